"""URL filters: host-suffix × path-prefix expressions looked up by short hash.

Every URL is expanded into the expressions a rule could be written as (a label
suffix of its host plus a prefix of its path), the expressions meet the rules
in an equi-join on the first 32 bits of their SHA-256, the full digests then
confirm the match, and the longest fitting rule decides. DataFrame functions
only.

Defined cases: a null URL or one without ``://`` has an empty host and path,
fits no rule and gets the default verdict; equal URLs on several rows are
judged row by row; of rules written twice, and of rules of equal length, the
longer host, then ``allow`` before ``block``, wins; rules with a null or empty
host are ignored and a null rule path counts as empty; without rules every row
gets the default; further columns of either input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import broadcast_if

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that the join key keeps (8 digits: 32 bits).
PREFIX_DIGITS = 8


def host_path(url):
    """(host, path) columns of a URL column; both empty where there is no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("1"))
    tail = F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))
    host = F.translate(F.regexp_extract(tail, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return (F.when(rest.isNotNull(), host).otherwise(empty),
            F.when(rest.isNotNull(), path).otherwise(empty))


def _digest(expression):
    return F.sha2(expression, 256)


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """Columns ``id_col``, host, path, rule, verdict: one row per row of ``pages``.

    ``rules``: host, path, action ('allow' or 'block'). A rule fits its host and
    every subdomain when the URL's path starts with the rule's path.
    """
    known = (rules.select(F.translate("host", UPPER, LOWER).alias("h"),
                          F.coalesce("path", F.lit("")).alias("p"), F.col("action").alias("a"))
             .filter("h is not null and h <> ''")
             .groupBy("h", "p").agg(F.min("a").alias("action")))
    # which suffix and prefix lengths any rule has: bounded by URL lengths, not by rows
    shapes = (known.select((F.size(F.split("h", r"\.")) + 0).alias("n"), F.length("p").alias("l"))
              .distinct().collect())
    size = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("h") + F.length("p")), F.lit(0)).alias("b")).first()
    digest = _digest(F.concat("h", "p"))
    known = known.select(F.substring(digest, 1, PREFIX_DIGITS).alias("key"), digest.alias("digest"),
                         F.concat("h", "p").alias("rule"), F.length("h").alias("rule_host"), "action")

    host, path = host_path(F.col("_url"))
    urls = (pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
            .select(F.monotonically_increasing_id().alias("_row"), "_id", host.alias("host"), path.alias("path")))
    pairs = ", ".join(f"struct({r.n} as n, {r.l} as l)" for r in sorted(shapes)) or "cast(null as struct<n:int,l:int>)"
    expressions = F.expr(
        f"transform(filter(array({pairs}), s -> s.n <= size(split(host, '[.]')) and s.l <= length(path)),"
        " s -> concat(substring_index(host, '.', -s.n), substring(path, 1, s.l)))")
    looked = (urls.withColumn("_e", F.explode_outer(expressions))
              .withColumn("_digest", F.when(F.col("host") != "", _digest(F.col("_e"))))
              .withColumn("_key", F.substring("_digest", 1, PREFIX_DIGITS)))
    hits = looked.join(broadcast_if(known, size.b + 200 * size.n),
                       (F.col("_key") == F.col("key")) & (F.col("_digest") == F.col("digest")), "left")
    best = F.max(F.when(F.col("rule").isNotNull(),
                        F.struct(F.length("rule").alias("n"), F.col("rule_host").alias("h"),
                                 F.when(F.col("action") == "allow", 1).otherwise(0).alias("a"),
                                 F.col("rule").alias("rule"), F.col("action").alias("action"))))
    return (hits.groupBy("_row", "_id", "host", "path").agg(best.alias("b"))
            .select(F.col("_id").alias(id_col), "host", "path", F.col("b.rule").alias("rule"),
                    F.coalesce(F.col("b.action"), F.lit(default)).alias("verdict")))

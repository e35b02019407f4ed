"""The registered queries opN_<name> and their DuckDB SQL.

Each is a thin view on an operator of this package, over its whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise.llm import (chat, codes, decontam, forest, html, packing, quality, resample, simhash, token_counts, topk,
                          toxicity, urls)
from cartwise.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    """The public vocabulary the packing and counting queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register
def op2_html_extraction(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@register
def op3_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), 5, F.col("vec_id") % 50 == 0)


ORACLES["op3_exact_top_k"] = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""


@register
def op4_benchmark_decontamination(spark, sf_dir):
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op4_benchmark_decontamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[s:s + 9] AS p FROM (
          SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(p) AS n FROM win),
grams AS (SELECT doc_id, s, n, w[s:s + n - 1] AS p FROM (
            SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n)),
m AS (SELECT doc_id, s, n, item_id FROM grams JOIN win USING (p)),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS pos FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)"""


@register
def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@register
def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


#: The contract's added conversation, which holds a template's control strings.
ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@register
def op7_chat_formatting(spark, sf_dir):
    added = spark.createDataFrame(ADDED, "conv_id bigint, turn bigint, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    back = chat.read_back(chat.chat_windows(talks))
    return back.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
                       F.length("targets").cast("bigint").alias("loss_chars"),
                       F.sha2("targets", 256).alias("loss_sha256"), "formatted_chars")


ORACLES["op7_chat_formatting"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
             SELECT conv_id, turn, role, text FROM conversations UNION ALL
             SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))),
n AS (SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) + 4 AS n,
             15 + length(replace(role, '~', '~0')) + length(replace(text, '~', '~0')) - 3 AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS idx FROM c),
b AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY idx) - n AS before,
             coalesce(max(CASE WHEN idx = 1 AND role = 'system' THEN n END) OVER (PARTITION BY conv_id), 0) AS sys FROM n),
s AS (SELECT *, greatest(1024 - sys - 192, 256) AS room FROM b),
k AS (SELECT *, before // room AS k, CASE WHEN before // room <> (before + n - 1) // room THEN idx ELSE 0 END AS i FROM s),
g AS (SELECT conv_id, k, i, sys, min(idx) AS win, min(before) AS at, 1024 - sum(n) AS left_over FROM k GROUP BY ALL),
h AS (SELECT *, sys > 0 AND sys <= left_over AS rep, least(192, left_over - CASE WHEN sys <= left_over AND win > 1 THEN sys ELSE 0 END) AS past FROM g),
p AS (SELECT k.conv_id, sum(k.chars) AS chars FROM k JOIN h ON k.conv_id = h.conv_id AND (
        (k.k = h.k AND k.i = h.i) OR (k.idx < h.win AND CASE WHEN k.idx = 1 AND k.sys > 0 THEN h.rep ELSE k.before >= h.at - h.past END))
      GROUP BY k.conv_id)
SELECT k.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(any_value(p.chars) AS BIGINT) AS formatted_chars
FROM k JOIN p ON k.conv_id = p.conv_id GROUP BY k.conv_id"""


@register
def op8_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.url_verdicts(table(spark, sf_dir, "pages"), rules)


#: The rules of the contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

ORACLES["op8_url_filters"] = r"""
WITH rules(h, p, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, row_number() OVER () AS r,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS t FROM pages),
s AS (SELECT page_id, r, translate(regexp_extract(t, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
      FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM s LEFT JOIN j USING (r)"""


@register
def op10_simhash_near_dedup(spark, sf_dir):
    out = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op9_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register
def op11_vector_code_compression(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    books = codes.train(vectors)
    out = codes.with_label_errors(codes.encode(vectors, books))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return out.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
                      F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of assignment and floored means, one pair of subqueries each."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
l{i} AS MATERIALIZED (SELECT part, e, list(c ORDER BY pos) AS c FROM c{i} GROUP BY part, e),
a{i} AS MATERIALIZED (SELECT r, part, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d FROM (
  SELECT r, part, e, CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) AS d
  FROM p JOIN l{i} USING (part)) GROUP BY r, part)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (SELECT c{i}.part, c{i}.e, c{i}.pos, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
  SELECT part, e, pos, floor(sum(x) / count(*)) AS m FROM (
    SELECT part, e, unnest(x) AS x, unnest(range(1, len(x) + 1)) AS pos FROM p JOIN a{i} USING (r, part))
  GROUP BY part, e, pos) USING (part, e, pos))""")
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
        list_transform(embedding, lambda x: floor({4096} * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, q[part * (len(q) // {parts}) + 1:(part + 1) * (len(q) // {parts})] AS x
      FROM k, (SELECT unnest(range({parts})) AS part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS e, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS c FROM p WHERE r <= {entries}),{",".join(steps)},
o AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, pos)) FROM c{rounds}) AS codebooks_sha256
FROM k JOIN o USING (r)"""


ORACLES["op11_vector_code_compression"] = _codes_sql()


@register
def op12_importance_resampling(spark, sf_dir):
    out = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@register
def op13_approximate_neighbours(spark, sf_dir):
    return forest.nearest(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % 20 == 0)

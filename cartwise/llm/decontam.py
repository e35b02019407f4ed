"""Benchmark decontamination over a distributed positional inverted index.

The index holds one posting (term, document, position) for every corpus token
that is a term of the test items, written once to the shared folder; a closing
posting of term 0 carries each document's length. Windows of ``window``
consecutive item words are looked up as phrases: the postings of a window's
rarest term give candidate starts (position minus the term's offset), these are
intersected with the offset-adjusted list of the second rarest term, and what
is left with the lists of all other terms at once. DataFrame functions only.

Everything is keyed by (document, position), so a term, a passage or a source
that holds a third of the corpus spreads over all tasks. The vocabulary of the
test items is broadcast only below a measured size.

Defined cases: null text has no words; an item without words has no window and
an item shorter than a window is one window; rows are judged one by one, also
with a repeated doc_id, and equal rows get equal answers; a repeated item_id
counts once; the rows of null item_id count as one item, whose words are hit and
which item_ids doesn't name; empty tables give no hits (no items) or
no rows (no documents); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import broadcast_if, staged

#: What lies between words once A-Z count as lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    """Array of a text's words, letters as they are (null text: no words)."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), "")


def fold(word):
    """A-Z lower-cased; ``lower`` serves wherever it can't touch another letter."""
    low = F.lower(word)
    return (F.when(low == word, word).when(F.length(word) == F.octet_length(word), low)
            .otherwise(F.translate(word, UPPER, LOWER)))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, text, terms): each item's windows as arrays of terms."""
    items = benchmark.select(
        "item_id", F.transform(words(F.col("text")), fold).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return (items.select("item_id", "w", F.explode(starts).alias("at"))
            .select("item_id", F.slice("w", F.col("at"), window).alias("terms"))
            .withColumn("phrase", F.array_join("terms", " ")).distinct())


class Phrases:
    """Test phrases as written tables: ``items`` (wid, item_id), ``terms`` (wid,
    off, term, len) and the vocabulary (word, term; '' is term 0)."""

    def __init__(self, windows: DataFrame):
        windows = staged(windows, "decontam-windows")
        phrases = staged(windows.select("phrase", "terms").distinct()
                         .select(F.monotonically_increasing_id().alias("wid"), "phrase", "terms"), "decontam-phrases")
        self.items = staged(windows.join(phrases, "phrase").select("wid", "item_id").distinct(), "decontam-items")
        parts = phrases.select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "word"))
        vocabulary = parts.select("word").distinct().select("word", (F.monotonically_increasing_id() + 1).alias("term"))
        self.vocabulary = staged(vocabulary.unionAll(windows.sparkSession.sql("select '' as word, 0L as term")),
                                 "decontam-vocabulary")
        self.terms = staged(parts.join(self.vocabulary, "word").select("wid", "len", "off", "term"), "decontam-terms")
        self.vocabulary_bytes = self.vocabulary.agg(F.sum(F.octet_length("word") + 64)).first()[0]
        self.terms_bytes = 64 * self.terms.count()


def build_index(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """The positional index of ``docs``: term, uid, pos; rows of term 0 close a
    document and carry doc_id, text_hash and its word count as pos."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.col("text").cast("string").alias("text"))
    tokens = (rows.select("uid", "doc_id", F.xxhash64("text").alias("text_hash"),
                          F.posexplode(F.array_append(words(F.col("text")), F.lit(""))).alias("pos", "raw"))
              .withColumn("word", fold(F.col("raw"))))
    hits = tokens.join(broadcast_if(phrases.vocabulary, phrases.vocabulary_bytes), "word")
    closing = F.col("term") == 0
    return staged(hits.select("term", "uid", "pos", F.when(closing, F.col("doc_id")).alias("doc_id"),
                              F.when(closing, F.col("text_hash")).alias("text_hash")), "decontam-index")


def rarest_first(index: DataFrame, phrases: Phrases) -> DataFrame:
    """``phrases.terms`` with rank (1: fewest postings) and the posting count;
    phrases with a term the corpus lacks are left out, they cannot occur."""
    counts = index.filter("term > 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"))  # a row a word at most
    w = Window.partitionBy("wid")
    ranked = (phrases.terms.join(broadcast_if(counts, phrases.vocabulary_bytes), "term", "left")
              .withColumn("gone", F.sum(F.when(F.col("n").isNull(), 1).otherwise(0)).over(w)).filter("gone = 0")
              .withColumn("rank", F.row_number().over(w.orderBy("n", "off"))))
    return staged(ranked.select("wid", "len", "off", "term", "n", "rank"), "decontam-ranked")


def phrase_matches(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Every occurrence of every phrase: uid, wid, start, len."""
    ranked = rarest_first(index, phrases)
    postings = index.filter("term > 0").select("term", "uid", "pos")
    small = lambda df: broadcast_if(df, phrases.terms_bytes)
    anchors = ranked.filter("rank = 1").select("term", "wid", "len", "off")
    found = (postings.join(small(anchors), "term").filter("pos >= off")
             .select("uid", "wid", "len", (F.col("pos") - F.col("off")).alias("start")))

    def needed(of: DataFrame, ranks: str) -> DataFrame:
        other = ranked.filter(ranks).select("wid", "off", "term")
        return of.join(small(other), "wid").select("uid", "wid", "len", "start", "term",
                                                   (F.col("start") + F.col("off")).alias("pos"))

    second = postings.join(small(ranked.filter("rank = 2").select("term").distinct()), "term", "left_semi")
    two = needed(found.filter("len > 1"), "rank = 2").join(second, ["uid", "term", "pos"], "left_semi")
    two = staged(two.select("uid", "wid", "len", "start"), "decontam-pairs")
    # the other lists at once: a start stays if every one of its terms stands where it must
    rest = (needed(two.filter("len > 2"), "rank > 2").join(postings, ["uid", "term", "pos"], "left_semi")
            .groupBy("uid", "wid", "len", "start").agg(F.count(F.lit(1)).alias("n")).filter("n = len - 2").drop("n"))
    done = found.filter("len = 1").select("uid", "wid", "len", "start").unionAll(two.filter("len = 2")).unionAll(rest)
    return done.select("uid", "wid", "start", "len")


def proximity_matches(index: DataFrame, phrases: Phrases, reach: int) -> DataFrame:
    """Phrases whose distinct terms all stand within ``reach`` words of the rarest
    one, in any order: uid, wid, pos (of the rarest term)."""
    ranked = rarest_first(index, phrases)
    postings = index.filter("term > 0").select("term", "uid", "pos")
    distinct = ranked.groupBy("wid", "term").agg(F.min("rank").alias("rank"))
    anchors = distinct.filter("rank = 1").select("term", "wid")
    others = distinct.filter("rank > 1").select("wid", F.col("term").alias("other"))
    n_others = others.groupBy("wid").agg(F.count(F.lit(1)).alias("need"))
    at = postings.join(broadcast_if(anchors, phrases.terms_bytes), "term").select("uid", "wid", "pos")
    # blocks of `reach` words: what is near lies in the same or a neighbouring block
    block = F.floor(F.col("pos") / reach)
    near = (at.join(broadcast_if(others, phrases.terms_bytes), "wid")
            .withColumn("block", F.explode(F.array(block - 1, block, block + 1))))
    p = postings.select(F.col("uid").alias("pu"), F.col("term").alias("pt"), F.col("pos").alias("pp"), block.alias("pb"))
    met = (near.join(p, (F.col("uid") == F.col("pu")) & (F.col("other") == F.col("pt")) & (F.col("block") == F.col("pb"))
                     & (F.abs(F.col("pos") - F.col("pp")) <= reach), "left_semi")
           .select("uid", "wid", "pos", "other").distinct()
           .groupBy("uid", "wid", "pos").agg(F.count(F.lit(1)).alias("have")))
    return (at.join(broadcast_if(n_others, phrases.terms_bytes), "wid", "left").join(met, ["uid", "wid", "pos"], "left")
            .filter("coalesce(need, 0) = coalesce(have, 0)").select("uid", "wid", "pos").distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit (words inside
    an occurrence of a window), n_items, item_ids (sorted as strings), contaminated."""
    phrases = Phrases(item_windows(benchmark, window))
    index = build_index(docs, phrases)
    matches = staged(phrase_matches(index, phrases), "decontam-matches")
    end = F.col("start") + F.col("len")
    before = Window.partitionBy("uid").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    hit = (matches.select("uid", "start", "len").distinct()
           .withColumn("reached", F.coalesce(F.max(end).over(before), F.lit(0)))
           .groupBy("uid").agg(F.sum(F.greatest(end - F.greatest("start", "reached"), F.lit(0))).alias("n_hit")))
    items = (matches.select("uid", "wid").distinct().join(broadcast_if(phrases.items, phrases.terms_bytes), "wid")
             .select("uid", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("uid").agg(F.sort_array(F.collect_list("item")).alias("item_ids"), F.count(F.lit(1)).alias("n_items")))
    rows = index.filter("term = 0").select("uid", "doc_id", "text_hash", F.col("pos").cast("bigint").alias("n_words"))
    return (rows.join(hit, "uid", "left").join(items, "uid", "left")
            .select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold an occurrence of a test window."""
    bad = (decontaminate(docs, benchmark, window).filter("contaminated")
           .select(F.col("doc_id").alias("_bd"), F.col("text_hash").alias("_bt")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_bd"))
                     & (F.xxhash64(docs["text"].cast("string")) == F.col("_bt")), "left_anti")

"""Benchmark decontamination with a positional inverted index.

The index holds, for each term that occurs in the benchmark, where it stands
in the training documents: rows (term, rid, pos), written once, segment by
segment, as the corpus is read; no posting is shuffled until its list is asked
for. ``rid`` names a document row by a hash of its id and text. The row of a
document's first piece also keeps its id and length.

Benchmark items are cut into windows of ``n`` words (an item with fewer is one
window). For each window the list of its rarest term is read and shifted by
the term's offset, which gives starts; the list of the second rarest term,
shifted alike, is intersected with it; what is left is checked against the
lists of all other terms. With ``slop`` > 0 each term may stand up to that
many words from its place (proximity matches); 0 means exact phrases.

Everything is DataFrame work. Only tables of a checked number of rows are
broadcast, else the same join shuffles.

Results in odd cases: null or empty text has no words, and no item without
words matches; rows that repeat doc_id and text are each reported alike, other
rows under one doc_id (or a null one) are kept apart by their text; a null
item_id counts as the empty id, and rows under one item_id are one item; empty
tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import broadcast_within, persist

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rows up to which the vocabulary, the windows or the candidates' row ids are broadcast (some ten MB).
MAX_BROADCAST_ROWS = 500_000
KEY = ["rid", "term", "pos"]


def _split(text: Column) -> Column:
    """Pieces between gaps; only the first and the last can be empty."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), GAP)


def _lower_az(word: Column) -> Column:
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def _row_id() -> Column:
    return F.xxhash64("doc_id", "text")


def item_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """item, w (window id), len, k (offset) and word of every window."""
    words = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                              F.posexplode(_split(F.col("text"))).alias("pos", "word"), F.xxhash64("text").alias("t"))
             .filter("word != ''").withColumn("word", _lower_az(F.col("word"))))
    by = Window.partitionBy("item", "t")
    words = (words.dropDuplicates(["item", "t", "pos"])
             .withColumn("size", F.count("*").over(by))
             .withColumn("i", F.row_number().over(by.orderBy("pos")) - 1))
    first = F.greatest(F.lit(0), F.col("i") - n + 1)
    last = F.greatest(F.lit(0), F.least(F.col("i"), F.col("size") - n))
    return (words.withColumn("s", F.explode(F.sequence(first, last)))
            .select("item", F.xxhash64("item", "t", "s").alias("w"), F.least(F.col("size"), F.lit(n)).alias("len"),
                    (F.col("i") - F.col("s")).cast("int").alias("k"), "word"))


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings of the words in ``vocabulary`` (word, term). The first row of
    each document has its doc_id and n_words, and a null term if its first
    piece is no such word. Written, segment by segment."""
    pieces = docs.select("doc_id", _row_id().alias("rid"), _split(F.col("text")).alias("a"))
    n_words = (F.size("a") - (F.element_at("a", 1) == "").cast("int")
               - ((F.size("a") > 1) & (F.element_at("a", -1) == "")).cast("int"))
    words = (pieces.select("doc_id", "rid", n_words.cast("long").alias("n_words"), F.posexplode("a").alias("pos", "word"))
             .withColumn("word", _lower_az(F.col("word"))))
    at_start = F.col("pos") == 0
    rows = words.join(broadcast_within(vocabulary, MAX_BROADCAST_ROWS), "word", "left").filter(
        at_start | F.col("term").isNotNull())
    rows = rows.select("term", "rid", "pos", F.when(at_start, F.col("doc_id")).alias("doc_id"),
                       F.when(at_start, F.col("n_words")).alias("n_words"))
    return persist(rows, "positions")


def matches(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """rid, w and start of every place where all terms of a window stand, each
    within ``slop`` words of its offset. ``windows``: w, len, k, term."""
    postings = index.filter("term IS NOT NULL").select(*KEY)
    count = persist(postings.groupBy("term").agg(F.count("*").alias("df")), "term-counts")
    ranked = windows.join(count, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    by = Window.partitionBy("w")
    ranked = (ranked.withColumn("rarest", F.min("df").over(by)).filter("rarest > 0")
              .withColumn("rank", F.row_number().over(by.orderBy("df", "k"))).select("w", "k", "term", "len", "rank"))
    ranked = persist(ranked, "ranked-terms")

    def listed(found: DataFrame, terms: DataFrame, lists: DataFrame) -> DataFrame:
        """Where the given terms of found windows should stand and do."""
        want = (found.join(broadcast_within(terms, MAX_BROADCAST_ROWS), "w")
                .withColumn("off", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
                .select("w", "rid", "start", "len", "k", "term", (F.col("start") + F.col("k") + F.col("off")).alias("pos")))
        return want.join(lists, KEY, "left_semi").select("w", "rid", "start", "len", "k").distinct()

    def lists_of(terms: DataFrame) -> DataFrame:
        return postings.join(broadcast_within(persist(terms.select("term").distinct(), "terms"), MAX_BROADCAST_ROWS), "term")

    first, second = ranked.filter("rank = 1"), ranked.filter("rank = 2")
    starts = (postings.join(broadcast_within(first, MAX_BROADCAST_ROWS), "term")
              .withColumn("off", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
              .select("w", "rid", (F.col("pos") - F.col("k") - F.col("off")).alias("start"), "len").distinct())
    starts = persist(starts, "starts")
    single = starts.filter("len = 1").select("w", "rid", "start")
    two = listed(starts.filter("len > 1").drop("len"), second, lists_of(second)).select("w", "rid", "start", "len")
    two = persist(two, "candidates")

    rows = persist(two.select("rid").distinct(), "candidate-rows")
    near = postings.join(broadcast_within(rows, MAX_BROADCAST_ROWS), "rid", "left_semi")
    rest = listed(two.drop("len"), ranked.filter("rank > 2"), near)
    full = (rest.groupBy("w", "rid", "start").agg(F.count("*").alias("n"), F.first("len").alias("len"))
            .filter("n = len - 2").select("w", "rid", "start"))
    return single.unionByName(two.filter("len = 2").select("w", "rid", "start")).unionByName(full)


def decontamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = 0) -> DataFrame:
    """For every document row: doc_id, n_words, n_hit (words inside a match),
    items (matched item ids, sorted as strings) and rid."""
    windows = persist(item_windows(benchmark, n), "windows")
    vocabulary = persist(windows.select("word").distinct(), "vocabulary")
    vocabulary = persist(vocabulary.withColumn("term", F.monotonically_increasing_id()), "terms")
    windows = persist(windows.join(vocabulary, "word").drop("word"), "window-terms")
    index = build_index(docs, vocabulary)
    found = persist(matches(index, windows.drop("item"), slop), "matches")
    of = windows.select("w", "item", "len").distinct()
    found = found.join(broadcast_within(of, MAX_BROADCAST_ROWS), "w")
    span = F.sequence(F.greatest(F.col("start") - slop, F.lit(0)), F.col("start") + F.col("len") - 1 + slop)
    hit = (found.select("rid", "start", "len").distinct().select("rid", F.explode(span).alias("pos")).distinct()
           .groupBy("rid").agg(F.count("*").alias("n_hit")))
    items = (found.select("rid", "item").distinct().groupBy("rid")
             .agg(F.array_sort(F.collect_list("item")).alias("items")))
    marks = index.filter("n_words IS NOT NULL").select("doc_id", "rid", "n_words")
    out = marks.join(hit, "rid", "left").join(items, "rid", "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", none).alias("items"), "rid")


def decontamination_filter(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, columns unchanged."""
    bad = persist(decontamination(docs, benchmark, n).filter("n_hit > 0").select("rid").distinct(), "contaminated")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    named = docs.select(row, _row_id().alias("rid"))
    return named.join(broadcast_within(bad, MAX_BROADCAST_ROWS), "rid", "left_anti").select("row.*")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    out = decontamination(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))

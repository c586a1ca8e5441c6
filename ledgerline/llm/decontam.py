"""Benchmark decontamination over a positional inverted index.

Words of the training texts are posted as (term, document, position) for the
terms that matter: each window of benchmark words is looked up by its rarest
terms. Postings of the rarest term, moved back by the term's place in the
window, are the candidate starts; they are intersected with the moved postings
of the next-rarest term, and what is left is compared word by word. Only
DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, small_side

WINDOW = 10
#: What parts words: ASCII characters other than digits and lower-case letters, after lower-casing.
PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERMS = 2  # rarest terms of a window that are intersected


def word_array(text: Column) -> Column:
    """Words of a text; where it begins or ends with none, an empty first or last element."""
    return F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), PARTS, -1)


def _lead(words: str) -> Column:
    return F.when(F.col(words)[0] == "", 1).otherwise(0)


def count_words(words: str) -> Column:
    last = F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (F.size(words) - _lead(words) - last).cast("bigint")


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """item_id, window (place of its first word), words: every ``size``
    consecutive words of an item, or all of them if there are fewer."""
    words = F.filter(word_array(F.col(text_col)), lambda w: w != "")
    own = items.select(F.col(id_col).alias("item_id"), words.alias("_all")).where(F.size("_all") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_all") - size))
    return own.select("item_id", "_all", F.explode(starts).alias("window")) \
        .select("item_id", "window", F.slice("_all", F.col("window") + 1, size).alias("words"))


def training_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Key of each row (hashes of id and text, so that equal rows are one) and its words."""
    return docs.select(F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(F.col(text_col).cast("string")).alias("k2"),
                       word_array(F.col(text_col)).alias("_words"))


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: occurrences in the training texts of each of ``terms`` that occurs."""
    return rows.select(F.explode("_words").alias("term")).join(terms, "term", "left_semi") \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def rarest(wins: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """Each window that can occur (all its terms do) with ``rare``: its ``n``
    rarest places, as structs (count, place, term), rarest first."""
    places = wins.select("w", "size", F.posexplode("words").alias("place", "term")).join(counts, "term", "left")
    per = places.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("n", "place", "term"))).alias("_by"),
                                  F.count("n").alias("_found"), F.first("size").alias("size"))
    return per.where(F.col("_found") == F.col("size")).select("w", F.slice("_by", 1, n).alias("rare"))


def postings(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The index, written to the shared work folder: term, k1, k2, pos (element of the word array)."""
    index = rows.select("k1", "k2", F.posexplode("_words").alias("pos", "term")).join(terms, "term", "left_semi")
    return materialize(index, "postings")


def phrase_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """k1, k2 (document key), item_id, window, start, length: every exact
    occurrence of a window in a document; start is an element of its word array."""
    return _matches(docs, items, id_col, text_col, item_id, item_text, size, 0, True)


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """As :func:`phrase_matches`, for windows whose TERMS rarest terms occur
    with their distance changed by ``slop`` words at most; start is where the
    rarest one puts the window (it may lie before the text)."""
    return _matches(docs, items, id_col, text_col, item_id, item_text, size, slop, False)


def _matches(docs, items, id_col, text_col, item_id, item_text, size, slop, exact) -> DataFrame:
    rows = training_words(docs, id_col, text_col)
    found = windows(items, item_id, item_text, size)
    # Equal windows of several items are looked up once.
    wins = found.select("words").distinct().withColumn("size", F.size("words")).withColumn("w", F.sha2(F.concat_ws(" ", "words"), 256))
    wins = materialize(wins, "windows")
    terms = small_side(wins.select(F.explode("words").alias("term")).distinct(), "terms")
    rare = materialize(rarest(wins, term_counts(rows, terms), TERMS), "rarest")
    index = postings(rows, small_side(rare.select(F.explode("rare.term").alias("term")).distinct(), "seed-terms"))
    by = [F.get("rare", F.lit(i)) for i in range(2)]
    first = small_side(rare.select("w", by[0]["term"].alias("term"), by[0]["place"].alias("place"),
                                   by[1]["term"].alias("term2"), by[1]["place"].alias("place2")), "seeds")
    starts = index.join(first, "term").select("w", "k1", "k2", (F.col("pos") - F.col("place")).alias("start"), "term2", "place2")
    if exact:
        starts = starts.where("start >= 0")
    alone = starts.where("term2 is null").select("w", "k1", "k2", "start")
    shifts = F.array(*[F.lit(i) for i in range(-slop, slop + 1)])
    wanted = starts.where("term2 is not null").withColumn("_shift", F.explode(shifts)) \
        .withColumn("_pos", F.col("start") + F.col("place2") + F.col("_shift"))
    other = index.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("term").alias("_term"), F.col("pos").alias("_at"))
    both = wanted.join(other, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("term2") == F.col("_term"))
                       & (F.col("_pos") == F.col("_at")), "left_semi").select("w", "k1", "k2", "start")
    candidates = both.unionByName(alone)
    if exact:
        # Windows of a document are gathered on one row (no more than its words have occurrences), so texts are moved once.
        per = candidates.join(wins.select("w", "words", "size"), "w").groupBy("k1", "k2") \
            .agg(F.collect_list(F.struct("w", "start", "size", "words")).alias("_c"))
        texts = docs.select(F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(F.col(text_col).cast("string")).alias("k2"),
                            F.col(text_col).alias("_text"))
        same = texts.join(per, ["k1", "k2"]).withColumn("_words", word_array(F.col("_text"))).select("k1", "k2", F.explode(F.filter(
            "_c", lambda c: F.slice("_words", c["start"] + 1, c["size"]) == c["words"])).alias("c"))
        candidates = same.select("k1", "k2", "c.w", "c.start", "c.size").distinct()  # repeated rows match alike
    else:
        candidates = candidates.distinct().join(wins.select("w", "size"), "w")
    by_item = found.select("item_id", "window", F.sha2(F.concat_ws(" ", "words"), 256).alias("w"))
    return candidates.join(by_item, "w").select("k1", "k2", "item_id", "window", "start", F.col("size").alias("length"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence of a window),
    n_items, items_sha256 (of the items' ids, sorted as text, joined by
    commas), contaminated; one row for each row of ``docs``.

    Null and empty texts have no words. Items without words are left out;
    repeated items, and items that share a window, each count by their id (a
    null id counts as no item, but its words are hit). Repeated rows have equal
    results. Other columns are not read. Without items nothing is hit.
    """
    hits = materialize(_matches(docs, items, id_col, text_col, item_id, item_text, size, 0, True), "matches")
    spans = hits.select("k1", "k2", "start", "length").groupBy("k1", "k2", "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy("k1", "k2").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", F.coalesce(
        F.max(F.col("start") + F.col("length")).over(before), F.lit(0))))
    covered = spans.withColumn("_new", fresh).groupBy("k1", "k2").agg(F.sum("_new").alias("n_hit"))
    named = hits.where(F.col("item_id").isNotNull()).select("k1", "k2", F.col("item_id").cast("string").alias("item")).distinct() \
        .groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item"))).alias("_items"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(F.col(text_col).cast("string")).alias("k2"),
                       word_array(F.col(text_col)).alias("_words")).withColumn("n_words", count_words("_words")).drop("_words")
    return rows.join(covered.join(named, ["k1", "k2"], "left"), ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Rows of ``docs``, with all their columns, in which no window of any item occurs."""
    hits = materialize(_matches(docs, items, id_col, text_col, item_id, item_text, size, 0, True).select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct(), "matches")
    return docs.join(hits, (F.xxhash64(docs[id_col]) == hits["_k1"]) & (F.xxhash64(docs[text_col].cast("string")) == hits["_k2"]), "left_anti")

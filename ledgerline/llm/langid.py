"""Language identification by prediction by partial matching.

One variable-order byte context tree a language, of ``order`` preceding bytes
at most, gives each next byte a probability: seen ``c`` times in a context of
``t`` bytes and ``d`` different ones, it has c / (t + d); otherwise the coder
escapes with d / (t + d) to the context one byte shorter (escape method C, no
exclusion), and below the empty context every byte has 1/256. Counts are
frozen after training, so every byte of a text has an exact code length in
every language; the language with the shortest code for the whole text wins.

A text is coded as if line feeds stood before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import in_fold, small_side, string_bytes, text_pieces

ORDER = 3
#: Model bound: longest contexts with a next byte kept over all languages
#: together, an equal share a language, the most frequent of each first.
MAX_GRAMS = 1 << 20
PAD = 10


def grams(raw: np.ndarray, lengths: np.ndarray, order: int) -> np.ndarray:
    """For each byte, itself and the ``order`` bytes before it in its text, as
    one big-endian number."""
    keys = raw.astype(np.uint32)
    for j in range(1, order + 1):
        keys[j:] |= raw[:-j].astype(np.uint32) << np.uint32(8 * j) if j < len(raw) else np.uint32(0)
    starts = np.cumsum(lengths) - lengths
    for j in range(order):  # the first bytes of a text have line feeds before them
        at = (starts + j)[lengths > j]
        key = np.zeros(len(at), np.uint32)
        for back in range(order, -1, -1):
            key = (key << np.uint32(8)) | (raw[at - back] if back <= j else np.uint32(PAD))
        keys[at] = key
    return keys


class Places:
    """Open-addressing table from numbers to 0..n-1, looked up by whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint32(32 - bits), (1 << bits) - 1
        self.key = np.zeros(1 << bits, np.uint32)
        self.at = np.full(1 << bits, -1, np.int32)
        self.tries = 0
        todo = np.arange(len(keys), dtype=np.int32)
        while len(todo):
            slot = (self._home(keys[todo]) + self.tries) & self.mask
            free = self.at[slot] < 0
            self.at[slot[free]] = todo[free]  # of several at one slot, the last stays
            done = self.at[slot] == todo
            self.key[slot[done]] = keys[todo[done]]
            todo = todo[~done]
            self.tries += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        home = self._home(keys)
        out = np.where(self.key[home] == keys, self.at[home], -1)
        todo = np.flatnonzero((out < 0) & (self.at[home] >= 0))
        for n in range(1, self.tries):
            slot = (home[todo] + n) & self.mask
            hit = (self.key[slot] == keys[todo]) & (self.at[slot] >= 0)
            out[todo[hit]] = self.at[slot[hit]]
            todo = todo[~hit & (self.at[slot] >= 0)]
            if not len(todo):
                break
        return out


class Model:
    """Context trees of all languages, with escapes worked out beforehand.

    ``costs[m]``: bits of the last byte of each known string of m + 1 bytes
    after its first m, one column a language. ``escapes[m]``: bits to leave
    each known context of m bytes (0 in languages that lack it).
    """

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]], order: int):
        self.languages, self.order = languages, order
        n = len(languages)
        self.costs, self.places, self.escapes, self.contexts = [], [], [], []
        for m in range(order + 1):
            mask = np.uint32((1 << (8 * (m + 1))) - 1)
            cut = [(key & mask, c) for key, c in counts]
            known = np.unique(np.concatenate([k for k, _ in cut]))
            seen = np.zeros((len(known), n))
            for i, (k, c) in enumerate(cut):
                np.add.at(seen[:, i], np.searchsorted(known, k), c)
            contexts, at = np.unique(known >> np.uint32(8), return_inverse=True)
            total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, at, seen)
            np.add.at(kinds, at, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                own = np.log2((total + kinds)[at] / seen)
            lower = self.costs[-1][self.places[-1].find(known & (mask >> np.uint32(8)))] if m else np.full((len(known), n), 8.0)
            self.costs.append(np.where(seen > 0, own, escape[at] + lower))
            self.places.append(Places(known))
            self.escapes.append(escape)
            self.contexts.append(Places(contexts) if m else None)

    def code_lengths(self, raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(lengths), len(self.languages)))
        if not len(raw):
            return out
        keys = grams(raw, lengths, self.order)
        at = self.places[-1].find(keys)
        bits = self.costs[-1][np.maximum(at, 0)]
        todo = np.flatnonzero(at < 0)
        bits[todo] = 0
        for m in range(self.order, -1, -1):  # strings that no language knows
            if not len(todo):
                break
            mask = np.uint32((1 << (8 * (m + 1))) - 1)
            key = keys[todo] & mask
            at = self.places[m].find(key)
            bits[todo[at >= 0]] += self.costs[m][at[at >= 0]]
            todo, key = todo[at < 0], key[at < 0]
            left = self.contexts[m].find(key >> np.uint32(8)) if m else np.zeros(len(key), np.int64)
            bits[todo[left >= 0]] += self.escapes[m][left[left >= 0]]
        bits[todo] += 8.0
        some = lengths > 0
        out[some] = np.add.reduceat(bits, (np.cumsum(lengths) - lengths)[some], axis=0)
        return out


def most_frequent(counts: DataFrame, kept: int) -> DataFrame:
    """About ``kept`` rows (lang, gram, n) of each language: all that are more
    frequent than some count, and of those with just that count a share by a
    hash of the string. The count is found in the table of how many strings
    have which count, so no task reads all strings of a language; the result of that
    (one row a language at most) is sent to all tasks if it is small. All rows
    of a language with ``kept`` strings or fewer are returned.
    """
    sizes = counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("_ties"))
    upto = F.sum("_ties").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    edges = sizes.withColumn("_above", upto - F.col("_ties")).where((F.col("_above") < kept) & (F.col("_above") + F.col("_ties") > kept)) \
        .select("lang", F.col("n").alias("_edge"), ((kept - F.col("_above")) / F.col("_ties")).alias("_share"))
    part = F.pmod(F.xxhash64("gram"), F.lit(1 << 30)) / F.lit(1 << 30)
    return counts.join(small_side(edges, "ppm-edges"), "lang", "left").where(
        F.col("_edge").isNull() | (F.col("n") > F.col("_edge")) | ((F.col("n") == F.col("_edge")) & (part < F.col("_share")))) \
        .select("lang", "gram", "n")


def train(labelled: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS) -> Model | None:
    """Count all of ``labelled`` (lang, text); None if it has no bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch):
                langs = part.column("lang").to_numpy(zero_copy_only=False)
                for lang in set(langs):
                    raw, lengths = string_bytes(part.column("text").filter(pa.array(langs == lang)))
                    key, n = np.unique(grams(raw, lengths, order), return_counts=True) if len(raw) else ([], [])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key, pa.int64()), pa.array(n, pa.int64())],
                                                     ["lang", "gram", "n"])

    counts = materialize(labelled.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
                         .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ppm-counts")
    kept = max(1, max_grams // max(1, counts.select("lang").distinct().count()))
    rows = most_frequent(counts, kept).toPandas()
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    by = {lang: part for lang, part in rows.sort_values("gram").groupby("lang")}
    return Model(languages, [(by[x]["gram"].to_numpy().astype(np.uint32), by[x]["n"].to_numpy()) for x in languages], order)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Language of every whole text: id, kept columns, lang_pred, score, bits (code length in the chosen language).

    score is the chosen language's share of 2 ** -bits over all languages. Null
    and empty texts and texts without a letter are ``und`` with score 0, and so
    is everything if there is no model. Among equal code lengths the first
    language in alphabetical order wins. Repeated rows have a result each.
    Columns not named are not read.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), *keep, text.alias("text"), text.rlike(r"\p{L}").alias("_letter"))
    named = [id_col, *keep]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in text_pieces(batch):
                letters = part.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
                langs, scores, bits = ["und"] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows)
                if known is not None:
                    raw, lengths = string_bytes(part.column("text"))
                    code = known.code_lengths(raw, lengths)
                    best = code.argmin(axis=1)
                    least = code.min(axis=1)
                    share = 1 / np.exp2(np.maximum(least[:, None] - code, -1000)).sum(axis=1)
                    langs = [known.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                    scores, bits = np.where(letters, share, 0.0), np.where(letters, least, 0.0)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in named), pa.array(langs, pa.string()), pa.array(scores), pa.array(bits)],
                                                 [*named, "lang_pred", "score", "bits"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.select(*named).schema)
    return rows.mapInArrow(score, schema + "lang_pred string, score double, bits double")


def predict_languages(docs: DataFrame, folds: int = 4, held: int = 2, order: int = ORDER) -> DataFrame:
    """Train on documents outside the held-out fold that have a language, then
    identify all: doc_id, held_out, lang_pred, score, bits."""
    rows = docs.select("doc_id", "text", "lang", in_fold("doc_id", folds, held).alias("held_out"))
    model = train(rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()), order)
    return identify(rows, model, keep=("held_out",))

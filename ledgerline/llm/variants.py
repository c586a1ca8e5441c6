"""Spelling variants by a frequency-vector trie.

A word's vector counts its letters by group (GROUPS). The trie has a level a
group, with a branch for each count. One inserted, deleted or replaced letter
changes the vector by at most one surplus and one deficit, so a depth-first
search that may spend one of each on its way down meets every word at one
edit's distance; the words of a leaf are then compared letter by letter.

The top of the trie is cut where a node has at most SUBTREE words. The list of
such nodes is small (each has a parent with more than SUBTREE words) and known
to every task, which searches it with its words; what is left of a word's
budget goes with it to each node that it reaches, where a task holds the
node's own words as a trie and goes on.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import text_pieces

#: Letters of each level, those that tell most words apart first; every other letter counts to the last level.
GROUPS = ("e", "t", "n", "a", "i", "o", "r", "s", "h", "d", "l", "u", "c", "m", "g", "w", "f", "b", "y", "p", "vkjxqz", "")
SUBTREE = 8192
RUN = re.compile("[A-Za-zÀ-ÿ]+")
HELD = 400_000  # distinct words that a task counts before it hands them on
_LEVEL = {c: i for i, letters in enumerate(GROUPS) for c in letters}


def vector(word: str) -> tuple[int, ...]:
    counts = [0] * len(GROUPS)
    last = len(GROUPS) - 1
    for c in word:
        counts[_LEVEL.get(c, last)] += 1
    return tuple(counts)


def misspelt(word: str, number: int, every: int) -> str:
    """The word without one letter, if its crc32 ``number`` says so."""
    if number % every:
        return word
    at = number % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, least_length: int, least_count: int, every: int | None, id_col: str, text_col: str) -> DataFrame:
    """word, n: runs of Latin letters of all whole texts, A-Z lower-cased, each
    without one letter where the crc32 of ``<id>:<run>`` is divisible by
    ``every`` (None: never; a row without an id keeps its runs)."""
    long = re.compile(RUN.pattern.replace("+", f"{{{least_length},}}"))  # a shorter run can't become a word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for part in text_pieces(batch):
                for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    runs = Counter(long.findall(text.encode().lower().decode()))
                    if every and doc is not None:
                        start = zlib.crc32(f"{doc}:".encode())
                        for word in [w for w in runs if zlib.crc32(w.encode(), start) % every == 0]:
                            n = runs.pop(word)
                            shorter = misspelt(word, zlib.crc32(word.encode(), start), every)
                            if len(shorter) >= least_length:
                                held[shorter] += n
                    held.update(runs)
                    if len(held) >= HELD:
                        yield out()
        if held:
            yield out()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Trie:
    """Nested dicts by count; values lie at the end of their vector, however long."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, counts: tuple[int, ...], value) -> None:
        node = self.root
        for c in counts:
            node = node.setdefault(c, {})
        node.setdefault(None, []).append(value)

    def search(self, counts: tuple[int, ...], surplus: int, deficit: int) -> Iterator[tuple[list, int, int]]:
        """Values whose vectors exceed ``counts`` by at most ``surplus`` and fall
        short of it by at most ``deficit``, with what is left of both."""
        stack = [(self.root, 0, surplus, deficit)]
        while stack:
            node, depth, s, d = stack.pop()
            if None in node:
                yield node[None], s, d
                continue
            c = counts[depth]
            depth += 1
            if c in node:
                stack.append((node[c], depth, s, d))
            if s and c + 1 in node:
                stack.append((node[c + 1], depth, 0, d))
            if d and c - 1 in node:
                stack.append((node[c - 1], depth, s, 0))


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes a different word equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:] and a != b


def cut_nodes(words: DataFrame, most: int) -> list[tuple[int, ...]]:
    """Nodes of the trie over ``words`` (counts: their vectors) that have at
    most ``most`` words and whose parents have more; a full vector is a node
    however many words it has. Level by level, only the children of nodes with
    more words are counted."""
    out: list[tuple[int, ...]] = []
    total = words.count()
    open_ = [()] if total > most else []
    if not open_ and total:
        out.append(())
    spark = words.sparkSession
    for depth in range(1, len(GROUPS) + 1):
        if not open_:
            break
        large = spark.createDataFrame([(list(p),) for p in open_], "prefix array<int>")
        found = words.select(F.slice("counts", 1, depth).alias("node"), F.slice("counts", 1, depth - 1).alias("prefix")) \
            .join(F.broadcast(large), "prefix", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect()
        open_ = [tuple(r.node) for r in found if r.n > most and depth < len(GROUPS)]
        out += [tuple(r.node) for r in found if r.n <= most or depth == len(GROUPS)]
    return sorted(out)


def near_words(words: DataFrame, most: int = SUBTREE) -> DataFrame:
    """word, n_near, best (minus its n, word): a row for each word and node with near words."""

    def with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("word", "n")),
                                              pa.array([vector(w) for w in batch.column("word").to_pylist()], pa.list_(pa.int32()))], ["word", "n", "counts"])

    known = materialize(words.select("word", "n").mapInArrow(with_vectors, "word string, n bigint, counts array<int>"), "variant-words")
    nodes = cut_nodes(known, most)
    top = known.sparkSession.sparkContext.broadcast(nodes)

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A word's own node (no budget named), and each node that it can reach."""
        trie = Trie()
        for i, node in enumerate(top.value):
            trie.add(node, i)
        for batch in batches:
            at, own, left, source = [], [], [], []
            for i, counts in enumerate(batch.column("counts").to_pylist()):
                for (node,), s, d in trie.search(counts, 1, 1):
                    at.append(node)
                    own.append(s and d)  # nothing spent: the word's own path
                    left.append(2 * s + d)
                    source.append(i)
            rows = batch.take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([bool(x) for x in own], pa.bool_()), pa.array(left, pa.int8()),
                                              rows.column("word"), rows.column("n")], ["node", "own", "budget", "word", "n"])

    routed = known.mapInArrow(routes, "node int, own boolean, budget byte, word string, n bigint")

    def search(part: pd.DataFrame) -> pd.DataFrame:
        depth = len(top.value[int(part["node"].iloc[0])])
        trie = Trie()
        indexed = part[part["own"]]
        for word, n in zip(indexed["word"], indexed["n"], strict=True):
            trie.add(vector(word)[depth:], (-n, word))
        out = []
        for word, budget in zip(part["word"], part["budget"], strict=True):
            number, best = 0, None
            for leaf, _, _ in trie.search(vector(word)[depth:], budget >> 1, budget & 1):
                for entry in leaf:
                    if one_edit(word, entry[1]):
                        number += 1
                        if best is None or entry < best:
                            best = entry
            if best is not None:
                out.append((word, number, best[0], best[1]))
        return pd.DataFrame(out, columns=["word", "n_near", "minus_n", "near"])

    return routed.groupBy("node").applyInPandas(search, "word string, n_near bigint, minus_n bigint, near string")


def roots_of(forms: DataFrame, longest: int) -> DataFrame:
    """word, root: the last word over forms (word, form). A chain has at most
    ``longest`` links, and each step doubles what a row has passed. No form is
    hot: a word has few near words, whatever the table's size."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    passed = 1
    while passed < longest:
        on = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        now = materialize(now.join(on, F.col("root") == F.col("_word"), "left")
                          .select("word", F.coalesce("_root", "root").alias("root")), "variant-roots")
        passed *= 2
    return now


def group_words(words: DataFrame, times: int = 5, most: int = SUBTREE) -> DataFrame:
    """word, n, n_near, form, form_n, root for every row of ``words`` (word, n; words distinct).

    Words are near if exactly one inserted, deleted or replaced code point
    makes them equal. A word's form is its near word of largest n (ties: the
    smallest in code-point order) if that is at least ``times`` its own n, else
    null; root follows forms to the last and is the word itself without one. An
    empty table gives no rows; null words are left out.
    """
    words = materialize(words.where("word is not null").select("word", "n"), "variant-counts")
    found = near_words(words, most)
    nothing = [F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<minus_n:bigint,near:string>").alias("best")]
    every = words.select("word", "n", *nothing).unionByName(
        found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", F.struct("minus_n", "near").alias("best")))
    near = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.minus_n") >= times * F.col("n")
    named = materialize(near.select("word", "n", "n_near", F.when(is_form, F.col("best.near")).alias("form"),
                                    F.when(is_form, -F.col("best.minus_n")).alias("form_n")), "variant-forms")
    top, links = named.agg(F.max("n")).first()[0] or 1, 1
    while times ** links <= top:  # n grows ``times``-fold with each link
        links += 1
    return named.join(roots_of(named.where("form is not null"), links), "word", "left") \
        .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int | None = 199, times: int = 5,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`group_words` of the words of all whole texts (:func:`count_words`)
    with at least ``least_length`` letters and ``least_count`` occurrences.

    Null and empty texts have no words; a run of any length is a word. Repeated
    rows count again. Columns other than id and text are not read.
    """
    return group_words(count_words(docs, least_length, least_count, every, id_col, text_col), times)

"""Scoring by Brown class-based bigrams.

Words have classes; the chance of a word is that of its class after the class
of the word before, times that of the word within its class. Classes come from
exchange clustering:

1. the SEEDS most frequent words are clustered by exchange (each word moves to
   the class that raises the likelihood of the class bigrams most, until none
   moves) from their bigram counts, a bounded matrix;
2. every other training word goes to the class that does so given the seeds'
   classes, by counts of the classes to its left and right; words are dealt out
   over tasks for this, and their classes stay in a table;
3. words that training lacks get the class that training words with the same
   ending mostly have (three bytes, else two, else one).

Counts and classes of the HEAD most frequent words are sent to all tasks, and
rarer words meet theirs in a join, in which no word is hot. Texts are read once
for their paths of classes, from which transitions and scores follow.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import in_fold, small_side, string_bytes, text_pieces

CLASSES = 32  # besides that of text ends
SEEDS = 1024
HEAD = 131072
ROUNDS = 12  # of exchange over the seeds
BLOCK = 2048  # words of one array of the exchange step
HELD = 600_000  # counts of (word, neighbour class) that a task holds before it hands them on
PATH_BYTES = 1 << 20  # of paths (a byte a token) that a task works on at once
HOLE = 255  # in a path: a word whose class comes from the join
SMOOTH = 20.0  # weight of the class unigram in a class transition, in counts
PARTIAL = 400_000  # words that a counting task holds before it hands them on
END = b""  # the token after the last word; no word is empty


def words_of(text: str) -> list[bytes]:
    """Words, A-Z lower-cased, parted by ASCII white space."""
    return text.encode().lower().split()


def coded_words(column: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """:func:`words_of` all texts of a column at once: the words end to end as
    places in a list of distinct words, that list, and the words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.cast(pa.string()).fill_null("")))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().cast(pa.binary()).dictionary_encode()
    codes, kinds = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    if b"" in kinds:  # before white space that begins a text, behind white space that ends it
        empty = kinds.index(b"")
        full = codes != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
        codes = codes[full]
        codes -= codes > empty
        del kinds[empty]
    return codes, kinds, sizes


def with_ends(row: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """Texts of ``sizes`` values end to end, with an end before the first and after each."""
    return np.concatenate([[end], np.insert(row, np.cumsum(sizes), end)])


def count_words(texts: DataFrame) -> DataFrame:
    """word (binary), n over all texts, ends included; summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in text_pieces(batch):
                codes, kinds, _ = coded_words(part.column("text"))
                found.update(dict(zip(kinds, np.bincount(codes, minlength=len(kinds)).tolist(), strict=True)))
                found[END] += part.num_rows
                if len(found) > PARTIAL:
                    yield handed()
                    found.clear()
        if found:
            yield handed()

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def exchange(bigrams: np.ndarray, classes: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of words 0..len(classes)-1 after exchange. ``bigrams`` counts
    (word, next word); further rows and columns are words with fixed classes
    (k and above, one each)."""
    n, full = len(classes), len(bigrams)
    own = np.concatenate([classes, k + np.arange(full - n)])
    size = k + full - n
    left, right = np.zeros((full, size)), np.zeros((full, size))  # of each word: by the next word's class, by the last word's
    for c in range(size):
        left[:, c] = bigrams[:, own == c].sum(axis=1)
        right[:, c] = bigrams[own == c].sum(axis=0)
    table = np.zeros((size, size))
    np.add.at(table, own, left)
    for _ in range(rounds):
        moved = 0
        for w in range(n):
            old, own_pair = own[w], bigrams[w, w]
            out, into = left[w].copy(), right[w].copy()
            out[old] -= own_pair
            into[old] -= own_pair
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= own_pair
            new = best_class(table, out, into, own_pair, k)
            table[new] += out
            table[:, new] += into
            table[new, new] += own_pair
            if new != old:
                moved += 1
                own[w] = new
                for m, counts in ((left, bigrams[:, w]), (right, bigrams[w])):
                    m[:, old] -= counts
                    m[:, new] += counts
        if not moved:
            break
    return own[:n]


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(table: np.ndarray, out: np.ndarray, into: np.ndarray, own: float, k: int) -> int:
    """The class (of the first k) that gives class bigrams ``table`` the
    highest likelihood with a word of which ``out`` counts the classes after
    and ``into`` those before it, and ``own`` the pairs of itself."""
    rows, cols = (table.sum(axis=1) + into)[:k], (table.sum(axis=0) + out)[:k]  # the words around it keep their classes
    gain = (_h(table[:k] + out) - _h(table[:k])).sum(axis=1) + (_h(table[:, :k] + into[:, None]) - _h(table[:, :k])).sum(axis=0)
    at = np.arange(k)  # the cell (c, c) changes in both and by the word's own pairs
    cell = table[at, at]
    gain += _h(cell + out[:k] + into[:k] + own) - _h(cell + out[:k]) - _h(cell + into[:k]) + _h(cell)
    mass = out.sum() + own, into.sum() + own
    gain -= _h(rows + mass[0]) - _h(rows) + _h(cols + mass[1]) - _h(cols)
    return int(gain.argmax())


def best_classes(table: np.ndarray, out: np.ndarray, into: np.ndarray, k: int) -> np.ndarray:
    """``best_class`` of many words (rows of ``out`` and ``into``, none empty) without pairs of themselves."""
    def change(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
        word, place = np.nonzero(counts)
        old = cells[:, place].T
        return np.add.reduceat(_h(old + counts[word, place][:, None]) - _h(old), np.searchsorted(word, np.arange(len(counts))), axis=0)

    gain = change(table[:k], out) + change(table[:, :k].T, into)
    rows, cols = table.sum(axis=1)[:k] + into[:, :k], table.sum(axis=0)[:k] + out[:, :k]
    cell = np.diagonal(table)[:k]
    gain += _h(cell + out[:, :k] + into[:, :k]) - _h(cell + out[:, :k]) - _h(cell + into[:, :k]) + _h(cell)
    gain -= _h(rows + out.sum(axis=1, keepdims=True)) - _h(rows) + _h(cols + into.sum(axis=1, keepdims=True)) - _h(cols)
    return gain.argmax(axis=1)


class Ids(dict):
    """Number of each word; words not in the list are numbered ``rest``."""

    def __init__(self, words: list[bytes], rest: int):
        super().__init__((w, i) for i, w in enumerate(words))
        self.rest = rest

    def __missing__(self, word: bytes) -> int:
        return self.rest


def seed_bigrams(texts: DataFrame, seeds: list[bytes]) -> np.ndarray:
    """Counts of (word, next word) with the seeds first, then one place for other words and one for the end."""
    n = len(seeds) + 2
    sent = texts.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, table = Ids(sent.value, n - 2), np.zeros(n * n, np.int64)
        for batch in batches:
            for part in text_pieces(batch):
                codes, kinds, sizes = coded_words(part.column("text"))
                row = with_ends(np.array([ids[w] for w in kinds], np.int64)[codes], sizes, n - 1)
                table += np.bincount(row[:-1] * n + row[1:], minlength=n * n)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], ["pair", "n"])

    rows = texts.select("text").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(n * n)
    table[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return table.reshape(n, n)


class Numbers(dict):
    """Number of each word in the order in which words are met, after ``first``."""

    def __init__(self, first: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(first))

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def assign_others(texts: DataFrame, seeds: list[bytes], seed_classes: np.ndarray, table: np.ndarray) -> DataFrame:
    """word, n and class of every word but the seeds, by one exchange step.
    ``table``: class bigrams, with a class for all words without one and one
    for the end. Tasks sum a word's neighbour classes (those after it, then
    those before it) and hand them on as pairs of place and count."""
    context = CLASSES + 2
    sent = texts.sparkSession.sparkContext.broadcast((seeds, seed_classes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, classes = sent.value
        n, class_of = len(first), np.concatenate([classes, [CLASSES, CLASSES + 1]])  # -1 is the end
        ids, held = Numbers(first), []

        def handed() -> Iterator[pa.RecordBatch]:
            key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            times = np.bincount(at, np.concatenate([c for _, c in held])).astype("<i4")
            word, place = np.divmod(key, 2 * context)
            edges = np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word)).astype(np.int32)
            words = list(ids)[n:]  # each has a count
            for i in range(0, len(words), 20000):
                cut = edges[i:i + 20001]
                sizes = cut - cut[0]
                yield pa.RecordBatch.from_arrays([pa.array(words[i:i + 20000], pa.binary()), *(
                    pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(sizes * width), pa.py_buffer(values[cut[0]:cut[-1]].tobytes())])
                    for values, width in ((place.astype(np.uint8), np.int32(1)), (times, np.int32(4))))], ["word", "places", "times"])

        for batch in batches:
            for part in text_pieces(batch):
                codes, kinds, sizes = coded_words(part.column("text"))
                row = with_ends(np.array([ids[w] for w in kinds], np.int64)[codes], sizes, -1)
                around = class_of[np.minimum(row, n)]
                at = np.flatnonzero(row >= n)
                if len(at):
                    base = (row[at] - n) * (2 * context)
                    held.append(np.unique(np.concatenate([base + around[at + 1], base + context + around[at - 1]]), return_counts=True))
                if len(ids) - n > PARTIAL or sum(len(k) for k, _ in held) > HELD:
                    yield from handed()
                    ids, held = Numbers(first), []
        if held:
            yield from handed()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(words: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
            best = [best_classes(table, c[:, :context], c[:, context:], CLASSES) for c in (counts[i:i + BLOCK] for i in range(0, len(counts), BLOCK))]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts[:, :context].sum(axis=1).astype(np.int64)),
                                               pa.array(np.concatenate(best), pa.int32())], ["word", "n", "class"])

        words: list[bytes] = []
        last = np.zeros((0, 2 * context))  # the last word's counts, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("word").dictionary_encode()
            places, sizes = string_bytes(batch.column("places"))
            times = np.frombuffer(string_bytes(batch.column("times"))[0].tobytes(), "<i4")
            key = np.repeat(coded.indices.to_numpy().astype(np.int64), sizes) * (2 * context) + places
            new = coded.dictionary.to_pylist()
            counts = np.bincount(key, times, len(new) * 2 * context).reshape(-1, 2 * context)
            if words and words[0] == new[0]:
                counts[0] += last[0]
            elif words:
                new, counts = words + new, np.concatenate([last, counts])
            if len(new) > 1:
                yield judged(new[:-1], counts[:-1])
            words, last = new[-1:], counts[-1:].copy()
        if words:
            yield judged(words, last)

    return texts.select("text").mapInArrow(count, "word binary, places binary, times binary") \
        .repartition("word").sortWithinPartitions("word").mapInArrow(step, "word binary, n bigint, class int")


def most_frequent(counts: DataFrame, most: int, name: str, ties: bool) -> DataFrame:
    """Rows of ``counts`` (word, n, ...) with the largest n, written once: those
    above the count at which they would be more than ``most``, or with ``ties``
    exactly ``most`` of them, in the words' order. The count is found in the
    table of how many words have which n, so what a task sends on does not
    depend on how many tasks there are; the caller may read the result whole."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("_k"))
    upto = sizes.withColumn("_upto", F.sum("_k").over(Window.orderBy(F.desc("n"))))
    inside = F.col("_upto") - F.col("_k") < most if ties else F.col("_upto") <= most
    least = upto.where(inside).agg(F.min("n")).first()[0]
    rows = counts.where(F.lit(False) if least is None else F.col("n") >= least)
    return materialize(rows.orderBy(F.desc("n"), "word").limit(most) if ties else rows, name)


def train(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """word, n and class of every word of ``texts``."""
    spark = texts.sparkSession
    schema = "word binary, n bigint, class int"
    top = most_frequent(vocabulary.where(F.octet_length("word") > 0), SEEDS, "seeds", ties=True).toPandas() \
        .sort_values(["n", "word"], ascending=[False, True])
    seeds, n = [bytes(w) for w in top["word"]], len(top)
    if not n:
        return spark.createDataFrame([], schema)
    bigrams = seed_bigrams(texts, seeds)
    classes = exchange(bigrams, np.arange(n) % CLASSES, CLASSES)
    own = np.concatenate([classes, [CLASSES, CLASSES + 1]])
    table = np.zeros((CLASSES + 2, CLASSES + 2))
    np.add.at(table, (own[:, None], own[None, :]), bigrams)
    first = spark.createDataFrame(list(zip(seeds, top["n"].tolist(), classes.tolist(), strict=True)), schema)
    return materialize(assign_others(texts, seeds, classes, table).unionByName(first), "word-classes")


def ending(size: int) -> Column:
    """The last bytes of a word, all of a shorter one."""
    return F.substring("word", -size, size)


def endings(classes: DataFrame) -> DataFrame:
    """ending (of one to three bytes) and the class that most tokens with it have, the first of equals."""
    return classes.select(F.explode(F.array_distinct(F.array(*map(ending, (1, 2, 3))))).alias("ending"), "class", "n") \
        .groupBy("ending", "class").agg(F.sum("n").alias("votes")) \
        .groupBy("ending").agg(F.max_by("class", F.struct("votes", -F.col("class"))).alias("class"))


def with_classes(words: DataFrame, classes: DataFrame, usual: int) -> DataFrame:
    """``words`` (with a column word) with n in training, 0 if unseen, and class."""
    out = words.join(classes, "word", "left")
    by_ending = small_side(endings(classes), "endings")
    for size in (3, 2, 1):
        side = by_ending.select(F.col("ending").alias(f"_end{size}"), F.col("class").alias(f"_class{size}"))
        out = out.join(side, ending(size) == F.col(f"_end{size}"), "left").drop(f"_end{size}")
    found = F.coalesce("class", "_class3", "_class2", "_class1", F.lit(usual))
    return out.select(*words.columns, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), found.alias("class"))


def path_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Classes of texts end to end, an end before the first and after each, and tokens of each text."""
    raw, lengths = string_bytes(column)
    return np.concatenate([[CLASSES], np.insert(raw, np.cumsum(lengths), CLASSES)]).astype(np.int64), lengths + 1


def transitions(paths: DataFrame) -> np.ndarray:
    """Counts of (class, next class) over all texts; a text begins after an end."""
    size = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64)
        for batch in batches:
            for part in text_pieces(batch, "path", PATH_BYTES):
                row, _ = path_of(part.column("path"))
                table += np.bincount(row[:-1] * size + row[1:], minlength=size * size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(table)], ["pair", "n"])

    rows = paths.select("path").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(size * size)
    table[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return table.reshape(size, size)


def score_texts(docs: DataFrame, folds: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the texts outside the held-out fold and score all whole texts.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens
    seen in training), train_tokens, base_score (add-one unigrams), score, and
    perplexity (10 ** (-score / n_tokens)). Both scores are log10 chances and
    give all unseen words of a class (base: all unseen words) one share:

    P(word | last) = P(class | last class) * (c + 1) / (tokens of class + words of class + 1)

    A null text is empty: one end. A row with a null id is never held out.
    Repeated rows count as often as they occur and have equal results. Without
    training texts the counts are 0 and scores follow from the formulas. Other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       in_fold(id_col, folds, held).alias("held_out"))
    texts = rows.where(~F.col("held_out")).select("text")
    vocabulary = materialize(count_words(texts), "vocabulary")
    total, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = vocabulary.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    classes = train(texts, vocabulary)
    tokens, own_kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)  # of each class
    for c, n, k in classes.groupBy("class").agg(F.sum("n"), F.count(F.lit(1))).collect():
        tokens[c], own_kinds[c] = n, k
    usual = int(tokens.argmax())
    tokens[CLASSES], own_kinds[CLASSES] = ends, ends > 0
    top = most_frequent(classes, HEAD, "head", ties=False).toPandas().sort_values(["n", "word"], ascending=[False, True])
    head = spark.sparkContext.broadcast(([bytes(w) for w in top["word"]], top["n"].to_numpy(np.int64), top["class"].to_numpy(np.uint8)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, own_classes = head.value
        ids, rare = Ids(words, len(words)), len(words)
        class_of, log_n = np.append(own_classes, np.uint8(HOLE)), np.append(np.log10(counts + 1.0), 0.0)
        for batch in batches:
            for part in text_pieces(batch):
                out: list[list] = [[] for _ in range(5)]
                codes, kinds, sizes = coded_words(part.column("text"))
                places = np.array([ids[w] for w in kinds], np.int64)
                for own in np.split(codes, np.cumsum(sizes)[:-1]):
                    at = places[own]
                    tail, holes = np.unique(own[at == rare], return_inverse=True)
                    for values, v in zip(out, (len(own) - len(holes) + (ends > 0), float(log_n[at].sum() + np.log10(ends + 1.0)),
                                               class_of[at].tobytes(), holes.astype("<i4").tobytes(), [kinds[i] for i in tail]), strict=True):
                        values.append(v)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.float64()),
                    pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.list_(pa.binary()))],
                    ["doc_id", "held_out", "n_head", "log_counts", "path", "holes", "tail"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch, "path", PATH_BYTES):
                out: list[list] = [[] for _ in range(3)]
                for n_head, known, raw, holes, c, n in zip(*(part.column(x).to_pylist() for x in (
                        "n_head", "log_counts", "path", "holes", "classes", "counts")), strict=True):
                    path, at, n = np.frombuffer(raw, np.uint8).copy(), np.frombuffer(holes, "<i4"), np.array(n, np.int64)
                    path[path == HOLE] = np.array(c, np.uint8)[at]
                    for values, v in zip(out, (n_head + int((n[at] > 0).sum()), known + float(np.log10(n[at] + 1.0).sum()), path.tobytes()), strict=True):
                        values.append(v)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(out[0], pa.int64()),
                                                  pa.array(out[1], pa.float64()), pa.array(out[2], pa.binary())],
                                                 ["doc_id", "held_out", "n_known", "log_counts", "path"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    begun = materialize(rows.mapInArrow(
        read, f"doc_id {kind}, held_out boolean, n_head bigint, log_counts double, path binary, holes binary, tail array<binary>")
        .withColumn("_row", F.monotonically_increasing_id()), "paths-begun")
    tail = with_classes(begun.select("_row", F.posexplode("tail").alias("at", "word")), classes, usual)
    met = tail.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("at", "class", "n"))).alias("met")) \
        .select("_row", F.col("met.class").alias("classes"), F.col("met.n").alias("counts"))
    paths = materialize(begun.drop("tail").join(met, "_row", "left").drop("_row")
                        .withColumns({"classes": F.coalesce("classes", F.array().cast("array<int>")), "counts": F.coalesce("counts", F.array().cast("array<bigint>"))})
                        .mapInArrow(fill, f"doc_id {kind}, held_out boolean, n_known bigint, log_counts double, path binary"), "paths")
    pairs = transitions(paths.where(~F.col("held_out")))
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + CLASSES + 1)
    moves = np.log10((pairs + SMOOTH * share) / (pairs.sum(axis=1, keepdims=True) + SMOOTH))
    moves -= np.log10(tokens + own_kinds + 1)  # below a word's count, of its chance in its class

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch, "path", PATH_BYTES):
                row, sizes = path_of(part.column("path"))
                rest = np.add.reduceat(moves[row[:-1], row[1:]], np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "held_out", "n_known", "log_counts")),
                                                  pa.array(sizes.astype(np.int64)), pa.array(rest)],
                                                 ["doc_id", "held_out", "n_known", "log_counts", "n_tokens", "log_rest"])

    base_below = float(np.log10(total + kinds + 1))
    return paths.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_known bigint, log_counts double, n_tokens bigint, log_rest double").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(base_below)).alias("base_score"),
        (F.col("log_counts") + F.col("log_rest")).alias("score")).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))

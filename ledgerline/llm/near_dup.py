"""Near duplicates: MinHash candidates with sequential Bayesian verification.

A document is its set of word shingles. Documents with equal sets form a class
with one representative, so copies are never compared with each other. Bands
of the representatives' MinHash signatures give candidate pairs. The
signatures of a pair are compared batch by batch; with m of n hashes equal and
a uniform prior, the similarity is Beta(m + 1, n - m + 1) distributed, and a
pair whose posterior chance of reaching the threshold falls below the miss
probability is dropped. Survivors are verified on their full sets.

Pairs within a bucket are not all compared: each member meets the bucket's
centre, the one that shares buckets with the most others. Where the members of
a centre still lie in different components, links between them are found as
follows. Of x and y, each with a known overlap with the centre, the common
shingles are at most min(overlap of x, overlap of y) plus the common ones among
those that the centre lacks, and a link needs a share of the sum of their
sizes. So either the overlaps alone suffice, which few pairs across components
pass, or x and y share a number of shingles that the centre lacks; with the
rarest first, all but the last ones of each, one fewer than that number, must
then have one in common (prefix filter), and that is a join on shingles. No
link that would join components is left out, and no pairs of a whole group are
made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_side, text_pieces

BANDS = 28
ROWS = 5
BATCH = 28  # hashes compared at a time
MISS = 1e-6  # posterior chance of a link below which a pair is dropped
CACHE = 100_000  # words of at most CACHED bytes whose hashes a task remembers
CACHED = 64
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered for CACHE short ones at most."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED and len(self) < CACHE:
            self[word] = h
        return h


class Shingler:
    """64-bit hashes of the distinct shingles of ``n`` words, sorted."""

    def __init__(self, n: int):
        self.n, self.cache = n, WordHashes()

    def words(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if len(self.cache) >= CACHE:
            self.cache.clear()
        return np.fromiter(map(self.cache.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str) -> np.ndarray:
        words = self.words(text)
        if not len(words):
            return words
        size = min(self.n, len(words))
        h = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            h = (h ^ words[i:len(words) - size + 1 + i]) * _SPREAD
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(h ^ (h >> np.uint64(32)))


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """MinHash of each set (none empty), a column each of ``hashes``."""
    rng = np.random.RandomState(11)
    factors = rng.randint(0, 1 << 31, hashes).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.randint(0, 1 << 32, hashes, dtype=np.uint64).astype(np.uint32)
    out = np.empty((len(sets), hashes), np.uint32)
    if not sets:
        return out
    flat = np.concatenate(sets)
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    for k in range(hashes):
        mixed = low * factors[k] + high * shifts[k]
        mixed ^= mixed >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(mixed, starts)
    return out


def least_matches(hashes: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, least number of equal hashes among the first n to go on), batch by
    batch. The chance that Beta(m + 1, n - m + 1) reaches the threshold is that
    of at most m successes in n + 1 trials at the threshold."""
    out = []
    for n in [*range(batch, hashes, batch), hashes]:
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def profile(docs: DataFrame, id_col: str, text_col: str, shingle: int, hashes: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit hash of the set; null if empty), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        cut = Shingler(shingle)
        for batch in batches:
            for part in text_pieces(batch):
                sets = [cut(t) for t in part.column("text").to_pylist()]
                rows = iter(signatures([s for s in sets if len(s)], hashes))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "signature"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, signature binary")


def band_rows(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """bucket, node: one row a band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("node").to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(len(ids), -1)
                for band in range(bands):
                    key = np.full(len(ids), band + 1, np.uint64)
                    for i in range(band * rows, band * rows + rows):
                        key = (key ^ sig[:, i]) * _SPREAD
                        key ^= key >> np.uint64(31)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids, pa.int64())], ["bucket", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "bucket bigint, node bigint")


def ends(pairs: DataFrame, name: str) -> DataFrame:
    """Distinct nodes of pairs (a, b), to thin out a table before it is shuffled."""
    return small_side(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), name)


def likely(pairs: DataFrame, nodes: DataFrame, percent: int, batch: int, miss: float) -> DataFrame:
    """Pairs (a, b) that sizes and signatures do not rule out."""
    nodes = nodes.join(ends(pairs, "pair-ends"), "node", "left_semi")
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("_na"), F.col("signature").alias("_sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("_nb"), F.col("signature").alias("_sb"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(part.num_rows, -1) for c in ("_sa", "_sb"))
            left, equal, done = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64), 0
            for n, least in least_matches(one.shape[1], batch, percent / 100, miss):
                equal = equal + (one[left, done:n] == two[left, done:n]).sum(axis=1)
                left, equal, done = left[equal >= least], equal[equal >= least], n
            yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(left)) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "_sa", "_sb").mapInArrow(run, "a bigint, b bigint").distinct()


def with_sets(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Pairs (a, b, ...) with their full sets _a, _b, cut from the texts of the documents that are in a pair."""

    def cut_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingler(shingle)
        for batch in batches:
            for part in text_pieces(batch):
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([cut(t).tobytes() for t in part.column("text").to_pylist()], pa.binary())],
                                                 ["node", "set"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).cast("string").alias("text")).where("text is not null") \
        .join(ends(pairs, "set-ends"), "node", "left_semi")
    sets = materialize(texts.mapInArrow(cut_sets, "node bigint, set binary").where(F.octet_length("set") > 0), "sets")
    return pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("_a")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("_b")), "b")


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("_a"), batch.column("_b"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    return with_sets(pairs, docs, id_col, text_col, shingle).select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint").distinct()


def across(met: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one centre in different components that may be linked.

    ``met``: centre, node. With sizes s, overlaps o with the centre, and q =
    percent / (100 + percent), a link has q * (s of x + s of y) common shingles
    at least, so x must share ``need`` = q * (s of x + least s in the group) - o
    shingles that the centre lacks, or none if that is not positive.
    """
    named = met.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")) \
        .join(nodes.select("node", "n_shingles"), "node")
    named = materialize(named, "named")
    spread = named.groupBy("centre").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.min("n_shingles").alias("least")) \
        .where("_lo <> _hi").select("centre", "least")
    sizes = named.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("_n"))
    main = sizes.groupBy("centre").agg(F.max(F.struct("_n", "component")).alias("_m")).select("centre", F.col("_m.component").alias("main"))
    open_ = materialize(named.join(spread, "centre").join(main, "centre")
                        .select("centre", "node", "component", "least", (F.col("component") == F.col("main")).alias("in_main")), "open")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            overlaps, lengths, others, firsts = [], [], [], []
            for one, two, least in zip(batch.column("_a"), batch.column("_b"), batch.column("least").to_pylist(), strict=True):
                centre, own = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                other = np.setdiff1d(own, centre, assume_unique=True)
                overlap = len(own) - len(other)
                need = -(-percent * (len(own) + least) // (100 + percent)) - overlap
                overlaps.append(overlap)
                lengths.append(len(own))
                first = max(0, len(other) - max(need, 1) + 1)
                others.append(other.view(np.int64) if first else [])
                firsts.append(first)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "component", "least", "in_main")), pa.array(overlaps, pa.int64()),
                                              pa.array(lengths, pa.int64()), pa.array(others, pa.list_(pa.int64())), pa.array(firsts, pa.int64())],
                                             ["centre", "node", "component", "least", "in_main", "overlap", "size", "others", "first"])

    known = with_sets(open_.withColumnsRenamed({"centre": "a", "node": "b"}), docs, id_col, text_col, shingle) \
        .select("a", "b", "component", "least", "in_main", "_a", "_b").mapInArrow(
            compare, "centre bigint, node bigint, component bigint, least bigint, in_main boolean, overlap bigint, size bigint, others array<bigint>, first bigint")
    known = materialize(known, "overlaps")
    apart = (F.col("x.component") != F.col("y.component")) & (F.col("y.in_main") | (F.col("x.node") < F.col("y.node")))
    pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    # Members that can be linked without a shingle that the centre lacks: few of them are outside the main component.
    near = known.where(F.col("overlap") * (100 + percent) >= (F.col("size") + F.col("least")) * percent).drop("others", "first")
    enough = F.least("x.overlap", "y.overlap") * (100 + percent) >= (F.col("x.size") + F.col("y.size")) * percent
    by_centre = near.where("not in_main").alias("x").join(near.alias("y"), (F.col("x.centre") == F.col("y.centre")) & apart & enough).select(*pair)
    parts = known.select("centre", "node", "component", "in_main", "overlap", "size", "first", F.explode("others").alias("shingle"))
    # The order that the first ones are taken in: rarest in the group first.
    held = parts.groupBy("centre", "shingle").agg(F.count(F.lit(1)).alias("held"))
    rank = F.row_number().over(Window.partitionBy("centre", "node").orderBy("held", "shingle"))
    parts = materialize(parts.join(held, ["centre", "shingle"]).withColumn("_rank", rank)
                        .where("_rank <= first and held > 1").drop("_rank", "held", "first"), "parts")
    beside = F.least(F.col("x.size") - F.col("x.overlap"), F.col("y.size") - F.col("y.overlap"))  # common shingles that the centre lacks, at most
    possible = (F.least("x.overlap", "y.overlap") + beside) * (100 + percent) >= (F.col("x.size") + F.col("y.size")) * percent
    by_shingle = parts.where("not in_main").alias("x").join(
        parts.alias("y"), (F.col("x.centre") == F.col("y.centre")) & (F.col("x.shingle") == F.col("y.shingle")) & apart & possible).select(*pair)
    return by_centre.unionByName(by_shingle).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of ``links``
    (a, b), by alternating large-star and small-star steps. Each step is two
    grouped minima and a join; the edges are written after every round."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        # Large star: a node's larger neighbours move to its smallest neighbour.
        either = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = either.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = either.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = moved.groupBy("u").agg(F.min("v").alias("m"))
        down = moved.join(least, "u")
        moved = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))) \
            .where("u <> v").distinct()
        edges = materialize(moved, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint")), F.sum(F.crc32(F.concat_ws(",", "u", "v")))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now


def find_components(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, rows: int = ROWS, batch: int = BATCH, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Words are lower-cased (A-Z) and parted by ASCII white space; a text with
    fewer words than ``shingle`` is one shingle. Documents are linked if their
    sets' Jaccard similarity is ``percent`` / 100 or more; component_id is the
    smallest id reachable over links, and kept tells whether it is the row's
    own. A pair at the very threshold shares no band with a chance of
    (1 - (percent / 100) ** rows) ** bands, 1.5e-5 with the defaults.

    Null and empty texts have no shingles and no links. Rows with a null id
    have no links, a null component_id, and are kept. Repeated rows, and rows
    that share an id, are one document (linked if any of them is). The id must
    be an integer; other columns are not read.
    """
    rows_of = materialize(profile(docs, id_col, text_col, shingle, bands * rows), "profiles")
    classes = materialize(rows_of.where("doc_id is not null and set_key is not null").groupBy("set_key")
                          .agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("_c"))
                          .select("set_key", F.col("_c.doc_id").alias("node"), "_c.n_shingles", "_c.signature"), "classes")
    members = band_rows(classes, bands, rows)
    # Buckets with one member, most of them, end here.
    many = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(members.join(many, "bucket"), "buckets")
    # The member with the most company over all its buckets is the likeliest to be near the rest.
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    members = members.join(company, "node")
    centres = members.groupBy("bucket").agg(F.max(F.struct("company", (-F.col("node")).alias("minus"))).alias("_c")) \
        .select("bucket", (-F.col("_c.minus")).alias("centre"))
    met = materialize(members.join(centres, "bucket").where("node <> centre").select("centre", "node").distinct(), "met")

    def check(pairs: DataFrame) -> DataFrame:
        kept = materialize(likely(pairs, classes, percent, batch, miss), "likely")
        return materialize(verified(kept, docs, id_col, text_col, shingle, percent), "links")

    links = check(met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    labels = materialize(components(links), "labels")
    rest = materialize(across(met, labels, classes.groupBy("node").agg(F.min("n_shingles").alias("n_shingles")),
                              docs, id_col, text_col, shingle, percent), "across")
    labels = materialize(components(links.unionByName(check(rest))), "labels")

    return rows_of.select("doc_id", "n_shingles", "set_key").join(classes.select("set_key", "node"), "set_key", "left") \
        .join(labels, "node", "left").withColumn("_id", F.coalesce("component", "node", "doc_id")) \
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("_id")).alias("component_id"),
                F.coalesce(F.col("doc_id") == F.col("_id"), F.lit(True)).alias("kept"))

"""Exact deduplication by content-defined chunk recipes.

A text (lower-cased, A-Z only) is cut where a rolling hash of its last 32 bytes
says so, so equal texts have equal chunks. Its recipe is the list of its
chunks' digests. A list that no other row has proves that its text occurs once,
as equal texts have equal lists; only rows with a shared list go on. Their
chunks are deduplicated by their bytes into a store, in which a digest with
more than one content shows itself, and each content of such a digest has a
number. Digest and number are a chunk's verified identifier. Rows are equal if
their lists of identifiers are; from here on lists alone are moved, not texts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_side, text_pieces

LEAST, MOST = 256, 8192  # bytes of a chunk; the last one of a text may be shorter
CUT_BITS = 10  # a place is a cut with a chance of 2 ** -CUT_BITS
SPAN = 32  # bytes that decide whether a place is a cut, at most LEAST
DIGEST_BYTES = 8
BLOCK = 1 << 20  # bytes whose rolling hashes are held at once

_GEAR = np.random.RandomState(13).randint(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def cut_places(raw: bytes) -> list[int]:
    """Ends of possible chunks: the rolling hash of the SPAN bytes before has
    its leading bits zero. Sums over 1, 2, 4, ... bytes are doubled up to SPAN."""
    out: list[np.ndarray] = []
    data = np.frombuffer(raw, np.uint8)
    for start in range(0, len(data), BLOCK):
        first = max(0, start - SPAN + 1)
        h = _GEAR[data[first:start + BLOCK]]
        step = 1
        while step < SPAN:
            longer = h.copy()
            longer[step:] += h[:-step] << np.uint32(step)
            h, step = longer, step * 2
        at = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + first + 1
        out.append(at[at > start])
    return np.concatenate(out).tolist() if out else []


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text: the first possible place that leaves LEAST
    bytes, or MOST bytes on where there is none before."""
    places, ends, start = cut_places(raw), [], 0
    while start < len(raw):
        i = bisect_left(places, start + LEAST)
        end = min(start + MOST, len(raw), places[i] if i < len(places) else len(raw))
        ends.append(end)
        start = end
    return ends


def digests_of(raw: bytes, ends: list[int], width: int) -> list[bytes]:
    import xxhash
    return [xxhash.xxh3_64_digest(raw[a:b])[:width] for a, b in zip([0, *ends], ends, strict=False)]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .withColumn("raw_hash", F.xxhash64("text"))


def digest_lists(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, raw_hash, digests (of the chunks, end to end), text_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch):
                lists, hashes = [], []
                for text in part.column("text").to_pylist():
                    raw = text.encode().lower()  # of bytes: A-Z alone
                    lists.append(b"".join(digests_of(raw, chunk_ends(raw), width)))
                    hashes.append(hashlib.sha256(raw).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("raw_hash"), pa.array(lists, pa.binary()), pa.array(hashes, pa.string())],
                                                 ["doc_id", "raw_hash", "digests", "text_sha256"])

    return rows.mapInArrow(run, "doc_id bigint, raw_hash bigint, digests binary, text_sha256 string")


def chunked(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, digests, text_sha256, chunks (digest, content) of each row."""
    chunk = pa.struct([("digest", pa.binary()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch):
                lists, hashes, chunks = [], [], []
                for text in part.column("text").to_pylist():
                    raw = text.encode().lower()
                    ends = chunk_ends(raw)
                    own = digests_of(raw, ends, width)
                    lists.append(b"".join(own))
                    hashes.append(hashlib.sha256(raw).hexdigest())
                    chunks.append([{"digest": d, "content": raw[a:b]} for d, a, b in zip(own, [0, *ends], ends, strict=False)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lists, pa.binary()), pa.array(hashes, pa.string()), pa.array(chunks, pa.list_(chunk))],
                                                 ["doc_id", "digests", "text_sha256", "chunks"])

    return rows.mapInArrow(run, "doc_id bigint, digests binary, text_sha256 string, chunks array<struct<digest: binary, content: binary>>")


def chunk_store(recurring: DataFrame) -> DataFrame:
    """digest, content: the distinct chunks, copies merged in the map tasks before anything is moved."""
    return recurring.select(F.explode("chunks").alias("c")).select("c.digest", "c.content").distinct()


def identified(recurring: DataFrame) -> DataFrame:
    """doc_id, text_sha256, _row, digests, numbers: the verified identifiers of
    each row's chunks. ``numbers`` (place, number) is empty unless a digest of
    the row has more than one content in the store."""
    store = materialize(chunk_store(recurring), "recipe-store")
    shared = small_side(store.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "recipe-shared-digests")
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("content"))
    numbered = store.join(shared, "digest", "left_semi").withColumn("number", nth)
    places = recurring.select("_row", F.posexplode("chunks").alias("place", "c")).select("_row", "place", "c.digest", "c.content") \
        .join(shared, "digest", "left_semi").join(numbered, ["digest", "content"])
    numbers = places.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("place", "number"))).alias("numbers"))
    return recurring.select("_row", "doc_id", "text_sha256", "digests").join(numbers, "_row", "left") \
        .withColumn("numbers", F.coalesce("numbers", F.expr("cast(array() as array<struct<place: int, number: int>>)")))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal if they are identical after lower-casing A-Z; null counts
    as empty, and all empty texts are equal. Of equal texts the row with the
    largest id stays; a null id is below all others, and of rows that share the
    largest id (repeated rows) exactly one has ``kept``. Texts may be of any
    length: they are cut in blocks, and beyond the row itself no more than its
    chunks is held. An empty table gives no rows. Other columns are not read;
    the id must be an integer.
    """
    rows = _rows(docs, id_col, text_col)
    lists = materialize(digest_lists(rows, digest_bytes), "recipe-lists")
    texts = materialize(lists.groupBy("digests", "raw_hash").agg(F.count(F.lit(1)).alias("n")), "recipe-texts")
    shared = texts.groupBy("digests").agg(F.sum("n").alias("n")).where("n > 1").select("digests")
    hashes = small_side(texts.join(shared, "digests", "left_semi").select("raw_hash").distinct(), "recipe-shared")
    alone = lists.join(hashes, "raw_hash", "left_anti") \
        .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    recurring = materialize(chunked(rows.join(hashes, "raw_hash", "left_semi"), digest_bytes)
                            .withColumn("_row", F.monotonically_increasing_id()), "recipe-recurring")
    named = materialize(identified(recurring), "recipe-identified")
    groups = small_side(named.groupBy("digests", "numbers").agg(F.max(F.struct("doc_id", "_row")).alias("_last"), F.count(F.lit(1)).alias("group_size")),
                        "recipe-groups")
    return alone.unionByName(named.join(groups, ["digests", "numbers"]).select(
        "doc_id", F.col("_last.doc_id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_last._row")).alias("kept"), "text_sha256"))

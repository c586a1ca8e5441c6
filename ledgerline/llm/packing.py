"""Packing along a Hilbert curve.

Each document is tokenized once; its hashed token vector is projected to a few
dimensions and given the key of its cell on a Hilbert curve. Documents sorted
by that key, so that neighbours resemble each other, form one long row of ids
that is cut every ``seq_len`` ids. Only the last sequence has padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import global_prefix, text_pieces

HASHED = 256  # length of the hashed vector
DIMS = 3
BITS = 16  # per dimension
SPREAD = 4.0  # projected values beyond this many standard deviations share the outermost cell

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts, as the byte-level BPE of a tokenizer file gives them.

    Merges are done by tiktoken, which is several times as fast and takes the
    file's own vocabulary: its ids are in the order of the merges. The file's
    added tokens are cut out of the text first, the longest at each place, as
    `tokenizers` does whether special tokens are added or not.
    """

    #: Fixed value: the pattern that byte-level pre-tokenizers part texts by.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    #: The characters that the pattern's \\s stands for; a run of this length or more is long.
    LONG_SPACE = re.compile("[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if file["model"]["type"] != "BPE" or file["pre_tokenizer"]["type"] != "ByteLevel" or file["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is no byte-level BPE without a space before the text")
        if file["normalizer"] or any(t[k] for t in file["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError(f"{path} normalizes texts or has added tokens that take more or less than their own characters")
        special = {t["content"]: t["id"] for t in file["added_tokens"] if t["content"]}
        of = byte_characters()
        ranks = {bytes(map(of.__getitem__, t)): i for t, i in file["model"]["vocab"].items() if t not in special}
        self.encoding = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.parts = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.ids(t), np.uint32) for t in texts]

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        last = 0
        for m in self.parts.finditer(text) if self.parts else ():
            out += self.plain(text[last:m.start()])
            out.append(self.special[m.group()])
            last = m.end()
        rest = self.plain(text[last:])
        return out + rest if out else rest

    def plain(self, text: str) -> list[int]:
        """Ids of a text without added tokens. The pattern takes a run of white
        space whole, or all of it but the last character where something
        follows, and its search needs stack for each character; so a long run
        is cut out first and merged as that one part."""
        out: list[int] = []
        last = 0
        for m in self.LONG_SPACE.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            out += self.encoding.encode_ordinary(text[last:m.start()])
            out += self.merged(text[m.start():end])
            last = end
        rest = self.encoding.encode_ordinary(text[last:])
        return out + rest if out else rest

    def merged(self, run: str) -> list[int]:
        """Ids of one part, however long."""
        return self.encoding._encode_single_piece(run)


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters are themselves, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index of each row of cells (n x dims, values below 2**bits) along the
    Hilbert curve of that many bits, by Skilling's transpose method."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the coarsest level
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (((x[i] ^ t) >> bit) & 1)
    return key


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document: signed hashing of its token counts to
    HASHED places, logarithm, unit length, a fixed projection to DIMS."""
    rng = np.random.RandomState(7)
    plan = rng.randn(HASHED, DIMS)
    vectors = np.zeros((len(ids), HASHED))
    for row, a in zip(vectors, ids, strict=True):
        h = a * np.uint32(2654435761)
        row[:] = np.bincount(h >> np.uint32(24), weights=1.0 - 2.0 * ((h >> np.uint32(23)) & np.uint32(1)), minlength=HASHED)
    vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    place = np.clip((vectors @ plan) / SPREAD, -1, 1)
    return hilbert_keys(np.minimum(((place + 1) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, doc_tokens, curve key, and the ids as little-endian uint16 if
    they fit, else uint32, with the end id; written once, with a row number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            for part in text_pieces(batch):
                ids = [np.append(a, np.uint32(end_id)) for a in coder.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(a) for a in ids], pa.int64()), pa.array(curve_keys(ids), pa.int64()),
                    pa.array([(a.astype("<u2") if a.max() < 65536 else a.astype("<u4")).tobytes() for a in ids], pa.binary())],
                    ["doc_id", "doc_tokens", "curve", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id bigint, doc_tokens bigint, curve bigint, ids binary")
                       .withColumn("_row", F.monotonically_increasing_id()), "packing-ids")


def pack(docs: DataFrame, tokenizer: str, seq_len: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``seq_len`` ids.

    A document is the ids of its whole text and then ``end_id``. Sequences are
    numbered along the curve; equal keys are ordered by id, then by row, so
    repeated rows are packed each on their own, and equal texts lie side by
    side. Null and empty texts are the end id alone. A table with no rows gives
    no rows. Columns other than id and text are not read; the id must be an
    integer.

    Columns: doc_id, start, length, ids_crc32 (of little-endian uint32 ids),
    doc_tokens, sequence_id, offset, ids (of the piece).
    """
    tokens = tokenize(docs, tokenizer, end_id, id_col, text_col)
    placed = global_prefix(tokens.select("_row", "doc_id", "curve", "doc_tokens"),
                           ["curve", "doc_id", "_row"], "doc_tokens", "packing-order")
    rows = tokens.select("_row", "doc_id", "doc_tokens", "ids").join(placed.select("_row", "_before"), "_row").drop("_row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_pieces(batch, "ids"):
                cols: list[list] = [[] for _ in range(8)]
                for doc, n, raw, before in zip(*(part.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "ids", "_before")), strict=True):
                    ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                    start = 0
                    while start < n:
                        at = before + start
                        length = min(n - start, seq_len - at % seq_len)
                        own = ids[start:start + length].tobytes()
                        for c, v in zip(cols, (doc, start, length, zlib.crc32(own), n, at // seq_len, at % seq_len, own), strict=True):
                            c.append(v)
                        start += length
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.binary())],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return rows.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                "sequence_id bigint, offset bigint, ids binary")

"""Quality rules by compression bands.

The zstandard ratio (compressed bytes to bytes) of the whole text and of each
fixed chunk must lie in a band that depends on the length: repetitive text
falls below it, noise above. Simple counts of words, symbols and repeats come
along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, text_pieces

LEVEL = 3
CHUNK = 4096
#: (least bytes, lowest ratio, highest ratio); the last entry that a text reaches holds.
BANDS = ((0, 0.0, 9.9), (64, 0.20, 1.25), (256, 0.25, 0.95), (1024, 0.20, 0.80), (4096, 0.20, 0.70), (16384, 0.15, 0.65))
#: Share of a text's chunks that may lie outside the band of their own length.
BAD_CHUNKS = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    n = len(words)
    if n <= size:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == n:
        return 0
    rank = np.fromiter(map(number.__getitem__, words), np.int64, n)
    width = 1
    while width < size:  # rank windows of twice the width by their halves' ranks; exact, no hashing
        step = min(width, size - width)
        pairs = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        kinds, rank = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(rank):
            return 0
        width += step
    often = np.bincount(rank)[rank] > 1
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def outside(length: int, ratio: float) -> bool:
    low, high = next((lo, hi) for least, lo, hi in reversed(BANDS) if length >= least)
    return not low <= ratio <= high


def measure(text: str, compressor) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, ratio, n_chunks, n_bad_chunks of one text."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
    ratio = len(compressor.compress(raw)) / len(raw) if raw else 0.0
    bad = chunks = 0
    if len(raw) > CHUNK:
        for i in range(0, len(raw), CHUNK):
            part = raw[i:i + CHUNK]
            chunks += 1
            bad += outside(len(part), len(compressor.compress(part)) / len(part))
    kept = not failed and not outside(len(raw), ratio) and bad <= BAD_CHUNKS * chunks
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeat, failed, kept, ratio, chunks, bad)


COLUMNS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, " \
          "base_failed boolean, kept boolean, ratio double, n_chunks bigint, n_bad_chunks bigint"
_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and COLUMNS for every whole text.

    Words are parted by ASCII white space. A text is kept if it has MIN_WORDS
    words, at most MAX_REPEAT_PERCENT of them in repeated windows, a ratio in
    the band of its length, and at most BAD_CHUNKS of its chunks (texts over
    CHUNK bytes) outside theirs. Null and empty texts have zeros, ratio 0, and
    are not kept. Repeated rows have a result each; a table with no rows gives
    none; columns other than id and text are not read.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for part in text_pieces(batch):
                found = list(zip(*(measure(t, compressor) for t in part.column("text").to_pylist()), strict=True))
                yield pa.RecordBatch.from_arrays([part.column(id_col), *(pa.array(c, t) for c, t in zip(found, _TYPES, strict=True))],
                                                 [id_col, *names])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {COLUMNS}")

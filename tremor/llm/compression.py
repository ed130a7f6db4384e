"""Quality rules by compression bands (operator 10).

Zstandard ratios (bytes before over bytes after) of whole texts and of fixed
chunks tell repetitive text (compresses too well) and incompressible text
(random strings) from prose. What is normal depends on the length, so each
length band has its own limits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm._text import CONTINUATION, WHITE, as_bytes, slices


@dataclass(frozen=True)
class Band:
    """Limits for texts under ``below`` bytes (None: any length); ratios outside are rejected."""

    below: int | None
    least: float
    most: float


#: Short texts carry the frame's overhead and find few repeats, so their ratios lie lower.
WHOLE = (Band(128, 0.0, 4.0), Band(512, 1.05, 2.5), Band(2048, 1.3, 3.0), Band(8192, 1.5, 3.5), Band(65536, 1.6, 4.0), Band(None, 1.6, 4.5))
#: For each full chunk of CHUNK bytes, and the last CHUNK bytes where the chunks leave a rest; a text fails if more than CHUNK_SHARE of them fail.
CHUNK, CHUNK_BAND, CHUNK_SHARE = 4096, Band(None, 1.5, 3.5), 0.2
MIN_WORDS, REPEAT_WORDS, REPEAT_PERCENT = 20, 8, 30

SCHEMA = """doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
 base_failed boolean, ratio double, n_chunks long, n_chunks_failed long, verdict string, kept boolean"""


def repeated_words(words: list[bytes], width: int = REPEAT_WORDS) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    order = np.sort(acc)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # Equal hashes only nominate windows; the words themselves decide.
    at = np.flatnonzero(np.isin(acc, twice))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
    keys = [ids[i : i + width].tobytes() for i in at]
    count = Counter(keys)
    steps = np.zeros(len(words) + 1, np.int64)
    for i, key in zip(at, keys, strict=True):
        if count[key] > 1:
            steps[i] += 1
            steps[i + width] -= 1
    return int((np.cumsum(steps[:-1]) > 0).sum())


def ratio(press: zstandard.ZstdCompressor, raw: bytes) -> float:
    return len(raw) / len(press.compress(raw)) if raw else 0.0


def outside(band: Band, value: float) -> str | None:
    return "incompressible" if value < band.least else "repetitive" if value > band.most else None


def rules(text: bytes, press: zstandard.ZstdCompressor) -> tuple:
    """All columns of the result for one text, after doc_id."""
    words = text.split()
    solid = text.translate(None, WHITE)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
    whole = ratio(press, text)
    verdict = outside(next(b for b in WHOLE if b.below is None or len(text) < b.below), whole) if text else "empty"
    starts = list(range(0, len(text) - CHUNK + 1, CHUNK))
    if starts and len(text) % CHUNK:
        starts.append(len(text) - CHUNK)
    chunks = [outside(CHUNK_BAND, ratio(press, text[i : i + CHUNK])) for i in starts]
    bad = [x for x in chunks if x]
    if verdict is None and len(bad) > CHUNK_SHARE * len(chunks):
        verdict = f"{max(sorted(set(bad)), key=bad.count)} chunks"
    return (
        len(words),
        len(solid.translate(None, CONTINUATION)),
        len(text) - len(text.translate(None, b"#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeats,
        failed,
        whole,
        len(chunks),
        len(bad),
        verdict or "fine",
        not failed and verdict is None,
    )


def compression_rules(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Counts, ratios and verdict of every text; one row per input row, repeats included.

    A null text counts as empty: no words, ``base_failed``, not kept. Very
    long texts are compressed whole, in memory of their own size. Other
    columns are ignored. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for part in slices(batches):
            rows = [(i, *rules(t, press)) for i, t in zip(part["i"], part["t"], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)

    return docs.select(F.col(doc_id).cast("long").alias("i"), as_bytes(text).alias("t")).mapInArrow(run, SCHEMA)


NAMES = [x.split()[0] for x in SCHEMA.split(",")]
TYPES = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}[x.split()[1]] for x in SCHEMA.split(",")]

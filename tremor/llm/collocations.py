"""Collocations by counted word n-grams (operator 13).

Words that occur often enough get a number; texts are cut where a rarer word
or a break stands. Every place of a text gives one window of numbers, as wide
as the longest phrase, packed as fixed-width binary. Windows go to ranges of
their order, a range is radix-sorted, and runs of equal beginnings give the
counts of all its phrases, of any length, at once.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm._text import as_bytes, batch_slices
from tremor.session import materialize, materialize_with, remove

#: Words of a phrase at most, and what its count must reach.
WIDTH, LEAST, TOP = 5, 100, 2000
#: Numbered words that every task may hold as a dictionary (some 150 MB); with more, words stand for themselves as 128-bit hashes.
MOST_WORDS = 1_000_000
#: Windows that a task sorts at once, windows of a range on average, and windows of the sample that the ranges follow.
GATHER, RANGE, SAMPLE = 1 << 20, 1 << 18, 1 << 15

_TABLE = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece of a text, lower-cased in A-Z; pieces without a word are left out."""
    for piece in text.translate(_TABLE).split(b"\n"):
        words = piece.split()
        if words:
            yield words


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(docs[f"`{lang}`"].cast("string"), F.lit("und")).cast("binary").alias("lang"), as_bytes(text, docs).alias("t"))


def _by_lang(part: pa.RecordBatch) -> dict[bytes, list[bytes]]:
    out: dict[bytes, list[bytes]] = {}
    for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
        out.setdefault(lang, []).append(t)
    return out


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, f`` of all words (binary), pre-aggregated in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = {}

        def flush():
            for lang, c in held.items():
                words = list(c)
                for at in range(0, len(words), 1 << 16):
                    w = words[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w), pa.binary()), pa.array(w, pa.binary()), pa.array([c[x] for x in w], pa.int64())], ["lang", "word", "f"])
            held.clear()

        for part in batch_slices(batches):
            for lang, texts in _by_lang(part).items():
                c = held.setdefault(lang, Counter())
                for t in texts:
                    c.update(t.translate(_TABLE).split())
            if sum(map(len, held.values())) > 400_000:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(run, "lang binary, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def digest(lang: bytes, word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=16, key=hashlib.blake2b(lang, digest_size=16).digest()).digest()


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of rows of uint32 columns, the first column highest: least digits first, 16 bits a pass, each pass stable."""
    order = np.arange(len(keys))
    for c in range(keys.shape[1] - 1, -1, -1):
        column = keys[:, c]
        top = int(column.max()) if len(column) else 0
        for shift in (0, 16):
            if top >> shift:
                order = order[np.argsort((column[order] >> np.uint32(shift)).astype(np.uint16), kind="stable")]
    return order


def _run_starts(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return np.flatnonzero(new)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order and how often each occurs (run-length count)."""
    order = radix_order(keys)
    keys = keys[order]
    at = _run_starts(keys)
    counts = np.ones(len(keys), np.int64) if counts is None else counts[order]
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts[:0]


def _windows(numbers: np.ndarray, width: int) -> np.ndarray:
    """The window at each place of a sequence ``[place, columns]``, where a row of zeros ends a run; single words have no window."""
    n, cols = numbers.shape
    solid = numbers.any(axis=1)
    out = np.zeros((n, width, cols), np.uint32)
    alive = np.ones(n, bool)
    for k in range(min(width, n)):
        alive[: n - k] &= solid[k:]
        alive[n - k :] = False
        out[: n - k, k][alive[: n - k]] = numbers[k:][alive[: n - k]]
    return out[out[:, 1].any(axis=1)].reshape(-1, width * cols)


def _packed(keys: np.ndarray) -> np.ndarray:
    """Rows as big-endian bytes, whose order is theirs."""
    return np.ascontiguousarray(keys.astype(">u4")).view(f"S{keys.shape[1] * 4}").ravel()


class Numbering:
    """Words as numbers: of a dictionary (one column), or as 128-bit hashes (four columns) where there are too many."""

    def __init__(self, known: dict[bytes, dict[bytes, int]] | None):
        self.known = known
        self.columns = 1 if known is not None else 4

    def encode(self, lang: bytes, texts: list[bytes]) -> np.ndarray:
        if self.known is not None:
            get = self.known.get(lang, {}).get
            out: list[int] = []
            for t in texts:
                for words in pieces(t):
                    out.extend([get(w, 0) for w in words])
                    out.append(0)
            return np.array(out, np.uint32).reshape(-1, 1)
        made: dict[bytes, bytes] = {}
        parts: list[bytes] = []
        for t in texts:
            for words in pieces(t):
                for w in words:
                    if w not in made:
                        made[w] = digest(lang, w)
                    parts.append(made[w])
                parts.append(bytes(16))
        return np.frombuffer(b"".join(parts), ">u4").astype(np.uint32).reshape(-1, 4)


def _gathered(batches: Iterator[pa.RecordBatch], numbering: Numbering, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct windows and their counts, of so many places at a time."""
    held, size = [], 0
    limit = GATHER // numbering.columns
    for part in batch_slices(batches):
        for lang, texts in _by_lang(part).items():
            numbers = numbering.encode(lang, texts)
            for at in range(0, len(numbers), limit):  # a window begins in its own stretch and may end in the next
                w = _windows(numbers[at : at + limit + width - 1], width) if at + limit >= len(numbers) else _stretch(numbers, at, limit, width)
                held.append(w)
                size += len(w)
        if size >= limit:
            yield counted(np.concatenate(held))
            held, size = [], 0
    if size:
        yield counted(np.concatenate(held))
    pa.default_memory_pool().release_unused()


def _stretch(numbers: np.ndarray, at: int, limit: int, width: int) -> np.ndarray:
    """Windows that begin in ``numbers[at : at + limit]``."""
    both = _windows(numbers[at : at + limit + width - 1], width)
    tail = _windows(numbers[at + limit : at + limit + width - 1], width)
    return both[: len(both) - len(tail)]


def phrase_counts(rows: DataFrame, numbering_of, columns: int, windows: int, least: int, width: int) -> DataFrame:
    """``key, a``: packed phrases of 2 to ``width`` words that occur ``least`` times or more."""
    spark = rows.sparkSession
    ranges = max(1, windows // RANGE)
    size = width * columns * 4
    bounds = np.zeros(0, f"S{size}")
    if ranges > 1:
        # Bounds of the ranges from a bounded sample of windows; they share out the work and decide nothing.
        part = min(1.0, 64 * SAMPLE / windows)
        share = SAMPLE / (windows * part)

        def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng(7)
            for keys, _ in _gathered(batches, numbering_of(), width):
                some = keys[rng.random(len(keys)) < share]
                yield pa.RecordBatch.from_arrays([pa.array([r.astype(">u4").tobytes() for r in some], pa.binary())], ["key"])

        some = rows.sample(part, 7).mapInArrow(sample, "key binary").orderBy(F.xxhash64("key")).limit(SAMPLE)
        found = sorted(bytes(r.key) for r in some.collect())
        bounds = np.array(sorted({found[i * len(found) // ranges] for i in range(1, ranges)} if found else ()), f"S{size}")
    shared = spark.sparkContext.broadcast(bounds)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _gathered(batches, numbering_of(), width):
            edge = [0, *np.searchsorted(_packed(keys), shared.value).tolist(), len(keys)]
            full = [k for k in range(len(edge) - 1) if edge[k] < edge[k + 1]]
            packed = [keys[edge[k] : edge[k + 1]].tobytes() + counts[edge[k] : edge[k + 1]].astype(np.uint32).tobytes() for k in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "packed"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, packed in by_range(batches):
            keys, n = _unpack(packed, width * columns)
            keys, n = counted(keys, n)
            out_keys, out_n = [], []
            for k in range(2, width + 1):
                prefix = keys[:, : k * columns]
                at = _run_starts(prefix)
                sums = np.add.reduceat(n, at)
                full = prefix[at][:, (k - 1) * columns :].any(axis=1)  # the others end before k words
                # A run at either end of the range may go on in the next one: its part is summed with the others.
                edge = np.zeros(len(at), bool)
                edge[[0, -1]] = True
                take = np.flatnonzero(full & ((sums >= least) | edge))
                out_keys += [r.astype(">u4").tobytes() for r in prefix[at[take]]]
                out_n.append(sums[take])
            yield pa.RecordBatch.from_arrays([pa.array(out_keys, pa.binary()), pa.array(np.concatenate(out_n), pa.int64())], ["key", "a"])

    dealt = rows.mapInArrow(emit, "bucket int, packed binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, "key binary, a long").groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Each range with its binaries, of rows in the order of ranges."""
    name, held = None, []
    for b in batches:
        for bucket, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if bucket != name and held:
                yield name, held
                held = []
            name = bucket
            held.append(packed)
    if held:
        yield name, held


def _unpack(packed: list[bytes], columns: int) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for x in packed:
        n = len(x) // (4 * columns + 4)
        keys.append(np.frombuffer(x, np.uint32, n * columns).reshape(n, columns))
        counts.append(np.frombuffer(x, np.uint32, n, 4 * n * columns).astype(np.int64))
    return np.concatenate(keys), np.concatenate(counts)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, width: int = WIDTH, most_words: int = MOST_WORDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to ``width`` words of each language.

    A null or empty text has no words; a null language is ``und``; repeated
    rows count as often as they stand there. Very long texts are read whole,
    in memory of some times their size. Ties go by count, then phrase (bytes).
    Other columns are ignored, whatever their names. An empty table, or one
    without a phrase that is frequent enough, gives an empty result.
    """
    spark = docs.sparkSession
    rows = _rows(docs, text, lang)
    counts, seen = materialize_with(word_counts(rows), "words", F.sum("f").alias("n"), F.count_if(F.col("f") >= least).alias("frequent"))
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.where(F.col("f") >= least)
    n_words, windows = seen["frequent"] or 0, seen["n"] or 0
    columns = 1 if n_words <= most_words else 4
    if columns == 1:
        found = frequent.select("lang", "word", "f").toArrow().sort_by([("f", "descending"), ("lang", "ascending"), ("word", "ascending")])  # of most_words at most
        known: dict[bytes, dict[bytes, int]] = {}
        for i, (name, word) in enumerate(zip(found["lang"].to_pylist(), found["word"].to_pylist(), strict=True), 1):
            known.setdefault(name, {})[word] = i
        number = spark.sparkContext.broadcast(known)
        ids = np.arange(1, found.num_rows + 1).astype(">u4").tobytes()
        words = spark.createDataFrame(found.append_column("id", pa.array([ids[i : i + 4] for i in range(0, len(ids), 4)], pa.binary())))
        words = materialize(words.select("id", "lang", "word", "f"), "dictionary")
        numbering_of = lambda: Numbering(number.value)
    else:
        name = F.udf(lambda a, b: digest(bytes(a), bytes(b)), "binary")
        words = materialize(frequent.select(name("lang", "word").alias("id"), "lang", "word", "f"), "dictionary")
        numbering_of = lambda: Numbering(None)
    step = 4 * columns
    phrases = materialize(phrase_counts(rows, numbering_of, columns, windows, least, width), "phrases")
    best = materialize(_scored(phrases, words, totals, step), "scored")
    # A phrase goes if a longer one is as frequent; then one longer by a word is, too.
    longer = phrases.where(F.octet_length("key") > 2 * step)
    inside = longer.select(F.explode(F.array(F.expr(f"substring(key, 1, octet_length(key) - {step})"), F.expr(f"substring(key, {step} + 1, octet_length(key))"))).alias("key"), "a").distinct()
    kept = materialize(best.join(inside, ["key", "a"], "left_anti"), "kept")
    named = materialize(_named(kept, words, step), "named")
    remove(spark, counts, words, phrases, best, kept)
    # The first of every part before the first of all, so no task ranks a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("key"), F.lit(64))).orderBy(*order)
    first = named.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select(F.col("lang").cast("string").alias("lang"), "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")


def _scored(phrases: DataFrame, words: DataFrame, totals: DataFrame, step: int) -> DataFrame:
    """``key, lang, a, l, r, n, score`` of the lowest-scoring cut of each phrase; exact in decimals of 38 digits."""
    f = phrases.select(F.col("key").alias("part"), F.col("a").alias("f")).union(words.select(F.col("id").alias("part"), "f"))
    cuts = phrases.select("key", "a", F.explode(F.expr(f"sequence(1, octet_length(key) div {step} - 1)")).alias("k"))
    cuts = cuts.select("key", "a", "k", F.expr(f"substring(key, 1, k * {step})").alias("left"), F.expr(f"substring(key, k * {step} + 1, octet_length(key))").alias("right"), F.expr(f"substring(key, 1, {step})").alias("first"))
    cuts = cuts.join(f.select(F.col("part").alias("left"), F.col("f").alias("l")), "left").join(f.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    lang = words.join(totals, "lang").select(F.col("id").alias("first"), "lang", "n")
    cuts = cuts.join(lang, "first")
    wide = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"cast(1000 as decimal(4,0)) * ({wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    cuts = cuts.withColumn("score", score.cast("long"))
    low = F.min(F.struct("score", "k", "l", "r", "n", "lang"))
    return cuts.groupBy("key", "a").agg(low.alias("c")).select("key", "a", "c.lang", "c.l", "c.r", "c.n", "c.score")


def _named(kept: DataFrame, words: DataFrame, step: int) -> DataFrame:
    """With the words of each phrase, joined by spaces (binary)."""
    at = kept.select("key", F.explode(F.expr(f"sequence(0, octet_length(key) div {step} - 1)")).alias("i"))
    at = at.select("key", "i", F.expr(f"substring(key, i * {step} + 1, {step})").alias("id")).join(words.select("id", "word"), "id")
    lists = at.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))  # of one phrase
    phrase = F.aggregate(F.slice("w", F.lit(2), F.size("w")), F.col("w")[0]["word"], lambda s, x: F.concat(s, F.lit(b" "), x["word"]))
    return kept.join(lists.select("key", phrase.alias("phrase")), "key")

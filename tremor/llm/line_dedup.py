"""Line dedup by a deletion-neighbourhood join (operator 9).

A line is dropped if an earlier line of the corpus (by doc_id, then text,
then place) has the same words, or words at an edit distance of one where that
leaves KEEP percent of the longer line. Letters A-Z are compared in lower case
and white space doesn't count; lines without words always stay.

Lines at distance one share a deletion variant: a line less one word. Short
lines emit all of theirs at once. For long ones that would be one row per word
of the corpus, so the join runs twice. First lines meet that could be at
distance one at all: an edit leaves the first or the last half of a line as it
was, so two keys a line (its first and its last m words, m a power of two of
about a third of the line) lose none. Then the lines that share a key with a
different line emit their deletion variants, and equal variants join. The
words of each line and of its earliest partner are compared at last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm._text import POWERS, as_bytes, batch_slices, hash_words, mix, text_buffers, to_signed
from tremor.session import materialize, release, remove, small_batches

#: One edit must leave so much of the longer line (percent): lines of MIN_WORDS words or more.
KEEP = 80
MIN_WORDS = 100 // (100 - KEEP)
#: Lines of fewer words emit their variants in the first round.
LONG = 12
LINE, GONE, NEAR = 0, 1, 2
_ROWS = "kind int, key long, h long, doc long, th long, line int"
_NAMES = ["kind", "key", "h", "doc", "th", "line"]
_VARIANTS = "v long, place int, doc long, th long, line int, words binary"
_NULL_ID = -(1 << 63)
_SECOND = np.uint64(0xA0761D6478BD642F)
#: A text is taken by pieces of so many bytes and the rest of their last line.
PIECE = 4 << 20


class Lines:
    """The lines with words of some texts that lie side by side: of which text, which number, their words and two hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, before: int = 0):
        words, at, bounds = hash_words(data, offsets)
        breaks = np.flatnonzero(data == 10)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        number = np.searchsorted(breaks, at) - np.searchsorted(breaks, offsets[:-1])[text]
        new = np.ones(len(words), bool)
        new[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
        self.data, self.at, self.offsets = data, at, offsets
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], len(words)) if len(words) else self.start
        self.size = self.end - self.start
        self.text, self.number = text[self.start], number[self.start] + before
        up, self.down = POWERS.get(len(words) + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(words * up[: len(words)]))
        self.whole = self._name(self._sum(self.start, self.end), self.size)
        second = np.append(np.uint64(0), np.cumsum(mix(words ^ _SECOND) * up[: len(words)]))
        self.second = self._name((second[self.end] - second[self.start]) * self.down[self.start], self.size)

    def _sum(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]

    @staticmethod
    def _name(value: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix(value ^ mix(size.astype(np.uint64)))

    def words(self, line: int) -> bytes:
        """The lower-cased words of a line, one space between."""
        stop = self.at[self.end[line]] if self.end[line] < len(self.at) else len(self.data)
        stop = min(int(stop), int(self.offsets[self.text[line] + 1]))
        return b" ".join(self.data[self.at[self.start[line]] : stop].tobytes().lower().split())

    def without(self, line: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Names of the lines less the word at the place in the line."""
        s, e = self.start[line], self.end[line]
        a = s + place
        right = (self.sums[e] - self.sums[a + 1]) * self.down[s + 1]
        return self._name((self.sums[a] - self.sums[s]) * self.down[s] + right, e - s - 1)

    def variants(self, line: np.ndarray, sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line, place and name of the rest, for each word of the given lines that an edit may have touched.

        ``sides``: 1 where another line has the same first words, 2 the same
        last words, 3 both; the edit lies outside of what is the same.
        """
        n = self.size[line]
        of = np.repeat(line, n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        if sides is not None:
            m = np.repeat(np.int64(1) << (np.floor(np.log2(n - 1)).astype(np.int64) - 1), n)
            side, size = np.repeat(sides, n), np.repeat(n, n)
            use = ((side & 1 > 0) & (place >= m)) | ((side & 2 > 0) & (place < size - m))
            of, place = of[use], place[use]
        return of, place, self.without(of, place)

    def half_keys(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line, key and side (0: first words, 1: last) of the first-round keys of the given lines (LONG words or more, or one less).

        With ``m = 2**(k - 1)`` for lines of ``2**k`` words or more, an edit
        at place e leaves the first m words if e >= m, else the last m. A
        partner one word shorter or longer may be of another k, so lines at
        the border of two use both.
        """
        n = self.size[line]
        lines, keys, sides = [], [], []
        k = np.floor(np.log2(n)).astype(np.int64)
        for shift in (0, -1, 1):
            other = np.floor(np.log2(n + shift)).astype(np.int64)
            use = np.ones(len(line), bool) if shift == 0 else other != k
            at, m = line[use], np.int64(1) << (other[use] - 1)
            s, e = self.start[at], self.end[at]
            for side, (a, b) in enumerate(((s, s + m), (e - m, e))):
                lines.append(at)
                keys.append(mix(self._name(self._sum(a, b), m) + np.uint64(side + 1)))
                sides.append(np.full(len(at), side, np.int64))
        return np.concatenate(lines), np.concatenate(keys), np.concatenate(sides)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Lines]]:
    """Slices of rows with their lines; a text of more than PIECE bytes comes by pieces that end with a line."""
    for part in batch_slices(batches, 256, PIECE):
        data, offsets = text_buffers(part.column("t"))
        if part.num_rows > 1 or len(data) <= PIECE:
            yield part, Lines(data, offsets)
            continue
        at = before = 0
        while at < len(data):
            end = min(at + PIECE, len(data))
            while end < len(data) and not (hit := np.flatnonzero(data[end : end + PIECE] == 10)).size:
                end = min(end + PIECE, len(data))
            end = min(end + int(hit[0]) + 1, len(data)) if end < len(data) else end
            piece = data[at:end]
            yield part, Lines(piece, np.array([0, len(piece)]), before)
            before += int(np.count_nonzero(piece == 10))
            at = end


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines and first-round keys of a slice of texts; of equal lines in the slice only the first goes on, the others are gone.

    A LINE row has the second hash of its words in ``h``, a key of a half
    (NEAR) the first one, and the side in ``line``.
    """
    with np.errstate(over="ignore"):
        for part, x in _pieces(batches):
            if not len(x.start):
                continue
            doc, th = (part.column(c).to_numpy()[x.text] for c in ("i", "h"))
            order = np.lexsort((x.number, th, doc, x.second, x.whole))
            h, g = x.whole[order], x.second[order]
            first = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))
            lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            same = (doc[lead] == doc[order]) & (th[lead] == th[order]) & (x.number[lead] == x.number[order])
            keep, gone = order[first], order[~first & ~same]  # rows of the same place are repeats of a row, not of a line
            yield _batch(LINE, x.whole[keep], x.second[keep], doc[keep], th[keep], x.number[keep])
            if len(gone):
                yield _batch(GONE, mix(x.whole[gone] ^ th[gone].view(np.uint64) ^ x.number[gone].astype(np.uint64)), None, doc[gone], th[gone], x.number[gone])
            long = keep[x.size[keep] >= LONG - 1]
            if len(long):
                of, key, side = x.half_keys(long)
                yield _batch(NEAR, key, x.whole[of], None, None, side)
            short = keep[(x.size[keep] >= MIN_WORDS - 1) & (x.size[keep] < LONG)]
            if len(short):
                of, _, key = x.variants(short)
                of, key = np.concatenate([short, of]), np.concatenate([x.whole[short], key])
                # A side of 2 or more: all words of the line may have been touched.
                yield _batch(NEAR, mix(key ^ _SECOND), x.whole[of], None, None, np.full(len(of), 2))


def _batch(kind, key, h, doc, th, line) -> pa.RecordBatch:
    n = len(key)
    zero = np.zeros(n, np.int64)
    cols = [np.full(n, kind, np.int32), to_signed(key), zero if h is None else to_signed(h), zero if doc is None else doc, zero if th is None else th, line.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], _NAMES)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and then the others: first lines stay LINE, later equal ones become GONE, keys stay where two lines share one.

    A key's row comes out once for each line but the first of its key, with
    that first line's hash in ``doc``. Holds one row of the batch before.
    """
    last = None
    for b in batches:
        kind, key, h, doc, th, line = (b.column(i).to_numpy(zero_copy_only=False).copy() for i in range(6))
        if not len(key):
            continue
        is_line, is_near = kind == LINE, kind == NEAR
        new = np.append(True, (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | (is_line[1:] & (h[1:] != h[:-1])))
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        lead = np.stack([h[at], doc[at], th[at], line[at].astype(np.int64)])
        again = np.zeros(len(key), bool)
        if last is not None and last[0] == (kind[0], key[0]) and (not is_line[0] or last[1][0] == h[0]):
            stop = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(key)
            lead[:, :stop] = last[1][:, None]
            again[:stop] = True
        last = (kind[-1], key[-1]), lead[:, -1].copy()
        first = new & ~again
        moved = (doc != lead[1]) | (th != lead[2]) | (line != lead[3])
        near = is_near & (h != lead[0])
        keep = (is_line & (first | moved)) | (kind == GONE) | near
        kind = np.where(is_line & ~first, GONE, kind)
        doc = np.where(near, lead[0], doc)
        cols = [kind.astype(np.int32), key, h, doc, th, line]
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], _NAMES)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Variants of the listed lines of each text: key, place of the missing word (-1: the whole line, with its words), and the line."""
    with np.errstate(over="ignore"):
        for part, x in _pieces(batches):
            want = part.column("lines")
            edge, flat = np.diff(want.offsets.to_numpy()), want.flatten()
            owner = np.repeat(np.arange(part.num_rows), edge)
            line, sides = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            # The lines of this piece among those listed, by text and number.
            code, listed = (x.text << 32) | x.number, (owner << 32) | line
            mine = np.minimum(np.searchsorted(code, listed), max(len(code) - 1, 0))
            hit = code[mine] == listed if len(code) else np.zeros(len(listed), bool)
            mine, sides = mine[hit], sides[hit].astype(np.int64)
            if not len(mine):
                continue
            full = (sides >= 4) | (x.size[mine] < LONG - 1)
            a = x.variants(mine[full])
            b = x.variants(mine[~full], sides[~full] & 3) if (~full).any() else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
            of, place, key = np.concatenate([mine, a[0], b[0]]), np.concatenate([np.full(len(mine), -1), a[1], b[1]]), np.concatenate([x.whole[mine], a[2], b[2]])
            doc, th = (part.column(c).to_numpy()[x.text[of]] for c in ("i", "h"))
            words = pa.concat_arrays([pa.array([x.words(k) for k in mine.tolist()], pa.binary()), pa.nulls(len(of) - len(mine), pa.binary())])
            yield pa.RecordBatch.from_arrays([pa.array(to_signed(key)), pa.array(place.astype(np.int32)), pa.array(doc), pa.array(th), pa.array(x.number[of].astype(np.int32)), words], ["v", "place", "doc", "th", "line", "words"])


def one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the words are at an edit distance of one that leaves KEEP percent of the longer line."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b or 100 * (len(b) - 1) < KEEP * len(b):
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batch_slices(batches, 4096, PIECE):
        good = [one_edit(a.split(b" "), b.split(b" ")) for a, b in zip(part.column("wa").to_pylist(), part.column("wb").to_pylist(), strict=True)]
        yield part.select(["doc", "th", "line"]).filter(pa.array(good, pa.bool_()))


def dropped_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc, th, line, near``: the place of every line that goes, and whether it goes for a line at distance one.

    ``doc`` is the doc_id (the least long for null), ``th`` a hash of the
    text, ``line`` counts from 0. Null and empty texts have no lines. Rows that
    are repeated give the same place more than once. Equal
    lines of one slice of a task are reduced before they are sent, so a line
    that a third of the rows hold travels once per slice.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(docs[f"`{doc_id}`"].cast("long"), F.lit(_NULL_ID)).alias("i"), as_bytes(text, docs).alias("t"))
    texts = texts.withColumn("h", F.xxhash64("t"))
    rows = texts.mapInArrow(_emit, _ROWS).repartition("key").sortWithinPartitions("key", "kind", "h", "doc", "th", "line")
    found = materialize(rows.mapInArrow(_groups, _ROWS), "lines")
    del rows
    release(spark)
    exact = found.where(f"kind = {GONE}").select("doc", "th", "line", F.lit(False).alias("near"))
    near = found.where(f"kind = {NEAR}").select(F.explode(F.array("h", "doc")).alias("h"), F.expr("shiftleft(1, line)").alias("side")).groupBy("h").agg(F.bit_or("side").alias("sides"))
    places = found.where(f"kind = {LINE}").select(F.col("key").alias("h"), "doc", "th", "line").join(near, "h")
    wanted = places.groupBy(F.col("doc").alias("i"), F.col("th").alias("h")).agg(F.array_sort(F.collect_set(F.struct("line", "sides"))).alias("lines"))  # of one text
    variants = texts.join(wanted, ["i", "h"]).select("i", "t", "h", "lines").dropDuplicates(["i", "h"]).mapInArrow(_word_rows, _VARIANTS)
    variants = materialize(variants, "variants")
    release(spark)
    # Most variants are one line's alone; the others are few.
    place = F.struct("doc", "th", "line").alias("s")
    narrow = variants.select("v", "place", place)
    shared = narrow.groupBy("v").agg(F.min("s").alias("m"), F.max("s").alias("x")).where("m < x").select("v")
    narrow = materialize(narrow.join(shared, "v", "left_semi"), "shared-variants")
    release(spark)
    rest, whole = narrow.where("place >= 0"), narrow.where("place < 0")
    by_place = rest.groupBy("v", "place").agg(F.min("s").alias("m"), F.max("s").alias("x")).where("m < x").select("v", "place", "m")
    swapped = rest.join(by_place, ["v", "place"]).where("s > m").select("s", "m")
    longer = rest.join(whole.groupBy("v").agg(F.min("s").alias("m")), "v").where("s > m").select("s", "m")
    shorter = whole.join(rest.groupBy("v").agg(F.min("s").alias("m")), "v").where("s > m").select("s", "m")
    # Each line with each of its (at most four) earliest partners; their words decide.
    pairs = swapped.union(longer).union(shorter).distinct()
    words = variants.where("place < 0").select(place, "words")
    pairs = pairs.join(words.select("s", F.col("words").alias("wa")), "s").join(words.select(F.col("s").alias("m"), F.col("words").alias("wb")), "m")
    close = pairs.select("s.*", "wa", "wb").mapInArrow(_verify, "doc long, th long, line int")
    close = materialize(close.distinct().withColumn("near", F.lit(True)), "near-lines")
    remove(spark, variants, narrow)
    release(spark)
    return exact.union(close)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the listed lines, and how many lines have words."""
    for part in batch_slices(batches, 1024, PIECE):
        texts, count = [], []
        for t, gone in zip(part.column("t").to_pylist(), part.column("gone").to_pylist(), strict=True):
            lines = t.split(b"\n") if t is not None else []
            count.append(sum(1 for x in lines if x.strip()))
            if gone:
                drop = set(gone)
                t = b"\n".join([x for k, x in enumerate(lines) if k not in drop])
            texts.append(None if t is None else t.decode())
        yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string()), pa.array(count, pa.int64()), part.column("n_exact"), part.column("n_near")], ["row", "kept", "n_lines", "n_exact", "n_near"])


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each row of ``docs`` as a struct ``row``, and ``kept`` (the text without dropped lines, null for null),
    ``n_lines`` (lines that have words), ``n_exact`` and ``n_near`` (how many of them were dropped, and why).

    One row per input row; repeated rows keep the same lines and count each
    line once. An empty table gives an empty result. Columns may have any name.
    """
    gone = dropped_lines(docs, text, doc_id)

    def lines(which):
        return F.collect_set(F.when(which, F.col("line")))

    gone = gone.groupBy("doc", "th").agg(F.collect_set("line").alias("gone"), F.size(lines(~F.col("near"))).cast("long").alias("n_exact"), F.size(lines(F.col("near"))).cast("long").alias("n_near"))
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    rows = docs.select(row, F.coalesce(docs[f"`{doc_id}`"].cast("long"), F.lit(_NULL_ID)).alias("i"), F.xxhash64(as_bytes(text, docs)).alias("h"), docs[f"`{text}`"].cast("binary").alias("t"))
    rows = rows.join(gone, (F.col("i") == F.col("doc")) & (F.col("h") == F.col("th")), "left")
    rows = rows.select("row", "t", "gone", F.coalesce("n_exact", F.lit(0).cast("long")).alias("n_exact"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
    kinds = {"row": rows.schema["row"].dataType, "kept": T.StringType(), "n_lines": T.LongType(), "n_exact": T.LongType(), "n_near": T.LongType()}
    return rows.mapInArrow(_kept, T.StructType([T.StructField(k, v) for k, v in kinds.items()]))


def keep_first_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, texts without dropped lines; documents that lose all their lines with words go.

    Null texts and texts without words stay as they are; repeated rows stay as
    often; ``n_chars``, where there is such a column, follows the text. An
    empty table gives an empty result; columns may have any name.
    """
    out = dedup_lines(docs).where("n_lines = 0 or n_lines > n_exact + n_near")
    cols = {"text": F.col("kept"), "n_chars": F.length("kept")}
    return out.select(*[cols.get(f.name, F.col("row").getField(f.name)).cast(f.dataType).alias(f.name) for f in docs.schema.fields])

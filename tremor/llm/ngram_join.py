"""N-gram Jaccard join (operator 3): exact, by universe partition and pigeonhole.

A document is its set of word shingles. Two sets of sizes a and b have a
Jaccard similarity of t or more only if they differ in at most
``H = floor((1 - t) / (1 + t) * (a + b))`` elements. Sizes are parted into
bands; a pair meets in the band of its smaller set, so a set has keys in its
own band and, where a smaller partner may lie there, in the one below. A band
parts the universe of shingle hashes into segments (cf. Deng et al., 2015, 2018)
and has one of two allocations, the cheaper by the shingle frequencies that
were measured over all documents (:func:`allocate`):

* segment subsets: sets that differ in at most H elements share one of their
  ``H + 1`` segments that come first in a common order, in which segments of
  frequent shingles come last;
* one-deletion neighbourhoods: of ``H / 2 + 1`` segments one differs in at most
  one element, so each counts as it is and less each of its elements.

A set whose segments cannot meet its bound (too many empty or single ones) has
the ``H + 1`` first of its shingles as keys besides. So no link is lost.

Every set of a key is compared with one of them first. A parity bitmap of each
set (a bit flips for each element) differs in no more bits than the sets do in
elements, so it rules most others out exactly; the rest is verified on the
words of the texts. Where a key still holds several components, its sets are
compared across components by their bitmaps, in blocks, and of those that may
link only a few spanning forests go on to be verified, until no pair is open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm._blobs import SCHEMA, Gathered, buckets_for, by_bucket, scatter, shuffled, unpack
from tremor.llm._text import as_bytes, batch_slices, column_shingles, mix, sorted_sets, to_signed
from tremor.operators.components import connected_components
from tremor.session import materialize, materialize_with, release, remove, small_batches

#: Similarity as a fraction: 80 of 100.
PERCENT, WIDTH = 80, 5
#: First sizes of the bands: the first one takes single shingles as segments; each later one spans this factor of sizes.
TINY, SPAN = 12, 2.0
#: Shingles of fewer documents aren't frequent. The most shingles that are known as frequent when segments are ordered (1 MB).
LEAST_FREQUENT, FREQUENT = 24, 65536
#: How many segments a band may have for each one that a set needs, and the costs of a key row and of a pair of one key.
SLACK, ROW_COST, PAIR_COST = (1.0, 1.5, 2.0, 3.0), 1.0, 1.0
#: Bytes of bitmaps, and sets, that a task compares at once; a larger group goes by pairs of blocks, 10**8 pairs of sets each at most.
BLOCK, BLOCK_SETS = 8 << 20, 10_000
#: Spanning forests of open pairs that are verified at once, and how many times more in each round after the first.
FORESTS, MORE = 8, 16
#: Rows of two ids that are sent to every task (some 30 MB); more meet texts and bitmaps by a shuffle.
SENT = 1 << 20
#: A set that a task has met has no keys again; so many are remembered.
SEEN = 200_000
_SUBSETS, _DELETIONS, _SINGLE = 0, 1, 2
_NAME = np.uint64(0xD6E8FEB86659FD93)
#: Frequent shingles are known by their other bits.
_BAND = np.uint64(63)


def difference(a, b, percent: int = PERCENT):
    """The most elements in which sets of sizes a and b may differ and link."""
    return (100 - percent) * (a + b) // (100 + percent)


def band_bases(largest: int) -> np.ndarray:
    """The least size of each band, the first of which begins at 1, up to that of a set of ``largest`` shingles and one more."""
    out = [1, TINY + 1]
    while out[-1] <= largest:
        out.append(max(int(out[-1] * SPAN), out[-1] + 1))
    return np.array(out, np.int64)


class Allocation:
    """For each band the kind of its keys and the number of its segments."""

    def __init__(self, bases: np.ndarray, kind: np.ndarray, segments: np.ndarray, percent: int = PERCENT):
        self.bases, self.kind, self.segments, self.percent = bases, kind, segments, percent


def allocate(largest: int, hot: dict[int, tuple[int, float, float]], percent: int = PERCENT) -> Allocation:
    """The cheapest allocation of each band.

    ``hot``: by band the number of sets, the share of frequent shingles among
    theirs, and the mean number of documents of those. A set that lacks
    segments without frequent shingles falls on frequent keys, each of which
    has about as many sets as the shingle has documents.
    """
    bases = band_bases(largest)
    kind, segments = np.zeros(len(bases), np.int64), np.ones(len(bases), np.int64)
    kind[0] = _SINGLE
    for k in range(1, len(bases) - 1):
        top = int(bases[k + 1]) - 1
        n = (int(bases[k]) + top) / 2
        most = int(difference(top, top * 100 // percent, percent))
        _, share, documents = hot.get(k, (0, 0.0, 0.0))
        choices = []
        for slack in SLACK:
            s = int((most + 1) * slack)
            clean = s * (1 - share ** max(n / s, 1))
            choices.append((ROW_COST * (most + 1) * (1 + s / n) + PAIR_COST * max(most + 1 - clean, 0) * documents, _SUBSETS, s))
        s = most // 2 + 1
        size = n / s
        # A segment is of frequent shingles alone, or of them but for one: that many keys are frequent.
        frequent = s * (share**size + size * share ** max(size - 1, 0) * (1 - share))
        choices.append((ROW_COST * (s + n) + PAIR_COST * frequent * documents, _DELETIONS, s))
        _, kind[k], segments[k] = min(choices)
    return Allocation(bases, kind, segments, percent)


def _key(band: np.ndarray, seg: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(value ^ mix(seg + np.uint64(0x9E3779B97F4A7C15) * (band.astype(np.uint64) + np.uint64(1))))


def _first(owner: np.ndarray, cost: np.ndarray, keys: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each owner's keys the first ``most + 1`` of the common order: by cost, then by hash. Owners ascend."""
    order = np.lexsort(((keys >> np.uint64(6)) | (cost.astype(np.uint64) << np.uint64(58)), owner))
    owner, keys = owner[order], keys[order]
    new = np.append(True, owner[1:] != owner[:-1])
    place = np.arange(len(owner)) - np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    use = place <= most[owner]
    return owner[use], keys[use]


def _band_keys(u, owner, cost, band, most, plan: Allocation):
    """Keys of sets (``owner`` of each shingle ascends) in the given band of each, for the bound ``most`` of each."""
    if not len(u):
        return [], []
    kind = plan.kind[band]
    v = mix(u)
    seg = ((u >> np.uint64(32)) * plan.segments[band][owner].astype(np.uint64)) >> np.uint64(32)
    single = kind[owner] == _SINGLE
    start = np.flatnonzero(np.append(True, (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1])))
    total = np.add.reduceat(v, start)
    so, sg = owner[start], seg[start]
    size = np.diff(np.append(start, len(u)))
    whole = _key(band[so], sg, total)
    n = len(band)
    owners, keys = [], []
    subsets = kind[so] == _SUBSETS
    if subsets.any():
        o, k = _first(so[subsets], np.minimum.reduceat(cost, start)[subsets], whole[subsets], most)
        owners.append(o), keys.append(k)
    deletions = kind[so] == _DELETIONS
    if deletions.any():
        owners.append(so[deletions]), keys.append(whole[deletions])
        of = np.repeat(np.arange(len(start)), size)
        rich = (size[of] > 1) & deletions[of]
        of = of[rich]
        owners.append(so[of]), keys.append(_key(band[so[of]], sg[of], total[of] - v[rich]))
    # Too few segments for the bound: single shingles besides.
    reach = np.bincount(so, np.where(kind[so] == _DELETIONS, np.minimum(size, 2), 1), n)
    weak = single | (reach <= most)[owner]
    if weak.any():
        w = owner[weak]
        o, k = _first(w, cost[weak], _key(band[w] + 1000, np.zeros(len(w), np.uint64), mix(u[weak] ^ np.uint64(0xA5A5A5A5))), most)
        owners.append(o), keys.append(k)
    return owners, keys


def signatures(u: np.ndarray, edge: np.ndarray, plan: Allocation, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of several sets of distinct shingle hashes (each ascending), and whose they are.

    ``frequent`` holds shingles that many documents have (sorted) and their
    cost, 1 to 63. Any such list gives the same links.
    """
    with np.errstate(over="ignore"):
        n = np.diff(edge)
        owner = np.repeat(np.arange(len(n)), n)
        cost = np.zeros(len(u), np.int64)
        if frequent is not None and len(frequent[0]):
            x = u & ~_BAND
            at = np.minimum(np.searchsorted(frequent[0], x), len(frequent[0]) - 1)
            cost = np.where(frequent[0][at] == x, frequent[1][at], 0)
        band = np.maximum(np.searchsorted(plan.bases, n, side="right") - 1, 0)
        owners, keys = _band_keys(u, owner, cost, band, difference(n, n * 100 // plan.percent, plan.percent), plan)
        # A smaller partner may lie in the band below.
        below = (band > 0) & (n * plan.percent <= (plan.bases[band] - 1) * 100)
        if below.any():
            use = below[owner]
            more = _band_keys(u[use], owner[use], cost[use], np.maximum(band - 1, 0), difference(n, np.minimum(n, plan.bases[band] - 1), plan.percent), plan)
            owners, keys = owners + more[0], keys + more[1]
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(owners)


def names(u: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set; the empty set has a name too."""
    with np.errstate(over="ignore"):
        return tuple(mix(np.diff(np.append(np.uint64(0), np.cumsum(mix(u ^ salt)))[edge]) + np.diff(edge).astype(np.uint64) + salt) for salt in (np.uint64(0), _NAME))


def bitmaps(u: np.ndarray, edge: np.ndarray) -> list[bytes]:
    """Parity bitmap of each set, 2 to 4 bits for each shingle, a power of two of 64 at least."""
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        bits = 1 << max((2 * (b - a) - 1).bit_length(), 6)
        odd = (np.bincount((u[a:b] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
        out.append(np.packbits(odd, bitorder="little").tobytes())
    return out


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) brought down to ``words`` words; their differences don't grow."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


_FACTS = "kind int, doc long, id long, other long, n int, bits binary"


def _facts(width: int, bases: np.ndarray):
    """Of each text its names, size and bitmap (kind 0); of what a task has read, shingles of several texts with their number (kind 1).

    A shingle comes once for each band of sizes: ``n`` tells the band then, ``other`` the number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows(kind, doc, ident, other, n, bits):
            k = len(ident)
            cols = [pa.array(np.full(k, kind, np.int32)), doc if doc is not None else pa.nulls(k, pa.int64()), pa.array(to_signed(ident)), pa.array(to_signed(other)), pa.array(n.astype(np.int32))]
            return pa.RecordBatch.from_arrays([*cols, pa.array(bits, pa.binary()) if bits is not None else pa.nulls(k, pa.binary())], [x.split()[0] for x in _FACTS.split(", ")])

        def counts():
            # The band rides in the lowest bits of a shingle, so one sort of numbers counts both.
            z = np.concatenate(held)
            z.sort()
            start = np.flatnonzero(np.append(True, (z[1:] ^ z[:-1]) > _BAND))
            size = np.diff(np.append(start, len(z)))
            z = z[np.repeat(size > 2, size)]
            start = np.flatnonzero(np.append(True, z[1:] != z[:-1])[: len(z)])
            return rows(1, None, z[start] & ~_BAND, np.diff(np.append(start, len(z))).astype(np.uint64), (z[start] & _BAND).astype(np.int32), None)

        with np.errstate(over="ignore"):
            for part in batch_slices(batches):
                u, edge = sorted_sets(*column_shingles(part.column("t"), width))
                n = np.diff(edge)
                lo, hi = names(u, edge)
                yield rows(0, part.column("i"), lo, hi, n, bitmaps(u, edge))
                held.append((u & ~_BAND) | np.repeat((np.searchsorted(bases, n, side="right") - 1).astype(np.uint64), n))
                size += len(u)
                if size > 1_000_000:
                    yield counts()
                    held, size = [], 0
            if held:
                yield counts()

    return run


_KEY = [np.uint64, np.int64, np.int32]
_PAIR = [np.uint64, np.int64, np.int32, np.int64, np.int32]
_PAIRS = "key long, rep long, rn int, id long, n int"


def _emit(width: int, given, clashes: frozenset, buckets: int):
    """Keys of sets, packed. Of a key that a task has several times the first goes on; the others are pairs with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, frequent = given.value
        seen: set[int] = set()
        held = Gathered()

        def flush():
            key, ident, n = held.take()
            first, at = _leads(key)
            other = ~first & (ident != ident[at])
            yield scatter(buckets, False, key[first], ident[first], n[first])
            yield scatter(buckets, True, key[other], ident[at][other], n[at][other], ident[other], n[other])

        with np.errstate(over="ignore"):
            for part in batch_slices(batches):
                u, edge = sorted_sets(*column_shingles(part.column("t"), width))
                ident, n = _ids(u, edge, clashes), np.diff(edge)
                fresh = np.ones(len(n), bool)
                for k, x in enumerate(ident.tolist()):
                    fresh[k] = x not in seen
                    seen.add(x)
                if len(seen) > SEEN:
                    seen.clear()
                take = np.repeat(fresh, n)
                keys, of = signatures(u[take], np.append(0, np.cumsum(n[fresh])), plan, frequent)
                if held.add(keys, to_signed(ident[fresh])[of], n[fresh][of].astype(np.int32)):
                    yield from flush()
            if held.rows:
                yield from flush()

    return run


def _leads(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: which are the first of their kind, and the place of the first for each."""
    first = np.append(True, key[1:] != key[:-1])[: len(key)]
    return first, np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))


def _ids(u: np.ndarray, edge: np.ndarray, clashes: frozenset) -> np.ndarray:
    """The first name of each set; of those whose first name another set has too, a mix of both."""
    lo, hi = names(u, edge)
    if clashes:
        twice = np.isin(lo, np.array(sorted(clashes), np.uint64))
        lo[twice] = mix(lo[twice] ^ mix(hi[twice]))
    return lo


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set of a key with the first of the key, where a key has two sets."""
    for bucket, packed in by_bucket(batches):
        if bucket < 0:
            columns = unpack(packed, _PAIR)
        else:
            key, ident, n = unpack(packed, _KEY)
            order = np.argsort(key, kind="stable")
            key, ident, n = key[order], ident[order], n[order]
            _, at = _leads(key)
            other = ident != ident[at]
            columns = [key[other], ident[at][other], n[at][other], ident[other], n[other]]
        for a in range(0, len(columns[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 16)].view(np.int64) if x.dtype == np.uint64 else x[a : a + (1 << 16)]) for x in columns], ["key", "rep", "rn", "id", "n"])


def _within(percent: int):
    """Of pairs with their bitmaps: those that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batch_slices(batches, 4096, 8 << 20):
            na, nb = (b.column(c).to_numpy() for c in ("na", "nb"))
            (xa, ea), (xb, eb) = (text_words(b.column(c)) for c in ("ba", "bb"))
            wa, wb = np.diff(ea), np.diff(eb)
            keep = np.zeros(b.num_rows, bool)
            for size in {*zip(wa.tolist(), wb.tolist(), strict=True)}:
                at = np.flatnonzero((wa == size[0]) & (wb == size[1]))
                w = min(size)
                x = fold(xa[ea[at][:, None] + np.arange(size[0])], w) ^ fold(xb[eb[at][:, None] + np.arange(size[1])], w)
                keep[at] = np.bitwise_count(x).sum(1, dtype=np.int64) <= difference(na[at], nb[at], percent)
            yield b.select(["a", "b", "na", "nb"]).filter(pa.array(keep))

    return run


def text_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit words of a binary column and the range of each row."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    bounds = np.frombuffer(offsets, kind, column.offset + len(column) + 1)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if len(column) else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), np.uint64), (bounds - bounds[0]) // 8


def _verify(width: int, percent: int):
    """Of rows ``a, b, ta, tb``: whether the sets of the texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part in batch_slices(batches, 512):
                (x, ex), (y, ey) = (sorted_sets(*column_shingles(part.column(c), width)) for c in ("ta", "tb"))
                # Of both sorted sets side by side, equal neighbours are shared.
                link = np.zeros(part.num_rows, bool)
                for k in range(part.num_rows):
                    z = np.concatenate([x[ex[k] : ex[k + 1]], y[ey[k] : ey[k + 1]]])
                    z.sort()
                    both = int(np.count_nonzero(z[1:] == z[:-1]))
                    link[k] = 100 * both >= percent * (len(z) - both)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(link)], ["a", "b", "link"])

    return run


_OPEN = "key long, i int, j int, id long, k long, n int, bits binary, failed array<long>"


def across(ident: np.ndarray, comp: np.ndarray, n: np.ndarray, bits: list[np.ndarray], failed: list, side: np.ndarray, percent: int = PERCENT, forests: int = FORESTS) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of different components that may link, as ``forests`` spanning forests, each of what the ones before leave; and whether that is all.

    ``side``: the block of each set where two blocks meet (only pairs of both
    count), zeros where one is compared with itself.
    """
    words = min(len(x) for x in bits)
    m = np.stack([fold(x, words) for x in bits])
    never = {(int(a), int(b)) for a, bs in zip(ident, failed, strict=True) for b in (bs if bs is not None else ())}
    _, comp = np.unique(comp, return_inverse=True)
    parents = [list(range(int(comp.max()) + 1)) for _ in range(min(forests, len(ident)))]

    def find(parent, x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # Rows of the largest component are compared with the others' only.
    mine = np.flatnonzero(comp != int(np.bincount(comp).argmax()))
    two = bool(side.any())
    out, all_told = [], True
    step = max(1, (2 << 20) // (len(ident) * words * 8 + 1))
    for at in range(0, len(mine), step):
        rows = mine[at : at + step]
        d = np.bitwise_count(m[rows][:, None, :] ^ m[None, :, :]).sum(2, dtype=np.int32)
        most = difference(n[rows][:, None].astype(np.int64), n[None, :], percent)
        ok = (d <= most) & (100 * np.minimum(n[rows][:, None], n[None, :]) >= percent * np.maximum(n[rows][:, None], n[None, :])) & (comp[rows][:, None] != comp[None, :])
        if two:
            ok &= side[rows][:, None] != side[None, :]
        x, y = np.nonzero(ok)
        for k in np.argsort(d[x, y] / np.maximum(most[x, y], 1), kind="stable").tolist():
            i, j = int(rows[x[k]]), int(y[k])
            p = int(ident[i]), int(ident[j])
            if p in never or p[::-1] in never:
                continue
            never.add(p)
            for parent in parents:
                a, b = find(parent, int(comp[i])), find(parent, int(comp[j]))
                if a != b:
                    parent[a] = b
                    out.append(p)
                    break
            else:
                all_told = False
    return out, all_told


def _across(percent: int, forests: int):
    """:func:`across` over rows sorted by key and blocks; a group has 2 * BLOCK bytes of bitmaps at most, or two sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, found = [], None, []

        def close():
            if len(held) > 1:
                ident, comp, n, bits, failed, block = zip(*held, strict=True)
                block = np.array(block) if name[1] != name[2] else np.zeros(len(held), np.int64)
                pairs, all_told = across(np.array(ident), np.array(comp), np.array(n), [np.frombuffer(x, np.uint64) for x in bits], list(failed), block, percent, forests)
                found.extend((name[0], *p, not all_told) for p in pairs)
            held.clear()

        for b in batches:
            rows = b.to_pydict()
            for key, i, j, ident, comp, n, bits, failed, block in zip(*(rows[c] for c in ("key", "i", "j", "id", "k", "n", "bits", "failed", "block")), strict=True):
                if (key, i, j) != name:
                    close()
                    name = key, i, j
                held.append((ident, comp, n, bits, failed, block))
            yield _pairs(found)
            found.clear()
        close()
        yield _pairs(found)

    return run


def _pairs(found: list[tuple[int, int, int, bool]]) -> pa.RecordBatch:
    cols = list(zip(*found, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.bool_()], strict=True)], ["key", "a", "b", "more"])


def frequencies(facts: DataFrame, bases: np.ndarray, percent: int) -> tuple[Allocation, tuple[np.ndarray, np.ndarray]]:
    """The allocation of each band, and the frequent shingles with their cost, from counts over all documents.

    What comes to the driver is bounded: FREQUENT shingles and one row per band.
    """
    counts = facts.where("kind = 1").select(F.col("id").alias("s"), F.col("n").alias("band"), F.col("other").alias("c"))
    top = counts.groupBy("s").agg(F.sum("c").alias("c")).where(f"c >= {LEAST_FREQUENT}").orderBy(F.desc("c"), "s").limit(FREQUENT).toPandas()
    order = np.argsort(top["s"].to_numpy(np.int64).view(np.uint64))
    shingles, c = top["s"].to_numpy(np.int64).view(np.uint64)[order], top["c"].to_numpy(np.int64)[order]
    frequent = shingles, np.clip(np.ceil(2 * np.log2(np.maximum(c, 1))), 1, 63).astype(np.int64)
    least = int(c.min()) if len(c) else LEAST_FREQUENT
    wanted = counts.groupBy("s").agg(F.sum("c").alias("t")).where(f"t >= {least}")
    share = {r["band"]: (r["c"], r["w"]) for r in counts.join(wanted, "s").groupBy("band").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("t").cast("double")).alias("w")).collect()}
    band = F.expr(f"filter(sequence(0, {len(bases) - 1}), k -> element_at(array({', '.join(f'{b}L' for b in bases)}), k + 1) <= n)")
    sizes = facts.where("kind = 0 and n > 0").groupBy((F.size(band) - 1).alias("band")).agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"), F.max("n").alias("largest")).collect()
    hot = {}
    for r in sizes:
        c, w = share.get(r["band"], (0, 0.0))
        hot[r["band"]] = r["sets"], min(c / r["shingles"], 1.0), w / max(c, 1) * min(1.0, r["sets"] / max(sum(x["sets"] for x in sizes), 1))
    return allocate(max([r["largest"] for r in sizes], default=1), hot, percent), frequent


#: Bands up to sets of more shingles than an array may hold.
_ALL_BASES = band_bases(1 << 31)


def components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the lower-cased (A-Z) text; the set
    holds its distinct shingles of ``width`` words, with fewer words the whole
    sequence. Two documents link when ``100 * intersection >= percent *
    union``; the component is the least doc_id reachable by links. Null and
    empty texts have empty sets and link with nothing; very long texts take
    part whole. Rows that repeat a doc_id with the same text come out once
    each with the same values; where texts differ, the rows of a doc_id are
    one document for links, each of its texts is compared, and each row keeps
    the size of its own set. Null doc_ids link with nothing. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(docs[f"`{doc_id}`"].cast("long").alias("i"), as_bytes(text, docs).alias("t"))
    facts = materialize(texts.mapInArrow(_facts(width, _ALL_BASES), _FACTS), "join-facts")
    sets = facts.where("kind = 0 and doc is not null")
    # Two sets of one 64-bit name: a handful among 10**10, told apart by the second name.
    twice = sets.groupBy("id").agg(F.min("other").alias("x"), F.max("other").alias("y")).where("x <> y").select("id").limit(100_001).collect()
    if len(twice) > 100_000:
        raise RuntimeError("too many sets of one name")
    clashes = frozenset(int(np.int64(r["id"]).view(np.uint64)) for r in twice)
    if clashes:
        named = texts.where("i is not null").mapInArrow(_named(width, clashes), "doc long, id long, n int, bits binary")
        sets = materialize(named, "join-sets")
    plan, frequent = frequencies(facts, _ALL_BASES, percent)
    given = spark.sparkContext.broadcast((plan, frequent))  # FREQUENT numbers and one row per band
    buckets = buckets_for(sets.agg(F.sum("n")).first()[0] or 0)  # a set has fewer keys than shingles, but for deletions
    rows = shuffled(texts.where("i is not null").mapInArrow(_emit(width, given, clashes, buckets), SCHEMA))
    keys = materialize(rows.mapInArrow(_groups, _PAIRS), "join-keys")
    del rows
    release(spark)
    met = keys.select("key", F.explode(F.array(F.struct(F.col("rep").alias("id"), F.col("rn").alias("n")), F.struct("id", "n"))).alias("s")).select("key", "s.*").distinct()
    met = materialize(met, "join-met")
    # One document stands for each set. Only sets that share a key with another go on, with their bitmaps and texts.
    classes = materialize(sets.groupBy("id").agg(F.min("doc").alias("rep_doc"), F.max("n").alias("n")), "join-classes")
    wanted, seen = materialize_with(met.select("id").distinct().join(classes, "id").select("id", F.col("rep_doc").alias("i"), "n"), "join-wanted", F.count("*").alias("n"))
    chosen = _sent(wanted.select("id", "i"), seen["n"])
    bits = sets.select("id", F.col("doc").alias("i"), "bits").join(chosen, ["id", "i"])
    bits = materialize(bits.groupBy("id").agg(F.max("bits").alias("bits")).join(wanted.select("id", "n"), "id"), "join-bits")
    # From here on the sets are told by their names alone: what held their bitmaps and the counts of shingles goes.
    members = materialize(sets.select("doc", "id", "n"), "join-members")
    bare = materialize(facts.where("kind = 0 and doc is null").select("n"), "join-bare")
    remove(spark, facts, *([sets] if clashes else []))
    release(spark)
    fitting = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    turn = F.col("rep") < F.col("id")
    pairs = keys.select(F.least("rep", "id").alias("a"), F.greatest("rep", "id").alias("b"), F.when(turn, F.col("rn")).otherwise(F.col("n")).alias("na"), F.when(turn, F.col("n")).otherwise(F.col("rn")).alias("nb")).where(fitting).distinct()
    pairs = pairs.join(bits.select(F.col("id").alias("a"), F.col("bits").alias("ba")), "a").join(bits.select(F.col("id").alias("b"), F.col("bits").alias("bb")), "b")
    pairs = materialize(pairs.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(_within(percent), "a long, b long, na int, nb int"), "join-pairs")
    remove(spark, keys)
    release(spark)
    held = texts.join(chosen, "i").select("id", "t")
    if _any(_many_texts(members)):
        held = held.mapInArrow(_check_names(width, clashes), "id long, t binary")
    held = materialize(held.dropDuplicates(["id"]), "join-texts")
    remove(spark, wanted)
    release(spark)
    done = _verified(held, pairs, percent, width)
    remove(spark, pairs)
    links, failed = done.where("link").select("a", "b"), done.where("not link").select("a", "b")
    reach, first, forests = connected_components(links), True, FORESTS
    while True:
        # Keys of several components; of keys with the very same sets, one.
        rows = (met if first else met.join(keys, "key")).join(reach, met["id"] == reach["node"], "left").select("key", "id", "n", F.coalesce("component", "id").alias("k"))
        # A group too large for one task meets in pairs of blocks; a bitmap has half a byte for each shingle at most, and 8 bytes at least.
        blocks = F.greatest(F.ceil(F.sum(F.col("n") / 2 + 8) / BLOCK), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks")
        mixed = rows.groupBy("key").agg(F.min("k").alias("k0"), F.max("k").alias("k1"), F.count("*").alias("c"), F.bit_xor(F.xxhash64("id")).alias("h0"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("h1"), blocks).where("k0 <> k1")
        mixed = materialize(mixed.groupBy("c", "h0", "h1").agg(F.min(F.struct("key", "blocks")).alias("m")).select("m.*"), "join-mixed")
        rows = rows.drop("n").join(mixed, "key", "left_semi").join(bits, "id")
        # One list per set: of a set's failed pairs, which are pairs that are nearly similar enough.
        lists = failed.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("failed"))
        rows = rows.join(lists, "id", "left")
        rows = rows.join(mixed.where("blocks > 1"), "key", "left").na.fill(1, ["blocks"])
        rows = rows.withColumn("block", F.expr("cast(pmod(xxhash64(id, 7), blocks) as int)")).withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
        rows = rows.select("key", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "id", "k", "n", "bits", "failed", "block")
        rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        found = materialize(rows.mapInArrow(_across(percent, forests), "key long, a long, b long, more boolean"), "join-open")
        remove(spark, mixed, *([] if first else [keys]))
        if not _any(found):
            break
        release(spark)
        done = _verified(held, found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), percent, width)
        grown = _extended(reach, done.where("link").select("a", "b"))
        remove(spark, reach)
        reach = grown
        # Few keys have more pairs than that, of sets that are nearly similar enough; they tell so many more at once that rounds are few.
        keys, first, forests = materialize(found.where("more").select("key").distinct(), "join-open-keys"), False, forests * MORE
        remove(spark, found)
        if not _any(keys):
            break
        more = materialize(failed.union(done.where("not link").select("a", "b")), "join-failed")
        remove(spark, failed, done)
        failed = more
    remove(spark, met, bits, held)
    release(spark)
    return _labelled(members, bare, classes, reach)


def _extended(reach: DataFrame, links: DataFrame) -> DataFrame:
    """Components with new links between them."""
    a, b = (reach.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b"))
    over = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    top = connected_components(over).select(F.col("node").alias("n"), F.col("component").alias("c"))
    grown = reach.join(top, reach["component"] == top["n"], "left").select("node", F.coalesce("c", "component").alias("component"))
    fresh = top.join(reach, top["n"] == reach["node"], "left_anti").select(F.col("n").alias("node"), F.col("c").alias("component"))
    return materialize(grown.union(fresh), "join-reach")


def _named(width: int, clashes: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part in batch_slices(batches):
                u, edge = sorted_sets(*column_shingles(part.column("t"), width))
                yield pa.RecordBatch.from_arrays([part.column("i"), pa.array(to_signed(_ids(u, edge, clashes))), pa.array(np.diff(edge).astype(np.int32)), pa.array(bitmaps(u, edge), pa.binary())], ["doc", "id", "n", "bits"])

    return run


def _check_names(width: int, clashes: frozenset):
    """Rows whose text has the set that ``id`` names: of a doc_id with several texts not all do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part in batch_slices(batches):
                mine = _ids(*sorted_sets(*column_shingles(part.column("t"), width)), clashes)
                yield part.select(["id", "t"]).filter(pa.array(to_signed(mine) == part.column("id").to_numpy()))

    return run


def _many_texts(sets: DataFrame) -> DataFrame:
    """doc_ids whose rows have different sets."""
    return sets.groupBy("doc").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("doc")


def _labelled(sets: DataFrame, bare: DataFrame, classes: DataFrame, reach: DataFrame) -> DataFrame:
    """The result: components of sets as components of documents; ``bare`` are rows without a doc_id."""
    ids = classes.join(reach, classes["id"] == reach["node"], "left").select("id", "rep_doc", "n", F.coalesce("component", "id").alias("component"))
    least = ids.groupBy("component").agg(F.min("rep_doc").alias("least"))
    ids = ids.join(least, "component").select("id", F.col("n").alias("size"), "least")
    members = sets.join(ids, "id").select("doc", "n", F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc")).alias("least"))
    several = members.groupBy("doc").agg(F.min("least").alias("x"), F.max("least").alias("y")).where("x <> y")
    if _any(several):
        # The texts of one doc_id are one document, so their components are one.
        edges = members.join(several, "doc", "left_semi").select(F.col("doc").alias("a"), F.col("least").alias("b"))
        top = connected_components(edges)
        members = members.join(top, members["least"] == top["node"], "left").select("doc", "n", F.coalesce("component", "least").alias("least"))
        members = members.join(members.groupBy(F.col("doc").alias("d")).agg(F.min("least").alias("l")), F.col("doc") == F.col("d")).select("doc", "n", F.col("l").alias("least"))
    out = members.select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"))
    return out.union(bare.select(F.lit(None).cast("long"), F.col("n").cast("long"), F.lit(None).cast("long")))


def _verified(texts: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """``a, b, link`` of each pair, from the whole texts; only texts of these pairs move."""
    pairs = materialize(pairs.select("a", "b"), "join-asked")
    wanted, seen = materialize_with(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "join-ids", F.count("*").alias("n"))
    texts = texts.join(_sent(wanted, seen["n"]), "id", "left_semi")
    rows = pairs.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    rows = rows.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").select("a", "b", "ta", "tb")
    done = materialize(rows.mapInArrow(_verify(width, percent), "a long, b long, link boolean"), "join-done")
    remove(texts.sparkSession, pairs, wanted)
    release(texts.sparkSession)
    return done


def _sent(ids: DataFrame, n: int) -> DataFrame:
    """A table of so many ids, sent to every task while it is small, so that what it is met with needn't move."""
    return F.broadcast(ids) if n <= SENT else ids


def _any(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) without those that link, directly or not, to a smaller doc_id.

    Rows of a null doc_id stay; repeated rows of one doc_id stay as they are;
    documents without words stay. An empty table gives an empty result.
    """
    gone = components(docs, **options).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")

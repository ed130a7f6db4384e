"""Sharding by best-fit-decreasing bin packing (operator 8).

Documents of equal text are one group and never part. Groups are packed largest
first, each into the bin with the tightest room that holds it, found in a
balanced tree. Groups of one size are interchangeable, so the packing deals
sizes and numbers, which are few, and ranks tell which group of a size is
meant.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.session import materialize

#: Groups over this part of all bytes are packed by name; the most sizes of others; rows of a section that are counted in order.
HEAVY, CLASSES, SECTION = 4096, 1_000_000, 50_000
SHARDS = 8


class _Node:
    __slots__ = ("key", "left", "level", "right")

    def __init__(self, key):
        self.key, self.left, self.right, self.level = key, None, None, 1


class RoomTree:
    """A balanced search tree (AA tree) of ``(room, bin)`` with best-fit look-up."""

    def __init__(self):
        self.root: _Node | None = None

    @staticmethod
    def _skew(t):
        if t.left is not None and t.left.level == t.level:
            l = t.left
            t.left, l.right = l.right, t
            return l
        return t

    @staticmethod
    def _split(t):
        if t.right is not None and t.right.right is not None and t.level == t.right.right.level:
            r = t.right
            t.right, r.left = r.left, t
            r.level += 1
            return r
        return t

    def add(self, key: tuple[int, int]) -> None:
        def into(t):
            if t is None:
                return _Node(key)
            if key < t.key:
                t.left = into(t.left)
            else:
                t.right = into(t.right)
            return self._split(self._skew(t))

        self.root = into(self.root)

    def drop(self, key: tuple[int, int]) -> None:
        def level(t):
            return t.level if t is not None else 0

        def out(t, key):
            if t is None:
                return None
            if key < t.key:
                t.left = out(t.left, key)
            elif key > t.key:
                t.right = out(t.right, key)
            elif t.left is None and t.right is None:
                return None
            elif t.left is None:
                s = t.right
                while s.left is not None:
                    s = s.left
                t.key, t.right = s.key, out(t.right, s.key)
            else:
                s = t.left
                while s.right is not None:
                    s = s.right
                t.key, t.left = s.key, out(t.left, s.key)
            low = min(level(t.left), level(t.right)) + 1
            if low < t.level:
                t.level = low
                if t.right is not None and t.right.level > low:
                    t.right.level = low
            t = self._skew(t)
            if t.right is not None:
                t.right = self._skew(t.right)
                if t.right.right is not None:
                    t.right.right = self._skew(t.right.right)
            t = self._split(t)
            if t.right is not None:
                t.right = self._split(t.right)
            return t

        self.root = out(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least room of ``size`` or more, of the lowest bin; None if there is none."""
        t, best = self.root, None
        while t is not None:
            if t.key >= (size, -1):
                best, t = t.key, t.left
            else:
                t = t.right
        return best


def best_fit_decreasing(classes: Iterable[tuple[int, int]], capacity: int, most: int | None = None) -> list[list[tuple[int, int]]] | None:
    """Best fit decreasing of ``count`` items of each ``size``: by class, in the order given, the bins it goes to and how many to each.

    Items are taken largest first, each into the tightest bin that has room.
    Equal items follow one another into that bin as long as it has room, so a
    class is dealt by runs. None if more than ``most`` bins would be needed;
    an item over the capacity gets a bin of its own.
    """
    classes = list(classes)
    out: list[list[tuple[int, int]]] = [[] for _ in classes]
    tree, bins = RoomTree(), 0
    for at in sorted(range(len(classes)), key=lambda k: -classes[k][0]):
        size, left = classes[at]
        while left:
            found = tree.tightest(size)
            if found is None:
                if bins == most:
                    return None
                room, name = max(capacity, size), bins
                bins += 1
            else:
                tree.drop(found)
                room, name = found
            take = min(left, room // size)
            out[at].append((name, take))
            left -= take
            if room > take * size:
                tree.add((room - take * size, name))
    return out


def pack_into(classes: list[tuple[int, int]], shards: int) -> list[list[tuple[int, int]]]:
    """The classes in at most ``shards`` bins of the least capacity for which best fit decreasing succeeds."""
    if not classes:
        return []
    total, largest = sum(s * c for s, c in classes), max(s for s, _ in classes)
    low = max(largest, -(-total // shards))
    high = low
    while (best := best_fit_decreasing(classes, high, shards)) is None:
        low, high = high + 1, high + max(largest, high - low + 1)
    while low < high:
        mid = (low + high) // 2
        if (found := best_fit_decreasing(classes, mid, shards)) is not None:
            high, best = mid, found
        else:
            low = mid + 1
    return best


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def assign_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Shard and slot of every document so that the shards' bytes are near equal.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one
    row per input row (repeated rows stay, each with its slot). Null and empty
    texts are one group, of size 1 a row and crc32 0; an empty table gives an
    empty result; other columns are ignored. Slots count from 0 in each shard.

    Groups of equal size are interchangeable, so the driver packs sizes with
    their numbers: HEAVY groups at most that are larger than that part of all
    bytes, and as many sizes below as there are, CLASSES at most (with more,
    sizes are rounded up to a multiple). Which group of a size goes where
    follows from its rank, counted by sections, and so do the slots.
    """
    spark = docs.sparkSession
    col = docs[f"`{text}`"]
    rows = docs.select(
        docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
        text_size(col).alias("size"),
        F.coalesce(F.crc32(col.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce(col, F.lit(""))).alias("g"),
    )
    rows = materialize(rows, "shard-rows")
    groups = materialize(rows.groupBy("g").agg(F.sum("size").alias("w"), F.count("*").alias("n")), "shard-groups")
    total, count = (int(x or 0) for x in groups.agg(F.sum("w"), F.sum("n")).first())
    mean = max(1, -(-total // HEAVY))
    heavy = sorted((-r["w"], r["g"]) for r in groups.where(F.col("w") > mean).select("g", "w").collect())  # under HEAVY by construction
    light = groups.where(F.col("w") <= mean)
    step = 1 if light.select("w").distinct().limit(CLASSES + 1).count() <= CLASSES else -(-mean // CLASSES)
    light = light.select("g", (F.ceil(F.col("w") / step) * step).cast("long").alias("w"))
    classes = [(r["w"], r["c"]) for r in light.groupBy("w").agg(F.count("*").alias("c")).orderBy("w").collect()]  # CLASSES at most
    dealt = pack_into([(-w, 1) for w, _ in heavy] + classes, shards)
    own = spark.createDataFrame([(g, dealt[k][0][0]) for k, (_, g) in enumerate(heavy)], "g long, own int")
    runs = []
    for (w, _), parts in zip(classes, dealt[len(heavy) :], strict=True):
        start = 0
        for name, n in parts:
            runs.append((w, start, start + n, name))
            start += n
    # The rank of a group among those of its size: groups of the sections before, and its place in its own.
    sections = max(1, -(-count // SECTION))
    light = light.withColumn("s", F.pmod(F.xxhash64("g", F.lit(5)), F.lit(sections)))
    ahead = light.groupBy("w", "s").agg(F.count("*").alias("c"))
    ahead = ahead.withColumn("ahead", F.expr("coalesce(sum(c) over (partition by w order by s rows between unbounded preceding and 1 preceding), 0)")).drop("c")
    light = light.join(ahead, ["w", "s"]).withColumn("rank", F.col("ahead") + F.expr("row_number() over (partition by w, s order by g)") - 1)
    table = spark.createDataFrame(runs, "w long, from long, to long, shard int")
    light = light.join(table, "w").where("rank >= from and rank < to").select("g", "shard")
    # Rows of heavy groups don't meet in a task: those few groups are known everywhere.
    rows = rows.join(F.broadcast(own), "g", "left")
    placed = rows.where("own is not null").withColumnRenamed("own", "shard").union(rows.where("own is null").drop("own").join(light, "g").select("g", "doc_id", "size", "text_crc32", "shard"))
    placed = materialize(placed.withColumn("s", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(sections))), "shard-placed")
    before = placed.groupBy("shard", "s").agg(F.count("*").alias("c"))
    before = before.withColumn("ahead", F.expr("coalesce(sum(c) over (partition by shard order by s rows between unbounded preceding and 1 preceding), 0)")).drop("c")
    rows = placed.withColumn("r", F.expr("row_number() over (partition by shard, s order by doc_id, text_crc32)")).join(before, ["shard", "s"])
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("ahead") + F.col("r") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

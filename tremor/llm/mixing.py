"""Mixing sources to target weights (operator 2).

Temperature mixing: a source's weight is its share of the tokens to the power
``alpha``, normalised. The exponent is bisected to the largest one that
reaches a target entropy (as a part of the greatest), and raised again where
the weights would repeat a source more often than a limit allows. The weights
are then realised as block permutations under a token budget: each source's
documents form blocks of some hundred, each epoch reads them in its own
pseudo-random order, and the last epoch stops where the source's budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.session import materialize

#: Share of the greatest entropy that the weights must reach, and the most epochs of any source.
ENTROPY_SHARE, MAX_EPOCHS = 0.95, 4.0
BLOCK_ROWS, SEED = 256, 20240229
#: Blocks are summed up in order by so many ranges of a source, then each by itself.
RANGES = 4096


def weights_at(tokens: list[float], alpha: float) -> list[float]:
    """Normalised shares to the power ``alpha``; sources without tokens get none."""
    total = sum(tokens)
    logs = [alpha * math.log(t / total) if t > 0 else None for t in tokens]
    top = max((x for x in logs if x is not None), default=0.0)
    raw = [math.exp(x - top) if x is not None else 0.0 for x in logs]
    s = sum(raw)
    return [x / s for x in raw] if s else raw


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect_exponent(tokens: list[float], budget: float, share: float = ENTROPY_SHARE, max_epochs: float = MAX_EPOCHS) -> float:
    """The exponent in [0, 1]: the largest that reaches the entropy, but no less than the repetition limit asks.

    Entropy falls and the repetition of small sources falls as the exponent
    grows, so both bounds are found by bisection. Where they contradict, the
    repetition limit holds; a budget beyond it even at exponent 1 leaves 1.
    """
    full = [t for t in tokens if t > 0]
    if len(full) < 2:
        return 1.0

    def edge(good) -> tuple[float, float]:
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if good(mid) else (low, mid)
        return low, high

    target = share * math.log(len(full))
    by_entropy = 1.0 if entropy(weights_at(full, 1.0)) >= target else edge(lambda a: entropy(weights_at(full, a)) >= target)[0]

    def repeats(a: float) -> bool:
        return max(w * budget / t for w, t in zip(weights_at(full, a), full, strict=True)) > max_epochs

    by_repeats = 0.0 if not repeats(0.0) else edge(repeats)[1]
    return max(by_entropy, by_repeats)


def word_count(text: str = "text"):
    """Tokens for mixing: words ``[^\\x20\\x09-\\x0D]+`` (null: none)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plan(docs: DataFrame, budget: int | None = None, share: float = ENTROPY_SHARE, max_epochs: float = MAX_EPOCHS, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The mixed stream: one row per reading of a document.

    Returns ``doc_id, source, h, n_tokens, weight, epoch, token_start`` (``h``: hash of the text):
    ``token_start`` is where the reading begins in its source's stream.
    Readings of a source stop before the one that would begin at or beyond
    ``weight * budget`` tokens; the budget's default is the corpus' tokens.
    Repeated rows are read each.

    A null source is a source of its own; a document without words takes no
    tokens and stays in every epoch of its source that is read whole or up to
    it; an empty table gives an empty result. Only one row per source reaches
    the driver. A block is a few hundred rows by hash, so a source with a
    third of the corpus is spread over its blocks; what is summed in order
    are blocks, not rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("n_tokens"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    rows = materialize(rows, "mix-rows")
    per = rows.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()
    per.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    tokens = [float(r["t"]) for r in per]
    limit = float(sum(tokens) if budget is None else budget)
    alpha = bisect_exponent(tokens, limit, share, max_epochs)
    sources = [(r["source"], w, w * limit, float(r["t"]), -(-r["n"] // BLOCK_ROWS), epochs(w * limit, r["t"])) for r, w in zip(per, weights_at(tokens, alpha), strict=True)]
    table = spark.createDataFrame(sources, "source string, weight double, room double, tokens double, blocks long, epochs int")
    rows = rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).drop(table["source"])  # one row per source
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "h", F.lit(SEED)), F.col("blocks")))
    blocks = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("bt"), F.first("epochs").alias("epochs"), F.first("tokens").alias("tokens"), F.first("room").alias("room"))
    blocks = blocks.withColumn("epoch", F.explode(F.expr("sequence(0, epochs - 1)")))
    blocks = blocks.withColumn("order", F.xxhash64("source", "block", "epoch", F.lit(SEED)))
    # Sums in order at two levels: over RANGES ranges of the order, and over the blocks of one range.
    blocks = blocks.withColumn("range", F.expr(f"floor((cast(`order` as double) + pow(2, 63)) / pow(2, 64) * {RANGES})"))
    ranges = blocks.groupBy("source", "epoch", "range").agg(F.sum("bt").alias("rt"))
    ranges = ranges.select(F.col("source").alias("rs"), F.col("epoch").alias("re"), F.col("range").alias("rr"), F.expr("coalesce(sum(rt) over (partition by source, epoch order by range rows between unbounded preceding and 1 preceding), 0)").alias("ahead"))
    blocks = blocks.join(ranges, blocks["source"].eqNullSafe(F.col("rs")) & (blocks["epoch"] == F.col("re")) & (blocks["range"] == F.col("rr")))
    before = F.expr("ahead + coalesce(sum(bt) over (partition by source, epoch, range order by `order`, block rows between unbounded preceding and 1 preceding), 0)")
    blocks = blocks.withColumn("start", F.col("epoch") * F.col("tokens") + before).where("start < room or (start = 0 and tokens = 0)")
    blocks = blocks.select(F.col("source").alias("bs"), F.col("block").alias("bb"), "epoch", "start")
    rows = rows.join(blocks, rows["source"].eqNullSafe(F.col("bs")) & (rows["block"] == F.col("bb")))
    inside = "(partition by source, block, epoch order by xxhash64(doc_id, epoch, h), doc_id, h rows between unbounded preceding and 1 preceding)"
    rows = rows.withColumn("token_start", F.col("start") + F.expr(f"coalesce(sum(n_tokens) over {inside}, 0)"))
    rows = rows.where("token_start < room or tokens = 0")
    return rows.select("doc_id", "source", "h", "n_tokens", "weight", "epoch", F.col("token_start").cast("long").alias("token_start"))


def epochs(room: float, tokens: float) -> int:
    """Epochs that are begun: a source without tokens is read once."""
    return max(1, math.ceil(room / tokens - 1e-9)) if tokens > 0 else 1


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) as often as the plan reads them.

    Rows equal in doc_id, source and text are read equally often, the total
    rounded up to a multiple of their number.
    """
    key = [F.col("doc_id").cast("long").alias("_d"), F.col("source").cast("string").alias("_s"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_h")]
    times = plan(docs, **options).groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("h").alias("_h")).agg(F.count("*").alias("_t"))
    copies = docs.select(*key).groupBy("_d", "_s", "_h").agg(F.count("*").alias("_c"))
    a, b = times.alias("a"), copies.alias("b")
    per = a.join(b, F.expr("a._d <=> b._d and a._s <=> b._s and a._h = b._h")).select("a._d", "a._s", "a._h", F.expr("cast(ceil(_t / _c) as int) as _n"))
    rows, p = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *key).alias("r"), per.alias("p")
    found = rows.join(p, F.expr("r._d <=> p._d and r._h = p._h and r._s <=> p._s"))
    return found.withColumn("_e", F.explode(F.expr("sequence(1, _n)"))).select("row.*")

"""Pick tables: normalisation, filters, station lookup, removal and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.components import connected_components
from tremor.session import materialize

#: Names of the second input layout and what they become.
SECOND_LAYOUT = {"seedid": "station_id", "phasename": "phase_type", "time": "phase_time", "probability": "phase_score"}
KEY = ["station_id", "phase_type", "phase_time"]


def micros(t: Column) -> Column:
    """Microseconds since the epoch of a time with or without zone (UTC)."""
    return F.unix_micros(t.cast("timestamp"))


def round_time(t: Column, step: int = 100) -> Column:
    """A time rounded to ``step`` microseconds, halves to even."""
    return F.timestamp_micros((F.bround(micros(t).cast("decimal(20,0)") / step, 0) * step).cast("bigint"))


def to_official_layout(df: DataFrame) -> DataFrame:
    """Columns of the second layout under the names of the first; the official layout passes unchanged."""
    return df if "station_id" in df.columns else df.withColumnsRenamed({k: v for k, v in SECOND_LAYOUT.items() if k in df.columns})


def require(df: DataFrame, *names: str) -> DataFrame:
    """The frame itself; an error where any of the columns is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def normalize(df: DataFrame) -> DataFrame:
    """Rounded times, NaN scores as null, ids as NET.STA with both parts apart, no fake picks."""
    df = require(to_official_layout(df), "station_id", "phase_type", "phase_time", "phase_score")
    if "phase_index" in df.columns:
        df = df.where("phase_index <> 1 or phase_index is null")
    df = df.withColumn("station_id", F.substring_index("station_id", ".", 2))
    return df.withColumns({
        "phase_time": round_time(F.col("phase_time")),
        "phase_score": F.when(~F.isnan("phase_score"), F.col("phase_score")),
        "network": F.split_part("station_id", F.lit("."), F.lit(1)),
        "station": F.split_part("station_id", F.lit("."), F.lit(2)),
    })


def in_range(df: DataFrame, begin=None, end=None) -> DataFrame:
    """Picks of a closed time range; an open side is None."""
    if begin is not None:
        df = df.where(F.col("phase_time") >= begin)
    return df if end is None else df.where(F.col("phase_time") <= end)


def without_stations(df: DataFrame, patterns: list[str]) -> DataFrame:
    """Picks whose station id matches none of the regular expressions (anywhere in the id)."""
    for p in patterns:
        df = df.where(F.coalesce(~F.col("station_id").rlike(p), F.lit(True)))
    return df


def blacklist_counts(df: DataFrame, patterns: list[str]) -> DataFrame:
    """``entry, removed``: rows that each entry removes, in order, in one pass."""
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("entry"), F.coalesce(F.col("station_id").rlike(p), F.lit(False)).alias("hit")) for i, p in enumerate(patterns)])
    hit = df.select(F.try_element_at(F.filter(entries, lambda e: e["hit"]), F.lit(1)).alias("e")).where("e is not null")
    return hit.groupBy("e.entry").agg(F.count("*").alias("removed"))


def above_threshold(df: DataFrame, p: float, s: float) -> DataFrame:
    """Drops picks of exactly P or S below their probability (or without one); other phases pass."""
    low = lambda phase, t: (F.col("phase_type") == phase) & (F.coalesce("phase_score", F.lit(-1.0)) < t)
    return df.where(~(F.coalesce(low("P", p) | low("S", s), F.lit(False))))


def unpivot_detections(df: DataFrame, p: float, s: float) -> DataFrame:
    """One row per P and S arrival of wide detections with a probability that isn't 0 and reaches its threshold."""
    keep = [c for c in df.columns if not c.startswith(("p_", "s_"))]
    arms = "stack(2, 'P', p_arrival_time, p_probability, 'S', s_arrival_time, s_probability) as (phase_type, phase_time, phase_score)"
    out = df.selectExpr(*keep, arms)
    return out.where(f"phase_score <> 0 and phase_score >= case phase_type when 'P' then {p} else {s} end")


def detection_time(df: DataFrame) -> DataFrame:
    """Wide detections with ``phase_time``, the earlier of both arrivals."""
    return df.withColumn("phase_time", F.least("p_arrival_time", "s_arrival_time"))


def with_coordinates(picks: DataFrame, stations: DataFrame) -> DataFrame:
    """Picks with the coordinates of the first station row that is valid at their time; others are dropped.

    ``stations`` may have ``channel``, ``start_date`` and ``end_date``. The
    rows of a station are one sorted array, so a pick finds its row without
    being grouped: the station table joins by its keys, and Spark broadcasts
    it while it is small.
    """
    order = [c for c in ("channel", "start_date") if c in stations.columns]
    row = F.struct(*order, "latitude", "longitude", "elevation", *(["end_date"] if "end_date" in stations.columns else []))
    epochs = stations.groupBy("network", "station").agg(F.sort_array(F.collect_list(row)).alias("_epochs"))  # of one station
    day = F.to_date(picks["phase_time"])

    def valid(e: Column) -> Column:
        good = F.lit(True)
        if "start_date" in stations.columns:
            good &= e["start_date"].isNull() | (e["start_date"] <= day)
        if "end_date" in stations.columns:
            good &= e["end_date"].isNull() | (e["end_date"] >= day)
        return good

    best = picks.join(epochs, ["network", "station"]).withColumn("_s", F.get(F.filter("_epochs", valid), F.lit(0))).where("_s is not null")
    return best.select(*picks.columns, "_s.latitude", "_s.longitude", "_s.elevation")


def unload(picks: DataFrame, used: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Picks that are not among the used ones (exact station, phase and time)."""
    return picks.join(used.select(*keys).distinct(), keys, "left_anti")


def phase_family(phase: Column) -> Column:
    """P for names that hold a P, else S for those that hold an S, else null."""
    return F.when(phase.contains("P"), "P").when(phase.contains("S"), "S")


def first_letter(phase: Column) -> Column:
    """Phase as associators take it: its first letter, upper case."""
    return F.upper(F.substring(phase, 1, 1))


def dedup_close(picks: DataFrame, p_seconds: float = 0.1, s_seconds: float = 0.2, bin_seconds: float = 3600.0) -> DataFrame:
    """One pick of each run of close picks (same station and phase family, gaps within the limit).

    The best score stays; on ties the greater phase name, then the earlier
    time. Picks of neither family pass. Runs are found inside bins of time,
    and those that meet at a bin's edge are joined as components, so nothing
    holds all that a station has recorded.
    """
    family = phase_family(F.col("phase_type"))
    width = round(max(bin_seconds, 2 * p_seconds, 2 * s_seconds) * 1e6)
    limit = F.when(F.col("_family") == "P", round(p_seconds * 1e6)).otherwise(round(s_seconds * 1e6))
    every = picks.withColumn("_family", family).withColumn("_us", micros(F.col("phase_time")))
    df = every.where("_family is not null").withColumn("_bin", F.expr(f"_us div {width}"))
    by = ["station_id", "_family", "_bin"]
    inside = Window.partitionBy(*by).orderBy("_us")
    df = df.withColumn("_new", F.coalesce((F.col("_us") - F.lag("_us").over(inside) > limit).cast("int"), F.lit(0)))
    df = df.withColumn("_run", F.sum("_new").over(inside))
    best = F.max(F.struct("phase_score", "phase_type", (-F.col("_us")).alias("_neg"), F.struct(*[F.col(f"`{c}`") for c in picks.columns]).alias("row")))
    runs = df.groupBy(*by, "_run").agg(best.alias("_best"), F.min("_us").alias("_from"), F.max("_us").alias("_to"))
    runs = materialize(runs.withColumn("_id", F.monotonically_increasing_id()), "runs")
    # A run goes on in the next bin where the gap between them is within the limit; a bin is wider than that.
    last = runs.select(F.col("station_id").alias("_s"), F.col("_family").alias("_f"), (F.col("_bin") + 1).alias("_b"), F.col("_to").alias("_before"), F.col("_id").alias("a"))
    met = runs.where("_run = 0").join(last, F.expr("station_id <=> _s and _family = _f and _bin = _b")).where(F.col("_from") - F.col("_before") <= limit)
    edges = materialize(met.select("a", F.col("_id").alias("b")), "run-links")
    reach = connected_components(edges)
    whole = runs.join(reach, F.col("_id") == F.col("node"), "left").groupBy(F.coalesce("component", "_id").alias("_id")).agg(F.max("_best").alias("_best"))
    kept = whole.select(*[F.col("_best.row")[c].alias(c) for c in picks.columns])
    return kept.union(every.where("_family is null").select(*[F.col(f"`{c}`") for c in picks.columns]))


def uncertainty(phase: Column, p: float = 0.1, s: float = 0.2, any_case: bool = False) -> Column:
    """Pick uncertainty in seconds by phase family (P first); null for other names."""
    name = F.upper(phase) if any_case else phase
    return F.when(name.contains("P"), p).when(name.contains("S"), s)

"""Readers and writers of text tables: picks, stations, hints, bulletins, scatter clouds, reports.

Schemas are explicit; headers are read once to choose a layout, never to infer types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.clusters import observation_lines
from tremor.operators.picks import SECOND_LAYOUT, to_official_layout

TYPES = {
    "station_id": "string", "phase_type": "string", "phase_time": "timestamp", "phase_score": "double", "eventid": "string", "agency": "string", "phase_index": "int",
    "seedid": "string", "phasename": "string", "time": "timestamp", "probability": "double",
    "network": "string", "station": "string", "station_lat": "double", "station_lon": "double", "station_elv": "double",
    "p_arrival_time": "timestamp", "p_probability": "double", "s_arrival_time": "timestamp", "s_probability": "double",
}


def _typed(spark: SparkSession, path, types: dict[str, str], sep: str = ",") -> DataFrame:
    """CSV with a header; known columns get their types, others stay text."""
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def read_picks(spark: SparkSession, path) -> DataFrame:
    """Picks of either layout under the official names; none of the required columns may miss."""
    df = to_official_layout(_typed(spark, path, TYPES))
    missing = [c for c in ("station_id", "phase_type", "phase_time", "phase_score") if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_detections(spark: SparkSession, path) -> DataFrame:
    """Wide detections (a P and an S arrival per row) with station_id as NET.STA where it is missing."""
    df = _typed(spark, path, TYPES)
    missing = [c for c in ("network", "station", "p_arrival_time", "p_probability", "s_arrival_time", "s_probability") if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df if "station_id" in df.columns else df.withColumn("station_id", F.concat_ws(".", "network", "station"))


def write_picks(df: DataFrame, path: str) -> None:
    """Picks of the official layout as CSV of the second, times to the microsecond; never over existing output."""
    back = {v: k for k, v in SECOND_LAYOUT.items()}
    out = df.withColumn("phase_time", F.date_format(F.col("phase_time").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).withColumnsRenamed(back)
    keep = [c for c in ("seedid", "phasename", "time", "probability", "eventid", "agency") if c in out.columns]
    out.select(*keep).write.mode("errorifexists").option("header", True).csv(path)


def read_stations(spark: SparkSession, path) -> DataFrame:
    """Station text as web services give it: fields between bars, a header that begins with #, padded values."""
    raw = spark.read.text(path, wholetext=True).select(F.split("value", "\n").alias("lines"))
    head = raw.select(F.split(F.regexp_replace(raw["lines"][0], "^#", ""), r"\|").alias("h"), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))).alias("rest"))
    rows = head.select(F.transform("h", lambda x: F.lower(F.trim(x))).alias("h"), F.explode("rest").alias("line")).where("trim(line) <> '' and line not like '#%'")
    pairs = F.map_from_arrays("h", F.transform(F.slice(F.split("line", r"\|"), 1, F.size("h")), lambda x: F.trim(x)))
    m = rows.select(pairs.alias("m"))
    get = lambda k, t="string": F.expr(f"try_cast(nullif(m['{k}'], '') as {t})")
    return m.select(get("network").alias("network"), get("station").alias("station"), get("channel").alias("channel"), get("latitude", "double").alias("latitude"), get("longitude", "double").alias("longitude"), get("elevation", "double").alias("elevation"), get("starttime", "timestamp").cast("date").alias("start_date"), get("endtime", "timestamp").cast("date").alias("end_date"))


def read_hints(spark: SparkSession, path) -> DataFrame:
    """Channel hints NET_STA_LOC_CHAN, one a line, in order; the channel without its last letter; repeats dropped."""
    lines = spark.read.text(path).withColumn("ord", F.monotonically_increasing_id()).where("trim(value) <> ''")
    part = F.split("value", "_")
    rows = lines.select("ord", *[F.coalesce(F.get(part, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(("network", "station", "location", "channel"))])
    rows = rows.withColumn("channel", F.expr("substring(channel, 1, greatest(length(trim(channel)) - 1, 0))"))
    return rows.groupBy("network", "station", "location", "channel").agg(F.min("ord").alias("ord"))


def read_bulletins(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Bulletins of several files as one table, the four columns that matter."""
    types = {"event_id": "string", "time": "timestamp", "latitude": "double", "longitude": "double"}
    parts = [_typed(spark, p, types).select(*types) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_merge_info(spark: SparkSession, path) -> DataFrame:
    """Merge table with an empty list of agencies where it is null."""
    return _typed(spark, path, {"time": "timestamp", "nb_agencies": "int"}).na.fill("", ["agencies_list"])


def read_scatter(spark: SparkSession, path) -> DataFrame:
    """Scatter cloud: three header lines, then latitude, longitude, depth, h1 and h2 between white space."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", "\n").alias("l"))
    rows = lines.select(F.explode(F.slice("l", 4, F.greatest(F.size("l") - 3, F.lit(0)))).alias("line")).where("trim(line) <> ''")
    part = F.split(F.trim("line"), r"\s+")
    return rows.select(*[F.get(part, F.lit(i)).cast("double").alias(n) for i, n in enumerate(("latitude", "longitude", "depth", "h1", "h2"))])


def write_report(df: DataFrame, path: str, order: str) -> None:
    """A report as CSV in the order of one column; never over existing output."""
    df.orderBy(order).write.mode("errorifexists").option("header", True).csv(path)


def write_observations(members: DataFrame, path: str) -> None:
    """A text file of observation lines per cluster (folders ``cluster_id=...``), in order of time; never over existing output."""
    lines = members.select("cluster_id", "phase_time", observation_lines(members).alias("value"))
    lines.repartition("cluster_id").sortWithinPartitions("cluster_id", "phase_time").select("cluster_id", "value").write.mode("errorifexists").partitionBy("cluster_id").text(path)


VELOCITY_SIDECAR = ["velocity_profile", "template", "time", "latitude", "longitude", "depth_m"]


def write_velocity_sidecars(zones: DataFrame, path: str) -> None:
    """Six lines per cluster: profile, template, time, latitude, longitude and depth of its first location."""
    text = F.concat_ws("\n", *[F.col(c).cast("string") for c in VELOCITY_SIDECAR])
    zones.select("cluster_id", text.alias("value")).write.mode("errorifexists").partitionBy("cluster_id").text(path)


def read_velocity_sidecars(spark: SparkSession, path) -> DataFrame:
    """What :func:`write_velocity_sidecars` has written, a row per cluster."""
    raw = spark.read.option("basePath", path).text(path, wholetext=True)
    part = F.split("value", "\n")
    kinds = {"time": "timestamp", "latitude": "double", "longitude": "double", "depth_m": "double"}
    return raw.select("cluster_id", *[F.get(part, F.lit(i)).cast(kinds.get(c, "string")).alias(c) for i, c in enumerate(VELOCITY_SIDECAR)])


def save_distances(pairs: DataFrame, path: str) -> None:
    """Pseudo-distances ``window_id, i, j, tt`` for another run; never over existing output."""
    pairs.write.mode("errorifexists").parquet(path)


def load_distances(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema("window_id long, i long, j long, tt double").parquet(path)


def write_scatter(cloud: DataFrame, path: str) -> None:
    """A scatter cloud as text of the layout that :func:`read_scatter` takes, in one file; never over existing output."""
    rows = F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("latitude", "longitude", "depth", "h1", "h2")]))), "\n")  # a cloud has some 10,000 samples
    cloud.agg(F.concat(F.lit("# scatter\n#\n#\n"), rows).alias("value")).write.mode("errorifexists").text(path)

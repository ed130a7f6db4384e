"""Views that turn the driver's tables into picks, stations, arrivals, origins and bulletins.

Each is one SQL text that Spark and DuckDB both run; tables stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions.geo import great_circle_km

VIEWS: dict[str, str] = {
    "fx_picks": """SELECT event_id AS pick_ord,
  concat('XX.S', lpad(CAST(user_id % 40 AS STRING), 3, '0'), '.00.HH') AS station_id,
  CASE event_type WHEN 'click' THEN 'P' WHEN 'view' THEN 'P' WHEN 'purchase' THEN 'S' WHEN 'signup' THEN 'Pn' ELSE 'Sg' END AS phase_type,
  ts AS phase_time,
  CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) + 1 AS DOUBLE) / 100 AS phase_score,
  CASE WHEN event_id % 7 = 0 THEN concat('ev', CAST(event_id % 50 AS STRING)) END AS eventid,
  CASE WHEN user_id % 3 = 0 THEN 'AG0' WHEN user_id % 3 = 1 THEN 'AG1' END AS agency
FROM {events}""",
    "fx_stations": """SELECT 'XX' AS network, concat('S', lpad(CAST(s AS STRING), 3, '0')) AS station,
  CAST(42.0 + ((s * 37) % 40) * 0.15 AS DOUBLE) AS latitude, CAST(-2.0 + ((s * 23) % 40) * 0.2 AS DOUBLE) AS longitude,
  CAST((s * 113) % 1500 AS DOUBLE) AS elevation
FROM (SELECT DISTINCT user_id % 40 AS s FROM {events}) t WHERE s % 13 <> 12""",
    "fx_arrivals": """SELECT l_orderkey AS event_id, l_linenumber AS ord, concat('S', CAST(l_suppkey % 5 AS STRING)) AS station,
  CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'N' THEN 'S' ELSE 'Pg' END AS phase,
  l_shipdate AS pick_time, l_discount AS time_weight, round(l_tax * 10 - 0.4, 3) AS time_residual, l_quantity / 10.0 AS distance_deg
FROM {lineitem}""",
    "fx_origins": """SELECT o_orderkey AS event_id, o_orderdate AS origin_time, CAST(42.0 + (o_custkey % 97) * 0.08 AS DOUBLE) AS latitude,
  CAST(-4.0 + (o_custkey % 89) * 0.12 AS DOUBLE) AS longitude, CAST(o_orderkey % 30 AS DOUBLE) AS depth_km FROM {orders}""",
    "fx_bulletin": """SELECT concat(CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END, CAST(event_id AS STRING)) AS event_id, ts AS time,
  CAST(44.0 + (user_id % 30) * 0.05 AS DOUBLE) AS latitude, CAST(2.0 + (user_id % 17) * 0.05 AS DOUBLE) AS longitude FROM {events} WHERE event_type IN ('click', 'error')""",
    "fx_wide": """SELECT l_orderkey * 10 + l_linenumber AS det_id, l_shipdate AS p_arrival_time, CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate END AS s_arrival_time,
  l_discount * 10 AS p_probability, l_tax * 12 AS s_probability FROM {lineitem}""",
    "fx_scatter": """SELECT CAST(43.0 + l_suppkey % 50 * 0.01 AS DOUBLE) AS latitude, CAST(1.0 + l_partkey % 70 * 0.01 AS DOUBLE) AS longitude,
  l_quantity AS depth, l_discount AS h1, l_tax AS h2 FROM {lineitem}""",
}

#: name, velocity profile and closed ring (lon, lat) of each zone, in order.
ZONES = [
    ("west", "vp_west", [(-4.5, 41.5), (1.0, 41.5), (1.0, 50.0), (-4.5, 50.0), (-4.5, 41.5)]),
    ("east", "vp_east", [(0.0, 41.5), (7.0, 41.5), (7.0, 50.0), (0.0, 50.0), (0.0, 41.5)]),
    ("far", "vp_far", [(20.0, 35.0), (23.0, 35.0), (23.0, 39.0), (20.0, 39.0), (20.0, 35.0)]),
]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the tables of a folder."""
    sql = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(sql, **tables)


def zones(spark: SparkSession) -> DataFrame:
    rows = [(i, n, p, ring) for i, (n, p, ring) in enumerate(ZONES)]
    return spark.createDataFrame(rows, "ord int, name string, velocity_profile string, points array<struct<lon: double, lat: double>>")


def with_views(sql: str) -> str:
    """DuckDB SQL with the views that it names in front."""
    named = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    views = ", ".join(f"{n} AS ({re.sub(r'[{}]', '', VIEWS[n])})" for n in named)
    body = sql.strip()
    if not named:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views}, {body[14:]}"
    return f"WITH {views}, {body[4:]}" if body.upper().startswith("WITH ") else f"WITH {views} {body}"


#: Events with a known truth, and their picks. Every ARRIVALS customers make an event: each is one of its stations, with a
#: P and an S arrival over straight rays (6 and 3.5 km/s) and a little noise; every row of ``events`` is a pick of no event.
#: An event is 40 s after the one before it, elsewhere, if its number ends in 9; the others are 43 minutes apart or more.
ARRIVALS, SITES = 15, 24

_QUAKE = "CAST(floor(c_custkey / 15.0) AS BIGINT)"
QUAKES = f"""SELECT quake, 1704067200 + pmod((quake - if(quake % 10 = 9, 1, 0)) * 2593, 2592000) + if(quake % 10 = 9, 40, 0) + (quake % 7) * 0.1D AS origin_s,
  43.6D + (quake * 37 % 41) * 0.034D AS latitude, 0.5D + (quake * 23 % 43) * 0.03D AS longitude, 4D + quake % 11 AS depth_km, n
FROM (SELECT {_QUAKE} AS quake, count(*) AS n FROM {{customer}} GROUP BY 1)"""
_SITE = "43.2D + (site % 6) * 0.45D + (site * 5 % 7) * 0.03D AS latitude, 0.2D + floor(site / 6.0) * 0.6D + (site * 3 % 5) * 0.04D AS longitude"


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``quake, origin_s, latitude, longitude, depth_km, n``: the events behind :func:`quake_picks`, with their number of stations."""
    return spark.sql(QUAKES, customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))


def quake_stations(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT 'QK' AS network, concat('S', lpad(CAST(site AS STRING), 3, '0')) AS station, {_SITE}, 0D AS elevation FROM (SELECT explode(sequence(0, {SITES - 1})) AS site)")


def quake_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks of the events and of none, as :func:`view` ``fx_picks`` has them, with the event's number in ``quake``."""
    km = great_circle_km(F.col("q.latitude"), F.col("q.longitude"), F.col("s.latitude"), F.col("s.longitude"))
    at = spark.sql(f"SELECT c_custkey, {_QUAKE} AS quake, pmod({_QUAKE} * 7 + c_custkey * 5, {SITES}) AS site FROM {{customer}}", customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))
    sites = at.selectExpr("*", *_SITE.replace(" AS latitude, ", " AS latitude;").split(";")).alias("s")
    rows = sites.join(quakes(spark, sf_dir).alias("q"), "quake").withColumn("far", F.sqrt(km * km + F.col("depth_km") * F.col("depth_km")))
    noise = lambda k: (F.pmod(F.xxhash64("c_custkey", F.lit(k)), F.lit(1000)) - 500) * 0.0001  # noqa: E731  up to 50 ms
    arm = lambda phase, v, k: rows.select((F.col("c_custkey") * 2 + k).alias("pick_ord"), F.concat(F.lit("QK.S"), F.lpad(F.col("site").cast("string"), 3, "0"), F.lit(".00.HH")).alias("station_id"), F.lit(phase).alias("phase_type"), F.timestamp_micros(((F.col("origin_s") + F.col("far") / v + noise(k)) * 1000000).cast("long")).cast("timestamp_ntz").alias("phase_time"), F.lit(0.9).alias("phase_score"), F.lit(None).cast("string").alias("eventid"), F.col("quake"))
    other = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("-1 - event_id as pick_ord", f"concat('QK.S', lpad(cast(user_id % {SITES} as string), 3, '0'), '.00.HH') as station_id", "if(event_type in ('click', 'view'), 'P', 'S') as phase_type", "cast(ts as timestamp_ntz) as phase_time", "0.9D as phase_score", "cast(null as string) as eventid", "cast(null as bigint) as quake")
    return arm("P", 6.0, 0).union(arm("S", 3.5, 1)).union(other)

"""Registered queries of the seismic operators, each with DuckDB SQL where SQL expresses it."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators import catalog, clusters, density, locate, pairs, picks, windows
from tremor.plans import pipeline
from tremor.plans.fixtures import ARRIVALS, ZONES, quake_picks, quake_stations, quakes, view, with_views, zones
from tremor.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BLACKLIST = ["S00[1-3]", "S01.\\.", "HZ$"]
SIX_HOURS, DAY = 21600.0, 86400.0
MEMBERS = "SELECT *, pick_ord % 400 AS cluster_id, split_part(station_id, '.', 2) AS station, split_part(station_id, '.', 1) AS network FROM fx_picks"
#: Great-circle distance in km and pseudo travel time of rows a and b, as DuckDB SQL.
_H = "pow(sin((radians({b}.latitude) - radians({a}.latitude)) / 2), 2) + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2)"
_KM = "(6371.0::DOUBLE * radians(degrees(2 * asin(sqrt(least(" + _H + ", 1.0::DOUBLE))))))"


def km_sql(a: str, b: str) -> str:
    return _KM.format(a=a, b=b)


def tt_sql(a: str, b: str, us: str, velocity: int) -> str:
    dt = f"(({a}.{us} - {b}.{us}) / 1e6::DOUBLE)"
    km = f"({km_sql(a, b)} / {velocity}::DOUBLE)"
    return f"sqrt({dt} * {dt} + {km} * {km})"


def query(sql: str | None = None):
    """Registers a function ``(spark, sf_dir) -> DataFrame`` under its name, with its SQL over the views."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = with_views(sql)
        return f

    return put


def _members(spark: SparkSession, d: str, n: int = 400) -> DataFrame:
    return picks.normalize(view(spark, d, "fx_picks")).withColumn("cluster_id", F.col("pick_ord") % n)


_ROUNDED = "(epoch_us(phase_time) // 100 + CASE WHEN epoch_us(phase_time) % 100 > 50 OR (epoch_us(phase_time) % 100 = 50 AND (epoch_us(phase_time) // 100) % 2 = 1) THEN 1 ELSE 0 END) * 100"


@query(f"SELECT pick_ord, split_part(station_id, '.', 1) AS network, split_part(station_id, '.', 2) AS station, phase_type, CAST({_ROUNDED} AS BIGINT) AS time_us, phase_score, eventid FROM fx_picks")
def picks_normalize(spark, d):
    return picks.normalize(view(spark, d, "fx_picks")).select("pick_ord", "network", "station", "phase_type", picks.micros(F.col("phase_time")).alias("time_us"), "phase_score", "eventid")


@query("SELECT pick_ord, station_id FROM fx_picks WHERE phase_time >= TIMESTAMP '2024-01-05 00:00:00' AND phase_time <= TIMESTAMP '2024-01-12 12:00:00'")
def picks_time_range(spark, d):
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    return picks.in_range(view(spark, d, "fx_picks"), t("2024-01-05 00:00:00"), t("2024-01-12 12:00:00")).select("pick_ord", "station_id")


@query("SELECT pick_ord, station_id FROM fx_picks WHERE " + " AND ".join(f"NOT regexp_matches(station_id, '{p}')" for p in BLACKLIST))
def picks_blacklist(spark, d):
    return picks.without_stations(view(spark, d, "fx_picks"), BLACKLIST).select("pick_ord", "station_id")


@query("SELECT entry, count(*) AS removed FROM (SELECT CASE " + " ".join(f"WHEN regexp_matches(station_id, '{p}') THEN '{p}'" for p in BLACKLIST) + " END AS entry FROM fx_picks) t WHERE entry IS NOT NULL GROUP BY entry")
def picks_blacklist_counts(spark, d):
    return picks.blacklist_counts(view(spark, d, "fx_picks"), BLACKLIST)


@query("SELECT pick_ord, phase_type, phase_score FROM fx_picks WHERE NOT (phase_type = 'P' AND coalesce(phase_score, -1) < 0.2) AND NOT (phase_type = 'S' AND coalesce(phase_score, -1) < 0.5)")
def picks_threshold(spark, d):
    return picks.above_threshold(view(spark, d, "fx_picks"), 0.2, 0.5).select("pick_ord", "phase_type", "phase_score")


@query("""SELECT det_id, 'P' AS phase_type, epoch_us(p_arrival_time) AS time_us, p_probability AS phase_score FROM fx_wide WHERE p_probability <> 0 AND p_probability >= 0.3
 UNION ALL SELECT det_id, 'S', epoch_us(s_arrival_time), s_probability FROM fx_wide WHERE s_probability <> 0 AND s_probability >= 0.4""")
def picks_unpivot(spark, d):
    return picks.unpivot_detections(view(spark, d, "fx_wide"), 0.3, 0.4).select("det_id", "phase_type", picks.micros(F.col("phase_time")).alias("time_us"), "phase_score")


@query("SELECT det_id, epoch_us(least(p_arrival_time, s_arrival_time)) AS time_us FROM fx_wide")
def picks_detection_time(spark, d):
    return picks.detection_time(view(spark, d, "fx_wide")).select("det_id", picks.micros(F.col("phase_time")).alias("time_us"))


@query("SELECT pick_ord, latitude, longitude, elevation FROM fx_picks JOIN fx_stations ON network = split_part(station_id, '.', 1) AND station = split_part(station_id, '.', 2)")
def picks_station_join(spark, d):
    return picks.with_coordinates(picks.normalize(view(spark, d, "fx_picks")), view(spark, d, "fx_stations")).select("pick_ord", "latitude", "longitude", "elevation")


@query("""SELECT pick_ord, station_id FROM fx_picks a WHERE NOT EXISTS (SELECT 1 FROM fx_picks b WHERE b.pick_ord % 3 = 0 AND a.station_id = b.station_id AND a.phase_type = b.phase_type AND a.phase_time = b.phase_time)""")
def picks_unload(spark, d):
    p = view(spark, d, "fx_picks")
    return picks.unload(p, p.where("pick_ord % 3 = 0")).select("pick_ord", "station_id")


@query("""WITH f AS (SELECT *, CASE WHEN contains(phase_type, 'P') THEN 'P' WHEN contains(phase_type, 'S') THEN 'S' END AS fam, epoch_us(phase_time) AS us FROM fx_picks),
 g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY station_id, fam ORDER BY us) > CASE fam WHEN 'P' THEN 600000000 ELSE 1200000000 END THEN 1 ELSE 0 END AS fresh FROM f),
 h AS (SELECT *, sum(fresh) OVER (PARTITION BY station_id, fam ORDER BY us) AS run FROM g),
 r AS (SELECT *, row_number() OVER (PARTITION BY station_id, fam, run ORDER BY phase_score DESC, phase_type DESC, us) AS n FROM h)
 SELECT pick_ord, station_id, phase_type, phase_score FROM r WHERE n = 1""")
def picks_dedup_1d(spark, d):
    return picks.dedup_close(view(spark, d, "fx_picks"), 600.0, 1200.0).select("pick_ord", "station_id", "phase_type", "phase_score")


@query("SELECT pick_ord, upper(substr(phase_type, 1, 1)) AS letter, CASE WHEN contains(phase_type, 'P') THEN 0.1::DOUBLE WHEN contains(phase_type, 'S') THEN 0.2::DOUBLE END AS uncertainty FROM fx_picks")
def picks_uncertainty(spark, d):
    return view(spark, d, "fx_picks").select("pick_ord", picks.first_letter(F.col("phase_type")).alias("letter"), picks.uncertainty(F.col("phase_type")).alias("uncertainty"))


_SPAN = "s AS (SELECT min(epoch_us(phase_time)) AS a, max(epoch_us(phase_time)) AS b FROM fx_picks), w AS (SELECT unnest(range(0, (b - a) // {size} + 1)) AS window_id, a, b FROM s)"


@query("WITH " + _SPAN.format(size=21600000000) + " SELECT window_id, a + window_id * 21600000000 AS begin_us, least(a + (window_id + 1) * 21600000000, b) AS end_us FROM w")
def windows_tumbling(spark, d):
    return windows.periods(view(spark, d, "fx_picks"), SIX_HOURS)


@query("WITH " + _SPAN.format(size=21600000000) + """ SELECT window_id, count(*) AS n, CAST(sum(pick_ord) AS BIGINT) AS ords FROM w JOIN fx_picks ON epoch_us(phase_time) >= a + window_id * 21600000000 - 60000000 AND epoch_us(phase_time) < a + (window_id + 1) * 21600000000 GROUP BY window_id""")
def windows_overlap(spark, d):
    out = windows.assign(view(spark, d, "fx_picks"), SIX_HOURS, 60.0)
    return out.groupBy("window_id").agg(F.count("*").alias("n"), F.sum("pick_ord").alias("ords"))


@query("WITH " + _SPAN.format(size=86400000000) + """, c AS (SELECT window_id, a FROM w WHERE window_id < (b - a) // 86400000000)
 SELECT window_id, count(pick_ord) AS n FROM c LEFT JOIN fx_picks ON epoch_us(phase_time) >= a + window_id * 86400000000 - 30000000 AND epoch_us(phase_time) < a + (window_id + 1) * 86400000000 + 30000000 GROUP BY window_id""")
def windows_two_sided(spark, d):
    return windows.counts(view(spark, d, "fx_picks"), DAY, 30.0)


#: Located picks with the number of their day, counted from the first pick.
_DAYS = "q AS (SELECT pick_ord, CAST(" + _ROUNDED + " AS BIGINT) AS us, latitude, longitude FROM fx_picks JOIN fx_stations ON network = split_part(station_id, '.', 1) AND station = split_part(station_id, '.', 2)), p AS (SELECT *, (us - (SELECT min(us) FROM q)) // 86400000000 AS day FROM q)"


def located_picks(spark: SparkSession, d: str) -> DataFrame:
    return picks.with_coordinates(picks.normalize(view(spark, d, "fx_picks")), view(spark, d, "fx_stations"))


def _by_day(spark, d):
    return windows.assign(located_picks(spark, d), DAY, 0.0)


@query("WITH " + _DAYS + f" SELECT a.pick_ord AS i, b.pick_ord AS j, round({tt_sql('a', 'b', 'us', 5)}, 6) AS tt FROM p a JOIN p b ON a.day = b.day AND a.pick_ord < b.pick_ord WHERE {tt_sql('a', 'b', 'us', 5)} <= 1800")
def pair_tt(spark, d):
    return pairs.pseudo_distances(_by_day(spark, d), 5.0, max_tt=1800.0, digits=6).select("i", "j", "tt")


@query("WITH " + _DAYS + f", e AS (SELECT a.pick_ord AS i, {tt_sql('a', 'b', 'us', 5)} AS tt FROM p a JOIN p b ON a.day = b.day AND a.pick_ord <> b.pick_ord), r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY tt) AS n FROM e) SELECT i, round(tt, 6) AS tt FROM r WHERE n = 7")
def kdist_curve(spark, d):
    return pairs.nearest_distances(_by_day(spark, d), 8, 5.0).select("i", F.round("tt", 6).alias("tt"))


@query(f"""WITH RECURSIVE p AS (SELECT event_id, epoch_us(time) AS us, latitude, longitude FROM fx_bulletin),
 e AS (SELECT a.event_id AS a, b.event_id AS b FROM p a JOIN p b ON a.event_id <> b.event_id AND abs(a.us - b.us) <= 63300000 WHERE {tt_sql('a', 'b', 'us', 5)} <= sqrt(4000.0::DOUBLE)),
 r AS (SELECT event_id AS n, event_id AS m FROM p UNION SELECT e.b, r.m FROM r JOIN e ON r.n = e.a),
 g AS (SELECT n, min(m) AS g FROM r GROUP BY n)
 SELECT min(us) AS time_us, arg_min(latitude, (us, event_id)) AS latitude, arg_min(longitude, (us, event_id)) AS longitude, string_agg(event_id, ',' ORDER BY us, event_id) AS event_ids, count(*) AS n_events FROM p JOIN g ON p.event_id = g.n GROUP BY g""")
def bulletin_match(spark, d):
    return pairs.match_bulletins(view(spark, d, "fx_bulletin"), 100.0, 60.0, 5.0)


@query(f"WITH m AS ({MEMBERS}) SELECT cluster_id, count(*) AS n_picks, count(DISTINCT station) AS n_stations, count(DISTINCT eventid) AS n_eventids FROM m GROUP BY cluster_id")
def cluster_stats(spark, d):
    return clusters.stats(_members(spark, d))


@query(f"""WITH m AS ({MEMBERS}), s AS (SELECT cluster_id, station, max(contains(phase_type, 'P')) AS p, max(contains(phase_type, 'S')) AS q FROM m GROUP BY ALL),
 c AS (SELECT cluster_id, count(*) AS n_stations, count(*) FILTER (WHERE p AND q) AS n_both FROM s GROUP BY cluster_id) SELECT * FROM c WHERE n_stations >= 6 AND n_both >= 1""")
def cluster_filter(spark, d):
    return clusters.accepted(_members(spark, d), 6, 1)


# Clusters of windows of six hours that overlap by one: picks are equal by station, phase and time.
_WINDOWED = "WITH " + _SPAN.format(size=21600000000) + """, m AS (SELECT window_id * 10 + pick_ord % 3 AS cluster_id, window_id, station_id, phase_type, epoch_us(phase_time) AS us, eventid FROM w JOIN fx_picks ON epoch_us(phase_time) >= a + window_id * 21600000000 - 3600000000 AND epoch_us(phase_time) < a + (window_id + 1) * 21600000000),
 x AS (SELECT cluster_id, window_id, station_id, phase_type, us, count(*) AS n FROM m GROUP BY ALL),
 c AS (SELECT x.cluster_id AS c1, y.cluster_id AS c2, CAST(sum(least(x.n, y.n)) AS BIGINT) AS n_common FROM x JOIN x y ON y.window_id = x.window_id + 1 AND x.station_id = y.station_id AND x.phase_type = y.phase_type AND x.us = y.us GROUP BY ALL)"""
_PICK = ["station_id", "phase_type", "us", "w"]


def _windowed(spark, d, ahead: int):
    m = windows.assign(view(spark, d, "fx_picks"), SIX_HOURS, 3600.0)
    return m.select((F.col("window_id") * 10 + F.col("pick_ord") % 3).alias("cluster_id"), (F.col("window_id") + ahead).alias("w"), "station_id", "phase_type", picks.micros(F.col("phase_time")).alias("us"), "eventid")


@query(f"{_WINDOWED} SELECT * FROM c WHERE n_common >= 4")
def cluster_common_picks(spark, d):
    return clusters.common_picks(_windowed(spark, d, 1), _windowed(spark, d, 0), _PICK, 4)


@query(f"{_WINDOWED} SELECT c1, c2 FROM c WHERE n_common >= 4 UNION SELECT a.cluster_id, b.cluster_id FROM m a JOIN m b ON a.eventid = b.eventid AND b.window_id = a.window_id + 1")
def cluster_related(spark, d):
    return clusters.related(_windowed(spark, d, 1), _windowed(spark, d, 0), _PICK, 4, ["w"])


@query(f"WITH m AS ({MEMBERS}) SELECT DISTINCT cluster_id, pick_ord FROM m UNION SELECT a.cluster_id, b.pick_ord FROM m a JOIN m b ON a.eventid = b.eventid")
def cluster_add_by_eventid(spark, d):
    m = _members(spark, d)
    return clusters.add_by_eventid(m.select("cluster_id", "eventid", "pick_ord"), m.select("eventid", "pick_ord")).select("cluster_id", "pick_ord").distinct()


@query(f"WITH m AS ({MEMBERS}) SELECT cluster_id, min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude, max(longitude) AS max_longitude FROM m JOIN fx_stations s ON m.station = s.station GROUP BY cluster_id")
def cluster_bbox(spark, d):
    return clusters.bounding_boxes(picks.with_coordinates(_members(spark, d), view(spark, d, "fx_stations")))


_EDGES = ", ".join(f"({i}, '{n}', '{p}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for i, (n, p, ring) in enumerate(ZONES) for a, b in zip(ring, ring[1:], strict=False))


@query(f"""WITH e AS (SELECT * FROM (VALUES {_EDGES}) t(ord, name, prof, x1, y1, x2, y2)),
 h AS (SELECT o.event_id, e.ord, e.name, e.prof, count(*) FILTER (WHERE (y1 > latitude) <> (y2 > latitude) AND longitude < x1 + (latitude - y1) * (x2 - x1) / (y2 - y1)) AS n FROM fx_origins o, e GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS k FROM h WHERE n % 2 = 1) SELECT event_id, name AS zone, prof AS velocity_profile FROM r WHERE k = 1""")
def zone_lookup(spark, d):
    return catalog.first_zone(view(spark, d, "fx_origins"), zones(spark))


_USED = "coalesce(time_weight <> 0 AND time_residual <> 0, false)"


@query(f"SELECT event_id, count(*) FILTER (WHERE {_USED}) AS used_phase_count, count(DISTINCT CASE WHEN {_USED} THEN station END) AS used_station_count FROM fx_arrivals GROUP BY event_id")
def arrivals_used_counts(spark, d):
    return catalog.used_counts(view(spark, d, "fx_arrivals"))


@query("""WITH s AS (SELECT event_id, station, count(*) AS n, max(contains(upper(phase), 'P')) AS p, max(contains(upper(phase), 'S')) AS q FROM fx_arrivals WHERE time_weight IS NULL OR time_weight <> 0 GROUP BY ALL)
 SELECT event_id, count(*) FILTER (WHERE n >= 2) AS n_stations FROM s GROUP BY event_id""")
def stations_multi_phase(spark, d):
    return catalog.stations_with_phases(view(spark, d, "fx_arrivals"), 2, compat=True)


@query("""WITH s AS (SELECT event_id, station, max(contains(upper(phase), 'P')) AS p, max(contains(upper(phase), 'S')) AS q FROM fx_arrivals WHERE time_weight IS NULL OR time_weight <> 0 GROUP BY ALL)
 SELECT event_id, count(*) FILTER (WHERE p AND q) AS n_stations FROM s GROUP BY event_id""")
def stations_p_and_s(spark, d):
    return catalog.stations_with_phases(view(spark, d, "fx_arrivals"), 2)


@query("""SELECT event_id, ord, phase, time_residual FROM fx_arrivals WHERE abs(time_weight) > 0.001 AND distance_deg <= 400 / 111.0::DOUBLE
 AND (CASE WHEN contains(upper(phase), 'P') THEN abs(time_residual) <= 0.25 WHEN contains(upper(phase), 'S') THEN abs(time_residual) <= 0.35 ELSE true END)""")
def arrivals_cleanup(spark, d):
    return catalog.clean_arrivals(view(spark, d, "fx_arrivals"), 0.25, 0.35, 400.0).select("event_id", "ord", "phase", "time_residual")


@query("SELECT event_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY event_id, phase, station ORDER BY abs(time_residual), ord DESC) AS n FROM fx_arrivals) t WHERE n = 1")
def arrivals_dedup(spark, d):
    return catalog.dedup_arrivals(view(spark, d, "fx_arrivals")).select("event_id", "ord")


@query("SELECT event_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY event_id, phase, station ORDER BY time_residual, ord DESC) AS n FROM fx_arrivals) t WHERE n = 1")
def arrivals_dedup_signed(spark, d):
    return catalog.dedup_arrivals(view(spark, d, "fx_arrivals"), corrected=False).select("event_id", "ord")


@query(f"""WITH u AS (SELECT event_id, count(*) FILTER (WHERE {_USED}) AS used_phase_count FROM fx_arrivals GROUP BY event_id),
 s AS (SELECT event_id, station, count(*) AS n FROM fx_arrivals WHERE time_weight IS NULL OR time_weight <> 0 GROUP BY ALL), k AS (SELECT event_id, count(*) FILTER (WHERE n >= 2) AS n_stations FROM s GROUP BY event_id)
 SELECT event_id, used_phase_count, coalesce(n_stations, 0) AS n_stations FROM u LEFT JOIN k USING (event_id) WHERE used_phase_count >= 4 AND coalesce(n_stations, 0) >= 2""")
def event_accept(spark, d):
    return catalog.accept_events(view(spark, d, "fx_arrivals"), 4, 2)


_CUT = 852076800000000  # 1997-01-01


@query(f"""WITH e AS (SELECT event_id, min(CASE WHEN {_USED} THEN epoch_us(pick_time) END) AS first_us, max(CASE WHEN {_USED} THEN epoch_us(pick_time) END) AS last_us FROM fx_arrivals GROUP BY event_id)
 SELECT *, CASE WHEN first_us >= {_CUT} THEN 'deleted' WHEN last_us >= {_CUT} THEN 'pruned' ELSE 'kept' END AS disposition FROM e""")
def event_disposition(spark, d):
    return catalog.disposition(view(spark, d, "fx_arrivals"), _CUT)


@query("SELECT event_id, ord, concat(CAST(event_id AS STRING), '/arrival/', CAST(row_number() OVER (PARTITION BY event_id ORDER BY ord) - 1 AS STRING)) AS readable_id FROM fx_arrivals")
def readable_ids(spark, d):
    return catalog.numbered(view(spark, d, "fx_arrivals"), "event_id", "ord", "arrival").select("event_id", "ord", "readable_id")


_MS = "(epoch_us(origin_time) // 1000)"
_B36 = " || ".join(f"substr('{catalog.DIGITS}', CAST(({_MS} // {36**k}) % 36 AS INT) + 1, 1)" for k in range(8, -1, -1))


@query(f"SELECT event_id, 'tr' || CAST(year(origin_time) AS STRING) || ltrim({_B36}, '0') AS readable_id FROM fx_origins")
def event_readable_ids(spark, d):
    return view(spark, d, "fx_origins").select("event_id", catalog.event_key("tr", F.col("origin_time")).alias("readable_id"))


@query("WITH p AS (SELECT event_id * 10 + ord AS pick_id, event_id, station, phase FROM fx_arrivals), f AS (SELECT pick_id, min(pick_id) OVER (PARTITION BY event_id, station, phase) AS m FROM p) SELECT pick_id AS old, m AS new FROM f WHERE pick_id <> m")
def picks_dup_remove(spark, d):
    p = view(spark, d, "fx_arrivals").withColumn("pick_id", F.col("event_id") * 10 + F.col("ord"))
    return catalog.dedup_picks(p, ["event_id", "station", "phase"])[1]


@query(f"""WITH m AS ({MEMBERS}), b AS (SELECT station, phase_type, {_ROUNDED} AS us, max(phase_score) AS s FROM m GROUP BY ALL)
 SELECT m.pick_ord, printf('{{"probability": {{"name": "probability", "value": %.2f}}}}', b.s) AS comment FROM m JOIN b ON m.station = b.station AND m.phase_type = b.phase_type AND {_ROUNDED} = b.us""")
def probability_comments(spark, d):
    m = _members(spark, d)
    return catalog.probability_comments(m, m).select("pick_ord", "comment")


@query(f"""WITH m AS ({MEMBERS}), h AS (SELECT a.pick_ord % 500 AS event_id, a.pick_ord AS ord, b.cluster_id FROM m a JOIN m b ON a.station = b.station AND a.phase_type = b.phase_type AND a.phase_time = b.phase_time WHERE a.pick_ord % 4 <> 0),
 f AS (SELECT event_id, arg_min(cluster_id, (ord, cluster_id)) AS cluster_id FROM h GROUP BY event_id), i AS (SELECT cluster_id, '{{"event_ids":[' || string_agg(DISTINCT '"' || eventid || '"', ',' ORDER BY '"' || eventid || '"') || ']}}' AS comment FROM m WHERE eventid IS NOT NULL GROUP BY cluster_id)
 SELECT event_id, cluster_id, comment FROM f JOIN i USING (cluster_id)""")
def event_id_comments(spark, d):
    m = picks.normalize(view(spark, d, "fx_picks")).drop("phase_time").join(view(spark, d, "fx_picks").select("pick_ord", "phase_time"), "pick_ord").withColumn("cluster_id", F.col("pick_ord") % 400)
    arrivals = m.select((F.col("pick_ord") % 500).alias("event_id"), F.col("pick_ord").alias("ord"), "station", F.col("phase_type").alias("phase"), F.col("phase_time").alias("pick_time"), (F.col("pick_ord") % 4).cast("double").alias("time_weight"), F.lit(0.1).alias("time_residual"))
    return catalog.event_id_comments(arrivals, m)


@query(f"""WITH q AS (SELECT event_id, latitude + 0.1::DOUBLE AS latitude, longitude - 0.2::DOUBLE AS longitude FROM fx_origins WHERE event_id % 3 = 0)
 SELECT o.event_id, round({km_sql('q', 'o')}, 6) AS preloc_distance_km FROM fx_origins o JOIN q ON o.event_id = q.event_id""")
def preloc_distance(spark, d):
    o = view(spark, d, "fx_origins")
    pre = o.select("event_id", F.lit(0).alias("ord"), (F.col("latitude") + 0.1).alias("latitude"), (F.col("longitude") - 0.2).alias("longitude"), F.when(F.col("event_id") % 3 == 0, "smi:pyocto/v1").otherwise("other").alias("method_id"))
    return catalog.preloc_distance(o, pre)


@query("""WITH h AS (SELECT station, network, '00' AS location, 'HH' AS channel FROM fx_stations) SELECT pick_ord, network, location, channel || CASE WHEN contains(phase_type, 'P') THEN 'Z' ELSE 'N' END AS channel
 FROM fx_picks p LEFT JOIN h ON h.station = split_part(p.station_id, '.', 2)""")
def channel_hints(spark, d):
    s = view(spark, d, "fx_stations")
    hints = s.select(F.lit(1).alias("ord"), "network", "station", F.lit("00").alias("location"), F.lit("HH").alias("channel")).union(s.select(F.lit(2), "network", "station", F.lit("10"), F.lit("EH")))
    p = view(spark, d, "fx_picks").select("pick_ord", F.split_part("station_id", F.lit("."), F.lit(2)).alias("station"), F.col("phase_type").alias("phase"))
    return catalog.complete_channels(p, hints).select("pick_ord", "network", "location", "channel")


@query("""WITH i AS (SELECT event_id, unnest([CAST(event_id AS STRING), CAST(event_id + 1 AS STRING)]) AS e FROM fx_origins)
 SELECT CAST(i.event_id AS STRING) AS merged_id, count(*) AS n_children, CAST(sum(a.ord) AS BIGINT) AS ords FROM i JOIN fx_arrivals a ON CAST(a.event_id AS STRING) = i.e GROUP BY ALL""")
def catalog_merge(spark, d):
    info = view(spark, d, "fx_origins").select(F.col("event_id").cast("string").alias("event_id"), F.concat_ws(" ", F.col("event_id").cast("string"), (F.col("event_id") + 1).cast("string")).alias("agencies_list"))
    return catalog.merge_catalogs(info, view(spark, d, "fx_arrivals")).groupBy("merged_id").agg(F.count("*").alias("n_children"), F.sum("ord").alias("ords"))


@query("SELECT station AS seedid, phase AS phasename, epoch_us(pick_time) AS time_us, 1.0::DOUBLE AS probability, CAST(event_id AS STRING) AS eventid, 'AG' AS agency FROM fx_arrivals WHERE time_weight <> 0")
def picks_export(spark, d):
    return catalog.export_picks(view(spark, d, "fx_arrivals"), "AG").select("seedid", "phasename", picks.micros(F.col("time")).alias("time_us"), "probability", "eventid", "agency")


@query("SELECT event_id, ord, station, phase, round(distance_deg, 2) AS probability FROM fx_arrivals WHERE (time_weight IS NULL OR time_weight <> 0) AND ord % 2 = 0")
def pick_report(spark, d):
    a = view(spark, d, "fx_arrivals")
    text = F.when(F.col("ord") % 2 == 0, F.format_string('{"probability": {"name": "probability", "value": %.2f}}', "distance_deg")).otherwise("not json")
    return catalog.pick_report(a.withColumn("comment", text))


@query("""WITH t AS (SELECT max(h2) AS top FROM fx_scatter) SELECT round(avg(latitude) FILTER (WHERE h2 = top), 6) AS best_latitude, round(avg(longitude) FILTER (WHERE h2 = top), 6) AS best_longitude, round(avg(depth) FILTER (WHERE h2 = top), 6) AS best_depth, count(*) FILTER (WHERE h2 = top) AS n_best,
 min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude, max(longitude) AS max_longitude FROM fx_scatter, t""")
def scatter_barycenter(spark, d):
    s = catalog.scatter_summary(view(spark, d, "fx_scatter"))
    return s.withColumns({c: F.round(c, 6) for c in ("best_latitude", "best_longitude", "best_depth")})


@query("""SELECT event_id, '' AS tag, printf('%.3f', latitude) AS latitude, printf('%.1f', depth_km * 1000) AS depth, CASE WHEN event_id % 4 = 0 THEN '-' ELSE printf('%.1f', (event_id % 4) * 1.0) END AS gap1, 'm' || CAST(event_id % 3 AS STRING) AS model FROM fx_origins""")
def event_table(spark, d):
    o = view(spark, d, "fx_origins").withColumns({"preferred": F.lit(True), "event_type": F.lit("earthquake"), "standard_error": F.lit(0.1), "used_station_count": F.lit(1), "used_phase_count": F.lit(1), "azimuthal_gap": (F.col("event_id") % 4).cast("double"), "secondary_azimuthal_gap": F.lit(None).cast("double"), "earth_model_id": F.concat(F.lit("smi:x/models/m"), (F.col("event_id") % 3).cast("string")), "method_id": F.lit("smi:x/octree")})
    return catalog.event_table(o).select("event_id", "tag", "latitude", "depth", "gap1", "model")


@query("""SELECT epoch_us(origin_time) AS time_us, event_id, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END AS nb_agencies, CASE WHEN event_id % 2 = 0 THEN 'a' || CAST(event_id AS STRING) || ' b' ELSE '' END AS agencies_list FROM fx_origins""")
def event_ids_report(spark, d):
    text = F.format_string('{"event_ids": ["a%d", "b"]}', "event_id")
    o = view(spark, d, "fx_origins").withColumn("comments", F.when(F.col("event_id") % 2 == 0, F.array(F.lit("no json"), text)).otherwise(F.array(F.lit('{"other": 1}'))))
    return catalog.event_ids_report(o).select(picks.micros(F.col("time")).alias("time_us"), "event_id", "nb_agencies", "agencies_list")


@query("""WITH a AS (SELECT event_id, ord, event_id * 3 + ord % 3 AS pick_id FROM fx_arrivals), p AS (SELECT pick_id, arg_min(station, (ord, station)) AS station FROM (SELECT event_id * 3 + ord % 3 AS pick_id, ord, station FROM fx_arrivals WHERE ord <> 2) t GROUP BY pick_id) SELECT a.event_id, a.ord, p.station FROM a LEFT JOIN p USING (pick_id)""")
def arrivals_with_picks(spark, d):
    a = view(spark, d, "fx_arrivals").withColumn("pick_id", F.col("event_id") * 3 + F.col("ord") % 3)
    return catalog.with_picks(a.select("event_id", "ord", "pick_id"), a.where("ord <> 2").select("pick_id", "ord", "station")).select("event_id", "ord", "pick.station")


@query("SELECT station_id, n_before, n_before - coalesce(n, 0) AS removed FROM (SELECT station_id, count(*) AS n_before FROM fx_picks GROUP BY 1) t LEFT JOIN (SELECT station_id AS s, count(*) AS n FROM fx_picks WHERE NOT (phase_type = 'P' AND coalesce(phase_score, -1) < 0.2) AND NOT (phase_type = 'S' AND coalesce(phase_score, -1) < 0.5) GROUP BY 1) u ON s = station_id")
def removal_counts(spark, d):
    p = view(spark, d, "fx_picks")
    return catalog.removal_counts(p, picks.above_threshold(p, 0.2, 0.5), ["station_id"]).select("station_id", "n_before", "removed")


@query("SELECT pick_ord, CASE WHEN pick_ord % 5 < 0 THEN -1 ELSE pick_ord % 5 END AS label FROM fx_picks UNION ALL SELECT pick_ord, CASE WHEN pick_ord % 4 = 3 THEN -1 ELSE 5 + pick_ord % 4 END FROM fx_picks")
def cluster_append(spark, d):
    p = view(spark, d, "fx_picks").select("pick_ord")
    return clusters.append(p.withColumn("label", F.col("pick_ord") % 5), p.withColumn("label", F.when(F.col("pick_ord") % 4 == 3, -1).otherwise(F.col("pick_ord") % 4)))


# Operators that SQL doesn't express: each runs over all picks, in windows of a day.


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return windows.assign(located_picks(spark, d), DAY, 60.0)


@query()
def hdbscan_labels(spark, d):
    return density.cluster_windows(_daily(spark, d), 5.0, 8)


@query()
def window_merge(spark, d):
    return pipeline.merge_labels(hdbscan_labels(spark, d), located_picks(spark, d), 2)


def _labelled(spark, d):
    return hdbscan_labels(spark, d).join(view(spark, d, "fx_picks").select("pick_ord", "eventid"), "pick_ord")


@query()
def eventid_merge(spark, d):
    return clusters.merge_windows_by_eventid(_labelled(spark, d))


@query()
def fixpoint_merge(spark, d):
    return clusters.merge_windows_to_fixpoint(_labelled(spark, d), 3)


#: Windows of an hour over picks with a known truth: what clusters, locates and associates is seen at work.
QUAKES = pipeline.Settings(time_window=3600.0, overlap=120.0, min_cluster_size=8, min_stations=6, min_both=3, min_picks_common=4)


def _clusters(spark, d):
    rows = materialize(picks.with_coordinates(picks.normalize(quake_picks(spark, d)), quake_stations(spark)), "picks")
    labels = density.cluster_windows(windows.assign(rows, QUAKES.time_window, QUAKES.overlap), 5.0, QUAKES.min_cluster_size)
    members = materialize(clusters.observations(pipeline.merge_labels(materialize(labels, "labels"), rows, QUAKES.min_picks_common).join(rows, "pick_ord")), "members")
    return members.join(clusters.accepted(members, QUAKES.min_stations, QUAKES.min_both).select("cluster_id"), "cluster_id", "left_semi")


@query()
def locate_origins(spark, d):
    return locate.locate_clusters(_clusters(spark, d)).drop("arrivals")


@query()
def associate_events(spark, d):
    return locate.associate_clusters(_clusters(spark, d))


#: An event counts as found if one within so many seconds and km is.
NEAR_S, NEAR_KM = 3.0, 10.0


@query(f"SELECT count(DISTINCT floor(c_custkey / {ARRIVALS}.0)) AS n_quakes, true AS most_found, true AS few_made_up FROM customer")
def quake_recovery(spark, d):
    """Whether 95 percent of the true events are among the associated ones, and no more than 5 percent of these are none."""
    found = materialize(locate.associate_clusters(_clusters(spark, d)).select("cluster_id", "event", "preloc_us", "preloc_latitude", "preloc_longitude").distinct(), "found")
    true = quakes(spark, d)
    met = catalog.matched_events(true.select(F.col("quake").alias("id"), (F.col("origin_s") * 1000000).cast("long").alias("us"), "latitude", "longitude"), found.select(F.struct("cluster_id", "event").alias("other"), F.col("preloc_us").alias("us"), F.col("preloc_latitude").alias("latitude"), F.col("preloc_longitude").alias("longitude")), NEAR_S, NEAR_KM)
    hits = met.agg(F.count_distinct("id").alias("hit"), F.count_distinct("other").alias("right"))
    sums = true.agg(F.count("*").alias("n_quakes")).crossJoin(hits).crossJoin(found.agg(F.count("*").alias("n_found")))  # a row each
    return sums.select("n_quakes", (F.col("hit") >= 0.95 * F.col("n_quakes")).alias("most_found"), (F.col("n_found") - F.col("right") <= 0.05 * F.col("n_found")).alias("few_made_up"))


@query()
def relocate(spark, d):
    """Catalogue events (those with a known truth) from their own arrivals, with the default search."""
    p = quake_picks(spark, d).where("quake is not null")
    arrivals = p.select(F.col("quake").alias("event_id"), F.col("pick_ord").alias("ord"), F.split_part("station_id", F.lit("."), F.lit(2)).alias("station"), F.lower("phase_type").alias("phase"), F.col("phase_time").alias("pick_time"), F.lit(1.0).alias("time_weight"), F.lit(0.1).alias("time_residual"), F.lit(0.1).alias("distance_deg"))
    return locate.relocate(arrivals, quake_stations(spark), km=400.0).drop("arrivals")


@query()
def detect_events(spark, d):
    s = dataclasses.replace(QUAKES, associate=True)
    return pipeline.run(quake_picks(spark, d), quake_stations(spark), s)["events"].drop("arrivals")

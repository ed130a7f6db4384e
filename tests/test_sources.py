"""Service answers as data sources, locator text, and SQL functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tremor.functions import geo, sql
from tremor.operators import catalog, picks
from tremor.sources import catalog_xml, locator_text, services


def test_stations_as_a_source(spark, tmp_path):
    services.register(spark)
    (tmp_path / "a.txt").write_text("#Network | Station | Latitude | Longitude | Elevation | SiteName | StartTime | EndTime\nN|A| 45.5 |3.0|100|Here|2000-01-01T00:00:00|\nN|B|46|4|||2001-01-01T00:00:00|\n\n# end\n")
    (tmp_path / "b.txt").write_text("#Network|Station|Latitude|Longitude|Elevation\nM|C|1|2|3\n")
    df = spark.read.format("tremor_stations").load(str(tmp_path))
    assert {(r.station, r.latitude, r.elevation, r.site) for r in df.collect()} == {("A", 45.5, 100.0, "Here"), ("B", 46.0, None, None), ("C", 1.0, 3.0, None)}
    assert df.rdd.getNumPartitions() == 2
    assert [r.station for r in df.where("network = 'N' and station in ('B', 'C')").collect()] == ["B"]
    assert [r.station for r in df.where("network = 'N' and latitude > 45.9").collect()] == ["B"]
    assert df.where("network = 'N' and network = 'M'").count() == 0
    with pytest.raises(Exception, match="readers"):
        spark.read.format("tremor_stations").load("hdfs://x/y").collect()


def test_events_by_their_id(spark, tmp_path):
    services.register(spark)
    for k in range(5):
        row = {"event_id": f"smi:x/event/{k}", "event_type": "earthquake", "origin_id": f"o{k}", "origin_time": dt.datetime(2024, 1, 1, 0, k), "latitude": 45.0 + k, "longitude": 3.0, "depth_m": 5000.0, "arrivals": [{"pick_time": dt.datetime(2024, 1, 1, 0, k, 5), "network": "N", "station": "A", "phase": "P", "time_weight": 1.0, "time_residual": 0.1, "distance_deg": 0.5}]}
        (tmp_path / services.event_file(row["event_id"])).write_text(catalog_xml.document([catalog_xml.event_xml(row)]))
    df = spark.read.format("tremor_events").load(str(tmp_path))
    assert df.count() == 5 and df.rdd.getNumPartitions() == 5
    some = df.where(F.col("event_id").isin("smi:x/event/3", "smi:x/event/9", "smi:x/event/1"))
    assert sorted((r.event_id, r.latitude) for r in some.collect()) == [("smi:x/event/1", 46.0), ("smi:x/event/3", 48.0)] and some.rdd.getNumPartitions() == 2
    arrivals = spark.read.format("tremor_events").option("content", "arrivals").load(str(tmp_path)).where("event_id = 'smi:x/event/2'").collect()
    assert [(a.station, a.phase, a.pick_time) for a in arrivals] == [("A", "P", dt.datetime(2024, 1, 1, 0, 2, 5))]


def test_locator_text_round_trip(spark, tmp_path):
    parts = []
    for k in range(7):
        origin = {"location_id": f"loc/{k}", "status": "LOCATED" if k != 2 else "ABORTED", "origin_time": dt.datetime(2024, 2, 29, 23, 59, 58, 250000 + k), "latitude": 45.5, "longitude": -3.25, "depth_km": 8.0 + k, "rms": 0.125, "n_phases": 2, "gap": 120.5, "nearest_km": 3.5, "error_x_km": 0.5, "error_y_km": 1.0, "error_z_km": 2.0}
        phases = [{"station": f"ST{i}", "phase": p, "pick_time": dt.datetime(2024, 3, 1, 0, 0, i, 500), "uncertainty": 0.05, "travel_time": 2.5, "time_residual": -0.0625, "time_weight": 1.5, "distance_km": 20.25, "azimuth": 77.5} for i, p in enumerate("PS")] if k != 4 else []
        parts.append(locator_text.location_text(origin, phases))
    (tmp_path / "many.hyp").write_text("".join(parts[:5]))
    (tmp_path / "one.hyp").write_text(parts[5])
    (tmp_path / "odd.hyp").write_text(parts[6].replace("QUALITY", "OTHER").replace("END_PHASE\n", "").replace("58.25", "60.25") + "\nrubbish\n")
    rows = {r.location_id: r for r in locator_text.read_locations(spark, str(tmp_path)).collect()}
    assert set(rows) == {f"loc/{k}" for k in range(7)} and rows["loc/2"].status == "ABORTED"
    r = rows["loc/3"]
    assert (r.origin_time, r.latitude, r.longitude, r.depth_km, r.rms, r.n_phases, r.gap, r.nearest_km, r.error_x_km, r.error_z_km, r.n_lines) == (dt.datetime(2024, 2, 29, 23, 59, 58, 250003), 45.5, -3.25, 11.0, 0.125, 2, 120.5, 3.5, 0.5, 2.0, 2)
    assert rows["loc/4"].n_lines == 0 and rows["loc/6"].rms is None and rows["loc/6"].n_lines == 0 and rows["loc/6"].origin_time == dt.datetime(2024, 3, 1, 0, 0, 0, 250006)
    phases = locator_text.read_phases(spark, str(tmp_path)).where("location_id = 'loc/5'").orderBy("ord").collect()
    assert [(p.station, p.phase, p.pick_time, p.uncertainty, p.time_residual, p.time_weight, p.distance_km, p.azimuth) for p in phases] == [(f"ST{i}", x, dt.datetime(2024, 3, 1, 0, 0, i, 500), 0.05, -0.0625, 1.5, 20.25, 77.5) for i, x in enumerate("PS")]


def test_functions_of_sql_equal_the_columns(spark):
    assert len(sql.register(spark)) == len(sql.FUNCTIONS)
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0), (0.0, 0.0)]
    rows = [(44.0, 3.0, 45.0, 4.0, "Pn", 2_500_150, ring), (0.0, 0.0, 0.0, 0.0, "Sg", 99_999, ring), (1.0, 2.0, 1.5, None, "x", 1_704_067_200_123_456, ring), (3.5, 2.0, 1.0, 1.0, None, None, ring)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, p string, us long, r array<struct<lon: double, lat: double>>").withColumn("t", F.timestamp_micros("us"))
    df.createOrReplaceTempView("rows")
    got = spark.sql("""SELECT tremor_great_circle_km(a, b, c, d), tremor_pseudo_time(a, b, 5.0D), tremor_round_time(t), tremor_phase_family(p), tremor_first_letter(p), tremor_pick_uncertainty(p, 0.1D, 0.2D),
      tremor_event_key('tr', t), tremor_inside_ring(b, a, r), tremor_used_arrival(a, b), tremor_net_station('N.A.00.H'), tremor_last_segment('x/y/z'), tremor_km_to_degrees(111.0D) FROM rows""")
    col = F.col
    want = df.select(geo.great_circle_km(col("a"), col("b"), col("c"), col("d")), geo.pseudo_time(col("a"), col("b"), 5.0), picks.round_time(col("t")), picks.phase_family(col("p")), picks.first_letter(col("p")), picks.uncertainty(col("p"), 0.1, 0.2), catalog.event_key("tr", col("t")), geo.inside_polygon(col("b"), col("a"), col("r")), F.coalesce((col("a") != 0) & (col("b") != 0), F.lit(False)), F.lit("N.A"), F.lit("z"), F.lit(1.0))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert "Python" not in got._jdf.queryExecution().toString()

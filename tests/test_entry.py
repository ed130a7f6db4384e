import ast
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tremor.sources import catalog_xml, tables

ROOT = Path(__file__).resolve().parents[1]


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_nothing_outside_imports_the_language_model_package():
    for path in (ROOT / "tremor").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("tremor.llm") for n in names), path


@pytest.mark.parametrize("name", ["picks_normalize", "picks_dedup_1d", "windows_overlap", "zone_lookup", "bulletin_match"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders"):
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    got = contract.queries()[name](spark, d)
    columns = sorted(got.columns)
    want = con.sql(f"select {', '.join(columns)} from ({contract.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want))


def test_text_sources(spark, tmp_path):
    (tmp_path / "second.csv").write_text("seedid,phasename,time,probability\nN.A.00.HH.Z,P,2023-02-13T18:30:58.558999Z,0.5\n")
    df = tables.read_picks(spark, str(tmp_path / "second.csv"))
    assert {"station_id", "phase_type", "phase_time", "phase_score"} <= set(df.columns) and df.first().phase_score == 0.5
    tables.write_picks(df, str(tmp_path / "out"))
    assert "2023-02-13T18:30:58.558999Z" in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    with pytest.raises(Exception):
        tables.write_picks(df, str(tmp_path / "out"))
    (tmp_path / "bad.csv").write_text("seedid,phasename\nx,P\n")
    with pytest.raises(ValueError):
        tables.read_picks(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "st.txt").write_text("#Network | Station | Latitude | Longitude | Elevation\nN|A| 45.5 |3.0|100\nN|B|46|4|\n")
    rows = {r.station: (r.latitude, r.elevation) for r in tables.read_stations(spark, str(tmp_path / "st.txt")).collect()}
    assert rows == {"A": (45.5, 100.0), "B": (46.0, None)}
    (tmp_path / "hints").write_text("N_A_00_HHZ\nN_A_00_HHN\nN_B__\n")
    hints = {(r.station, r.location, r.channel) for r in tables.read_hints(spark, str(tmp_path / "hints")).collect()}
    assert hints == {("A", "00", "HH"), ("B", "", "")}
    (tmp_path / "scat").write_text("a\nb\nc\n 1.0  2.0 3.0  0.1 0.2\n")
    assert tuple(tables.read_scatter(spark, str(tmp_path / "scat")).first()) == (1.0, 2.0, 3.0, 0.1, 0.2)


def test_catalog_round_trip(spark, tmp_path):
    schema = "event_id string, event_type string, origin_id string, origin_time timestamp, latitude double, longitude double, depth_m double, method_id string, comments array<string>, arrivals array<struct<pick_time: timestamp, network: string, station: string, phase: string, time_weight: double, time_residual: double, distance_deg: double>>"
    rows = spark.sql("select 'e' || id as event_id, 'earthquake' as event_type, 'o' || id as origin_id, timestamp_seconds(id * 60) as origin_time, 45.0D as latitude, 3.0D as longitude, 5000.0D as depth_m, 'm' as method_id, array('{}') as comments, array(named_struct('pick_time', timestamp_seconds(id * 60 + 5), 'network', 'N', 'station', 'A', 'phase', 'P', 'time_weight', 1.0D, 'time_residual', 0.1D, 'distance_deg', 0.5D)) as arrivals from range(25)")
    assert len(rows.columns) == len(schema.split(", ")) - 6
    catalog_xml.write_catalog(rows, str(tmp_path / "cat"), per_file=10, partitions=2)
    path = str(tmp_path / "cat") + "/part*"
    events, arrivals = catalog_xml.read_origins(spark, path), catalog_xml.read_arrivals(spark, path)
    assert {r.event_id for r in events.collect()} == {f"e{i}" for i in range(25)} and events.first().depth_m == 5000.0
    assert arrivals.count() == 25 and {r.station for r in arrivals.collect()} == {"A"}


def test_config(tmp_path):
    (tmp_path / "c.yml").write_text("a: &x /data\nb: !join [*x, /picks, .csv]\n")
    assert catalog_xml.read_config(tmp_path / "c.yml")["b"] == "/data/picks.csv"


def test_inventory_and_formats(spark, tmp_path):
    (tmp_path / "inv.xml").write_text('<FDSNStationXML xmlns="x"><Network code="N"><Station code="A"><Latitude>1</Latitude><Longitude>2</Longitude><Elevation>3</Elevation><Channel code="HHZ" startDate="2020-01-01T00:00:00"><Latitude>1.5</Latitude><Longitude>2.5</Longitude><Elevation>3.5</Elevation></Channel></Station><Station code="B"><Latitude>4</Latitude><Longitude>5</Longitude><Elevation>6</Elevation></Station></Network></FDSNStationXML>')
    rows = {r.station: (r.channel, r.latitude) for r in catalog_xml.read_inventory(spark, str(tmp_path / "inv.xml")).collect()}
    assert rows == {"A": ("HHZ", 1.5), "B": (None, 4.0)}
    catalog_xml.write_events(spark.range(3), str(tmp_path / "j"), "json")
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    with pytest.raises(ValueError):
        catalog_xml.write_events(spark.range(3), str(tmp_path / "k"), "other")
    assert catalog_xml.render("a {X} b", {"{X}": "1"}) == "a 1 b"


def test_stream(spark, tmp_path):
    from tremor.streaming.incremental import clean_stream, window_counts

    rows = spark.sql("select 'N.A.00' as station_id, 'P' as phase_type, timestamp_seconds(1000 + id div 2 * 10) as phase_time, 0.9D as phase_score from range(40)")
    rows.write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, df, mode in (("cleaned", clean_stream(source()), "append"), ("counted", window_counts(source(), "1 minute"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("cleaned").count() == 20
    assert spark.sql("select sum(n_picks) from counted").first()[0] == 40

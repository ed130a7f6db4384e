import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tremor.functions.geo import geodesic_km, great_circle_km, vincenty_km
from tremor.operators import catalog, clusters, density, locate, pairs, picks, windows
from tremor.operators.components import connected_components


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


PICKS = "pick_ord long, station_id string, phase_type string, phase_time timestamp, phase_score double"


def ts(seconds):
    return pd.Timestamp("2024-01-01", tz="UTC") + pd.Timedelta(microseconds=round(seconds * 1e6))


def pick_rows(spark, rows):
    times = frame(spark, [(i, s, p, round(1704067200e6 + t * 1e6), q) for i, s, p, t, q in rows], "pick_ord long, station_id string, phase_type string, us long, phase_score double")
    return times.withColumn("phase_time", F.timestamp_micros("us")).drop("us")


def test_rounding_is_half_even(spark):
    df = pick_rows(spark, [(i, "A.B", "P", t, 0.5) for i, t in enumerate([0.00015, 0.00025, 0.00035, 0.000251])])
    got = {r[0]: r[1] % 1000 for r in picks.normalize(df).select("pick_ord", picks.micros(F.col("phase_time"))).collect()}
    assert got == {0: 200, 1: 200, 2: 400, 3: 300}


def test_thresholds_hold_for_exact_names_only(spark):
    df = pick_rows(spark, [(0, "A", "P", 0, 0.1), (1, "A", "Pn", 0, 0.1), (2, "A", "S", 0, 0.4), (3, "A", "Sg", 0, 0.4), (4, "A", "P", 0, None)])
    assert {r.pick_ord for r in picks.above_threshold(df, 0.2, 0.5).collect()} == {1, 3}


def test_sessions_include_the_limit(spark):
    df = pick_rows(spark, [(0, "A", "P", 0.0, 0.5), (1, "A", "Pn", 0.1, 0.5), (2, "A", "P", 0.200001, 0.9), (3, "B", "P", 0.0, 0.1), (4, "A", "X", 0.0, 0.1)])
    assert {r.pick_ord for r in picks.dedup_close(df, 0.1, 0.2).collect()} == {1, 2, 3, 4}


def test_station_epochs(spark):
    df = picks.normalize(pick_rows(spark, [(0, "N.A.00", "P", 0, 0.5), (1, "N.B.00", "P", 0, 0.5)]))
    stations = frame(spark, [("N", "A", "H", "2000-01-01", "2010-01-01", 1.0, 1.0, 0.0), ("N", "A", "H", "2010-01-01", None, 2.0, 2.0, 0.0)], "network string, station string, channel string, start_date string, end_date string, latitude double, longitude double, elevation double")
    stations = stations.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    assert [(r.pick_ord, r.latitude) for r in picks.with_coordinates(df, stations).collect()] == [(0, 2.0)]


def test_unload_removes_exact_keys(spark):
    df = pick_rows(spark, [(0, "A", "P", 0, 0.5), (1, "A", "P", 0.0001, 0.5), (2, "A", "S", 0, 0.5)])
    assert {r.pick_ord for r in picks.unload(df, df.where("pick_ord = 0")).collect()} == {1, 2}


def test_windows_hold_every_pick(spark):
    df = pick_rows(spark, [(i, "A", "P", i * 30.0, 0.5) for i in range(41)])
    got = windows.assign(df, 600.0, 60.0).groupBy("window_id").agg(F.min("pick_ord"), F.max("pick_ord")).orderBy("window_id").collect()
    assert [tuple(r) for r in got] == [(0, 0, 19), (1, 18, 39), (2, 38, 40)]
    left = windows.assign(df, 600.0, 60.0, keep_last=False)
    assert left.where("pick_ord = 40").count() == 0


def test_pairs_are_symmetric_and_bounded(spark):
    df = pick_rows(spark, [(i, "A", "P", i * 1.0, 0.5) for i in range(6)]).withColumns({"latitude": F.lit(45.0), "longitude": F.lit(3.0), "window_id": F.lit(0)})
    assert pairs.pseudo_distances(df, 5.0).count() == 15
    assert pairs.pseudo_distances(df, 5.0, max_tt=2.0).count() == 9
    assert {round(r.tt, 6) for r in pairs.neighbour_curve(pairs.pseudo_distances(df, 5.0), 2).collect()} == {1.0}


def test_distances(spark):
    assert abs(vincenty_km([48.0], [2.0], [43.0], [5.0])[0] - 601.7) < 1.5
    assert vincenty_km([10.0], [20.0], [10.0], [20.0])[0] == 0
    assert np.isfinite(vincenty_km([0.0], [0.0], [0.3], [179.9])[0])
    df = spark.createDataFrame([(48.0, 2.0, 43.0, 5.0)], "a double, b double, c double, d double")
    r = df.select(geodesic_km("a", "b", "c", "d").alias("e"), great_circle_km(*map(F.col, "abcd")).alias("g")).first()
    assert abs(r.e - r.g) < 3


def test_components(spark):
    rows = [(i, i + 1) for i in range(1, 30)] + [(50, 60), (60, 55), (None, 1), (7, 7)] + [(100, 100 + i) for i in range(1, 20)]
    got = {r.node: r.component for r in connected_components(frame(spark, rows, "a long, b long")).collect()}
    assert got[30] == 1 and got[55] == 50 and got[119] == 100 and len(got) == 30 + 3 + 20
    assert connected_components(frame(spark, [], "a long, b long")).count() == 0


def two_quakes(seed=3):
    """Twelve stations on a ring, two events 40 s apart, five noise picks."""
    rng = np.random.default_rng(seed)
    a = np.arange(12) * np.pi / 6
    lat, lon = 44 + 0.9 * np.sin(a), 3 + 1.25 * np.cos(a)
    rows, n = [], 0
    for k, (la, lo, dep, t0) in enumerate([(44.1, 3.1, 8.0, 100.0), (43.85, 2.8, 12.0, 140.0)]):
        for i in range(12):
            km = float(vincenty_km([la], [lo], [lat[i]], [lon[i]])[0])
            for phase, v in (("P", 6.0), ("S", 3.5)):
                rows.append((n, f"XX.S{i:02d}", phase, t0 + np.hypot(km, dep) / v, lat[i], lon[i], k))
                n += 1
    for t in rng.uniform(0, 1000, 5):
        rows.append((n, "XX.S03", "P", float(t), lat[3], lon[3], -1))
        n += 1
    return rows


def test_location_finds_the_source(spark):
    rows = [r for r in two_quakes() if r[6] == 0]
    obs = pd.DataFrame({"pick_ord": [r[0] for r in rows], "station_id": [r[1] for r in rows], "phase_type": [r[2] for r in rows], "us": [round(r[3] * 1e6) for r in rows], "latitude": [r[4] for r in rows], "longitude": [r[5] for r in rows], "uncertainty": 0.1})
    f = locate.locate(obs, locate.LocatorSettings())
    assert float(vincenty_km([f["latitude"]], [f["longitude"]], [44.1], [3.1])[0]) < 4
    assert abs(f["origin_us"] / 1e6 - 100) < 1.0 and f["gap"] < 60
    assert locate.locate(obs[:3], locate.LocatorSettings()) is None
    wrong = obs.copy()
    wrong.loc[0, "us"] += 5_000_000
    g = locate.locate(wrong, locate.LocatorSettings())
    kept = locate.clean(wrong, g, locate.LocatorSettings())
    assert 0 not in set(kept["pick_ord"]) and len(kept) >= 20


def test_misfit_equals_all_pairs_and_takes_large_clusters():
    rng = np.random.default_rng(3)
    s = locate.LocatorSettings()
    points = rng.uniform(0, 30, (5, 3))
    for n in (2, 7, 40):
        obs = {"x": rng.uniform(-50, 50, n), "y": rng.uniform(-50, 50, n), "t": rng.uniform(0, 20, n), "p": rng.random(n) < 0.5, "sigma": rng.choice([0.1, 0.2], n)}
        km = np.hypot(points[:, None, 0] - obs["x"], points[:, None, 1] - obs["y"])
        tt = np.where(obs["p"], s.model.time("P", km, points[:, None, 2]), s.model.time("S", km, points[:, None, 2]))
        r, var = obs["t"] - tt, obs["sigma"] ** 2 + s.model_error**2
        i, j = np.triu_indices(n, 1)
        want = (np.exp(-((r[:, i] - r[:, j]) ** 2) / (var[i] + var[j])) / np.sqrt(var[i] + var[j])).sum(axis=1) / len(i)
        assert np.allclose(locate._misfit(points, obs, s)[0], n * np.log(want))
    n = 3000
    rows = pd.DataFrame({"pick_ord": range(n), "station_id": [f"X.S{i % 40:02d}" for i in range(n)], "phase_type": "P", "us": np.sort(rng.integers(0, 86_400_000_000, n)), "latitude": 44 + np.arange(n) % 40 * 0.02, "longitude": 3 + np.arange(n) % 7 * 0.05, "uncertainty": 0.1})
    assert locate.locate(rows, locate.LocatorSettings(budget=600)) is not None


def test_windows_merge_with_the_one_before_only(spark):
    from tremor.plans.pipeline import merge_labels

    # Each window's cluster shares two picks with the next window's: the second goes into the first, the fourth into the third.
    labels = frame(spark, [(w, p, 0) for w in range(4) for p in range(4 * w, 4 * w + 6)] + [(2, 90, 1), (3, 91, 1), (2, 92, -1)], "window_id long, pick_ord long, label int")
    rows = frame(spark, [(p, "e" if p in (90, 91) else None) for p in [*range(30), 90, 91, 92]], "pick_ord long, eventid string")
    got = {}
    for r in merge_labels(labels, rows, 2).collect():
        got.setdefault(r.cluster_id, set()).add(r.pick_ord)
    assert got == {0: set(range(10)), 200000: set(range(8, 18)), 200001: {90, 91}}
    assert clusters.fold_links([(0, 1, 1, 11), (1, 11, 1, 12), (1, 12, 2, 21)]) == {11: 1, 12: 1}


def test_chains_of_windows_fold_as_one(spark):
    import random

    from tremor.operators.chain import fold_chain

    rng = random.Random(4)
    quads = []
    for w in range(400):
        have, nxt = [10 * w + k for k in range(1 + w % 3)], [10 * (w + 1) + k for k in range(1 + (w + 1) % 3)]
        quads += [(w, a, w + 1, b) for a in have for b in nxt if rng.random() < (0.9 if w != 77 else 0)]
        quads += [(w, have[0], w, have[-1])] if len(have) > 1 and rng.random() < 0.2 else []
    want = clusters.fold_links(quads)
    df = frame(spark, quads, "w1 long, c1 long, w2 long, c2 long")
    for block, fan, reach in ((10, 4, 8), (7, 1000, 8), (5, 3, 1), (5, 1000, 0), (1000, 1000, 8)):
        assert {r.old: r.new for r in fold_chain(df, block, fan, reach).collect()} == want, (block, fan, reach)
    assert fold_chain(df.limit(0)).count() == 0


def test_a_chain_of_a_hundred_thousand_windows(spark):
    # One cluster a window, each sharing picks with the next: every second one goes into the one before.
    links = spark.range(99_999).selectExpr("id as w1", "id * 10 as c1", "id + 1 as w2", "(id + 1) * 10 as c2")
    from tremor.operators.chain import fold_chain

    got = fold_chain(links).agg(F.count("*").alias("n"), F.count_if(F.expr("old % 20 = 10 and new = old - 10")).alias("right")).first()
    assert (got.n, got.right) == (50_000, 50_000)


def test_text_and_file_helpers(spark, tmp_path):
    from tremor.sources import tables

    df = frame(spark, [("smi:a b/c*~",)], "x string").select(catalog.quoted(F.col("x")).alias("q"), catalog.last_segment(F.col("x")).alias("l"), catalog.unquoted(catalog.quoted(F.col("x"))).alias("u"))
    assert tuple(df.first()) == ("smi%3Aa%20b%2Fc%2A~", "c*~", "smi:a b/c*~")
    cloud = frame(spark, [(1.0, 2.0, 3.0, 0.1, 0.5), (1.5, 2.5, 3.5, 0.1, 0.9)], "latitude double, longitude double, depth double, h1 double, h2 double")
    tables.write_scatter(cloud, str(tmp_path / "scat"))
    assert sorted(map(tuple, tables.read_scatter(spark, str(tmp_path / "scat")).collect())) == sorted(map(tuple, cloud.collect()))
    assert catalog.reach_km(cloud).first()["region_km"] > 100
    side = frame(spark, [(3, "alps", "t", "2024-01-01 00:00:00", 44.0, 3.0, 8000.0)], "cluster_id long, velocity_profile string, template string, time string, latitude double, longitude double, depth_m double")
    tables.write_velocity_sidecars(side, str(tmp_path / "vel"))
    assert tables.read_velocity_sidecars(spark, str(tmp_path / "vel")).select("velocity_profile", "depth_m").first() == ("alps", 8000.0)
    pairs_ = frame(spark, [(0, 1, 2, 0.5)], "window_id long, i long, j long, tt double")
    tables.save_distances(pairs_, str(tmp_path / "tt"))
    assert tables.load_distances(spark, str(tmp_path / "tt")).collect() == pairs_.collect()
    obs = frame(spark, [(1, "S1", "P", "2024-01-01 00:00:02", 0.1), (1, "S2", "S", "2024-01-01 00:00:01", 0.2), (2, "S1", "P", "2024-01-01 00:00:01", 0.1)], "cluster_id long, station string, phase_type string, phase_time string, uncertainty double")
    tables.write_observations(obs.withColumn("phase_time", F.to_timestamp("phase_time")), str(tmp_path / "obs"))
    assert [r.value[:2] for r in spark.read.text(str(tmp_path / "obs" / "cluster_id=1")).collect()] == ["S2", "S1"]


def test_location_and_association_as_queries(spark):
    rows = two_quakes()
    base = 1704067200e6
    df = frame(spark, [(r[0], r[1], r[2], round(base + r[3] * 1e6), float(r[4]), float(r[5]), max(r[6], 0)) for r in rows], "pick_ord long, station_id string, phase_type string, us long, latitude double, longitude double, cluster_id long")
    df = df.withColumn("phase_time", F.timestamp_micros("us")).drop("us").withColumn("uncertainty", F.lit(0.1))
    found = locate.locate_clusters(df).toPandas()
    assert sorted(zip(found["cluster_id"], found["pass"], strict=True)) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    one = df.withColumn("cluster_id", F.lit(7).cast("long"))
    events = locate.associate_clusters(one).toPandas()
    assert events["event"].nunique() == 2 and events.groupby("event").size().min() >= 20


def test_a_large_cluster_is_searched_by_many_tasks(spark):
    rng = np.random.default_rng(5)
    quake = [r for r in two_quakes() if r[6] == 0]
    base = 1704067200e6
    rows = [(r[0], r[1], r[2], round(base + (1000 + r[3]) * 1e6), float(r[4]), float(r[5])) for r in quake for _ in range(6)]
    sites = {r[1]: (float(r[4]), float(r[5])) for r in quake}
    for t, k in zip(rng.uniform(0, 3000, 1500), rng.integers(0, 12, 1500), strict=True):
        rows.append((0, f"XX.S{k:02d}", "P", round(base + t * 1e6), *sites[f"XX.S{k:02d}"]))
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    df = frame(spark, [(c, *r) for c in (1, 2) for r in rows] + [(3, *r) for r in rows[:40]], "cluster_id long, pick_ord long, station_id string, phase_type string, us long, latitude double, longitude double")
    df = df.withColumn("phase_time", F.timestamp_micros("us")).drop("us").withColumn("uncertainty", F.lit(0.1))
    one, many = ({(r.cluster_id, r["pass"]): r for r in locate.locate_clusters(df, large=n).drop("arrivals").collect()} for n in (10**9, 1000))
    assert one.keys() == many.keys() and one[3, 1] == many[3, 1]
    for k in one:
        assert float(vincenty_km([one[k].latitude], [one[k].longitude], [many[k].latitude], [many[k].longitude])[0]) < 2
        assert float(vincenty_km([many[k].latitude], [many[k].longitude], [44.1], [3.1])[0]) < 4 and abs(one[k].origin_us - many[k].origin_us) < 1_000_000


def test_association_takes_as_many_events_as_there_are():
    rows = [(r, k) for k in range(20) for r in two_quakes() if r[6] == 0]
    obs = pd.DataFrame({"pick_ord": range(len(rows)), "station_id": [r[1] for r, _ in rows], "phase_type": [r[2] for r, _ in rows], "us": [round((r[3] + 600 * k) * 1e6) for r, k in rows], "latitude": [r[4] for r, _ in rows], "longitude": [r[5] for r, _ in rows], "uncertainty": 0.1})
    found = locate.associate(obs.sort_values(["us", "station_id", "phase_type"], ignore_index=True), locate.AssociatorSettings())
    assert len(found) == 20 and sum(len(p) for _, p in found) >= 20 * 20


def test_nodes_bound_what_their_points_can_explain():
    from tremor.operators import octree

    rows = two_quakes()
    obs = pd.DataFrame({"pick_ord": [r[0] for r in rows], "station_id": [r[1] for r in rows], "phase_type": [r[2] for r in rows], "us": [round(r[3] * 1e6) for r in rows], "latitude": [r[4] for r in rows], "longitude": [r[5] for r in rows], "uncertainty": 0.1})
    rng = np.random.default_rng(2)
    for model in (locate.VelocityModel(), locate.VelocityModel((0.0, 3.0, 20.0), (4.0, 6.0, 8.0), (2.3, 3.5, 4.6), "first")):
        v = octree.Volume(obs, locate.AssociatorSettings(locator=locate.LocatorSettings(model=model)))
        every = np.arange(len(obs))
        for root in v.roots():
            for part in octree.divided(octree.divided(root[None]))[::37]:
                inside = part[:4] + rng.uniform(-1, 1, (20, 4)) * part[4:]
                points = np.concatenate([inside, np.zeros((20, 4))], axis=1)
                assert not (v.consistent(points, every) & ~v.consistent(part[None], every)).any()


def test_first_arrivals_agree_with_closed_forms():
    m = locate.VelocityModel((0.0, 20.0), (6.0, 8.0), (3.5, 4.6), "first")
    rng = np.random.default_rng(0)
    km, z = rng.uniform(0, 400, 5000), rng.uniform(0, 20, 5000)
    cosine = np.sqrt(1 - 0.75**2)
    head = np.where(km >= (40 - z) * 0.75 / cosine, km / 8 + (40 - z) * cosine / 6, np.inf)
    assert np.abs(m.time("P", km, z) - np.minimum(np.hypot(km, z) / 6, head)).max() < 1e-3
    # From below the second layer's top: the earliest way over all places where a ray may cross it (Fermat).
    for x, depth in zip(rng.uniform(0, 300, 40), rng.uniform(20.5, 60, 40), strict=True):
        u = np.linspace(0, x, 400_001)
        assert abs(m.time("P", x, depth) - (np.hypot(u, 20) / 6 + np.hypot(x - u, depth - 20) / 8).min()) < 1e-3
    assert abs(locate.VelocityModel(rays="first").time("S", 30.0, 8.0) - np.hypot(30, 8) / 3.5) < 1e-9


def test_events_that_overlap_are_told_apart_and_failures_block_nothing():
    rng = np.random.default_rng(8)
    a = np.arange(14) * np.pi / 7
    lat, lon = 44 + 0.9 * np.sin(a), 3 + 1.25 * np.cos(a)
    rows, true = [], []
    for k in range(40):
        la, lo, dep, t0 = 44 + rng.uniform(-0.5, 0.5), 3 + rng.uniform(-0.7, 0.7), rng.uniform(3, 15), 90.0 * (k // 2) + (k % 2) * rng.uniform(3, 20)
        true.append((la, lo, t0))
        for i in rng.permutation(14)[:11]:
            km = float(vincenty_km([la], [lo], [lat[i]], [lon[i]])[0])
            rows += [(f"XX.S{i:02d}", phase, t0 + np.hypot(km, dep) / v + rng.normal(0, 0.05), lat[i], lon[i]) for phase, v in (("P", 6.0), ("S", 3.5))]
    rows += [(f"XX.S{i:02d}", rng.choice(["P", "S"]), t, lat[i], lon[i]) for i, t in zip(rng.integers(0, 14, 150), rng.uniform(0, 1900, 150), strict=True)]
    obs = pd.DataFrame(rows, columns=["station_id", "phase_type", "t", "latitude", "longitude"]).assign(uncertainty=0.1)
    obs["us"] = (obs.pop("t") * 1e6).round().astype("int64")
    obs = obs.assign(pick_ord=range(len(obs))).sort_values(["us", "station_id", "phase_type"], ignore_index=True)
    found = locate.associate(obs, locate.AssociatorSettings(n_picks=10))
    near = lambda e, q: abs(e["origin_us"] / 1e6 - q[2]) < 2 and vincenty_km([e["latitude"]], [e["longitude"]], [q[0]], [q[1]])[0] < 10
    assert sum(any(near(e, q) for e, _ in found) for q in true) >= 38
    assert len(found) <= 42 and len({p for _, f in found for p in f["pick_ord"]}) == sum(len(f) for _, f in found)


def test_a_cluster_of_150_events_keeps_them_apart(spark):
    from tremor.plans import pipeline

    rows = [r for r in two_quakes() if r[6] == 0]
    base = 1704067200e6
    every = [(k * 100 + i, r[1] + ".00.HH", r[2], round(base + (r[3] + 120 * k) * 1e6), 0.9) for k in range(150) for i, r in enumerate(rows)]
    df = frame(spark, every, "pick_ord long, station_id string, phase_type string, us long, phase_score double").withColumn("phase_time", F.timestamp_micros("us")).drop("us")
    stations = frame(spark, sorted({("XX", r[1][3:], float(r[4]), float(r[5]), 0.0) for r in rows}), "network string, station string, latitude double, longitude double, elevation double")
    # A search distance beyond the gaps makes one cluster of all.
    s = pipeline.Settings(time_window=86400.0, max_search_dist=1e6, associate=True, locator=locate.LocatorSettings(budget=600))
    out = pipeline.run(df, stations, s)
    events = out["events"].select("cluster_id", "origin_us", "latitude", "longitude").toPandas()
    assert len(events) == 150 and events["cluster_id"].is_unique and out["members"].count() == 150 * 24
    assert set(((events["origin_us"] - base) / 1e6 / 120).round().astype(int)) == set(range(1, 151))


def test_hdbscan_separates_groups_and_noise():
    rng = np.random.default_rng(1)
    pts = np.concatenate([rng.normal(0, 0.3, (30, 2)), rng.normal(10, 0.3, (25, 2)), rng.uniform(-30, 40, (6, 2))])
    d = np.hypot(*(pts[:, None, k] - pts[None, :, k] for k in (0, 1)))
    labels, strength = density.hdbscan(d, 8)
    assert len(set(labels[:30])) == 1 and len(set(labels[30:55])) == 1 and labels[0] != labels[30]
    assert labels[0] >= 0 and labels[30] >= 0 and (labels[55:] == -1).sum() >= 3
    assert (strength[labels >= 0] > 0).all() and (strength[labels < 0] == 0).all()
    assert (density.hdbscan(d[:5, :5], 8)[0] == -1).all()
    same = density.hdbscan(np.zeros((10, 10)), 5)[0]
    assert (same == 0).all()


def random_picks(n, span, seed=0):
    rng = np.random.default_rng(seed)
    us, site = np.sort((rng.random(n) * span * 1e6).astype(np.int64)), rng.integers(0, 40, n)
    return us, 42 + site * 37 % 40 * 0.15, -2 + site * 23 % 40 * 0.2


def test_spanning_trees_of_picks_equal_those_of_matrices():
    for n, span, k in ((2000, 900, 8), (2000, 86400, 5), (300, 0, 5), (2, 10, 8), (60, 5, 1)):
        us, lat, lon = random_picks(n, span, n)
        d = density.pseudo_matrix(us, lat, lon, 5.0)
        for m in (density.PickTimes(us, lat, lon, 5.0), density.PickTimes(us, lat, lon, 5.0, ellipsoid=True)):
            want = density.spanning_tree(d if not m.ellipsoid else density.pseudo_matrix(us, lat, lon, 5.0, True), k)
            got = density.pick_tree(m, k)
            assert np.array_equal(got[:, 1:], want[:, 1:]) and np.allclose(got[:, 0], want[:, 0], rtol=1e-12)
        labels, strength = density.hdbscan(d, 8, 2.0)
        assert np.array_equal(labels, density.hdbscan_picks(density.PickTimes(us, lat, lon, 5.0), 8, 2.0)[0])


def test_a_window_of_many_picks_needs_no_matrix():
    import tracemalloc

    us, lat, lon = random_picks(50_000, 86400)
    tracemalloc.start()
    labels, _ = density.hdbscan_picks(density.PickTimes(us, lat, lon, 5.0), 8)
    assert len(labels) == 50_000 and tracemalloc.get_traced_memory()[1] < 500e6  # a matrix would have 20 GB
    tracemalloc.stop()


def test_clustering_by_window(spark):
    rows = two_quakes()
    base = 1704067200e6
    df = frame(spark, [(r[0], r[1], r[2], round(base + r[3] * 1e6), float(r[4]), float(r[5])) for r in rows], "pick_ord long, station_id string, phase_type string, us long, latitude double, longitude double")
    df = df.withColumn("phase_time", F.timestamp_micros("us")).withColumn("window_id", F.lit(0).cast("long"))
    got = density.cluster_windows(df, 5.0, 8).toPandas()
    assert len(got) == len(rows) and got["label"].max() >= 0


def test_merges():
    assert clusters.merge_by_eventid([{1}, {1, 2}, {2}]) == [[0, 1], [2]]
    assert clusters.merge_by_eventid([{1}, {1, 2}, {2}], transitive=True) == [[0, 1, 2]]
    grown, rest = clusters.fold_windows([["a", "b", "c"], ["x"]], [["b", "c", "d"], ["c", "d", "e"], ["z"]], 2)
    assert grown == [["a", "b", "c", "d", "e"], ["x"]] and rest == [["z"]]
    merged, origin = clusters.merge_to_fixpoint([[1, 2, 3], [7, 8], [3, 2, 9], [9, 3, 10, 11]], ["p", "q", "r", "s"], 2)
    assert merged == [[1, 2, 3, 9, 10, 11], [7, 8]] and origin[1] == "q"
    assert clusters.merge_to_fixpoint(merged, origin, 2)[0] == merged


def test_arrival_dedup_is_by_size_unless_signed(spark):
    df = frame(spark, [(1, 1, "S", "P", -0.3), (1, 2, "S", "P", 0.1), (1, 3, "S", "P", -0.3)], "event_id long, ord int, station string, phase string, time_residual double")
    assert [r.ord for r in catalog.dedup_arrivals(df).collect()] == [2]
    assert [r.ord for r in catalog.dedup_arrivals(df, corrected=False).collect()] == [3]


def test_dropped_picks_hand_over_their_arrivals(spark):
    df = frame(spark, [(1, "A"), (2, "A"), (3, "A"), (4, "B")], "pick_id long, k string")
    kept, moved = catalog.dedup_picks(df, ["k"])
    arrivals = frame(spark, [(1,), (2,), (3,), (4,)], "pick_id long")
    assert {r.pick_id for r in kept.collect()} == {1, 4}
    assert sorted(r.pick_id for r in catalog.remap_arrivals(arrivals, moved).collect()) == [1, 1, 1, 4]


def test_relocation_and_origin_filters(spark):
    rows = [r for r in two_quakes() if r[6] == 0]
    arrivals = frame(spark, [(1, r[0], r[1], r[2].lower(), round(1704067200e6 + r[3] * 1e6), 1.0 if r[0] else 0.0) for r in rows], "event_id long, ord int, station string, phase string, us long, time_weight double").withColumn("pick_time", F.timestamp_micros("us"))
    stations = frame(spark, list({(r[1], float(r[4]), float(r[5])) for r in rows}), "station string, latitude double, longitude double")
    got = locate.relocate(arrivals, stations, [1]).where("pass = 1").collect()
    assert len(got) == 1 and len(got[0].arrivals) == len(rows) - 1
    assert float(vincenty_km([got[0].latitude], [got[0].longitude], [44.1], [3.1])[0]) < 5
    assert locate.relocate(arrivals, stations, [2]).count() == 0
    origins = frame(spark, [(1, 1.0, "LOCATED"), (2, float("nan"), "LOCATED"), (3, 1.0, "Aborted"), (4, 1.0, None)], "event_id long, e double, status string")
    assert {r.event_id for r in catalog.sound_origins(origins, ["e"], "status").collect()} == {1, 4}
    assert {r.agency for r in catalog.stamped(origins, agency="XX").collect()} == {"XX"}


def test_window_merges(spark):
    rows = [(0, 0, 1, "a"), (0, 1, 2, "a"), (0, 1, 3, "b"), (0, 2, 4, "b"), (0, -1, 5, None), (1, 0, 6, None)]
    df = frame(spark, rows, "window_id long, label int, pick_ord long, eventid string")
    got = {r.pick_ord: r.label for r in clusters.merge_windows_by_eventid(df).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: -1, 6: 0}
    assert {r.pick_ord: r.label for r in clusters.merge_windows_to_fixpoint(df, 2).where("window_id = 0").collect()} == {1: 0, 2: 0, 3: 0, 4: 0}


def test_zone_cells_leave_no_point_to_a_nested_loop(spark):
    rng = np.random.default_rng(6)
    zones, rings = [], []
    for k in range(12):
        a = np.sort(rng.uniform(0, 2 * np.pi, rng.integers(3, 12)))
        r = rng.uniform(0.05, 2.5, len(a))
        ring = [(float(5 + rng.uniform(-2, 2) + x), float(44 + y)) for x, y in zip(r * np.cos(a), r * np.sin(a), strict=True)]
        rings.append(ring + ring[:1])
        zones.append((k, f"z{k}", f"v{k % 5}", ring + ring[:1]))
    zones.append((12, "point", "v0", [(5.0, 44.0)] * 3))
    df = frame(spark, zones, "ord int, name string, velocity_profile string, points array<struct<lon: double, lat: double>>")
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform([0, 41], [10, 47], (4000, 2)))]
    pts += [(5000 + i, *p) for i, p in enumerate(p for r in rings for p in r)] + [(9000, None, 44.0)]
    points = frame(spark, pts, "event_id long, longitude double, latitude double")

    def inside(x, y, ring):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                hit = not hit
        return hit

    want = {i: next((f"z{k}" for k, r in enumerate(rings) if inside(x, y, r)), None) for i, x, y in pts if x is not None}
    for degrees in (0.25, 0.07, 3.0):
        found = catalog.first_zone(points, df, degrees=degrees)
        assert {r.event_id: r.zone for r in found.collect()} == {i: z for i, z in want.items() if z}
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    profiles = frame(spark, [(f"v{k}", 6.0) for k in range(5)], "velocity_profile string, vp double")
    assert catalog.zones_with_profiles(df, profiles).count() == 13
    assert catalog.zones_with_profiles(df, profiles.where("velocity_profile <> 'v3'")).count() == 0


def test_sessions_that_cross_bins_are_one(spark):
    rng = np.random.default_rng(4)
    t, rows = 0.0, []
    for i in range(600):
        t += rng.choice([0.05, 0.1, 0.15, 3.0], p=[0.6, 0.25, 0.1, 0.05])
        rows.append((i, "A" if i % 50 else None, rng.choice(["P", "Pn", "S", "X"], p=[0.7, 0.1, 0.15, 0.05]), round(t, 3), float(rng.integers(0, 4)) if i % 11 else None))
    df = pick_rows(spark, rows)
    want = set()
    for station in ("A", None):
        for family in "PS":
            mine = [r for r in rows if r[1] == station and family in r[2]]
            run: list = []
            for r in [*mine, None]:
                if r is None or (run and round(r[3] * 1e6) - round(run[-1][3] * 1e6) > (100_000 if family == "P" else 200_000)):
                    if run:
                        want.add(max(run, key=lambda q: (-1.0 if q[4] is None else q[4], q[2], -q[3]))[0])
                    run = []
                if r is not None:
                    run.append(r)
    want |= {r[0] for r in rows if r[2] == "X"}
    for bins in (0.5, 2.0, 3600.0):
        assert {r.pick_ord for r in picks.dedup_close(df, 0.1, 0.2, bins).collect()} == want


def test_nearest_distances_by_ever_wider_bins(spark):
    us, lat, lon = random_picks(400, 3000)
    rows = [(int(i % 2), int(i), int(u), float(a), float(b)) for i, (u, a, b) in enumerate(zip(us, lat, lon, strict=True))] + [(7, 1000, 5, 44.0, 3.0)]
    df = frame(spark, rows, "window_id long, pick_ord long, us long, latitude double, longitude double").withColumn("phase_time", F.timestamp_micros("us"))
    want = {(r.window_id, r.i): r.tt for r in pairs.neighbour_curve(pairs.pseudo_distances(df, 5.0), 6).collect()}
    for seconds in (None, 7.0, 1e6):
        got = {(r.window_id, r.i): r.tt for r in pairs.nearest_distances(df, 6, 5.0, seconds=seconds).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)

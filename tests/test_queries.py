"""Queries over picks with a known truth, at the smallest scale: what they find is where the events are."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tremor.functions.geo import great_circle_km
from tremor.plans import fixtures

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def truth(spark):
    return fixtures.quakes(spark, D).select("quake", "origin_s", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


def test_detected_events_are_the_true_ones(spark, truth):
    found = contract.queries()["detect_events"](spark, D)
    near = found.join(truth, F.abs(F.col("origin_us") / 1e6 - F.col("origin_s")) < 3).select("quake", great_circle_km(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon")).alias("km"), "event_id").collect()
    assert {r.quake for r in near if r.km < 10} == {r.quake for r in truth.collect()}
    assert len({r.event_id for r in near}) == found.count()


def test_relocated_events_are_where_they_were(spark, truth):
    got = contract.queries()["relocate"](spark, D)
    best = got.where("pass = 2").join(truth, F.col("cluster_id") == F.col("quake")).select(great_circle_km(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon")).alias("km"), (F.col("origin_us") / 1e6 - F.col("origin_s")).alias("s"), "used_phase_count").collect()
    assert len(best) == truth.count() and max(r.km for r in best) < 10 and max(abs(r.s) for r in best) < 2 and min(r.used_phase_count for r in best) >= 20


def test_recovery_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"create view customer as select * from '{D}/customer.parquet'")
    got = contract.queries()["quake_recovery"](spark, D)
    assert [tuple(r) for r in got.select("few_made_up", "most_found", "n_quakes").collect()] == con.sql(f"select few_made_up, most_found, n_quakes from ({contract.oracle_sql()['quake_recovery']})").fetchall()

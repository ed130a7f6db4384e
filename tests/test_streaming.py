"""The stream with carried state against the batch over the same picks."""

import pytest
from pyspark.sql import functions as F

from tests_support import quake_rows
from tremor.operators import density, windows
from tremor.plans import pipeline
from tremor.session import materialize
from tremor.streaming import carried


def test_streamed_members_equal_the_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    start, size, overlap = 1704067200_000_000, 600.0, 120.0
    rows = quake_rows(start, 12, 280.0)
    schema = "pick_ord long, station_id string, phase_type string, us long, latitude double, longitude double, eventid string"
    df = materialize(spark.createDataFrame(rows, schema).withColumn("phase_time", F.timestamp_micros("us")).drop("us"), "stream")
    # Files in the order of time, as a feed brings them; the last one only moves the watermark on.
    end = max(r[3] for r in rows)
    for k in range(6):
        a, b = start + (end - start) * k // 6, start + (end - start) * (k + 1) // 6
        df.where(f"unix_micros(phase_time) >= {a} and unix_micros(phase_time) < {b if k < 5 else end + 1}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    far = [(-1, "X.X", "P", end + 7200_000_000, 44.0, 3.0, None)]
    spark.createDataFrame(far, schema).withColumn("phase_time", F.timestamp_micros("us")).drop("us").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    members = carried.cluster_stream(stream, start, size, overlap, least=4)
    query = members.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.cluster_id, r.pick_ord) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assigned = windows.assign(df, size, overlap, start=(start, end + 10**9))
    labels = materialize(density.cluster_windows(assigned, 5.0, 8), "labels")
    want = {(r.cluster_id, r.pick_ord) for r in pipeline.merge_labels(labels, df, 4).collect()}
    assert got == want and len({c for c, _ in want}) >= 8


@pytest.mark.parametrize("least", [1, 2])
def test_merging_of_two_windows(least):
    before = [(0, 1, None), (0, 2, None), (1, 3, "e")]
    after = [(100_000, 1, None), (100_000, 2, None), (100_000, 4, "f"), (100_001, 9, "f"), (100_002, 8, "e"), (100_003, 7, None)]
    finished, rest = carried.merged_windows(before, after, 1, least)
    # The second goes by an event id that it shares with the first of its window.
    assert finished == [(0, 1), (0, 2), (0, 4), (0, 9), (1, 3), (1, 8)] and rest == [(100_003, 7, None)]

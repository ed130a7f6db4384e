"""Session helpers: local sessions for tests, and tables that cut a plan's lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cpus: int = 8, partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the engine expects (UTC, AQE, Arrow)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tremor")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where the setting is absent (tests, a laptop) a temporary folder is set
    once for the session; a cluster must name a shared one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = spark.conf.get("tremor.checkpoint.dir", None)
        if not found:
            found = "file://" + tempfile.mkdtemp(prefix="tremor-")
            spark.conf.set("tremor.checkpoint.dir", found)
    return found.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 2048) -> None:
    """Arrow batches of so many rows at most from now on in the session: operators that map whole texts hold one batch at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result depends on the written files only, so lost executors cost no
    recomputation of what lies before.
    """
    return materialize_with(df, label)[0]


def materialize_with(df: DataFrame, label: str, *measures: Column) -> tuple[DataFrame, dict]:
    """As :func:`materialize`, with aggregates that are taken while the rows are written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tremor/{label}-{uuid.uuid4().hex}"
    seen = Observation() if measures else None
    (df.observe(seen, *measures) if measures else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get if measures else {}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over so many tasks in any case, for groups whose work is long and whose rows are few: by their bytes, which is what Spark sees, they would get one task or two."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nothing refers to any more.

    Spark drops them once the driver has collected its garbage, which may be
    long after a large table has been written and its shuffle is of no use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the files behind tables made by :func:`materialize` that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)

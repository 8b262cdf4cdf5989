"""Session and storage helpers shared by all operators.

Everything that has to outlive one job goes to the folder that the cluster
names in ``spark.checkpoint.dir``; machine-local folders are used only where
that setting is absent (tests, a laptop).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quernel", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, quiet)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quernel-"))
        current = sc._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


@contextmanager
def setting(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as double underscores) for one block, then what was before."""
    names = {k: k.replace("__", ".") for k in values}
    before = {n: spark.conf.get(n, None) for n in names.values()}
    for k, n in names.items():
        spark.conf.set(n, values[k])
    try:
        yield
    finally:
        for n, value in before.items():
            if value is None:
                spark.conf.unset(n)
            else:
                spark.conf.set(n, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The table goes when the driver's JVM ends, or with ``forget``. Use it for
    wide or large intermediates that several jobs read: a lost executor then
    costs a reread, not a recomputation. The shuffle files of the write go at
    its end, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    place, system = _hadoop(spark, path)
    system.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that no later plan reads."""
    for table in tables:
        place, system = _hadoop(table.sparkSession, table._stored_at)
        system.delete(place, True)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


#: Bytes of a table that ``dealt`` moves; a larger one has row groups for all cores.
SMALL_TABLE = 1 << 30


def dealt(df: DataFrame) -> DataFrame:
    """A small table dealt evenly over the cores, as it may be a single row group; a larger one as it is stored."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL_TABLE else df


def parallel(spark: SparkSession) -> int:
    """Tasks that a step may have whose units, such as shards, are many more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def small_batches(spark: SparkSession, rows: int = 10_000) -> None:
    """Keep Arrow batches of whole texts or token runs small on both sides of the pipe, from now on, as lazy plans run later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test layout, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Session settings and the shared folder that loops and fixtures write to."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings of this library, readable and settable as ordinary session conf.
BROADCAST_ROWS = "spark.lanewise.broadcast.maxRows"
BROADCAST_BYTES = "spark.lanewise.broadcast.maxBytes"
ROWS_PER_SPLIT = "spark.lanewise.skew.rowsPerSplit"

_DEFAULTS = {
    BROADCAST_ROWS: 1_000_000,
    BROADCAST_BYTES: 64 << 20,
    ROWS_PER_SPLIT: 1_000_000,
}


def local_session(app: str, cores: str = "*", **conf) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    slots = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(slots))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, key: str) -> int:
    return int(spark.conf.get(key, str(_DEFAULTS[key])))


@contextmanager
def set_inside(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_let_go(spark: SparkSession):
    """Files that jobs inside shuffle are removed when their job ends.

    Otherwise they stay until the driver happens to collect what refers to them, and those of
    one step fill the disk beside those of the next.
    """
    return set_inside(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may leave it unset; it then gets a new temporary
    folder.  On a cluster a machine-local folder would be lost with its executor,
    so an unset folder is an error there.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lanewise-")
    sc.setCheckpointDir(root)
    return root


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps the tables it derives."""
    return f"{scratch_root(spark)}/lanewise-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table that will be read many times, and read it back.

    Parquet, so that its readers take only the columns they need and the planner knows
    its size.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Write the state of a loop to the reliable checkpoint folder and cut its lineage."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)

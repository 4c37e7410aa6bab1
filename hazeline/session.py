"""Session helpers: a local session for tests and shared scratch tables."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores="*", memory="20g", shuffle_partitions=8) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hazeline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    A local session that names none gets a folder of its own. Elsewhere a folder of one
    machine would lose parts of what the others write, so there must be a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="hazeline-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Lists of the scratch paths handed out inside each open scope.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/hazeline/{label}-{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables made inside go at the end of the scope; write what is to stay before it ends.

    Only paths that the scope itself handed out are removed, also when it ends by an error.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not made]
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_in_scope(spark: SparkSession, make, label: str) -> DataFrame:
    """The DataFrame that ``make()`` returns, written and read again; the tables it needed are gone."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_and_reread(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a columnar table in the shared folder.

    Unlike ``checkpoint()`` the result keeps column pruning and size statistics,
    so later joins are still planned from real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from terrazzo.errors import ConfigurationError

# Runtime SQL settings the jobs rely on. `tune` leaves alone what the caller has set.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # compressed columnar files hold several times their size in rows; without this Spark
    # would broadcast tables well beyond its threshold
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # hash instead of sort where every partition of one join side is known to be small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # re-writing one ingestion date must leave the other dates in place
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # streaming state outside the heap, saved as changes; expiring state needs this provider
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# settings that can only be given when a session is built
STATIC_SETTINGS = {
    # recording the call site of every column expression makes long plans slow to write down
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_roots: dict[str, str] = {}
_registered: set[str] = set()


def build_session(app_name: str = "terrazzo", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` to a running session, except those set when it was built."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in SETTINGS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Where the setting is absent a temporary folder stands in, on local masters only: on a
    cluster the executors would not see it.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ConfigurationError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="terrazzo-")
    return _local_roots[app]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. All such paths of an application go when it ends."""
    app = spark.sparkContext.applicationId
    folder = f"{staging_root(spark)}/terrazzo/{app}"
    if folder not in _registered:
        _registered.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        # only what exists can be marked
        store.mkdirs(path)
        store.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` below the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the planner the true size,
    so that Spark's own threshold decides whether the table is broadcast.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

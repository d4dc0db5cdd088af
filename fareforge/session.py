"""Session settings and the shared scratch folder."""
import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All of these can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
_WRITTEN: dict = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only a local session may go without one and gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="fareforge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder; it goes when the session ends or `release` is called."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_release_at_exit)
    _WRITTEN[path] = spark
    return path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders: those named, else all that this process made. Results that read them are void then.

    Spark deletes the shuffle files, broadcasts and generated classes of what wrote them only once the driver's garbage is
    collected, which a driver of little work may put off for long; so that is asked for.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths or list(_WRITTEN):
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
        _WRITTEN.pop(path, None)
    gc.collect()
    jvm.System.gc()


def _release_at_exit() -> None:
    for spark in set(_WRITTEN.values()):
        if spark.sparkContext._jsc is not None:
            release(spark, *[p for p, s in list(_WRITTEN.items()) if s is spark])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate layer to the shared folder and read it back.

    Later steps read it as often as they like, nothing is recomputed, and lost executors cost nothing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

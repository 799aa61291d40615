"""Session helpers.

Cluster deployments pass their own ``SparkSession`` (and their own shared
``spark.checkpoint.dir``); :func:`local_session` is for tests and the bench.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session we create gets. On a cluster the same keys belong in
# spark-defaults; ``shuffle.partitions`` there is sized to the data (about
# 128-256 MB per partition after AQE coalescing), not to the core count.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starmart", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins. Only when it is unset (local
    tests) do we create a private folder, since a machine-local temp folder is
    not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="starmart-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path for tables the library writes itself (merge targets, SCD2 state)."""
    return "/".join([ensure_checkpoint_dir(spark), "starmart", *parts])


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A work path for what a lazy result still reads: its folder belongs to the
    application and goes when the driver ends."""
    root = work_path(spark, "scratch", spark.sparkContext.applicationId)
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(lambda: spark.sparkContext._jsc is not None and remove(spark, root))
    return "/".join([root, *parts, uuid.uuid4().hex])


def filesystem(spark: SparkSession, path: str):
    """(Hadoop Path class, file system of ``path``)."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return cls, cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    cls, fs = filesystem(spark, path)
    fs.delete(cls(path), True)


class Staged:
    """A frame written once to the shared work folder and removed afterwards:

        with Staged(df) as written: ...
    """

    def __init__(self, df: DataFrame):
        self.spark, self.df = df.sparkSession, df
        self.path = work_path(self.spark, "staged", uuid.uuid4().hex)

    def __enter__(self) -> DataFrame:
        self.df.write.parquet(self.path)
        return self.spark.read.schema(self.df.schema).parquet(self.path)

    def __exit__(self, *exc) -> None:
        remove(self.spark, self.path)

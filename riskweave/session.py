"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


_local_folders: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("riskweave")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master, where every task sees the same disk, may go without
    the setting; it then gets a fresh folder under /tmp.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/riskweave-{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Removes the folders this application wrote to the shared folder; says how many.

    For a caller who has written or collected all results: frames that still
    read such a folder fail afterwards.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written.pop(spark.sparkContext.applicationId, [])
    gone = 0
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage for frames that several later jobs read. A lost executor
    costs a re-read of its files, not a re-run of what produced them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

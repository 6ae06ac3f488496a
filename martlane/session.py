"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings for large joins. Each is set only where the session
# has not been given a value of its own.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Chained joins on one key would otherwise keep a skewed partition whole,
    # because splitting it costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    explicit = dict(spark.sparkContext.getConf().getAll())
    for name, value in TUNING.items():
        if name not in explicit:
            spark.conf.set(name, value)
    return spark


def local_session(
    app: str, cores: str = "*", shuffle_partitions: int = 8, config: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in (config or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder on storage every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local master may fall back
    to a temporary folder of the machine, since there all tasks share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="martlane-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors."""
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

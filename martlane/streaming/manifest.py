"""Small tables beside a table of batches: which batches are finished, which files are current.

A finished batch is one row in a folder of its own below ``_manifest``, written last. Such a
row is a single file, which Spark's commit makes visible as a whole.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"
# ``digests`` is how many payload digests the batch added, ``upto`` the last batch of another
# table that it read; either may be NULL.
MARK_SCHEMA = "done boolean, digests bigint, upto bigint, batch_id bigint"


def side_table(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """The table in a folder, with the partitions of its path; None where there is none yet."""
    try:
        return spark.read.schema(schema).option("basePath", folder).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def marks(spark: SparkSession, out: str) -> DataFrame | None:
    return side_table(spark, f"{out}/{MANIFEST}", MARK_SCHEMA)


def is_marked(spark: SparkSession, out: str, batch_id: int) -> bool:
    """Whether the manifest says that a batch is finished."""
    found = marks(spark, out)
    return found is not None and not found.filter(F.col("batch_id") == batch_id).isEmpty()


def mark(
    spark: SparkSession, out: str, batch_id: int, digests: int | None = None, upto: int | None = None
) -> None:
    row = spark.range(1).select(
        F.lit(True).alias("done"),
        F.lit(digests).cast("bigint").alias("digests"),
        F.lit(upto).cast("bigint").alias("upto"),
    )
    row.coalesce(1).write.mode("overwrite").parquet(f"{out}/{MANIFEST}/batch_id={batch_id}")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever store its path names, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

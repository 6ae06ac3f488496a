"""Finding, writing and listing tables by layer and data product."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.operators.heavy import heavy_keys, summarize

INVENTORY_SCHEMA = "schema_name string, table_name string, row_count bigint, file_bytes bigint"


@dataclass(frozen=True)
class Catalog:
    """Names tables ``<layer>_<product><suffix>.<table>`` in the session catalog.

    ``suffix`` separates environments, for example ``_dev`` or ``_pr12``. ``location`` is a
    folder for new schemas; without it they lie in the session's warehouse.
    """

    spark: SparkSession
    suffix: str = ""
    location: str | None = None

    def schema(self, layer: str, product: str) -> str:
        return f"{layer}_{product}{self.suffix}".lower()

    def name(self, layer: str, product: str, table: str) -> str:
        return f"{self.schema(layer, product)}.{table}".lower()

    def read(self, layer: str, product: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, product, table))

    def write(
        self,
        df: DataFrame,
        layer: str,
        product: str,
        table: str,
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
    ) -> DataFrame:
        """Rebuild a table from ``df`` and return it read back.

        The table on storage also cuts the lineage: later marts read it
        instead of computing it again, and a lost executor costs only a scan.
        ``sort_by`` orders the rows of each task, so that ids are written as what
        they have not in common with the one before.
        """
        schema = self.schema(layer, product)
        place = f" LOCATION '{self.location}/{schema}.db'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{place}")
        full_name = self.name(layer, product, table)
        documented = with_comments(df, column_comments or {})
        if partition_by:
            # Gathers each partition's rows in few files; a partition too large
            # for one task is split again at run time.
            documented = documented.hint("rebalance", *partition_by)
        if sort_by:
            documented = documented.sortWithinPartitions(*sort_by)
        writer = documented.write.mode("overwrite").format("parquet").option("compression", "zstd")
        # The second version codes a string that begins like the one before by the rest of it.
        writer = writer.option("parquet.writer.version", "v2")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(full_name)
        if comment:
            text = comment.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"COMMENT ON TABLE {full_name} IS '{text}'")
        return self.spark.table(full_name)

    def view(self, df: DataFrame, name: str) -> DataFrame:
        """Staging is a view: nothing is stored."""
        df.createOrReplaceTempView(name)
        return df

    def heavy(self, layer: str, product: str, table: str, key: str) -> DataFrame | None:
        """The stored list of a table's heavy keys, if it was written with one."""
        name = self.name(layer, product, f"{table}_heavy_{key}")
        return self.spark.table(name) if self.spark.catalog.tableExists(name) else None

    def write_heavy(self, layer: str, product: str, table: str, key: str) -> DataFrame:
        """Summarize a written table's key column, and store the keys that are heavy."""
        rows = self.read(layer, product, table)
        summary = self.write(summarize(rows, key), layer, product, f"{table}_summary_{key}")
        return self.write(heavy_keys(rows, key, summary), layer, product, f"{table}_heavy_{key}")

    def tables(self, prefix: str = "mart") -> list[tuple[str, str, str]]:
        """(schema, table, location) of the stored tables whose schema starts with ``prefix``."""
        found = []
        for db in self.spark.catalog.listDatabases():
            if not db.name.startswith(prefix):
                continue
            for table in self.spark.catalog.listTables(db.name):
                if table.isTemporary or table.tableType == "VIEW":
                    continue
                about = self.spark.sql(f"DESCRIBE EXTENDED {db.name}.{table.name}")
                place = about.filter("col_name = 'Location'").select("data_type").first()
                found.append((db.name, table.name, place[0]))
        return found

    def inventory(self, prefix: str = "mart") -> DataFrame:
        """Tables of all schemas whose name starts with ``prefix``, with their rows and bytes.

        One scan over the files of all tables, without a column: so tasks read nothing but
        the row counts in the files' footers, and the plan is the same for any number of
        tables.
        """
        named = self.tables(prefix)
        if not named:
            return self.spark.createDataFrame([], INVENTORY_SCHEMA)
        listed = self.spark.createDataFrame(named, "schema_name string, table_name string, place string")
        counted = file_counts(self.spark, [place for _, _, place in named])
        # Every folder that a file lies in.
        folders = "transform(sequence(1, size(split(file_path, '/'))), i -> substring_index(file_path, '/', i))"
        inside = counted.withColumn("folder", F.explode(F.expr(folders)))
        tables = listed.withColumn("folder", _plain_path(F.col("place")))
        return (
            tables.join(inside, "folder", "left")
            .groupBy("schema_name", "table_name")
            .agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum("bytes"), F.lit(0)).alias("file_bytes"),
            )
            .orderBy("schema_name", "table_name")
        )


def _plain_path(path: Column) -> Column:
    """A path whose scheme is followed by one slash, and that ends in none."""
    return F.rtrim(F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/"), F.lit("/"))


def file_counts(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """file_path, rows and bytes of every Parquet file below the folders."""
    # No file has the column: only footers are read.
    files = spark.read.schema("no_column boolean").option("recursiveFileLookup", True)
    return (
        files.parquet(*folders)
        .select(_plain_path(F.col("_metadata.file_path")).alias("file_path"), "_metadata.file_size")
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
    )


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column comments as metadata; the writer stores them with the table."""
    for column, text in comments.items():
        known = dict(df.schema[column].metadata or {})
        df = df.withMetadata(column, {**known, "comment": text})
    return df


def preview(df: DataFrame, rows: int = 100) -> DataFrame:
    """The first rows a scan finds."""
    return df.limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))

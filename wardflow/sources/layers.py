"""Where Bronze, Silver and Gold tables live: a folder of Parquet tables or a catalog schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Layers:
    """Table names resolve to ``root/<name>`` (path mode) or ``schema.<name>`` (catalog mode)."""

    def __init__(self, spark: SparkSession, root: str | None = None, schema: str | None = None):
        if (root is None) == (schema is None):
            raise ValueError("give either a root folder or a catalog schema")
        self.spark, self.root, self.schema = spark, root, schema

    def _name(self, table: str) -> str:
        return f"{self.root}/{table}" if self.root else f"{self.schema}.{table}"

    def read(self, table: str) -> DataFrame:
        """The table; folder values of ``_batch_id``, ``_source_file`` and ``_part`` stay text, whatever they look like."""
        if not self.root:
            return self.spark.read.table(self._name(table))
        df = self.spark.read.parquet(self._name(table))
        fields = [T.StructField(f.name, T.StringType()) if f.name in ("_batch_id", "_source_file", "_part") else f for f in df.schema]
        declared = T.StructType(fields)
        return df if declared == df.schema else self.spark.read.schema(declared).parquet(self._name(table))

    def exists(self, table: str) -> bool:
        if not self.root:
            return self.spark.catalog.tableExists(self._name(table))
        try:
            self.read(table)
            return True
        except AnalysisException:
            return False

    def _save(self, df: DataFrame, table: str, mode: str, partitions: Sequence[str], **options) -> None:
        writer = df.write.mode(mode).format("parquet").options(**options)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.save(self._name(table)) if self.root else writer.saveAsTable(self._name(table))

    def overwrite(self, table: str, df: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
        """Replace the table, schema included, and return it as written."""
        self._save(df, table, "overwrite", partitions, partitionOverwriteMode="static")
        if partitions and self.root and not self.exists(table):  # no rows, so no file that tells the columns
            folder = "/".join(f"{p}=none" for p in partitions)
            self.spark.createDataFrame([], df.drop(*partitions).schema).write.parquet(f"{self._name(table)}/{folder}")
        return self.read(table)

    def append(self, table: str, df: DataFrame) -> None:
        self._save(df, table, "append", ())

    def replace_partitions(self, table: str, df: DataFrame, partitions: Sequence[str]) -> None:
        """Replace only the partitions present in ``df``.

        Rows are clustered by partition first so that a task writes few files; AQE splits a
        partition that is large.
        """
        spread = df.hint("rebalance", *partitions)
        if self.root or not self.exists(table):
            self._save(spread, table, "overwrite", partitions, partitionOverwriteMode="dynamic")
        else:
            spread.select(*self.read(table).columns).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").insertInto(self._name(table))

    def clear_partitions(self, table: str, column: str, values: Iterable[str]) -> None:
        """Leave no row in the partitions of ``column`` with these values; a folder that is there is overwritten with no rows."""
        rows = self.read(table)
        for value in sorted(values):
            if not self.root:
                self.spark.sql(f"ALTER TABLE {self._name(table)} DROP IF EXISTS PARTITION ({column} = '{value}')")
            elif not rows.filter(F.col(column) == value).isEmpty():
                empty = self.spark.createDataFrame([], rows.drop(column).schema)
                empty.write.mode("overwrite").parquet(f"{self._name(table)}/{column}={value}")

    def reset(self, tables: Iterable[str]) -> None:
        """Drop catalog tables (path tables are replaced by the next overwrite)."""
        if self.schema:
            for table in tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")

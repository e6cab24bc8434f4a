"""Session settings the library is tuned for, and where intermediate tables are kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter provides it."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("wardflow")
    settings = {**SETTINGS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                "spark.sql.shuffle.partitions": "8",
                "spark.python.sql.dataFrameDebugging.enabled": "false", **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` master may leave it unset (tests, a laptop): then a temporary folder is made, since
    driver and executors are one process. On a cluster a machine-local folder would lose rows, so this raises.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="wardflow-"))
    return context.getCheckpointDir()


#: Makes Spark remove the shuffle files of an execution at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_WATCHED: list[list[DataFrame]] = []


def settle(df: DataFrame) -> DataFrame:
    """Compute once, write to the shared folder, go on from the written table.

    Cuts lineage like ``checkpoint()``, survives lost executors, and being Parquet still lets
    later steps read only the columns they need. What was shuffled to make the table is removed once it is written.
    """
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[written] = path
    for tables in _WATCHED:
        tables.append(written)
    return written


def once(tables: Callable[[str], DataFrame], prefix: str = "") -> Callable[[str], DataFrame]:
    """The same supplier of tables, each whose name starts with ``prefix`` being settled when it is first asked for."""
    written: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if not name.startswith(prefix):
            return tables(name)
        if name not in written:
            written[name] = settle(tables(name))
        return written[name]
    return table


@contextmanager
def watched() -> Iterator[list[DataFrame]]:
    """The list of tables settled inside, to be discarded when what was made of them has been written."""
    tables: list[DataFrame] = []
    _WATCHED.append(tables)
    try:
        yield tables
    finally:
        _WATCHED[:] = [t for t in _WATCHED if t is not tables]


def discard(*tables: DataFrame) -> None:
    """Give back the disk of settled tables that nothing will read again: their folders are overwritten with no rows."""
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path is not None:
            table.sparkSession.createDataFrame([], "gone boolean").write.mode("overwrite").parquet(path)

"""Small helpers the training-data operators share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import settle

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROW = "_row_of_stage"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file on this machine (the files are installed on every executor)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text of ASCII characters: its bits one by one."""
    zeros = ", ".join(["0::UBIGINT"] * 7)
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::UBIGINT, {zeros}]))"
    step = "xor(xor(a, e) >> 1, 3988292384::UBIGINT * (xor(a, e) & 1::UBIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {bits}), lambda a, e: {step}), 4294967295::UBIGINT)"


def numbered(docs: DataFrame) -> DataFrame:
    """The rows, each with a number of its own in ``ROW``; written out, so that a row has the same number whenever it is read."""
    return settle(docs.withColumn(ROW, F.monotonically_increasing_id()))


def only(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The numbered rows whose ``ROW`` is among ``kept``, without it; always by a sort-merge join, as the list grows with the corpus."""
    return rows.join(kept.select(ROW).hint("merge"), ROW, "left_semi").drop(ROW)


def quiet_tokenizers() -> None:
    """One thread per task: Spark already runs a task on every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"

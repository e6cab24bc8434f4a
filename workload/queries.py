"""The registered queries: library plans over feeds derived from the supplied tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardflow.plans.gold import DIMENSIONS, FACTS, Gold
from wardflow.plans.silver import Silver
from workload import oracle_tables as ot
from workload.derive import Bronze

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

class Hospital:
    """Bronze, Silver and Gold over one folder, as lazy frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.bronze = spark, Bronze(spark, folder)
        self._silver = Silver(self.bronze)
        self._gold = Gold(spark, self._silver.table, as_of=ot.AS_OF, settled=True, narrow=self._silver.verdicts)

    def silver(self, name: str) -> DataFrame:
        return self._silver.table(name)

    def verdicts(self, name: str) -> DataFrame:
        return self._silver.verdicts(name)

    def counts(self, name: str) -> DataFrame:
        return self._silver.counts(name)

    def gold(self, name: str) -> DataFrame:
        return self._gold.table(name)

    def fact(self, name: str, columns: Sequence[str]) -> DataFrame:
        return self._gold.columns(name, columns)

def present(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Print-ready values: text for times and dates, doubles for decimals, rates to 9 places."""
    def shown(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') AS {name}"
        if isinstance(field.dataType, T.DateType):
            return f"date_format({name}, 'yyyy-MM-dd') AS {name}"
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST({name} AS DOUBLE) AS {name}"
        return f"round({name}, 9) AS {name}" if isinstance(field.dataType, T.DoubleType) else name

    return df.selectExpr(*[shown(f) for f in df.schema if columns is None or f.name in columns])

def register(name: str, sql: str | None = None, **ctes: str):
    def add(make: Callable[[Hospital], DataFrame]):
        QUERIES[name] = lambda spark, folder: make(Hospital(spark, folder))
        if sql is not None:
            ORACLE[name] = ot.query(sql, **ctes)
        return make
    return add

def _silver_query(name: str) -> None:
    columns = [c for c, _ in ot.silver_columns(name)]
    QUERIES[f"silver_{name}"] = lambda spark, folder: present(Hospital(spark, folder).silver(name), columns)
    ORACLE[f"silver_{name}"] = ot.silver_query(name)

def _gold_query(name: str) -> None:
    columns = [c for c, _ in ot.gold_columns(name)]
    QUERIES[f"gold_{name}"] = lambda spark, folder: present(Hospital(spark, folder).gold(name), columns)
    ORACLE[f"gold_{name}"] = ot.gold_query(name)

for _name in ot.SILVER:
    _silver_query(_name)
for _name in [*DIMENSIONS, *FACTS]:
    if _name != "dim_date":
        _gold_query(_name)

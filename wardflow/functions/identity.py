"""Person keys and de-identification."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.parsing import as_col

# Columns that identify a person directly.
DIRECT_IDENTIFIERS = [
    "SSN", "Drivers", "Passport", "Prefix", "First", "Middle", "Last", "Suffix", "Maiden",
    "BirthDate", "BirthDate_date", "DeathDate", "BirthPlace", "Address", "City", "Lat", "Lon",
    "phone", "email", "mrn", "mpi_key",
]


def mpi_key(ssn: str | Column, birth: str | Column, last: str | Column,
            first: str | Column, postal: str | Column) -> Column:
    """Match key of a person: the national number if given, else demographics."""
    number = as_col(ssn)
    demographics = F.concat_ws("|", F.lit("demo"), as_col(birth), F.lower(as_col(last)),
                               F.lower(as_col(first)), as_col(postal))
    return F.when(F.trim(number) != "", F.concat(F.lit("ssn:"), number)).otherwise(demographics)


def deidentify(df: DataFrame, extra: Iterable[str] = (), hashed: Iterable[str] = ()) -> DataFrame:
    """Drop direct identifiers; ``hashed`` columns stay joinable as SHA-256 digests."""
    hashed = list(hashed)
    kept = df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in hashed})
    return kept.drop(*[c for c in [*DIRECT_IDENTIFIERS, *extra] if c not in hashed])


def role_view(df: DataFrame, visible: Iterable[str]) -> DataFrame:
    """Same columns for every role; those a role may not see arrive as NULL."""
    allowed = set(visible)
    return df.select(*[F.col(f.name) if f.name in allowed
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])

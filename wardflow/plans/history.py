"""A versioned dimension kept up to date: each snapshot is applied to the history that is there.

The table has the open versions, one row per key, in ``buckets`` parts by hash of the key, and the closed ones in a part per snapshot
that closed them. Applying a snapshot reads the open versions only, writes the versions it closes as one new part, and
rewrites just the buckets in which a key is new, changed, gone or back. Closed parts are never read or written again.

A run that ends early is made good by applying the same snapshot again: closed versions are written before open ones change, and a
part of closed versions that is there is complete, since a part appears at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.dedupe import latest_per_key
from wardflow.session import discard, settle
from wardflow.sources.layers import Layers

OPEN, CLOSED = "open-", "closed-"


@dataclass(frozen=True)
class History:
    """History of ``key`` in ``table``; a version ends when one of ``attributes`` changes (without any: with every snapshot).

    A key absent from the newest snapshot ends where it was last seen; if it comes back unchanged, its version goes on. Rows with a
    null key are left out, of several rows of a key in one snapshot one stays, chosen by all its columns.
    """

    layers: Layers
    table: str
    key: str
    attributes: Sequence[str] = ()
    buckets: int = 256

    def newest(self) -> str | None:
        """The last snapshot that was applied in full."""
        log = f"{self.table}_snapshots"
        return self.layers.read(log).agg(F.max("snapshot")).first()[0] if self.layers.exists(log) else None

    def _open(self, snapshot: DataFrame, batch: str) -> DataFrame:
        """A snapshot's rows as open versions."""
        once = latest_per_key(snapshot.filter(F.col(self.key).isNotNull()), [self.key], [])
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return once.select(*snapshot.columns, F.lit(batch).alias("valid_from"), F.lit(None).cast("string").alias("valid_to"),
                           F.lit(None).cast("string").alias("_last_seen"), F.format_string(OPEN + "%04d", bucket).alias("_part"))

    def apply(self, snapshot: DataFrame, batch: str) -> None:
        """Take in the snapshot of ``batch``, an id that sorts after all before it; the newest one again changes nothing."""
        newest = self.newest()
        if newest is not None and batch <= newest:
            if batch < newest:
                raise ValueError(f"snapshot {batch} is older than {newest}")
            return
        fresh = self._open(snapshot, batch)
        if newest is None:
            self.layers.overwrite(self.table, fresh.hint("rebalance", "_part"), ["_part"])
        else:
            self._update(fresh, batch, newest)
        self.layers.append(f"{self.table}_snapshots", snapshot.sparkSession.range(1).select(F.lit(batch).alias("snapshot")))

    def _update(self, fresh: DataFrame, batch: str, newest: str) -> None:
        columns = fresh.columns
        table = self.layers.read(self.table).select(*columns)
        before = table.filter(F.col("_part").startswith(OPEN))
        met = before.select(self.key, F.struct(*columns).alias("was")).join(
            fresh.select(self.key, F.struct(*columns).alias("now")), self.key, "full")
        both = F.col("was").isNotNull() & F.col("now").isNotNull()
        held = lambda side: F.struct(*[F.col(f"{side}.{a}") for a in self.attributes])
        # a version that began with this very snapshot was written by a run that ended early
        differs = both & (F.col("was.valid_from") != batch) & (~held("was").eqNullSafe(held("now")) if self.attributes else F.lit(True))
        gone = F.col("now").isNull() & F.col("was._last_seen").isNull()
        back = both & ~differs & F.col("was._last_seen").isNotNull()
        changes = settle(met.withColumns({"differs": differs, "gone": gone, "back": back}).filter("was IS NULL OR differs OR gone OR back"))
        if table.filter(F.col("_part") == CLOSED + batch).isEmpty():
            ended = changes.filter("differs").select("was.*").withColumns(
                {"valid_to": F.lit(batch), "_last_seen": F.lit(None).cast("string"), "_part": F.lit(CLOSED + batch)})
            self.layers.replace_partitions(self.table, ended, ["_part"])
        newly = changes.select(F.when(F.col("was").isNull() | F.col("differs"), F.col("now")).when(
            F.col("gone"), F.col("was").withField("_last_seen", F.lit(newest))).otherwise(
            F.col("was").withField("_last_seen", F.lit(None).cast("string"))).alias("row")).select("row.*")
        touched = newly.select("_part").distinct()
        stay = before.join(touched, "_part", "left_semi").join(changes.select(self.key), self.key, "left_anti")
        rewritten = settle(stay.select(*columns).unionByName(newly))
        self.layers.replace_partitions(self.table, rewritten, ["_part"])
        discard(changes, rewritten)

    def read(self) -> DataFrame:
        """All versions with ``valid_from``, ``valid_to`` and ``is_current``, as ``scd.versions`` makes them from all snapshots at once."""
        ended = self.layers.read(self.table).withColumn("valid_to", F.coalesce("valid_to", "_last_seen"))
        return ended.drop("_last_seen", "_part").withColumn("is_current", F.col("valid_to").isNull())

"""Stable dense ids: a stored map from natural key to id.

A key keeps the id it was given; keys that are new get the numbers behind the highest, in their order,
without gaps. Numbers come from ranges and offsets (``keys.with_dense_key``), not from a window over all
keys. Every registration is one version of the map (``sinks.versions``): one that breaks leaves the map as
it was, and of two that run at once the later starts again on top of the other's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from portmart.operators.joins import estimated_bytes
from portmart.operators.keys import with_dense_key
from portmart.session import staging_path
from portmart.sinks.versions import Conflict, Version, VersionedTables

_TABLE, _FIRST, _ID = "ids", "first_id", "id"
FILE_BYTES = 16 << 20  # of staged keys that go to one task and file


class KeyRegistry:
    """The map at ``path`` for keys with the columns ``keys`` (null is a value like others)."""

    def __init__(self, spark: SparkSession, path: str, keys: StructType):
        taken = {_FIRST, _ID} & {k.lower() for k in keys.names}
        if taken:
            raise ValueError(f"key columns cannot be named {sorted(taken)}")
        self.spark, self.keys = spark, keys
        self.store = VersionedTables(spark, path, {_TABLE: StructType([*keys.fields, StructField(_ID, LongType()), StructField(_FIRST, LongType())])}, layout=(_FIRST,))

    def read(self) -> DataFrame:
        """(key columns, id)."""
        return self.store.read(_TABLE).drop(_FIRST)

    def _unknown(self, df: DataFrame, now: Version) -> DataFrame:
        """The distinct keys of ``df`` that have no id in ``now``: both sides are grouped by key, in one exchange."""
        names = [F.col(_q(k)) for k in self.keys.names]
        asked = df.select(*[F.col(_q(f.name)).cast(f.dataType).alias(f.name) for f in self.keys.fields])
        if not now.rows(_TABLE):
            return asked.distinct()
        known = self.store.read(_TABLE, now).select(*names, _ID)
        both = asked.withColumn(_ID, F.lit(None).cast("long")).unionByName(known)
        return both.groupBy(*names).agg(F.max(_ID).alias(_ID)).filter(F.col(_ID).isNull()).select(*names)

    def register(self, df: DataFrame, attempts: int = 5) -> int:
        """Give an id to every key of ``df`` that has none; the number of new keys."""
        for _ in range(attempts):
            now = self.store.version()
            last = now.rows(_TABLE)  # ids have no gaps
            ranged = staging_path(self.spark, "dense-key")
            rows = with_dense_key(self._unknown(df, now), _ID, self.keys.names, stage_to=ranged)
            rows = rows.withColumn(_ID, (F.col(_ID) + last).cast("long")).withColumn(_FIRST, F.lit(last + 1).cast("long"))
            # the one folder is written from the staged ranges as they are; small ones go together
            staged_bytes = estimated_bytes(self.spark.read.parquet(ranged))
            if staged_bytes is not None:
                rows = rows.coalesce(staged_bytes // FILE_BYTES + 1)
            try:
                return self.store.publish({_TABLE: rows}, expect=now, rebalance=False).rows(_TABLE) - last
            except Conflict:
                continue
        raise RuntimeError(f"{self.store.root}: {attempts} registrations were overtaken")

    def assign(self, df: DataFrame, name: str, on: Sequence[str] | None = None) -> DataFrame:
        """``df`` with the id of its key as ``name`` (never null); keys without one are registered first.
        ``on``: ``df``'s columns that hold the key, where they are named otherwise. ``df`` is read twice, so
        stage it if it is dear or not repeatable."""
        own = list(on or self.keys.names)
        self.register(df.select(*[F.col(_q(c)).alias(k) for c, k in zip(own, self.keys.names)]))
        ids = self.read().select(*[F.col(_q(k)).alias(f"_key{i}") for i, k in enumerate(self.keys.names)], F.col(_ID).alias("_assigned"))
        cond = F.lit(True)
        for i, (c, f) in enumerate(zip(own, self.keys.fields)):
            cond = cond & F.col(_q(c)).cast(f.dataType).eqNullSafe(F.col(f"_key{i}"))
        out = df.join(ids, cond, "left").withColumn(name, F.coalesce("_assigned", F.lit(0).cast("long")))  # ids begin at 1
        return out.drop("_assigned", *[f"_key{i}" for i in range(len(own))])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

"""Upserts into a bucketed table whose reading cost does not grow with history.

All versions of a key lie in one bucket: the folded rows in one file, and each later micro-batch's rows in one file more.
Reading takes the newest version per key bucket by bucket, without a shuffle. After ``fold_every`` micro-batches the
table is folded: what reading gives is written, again bucket by bucket, as the next generation, which later batches go
to. So a read sees the rows once, and the newest batches.

A version is (run, batch): runs are checkpoints in the order they first wrote. A replayed batch writes the same versions
again, a half-written one is never visible, and a generation counts once its line is stored, so no commit log is needed.
Tables live in the session's catalog over files at ``path``; another session registers them again. One query at a time
writes to a table.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.streaming.carry import run_number

BUCKETS, FOLD_EVERY = 8, 32
_VERSION = (StructField("_run", IntegerType()), StructField("_batch", LongType()))


class UpsertTable:
    """Newest row per key; ``schema`` has keys and values. NULL is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: StructType, buckets: int = BUCKETS, fold_every: int = FOLD_EVERY):
        self.spark, self.path, self.keys, self.buckets, self.fold_every = spark, path, keys, buckets, fold_every
        self.values = [c for c in schema.names if c not in keys]
        self.schema = StructType([*schema.fields, *_VERSION])
        self._generation: int | None = None

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        """Write one micro-batch; for ``foreachBatch``."""
        run = run_number(df.sparkSession, self.path)
        rows = df.withColumns({"_run": F.lit(run), "_batch": F.lit(batch_id).cast("bigint")})
        self._write(rows.repartition(self.buckets, *self.keys), self.generation, "append")
        if (batch_id + 1) % self.fold_every == 0:
            self.fold()

    @property
    def generation(self) -> int:
        """Number of the newest folded generation; looked up once, then followed."""
        if self._generation is None:
            try:
                found = self.spark.read.schema("generation int").parquet(f"{self.path}/generations")
                self._generation = found.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
            except AnalysisException:
                self._generation = 0
        return self._generation

    def _table(self, generation: int) -> str:
        """The table over a generation's files, registered if this session does not know it."""
        name = f"upsert_{hashlib.md5(self.path.encode()).hexdigest()[:16]}_{generation}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/generation={generation}'"
            )
        return name

    def _write(self, rows: DataFrame, generation: int, mode: str) -> None:
        rows.select(*self.schema.names).write.mode(mode).insertInto(self._table(generation))

    def _newest(self) -> DataFrame:
        """Newest version per key; grouped where the buckets lie."""
        rows = self.spark.table(self._table(self.generation))
        last = F.max_by(F.struct(*self.values, "_run", "_batch"), F.struct("_run", "_batch")).alias("_last")
        return rows.groupBy(*self.keys).agg(last).select(*self.keys, "_last.*")

    def read(self) -> DataFrame:
        return self._newest().select(*self.keys, *self.values)

    def fold(self) -> None:
        """Write the newest versions as the next generation."""
        after = self.generation + 1
        self._write(self._newest(), after, "overwrite")
        self.spark.createDataFrame([(after,)], "generation int").coalesce(1).write.mode("append").parquet(f"{self.path}/generations")
        self._generation = after

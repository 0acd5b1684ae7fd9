"""Small state that a batch function hands from one micro-batch to the next.

A state is a table of bounded size, stored beside the output as ``run=<n>/batch_id=<m>``. A batch reads the state of the
batch before it and writes its own over whatever an earlier attempt of the same batch left, so a replay changes nothing
and no batch reads the history. Runs (checkpoints) are numbered in the order they first wrote; the first batch of a run
goes on from the last state of the run before. One query at a time writes to a path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

#: From the state before (None at the very start) to the state after.
Step = Callable[[DataFrame | None], DataFrame]


def run_id(spark: SparkSession) -> str:
    """Id of the query whose batch function runs, which its checkpoint keeps."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


_numbers: dict[tuple[str, str], int] = {}


def run_number(spark: SparkSession, path: str) -> int:
    """Number of the calling query's run among those that wrote to ``path``; one stored row per run, read once."""
    run = run_id(spark)
    if (path, run) not in _numbers:
        _numbers[path, run] = _registered(spark, path, run)
    return _numbers[path, run]


def _registered(spark: SparkSession, path: str, run: str) -> int:
    kind = "run string, number int"
    try:
        known = {r["run"]: r["number"] for r in spark.read.schema(kind).parquet(f"{path}/runs").collect()}
    except AnalysisException:
        known = {}
    if run not in known:
        known[run] = max(known.values(), default=-1) + 1
        spark.createDataFrame([(run, known[run])], kind).coalesce(1).write.mode("append").parquet(f"{path}/runs")
    return known[run]


@dataclass(frozen=True)
class Carry:
    """States below ``path`` with one schema."""

    path: str
    schema: StructType

    def _at(self, run: int, batch_id: int) -> str:
        return f"{self.path}/states/run={run}/batch_id={batch_id}"

    def _read(self, spark: SparkSession, path: str) -> DataFrame | None:
        try:
            return spark.read.schema(self.schema).parquet(path)
        except AnalysisException:
            return None

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The state that batch ``batch_id`` of the calling query goes on from."""
        run = run_number(spark, self.path)
        if batch_id and (direct := self._read(spark, self._at(run, batch_id - 1))) is not None:
            return direct
        try:
            names = spark.read.parquet(f"{self.path}/states")
        except AnalysisException:
            return None
        # Names of folders decide; no state is opened for it.
        earlier = (F.col("run") < run) | ((F.col("run") == run) & (F.col("batch_id") < batch_id))
        last = names.where(earlier).agg(F.max(F.struct("run", F.col("batch_id").cast("bigint")))).first()[0]
        return None if last is None else self._read(spark, self._at(*last))

    def step(self, spark: SparkSession, batch_id: int, change: Step) -> DataFrame:
        """Store the state after batch ``batch_id`` and return it."""
        path = self._at(run_number(spark, self.path), batch_id)
        after = change(self.before(spark, batch_id)).select(*self.schema.names)
        after.coalesce(1).write.mode("overwrite").parquet(path)
        return spark.read.schema(self.schema).parquet(path)

    def history(self, spark: SparkSession) -> DataFrame:
        """All states with ``run`` and ``batch_id``."""
        kinds = StructType([*self.schema.fields, StructField("run", IntegerType()), StructField("batch_id", LongType())])
        return spark.read.schema(kinds).parquet(f"{self.path}/states")

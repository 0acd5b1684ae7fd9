"""Addresses of rows that stay the same however often, and by however many tasks, a table is read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.bounds import stored

ADDRESS = ("_file", "_index")
#: Steps over a file scan that give a row of a file at most once, and the same rows in every run.
_ONE_TO_ONE = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a scan of files with nothing over it that repeats, merges or draws rows."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in _ONE_TO_ONE:
        if not plan.children().size():
            return True
        plan = plan.children().apply(0)
    return False


def addressed(df: DataFrame) -> DataFrame:
    """Add the file of every row and its number in that file. A frame that is not a plain scan of files is written first.

    Every call on such a frame writes a copy with addresses of its own: call it once, and take decisions on rows and
    the rows themselves from the frame it returns.

    Numbers by task (``monotonically_increasing_id``) change when the cluster does between two reads.
    """
    if not plain_scan(df):
        df = stored(df, "addressed")
    try:
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        # Files without row numbers.
        return addressed(stored(df, "addressed"))


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``rows``, a frame that ``addressed`` returned, whose address is not among ``dropped``; without addresses."""
    missing = [c for c in ADDRESS if c not in rows.columns]
    if missing:
        raise ValueError(f"rows have no address: {missing}")
    return rows.join(dropped.select(*ADDRESS), list(ADDRESS), "left_anti").drop(*ADDRESS)

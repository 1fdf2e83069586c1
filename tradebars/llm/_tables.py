"""Small helpers of the operators that deal with whole DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradebars.functions.tables import new_path

#: Rows that a task writes at least where the number of rows is known.
ROWS_A_TASK = 250_000


def settle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them again.

    That cuts the lineage, survives lost executors, and gives the planner true sizes. Where about so many rows are known to
    come, as many tasks write them as they need. `tradebars.functions.tables.clear` deletes what a job has written so.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_TASK)))
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, name: str) -> str:
    """The name of a public vocabulary file, of which every worker gets a copy."""
    spark.sparkContext.addFile(public_tokenizers.path(name))
    return name


def shield(docs: DataFrame, added: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rename columns that clash with those an operator adds inside; the second value puts the input's columns back."""
    added = {c.lower() for c in added}
    moved = {c: f"_own_{c}" for c in docs.columns if c.lower() in added}
    columns = docs.columns
    return docs.withColumnsRenamed(moved), lambda out: out.select(*[moved.get(c, c) for c in columns]).withColumnsRenamed({v: k for k, v in moved.items()})

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows turned into Python objects at once inside a task; bounds a worker's memory.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One given table, pruned to ``columns`` (all of them when none are named)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder for one written intermediate, on storage all executors share.

    The folder lies under ``spark.checkpoint.dir``; where that is unset, under the
    SQL warehouse, which is shared too. Never a machine-local temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/candlegap-llm/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, so a lost
    executor costs a re-read and not a recomputation."""
    path = scratch_dir(df.sparkSession, what)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Dealt by ``columns`` over a stated number of partitions, which adaptive execution
    does not join again: for small rows that each stand for much work, such as file names."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[dict[str, list]]:
    """Columns of each batch as Python lists, ``rows`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()


def shared_filesystem(path: str):
    """(file system, path) of a shared location for reads and writes inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))

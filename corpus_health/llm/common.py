"""Helpers shared by the operators: row functions over Arrow batches, landed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from corpus_health.sources.shared import work_dir

#: Rows handed to a row function at once; bounds what a Python worker holds.
SLICE = 256


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back.

    Later jobs don't compute it again, and a lost executor costs them nothing of it. The
    folder is the job's own; empty it when the job is done.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable], size: int = SLICE) -> DataFrame:
    """Run a Python function over slices of the rows of `df`, inside each task.

    `start()` runs once in each task (tables, tokenizers) and returns a function
    that takes one list for each column of `df` and returns one list for each
    column of `schema`, not necessarily as many rows as came in.
    """
    empty = df.sparkSession.createDataFrame([], schema)
    arrow = empty.limit(0).toArrow().schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = start()
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                out = run(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(task, schema)

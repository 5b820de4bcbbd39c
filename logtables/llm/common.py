"""Helpers of several operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, and lost executors lose nothing."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def sent(spark: SparkSession, item) -> Callable[[], object]:
    """A function that gives tasks the item, once per task: it is broadcast as pickled bytes, with its classes by value.

    A broadcast object itself would be read with this package, which executors need not have.
    """
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(item))
    return lambda: pickle.loads(shared.value)


def filter_texts(docs: DataFrame, text: str, verdict: Callable[[], Callable[[list], np.ndarray]]) -> DataFrame:
    """Rows of docs, with all their columns and types, for whose text the verdict is true.

    ``verdict`` is called once per task and returns a function from a list of texts (None for null) to booleans.
    Columns are reached by position, so names may clash in any way.
    """
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = verdict()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(judge(batch.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def remainder(column: str, n: int):
    """crc32 of a number's decimal text modulo n; null gives null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n

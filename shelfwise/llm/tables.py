"""Written intermediate tables in the shared folder named by spark.checkpoint.dir."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from shelfwise.llm.common import ship
from shelfwise.session import checkpoint_dir, noted


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's checkpoint folder, as the URI the cluster gave; ``session.drop_scratch`` deletes it."""
    return noted(f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def append_column(df: DataFrame, name: str, kind: str, inputs: list[str], kernel: Callable) -> DataFrame:
    """All columns of ``df`` and one made by ``kernel(*arrow arrays)`` per batch; rows keep their place, no shuffle."""
    schema = StructType([*df.schema.fields, StructField(name, DataType.fromDDL(kind))])
    at = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = kernel(*(batch.column(i) for i in at))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])
    return df.mapInArrow(run, schema)


ship(__name__)

"""What the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of an Arrow batch: bounds what a Python worker holds, never what is computed.
BATCH_ROWS = 1000
BATCH_BYTES = "8m"

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text, so no further column can clash with an operator's own."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded size."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)


ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
               "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
               "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of ``name type, name type``; works in a task, where there is no session."""
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch of Python lists or arrays, in the order of ``schema``."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, field.type) for c, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def byte_strings(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8; null is the empty text."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file: a path as it is, a bare file name in the installed collection."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)

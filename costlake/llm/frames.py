"""Small helpers that the corpus operators share: Arrow passes over rows, and tables that cut lineage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.session import ensure_checkpoint_dir


def release() -> None:
    """Give freed memory back to the system: Python workers live on from step to step, and an executor has several."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def _released(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    return run


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | T.StructType, barrier: bool = False) -> DataFrame:
    """``df.mapInArrow`` with a function of this package (pickled by reference); a task's memory is released at its end."""
    return df.mapInArrow(_released(fn), schema, barrier)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text of a string column; null is empty."""
    values = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    return [v if v is not None else b"" for v in values.to_pylist()]


def with_new(batch: pa.RecordBatch, new: Iterable[tuple[str, pa.Array]]) -> pa.RecordBatch:
    """The batch with further columns behind its own."""
    new = list(new)
    return pa.RecordBatch.from_arrays([*batch.columns, *(a for _, a in new)], names=[*batch.schema.names, *(n for n, _ in new)])


def added(df: DataFrame, fields: str) -> T.StructType:
    """The schema of df, all columns nullable, followed by ``fields``."""
    own = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType([*own, *T.StructType.fromDDL(fields).fields])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of df has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in ``spark.checkpoint.dir``."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_hash(df: DataFrame):
    """A hash of all columns of a row (maps are left out: they can't be hashed)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])

"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.session import remove_folder, scratch_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_CHARS = 4_000_000
FILE_ROWS = 20_000
LEAST_FILES = 8


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when each job ends; the former setting comes back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def few_files(rows: int) -> int:
    """How many files suit about so many short rows."""
    return max(LEAST_FILES, rows // FILE_ROWS)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to a new table in the shared scratch folder and read it back.

    This cuts lineage: a lost executor costs its running tasks, not the steps before. ``rows`` is about the
    number of short rows, if known: a small table then has few files, however many partitions a shuffle has. Each
    file costs a local file system two processes that set its mode, besides the task.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(few_files(rows))
    path = scratch_dir(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Remove the folders of stored tables that nothing reads any more."""
    for df in tables:
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            remove_folder(df.sparkSession, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, null_text: str | None = "") -> DataFrame:
    """Only ``doc_id`` and ``text``, so that other columns cannot clash with working columns."""
    text = F.col("text").cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def row_key(docs: DataFrame) -> Column:
    """The id and a wide digest of the text: what tells rows apart where ids repeat or are NULL."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return F.struct(
        docs["doc_id"].cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest")
    )


def counted_small(stored_rows: DataFrame, most: int = 200_000) -> DataFrame:
    """A broadcast hint for a stored table of at most ``most`` short rows, which are counted here; else none.

    Without the hint the join shuffles both sides, so the answer is the same for any number.
    """
    return F.broadcast(stored_rows) if stored_rows.count() <= most else stored_rows


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is in column ``key`` of ``keys``."""
    wanted = keys.select(F.col("key").alias("_kept_key"))
    return docs.join(wanted, row_key(docs) == F.col("_kept_key"), "left_semi")


def keep_one_row(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """As ``keep_rows``, but one row of each key; ``copies`` of ``keys`` is their number in ``docs``.

    Only rows that do repeat are grouped.
    """
    once = keep_rows(docs, keys.filter(F.col("copies") == 1))
    several = keep_rows(docs, keys.filter(F.col("copies") > 1))
    number = several.withColumn("_row_key", row_key(several)).dropDuplicates(["_row_key"])
    return once.unionByName(number.select(*[number[f"`{name}`"] for name in docs.columns]))


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = BATCH_CHARS
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds ``most`` bytes of a string column at most, or a single row."""
    for batch in batches:
        start = size = 0
        lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
        for row, n in enumerate(lengths):
            if size and size + (n or 0) > most:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Return this process's freed memory to the system, as far as its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, whose worker keeps no freed memory: Spark leaves it to later tasks and stages."""

    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows one by one, so that no second copy of a batch of large bodies is made."""
    for row in zip(*batch.columns):
        yield tuple(value.as_py() for value in row)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema)], schema=schema
    )


def pack(*arrays: np.ndarray, level: int = 6) -> bytes:
    """Integer arrays as compressed byte planes, which suits many small numbers."""
    parts = [np.array([len(arrays)], "<i8").tobytes()]
    for array in arrays:
        planes = np.ascontiguousarray(array.view(np.uint8).reshape(-1, array.itemsize).T)
        parts += [np.array([len(array), array.itemsize], "<i8").tobytes(), planes.tobytes()]
    return zstandard.compress(b"".join(parts), level)


def unpack(body: bytes) -> list[np.ndarray]:
    raw, at, arrays = zstandard.decompress(body), 8, []
    for _ in range(int.from_bytes(raw[:8], "little")):
        n, size = np.frombuffer(raw, "<i8", 2, at).tolist()
        planes = np.frombuffer(raw, np.uint8, n * size, at + 16).reshape(size, n)
        arrays.append(np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(-1))
        at += 16 + n * size
    return arrays

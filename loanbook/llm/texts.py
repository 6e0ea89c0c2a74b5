"""Reading documents, and handing whole texts to Python in bounded slices."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.sources.tables import staged

__all__ = ["documents", "give_back", "staged", "text_slices", "unit_hash", "with_texts"]

#: A task works on this many bytes of text at a time, or on one longer text.
SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unit_hash(*columns: str | Column, seed: int = 0) -> Column:
    """A number from 0 up to 1 that the columns' values alone decide."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 32)) / F.lit(float(1 << 32))


def with_texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text``, and further columns by name, whatever else the
    table holds."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(name) for name in more],
    )


def give_back() -> None:
    """Hand memory that was freed to the system: a worker process waits between
    tasks with all that its allocators keep, beside an executor's other ones."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def text_slices(
    batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Arrow batches cut by bytes of text, each with its texts as UTF-8 bytes.

    Texts are never cut: a slice holds one row at least.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        texts = column.cast(pa.binary())
        start, size = 0, 0
        for row, length in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
            if row > start and size + length > limit:
                yield batch.slice(start, row - start), texts.slice(start, row - start).to_pylist()
                start, size = row, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start), texts.slice(start).to_pylist()
        # workers are reused, and share an executor's memory with its JVM
        del column, texts
        give_back()

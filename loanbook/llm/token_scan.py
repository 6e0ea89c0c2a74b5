"""Token counts of documents in flat token files without an index.

A flat file is nothing but token ids of a fixed width, documents ending in an
end-of-document id. Each block of a file is searched for that id in one
vectorised comparison; a block tells how many documents end in it and where, but
not which ones, and its first and last document reach into other blocks. A
prefix scan over the blocks of a file, running sums of ends and the last end
before a block, stitches them together.

Flat files are read by Spark's binary file source, or streamed from documents as
they are tokenized. ``write_flat`` writes documents as flat files.

Defined results: a document's count excludes its end id; ids after the last end
of a file are a last, unended document; an empty file has no documents; bytes
that fill no whole id at the end of a file are an error. A null or empty text is
an ended document of no ids. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, staged, text_slices, with_texts
from loanbook.llm.tokens import word_ids

#: Ids in a block.
BLOCK_IDS = 1 << 18
KIND = np.dtype("<u4")
#: The end id of files made here: beyond the vocabulary, so that no text holds it.
END_ID = 1 << 16

BLOCK_SCHEMA = "file string, block long, payload binary, doc_ids array<long>"
SCANNED_SCHEMA = "file string, block long, n_ids long, ends array<long>, doc_ids array<long>"


def blocks_of_files(spark: SparkSession, path: str, kind: np.dtype = KIND, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The blocks of all flat files below a path, in the order of each file."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                if data.size % kind.itemsize:
                    raise ValueError(f"{name} ends in the middle of an id")
                step = block_ids * kind.itemsize
                for number, at in enumerate(range(0, data.size, step)):
                    yield _block(name, number, data.slice(at, min(step, data.size - at)), None)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(cut, BLOCK_SCHEMA)


def _block(file: str, number: int, payload: bytes | pa.Buffer | None, doc_ids: list[int | None] | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file]),
            pa.array([number], pa.int64()),
            pa.array([None if payload is None else bytes(payload)], pa.binary()),
            pa.array([doc_ids], pa.list_(pa.int64())),
        ],
        names=["file", "block", "payload", "doc_ids"],
    )


def blocks_of_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Documents as a stream of flat blocks, one file for each task; blocks are
    cut wherever they are full. Each also lists the documents read since the one
    before, so that counts can be named; the scan makes no use of it."""

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, number = f"task-{TaskContext.get().partitionId():05d}", 0
        encoder = word_ids(tokenizer)
        waiting, named = np.zeros(0, dtype=KIND), []
        for rows, texts in text_slices(batches):
            ids, starts = encoder.of_texts(texts)
            named += rows.column(0).to_pylist()
            waiting = np.concatenate([waiting, np.insert(ids.astype(KIND), starts[1:], KIND.type(end_id))])
            full = len(waiting) - len(waiting) % block_ids
            for at in range(0, full, block_ids):
                yield _block(file, number, waiting[at : at + block_ids].tobytes(), named)
                number, named = number + 1, []
            waiting = waiting[full:]
        if len(waiting):
            yield _block(file, number, waiting.tobytes(), named)

    return with_texts(docs).mapInArrow(stream, BLOCK_SCHEMA)


def write_flat(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write documents as flat files, a part file for each task.

    The text writer puts the bytes of a value and then its line separator; with
    ids as the value's bytes and the end id as separator, that is a flat file,
    on any file system that Spark can write to. The end id's bytes must be ASCII.
    """
    separator = np.array([end_id], dtype=KIND).tobytes().decode("ascii")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        for _, texts in text_slices(batches):
            ids, starts = encoder.of_texts(texts)
            data = ids.astype(KIND)
            values = [data[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])

    rows = with_texts(docs).mapInArrow(encode, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", separator).text(path)


def scan_blocks(blocks: DataFrame, end_id: int = END_ID, kind: np.dtype = KIND) -> DataFrame:
    """Per block its number of ids and the places of end ids in it."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [np.frombuffer(x.as_buffer(), dtype=kind) if x.is_valid else [] for x in batch.column(2)]
            ends = [np.flatnonzero(np.asarray(ids) == end_id) for ids in payloads]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(ids) for ids in payloads], pa.int64()),
                    pa.array(ends, pa.list_(pa.int64())),
                    batch.column(3),
                ],
                names=["file", "block", "n_ids", "ends", "doc_ids"],
            )

    return blocks.mapInArrow(scan, SCANNED_SCHEMA)


def _stitched(scanned: DataFrame) -> DataFrame:
    """Blocks with what lies before them in their file: ids, ended documents,
    and where the last ended document stopped."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = scanned.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    last = F.col("first_id") + F.element_at("ends", -1) + 1
    return blocks.withColumn("last_stop", F.when(F.size("ends") > 0, last)).withColumns(
        {
            "ended_before": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
            "open_from": F.coalesce(F.max("last_stop").over(before), F.lit(0)),
        }
    )


def document_counts(scanned: DataFrame) -> DataFrame:
    """One row per document: ``file``, ``ordinal`` in it, ``start``, ``n_tokens``
    and whether it is ``ended``."""
    stitched = _stitched(scanned)
    stops = F.transform("ends", lambda end: end + F.col("first_id"))
    begins = F.concat(F.array("open_from"), F.transform(stops, lambda stop: stop + 1))
    ended = stitched.select(
        "file", "ended_before", F.posexplode(F.arrays_zip(stops.alias("stop"), F.slice(begins, 1, F.size(stops)).alias("start")))
    ).select(
        "file",
        (F.col("ended_before") + F.col("pos")).alias("ordinal"),
        F.col("col.start").alias("start"),
        (F.col("col.stop") - F.col("col.start")).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    whole = stitched.groupBy("file").agg(
        F.sum(F.size("ends")).alias("ordinal"), F.max("last_stop").alias("start"), F.sum("n_ids").alias("n_ids")
    )
    start = F.coalesce("start", F.lit(0).cast("long"))
    unended = whole.where(F.col("n_ids") > start).select(
        "file", "ordinal", start.alias("start"), (F.col("n_ids") - start).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.unionByName(unended)


def named_counts(scanned: DataFrame) -> DataFrame:
    """Counts with the ``doc_id`` of the document that stands at each ordinal."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    listed = scanned.select("file", "block", "doc_ids").withColumn(
        "listed_before", F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0))
    )
    names = listed.select("file", "listed_before", F.posexplode("doc_ids").alias("pos", "doc_id")).select(
        "file", (F.col("listed_before") + F.col("pos")).alias("ordinal"), "doc_id"
    )
    return document_counts(scanned).join(names, ["file", "ordinal"])


def op7_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # stored, as both the counts and the names read it
    scanned = scan_blocks(blocks_of_documents(documents(spark, sf_dir)))
    return named_counts(staged(scanned, "ends")).select("doc_id", "n_tokens", "file", "ordinal", "start")

"""Folders for intermediate tables, on storage every executor can reach."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Of stored tables; a third less than the default on keys and texts.
COMPRESSION = "zstd"
#: Of tables that stay: most columns hold too many values for a dictionary, which
#: costs a third of the time of a write to find out and then leaves larger pages.
PLAIN = {"parquet.enable.dictionary": "false"}


#: Whether Spark deletes what a query shuffled once the query has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_setting = threading.Lock()
#: How many writes go on, and what the setting was before the first.
_writes: list = [0, None]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """For writing a table: what is shuffled for it goes as soon as it is stored.

    Otherwise those files stay until the driver happens to collect its garbage,
    and the shuffles of one stored table lie beside those of the next.
    """
    # tables may be written at the same time, by threads of one session
    with _setting:
        if not _writes[0]:
            _writes[1] = spark.conf.get(SHUFFLES_GO, None)
            spark.conf.set(SHUFFLES_GO, "true")
        _writes[0] += 1
    try:
        yield
    finally:
        with _setting:
            _writes[0] -= 1
            if not _writes[0]:
                spark.conf.unset(SHUFFLES_GO) if _writes[1] is None else spark.conf.set(SHUFFLES_GO, _writes[1])


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder of this machine stands in
    for it in a local session. Elsewhere executors would not share such a
    folder, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return tempfile.mkdtemp(prefix="loanbook-")
    raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/loanbook/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The rows through a table in the scratch folder: computed once, lineage
    cut, and safe from the loss of executors."""
    path = scratch_path(rows.sparkSession, name)
    with freed_shuffles(rows.sparkSession):
        rows.write.parquet(path, compression=COMPRESSION)
    return rows.sparkSession.read.parquet(path)

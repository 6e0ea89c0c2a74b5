"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, recency: str = "data_ingestao") -> DataFrame:
    """One row per key: the most recent, ties settled by all other columns.

    The rank filter is applied within every map task before the shuffle (Spark's
    window group limit), so a key held by a third of all rows sends one row per
    task, not its whole group.
    """
    others = [name for name in rows.columns if name not in (key, recency)]
    newest_first = Window.partitionBy(key).orderBy(
        F.desc_nulls_last(recency), *[F.asc_nulls_last(name) for name in others]
    )
    ranked = rows.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")

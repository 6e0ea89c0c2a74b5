"""Approximate nearest neighbours by cross-polytope hashing.

A vector is scaled by the largest norm of its dimension and gets one more
component that brings it to length one, so that the smallest angle belongs to
the largest inner product. Three rounds of random signs and a Hadamard transform
turn it pseudo-randomly; its cell is the signed axis it comes nearest to. A
second turn adds a coarser cell once a table's cells would hold too many
vectors. Queries look into the cells next in line too, in every table, and all
vectors found there are ranked by their exact inner product.

Every vector is indexed. Equal vectors are searched as one and listed by id, and
a crowded cell is dealt out in blocks which its queries all visit, so neither
copies nor crowds gather in one task.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id; vectors of different length
are never compared. Ties go to the smaller id, rows that share an id and a
vector count once, and a table without vectors gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.texts import staged

TABLES = 16
PROBES = 16
#: Vectors in a cell, about, before a second turn splits it.
CELL_ROWS = 4096
#: Index rows that are searched together, about.
PART_ROWS = 100_000

HASHED_SCHEMA = "bucket long, node long, vector binary"
FOUND_SCHEMA = "query long, node long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, as ``vec_id`` and ``embedding`` in double precision."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where("vec_id is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(finite & F.exists("embedding", lambda x: x != 0))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, whose length is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        pairs = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(rows), -1)
        step *= 2
    return rows / np.sqrt(width)


def turned(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    for _ in range(3):
        rows = hadamard(rows * rng.choice([-1.0, 1.0], rows.shape[1]))
    return rows


def signed_axes(rows: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes of each row, nearest first, and how much farther
    along each row reaches on the first of them, squared."""
    both = np.concatenate([rows, -rows], 1)
    number = min(number, both.shape[1])
    near = np.argpartition(-both, number - 1, axis=1)[:, :number]
    reach = np.take_along_axis(both, near, 1)
    order = np.argsort(-reach, axis=1, kind="stable")
    near, reach = np.take_along_axis(near, order, 1), np.take_along_axis(reach, order, 1)
    return near, (reach[:, :1] - reach) ** 2


def second_width(rows: int, width: int, cell_rows: int = CELL_ROWS) -> int:
    """Axes of the second turn: 0 for none, else a power of two up to the width."""
    axes = 0
    while axes < width and rows / (2 * width * max(1, 2 * axes)) > cell_rows:
        axes = max(1, 2 * axes)
    return axes


def cells(rows: np.ndarray, table: int, axes: int, probes: int) -> np.ndarray:
    """The cells of each row in a table, nearest first: ``probes`` of them."""
    first, gap = signed_axes(turned(rows, np.random.default_rng([table, 1])), probes)
    if not axes:
        return first
    second, more = signed_axes(turned(rows, np.random.default_rng([table, 2]))[:, :axes], probes)
    total = (gap[:, :, None] + more[:, None, :]).reshape(len(rows), -1)
    cell = (first[:, :, None] * (2 * axes) + second[:, None, :]).reshape(len(rows), -1)
    best = np.argsort(total, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(cell, best, 1)


def hashed(rows: DataFrame, sizes: dict[int, tuple[int, float]], tables: int, probes: int) -> DataFrame:
    """A row for each table and probe of each vector, by bucket. ``sizes`` holds
    number of vectors and largest norm for each dimension."""

    def hash_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            values, ids = lists.flatten().to_numpy(), batch.column(0).to_numpy()
            ends = np.cumsum(lengths)
            for dimension in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dimension)
                vectors = values[(ends[own] - dimension)[:, None] + np.arange(dimension)]
                width = 1 << dimension.bit_length()
                count, norm = sizes[dimension]
                axes = second_width(count, width)
                unit = np.zeros((len(own), width))
                unit[:, :dimension] = vectors / norm
                unit[:, dimension] = np.sqrt(np.maximum(0.0, 1 - (unit**2).sum(1)))
                payload = [vector.tobytes() for vector in vectors]
                for table in range(tables):
                    found = cells(unit, table, axes, probes)
                    bucket = ((dimension << 8 | table) << 32) + found
                    repeated = np.repeat(np.arange(len(own)), found.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket.ravel()),
                            pa.array(ids[own][repeated]),
                            pa.array(payload, pa.binary()).take(pa.array(repeated)),
                        ],
                        names=["bucket", "node", "vector"],
                    )

    return rows.select("vec_id", "embedding").mapInArrow(hash_batches, HASHED_SCHEMA)


def best_rows(query: np.ndarray, node: np.ndarray, score: np.ndarray, number: int) -> np.ndarray:
    """Places of the ``number`` best distinct nodes of each query."""
    _, once = np.unique(np.stack([query, node]), axis=1, return_index=True)
    order = once[np.lexsort((node[once], -score[once], query[once]))]
    _, first, count = np.unique(query[order], return_index=True, return_counts=True)
    place = np.arange(len(order)) - np.repeat(first, count)
    return order[place < number]


def search_part(index: pa.Table, probes: pa.Table, number: int) -> pa.Table:
    """The best nodes of each query among those that share a bucket's block."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    index, probes = index.sort_by([("bucket", "ascending"), ("block", "ascending")]), probes.combine_chunks()

    def places(table: pa.Table) -> dict[tuple[int, int], np.ndarray]:
        keys = np.stack([table["bucket"].to_numpy(), table["block"].to_numpy()])
        order = np.lexsort(keys[::-1])
        if not len(order):
            return {}
        change = np.flatnonzero((np.diff(keys[:, order]) != 0).any(0)) + 1
        return {tuple(keys[:, part[0]].tolist()): part for part in np.split(order, change)}

    def vectors(table: pa.Table, rows: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(table["vector"].take(pa.array(rows)).to_pylist())).reshape(len(rows), -1)

    at = places(index)
    nodes, queries = index["node"].to_numpy(), probes["node"].to_numpy()
    for key, asking in places(probes).items():
        if key not in at:
            continue
        own = at[key]
        held = vectors(index, own)
        for start in range(0, len(asking), 256):
            rows = asking[start : start + 256]
            score = vectors(probes, rows) @ held.T
            # all that reach the score of the last one wanted, so ties stay together
            if len(own) > number:
                last = -np.partition(-score, number - 1, axis=1)[:, number - 1 : number]
                row, column = np.nonzero(score >= last)
            else:
                row, column = (x.ravel() for x in np.indices(score.shape))
            found.append((queries[rows[row]], nodes[own[column]], score[row, column]))
    query, node, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3
    if len(query):
        best = best_rows(query, node, score, number)
        query, node, score = query[best], node[best], score[best]
    return pa.table({"query": query, "node": node, "score": score.astype(float)})


def _top(rows: DataFrame, by: str, order: list[Column], number: int) -> DataFrame:
    """The first rows of each group; Spark keeps no more in each task before it
    shuffles."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("rank") <= number)


def nearest(
    vectors: DataFrame, is_query: Column, number: int = 20, tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """For each query row its nearest found other rows: ``query_id``, ``rank``,
    ``vec_id``, ``score``."""
    rows = usable(vectors).withColumn("name", F.struct(F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")))
    rows = staged(rows.dropDuplicates(["vec_id", "name"]).withColumn("is_query", is_query), "vectors")
    wanted = number + 1  # the query's own vector is among them
    members = _top(rows.select("vec_id", "name"), "name", [F.col("vec_id")], wanted)
    members = staged(members.withColumn("node", F.min("vec_id").over(Window.partitionBy("name"))), "members")
    nodes = rows.join(members.where("rank = 1").select("name", "vec_id"), ["name", "vec_id"], "left_semi")
    asking = staged(rows.where("is_query").select("vec_id", "name"), "queries")
    asked = nodes.join(asking.select("name").distinct(), "name", "left_semi")
    norms = nodes.groupBy(F.size("embedding").alias("dimension")).agg(
        F.count("*").alias("rows"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("square")
    )
    # one row per vector length
    sizes = {row.dimension: (row.rows, float(np.sqrt(row.square))) for row in norms.collect()}
    if not sizes:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)

    index = staged(hashed(nodes, sizes, tables, 1), "index")
    crowded = index.groupBy("bucket").count().where(F.col("count") > CELL_ROWS)
    crowded = staged(crowded.select("bucket", F.ceil(F.col("count") / CELL_ROWS).alias("blocks")), "crowded")
    parts = max(1, -(-sum(count for count, _ in sizes.values()) * tables // PART_ROWS))
    part = F.pmod(F.xxhash64("bucket", "block"), F.lit(parts)).alias("part")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = index.join(crowded, "bucket", "left").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    visits = hashed(asked, sizes, tables, probes).join(crowded, "bucket", "left")
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    columns = ["bucket", "block", "node", "vector", part]
    found = (
        dealt.select(*columns)
        .groupBy("part")
        .cogroup(visits.select(*columns).groupBy("part"))
        .applyInArrow(lambda index, probes: search_part(index, probes, wanted), FOUND_SCHEMA)
    )

    # a pair found in several tables has one score but for the last bit
    once = found.groupBy("query", "node").agg(F.max("score").alias("score"))
    classes = _top(once, "query", [F.desc("score"), F.col("node")], wanted).drop("rank")
    listed = classes.join(members.select("node", "vec_id"), "node")
    listed = staged(_top(listed, "query", [F.desc("score"), F.col("vec_id")], wanted).drop("rank", "node"), "listed")
    names = members.where("rank = 1").select("name", F.col("node").alias("query"))
    queries = staged(asking.withColumnRenamed("vec_id", "query_id").join(names, "name"), "queries")
    pairs = queries.join(listed, "query").where("query_id <> vec_id")
    ranked = _top(pairs, "query_id", [F.desc("score"), F.col("vec_id")], number)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 20 == 0)

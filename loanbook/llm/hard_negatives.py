"""Hard negatives by rotated one-bit codes with their alignment.

A vector is turned by a pseudo-random rotation and stored as the signs of its
components, one bit each, with its alignment: how far it reaches along that code
vector. What is left of it stands at a right angle to the code vector and has a
known length. An inner product is therefore alignment times the anchor's share
along the code vector, which popcounts of the bits against the anchor's bit
planes give, plus a rest that the inequality of Cauchy and Schwarz bounds by the
lengths of both rests. The bound is no estimate: every interval holds the true
product. Rows whose interval cannot reach what is looked for fall away, and
survivors are scored in whole numbers.

Rows are searched in blocks of bounded size, each against chunks of anchors; a
block's best so far raise the bar for the rest of it. First come an anchor's
nearest rows of its own label, its positives; then for each positive the best
rows of other labels whose scores lie between two shares of the positive's.

Defined results: rows with a null id, label or vector, or with null or
non-finite components take no part; vectors of different length are never
compared; rows equal in id, label and vector count once; rows with the anchor's
id are never its positives or negatives; ties go to the smaller id; a positive
that is not above zero has no negatives unless a score of zero fits; an anchor
without positives, or a positive without negatives, has no rows; an empty table
gives no rows. A score beyond 64 bits is an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.texts import staged

POSITIVES = 5
NEGATIVES = 10
# The shares, in hundredths, of the positive's score.
LOW, HIGH = 30, 90
#: Bytes of vectors in a block of rows and in a chunk of anchors, about.
ROW_BYTES = 32 << 20
ANCHOR_BYTES = 8 << 20
#: Rows of a block below which it is not split for more tasks.
LEAST_ROWS = 2_000
#: Rows and anchors compared in one step of numpy.
STEP_ROWS = 4_096
STEP_ANCHORS = 128
#: Bits an anchor's components are rounded to.
PLANES = 8
WORD = 64

CODED_SCHEMA = "vec_id long, label long, anchor boolean, vector binary, bits binary, alignment double, rest double, length double"
POSITIVE_SCHEMA = "anchor long, positive_id long, positive_score long"
NEGATIVE_SCHEMA = "anchor long, positive_rank int, negative_id long, negative_score long"


# --- codes -----------------------------------------------------------------------


def rotated(vectors: np.ndarray, seed: int = 1) -> np.ndarray:
    """The vectors, filled up to whole words of bits, turned by three rounds of
    random signs and a Hadamard transform. Lengths and products stay."""
    size = WORD
    while size < vectors.shape[1]:
        size *= 2
    turned = np.zeros((len(vectors), size))
    turned[:, : vectors.shape[1]] = vectors
    rng = np.random.default_rng(seed)
    for _ in range(3):
        turned *= rng.choice([-1.0, 1.0], size)
        half = 1
        while half < size:
            pairs = turned.reshape(len(turned), -1, 2, half)
            turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            turned = turned.reshape(-1, size)
            half *= 2
        turned /= np.sqrt(size)
    return turned


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def coded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits, alignment with the code vector, length of the rest, length."""
    turned = rotated(vectors)
    alignment = np.abs(turned).sum(1) / np.sqrt(turned.shape[1])
    square = (turned**2).sum(1)
    return packed(turned >= 0), alignment, np.sqrt(np.maximum(square - alignment**2, 0)), np.sqrt(square)


class Planes:
    """Anchors rounded to a few bits per component, as bit planes."""

    def __init__(self, vectors: np.ndarray):
        turned = rotated(vectors)
        low = turned.min(1, keepdims=True)
        step = np.maximum((turned.max(1, keepdims=True) - low) / (2**PLANES - 1), 1e-300)
        rounded = np.rint((turned - low) / step)
        self.low, self.step = low, step
        self.planes = [packed((rounded.astype(np.int64) >> bit) & 1 == 1) for bit in range(PLANES)]
        self.total = (low + step * rounded).sum(1, keepdims=True)
        # what rounding may move a sum of components with any signs
        self.error = np.abs(turned - low - step * rounded).sum(1, keepdims=True)
        self.length = np.sqrt((turned**2).sum(1, keepdims=True))
        self.root = np.sqrt(turned.shape[1])

    def intervals(self, some: slice, bits: np.ndarray, alignment: np.ndarray, rest: np.ndarray, length: np.ndarray):
        """Whole numbers that the products of some anchors with rows lie between."""
        ones = np.bitwise_count(bits).sum(1).astype(np.float64)
        counts = np.zeros((len(self.low[some]), len(bits)))
        for bit, plane in enumerate(self.planes):
            for word in range(bits.shape[1]):
                counts += float(1 << bit) * np.bitwise_count(plane[some, word, None] & bits[None, :, word])
        signed = 2 * (self.low[some] * ones + self.step[some] * counts) - self.total[some]
        share, error = signed / self.root, self.error[some] / self.root
        least = np.maximum(np.abs(share) - error, 0)
        own = self.length[some]
        spread = np.sqrt(np.maximum(own**2 - least**2, 0)) * rest
        # far above what sums in double precision may be off by
        spread += alignment * error + 1e-9 * own * length + 1e-6
        middle = alignment * share
        return np.ceil(middle - spread), np.floor(middle + spread)


# --- exact scores ------------------------------------------------------------------


class Scores:
    """Exact inner products of whole-number vectors."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.plain = rows, rows.astype(np.float64)
        self.largest = float(np.abs(self.plain).max()) if rows.size else 0.0

    def __call__(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        most = self.largest * float(np.abs(anchor.astype(np.float64)).max(initial=0)) * len(anchor)
        if most < 2**53:
            return (self.plain[at] @ anchor.astype(np.float64)).astype(np.int64)
        if most < 2**62:
            return self.rows[at] @ anchor
        return np.array([sum(int(x) * int(y) for x, y in zip(row, anchor)) for row in self.rows[at]], dtype=np.int64)


class Best:
    """The highest scores met so far, ties by smaller id."""

    def __init__(self, number: int):
        self.number = number
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort([ids, -scores])[: self.number]
        self.scores, self.ids = scores[order], ids[order]

    @property
    def bar(self) -> float:
        """What a score must reach to get in."""
        return float(self.scores[-1]) if len(self.scores) == self.number else -np.inf


# --- a block of rows against a chunk of anchors ------------------------------------


def _vectors(table: pa.Table, name: str, kind: str) -> np.ndarray:
    column = table.column(name).to_pylist()
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1)


class Block:
    """One block of rows and one chunk of anchors, in numpy."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        whole = lambda table, name: np.array(table.column(name).to_pylist(), dtype=np.int64)
        self.anchor, self.anchor_ids, self.anchor_labels = (whole(anchors, x) for x in ("anchor", "vec_id", "label"))
        self.anchor_vectors = _vectors(anchors, "vector", "<i8")
        self.ids, self.labels = whole(rows, "vec_id"), whole(rows, "label")
        self.bits = _vectors(rows, "bits", "<u8")
        self.alignment, self.rest, self.length = (np.array(rows.column(x).to_pylist()) for x in ("alignment", "rest", "length"))
        self.scores = Scores(_vectors(rows, "vector", "<i8"))
        self.planes = Planes(self.anchor_vectors.astype(np.float64))

    def steps(self) -> Iterator[tuple[range, slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Anchors and rows a step at a time, with the intervals and whether the
        labels agree."""
        for first in range(0, len(self.anchor), STEP_ANCHORS):
            some = slice(first, first + STEP_ANCHORS)
            numbers = range(first, min(first + STEP_ANCHORS, len(self.anchor)))
            for at in range(0, len(self.ids), STEP_ROWS):
                rows = slice(at, at + STEP_ROWS)
                low, high = self.planes.intervals(
                    some, self.bits[rows], self.alignment[rows], self.rest[rows], self.length[rows]
                )
                agree = self.anchor_labels[some, None] == self.labels[None, rows]
                yield numbers, rows, low, high, agree

    def positives(self, number: int) -> pa.Table:
        best = [Best(number) for _ in self.anchor]
        for numbers, rows, _, high, agree in self.steps():
            bars = np.array([best[i].bar for i in numbers])[:, None]
            survive = agree & (high >= bars) & (self.ids[None, rows] != self.anchor_ids[numbers, None])
            for i, row in zip(numbers, survive):
                at = np.flatnonzero(row) + rows.start
                if len(at):
                    best[i].add(self.scores(self.anchor_vectors[i], at), self.ids[at])
        return pa.table(
            {
                "anchor": pa.array(np.repeat(self.anchor, [len(x.ids) for x in best])),
                "positive_id": pa.array(np.concatenate([x.ids for x in best])),
                "positive_score": pa.array(np.concatenate([x.scores for x in best])),
            }
        )

    def negatives(self, goals: list[list[int]], number: int, low: int, high: int) -> pa.Table:
        """``goals`` holds the scores of each anchor's positives in their order."""
        ranges = [[(-(-low * goal // 100), high * goal // 100) for goal in own] for own in goals]
        best = [[Best(number) for _ in own] for own in goals]
        # an anchor's rows must lie below its highest range's end and reach its lowest bar
        ends = np.array([max((end for _, end in own), default=-np.inf) for own in ranges], dtype=float)
        for numbers, rows, least, most, agree in self.steps():
            bars = np.array(
                [min((max(x.bar, begin) for x, (begin, _) in zip(best[i], ranges[i])), default=np.inf) for i in numbers]
            )[:, None]
            survive = ~agree & (most >= bars) & (least <= ends[numbers, None])
            survive &= self.ids[None, rows] != self.anchor_ids[numbers, None]
            for i, row in zip(numbers, survive):
                at = np.flatnonzero(row) + rows.start
                if not len(at):
                    continue
                scores = self.scores(self.anchor_vectors[i], at)
                for x, (begin, end) in zip(best[i], ranges[i]):
                    fits = (scores >= max(begin, x.bar)) & (scores <= end)
                    x.add(scores[fits], self.ids[at[fits]])
        found = [
            (int(anchor), rank, int(key), int(score))
            for anchor, own in zip(self.anchor, best)
            for rank, x in enumerate(own, 1)
            for key, score in zip(x.ids, x.scores)
        ]
        columns = list(zip(*found)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        names = ["anchor", "positive_rank", "negative_id", "negative_score"]
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, columns, kinds)})


# --- the search over all blocks ----------------------------------------------------


def with_codes(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, label, anchor, vector array<long>) with vectors as bytes and
    their codes."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lists = table.column("vector").combine_chunks()
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                own = table.filter(pa.array(sizes == size))
                flat = own.column("vector").combine_chunks().flatten().to_numpy().astype("<i8")
                vectors = flat.reshape(own.num_rows, size)
                bits, alignment, rest, length = coded(vectors.astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own.column(name).combine_chunks() for name in ("vec_id", "label", "anchor")),
                        pa.array([row.tobytes() for row in vectors], pa.binary()),
                        pa.array([row.tobytes() for row in bits], pa.binary()),
                        pa.array(alignment), pa.array(rest), pa.array(length),
                    ],
                    names=["vec_id", "label", "anchor", "vector", "bits", "alignment", "rest", "length"],
                )

    return rows.select("vec_id", "label", "anchor", "vector").mapInArrow(encode, CODED_SCHEMA)


def _spread(rows: DataFrame, name: str, number: Column) -> DataFrame:
    """Rows once for each value of a key from 0 below a number."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), number - 1)))


def _dealt(coded_rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``block`` for every ``chunk``, and anchors with their
    chunk for every block, by size of the vectors (``size``)."""
    tasks = coded_rows.sparkSession.sparkContext.defaultParallelism
    counted = coded_rows.groupBy("size").agg(F.count("*").alias("rows"), F.count_if("anchor").alias("n"))
    parts = lambda count, most: F.ceil(F.col(count) * F.col("size") / F.lit(float(most))).cast("int")
    for_tasks = F.least(F.lit(tasks), F.ceil(F.col("rows") / LEAST_ROWS)).cast("int")
    counted = counted.select(
        "size",
        F.greatest(parts("rows", ROW_BYTES), for_tasks, F.lit(1)).alias("blocks"),
        F.greatest(parts("n", ANCHOR_BYTES), F.lit(1)).alias("chunks"),
    )
    # one row for each length of vectors
    counted = staged(counted, "tiles")
    place = lambda key, number: F.pmod(F.xxhash64(key), F.col(number)).cast("int")
    rows = coded_rows.drop("anchor").join(counted, "size").withColumn("block", place("vec_id", "blocks"))
    dealt = anchors.join(counted, "size").withColumn("chunk", place("anchor", "chunks"))
    return _spread(rows, "chunk", F.col("chunks")), _spread(dealt, "block", F.col("blocks"))


def mine(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores
    for rows (vec_id long, label long, anchor boolean, vector array<long>)."""
    coded_rows = staged(with_codes(rows.distinct()).withColumn("size", F.octet_length("vector")), "codes")
    anchors = coded_rows.where("anchor").select(
        F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "vector", "size"
    )
    anchors = staged(anchors, "anchors")
    tiles = ["size", "block", "chunk"]
    dealt_rows, dealt_anchors = _dealt(coded_rows, anchors)
    row_columns = ["vec_id", "label", "vector", "bits", "alignment", "rest", "length"]
    dealt_rows = dealt_rows.select(*tiles, *row_columns)

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"anchor": [], "positive_id": [], "positive_score": []}).cast(_POSITIVE)
        return Block(left, right).positives(positives)

    own = dealt_anchors.select(*tiles, "anchor", "vec_id", "label", "vector")
    found = own.groupBy(*tiles).cogroup(dealt_rows.groupBy(*tiles)).applyInArrow(nearest, POSITIVE_SCHEMA)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("positive_rank", F.row_number().over(order)).where(F.col("positive_rank") <= positives)
    found = staged(found, "positives")

    # some few scores for each anchor
    listed = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("p"))
    goals = dealt_anchors.join(listed, "anchor").select(
        *tiles, "anchor", "vec_id", "label", "vector", F.col("p.positive_score").alias("goals")
    )

    def between(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({name: [] for name in _NEGATIVE.names}).cast(_NEGATIVE)
        return Block(left, right).negatives(left.column("goals").to_pylist(), negatives, low, high)

    hard = goals.groupBy(*tiles).cogroup(dealt_rows.groupBy(*tiles)).applyInArrow(between, NEGATIVE_SCHEMA)
    order = Window.partitionBy("anchor", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = found.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(hard, ["anchor", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


_POSITIVE = pa.schema([("anchor", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_NEGATIVE = pa.schema(
    [("anchor", pa.int64()), ("positive_rank", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]
)


def labelled(embeddings: DataFrame) -> DataFrame:
    """The rows that take part, with whole-number vectors."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id is not null and label is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x).cast("long"))
    return mine(rows.select("vec_id", moved.alias("label"), (F.col("vec_id") % 100 == 0).alias("anchor"), vector.alias("vector")))


#: The same by scoring every row against every anchor, for checking.
OP13_SQL = """
with usable as (
  select distinct vec_id, label, embedding from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(embedding) = list_count(embedding) and list_bool_and([isfinite(x::double) for x in embedding])),
vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as v from usable),
scores as materialized (
  select a.vec_id as anchor_id, r.vec_id as row_id, a.label = r.label as same, list_dot_product(a.v, r.v)::bigint as score
  from vectors a join vectors r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id and len(a.v) = len(r.v)),
positives as (
  select anchor_id, row_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, row_id) <= 5)
select p.anchor_id, p.positive_id, p.positive_score, s.row_id as negative_id, s.score as negative_score,
  (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.row_id))::int as rank
from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
  and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

"""Quality rules: statistics of each text, an isolation forest over them, and a
cut-off calibrated on labelled documents.

Rules count, the forest judges combinations of counts that no single rule
catches: documents whose statistics are isolated by few random splits differ
from the labelled good ones. The cut-off drops as much labelled bad text as it
can while losing at most a stated share of labelled good text.

Defined results: a null or empty text has all counts 0 and fails the base rule;
repeated rows are judged alike, one result row each; an empty table gives no
rows; with no labelled good document there is no forest and the base rule alone
decides. Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, staged, text_slices, unit_hash, with_texts

# Characters counted as symbols, white space between words.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
#: Words in a window that counts as repeated.
WINDOW = 5

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_distinct_words",
]
STATISTICS_SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """How many words lie in a window of words found twice or more, the first
    one included, and how many distinct words there are."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
    distinct, n = len(numbers), len(ids)
    if n <= window or distinct == n:
        return 0, distinct
    # each window as one number, ranked anew where the next digit would not fit
    keys, base = ids[: n - window + 1].copy(), distinct
    size = distinct
    for step in range(1, window):
        if size > (1 << 62) // base:
            keys = np.unique(keys, return_inverse=True)[1]
            size = n
        keys = keys * base + ids[step : n - window + 1 + step]
        size *= base
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(n, dtype=bool)
    for step in range(window):
        covered[step : step + len(twice)] |= twice
    return int(covered.sum()), distinct


def count_rules(text: bytes | None) -> tuple[int, ...]:
    """The counts of one UTF-8 text, in the order of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated, distinct = repeated_words(words)
    without = lambda drop: len(text) - len(text.translate(None, drop))
    return (
        len(words),
        len(text.decode()) - without(SPACES),
        without(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        without(UPPER),
        without(DIGITS),
        distinct,
    )


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_slices(batches):
        counts = np.array([count_rules(text) for text in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        columns = [rows.column(0), *(pa.array(counts[:, i]) for i in range(len(COUNTS)))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts per document."""
    return with_texts(docs).mapInArrow(_count_batches, STATISTICS_SCHEMA)


def base_failed() -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features(counts: np.ndarray) -> np.ndarray:
    """Scale-free features of rows of counts, in the order of ``COUNTS``; roots
    spread the small shares that most texts have."""
    words, chars, symbols, dup_lines, repeated, lines, upper, digits, distinct = counts.T.astype(float)
    per_word, per_char = 1 / np.maximum(words, 1), 1 / np.maximum(chars, 1)
    return np.column_stack(
        [
            np.log1p(words),
            chars * per_word,
            np.sqrt(symbols * per_char),
            dup_lines / np.maximum(lines, 1),
            np.sqrt(repeated * per_word),
            np.log1p(words / np.maximum(lines, 1)),
            np.sqrt(upper * per_char),
            np.sqrt(digits * per_char),
            distinct * per_word,
        ]
    )


def mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a random tree over n rows."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as parallel arrays; a leaf has column -1 and its depth as split."""

    column: np.ndarray
    split: np.ndarray
    left: np.ndarray
    roots: np.ndarray
    scale: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, from 0 to 1; 0.5 is the usual path."""
        depth = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            while True:
                column = self.column[node]
                inner = column >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(column, 0)] >= self.split[node]
                node = np.where(inner, self.left[node] + right, node)
            depth += self.split[node]
        return 2 ** (-depth / (len(self.roots) * self.scale))


def fit_forest(
    rows: np.ndarray, box: tuple[np.ndarray, np.ndarray], trees: int, rows_per_tree: int, depth_limit: int = 12, seed: int = 1
) -> Forest:
    """Grow each tree on rows of its own by random columns and random splits.

    ``box`` holds the lowest and highest value of each column. Splits are drawn
    over a node's part of that box, not only over the values of its rows: where
    the box reaches beyond the rows, that space comes off in few splits, and
    what lies there is isolated early even in columns the rows hardly vary in.
    """
    rng = np.random.default_rng(seed)
    taken = min(rows_per_tree, len(rows))
    column, split, left, roots = [], [], [], []

    def node() -> int:
        column.append(-1), split.append(0.0), left.append(0)
        return len(column) - 1

    for _ in range(trees):
        roots.append(node())
        open_nodes = [(roots[-1], rng.choice(len(rows), taken, replace=False), *box, 0)]
        while open_nodes:
            at, members, low, high, depth = open_nodes.pop()
            varied = np.flatnonzero(high > low)
            if depth >= depth_limit or len(members) < 2 or not len(varied):
                split[at] = depth + mean_path(len(members))
                continue
            c = int(rng.choice(varied))
            value = rng.uniform(low[c], high[c])
            column[at], split[at], left[at] = c, value, node()
            node()
            right = rows[members, c] >= value
            below, above = high.copy(), low.copy()
            below[c] = above[c] = value
            open_nodes.append((left[at], members[~right], low, below, depth + 1))
            open_nodes.append((left[at] + 1, members[right], above, high, depth + 1))
    arrays = (np.array(column), np.array(split), np.array(left), np.array(roots))
    return Forest(*arrays, scale=mean_path(taken) or 1.0)


def with_scores(statistics: DataFrame, forest: Forest) -> DataFrame:
    """The statistics with the forest's ``anomaly`` score of each row."""
    names = statistics.columns

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.column_stack([batch.column(names.index(c)).to_numpy() for c in COUNTS])
            anomaly = forest.scores(features(counts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly)], names=[*names, "anomaly"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in statistics.dtypes)
    return statistics.mapInArrow(score, f"{fields}, anomaly double")


#: Scores are counted in so many bins for the cut-off.
BINS = 1000


def calibrate(bins: list[tuple[int, int, int]], max_good_loss: float) -> float:
    """The lowest score to drop from, given (bin, good, bad) counts of labelled
    documents: the most bad ones dropped, and the fewest good ones for that,
    while at most a share of the good ones lies above. Over 1 drops nothing."""
    good_total = sum(good for _, good, _ in bins)
    best, cut = 0, 2.0
    good_above = bad_above = 0
    for at, good, bad in sorted(bins, reverse=True):
        good_above += good
        bad_above += bad
        if good_above > max_good_loss * good_total:
            break
        if bad_above > best and bad_above > good_above:
            best, cut = bad_above, at / BINS
    return cut


def fit_sample(known: DataFrame, fit_rows: int, seed: int) -> DataFrame:
    """Counts and quality of different labelled documents, at most ``fit_rows``.
    Most rows that are not among them stay where they stand; then comes the
    bound itself."""
    different = known.select("doc_id", *COUNTS, "quality").distinct()
    drawn = different.withColumn("draw", unit_hash("doc_id", *COUNTS, seed=seed))
    near = drawn.where(F.col("draw") < 1.2 * fit_rows / max(1, different.count()))
    return near.orderBy("draw", "doc_id", *COUNTS, "quality").limit(fit_rows).select(*COUNTS, "quality")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    trees: int = 100,
    rows_per_tree: int = 256,
    fit_rows: int = 20_000,
    max_good_loss: float = 0.002,
    seed: int = 1,
) -> DataFrame:
    """Counts, ``base_failed``, ``anomaly`` and ``kept`` of every document.

    The forest is grown on at most ``fit_rows`` labelled documents that pass the
    base rule, those of smallest hash, repeated rows taken once: trees hold the
    good ones, all of them give the box. The cut-off counts every labelled
    document. A document with
    several labels counts as bad if any is.
    """
    statistics = staged(rule_statistics(docs).withColumn("base_failed", base_failed()), "rules")
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    known = statistics.where(~F.col("base_failed")).join(marks, "doc_id")
    chosen = fit_sample(known, fit_rows, seed).collect()
    chosen = np.array(chosen, dtype=np.int64).reshape(-1, len(COUNTS) + 1)
    verdict = ~F.col("base_failed")
    if not len(chosen) or not (chosen[:, -1] == 1).any():
        return statistics.withColumns({"anomaly": F.lit(None).cast("double"), "kept": verdict})
    rows = features(chosen[:, :-1])
    forest = fit_forest(rows[chosen[:, -1] == 1], (rows.min(0), rows.max(0)), trees, rows_per_tree, seed=seed)
    good, bad = F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)
    bins = (
        with_scores(known, forest)
        .groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .agg(good.alias("good"), bad.alias("bad"))
        .collect()
    )
    cut = calibrate([tuple(row) for row in bins], max_good_loss)
    scored = with_scores(statistics, forest)
    return scored.withColumn("kept", verdict & (F.floor(F.col("anomaly") * BINS) < F.lit(round(cut * BINS))))


def op8_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(documents(spark, sf_dir), labels)

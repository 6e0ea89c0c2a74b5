"""Language identification by prediction by partial matching.

Per language a tree of byte contexts up to ``ORDER`` bytes long holds how often
each byte followed. A byte that followed the longest context is coded by its
share there; otherwise an escape is coded and the next shorter context tried,
down to a uniform byte. Escapes follow method C: as many escape counts as
different followers. Statistics are frozen once learned, so a text's code length
in a language is a sum over its bytes of a number that only the bytes before
them decide, and whole batches are scored by table look-ups. The language with
the shortest code is predicted; the score is its share of the probability.

Learned from a sample of labelled documents, at most ``SAMPLE_DOCUMENTS``
different texts of each language, those of smallest hash, and at most the first
``SAMPLE_BYTES`` of each. Copies neither crowd others out nor count twice.
Text is folded before: A-Z to lower case, digits to one digit.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when nothing was learned; repeated rows are scored alike;
an empty table gives no rows; a very long text is scored in blocks. Labels are
read for learning only, and other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, text_slices, unit_hash, with_texts

ORDER = 3
SAMPLE_DOCUMENTS = 300
SAMPLE_BYTES = 16_384
#: Bytes in the learned alphabet; rarer ones share a place.
ALPHABET = 96
#: Longest contexts kept, the most frequent ones; others use shorter contexts.
CONTEXTS = 16_384
UNDETERMINED = "und"
#: Bytes scored at once.
BLOCK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("0") : ord("9") + 1] = ord("0")
_LETTER = re.compile(r"[^\W\d_]")


def fold(text: bytes) -> np.ndarray:
    return _FOLD[np.frombuffer(text, dtype=np.uint8)]


@dataclass
class Trees:
    """Code lengths in bits by context and byte, one column per language.

    ``symbol`` maps bytes to the alphabet. ``place`` numbers the kept contexts
    of three bytes, 0 for all others; ``longest[place, byte]`` and, for place 0,
    ``shorter[two bytes, byte]`` hold the code lengths.
    """

    languages: list[str]
    symbol: np.ndarray
    place: np.ndarray
    longest: np.ndarray
    shorter: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language; texts are taken as if they
        followed a line break."""
        lead = np.full(ORDER, self.symbol[10], dtype=np.uint8)
        total = np.zeros((len(texts), len(self.languages)))
        for row, text in enumerate(texts):
            codes = np.concatenate([lead, self.symbol[fold(text)]])
            for at in range(ORDER, len(codes), BLOCK):
                total[row] += self.code_lengths(codes[at - ORDER : at + BLOCK]).sum(0)
        return total

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each code but the first three, in each language."""
        n = ALPHABET
        codes = codes.astype(np.int64)
        two = codes[1:-2] * n + codes[2:-1]
        at = self.place[codes[:-3] * (n * n) + two]
        byte = codes[3:]
        found = self.longest[at * n + byte]
        short = np.flatnonzero(at == 0)
        found[short] = self.shorter[two[short] * n + byte[short]]
        return found


def context_keys(codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` codes from each place on, as one number, where they lie in
    one of the texts, which end at the given places. Four codes fit 32 bits."""
    key = np.zeros(max(len(codes) - order + 1, 0), dtype=np.int32)
    for step in range(order):
        key *= ALPHABET
        key += codes[step : len(codes) - order + 1 + step]
    inside = np.ones(len(codes), dtype=bool)
    for step in range(1, order):
        inside[np.maximum(ends - step, 0)] = False
    return key[inside[: len(key)]]


def followers(codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """How often each byte followed each context of ``order`` bytes."""
    keys = context_keys(codes, ends, order + 1)
    return np.bincount(keys, minlength=ALPHABET ** (order + 1)).reshape(-1, ALPHABET)


def escaped(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Code lengths given follower counts (contexts, bytes) and those of the
    contexts one byte shorter: seen bytes by share, others after an escape."""
    total = counts.sum(1, keepdims=True)
    different = (counts > 0).sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = np.log2(total + different) - np.log2(counts)
        escape = np.where(total > 0, np.log2(total + different) - np.log2(different), 0.0)
    return np.where(counts > 0, seen, escape + shorter)


def learn(sample: list[tuple[str, bytes]]) -> Trees | None:
    """Frozen trees of the languages of a sample of (language, text)."""
    languages = sorted({language for language, _ in sample})
    if not languages:
        return None
    # one language at a time, a byte for each byte of its texts
    seen = np.zeros(256, dtype=np.int64)
    for _, text in sample:
        seen += np.bincount(fold(text), minlength=256)
    seen[10] = seen.max() + 1  # a line break leads every text
    frequent = np.argsort(-seen, kind="stable")[: ALPHABET - 1]
    symbol = np.full(256, ALPHABET - 1, dtype=np.uint8)
    symbol[frequent] = np.arange(len(frequent))
    lead = np.full(ORDER, symbol[10], dtype=np.uint8)

    def own(language: str) -> tuple[np.ndarray, np.ndarray]:
        """The codes of its texts in a row, and where each ends."""
        texts = [np.concatenate([lead, symbol[fold(text)]]) for name, text in sample if name == language]
        return np.concatenate(texts), np.cumsum([len(text) for text in texts])

    # contexts of three bytes over all languages, the most frequent ones kept
    count = np.zeros(ALPHABET**3, dtype=np.int64)
    for language in languages:
        count += np.bincount(context_keys(*own(language), ORDER + 1) // ALPHABET, minlength=ALPHABET**3)
    context = np.flatnonzero(count)
    kept = np.sort(context[np.argsort(-count[context], kind="stable")[:CONTEXTS]])
    place = np.zeros(ALPHABET**3, dtype=np.int32)
    place[kept] = np.arange(1, len(kept) + 1)
    longest = np.zeros(((len(kept) + 1) * ALPHABET, len(languages)), dtype=np.float32)
    shorter = np.zeros((ALPHABET**3, len(languages)), dtype=np.float32)
    for column, language in enumerate(languages):
        codes, ends = own(language)
        lengths = np.full((1, ALPHABET), np.log2(ALPHABET))
        for order in range(3):
            # context c of order bytes ends in the context c mod ALPHABET^(order - 1)
            above = np.tile(lengths, (ALPHABET, 1)) if order else lengths
            lengths = escaped(followers(codes, ends, order), above)
        shorter[:, column] = lengths.ravel()
        followed = context_keys(codes, ends, ORDER + 1)
        at = place[followed // ALPHABET] * ALPHABET + followed % ALPHABET
        counts = np.bincount(at, minlength=(len(kept) + 1) * ALPHABET)
        above = np.concatenate([np.zeros((1, ALPHABET)), lengths[kept % ALPHABET**2]])
        longest[:, column] = escaped(counts.reshape(-1, ALPHABET), above).ravel()
    return Trees(languages, symbol, place, longest, shorter)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled_sample(docs: DataFrame, languages_from: str = "lang") -> list[tuple[str, bytes]]:
    """The labelled documents to learn from, at most a fixed number of different
    ones per language and a bounded piece of each."""
    piece = F.substring(F.col("text").cast("binary"), 1, SAMPLE_BYTES)
    known = (
        with_texts(docs, languages_from)
        .where(~held_out() & F.col(languages_from).isNotNull())
        .where(F.octet_length("text") >= 1)
        .withColumns({"draw": unit_hash(F.col("text").cast("binary")), "same": F.xxhash64("text")})
        .select(F.col(languages_from).cast("string").alias("language"), piece.alias("text"), "draw", "same")
    )
    # a share of each language small enough, chosen where the rows stand; then the
    # bound itself. One number for each language reaches the driver
    different = known.select("language", "same").distinct().groupBy("language").agg(F.count("*").alias("n"))
    shares = [(row.language, 1.5 * SAMPLE_DOCUMENTS / row.n) for row in different.collect()]
    if not shares:
        return []
    share = F.element_at(F.create_map(*[F.lit(x) for pair in shares for x in pair]), F.col("language"))
    drawn = known.where(F.col("draw") < share).select("language", "text", "draw").distinct()
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("language").orderBy("draw", "text")))
    chosen = ranked.where(F.col("rank") <= SAMPLE_DOCUMENTS).select("language", "text").orderBy("language", "text")
    return [(row.language, bytes(row.text)) for row in chosen.collect()]


def told(trees: Trees | None, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits per byte of each text."""
    names = [UNDETERMINED] * len(texts)
    scores, rates = np.zeros(len(texts)), np.full(len(texts), np.nan)
    known = [i for i, text in enumerate(texts) if trees and text and _LETTER.search(text.decode(errors="ignore"))]
    if known:
        bits = trees.bits([texts[i] for i in known])
        least = bits.min(1, keepdims=True)
        scores[known] = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(1)
        rates[known] = least[:, 0] / [len(texts[i]) for i in known]
        for i, column in zip(known, bits.argmin(1), strict=True):
            names[i] = trees.languages[column]
    return names, scores, rates


def predict(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``bits_per_byte`` of each document."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            names, scores, rates = told(trees, texts)
            columns = [pa.array(names), pa.array(scores), pa.array(rates, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *columns], names=["doc_id", "lang_pred", "score", "bits_per_byte"]
            )

    return with_texts(docs).mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those not held out."""
    return predict(docs, learn(labelled_sample(docs)))


#: Documents whose best language has less of the probability are rejected.
LEAST_SCORE = 0.5
#: So are those that cost more bits a byte, by this factor, than all but a
#: hundredth of the labelled texts; texts of fewer bytes vary too much for that.
RATE_FACTOR = 1.3
RATE_BYTES = 256


def rate_limit(sample: list[tuple[str, bytes]]) -> float:
    """The most bits a byte that text of a learned language takes: half of the
    labelled texts are rated by what the other half teaches."""
    trees = learn(sample[::2])
    rated = [text for _, text in sample[1::2] if len(text) >= RATE_BYTES]
    rates = told(trees, rated)[2] if trees else np.zeros(0)
    rates = rates[np.isfinite(rates)]
    return RATE_FACTOR * float(np.quantile(rates, 0.99)) if len(rates) else math.inf


def accepted(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, as they are, whose language is determined well enough.
    Where there is nothing to learn from, nothing is rejected."""
    sample = labelled_sample(docs)
    trees, limit = learn(sample), rate_limit(sample)
    rows = docs.withColumn("text", F.col("text").cast("string"))
    if trees is None:
        return rows

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            names, scores, rates = told(trees, texts)
            long = np.array([len(text or b"") >= RATE_BYTES for text in texts])
            kept = (np.array(names, dtype=object) != UNDETERMINED) & (scores >= least_score)
            yield rows.filter(pa.array(kept & ~(long & (rates > limit))))

    return rows.mapInArrow(choose, rows.schema)


def op2_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")

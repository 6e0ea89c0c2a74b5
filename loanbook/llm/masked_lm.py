"""Language-model scores by masked pseudo-likelihood.

Each token is predicted from both sides. A small network predicts its class from
the two tokens before and the two after it: one table per place of the window,
summed and squashed, then a softmax. The class gives the word by how often it
occurs in the corpus, and the word between its two neighbours follows what the
corpus has between them; the token itself is masked in all these counts. A
document scores the sum over its tokens of the log-probability.

The most frequent words of the corpus are classes by themselves, all others
belong to the class of their ending and stay apart within it, so the vocabulary
is that of the corpus. Training is data-parallel: in each round every task runs
stochastic descent over its own documents, and the tasks' networks are averaged
by the positions they learned from. Each position is learned in one round, so in
all of them every position is. The sums are made in the cluster; only one network,
the classes' counts and the frequent words' keys reach the driver.

Counts of words and phrases never do: tasks send sorted hashes in sheaves, one
for each part of all hashes, and get back how often the corpus holds each. The
number of parts grows with the corpus, and so does the length of a hash, with 32
bits within a part, and 16 for the word between two others. Hashes that coincide
count together.

Defined results: a null or empty text, or one without words, has no tokens and
scores 0, with no mean; repeated rows count as often as they occur and score
alike; an empty table gives no rows, and a corpus without words trains nothing.
Without rounds, only how frequent classes and words are is known. Other columns
are ignored. Texts are never cut: one is held whole with all its words, at some
ten times its size.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, staged, text_slices, with_texts

#: Classes: frequent words, endings of other words, and the edge of a text.
WORDS, ENDINGS = 95, 32
EDGE = WORDS + ENDINGS
CLASSES = EDGE + 1
#: Places of the window, relative to the predicted token.
WINDOW = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 2
BATCH = 1024
RATE = 0.05
#: Words are forgotten once a task holds so many.
HELD_WORDS = 200_000
#: A slice of documents is handed on once it holds so many tokens.
SLICE_TOKENS = 1 << 19
#: Tokens of the corpus to a part of all hashes.
PART_TOKENS = 1 << 21
#: How many times the network counts for what stands between two words.
STRENGTH = 1.0

SHAPES = {
    "table": (len(WINDOW), CLASSES, HIDDEN),
    "bias": (HIDDEN,),
    "out": (HIDDEN, CLASSES),
    "prior": (CLASSES,),
}
SIZE = sum(int(np.prod(shape)) for shape in SHAPES.values())


class Places(dict):
    """Places of words in the order in which they came, and the token of each: the
    class of its ending below a hash of the word."""

    def __init__(self) -> None:
        super().__init__()
        self.tokens: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = WORDS + zlib.crc32(word[-3:]) % ENDINGS
        self.tokens.append(int.from_bytes(blake2b(word, digest_size=7).digest(), "little") << 8 | number)
        place = self[word] = len(self)
        return place

    def forget(self) -> None:
        if len(self) > HELD_WORDS:
            self.clear()
            self.tokens.clear()


def packed(values: np.ndarray) -> bytes:
    """Compressed, bytes of one weight together."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return pa.compress(planes, "zstd", asbytes=True) if planes else b""


def unpacked(data: bytes, number: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = pa.decompress(data, number * width, "zstd", asbytes=True) if number else b""
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(width, number).T).view(kind).reshape(-1)


def encoded(docs: DataFrame) -> DataFrame:
    """Slices of documents: their ids, their lengths, the different tokens with
    the most frequent first, and which of them the documents hold."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, task, number = Places(), TaskContext.get().partitionId(), 0
        ids, lengths, parts, held = [], [], [], 0

        def passed() -> pa.RecordBatch:
            words, which, counts = np.unique(
                np.concatenate([*parts, np.zeros(0, np.int32)]), return_inverse=True, return_counts=True
            )
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order))
            columns = [
                pa.array([task << 32 | number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([len(words)], pa.int64()),
                pa.array([packed(np.array(places.tokens, dtype=np.uint64)[words[order]])], pa.binary()),
                pa.array([packed(rank[which])], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["slice", "ids", "lengths", "size", "words", "places"])

        for rows, texts in text_slices(batches):
            for doc, text in zip(rows.column(0).to_pylist(), texts):
                words = text.lower().split() if text else ()
                if held and held + len(words) > SLICE_TOKENS:
                    yield passed()
                    places.forget()
                    ids, lengths, parts, held, number = [], [], [], 0, number + 1
                ids.append(doc)
                lengths.append(len(words))
                parts.append(np.fromiter(map(places.__getitem__, words), dtype=np.int32, count=len(words)))
                held += len(words)
        if ids:
            yield passed()

    schema = "slice long, ids array<long>, lengths array<long>, size long, words binary, places binary"
    return with_texts(docs).mapInArrow(encode, schema)


def _slices(batches: Iterable[pa.RecordBatch | pa.Table]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, ids, lengths, different tokens, and which of these the texts hold."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
            lengths = np.array(get("lengths"), dtype=np.int64)
            words = unpacked(get("words"), get("size"), np.uint64)
            yield get("slice"), get("ids"), lengths, words, unpacked(get("places"), int(lengths.sum()), np.uint32)


def token_count(slices: DataFrame) -> int:
    """How many tokens the corpus has."""
    own = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, length: total + length)
    return slices.agg(F.coalesce(F.sum(own), F.lit(0))).first()[0]


class Classes:
    """Classes of tokens: that of their ending, but for those whose word is frequent."""

    def __init__(self, frequent: list[int], bits: int):
        self.bits = bits
        self.order = np.argsort(np.array(frequent, dtype=np.uint64))
        self.keys = np.array(frequent, dtype=np.uint64)[self.order]

    def of(self, words: np.ndarray) -> np.ndarray:
        classes = words.astype(np.uint8)
        if len(self.keys):
            keys = word_keys(words, self.bits)
            places = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = self.keys[places] == keys
            classes[found] = self.order[places[found]]
        return classes


def class_counts(slices: DataFrame, classes: Classes) -> np.ndarray:
    """How many tokens of the corpus each class has."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, dtype=np.int64)
        for _, _, _, words, places in _slices(batches):
            counts += np.bincount(classes.of(words)[places], minlength=CLASSES)
        columns = [pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, names=["class", "n"])

    # as many rows as there are classes
    rows = slices.mapInArrow(count, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES)
    counts[[row["class"] for row in rows]] = [row.n for row in rows]
    return counts


def split_up(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parts of a network as views of its flat parameters."""
    parts, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        parts[name] = flat[at : at + size].reshape(shape)
        at += size
    return parts


def fresh(counts: np.ndarray, seed: int) -> np.ndarray:
    """A network that knows only how frequent each class is."""
    flat = (np.random.default_rng(seed).standard_normal(SIZE) * 0.1).astype(np.float32)
    parts = split_up(flat)
    parts["bias"][:] = 0
    parts["prior"][:] = np.log((counts + 1) / (counts + 1).sum())
    return flat


def laid_out(lengths: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in a row with edges between them, and the tokens' places there."""
    gap = max(WINDOW)
    places = np.arange(len(line)) + np.repeat(gap * np.arange(1, len(lengths) + 1), lengths)
    spaced = np.full(len(line) + gap * (len(lengths) + 1), EDGE, dtype=line.dtype)
    spaced[places] = line
    return spaced, places


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets of all texts in a row, their windows, and the targets' places."""
    line, places = laid_out(np.array([len(text) for text in texts], dtype=np.int64), np.concatenate(texts))
    return line[places], line[places[:, None] + np.array(WINDOW)], places


def hidden_and_logits(parts: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values, and what each class weighs, as a logarithm without its
    largest value; the edge weighs nothing."""
    hidden = parts["bias"] + parts["table"][0][context[:, 0]]
    for place in range(1, len(WINDOW)):
        hidden += parts["table"][place][context[:, place]]
    np.tanh(hidden, out=hidden)
    logits = hidden @ parts["out"]
    logits += parts["prior"]
    logits[:, EDGE] = -np.inf
    logits -= logits.max(1, keepdims=True)
    return hidden, logits


def _summed(context: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes that occur, and the sums of their rows."""
    order = np.argsort(context, kind="stable")
    ordered = context[order]
    starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    return ordered[starts], np.add.reduceat(rows[order], starts, axis=0)


def descend(flat: np.ndarray, power: np.ndarray, target: np.ndarray, context: np.ndarray) -> None:
    """One step on a batch, in place, each parameter at its own pace."""
    parts = split_up(flat)
    hidden, error = hidden_and_logits(parts, context)
    np.exp(error, out=error)
    error *= 1 / (error.sum(1, keepdims=True) * np.float32(len(target)))
    error[np.arange(len(target)), target] -= np.float32(1 / len(target))
    back = (error @ parts["out"].T) * (1 - hidden**2)
    slope = np.zeros(SIZE, dtype=np.float32)
    slopes = split_up(slope)
    np.matmul(hidden.T, error, out=slopes["out"])
    slopes["prior"][:] = error.sum(0)
    slopes["bias"][:] = back.sum(0)
    for place in range(len(WINDOW)):
        found, sums = _summed(context[:, place], back)
        slopes["table"][place][found] = sums
    power += slope**2
    slope *= RATE
    slope /= np.sqrt(power) + 1e-8
    flat -= slope


def places_of_round(number: int, rounds: int, length: int) -> np.ndarray:
    """The places of a slice that one of the rounds learns, in random order. Each
    place belongs to one round."""
    rng = np.random.default_rng(length)
    turn = rng.permutation(length)
    return turn[number::rounds]


def trained_round(slices: DataFrame, classes: Classes, flat: np.ndarray, number: int, rounds: int) -> np.ndarray:
    """The average of the networks that tasks train over all documents."""

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, power, learned = flat.copy(), np.full(SIZE, 1e-4, dtype=np.float32), 0
        for _, _, lengths, words, held in _slices(batches):
            line, places = laid_out(lengths, classes.of(words)[held])
            chosen = places[places_of_round(number, rounds, len(places))]
            for at in range(0, len(chosen), BATCH):
                rows = chosen[at : at + BATCH]
                descend(own, power, line[rows], line[rows[:, None] + np.array(WINDOW)])
            learned += len(chosen)
        if learned:
            columns = [np.arange(SIZE, dtype=np.int32), own.astype(float) * learned, np.full(SIZE, float(learned))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["place", "total", "weight"])

    sums = slices.mapInArrow(train, "place int, total double, weight double").groupBy("place")
    # as many rows as the network has parameters
    rows = sums.agg((F.sum("total") / F.sum("weight")).alias("value")).collect()
    if not rows:
        return flat
    averaged = flat.copy()
    averaged[[row.place for row in rows]] = [row.value for row in rows]
    return averaged


def token_scores(flat: np.ndarray, line: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Log-probability of the class of each token, from both sides."""
    parts = split_up(flat)
    each = np.zeros(len(places))
    for at in range(0, len(places), 1 << 12):
        rows = places[at : at + (1 << 12)]
        _, logits = hidden_and_logits(parts, line[rows[:, None] + np.array(WINDOW)])
        own = logits[np.arange(len(rows)), line[rows]]
        each[at : at + len(rows)] = own - np.log(np.exp(logits, out=logits).sum(1))
    return each


def summed_up(lengths: np.ndarray, each: np.ndarray) -> np.ndarray:
    """The sum over each text."""
    sums, ends = np.concatenate([[0.0], np.cumsum(each)]), np.cumsum(lengths)
    return sums[ends] - sums[ends - lengths]


def document_scores(flat: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Pseudo-log-likelihood of the classes of each text, in nats."""
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    return summed_up(lengths, token_scores(flat, *laid_out(lengths, np.concatenate(texts))))


# --- words and phrases of the corpus ------------------------------------------


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """One hash of several values in their order."""
    value = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for part in parts:
        value += part
        value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
    return value


def word_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """Keys of tokens. The ``bits`` above 32 name the part."""
    return _mixed(words) >> np.uint64(32 - bits)


def phrase_keys(lengths: np.ndarray, tokens: np.ndarray, bits: int) -> np.ndarray:
    """Keys of each token's neighbours, the token itself below in 16 bits."""
    line, places = laid_out(lengths, tokens)
    around = _mixed(line[places - 1], line[places + 1]) >> np.uint64(32 - bits)
    return around << np.uint64(16) | _mixed(tokens) >> np.uint64(48)


def _sheaves(number: int, kind: int, keys: np.ndarray, counts: np.ndarray, low: int) -> pa.RecordBatch:
    """Ascending different keys cut by part: the 32 bits that follow it, each as
    its distance from the one before, the ``low`` ones below, and the counts."""
    high = keys >> np.uint64(low)
    parts = (high >> np.uint64(32)).astype(np.int64)
    starts = np.concatenate([[0], np.flatnonzero(parts[1:] != parts[:-1]) + 1])
    steps = high.astype(np.uint32)
    steps[1:] -= steps[:-1].copy()
    steps[starts] = high[starts].astype(np.uint32)
    cut = lambda values: [packed(part) for part in np.split(values, starts[1:])]
    columns = {
        "part": parts[starts],
        "slice": np.full(len(starts), number),
        "kind": np.full(len(starts), kind),
        "size": np.diff(np.concatenate([starts, [len(keys)]])),
        "steps": pa.array(cut(steps), pa.binary()),
        "low": pa.array(cut(keys.astype(np.uint16)) if low else [b""] * len(starts), pa.binary()),
        "counts": pa.array(cut(counts.astype(np.uint32)), pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


#: Kinds of keys: of words, and of phrases.
WORD, PHRASE = 0, 1


SHEAF_SCHEMA = "part long, slice long, kind long, size long, steps binary, low binary, counts binary"


def word_sheaves(slices: DataFrame, bits: int) -> DataFrame:
    """A slice's words of a part, by ascending key, and how often it holds each."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, _, words, places in _slices(batches):
            if len(places):
                keys = word_keys(words, bits)
                order = np.argsort(keys)
                yield _sheaves(number, WORD, keys[order], np.bincount(places)[order], 0)

    return slices.mapInArrow(cut, SHEAF_SCHEMA)


def phrase_sheaves(slices: DataFrame, bits: int) -> DataFrame:
    """A slice's different phrases of a part likewise."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, lengths, words, places in _slices(batches):
            if len(places):
                keys, counts = np.unique(phrase_keys(lengths, words[places], bits), return_counts=True)
                yield _sheaves(number, PHRASE, keys, counts, 16)

    return slices.mapInArrow(cut, SHEAF_SCHEMA)


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The total of each key's counts, at every place of the key; and of the
    different keys."""
    different, places = np.unique(keys, return_inverse=True)
    totals = np.bincount(places, weights=counts)
    return totals.astype(np.float32)[places], different, totals


def corpus_totals(sheaves: DataFrame) -> DataFrame:
    """How often the corpus holds the keys of each sheaf, in their order: words,
    or neighbours with their token (``totals``) and alone (``around``). The first
    sheaf of a part holds its most frequent words too (``leaders``)."""

    def add_up(table: pa.Table) -> pa.Table:
        lengths = table["size"].to_pylist()
        read = lambda name, kind: [unpacked(x, n, kind) for x, n in zip(table[name].to_pylist(), lengths)]
        high = np.concatenate([np.cumsum(steps, dtype=np.uint32) for steps in read("steps", np.uint32)])
        counts = np.concatenate(read("counts", np.uint32))
        cut = lambda values: [packed(part) for part in np.split(values, np.cumsum(lengths)[:-1])]
        leaders: list = [[] for _ in lengths]
        of_key, different, total = _totals(high, counts)
        if table["kind"][0].as_py() == WORD:
            totals, around = cut(of_key), [b""] * len(lengths)
            first = np.lexsort((different, -total))[:WORDS]
            part = table["part"][0].as_py() << 32
            leaders[0] = [{"key": part | int(different[at]), "n": int(total[at])} for at in first]
        else:
            low = np.concatenate(read("low", np.uint16))
            totals, around = cut(_totals(high.astype(np.uint64) << np.uint64(16) | low, counts)[0]), cut(of_key)
        columns = [table["slice"], table["part"], table["kind"], table["size"], pa.array(totals, pa.binary())]
        kind = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))
        columns += [pa.array(around, pa.binary()), pa.array(leaders, kind)]
        return pa.table(columns, names=["slice", "part", "kind", "size", "totals", "around", "leaders"])

    schema = "slice long, part long, kind long, size long, totals binary, around binary, leaders array<struct<key:long,n:long>>"
    return sheaves.groupBy("part", "kind").applyInArrow(add_up, schema)


def word_scores(
    classes: np.ndarray, each: np.ndarray, held: tuple[np.ndarray, np.ndarray, np.ndarray], counts: np.ndarray, learned: bool
) -> np.ndarray:
    """Log-probability of each token from that of its class and how often the
    corpus holds the word, it between its neighbours, and these; the token itself
    is masked. What the corpus does not hold shares half a count for each word."""
    of_word, between, around = held
    score = each + np.where(classes < WORDS, 0.0, np.log((of_word - 0.5) / np.maximum(counts[classes], 1)))
    if not learned:
        return score
    return np.log((between - 1 + STRENGTH * np.exp(score)) / (around - 1 + STRENGTH))


def scored(
    slices: DataFrame, totals: DataFrame, classes: Classes, flat: np.ndarray, counts: np.ndarray, learned: bool
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` and its mean of each document."""

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        _, ids, lengths, words, places = next(_slices([rows]))
        total = np.zeros(len(lengths))
        if len(places):
            sheaves, bits = sorted(found.to_pylist(), key=lambda row: row["part"]), classes.bits
            totals, around, phrases = (
                np.concatenate([unpacked(row[name], row["size"], np.float32) for row in sheaves if row["kind"] == kind])
                for name, kind in (("totals", WORD), ("around", PHRASE), ("totals", PHRASE))
            )
            of_word = np.empty(len(words))
            of_word[np.argsort(word_keys(words, bits))] = totals
            _, which = np.unique(phrase_keys(lengths, words[places], bits), return_inverse=True)
            line, at = laid_out(lengths, classes.of(words)[places])
            held = of_word[places], phrases[which].astype(float), around[which].astype(float)
            total = summed_up(lengths, word_scores(line[at], token_scores(flat, line, at), held, counts, learned))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = total / lengths
        return pa.table(
            [pa.array(ids, pa.int64()), pa.array(lengths), pa.array(total), pa.array(mean, from_pandas=True)],
            names=["doc_id", "n_tokens", "log_likelihood", "per_token"],
        )

    both = slices.groupBy("slice").cogroup(totals.groupBy("slice"))
    return both.applyInArrow(score, "doc_id long, n_tokens long, log_likelihood double, per_token double")


def masked_scores(docs: DataFrame, rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """Scores of all documents by a network trained on all of them, and by the
    words and phrases of all."""
    slices = staged(encoded(docs), "codes")
    # the parts' number, by which keys are the longer the more of them there are
    bits = min(31, (token_count(slices) // PART_TOKENS).bit_length())
    words = staged(corpus_totals(word_sheaves(slices, bits)), "word-totals")
    leaders = words.select(F.inline("leaders")).orderBy(F.desc("n"), "key").limit(WORDS).collect()
    classes = Classes([row.key for row in leaders], bits)
    counts = class_counts(slices, classes)
    flat = fresh(counts, seed)
    for number in range(rounds):
        flat = trained_round(slices, classes, flat, number, rounds)
    phrases = corpus_totals(phrase_sheaves(slices, bits))
    totals = words.unionByName(phrases).drop("leaders")
    return scored(slices, totals, classes, flat, counts, rounds > 0)


def op10_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_scores(documents(spark, sf_dir))

"""Near-duplicate documents by min-max hashing of word shingles.

Each permutation of the shingle hashes gives two signature values, the minimum
and the maximum, so half the hash evaluations fill a signature. Bands of two
permutations, four values, name buckets; documents that share one are
candidates, and links are confirmed on the full shingle sets.

Copies do not multiply the work: documents with equal sets form a class, and
classes alone are compared. Nor do large groups of near copies. A shingle that
no other candidate has can be shared with none, so the number of those bounds
what a document can share, and most pairs of far copies need no comparison. Sets
of a bucket are told apart by size, in kinds so wide that linked sets are of one
kind or of two adjacent ones. The member of a kind with the fewest such shingles,
the one most like what its group was copied from, leads it: others of its kind
and the next are compared with it, found links merge into components, and pairs
within one need no comparison any more. Then all pairs that share a bucket, lie
in different components and may reach the similarity are compared, so no link is
lost. What two sets can share is bounded by what each lacks of the leader of the
smaller one's kind and by what each holds besides: missing shingles, hashed to
bits, are missed by both together, and bits that one alone has are not shared.
A part of a long text, which has no shingle to itself either, so cannot lead those
it tells nothing of.

Defined results: A-Z are lower-cased, words are separated by white space as in
``WORD``; a text with fewer words than a shingle is one shingle; a text without
words or null has none, is linked with nothing and is kept. Repeated rows are
copies. Rows that share an id and differ in text are documents of their own. A
document without an id is linked with nothing, has no component and is kept. An
empty table gives no rows. A very long text is worked on whole, in memory of some
ten times its size. Other columns are ignored.

A class is named by its smallest id and its set, in this order, so the smallest
name in a component holds the smallest id in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.components import components
from loanbook.llm.texts import documents, staged, text_slices, with_texts

BANDS = 32
#: Permutations in a band, two signature values each.
PER_BAND = 2
REMEMBERED = 150_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.array([hashes[word] for word in words], dtype=np.uint64)
    size = min(size, len(codes))
    mixed = np.full(len(codes) - size + 1, size, dtype=np.uint64)
    for place in range(size):
        mixed = _mixed(mixed * _ODD + codes[place : len(codes) - size + 1 + place])
    return np.unique(mixed)


def permutations(number: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 31, number, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, number, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, odd: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation, one row of two for each."""
    low = np.full(len(odd), 0xFFFFFFFF, dtype=np.uint32)
    high = np.zeros(len(odd), dtype=np.uint32)
    codes = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(codes), 4096):
        hashed = codes[None, at : at + 4096] * odd + shift
        np.minimum(low, hashed.min(1), out=low)
        np.maximum(high, hashed.max(1), out=high)
    return np.column_stack([low, high])


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit bucket key for each band of a signature."""
    rows = values.reshape(bands, -1).astype(np.uint64)
    keys = np.arange(bands, dtype=np.uint64)
    for column in rows.T:
        keys = _mixed(keys * _ODD + column)
    return keys.view(np.int64)


def _slices(batches: Iterable[pa.RecordBatch]):
    hashes = WordHashes()
    for rows, texts in text_slices(batches):
        if len(hashes) > REMEMBERED:
            hashes.clear()
        yield rows, texts, hashes


def signatures(docs: DataFrame, size: int, bands: int = BANDS) -> DataFrame:
    """Per document its set's size, a 128-bit name of the set, and band keys."""
    odd, shift = permutations(bands * PER_BAND)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for rows, texts, hashes in _slices(batches):
            sizes, names, keys = [], [], []
            for text in texts:
                shingles = shingle_set(text, size, hashes)
                sizes.append(len(shingles))
                names.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                keys.append(band_keys(signature(shingles, odd, shift), bands) if len(shingles) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *columns], names=["doc_id", "n_shingles", "set_name", "bands"]
            )

    return with_texts(docs).mapInArrow(sign, "doc_id long, n_shingles long, set_name binary, bands array<long>")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """``low``, the id of each text, ``set_name`` and the distinct shingles as
    numbers."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for rows, texts, hashes in _slices(batches):
            sets = [shingle_set(text, size, hashes) for text in texts]
            names = [xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None for own in sets]
            numbers = pa.array([own.view(np.int64) for own in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(names, pa.binary()), numbers], names=["low", "set_name", "shingles"]
            )

    return texts.mapInArrow(collect, "low long, set_name binary, shingles array<long>")


def _at(rows: DataFrame, suffix: str, *columns: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{c}_{suffix}") for c in columns])


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their sets, and how many shingles both have and either."""
    joined = (
        pairs.join(_at(sets, "b", "doc_id", "shingles"), F.col("b") == F.col("doc_id_b"))
        .join(_at(sets, "a", "doc_id", "shingles"), F.col("a") == F.col("doc_id_a"))
        .withColumn("both", F.size(F.array_intersect("shingles_a", "shingles_b")))
    )
    return joined.withColumn("either", F.size("shingles_a") + F.size("shingles_b") - F.col("both"))


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * F.col("either")


def _enough(shared: Column, percent: int, a: str, b: str) -> Column:
    """Whether two sets that share so many shingles at most may be linked."""
    return (100 + percent) * shared >= percent * (F.col(f"{a}.size") + F.col(f"{b}.size"))


def _may_link(percent: int, a: str, b: str) -> Column:
    """Whether two sets may be linked, given their ``size`` and how many of
    their shingles are not theirs alone, ``open``."""
    return _enough(F.least(f"{a}.open", f"{b}.open"), percent, a, b)


def _may_link_by_leader(percent: int, a: str, b: str) -> Column:
    """The same for two sets compared with one leader: within it they share no
    more than it keeps without the shingles that either lacks, and besides no
    more than one has without those whose bits the other has not."""
    lacking = sum(F.bit_count(F.col(f"{a}.lacks{i}").bitwiseOR(F.col(f"{b}.lacks{i}"))) for i in range(WORDS))
    within = F.least(F.col(f"{a}.leader_size") - lacking, F.col(f"{a}.inside"), F.col(f"{b}.inside"))

    def common(x: str, y: str) -> Column:
        bits = [(F.col(f"{x}.besides{i}"), F.col(f"{y}.besides{i}")) for i in range(WORDS)]
        return F.col(f"{x}.besides") - sum(F.bit_count(own.bitwiseAND(F.bitwise_not(other))) for own, other in bits)

    outside = F.least(f"{a}.outside", f"{b}.outside", common(a, b), common(b, a))
    return _enough(within + outside, percent, a, b)


#: Shingles a set lacks of its leader, and those it holds besides, are hashed to
#: so many words of 64 bits.
WORDS = 4
#: In kinds of so many members all are compared with the leader, not only those
#: it may be linked with: pairs of members never compared cannot be ruled out.
CROWD = 32


def _kind(percent: int) -> Column:
    """A whole number by ``size``. Linked sets differ in it by one at most; kinds
    are a little wider than that needs, for logarithms are rounded."""
    step = 1.001 * max(math.log(100 / percent), 0.01)
    return F.floor(F.log("size") / step)


def _under(leader_kind: str, kind: str) -> Column:
    """Whether a leader's kind is that of a member or the next smaller one."""
    return (F.col(kind) - F.col(leader_kind)).isin(0, 1)


def _bits(numbers: Column, word: int) -> Column:
    """The numbers whose hash falls into a word, as its bits."""
    one = F.lit(1).cast("long")
    place = lambda x: F.pmod(x, F.lit(64 * WORDS))
    here = F.filter(numbers, lambda x: F.floor(place(x) / 64) == word)
    return F.aggregate(here, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", one, (place(x) % 64).cast("int"))))


def profiles(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (leader a, member b) with what they share, what b lacks of a and
    what b holds besides."""
    lacking, besides = F.array_except("shingles_a", "shingles_b"), F.array_except("shingles_b", "shingles_a")
    return _with_sets(pairs, sets).select(
        "a", "b", "both", "either",
        *[_bits(lacking, i).alias(f"lacks{i}") for i in range(WORDS)],
        *[_bits(besides, i).alias(f"besides{i}") for i in range(WORDS)],
    )


def shareable(sets: DataFrame) -> DataFrame:
    """``doc_id``, the ``size`` of its set, and how many of its shingles some
    other set has too, ``open``."""
    each = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    counted = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    own = counted.where("n = 1").groupBy("doc_id").agg(F.count("*").alias("own"))
    sizes = sets.select("doc_id", F.size("shingles").cast("long").alias("size")).join(own, "doc_id", "left")
    return sizes.select("doc_id", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("open"))


def class_links(docs: DataFrame, buckets: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Components of classes as (node, component), from rows (key, doc_id) of
    class representatives and their buckets."""
    crowded = buckets.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    members = staged(buckets.join(crowded.select("key"), "key"), "buckets")
    if members.isEmpty():
        return None
    wanted = members.select("doc_id").distinct()
    low = wanted.select(F.col("doc_id.low").alias("low")).distinct()
    texts = with_texts(docs).join(low, F.col("doc_id") == F.col("low"), "left_semi").dropDuplicates(["doc_id", "text"])
    sets = shingle_sets(texts, size).select(F.struct("low", "set_name").alias("doc_id"), "shingles")
    sets = staged(sets.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "shingles")
    # a set that shares too little of itself is linked with nothing
    bounds = shareable(sets).where(100 * F.col("open") >= percent * F.col("size")).withColumn("kind", _kind(percent))
    members = staged(members.join(bounds, "doc_id"), "members")

    alone = (1 - F.col("open") / F.col("size")).alias("alone")
    first = F.min(F.struct(alone, -F.col("size"), "doc_id", "size", "open")).alias("lead")
    led_by = members.groupBy("key", "kind").agg(first, F.count(F.lit(1)).alias("n"))
    leaders = staged(led_by.select("key", "kind", "n", "lead.doc_id", "lead.size", "lead.open"), "leaders")
    m, lead = members.alias("m"), leaders.alias("lead")
    led = (F.col("m.key") == F.col("lead.key")) & _under("lead.kind", "m.kind") & (F.col("m.doc_id") != F.col("lead.doc_id"))
    met = m.join(lead, led & ((F.col("lead.n") >= CROWD) | _may_link(percent, "m", "lead")))
    pairs = met.select(F.col("lead.doc_id").alias("a"), F.col("m.doc_id").alias("b")).distinct()
    compared = staged(profiles(staged(pairs, "pairs"), sets), "compared")
    links = staged(compared.where(_linked(percent)).select("a", "b"), "links")
    placed = with_component(_profiled(members, leaders, compared), components(links))
    placed = staged(placed, "placed")
    a, b = placed.alias("a"), placed.alias("b")
    apart = (F.col("a.component") != F.col("b.component")) & (F.col("a.doc_id") < F.col("b.doc_id"))
    possible = _may_link(percent, "a", "b") & _may_link_by_leader(percent, "a", "b")
    # the smaller one's kind has the leader by which both are bounded
    led = (F.col("a.leader_kind") == F.col("b.leader_kind")) & (F.col("a.leader_kind") == F.least("a.kind", "b.kind"))
    rest = a.join(b, (F.col("a.key") == F.col("b.key")) & led & apart & possible)
    pairs = staged(rest.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")).distinct(), "pairs")
    more = _with_sets(pairs, sets).where(_linked(percent)).select("a", "b")
    return components(links.union(more))


def _profiled(members: DataFrame, leaders: DataFrame, compared: DataFrame) -> DataFrame:
    """Members with the size of each leader they are under, how much of that
    leader they hold, at most, and how many open shingles and how many of all
    they hold besides, at most."""
    lead = leaders.select(
        "key", F.col("kind").alias("leader_kind"), F.col("doc_id").alias("leader"), F.col("size").alias("leader_size")
    )
    told = compared.drop("either").withColumnsRenamed({"a": "leader", "b": "doc_id"})
    rows = members.join(lead, "key").where(_under("leader_kind", "kind")).join(told, ["leader", "doc_id"], "left")
    known, own = F.col("both").isNotNull(), F.col("doc_id") == F.col("leader")
    inside = F.when(own, F.col("size")).when(known, F.col("both").cast("long")).otherwise(F.col("open"))
    # those a set has alone lie outside the leader: open ones besides are the rest
    outside = F.when(own, 0).when(known, F.col("open") - F.col("both")).otherwise(F.col("open"))
    # those of a set never compared may have any bit, and take none away
    besides = F.when(own, 0).when(known, F.col("size") - F.col("both")).otherwise(F.col("open") + 64 * WORDS)
    none, every = F.lit(0).cast("long"), F.lit(-1).cast("long")
    return rows.select(
        "key", "kind", "leader_kind", "doc_id", "size", "open", "leader_size", inside.alias("inside"),
        outside.cast("long").alias("outside"), besides.cast("long").alias("besides"),
        *[F.coalesce(f"lacks{i}", none).alias(f"lacks{i}") for i in range(WORDS)],
        *[F.when(own, none).otherwise(F.coalesce(f"besides{i}", every)).alias(f"besides{i}") for i in range(WORDS)],
    )


def with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the component of their ``doc_id``, itself where it has no link."""
    named = labels.select(F.col("node").alias("doc_id"), "component")
    joined = rows.join(named, "doc_id", "left")
    return joined.withColumn("component", F.coalesce("component", "doc_id"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest id reachable by links of at least ``percent`` Jaccard similarity on
    shingles of ``size`` words), and ``kept`` for the document of that id."""
    signed = staged(signatures(docs, size), "signatures")
    members = signed.where("doc_id is not null and set_name is not null")
    classes = members.groupBy("set_name").agg(F.min("doc_id").alias("low"))
    classes = staged(classes.select(F.struct("low", "set_name").alias("doc_id")), "classes")
    named_rows = members.select(F.struct(F.col("doc_id").alias("low"), "set_name").alias("doc_id"), "bands")
    representatives = named_rows.join(classes, "doc_id", "left_semi")
    buckets = representatives.select("doc_id", F.explode("bands").alias("key")).distinct()
    labels = class_links(docs, buckets, size, percent)
    named = classes if labels is None else with_component(classes, labels)
    component = F.col("doc_id" if labels is None else "component")
    named = named.select(F.col("doc_id.set_name").alias("_name"), component["low"].alias("_component"))
    named = staged(named, "classes")
    # both sides are stored tables, so a class of many copies can be split
    joined = signed.join(named, F.col("set_name") == F.col("_name"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, as they are, less all but one row of each group: that of
    smallest id stays, ids that are null come last, and of rows with one id the
    first stored. Rows are numbered in a stored copy, so that repeated rows and
    rows without an id are told apart."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    numbered = staged(docs.select(whole.alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")
    texts = numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))
    found = near_duplicates(texts, size, percent).where(~F.col("kept")).select("component_id", F.col("doc_id").alias("number"))
    found = staged(found, "copies")
    members = found.union(found.select("component_id", F.col("component_id").alias("number")).distinct())
    ids = numbered.select("number", F.col("row.doc_id").alias("id"))
    ordered = F.struct(F.col("id").isNull(), "id", "number")
    members = staged(members.join(ids, "number").select("component_id", ordered.alias("place")), "members")
    first = members.groupBy("component_id").agg(F.min("place").alias("place"))
    # all members but the first; a component has one first member
    copies = members.select("place.number").join(first.select("place.number"), "number", "left_anti")
    return numbered.join(staged(copies, "copies"), "number", "left_anti").select("row.*")


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), size=3, percent=85)

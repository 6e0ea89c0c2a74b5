"""Phrase collocations from a weighted de Bruijn graph of words.

A text is cut into pieces, pieces into words. The longest phrases are the edges
of a graph: an edge of ``longest`` words leads from the node of its first words
to the node of its last, and its weight is how often it occurs. Only edges are
counted in texts. Every word of a piece begins one edge, cut short where the
piece ends, so the count of a shorter phrase is the flow out of its node plus
the pieces that end there, level by level down to single words and to the
number of all words.

Phrases that occur often enough are solid. Solid edges joined by nodes with one
way in and one way out are compacted into paths, which show the whole wording a
phrase belongs to. Candidates are scored by how much more often they occur than
their parts, at their weakest cut, and fall away where a longer candidate makes
up most of them.

Each task counts its edges in sorted codes before they are shuffled. They travel
in sheaves, one row for all edges of a task that go to the same bucket, dealt by
the phrase itself: a frequent phrase is one entry of each task, and buckets grow
in number with the input. A bucket sums its phrases and deals out what flows on
to their nodes. All else works on solid phrases alone.

Defined results: languages that are null count as ``und``; null and empty texts
have no words; repeated rows count as often as they occur; a very long text is
worked on whole, in memory of some ten times its size; ties in score go to the
more frequent phrase, then to the smaller one in byte order; a unary path that
closes upon itself is cut before its smallest edge; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.components import components
from loanbook.llm.texts import documents, staged, text_slices, with_texts

# What ends a piece, and A-Z in lower case; tabs separate like spaces.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(PIECE_ENDS)
)
UNKNOWN_LANGUAGE = "und"
#: Stands for the end of a piece; no UTF-8 text holds this byte.
_END = b"\xff"
#: Words a task counts at once, and distinct words it remembers.
COUNTED = 1_000_000
REMEMBERED = 500_000
#: Bytes of text a task splits into words at once.
SLICE = 1 << 20
#: Phrases hashed in one step of numpy.
HASHED = 1 << 17
#: Bytes of text for each bucket, about, and the fewest buckets.
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32

#: Phrases of one bucket, a line each, with their counts: sums of so many words
#: that are done, or with 0 words phrases that are still to be summed.
SHEAF_SCHEMA = "lang string, bucket int, words int, phrases string, counts array<long>"
_SHEAF = pa.schema(
    [
        ("lang", pa.string()),
        ("bucket", pa.int32()),
        ("words", pa.int32()),
        ("phrases", pa.string()),
        ("counts", pa.list_(pa.int64())),
    ]
)


def words_and_ends(texts: list[bytes]) -> list[bytes]:
    """The words of the texts in a row, and an end after every piece."""
    return b"\n".join([*texts, b""]).translate(_FOLD).replace(b"\n", b" \xff ").split()


class Codes(dict):
    """Numbers words as they are first met; the end of a piece is 0."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def bucket_of(phrases: pa.StringArray, buckets: int) -> np.ndarray:
    """A bucket for each phrase, by its length and its first and last bytes."""
    if len(phrases) > HASHED:
        parts = [phrases.slice(at, HASHED) for at in range(0, len(phrases), HASHED)]
        return np.concatenate([bucket_of(part, buckets) for part in parts])
    starts = np.frombuffer(phrases.buffers()[1], dtype=np.int32)[phrases.offset : phrases.offset + len(phrases) + 1].astype(np.int64)
    content = phrases.buffers()[2]
    data = np.frombuffer(content, dtype=np.uint8) if content is not None and content.size else np.zeros(1, dtype=np.uint8)
    first, length = starts[:-1], np.diff(starts)
    key = length.astype(np.uint64)
    for back in (False, True):
        for step in range(8):
            at = first + (length - 1 - step if back else step)
            byte = np.where(step < length, data[np.clip(at, 0, len(data) - 1)], 0)
            key = (key ^ byte.astype(np.uint64)) * np.uint64(0x100000001B3)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0x9E3779B97F4A7C15)
    return ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _lines(offsets: pa.Int32Array, phrases: pa.StringArray) -> pa.StringArray:
    """Runs of phrases as one text each; no phrase holds a line break."""
    return pc.binary_join(pa.ListArray.from_arrays(offsets, phrases), "\n")


def sheaves(lang: str, phrases: pa.StringArray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Phrases still to be summed, one row for each bucket that has any."""
    bucket = bucket_of(phrases, buckets)
    order = np.argsort(bucket, kind="stable")
    found, begins = np.unique(bucket[order], return_index=True)
    offsets = pa.array(np.append(begins, len(order)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(found), pa.string()),
            pa.array(found, pa.int32()),
            pa.array(np.zeros(len(found)), pa.int32()),
            _lines(offsets, phrases.take(pa.array(order))),
            pa.ListArray.from_arrays(offsets, pa.array(counts[order], pa.int64())),
        ],
        schema=_SHEAF,
    )


def counted_edges(codes: np.ndarray, words: Codes, longest: int) -> tuple[pa.StringArray, np.ndarray]:
    """Distinct edges of coded words, and their counts. What an end cuts short
    is an edge of fewer words."""
    size = len(words)
    padded = np.concatenate([codes, np.zeros(longest, dtype=codes.dtype)])
    begins = np.flatnonzero(codes)
    key, keys, goes_on = padded[begins].astype(np.int64), size, np.ones(len(begins), dtype=bool)
    renumbered: dict[int, np.ndarray] = {}
    for step in range(1, longest):
        if keys > 2**62 // size:
            renumbered[step], key = np.unique(key, return_inverse=True)
            keys = len(renumbered[step])
        following = np.where(goes_on, padded[begins + step], 0)
        goes_on &= following != 0
        key, keys = key * size + following, keys * size
    at, number = np.unique(key, return_counts=True)
    columns = []
    for step in range(longest - 1, 0, -1):
        columns.append((at % size).astype(np.int32))
        at = at // size
        at = renumbered[step][at] if step in renumbered else at
    columns.append(at)
    vocabulary = pa.array([None, *list(words)[1:]], pa.binary())
    parts = [vocabulary.take(pa.array(column)) for column in reversed(columns)]
    return pc.binary_join_element_wise(*parts, b" ", null_handling="skip").cast(pa.string()), number


def edges(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """Sheaves of the edges counted within each task. Those of fewer than
    ``longest`` words end their piece."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, number = Codes(), {}, 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                phrases, counts = counted_edges(np.concatenate(parts), words, longest)
                yield sheaves(lang, phrases, counts, buckets)
            held.clear()
            pa.default_memory_pool().release_unused()

        for rows, texts in text_slices(batches, SLICE):
            langs = rows.column(rows.schema.get_field_index("lang")).to_pylist()
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(langs, texts, strict=True):
                if text:
                    by_lang.setdefault(UNKNOWN_LANGUAGE if lang is None else lang, []).append(text)
            for lang, own in by_lang.items():
                found = words_and_ends(own)
                held.setdefault(lang, []).append(np.array([words[word] for word in found], dtype=np.int32))
                number += len(found)
            if number > COUNTED or len(words) > REMEMBERED:
                yield from flushed()
                number = 0
                words = Codes() if len(words) > REMEMBERED else words
        yield from flushed()

    named = docs.withColumn("lang", F.col("lang").cast("string"))
    return with_texts(named, "lang").mapInArrow(count, SHEAF_SCHEMA)


def _summed(phrases: pa.Array, counts: pa.Array) -> tuple[pa.StringArray, pa.Int64Array]:
    """Distinct phrases and the sums of their counts."""
    told = pa.table({"phrase": phrases, "n": counts}).group_by("phrase").aggregate([("n", "sum")]).combine_chunks()
    return tuple(_array(told.column(name), kind) for name, kind in (("phrase", pa.string()), ("n_sum", pa.int64())))


def _array(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], kind)


def flowed_on(level: int, least: int, buckets: int):
    """For the sheaves of a bucket: phrases of ``level`` words that occur at least
    ``least`` times, and what all phrases add to their nodes' flow."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        lang, bucket = (value.as_py() for value in key)
        is_open = pc.equal(table.column("words"), 0)
        done, waiting = table.filter(pc.invert(is_open)), table.filter(is_open)
        if not waiting.num_rows:
            return done
        lines = pc.list_flatten(pc.split_pattern(waiting.column("phrases"), "\n"))
        phrases, counts = _summed(lines, pc.list_flatten(waiting.column("counts")))
        # a phrase that is shorter already ended its piece
        whole = pc.equal(pc.count_substring(phrases, " "), level - 1)
        if level == 1:
            whole = pc.not_equal(phrases, "")
        solid = pc.and_(whole, pc.greater_equal(counts, least))
        kept = [column.filter(solid) for column in (phrases, counts)]
        parts = [done]
        if len(kept[0]):
            offsets = pa.array([0, len(kept[0])], pa.int32())
            named = [pa.array([x], kind) for x, kind in zip((lang, bucket, level), _SHEAF.types)]
            columns = [*named, _lines(offsets, kept[0]), pa.ListArray.from_arrays(offsets, kept[1])]
            parts.append(pa.Table.from_arrays(columns, schema=_SHEAF))
        cut = pc.replace_substring_regex(phrases, r" [^ ]*$", "") if level > 1 else pa.array([""] * len(phrases))
        phrases, counts = _summed(pc.if_else(whole, cut, phrases), counts)
        parts.append(pa.Table.from_batches([sheaves(lang, phrases, counts.to_numpy(), buckets)]))
        pa.default_memory_pool().release_unused()
        return pa.concat_tables([part.cast(_SHEAF) for part in parts])

    return work


def word_count(phrase: Column) -> Column:
    return F.size(F.split(phrase, " "))


def solid_phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``n`` of all phrases of 1 to
    ``longest`` words that occur at least ``least`` times; the number of all
    words of a language comes with 0 words and an empty phrase.

    At each level the buckets' phrases are summed, solid ones are set aside, and
    the last word of all is cut off, which makes them part of their node's flow.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    rows = edges(docs, longest, buckets)
    for level in range(longest, 0, -1):
        rows = rows.groupBy("lang", "bucket").applyInArrow(flowed_on(level, least, buckets), SHEAF_SCHEMA)
    each = rows.select("lang", "words", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("counts").alias("n"))))
    return each.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def _joined(rows: DataFrame, phrases: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with the count, as ``name``, of the phrase in a column."""
    counts = phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias(name))
    same = (F.col("lang") == F.col("_lang")) & (F.col(column) == F.col("_phrase"))
    return rows.join(counts, same).drop("_lang", "_phrase")


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of 38 digits."""
    whole = lambda x: x.cast("decimal(16,0)")
    above = (F.lit(1_000_000).cast("decimal(7,0)") * (whole(a) * whole(a)).cast("decimal(31,0)")).cast("decimal(38,0)")
    return F.call_function("div", above, (whole(left) * whole(right)).cast("decimal(38,0)")).cast("long")


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates, solid phrases of two words and more, with ``a``, ``l``, ``r``
    and ``score`` at their lowest-scoring cut."""
    candidates = phrases.where("words >= 2").withColumnRenamed("n", "a")
    cuts = candidates.select("lang", "words", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")}
    )
    cuts = _joined(_joined(cuts, phrases, "first", "l"), phrases, "rest", "r")
    cuts = cuts.withColumn("score", exact_score(F.col("a"), F.col("l"), F.col("r")))
    lowest = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mostly_in_longer(phrases: DataFrame, percent: int) -> DataFrame:
    """Candidates that some longer one holds, at ``percent`` of their count at
    least: ``lang`` and ``phrase``."""
    longer = phrases.where("words >= 3")
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1),"
        " start -> array_join(slice(split(phrase, ' '), start, size), ' '))))"
    )
    held = longer.select("lang", "n", F.explode(inner).alias("phrase"))
    most = held.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    both = phrases.where("words >= 2").join(most, ["lang", "phrase"])
    return both.where(100 * F.col("longer") >= percent * F.col("n")).select("lang", "phrase")


def collocations(phrases: DataFrame, top: int, percent: int = 50) -> DataFrame:
    """Each language's first ``top`` candidates by score, from solid phrases."""
    left = scored(phrases).join(mostly_in_longer(phrases, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", F.col("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "words", "a", "l", "r", "n", "score")


# --- compaction of unary paths ---------------------------------------------------


def _followed(links: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """From links (lang, edge, before) to (lang, edge, root, place), the first
    edge of each chain and the distance to it; and the links of edges that have
    no first one, as they lie on a cycle. Distances double each round."""
    at = links.select("lang", "edge", F.col("before").alias("root"), F.lit(1).cast("long").alias("place"))
    at, open_before = staged(at, "paths"), None
    while True:
        # an edge that no link leads into is a root
        up = at.select(
            F.col("lang").alias("_lang"), F.col("edge").alias("_edge"), F.col("root").alias("_root"), F.col("place").alias("_place")
        )
        joined = at.join(up, (F.col("lang") == F.col("_lang")) & (F.col("root") == F.col("_edge")), "left")
        moved = F.col("_edge").isNotNull()
        root, place = F.coalesce("_root", "root"), F.col("place") + F.coalesce("_place", F.lit(0).cast("long"))
        at = staged(joined.select("lang", "edge", root.alias("root"), place.alias("place"), moved.alias("open")), "paths")
        number = at.where("open").count()
        if number in (0, open_before):
            break
        open_before = number
    ended = at.where("not open").drop("open")
    return ended, (links.join(at.where("open").select("lang", "edge"), ["lang", "edge"], "left_semi") if number else None)


def unary_paths(phrases: DataFrame, longest: int = 3) -> DataFrame:
    """Every solid edge with the path it lies on: ``lang``, ``edge``, ``root``
    (the path's first edge), ``place`` in it from 0, and ``n``."""
    solid = phrases.where(F.col("words") == longest).select("lang", F.col("phrase").alias("edge"), "n")
    solid = solid.withColumns(
        {
            "start": F.substring_index("edge", " ", longest - 1),
            "stop": F.substring_index("edge", " ", 1 - longest),
        }
    )
    into = solid.groupBy("lang", F.col("stop").alias("node")).agg(F.count("*").alias("ways"), F.min("edge").alias("before"))
    out = solid.groupBy("lang", F.col("start").alias("node")).agg(F.count("*").alias("ways"), F.min("edge").alias("edge"))
    one = F.col("ways") == 1
    links = into.where(one).drop("ways").join(out.where(one).drop("ways"), ["lang", "node"]).where("before <> edge")
    links = staged(links.select("lang", "edge", "before"), "unary")
    ended, cyclic = _followed(links)
    if cyclic is not None:
        # languages share no edge of the graph: the language is part of a node's name
        name = lambda column: F.struct("lang", F.col(column).alias("edge"))
        labels = components(cyclic.select(name("edge").alias("a"), name("before").alias("b")))
        first = labels.select("component.lang", "component.edge").distinct()
        opened, _ = _followed(staged(cyclic.join(first, ["lang", "edge"], "left_anti"), "cycles"))
        ended = ended.unionByName(opened)
    placed = solid.select("lang", "edge", "n").join(ended, ["lang", "edge"], "left")
    return placed.withColumns(
        {"root": F.coalesce("root", "edge"), "place": F.coalesce("place", F.lit(0).cast("long"))}
    ).select("lang", "edge", "root", "place", "n")


def paths(placed: DataFrame) -> DataFrame:
    """Compacted paths: ``lang``, ``path`` (the whole wording), ``words`` and the
    least weight ``n`` along it. A path is as long as the longest wording that
    recurs without a branch."""
    last = F.substring_index("edge", " ", -1)
    step = F.struct("place", F.when(F.col("place") == 0, F.col("edge")).otherwise(last).alias("part"))
    grouped = placed.groupBy("lang", "root").agg(F.array_sort(F.collect_list(step)).alias("steps"), F.min("n").alias("n"))
    path = F.array_join(F.col("steps.part"), " ")
    return grouped.select("lang", path.alias("path"), word_count(path).cast("long").alias("words"), "n")


def op11_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    longest, top = 3, 2000
    phrases = staged(solid_phrases(documents(spark, sf_dir), longest, least=10), "phrases")
    found = staged(collocations(phrases, top), "collocations")
    placed = staged(unary_paths(phrases, longest), "placed")
    # how long the wording is that a phrase of the longest kind belongs to
    roots = placed.join(found.select("lang", F.col("phrase").alias("edge")), ["lang", "edge"], "left_semi")
    roots = roots.select("lang", "edge", "root")
    lengths = placed.join(roots.select("lang", "root").distinct(), ["lang", "root"], "left_semi")
    lengths = lengths.groupBy("lang", "root").agg((F.max("place") + longest).alias("path_words"))
    known = roots.join(lengths, ["lang", "root"]).select("lang", F.col("edge").alias("phrase"), "path_words")
    rows = found.join(known, ["lang", "phrase"], "left")
    path_words = F.coalesce("path_words", F.col("words").cast("long")).alias("path_words")
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", path_words)


#: The same by counting every length in the texts, for checking, but for the
#: paths: an edge is followed forward and backward while both ways are single.
OP11_SQL = r"""
with recursive pieces as (
  select row_number() over () as piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') as words
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents)),
places as (select lang, words, unnest(range(1, len(words) + 1)) as i from pieces where len(words) > 0),
grams as (select lang, m, words[i:i + m - 1] as w from places, (values (1), (2), (3)) lengths(m) where i + m - 1 <= len(words)),
counts as materialized (select lang, m, w, array_to_string(w, ' ') as phrase, count(*) as f
  from grams group by lang, m, w having count(*) >= 10),
totals as (select lang, count(*) as n from places group by lang),
candidates as materialized (select * from counts where m >= 2),
cuts as (select lang, m, phrase, f, k, array_to_string(w[1:k], ' ') as first, array_to_string(w[k + 1:m], ' ') as rest
  from candidates, (values (1), (2)) ks(k) where k < m),
scores as (select c.*, c.f as a, l.f as l, r.f as r, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score
  from cuts c join counts l on l.lang = c.lang and l.phrase = c.first join counts r on r.lang = c.lang and r.phrase = c.rest),
lowest as (select *, row_number() over (partition by lang, phrase order by score, k) as low from scores),
inner_phrases as (select lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from candidates where m = 3),
dropped as (select distinct s.lang, s.phrase from candidates s join inner_phrases t using (lang, phrase) where 100 * t.f >= 50 * s.f),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from (from lowest where low = 1) anti join dropped using (lang, phrase)),
solid as (select lang, phrase as edge, array_to_string(w[1:2], ' ') as start, array_to_string(w[2:3], ' ') as stop
  from candidates where m = 3),
ways_in as (select lang, stop as node, min(edge) as edge from solid group by all having count(*) = 1),
ways_out as (select lang, start as node, min(edge) as edge from solid group by all having count(*) = 1),
links as (select i.lang, i.edge as before, o.edge as after from ways_in i join ways_out o
  on i.lang = o.lang and i.node = o.node and i.edge <> o.edge),
shown as (select lang, phrase from ranked where rank <= 2000 and m = 3),
forward as (select lang, phrase, phrase as edge from shown
  union select f.lang, f.phrase, l.after from forward f join links l on l.lang = f.lang and l.before = f.edge),
backward as (select lang, phrase, phrase as edge from shown
  union select f.lang, f.phrase, l.before from backward f join links l on l.lang = f.lang and l.after = f.edge),
path as (select lang, phrase, count(distinct edge) + 2 as path_words
  from (select * from forward union all select * from backward) group by all)
select r.lang, r.rank::bigint as rank, r.phrase, r.a::bigint as a, r.l::bigint as l, r.r::bigint as r, t.n::bigint as n,
  r.score::bigint as score, coalesce(p.path_words, r.m)::bigint as path_words
from ranked r join totals t on t.lang = r.lang left join path p on p.lang = r.lang and p.phrase = r.phrase
where r.rank <= 2000
"""

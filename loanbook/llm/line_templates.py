"""Line dedup by a log-template tree.

Lines are parsed by a tree of fixed depth: by number of tokens, then by leading
tokens. Tokens that hold a digit are variable fields from the start. In the
leaves, a token stays constant if enough unrelated documents have it at its
place; other tokens become variable fields too. Lines with equal constant tokens
share a template, and templates that recur across documents are dropped from
all of them.

Whole copies of a document share every line without any of it being boilerplate;
they are left to document dedup. So it is unrelated documents that are counted.
A text is sketched by the ``SKETCH`` smallest hashes of its pieces (some words in
a row), with the line each lies in. Texts that share such a hash follow the one
of smallest id; a text that follows another by a fifth of its hashes belongs to
that one's family, any other founds its own. So equal texts and near copies have
one family between them. For each line the hashes that lie in it have no say: a
line never tells where it belongs. Texts that are little else than a line count
as one family there.

A template recurs if enough families have it, however many documents there are:
three, or the square root of the number of different texts, as some of very many
near copies have nothing else in common by chance. A line of few tokens
needs many more; it is compared whole and takes no part in the tree.

Only DataFrame functions are used. A text is parsed into one row of line keys;
families are found per text, and what is shuffled of a line is its key and its
family, once for each of them. All that joins back to the texts is a list of line
keys for each distinct text with anything to drop.

Defined results: a null text stays null, an empty one empty; line breaks between
kept lines stay as they are, and a text whose lines are all dropped becomes
empty; repeated rows are treated alike; a very long text is one row while it is
parsed, some times its size; an empty table gives no rows. All other columns are
kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, staged

#: Shorter lines take no part in the tree.
LEAST_TOKENS = 5
#: Leading tokens the tree branches on below the number of tokens.
LEADING = 3
#: Families that must share a template, or a token at its place in a leaf, and
#: families that must share a short line.
LEAST_FAMILIES = 3
SHORT_FAMILIES = 50
#: Hashes that describe a text, the share of them that must lie outside of a line
#: to tell its family, and the share of those by which a text follows another.
SKETCH = 24
OUTSIDE = 0.2
FOLLOW = 0.2
#: A hash holds the number of its line in its lowest bits; lines from the last
#: number on share it.
LINE_BITS = 12
#: Lines are cut behind words that end so; shorter pieces tell nothing.
_CUT = "[.!?;yr] "
PIECE_CHARS = 20
#: Share of constant tokens that makes lines of a leaf similar.
SIMILAR = 0.7
VARIABLE = "<*>"

_SPACE = r"[ \t\x0B\f\r]{2,}|[\t\x0B\f\r]"
#: A token with a digit, matched from its start on and without backtracking.
_DIGITS = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def line_parts(text: Column) -> Column:
    return F.split(text, "\n", -1)


def masked(line: Column) -> Column:
    """A line with single spaces, and a mark for each token that holds a digit.
    Most lines need neither, and plain searches find that out fast."""
    spaced = F.contains(line, F.lit("  "))
    for space in "\t\x0b\f\r":
        spaced |= F.contains(line, F.lit(space))
    single = F.when(spaced, F.regexp_replace(line, _SPACE, " ")).otherwise(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(F.trim(single), _DIGITS, VARIABLE)).otherwise(F.trim(single))


def piece_hashes(line: Column, at: Column) -> Column:
    """Hashes of the long pieces of a line, with the line's number."""
    number = F.least(at, F.lit((1 << LINE_BITS) - 1)).cast("long")
    long = F.filter(F.split(line, _CUT), lambda piece: F.length(piece) >= PIECE_CHARS)
    return F.transform(long, lambda piece: F.xxhash64(piece).bitwiseAND(F.lit(-1 << LINE_BITS)).bitwiseOR(number))


def piece_of(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(-1 << LINE_BITS))


def line_of(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int")


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _let(value: Column, result: Callable[[Column], Column]) -> Column:
    """A result of a value that is worked out once."""
    return F.get(F.transform(F.array(value), result), F.lit(0))


def n_tokens(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("int")


def masked_lines(text: Column) -> Column:
    """The distinct lines of a text, masked, without empty ones."""
    lines = F.transform(line_parts(text), masked)
    return F.array_distinct(F.filter(lines, lambda line: line != ""))


def parsed_texts(docs: DataFrame) -> DataFrame:
    """One row per document with lines: ``text_id``, its ``lines`` (key, leaf and
    number of tokens), and its ``sketch``."""

    def line_row(line: Column) -> Column:
        def row(tokens: Column) -> Column:
            leaf = F.xxhash64(tokens, F.substring_index(line, " ", LEADING))
            return F.struct(_key(line).alias("key"), leaf.alias("leaf"), tokens.alias("tokens"))

        return _let(n_tokens(line), row)

    def told(lines: Column) -> Column:
        pieces = F.array_distinct(F.flatten(F.transform(lines, piece_hashes)))
        return F.struct(F.transform(lines, line_row).alias("lines"), F.slice(F.sort_array(pieces), 1, SKETCH).alias("sketch"))

    texts = docs.where(F.col("text").isNotNull()).select(
        F.xxhash64("text").alias("text_id"), _let(masked_lines(F.col("text")), told).alias("told")
    )
    return texts.select("text_id", "told.lines", "told.sketch")


def followed(text_id: Column, votes: Column) -> Column:
    """The text that most votes follow, of equal ones the largest id, if enough
    do; else the text itself."""
    others = F.filter(votes, lambda leader: leader != text_id)
    number = lambda leader: F.size(F.filter(votes, lambda other: other == leader))
    counted = F.transform(F.array_distinct(others), lambda leader: F.struct(number(leader), leader.alias("leader")))
    enough = lambda most: F.when(most["col1"] >= FOLLOW * F.size(votes), most["leader"])
    return F.coalesce(_let(F.array_max(counted), enough), text_id)


def lines_with_family(texts: DataFrame) -> DataFrame:
    """The lines of different texts, one row each: ``text_id``, ``key``,
    ``leaf``, ``tokens`` and ``family``."""
    texts = staged(texts.dropDuplicates(["text_id"]), "texts")
    values = texts.select("text_id", F.explode(F.array_distinct(F.transform("sketch", piece_of))).alias("hash"))
    leaders = values.groupBy("hash").agg(F.min("text_id").alias("leader"), F.max("text_id").alias("last"))
    shared = values.join(leaders.where("leader < last").drop("last"), "hash")
    # as many entries as a sketch has, at most
    led = shared.groupBy("text_id").agg(F.map_from_entries(F.collect_list(F.struct("hash", "leader"))).alias("led"))
    joined = texts.join(led, "text_id", "left")
    leader = lambda entry: F.coalesce(F.element_at("led", piece_of(entry)), "text_id")
    votes = F.transform("sketch", lambda entry: F.struct(line_of(entry).alias("at"), leader(entry).alias("leader")))
    # lines without a hash in the sketch, most of a long text's, see all votes
    voted = joined.select("text_id", "lines", votes.alias("votes"))
    voted = voted.select("*", followed(F.col("text_id"), F.col("votes.leader")).alias("whole"))

    def family(line: Column, at: Column) -> Column:
        number = F.least(at, F.lit((1 << LINE_BITS) - 1))
        rest = F.filter("votes", lambda vote: vote["at"] != number)
        told = lambda rest: F.when(
            F.size(rest) >= OUTSIDE * F.size("votes"), followed(F.col("text_id"), rest["leader"])
        ).otherwise(F.xxhash64(line["key"]))
        return F.when(F.array_contains("votes.at", number), _let(rest, told)).otherwise(F.col("whole"))

    row = lambda line, at: F.struct(line["key"], line["leaf"], line["tokens"], family(line, at).alias("family"))
    each = voted.select("text_id", F.explode(F.transform("lines", row)).alias("line"))
    return each.select("text_id", "line.key", "line.leaf", "line.tokens", "line.family")


def recurring(rows: DataFrame, *keys: str, least: int | Column = LEAST_FAMILIES) -> DataFrame:
    """Keys shared by enough families, one row each. ``rows`` may hold how many
    texts each stands for, as ``texts``."""
    number = F.sum("texts") if "texts" in rows.columns else F.count("*")
    shared = rows.groupBy(*keys, "family").agg(number.alias("texts"))
    shared = shared.groupBy(*keys).agg(F.count("*").alias("families"), F.sum("texts").alias("texts"))
    by_chance = F.sqrt("texts")
    return shared.where((F.col("families") >= least) & (F.col("families") >= by_chance)).select(*keys)


def generalised(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Of lines whose leaf is crowded, those whose template with variable fields
    recurs: ``key``, one row each."""
    wanted = staged(rows.groupBy("key", "leaf", "family").agg(F.count("*").alias("texts")), "crowded")
    # one text is enough to read a line from
    holders = rows.groupBy("key").agg(F.min("text_id").alias("holder")).select("holder").distinct()
    holding = docs.join(staged(holders, "holders"), F.xxhash64("text") == F.col("holder"), "left_semi")
    read = holding.select(F.explode(masked_lines(F.col("text"))).alias("line")).select(_key(F.col("line")).alias("key"), "line")
    lines = wanted.select("key", "leaf").distinct().join(read.dropDuplicates(["key"]), "key")
    lines = staged(lines.select("key", "leaf", F.posexplode(F.split("line", " ")).alias("place", "token")), "tokens")
    tokens = lines.join(wanted.select("key", "family", "texts"), "key")
    constant = recurring(tokens, "leaf", "place", "token").withColumn("constant", F.lit(True))
    told = lines.join(constant, ["leaf", "place", "token"], "left")
    field = F.when(F.col("constant"), F.col("token")).otherwise(VARIABLE)
    templates = told.groupBy("key", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("place", field.alias("field")))).alias("fields"),
        (F.count("constant") / F.count("*")).alias("similar"),
    )
    named = templates.where(F.col("similar") >= SIMILAR).select(
        "key", _key(F.concat_ws(" ", F.col("leaf").cast("string"), F.col("fields.field"))).alias("template")
    )
    named = staged(named, "templates")
    found = recurring(wanted.join(named, "key"), "template")
    return named.join(found, "template", "left_semi").select("key")


def recurring_lines(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Keys of all lines whose template recurs across documents."""
    least = F.when(F.col("tokens") < LEAST_TOKENS, SHORT_FAMILIES).otherwise(LEAST_FAMILIES)
    equal = staged(recurring(rows, "key", "tokens", least=least).select("key"), "recurring")
    open_rows = rows.where(F.col("tokens") >= LEAST_TOKENS).join(equal, "key", "left_anti")
    crowded = staged(recurring(open_rows, "leaf"), "leaves")
    return equal.union(generalised(docs, open_rows.join(crowded, "leaf", "left_semi")))


def _cleaned(docs: DataFrame) -> DataFrame:
    """The documents (``row``) with their ``text`` less the lines of recurring
    templates, and with ``n_lines`` and ``n_dropped``."""
    others = [F.col(f"`{name}`") for name in docs.columns if name != "text"]
    whole = F.struct(*others, F.lit(None).cast("boolean").alias("text"))
    typed = docs.select(whole.alias("row"), F.col("text").cast("string").alias("text"))
    rows = staged(lines_with_family(parsed_texts(typed)), "lines")
    drop = staged(recurring_lines(typed, rows), "dropped")
    # at most the lines of one text each, and both sides of the join are stored
    held = rows.select("text_id", "key").join(drop, "key", "left_semi")
    per_text = held.groupBy("text_id").agg(F.collect_set("key").alias("drop"))
    per_text = staged(per_text.withColumnRenamed("text_id", "dropped_from"), "drops")
    # the lists grow with the documents: they meet by a shuffle at every size
    joined = typed.join(per_text.hint("merge"), F.xxhash64("text") == F.col("dropped_from"), "left")
    parts = line_parts(F.col("text"))
    left = F.filter(parts, lambda line: ~F.array_contains("drop", _key(masked(line))))
    changed = F.col("drop").isNotNull()
    rows = joined.withColumn("left", F.when(changed, left))
    return rows.select(
        "row",
        F.when(changed, F.array_join("left", "\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.coalesce(F.size(parts), F.lit(0))).cast("long").alias("n_lines"),
        F.when(changed, F.size(parts) - F.size("left")).otherwise(0).cast("long").alias("n_dropped"),
    )


def _with_text(docs: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    return [
        F.col("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in docs.columns if name not in without
    ]


def without_templates(docs: DataFrame) -> DataFrame:
    """The documents without the lines of recurring templates, in the columns
    they came in."""
    return _cleaned(docs).select(*_with_text(docs))


def with_dropped(docs: DataFrame) -> DataFrame:
    """The same with ``n_lines`` and ``n_dropped``; columns of these names that
    the documents had give way."""
    return _cleaned(docs).select(*_with_text(docs, ("n_lines", "n_dropped")), "n_lines", "n_dropped")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return with_dropped(docs).select("doc_id", "n_lines", "n_dropped", "text")

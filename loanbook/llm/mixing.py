"""Mixing sources to target weights by weighted sampling without replacement.

Each source gets a token budget. Whole epochs of it come first; the rest of the
budget is met by Efraimidis-Spirakis sampling: a document's key is an
exponential variate divided by its quality weight, keys are sorted within the
source, and the documents whose running size stays nearest the budget are taken
once more. Only DataFrame functions are used.

Sorting is dealt over bins of keys: the number of bins grows with a source's
rows, bins are summed first, and only the bin in which a source's budget runs
out is sorted and summed row by row. What comes out is one cut per source, which
then decides every document where it stands. So a source with a third of all
rows is never gathered, and no text is shuffled.

Defined results: a null text has size 0; sources sort by code point, the null
source last; a document's id and text alone decide its variate, so reruns agree
and repeated rows, which tie, are taken or left together; an empty table gives
no rows; a table without words gives targets of 0. Other columns are kept by
``mixed`` and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, staged

# Words, weights of sources in order, share of all sizes, most epochs.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
# Fixed value: characters that lower the quality weight of a text.
NOISE = "0123456789#*$%&|<>{}[]\\^~_=+@"
#: Documents in a bin of keys, about.
BIN_ROWS = 20_000
UNIT = float(2**52)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """From 0.25 for noise alone to 1 for text without digits and symbols."""
    length = F.length(text)
    clean = F.length(F.translate(text, NOISE, ""))
    return F.when(length > 0, F.lit(0.25) + F.lit(0.75) * clean / length).otherwise(F.lit(0.25))


def variate(doc_id: Column, text: Column, seed: int) -> Column:
    """A number between 0 and 1 that the document's id and text alone decide."""
    named = [F.lit(f"{seed}:"), doc_id.cast("string"), F.lit(":"), text]
    digest = F.md5(F.concat(*[F.coalesce(part, F.lit("")) for part in named]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(UNIT)


def with_keys(docs: DataFrame, seed: int) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.withColumns(
        {
            "_size": words_in(text),
            "_source": F.col("source").cast("string"),
            "_key": -F.ln(variate(F.col("doc_id"), text, seed)) / quality(text),
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
        }
    )


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: its rows, size, target and number of bins.

    Filling up by weight until none exceeds its cap equals one level for all
    below their caps: sources are taken in order of cap per weight, and the
    level after k capped ones is what they leave over the weights still open.
    """
    by_source = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_rows"))
    # one row per source, no partition key: sources are few against documents
    in_order = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1)
    weighed = by_source.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * MOST_EPOCHS)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("_cap").over(before), F.lit(0))
    open_weight = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(every) * F.lit(SHARE) - capped) / open_weight
    # the first source in that order that stays below its cap sets the level;
    # counting it and later ones as capped only lowers the level, so it is the highest
    levelled = weighed.withColumn("_level", level).withColumn(
        "_level", F.max(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))).over(every)
    )
    target = F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap")))
    return levelled.select(
        "_source",
        "source_size",
        target.alias("target"),
        F.ceil(F.col("_rows") / BIN_ROWS).alias("_bins"),
    )


def _joined(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's columns. Both sides are read from tables, so
    Spark broadcasts the small one by its size or splits a hot source."""
    named = sources.withColumnRenamed("_source", "_name")
    return rows.join(named, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")


def _bin() -> Column:
    """1 - exp(-key) spreads the keys over the unit, in their order."""
    return F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * F.col("_bins"))


def source_cuts(keyed: DataFrame) -> DataFrame:
    """Per source its size, target, whole epochs, and where its budget runs out:
    bins below ``_cut_bin`` are taken once more, and of that bin what sorts up
    to ``_cut``."""
    targets = staged(source_targets(keyed), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("_epochs", epochs.cast("long")).withColumn(
        "_budget", F.col("target") - F.col("_epochs") * F.col("source_size")
    )
    placed = _joined(keyed.where("_size > 0"), targets).withColumn("_bin", _bin())
    sums = placed.groupBy("_source", "_bin").agg(F.sum("_size").alias("_bin_size"), F.first("_budget").alias("_budget"))
    earlier = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_before", F.coalesce(F.sum("_bin_size").over(earlier), F.lit(0)))
    edge = starts.where("_before < _budget").groupBy("_source").agg(F.max(F.struct("_bin", "_before")).alias("_edge"))
    edge = staged(edge.select("_source", "_edge.*").withColumnRenamed("_bin", "_cut_bin"), "edges")
    # repeated rows tie in every column sorted by, and stand together
    last = _joined(placed, edge).where("_bin = _cut_bin")
    units = last.groupBy("_source", "_key", "_id", "_size").agg(
        F.sum("_size").alias("_unit"), F.first("_before").alias("_before"), F.first("_budget").alias("_budget")
    )
    running = F.sum("_unit").over(
        Window.partitionBy("_source").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # the document across the budget is taken if that is nearer than leaving it
    middle = F.col("_before") + F.col("_running") - F.col("_unit") / F.lit(2.0)
    cuts = units.withColumn("_running", running).where(middle < F.col("_budget"))
    cuts = cuts.groupBy("_source").agg(F.max(F.struct("_key", "_id", "_size")).alias("_cut"))
    return staged(_left(_left(targets, edge), cuts), "cuts")


def _left(rows: DataFrame, sources: DataFrame) -> DataFrame:
    named = sources.withColumnRenamed("_source", "_name")
    return rows.join(named, F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name")


def _with_copies(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    """The rows with ``_copies``, how often the mix takes each."""
    decided = _joined(keyed, cuts)
    inside = F.coalesce(F.struct("_key", "_id", "_size") <= F.col("_cut"), F.lit(False))
    more = (F.col("_size") > 0) & ((_bin() < F.col("_cut_bin")) | ((_bin() == F.col("_cut_bin")) & inside))
    return decided.withColumn("_copies", F.col("_epochs") + F.when(more, 1).otherwise(0))


def taken_by(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    """The rows with ``size``, ``source_size``, ``target``, and ``copies`` and
    ``taken``, how often and with how many words the mix takes each; columns of
    these names that the rows had give way."""
    rows = keyed.drop("source_size", "target")
    taken = (F.col("_copies") * F.col("_size")).cast("long")
    return _with_copies(rows, cuts).withColumns({"size": F.col("_size"), "copies": F.col("_copies"), "taken": taken})


def mixed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The documents the mix takes, each as often as it takes it, in the columns
    they came in."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    keyed = with_keys(docs.select(whole.alias("row"), "doc_id", "text", "source"), seed)
    cuts = source_cuts(staged(keyed.select("_id", "_source", "_size", "_key"), "keys"))
    rows = _with_copies(keyed, cuts.drop("source_size", "target")).where("_copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return rows.select("row", again).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    keyed = with_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source"), seed=1)
    keyed = staged(keyed.select("doc_id", "_id", "_source", "_size", "_key"), "keys")
    return taken_by(keyed, source_cuts(keyed)).select("doc_id", "size", "source_size", "target", "taken")


#: The same mix with one sort per source, for checking.
OP6_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    -ln((('0x' || substr(md5('1:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 13))::bigint::double + 5e-1)
        / 4503599627370496::double)
    / case when length(text) > 0
        then 25e-2::double + 75e-2::double * length(translate(text, '0123456789#*$%&|<>{}[]\^~_=+@', '')) / length(text)
        else 25e-2::double end as key
  from documents),
by_source as (
  select source, sum(size)::bigint as source_size,
    [3, 1, 2][(row_number() over (order by encode(source) nulls last) - 1) % 3 + 1] as weight
  from sized group by source),
levels as (
  select *, (sum(source_size) over () * 15e-1::double - coalesce(sum(source_size * 2) over earlier, 0))
    / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as level
  from by_source
  window earlier as (order by source_size * 2 / weight::double, encode(source) nulls last rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_size, least(source_size * 2::double,
    max(case when level * weight <= source_size * 2 then level end) over () * weight) as target
  from levels),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as epochs from targets),
units as (
  select source, key, doc_id, size, sum(size) as unit from sized where size > 0 group by all),
ends as (
  select *, sum(unit) over (partition by source order by key, doc_id nulls first, size rows unbounded preceding) as running from units)
select d.doc_id, d.size::bigint as size, b.source_size, b.target,
  (d.size * (b.epochs + case when e.running - e.unit / 2e0::double < b.target - b.epochs * b.source_size then 1 else 0 end))::bigint as taken
from sized d join budgets b on d.source is not distinct from b.source
left join ends e on d.source is not distinct from e.source and d.key = e.key and d.doc_id is not distinct from e.doc_id and d.size = e.size
"""

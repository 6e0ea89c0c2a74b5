"""Exact quantiles of columns of any size.

``percentile`` keeps every distinct value in one task. Here a sketch of bounded
size brackets each wanted rank, the rows below and inside the bracket are
counted, and the search goes on strictly inside it. Every round is one plain
aggregation without a shuffle of rows and shrinks the bracket about a
thousandfold; a bracket with few distinct values is resolved by counting them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
BRACKET = 0.0005
FEW_VALUES = 5_000


@dataclass(frozen=True)
class _Search:
    """The value at ``rank`` (from 0) of the ``size`` values strictly between the bounds."""

    column: str
    rank: int
    size: int
    low: float | None = None
    high: float | None = None

    @property
    def value(self) -> Column:
        return F.col(self.column)

    @property
    def window(self) -> tuple:
        return self.column, self.low, self.high

    @property
    def inside(self) -> Column:
        within = self.value.isNotNull()
        if self.low is not None:
            within = within & (self.value > self.low)
        if self.high is not None:
            within = within & (self.value < self.high)
        return within

    @property
    def bracket(self) -> list[float]:
        at = self.rank / max(self.size - 1, 1)
        return [max(at - BRACKET, 0.0), min(at + BRACKET, 1.0)]


def _once(keys: list) -> dict:
    """The place of every different key, so that searches in the same window,
    as both neighbours of a rank mostly are, are worked out once."""
    return {key: place for place, key in enumerate(dict.fromkeys(keys))}


def _measure(rows: DataFrame, searches: list[_Search]) -> list[tuple[int, list[float]]]:
    """Distinct values (estimated) and bracketing values of every search, in one
    job and with one sketch for all searches of a window."""
    places = _once([s.window for s in searches])
    first_of = {s.window: s for s in reversed(searches)}
    shares = {window: list(_once([x for s in searches if s.window == window for x in s.bracket])) for window in places}
    measured = rows.agg(
        *[
            F.struct(
                F.approx_count_distinct(F.when(s.inside, s.value)),
                F.percentile_approx(F.when(s.inside, s.value), shares[window], SKETCH_ACCURACY),
            )
            for window, s in ((window, first_of[window]) for window in places)
        ]
    ).first()

    def of(s: _Search) -> tuple[int, list[float]]:
        distinct, values = measured[places[s.window]]
        at = dict(zip(shares[s.window], values or []))
        return distinct, [at.get(share) for share in s.bracket]

    return [of(s) for s in searches]


def _narrow(rows: DataFrame, searches: list[_Search], brackets: list[list[float]]):
    """Follow each rank to one of: below the bracket, its ends, inside, above."""
    keys = [(s.window, low, high) for s, (low, high) in zip(searches, brackets)]
    places = _once(keys)
    first_of = {key: s for key, s in reversed([*zip(keys, searches)])}
    counts = rows.agg(
        *[
            F.struct(
                F.count_if(first_of[key].inside & (first_of[key].value < key[1])),
                F.count_if(first_of[key].value == key[1]),
                F.count_if((first_of[key].value > key[1]) & (first_of[key].value < key[2])),
                F.count_if(first_of[key].value == key[2]),
            )
            for key in places
        ]
    ).first()
    found, open_searches = {}, {}
    for position, (s, (low, high)) in enumerate(zip(searches, brackets)):
        below, at_low, between, at_high = counts[places[keys[position]]]
        at_high = 0 if low == high else at_high
        if s.rank < below:
            open_searches[position] = replace(s, high=low, size=below)
        elif s.rank < below + at_low:
            found[position] = low
        elif s.rank < below + at_low + between:
            open_searches[position] = replace(
                s, low=low, high=high, rank=s.rank - below - at_low, size=between
            )
        elif s.rank < below + at_low + between + at_high:
            found[position] = high
        else:
            passed = below + at_low + between + at_high
            open_searches[position] = replace(s, low=high, rank=s.rank - passed, size=s.size - passed)
    return found, open_searches


def _count_out(rows: DataFrame, searches: dict[int, _Search]) -> dict[int, float]:
    """Resolve searches with few distinct values by running totals over them;
    the values of all windows are counted in one pass."""
    places = _once([s.window for s in searches.values()])
    first_of = {s.window: s for s in reversed(searches.values())}
    within = [
        F.when(first_of[window].inside, F.struct(F.lit(place).alias("window"), first_of[window].value.alias("value")))
        for window, place in places.items()
    ]
    counted = (
        rows.select(F.inline(F.array_compact(F.array(*within))))
        .groupBy("window", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    totals = F.sum("rows").over(Window.partitionBy("window").orderBy("value"))

    def at(s: _Search) -> Column:
        return F.min(F.when((F.col("window") == places[s.window]) & (F.col("total") > s.rank), F.col("value")))

    found = counted.withColumn("total", totals).agg(*[at(s) for s in searches.values()]).first()
    return dict(zip(searches, found))


def values_at_ranks(rows: DataFrame, wanted: list[tuple[str, int, int]]) -> list[float]:
    """The exact value for each (column, rank from 0, number of values)."""
    pending = {i: _Search(column, rank, size) for i, (column, rank, size) in enumerate(wanted)}
    values: dict[int, float] = {}
    while pending:
        measured = dict(zip(pending, _measure(rows, list(pending.values()))))
        few = {i: s for i, s in pending.items() if measured[i][0] <= FEW_VALUES}
        if few:
            values.update(_count_out(rows, few))
        many = [i for i in pending if i not in few]
        if not many:
            break
        found, still_open = _narrow(
            rows, [pending[i] for i in many], [measured[i][1] for i in many]
        )
        values.update({many[position]: value for position, value in found.items()})
        pending = {many[position]: search for position, search in still_open.items()}
    return [values[i] for i in range(len(wanted))]


def exact_quantiles(
    rows: DataFrame, columns: list[str], shares: list[float]
) -> dict[str, list[float | None]]:
    """Quantiles per column with linear interpolation between neighbours; NULL
    values are left out, a column without values has none."""
    sizes = rows.agg(*[F.count(name).alias(name) for name in columns]).first().asDict()
    filled = [name for name in columns if sizes[name]]
    places = {name: [(sizes[name] - 1) * share for share in shares] for name in filled}
    wanted = sorted(
        {
            (name, rank, sizes[name])
            for name in filled
            for place in places[name]
            for rank in (math.floor(place), math.ceil(place))
        }
    )
    at = {}
    if wanted:
        at = {(name, rank): v for (name, rank, _), v in zip(wanted, values_at_ranks(rows, wanted))}

    def interpolated(name: str, place: float) -> float:
        lower, upper = at[name, math.floor(place)], at[name, math.ceil(place)]
        return lower + (upper - lower) * (place - math.floor(place))

    return {
        name: [interpolated(name, place) for place in places[name]] if name in places else [None] * len(shares)
        for name in columns
    }

"""Licence scans by matching marked-up templates.

A template is the wording of a licence or notice in which optional and
replaceable regions are marked. It is compiled into an automaton over words:
mandatory words must come exactly, one after the other; an optional region may
be passed over; a replaceable one takes any words within its limits, or one of
the wordings it names. A text is accepted where the automaton gets through.

The automaton is not run from every word. Each template has an anchor, mandatory
wording that is looked for by plain search; only around it are words compared.
What a template may begin with but need not is left out when it is matched.

Fixed phrases are counted besides. Scores follow the longest mandatory wording
accepted: m words give m / (m + 2), and a text without labels 0.

Defined results: a null or empty text has no words and no labels; repeated rows
get equal rows; an empty table gives no rows; a very long text is searched whole
as one string of its words, two or three times its size, without an object for
each word. Matches of one template do not overlap; of those that begin alike the
longest counts. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.license_templates import TEMPLATES
from loanbook.llm.texts import documents, text_slices, with_texts

# Phrases with their labels, and the characters words are made of.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
_FOLD = bytearray(range(256))
for _byte in [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]:
    _FOLD[_byte] = ord(" ")
_FOLD[ord("A") : ord("Z") + 1] = bytes(range(ord("a"), ord("z") + 1))
_FOLD = bytes(_FOLD)

#: Words that tell nothing about where a licence stands.
COMMON = frozenset(
    "a an and any are by for from in is it may not of on or the this to under with you"
    " available distributed licensed published released".split()
)
#: Wordings an anchor may have, at most.
ANCHORS = 64


def word_string(text: bytes) -> bytes:
    """The words of a text, each between single spaces."""
    folded = text.translate(_FOLD)
    while b"  " in folded:
        folded = folded.replace(b"  ", b" ")
    folded = folded.strip(b" ")
    return b" " + folded + b" " if folded else b" "


def words_of(text: str) -> list[str]:
    return word_string(text.encode()).decode().split()


# --- templates -------------------------------------------------------------------


@dataclass(frozen=True)
class Choice:
    """One of some wordings; plain mandatory words are a choice of one."""

    wordings: tuple[tuple[str, ...], ...]


@dataclass(frozen=True)
class Replaceable:
    """From ``least`` to ``most`` words of any kind."""

    least: int
    most: int


@dataclass(frozen=True)
class Skippable:
    parts: tuple


_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=\d+-\d+|var;match=[^<>]+)>>")


def parsed(template: str) -> tuple:
    """The parts of a template in their order."""
    open_parts: list[list] = [[]]
    at = 0
    for mark in [*_MARK.finditer(template), None]:
        plain = template[at : mark.start() if mark else len(template)]
        if "<<" in plain or ">>" in plain:
            raise ValueError(f"unknown markup: {plain}")
        if words := words_of(plain):
            open_parts[-1].append(Choice((tuple(words),)))
        if mark is None:
            break
        at, kind = mark.end(), mark.group(1)
        if kind == "beginOptional":
            open_parts.append([])
        elif kind == "endOptional":
            inner = open_parts.pop()
            if not open_parts:
                raise ValueError("endOptional without beginOptional")
            open_parts[-1].append(Skippable(tuple(inner)))
        elif kind.startswith("var;words="):
            open_parts[-1].append(Replaceable(*map(int, kind.removeprefix("var;words=").split("-"))))
        else:
            wordings = kind.removeprefix("var;match=").split("|")
            open_parts[-1].append(Choice(tuple(tuple(words_of(wording)) for wording in wordings)))
    if len(open_parts) > 1:
        raise ValueError("beginOptional without endOptional")
    parts = open_parts[0]
    while parts and not isinstance(parts[0], Choice):
        parts = parts[1:]
    if not parts:
        raise ValueError("a template needs mandatory words")
    return tuple(parts)


def mandatory(parts: tuple) -> int:
    """The fewest mandatory words that are matched."""
    return sum(min(map(len, part.wordings)) for part in parts if isinstance(part, Choice))


def most_words(parts: tuple) -> int:
    """The most words that may be matched."""
    longest = {Choice: lambda p: max(map(len, p.wordings)), Replaceable: lambda p: p.most, Skippable: lambda p: most_words(p.parts)}
    return sum(longest[type(part)](part) for part in parts)


def anchor(parts: tuple) -> tuple[int, list[str]]:
    """Wordings one of which each match holds, and the most words before it: of
    the runs of mandatory parts the one that is least common."""
    best = (-math.inf, 0, [""])
    for first in range(len(parts)):
        wordings: list[tuple[str, ...]] = [()]
        for part in parts[first:]:
            if not isinstance(part, Choice) or len(wordings) * len(part.wordings) > ANCHORS:
                break
            wordings = [before + own for before, own in product(wordings, part.wordings)]
            telling = min(sum(len(word) for word in wording if word not in COMMON) for wording in wordings)
            value = min(telling, 24) - 2 * math.log2(len(wordings))
            if wordings[0] and value > best[0]:
                best = (value, most_words(parts[:first]), sorted(" ".join(wording) for wording in set(wordings)))
    return best[1], best[2]


@dataclass
class Automaton:
    """States and the words that lead between them; state 0 is the first."""

    label: str
    weight: int
    lead: int
    anchors: list[str]
    by_word: list[dict[bytes, list[int]]] = field(default_factory=list)
    by_any: list[list[int]] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    accepted: int = 0

    def state(self) -> int:
        self.by_word.append({})
        self.by_any.append([])
        self.skips.append([])
        return len(self.skips) - 1

    def add(self, parts: tuple, at: int) -> int:
        """The state behind the parts, begun in a state."""
        for part in parts:
            end = self.state()
            if isinstance(part, Choice):
                for wording in part.wordings:
                    here = at
                    for place, word in enumerate(wording):
                        there = end if place == len(wording) - 1 else self.state()
                        self.by_word[here].setdefault(word.encode(), []).append(there)
                        here = there
            elif isinstance(part, Replaceable):
                here = at
                for place in range(part.most + 1):
                    if place >= part.least:
                        self.skips[here].append(end)
                    if place < part.most:
                        there = self.state()
                        self.by_any[here].append(there)
                        here = there
            else:
                self.skips[at].append(end)
                self.skips[self.add(part.parts, at)].append(end)
            at = end
        return at

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        """The states with those that no word is needed for."""
        found, waiting = set(), list(states)
        while waiting:
            state = waiting.pop()
            if state not in found:
                found.add(state)
                waiting += self.skips[state]
        return frozenset(found)

    def accepts(self, string: bytes, at: int) -> int | None:
        """Where the longest match ends that begins with the word after the
        space at a place: the place of the space behind its last word."""
        states, end = self.closed([0]), None
        while states:
            if self.accepted in states:
                end = at
            stop = string.find(b" ", at + 1)
            if stop < 0:
                break
            word = string[at + 1 : stop]
            after = [there for state in states for there in self.by_word[state].get(word, ())]
            after += [there for state in states for there in self.by_any[state]]
            states, at = self.closed(after), stop
        return end


def compiled(label: str, template: str) -> Automaton:
    parts = parsed(template)
    lead, anchors = anchor(parts)
    automaton = Automaton(label, mandatory(parts), lead, anchors)
    automaton.accepted = automaton.add(parts, automaton.state())
    return automaton


# --- scans -----------------------------------------------------------------------


class Places:
    """Numbers of words by the place of the space before them; places ascend."""

    def __init__(self, string: bytes):
        self.string, self.at, self.number = string, 0, 0

    def word(self, at: int) -> int:
        if at < self.at:
            self.at, self.number = 0, 0
        self.number += self.string.count(b" ", self.at, at)
        self.at = at
        return self.number


def occurrences(string: bytes, wording: bytes) -> Iterator[int]:
    """The places of the spaces before a wording."""
    at = string.find(wording)
    while at >= 0:
        yield at
        # the space behind it may be that before the next
        at = string.find(wording, at + 1)


def phrase_places(string: bytes) -> list[tuple[str, int]]:
    """Labels and first words of the fixed phrases."""
    found = []
    for phrase, label in PHRASES:
        places = Places(string)
        found += [(label, places.word(at)) for at in occurrences(string, b" " + phrase.encode() + b" ")]
    return found


def template_matches(string: bytes, automata: list[Automaton]) -> list[tuple[str, int, int, int]]:
    """Label, first word, word behind the last, and mandatory words of what the
    templates accept."""
    found = []
    for automaton in automata:
        anchors = sorted({at for wording in automaton.anchors for at in occurrences(string, b" " + wording.encode() + b" ")})
        if not anchors:
            continue
        places, tried, ended = Places(string), -1, 0
        for place in anchors:
            # the first words of a match stand so many words before the anchor at most
            starts, at = [place], place
            for _ in range(automaton.lead):
                at = string.rfind(b" ", 0, at)
                if at < 0 or at <= tried:
                    break
                starts.append(at)
            for start in reversed(starts):
                if start < ended or start <= tried:
                    continue
                tried = start
                end = automaton.accepts(string, start)
                if end is not None:
                    found.append((automaton.label, places.word(start), places.word(end), automaton.weight))
                    ended = end
    return found


SCAN_SCHEMA = (
    "doc_id long, n_words long, phrases array<struct<label:string,start:long>>, "
    "matches array<struct<label:string,start:long,end:long,weight:long>>"
)
_PHRASE = pa.struct([("label", pa.string()), ("start", pa.int64())])
_MATCH = pa.struct([*_PHRASE, ("end", pa.int64()), ("weight", pa.int64())])


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per document its number of words, the places of the fixed ``phrases``, and
    the ``matches`` of templates with label, first word, the word behind the
    last, and how many mandatory words the template has."""
    automata = [compiled(label, template) for label, template in templates]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            numbers, phrases, matches = [], [], []
            for text in texts:
                string = word_string(text or b"")
                numbers.append(string.count(b" ") - 1)
                phrases.append([{"label": label, "start": start} for label, start in phrase_places(string)])
                keys = ("label", "start", "end", "weight")
                matches.append([dict(zip(keys, match)) for match in template_matches(string, automata)])
            columns = [pa.array(numbers, pa.int64()), pa.array(phrases, pa.list_(_PHRASE)), pa.array(matches, pa.list_(_MATCH))]
            yield pa.RecordBatch.from_arrays([rows.column(0), *columns], names=["doc_id", "n_words", "phrases", "matches"])

    return with_texts(docs).mapInArrow(search, SCAN_SCHEMA)


def _labels(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op12_template_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    lengths = F.create_map(*[F.lit(x) for phrase, label in PHRASES for x in (label, len(phrase.split()))])
    weights = F.concat(
        F.transform("phrases", lambda p: F.element_at(lengths, p["label"]).cast("long")), F.col("matches.weight")
    )
    most = F.coalesce(F.array_max(weights), F.lit(0)).cast("double")
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"),
        _labels(F.col("phrases.label")).alias("base_labels"),
        _labels(F.concat("phrases.label", "matches.label")).alias("labels"),
        (most / (most + 2)).alias("score"),
    )


# --- checking SQL ----------------------------------------------------------------


def pattern(parts: tuple) -> str:
    """The parts as a regular expression over words each followed by a space."""
    told = {
        Choice: lambda p: "(?:" + "|".join("".join(f"{word} " for word in wording) for wording in p.wordings) + ")",
        Replaceable: lambda p: f"(?:[^ ]+ ){{{p.least},{p.most}}}",
        Skippable: lambda p: f"(?:{pattern(p.parts)})?",
    }
    return "".join(told[type(part)](part) for part in parts)


def _sql() -> str:
    """The same with words in rows, and templates as regular expressions."""
    # fixed wording without quotes: it goes into SQL texts as it is
    tried = ",\n".join(
        f"    ('{label}', {mandatory(parts)}, ' {pattern(parts)}')" for label, parts in ((x, parsed(y)) for x, y in TEMPLATES)
    )
    starts = "\n    union all ".join(
        f"select rid, '{label}' as label, {len(phrase.split())} as weight, i from words where "
        + " and ".join(f"{column} = '{word}'" for column, word in zip(["w", "w1", "w2", "w3"], phrase.split()))
        for phrase, label in PHRASES
    )
    return rf"""
with docs as materialized (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
words as materialized (
  select rid, i - 1 as i, ws[i] as w, ws[i + 1] as w1, ws[i + 2] as w2, ws[i + 3] as w3
  from (select rid, ws, unnest(range(1, len(ws) + 1)) as i from docs)),
base as (
    {starts}),
templates(label, weight, wording) as (values
{tried}),
matches as (
  select rid, t.label, t.weight
  from (select rid, ' ' || array_to_string(ws, ' ') || ' ' as string from docs) d, templates t
  where regexp_matches(string, wording)),
base_by_doc as (
  select rid, count(*) as n_base, min(i) as first_word, max(i) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels from base group by rid),
all_by_doc as (
  select rid, string_agg(distinct label, ',' order by label) as labels, max(weight)::double as most
  from (select rid, label, weight from base union all select * from matches) group by rid)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(b.n_base, 0)::bigint as n_base, b.first_word::bigint as first_word,
  b.last_word::bigint as last_word, coalesce(b.base_labels, '') as base_labels, coalesce(a.labels, '') as labels,
  coalesce(a.most / (a.most + 2), 0::double) as score
from docs d left join base_by_doc b using (rid) left join all_by_doc a using (rid)
"""


OP12_SQL = _sql()

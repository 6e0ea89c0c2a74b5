"""Licence templates against a plain matcher and against regular expressions."""

import random
import re

import pytest

from loanbook.llm import template_markup as markup
from tests.llm.cases import documents


def matches_at(parts, words, at):
    """All places behind a match that begins at a word, by trying everything."""
    if not parts:
        return {at}
    part, rest = parts[0], parts[1:]
    if isinstance(part, markup.Choice):
        after = {at + len(w) for w in part.wordings if tuple(words[at : at + len(w)]) == w}
    elif isinstance(part, markup.Replaceable):
        after = {at + n for n in range(part.least, part.most + 1) if at + n <= len(words)}
    else:
        after = {at} | matches_at(part.parts, words, at)
    return {end for place in after for end in matches_at(rest, words, place)}


def plain_matches(parts, words):
    found, at = [], 0
    while at < len(words):
        ends = matches_at(parts, words, at)
        if ends:
            found.append((at, max(ends)))
            at = max(ends)
        else:
            at += 1
    return found


TEMPLATES = [
    "a b <<var;words=1-3>> c",
    "<<beginOptional>>x<<endOptional>> a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> e",
    "<<var;match=a b|a|c d e>> <<var;match=d|e f>> b",
    "<<var;words=0-2>> d <<var;words=0-2>> a <<var;words=2-2>> b <<beginOptional>>a b<<endOptional>>",
    "a a <<beginOptional>>a<<endOptional>> b",
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_automata_equal_trying_everything(template):
    rng = random.Random(template)
    parts, automaton = markup.parsed(template), markup.compiled("it", template)
    hits = 0
    for _ in range(400):
        words = rng.choices("abcdefx", [6, 6, 3, 3, 3, 1, 2], k=rng.randint(0, 25))
        string = markup.word_string(" ".join(words).encode())
        found = [(start, end) for _, start, end, _ in markup.template_matches(string, [automaton])]
        assert found == plain_matches(parts, words), words
        assert bool(found) == bool(re.search(" " + markup.pattern(parts), string.decode()))
        hits += len(found)
    assert hits > 20


def filled(parts, rng):
    words = []
    for part in parts:
        if isinstance(part, markup.Choice):
            words += rng.choice(part.wordings)
        elif isinstance(part, markup.Replaceable):
            words += [f"any{rng.randint(0, 9)}" for _ in range(rng.randint(part.least, part.most))]
        elif rng.random() < 0.5:
            words += filled(part.parts, rng)
    return words


def test_every_template_accepts_its_wording_and_nothing_else():
    rng = random.Random(2)
    automata = [markup.compiled(label, template) for label, template in markup.TEMPLATES]
    for (label, template), automaton in zip(markup.TEMPLATES, automata):
        for _ in range(5):
            words = filled(markup.parsed(template), rng)
            text = "Before it. " + " ".join(w.upper() if rng.random() < 0.3 else w + rng.choice(["", ",", "\n", " --"]) for w in words)
            assert label in {found[0] for found in markup.template_matches(markup.word_string(text.encode()), automata)}
            assert markup.mandatory(markup.parsed(template)) == automaton.weight <= len(words)
        if automaton.weight == len(filled(markup.parsed(template), random.Random(0))):
            changed = [word if i != len(words) // 2 else "changed" for i, word in enumerate(words)]
            assert not markup.template_matches(markup.word_string(" ".join(changed).encode()), [automaton])


def test_plain_prose_has_no_labels():
    text = "She had a licence to fly. All rights of way are reserved for walkers; permission to enter is granted by MIT staff."
    automata = [markup.compiled(label, template) for label, template in markup.TEMPLATES]
    assert markup.template_matches(markup.word_string(text.encode()), automata) == []


def test_unknown_markup_is_an_error():
    for template in ("a <<what>> b", "a <<beginOptional>> b", "a <<endOptional>> b", "<<var;words=1-2>>", ""):
        with pytest.raises(ValueError):
            markup.parsed(template)


def test_places_labels_and_scores(spark, tmp_path):
    texts = [
        "Licensed under CC BY-NC 4.0.",
        "mit license MIT-License\nthe GNU General Public License, version 3",
        "This work is licensed under the GNU General Public License, version 3.",
        "gnu general public licence",
        "Mït license é mit license",
        None,
        "",
        "mit licens",
        "mit license " * 20_000,
    ]
    rows = [(i, text, "clash", 1) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, label string, phrases int").write.parquet(str(tmp_path / "documents.parquet"))
    told = {row.doc_id: tuple(row)[1:] for row in markup.op12_template_markup(spark, str(tmp_path)).collect()}
    assert told[0] == (7, 1, 2, 2, "cc-by", "CC-BY-NC-4.0,cc-by", 6 / 8)
    assert told[1] == (11, 3, 0, 5, "gpl,mit", "gpl,mit", 4 / 6)
    assert told[2] == (12, 1, 6, 6, "gpl", "GPL-3.0,gpl", 8 / 10)
    assert told[3] == (4, 0, None, None, "", "", 0.0)
    assert told[4] == (5, 1, 3, 3, "mit", "mit", 0.5)
    assert told[5] == told[6] == (0, 0, None, None, "", "", 0.0)
    assert told[7] == (2, 0, None, None, "", "", 0.0)
    assert told[8] == (40_000, 20_000, 0, 39_998, "mit", "mit", 0.5)


def test_odd_tables(spark):
    docs = documents(spark)
    assert markup.scan(docs).count() == docs.count()
    assert markup.scan(docs.limit(0)).count() == 0

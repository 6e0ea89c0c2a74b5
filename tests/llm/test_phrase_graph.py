"""Phrase collocations against counting every phrase in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from loanbook.llm import phrase_graph
from tests.llm.cases import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest):
    """Counts of phrases by language, and of all words."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    counts["und" if lang is None else lang, tuple(words[at : at + size])] += 1
    return counts, totals


def expected(rows, longest, least, top, percent=50):
    counts, totals = counted(rows, longest)
    candidates = {key: n for key, n in counts.items() if len(key[1]) >= 2 and n >= least}
    by_lang = {}
    for (lang, words), a in candidates.items():
        if any(
            other == lang and len(longer) > len(words) and 100 * n >= percent * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), n in candidates.items()
        ):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, own in by_lang.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1)
    }


def made_up(seed, texts=300):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "café", "x\x0by", "a", "b", "ÄB", " ", "12"]
    rows = []
    for _ in range(texts):
        words = rng.choices(vocabulary, [9, 7, 3, 3, 2, 2, 5, 5, 1, 1, 1], k=rng.randint(0, 40))
        text = "".join(word + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for word in words)
        rows.append((rng.choice(["en", "de", None]), text))
    return [*rows, ("en", None), ("de", ""), (None, " .,\n"), ("fr", "too seldom to count")]


@pytest.mark.parametrize("longest, least, top", [(3, 10, 2000), (3, 3, 7), (2, 5, 50), (5, 2, 400)])
def test_equals_counting_every_phrase(spark, monkeypatch, longest, least, top):
    monkeypatch.setattr(phrase_graph, "COUNTED", 500)
    rows = made_up(longest)
    docs = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string")
    phrases = phrase_graph.solid_phrases(docs, longest, least)
    found = phrase_graph.collocations(phrases, top).drop("words").collect()
    assert {tuple(row) for row in found} == expected(rows, longest, least, top)
    counts, totals = counted(rows, longest)
    told = {(row.lang, row.phrase): row.n for row in phrases.collect()}
    assert told == {(lang, " ".join(words)): n for (lang, words), n in counts.items() if n >= least} | {
        (lang, ""): n for lang, n in totals.items() if n
    }


def test_edges_of_many_words_are_renumbered():
    """Products of codes beyond 64 bits."""
    rng = np.random.default_rng(3)
    words = phrase_graph.Codes()
    text = [f"w{i}".encode() for i in rng.integers(0, 40, 3000)] + [b"\xff"]
    codes = np.array([words[word] for word in text])
    for i in range(3_000_000):
        words[i] = len(words)  # numbers that no word of the text has
    words = dict(zip([str(word).encode() if isinstance(word, int) else word for word in words], words.values()))
    phrases, counts = phrase_graph.counted_edges(codes, words, 4)
    found = dict(zip(phrases.to_pylist(), counts.tolist()))
    plain = [word.decode() for word in text[:-1]]
    want = Counter(" ".join(plain[i : i + 4]) for i in range(len(plain)))
    assert found == want


def test_exact_scores_of_counts_beyond_64_bits(spark):
    a, left, right = 9 * 10**13 + 7, 10**14 + 3, 3 * 10**14 + 1
    frame = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    from pyspark.sql import functions as F

    found = frame.select(phrase_graph.exact_score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert found == 1_000_000 * a * a // (left * right)


def compacted(spark, edges, longest=3):
    rows = [("en", longest, edge, n) for edge, n in edges.items()] + [("de", longest, edge, n) for edge, n in edges.items()]
    phrases = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    found = phrase_graph.paths(phrase_graph.unary_paths(phrases, longest)).collect()
    by_lang = {lang: {row.path: (row.words, row.n) for row in found if row.lang == lang} for lang in ("en", "de")}
    assert by_lang["en"] == by_lang["de"]
    return by_lang["en"]


def test_unary_paths_are_compacted(spark):
    long = [f"w{i}" for i in range(40)]
    edges = {" ".join(long[i : i + 3]): 10 + i % 4 for i in range(38)}
    # a branch, a cycle of five words, and a word that follows itself
    edges |= {"a b c": 12, "b c d": 6, "b c e": 6, "c e f": 6}
    ring = ["r0", "r1", "r2", "r3", "r4"]
    edges |= {" ".join(ring[(i + k) % 5] for k in range(3)): 20 for i in range(5)}
    edges |= {"ha ha ha": 30}
    assert compacted(spark, edges) == {
        " ".join(long): (40, 10),
        "a b c": (3, 12),
        "b c d": (3, 6),
        "b c e f": (4, 6),
        "r0 r1 r2 r3 r4 r0 r1": (7, 20),
        "ha ha ha": (3, 30),
    }


def test_odd_tables(spark):
    docs = documents(spark)
    phrases = phrase_graph.solid_phrases(docs, 3, 2)
    assert {row.lang for row in phrases.collect()} == {"en", "de", "und"}
    empty = phrase_graph.solid_phrases(docs.limit(0))
    assert phrase_graph.collocations(empty, 5).count() == 0
    assert phrase_graph.paths(phrase_graph.unary_paths(empty)).count() == 0

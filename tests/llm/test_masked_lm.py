"""The language model learns every position and knows every word of the corpus."""

import random
import zlib

import numpy as np
import pytest

from loanbook.llm import masked_lm


def scores(docs, **options):
    return {row.doc_id: row for row in masked_lm.masked_scores(docs, **options).collect()}


def test_every_position_is_learned_in_one_round():
    for length, rounds in ((0, 2), (1, 2), (1001, 2), (50, 3)):
        places = [masked_lm.places_of_round(number, rounds, length) for number in range(rounds)]
        assert sorted(np.concatenate(places).tolist()) == list(range(length))


def test_rounds_learn_from_every_token(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "one two three " * i) for i in range(20)], "doc_id long, text string")
    slices = masked_lm.staged(masked_lm.encoded(docs), "codes")
    # a step that only counts what it is given
    monkeypatch.setattr(masked_lm, "descend", lambda flat, power, target, context: flat.__setitem__(0, flat[0] + len(target)))
    classes, seen = masked_lm.Classes([], 0), 0
    for number in range(2):
        frames = slices.coalesce(1)
        seen += masked_lm.trained_round(frames, classes, np.zeros(masked_lm.SIZE, np.float32), number, 2)[0]
    assert seen == 3 * sum(range(20))


def test_words_of_one_ending_are_told_apart(spark):
    """Neither word is among the frequent ones; both belong to one class."""
    frequent = " ".join(f"common{i}" for i in range(masked_lm.WORDS))
    rows = [(0, "common1 common2 staring common3 common4"), (1, "common1 common2 slaring common3 common4")]
    rows += [(i, f"{frequent} {frequent} {frequent} {frequent}") for i in range(2, 52)]
    rows += [(i, f"u{i} v{i} staring w{i} x{i}") for i in range(52, 92)]
    found = scores(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found[0].log_likelihood > found[1].log_likelihood + 1


def test_documents_that_occur_twice_score_apart(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000 + i, texts[i]) for i in range(30)]
    found = scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    once = max(found[i].per_token for i in range(30, 300))
    assert all(found[i].per_token == pytest.approx(found[1000 + i].per_token) for i in range(30))
    assert min(found[i].per_token for i in range(30)) > once + 1


def test_counts_of_the_corpus_by_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcde", k=rng.randrange(9))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(masked_lm, "SLICE_TOKENS", 20)
    slices = masked_lm.staged(masked_lm.encoded(docs), "codes")
    sheaves = masked_lm.word_sheaves(slices, 2).unionByName(masked_lm.phrase_sheaves(slices, 2))
    totals = masked_lm.corpus_totals(sheaves).collect()
    got: dict = {}
    for sheaf in sheaves.collect():
        row = next(row for row in totals if (row.slice, row.part, row.kind) == (sheaf.slice, sheaf.part, sheaf.kind))
        high = np.cumsum(masked_lm.unpacked(sheaf.steps, sheaf["size"], np.uint32), dtype=np.uint32).tolist()
        read = lambda data: masked_lm.unpacked(data, sheaf["size"], np.float32).tolist()
        if sheaf.kind == masked_lm.WORD:
            found = [((0, sheaf.part, key), n) for key, n in zip(high, read(row.totals))]
        else:
            low = masked_lm.unpacked(sheaf.low, sheaf["size"], np.uint16).tolist()
            found = [((1, sheaf.part, *key), n) for key, n in zip(zip(high, low), read(row.totals))]
            found += [((2, sheaf.part, key), n) for key, n in zip(high, read(row.around))]
        assert all(got.setdefault(key, n) == n for key, n in found)
    expected: dict = {}
    for text in texts:
        padded = ["", *text.split(), ""]
        for before, word, after in zip(padded, padded[1:], padded[2:]):
            for key in ((word,), (before, word, after), (before, None, after)):
                expected[key] = expected.get(key, 0) + 1
    assert sorted(got.values()) == pytest.approx(sorted(expected.values()))


def test_classes_are_the_most_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "SLICE_TOKENS", 50)
    texts = [f"w{i} " * (i + 1) + "rest" for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    slices = masked_lm.staged(masked_lm.encoded(docs), "codes")
    assert masked_lm.token_count(slices) == sum(range(121)) + 120
    totals = masked_lm.corpus_totals(masked_lm.word_sheaves(slices, 2))
    leaders = totals.selectExpr("inline(leaders)").orderBy("n", ascending=False).limit(masked_lm.WORDS).collect()
    assert [row.n for row in leaders] == [120, 120, *range(119, 26, -1)]
    classes = masked_lm.Classes([row.key for row in leaders], 2)
    places = masked_lm.Places()
    for word in ("rest", "w119", "w118", "w27", "w26", "w25"):
        places[word.encode()]
    found = classes.of(np.array(places.tokens, dtype=np.uint64)).tolist()
    assert sorted(found[:2]) == [0, 1] and found[2:5] == [2, 93, 94]
    assert found[5] == masked_lm.WORDS + zlib.crc32(b"w25") % masked_lm.ENDINGS
    counts = masked_lm.class_counts(slices, classes)
    assert counts[:3].tolist() == [120, 120, 119] and counts.sum() == sum(range(121)) + 120


def test_scores_do_not_depend_on_slices(spark, monkeypatch):
    rows = [(i, f"a b{i % 7} c d{i % 3} e") for i in range(60)] + [(None, None), (None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = masked_lm.masked_scores(docs.coalesce(1), rounds=0).collect()
    cut = masked_lm.masked_scores(docs.repartition(7), rounds=0).collect()
    name = lambda row: (row.doc_id is None, row.doc_id or 0, row.n_tokens)
    for one, other in zip(sorted(whole, key=name), sorted(cut, key=name), strict=True):
        assert name(one) == name(other) and one.log_likelihood == pytest.approx(other.log_likelihood)

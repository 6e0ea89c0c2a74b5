"""Bounds, repeated rows, clashing names, noise and special tokens."""

import random
import tracemalloc

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from loanbook.llm import language_ppm, line_templates, minmax_dedup, mixing, packing, quality_forest, tokens
from loanbook.llm.texts import staged
from loanbook.llm.tokens import tokenizer_path
from tests.llm.cases import linked_components
from tests.llm.test_corpus_operators import prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def english(rng, words=60):
    vocabulary = "the people of this small town like to read old books in the garden while others work or sleep all day".split()
    return " ".join(rng.choices(vocabulary, k=words))


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(1)
    a, b, c = english(rng), english(rng), english(rng)
    rows = [(3, a), (3, a), (3, a), (5, b), (None, b), (None, c), (None, c), (7, a + " and"), (8, None), (9, ""), (9, "")]
    kept = minmax_dedup.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # rows without words are linked with nothing
    assert sorted(kept, key=str) == sorted([(3, a), (5, b), (None, c), (8, None), (9, ""), (9, "")], key=str)


def test_one_id_with_two_texts_gives_every_link(spark):
    rng = random.Random(2)
    a, b = english(rng, 80), english(rng, 80)
    rows = [(3, a), (3, b), (10, a + " end"), (11, b + " end"), (12, english(rng, 80))]
    for _ in range(2):
        found = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
        assert sorted((row.doc_id, row.component_id) for row in found) == [(3, 3), (3, 3), (10, 3), (11, 3), (12, 12)]


def test_columns_of_any_name_come_through(spark):
    rng = random.Random(3)
    names = ["_copy", "_drop", "_left", "_size", "_copies", "_source", "row", "drop", "left", "line", "key", "size", "component", "number"]
    rows = [(i, "\n".join(prose(rng, 4)), "en", f"s{i % 3}", 0, *range(90, 90 + len(names))) for i in range(30)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, frame, "")
        assert kept.dtypes == frame.dtypes, name
        assert {tuple(row)[5:] for row in kept.collect()} == {tuple(range(90, 90 + len(names)))}, name


def test_noise_goes_and_nothing_goes_without_labels(spark):
    rng = random.Random(4)
    rows = [(i, english(rng, rng.randint(3, 80)), "en", "s", 0) for i in range(120)]
    noise = [(1000 + i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300)), None, "s", 0) for i in range(8)]
    frame = spark.createDataFrame(rows + noise, DOCS)
    kept = {row.doc_id for row in language_ppm.accepted(frame).collect()}
    assert kept == {row[0] for row in rows}
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert language_ppm.accepted(unlabelled).count() == len(rows + noise)


def test_the_sample_is_drawn_where_the_rows_stand(spark):
    """No exchange by language, at any table size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.createDataFrame([(i, f"text {i}", "en" if i % 2 else "de", "s", 0) for i in range(40)], DOCS)
        plans = []
        kept = type(frame).collect
        type(frame).collect = lambda self: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or kept(self)
        try:
            assert len(language_ppm.labelled_sample(frame)) > 20
        finally:
            type(frame).collect = kept
        assert plans and not any("Join" in plan for plan in plans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_learning_takes_little_memory():
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz     .,\n" * 3, dtype=np.uint8)
    sample = [(f"l{i % 4}", rng.choice(letters, language_ppm.SAMPLE_BYTES).tobytes()) for i in range(4 * language_ppm.SAMPLE_DOCUMENTS)]
    tracemalloc.start()
    language_ppm.learn(sample)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_repeated_labelled_rows_do_not_crowd_the_sample(spark):
    fields = "doc_id long, " + ", ".join(f"{name} long" for name in quality_forest.COUNTS) + ", quality int"
    copies = [(1, *([7] * len(quality_forest.COUNTS)), 1)] * 20_000
    others = [(i, *([i % 50] * len(quality_forest.COUNTS)), i % 2) for i in range(2, 500)]
    known = spark.createDataFrame(copies + others, fields)
    assert 80 <= quality_forest.fit_sample(known, 100, 1).count() <= 100
    assert quality_forest.fit_sample(known, 20_000, 1).count() == 1 + len(others)


def test_texts_that_spell_special_tokens(spark):
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    texts = ["<|endoftext|> hello", "a<|startoftext|>B <|EndOfText|>", "x <|endoftext|><|endoftext|>. y", "<|endoftext|>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in packing.pack(rows).where("start = 0").collect():
        ids = [*plain.encode(texts[row.doc_id], add_special_tokens=False).ids, 1]
        assert row.doc_tokens == len(ids)
        assert row.ids_crc32 == packing.crc_of(np.array(ids[: row.length]))


def test_repeated_rows_spread_over_groups(spark):
    rows = spark.createDataFrame([(1, "the same text again")] * 2_000, "doc_id long, text string").coalesce(1)
    places = packing.pieces(rows).select("doc_id", "start", "ids_crc32", "place")
    assert places.select(F.pmod(F.xxhash64("*"), F.lit(8)).alias("g")).groupBy("g").count().where("count > 500").count() == 0


# --- line templates --------------------------------------------------------------


def families(spark, texts):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {row.doc_id: row for row in line_templates.with_dropped(frame).collect()}


def test_short_lines_need_many_documents(spark):
    rng = random.Random(6)
    texts = {i: "\n".join([*prose(rng, 3), "Share this", *(["Less often"] if i % 3 == 0 else [])]) for i in range(60)}
    found = families(spark, texts)
    assert all("Share this" not in row.text and len(row.text.split("\n")) == 3 + (key % 3 == 0) for key, row in found.items())


def test_near_copies_of_few_lines_stay(spark):
    """Documents of two lines, some words changed in each copy, among many exact
    copies; a passage of three unrelated documents goes."""
    rng = random.Random(7)
    sentences = lambda n: ". ".join(prose(rng, n, 6))
    long, short, passage = sentences(14), sentences(9), " ".join(prose(rng, 1, 60))
    texts = {}
    for i in range(300):
        own = [long.split(" "), short.split(" ")]
        for _ in range(rng.randint(0, 4) if i > 200 else 0):
            line = rng.choice(own)
            line[rng.randrange(len(line))] = f"changed{chr(97 + i % 26)}"
        texts[i] = "\n".join(" ".join(line) for line in own)
    texts |= {400 + i: "\n".join([*prose(rng, 6), *([passage] if i < 3 else [])]) for i in range(6)}
    alone = sentences(30)
    texts |= {500 + i: f"{alone}\nby {prose(rng, 1, 2)[0]}" for i in range(6)}
    found = families(spark, texts)
    assert all(found[i].text == texts[i] for i in [*range(300), *range(403, 406)])
    assert all(passage not in found[i].text and found[i].n_dropped == 1 for i in range(400, 403))
    assert all(alone in found[i].text for i in range(500, 506))


def brute_recurring(texts):
    """Equal lines by families worked out in plain Python, without templates."""
    import re

    def masked(line):
        return " ".join(line_templates.VARIABLE if re.search("[0-9]", word) else word for word in line.split())

    def pieces(line):
        return [piece for piece in re.split(line_templates._CUT, line) if len(piece) >= line_templates.PIECE_CHARS]

    return {key: list(dict.fromkeys(x for x in map(masked, text.split("\n")) if x)) for key, text in texts.items()}, pieces


@pytest.mark.parametrize("seed", [11, 12])
def test_families_equal_those_of_plain_python(spark, seed):
    rng = random.Random(seed)
    shared = prose(rng, 6, 14)
    texts = {}
    for i in range(60):
        lines = [*prose(rng, rng.randint(1, 6), 10), *rng.sample(shared, rng.randint(0, 3))]
        rng.shuffle(lines)
        texts[i] = "\n".join(lines)
    for i in range(60, 90):
        own = texts[i % 7].split("\n")
        own[rng.randrange(len(own))] += " more"
        texts[i] = "\n".join(own)
    lines, pieces = brute_recurring(texts)
    words = sorted({piece for own in lines.values() for line in own for piece in pieces(line)})
    hashed = dict(spark.createDataFrame([(word,) for word in words], "w string").select("w", F.xxhash64("w")).collect())
    ids = {row.doc_id: row.h for row in spark.createDataFrame(list(texts.items()), "doc_id long, text string").select("doc_id", F.xxhash64("text").alias("h")).collect()}
    mask = -1 << line_templates.LINE_BITS
    sketches = {
        key: sorted({(hashed[p] & mask) | at for at, line in enumerate(own) for p in pieces(line)})[: line_templates.SKETCH]
        for key, own in lines.items()
    }
    holders = {}
    for key, sketch in sketches.items():
        for entry in sketch:
            holders.setdefault(entry & mask, []).append(ids[key])
    by_line = {}
    for key, own in lines.items():
        for i, line in enumerate(own):
            votes = [min(holders[entry & mask]) for entry in sketches[key] if entry & ~mask != i]
            family = ids[key]
            if any(entry & ~mask == i for entry in sketches[key]) and len(votes) < line_templates.OUTSIDE * len(sketches[key]):
                family = "the line"
            elif others := [v for v in votes if v != ids[key]]:
                number, leader = max((others.count(v), v) for v in others)
                family = leader if number >= line_templates.FOLLOW * len(votes) else family
            by_line.setdefault(line, {}).setdefault(family, set()).add(key)

    def least(line, found):
        short = len(line.split(" ")) < line_templates.LEAST_TOKENS
        texts = sum(map(len, found.values()))
        return max(texts**0.5, line_templates.SHORT_FAMILIES if short else line_templates.LEAST_FAMILIES)

    expected = {line for line, found in by_line.items() if len(found) >= least(line, found)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    parsed = line_templates.lines_with_family(line_templates.parsed_texts(frame))
    counted = parsed.select("key", "tokens", "family").distinct().groupBy("key", "tokens").count().collect()
    all_lines = spark.createDataFrame([(line,) for line in by_line], "line string")
    keys = {bytes(row.key): row.line for row in all_lines.select("line", line_templates._key(F.col("line")).alias("key")).collect()}
    assert {keys[bytes(row.key)]: row["count"] for row in counted} == {line: len(found) for line, found in by_line.items()}
    assert expected and expected < set(by_line)
    recurring = line_templates.recurring(parsed.where(F.col("tokens") >= line_templates.LEAST_TOKENS), "key").collect()
    assert {keys[bytes(row.key)] for row in recurring} == expected


def test_mixed_copies_keep_their_columns(spark):
    rows = [(i, "w " * 10, "a", i) for i in range(10)]
    found = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string, _size int")).collect()
    assert found and all(row._size == row.doc_id for row in found)


def test_pieces_cut_within_a_character_are_rated():
    sample = [("fr", ("é" * 40 + " été ").encode()[: 60 + i]) for i in range(8)]
    assert language_ppm.rate_limit([("fr", text * 2) for _, text in sample]) > 0


def test_long_texts_are_looked_up_in_parts(monkeypatch):
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    rng = random.Random(9)
    marks = ["café au", "end.", "Stop, go", "<|endoftext|>", "x" * 300, "tab\there", " wide"]
    long = " ".join(rng.choices([*english(rng).split(), *marks], k=3000)) + "\nlast."
    texts = [long, None, "", "One. word", long[:777], "y" * 5000]
    encoded = [None if text is None else text.encode() for text in texts]
    for part, words, learned in ((64, 50, 7), (1 << 18, 100_000, 2_000)):
        monkeypatch.setattr(tokens, "LEARNED_AT_ONCE", learned)
        monkeypatch.setattr(tokens, "WORDS_AT_ONCE", words)
        monkeypatch.setattr(tokens.parts, "__defaults__", (part,))
        assert b"".join(tokens.parts(encoded[0])) == encoded[0]
        ids, ends = tokens.WordIds().of_texts(encoded)
        for at, text in enumerate(texts):
            expected = plain.encode(text or "", add_special_tokens=False).ids
            assert ids[ends[at] : ends[at + 1]].tolist() == expected
        assert len(ends) == len(texts) + 1
    assert len(list(tokens.parts(encoded[0], 64))) > 100
    ids, ends = tokens.WordIds().of_texts([])
    assert len(ids) == 0 and ends.tolist() == [0]


def test_a_part_of_a_text_does_not_lead_its_copies(spark, monkeypatch):
    """A part has no shingle to itself, as the whole text has none, but tells
    little of far copies; compared through it, nearly all pairs of them remain."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(words[:90]), 1: " ".join(words)}
    for doc in range(2, 260):
        changed = set(draw.sample(range(3, 147, 6), 9))
        texts[doc] = " ".join(f"x{i}" if i in changed else word for i, word in enumerate(words))
    compared = []

    def watched(rows, name):
        stored = staged(rows, name)
        if name == "pairs":
            compared.append(stored.count())
        return stored

    monkeypatch.setattr(minmax_dedup, "staged", watched)
    found = minmax_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 5, 80)
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in found.collect()} == linked_components(texts, 5, 80)
    assert compared[1] < 1_000

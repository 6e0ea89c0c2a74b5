"""Dedup, mixing, nearest neighbours and the pipeline against brute force."""

import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from loanbook.llm import components, cross_polytope, line_templates, minmax_dedup, mixing
from tests.llm.cases import documents, linked_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


# --- near duplicates -----------------------------------------------------------


def near_copies(rng, groups=6, copies=12):
    """Groups of copies with words changed at random, more in some than in others."""
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([7, 30, 120]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(own) // 20)):
                own[rng.randrange(len(own))] = f"w{rng.randint(0, 400)}"
            texts.append(" ".join(own).title() if rng.random() < 0.3 else " ".join(own))
    rng.shuffle(texts)
    return [*texts, None, "", " \t", "one two", "ONE two", "one", "three four"]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, size, percent):
    texts = dict(enumerate(near_copies(random.Random(size))))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = minmax_dedup.near_duplicates(rows, size, percent).collect()
    expected = linked_components(texts, size, percent)
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in found} == expected
    assert all(row.kept == (row.doc_id == row.component_id) for row in found)
    assert len({row.component_id for row in found}) < len(texts) - 10


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(1)
    odd, shift = minmax_dedup.permutations(256)
    both = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = both[:800], both[100:]
    same = minmax_dedup.signature(a, odd, shift) == minmax_dedup.signature(b, odd, shift)
    assert same.mean() == pytest.approx(700 / 900, abs=0.08)


def test_near_duplicates_of_odd_tables(docs, empty):
    found = minmax_dedup.near_duplicates(docs, 5, 80).collect()
    told = {row.doc_id: row for row in found}
    assert len(found) == docs.count() and minmax_dedup.near_duplicates(empty).count() == 0
    assert [told[key].component_id for key in (9, 10, 11)] == [9, 9, 9]
    assert told[None].component_id is None and told[None].kept
    assert all(told[key].kept and told[key].n_shingles == 0 for key in (0, 1, 2))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    order = rng.sample(range(200), 200)
    links = list(zip(order[:99], order[1:100])) + [(order[100], node) for node in order[101:150]]
    found = components.components(spark.createDataFrame(links + [(7, 7)], "a long, b long"))
    told = {row.node: row.component for row in found.collect()}
    assert {told[node] for node in order[:100]} == {min(order[:100])}
    assert {told[node] for node in order[100:150]} == {min(order[100:150])}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- line templates ------------------------------------------------------------


def prose(rng, lines=6, words=12):
    return [" ".join(f"v{rng.getrandbits(30):x}q".translate(str.maketrans("0123456789", "ghijklmnop")) for _ in range(words)) for _ in range(lines)]


def test_recurring_templates_go_and_copies_stay(spark):
    rng = random.Random(5)
    notice = "all rights reserved by the owner of this page"
    passage = " ".join(prose(rng, 1, 60))
    texts = {}
    for key in range(40):
        own = prose(rng)
        own.insert(3, f"user {rng.choice(['ann', 'bob', 'cyd', 'dee'])}{key} logged in from host{key} at port {key}80 today")
        own.insert(1, notice) if key % 2 else own.insert(2, passage)
        own.append("too short line")
        texts[key] = "\n".join(own)
    base = prose(rng, 8, 20)
    for key in range(40, 70):
        own = [line.split() for line in base]
        own[key % 8][rng.randrange(20)] = f"changed{chr(97 + key % 26)}"
        texts[key] = "\n".join(" ".join(line) for line in own)
    clean = "\n".join(prose(rng))
    texts[70] = clean
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {row.doc_id: row for row in line_templates.with_dropped(rows).collect()}
    for key in range(40):
        left = found[key].text.split("\n")
        assert notice not in left and passage not in left and "too short line" in left
        assert not any(line.startswith("user ") for line in left)
        assert len(left) == 7 and found[key].n_dropped == 2
    assert all(found[key].text == texts[key] and found[key].n_dropped == 0 for key in range(40, 71))


def test_variable_fields_without_digits_are_generalised(spark):
    rng = random.Random(6)
    names = prose(rng, 1, 30)[0].split()
    texts = [(key, "\n".join([*prose(rng, 4), f"dear reader of this {names[key]} please write to the editor of this paper"])) for key in range(30)]
    found = line_templates.with_dropped(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert all(row.n_dropped == 1 and "dear reader" not in row.text for row in found)


def test_lines_recur_however_many_documents_and_copies_there_are(spark):
    """A Zipf vocabulary that all share, rising numbers of documents, and one
    text copied a thousand times."""
    rng = random.Random(8)
    vocabulary = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2_000)]
    weights = [1 / (i + 1) for i in range(2_000)]
    notice = "all rights reserved by the owner of this page"
    for n, copies in ((10, 0), (100, 1_000), (1_500, 0)):
        own = [[" ".join(rng.choices(vocabulary, weights, k=40)) for _ in range(6)] for _ in range(n)]
        field = [f"dear reader of this {''.join(rng.choices('abcdefgh', k=12))} please write to the editor" for _ in range(n)]
        texts = ["\n".join([*lines, notice, line]) for lines, line in zip(own, field)]
        rows = list(enumerate([*texts, *texts[:1] * copies]))
        found = line_templates.with_dropped(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert all(row.n_dropped == 2 and notice not in row.text and "dear" not in row.text for row in found)
        assert all(row.text == "\n".join(own[row.doc_id if row.doc_id < n else 0]) for row in found)


def test_line_templates_of_odd_tables(docs, empty):
    found = line_templates.with_dropped(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    told = Counter((row.doc_id, row.text) for row in found.collect())
    assert told == Counter((row.doc_id, row.text) for row in docs.collect())
    assert line_templates.with_dropped(empty).count() == 0


def test_line_templates_run_no_python(docs):
    plan = line_templates.with_dropped(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


# --- mixing --------------------------------------------------------------------


def test_targets_fill_up_by_weight(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 0, "e": 400}
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())] + [(9, " ".join(["w"] * 70), None)]
    keyed = mixing.with_keys(spark.createDataFrame(rows, "doc_id long, text string, source string"), 1)
    found = {row["_source"]: row.target for row in mixing.source_targets(keyed).collect()}
    order = [*sorted(sizes), None]
    cap = {s: 2 * sizes.get(s, 70) for s in order}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    rest, open_sources, target = 1.5 * (sum(cap.values()) / 2), list(order), {}
    while True:
        level = rest / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if level * weight[s] > cap[s]]
        if not full:
            break
        for s in full:
            target[s] = cap[s]
            rest -= cap[s]
            open_sources.remove(s)
    target |= {s: level * weight[s] for s in open_sources}
    assert found == pytest.approx(target)


def test_taken_words_meet_targets_and_epochs_come_first(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 20)
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "big" if i % 3 else f"s{i % 5}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keyed = mixing.with_keys(docs, 1)
    found = mixing.taken_by(keyed, mixing.source_cuts(keyed)).collect()
    by_source = {}
    for row in found:
        by_source.setdefault(row.source, []).append(row)
        assert row.taken in (0, row.size, 2 * row.size)
    for own in by_source.values():
        assert abs(sum(row.taken for row in own) - own[0].target) <= 15
        if own[0].target >= own[0].source_size:
            assert all(row.taken >= row.size for row in own)
    again = mixing.taken_by(keyed, mixing.source_cuts(keyed)).select("doc_id", "taken").collect()
    assert sorted(again) == sorted((row.doc_id, row.taken) for row in found)
    total = sum(row.taken for row in found)
    assert mixing.mixed(docs).select(F.sum(mixing.words_in(F.col("text")))).first()[0] == total


def test_mixing_of_odd_tables(docs, empty):
    keyed = mixing.with_keys(docs, 1)
    assert mixing.taken_by(keyed, mixing.source_cuts(keyed)).count() == docs.count()
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(empty).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_mixing_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.sql(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    expected = connection.sql(mixing.OP6_SQL)
    found = mixing.op6_mixing(spark, SF_DIR).select(*expected.columns).collect()
    assert sorted(tuple(row) for row in found) == sorted(expected.fetchall())


# --- nearest neighbours --------------------------------------------------------


def brute_nearest(rows, queries, number=20):
    found = {}
    for query, vector in queries:
        scored = [(-float(np.dot(vector, other)), key) for key, other in rows if key != query and len(other) == len(vector)]
        found[query] = [key for _, key in sorted(scored)[:number]]
    return found


def test_recall_ranks_and_scores(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 48))
    rows = [(i, (centres[i % 20] + rng.normal(size=48) * 0.6) * rng.uniform(0.5, 2)) for i in range(1500)]
    rows += [(1500 + i, rows[0][1]) for i in range(60)]
    frame = spark.createDataFrame([(key, vector.tolist()) for key, vector in rows], "vec_id long, embedding array<double>")
    found = {}
    for row in cross_polytope.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    queries = [(key, vector) for key, vector in rows if key % 20 == 0]
    expected, held = brute_nearest(rows, queries), dict(rows)
    hits = sum(len({key for _, key, _ in found[query]} & set(expected[query])) for query, _ in queries)
    assert hits >= 0.9 * 20 * len(queries)
    for query, vector in queries:
        own = sorted(found[query])
        assert [rank for rank, _, _ in own] == list(range(1, 21))
        assert all(score == pytest.approx(float(np.dot(vector, held[key])), rel=1e-12) for _, key, score in own)
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [0.5, 0.5], None, [0.0, 0.0], [nan, 1.0], [1.0, inf], [None, 1.0], [1.0, 0.0, 0.0], [], [1.0, 0.0]]
    rows = [(key, vector, "x") for key, vector in enumerate(vectors)] + [(None, [1.0, 1.0], "x"), (0, [1.0, 0.0], "y")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    found = cross_polytope.nearest(frame, F.col("vec_id") >= 0).collect()
    told = {}
    for row in sorted(found, key=lambda row: (row.query_id, row.rank)):
        told.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert told == {0: [(9, 1.0), (1, 0.5)], 1: [(0, 0.5), (9, 0.5)], 9: [(0, 1.0), (1, 0.5)]}
    assert cross_polytope.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_crowded_cells_are_searched_whole(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "CELL_ROWS", 16)
    monkeypatch.setattr(cross_polytope, "PART_ROWS", 200)
    rng = np.random.default_rng(9)
    rows = [(i, np.array([10.0] + (rng.normal(size=7) * 0.01).tolist())) for i in range(300)]
    frame = spark.createDataFrame([(key, vector.tolist()) for key, vector in rows], "vec_id long, embedding array<double>")
    found = {}
    for row in cross_polytope.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    expected = brute_nearest(rows, [row for row in rows if row[0] % 50 == 0])
    assert sum(len(found[query] & set(expected[query])) for query in expected) >= 0.9 * 20 * len(expected)


# --- the pipeline --------------------------------------------------------------


def test_pipeline_stages_hand_on_documents(spark, docs):
    rows = docs.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, SF_DIR)
        assert kept.dtypes == rows.dtypes, name
        assert stage(spark, rows.limit(0), SF_DIR).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR)
    assert {row.doc_id for row in packed.select("doc_id").distinct().collect()} == {row.doc_id for row in docs.collect()}


def test_pipeline_keeps_one_of_each_group(spark, tmp_path):
    rng = random.Random(10)
    rows = []
    for key in range(60):
        rows.append((key, "\n".join(prose(rng, 5, 20)), "en", f"s{key % 2}", 0))
    for key in range(60, 80):
        text = rows[key - 60][1]
        rows.append((key, text if key % 2 else text + " end", "en", "s0", 0))
    rows.append((80, "12345 !!!", "en", "s1", 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    packed = {row.doc_id for row in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert packed and packed <= set(range(60))
    docs = frame
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert {row.doc_id: row.text for row in docs.collect()} == {row[0]: row[1] for row in rows[:60]}


def test_every_operator_is_registered():
    names = [name for name in entry_points.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries() and {"op6_mixing", "op11_phrase_graph", "op12_template_markup", "op13_hard_negatives"} <= set(entry_points.oracle_sql())

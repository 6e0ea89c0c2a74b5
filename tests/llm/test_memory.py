"""What worker processes keep between tasks."""

from loanbook.llm import packing, tokens


def test_packing_needs_no_words(spark):
    kept = tokens.word_ids()
    before = kept.of_texts([b"some words and more"])[0].tolist()
    assert len(kept.place) == 4
    tokens.forget_words()
    assert len(kept.place) == 0 and tokens.word_ids() is kept
    assert kept.of_texts([b"some words and more"])[0].tolist() == before


def test_groups_forget_them(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(50)], "doc_id long, text string").repartition(1)
    assert packing.pack(docs).count() >= 50

    def remembered(batches):
        import pyarrow as pa
        import tokenizers

        kept = vars(tokenizers).get("_kept_word_ids", {})
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(len(ids.place) for ids in kept.values())]})

    # workers that packed last are the ones that are taken again
    assert all(row.n == 0 for row in spark.range(4).repartition(1).mapInArrow(remembered, "n long").collect())


def test_frequent_words_are_remembered(monkeypatch):
    """More words than are remembered: rare ones go, and all ids stay right."""
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    monkeypatch.setattr(tokens, "KEPT", 4)
    odd = ["<|STARTOFTEXT|>", "a<|endoftext|>b", "<|", "it's,", "Été", "é", "漢字"]
    texts = [" ".join(["often", "again", "the", *(f"rare{i}x{j}" for j in range(40)), *odd, "often", "again", "the"]).encode() for i in range(6)]
    words = tokens.WordIds()
    plain = words.tokenizer.from_file(tokens.tokenizer_path())
    learned = []
    learn = words.learn
    monkeypatch.setattr(words, "learn", lambda new: (learned.extend(new), learn(new)))
    for text in texts:
        ids, starts = words.of_texts([text, None])
        assert ids.tolist() == plain.encode(text.decode(), add_special_tokens=False).ids
        assert starts.tolist() == [0, len(ids), len(ids)]
    assert len(words.place) < 110 and [learned.count(word) for word in (b"often", b"again", b"the")] == [1, 1, 1]

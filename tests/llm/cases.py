"""Small documents with everything a table may hold, and brute-force versions."""

import zlib

LONG = " ".join(f"word{i % 977} lorem{i % 13}." for i in range(30_000))
TEXTS = [
    None,
    "",
    " \n\t ",
    "Das ist ein ganz normaler Satz mit einigen Worten.",
    "This is a perfectly ordinary sentence with several words in it.",
    "This is a perfectly ordinary sentence with several words in it.",
    "one two",
    "...",
    "ÄÖÜ éàè 漢字 😀 \x1c   x",
    LONG,
    LONG,
    LONG + " and a little more",
]


def documents(spark, texts=TEXTS):
    """Documents with a null id, a repeated row, and columns with clashing names."""
    rows = [(i if i != 8 else None, text, ["en", None, "de"][i % 3], [None, "a", "b"][i % 3]) for i, text in enumerate(texts)]
    rows.append(rows[4]) if len(rows) > 4 else None
    rows = [(*row, 7, "clash", 1.5, 3) for row in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, key long, component string, size double, a int"
    )


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def shingles(text, size):
    words = text.encode().lower().split() if text else []
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def linked_components(texts, size, percent):
    """Smallest reachable id for each id of a dict of texts, by all pairs."""
    sets = {key: shingles(text, size) for key, text in texts.items()}
    parent = {key: key for key in texts}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            either = len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * either:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {key: (len(sets[key]), root(key)) for key in texts}

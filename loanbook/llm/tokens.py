"""Token ids of whole texts, word by word.

The lower-casing word tokenizer treats white space as nothing but a separator,
so the ids of a text are those of its words in a row. A task tokenizes each
distinct word once and looks the others up. Where a text spells a special token
of the tokenizer, exactly as it is written, that is one id, whatever stands
around it.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np

#: Ends a document in the streams made here.
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words a task remembers; beyond that it forgets those it has met only once, or
#: the less frequent ones, and keeps so many at most.
REMEMBERED = 400_000
KEPT = 200_000
#: New words tokenized at once; what the tokenizer builds for a word takes a
#: hundred times what is kept of it.
LEARNED_AT_ONCE = 2_000
#: Words looked up at once, and bytes of text split into words at once.
WORDS_AT_ONCE = 100_000
PART_BYTES = 1 << 18


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: A full stop or comma after a letter and before white space is a token by itself.
_STOPS = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")


def split(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case unless a combining mark may
    follow one: letter and mark are composed before letters change case."""
    if not text:
        return []
    if b"\xcc" in text or b"\xcd" in text:
        return text.split()
    return _STOPS.sub(rb" \1", text.lower()).split()


_SPACE = re.compile(rb"[ \t-\r]")


def parts(text: bytes | None, limit: int = PART_BYTES) -> Iterator[bytes | None]:
    """A text cut behind white space into parts of about so many bytes; a word
    is never cut, however long it is."""
    begin = 0
    while text and len(text) - begin > limit and (space := _SPACE.search(text, begin + limit)):
        yield text[begin : space.end()]
        begin = space.end()
    yield text[begin:] if begin else text


class Numbers(dict):
    """Numbers words as they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def word_ids(path: str | None = None) -> WordIds:
    """The tokenizer this worker process keeps between tasks, with the words it
    has met; functions sent by value have no module of their own to keep it in."""
    import tokenizers

    path = path or tokenizer_path()
    kept = vars(tokenizers).setdefault("_kept_word_ids", {})
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def forget_words() -> None:
    """Drop the words this worker process remembers, and let its tokenizers stay.
    For work that follows on tokens and needs no words."""
    for kept in vars(sys.modules.get("tokenizers", object)).get("_kept_word_ids", {}).values():
        kept.forget()


class WordIds:
    """Ids of texts by a tokenizer file whose tokens never span white space."""

    def __init__(self, path: str | None = None):
        # Spark runs a task for each core already
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        # special tokens are told apart in the raw text, before it is cut into words
        self.special = {token.content.encode(): key for key, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.spelled = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")")
        self.tokenizer.encode_special_tokens = True
        self.mark = self._mark()
        self.forget()

    def words(self, text: bytes | None) -> list[bytes]:
        """Words of a text; special tokens among them begin with a byte that no
        text holds."""
        if not text or not any(token in text for token in self.special):
            return split(text)
        parts = self.spelled.split(text)
        return list(chain.from_iterable([b"\xff" + part] if at % 2 else split(part) for at, part in enumerate(parts)))

    def forget(self) -> None:
        """``place`` numbers the words; word i has ids[start[i] : start[i + 1]]
        and was looked up ``uses[i]`` times."""
        self.place = Numbers()
        self.ids = np.zeros(0, dtype=np.uint16)
        self.start = np.zeros(1, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int32)

    def forget_rare(self) -> None:
        """Keep the words that were looked up more than once since the last time,
        the most frequent of them if they are many."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > KEPT:
            kept = np.sort(kept[np.argpartition(self.uses[kept], -KEPT)[-KEPT:]])
        words = list(self.place)
        place = Numbers()
        place.update((words[number], new) for new, number in enumerate(kept.tolist()))
        self.ids, self.start = self.gathered(kept)
        self.place, self.uses = place, np.zeros(len(kept), dtype=np.int32)

    def _mark(self) -> tuple[str, int] | None:
        """A special token that, put behind each word, tells many words of one
        text apart, and its id; none where words differ by what precedes them."""
        for key, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word):
                self.mark, probe = (token.content, key), [b"one", b"two,", b"one", "\u00e9t\u00e9".encode(), b"."]
                if self._marked(probe) is not None and all(map(np.array_equal, self._marked(probe), self._apart(probe))):
                    return self.mark
        return None

    def _apart(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row and how many each has, word by word."""
        plain = [word.decode() for word in words if word[:1] != b"\xff"]
        found = iter(self.tokenizer.encode_batch_fast(plain, add_special_tokens=False))
        ids = [[self.special[word[1:]]] if word[:1] == b"\xff" else next(found).ids for word in words]
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint16), np.array([len(x) for x in ids], dtype=np.int64)

    def _marked(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of all words in one text, a mark behind each; nothing where
        they hold special tokens, or what is one in lower case."""
        text = b" ".join(words)
        if b"\xff" in text or any(token in text for token in self.special):
            return None
        mark, key = self.mark
        marked = "".join([word.decode() + mark for word in words])
        self.tokenizer.encode_special_tokens = False
        try:
            ids = np.array(self.tokenizer.encode_batch_fast([marked], add_special_tokens=False)[0].ids, dtype=np.uint16)
        finally:
            self.tokenizer.encode_special_tokens = True
        ends = np.flatnonzero(ids == key)
        return (ids[ids != key], np.diff(ends, prepend=-1) - 1) if len(ends) == len(words) else None

    def learn(self, words: list[bytes]) -> None:
        """Store the ids of new words, in the order of their numbers."""
        flat, lengths = [self.ids], []
        for at in range(0, len(words), LEARNED_AT_ONCE):
            some = words[at : at + LEARNED_AT_ONCE]
            ids, numbers = (self._marked(some) if self.mark else None) or self._apart(some)
            flat.append(ids)
            lengths.append(numbers)
        self.ids = np.concatenate(flat)
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(lengths))])

    def of_texts(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text begins, with the
        total at the end. A null text has no ids."""
        if len(self.place) > REMEMBERED:
            self.forget_rare()
        number = self.place.__getitem__
        found: list[np.ndarray] = []
        ends = [np.zeros(1, dtype=np.int64)]
        numbers: list[int] = []
        closed: list[int] = []
        total = 0
        for text in texts:
            for part in parts(text):
                if len(numbers) > WORDS_AT_ONCE:
                    ids, after = self.looked_up(numbers)
                    found.append(ids)
                    ends.append(total + after[np.array(closed, dtype=np.int64)])
                    total += len(ids)
                    numbers, closed = [], []
                numbers += map(number, self.words(part))
            closed.append(len(numbers))
        ids, after = self.looked_up(numbers)
        ends.append(total + after[np.array(closed, dtype=np.int64)])
        return np.concatenate([*found, ids]), np.concatenate(ends)

    def looked_up(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered words in a row, and where each word begins, with the
        total at the end; words not met before are learned first."""
        if self.place.new:
            self.learn(self.place.new)
            self.place.new = []
        words = np.array(numbers, dtype=np.int64)
        uses = np.bincount(words, minlength=len(self.start) - 1).astype(np.int32)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return self.gathered(words)

    def gathered(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of these numbers in a row, and where each begins."""
        first = self.start[words]
        lengths = self.start[words + 1] - first
        after = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        # place k of the result lies k - after[w] places into its word w
        places = np.arange(after[-1]) + np.repeat(first - after[:-1], lengths)
        return self.ids[places], after

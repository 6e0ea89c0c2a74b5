"""Packing documents into sequences of a fixed capacity by minimum bin slack.

A document longer than a sequence gives full sequences and a remainder; shorter
ones are remainders as they are. Remainders are dealt into groups of bounded
size, and within a group each window takes its longest remaining piece and then
that multiset of the other lengths that fills it closest to capacity: a bitset
holds the sums that can be reached, one big-integer shift per length, and
walking back through it counts the pieces of each length. Where nothing fills
the window, the next piece is cut at its end; what is left of the last window
is cut into powers of two, which need no padding. So no sequence is padded.

Defined results: a document has one id at least, the end mark, so null and empty
texts are packed too; repeated rows and equal ids are packed one by one; an
empty table gives no rows. Columns other than ``doc_id`` and ``text`` are
ignored. Which sequence a piece goes to depends on the documents alone.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, give_back, text_slices, with_texts
from loanbook.llm.tokens import END_ID, forget_words, word_ids

CAPACITY = 2048
#: Documents whose pieces are packed together, on average.
GROUP_DOCUMENTS = 4096

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary, place long"
PACKED_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Full pieces, and one remainder per document with its ids, two bytes
    each: at most one sequence of them travels per document. ``place`` numbers
    the pieces of a task, so that repeated rows differ in it."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = word_ids(tokenizer), 0
        for rows, texts in text_slices(batches):
            ids, starts = encoder.of_texts(texts)
            out: list[tuple] = []
            for doc, first, end in zip(rows.column(0).to_pylist(), starts[:-1], starts[1:], strict=True):
                own = np.append(ids[first:end], np.uint16(END_ID))
                for at in range(0, len(own), capacity):
                    part = own[at : at + capacity]
                    kept = None if len(part) == capacity else part.astype("<u2").tobytes()
                    out.append((doc, at, len(part), len(own), crc_of(part), kept, place))
                    place += 1
            names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids", "place"]
            kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_texts(docs).mapInArrow(cut, PIECE_SCHEMA)


def fill(space: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is closest to the
    space without exceeding it. ``lengths`` are the keys in descending order."""
    mask, reached, steps = (1 << (space + 1)) - 1, 1, []
    for length in lengths:
        if length > space or not counts[length]:
            continue
        left, copies = min(counts[length], space // length), 1
        while left and not reached >> space:
            taken = min(copies, left)
            steps.append((length, taken, reached))
            reached |= (reached << (length * taken)) & mask
            left -= taken
            copies *= 2
        if reached >> space:
            break
    best, chosen = reached.bit_length() - 1, defaultdict(int)
    for length, taken, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] += taken
            best -= length * taken
    return dict(chosen)


def pack_lengths(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, begin, end), each full or as long as a power of two.

    Every id of every piece lies in exactly one sequence.
    """
    # what is left of piece i is begin[i] up to lengths[i]
    begin = [0] * len(lengths)
    of_length: dict[int, list[int]] = defaultdict(list)
    for piece in range(len(lengths) - 1, -1, -1):
        of_length[lengths[piece]].append(piece)
    counts = {length: len(found) for length, found in of_length.items()}
    order = sorted(counts, reverse=True)
    total, sequences = sum(lengths), []

    def take(length: int, amount: int) -> tuple[int, int, int]:
        """The first ``amount`` ids of a piece with ``length`` left."""
        piece = of_length[length].pop()
        counts[length] -= 1
        at = begin[piece]
        begin[piece] = at + amount
        if rest := length - amount:
            if rest not in counts:
                counts[rest] = 0
                order.append(rest)
                order.sort(reverse=True)
            of_length[rest].append(piece)
            counts[rest] += 1
        return piece, at, at + amount

    while total:
        size = capacity if total >= capacity else 1 << (total.bit_length() - 1)
        while order and not counts[order[0]]:
            del counts[order.pop(0)]
        window, space = [], size
        if order[0] <= space:
            space -= order[0]
            window.append(take(order[0], order[0]))
        if space:
            for length, number in fill(space, counts, order).items():
                for _ in range(number):
                    window.append(take(length, length))
                    space -= length
        while space:
            # nothing fills it: cut the shortest piece that reaches the end
            longer = [length for length in order if counts[length] and length >= space]
            window.append(take(longer[-1], space))
            space = 0
        total -= size
        sequences.append(window)
    return sequences


def pack(
    docs: DataFrame, capacity: int = CAPACITY, group_documents: int = GROUP_DOCUMENTS, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece: its document, place there, checksum, sequence, offset."""
    groups = max(1, -(-docs.count() // group_documents))

    def pack_group(rows: pa.Table) -> pa.Table:
        # the process may be one that tokenized and waited since
        forget_words()
        give_back()
        rows = rows.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        )
        lengths = rows["length"].to_numpy()
        base = rows["group"][0].as_py() << 32
        found = []
        for number, window in enumerate(pack_lengths(lengths.tolist(), capacity)):
            offset = 0
            for piece, at, end in window:
                found.append((piece, at, end - at, base + number, offset))
                offset += end - at
        piece, at, length, sequence_id, offset = np.array(found, dtype=np.int64).T
        crc = rows["ids_crc32"].to_numpy()[piece]
        for row in np.flatnonzero(length < lengths[piece]):
            ids = np.frombuffer(rows["ids"][int(piece[row])].as_py(), dtype="<u2")
            crc[row] = crc_of(ids[at[row] : at[row] + length[row]])
        return pa.table(
            {
                "doc_id": rows["doc_id"].take(pa.array(piece)),
                "start": rows["start"].to_numpy()[piece] + at,
                "length": length,
                "ids_crc32": crc,
                "doc_tokens": rows["doc_tokens"].to_numpy()[piece],
                "sequence_id": sequence_id,
                "offset": offset,
            }
        )

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "place"), F.lit(groups))
    dealt = pieces(docs, capacity, tokenizer).withColumn("group", group)
    return dealt.groupBy("group").applyInArrow(pack_group, PACKED_SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))

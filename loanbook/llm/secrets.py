"""Secret scan: fixed patterns, and a battery of randomness tests.

The patterns find assignments to secret-like names, access keys and long hex
runs. The battery looks at every other run of key characters: it infers the
smallest encoding whose alphabet holds the run, and tests what random keys in
that encoding do and ordinary text does not.

* Chi-squared uniformity of the alphabet. Ordinary runs repeat characters: their
  coincidences exceed those of a uniform draw several times over.
* Runs of character classes. Random keys change between lower case, upper case,
  digits and symbols at most places, ordinary runs seldom.
* Serial correlation of neighbouring code values. It tells sequences such as an
  alphabet or a counter from random order.

A run is a candidate if a random key would pass all three at a level of
``FIT``. Its p-value, of looking this random while being ordinary, combines by
Fisher's method the chances that an ordinary run has so few coincidences and so
many class changes. Benjamini-Hochberg with weights by length over all
candidates of the scan then bounds the share of ordinary runs among the spans
added: longer runs carry more evidence and get more of the error allowance.
Only counts of p-values by bins reach the driver.

Defined results: a null or empty text has no spans; repeated rows get equal
rows; an empty table gives no rows. Other columns are ignored. Offsets count
code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.texts import documents, staged, text_slices, with_texts

# The base patterns and the least lengths of what they must hold.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ASSIGN_LEAST = 8
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
#: A run of 32 or more is what is left of maximal runs once shorter ones go.
HEX = re.compile(rb"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")

#: Runs of key characters the battery looks at; shorter ones tell too little.
RUN = re.compile(rb"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Level at which a random key fails one of the three tests.
FIT = 0.001
#: Allowed share of ordinary runs among the spans added.
FDR = 0.01
# Properties of ordinary runs, on the safe side: the share of equal pairs of
# characters, and of places where the character class changes.
ORDINARY_COINCIDENCE = 0.055
ORDINARY_CHANGE = 0.2

_LOWER, _UPPER, _DIGIT, _SIGN = range(4)
_CLASS = np.full(256, _SIGN)
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT

#: Encodings from the smallest alphabet on; digits in it tell keys from words.
ENCODINGS = {
    "hex": b"0123456789abcdef",
    "upperhex": b"0123456789ABCDEF",
    "base32": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": b"abcdefghijklmnopqrstuvwxyz0123456789",
    "upper36": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "base62": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer_encoding(run: bytes) -> str | None:
    """The smallest encoding that holds the run, if every class of characters
    that a random key of this length is sure to show is there."""
    body = run.rstrip(b"=")
    present = set(_CLASS[np.frombuffer(body, dtype=np.uint8)].tolist())
    if _DIGIT not in present or len(present) < 2:
        return None
    for name, alphabet in ENCODINGS.items():
        if not body.translate(None, alphabet):
            expected = set(_CLASS[np.frombuffer(alphabet, dtype=np.uint8)].tolist()) - {_SIGN}
            return name if expected <= present else None
    return None


def battery(body: bytes, alphabet: bytes) -> tuple[float, float]:
    """Two probabilities for a run: that a random key of this alphabet gives
    its least likely test result, and that an ordinary run looks as random."""
    codes = np.frombuffer(body, dtype=np.uint8)
    values = np.zeros(256)
    values[list(alphabet)] = np.arange(len(alphabet))
    n, k = len(codes), len(alphabet)

    # chi-squared, by the cube-root normal approximation on k - 1 degrees
    count = np.bincount(codes, minlength=256).astype(float)
    chi = k / n * float((count**2).sum()) - n
    spread = 2 / (9 * (k - 1))
    fit_chi = normal_tail(((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)) if chi > 0 else 1.0
    pairs = n * (n - 1) / 2
    equal = float((count * (count - 1)).sum()) / 2
    # coincidences of an ordinary run vary more than independent pairs would
    deviation = math.sqrt(pairs * ORDINARY_COINCIDENCE * (1 + 2 * n * ORDINARY_COINCIDENCE / 3))
    ordinary_chi = normal_tail((pairs * ORDINARY_COINCIDENCE - equal) / deviation)

    # runs of character classes; a change has the chance that two draws differ in class
    kinds = _CLASS[codes]
    shares = np.bincount(_CLASS[np.frombuffer(alphabet, dtype=np.uint8)], minlength=4) / k
    change = 1 - float((shares**2).sum())
    changes = int((kinds[1:] != kinds[:-1]).sum())
    expected = (n - 1) * change
    fit_runs = 2 * normal_tail(abs(changes - expected) / math.sqrt(expected * (1 - change) + 0.25))
    mean = (n - 1) * ORDINARY_CHANGE
    ordinary_runs = normal_tail((changes - 0.5 - mean) / math.sqrt(mean * (1 - ORDINARY_CHANGE)))

    # serial correlation of neighbours, about -1/n with deviation 1/sqrt(n)
    value = values[codes] - values[codes].mean()
    power = float((value**2).sum())
    serial = float((value[1:] * value[:-1]).sum()) / power if power else 1.0
    fit_serial = 2 * normal_tail(abs(serial + 1 / n) * math.sqrt(n))
    both = max(ordinary_chi * ordinary_runs, 1e-300)
    return min(fit_chi, fit_runs, fit_serial), both * (1 - math.log(both))


def base_spans(text: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of the fixed patterns by start, then kind as listed."""
    spans = []
    for found in ASSIGN.finditer(text):
        if found.end(2) - found.start(2) >= ASSIGN_LEAST:
            spans.append((found.start(), 0, found.end()))
    for found in ACCESS.finditer(text):
        if found.end() - found.start() >= ACCESS_LEAST:
            spans.append((found.start(), 1, found.end()))
    for found in HEX.finditer(text):
        spans.append((found.start(), 2, found.end()))
    return [(start, end, KINDS[kind]) for start, kind, end in sorted(spans)]


def random_runs(text: bytes, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """Byte spans of runs that pass as random keys and lie in no base span, with
    encoding and p-value."""
    found = []
    for match in RUN.finditer(text):
        start, end = match.span()
        if any(start < b and a < end for a, b, _ in taken):
            continue
        run = match.group()
        encoding = infer_encoding(run)
        if encoding is None:
            continue
        fit, ordinary = battery(run.rstrip(b"="), ENCODINGS[encoding])
        if fit >= FIT:
            found.append((start, end, encoding, ordinary))
    return found


def code_points(text: bytes, places: list[int]) -> list[int]:
    """Code point offsets of ascending byte offsets."""
    if text.isascii():
        return places
    out, at, count = [], 0, 0
    for place in places:
        count += len(text[at:place].decode())
        at = place
        out.append(count)
    return out


def _in_code_points(text: bytes, spans: list[tuple]) -> list[tuple]:
    places = sorted({place for span in spans for place in span[:2]})
    points = dict(zip(places, code_points(text, places), strict=True))
    return [(points[span[0]], points[span[1]], *span[2:]) for span in spans]


SPAN = "start long, end long, kind string"
SCAN_SCHEMA = (
    "doc_id long, base array<struct<start:long,end:long,kind:string>>, "
    "runs array<struct<start:long,end:long,kind:string,p:double>>"
)
_SPAN_TYPE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
_RUN_TYPE = pa.struct([*_SPAN_TYPE, ("p", pa.float64())])


def _scan_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_slices(batches):
        base, runs = [], []
        for text in texts:
            spans = base_spans(text) if text else []
            candidates = random_runs(text, spans) if text else []
            keys = ("start", "end", "kind", "p")
            base.append([dict(zip(keys, span)) for span in _in_code_points(text, spans)] if spans else [])
            runs.append([dict(zip(keys, run)) for run in _in_code_points(text, candidates)] if candidates else [])
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(base, pa.list_(_SPAN_TYPE)), pa.array(runs, pa.list_(_RUN_TYPE))],
            names=["doc_id", "base", "runs"],
        )


#: p-values are counted in so many bins for each factor of ten, down to 1e-60.
BINS_PER_DECADE = 20
LEAST_LOG = -60


def p_bin(run: Column) -> Column:
    """The number of a p-value's bin; its upper edge stands for all in it."""
    return F.ceil(F.greatest(F.log10(run["p"]), F.lit(float(LEAST_LOG))) * BINS_PER_DECADE).cast("int")


def length_class(run: Column) -> Column:
    return F.floor(F.log2(run["end"] - run["start"])).cast("int")


def length_cutoffs(bins: list[tuple[int, int, int]], fdr: float) -> dict[int, int]:
    """The highest bin accepted in each length class, from (class, bin, count).

    A class weighs in proportion to its length, weights have mean one over the
    candidates, and p / weight is compared with the step-up line.
    """
    total = sum(count for _, _, count in bins)
    if not total:
        return {}
    mean = sum(2.0**size * count for size, _, count in bins) / total
    weight = {size: 2.0**size / mean for size, _, _ in bins}
    weighed = sorted((at / BINS_PER_DECADE - math.log10(weight[size]), count) for size, at, count in bins)
    seen, accepted = 0, None
    for value, count in weighed:
        seen += count
        if value <= math.log10(fdr * seen / total):
            accepted = value
    if accepted is None:
        return {}
    return {size: math.floor((accepted + math.log10(weight[size])) * BINS_PER_DECADE + 1e-9) for size in weight}


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Per document ``base`` spans by pattern and ``added`` spans by the battery."""
    found = staged(with_texts(docs).mapInArrow(_scan_batches, SCAN_SCHEMA), "secrets")
    runs, run = found.select(F.explode("runs").alias("run")), F.col("run")
    counted = runs.groupBy(length_class(run).alias("size"), p_bin(run).alias("bin")).count()
    # a few dozen length classes of 1,200 bins at most
    cutoffs = length_cutoffs([tuple(row) for row in counted.collect()], fdr)
    if not cutoffs:
        return found.withColumn("added", F.filter("runs", lambda _: F.lit(False)))
    limit = F.create_map(*[F.lit(x) for pair in cutoffs.items() for x in pair])

    accepted = F.filter("runs", lambda run: p_bin(run) <= F.element_at(limit, length_class(run)))
    return found.withColumn("added", accepted)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    plain = F.transform("added", lambda s: F.struct(s["start"], s["end"], F.concat(F.lit("random-"), s["kind"]).alias("kind")))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    # a base span and an added one never share a start
    every = F.array_sort(F.concat("base", plain), lambda a, b: (a["start"] - b["start"]).cast("int"))
    return found.select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
    )

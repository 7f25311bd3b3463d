"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing turns each symbol into a small label by comparing it with its left neighbour; local maxima of
the labels start the phrases, and a phrase's name is a hash of what it holds. Phrases of one level are the symbols of the
next. Where a phrase begins depends on a few symbols around it only, so equal substrings share the names of their
interior phrases at any offset. A fingerprint is a bottom sketch of the names of three levels as a bag: each name with the
number of its occurrence, and a long run of one symbol as often as phrases would cover it, so that likeness follows the text
that is shared, repetitive texts included.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import arrow_limits, beside

#: Levels whose names are kept (phrases of about 9, 27 and 80 bytes), and hashes in a fingerprint.
LEVELS, KEEP = (2, 3, 4), 128
#: Symbols of a run that count as one phrase, of bytes and of phrases of the first level (of later levels each is one).
RUNS = {1: 8, 2: 3}
#: Bytes of text of a range of documents.
RANGE = 64 << 20
_PIECE = 1 << 20
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _A
    x = (x ^ (x >> _S)) * _B
    return x ^ (x >> _S)


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Odd multipliers for the places within a phrase.
_PLACE = _mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _tossed(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels after coin tossing: twice the lowest place where a symbol differs from its left neighbour, plus its bit there.

    Repeated until at most six labels are left; the first symbol of a text has only its own lowest bit.
    """
    x = names
    for _ in range(4 if x.dtype == np.uint64 else 3):
        one = x.dtype.type(1)
        low = np.empty_like(x)
        np.bitwise_xor(x[1:], x[:-1], out=low[1:])
        low[starts] = one
        low &= ~low + one
        x = (np.bitwise_count(low - one) * np.uint8(2) + ((x & low) != 0)).astype(np.uint8)
    return x


def _parsed(names: np.ndarray, starts: np.ndarray, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of the phrases of the next level, where each text starts among them, and the places and names of runs, one for every
    `runs` symbols of a run (none if 0)."""
    # runs of one symbol become one symbol named by it and its length, so that neighbours differ
    first = np.empty(len(names), bool)
    np.not_equal(names[1:], names[:-1], out=first[1:])
    first[starts] = True
    at = np.flatnonzero(first)
    starts = np.cumsum(first)[starts] - 1
    run = np.diff(at, append=len(names))
    value = names[at]
    label = _tossed(value, starts)
    wide = _BYTE[value] if value.dtype == np.uint8 else value
    long = run > 1
    if long.any():
        wide = wide.copy() if wide is value else wide
        wide[long] = _mix(wide[long] + run[long].astype(np.uint64) * _A)
    often = run // runs if runs else np.zeros(0, np.int64)
    held = np.flatnonzero(often)
    run_at, what = np.repeat(at[held], often[held]), np.repeat((_BYTE[value[held]] if value.dtype == np.uint8 else value[held]), often[held])
    begins = np.zeros(len(label), bool)
    begins[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    begins[starts[1:] - 1] = False  # the last symbol of a text has no right neighbour
    begins[starts] = True
    begin = np.flatnonzero(begins)
    size = np.diff(begin, append=len(label))
    place = np.arange(len(label)) - np.repeat(begin, size)
    total = np.add.reduceat(wide * _PLACE[place & 63], begin)
    return _mix(total + size.astype(np.uint64)), np.cumsum(begins)[starts] - 1, run_at, what


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the KEEP smallest 32-bit hashes of its phrases (name and number of the occurrence), sorted; none for the empty text.

    Texts are parsed together, side by side, in pieces of about a MB (a longer text is its own piece).
    """
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    group: list[int] = []
    size = 0
    for i, x in enumerate(texts):
        if x:
            group.append(i)
            size += len(x)
        if group and (size > _PIECE or i == len(texts) - 1):
            _group([texts[k] for k in group], group, out)
            group, size = [], 0
    return out


def _group(texts: list[bytes], where: list[int], out: list[np.ndarray]) -> None:
    names = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *(len(x) for x in texts[:-1])])
    seen = []
    for level in range(1, LEVELS[-1] + 1):
        before = starts
        names, starts, run_at, what = _parsed(names, starts, RUNS.get(level, 0))
        if len(run_at):
            owner = (np.searchsorted(before, run_at, "right") - 1).astype(np.uint64)
            seen.append(owner << _S | _mix(what + np.uint64(100 + level)) >> _S)
        if level in LEVELS:
            owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(starts, append=len(names)))
            seen.append(owner << _S | _mix(names + np.uint64(level)) >> _S)
    bag = np.sort(np.concatenate(seen))
    new = np.concatenate([[True], bag[1:] != bag[:-1]])
    nth = np.arange(len(bag)) - np.maximum.accumulate(np.where(new, np.arange(len(bag)), 0))
    both = np.unique(bag >> _S << _S | _mix(bag << _S | nth.astype(np.uint64)) >> _S)
    cuts = np.searchsorted(both >> _S, np.arange(len(texts) + 1, dtype=np.uint64))
    low = both.astype(np.uint32)
    for i, a, b in zip(where, cuts[:-1], cuts[1:]):
        out[i] = low[a : min(b, a + KEEP)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the phrases that two fingerprints have in common (Dice); 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    if len(a) == len(b) and (a == b).all():
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    same = both[1:] == both[:-1]
    distinct = len(both) - int(same.sum())
    n = min(KEEP, distinct)
    # shared hashes among the n smallest of the union
    last = np.flatnonzero(np.concatenate([[True], ~same]))[n - 1]
    j = int(same[: last + 1].sum()) / n
    return 2 * j / (1 + j)


def text_of(a: np.ndarray) -> str:
    """The fingerprint as text: eight hexadecimal digits for each hash."""
    return a.astype(">u4").tobytes().hex()


def edited(text: str, after: str) -> str:
    """text with its last third (floor of its code points / 3) replaced by as many of the first of `after`."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and `fingerprint` of every whole text (null: as the empty text); one pass, no shuffle."""

    def start():
        return lambda texts: [pa.array([text_of(x) for x in sketches([(x or "").encode("utf-8", "surrogatepass") for x in texts])], pa.string())]

    found = beside(docs.select(*keep, *([] if text in keep else [text])), start, [T.StructField("fingerprint", T.StringType())], text)
    return found.select(*[F.col(f"row.{c}") for c in keep], "fingerprint")


def beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, extra) in order; each is given out once the row after it is known, extra ones never."""
    held: tuple | None = None  # id, text, sketch of the last row so far
    for b in batches:
        ids, xs, extra = b.column(0).to_pylist(), [x or "" for x in b.column(1).to_pylist()], b.column(2).to_pylist()
        own = sketches([x.encode("utf-8", "surrogatepass") for x in xs])
        rows = ([held] if held else []) + [(i, x, s) for i, x, s in zip(ids, xs, own)]
        held = None if extra[-1] else rows[-1]
        if len(rows) > 1:
            changed = [edited(a[1], n[1]).encode("utf-8", "surrogatepass") for a, n in zip(rows, rows[1:])]
            new = sketches(changed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows[:-1]], pa.int64()),
                    pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
                    pa.array([text_of(r[2]) for r in rows[:-1]], pa.string()),
                    pa.array([text_of(s) for s in new], pa.string()),
                    pa.array([likeness(r[2], s) for r, s in zip(rows, new)], pa.float64()),
                    pa.array([likeness(r[2], n[2]) for r, n in zip(rows, rows[1:])], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, and that to the next document's.

    The next document is the next by descending doc_id (null ids last, equal ids by hash and text); after the last comes the
    first, and a single document is its own next. Null texts are empty; repeated rows follow one another; an empty table gives
    no rows; only doc_id and text are read, so other columns may have any name. Whole texts move once, into ranges of about
    RANGE bytes (an id on many rows in several, by hash); the first document of each range also goes to the range before it.
    The driver holds a few numbers for each range.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    low = -(1 << 63)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.coalesce(docs["doc_id"].cast("long"), F.lit(low)).alias("o"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("h"))
    total, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not total:
        return rows.select("doc_id", "text", F.lit(False).alias("extra")).mapInArrow(beside_next, _OUT)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // RANGE))
    k = -F.col("o").cast("double")
    bounds = set(rows.select(k.alias("k")).approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.1 / ranges))
    # ids on so many rows that they fill ranges of their own: `ranges` at most
    many = {-float(r["o"]): -(-r["count"] * ranges // total) for r in rows.groupBy("o").count().where(F.col("count") > max(1000, total // ranges)).collect()}
    bounds |= {x for h in many for x in (h, math.nextafter(h, math.inf))}
    splits = [-float("inf"), *(sorted(bounds) or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="k", outputCol="big").transform(rows.withColumn("k", k)).withColumn("big", F.col("big").cast("int"))
    sub = F.lit(0)
    for x, parts in many.items():
        sub = F.when(F.col("k") == x, F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * parts).cast("int")).otherwise(sub)
    ranged = ranged.withColumn("sub", sub)
    heads = sorted((r["big"], r["sub"], r["o"]) for r in ranged.groupBy("big", "sub").agg(F.max("o").alias("o")).collect())
    names = F.broadcast(spark.createDataFrame([(b, s, i, (i - 1) % len(heads)) for i, (b, s, _) in enumerate(heads)], "big int, sub int, range int, before int"))
    ranged = ranged.join(names, ["big", "sub"]).select("doc_id", "text", "o", "h", "range", "before")
    top = F.broadcast(spark.createDataFrame([(i, o) for i, (_, _, o) in enumerate(heads)], "range int, o long"))
    first = ranged.join(top, ["range", "o"]).groupBy("range", "before").agg(F.min(F.struct("h", F.coalesce("text", F.lit("")).alias("text"), "doc_id", "o")).alias("s"))
    extra = first.select("s.doc_id", "s.text", "s.o", "s.h", F.col("before").alias("range"), F.lit(True).alias("extra"))
    both = ranged.select("doc_id", "text", "o", "h", "range", F.lit(False).alias("extra")).unionByName(extra)
    placed = both.repartitionById(len(heads), "range").sortWithinPartitions(F.col("extra"), F.col("o").desc(), "h", F.coalesce("text", F.lit("")))
    return placed.select("doc_id", "text", "extra").mapInArrow(beside_next, _OUT)


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

"""Toxicity by multiple-instance learning.

Only whole documents are labelled. Each sentence gets a probability from its words; a document's probability is their
noisy-or, 1 - prod(1 - p). Weights of words (hashed) are learned from document labels through the noisy-or, with an
L1 penalty that leaves few of them, and then tell which sentences offend.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import arrow_limits, beside, dropped, sampled

_BITS = 20
_WORD = re.compile(r"\w+")
_STOP = re.compile(r"[.!?\n]+")
_CACHED = 300_000


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by bucket (at most 2**20, those above zero in size only) and the offset of a sentence."""

    weights: dict[int, float]
    offset: float


def bucket(word: str) -> int:
    return crc32(word.encode("utf-8", "surrogatepass")) & ((1 << _BITS) - 1)


def buckets(word: str) -> list[int]:
    """Of the word and of its beginnings of 3 to 9 letters, so that stems count in all their forms."""
    return [bucket(word), *(bucket("^" + word[:k]) for k in range(3, min(len(word), 9) + 1))]


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence: the text between marks . ! ? and line ends."""
    at = 0
    for m in _STOP.finditer(text):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def features(text: str) -> list[np.ndarray]:
    """Distinct buckets of the words of each sentence that has words."""
    low = text.lower()
    return [np.fromiter({x for w in set(ws) for x in buckets(w)}, np.int32) for a, b in sentences(low) if (ws := _WORD.findall(low, a, b))]


def telling(df, bad, rate: float):
    """Whether a feature in df documents, bad of them toxic, may gain weight where the share `rate` of all is toxic."""
    return (bad > 1) & (bad > 1.5 * rate * df)


def train(docs: list[list[np.ndarray]], labels: list[int], steps: int = 200, rate: float = 0.1, l1: float = 0.05, start: float = -7.0) -> ToxicityModel:
    """Adam with a proximal L1 step on the noisy-or likelihood; docs in any fixed order.

    Weights stay at or above zero: a word may make a sentence offend, none excuses it. l1: nats a unit of weight costs.
    Words of a single toxic document, and those hardly commoner in toxic ones, can't gain weight and are left out first. Without toxic rows every score is that of `start`.
    """
    y = np.array(labels, float)
    sizes = [len(s) for d in docs for s in d]
    if not sizes or not y.any():
        return ToxicityModel({}, -12.0)
    ids = np.concatenate([s for d in docs for s in d])
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    pairs = np.unique(doc[of] * (1 << _BITS) + ids)
    df, bad = (np.bincount(pairs & ((1 << _BITS) - 1), weights, 1 << _BITS) for weights in (None, y[pairs >> _BITS]))
    use = telling(df, bad, y.mean())[ids]
    ids, of = ids[use], of[use]
    words, col = np.unique(ids, return_inverse=True)
    w, b = np.zeros(len(words) + 1), start
    w[-1] = start
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(of, w[col], len(sizes)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        q = np.bincount(doc, np.logaddexp(0, z), len(docs))
        lead = np.where(y > 0, np.exp(-q) / np.maximum(-np.expm1(-q), 1e-6), -1.0)
        lead[(y > 0) & (q <= 0)] = 0.0
        gz = p * lead[doc]
        g = np.append(np.bincount(col, gz[of], len(words)), gz.sum()) / len(docs)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        w += step * m / (1 - 0.9**t)
        w[:-1] = np.maximum(w[:-1] - step[:-1] * (l1 / len(docs)), 0)
    return ToxicityModel({int(k): float(x) for k, x in zip(words, w) if abs(x) > 1e-3}, float(w[-1]))


def fit(labelled: DataFrame, label: str = "toxic", text: str = "text", by: str = "doc_id", rows: int = 10_000) -> ToxicityModel:
    """From labelled rows, of which about `rows` are taken by the hash of `by`.

    Features are made on the executors, which first count in how many documents of either label each stands; only those
    that may gain weight come to the driver.

    Rows with a null label or text teach nothing.
    """
    spark = labelled.sparkSession
    arrow_limits(spark)
    known = labelled.where(labelled[label].isNotNull() & labelled[text].isNotNull())
    sample = sampled(known.select(labelled[by].alias("by"), labelled[text].alias("text"), (labelled[label] > 0).cast("int").alias("y")), rows, "by")
    taken = sample.select("y", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            got = [np.unique(np.concatenate(d)) if d else np.zeros(0, np.int32) for d in map(features, b.column(1).to_pylist())]
            ids, inverse = np.unique(np.concatenate(got), return_inverse=True)
            label = np.repeat(y, [len(g) for g in got])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(np.bincount(inverse, minlength=len(ids)), pa.int64()), pa.array(np.bincount(inverse, label, len(ids)).astype(np.int64))], ["b", "df", "bad"])

    rate = taken.agg(F.avg("y")).first()[0] or 0.0
    seen = taken.mapInArrow(count, "b int, df long, bad long").groupBy("b").agg(F.sum("df").alias("df"), F.sum("bad").alias("bad"))
    good = spark.sparkContext.broadcast(seen.where(telling(F.col("df"), F.col("bad"), rate)).select("b").toArrow().column(0).to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells = np.zeros(1 << _BITS, bool)
        tells[good.value] = True
        for b in batches:
            got = [[s[tells[s]] for s in features(x)] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.concatenate(d).tobytes() if d else b"" for d in got], pa.binary()), pa.array([np.array([len(s) for s in d], np.int32).tobytes() for d in got], pa.binary())], ["y", "ids", "sizes"])

    got = sorted((r["y"], bytes(r["ids"]), bytes(r["sizes"])) for r in taken.mapInArrow(run, "y int, ids binary, sizes binary").collect())
    dropped(sample)
    docs = [np.split(np.frombuffer(i, np.int32), np.cumsum(np.frombuffer(n, np.int32))[:-1]) if n else [] for _, i, n in got]
    return train(docs, [y for y, _, _ in got])


class Scorer:
    """Scores texts with a bounded cache of words."""

    def __init__(self, model: ToxicityModel):
        self.model, self.known = model, {}

    def weight(self, word: str) -> tuple[tuple[int, float], ...]:
        """The buckets of the word that carry weight."""
        if len(self.known) > _CACHED:
            self.known.clear()
        self.known[word] = found = tuple((b, w) for b in buckets(word) if (w := self.model.weights.get(b)))
        return found

    def __call__(self, text: str, least: float = 0.5) -> tuple[float, list[dict]]:
        """Noisy-or of the sentences and the spans (code points) of those with probability `least` or more."""
        low, known, weight, offset = text.lower(), self.known.get, self.weight, self.model.offset
        if len(low) != len(text):
            low = "".join([c.lower() if len(c.lower()) == 1 else c for c in text])
        z, spans = [], []
        for a, b in sentences(low):
            words = set(_WORD.findall(low, a, b))
            if not words:
                continue
            hit: dict[int, float] = {}
            for w in words:
                if (k := known(w)) is None:
                    k = weight(w)
                if k:
                    hit.update(k)
            z.append(offset + sum(hit.values()))
            spans.append((a, b))
        if not z:
            return 0.0, []
        z = np.array(z)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return float(-np.expm1(-np.logaddexp(0, z).sum())), [{"start": spans[i][0], "end": spans[i][1], "score": float(p[i])} for i in np.flatnonzero(p >= least)]


def scored(docs: DataFrame, model: ToxicityModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """`row` (all columns of docs), the score of every whole text and its offending sentences (start, end, score).

    Null, empty and wordless texts score 0; repeated rows are scored each; an empty table gives no rows. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def start():
        scorer = Scorer(shared.value)

        def run(texts: list) -> list[pa.Array]:
            got = [scorer(x or "", least) for x in texts]
            return [pa.array([s for s, _ in got], pa.float64()), pa.array([x for _, x in got], span)]

        return run

    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    return beside(docs, start, [T.StructField("score", T.DoubleType()), T.StructField("offending", spans)], text)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: float = 0.5) -> DataFrame:
    """The kept columns, score and offending of every text, as scored()."""
    return scored(docs.select(*keep, *([] if text in keep else [text])), model, text, least).select(*[F.col(f"row.{c}") for c in keep], "score", "offending")

"""Quality by compression: one zstandard dictionary of good text, one of bad text.

A text compresses better with the dictionary of the kind it belongs to. The difference of the two compressed sizes over
their sum, put through a logistic curve fitted on other labelled rows than the dictionaries, is the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import arrow_limits, beside, dropped, sampled


@dataclass(frozen=True)
class CompressionModel:
    """Contents of the two dictionaries, the compression level and the calibration."""

    good: bytes
    bad: bytes
    level: int
    slope: float
    offset: float


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; from texts too few or too short for training, their ends as plain content."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:]


class Sizes:
    """Compressed sizes with either dictionary, summed over blocks of the whole text.

    Blocks keep the dictionaries in play all along a long text, which would otherwise soon be its own dictionary.
    """

    def __init__(self, good: bytes, bad: bytes, level: int, block: int = 512):
        self.block = block
        self.by = []
        for x in (good, bad):
            d = zstandard.ZstdCompressionDict(x) if len(x) >= 8 else None
            if d:
                d.precompute_compress(level=level)
            self.by.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        """(bad - good) / (bad + good): above 0 if the good dictionary serves better; 0 for the empty text."""
        if not text:
            return 0.0
        parts = [text[i : i + self.block] for i in range(0, len(text), self.block)]
        good, bad = (sum([len(c.compress(p)) for p in parts]) for c in self.by)
        return (bad - good) / (bad + good)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the most likely logistic curve, by Newton steps."""
    scale = float(np.std(x)) or 1.0
    u, w = x / scale, np.zeros(2)
    a = np.stack([u, np.ones_like(u)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def constant(labels: list[int], level: int) -> CompressionModel:
    """Without both labels the score is the share of label 1 for every text."""
    share = min(max(sum(labels) / len(labels) if labels else 0.5, 1e-6), 1 - 1e-6)
    return CompressionModel(b"", b"", level, 0.0, math.log(share / (1 - share)))


def dictionaries(texts: list[bytes], labels: list[int], size: int = 110_000, level: int = 1) -> tuple[bytes, bytes]:
    """Dictionaries of good and of bad texts, given in any fixed order."""
    return tuple(_dictionary([t for t, l in zip(texts, labels) if l == k and t], size) for k in (1, 0))


def fit(labelled: DataFrame, label: str = "quality", text: str = "text", by: str = "doc_id", rows: int = 4000, size: int = 110_000, level: int = 1) -> CompressionModel:
    """From labelled rows, of which about `rows` are taken by the hash of `by`: two of three for the dictionaries, whose texts
    come to the driver, the others for the calibration, of which only numbers do.

    Rows with a null label or text teach nothing; other columns may have any name. Without both labels the score is the
    share of label 1, a half without any row.
    """
    spark = labelled.sparkSession
    arrow_limits(spark)
    known = labelled.where(labelled[label].isNotNull() & labelled[text].isNotNull())
    part = F.pmod(F.xxhash64(labelled[by].cast("string"), F.lit(3)), F.lit(3))
    taken = sampled(known.select(labelled[by].alias("by"), labelled[text].alias("text"), (labelled[label].cast("int") > 0).cast("int").alias("y"), part.alias("part")), rows, "by")
    counts = {r["y"]: r["count"] for r in taken.groupBy("y").count().collect()}
    if len(counts) < 2:
        dropped(taken)
        return constant([k for k, n in counts.items() for _ in range(n)], level)
    got = sorted((r["y"], r["text"]) for r in taken.where("part < 2").select("y", "text").collect())
    good, bad = dictionaries([t.encode() for _, t in got], [y for y, _ in got], size, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad, level)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sizes.difference(x.encode()) for x in b.column(1).to_pylist()], pa.float64())], ["y", "x"])

    for apart in ("part = 2", "true"):  # all rows where those kept apart have one label only
        seen = sorted((r["y"], r["x"]) for r in taken.where(apart).select("y", "text").mapInArrow(run, "y int, x double").collect())
        if len({y for y, _ in seen}) == 2:
            break
    dropped(taken)
    slope, offset = _logistic(np.array([x for _, x in seen]), np.array([float(y) for y, _ in seen]))
    return CompressionModel(good, bad, level, slope, offset)


def score(docs: DataFrame, model: CompressionModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and the probability of good text, `score`, for every whole text; one pass, no shuffle.

    Null and empty texts count as difference 0 and get the curve's value there; repeated rows are scored each; an empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        sizes = Sizes(m.good, m.bad, m.level)
        return lambda texts: [pa.array([1 / (1 + math.exp(-min(max(m.slope * sizes.difference((x or "").encode()) + m.offset, -500), 500))) for x in texts], pa.float64())]

    found = beside(docs.select(*keep, *([] if text in keep else [text])), start, [T.StructField("score", T.DoubleType())], text)
    return found.select(*[F.col(f"row.{c}") for c in keep], "score")

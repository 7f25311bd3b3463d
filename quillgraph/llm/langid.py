"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned by follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties, which leaves most of them
zero; a temperature fitted on rows kept apart calibrates the probabilities. One to three letters make an n-gram; every
other character counts as a blank. N-grams are hashed into a fixed number of buckets, so the model's size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import arrow_limits, beside, cut

#: What a text without a letter gets.
UNDETERMINED = "und"
_BITS = 15
_MIX = np.uint32(0x9E3779B1)
_WINDOW = 1 << 17
_LETTERS: list[np.ndarray] = []


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, a weight for each bucket and language (IDF included), an offset each, the temperature."""

    langs: tuple[str, ...]
    weights: np.ndarray
    offset: np.ndarray
    temperature: float


def _letters() -> np.ndarray:
    """Code points below 65,536: themselves if letters, else a blank."""
    if not _LETTERS:
        _LETTERS.append(np.array([i if chr(i).isalpha() else 32 for i in range(1 << 16)], np.uint32))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and blanks of all texts in one array, where each text starts, and whether each holds a letter."""
    low = [x.lower() + "  " for x in texts]
    cps = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = _letters()[np.minimum(cps, 0xFFFF)]
    high = np.flatnonzero(cps >= 1 << 16)
    if len(high):
        each, at = np.unique(cps[high], return_inverse=True)
        seen[high] = np.array([c if chr(c).isalpha() else 32 for c in each.tolist()], np.uint32)[at]
    starts = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(x) for x in low], out=starts[1:])
    return seen, starts, np.add.reduceat(seen != 32, starts[:-1]) > 0 if len(low) else np.zeros(0, bool)


def buckets(seen: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the one, two and three characters that start at each place; zeros follow after the last and at `ends`.

    So no n-gram runs into the next text, and what a text gets is the same whatever stands beside it.
    """
    out, h = [], np.zeros(len(seen), np.uint32)
    for n in range(3):
        nxt = np.zeros(len(seen), np.uint32)
        nxt[: max(len(seen) - n, 0)] = seen[n:]
        for k in range(n if ends is not None else 0):
            at = ends - 1 - k
            nxt[at[(at >= 0) & (at < len(seen))]] = 0
        h = (h ^ nxt) * _MIX
        h ^= h >> np.uint32(15)
        out.append(((h + np.uint32(n + 1)) * _MIX) >> np.uint32(32 - _BITS))
    return tuple(out)


def sums(seen: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each text the sum over its n-grams of their weights; window by window, so memory is bounded."""
    total = np.zeros((len(starts) - 1, weights.shape[1]))
    for a in range(0, len(seen), _WINDOW):
        b = min(a + _WINDOW, len(seen))
        part = np.zeros((b - a, weights.shape[1]), np.float32)
        for ids in buckets(seen[a : b + 2], starts[1:] - a):
            part += weights[ids[: b - a]]
        first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left")
        cuts = np.maximum(starts[first:last] - a, 0)
        total[first:last] += np.add.reduceat(part.astype(np.float64), cuts, axis=0)
    return total


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and their shares of its n-grams."""
    seen, _, _ = grams([text])
    ids, n = np.unique(np.concatenate(buckets(seen)), return_counts=True)
    return ids.astype(np.int32), (n / n.sum()).astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, scale: float = 20.0) -> LanguageModel:
    """FTRL-proximal over rows (language, buckets, shares) in the order given; every fifth row calibrates instead."""
    langs = tuple(sorted({r[0] for r in rows}))
    if not langs:
        return LanguageModel((), np.zeros((1 << _BITS, 0), np.float32), np.zeros(0), 1.0)
    fit = [r for i, r in enumerate(rows) if i % 5] or rows
    kept = rows[::5]
    z, n = np.zeros((1 << _BITS, len(langs))), np.zeros((1 << _BITS, len(langs)))
    zb, nb = np.zeros(len(langs)), np.zeros(len(langs))

    def solved(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for lang, ids, share in fit:
            x = share * idf[ids] * scale
            w, wb = solved(z[ids], n[ids], l1), solved(zb, nb, 0.0)
            g = _softmax(x @ w + wb)
            g[langs.index(lang)] -= 1
            gw = x[:, None] * g
            z[ids] += gw - (np.sqrt(n[ids] + gw**2) - np.sqrt(n[ids])) / alpha * w
            n[ids] += gw**2
            zb += g - (np.sqrt(nb + g**2) - np.sqrt(nb)) / alpha * wb
            nb += g**2
    w = solved(z, n, l1) * (idf * scale)[:, None]
    b = solved(zb, nb, 0.0)
    logits = np.stack([share @ w[ids] + b for _, ids, share in kept])
    truth = np.array([langs.index(r[0]) for r in kept])
    tries = np.exp(np.linspace(np.log(0.2), np.log(20), 80))
    nll = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tries]
    return LanguageModel(langs, w.astype(np.float32), b, float(tries[int(np.argmin(nll))]))


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, df) over all texts of a task: in how many of them each bucket is; bucket -1 counts the texts."""
    total, n = np.zeros(1 << _BITS, np.int64), 0
    for b in batches:
        seen, starts, _ = grams(b.column(0).to_pylist())
        n += len(starts) - 1
        for s, e in zip(starts[:-1], starts[1:]):
            has = np.zeros(1 << _BITS, bool)
            for a in range(s, e, _WINDOW):
                for ids in buckets(seen[a : min(a + _WINDOW + 2, e)]):
                    has[ids[: min(_WINDOW, e - a)]] = True
            total += has
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], ["bucket", "df"])


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", by: str = "doc_id", rows: int = 2000, langs: int = 256) -> LanguageModel:
    """From rows with non-null text and language; of each language about rows / languages are taken by the hash of `by`.

    Document frequencies are counted over all these rows, weights are fitted on those taken. N-grams are counted on the
    executors; the driver gets at most 2**15 buckets for each row taken. `langs` bounds the languages learned, the most
    frequent ones (by name among equals). Other columns may have any name. Without rows each text is UNDETERMINED.
    """
    known = labelled.select(labelled[by].cast("string").alias("by"), labelled[lang].cast("string").alias("lang"), labelled[text].alias("text")).where("lang is not null and text is not null")
    arrow_limits(known.sparkSession)
    each = cut(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(langs))
    most = each.count()
    if not most:
        return train([], np.ones(1 << _BITS))
    # a row for each of `langs` languages at most
    known = known.join(F.broadcast(each), "lang")
    share = F.least(F.lit(1.0), F.lit(rows / most) / F.col("count"))
    taken = known.where(F.pmod(F.xxhash64(F.coalesce("by", F.lit("")), F.lit(2026)), F.lit(1 << 20)) < (share * (1 << 20)).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [counts(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([s.tobytes() for _, s in got], pa.binary())], ["lang", "ids", "shares"])

    got = taken.select("lang", "text").mapInArrow(run, "lang string, ids binary, shares binary").collect()
    order = sorted(((r["lang"], bytes(r["ids"]), bytes(r["shares"])) for r in got), key=lambda r: (hash_bytes(r[1] + r[2]), r[0]))
    df = {r["bucket"]: r["df"] for r in known.select("text").mapInArrow(frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()}  # 2**15 and one rows
    seen = np.array([df.get(i, 0) for i in range(1 << _BITS)])
    idf = np.log((1 + df.get(-1, 0)) / (1 + seen)) + 0.1
    return train([(a, np.frombuffer(i, np.int32), np.frombuffer(s, np.float32)) for a, i, s in order], idf)


def hash_bytes(x: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(x, 7)


def predict(texts: list[str | None], m: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and calibrated probability of each text; UNDETERMINED and 0 for null and for texts without a letter."""
    seen, starts, letter = grams([x or "" for x in texts])
    if not texts or not m.langs:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    n = 3 * np.diff(starts)
    p = _softmax((sums(seen, starts, m.weights) / n[:, None] + m.offset) / m.temperature)
    best = p.argmax(1)
    return [m.langs[k] if ok else UNDETERMINED for k, ok in zip(best, letter)], [float(x) if ok else 0.0 for x, ok in zip(p.max(1), letter)]


def identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`row` (all columns of docs), lang_pred and score of every whole text; one pass, no shuffle, rows as they come.

    Null texts and texts without a letter are UNDETERMINED with score 0; among equally likely languages the first by name
    is taken; repeated rows are judged each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def run(texts: list) -> list[pa.Array]:
            lang, p = predict(texts, shared.value)
            return [pa.array(lang, pa.string()), pa.array(p, pa.float64())]

        return run

    return beside(docs, start, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score of every text, as identified()."""
    return identified(docs.select(*keep, *([] if text in keep else [text])), model, text).select(*[F.col(f"row.{c}") for c in keep], "lang_pred", "score")

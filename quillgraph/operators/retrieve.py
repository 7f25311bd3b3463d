"""Exact nearest neighbours by squared Euclidean distance, and contexts made of what they find."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries in one pass over the vectors; they are literals of the plan.
BLOCK = 64


class Embedder(Protocol):
    def __call__(self, texts: Sequence[str]) -> np.ndarray: ...


def hashed_words(dim: int = 64) -> Embedder:
    """The offline default: counts of hashed words at length 1."""
    from zlib import crc32

    def embed(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, x in enumerate(texts):
            for w in (x or "").lower().split():
                out[i, crc32(w.encode()) % dim] += 1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return embed


def embedded(chunks: DataFrame, embed: Embedder, text: str = "text") -> DataFrame:
    """chunks with `vector`, in Arrow batches."""

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series(list(embed(texts.fillna("").tolist())))

    return chunks.withColumn("vector", vectors(text))


def squared_distance(vector: Column, query: Sequence[float]) -> Column:
    """In double precision, summed from the first component on."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return F.aggregate(F.zip_with(vector, q, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, query: Sequence[float], k: int = 4, id_: str = "id") -> DataFrame:
    """(rank, id, d2) of the k nearest, ties by id: a bounded heap in each partition."""
    near = vectors.select(F.col(id_).alias("id"), squared_distance(F.col("vector"), query).alias("d2")).orderBy("d2", "id").limit(k)
    return near.withColumn("rank", F.row_number().over(Window.orderBy("d2", "id"))).select("rank", "id", "d2")


def nearest_of_each(vectors: DataFrame, queries: Sequence[tuple[int, Sequence[float]]], k: int = 4, id_: str = "id") -> DataFrame:
    """(query, rank, id, d2): the k nearest of each stated query, in one pass for each block of queries.

    The rank filter is pushed below the shuffle (a group limit in each partition), so only k rows of each query and
    partition move.
    """
    out = None
    for i in range(0, len(queries), BLOCK):
        each = F.array(*[F.struct(F.lit(q).cast("long").alias("query"), squared_distance(F.col("vector"), v).alias("d2")) for q, v in queries[i : i + BLOCK]])
        scored = vectors.select(F.col(id_).alias("id"), F.explode(each).alias("s")).select("s.query", "id", "s.d2")
        ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("d2", "id"))).where(F.col("rank") <= k)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        raise ValueError("no query")
    return out.select("query", "rank", "id", "d2")


def context(representatives: DataFrame, retrieved: Column | None = None, glue: str = "\n\n") -> DataFrame:
    """(doc_id, section_ord, context): the texts of a section's picks in order, then what was retrieved, empty parts left out."""
    grouped = representatives.groupBy("doc_id", "section_ord").agg(F.array_sort(F.collect_list(F.struct("pick", "text"))).alias("p"))
    parts = F.col("p.text") if retrieved is None else F.concat(F.col("p.text"), retrieved)
    return grouped.select("doc_id", "section_ord", F.array_join(F.filter(parts, lambda x: x != ""), glue).alias("context"))

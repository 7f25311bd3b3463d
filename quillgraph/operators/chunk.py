"""Chunks of documents and the outline of sections over them.

chunks: (doc_id, chunk_idx, text), one row per chunk; the position is a column, so no order of rows matters.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx


def whitespace_tokens(c: Column) -> Column:
    """Words, each with the white space after it, so that neighbours put together are the text again."""
    return F.regexp_extract_all(c, F.lit(r"[^\x09-\x0D\x20]+[\x09-\x0D\x20]*"), 0)


def token_windows(docs: DataFrame, size: int = 1200, overlap: int = 150, tokens: Callable[[Column], Column] = whitespace_tokens) -> DataFrame:
    """Windows of `size` tokens that share `overlap`; the last is the first to reach the end; blank ones are dropped.

    tokens: pieces of the text in order, with its white space; lines and paragraphs stay as they are, only what is blank at a
    window's end goes. A projection and a generator: no shuffle. Null and blank texts have no chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    words = docs.select("doc_id", tokens(F.col("text")).alias("t")).where(F.size("t") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("t") - overlap - 1, F.lit(0)), F.lit(size - overlap))
    window = lambda s: F.regexp_replace(F.array_join(F.slice("t", s + 1, F.lit(size)), ""), r"[\x09-\x0D\x20]+\z", "")
    texts = F.filter(F.transform(starts, window), lambda x: ~tx.is_blank(x))
    return words.select("doc_id", F.posexplode(texts).alias("chunk_idx", "text"))


# Separators in the order they are tried.
SEPARATORS = ("\n\n", "\n", ". ", ".", " ")


def split_recursively(text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most `size` characters where a separator allows it, neighbours sharing up to `overlap` characters.

    The first separator that occurs cuts the text, each piece keeping the separator in front; pieces are gathered up to the
    size; a piece still too long is cut by the separators after that one, and stays whole if there is none.
    """
    at = next((i for i, s in enumerate(separators) if s in text), None)
    if at is None:
        return [text.strip()] if text.strip() else []
    head, *tail = text.split(separators[at])
    pieces = [p for p in (head, *(separators[at] + t for t in tail)) if p]
    out: list[str] = []
    gathered: list[str] = []

    def close() -> None:
        whole = "".join(gathered).strip()
        if whole:
            out.append(whole)

    for p in pieces:
        if len(p) >= size:
            if gathered:
                close()
                gathered = []
            out += split_recursively(p, size, overlap, separators[at + 1 :])
            continue
        if gathered and sum(map(len, gathered)) + len(p) > size:
            close()
            while gathered and (sum(map(len, gathered)) > overlap or sum(map(len, gathered)) + len(p) > size):
                gathered.pop(0)
        gathered.append(p)
    if gathered:
        close()
    return out


def recursive_chunks(docs: DataFrame, size: int = 1200, overlap: int = 150) -> DataFrame:
    """Character chunks by separators, for texts without a tokenizer; sequential within a document, so a pandas UDF."""

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: split_recursively(x, size, overlap) if x else [])

    return docs.select("doc_id", F.posexplode(pieces("text")).alias("chunk_idx", "text"))


def sections(chunks: DataFrame) -> DataFrame:
    """(doc_id, section_ord, title, chunk_indices): a heading opens a section; what comes before the first is Introduction.

    Gaps and islands: a running count of headings numbers the sections of a document; one shuffle by doc_id.
    """
    line = tx.first_line(F.col("text"))
    marked = chunks.select("doc_id", "chunk_idx", F.coalesce(tx.is_heading(line), F.lit(False)).alias("opens"), tx.title(F.col("text")).alias("title"))
    order = Window.partitionBy("doc_id").orderBy("chunk_idx")
    numbered = marked.withColumn("n", F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = numbered.withColumn("section_ord", F.col("n") - F.min("n").over(Window.partitionBy("doc_id")))
    grouped = numbered.groupBy("doc_id", "section_ord").agg(F.max(F.when(F.col("opens"), F.col("title"))).alias("title"), F.array_sort(F.collect_list("chunk_idx")).alias("chunk_indices"))
    return grouped.select("doc_id", "section_ord", F.coalesce("title", F.lit("Introduction")).alias("title"), "chunk_indices")


def or_default_section(outline: DataFrame, chunks: DataFrame) -> DataFrame:
    """The outline, and for documents that have none one section `all` with every chunk."""
    rest = chunks.join(outline.select("doc_id").distinct(), "doc_id", "left_anti")
    whole = rest.groupBy("doc_id").agg(F.array_sort(F.collect_list("chunk_idx")).alias("chunk_indices"))
    return outline.unionByName(whole.select("doc_id", F.lit(0).alias("section_ord"), F.lit("all").alias("title"), "chunk_indices"), allowMissingColumns=False)


def representatives(outline: DataFrame, most: int = 8) -> DataFrame:
    """(doc_id, section_ord, title, pick, chunk_idx): of the first sections the first chunk, of those with more than two
    also the middle and the last."""
    n = F.size("chunk_indices")
    picks = F.when(n > 2, F.array(F.get("chunk_indices", F.lit(0)), F.get("chunk_indices", (n / 2).cast("int")), F.get("chunk_indices", n - 1))).when(n > 0, F.slice("chunk_indices", 1, 1)).otherwise(F.array().cast("array<int>"))
    return outline.where(F.col("section_ord") < most).select("doc_id", "section_ord", "title", F.posexplode(picks).alias("pick", "chunk_idx"))


def batches(chunks: DataFrame, size: int = 5, glue: str = "\n\n") -> DataFrame:
    """(doc_id, batch, text): consecutive chunks joined."""
    grouped = chunks.groupBy("doc_id", F.floor(F.col("chunk_idx") / size).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("chunk_idx", "text"))).alias("c"))
    return grouped.select("doc_id", "batch", F.array_join(F.col("c.text"), glue).alias("text"))

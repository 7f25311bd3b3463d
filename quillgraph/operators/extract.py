"""Entities: found by pattern, read from model answers, coerced, sieved, and deduplicated first-wins.

entities: (ord, name, type, description, inputs, outputs [, id, romanian]); ord carries the order that first-wins needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import jsonx
from quillgraph.functions import text as tx

# Vocabularies and the pattern of a definition.
HEURISTIC_TYPES = ("component", "module", "system", "process", "circuit", "unit", "network", "layer", "function", "agent", "entity")
ALLOWED_TYPES = ("component", "module", "system", "process", "circuit", "unit", "network", "layer", "function", "agent", "model")
STOP_PARTS = ("author", "autori", "bibliography", "preface", "introduc", "chapter", "capitol", "appendix", "isbn", "copyright")
DEFINITION = r"([A-Za-zăâîșțĂÂÎȘȚ\-\s]+)\s+is\s+(a|an|the)\s+([A-Za-z\-\s]+)\s+that\s+(.*)"

_SENTENCE = "(?iuU)(?d)" + DEFINITION


def by_pattern(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, sentence_idx, name, type, description: the first `X is a Y that Z` of each sentence, if long enough."""
    s = texts.select(*keys, F.posexplode(tx.sentences(F.col("text"))).alias("sentence_idx", "s"))
    part = lambda i: F.regexp_extract("s", _SENTENCE, i)
    kind = F.lower(tx.strip(part(3)))
    found = s.where(F.col("s").rlike(_SENTENCE)).select(
        *keys,
        "sentence_idx",
        tx.strip(part(1)).alias("name"),
        F.when(kind.isin(*HEURISTIC_TYPES), kind).otherwise("other").alias("type"),
        F.regexp_replace(tx.strip(part(4)), r"\.+$", "").alias("description"),
    )
    return found.where(F.length("name").between(3, 120) & (F.length("description") >= 3))


def from_answers(responses: DataFrame, field: str = "entities") -> DataFrame:
    """Rows of `responses` (unit, sample_idx, text) with pos and e (VARIANT): each object in the answer's array.

    Answers that are no JSON, hold no object or have no such array give no row.
    """
    v = jsonx.robust(F.col("text"))
    got = responses.select("unit", "sample_idx", F.try_variant_get(v, f"$.{field}", "array<variant>").alias("a"))
    return got.select("unit", "sample_idx", F.posexplode("a").alias("pos", "e"))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def coerced(raw: DataFrame, e: str = "e") -> DataFrame:
    """Columns of an entity from a VARIANT: name or id as text, type or component, arrays or none, text or empty."""
    v = F.col(e)
    text = lambda f: F.try_variant_get(v, f"$.{f}", "string")
    given = lambda f: F.nullif(text(f), F.lit(""))
    array = lambda f: F.when(_kind(F.try_variant_get(v, f"$.{f}", "variant")).startswith("ARRAY"), F.try_variant_get(v, f"$.{f}", "array<string>")).otherwise(F.array().cast("array<string>"))
    return raw.where(v.isNotNull() & ~F.is_variant_null(v)).select(
        *[c for c in raw.columns if c != e],
        F.coalesce(given("name"), given("id"), F.lit("")).alias("name"),
        F.coalesce(given("type"), F.lit("component")).alias("type"),
        F.when(_kind(F.try_variant_get(v, "$.description", "variant")) == "STRING", text("description")).otherwise("").alias("description"),
        array("inputs").alias("inputs"),
        array("outputs").alias("outputs"),
    )


def has_stop_part(*columns: Column) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.lower(c).rlike("|".join(STOP_PARTS)), F.lit(False))
    return out


def type_allowed(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).isin("") | F.lower(c).isin(*ALLOWED_TYPES)


def relevant(entities: DataFrame) -> DataFrame:
    """Without stop parts in name or description, of an allowed type or none, with a name of 2 to 60 characters."""
    return entities.where(~has_stop_part(F.col("name"), F.col("description")) & type_allowed(F.col("type")) & F.length(F.coalesce("name", F.lit(""))).between(2, 60))


def first_of_each(entities: DataFrame, *within: str, order: str = "ord") -> DataFrame:
    """One row for each (name, type), nulls equal, the first by order; `within` keeps batches apart."""
    w = Window.partitionBy(*within, "name", "type").orderBy(order)
    return entities.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def union_of_samples(raw: DataFrame) -> DataFrame:
    """raw rows (unit, sample_idx, pos, ...) with ord: samples one after the other within each unit."""
    return raw.withColumn("ord", F.row_number().over(Window.partitionBy("unit").orderBy("sample_idx", "pos")) - 1)


def section_mode(raw: DataFrame) -> DataFrame:
    """Coerced, sieved, deduplicated over everything; raw: (ord, e)."""
    return first_of_each(relevant(coerced(raw)))


def full_mode(raw: DataFrame) -> DataFrame:
    """Coerced, deduplicated within each batch; the sieve comes after this table is cached. raw: (batch, ord, e)."""
    return first_of_each(coerced(raw), "batch")

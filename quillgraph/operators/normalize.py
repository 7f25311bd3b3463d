"""Normalised entities and the deterministic task filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators.extract import has_stop_part, type_allowed


def normalized(entities: DataFrame) -> DataFrame:
    """entities with id (snake case of the name) and romanian (the name); a null name becomes entity_<ord>."""
    name = F.coalesce("name", F.concat(F.lit("entity_"), F.col("ord").cast("string")))
    return entities.withColumns({"id": tx.snake(name), "romanian": name})


def from_answer(raw: DataFrame) -> DataFrame:
    """Columns of an answered entity: trimmed name or id, id recomputed from it, romanian trimmed (null if empty)."""
    nm = tx.strip(F.coalesce(F.nullif(F.col("name"), F.lit("")), F.nullif(F.col("id"), F.lit("")), F.lit("")))
    return raw.withColumns({"id": tx.snake(nm), "romanian": F.coalesce(F.nullif(tx.strip(F.col("romanian")), F.lit("")), F.col("romanian"))})


def fits_task(entities: DataFrame):
    """Condition: no stop parts, type allowed or empty, and some input or output or a description of 12 characters."""
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    text = F.coalesce(F.col("description"), F.lit(""))
    name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id")) if "id" in entities.columns else F.col("name")
    return ~has_stop_part(name, text) & type_allowed(F.col("type")) & ((size("inputs") + size("outputs") > 0) | (F.length(text) >= 12))


def task_filter(entities: DataFrame) -> DataFrame:
    return entities.where(fits_task(entities))


def filter_or_all(entities: DataFrame, keep, *within: str) -> DataFrame:
    """Rows that meet `keep`, or all rows (of the same `within`) if none does.

    With `within` one window; without, the total is one aggregate joined back as a single row, so no task gets all rows.
    """
    if within:
        marked = entities.withColumn("__keep", keep).withColumn("__any", F.max("__keep").over(Window.partitionBy(*within)))
        return marked.where("__keep OR NOT __any").drop("__keep", "__any")
    some = entities.where(keep).limit(1).agg(F.count(F.lit(1)).alias("__some"))
    return entities.where(keep | (some.scalar() == 0))

"""Nodes, edges, referential check, and precision and recall against a gold set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nodes(entities: DataFrame) -> DataFrame:
    """(ord, id, name, romanian, function, inputs, outputs, type): the name shown is the id."""
    none = F.array().cast("array<string>")
    return entities.select(
        "ord",
        "id",
        F.col("id").alias("name"),
        F.coalesce("romanian", "name").alias("romanian"),
        F.coalesce("description", F.lit("")).alias("function"),
        F.coalesce("inputs", none).alias("inputs"),
        F.coalesce("outputs", none).alias("outputs"),
        F.coalesce("type", F.lit("component")).alias("type"),
    )


def edges(relations: DataFrame) -> DataFrame:
    return relations.select(*[c for c in ("ord",) if c in relations.columns], "from", "to", F.coalesce("label", F.lit("")).alias("label"))


def dangling(edges_: DataFrame, nodes_: DataFrame) -> DataFrame:
    """(ord, side, error): up to two errors for each edge, first the unknown `from`, then the unknown `to`.

    edges: (ord, from, to). An anti join on the distinct known ids; empty and null ids are unknown.
    """
    known = nodes_.where(F.col("id").isNotNull() & (F.col("id").cast("string") != "")).select("id").distinct()
    ends = edges_.select("ord", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("from").alias("id")), F.struct(F.lit(1).alias("side"), F.col("to").alias("id")))).alias("e")).select("ord", "e.side", "e.id")
    shown = F.coalesce(F.col("id").cast("string"), F.lit("None"))
    error = F.concat(F.when(F.col("side") == 0, "Edge from '").otherwise("Edge to '"), shown, F.lit("' not in nodes"))
    return ends.join(known, "id", "left_anti").select("ord", "side", error.alias("error"))


def validation_report(errors: DataFrame) -> DataFrame:
    """(report): one row; the errors in order of edge and side, or that there are none."""
    head = "Validation Report\n==================\n\n"
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "side", "error"))), lambda e: F.concat(F.lit("- "), e["error"])), "\n")
    return errors.agg(F.concat(F.lit(head), F.when(F.count(F.lit(1)) == 0, "No issues detected.").otherwise(F.concat(F.lit("Errors:\n"), lines)), F.lit("\n")).alias("report"))


def precision_recall(retrieved: DataFrame, gold: DataFrame, *keys: str) -> DataFrame:
    """(precision, recall, retrieved, gold) of two sets of keys: one row; 0 and 0 if either set is empty."""
    r = retrieved.select(*keys).distinct().withColumn("__s", F.lit(1))
    g = gold.select(*keys).distinct().withColumn("__s", F.lit(2))
    each = r.unionByName(g).groupBy(*keys).agg(F.sum("__s").alias("s"))
    n = lambda *of: F.count_if(F.col("s").isin(*of))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return each.agg(share(n(3), n(1, 3)).alias("precision"), F.when(n(1, 3) > 0, share(n(3), n(2, 3))).otherwise(0.0).alias("recall"), n(1, 3).alias("retrieved"), n(2, 3).alias("gold"))


def evaluation(entities: DataFrame, edges_: DataFrame, gold_entities: DataFrame, gold_edges: DataFrame) -> DataFrame:
    """Two rows, entities (by id; empty retrieved ids do not count) and edges (by from, to, label)."""
    ids = entities.where(F.col("id").isNotNull() & (F.col("id").cast("string") != ""))
    what: Column = F.lit("entities").alias("kind")
    one = precision_recall(ids, gold_entities, "id").select(what, "*")
    two = precision_recall(edges_, gold_edges, "from", "to", "label").select(F.lit("edges").alias("kind"), "*")
    return one.unionByName(two)

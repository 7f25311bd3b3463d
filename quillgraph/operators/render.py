"""Graphs as PlantUML, DOT and Markdown: a line or two for each row, then one ordered string.

The lines stay a table until the last step, which by its nature makes one string of a whole graph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx


def _joined(lines: DataFrame, name: str, head: str, tail: str) -> DataFrame:
    body = F.array_join(F.col("l.line"), "\n")
    return lines.agg(F.array_sort(F.collect_list(F.struct("part", "ord", "line"))).alias("l")).select(F.concat_ws("\n", F.lit(head), F.when(F.size("l") > 0, body), F.lit(tail)).alias(name))


def _differs() -> Column:
    return (F.col("romanian") != "") & (F.col("romanian") != F.col("name"))


def puml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, ord, line); quotes stay as they are."""
    label = F.concat(F.lit("["), F.col("name"), F.lit("]"))
    n = F.when(_differs(), F.concat(label, F.lit(' as "'), F.col("name"), F.lit(" ("), F.col("romanian"), F.lit(')"'))).otherwise(label)
    arrow = F.concat(F.lit("["), F.coalesce("from", F.lit("None")), F.lit("] -->> ["), F.coalesce("to", F.lit("None")), F.lit("]"))
    e = F.when(F.coalesce("label", F.lit("")) != "", F.concat(arrow, F.lit(" : "), F.col("label"))).otherwise(arrow)
    return nodes.select(F.lit(0).alias("part"), F.col("ord").cast("long").alias("ord"), n.alias("line")).unionByName(edges.select(F.lit(1).alias("part"), F.col("ord").cast("long").alias("ord"), e.alias("line")))


def puml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(diagram): PlantUML without a final newline."""
    return _joined(puml_lines(nodes, edges), "diagram", "@startuml", "@enduml")


def dot_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    label = F.when(_differs(), F.concat(F.col("name"), F.lit(" ("), F.col("romanian"), F.lit(")"))).otherwise(F.col("name"))
    n = F.concat(F.lit('  "'), F.coalesce("id", F.lit("None")), F.lit('" [label="'), tx.quoted(label), F.lit('"];'))
    arrow = F.concat(F.lit('  "'), F.coalesce("from", F.lit("None")), F.lit('" -> "'), F.coalesce("to", F.lit("None")), F.lit('"'))
    e = F.concat(arrow, F.when(F.coalesce("label", F.lit("")) != "", F.concat(F.lit(' [label="'), tx.quoted(F.col("label")), F.lit('"]'))).otherwise(""), F.lit(";"))
    return nodes.select(F.lit(0).alias("part"), F.col("ord").cast("long").alias("ord"), n.alias("line")).unionByName(edges.select(F.lit(1).alias("part"), F.col("ord").cast("long").alias("ord"), e.alias("line")))


def dot(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return _joined(dot_lines(nodes, edges), "diagram", "digraph G {\n  rankdir=LR;\n  node [shape=box];", "}")


def diagram(nodes: DataFrame, edges: DataFrame, form: str = "plantuml") -> DataFrame:
    """DOT if asked for, else PlantUML."""
    return dot(nodes, edges) if form.lower() == "dot" else puml(nodes, edges)


def markdown_entries(nodes: DataFrame) -> DataFrame:
    """(ord, entry): heading, responsibility, inputs, outputs of each node."""
    shown = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id"))
    heading = F.concat(F.lit("## "), shown, F.when((F.col("romanian") != "") & (F.col("romanian") != shown), F.concat(F.lit(" ("), F.col("romanian"), F.lit(")"))).otherwise(""))
    return nodes.select("ord", F.concat_ws("\n", heading, F.concat(F.lit("**Responsibility**: "), F.coalesce("function", F.lit(""))), F.concat(F.lit("**Inputs**: "), tx.joined(F.col("inputs"))), F.concat(F.lit("**Outputs**: "), tx.joined(F.col("outputs")))).alias("entry"))


def markdown(nodes: DataFrame) -> DataFrame:
    """(markdown): entries with a blank line between, trimmed, one newline at the end."""
    body = F.array_join(F.col("e.entry"), "\n\n")
    return markdown_entries(nodes).agg(F.array_sort(F.collect_list(F.struct("ord", "entry"))).alias("e")).select(F.concat(tx.strip(body), F.lit("\n")).alias("markdown"))

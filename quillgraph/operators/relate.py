"""Links between entities by what they put out and take in, and votes over sampled answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx


def similar_terms(terms: DataFrame, others: DataFrame, least: float = 0.62) -> DataFrame:
    """(x, y, sim) for distinct terms x and y whose token Jaccard is at least `least` (above 0).

    An exact equi-join: such terms share a token, and of the shared ones also the smallest of their rarest tokens (a prefix
    as long as the threshold allows). Frequencies are counted on both sides together.
    """
    if not 0 < least <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")

    def sets(t: DataFrame) -> DataFrame:
        return t.select("term").distinct().select("term", tx.io_tokens(F.col("term")).alias("t")).where(F.size("t") > 0)

    a, b = sets(terms), sets(others)
    freq = a.unionByName(b).select(F.explode("t").alias("w")).groupBy("w").count()

    def prefixes(s: DataFrame, term: str, n: str, t: str) -> DataFrame:
        ranked = s.select("term", F.size("t").alias("n"), F.explode("t").alias("w")).join(freq, "w").groupBy("term", "n").agg(F.array_sort(F.collect_list(F.struct("count", "w"))).alias("s"))
        first = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9).cast("int") + 1
        return ranked.select(F.col("term").alias(term), F.col("n").alias(n), F.col("s.w").alias(t), F.explode(F.slice(F.col("s.w"), F.lit(1), F.greatest(first, F.lit(1)))).alias("w"))

    both = prefixes(a, "x", "nx", "tx").join(prefixes(b, "y", "ny", "ty"), "w")
    both = both.where((F.col("ny") >= F.lit(least) * F.col("nx") - 1e-9) & (F.col("nx") >= F.lit(least) * F.col("ny") - 1e-9))
    return both.withColumn("sim", tx.jaccard(F.col("tx"), F.col("ty"))).where(F.col("sim") >= least).select("x", "y", "sim").distinct()


def io_links(entities: DataFrame, least: float = 0.62) -> DataFrame:
    """(from, to, label, sim), a bag: each output of one row and each similar input of another row; label is the output.

    Terms are compared once each, however many rows share them; rows are told apart by ord, so equal ids may link.
    """
    outs, ins = _ends(entities)
    near = similar_terms(outs.select(F.col("x").alias("term")), ins.select(F.col("y").alias("term")), least)
    return outs.join(near, "x").join(ins, "y").where("o1 <> o2").select("from", "to", F.col("x").alias("label"), "sim")


def _ends(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(o1, from, x) of every output and (o2, to, y) of every input."""
    outs = entities.select(F.col("ord").alias("o1"), F.coalesce("id", F.lit("None")).alias("from"), F.explode("outputs").alias("x"))
    ins = entities.select(F.col("ord").alias("o2"), F.coalesce("id", F.lit("None")).alias("to"), F.explode("inputs").alias("y"))
    return outs, ins


def strongest_io_links(entities: DataFrame, least: float = 0.62, most: int = 200) -> DataFrame:
    """What strongest(io_links(entities, least), most) gives, without the whole bag of links, which a common term squares.

    Of the rows of a term only the first `most` + 1 by name are joined. The links of any other row come after or equal `most`
    links of those, one for each but the row that may be the other end itself. Repeats are counted, and unfolded last. The
    ranks are cut in every partition before they are shuffled, so a term of all rows moves `most` + 1 rows a partition.
    """

    def first(rows: DataFrame, ord_: str, name: str, term: str, n: str) -> DataFrame:
        counted = rows.groupBy(ord_, name, term).agg(F.count(F.lit(1)).alias(n))
        rank = F.row_number().over(Window.partitionBy(term).orderBy(name, ord_))
        return counted.withColumn("rank", rank).where(F.col("rank") <= most + 1).drop("rank")

    outs, ins = _ends(entities)
    near = similar_terms(outs.select(F.col("x").alias("term")), ins.select(F.col("y").alias("term")), least)
    links = first(outs, "o1", "from", "x", "n1").join(near, "x").join(first(ins, "o2", "to", "y", "n2"), "y").where("o1 <> o2")
    times = F.least(F.col("n1") * F.col("n2"), F.lit(most)).cast("int")
    counted = strongest(links.select("from", "to", F.col("x").alias("label"), "sim", times.alias("times")), most)
    return strongest(counted.withColumn("times", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times"), most)


def strongest(links: DataFrame, most: int = 200) -> DataFrame:
    """The `most` most similar, ties by from, to, label: bounded heaps, then one small sort."""
    return links.orderBy(F.desc("sim"), "from", "to", "label").limit(most)


def majority(votes: DataFrame, samples: int = 3) -> DataFrame:
    """(from, to, label, n, first) of the edges with more than half of the samples' votes; repeats in one sample count.

    votes: (ord, from, to, label), nulls in label as the empty text.
    """
    counted = votes.withColumn("label", F.coalesce("label", F.lit(""))).groupBy("from", "to", "label").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    return counted.where(F.col("n") >= samples // 2 + 1)


def voted_or(proposed: DataFrame, votes: DataFrame, samples: int = 3) -> DataFrame:
    """(from, to, label): what the vote passed, or the proposed relations if nothing passed."""
    passed = majority(votes, samples)
    none = passed.limit(1).agg(F.count(F.lit(1))).scalar() == 0
    return passed.select("from", "to", "label").unionByName(proposed.where(none).select("from", "to", "label"))


def top_voted(votes: DataFrame, samples: int = 3, most: int = 5) -> DataFrame:
    """(from, to, label, turn): the majority in turn of first seen, or the `most` commonest (ties by first seen) if nothing passed."""
    counted = votes.withColumn("label", F.coalesce("label", F.lit(""))).groupBy("from", "to", "label").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    passed = counted.where(F.col("n") >= samples // 2 + 1)
    none = passed.limit(1).agg(F.count(F.lit(1))).scalar() == 0
    best = counted.orderBy(F.desc("n"), "first").limit(most).where(none)
    turn = lambda n: F.struct(n.alias("n"), F.col("first").alias("first")).alias("turn")
    return passed.select("from", "to", "label", turn(F.lit(0).cast("long"))).unionByName(best.select("from", "to", "label", turn(-F.col("n"))))


def new_votes(proposed: DataFrame, votes: DataFrame, samples: int = 3, most: int = 5) -> DataFrame:
    """(from, to, label, turn): the voted edges that are not among the proposed ones."""
    same = [F.col(f"v.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("from", "to", "label")]
    return top_voted(votes, samples, most).alias("v").join(proposed.alias("p"), same[0] & same[1] & same[2], "left_anti")


def with_voted(proposed: DataFrame, votes: DataFrame, samples: int = 3, most: int = 5) -> DataFrame:
    """The proposed edges as they are, and the voted ones that are not among them."""
    new = new_votes(proposed, votes, samples, most)
    return proposed.select("from", "to", "label").unionByName(new.select("from", "to", "label"))

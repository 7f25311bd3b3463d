"""Near-duplicate entities: buckets by key, greedy leaders by name similarity, ordered merge.

The leader rule is sequential as it is stated: keys in order of appearance, an unused key leads and takes every later
unused key similar to it. Here it runs in rounds that give the same result: an undecided key without an earlier undecided
neighbour leads, its later neighbours follow; a chain of n keys needs up to n rounds, ordinary names need one to three.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.plans.shared import cut


def keyed(entities: DataFrame) -> DataFrame:
    """entities with key and bucket (smallest ord of its key)."""
    name = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.nullif(F.col("name"), F.lit("")), F.lit("")) if "id" in entities.columns else F.coalesce("name", F.lit(""))
    k = entities.withColumn("key", tx.key(name))
    return k.withColumn("bucket", F.min("ord").over(Window.partitionBy("key")))


def buckets(entities: DataFrame) -> DataFrame:
    """(key, bucket, n): distinct keys in order of appearance."""
    name = F.coalesce(F.nullif(F.col("id"), F.lit("")), F.nullif(F.col("name"), F.lit("")), F.lit("")) if "id" in entities.columns else F.coalesce("name", F.lit(""))
    return entities.select(tx.key(name).alias("key"), "ord").groupBy("key").agg(F.min("ord").alias("bucket"), F.count(F.lit(1)).alias("n"))


def similar_keys(keys: DataFrame, least: float = 0.9) -> DataFrame:
    """(a, b) by bucket order, a before b, token Jaccard at least `least` (above 0).

    Exact prefix join: tokens are put in order of rarity; two sets that similar share one of their first
    n - ceil(least * n) + 1 tokens, and their sizes are within the factor `least`. Common tokens stay out of the join.
    """
    if not 0 < least <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    sets = keys.select("bucket", tx.key_tokens(F.col("key")).alias("t"))
    freq = sets.select(F.explode("t").alias("w")).groupBy("w").count()
    ranked = sets.select("bucket", F.size("t").alias("n"), F.explode("t").alias("w")).join(freq, "w").groupBy("bucket", "n").agg(F.array_sort(F.collect_list(F.struct("count", "w"))).alias("s"))
    first = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9).cast("int") + 1
    pre = cut(ranked.select("bucket", "n", F.col("s.w").alias("t"), F.explode(F.slice(F.col("s.w"), F.lit(1), F.greatest(first, F.lit(1)))).alias("w")))
    a = pre.select(F.col("bucket").alias("a"), F.col("n").alias("na"), F.col("t").alias("ta"), "w")
    b = pre.select(F.col("bucket").alias("b"), F.col("n").alias("nb"), F.col("t").alias("tb"), "w")
    near = a.join(b, "w").where((F.col("a") < F.col("b")) & (F.col("nb") >= F.lit(least) * F.col("na") - 1e-9) & (F.col("na") >= F.lit(least) * F.col("nb") - 1e-9))
    return near.where(tx.jaccard(F.col("ta"), F.col("tb")) >= least).select("a", "b").distinct()


def leaders(keys: DataFrame, least: float = 0.9) -> DataFrame:
    """(bucket, leader): each key's leader by greedy order; keys: (key, bucket)."""
    pairs = cut(similar_keys(keys, least))
    open_ = cut(keys.select("bucket"))
    done = None
    while True:
        live = pairs.join(open_.withColumnRenamed("bucket", "a"), "a").join(open_.withColumnRenamed("bucket", "b"), "b")
        held = live.select(F.col("b").alias("bucket")).distinct()
        lead = cut(open_.join(held, "bucket", "left_anti"))
        follow = live.join(lead.withColumnRenamed("bucket", "a"), "a").groupBy("b").agg(F.min("a").alias("leader"))
        new = cut(lead.select("bucket", F.col("bucket").alias("leader")).unionByName(follow.select(F.col("b").alias("bucket"), "leader")))
        done = new if done is None else cut(done.unionByName(new))
        open_ = cut(open_.join(new.select("bucket"), "bucket", "left_anti"))
        if open_.isEmpty():
            return done


def leaders_asking(entities: DataFrame, ask: Callable[[dict, dict], bool], least: float = 0.9, band: float = 0.1, most: int = 25) -> DataFrame:
    """(bucket, leader) as leaders(), but pairs within `band` below the threshold are put to `ask`, at most `most` of them.

    The budget is spent in scan order, so this one is a loop on the driver: over the similar pairs only, and over the merged
    entities of those that are asked about. For entity sets of one book, with a model at hand.
    """
    keys = cut(buckets(entities))
    tokens = tx.key_tokens
    near = similar_keys(keys, least - band)
    a, b = (keys.select(F.col("bucket").alias(n), tokens(F.col("key")).alias(f"t{n}")) for n in "ab")
    pairs = near.join(a, "a").join(b, "b").select("a", "b", tx.jaccard(F.col("ta"), F.col("tb")).alias("sim")).collect()
    later: dict[int, list[tuple[int, float]]] = {}
    for r in sorted(pairs):
        later.setdefault(r["a"], []).append((r["b"], r["sim"]))
    close = {x for r in pairs if r["sim"] < least for x in (r["a"], r["b"])}
    seeds = merged(keyed(entities).withColumn("leader", F.col("bucket")))
    seen = {r["ord"]: {k: v for k, v in r.asDict().items() if k not in ("ord", "members")} for r in seeds.where(F.col("ord").isin(*close)).collect()} if close else {}
    lead: dict[int, int] = {}
    asked = 0
    for (x,) in keys.select("bucket").orderBy("bucket").collect():
        if x in lead:
            continue
        lead[x] = x
        for y, sim in later.get(x, ()):
            if y in lead:
                continue
            if sim < least:
                if asked >= most:
                    continue
                asked += 1
                if not ask(seen[x], seen[y]):
                    continue
            lead[y] = x
    return entities.sparkSession.createDataFrame(sorted(lead.items()), "bucket long, leader long")


def clustered(entities: DataFrame, least: float = 0.9, ask: Callable[[dict, dict], bool] | None = None, band: float = 0.1, most: int = 25) -> DataFrame:
    """entities with key, bucket and leader; members of a group are in order of (bucket, ord)."""
    k = keyed(entities)
    return k.join(leaders(buckets(entities), least) if ask is None else leaders_asking(entities, ask, least, band, most), "bucket")


def merged(groups: DataFrame) -> DataFrame:
    """One row for each leader: the row with the longest description (first among equals), with all inputs, outputs and
    names in order of first appearance; id from its name if empty."""
    place = F.struct("bucket", "ord")
    ordered = lambda c: F.array_sort(F.collect_list(F.struct("bucket", "ord", F.col(c).alias("x"))))
    distinct = lambda c: F.array_distinct(F.flatten(F.transform(c, lambda r: F.coalesce(r["x"], F.array().cast("array<string>")))))
    row = F.struct("id", "name", "romanian", "type", "description")
    g = groups.withColumn("label", F.coalesce(F.nullif(F.col("name"), F.lit("")), F.nullif(F.col("id"), F.lit("")))).groupBy("leader").agg(
        F.max_by(row, F.struct(F.length(F.coalesce("description", F.lit(""))), -F.col("bucket"), -F.col("ord"))).alias("base"),
        ordered("inputs").alias("i"),
        ordered("outputs").alias("o"),
        F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("bucket", "ord", F.col("label").alias("x"))))).alias("l"),
        F.array_sort(F.collect_list(F.struct("bucket", "ord", F.coalesce(F.nullif(F.col("id"), F.lit("")), F.col("name")).alias("x")))).alias("m"),
    )
    return g.select(
        F.col("leader").alias("ord"),
        F.coalesce(F.nullif(F.col("base.id"), F.lit("")), tx.key(F.col("base.name"))).alias("id"),
        "base.name",
        "base.romanian",
        "base.type",
        "base.description",
        distinct(F.col("i")).alias("inputs"),
        distinct(F.col("o")).alias("outputs"),
        F.array_distinct(F.col("l.x")).alias("alt_names"),
        F.col("m.x").alias("members"),
    )


def report(merged_: DataFrame) -> DataFrame:
    """(ord, canonical, alt_names, members), members with their repeats."""
    return merged_.select("ord", F.coalesce(F.nullif(F.col("id"), F.lit("")), F.col("name")).alias("canonical"), "alt_names", "members")

"""Mixing sources to target weights.

Tokens are summed by source; each source's target follows its weight but stops at a cap times its size, and what it
can't use goes to the others by weight until none is above. A source's repetition rate is target over size; a document
is taken floor(rate) times, and once more with probability equal to the fraction, by a hash of its id and a seed. Of SEEDS
seeds each source takes the one whose words taken come nearest to its target, found in one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import WORD, cut, packed, unpacked

#: Up to so many sources the table of rates is broadcast (its size is then proven, a few MB); beyond, documents are salted.
BROADCAST_SOURCES = 20_000
SALTS = 64
#: Seeds that each source chooses from.
SEEDS = 64


def words(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_: Column, seed: int, number: Column | int) -> Column:
    """A number from 0 up to 1 for an id and the number of a seed: the same on every engine and in every run.

    (a + number * b) modulo 2**48, where a and b are 48 bits each of the MD5 of seed and id; any two numbers' draws of an id are
    independent of one another.
    """
    md5 = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"))
    a, b = (F.conv(F.substring(md5, i, 12), 16, 10).cast("long") for i in (1, 13))
    number = F.lit(number) if isinstance(number, int) else number
    return F.pmod(a + number.cast("long") * b, F.lit(1 << 48)) / F.lit(float(1 << 48))


def ranked(sizes: DataFrame) -> DataFrame:
    """Sources by code point, null last, numbered from 0 in column `rank`, without bringing them to one task.

    Sorted by range; each partition numbers its own rows and adds what the partitions before it hold. The driver sees
    one count for each partition.
    """
    spread = cut(sizes.withColumn("__null", F.col("source").isNull()).repartitionByRange("__null", "source").sortWithinPartitions("__null", "source").withColumn("__p", F.spark_partition_id()))
    before, total = {}, 0
    for p, n in sorted((r["__p"], r["count"]) for r in spread.groupBy("__p").count().collect()):
        before[p], total = total, total + n
    w = Window.partitionBy("__p").orderBy("__null", "source")
    offsets = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("__p")) if before else F.lit(0)
    return spread.withColumn("rank", (offsets + F.row_number().over(w) - 1).cast("long")).drop("__p", "__null")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """source, source_size, target: weights repeat the cycle in the order of sources; all sizes are shared out.

    Each round finds the sources whose share is above cap times their size, holds them there and shares the rest anew;
    it ends when none is above, after as many small aggregations as there are rounds.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (F.col("rank") % len(cycle) + 1).cast("int"))
    src = cut(ranked(sizes).select("source", "source_size", w.alias("weight"), (F.col("source_size") * cap).alias("most")))
    total = src.agg(F.sum("source_size")).first()[0] or 0
    rest, weight, held = float(total), None, -1
    while True:
        # a source is held if its share at the present level, rest * w / weight, is above its cap
        over = F.lit(False) if weight is None else F.col("most") * F.lit(weight) < F.lit(rest) * F.col("weight")
        got = src.agg(F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0)).alias("m"), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("w"), F.count_if(over).alias("n")).first()
        if got["n"] == held:
            break
        held, rest, weight = got["n"], float(total - got["m"]), got["w"]
        if not weight:
            break
    share = F.lit(rest) * F.col("weight") / F.lit(weight or 1.0)
    return src.select("source", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def plan(docs: DataFrame, seed: int = 17, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every document; repeated rows are planned alike.

    Null texts have size 0; null sources are one source, the last; sources without words have rate 0; ids that are equal or
    null draw alike. An empty table gives no rows; only the three columns are read, so others may have any name. The text is
    read once; only (doc_id, source, size) is kept. A hot source meets no shuffle while the table of sources is small; beyond
    BROADCAST_SOURCES documents are salted and the table is repeated once for each salt.
    """
    sized = cut(docs.select(docs["doc_id"], docs["source"], words(docs["text"]).alias("size")))
    return with_copies(sized, goals(sized, seed, cycle, cap), seed)


def goals(sized: DataFrame, seed: int, cycle: tuple[int, ...], cap: int) -> DataFrame:
    """source, source_size, target, rate and the number of its seed, for every source of (doc_id, source, size)."""
    goal = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = cut(goal.withColumn("rate", rate))
    part = F.col("rate") - F.floor("rate")
    sums = [F.sum(F.when(draw(F.col("doc_id"), seed, k) < part, F.col("size")).otherwise(0)).alias(f"s{k}") for k in range(SEEDS)]
    drawn = joined(sized, goal.select("source", "rate")).groupBy("source").agg(*sums)
    drawn = drawn.select(F.col("source").alias("s"), F.array(*[f"s{k}" for k in range(SEEDS)]).alias("sums"))
    both = goal.join(drawn, goal["source"].eqNullSafe(drawn["s"]))
    off = F.transform("sums", lambda x, k: F.struct(F.abs((F.floor("rate") * F.col("source_size") + x).cast("double") - F.col("target")).alias("off"), k.alias("number")))
    return cut(both.select("source", "source_size", "target", "rate", F.array_min(off)["number"].alias("number")))


def joined(docs: DataFrame, goal: DataFrame) -> DataFrame:
    """docs with the other columns of their source's goal."""
    goal = goal.withColumnRenamed("source", "goal_source")
    if goal.count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(goal), docs["source"].eqNullSafe(goal["goal_source"])).drop("goal_source")
    left = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    right = goal.withColumn("goal_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, left["source"].eqNullSafe(right["goal_source"]) & (left["salt"] == right["goal_salt"])).drop("salt", "goal_salt", "goal_source")


def with_copies(docs: DataFrame, goal: DataFrame, seed: int = 17) -> DataFrame:
    """docs (doc_id, source and columns that goals() doesn't name) with source_size, target and `copies`."""
    extra = (draw(F.col("doc_id"), seed, F.col("number")) < F.col("rate") - F.floor("rate")).cast("int")
    return joined(docs, goal).withColumn("copies", (F.floor("rate") + extra).cast("int")).drop("rate", "number")


def mix(docs: DataFrame, seed: int = 17, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The documents themselves, each as often as plan() takes it, with their own columns only, whatever their names."""
    sized = cut(docs.select(docs["doc_id"], docs["source"], words(docs["text"]).alias("size")))
    chosen = with_copies(packed(docs, doc_id=docs["doc_id"], source=docs["source"]), goals(sized, seed, cycle, cap), seed)
    return unpacked(chosen.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))


#: The same rows in DuckDB: rounds of resharing as a recursive query over the level's rest and weight.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM d GROUP BY source),
r(step, rest, weight, held) AS (
  SELECT 0, CAST(sum(source_size) AS DOUBLE), sum(weight), CAST(0 AS BIGINT) FROM s
  UNION ALL
  SELECT step + 1, n.rest, n.weight, n.held
  FROM r, LATERAL (
    SELECT CAST((SELECT sum(source_size) FROM s) - coalesce(sum(CASE WHEN 3 * source_size * r.weight < r.rest * s.weight THEN 3 * source_size END), 0) AS DOUBLE) AS rest,
           coalesce(sum(CASE WHEN 3 * source_size * r.weight < r.rest * s.weight THEN NULL ELSE s.weight END), 0) AS weight,
           count(*) FILTER (WHERE 3 * source_size * r.weight < r.rest * s.weight) AS held
    FROM s) AS n
  WHERE n.held <> r.held AND n.weight > 0),
l AS (SELECT rest, weight FROM r ORDER BY step DESC LIMIT 1),
t AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), l.rest * s.weight / l.weight) AS target FROM s, l),
c AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT *, CAST(('0x' || substr(h, 1, 12)) AS BIGINT) AS a, CAST(('0x' || substr(h, 13, 12)) AS BIGINT) AS b FROM c),
k AS (
  SELECT source, number, abs(CAST(any_value(floor(rate) * source_size) + sum(CASE WHEN ((a + number * b) % 281474976710656) / 281474976710656.0 < rate - floor(rate) THEN size ELSE 0 END) AS DOUBLE) - any_value(target)) AS off
  FROM u, (SELECT unnest(range(64)) AS number) AS numbers GROUP BY source, number),
n AS (SELECT source, arg_min(number, struct_pack(off := off, number := number)) AS number FROM k GROUP BY source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN ((a + number * b) % 281474976710656) / 281474976710656.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM u JOIN n ON u.source IS NOT DISTINCT FROM n.source
"""

"""Near-duplicate embeddings by int8 tile products with error bounds.

Every distinct vector is quantised to int8 components with a scale, and what that leaves over to int8 components once more.
Vectors are dealt into blocks (cells of pivots, large cells in parts); a tile is a pair of blocks, and a vector goes to a
tile only if its distance from the hyperplane between the two pivots allows a link there. In a tile all products of the first
components are exact in whole numbers; the vectors' quantisation errors bound how far the true cosine can be. Pairs that the
bound leaves open are multiplied with the second components too, and the few still open are computed in double precision
from the vectors themselves. Only the quantised vectors are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_limits, cut, dropped, stored
from quillgraph.llm.components import components, merged_labels

#: Vectors of a block at most, and in a cell of a pivot on average with few vectors; products held at once in a tile.
BLOCK, CELL, PRODUCTS = 65_536, 2_000, 1 << 21
#: Pivots at most; they change how much is compared, never what is found.
PIVOTS = 1024
#: Components whose int8 products sum to less than 2**24, so that float32 holds every partial sum exactly.
EXACT = 1040


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, all components present and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1 in double precision; scaled first, so that neither tiny nor huge components are lost."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 components of unit vectors and of what they leave over, scale, and the lengths of both errors, rounded up.

    x = (q + r / 254) * scale + rest: the second scale is a 254th of the first, as a component is off by half of it at most.
    """
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    left = x / scale[:, None] - q
    r = np.rint(left * 254)
    up = 1 + 1e-9
    one = np.sqrt((left * left).sum(1)) * scale * up + 1e-12
    two = np.sqrt(((left - r / 254) ** 2).sum(1)) * scale * up + 1e-12
    return q.astype(np.int8), r.astype(np.int8), scale, one, two


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products of the rows of two int8 matrices, exact: whole numbers below 2**24 in float32, added up in double."""
    if a.shape[1] <= EXACT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum((a[:, c : c + EXACT].astype(np.float32) @ b[:, c : c + EXACT].astype(np.float32).T).astype(np.float64) for c in range(0, a.shape[1], EXACT))


def slack(ea: np.ndarray, eb: np.ndarray, d: int) -> np.ndarray:
    """How far the product of two quantised unit vectors can be from their cosine.

    |x.y - x'.y'| <= |x - x'| |y'| + |x| |y - y'| <= ea (1 + eb) + eb, and 1e-9 + d * 1e-15 for unit vectors not being quite of
    length 1 and for a few products in double precision.
    """
    return ea * (1 + eb) + eb + 1e-9 + d * 1e-15


def judged(a, b, least: float, below: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs that link for certain, and those that the quantised vectors leave open; below: only i < j."""
    qa, ra, sa, ea, fa = a
    qb, rb, sb, eb, fb = b
    d = qa.shape[1]
    p = products(qa, qb)
    # first one bound for each row, with the largest error and scale of the other side
    first = (least - slack(ea, eb.max(), d)) / (sa * sb.max()) if least > 0 else np.full(len(ea), -np.inf)
    i, j = np.nonzero(p >= np.nextafter(first.astype(p.dtype), -np.inf, dtype=p.dtype)[:, None])
    if below:
        i, j = i[i < j], j[i < j]
    whole = p[i, j].astype(np.float64)
    cos = whole * sa[i] * sb[j]
    off = slack(ea[i], eb[j], d)
    sure = cos - off >= least
    some = np.flatnonzero(~sure & (cos + off >= least))
    for c in range(0, len(some), 1 << 16):
        at = some[c : c + (1 << 16)]
        k, m = i[at], j[at]
        # whole numbers: components times 254 plus the second ones stay below 2**15, their products' sums below 2**53
        full = np.einsum("nd,nd->n", qa[k].astype(np.float64) * 254 + ra[k], qb[m].astype(np.float64) * 254 + rb[m]) / (254.0 * 254.0)
        cos[at] = full * sa[k] * sb[m]
        off[at] = slack(fa[k], fb[m], d)
    sure |= cos - off >= least
    open_ = ~sure & (cos + off >= least)
    return i[sure], j[sure], i[open_], j[open_]


def _rows(kind: int, a: np.ndarray, b: np.ndarray | None = None, n: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), none if b is None else pa.array(b), none if n is None else pa.array(n.astype(np.int64))], ["kind", "a", "b", "n"])


class Tile:
    """The first block of a tile, as it gathers, and what was found in it."""

    def __init__(self, least: float):
        self.least, self.own, self.ids, self.many, self.label, self.n = least, None, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def meet(self, other, ids: np.ndarray, many: np.ndarray, add: bool, alone: bool) -> Iterator[pa.RecordBatch]:
        """Compares the block so far with other rows. With add these rows join the block, which is compared with itself only
        where it is alone."""
        label, n = ids.copy(), np.zeros(len(ids))
        if len(self.ids) and (alone or not add):
            yield from self._compare(self.own, self.ids, self.many, self.label, self.n, other, ids, many, label, n, False)
        if add:
            if alone:
                yield from self._compare(other, ids, many, label, n, other, ids, many, label, n, True)
            self.own = other if self.own is None else tuple(np.concatenate(c) for c in zip(self.own, other))
            self.ids, self.many = np.concatenate([self.ids, ids]), np.concatenate([self.many, many])
            self.label, self.n = np.concatenate([self.label, label]), np.concatenate([self.n, n])
        elif n.any():
            at = np.flatnonzero(n)
            yield _rows(0, ids[at], n=n[at])

    def _compare(self, a, a_ids, a_many, a_label, a_n, b, b_ids, b_many, b_label, b_n, below: bool) -> Iterator[pa.RecordBatch]:
        step = max(1, PRODUCTS // max(1, len(b_ids)))
        for s in range(0, len(a_ids), step):
            here = slice(s, s + step)
            skip = s if below else 0  # of a block with itself only pairs in one order
            i, j, k, m = judged(tuple(c[here] for c in a), tuple(c[skip:] for c in b), self.least, below)
            j, m = j + skip, m + skip
            if len(i):
                a_n[here] += np.bincount(i, b_many[j], len(a_n[here]))
                b_n += np.bincount(j, a_many[here][i], len(b_n))
                old, new = merged_labels(a_label[here], b_label, i, j)
                if len(old):
                    yield _rows(1, old, new)
            if len(k):
                yield _rows(2, a_ids[here][k], b_ids[m])

    def close(self) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(self.n)
        if len(at):
            yield _rows(0, self.ids[at], n=self.n[at])


def compared(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (kind, a, b, n), from rows sorted by tile, its first block before its second.

    kind 0: a links with n more rows; 1: a and b are of one class; 2: whether a and b link is open. Each pair meets in one tile only.
    """
    key, tile = None, Tile(least)
    for b in batches:
        one, two, second, ids, many = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        scale, e, f = (b.column(i).to_numpy() for i in range(5, 8))
        begin = offsets(b.column(8))
        raw = [np.frombuffer(b.column(c).buffers()[2] or b"", np.int8) for c in (8, 9)]
        cuts = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (second[1:] != second[:-1])) + 1
        for s, t in zip([0, *cuts], [*cuts, len(one)]):
            if (one[s], two[s]) != key:
                yield from tile.close()
                key, tile = (one[s], two[s]), Tile(least)
            q, r = (x[begin[s] : begin[t]].reshape(t - s, -1) for x in raw)
            yield from tile.meet((q, r, scale[s:t], e[s:t], f[s:t]), ids[s:t], many[s:t], not second[s], one[s] == two[s])
    yield from tile.close()


def offsets(x: pa.Array) -> np.ndarray:
    """Where each binary begins, and where the last one ends."""
    return np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int32)


def _binary(x: np.ndarray) -> pa.Array:
    n, d = x.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * d), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, k, k2, vector) to the same rows with scale, errors and int8 components, vectors of one length together."""
    for b in batches:
        size = np.diff(b.column(3).offsets.to_numpy())
        for d in np.unique(size):
            rows = b.filter(pa.array(size == d))
            q, r, scale, e, f = quantised(unit(rows.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)))
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(scale), pa.array(e), pa.array(f), _binary(q), _binary(r)], ["id", "k", "k2", "scale", "e", "f", "q", "r"])


def tiles(nodes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """The rows of every tile, sorted by tile within partitions, and the stored table they are read from; nodes: (node, many, scale, e, f, q, r).

    Cells are those of the pivots of one length of vectors, whose pivots' number goes with the root of the vectors'; lengths
    with few vectors are one cell. The driver holds PIVOTS pivots at most, and their cells' sizes.
    """
    spark = nodes.sparkSession
    total, worst = nodes.agg(F.count(F.lit(1)), F.max("e")).first()
    pivots = min(PIVOTS, int(np.ceil(np.sqrt(total / CELL)))) if total else 1
    length = F.octet_length("q")
    share = {r["d"]: max(1, round(pivots * r["count"] / total)) for r in nodes.groupBy(length.alias("d")).count().where(F.col("count") * pivots * 2 >= 3 * F.lit(total)).collect()} if total else {}
    picked: dict[int, np.ndarray] = {}
    if share:
        some = nodes.where(length.isin(*share) & (F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 8 * pivots / total))))
        rows = sorted(((r["h"], bytes(r["q"])) for r in some.select(F.xxhash64("node", F.lit(6)).alias("h"), "q").collect()))
        for d, n in share.items():
            mine = [x for _, x in rows if len(x) == d][:n]
            if len(mine) > 1:
                picked[d] = unit(np.frombuffer(b"".join(mine), np.int8).reshape(-1, d))
    shared = spark.sparkContext.broadcast(picked)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6 + (worst or 0.0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its cell and the cells that it may have links in."""
        for b in batches:
            size = np.diff(offsets(b.column(5)))
            for d in np.unique(size):
                rows = b.filter(pa.array(size == d))
                n = len(rows)
                if int(d) not in shared.value:
                    own, to, ends = np.zeros(n, np.int32), np.zeros(n, np.int32), np.arange(n + 1, dtype=np.int32)
                else:
                    p = shared.value[int(d)]
                    scale, e = rows.column(2).to_numpy(), rows.column(3).to_numpy()
                    begin = offsets(rows.column(5))
                    x = np.frombuffer(rows.column(5).buffers()[2], np.int8)[begin[0] : begin[-1]].reshape(n, d) * scale[:, None]
                    near = x @ p.T
                    own = near.argmax(1)
                    apart = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[own]
                    # x lies beyond the hyperplane of another cell's vectors by so much; both are known to within their errors
                    goes = near[np.arange(n), own][:, None] - near <= (reach + e[:, None]) * apart + 1e-9
                    goes[np.arange(n), own] = True
                    i, to = np.nonzero(goes)
                    ends = np.searchsorted(i, np.arange(n + 1)).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(to.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(n, d, np.int32)), pa.array(own.astype(np.int32)), cells], ["node", "many", "scale", "e", "f", "q", "r", "d", "cell", "to"])

    kept = nodes.select("node", "many", "scale", "e", "f", "q", "r")
    dealt = stored(kept.mapInArrow(deal, "node long, many long, scale double, e double, f double, q binary, r binary, d int, cell int, to array<int>"))
    large = cut(dealt.groupBy("d", "cell").count().where(F.col("count") > BLOCK).select("d", "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")))
    if large.isEmpty():
        blocks = dealt.withColumn("block", F.struct("cell", F.lit(0).alias("part"))).withColumn("other", F.explode(F.transform("to", lambda c: F.struct(c.alias("cell"), F.lit(0).alias("part")))))
    else:
        # the parts of every cell that a vector goes to, its own cell among them
        parts = large.groupBy("d").agg(F.map_from_entries(F.collect_list(F.struct("cell", "parts"))).alias("parts"))
        blocks = dealt.join(F.broadcast(parts), "d", "left")  # at most PIVOTS cells, and one for each length with more than BLOCK vectors
        many = lambda c: F.coalesce(F.element_at("parts", c), F.lit(1))
        blocks = blocks.withColumn("block", F.struct("cell", F.pmod(F.xxhash64("node"), many(F.col("cell"))).cast("int").alias("part")))
        blocks = blocks.withColumn("other", F.explode(F.flatten(F.transform("to", lambda c: F.transform(F.sequence(F.lit(0), many(c) - 1), lambda k: F.struct(c.alias("cell"), k.alias("part")))))))
    second = F.col("block") > F.col("other")
    one, two = F.xxhash64("d", F.least("block", "other")), F.xxhash64("d", F.greatest("block", "other"))
    at = blocks.select(one.alias("one"), two.alias("two"), second.alias("second"), "node", "many", "scale", "e", "f", "q", "r")
    return at.repartition("one", "two").sortWithinPartitions("one", "two", "second"), dealt


def near_duplicates(embeddings: DataFrame, least: float = 0.95, vector: str = "embedding", id_: str = "vec_id") -> DataFrame:
    """id, n_links, component_id, kept for every row; least is above 0.

    Equal vectors are one node with their count (told apart by 128 bits of hash), so copies are never expanded into pairs.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; nor do vectors of different
    lengths. Rows with a null id take part in links, but name no class. Repeated rows are copies. An empty table gives no
    rows. Only the two columns are read, so others may have any name.
    """
    arrow_limits(embeddings.sparkSession)
    rows = embeddings.select(embeddings[id_].cast("long").alias("vec_id"), embeddings[vector].alias("vector"))
    fine = rows.where(usable(F.col("vector"))).select("vec_id", F.xxhash64("vector").alias("k"), F.xxhash64(F.lit(1), "vector").alias("k2"), "vector")
    each = fine.mapInArrow(quantise, "vec_id long, k long, k2 long, scale double, e double, f double, q binary, r binary")
    # copies are summed before they are shuffled, with any one of their quantised vectors, all the same
    grouped = each.groupBy("k", "k2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("many"), *[F.first(c).alias(c) for c in ("scale", "e", "f", "q", "r")])
    nodes = stored(grouped.withColumn("node", F.monotonically_increasing_id()))
    tiled, dealt = tiles(nodes, least)
    found = stored(tiled.mapInArrow(lambda it: compared(it, least), "kind int, a long, b long, n long"))
    dropped(dealt)
    ids = nodes.select("node", "id", "k", "k2", "many")
    edges, counts = found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")), found.where("kind = 0").select("a", "n")
    unsure = cut(found.where("kind = 2").select("a", "b"))
    if not unsure.isEmpty():
        # the vectors themselves, of these nodes only, by the id and hashes of one row of each
        wanted = unsure.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(ids, "node")
        same = fine["vec_id"].eqNullSafe(wanted["id"]) & (fine["k"] == wanted["k"]) & (fine["k2"] == wanted["k2"])
        real = cut(fine.join(wanted, same).groupBy("node").agg(F.first("vector").cast("array<double>").alias("x"), F.first("many").alias("many")))
        left, right = (real.select(F.col("node").alias(n), F.col("x").alias("x" + n), F.col("many").alias("n" + n)) for n in "ab")
        dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
        top = F.array_max(F.transform("xa", F.abs)), F.array_max(F.transform("xb", F.abs))
        pairs = unsure.join(left, "a").join(right, "b").withColumn("xa", F.transform("xa", lambda x: x / top[0])).withColumn("xb", F.transform("xb", lambda x: x / top[1]))
        linked = cut(pairs.where(dot("xa", "xb") / (F.sqrt(dot("xa", "xa")) * F.sqrt(dot("xb", "xb"))) >= least).select("a", "b", "na", "nb"))
        edges = edges.unionByName(linked.select(F.col("a").alias("u"), F.col("b").alias("v")))
        counts = counts.unionByName(linked.select("a", F.col("nb").alias("n"))).unionByName(linked.select(F.col("b").alias("a"), F.col("na").alias("n")))
    roots = components(edges)
    rooted = cut(ids.join(roots, "node", "left").select("node", "id", "k", "k2", "many", F.coalesce("root", "node").alias("root")))
    least_id = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    more = counts.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = cut(rooted.join(least_id, "root").join(more, "node", "left").select("k", "k2", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id"))
    dropped(nodes, found)
    keys = rows.select("vec_id", F.when(usable(F.col("vector")), F.xxhash64("vector")).alias("k"), F.xxhash64(F.lit(1), "vector").alias("k2"))
    apart = keys.where("k is null").select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    out = keys.where("k is not null").join(named, ["k", "k2"], "left").select("vec_id", "n_links", "component_id").unionByName(apart)
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


#: The same in DuckDB: all pairs in double precision, then what each vector reaches.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
w AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM w a JOIN w b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r(u, v) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u),
k AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT e.vec_id, coalesce(k.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.u = e.vec_id LEFT JOIN k ON k.u = e.vec_id
"""

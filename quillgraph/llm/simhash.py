"""SimHash near-duplicates by anchor points.

Two fingerprints within 3 bits differ by at most one bit in one of their halves. The anchors of a half are the words of
the perfect Hamming code on 31 of its bits: every fingerprint lies within covering radius 1 of one of them, its home. It is
replicated to each anchor within covering radius plus threshold, 2 bits: 16 at most, by syndrome, without a search. Of
two linked fingerprints each then meets the other at its home, and only homes are compared with what has come there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import arrow_limits, cut, dropped, packed, stored, unpacked
from quillgraph.llm.components import components

#: Homes of one anchor that one task compares; more are split, and what visits the anchor goes to each part.
HOMES = 1024
#: Rows of an anchor, and places of fingerprints, that are handled at once.
_SLICE = 2048
#: Different texts whose common shingles come last in every set, and how many such shingles at most; any choice is exact.
SAMPLE, LATE = 20_000, 1 << 20
#: Shingles before its own that a row has with it, so that a pair that shares several is given at the first of them; any number is exact.
BEFORE = 4


def covering(checks: int) -> tuple[list[int], np.ndarray]:
    """The Hamming code on 2**checks - 1 bits: masks of its parity checks (bit p - 1 stands for position p), and for each syndrome
    the pairs of bits that lead to a code word two bits away (none for 0)."""
    n = (1 << checks) - 1
    masks = [sum(1 << (p - 1) for p in range(1, n + 1) if p >> k & 1) for k in range(checks)]
    pairs = [[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, n + 1) if i ^ s > i] if s else [0] * (n // 2) for s in range(n + 1)]
    return masks, np.array(pairs, np.int64)


#: Codes of the 31 bits of a half, and of the 15 bits of one of eight blocks.
_HALF, _BLOCK = covering(5), covering(4)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over the XXH64 (seed 42) of all word shingles, as a signed number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - 1]]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(whole[a : b - 1], 42) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :])], np.uint64, n)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        votes += np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """doc_id and fp (long) of every whole text; one pass, no shuffle."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])

    return docs.select(docs[id_].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, "doc_id long, fp long")


def anchors(words: list[np.ndarray], code: tuple[list[int], np.ndarray], stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, whether it is the home, and index of the fingerprint, for all that each fingerprint is replicated to.

    A fingerprint is one or more 64-bit words, cut into blocks of `stride` bits of which the code covers all but the last.
    """
    checks, pairs = code
    bits = len(pairs) - 1
    out = []
    at = np.arange(len(words[0]))
    blocks = [(f >> k) & ((1 << bits) - 1) for f in words for k in range(0, 64, stride)]
    for block, x in enumerate(blocks):
        s = np.zeros(len(x), np.int64)
        for k, mask in enumerate(checks):
            s |= (np.bitwise_count(x & mask).astype(np.int64) & 1) << k
        home = np.where(s > 0, x ^ (1 << np.maximum(s - 1, 0)), x)
        out.append((home | block << bits, np.ones(len(x), bool), at))
        off = np.flatnonzero(s)
        out.append(((x[off, None] ^ pairs[s[off]]).ravel() | block << bits, np.zeros(pairs.shape[1] * len(off), bool), np.repeat(at[off], pairs.shape[1])))
    return tuple(np.concatenate(c) for c in zip(*out))


def apart(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Differing bits of each pair of fingerprints; unsigned, as of negative numbers bitwise_count takes the absolute value."""
    return sum(np.bitwise_count(x.view(np.uint64)[:, None] ^ y.view(np.uint64)[None, :]) for x, y in zip(a, b))


def forest(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links left[i]-right[j] a shortest forest that joins all the labels that they join; labels change in place.

    In rounds: each class of labels takes its shortest link to another class, in whole arrays.
    """
    chosen: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        a, b = left[i], right[j]
        cross = a != b
        if not cross.any():
            break
        i, j, far, a, b = i[cross], j[cross], far[cross], a[cross], b[cross]
        # shortest first, once for each pair of classes
        order = np.lexsort((np.maximum(a, b), np.minimum(a, b), far))
        i, j, far, a, b = (x[order] for x in (i, j, far, a, b))
        each, at = np.unique(np.concatenate([a, b]), return_index=True)
        pick = np.unique(at % len(a))
        chosen.append((i[pick], j[pick]))
        root = {x: x for x in each.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in zip(a[pick].tolist(), b[pick].tolist()):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
        to = np.array([find(x) for x in each.tolist()], np.int64)
        for labels in (left, right):
            k = np.minimum(np.searchsorted(each, labels), len(each) - 1)
            hit = each[k] == labels
            labels[hit] = to[k[hit]]
    if not chosen:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*chosen))


def compared(batches: Iterator[pa.RecordBatch], near: Callable[[list[np.ndarray], list[np.ndarray]], tuple[np.ndarray, np.ndarray, np.ndarray]], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Links u, v per anchor that join all that its links join (whole: all of its links), from rows (anchor, part, visits, name, ...)
    sorted by anchor and part, homes first, by a last column from the name on; near() tells the links of two groups of rows
    and their lengths. Whole links come with u < v, once a batch.

    Of an open group only its homes are kept.
    """
    key, own, label = None, [], np.zeros(0, np.int64)
    for b in batches:
        anchor, part, visits, *rest = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(anchor)]])
        homes = np.add.reduceat((~visits).astype(np.int64), starts)
        look = (homes > 0) & (ends - starts > 1)
        look[[0, -1]] = True
        us, vs = [], []
        for g in np.flatnonzero(look):
            s, e, h, this = starts[g], ends[g], homes[g], (int(anchor[starts[g]]), int(part[starts[g]]))
            new = [c[s : s + h] for c in rest]
            if this == key:
                own, label = [np.concatenate(c) for c in zip(own, new)], np.concatenate([label, new[0]])
            else:
                key, own, label = this, new, new[0].copy()
            for c in range(s, e, _SLICE) if len(label) else ():
                other = [x[c : min(c + _SLICE, e)] for x in rest]
                i, j, far = near(own, other)
                if len(i):
                    # rows that are homes too have the label of their class so far
                    if not whole:
                        k = np.searchsorted(own[0], other[0], sorter=(order := np.argsort(own[0])))
                        k = order[np.minimum(k, len(order) - 1)]
                        theirs = np.where(own[0][k] == other[0], label[k], other[0])
                        i, j = forest(label, theirs, i, j, far)
                    us.append(own[0][i])
                    vs.append(other[0][j])
        if us:
            u, v = np.concatenate(us), np.concatenate(vs)
            if whole:
                u, v = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def meetings(rows: DataFrame, words: list[str], code: tuple[list[int], np.ndarray], stride: int) -> DataFrame:
    """Each row (name first) at its anchors, sorted as compared() needs; anchors of more than HOMES homes in parts."""
    columns = rows.columns
    fields = ", ".join(f"{c} {t}" for c, t in rows.dtypes)

    def replicate(batches: Iterator[pa.RecordBatch], only_homes: bool = False) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), _SLICE):
                some = b.slice(i, _SLICE)
                anchor, home, at = anchors([some.column(columns.index(w)).to_numpy() for w in words], code, stride)
                if only_homes:
                    anchor, at, home = anchor[home], at[home], home[home]
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(~home), *(c.take(pa.array(at)) for c in some.columns)], ["anchor", "visits", *columns])

    schema = f"anchor long, visits boolean, {fields}"
    spread = rows.mapInArrow(replicate, schema)
    at_home = rows.mapInArrow(lambda it: replicate(it, True), schema)
    return parted(spread, at_home, columns)


def parted(spread: DataFrame, at_home: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (anchor, visits, name, ...) sorted as compared() needs; anchors of more than HOMES of the rows at_home in parts."""
    heavy = cut(at_home.groupBy("anchor").count().where(F.col("count") > HOMES).select("anchor", F.ceil(F.col("count") / HOMES).cast("int").alias("parts")))
    if heavy.isEmpty():
        spread = spread.withColumn("part", F.lit(0))
    else:
        part = F.pmod(F.xxhash64(columns[0]), F.col("parts")).cast("int")
        spread = spread.join(heavy, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        spread = spread.withColumn("part", F.explode(F.when(F.col("visits"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(part))))
        # homes of one part also have to meet those of the others
        others = spread.where(~F.col("visits") & (F.col("parts") > 1)).withColumn("visits", F.lit(True)).withColumn("part", F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part"))))
        spread = spread.unionByName(others)
    return spread.select("anchor", "part", "visits", *columns).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "visits")


def links(distinct: DataFrame, most: int = 3) -> DataFrame:
    """Links u, v between the distinct fingerprints `fp` that keep every class of linked ones together.

    Exact for up to 3 bits. An anchor that is home to more than HOMES fingerprints is compared in parts.
    """
    if most > 3:
        raise ValueError("two halves of 31 checked bits carry links of at most 3 bits")
    arrow_limits(distinct.sparkSession)

    def near(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        off = apart(a, b)
        i, j = np.nonzero((off <= most) & (a[0][:, None] != b[0][None, :]))
        return i, j, off[i, j]

    return meetings(distinct.select("fp"), ["fp"], _HALF, 32).mapInArrow(lambda it: compared(it, near), "u long, v long").distinct()


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def classes(docs: DataFrame, shingle: int = 3, most: int = 3, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """doc_id, fp, component_id for every row: the smallest doc_id reachable by links, its own included.

    Equal fingerprints are one node (their groups are never expanded); documents without words share fingerprint 0 and are
    linked like any other. Null ids take part in links but name no class; a class of null ids only has a null id.
    """
    fps = cut(fingerprints(docs, shingle, text, id_))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, most))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    best = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = cut(rooted.join(best, "root").select("fp", "component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def kept(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """docs without near-duplicates: of each class the row with the smallest doc_id stays, with the columns of docs.

    found: doc_id and component_id of every row, by classes() if not given. Whole texts move once, to meet the ids that stay.
    Where an id is repeated, equal texts of it stay once. Null ids stay, once for each text, if their class has no other.
    Other columns may have any name; an empty table stays empty.
    """
    found = classes(docs) if found is None else found
    first = cut(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("first_id")).agg(F.count(F.lit(1)).alias("n")))
    rows = packed(docs, doc_id=docs["doc_id"].cast("long"), text=F.xxhash64(docs["text"]))
    stay = rows.join(first, rows["doc_id"].eqNullSafe(first["first_id"]))
    if first.where("n > 1").isEmpty():
        return unpacked(stay)
    again = stay.where("n > 1").dropDuplicates(["doc_id", "text"])
    return unpacked(stay.where("n = 1").unionByName(again))


# ---- similar texts: longer fingerprints, then an exact check -------------------------------------------------------

def shingles(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the distinct word shingles, sorted; of fewer words the whole sequence, without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter([digest(whole[a : b - 1], 42) for a, b in zip([0, *ends[: n - 1]], ends[min(shingle, len(words)) - 1 :])], np.uint64, n))


def _second(h: np.ndarray) -> np.ndarray:
    """64 more bits of each hash."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def described(text: str | None, shingle: int) -> tuple[int, int, int, int]:
    """128 bits of SimHash over the distinct shingles, their number and the sum of their hashes, which tells sets apart."""
    return described_set(shingles(text, shingle))


def described_set(h: np.ndarray) -> tuple[int, int, int, int]:
    words = []
    for x in (h, _second(h)):
        votes = np.zeros(64, np.int64)
        for i in range(0, len(x), 1 << 14):
            votes += np.unpackbits(x[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        words.append(int(np.packbits(2 * votes > len(x), bitorder="little").view(np.int64)[0]))
    return words[0], words[1], len(h), int(h.sum(dtype=np.uint64).view(np.int64))


def first_shingles(h: np.ndarray, least: float, late: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """So many of a set's shingles that sets of similarity `least` share one; those of late (hashes, counts) last, rarest first."""
    hashes, counts = late
    k = len(h) - int(np.ceil(least * len(h) - 1e-6)) + 1
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        h = h[np.lexsort((h, np.where(hashes[at] == h, counts[at], 0)))]
    return h[:k] if len(h) else h


def marks(h: np.ndarray) -> list[int]:
    """256 bits: is the number of shingles with this remainder odd? Sets differ in at least as many shingles as these in bits."""
    odd = np.bincount((h & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def similar(docs: DataFrame, least: float = 0.8, shingle: int = 5, most: int = 32, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """doc_id, component_id of every row: classes of texts whose word shingles are alike, Jaccard `least` or more.

    Fingerprints of 128 bits are covered by anchors in eight blocks of 15 checked bits: pairs within 15 bits surely meet, others
    if a block differs by one bit at most. Those of matching numbers of shingles within `most` bits are candidates, of which a
    forest in each anchor, shortest links first, is held against the whole texts. An exact check of the rest follows: similar sets
    share one of their first shingles (in any order that all have), so all pairs of different classes so far that do, and
    that sizes, places and 256 parities allow to be similar, are held against the whole texts too. No link between
    classes is lost, none is false. Texts without words are one class. Null texts are empty, equal sets of shingles one node;
    null ids take part in links but name no class.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    # by this key one row of a node is found again; a collision is told by the sum of its hashes
    rows = docs.select(docs[id_].cast("long").alias("doc_id"), docs[text].alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))

    def each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(x, shingle).view(np.int64))], ["h"])

    share = min(1.0, SAMPLE / max(1, docs.count()))
    some = rows.select("text").where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["text"])
    often = some.mapInArrow(each_shingle, "h long").groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(LATE).toArrow()
    hashes, counts = often.column(0).to_numpy().view(np.uint64), often.column(1).to_numpy()
    late = spark.sparkContext.broadcast((hashes[np.argsort(hashes)], counts[np.argsort(hashes)]))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x, shingle) for x in b.column(2).to_pylist()]
            numbers = np.array([(*described_set(h), *marks(h)) for h in sets], np.int64).reshape(-1, 8)
            firsts = pa.array([first_shingles(h, least, late.value).view(np.int64) for h in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c) for c in numbers.T.copy()), firsts], ["doc_id", "key", "f", "g", "n", "total", *bits, "firsts"])

    bits = ["m0", "m1", "m2", "m3"]
    each = stored(rows.select("doc_id", "key", "text").mapInArrow(describe, "doc_id long, key long, f long, g long, n long, total long, m0 long, m1 long, m2 long, m3 long, firsts array<long>"))
    nodes = cut(each.groupBy("f", "g", "n", "total").agg(F.min("doc_id").alias("least_id"), F.min("key").alias("key")).withColumn("node", F.monotonically_increasing_id()))

    def fitting(m: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.minimum(m, n) >= least * np.maximum(m, n) - 1e-6

    def near(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # sizes that allow the similarity, in a range of the homes sorted by size
        order = np.argsort(a[3], kind="stable")
        size = a[3][order]
        some = order[np.searchsorted(size, b[3].min() * least - 1e-9) : np.searchsorted(size, b[3].max() / least + 1e-9, "right")]
        off = apart([x[some] for x in a[1:3]], b[1:3])
        i, j = np.nonzero(off <= most)
        far, i = off[i, j], some[i]
        ok = (a[0][i] != b[0][j]) & fitting(a[3][i], b[3][j])
        return i[ok], j[ok], far[ok]

    def possible(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of rows (node, root, n, place, parities, shingles before) of different classes that may be similar, without
        those that meet at a shingle before this one too: of all that a pair shares, the first in both is never left out."""
        both = a[2][:, None] + b[2][None, :]
        i, j = np.nonzero((a[1][:, None] != b[1][None, :]) & (np.minimum((a[2] - a[3])[:, None], (b[2] - b[3])[None, :]) >= least / (1 + least) * both - 1e-6))
        far = sum(np.bitwise_count(x[i].view(np.uint64) ^ y[j].view(np.uint64)).astype(np.int64) for x, y in zip(a[4:8], b[4:8]))
        ok = (far <= (1 - least) / (1 + least) * both[i, j] + 1e-6) & fitting(a[2][i], b[2][j])
        i, j, far = i[ok], j[ok], far[ok]
        met = np.zeros(len(i), bool)
        for x in a[8:]:
            for y in b[8:]:
                met |= x[i] == y[j]
        return i[~met], j[~met], far[~met]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shingles(x, shingle) for x in b.column(2).to_pylist()]
            same = [i for i, (h, t) in enumerate(zip(got, b.column(1).to_pylist())) if int(h.sum(dtype=np.uint64).view(np.int64)) == t]
            ends = np.cumsum([0, *(len(got[i]) for i in same)]).astype(np.int32)
            flat = np.concatenate([got[i] for i in same]) if same else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(same, pa.int64())), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))], ["node", "h"])

    def holding(met: DataFrame, tell: Callable, whole: bool) -> DataFrame:
        """The candidates u, v that hold against the whole texts."""
        pairs = cut(met.mapInArrow(lambda it: compared(it, tell, whole), "u long, v long").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        wanted = cut(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(nodes.select("node", "key", "total"), "node"))
        found = stored(rows.select("key", "text").join(wanted, "key").select("node", "total", "text").mapInArrow(sets, "node long, h array<long>").dropDuplicates(["node"]))
        both = pairs.join(found.select(F.col("node").alias("u"), F.col("h").alias("a")), "u").join(found.select(F.col("node").alias("v"), F.col("h").alias("b")), "v")
        shared = F.size(F.array_intersect("a", "b"))
        out = cut(both.where(shared >= F.lit(least) * (F.size("a") + F.size("b") - shared) - 1e-9).select("u", "v"))
        dropped(found)
        return out

    met = meetings(nodes.select("node", "f", "g", "n"), ["f", "g"], _BLOCK, 16).sortWithinPartitions("anchor", "part", "visits", "n")
    links_ = holding(met, near, False)
    # the rest: pairs of different classes so far that share one of their first shingles
    classed = nodes.join(components(links_), "node", "left").select("node", "key", "f", "g", "n", "total", F.coalesce("root", "node").alias("root"))
    one = stored(each.drop("doc_id").join(classed, ["key", "f", "g", "n", "total"]).dropDuplicates(["key", "node"]).select("node", "root", "n", *bits, "firsts"))
    # what the later steps need, so that the first shingles, the bulk of both tables, go as soon as they can
    ids = stored(each.select("doc_id", "f", "g", "n", "total"))
    dropped(each)
    placed = one.select("node", "root", "n", F.posexplode("firsts").alias("place", "anchor")).withColumn("place", F.col("place").cast("long"))
    of_one = Window.partitionBy("anchor")
    mixed = stored(placed.select("*", F.min("root").over(of_one).alias("low"), F.max("root").over(of_one).alias("high")).where("low < high").drop("low", "high"))
    parities = stored(one.select("node", *bits))
    dropped(one)
    # where fewer stand before, a number that no other node has
    in_order = Window.partitionBy("node").orderBy("place")
    earlier = [F.coalesce(F.lag("anchor", k).over(in_order), -1 - F.col("node")).alias(f"b{k}") for k in range(1, BEFORE + 1)]
    columns = ["node", "root", "n", "place", *bits]
    spread = mixed.join(parities, "node").select("anchor", F.lit(False).alias("visits"), *columns, *earlier)
    more = holding(parted(spread, mixed.select("anchor"), [*columns, *(f"b{k}" for k in range(1, BEFORE + 1))]), possible, True)
    dropped(mixed, parities)
    roots = components(links_.unionByName(more))
    rooted = cut(nodes.join(roots, "node", "left").select("f", "g", "n", "total", "least_id", F.coalesce("root", "node").alias("root")))
    named = cut(rooted.join(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("f", "g", "n", "total", "component_id"))
    return ids.join(named, ["f", "g", "n", "total"]).select("doc_id", "component_id")

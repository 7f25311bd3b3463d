"""Operators against brute force, exact round trips and odd rows: nulls, empty and long texts, ties, repeats, empty tables."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from quillgraph.llm import bpe, langid, mixing, parsing, quality, simhash, suffixtree, toxicity, urls, vectors
from quillgraph.llm.components import components

WORDS = "the of and to in it was for with on as by at from that this have not are but".split()


def docs(spark, rows, extra=True):
    """doc_id, text, source, with a column whose name clashes with internal ones."""
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, row int")
    return df.withColumns({"key": F.lit(1), "score": F.lit("x"), "fp": F.lit(2)}) if extra else df


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing"]) for _ in range(n))


ODD = [(None, None, None), (1, "", "a"), (2, "  \n", "a"), (3, "one", None), (3, "one", None), (4, "é" * 5000, "b"), (5, "x y " * 4000, "b"), (6, "123 $$", "")]


# ---- links and components ------------------------------------------------------------------------------------------

def reach(nodes, pairs):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = reach({x for p in pairs for x in p}, pairs)
    assert got == {n: r for n, r in want.items() if n in got} and len(got) == len({x for p in pairs if p[0] != p[1] for x in p})
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 24))
    rows = [(i, (base[i % 12] + rng.normal(scale=0.05 + 0.03 * (i % 5), size=24)).tolist()) for i in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, [0.0] * 24), (204, [float("nan")] * 24), (205, [1.0, None]), (206, []), (207, [3.0, 4.0]), (208, [6.0, 8.0]), (209, [1e-30] * 24), (210, [1e30] * 24), (211, [float("inf")] * 24)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n int")
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_duplicates(df).collect()}
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in df.collect() if r["embedding"] and None not in r["embedding"] and np.isfinite(np.array(r["embedding"], float)).all() and np.any(np.array(r["embedding"], float))}
    u = {k: v / np.abs(v).max() for k, v in x.items()}
    pairs = [(a, b) for a in u for b in u if a < b and len(u[a]) == len(u[b]) and u[a] @ u[b] / np.linalg.norm(u[a]) / np.linalg.norm(u[b]) >= 0.95]
    roots = reach([i for i, _ in rows], pairs)
    want = {i: (sum(i in p for p in pairs), roots[i], roots[i] == i) for i, _ in rows}
    assert got == want and len(pairs) > 100
    assert vectors.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("cell,block", [(2_000, 65_536), (4, 65_536), (10, 7)])
def test_tiles(spark, cell, block, monkeypatch):
    """Several pivots and cells in parts find what one tile finds."""
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 8))
    x[45:] = x[:45] + rng.normal(scale=0.12, size=(45, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df, 0.9).collect()}
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [(a, b) for a in range(90) for b in range(a + 1, 90) if n[a] @ n[b] >= 0.9]
    roots = reach(range(90), pairs)
    assert got == {i: (sum(i in p for p in pairs), roots[i]) for i in range(90)}


def tile_rows(x, ids, many, one, two, second):
    import pyarrow as pa

    q, r, scale, e, f = vectors.quantised(vectors.unit(x))
    n = len(x)
    full = lambda v, k: pa.array([v] * n, k)
    return pa.RecordBatch.from_arrays([full(one, pa.int64()), full(two, pa.int64()), full(second, pa.bool_()), pa.array(ids), pa.array(many), pa.array(scale), pa.array(e), pa.array(f), vectors._binary(q), vectors._binary(r)], list("abcdefghij"))


@pytest.mark.parametrize("step", [1 << 21, 40])
def test_tiles_over_several_batches(step, monkeypatch):
    """A tile whose two blocks come in many batches counts every link once at both ends and joins what it links."""
    monkeypatch.setattr(vectors, "PRODUCTS", step)
    rng = np.random.default_rng(15)
    x = np.repeat(rng.normal(size=(6, 8)), 5, axis=0) + rng.normal(scale=0.02, size=(30, 8))
    ids, many = np.arange(30), 1 + np.arange(30) % 3
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    for second in (0, 1):  # one block with itself, or with a second one
        parts = [tile_rows(x[i : i + 4], ids[i : i + 4], many[i : i + 4], 3, 3 + second, False) for i in range(0, 20, 4)]
        if second:
            parts += [tile_rows(x[i : i + 3], ids[i : i + 3], many[i : i + 3], 3, 4, True) for i in range(20, 30, 3)]
        want, pairs = {}, []
        for a in range(20):
            for b in range(20, 30) if second else range(a + 1, 20):
                if n[a] @ n[b] >= 0.95:
                    want[a] = want.get(a, 0) + 1 + b % 3
                    want[b] = want.get(b, 0) + 1 + a % 3
                    pairs.append((a, b))
        got, edges = {}, []
        for b in vectors.compared(iter(parts), 0.95):
            for kind, u, v, k in zip(*(c.to_pylist() for c in b.columns)):
                assert kind < 2  # none of these is near the threshold
                if kind:
                    edges.append((u, v))
                else:
                    got[u] = got.get(u, 0) + k
        assert got == want and reach(range(30), edges) == reach(range(30), pairs)


@pytest.mark.parametrize("d", [3, 64, 768, 4096])
def test_error_bound(d):
    """Pairs on either side of the threshold by far less than float32 can tell, all components positive among them."""
    rng = np.random.default_rng(4)
    x = vectors.unit(np.concatenate([rng.normal(size=(40, d)), rng.random(size=(40, d)), np.ones((1, d)) + 1e-3 * rng.random(size=(20, d))]))
    least = 0.95
    for i in range(40):  # partners at the threshold, give or take 1e-7 to 1e-14
        y = rng.normal(size=d)
        y -= (y @ x[i]) * x[i]
        y /= np.linalg.norm(y)
        c = least + (1 if i % 2 else -1) * 10.0 ** -(7 + i % 8)
        x[40 + i] = c * x[i] + math.sqrt(1 - c * c) * y
    q = vectors.quantised(x)
    # products are exact
    p = vectors.products(q[0], q[0])
    assert (p == q[0].astype(np.int64) @ q[0].astype(np.int64).T).all()
    for e, part in ((q[3], 0), (q[4], q[1] / 254)):
        assert (np.linalg.norm(x - (q[0] + part) * q[2][:, None], axis=1) <= e).all()
    i, j, k, m = vectors.judged(q, q, least, True)
    sure, open_ = set(zip(i.tolist(), j.tolist())), set(zip(k.tolist(), m.tolist()))
    true = {(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if math.fsum(x[a] * x[b]) >= least}
    assert sure <= true <= sure | open_ and not sure & open_ and len(open_ - true) <= 60
    assert {(a, a + 40) for a in range(40)} <= open_


def test_ten_thousand_near_equal_vectors():
    import time

    rng = np.random.default_rng(5)
    x = rng.normal(size=64) + rng.normal(scale=0.02, size=(10_000, 64))
    began, rows, count = time.time(), 0, {}
    for b in vectors.compared(iter([tile_rows(x[i : i + 5000], np.arange(i, i + 5000), np.ones(5000, np.int64), 0, 0, False) for i in (0, 5000)]), 0.95):
        rows += len(b)
        for kind, a, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
            if not kind:
                count[a] = count.get(a, 0) + n
    assert set(count.values()) == {9_999} and len(count) == 10_000 and rows < 60_000 and time.time() - began < 60


def plain_fingerprint(t):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64(s, 42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(spark):
    rng = random.Random(5)
    rows = [(i, text(rng, 300), "a") for i in range(20)]
    for i in range(20, 90):
        w = rng.choice(rows)[1].split()
        w[rng.randrange(len(w))] = "new"
        rows.append((i, " ".join(w), "a"))
    rows = [(i + 100, t, s) for i, t, s in rows] + ODD
    got = simhash.classes(docs(spark, rows)).select("doc_id", simhash.hexadecimal(F.col("fp")).alias("f"), "component_id").collect()
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    assert sorted((str(r["doc_id"]), r["f"]) for r in got) == sorted((str(i), f"{f:016x}") for (i, _, _), f in zip(rows, fps))
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    roots = reach(range(len(rows)), pairs)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[roots[k]] = min(least.get(roots[k], i), i)
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted((str(i), str(least.get(roots[k]))) for k, (i, _, _) in enumerate(rows))
    assert len(set(roots.values())) < len(rows) - 20
    kept = simhash.kept(docs(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.classes(docs(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("homes", [1, 4, 1024])
def test_anchors(spark, homes, monkeypatch):
    """Every pair within three bits is linked, however anchors are split."""
    monkeypatch.setattr(simhash, "HOMES", homes)
    rng = random.Random(6)
    fps = set()
    for _ in range(8):
        c = rng.getrandbits(64)
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63, 7 << 61}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3]
    got = [(r["u"], r["v"]) for r in found.collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 for a, b in got)
    assert reach(signed, pairs) == reach(signed, got)


@pytest.mark.parametrize("homes", [1024, 3])
def test_similar_loses_no_pair(spark, homes, monkeypatch):
    """Short pairs around the threshold, whose fingerprints are far apart, with a passage that many texts share."""
    monkeypatch.setattr(simhash, "HOMES", homes)
    rng = random.Random(25)
    rows = []
    for i in range(240):
        words = [f"w{rng.randrange(9999)}" for _ in range(rng.randrange(25, 90))] + ("a passage that stands in many a text " * (i % 3 == 0)).split()
        n = len(words) - 4
        rows += [(2 * i, " ".join(words), "a"), (2 * i + 1, " ".join(words[n // 9 :] + [f"v{i}x{k}" for k in range(n // 9)]), "a")]
    sets = {i: set(simhash.shingles(t, 5).tolist()) for i, t, _ in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    assert len(pairs) > 200

    def met(a, b):
        """Whether the fingerprints of two texts come to one anchor."""
        f = [np.array(x, np.int64) for x in zip(*[simhash.described(rows[i][1], 5)[:2] for i in (a, b)])]
        anchor, home, at = simhash.anchors(f, simhash._BLOCK, 16)
        return bool(set(anchor[home & (at == 0)]) & set(anchor[at == 1]) or set(anchor[home & (at == 1)]) & set(anchor[at == 0]))

    assert any(not met(a, b) for a, b in pairs)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs(spark, rows)).collect()}
    assert got == reach(sets, pairs)


@pytest.mark.parametrize("homes", [1024, 7])
def test_similar_gives_a_pair_once(spark, homes, monkeypatch, tmp_path):
    """Texts of one origin, most of them just below the threshold, share many first shingles: a pair is given at one of them."""
    monkeypatch.setattr(simhash, "HOMES", homes)
    rng = random.Random(31)
    base = [f"w{rng.randrange(9999)}" for _ in range(400)]
    rows = []
    for i in range(60):
        words = base.copy()
        for k in rng.sample(range(400), 5 + i % 2):
            words[k] = f"v{i}x{k}"
        rows.append((i, " ".join(words), "a"))
    sets = {i: set(simhash.shingles(t, 5).tolist()) for i, t, _ in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    made, plain = tmp_path / "made", simhash.compared

    def counted(batches, near, whole=False):
        for b in plain(batches, near, whole):
            if whole:
                with open(made, "a") as f:
                    f.write("".join(f"{u} {v}\n" for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
            yield b

    monkeypatch.setattr(simhash, "compared", counted)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs(spark, rows)).collect()}
    assert got == reach(sets, pairs)
    lines = made.read_text().split("\n")[:-1]
    assert len(set(lines)) > 100 and len(lines) <= 1.5 * len(set(lines))


# ---- fingerprints --------------------------------------------------------------------------------------------------

M64 = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 32) * 0xFF51AFD7ED558CCD & M64
    x = (x ^ x >> 32) * 0xC4CEB9FE1A85EC53 & M64
    return x ^ x >> 32


BYTE = [mix((i + 1) * 0x9E3779B97F4A7C15 & M64) for i in range(256)]
PLACE = [mix((i + 1) * 0xD1342543DE82EF95 & M64) | 1 for i in range(64)]


def plain_sketch(t):
    """The fingerprint of one text, symbol by symbol."""
    if not t:
        return []
    names, bag = list(t), []
    for level in range(1, parsing.LEVELS[-1] + 1):
        wide = (lambda x: BYTE[x]) if level == 1 else (lambda x: x)
        runs = []
        for x in names:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        if level in parsing.RUNS:
            bag += [mix(wide(x) + 100 + level & M64) >> 32 for x, n in runs for _ in range(n // parsing.RUNS[level])]
        label = [x for x, _ in runs]
        for _ in range(3 if level == 1 else 4):
            nxt = []
            for i, x in enumerate(label):
                low = 1 if not i else (x ^ label[i - 1]) & -(x ^ label[i - 1])
                nxt.append(2 * ((low - 1).bit_count() if low else (8 if level == 1 and _ == 0 else 64)) + (1 if x & low else 0))
            label = nxt
        value = [wide(x) if n == 1 else mix(wide(x) + n * 0xFF51AFD7ED558CCD & M64) for x, n in runs]
        phrases = []
        for i, v in enumerate(value):
            if not i or (i < len(value) - 1 and label[i] > label[i - 1] and label[i] > label[i + 1]):
                phrases.append([])
            phrases[-1].append(v)
        names = [mix(sum(v * PLACE[k & 63] for k, v in enumerate(p)) + len(p) & M64) for p in phrases]
        if level in parsing.LEVELS:
            bag += [mix(x + level & M64) >> 32 for x in names]
    nth, out = {}, set()
    for x in bag:
        out.add(mix((x << 32 | nth.get(x, 0)) & M64) >> 32)
        nth[x] = nth.get(x, 0) + 1
    return sorted(out)[: parsing.KEEP]


def plain_likeness(a, b):
    if not a and not b or a == b:
        return 1.0
    low = sorted(set(a) | set(b))[: parsing.KEEP]
    j = len(set(low) & set(a) & set(b)) / len(low)
    return 2 * j / (1 + j)


def expected_edits(rows):
    order = sorted(rows, key=lambda r: (-r[0] if r[0] is not None else 1 << 70, r[1] or ""))
    for (i, t, _), (_, nxt, _) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        k = len(t) // 3
        e = t[: len(t) - k] + nxt[:k]
        a, b, c = (plain_sketch(x.encode()) for x in (t, e, nxt))
        text_of = lambda x: "".join(f"{h:08x}" for h in x)
        yield (i, len(t), hashlib.sha256(e.encode()).hexdigest(), text_of(a), text_of(b), round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9))


def test_parsing(spark):
    rng = random.Random(7)
    long = [text(rng, 400) for _ in range(12)]
    rows = [(i, t, "a") for i, t in enumerate(long, 10)] + ODD[1:] + [(50, "again " * 300, "a"), (51, "x" * 900, "a"), (52, "aabb" * 200 + "\n" * 40, "a")]
    got = [tuple(r) for r in parsing.compare_with_edited(docs(spark, rows).repartition(3)).collect()]
    assert sorted((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == sorted(expected_edits(rows))
    by_id = {r[0]: r for r in got}
    assert all(abs(by_id[i][5] - 2 / 3) < 0.2 and by_id[i][6] < 0.4 for i in range(11, 22))
    # texts of which a third changes keep two thirds, repetitive ones too
    for x in ("again " * 300, "x" * 900, "ab" * 500, *long):
        a, b = parsing.sketches([x.encode(), parsing.edited(x, text(rng, 500)).encode()])
        assert abs(parsing.likeness(a, b) - 2 / 3) < 0.2
    a, b = parsing.sketches([long[0].encode(), b"other words first " + long[0].encode()])
    assert parsing.likeness(a, b) > 0.85
    assert (parsing.sketches([x.encode() for x in long])[3] == parsing.sketches([long[3].encode()])[0]).all()
    assert parsing.compare_with_edited(docs(spark, rows).limit(0)).count() == 0
    nulls = parsing.compare_with_edited(docs(spark, [(None, None, None), (1, "abc", "s")])).collect()
    assert sorted(r["n_chars"] for r in nulls) == [0, 3]


def test_parsing_with_one_id_on_many_rows(spark, monkeypatch):
    """An id that fills several ranges: every row is still followed by the next in order of hash and text."""
    monkeypatch.setattr(parsing, "RANGE", 4000)
    rows = [(7 if i % 3 else i, f"text {i} " * (1 + i % 4), "a") for i in range(2500)]
    df = docs(spark, rows)
    got = [tuple(r)[:3] for r in parsing.compare_with_edited(df).collect()]
    order = [tuple(r) for r in df.select("doc_id", "text").orderBy(F.col("doc_id").desc(), F.xxhash64("text"), "text").collect()]
    want = [(i, len(t), hashlib.sha256(parsing.edited(t, n).encode()).hexdigest()) for (i, t), (_, n) in zip(order, order[1:] + order[:1])]
    assert sorted(got) == sorted(want)
    f = parsing.fingerprints(df.limit(3)).collect()
    assert all(r["fingerprint"] for r in f)


# ---- mixing --------------------------------------------------------------------------------------------------------

def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, text(rng, rng.randrange(1, 60)), f"s{min(rng.randrange(9), 3)}") for i in range(600)] + ODD
    got = mixing.plan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: float(k % 3 + 1) for k, s in enumerate(names)}
    held = set()
    while True:
        rest, w = sum(sizes.values()) - sum(3 * sizes[s] for s in held), sum(weight[s] for s in names if s not in held)
        new = {s for s in names if s not in held and rest * weight[s] / w > 3 * sizes[s]}
        if not new:
            break
        held |= new
    goal = {s: 3.0 * sizes[s] if s in held else rest * weight[s] / w for s in names}
    for r in got:
        assert r["target"] == pytest.approx(goal[r["source"]]) and r["copies"] <= 3 and r["source_size"] == sizes[r["source"]]
    taken = {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
    assert all(abs(taken[s] - goal[s]) <= 0.02 * goal[s] for s in ("s0", "s1", "s2", "s3"))
    mixed = mixing.mix(docs(spark, rows))
    assert mixed.count() == sum(r["copies"] for r in got) and mixed.columns == docs(spark, rows).columns
    assert mixing.plan(docs(spark, rows).limit(0)).count() == 0 and mixing.mix(docs(spark, rows).limit(0)).count() == 0


def test_mixing_with_salts(spark, monkeypatch):
    rows = [(i, "a b c", f"s{i % 5}") for i in range(50)]
    want = sorted(tuple(r) for r in mixing.plan(docs(spark, rows)).select("doc_id", "source", "size", "source_size", "target", "copies").collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(tuple(r) for r in mixing.plan(docs(spark, rows)).select("doc_id", "source", "size", "source_size", "target", "copies").collect()) == want


# ---- classifiers ---------------------------------------------------------------------------------------------------

def test_toxicity(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        s = [text(rng, 8) for _ in range(6)]
        if bad:
            s[rng.randrange(6)] += " vilest " + rng.choice(["scumbag", "rottenish", "rottened"])
        rows.append((i, ". ".join(s), "a"))
        labels.append((i, int(bad)))
    df = docs(spark, rows).join(spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id")
    model = toxicity.fit(df.where("doc_id % 3 != 1"))
    odd = docs(spark, ODD)
    got = {r["doc_id"]: r for r in toxicity.score(df.where("doc_id % 3 = 1"), model).collect()}
    assert all((got[i]["score"] >= 0.7) == bool(y) for i, y in labels if i in got)
    bad = next(r for i, r in got.items() if i % 4 == 0)
    t = dict((i, t) for i, t, _ in rows)[bad["doc_id"]]
    assert bad["offending"] and all("vilest" in t[s["start"] : s["end"]] for s in bad["offending"])
    scores = [r["score"] for r in toxicity.score(odd, model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s < 0.7 for s in scores)
    none = toxicity.fit(df.limit(0))
    assert all(r["score"] < 0.7 for r in toxicity.score(odd, none).collect())


def test_quality(spark):
    rng = random.Random(10)
    rows = [(i, text(rng, 120) if i % 3 else " ".join(w.upper() + "!!" for w in text(rng, 120).split()), "a") for i in range(240)]
    df = docs(spark, rows).withColumn("quality", (F.col("doc_id") % 3 > 0).cast("int"))
    model = quality.fit(df.where("doc_id % 5 != 0"))
    got = {r["doc_id"]: r["score"] for r in quality.score(df.where("doc_id % 5 = 0"), model).collect()}
    assert all((s >= 0.3) == (i % 3 > 0) for i, s in got.items())
    odd = quality.score(docs(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    for few in (df.limit(0), df.where("quality = 1"), df.where("doc_id < 4")):
        assert all(0 <= r["score"] <= 1 for r in quality.score(docs(spark, ODD), quality.fit(few)).collect())


def test_language(spark):
    rng = random.Random(11)
    vocab = {"en": WORDS, "xx": "ška žel ňu ďob řep čiš".split(), "yy": "uoa aio eua oie".split()}
    rows = [(i, " ".join(rng.choice(vocab[l]) for _ in range(40)), l) for i, l in enumerate(["en", "xx", "yy"] * 60)]
    df = docs(spark, rows, extra=False).withColumn("lang", F.col("source"))
    model = langid.fit(df.where("doc_id % 4 != 2"))
    got = langid.identify(df.where("doc_id % 4 = 2"), model).collect()
    assert all(r["lang_pred"] == rows[r["doc_id"]][2] and 0.5 < r["score"] <= 1 for r in got)
    odd = {str(r["doc_id"]): r["lang_pred"] for r in langid.identify(docs(spark, ODD), model).collect()}
    assert [odd[k] for k in ("None", "1", "2", "6")] == ["und"] * 4 and odd["3"] in vocab
    assert all(r["lang_pred"] == "und" for r in langid.identify(df, langid.fit(df.limit(0))).collect())
    alone, _ = langid.predict([rows[5][1]], model)
    among, _ = langid.predict([t for _, t, _ in rows], model)
    assert alone[0] == among[5]


# ---- urls ----------------------------------------------------------------------------------------------------------

def test_urls(spark):
    rows = [
        ("http://A.example.COM/en/7?x", "a.example.com", "/en/7", "example.com/en/7", "allow"),
        ("http://shop.com/en/8#y", "shop.com", "/en/8", "com/en/", "block"),
        ("https://x.example.net/de/81/", "x.example.net", "/de/81/", "example.net/de/8", "block"),
        ("https://x.example.net/de/11", "x.example.net", "/de/11", "net/de/", "allow"),
        ("ftp://org/es/1", "org", "/es/1", "org/es/", "block"),
        ("https://notexample.com/fr/7", "notexample.com", "/fr/7", None, None),
        ("https://cheap-pills.example.org/fr/2", "cheap-pills.example.org", "/fr/2", None, "block"),
        ("https://ththed.example.org/fr/2", "ththed.example.org", "/fr/2", None, "allow"),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("http://h?q/en/", "h", "", None, None),
        ("http://" + "long." * 3000 + "com/en/", "long." * 3000 + "com", "/en/", "com/en/", "block"),
    ]
    df = spark.createDataFrame([(i, r[0], "x") for i, r in enumerate(rows)], "page_id long, url string, score string")
    for r in urls.judge(df).collect():
        _, host, path, rule, verdict = rows[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        urls.train(spark, [("x", 1.0)] * 501)


# ---- tokens and language model -------------------------------------------------------------------------------------

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_bpe(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(12)
    texts = [t for _, t, _ in ODD] + ["I'm 12³½ don't <|endoftext|>x<|startoftext|>", "ΣΑΣ İstanbul naïve é \x85\x1c a​b 中文字 ９", "'s's''", "\x00\x01 x", "😀👍🏽 x😀", "ﬁ Å ẞ ß", "a" * 3000]
    texts += ["".join(rng.choice("abc é'3!\n ſK<|") for _ in range(60)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.encode_decode(df, VOCABULARY).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)
    d = {r["doc_id"]: r for r in bpe.digest(bpe.encode_decode(df, VOCABULARY)).collect()}
    assert d[1]["n_tokens"] == 0 and d[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.encode_decode(df.limit(0), VOCABULARY).count() == 0


def test_long_fragments_merge_alike():
    with open(VOCABULARY, encoding="utf-8") as f:
        b = bpe.ForcedBoundaryBPE(f.read())
    rng = random.Random(13)
    for _ in range(50):
        s = "".join(rng.choice("ethaonis") for _ in range(90))
        assert b.merge(s) == b.merge_long(s)


def test_language_letters_above_the_first_plane():
    """Emoji are no letters; letters of the higher planes are."""
    seen, _, letter = langid.grams(["\U0001f600\U0001f601 \U0001f680", "\U0001f600a", "\U00010330\U00020000"])
    assert letter.tolist() == [False, True, True]
    assert 0x1F600 not in seen and 0x10330 in seen and 0x20000 in seen
    m = langid.LanguageModel(("de", "en"), np.zeros((1 << 15, 2), np.float32), np.zeros(2), 1.0)
    assert langid.predict(["\U0001f600"], m) == ([langid.UNDETERMINED], [0.0])


def plain_tree(train, depth, least, seen_from, gain, common):
    """score(text) of the tree by plain counting: a word that occurs too seldom is the symbol None."""
    counts = {}
    for t in train:
        for w in suffixtree.tokens(t):
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    symbols = {w for w, c in counts.items() if c >= common * n or not w}

    def root(w):
        return (counts.get(w, 0) + 1) / (n + v + 1)

    rare = 1 - sum(map(root, symbols))

    def seen(t):
        return [None, b"", *(w if w in symbols else None for w in suffixtree.tokens(t))]

    after = {}
    for t in train:
        s = seen(t)
        for i in range(2, len(s)):
            for k in range(1, depth + 1):
                c = tuple(s[max(i - k, 0) : i])
                if len(c) == k and None not in c:
                    d = after.setdefault(c, {})
                    d[s[i]] = d.get(s[i], 0) + 1
    kept = {}

    def p(c, a):
        if not c:
            return rare if a is None else root(a)
        up = p(c[1:], a)
        if c not in kept:
            return up
        return smoothed(after[c], a, up)

    def smoothed(d, a, up):
        own = {b: x - 1 for b, x in d.items() if x >= seen_from}
        return (own.get(a, 0) + (sum(d.values()) - sum(own.values())) * up) / sum(d.values())

    for k in range(1, depth + 1):
        level = {}
        for c, d in after.items():
            if len(c) == k and (k == 1 or sum(d.values()) >= least):
                if sum(x * math.log(smoothed(d, a, p(c[1:], a)) / p(c[1:], a)) for a, x in d.items()) >= gain:
                    level[c] = True
        kept.update(level)

    def score(t):
        s, total = seen(t), 0.0
        for i, w in enumerate(suffixtree.tokens(t), 2):
            c = tuple(s[max(0, i - depth) : i])
            while None in c:
                c = c[c.index(None) + 1 :]
            total += math.log10(root(w)) + math.log10(p(c, s[i]) / p((), s[i]))
        return total

    return counts, n, kept, p, score


@pytest.mark.parametrize("common,depth", [(0.0, 3), (0.004, 2), (0.02, 1)])
def test_suffix_tree(spark, common, depth):
    rng = random.Random(14)
    phrases = [[rng.choice(WORDS) + str(rng.randrange(12)) for _ in range(6)] for _ in range(12)] + [["one", "mid", "end", "left"], ["two", "mid", "end", "right"]] * 4
    rows = [(i + 100, " ".join(w for _ in range(12) for w in (rng.choice(phrases) if rng.random() < 0.6 else text(rng, 3).split())), "a") for i in range(70)] + ODD
    df = docs(spark, rows).withColumn("held", F.coalesce(F.col("doc_id") % 5 == 0, F.lit(True)))
    counts, total, kept, p, plain = plain_tree([t for i, t, _ in rows if i is not None and i % 5], depth, 8, suffixtree.SEEN, 10.0, common)
    assert {len(c) for c in kept} == set(range(1, depth + 1))
    assert sum(p(max(kept, key=len), a) for a in [*(w for w in counts if counts[w] >= common * total or not w), None]) == pytest.approx(1.0)
    for most in (1 << 20, 40, 0):
        got = suffixtree.score(df, ~F.col("held"), ("doc_id", "held"), depth=depth, symbol=common, common=common / 3, most=most).collect()
        assert len(got) == len(rows)
        by_id = {}
        for r in got:
            by_id.setdefault(r["doc_id"], r)
        for i, t, _ in rows:
            ws, r = suffixtree.tokens(t), by_id[i]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in counts for w in ws), total)
            assert r["base_score"] == pytest.approx(sum(math.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in ws))
            assert r["score"] == pytest.approx(plain(t), rel=1e-5), (most, i)
    held = [r for r in got if r["held"] and r["doc_id"] is not None and r["doc_id"] >= 100]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("n,fill,depth", [(12, 800_000, 1), (70, 0, 3)])
def test_every_word_of_the_tree_is_a_symbol(spark, n, fill, depth):
    """By default, however small its share of a long text, and whether it is broadcast or not."""
    rng = random.Random(24)
    phrases = [[f"{rng.choice(WORDS)}{rng.randrange(40)}" for _ in range(5)] for _ in range(6)] + [["one", "mid", "end", "left"], ["two", "mid", "end", "right"]] * (0 if fill else 4)
    rows = [(i, " ".join(w for _ in range(4 if fill else 12) for w in (rng.choice(phrases) if rng.random() < 0.7 else text(rng, 3).split())), "a") for i in range(2, n)]
    rows += [(100, "of it " * (fill // 2), "a"), (101, "unknown the0 " + " ".join(phrases[0]), "a")]
    df = docs(spark, rows).withColumn("held", F.col("doc_id") % 100 == 1)
    counts, total, kept, _, plain = plain_tree([t for i, t, _ in rows if i % 100 != 1], depth, 8, suffixtree.SEEN, 10.0, 0.0)
    assert any(len(c) == depth and all(counts[w] < (1e-5 if fill else 0.2) * total for w in c) for c in kept)
    for common, most in [(1e-6, 1 << 20)] if fill else [(0.06, 1 << 20), (0.06, 5), (2.0, 0)]:
        got = suffixtree.score(df, ~F.col("held"), depth=depth, common=common, most=most).collect()
        assert len(got) == len(rows)
        for r in got:
            t = dict((i, t) for i, t, _ in rows)[r["doc_id"]]
            assert r["score"] == pytest.approx(plain(t), rel=1e-5, abs=1e-7 * len(t)), (common, most, r["doc_id"])


def test_suffix_tree_on_odd_tables(spark, monkeypatch):
    """Empty tables, nothing to learn from, and texts cut into small runs of places."""
    rng = random.Random(16)
    rows = [(i, text(rng, 200), "a") for i in range(30)]
    df = docs(spark, rows)
    assert suffixtree.score(df.limit(0), F.lit(True)).count() == 0
    none = suffixtree.score(df, F.lit(False)).collect()
    assert len(none) == 30 and all(r["n_known"] == r["train_tokens"] == 0 and r["score"] == r["base_score"] == 0 for r in none)
    seq, starts = suffixtree.stream([[2, 3, 1], [4, 1], [1]])
    whole = [list(suffixtree.pieces(seq, starts, 3))]
    monkeypatch.setattr(suffixtree, "_CHUNK", 4)
    cut = list(suffixtree.pieces(seq, starts, 3))
    for k in (1, 3):
        assert np.concatenate([c[k] for c in cut]).tolist() == whole[0][0][k].tolist()
    for k in range(3):
        assert np.concatenate([c[2][k] for c in cut]).tolist() == whole[0][0][2][k].tolist()


@pytest.mark.parametrize("n,size", [(0, 16), (1, 16), (3000, 16), (60_000, 20)])
def test_filters_bits_in_a_row_for_each_slice(spark, n, size):
    """A task gives a row for each slice of the filter, not for each bit; the filter of a table is the same bit by bit."""
    keys = np.unique(np.random.default_rng(21).integers(-(1 << 62), 1 << 62, n))
    batches = [pa.RecordBatch.from_arrays([pa.array(k)], ["key"]) for k in np.array_split(keys, 7) if len(k)]
    rows = [(k, x) for b in suffixtree.set_bits(iter(batches), size) for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    cut = min(size, 18)
    assert len(rows) == min(n, 1 << (size - cut))
    expected = np.zeros(1 << size, bool)
    for at in suffixtree.places(keys, size):
        expected[at] = True
    assert np.flatnonzero(expected).tolist() == sorted((k << cut) + x for k, some in rows for x in some)
    bits = suffixtree.filter_of(spark.createDataFrame(pa.table({"key": keys})))
    assert suffixtree.passes(bits, keys).all()
    if len(bits) * 8 == 1 << size:
        assert (np.unpackbits(bits, bitorder="little") == expected).all()


def test_table_of_numbers():
    rng = np.random.default_rng(17)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, 5000))
    keys = np.concatenate([keys, [0, 1 << 20, 2 << 20, 3 << 20]])
    t = suffixtree.Table(keys, np.arange(len(keys)))
    value, known = t.get(np.concatenate([keys, keys + 1]))
    assert known[: len(keys)].all() and not known[len(keys) :].any() and (value[: len(keys)] == np.arange(len(keys))).all()

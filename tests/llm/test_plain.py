"""Trained operators against plain Python: loops over dictionaries, products of probabilities, one number at a time."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from quillgraph.llm import langid, quality, toxicity

WORDS = "the of and to in it was for with on as by at from that this have not are but".split()
ODD = [None, "", "  \n", "one", "123 $$", "é" * 3000, "x y " * 3000, "😀😀", "İstanbul. the of! not\nare"]


def text(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", "s", "ing"]) for _ in range(n))


# ---- toxicity ------------------------------------------------------------------------------------------------------

def plain_sentences(t):
    """(start, end, features) of the sentences with words, in lower case that keeps each code point's place."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in t)
    out = []
    for m in re.finditer(r"[^.!?\n]+", low):
        names = {n for w in re.findall(r"\w+", m.group()) for n in (w, *("^" + w[:k] for k in range(3, min(len(w), 9) + 1)))}
        if names:
            out.append((m.start(), m.end(), {crc32(n.encode()) % 2**20 for n in names}))
    return out


def plain_noisy_or(docs, labels, steps=200, rate=0.1, l1=0.05, start=-7.0):
    n, share = len(docs), sum(labels) / len(labels)
    df, bad = Counter(), Counter()
    for d, y in zip(docs, labels):
        for f in set().union(*d):
            df[f] += 1
            bad[f] += y
    w = {f: 0.0 for f in df if bad[f] > 1 and bad[f] > 1.5 * share * df[f]}
    docs = [[[f for f in s if f in w] for s in d] for d in docs]
    w[None] = start
    m, v = dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0)
    for t in range(1, steps + 1):
        g = dict.fromkeys(w, 0.0)
        for d, y in zip(docs, labels):
            p = [1 / (1 + math.exp(-w[None] - sum(w[f] for f in s))) for s in d]
            none = math.prod(1 - x for x in p)
            lead = none / (1 - none) if y else -1.0
            for s, x in zip(d, p):
                for f in [*s, None]:
                    g[f] += lead * x / n
        for f in w:
            m[f] = 0.9 * m[f] + 0.1 * g[f]
            v[f] = 0.99 * v[f] + 0.01 * g[f] ** 2
            step = rate / (math.sqrt(v[f] / (1 - 0.99**t)) + 1e-6)
            w[f] += step * m[f] / (1 - 0.9**t)
            if f is not None:
                w[f] = max(w[f] - step * l1 / n, 0.0)
    return w


def test_toxicity_is_the_plain_noisy_or(spark):
    rng = random.Random(3)
    rows = []
    for i in range(90):
        s = [text(rng, 5) for _ in range(4)]
        if i % 3 == 0 or i % 17 == 0:
            s[rng.randrange(4)] += " " + rng.choice(["vilest", "rottenish", "rottened"])
        rows.append((i, ". ".join(s), int(i % 3 == 0)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.fit(labelled)
    want = plain_noisy_or([[f for _, _, f in plain_sentences(t)] for _, t, _ in rows], [y for _, _, y in rows])
    assert got.offset == pytest.approx(want[None], abs=1e-6) and got.weights
    for f in {*got.weights, *want} - {None}:
        assert got.weights.get(f, 0.0) == pytest.approx(want[f], abs=2e-3)  # weights up to 1e-3 are not kept
    texts = [t for _, t, _ in rows] + ODD
    seen = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), got).collect()
    assert len(seen) == len(texts)
    for r in seen:
        p = [(a, b, 1 / (1 + math.exp(-got.offset - sum(got.weights.get(f, 0.0) for f in s)))) for a, b, s in plain_sentences(texts[r["doc_id"]] or "")]
        assert r["score"] == pytest.approx(1 - math.prod(1 - x for _, _, x in p), abs=1e-9)
        assert [(s["start"], s["end"]) for s in r["offending"]] == [(a, b) for a, b, x in p if x >= 0.5]


# ---- quality -------------------------------------------------------------------------------------------------------

def plain_difference(t, m):
    """Each block of 512 bytes with a compressor of its own."""
    raw, total = (t or "").encode(), [0, 0]
    for at in range(0, len(raw), 512):
        for k, content in enumerate((m.good, m.bad)):
            d = zstandard.ZstdCompressionDict(content)
            d.precompute_compress(level=m.level)
            total[k] += len(zstandard.ZstdCompressor(level=m.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(raw[at : at + 512]))
    return (total[1] - total[0]) / sum(total) if raw else 0.0


def test_quality_is_the_plain_size_difference(spark):
    rng = random.Random(4)
    kinds = (WORDS, "buy now free win cash prize click here offer deal".split())
    rows = [(i, text(rng, 60, kinds[i % 2]), int((i % 2 == 0) ^ (i % 11 == 0))) for i in range(150)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    m = quality.fit(labelled)
    apart = {r[0] for r in labelled.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), F.lit(3)) == 2).select("doc_id").collect()}
    x, y = np.array([(plain_difference(t, m), y) for i, t, y in rows if i in apart]).T
    assert 0 < len(x) < len(rows) and 0 < y.mean() < 1
    # the curve is the most likely one under its ridge: no slope left in either parameter
    rest, scale = y - 1 / (1 + np.exp(-(m.slope * x + m.offset))), x.std()
    assert abs(rest.sum() - 1e-3 * m.offset) < 1e-5 and abs((rest * x / scale).sum() - 1e-3 * m.slope * scale) < 1e-5
    texts = [t for _, t, _ in rows[:40]] + [rows[0][1] * 9, *ODD]
    seen = quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()
    assert len(seen) == len(texts)
    for r in seen:
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-m.slope * plain_difference(texts[r["doc_id"]], m) - m.offset)), abs=1e-9)


# ---- language ------------------------------------------------------------------------------------------------------

def plain_grams(t):
    """How often each bucket comes: one to three characters from each place, two blanks at the end, zeros beyond."""
    cps = [ord(c) if c.isalpha() else 32 for c in t.lower() + "  "] + [0, 0]
    out = Counter()
    for i in range(len(cps) - 2):
        h = 0
        for n in range(3):
            h = (h ^ cps[i + n]) * 0x9E3779B1 % 2**32
            h ^= h >> 15
            out[(h + n + 1) * 0x9E3779B1 % 2**32 >> 17] += 1
    return out


def softmax(z):
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def plain_ftrl(rows, epochs=3, alpha=0.3, beta=1.0, l1=0.02, l2=0.02, scale=20.0):
    """Weight of (bucket, language), offsets and temperature; rows (language, text) in the operator's order of hashes."""
    grams = [(lang, plain_grams(t)) for lang, t in rows]
    df = Counter(b for _, c in grams for b in c)
    idf = {b: math.log((1 + len(rows)) / (1 + n)) + 0.1 for b, n in df.items()}
    each = []
    for lang, c in grams:
        ids, total = sorted(c), sum(c.values())
        share = np.array([c[b] / total for b in ids], np.float32)
        each.append((langid.hash_bytes(np.array(ids, np.int32).tobytes() + share.tobytes()), lang, dict(zip(ids, share.tolist()))))
    each.sort(key=lambda r: r[:2])
    langs = sorted({r[0] for r in rows})
    z, n = Counter(), Counter()

    def solved(key, l1):
        return 0.0 if abs(z[key]) <= l1 else -(z[key] - math.copysign(l1, z[key])) / ((beta + math.sqrt(n[key])) / alpha + l2)

    def logits(share, by):
        return [solved((None, k), 0.0) + sum(s * idf[b] * scale * by(b, k) for b, s in share.items()) for k in langs]

    for _ in range(epochs):
        for i, (_, lang, share) in enumerate(each):
            if i % 5 == 0:
                continue
            w = {(b, k): solved((b, k), l1) for b in [*share] for k in langs} | {(None, k): solved((None, k), 0.0) for k in langs}
            p = softmax(logits(share, lambda b, k: w[b, k]))
            for k, q in zip(langs, p):
                for b, x in [*((b, s * idf[b] * scale) for b, s in share.items()), (None, 1.0)]:
                    g = x * (q - (k == lang))
                    z[b, k] += g - (math.sqrt(n[b, k] + g * g) - math.sqrt(n[b, k])) / alpha * w[b, k]
                    n[b, k] += g * g
    kept = [(lang, logits(share, lambda b, k: solved((b, k), l1))) for _, lang, share in each[::5]]
    tries = [0.2 * 100 ** (i / 79) for i in range(80)]
    loss = [sum(-math.log(softmax([x / t for x in zs])[langs.index(lang)] + 1e-12) for lang, zs in kept) for t in tries]
    return langs, {(b, k): solved((b, k), l1) * idf[b] * scale for b in df for k in langs}, [solved((None, k), 0.0) for k in langs], tries[loss.index(min(loss))]


def test_language_is_the_plain_ftrl(spark):
    rng = random.Random(5)
    vocab = {"en": WORDS, "xx": "ška žel ňu ďob řep čiš the of".split(), "yy": "uoa aio eua oie 𐐀𐐁".split()}
    rows = [(lang, " ".join(rng.choice(vocab[lang]) for _ in range(rng.randrange(3, 14)))) for lang in ["en", "xx", "yy"] * 20]
    labelled = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    m = langid.fit(labelled)
    langs, weights, offset, temperature = plain_ftrl(rows)
    assert list(m.langs) == langs and m.temperature == pytest.approx(temperature) and m.offset == pytest.approx(offset, abs=1e-6)
    for (b, k), w in weights.items():
        assert float(m.weights[b, langs.index(k)]) == pytest.approx(w, rel=1e-4, abs=1e-4)
    assert np.count_nonzero(m.weights) == sum(w != 0 for w in weights.values())
    texts = [t for _, t in rows] + ODD
    seen = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()
    assert len(seen) == len(texts)
    for r in seen:
        t = texts[r["doc_id"]] or ""
        if not any(c.isalpha() for c in t):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        c = plain_grams(t)
        p = softmax([(o + sum(x * weights.get((b, k), 0.0) for b, x in c.items()) / sum(c.values())) / temperature for k, o in zip(langs, offset)])
        assert r["score"] == pytest.approx(max(p), abs=1e-3)
        assert r["lang_pred"] == langs[p.index(max(p))] or sorted(p)[-1] - sorted(p)[-2] < 1e-3

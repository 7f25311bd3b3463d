"""Language-model scores by a probabilistic suffix tree over words.

A text is its words (A-Z lower-cased), then an end sign. The tree's contexts are the one to DEPTH symbols before a place, its
root is the add-one distribution of single words, the base. A context is kept where what follows it diverges from what
follows its suffix: where it betters the likelihood of what followed by GAIN nats, each occurrence being judged by the
counts of all others. Distributions are smoothed by discounting 1: what goes to the suffix's distribution is one occurrence of each next symbol, and
all of those seen fewer than SEEN times. Each place is scored in the state of its longest kept context.

Every word is a symbol of the tree, however rare. A word that is broadcast goes by its number, any other by a hash of 63
bits. (With a share `symbol` above 0, words below it are one symbol `rare`, which no context holds, and share its probability in
proportion to the base.) Contexts of more than one symbol are counted where they occur LEAST times. Counts of words and
contexts and the tree cover all training texts, grow with them and stay distributed. Broadcast are, whatever the input, at most: a
million words (COMMON), the SHARED most common entries of the tree, and filters of 2**_FILTER bits. Entries beyond are joined.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import arrow_limits, dropped, stored

#: Symbols of the longest context (three at most fit a number), times a context of two or more has to occur and a next symbol
#: to be seen in it, nats that keep a context.
DEPTH, LEAST, SEEN, GAIN = 2, 8, 3, 10.0
#: Shares of all tokens from which a word is a symbol of its own (0: every word is), and is broadcast rather than joined; entries of
#: the tree that are broadcast, bits of a filter.
SYMBOL, COMMON, SHARED, _FILTER = 0.0, 1e-6, 1 << 21, 28
#: Symbols: words that no context holds, and the end sign, which also stands before the first word; others follow. Names of
#: words and contexts by hash are negative and even; -1 is no context.
RARE, END = 0, 1
_WIDTH, _SIGN = 20, 1 << 63
#: Bits of a filter that go to the driver in one row.
_SLICE = 18
#: Bounds of what a Python worker holds: words counted, places of the text at a time, entries summed.
_FLUSH, _CHUNK, _MOST = 250_000, 1 << 19, 800_000


def tokens(text: str | None) -> list[bytes]:
    """Words of the lower-cased text, then the end sign (the empty word)."""
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out.append(b"")
    return out


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for x in b.column(0).to_pylist():
            seen.update(tokens(x))
            if len(seen) > _FLUSH:
                yield out()
                seen.clear()
    if seen:
        yield out()


def hashed(word: bytes) -> int:
    """The symbol of a word that isn't broadcast."""
    return ((xxhash.xxh64_intdigest(word, 42) | _SIGN) & -2) - (1 << 64)


# ---- places and their contexts -------------------------------------------------------------------------------------

def stream(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each after `rare` and an end sign, and where each begins with these two."""
    flat: list[int] = []
    starts = []
    for ids in texts:
        starts.append(len(flat))
        flat += (RARE, END)
        flat += ids
    return np.array(flat, np.int64), np.array(starts, np.int64)


def pieces(seq: np.ndarray, starts: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], np.ndarray]]:
    """For runs of places: first place, symbols, name of the context of each length (-1: none there), and which are scored."""
    for a in range(0, len(seq), _CHUNK):
        lead = min(a, depth)
        part = seq[a - lead : a + _CHUNK]
        before = np.concatenate([[RARE], part[:-1]])
        key = np.where(before != RARE, before, -1)
        ctx = [key[lead:]]
        for _ in range(1, depth):
            older = np.concatenate([[-1], key[:-1]])
            key = np.where((older != -1) & (before != RARE), extended(older, before), -1)
            ctx.append(key[lead:])
        real = np.ones(len(part) - lead, bool)
        at = starts[(starts >= a - 1) & (starts < a + _CHUNK)] - a
        for skip in (at, at + 1):
            real[skip[(skip >= 0) & (skip < len(real))]] = False
        yield a, part[lead:], ctx, real


def mixed(ctx: np.ndarray, sym: np.ndarray | int, level: int) -> np.ndarray:
    """One 64-bit name for a context (sym -1) or for a context and what follows it."""
    with np.errstate(over="ignore"):
        h = ctx.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (np.asarray(sym).astype(np.int64) + 2 + (level << 21)).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def extended(ctx: np.ndarray, sym: np.ndarray) -> np.ndarray:
    """Names of contexts by one newer symbol longer: packed if all are numbers, a hash otherwise."""
    out = ctx << _WIDTH | sym
    by_hash = np.flatnonzero((ctx < 0) | (sym < 0))
    out[by_hash] = (mixed(ctx[by_hash], sym[by_hash], 9) | np.int64(-_SIGN)) & np.int64(-2)
    return out


# ---- filters and tables of numbers ---------------------------------------------------------------------------------

def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a filter of 2**size bits that stand for each key."""
    h = mixed(keys, 0, 7).view(np.uint64)
    return (h & np.uint64((1 << size) - 1)).astype(np.int64), (h >> np.uint64(64 - size)).astype(np.int64)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key; never false for one that it holds."""
    a, b = places(keys, (len(bits) * 8).bit_length() - 1)
    return (bits[a >> 3] >> (a & 7).astype(np.uint8) & bits[b >> 3] >> (b & 7).astype(np.uint8) & 1) > 0


def set_bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(slice, bits): of a filter of 2**size bits, those that the keys set, a row for each slice of it once a task, or oftener
    if the task has many keys."""
    cut = min(size, _SLICE)
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        at = np.unique(np.concatenate(held))
        which, first = np.unique(at >> cut, return_index=True)
        bits = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array((at & (1 << cut) - 1).astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(which), bits], ["slice", "bits"])

    for b in batches:
        held += places(b.column(0).to_numpy(), size)
        if sum(map(len, held)) > 2 * _MOST:
            yield out()
            held.clear()
    if held:
        yield out()


def filter_of(keys: DataFrame) -> np.ndarray:
    """Bits of the filter of the distinct column `key`, set on the executors; 16 for each key, 2**_FILTER at most."""
    size = min(_FILTER, max(16, (16 * keys.count()).bit_length()))
    cut = min(size, _SLICE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column(1):
                some = np.zeros(1 << cut, bool)
                some[x.values.flatten().to_numpy()] = True
                rows.append(np.packbits(some, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], ["slice", "bits"])

    found = keys.select("key").mapInArrow(lambda it: set_bits(it, size), "slice long, bits array<int>").groupBy("slice").agg(F.collect_list("bits").alias("bits")).mapInArrow(pack, "slice long, bits binary").toArrow()
    out = np.zeros((1 << (size - cut), 1 << (cut - 3)), np.uint8)
    for k, x in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        out[k] = np.frombuffer(x, np.uint8)
    return out.ravel()


class Table:
    """Values of 64-bit keys, found for whole arrays at once: linear probing in an array half full at most."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = max(4, int(2 * len(keys) - 1).bit_length())
        self.mask = (1 << size) - 1
        self.keys, self.values = np.zeros(1 << size, np.int64), np.zeros(1 << size, np.float32)
        self.full = np.zeros(1 << size, bool)
        left, at = np.arange(len(keys)), keys & self.mask
        while len(left):
            free = ~self.full[at]
            slot, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.keys[slot], self.values[slot], self.full[slot] = keys[won], values[won], True
            stay = self.keys[at] != keys[left]
            left, at = left[stay], at[stay] + 1 & self.mask

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key (0 for others), and whether it is there."""
        value, known = np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        left, at = np.arange(len(keys)), keys & self.mask
        while len(left):
            there = self.full[at]
            left, at = left[there], at[there]
            same = self.keys[at] == keys[left]
            value[left[same]], known[left[same]] = self.values[at[same]], True
            left, at = left[~same], at[~same] + 1 & self.mask
        return value, known


# ---- the tree ------------------------------------------------------------------------------------------------------

def count_contexts(symbols: Callable[[], dict[bytes, int]], top: int, level: int, bits: Broadcast | None, words: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(ctx, sym, n): contexts of `level` symbols and what follows them, summed as far as memory allows; those the filter lets
    pass. Symbols are those below top, with a filter `words` also the hashed words in it, and then no others follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, some, more = symbols().get, bits and bits.value, words and words.value
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def fold() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ctx, sym, n = (np.concatenate(c) for c in zip(*held))
            # by context, so that what is shuffled compresses; pairs that this key confuses are summed later
            order = np.argsort((ctx << _WIDTH) + (sym & (1 << _WIDTH) - 1))
            ctx, sym, n = ctx[order], sym[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], (ctx[1:] != ctx[:-1]) | (sym[1:] != sym[:-1])]))
            return ctx[new], sym[new], np.add.reduceat(n, new)

        def out() -> pa.RecordBatch:
            ctx, sym, n = held[0]
            return pa.RecordBatch.from_arrays([pa.array(ctx), pa.array(sym), pa.array(n)], ["ctx", "sym", "n"])

        for b in batches:
            if more is None:
                seq, starts = stream([[get(w, RARE) for w in tokens(x)] for x in b.column(0).to_pylist()])
                seq[seq >= top] = RARE
            else:
                seq, starts = stream([[get(w) or hashed(w) for w in tokens(x)] for x in b.column(0).to_pylist()])
                far = np.flatnonzero(seq < 0)
                seq[far[~passes(more, seq[far])]] = RARE
            for _, sym, ctx, real in pieces(seq, starts, level):
                at = np.flatnonzero(real & (ctx[-1] != -1) & ((sym != RARE) if more is not None else True))
                if some is not None:
                    at = at[passes(some, ctx[-1][at])]
                if len(at):
                    held.append((ctx[-1][at], sym[at], np.ones(len(at), np.int64)))
                    if sum(len(h[0]) for h in held) > 2 * _MOST:
                        held[:] = [fold()]
                        if len(held[0][0]) > _MOST:
                            yield out()
                            held.clear()
        if held:
            held[:] = [fold()]
            yield out()

    return run


def keyed(level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(ctx, sym, n, value) to (key, n, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ctx, sym = b.column(0).to_numpy(), b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(mixed(ctx, sym, level)), b.column(2), b.column(3)], ["key", "n", "value"])

    return run


def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ctx, sym, n, p, s_ctx) with the names of the context that the symbol makes longer, and of that context's suffix."""
    for b in batches:
        ctx, sym, low = (b.column(i).to_numpy() for i in (0, 1, 4))
        new = [extended(ctx, sym), np.where(low == -1, sym, extended(low, sym))]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], *map(pa.array, new)], [*b.schema.names[:4], "name", "low"])


@dataclass
class Model:
    """What a Python worker needs to score: the words' symbols and logs, values of contexts of one such symbol, common entries
    and a filter of the others, and whether other words are symbols as well."""

    symbols: dict[bytes, int]
    logs: np.ndarray
    single: np.ndarray
    table: Table
    bits: np.ndarray | None
    depth: int
    every: bool

    def values(self, seq: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What contexts add to each text's score, and the entries that may be in the filter: text, key."""
        total, whose, keys = np.zeros(len(starts)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        seq = np.where(seq < len(self.single), seq, RARE)
        for a, sym, ctx, real in pieces(seq, starts, self.depth):
            gain = np.zeros(len(sym))
            for k, c in enumerate(ctx, 1):
                at = np.flatnonzero(real & (c != -1))
                if k == 1:
                    far, at = at[c[at] < 0], at[c[at] >= 0]
                    value = self.single[c[at]]
                    at, value = at[value < 0], value[value < 0]
                    gain[at] += value
                    far = far[self._look(mixed(c[far], -1, 1), far, a, gain, starts, whose, keys)]
                    at = np.concatenate([at, far])
                else:
                    at = at[self._look(mixed(c[at], -1, k), at, a, gain, starts, whose, keys)]
                self._look(mixed(c[at], sym[at], k), at, a, gain, starts, whose, keys)
            first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, a + len(sym), "left")
            total[first:last] += np.add.reduceat(gain, np.maximum(starts[first:last] - a, 0))
        return total, np.concatenate(whose), np.concatenate(keys)

    def _look(self, key: np.ndarray, at: np.ndarray, a: int, gain: np.ndarray, starts: np.ndarray, whose: list, keys: list) -> np.ndarray:
        """Adds the values of the keys at these places; whether each is or may be in the tree."""
        value, known = self.table.get(key)
        gain[at] += value
        if self.bits is not None:
            rest = np.flatnonzero(~known)
            rest = rest[passes(self.bits, key[rest])]
            whose.append(np.searchsorted(starts, a + at[rest], "right") - 1)
            keys.append(key[rest])
            known[rest] = True
        return known


_LOADED: dict[str, object] = {}


def _once(name: str, make: Callable[[], object], room: int = 1) -> object:
    """One object of that name for each Python worker, not for each task; earlier ones make room."""
    if name not in _LOADED:
        while len(_LOADED) >= room:
            _LOADED.pop(next(iter(_LOADED)))
        _LOADED[name] = make()
    return _LOADED[name]


def score(docs: DataFrame, learn: Column, keep: tuple[str, ...] = ("doc_id",), text: str = "text", depth: int = DEPTH, least: int = LEAST, seen: int = SEEN, gain: float = GAIN, symbol: float = SYMBOL, common: float = COMMON, most: int = SHARED) -> DataFrame:
    """The kept columns, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    learn: which rows teach (null: doesn't). Null and empty texts are one end sign; repeated rows are scored each; an empty
    table gives no rows; only the kept columns and the text are read, so others may have any name. base_score is the
    add-one unigram score of the tokens; without training rows the score is the base. Words that aren't broadcast and
    entries of the tree beyond the `most` most common are joined, summed by row before the rows meet: nothing common is shuffled.
    symbol: 0, and every word is a symbol; above, those with at least this share of all tokens.
    """
    if not 1 <= depth <= 3 or not 1 <= seen <= least:
        raise ValueError("contexts have one to three symbols, and occur at least as often as a next symbol of theirs")
    if 0 < symbol < 1e-6:
        raise ValueError("symbols by share are a million at most; 0 makes every word one")
    spark = docs.sparkSession
    run_id = uuid.uuid4().hex
    arrow_limits(spark)
    train = docs.where(F.coalesce(learn, F.lit(False))).select(docs[text].alias("text"))
    counts = stored(train.mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")))
    n, v = (int(x) for x in counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first())
    every = symbol <= 0
    often = counts.where((F.col("word") != F.lit(b"")) & (F.col("c") >= F.lit((common if every else min(common, symbol)) * n))).toArrow().sort_by([("c", "descending"), ("word", "ascending")])  # 1 / share words at most
    often = often.slice(0, (1 << _WIDTH) - 2) if every else often  # numbers fit their width
    words, c = often.column(0).to_pylist(), often.column(1).to_numpy()
    ends = next((r["c"] for r in counts.where(F.col("word") == F.lit(b"")).collect()), 0)
    own = c[c >= symbol * n]  # of the tree's symbols
    rest = n - ends - own.sum() + v - (ends > 0) - len(own)  # of `rare` so that its add-one share is that of all its words and an unknown one
    held = np.concatenate([[rest, ends], own])
    root, top = (held + 1) / (n + v + 1), len(held)
    shared = spark.sparkContext.broadcast([b"", *words])

    def symbols() -> dict[bytes, int]:
        return _once("symbols" + run_id, lambda: {w: i for i, w in enumerate(shared.value, END)}, 2)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = symbols().get
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([get(w) or hashed(w) for w in b.column(0).to_pylist()], pa.int64()), b.column(1)], ["sym", "n"])

    entries, single, bits, before, used, words_in = [], np.zeros(len(root)), None, None, [], None
    if every:  # a word seen less than `seen` times is in no pair that is
        alone = stored(counts.where(F.col("c") >= seen).mapInArrow(coded, "sym long, n long").withColumn("up", (F.col("n") + 1) / F.lit(float(n + v + 1))))
        words_in = spark.sparkContext.broadcast(filter_of(alone.where("sym < 0").select(F.col("sym").alias("key"))))
        used.append(alone)
    else:
        alone = F.broadcast(spark.createDataFrame(pa.table({"sym": np.arange(len(root)), "up": root, "n": held.astype(np.int64)})))  # 1 / symbol rows at most
    for level in range(1, depth + 1):
        if level > 1:
            times = before.where((F.col("n") >= least) & (F.col("sym") != RARE)).select(F.col("name").alias("ctx"), F.col("n").alias("all"), F.col("low").alias("s_ctx"))
            bits = spark.sparkContext.broadcast(filter_of(times.select(F.col("ctx").alias("key"))))
        pairs = train.mapInArrow(count_contexts(symbols, top, level, bits, words_in), "ctx long, sym long, n long").groupBy("ctx", "sym").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)
        # how often a context occurs is the count of it as a pair, one level down; so is its suffix's probability of the symbol
        if level == 1:
            pairs = pairs.join(alone.select(F.col("sym").alias("ctx"), F.col("n").alias("all")), "ctx").join(alone.select("sym", "up"), "sym").withColumn("s_ctx", F.lit(-1).cast("long"))
        else:
            pairs = pairs.join(times, "ctx").join(before.select(F.col("ctx").alias("s_ctx"), "sym", F.col("p").alias("up")), ["s_ctx", "sym"])
        pairs = stored(pairs.select("ctx", "sym", "n", "all", "up", "s_ctx"))
        stats = pairs.groupBy("ctx").agg(((F.max("all") - F.sum("n") + F.count(F.lit(1))) / F.max("all")).alias("rest"), (F.max("all") - F.sum("n")).alias("pooled"))
        p = (F.col("n") - 1) / F.col("all") + F.col("rest") * F.col("up")
        bettered = F.sum(F.col("n") * F.log(p / F.col("up"))) + F.max(F.when(F.col("pooled") > 0, F.col("pooled") * F.log("rest")).otherwise(0.0))
        good = pairs.join(stats, "ctx").groupBy("ctx").agg(F.max("all").alias("n"), F.max("rest").alias("rest"), bettered.alias("gain")).where(F.col("gain") >= gain)
        kept = stored(good.select("ctx", "n", "rest", F.log10("rest").alias("value")))
        known = pairs.join(kept.select("ctx", "rest"), "ctx", "left")
        used += [pairs, kept]
        if level < depth:
            lower = known.select("ctx", "sym", "n", F.when(F.col("rest").isNotNull(), p).otherwise(F.col("up")).alias("p"), "s_ctx")
            before = stored(lower.mapInArrow(longer, "ctx long, sym long, n long, p double, name long, low long"))
            used.append(before)
        followed = known.where(F.col("rest").isNotNull()).select("ctx", "sym", "n", F.log10(p / (F.col("rest") * F.col("up"))).alias("value"))
        if level == 1:
            near = kept.where("ctx >= 0").toArrow()  # as many as words are broadcast
            single[near.column(0).to_numpy()] = near.column(3).to_numpy()
        followed = followed.unionByName(kept.where("ctx < 0" if level == 1 else "true").select("ctx", F.lit(-1).cast("long").alias("sym"), "n", "value"))
        entries.append(followed.mapInArrow(keyed(level), "key long, n long, value double"))
    tree = entries[0]
    for e in entries[1:]:
        tree = tree.unionByName(e)
    tree = stored(tree)
    dropped(*used)
    # the most common entries, down to a step of their count
    step = F.floor(F.log2("n") * 32)
    bar, room = 0, most
    for r in sorted(tree.groupBy(step.alias("step")).count().collect(), reverse=True):
        if r["count"] > room:
            bar = r["step"] + 1
            break
        room -= r["count"]
    near, far = tree.where(step >= bar).select("key", "value").toArrow(), tree.where(step < bar)
    tables = (np.log10(np.concatenate([[0, ends], c]) + 1), single.astype(np.float32), near.column(0).to_numpy(), near.column(1).to_numpy().astype(np.float32), filter_of(far) if bar else None)
    parts = spark.sparkContext.broadcast(tables)
    low = float(np.log10(n + v + 1))

    def model() -> Model:
        def make() -> Model:
            logs, one, keys, values, rare = parts.value
            return Model({w: i for i, w in enumerate(shared.value, END)}, logs, one, Table(keys, values), rare, depth, every)

        return _once(run_id, make)

    values = counts.select(F.xxhash64("word").alias("key"), "c", F.lit(0.0).alias("value"))
    if bar:
        values = values.unionByName(far.select("key", F.lit(None).cast("long").alias("c"), "value"))
    kept = {f"kept{i}": c for i, c in enumerate(keep)}
    # the row number only ties the lines of one row together; rows and lines come from one pass
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), docs[text].alias("text"), *[docs[c].alias(k) for k, c in kept.items()])
    fields = [T.StructField(c, T.LongType()) for c in ("row", "key", "times", "n_tokens", "known")] + [T.StructField(c, T.DoubleType()) for c in ("logs", "gain")]
    lines = numbered.mapInArrow(lambda it: (lines_of(b, model(), n > 0) for b in it), T.StructType([*fields, *(T.StructField(k, docs.schema[c].dataType) for k, c in kept.items())]))
    found = lines.join(values, "key", "left")
    times = F.col("times")
    logs = F.coalesce("logs", F.lit(0.0)) + times * F.log10(F.coalesce("c", F.lit(0)) + 1)
    known = F.coalesce("known", F.lit(0)) + F.when(F.col("c") > 0, times).otherwise(0)
    more = F.coalesce("gain", F.lit(0.0)) + times * F.coalesce("value", F.lit(0.0))
    summed = found.groupBy("row").agg(*[F.max_by(k, "n_tokens").alias(k) for k in kept], F.sum("n_tokens").alias("n_tokens"), F.sum(known).alias("n_known"), F.sum(logs).alias("logs"), F.sum(more).alias("gain"))
    base = F.col("logs") - F.col("n_tokens") * F.lit(low)
    return summed.select(*[F.col(k).alias(c) for k, c in kept.items()], "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"))


def lines_of(b: pa.RecordBatch, model: Model, taught: bool) -> pa.RecordBatch:
    """A line for each row (sums over common words and entries), and one for each rarer word or entry in it."""
    rows = b.column(0).to_numpy()
    get = model.symbols.get
    ids, codes, whose, keys, times = [], [], [], [], []
    for i, x in enumerate(b.column(1).to_pylist()):
        words = tokens(x)
        own = [get(w, RARE) for w in words]
        ids.append(own)
        if RARE in own:
            other = Counter([w for w, k in zip(words, own) if not k])
            whose += [i] * len(other)
            keys += [xxhash.xxh64_intdigest(w, 42) for w in other]
            times += other.values()
            own = [k or hashed(w) for w, k in zip(words, own)] if model.every else own
        codes.append(own)
    seq, starts = stream(ids)
    n_tokens = np.diff(starts, append=len(seq)) - 2
    common = seq != RARE
    common[starts + 1] = False
    logs = np.add.reduceat(np.where(common, model.logs[seq], 0.0), starts)
    gain, who, key = model.values(stream(codes)[0], starts)
    order = np.lexsort((key, who))
    who, key = who[order], key[order]
    new = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (key[1:] != key[:-1])])) if len(who) else np.zeros(0, np.int64)
    many = np.diff(new, append=len(who)).astype(np.int64)
    m, k = len(rows), len(keys) + len(new)
    at = np.concatenate([np.array(whose, np.int64), who[new]]).astype(np.int64)

    def first(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.array(values, kind), pa.nulls(k, kind)])

    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([rows, rows[at]])),
            # a row's own line goes by a name of its own, so these lines spread evenly
            pa.array(np.concatenate([mixed(rows, 0, 5), np.array(keys, np.uint64).view(np.int64), key[new]])),
            pa.array(np.concatenate([np.zeros(m, np.int64), np.array(times, np.int64), many])),
            first(n_tokens, pa.int64()),
            first(np.add.reduceat(common.astype(np.int64), starts) if taught else np.zeros(m, np.int64), pa.int64()),
            first(logs, pa.float64()),
            first(gain, pa.float64()),
            *(pa.concat_arrays([c, pa.nulls(k, c.type)]) for c in b.columns[2:]),
        ],
        ["row", "key", "times", "n_tokens", "known", "logs", "gain", *b.schema.names[2:]],
    )

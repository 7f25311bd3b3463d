"""BPE encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side inside no token of the vocabulary can never be merged into one token,
whatever the merge order. Each such place is a certain cut: the fragments between cuts are encoded alone, and their ids
follow one another. Fragments recur far more often than words, so a bounded cache of fragments does most of the work.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import beside

#: Texts of these characters only take the short way; others are normalised and split by the library's own parts.
_RARE = re.compile("[^\x00-\x1b\x20-\x84\x86-ɏ‐-‧‰-⁞]")
_END = "</w>"
_CACHED = 400_000
_NONE = 1 << 60


def _last(c: str) -> str:
    """The symbol of a character that ends a word: one private character, so that fragments are plain strings."""
    return chr(0xE000 + ord(c))


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ForcedBoundaryBPE:
    """A tokenizer file of the `tokenizers` library (BPE with word ends), read once per Python worker."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        conf = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.vocab: dict[str, int] = conf["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in conf["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        if any(t.get(flag) for t in conf["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special tokens that take in white space or whole words only are not read here")
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.marks = tuple({t[:2] for t in self.special})
        ends = {t: t[: -len(_END) - 1] + _last(t[-len(_END) - 1]) for t in self.vocab if t.endswith(_END) and t != _END}
        self.ids = {ends.get(t, t): i for t, i in self.vocab.items()}
        self.rank = {(ends.get(a, a), ends.get(b, b)): i for i, (a, b) in enumerate(pairs)}
        self.inside = {t[i : i + 2] for t in self.ids for i in range(len(t) - 1)}
        self.letters = {b: ord(c) for b, c in byte_alphabet().items()}
        self.split = regex.compile(conf["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.fragments: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}

    def merge(self, s: str) -> tuple[int, ...]:
        """Merges of one fragment, lowest rank first, leftmost first among equals."""
        if len(s) > 100:
            return self.merge_long(s)
        parts, rank = list(s), self.rank.get
        ranks = [rank(p, _NONE) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != _NONE:
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), _NONE)
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), _NONE)
        return tuple([self.ids[x] for x in parts])

    def merge_long(self, s: str) -> tuple[int, ...]:
        """The same by a heap and links to the neighbours: n log n for very long fragments."""
        sym: list[str | None] = list(s)
        after, before = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        rank = self.rank
        heap = [(rank[p], i, p) for i, p in enumerate(zip(s, s[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            sym[i], sym[j] = a + b, None
            after[i] = k = after[j]
            if k < len(sym):
                before[k] = i
                if (p := (sym[i], sym[k])) in rank:
                    heapq.heappush(heap, (rank[p], i, p))
            if (h := before[i]) >= 0 and (p := (sym[h], sym[i])) in rank:
                heapq.heappush(heap, (rank[p], h, p))
        return tuple(self.ids[x] for x in sym if x is not None)

    def word(self, shown: str) -> tuple[int, ...]:
        """Ids of one pre-token in the byte alphabet: cut at the certain places, then fragment by fragment."""
        s, inside = shown[:-1] + _last(shown[-1]), self.inside
        cuts = [i for i in range(1, len(s)) if s[i - 1 : i + 1] not in inside]
        if not cuts:
            return self.fragment(s)
        return tuple([x for a, b in zip([0, *cuts], [*cuts, len(s)]) for x in self.fragment(s[a:b])])

    def fragment(self, s: str) -> tuple[int, ...]:
        if (ids := self.fragments.get(s)) is None:
            if len(self.fragments) > _CACHED:
                self.fragments.clear()
            ids = self.merge(s)
            if len(s) < 64:
                self.fragments[s] = ids
        return ids

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a lower-cased text without white space."""
        if (ids := self.chunks.get(chunk)) is None:
            if len(self.chunks) > _CACHED:
                self.chunks.clear()
            words = (chunk,) if chunk.isascii() and chunk.isalpha() else self.split.findall(chunk)
            ids = tuple([i for x in words for i in self.word(x.encode().decode("latin-1").translate(self.letters))])
            if len(chunk) < 64:
                self.chunks[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, chunk = self.chunks.get, self.chunk
        for piece in self.cut_special.split(text) if any(m in text for m in self.marks) else (text,):
            if piece in self.special:
                out.append(self.special[piece])
            elif _RARE.search(piece):
                for shown, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece)):
                    out.extend(self.word(shown))
            else:
                for c in piece.lower().split():
                    out.extend(known(c) or chunk(c))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: tokens with one space between; unknown ids are left out."""
        return " ".join([t for t in map(self.token.get, ids) if t is not None])


_LOADED: dict[int, ForcedBoundaryBPE] = {}


def tokenizer(spec: str) -> ForcedBoundaryBPE:
    """One instance, with its caches, for each Python worker and file."""
    if (key := hash(spec)) not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ForcedBoundaryBPE(spec)
    return _LOADED[key]


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, `ids` (array of int) and `decoded` (string) of every whole text.

    vocabulary: path of the tokenizer file, read on the driver and broadcast (its size is that of the file, a few MB).
    Null and empty texts have no ids and decode to the empty text. One pass, no shuffle; rows, repeated ones included,
    are kept as they come, and an empty table gives none; other columns are dropped, whatever their names.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        bpe = tokenizer(spec.value)

        def run(texts: list) -> list[pa.Array]:
            flat: list[int] = []
            ends, decoded = [0], []
            for x in texts:
                ids = bpe.encode(x) if x else []
                flat.extend(ids)
                ends.append(len(flat))
                decoded.append(bpe.decode(ids))
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())), pa.array(decoded, pa.string())]

        return run

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    found = beside(docs.select(*keep, *([] if text in keep else [text])), start, fields, text)
    return found.select(*[F.col(f"row.{c}") for c in keep], "ids", "decoded")


def digest(encoded: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_tokens and the SHA-256 of the ids (decimal, joined by one space) and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(*keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

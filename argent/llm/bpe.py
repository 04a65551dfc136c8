"""BPE encoding and decoding with a pair occurrence index."""

from __future__ import annotations

import heapq
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from argent.llm.common import add_columns, column

#: Chunks (runs between spaces) and words whose ids a task remembers.
CHUNKS, WORDS = 400_000, 200_000
#: Texts encoded together.
TEXTS = 250
#: Words merged together; bounds the arrays of the index.
TOGETHER = 10_000


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    own = set(plain)
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary with word ends, read from a tokenizer file.

    Text is cut at its special strings, normalised (NFC, white space to one
    space, lower case by code point) and split by the file's pattern; each
    piece is spelled in byte letters, the last with the end mark.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.spelled = dict(enumerate(letters[:128]))
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: by rank: the two symbols and what they make; and the rank by pair
        self.pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self.ranks = {a << 20 | b: r for r, (a, b, _) in enumerate(self.pairs)}
        #: symbols of the bytes within a word, then at its end; the byte of a letter; ranks of pairs of them
        symbols = [vocab[c + e] for e in ("", self.end) for c in letters]
        self.byte_symbols = np.array(symbols)
        self.byte_of = np.zeros(512, np.int64)
        self.byte_of[[ord(c) for c in letters]] = np.arange(256)
        index = {x: i for i, x in enumerate(symbols)}
        self.byte_ranks = np.full((512, 512), -1)
        for r, (a, b, _) in enumerate(self.pairs):
            if a in index and b in index:
                self.byte_ranks[index[a], index[b]] = r
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        # only the normalizer and the pre-tokenizer are asked
        self.rules = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "post_processor": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}))

    def split(self, chunk: str) -> list[str | int]:
        """Pieces of a chunk, spelled in byte letters, and ids of special strings.

        ASCII is normalised and split here; for the rest, the tokenizer file's
        own normalizer and pre-tokenizer say what a letter or a number is.
        """
        out: list[str | int] = []
        for part in self.cut(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self.special[part])
            elif part.isascii():
                out += [w if w.isprintable() else w.translate(self.spelled) for w in self.pieces(part.lower())]
            else:
                out += [x for x, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(part))]
        return out

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words as 32-bit bytes, all merged together.

        The words lie one after another in one array of symbols, linked within
        each word. An index holds, for the rank of every mergeable pair, all
        positions of the pair; the active ranks are applied in ascending order,
        each at all its positions from left to right, and the lists of the
        pairs that a merge makes are extended. A symbol that was merged into
        the one before it is marked -1.
        """
        n = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(n)
        at = self.byte_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        at[ends - 1] += 256
        left, right = np.arange(-1, len(at) - 1), np.arange(1, len(at) + 1)
        left[ends - n] = right[ends - 1] = -1
        rank = np.full(len(at), -1)
        rank[:-1] = self.byte_ranks[at[:-1], at[1:]]
        spots = np.flatnonzero(rank >= 0)
        spots = spots[np.argsort(rank[spots], kind="stable")]
        ranks, starts = np.unique(rank[spots], return_index=True)
        active, cuts, spots = ranks.tolist(), [*starts.tolist(), len(spots)], spots.tolist()
        where = {r: spots[cuts[i]:cuts[i + 1]] for i, r in enumerate(active)}
        sym, left, right = self.byte_symbols[at].tolist(), left.tolist(), right.tolist()
        rank_of, pairs, push, pop = self.ranks.get, self.pairs, heapq.heappush, heapq.heappop
        while active:  # in ascending order from the start: a heap
            r = pop(active)
            a, b, new = pairs[r]
            for p in sorted(where.pop(r)):
                q = right[p]
                if sym[p] != a or q < 0 or sym[q] != b:
                    continue  # an earlier merge took one of the two
                sym[p], sym[q] = new, -1
                right[p] = q = right[q]
                if q >= 0:
                    left[q] = p
                    if (r := rank_of(new << 20 | sym[q])) is not None:
                        if r in where:
                            where[r].append(p)
                        else:
                            where[r] = [p]
                            push(active, r)
                k = left[p]
                if k >= 0 and (r := rank_of(sym[k] << 20 | new)) is not None:
                    if r in where:
                        where[r].append(k)
                    else:
                        where[r] = [k]
                        push(active, r)
        ids = np.array(sym, np.int32)
        kept = ids >= 0
        data, ends = ids[kept].tobytes(), (4 * np.cumsum(kept)[ends - 1]).tolist()
        return {w: data[i:j] for w, i, j in zip(words, [0, *ends], ends)}


class Recent(dict):
    """What was looked up lately, at most ``limit`` entries besides those of one
    call, in two halves: when the newer is full, it becomes the older one."""

    def __init__(self, limit: int):
        self.limit, self.older = limit, {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys that are not known; the others are from now on in the newer half."""
        if len(self) > self.limit // 2:
            self.older = dict(self)
            self.clear()
        keys = keys - self.keys()
        again = keys & self.older.keys()
        self.update((k, self.older[k]) for k in again)
        return keys - again


class Encoder:
    """Encodes texts and remembers the ids of chunks and words, as 32-bit bytes, between calls."""

    def __init__(self, path: str, chunks: int = CHUNKS, words: int = WORDS):
        self.bpe = _bpe(path)
        self.chunks, self.words = Recent(chunks), Recent(words)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [x for i in range(0, len(texts), TEXTS) for x in self._encode(texts[i:i + TEXTS])]

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        chunks = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        pieces = {c: self.bpe.split(c) for c in self.chunks.missing({c for doc in chunks for c in doc})}
        words = self.words
        new = list(words.missing({w for ws in pieces.values() for w in ws if isinstance(w, str)}))
        for i in range(0, len(new), TOGETHER):
            words.update(self.bpe.encode_words(new[i:i + TOGETHER]))
        for c, ws in pieces.items():
            self.chunks[c] = b"".join([words[w] if isinstance(w, str) else array("i", [w]).tobytes() for w in ws])
        get = self.chunks.__getitem__
        return [b"".join(map(get, doc)) for doc in chunks]


def _lists(rows: list[bytes]) -> pa.Array:
    """Rows of 32-bit ids as an Arrow list array."""
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))


@lru_cache(1)
def _tokens(path: str) -> pa.Array:
    """Token strings by id, null where there is none."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    found = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out: list[str | None] = [None] * (max(found.values()) + 1)
    for t, i in found.items():
        out[i] = t
    return pa.array(out, pa.large_string())


@lru_cache(1)
def _bpe(path: str) -> Bpe:
    return Bpe(path)


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids",
               chunks: int = CHUNKS, words: int = WORDS) -> DataFrame:
    """``docs`` with the token ids of the whole text, in a column named ``ids``
    (replaced if there). Null and empty texts have no tokens. Map-only; a task
    remembers the ids of about ``chunks`` chunks and ``words`` words, which
    costs time or memory and changes no result. ``vocabulary`` is a tokenizer
    file that every executor has (or gets through ``spark.files``)."""
    return add_columns(docs, lambda b, e: [_lists(e.encode(column(b, text)))], [(ids, "array<int>")], lambda: Encoder(vocabulary, chunks, words))


def _decode(ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """Texts of lists of ids: the tokens joined by spaces."""
    n = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    flat = ids.flatten()
    inside = pc.and_kleene(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))
    words = tokens.take(pc.if_else(inside, flat, None))
    if words.null_count:
        owner = np.repeat(np.arange(len(n)), n)[pc.is_valid(words).to_numpy(zero_copy_only=False)]
        n, words = np.bincount(owner, minlength=len(n)), words.drop_null()
    ends = pa.array(np.cumsum([0, *n], dtype=np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(ends, words), pa.scalar(" ", pa.large_string())).cast(pa.string())


def bpe_decode(df: DataFrame, vocabulary: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids``: the tokens joined by spaces, special
    ones kept, as the file names no decoder. Null ids give an empty text; ids
    outside the vocabulary are left out."""
    return add_columns(df, lambda b, tokens: [_decode(b.column(b.schema.get_field_index(ids)), tokens)], [(text, "string")], lambda: _tokens(vocabulary))


def bpe_round_trip(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded",
                   chunks: int = CHUNKS, words: int = WORDS, with_text: bool = True) -> DataFrame:
    """:func:`bpe_decode` of :func:`bpe_encode`, in one pass: a task needs one
    Python worker instead of two, and the ids go to the JVM once. Without
    ``with_text`` the column of the texts is left out."""
    def run(b, state):
        encoder, tokens = state
        found = _lists(encoder.encode(column(b, text)))
        return [found, _decode(found, tokens)]
    return add_columns(docs, run, [(ids, "array<int>"), (decoded, "string")], lambda: (Encoder(vocabulary, chunks, words), _tokens(vocabulary)),
                       () if with_text else (text,))

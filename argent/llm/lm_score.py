"""Cross-entropy difference of documents under two matched n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from argent.llm.common import Hashes, column, map_groups, split
from argent.session import stored

#: A word of the shared vocabulary occurs at least so often, whatever the corpus.
LEAST = 2
#: Weight of the unigram estimate in a bigram's, and of the even one in a unigram's.
MU, ALPHA = 100.0, 1.0
#: A block of documents is closed when it has so many tokens; a task that adds
#: counts up gets those of about so many tokens.
BLOCK, ADDED = 2_000_000, 4_000_000
#: Words are 64-bit hashes; these stand for the rare words and the start of a text.
RARE, START = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Kinds of rows that go to a block: vocabulary, flags of documents, counts of words and of bigrams.
KNOWN, FLAG, WORDS, BIGRAMS = 0, 1, 2, 3


def _pack(*arrays: np.ndarray) -> bytes:
    """64-bit arrays as compressed bytes, byte by byte of all numbers."""
    sizes = np.array([len(a) for a in arrays], np.int64).tobytes()
    return sizes + zstandard.compress(b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays if len(a)), 1)


def _unpack(data: bytes, arrays: int, dtype=np.int64) -> list[np.ndarray]:
    sizes = np.frombuffer(data[:8 * arrays], np.int64)
    body, at, out = np.frombuffer(zstandard.decompress(data[8 * arrays:]), np.uint8), 0, []
    for n in sizes:
        out.append(np.ascontiguousarray(body[at:at + 8 * n].reshape(8, -1).T).view(dtype).reshape(-1) if n else np.zeros(0, dtype))
        at += 8 * n
    return out


def _words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _firsts(n: np.ndarray) -> np.ndarray:
    """Places of the first tokens of the texts with n tokens."""
    return (np.cumsum(n) - n)[n > 0]


def _bigrams(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit codes of the bigrams that end at each token; words are hashes."""
    left = np.empty_like(words)
    left[1:] = words[:-1]
    left[_firsts(n)] = START
    return left * FACTOR + words


def _parts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of ``keys`` by part and key, and each part that has some with its places in it."""
    p = (keys >> np.uint64(32)) % np.uint64(parts)
    order = np.lexsort((keys, p))
    p = p[order]
    cuts = [0, *(np.flatnonzero(p[1:] != p[:-1]) + 1).tolist(), len(p)]
    return order, [(int(p[a]), slice(a, b)) for a, b in zip(cuts, cuts[1:]) if b > a]


def _rows(block: int, kind: int, keys: np.ndarray, counts: list[np.ndarray], parts: int) -> Iterator[tuple]:
    """The keys of a block with their counts, packed by part."""
    order, found = _parts(keys, parts)
    keys, counts = keys[order], [c[order] for c in counts]
    for p, at in found:
        own = keys[at]
        yield kind, p, block, _pack(np.diff(own, prepend=np.uint64(0)), *(c[at].view(np.uint64) for c in counts))


def _added(rows: pa.Table, counts: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Distinct keys of the packed rows, the sums of their counts, and where each row's keys stand among them."""
    found = [_unpack(x, counts + 1, np.uint64) for x in rows.column("data").to_pylist()]
    keys = np.concatenate([np.cumsum(f[0], dtype=np.uint64) for f in found])
    own, at = np.unique(keys, return_inverse=True)
    sums = [np.bincount(at, weights=np.concatenate([f[c] for f in found]).view(np.int64), minlength=len(own)).astype(np.int64) for c in range(1, counts + 1)]
    return own, sums, np.split(at, np.cumsum([len(f[0]) for f in found])[:-1]), rows.column("block").to_numpy()


class _Block:
    """The documents of a block, in the vocabulary of all blocks."""

    def __init__(self, left: pa.Table, right: pa.Table, parts: int):
        self.number = left.column("block")[0].as_py()
        deltas, self.n, self.tokens = _unpack(left.column("data")[0].as_py(), 3)
        words = np.cumsum(deltas.view(np.uint64), dtype=np.uint64)
        rows = list(zip(*(right.column(c).to_pylist() for c in ("kind", "p", "data")))) if right.num_rows else []
        self.got = {kind: {p: data for k, p, data in rows if k == kind} for kind in (KNOWN, WORDS, BIGRAMS)}
        order, found = _parts(words, parts)
        known = np.zeros(len(words), bool)
        for p, at in found:
            known[order[at]] = _unpack(self.got[KNOWN][p], 1)[0] != 0
        self.flags = np.zeros(len(self.n), bool)
        self.flags[np.array([p for k, p, _ in rows if k == FLAG], np.int64)] = True
        self.coded = np.where(known, words, RARE)[self.tokens]
        self.of_token = np.repeat(self.flags, self.n)
        self.words, self.word = np.unique(self.coded, return_inverse=True)
        self.grams, self.gram = np.unique(_bigrams(self.coded, self.n), return_inverse=True)

    def counts(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of words: occurrences in target and all documents, and as the left of
        a bigram in both; of bigrams: occurrences in both."""
        inner = np.ones(len(self.coded), bool)
        inner[(np.cumsum(self.n) - 1)[self.n > 0]] = False

        def sums(at: np.ndarray, some: np.ndarray, size: int) -> np.ndarray:
            return np.bincount(at[some], minlength=size).astype(np.int64)
        t, every = self.of_token, np.ones(len(self.coded), bool)
        return ([sums(self.word, some, len(self.words)) for some in (t, every, t & inner, inner)],
                [sums(self.gram, some, len(self.grams)) for some in (t, every)])

    def totals(self, kind: int, keys: np.ndarray, counts: int, parts: int) -> list[np.ndarray]:
        """What came back for the block's keys, in their order."""
        order, found = _parts(keys, parts)
        out = [np.zeros(len(keys), np.int64) for _ in range(counts)]
        for p, at in found:
            for o, c in zip(out, _unpack(self.got[kind][p], counts)):
                o[order[at]] = c
        return out


def lm_scores(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) of every row.

    The target model is trained on the documents whose id is in ``target`` (a
    column ``id``), the background model on all documents; both are bigram
    models with the same smoothing over one vocabulary, the words (A-Z lower
    case) that occur at least ``least`` times and one symbol for the rest. The
    losses are mean negative logarithms of the probabilities per token; score
    is their difference, lower for documents more like the target. A null or
    empty text has no tokens and null losses; a null id is no target; with no
    target documents the target model is the smoothed even one. Rows are scored
    each for itself, texts whole, of any length; other columns are not read and
    an empty table gives an empty result.

    Texts become blocks of about BLOCK tokens (one text at least) and are read
    once; ids meet the targets without them. A block sends its distinct words,
    and later its bigrams with their counts, in parts by hash, each part packed
    in one row; the task of a part adds up what all blocks sent and answers each
    with the sums of the keys it sent, in their order, so keys go one way and
    counts the other, and a word that all blocks have is one number in each.
    All words and bigrams of all documents are counted; what is gathered grows
    with the corpus, in parts of about ADDED tokens, and the driver gets a few
    sums. Blocks meet the answers twice, by block number. Words and bigrams are
    told apart by 64-bit hashes.
    """
    base = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = base.schema["id"].dataType.simpleString()

    def encode(batches):
        hashes, number = Hashes(), TaskContext.get().partitionId() << 32
        ids, found, held = [], [], 0

        def block():
            n = np.array([len(x) for x in found], np.int64)
            words, at = np.unique(np.concatenate(found), return_inverse=True)
            data = _pack(np.diff(words, prepend=np.uint64(0)), n, at.astype(np.int64))
            size = len(n) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, number, np.int64)), pa.array([*range(len(n)), -1], pa.int32()), pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)]),
                 pa.array([*n.tolist(), None], pa.int64()), pa.array([None] * len(n) + [data], pa.binary())], names=["block", "pos", "id", "n", "data"])
        for batch in batches:
            for part in split(batch):
                new = [hashes.of(_words(t)) for t in column(part, "text")]
                cuts, size = [0], held
                for i, x in enumerate(new):  # a long text ends a block
                    size += len(x)
                    if size >= BLOCK:
                        cuts.append(i + 1)
                        size = 0
                cuts.append(len(new))
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        ids.append(part.column(part.schema.get_field_index("id")).slice(a, b - a))
                        found += new[a:b]
                    if k < len(cuts) - 2:
                        yield block()
                        number, ids, found = number + 1, [], []
                held = size
        if found:
            yield block()
    tokens = stored(base.mapInArrow(encode, f"block bigint, pos int, id {kind}, n bigint, data binary"), "tokens")
    texts, blocks = tokens.where("pos >= 0").select("block", "pos", "id", "n"), tokens.where("pos < 0").select("block", "data")
    marked = target.select(F.col("id").alias("id")).where("id is not null").distinct()
    flags = stored(texts.where("n > 0").join(marked, "id", "left_semi").select("block", "pos", "n"), "flags")
    sums = texts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("starts")).first()
    of_target = flags.agg(F.sum("n").alias("n"), F.count("*").alias("starts")).first()
    of = {"t": of_target["n"] or 0, "b": sums["n"] or 0}
    starts = {"t": of_target["starts"], "b": sums["starts"]}
    parts = max(16, -(-of["b"] // ADDED))
    packed, answer = "kind int, p int, block bigint, data binary", ["kind", "p", "block", "data"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=answer)

    def vocabulary(batches):
        """The words of each block with how often they occur there."""
        for batch in batches:
            for number, data in zip(*(c.to_pylist() for c in batch.columns)):
                deltas, _, at = _unpack(data, 3)
                words = np.cumsum(deltas.view(np.uint64), dtype=np.uint64)
                if len(words):
                    yield batch_of(list(_rows(number, KNOWN, words, [np.bincount(at, minlength=len(words)).astype(np.int64)], parts)))

    def known(rows: pa.Table) -> pa.RecordBatch:
        own, (n,), places, numbers = _added(rows, 1)
        ok = (n >= least).astype(np.int64)
        p = rows.column("p")[0].as_py()
        return batch_of([(KNOWN, p, b, _pack(ok[at])) for b, at in zip(numbers.tolist(), places)] + [(KNOWN, p, -1, _pack(np.array([ok.sum()])))])
    said = stored(map_groups(blocks.mapInArrow(vocabulary, packed), ["p"], known, packed), "vocabulary")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(_unpack(x, 1)[0][0]) for x in batch.column(0).to_pylist()], pa.int64())], names=["size"])
    size = said.where("block < 0").select("data").mapInArrow(sizes, "size bigint").agg(F.sum("size")).first()[0] or 0
    width = size + 2
    route = said.where("block >= 0").unionByName(flags.select(F.lit(FLAG).alias("kind"), F.col("pos").alias("p"), "block", F.lit(None).cast("binary").alias("data")))

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows:
            b = _Block(left, right, parts)
            words, grams = b.counts()
            rows = [*_rows(b.number, WORDS, b.words, words, parts), *_rows(b.number, BIGRAMS, b.grams, grams, parts)]
        return pa.Table.from_batches([batch_of(rows)]) if rows else pa.table({c: pa.array([], t) for c, t in zip(answer, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))})
    counted = blocks.groupBy("block").cogroup(route.groupBy("block")).applyInArrow(count, packed)

    def add(rows: pa.Table) -> pa.RecordBatch:
        what, p = rows.column("kind")[0].as_py(), rows.column("p")[0].as_py()
        _, totals, places, numbers = _added(rows, 4 if what == WORDS else 2)
        return batch_of([(what, p, b, _pack(*(t[at] for t in totals))) for b, at in zip(numbers.tolist(), places)])
    added = map_groups(counted, ["kind", "p"], add, packed)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["block", "pos", "target_loss", "background_loss"]
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(names, (pa.int64(), pa.int32(), pa.float64(), pa.float64()))})
        b = _Block(left, right, parts)
        nt, nb, ct, cb = b.totals(WORDS, b.words, 4, parts)
        gt, gb = b.totals(BIGRAMS, b.grams, 2, parts)
        first, some = _firsts(b.n), np.flatnonzero(b.n)
        losses = []
        for which, single, left_of, pair in (("t", nt, ct, gt), ("b", nb, cb, gb)):
            context = left_of[b.word].astype(np.float64)
            before = np.empty(len(context))
            before[1:] = context[:-1]
            before[first] = starts[which]
            even = (single + ALPHA) / (of[which] + ALPHA * width)
            total = np.concatenate([[0.0], np.cumsum(-np.log((pair[b.gram] + MU * even[b.word]) / (before + MU)))])
            ends = np.cumsum(b.n)[some]
            losses.append((total[ends] - total[ends - b.n[some]]) / b.n[some])
        return pa.table({"block": np.full(len(some), b.number, np.int64), "pos": some.astype(np.int32), "target_loss": losses[0], "background_loss": losses[1]})
    scored = blocks.groupBy("block").cogroup(route.unionByName(added).groupBy("block")).applyInArrow(score, "block bigint, pos int, target_loss double, background_loss double")
    out = texts.join(scored, ["block", "pos"], "left")
    return out.select(F.col("id").alias(id), F.col("n").alias("n_tokens"), "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("score"))

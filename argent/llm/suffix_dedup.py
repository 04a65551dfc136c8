"""Exact removal of long repeated byte strings by a distributed merge sort of
suffixes that knows common prefixes."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from argent.llm.common import KEY, add_columns, column, row_key, split
from argent.session import stored

#: Bytes of the strings that choose the sorted suffixes, and of a hashing chunk.
GRAM, CHUNK = 32, 1 << 20
#: Share of the suffixes sampled for the splitters (1 / SAMPLE), about the most
#: that reach the driver, and suffixes of a range and of a sorted run.
SAMPLE, MOST_SAMPLES, RANGE, RUN = 256, 20_000, 25_000, 50_000
#: Samples of a range that reach the driver even where they are more than MOST_SAMPLES.
RANGE_SAMPLES = 16
#: Merged entries that are looked through together, strings hashed at once, and
#: rows of a batch that a range returns.
BLOCK, CELLS, OUT_ROWS = 2048, 400_000, 50_000
#: Rows of a batch of sorted runs, and ranges of a task.
RUN_ROWS, TASK_RANGES = 200, 4
#: Pairs of rows compared at once.
PAIRS = 1024

_RNG = np.random.default_rng(20240607)
_TABLE = _RNG.integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Suffixes whose number is below this are sampled.
SAMPLED = (1 << 64) // SAMPLE


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Positions of a text chosen by its content.

    Of each ``width`` consecutive GRAM-byte strings the one with the least hash
    is chosen (all of them at a tie). Every string of width + GRAM - 1 bytes
    holds a chosen one, and equal strings hold them at equal places.
    """

    def __init__(self, length: int):
        self.width = length - GRAM + 1
        n = CHUNK + 2 * self.width + GRAM + 1
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def hashes(self, b: np.ndarray) -> np.ndarray:
        n = len(b) - GRAM + 1
        s = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_TABLE[b] * self.up[:len(b)], out=s[1:])
        h = (s[GRAM:] - s[:n]) * self.down[:n]
        h ^= h >> np.uint64(32)
        h *= _MIX
        return h ^ (h >> np.uint64(29))

    def _slide(self, x: np.ndarray, op) -> np.ndarray:
        """op over each ``width`` consecutive values, by blocks."""
        w, n = self.width, len(x)
        fill = np.iinfo(np.uint64).max if op is np.minimum else 0
        blocks = np.full(-(-n // w) * w, fill, np.uint64)
        blocks[:n] = x
        blocks = blocks.reshape(-1, w)
        ahead = op.accumulate(blocks, axis=1).ravel()
        behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return op(behind[:n - w + 1], ahead[w - 1:n])

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes), none for a text shorter than the strings."""
        whole, w = np.frombuffer(text, np.uint8), self.width
        places, grams = [], []
        for at in range(0, max(0, len(whole) - GRAM - w + 2), CHUNK) if len(whole) >= w + GRAM - 1 else ():
            start = max(0, at - w)
            # the last chunk takes the rest, shorter than a window or not
            stop = len(whole) if at + CHUNK > len(whole) - GRAM - w + 1 else at + CHUNK
            h = self.hashes(whole[start:min(len(whole), stop + w + GRAM)])
            least = self._slide(h, np.minimum)
            pad = np.zeros(w - 1, np.uint64)
            chosen = self._slide(np.concatenate([pad, least, pad]), np.maximum) == h
            p = np.flatnonzero(chosen) + start
            p = p[(p >= at) & (p < stop)]
            places.append(p)
            grams.append(h[p - start])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(places), np.concatenate(grams)


def suffix(text: bytes, p: int, length: int) -> tuple[bytes, int, int]:
    """(sort key, bytes on the right, on the left): the suffix at ``p`` cut at
    ``length`` bytes, then what stands before it, read backwards; padded."""
    right, left = text[p:p + length], text[max(0, p - length + GRAM):p][::-1]
    return right.ljust(length, b"\0") + left.ljust(length - GRAM, b"\0"), len(right), len(left)


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are not read."""
    x = int.from_bytes(a[known:], "big") ^ int.from_bytes(b[known:], "big")
    return len(a) - (x.bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> tuple[bytes, bytes]:
    """(common prefix with the key before, 16 bits each; the remaining bytes)."""
    lcp = [0, *(common(a, b, 0) for a, b in zip(keys, keys[1:]))]
    return np.array(lcp, np.uint16).tobytes(), b"".join([k[n:] for k, n in zip(keys, lcp)])


def decoded(lcp: bytes, rest: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """(key, common prefix with the key before) of a front-coded run."""
    at, key = 0, b""
    for n in np.frombuffer(lcp, np.uint16).tolist():
        key = key[:n] + rest[at:at + size - n]
        at += size - n
        yield key, n


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """(run, key, common prefix with the key before) in the order of all runs.

    A loser tree. Each entry carries its common prefix with the last winner of
    its node: the entry with the longer one is smaller, and only at equal ones
    are bytes read, from there on. Known prefixes are never compared again.
    """
    n = 1
    while n < len(runs):
        n *= 2
    ended = (None, 0)
    heads: list[tuple[bytes | None, int]] = [next(r, ended) for r in runs] + [ended] * (n - len(runs))
    heads = [(k, 0) for k, _ in heads]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser learns its common prefix with the winner."""
        (x, p), (y, q) = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if p != q:
            return (a, b) if p > q else (b, a)
        m = common(x, y, p)
        if m == len(x) or x[m] < y[m]:
            heads[b] = (y, m)
            return a, b
        heads[a] = (x, m)
        return b, a

    losers = [0] * n

    def build(node: int) -> int:
        if node >= n:
            return node - n
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    win = build(1) if n > 1 else 0
    while heads[win][0] is not None:
        key, p = heads[win]
        yield win, key, p
        heads[win] = next(runs[win], ended) if win < len(runs) else ended
        node = (win + n) // 2
        while node:
            win, losers[node] = play(win, losers[node])
            node //= 2


def scattered(places: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit number for each place of a text that looks drawn at random."""
    x = places.astype(np.uint64) * np.uint64(_BASE) + np.uint64(key & (1 << 64) - 1)
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= _MIX
    return x ^ (x >> np.uint64(29))


def _packed(x, dtype) -> bytes:
    return np.asarray(x, dtype).tobytes()


RUN_SCHEMA = ("range int, lcp binary, rest binary, sides binary, count binary, k1 binary, k2 binary, place binary")


def sorted_runs(texts: DataFrame, splitters: list[bytes], length: int) -> DataFrame:
    """Front-coded sorted runs of the chosen suffixes, cut at the splitters.
    Equal suffixes of a run are one entry with all their places."""
    def run(batches):
        held: dict[tuple[bytes, int, int], list[tuple[int, int, int]]] = {}

        def flush():
            entries = sorted(held)
            at = 0
            for r in range(len(splitters) + 1):
                to = bisect_left(entries, (splitters[r],)) if r < len(splitters) else len(entries)
                part = entries[at:to]
                at = to
                if part:
                    lcp, rest = front_coded([e[0] for e in part])
                    spots = [held[e] for e in part]
                    k1, k2, place = zip(*(x for s in spots for x in s))
                    yield (r, lcp, rest, _packed([e[1:] for e in part], np.uint8), _packed([len(s) for s in spots], np.int32),
                           _packed(k1, np.int64), _packed(k2, np.int64), _packed(place, np.int64))
            held.clear()

        def batches_of(rows):
            types = [pa.int32()] + [pa.binary()] * 7
            names = [x.split()[0] for x in RUN_SCHEMA.split(", ")]
            while some := list(islice(rows, RUN_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)
        n = 0
        for batch in batches:
            for part in split(batch):
                for k1, k2, text, places in zip(*(column(part, c) for c in (*KEY, "text", "places"))):
                    raw = text.encode()
                    for p in places:
                        held.setdefault(suffix(raw, p, length), []).append((k1, k2, p))
                    n += len(places)
                    if n >= RUN:
                        yield from batches_of(flush())
                        n = 0
        if held:
            yield from batches_of(flush())
    return texts.select(*KEY, "text", "places").mapInArrow(run, RUN_SCHEMA)


def repeated_cells(text: np.ndarray, spot: np.ndarray, hashes: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings ``spot`` (row of ``text`` * (reach + 1) + bytes on the
    left) stand in another row at the same place, byte for byte.

    Equal strings share a hash. Neighbours in the order of the hashes are
    compared, each pair of rows once for all its strings; where different
    strings share a hash, all strings of that hash are grouped by their bytes.
    """
    m, size = text.shape
    reach = size - length
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    a, b = order[first], order[first + 1]
    (row_a, left), (row_b, other) = np.divmod(spot[a], reach + 1), np.divmod(spot[b], reach + 1)
    pairs, at = np.unique(row_a * m + row_b, return_inverse=True)
    by_pair = np.argsort(at, kind="stable")
    equal = np.zeros(len(first), bool)
    ends = np.searchsorted(at[by_pair], np.arange(0, len(pairs) + PAIRS, PAIRS)).tolist()
    for lo, i, j in zip(range(0, len(pairs), PAIRS), ends, ends[1:]):
        some = by_pair[i:j]
        x, y = np.divmod(pairs[lo:lo + PAIRS], m)
        differ = np.zeros((len(x), size + 1), np.int32)
        np.cumsum(text[x] != text[y], axis=1, out=differ[:, 1:])
        start = reach - left[some]
        equal[some] = differ[at[some] - lo, start] == differ[at[some] - lo, start + length]
    equal &= left == other
    hit = np.zeros(len(spot), bool)
    hit[a[equal]] = hit[b[equal]] = True
    if not equal.all():
        shared = np.flatnonzero(np.isin(hashes, np.unique(hashes[a[~equal]])))
        groups: dict[tuple[int, bytes], list[int]] = {}
        for i in shared.tolist():
            row, n = divmod(int(spot[i]), reach + 1)
            groups.setdefault((n, text[row, reach - n:reach - n + length].tobytes()), []).append(i)
        for g in groups.values():
            hit[g] = len(g) > 1
    return hit


FOUND_SCHEMA = "_k1 bigint, _k2 bigint, lo bigint, hi bigint, h1 bigint, h2 bigint, open boolean"


def _found(k1, k2, lo, hi, h1=None, h2=None, open_=None) -> pa.RecordBatch:
    """A batch of FOUND_SCHEMA; without hashes, settled spans."""
    n = len(lo)
    long, none = pa.int64(), pa.nulls(n, pa.int64())
    cols = [pa.array(k1, long), pa.array(k2, long), pa.array(lo, long), pa.array(hi, long), none if h1 is None else pa.array(h1, long),
            none if h2 is None else pa.array(h2, long), pa.array(np.zeros(n, bool) if open_ is None else open_, pa.bool_())]
    return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in FOUND_SCHEMA.split(", ")])


def common_with(keys: np.ndarray, splitter: bytes) -> np.ndarray:
    """Length of the prefix that each row of ``keys`` has in common with a
    splitter, one less than the splitter at most: a key that begins with all of
    it is on its right, and so is every other such key."""
    n = len(splitter) - 1
    differ = np.ones((len(keys), n + 1), bool)
    np.not_equal(keys[:, :n], np.frombuffer(splitter, np.uint8)[:n], out=differ[:, :n])
    return differ.argmax(axis=1).astype(np.int32)


def block_repeats(keys: list[bytes], lcps: list[int], sides: list[list[int]], places: np.ndarray, counts: np.ndarray, edges: list[bytes],
                  length: int) -> Iterator[pa.RecordBatch]:
    """Starts of repeated strings of neighbouring entries of a range.

    ``lcps`` are the common prefixes with the entry before, ``places`` the rows
    (key, key, place) of all entries, of which ``counts`` says how many each has.
    The strings are hashed and compared by slices of their bytes on the left;
    equal ones have as many, so that a slice needs no other.
    """
    size, reach, m = 2 * length - GRAM, length - GRAM, len(keys)
    both, many, first = np.array(sides, np.int32), counts > 1, np.cumsum(counts) - counts
    near = np.array([0, *lcps[1:], 0], np.int32)
    near = np.maximum(near[:-1], near[1:])
    text = np.frombuffer(b"".join(keys), np.uint8).reshape(m, size)
    edge = np.zeros(m, np.int32)
    for e in edges:
        np.maximum(edge, common_with(text, e), out=edge)
    text = np.concatenate([text[:, length:][:, ::-1], text[:, :length]], axis=1)  # as it stands in the document
    whole = memoryview(text).cast("B")

    def digest(e: int, n: int) -> tuple[int, int]:
        at = e * size + reach - n
        d = xxhash.xxh128_digest(whole[at:at + length], n)
        return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)
    # hashes of all strings, rolled from the leftmost to the rightmost start
    base, top = np.uint64(_BASE), np.uint64(pow(_BASE, length - 1, 1 << 64))
    h = np.zeros(m, np.uint64)
    for i in range(length):
        h = h * base + _TABLE[text[:, i]]
    twice = np.zeros((m, reach + 1), bool)
    step = max(1, CELLS // m)
    for start in range(0, reach + 1, step):
        l = reach - np.arange(start, min(reach + 1, start + step))
        strings = np.empty((m, len(l)), np.uint64)
        for i, left in enumerate(l.tolist()):
            at = reach - left
            strings[:, i] = h * _MIX + np.uint64(left)
            if left:
                h = (h - _TABLE[text[:, at]] * top) * base + _TABLE[text[:, at + length]]
        valid = (length - l[None] <= both[:, :1]) & (l[None] <= both[:, 1:])
        look = valid & ((length - l[None] <= near[:, None]) | many[:, None])
        row, i = np.nonzero(look)
        hit = repeated_cells(text, row * (reach + 1) + l[i], strings[row, i], length) | many[row]
        twice[row[hit], l[i[hit]]] = True
        del strings, look, row, i, hit
        if not edge.any():
            continue
        row, i = np.nonzero(valid & (length - l[None] <= edge[:, None]))
        n, settled = l[i], twice[row, l[i]]
        done: set[tuple[int, int]] = set()
        for lo in range(0, len(row), OUT_ROWS):
            some = []
            for e, left, s in zip(row[lo:lo + OUT_ROWS].tolist(), n[lo:lo + OUT_ROWS].tolist(), settled[lo:lo + OUT_ROWS].tolist()):
                d = digest(e, left)
                if not s:
                    some.append((e, left, *d, True))
                elif d not in done:
                    done.add(d)
                    some.append((e, left, *d, False))
            if some:
                e, left, h1, h2, open_ = zip(*some)
                k1, k2, p = places[first[list(e)]].T
                p = p - np.array(left)
                yield _found(k1, k2, p, p + length, h1, h2, open_)
    edged = np.zeros((m, reach + 3), np.int8)
    edged[:, 1:-1] = twice
    edged = np.diff(edged, axis=1)
    row, least = np.nonzero(edged == 1)  # runs of repeated strings, by their bytes on the left
    most = np.nonzero(edged == -1)[1] - 1
    n = counts[row]
    ends = np.cumsum(n)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, OUT_ROWS):
        which = np.arange(lo, min(lo + OUT_ROWS, int(ends[-1])))
        run = np.searchsorted(ends, which, "right")
        k1, k2, p = places[first[row[run]] + which - (ends - n)[run]].T
        yield _found(k1, k2, p - most[run], p - least[run] + length)


def merge_range(table: pa.Table, splitters: list[bytes], length: int) -> Iterator[pa.RecordBatch]:
    """Merge the runs of a range and find the starts of repeated strings.

    For an entry with ``l`` bytes on the left taken, the string starts ``l``
    before it. Only strings whose right part is common with a neighbour in the
    sorted order are looked at; among these, equal ones (of one ``l``) are
    repeats: found by 64-bit hashes, then compared. A right part has GRAM bytes or
    more, so the merged entries are looked through by blocks that end where
    neighbours have less in common, and a range is never spread out whole.
    Strings whose right part is also that of a splitter may repeat in
    another range: what is not settled here goes on as an open row, with a
    128-bit hash, and a settled string as one open row of which the rest follows.
    """
    size, r = 2 * length - GRAM, table.column("range")[0].as_py()
    rows = {c: [x.as_buffer() for x in table.column(c)] for c in table.column_names if c != "range"}
    edges = [e for e in (splitters[x] for x in (r - 1, r) if 0 <= x < len(splitters)) if len(e) > GRAM]
    side_of = [np.frombuffer(s, np.uint8).reshape(-1, 2).tolist() for s in rows["sides"]]
    ends = [[0, *np.cumsum(np.frombuffer(c, np.int32)).tolist()] for c in rows["count"]]
    spots = [tuple(np.frombuffer(rows[c][i], np.int64) for c in ("k1", "k2", "place")) for i in range(len(ends))]
    keys: list[bytes] = []
    lcps: list[int] = []
    sides: list[list[int]] = []
    where: list[tuple[int, int, int]] = []
    counts: list[int] = []

    def looked_through() -> Iterator[pa.RecordBatch]:
        places = np.stack([np.concatenate([spots[i][c][a:b] for i, a, b in where]) for c in range(3)], axis=1)
        yield from block_repeats(keys, lcps, sides, places, np.array(counts, np.int64), edges, length)
        for x in (keys, lcps, sides, where, counts):
            x.clear()
    at = [0] * len(ends)
    for i, key, lcp in merged([decoded(x, memoryview(y), size) for x, y in zip(rows["lcp"], rows["rest"])]):
        n = at[i]
        at[i] += 1
        side, spot = side_of[i][n], (i, ends[i][n], ends[i][n + 1])
        if keys and lcp == size and side == sides[-1]:
            where.append(spot)
            counts[-1] += spot[2] - spot[1]
            continue
        if lcp < GRAM and len(keys) >= BLOCK:
            yield from looked_through()
        keys.append(key)
        lcps.append(lcp)
        sides.append(side)
        where.append(spot)
        counts.append(spot[2] - spot[1])
    if keys:
        yield from looked_through()


def merged_ranges(runs: DataFrame, splitters: list[bytes], length: int) -> DataFrame:
    """:func:`merge_range` of every range, TASK_RANGES a task; neighbours, which
    a passage that many texts share may fill, go to different tasks."""
    tasks = -(-(len(splitters) + 1) // TASK_RANGES)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        r = table.column("range").to_numpy()
        for x in np.unique(r).tolist():
            yield from merge_range(table.filter(pa.array(r == x)) if (r != x).any() else table, splitters, length)
    return runs.repartitionById(tasks, F.pmod("range", F.lit(tasks))).mapInArrow(merge, FOUND_SCHEMA)


def splitters_of(sample: list[bytes], ranges: int) -> list[bytes]:
    """Up to ``ranges`` - 1 ends of key ranges, at equal steps of a sorted sample.

    Each has only the bytes that tell its key from the end before, GRAM at least:
    suffixes with equal first GRAM bytes stay in one range unless a range ends
    among them twice.
    """
    out: list[bytes] = []
    last = None
    for i in range(1, ranges) if sample else ():
        key = sample[len(sample) * i // ranges]
        if key != last:
            out.append(key[:GRAM if last is None else max(GRAM, common(last, key, 0) + 1)])
            last = key
    return out


def _cut(text: str, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(removed bytes, maximal removed runs, remaining bytes)."""
    raw, kept, at, gone, runs = text.encode(), [], 0, 0, 0
    end = -1
    for lo, hi in sorted(spans):
        if lo > end:
            runs += 1
            kept.append(raw[at:lo])
            gone += hi - lo
        else:
            gone += max(0, hi - end)
        end = max(end, hi)
        at = end
    kept.append(raw[at:])
    return gone, runs, b"".join(kept)


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 200, seed_ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(spans, texts): for each text of ``docs``, by its row key, the merged
    list of byte spans [lo, hi) that consist of strings of ``length`` bytes which
    also start elsewhere in another text or place. Texts that occur in several
    rows are one here; see :func:`drop_repeats`. ``texts`` holds the texts that
    could have spans.
    """
    base = row_key(docs.select(F.col(text).alias("text")).where(F.col("text").isNotNull()), "text")

    def choose(batch, anchors):
        places, grams, samples = [], [], []
        for k, t in zip(column(batch, KEY[0]), column(batch, "text")):
            raw = t.encode()
            p, h = anchors.of(raw)
            r = scattered(p, k)
            some = np.flatnonzero(r < np.uint64(SAMPLED))
            places.append(p)
            grams.append(h.view(np.int64))
            samples.append([{"g": int(h[i].view(np.int64)), "key": suffix(raw, int(p[i]), length)[0], "r": int(r[i])} for i in some])
        return [pa.array(places, pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int64())),
                pa.array(samples, pa.list_(pa.struct([("g", pa.int64()), ("key", pa.binary()), ("r", pa.int64())])))]
    fields = [("places", "array<bigint>"), ("grams", "array<bigint>"), ("samples", "array<struct<g:bigint,key:binary,r:bigint>>")]
    chosen = stored(add_columns(base, choose, fields, lambda: Anchors(length)).drop("text").where(F.size("places") > 0), "anchors")
    one = F.explode(F.arrays_zip(F.col("places").alias("p"), F.col("grams").alias("g")))
    anchors = chosen.select(*KEY, one.alias("a")).select(*KEY, F.col("a.p").alias("p"), F.col("a.g").alias("g"))
    spot = F.xxhash64(*KEY, "p")
    twice = stored(anchors.groupBy("g").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi")).where("lo <> hi").select("g"), "grams")
    wanted = stored(anchors.join(twice, "g").groupBy(*KEY).agg(F.collect_set("p").alias("places")), "suffixes")
    texts = stored(base.join(wanted, list(KEY)).dropDuplicates(list(KEY)), "texts")
    n = texts.agg(F.sum(F.size("places"))).first()[0] or 0
    ranges = seed_ranges or max(1, -(-n // RANGE))
    # one suffix in SAMPLE is there, of equal texts one; about MOST_SAMPLES or RANGE_SAMPLES a range reach the driver
    sample = stored(chosen.select(F.explode("samples").alias("s")).select("s.*").dropDuplicates(["r", "key"]).join(twice, "g").select("key", "r"), "samples")
    most = int(SAMPLED * min(1, max(MOST_SAMPLES, RANGE_SAMPLES * ranges) / max(1, sample.count())))
    splitters = splitters_of(sorted(bytes(x["key"]) for x in sample.where(F.col("r") < most).select("key").collect()), ranges)
    found = stored(merged_ranges(sorted_runs(texts, splitters, length), splitters, length), "repeats")
    edges = found.where("h1 is not null")
    settled = stored(edges.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "settled")
    rest = edges.where("open").join(settled, ["h1", "h2"]).select(*KEY, "lo", "hi")
    spans = found.where("not open and h1 is null").select(*KEY, "lo", "hi").unionByName(rest)
    return spans.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), texts


def drop_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 200, with_text: bool = False,
                 seed_ranges: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row.

    Every byte covered by a ``length``-byte string that also starts anywhere
    else (in this text or another row's) is removed; strings are judged on the
    input. A null or empty text has 0 bytes. ``kept`` holds the remaining bytes.

    Texts that occur in two rows or more go whole, if they are long enough;
    one of them stands for all in the search. In the rest, content chooses
    suffixes such that every string of ``length`` bytes holds one, equal strings
    at equal places; those whose first GRAM bytes occur once are done. The
    others are sorted: each task sorts its suffixes (what stands before them
    last) and collapses equal ones, sends front-coded runs to key ranges, and a
    range merges them by a loser tree that keeps common prefixes. Ranges end at
    sampled keys, so a passage that many documents share is spread over them.
    """
    empty = hashlib.sha256(b"").hexdigest()
    keyed = row_key(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text")
    spans, texts = repeated_spans(docs, text, length, seed_ranges)

    def cut(batch):
        done = [_cut(t, [(s["lo"], s["hi"]) for s in x]) for t, x in zip(column(batch, "text"), column(batch, "spans"))]
        return [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                pa.array([hashlib.sha256(d[2]).hexdigest() for d in done], pa.string()), pa.array([d[2] for d in done], pa.binary())]
    fields = [("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"), ("kept", "binary")]
    out = add_columns(texts.select(*KEY, "text").join(spans, list(KEY)), cut, fields).drop("text", "spans")
    out = stored(out if with_text else out.drop("kept"), "cut")

    own = [F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")] + ([F.coalesce("text", F.lit("")).cast("binary").alias("raw")] if with_text else [])
    rows = keyed.select("id", *KEY, F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), *own)
    copies = stored(rows.where(F.col("n_bytes") >= length).groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1"), "copies")
    copy = F.col("n").isNotNull()
    joined = rows.join(copies, list(KEY), "left").join(out, list(KEY), "left")
    cols = [F.col("id").alias(id), "n_bytes",
            F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
            F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
            F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    if with_text:
        cols.append(F.when(copy, F.lit(b"")).otherwise(F.coalesce("kept", "raw")).alias("kept"))
    return joined.select(*cols)

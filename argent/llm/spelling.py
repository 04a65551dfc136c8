"""Spelling variants: words one edit apart, found on sorted lists."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from argent.llm.common import split
from argent.session import stored

#: Words that count have at least so many code points and occurrences.
LETTERS, LEAST = 6, 5
#: A word's form occurs at least so many times as often.
TIMES = 5
#: A group of words that share a prefix and a suffix is split beyond so many.
GROUP = 400
#: Distinct words a task keeps before it hands on their counts; bytes of a text that are cut into words at once.
HELD, PIECE = 500_000, 4 << 20
#: Latin-1: what is no letter becomes a space, A-Z lower case.
_LETTER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text in Latin-1, some MB at a time, cut between words."""
    start = 0
    while start < len(data):
        end = start + PIECE
        if end < len(data):
            end = data.rfind(b" ", start, end) + 1 or data.find(b" ", end) + 1 or len(data)
            if end <= start:
                end = len(data)
        yield data[start:end].split()
        start = end


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", letters: int = LETTERS, least: int = LEAST, drop_one_in: int | None = None) -> DataFrame:
    """(word, n) of every word of at least ``letters`` code points that occurs
    at least ``least`` times in ``docs``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower
    case. With ``drop_one_in`` d, a run loses the code point h % length where h
    = crc32 of '<id>:<run>' is divisible by d; what is left is the word. A null
    text has no words, a null id is written as nothing; rows with one id are
    counted each. Whole texts of any length are read; a task holds one text and
    up to HELD words. Other columns are not read.
    """
    base = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        crc = zlib.crc32
        for batch in batches:
            for part in split(batch):
                for key, body in zip(*(c.to_pylist() for c in part.columns)):
                    found: Counter[bytes] = Counter()
                    for words in _pieces(body.encode("latin-1", "replace").translate(_LETTER)):
                        found.update(words)
                    prefix = crc(f"{key}:".encode())
                    for w, n in found.items():
                        if len(w) < letters:
                            continue
                        if drop_one_in:
                            h = crc(w if w.isascii() else w.decode("latin-1").encode(), prefix)
                            if h % drop_one_in == 0:
                                at = h % len(w)
                                w = w[:at] + w[at + 1:]
                                if len(w) < letters:
                                    continue
                        held[w] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()
    return base.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class SortedList:
    """Finds the words of a sorted list that are exactly one edit from a word.

    The list is walked in order with the edit matrix between its word and the
    query, of which three cells of each row are kept: a word starts from the
    rows of the prefix it shares with the one before, and when all cells of a
    row exceed one edit, every word with that prefix is skipped.
    """

    def __init__(self, words: list[str]):
        self.words = words

    def near(self, q: str) -> list[int]:
        """Places of the words one edit from ``q``."""
        words, out, size = self.words, [], len(q)
        # row d: edits between the first d letters of the word and the first d - 1, d, d + 1 of q; 2 is two or more
        rows = [(2, 0, 1 if size else 2)]
        i, depth, count = 0, 0, len(words)
        while i < count:
            w = words[i]
            length = len(w)
            r0, r1, r2 = rows[depth]
            alive = True
            while depth < length:
                c = w[depth]
                a = r0 + (q[depth - 1] != c) if 0 < depth <= size else 2
                if r1 + 1 < a:
                    a = r1 + 1
                b = r1 + (q[depth] != c) if depth < size else 2
                if r2 + 1 < b:
                    b = r2 + 1
                if a + 1 < b:
                    b = a + 1
                z = r2 + (q[depth + 1] != c) if depth + 1 < size else 2
                if depth + 2 <= size and b + 1 < z:
                    z = b + 1
                if depth > size:
                    a = 2
                if depth + 1 > size:
                    b = 2
                r0, r1, r2 = a, b, z
                depth += 1
                if r0 > 1 and r1 > 1 and r2 > 1:
                    alive = False
                    break
                if depth < len(rows):
                    rows[depth] = (r0, r1, r2)
                else:
                    rows.append((r0, r1, r2))
            if alive:
                d = size - length
                if -1 <= d <= 1 and (r0, r1, r2)[d + 1] == 1:
                    out.append(i)
                nxt = i + 1
            else:
                # past every word with the prefix w[:depth]
                nxt = i + 1
                if nxt < count and words[nxt].startswith(w[:depth]):
                    nxt = bisect_left(words, w[:depth - 1] + chr(min(ord(w[depth - 1]) + 1, 0x10FFFF)), nxt)
                depth -= 1
            if nxt < count:
                v, shared = words[nxt], 0
                top = min(depth, len(v))
                while shared < top and v[shared] == w[shared]:
                    shared += 1
                depth = shared
            i = nxt
        return out


def _group(words: list[str], ns: list[int], m: int, a: int, b: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, n of the best one, the best one) within a group of
    words that share the first ``a`` and the last ``b`` letters.

    A group holds words of ``m`` and ``m + 1`` letters; it settles the pairs
    whose shorter word has ``m`` and that share less than m - b letters at the
    start (any number if b = 0), so that each pair is settled in one group.
    """
    middles = sorted((w[a:len(w) - b], k) for k, w in enumerate(words))
    look = SortedList([x for x, _ in middles])
    count, best = [0] * len(words), [(0, "")] * len(words)

    def add(i: int, j: int) -> None:
        count[i] += 1
        n, w = best[i]
        if ns[j] > n or ns[j] == n and words[j] < w:
            best[i] = ns[j], words[j]
    for q, i in middles:
        if len(words[i]) != m:
            continue
        for place in look.near(q):
            other, j = middles[place]
            if b:
                shared, top = 0, min(len(q), len(other))
                while shared < top and q[shared] == other[shared]:
                    shared += 1
                if a + shared >= m - b:
                    continue
            add(i, j)
            if len(words[j]) > m:
                add(j, i)
    for k, w in enumerate(words):
        if count[k]:
            yield w, count[k], *best[k]


def _halves(shelf: DataFrame) -> DataFrame:
    """Each group (m, a, b) as two: pairs that share at least t letters at the
    start, and the others, which share at least m - t at the end."""
    t = F.col("a") + F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    two = shelf.withColumn("t", t).withColumn("x", F.explode(F.array(F.struct(F.col("t").alias("a"), "b"), F.struct("a", (F.col("m") - F.col("t")).alias("b")))))
    two = two.select("word", "n", "m", "x.a", "x.b")

    def key(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "m", "a", "b", F.substr("word", F.lit(1), F.col("a")), F.substr("word", F.length("word") - F.col("b") + 1, F.col("b")))
    return two.withColumn("g", key(1))


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``words`` (word, n; distinct)
    that have a near word, one edit away; best is the one of largest n, then
    the smallest.

    Two words one edit apart, the shorter of m letters, share p letters at the
    start and s at the end with p + s >= m - 1, so for any t they share t at the
    start or m - t at the end. Each word goes to such groups for m = its length
    and its length - 1, and groups of more than ``group`` words are halved again
    until their words differ in one place only; so a group is small whatever
    the vocabulary, the rows grow with it in proportion, and no pair is lost.
    Within a group the middles of the words are a :class:`SortedList`.
    """
    one = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    open_, done = stored(_halves(one.where("m >= 1")), "spelling-groups"), None
    while True:
        large = open_.groupBy("g").agg(F.count("*").alias("c"), F.max(F.col("m") - F.col("a") - F.col("b")).alias("gap")).where(f"c > {group} and gap >= 2").select("g")
        large = stored(large, "spelling-large")
        if large.isEmpty():
            break
        rest = open_.join(large, "g", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        open_ = stored(_halves(open_.join(large, "g", "left_semi")), "spelling-groups")
    shelf = open_ if done is None else done.unionByName(open_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, out = None, [], []

        def settle() -> None:
            kinds: dict[tuple, list] = {}
            for _, w, n, m, a, b in held:  # hashes may meet
                kinds.setdefault((m, a, b, w[:a], w[len(w) - b:]), []).append((w, n))
            for (m, a, b, _, _), found in kinds.items():
                if len(found) > 1:
                    out.extend(_group([w for w, _ in found], [n for _, n in found], m, a, b))

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                                              names=["word", "k", "best_n", "best"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last:
                    if len(held) > 1:
                        settle()
                    last, held = row[0], []
                held.append(row)
            if len(out) > 10_000:
                yield batch_of()
                out = []
        if len(held) > 1:
            settle()
        if out:
            yield batch_of()
    found = (shelf.select("g", "word", F.col("n").cast("bigint").alias("n"), "m", "a", "b").repartition("g").sortWithinPartitions("g")
             .mapInArrow(run, "word string, k bigint, best_n bigint, best string"))
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("o"), F.col("best").alias("w"))).alias("x")).select(
        "word", "n_near", (-F.col("x.o")).alias("best_n"), F.col("x.w").alias("best"))


def near_words(words: DataFrame, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    Words are near if one inserted, deleted or replaced code point turns one
    into the other. A word's form is its near word of largest n (ties: the
    smallest in code point order) if that is at least ``times`` its own n; root
    is the last word reached over forms, the word itself without one. Null and
    empty words are left out, repeated ones are one with their n added; other
    columns are not read. An empty table gives none.

    n grows at each step to a form, so forms make no rings and chains are
    short; the roots are found by pointer jumping, each round a join.
    """
    words = stored(words.where("word <> ''").groupBy("word").agg(F.sum("n").cast("bigint").alias("n")), "words")
    out = words.join(near_pairs(words, group), "word", "left")
    has = F.col("best_n") >= times * F.col("n")
    out = stored(out.select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                            F.when(has, F.col("best_n")).alias("form_n")), "word-forms")
    root = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = stored(root.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        root = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            break
    return out.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

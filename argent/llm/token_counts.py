"""Token counts by prefix dynamic programming over a sentence-piece BPE model."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from argent.llm.common import add_columns, column

SPACE = "▁"
#: Units (one space mark and what follows) whose counts a worker remembers.
CACHE = 800_000


class PieceCounts:
    """Exact token counts of every prefix.

    The text is spelled with a space mark for each space and one in front. No
    piece has a space mark after another character, so no merge crosses into a
    unit (a space mark and the characters up to the next one), and runs of
    space marks are pieces of their own. Within a unit, count[i] is 1 plus the
    count before the last token of the prefix of length i. That token is the
    one whose neighbour on its left, the last token of what precedes it, stays
    apart from it when the two are merged alone; BPE leaves exactly one.
    """

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.longest = max(map(len, self.score))
        self.has_bytes = any(sp.is_byte(i) for i in range(n))
        for p in self.score:
            if SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE)):
                raise ValueError("a piece crosses the units that this method counts apart")
        self.tokens = {t: 1 for t in self.score if self.merged(t) == [t]}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.totals: dict[str, int] = {}
        self.runs: dict[int, int] = {}

    def merged(self, text: str) -> list[str]:
        """Tokens of a short string by BPE: the best score first, then the leftmost."""
        parts = list(text)
        while True:
            best = max(((self.score.get(a + b, float("-inf")), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=None)
            if best is None or best[0] == float("-inf"):
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def apart(self, a: str, b: str) -> bool:
        """Whether tokens a and b next to each other stay as they are."""
        if (found := self.pairs.get((a, b))) is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return found

    def tables(self, units: list[str]) -> Iterator[tuple[str, list[int], list[str]]]:
        """(unit, count, first) for sorted units: token count and first token of
        every prefix, by its length from 0 on. The rows of the beginning that
        a unit shares with the one before are kept, not made again."""
        tokens, pairs, longest = self.tokens, self.pairs, self.longest
        count, last, first, before = [0], [""], [""], ""
        for u in units:
            n = next((i for i, (x, y) in enumerate(zip(u, before)) if x != y), min(len(u), len(before)))
            del count[n + 1:], last[n + 1:], first[n + 1:]
            before = u
            for i in range(n + 1, len(u) + 1):
                for j in range(i - longest if i > longest else 0, i):
                    t = u[j:i]
                    if (t in tokens or j == i - 1) and (not j or (x if (x := pairs.get((last[j], t))) is not None else self.apart(last[j], t))):
                        count.append(count[j] + (1 if t in tokens or not self.has_bytes else len(t.encode())))
                        last.append(t)
                        first.append(first[j] or t)
                        break
            yield u, count, first

    def run(self, k: int) -> int:
        """Tokens of k space marks in a row. Their pieces share one score, so the
        leftmost pair goes first: a stack of the merged ones is enough."""
        if (found := self.runs.get(k)) is None:
            parts: list[int] = []
            for _ in range(k):
                parts.append(1)
                while len(parts) > 1 and SPACE * (parts[-2] + parts[-1]) in self.score:
                    parts[-2:] = [parts[-2] + parts[-1]]
            found = self.runs[k] = len(parts)
        return found

    def cut(self, text: str) -> list[tuple[int, str]]:
        """(space marks before, word) of each unit; a word keeps no space mark."""
        out, marks = [], 0
        for w in text.replace(SPACE, " ").split(" "):
            marks += 1
            if w:
                out.append((marks, w))
                marks = 0
        return [*out, (marks, "")] if marks else out

    def learn(self, texts: list[str | None]) -> None:
        """Remember the token counts of the units of these texts."""
        new = {SPACE + w for t in texts if t for w in t.split(" ")} - self.totals.keys()
        if len(self.totals) + len(new) > CACHE:
            self.totals.clear()
            new = {SPACE + w for t in texts if t for w in t.split(" ")}
        for u, count, _ in self.tables(sorted(new)):
            self.totals[u] = count[-1]

    def count(self, text: str | None) -> int:
        """Tokens of the whole text (after :meth:`learn` had it)."""
        if not text:
            return 0
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return self.prefixes(text)[-1]
        totals = self.totals
        return sum([totals[SPACE + w] for w in text.split(" ")])

    def prefixes(self, text: str | None) -> array:
        """Tokens of the first i characters, for i = 1 to len(text)."""
        out = array("i")
        cut = self.cut(text) if text else []
        own = {u: (count[1:], first[1:]) for u, count, first in self.tables(sorted({SPACE + w for _, w in cut if w}))}
        total = 0
        for k, (marks, word) in enumerate(cut):
            # the mark in front of the text is not one of its characters
            out.extend([total + self.run(m) for m in range(1 + (k == 0), marks + 1)])
            if word:
                # the last mark belongs to the run before it unless the word takes it
                free, taken = self.run(marks) - 1, self.run(marks - 1) if marks > 1 else 0
                count, first = own[SPACE + word]
                out.extend([total + c + (free if f == SPACE else taken) for c, f in zip(count[1:], first[1:])])
                total = out[-1]
        return out


@lru_cache(2)
def _load(path: str) -> PieceCounts:
    return PieceCounts(path)


def token_counts(docs: DataFrame, model: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit of the whole text.

    Map-only. Null and empty texts have 0 bytes and tokens. Input columns with
    these names are replaced. ``model`` is a file that every executor has.
    """
    def run(b, counts):
        texts = column(b, text)
        counts.learn(texts)
        n = [counts.count(t) for t in texts]
        return [pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array(n, pa.int64()),
                pa.array([x > limit for x in n], pa.bool_())]
    return add_columns(docs, run, [("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")], lambda: _load(model))


def prefix_counts(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with prefix_tokens: the exact token count of every prefix of the
    text, by its length in characters from 1 on; empty for null and empty texts."""
    return add_columns(docs, lambda b, c: [pa.array([c.prefixes(t) for t in column(b, text)], pa.list_(pa.int32()))],
                       [("prefix_tokens", "array<int>")], lambda: _load(model))


def truncate_to_budget(docs: DataFrame, model: str, budget: int, text: str = "text") -> DataFrame:
    """``docs`` with the longest prefix of the text of at most ``budget`` tokens
    as truncated, from the stored prefix counts; null stays null."""
    def run(b, counts):
        out = []
        for t in column(b, text):
            if t:
                p = counts.prefixes(t)
                t = t[:next((i for i in range(len(p), 0, -1) if p[i - 1] <= budget), 0)]
            out.append(t)
        return [pa.array(out, pa.string())]
    return add_columns(docs, run, [("truncated", "string")], lambda: _load(model))

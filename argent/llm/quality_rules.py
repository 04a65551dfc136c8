"""Quality rules, line first: lines that break a rule go, then documents that
lost too much text are rejected."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from argent.llm.common import Hashes, add_columns, column

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Separators of menus and breadcrumbs, as words of their own.
SEPARATORS = frozenset((b"|", "»".encode(), "›".encode(), "•".encode(), "·".encode(), b"/", b">"))
#: Phrases of notices, licences and site furniture (lower case).
BOILERPLATE = re.compile(
    r"all rights reserved|licen[sc]ed under|creative commons|terms of (?:use|service)|privacy policy|cookie(?:s| policy)"
    r"|click here|read more|sign up|log ?in\b|subscribe|javascript|lorem ipsum|share (?:this|on)|©|copyright\b")
FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
          ("n_repeat_words", "bigint"), ("n_lines", "bigint"), ("n_removed_lines", "bigint"), ("n_lost_words", "bigint"),
          ("clean_text", "string")]
WINDOW = 8


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """The line rules: navigation, symbol punctuation, shouting, run-on, boilerplate."""
    n = len(words)
    separators = sum(w in SEPARATORS for w in words)
    if separators >= 3 and 5 * separators >= n:
        return True
    if 4 * (len(line) - len(line.translate(None, SYMBOLS)) - separators) >= n >= 3:
        return True
    if n >= 3 and 4 * line.count(b"!!") >= n:
        return True
    text = line.decode()
    if n >= 5 and text.isupper():
        return True
    if n >= 12 and 3 * len(set(words)) <= n and not re.search(r"[.!?…]", text):
        return True
    return n <= 40 and BOILERPLATE.search(text.lower()) is not None


def repeat_words(words: list[bytes], hashes: Hashes, window: int = WINDOW) -> int:
    """Words inside windows found twice or more in the same text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    x, h = hashes.of(words), np.zeros(n, np.uint64)
    for i in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[i:i + n]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    hit = np.flatnonzero(np.isin(h, twice))
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _measure(text: str | None, hashes: Hashes) -> tuple:
    if not text:
        return 0, 0, 0, 0, 0, 0, 0, 0, text
    raw = text.encode()
    words = raw.split()
    seen: set[bytes] = set()
    kept, lines, dup, gone, lost = [], 0, 0, 0, 0
    for line in raw.split(b"\n"):
        own = line.split()
        if own:
            lines += 1
            dup += line in seen
            seen.add(line)
            if line_fails(line, own):
                gone += 1
                lost += len(own)
                continue
        kept.append(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), len(raw) - len(raw.translate(None, SYMBOLS)), dup,
            repeat_words(words, hashes), lines, gone, lost, text if not gone else b"\n".join(kept).decode())


def quality_rules(docs: DataFrame, text: str = "text", min_words: int = 20, max_repeat_pct: int = 30,
                  max_lost_pct: int = 30) -> DataFrame:
    """``docs`` with measures, ``clean_text`` (without the failing lines),
    ``base_failed`` and ``kept``. Map-only: no row moves.

    A null or empty text has zero measures, fails the base rule and keeps its
    value as ``clean_text``. Repeated rows are judged each alike; an input
    column with the name of a result column is replaced.
    """
    out = add_columns(docs, lambda b, h: [pa.array(c, pa.string() if k == "string" else pa.int64()) for c, (_, k) in
                                          zip(zip(*(_measure(t, h) for t in column(b, text))), FIELDS)], FIELDS, Hashes)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (100 * F.col("n_lost_words") <= max_lost_pct * F.col("n_words"))))

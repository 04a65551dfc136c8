"""Removal of repeated three-line windows (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from argent.llm.common import KEY, row_key
from argent.session import stored

WINDOW = 3


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, " \t\n\x0b\x0c\r", "")) > 0


def _windows(keyed: DataFrame, text: str, order: str, size: int) -> DataFrame:
    """One row (row key, place, h1, h2: 128 hashed bits, idx: line numbers) for
    every run of ``size`` consecutive lines with a word."""
    lines = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: _has_word(s["x"]))
    hashed = F.transform(lines, lambda s: F.struct(s["i"].alias("i"), F.xxhash64(s["x"]).alias("a"), F.xxhash64(F.lit(1), s["x"]).alias("b")))
    # a column of its own, used more than once: Spark computes it once per row
    shifted = [F.slice("_h", k + 1, F.greatest(F.size("_h"), F.lit(1))) for k in range(size)]
    rows = (keyed.select(order, *KEY, hashed.alias("_h")).where(F.size("_h") >= size)
            .select(order, *KEY, F.explode(F.arrays_zip(*[x.alias(f"w{k}") for k, x in enumerate(shifted)])).alias("w")))
    parts = [F.col(f"w.w{k}") for k in range(size)]
    place = F.struct(F.col(order).isNull().alias("o"), F.col(order).alias("d"), *KEY, parts[0]["i"].alias("i"))
    return rows.where(parts[-1].isNotNull()).select(
        *KEY, place.alias("place"), F.xxhash64(*[p["a"] for p in parts]).alias("h1"),
        F.xxhash64(*[p["b"] for p in reversed(parts)]).alias("h2"), F.array(*[p["i"] for p in parts]).alias("idx"))


def line_dedup(docs: DataFrame, text: str = "text", order: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``docs`` with the text without repeated windows, n_lines (lines with a
    word) and n_removed_lines.

    Windows are ``window`` consecutive lines with a word, compared as they are
    written; blank lines are skipped and stay. The first occurrence of a window
    by (``order``, nulls last, then row key and place) stays, and the lines
    covered by any later occurrence go, each once. Texts of fewer lines and
    null texts stay as they are; texts are taken whole, of any length. Rows
    equal in ``order`` and text count as one. An empty table gives an empty
    one. Input columns named like the two counts are replaced, all others come
    back as they were, whatever their names.

    Only hashes, keys and line numbers are shuffled to find the windows; they
    and the repeated ones are stored, so that the texts are read once for them
    and a hot window can be split in the join. The texts meet their removed
    lines by a merge join at any size.
    """
    cols = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed_lines")]
    # the input's columns stand in a struct, so that they clash with none of ours
    others = F.struct(*[F.col(f"`{c}`") for c in cols if c != text]).alias("row")
    keyed = row_key(docs.select(others, F.col(f"`{text}`").alias("text"), F.col(f"`{order}`").alias("order")), "order", "text")
    found = stored(_windows(keyed, "text", "order", window), "windows")
    repeated = stored(found.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                      .where("first <> last").select("h1", "h2", "first"), "repeated")
    gone = (found.join(repeated, ["h1", "h2"]).where("place <> first").select(*KEY, F.explode("idx").alias("i"))
            .groupBy(*KEY).agg(F.collect_set("i").alias("gone")))
    # the lines are a column of their own, so that they are split once per row
    out = keyed.drop("order").hint("merge").join(stored(gone, "gone"), list(KEY), "left").withColumn("lines", F.split("text", "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i))
    new = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return out.select(*[new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in cols],
                      F.greatest(F.size(F.filter("lines", _has_word)), F.lit(0)).cast("bigint").alias("n_lines"),
                      F.greatest(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed_lines"))

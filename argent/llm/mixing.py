"""Mixing sources to target weights (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from argent.llm.common import WORD, fresh, without

#: Weights by source in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix over all words, and the most a source may be repeated.
SHARE, MOST = 1.5, 2


def n_words(text) -> F.Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> target words and repetition rate per source.

    Water filling: target = min(most * size, level * weight). With the sources
    in order of the level at which they stop, the level is
    (share * all sizes - what the stopped ones take) / the weights of the rest;
    it is right at the first source that it does not stop, and falls after it.
    One row per source.
    """
    all_ = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumns({"weight": weight, "cap": (most * F.col("source_size")).cast("double"),
                           "_all": share * F.sum("source_size").over(all_)})
    s = s.withColumn("_left", F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("_level", (F.col("_all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.col("_left"))
    level = F.max(F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.col("_level"))).over(all_)
    s = s.withColumn("_l", level)
    target = F.when(F.col("_l").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("_l") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"),
                    F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def mixing_plan(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                most: int = MOST) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken.

    Each document is taken floor(rate) times and once more when its draw is
    below the fraction: the first 52 bits of the md5 of seed, doc_id, text and
    the row's number among the rows equal in these and source. So rows that share an id or
    have none draw each for itself, equal rows too, and reruns agree. Null
    sources form one source, the last. Null and empty texts have size 0, texts
    are counted whole, an empty table gives an empty one. Sizes per source are
    summed map-side, and the per-source rows, as few as there are sources, are
    joined by Spark's own choice (a hot source is split by AQE). Input columns
    with the names of result columns are replaced, all others stay.
    """
    docs = without(docs, "size", "source_size", "target", "rate", "copies", "taken")
    place = F.row_number().over(Window.partitionBy("doc_id", "source", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).orderBy(F.lit(0)))
    said = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))), place.cast("string"))
    draw, other = fresh(docs, "draw", "of_source")
    docs = docs.withColumns({"size": n_words(F.col("text")), draw: F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))})
    per = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most).withColumnRenamed("source", other)
    out = docs.join(per, docs["source"].eqNullSafe(per[other]), "left").drop(other)
    out = out.withColumn("copies", (F.floor("rate") + (F.col(draw) < F.col("rate") - F.floor("rate")).cast("int")).cast("bigint")).drop(draw)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document of ``docs`` as often as its plan says."""
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    plan = mixing_plan(docs.select("doc_id", "text", "source", rows), **options).where("copies > 0")
    out = plan.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

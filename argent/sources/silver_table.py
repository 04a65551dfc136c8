"""Keyed Parquet tables: fresh folders per commit and one pointer file.

Layout of a table::

    <path>/_current                              the pointer, a small JSON file
    <path>/data/_commit=<id>/<part>=<value>/...  what one commit wrote

A commit writes its rows with Spark's own committer to a folder of its own and
then replaces the pointer, which names the live partition folders of every
commit, the schema (with column descriptions and tags), the layout and the
newest sync time. Readers follow the pointer. So a reader sees the table before
a commit or after it, whole, wherever the writer stops; what a stopped writer
left is named by no pointer and goes with the next commit's clean-up, which
keeps the folders of the version before for readers on their way. One writer
per table at a time: a commit that finds another pointer than the one it
started from raises.

Partition folders are

* ``_bucket`` = ``pmod(xxhash64(key), N)``, or ``floor(key / width)`` for a
  numeric key that grows with time (:func:`bucket_expr`); a merge rewrites only
  the buckets that its batch touches;
* ``_day``, the day of the sync time (the first of its month or year where a
  day holds little), for tables whose merge matches only recent rows: the match
  window selects folders, so a merge reads and rewrites only the days in it;
* ``_part`` for history tables (:mod:`argent.operators.scd2`).

Columns may be added and widened (:func:`reconciled`); files keep the type
they were written with and Spark's reader promotes them to the type in the
pointer, so neither rewrites old files. (``MERGE INTO`` needs a table format we
do not have.)
"""

from __future__ import annotations

import datetime
import json
import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Dict, Iterable, List, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions.exprs import MIN_DATE, col_of
from argent.operators.merge import merge_frames
from argent.operators.staging import AUDIT_LOAD, AUDIT_SYNC, SYNCED
from argent.session import child_names, read_text, remove_path, replace_text, work_dir

POINTER = "_current"
COMMIT = "_commit"
BUCKET = "_bucket"
DAY = "_day"
PART = "_part"                 # history tables: c<bucket> = current versions, closed = closed by a run
DEFAULT_BUCKETS = 64           # when nothing is known of the size
BUCKETS_META = "argent.num_buckets"       # on the key column of a table that is read
RANGE_META = "argent.range_width"
NULL_KEY_SPREAD = 1024                    # range buckets -1..-1024 hold rows with a NULL key
TARGET_BUCKET_BYTES = 512 * 1024 * 1024
DAY_BYTES = 64 * 1024 * 1024
TASK_ROWS = 250_000                       # rows that a task of a merge sorts, and the bytes of files they come from
TASK_BYTES = 64 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60                   # Spark's estimate for a plan it knows nothing of is beyond


# ---------------------------------------------------------------------------
# Bucket counts
# ---------------------------------------------------------------------------
def buckets_for(total_bytes: int, target_bytes: int = TARGET_BUCKET_BYTES, minimum: int = 8) -> int:
    """Bucket count for a table of ``total_bytes`` (about one file per
    bucket per write): a power of two near ``total / target``. A 100 TB
    table at 512 MB per bucket gets 2^18 buckets."""
    n = max(minimum, -(-int(total_bytes) // int(target_bytes)))
    return 1 << (n - 1).bit_length()


def input_bytes(df: DataFrame) -> Optional[int]:
    """Bytes of the sources under ``df`` by the optimizer's statistics (no job);
    None when a source does not know."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(s >= UNKNOWN_BYTES for s in sizes) else sum(sizes)


def first_buckets(df: DataFrame) -> int:
    """Bucket count of a first build, from the size of what it reads."""
    size = input_bytes(df)
    return DEFAULT_BUCKETS if size is None else buckets_for(size)


def merge_shares(target: DataFrame, staged: DataFrame, n_rows: int, n_buckets: int) -> Dict:
    """Into how many pieces a merge deals each of ``n_buckets``, so that a piece
    holds about TASK_ROWS rows however large the table is, and the partitions
    for it where they are more than the session's: four for a piece, so that
    few pieces meet in one. The rows of the target are counted from the
    footers of its files."""
    sizes = [input_bytes(target), input_bytes(staged)]
    tasks = max(-(-(target.count() + n_rows) // TASK_ROWS), -(-sum(s or 0 for s in sizes) // TASK_BYTES))
    usual = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return {"pieces": max(1, -(-tasks // n_buckets)), "num_partitions": 4 * tasks if 4 * tasks > usual else None}


def range_width_for(df: DataFrame, key: str) -> Optional[int]:
    """Keys per range bucket of a first build: the span of the keys over the
    bucket count for its size (one pass over the key column; None without keys)."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    return None if lo is None else max(1, -(-(int(hi) - int(lo) + 1) // first_buckets(df)))


def day_unit_for(df: DataFrame, sync: str) -> str:
    """``day``, ``month`` or ``year``: the shortest that holds DAY_BYTES of what
    ``df`` reads (one pass over the sync column)."""
    size = input_bytes(df)
    lo, hi = df.agg(F.min(sync), F.max(sync)).first()
    if size is None or lo is None:
        return "day"
    per_day = size / max(1, (hi - lo).days + 1)
    return next((unit for unit, days in (("day", 1), ("month", 30)) if per_day * days >= DAY_BYTES), "year")


# ---------------------------------------------------------------------------
# The pointer
# ---------------------------------------------------------------------------
def _packed(parts: Iterable[str]) -> list:
    """Partition values, runs of whole numbers as [first, last]."""
    parts = list(parts)
    numbers = sorted(int(p) for p in parts if re.fullmatch(r"-?\d+", p))
    out: list = sorted(p for p in parts if not re.fullmatch(r"-?\d+", p))
    for n in numbers:
        if out and isinstance(out[-1], list) and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def _unpacked(parts: list) -> set:
    return {v for p in parts for v in ([p] if isinstance(p, str) else map(str, range(p[0], p[1] + 1)))}


@dataclass
class Table:
    """What the pointer of a table says."""

    path: str
    version: int = 0
    part: str = BUCKET
    schema: T.StructType = field(default_factory=T.StructType)
    layout: Dict = field(default_factory=dict)            # keys, and buckets or range_width or day
    live: Dict[str, set] = field(default_factory=dict)    # commit -> its live partition values
    whole: set = field(default_factory=set)               # commits all of whose folders are live
    dropped: Dict[str, set] = field(default_factory=dict)  # folders that the version before still named
    high_water: Optional[str] = None
    applied: Dict[str, int] = field(default_factory=dict)  # stream -> its last micro-batch
    untimed: bool = False                                  # a row without sync time was written
    comment: Optional[str] = None                          # description of the table

    @property
    def keys(self) -> List[str]:
        return self.layout["keys"]

    def text(self) -> str:
        return json.dumps({
            "version": self.version, "part": self.part, "schema": json.loads(self.schema.json()), "layout": self.layout,
            "live": {c: _packed(v) for c, v in self.live.items()}, "whole": sorted(self.whole),
            "dropped": {c: _packed(v) for c, v in self.dropped.items()}, "high_water": self.high_water, "applied": self.applied,
            "untimed": self.untimed, "comment": self.comment})

    def folders(self, only: Optional[Callable[[str], bool]] = None) -> List[str]:
        """The live folders (of the partitions that ``only`` takes)."""
        root = f"{self.path}/data"
        out = []
        for commit, parts in self.live.items():
            some = parts if only is None else {p for p in parts if only(p)}
            if some and some == parts and commit in self.whole:
                out.append(f"{root}/{COMMIT}={commit}")
            else:
                out += [f"{root}/{COMMIT}={commit}/{self.part}={p}" for p in sorted(some)]
        return out


def open_table(spark: SparkSession, path: str) -> Optional[Table]:
    """The table at ``path`` as its pointer names it, or None."""
    root = path.rstrip("/")
    text = read_text(spark, f"{root}/{POINTER}")
    if text is None:
        return None
    p = json.loads(text)
    return Table(root, p["version"], p["part"], T.StructType.fromJson(p["schema"]), p["layout"], {c: _unpacked(v) for c, v in p["live"].items()},
                 set(p["whole"]), {c: _unpacked(v) for c, v in p["dropped"].items()}, p["high_water"], p["applied"], p["untimed"], p["comment"])


def read_folders(spark: SparkSession, table: Table, only: Optional[Callable[[str], bool]] = None) -> DataFrame:
    """The rows of the live folders of ``table`` with the partition column.

    ``only`` selects partition values before anything is listed; the schema is
    the pointer's, so no file is opened for it.
    """
    meta = {}
    if "buckets" in table.layout:
        meta = {BUCKETS_META: table.layout["buckets"]}
    elif "range_width" in table.layout:
        meta = {RANGE_META: table.layout["range_width"]}
    fields = [T.StructField(f.name, f.dataType, True, {**(f.metadata or {}), **(meta if f.name == table.keys[0] else {})}) for f in table.schema.fields]
    kind = T.LongType() if table.part == BUCKET else T.DateType() if table.part == DAY else T.StringType()
    schema = T.StructType([*fields, T.StructField(table.part, kind)])
    folders = table.folders(only)
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    return spark.read.schema(full).option("basePath", f"{table.path}/data").parquet(*folders).drop(COMMIT)


def read_table(spark: SparkSession, path: str, keep_bucket: bool = False) -> Optional[DataFrame]:
    """Read a table as of its last commit, or ``None`` when it does not exist yet."""
    table = open_table(spark, path)
    if table is None:
        return None
    df = read_folders(spark, table)
    return df if keep_bucket else df.drop(table.part)


def stored_buckets(df: DataFrame, keys: Sequence[str]) -> Optional[int]:
    """The bucket count of a hash-bucketed table that was read (``None`` if not one)."""
    v = (df.schema[keys[0]].metadata or {}).get(BUCKETS_META)
    return int(v) if v is not None else None


def stored_range_width(df: DataFrame, keys: Sequence[str]) -> Optional[int]:
    """The key-range width of a range-bucketed table (``None`` if not one)."""
    v = (df.schema[keys[0]].metadata or {}).get(RANGE_META)
    return int(v) if v is not None else None


def commit(df: DataFrame, path: str, before: Optional[Table], schema: T.StructType, layout: Dict, part: str = BUCKET,
           replaces: Optional[Callable[[str], bool]] = None, high_water: Optional[Callable[[object], Optional[str]]] = None,
           applied: Optional[tuple] = None, comment: Optional[str] = None) -> Table:
    """Write ``df`` (with the column ``part``) to a fresh folder and publish it.

    The live folders whose partition value ``replaces`` takes go (all of them
    when it is None); others stay beside what ``df`` wrote. ``df`` may read the
    table. ``high_water`` gets the newest sync time written (seen while
    writing) and gives that of the table. ``applied`` is a stream and its
    micro-batch, ``comment`` the table's description.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    name = f"{(before.version if before else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/data/{COMMIT}={name}"
    sync = _sync_column(df.columns)
    seen = Observation(f"commit-{name}")
    out = df.observe(seen, F.max(sync).alias("m"), F.count_if(F.col(sync).isNull()).alias("untimed")) if sync else df
    out.write.partitionBy(part).parquet(folder)
    written = {n.split("=", 1)[1] for n in child_names(spark, folder) if n.startswith(f"{part}=")}
    latest = seen.get["m"] if sync else None
    new = Table(root, (before.version if before else 0) + 1, part, _plain(schema), layout)
    if before:
        new.applied = dict(before.applied)
        if replaces is not None:
            new.live = {c: kept for c, parts in before.live.items() if (kept := {p for p in parts if not replaces(p)})}
            new.whole = {c for c in before.whole if len(new.live.get(c, ())) == len(before.live[c])}
        new.dropped = {c: gone for c, parts in before.live.items() if (gone := parts - new.live.get(c, set()))}
    if written:
        new.live[name] = written
        new.whole.add(name)
    new.high_water = high_water(latest) if high_water else _iso(latest)
    new.untimed = bool(sync and seen.get["untimed"]) or bool(before and replaces is not None and before.untimed)
    new.comment = comment or (before.comment if before else None)
    if applied:
        new.applied[applied[0]] = int(applied[1])
    publish(spark, new, before)
    clean_up(spark, new, before)
    return new


def publish(spark: SparkSession, new: Table, before: Optional[Table]) -> None:
    """Replace the pointer, if it is still the one the commit started from."""
    now = open_table(spark, new.path)
    if (now.version if now else 0) != (before.version if before else 0):
        raise RuntimeError(f"{new.path} was written by another commit meanwhile")
    replace_text(spark, f"{new.path}/{POINTER}", new.text())


def clean_up(spark: SparkSession, table: Table, before: Optional[Table], threads: int = 16) -> None:
    """Delete the folders that neither this version nor the one before names.

    Whole commits by one call; single partitions, where part of a commit is
    still live, from a few threads. Nothing waits for it and nothing is lost
    if it stops.
    """
    root = f"{table.path}/data/{COMMIT}="
    named = {*table.live, *table.dropped}
    gone = [f"{table.path}/data/{n}" for n in child_names(spark, f"{table.path}/data") if n.startswith(f"{COMMIT}=") and n.split("=", 1)[1] not in named]
    for c, parts in (before.dropped if before else {}).items():
        if c in named:
            gone += [f"{root}{c}/{before.part}={p}" for p in parts]
    if gone:
        with ThreadPoolExecutor(min(threads, len(gone))) as pool:
            list(pool.map(lambda f: remove_path(spark, f), gone))


def _sync_column(columns: Sequence[str]) -> Optional[str]:
    return next((c for c in (AUDIT_SYNC, SYNCED) if c in columns), None)


def _iso(value) -> Optional[str]:
    return None if value is None else value.isoformat(sep=" ")


def _plain(schema: T.StructType) -> T.StructType:
    """A schema as it is kept: nullable, without the layout marks."""
    return T.StructType([T.StructField(f.name, f.dataType, True, {k: v for k, v in (f.metadata or {}).items() if k not in (BUCKETS_META, RANGE_META)})
                         for f in schema.fields])


def table_high_water(spark: SparkSession, path: str, min_date: str = MIN_DATE):
    """A1 for a stored table: ``coalesce(max(sync), min_date)`` from the
    pointer, without a job. ``None`` when the table does not exist."""
    table = open_table(spark, path)
    if table is None:
        return None
    return datetime.datetime.fromisoformat(table.high_water or min_date)


def _merged_high_water(spark: SparkSession, table: Table, replaced: Callable[[str], bool]) -> Callable:
    """The newest sync time after a merge: what was written, unless folders
    that stay hold a newer one. They can only if the batch brought nothing as
    new as the table had; then their one column is read."""
    def of(latest) -> Optional[str]:
        new, old = _iso(latest), table.high_water
        if old is None or (new is not None and datetime.datetime.fromisoformat(new) >= datetime.datetime.fromisoformat(old)):
            return new
        rest = read_folders(spark, table, lambda p: not replaced(p))
        sync = _sync_column(rest.columns)
        kept = rest.agg(F.max(sync)).first()[0] if sync else None
        return max((v for v in (new, _iso(kept)) if v is not None), default=None, key=datetime.datetime.fromisoformat)
    return of


_V1_SOURCES, _PUSHED = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
_READING = threading.Lock()


def newest(spark: SparkSession, path: str, column: str) -> Optional[DataFrame]:
    """One row ``max_loaded_at``: the newest ``column`` of the table at ``path``.

    A time without zone is read as the bigint it is stored as, of which Spark
    takes the maximum from the footers of the files (the pushed aggregate of
    its V2 Parquet source), so no data is read. Where footers cannot tell - the
    column was written with nulls, is of another type or does not stand at one
    place in all files - the column is read. None without a table.
    """
    table = open_table(spark, path)
    if table is None:
        return None
    names = table.schema.fieldNames()
    place = names.index(column) if column in names else len(names)
    flat = all(not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in table.schema.fields[:place])
    if place == len(names) or not isinstance(table.schema[column].dataType, T.TimestampNTZType) or table.untimed or not flat or table.part == PART or column != _sync_column(names) or not table.live:
        return read_folders(spark, table).agg(F.max(column).alias("max_loaded_at"))
    part = T.StructField(table.part, T.LongType() if table.part == BUCKET else T.DateType())
    schema = T.StructType([T.StructField(f.name, T.LongType() if f.name == column else f.dataType) for f in table.schema.fields] + [part, T.StructField(COMMIT, T.StringType())])
    spark.conf.set(_PUSHED, "true")     # read when the plan is made; it means nothing to other readers
    with _READING:
        before = spark.conf.get(_V1_SOURCES)
        spark.conf.set(_V1_SOURCES, ",".join(x for x in before.split(",") if x != "parquet"))
        try:
            df = spark.read.schema(schema).option("basePath", f"{table.path}/data").parquet(*table.folders())
        finally:
            spark.conf.set(_V1_SOURCES, before)
    micros = df.agg(F.max(column).alias("m"))
    return micros.select((F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("m").cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))).alias("max_loaded_at"))


# ---------------------------------------------------------------------------
# Types (S9)
# ---------------------------------------------------------------------------
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}      # digits a decimal needs
_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def common_type(a: T.DataType, b: T.DataType) -> Optional[T.DataType]:
    """The narrowest type that holds every value of both without loss and that
    Spark's Parquet reader promotes to; None when there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    ka, kb = type(a), type(b)
    if ka in _WHOLE and kb in _WHOLE:
        return a if _ORDER.index(ka) >= _ORDER.index(kb) else b
    for x, y in ((a, b), (b, a)):
        if isinstance(y, T.DoubleType) and type(x) in (T.ByteType, T.ShortType, T.IntegerType, T.FloatType):
            return y
        if isinstance(y, T.DecimalType) and type(x) in _WHOLE:
            digits = max(_WHOLE[type(x)], y.precision - y.scale) + y.scale
            return T.DecimalType(digits, y.scale) if digits <= 38 else None
        if isinstance(y, T.TimestampNTZType) and isinstance(x, T.DateType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def reconciled(stored: T.StructType, batch: T.StructType, keys: Sequence[str] = ()) -> T.StructType:
    """The schema of a table after a batch: the stored columns, then the new
    ones. A type that differs becomes the type that holds both without loss;
    where there is none, or where a key would change its hash, TypeError.
    Metadata: the stored, with the batch's on top."""
    by_name = {f.name.lower(): f for f in batch.fields}
    out = []
    for f in stored.fields:
        g = by_name.pop(f.name.lower(), None)
        if g is None:
            out.append(f)
            continue
        kind = common_type(f.dataType, g.dataType)
        if kind is None:
            raise TypeError(f"column {f.name} is {f.dataType.simpleString()} in the table and {g.dataType.simpleString()} in the batch; no type holds both without loss")
        if f.name in keys and kind != f.dataType and not (type(kind) in _WHOLE and type(f.dataType) in _WHOLE):
            raise TypeError(f"key {f.name} cannot change from {f.dataType.simpleString()} to {kind.simpleString()}")
        out.append(T.StructField(f.name, kind, True, {**(f.metadata or {}), **(g.metadata or {})}))
    return _plain(T.StructType([*out, *by_name.values()]))


def conformed(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """``df`` with the types of ``schema`` (lossless casts); other columns as they are."""
    want = {f.name.lower(): f for f in schema.fields}
    cols = []
    for f in df.schema.fields:
        g = want.get(f.name.lower())
        cols.append(F.col(f"`{f.name}`") if g is None or f.name in extra else
                    (F.col(f"`{f.name}`") if f.dataType == g.dataType else F.col(f"`{f.name}`").cast(g.dataType)).alias(g.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Partition values
# ---------------------------------------------------------------------------
def bucket_expr(keys: Sequence[Union[str, Column]], num_buckets: int, all_cols: Sequence[str] = (),
                range_width: Optional[int] = None) -> Column:
    """Storage bucket of a row.

    * hash (default): ``pmod(xxhash64(key), N)`` - even spread, but a batch of
      random keys touches most buckets;
    * ``range_width``: ``floor(key / width)`` for one numeric key that grows
      with time (event ids, sequence numbers) - new and recently changed keys
      share a few buckets, so an incremental merge rewrites only those, and
      the bucket count grows with the table.

    Rows with a NULL key (they never match) are spread by the hash of the
    whole row instead of piling up in one bucket (negative buckets in the
    range scheme).
    """
    keys = [col_of(k) for k in keys]
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & k.isNotNull()
    if range_width:
        if len(keys) != 1:
            raise ValueError("range buckets need a single numeric key")
        by_key = F.floor(keys[0] / F.lit(int(range_width))).cast("long")
        spread = NULL_KEY_SPREAD
    else:
        by_key = F.pmod(F.xxhash64(*keys), F.lit(num_buckets))
        spread = num_buckets
    if not all_cols:
        return by_key.cast("long")
    by_row = F.pmod(F.xxhash64(*[F.col(c) for c in all_cols]), F.lit(spread))
    if range_width:
        by_row = -1 - by_row
    return F.when(has_key, by_key).otherwise(by_row).cast("long")


def hashed_keys(schema: T.StructType, keys: Sequence[str]) -> List[Column]:
    """The keys as they are hashed: whole numbers as bigint, so that a key
    that is widened keeps its bucket."""
    return [F.col(k).cast("bigint") if type(schema[k].dataType) in _WHOLE else F.col(k) for k in keys]


def with_bucket(df: DataFrame, keys: Sequence[str], layout: Dict) -> DataFrame:
    """``df`` with the storage bucket of each row."""
    return df.withColumn(BUCKET, bucket_expr(hashed_keys(df.schema, keys), layout.get("buckets", DEFAULT_BUCKETS),
                                             [c for c in df.columns if c != BUCKET], layout.get("range_width")))


def day_of(layout: Dict) -> Column:
    """The ``_day`` of a row."""
    day = F.to_date(layout["day"])
    return day if layout["unit"] == "day" else F.trunc(day, layout["unit"]).cast("date")


# ---------------------------------------------------------------------------
# Writes
# ---------------------------------------------------------------------------
def _first_layout(df: DataFrame, keys: List[str], num_buckets: Optional[int], range_width: Optional[int], day_unit: Optional[str]) -> Dict:
    if day_unit:
        return {"keys": keys, "day": AUDIT_SYNC, "unit": day_unit}
    if range_width:
        return {"keys": keys, "range_width": int(range_width)}
    return {"keys": keys, "buckets": int(num_buckets or first_buckets(df))}


def write_table(df: DataFrame, path: str, keys: Union[str, Sequence[str]], num_buckets: Optional[int] = None,
                range_width: Optional[int] = None, day_unit: Optional[str] = None, applied: Optional[tuple] = None, comment: Optional[str] = None) -> Table:
    """First build: one commit in place of all that an earlier table at
    ``path`` held, with one folder per bucket (or day).

    The bucket count comes from the size of what ``df`` reads unless given.
    Buckets and days are dealt by Spark's rebalancing, so small ones share a
    task and a large one is split.
    """
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    before = open_table(spark, path)
    layout = _first_layout(df, keys, num_buckets, range_width, day_unit)
    if day_unit:
        return commit(df.withColumn(DAY, day_of(layout)).hint("rebalance", DAY), path, before, df.schema, layout, DAY, applied=applied, comment=comment)
    return commit(with_bucket(df, keys, layout).hint("rebalance", BUCKET), path, before, df.schema, layout, applied=applied, comment=comment)


def stage(df: DataFrame, spark: SparkSession, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back
    (the read carries its folder as ``stage_path``)."""
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def merge_upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Union[str, Sequence[str]],
                 exclude_update: Sequence[str] = (AUDIT_LOAD,), match_cond: Optional[Column] = None,
                 num_buckets: Optional[int] = None, combine=None, create=None, guard_col: Optional[str] = None,
                 range_width: Optional[int] = None, window_from=None, day_unit: str = "day", applied: Optional[tuple] = None, comment: Optional[str] = None) -> dict:
    """Upsert ``batch`` (one row per key) into the table at ``path``.

    ``combine(target_buckets, staged_batch, pieces=, num_partitions=)``
    replaces the default merge (both carry the bucket column; the result must
    too; the last two are those of :func:`merge_shares`); ``create(batch)``
    shapes the batch of a first write. ``window_from`` is the time from which
    ``match_cond`` matches: a first build then lays the table out by sync time,
    a folder for each ``day_unit`` (:func:`day_unit_for`), and a merge into such
    a table reads and rewrites the folders from it on and adds older rows of
    the batch beside what their folder holds. ``applied`` is a
    stream and its micro-batch: one that the table holds already is skipped.
    Returns a small report.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    table = open_table(spark, path)
    if table is None:
        first = create(batch) if create else batch
        new = write_table(first, path, keys, num_buckets, range_width, day_unit=day_unit if window_from is not None else None, applied=applied,
                          comment=comment)
        return {"mode": "create", "buckets": new.layout.get("buckets"), "layout": new.layout}
    if applied and table.applied.get(applied[0], -1) >= int(applied[1]):
        return {"mode": "skipped", "rows": 0, "buckets": 0}
    own = batch.schema if create is None else create(batch).schema
    schema = reconciled(table.schema, own, keys)
    batch = conformed(batch, schema)
    table.schema = schema              # files of a narrower type are promoted as they are read
    if table.part == DAY:
        return _merge_days(spark, table, batch, keys, exclude_update, match_cond, guard_col, window_from, applied)

    # The touched buckets (small integers, no more than the table has or the
    # batch makes) and the row count are gathered while the batch is staged.
    obs = Observation("staged_batch")
    bucketed = with_bucket(batch, keys, table.layout)
    staged = stage(bucketed.observe(obs, F.collect_set(BUCKET).alias("buckets"), F.count(F.lit(1)).alias("rows")), spark)
    seen = obs.get
    touched, n_rows = {str(b) for b in seen["buckets"] or []}, seen["rows"]
    if n_rows:
        target = read_folders(spark, table, touched.__contains__)
        dealt = merge_shares(target, staged, n_rows, len(touched))
        if combine is not None:
            merged = combine(target, staged, **dealt)
        else:
            merged = merge_frames(target, staged, keys, exclude_update, match_cond, bucket_col=BUCKET, guard_col=guard_col, **dealt)
        commit(merged.select(*schema.fieldNames(), BUCKET), path, table, schema, table.layout, replaces=touched.__contains__,
               high_water=_merged_high_water(spark, table, touched.__contains__), applied=applied)
    remove_path(spark, staged.stage_path)
    return {"mode": "merge", "rows": n_rows, "buckets": len(touched)}


def _merge_days(spark: SparkSession, table: Table, batch: DataFrame, keys: Sequence[str], exclude_update: Sequence[str],
                match_cond: Optional[Column], guard_col: Optional[str], window_from, applied: Optional[tuple]) -> dict:
    """The merge of a table laid out by sync day.

    With a match window only its days are read and replaced; without one any
    day may hold a match, so all are.
    """
    staged = stage(batch, spark)
    n_rows = staged.count()
    if n_rows:
        start = None if match_cond is None or window_from is None else _first_of(window_from, table.layout["unit"])
        inside = (lambda p: True) if start is None else (lambda p: re.match(r"\d", p) is not None and datetime.date.fromisoformat(p) >= start)
        # the window as a partition filter as well: Spark prunes by it, whatever the folders given
        target = read_folders(spark, table, inside)
        if start is not None:
            target = target.where(F.col(DAY) >= F.lit(start))
        merged = merge_frames(target.drop(DAY), staged, keys, exclude_update, match_cond, guard_col=guard_col)
        merged = merged.select(*table.schema.fieldNames(), day_of(table.layout).alias(DAY)).hint("rebalance", DAY)
        commit(merged, table.path, table, table.schema, table.layout, DAY, replaces=inside,
               high_water=_merged_high_water(spark, table, inside), applied=applied)
    remove_path(spark, staged.stage_path)
    return {"mode": "merge", "rows": n_rows, "days": None}


def _first_of(value, unit: str) -> datetime.date:
    if not isinstance(value, datetime.date):
        value = datetime.datetime.fromisoformat(str(value))
    day = value.date() if isinstance(value, datetime.datetime) else value
    return day if unit == "day" else day.replace(day=1) if unit == "month" else day.replace(month=1, day=1)

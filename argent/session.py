"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. Timestamps are kept without zone and the
# session zone is pinned so literal parsing is the same on every executor.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "argent") -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("ARGENT_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name it; only a local master (tests) gets a temporary one.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="argent-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder under the checkpoint root for tables written by one job;
    it goes when the driver's JVM ends."""
    path = f"{_checkpoint_root(spark)}/argent/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = _fs_path(spark, path)
    fs.deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written as Parquet to the shared work folder and read again: a cut
    in the lineage that survives lost executors and has a known size."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs_path(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path of ``path`` (works on any cluster store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None when there is none."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new.

    Written beside it and renamed over it; on an object store, where a rename
    is a copy, put there at once.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, target = _fs_path(spark, path)
    scheme = fs.getUri().getScheme()
    direct = scheme in ("s3", "s3a", "s3n", "gs", "oss", "cos")
    if scheme == "file":
        fs = fs.getRawFileSystem()      # a checksum file of its own would be renamed later
    beside = target if direct else jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    out = fs.create(beside, True)
    out.write(text.encode())
    out.close()
    if scheme == "file":
        if not fs.rename(beside, target):
            raise OSError(f"could not replace {path}")
    elif not direct:
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        over = spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(beside, target, over)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none when there is no such folder."""
    fs, p = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _owned(path: str) -> bool:
    """Paths this library may delete: work folders and folders of commits."""
    return "/argent/" in path or "/data/_commit=" in path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library wrote (a work folder or what a commit wrote)."""
    if not _owned(path):
        raise ValueError(f"refusing to delete a path this library did not write: {path}")
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def cut_lineage(df):
    """Materialise ``df`` with a reliable checkpoint in the shared folder of
    ``spark.checkpoint.dir`` (survives executor loss, unlike a local one)."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)

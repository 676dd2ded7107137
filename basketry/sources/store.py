"""Materialisation: written tables that cut lineage and allow reuse.

Every level of a mining run is written as parquet into the shared checkpoint
folder and read back.  That keeps each level's plan short (no lineage growth
across iterations), makes the data survive the loss of an executor, and lets
a second run reuse a finished result.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import checkpoint_root


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A finished Spark write leaves ``_SUCCESS``; half-written output does not."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3.  Unlike the reference (which returns None) a missing path raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def save_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S5."""
    df.write.mode(mode).parquet(path)


def cache_key(**parts) -> str:
    """Reuse key: a digest of *everything* that determines a result (input
    identity, algorithm, parameters, level)."""
    blob = json.dumps(parts, sort_keys=True, default=str)
    return hashlib.sha1(blob.encode()).hexdigest()[:16]


def _uncut_plan(df: DataFrame) -> str:
    """The canonical analysed plan as text, however many fields it has."""
    spark, name = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, str(2**31 - 1))
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set(name, before)


def _file_roots(df: DataFrame) -> list[str] | None:
    """Root paths of the file scans that ``df`` reads; None if it also reads
    something else (in-memory rows, an RDD, a stream)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots: set[str] = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "Range":
            continue
        try:
            paths = leaf.relation().location().rootPaths()
        except Exception:  # noqa: BLE001 -- py4j: the leaf is no file scan
            return None
        roots |= {paths.apply(j).toString() for j in range(paths.size())}
    return sorted(roots)


def input_identity(df: DataFrame, input_version: str | None = None) -> str:
    """Identity of a DataFrame's result for reuse keys: its canonical analysed
    plan, uncut, and the content it reads -- a caller's ``input_version``, or
    path, size and modification time of every file under the roots that are
    read, hashed by a Spark job.  Frames that read anything but files have no
    identity of their own: without a version they are refused."""
    h = hashlib.sha1(_uncut_plan(df).encode())
    if input_version is not None:
        h.update(f"version {input_version}".encode())
        return h.hexdigest()
    roots = _file_roots(df)
    if roots is None:
        raise ValueError("reuse of data that are not files needs an input_version")
    if roots:
        spark = df.sparkSession
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
                 .select(F.xxhash64("path", "length", "modificationTime").alias("f")))
        seen = files.agg(F.count("f"), F.bit_xor("f"), F.sum(F.pmod("f", F.lit(1 << 31)))).first()
        h.update(repr(tuple(seen)).encode())
    return h.hexdigest()


def _read_text(spark: SparkSession, path: str) -> str | None:
    return spark.read.text(path).first()[0] if path_exists(spark, path) else None


def materialize(df: DataFrame, path: str, force: bool = False, input_version: str | None = None) -> DataFrame:
    """If ``path`` holds the finished result of the same plan over the
    same input, read it; otherwise (or with ``force``) compute ``df``, write
    it and read it back.  The key lies beside the data, in ``<path>.key``."""
    spark, key_path = df.sparkSession, path.rstrip("/") + ".key"
    key = input_identity(df, input_version)
    if force or not is_complete(spark, path) or _read_text(spark, key_path) != key:
        delete_path(spark, key_path)
        df.write.mode("overwrite").parquet(path)
        spark.createDataFrame([(key,)], "value string").coalesce(1).write.mode("overwrite").text(key_path)
    return spark.read.parquet(path)


class Store:
    """Folder for the intermediate tables of one run, below the shared
    checkpoint folder of the session."""

    def __init__(self, spark: SparkSession, root: str | None = None, run: str | None = None):
        self.spark = spark
        base = root or checkpoint_root(spark)
        self.root = f"{base.rstrip('/')}/basketry-{run or uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def complete(self, name: str) -> bool:
        return is_complete(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def clear(self) -> None:
        delete_path(self.spark, self.root)

    def child(self, name: str) -> "Store":
        s = Store.__new__(Store)
        s.spark = self.spark
        s.root = self.path(name)
        return s

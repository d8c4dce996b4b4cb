"""Lineage cuts in the folder that all executors share.

A staged table is plain Parquet under ``spark.checkpoint.dir``; losing an
executor never loses it, and readers see only what a finished job committed. Its
writer gives up its shuffle files once the table is there. Tables go when the
operator that made them returns, but for those that its result reads; those go
with the session, or after a :func:`step` as soon as the next one begins.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the operators that run now, innermost last; the first list is what finished ones left.
_scopes: list[list[str]] = [[]]
_steps: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; on one machine a temporary one where none is set."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted with the session at the latest."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = _file_system(spark, path)
    fs.deleteOnExit(p)
    _scopes[-1].append(path)
    return path


def write(df: DataFrame, path: str, *partition: str) -> None:
    """Append ``df``; its shuffle files go when it is written."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode("append").partitionBy(*partition).parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stage`, with the path, for tables to :func:`drop` early."""
    spark = df.sparkSession
    path = new_path(spark, name)
    write(df, path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    return stage_at(df, name)[0]


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a number of its own for every row, whatever its ids are."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that no later plan reads."""
    for path in paths:
        p, fs = _file_system(spark, path)
        fs.delete(p, True)
        fs.cancelDeleteOnExit(p)


def _read_by(df: DataFrame, paths: list[str]) -> set[str]:
    parts = {x for f in df.inputFiles() for x in f.split("/")[-4:-1]}
    return {p for p in paths if p.rsplit("/", 1)[-1] in parts}


def tidy(operator):
    """A decorator: what ``operator`` staged and its result does not read is deleted when it returns."""

    @functools.wraps(operator)
    def run(*args, **options):
        _scopes.append([])
        try:
            out = operator(*args, **options)
        finally:
            made = _scopes.pop()
        live = _read_by(out, made) if made else set()
        drop(out.sparkSession, *[p for p in made if p not in live])
        _scopes[-1] += [p for p in made if p in live]
        return out

    return run


def step(function):
    """A decorator for steps whose result is written before the next one begins: what earlier steps left goes then, but for what ``docs`` reads."""

    @functools.wraps(function)
    def run(spark, docs, *args):
        live = _read_by(docs, _steps) if _steps else set()
        drop(spark, *[p for p in _steps if p not in live])
        _steps[:] = [p for p in _steps if p in live]
        _scopes.append([])
        try:
            return function(spark, docs, *args)
        finally:
            _steps.extend(_scopes.pop())

    return run


def stage_step(df: DataFrame, name: str) -> DataFrame:
    """As :func:`stage`, for the table between two steps."""
    out, path = stage_at(df, name)
    _scopes[-1].remove(path)
    _steps.append(path)
    return out

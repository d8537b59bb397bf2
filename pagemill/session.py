"""Shared folders and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (as in tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="pagemill-")
    return _LOCAL_DIRS[application]


def new_workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared folder."""
    return f"{shared_dir(spark)}/pagemill/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered_paths(spark: SparkSession, root: str, pattern: str) -> list[tuple[int, ...]]:
    """The numbers in the paths below ``root`` that match, as ``log/batch_id=*``; one listing."""
    escaped = re.sub(r"([\\{}\[\]*?])", r"\\\1", root)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{escaped}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    depth = pattern.count("/") + 1
    tails = ["/".join(entry.getPath().toString().split("/")[-depth:]) for entry in found or ()]
    return sorted(tuple(map(int, re.findall(r"=(\d+)", tail))) for tail in tails)


def finished_numbers(spark: SparkSession, root: str, label: str) -> list[int]:
    """The numbers of the folders ``label=N`` below ``root`` whose write finished."""
    return [n for (n,) in numbered_paths(spark, root, f"{label}=*/_SUCCESS")]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` reliably, so that a lost executor does not replay its history."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def kept_by(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` materialized reliably in ``parts`` partitions by ``keys``, which later plans know of.

    Joins and groupings by the keys then need no exchange of it, nor of a union of such tables.
    Only a plan fixed in advance remembers its partitioning, so adaptive execution is off for the
    write.
    """
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut_lineage(df.repartition(parts, *keys).sortWithinPartitions(*keys))
    finally:
        conf.set(name, before)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a table that :func:`cut_lineage` or :func:`kept_by` made."""
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        remove_folder(df.sparkSession, file.get())

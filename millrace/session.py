"""Session and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on; ``conf`` keys use ``__`` for dots.

    Shuffle sizing is left to adaptive execution, so nothing here depends on the data volume.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # the JIT compiler skips methods above 8000 bytes; wide feature rows then run faster as
        # split projections than as one generated loop
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (``__`` for dots) that hold inside the block and are put back after it."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a session whose driver does all the work (``local``, ``local[n]``) may fall back to a temporary
    folder; on a cluster, also a simulated one, a missing setting is an error, because files written to one
    machine would be lost to the others.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="millrace-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Removes folders that ``scratch_path`` named; anything outside the shared folder is refused."""
    base = shared_dir(spark)
    for path in paths:
        if not path.startswith(f"{base}/"):
            raise ValueError(f"{path} is not in the shared folder")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

"""Session helpers: where shared intermediate data may live."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session may have neither: it gets a temporary folder, once per
    application, removed at exit. On a cluster that would be a folder of one machine,
    so it is refused. What lies in a shared folder is the user's to clear; with
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark removes checkpoints itself.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all machines share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sievemark-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/sievemark/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


_lock = threading.Lock()
_held: dict[tuple[int, str], list] = {}


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Hold a session setting at ``value`` for a while, then give it back.

    Uses that overlap, in threads of one session, share it; the last one restores it.
    """
    place = (id(spark), key)
    with _lock:
        if place not in _held:
            _held[place] = [spark.conf.get(key, None), 0]
            spark.conf.set(key, value)
        _held[place][1] += 1
    try:
        yield
    finally:
        with _lock:
            _held[place][1] -= 1
            if not _held[place][1]:
                before = _held.pop(place)[0]
                if before is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before)

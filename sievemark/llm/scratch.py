"""Intermediate tables of the operators, and giving back those of a finished step."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sievemark import session

#: Bytes of rows that go to a Python worker at a time in a chain of steps: whole texts are long rows.
BATCH_BYTES = 1 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_own = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, noted for the step that asks for it."""
    path = session.scratch_path(spark, name)
    if getattr(_own, "noted", None) is not None:
        _own.noted.append(path)
    return path


def step(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A step of a chain whose result is written before the next step is called.

    Its intermediate tables are removed when the next step (of the same thread) begins:
    until then the result, which is not computed yet, reads them. For the same reason the
    session's Arrow batches keep to ``BATCH_BYTES`` from the first step on, unless the session
    sets their bytes itself: buffers of large batches stay with executor and worker.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in getattr(_own, "previous", []):
            remove(spark, path)
        if spark.conf.get(_BATCH_KEY, None) is None:
            spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
        _own.noted = []
        try:
            return function(spark, docs, sf_dir)
        finally:
            _own.previous, _own.noted = _own.noted, None

    return run


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

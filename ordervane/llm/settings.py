"""Session settings that hold while an operator writes its tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Within a run of several writes: a write's shuffle files go when it is done.
SHUFFLES_DELETED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: For rows that hold whole texts: less of them at a time on their way to Python.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextmanager
def settings(spark: SparkSession, *several: dict[str, str]) -> Iterator[None]:
    """Within it the settings have these values, then the ones before."""
    wanted = {k: v for one in several for k, v in one.items()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

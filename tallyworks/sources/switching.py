"""Sinks that keep what they replace until the new data are complete."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def switched(spark: SparkSession, target: str, replace: bool) -> Iterator[str]:
    """A path to write to, which is at `target` once the block has ended without an error.

    Without `replace` that is the target itself, and writers refuse one that exists. Else the data are written beside
    it, in the same folder and so in the same store; only then is the old target moved aside, the new one moved in, and
    the old one deleted. If the block fails, the target is as it was and what was written is deleted. If the new one
    cannot be moved in, the old one is moved back. Between the two moves there is no target for a moment.
    """
    if not replace:
        yield target
        return
    path = spark._jvm.org.apache.hadoop.fs.Path
    place = path(target.rstrip("/"))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    token = uuid.uuid4().hex
    new, old = (path(place.getParent() or path("."), f".{place.getName()}-{kind}-{token}") for kind in ("new", "old"))
    try:
        yield new.toString()
    except BaseException:
        files.delete(new, True)
        raise
    had = files.exists(place)
    if had and not files.rename(place, old):
        files.delete(new, True)
        raise OSError(f"{target} cannot be moved aside; it is as it was")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        files.delete(new, True)
        raise OSError(f"the new data cannot be moved to {target}; it is as it was")
    if had:
        files.delete(old, True)
    spark.catalog.refreshByPath(target)

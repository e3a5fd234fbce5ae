"""What a frame counted while it was written."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(counted: Observation, nothing: dict) -> dict:
    """The metrics of a frame that has been written, or `nothing`.

    Where Spark sees beforehand that a frame has no rows, it leaves the counting
    out, and the finished job has no metrics to give.
    """
    try:
        return dict(counted.get)
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.getClass().getName():
            raise
        return nothing

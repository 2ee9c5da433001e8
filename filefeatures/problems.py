"""Errors that are a file's own fault. A watch puts such a file into quarantine; every other error stops it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Error conditions of Spark that tell of a file's content.
CONTENT_CONDITIONS = ("MALFORMED_RECORD_IN_PARSING", "INVALID_HEADER")
# Those that a broken file and a broken store have in common.
READ_CONDITIONS = ("FAILED_READ_FILE",)


class FileProblem(ValueError):
    """The content of a file cannot be used."""


class NoHeader(FileProblem, FileNotFoundError):
    """No file has a header line."""


def conditions(error: BaseException) -> Iterator[str]:
    """Spark's error conditions of an error and of what caused it, on the Python and on the Java side.

    An error inside a task reaches Python as a plain Java error with Spark's own error as a cause.
    """
    seen = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        if isinstance(error, PySparkException) and error.getCondition():
            yield error.getCondition()
        java = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
        for _ in range(20):  # Java causes may form a ring
            if java is None:
                break
            try:
                condition = java.getCondition()
            except (Py4JError, TypeError):
                condition = None
            if condition:
                yield condition
            java = java.getCause()
        error = error.__cause__ or error.__context__


def is_file_problem(error: BaseException) -> bool:
    """Whether the error tells of a file's content; a file that could not be read is another matter (see `is_at_fault`)."""
    return isinstance(error, FileProblem) or any(found.startswith(CONTENT_CONDITIONS) for found in conditions(error))


def is_read_problem(error: BaseException) -> bool:
    return any(found.startswith(READ_CONDITIONS) for found in conditions(error))


def readable(spark: SparkSession, path: str) -> bool:
    """Whether the store gives the first and the last byte of a file; what they say does not matter."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        length = store.getFileStatus(place).getLen()
        stream = store.open(place)
        try:
            if length:
                stream.read()
                stream.seek(length - 1)
                stream.read()
        finally:
            stream.close()
    except Py4JJavaError:
        return False
    return True


def is_at_fault(spark: SparkSession, error: BaseException, path: str, others: Iterable[str]) -> bool:
    """Whether an error that came with this file alone is the file's fault and not that of the store.

    Its content is at fault if the store gives the bytes and Spark still could not read it, or if the store gives some other
    file's bytes but not this one's.
    """
    if is_file_problem(error):
        return True
    return is_read_problem(error) and (readable(spark, path) or any(readable(spark, other) for other in others))

"""A log of commits in a folder: numbered JSON files, each put in its place by one rename that fails if the number is taken.

Whatever a commit speaks of is written before it, so a reader sees all of it or nothing.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from filefeatures.session import qualified


def publish(spark: SparkSession, folder: str, facts: dict, *, after: int | None = None) -> int:
    """Add a commit; gives its number. With `after`, the number of the commit that it builds on, it is refused with a
    `Overtaken` when another commit has come in between; without, it takes the next free number."""
    hadoop, gateway = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = hadoop.Path(qualified(spark, folder))
    files, store = hadoop.FileContext.getFileContext(path.toUri(), conf), path.getFileSystem(conf)
    store.mkdirs(path)
    number = 1 + (max((commit["number"] for commit in commits(spark, folder)), default=0) if after is None else after)
    while True:
        draft = hadoop.Path(path, f".{uuid.uuid4()}")
        stream = store.create(draft, True)
        stream.write(bytearray(json.dumps({"number": number, **facts}).encode() + b"\n"))
        stream.close()
        try:
            files.rename(draft, hadoop.Path(path, f"{number:020d}.json"), gateway.new_array(hadoop.Options.Rename, 0))
            return number
        except Py4JJavaError as error:
            store.delete(draft, False)
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            if after is not None:
                raise Overtaken(f"commit {number} of {folder} is there already") from error
            number += 1  # another one was faster


class Overtaken(RuntimeError):
    """Somebody else has committed meanwhile."""


def commits(spark: SparkSession, folder: str) -> list[dict]:
    """All commits by number; none if there is no folder yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(qualified(spark, folder))
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    texts = [row.value for row in spark.read.option("pathGlobFilter", "*.json").text(folder).collect()]
    return sorted((json.loads(text) for text in texts if text.strip()), key=lambda commit: commit["number"])

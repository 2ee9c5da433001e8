"""Give predictions back: join them to their features and write one OUT folder per input file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filefeatures.contracts import SOURCE_FILE
from filefeatures.functions.paths import decoded, plain_path, without_scheme
from filefeatures.functions.text import last_path_segment
from filefeatures.operators.delivery import join_predictions, reconcile
from filefeatures.session import qualified
from filefeatures.sinks.csv import write_by_source
from filefeatures.sources.listing import list_files


def deliver_predictions(
    features: DataFrame, predictions: DataFrame, keys: Sequence[str], out: str, *, by: str = SOURCE_FILE
) -> DataFrame:
    """Write `out/<by>=<name>/` with the features and predictions of each input file."""
    delivered = join_predictions(features, predictions, keys)
    write_by_source(delivered, out, by=by, header=True)
    return delivered


def undelivered(spark, folder: str, out: str, *, glob: str = "*.csv") -> DataFrame:
    """State of every input file, named by its path below the folder: an answered one has a folder `<by>=<name>` below
    `out`, with what Spark escapes in a folder's name."""
    root = without_scheme(qualified(spark, folder)).rstrip("/") + "/"
    below = F.substring(plain_path(F.col("path")), len(root) + 1, 1 << 30)
    incoming = list_files(spark, folder, glob).select(below.alias("file_name"))
    folder_name = last_path_segment(F.regexp_replace("path", "/[^/]*$", ""))
    answered = list_files(spark, out).select(decoded(F.regexp_replace(folder_name, "^[^=]*=", "")).alias("file_name"))
    return reconcile(incoming, answered)

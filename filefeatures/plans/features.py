"""The feature chain: derive, project, encode, score, write."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filefeatures import contracts
from filefeatures.functions.text import keyword_flags, labelled_number, marker_count
from filefeatures.operators.effects import EffectsModel, load_effects, score_effects, train_effects
from filefeatures.operators.labels import LabelModel, encode, fit_labels
from filefeatures.operators.select import Derivation, derive_if_present, match_columns, select_wanted
from filefeatures.problems import FileProblem
from filefeatures.session import scratch_scope, stage
from filefeatures.sinks.csv import dump_features, write_by_source, write_model_input
from filefeatures.sinks.runs import Run
from filefeatures.sources.csv import CORRUPT, files_read, glob_literal, named_root, read_by_header, split_checked

OUTPUTS = ("bad-rows", "preprocessed", "model-input", "predictions")


def _payment_flags(source: Column) -> dict[str, Column]:
    return keyword_flags(
        source, contracts.PAYMENT_LABEL, contracts.PAYMENT_METHODS, prefix="AA_PM_support_", delimiter="|"
    )


# What the listing feed's text columns hold.
LISTING_DERIVATIONS = [
    Derivation("Review Sources", lambda c: {"ReviewSourcesCount": marker_count(c, contracts.REVIEW_MARKER)}),
    Derivation("Facebook Profile", lambda c: {"FaceBookLikesCount": labelled_number(c, "Likes:")}),
    Derivation(
        "Twitter Profile",
        lambda c: {
            "TwitterFollowersCount": labelled_number(c, "Followers:"),
            "TwitterFollowingCount": labelled_number(c, "Following:"),
            "TwitterTweetsCount": labelled_number(c, "Tweets:"),
        },
    ),
    Derivation("Additional Attributes", _payment_flags),
]


def derive_and_project(
    df: DataFrame, wanted: Iterable[str], derivations: Iterable[Derivation], keep: Sequence[str] = ()
) -> DataFrame:
    """Wanted columns that exist, then the derived ones, then `keep`.

    Derivations see all columns of the input; the scan still reads only what is used.
    """
    derived, new = derive_if_present(df, derivations)
    found = [name for name in match_columns(derived.columns, wanted) if name not in new]
    if not found:
        raise FileProblem(f"none of the wanted columns is in the input: {df.columns}")
    return select_wanted(derived, [*found, *new, *keep])


def listing_features(df: DataFrame, id_column: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Features of the listing feed before its category is encoded; `keep` are columns to carry along."""
    return derive_and_project(df, contracts.wanted_columns(id_column), LISTING_DERIVATIONS, keep)


def run_features(
    spark: SparkSession,
    paths: str | Sequence[str],
    out: str,
    *,
    labels: LabelModel | None = None,
    per_file: bool = False,
    id_column: str | None = None,
    score: Callable[[DataFrame], DataFrame] | None = None,
    multiline: bool | None = None,
    glob: str | None = "*.csv",
    root: str | None = None,
) -> DataFrame:
    """Read files, write the outputs `preprocessed`, `model-input`, `bad-rows` and, with a scorer, `predictions` below `out`.

    All outputs become visible together (see `sinks.runs`; `read_output` gives their rows), so a run that fails on its way
    changes nothing. What an earlier run wrote for the same files is replaced. The CSV text is parsed once: features are
    staged as parquet in the shared scratch folder, and the label fit and all the writes read that. Labels come from a
    stored model, from each file alone (`per_file`), or from all the files of this run. Gives the encoded features.

    Rows with more or fewer values than their header go to `bad-rows` with their file and raw text, and nowhere else.
    A file is its path below `root`, without one below the folder that `paths` names (see `named_root`): per-file labels
    and output folders follow that, so files of the same name in two folders stay apart, also in two runs. A file that has
    no row any more has none in any output.
    """
    root = named_root(spark, paths) if root is None else root
    rows = read_by_header(spark, paths, multiline=multiline, glob=glob, root=root, marked=True)
    features, bad = split_checked(stage(listing_features(rows, id_column, keep=[contracts.SOURCE_FILE, CORRUPT])))

    category = match_columns(features.columns, [contracts.CATEGORY_COLUMN])
    if category:
        groups = [contracts.SOURCE_FILE] if per_file else []
        model = labels if labels and not per_file else fit_labels(features, contracts.CATEGORY_COLUMN, groups=groups)
        features = encode(
            features,
            model,
            contracts.CATEGORY_COLUMN,
            contracts.CATEGORY_VECTOR,
            fitted_here=model is not labels,
        )
    last = [c for c in features.columns if c != contracts.SOURCE_FILE] + [contracts.SOURCE_FILE]
    # Laid out by source once, for all the writes.
    features = stage(select_wanted(features, last).hint("rebalance", F.col(contracts.SOURCE_FILE)))

    run = Run(spark, out, OUTPUTS)
    try:
        write_by_source(bad, run.path("bad-rows"), quote_all=True)
        dump_features(features, run.path("preprocessed"), clustered=True)
        write_model_input(features, run.path("model-input"), clustered=True)
        if score:
            write_by_source(score(features), run.path("predictions"), header=True)
        run.commit(files_read(spark, paths, glob, root))
    except BaseException:
        run.abandon()
        raise
    return features


def features_handler(
    spark: SparkSession, out: str, root: str, **options: object
) -> Callable[[Sequence[str], int], None]:
    """`run_features` as a handler for `watch_files`; a repeated batch replaces what it wrote before.

    `root` is the folder that files are named below, the same for all batches.

    Without a stored label model each file gets labels of its own, so that the features of a file do not
    depend on the files it happens to arrive with.
    """
    options.setdefault("per_file", options.get("labels") is None)
    options.setdefault("root", root)

    def handle(paths: Sequence[str], batch_id: int) -> None:
        with scratch_scope(spark):
            run_features(spark, [glob_literal(path) for path in paths], out, glob=None, **options)

    return handle


def train_on_target(
    features: DataFrame, labels: LabelModel, numeric: Sequence[str], folder: str, *, reg_param: float = 0.0
) -> EffectsModel:
    """Fit a linear model of the learning target on numbers and the category, and store it."""
    model = train_effects(
        features, contracts.TARGET_COLUMN, numeric, contracts.CATEGORY_COLUMN, labels=labels, reg_param=reg_param
    )
    return model.save(folder)


def score_target(features: DataFrame, folder: str) -> DataFrame:
    """Add the prediction of a model stored by `train_on_target`."""
    return score_effects(features, load_effects(features.sparkSession, folder))

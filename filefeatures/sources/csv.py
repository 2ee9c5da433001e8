"""Reading folders of CSV files."""

from __future__ import annotations

import csv
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.contracts import CSV_OPTIONS, SOURCE_FILE
from filefeatures.functions.paths import plain_path, source_file_name, without_scheme
from filefeatures.operators.select import quoted
from filefeatures.operators.types import typed
from filefeatures.problems import FileProblem, NoHeader
from filefeatures.session import is_file, qualified, stage

CORRUPT = "_corrupt_record"
FILES_BROADCAST = 100_000  # layouts of so many files go to the tasks; of more, rows are shuffled to meet them


def _reader(spark: SparkSession, *, multiline: bool, glob: str | None = None, **options: object):
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multiline, **options)
    return reader.option("pathGlobFilter", glob) if glob else reader


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema: T.StructType | str | None = None,
    header: bool = True,
    multiline: bool = True,
    glob: str | None = "*.csv",
    check_header: bool = True,
    source_file: bool = False,
    root: str | None = None,
    marked: bool = False,
) -> DataFrame:
    """All files of a folder that have one and the same header; every column is text without a schema.

    A file whose header differs from the schema is an error, never a silent shift of columns.
    `multiline=False` lets Spark split large files; use it when no value holds a line break. `marked` adds the
    raw text of rows that do not follow the schema (see `split_checked`).
    """
    reader = _reader(spark, multiline=multiline, glob=glob, header=header, **(CHECK_OPTIONS if marked else {}))
    if marked:
        schema = marked_schema(schema)
    if header and check_header:
        reader = reader.option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(paths)
    if not source_file:
        return df
    if any(name.lower() == SOURCE_FILE for name in df.columns):
        raise FileProblem(f"a column of the input is named {SOURCE_FILE}, as the one for the file is")
    return df.select("*", source_file_name(root).alias(SOURCE_FILE))


def read_inferred(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    keep_text: Iterable[str] = (),
    multiline: bool | None = None,
    glob: str | None = "*.csv",
) -> DataFrame:
    """All files of a folder with the types that their texts have (see `operators.types`), aligned by column name.

    A column gets a type only if every text of it prints back to itself, so codes with leading zeros stay text. The text is
    parsed once and staged; types are measured and cast from there. `keep_text` names columns that stay text in any case.
    """
    text = stage(read_by_header(spark, paths, multiline=multiline, glob=glob).drop(SOURCE_FILE))
    return typed(text, keep_text=keep_text)


def marked_schema(schema: T.StructType) -> T.StructType:
    """The schema with a column that holds the raw text of a row that does not follow it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


# A row is checked as a whole, whatever columns are used later, so the parser prunes no columns.
CHECK_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}


def split_checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that follow the schema, file name and raw text of the others) of marked rows.

    A row of the wrong shape keeps the columns that could be read, so the mark decides, not NULLs.
    """
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, F.col(CORRUPT).alias("line"))
    return good, bad


def read_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    header: bool = True,
    multiline: bool = True,
    glob: str | None = "*.csv",
    root: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Good rows with their `source_file`, and the raw text of bad ones; the files are parsed once."""
    reader = _reader(spark, multiline=multiline, glob=glob, header=header, **CHECK_OPTIONS)
    rows = reader.schema(marked_schema(schema)).csv(paths).select("*", source_file_name(root).alias(SOURCE_FILE))
    return split_checked(stage(rows))


def may_span(line: Column) -> Column:
    """1 when a quoted value may go on past the end of this line, else 0.

    With quotes only around values, and doubled inside them, that takes an odd number of quotes. A quote elsewhere in
    an unquoted value makes the count say nothing, so such a line counts too: its file is then read as a whole.
    """
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    stray = line.rlike('(?:^|,)[^",]+"')
    return F.when(F.contains(line, F.lit('"')) & ((quotes % 2 == 1) | stray), 1).otherwise(0)


def file_headers(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv", *, look_for_breaks: bool = True
) -> DataFrame:
    """One row per file: its path as the file source encodes it, first line that is not blank, `spans`.

    `spans` says whether a quoted value may hold a line break, which only a look at every line can tell. The
    text is split, lines are combined before the shuffle, and one row per file and task is shuffled.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
    )
    lines = lines.withColumn("odd", may_span(F.col("value")) if look_for_breaks else F.lit(0))
    first = F.when((F.col("start") == 0) & F.col("value").rlike(r"\S"), F.col("position"))
    # A set keeps the whole aggregation hash-based; with text buffers alone Spark would sort all lines.
    return (
        lines.where("start = 0 OR odd = 1")
        .groupBy("path")
        .agg(
            F.min_by("value", first).alias("header"),
            F.array_contains(F.collect_set("odd"), 1).alias("spans"),
        )
        .where("header IS NOT NULL")
    )


def spans_lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv") -> bool:
    """Whether any of the files may have a line break inside quotes."""
    return not file_headers(spark, paths, glob).where("spans").isEmpty()


def glob_literal(path: str) -> str:
    """A path as `load` wants it, with its glob characters taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def header_names(line: str) -> list[str]:
    """Column names of a header line, named as Spark does: `_c1` for a blank, `A0, A2` for repeats."""
    if line.count('"') % 2:
        raise FileProblem(f"the header has a line break in a name: {line!r}")
    raw = next(csv.reader([line.lstrip("\ufeff")]))
    seen = Counter(name.lower() for name in raw)
    return [
        f"_c{i}" if not name else f"{name}{i}" if seen[name.lower()] > 1 else name for i, name in enumerate(raw)
    ]


def common_folder(folders: Sequence[str]) -> str:
    """The longest path that all of these folders lie below, or are."""
    parts = [folder.split("/") for folder in folders]
    shared = 0
    while all(len(p) > shared and p[shared] == parts[0][shared] for p in parts):
        shared += 1
    return "/".join(parts[0][:shared])


def named_root(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """The folder that the caller names, whatever files are in it: without glob parts, of a file the folder that it is in,
    and of several the one that they share."""

    def root(path: str) -> str:
        plain = re.sub(r"\\(.)", r"\1", re.split(r"/[^/]*(?<!\\)[*?\[{]", path)[0]) or "/"
        folder = without_scheme(qualified(spark, plain))
        return folder.rsplit("/", 1)[0] if is_file(spark, plain) else folder

    return root(paths) if isinstance(paths, str) else common_folder([root(path) for path in paths])


def files_read(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv", root: str | None = None
) -> DataFrame:
    """The `source_file` of every file that `read_by_header` reads, also of those without a row; no content is read."""
    files = spark.read.format("binaryFile")
    files = (files.option("pathGlobFilter", glob) if glob else files).load(paths)
    path = plain_path(F.col("path"))
    root = named_root(spark, paths) if root is None else root
    prefix = root.rstrip("/") + "/"
    name = F.when(F.startswith(path, F.lit(prefix)), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(F.regexp_extract(path, "[^/]*$", 0))
    return files.select(name.alias(SOURCE_FILE))


class Layout(NamedTuple):
    """A header line and the columns that it names."""

    header: str
    names: list[str]


class Scan(NamedTuple):
    """What one scan reads: files whose rows have `width` values, across lines or not."""

    paths: str | Sequence[str]
    glob: str | None
    spanning: bool
    width: int


def _by_position(
    spark: SparkSession, scans: Sequence[Scan], files: DataFrame, layouts: Sequence[Layout], root: str, marked: bool
) -> DataFrame:
    """Files of any number of layouts: parsed once into an array of values, which each file's layout puts into columns.

    `files` has (path, header). `marked` needs scans of files of one width each: then the parser itself tells rows of
    another length, and gives the raw text of these alone, which takes it much longer than a row that fits.
    """
    columns = _all_names(layouts)
    numbered = spark.createDataFrame(
        [(n, layout.header, [_position(layout.names, c) for c in columns]) for n, layout in enumerate(layouts)],
        "layout int, header string, place array<int>",
    )
    of_file = files.join(numbered.select("header", "layout"), "header").select("path", "layout")
    of_file = F.broadcast(of_file) if files.count() <= FILES_BROADCAST else of_file

    def values(scan: Scan) -> DataFrame:
        schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(scan.width)])
        reader = _reader(spark, multiline=scan.spanning, glob=scan.glob, header=True, **(CHECK_OPTIONS if marked else {}))
        return (
            reader.schema(marked_schema(schema) if marked else schema)
            .csv(scan.paths)
            .select(
                F.col("_metadata.file_path").alias("path"),
                source_file_name(root).alias(SOURCE_FILE),
                F.array(*schema.names).alias("values"),
                # Spark refuses a scan of the raw text alone, so that goes with the values.
                *([F.when(F.coalesce(*schema.names, CORRUPT).isNotNull(), F.col(CORRUPT)).alias(CORRUPT)] if marked else []),
            )
        )

    rows = reduce(DataFrame.unionByName, map(values, scans)).join(of_file, "path")
    # The layouts came from the driver, so they fit wherever they go.
    rows = rows.join(F.broadcast(numbered.select("layout", "place")), "layout")
    named = [F.get("values", F.get("place", F.lit(i))).alias(name) for i, name in enumerate(columns)]
    return rows.select(*named, *([CORRUPT] if marked else []), SOURCE_FILE)


def _position(names: Sequence[str], wanted: str) -> int:
    return next((i for i, name in enumerate(names) if name.lower() == wanted.lower()), -1)


def _all_names(layouts: Iterable[Layout]) -> list[str]:
    """Every column once, in the spelling and order in which the layouts first name it."""
    found: dict[str, str] = {}
    for layout in layouts:
        for name in layout.names:
            found.setdefault(name.lower(), name)
    return list(found.values())


def _check_names(layout: Layout, example: str, taken: Iterable[str], required: Iterable[str]) -> None:
    lower = {name.lower() for name in layout.names}
    for name in taken:
        if name in lower:
            raise FileProblem(f"a column of {example} is named {name}, as one of the result is")
    missing = [name for name in required if name.lower() not in lower]
    if missing:
        raise FileProblem(f"{example} lacks the columns {missing}")


def read_by_header(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    multiline: bool | None = None,
    glob: str | None = "*.csv",
    root: str | None = None,
    marked: bool = False,
    required: Sequence[str] = (),
) -> DataFrame:
    """Files whose headers differ in order or in columns, aligned by column name; adds `source_file`.

    `source_file` is the path below `root`, without one below the folder that `paths` names (see `named_root`): the file's
    name when it lies in that folder, and the same in every call.

    All columns are text; a column that a file lacks is NULL, unless it is `required`: then the file is an error. All
    files are parsed in one scan, whatever the number of headers, by position; a table of headers says which value belongs
    to which column. With `marked` there is a scan for each number of columns that headers have. With `multiline=None` each
    file is looked at: without a line break inside quotes it is read in splits, otherwise by Spark's multi-line reader in
    one task, whatever its size, in a second scan, so the rows do not depend on it. A file with a line break in a column name is read by itself. With `marked`, a row with more or fewer
    values than its header has its raw text in a column of its own (see `split_checked`). The driver holds distinct
    headers, and file paths only when there are several scans or few files; it holds no rows.
    """
    found = file_headers(spark, paths, glob, look_for_breaks=multiline is None)
    spans = F.lit(multiline) if multiline is not None else F.col("spans")
    broken = F.regexp_count("header", F.lit('"')) % 2 == 1
    # Only a header that its first line holds whole can be shared by several files.
    files = stage(found.select("path", "header", (spans | broken).alias("spans"), F.when(broken, F.col("path")).alias("alone")), "headers")
    kinds = files.groupBy("header", "spans", "alone").agg(F.min("path").alias("path")).collect()
    kinds = sorted(kinds, key=lambda kind: (kind.header, kind.spans, kind.alone or ""))
    if not kinds:
        raise NoHeader(f"no file with a header in {paths}")
    root = named_root(spark, paths) if root is None else root
    taken = [SOURCE_FILE, *([CORRUPT] if marked else [])]
    shared = [kind for kind in kinds if kind.alone is None]
    layouts = [Layout(header, header_names(header)) for header in dict.fromkeys(kind.header for kind in shared)]
    example = {kind.header: unquote(kind.path) for kind in shared}
    for layout in layouts:
        _check_names(layout, example[layout.header], taken, required)

    groups = {}  # by header, which gives the columns their order
    ways = sorted({kind.spans for kind in shared})
    if len(ways) == 1 and len(layouts) == 1 and len(shared) == len(kinds):
        names = layouts[0].names
        groups[layouts[0].header, ""] = read_csv(
            spark,
            paths,
            schema=T.StructType([T.StructField(name, T.StringType()) for name in names]),
            multiline=ways[0],
            glob=glob,
            check_header=names == next(csv.reader([layouts[0].header])),
            source_file=True,
            root=root,
            marked=marked,
        )
    elif layouts:
        width_of = {layout.header: len(layout.names) for layout in layouts}
        widest = max(width_of.values())
        width_of = width_of if marked else dict.fromkeys(width_of, widest)
        shapes = sorted({(kind.spans, width_of[kind.header]) for kind in shared})
        if len(shapes) == 1 and len(shared) == len(kinds):
            scans = [Scan(paths, glob, *shapes[0])]
        else:
            members = defaultdict(list)
            for row in files.where("alone IS NULL").select("path", "header", "spans").collect():
                members[row.spans, width_of[row.header]].append(glob_literal(unquote(row.path)))
            scans = [Scan(sorted(members[shape]), None, *shape) for shape in shapes]
        groups[layouts[0].header, ""] = _by_position(spark, scans, files.where("alone IS NULL"), layouts, root, marked)
    for kind in kinds:
        if kind.alone is not None:
            file = glob_literal(unquote(kind.path))
            by_itself = read_csv(spark, [file], multiline=True, glob=None, check_header=False, source_file=True, root=root)
            _check_names(Layout(kind.header, by_itself.drop(SOURCE_FILE).columns), unquote(kind.path), taken, required)
            groups[kind.header, kind.path] = by_itself
    aligned = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), [groups[key] for key in sorted(groups)])
    if marked and CORRUPT not in aligned.columns:
        aligned = aligned.withColumn(CORRUPT, F.lit(None).cast("string"))
    last = [CORRUPT, SOURCE_FILE] if marked else [SOURCE_FILE]
    return aligned.select(*[quoted(c) for c in aligned.columns if c not in last], *last)

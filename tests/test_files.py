import csv
import gzip
import itertools
import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures import problems
from filefeatures.__main__ import main, parse
from filefeatures.operators.labels import fit_labels
from filefeatures.operators.scoring import score_constant
from filefeatures.plans.delivery import deliver_predictions, undelivered
from filefeatures.plans import features as feature_plan
from filefeatures.plans.features import features_handler, run_features
from filefeatures.plans.importer import run_import
from filefeatures.problems import FileProblem
from filefeatures.session import scratch_scope, stage
from filefeatures.sinks import csv as sink
from filefeatures.sinks import runs
from filefeatures.sinks.runs import Run, counting_commits, current_sources, merge_commits, read_output, remove_superseded
from filefeatures.sources.csv import glob_literal, header_names, named_root, read_by_header, read_checked, read_csv, read_inferred, split_checked
from filefeatures.sources.listing import list_files, route_files
from filefeatures.streaming.arrivals import append_files, watch_files
from filefeatures.streaming.rows import append_checked, append_csv, append_lookup, read_csv_stream

ONCE = {"availableNow": True}


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_files_with_different_headers(spark, tmp_path):
    put(tmp_path, "a b.csv", "A,B", "a1,b1")
    put(tmp_path, "b%20[1].csv", "B,A", "b2,a2", '"x\ny",a4')
    put(tmp_path, "c+d.csv", "A,C", "a3,c3")
    put(tmp_path, "e.csv", "A,C", "a5,c5")
    (tmp_path / "empty.csv").write_text("")
    put(tmp_path, "other.txt", "A,B", "no,no")
    got = {tuple(r) for r in read_by_header(spark, str(tmp_path)).select("A", "B", "C", "source_file").collect()}
    assert got == {
        ("a1", "b1", None, "a b.csv"),
        ("a2", "b2", None, "b%20[1].csv"),
        ("a4", "x\ny", None, "b%20[1].csv"),
        ("a3", None, "c3", "c+d.csv"),
        ("a5", None, "c5", "e.csv"),
    }


def test_many_layouts_are_one_scan(spark, tmp_path):
    names = [f"c{i}" for i in range(7)]
    want = set()
    for f, order in enumerate(itertools.islice(itertools.permutations(range(7)), 0, 5040, 17)):
        own = order[: 7 - f % 3]  # some lack a column or two
        put(tmp_path, f"{f:03d}.csv", ",".join(names[i] for i in own), ",".join(f"{f}-{i}" for i in own), ",".join(["" if i else '""' for i in own]))
        want |= {tuple(f"{f}-{i}" if i in own else None for i in range(7))}
    rows = read_by_header(spark, str(tmp_path))
    assert {tuple(r) for r in rows.where("coalesce(c0, c1, c2, c3, c4, c5, c6) IS NOT NULL").select(names).collect()} == want
    assert rows.count() == 2 * len(want)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


@pytest.mark.parametrize("multiline", [None, False, True])
def test_rows_of_wrong_length_in_files_of_several_layouts(spark, tmp_path, multiline):
    put(tmp_path, "a.csv", "A,B,C", "1,,", "1,2", "1,2,3,4", ",,", "x", "1,2,3")
    put(tmp_path, "b.csv", "B,A", "b,a", '"b, ""q""",', "b", "b,a,c", "b,a,c,d,e", "b,a,c,d,e,f")
    rows = read_by_header(spark, str(tmp_path), multiline=multiline, marked=True)
    good, bad = split_checked(rows)
    assert {tuple(r) for r in good.collect()} == {
        ("1", None, None, "a.csv"), (None, None, None, "a.csv"), ("1", "2", "3", "a.csv"), ("a", "b", None, "b.csv"), (None, 'b, "q"', None, "b.csv"),
    }
    assert sorted(map(tuple, bad.collect())) == [
        ("a.csv", "1,2"), ("a.csv", "1,2,3,4"), ("a.csv", "x"), ("b.csv", "b"), ("b.csv", "b,a,c"), ("b.csv", "b,a,c,d,e"), ("b.csv", "b,a,c,d,e,f"),
    ]
    # Unmarked, missing values are NULL and those too many are dropped.
    unmarked = read_by_header(spark, str(tmp_path), multiline=multiline)
    assert unmarked.count() == 12 and unmarked.where("A = 'x' AND B IS NULL AND C IS NULL").count() == 1


@pytest.mark.parametrize("multiline", [None, True])
def test_raw_text_of_rows_longer_than_any_header(spark, tmp_path, multiline):
    put(tmp_path, "a.csv", "A,B", '"1","2","3","4"', '"1","2","3"', "5,6")
    put(tmp_path, "b.csv", "B,A", '"7","8","9","0"')
    put(tmp_path, "c.csv", "B", '"7",8', "9")
    good, bad = split_checked(read_by_header(spark, str(tmp_path), multiline=multiline, marked=True))
    assert {tuple(r) for r in good.collect()} == {("5", "6", "a.csv"), (None, "9", "c.csv")}
    assert sorted(map(tuple, bad.collect())) == [
        ("a.csv", '"1","2","3"'), ("a.csv", '"1","2","3","4"'), ("b.csv", '"7","8","9","0"'), ("c.csv", '"7",8'),
    ]
    # Spark works a column's default out again for every row that is too short, which took a millisecond a row.
    plan = good._jdf.queryExecution().analyzed().toJSON()
    assert "EXISTS_DEFAULT" not in plan and "absent-" not in plan


def test_layouts_of_few_files_are_broadcast(spark, tmp_path, monkeypatch):
    put(tmp_path, "a.csv", "A,B", "1,2")
    put(tmp_path, "b.csv", "B,A", "4,3")
    for limit, shuffles in ((2, False), (1, True)):
        monkeypatch.setattr("filefeatures.sources.csv.FILES_BROADCAST", limit)
        rows = read_by_header(spark, str(tmp_path)).select("A", "B")
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("strategy=broadcast") < 2) == shuffles
        assert sorted(map(tuple, rows.collect())) == [("1", "2"), ("3", "4")]


def test_files_of_several_layouts_that_span_lines(spark, tmp_path):
    put(tmp_path, "a.csv", "A,B", "1,2")
    put(tmp_path, "b.csv", "B,A", '"x', 'y",1')
    put(tmp_path, "c.csv", 'C,"A', 'A"', "3,4")
    got = {tuple(r) for r in read_by_header(spark, str(tmp_path)).select("A", "B", "C", "`A\nA`").collect()}
    assert got == {("1", "2", None, None), ("1", "x\ny", None, None), (None, None, "3", "4")}


def test_names_of_the_result_and_required_columns(spark, tmp_path):
    put(tmp_path, "a.csv", "A,_corrupt_record", "1,2")
    put(tmp_path, "b.csv", "A", "3")
    assert read_by_header(spark, str(tmp_path)).count() == 2
    with pytest.raises(FileProblem, match="_corrupt_record"):
        read_by_header(spark, str(tmp_path), marked=True)
    with pytest.raises(FileProblem, match=r"b.csv lacks the columns \['_Corrupt_Record'\]"):
        read_by_header(spark, str(tmp_path), required=["a", "_Corrupt_Record"])


def test_import_goes_by_name(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "Zip,n,more", "01234,1,x", "00001,2,x,y")
    put(tmp_path / "in", "b.csv", "n,ZIP", "3,77777")
    rows = run_import(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["Zip", "n"])
    assert {tuple(r) for r in rows.collect()} == {("01234", 1, 1), ("77777", 3, 1)}
    bad = read_csv(spark, str(tmp_path / "out-bad-rows"), schema="line string, source_file string", header=False)
    assert [r.line for r in bad.collect()] == ["00001,2,x,y"]
    put(tmp_path / "in", "c.csv", "n", "3")
    with pytest.raises(FileProblem, match="c.csv lacks"):
        run_import(spark, str(tmp_path / "in"), str(tmp_path / "other"), ["Zip", "n"])
    assert not (tmp_path / "other").exists()


def test_header_names():
    assert header_names('A,"x ""y"", z",,b,B') == ["A", 'x "y", z', "_c2", "b3", "B4"]
    assert header_names("\ufeffA,B") == ["A", "B"]
    with pytest.raises(ValueError, match="line break"):
        header_names('A,"b')


def test_repeated_and_blank_names(spark, tmp_path):
    put(tmp_path, "a.csv", "A,,A", "1,2,3")
    assert read_by_header(spark, str(tmp_path)).first().asDict() == {
        "A0": "1",
        "_c1": "2",
        "A2": "3",
        "source_file": "a.csv",
    }


def test_header_of_a_file_with_several_splits(spark, tmp_path):
    put(tmp_path, "a.csv", "A,B", *[f"{i},b" for i in range(5000)])
    put(tmp_path, "b.csv", "B,A", *[f"b,{i}" for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_by_header(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        assert rows.groupBy("B").count().collect() == [("b", 10000)]
        assert rows.agg(F.sum(F.col("A").cast("int"))).first()[0] == 2 * sum(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def random_csv(seed, rows=60):
    pick = random.Random(seed)
    values = ["", "a", 'say ""hi""', "x,y", "two\nlines", "\n", '""', "é\r\nü", "  b ", '\n""\n', "'"]

    def value():
        text = pick.choice(values)
        return f'"{text}"' if pick.random() < 0.3 or any(c in text for c in ',\n"') else text

    return "A,B b,C\n" + "".join(
        f"{n},{value()},{value()}\n" + pick.choice(["", "\n", "  \n", *[""] * 50]) for n in range(rows)
    )


@pytest.mark.parametrize("split_bytes", ["128", "134217728"])
def test_line_breaks_inside_quotes_at_any_split_size(spark, tmp_path, split_bytes):
    for seed in range(4):
        (tmp_path / f"f{seed}.csv").write_bytes(random_csv(seed).encode())
    with (tmp_path / "f0.csv").open("r+b") as file:
        text = file.read()
        file.seek(0)
        file.write(b"\n\n" + text)
    (tmp_path / "windows.csv").write_bytes(random_csv(9).replace("\r\n", "\n").replace("\n", "\r\n").encode())
    expected = read_csv(spark, str(tmp_path), schema="A string, `B b` string, C string", source_file=True)
    expected = sorted(map(tuple, expected.collect()), key=str)
    assert len(expected) >= 300
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert sorted(map(tuple, read_by_header(spark, str(tmp_path)).collect()), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split_bytes", ["128", "134217728"])
@pytest.mark.parametrize(
    "lines",
    [
        ['1,5" pipe', "2,b", '3,"two', 'lines"', "4,d"],
        ['1,5" pipe', *[f"{i},plain" for i in range(20_000)]],
        ['1,5" x,"open', 'closed"', "2,b,c"],
        ['1,a 5"', '2,6" b', '3,"x', 'y"'],
    ],
)
def test_stray_quotes_lose_no_rows(spark, tmp_path, lines, split_bytes):
    put(tmp_path, "a.csv", "A,B,C" if lines[0].count(",") == 2 else "A,B", *lines)
    whole = sorted(map(tuple, read_csv(spark, str(tmp_path)).collect()), key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        assert sorted((tuple(r)[:-1] for r in read_by_header(spark, str(tmp_path)).collect()), key=str) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_header_with_a_line_break(spark, tmp_path):
    put(tmp_path, "a.csv", '"A', 'x",B', "1,2")
    put(tmp_path, "b.csv", "B", "3")
    assert [tuple(r) for r in read_by_header(spark, str(tmp_path)).orderBy("B").collect()] == [
        ("1", "2", "a.csv"),
        (None, "3", "b.csv"),
    ]


def test_a_file_is_its_path(spark, tmp_path):
    feed(tmp_path / "in/p1", "a.csv", "x", "x", "y")
    feed(tmp_path / "in/p2", "a.csv", "y")
    out = str(tmp_path / "out")
    for _ in range(2):
        run_features(spark, str(tmp_path / "in/*"), out, per_file=True, id_column="Listing")
    got = dump(spark, out).collect()
    assert sorted((r.source_file, r.CategoryVector) for r in got) == [
        ("p1/a.csv", "2|0|1.0"),
        ("p1/a.csv", "2|0|1.0"),
        ("p1/a.csv", "2|1|1.0"),
        ("p2/a.csv", "1|0|1.0"),
    ]
    header = (tmp_path / "in/p1/a.csv").read_text().splitlines()[0]
    (tmp_path / "in/p1/a.csv").write_text(header + "\n")
    run_features(spark, str(tmp_path / "in/*"), out, per_file=True, id_column="Listing")
    assert [r.source_file for r in dump(spark, out).collect()] == ["p2/a.csv"]


def test_two_runs_into_one_output(spark, tmp_path):
    feed(tmp_path / "in/p1", "a.csv", "x", "x")
    feed(tmp_path / "in/p2", "a.csv", "y")
    out = str(tmp_path / "out")
    for part in ("p1", "p2"):
        run_features(spark, str(tmp_path / "in" / part), out, id_column="Listing", root=str(tmp_path / "in"))
    assert sorted(r.source_file for r in dump(spark, out).collect()) == ["p1/a.csv", "p1/a.csv", "p2/a.csv"]
    # A handler gets one file per batch; names are those below its root.
    handler = features_handler(spark, out, str(tmp_path / "in"), id_column="Listing")
    handler([f"file:{tmp_path}/in/p2/a.csv"], 1)
    assert sorted(r.source_file for r in dump(spark, out).collect()) == ["p1/a.csv", "p1/a.csv", "p2/a.csv"]
    # The root is the folder that is named, not what its files happen to share.
    assert named_root(spark, f"{tmp_path}/in/*") == named_root(spark, f"{tmp_path}/in") == f"{tmp_path}/in"
    assert named_root(spark, [f"{tmp_path}/in/p1/a.csv", f"{tmp_path}/in/p2/*.csv"]) == f"{tmp_path}/in"
    put(tmp_path / "in", "a[1].csv", "x")
    assert named_root(spark, f"{tmp_path}/in/a\\[1\\].csv") == f"{tmp_path}/in"


STEPS = ["write_by_source", "dump_features", "write_model_input", "score", "files_read", "publish"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_fails_changes_no_output(spark, tmp_path, monkeypatch, step):
    feed(tmp_path / "in", "a.csv", "x")
    feed(tmp_path / "in", "b.csv", "x", "y")
    out = str(tmp_path / "out")

    def run(fail=False):
        def score(rows):
            if fail and step == "score":
                raise RuntimeError("stopped")
            return score_constant(rows)

        run_features(spark, str(tmp_path / "in"), out, id_column="Listing", score=score)

    def seen():
        outputs = [read_output(spark, out, name) for name in ("preprocessed", "predictions")]
        outputs.append(read_output(spark, out, "model-input", schema="a string, b string"))
        return [sorted(map(tuple, rows.collect())) for rows in outputs]

    def stopped(*args, **kwargs):
        raise RuntimeError("stopped")

    run()
    before, files = seen(), {str(f) for f in (tmp_path / "out").rglob("part-*")}
    feed(tmp_path / "in", "a.csv", "z", "z")
    if step != "score":
        monkeypatch.setattr(runs if step == "publish" else feature_plan, step, stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        run(fail=True)
    monkeypatch.undo()
    assert seen() == before
    assert {str(f) for f in (tmp_path / "out").rglob("part-*") if "_sources" not in str(f)} == {f for f in files if "_sources" not in f}
    run()
    assert seen() != before and [len(rows) for rows in seen()] == [4, 4, 4]
    assert len(list((tmp_path / "out/preprocessed").glob("run=*/source_file=*"))) == 2  # what was replaced is gone


def test_commits_of_runs(spark, tmp_path):
    out = str(tmp_path / "out")

    def write(rows, sources, **how):
        run = Run(spark, out, ["data"])
        table = spark.createDataFrame(rows, "v string, source_file string")
        sink.write_by_source(table, run.path("data"), header=True)
        return run.commit(spark.createDataFrame([(s,) for s in sources], "source_file string"), **how)

    def seen():
        return sorted(map(tuple, read_output(spark, out, "data").collect()))

    assert current_sources(spark, out).count() == 0
    assert write([("1", "a/b.csv"), ("2", "c%.csv")], ["a/b.csv", "c%.csv"], clean=False) == 1
    assert write([("3", "a/b.csv")], ["a/b.csv"], clean=False) == 2
    assert seen() == [("2", "c%.csv"), ("3", "a/b.csv")]
    assert merge_commits(spark, out) == 3 and len(counting_commits(spark, out)) == 1
    assert write([], ["c%.csv"], clean=False) == 4  # read again, without a row
    assert seen() == [("3", "a/b.csv")]
    remove_superseded(spark, out, ["data"])
    # A number that is taken meanwhile is passed over.
    (tmp_path / "out/_runs" / f"{5:020d}.json").write_text("")  # not written yet
    assert write([("9", "007")], ["007"]) == 6
    assert seen() == [("3", "a/b.csv"), ("9", "007")]
    with pytest.raises(ValueError, match="not one of"):
        Run(spark, out, ["data"]).path("other")


def test_a_column_named_like_the_file_column(spark, tmp_path):
    put(tmp_path, "a.csv", "A,source_file", "1,2")
    with pytest.raises(FileProblem, match="source_file"):
        read_by_header(spark, str(tmp_path))


def test_an_import_reads_one_large_file_in_splits(spark, tmp_path):
    put(tmp_path, "a.csv", "A,B", *[f"{i},b" for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert read_by_header(spark, str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_wrong_header_is_an_error(spark, tmp_path):
    put(tmp_path, "a.csv", "A,B", "1,2")
    put(tmp_path, "b.csv", "B,A", "2,1")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv(spark, str(tmp_path), schema="A string, B string").collect()
    with pytest.raises(FileNotFoundError):
        read_by_header(spark, str(tmp_path), glob="*.none")


def test_quotes_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([('1 "Q" St', "x,y"), ("two\nlines", " s "), ("back\\slash", '"')], "a string, b string")
    sink.write_csv(df, str(tmp_path / "out"), quote_all=True)
    back = read_csv(spark, str(tmp_path / "out"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}


def test_inferred_types_keep_codes(spark, tmp_path):
    put(tmp_path, "a.csv", "Zip Code,n,x", "01234,1,1.5", "00001,2,2.5")
    df = read_inferred(spark, str(tmp_path))
    assert df.dtypes == [("Zip Code", "string"), ("n", "int"), ("x", "double")]
    assert df.first()["Zip Code"] == "01234"


SCHEMA = T.StructType().add("a", "integer").add("b", "string").add("c", "double")
LINES = ["1,x,1.5", "2,y", "z,y,1.5", "3,x,1.5,9", "4,x,bad", "5,z,2.5"]


def test_checked_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "a,b,c", *LINES)
    good, bad = read_checked(spark, str(tmp_path), SCHEMA)
    assert {r.a for r in good.select("a").collect()} == {1, 5} and good.count() == 2
    assert {r.line for r in bad.collect()} == set(LINES[1:5]) and bad.count() == 4


def test_checked_stream(spark, tmp_path):
    put(tmp_path / "in", "a.csv", *LINES)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    args = (spark, str(tmp_path / "in"), SCHEMA, out, bad, str(tmp_path / "check"))
    for _ in range(2):
        append_checked(*args, trigger=ONCE, header=False).awaitTermination()
        assert {r.a for r in spark.read.parquet(out).collect()} == {1, 5}
        assert {(r.source_file, r.line) for r in spark.read.parquet(bad).collect()} == {("a.csv", x) for x in LINES[1:5]}


def test_listing_and_routes(spark, tmp_path):
    for folder, name in [("in", "a-1.csv"), ("in", "A.csv"), ("out", "a-1.csv"), ("in", "a.csv._COPYING_")]:
        put(tmp_path / folder, name, "x")
    files = route_files(list_files(spark, str(tmp_path)), str(tmp_path))
    assert {(r.file_name, r.route) for r in files.collect()} == {
        ("a-1.csv", "IN"),
        ("A.csv", "SKIP"),
        ("a-1.csv", "OUT"),
    }


def test_stream_restart_adds_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "a,b", "1,x", "2,y")
    out = str(tmp_path / "out")

    def run():
        rows = read_csv_stream(spark, str(tmp_path / "in"), "a int, b string")
        append_csv(score_constant(rows), out, str(tmp_path / "check"), trigger=ONCE).awaitTermination()
        return sorted(tuple(r) for r in read_csv(spark, out, schema="a int, b string, p string", header=False).collect())

    assert run() == run() == [(1, "x", "predicted"), (2, "y", "predicted")]
    put(tmp_path / "in", "b.csv", "a,b", "3,z")
    assert run()[-1] == (3, "z", "predicted")


def test_stream_lookup_with_hot_and_missing_keys(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "k,v", *[f"hot,{i}" for i in range(50)], "cold,50", "none,51", ",52")
    static = spark.createDataFrame([("hot", 1), ("cold", 2), ("other", 3)], "k string, x int")
    for name, min_rows in [("split", 10), ("plain", 1000)]:
        append_lookup(
            read_csv_stream(spark, str(tmp_path / "in"), "k string, v int"),
            static,
            ["k"],
            str(tmp_path / name),
            str(tmp_path / f"{name}-check"),
            trigger=ONCE,
            hot_min_rows=min_rows,
        ).awaitTermination()
        got = {(r.k, r.v, r.x) for r in spark.read.parquet(str(tmp_path / name)).collect()}
        assert got == {("hot", i, 1) for i in range(50)} | {("cold", 50, 2), ("none", 51, None), (None, 52, None)}


HEADER = "Listing,Address,Category,Review Sources,Additional Attributes"


def feed(folder, name, *categories):
    put(folder, name, HEADER, *[f"{name}-{i},street,{c},Source:a Source:b,Payment Methods:visa|x" for i, c in enumerate(categories)])


def dump(spark, out):
    rows = read_output(spark, str(out), "preprocessed")
    return rows.select("Listing", "CategoryVector", "source_file", "ReviewSourcesCount", "AA_PM_support_visa")


def test_features_per_file_and_over_all_files(spark, tmp_path):
    feed(tmp_path / "in", "a.csv", "x", "y", "y")
    feed(tmp_path / "in", "b.csv", "x", "x", "z", "")
    run_features(spark, str(tmp_path / "in"), str(tmp_path / "one"), per_file=True, id_column="Listing")
    got = {r.Listing: (r.CategoryVector, r.source_file, r[3], r[4]) for r in dump(spark, tmp_path / "one").collect()}
    assert got["a.csv-0"] == ("2|1|1.0", "a.csv", "2", "1") and got["a.csv-1"] == ("2|0|1.0", "a.csv", "2", "1")
    assert got["b.csv-0"] == ("2|0|1.0", "b.csv", "2", "1") and got["b.csv-3"] == ("2|null|null", "b.csv", "2", "1")

    features = run_features(
        spark, str(tmp_path / "in"), str(tmp_path / "all"), id_column="Listing", score=score_constant
    )
    got = {r.Listing: r.CategoryVector for r in features.collect()}
    assert got["a.csv-0"] == "3|0|1.0" and got["a.csv-1"] == "3|1|1.0" and got["b.csv-2"] == "3|2|1.0"
    plain = (tmp_path / "all/model-input").rglob("part-*.csv")
    lines = [row for path in plain for row in csv.reader(path.open())]
    assert len(lines) == 7 and all(len(row) == len(features.columns) - 1 for row in lines)
    scored = read_output(spark, str(tmp_path / "all"), "predictions")
    assert scored.where("prediction = 'predicted'").count() == 7


def test_watch_gives_each_file_once(spark, tmp_path):
    root, out = tmp_path / "root", tmp_path / "features"
    feed(root / "in", "a-1.csv", "x", "y", "y")
    feed(root / "in", "NOT_READY.csv", "q")
    labels = fit_labels(spark.createDataFrame([("y",), ("y",), ("x",)], "Category string"), "Category")
    seen = []
    handler = features_handler(spark, str(out), str(root / "in"), labels=labels, id_column="Listing")

    def on_in(paths, batch_id):
        seen.extend(path.rsplit("/", 1)[-1] for path in paths)
        handler(paths, batch_id)

    def run():
        watch_files(
            spark, str(root), str(tmp_path / "check"), on_in=on_in, root=str(root), max_files=2, trigger=ONCE
        ).awaitTermination()

    run()
    for name in ("b-1.csv", "b-2.csv", "b-3.csv"):
        feed(root / "in", name, "x", "new")
    run()
    run()
    assert sorted(seen) == ["a-1.csv", "b-1.csv", "b-2.csv", "b-3.csv"]
    got = {r.Listing: r.CategoryVector for r in dump(spark, out).collect()}
    assert got["a-1.csv-0"] == "2|1|1.0" and got["b-3.csv-1"] == "2|null|null" and len(got) == 9
    handler([f"{root}/in/b-1.csv"], 1)
    assert dump(spark, out).count() == 9


def test_a_failing_file_goes_to_quarantine(spark, tmp_path):
    root = tmp_path / "root"
    feed(root / "in", "good.csv", "x")
    put(root / "in", "bad.csv", "no,wanted,column", "1,2,3")
    feed(root / "out", "done.csv", "x")
    options = {"root": str(root), "trigger": ONCE}
    answered = []
    watch_files(
        spark,
        str(root),
        str(tmp_path / "check"),
        on_in=features_handler(spark, str(tmp_path / "features"), str(root / "in"), id_column="Listing"),
        on_out=lambda paths, batch_id: answered.extend(paths),
        quarantine=str(tmp_path / "quarantine"),
        max_files=1,
        **options,
    ).awaitTermination()
    failed = spark.read.json(str(tmp_path / "quarantine")).collect()
    assert [r.path.rsplit("/", 1)[-1] for r in failed] == ["bad.csv"] and "none of the wanted" in failed[0].error
    assert dump(spark, tmp_path / "features").count() == 1
    assert [path.rsplit("/", 1)[-1] for path in answered] == ["done.csv"]


def counting(spark, seen):
    def handle(paths, batch_id):
        seen.append((len(paths), read_by_header(spark, [glob_literal(p) for p in paths], glob=None).where("Listing IS NOT NULL").count()))

    return handle


def test_a_file_that_cannot_be_read_goes_to_quarantine(spark, tmp_path):
    root = tmp_path / "root"
    for i in range(40):
        (root / "in").mkdir(parents=True, exist_ok=True)
        data = gzip.compress("\n".join([HEADER, *[f"{i}-{k},street,x,Source:a,{'y' * 50}" for k in range(300)], ""]).encode())
        (root / "in" / f"f{i:02d}.csv.gz").write_bytes(data[: len(data) // 2] if i == 17 else data)
    seen = []
    watch_files(
        spark, str(root), str(tmp_path / "check"), on_in=counting(spark, seen), quarantine=str(tmp_path / "quarantine"), root=str(root),
        in_pattern=r"/in/.*\.csv\.gz", trigger=ONCE,
    ).awaitTermination()
    failed = spark.read.json(str(tmp_path / "quarantine")).collect()
    assert [r.path.rsplit("/", 1)[-1] for r in failed] == ["f17.csv.gz"]
    assert sum(files for files, _ in seen) == 39 and sum(rows for _, rows in seen) == 39 * 300


def test_a_store_that_cannot_be_read_stops_the_watch(spark, tmp_path, monkeypatch):
    root = tmp_path / "root"
    for name in ("a.csv.gz", "b.csv.gz"):
        (root / "in").mkdir(parents=True, exist_ok=True)
        (root / "in" / name).write_bytes(gzip.compress(HEADER.encode() * 1000)[:-30])
    seen = []

    def watch():
        watch_files(
            spark, str(root), str(tmp_path / "check"), on_in=counting(spark, seen), quarantine=str(tmp_path / "quarantine"), root=str(root),
            in_pattern=r"/in/.*\.csv\.gz", trigger=ONCE,
        ).awaitTermination()

    monkeypatch.setattr(problems, "readable", lambda spark, path: False)
    with pytest.raises(Exception, match="FAILED_READ_FILE|EOFException|Unexpected end"):
        watch()
    assert seen == [] and not (tmp_path / "quarantine").exists()
    assert not list((tmp_path / "check" / "commits").glob("[0-9]*"))
    # The store is back: a restart takes the same files again, and finds that these two are at fault.
    monkeypatch.undo()
    watch()
    assert sorted(r.path.rsplit("/", 1)[-1] for r in spark.read.json(str(tmp_path / "quarantine")).collect()) == ["a.csv.gz", "b.csv.gz"]


def test_bytes_of_a_file(spark, tmp_path):
    put(tmp_path, "a.csv", "x")
    (tmp_path / "empty.csv").write_text("")
    assert problems.readable(spark, f"file:{tmp_path}/a.csv") and problems.readable(spark, str(tmp_path / "empty.csv"))
    assert not problems.readable(spark, str(tmp_path / "gone.csv"))


def test_a_wrong_header_on_a_row_stream(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "a,b", "1,x", "zwei,y", "3")
    put(tmp_path / "in", "b.csv", "b,a", "x,1")
    target = [str(tmp_path / name) for name in ("out", "bad", "check")]
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])

    def run():
        append_files(spark, str(tmp_path / "in"), schema, *target, derive=score_constant, trigger=ONCE).awaitTermination()

    run()
    put(tmp_path / "in", "c.csv", "a,b", "4,later")
    run()
    rows = read_csv(spark, target[0], schema="a int, b string, prediction string, source_file string", header=False)
    assert sorted(r.a for r in rows.collect()) == [1, 4]
    assert [r.path.rsplit("/", 1)[-1] for r in spark.read.json(f"{target[1]}/files").collect()] == ["b.csv"]
    assert sorted(r.line for r in read_csv(spark, f"{target[1]}/rows", schema="line string", header=False).select("line").collect()) == ["3", "zwei,y"]


def test_single_file(spark, tmp_path):
    sink.write_single_csv(spark.range(100).repartition(5), str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    assert read_csv(spark, str(tmp_path / "one")).count() == 100


def watched(spark, tmp_path, handler, files=40):
    """Run a watch over files of which the handler decides; gives the paths per handler call."""
    calls = []

    def on_in(paths, batch_id):
        calls.append(paths)
        handler(paths)

    for i in range(files):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/f{i}.csv").write_text("A\n1\n")
    watch_files(
        spark,
        str(tmp_path),
        str(tmp_path) + "-check",
        on_in=on_in,
        root=str(tmp_path),
        quarantine=str(tmp_path) + "-bad",
        trigger=ONCE,
    ).awaitTermination()
    return calls


def test_one_bad_file_is_found_by_halves(spark, tmp_path):
    def handler(paths):
        if any(path.endswith("/f7.csv") for path in paths):
            raise FileProblem("bad content")

    calls = watched(spark, tmp_path / "w", handler) if (tmp_path / "w").mkdir() is None else None
    assert len(calls) <= 1 + 2 * 6
    assert [r.path.rsplit("/", 1)[-1] for r in spark.read.json(str(tmp_path / "w-bad")).collect()] == ["f7.csv"]
    handled = {path for paths in calls for path in paths}
    assert len(handled) == 40


def test_an_outage_leaves_the_checkpoint(spark, tmp_path):
    root = tmp_path / "w"
    root.mkdir()

    def down(paths):
        raise OSError("the store is down")

    with pytest.raises(Exception, match="store is down"):
        watched(spark, root, down)
    assert not (tmp_path / "w-bad").exists()
    calls = watched(spark, root, lambda paths: None)
    assert sum(map(len, calls)) == 40


def test_writing_by_source_replaces_only_its_sources(spark, tmp_path):
    rows = lambda v: spark.createDataFrame(v, "n int, source_file string")
    sink.write_by_source(rows([(1, "a"), (2, "b/c"), (3, None)]), str(tmp_path))
    sink.write_by_source(rows([(9, "a")]), str(tmp_path))
    got = read_csv(spark, str(tmp_path), schema="n int, source_file string", header=False).collect()
    assert {tuple(r) for r in got} == {(9, "a"), (2, "b/c"), (3, None)}


def test_a_hot_source_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60000).select(
        "id",
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") < 20000, "hot").otherwise(F.format_string("s%02d", F.col("id") % 40)).alias("source_file"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        sink.write_by_source(rows.repartition(16), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {folder.name: len(list(folder.glob("*.csv"))) for folder in tmp_path.glob("source_file=*")}
    assert len(files) == 41 and files["source_file=hot"] > 1 and max(files.values()) < 16
    assert read_csv(spark, str(tmp_path), schema="id long, text string", header=False).count() == 60000


def test_command_line(spark, tmp_path):
    columns = "Listing,Category,Employee Count,sales"
    put(tmp_path / "in", "a.csv", columns, *[f"a{i},{'xy'[i % 2]},{i},{2 * i + 5 * (i % 2)}" for i in range(20)])
    put(tmp_path / "in", "b.csv", "sales,Listing,Category,Employee Count", ",b,y,100", ",c,new,50")
    folder, out, labels, model = (str(tmp_path / name) for name in ("in", "out", "labels", "model"))
    main(["labels", folder, labels])
    numeric = ["--numeric", "Employee Count"]
    main(["train", folder, model, "--labels", labels, *numeric])
    main(["features", folder, out, "--id-column", "Listing", "--labels", labels, "--model", model])
    got = {r.Listing: r for r in read_output(spark, out, "predictions").collect()}
    assert len(got) == 22 and got["a0"].CategoryVector == "3|1|1.0" and got["b"].CategoryVector == "3|0|1.0"
    assert float(got["b"].prediction) == pytest.approx(205.0) and float(got["a4"].prediction) == pytest.approx(8.0)

    main(["take", folder, str(tmp_path / "taken"), "--ledger", str(tmp_path / "ledger"), "--id-column", "Listing", "--labels", labels])
    put(tmp_path / "in", "b.csv", "sales,Listing,Category,Employee Count", ",b2,y,100")
    main(["take", folder, str(tmp_path / "taken"), "--ledger", str(tmp_path / "ledger"), "--id-column", "Listing", "--labels", labels])
    taken = read_output(spark, str(tmp_path / "taken"), "preprocessed").collect()
    assert {r.Listing for r in taken} == {f"a{i}" for i in range(20)} | {"b2"}

    with pytest.raises(FileProblem, match="lacks the columns"):
        main(["import", folder, str(tmp_path / "imported")])
    args = parse(["watch", "hdfs://host/data", "out", "--checkpoint", "c", "--max-files", "5"])
    assert (args.job, args.max_files, args.per_file) == ("watch", 5, False)


def test_delivery_and_what_is_left(spark, tmp_path):
    feed(tmp_path / "in", "a.csv", "x")
    feed(tmp_path / "in", "b c.csv", "x")
    feed(tmp_path / "in", "d.csv", "x")
    features = read_by_header(spark, str(tmp_path / "in")).where("source_file <> 'd.csv'")
    predictions = features.select("source_file", "Listing", F.lit(0.5).alias("prediction"))
    deliver_predictions(features, predictions, ["source_file", "Listing"], str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"))
    assert {(r.source_file, r.prediction) for r in back.collect()} == {("a.csv", "0.5"), ("b c.csv", "0.5")}
    states = undelivered(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert {r.file_name: r.state for r in states} == {"a.csv": "DONE", "b c.csv": "DONE", "d.csv": "MISSING"}


def test_what_is_left_of_files_with_odd_names(spark, tmp_path):
    for folder, name in (("in", "a#b.csv"), ("in", "a%23b.csv"), ("in/sub", "c.csv"), ("in", "d=e.csv"), ("in/x/y", "plain.csv"), ("in", "left.csv")):
        feed(tmp_path / folder, name, "x")
    features = read_by_header(spark, [str(tmp_path / "in"), str(tmp_path / "in/*")], root=str(tmp_path / "in"))
    features = features.unionByName(read_by_header(spark, str(tmp_path / "in/x/y"), root=str(tmp_path / "in"))).where("source_file <> 'left.csv'")
    predictions = features.select("source_file", "Listing", F.lit(0.5).alias("prediction")).distinct()
    deliver_predictions(features, predictions, ["source_file", "Listing"], str(tmp_path / "out"))
    states = {r.file_name: r.state for r in undelivered(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    done = ["a#b.csv", "a%23b.csv", "sub/c.csv", "d=e.csv", "x/y/plain.csv"]
    assert states == {name: "DONE" for name in done} | {"left.csv": "MISSING"}


def test_scratch_is_removed_with_its_scope(spark):
    with scratch_scope(spark):
        staged = stage(spark.range(5))
        assert staged.count() == 5
        [file, *_] = staged.inputFiles()
        folder = Path(urlparse(file).path).parent
        assert folder.exists()
    kept = Path(urlparse(stage(spark.range(5)).inputFiles()[0]).path)
    assert kept.exists() and not folder.exists()

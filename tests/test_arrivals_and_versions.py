"""Mechanisms that keep state: as-of versions, late answers, label epochs, the arrival ledger, replays."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.operators.asof import asof_join
from filefeatures.operators.labels import fit_labels
from filefeatures.plans.replay import Replays, quarantined
from filefeatures.sinks.commits import Overtaken, commits, publish
from filefeatures.streaming.answers import append_parquet, join_answers, watch_answers
from filefeatures.streaming.labels import LabelHistory, append_encoded
from filefeatures.streaming.ledger import Ledger, content_digests, merge_entries
from filefeatures.streaming.rows import append_asof

ONCE = {"availableNow": True}
START = datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


# As-of ---------------------------------------------------------------------------------------------

EVENTS, VERSIONS = "id int, a string, b int, ts timestamp_ntz", "a string, b int, since timestamp_ntz, until timestamp_ntz, v string"


def plain_asof(events, versions):
    out = []
    for id_, a, b, ts in events:
        fitting = [x for x in versions if ts and a is not None and b is not None and x[:2] == (a, b) and x[2] and x[2] <= ts]
        found = max(fitting, key=lambda x: x[2], default=None)
        if found and found[3] and ts >= found[3]:
            found = None
        out.append((id_, a, b, ts, *(found[2:] if found else (None, None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_asof_with_a_hot_key_and_odd_rows(spark, partitions):
    events = [(i, "hot" if i % 3 else f"k{i % 7}", i % 2, at(i * 37 % 500)) for i in range(600)]
    events += [(1000, None, 1, at(5)), (1001, "hot", None, at(5)), (1002, "hot", 1, None), (1003, "none", 1, at(5)), (5, "hot", 1, at(5)), (5, "hot", 1, at(5))]
    versions = [(a, b, at(h), at(h + 30) if h % 60 == 0 else None, f"{a}{b}@{h}") for a in ("hot", "k1", "k3") for b in (0, 1) for h in range(20, 480, 20)]
    versions += [(None, 1, at(0), None, "x"), ("hot", 1, None, None, "y")]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_join(spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, VERSIONS), ["a", "b"], time="ts", valid_from="since", valid_to="until")
        assert sorted(map(tuple, got.collect()), key=str) == plain_asof(events, versions)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_asof_of_empty_tables_and_errors(spark):
    events, versions = spark.createDataFrame([(1, "a", 1, at(1))], EVENTS), spark.createDataFrame([("a", 1, at(0), None, "v")], VERSIONS)
    how = {"time": "ts", "valid_from": "since"}
    assert asof_join(events.where("id = 2"), versions, ["a", "b"], **how).count() == 0
    assert [r.v for r in asof_join(events, versions.where("b = 2"), ["a", "b"], **how).collect()] == [None]
    with pytest.raises(ValueError, match="more than one row"):
        asof_join(events, versions.unionByName(versions), ["a", "b"], **how)
    with pytest.raises(ValueError, match="rename the columns"):
        asof_join(events, versions.withColumn("ID", F.lit(1)), ["a", "b"], **how)


def test_versions_that_are_added_while_a_stream_runs(spark, tmp_path):
    schema = "id int, a string, b int, ts timestamp_ntz"
    versions = [("a", 1, at(0), None, "first")]

    def run(*events):
        spark.createDataFrame(events, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        append_asof(
            stream, lambda: spark.createDataFrame(versions, VERSIONS), ["a", "b"], str(tmp_path / "out"), str(tmp_path / "check"),
            time="ts", valid_from="since", trigger=ONCE,
        ).awaitTermination()

    run((1, "a", 1, at(1)), (2, "a", 1, at(9)))
    versions.append(("a", 1, at(5), None, "second"))
    run((3, "a", 1, at(1)), (4, "a", 1, at(9)))
    got = {r.id: r.v for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "first", 2: "first", 3: "first", 4: "second"}


# Late answers --------------------------------------------------------------------------------------


def stream_of(spark, folder, schema, *batches):
    """A stream that takes the batches one by one."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for j, name in enumerate(sorted((n for n in os.listdir(folder) if n.endswith(".parquet")), key=lambda n: os.path.getmtime(f"{folder}/{n}"))):
            os.utime(f"{folder}/{name}", (1_700_000_000 + 10 * j,) * 2) if i == len(batches) - 1 else None
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_answers_in_time_and_too_late(spark, tmp_path):
    asked = stream_of(spark, str(tmp_path / "in"), "k string, x int, asked timestamp", [("a", 1, at(0)), ("b", 2, at(0)), ("c", 3, at(0)), (None, 4, at(0)), ("a", 5, at(20))], [("end", None, at(900))])
    answers = stream_of(spark, str(tmp_path / "answers"), "k string, p double, answered timestamp", [("a", 0.1, at(1)), ("b", 0.2, at(5)), (None, 0.4, at(1)), ("a", 0.5, at(21))], [("end", None, at(900))])
    joined = join_answers(asked, answers, ["k"], asked_at="asked", answered_at="answered", wait="2 hours", late="30 hours")
    append_parquet(joined, str(tmp_path / "out"), str(tmp_path / "check"), trigger=ONCE).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).where("k <> 'end' OR k IS NULL").collect()
    got = sorted(((r.x, r.k, r.p) for r in rows), key=str)
    assert got == [(1, "a", 0.1), (2, "b", None), (3, "c", None), (4, None, None), (5, "a", 0.5)]
    with pytest.raises(ValueError, match="rename the columns"):
        join_answers(asked, answers.withColumnRenamed("p", "X"), ["k"], asked_at="asked", answered_at="answered")


def test_states_of_files(spark, tmp_path):
    schema = "file_name string, modified timestamp"
    came = stream_of(spark, str(tmp_path / "in"), schema, [("a", at(0)), ("a", at(1)), ("b", at(0)), ("c", at(5)), (None, at(0))], [("end in", at(900))])
    gone = stream_of(spark, str(tmp_path / "out"), schema, [("a", at(2)), ("c", at(1)), ("b", at(30)), ("d", at(3)), ("d", at(4))], [("end out", at(900))])
    states = watch_answers(came, gone, deadline="12 hours", late="40 hours")
    append_parquet(states, str(tmp_path / "states"), str(tmp_path / "check"), trigger=ONCE).awaitTermination()
    got = sorted((r.file_name, r.state) for r in spark.read.parquet(str(tmp_path / "states")).collect())
    assert got == [("a", "DONE"), ("b", "MISSING"), ("b", "STRAY"), ("c", "DONE"), ("d", "STRAY")]


# Labels --------------------------------------------------------------------------------------------


def labels_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def test_labels_keep_their_index_within_an_epoch(spark, tmp_path):
    history = LabelHistory(spark, str(tmp_path))
    assert history.model() is None and history.last() is None
    with pytest.raises(ValueError, match="no labels"):
        history.rerank()

    def state():
        return sorted(((r.label, r.idx, r.n, r.rows) for r in history.model().table.collect()), key=str)

    history.add(labels_of(spark, "b", "b", "a", None, ""), "c", 0)
    first = [("", 1, 3, 1), ("a", 2, 3, 1), ("b", 0, 3, 2), (None, None, 3, 1)]
    assert state() == sorted(first, key=str)
    for _ in range(2):  # a repeated batch is counted once
        history.add(labels_of(spark, "z", "y", "z", "a", "a", "a", None), "c", 1, one_window_labels=1)
    second = [("", 1, 5, 1), ("a", 2, 5, 4), ("b", 0, 5, 2), (None, None, 5, 2), ("z", 3, 5, 2), ("y", 4, 5, 1)]
    assert state() == sorted(second, key=str)
    history.add(labels_of(spark), "c", 2)
    assert state() == sorted(second, key=str) and history.last()["epoch"] == 0
    assert history.rerank() == 1
    everything = fit_labels(labels_of(spark, "b", "b", "a", None, "", "z", "y", "z", "a", "a", "a", None), "c")
    assert state() == sorted(((r.label, r.idx, r.n, r.rows) for r in everything.table.collect()), key=str)
    history.add(labels_of(spark, "new"), "c", 3)
    assert ("new", 5, 6, 1) in state() and history.last()["epoch"] == 1


def test_labels_that_follow_a_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    history = LabelHistory(spark, str(tmp_path / "labels"))
    for values in (["x", "x", "y"], ["z", "z", "z", "y"]):
        labels_of(spark, *values).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("c string").parquet(folder)
        append_encoded(stream, "c", "v", history, str(tmp_path / "out"), str(tmp_path / "check"), trigger=ONCE).awaitTermination()
    got = {(r.batch_id, r.c, r.v, r.label_epoch) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(0, "x", "2|0|1.0", 0), (0, "y", "2|1|1.0", 0), (1, "z", "3|2|1.0", 0), (1, "y", "3|1|1.0", 0)}


def test_a_log_of_commits(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert commits(spark, folder) == []
    assert [publish(spark, folder, {"x": i}) for i in range(3)] == [1, 2, 3]
    assert publish(spark, folder, {"x": 9}, after=3) == 4
    with pytest.raises(Overtaken):
        publish(spark, folder, {"x": 10}, after=3)
    assert [c["x"] for c in commits(spark, folder)] == [0, 1, 2, 9]
    assert not [n for n in os.listdir(folder) if not n.endswith(".json") and not n.endswith(".crc")]


# Ledger --------------------------------------------------------------------------------------------


def upload(folder, name, *lines, when=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))
    if when:
        os.utime(folder / name, (when, when))


def test_a_replaced_file_is_taken_again_and_a_repeated_one_is_not(spark, tmp_path):
    folder, ledger, seen = tmp_path / "in", Ledger(spark, str(tmp_path / "ledger")), []

    def take(fail=False):
        def handle(paths, number):
            if fail:
                raise RuntimeError("stopped")
            seen.append((number, [path.rsplit("/", 1)[-1] for path in paths]))

        return ledger.take(str(folder), handle)

    assert take() == 0 if folder.exists() else True
    upload(folder, "a b.csv", "x", "1", when=1000)
    upload(folder, "c%20.csv", "x", "2", when=1000)
    with pytest.raises(RuntimeError):
        take(fail=True)
    assert take() == 2 and take() == 0
    upload(folder, "a b.csv", "x", "3", when=2000)  # as long as before
    upload(folder, "c%20.csv", "x", "2", when=2000)  # the same again
    upload(folder / "sub", "d.csv", "x", when=2000)
    upload(folder, "e.txt", "x", when=2000)
    assert take() == 2 and take() == 0
    upload(folder, "a b.csv", "x", "1", when=3000)  # back to the first content: other than the last
    assert take() == 1
    assert seen == [(1, ["a b.csv", "c%20.csv"]), (2, ["a b.csv", "d.csv"]), (3, ["a b.csv"])]
    last = {r.path.rsplit("/", 1)[-1]: r.version for r in merge_entries(ledger.entries()).collect()}
    assert last == {"a b.csv": 3, "c%20.csv": 1, "d.csv": 1}
    assert ledger.versions().count() == 5


def test_digests_do_not_follow_the_splits(spark, tmp_path):
    upload(tmp_path, "a.csv", *[f"{i},{i * i}" for i in range(500)])
    upload(tmp_path, "b.csv", *[f"{i},{i * i}" for i in reversed(range(500))])
    upload(tmp_path, "c.csv", *[f"{i},{i * i}" for i in range(499)], "0,0")
    paths = [str(tmp_path / name) for name in ("a.csv", "b.csv", "c.csv")]
    whole = dict((r.path[-5:], r.digest) for r in content_digests(spark, paths).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        assert whole == dict((r.path[-5:], r.digest) for r in content_digests(spark, paths).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole["a.csv"] == whole["b.csv"] != whole["c.csv"]


# Replays -------------------------------------------------------------------------------------------


def test_repaired_rows_go_through_once(spark, tmp_path):
    schema = T.StructType([T.StructField("a b", T.IntegerType()), T.StructField("c", T.StringType())])
    bad = [("f", "x,1"), ("f", "x,1"), ("g", "x,1"), ("f", "1"), (None, "2,y,z"), ("g", None)]
    quarantine = quarantined(spark.createDataFrame(bad, "source_file string, line string"))
    ids = {(r.source_file, r.line): r.id for r in quarantine.collect()}
    assert len(ids) == 5 and {r.copies for r in quarantine.where("line = 'x,1' AND source_file = 'f'").collect()} == {2}
    replays = Replays(spark, str(tmp_path))
    assert replays.rows() is None

    def replay(*repairs, job=lambda rows: rows):
        table = spark.createDataFrame([(ids.get(key, "unknown"), line) for key, line in repairs], "id string, line string")
        return sorted(r.line or "" for r in replays.replay(quarantine, table, schema, job).collect())

    def rows():
        return sorted(map(tuple, replays.rows().collect()), key=str)

    once = [(("f", "x,1"), '1,"x, ""1"""'), (("g", "x,1"), "still,broken"), (("f", "1"), "1"), (("h", "no"), "1,1")]
    assert replay(*once) == ["1", "still,broken"]
    want = [(1, 'x, "1"', "f"), (1, 'x, "1"', "f")]
    assert rows() == want
    assert replay(*once) == ["1", "still,broken"] and rows() == want

    def stopped(rows):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        replay((("g", "x,1"), "5,ok"), job=stopped)
    assert rows() == want
    replay((("g", "x,1"), "5,ok"), (("f", "x,1"), "9,changed too late"), (("", "2,y,z"), "2,"))
    assert rows() == sorted([*want, (5, "ok", "g"), (2, None, "")], key=str)
    with pytest.raises(ValueError, match="more than one row"):
        replay((("f", "1"), "1,1"), (("f", "1"), "2,2"))

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from filefeatures.operators.delivery import join_predictions, reconcile
from filefeatures.operators.effects import score_effects, train_effects
from filefeatures.operators.labels import encode, fit_and_encode, fit_labels, load_labels
from filefeatures.operators.lookup import hot_keys, hot_part, key_part, lookup
from filefeatures.operators.scoring import score_constant, score_linear
from filefeatures.operators.select import derive_if_present, match_columns, select_strict, select_wanted
from filefeatures.operators.types import measure_types, merge_types, typed
from filefeatures.plans.features import LISTING_DERIVATIONS, listing_features, score_target, train_on_target

SF = "/root/testdata/sf0.001"


def rows(spark, values, schema="Category string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def vectors(df, column="Category", out="v"):
    return {(r[column], r[out]) for r in df.collect()}


def test_wanted_columns_in_wanted_order(spark):
    assert list(match_columns(["A", "B", "C"], ["B", "C", "D"])) == ["B", "C"]
    assert match_columns(["zip code", "ZIP CODE", "x.y"], ["Zip Code", "ZIP CODE"]) == {
        "Zip Code": "zip code",
        "ZIP CODE": "ZIP CODE",
    }
    df = spark.createDataFrame([(1, 2, 3)], "`b.c` int, A int, `8 Digit SIC ( Source1 )` int")
    assert select_wanted(df, ["8 Digit SIC ( Source1 )", "a", "b.c"]).first().asDict() == {
        "8 Digit SIC ( Source1 )": 3,
        "a": 2,
        "b.c": 1,
    }
    with pytest.raises(ValueError, match="none of the wanted"):
        select_wanted(df, ["D"])


def test_strict_select_fails_on_a_missing_column(spark):
    with pytest.raises(AnalysisException):
        select_strict(spark.range(1), ["id", "Address"]).collect()


def test_derivations_follow_the_columns(spark):
    df = spark.createDataFrame([("Source:a", "x")], "`Review Sources` string, Address string")
    derived, new = derive_if_present(df, LISTING_DERIVATIONS)
    assert new == ["ReviewSourcesCount"] and derived.first().ReviewSourcesCount == 1
    assert listing_features(df).columns == ["Address", "Review Sources", "ReviewSourcesCount"]


def test_one_hot_text(spark):
    got = vectors(fit_and_encode(rows(spark, ["b", "b", "a", "c", None, "a", "d"]), "Category", "v"))
    assert got == {
        ("a", "4|0|1.0"),
        ("b", "4|1|1.0"),
        ("c", "4|2|1.0"),
        ("d", "4|3|1.0"),
        (None, "4|null|null"),
    }


def test_empty_and_all_null_categories(spark):
    assert vectors(fit_and_encode(rows(spark, ["", "", "a"]), "Category", "v")) == {("", "2|0|1.0"), ("a", "2|1|1.0")}
    assert vectors(fit_and_encode(rows(spark, [None, None]), "Category", "v")) == {(None, "0|null|null")}
    assert vectors(fit_and_encode(rows(spark, []), "Category", "v")) == set()


def test_long_labels(spark):
    long = ["x" * 5000 + "1", "x" * 5000 + "2", "n", "vn", "sha256:"]
    got = vectors(fit_and_encode(rows(spark, [*long, long[1]]), "Category", "v"))
    assert got == {(label, f"5|{i}|1.0") for i, label in enumerate([long[1], "n", "sha256:", "vn", long[0]])}


@pytest.mark.parametrize(("table", "column"), [("part", "p_brand"), ("documents", "source"), ("events", "user_id")])
def test_one_hot_text_equals_ml(spark, table, column):
    df = spark.read.parquet(f"{SF}/{table}.parquet").select(F.col(column).cast("string").alias("c"))
    indexed = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    encoder = OneHotEncoder(inputCol="i", outputCol="vec").fit(indexed)
    expected = {(r.c, f"{r.vec.size}|{r.vec.indices[0]}|{r.vec.values[0]}") for r in encoder.transform(indexed).collect()}
    assert vectors(fit_and_encode(df, "c", "v"), "c") == expected


def skewed(spark):
    """A third of the rows holds one label, a third is NULL, the rest are many small labels."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") < 1000, "hot")
        .when(F.col("id") < 2000, None)
        .otherwise(F.concat(F.lit("label-"), F.expr("cast(sqrt(id) * 70 as int)").cast("string")))
        .alias("c"),
        F.when(F.col("id") % 3 > 0, "g1").when(F.col("id") % 7 > 0, "g2").alias("g"),
    )


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranges_give_the_same_ranks(spark, groups):
    df = skewed(spark)
    one = fit_labels(df, "c", groups=groups).table
    many = fit_labels(df, "c", groups=groups, one_window_labels=20).table
    assert one.count() == many.count() > 200
    assert one.exceptAll(many.select(one.columns)).count() == 0
    assert one.dtypes == many.dtypes


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_split_lookup_gives_the_same_rows(spark, groups):
    df = skewed(spark)
    whole = fit_and_encode(df, "c", "v", groups=groups)
    split = fit_and_encode(df, "c", "v", groups=groups, broadcast_labels=0, hot_share=0.01)
    assert whole.count() == split.count() == 3000
    assert whole.exceptAll(split).count() == 0


def test_split_lookup_with_an_unseen_hot_label(spark):
    df = skewed(spark)
    model = fit_labels(df.where("c <> 'hot'"), "c")
    whole = encode(df, model, "c", "v")
    split = encode(df, model, "c", "v", broadcast_labels=0, hot_share=0.01, hot_min_rows=100)
    assert whole.where("c = 'hot' AND v LIKE '%|null|null'").count() == 1000
    assert whole.exceptAll(split).count() == split.exceptAll(whole).count() == 0


def test_hot_keys(spark):
    keyed = skewed(spark).select(key_part(F.col("c")).alias("k"))
    assert {r.k for r in hot_keys(keyed, ["k"], min_rows=500).collect()} == {"n", "vhot"}
    assert hot_keys(keyed, ["k"]) is None
    dim = keyed.distinct().withColumn("x", F.length("k"))
    hot = hot_part(dim, hot_keys(keyed, ["k"], min_rows=500), ["k"])
    plain, split = lookup(keyed, dim, ["k"], None), lookup(keyed, dim, ["k"], hot)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    wide = lookup(keyed, dim, ["k"], hot, broadcast_bytes=1)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (split, wide)]
    assert "_hot" in plans[0] and "_hot" not in plans[1]
    assert plans[0].count("Range (0, 3000") == plans[1].count("Range (0, 3000")  # the rows are read once
    assert plain.exceptAll(wide).count() == wide.exceptAll(plain).count() == 0


def test_small_label_table_needs_no_shuffle_of_the_rows(spark):
    df = spark.read.parquet(f"{SF}/part.parquet")
    plan = fit_and_encode(df, "p_brand", "v")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stored_labels(spark, tmp_path):
    df = rows(spark, ["b", "b", "a"])
    fit_labels(df, "Category").save(str(tmp_path / "labels"))
    model = load_labels(spark, str(tmp_path / "labels"))
    assert (model.labels, model.fact_rows) == (2, 3)
    new = rows(spark, ["a", "new", None])
    assert vectors(encode(new, model, "Category", "v")) == {("a", "2|1|1.0"), ("new", "2|null|null"), (None, "2|null|null")}


def test_scores(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 2)], "a double, b int")
    assert [r.prediction for r in score_linear(df, {"a": 2.0, "b": 0.5}, 1.0).collect()] == [4.0, None]
    assert {r.prediction for r in score_constant(df).collect()} == {"predicted"}


def test_train_and_score_on_the_target(spark, tmp_path):
    data = [(str(n), c, str(3.0 * n + (10.0 if c == "b" else 0.0))) for n in range(20) for c in ("a", "b")]
    data += [("5", "a", None), ("x", "a", "1"), ("5", None, None), ("5", "new", None)]
    features = spark.createDataFrame(data, "`Employee Count` string, Category string, sales string")
    labels = fit_labels(features.where("sales IS NOT NULL"), "Category")
    train_on_target(features, labels, ["Employee Count"], str(tmp_path / "model"))
    scored = score_target(features, str(tmp_path / "model"))
    assert scored.count() == len(data)
    known = {(r["Employee Count"], r.Category): r.prediction for r in scored.collect()}
    assert known[("5", "a")] == pytest.approx(15.0) and known[("5", "b")] == pytest.approx(25.0)
    assert ("5", None) in known and known[("5", "new")] == known[("5", None)]
    assert known[("x", "a")] is None  # the text stays, and there is no prediction


def test_null_is_a_category_of_its_own(spark, tmp_path):
    data = [(str(n), c, str(3.0 * n + (10.0 if c == "b" else 0.0))) for n in range(20) for c in ("a", "b")]
    nulls = [(str(n), None, str(3.0 * n + 4.0)) for n in range(20)]
    schema = "`Employee Count` string, Category string, sales string"
    for name, rows_ in (("without", data), ("with", data + nulls)):
        features = spark.createDataFrame(rows_, schema)
        labels = fit_labels(features, "Category")
        model = train_on_target(features, labels, ["Employee Count"], str(tmp_path / name))
        assert model.slopes == {"Employee Count": pytest.approx(3.0)} and model.categories == 2
        scored = score_target(features, str(tmp_path / name))
        assert scored.where("abs(prediction - cast(sales as double)) > 1e-9").count() == 0
        # Without rows of NULL their constant is the mean of all rows' constants.
        assert model.other == pytest.approx({"without": 5.0, "with": 4.0}[name])


def plain_effects(rows, numbers):
    """Least squares with one indicator per category, by numpy."""
    names = sorted({c for c, *_ in rows}, key=str)
    x = np.array([[*values[:numbers], *[float(c == name) for name in names]] for c, *values in rows])
    found = np.linalg.lstsq(x, np.array([values[-1] for _, *values in rows]), rcond=None)[0]
    return found[:numbers], dict(zip(names, found[numbers:], strict=True))


def test_absorbed_categories_equal_indicators(spark):
    draw = np.random.default_rng(1)
    rows = [(c, float(a), float(b), float(2 * a - b + i % 7 + draw.normal())) for i, (c, a, b) in enumerate(
        (f"c{k % 40}" if k % 9 else None, draw.normal(k % 5), draw.normal()) for k in range(600))]
    df = spark.createDataFrame(rows, "c string, a double, b double, y double").repartition(5)
    slopes, constants = plain_effects(rows, 2)
    model = train_effects(df, "y", ["a", "b"], "c")
    assert list(model.slopes.values()) == pytest.approx(list(slopes))
    assert {r.category: r.constant for r in model.constants.collect()} == pytest.approx({c: v for c, v in constants.items() if c})
    assert model.other == pytest.approx(constants[None])
    want = {(c, a): slopes[0] * a + slopes[1] * b + constants[c] for c, a, b, _ in rows}
    for limits in ({}, {"broadcast_labels": 1, "hot_min_rows": 1, "hot_share": 0.02}):
        scored = score_effects(df, model, **limits).collect()
        assert {(r.c, r.a): r.prediction for r in scored} == pytest.approx(want)


def test_numbers_that_say_nothing_have_no_slope(spark):
    rows = [("a", 1.0, 2.0, 5.0), ("a", 2.0, 2.0, 7.0), ("b", 1.0, 3.0, 1.0), ("b", 4.0, 3.0, 7.0)]
    df = spark.createDataFrame(rows, "c string, x double, fixed double, y double")
    model = train_effects(df, "y", ["x", "fixed"], "c")
    assert model.slopes == {"x": pytest.approx(2.0), "fixed": 0.0}
    assert abs(train_effects(df, "y", ["x", "fixed"], "c", reg_param=1.0).slopes["x"]) < 2.0
    with pytest.raises(ValueError, match="no row"):
        train_effects(df.where("y < 0"), "y", ["x"], "c")


def test_types_that_lose_nothing(spark):
    rows = [
        ("01234", "7", "1.50", "0.1", "true", "2024-01-31", "2024-01-31 10:00:00", "1", None, "9999999999", "1", "-0"),
        ("7", "-8", "12.25", "1.0E10", "false", "2023-12-01", "2024-01-31 10:00:00.5", "2.5", None, "1", "x", "0"),
        (None, None, "0.00", None, None, None, None, None, None, None, None, None),
    ]
    names = ["zip", "int", "fixed", "real", "truth", "day", "moment", "mixed", "empty", "long", "text", "minus"]
    df = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names))
    want = ["string", "int", "decimal(4,2)", "double", "boolean", "date", "timestamp_ntz", "string", "string", "bigint", "string", "string"]
    assert typed(df).dtypes == list(zip(names, want, strict=True))
    back = typed(df).select([F.col(name).cast("string") for name in names]).collect()
    assert [tuple(r) for r in back] == rows
    assert dict(typed(df, keep_text=["INT"]).dtypes)["int"] == "string"
    # Measurements of parts merge into that of the whole.
    parts = [measure_types(df.where(c)) for c in ("zip = '7'", "zip <> '7'", "zip IS NULL")]
    merged = merge_types(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert typed(df, measured=merged).dtypes == typed(df).dtypes
    assert typed(df.where("zip = 'none'")).dtypes == [(name, "string") for name in names]


def test_group_columns_with_odd_names(spark):
    df = spark.createDataFrame([("g1", "a"), ("g1", "a"), ("g2", "b")], "`a.b` string, c string")
    assert {r.v for r in fit_and_encode(df, "c", "v", groups=["a.b"]).collect()} == {"1|0|1.0"}
    assert {r.v for r in fit_and_encode(df, "c", "v", groups=["a.b"], one_window_labels=1).collect()} == {"1|0|1.0"}
    with pytest.raises(ValueError, match="rename"):
        fit_labels(df.withColumnRenamed("a.b", "rows"), "c", groups=["rows"])


def test_repeated_prediction_keys_are_an_error(spark):
    features = spark.createDataFrame([(1, "x"), (2, "y")], "id int, f string")
    twice = spark.createDataFrame([(1, 0.5), (1, 0.7)], "id int, prediction double")
    with pytest.raises(ValueError, match="more than one row"):
        join_predictions(features, twice, ["id"])
    once = join_predictions(features, twice.limit(1), ["id"])
    assert once.count() == 2


def test_reconcile(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "file_name string")
    got = {r.file_name: r.state for r in reconcile(names("a", "b", "b"), names("b", "c")).collect()}
    assert got == {"a": "MISSING", "b": "DONE", "c": "STRAY"}

import uuid

import pytest
from pyspark.sql import functions as F

from filefeatures.contracts import IMPORT_COLUMNS, IN_PATTERN, OUT_PATTERN, PAYMENT_METHODS, wanted_columns
from filefeatures.functions.paths import decoded, file_route, plain_path, without_scheme
from filefeatures.functions.text import (
    keyword_flags,
    labelled_number,
    last_path_segment,
    literal_pattern,
    marker_count,
)


def evaluate(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("t"))).collect()]


def test_marker_count(spark):
    texts = [None, "", "Source:", "Source:a Source:b", "source:"]
    assert evaluate(spark, texts, lambda c: marker_count(c, "Source:")) == [None, 0, 1, 2, 0]


def test_marker_is_literal_unless_asked(spark):
    texts = ["a.b.c", "axb"]
    assert evaluate(spark, texts, lambda c: marker_count(c, ".")) == [2, 0]
    assert evaluate(spark, texts, lambda c: marker_count(c, "[ab]", regex=True)) == [2, 2]


def test_marker_count_is_split_size_minus_one(spark):
    texts = ["", "aaa", "aaaa", "baab", "é<li>ü<li>", None]
    for marker in ("aa", "<li>"):
        split = evaluate(spark, texts, lambda c: F.when(c.isNotNull(), F.size(F.split(c, marker)) - 1))
        assert evaluate(spark, texts, lambda c: marker_count(c, marker)) == split


def test_literal_pattern_with_quote_end(spark):
    assert evaluate(spark, ["x\\Ey", "xy"], lambda c: c.rlike("^" + literal_pattern("x\\Ey") + "$")) == [True, False]


def test_labelled_number(spark):
    texts = ["Likes:12 Likes:34", "Likes:1,234", "Likes: 5", "likes:5", "", None, "Likes:99999999999"]
    texts += ["Likes:99999999999999999999", "Likes: Likes:7"]
    assert evaluate(spark, texts, lambda c: labelled_number(c, "Likes:")) == [
        12, 1, None, None, None, None, 99999999999, None, 7,
    ]


def flags(spark, text, **options):
    rows = spark.createDataFrame([(text,)], "t string")
    columns = keyword_flags(F.col("t"), "Payment Methods:", PAYMENT_METHODS, prefix="", **options)
    return {k for k, v in rows.select(*[c.alias(n) for n, c in columns.items()]).first().asDict().items() if v == 1}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Payment Methods:visa,mastercard|Parking:cash", {"visa", "master"}),
        ("Payment Methods:Visa", set()),
        ("Payment Methods:checkout", {"check"}),
        (None, set()),
        ("", set()),
        ("visa", set()),
        ("Payment Methods:|Payment Methods: amex\ncash|debit", {"amex", "cash"}),
        ("Payment Methods:visa Payment Methods:debit", {"visa", "debit"}),
    ],
)
def test_keyword_flags(spark, text, expected):
    assert flags(spark, text) == expected
    rows = spark.createDataFrame([(text,)], "t string")
    pattern = "(Payment Methods:)[^\\|]{{0,}}({})"
    extracted = rows.select(
        *[(F.regexp_extract("t", pattern.format(m), 2) == m).alias(m) for m in PAYMENT_METHODS]
    ).first()
    assert {m for m in PAYMENT_METHODS if extracted[m]} == expected


def test_keyword_flag_options(spark):
    assert flags(spark, "Payment Methods:Visa,checkout", ignore_case=True) == {"visa", "check"}
    assert flags(spark, "Payment Methods:visa,checkout", whole_word=True) == {"visa"}
    with pytest.raises(ValueError):
        keyword_flags(F.col("t"), "x", ["a|b"], prefix="")


def test_last_path_segment(spark):
    assert evaluate(spark, ["/a/b.csv", "b.csv", "/a/", None], last_path_segment) == ["b.csv", "", "", None]


ROUTES = {
    "/in/aaaaaa-bbbb-1234-5678.csv": "IN",
    "/out/aaaaaa-bbbb-1234-5678.csv": "OUT",
    "/in/new_file_name_to_process.csv": "SKIP",
    "/in/ABC.csv": "SKIP",
    "/in/a.csv._COPYING_": "SKIP",
    "/in/sub/a.csv": "SKIP",
    "/in/4.txt": "SKIP",
    "/in/a.csv\n": "SKIP",
    "/x/in/a.csv": "SKIP",
    "test": "SKIP",
}


def test_file_route(spark):
    assert evaluate(spark, list(ROUTES), file_route) == list(ROUTES.values())
    name = uuid.uuid4()
    assert evaluate(spark, [f"/in/{name}.csv", f"/out/{name}.csv"], file_route) == ["IN", "OUT"]
    own = evaluate(spark, ["/data/A.csv"], lambda c: file_route(c, in_pattern="/data/.*", out_pattern=OUT_PATTERN))
    assert own == ["IN"] and IN_PATTERN != OUT_PATTERN


def test_paths(spark):
    uris = ["hdfs://host:9000/in/a.csv", "file:/in/a.csv", "file:///in/a.csv", "/in/a.csv"]
    assert evaluate(spark, uris, plain_path) == ["/in/a.csv"] * 4
    assert [without_scheme(uri) for uri in uris] == ["/in/a.csv"] * 4
    assert evaluate(spark, ["file:/tmp/x/in/a.csv"], lambda c: plain_path(c, "/tmp/x/")) == ["/in/a.csv"]
    assert evaluate(spark, ["a%20b+c%2520.csv"], decoded) == ["a b+c%20.csv"]


def test_vocabularies():
    assert len(wanted_columns("ID")) == len(set(wanted_columns("ID"))) == 97
    assert len(IMPORT_COLUMNS) == len(set(IMPORT_COLUMNS)) == 48

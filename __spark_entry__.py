"""

Every query runs over whole tables. Queries about files first write the table as files of the kind the
operator reads, into a new scratch folder per call.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from itertools import islice, permutations
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from filefeatures import contracts
from filefeatures.functions.paths import file_route, without_scheme
from filefeatures.functions.text import keyword_flags, labelled_number, last_path_segment, marker_count
from filefeatures.operators.asof import asof_join
from filefeatures.operators.delivery import join_predictions, reconcile
from filefeatures.operators.effects import train_effects
from filefeatures.operators.labels import (
    encode,
    fit_and_encode,
    fit_labels,
    register_one_hot_text,
    with_label_index,
)
from filefeatures.operators.scoring import score_constant, score_linear, train_linear
from filefeatures.operators.select import (
    Derivation,
    add_constant,
    derive_if_present,
    select_strict,
    select_wanted,
)
from filefeatures.plans.delivery import deliver_predictions
from filefeatures.plans.features import (
    derive_and_project,
    features_handler,
    run_features,
    score_target,
    train_on_target,
)
from filefeatures.plans.importer import run_import
from filefeatures.plans.replay import Replays, quarantined
from filefeatures.session import scratch_folder, ship_package, stage
from filefeatures.sinks.csv import write_by_source, write_csv, write_single_csv
from filefeatures.sinks.runs import Run, read_output
from filefeatures.sources.csv import glob_literal, read_by_header, read_checked, read_csv, read_inferred
from filefeatures.streaming.answers import append_parquet, join_answers, watch_answers
from filefeatures.streaming.arrivals import watch_files
from filefeatures.streaming.ledger import Ledger
from filefeatures.streaming.labels import LabelHistory, append_encoded
from filefeatures.streaming.rows import append_asof, append_csv, append_lookup, read_csv_stream

try:  # the corpus operators and their pipeline are optional; nothing else needs them
    import corpus_pipeline
    from filefeatures.llm import queries as corpus_queries

    CORPUS = [corpus_queries, corpus_pipeline]
except ModuleNotFoundError:  # the package, or a module that only it needs
    CORPUS = []

Query = Callable[[SparkSession, str], DataFrame]

TITLE_WORDS = ["the", "der", "que", "and", "des", "und", "los"]
ONCE = {"availableNow": True}
LISTINGS_PER_PART = 20_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text-derived columns ------------------------------------------------------------------------------


def q_marker_count(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", marker_count(F.col("html"), "<li>").alias("list_items"))


def q_labeled_number(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", labelled_number(F.col("props"), '"k": ').alias("k"))


def _title_flags(html: Column) -> dict[str, Column]:
    return keyword_flags(html, "<title>", TITLE_WORDS, prefix="title_has_", delimiter="<")


def q_labeled_keyword_flags(spark, sf_dir):
    return _table(spark, sf_dir, "pages").withColumns(_title_flags(F.col("html"))).drop("url", "html")


def q_last_path_segment(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", last_path_segment(F.col("url")).alias("segment"))


def q_file_route(spark, sf_dir):
    """One path per document, in a form that depends on its language: ready, answered, and two to skip."""
    doc = F.col("doc_id").cast("string")
    path = (
        F.when(F.col("lang") == "en", F.concat(F.lit("/in/doc-"), doc, F.lit(".csv")))
        .when(F.col("lang") == "fr", F.concat(F.lit("/out/doc-"), doc, F.lit(".csv")))
        .when(F.col("lang") == "de", F.concat(F.lit("/in/DOC-"), doc, F.lit(".csv")))
        .otherwise(F.concat(F.lit("/in/doc-"), doc, F.lit(".csv._COPYING_")))
    )
    paths = _table(spark, sf_dir, "documents").select("doc_id", path.alias("path"))
    return paths.withColumn("route", file_route(F.col("path")))


# Projections ---------------------------------------------------------------------------------------


def q_intersect_select(spark, sf_dir):
    return select_wanted(
        _table(spark, sf_dir, "customer"), ["c_mktsegment", "C_NAME", "c_phone", "c_custkey", "c_comment"]
    )


def q_strict_select(spark, sf_dir):
    return select_strict(_table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey", "o_orderpriority"])


def q_constant_column(spark, sf_dir):
    return add_constant(_table(spark, sf_dir, "orders"), "purchase_complete", 1)


def q_guarded_derive(spark, sf_dir):
    derived, _ = derive_if_present(
        _table(spark, sf_dir, "events"),
        [
            Derivation("props", lambda c: {"k": labelled_number(c, '"k": ')}),
            Derivation("profile", lambda c: {"likes": labelled_number(c, "Likes:")}),
        ],
    )
    return derived


# Category encoding ---------------------------------------------------------------------------------


def q_frequency_index(spark, sf_dir):
    return fit_labels(_table(spark, sf_dir, "part"), "p_brand").table.select("label", "idx", "rows")


def q_one_hot_string(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return fit_and_encode(part, "p_brand", "brand_vector")


def q_one_hot_null_keep(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return fit_and_encode(events, "event_type", "type_vector")


def _lang_source(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.concat_ws("/", "lang", "source").alias("category"))


def q_encode_unseen(spark, sf_dir):
    """Fit on the documents that have labels, apply to all."""
    documents = _lang_source(_table(spark, sf_dir, "documents"))
    labelled = documents.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return encode(documents, fit_labels(labelled, "category"), "category", "category_vector")


def q_encode_per_group(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return fit_and_encode(documents, "source", "source_vector", groups=["lang"])


def q_encode_many_labels(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return fit_and_encode(orders, "o_custkey", "customer_vector")


def q_rank_by_ranges(spark, sf_dir):
    """Ranking range by range, as for more labels than one window takes."""
    orders = _table(spark, sf_dir, "orders").select("o_custkey")
    return fit_labels(orders, "o_custkey", one_window_labels=1000).table.select("label", "idx", "rows")


def q_encode_split_join(spark, sf_dir):
    """Hot labels from a broadcast and the rest by a shuffle, as for a label table that is too large to broadcast."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    limits = {"broadcast_labels": 10, "hot_share": 1 / 2000, "hot_min_rows": 100}
    return fit_and_encode(orders, "o_custkey", "customer_vector", one_window_labels=1000, **limits)


def q_one_hot_named_function(spark, sf_dir):
    """The text form called by the name it is registered under."""
    register_one_hot_text(spark)
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
    indexed = with_label_index(part, fit_labels(part, "p_type"), "p_type", fitted_here=True)
    vector = F.call_function("one_hot_text", F.col("_n"), F.col("_idx"))
    return indexed.select("p_partkey", "p_type", vector.alias("type_vector"))


# CSV in and out ------------------------------------------------------------------------------------


def q_csv_quoted_multiline(spark, sf_dir):
    documents, folder = _table(spark, sf_dir, "documents"), scratch_folder(spark, "csv")
    write_csv(documents, folder, quote_all=True)
    return read_csv(spark, folder, schema=documents.schema)


def _write_lines(spark, lines, header, files, folder):
    """Lines (file, value) as text, one folder per file, each with its header first: the same for all, or one per file."""
    if isinstance(header, str):
        header = spark.range(files).select(F.col("id").alias("file"), F.lit(header).alias("value"))
    every = header.withColumn("order", F.lit(0)).unionByName(lines.withColumn("order", F.lit(1)))
    every.repartition("file").sortWithinPartitions("file", "order").drop("order").write.partitionBy("file").text(folder)


def q_csv_stray_quotes(spark, sf_dir):
    """Quotes inside unquoted values, and line breaks inside quoted ones, in the same files."""
    documents, folder = _table(spark, sf_dir, "documents"), scratch_folder(spark, "csv")
    key, files = F.col("doc_id").cast("string"), 8
    line = F.concat(key, F.lit(',5" '), F.col("lang"), F.lit(',"line one\n'), F.col("source"), F.lit('"'))
    _write_lines(spark, documents.select(F.pmod("doc_id", F.lit(files)).alias("file"), line.alias("value")), "id,size,note", files, folder)
    return read_by_header(spark, f"{folder}/*", glob="*.txt").select("id", "size", "note")


def q_csv_folder_glob(spark, sf_dir):
    customer, folder = _table(spark, sf_dir, "customer"), scratch_folder(spark, "csv")
    write_csv(customer, folder)
    customer.write.mode("append").json(folder)
    return read_csv(spark, folder, schema=customer.schema, multiline=False)


def q_csv_mixed_headers(spark, sf_dir):
    customer, folder = _table(spark, sf_dir, "customer"), scratch_folder(spark, "csv")
    variants = [
        (0, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
        (1, ["c_mktsegment", "c_acctbal", "c_name", "c_custkey", "c_nationkey"]),
        (2, ["c_nationkey", "c_custkey", "c_mktsegment", "c_name"]),
    ]
    layout = F.when(F.col("c_mktsegment") == "FURNITURE", 1).when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"), 2)
    for number, columns in variants:
        write_csv(customer.where(F.coalesce(layout, F.lit(0)) == number).select(columns), folder, mode="append")
    rows = read_by_header(spark, folder)
    return rows.select([F.col(field.name).cast(field.dataType) for field in customer.schema])


def q_csv_many_layouts(spark, sf_dir):
    """A thousand layouts: all orders of the columns, and some orders of all but one of them."""
    orders, folder = _table(spark, sf_dir, "orders"), scratch_folder(spark, "csv")
    names, layouts = orders.columns, list(permutations(range(6)))
    for number in range(1000 - len(layouts)):
        some = [i for i in range(6) if i != number % 6]
        layouts.append(next(islice(permutations(some), number // 6, None)))
    rows = [(file, list(places), ",".join(names[i] for i in places)) for file, places in enumerate(layouts)]
    table = spark.createDataFrame(rows, "file long, places array<int>, value string")
    values = F.array(*[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]).alias("values")
    lines = orders.select(F.pmod("o_orderkey", F.lit(1000)).alias("file"), values).join(F.broadcast(table), "file")
    line = F.array_join(F.transform("places", lambda place: F.get("values", place)), ",").alias("value")
    _write_lines(spark, lines.select("file", line), table.select("file", "value"), 1000, folder)
    rows = read_by_header(spark, f"{folder}/*", glob="*.txt")
    return rows.select([F.col(field.name).cast(field.dataType) for field in orders.schema])


def q_csv_inferred_codes(spark, sf_dir):
    """Types without a list of columns that must stay text: codes with leading zeros do."""
    part, folder = _table(spark, sf_dir, "part"), scratch_folder(spark, "csv")
    code, half = F.format_string("%05d", "p_partkey").alias("code"), (F.col("p_size") / 2).alias("half")
    write_csv(part.select("p_partkey", code, "p_size", half, (F.col("p_size") > 9).alias("large")), folder)
    return read_inferred(spark, folder)


def q_csv_inferred(spark, sf_dir):
    folder = scratch_folder(spark, "csv")
    write_csv(_table(spark, sf_dir, "part"), folder)
    return read_inferred(spark, folder, keep_text=["p_size"], multiline=False)


def q_csv_partitioned_by_source(spark, sf_dir):
    documents, folder = _table(spark, sf_dir, "documents"), scratch_folder(spark, "csv")
    write_by_source(documents, folder, by="source")
    rows = read_csv(spark, folder, schema=documents.schema, header=False)
    return rows.select(documents.columns)


def q_quarantine_bad_rows(spark, sf_dir):
    """Each event as a line; "error" events get a wrong type, "signup" events lose their last columns."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    folder = scratch_folder(spark, "csv")
    key, kind, value = (F.col(name).cast("string") for name in events.columns)
    line = (
        F.when(F.col("event_type") == "error", F.concat_ws(",", key, kind, F.lit("broken")))
        .when(F.col("event_type") == "signup", F.concat_ws(",", key, kind))
        .otherwise(F.concat_ws(",", key, kind, value))
    )
    events.select(line.alias("value")).write.text(folder)
    good, bad = read_checked(spark, folder, events.schema, header=False, multiline=False, glob="*.txt")
    return good.select(
        "event_id", "event_type", "value", F.lit(None).cast("string").alias("bad_line")
    ).unionByName(bad.select(F.col("line").alias("bad_line")), allowMissingColumns=True)


# Streams -------------------------------------------------------------------------------------------


def q_stream_constant_prediction(spark, sf_dir):
    events, root = _table(spark, sf_dir, "events"), scratch_folder(spark, "stream")
    write_csv(events, f"{root}/in")
    rows = read_csv_stream(spark, f"{root}/in", events.schema, multiline=False)
    append_csv(score_constant(rows), f"{root}/out", f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    schema = T.StructType([*events.schema.fields, T.StructField("prediction", T.StringType())])
    return read_csv(spark, f"{root}/out", schema=schema, header=False, multiline=False)


def q_stream_per_file_features(spark, sf_dir):
    """Pages arrive as files; each batch of files becomes features with labels fitted before."""
    pages, root = _table(spark, sf_dir, "pages"), scratch_folder(spark, "stream")
    files = spark.sparkContext.defaultParallelism
    write_csv(pages.repartition(files), f"{root}/in", quote_all=True)
    labels = fit_labels(pages.select(_page_language(F.col("html")).alias("category")), "category")

    def handle(paths, batch_id):
        rows = read_by_header(spark, [glob_literal(path) for path in paths], glob=None)
        features = encode(_page_features(rows, [contracts.SOURCE_FILE]), labels, "category", "category_vector")
        (
            features.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(contracts.SOURCE_FILE)
            .parquet(f"{root}/features")
        )

    watch_files(
        spark,
        root,
        f"{root}-checkpoint",
        on_in=handle,
        root=root,
        max_files=max(1, files // 2),
        trigger=ONCE,
    ).awaitTermination()
    features = spark.read.parquet(f"{root}/features").drop(contracts.SOURCE_FILE)
    return features.withColumn("page_id", F.col("page_id").cast("bigint"))


def _stream_listing_features(spark, root, listings, labels):
    """The files in `root/in` through the job for arriving files; its dump, read back."""
    handler = features_handler(spark, f"{root}/out", root=without_scheme(f"{root}/in"), labels=labels, id_column="Listing ID")
    watch_files(spark, root, f"{root}-checkpoint", on_in=handler, root=without_scheme(root), max_files=2, trigger=ONCE).awaitTermination()
    rows = read_output(spark, f"{root}/out", "preprocessed").drop(contracts.SOURCE_FILE)
    return rows.select([F.col(f"`{name}`").alias(name.lower().replace(" ", "_")) for name in rows.columns])


def q_stream_listing_features(spark, sf_dir):
    """The whole feature job on each batch of arriving files, with stored labels."""
    listings, root = _listings(spark, sf_dir), scratch_folder(spark, "stream")
    write_csv(listings.repartition(4), f"{root}/in", quote_all=True)
    labels = fit_labels(listings, "Category").save(scratch_folder(spark, "labels"))
    return _stream_listing_features(spark, root, listings, labels)


def q_stream_listing_features_per_file(spark, sf_dir):
    """The same without stored labels: each arriving file is ranked alone."""
    listings, root = _listings(spark, sf_dir), scratch_folder(spark, "stream")
    for file in range(4):
        own = listings.where(F.col("`Zip Code`").cast("int") % 4 == file)
        write_csv(own.coalesce(1), f"{root}/in", quote_all=True, mode="append")
    return _stream_listing_features(spark, root, listings, None)


def q_stream_static_join(spark, sf_dir):
    return _stream_lookup(spark, sf_dir)


def q_stream_hot_keys(spark, sf_dir):
    """The same with hot keys answered from a broadcast, as for large batches."""
    return _stream_lookup(spark, sf_dir, hot_min_rows=10)


def _stream_lookup(spark, sf_dir, **limits):
    events, root = _table(spark, sf_dir, "events"), scratch_folder(spark, "stream")
    write_csv(events, f"{root}/in")
    rows = read_csv_stream(spark, f"{root}/in", events.schema, multiline=False)
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    append_lookup(
        rows, customer, ["user_id"], f"{root}/out", f"{root}/checkpoint", trigger=ONCE, **limits
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def _customer_versions(spark, sf_dir):
    """Four versions of every customer, hours and days apart; every third version of a customer ends before the next."""
    customer = _table(spark, sf_dir, "customer")
    start = F.expr("timestamp_ntz'2023-12-30 00:00:00' + make_dt_interval(v * 9, int(c_custkey % 50 * 5))")
    number = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("v")
    rows = customer.select(F.col("c_custkey").alias("user_id"), "c_custkey", "c_mktsegment", "c_acctbal", number)
    end = F.when(F.col("v") % 3 == 2, F.expr("valid_from + interval '3' day")).alias("valid_to")
    segment = F.concat_ws("-", "c_mktsegment", F.col("v").cast("string")).alias("segment")
    return rows.withColumn("valid_from", start).select("user_id", "valid_from", end, segment, (F.col("c_acctbal") + F.col("v")).alias("balance"))


def q_events_asof_customer(spark, sf_dir):
    """Every event with the customer's version of its time."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return asof_join(events, _customer_versions(spark, sf_dir), ["user_id"], time="ts", valid_from="valid_from", valid_to="valid_to")


def q_stream_events_asof(spark, sf_dir):
    """The same on a stream of files, batch by batch."""
    events, root = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value"), scratch_folder(spark, "asof")
    events.repartition(4).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    versions = _customer_versions(spark, sf_dir)
    how = {"time": "ts", "valid_from": "valid_from", "valid_to": "valid_to", "trigger": ONCE}
    append_asof(stream, lambda: versions, ["user_id"], f"{root}/out", f"{root}/checkpoint", **how).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def q_stream_label_epochs(spark, sf_dir):
    """Orders by customer in four batches, each by a restarted stream: indices stay, counts are those of all orders."""
    orders, root = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), scratch_folder(spark, "epochs")
    history = LabelHistory(spark, f"{root}/labels")
    for part in range(4):
        orders.where(F.pmod("o_orderkey", F.lit(4)) == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(orders.schema).parquet(f"{root}/in")
        append_encoded(stream, "o_custkey", "vector", history, f"{root}/out", f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    return history.model().table.select("label", "idx", "n", "rows")


def q_predictions_stream_join(spark, sf_dir):
    """Every document with its label, which comes up to an hour later on a stream of its own, in other files.

    A last row on each stream, a year later, says that all others have come.
    """
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    root = scratch_folder(spark, "answers")
    start = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(doc_id % 100))")
    asked = documents.select("doc_id", "lang", "source", "n_chars", start.alias("asked_at"))
    later = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(doc_id % 100 + doc_id % 61))")
    answers = labels.select("doc_id", F.col("quality").alias("prediction"), later.alias("answered_at"))
    end = spark.sql("SELECT -1L AS doc_id, timestamp'2025-01-01 00:00:00' AS at")
    last = [end.withColumnRenamed("at", "asked_at"), end.withColumnRenamed("at", "answered_at")]
    streams = []
    for name, rows, closing in zip(["in", "answers"], [asked, answers], last, strict=True):
        rows.repartition(3).unionByName(closing, allowMissingColumns=True).write.parquet(f"{root}/{name}")
        streams.append(spark.readStream.schema(rows.schema).parquet(f"{root}/{name}"))
    joined = join_answers(*streams, ["doc_id"], asked_at="asked_at", answered_at="answered_at", wait="1 hour", late="2 hours")
    append_parquet(joined, f"{root}/out", f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    return spark.read.parquet(f"{root}/out").where("doc_id >= 0").select("doc_id", "lang", "source", "n_chars", "prediction")


# Scoring and delivery ------------------------------------------------------------------------------


def q_score_linear(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return score_linear(lineitem, {"l_quantity": 0.25, "l_discount": -3.5, "l_tax": 1.75}, 0.5).select(
        "l_orderkey", "l_linenumber", "prediction"
    )


def q_train_linear(spark, sf_dir):
    """Weights of a price model, to four decimals."""
    model = train_linear(_table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_quantity"])
    line = model.stages[-1]

    def rounded(value: float) -> Column:
        return F.floor(F.lit(float(value)) * 10000 + 0.5) / 10000

    return spark.range(1).select(
        rounded(line.intercept).alias("intercept"), rounded(line.coefficients[0]).alias("quantity_weight")
    )


def _sales_model(spark, sf_dir):
    """A model of the balance by nation number and segment, stored; with what it was fitted on."""
    listings = _listings(spark, sf_dir).select(
        "Listing ID", "Category", F.col("`Zip Code`").alias("Employee Count"), F.col("sales").cast("string").alias("sales")
    )
    labels, folder = fit_labels(listings, "Category"), scratch_folder(spark, "model")
    model = train_on_target(listings, labels, ["Employee Count"], folder)
    return listings, folder, model


def q_train_linear_category(spark, sf_dir):
    """The weight of each segment against that of a missing one, to three decimals."""
    model = _sales_model(spark, sf_dir)[-1]
    weight = F.col("constant") - F.lit(model.other)
    return model.constants.select("category", (F.floor(weight * 1000 + 0.5) / 1000).alias("weight"))


def q_train_linear_many_categories(spark, sf_dir):
    """The price by order date and customer: a constant for each customer, to two decimals, and the slope."""
    orders = _table(spark, sf_dir, "orders")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01")).alias("day")
    model = train_effects(orders.select("o_totalprice", "o_custkey", day), "o_totalprice", ["day"], "o_custkey")
    rounded = (F.floor(F.col("constant") * 100 + 0.5) / 100).alias("constant")
    slope = F.floor(F.lit(model.slopes["day"]) * 10000 + 0.5) / 10000
    return model.constants.select("category", rounded, "rows", slope.alias("slope"))


def q_score_stored_model(spark, sf_dir):
    """Every listing scored with a stored model; the feature values stay as they are."""
    listings, folder, _ = _sales_model(spark, sf_dir)
    scored = score_target(listings, folder)
    return scored.select(
        F.col("`Listing ID`").alias("listing_id"),
        F.col("`Employee Count`").alias("employee_count"),
        "sales",
        (F.floor(F.col("prediction") * 1000 + 0.5) / 1000).alias("prediction"),
    )


def q_predictions_join(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    predictions = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("prediction"))
    return join_predictions(documents, predictions, ["doc_id"])


def q_predictions_delivery(spark, sf_dir):
    """Predictions for the labelled documents, written to one folder per source and read back."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("prediction"))
    predictions = labels.join(documents.select("source", "doc_id"), "doc_id")
    out = scratch_folder(spark, "out")
    delivered = deliver_predictions(documents, predictions, ["source", "doc_id"], out, by="source")
    rows = read_csv(spark, out, schema="doc_id long, lang string, n_chars long, prediction int, source string")
    return rows.select(delivered.columns)


def q_in_out_reconcile(spark, sf_dir):
    """Documents came in, with or without an answer; for every label there is also an answer that nobody asked for."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return reconcile(_file_names(documents), _file_names(labels).unionByName(_file_names(labels, "lost")))


def q_stream_in_out_reconcile(spark, sf_dir):
    """The same from two streams: answers come before or after their file, and the streams end far behind the deadline."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    root = scratch_folder(spark, "watch")
    at = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(doc_id % 500))").alias("modified")
    answered = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, int(doc_id % 31) - 10, int(doc_id % 500))").alias("modified")
    sides = {
        "in": _file_names(documents, extra=at),
        "out": _file_names(labels, extra=answered).unionByName(_file_names(labels, "lost", extra=answered)),
    }
    streams = []
    for side, rows in sides.items():
        closing = spark.createDataFrame([(f"end of {side}",)], "file_name string").withColumn("modified", F.expr("timestamp'2025-01-01 00:00:00'"))
        rows.repartition(3).unionByName(closing).write.parquet(f"{root}/{side}")
        streams.append(spark.readStream.schema(rows.schema).parquet(f"{root}/{side}"))
    states = watch_answers(*streams, deadline="1 day", late="3 days")
    append_parquet(states, f"{root}/states", f"{root}/checkpoint", trigger=ONCE).awaitTermination()
    return spark.read.parquet(f"{root}/states").where("file_name NOT LIKE 'end of %'").select("file_name", "state")


def _file_names(rows: DataFrame, kind: str = "doc", extra: Column | None = None) -> DataFrame:
    return rows.select(F.format_string(f"{kind}-%d.csv", "doc_id").alias("file_name"), *([] if extra is None else [extra]))


def _put_file(spark, rows, path):
    """Rows as one CSV file of this name, over one that is there."""
    folder = scratch_folder(spark, "upload")
    write_single_csv(rows, folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    [part] = [status.getPath() for status in store.globStatus(hadoop.Path(f"{folder}/part-*.csv"))]
    target = hadoop.Path(path)
    store.mkdirs(target.getParent())
    store.delete(target, False)
    store.rename(part, target)


def q_arrivals_reuploaded(spark, sf_dir):
    """Customers in files. One file comes again with other rows, one as it was, one is new; then nothing has changed."""
    customer, root = _table(spark, sf_dir, "customer"), scratch_folder(spark, "arrivals")
    rows = customer.select("c_custkey", "c_name", "c_acctbal")
    part, ledger, folder = F.pmod("c_custkey", F.lit(4)), Ledger(spark, f"{root}/ledger"), f"{root}/in"

    def handle(paths, number):
        run = Run(spark, f"{root}/out", ["rows"])
        found = read_by_header(spark, [glob_literal(path) for path in paths], glob=None, root=without_scheme(folder))
        write_by_source(found, run.path("rows"), header=True)
        run.commit(found.select(contracts.SOURCE_FILE).distinct())

    for file in range(3):
        _put_file(spark, rows.where(part == file), f"{folder}/f{file}.csv")
    ledger.take(folder, handle)
    _put_file(spark, rows.where(part == 1).withColumn("c_acctbal", F.col("c_acctbal") + 1), f"{folder}/f1.csv")
    _put_file(spark, rows.where(part == 2), f"{folder}/f2.csv")
    _put_file(spark, rows.where(part == 3), f"{folder}/f3.csv")
    ledger.take(folder, handle)
    ledger.take(folder, handle)
    versions = ledger.versions().groupBy(F.regexp_extract("path", "[^/]*$", 0).alias(contracts.SOURCE_FILE)).agg(F.max("version").alias("version"))
    seen = read_output(spark, f"{root}/out", "rows").join(versions, contracts.SOURCE_FILE)
    return seen.select(F.col("c_custkey").cast("long"), "c_name", F.col("c_acctbal").cast("double"), "version", contracts.SOURCE_FILE)


def q_replay_repaired_rows(spark, sf_dir):
    """Events as lines, some broken; the repaired ones are replayed twice, in two halves that overlap."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    root = scratch_folder(spark, "replay")
    right = F.concat_ws(",", *[F.col(name).cast("string") for name in events.columns])
    line = F.when(F.col("event_type") == "error", F.concat(right, F.lit(",more"))).when(
        F.col("event_type") == "signup", F.concat_ws(",", F.col("event_id").cast("string"), "event_type")
    ).otherwise(right)
    events.select(line.alias("value")).write.text(f"{root}/in")
    good, bad = read_checked(spark, f"{root}/in", events.schema, header=False, multiline=False, glob="*.txt")
    quarantine = stage(quarantined(bad))
    by_id = F.regexp_extract("line", "^([0-9]+)", 1).cast("long")
    repairs = quarantine.select("id", by_id.alias("event_id")).join(events.select("event_id", right.alias("line")), "event_id")
    replays = Replays(spark, f"{root}/replays")
    for some in ("event_id % 3 > 0", "event_id % 3 < 2", "event_id IS NOT NULL"):
        replays.replay(quarantine, repairs.where(some).select("id", "line"), events.schema)
    return good.unionByName(replays.rows()).select(events.columns)


# Whole jobs ----------------------------------------------------------------------------------------


def _page_language(html: Column) -> Column:
    return F.regexp_extract(html, 'lang="([a-z]+)"', 1)


PAGE_DERIVATIONS = [
    Derivation("url", lambda c: {"segment": last_path_segment(c), "page_number": labelled_number(c, "page=")}),
    Derivation(
        "html",
        lambda c: {"list_items": marker_count(c, "<li>"), **_title_flags(c), "category": _page_language(c)},
    ),
    Derivation("author", lambda c: {"author_posts": labelled_number(c, "Posts:")}),
]


def _page_features(pages: DataFrame, keep: list[str]) -> DataFrame:
    return derive_and_project(pages, ["page_id", "url", "author"], PAGE_DERIVATIONS, keep)


def q_features_job(spark, sf_dir):
    """Flagship: derive, project, stage once, fit labels, encode, score."""
    features = stage(_page_features(_table(spark, sf_dir, "pages"), []))
    encoded = fit_and_encode(features, "category", "category_vector")
    return score_linear(encoded, {"list_items": 0.25, "title_has_the": 1.5, "title_has_der": -2.0}, 0.5)


def _spread(table: DataFrame) -> DataFrame:
    """The rows in parts of some thousands, however the table is stored: what is made of them grows far beyond the table,
    and is written as files of moderate size by all cores."""
    parts = 1 + table.count() // LISTINGS_PER_PART
    return table.repartition(parts) if parts > 1 else table


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a listing feed, with the text columns the features are read from."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return _spread(_table(spark, sf_dir, "customer")).select(
        F.col("c_name").alias("Listing ID"),
        F.concat(F.lit('1 "Q" St,\nflat '), nation.cast("string")).alias("Address"),
        F.format_string("%05d", nation).alias("Zip Code"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("Category"),
        F.expr("repeat('Source:site ', c_nationkey)").alias("Review Sources"),
        F.concat(F.lit("Likes:"), (key * 7).cast("string"), F.lit(" Likes:1")).alias("Facebook Profile"),
        F.concat(F.lit("Followers:"), key.cast("string"), F.lit(" Following:1,234 Tweets: 5")).alias(
            "Twitter Profile"
        ),
        F.concat(
            F.lit("Payment Methods:"),
            F.when(nation < 10, "visa,mastercard").when(nation < 20, "cash,checkout").otherwise("Visa"),
            F.lit("|Parking:amex"),
        ).alias("Additional Attributes"),
        F.col("c_acctbal").alias("sales"),
    )


def q_listing_features_job(spark, sf_dir):
    """The feed in files of two layouts -> the whole feature job -> its dump, read back."""
    listings, root = _listings(spark, sf_dir), scratch_folder(spark, "listings")
    with_category = listings.where("Category IS NOT NULL")
    write_csv(with_category, f"{root}/in", quote_all=True)
    write_csv(
        listings.where("Category IS NULL").select(sorted(listings.columns, reverse=True)),
        f"{root}/in",
        quote_all=True,
        mode="append",
    )
    run_features(spark, f"{root}/in", f"{root}/out", id_column="Listing ID")
    # The folder of a dump is named after its input file; within a folder the columns are those of the job.
    rows = read_output(spark, f"{root}/out", "preprocessed").drop(contracts.SOURCE_FILE)
    return rows.select([F.col(f"`{name}`").alias(name.lower().replace(" ", "_")) for name in rows.columns])


def q_features_same_name_two_folders(spark, sf_dir):
    """Two folders whose files have the same names: none replaces another."""
    listings, root = _listings(spark, sf_dir), scratch_folder(spark, "listings")
    half = (F.col("`Zip Code`").cast("int") % 2).alias("half")
    options = {**contracts.CSV_OPTIONS, "header": True, "quoteAll": True}
    listings.select("*", half).write.options(**options).partitionBy("half").csv(f"{root}/in")
    run_features(spark, f"{root}/in/*", f"{root}/out", id_column="Listing ID")
    rows = read_output(spark, f"{root}/out", "preprocessed").drop(contracts.SOURCE_FILE)
    return rows.select([F.col(f"`{name}`").alias(name.lower().replace(" ", "_")) for name in rows.columns])


def q_features_two_runs_one_output(spark, sf_dir):
    """Two folders with files of the same names, one after the other into one output; the second of them twice."""
    listings, root = _listings(spark, sf_dir), scratch_folder(spark, "listings")
    half = (F.col("`Zip Code`").cast("int") % 2).alias("half")
    options = {**contracts.CSV_OPTIONS, "header": True, "quoteAll": True}
    listings.select("*", half).write.options(**options).partitionBy("half").csv(f"{root}/in")
    labels = fit_labels(listings, "Category")
    for part in (0, 1, 1):
        how = {"labels": labels, "id_column": "Listing ID", "root": without_scheme(f"{root}/in")}
        run_features(spark, f"{root}/in/half={part}", f"{root}/out", **how)
    rows = read_output(spark, f"{root}/out", "preprocessed").drop(contracts.SOURCE_FILE)
    return rows.select([F.col(f"`{name}`").alias(name.lower().replace(" ", "_")) for name in rows.columns])


def q_features_with_bad_rows(spark, sf_dir):
    """Rows with a value too many or some too few go to the job's bad rows, the others through it."""
    listings, root = _listings(spark, sf_dir), scratch_folder(spark, "listings")
    names = ["Listing ID", "Zip Code", "Category"]
    values = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in names]
    nation = F.col("`Zip Code`").cast("int")
    line = (
        F.when(nation < 5, F.concat_ws(",", *values, F.lit("more")))
        .when(nation < 10, values[0])
        .otherwise(F.concat_ws(",", *values))
    )
    file = F.pmod(F.xxhash64("Listing ID"), F.lit(8))
    _write_lines(spark, listings.select(file.alias("file"), line.alias("value")), ",".join(names), 8, f"{root}/in")
    run_features(spark, f"{root}/in/*", f"{root}/out", id_column="Listing ID", glob="*.txt")
    good = read_output(spark, f"{root}/out", "preprocessed").select(
        F.col("`Listing ID`").alias("listing_id"), F.col("`Zip Code`").alias("zip_code"), F.col("CategoryVector").alias("vector")
    )
    bad = read_output(spark, f"{root}/out", "bad-rows", schema="bad_line string").select("bad_line")
    return good.unionByName(bad, allowMissingColumns=True)


def _import_feed(spark, sf_dir):
    """The importer's 48 columns, each with values of its own."""
    listings = _listings(spark, sf_dir)
    filled = listings.withColumns({"Full Category Set": F.col("Category"), "Likes Count": F.length("Review Sources")})
    missing = {
        name: F.concat(F.lit(f"{name} "), F.col("Listing ID")) for name in contracts.IMPORT_COLUMNS if name not in filled.columns
    }
    return filled.withColumns(missing)


def _imported(spark, root):
    rows = run_import(spark, f"{root}/in", f"{root}/out")
    return rows.select([F.col(f"`{name}`").alias(name.lower().replace(" ", "_")) for name in rows.columns])


def q_listing_import_job(spark, sf_dir):
    root = scratch_folder(spark, "import")
    write_csv(_import_feed(spark, sf_dir), f"{root}/in", quote_all=True)
    return _imported(spark, root)


def q_import_mixed_headers(spark, sf_dir):
    """The same feed in files whose columns have opposite orders."""
    feed, root = _import_feed(spark, sf_dir), scratch_folder(spark, "import")
    even = F.crc32(F.col("Listing ID").cast("binary")) % 2 == 0
    write_csv(feed.where(even), f"{root}/in", quote_all=True)
    write_csv(feed.where(~even).select([f"`{c}`" for c in reversed(feed.columns)]), f"{root}/in", quote_all=True, mode="append")
    return _imported(spark, root)


def queries() -> dict[str, Query]:
    own = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return own | {name: _shipped(query) for module in CORPUS for name, query in module.queries().items()}


def _shipped(query: Query) -> Query:
    """The corpus operators run Python in the tasks, which must find this package there."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    return q_features_job(spark, "/root/testdata/sf0.001")


# Oracles -------------------------------------------------------------------------------------------


def _title_flag_sql(column: str) -> str:
    return ", ".join(
        f"CAST(regexp_matches({column}, '<title>[^<]*{word}') AS INTEGER) AS title_has_{word}" for word in TITLE_WORDS
    )


def _ranked_sql(relation: str, column: str) -> str:
    return f"""ranked AS (
      SELECT {column} AS label, count(*) AS n_rows,
             CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INTEGER) AS idx
      FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column})"""


VECTOR_SQL = """concat((SELECT count(*) FROM ranked), '|', coalesce(CAST(idx AS VARCHAR), 'null'), '|',
        CASE WHEN idx IS NULL THEN 'null' ELSE '1.0' END)"""

PAGE_FEATURES_SQL = f"""
    SELECT page_id, url,
           regexp_extract(url, '/([^/]*)$', 1) AS segment,
           TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS BIGINT) AS page_number,
           CAST(len(string_split(html, '<li>')) - 1 AS INTEGER) AS list_items,
           {_title_flag_sql("html")},
           regexp_extract(html, 'lang="([a-z]+)"', 1) AS category
    FROM pages"""

PAGE_COLUMNS_SQL = "page_id, url, segment, page_number, list_items, category, " + ", ".join(
    f"title_has_{word}" for word in TITLE_WORDS
)

PAGE_ENCODED_SQL = f"""
    WITH features AS ({PAGE_FEATURES_SQL}), {_ranked_sql("features", "category")}
    SELECT {PAGE_COLUMNS_SQL}, {VECTOR_SQL} AS category_vector
    FROM features LEFT JOIN ranked ON category = label"""

LISTINGS_SQL = """
    SELECT c_name AS listing_id,
           concat('1 "Q" St,', chr(10), 'flat ', c_nationkey) AS address,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code,
           nullif(c_mktsegment, 'MACHINERY') AS category,
           nullif(repeat('Source:site ', c_nationkey), '') AS review_sources,
           c_nationkey, c_custkey, c_acctbal
    FROM customer"""

EVENT_COLUMNS_SQL = "event_id, ts, user_id, event_type, value, props"


LISTING_FEATURES_SQL = f"""
            WITH listings AS ({LISTINGS_SQL}), {_ranked_sql("listings", "category")}
            SELECT listing_id, address, zip_code, category, review_sources, CAST(c_acctbal AS VARCHAR) AS sales,
                   CAST(len(string_split(review_sources, 'Source:')) - 1 AS VARCHAR) AS reviewsourcescount,
                   CAST(c_custkey * 7 AS VARCHAR) AS facebooklikescount,
                   CAST(c_custkey AS VARCHAR) AS twitterfollowerscount,
                   '1' AS twitterfollowingcount, CAST(NULL AS VARCHAR) AS twittertweetscount,
                   CASE WHEN c_nationkey < 10 THEN '1' ELSE '0' END AS aa_pm_support_visa,
                   CASE WHEN c_nationkey < 10 THEN '1' ELSE '0' END AS aa_pm_support_master,
                   CASE WHEN c_nationkey BETWEEN 10 AND 19 THEN '1' ELSE '0' END AS aa_pm_support_cash,
                   '0' AS aa_pm_support_debit,
                   CASE WHEN c_nationkey BETWEEN 10 AND 19 THEN '1' ELSE '0' END AS aa_pm_support_check,
                   '0' AS aa_pm_support_amex, '0' AS aa_pm_support_financing,
                   {VECTOR_SQL} AS categoryvector
            FROM listings LEFT JOIN ranked ON category = label"""

# Each quarter of the nations is a file of its own.
PER_FILE_VECTOR_SQL = """concat(labels, '|', coalesce(CAST(idx AS VARCHAR), 'null'), '|',
        CASE WHEN idx IS NULL THEN 'null' ELSE '1.0' END)"""

LISTING_FEATURES_PER_FILE_SQL = f"""
            WITH listings AS ({LISTINGS_SQL}), ranked AS (
      SELECT c_nationkey % 4 AS file, category AS label,
             count(category) OVER (PARTITION BY c_nationkey % 4) AS labels,
             CASE WHEN category IS NOT NULL THEN row_number() OVER (
               PARTITION BY c_nationkey % 4 ORDER BY category IS NULL, count(*) DESC, category) - 1 END AS idx
      FROM listings GROUP BY c_nationkey % 4, category)
            SELECT listing_id, address, zip_code, category, review_sources, CAST(c_acctbal AS VARCHAR) AS sales,
                   CAST(len(string_split(review_sources, 'Source:')) - 1 AS VARCHAR) AS reviewsourcescount,
                   CAST(c_custkey * 7 AS VARCHAR) AS facebooklikescount,
                   CAST(c_custkey AS VARCHAR) AS twitterfollowerscount,
                   '1' AS twitterfollowingcount, CAST(NULL AS VARCHAR) AS twittertweetscount,
                   CASE WHEN c_nationkey < 10 THEN '1' ELSE '0' END AS aa_pm_support_visa,
                   CASE WHEN c_nationkey < 10 THEN '1' ELSE '0' END AS aa_pm_support_master,
                   CASE WHEN c_nationkey BETWEEN 10 AND 19 THEN '1' ELSE '0' END AS aa_pm_support_cash,
                   '0' AS aa_pm_support_debit,
                   CASE WHEN c_nationkey BETWEEN 10 AND 19 THEN '1' ELSE '0' END AS aa_pm_support_check,
                   '0' AS aa_pm_support_amex, '0' AS aa_pm_support_financing,
                   {PER_FILE_VECTOR_SQL} AS categoryvector
            FROM listings JOIN ranked ON category IS NOT DISTINCT FROM label AND c_nationkey % 4 = file"""

# Least squares with one constant per segment: the slope within the segments, then each one's mean.
SALES_MODEL_SQL = f"""
    WITH rows AS (SELECT *, CAST(c_acctbal AS VARCHAR) AS sales FROM ({LISTINGS_SQL})),
         means AS (SELECT category, avg(c_nationkey) AS x, avg(c_acctbal) AS y FROM rows GROUP BY category),
         slopes AS (
           SELECT sum((c_nationkey - x) * (c_acctbal - y)) / sum((c_nationkey - x) * (c_nationkey - x)) AS slope
           FROM rows JOIN means ON rows.category IS NOT DISTINCT FROM means.category),
         model AS (SELECT category, slope, y - slope * x AS constant FROM means, slopes)"""


# Columns of the import that are not the feed's name followed by the listing's.
IMPORT_VALUES_SQL = {
    "Address": "address",
    "Zip Code": "zip_code",
    "Category": "category",
    "Full Category Set": "category",
    "Likes Count": "CAST(c_nationkey * 12 AS INTEGER)",
    "Facebook Profile": "concat('Likes:', c_custkey * 7, ' Likes:1')",
    "Twitter Profile": "concat('Followers:', c_custkey, ' Following:1,234 Tweets: 5')",
    "PurchaseComplete": "CAST(1 AS INTEGER)",
}
ASOF_SQL = """
    WITH starts AS (
           SELECT c_custkey AS user_id, v, TIMESTAMP '2023-12-30' + to_days(9 * v) + to_hours(c_custkey % 50 * 5) AS valid_from,
                  concat(c_mktsegment, '-', v) AS segment, c_acctbal + v AS balance
           FROM customer, (SELECT unnest([0, 1, 2, 3]) AS v)),
         versions AS (SELECT *, CASE WHEN v % 3 = 2 THEN valid_from + to_days(3) END AS valid_to FROM starts),
         found AS (
           SELECT e.event_id, e.ts, e.user_id, e.value, v.valid_from, v.valid_to, v.segment, v.balance,
                  v.valid_to IS NULL OR e.ts < v.valid_to AS holds
           FROM events e ASOF LEFT JOIN versions v ON e.user_id = v.user_id AND e.ts >= v.valid_from)
    SELECT event_id, ts, user_id, value, CASE WHEN holds THEN valid_from END AS valid_from, CASE WHEN holds THEN valid_to END AS valid_to,
           CASE WHEN holds THEN segment END AS segment, CASE WHEN holds THEN balance END AS balance
    FROM found"""

RECONCILE_SQL = """
            SELECT concat('doc-', coalesce(d.doc_id, l.doc_id), '.csv') AS file_name,
                   CASE WHEN l.doc_id IS NULL THEN 'MISSING' WHEN d.doc_id IS NULL THEN 'STRAY' ELSE 'DONE' END AS state
            FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id
            UNION ALL SELECT concat('lost-', doc_id, '.csv'), 'STRAY' FROM labels"""

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
MANY_LAYOUTS_SQL = "SELECT " + ", ".join(
    f"CASE WHEN o_orderkey % 1000 < 720 OR (o_orderkey % 1000 - 720) % 6 <> {i} THEN {name} END AS {name}"
    for i, name in enumerate(ORDER_COLUMNS)
) + " FROM orders"

IMPORT_SQL = "SELECT " + ", ".join(
    f"{IMPORT_VALUES_SQL.get(name, f"concat('{name} ', listing_id)")} AS \"{name.lower().replace(' ', '_')}\""
    for name in [*contracts.IMPORT_COLUMNS, "PurchaseComplete"]
) + f" FROM ({LISTINGS_SQL})"


def oracle_sql() -> dict[str, str]:
    return OWN_SQL | {name: sql for module in CORPUS for name, sql in module.oracle_sql().items()}


OWN_SQL = {
    "marker_count": "SELECT page_id, CAST(len(string_split(html, '<li>')) - 1 AS INTEGER) AS list_items FROM pages",
    "labeled_number": """SELECT event_id, TRY_CAST(regexp_extract(props, '("k": )([0-9]+)', 2) AS BIGINT) AS k
            FROM events""",
    "labeled_keyword_flags": f"SELECT page_id, {_title_flag_sql('html')} FROM pages",
    "last_path_segment": "SELECT page_id, regexp_extract(url, '/([^/]*)$', 1) AS segment FROM pages",
    "file_route": r"""
            WITH paths AS (
              SELECT doc_id, CASE lang
                WHEN 'en' THEN concat('/in/doc-', doc_id, '.csv')
                WHEN 'fr' THEN concat('/out/doc-', doc_id, '.csv')
                WHEN 'de' THEN concat('/in/DOC-', doc_id, '.csv')
                ELSE concat('/in/doc-', doc_id, '.csv._COPYING_') END AS path
              FROM documents)
            SELECT doc_id, path, CASE
              WHEN regexp_full_match(path, '/in/[0-9a-z\-]{1,}\.csv') THEN 'IN'
              WHEN regexp_full_match(path, '/out/[0-9a-z\-]{1,}\.csv') THEN 'OUT'
              ELSE 'SKIP' END AS route
            FROM paths""",
    "intersect_select": 'SELECT c_mktsegment, c_name AS "C_NAME", c_custkey FROM customer',
    "strict_select": "SELECT o_orderdate, o_orderkey, o_orderpriority FROM orders",
    "constant_column": "SELECT *, CAST(1 AS INTEGER) AS purchase_complete FROM orders",
    "guarded_derive": """SELECT *, TRY_CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k
            FROM events""",
    "frequency_index": f"WITH {_ranked_sql('part', 'p_brand')} SELECT label, idx, n_rows AS rows FROM ranked",
    "one_hot_string": f"""WITH {_ranked_sql('part', 'p_brand')}
            SELECT p_partkey, p_brand, {VECTOR_SQL} AS brand_vector FROM part LEFT JOIN ranked ON p_brand = label""",
    "one_hot_named_function": f"""WITH {_ranked_sql('part', 'p_type')}
            SELECT p_partkey, p_type, {VECTOR_SQL} AS type_vector FROM part LEFT JOIN ranked ON p_type = label""",
    "one_hot_null_keep": f"""
            WITH typed AS (SELECT event_id, nullif(event_type, 'error') AS event_type FROM events),
                 {_ranked_sql('typed', 'event_type')}
            SELECT event_id, event_type, {VECTOR_SQL} AS type_vector
            FROM typed LEFT JOIN ranked ON event_type = label""",
    "encode_unseen": f"""
            WITH docs AS (SELECT doc_id, concat(lang, '/', source) AS category FROM documents),
                 labelled AS (SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)),
                 {_ranked_sql('labelled', 'category')}
            SELECT doc_id, category, {VECTOR_SQL} AS category_vector
            FROM docs LEFT JOIN ranked ON category = label""",
    "encode_per_group": """
            WITH ranked AS (
              SELECT lang, source, count(*) OVER (PARTITION BY lang) AS n,
                     row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) - 1 AS idx
              FROM documents GROUP BY lang, source)
            SELECT doc_id, lang, source, concat(n, '|', idx, '|1.0') AS source_vector
            FROM documents JOIN ranked USING (lang, source)""",
    "encode_many_labels": f"""
            WITH texts AS (SELECT o_orderkey, o_custkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders),
                 {_ranked_sql('texts', 'customer')}
            SELECT o_orderkey, o_custkey, {VECTOR_SQL} AS customer_vector
            FROM texts LEFT JOIN ranked ON customer = label""",
    "csv_quoted_multiline": "SELECT * FROM documents",
    "csv_folder_glob": "SELECT * FROM customer",
    "csv_mixed_headers": """
            SELECT c_custkey, c_name, c_nationkey,
                   CASE WHEN c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY') THEN c_acctbal END AS c_acctbal,
                   c_mktsegment
            FROM customer""",
    "csv_inferred": """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type,
            CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part""",
    "csv_partitioned_by_source": "SELECT * FROM documents",
    "quarantine_bad_rows": """
            SELECT CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id END AS event_id,
                   CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type,
                   CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS value,
                   CASE event_type WHEN 'error' THEN concat(event_id, ',error,broken')
                                   WHEN 'signup' THEN concat(event_id, ',signup') END AS bad_line
            FROM events""",
    "stream_constant_prediction": f"SELECT {EVENT_COLUMNS_SQL}, 'predicted' AS prediction FROM events",
    "stream_per_file_features": PAGE_ENCODED_SQL,
    "stream_static_join": f"""SELECT {EVENT_COLUMNS_SQL}, c_name, c_mktsegment
            FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "score_linear": """SELECT l_orderkey, l_linenumber,
            0.5::DOUBLE + l_quantity * 0.25::DOUBLE + l_discount * (-3.5)::DOUBLE + l_tax * 1.75::DOUBLE AS prediction
            FROM lineitem""",
    "train_linear": """SELECT
            floor(regr_intercept(l_extendedprice, l_quantity) * 10000 + 0.5) / 10000 AS intercept,
            floor(regr_slope(l_extendedprice, l_quantity) * 10000 + 0.5) / 10000 AS quantity_weight
            FROM lineitem""",
    "predictions_join": """SELECT doc_id, lang, source, n_chars, quality AS prediction
            FROM documents LEFT JOIN labels USING (doc_id)""",
    "stream_label_epochs": """
            WITH parts AS (
                   SELECT CAST(o_custkey AS VARCHAR) AS label, o_orderkey % 4 AS part, count(*) AS n_rows FROM orders GROUP BY ALL),
                 labels AS (SELECT label, min(part) AS first, arg_min(n_rows, part) AS at_first, sum(n_rows)::BIGINT AS "rows" FROM parts GROUP BY label)
            SELECT label, CAST(row_number() OVER (ORDER BY first, at_first DESC, label) - 1 AS INTEGER) AS idx,
                   count(*) OVER () AS n, "rows" FROM labels""",
    "predictions_stream_join": """SELECT doc_id, lang, source, n_chars, quality AS prediction
            FROM documents LEFT JOIN labels USING (doc_id)""",
    "predictions_delivery": """SELECT doc_id, lang, source, n_chars, quality AS prediction
            FROM documents LEFT JOIN labels USING (doc_id)""",
    "in_out_reconcile": RECONCILE_SQL,
    "stream_in_out_reconcile": RECONCILE_SQL,
    "arrivals_reuploaded": """
            SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 4 = 1 THEN 1 ELSE 0 END AS c_acctbal,
                   CAST(CASE WHEN c_custkey % 4 = 1 THEN 2 ELSE 1 END AS INTEGER) AS version, concat('f', c_custkey % 4, '.csv') AS source_file
            FROM customer""",
    "replay_repaired_rows": "SELECT event_id, event_type, value FROM events",
    "features_job": f"""
            SELECT *, 0.5::DOUBLE + list_items::DOUBLE * 0.25::DOUBLE + title_has_the::DOUBLE * 1.5::DOUBLE
                   + title_has_der::DOUBLE * (-2.0)::DOUBLE AS prediction
            FROM ({PAGE_ENCODED_SQL})""",
    "listing_features_job": LISTING_FEATURES_SQL,
    "stream_listing_features": LISTING_FEATURES_SQL,
    "features_same_name_two_folders": LISTING_FEATURES_SQL,
    "features_two_runs_one_output": LISTING_FEATURES_SQL,
    "stream_listing_features_per_file": LISTING_FEATURES_PER_FILE_SQL,
    "features_with_bad_rows": f"""
            WITH listings AS ({LISTINGS_SQL}), good AS (SELECT * FROM listings WHERE c_nationkey >= 10),
                 {_ranked_sql("good", "category")}
            SELECT listing_id, zip_code, {VECTOR_SQL} AS vector, NULL AS bad_line
            FROM good LEFT JOIN ranked ON category = label
            UNION ALL
            SELECT NULL, NULL, NULL, CASE WHEN c_nationkey < 5
              THEN concat(listing_id, ',', zip_code, ',', coalesce(category, ''), ',more') ELSE listing_id END
            FROM listings WHERE c_nationkey < 10""",
    "csv_stray_quotes": """SELECT CAST(doc_id AS VARCHAR) AS id, concat('5" ', lang) AS size,
            concat('line one', chr(10), source) AS note FROM documents""",
    "rank_by_ranges": f"""WITH texts AS (SELECT CAST(o_custkey AS VARCHAR) AS customer FROM orders),
            {_ranked_sql("texts", "customer")} SELECT label, idx, n_rows AS rows FROM ranked""",
    "encode_split_join": f"""
            WITH texts AS (SELECT o_orderkey, o_custkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders),
                 {_ranked_sql('texts', 'customer')}
            SELECT o_orderkey, o_custkey, {VECTOR_SQL} AS customer_vector
            FROM texts LEFT JOIN ranked ON customer = label""",
    "stream_hot_keys": f"""SELECT {EVENT_COLUMNS_SQL}, c_name, c_mktsegment
            FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "train_linear_category": f"""{SALES_MODEL_SQL}
            SELECT m.category, floor((m.constant - none.constant) * 1000 + 0.5) / 1000 AS weight
            FROM model m, (SELECT constant FROM model WHERE category IS NULL) none WHERE m.category IS NOT NULL""",
    "train_linear_many_categories": """
            WITH orders_by_day AS (
                   SELECT CAST(o_custkey AS VARCHAR) AS category, o_totalprice AS y,
                          CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS x
                   FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL),
                 cells AS (
                   SELECT category, count(*) AS n_rows, avg(x) AS mean_x, avg(y) AS mean_y,
                          covar_pop(y, x) * count(*) AS xy, var_pop(x) * count(*) AS xx
                   FROM orders_by_day GROUP BY category),
                 line AS (SELECT sum(xy) / sum(xx) AS slope FROM cells)
            SELECT category, floor((mean_y - slope * mean_x) * 100 + 0.5) / 100 AS constant, n_rows AS "rows",
                   floor(slope * 10000 + 0.5) / 10000 AS slope
            FROM cells, line WHERE category IS NOT NULL""",
    "score_stored_model": f"""{SALES_MODEL_SQL}
            SELECT listing_id, zip_code AS employee_count, sales,
                   floor((constant + slope * c_nationkey) * 1000 + 0.5) / 1000 AS prediction
            FROM rows JOIN model ON rows.category IS NOT DISTINCT FROM model.category""",
    "listing_import_job": IMPORT_SQL,
    "import_mixed_headers": IMPORT_SQL,
    "csv_many_layouts": MANY_LAYOUTS_SQL,
    "events_asof_customer": ASOF_SQL,
    "stream_events_asof": ASOF_SQL,
    "csv_inferred_codes": """SELECT p_partkey::INTEGER AS p_partkey, lpad(p_partkey::VARCHAR, greatest(5, strlen(p_partkey::VARCHAR)::INTEGER), '0') AS code,
            p_size::INTEGER AS p_size, p_size / 2::DOUBLE AS half, p_size > 9 AS large FROM part""",
}

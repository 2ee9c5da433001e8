"""Exact top-k, near dedup, components and sharding against brute force."""

import itertools
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import ROWS
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.components import components, union_find
from filefeatures.llm.exact_dedup import dedup, keep_first
from filefeatures.llm.lm_scoring import look_up, score
from filefeatures.llm.near_dedup import keep_one, near_dedup
from filefeatures.llm.sharding import shard, write_shards
from filefeatures.llm.superminhash import shingles, signatures
from filefeatures.llm.topk import top_k, whole_vectors
from filefeatures.session import stage

VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("part", T.StringType())])


def brute_top_k(rows, is_query, k):
    vectors = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows]
    out = []
    for i, v in vectors:
        if is_query(i):
            scored = sorted((-int(v @ w), j) for j, w in vectors if j != i)[:k]
            out += [(i, rank, j, -score) for rank, (score, j) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("query_block, part_rows, row_block", [(512, 1 << 16, 8192), (3, 50, 16)])
def test_top_k_with_ties(spark, query_block, part_rows, row_block):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.integers(-2, 3, 40) / 4).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(60)]  # copies: the same scores
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTOR)
    got = top_k(whole_vectors(table), F.col("vec_id") % 7 == 0, query_block=query_block, part_rows=part_rows, row_block=row_block, dimensions_at_once=8)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, lambda i: i % 7 == 0, 5)


@pytest.mark.parametrize("copies", [2, 5, 6, 12])
def test_top_k_of_queries_that_occur_more_than_once(spark, copies):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.integers(-2, 3, 40) / 4).astype(float).tolist()) for i in range(1, 200)]
    # The query's own rows are longer than all others, so their products with it are the highest.
    rows += [(0, (draw.integers(3, 5, 40) / 2).astype(float).tolist()) for _ in range(copies)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTOR)
    got = top_k(whole_vectors(table), F.col("vec_id") == 0, dimensions_at_once=8)
    whole = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows]
    scored = sorted((-int(q @ w), j) for i, q in whole if i == 0 for j, w in whole if j != 0)[:5]
    assert sorted(map(tuple, got.collect())) == [(0, rank, j, -score) for rank, (score, j) in enumerate(scored, 1)]


def test_top_k_leaves_out_vectors_without_numbers(spark):
    rows = [(0, [1.0, 2.0]), (7, None), (14, [1.0, None]), (21, [float("nan"), 1.0]), (28, [float("inf"), 1.0]), (1, [0.5, 0.5]), (None, [1.0, 1.0])]
    got = top_k(whole_vectors(spark.createDataFrame([(*r, "x") for r in rows], VECTOR)), F.col("vec_id") % 7 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 256 * 128 + 512 * 128)]


def test_top_k_among_vectors_of_the_same_length(spark):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.integers(-9, 9, 3 + i % 2) / 4).astype(float).tolist()) for i in range(80)] + [(700, []), (701, [1.0] * 9)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTOR)
    got = top_k(whole_vectors(table), F.col("vec_id") % 7 == 0, query_block=3, part_rows=20, dimensions_at_once=2)
    want = [r for n in (3, 4, 9) for r in brute_top_k([x for x in rows if len(x[1]) == n], lambda i: i % 7 == 0, 5)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("size", [2e5, 1e6])
def test_top_k_of_large_components(spark, size):
    draw = np.random.default_rng(7)
    vectors = (size * draw.normal(size=(150, 12))).astype(np.float32).astype(float)
    vectors[40:60] = vectors[20]  # near ties: only exact sums tell them apart
    vectors[40:60, 3] += np.arange(20) / 8
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTOR)
    got = top_k(whole_vectors(table), F.col("vec_id") % 10 == 0, query_block=8, part_rows=40, row_block=16, dimensions_at_once=4)
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = []
    for i in range(0, 150, 10):
        scored = sorted((-sum(a * b for a, b in zip(whole[i], w, strict=True)), j) for j, w in whole.items() if j != i)[:5]
        want += [(i, rank, j, -score) for rank, (score, j) in enumerate(scored, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_refuses_products_beyond_64_bits(spark):
    table = spark.createDataFrame([(0, [1e12], "x"), (1, [1e12], "x")], VECTOR)
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        top_k(whole_vectors(table), F.col("vec_id") == 0).collect()


def test_top_k_of_nothing(spark):
    assert top_k(whole_vectors(spark.createDataFrame([], VECTOR)), F.lit(True)).count() == 0
    alone = spark.createDataFrame([(0, [1.0], "x")], VECTOR)
    assert top_k(whole_vectors(alone), F.lit(True)).count() == 0


def plain_shingles(text, width):
    """The set of word tuples; words of a shorter text are one."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[ \t-\r]+", lower) if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_near(rows, width, percent):
    """(doc_id, n_shingles, component) by comparing all pairs and spreading the smallest row along links."""
    sets = [plain_shingles(text, width) for _, text in rows]
    links = defaultdict(list)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                links[i].append(j)
                links[j].append(i)
    group = {}
    for i in range(len(rows)):
        todo = [] if i in group else [i]
        while todo:
            at = todo.pop()
            if at not in group:
                group[at] = i
                todo += links[at]
    least = {g: min((rows[i][0] for i in group if group[i] == g and rows[i][0] is not None), default=None) for g in set(group.values())}
    return [(doc_id, len(sets[i]), least[group[i]]) for i, (doc_id, _) in enumerate(rows)]


def as_file(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def comparable(rows):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


@pytest.mark.parametrize("block_rows", [512, 16])
def test_near_dedup_of_groups_around_the_limit(spark, tmp_path, block_rows):
    """Families whose members are alike by 0.6 to 1: bridges, hot buckets, copies, singles."""
    draw = np.random.default_rng(5)
    rows = []
    for family in range(4):
        base = [f"w{x}" for x in draw.integers(0, 5000, 120)]
        for _ in range(60 if family else 150):
            words = list(base)
            for place in draw.integers(0, 120, draw.integers(0, 8)):
                words[place] = f"v{draw.integers(0, 5000)}"
            rows.append(" ".join(words))
    rows += rows[:20] + [" ".join(f"s{x}" for x in draw.integers(0, 9000, 60)) for _ in range(40)]
    rows = [(int(i), text) for i, text in zip(draw.permutation(len(rows)), rows, strict=True)]
    docs = as_file(spark, tmp_path, rows)
    got = near_dedup(docs, shingle_words=4, block_rows=block_rows).collect()
    assert comparable(got) == Counter(brute_near(rows, 4, 80))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_of_the_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert comparable(near_dedup(documents, shingle_words=4).collect()) == Counter(brute_near(rows, 4, 80))


def test_near_dedup_edge_documents(edge_docs):
    got = near_dedup(edge_docs).collect()
    expected = brute_near(ROWS, 5, 80)
    # Without shingles a text is linked with nothing, copies of it included.
    assert comparable(got) == Counter((d, n, d if n == 0 else c) for d, n, c in expected)
    kept = keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [1, 2, 3, 4, 6, 9, 10]


def test_keep_one_keeps_unlinked_texts_that_share_an_id_or_have_none(spark, tmp_path):
    texts = [f"{name} one two three four five six seven" for name in ("red", "blue")] + [f"{x}1 {x}2 {x}3 {x}4 {x}5 {x}6" for x in "abcdef"]
    rows = list(zip([None, 3, None, None, 7, 7, 8, 8], texts, strict=True))
    rows += [(None, texts[2]), (5, texts[3]), (6, texts[4]), (8, texts[7])]
    docs = as_file(spark, tmp_path, rows)
    components_of = defaultdict(set)
    for r in near_dedup(docs).collect():
        components_of[r.component].add(r.component_id)
    assert len(components_of) == len(texts) and all(len(ids) == 1 for ids in components_of.values())
    expected = [(None, texts[0]), (3, texts[1]), (None, texts[2]), (5, texts[3]), (6, texts[4]), (7, texts[5]), (8, texts[6]), (8, texts[7])]
    assert Counter(map(tuple, keep_one(docs).collect())) == Counter(expected)


@pytest.fixture
def shifting_splits(spark, monkeypatch):
    """After every staged table files are split in another way, as when executors come or go."""
    names = [f"spark.sql.files.{name}" for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")]
    before, sizes = {name: spark.conf.get(name, None) for name in names}, itertools.cycle(["4k", "1g"])
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "1")

    def staged(df, purpose="staged"):
        done = stage(df, purpose)
        spark.conf.set(names[0], next(sizes))
        return done

    for module in ("arrow", "near_dedup", "exact_dedup", "lm_scoring"):
        monkeypatch.setattr(sys.modules[f"filefeatures.llm.{module}"], "stage", staged)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rows_keep_their_number_when_files_are_split_anew(spark, tmp_path, shifting_splits):
    draw = np.random.default_rng(8)
    bases = [[f"w{x}" for x in draw.integers(0, 900, 60)] for _ in range(25)]
    rows = [(i, " ".join([*bases[i % 25][:58], *([f"x{i}"] if i % 3 else []), "end"])) for i in range(100)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(path)
    docs = spark.read.parquet(path)
    near = brute_near(rows, 5, 80)
    assert comparable(near_dedup(docs).collect()) == Counter(near)
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == sorted(d for d, _, c in near if d == c)
    assert sorted(r.doc_id for r in keep_first(docs).collect()) == sorted({text: d for d, text in rows}.values())
    plain = {r.doc_id: r.score for r in score(docs.coalesce(1), block_bytes=400, shares=3).collect()}
    assert {r.doc_id: r.score for r in score(docs, block_bytes=400, shares=3).collect()} == pytest.approx(plain, rel=1e-6)


def test_a_key_without_answer_is_an_error():
    keys, values = np.array([2, 5, 9]), np.array([0.2, 0.5, 0.9])
    assert look_up(keys, values, np.array([9, 2, 2])).tolist() == [0.9, 0.2, 0.2]
    for missing in (1, 6, 10):
        with pytest.raises(ValueError):
            look_up(keys, values, np.array([2, missing]))


def test_dedup_edge_documents(edge_docs):
    got = dedup(edge_docs).collect()
    assert len(got) == len(ROWS)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append((r.keep_id, r.group_size, r.kept))
    assert by_id[1] == [(2, 2, False)] and by_id[2] == [(2, 2, True)] and by_id[3] == [(3, 1, True)]
    assert by_id[6] == [(7, 2, False)] and by_id[8] == [(8, 1, True)]
    assert sorted(by_id[5]) == [(5, 4, False), (5, 4, True)] and by_id[None] == [(5, 4, False)]
    kept = keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [2, 3, 5, 7, 8, 9, 10]


def test_nothing(no_docs):
    assert dedup(no_docs).count() == near_dedup(no_docs).count() == shard(no_docs).count() == 0


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (2001, 2000), (2000, 2001)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(20)).collect()))
    loops = [(a, b) for a, b in edges if a != b]
    assert got == union_find(*(np.array(x) for x in zip(*loops, strict=True)))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_estimate_similarity_with_less_spread_than_independent_hashes():
    draw, errors = np.random.default_rng(0), []
    for _ in range(300):
        a = draw.integers(0, 2**63, 60, dtype=np.uint64)
        b = np.concatenate([a[6:], draw.integers(0, 2**63, 6, dtype=np.uint64)])
        true = 54 / 66
        first, second = signatures([a, b], 128)
        errors.append((first == second).mean() - true)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.9 * np.sqrt(true * (1 - true) / 128)


def test_each_shingle_ranks_the_slots_without_repeats():
    values = signatures([np.array([77], np.uint64)], 50)[0]
    assert sorted((values >> np.uint64(48)).tolist()) == list(range(50))


def test_shards_with_a_document_over_the_limit_and_repeated_ids(spark, tmp_path):
    rows = [(i, "x" * 100) for i in range(300)] + [(1000, "y" * 5000), (None, "z"), (None, None), (7, "x" * 900), (7, "x" * 900)]
    docs = as_file(spark, tmp_path, rows)
    got = shard(docs, limit=1500).collect()
    assert len(got) == len(rows)
    sizes, shards = defaultdict(int), defaultdict(set)
    for r in got:
        shards[r.shard].add(r.doc_id)
        sizes[r.shard] = r.shard_bytes
    for bits, size in sizes.items():
        assert size <= 1500 or shards[bits] in ({1000}, {7})
        assert not any(other != bits and other.startswith(bits) for other in sizes)  # no shard lies in another
    write_shards(docs, str(tmp_path / "out"), limit=1500)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(tuple, back.select("doc_id", "text").collect())) == Counter(rows)
    assert back.groupBy("__shard").agg(F.sum(F.octet_length("text"))).count() == len(sizes)

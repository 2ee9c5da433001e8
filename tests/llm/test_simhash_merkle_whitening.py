"""SimHash groups, Merkle manifests and whitening against plain versions that share no code with them."""

import hashlib
import re
import zlib

import numpy as np
import oracle
import pytest
import xxhash
from edge import ROWS, SF_DIR
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm import queries as registered
from filefeatures.llm import simhash
from filefeatures.llm.components import components
from filefeatures.llm.merkle import folded, leaf, manifest, proof_text
from filefeatures.llm.simhash import fingerprints, links, simhash_dedup
from filefeatures.llm.whitening import _squares, fit, whiten

# SimHash -------------------------------------------------------------------------------------------


def plain_print(text, width=4):
    data = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits=4):
    """Of each fingerprint, the number of the first one that it is connected with."""
    group = list(range(len(prints)))
    prints = np.array(prints, np.uint64)
    todo = set(group)
    while todo:
        first, edge = min(todo), [min(todo)]
        todo.discard(first)
        while edge:
            at = edge.pop()
            for other in np.flatnonzero(np.bitwise_count(prints ^ prints[at]) <= bits).tolist():
                if other in todo:
                    todo.discard(other)
                    group[other] = first
                    edge.append(other)
    return group


def plain_simhash(rows):
    prints = [plain_print(text) for _, text in rows]
    group = plain_groups(prints)
    least = {}
    for g, (doc_id, _) in zip(group, rows, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return sorted(((d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, group, strict=True)), key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"block": 3}, {"block": 2, "split": 3}])
def test_simhash_of_edge_documents(edge_docs, sizes):
    assert rows_of(simhash_dedup(edge_docs, **sizes)) == plain_simhash(ROWS)


def test_simhash_query_equals_brute_force(spark, documents):
    rows = [tuple(row) for row in documents.select("doc_id", "text").collect()]
    assert rows_of(registered.queries()["op11_simhash"](spark, SF_DIR)) == plain_simhash(rows)


def test_simhash_of_nothing(no_docs):
    assert simhash_dedup(no_docs).count() == 0


def test_simhash_links_documents_of_few_changed_words(spark):
    long = [f"w{i * i % 9973}" for i in range(3000)]
    texts = [" ".join(long), " ".join(long[:1500] + ["odd"] + long[1500:]), " ".join(reversed(long)), " ".join(long).upper()]
    rows = [(10 + i, text) for i, text in enumerate(texts)]
    got = rows_of(simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_simhash(rows)
    assert [row[2] for row in got] == [10, 10, 12, 10]


def test_runs_of_a_long_text_give_the_same_fingerprint(monkeypatch):
    text = " ".join(f"Word{i % 53}\n\tx{i % 7}" for i in range(400))
    monkeypatch.setattr(simhash, "TEXT_AT_ONCE", 10)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    texts = [text, "", "a b", "a  b c D", text[:100]]
    assert fingerprints([t.encode() for t in texts]).tolist() == [plain_print(t) for t in texts]


def crowd(draw, n, most):
    """Fingerprints around a few centres, of zero to `most` changed bits, and some far from all."""
    centres = [int(x) for x in draw.integers(0, 1 << 63, 5)] + [0, (1 << 64) - 1]
    made = {int(x) for x in draw.integers(0, 1 << 63, 50)}
    while len(made) < n:
        value = centres[int(draw.integers(len(centres)))]
        for bit in draw.choice(64, int(draw.integers(0, most + 1)), replace=False):
            value ^= 1 << int(bit)
        made.add(value)
    return sorted(made)


@pytest.mark.parametrize("sizes", [{}, {"block": 16}, {"block": 16, "split": 20}, {"block": 1, "split": 2}])
@pytest.mark.parametrize("most", [3, 9, 14])
def test_links_connect_what_few_bits_do(spark, sizes, most):
    prints = crowd(np.random.default_rng(most), 600, most)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(p,) for p in signed], "print long")
    found = links(nodes, **sizes)
    for a, b in found.distinct().collect():
        assert 0 < (a ^ b).bit_count() <= 4 or ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    component = dict(map(tuple, components(found).collect()))
    group = plain_groups(prints)
    least = {}
    for p, g in zip(signed, group, strict=True):
        least[g] = min(p, least.get(g, p))
    assert [component.get(p, p) for p in signed] == [least[g] for g in group]


def test_a_key_with_many_members_gives_fewer_links_than_members(spark):
    """All pairs of these are alike: nearly a million."""
    draw = np.random.default_rng(1)
    made = sorted({int((1 << a) | (1 << b)) for a in range(40) for b in range(a)} | {1 << a for a in range(60)})
    nodes = spark.createDataFrame([(int(p),) for p in draw.permutation(made)], "print long")
    assert links(nodes).count() < 64 * len(made)
    assert components(links(nodes, block=64)).select("component").distinct().count() == 1


def test_links_take_four_bits_at_most(spark):
    with pytest.raises(ValueError):
        links(spark.createDataFrame([(1,)], "print long"), max_bits=5)


# Merkle --------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    texts = [None if v is None else str(v) for v in values]
    return sha(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def plain_tree(leaves, arity):
    """(root, for each leaf the siblings on its way up as (left, right))."""
    paths, level = [[] for _ in leaves], list(leaves)
    place = list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(place):
            start = at - at % arity
            paths[i].append(("".join(level[start:at]), "".join(level[at + 1 : start + arity])))
            place[i] = at // arity
        level = [sha(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return level[0], paths


def plain_manifest(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text)."""
    order = sorted(rows, key=lambda r: ((r[2] is not None, (r[2] or "").encode()), (r[0] is not None, r[0] or 0), plain_leaf(*r)))
    groups = {}
    for row in order:
        groups.setdefault(row[2], []).append(row)
    trees = {lang: plain_tree([plain_leaf(*row) for row in own], arity) for lang, own in groups.items()}
    root, tops = plain_tree([tree[0] for tree in trees.values()], arity)
    out = []
    for (lang, own), top in zip(groups.items(), tops, strict=True):
        for row, path in zip(own, trees[lang][1], strict=True):
            path = path + top
            tampered = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                tampered = (*row[:3], row[3] + 1, row[4])
            at = plain_leaf(*tampered)
            for left, right in path:
                at = sha(left, at, right)
            out.append((row[0], plain_leaf(*row), trees[lang][0], root, sha(*[x for pair in path for x in pair]), at, at == root))
    return sorted(out, key=str)


MERKLE_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos string, digest string, path string, node string, __row string"
LANGS = [None, "", "-", "=", "de", "é", "z"]


def merkle_rows(n):
    rows = [(i, f"s{i % 3}" if i % 5 else None, LANGS[i % 13 % len(LANGS)], None if i % 11 == 0 else i, [None, "", "Text é", "x" * 5000][i % 4]) for i in range(n)]
    return rows + [(None, None, None, None, None), (3, "a", "de", 1, "same"), (3, "a", "de", 1, "same"), (3, "b", "de", 1, "other"), (7, None, "only", 2, "one")]


def checked(df):
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    rows = df.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256), root)
    return sorted(((*r, r[5] == r[3]) for r in map(tuple, rows.collect())), key=str)


def tampered(docs):
    chosen = (F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0) & docs["n_chars"].isNotNull()
    return {"tampered": F.when(chosen, leaf([docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"] + 1, docs["text"]]))}


@pytest.mark.parametrize("arity, levels", [(2, 8), (2, 1), (2, 3), (3, 2), (5, 1)])
def test_manifest_of_odd_rows(spark, arity, levels):
    rows = merkle_rows(120)
    docs = spark.createDataFrame([(*row, *"abcdef") for row in rows], MERKLE_SCHEMA).repartition(4)
    assert checked(manifest(docs, carry=tampered(docs), arity=arity, levels=levels)) == plain_manifest(rows, arity)


def test_manifest_of_one_row_and_of_none(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, *"abcdef")], MERKLE_SCHEMA)
    (row,) = manifest(docs).collect()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert manifest(docs.where("doc_id = 2")).count() == 0


def test_manifest_of_numbers_at_the_end_of_their_range(spark):
    rows = [(1, "a", "b", (1 << 63) - 1, "t"), (7, "a", "b", -1, "t"), (14, "a", "b", (1 << 63) - 1, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    docs.select(leaf([F.col("doc_id"), more])).collect()


def test_manifest_order_does_not_follow_the_partitions(spark, documents):
    root = {row.root for row in manifest(documents.repartition(7)).select("root").collect()}
    assert root == {row.root for row in manifest(documents.coalesce(1), levels=4).select("root").collect()}


# Whitening -----------------------------------------------------------------------------------------

VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("n", T.StringType())])


def plain_whitening(rows):
    """By Python integers: ids, deviations, covariance, centred values."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024.0 * float(np.float32(c)))) + 100_000 for c in v] for _, v in kept], dtype=object)
    n = len(x)
    y = n * x - x.sum(axis=0)
    products = y.T.dot(y)
    covariance = np.array([[int(p) / n**3 for p in row] for row in products])
    return [i for i, _ in kept], [int((r * r).sum()) for r in y], covariance, y.astype(float) / n


def check_whitening(rows, got, components=8):
    ids, deviations, covariance, centred = plain_whitening(rows)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    assert len(got) == len(ids) * len(values)
    assert {r.n for r in got} == {len(ids)}
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == sorted(zip(ids, deviations, strict=True))
    (error,) = {r.identity_error for r in got}
    assert error <= 1e-4
    for k in range(len(values)):
        own = {r.vec_id: r for r in got if r.component == k + 1}
        mine = np.array([own[i].whitened for i in ids])
        want = centred @ directions[:, k] / np.sqrt(values[k])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
        assert abs(own[ids[0]].explained / (values[k] / np.trace(covariance)) - 1) < 1e-9
    white = np.array([[{r.vec_id: r.whitened for r in got if r.component == k + 1}[i] for i in ids] for k in range(len(values))])
    assert np.abs(white @ white.T / len(ids) - np.eye(len(values))).max() < 1e-6


def test_whitening_query_equals_plain_version(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check_whitening(rows, registered.queries()["op13_whiten"](spark, SF_DIR).collect())


@pytest.mark.parametrize("size", [1.0, 100.0])
def test_whitening_of_odd_vectors(spark, size):
    draw = np.random.default_rng(5)
    rows = [(i, (size * draw.normal(size=10) * np.arange(1, 11)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(300, None), (301, [1.0] * 9 + [None]), (302, [float("nan")] * 10), (303, [float("inf")] + [0.0] * 9)]
    table = spark.createDataFrame([(*row, "x") for row in rows], VECTOR).repartition(3)
    check_whitening(rows, whiten(table, fit(table)).collect())


def test_whitening_with_fewer_dimensions_and_repeated_rows(spark):
    rows = [(0, [0.0, 0.0]), (0, [0.0, 0.0]), (None, [1.0, 0.5]), (2, [1.0, -0.5])]
    table = spark.createDataFrame([(*row, "x") for row in rows], VECTOR)
    got = whiten(table, fit(table)).collect()
    assert len(got) == 8 and {r.component for r in got} == {1, 2}
    assert got[0].identity_error < 1e-9


def test_whitening_without_variance_and_of_nothing(spark):
    table = spark.createDataFrame([(i, [0.5, 0.25], "x") for i in range(3)], VECTOR)
    got = whiten(table, fit(table)).collect()
    assert len(got) == 6
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, 0.0, None)}
    none = table.where("vec_id = 9")
    assert whiten(none, fit(none)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 1.0], "x") for i in range(4)], VECTOR)
    got = whiten(line, fit(line)).collect()
    assert {r.component for r in got if r.whitened is None} == {2}
    assert got[0].identity_error < 1e-9


def test_whitening_refuses_what_has_no_result(spark):
    mixed = spark.createDataFrame([(1, [1.0], "x"), (2, [1.0, 2.0], "x")], VECTOR)
    with pytest.raises(ValueError, match="1 and of 2 entries"):
        fit(mixed)
    vast = spark.createDataFrame([(1, [1e30], "x"), (2, [1.0], "x")], VECTOR)
    with pytest.raises(Exception, match="too large"):
        fit(vast)


def test_sums_of_squares_are_exact():
    draw = np.random.default_rng(2)
    for high in (10, 1 << 30, 1 << 40, 1 << 61):
        values = draw.integers(-high, high, (500, 3))
        assert _squares(values) == [sum(int(v) ** 2 for v in column) for column in values.T]


# SQL -----------------------------------------------------------------------------------------------


def test_merkle_sql_on_odd_rows(spark, tmp_path):
    rows = merkle_rows(60)
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, registered.queries()["op12_merkle"](spark, str(tmp_path)).collect()), key=str)
    assert got == plain_manifest(rows)
    duck = oracle.duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duck.execute(registered.MERKLE_SQL).fetchall(), key=str) == got

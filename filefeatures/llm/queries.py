"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from filefeatures.llm import quality, toxicity
from filefeatures.llm.arrow import bound_batches
from filefeatures.llm.bpe import encode_documents
from filefeatures.llm.exact_dedup import dedup
from filefeatures.llm.html_extract import extract_pages
from filefeatures.llm.lm_scoring import score
from filefeatures.llm.merkle import LEAF_COLUMNS, folded, leaf, manifest, proof_text
from filefeatures.llm.near_dedup import near_dedup
from filefeatures.llm.packing import pack
from filefeatures.llm.sharding import HASH_BITS, LIMIT_BYTES, shard
from filefeatures.llm.simhash import simhash_dedup
from filefeatures.llm.topk import top_k, whole_vectors
from filefeatures.llm.whitening import fit, whiten

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark, sf_dir, name):
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark, sf_dir):
    return pack(_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op2_quality(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, _table(spark, sf_dir, "labels")))


def op3_top_k(spark, sf_dir):
    return top_k(whole_vectors(_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0, k=5)


def op4_lm_score(spark, sf_dir):
    return score(_table(spark, sf_dir, "documents"))


def op5_html_text(spark, sf_dir):
    return extract_pages(_table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark, sf_dir):
    return encode_documents(_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op7_exact_dedup(spark, sf_dir):
    return dedup(_table(spark, sf_dir, "documents")).drop("row")


def op8_toxicity(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op9_shard(spark, sf_dir):
    return shard(_table(spark, sf_dir, "documents"))


def op10_near_dedup(spark, sf_dir):
    """Four words a shingle, as this query's contract says."""
    return near_dedup(_table(spark, sf_dir, "documents"), shingle_words=4).drop("row", "component")


def op11_simhash(spark, sf_dir):
    return simhash_dedup(_table(spark, sf_dir, "documents"))


def op12_merkle(spark, sf_dir):
    """Rows whose id's checksum 7 divides are looked up as if one had been added to n_chars since."""
    docs = _table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = leaf([more if name == "n_chars" else docs[name] for name in LEAF_COLUMNS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, carry={"tampered": F.when(chosen, tampered)})
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), root.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_whiten(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit(vectors))


def queries():
    return {name: query for name, query in globals().items() if name.startswith("op")}


TOP_K_SQL = """
    WITH vectors AS (
           SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
         scored AS (
           SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
           FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
         ranked AS (
           SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

DEDUP_SQL = f"""
    WITH texts AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS folded FROM documents),
         groups AS (SELECT folded, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY folded)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(folded) AS text_sha256
    FROM texts JOIN groups USING (folded)"""


def shard_sql(limit):
    """Every prefix of every hash with its bytes; a document's shard is its shortest prefix that fits."""
    return f"""
    WITH keyed AS (
           SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
           FROM documents),
         prefixes AS (SELECT *, hash >> ({HASH_BITS} - depth) AS prefix FROM keyed, generate_series(0, {HASH_BITS}) AS g(depth)),
         buckets AS (
           SELECT depth, prefix, sum(bytes) AS total, count(*) AS documents
           FROM prefixes GROUP BY depth, prefix HAVING sum(bytes) <= {limit} OR min(hash) = max(hash)),
         placed AS (SELECT doc_id, hash, min(depth) AS depth FROM prefixes JOIN buckets USING (depth, prefix) GROUP BY doc_id, hash)
    SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard,
           CAST(depth AS INTEGER) AS depth, CAST(total AS BIGINT) AS shard_bytes, documents AS shard_documents
    FROM placed JOIN prefixes USING (doc_id, hash, depth) JOIN buckets USING (depth, prefix)"""


def _leaf_sql(chars):
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


# A tree level by level: (lvl, tree, size, pos, digest), size being the nodes that are left; then every leaf's way up,
# with the digest that its neighbour has. The checksum is CRC-32, bit by bit, of the id's digits.
MERKLE_SQL = f"""
    WITH RECURSIVE crc AS (
           SELECT doc_id, 4294967295 - list_reduce(
                    list_concat([4294967295], flatten([list_concat([256 + ord(c)], [0, 0, 0, 0, 0, 0, 0, 0])
                                                       FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
                    lambda a, b: CASE WHEN b > 0 THEN xor(a, b - 256) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS crc
           FROM (SELECT DISTINCT doc_id FROM documents)),
         leaves AS (
           SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
                  CASE WHEN crc % 7 = 0 THEN {_leaf_sql("(CAST(n_chars AS HUGEINT) + 1)")} END AS tampered
           FROM documents LEFT JOIN crc USING (doc_id)),
         placed AS (
           SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size,
                  row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS leaf_no
           FROM leaves),
         nodes(lvl, lang, size, pos, digest) AS (
           SELECT 0, lang, size, pos, leaf FROM placed
           UNION ALL
           SELECT lvl + 1, lang, (size + 1) // 2, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
           FROM nodes WHERE size > 1 GROUP BY lvl, lang, size, pos // 2),
         subroots AS (
           SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1),
         tops(lvl, size, pos, digest) AS (
           SELECT 0, size, pos, digest FROM subroots
           UNION ALL
           SELECT lvl + 1, (size + 1) // 2, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
           FROM tops WHERE size > 1 GROUP BY lvl, size, pos // 2),
         walk(leaf_no, lvl, lang, size, pos, proof, here) AS (
           SELECT leaf_no, 0, lang, size, pos, '', coalesce(tampered, leaf) FROM placed
           UNION ALL
           SELECT w.leaf_no, w.lvl + 1, w.lang, (w.size + 1) // 2, w.pos // 2, w.proof || coalesce(n.digest, ''),
                  sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(n.digest, '') || here ELSE here || coalesce(n.digest, '') END)
           FROM walk w LEFT JOIN nodes n ON n.lvl = w.lvl AND n.lang IS NOT DISTINCT FROM w.lang AND n.pos = xor(w.pos, 1)
           WHERE w.size > 1),
         climb(leaf_no, lvl, size, pos, proof, here) AS (
           SELECT w.leaf_no, 0, s.size, s.pos, w.proof, w.here FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.size = 1
           UNION ALL
           SELECT w.leaf_no, w.lvl + 1, (w.size + 1) // 2, w.pos // 2, w.proof || coalesce(n.digest, ''),
                  sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(n.digest, '') || here ELSE here || coalesce(n.digest, '') END)
           FROM climb w LEFT JOIN tops n ON n.lvl = w.lvl AND n.pos = xor(w.pos, 1)
           WHERE w.size > 1)
    SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(c.proof) AS proof_sha256, c.here AS folded_root, c.here = t.digest AS verified
    FROM placed p
    JOIN climb c ON c.leaf_no = p.leaf_no AND c.size = 1
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
    CROSS JOIN (SELECT digest FROM tops WHERE size = 1) t"""


def oracle_sql():
    return {"op3_top_k": TOP_K_SQL, "op7_exact_dedup": DEDUP_SQL, "op9_shard": shard_sql(LIMIT_BYTES), "op12_merkle": MERKLE_SQL}

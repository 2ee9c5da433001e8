"""The pipeline's stages against what the operators' plain versions keep."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from edge import SF_DIR
from test_search_and_dedup import brute_near
from tokenizers import Tokenizer

import corpus_pipeline
from filefeatures.llm import quality, toxicity
from filefeatures.session import stage


def test_stages(spark, documents, labels, edge_docs):
    trees, severity = quality.train(documents, labels), toxicity.train(documents, labels)
    rows = {r.doc_id: r for r in documents.collect()}
    texts = {d: (r.text or "").encode() for d, r in rows.items()}
    good = dict(zip(texts, quality.probabilities(trees, list(texts.values())) >= 0.7, strict=True))
    left = {d for d in rows if good[d]}
    clean = {d for d in left if severity.above([texts[d]])[0, 0] < 0.5}
    by_text = {}
    for d in sorted(clean):
        by_text[fold(texts[d])] = d
    single = set(by_text.values())
    near = brute_near([(d, rows[d].text) for d in sorted(single)], 5, 80)
    last = {d for d, size, component in near if size == 0 or d == component}

    docs = documents
    for (name, function), expected in zip(corpus_pipeline.STAGES, [left, clean, single, last], strict=False):
        docs = stage(function(spark, docs, SF_DIR))
        assert docs.dtypes == documents.dtypes
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(expected), name

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        ids = [*tokenizer.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids, 1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        lengths[r.doc_id] += r.length
        assert r.doc_tokens == len(ids)
    assert set(lengths) == last

    for _, function in corpus_pipeline.STAGES[:-1]:
        for odd in (edge_docs, edge_docs.where("doc_id = -1")):
            assert function(spark, odd, SF_DIR).columns == odd.columns
            assert function(spark, odd, SF_DIR).count() <= odd.count()


def fold(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in text)

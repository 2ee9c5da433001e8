"""Packing and byte-level BPE against the tokenizer libraries and brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from edge import ROWS
from tokenizers import Tokenizer

from filefeatures.llm.bpe import Decoder, Encoder, encode_documents, read_ranks
from filefeatures.llm.packing import HARD_SPACING, PER_WINDOW, SMALLEST_POWER, Packer, Plan, WordTokens, cuts_of, pack

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORDS)


def check_pieces(rows, expected):
    """Every id of every document in one piece, no gaps in a sequence, no sequence too long."""
    filled, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        filled[row.sequence_id].append((row.offset, row.length))
        assert row.sequence_length <= 2048
        pieces[row.doc_id, row.doc_tokens].append(row)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
    for doc_id, ids in expected:
        own = sorted(pieces[doc_id, len(ids)], key=lambda r: (r.start, r.sequence_id, r.offset))
        got = defaultdict(int)
        for row in own:
            data = np.array(ids[row.start : row.start + row.length], "<u4").tobytes()
            assert row.ids_crc32 == zlib.crc32(data)
            got[row.start, row.length] += 1
        copies = sum(1 for d, i in expected if d == doc_id and len(i) == len(ids))
        assert sum(row.length for row in own) == copies * len(ids)
    return sum(0 if n & (n - 1) == 0 else 2048 - n for n in (sum(x for _, x in p) for p in filled.values()))


def test_pack_edge_documents(edge_docs, word_tokenizer):
    expected = [(d, [*word_tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in ROWS]
    check_pieces(pack(edge_docs, WORDS).collect(), expected)


def test_pack_documents_with_little_padding(documents, word_tokenizer):
    rows = pack(documents, WORDS, with_ids=True).collect()
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    expected = [(d, [*word_tokenizer.encode(t, add_special_tokens=False).ids, 1]) for d, t in texts.items()]
    padding = check_pieces(rows, expected)
    assert padding < 0.01 * sum(len(ids) for _, ids in expected)
    by_doc = dict(expected)
    assert all(row.ids == by_doc[row.doc_id][row.start : row.start + row.length] for row in rows)


def test_added_tokens_get_the_ids_of_the_unmodified_tokenizer(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>The end.<|endoftext|>.,", "<|ENDOFTEXT|> <|endoftext", "x\n<|endoftext|>\n<|endoftext|>'s"]
    assert 49407 in tokenizer.encode(texts[0], add_special_tokens=False).ids
    expected = [(d, [*tokenizer.encode(t, add_special_tokens=False).ids, 1]) for d, t in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_pieces(pack(docs, WORDS).collect(), expected)


def test_pack_nothing(no_docs):
    assert pack(no_docs, WORDS).count() == 0


def cost_by_brute_force(positions, penalties, size):
    best = [0.0]
    for i in range(1, len(positions)):
        options = []
        for j in range(i):
            n = positions[i] - positions[j]
            if n <= size:
                free = n >= SMALLEST_POWER and n & (n - 1) == 0
                options.append(best[j] + (0 if free else size - n))
        best.append(min(options) + penalties[i] + PER_WINDOW)
    return best


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_the_cheapest(seed):
    draw = random.Random(seed)
    size = draw.choice([64, 128, 256])
    positions = [0]
    while positions[-1] < 20 * size:
        positions.append(positions[-1] + draw.randint(1, 40))
    penalties = [0.0, *(float(draw.choice([0, 4, 32])) for _ in positions[1:])]
    plan = Plan(size)
    plan.push(positions[1:], penalties[1:])
    assert plan.best == pytest.approx(cost_by_brute_force(positions, penalties, size))
    cuts = [0, *(plan.positions[i] for i in plan.cuts())]
    assert cuts[-1] == positions[-1] and all(0 < b - a <= size for a, b in zip(cuts, cuts[1:]))


def test_documents_without_sentences_are_cut_at_a_spacing():
    places, penalties = cuts_of(10 * HARD_SPACING + 3, np.array([], np.int64))
    assert places.tolist()[:2] == [HARD_SPACING, 2 * HARD_SPACING] and places[-1] == 10 * HARD_SPACING + 3
    assert penalties[-1] == 0 and (penalties[:-1] > 0).all()


def test_packer_keeps_the_order():
    packer, out = Packer(256, 0), []
    for doc in range(200):
        ids = np.full(37 * doc % 900 + 1, doc, np.uint32)
        out += packer.add(doc, ids, np.arange(20, len(ids), 20))
    out += packer.finish()
    assert [doc for doc, *_ in out] == sorted(doc for doc, *_ in out)
    assert [(o[5], o[6]) for o in out] == sorted((o[5], o[6]) for o in out)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def test_encode_documents_equals_the_library(documents, edge_docs, library):
    for docs in (documents, edge_docs):
        texts = defaultdict(list)
        for row in docs.collect():
            texts[row.doc_id].append(row.text or "")
        rows = encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
        assert len(rows) == sum(map(len, texts.values()))
        for row in rows:
            assert row.decoded in texts[row.doc_id]
            ids = library.encode_ordinary(row.decoded)
            assert row.ids == ids and row.n_tokens == len(ids)
            assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()


def test_encode_nothing(no_docs):
    assert encode_documents(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_equal_the_library(encoder, library, seed):
    draw = random.Random(seed)
    letters = "ab th'sé \n\r\t  \x1c.,!?12 中文\U0001f600 \x85-"
    for _ in range(2000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 30)))
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_long_matches_come_in_parts(encoder, library):
    draw = random.Random(1)
    text = "".join(draw.choice("abeth") for _ in range(20_000))
    parts = list(encoder.transducer.stream(text.encode()))
    assert len(parts) > 4 and [i for part in parts for i in part] == library.encode_ordinary(text)


def test_decoder_treats_wrong_bytes_as_python_does():
    draw, decoder = random.Random(1), Decoder({i: bytes([i]) for i in range(256)})
    for _ in range(5000):
        data = bytes(draw.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0]) for _ in range(draw.randint(0, 9)))
        assert decoder.text(data) == data.decode("utf-8", "replace")


def test_chunks_are_cut_where_the_pattern_cuts(encoder):
    pattern = regex.compile(public_tokenizers.PATTERN)
    text = "a  b\n\nc \n d's x　y \x1cz   "
    assert [m for chunk in encoder.chunks.findall(text) for m in pattern.findall(chunk)] == pattern.findall(text)


def test_a_part_of_a_word_is_numbered_and_encoded_once():
    tokens, seen = WordTokens(WORDS), []

    def encode(texts):
        seen.append(texts)
        return tokens._ids_of(texts)

    assert tokens._learn_parts(["b", "", "a."], encode).tolist() == [0, 1, 2]
    assert tokens._learn_parts(["a.", "c", "b"], encode).tolist() == [2, 3, 0]
    assert tokens._learn_parts(["c", ""], encode).tolist() == [3, 1]
    assert seen == [["b", "", "a."], ["c"]]
    words = ["Ab", "ab.", "AB.,", "x..", ".,", "Été,", "ab", "5.,", "a<|endoftext|>.", "İ.", "é."]
    whole = tokens.tokenizer
    for text in (" ".join(words[:5]), " ".join(words)):
        [(ids, _)] = tokens.encode(pa.array([text]))
        assert ids.tolist() == [i for word in text.split(" ") for i in whole.encode(word, add_special_tokens=False).ids]


def test_words_share_their_letters_whatever_punctuation_follows():
    tokens, marks = WordTokens(WORDS), "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
    words = [w + end for w in ("ab", "AB", "Été", "5") for end in ("", "%%%", "!!", ".,%", marks, *marks)]
    words += ["", "'", "%%%", "ab's.", "ab'", "a<|endoftext|>%%%", "é!!", "≠", "ab≠"]
    texts = [" ".join(words), "", "ab%%% AB!! %%%", " ab "]
    want = [[i for word in text.split(" ") for i in tokens.tokenizer.encode(word, add_special_tokens=False).ids] for text in texts]
    assert [ids.tolist() for ids, _ in tokens.encode(pa.array(texts))] == want
    fresh = WordTokens(WORDS)
    [(ids, sentences)] = fresh.encode(pa.array(["ab%%% AB!! ab?!? Ab"]))
    assert set(fresh.part_index) == {"ab", "", "%%%", "!!", "?!?"}
    assert ids.tolist() == fresh.tokenizer.encode("ab%%% AB!! ab?!? Ab", add_special_tokens=False).ids
    assert sentences.tolist() == [len(fresh.tokenizer.encode(t, add_special_tokens=False).ids) for t in ("ab%%% AB!!", "ab%%% AB!! ab?!?")]


@pytest.mark.parametrize("seed", range(6))
def test_documents_packed_together_or_one_by_one_give_the_same(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.choice([1, 2, 63, 64, 65, 700, 5_000, 300_000], 60, p=[0.2, 0.1, 0.1, 0.1, 0.1, 0.2, 0.18, 0.02])
    marks = [np.sort(draw.integers(0, n, n // draw.integers(3, 200))) for n in lengths]
    ids, ends = np.arange(lengths.sum(), dtype=np.uint32), np.cumsum(lengths)
    alone, together = Packer(256, 0), Packer(256, 0)
    one_by_one, at_once = [], []
    for doc, (end, n) in enumerate(zip(ends, lengths, strict=True)):
        one_by_one += alone.add(doc, ids[end - n : end], marks[doc])
    for part in (slice(0, 25), slice(25, 26), slice(26, 60)):
        first = ends[part.start] - lengths[part.start]
        sentences = np.concatenate([marks[doc] + ends[doc] - lengths[doc] for doc in range(60)[part]]) - first
        at_once += together.add_all(list(range(60)[part]), ids[first : ends[part.stop - 1]], ends[part] - first, sentences)
    pieces = [[row[:8] for row in (*rows, *packer.finish())] for rows, packer in ((one_by_one, alone), (at_once, together))]
    assert pieces[0] == pieces[1] and sum(row[2] for row in pieces[0]) == lengths.sum()

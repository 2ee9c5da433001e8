"""Near duplicates by SimHash: deletion-variant signatures, an equality join, verification of every candidate.

Fingerprints of 64 bits that differ in at most four bits differ in at most one bit of one of three segments. So each
fingerprint is filed under all its segments with one bit left out: 64 keys, one for each bit. Two fingerprints that share
a key are candidates, and every pair within four bits shares one.

1. One pass makes the fingerprints; equal ones become one node, however many documents carry them.
2. Keys are counted before anything meets. A key of one node is dropped, a key of two is verified on the spot.
3. Of larger keys the members are dealt in blocks, and blocks are compared two by two: a task gives back only links that
   join what it has not yet joined, fewer than it has members.
4. A key of more members than `split` is not compared at all: its members are filed again, by the same rule, under the
   bits outside the segment. That divides them by thousands and loses no pair, as the other bits differ in four at most.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import as_bytes, ascii_lower, slices, text_or_empty
from filefeatures.llm.components import components
from filefeatures.session import stage

SHINGLE_WORDS = 4
MAX_BITS = 4  # three segments; one of them differs in a bit at most
SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit and width
BLOCK = 4096  # members of a key that meet in one comparison, twice
SPLIT = 32_768
TEXT_AT_ONCE = 1 << 20
HASHES_AT_ONCE = 1 << 16

SPACE = re.compile(rb"[\x20\x09-\x0d]")
PRINT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("print", T.LongType())])


def _runs(text: bytes, width: int):
    """The words of a text in runs that share width - 1 words with the run before, so that no shingle is lost or doubled."""
    words, at, given = [], 0, False
    while at < len(text):
        gap = SPACE.search(text, at + TEXT_AT_ONCE) if at + TEXT_AT_ONCE < len(text) else None
        end = gap.start() if gap else len(text)
        words += text[at:end].split()
        at = end
        if len(words) >= width:
            yield words
            given = True
            words = words[len(words) - width + 1 :]
    if words and not given:
        yield words


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each shingle of a lower-cased text, repeats included; a text of fewer words is one shingle."""
    digest, found = xxhash.xxh64_intdigest, []
    for words in _runs(text, width):
        joined = b" ".join(words)
        ends = np.cumsum([len(word) + 1 for word in words])
        last = (ends - 1)[min(width, len(words)) - 1 :].tolist()
        first = [0, *ends.tolist()][: len(last)]
        found.append(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(last)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def fingerprints(texts: list[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """One unsigned fingerprint per text: a bit is set if over half the hashes have it; no words give zero."""
    hashes = [shingle_hashes(ascii_lower(text), width) for text in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    counts = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(flat), HASHES_AT_ONCE):
        own = owner[at : at + HASHES_AT_ONCE]
        bits = np.unpackbits(flat[at : at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        counts[own[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def _print(width: int):
    def run(batches):
        for part in slices(batches):
            prints = fingerprints(as_bytes(part.column("text")), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints)], names=PRINT.names)

    return run


def _variants(bits: Column, segments) -> list[Column]:
    """For each bit, the segment that it lies in without it, and the number of the bit: equal where all else of the segment is."""
    keys = []
    for first, width in segments:
        part = F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        keys += [part.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << i)).cast("long")) + F.lit((first + i) << 22).cast("long") for i in range(width)]
    return keys


def _filed(nodes: DataFrame) -> DataFrame:
    """(key, sub, print): every node under its 64 keys."""
    return nodes.select(F.explode(F.array(*_variants(F.col("print"), SEGMENTS))).alias("key"), F.lit(-1).cast("long").alias("sub"), "print")


def _filed_again(rows: DataFrame) -> DataFrame:
    """(key, sub, print): every member of a key under that key and each of the variants of the bits outside its segment."""
    bit = F.shiftrightunsigned("key", 22)
    out = None
    for first, width in SEGMENTS:
        low = F.col("print").bitwiseAND(F.lit((1 << first) - 1).cast("long"))
        high = F.shiftrightunsigned("print", first + width) if first + width < 64 else F.lit(0).cast("long")
        rest, left = low.bitwiseOR(F.shiftleft(high, first)), 64 - width
        third = left // 3
        subs = F.array(*_variants(rest, ((0, third), (third, third), (2 * third, left - 2 * third))))
        mine = F.when((bit >= first) & (bit < first + width), subs)
        out = mine if out is None else F.coalesce(out, mine)
    return rows.select("key", F.explode(out).alias("sub"), "print")


def _compare(max_bits: int):
    """Links between the members of one (key, sub, i, j): rows sorted by these, in any number of batches."""

    def links(key: np.ndarray, prints: np.ndarray):
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(key)])
        begin, end = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
        group = np.arange(len(key))  # the first member that a member is joined to
        left, right = [], []
        active, step = group.copy(), 1
        while len(active := active[active + step < end[active]]):
            other = active + step
            near = np.bitwise_count(prints[active] ^ prints[other]) <= max_bits
            for a in active[near & (group[active] != group[other])].tolist():
                b = a + step
                if group[a] != group[b]:
                    low, high = sorted((group[a], group[b]))
                    own = group[begin[a] : end[a]]
                    own[own == high] = low
                    left.append(a)
                    right.append(b)
            step += 1
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(prints[left].view(np.int64)), pa.array(prints[right].view(np.int64))], names=["a", "b"])

    def run(batches):
        keys, prints = np.empty((0, 4), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if batch.num_rows:
                keys = np.concatenate([keys, np.stack([batch.column(c).to_numpy() for c in ("key", "sub", "i", "j")], axis=1)])
                prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
                whole = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
                whole = whole[-1] + 1 if len(whole) else 0  # the last key may go on in the next batch
                yield from links(keys[:whole], prints[:whole]) if whole else ()
                keys, prints = keys[whole:], prints[whole:]
        if len(keys):
            yield from links(keys, prints)

    return run


def _meet(rows: DataFrame, max_bits: int, block: int, split: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Links among the members of each (key, sub), and the rows of keys that have more members than `split`."""
    sizes = rows.groupBy("key", "sub").agg(F.count("*").alias("members"), F.min("print").alias("a"), F.max("print").alias("b"))
    sizes = stage(sizes.where("members > 1"), "variant-keys")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    links = sizes.where((F.col("members") == 2) & near).select("a", "b").distinct()
    larger = rows.join(sizes.where("members > 2").select("key", "sub", "members"), ["key", "sub"])
    rest = None
    if split is not None and not sizes.where(F.col("members") > split).isEmpty():
        larger = stage(larger, "variants")
        rest = larger.where(F.col("members") > split).select("key", "print")
        larger = larger.where(F.col("members") <= split)
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.expr("int(pmod(xxhash64(print, 7), blocks))")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: (other != F.col("own")) | (F.col("blocks") == 1))
    pairs = F.transform(others, lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")))
    dealt = larger.withColumn("blocks", blocks).withColumn("own", own).select("key", "sub", "print", F.explode(pairs).alias("pair"))
    dealt = dealt.select("key", "sub", F.col("pair.i").cast("long").alias("i"), F.col("pair.j").cast("long").alias("j"), "print")
    dealt = dealt.repartition("key", "sub", "i", "j").sortWithinPartitions("key", "sub", "i", "j")
    return links.unionByName(dealt.mapInArrow(_compare(max_bits), "a long, b long")), rest


def links(nodes: DataFrame, *, max_bits: int = MAX_BITS, block: int = BLOCK, split: int = SPLIT) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints `print` which chains of at most max_bits differing bits do.

    Not every pair within max_bits is listed: inside one key, a pair that other links join already adds nothing.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"three segments find pairs of up to {MAX_BITS} differing bits")
    found, rest = _meet(_filed(nodes), max_bits, block, split)
    found = stage(found, "print-links")
    if rest is not None:
        found = found.unionByName(stage(_meet(_filed_again(rest), max_bits, block, None)[0], "print-links"))
    return found


def simhash_dedup(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
    split: int = SPLIT,
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id that links lead to).

    Only A-Z are lower-cased; words are what lies between ASCII white space; shingles count as often as they occur. A text
    with fewer words than a shingle is one shingle. NULL, empty and blank texts have the fingerprint zero and are linked
    like any other. Rows that repeat a doc_id or a text each give a row. A NULL doc_id is passed over for component_id
    unless its component has no other. An empty table gives no rows. Other columns than doc_id and text are not read.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    prints = stage(rows.mapInArrow(_print(shingle_words), PRINT), "fingerprints")
    nodes = stage(prints.groupBy("print").agg(F.min("doc_id").alias("lowest")), "print-nodes")
    found = components(links(nodes, max_bits=max_bits, block=block, split=split))
    placed = nodes.join(found, F.col("print") == F.col("node"), "left")
    placed = stage(placed.select("print", "lowest", F.coalesce("component", "print").alias("component")), "print-components")
    named = placed.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = stage(placed.join(named, "component").select("print", "component_id"), "print-names")
    return prints.join(named, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")

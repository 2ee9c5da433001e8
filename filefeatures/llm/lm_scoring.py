"""Code length of whole texts under context-tree weighting, learnt from all training documents.

The text of a document is its words, lower-cased, with one blank between them and an end byte after the last; before it
stand end bytes. Four steps, each a shuffle of compact tables, none of whose keys grows without bound:

1. Every block of documents (some MB, in the order of the input) lists its distinct grams and words with their counts,
   in shares by hash.
2. Per share, counts of all blocks are added up.
3. The context tree is built from the distinct grams: subtrees below two bytes of context by task, and from their sums
   the few nodes above (at most 255 for each byte value, so their broadcast is bounded). The few contexts of two bytes
   that hold many grams each are split once more, into subtrees below three bytes. Each gram gets its log probability:
   also grams that only other documents have.
4. The answers go back to the blocks that asked, and meet the documents there.

A task holds one share or one block's tables at a time. What is gathered grows with the input; nothing is sampled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import as_bytes, ascii_lower, slices, splitmix, text_or_empty
from filefeatures.llm.ctw import BITS, END, Level, Top, Tree, grams, levels_of, node_keys, parent_keys
from filefeatures.llm.superminhash import word_hashes
from filefeatures.session import stage

DEPTH = 5
FOLDS, HELD_OUT_FOLD = 5, 1
BLOCK_BYTES = 32 << 20
SHARES = 512
TOP = 2  # bytes of context that choose a subtree's task
HOT = 256  # a context of two bytes with more than this part of the distinct grams is split; so there are fewer of them
GRAM, WORD = 0, 1
NODE_NAMES = ["key", "zeros", "ones", "longer"]
PLACE_BITS = 16  # grams of five bytes of context have 48 bits

SHARED = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("share", T.IntegerType()),
        T.StructField("block", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("amounts", T.BinaryType()),
    ]
)
COUNTS = T.StructType(
    [
        *SHARED.fields[:2],
        *SHARED.fields[3:],
        T.StructField("distinct", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)
SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def pack(values: np.ndarray) -> bytes:
    """An array as compressed planes of its 1st, 2nd, ... bytes; sorted whole numbers are packed as differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.int64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.int64))


def add_up(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, amounts
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(amounts, starts)


class Sum:
    """Amounts by key, folded whenever as much again has come in."""

    def __init__(self):
        self.keys, self.amounts, self.new, self.waiting = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def add(self, keys: np.ndarray, amounts: np.ndarray) -> None:
        self.new.append((keys, amounts))
        self.waiting += len(keys)
        if self.waiting > max(1 << 20, len(self.keys)):
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [(self.keys, self.amounts), *self.new]
        self.keys, self.amounts = add_up(np.concatenate([k for k, _ in parts]), np.concatenate([a for _, a in parts]))
        self.new, self.waiting = [], 0
        return self.keys, self.amounts


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


def words_of(text: bytes) -> list[bytes]:
    return ascii_lower(text).split()


def word_keys(texts: list[list[bytes]]) -> np.ndarray:
    """64-bit hashes of the words of texts, one after another, and after each text of its end (as the empty word)."""
    return word_hashes([word for words in texts for word in (*words, b"")]).view(np.int64)


def gram_keys(words: list[bytes], depth: int) -> np.ndarray:
    end = bytes([END])
    return grams(np.frombuffer(end * depth + b" ".join(words) + end, np.uint8).astype(np.int64), depth)


def _share_of(keys: np.ndarray, shares: int) -> np.ndarray:
    return (splitmix(keys.view(np.uint64)) % np.uint64(shares)).astype(np.int32)


def _blocked(batches, block_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices with their block: how far the bytes before a row reach in its partition. Batch borders play no part."""
    first, before = TaskContext.get().partitionId() << 24, 0
    for part in slices(batches):
        sizes = np.fromiter((len(t) for t in as_bytes(part.column("text"))), np.int64, part.num_rows)
        numbers = (before + np.cumsum(sizes) - sizes) // block_bytes
        before += int(sizes.sum())
        starts = np.flatnonzero(np.diff(numbers, prepend=-1))
        for begin, end in zip(starts, [*starts[1:], part.num_rows], strict=True):
            yield first + int(numbers[begin]), part.slice(int(begin), int(end - begin))


def _by_block(batches) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of placed rows with their block. A block may come in several tasks: each asks for what its rows need."""
    for part in slices(batches):
        blocks = part.column("block").to_numpy()
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        for begin, end in zip(starts, [*starts[1:], part.num_rows], strict=True):
            yield int(blocks[begin]), part.slice(int(begin), int(end - begin))


def look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The values of the keys asked for; keys are sorted. A key that is not there is an error.

    Where keys leave room for it, some are sorted together with their places: each is then looked for once, and neighbours
    one after the other, which finds them in the cache.
    """
    if not len(asked):
        return values[:0]
    if int(asked.min()) < 0 or int(asked.max()) >> 64 - PLACE_BITS:
        at = pc.index_in(pa.array(asked), value_set=pa.array(keys))
        if at.null_count:
            raise ValueError("a key has no answer")
        return values[at.to_numpy()]
    found, size = np.empty(len(asked), values.dtype), 1 << PLACE_BITS
    for begin in range(0, len(asked), size):
        part = asked[begin : begin + size].astype(np.uint64)
        packed = np.sort(part << np.uint64(PLACE_BITS) | np.arange(len(part), dtype=np.uint64))
        ordered, place = (packed >> np.uint64(PLACE_BITS)).astype(np.int64), (packed & np.uint64(size - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        at = np.searchsorted(keys, ordered[first])
        if int(at[-1]) >= len(keys) or (keys[at] != ordered[first]).any():
            raise ValueError("a key has no answer")
        found[begin + place] = np.repeat(values[at], np.diff(first, append=len(part)))
    return found


def _occurrences(depth: int, shares: int):
    """What each block asks for: its distinct grams and words, with how often its training documents have them."""

    def emit(block: int, sums: list[Sum]):
        for kind, total in enumerate(sums):
            keys, amounts = total.fold()
            share = _share_of(keys, shares)
            order = np.argsort(share, kind="stable")
            cuts = np.searchsorted(share[order], np.arange(shares + 1))
            rows = []
            for s in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[s] : cuts[s + 1]]  # still sorted by key
                rows.append((kind, int(s), block, pack_keys(keys[own]), pack(amounts[own].astype(np.uint32))))
            if rows:
                yield _batch(rows, SHARED)

    def run(batches):
        block, sums = None, []
        for number, part in _by_block(batches):
            if number != block and block is not None:
                yield from emit(block, sums)
            if number != block:
                block, sums = number, [Sum(), Sum()]
            sides: dict[bool, list[list[bytes]]] = {}
            for doc_id, text in zip(part.column("doc_id").to_pylist(), as_bytes(part.column("text")), strict=True):
                sides.setdefault(is_held_out(doc_id), []).append(words_of(text))
            for held, texts in sides.items():
                for kind, keys in ((GRAM, np.concatenate([gram_keys(words, depth) for words in texts])), (WORD, word_keys(texts))):
                    found, amounts = np.unique(keys, return_counts=True)
                    sums[kind].add(found, amounts * (not held))
        if block is not None:
            yield from emit(block, sums)

    return run


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"integer": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kinds[f.dataType.typeName()]) for c, f in zip(columns, schema.fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _runs(batches, names: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(key, row) for rows sorted by key, row by row; rows are packed arrays, so there are few."""
    for batch in batches:
        for row in batch.to_pylist():
            yield tuple(row[n] for n in names), row


def _add_shares(batches):
    key, total = None, Sum()

    def emit():
        keys, amounts = total.fold()
        known = amounts > 0
        return _batch([(*key, pack_keys(keys), pack(amounts), int(known.sum()), int(amounts.sum()))], COUNTS)

    for now, row in _runs(batches, ["kind", "share"]):
        if now != key:
            if key is not None:
                yield emit()
            key, total = now, Sum()
        total.add(unpack_keys(row["keys"]), unpack(row["amounts"], np.uint32).astype(np.int64))
    if key is not None:
        yield emit()


def _unpacked(batches):
    for batch in batches:
        for row in batch.to_pylist():
            keys = unpack_keys(row["keys"])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(unpack(row["amounts"], np.int64))], names=["gram", "seen"])


def _subtree(batches, depth: int, shortest: int) -> tuple[np.ndarray, Tree] | None:
    parts = [(b.column("gram").to_numpy(), b.column("seen").to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return None
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    return keys, Tree(keys, counts, depth, shortest)


def _for_parents(level: Level) -> tuple[np.ndarray, ...]:
    """By the keys of the nodes one byte shorter: zeros, ones, and the log of the product of what is weighted below."""
    up, back = np.unique(parent_keys(level.keys), return_inverse=True)
    return up, *(np.bincount(back, weights=x, minlength=len(up)) for x in (level.zeros, level.ones, level.log_pw))


def _sums_for_top(depth: int, shortest: int):
    def run(batches):
        made = _subtree(batches, depth, shortest)
        if made is None:
            return
        for bits in range(BITS):
            yield pa.RecordBatch.from_arrays([*map(pa.array, _for_parents(made[1].levels[shortest, bits]))], names=NODE_NAMES)

    return run


class Above:
    """The nodes above the subtrees: those of hot contexts of TOP bytes, and all shorter ones."""

    def __init__(self, cold: list[np.ndarray], hot: list[np.ndarray]):
        """Sums by parent (key, zeros, ones, longer): of subtrees below TOP bytes, and of those below one byte more."""
        self.hot = levels_of(*hot)
        parts = [cold, *(_for_parents(level) for level in self.hot.values())]
        keys = np.concatenate([part[0] for part in parts])
        up, back = np.unique(keys, return_inverse=True)
        sums = [np.bincount(back, weights=np.concatenate([part[i] for part in parts]), minlength=len(up)) for i in (1, 2, 3)]
        self.top = Top(TOP, up, *sums)

    def mix(self, grams_: np.ndarray, depth: int, bits: int, longer: np.ndarray, hot: bool) -> np.ndarray:
        if hot:
            bit = (grams_ >> (BITS - 1 - bits)) & 1
            longer = self.hot[bits].mix(node_keys(grams_, depth, TOP, bits), bit, longer)
        return self.top.mix(grams_, depth, bits, longer)


def _probabilities(depth: int, shares: int, above: Above, hot: bool):
    def run(batches):
        made = _subtree(batches, depth, TOP + hot)
        if made is None:
            return
        keys, tree = made
        log10 = np.zeros(len(keys))
        for bits in range(BITS):
            log10 += np.log10(above.mix(keys, depth, bits, tree.bit_probabilities(keys, bits), hot))
        share = _share_of(keys, shares)
        order = np.argsort(share, kind="stable")
        cuts = np.searchsorted(share[order], np.arange(shares + 1))
        rows = []
        for s in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[s] : cuts[s + 1]]
            rows.append((GRAM, int(s), pack_keys(keys[own]), pack(log10[own])))
        yield _batch(rows, T.StructType([*SHARED.fields[:2], *SHARED.fields[3:]]))

    return run


def _answer(batches):
    """Per share: the answers (which sort first), then for each block that asked, the answers to its keys."""
    key, parts, table = None, [], None
    for now, row in _runs(batches, ["kind", "share"]):
        if now != key:
            key, parts, table = now, [], None
        kind = np.float64 if now[0] == GRAM else np.int64
        keys = unpack_keys(row["keys"])
        if row["block"] is None:
            parts.append((keys, unpack(row["amounts"], kind)))
            continue
        if table is None:
            known, values = np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts])
            order = np.argsort(known)
            table, parts = (known[order], values[order]), []
        found = look_up(*table, keys)
        found = found.astype(np.float32 if now[0] == GRAM else np.uint32 if found.max() < 1 << 32 else np.int64)
        yield _batch([(now[0], now[1], row["block"], row["keys"], found.dtype.char.encode() + pack(found))], SHARED)


def _score(depth: int, total: int, distinct: int):
    """Rows of a block: the answers, then its documents."""

    def table(parts: list[tuple[np.ndarray, np.ndarray]]):
        keys, values = np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts])
        order = np.argsort(keys)
        return keys[order], values[order].astype(np.float64)

    def run(batches):
        block, parts, tables = None, ([], []), None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
            for begin, end in zip(starts, [*starts[1:], len(blocks)], strict=True):
                own = batch.slice(int(begin), int(end - begin))
                if blocks[begin] != block:
                    block, parts, tables = blocks[begin], ([], []), None
                kinds = own.column("kind").to_numpy(zero_copy_only=False)
                answers = int((kinds < 2).sum())  # they sort before the documents
                for row in own.slice(0, answers).select(["kind", "keys", "amounts"]).to_pylist():
                    data = row["amounts"]
                    parts[row["kind"]].append((unpack_keys(row["keys"]), unpack(data[1:], np.dtype(data[:1].decode()).type)))
                if answers == own.num_rows:
                    continue
                if tables is None:
                    tables, parts = [table(p) for p in parts], ([], [])
                for part in slices([own.slice(answers)]):
                    yield _batch(list(score_rows(part, tables)), SCORES)

    def score_rows(part: pa.RecordBatch, tables):
        texts = [words_of(text) for text in as_bytes(part.column("text"))]
        keys = [gram_keys(words, depth) for words in texts]
        lengths, tokens = np.array([len(k) for k in keys]), np.array([len(words) + 1 for words in texts])
        scores = sums(look_up(*tables[GRAM], np.concatenate(keys)), lengths)
        counts = look_up(*tables[WORD], word_keys(texts))
        bases = sums(np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1))), tokens)
        known = sums((counts > 0).astype(np.int64), tokens)
        bits = -scores / np.log10(2) / lengths
        for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
            yield doc_id, is_held_out(doc_id), int(tokens[i]), int(known[i]), total, float(bases[i]), float(scores[i]), float(bits[i])

    def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each text's values; a text has its end at least, so none is empty."""
        return np.add.reduceat(values, np.cumsum(lengths) - lengths)

    return run


def score(
    docs: DataFrame, *, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, shares: int = SHARES, hot_part: int = HOT
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), bits_per_byte.

    Documents whose crc32 of the id leaves 1 modulo 5 are held out: scored, not learnt from. NULL text counts as empty:
    one token, the end. A NULL doc_id is learnt from; rows that repeat one are separate documents. Without any training
    document every bit has probability 1/2 and the base is that of its formula. An empty table gives no rows. Other
    columns than doc_id and text are not read.
    """
    if not TOP <= depth <= 6:
        raise ValueError(f"depth must be {TOP} to 6")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))

    def blocked(batches):
        for block, part in _blocked(batches, block_bytes):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block)), part.column("doc_id"), part.column("text")], names=["block", "doc_id", "text"])

    # Written once: every later job reads the block with its row, however files are split by then.
    placed = stage(texts.mapInArrow(blocked, "block long, doc_id long, text string"), "placed")
    asked = stage(placed.mapInArrow(_occurrences(depth, shares), SHARED), "occurrences")
    by_share = asked.drop("block").repartition("kind", "share").sortWithinPartitions("kind", "share")
    counts = stage(by_share.mapInArrow(_add_shares, COUNTS), "counts")
    word_sums = counts.where(F.col("kind") == WORD).agg(F.sum("distinct"), F.sum("total")).first()
    distinct, total = (int(x or 0) for x in word_sums)

    unpacked = counts.where(F.col("kind") == GRAM).select("keys", "amounts").mapInArrow(_unpacked, "gram long, seen long")
    context = F.shiftright("gram", 8 * (depth + 1 - TOP))
    sizes = dict(map(tuple, unpacked.groupBy(context.alias("context")).count().collect())) if depth > TOP else {}
    # Fewer than HOT contexts can be hot, and there are 65,536 at most.
    hot = sorted(c for c, size in sizes.items() if size * hot_part > sum(sizes.values()))
    is_hot = context.isin(hot) if hot else F.lit(False)
    subtrees = {False: unpacked.where(~is_hot).repartition(context)}
    if hot:
        subtrees[True] = unpacked.where(is_hot).repartition(F.shiftright("gram", 8 * (depth - TOP)))

    def sums(split: bool) -> list[np.ndarray]:
        """One row per node with one byte of context, or with those of a hot one: 256 * 255 at most, whatever the corpus."""
        if split not in subtrees:
            return [np.empty(0, np.int64), np.empty(0), np.empty(0), np.empty(0)]
        found = subtrees[split].mapInArrow(_sums_for_top(depth, TOP + split), "key long, zeros double, ones double, longer double")
        found = found.groupBy("key").agg(*(F.sum(c).alias(c) for c in NODE_NAMES[1:])).toPandas().sort_values("key")
        return [found[c].to_numpy() for c in NODE_NAMES]

    above = Above(sums(False), sums(True))
    answers = T.StructType(SHARED.fields[:2] + SHARED.fields[3:])
    gram_answers = reduce(DataFrame.unionByName, [rows.mapInArrow(_probabilities(depth, shares, above, split), answers) for split, rows in subtrees.items()])
    word_answers = counts.where(F.col("kind") == WORD).select("kind", "share", "keys", "amounts")
    known = gram_answers.unionByName(word_answers).withColumn("block", F.lit(None).cast("long"))
    together = known.unionByName(asked).repartition("kind", "share").sortWithinPartitions("kind", "share", "block")
    returned = together.select(SHARED.names).mapInArrow(_answer, SHARED)

    rows = placed.withColumn("kind", F.lit(2)).unionByName(returned.drop("share"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_score(depth, total, distinct), SCORES)

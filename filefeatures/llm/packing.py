"""Pack token sequences into windows: order-preserving dynamic programming over cut positions.

Documents follow one another in the order of their partition. A cut may lie at the end of a document (free), at the end
of a sentence (a small penalty), or, where a document has neither for long, at a fixed spacing (a larger one). A window
of n tokens costs its padding: size - n, or nothing where n is a power of two. The cheapest cuts follow from

    best(i) = penalty(i) + per_window + min over windows (j, i] of best(j) + padding(i - j)

Without powers of two the minimum is that of best(j) + position(j) over a sliding range, which a monotone queue gives in
constant time per cut; the powers of two are a fixed number of look-ups. Each partition is packed by itself, so nothing
is shuffled, and holds some windows of ids at a time.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import defaultdict, deque
from collections.abc import Generator, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from filefeatures.llm.arrow import kept_in_worker, slices, text_or_empty

SIZE = 2048
END_ID = 1
SENTENCE_PENALTY = 4
HARD_PENALTY = 32
PER_WINDOW = 16  # keeps the plan from dissolving into many tiny windows
HARD_SPACING = 64
SMALLEST_POWER = 32
HORIZON = 32  # windows that are planned together
WORDS_KEPT = 1_000_000
PART_BYTES = 2 << 20  # of text, whose ids are worked out together
# Letters up to U+024F: none has marks to compose, and lower case is letter for letter (U+0130 is left out for that).
LETTER = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]"
LETTERS = f"^{LETTER}+$"
ENDINGS = string.punctuation.replace("'", "")  # what may follow a word's letters; an apostrophe may belong to them

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("sequence_length", T.LongType()),
    ]
)
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def _numbers() -> defaultdict:
    """Numbers from 0 on for keys in the order in which they are first asked for."""
    return defaultdict(count().__next__)


def _listed(words: pa.Array) -> list[bytes]:
    """Words, which hold no line break, as Python's bytes; much faster than one by one."""
    words = pc.cast(words, pa.binary())
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), b"\n")[0].as_py().split(b"\n") if len(words) else []


class _Ids:
    """Token ids by number: one flat array, and where each number's ids end."""

    def __init__(self):
        self.flat, self.counts, self.ends = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
        self.counts = np.concatenate([self.counts, counts])
        self.ends = np.cumsum(self.counts)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers, one after another, and how many there are up to the end of each."""
        counts = self.counts[numbers]
        after = np.cumsum(counts)
        total = int(after[-1]) if len(after) else 0
        # The k-th id belongs to some number; it lies as far from that number's last id as k from its end.
        return self.flat[np.arange(total) + np.repeat(self.ends[numbers] - after, counts)], after


class WordTokens:
    """Token ids by white-space separated word; a tokenizer whose tokens never span white space gives the same ids for
    a text as for its words one by one. Words seen before are looked up; the table starts anew when it is full.

    With a tokenizer that ignores case and separates letters from punctuation, words that differ only in capitals and
    in punctuation at their end share the work: the tokenizer sees their letters once. A word that holds an added token
    of the tokenizer (as <|endoftext|>) goes to it alone and as it is.
    """

    def __init__(self, path: str, keep: int = WORDS_KEPT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if any(re.search(r"\s", token) for token in added):
            raise ValueError("an added token of the tokenizer spans white space")
        self.added = "|".join(map(re.escape, added))  # without regard to case: alone, any word gets its right ids

        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids

        self.shares = ids("Ab") == ids("ab") and all(ids("\u00c9t" + end) == ids("\u00e9t") + ids(end) for end in (*ENDINGS, ENDINGS))
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.keep = keep
        self._clear()

    def _clear(self) -> None:
        self.index, self.words, self.sentence = _numbers(), _Ids(), np.empty(0, bool)
        self.part_index, self.parts = _numbers(), _Ids()

    def start(self) -> None:
        """Between slices: make room if the table is full."""
        if len(self.index) > self.keep:
            self._clear()

    def _learn(self, words: pa.Array) -> None:
        cores = pc.utf8_rtrim(words, characters=ENDINGS)
        simple = pc.match_substring_regex(cores, LETTERS) if self.shares else pa.array(np.zeros(len(words), bool))
        if self.added:
            simple = pc.and_not(simple, pc.match_substring_regex(words, self.added, ignore_case=True))
        keys = pc.if_else(simple, pc.utf8_lower(cores), words).dictionary_encode()
        distinct = keys.dictionary
        letters = pc.match_substring_regex(distinct, LETTERS).to_numpy(zero_copy_only=False) & self.shares
        alone = np.zeros(len(distinct), bool)
        if self.added:
            alone = pc.match_substring_regex(distinct, self.added, ignore_case=True).to_numpy(zero_copy_only=False)
        ways, numbers = np.where(alone, 2, np.where(letters, 0, 1)), np.empty(len(distinct), np.int64)
        for way, encode in enumerate((self._ids_of_letters, self._ids_of, self._ids_alone)):
            texts = [text.decode() for text in _listed(distinct.filter(pa.array(ways == way)))]
            numbers[ways == way] = self._learn_parts(texts, encode)
        # Most words have nothing after their letters.
        longer = pc.and_(simple, pc.not_equal(pc.binary_length(words), pc.binary_length(cores)))
        ends = pc.replace_substring_regex(words.filter(longer), f"^{LETTER}+", "").dictionary_encode()
        known = self._learn_parts(["", *ends.dictionary.to_pylist()], self._ids_of)
        pairs = np.full((len(words), 2), known[0], np.int64)
        pairs[:, 0] = numbers[keys.indices.to_numpy()]
        pairs[longer.to_numpy(zero_copy_only=False), 1] = known[1:][ends.indices.to_numpy()]
        ids, after = self.parts.of(pairs.ravel())
        self.words.add(ids, np.diff(after[1::2], prepend=0))
        self.sentence = np.concatenate([self.sentence, pc.match_substring_regex(words, "[.!?]$").to_numpy(zero_copy_only=False)])

    def _learn_parts(self, texts: list[str], encode) -> np.ndarray:
        """The numbers of these distinct texts; those that are new are encoded."""
        known = len(self.part_index)
        numbers = np.fromiter(map(self.part_index.__getitem__, texts), np.int64, len(texts))
        if len(self.part_index) > known:
            self.parts.add(*encode(list(compress(texts, numbers >= known))))
        return numbers

    def _ids_of_letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts for words of letters alone: each ends with a token that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(self.ends_word[ids]) + 1
        if len(cuts) != len(texts):  # a tokenizer that marks word ends in another way
            return self._ids_of(texts)
        return ids, np.diff(cuts, prepend=0)

    def _ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoding = self.tokenizer.encode("\n".join(texts), add_special_tokens=False)
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
        places = np.fromiter((begin for begin, _ in encoding.offsets), np.int64, len(encoding.ids))
        return np.array(encoding.ids, np.uint32), np.diff(np.searchsorted(places, begins))

    def _ids_alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each word by itself: an added token may take the white space beside it, or end a word without its mark."""
        found = [self.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, one after another; after how many ids each text ends; after how many each sentence ends;
        and how many sentences each text has."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        known, words = len(self.index), _listed(coded.dictionary)
        numbers = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if len(self.index) > known:
            self._learn(coded.dictionary.filter(pa.array(numbers >= known)))
        every = numbers[coded.indices.to_numpy()]
        ids, after = self.words.of(every)
        closes = self.sentence[every]
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        counts = np.diff(np.concatenate([[0], np.cumsum(closes)])[ends], prepend=0)
        return ids, np.concatenate([[0], after])[ends], after[closes], counts

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and after how many ids its sentences end."""
        ids, ends, sentences, counts = self.encode_all(texts)
        first = 0
        for begin, end, count in zip([0, *ends[:-1]], ends, counts, strict=True):
            yield ids[begin:end], sentences[first : first + count] - begin
            first += count


def word_tokens(path: str) -> WordTokens:
    """One table per Python worker, which later tasks go on with."""
    return kept_in_worker(("word tokens", path), lambda: WordTokens(path))


def _counted(counts: np.ndarray) -> np.ndarray:
    """1, 2, .. up to each of the counts, one after another."""
    return np.arange(1, counts.sum() + 1) - np.repeat(np.cumsum(counts) - counts, counts)


def cuts_of(ends: int | np.ndarray, sentences: np.ndarray, spacing: int = HARD_SPACING) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cut positions in documents that lie one after another up to these ends (which are cuts), and the penalty of
    each."""
    ends = np.atleast_1d(ends)
    marks = np.unique(np.concatenate([[0], sentences[sentences < ends[-1]], ends]))
    gaps = np.diff(marks)
    places, penalties = marks[1:], np.full(len(marks) - 1, float(SENTENCE_PENALTY))
    penalties[np.searchsorted(places, ends)] = 0
    if gaps.max() > spacing:
        counts = (gaps - 1) // spacing
        hard = np.repeat(marks[:-1], counts) + spacing * _counted(counts)
        order = np.argsort(np.concatenate([places, hard]), kind="stable")
        places = np.concatenate([places, hard])[order]
        penalties = np.concatenate([penalties, np.full(len(hard), float(HARD_PENALTY))])[order]
    return places, penalties


class Plan:
    """Cheapest cuts, found while positions arrive. Positions are counted from the last cut that is settled."""

    def __init__(self, size: int, per_window: float = PER_WINDOW):
        self.size, self.per_window = size, per_window
        self.powers = np.array([1 << k for k in range(size.bit_length()) if SMALLEST_POWER <= 1 << k < size], np.int64)
        self.restart([], [])

    def restart(self, positions: list[int], penalties: list[float]) -> None:
        self.positions, self.penalties, self.best, self.back = [0], [0.0], [0.0], [-1]
        self.at = np.full(1, 0)  # the number of the cut at a position, or -1
        self.queue = deque([(0.0, 0, 0)])  # (best + position, position, number) of cuts in reach, both rising
        self.push(positions, penalties)

    def push(self, positions: list[int], penalties: list[float]) -> None:
        queue, best, back_of, size, per_window = self.queue, self.best, self.back, self.size, self.per_window
        number, first = len(best), 0
        powers, counts = self._powers_before(positions)
        for position, penalty, count in zip(positions, penalties, counts, strict=True):
            reach = position - size
            while queue[0][1] < reach:
                queue.popleft()
            cost, _, back = queue[0]
            cost -= reach
            if count:
                for j in powers[first : first + count]:
                    if best[j] < cost:
                        cost, back = best[j], j
                first += count
            cost += penalty + per_window
            best.append(cost)
            back_of.append(back)
            value = cost + position
            while queue and queue[-1][0] >= value:
                queue.pop()
            queue.append((value, position, number))
            number += 1
        self.positions += positions
        self.penalties += penalties

    def _powers_before(self, positions: list[int]) -> tuple[list[int], list[int]]:
        """The numbers of the cuts that lie a power of two before each of these positions, and how many each has."""
        if not positions:
            return [], []
        new, number, room = np.array(positions), len(self.best), len(self.at)
        if new[-1] >= room:
            self.at = np.concatenate([self.at, np.full(max(room, new[-1] + 1 - room), -1)])
        self.at[new] = np.arange(number, number + len(new))
        before = new[:, None] - self.powers
        found = np.where(before >= 0, self.at[np.maximum(before, 0)], -1)
        return found[found >= 0].tolist(), (found >= 0).sum(axis=1).tolist()

    def cuts(self) -> list[int]:
        """Numbers of the cuts of the cheapest plan up to the last position."""
        found, number = [], len(self.positions) - 1
        while number > 0:
            found.append(number)
            number = self.back[number]
        return found[::-1]


class Packer:
    def __init__(self, size: int, first_sequence: int):
        self.plan, self.size, self.sequence = Plan(size), size, first_sequence
        self.pending: deque = deque()  # (doc_id, ids, ids that are already packed)
        self.end = 0

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        return self.add_all([doc_id], ids, np.array([len(ids)]), sentences)

    def add_all(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        """Documents whose ids lie one after another up to these ends; none is without ids."""
        places, penalties = cuts_of(ends, sentences)
        for doc_id, begin, end in zip(doc_ids, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            self.pending.append((doc_id, ids[begin:end], 0))
        shift, step = self.end, HORIZON * self.size
        # Windows may be settled after each document; a very long one is planned in parts.
        lasts, part = np.searchsorted(places, ends) + 1, step // HARD_SPACING
        firsts = np.concatenate([[0], lasts[:-1]])
        parts = -(-(lasts - firsts) // part)
        stops = np.minimum(np.repeat(firsts, parts) + part * _counted(parts), np.repeat(lasts, parts))
        after, begin, done = places[stops - 1], 0, 0
        while done < len(stops):
            done = min(max(done, int(np.searchsorted(after, step - shift, side="right"))), len(stops) - 1) + 1
            end = stops[done - 1]
            self.plan.push((places[begin:end] + shift).tolist(), penalties[begin:end].tolist())
            begin = end
            if self.plan.positions[-1] > step:
                cuts = self.plan.cuts()
                shift -= yield from self._settle(cuts[: max(1, len(cuts) - 2)])
        self.end = shift + int(ends[-1])

    def finish(self) -> Iterator[tuple]:
        """The last windows. What is left at the end may be too short for a window: it is cut into powers of two, which need
        no padding, where that costs less."""
        if not self.end:
            return
        cuts, begin = self.plan.cuts(), 0
        if len(cuts) > 1:
            begin = yield from self._settle(cuts[:-1])
        rest = self.end - begin
        powers = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        if (len(powers) - 1) * (HARD_PENALTY + self.plan.per_window) >= self.size - rest:
            powers = [rest]
        for length in powers:
            yield from self._window(length)

    def _settle(self, cuts: list[int]) -> Generator[tuple, None, int]:
        """Deliver the windows up to these cuts; returns by how much positions are smaller from then on."""
        plan, begin = self.plan, 0
        for number in cuts:
            yield from self._window(plan.positions[number] - begin)
            begin = plan.positions[number]
        plan.restart([p - begin for p in plan.positions[cuts[-1] + 1 :]], plan.penalties[cuts[-1] + 1 :])
        return begin

    def _window(self, length: int) -> Iterator[tuple]:
        offset = 0
        while offset < length:
            doc_id, ids, done = self.pending.popleft()
            taken = min(len(ids) - done, length - offset)
            piece = ids[done : done + taken]
            yield doc_id, done, taken, zlib.crc32(piece.astype("<u4", copy=False)), len(ids), self.sequence, offset, length, piece
            if done + taken < len(ids):
                self.pending.appendleft((doc_id, ids, done + taken))
            offset += taken
        self.sequence += 1


def pack(docs: DataFrame, tokenizer: str, *, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document and window; with_ids adds the token ids of the piece.

    NULL text counts as empty: its document is the end id alone. NULL and repeated doc_id are carried along: every row
    is packed by itself. An empty table gives no rows. Other columns than doc_id and text are not read.

    tokenizer is the file of a tokenizer whose tokens do not span white space. A sequence id holds the number of the
    partition in its upper bits, so sequences of all partitions differ.
    """
    keep = T.StructType([*SCHEMA.fields, IDS]) if with_ids else SCHEMA

    def run(batches):
        words = word_tokens(tokenizer)
        packer = Packer(size, TaskContext.get().partitionId() << 33)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(column, pa.int64()) for column in columns[:8]]
            if with_ids:
                arrays.append(pa.array([piece.astype(np.int32) for piece in columns[8]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=keep.names)

        for part in slices(batches, max_bytes=PART_BYTES):
            words.start()
            ids, ends, sentences, counts = words.encode_all(part.column("text"))
            before = np.arange(len(ends))  # end ids before a text
            rows = list(
                packer.add_all(
                    part.column("doc_id").to_pylist(), np.insert(ids, ends, end_id), ends + before + 1, sentences + np.repeat(before, counts)
                )
            )
            if rows:
                yield batch_of(rows)
        if rows := list(packer.finish()):
            yield batch_of(rows)

    # A whole slice is packed between two outputs, so the plan may run ahead of what is delivered.
    return docs.select(docs["doc_id"].cast("long"), text_or_empty(docs).alias("text")).mapInArrow(run, keep)

"""Byte-level BPE as a finite-state transducer that is made deterministic while it runs, and a streaming decoder.

Merging by rank gives t1 .. tk exactly if every neighbouring pair stands, that is, if the bytes of the pair merge back
into the same two tokens. So each prefix of a text has one last token, and a text can be read from left to right. After
some bytes, the open ends are the places at which a token may still be growing: each is a node in the trie of tokens and
the token before it. A set of open ends is a state; a byte leads to the next state and gives the last token of the
longer prefix. States and moves are worked out the first time that a text needs them, and looked up afterwards. What
lies before the place where the paths to all open ends meet can no longer change and is emitted.

Decoding goes token by token through a state machine over UTF-8 byte classes, whose moves are kept per state and token.

A pattern cuts a text at white space at least (CHUNK says where), so texts are cut into stretches that are encoded each by
itself, and looked up when seen before.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from filefeatures.llm.arrow import kept_in_worker, slices, text_or_empty

CHUNKS_KEPT = 300_000
MATCHES_KEPT = 300_000
STATES_KEPT = 400_000
LONG_TEXT = 1 << 20  # code points; longer texts are cut into stretches bit by bit
CHUNKS_AT_ONCE = 1 << 18
SETTLE = 4096
# White space in the sense of Unicode's White_Space property; Python's \s has four control characters more.
SPACE = r"\t-\r \x85\xa0  -     　"
# Cuts a text at some of the places where PATTERN cuts it: matches never go on over white space but for one leading blank.
CHUNK = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.StringType())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.never = 1 + max(ranks.values())
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length_of = {rank: len(token) for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.depth, self.token_at = [0], [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                child = self.children[node].get(byte)
                if child is None:
                    child = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.token_at.append(-1)
                node = child
            self.token_at[node] = rank
        self.last_merge: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((0, -1),)
        self.states, self.number, self.moves = [start], {start: 0}, [{}]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; () for a byte, None for a token that no merge makes."""
        if token not in self.last_merge:
            data, halves = self.bytes_of[token], None
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                ranked = [(self.ranks.get(left + right, self.never), i) for i, (left, right) in enumerate(zip(parts, parts[1:], strict=False))]
                rank, i = min(ranked)
                if rank >= token:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:
                halves = ()
            elif len(parts) == 2:
                halves = (self.ranks[parts[0]], self.ranks[parts[1]])
            self.last_merge[token] = halves
        return self.last_merge[token]

    def _stands(self, left: int, right: int) -> bool:
        """Whether the two stay apart. Going back in time from the whole tokens, the one that was made later is taken
        apart, and the parts that then touch must not merge before the merge that they went into."""
        found = self.pairs.get((left, right))
        if found is None:
            a, b, a_used, b_used = left, right, self.never, self.never
            found = True
            while found:
                both = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], self.never)
                found = not (both < a_used and both <= b_used and both < self.never)
                if self.length_of[b] > 1 and (self.length_of[a] == 1 or b >= a):
                    b, b_used = self._halves(b)[0], b
                elif self.length_of[a] > 1:
                    a, a_used = self._halves(a)[1], a
                else:
                    break
            self.pairs[left, right] = found
        return found

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        ends, last = [], -1
        children, token_at, pairs, merges = self.children, self.token_at, self.pairs, self.last_merge
        for end in self.states[state]:  # the longest first
            node, before = end
            child = children[node].get(byte)
            if child is None:
                continue
            if last < 0 <= (token := token_at[child]):
                made = merges[token] if token in merges else self._halves(token)
                if made is not None:
                    stands = True if before < 0 else pairs.get((before, token))
                    if self._stands(before, token) if stands is None else stands:
                        last = token
            if children[child]:
                ends.append((child, before))
        if last < 0:
            raise ValueError(f"no token for byte {byte}")
        new = (*ends, (0, last))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
            self.moves.append({})
        return number, last

    def stream(self, data: bytes, settle: int = SETTLE) -> Iterator[list[int]]:
        """The ids of one match, in parts: all that is certain after every so many bytes, the rest at the end."""
        if len(self.states) > STATES_KEPT:
            self._forget()
        moves, state, lasts = self.moves, 0, [-1]  # lasts: by position after what was emitted, the last token there
        for byte in data:
            move = moves[state].get(byte)
            if move is None:
                move = moves[state][byte] = self._move(state, byte)
            state, last = move
            lasts.append(last)
            if len(lasts) > settle:
                paths = [self._path(lasts, len(lasts) - 1 - self.depth[node]) for node, _ in self.states[state]]
                certain = 0
                for tokens in zip(*paths, strict=False):
                    if len(set(tokens)) > 1:
                        break
                    certain += 1
                if emitted := paths[0][:certain]:
                    yield emitted
                    lasts = lasts[sum(map(self.length_of.__getitem__, emitted)) :]
        yield self._path(lasts, len(lasts) - 1)

    def _path(self, lasts: list[int], position: int) -> list[int]:
        found = []
        while position > 0:
            found.append(lasts[position])
            position -= self.length_of[lasts[position]]
        return found[::-1]

    def encode(self, data: bytes) -> tuple[int, ...]:
        """The ids of one match. A match that is a token as a whole is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(data) > SETTLE:
            return tuple(chain.from_iterable(self.stream(data)))
        if len(self.states) > STATES_KEPT:
            self._forget()
        moves, state, lasts = self.moves, 0, [-1]
        for byte in data:
            here = moves[state]
            if byte not in here:
                here[byte] = self._move(state, byte)
            state, last = here[byte]
            lasts.append(last)
        return tuple(self._path(lasts, len(data)))


def _utf8_start(byte: int) -> tuple[int, int, int] | None:
    """Continuation bytes that follow a first byte, and the range of the first of them; None: not a first byte."""
    if byte < 0x80:
        return 0, 0, 0
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return None


class Decoder:
    """Token ids to text, piece by piece. A state is the unfinished character's bytes; wrong bytes become U+FFFD, one for
    each longest start of a character, as Python's "replace" does."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.moves: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    def _move(self, open_: bytes, token: int) -> tuple[str, bytes]:
        out, data, begin = [], open_ + self.bytes_of[token], 0
        while begin < len(data):
            first = _utf8_start(data[begin])
            if first is None:
                out.append("�")
                begin += 1
                continue
            need, low, high = first
            end = begin + 1
            while need and end < len(data) and low <= data[end] <= high:
                need, low, high, end = need - 1, 0x80, 0xBF, end + 1
            if need and end == len(data):
                return "".join(out), data[begin:]
            out.append("�" if need else data[begin:end].decode())
            begin = end
        return "".join(out), b""

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        open_ = b""
        moves = self.moves[open_]
        for token in ids:
            move = moves.get(token)
            if move is None:
                move = moves[token] = self._move(open_, token)
            if move[1] != open_:
                open_ = move[1]
                moves = self.moves.setdefault(open_, {})
            if move[0]:
                yield move[0]
        if open_:
            yield "�"

    def text(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


class Encoder:
    """Whole texts: cut by the pattern, each match through the transducer. Stretches seen before are looked up.

    The pattern must not match over a place where CHUNK cuts: white space, but for one blank before other characters.
    """

    def __init__(self, path: str, pattern: str):
        import regex

        self.chunks, self.matches = re.compile(CHUNK), regex.compile(pattern)
        self.transducer = Transducer(read_ranks(path))
        self.decoder = Decoder(self.transducer.bytes_of)
        self.numerals = {rank: b",%d" % rank for rank in self.transducer.bytes_of}
        # Tokens that are whole characters: from the state machine's start they lead back there.
        self.whole = {rank: token for rank, token in self.transducer.bytes_of.items() if _is_whole(token)}
        self.known = _Known(self)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))

    def parts(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, in parts that begin and end between characters."""
        found = self.chunks.findall(text) if len(text) <= LONG_TEXT else map(re.Match.group, self.chunks.finditer(text))
        found = iter(found)
        while part := list(islice(found, CHUNKS_AT_ONCE)):
            if len(self.known) > CHUNKS_KEPT:
                self.known.clear()
            if len(self.known.matches) > MATCHES_KEPT:
                self.known.matches.clear()
            yield list(chain.from_iterable(map(self.known.__getitem__, part)))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of whole characters. Only where a token leaves a character open the state machine is needed."""
        try:
            return b"".join(map(self.whole.__getitem__, ids))
        except KeyError:
            return self.decoder.text(ids).encode()


class _Known(dict):
    """Ids by stretch of text. Many stretches share a match: a word with and without the comma after it."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.matches = encoder, {}

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = []
        for match in self.encoder.matches.findall(chunk):
            known = self.matches.get(match)
            if known is None:
                known = self.matches[match] = self.encoder.transducer.encode(match.encode())
            ids += known
        found = self[chunk] = tuple(ids)
        return found


def _is_whole(token: bytes) -> bool:
    try:
        return bool(token.decode())
    except UnicodeDecodeError:
        return False


def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker, so that what it has learnt serves all of its tasks."""
    return kept_in_worker(("byte BPE", path, pattern), lambda: Encoder(path, pattern))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, *, with_ids: bool = False) -> DataFrame:
    """Per row: the number of tokens, a digest of the ids, and a digest of what they decode to; with_ids adds both.

    NULL text counts as empty: no ids, and the digests of no bytes. doc_id may be NULL or repeated; each row stands for
    itself. Other columns than doc_id and text are not read. Text is what Spark's strings hold, that is, valid UTF-8. The
    pattern must fit CHUNK (see Encoder), as that of the byte-level vocabularies does.
    """
    schema = T.StructType([*SCHEMA.fields, IDS, DECODED]) if with_ids else SCHEMA

    def coded(coder: Encoder, text: str) -> tuple[int, str, str, list[int], str]:
        count, digest, decoded, ids_of, back = 0, hashlib.sha256(), hashlib.sha256(), [], []
        for ids in coder.parts(text):
            numerals, data = b"".join(map(coder.numerals.__getitem__, ids)), coder.decode(ids)
            digest.update(numerals if count else numerals[1:])
            decoded.update(data)
            count += len(ids)
            if with_ids:
                ids_of += ids
                back.append(data.decode())
        return count, digest.hexdigest(), decoded.hexdigest(), ids_of, "".join(back)

    def run(batches):
        coder = encoder(ranks, pattern)
        # Tables of tuples grow all the time and hold no cycles: looking through them for cycles costs a third of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            for part in slices(batches):
                columns = list(zip(*[coded(coder, text) for text in part.column("text").to_pylist()], strict=True))
                arrays = [part.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2])]
                if with_ids:
                    arrays += [pa.array(columns[3], pa.list_(pa.int32())), pa.array(columns[4], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        finally:
            if collecting:
                gc.enable()

    return docs.select(docs["doc_id"].cast("long"), text_or_empty(docs).alias("text")).mapInArrow(run, schema)

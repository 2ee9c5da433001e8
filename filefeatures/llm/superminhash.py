"""Word shingles of a text and their SuperMinHash signature, vectorised over the shingles of many texts.

SuperMinHash gives every shingle a random permutation p of the slots, built step by step (Fisher-Yates), and random
numbers r in [0, 1): slot p[j] gets the smallest r + j over all shingles. Because one shingle ranks the slots without
repeats, signatures vary less than with independent hash functions. A value of round j is smaller than any of a later
round, so a slot that is filled in a round is final after it, and a text is done as soon as all its slots are filled:
a long text needs one or two rounds, a short one up to as many as there are slots.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from filefeatures.llm.arrow import ascii_lower, kept_in_worker, splitmix

WORDS_KEPT = 250_000
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class WordHashes(dict):
    """64-bit hashes of words, looked up when seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(kept_in_worker("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Distinct 64-bit hashes, sorted, of the runs of `width` words of the lower-cased text; a shorter text is one run."""
    return shingle_sets([text], width)[0]


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """`shingles` of each text."""
    words = [ascii_lower(text).split() for text in texts]
    hashes, sets, begin = word_hashes([word for own in words for word in own]), [], 0
    # The runs of `width` words over all the texts; those that cross from one text to the next are left out below.
    mixed = _runs(hashes, width)
    for own in words:
        end = begin + len(own)
        runs = mixed[begin : end - width + 1] if len(own) >= width else _runs(hashes[begin:end], len(own))
        sets.append(np.unique(runs))
        begin = end
    return sets


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    count = len(hashes) - width + 1
    if not width or count < 1:
        return np.empty(0, np.uint64)
    mixed = np.full(count, width, np.uint64)
    for i in range(width):
        mixed = splitmix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return mixed


def set_id(hashes: np.ndarray) -> bytes:
    """Equal for equal sets, and (128 bits of BLAKE2) only for these."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row per set: per slot the round in the upper 16 bits and 48 random bits. An empty set has no filled slot."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.full((len(sets), slots), EMPTY)
    owner = np.repeat(np.arange(len(sets)), sizes)
    seeds = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    places, flat = np.empty((0, 0), np.int16), values.reshape(-1)
    for round_ in range(slots):
        if round_ == 1:
            places = np.repeat(np.arange(slots, dtype=np.int16)[None, :], len(owner), axis=0)
            # What round 0 swapped is known again from its draw.
            places[np.arange(len(owner)), _draw(seeds, 0, slots)[0]] = 0
        if not len(owner):
            break
        pick, value = _draw(seeds, round_, slots)
        if round_:
            at = np.arange(len(owner))
            slot = places[at, pick].astype(np.int64)
            places[at, pick] = places[:, round_]
        else:
            slot = pick
        np.minimum.at(flat, owner * slots + slot, value)
        still = (values == EMPTY).any(axis=1)
        going = still[owner]
        owner, seeds = owner[going], seeds[going]
        if round_:
            places = places[going]
    return values


def _draw(seeds: np.ndarray, round_: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle the position drawn from round_ .. slots - 1, and its value in that round."""
    random = splitmix(seeds + np.uint64((2 * round_ + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    pick = round_ + ((random >> np.uint64(48)).astype(np.int64) * (slots - round_) >> 16)
    return pick, np.uint64(round_ << 48) | (splitmix(random) >> np.uint64(16))


def bands(values: np.ndarray, count: int) -> np.ndarray:
    """Per signature, one 64-bit key for each group of neighbouring slots; the group's number is part of the key."""
    rows = values.shape[1] // count
    keys = np.repeat(np.arange(count, dtype=np.uint64)[None, :], len(values), axis=0)
    grouped = values[:, : count * rows].reshape(len(values), count, rows)
    for i in range(rows):
        keys = splitmix(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, i])
    return keys.view(np.int64)

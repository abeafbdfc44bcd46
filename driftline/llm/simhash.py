"""SimHash fingerprints of word shingles, computed on whole batches of texts.

A text's words are what ASCII white space separates, with A-Z lower-cased. Every
shingle (repeats included) is hashed with XXH64, and a fingerprint bit is one if
more than half of the hashes have it. A text with fewer words than a shingle has
one shingle, its whole sequence; a text without words has the fingerprint zero.
"""

from __future__ import annotations

import numpy as np
import xxhash

from driftline.llm.common import in_batches

SEED = 42
# The primes of the XXH64 algorithm.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LANES = np.uint64(0x0101010101010101)
#: Shingles hashed at once, and the length from which one is hashed on its own.
SLICE, LONG = 1 << 18, 256


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turn(state + word * P2, 31) * P1


def _hash_equal(data: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """XXH64 of ``size`` bytes from each position ``at``."""
    end = len(data)
    eight = np.ndarray((end - 7,), "<u8", data, strides=(1,))
    four = np.ndarray((end - 3,), "<u4", data, strides=(1,))
    start, done = np.uint64(seed), 0
    if size >= 32:
        states = [start + P1 + P2, start + P2, start, start - P1]
        states = [np.full(len(at), s, np.uint64) for s in states]
        while done + 32 <= size:
            for i in range(4):
                states[i] = _round(states[i], eight[at + (done + 8 * i)])
            done += 32
        h = sum(_turn(s, by) for s, by in zip(states, (1, 7, 12, 18)))
        for s in states:
            h = (h ^ _round(np.uint64(0), s)) * P1 + P4
    else:
        h = np.full(len(at), start + P5, np.uint64)
    h = h + np.uint64(size)
    while done + 8 <= size:
        h = _turn(h ^ _round(np.uint64(0), eight[at + done]), 27) * P1 + P4
        done += 8
    if done + 4 <= size:
        h = _turn(h ^ (four[at + done].astype(np.uint64) * P1), 23) * P2 + P3
        done += 4
    while done < size:
        h = _turn(h ^ (data[at + done].astype(np.uint64) * P5), 11) * P1
        done += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, at: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of the spans of ``data``; the last 8 bytes of ``data`` are padding."""
    out = np.empty(len(at), np.uint64)
    order = np.argsort(np.minimum(size, LONG).astype(np.uint16), kind="stable")
    sizes = size[order]
    cuts = np.flatnonzero(np.diff(np.minimum(sizes, LONG))) + 1
    with np.errstate(over="ignore"):
        for group in np.split(order, cuts):
            if not len(group):
                continue
            n = int(size[group[0]])
            if n < LONG:
                out[group] = _hash_equal(data, at[group], n, seed)
            else:
                for i in group:
                    span = data[at[i] : at[i] + size[i]].tobytes()
                    out[i] = xxhash.xxh64_intdigest(span, seed)
    return out


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' lower-cased words, each followed by one space, and padding;
    the place of each of those spaces; the number of words up to each text."""
    raw = np.frombuffer(b" ".join([*texts, b""]).lower() + b" ", np.uint8)
    space = SPACE[raw]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    ends = np.cumsum([len(t) + 1 for t in texts])
    # A word's first byte, counted up to the end of each text.
    words = np.cumsum(~space & before, dtype=np.int64)[ends - 1]
    keep = ~(space & before)
    data = raw[keep]
    data[space[keep]] = 0x20
    return np.concatenate([data, np.zeros(8, np.uint8)]), np.flatnonzero(data == 0x20), words


def _spans(ends, first, words, width):
    """Start and length of the shingles that begin at the words ``first``.

    ``words`` is the number of words up to the end of the text of each."""
    begin = np.where(first > 0, ends[first - 1] + 1, 0)
    return begin, ends[np.minimum(first + width - 1, words - 1)] - begin


class _Shingles:
    """The shingles of a batch of texts, hashed slice by slice."""

    def __init__(self, texts: list[bytes], width: int):
        self.data, self.ends, self.upto = _words(texts)
        self.begin = np.concatenate([[0], self.upto[:-1]])
        words = self.upto - self.begin
        self.count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
        self.width = width

    def __iter__(self):
        """The text of each shingle of a slice, and its hash."""
        total = np.cumsum(self.count)
        last = int(total[-1]) if len(total) else 0
        for low in range(0, last, SLICE):
            number = np.arange(low, min(low + SLICE, last))
            text = np.searchsorted(total, number, side="right")
            first = self.begin[text] + number - (total - self.count)[text]
            at, size = _spans(self.ends, first, self.upto[text], self.width)
            yield text, xxh64(self.data, at, size)


def _batch(texts: list[bytes], width: int) -> np.ndarray:
    counts = np.zeros((len(texts), 64), np.int64)
    shingles = _Shingles(texts, width)
    for text, hashes in shingles:
        _add_bits(counts, text, hashes)
    return _majority(counts, shingles.count)


def _add_bits(counts: np.ndarray, text: np.ndarray, hashes: np.ndarray) -> None:
    """Add the bits of each hash to the 64 counts of its text.

    Eight counters share a word, so at most 255 hashes are summed at once.
    """
    where = np.arange(len(text))
    fresh = np.flatnonzero(np.diff(text, prepend=-1))
    since = where - np.repeat(fresh, np.diff(np.append(fresh, len(text))))
    blocks = np.flatnonzero(since % 255 == 0)
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & LANES
        sums = np.add.reduceat(lanes, blocks).view(np.uint8).reshape(-1, 8)
        np.add.at(counts, (text[blocks][:, None], np.arange(8)[None, :] * 8 + bit), sums)


def _majority(counts: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    bits = (2 * counts > shingles[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(texts: list[bytes], width: int = 3) -> np.ndarray:
    """The 64-bit fingerprint of each text, unsigned."""
    out = [_batch(texts[a:b], width) for a, b in in_batches(texts, 2_000_000)]
    return np.concatenate(out) if out else np.empty(0, np.uint64)

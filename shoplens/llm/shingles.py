"""Sets of word shingles as sorted 64-bit hashes, computed with numpy over many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

SLICE_BYTES = 1 << 20  # of text worked on at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    codes[65:91] += np.uint64(32)  # A-Z as a-z
    return _mix(codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))


_VALUE = _byte_values()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte array that ends with a space."""
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _power_tables(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up[: len(data)], dtype=np.uint64)))
    return starts, _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _words(texts: list[bytes]):
    """Word hashes of all texts in a row, and how many each text has."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    limits = np.cumsum([len(t) + 1 for t in texts])
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + SLICE_BYTES)
        while end < len(data) and not _SPACE[data[end - 1]]:  # a slice ends after a space
            back = np.flatnonzero(_SPACE[data[at:end]])
            end = at + int(back[-1]) + 1 if len(back) else min(len(data), end + SLICE_BYTES)
        s, h = _word_hashes(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    words = np.concatenate(hashes)
    counts = np.diff(np.searchsorted(np.concatenate(starts), np.concatenate(([0], limits))))
    return words, counts


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles of ``size`` words as sorted hashes.

    Words are maximal runs without ASCII white space, A-Z lower-cased.  A text
    of fewer words is one shingle of them all; one without words has none.
    """
    out: list[np.ndarray] = []
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(raw):
        end, held = at, 0
        while end < len(raw) and (end == at or held + len(raw[end]) < SLICE_BYTES):
            held += len(raw[end])
            end += 1
        out += _sets(raw[at:end], size)
        at = end
    return out


def _sets(raw: list[bytes], size: int) -> list[np.ndarray]:
    words, counts = _words(raw)
    weights = _mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    total = len(words)
    grams = np.zeros(0, np.uint64)
    if total >= size:
        grams = np.zeros(total - size + 1, np.uint64)
        for j in range(size):
            grams += words[j : total - size + 1 + j] * weights[j]
        grams = _mix(grams)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(grams[at : at + n - size + 1]))
        elif n:
            short = (words[at : at + n] * weights[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(_mix(np.array([short], np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit integers that name a set."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)

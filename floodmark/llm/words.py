"""Words of a text, their 64-bit names, and names of word sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64

# Odd multiplier of the rolling names and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """Words between the ASCII white space characters 0x20 and 0x09 to 0x0D."""
    data = encoded(text)
    return (data.lower() if lower else data).split()  # bytes.lower() maps A-Z only


# One random odd number per byte value.
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)

#: Bytes that are not part of a word.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes that are named at a time, about.
_PART = 1 << 21


def named(texts: list[bytes], gaps: np.ndarray = WHITE, joiner: bytes = b" ", head: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of all words of some texts, and the first word of each text and the end.

    A name is a function of a word's bytes, so every task gives a word the same name.
    ``gaps`` says which bytes are not part of a word, the joiner among them; ``head`` names
    words by their first bytes only.
    """
    data = np.frombuffer(joiner.join(texts) + joiner, np.uint8)
    part = gaps[data]
    turn = np.flatnonzero(np.diff(part, prepend=True))
    starts, ends = turn[::2], turn[1::2]
    if head:
        ends = np.minimum(ends, starts + head)
    names = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(int(np.searchsorted(ends, low + _PART)), at + 1)
        prefix = np.zeros(ends[upto - 1] - low + 1, U64)
        np.cumsum(_BYTES[data[low : ends[upto - 1]]] * _powers("up", len(prefix) - 1), out=prefix[1:])
        a, b = starts[at:upto] - low, ends[at:upto] - low
        names[at:upto] = mix((prefix[b] - prefix[a]) * _powers("down", len(prefix))[a])
        at = upto
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return names, np.searchsorted(starts, first)


def in_slabs(texts: list[bytes], size: int = 1 << 19) -> Iterator[list[bytes]]:
    """Whole texts, some ``size`` bytes at a time: what naming them takes is many times that."""
    since, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size or i + 1 == len(texts):
            yield texts[since : i + 1]
            since, held = i + 1, 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (one to one)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(way: str, n: int) -> np.ndarray:
    have = _POWERS[way]
    if len(have) < n:
        step = np.full(max(n, 2 * len(have)), _BASE if way == "up" else _INVERSE, U64)
        step[0] = 1
        have = _POWERS[way] = np.multiply.accumulate(step)
    return have[:n]


def sums(names: np.ndarray, salt: int = 0) -> np.ndarray:
    """Prefix sums that sequence() takes names of word sequences from."""
    out = np.zeros(len(names) + 1, U64)
    x = mix(names ^ U64(salt)) if salt else names
    np.cumsum(x * _powers("up", len(names)), out=out[1:])
    return out


def sequence(prefix: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Names of the sequences of ``width`` words that begin at ``start``."""
    return mix((prefix[start + width] - prefix[start]) * _powers("down", len(prefix))[start])


def windows(names: np.ndarray, width: int) -> np.ndarray:
    """Names of all sequences of ``width`` consecutive words."""
    if len(names) < width:
        return np.empty(0, U64)
    return sequence(sums(names), np.arange(len(names) - width + 1), width)

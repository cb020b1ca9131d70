"""Word boundaries and 64-bit word hashes of many texts at once, in numpy.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8
text. A word's hash is a polynomial over a table of random 64-bit byte values,
read off prefix sums (all arithmetic modulo 2**64) and finished by a mixer, so
a text costs a few vector operations per byte and no Python call per word.
The work runs over blocks of about ``BLOCK`` bytes cut at white space, which
bounds the temporary arrays whatever the length of a text.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds); ``salt`` gives
    independent functions."""
    x = x + U64((salt * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & MASK)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    step = base & MASK
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * U64(step)
        step = step * step & MASK
        done += more
    return out


class Tables:
    """Powers of one base, their inverses, and the byte values, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.bytes = mix(np.arange(1, 257, dtype=U64), 7)
        self.up = self.down = np.ones(1, U64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = powers(self.base, n), powers(self.inverse, n)


_TABLES = Tables()


def range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, tables: Tables) -> np.ndarray:
    """sum(values[s + j] * base**j) for each range [s, e), modulo 2**64."""
    tables.grow(len(values) + 1)
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * tables.up[:len(values)], out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * tables.down[starts]


class Words:
    """The words of a list of texts.

    ``buf``: all texts' bytes, joined by a line feed; ``start``/``end``: byte
    range of each word; ``first``: word index at which each text begins, with
    the total number of words at the end."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts)
        self.buf = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.concatenate(([0], np.cumsum(sizes + 1)))[:len(texts)]
        inside = np.zeros(len(self.buf) + 2, np.int8)
        inside[1:-1] = (self.buf != 32) & ((self.buf - np.uint8(9)) > 4)
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.append(np.searchsorted(self.start, self.offset), len(self.start))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), U64)
        at = 0
        while at < len(self.start):
            low = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, low + BLOCK, side="right")))
            high = self.end[to - 1]
            values = _TABLES.bytes[self.buf[low:high]]
            out[at:to] = range_sums(values, self.start[at:to] - low, self.end[at:to] - low, _TABLES)
            at = to
        return mix(out ^ (self.end - self.start).astype(U64), 1)


def encoded(texts) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def windows(values: np.ndarray, width: int, base_salt: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values (as if they were one text)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    base = (BASE * (2 * base_salt + 3)) & MASK | 1
    out = np.zeros(n, U64)
    # Hashes of 2^k values come from two of 2^(k-1); the width is the sum of its binary digits.
    power, size, part, done, lead = base, 1, values, 0, 1
    while True:
        if width & size:
            out += part[done:done + n] * U64(lead)
            lead = lead * power & MASK
            done += size
        if size * 2 > width:
            return mix(out, base_salt)
        part = part[:-size] + part[size:] * U64(power)
        power = power * power & MASK
        size *= 2

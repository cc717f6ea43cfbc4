"""Prefix polynomial hashes of one text: arrays modulo two primes that answer any span.

``H[i]`` is the sum of ``(c + 1) * BASE ** j`` over the code points ``c`` at ``j < i``. A span's
hash is a difference of two entries, moved to place 0 by an inverse power. Arrays are built
and read in blocks, so beside the arrays (8 bytes a code point) memory is that of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Two primes below 2 ** 31, and a base for each.
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (1_103_515_245, 1_442_695_041)
BLOCK = 1 << 16


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.append(out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime))
    return out[:n]


_POWERS = [_powers(b, p, BLOCK) for b, p in zip(BASES, PRIMES, strict=True)]
_INVERSES = [_powers(pow(b, -1, p), p, BLOCK) for b, p in zip(BASES, PRIMES, strict=True)]


class Spans:
    """Hashes of spans of ``n`` code points, from ``entries``: the prefix hashes at places [start, stop)."""

    n: int

    def entries(self, which: int, start: int, stop: int) -> np.ndarray:
        raise NotImplementedError

    def span(self, start: int, length: int) -> tuple[int, ...]:
        """Hash of one span; equal spans have equal hashes wherever they lie."""
        out = []
        for which, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
            low, high = (int(self.entries(which, i, i + 1)[0]) for i in (start, start + length))
            out.append((high - low) * pow(base, -start, prime) % prime)
        return tuple(out)

    def windows(self, length: int) -> Iterator[np.ndarray]:
        """62-bit hashes of all spans of ``length`` code points, in order, a block at a time."""
        for start in range(0, self.n - length + 1, BLOCK):
            stop = min(start + BLOCK, self.n - length + 1)
            both = []
            for which, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
                near = self.entries(which, start, stop + length)
                p = np.uint64(prime)
                spans = (near[length:] + p - near[:-length]) % p * _INVERSES[which][: stop - start] % p
                both.append(spans * np.uint64(pow(base, -start, prime)) % p if start else spans)
            yield both[0] << np.uint64(31) | both[1]

    def common(self, other: Spans, start: int = 0, other_start: int = 0) -> int:
        """Longest common extension from two places, by binary search over spans."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(start, mid) == other.span(other_start, mid):
                low = mid
            else:
                high = mid - 1
        return low


class Text(Spans):
    """The prefix hashes of a text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = len(codes)
        self._arrays = [np.zeros(self.n + 1, np.uint32) for _ in PRIMES]
        for which, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
            p, array, carry = np.uint64(prime), self._arrays[which], np.uint64(0)
            for start in range(0, self.n, BLOCK):
                part = codes[start : start + BLOCK].astype(np.uint64) + np.uint64(1)
                part = part * _POWERS[which][: len(part)] % p
                if start:
                    part = part * np.uint64(pow(base, start, prime)) % p
                part[0] += carry
                sums = np.cumsum(part) % p
                array[start + 1 : start + len(part) + 1] = sums
                carry = sums[-1]

    def entries(self, which: int, start: int, stop: int) -> np.ndarray:
        return self._arrays[which][start:stop].astype(np.uint64)


class Joined(Spans):
    """The first ``cut`` code points of one text, then the first ``rest`` of another, without hashing any anew."""

    def __init__(self, first: Text, cut: int, second: Text, rest: int):
        self.first, self.cut, self.second, self.n = first, cut, second, cut + rest

    def entries(self, which: int, start: int, stop: int) -> np.ndarray:
        prime, cut = np.uint64(PRIMES[which]), self.cut
        before = self.first.entries(which, start, min(stop, cut + 1))
        if stop <= cut + 1:
            return before
        after = self.second.entries(which, max(start - cut, 1), stop - cut)
        moved = after * np.uint64(pow(BASES[which], cut, PRIMES[which])) % prime
        return np.append(before, (moved + self.first.entries(which, cut, cut + 1)) % prime)

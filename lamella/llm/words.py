"""Words of many texts at once, as 64-bit hashes in numpy arrays; runs inside Python workers."""

from __future__ import annotations

import numpy as np
import pandas as pd

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Lower case for A-Z, every other byte as it is; plus 1, so that a zero byte counts too.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) + np.uint64(1)
#: The six characters that end a word in WORD; and for plain words all of ASCII but letters and digits.
BLANKS = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of murmur3: spreads the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHasher:
    """Hashes words of texts, ASCII letters lower-cased. Powers are kept between calls."""

    def __init__(self, separators: np.ndarray):
        self.separators, self.powers, self.inverses = separators, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def __call__(self, texts: pd.Series | list) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, number of words of each text); a null text has none."""
        raw = [(t or "").encode("utf-8", "surrogatepass") + b" " for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        self._grow(len(data) + 1)
        inside = ~self.separators[data]
        change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        starts, stops = change[::2], change[1::2]
        # polynomial of the bytes from a prefix sum, shifted back to the word's start (all modulo 2**64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[data] * self.powers[: len(data)], dtype=np.uint64)])
        hashes = mix64((sums[stops] - sums[starts]) * self.inverses[starts] + (stops - starts).astype(np.uint64))
        counts = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
        return hashes, counts

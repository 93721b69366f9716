"""Words of many texts at once, as numpy arrays: places, owners and 64-bit hashes.

Texts are taken in chunks of half a megabyte, so that the arrays of a chunk stay small whatever the
size of an Arrow batch; one very long text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95

#: Bytes that belong to words: all but space and 0x09 to 0x0D.
PLAIN = np.ones(256, dtype=bool)
PLAIN[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: As a table for bytes.translate: A-Z lowered, every byte that is in no alphanumeric word a space.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: The same words as PLAIN, with A-Z lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Powers:
    """Powers of an odd base modulo 2^64, and of its inverse; grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def __getstate__(self):
        return {"base": self.base, "inverse": self.inverse, "n": 0}

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([[U(1)], np.cumprod(np.full(self.n, U(self.base)))])
                self.down = np.concatenate([[U(1)], np.cumprod(np.full(self.n, U(self.inverse)))])
        return self.up, self.down


_bytes_pow, _words_pow = Powers(_BYTE_BASE), Powers(_WORD_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher that spreads every input bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Chunk:
    """Words of some texts. ``first``: index of the first text; ``bounds[i]:bounds[i + 1]``: words of text i."""

    def __init__(self, first: int, texts: list[bytes], lower: bool):
        self.first, self.n_texts = first, len(texts)
        buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            buf = LOWER[buf]
        self.buf = buf
        edge = np.diff(PLAIN[buf].astype(np.int8), prepend=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        self.bounds = np.concatenate([[0], np.searchsorted(self.start, ends)])
        up, down = _bytes_pow.upto(len(buf) + 1)
        total = np.concatenate([[U(0)], np.cumsum((buf.astype(U) + U(1)) * up[: len(buf)])])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    def ngrams(self, k: int) -> np.ndarray:
        """Hash of the k words from each place on; places whose k words leave the chunk are missing."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, dtype=U)
        up, down = _words_pow.upto(n + 1)
        total = np.concatenate([[U(0)], np.cumsum(self.hash * up[:n])])
        return mix((total[k:] - total[: n - k + 1]) * down[: n - k + 1] + U(k))

    def span_hash(self, a: int, b: int, seed: int = 0) -> int:
        """Hash of words a to b (exclusive), with ``b - a`` mixed in."""
        up, down = _words_pow.upto(len(self.hash) + 1)
        h = (self.hash[a:b] * up[: b - a]).sum(dtype=U)
        return int(mix(np.array([h], dtype=U) * U(2 * seed + 1) + U(b - a + seed))[0])


def chunks(texts: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts (null: empty) as chunks in order."""
    held: list[bytes] = []
    first = size = 0
    for i, t in enumerate(texts.cast(pa.binary() if not pa.types.is_large_string(texts.type) else pa.large_binary())):
        b = t.as_py() or b""
        if held and size + len(b) > limit:
            yield Chunk(first, held, lower)
            held, first, size = [], i, 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield Chunk(first, held, lower)


def signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)

"""Shared helpers: tables in the shared folder, and hashing of words in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql.functions import broadcast

from churnkit.session import release, stored

__all__ = ["release", "stored"]

#: The white space of every word contract: ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"

_U = np.uint64
# Fixed odd multipliers of the 64-bit hashes.
_P = 0x9E3779B97F4A7C15
_M1, _M2 = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53)
_S33 = _U(33)

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out)


_TABLES: dict[int, np.ndarray] = {}
#: What Python workers keep between tasks; ``drop_caches`` empties it before tasks that need the memory themselves.
CACHES: list = [_TABLES.clear]


def drop_caches() -> None:
    for clear in CACHES:
        clear()



def power_table(base: int, n: int) -> np.ndarray:
    have = _TABLES.get(base)
    if have is None or len(have) < n:
        have = _TABLES[base] = powers(base, max(n, 1 << 16))
    return have[:n]


_INVERSE = pow(_P, -1, 1 << 64)


def words_of(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Words of all texts at once: (hash, start, end, first word of each text + total, joined bytes).

    A word is a longest run of bytes outside ``WHITE``; the hash depends on its
    bytes alone.  ``lower`` folds A-Z first.
    """
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    buf = np.frombuffer(joined, np.uint8)
    if lower:
        buf = _LOWER[buf]
    word = ~_IS_WHITE[buf]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    n = len(buf)
    total = np.empty(n + 1, _U)
    total[0] = 0
    np.cumsum((buf.astype(_U) + _U(1)) * power_table(_P, n), out=total[1:])
    h = mix((total[end] - total[start]) * power_table(_INVERSE, n)[start] + (end - start).astype(_U))
    begins = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return h, start, end, np.searchsorted(start, begins), joined


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``most`` (one item at least)."""
    i, n = 0, len(sizes)
    while i < n:
        j, total = i, 0
        while j < n and (j == i or total + sizes[j] <= most):
            total += sizes[j]
            j += 1
        yield i, j
        i = j


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the int64 of the same bits (Spark's long)."""
    return x.view(np.int64)


# Words of letters and digits: A-Z become a-z, ASCII other than digits and letters separates, all else belongs to words.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    """Longest runs of ``[0-9A-Za-z]`` and non-ASCII characters of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_PLAIN).split() if text else []


def free_names(df, n: int) -> list[str]:
    """``n`` column names that ``df`` does not have, whatever their case."""
    taken, out, i = {c.lower() for c in df.columns}, [], 0
    while len(out) < n:
        if f"_free{i}" not in taken:
            out.append(f"_free{i}")
        i += 1
    return out


#: Rows of a stored table of ids that a join may broadcast (16 bytes or so each); larger tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def by_size(ids):
    """A stored table of few columns, marked for broadcast if its counted rows are at most ``BROADCAST_ROWS``, else for a
    shuffled join: so texts are not shuffled to be joined with a few ids."""
    return broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("merge")

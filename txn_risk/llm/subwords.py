"""Hashed word and character n-gram features of whole texts, computed on arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
# Bytes handled at once; a longer text is cut at a blank into parts whose features are put together.
CHUNK = 1 << 20

_LOWER = bytes.maketrans(
    bytes(range(65, 91)) + b"\t\n\r\x0b\x0c", bytes(range(97, 123)) + b" " * 5
)


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(33)
    x *= _PRIME
    return (x >> np.uint64(64 - bits)).astype(np.int32)


def _parts(texts: Sequence[str | None]) -> Iterator[tuple[list[int], bytes]]:
    """``(numbers of texts, their bytes joined by blanks)``, each of about CHUNK bytes."""
    own: list[int] = []
    held: list[bytes] = []
    size = 0
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
        while len(raw) > CHUNK:
            cut = raw.rfind(b" ", 0, CHUNK)
            cut = cut if cut > 0 else CHUNK
            yield [k], raw[:cut]
            raw = raw[cut:]
        if size + len(raw) > CHUNK and own:
            yield own, b"\n".join(held)
            own, held, size = [], [], 0
        own.append(k)
        held.append(raw)
        size += len(raw) + 1
    if own:
        yield own, b"\n".join(held)


def features(
    texts: Sequence[str | None], bits: int, grams: Sequence[int] = (3, 4), starts: Sequence[int] = (),
    repeats: bool = False,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text number, feature)`` pairs, in parts; a feature is a number below ``2 ** bits``.

    Features are the words (what stands between white space, A-Z lower-cased), their n-grams of
    ``grams`` bytes with the blanks around the word, and their first ``starts`` bytes. ``repeats`` adds
    one for every word that equals the word before it, the only word pair that recurs across texts.
    """
    for own, raw in _parts(texts):
        data = np.frombuffer(b" " + raw + b" ", np.uint8)
        line = data == 10
        document = np.asarray(own, np.int64)[np.cumsum(line)] if len(own) > 1 else np.full(len(data), own[0])
        blank = (data == 32) | line
        codes = np.where(line, 32, data).astype(np.uint64)
        edge = np.flatnonzero(blank)
        begin, end = edge[:-1] + 1, edge[1:]
        filled = end > begin
        begin, end = begin[filled], end[filled]
        if not len(begin):
            continue
        # Sums of code * prime ** position are comparable once shifted back to position 0.
        where, what = [document[begin]], []
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), _PRIME)]).astype(np.uint64))
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), _INVERSE)]).astype(np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * power[:-1])])
        word = (sums[end] - sums[begin]) * back[begin]
        what.append(_mixed(word, bits))
        if repeats:
            same = np.flatnonzero((word[1:] == word[:-1]) & (where[0][1:] == where[0][:-1])) + 1
            where.append(where[0][same])
            what.append(np.zeros(len(same), np.int32))
        for n in starts:
            long = end - begin > n
            at = begin[long]
            where.append(document[at])
            what.append(_mixed((sums[at + n] - sums[at]) * back[at] + np.uint64(n), bits))
        inner = np.concatenate([[0], np.cumsum(blank)])
        for n in grams:
            if len(data) < n:
                continue
            at = np.arange(len(data) - n + 1)
            # No blank except at either end.
            good = inner[at + n - 1] - inner[at + 1] == 0 if n > 2 else inner[at + n] - inner[at] < n
            at = at[good]
            code = np.zeros(len(at), np.uint64)
            for i in range(n):
                code = (code << np.uint64(8)) | codes[at + i]
            where.append(document[at])
            what.append(_mixed(code + np.uint64(n << 40), bits))
        yield np.concatenate(where), np.concatenate(what)


_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))

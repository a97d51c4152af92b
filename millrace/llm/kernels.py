"""Array kernels over the bytes of many texts at once: word hashes, shingles, fingerprints, rolling hashes.

All hashes are polynomials modulo 2^64 taken from one running sum, so the hash of any stretch of bytes costs
two look-ups. Texts go through in chunks of about a megabyte, whatever the size of a batch.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK = 1 << 20

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: word bytes: lower-case letters, digits, and all of other alphabets
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
#: as word bytes, without digits
_IS_LETTER = _IS_WORD.copy()
_IS_LETTER[48:58] = False


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        m = max(n + 1, CHUNK + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def running(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sum of ``buf``, with a leading zero."""
    power, _ = _grown(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=out[1:])
    return out


def stretch(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end)."""
    _, inverse = _grown(len(run))
    return mix((run[end] - run[start]) * inverse[start])


def chunks(texts: list[str]):
    """Ranges (i, j) of ``texts`` of about ``CHUNK`` characters, and so of fewer than 2^20 texts with a word."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (size < CHUNK or j == i):
            size += len(texts[j]) + 1
            j += 1
        yield i, j
        i = j


def words(texts: list[str], figures: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, text it is in) of lower-cased ``texts``; words are runs of letters and, with ``figures``, digits."""
    h, doc, _, _ = words_and_ends(texts, figures)
    return h, doc


def words_and_ends(texts: list[str], figures: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``words``, with the bytes of each word and the number of sentence ends of each text."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    begin = np.cumsum([0, *(len(r) + 1 for r in raw)])
    is_word = np.concatenate([[False], (_IS_WORD if figures else _IS_LETTER)[buf], [False]])
    edge = np.flatnonzero(is_word[1:] != is_word[:-1])
    start, end = edge[::2], edge[1::2]
    run = running(buf)
    stop = np.flatnonzero(((buf[:-1] == 46) | (buf[:-1] == 33) | (buf[:-1] == 63)) & ((buf[1:] == 32) | (buf[1:] == 10)))
    stops = np.bincount(np.searchsorted(begin, stop, side="right") - 1, minlength=len(texts))
    return stretch(run, start, end), np.searchsorted(begin, start, side="right") - 1, end - start, stops


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``size`` words within a text; a shorter text has one of all its words."""
    n = len(h)
    count = np.bincount(doc, minlength=n_docs)
    out, at = [], []
    if n >= size:
        full = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            full = full * np.uint64(0x100000001B3) + h[k : n - size + 1 + k]
        ok = doc[: n - size + 1] == doc[size - 1 :]
        out.append(full[ok])
        at.append(doc[: n - size + 1][ok])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])[short]
        one = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            one[has] = one[has] * np.uint64(0x100000001B3) + h[first[has] + k]
        out.append(one)
        at.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value, where = mix(np.concatenate(out)), np.concatenate(at)
    order = np.argsort(where, kind="stable")
    return value[order], where[order]


#: the bits of each byte as bytes, eight in one number: 255 of these add up without a carry
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _simhash(s: np.ndarray, at: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, hash of all shingles in order) of each text, from its shingles."""
    sim, whole = np.zeros(n_docs, np.uint64), np.zeros(n_docs, np.uint64)
    if len(s):
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        own = at[first]
        total = np.diff(np.append(first, len(s)))
        place = np.arange(len(s)) - np.repeat(first, total)
        part = np.flatnonzero(place % 255 == 0)
        some = np.add.reduceat(_SPREAD[s.view(np.uint8).reshape(-1, 8)], part, axis=0).view(np.uint8).reshape(-1, 64)
        ones = np.add.reduceat(some, np.searchsorted(part, first), axis=0, dtype=np.int32)
        sim[own] = np.packbits(2 * ones > total[:, None], axis=1).view(np.uint64).ravel()
        whole[own] = np.add.reduceat(mix(s ^ mix(place.astype(np.uint64))), first)
    return sim, whole


def _bottoms(s: np.ndarray, at: np.ndarray, n_docs: int, share: float) -> tuple[np.ndarray, list[np.ndarray]]:
    # text and the upper 44 bits of a shingle in one number: sorted by text, then hash
    key = at.astype(np.uint64) << np.uint64(44) | s >> np.uint64(20)
    key.sort()  # np.unique hashes first, at several times the cost
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    n = np.bincount((key >> np.uint64(44)).astype(np.int64), minlength=n_docs)
    first = np.cumsum(n) - n
    take = np.where(n > 0, n - np.ceil(share * n - 1e-9).astype(np.int64) + 1, 0)
    half = (key >> np.uint64(12)).astype(np.uint32).view(np.int32)
    return n, [half[a : a + k] for a, k in zip(first.tolist(), take.tolist())]


def prints(texts: list[str], size: int, share: float, figures: bool = True) -> dict[str, object]:
    """Per text: ``sim``, its 64-bit fingerprint; ``n_words``; ``text``, a hash of its words in order; ``n_shingles``, distinct
    shingles; ``least``, the upper halves of the least of their hashes.

    So many of the least hashes are taken that two texts which share at least ``share`` of all that either
    has must have one of them in common.
    """
    sims, counts, wholes, numbers, least = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
    for i, j in chunks(texts):
        h, doc = words(texts[i:j], figures)
        s, at = shingles(h, doc, j - i, size)
        sim, whole = _simhash(s, at, j - i)
        n, low = _bottoms(s, at, j - i, share)
        sims.append(sim)
        wholes.append(whole)
        counts.append(np.bincount(doc, minlength=j - i))
        numbers.append(n)
        least += low
    return {
        "sim": np.concatenate(sims).view(np.int64), "n_words": np.concatenate(counts).astype(np.int32), "text": np.concatenate(wholes).view(np.int64),
        "n_shingles": np.concatenate(numbers).astype(np.int32), "least": least,
    }


def shared_shingles(a: str, b: str, size: int, figures: bool = True) -> float:
    """Share of equal shingles of two texts (of all that either has); 1.0 for two texts without words."""
    h, doc = words([a, b], figures)
    s, at = shingles(h, doc, 2, size)
    x, y = np.unique(s[at == 0]), np.unique(s[at == 1])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0

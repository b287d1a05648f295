"""Word shingles and improved consistent weighted sampling, in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_SALT = np.random.default_rng(5).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+``, and where the words of each text begin (and the last end)."""
    global _POWERS
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    text_ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
    starts, ends = edges[::2], edges[1::2]  # the last byte is blank, so they pair up
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    size = ends - starts
    if size.max() > len(_POWERS):
        _POWERS = np.cumprod(np.full(1 << int(size.max()).bit_length(), _POWERS[0], np.uint64))
    inside = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
    values = _SALT[data[inside]] * _POWERS[np.arange(len(inside)) - np.repeat(np.cumsum(size) - size, size)]
    hashes = mix(np.add.reduceat(values, np.cumsum(size) - size) + size.astype(np.uint64))
    return hashes, np.append(0, np.searchsorted(starts, text_ends))


def shingle_hashes(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """A hash of every ``width`` words in a row; fewer words than that are one shingle, none are none."""
    if len(words) == 0:
        return words
    n = max(1, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        total = mix(total + words[k : k + n] * np.uint64(2 * k + 1))
    return total


def _gamma_quantiles(n: int) -> np.ndarray:
    """Mid-point quantiles of the gamma distribution of shape 2, by bisection of its distribution function."""
    chance = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        above = 1 - (1 + middle) * np.exp(-middle) > chance
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return (low + high) / 2


_GAMMA = _gamma_quantiles(1 << 16).astype(np.float32)
#: Logarithms of the same, raised so that every value ordered by is positive: then its bits order as it does.
_RAISED_LOG = (np.log(_GAMMA) + 64).astype(np.float32)
_UNIT = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
_REST = 1 - _UNIT


def seeds(samples: int) -> np.ndarray:
    return mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]


def keyed_samples(terms: np.ndarray, weights: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A row a term, a column a sample; the least over a set's terms is the set's sample.

    For a term of weight ``w``, with ``r`` and ``c`` of the gamma distribution of shape 2 and
    ``b`` uniform, all fixed by term and sample: ``t = floor(ln w / r + b)``, and the term of
    least ``ln c - r (t - b) - r`` is taken, together with its ``t`` (Ioffe, 2010). The upper
    half of the integer orders by that value, the lower half tells term and ``t``. Two sets
    have equal samples as often as the generalised Jaccard similarity of their weights.
    """
    bits = (terms[:, None] ^ seed) * np.uint64(0xD6E8FEB86659FD93)
    bits ^= bits >> np.uint64(32)
    bits *= np.uint64(0x9E3779B97F4A7C15)
    parts, halves = bits.view("<u2").reshape(*bits.shape, 4), bits.view("<u4").reshape(*bits.shape, 2)
    r, rest, value = _GAMMA[parts[..., 3]], _REST[parts[..., 2]], _RAISED_LOG[parts[..., 1]]
    keyed = np.empty(bits.shape, np.uint64)
    low_high = keyed.view("<u4").reshape(*bits.shape, 2)
    np.bitwise_xor(halves[..., 0], (terms >> np.uint64(7)).astype(np.uint32)[:, None], out=low_high[..., 0])
    heavier = np.flatnonzero(weights != 1)  # of weight 1, t is 0
    if len(heavier):
        t = np.floor(np.log(weights[heavier].astype(np.float32))[:, None] / r[heavier] + _UNIT[parts[heavier, :, 2]])
        low_high[heavier, :, 0] += t.astype(np.int64).astype(np.uint32) * np.uint32(0x632BE5AB)
        rest[heavier] += t
    value -= r * rest
    low_high[..., 1] = value.view(np.uint32)
    return keyed


NO_SAMPLE = np.uint32(0xFFFFFFFF)


def signature(keyed: np.ndarray) -> np.ndarray:
    """The samples of a set from those of its terms; the empty set has ``NO_SAMPLE`` everywhere."""
    if len(keyed) == 0:
        return np.full(keyed.shape[1], NO_SAMPLE)
    return keyed.min(axis=0).astype(np.uint32)  # the lower half


def blocks(terms: np.ndarray, weights: np.ndarray, seed: np.ndarray, most: int = 1 << 21) -> np.ndarray:
    """As ``signature(keyed_samples(...))``, with bounded memory however many terms there are."""
    step = max(1, most // seed.size)
    if len(terms) <= step:
        return signature(keyed_samples(terms, weights, seed))
    least = np.full(seed.size, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(terms), step):
        least = np.minimum(least, keyed_samples(terms[at : at + step], weights[at : at + step], seed).min(axis=0))
    return least.astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples; two empty sets are alike, an empty and another are not."""
    return float(np.mean(a == b))

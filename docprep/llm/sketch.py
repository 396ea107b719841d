"""Word shingles and ProbMinHash sketches of a batch of texts, in numpy over the whole batch at once."""

from __future__ import annotations

import math
import re

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _modular_inverse(a: int) -> int:
    return pow(a, -1, 2**64)


def byte_table() -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal bytes wherever they stand. Prefix sums make it one pass."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.full(len(data) + 1, _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    back = np.full(len(data) + 1, np.uint64(_modular_inverse(int(_BASE))), np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_table()[data] * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts] ^ ((ends - starts).astype(np.uint64) * _GOLD))


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of each word: the runs of a-z and 0-9 in the lower-cased text. Null counts as ''."""
    raw = [(t or "").lower().encode("utf-8", "replace") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends_of_text = np.cumsum([len(r) for r in raw])
    inside = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    return np.searchsorted(ends_of_text, starts, "right"), span_hashes(data, starts, ends)


#: (text index, hash, count, first): the distinct shingles of some texts, ordered by text and hash; first is the place of a
#: shingle's first occurrence in its text.
Shingles = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
#: Shingles after which the weight of an opening's shingles has halved.
HALF = 16


def _counted(owner: np.ndarray, s: np.ndarray) -> Shingles:
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    order = np.lexsort((s, owner))  # stable: of equal shingles the first comes first
    owner, s, place = owner[order], s[order], place[order]
    first = np.ones(len(s), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(first)
    return owner[at], s[at], np.diff(np.append(at, len(s))), place[at]


def shingles(texts: list[str | None], n: int) -> Shingles:
    """Runs of n words within a text."""
    owner, h = words(texts)
    count = max(0, len(h) - n + 1)
    same = owner[:count] == owner[n - 1 : n - 1 + count]
    s = np.zeros(count, np.uint64)
    for k in range(n):
        s = mix(s * np.uint64(3) + h[k : k + count] + np.uint64(k * int(_GOLD) % 2**64))
    return _counted(owner[:count][same], s[same])


_NO_SIGN = re.compile(r"(?:[^\w\n]|_)+")


def character_shingles(texts: list[str | None], n: int = 3) -> Shingles:
    """Runs of n letters, digits and single spaces, of any script."""
    return _counted(*grams(character_codes(texts, _NO_SIGN), n))


def weights(kind: str, count: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What shingles weigh: all the same ('distinct'), by their occurrences ('count'), or the less the later they come ('opening')."""
    if kind == "count":
        return count.astype(np.float64)
    return np.exp2(-first / HALF) if kind == "opening" else np.ones(len(count))


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """The sum of the lesser over that of the greater shares of weight of two sets; the plain similarity if sizes and weights are equal."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = np.minimum(wa[i] / wa.sum(), wb[j] / wb.sum()).sum()
    return float(common / (2 - common))


def paired_jaccard(sets: Shingles, kind: str, n_texts: int, a: np.ndarray, b: np.ndarray, most: int = 1_000_000) -> np.ndarray:
    """weighted_jaccard of each pair (a, b) of the texts that the shingles come from; about so many shingles are looked up at once."""
    owner, h, count, first = sets
    weight = weights(kind, count, first)
    share = weight / np.bincount(owner, weight, n_texts)[owner]
    size = np.bincount(owner, minlength=n_texts)
    start = np.cumsum(size) - size
    told, code = np.unique(h, return_inverse=True)
    place = owner * len(told) + code  # ascends, as shingles are ordered by text and hash
    ends = np.cumsum(size[a])
    common = np.zeros(len(a))
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - size[a[at]] + most, "right")))
        n = size[a[at:to]]
        pair = np.repeat(np.arange(to - at), n)
        x = np.arange(len(pair)) + np.repeat(start[a[at:to]] - (np.cumsum(n) - n), n)
        wanted = b[at:to][pair] * len(told) + code[x]
        y = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
        common[at:to] = np.bincount(pair, np.where(place[y] == wanted, np.minimum(share[x], share[y]), 0.0), to - at)
        at = to
    return common / (2 - common)


_WIDE = re.compile("([\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\U00020000-\U0003ffff])")
_END = 10


def character_codes(texts: list[str | None], between: re.Pattern) -> np.ndarray:
    """The code points of all texts in lower case, a space for each run of the pattern and around a text, a line end after it.

    The pattern must not match a line end. A character of a script written without spaces carries as much as a
    syllable, so it is followed by a filler.
    """
    joined = "\n".join(" " + (t or "").lower().replace("\n", " ") + " " for t in texts) + "\n"
    return np.frombuffer(_WIDE.sub("\\1\x01", between.sub(" ", joined)).encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of each run of n codes within a text."""
    end = codes == _END
    owner = np.cumsum(end) - end
    count = max(0, len(codes) - n + 1)
    inside = np.ones(count, bool)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        inside &= ~end[k : k + count]
        h = h << np.uint64(21) | codes[k : k + count].astype(np.uint64)
    return owner[:count][inside], mix(h[inside] + _GOLD)


def prob_minhash(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """ProbMinHash signatures [n_texts, m]: two texts agree in a component with their probability Jaccard similarity.

    Each element sends arrivals of a Poisson process of its weight's rate; an arrival lands in a random component,
    which keeps the earliest. An element ends as soon as its next arrival comes after the latest of its text's
    components, so few arrivals are drawn beyond those that count. With equal weights the probability Jaccard
    similarity is the plain one. Texts without elements keep 0.
    """
    earliest = np.full(n_texts * m, np.inf)
    signature = np.zeros(n_texts * m, np.uint64)
    time = np.zeros(len(h))
    latest = np.full(n_texts, np.inf)
    rate = 1.0 / weight
    step = 0
    while len(h):
        draw = mix(h + np.uint64((2 * step + 1) * int(_GOLD) % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * rate
        slot = owner * m + (mix(draw + _GOLD) % np.uint64(m)).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        signature[slot[won]] = h[won]
        latest = earliest.reshape(n_texts, m).max(axis=1)
        go = time < latest[owner]
        owner, h, rate, time = owner[go], h[go], rate[go], time[go]
        step += 1
    return signature.reshape(n_texts, m)


def missed(threshold: float, bands: int, rows: int) -> float:
    """The probability that a pair at the threshold meets in fewer than two bands."""
    p = threshold**rows
    return (1 - p) ** bands + bands * p * (1 - p) ** (bands - 1)


def banding(threshold: float, miss: float = 1e-4, most: int = 256) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold meets twice but with at most that probability.

    Two meetings instead of one cost a few more bands and keep nearly all unlike pairs away: they meet once by chance,
    hardly ever twice.
    """
    best = (2, 1)
    for rows in range(1, most // 2 + 1):
        bands = next((b for b in range(2, most // rows + 1) if missed(threshold, b, rows) <= miss), None)
        if bands is None:
            break
        best = (bands, rows)
    return best


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """[n_texts, bands] int64 keys, each over its band's number and components."""
    out = np.zeros((len(signature), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        out = mix(out * np.uint64(5) + signature[:, r : bands * rows : rows] + np.uint64(r + 1))
    return out.view(np.int64)

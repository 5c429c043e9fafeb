"""Shingle sets of whole texts and the partition signatures of the n-gram Jaccard join (see ngram_join)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from partwise.llm._batches import LOWER, U64, mixed, ranges, tabled, word_bounds

_BYTE = mixed(tabled(11))[LOWER]
_BASE = U64(0x9E3779B97F4A7C15)
_BACK = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ODD = tabled(12) | U64(1)
_SIDE, _ITEM, _SEG, _FP1, _FP2 = (U64(int(x)) for x in tabled(13)[:5])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased, from running sums over the bytes."""
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw))[:-1], out=sums[1:])
    lengths = (ends - starts).astype(U64)
    return mixed((sums[ends] - sums[starts]) * _powers(_BACK, len(raw))[starts] + lengths * _SIDE)


def shingle_sets(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, rows in order; a row with fewer words has its whole sequence as one."""
    starts, ends, first = word_bounds(raw, at)
    h = word_hashes(raw, starts, ends)
    n = np.diff(first)
    many = np.maximum(n - words + 1, 0)
    here = ranges(first[:-1], many)
    hashes = np.zeros(len(here), U64)
    for j in range(words):
        hashes += h[here + j] * _ODD[j]
    rows = np.repeat(np.arange(len(n)), many)
    short = np.flatnonzero((n > 0) & (n < words))
    whole = n[short].astype(U64) * _SIDE
    for j in range(words - 1):
        has = n[short] > j
        whole[has] += h[first[short[has]] + j] * _ODD[j]
    rows, hashes = np.concatenate([rows, short]), mixed(np.concatenate([hashes, whole]))
    bits = max(1, int(len(n)).bit_length())
    short = (rows.astype(U64) << U64(64 - bits)) | (hashes >> U64(bits))
    order = np.argsort(short)
    rows, hashes, short = rows[order], hashes[order], short[order]
    if ((short[1:] == short[:-1]) & (hashes[1:] != hashes[:-1])).any():  # the shortened hash does not tell them apart
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def fingerprints(rows: np.ndarray, hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size and two independent 64-bit sums over each row's set; equal sets have equal values."""
    n = np.bincount(rows, minlength=count)
    at = np.concatenate([[0], np.cumsum(n)])
    out = []
    for key in (_FP1, _FP2):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(hashes ^ key))])
        out.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
    return n, out[0], out[1]


@dataclass(frozen=True)
class Scheme:
    """How sets of one size band are cut: segments of the universe, and how many of them also index one-deletions."""

    band: int
    segments: int
    deletions: int


def allowed(n: np.ndarray | int, percent: int):
    """Most elements in which a set of n differs from any set with 100*intersection >= percent*union."""
    return (100 - percent) * n // percent


def allocate(bands: dict[int, tuple[int, float]], percent: int, met: dict[int, tuple[float, float]] | None = None, partner_cost: float = 0.02) -> dict[int, Scheme]:
    """The cheapest scheme of each band 2^b <= size < 2^(b+1), from its number of sets and their mean size.

    By the pigeonhole principle a set needs segments whose weights exceed its allowed differences; a segment of
    weight 1 is found again only when equal (one row), one of weight 2 also with one element more or less (one row
    and one for each deletion). met has, for each band, the share of elements that recur in other sets and in how many
    on average. Cost of a set: its index rows, and partner_cost for each partner expected to share a row by chance: a
    segment of m elements recurs with probability share^m. A partner costs little beside a row, as the members of a
    bucket meet its first one, and each other only by bit sketches. So deletions, which make fewer and longer segments but
    more rows of each, pay where a moderate share of the elements recurs very often (a passage that many texts have).
    Segments are a third more than needed, as some stay empty.
    """
    out = {}
    for band in sorted(set(bands) | {b + 1 for b in bands}):
        most = allowed((2 << band) - 1, percent) + 1
        size = bands.get(band, bands.get(band - 1, (0, 0.0)))[1] or 1.5 * (1 << band)
        shared, partners = (met or {}).get(band, (met or {}).get(band - 1, (0.0, 0.0)))
        costs = []
        for share in (0.0, 0.25, 0.5, 1.0):
            segments = int(np.ceil(1.3 * most / (1 + share))) + 2
            mean, used = size / segments, (allowed(size, percent) + 1) / (1 + share)
            rows = used * (1 + share * mean)
            chance = (1 - share) * shared**mean + share * (1 + mean) * shared ** max(mean - 1, 0)
            costs.append((rows + partner_cost * used * partners * chance, share, segments))
        _, share, segments = min(costs)
        out[band] = Scheme(band, segments, int(share * segments))
    return out


def signatures(rows: np.ndarray, hashes: np.ndarray, count: int, schemes: dict[int, Scheme], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) pairs such that any two linked, different sets share a signature.

    Each set is cut by its own band's scheme and, if a linked set can be in the next band, by that one too. Segments
    are taken in order until the weights of those not empty exceed the allowed differences. A set with too few of
    them takes all and also signs its empty segments, so two such sets meet as well.
    """
    n = np.bincount(rows, minlength=count)
    band = np.frexp(np.maximum(n, 1))[1] - 1
    differ = allowed(n, percent)
    grows = np.frexp(np.maximum(100 * n // percent, 1))[1] - 1 > band
    out_rows, out_sigs = [], []
    for step in (0, 1):
        part = np.flatnonzero((differ > 0) & ((step == 0) | grows))
        if not len(part):
            continue
        cut = [schemes[b] for b in (band[part] + step).tolist()]
        m = np.array([s.segments for s in cut])
        two = np.array([s.deletions for s in cut])
        local = np.full(count, -1)
        local[part] = np.arange(len(part))
        own = local[rows]
        h, own = hashes[own >= 0], own[own >= 0]
        base = np.concatenate([[0], np.cumsum(m)])
        tag = mixed((band[part] + step).astype(U64) * _SEG)
        seg = ((mixed(h ^ tag[own]) >> U64(32)) * m[own].astype(U64) >> U64(32)).astype(np.int64)
        slot = base[own] + seg
        item = mixed(h ^ _ITEM)
        total = int(base[-1])
        size = np.bincount(slot, minlength=total)
        sums = np.zeros(total, U64)
        for shift in (0, 22, 44):  # exact in doubles: each part has at most 22 bits
            bits = ((item >> U64(shift)) & U64(0x3FFFFF)).astype(np.float64)
            sums += np.bincount(slot, bits, total).astype(U64) << U64(shift)
        owner = np.repeat(np.arange(len(part)), m)
        index = np.arange(total) - base[owner]
        weight = np.where(size == 0, 0, np.where((index < two[owner]) & (size > 1), 2, 1))
        before = np.cumsum(weight) - weight
        before -= before[base[:-1]][owner]
        taken = (size > 0) & (before <= differ[part][owner])
        short = np.add.reduceat(weight, base[:-1]) <= differ[part]
        taken |= short[owner] & (size == 0)
        place = mixed(tag[owner] + index.astype(U64) * _SIDE)
        out_rows.append(part[owner[taken]])
        out_sigs.append(mixed(sums[taken] + place[taken]))
        lessen = taken[slot] & (weight[slot] == 2)
        out_rows.append(part[own[lessen]])
        out_sigs.append(mixed(sums[slot[lessen]] - item[lessen] + place[slot[lessen]]))
    if not out_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_rows), np.concatenate(out_sigs).view(np.int64)

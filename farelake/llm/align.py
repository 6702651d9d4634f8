"""Banded alignment of token sequences: edit similarity of many pairs at once.

The edit distance of a pair is needed only up to the threshold's bound, so the
table is computed in a band around the diagonal. The band starts narrow and
widens fourfold until the distance fits into it (then it is exact) or it has
reached the bound. Pairs of one width go through the rows together.
"""

from __future__ import annotations

import numpy as np

FIRST_BAND = 8
CELLS = 1 << 15
#: Tokens of the pairs that go through the rows together.
TOKENS = 1 << 20
FAR = 1 << 29


def common_tokens(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sequences as bags."""
    ka, na = np.unique(a, return_counts=True)
    kb, nb = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    return int(np.minimum(na, nb[at])[kb[at] == ka].sum())


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sequences without their common start and end."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    start = int(differ.argmax()) if differ.any() else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    if n:
        differ = a[len(a) - n:][::-1] != b[len(b) - n:][::-1]
        end = int(differ.argmax()) if differ.any() else n
        a, b = a[:len(a) - end], b[:len(b) - end]
    return a, b


def band_distances(pairs: list[tuple[np.ndarray, np.ndarray]], w: int) -> np.ndarray:
    """Edit distances of pairs (shorter first) as far as a band of half-width w shows; else above w."""
    p, width = len(pairs), 2 * w + 1
    n, m = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    rows = int(n.max())
    left = np.zeros((p, rows), np.int64)
    right = np.full((p, rows + width + 1), -1, np.int64)  # column c of row i is token i + c - w
    for k, (a, b) in enumerate(pairs):
        left[k, :len(a)] = a
        some = b[:rows + w + 1]
        right[k, w:w + len(some)] = some
    column = np.arange(width, dtype=np.int32)
    row = np.where(column >= w, column - w, FAR).astype(np.int32)[None, :].repeat(p, 0)
    out = np.full(p, FAR)
    last = m - n + w
    done = np.flatnonzero(n == 0)
    out[done] = row[done, last[done]]
    ends: dict[int, list[int]] = {}
    for k, x in enumerate(n):
        ends.setdefault(int(x), []).append(k)
    pad = np.full((p, 1), FAR, np.int32)
    for i in range(rows):
        best = row + (left[:, i:i + 1] != right[:, i:i + width])
        np.minimum(best, np.concatenate([row[:, 1:], pad], axis=1) + 1, out=best)
        row = (np.minimum.accumulate(best - column, axis=1) + column).astype(np.int32)
        if i + 1 in ends:
            k = ends[i + 1]
            out[k] = row[k, last[k]]
    return out


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], least: float) -> np.ndarray:
    """Whether each pair's ``1 - distance / longer length`` is at least ``least``; two empty ones are."""
    out = np.zeros(len(pairs), bool)
    open_: list[tuple[int, np.ndarray, np.ndarray, int]] = []
    for k, (a, b) in enumerate(pairs):
        if len(a) > len(b):
            a, b = b, a
        bound = int((1 - least) * len(b) + 1e-9)
        if len(b) - len(a) > bound:
            continue
        if not len(a):
            out[k] = len(b) <= bound
            continue
        if len(b) - common_tokens(a, b) > bound:
            continue
        a, b = _trimmed(a, b)
        if not len(a):
            out[k] = len(b) <= bound
        else:
            open_.append((k, a, b, bound))
    w = FIRST_BAND
    while open_:
        later = [x for x in open_ if min(w, x[3]) < len(x[2]) - len(x[1])]
        now = sorted((x for x in open_ if min(w, x[3]) >= len(x[2]) - len(x[1])),
                     key=lambda x: (min(w, x[3]), len(x[1])))
        at = 0
        while at < len(now):
            width = min(w, now[at][3])
            most = max(1, CELLS // (2 * width + 1))
            # Lengths ascend, so the last text of a batch is its longest.
            cut = [x for k, x in enumerate(now[at:at + most])
                   if min(w, x[3]) == width and (k == 0 or (k + 1) * len(x[1]) <= TOKENS)]
            found = band_distances([(x[1], x[2]) for x in cut], width)
            for x, d in zip(cut, found, strict=True):
                if d <= width:
                    out[x[0]] = d <= x[3]
                elif width < x[3]:
                    later.append(x)
            at += len(cut)
        open_, w = later, w * 4
    return out

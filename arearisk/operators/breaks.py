"""Helper for one group of bins: least-squares breaks and the bins still in doubt.

Works on a bounded, sorted set of bins (count, sum, sum of squares, lowest and
highest value); Spark builds the bins and runs one call per group.
"""

from __future__ import annotations

import numpy as np


def _spread(n: np.ndarray, s: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Within-class sum of squares of bins i..j-1 from prefix sums."""
    m = n[j] - n[i]
    t = s[j] - s[i]
    with np.errstate(invalid="ignore", divide="ignore"):
        out = (q[j] - q[i]) - np.where(m > 0, t * t / m, 0.0)
    return np.maximum(out, 0.0)


def _extend(prev: np.ndarray, n: np.ndarray, s: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """best[p] = min over h <= p of prev[h] + spread(h, p), with the smallest such h.

    The best h never moves left as p grows, so positions are solved in
    halving steps, each bounded by its solved neighbours.
    """
    size = len(prev)
    best = np.full(size, np.inf)
    arg = np.zeros(size, dtype=np.int64)
    step = 1
    while step < size:
        step *= 2
    known = np.zeros(0, dtype=np.int64)
    while step >= 1:
        at = np.arange(0, size, step) if known.size == 0 else np.arange(step, size, 2 * step)
        if at.size:
            lo = np.zeros(at.size, dtype=np.int64) if known.size == 0 else arg[at - step]
            nxt = at + step
            hi = at.copy()
            if known.size:
                inner = nxt < size
                hi[inner] = np.minimum(at[inner], arg[nxt[inner]])
            lo = np.minimum(lo, hi)
            length = hi - lo + 1
            start = np.concatenate(([0], np.cumsum(length)[:-1]))
            h = np.arange(length.sum()) - np.repeat(start, length) + np.repeat(lo, length)
            cost = prev[h] + _spread(n, s, q, h, np.repeat(at, length))
            low = np.minimum.reduceat(cost, start)
            first = np.where(cost <= np.repeat(low, length), h, size)
            best[at] = low
            arg[at] = np.minimum.reduceat(first, start)
            known = at
        step //= 2
    return best, arg


def _centroid(n, s, i, j, empty):
    """Mean of bins i..j-1 from prefix sums; `empty` where the range holds nothing."""
    m = n[j] - n[i]
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(m > 0, (s[j] - s[i]) / m, empty)


def solve(n, s, q, lo, hi, k: int, closed=None, tighten: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Class (from the bottom, 0-based) of every bin, and whether a break may lie inside it.

    Values are relative to any fixed centre. In the best solution a break lies
    midway between the means of its two classes. Sending all points of the bin
    around it to one side costs 2 * gap * (their distances to the break on the
    other side); the cheaper side costs at most gap * count * width / 2, with
    gap the distance of the two means, and the same choice works for several
    breaks in one bin. So edge solutions credited with that amount per break
    are a lower bound, and a bin is closed once no credited solution through
    its edges beats the best edge solution. Knowing where the neighbouring
    breaks can be bounds the gap, which is used to tighten the credit. Bins
    marked `closed` were settled before and stay so.
    """
    d = len(n)
    if d <= k and bool(np.all(hi <= lo)):
        return np.arange(d), np.zeros(d, dtype=bool)
    pn, ps, pq = (np.concatenate(([0.0], np.cumsum(a))) for a in (n, s, q))
    edge = np.arange(d + 1)
    zero = np.zeros(d + 1, dtype=np.int64)

    # Best solution with breaks at bin edges only.
    first = _spread(pn, ps, pq, zero, edge)
    args = []
    cost = first
    for _ in range(k - 1):
        cost, a = _extend(cost, pn, ps, pq)
        args.append(a)
    best = cost[d]
    cls = np.zeros(d, dtype=np.int64)
    right = d
    for j in range(k - 1, 0, -1):
        left = args[j - 1][right]
        cls[left:right] = j
        right = left

    wide = hi > lo
    if closed is not None:
        wide &= ~closed
    if k < 2 or not wide.any():
        return cls, np.zeros(d, dtype=bool)
    limit = best + 1e-9 * max(first[d], 1e-300)
    rn, rs, rq = (np.concatenate(([0.0], np.cumsum(a[::-1]))) for a in (n, s, q))
    last = _spread(rn, rs, rq, zero, edge)[::-1]
    gap = [np.full(d, hi[-1] - lo[0]) for _ in range(k - 1)]
    bins = np.arange(d)
    open_ = wide
    for _ in range(tighten):
        credit = []
        for j in range(k - 1):
            slack = np.where(wide, gap[j] * n * (hi - lo) / 2.0, 0.0)
            c = np.zeros(d + 1)
            c[:-1] = slack
            c[1:] = np.maximum(c[1:], slack)
            credit.append(c)
        # left[j][p]: best credited solution of the first p bins in j + 1 classes; rest likewise from the right.
        left = [first]
        for j in range(k - 2):
            left.append(_extend(left[-1] - credit[j], pn, ps, pq)[0])
        rest = [last]
        for j in range(k - 2, 0, -1):
            rest.append(_extend((rest[-1] - credit[j])[::-1], rn, rs, rq)[0][::-1])
        alive = [left[j] + rest[k - 2 - j] - credit[j] <= limit for j in range(k - 1)]
        touched = np.zeros(d + 1, dtype=bool)
        for a in alive:
            touched |= a
        before, open_ = int(open_.sum()), wide & (touched[:-1] | touched[1:])
        if open_.sum() > 0.9 * before or not all(a.any() for a in alive):
            break
        ends = [(max(int(edge[a].min()) - 1, 0), min(int(edge[a].max()) + 1, d)) for a in alive]
        reach = hi[-1] - lo[0]
        for j in range(k - 1):
            start = ends[j - 1][0] if j else 0
            stop = ends[j + 1][1] if j < k - 2 else d
            low = _centroid(pn, ps, np.minimum(start, bins), bins, -np.inf)
            high = _centroid(pn, ps, bins + 1, np.maximum(stop, bins + 1), np.inf)
            gap[j] = np.minimum(np.minimum(high - low, gap[j]), reach)
    return cls, open_

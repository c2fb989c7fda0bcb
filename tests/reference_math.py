"""Row-by-row versions of the metrics, for comparison on small inputs."""

import numpy as np


def ks(pos, neg):
    grid = np.unique(np.concatenate([pos, neg]))
    return max(abs(np.mean(pos <= x) - np.mean(neg <= x)) for x in grid)


def delta(pos, neg):
    gap = np.asarray(pos)[:, None] - np.asarray(neg)[None, :]
    return ((gap > 0).sum() - (gap < 0).sum()) / gap.size


def bins(pos, neg, n_bins, mode):
    rows = sorted([(v, 0) for v in neg] + [(v, 1) for v in pos])
    n = len(rows)
    if mode == "floor":
        n_bins = min(n_bins, len({v for v, _ in rows}))
        ids = [min(n_bins - 1, i * n_bins // n) for i in range(n)]
    else:
        size, longer = divmod(n, n_bins)
        ids = [b for b in range(n_bins) for _ in range(size + (b < longer))]
    out = []
    for b in sorted(set(ids)):
        mine = [rows[i] for i in range(n) if ids[i] == b]
        n_pos = sum(label for _, label in mine)
        share = (n_pos + 0.5) / (len(pos) + 0.5 * n_bins), (len(mine) - n_pos + 0.5) / (len(neg) + 0.5 * n_bins)
        out.append((b + 1, mine[0][0], mine[-1][0], len(mine), n_pos, (share[0] - share[1]) * np.log(share[0] / share[1])))
    return out


def average_precision(rows):
    """rows: (score, amount, label)"""
    tp = total = 0.0
    n_pos = sum(label for _, _, label in rows)
    for i, (_, _, label) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1], r[2])), 1):
        tp += label
        total += tp / i if label else 0.0
    return total / n_pos if n_pos else 0.0

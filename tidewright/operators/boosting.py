"""Boosted trees of rows that one task holds: all rounds in a row, with no job in between.

Every tree is grown over all rows and features, as by ``grown.grow`` with weights of one. A node costs the rows of its
smaller child: the sums of the other are the node's own without them. Rows of a node lie side by side, nodes of more than
``BRANCH_ROWS`` rows are cut one by one and the branches below level by level. The rows' own leaves give the next labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Rows of a branch that is grown level by level; its rows and sums stay in a core's cache.
BRANCH_ROWS = 40_000
# Sums of a level per value of its rows up to which they are held; beyond, the rows are sorted.
SUMS_PER_VALUE = 4
# Least loss of variance by a cut, as a share of the node's, so that rounding cuts nothing.
LEAST_GAIN = 1e-9


def _words(bins: np.ndarray) -> np.ndarray:
    """One value per row, so that a row moves in one piece."""
    n, features = bins.shape
    if features > 8:
        return np.ascontiguousarray(bins).view(np.dtype((np.void, features))).ravel()
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :features] = bins
    return wide.view(np.uint64).ravel()


def _bins(words: np.ndarray) -> np.ndarray:
    return words.view(np.uint8).reshape(len(words), words.dtype.itemsize)


def _sums(words: np.ndarray, y: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and labels of one node per bin."""
    count, summed = np.zeros(starts[-1]), np.zeros(starts[-1])
    for at in range(0, len(y), BRANCH_ROWS):
        bins, label = _bins(words[at:at + BRANCH_ROWS]), y[at:at + BRANCH_ROWS]
        for f, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            key = bins[:, f].astype(np.intp)
            count[a:b] += np.bincount(key, minlength=b - a)
            summed[a:b] += np.bincount(key, label, b - a)
    return count, summed


def _sums_of_many(words: np.ndarray, y: np.ndarray, own: np.ndarray, k: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and labels per node and bin."""
    cells, features = starts[-1], len(starts) - 1
    key = (own * cells)[:, None] + starts[:-1]
    key += _bins(words)[:, :features]
    key = key.ravel()
    return (np.bincount(key, minlength=k * cells).reshape(k, cells).astype(np.float64),
            np.bincount(key, np.repeat(y, features), k * cells).reshape(k, cells))


def _without(sums: tuple[np.ndarray, np.ndarray], less: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of a node's other child."""
    count, summed = sums[0] - less[0], sums[1] - less[1]
    summed[count == 0] = 0.0  # no rest of rounding where no row is
    return count, summed


def _best_summed(count: np.ndarray, summed: np.ndarray, total: np.ndarray, mean: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, bin and gain of each node's best cut, and the rows it leaves on the left; gain -1: no cut."""
    # Every feature's rows add up to the node's, and their deviations from its mean to nothing: one run over all bins.
    lw = np.cumsum(count, axis=1)
    lw -= total[:, None] * np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    off = count * -mean[:, None]
    off += summed
    np.cumsum(off, axis=1, out=off)
    both = total[:, None] - lw
    both *= lw
    np.maximum(both, 1.0, out=both)
    off *= off
    off /= both
    place = off.argmax(axis=1)
    at = np.arange(len(total))
    n_left = lw[at, place].astype(np.int64)
    feature = np.searchsorted(starts, place, side="right") - 1
    gain = np.where((n_left > 0) & (n_left < total), off[at, place] * total, -1.0)
    return feature.astype(np.int16), place - starts[feature], gain, n_left


def _best_sorted(bins: np.ndarray, y: np.ndarray, own: np.ndarray, total: np.ndarray, mean: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """As ``_best_summed``, over the bins that occur: for many nodes of few rows."""
    k, features = len(total), bins.shape[1]
    key = ((own[:, None] * features + np.arange(features)) * width + bins).ravel()
    order = np.argsort(key, kind="stable")
    key, row = key[order], order // features
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    part = key[last] // width
    new = np.append(True, part[1:] != part[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(part)), 0))
    run_y, run_n = np.cumsum((y - mean[own])[row])[last], last + 1
    off, lw = run_y - np.append(0.0, run_y)[start], run_n - np.append(0, run_n)[start]
    node = part // features
    rw = total[node] - lw
    found = np.where(rw > 0, off * off * total[node] / np.maximum(lw * rw, 1), -1.0)
    begin = np.searchsorted(node, np.arange(k))
    best = np.maximum.reduceat(found, begin)
    place = np.flatnonzero(found == np.repeat(best, np.diff(np.append(begin, len(found)))))
    place = place[np.unique(node[place], return_index=True)[1]]
    return (part[place] % features).astype(np.int16), key[last[place]] % width, best, lw[place]


def _spread_out(spread, total, mean):
    """Whether labels differ by more than rounding."""
    return spread > 1e-12 * np.maximum(1.0, total * mean * mean)


def _branch(words: np.ndarray, y: np.ndarray, levels: int, sums: tuple | None, starts: np.ndarray, done: list) -> tuple[np.ndarray, ...]:
    """The nodes of a branch of few rows, level by level; its rows go to ``done`` with the mean of their leaf."""
    features, out, first, width = len(starts) - 1, [], 0, int(np.diff(starts).max())
    size, spot = np.array([len(y)]), np.zeros(1, np.int64)  # spot: a node's place on its level
    sums = sums and (sums[0][None], sums[1][None])
    for level in range(levels + 1):
        k = len(size)
        own = np.repeat(np.arange(k), size)
        begin = np.append(0, np.cumsum(size)[:-1])
        mean = np.add.reduceat(y, begin) / size
        means = mean[own]
        feature, cut, left = np.full(k, -1, np.int16), np.zeros(k, np.uint8), np.zeros(k, np.int32)
        split = n_left = np.zeros(0, np.int64)
        if level < levels:
            away = y - means
            spread = np.add.reduceat(away * away, begin)
            live = np.flatnonzero(_spread_out(spread, size, mean))
            if len(live):
                if sums:
                    f, c, gain, n_left = _best_summed(sums[0][live], sums[1][live], size[live], mean[live], starts)
                else:
                    number = np.full(k, -1)
                    number[live] = np.arange(len(live))
                    number = number[own]
                    some = np.flatnonzero(number >= 0)
                    f, c, gain, n_left = _best_sorted(_bins(words[some])[:, :features], y[some], number[some], size[live], mean[live], width)
                good = gain > LEAST_GAIN * spread[live]
                split, n_left = live[good], n_left[good]
                feature[split], cut[split] = f[good], c[good]
        # Children in the order of their parents on the level: a right one follows its left one.
        rank = np.argsort(np.argsort(spot[split], kind="stable"), kind="stable")
        left[split] = first + k + 2 * rank
        placed = np.argsort(spot, kind="stable")
        out.append((feature[placed], cut[placed], left[placed], mean[placed]))
        first += k
        if not len(split):
            done.append((words, y, means))
            break
        side = np.take(_bins(words).ravel(), np.arange(0, len(y) * words.dtype.itemsize, words.dtype.itemsize) + np.maximum(feature, 0)[own]) > cut[own]
        if len(split) < k:
            stays = (feature >= 0)[own]
            gone = np.flatnonzero(~stays)
            done.append((words[gone], y[gone], means[gone]))
            low, high = np.flatnonzero(stays & ~side), np.flatnonzero(stays & side)
        else:
            low, high = np.flatnonzero(~side), np.flatnonzero(side)
        s, n = len(split), size[split]
        if sums and level + 1 < levels and 2 * s * starts[-1] <= SUMS_PER_VALUE * (len(low) + len(high)) * features:
            less = n_left <= n - n_left
            number = np.full(k, -1)
            number[split] = np.arange(s)
            fewer = np.zeros(k, bool)
            fewer[split] = less
            small = np.flatnonzero((side != fewer[own]) & (number[own] >= 0) if len(split) < k else side != fewer[own])
            count, summed = _sums_of_many(words[small], y[small], number[own[small]], s, starts)
            count_rest, summed_rest = _without((sums[0][split], sums[1][split]), (count, summed))
            less = less[:, None]
            sums = (np.concatenate([np.where(less, count, count_rest), np.where(less, count_rest, count)]),
                    np.concatenate([np.where(less, summed, summed_rest), np.where(less, summed_rest, summed)]))
        else:
            sums = None
        words, y = np.concatenate([words[low], words[high]]), np.concatenate([y[low], y[high]])
        size, spot = np.concatenate([n_left, n - n_left]), np.concatenate([2 * rank, 2 * rank + 1])
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def tree(words: np.ndarray, y: np.ndarray, depth: int, starts: np.ndarray) -> tuple[tuple[np.ndarray, ...], list]:
    """Feature (-1: leaf), cut, left child and mean of every node, and the rows by leaf: words, labels, mean of the leaf."""
    done, made, tall = [], [], 1  # made: a node's place with its columns, or places with those of a branch
    waiting = [(words, y, 0, 0, _sums(words, y, starts))]
    del words, y
    while waiting:
        words, y, place, level, sums = waiting.pop()
        n = len(y)
        if n <= BRANCH_ROWS:
            feature, cut, left, mean = _branch(words, y, depth - level, sums, starts, done)
            made.append((np.append(place, np.arange(tall, tall + len(feature) - 1)), feature, cut, np.where(feature >= 0, left + tall - 1, 0), mean))
            tall += len(feature) - 1
            continue
        mean = y.sum() / n
        away = y - mean
        away *= away
        spread, gain = away.sum(), -1.0
        if level < depth and _spread_out(spread, n, mean):
            f, c, gain, n_left = (v[0] for v in _best_summed(sums[0][None], sums[1][None], np.array([n]), np.array([mean]), starts))
        if gain <= LEAST_GAIN * spread:
            done.append((words, y, np.full(n, mean)))
            made.append(([place], [-1], [0], [0], [mean]))
            continue
        made.append(([place], [f], [c], [tall], [mean]))
        side = _bins(words)[:, f] > c
        sides = [(words[at], y[at]) for at in (np.flatnonzero(~side), np.flatnonzero(side))]
        del words, y, away
        own = [None, None]
        if level + 1 < depth:
            fewer = int(n_left > n - n_left)
            own[fewer] = _sums(*sides[fewer], starts)
            own[1 - fewer] = _without(sums, own[fewer])
        waiting += [(*sides[i], tall + i, level + 1, own[i]) for i in (1, 0)]
        tall += 2
    place, *columns = (np.concatenate(c) for c in zip(*made, strict=True))
    at = np.empty(tall, np.int64)
    at[place] = np.arange(tall)
    return tuple(c[at].astype(t) for c, t in zip(columns, (np.int16, np.uint8, np.int32, np.float64), strict=True)), done


def _starts(bins: np.ndarray) -> np.ndarray:
    """Where each feature's bins begin, and where the last one's end."""
    return np.append(0, np.cumsum(bins.max(axis=0).astype(np.int64) + 1))


def branch(bins: np.ndarray, y: np.ndarray, levels: int) -> tuple[np.ndarray, ...]:
    """The nodes of one tree of at most so many levels of cuts."""
    return tree(_words(bins), y, levels, _starts(bins))[0]


def boosted(bins: np.ndarray, label: np.ndarray, rounds: int, depth: int, step: float) -> Iterator[tuple[np.ndarray, ...]]:
    """One tree per round; each learns twice the error of those before, the slope of the squared loss."""
    words, starts = _words(bins), _starts(bins)
    for number in range(rounds):
        nodes, done = tree(words, label, depth, starts)
        yield nodes
        words = np.concatenate([w for w, _, _ in done])
        label = np.concatenate([2 * (y - mean) if number == 0 else y - 2 * step * mean for _, y, mean in done])

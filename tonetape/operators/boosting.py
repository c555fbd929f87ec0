"""Boosted trees on histograms: many fits grown together, every round of each one scored.

Features are binned once, into a written table of (label, fold, draw, bins, scores).
A pass over it takes the scores so far, adds the trees since they were written, and sums
what a split needs by fit, class, node, feature and bin; the sums of a fit meet in one
task, which sends its best splits to the driver.  So rows never leave their tasks, the
driver holds trees and no sums, and a pass serves all fits of a search: the points of a
grid that differ in the number of rounds are prefixes of one fit, and the accuracy of
every prefix on the fold a fit leaves out comes with the pass of the next round.

The scores of stumps are sums over features of what a bin got so far, so they are looked
up in a pass and neither stored nor written anew.

Two ways to boost share this: gradients of the softmax loss, one regression tree per
class and round, with second-order leaf values (Chen and Guestrin 2016); and stumps on
reweighted rows (SAMME; Zhu et al. 2009), whose weights are exp(-votes for the label).
"""

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetape.session import materialised, release

BINS = 32
#: Values probed for each cut, rounds between two writes of the scores, and numbers in one array of a task.
PROBES, EVERY, STEP = 8, 20, 1 << 21
#: Penalty on leaf values, least second-order weight of a leaf, and first score.
LAMBDA, LEAST, START = 1.0, 1.0, 0.5


@dataclass(frozen=True)
class Fit:
    """One fit: rounds, step size, depth, shares of rows and columns a tree sees, and the fold left out (-1: none)."""

    rounds: int
    rate: float
    depth: int = 1
    rows: float = 1.0
    cols: float = 1.0
    without: int = -1


@dataclass
class Grown:
    """Trees of a fit as heaps (children of node i: 2i + 1 and 2i + 2), by round and class.

    feature is -1 in a leaf; `cut` is the bin, at most which goes left.  losses and
    accuracies have an entry for each number of rounds from 0 on."""

    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    gain: list[np.ndarray] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    accuracies: list[float] = field(default_factory=list)
    done: bool = False


def cut_points(df: DataFrame, vec: str, size: int, bins: int = BINS) -> list[list[float]]:
    """Thresholds of each feature, at most bins - 1: midpoints between neighbours among its quantiles.

    A feature with few values, each on enough rows to be a quantile, is cut between all
    of them; one with missing values (NaN) also after its largest, as they go last."""
    probes = [i / (bins * PROBES) for i in range(bins * PROBES + 1)]
    x = vector_to_array(F.col(vec))
    known = [F.nullif(x[j], F.lit(float("nan"))) for j in range(size)]
    row = df.agg(
        *[F.percentile_approx(v, probes, 100_000).alias(f"q{j}") for j, v in enumerate(known)],
        *[F.max(v).alias(f"most{j}") for j, v in enumerate(known)],
        *[F.max(F.isnan(x[j])).alias(f"gaps{j}") for j in range(size)],
    ).first()
    out = []
    for j in range(size):
        seen = sorted(set(row[f"q{j}"] or []))
        middle = [(a + b) / 2 for a, b in zip(seen, seen[1:])]
        last = [row[f"most{j}"]] if row[f"gaps{j}"] and seen else []
        many = bins - 1 - len(last)
        if len(middle) > many:
            middle = sorted({middle[round(i * (len(middle) - 1) / (many - 1))] for i in range(many)})
        out.append(middle + last)
    return out


def binned(df: DataFrame, vec: str, label: str, cuts: Sequence[Sequence[float]], fold: str | None, fits: int, classes: int, start: float) -> DataFrame:
    """The table that passes read.  A missing feature value goes to the last bin.

    draw tells rows apart for the shares of rows; it depends on the row's features, label and fold alone."""
    own = df.select(vector_to_array(F.col(vec)).alias("x"), F.col(label).cast("int").alias("label"), (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))
    own = own.withColumn("draw", F.xxhash64("x", "label", "fold"))

    def put(batches):
        for b in batches:
            n = b.num_rows
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, len(cuts)))
            bins = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)
            scores = np.full((1, fits, classes), start).tobytes()
            arrays = [b.column("label"), b.column("fold"), b.column("draw"), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array([scores] * n, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "fold", "draw", "bins", "scores"])

    return materialised(own.mapInArrow(put, "label int, fold int, draw long, bins binary, scores binary"))


def uniform(draw: np.ndarray, turn: int) -> np.ndarray:
    """A number in [0, 1) for each row and round."""
    h = draw.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


def columns_of(fit: Fit, turn: int, k: int, size: int) -> np.ndarray:
    """Which features the tree of a round and class may split on; the share rounded down, one at least."""
    many = max(1, int(fit.cols * size + 1e-9))
    return np.isin(np.arange(size), np.random.default_rng([turn, k, many]).permutation(size)[:many])


def places(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Nodes that rows reach after so many levels, by fit and class; feature and cut are (fit, class, node)."""
    fits, classes, _ = feature.shape
    node = np.zeros((len(bins), fits, classes), np.int64)
    a, k, row = np.arange(fits)[:, None], np.arange(classes), np.arange(len(bins))[:, None, None]
    for _ in range(levels):
        f = feature[a, k, node]
        right = bins[row, np.maximum(f, 0)] > cut[a, k, node]
        node = np.where(f >= 0, 2 * node + 1 + right, node)
    return node


def added(scores: np.ndarray, bins: np.ndarray, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """scores (row, fit, class) and what trees (feature, cut, value by fit, class and node) add to them."""
    a, k = np.arange(scores.shape[1])[:, None], np.arange(scores.shape[2])
    for feature, cut, value in trees:
        depth = (feature.shape[2] + 1).bit_length() - 2
        scores = scores + value[a, k, places(bins, feature, cut, depth)]
    return scores


def chunks(batches: Iterator[pa.RecordBatch], fits: int, classes: int, held: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """label, fold, draw, bins and scores (None if not held) of the rows, so many at a time that an array holds STEP numbers."""
    many = max(1, STEP // (fits * classes))
    for whole in batches:
        for low in range(0, whole.num_rows, many):
            b = whole.slice(low, many)
            n = b.num_rows
            label, fold, draw = (b.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold", "draw"))
            bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(n, -1)
            scores = np.frombuffer(b"".join(b.column("scores").to_pylist())).reshape(n, fits, classes) if held else None
            yield label, fold, draw, bins, scores


def rescored(table: DataFrame, trees: list, fits: int, classes: int) -> DataFrame:
    """table with trees added to its scores, written; the old one is deleted."""

    def add(batches):
        for label, fold, draw, bins, scores in chunks(batches, fits, classes):
            scores = added(scores, bins, trees)
            arrays = [pa.array(label), pa.array(fold), pa.array(draw), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (bins, scores))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "fold", "draw", "bins", "scores"])

    out = materialised(table.mapInArrow(add, table.schema))
    release(table)
    return out


def pass_over(table: DataFrame, fits: int, classes: int, active: list[int], partial: Callable, choose: Callable, held: bool = True) -> dict[int, np.ndarray]:
    """For each active fit, choose(fit, sums) of the sums over all rows of partial(chunk), whose first axis is active.

    Sums of one fit meet in one task: their size follows its nodes and bins, not the rows."""

    def summed(batches):
        total = None
        for chunk in chunks(batches, fits, classes, held):
            got = partial(*chunk)
            total = got if total is None else np.add(total, got, out=total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(active, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], names=["fit", "sums"])

    def chosen(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column("fit").to_pylist(), b.column("sums").to_pylist()):
                sums = np.frombuffer(raw)
                total[i] = total[i] + sums if i in total else sums
        if total:
            out = [np.ascontiguousarray(choose(i, s), float).tobytes() for i, s in total.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(out, pa.binary())], names=["fit", "sums"])

    kind = "fit int, sums binary"
    rows = table.mapInArrow(summed, kind)
    # One fit has one task of sums, whatever the session's number of partitions.
    rows = rows.repartition(1) if len(active) == 1 else rows.repartition("fit")
    got = rows.mapInArrow(chosen, kind).toArrow()
    return {i: np.frombuffer(raw) for i, raw in zip(got.column("fit").to_pylist(), got.column("sums").to_pylist())}


def best_splits(g: np.ndarray, h: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Best split of each class and node from sums by (class, node, feature, bin): feature (-1: none), bin, gain, sums left and right."""
    gl, hl = g.cumsum(3)[..., :-1], h.cumsum(3)[..., :-1]
    all_g, all_h = g[:, :, :1].sum(3), h[:, :, :1].sum(3)
    gr, hr = all_g[..., None] - gl, all_h[..., None] - hl
    gain = gl**2 / (hl + LAMBDA) + gr**2 / (hr + LAMBDA) - (all_g**2 / (all_h + LAMBDA))[..., None]
    gain = np.where((hl >= LEAST) & (hr >= LEAST) & allowed[:, None, :, None], gain, -np.inf)
    flat = gain.reshape(*gain.shape[:2], -1)
    at = flat.argmax(2)[..., None]
    pick = lambda x: np.take_along_axis(x.reshape(flat.shape), at, 2)
    best = pick(gain)
    cuts = gain.shape[3]
    # Rounding may leave a trace of gain where there is none.
    found = best > 1e-9
    return np.concatenate([np.where(found, at // cuts, -1), at % cuts, best, pick(gl), pick(hl), pick(gr), pick(hr), all_g, all_h], axis=2)


def tail_sums(label, fold, scores, without: np.ndarray) -> np.ndarray:
    """By fit: loss and number of the rows it learns from, hits and number of those it leaves out."""
    top = scores.max(2, keepdims=True)
    log_p = scores - top - np.log(np.exp(scores - top).sum(2, keepdims=True))
    row = np.arange(len(label))
    held = fold[:, None] == without
    loss, hit = -log_p[row, :, label], scores.argmax(2) == label[:, None]
    return np.stack([(loss * ~held).sum(0), (~held).sum(0), (hit & held).sum(0), held.sum(0)], axis=1)


def note(grown: Grown, tail: np.ndarray) -> None:
    loss, rows, hits, held = tail
    grown.losses.append(float(loss / rows) if rows else math.nan)
    grown.accuracies.append(float(hits / held) if held else math.nan)


def grow(table: DataFrame, fits: Sequence[Fit], classes: int, size: int, bins: int, stumps: bool = False, every: int = EVERY) -> list[Grown]:
    """All fits, grown together over a table made by `binned` for as many; the table is deleted."""
    fits = list(fits)
    grown = [Grown() for _ in fits]
    without, shares = np.array([f.without for f in fits]), np.array([f.rows for f in fits])
    shift = np.zeros(len(fits))
    # Stumps add up by feature and bin, so their scores are looked up and not stored.
    waiting = Tally(len(fits), classes, size, bins) if stumps else []
    most = max(f.rounds for f in fits)
    for turn in range(most + 1):
        # A fit that has ended takes part until its last round is scored.
        live = [i for i, f in enumerate(fits) if turn <= f.rounds and not (grown[i].done and len(grown[i].losses) > len(grown[i].feature))]
        if not live:
            break
        if not stumps and len(waiting) == every:
            table, waiting = rescored(table, waiting, len(fits), classes), []
        learn = [i for i in live if turn < fits[i].rounds and not grown[i].done]
        step = stump_round if stumps else softmax_round
        trees = step(table, fits, grown, live, learn, turn, classes, size, bins, waiting, without, shares, shift)
        if trees is not None:
            waiting.append(trees)
    release(table)
    return grown


def softmax_round(table, fits, grown, live, learn, turn, classes, size, bins, waiting, without, shares, shift):
    """One tree per class for each fit that still learns, a pass per level; the first pass scores the rounds before."""
    depth = max((fits[i].depth for i in learn), default=1)
    shape = (len(fits), classes, 2 ** (depth + 1) - 1)
    feature, cut, value, gain = np.full(shape, -1), np.zeros(shape, int), np.zeros(shape), np.zeros(shape)
    rates = np.array([f.rate for f in fits])
    for level in range(depth):
        wide, base = 2**level, 2**level - 1
        active = live if level == 0 else [i for i in learn if fits[i].depth > level and (feature[i, :, (base - 1) // 2 : base] >= 0).any()]
        if not active:
            break
        own, cells = np.array(active), wide * size * bins

        def partial(label, fold, draw, packed, scores, own=own, wide=wide, base=base, level=level, cells=cells):
            s = added(scores, packed, waiting)[:, own]
            p = np.exp(s - s.max(2, keepdims=True))
            p /= p.sum(2, keepdims=True)
            g, h = p - (np.arange(classes) == label[:, None, None]), 2 * p * (1 - p)
            node = places(packed, feature[own], cut[own], level) - base
            use = ((fold[:, None] != without[own]) & (uniform(draw, turn)[:, None] < shares[own]))[..., None] & (node >= 0)
            g, h = (g * use).ravel(), (h * use).ravel()
            at = (np.arange(len(own) * classes).reshape(len(own), classes) * wide + np.maximum(node, 0)) * size
            out = np.zeros((len(own), 2 * classes * cells + 4))
            for j in range(size):
                index = ((at + j) * bins + packed[:, j, None, None]).ravel()
                for part, x in enumerate((g, h)):
                    out[:, part * classes * cells : (part + 1) * classes * cells] += np.bincount(index, x, len(own) * classes * cells).reshape(len(own), -1)
            if level == 0:
                out[:, -4:] = tail_sums(label, fold, s, without[own])
            return out

        def choose(i, sums, wide=wide):
            g, h = sums[:-4].reshape(2, classes, wide, size, bins)
            allowed = np.array([columns_of(fits[i], turn, k, size) for k in range(classes)])
            return np.append(best_splits(g, h, allowed).ravel(), sums[-4:])

        for i, got in pass_over(table, len(fits), classes, active, partial, choose).items():
            if level == 0:
                note(grown[i], got[-4:])
            if i not in learn:
                continue
            f, b, w, gl, hl, gr, hr, all_g, all_h = np.moveaxis(got[:-4].reshape(classes, wide, 9), 2, 0)
            here = slice(base, base + wide)
            # Nodes that no row can reach stay leaves of value 0.
            feature[i, :, here], cut[i, :, here] = f, b
            gain[i, :, here] = np.where(f >= 0, w, 0)
            if level == 0:
                value[i, :, here] = np.where(f >= 0, 0, -rates[i] * all_g / (all_h + LAMBDA))
            value[i, :, here] = np.where(f >= 0, 0, value[i, :, here])
            left, right = slice(2 * base + 1, 2 * (base + wide) + 1, 2), slice(2 * base + 2, 2 * (base + wide) + 2, 2)
            value[i, :, left] = np.where(f >= 0, -rates[i] * gl / (hl + LAMBDA), 0)
            value[i, :, right] = np.where(f >= 0, -rates[i] * gr / (hr + LAMBDA), 0)
    if not learn:
        return None
    for i in learn:
        keep(grown[i], feature[i], cut[i], value[i], gain[i])
    return feature, cut, value


def keep(grown: Grown, feature, cut, value, gain) -> None:
    for name, x in (("feature", feature), ("cut", cut), ("value", value), ("gain", gain)):
        getattr(grown, name).append(x.copy())


def best_stump(weights: np.ndarray) -> tuple[int, int, int, int, float, float, float]:
    """Feature (-1: none), bin, class left and right, missed share, total and Gini gain, from weights by (class, feature, bin)."""
    total = weights[:, 0].sum(1)
    whole = total.sum()
    left = weights.cumsum(2)[..., :-1]
    right = total[:, None, None] - left
    impure = lambda w: w.sum(0) - (w**2).sum(0) / np.maximum(w.sum(0), 1e-300)
    gain = impure(total[:, None, None]) - impure(left) - impure(right)
    gain = np.where((left.sum(0) > 1e-12 * whole) & (right.sum(0) > 1e-12 * whole), gain, -np.inf)
    j, b = np.unravel_index(gain.argmax(), gain.shape)
    if not gain[j, b] > 1e-12 * whole:
        c = int(total.argmax())
        return -1, 0, c, c, 1 - total[c] / whole, whole, 0.0
    lo, hi = int(left[:, j, b].argmax()), int(right[:, j, b].argmax())
    return int(j), int(b), lo, hi, 1 - (left[lo, j, b] + right[hi, j, b]) / whole, whole, gain[j, b] / whole


class Tally:
    """The scores of stumps so far: what each bin of each feature adds, by fit and class, and what all rows get.

    A stump splits on one feature, so however many there are, a row's score is one number
    per feature."""

    def __init__(self, fits: int, classes: int, size: int, bins: int):
        self.all = np.zeros((fits, classes))
        self.by_bin = np.zeros((size, bins, fits, classes))

    def append(self, stumps: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        feature, cut, value = stumps
        for i, (j, b) in enumerate(zip(feature[:, 0, 0], cut[:, 0, 0])):
            if j < 0:
                self.all[i] += value[i, :, 0]
            else:
                self.by_bin[j, : b + 1, i] += value[i, :, 1]
                self.by_bin[j, b + 1 :, i] += value[i, :, 2]

    def of(self, own: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """For the fits in own: what all rows get, and the table by bin of each feature that a stump splits on."""
        return self.all[own], [(j, t[:, own].copy()) for j, t in enumerate(self.by_bin) if t[:, own].any()]


def stump_round(table, fits, grown, live, learn, turn, classes, size, bins, waiting, without, shares, shift):
    """One stump for each fit that still learns: a single pass sums the weights by class, feature and bin."""
    own, cells = np.array(live), size * bins
    every, by_bin = waiting.of(own)

    def partial(label, fold, draw, packed, scores):
        s = np.repeat(every[None], len(label), 0)
        for j, t in by_bin:
            s += t[packed[:, j]]
        use = (fold[:, None] != without[own]) & (uniform(draw, turn)[:, None] < shares[own])
        w = np.exp(-s[np.arange(len(label)), :, label] - shift[own]) * use
        out = np.zeros((len(own), classes * cells + 4))
        # The place of a weight is the same in all fits.
        columns = np.ascontiguousarray(w.T)
        for j in range(size):
            index = (label * size + j) * bins + packed[:, j]
            for i, x in enumerate(columns):
                out[i, :-4] += np.bincount(index, x, classes * cells)
        out[:, -4:] = tail_sums(label, fold, s, without[own])
        return out

    def choose(i, sums):
        return np.append(best_stump(sums[:-4].reshape(classes, size, bins)), sums[-4:])

    shape = (len(fits), classes, 3)
    feature, cut, value = np.full(shape, -1), np.zeros(shape, int), np.zeros(shape)
    for i, got in pass_over(table, len(fits), classes, live, partial, choose, held=False).items():
        note(grown[i], got[-4:])
        j, b, lo, hi, error, total, gain = got[:-4]
        if i not in learn:
            continue
        # No stump does better than chance, or one does without fault: the fit ends.
        grown[i].done = error >= 1 - 1 / classes or error <= 1e-12
        if error >= 1 - 1 / classes:
            continue
        weight = 1.0 if error <= 1e-12 else fits[i].rate * (math.log((1 - error) / error) + math.log(classes - 1))
        feature[i, :, 0], cut[i, :, 0] = int(j), int(b)
        value[i, int(lo), 1 if j >= 0 else 0] = weight
        if j >= 0:
            value[i, int(hi), 2] = weight
        shift[i] += math.log(total)
        keep(grown[i], feature[i], cut[i], value[i], np.where(np.arange(3) == 0, gain * weight, 0.0) * np.ones((classes, 1)))
    return feature, cut, value


def fit_together(df: DataFrame, fits: Sequence[Fit], classes: int, vec: str = "features", label: str = "label", fold: str | None = None, stumps: bool = False, bins: int = BINS, every: int = EVERY) -> tuple[list[Grown], list[list[float]]]:
    """All fits over the rows of df, and the thresholds of their bins."""
    first = df.select(F.size(vector_to_array(F.col(vec)))).first()
    if first is None:
        raise ValueError("no rows to learn from")
    size = first[0]
    cuts = cut_points(df, vec, size, bins)
    table = binned(df, vec, label, cuts, fold, 0 if stumps else len(fits), classes, START)
    return grow(table, fits, classes, size, bins, stumps, every), cuts


# ---- searches ---------------------------------------------------------------------


def prefix_search(df: DataFrame, points: Sequence[Fit], folds: int, classes: int, vec: str = "features", label: str = "label", fold: str = "fold", stumps: bool = False, bins: int = BINS) -> tuple[list[tuple[int, int, float]], int, Grown, list[list[float]]]:
    """Accuracy of every point on every fold, the best point by their mean (equal: the first), and its fit on all rows.

    Points that differ in rounds alone are one fit per fold and one on all rows, cut at
    their rounds; a fit that ended before counts as it ended."""
    longest: dict[tuple, int] = {}
    for p in points:
        key = (p.rate, p.depth, p.rows, p.cols)
        longest[key] = max(longest.get(key, 0), p.rounds)
    fits = [Fit(rounds, *key, without=w) for key, rounds in longest.items() for w in (*range(folds), -1)]
    grown, cuts = fit_together(df, fits, classes, vec, label, fold, stumps, bins)
    by_key = {(f.rate, f.depth, f.rows, f.cols, f.without): g for f, g in zip(fits, grown)}
    table, means = [], []
    for i, p in enumerate(points):
        each = []
        for w in range(folds):
            found = by_key[p.rate, p.depth, p.rows, p.cols, w].accuracies
            each.append(found[min(p.rounds, len(found) - 1)])
        table += [(i, w, a) for w, a in enumerate(each)]
        means.append(float(np.nanmean(each)))
    best = max(range(len(points)), key=lambda i: (means[i], -i))
    p = points[best]
    return table, best, cut_back(by_key[p.rate, p.depth, p.rows, p.cols, -1], p.rounds), cuts


def cut_back(grown: Grown, rounds: int) -> Grown:
    """The fit as it was after so many rounds."""
    return Grown(*(x[:rounds] for x in (grown.feature, grown.cut, grown.value, grown.gain)), grown.losses[: rounds + 1], grown.accuracies[: rounds + 1])

"""Second-order gradient boosting on Spark.

The rows are binned once: a byte per feature, the label and a running margin.
Growing a tree needs histograms of gradients, hessians and rows per (node,
feature, bin).  One Spark job gives those of all nodes that are open: tasks add
up their rows, an aggregate adds the tasks' cells, and the driver receives at
most nodes x features x bins cells, whatever the number of rows.  Sums are
fixed-point integers, so a model doesn't depend on the order of the rows.

Gains and leaf weights are regularised by an L1 (``alpha``) and an L2 (``lambda_``)
penalty; ``gamma`` is the least gain of a split and ``min_child_weight`` the
least hessian sum of a child.  Trees grow by levels, or leaf by leaf
(``growth="leaf"``): the leaf with the largest gain first, up to ``max_leaves``.  Of two
siblings only the one with fewer rows is summed, the other is the difference to the parent.

Once the trees since then have ``PENDING`` nodes, the first job of a round adds their values to the
margins and keeps the blocks of rows on the executors, so that a large tree is walked once over all rows;
every ``checkpoint_rounds`` times the blocks are checkpointed in the shared folder, which cuts the lineage.  The jobs also sum the loss on the evaluation rows (the training rows where there
are none), so training ends ``patience`` rounds after the best one without
another fit.  Training continues from any earlier model, whose scores are the first margins.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.session import checkpoint_dir, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed copy

SCALE = 1 << 26  # of a gradient in a sum; 2**36 rows fit a long
LOSS_SCALE = 1 << 20
LEAST_GAIN = 1e-6
BLOCK = 1 << 14  # rows packed into one row of the working table; of so many, hessians and rows are counted in one exact double
COUNT = 1.5 * (1 << 38)  # a row in such a sum: above BLOCK hessians, which are at most SCALE / 4, and BLOCK times it below 2**53
BINNED = "n int, id binary, y binary, evaluated binary, trained binary, bins binary, margin binary"
KINDS = {"id": "<u8", "y": "<f4", "evaluated": "?", "trained": "?", "bins": "u1", "margin": "<f8"}  # of the packed columns
PENDING = 48  # nodes of the trees that a job walks for the margins; above it they are added to the kept blocks
DIRECT = 32  # tasks whose cells the driver adds up itself; the rows are dealt to no more, or to one for each core
WAVE = 64  # blocks that make a task worth its start
GROUP = 16  # blocks that share the codes of their bundles
CODES = 512  # bins that the features of a bundle have together, at most
MASKED = 256  # nodes of a tree that is walked node by node for all rows at once; larger ones are walked row by row


@dataclass(frozen=True)
class Params:
    """Training parameters; the defaults are those of the boosted-tree learner of the reference."""

    rounds: int = 500
    eta: float = 0.3
    max_depth: int = 6  # 0: no limit (leaf-wise growth only)
    max_leaves: int = 0  # 0: no limit
    growth: str = "level"  # or "leaf"
    lambda_: float = 1.0
    alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    min_child_rows: int = 1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    trees_per_round: int = 1
    max_bins: int = 64
    cuts: str = "quantile"  # or "width", or "middle": quantiles, halfway to the value below
    base_score: float | None = 0.5  # None: the labels' mean
    newton: bool = True  # False: gradients alone, a row's hessian being 1 in gains, leaves and ``min_child_weight``
    eta_first: float | None = None  # of the first round, where it isn't ``eta``
    patience: int | None = 30
    checkpoint_rounds: int = 25
    seed: int = 0

    def __post_init__(self):
        if self.growth not in ("level", "leaf") or self.cuts not in ("quantile", "width", "middle"):
            raise ValueError("growth is 'level' or 'leaf', cuts 'quantile', 'width' or 'middle'")
        if not 2 <= self.max_bins <= 256:
            raise ValueError("max_bins must be 2 to 256")
        if self.growth == "level" and self.max_depth < 1 or self.growth == "leaf" and not (self.max_leaves or self.max_depth):
            raise ValueError("a tree needs max_depth, or max_leaves if it grows leaf by leaf")


@dataclass
class Node:
    feature: int = -1  # -1: a leaf
    bin: int = 0  # rows in smaller bins, so with smaller values than the threshold, go left
    threshold: float = 0.0
    left: int = -1
    right: int = -1
    value: float = 0.0
    gain: float = 0.0
    cover: float = 0.0
    rows: int = 0


@dataclass
class Ensemble:
    """A fitted model: ``trees`` in rounds of ``per_round``, of which ``best`` rounds count."""

    features: list[str]
    cuts: list[list[float]]
    base_margin: float
    trees: list[list[Node]] = field(default_factory=list)
    per_round: int = 1
    best: int = 0
    losses: list[float] = field(default_factory=list)  # on the evaluation rows, after each round of the last fit

    @property
    def used(self) -> list[list[Node]]:
        return self.trees[:self.best * self.per_round]


# ---------------------------------------------------------------- bins
def filled(name: str):
    """A feature as a double; NULL and NaN count as 0."""
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0))


def cut_points(rows: DataFrame, features: Sequence[str], params: Params) -> list[list[float]]:
    """Ascending cuts per feature, at most ``max_bins - 1``: quantiles, or equal widths from least to greatest value."""
    n = params.max_bins
    ends = [f(filled(c)).alias(f"{k}{i}") for i, c in enumerate(features) for k, f in (("lo", F.min), ("hi", F.max))]
    if params.cuts == "width":
        r = rows.agg(*ends).first()
        return [sorted({r[f"lo{i}"] + (r[f"hi{i}"] - r[f"lo{i}"]) * k / n for k in range(1, n)}) if r[f"lo{i}"] is not None and r[f"lo{i}"] < r[f"hi{i}"]
                else [] for i in range(len(features))]
    at = [k / n for k in range(1, n)]
    r = rows.agg(*ends, *[F.percentile_approx(filled(c), at, 100 * n).alias(f"q{i}") for i, c in enumerate(features)]).first()
    cuts = [sorted({v for v in r[f"q{i}"] or [] if v > r[f"lo{i}"]}) for i in range(len(features))]
    return cuts if params.cuts == "quantile" else halfway(rows, features, cuts, n)


def halfway(rows: DataFrame, features: Sequence[str], cuts: list[list[float]], most: int) -> list[list[float]]:
    """Cuts just above the middle of neighbouring values: of all values where a feature has at most ``most``, else
    of each cut and the greatest value below it."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        seen, below = [np.zeros(0)] * len(cuts), [np.full(len(c), -np.inf) for c in cuts]
        for b in batches:
            for j, x in enumerate(np.sort(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).T, axis=1)):
                at = np.searchsorted(x, cuts[j])
                below[j] = np.maximum(below[j], np.where(at > 0, x[at - 1], -np.inf))
                if seen[j] is not None:
                    own = np.union1d(seen[j], x)
                    seen[j] = own if len(own) <= most else None
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array(seen, pa.list_(pa.float64())), pa.array(below, pa.list_(pa.float64()))],
                                         names=["j", "seen", "below"])

    values, lower = [set() for _ in cuts], [[-float("inf")] * len(c) for c in cuts]
    for r in rows.select(F.array(*[filled(c) for c in features]).alias("x")).mapInArrow(run, "j int, seen array<double>, below array<double>").collect():  # a row per task and feature
        values[r.j] = None if values[r.j] is None or r.seen is None or len(values[r.j] | set(r.seen)) > most else values[r.j] | set(r.seen)
        lower[r.j] = list(map(max, lower[r.j], r.below))
    pairs = [list(zip(sorted(v), sorted(v)[1:])) if v is not None else list(zip(low, c)) for v, low, c in zip(values, lower, cuts)]
    return [sorted({min(math.nextafter(a / 2 + b / 2, math.inf), b) for a, b in own}) for own in pairs]


def packed(columns: dict):
    """A record batch of blocks: per column the bytes of up to ``BLOCK`` rows, of the bins feature by feature."""
    import numpy as np
    import pyarrow as pa
    rows = len(columns["y"])
    at = range(0, rows, BLOCK)
    out = [pa.array([min(BLOCK, rows - i) for i in at], pa.int32())]
    for name, kind in KINDS.items():
        values = np.asarray(columns[name]).astype(kind, copy=False)
        out.append(pa.array([values[..., i:i + BLOCK].tobytes() for i in at], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["n", *KINDS])


def unpacked(batch):
    """The blocks of a record batch: per block a dictionary of its columns; bins as a matrix with a line per feature."""
    import numpy as np
    for k, n in enumerate(batch.column("n").to_pylist()):
        own = {c: np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in KINDS.items()}
        own["bins"] = own["bins"].reshape(-1, n)
        yield own


def binned(rows: DataFrame, features: Sequence[str], label: str, cuts: list[list[float]], base: float, evaluated: bool, trained: bool,
           ids: bool = True) -> DataFrame:
    """Blocks of rows: a byte per feature (the number of cuts that aren't above the value; NULL and NaN count as 0),
    the label, a hash of the row (0 without ``ids``, where no sample is drawn) and its first margin."""
    x = F.array(*[filled(c) for c in features])
    own = rows.select((F.xxhash64(*[F.col(c) for c in rows.columns]) if ids else F.lit(0).cast("long")).alias("id"), F.col(label).cast("double").alias("y"), x.alias("x"))

    def run(batches):
        import numpy as np
        at = [np.array(c) for c in cuts]
        for b in batches:
            n = b.num_rows
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            bins = np.stack([np.searchsorted(c, flat[:, j], side="right") for j, c in enumerate(at)])
            yield packed({"id": b.column(0).to_numpy().view(np.uint64), "y": b.column(1).to_numpy(), "bins": bins, "margin": np.full(n, base),
                          "evaluated": np.full(n, evaluated), "trained": np.full(n, trained)})

    return own.mapInArrow(run, BINNED)


class Coded:
    """The bins of a block in which the features of a bundle are one column of codes.

    A bundle is a list of features and the bins, with a line per feature, that a code stands for.
    """

    def __init__(self, block):
        import numpy as np
        self.bins, self.codes = block["bins"], block["codes"].astype(np.int64)
        self.place = {f: (-1, k) for k, f in enumerate(block["single"])}
        for k, (features, lines) in enumerate(block["bundles"]):
            self.place |= {f: (k, line) for f, line in zip(features, lines)}
        self.shape = len(self.place), len(block["y"])

    def above(self, f: int, b: int):
        """The rows that go right at a split."""
        k, line = self.place[f]
        return self.bins[line] >= b if k < 0 else (line >= b).take(self.codes[k])

    def whole(self):
        """The bins as a matrix with a line per feature."""
        import numpy as np
        return np.stack([self.bins[line] if k < 0 else line.take(self.codes[k]) for _, (k, line) in sorted(self.place.items())])


def bins_of(block):
    return Coded(block) if "codes" in block else block["bins"]


def bundled(blocks, ids: bool = True):
    """The blocks with their features in bundles, without the rows' hashes if those aren't needed.

    Features that have few bins together (at most ``CODES`` in ``GROUP`` blocks) are one column of
    codes, whose sums give those of each of them.
    """
    group = []
    for b in blocks:
        group.append(b)
        if len(group) == GROUP:
            yield from coded(group, ids)
            group = []
    if group:
        yield from coded(group, ids)


def coded(group, ids: bool = True):
    """The rows of some blocks as blocks with common bundles; a feature joins the first one that it fits in."""
    import numpy as np
    own = {c: np.concatenate([b[c] for b in group], axis=-1) for c in KINDS if ids or c != "id"}
    bins = own.pop("bins")
    rows, left, single, bundles, columns = bins.shape[1], list(range(len(bins))), [], [], []
    while left:
        features, code, size = [], np.zeros(rows, np.int64), 1
        for f in list(left):
            joint = code * 256 + bins[f]
            if features and np.count_nonzero(np.bincount(joint[:BLOCK], minlength=size * 256)) > CODES:
                continue
            seen = np.bincount(joint, minlength=size * 256) > 0
            if features and np.count_nonzero(seen) > CODES:
                continue
            code, size = (np.cumsum(seen) - 1).take(joint), np.count_nonzero(seen)
            features.append(f)
            left.remove(f)
        if len(features) > 1:
            row = np.zeros(size, np.int64)
            row[code] = np.arange(rows)
            bundles.append((features, bins[features][:, row]))
            columns.append(code.astype("<u2"))
        else:
            single += features
    own["bins"], own["codes"] = bins[single], np.stack(columns) if columns else np.zeros((0, rows), "<u2")
    for i in range(0, rows, BLOCK):
        yield {**{c: np.ascontiguousarray(v[..., i:i + BLOCK]) for c, v in own.items()}, "single": single, "bundles": bundles, "first": not i}


def leaf_of(tree: list[Node], bins):
    """The leaf, by number, that each row of a bin matrix reaches."""
    import numpy as np
    if len(tree) <= MASKED:
        out, todo = np.zeros(bins.shape[1], np.uint8), [(0, None)]
        while todo:
            k, own = todo.pop()
            node = tree[k]
            if node.feature < 0:
                if k:
                    out |= own.view(np.uint8) * np.uint8(k)
                continue
            above = bins.above(node.feature, node.bin) if isinstance(bins, Coded) else bins[node.feature] >= node.bin
            if own is not None:
                above &= own
            todo += [(node.left, ~above if own is None else own ^ above), (node.right, above)]
        return out
    bins = bins.whole() if isinstance(bins, Coded) else bins
    f, b, left, right = (np.array([getattr(n, k) for n in tree]) for k in ("feature", "bin", "left", "right"))
    child, n = np.stack([left, right], axis=1).ravel(), bins.shape[1]
    out = np.zeros(n, np.int64)
    if f[0] < 0:
        return out
    flat, offset, rows = np.ascontiguousarray(bins).ravel(), f * n, np.arange(n)
    own = np.zeros(n, np.int64)
    while len(rows):
        own = child.take(2 * own + (flat.take(offset.take(own) + rows) >= b.take(own)))
        on = f.take(own) >= 0
        if not on.all():
            there = ~on
            out[rows[there]] = own[there]
            rows, own = rows[on], own[on]
    return out


def margins(trees: list[list[Node]], bins):
    import numpy as np
    out = np.zeros(bins.shape[1])
    for tree in trees:
        out += np.array([n.value for n in tree]).take(leaf_of(tree, bins))
    return out


# ---------------------------------------------------------------- histograms
def settled() -> None:
    """Leaves what a Python worker has loaded out of its garbage collections: there is one after each task, and tasks are short."""
    import gc
    if not gc.get_freeze_count():
        gc.freeze()


def drawn(ids, share: float, seed: int):
    """Mask of the rows of one tree's sample: by a hash of the row, so a repeated task draws the same."""
    import numpy as np
    if share >= 1:
        return np.ones(len(ids), bool)
    x = ids ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return (x ^ (x >> np.uint64(31))) / float(1 << 64) < share


def histograms(table: RDD, pending: list[list[Node]], growing: list[list[Node]], wanted: list[tuple[int, int]], features: list[int],
               params: Params, seeds: list[int], wide: int, with_loss: bool, tasks: int):
    """Cells of the wanted (tree, leaf) pairs: ``{(tree, leaf): int array [feature, bin, (g, h, n)]}``, and the loss sum and rows.

    ``pending`` are the trees since the margins were kept; ``wide``: bins of a feature in a cell array, at least those of the feature with most cuts.
    """
    import numpy as np
    slot = {w: k for k, w in enumerate(wanted)}

    def run(blocks):
        import numpy as np
        settled()
        total = np.zeros((3, len(features), len(wanted), wide), np.int64)
        places = [np.array([slot.get((t, k), -1) for k in range(len(tree))], np.int64) for t, tree in enumerate(growing)]
        loss, evaluated = 0, 0
        columns = [("bins", f, wide, [j], None, total[:, j]) for j, f in enumerate(features)]

        def close():
            """Adds the sums of the bundles to those of their features."""
            for _, _, _, js, lines, sums in columns:
                for j, line in zip(js, lines or ()):
                    cell = (np.arange(len(wanted))[:, None] * wide + line).ravel()
                    for k in range(3):  # whole numbers below 2**53 in a group: exact
                        total[k, j] += np.bincount(cell, sums[k].ravel(), len(wanted) * wide).astype(np.int64).reshape(-1, wide)

        for b in blocks:
            bins, y = bins_of(b), b["y"]
            if b.get("first"):
                close()
                number, columns = {f: j for j, f in enumerate(features)}, []
                for k, (fs, lines) in enumerate(b["bundles"]):
                    own = [(number[f], line) for f, line in zip(fs, lines) if f in number]
                    if own:
                        columns.append(("codes", k, lines.shape[1], *zip(*own), np.zeros((3, len(wanted), lines.shape[1]), np.int64)))
                columns += [("bins", k, wide, [number[f]], None, total[:, number[f]]) for k, f in enumerate(b["single"]) if f in number]
            margin = b["margin"] + margins(pending, bins) if pending else b["margin"]
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            if with_loss:
                own = np.flatnonzero(b["evaluated"])
                q = np.clip(np.where(y[own] > 0, p[own], 1 - p[own]), 1e-15, 1)
                loss += int(np.rint(-np.log(q) * LOSS_SCALE).sum())
                evaluated += len(own)
            if not wanted:
                continue
            g, h = np.rint((p - y) * SCALE), np.rint(p * (1 - p) * SCALE) + COUNT if params.newton else np.full(len(p), COUNT)
            for t, tree in enumerate(growing):
                at = places[t].take(leaf_of(tree, bins))
                used = at >= 0
                used &= b["trained"]
                if params.subsample < 1:
                    used &= drawn(b["id"], params.subsample, seeds[t])
                rows = np.flatnonzero(used)
                if not len(rows):
                    continue
                whole = len(rows) == len(used)
                place, gs, hs = (at, g, h) if whole else (at.take(rows), g.take(rows), h.take(rows))
                for source, k, size, _, _, sums in columns:
                    column = bins.codes[k] if source == "codes" else b["bins"][k]
                    cell = place * size
                    cell += column if whole else column.take(rows)
                    # sums of one block are whole numbers below 2**53: exact, as are the rows above COUNT
                    sums[0] += np.bincount(cell, gs, len(wanted) * size).astype(np.int64).reshape(-1, size)
                    both = np.bincount(cell, hs, len(wanted) * size)
                    n = np.floor(both / COUNT)
                    sums[1] += (both - n * COUNT).astype(np.int64).reshape(-1, size)
                    sums[2] += n.astype(np.int64).reshape(-1, size)
        close()
        flat = np.ascontiguousarray(total.transpose(0, 2, 1, 3)).reshape(3, -1)
        some = np.flatnonzero(flat[2])
        cells = np.concatenate([[some], flat[:, some]])
        if with_loss:
            cells = np.concatenate([cells, [[-1], [loss], [0], [evaluated]]], axis=1)
        yield cells

    def added(a, b):
        import numpy as np
        cells = np.concatenate([a, b], axis=1)
        some, at = np.unique(cells[0], return_inverse=True)
        out = np.zeros((4, len(some)), np.int64)
        out[0] = some
        for k in (1, 2, 3):
            np.add.at(out[k], at, cells[k])
        return out

    found = table.mapPartitions(run)
    parts = found.collect() if tasks <= DIRECT else [found.treeReduce(added)]
    own = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.int64)
    lost = own[1:, own[0] < 0].sum(axis=1)
    own = own[:, own[0] >= 0]
    out = np.zeros((len(wanted) * len(features) * wide, 3), np.int64)
    for k in range(3):
        np.add.at(out[:, k], own[0], own[k + 1])
    if not params.newton:
        out[:, 1] = out[:, 2] * SCALE
    out = (out / np.array([SCALE, SCALE, 1])).reshape(len(wanted), len(features), wide, 3)
    return {w: out[k] for w, k in slot.items()}, (float(lost[0]) / LOSS_SCALE, int(lost[2]))


def shrunk(g, alpha: float):
    """The gradient sum after the L1 penalty."""
    import numpy as np
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def split_gains(cells, params: Params):
    """Gain of sending the bins below b left, ``[feature, b]`` for b from 1 on; -inf where a child is too light."""
    import numpy as np
    left = cells.cumsum(axis=1)[:, :-1]
    right = cells.sum(axis=1)[:, None] - left

    def quality(s):
        return shrunk(s[..., 0], params.alpha) ** 2 / (s[..., 1] + params.lambda_)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = quality(left) + quality(right) - quality(cells.sum(axis=1))[:, None]
    heavy = (np.minimum(left[..., 1], right[..., 1]) >= params.min_child_weight) & (np.minimum(left[..., 2], right[..., 2]) >= max(1, params.min_child_rows))
    return np.where(heavy, gain, -np.inf)


def leaf_value(s, params: Params) -> float:
    return float(-shrunk(s[0], params.alpha) / (s[1] + params.lambda_)) * params.eta / params.trees_per_round if s[1] + params.lambda_ > 0 else 0.0


# ---------------------------------------------------------------- growth
class Growing:
    """One tree while it grows: its nodes, the cells of its open leaves and their best splits.

    A leaf is split when it is first in order: by level, or by gain.  The cells
    of its children must be known then if they may be split themselves.  A
    request asks for those of all leaves that are next in order, so a job serves
    many splits, and the tree is the same as with one job per split.
    """

    def __init__(self, params: Params, columns: list[int], rng, cuts: list[list[float]]):
        self.params, self.columns, self.rng, self.cuts = params, columns, rng, cuts
        self.nodes, self.depth = [Node()], [0]
        self.best: dict[int, tuple[float, int, int]] = {}  # of open leaves: gain, place of the column, bin
        self.cells: dict[int, object] = {}
        self.children: dict[int, tuple] = {}  # of leaves that aren't split yet: the cells of both sides
        self.at_level: dict[int, list[int]] = {}

    def allowed(self, depth: int) -> list[int]:
        """The columns of one level, by their place among the tree's columns."""
        if depth not in self.at_level:
            n = len(self.columns)
            self.at_level[depth] = sorted(self.rng.sample(range(n), max(1, round(n * self.params.colsample_bylevel))))
        return self.at_level[depth]

    def know(self, k: int, cells) -> None:
        """The cells of leaf ``k``: its best split, if it may be split."""
        import numpy as np
        p = self.params
        gains = split_gains(cells, p)
        own = np.full(gains.shape[0], -np.inf)
        usable = self.allowed(self.depth[k])
        own[usable] = gains[usable].max(axis=1)
        f = int(own.argmax())
        if own[f] > LEAST_GAIN and own[f] >= p.gamma:
            self.best[k], self.cells[k] = (float(own[f]), f, int(gains[f].argmax()) + 1), cells

    def deep_enough(self, k: int) -> bool:
        """The children of leaf ``k`` stay leaves."""
        return bool(self.params.max_depth) and self.depth[k] + 1 >= self.params.max_depth

    def sides(self, k: int):
        _, f, b = self.best[k]
        below, total = self.cells[k][f][:b].sum(axis=0), self.cells[k][f].sum(axis=0)
        return below, total - below

    def as_split(self, k: int, first: int) -> Node:
        gain, f, b = self.best[k]
        c = self.columns[f]
        return replace(self.nodes[k], feature=c, bin=b, threshold=self.cuts[c][b - 1], gain=gain, left=first, right=first + 1)

    def split(self, k: int) -> None:
        first = len(self.nodes)
        sides = self.sides(k)
        self.nodes[k] = self.as_split(k, first)
        for s in sides:
            self.nodes.append(Node(value=leaf_value(s, self.params), cover=float(s[1]), rows=int(s[2])))
            self.depth.append(self.depth[k] + 1)
        for j, cells in zip((first, first + 1), self.children.pop(k, ())):
            self.know(j, cells)
        del self.best[k], self.cells[k]

    def request(self) -> tuple[list[Node], dict[int, int]]:
        """A tree for the next job and its wanted leaves, by number with the leaf that they come from; none when done."""
        p = self.params
        if not self.nodes[0].rows and not self.cells:
            return self.nodes, {0: -1}
        while True:
            left = p.max_leaves - (len(self.nodes) + 1) // 2 if p.max_leaves else len(self.best) + 1
            order = sorted(self.best, key=lambda k: (self.depth[k] if p.growth == "level" else 0, -self.best[k][0], k))[:max(left, 0)]
            if not order:
                return self.nodes, {}
            if not self.deep_enough(order[0]) and left > 1 and order[0] not in self.children:
                break
            self.split(order[0])
        tree, wanted = list(self.nodes), {}
        for k in order:
            if k not in self.children and not self.deep_enough(k) and (p.growth == "leaf" or self.depth[k] == self.depth[order[0]]):
                tree[k] = self.as_split(k, len(tree))
                below, above = self.sides(k)
                wanted[len(tree) + int(above[2] < below[2])] = k
                tree += [Node(), Node()]
        return tree, wanted

    def take(self, wanted: dict[int, int], found: dict[int, object]) -> None:
        """The cells that a job found; the sibling's are the rest of the parent's."""
        for at, cells in found.items():
            k = wanted[at]
            if k < 0:
                total = cells[0].sum(axis=0)
                self.nodes[0] = Node(value=leaf_value(total, self.params), cover=float(total[1]), rows=int(total[2]))
                self.know(0, cells)
                if not total[2]:
                    self.nodes[0].rows = -1
                continue
            below, above = self.sides(k)
            other = self.cells[k] - cells
            self.children[k] = (other, cells) if above[2] < below[2] else (cells, other)


def fit_boosted(train: DataFrame, features: Sequence[str], params: Params, label: str = "reordered", evaluation: DataFrame | None = None,
                start: Ensemble | None = None) -> Ensemble:
    """Boosted trees for a 0/1 ``label``, after those of ``start`` if given.

    Losses are taken on ``evaluation``, or on ``train`` without it; with
    ``patience`` training ends that many rounds after the best one, and
    the rounds up to the best one count.  Rows with a NULL label are left
    out.  A table without rows gives a model of the base score alone.
    """
    import random

    features = list(start.features if start else features)
    rows = train.filter(F.col(label).isNotNull()).select(label, *features)
    cuts = start.cuts if start else cut_points(rows, features, params)
    score = params.base_score if start or params.base_score is not None else rows.agg(F.avg(F.col(label).cast("double"))).first()[0]
    score = min(max(0.5 if score is None else score, 1e-7), 1 - 1e-7)
    base = start.base_margin if start else math.log(score / (1 - score))
    ids = params.subsample < 1
    data = binned(rows, features, label, cuts, base, evaluation is None, True, ids)
    if evaluation is not None:
        data = data.unionByName(binned(evaluation.filter(F.col(label).isNotNull()).select(label, *features), features, label, cuts, base, True, False, ids))
    before = start.used if start else []
    table = blocks(materialize(with_margins(data, before), "boosting_rows"), ids).persist(StorageLevel.MEMORY_AND_DISK)
    model = Ensemble(features, cuts, base, list(before), params.trees_per_round if not start else start.per_round)
    if start and start.per_round != params.trees_per_round:
        raise ValueError("continued training needs the same number of trees per round")
    pending: list[list[Node]] = []
    tasks, steps = table.getNumPartitions(), 0
    first, best = len(before) // model.per_round, (math.inf, 0)
    for r in range(params.rounds + 1):
        last = r == params.rounds  # a last job for the loss after the last round
        rng = random.Random(f"{params.seed} {first + r}")
        columns = sorted(rng.sample(range(len(features)), max(1, round(len(features) * params.colsample_bytree))))
        seeds = [params.seed * 1_000_003 + (first + r) * model.per_round + t for t in range(model.per_round)]
        own = replace(params, eta=params.eta_first) if params.eta_first is not None and not first + r else params
        growing = [] if last else [Growing(own, columns, rng, cuts) for _ in seeds]
        with_loss, stopped, old = True, False, table
        if sum(map(len, pending)) >= PENDING:
            table, pending, steps = stepped(table, pending).persist(StorageLevel.MEMORY_AND_DISK), [], steps + 1  # the first job computes it
            if steps % params.checkpoint_rounds == 0:
                table.checkpoint()
        while not stopped:
            asked = [g.request() for g in growing]
            wanted = [(t, k) for t, (_, own) in enumerate(asked) for k in own]
            if not wanted and not with_loss:
                break
            found, loss = histograms(table, pending, [tree for tree, _ in asked], wanted, columns, params, seeds, wide_for(cuts), with_loss, tasks)
            if with_loss and r:
                model.losses.append(loss[0] / loss[1] if loss[1] else math.nan)
                if model.losses[-1] < best[0]:
                    best = (model.losses[-1], r)
            stopped = with_loss and (last or params.patience is not None and r - best[1] >= params.patience and r > 0)
            if with_loss and old is not table:
                old.unpersist()
            with_loss = False
            for t, g in enumerate(growing):
                g.take(asked[t][1], {k: found[t, k] for k in asked[t][1]})
        if stopped:
            model.best = first + (best[1] if params.patience is not None else r)
            table.unpersist()
            break
        pending = pending + [g.nodes for g in growing]
        model.trees += [g.nodes for g in growing]
    return model


def wide_for(cuts: list[list[float]]) -> int:
    """Bins of the feature with most cuts; two at least, so that there is a place to split."""
    return max([2, *(len(c) + 1 for c in cuts)])


def blocks(table: DataFrame, ids: bool = True) -> RDD:
    """The blocks of a table, a dictionary each, dealt evenly to the same number of tasks for each core: few enough for
    the driver to add up their cells, but one for each core at least.

    A task reads its blocks one at a time, so their number costs no memory.
    """
    checkpoint_dir(table.sparkSession)
    cores = table.sparkSession.sparkContext.defaultParallelism
    waves = min(max(1, DIRECT // cores), 1 + table.count() // (WAVE * cores))
    return table.repartition(cores * waves).rdd.map(block_of).mapPartitions(lambda found: bundled(found, ids))


def block_of(r):
    """A row of the table as a dictionary of its columns."""
    import numpy as np
    b = {c: np.frombuffer(r[c], kind) for c, kind in KINDS.items()}
    return {**b, "bins": b["bins"].reshape(-1, r["n"])}


def stepped(table: RDD, trees: list[list[Node]]) -> RDD:
    """The blocks with the trees' values added to their margins."""
    return table.map(lambda b: {**b, "margin": b["margin"] + margins(trees, bins_of(b))})


def with_margins(table: DataFrame, trees: list[list[Node]]) -> DataFrame:
    """The binned rows with the trees' values added to their margins."""
    if not trees:
        return table

    def run(batches):
        for batch in batches:
            for b in unpacked(batch):
                yield packed({**b, "margin": b["margin"] + margins(trees, b["bins"])})

    return table.mapInArrow(run, BINNED)


# ---------------------------------------------------------------- use
def predict(model: Ensemble, df: DataFrame, keep: Sequence[str] = (), name: str = "score") -> DataFrame:
    """The ``keep`` columns, ``margin`` and ``name``, the probability of label 1; NULL features count as 0."""
    from pyspark.sql import types as T
    trees, cuts, base = model.used, model.cuts, model.base_margin
    x = F.array(*[filled(c) for c in model.features])
    own = df.select(*keep, x.alias("_x"))
    schema = T.StructType([*(own.schema[c] for c in keep), T.StructField("margin", T.DoubleType()), T.StructField(name, T.DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        at = [np.array(c) for c in cuts]
        for b in batches:
            flat = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            bins = np.stack([np.searchsorted(c, flat[:, j], side="right") for j, c in enumerate(at)]).astype(np.uint8)
            m = base + margins(trees, bins)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(m), pa.array(1 / (1 + np.exp(-np.clip(m, -500, 500))))],
                                             names=[*b.schema.names[:-1], "margin", name])

    return own.mapInArrow(run, schema)


NODES = ("tree int, node int, feature string, threshold double, bin int, left int, right int, value double, gain double, cover double, rows long")


def node_table(spark: SparkSession, model: Ensemble) -> DataFrame:
    """One row per node of the trees that count; leaves have no feature."""
    out = [(t, k, model.features[n.feature] if n.feature >= 0 else None, n.threshold if n.feature >= 0 else None, n.bin, n.left, n.right,
            n.value, n.gain, n.cover, n.rows) for t, tree in enumerate(model.used) for k, n in enumerate(tree)]
    return spark.createDataFrame(out, NODES)


def importance(spark: SparkSession, model: Ensemble) -> DataFrame:
    """M16/M17 per feature: mean and total gain of its splits and their number, 0 when unused."""
    splits = (node_table(spark, model).filter("feature IS NOT NULL").groupBy("feature")
              .agg(F.avg("gain").alias("gain"), F.sum("gain").alias("total_gain"), F.count(F.lit(1)).alias("weight")))
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    return names.join(splits, "feature", "left").na.fill(0)


def loss_history(spark: SparkSession, model: Ensemble) -> DataFrame:
    """Loss on the evaluation rows after each round of the last fit."""
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(model.losses)], "iteration int, loss double")


def save(spark: SparkSession, model: Ensemble, path: str) -> None:
    """The model as two Parquet tables below ``path`` (any Hadoop URI)."""
    path = path.rstrip("/")
    head = {"features": model.features, "cuts": model.cuts, "base_margin": model.base_margin, "per_round": model.per_round, "best": model.best}
    spark.createDataFrame([(json.dumps(head),)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    node_table(spark, model).write.mode("overwrite").parquet(f"{path}/nodes")


def load(spark: SparkSession, path: str) -> Ensemble:
    """The model that :func:`save` wrote."""
    path = path.rstrip("/")
    head = json.loads(spark.read.parquet(f"{path}/model").first().model)
    number = {f: i for i, f in enumerate(head["features"])}
    trees: list[list[Node]] = [[] for _ in range(head["best"] * head["per_round"])]
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # as large as the model
        trees[r.tree].append(Node(number.get(r.feature, -1), r.bin, r.threshold or 0.0, r.left, r.right, r.value, r.gain, r.cover, r.rows))
    return Ensemble(head["features"], head["cuts"], head["base_margin"], trees, head["per_round"], head["best"])


def root_gains(rows: DataFrame, features: Sequence[str], params: Params, label: str = "reordered") -> DataFrame:
    """Every split of the first tree's root: ``feature, bin, threshold, left_g, left_h, left_rows, gain`` (gain NULL where a child is too light)."""
    import numpy as np
    features = list(features)
    rows = rows.filter(F.col(label).isNotNull()).select(label, *features)
    cuts = cut_points(rows, features, params)
    data = binned(rows, features, label, cuts, 0.0, False, True, False)
    # one job reads the rows: they aren't dealt to other tasks, and their cells are added on the executors
    found, _ = histograms(data.rdd.map(block_of), [], [[Node()]], [(0, 0)], list(range(len(features))), replace(params, subsample=1.0), [0], wide_for(cuts), False, DIRECT + 1)
    cells = found[0, 0]
    gains, left = split_gains(cells, params), cells.cumsum(axis=1)
    out = [(f, b, float(c), float(left[j, b - 1, 0]), float(left[j, b - 1, 1]), int(left[j, b - 1, 2]),
            round(float(gains[j, b - 1]), 6) if np.isfinite(gains[j, b - 1]) else None)
           for j, f in enumerate(features) for b, c in enumerate(cuts[j], 1)]
    return rows.sparkSession.createDataFrame(out, "feature string, bin int, threshold double, left_g double, left_h double, left_rows long, gain double")


def fit_continued(folds: Sequence[DataFrame], features: Sequence[str], params: Params, label: str = "reordered",
                  evaluation: DataFrame | None = None) -> list[Ensemble]:
    """M9: one model per fold, each trained on from the one before; the last one is the result."""
    models: list[Ensemble] = []
    for fold in folds:
        models.append(fit_boosted(fold, features, params, label, evaluation, models[-1] if models else None))
    return models

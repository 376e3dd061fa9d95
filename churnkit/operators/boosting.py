"""Histogram gradient boosting for binary labels, many training sets at once.

Features are cut at quantiles into at most ``bins`` bins, and rows become blocks of bin
codes.  Training sets (cross-validation folds and refits) of at most ``LOCAL_BYTES`` are shuffled to a task
each, which grows all their trees: one job, however many rounds and levels there are.

Of larger sets a level of a tree is one Spark aggregate: every task adds up gradient and hessian by
(training set, node, feature, bin) over its blocks, the sums are added up by node, and each node's
best cut is picked where its sums lie.  All training sets share each aggregate, so five folds and two
refits cost as many jobs as one fit.  What reaches the driver is six numbers per set and node and grows
with neither rows nor tasks.

Where rows outnumber bins by far, features of few bins are added up together: a row's codes of several
features are one number, and the sums by that number are dealt to the features' bins afterwards.

The objective is the weighted log-loss with second-order gains
``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)``; rows and columns are sampled per round by hashes, so
a fit depends on neither the partitioning nor a random state.  The margins of a finished round are folded
into the blocks by the next round's first pass and checkpointed every ``FOLD_ROUNDS`` rounds, which bounds
what a lost executor costs.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.session import ensure_checkpoint_dir, ship_package, stored

#: Rounds between checkpoints of the blocks' margins.
FOLD_ROUNDS = 8
#: Memory for the rows of a training set up to which one task grows all its trees.
LOCAL_BYTES = 400_000_000
#: Rows of the largest training set from which features are added up together, and joint codes of such features, at most.
JOINT_ROWS, JOINT_CODES = 100_000, 1_024
_LEAST_GAIN = 1e-6
#: Tasks that add up the sums of a level, at most.
REDUCERS = 16


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 200
    depth: int = 5
    rate: float = 0.1
    rows: float = 0.9
    columns: float = 0.9
    l2: float = 1.0
    least_hessian: float = 1.0
    bins: int = 64


def round_factor(r: int) -> int:
    """Odd 32-bit multiplier that spreads the row hashes anew in every round."""
    return int(hashlib.md5(f"rows:{r}".encode()).hexdigest()[:8], 16) | 1


def sampled_columns(r: int, features: Sequence[str], share: float) -> list[bool]:
    """The columns of round r: the int(share x d) first by md5, at least one."""
    order = sorted(range(len(features)), key=lambda i: hashlib.md5(f"columns:{r}:{features[i]}".encode()).hexdigest())
    keep = set(order[:max(1, int(share * len(features)))])
    return [i in keep for i in range(len(features))]


def row_hash(key: str) -> Column:
    """60 bits of md5 of the key's text."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def value_counts(df: DataFrame, features: Sequence[str], most: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per feature (by its place) with at most ``most`` values: its values in ascending order, and how many rows have each."""
    features = list(features)
    ship_package(df.sparkSession)

    def run(batches):
        found: list = [(np.zeros(0), np.zeros(0, np.int64))] * len(features)
        for b in batches:
            for i, f in enumerate(features):
                if found[i] is not None:
                    v, n = np.unique(b.column(f).drop_null().to_numpy(zero_copy_only=False).astype(float), return_counts=True)
                    v, at = np.unique(np.concatenate([found[i][0], v]), return_inverse=True)
                    found[i] = (v, np.bincount(at, np.concatenate([found[i][1], n]), len(v)).astype(np.int64)) if len(v) <= most else None
        for i, x in enumerate(found):
            v, n = ([None], [0]) if x is None else x  # NULL: too many
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(v), pa.int32()), pa.array(v, pa.float64()), pa.array(n, pa.int64())], names=["i", "v", "n"])

    some = df.select(*[F.col(f).cast("double").alias(f) for f in features]).mapInArrow(run, "i int, v double, n long").groupBy("i", "v").agg(F.sum("n").alias("n"))
    rows = some.groupBy("i").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("v").isNull().cast("int")).alias("many"),
                                 F.sort_array(F.collect_list(F.struct("v", "n"))).alias("all")).where(f"many = 0 AND k <= {most}").collect()
    return {r["i"]: (np.array([x["v"] for x in r["all"]]), np.array([x["n"] for x in r["all"]])) for r in rows}  # at most ``most`` values a feature


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature the distinct i/bins quantiles below its largest value (rows with x <= edge go left of it)."""
    steps = [i / bins for i in range(1, bins)]
    few = value_counts(df, features, 4 * bins)
    many = [i for i in range(len(features)) if i not in few]
    x = {i: F.col(features[i]).cast("double") for i in many}
    row = df.agg(*[F.percentile_approx(x[i], steps, 100_000).alias(f"q{i}") for i in many], *[F.max(x[i]).alias(f"m{i}") for i in many]).first() if many else {}
    out = []
    for i in range(len(features)):
        if i in few:
            v, n = few[i]
            upto = np.cumsum(n)
            q = np.unique(v[np.searchsorted(upto, np.ceil(np.array(steps) * upto[-1]), side="left")])
            out.append(q[q < v[-1]])
        else:
            q = np.unique(np.array(row[f"q{i}"] or [], float))
            out.append(q[q < row[f"m{i}"]] if len(q) else q)
    return out


def codes_of(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every value: the number of edges below it."""
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8) if len(edges) else \
        np.zeros((len(x), 0), np.uint8)


def leaves(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Node that every row reaches in every tree.  codes (n, d); feature and cut (trees, nodes) as heaps, feature < 0 is a leaf."""
    at = np.zeros((len(feature), len(codes)), np.int64)
    tree, row = np.arange(len(feature))[:, None], np.arange(len(codes))[None, :]
    for _ in range(depth):
        f = feature[tree, at]
        right = codes[row, np.maximum(f, 0)] > cut[tree, at]
        at = np.where(f < 0, at, 2 * at + 1 + right)
    return at


# ---------------------------------------------------------------- blocks and passes

def _to_blocks(features: list[str], edges: list[np.ndarray], n_sets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features], axis=1)
            sets = np.stack([b.column(f"_s{i}").to_numpy(zero_copy_only=False) for i in range(n_sets)]).astype(np.uint8)
            cells = [codes_of(x, edges).tobytes(), b.column("_y").to_numpy().astype(np.uint8).tobytes(),
                     b.column("_h").to_numpy().astype(np.uint64).tobytes(), sets.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())] + [pa.array([c], pa.binary()) for c in cells],
                                             names=["n", "codes", "y", "h", "sets"])
    return run


@dataclass
class _Block:
    codes: np.ndarray  # (n, d)
    y: np.ndarray
    h: np.ndarray
    sets: np.ndarray  # (sets, n)
    margin: np.ndarray  # (sets, n)


def _block(row, n_sets: int) -> _Block:
    n = row["n"]
    as_ = lambda c, t: np.frombuffer(bytes(row[c]), t)
    return _Block(as_("codes", np.uint8).reshape(n, -1), as_("y", np.uint8), as_("h", np.uint64), as_("sets", np.uint8).reshape(n_sets, n).astype(bool),
                  np.zeros((n_sets, n)))


@dataclass
class _Trees:
    """One tree of every training set, as heaps (sets, nodes)."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, sets: int, depth: int) -> "_Trees":
        nodes = 2 ** (depth + 1) - 1
        return cls(np.full((sets, nodes), -1, np.int16), np.zeros((sets, nodes), np.int16), *[np.zeros((sets, nodes)) for _ in range(3)])


def _margin(block: _Block, recent: list[_Trees], depth: int) -> np.ndarray:
    margin = block.margin
    for t in recent:
        at = np.stack([_reach(block.codes, np.arange(len(block.y)), t.feature[i], t.cut[i], depth) for i in range(len(t.feature))])
        margin = margin + np.take_along_axis(t.value, at, axis=1)
    return margin


def _loss(margin: np.ndarray, block: _Block, weights: np.ndarray) -> np.ndarray:
    """Weighted log-loss of every set, summed over its rows."""
    each = np.where(block.y > 0, weights[:, None] * np.logaddexp(0, -margin), np.logaddexp(0, margin))
    return (each * block.sets).sum(axis=1)


def _onward(codes: np.ndarray, base: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The child that every row of node ``at`` goes to, or the leaf it stays in.  base: where the row's codes begin in flat ``codes``."""
    f = feature[at]
    leaf = f < 0
    right = codes.ravel()[base + np.maximum(f, 0)] > cut[at]
    to = 2 * at + 1 + right
    return np.where(leaf, at, to) if leaf.any() else to


def _reach(codes: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Node of one tree (a heap) that each of ``rows`` reaches within ``depth`` levels."""
    at, base = np.zeros(len(rows), np.int64), rows * codes.shape[1]
    for _ in range(depth):
        at = _onward(codes, base, at, feature, cut)
    return at


@dataclass
class _Joint:
    """Some features that are added up together: their codes as one number below ``size``, and the bin sums that its sums fall to."""

    features: list[int]
    factors: list[int]
    size: int
    bins: np.ndarray
    spread: np.ndarray | None  # (size, bins) of 0 and 1; None for one feature

    def code(self, codes: np.ndarray) -> np.ndarray:
        out = codes[:, self.features[0]].astype(np.int64)
        for f, factor in zip(self.features[1:], self.factors[1:]):
            out += codes[:, f].astype(np.int64) * factor
        return out


def together(sizes: Sequence[int], most: int) -> list[list[int]]:
    """The places of ``sizes`` in groups whose sizes multiply to at most ``most``; a larger one is a group of its own."""
    groups: list[list[int]] = []
    for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        fits = [g for g in groups if math.prod(sizes[i] for i in [*g, j]) <= most]
        if fits:
            fits[0].append(j)
        else:
            groups.append([j])
    return groups


def joints_of(offsets: np.ndarray, most: int) -> list[_Joint]:
    """The features in groups whose numbers of bins multiply to at most ``most``; a feature with more bins is a group of its own."""
    sizes, out = np.diff(offsets).tolist(), []
    for g in together(sizes, most):
        factors = np.cumprod([1, *[sizes[j] for j in g]]).tolist()
        bins = np.concatenate([np.arange(offsets[j], offsets[j + 1]) for j in g])
        spread = None
        if len(g) > 1:
            number = np.arange(factors[-1])
            spread = np.concatenate([(number // factor % sizes[j])[:, None] == np.arange(sizes[j]) for j, factor in zip(g, factors)], axis=1).astype(float)
        out.append(_Joint(g, factors[:-1], factors[-1], bins, spread))
    return out


class _Sums:
    """Gradient and hessian by node of a level and joint code, added up block by block."""

    def __init__(self, joints: list[_Joint], nodes: int):
        self.joints, self.nodes = joints, nodes
        self.parts = [np.zeros((2, (nodes + 1) * j.size)) for j in joints]  # rows that have ended above the level come last and are left out

    def add(self, codes: list[np.ndarray], at: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        node = at - (self.nodes - 1)
        if self.nodes > 1:
            node[node < 0] = self.nodes
        for j, code, part in zip(self.joints, codes, self.parts):
            slot = node * j.size + code
            part[0] += np.bincount(slot, g, part.shape[1])
            part[1] += np.bincount(slot, h, part.shape[1])

    def by_bin(self, total: int) -> np.ndarray:
        """(nodes, all bins, 2)."""
        out = np.zeros((self.nodes, total, 2))
        for j, part in zip(self.joints, self.parts):
            for i in (0, 1):
                x = part[i].reshape(self.nodes + 1, j.size)[:-1]
                out[:, j.bins, i] = x if j.spread is None else x @ j.spread
        return out


def _pass(round_: int, recent: list[_Trees], grown: _Trees, level: int, offsets: np.ndarray, weights: np.ndarray, joints: list[_Joint],
          params: BoostParams):
    """Sums of one level over the blocks of a partition: (sets x nodes of the level, all bins, 2) and the losses."""
    nodes, total = 2 ** level, int(offsets[-1])
    factor, most = np.uint64(round_factor(round_)), np.uint64(round(params.rows * 2 ** 20))

    def run(blocks: Iterator[_Block]):
        n_sets = len(weights)
        sums, loss = [_Sums(joints, nodes) for _ in range(n_sets)], np.zeros(n_sets)
        for b in blocks:
            margin = _margin(b, recent, params.depth)
            if level == 0:
                loss += _loss(margin, b, weights)
            codes, drawn = [j.code(b.codes) for j in joints], ((b.h * factor) >> np.uint64(44)) < most
            for s in range(n_sets):
                i = np.flatnonzero(b.sets[s] & drawn)
                p, y = 1.0 / (1.0 + np.exp(-margin[s, i])), b.y[i]
                w = np.where(y > 0, weights[s], 1.0)
                sums[s].add([c[i] for c in codes], _reach(b.codes, i, grown.feature[s], grown.cut[s], level), w * (p - y), w * p * (1 - p))
        yield np.concatenate([x.by_bin(total) for x in sums]), loss
    return run


def _plus(a, b):
    return a[0] + b[0], a[1] + b[1]


def best_cuts(sums: np.ndarray, offsets: np.ndarray, params: BoostParams) -> tuple[np.ndarray, ...]:
    """Per row of ``sums`` (k, bins, 2): (gain, GL, HL) of a cut after every bin; -inf where a cut isn't allowed; and (G, H)."""
    k, total, _ = sums.shape
    along = np.cumsum(sums, axis=1)
    before = np.concatenate([np.zeros((k, 1, 2)), along], axis=1)[:, offsets[:-1]]
    sizes = np.diff(offsets)
    left = along - np.repeat(before, sizes, axis=1)
    whole = left[:, offsets[1] - 1] if len(sizes) else np.zeros((k, 2))
    right = whole[:, None, :] - left
    score = lambda x: x[..., 0] ** 2 / (x[..., 1] + params.l2)
    gain = score(left) + score(right) - score(whole)[:, None]
    last = np.zeros(total, bool)
    last[offsets[1:] - 1] = True
    gain[(left[..., 1] < params.least_hessian) | (right[..., 1] < params.least_hessian) | last[None, :]] = -np.inf
    return gain, left, whole


def _chosen(sums: np.ndarray, offsets: np.ndarray, closed: np.ndarray, params: BoostParams) -> np.ndarray:
    """Per row of ``sums`` (k, bins, 2) the best cut after a bin that isn't ``closed``: gain, bin, GL, HL, G, H."""
    gain, left, whole = best_cuts(sums, offsets, params)
    gain[:, closed] = -np.inf
    k, b = np.arange(len(gain)), gain.argmax(axis=1)
    return np.column_stack([gain[k, b], b, left[k, b], whole])


@dataclass
class Booster:
    """A fitted model: trees as heaps over bin codes, the bins' edges, the loss before every round and at the end."""

    features: list[str]
    edges: list[np.ndarray]
    params: BoostParams
    feature: np.ndarray  # (rounds, nodes)
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    losses: list[float] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        codes, out = codes_of(x, self.edges), np.zeros(len(x))
        for at in range(0, len(self.feature), 16):  # 16 trees at a time bounds memory
            part = slice(at, at + 16)
            node = leaves(codes, self.feature[part], self.cut[part], self.params.depth)
            out += np.take_along_axis(self.value[part], node, axis=1).sum(axis=0)
        return out

    def node_rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, value, cover, gain) of every node that rows can reach; feature -1 at leaves."""
        rows = []
        for t in range(len(self.feature)):
            todo = [0]
            while todo:
                i = todo.pop()
                f = int(self.feature[t, i])
                threshold = float(self.edges[f][self.cut[t, i]]) if f >= 0 else 0.0
                rows.append((t, i, f, int(self.cut[t, i]), threshold, *[float(a[t, i]) for a in (self.value, self.cover, self.gain)]))
                todo += [2 * i + 1, 2 * i + 2] if f >= 0 else []
        return sorted(rows)

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table (Parquet) and a description (JSON) under ``path``."""
        spark.createDataFrame(self.node_rows(), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = {"features": self.features, "edges": [e.tolist() for e in self.edges], "params": vars(self.params), "losses": self.losses}
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Booster":
        about = json.loads(spark.read.json(f"{path}/about").first()["about"])
        params = BoostParams(**about["params"])
        n = 2 ** (params.depth + 1) - 1
        arrays = {k: np.zeros((params.rounds, n), t) for k, t in (("feature", np.int16), ("cut", np.int16), ("value", float), ("cover", float), ("gain", float))}
        arrays["feature"][:] = -1
        for r in spark.read.parquet(f"{path}/nodes").collect():  # at most rounds x 2^(depth + 1) rows
            for k in arrays:
                arrays[k][r["tree"], r["node"]] = r[k]
        return cls(about["features"], [np.array(e) for e in about["edges"]], params, **arrays, losses=about["losses"])


NODES = "tree int, node int, feature int, cut int, threshold double, value double, cover double, gain double"


@dataclass
class _Prepared:
    blocks: object  # RDD of _Block
    edges: list[np.ndarray]
    offsets: np.ndarray
    weights: np.ndarray
    sizes: np.ndarray
    joints: list[_Joint]
    local: bool  # whether a task can hold any of the sets


def _prepare(data: DataFrame, features: list[str], label: str, key: str, sets: dict[str, Column], params: BoostParams) -> _Prepared:
    spark = data.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    flags = [F.coalesce(c, F.lit(False)).alias(f"_s{i}") for i, c in enumerate(sets.values())]
    rows = data.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("int").alias("_y"), row_hash(key).alias("_h"), *flags)
    rows = rows.where(" OR ".join(f"_s{i}" for i in range(len(sets))) + " AND _y IS NOT NULL" if len(sets) == 1 else
                      "(" + " OR ".join(f"_s{i}" for i in range(len(sets))) + ") AND _y IS NOT NULL")
    counts = rows.agg(*[F.coalesce(F.sum(F.when(F.col(f"_s{i}"), 1 - F.col("_y"))), F.lit(0)).alias(f"n{i}") for i in range(len(sets))],
                      *[F.coalesce(F.sum(F.when(F.col(f"_s{i}"), F.col("_y"))), F.lit(0)).alias(f"p{i}") for i in range(len(sets))]).first()
    neg, pos = (np.array([counts[f"{c}{i}"] for i in range(len(sets))], float) for c in "np")
    edges = quantile_edges(rows, features, params.bins)
    offsets = np.cumsum([0] + [len(e) + 1 for e in edges])
    blocks = stored(spark, rows.mapInArrow(_to_blocks(list(features), edges, len(sets)), "n long, codes binary, y binary, h binary, sets binary"), "boost-blocks")
    n_sets = len(sets)
    sizes = neg + pos
    joints = joints_of(offsets, JOINT_CODES if sizes.max(initial=0) >= JOINT_ROWS else 0)
    local = sizes.max(initial=0) * (len(features) + 2 * len(joints) + 40) <= LOCAL_BYTES  # bytes of a row of ``_Rows``
    rdd = blocks.rdd.map(lambda r: _block(r, n_sets))
    return _Prepared(rdd if local else rdd.persist(StorageLevel.MEMORY_AND_DISK), edges, offsets, neg / np.maximum(1.0, pos), sizes, joints, local)


def _sums(prepared: _Prepared, round_: int, recent: list, grown: _Trees, level: int, params: BoostParams):
    run = _pass(round_, recent, grown, level, prepared.offsets, prepared.weights, prepared.joints, params)
    n_sets, total = len(prepared.weights), int(prepared.offsets[-1])
    if prepared.blocks.getNumPartitions() == 0:
        return np.zeros((n_sets, 2 ** level, total, 2)), np.zeros(n_sets)
    out, loss = prepared.blocks.mapPartitions(run).treeReduce(_plus)
    return out.reshape(n_sets, 2 ** level, total, 2), loss


def _level(prepared: _Prepared, round_: int, recent: list, grown: _Trees, level: int, columns: np.ndarray, params: BoostParams):
    """The best cut of every node of a level (gain, bin, GL, HL, G, H by set and node) and the losses.

    Sums are added up by node and cut where they lie: the driver gets a few numbers per node, however many bins and tasks there are."""
    run = _pass(round_, recent, grown, level, prepared.offsets, prepared.weights, prepared.joints, params)
    n_sets, nodes, offsets = len(prepared.weights), 2 ** level, prepared.offsets
    tasks = prepared.blocks.getNumPartitions()
    closed = ~columns[np.repeat(np.arange(len(columns)), np.diff(offsets))]

    def cells(blocks):
        for out, loss in run(blocks):
            yield from ((i, x) for i, x in enumerate(out) if x.any())
            yield -1, loss

    def choose(cell):
        i, sums = cell
        return cell if i < 0 else (i, _chosen(sums[None], offsets, closed, params)[0])

    best, loss = np.zeros((n_sets * nodes, 6)), np.zeros(n_sets)
    best[:, 0] = -np.inf
    if tasks:
        found = prepared.blocks.mapPartitions(cells)
        if tasks > 1:
            found = found.reduceByKey(np.add, min(tasks, REDUCERS))
        for i, x in found.map(choose).collect():  # sets x nodes rows of six numbers
            if i < 0:
                loss = x
            else:
                best[i] = x
    return best, loss


def fit_many(data: DataFrame, features: Sequence[str], label: str, key: str, sets: dict[str, Column],
             params: BoostParams = BoostParams()) -> dict[str, Booster]:
    """A model for every training set (name -> condition on ``data``'s rows), positives weighted n_neg / max(1, n_pos) in each.

    Rows without a label are in no set.  A set without rows gives a model of leaves with value 0.
    """
    features = list(features)
    p = _prepare(data, features, label, key, sets, params)
    grow = _grow_local if p.local else _grow_by_passes
    return {name: Booster(features, p.edges, params, *found[:5], losses=[float(x) for x in found[5]])
            for name, found in zip(sets, grow(p, features, params))}


_KINDS = (np.int16, np.int16, float, float, float)  # of a booster's arrays


def _grow_local(p: _Prepared, features: list[str], params: BoostParams) -> list[tuple]:
    """(feature, cut, value, cover, gain, losses) of every set, each grown by one task on the set's rows."""
    n_sets, shape = len(p.weights), (params.rounds, 2 ** (params.depth + 1) - 1)
    if not len(features) or not p.blocks.getNumPartitions():
        return [(*[np.full(shape, -1 if i == 0 else 0, t) for i, t in enumerate(_KINDS)], np.zeros(params.rounds + 1)) for _ in range(n_sets)]
    offsets, weights, sizes, joints = p.offsets, p.weights, p.sizes, p.joints

    def deal(part, blocks):
        for n, b in enumerate(blocks):
            for s in range(n_sets):
                mine = b.sets[s]
                if mine.any():
                    yield s, ((part, n), b.codes[mine].tobytes(), b.y[mine].tobytes(), b.h[mine].tobytes())

    def grow(cells):
        found: dict = {}
        for s, cell in cells:
            found.setdefault(s, []).append(cell)
        for s, parts in found.items():
            rows = [_Rows.of(codes, y, h, len(features), joints) for _, codes, y, h in sorted(parts)]
            trees, losses = _grow_set(rows, features, offsets, joints, weights[s], sizes[s], params)
            yield s, b"".join(a.tobytes() for a in (*trees, losses))

    out: list = [None] * n_sets
    for s, cell in p.blocks.mapPartitionsWithIndex(deal).partitionBy(n_sets, int).mapPartitions(grow).collect():  # the trees of each set
        arrays, at = [], 0
        for t in _KINDS:
            arrays.append(np.frombuffer(cell, t, shape[0] * shape[1], at).reshape(shape))
            at += arrays[-1].nbytes
        out[s] = (*arrays, np.frombuffer(cell, float, offset=at))
    for s in range(n_sets):
        if out[s] is None:  # no rows
            out[s] = (*[np.full(shape, -1 if i == 0 else 0, t) for i, t in enumerate(_KINDS)], np.zeros(params.rounds + 1))
    return out


@dataclass
class _Rows:
    """The rows of a training set that come from one block, with their state while trees grow."""

    codes: np.ndarray  # (n, d)
    joint: list[np.ndarray]
    y: np.ndarray
    h: np.ndarray
    margin: np.ndarray
    at: np.ndarray
    gradient: np.ndarray | None = None
    hessian: np.ndarray | None = None

    @classmethod
    def of(cls, codes: bytes, y: bytes, h: bytes, d: int, joints: list[_Joint]) -> "_Rows":
        y = np.frombuffer(y, np.uint8)
        codes = np.frombuffer(codes, np.uint8).reshape(len(y), d)
        small = np.uint8 if max((j.size for j in joints), default=0) <= 256 else np.uint16 if max(j.size for j in joints) <= 65_536 else np.int64
        return cls(codes, [j.code(codes).astype(small) for j in joints], y, np.frombuffer(h, np.uint64), np.zeros(len(y)), np.zeros(len(y), np.int64))


def _grow_set(rows: list[_Rows], features: list[str], offsets: np.ndarray, joints: list[_Joint], weight: float, size: float, params: BoostParams):
    """All trees of one training set: their arrays (rounds, nodes), and the losses before every round and at the end."""
    of_bin = np.repeat(np.arange(len(features)), np.diff(offsets))
    most, total = np.uint64(round(params.rows * 2 ** 20)), int(offsets[-1])
    trees, losses, base = [], np.zeros(params.rounds + 1), np.arange(max(len(b.y) for b in rows)) * len(features)
    for r in range(params.rounds + 1):
        factor = np.uint64(round_factor(r))
        for b in rows:
            losses[r] += np.where(b.y > 0, weight * np.logaddexp(0, -b.margin), np.logaddexp(0, b.margin)).sum()
            p, w = 1.0 / (1.0 + np.exp(-b.margin)), np.where(b.y > 0, weight, 1.0)
            drawn = ((b.h * factor) >> np.uint64(44)) < most
            b.gradient, b.hessian = np.where(drawn, w * (p - b.y), 0.0), np.where(drawn, w * p * (1 - p), 0.0)
            b.at = np.zeros(len(b.y), np.int64)
        if r == params.rounds:
            break
        closed = ~np.array(sampled_columns(r, features, params.columns))[of_bin]
        tree = _Trees.empty(1, params.depth)
        for level in range(params.depth):
            sums = _Sums(joints, 2 ** level)
            for b in rows:
                sums.add(b.joint, b.at, b.gradient, b.hessian)
            if not _split(tree, _chosen(sums.by_bin(total), offsets, closed, params), level, offsets, of_bin, params):
                break
            for b in rows:
                b.at = _onward(b.codes, base[:len(b.y)], b.at, tree.feature[0], tree.cut[0])
        for b in rows:
            b.margin = b.margin + tree.value[0][b.at]
        trees.append(tree)
    return [np.stack([getattr(t, f)[0] for t in trees]).astype(k) if trees else np.zeros((0, 2 ** (params.depth + 1) - 1), k)
            for f, k in zip(("feature", "cut", "value", "cover", "gain"), _KINDS)], losses / np.maximum(1.0, size)


def _grow_by_passes(p: _Prepared, features: list[str], params: BoostParams) -> list[tuple]:
    """The same by a job for every level, for sets of any size."""
    n_sets = len(p.weights)
    losses, every = [], []
    of_bin = np.repeat(np.arange(len(features)), np.diff(p.offsets))
    for r in range(params.rounds + 1):
        before = p.blocks
        if every:  # the last round's tree; the first pass of this round keeps the new margins
            p.blocks = before.map(lambda b, add=every[-1:], depth=params.depth: _Block(b.codes, b.y, b.h, b.sets, _margin(b, add, depth))).persist(
                StorageLevel.MEMORY_AND_DISK)
            if r % FOLD_ROUNDS == 0:
                p.blocks.checkpoint()
        columns = np.array(sampled_columns(r, features, params.columns))
        tree = _Trees.empty(n_sets, params.depth)
        for level in range(params.depth):
            best, loss = _level(p, r, [], tree, level, columns, params)
            if level == 0:
                losses.append(loss / np.maximum(1.0, p.sizes))
                if before is not p.blocks:
                    before.unpersist()
            if r == params.rounds or not _split(tree, best, level, p.offsets, of_bin, params):
                break
        if r < params.rounds:
            every.append(tree)
    p.blocks.unpersist()
    return [(*[np.stack([getattr(t, f)[i] for t in every]) for f in ("feature", "cut", "value", "cover", "gain")], [x[i] for x in losses])
            for i in range(n_sets)]


def _split(tree: _Trees, found: np.ndarray, level: int, offsets: np.ndarray, of_bin: np.ndarray, params: BoostParams) -> bool:
    """Cut the nodes of a level at their best bins (rows of ``_level``); children get their values.  False if no node was cut."""
    nodes = 2 ** level
    gain, best, left, whole = found[:, 0], found[:, 1].astype(int), found[:, 2:4], found[:, 4:6]
    k = np.arange(len(best))
    s, node = k // nodes, k % nodes + nodes - 1
    value = lambda x: -params.rate * x[..., 0] / (x[..., 1] + params.l2)
    if level == 0:
        tree.value[s, node], tree.cover[s, node] = value(whole), whole[..., 1]
    cut = gain > _LEAST_GAIN
    k, s, node, best = k[cut], s[cut], node[cut], best[cut]
    tree.feature[s, node] = of_bin[best]
    tree.cut[s, node] = best - offsets[of_bin[best]]
    tree.gain[s, node] = gain[k]
    for child, x in ((2 * node + 1, left[k]), (2 * node + 2, whole[k] - left[k])):
        tree.value[s, child], tree.cover[s, child] = value(x), x[..., 1]
    return bool(cut.any())


def first_cuts(data: DataFrame, features: Sequence[str], label: str, key: str, sets: dict[str, Column],
               params: BoostParams = BoostParams()) -> DataFrame:
    """set_name, feature, cut, threshold, gain, cover_left: every feature's best cut at the root of round 1 (no column sampling)."""
    p = _prepare(data, list(features), label, key, sets, params)
    sums, _ = _sums(p, 0, [], _Trees.empty(len(sets), params.depth), 0, params)
    gain, left, _ = best_cuts(sums[:, 0], p.offsets, params)
    p.blocks.unpersist()
    rows = []
    for i, name in enumerate(sets):
        for j, f in enumerate(features):
            part = gain[i, p.offsets[j]:p.offsets[j + 1]]
            b = int(part.argmax())
            if np.isfinite(part[b]):
                rows.append((name, f, b, float(p.edges[j][b]), float(part[b]), float(left[i, p.offsets[j] + b, 1])))
    return data.sparkSession.createDataFrame(rows, "set_name string, feature string, cut int, threshold double, gain double, cover_left double")


# ---------------------------------------------------------------- scoring

def predict(df: DataFrame, boosters: dict, keep: Sequence[str], by: str | None = None, out: str = "p") -> DataFrame:
    """``keep`` and the positive-class probability.  ``by`` names the column whose value picks the model
    (rows with another value get NULL); without it ``boosters`` has one model, under None."""
    ship_package(df.sparkSession)
    features = next(iter(boosters.values())).features
    extra = [] if by is None else [F.col(by).alias("_by")]
    src = df.select(*[F.col(c) for c in keep], *extra, *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + f", `{out}` double"
    models, keep = dict(boosters), list(keep)

    def run(batches):
        for b in batches:
            x = np.stack([b.column(f"_f{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))], axis=1)
            p, known = np.zeros(len(x)), np.zeros(len(x), bool)
            which = np.array(b.column("_by").to_pylist(), object) if by is not None else None
            for value, model in models.items():
                mine = np.ones(len(x), bool) if which is None else which == value
                if mine.any():
                    p[mine] = 1.0 / (1.0 + np.exp(-model.margin(x[mine])))
                    known |= mine
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(p, mask=~known)], names=[*keep, out])
    return src.mapInArrow(run, schema)


def loss_curve(spark: SparkSession, boosters: dict[str, Booster]) -> DataFrame:
    """set_name, round, loss: mean weighted log-loss before every round (round 0 is the empty model) and after the last."""
    rows = [(name, i, float(x)) for name, b in boosters.items() for i, x in enumerate(b.losses)]
    return spark.createDataFrame(rows, "set_name string, round int, loss double")

"""A random forest for training rows beyond memory.

Spark's forest keeps a number a tree of each row (400 bytes with 100 trees) in memory or, beyond
that, serialized on disk, and reads all of it again for every level. Here a row is its bins, a byte
a feature, in a staged table; how often a tree draws the row is computed from the row's number
whenever it is needed. The forest is grown level by level as Spark's is: all rows, Poisson(1)
draws for each tree, a third of the features for each node, up to 32 bins by the quantiles of a
sample of 10,000 rows, the split of largest variance reduction, depth 5. Each level is one pass,
in which tasks add up counts and sums by tree, node and bin. Of two siblings only the smaller one
is added up; the other is what is left of the parent.

Features with one threshold that are never above it together (the slots of a one-hot vector) share
a byte. That is decided by the sample and checked on every row: a byte that fails is given up.
The result is a ``RandomForestRegressionModel``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import materialize_at, remove_staged, staging_root

if TYPE_CHECKING:
    import numpy as np

MAX_BINS = 32
MAX_DEPTH = 5
#: Rows whose values give the thresholds, as in Spark's forest.
SPLIT_ROWS = 10_000
#: Features at most: the sample's rows come to the driver.
MAX_FEATURES = 1_000
#: Bytes of one level's sums at most, on the driver and in each task.
MAX_SUMS_BYTES = 64 << 20
#: Rows of a block, a row of the staged table: 8 bytes for the label and one for each group. A file
#: holds one block, so that a task reads a few dozen.
BLOCK_ROWS = 65_536
#: Thresholds that share a byte at most.
MAX_BUNDLE = 200


@dataclass
class Group:
    """A byte of a row: the bin of one feature, or 1 + the place of the feature that is above its
    threshold (0: none)."""

    members: list[int]
    size: int


@dataclass
class Node:
    """Sums over the rows of a node (times drawn, label, its square) and its split, if any."""

    n: float
    s: float
    q: float
    feature: int = -1
    bin: int = 0
    gain: float = 0.0
    children: list = field(default_factory=list)


def thresholds(values: np.ndarray, max_bins: int = MAX_BINS) -> np.ndarray:
    """Spark's thresholds of a feature: midpoints of all distinct values, or where the sorted
    values come closest to equal shares."""
    import numpy as np

    found, counts = np.unique(values, return_counts=True)
    mid = (found[:-1] + found[1:]) / 2
    if len(mid) <= max_bins - 1:
        return mid
    stride = len(values) / max_bins
    out, target, current = [], stride, int(counts[0])
    for i in range(1, len(found)):
        previous, current = current, current + int(counts[i])
        if abs(previous - target) < abs(current - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


def bundles(sample: np.ndarray, cuts: list, apart: set[int] = frozenset()) -> list[Group]:
    """Bytes for the features that have a threshold; those in ``apart`` share none."""
    groups, open_, on_of = [], [], {}
    for j, cut in enumerate(cuts):
        if len(cut) != 1 or j in apart:
            if len(cut):
                groups.append(Group([j], len(cut) + 1))
            continue
        on = sample[:, j] > cut[0]
        free = next((g for g in open_ if len(g.members) < MAX_BUNDLE
                     and not (on_of[id(g)] & on).any()), None)
        if free is None:
            free = Group([], 1)
            open_.append(free)
            groups.append(free)
            on_of[id(free)] = on
        else:
            on_of[id(free)] = on_of[id(free)] | on
        free.members.append(j)
        free.size += 1
    return groups


def _coded(members: list[list[int]], cuts: list, n_features: int, shift: float):
    """Blocks of rows as bytes; ``first`` is the number of a block's first row, and ``clash`` names
    the bytes that two features claim."""

    def coded(batch):
        import numpy as np

        y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        lists = batch.column(0)
        x = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        if (lists.null_count or len(x) != len(y) * n_features
                or not (np.isfinite(x).all() and np.isfinite(y).all())):
            raise ValueError("labels and features must not be NULL, NaN or infinite, and all "
                             "vectors must be of one size")
        x = np.ascontiguousarray(x.reshape(-1, n_features).T)
        clash, out = set(), np.zeros((len(members), len(y)), np.uint8)
        for i, byte_of in enumerate(members):
            if len(byte_of) == 1:
                j = byte_of[0]
                out[i] = np.searchsorted(cuts[j], x[j], side="left")
                continue
            for k, j in enumerate(byte_of):
                on = x[j] > cuts[j][0]
                if (on & (out[i] > 0)).any():
                    clash.add(i)
                out[i][on] = k + 1
        return y - shift, out, clash

    def code(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        at, held, count = TaskContext.get().partitionId() << 33, [], 0

        def block():
            y, out = np.concatenate([h[0] for h in held]), np.hstack([h[1] for h in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([len(y)], pa.int32()),
                 pa.array([y.tobytes()], pa.binary()), pa.array([out.tobytes()], pa.binary()),
                 pa.array([sorted(set().union(*(h[2] for h in held)))], pa.list_(pa.int32()))],
                names=["first", "n", "y", "bytes", "clash"])

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                if count and count + part.num_rows > BLOCK_ROWS:
                    yield block()
                    at, held, count = at + count, [], 0
                held.append(coded(part))
                count += part.num_rows
        if count:
            yield block()

    return code


def poisson_draws(seed: int):
    """Makes, where it is called, the function that takes the rows' numbers and gives the one that
    says how often a tree draws each: Poisson(1) by a hash (SplitMix64) of row, tree and seed."""

    def draws_of():
        import numpy as np

        u64, all_bits = np.uint64, 0xFFFFFFFFFFFFFFFF
        cdf, p = [], math.exp(-1.0)
        for k in range(1, 30):
            cdf.append(p + (cdf[-1] if cdf else 0.0))
            p /= k
        cdf = np.array(cdf)
        # by the first 16 bits, but for the few values that hold a step (255)
        low = np.searchsorted(cdf, np.arange(65536) / 65536, side="right")
        high = np.searchsorted(cdf, np.arange(1, 65537) / 65536, side="left")
        table = np.where(low == high, low, 255).astype(np.uint8)

        def mixed(z):
            z = (z ^ (z >> u64(30))) * u64(0xBF58476D1CE4E5B9)
            return (z ^ (z >> u64(27))) * u64(0x94D049BB133111EB)

        seeded = mixed(np.array([seed & all_bits], u64))[0]

        def draws(numbers):
            base = mixed(numbers.astype(u64) + seeded)
            base ^= base >> u64(31)

            def drawn(tree):
                z = mixed(base + u64(tree * 0x9E3779B97F4A7C15 & all_bits))
                w = table[(z >> u64(48)).astype(np.intp)]
                odd = np.flatnonzero(w == 255)
                w[odd] = np.searchsorted(cdf, (z[odd] >> u64(11)).astype(float) / 2.0 ** 53,
                                         side="right")
                return w

            return drawn

        return draws

    return draws_of


def _sums(sizes: list[int], level: int, paths: list, slots: np.ndarray, n_slots: int, seed: int):
    """Sums of one task by tree: for each byte, wanted node and bin the rows drawn and their labels,
    then each wanted node's squares. Without ``sizes`` only the squares.

    ``paths``: for each tree and level above, the splits ``(node, byte, bin, equal)``;
    ``slots``: for each tree and node of this level its place among the wanted, or 255."""
    n_trees, draws_of = len(paths), poisson_draws(seed)

    def add(batches):
        import numpy as np
        import pyarrow as pa

        draws = draws_of()
        totals = [[np.zeros((2, n_slots * size)) for size in sizes] for _ in range(n_trees)]
        squares = np.zeros((n_trees, n_slots))

        def block(first, n, labels, coded):
            y, small = np.frombuffer(labels), np.frombuffer(coded, np.uint8).reshape(-1, n)
            drawn = draws(np.arange(first, first + n))
            wide = [c.astype(np.intp) for c in small[:len(sizes)]]
            for t in range(n_trees):
                wanted = slots[t]
                if (wanted == 255).all():
                    continue
                w = drawn(t)
                if level == 0:
                    at = np.flatnonzero(w)
                    slot = None
                else:
                    node = np.zeros(len(y), np.uint8)
                    for depth, splits in enumerate(paths[t]):
                        right = np.zeros(len(y), bool)
                        for k, byte, bin_, equal in splits:
                            go = small[byte] == bin_ if equal else small[byte] > bin_
                            if depth:
                                go &= node == k
                            right |= go
                        node += node
                        node += right
                    place = wanted[node]
                    at = np.flatnonzero((place != 255) & (w > 0))
                    slot = place[at].astype(np.intp)
                wi = w[at].astype(float)
                yi = y[at]
                wy = wi * yi
                wyy = wy * yi
                squares[t] += (wyy.sum() if slot is None
                               else np.bincount(slot, wyy, minlength=n_slots))
                for g, size in enumerate(sizes):
                    key = wide[g].take(at)
                    if slot is not None and n_slots > 1:
                        key += slot * size
                    for i, v in enumerate((wi, wy)):
                        totals[t][g][i] += np.bincount(key, v, minlength=n_slots * size)

        any_ = False
        for batch in batches:
            for first, n, labels, coded in zip(*batch.columns, strict=True):
                any_ = True
                block(first.as_py(), n.as_py(), labels.as_buffer(), coded.as_buffer())
        if any_:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n_trees), pa.int32()),
                 pa.array([np.concatenate([*(x.ravel() for x in totals[t]), squares[t]]).tobytes()
                           for t in range(n_trees)], pa.binary())], names=["tree", "sums"])

    return add


def _added():
    def add(table):
        import numpy as np
        import pyarrow as pa

        total = None
        for value in table["sums"]:
            part = np.frombuffer(value.as_py())
            total = part.copy() if total is None else total + part
        return pa.table({"tree": pa.array([table["tree"][0].as_py()], pa.int32()),
                         "sums": pa.array([total.tobytes()], pa.binary())})

    return add


def best_split(node: Node, sums: list, groups: list[Group], where: dict, features) -> tuple:
    """``(feature, bin, gain, left, right)`` of the split of largest gain among ``features``; left
    and right are ``(n, s)``. A gain of 0 or less is no split."""
    import numpy as np

    whole = node.s * node.s / node.n
    best = (-1, 0, 0.0, None, None)
    floor = 1e-14 * node.q / node.n
    for j in features:
        if j not in where:
            continue
        g, k = where[j]
        n, s = sums[g][0], sums[g][1]
        if len(groups[g].members) > 1:
            nr, sr = n[k:k + 1], s[k:k + 1]
            nl, sl = node.n - nr, node.s - sr
        else:
            nl, sl = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
            nr, sr = node.n - nl, node.s - sl
        ok = (nl >= 1) & (nr >= 1)
        if not ok.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, (sl * sl / nl + sr * sr / nr - whole) / node.n, -1.0)
        i = int(np.argmax(gain))
        if gain[i] > max(best[2], floor):
            bin_ = k if len(groups[g].members) > 1 else i
            best = (j, bin_, float(gain[i]), (float(nl[i]), float(sl[i])),
                    (float(nr[i]), float(sr[i])))
    return best


def _stage(rows: DataFrame, groups: list[Group], cuts: list, n_features: int, shift: float):
    members = [g.members for g in groups]
    blocks = rows.mapInArrow(_coded(members, cuts, n_features, shift),
                             "first bigint, n int, y binary, bytes binary, clash array<int>")
    return materialize_at(blocks, "forest-bins", 1)


def grow(train: DataFrame, label: str, features: str, n_rows: int, num_trees: int, seed: int):
    """``(trees, thresholds, shift, number of features)``: the root ``Node`` of each tree; None if
    the thresholds or sums are beyond their bounds, or the session names no staging folder."""
    import numpy as np

    try:
        staging_root(train.sparkSession)
    except RuntimeError:
        return None

    columns = [vector_to_array(F.col(f"`{features}`")).alias("x"),
               F.col(f"`{label}`").cast("double").alias("y")]
    rows = train.select(*columns)
    n_features = len(rows.first().x)
    if not 0 < n_features <= MAX_FEATURES:
        return None
    # only the sampled rows' vectors are made arrays
    sample = train.sample(False, min(1.0, SPLIT_ROWS / n_rows), seed).select(
        *columns).toArrow().combine_chunks()
    x = sample["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    x, y = x.reshape(-1, n_features), sample["y"].to_numpy()
    # labels are shifted by a whole number near their mean, so that squares keep their digits
    shift = float(np.round(np.mean(y))) if len(y) and np.isfinite(y).all() else 0.0
    cuts = [thresholds(x[:, j]) for j in range(n_features)]
    spark, apart, staged = train.sparkSession, set(), []
    try:
        while True:
            groups = bundles(x, cuts, apart)
            if not groups or (num_trees * 2 ** (MAX_DEPTH - 1) * sum(g.size for g in groups) * 16
                              > MAX_SUMS_BYTES):
                return None
            coded, path = _stage(rows, groups, cuts, n_features, shift)
            staged.append(path)
            clashes = coded.select(F.explode("clash").alias("clash")).distinct().collect()
            if not clashes:
                break
            apart |= {j for r in clashes for j in groups[r.clash].members}
        trees = _levels(coded.drop("clash"), groups, num_trees, seed, n_features)
    finally:
        remove_staged(spark, *staged)
    return trees, cuts, shift, n_features


def _levels(coded: DataFrame, groups: list[Group], num_trees: int, seed: int,
            n_features: int) -> list[Node]:
    import numpy as np

    sizes = [g.size for g in groups]
    where = {j: (i, k + 1) for i, g in enumerate(groups) for k, j in enumerate(g.members)}
    per_node = max(1, math.ceil(n_features / 3)) if num_trees > 1 else n_features
    trees: list = [None] * num_trees
    # nodes of the level by tree and place, and the sums of their parents
    level_nodes: list[dict] = [{0: None} for _ in range(num_trees)]
    parents: list[dict] = [{} for _ in range(num_trees)]
    paths: list[list] = [[] for _ in range(num_trees)]
    for level in range(MAX_DEPTH + 1):  # beneath the last one only the leaves' squares are missing
        wanted = [sorted(k for k, node in level_nodes[t].items()
                         if node is None or node.n <= level_nodes[t][k ^ 1].n
                         and (node.n < level_nodes[t][k ^ 1].n or not k & 1))
                  for t in range(num_trees)]
        n_slots = max((len(w) for w in wanted), default=0)
        if not n_slots:
            break
        slots = np.full((num_trees, 2 ** level), 255, np.uint8)
        for t, w in enumerate(wanted):
            slots[t, w] = range(len(w))
        sums_of = sizes if level < MAX_DEPTH else []
        add = _sums(sums_of, level, paths, slots, n_slots, seed)
        found = {r.tree: np.frombuffer(r.sums) for r in
                 coded.mapInArrow(add, "tree int, sums binary").groupBy("tree").applyInArrow(
                     _added(), "tree int, sums binary").collect()}
        for t in range(num_trees):
            if not wanted[t]:
                continue
            own, at = [], 0
            for size in sums_of:
                own.append(found[t][at:at + 2 * n_slots * size].reshape(2, n_slots, size))
                at += 2 * n_slots * size
            squares = found[t][at:]
            known, following, splits = {}, {}, []
            for i, k in enumerate(wanted[t]):
                known[k] = [o[:, i, :] for o in own], squares[i]
                if level:
                    up, q = parents[t][k >> 1]
                    known[k ^ 1] = [a - b for a, b in zip(up, known[k][0])], q - squares[i]
            done = {}
            for k in sorted(known):
                sums, q = known[k]
                node = level_nodes[t][k]
                if node is None:  # the root
                    node = trees[t] = Node(*(float(v) for v in sums[0].sum(axis=1)), 0.0)
                node.q = float(q)
                if level == MAX_DEPTH or node.n < 1:
                    continue
                rng = np.random.default_rng([seed & 0xFFFFFFFF, t, 2 ** level + k])
                some = (range(n_features) if per_node == n_features else
                        sorted(rng.choice(n_features, per_node, replace=False).tolist()))
                node.feature, node.bin, node.gain, left, right = best_split(
                    node, sums, groups, where, some)
                if node.feature < 0:
                    continue
                g = where[node.feature][0]
                splits.append((k, g, node.bin, len(groups[g].members) > 1))
                node.children = [Node(*left, math.nan), Node(*right, math.nan)]
                following |= {2 * k + i: c for i, c in enumerate(node.children)}
                done[k] = sums, node.q
            paths[t].append(splits)
            level_nodes[t], parents[t] = following, done
    return trees


def to_model(spark, trees: list[Node], cuts: list, shift: float, n_features: int, uid: str):
    """The trees as Spark's own model; children that predict the same become one leaf, as there."""
    from pyspark.ml.regression import RandomForestRegressionModel

    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    tree, impurity = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity
    regression = jvm.org.apache.spark.ml.regression

    def made(node):
        """The Java node, and its prediction if it is a leaf."""
        mean = node.s / node.n if node.n else 0.0
        spread = max(node.q / node.n - mean * mean, 0.0) if node.n else 0.0
        stats = gateway.new_array(jvm.double, 3)
        stats[0], stats[1] = float(node.n), float(node.s + shift * node.n)
        stats[2] = float(node.q + 2 * shift * node.s + shift * shift * node.n)
        counted = impurity.VarianceCalculator(stats, int(node.n))
        if node.children:
            (left, a), (right, b) = (made(c) for c in node.children)
            if a is None or b is None or a != b:
                cut = cuts[node.feature]
                split = tree.ContinuousSplit(
                    node.feature, float(cut[0] if len(cut) == 1 else cut[node.bin]))
                return tree.InternalNode(mean + shift, spread, node.gain, left, right, split,
                                         counted), None
        return tree.LeafNode(mean + shift, spread, counted), mean + shift

    all_ = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    for i, root in enumerate(trees):
        all_[i] = regression.DecisionTreeRegressionModel(f"{uid}_{i}", made(root)[0], n_features)
    return RandomForestRegressionModel(
        regression.RandomForestRegressionModel(uid, all_, n_features))

"""Models fitted by plain aggregations, the same on every partitioning.

Each step of a fit is one scan with one map-side combined aggregation; what
reaches the driver is a statistic whose size is fixed by the model (nodes x
features x bins x classes, clusters x coordinates, coefficients squared),
never rows. Nothing is drawn, so results can be rebuilt in SQL.

* ``histogram_tree``: a decision tree level by level on binned features.
* ``lloyd_kmeans`` / ``gaussian_em``: Lloyd and EM steps from sufficient
  statistics, seeded by ``hash_seeds`` or ``parallel_seeds``.
* ``newton_logistic``: Newton steps on the summed gradient and Hessian.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a histogram, and classes, that a fit takes.
MAX_CELLS, MAX_CLASSES = 4_000_000, 1_000


# ----------------------------------------------------------------- trees
@dataclass
class Tree:
    """Splits by node (children 2n and 2n + 1): a row goes right where the
    bin of the split's feature is above its cut."""

    features: list[str]
    low: list[float]
    width: list[float]
    bins: int
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    labels: dict[int, object] = field(default_factory=dict)

    def bin_of(self, f: int) -> Column:
        """Equal-width bin of a feature; a null is in the first one."""
        if self.width[f] == 0:
            return F.lit(0)
        x = F.col(f"`{self.features[f]}`").cast("double")
        at = F.floor((x - F.lit(self.low[f])) / F.lit(self.width[f]))
        return F.when(x.isNull(), 0).otherwise(F.greatest(F.least(at, F.lit(self.bins - 1)), F.lit(0))).cast("int")

    def node_of(self) -> Column:
        """The deepest node that a row reaches."""
        def walk(n):
            if n not in self.splits:
                return F.lit(n)
            f, cut = self.splits[n]
            return F.when(self.bin_of(f) > cut, walk(2 * n + 1)).otherwise(walk(2 * n))
        return walk(1)

    def predict(self) -> Column:
        """The label of a row's leaf; a column without a Python function."""
        leaves = [n for n in self.labels if n not in self.splits]
        node, out = self.node_of(), None
        for n in leaves:
            out = F.when(node == n, F.lit(self.labels[n])) if out is None else out.when(node == n, F.lit(self.labels[n]))
        return out if out is not None else F.lit(None)


def binned(df: DataFrame, features: list[str], bins: int) -> Tree:
    """A tree without splits: bin edges from one aggregation."""
    ends = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{n}{k}") for k, c in enumerate(features)
                    for n, f in (("lo", F.min), ("hi", F.max))]).first()
    low = [ends[f"lo{k}"] if ends[f"lo{k}"] is not None else 0.0 for k in range(len(features))]
    high = [ends[f"hi{k}"] if ends[f"hi{k}"] is not None else 0.0 for k in range(len(features))]
    return Tree(list(features), low, [(h - lo) / bins for lo, h in zip(low, high)], bins)


def histogram(df: DataFrame, tree: Tree, label: str) -> DataFrame:
    """(node, f, b, y, n): rows of every class in every bin of every feature
    by node, one aggregation for a whole level."""
    cells = F.array(*[F.struct(F.lit(k).alias("f"), tree.bin_of(k).alias("b")) for k in range(len(tree.features))])
    return (df.select(tree.node_of().alias("node"), F.col(f"`{label}`").alias("y"), F.explode(cells).alias("c"))
            .groupBy("node", "c.f", "c.b", "y").agg(F.count(F.lit(1)).alias("n")))


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """(feature, cut) of least Gini impurity for counts [f, b, class]; ties go
    to the first feature, then the lowest cut; None if nothing is gained."""
    left = counts.cumsum(1)[:, :-1].astype(float)
    right = counts.sum(1, keepdims=True) - left
    total = counts[0].sum(0).astype(float)
    nl, nr = left.sum(2), right.sum(2)
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = np.round(nl - (left * left).sum(2) / nl + nr - (right * right).sum(2) / nr, 9)
    impurity[(nl == 0) | (nr == 0)] = np.inf
    whole = round(total.sum() - (total * total).sum() / total.sum(), 9)
    f, cut = divmod(int(impurity.argmin()), impurity.shape[1]) if impurity.size else (0, 0)
    return (f, cut) if impurity.size and whole - impurity[f, cut] > 1e-9 else None


def histogram_tree(df: DataFrame, features: list[str], label: str, depth: int = 5, bins: int = 32) -> Tree:
    """A classification tree of at most ``depth`` levels. Rows without a
    label are not used; an empty table gives a tree without a label."""
    df = df.filter(F.col(f"`{label}`").isNotNull())
    tree = binned(df, features, bins)
    open_nodes = [1]
    for level in range(depth + 1):
        rows = histogram(df.filter(tree.node_of().isin(open_nodes)) if level else df, tree, label)
        got = rows.limit(MAX_CELLS + 1).toPandas()
        if len(got) > MAX_CELLS or got["y"].nunique() > MAX_CLASSES:
            raise ValueError(f"a level has more than {MAX_CELLS} cells or {MAX_CLASSES} classes")
        if not len(got):
            break
        classes = sorted(got["y"].unique().tolist())
        place = {n: k for k, n in enumerate(open_nodes)}
        counts = np.zeros((len(open_nodes), len(features), bins, len(classes)), np.int64)
        y = got["y"].map({c: k for k, c in enumerate(classes)}).to_numpy()
        counts[got["node"].map(place).to_numpy(), got["f"].to_numpy(), got["b"].to_numpy(), y] = got["n"].to_numpy()
        after = []
        for n in open_nodes:
            tree.labels[n] = classes[int(counts[place[n]][0].sum(0).argmax())]  # ties: the least label
            split = best_split(counts[place[n]]) if level < depth else None
            if split:
                tree.splits[n] = split
                after += [2 * n, 2 * n + 1]
        open_nodes = after
        if not open_nodes:
            break
    return tree


def histogram_forest(df: DataFrame, features: list[str], label: str, key: Column, trees: int = 10, depth: int = 5,
                     bins: int = 32) -> list[Tree]:
    """Trees on hash-weighted bags: row copies (0 to 3, in mean one) and the
    square root of the features follow from a hash of ``key`` and the tree's
    number, so a forest is the same on every partitioning."""
    out = []
    width = max(int(round(len(features) ** 0.5)), 1)
    for t in range(trees):
        draw = F.pmod(F.xxhash64(F.lit(t), key), F.lit(1000))
        copies = F.when(draw < 368, 0).when(draw < 736, 1).when(draw < 920, 2).otherwise(3)
        bag = df.withColumn("__copy", F.explode(F.expr("sequence(1, 3)"))).filter(F.col("__copy") <= copies).drop("__copy")
        rng = np.random.default_rng(t)
        own = sorted(rng.choice(len(features), width, replace=False).tolist())
        out.append(histogram_tree(bag, [features[k] for k in own], label, depth, bins))
    return out


def vote(forest: list[Tree], classes: list) -> Column:
    """The class with most trees; ties go to the first of ``classes``."""
    votes = [sum((F.when(t.predict() == c, 1).otherwise(0) for t in forest), F.lit(0)) for c in classes]
    most = F.greatest(*votes, F.lit(0))
    out = F.when(votes[0] == most, F.lit(classes[0]))
    for v, c in zip(votes[1:], classes[1:]):
        out = out.when(v == most, F.lit(c))
    return out


# -------------------------------------------------------------- clusters
def _distance(cols: list[str], center) -> Column:
    out = None
    for c, x in zip(cols, center):
        d = (F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x)))
        out = d if out is None else out + d
    return out


def nearest(cols: list[str], centers) -> Column:
    """Number of the nearest center; ties go to the first."""
    return F.array_min(F.array(*[F.struct(_distance(cols, x).alias("d"), F.lit(k).alias("c")) for k, x in enumerate(centers)]))["c"]


def hash_seeds(df: DataFrame, cols: list[str], key: str, k: int) -> list[list[float]]:
    """The rows with the ``k`` least md5 digests of their key."""
    rows = df.select(*cols, key).orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(k).collect()
    return [[float(r[c]) for c in cols] for r in rows]


def parallel_seeds(df: DataFrame, cols: list[str], key: str, k: int, rounds: int = 4) -> list[list[float]]:
    """Oversampling seeds: each round keeps a row with probability ``2 k`` times
    its share of the squared distances, drawn by a hash of (key, round); the
    kept rows (some 2 k a round), weighted by the rows next to them, are then
    thinned to ``k`` by weight and distance."""
    centers = hash_seeds(df, cols, key, 1)
    for r in range(rounds):
        far = df.select(*cols, key, F.array_min(F.array(*[_distance(cols, x) for x in centers])).alias("d"))
        total = far.agg(F.sum("d")).first()[0]
        if not total:
            break
        draw = F.pmod(F.xxhash64(F.lit(r), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        new = far.filter(draw < 2 * k * F.col("d") / F.lit(total)).orderBy(F.xxhash64(F.lit(r), F.col(key)), key).limit(8 * k).collect()
        centers += [[float(x[c]) for c in cols] for x in new]
    weight = {x["c"]: x["n"] for x in df.groupBy(nearest(cols, centers).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    points, w = np.array(centers), np.array([weight.get(j, 0) for j in range(len(centers))], float)
    chosen = [int(w.argmax())]
    while len(chosen) < min(k, len(points)):
        d = ((points[:, None] - points[chosen][None]) ** 2).sum(2).min(1) * w
        if d.max() <= 0:
            break
        chosen.append(int(d.argmax()))
    return points[chosen].tolist()


def lloyd_kmeans(df: DataFrame, cols: list[str], centers: list[list[float]], rounds: int = 10) -> list[list[float]]:
    """Centers after ``rounds`` steps (fewer, if nothing moves): each is one
    aggregation. A center without rows stays where it is; rows with a null
    coordinate are left out."""
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    for _ in range(rounds):
        got = df.groupBy(nearest(cols, centers).alias("c")).agg(*[F.avg(c).alias(c) for c in cols]).collect()  # a row per center
        after = [list(x) for x in centers]
        for r in got:
            after[r["c"]] = [float(r[c]) for c in cols]
        if after == centers:
            break
        centers = after
    return centers


def gaussian_em(df: DataFrame, cols: list[str], centers: list[list[float]], rounds: int = 10, floor: float = 1e-6):
    """(weights, means, variances) of a diagonal Gaussian mixture after
    ``rounds`` EM steps: each is one aggregation of the responsibilities'
    sums, sums of values and of squares."""
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    k = len(centers)
    first = df.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(c) for c in cols]).first()
    if not first["n"]:
        return np.full(k, 1 / k), np.array(centers, float), np.ones((k, len(cols)))
    weight, mean = np.full(k, 1 / k), np.array(centers, float)
    var = np.tile(np.maximum([first[c] for c in cols], floor), (k, 1))
    for _ in range(rounds):
        logs = F.array(*[_log_density(cols, weight[j], mean[j], var[j]) for j in range(k)])
        e = df.withColumn("l", logs).withColumn("top", F.array_max("l"))
        e = e.withColumn("e", F.array(*[F.exp(F.col("l")[j] - F.col("top")) for j in range(k)]))
        e = e.withColumn("z", sum((F.col("e")[j] for j in range(1, k)), F.col("e")[0]))
        part = [F.col("e")[j] / F.col("z") for j in range(k)]
        s = e.agg(*[F.sum(part[j]).alias(f"n{j}") for j in range(k)],
                  *[F.sum(part[j] * F.col(c)).alias(f"x{j}_{i}") for j in range(k) for i, c in enumerate(cols)],
                  *[F.sum(part[j] * F.col(c) * F.col(c)).alias(f"q{j}_{i}") for j in range(k) for i, c in enumerate(cols)]).first()
        n = np.maximum([s[f"n{j}"] for j in range(k)], 1e-300)
        mean = np.array([[s[f"x{j}_{i}"] / n[j] for i in range(len(cols))] for j in range(k)])
        var = np.maximum([[s[f"q{j}_{i}"] / n[j] - mean[j][i] ** 2 for i in range(len(cols))] for j in range(k)], floor)
        weight = n / first["n"]
    return weight, mean, var


def _log_density(cols, weight, mean, var) -> Column:
    out = F.lit(float(np.log(weight) - 0.5 * np.log(2 * np.pi * np.asarray(var)).sum()))
    for c, m, v in zip(cols, mean, var):
        out = out - (F.col(c) - F.lit(float(m))) * (F.col(c) - F.lit(float(m))) / F.lit(float(2 * v))
    return out


# -------------------------------------------------------------- logistic
def newton_logistic(df: DataFrame, features: list[str], label: str, rounds: int = 8, ridge: float = 0.0) -> list[float]:
    """[intercept, coefficients...] of a logistic regression on a 0/1 label
    after ``rounds`` Newton steps from zero. A step is one aggregation: the
    gradient and the upper triangle of the Hessian. Rows with a null are left
    out; ``ridge`` penalises all but the intercept (by sums, not means)."""
    df = df.select(F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i + 1}") for i, c in enumerate(features)]).dropna()
    size = len(features) + 1
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(1, size)]]
    beta, shrink = np.zeros(size), ridge * np.diag([0.0] + [1.0] * (size - 1))
    for _ in range(rounds):
        score = F.lit(float(beta[0]))
        for i in range(1, size):
            score = score + F.lit(float(beta[i])) * x[i]
        step = df.withColumn("p", 1 / (1 + F.exp(-score))).withColumn("w", F.col("p") * (1 - F.col("p")))
        s = step.agg(*[F.coalesce(F.sum((F.col("y") - F.col("p")) * x[i]), F.lit(0.0)).alias(f"g{i}") for i in range(size)],
                     *[F.coalesce(F.sum(F.col("w") * x[i] * x[j]), F.lit(0.0)).alias(f"h{i}_{j}") for i in range(size) for j in range(i, size)]).first()
        grad = np.array([s[f"g{i}"] for i in range(size)]) - shrink @ beta
        hess = np.array([[s[f"h{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)]) + shrink
        move = np.linalg.lstsq(hess, grad, rcond=None)[0]
        beta = beta + move
        if np.abs(move).max(initial=0) < 1e-13:
            break
    return beta.tolist()


def softmax_classes(df: DataFrame, features: list[str], label: str, rounds: int = 8, ridge: float = 1e-3) -> dict[object, list[float]]:
    """One-against-rest Newton fits, by class (a bounded set)."""
    classes = [r[0] for r in df.select(label).dropna().distinct().limit(MAX_CLASSES + 1).collect()]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return {c: newton_logistic(df.withColumn("__y", (F.col(label) == F.lit(c)).cast("int")), features, "__y", rounds, ridge)
            for c in sorted(classes)}

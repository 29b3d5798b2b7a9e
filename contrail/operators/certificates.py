"""Proofs of fitted models that need no second fit.

``elastic_net_certificate`` tests a linear fit by the optimality conditions of its
penalised objective, from the moments of its training rows: whatever the solver,
a fit that meets them is the optimum. ``forest_table`` lists a fitted forest's nodes, so
that splits can be compared with sums over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Excess of a condition, in standardised units, that the solver's stopping rule may leave.
TOLERANCE = 1e-4


def training_moments(df: DataFrame, label: str, columns: Sequence[str], fold_col: str,
                     num_folds: int) -> DataFrame:
    """One row a fold: means, population variances and covariances of the rows that the fold
    trains on (all other folds'), in one aggregate."""
    others = F.filter(F.array(*[F.lit(f) for f in range(num_folds)]),
                      lambda f: f != F.col(f"`{fold_col}`"))
    x = [F.col(f"`{c}`").cast("double") for c in columns]
    y = F.col(f"`{label}`").cast("double")
    rows = df.select(F.explode(others).alias("fold"), y.alias("y"),
                     *[c.alias(f"x{i}") for i, c in enumerate(x)])
    names = [f"x{i}" for i in range(len(x))]
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_y"), F.var_pop("y").alias("yy")]
    aggs += [F.avg(c).alias(f"mean_{c}") for c in names]
    aggs += [F.covar_pop(c, "y").alias(f"{c}_y") for c in names]
    aggs += [F.covar_pop(a, b).alias(f"{a}_{b}") for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy("fold").agg(*aggs)


def fitted_models(spark, cv_model) -> DataFrame:
    """``(fold, regParam, elasticNetParam, intercept, coefficients)`` of every fit of a grid search
    that kept its models (``grid_search(..., keep_models=True)``)."""
    rows = []
    for fold, fits in enumerate(cv_model.subModels):
        for m in fits:
            rows.append((fold, float(m.getOrDefault("regParam")),
                         float(m.getOrDefault("elasticNetParam")), float(m.intercept),
                         [float(v) for v in m.coefficients.toArray()]))
    return spark.createDataFrame(rows, "fold int, regParam double, elasticNetParam double, "
                                       "intercept double, coefficients array<double>")


def elastic_net_certificate(moments: DataFrame, fits: DataFrame, columns: Sequence[str],
                            tolerance: float = TOLERANCE) -> DataFrame:
    """``(fold, regParam, elasticNetParam, term, coefficient, excess, violated)``.

    With predictors and label standardised by their population deviations, b the standardised
    coefficients, r the covariances of predictors and residual and ``l = regParam / sd(label)``,
    a fit is optimal exactly if for each term
    ``r_j = l (alpha sign(b_j) + (1 - alpha) b_j)`` where b_j is not 0, ``|r_j| <= l alpha``
    where it is, and the mean residual is 0. ``excess`` is how far a term is from that. A
    constant predictor must have coefficient 0; a constant label has no coefficients.
    """
    names = [f"x{i}" for i in range(len(columns))]
    met = fits.join(F.broadcast(moments), "fold")
    sd_y = F.sqrt("yy")
    pair = lambda i, k: F.col(f"x{min(i, k)}_x{max(i, k)}")
    beta = {n: F.get("coefficients", F.lit(i)) for i, n in enumerate(names)}

    def term(i: int) -> Column:
        j = names[i]
        sd = F.sqrt(F.col(f"{j}_{j}"))
        rest = F.col(f"{j}_y")
        for k, other in enumerate(names):
            rest = rest - pair(i, k) * beta[other]
        r, b = rest / (sd * sd_y), beta[j] * sd / sd_y
        lam, alpha = F.col("regParam") / sd_y, F.col("elasticNetParam")
        held = F.when(beta[j] != 0, F.abs(r - lam * (alpha * F.signum(b) + (1 - alpha) * b))
                      ).otherwise(F.greatest(F.lit(0.0), F.abs(r) - lam * alpha))
        return F.when((sd == 0) | (sd_y == 0), F.abs(beta[j])).otherwise(held)

    predicted = F.col("intercept")
    for n in names:
        predicted = predicted + F.col(f"mean_{n}") * beta[n]
    off = F.abs(F.col("mean_y") - predicted) / F.when(sd_y == 0, 1.0).otherwise(sd_y)
    terms = [F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("coefficient"),
                      off.alias("excess"))]
    terms += [F.struct(F.lit(c).alias("term"), beta[n].alias("coefficient"),
                       term(i).alias("excess"))
              for i, (c, n) in enumerate(zip(columns, names, strict=True))]
    return met.select("fold", "regParam", "elasticNetParam", F.inline(F.array(*terms))).withColumn(
        "violated", ~F.coalesce(F.col("excess") <= tolerance, F.lit(False)))


def forest_table(spark, model, feature_names: Sequence[str]) -> DataFrame:
    """``(tree, node, depth, feature, threshold, prediction, gain)``: the nodes of a fitted tree or
    forest; leaves have no feature. Nodes are numbered as in a heap: 1 is the root, 2n and
    2n + 1 the children of n, rows with ``feature <= threshold`` going to 2n."""
    rows = []
    trees = model.trees if hasattr(model, "trees") else [model]
    for no, tree in enumerate(trees):
        todo = [(1, 0, tree._call_java("rootNode"))]
        while todo:
            at, depth, node = todo.pop()
            kind = node.getClass().getSimpleName()
            if kind == "LeafNode":
                rows.append((no, at, depth, None, None, float(node.prediction()), None))
                continue
            split = node.split()
            if split.getClass().getSimpleName() != "ContinuousSplit":
                raise ValueError("categorical splits have no threshold")
            rows.append((no, at, depth, feature_names[split.featureIndex()],
                         float(split.threshold()), float(node.prediction()), float(node.gain())))
            todo += [(2 * at + 1, depth + 1, node.rightChild()),
                     (2 * at, depth + 1, node.leftChild())]
    return spark.createDataFrame(rows, "tree int, node bigint, depth int, feature string, "
                                       "threshold double, prediction double, gain double")

"""Category indexing, one-hot encoding, vector assembly and min-max scaling.

Indexing and one-hot use the built-in multi-column ML stages: one fitting
pass for all categorical columns (the reference fitted one column per job).
Fitted label lists live on the driver as model state, so their size is
checked up front with a HyperLogLog pass where ``max_categories`` is given.
Min-max scaling is one ``agg(min, max)`` over all columns and a projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDEX_SUFFIX = "_Index"
ONEHOT_SUFFIX = "_OneHot"
FULL_SUFFIX = "_OneHotFull"
SCALED_SUFFIX = "_Scaled"
DEFAULT_MAX_CATEGORIES = None  # no bound, as StringIndexer has none


def check_cardinality(df: DataFrame, columns: Sequence[str],
                      max_categories: int | None = DEFAULT_MAX_CATEGORIES) -> None:
    """Refuse to index a column whose (approximate) cardinality exceeds the bound."""
    if max_categories is None or not columns:
        return
    row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"k{i}")
                   for i, c in enumerate(columns)]).first()
    over = [(c, row[f"k{i}"]) for i, c in enumerate(columns) if row[f"k{i}"] > max_categories]
    if over:
        raise ValueError("too many categories to index: "
                         + ", ".join(f"{c} (~{k})" for c, k in over)
                         + f"; max_categories={max_categories}")


def fit_string_indexer(df: DataFrame, columns: Sequence[str], *, suffix: str = INDEX_SUFFIX,
                       handle_invalid: str = "error",
                       max_categories: int | None = DEFAULT_MAX_CATEGORIES):
    """Frequency-descending index (ties alphabetical), fitted in one pass."""
    columns = list(columns)
    check_cardinality(df, columns, max_categories)
    indexer = StringIndexer(inputCols=columns, outputCols=[c + suffix for c in columns],
                            stringOrderType="frequencyDesc", handleInvalid=handle_invalid)
    return indexer.fit(df)


def index_labels(model) -> dict[str, list[str]]:
    return dict(zip(model.getInputCols(), [list(a) for a in model.labelsArray]))


def labels_frame(spark, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(column_name, value, idx)`` from fitted labels."""
    rows = [(c, v, float(i)) for c, vals in labels.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "column_name string, value string, idx double")


def string_index(df: DataFrame, columns: Sequence[str], *, fit_df: DataFrame | None = None,
                 suffix: str = INDEX_SUFFIX, handle_invalid: str = "error",
                 max_categories: int | None = DEFAULT_MAX_CATEGORIES):
    """Add ``<c>_Index`` for each column; returns ``(frame, model)``."""
    model = fit_string_indexer(fit_df if fit_df is not None else df, columns, suffix=suffix,
                               handle_invalid=handle_invalid, max_categories=max_categories)
    return model.transform(df), model


def one_hot(df: DataFrame, index_columns: Sequence[str], output_columns: Sequence[str], *,
            drop_last: bool = True, handle_invalid: str = "error",
            n_categories: Mapping[str, int] | None = None):
    """Sparse one-hot vectors (last category dropped by default: size k-1).

    ``n_categories`` (from the indexer) lets us name the column that has a
    single category, which the encoder cannot handle with ``drop_last``.
    """
    if drop_last and n_categories:
        single = [c for c, k in n_categories.items() if k < 2]
        if single:
            raise ValueError("one-hot with drop_last needs at least two categories; "
                             f"single-category column(s): {single}")
    encoder = OneHotEncoder(inputCols=list(index_columns), outputCols=list(output_columns),
                            dropLast=drop_last, handleInvalid=handle_invalid)
    model = encoder.fit(df)  # sizes come from the indexer's column metadata
    return model.transform(df), model


def encode_categoricals(df: DataFrame, columns: Sequence[str], *,
                        fit_df: DataFrame | None = None, handle_invalid: str = "error",
                        drop_last: bool = True, rename: bool = True,
                        max_categories: int | None = DEFAULT_MAX_CATEGORIES):
    """Index + one-hot every categorical column, then drop the text and index
    columns and (``rename``) give the vectors the original names.

    Returns ``(frame, PipelineModel, labels)``; the model replays the same
    encoding on any other frame (e.g. the test split).
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df, None, {}
    base = fit_df if fit_df is not None else df
    idx_model = fit_string_indexer(base, columns, handle_invalid=handle_invalid,
                                   max_categories=max_categories)
    labels = index_labels(idx_model)
    if drop_last and any(len(v) < 2 for v in labels.values()):
        single = [c for c, v in labels.items() if len(v) < 2]
        raise ValueError("one-hot with drop_last needs at least two categories; "
                         f"single-category column(s): {single}")
    indexed_base = idx_model.transform(base)
    if handle_invalid != "keep" or not drop_last:
        _, ohe_model = one_hot(indexed_base, [c + INDEX_SUFFIX for c in columns],
                               [c + ONEHOT_SUFFIX for c in columns], drop_last=drop_last)
        stages = [idx_model, ohe_model]
    else:
        # With an "unknown" bucket the indexer has k+1 levels and dropLast
        # would drop the bucket, leaving all k real levels: collinear with
        # the intercept (singular normal equations). Encode all k+1, then
        # keep the first k-1 slots: the last real level and unseen values
        # both become the all-zero baseline, as in the reference's encoding.
        full = [c + FULL_SUFFIX for c in columns]
        _, ohe_model = one_hot(indexed_base, [c + INDEX_SUFFIX for c in columns], full,
                               drop_last=False)
        slicers = [VectorSlicer(inputCol=f, outputCol=c + ONEHOT_SUFFIX,
                                indices=list(range(len(labels[c]) - 1)))
                   for c, f in zip(columns, full)]
        stages = [idx_model, ohe_model, *slicers, SQLTransformer(
            statement="SELECT * EXCEPT (" + ", ".join(f"`{f}`" for f in full) + ") FROM __THIS__")]
    model = PipelineModel(stages=stages)
    return apply_encoding(df, model, columns, rename), model, labels


def apply_encoding(df: DataFrame, model: PipelineModel, columns: Sequence[str],
                   rename: bool = True) -> DataFrame:
    out = model.transform(df).drop(*columns, *[c + INDEX_SUFFIX for c in columns])
    if rename:
        out = out.withColumnsRenamed({c + ONEHOT_SUFFIX: c for c in columns})
    return out


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """One vector column from numeric and vector columns, in the given order."""
    return VectorAssembler(inputCols=list(columns), outputCol=output,
                           handleInvalid=handle_invalid).transform(df)


def explode_vector(df: DataFrame, vector_col: str, id_cols: Sequence[str],
                   nonzero_only: bool = False) -> DataFrame:
    """``(ids..., pos, value)`` rows from a vector column (for tables and checks)."""
    out = df.select(*id_cols, F.posexplode(vector_to_array(vector_col)).alias("pos", "value"))
    return out.filter(F.col("value") != 0) if nonzero_only else out


def min_max_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """``{column: (min, max)}`` from one aggregate over all columns."""
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(columns)}


def scale_expr(c: str, mn, mx):
    x = F.col(f"`{c}`").cast("double")
    if mn is None or mx is None:
        return F.lit(None).cast("double")
    if mn == mx:
        return F.when(x.isNotNull(), F.lit(0.5))
    return (x - F.lit(float(mn))) / F.lit(float(mx) - float(mn))


def min_max_scale(df: DataFrame, columns: Sequence[str], *, fit_df: DataFrame | None = None,
                  suffix: str = SCALED_SUFFIX, keep_original: bool = False,
                  bounds: Mapping[str, tuple] | None = None):
    """Scale each column to [0, 1] by the fitted min/max; a constant column -> 0.5.

    Same values as ``VectorAssembler`` + ``MinMaxScaler`` per column, in one
    pass instead of one fit per column. Returns ``(frame, bounds)``.
    """
    columns = list(columns)
    if bounds is None:
        bounds = min_max_bounds(fit_df if fit_df is not None else df, columns)
    scaled = {c: scale_expr(c, *bounds[c]).alias(c + suffix) for c in columns}
    out = [F.col(f"`{c}`") for c in df.columns if keep_original or c not in scaled]
    return df.select(*out, *scaled.values()), dict(bounds)


def model_pipeline(categorical: Sequence[str], numeric: Sequence[str], estimator, *,
                   features: str = "features", handle_invalid: str = "error"):
    """One reusable ``pyspark.ml.Pipeline``: index -> one-hot -> scale -> assemble -> model.

    The numeric predictors are assembled into one vector and scaled by a
    single ``MinMaxScaler`` (one fitting pass for all of them, instead of a
    pipeline per column); the one-hot vectors and the scaled block are then
    assembled for ``estimator``. ``fit`` runs every stage on the training
    frame only, and the fitted ``PipelineModel`` can be saved and replayed.
    Unseen categories raise (the reference's behaviour); with
    ``handle_invalid="keep"`` they get their own level, and ``dropLast``
    then drops that level, so use a regularised estimator.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler

    categorical, numeric = list(categorical), list(numeric)
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical,
                                    outputCols=[c + INDEX_SUFFIX for c in categorical],
                                    stringOrderType="frequencyDesc",
                                    handleInvalid=handle_invalid))
        stages.append(OneHotEncoder(inputCols=[c + INDEX_SUFFIX for c in categorical],
                                    outputCols=[c + ONEHOT_SUFFIX for c in categorical]))
    parts = [c + ONEHOT_SUFFIX for c in categorical]
    if numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="_numeric"))
        stages.append(MinMaxScaler(inputCol="_numeric", outputCol="_numeric_scaled"))
        parts.append("_numeric_scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol=features))
    stages.append(estimator)
    return Pipeline(stages=stages)

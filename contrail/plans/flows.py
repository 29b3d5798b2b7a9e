"""The two end-to-end pipelines: categorical places and coordinate places.

Shape of the work (each "pass" is one scan + one aggregate; the only
full-data shuffle is the de-duplication):

  raw --tokens, forbidden--> Parquet landing --> pass A: NULL profile + zero count       -> sparse columns
      --drop sparse, dropna--> pass B: constancy + letters + approx k -> constants, categoricals
      --dedupe (shuffle), [lookup joins], tolerant cast, clock flag--> Parquet in the shared
        staging folder (lineage cut; survives executor loss)
  clean: pass C: counts, NULLs created by the cast, HLL cardinality (one aggregate)
      --> index/one-hot fit (train) --> pass D: correlation + min/max (train) in one aggregate
      --> assemble [--> Parquet] --> model fit (train) --> predictions + metrics (test), one aggregate
"""

from __future__ import annotations

import time
from functools import reduce
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contrail.functions.casts import tolerant_double, tolerant_int
from contrail.functions.clock import hhmm_to_minutes, valid_clock
from contrail.operators.clean import cast_numeric, drop_null_rows, replace_null_tokens
from contrail.operators.enrich import duplicate_keys, missing_keys, role_join
from contrail.operators.features import SCALED_SUFFIX, assemble, encode_categoricals, scale_expr
from contrail.operators.models import fit_forest, fit_linear, regression_metrics
from contrail.operators.profile import constant_and_letters, profile_columns
from contrail.operators.split import random_split, split_label
from contrail.operators.stats import HIGH_CORR_THRESHOLD, pair_moments, trend
from contrail.plans.config import PipelineConfig
from contrail.session import ROWS_PER_FILE, materialize_at

VALID_FLAG = "_valid_time"
MATCH_FLAG = "_matched"
FOUND = "_found"
SPLIT_COL = "_split"
#: Clean rows beyond which the assembled features are staged; few are encoded again in every pass.
STAGE_FEATURE_ROWS = 1_000_000


@dataclass
class PipelineResult:
    clean: DataFrame                 # typed, cleaned rows (before encoding)
    encoded: DataFrame               # features assembled, target, keys, split label
    metrics: DataFrame               # one row per model
    report: dict = field(default_factory=dict)
    corr: list = field(default_factory=list)      # [(var_a, var_b, r)] full matrix
    models: dict = field(default_factory=dict)
    trend: DataFrame | None = None


def _q(c: str):
    return F.col(f"`{c}`")


def _lap(report: dict, stage: str) -> None:
    """Record seconds spent since the previous lap under ``report['timings']``."""
    now = time.perf_counter()
    t = report.setdefault("timings", {})
    last = report.get("_t", now)
    t[stage] = round(now - last, 3)
    report["_t"] = now


def _prepare(raw: DataFrame, cfg: PipelineConfig, report: dict,
             keep_text: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], DataFrame]:
    """Passes A and B; returns the de-duplicated text frame, the categoricals
    and the frame before de-duplication (for reports that do not need it)."""
    if cfg.target not in raw.columns:
        raise ValueError(f"target column {cfg.target!r} not in input")
    df = replace_null_tokens(raw, cfg.null_token)
    df = df.drop(*cfg.forbidden)
    report["forbidden_dropped"] = [c for c in cfg.forbidden if c in raw.columns]
    if cfg.materialize:
        # land the text input once as Parquet: the profile passes and the
        # de-duplication then read columnar files instead of re-parsing text
        df, path = materialize_at(df, "landed", ROWS_PER_FILE)
        report.setdefault("staged_paths", []).append(path)

    # pass A: NULL profile + zero count of the target
    t = _q(cfg.target)
    num = tolerant_int(t) if dict(df.dtypes)[cfg.target] == "string" else t
    _lap(report, "land")
    prof_a = profile_columns(df, ("n_null", "pct_null"),
                             extra={"n_zero": F.count_if(num == 0)}).collect()
    _lap(report, "profile_a")
    report["n_rows"] = prof_a[0].n_rows if prof_a else 0
    report["n_zero_target"] = prof_a[0].n_zero if prof_a else 0
    report["null_pct"] = {r.column_name: r.pct_null for r in prof_a}
    sparse = [r.column_name for r in prof_a
              if r.pct_null is not None and r.pct_null > cfg.sparse_threshold_pct
              and r.column_name != cfg.target and r.column_name not in cfg.key_columns]
    report["sparse_dropped"] = sparse
    df = drop_null_rows(df.drop(*sparse))

    # pass B: constancy and letters
    prof_b = constant_and_letters(df)
    _lap(report, "profile_b")
    report["n_rows_after_dropna"] = prof_b[0].n_rows if prof_b else 0
    report["dropped_null_rows"] = report["n_rows"] - report["n_rows_after_dropna"]
    protected = {cfg.target, *cfg.key_columns}
    constants = [r.column_name for r in prof_b if r.is_constant and r.column_name not in protected]
    report["constant_dropped"] = constants
    df = df.drop(*constants)
    letters = [r.column_name for r in sorted(prof_b, key=lambda r: r.position)
               if r.has_letters and r.column_name not in constants
               and r.column_name not in protected]
    if cfg.categorical is None:
        cats = [c for c in letters if c not in cfg.exclude_categorical]
    else:
        cats = [c for c in cfg.categorical if c in df.columns]
    report["categorical"] = cats
    # a text column that is not encoded goes whole: its cast would cost rows
    unencoded = [c for c in letters if c not in cats and c not in keep_text]
    report["unencoded_dropped"] = unencoded
    df = df.drop(*unencoded)
    return df.dropDuplicates(), cats, df


def _finish(df: DataFrame, cats: list[str], cfg: PipelineConfig, report: dict,
            typed: tuple[str, ...] = (), match_flags: tuple[str, ...] = ()) -> DataFrame:
    """Cast, clock flag, materialise, pass C; returns the clean typed frame.

    ``typed`` columns are already numeric (lookup coordinates) and keep their
    type; ``match_flags`` mark rows that found their lookup row (left join),
    so unmatched rows are counted and then removed, as an inner join would.
    """
    df = cast_numeric(df, cats, keep=tuple(cfg.key_columns) + tuple(typed) + tuple(match_flags))
    times = [c for c in cfg.time_columns if c in df.columns]
    flag = F.lit(True)
    for c in times:
        flag = flag & F.coalesce(valid_clock(_q(c), cfg.strict_times), F.lit(False))
    matched = F.lit(True)
    for c in match_flags:
        matched = matched & F.coalesce(_q(c), F.lit(False))
    extra = []
    if cfg.split_key:
        # the hash split depends on the row key only: store it with the rows
        # so later passes read a column instead of re-hashing every row
        extra.append(split_label(cfg.split_key, cfg.split_weights, cfg.seed).alias(SPLIT_COL))
    df = df.select(*[hhmm_to_minutes(_q(c)).alias(c) if c in times else _q(c)
                     for c in df.columns if c not in match_flags],
                   flag.alias(VALID_FLAG), matched.alias(MATCH_FLAG), *extra)
    if cfg.materialize:
        df, path = materialize_at(df, "clean", ROWS_PER_FILE)
        report.setdefault("staged_paths", []).append(path)
    _lap(report, "dedupe_cast_materialize")

    # pass C (one aggregate): rows after dedupe, unmatched rows, bad clock
    # rows and NULLs the cast created among the kept rows; with a bound on
    # categories, also the approximate cardinality of each categorical
    keep = _q(VALID_FLAG) & _q(MATCH_FLAG)
    data_cols = [c for c in df.columns if c not in (VALID_FLAG, MATCH_FLAG, SPLIT_COL)]
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(keep).alias("n_keep"),
            F.count_if(~_q(MATCH_FLAG)).alias("unmatched"),
            F.count_if(_q(MATCH_FLAG) & ~_q(VALID_FLAG)).alias("bad_time")]
    aggs += [F.count_if(keep & _q(c).isNull()).alias(f"z__{i}") for i, c in enumerate(data_cols)]
    if cfg.max_categories is not None:
        aggs += [F.approx_count_distinct(F.when(keep, _q(c))).alias(f"k__{i}")
                 for i, c in enumerate(cats)]
    r = df.agg(*aggs).first()
    _lap(report, "profile_c")
    if cfg.max_categories is not None:
        over = {c: r[f"k__{i}"] for i, c in enumerate(cats) if r[f"k__{i}"] > cfg.max_categories}
        if over:
            raise ValueError(f"categorical columns above max_categories={cfg.max_categories}: "
                             f"{over}")
    report["n_rows_after_dedupe"] = r.n
    report["n_rows_kept"] = r.n_keep
    report["duplicates"] = report["n_rows_after_dropna"] - r.n
    report["rows_without_lookup"] = r.unmatched
    report["invalid_time_rows"] = r.bad_time
    nulls = {c: r[f"z__{i}"] for i, c in enumerate(data_cols)}
    all_null = [c for c, z in nulls.items() if r.n_keep and z == r.n_keep and c != cfg.target]
    report["cast_all_null_dropped"] = all_null
    report["cast_null_columns"] = {c: z for c, z in nulls.items() if z}
    if not r.n_keep:
        raise ValueError("no rows left after cleaning (input rows: "
                         f"{report.get('n_rows')}, after NULL-row drop: "
                         f"{report.get('n_rows_after_dropna')}, after dedupe: {r.n})")
    some_null = [c for c, z in nulls.items() if z and c not in all_null]
    lost = 0
    if some_null:
        lost = df.filter(keep & reduce(lambda a, b: a | b,
                                       [_q(c).isNull() for c in some_null])).count()
    report["rows_dropped_by_cast"] = lost
    if lost and cfg.on_cast_loss == "raise":
        raise ValueError(f"the numeric cast makes NULLs in {lost} of {r.n_keep} rows (columns "
                         f"{some_null}); drop or clean these columns, or set on_cast_loss='drop'")
    return drop_null_rows(df.filter(keep).drop(VALID_FLAG, MATCH_FLAG, *all_null))


def _model_stage(clean: DataFrame, cats: list[str], cfg: PipelineConfig,
                 report: dict) -> PipelineResult:
    if SPLIT_COL in clean.columns:
        labelled = clean
    else:
        parts = random_split(clean, cfg.split_weights, cfg.seed)
        labelled = parts[0].withColumn(SPLIT_COL, F.lit(0))
        for i, p in enumerate(parts[1:], start=1):
            labelled = labelled.unionByName(p.withColumn(SPLIT_COL, F.lit(i)))
    fit_frame = labelled.filter(_q(SPLIT_COL) == 0) if cfg.fit_on == "train" else labelled

    # categorical encoding, fitted once for all categorical columns
    handle = "keep" if cfg.fit_on == "train" else "error"
    encoded, enc_model, labels = encode_categoricals(
        labelled, cats, fit_df=fit_frame, handle_invalid=handle,
        max_categories=None)  # cardinality already checked in pass C
    report["categories"] = {c: len(v) for c, v in labels.items()}

    _lap(report, "encode_fit")
    # pass D: correlation of all numeric columns (incl. target) + min/max on
    # the fit side, one keyed aggregate over the column pairs
    keys = set(cfg.key_columns) | {SPLIT_COL}
    numeric = [c for c in clean.columns if c not in cats and c not in keys]
    clean = clean.drop(SPLIT_COL)
    is_fit = (_q(SPLIT_COL) == 0) if cfg.fit_on == "train" else F.lit(True)
    moments = pair_moments(labelled, numeric, bounds_where=is_fit).collect()
    _lap(report, "pass_d")
    corr, bounds_all = [], {}
    for m in moments:
        a, b = numeric[m.pos_a], numeric[m.pos_b]
        if a == b:
            bounds_all[a] = (m.min_a, m.max_a)
            continue
        den = ((m.var_a or 0.0) * (m.var_b or 0.0)) ** 0.5
        r = float("nan") if den == 0 or m.cov is None else m.cov / den
        corr.append((a, b, r))
    corr.sort(key=lambda t: (numeric.index(t[0]), numeric.index(t[1])))
    high = [(a, b, r) for a, b, r in corr if r == r and abs(r) > HIGH_CORR_THRESHOLD]
    report["high_corr_before"] = high
    drop = [c for c in cfg.correlated_drop if c in numeric]
    if cfg.auto_correlated:
        for a, b, _ in high:
            if a not in drop and b not in drop and b != cfg.target:
                drop.append(b)
    report["correlated_dropped"] = drop
    report["high_corr_after"] = [(a, b, r) for a, b, r in high if a not in drop and b not in drop]

    # min-max scaling of the remaining numeric predictors, bounds from pass D
    predictors = [c for c in numeric if c != cfg.target and c not in drop]
    bounds = {c: bounds_all[c] for c in predictors}
    scaled = encoded.select(
        *[_q(c) for c in cfg.key_columns], _q(SPLIT_COL), _q(cfg.target).cast("double").alias(cfg.target),
        *[_q(c) for c in cats],
        *[scale_expr(c, *bounds[c]).alias(c + SCALED_SUFFIX) for c in predictors])
    features = list(cats) + [c + SCALED_SUFFIX for c in predictors]
    report["features"] = features
    modeling = assemble(scaled, features, "features").select(
        *cfg.key_columns, SPLIT_COL, "features", cfg.target)
    if cfg.materialize and cfg.models and report["n_rows_kept"] > STAGE_FEATURE_ROWS:
        # every fit and score reads the features: they are encoded and assembled once
        modeling, path = materialize_at(modeling, "modeling", ROWS_PER_FILE)
        report["staged_features"] = path
        _lap(report, "assemble")

    train = modeling.filter(_q(SPLIT_COL) == 0)
    test = modeling.filter(_q(SPLIT_COL) == 1)
    models, metrics = {}, None
    for kind in cfg.models:
        if kind == "linear":
            model = fit_linear(train, cfg.target, prediction=cfg.prediction)
        elif kind == "forest":
            model = fit_forest(train, cfg.target, prediction=cfg.prediction,
                               num_trees=cfg.forest_trees, seed=cfg.seed)
        else:
            raise ValueError(f"unknown model {kind!r}")
        models[kind] = model
        _lap(report, f"fit_{kind}")
        m = regression_metrics(model.transform(test), cfg.target, cfg.prediction)
        m = m.select(F.lit(kind).alias("model"), "*")
        metrics = m if metrics is None else metrics.unionByName(m)
    models["encoding"] = enc_model
    full_corr = [(a, b, r) for a, b, r in corr] + [(b, a, r) for a, b, r in corr]
    trend_df = trend(clean, cfg.target, cfg.trend_by) if any(
        c in clean.columns for c in cfg.trend_by) else None
    report.pop("_t", None)
    return PipelineResult(clean=clean, encoded=modeling, metrics=metrics, report=report,
                          corr=full_corr, models=models, trend=trend_df)


def run_categorical(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> PipelineResult:
    """Places stay categories: every detected categorical is one-hot encoded."""
    report: dict = {"pipeline": "categorical", "_t": time.perf_counter()}
    deduped, cats, _ = _prepare(raw, cfg, report)
    clean = _finish(deduped, cats, cfg, report)
    return _model_stage(clean, cats, cfg, report)


def run_numeric(raw: DataFrame, dim: DataFrame,
                cfg: PipelineConfig = PipelineConfig(categorical=("UniqueCarrier",))) -> PipelineResult:
    """Places become coordinates through one lookup join per role; only the
    fixed categorical list (the carrier) is one-hot encoded, or, without a
    list, the detected categoricals that are no places."""
    report: dict = {"pipeline": "numeric", "_t": time.perf_counter()}
    deduped, cats, before_dedupe = _prepare(raw, cfg, report, keep_text=tuple(cfg.roles))
    # counted as the rows flow into the joins, which a repeated key multiplies
    counted = Observation()
    deduped = deduped.observe(counted, F.count(F.lit(1)).alias("n"))
    roles = {c: p for c, p in cfg.roles.items() if c in deduped.columns}
    cast = tolerant_double if cfg.coordinate_kind == "double" else tolerant_int
    types = dict(dim.dtypes)
    slim_dim = dim.select(cfg.dim_key, *[
        (cast(F.col(a)) if types[a] == "string" else F.col(a).cast(cfg.coordinate_kind)).alias(a)
        for a in cfg.dim_attrs])
    # the set of key values does not change with de-duplication: read the
    # (columnar, landed) rows before it, so the dedupe shuffle runs only once
    missing = missing_keys(before_dedupe, slim_dim, cfg.dim_key, list(roles))
    report["missing_keys"] = missing            # lazy; may be large
    report["n_missing_keys"] = missing.count()
    _lap(report, "missing_keys")
    report["dim_duplicate_keys"] = duplicate_keys(slim_dim, cfg.dim_key).count()
    # left join + a found flag per role: the inner join's row loss is applied
    # after materialisation, so the de-duplicated count stays observable
    attrs = {**cfg.dim_attrs, FOUND: FOUND}
    joined = role_join(deduped, slim_dim.withColumn(FOUND, F.lit(True)), cfg.dim_key, roles,
                       attrs, how="left", unique_keys=cfg.unique_dim_keys,
                       salt_buckets=cfg.join_salt_buckets)
    added = tuple(f"{p}{s}" for p in roles.values() for s in cfg.dim_attrs.values())
    flags = tuple(f"{p}{FOUND}" for p in roles.values())
    cats = [c for c in cats if c not in roles]
    clean = _finish(joined, cats, cfg, report, typed=added, match_flags=flags)
    report["n_rows_after_joins"] = report["n_rows_after_dedupe"]
    report["n_rows_after_dedupe"] = counted.get["n"]
    report["duplicates"] = report["n_rows_after_dropna"] - report["n_rows_after_dedupe"]
    return _model_stage(clean, cats, cfg, report)

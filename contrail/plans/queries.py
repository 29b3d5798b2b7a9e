"""The registered query set: one Spark query per operator, plus its SQL oracle.

Every query reads the driver's tables (through the ``trips`` view or
directly) in full, and returns a DataFrame whose column names match the
oracle's. Doubles that depend on summation order are rounded (6 places;
4 for model outputs) on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.clean import (
    cast_columns,
    drop_columns,
    drop_constant_columns,
    drop_null_rows,
    drop_sparse_columns,
    filter_valid_times,
    replace_null_tokens,
    times_to_minutes,
)
from contrail.operators.certificates import (
    elastic_net_certificate,
    fitted_models,
    forest_table,
    training_moments,
)
from contrail.operators.dedupe import dedupe_by_hash
from contrail.operators.enrich import missing_key_count, missing_keys, role_join
from contrail.operators.features import (
    INDEX_SUFFIX,
    ONEHOT_SUFFIX,
    assemble,
    encode_categoricals,
    explode_vector,
    min_max_scale,
    model_pipeline,
    string_index,
)
from contrail.operators.model_store import (
    differing_rows,
    load_model,
    save_model,
    score_both,
)
from contrail.operators.models import (
    coefficients_frame,
    fit_forest,
    fit_linear,
    grid_search,
    regression_metrics,
)
from contrail.operators.profile import (
    categorical_profile,
    category_counts,
    distinct_profile,
    duplicate_count,
    null_profile,
    zero_count,
)
from contrail.operators.profile_state import (
    load_states,
    merge_states,
    outside_error,
    profile_state,
    store_state,
)
from contrail.operators.ranking import string_index_table
from contrail.operators.split import fold_column, hash_bucket, random_split, split_label
from contrail.operators.stats import (
    corr_matrix,
    drop_correlated,
    high_corr_columns,
    high_corr_pairs,
    trend,
)
from contrail.operators.wide_corr import corr_wide
from contrail.plans.config import TRIPS_CONFIG
from contrail.plans.derived import csv_line, wide_columns
from contrail.plans.flows import run_categorical, run_numeric
from contrail.session import ROWS_PER_FILE, materialize, staging_path
from contrail.sources.files import merge_inputs, scan_csv, scan_dimension
from contrail.sources.rejects import scan_csv_checked
from contrail.sources.sinks import preview, write_parquet
from contrail.sources.tables import TRIPS_COLUMNS, load_table, spread_table, trips, trips_text

Query = Callable[[SparkSession, str], DataFrame]

NUMERIC = ("yr", "mo", "dep_hhmm", "arr_hhmm", "distance", "elapsed", "delay")
PLACES = ("carrier", "origin", "dest")
TIMES = ("dep_hhmm", "arr_hhmm")
LR_FEATURES = ("distance", "mo")
#: Columns that the index as a table is built for: few categories, and one a row.
INDEXED = (*PLACES, "row_key")


def _r(c, places: int = 6):
    return F.round(c, places)


# ---------------------------------------------------------------- stages

def _clean(spark, d):
    return replace_null_tokens(trips_text(spark, d))


def _no_null_rows(spark, d):
    return drop_null_rows(drop_sparse_columns(_clean(spark, d)))


def _staged_rows(spark, d):
    """The complete rows, from staged ones: their profile and what follows read files, the joins
    run once."""
    return drop_null_rows(drop_sparse_columns(_staged_clean(spark, d)))


def _no_constants(spark, d):
    return drop_constant_columns(_staged_rows(spark, d))


def _typed(spark, d):
    return cast_columns(_clean(spark, d), NUMERIC, "int")


def _split_typed(spark, d):
    typed = _typed(spark, d).select("row_key", *LR_FEATURES, "delay")
    return typed.withColumn("_split", split_label(["row_key"], (0.8, 0.2), 123))


def _lr_parts(spark, d):
    df = materialize(_lr_input(spark, d), "lr-input", ROWS_PER_FILE)
    return df.filter("_split = 0"), df.filter("_split = 1")


def _lr_input(spark, d):
    return assemble(_split_typed(spark, d), list(LR_FEATURES), "features")


def _folds(spark, d):
    train = _lr_input(spark, d).filter("_split = 0")  # grid_search stages it
    return train.withColumn("fold", fold_column(["row_key"], 3, 123))


# ---------------------------------------------------------------- sources

def q_csv_scan(spark, d):
    path = staging_path(spark, "csv")
    trips_text(spark, d).write.option("header", True).csv(path)
    return scan_csv(spark, path).select(*TRIPS_COLUMNS)


def q_dimension_scan(spark, d):
    path = staging_path(spark, "dimension")
    load_table(spark, d, "nation").write.option("header", True).csv(path)
    return scan_dimension(spark, path, ["n_name", "n_nationkey"])


def q_merge_inputs(spark, d):
    t = trips(spark, d)
    early = t.filter("yr <= 1995")
    late = t.filter("yr > 1995 OR yr IS NULL").select(*reversed(t.columns))
    text = lambda df: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return merge_inputs([text(early), text(late)])


def q_preview_first(spark, d):
    return preview(_clean(spark, d), 20, by=["row_key"])


def q_csv_rejects(spark, d):
    """Customers as CSV lines of which some are short, long, badly quoted, or well quoted."""
    path, columns = staging_path(spark, "csv"), ["custkey", "name", "segment"]
    load_table(spark, d, "customer").select(F.expr(csv_line()).alias("line")).write.text(path)
    rows, rejects = scan_csv_checked(spark, path, columns, header=False)
    return rows.select(F.lit("ok").alias("reason"), F.concat_ws("|", *columns).alias(
        "record")).unionAll(rejects.select("reason", "record"))


def q_sink_round_trip(spark, d):
    """Rows partitioned by year, one year written again, and what is there then."""
    path = staging_path(spark, "sink")
    rows = _typed(spark, d).select("yr", "row_key", "delay")
    write_parquet(rows, path, partition_by=["yr"])
    again = rows.filter("yr = 1995").withColumn("delay", F.col("delay") + 1000)
    write_parquet(again, path, partition_by=["yr"], dynamic=True)
    return spark.read.parquet(path).groupBy("yr").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("delay").alias("sum_delay"))


# ---------------------------------------------------------------- cleaning

def q_null_token(spark, d):
    return _clean(spark, d)


def q_drop_columns(spark, d):
    return drop_columns(_clean(spark, d), ["sparse_col", "const_col", "no_such_column"])


def q_drop_sparse(spark, d):
    return drop_sparse_columns(_clean(spark, d))


def q_drop_sparse_labels(spark, d):
    docs = load_table(spark, d, "documents").join(load_table(spark, d, "labels"), "doc_id", "left")
    return drop_sparse_columns(docs)


def q_drop_null_rows(spark, d):
    return _no_null_rows(spark, d)


def q_dropped_row_count(spark, d):
    df = drop_sparse_columns(_clean(spark, d))
    complete = F.lit(True)
    for c in df.columns:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_before"),
                  F.count_if(complete).alias("n_after")).withColumn(
        "n_dropped", F.col("n_before") - F.col("n_after"))


def q_drop_constant(spark, d):
    return _no_constants(spark, d)


def _delivered_twice(spark, d):
    once = _clean(spark, d)
    return merge_inputs([once, once])


def q_dedupe(spark, d):
    return _delivered_twice(spark, d).dropDuplicates()


def q_dedupe_by_hash(spark, d):
    return dedupe_by_hash(_delivered_twice(spark, d))


def q_duplicate_count(spark, d):
    return duplicate_count(_delivered_twice(spark, d))


def q_tolerant_int(spark, d):
    li = spread_table(spark, d, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag"])
    text = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("string").alias("qty"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_discount").cast("string").alias("discount"),
        (F.col("l_extendedprice") * 100000).cast("decimal(20,2)").cast("string").alias("big"),
        F.col("l_returnflag").alias("flag"),
        F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")).alias("mixed"),
        # text that a double cast reads as a number, and an int cast does not
        F.concat(F.col("l_linenumber").cast("string"),
                 F.element_at(F.array(*map(F.lit, ("D", "f", "e3", ".", ""))),
                              (F.col("l_linenumber") % 5 + 1).cast("int"))).alias("suffixed"),
    )
    return cast_columns(text, ["qty", "price", "discount", "big", "flag", "mixed", "suffixed"],
                        "int")


def q_valid_time(spark, d):
    df = cast_columns(_clean(spark, d).select("row_key", *TIMES), TIMES, "int")
    return filter_valid_times(df, TIMES)


def q_hhmm_to_minutes(spark, d):
    return times_to_minutes(q_valid_time(spark, d), TIMES)


# ---------------------------------------------------------------- profiles

def q_null_profile(spark, d):
    return null_profile(_clean(spark, d)).withColumn("pct_null", _r(F.col("pct_null")))


def _staged_clean(spark, d):
    """The rows staged once, where several passes read them."""
    return materialize(_clean(spark, d), "rows", ROWS_PER_FILE)


def _states(spark, rows):
    """Stored states of two inputs, one of them delivered again."""
    path = staging_path(spark, "states")
    late = "yr > '1995' OR yr IS NULL"
    for name, where in (("early", "yr <= '1995'"), ("late", "yr IS NULL"), ("late", late)):
        store_state(profile_state(rows.filter(where), name), path)
    return load_states(spark, path)


def q_profile_merge(spark, d):
    merged = merge_states(_states(spark, _staged_clean(spark, d))).withColumn("pct_null", _r(F.col("pct_null")))
    return merged.drop("n_distinct")


def q_distinct_sketch(spark, d):
    """The united sketches' estimates beside the exact counts: none may miss by more than the
    sketch's error."""
    rows = _staged_clean(spark, d)
    merged = merge_states(_states(spark, rows)).select(
        "column_name", F.col("n_distinct").alias("e"))
    exact = distinct_profile(rows)
    return exact.join(merged, "column_name").select(
        "column_name", "position", "n_distinct",
        outside_error(F.col("e"), F.col("n_distinct")).alias("outside_error"))


def q_zero_count(spark, d):
    return zero_count(_clean(spark, d), "delay")


def q_distinct_profile(spark, d):
    return distinct_profile(_clean(spark, d))


def q_detect_categorical(spark, d):
    return categorical_profile(_no_constants(spark, d))


def q_category_counts(spark, d):
    return category_counts(_no_null_rows(spark, d), list(PLACES))


def q_row_counts(spark, d):
    """Rows per stage in two passes: (raw, complete rows) in one aggregate,
    then (de-duplicated, valid clock) in one aggregate over one dedupe."""
    from contrail.functions.casts import tolerant_int
    from contrail.functions.clock import valid_clock
    clean = drop_sparse_columns(_clean(spark, d))
    complete = F.lit(True)
    for c in clean.columns:
        complete = complete & F.col(c).isNotNull()
    first = clean.agg(F.count(F.lit(1)).alias("raw"), F.count_if(complete).alias("after_dropna"))
    valid = F.lit(True)
    for t in TIMES:
        valid = valid & F.coalesce(valid_clock(tolerant_int(F.col(t))), F.lit(False))
    second = (drop_null_rows(clean).dropDuplicates()
              .agg(F.count(F.lit(1)).alias("after_dedupe"),
                   F.count_if(valid).alias("after_valid_time")))
    unpivot = lambda df: df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("stage"), F.col(c).alias("n_rows")) for c in df.columns])))
    return unpivot(first).union(unpivot(second))


# ---------------------------------------------------------------- lookups

def q_role_join(spark, d):
    return role_join(_no_null_rows(spark, d), load_table(spark, d, "nation"), "n_name",
                     {"origin": "origin", "dest": "dest"},
                     {"n_nationkey": "_nationkey", "n_regionkey": "_regionkey"})


def q_missing_keys(spark, d):
    return missing_keys(load_table(spark, d, "documents"), load_table(spark, d, "labels"),
                        "doc_id", ["doc_id"])


def q_missing_key_count(spark, d):
    return missing_key_count(load_table(spark, d, "documents"), load_table(spark, d, "labels"),
                             "doc_id", ["doc_id"])


# ---------------------------------------------------------------- statistics

def q_trend(spark, d):
    return trend(_typed(spark, d), "delay", ("yr", "mo")).withColumn("avg", _r(F.col("avg")))


def q_trend_fallback(spark, d):
    return trend(_typed(spark, d).drop("yr"), "delay", ("yr", "mo")).withColumn(
        "avg", _r(F.col("avg")))


def _corr(spark, d):
    return corr_matrix(_typed(spark, d), list(NUMERIC))


def q_corr_matrix_nulls(spark, d):
    """Pairwise deletion: ``sparse_col`` is NULL in many rows."""
    cols = ("sparse_col", "distance", "elapsed", "delay")
    typed = cast_columns(_clean(spark, d).select(*cols), cols, "int")
    return corr_matrix(typed, cols).withColumn("corr", _r(F.col("corr")))


def q_corr_matrix(spark, d):
    return _corr(spark, d).withColumn("corr", _r(F.col("corr")))


def q_high_corr_pairs(spark, d):
    return high_corr_pairs(_corr(spark, d)).withColumn("corr", _r(F.col("corr")))


def q_high_corr_columns(spark, d):
    return high_corr_columns(_corr(spark, d))


def q_drop_correlated(spark, d):
    typed = _typed(spark, d)
    return drop_correlated(typed, auto=True, candidates=list(NUMERIC), keep=["delay"])


def q_corr_wide(spark, d):
    columns = wide_columns()
    rows = spread_table(spark, d, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])
    wide = rows.select(*[F.expr(v).alias(c) for c, v in columns.items()])
    return corr_wide(wide, list(columns)).withColumn("corr", _r(F.col("corr")))


# ---------------------------------------------------------------- features

def _index_long(df, cols, value_suffix=INDEX_SUFFIX):
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                        F.col(c + value_suffix).alias("idx")) for c in cols]
    return df.select(F.inline(F.array(*entries)))


def q_string_index(spark, d):
    indexed, _ = string_index(_staged_rows(spark, d), list(PLACES))
    return (_index_long(indexed, PLACES).groupBy("column_name", "value", "idx")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_string_index_table(spark, d):
    """The index without labels on the driver, also of a column with a category a row."""
    indexed, _ = string_index_table(_staged_rows(spark, d).select(*INDEXED), INDEXED)
    return (_index_long(indexed, INDEXED).groupBy("column_name", "value", "idx")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_one_hot(spark, d):
    from pyspark.ml.functions import vector_to_array
    base = _staged_rows(spark, d)
    _, model, _ = encode_categoricals(base, list(PLACES), rename=False)
    # keep the text and index next to the vector to report the mapping
    enc = model.transform(base)
    entries = []
    for c in PLACES:
        arr = vector_to_array(F.col(c + ONEHOT_SUFFIX))
        pos = F.array_position(arr, F.lit(1.0))
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.col(c).alias("value"),
            F.col(c + INDEX_SUFFIX).alias("idx"), F.size(arr).alias("vec_size"),
            F.when(pos > 0, (pos - 1).cast("int")).alias("hot_pos")))
    return (enc.select(F.inline(F.array(*entries)))
            .groupBy("column_name", "value", "idx", "vec_size", "hot_pos")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_assemble(spark, d):
    df = assemble(_typed(spark, d), ["distance", "elapsed", "mo"], "features")
    return explode_vector(df, "features", ["row_key"])


def q_min_max_scale(spark, d):
    typed = _typed(spark, d).select("row_key", "yr", "mo", "distance", "elapsed")
    scaled, _ = min_max_scale(typed, ["yr", "mo", "distance", "elapsed"])
    return scaled.select("row_key", *[_r(F.col(c)).alias(c) for c in scaled.columns
                                      if c.endswith("_Scaled")])


def q_hash_split(spark, d):
    return trips(spark, d).select(
        "row_key", hash_bucket(["row_key"], 123).alias("bucket"),
        (split_label(["row_key"], (0.8, 0.2), 123) == 0).alias("is_train"))


def q_random_split(spark, d):
    # staged: both sides must draw over the same rows in the same partitions
    rows = materialize(trips(spark, d).select("row_key", "delay"), "split-input")
    train, test = random_split(rows, (0.8, 0.2), 123)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))


def q_random_split_check(spark, d):
    """Every row is on exactly one side; which one, the oracle cannot tell."""
    n = q_random_split(spark, d).groupBy("row_key").agg(
        F.count("*").alias("n"), F.count_distinct("side").alias("sides"))
    return n.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("sides") > 1).alias("n_overlap"))


# ---------------------------------------------------------------- models

def q_lr_coefficients(spark, d):
    train, _ = _lr_parts(spark, d)
    model = fit_linear(train, "delay")
    coef = coefficients_frame(spark, model, list(LR_FEATURES))
    return coef.withColumn("value", _r(F.col("value"), 4))


def q_lr_predict(spark, d):
    train, test = _lr_parts(spark, d)
    model = fit_linear(train, "delay")
    return model.transform(test).select("row_key", _r(F.col("prediction"), 4).alias("prediction"))


def q_regression_metrics(spark, d):
    train, test = _lr_parts(spark, d)
    model = fit_linear(train, "delay")
    m = regression_metrics(model.transform(test), "delay")
    return m.select("n", *[_r(F.col(c), 4).alias(c) for c in ("rmse", "mse", "mae", "r2", "var")])


def q_rf_predict(spark, d):
    train, test = _lr_parts(spark, d)
    model = fit_forest(train, "delay", num_trees=100, seed=123)
    return model.transform(test).select("row_key", "prediction")


def q_rf_bounds(spark, d):
    """Predicted rows, and those outside the training labels' range (a mean of labels is in
    it). The oracle proves the rows and the range, not the trees."""
    train, test = _lr_parts(spark, d)
    low, high = train.agg(F.min("delay"), F.max("delay")).first()
    predicted = fit_forest(train, "delay", num_trees=100, seed=123).transform(test)
    return predicted.agg(F.count("*").alias("n_rows"), F.count_if(
        ~F.col("prediction").between(low, high)).alias("n_outside"))


def q_cv_grid(spark, d):
    _, table = grid_search(_folds(spark, d), "delay", fold_col="fold", parallelism=9)
    return table


def q_cv_ridge(spark, d):
    """The grid's points without an L1 part, which have a closed form."""
    _, table = grid_search(_folds(spark, d), "delay", fold_col="fold", parallelism=3,
                           elastic_net=(0.0,))
    return table.select("regParam", _r(F.col("avg_rmse"), 4).alias("avg_rmse"), "is_best")


def q_cv_certificate(spark, d):
    """All nine grid points: the average error, and the terms of their 27 fits that miss the
    optimality conditions of the elastic net."""
    folds = materialize(_folds(spark, d).select("features", *LR_FEATURES, "delay", "fold"),
                        "cv-input", ROWS_PER_FILE)
    model, table = grid_search(folds, "delay", fold_col="fold", parallelism=9, stage=False,
                               keep_models=True)
    moments = training_moments(folds, "delay", LR_FEATURES, "fold", 3)
    proof = elastic_net_certificate(moments, fitted_models(spark, model), LR_FEATURES)
    point = ["regParam", "elasticNetParam"]
    found = proof.groupBy(*point).agg(F.count_distinct("fold").alias("n_fits"),
                                      F.count_if("violated").alias("n_violations"))
    return table.join(found, point).select(*point, _r(F.col("avg_rmse"), 4).alias("avg_rmse"),
                                           "is_best", "n_fits", "n_violations")


def q_rf_stump(spark, d):
    """One tree of depth 1 on all rows and features: its split is the best there is."""
    train, _ = _lr_parts(spark, d)
    forest = fit_forest(train, "delay", num_trees=1, seed=123, bootstrap=False, maxDepth=1,
                        maxBins=64, featureSubsetStrategy="all")
    nodes = forest_table(spark, forest, LR_FEATURES)
    mean = lambda n: _r(F.max(F.when(F.col("node") == n, F.col("prediction"))), 4)
    return nodes.agg(F.max("feature").alias("feature"), F.max("threshold").alias("threshold"),
                     mean(2).alias("left_mean"), mean(3).alias("right_mean"))


def _ml_parts(spark, d):
    """The training and test rows that the ML pipeline is fitted and scored on, staged."""
    typed = _no_null_rows(spark, d)
    typed = materialize(cast_columns(
        typed, [c for c in NUMERIC if c in typed.columns], "int").withColumn(
        "_split", split_label(["row_key"], (0.8, 0.2), 123)), "ml-input")
    return typed.filter("_split = 0"), typed.filter("_split = 1")


def q_model_round_trip(spark, d):
    """The fitted pipeline stored in the shared folder, loaded and compared row by row."""
    from pyspark.ml.regression import LinearRegression
    train, test = _ml_parts(spark, d)
    lr = LinearRegression(featuresCol="features", labelCol="delay")
    model = model_pipeline(list(PLACES), ["yr", "mo", "distance"], lr).fit(train)
    again = load_model(save_model(spark, model))
    return differing_rows(score_both(test, model, again, "row_key"))


def q_ml_stages(spark, d):
    from pyspark.ml.regression import LinearRegression
    train, test = _ml_parts(spark, d)
    lr = LinearRegression(featuresCol="features", labelCol="delay")
    pipe = model_pipeline(list(PLACES), ["yr", "mo", "distance"], lr)
    model = pipe.fit(train)
    return regression_metrics(model.transform(test), "delay")


def q_categorical_flow(spark, d):
    return run_categorical(trips_text(spark, d), TRIPS_CONFIG).metrics


def q_numeric_flow(spark, d):
    cfg = TRIPS_CONFIG.with_(categorical=("carrier",))
    return run_numeric(trips_text(spark, d), load_table(spark, d, "nation"), cfg).metrics


def _report_rows(spark, report, extra):
    """(item, n, columns): the counts of a flow's report and its dropped columns."""
    counts = ("n_rows", "dropped_null_rows", "n_rows_after_dedupe", "duplicates",
              "rows_without_lookup", "invalid_time_rows", "rows_dropped_by_cast")
    drops = ("sparse_dropped", "constant_dropped", "unencoded_dropped", "correlated_dropped")
    rows = [(c, int(report[c]), "") for c in counts] + [(c, int(n), "") for c, n in extra]
    rows += [(c, len(report[c]), ",".join(sorted(report[c]))) for c in drops]
    return spark.createDataFrame(rows, "item string, n bigint, columns string")


def _raw_twice(spark, d):
    once = trips_text(spark, d)
    return merge_inputs([once, once])


def q_categorical_flow_report(spark, d):
    """The flow's decisions and row counts over rows delivered twice; no model is fitted
    here, as ``categorical_flow`` fits both."""
    res = run_categorical(_raw_twice(spark, d), TRIPS_CONFIG.with_(models=()))
    return _report_rows(spark, res.report, [("n_rows_clean", res.clean.count())])


def q_numeric_flow_report(spark, d):
    """The same for the numeric flow, with a dimension whose region 0 is listed twice."""
    dim = load_table(spark, d, "nation")
    dim = dim.unionByName(dim.filter("n_regionkey = 0"))
    res = run_numeric(_raw_twice(spark, d), dim,
                      TRIPS_CONFIG.with_(categorical=("carrier",), models=()))
    return _report_rows(spark, res.report, [
        ("n_rows_clean", res.clean.count()), ("n_missing_keys", res.report["n_missing_keys"]),
        ("dim_duplicate_keys", res.report["dim_duplicate_keys"]),
        ("n_rows_after_joins", res.report["n_rows_after_joins"])])


QUERIES: dict[str, Query] = {
    "csv_scan": q_csv_scan,
    "dimension_scan": q_dimension_scan,
    "merge_inputs": q_merge_inputs,
    "preview_first": q_preview_first,
    "csv_rejects": q_csv_rejects,
    "sink_round_trip": q_sink_round_trip,
    "null_token": q_null_token,
    "drop_columns": q_drop_columns,
    "zero_count": q_zero_count,
    "null_profile": q_null_profile,
    "drop_sparse": q_drop_sparse,
    "drop_sparse_labels": q_drop_sparse_labels,
    "drop_null_rows": q_drop_null_rows,
    "dropped_row_count": q_dropped_row_count,
    "drop_constant": q_drop_constant,
    "distinct_profile": q_distinct_profile,
    "profile_merge": q_profile_merge,
    "distinct_sketch": q_distinct_sketch,
    "dedupe": q_dedupe,
    "dedupe_by_hash": q_dedupe_by_hash,
    "duplicate_count": q_duplicate_count,
    "detect_categorical": q_detect_categorical,
    "category_counts": q_category_counts,
    "row_counts": q_row_counts,
    "tolerant_int": q_tolerant_int,
    "valid_time": q_valid_time,
    "hhmm_to_minutes": q_hhmm_to_minutes,
    "role_join": q_role_join,
    "missing_keys": q_missing_keys,
    "missing_key_count": q_missing_key_count,
    "trend": q_trend,
    "trend_fallback": q_trend_fallback,
    "corr_matrix": q_corr_matrix,
    "corr_matrix_nulls": q_corr_matrix_nulls,
    "corr_wide": q_corr_wide,
    "high_corr_pairs": q_high_corr_pairs,
    "high_corr_columns": q_high_corr_columns,
    "drop_correlated": q_drop_correlated,
    "string_index": q_string_index,
    "string_index_table": q_string_index_table,
    "one_hot": q_one_hot,
    "assemble": q_assemble,
    "min_max_scale": q_min_max_scale,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "random_split_check": q_random_split_check,
    "lr_coefficients": q_lr_coefficients,
    "lr_predict": q_lr_predict,
    "regression_metrics": q_regression_metrics,
    "rf_predict": q_rf_predict,
    "rf_bounds": q_rf_bounds,
    "rf_stump": q_rf_stump,
    "cv_grid": q_cv_grid,
    "cv_ridge": q_cv_ridge,
    "cv_certificate": q_cv_certificate,
    "model_round_trip": q_model_round_trip,
    "ml_stages": q_ml_stages,
    "categorical_flow": q_categorical_flow,
    "numeric_flow": q_numeric_flow,
    "categorical_flow_report": q_categorical_flow_report,
    "numeric_flow_report": q_numeric_flow_report,
}

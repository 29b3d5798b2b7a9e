"""DuckDB SQL oracles for the registered queries (same column names as Spark).

The ``trips`` text is the FIXTURES.md §3 view. Shared stages are CTEs; each
oracle pulls in the ones it needs.
"""

from __future__ import annotations

from contrail.plans.derived import csv_line, wide_columns

TRIPS_COLUMNS = ("yr", "mo", "row_key", "carrier", "origin", "dest", "dep_hhmm",
                 "arr_hhmm", "sparse_col", "const_col", "distance", "elapsed", "delay")
NUMERIC = ("yr", "mo", "dep_hhmm", "arr_hhmm", "distance", "elapsed", "delay")
PLACES = ("carrier", "origin", "dest")
TIMES = ("dep_hhmm", "arr_hhmm")

TRIPS_SQL = """
SELECT CAST(extract(year FROM o_orderdate) AS INT) AS yr,
  CAST(extract(month FROM o_orderdate) AS INT) AS mo,
  concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key,
  CASE WHEN l_linenumber = 7 AND l_quantity > 40 THEN 'NA' ELSE o_orderpriority END AS carrier,
  nc.n_name AS origin, ns.n_name AS dest,
  CAST((l_orderkey * 37 + l_partkey * 11) % 2500 AS VARCHAR(10)) AS dep_hhmm,
  CAST((l_suppkey * 53 + l_orderkey * 17) % 2400 AS VARCHAR(10)) AS arr_hhmm,
  CASE WHEN l_linenumber <= 3 THEN 'NA'
       ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR(10)) END AS sparse_col,
  'K' AS const_col,
  CAST(l_quantity AS INT) AS distance,
  CAST(l_quantity AS INT) * 2 + l_linenumber AS elapsed,
  CAST((l_orderkey * 7 + l_partkey * 3) % 61 AS INT) - 10 + CAST(l_quantity AS INT) AS delay
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation nc ON c_nationkey = nc.n_nationkey
JOIN nation ns ON s_nationkey = ns.n_nationkey
"""


def tol_int(x: str) -> str:
    d = f"try_cast({x} AS DOUBLE)"
    plain = f"regexp_full_match({x}, '\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)\\s*')"
    return (f"CASE WHEN {plain} AND {d} > -2147483649 AND {d} < 2147483648 "
            f"THEN CAST(trunc({d}) AS INTEGER) END")


def minutes(h: str) -> str:
    return f"CAST(floor({h} / 100.0) * 60 + (({h} % 100) + 100) % 100 AS INTEGER)"


def _cols(cols, exclude=()) -> str:
    return ", ".join(c for c in cols if c not in exclude)


def _all_not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


NO_NULL_COLS = tuple(c for c in TRIPS_COLUMNS if c != "sparse_col")
NO_CONST_COLS = tuple(c for c in NO_NULL_COLS if c != "const_col")

CTES = {
    "trips": TRIPS_SQL,
    "trips_text": "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TRIPS_COLUMNS)
                  + " FROM trips",
    "trips_clean": "SELECT " + ", ".join(f"nullif({c}, 'NA') AS {c}" for c in TRIPS_COLUMNS)
                   + " FROM trips_text",
    "no_null_rows": f"SELECT {_cols(NO_NULL_COLS)} FROM trips_clean "
                    f"WHERE {_all_not_null(NO_NULL_COLS)}",
    "no_constants": f"SELECT {_cols(NO_CONST_COLS)} FROM no_null_rows",
    "typed": "SELECT " + ", ".join(tol_int(c) + f" AS {c}" if c in NUMERIC else c
                                   for c in TRIPS_COLUMNS) + " FROM trips_clean",
    "split_typed": ("SELECT row_key, distance, mo, delay, "
                    "('0x' || substr(md5('123|' || row_key), 1, 7))::BIGINT < 0.8 * 268435456 "
                    "AS is_train FROM typed"),
    "lr_fit": ("SELECT *, avg_y - b1 * avg_x1 - b2 * avg_x2 AS b0 FROM ("
               "SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, "
               "(s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, avg_x1, avg_x2, avg_y "
               "FROM (SELECT var_pop(distance) AS s11, var_pop(mo) AS s22, "
               "covar_pop(distance, mo) AS s12, covar_pop(distance, delay) AS s1y, "
               "covar_pop(mo, delay) AS s2y, avg(distance) AS avg_x1, avg(mo) AS avg_x2, "
               "avg(delay) AS avg_y FROM split_typed WHERE is_train))"),
    "lr_pred": ("SELECT row_key, delay, b0 + b1 * distance + b2 * mo AS prediction "
                "FROM split_typed, lr_fit WHERE NOT is_train"),
    "twice": "SELECT * FROM trips_clean UNION ALL SELECT * FROM trips_clean",
}
ORDER = list(CTES)
DEPS = {
    "trips_text": ["trips"], "trips_clean": ["trips_text"], "no_null_rows": ["trips_clean"],
    "no_constants": ["no_null_rows"], "typed": ["trips_clean"], "split_typed": ["typed"],
    "lr_fit": ["split_typed"], "lr_pred": ["lr_fit", "split_typed"], "twice": ["trips_clean"],
}


def with_(needs: list[str], body: str) -> str:
    need: set[str] = set()

    def visit(n):
        if n not in need:
            need.add(n)
            for m in DEPS.get(n, []):
                visit(m)
    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n]})" for n in ORDER if n in need]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _profile_union(source: str, cols, select_fn) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {i} AS position, {select_fn(c)} FROM {source}"
        for i, c in enumerate(cols))


def _corr_pairs(cols=NUMERIC, source: str = "typed") -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            src = "" if i == j else f" FROM {source}"
            val = "1.0" if i == j else f"corr({a}, {b})"
            parts.append(f"SELECT '{a}' AS var_a, {i} AS pos_a, '{b}' AS var_b, {j} AS pos_b, "
                         f"CAST({val} AS DOUBLE) AS corr{src}")
    return "\nUNION ALL\n".join(parts)


def _index_counts(source: str, cols=PLACES) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n_rows FROM {source} GROUP BY {c}"
        for c in cols)
    return (f"SELECT column_name, value, CAST(row_number() OVER (PARTITION BY column_name "
            f"ORDER BY n_rows DESC, value) - 1 AS DOUBLE) AS idx, n_rows FROM ({counts})")


# Ridge regression of Spark ML by its closed form: predictors and label standardised by their
# population deviation, the penalty divided by the label's deviation; 3 folds by hash.
RIDGE = """
SELECT regParam, round(avg(rmse), 4) AS avg_rmse,
       avg(rmse) = min(avg(rmse)) OVER () AS is_best FROM (
  SELECT regParam, fold, sqrt(avg((m.avg_y + b1 * (t.distance - m.avg_x1)
                                   + b2 * (t.mo - m.avg_x2) - t.delay) ^ 2)) AS rmse
  FROM (
    SELECT regParam, f AS fold, avg_x1, avg_x2, avg_y,
      ((s22 + l * s22) * s1y - s12 * s2y) / ((s11 + l * s11) * (s22 + l * s22) - s12 * s12) AS b1,
      ((s11 + l * s11) * s2y - s12 * s1y) / ((s11 + l * s11) * (s22 + l * s22) - s12 * s12) AS b2
    FROM (
      SELECT *, regParam / sqrt(syy) AS l FROM (
        SELECT f, var_pop(distance) AS s11, var_pop(mo) AS s22, var_pop(delay) AS syy,
          covar_pop(distance, mo) AS s12, covar_pop(distance, delay) AS s1y,
          covar_pop(mo, delay) AS s2y, avg(distance) AS avg_x1, avg(mo) AS avg_x2,
          avg(delay) AS avg_y
        FROM folds, range(3) r(f) WHERE fold <> f GROUP BY f),
      (SELECT unnest([0.01, 0.1, 0.5])::DOUBLE AS regParam))
  ) m JOIN folds t USING (fold) GROUP BY regParam, fold
) GROUP BY regParam
""".replace("folds", "(SELECT *, (('0x' || substr(md5('124|' || row_key), 1, 7))::BIGINT % 10000) "
            "% 3 AS fold FROM split_typed WHERE is_train)")


# The elastic net in two variables: of the nine patterns of signs the one whose closed form has
# those signs, and whose zero coefficients meet |covariance with the residual| <= penalty.
ELASTIC_NET = """
SELECT regParam, elasticNetParam, round(avg(rmse), 4) AS avg_rmse,
       avg(rmse) = min(avg(rmse)) OVER () AS is_best,
       CAST(3 AS BIGINT) AS n_fits, CAST(0 AS BIGINT) AS n_violations FROM (
  SELECT regParam, elasticNetParam, fold, sqrt(avg((avg_y + b1 * sy / s1 * (t.distance - avg_x1)
           + b2 * sy / s2 * (t.mo - avg_x2) - t.delay) ^ 2)) AS rmse
  FROM (
    SELECT regParam, elasticNetParam, fold, any_value(b1) AS b1, any_value(b2) AS b2,
      any_value(s1) AS s1, any_value(s2) AS s2, any_value(sy) AS sy, any_value(avg_x1) AS avg_x1,
      any_value(avg_x2) AS avg_x2, any_value(avg_y) AS avg_y
    FROM (
      SELECT *, CASE WHEN e1 = 0 THEN 0 WHEN e2 = 0 THEN (c1 - l1 * e1) / d
                ELSE (d * (c1 - l1 * e1) - r * (c2 - l1 * e2)) / (d * d - r * r) END AS b1,
             CASE WHEN e2 = 0 THEN 0 WHEN e1 = 0 THEN (c2 - l1 * e2) / d
                ELSE (d * (c2 - l1 * e2) - r * (c1 - l1 * e1)) / (d * d - r * r) END AS b2
      FROM (
        SELECT *, regParam / sy * elasticNetParam AS l1,
               1 + regParam / sy * (1 - elasticNetParam) AS d
        FROM (
          SELECT f AS fold, stddev_pop(distance) AS s1, stddev_pop(mo) AS s2,
            stddev_pop(delay) AS sy, corr(distance, mo) AS r, corr(distance, delay) AS c1,
            corr(mo, delay) AS c2, avg(distance) AS avg_x1, avg(mo) AS avg_x2,
            avg(delay) AS avg_y
          FROM folds, range(3) r(f) WHERE fold <> f GROUP BY f),
        (SELECT unnest([0.01, 0.1, 0.5])::DOUBLE AS regParam),
        (SELECT unnest([0.0, 0.5, 1.0])::DOUBLE AS elasticNetParam)),
      (SELECT unnest([-1, 0, 1]) AS e1), (SELECT unnest([-1, 0, 1]) AS e2))
    WHERE sign(b1) = e1 AND sign(b2) = e2
      AND (e1 <> 0 OR abs(c1 - r * b2) <= l1) AND (e2 <> 0 OR abs(c2 - r * b1) <= l1)
    GROUP BY regParam, elasticNetParam, fold
  ) m JOIN folds t USING (fold) GROUP BY regParam, elasticNetParam, fold
) GROUP BY regParam, elasticNetParam
""".replace("folds", "(SELECT *, (('0x' || substr(md5('124|' || row_key), 1, 7))::BIGINT % 10000) "
            "% 3 AS fold FROM split_typed WHERE is_train)")

# The split of the least squared error: sums up to each distinct value of a feature, the
# threshold half way to the next.
STUMP = """
SELECT feature, threshold, round(sl / nl, 4) AS left_mean,
       round((s - sl) / (n - nl), 4) AS right_mean FROM (
  SELECT feature, (v + lead(v) OVER along) / 2.0 AS threshold,
    sum(n) OVER along AS nl, sum(s) OVER along AS sl,
    sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
  FROM (SELECT 'distance' AS feature, distance AS v, count(*)::DOUBLE AS n, sum(delay)::DOUBLE AS s
        FROM split_typed WHERE is_train GROUP BY distance
        UNION ALL SELECT 'mo', mo, count(*)::DOUBLE, sum(delay)::DOUBLE
        FROM split_typed WHERE is_train GROUP BY mo)
  WINDOW along AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)
) WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1
"""


def _corr_wide(columns: dict[str, str]) -> str:
    """Both triangles and the diagonal, from one aggregate of all pairs."""
    names = list(columns)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    lists = {"i": (i for i, _ in pairs), "j": (j for _, j in pairs),
             "r": (f"corr({names[i]}, {names[j]})" for i, j in pairs)}
    one = ", ".join(f"unnest([{', '.join(map(str, v))}]) AS {k}" for k, v in lists.items())
    wide = "SELECT " + ", ".join(f"{v} AS {c}" for c, v in columns.items()) + " FROM lineitem"
    return (f"WITH p AS (SELECT {one} FROM ({wide})) "
            "SELECT 'c' || i AS var_a, i AS pos_a, 'c' || j AS var_b, j AS pos_b, round(r, 6) AS corr "
            "FROM (SELECT i, j, r FROM p UNION ALL SELECT j, i, r FROM p UNION ALL "
            f"SELECT k, k, 1.0 FROM (SELECT unnest(generate_series(0, {len(names) - 1}))::INT AS k))")


def _listed(columns, source: str, when) -> str:
    """The names of the columns for which the aggregate ``when(c)`` holds over ``source``, sorted."""
    cases = ", ".join(f"CASE WHEN {when(c)} THEN '{c}' END" for c in sorted(columns))
    return f"(SELECT concat_ws(',', {cases}) FROM {source})"


def _flow_report(numeric: bool) -> str:
    """Counts and dropped columns of a flow over rows delivered twice, all from the rows: only the
    list of correlated columns is a setting, in the flow as here."""
    clean = f"SELECT DISTINCT {_cols(NO_CONST_COLS)} FROM no_null_rows"
    kept = " AND ".join(f"NOT ({tol_int(t)} > 2359)" for t in TIMES)
    # a place of region 0 is listed twice, so its rows are doubled, once a role
    dim = "(SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey = 0)"
    joins = (f" LEFT JOIN {dim} o ON c.origin = o.n_name LEFT JOIN {dim} e ON c.dest = e.n_name"
             if numeric else "")
    met = "o.n_name IS NOT NULL AND e.n_name IS NOT NULL" if numeric else "true"
    total = lambda where: f"(SELECT count(*) FROM ({clean}) c{joins} WHERE {where})"
    lost = " OR ".join(f"{tol_int('c.' + c)} IS NULL" for c in NUMERIC)
    n, complete = "(SELECT 2 * count(*) FROM trips_clean)", "(SELECT 2 * count(*) FROM no_null_rows)"
    distinct = f"(SELECT count(*) FROM ({clean}))"
    items = {"n_rows": n, "dropped_null_rows": f"{n} - {complete}",
             "n_rows_after_dedupe": distinct, "duplicates": f"{complete} - {distinct}",
             "rows_without_lookup": total(f"NOT ({met})"),
             "invalid_time_rows": total(f"{met} AND NOT ({kept})"),
             "rows_dropped_by_cast": total(f"{met} AND {kept} AND ({lost})"),
             "n_rows_clean": total(f"{met} AND {kept} AND NOT ({lost})")}
    if numeric:
        keys = "SELECT origin FROM no_null_rows UNION SELECT dest FROM no_null_rows"
        items |= {"n_missing_keys": f"(SELECT count(*) FROM ({keys} EXCEPT SELECT n_name FROM nation))",
                  "n_rows_after_joins": total(met),
                  "dim_duplicate_keys": "(SELECT count(*) FROM nation WHERE n_regionkey = 0)"}
    free = [c for c in TRIPS_COLUMNS if c not in ("row_key", "delay")]  # neither key nor target
    complete_free = [c for c in free if c in NO_NULL_COLS]
    encoded = ("carrier", "origin", "dest")  # all that hold letters, or as the numeric flow names them
    drops = {
        "sparse_dropped": _listed(free, "trips_clean", lambda c: f"count({c}) < 0.75 * count(*)"),
        "constant_dropped": _listed(complete_free, "no_null_rows",
                                    lambda c: f"count(DISTINCT {c}) = 1"),
        "unencoded_dropped": _listed(
            [c for c in complete_free if c not in encoded], "no_null_rows",
            lambda c: f"count(DISTINCT {c}) > 1 AND bool_or(regexp_matches({c}, '\\p{{L}}'))"),
        "correlated_dropped": "'elapsed'"}
    rows = [f"SELECT '{k}' AS item, CAST({v} AS BIGINT) AS n, '' AS columns"
            for k, v in items.items()]
    rows += [f"SELECT '{k}', len(string_split(nullif({v}, ''), ',')), {v}" if v[0] == "(" else
             f"SELECT '{k}', 1, {v}" for k, v in drops.items()]
    return ("SELECT item, CAST(coalesce(n, 0) AS BIGINT) AS n, columns FROM ("
            + "\nUNION ALL\n".join(rows) + ")")


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    all_cols = _cols(TRIPS_COLUMNS)
    q["csv_scan"] = with_(["trips_text"], f"SELECT {all_cols} FROM trips_text")
    q["dimension_scan"] = ("SELECT n_name, CAST(n_nationkey AS VARCHAR) AS n_nationkey "
                           "FROM nation")
    q["merge_inputs"] = with_(["trips_text"], f"SELECT {all_cols} FROM trips_text")
    q["null_token"] = with_(["trips_clean"], f"SELECT {all_cols} FROM trips_clean")
    q["drop_columns"] = with_(["trips_clean"],
                              f"SELECT {_cols(TRIPS_COLUMNS, ('sparse_col', 'const_col'))} "
                              "FROM trips_clean")
    q["zero_count"] = with_(["trips_clean"],
                            "SELECT count(*) FILTER (WHERE try_cast(delay AS DOUBLE) = 0) AS n_zero, "
                            "count(*) AS n_rows FROM trips_clean")
    q["null_profile"] = with_(["trips_clean"], _profile_union(
        "trips_clean", TRIPS_COLUMNS,
        lambda c: (f"count(*) AS n_rows, count(*) - count({c}) AS n_null, "
                   f"round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 6) AS pct_null")))
    q["drop_sparse"] = with_(["trips_clean"],
                             f"SELECT {_cols(NO_NULL_COLS)} FROM trips_clean")
    q["drop_sparse_labels"] = ("SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars "
                               "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
    q["drop_null_rows"] = with_(["no_null_rows"], f"SELECT {_cols(NO_NULL_COLS)} FROM no_null_rows")
    q["dropped_row_count"] = with_(["trips_clean"], (
        f"SELECT count(*) AS n_before, count(*) FILTER (WHERE {_all_not_null(NO_NULL_COLS)}) "
        f"AS n_after, count(*) - count(*) FILTER (WHERE {_all_not_null(NO_NULL_COLS)}) "
        "AS n_dropped FROM trips_clean"))
    q["drop_constant"] = with_(["no_constants"], f"SELECT {_cols(NO_CONST_COLS)} FROM no_constants")
    q["distinct_profile"] = with_(["trips_clean"], _profile_union(
        "trips_clean", TRIPS_COLUMNS,
        lambda c: f"count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct"))
    q["dedupe"] = with_(["twice"], f"SELECT DISTINCT {all_cols} FROM twice")
    q["duplicate_count"] = with_(["twice"], (
        f"SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {all_cols} FROM twice)) "
        f"AS n_distinct, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {all_cols} FROM twice)) "
        "AS n_duplicates FROM twice"))
    q["detect_categorical"] = with_(["no_constants"], _profile_union(
        "no_constants", NO_CONST_COLS,
        lambda c: f"coalesce(bool_or(regexp_matches({c}, '\\p{{L}}')), false) AS is_categorical"))
    q["category_counts"] = with_(["no_constants"], "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {NO_CONST_COLS.index(c)} AS position, "
        f"count(DISTINCT {c}) AS n_categories FROM no_constants" for c in PLACES))
    valid = " AND ".join(f"NOT ({tol_int(t)} > 2359)" for t in TIMES)
    q["row_counts"] = with_(["no_null_rows"], (
        "SELECT 'raw' AS stage, count(*) AS n_rows FROM trips_clean UNION ALL "
        "SELECT 'after_dropna', count(*) FROM no_null_rows UNION ALL "
        f"SELECT 'after_dedupe', count(*) FROM (SELECT DISTINCT {_cols(NO_NULL_COLS)} "
        "FROM no_null_rows) UNION ALL "
        f"SELECT 'after_valid_time', count(*) FROM (SELECT DISTINCT {_cols(NO_NULL_COLS)} "
        f"FROM no_null_rows) WHERE {valid}"))
    q["tolerant_int"] = (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
        + ", ".join(f"{tol_int(e)} AS {n}" for n, e in (
            ("qty", "CAST(l_quantity AS VARCHAR)"), ("price", "CAST(l_extendedprice AS VARCHAR)"),
            ("discount", "CAST(l_discount AS VARCHAR)"),
            ("big", "CAST(CAST(l_extendedprice * 100000 AS DECIMAL(20,2)) AS VARCHAR)"), ("flag", "l_returnflag"),
            ("mixed", "l_returnflag || CAST(l_linenumber AS VARCHAR)"),
            ("suffixed", "(CAST(l_linenumber AS VARCHAR) || "
                         "(['D', 'f', 'e3', '.', ''])[l_linenumber % 5 + 1])")))
        + " FROM lineitem")
    timed = ("SELECT row_key, " + ", ".join(f"{tol_int(t)} AS {t}" for t in TIMES)
             + " FROM trips_clean")
    q["valid_time"] = with_(["trips_clean"], (
        f"SELECT row_key, dep_hhmm, arr_hhmm FROM ({timed}) "
        "WHERE NOT (dep_hhmm > 2359) AND NOT (arr_hhmm > 2359)"))
    q["hhmm_to_minutes"] = with_(["trips_clean"], (
        f"SELECT row_key, {minutes('dep_hhmm')} AS dep_hhmm, {minutes('arr_hhmm')} AS arr_hhmm "
        f"FROM ({timed}) WHERE NOT (dep_hhmm > 2359) AND NOT (arr_hhmm > 2359)"))
    fact = _cols(NO_NULL_COLS, ("origin", "dest"))
    q["role_join"] = with_(["no_null_rows"], (
        f"SELECT {', '.join('t.' + c for c in fact.split(', '))}, "
        "o.n_nationkey AS origin_nationkey, o.n_regionkey AS origin_regionkey, "
        "d.n_nationkey AS dest_nationkey, d.n_regionkey AS dest_regionkey "
        "FROM no_null_rows t JOIN nation o ON t.origin = o.n_name "
        "JOIN nation d ON t.dest = d.n_name"))
    missing = "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels"
    q["missing_keys"] = missing
    q["missing_key_count"] = f"SELECT count(*) AS n_missing FROM ({missing})"
    q["trend"] = with_(["typed"], "SELECT yr, round(avg(delay), 6) AS avg, count(*) AS n_rows "
                                  "FROM typed GROUP BY yr")
    q["trend_fallback"] = with_(["typed"], "SELECT mo, round(avg(delay), 6) AS avg, "
                                           "count(*) AS n_rows FROM typed GROUP BY mo")
    pairs = _corr_pairs()
    q["corr_matrix"] = with_(["typed"], f"SELECT var_a, pos_a, var_b, pos_b, round(corr, 6) AS corr "
                                        f"FROM ({pairs})")
    high = (f"SELECT * FROM ({pairs}) WHERE pos_a < pos_b AND corr IS NOT NULL "
            "AND NOT isnan(corr) AND abs(corr) > 0.9")
    sparse = ("sparse_col", "distance", "elapsed", "delay")
    q["corr_matrix_nulls"] = with_(["trips_clean"], (
        f"SELECT var_a, pos_a, var_b, pos_b, round(corr, 6) AS corr FROM ({_corr_pairs(sparse, 't')})"
    ).replace("FROM t", "FROM (SELECT " + ", ".join(f"{tol_int(c)} AS {c}" for c in sparse)
              + " FROM trips_clean)"))
    q["high_corr_pairs"] = with_(["typed"], f"SELECT var_a, pos_a, var_b, pos_b, "
                                            f"round(corr, 6) AS corr FROM ({high})")
    q["high_corr_columns"] = with_(["typed"], (
        f"SELECT var_a AS column_name, pos_a AS position FROM ({high}) UNION "
        f"SELECT var_b, pos_b FROM ({high})"))
    q["drop_correlated"] = with_(["typed"], f"SELECT {_cols(TRIPS_COLUMNS, ('elapsed',))} FROM typed")
    q["string_index"] = with_(["no_null_rows"], _index_counts("no_null_rows"))
    q["preview_first"] = with_(["trips_clean"], (
        f"SELECT {all_cols} FROM trips_clean ORDER BY row_key LIMIT 20"))
    q["csv_rejects"] = (
        "SELECT CASE c_custkey % 11 WHEN 3 THEN 'short' WHEN 5 THEN 'long' WHEN 7 THEN 'quote' "
        "ELSE 'ok' END AS reason, CASE WHEN c_custkey % 11 IN (3, 5, 7) THEN " + csv_line()
        + " ELSE concat_ws('|', c_custkey, CASE WHEN c_custkey % 11 = 9 THEN c_name || ', Inc.' "
          "ELSE c_name END, c_mktsegment) END AS record FROM customer")
    q["sink_round_trip"] = with_(["typed"], (
        "SELECT yr, count(*) AS n_rows, CAST(sum(delay + CASE WHEN yr = 1995 THEN 1000 ELSE 0 END) "
        "AS BIGINT) AS sum_delay FROM typed GROUP BY yr"))
    q["dedupe_by_hash"] = q["dedupe"]
    q["profile_merge"] = with_(["trips_clean"], _profile_union(
        "trips_clean", TRIPS_COLUMNS,
        lambda c: (f"count(*) AS n_rows, count(*) - count({c}) AS n_null, "
                   f"round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 6) AS pct_null, "
                   f"min({c}) AS low, max({c}) AS high")))
    q["distinct_sketch"] = with_(["trips_clean"], _profile_union(
        "trips_clean", TRIPS_COLUMNS,
        lambda c: f"count(DISTINCT {c}) AS n_distinct, false AS outside_error"))
    q["string_index_table"] = with_(["no_null_rows"], _index_counts(
        "no_null_rows", (*PLACES, "row_key")))
    q["corr_wide"] = _corr_wide(wide_columns())
    q["rf_stump"] = with_(["split_typed"], STUMP)
    q["cv_certificate"] = with_(["split_typed"], ELASTIC_NET)
    q["model_round_trip"] = with_(["no_null_rows"], (
        "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differing, CAST(0 AS BIGINT) AS n_null "
        "FROM no_null_rows WHERE "
        "('0x' || substr(md5('123|' || row_key), 1, 7))::BIGINT >= 0.8 * 268435456"))
    q["one_hot"] = with_(["no_null_rows"], (
        "SELECT column_name, value, idx, CAST(k - 1 AS INTEGER) AS vec_size, "
        "CASE WHEN idx < k - 1 THEN CAST(idx AS INTEGER) END AS hot_pos, n_rows FROM ("
        "SELECT *, count(*) OVER (PARTITION BY column_name) AS k FROM ("
        + _index_counts("no_null_rows") + "))"))
    q["assemble"] = with_(["typed"], " UNION ALL ".join(
        f"SELECT row_key, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM typed"
        for i, c in enumerate(("distance", "elapsed", "mo"))))
    scaled = ["yr", "mo", "distance", "elapsed"]
    bounds = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in scaled)
    q["min_max_scale"] = with_(["typed"], (
        "SELECT row_key, " + ", ".join(
            f"round(CASE WHEN mx_{c} = mn_{c} THEN 0.5 ELSE CAST({c} - mn_{c} AS DOUBLE) / "
            f"(mx_{c} - mn_{c}) END, 6) AS {c}_Scaled" for c in scaled)
        + f" FROM typed, (SELECT {bounds} FROM typed)"))
    q["hash_split"] = with_(["trips"], (
        "SELECT row_key, ('0x' || substr(md5('123|' || row_key), 1, 7))::BIGINT % 10000 AS bucket, "
        "('0x' || substr(md5('123|' || row_key), 1, 7))::BIGINT < 0.8 * 268435456 AS is_train "
        "FROM trips"))
    q["lr_coefficients"] = with_(["lr_fit"], (
        "SELECT 'intercept' AS term, round(b0, 4) AS value FROM lr_fit UNION ALL "
        "SELECT 'distance', round(b1, 4) FROM lr_fit UNION ALL "
        "SELECT 'mo', round(b2, 4) FROM lr_fit"))
    q["lr_predict"] = with_(["lr_pred"], "SELECT row_key, round(prediction, 4) AS prediction "
                                         "FROM lr_pred")
    q["regression_metrics"] = with_(["lr_pred"], (
        "SELECT n, round(sqrt(mse), 4) AS rmse, round(mse, 4) AS mse, round(mae, 4) AS mae, "
        "round(1 - mse / var_y, 4) AS r2, round(var_p + (mean_p - mean_y) ^ 2, 4) AS var FROM ("
        "SELECT count(*) AS n, avg((prediction - delay) ^ 2) AS mse, "
        "avg(abs(prediction - delay)) AS mae, var_pop(delay) AS var_y, avg(delay) AS mean_y, "
        "var_pop(prediction) AS var_p, avg(prediction) AS mean_p FROM lr_pred)"))
    q["random_split_check"] = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_overlap FROM lineitem"
    q["rf_bounds"] = with_(["split_typed"], (
        "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM split_typed WHERE NOT is_train"))
    q["cv_ridge"] = with_(["split_typed"], RIDGE)
    q["categorical_flow_report"] = with_(["no_null_rows"], _flow_report(False))
    q["numeric_flow_report"] = with_(["no_null_rows"], _flow_report(True))
    return q

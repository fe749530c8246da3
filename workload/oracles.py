"""The queries of :mod:`workload.queries` in plain SQL."""

from __future__ import annotations

LINE_ORDER = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate"
)
CHARGE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
LOST = "(d % 7 = 3 OR d BETWEEN 9500 AND 9529)"
FORWARD = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BACKWARD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def day_number(column: str) -> str:
    return f"CAST({column}::DATE - DATE '1970-01-01' AS INTEGER)"


def carried(column: str, order: str, group: str = "") -> str:
    """Last known value up to, and first known value from, each row."""
    part = f"PARTITION BY {group} " if group else ""
    return (
        f"last_value({column} IGNORE NULLS) OVER ({part}ORDER BY {order} {FORWARD}) AS {column}_prev, "
        f"first_value({column} IGNORE NULLS) OVER ({part}ORDER BY {order} {BACKWARD}) AS {column}_next"
    )


def imputed(column: str, median: str = "NULL") -> str:
    return (
        f"coalesce({column}, ({column}_prev + {column}_next) / 2.0, "
        f"{column}_prev, {column}_next, {median})"
    )


def limits(column: str, source: str) -> str:
    """One row: quartiles and fences of a column."""
    return f"""SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
      SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source})"""


def capped(column: str, fence: str) -> str:
    return (
        f"CASE WHEN {column} < {fence}.low THEN {fence}.low "
        f"WHEN {column} > {fence}.high THEN {fence}.high ELSE {column} END"
    )


def outside(column: str, fence: str) -> str:
    return f"CAST({column} < {fence}.low OR {column} > {fence}.high AS INTEGER)"


# Least squares on three features by Cramer's rule.


def moments(source: str, xs: tuple[str, str, str], y: str, group: str = "") -> str:
    names = [*xs, y]
    parts = [f"avg({c}) AS m{i}" for i, c in enumerate(names, 1)]
    parts += [
        f"covar_pop({names[i]}, {names[j]}) AS s{i + 1}{j + 1}" for i in range(4) for j in range(i, 4)
    ]
    head, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"SELECT {head}count(*) AS n, {', '.join(parts)} FROM {source}{tail}"


def coefficients(source: str, extra: str = "") -> str:
    """b0..b3 from a row of moments."""
    det = "(s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13))"
    b1 = "(s14 * (s22 * s33 - s23 * s23) - s12 * (s24 * s33 - s23 * s34) + s13 * (s24 * s23 - s22 * s34))"
    b2 = "(s11 * (s24 * s33 - s23 * s34) - s14 * (s12 * s33 - s23 * s13) + s13 * (s12 * s34 - s24 * s13))"
    b3 = "(s11 * (s22 * s34 - s24 * s23) - s12 * (s12 * s34 - s24 * s13) + s14 * (s12 * s23 - s22 * s13))"
    return f"""SELECT *, m4 - b1 * m1 - b2 * m2 - b3 * m3 AS b0 FROM (
      SELECT {extra}m1, m2, m3, m4, {b1} / {det} AS b1, {b2} / {det} AS b2, {b3} / {det} AS b3
      FROM {source})"""


FIT = f"""lines AS (SELECT *, {CHARGE} AS charge FROM lineitem),
 moments AS ({moments("lines", ("l_extendedprice", "l_discount", "l_tax"), "charge")}),
 fit AS ({coefficients("moments")})"""

TERMS = """terms(position, term, coefficient) AS (
  SELECT 0, 'intercept', b0 FROM fit UNION ALL SELECT 1, 'l_extendedprice', b1 FROM fit
  UNION ALL SELECT 2, 'l_discount', b2 FROM fit UNION ALL SELECT 3, 'l_tax', b3 FROM fit)"""

RESIDUALS = """residuals AS (SELECT charge,
  b0 + b1 * l_extendedprice + b2 * l_discount + b3 * l_tax AS p FROM lines, fit),
 metrics AS (SELECT count(*) AS n, avg((charge - p) * (charge - p)) AS mse,
  1 - avg((charge - p) * (charge - p)) / var_pop(charge) AS r2 FROM residuals)"""

FOLDED = f"""folded AS (SELECT *, CAST(ntile(5) OVER (ORDER BY {LINE_ORDER}) - 1 AS INTEGER) AS fold FROM lines),
 others AS (SELECT f.k, x.* FROM range(5) f(k), folded x WHERE x.fold <> f.k),
 fold_moments AS ({moments("others", ("l_extendedprice", "l_discount", "l_tax"), "charge", "k")}),
 fold_fit AS ({coefficients("fold_moments", "k, ")}),
 fold_scores AS (SELECT fold, count(*) AS n, avg((charge - p) * (charge - p)) AS mse,
   1 - avg((charge - p) * (charge - p)) / var_pop(charge) AS r2
   FROM (SELECT fold, charge, b0 + b1 * l_extendedprice + b2 * l_discount + b3 * l_tax AS p
         FROM folded JOIN fold_fit ON fold = k) GROUP BY fold)"""

SHORT = """short AS (SELECT round(b0, 4) AS b0, round(b1, 4) AS b1, round(b2, 4) AS b2,
  round(b3, 4) AS b3 FROM fit)"""

# Series with gaps.

DAILY = f"""days AS (SELECT {day_number("o_orderdate")} AS d,
   sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS c FROM orders GROUP BY 1),
 known AS (SELECT d, CAST(c AS BIGINT) / 100.0 AS total FROM days WHERE NOT {LOST}),
 dense AS (SELECT CAST(s.d AS INTEGER) AS d, total, CAST(k.d IS NULL AS INTEGER) AS inserted
   FROM (SELECT unnest(generate_series(min(d), max(d))) AS d FROM known) s
   LEFT JOIN known k ON s.d = k.d)"""
DAY = "DATE '1970-01-01' + d AS day"

SERIES = f"""days AS (SELECT {day_number("o_orderdate")} AS d,
   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c, count(*) AS n
   FROM orders GROUP BY 1),
 raw AS (SELECT d, c, n FROM days UNION ALL SELECT d, c + 100, n FROM days WHERE d % 10 = 0),
 known AS (SELECT d, c / 100.0 AS total, CAST(n AS DOUBLE) AS orders FROM days WHERE NOT {LOST}),
 dense AS (SELECT CAST(s.d AS INTEGER) AS day, total, orders, CAST(k.d IS NULL AS INTEGER) AS inserted
   FROM (SELECT unnest(generate_series(min(d), max(d))) AS d FROM known) s
   LEFT JOIN known k ON s.d = k.d),
 seen AS (SELECT *, {carried("total", "day")}, {carried("orders", "day")} FROM dense),
 whole AS (SELECT day, {imputed("total")} AS total, {imputed("orders")} AS orders, inserted,
   CAST(total IS NULL AS INTEGER) AS imputed_total, CAST(orders IS NULL AS INTEGER) AS imputed_orders
   FROM seen),
 ft AS ({limits("total", "whole")}), fo AS ({limits("orders", "whole")}),
 cleaned AS (SELECT day, {capped("total", "ft")} AS total, {capped("orders", "fo")} AS orders,
   inserted, imputed_total, imputed_orders,
   {outside("total", "ft")} AS outlier_total, {outside("orders", "fo")} AS outlier_orders
   FROM whole, ft, fo)"""


def cleaned_rows(typed: str, rule: str, first: str, second: str, others: str) -> str:
    """Valid distinct rows with two columns capped and flagged."""
    return f"""WITH typed AS ({typed}), valid AS (SELECT DISTINCT * FROM typed WHERE {rule}),
     fa AS ({limits(first, "valid")}), fb AS ({limits(second, "valid")})
     SELECT round({capped(first, "fa")}, 4) AS {first}, round({capped(second, "fb")}, 4) AS {second},
       {others}, 0 AS imputado_{first}, 0 AS imputado_{second},
       {outside(first, "fa")} AS outlier_{first}, {outside(second, "fb")} AS outlier_{second}
     FROM valid, fa, fb"""


def imputed_rows(typed: str, rule: str, first: str, second: str, order: str, group: str) -> str:
    """As :func:`cleaned_rows`, with NULLs imputed in the group's order, ties by the figures."""
    whole = f"{order}, {first} NULLS FIRST, {second} NULLS FIRST"
    return f"""WITH typed AS ({typed}), valid AS (SELECT DISTINCT * FROM typed WHERE {rule}),
     seen AS (SELECT *, {carried(first, whole, group)}, {carried(second, whole, group)} FROM valid),
     filled AS (SELECT {order}, {group}, CAST({first} IS NULL AS INTEGER) AS i1, CAST({second} IS NULL AS INTEGER) AS i2,
       {imputed(first)} AS {first}, {imputed(second)} AS {second} FROM seen),
     fa AS ({limits(first, "filled")}), fb AS ({limits(second, "filled")})
     SELECT round({capped(first, "fa")}, 4) AS {first}, round({capped(second, "fb")}, 4) AS {second},
       {order}, {group}, i1 AS imputado_{first}, i2 AS imputado_{second},
       {outside(first, "fa")} AS outlier_{first}, {outside(second, "fb")} AS outlier_{second}
     FROM filled, fa, fb"""


def fence_row(column: str) -> str:
    return f"""SELECT '{column}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3,
      round(low, 4) AS low, round(high, 4) AS high FROM ({limits(column, "lineitem")})"""


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def description(column: str) -> str:
    quartile = ", ".join(
        f"round(quantile_cont({column}, {p}), 4) AS {name}"
        for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    )
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 4) AS mean,
      round(stddev_samp({column}), 4) AS std, round(CAST(min({column}) AS DOUBLE), 4) AS min,
      {quartile}, round(CAST(max({column}) AS DOUBLE), 4) AS max FROM customer"""


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "charge"]
FEATURES = ["l_extendedprice", "l_discount", "l_tax"]

NULLED = """SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN l_orderkey % 7 <> 0 THEN l_tax END AS l_tax,
  CASE WHEN l_orderkey % 7 <> 1 THEN l_quantity END AS l_quantity FROM lineitem"""

VALID_LINE = "l_quantity BETWEEN 1 AND 40 AND l_discount <= 0.08 AND l_orderkey IS NOT NULL"

FENCED_EVENTS = f"WITH f AS ({limits('value', 'events')})"

# Fit on the training lines and scores on the others.
SPLIT_FIT = f"""lines AS (SELECT *, {CHARGE} AS charge,
        CAST(substr(md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber) || ':42'), 1, 8)
          < '33333333' AS INTEGER) AS is_test FROM lineitem),
      train_lines AS (SELECT * FROM lines WHERE is_test = 0),
      train_moments AS ({moments("train_lines", tuple(FEATURES), "charge")}),
      fit AS ({coefficients("train_moments")}),
      residuals AS (SELECT charge, b0 + b1 * l_extendedprice + b2 * l_discount + b3 * l_tax AS p
        FROM lines, fit WHERE is_test = 1),
      metrics AS (SELECT count(*) AS n, avg((charge - p) * (charge - p)) AS mse,
        1 - avg((charge - p) * (charge - p)) / var_pop(charge) AS r2 FROM residuals)"""

METRIC_ROWS = union(
    [
        "SELECT 'train_rows' AS metric, CAST(n AS DOUBLE) AS value FROM train_moments",
        "SELECT 'test_rows', n FROM metrics",
        "SELECT 'intercept', b0 FROM fit",
        *[f"SELECT 'coefficient_{f}', b{i} FROM fit" for i, f in enumerate(FEATURES, 1)],
        "SELECT 'mse', mse FROM metrics",
        "SELECT 'rmse', sqrt(mse) FROM metrics",
        "SELECT 'r2', r2 FROM metrics",
        "SELECT 'fold_' || fold || '_mse', mse FROM fold_scores",
        "SELECT 'fold_' || fold || '_r2', r2 FROM fold_scores",
        "SELECT 'cv_mse', avg(mse) FROM fold_scores",
        "SELECT 'cv_r2', avg(r2) FROM fold_scores",
        *[f"SELECT 'correlation_{f}', corr({f}, charge) FROM lines" for f in FEATURES],
        *[f"SELECT 'trend_{f}', regr_slope(charge, {f}) FROM lines" for f in FEATURES],
        *[
            f"SELECT 'correlation_{a}_{b}', corr({a}, {b}) FROM lines"
            for a in [*FEATURES, "charge"]
            for b in [*FEATURES, "charge"]
            if a < b
        ],
        *[f"SELECT 'sign_{f}', sign(b{i}) FROM fit" for i, f in enumerate(FEATURES, 1)],
        "SELECT 'impact_rank_' || term, row_number() OVER (ORDER BY abs(c) DESC, term) FROM ("
        + union([f"SELECT '{f}' AS term, b{i} AS c FROM fit" for i, f in enumerate(FEATURES, 1)])
        + ")",
    ]
)

REQUESTS = """requests AS (SELECT o_orderkey AS request_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'dolar' WHEN 2 THEN 'energia' WHEN 3 THEN 'euro' ELSE 'glucosa' END AS exercise,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS v1,
  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 0.01
    ELSE (o_orderkey % 10) / 100.0 END AS v2,
  CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey % 8) / 100.0 END AS v3 FROM orders)"""

LABELS = """labels_(exercise, l1, l2, l3, title, target) AS (VALUES
  ('dolar', 'Dia', 'Inflacion', 'Tasa de interes', 'Prediccion del precio del dolar', 'precio_dolar'),
  ('glucosa', 'Edad', 'IMC', 'Actividad fisica', 'Prediccion del nivel de glucosa', 'nivel_glucosa'),
  ('energia', 'Temperatura', 'Hora', 'Dia de semana', 'Prediccion del consumo de energia electrica', 'consumo_energia'))"""

QUANTILE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]

def _but(share: int, odd: str | None, usual: str) -> str:
    return f"CASE WHEN o_orderkey % {share} = {share - 1} THEN {'NULL' if odd is None else repr(odd)} ELSE {usual} END"


_TEXTS = {
    "whole": _but(7, None, "' ' || o_orderkey"),
    "signed": _but(11, "+5", "'-' || o_orderkey"),
    "long": _but(13, "", "o_orderkey || '0000000000'"),
    "huge": _but(17, "-7", "'9' || o_orderkey || '00000000000000000000'"),
    "too_huge": _but(19, "1", "rpad(o_orderkey::VARCHAR, 45, '3')"),
    "price": _but(23, "1e-3", "printf('%d.%02d', c // 100, c % 100)"),
    "not_finite": _but(29, "NaN", "o_orderkey::VARCHAR"),
    "comma": "printf('%d,%02d', c // 100, c % 100)",
    "stray": _but(1000, "n/a", "o_orderkey::VARCHAR"),
    "day": _but(5, None, "strftime(o_orderdate, '%Y-%m-%d')"),
    "moment": _but(3, "2020-02-29T12:30:01.5", "strftime(o_orderdate, '%Y-%m-%d')"),
    "no_day": _but(900, "2021-02-29", "strftime(o_orderdate, '%Y-%m-%d')"),
    "yes": _but(2, " TRUE", "'false'"),
    "blank": _but(2, None, "'  '"),
    "mixed": _but(2, "true", "o_orderkey::VARCHAR"),
}
# The narrowest type that every value fits, asked for type by type.
INFERRED = (
    "WITH o AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders), texts AS ("
    + " UNION ALL ".join(f"SELECT {i} AS position, '{n}' AS name, nullif(trim({t}), '') AS t FROM o" for i, (n, t) in enumerate(_TEXTS.items()))
    + """),
    marked AS (SELECT *, regexp_full_match(t, '[+-]?\\d+') AS whole, length(ltrim(ltrim(t, '+-'), '0')) AS digits FROM texts)
    SELECT position, name AS "column", CASE
        WHEN count(t) = 0 THEN 'string'
        WHEN bool_and(whole) FILTER (WHERE t IS NOT NULL) AND bool_and(try_cast(t AS HUGEINT) IS NOT NULL AND try_cast(t AS HUGEINT) BETWEEN -2147483648 AND 2147483647) FILTER (WHERE t IS NOT NULL) THEN 'int'
        WHEN bool_and(whole) FILTER (WHERE t IS NOT NULL) AND bool_and(try_cast(t AS BIGINT) IS NOT NULL) FILTER (WHERE t IS NOT NULL) THEN 'bigint'
        WHEN bool_and(whole) FILTER (WHERE t IS NOT NULL) AND max(digits) <= 38 THEN 'decimal(' || max(digits) || ',0)'
        WHEN bool_and(regexp_full_match(t, '(?i)[+-]?((\\d+\\.?\\d*|\\.\\d+)(e[+-]?\\d+)?|inf|infinity|nan)')) FILTER (WHERE t IS NOT NULL) THEN 'double'
        WHEN bool_and(regexp_full_match(t, '\\d{4}-\\d{2}-\\d{2}') AND try_cast(t AS DATE) IS NOT NULL) FILTER (WHERE t IS NOT NULL) THEN 'date'
        WHEN bool_and(regexp_full_match(t, '\\d{4}-\\d{2}-\\d{2}([ T]\\d{2}:\\d{2}(:\\d{2}(\\.\\d+)?)?)?') AND try_cast(t AS TIMESTAMP) IS NOT NULL) FILTER (WHERE t IS NOT NULL) THEN 'timestamp'
        WHEN bool_and(lower(t) IN ('true', 'false')) FILTER (WHERE t IS NOT NULL) THEN 'boolean' ELSE 'string' END AS type,
      count(t) AS filled, count(*) - count(t) AS empty
    FROM marked GROUP BY position, name"""
)


ORACLES: dict[str, str] = {
    "scan_csv_roundtrip": "SELECT * FROM part",
    "csv_headers_many": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority
      FROM orders""",
    "infer_types": INFERRED,
    "sink_parquet_roundtrip": "SELECT * FROM part",
    "head_rows": """SELECT c_custkey, c_name, c_acctbal FROM customer
      ORDER BY c_acctbal DESC, c_custkey LIMIT 5""",
    "normalize_columns": """SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nation_key,
      c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
    "conform_schema": """SELECT CAST(c_custkey AS VARCHAR) AS custkey, trim(c_name) AS name,
      trim(c_mktsegment) AS segment, CAST(NULL AS VARCHAR) AS phone FROM customer""",
    "required_columns": """SELECT * FROM (
      SELECT 'l_orderkey' AS "column", TRUE AS present, count(l_orderkey) AS filled FROM lineitem
      UNION ALL SELECT 'l_quantity', TRUE, count(l_quantity) FROM lineitem
      UNION ALL SELECT 'l_comment', FALSE, 0
      UNION ALL SELECT 'l_tax', TRUE, count(l_tax) FROM lineitem
      UNION ALL SELECT 'l_weight', FALSE, 0)""",
    "parse_locale_numbers": """SELECT p_partkey,
      CASE WHEN p_partkey % 17 NOT IN (1, 2, 3) THEN round(p_retailprice, 4) END AS as_double,
      CASE WHEN p_partkey % 17 NOT IN (1, 2, 3) THEN CAST(trunc(p_retailprice) AS INTEGER) END AS as_int,
      CASE WHEN p_partkey % 17 = 4 THEN round(p_retailprice, 4) END AS as_number FROM part""",
    "validate_rules": f"""SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount
      FROM lineitem WHERE {VALID_LINE}""",
    "validate_counts": f"""SELECT count(*) AS typed_rows, count(*) FILTER ({VALID_LINE}) AS valid_rows,
      count(*) FILTER (NOT ({VALID_LINE})) AS invalid_rows FROM lineitem""",
    "drop_nulls": f"""SELECT * FROM ({NULLED}) WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL
      AND l_linenumber IS NOT NULL AND l_tax IS NOT NULL AND l_quantity IS NOT NULL""",
    "null_counts": union(
        [
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM ({NULLED})"
            for c in ("l_orderkey", "l_tax", "l_quantity")
        ]
    ),
    "key_bounds": "SELECT min(l_orderkey) AS min_key, max(l_orderkey) AS max_key FROM lineitem",
    "profile_columns": union(
        [
            f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM customer"
            for i, (c, t) in enumerate(
                [
                    ("c_custkey", "bigint"),
                    ("c_name", "string"),
                    ("c_nationkey", "int"),
                    ("c_acctbal", "double"),
                    ("c_mktsegment", "string"),
                ]
            )
        ]
    ),
    "describe_table": union([description("c_acctbal"), description("c_nationkey")]),
    "correlation_matrix": f"WITH lines AS (SELECT *, {CHARGE} AS charge FROM lineitem) "
    + union(
        [
            f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, round(corr({a}, {b}), 4) AS r FROM lines"
            for a in CORRELATED
            for b in CORRELATED
        ]
    ),
    "trend_lines": f"WITH lines AS (SELECT *, {CHARGE} AS charge FROM lineitem) "
    + union(
        [
            f"""SELECT '{x}' AS feature, round(regr_slope(charge, {x}), 4) AS slope,
            round(regr_intercept(charge, {x}), 4) AS intercept FROM lines"""
            for x in FEATURES
        ]
    ),
    "dedup_keep_first": """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders) WHERE rn = 1""",
    "dedup_exact": "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem",
    "gap_fill_global": f"WITH {DAILY} SELECT {DAY}, round(total, 4) AS total, inserted FROM dense",
    "gap_fill_per_key": f"""WITH days AS (SELECT user_id, {day_number("ts")} AS d,
        sum(CAST(round(value * 100) AS BIGINT)) AS c FROM events GROUP BY 1, 2),
      known AS (SELECT user_id, d, CAST(c AS BIGINT) / 100.0 AS total FROM days WHERE NOT {LOST}),
      spine AS (SELECT user_id, CAST(unnest(generate_series(min(d), max(d))) AS INTEGER) AS d
        FROM known GROUP BY user_id)
      SELECT s.user_id, DATE '1970-01-01' + s.d AS day, round(total, 4) AS total,
        CAST(k.d IS NULL AS INTEGER) AS inserted
      FROM spine s LEFT JOIN known k ON s.user_id = k.user_id AND s.d = k.d""",
    "carry_forward_backward": f"""WITH {DAILY}, seen AS (SELECT d, {carried("total", "d")} FROM dense)
      SELECT {DAY}, round(total_prev, 4) AS known_before, round(total_next, 4) AS known_after FROM seen""",
    "impute_global": f"""WITH {DAILY}, seen AS (SELECT *, {carried("total", "d")} FROM dense)
      SELECT {DAY}, round({imputed("total")}, 4) AS total, inserted,
        CAST(total IS NULL AS INTEGER) AS imputed_total FROM seen""",
    "impute_grouped": f"""WITH holes AS (SELECT {LINE_ORDER}, l_returnflag,
        CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS discount,
        CASE WHEN l_returnflag <> 'A' AND l_orderkey % 11 <> 0 THEN l_tax END AS tax FROM lineitem),
      middle AS (SELECT quantile_disc(tax, 0.5) AS tax FROM holes),
      seen AS (SELECT *, {carried("discount", LINE_ORDER, "l_returnflag")},
        {carried("tax", LINE_ORDER, "l_returnflag")} FROM holes)
      SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag,
        round({imputed("discount")}, 6) AS discount,
        round({imputed("seen.tax", "middle.tax").replace("seen.tax_", "tax_")}, 6) AS tax,
        CAST(discount IS NULL AS INTEGER) AS imputed_discount,
        CAST(seen.tax IS NULL AS INTEGER) AS imputed_tax
      FROM seen, middle""",
    "quartiles_exact": union(
        [
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS p,
            CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM lineitem"""
            for c in QUANTILE_COLUMNS
            for p in (0.25, 0.5, 0.75)
        ]
    ),
    "quartiles_approx": union(
        [
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS p, true AS within"""
            for c in ("l_quantity", "l_extendedprice")
            for p in (0.25, 0.75)
        ]
    ),
    "median_exact": """SELECT 'o_totalprice' AS "column", CAST(0.5 AS DOUBLE) AS p,
      quantile_disc(o_totalprice, 0.5) AS value FROM orders""",
    "iqr_bounds": union([fence_row(c) for c in ("l_quantity", "l_extendedprice", "l_tax")]),
    "outlier_flags": f"""{FENCED_EVENTS} SELECT event_id, value, {outside("value", "f")} AS outlier_value
      FROM events, f""",
    "winsorize": f"""{FENCED_EVENTS} SELECT event_id, round({capped("value", "f")}, 4) AS value,
      {outside("value", "f")} AS outlier_value FROM events, f""",
    "clean_daily_series": f"""WITH {SERIES} SELECT day, round(total, 4) AS total,
      round(orders, 4) AS orders, inserted, imputed_total, imputed_orders, outlier_total,
      outlier_orders FROM cleaned ORDER BY day""",
    "clean_csv_daily": f"""WITH {SERIES}
      SELECT 'parquet' AS sink, CAST(day AS BIGINT) AS day, round(total, 4) AS total FROM cleaned
      UNION ALL SELECT 'csv', CAST(day AS BIGINT), round(total, 4) FROM cleaned
      UNION ALL SELECT 'report', (SELECT count(*) FROM cleaned), CAST((SELECT count(*) FROM days WHERE {LOST}) AS DOUBLE)""",
    "quality_report": f"""WITH {SERIES}
      SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM raw) AS typed_rows,
        (SELECT count(*) FROM raw WHERE {LOST}) AS invalid_rows,
        (SELECT count(*) FROM raw WHERE NOT {LOST}) - (SELECT count(*) FROM known) AS duplicates_removed,
        (SELECT CAST(min(d) AS BIGINT) FROM known) AS min_day,
        (SELECT CAST(max(d) AS BIGINT) FROM known) AS max_day,
        (SELECT count(*) FROM dense WHERE inserted = 1) AS keys_filled,
        (SELECT count(*) - count(total) FROM dense) AS nulls_before,
        (SELECT count(*) - count(total) FROM cleaned) AS nulls_after,
        (SELECT count(*) FROM cleaned WHERE imputed_orders = 1) AS imputed_orders,
        (SELECT count(*) FROM cleaned WHERE outlier_total = 1) AS outliers_total,
        (SELECT round(low, 4) FROM ft) AS low_total, (SELECT round(high, 4) FROM ft) AS high_total,
        (SELECT count(*) FROM cleaned) AS final_rows""",
    "clean_readings": cleaned_rows(
        """SELECT CAST(round(value * 100) AS BIGINT) / 100.0 AS temperatura,
           CAST(extract(hour FROM ts) AS INTEGER) AS hora,
           CAST(isodow(ts) AS INTEGER) AS dia_semana, user_id * 7 / 100.0 AS consumo_energia FROM events""",
        "hora BETWEEN 1 AND 24 AND dia_semana BETWEEN 1 AND 7",
        "temperatura",
        "consumo_energia",
        "hora, dia_semana",
    ),
    "clean_measurements": cleaned_rows(
        """SELECT CAST(l_suppkey % 130 AS INTEGER) AS edad, l_quantity AS imc,
           CAST(round(l_tax * 100) AS INTEGER) AS actividad_fisica,
           (CAST(round(l_extendedprice * 100) AS BIGINT) // 100) / 100.0 AS nivel_glucosa FROM lineitem""",
        """edad BETWEEN 0 AND 120 AND imc > 0 AND imc <= 80 AND actividad_fisica BETWEEN 0 AND 24
           AND nivel_glucosa BETWEEN 20 AND 600""",
        "imc",
        "nivel_glucosa",
        "edad, actividad_fisica",
    )
    + " ORDER BY edad, actividad_fisica",
    "clean_readings_imputed": imputed_rows(
        """SELECT CASE WHEN event_id % 6 <> 0 THEN CAST(round(value * 100) AS BIGINT) / 100.0 END AS temperatura,
           CAST(extract(hour FROM ts) AS INTEGER) AS hora, CAST(isodow(ts) AS INTEGER) AS dia_semana,
           CASE WHEN event_id % 9 <> 0 THEN user_id * 7 / 100.0 END AS consumo_energia FROM events""",
        "hora BETWEEN 1 AND 24 AND dia_semana BETWEEN 1 AND 7",
        "temperatura",
        "consumo_energia",
        "hora",
        "dia_semana",
    ),
    "clean_measurements_imputed": imputed_rows(
        """SELECT edad, actividad_fisica, CASE WHEN imc BETWEEN 1 AND 45 THEN imc END AS imc,
             CASE WHEN nivel_glucosa BETWEEN 20 AND 600 THEN nivel_glucosa END AS nivel_glucosa FROM (
           SELECT CAST(l_suppkey % 130 AS INTEGER) AS edad, l_quantity AS imc,
             CAST(round(l_tax * 100) AS INTEGER) AS actividad_fisica,
             (CAST(round(l_extendedprice * 100) AS BIGINT) // 100) / 100.0 AS nivel_glucosa FROM lineitem)""",
        "edad BETWEEN 0 AND 120 AND actividad_fisica BETWEEN 0 AND 24",
        "imc",
        "nivel_glucosa",
        "edad",
        "actividad_fisica",
    ),
    "train_test_split": """WITH h AS (SELECT o_orderkey, md5(o_orderkey || ':42') AS h FROM orders)
      SELECT o_orderkey, CAST(substr(h, 1, 8) < '33333333' AS INTEGER) AS is_test,
        CAST(row_number() OVER (ORDER BY substr(h, 1, 15), o_orderkey)
          <= ceil(0.2 * count(*) OVER ()) AS INTEGER) AS is_test_exact FROM h""",
    "ols_fit": f"""WITH {FIT}, {TERMS} SELECT 'charge' AS model, 'charge' AS target, term,
      CAST(position AS INTEGER) AS position, round(coefficient, 4) AS coefficient FROM terms""",
    "ols_equation": f"""WITH {FIT} SELECT 'charge' AS target, printf(
      'charge = %.4f + (%.4f * l_extendedprice) + (%.4f * l_discount) + (%.4f * l_tax)',
      b0, b1, b2, b3) AS equation FROM fit""",
    "ols_metrics": f"""WITH {FIT}, {RESIDUALS} SELECT n, round(mse, 3) AS mse,
      round(sqrt(mse), 3) AS rmse, round(r2, 3) AS r2 FROM metrics""",
    "performance_band": f"""WITH {FIT}, {RESIDUALS} SELECT n, round(r2, 4) AS r2,
      CASE WHEN r2 >= 0.8 THEN 'good' WHEN r2 >= 0.5 THEN 'acceptable' ELSE 'low' END AS band
      FROM metrics""",
    "coefficient_sign": f"""WITH {FIT}, {TERMS} SELECT term, round(coefficient, 4) AS coefficient,
      CASE WHEN coefficient > 0 THEN 'positive' WHEN coefficient < 0 THEN 'negative' ELSE 'none' END
      AS effect FROM terms WHERE position > 0""",
    "coefficient_impact": f"""WITH {FIT}, {TERMS} SELECT term, round(coefficient, 4) AS coefficient,
      round(abs(coefficient), 4) AS impact FROM terms WHERE position > 0
      ORDER BY abs(coefficient) DESC, term""",
    "cross_validate": f"""WITH {FIT}, {FOLDED} SELECT fold, n, round(mse, 3) AS mse, round(r2, 6) AS r2
      FROM fold_scores UNION ALL SELECT NULL, CAST(sum(n) AS BIGINT), round(avg(mse), 3),
      round(avg(r2), 6) FROM fold_scores""",
    "train_report": f"""WITH {SPLIT_FIT},
      {FOLDED} SELECT metric, round(value, 3) AS value FROM ({METRIC_ROWS})""",
    "cross_validate_by_date": """WITH rows AS (
        SELECT CAST(left(o_orderpriority, 1) AS INTEGER) AS p, o_custkey % 100 AS c, o_totalprice / 1000 + dayofyear(o_orderdate) * 3 AS y,
          CAST(ntile(5) OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS fold FROM orders),
      stats AS (
        SELECT f.fold, avg(p) AS mp, avg(c) AS mc, avg(y) AS my, covar_pop(p, p) AS pp, covar_pop(c, c) AS cc, covar_pop(p, c) AS pc,
          covar_pop(p, y) AS py, covar_pop(c, y) AS cy
        FROM rows JOIN (SELECT DISTINCT fold FROM rows) f ON rows.fold <> f.fold GROUP BY f.fold),
      fits AS (SELECT *, (py * cc - cy * pc) / (pp * cc - pc * pc) AS b1, (cy * pp - py * pc) / (pp * cc - pc * pc) AS b2 FROM stats),
      scores AS (
        SELECT fold, count(*) AS n, avg(pow(y - (my + b1 * (p - mp) + b2 * (c - mc)), 2)) AS mse, var_pop(y) AS spread
        FROM rows JOIN fits USING (fold) GROUP BY fold)
      SELECT fold, n, round(mse, 5) AS mse, round(1 - mse / spread, 5) AS r2 FROM scores
      UNION ALL SELECT NULL, CAST(sum(n) AS BIGINT), round(avg(mse), 5), round(avg(1 - mse / spread), 5) FROM scores""",
    # The difference of two columns this close is exact in doubles, and no longer close to either.
    "ols_ill_conditioned": """WITH given AS (
        SELECT l_quantity / 50 AS x1, l_quantity / 50 + 1e-9::DOUBLE * l_linenumber AS x2, l_tax AS t,
          (l_extendedprice * (1 - l_discount) * (1 + l_tax)) / 1000 + 20 * l_linenumber AS y FROM lineitem),
      rows AS (SELECT x1 AS a, (x2 - x1) * 1e9::DOUBLE AS d, t, y FROM given),
      s AS (SELECT avg(a) AS ma, avg(d) AS md, avg(t) AS mt, avg(y) AS my, covar_pop(a, a) AS aa, covar_pop(d, d) AS dd, covar_pop(t, t) AS tt,
        covar_pop(a, d) AS ad, covar_pop(a, t) AS at_, covar_pop(d, t) AS dt, covar_pop(a, y) AS ay, covar_pop(d, y) AS dy, covar_pop(t, y) AS ty FROM rows),
      det AS (SELECT *, aa * (dd * tt - dt * dt) - ad * (ad * tt - dt * at_) + at_ * (ad * dt - dd * at_) AS det FROM s),
      b AS (SELECT *,
        (ay * (dd * tt - dt * dt) - ad * (dy * tt - dt * ty) + at_ * (dy * dt - dd * ty)) / det AS ba,
        (aa * (dy * tt - dt * ty) - ay * (ad * tt - dt * at_) + at_ * (ad * ty - dy * at_)) / det AS bd,
        (aa * (dd * ty - dy * dt) - ad * (ad * ty - dy * at_) + ay * (ad * dt - dd * at_)) / det AS bt FROM det)
      SELECT false AS dependent, round(my - ba * ma - bd * md - bt * mt, 1) AS intercept, round(ba, 1) AS "sum", round(bd, 1) AS apart,
        round(bt, 1) AS l_tax FROM b""",
    "folds_by_date": """SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS fold
      FROM orders""",
    "folds_by_text": """SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY c_mktsegment, c_name) - 1 AS INTEGER) AS fold
      FROM customer""",
    "train_explained": f"""WITH {SPLIT_FIT}
      SELECT 'equation' AS about, printf(
        'charge = %.4f + (%.4f * l_extendedprice) + (%.4f * l_discount) + (%.4f * l_tax)', b0, b1, b2, b3) AS text FROM fit
      UNION ALL SELECT 'effect_' || term, CASE WHEN c > 0 THEN 'positive' WHEN c < 0 THEN 'negative' ELSE 'none' END FROM ("""
    + union([f"SELECT '{f}' AS term, b{i} AS c FROM fit" for i, f in enumerate(FEATURES, 1)])
    + """) UNION ALL SELECT 'band', CASE WHEN r2 >= 0.8 THEN 'good' WHEN r2 >= 0.5 THEN 'acceptable' ELSE 'low' END FROM metrics""",
    "correlation_wide": """WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)
      SELECT 'e' || a.i AS variable_a, 'e' || b.i AS variable_b, round(corr(a.x, b.x), 6) AS r
      FROM e a JOIN e b USING (vec_id) GROUP BY a.i, b.i""",
    "correlation_tiles": """WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
      c AS (SELECT vec_id, 'e' || i AS name, x FROM e UNION ALL
        SELECT vec_id, 'g' || i, x * 2 + 1 FROM e WHERE i < 36 AND (vec_id + i) % 5 <> 0)
      SELECT a.name AS variable_a, b.name AS variable_b, round(corr(a.x, b.x), 6) AS r
      FROM c a JOIN c b USING (vec_id) GROUP BY a.name, b.name""",
    "describe_decimal": """SELECT 'price' AS "column", count(*) AS count, round(avg(o_totalprice), 4) AS mean,
      round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
      round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75,
      max(o_totalprice) AS max FROM orders""",
    "model_table_roundtrip": f"""WITH {FIT}, {TERMS} SELECT 'charge' AS model, 'charge' AS target,
      term, CAST(position AS INTEGER) AS position, round(coefficient, 4) AS coefficient,
      'Charge of a line' AS display, false AS rank_deficient, 1::BIGINT AS version FROM terms""",
    "model_versions": f"""WITH lines AS (SELECT *, {CHARGE} AS charge FROM lineitem), fits AS ("""
    + union([f"SELECT '{f}' AS name, round(regr_intercept(charge, {f}), 4) AS a, round(regr_slope(charge, {f}), 4) AS b FROM lines" for f in FEATURES])
    + """),
      first AS (SELECT name AS model, 'charge' AS target, name AS term, a, b, '' AS display, 1 AS version FROM fits),
      second AS (
        SELECT * FROM first WHERE model <> 'l_tax' UNION ALL SELECT name, 'charge', name, -1.5, b, 'Second', 2 FROM fits WHERE name = 'l_tax'
        UNION ALL SELECT 'new', '', name, a, b, '', 2 FROM fits WHERE name = 'l_tax'),
      every AS (SELECT *, 1 AS asked FROM first UNION ALL SELECT *, 2 FROM second UNION ALL SELECT *, 3 FROM second)
      SELECT model, target, 'intercept' AS term, 0 AS position, a AS coefficient, display, false AS rank_deficient, version::BIGINT AS version, asked FROM every
      UNION ALL SELECT model, target, term, 1, b, display, false, version::BIGINT, asked FROM every""",
    "score_requests_many": """WITH asked AS (
        SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q, round(l_tax * 100) / 100 AS t,
          CASE WHEN (l_partkey + l_linenumber) % 10 < 9 THEN 7 WHEN l_orderkey % 13 = 0 THEN -l_orderkey ELSE l_orderkey END AS k,
          l_orderkey % 17 = 0 AND l_linenumber = 3 AS empty, l_orderkey % 19 = 0 AND l_linenumber = 2 AS wrong FROM lineitem),
      judged AS (
        SELECT *, CASE WHEN o_orderkey IS NULL THEN 'Unknown exercise.'
          WHEN empty THEN 'Field ''Quantity'' is required.' WHEN wrong THEN 'Field ''Tax'' must be numeric.'
          WHEN k % 50 = 0 THEN 'No model found: m' || k WHEN k % 41 = 0 THEN 'Model variables without a value: Weight' END AS error
        FROM asked LEFT JOIN orders ON o_orderkey = k)
      SELECT l_orderkey, l_partkey, l_linenumber, 'e' || k AS exercise, error,
        CASE WHEN error IS NULL THEN 'Order ' || o_orderstatus END AS title,
        CASE WHEN error IS NULL THEN CASE WHEN k % 10 = 1 THEN 'Model of order ' ELSE 'm' END || k END AS model,
        CASE WHEN error IS NULL THEN CASE WHEN k % 3 = 0 THEN 'price' ELSE 'cost' END END AS target,
        CASE WHEN error IS NULL THEN round(k % 100 / 4 + CASE WHEN k % 3 = 1 THEN 1000 ELSE 0 END + q * (k % 7 + 0.5) + t * (k % 5 * 0.25), 6)::DOUBLE END AS value
      FROM judged""",
    "score_table": f"""WITH {FIT}, {SHORT} SELECT l_orderkey, l_partkey, l_linenumber,
      l_extendedprice, l_discount, l_tax,
      round(b0 + b1 * l_extendedprice + b2 * l_discount + b3 * l_tax, 6) AS prediction
      FROM lines, short""",
    "score_named_features": f"""WITH {FIT}, {SHORT} SELECT l_orderkey, l_linenumber,
      l_extendedprice AS price,
      round(b0 + b1 * l_extendedprice + b2 * l_discount + b3 * l_tax, 6) AS prediction
      FROM lines, short""",
    "score_requests": f"""WITH lines AS (SELECT *, {CHARGE} AS charge FROM lineitem),
      moments AS ({moments("lines", ("l_quantity", "l_discount", "l_tax"), "charge")}),
      fit AS ({coefficients("moments")}), {SHORT}, {REQUESTS}, {LABELS},
      judged AS (SELECT r.*, title, target, CASE
        WHEN l1 IS NULL THEN 'Debes seleccionar un ejercicio valido.'
        WHEN v1 IS NULL THEN 'El campo ''' || l1 || ''' es obligatorio.'
        WHEN v2 IS NULL THEN 'El campo ''' || l2 || ''' debe ser numerico.'
        WHEN v3 IS NULL THEN 'El campo ''' || l3 || ''' es obligatorio.'
        WHEN r.exercise = 'energia' THEN 'No se pudieron mapear variables del modelo: humedad'
        END AS error FROM requests r LEFT JOIN labels_ l ON r.exercise = l.exercise)
      SELECT request_id, exercise, error, CASE WHEN error IS NULL THEN title END AS title,
        CASE WHEN error IS NULL THEN CASE exercise WHEN 'glucosa' THEN 'Glucosa II' ELSE exercise END END AS model,
        CASE WHEN error IS NULL THEN target END AS target,
        CASE WHEN error IS NULL THEN round(b0 + v1 * b1 + v2 * b2 + v3 * b3, 6) END AS value
      FROM judged, short""",
}
# The same questions, asked so that the large-table paths answer them.
ORACLES["quartiles_narrowed"] = ORACLES["quartiles_exact"]
ORACLES["impute_grouped_ties"] = f"""WITH r AS (SELECT event_id, CAST(isodow(ts) AS INTEGER) AS day,
    CAST(extract(hour FROM ts) AS INTEGER) AS hour,
    CASE WHEN event_id % 5 <> 0 THEN CAST(round(value * 100) AS BIGINT) / 100.0 END AS reading FROM events),
  seen AS (SELECT *, {carried("reading", "hour, event_id", "day")} FROM r)
  SELECT event_id, day, hour, round({imputed("reading")}, 4) AS reading,
    CAST(reading IS NULL AS INTEGER) AS imputed_reading FROM seen"""
ORACLES["impute_grouped_ties_sliced"] = ORACLES["impute_grouped_ties"]
ORACLES["impute_grouped_sliced"] = ORACLES["impute_grouped"]

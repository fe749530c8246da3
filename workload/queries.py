"""Queries over the test tables, one or more per operator.

The tables hold no NULLs and no malformed text, so dirt is derived from their
keys, the same way in the SQL. Money is summed in whole cents: sums are then
exact and equal in any engine. Doubles are rounded in the output only, to more
digits than a product of inputs can have where it could end in a tie.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.functions.parse import parse_double, parse_int, parse_number, trimmed
from tablaris.operators import conform as schema
from tablaris.operators import dedup, gapfill, infer, ordering, outliers, quantiles, regression, stats, tiles
from tablaris.operators.impute import impute
from tablaris.operators.regression import LinearModel
from tablaris.operators.scoring import score_named, score_requests
from tablaris.operators.split import train_test_split
from tablaris.operators.validate import drop_nulls, is_valid, keep_valid, validity_counts
from tablaris.plans.clean import CleanResult, clean, clean_csv
from tablaris.plans.presets import ENERGY, EXERCISES, GLUCOSE, MESSAGES
from tablaris.plans.score import score_with_many_models
from tablaris.plans.train import train
from tablaris.sources import csv, tables
from tablaris.sources.models import load_models, packed, read_model_table, save_model_rows, save_models
from tablaris.sources.staging import stage, staging_path
from tablaris.spec import CleanSpec, Field, Rule

Query = Callable[[SparkSession, str], DataFrame]

# Columns that together identify a lineitem row.
LINE_KEY = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
]
FEATURES = ["l_extendedprice", "l_discount", "l_tax"]
LABEL = "charge"


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def money_text(whole_cents: Column, point: str = ",") -> Column:
    """Cents as text such as ``1234,05``."""
    units = F.floor(whole_cents / 100).cast("string")
    return F.concat(units, F.lit(point), F.lpad((whole_cents % 100).cast("string"), 2, "0"))


def charges(spark: SparkSession, data: str) -> DataFrame:
    """Lineitem with a label that follows from its numbers."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, data, "lineitem").withColumn(LABEL, charge)


# Sources, sinks, previews


def scan_csv_roundtrip(spark: SparkSession, data: str) -> DataFrame:
    part = table(spark, data, "part")
    path = staging_path(spark, "part-csv")
    csv.write_csv(part, path)
    rows, _ = csv.scan_csv(spark, path, part.schema)
    return rows


def infer_types(spark: SparkSession, data: str) -> DataFrame:
    """Text columns of every kind, with blanks, strays and mixtures among them."""
    key = F.col("o_orderkey")
    number, day = key.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")

    def but(share: int, odd: str | None, usual: Column) -> Column:
        return F.when(key % share == share - 1, F.lit(odd)).otherwise(usual)

    texts = {
        "whole": but(7, None, F.concat(F.lit(" "), number)),
        "signed": but(11, "+5", F.concat(F.lit("-"), number)),
        "long": but(13, "", F.concat(number, F.lit("0000000000"))),
        "huge": but(17, "-7", F.concat(F.lit("9"), number, F.lit("00000000000000000000"))),
        "too_huge": but(19, "1", F.rpad(number, 45, "3")),
        "price": but(23, "1e-3", money_text(cents("o_totalprice"), ".")),
        "not_finite": but(29, "NaN", number),
        "comma": money_text(cents("o_totalprice")),
        "stray": but(1000, "n/a", number),
        "day": but(5, "\t", day),
        "moment": but(3, "2020-02-29T12:30:01.5", day),
        "no_day": but(900, "2021-02-29", day),
        "yes": but(2, " TRUE", F.lit("false")),
        "blank": but(2, None, F.lit("  ")),
        "mixed": but(2, "true", number),
    }
    raw = table(spark, data, "orders").select(*[t.alias(n) for n, t in texts.items()])
    return infer.infer_types(raw)


MANY_FILES = 2000


def csv_headers_many(spark: SparkSession, data: str) -> DataFrame:
    """Orders from 2,000 small CSV files of three layouts, one of them with the names of another sheet."""
    orders = table(spark, data, "orders")
    asked = orders.select("o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice").alias("cents"), "o_orderpriority")
    source = staging_path(spark, "orders-csv")
    kind = F.col("o_orderkey") % 4
    layouts = {
        "a": (asked.where(kind < 2), MANY_FILES // 2),
        "b": (asked.where(kind == 2).select(*asked.columns[::-1]), MANY_FILES // 4),
        "c": (asked.where(kind == 3).toDF("O Orderkey", " o_CUSTKEY", "O-Orderstatus", "Cents", "O_orderpriority!").withColumn("note", F.lit("x, y")), MANY_FILES // 4),
    }
    for name, (rows, files) in layouts.items():
        csv.write_csv(rows.repartition(files, rows.columns[0]), f"{source}/layout={name}")
    rows, _ = csv.scan_csv(spark, f"{source}/*", asked.schema)
    return rows


def sink_parquet_roundtrip(spark: SparkSession, data: str) -> DataFrame:
    path = staging_path(spark, "part-parquet")
    tables.write_parquet(table(spark, data, "part"), path)
    return tables.read_parquet(spark, path)


def head_rows(spark: SparkSession, data: str) -> DataFrame:
    customer = table(spark, data, "customer").select("c_custkey", "c_name", "c_acctbal")
    return tables.head_rows(customer, 5, [F.desc("c_acctbal"), "c_custkey"])


# Schema


CUSTOMER_HEADERS = [" Clé Client ", "Name!", "NATION  key", "Acct.Bal", "Mkt-Segment"]
CUSTOMER_ALIASES = {"cle_client": "custkey", "acct_bal": "balance", "mkt_segment": "segment"}


def messy_customer(spark: SparkSession, data: str) -> DataFrame:
    """Customer under untidy headers, with a second column claiming the key's name."""
    customer = table(spark, data, "customer").toDF(*CUSTOMER_HEADERS)
    return customer.withColumn("clé_client", F.lit(0))


def normalize_columns(spark: SparkSession, data: str) -> DataFrame:
    return schema.normalize_columns(messy_customer(spark, data), CUSTOMER_ALIASES)


def conform_schema(spark: SparkSession, data: str) -> DataFrame:
    spec = CleanSpec(
        fields=(
            Field("custkey", "int", ("cle_client",)),
            Field("name", "string"),
            Field("segment", "string", ("mkt_segment",)),
            Field("phone", "string"),
        )
    )
    return schema.conform(messy_customer(spark, data), spec)


def required_columns(spark: SparkSession, data: str) -> DataFrame:
    needed = ["l_orderkey", "l_quantity", "l_comment", "l_tax", "l_weight"]
    return schema.required_columns(table(spark, data, "lineitem"), needed)


def parse_locale_numbers(spark: SparkSession, data: str) -> DataFrame:
    part = table(spark, data, "part")
    whole, kind = cents("p_retailprice"), F.col("p_partkey") % 17
    text = (
        F.when(kind == 0, F.concat(F.lit("  "), money_text(whole), F.lit(" ")))
        .when(kind == 1, F.concat(money_text(whole), F.lit("x")))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.concat(F.lit("1."), money_text(whole)))
        .when(kind == 4, money_text(whole, "."))
        .otherwise(money_text(whole))
    )
    return part.select("p_partkey", text.alias("t")).select(
        "p_partkey",
        F.round(parse_double(F.col("t")), 4).alias("as_double"),
        parse_int(F.col("t")).alias("as_int"),
        F.round(parse_number(F.col("t")), 4).alias("as_number"),
    )


# Validation and null handling


LINE_RULES = (Rule("l_quantity", 1, 40), Rule("l_discount", high=0.08), Rule("l_orderkey"))


def validate_rules(spark: SparkSession, data: str) -> DataFrame:
    lines = table(spark, data, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount"
    )
    return keep_valid(lines, LINE_RULES, ["l_quantity", "l_discount"])


def validate_counts(spark: SparkSession, data: str) -> DataFrame:
    lines = table(spark, data, "lineitem")
    return validity_counts(lines, is_valid(LINE_RULES, ["l_quantity", "l_discount"]))


def lines_with_nulls(spark: SparkSession, data: str) -> DataFrame:
    key = F.col("l_orderkey")
    return table(spark, data, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(key % 7 != 0, F.col("l_tax")).alias("l_tax"),
        F.when(key % 7 != 1, F.col("l_quantity")).alias("l_quantity"),
    )


def drop_null_rows(spark: SparkSession, data: str) -> DataFrame:
    return drop_nulls(lines_with_nulls(spark, data))


def null_counts(spark: SparkSession, data: str) -> DataFrame:
    return stats.null_counts(lines_with_nulls(spark, data), ["l_orderkey", "l_tax", "l_quantity"])


def key_bounds(spark: SparkSession, data: str) -> DataFrame:
    return gapfill.key_bounds(table(spark, data, "lineitem"), "l_orderkey")


# Summaries


def profile_columns(spark: SparkSession, data: str) -> DataFrame:
    return stats.profile_columns(table(spark, data, "customer"))


def describe_table(spark: SparkSession, data: str) -> DataFrame:
    found = stats.describe(table(spark, data, "customer"), ["c_acctbal", "c_nationkey"])
    return rounded(found, "mean", "std", "min", "q25", "q50", "q75", "max")


def correlation_matrix(spark: SparkSession, data: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", LABEL]
    return rounded(stats.correlation_matrix(charges(spark, data), columns), "r")


def trend_lines(spark: SparkSession, data: str) -> DataFrame:
    found = stats.trend_lines(charges(spark, data), FEATURES, LABEL)
    return rounded(found, "slope", "intercept")


# Duplicates


def dedup_keep_first(spark: SparkSession, data: str) -> DataFrame:
    orders = table(spark, data, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"
    )
    return dedup.keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def dedup_exact(spark: SparkSession, data: str) -> DataFrame:
    lines = table(spark, data, "lineitem")
    return dedup.drop_exact(lines.select("l_returnflag", "l_linestatus", "l_quantity", "l_tax"))


# Gaps and imputation


def lost_day(day: Column) -> Column:
    """Days whose figure counts as unreadable: one a week and one longer run."""
    number = F.unix_date(day)
    return (number % 7 == 3) | number.between(9500, 9529)


def daily_totals(spark: SparkSession, data: str) -> DataFrame:
    """Order value per day, lost days taken out by the NULL rule."""
    day = F.to_date("o_orderdate").alias("day")
    daily = table(spark, data, "orders").groupBy(day).agg(F.sum(cents("o_totalprice")).alias("c"))
    total = F.when(~lost_day(F.col("day")), F.col("c") / 100.0)
    return stage(keep_valid(daily.select("day", total.alias("total")), [Rule("total")]), "daily")


def gap_fill_global(spark: SparkSession, data: str) -> DataFrame:
    return rounded(gapfill.fill_gaps(daily_totals(spark, data), "day"), "total")


def gap_fill_per_key(spark: SparkSession, data: str) -> DataFrame:
    day = F.to_date("ts").alias("day")
    events = table(spark, data, "events")
    daily = events.groupBy("user_id", day).agg(F.sum(cents("value")).alias("c"))
    total = F.when(~lost_day(F.col("day")), F.col("c") / 100.0)
    known = stage(
        keep_valid(daily.select("user_id", "day", total.alias("total")), [Rule("total")]),
        "daily-per-user",
    )
    return rounded(gapfill.fill_gaps_per_entity(known, ["user_id"], "day"), "total")


def carry_forward_backward(spark: SparkSession, data: str) -> DataFrame:
    dense = stage(gapfill.fill_gaps(daily_totals(spark, data), "day"), "dense")
    seen = ordering.neighbours(dense, ["total"], ["day"])
    return seen.select(
        "day",
        F.round("_prev_total", 4).alias("known_before"),
        F.round("_next_total", 4).alias("known_after"),
    )


def impute_global(spark: SparkSession, data: str) -> DataFrame:
    dense = stage(gapfill.fill_gaps(daily_totals(spark, data), "day"), "dense")
    return rounded(impute(dense, ["total"], ["day"]), "total")


def impute_lines(spark: SparkSession, data: str, window_rows: int) -> DataFrame:
    """Gaps inside three large groups; one group has no tax at all."""
    key, flag = F.col("l_orderkey"), F.col("l_returnflag")
    lines = table(spark, data, "lineitem").select(
        *LINE_KEY,
        "l_returnflag",
        F.when(key % 7 != 0, F.col("l_discount")).alias("discount"),
        F.when((flag != "A") & (key % 11 != 0), F.col("l_tax")).alias("tax"),
    )
    filled = impute(
        lines, ["discount", "tax"], LINE_KEY, ["l_returnflag"], window_rows=window_rows
    )
    kept = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "discount", "tax"]
    return rounded(
        filled.select(*kept, "imputed_discount", "imputed_tax"), "discount", "tax", digits=6
    )


def impute_grouped(spark: SparkSession, data: str) -> DataFrame:
    return impute_lines(spark, data, ordering.WINDOW_ROWS)


def impute_grouped_sliced(spark: SparkSession, data: str) -> DataFrame:
    """The same with groups cut into slices, as happens to large ones."""
    return impute_lines(spark, data, 10_000)


def impute_hourly(spark: SparkSession, data: str, window_rows: int) -> DataFrame:
    """Readings by weekday and hour: 24 order values, so nearly all rows are tied."""
    readings = table(spark, data, "events").select(
        "event_id",
        (F.weekday("ts") + 1).alias("day"),
        F.hour("ts").alias("hour"),
        F.when(F.col("event_id") % 5 != 0, cents("value") / 100.0).alias("reading"),
    )
    return rounded(impute(readings, ["reading"], ["hour"], ["day"], window_rows=window_rows), "reading")


def impute_grouped_ties(spark: SparkSession, data: str) -> DataFrame:
    return impute_hourly(spark, data, ordering.WINDOW_ROWS)


def impute_grouped_ties_sliced(spark: SparkSession, data: str) -> DataFrame:
    """The same with groups cut into slices, as happens to large ones."""
    return impute_hourly(spark, data, 500)


# Quantiles and outliers


QUANTILE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]


def quartiles_exact(spark: SparkSession, data: str) -> DataFrame:
    return quantiles.quantile_table(
        table(spark, data, "lineitem"), QUANTILE_COLUMNS, [0.25, 0.5, 0.75]
    )


def quartiles_narrowed(spark: SparkSession, data: str) -> DataFrame:
    """The same selection, made to narrow as often as on a table of any size."""
    lines, shares = table(spark, data, "lineitem"), [0.25, 0.5, 0.75]
    return quantiles.quantile_table(lines, QUANTILE_COLUMNS, shares, rank_rows=20)


def median_exact(spark: SparkSession, data: str) -> DataFrame:
    return quantiles.quantile_table(table(spark, data, "orders"), ["o_totalprice"], [0.5])


def quartiles_approx(spark: SparkSession, data: str) -> DataFrame:
    """Whether each approximate quartile's rank is within a ten-thousandth of the rows."""
    lines = table(spark, data, "lineitem")
    found = quantiles.quantile_table(lines, ["l_quantity", "l_extendedprice"], [0.25, 0.75], "approx")
    checks = []
    for row in found.collect():  # four values
        below, upto = (F.count_if(test(F.col(row["column"]), row["value"])) for test in (Column.__lt__, Column.__le__))
        spot, slack = row["p"] * F.count(F.lit(1)), F.count(F.lit(1)) / 10_000 + 1
        within = (below <= spot + slack) & (upto >= spot - slack)
        checks.append(F.struct(F.lit(row["column"]).alias("column"), F.lit(row["p"]).alias("p"), within.alias("within")))
    return lines.agg(F.array(*checks).alias("r")).select(F.inline("r"))


def iqr_bounds(spark: SparkSession, data: str) -> DataFrame:
    found = outliers.fence_table(
        table(spark, data, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"]
    )
    return rounded(found, "q1", "q3", "low", "high")


def event_values(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "events").select("event_id", "value")


def outlier_flags(spark: SparkSession, data: str) -> DataFrame:
    values = event_values(spark, data)
    return outliers.flag_outliers(values, outliers.iqr_fences(values, ["value"]))


def winsorize(spark: SparkSession, data: str) -> DataFrame:
    values = event_values(spark, data)
    return rounded(outliers.winsorize(values, outliers.iqr_fences(values, ["value"])), "value")


# Cleaning jobs


SERIES = CleanSpec(
    fields=(
        Field("day", "int", ("dia",), decimal_comma=False),
        Field("total", aliases=("order_total",)),
        Field("orders", aliases=("number_of_orders",)),
    ),
    rules=(Rule("day", low=0, low_open=True),),
    key="day",
    ingest_order=("seq",),
    fill_gaps=True,
    impute=("total", "orders"),
    order_by=("day",),
    cap=("total", "orders"),
    sort_by=("day",),
)


def cleaned_series(spark: SparkSession, data: str) -> CleanResult:
    """Daily order figures as text, with unreadable days and repeated days."""
    day = F.unix_date(F.to_date("o_orderdate")).alias("d")
    daily = (
        table(spark, data, "orders")
        .groupBy(day)
        .agg(F.sum(cents("o_totalprice")).alias("c"), F.count(F.lit(1)).alias("n"))
    )
    lost = (F.col("d") % 7 == 3) | F.col("d").between(9500, 9529)
    # A repeat of every tenth day arrives later, with another total.
    copies = F.when(F.col("d") % 10 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    repeated = daily.select("d", "c", "n", F.explode(copies).alias("seq"))
    total = money_text(F.col("c") + (F.col("seq") - 1) * 100)
    raw = repeated.select(
        F.col("d").cast("string").alias(" Día "),
        F.when(lost, F.lit("n/a")).otherwise(total).alias("Order  total"),
        F.concat(F.lit(" "), F.col("n").cast("string")).alias("Number of Orders"),
        "seq",
    )
    return clean(raw, SERIES)


def clean_daily_series(spark: SparkSession, data: str) -> DataFrame:
    return rounded(cleaned_series(spark, data).data, "total", "orders")


def quality_report(spark: SparkSession, data: str) -> DataFrame:
    report = cleaned_series(spark, data).report()
    total = F.col("outliers")["total"]
    return report.select(
        "raw_rows",
        "typed_rows",
        "invalid_rows",
        "duplicates_removed",
        F.col("key_range.min").alias("min_day"),
        F.col("key_range.max").alias("max_day"),
        "keys_filled",
        F.col("nulls_before")["total"].alias("nulls_before"),
        F.col("nulls_after")["total"].alias("nulls_after"),
        F.col("imputations")["orders"].alias("imputed_orders"),
        total["detected"].alias("outliers_total"),
        F.round(total["low_limit"], 4).alias("low_total"),
        F.round(total["high_limit"], 4).alias("high_total"),
        "final_rows",
    )


def clean_csv_daily(spark: SparkSession, data: str) -> DataFrame:
    """Days from CSV files of two layouts to Parquet, CSV and a JSON report, read back.

    One row for each day of either sink and one for the report.
    """
    day = F.unix_date(F.to_date("o_orderdate")).alias("d")
    daily = table(spark, data, "orders").groupBy(day).agg(F.sum(cents("o_totalprice")).alias("c"), F.count(F.lit(1)).alias("n"))
    lost = (F.col("d") % 7 == 3) | F.col("d").between(9500, 9529)
    total = F.when(lost, F.lit("n/a")).otherwise(money_text(F.col("c"))).alias("Order  total")
    number = F.concat(F.lit(" "), F.col("n").cast("string")).alias("Number of Orders")
    rows = stage(daily.select(F.col("d").cast("string").alias("day"), total, number, F.col("d").alias("d")), "csv-days")
    source, target = staging_path(spark, "csv-in"), staging_path(spark, "csv-out")
    plain = rows.drop("d")
    csv.write_csv(plain.where(rows["d"] % 2 == 0), f"{source}/layout=a")
    csv.write_csv(plain.where(rows["d"] % 2 != 0).select(*plain.columns[::-1]), f"{source}/layout=b")
    report = f"{target}/report"
    clean_csv(spark, f"{source}/*", target, report, replace(SERIES, ingest_order=()))
    parquet = spark.read.parquet(f"{target}/parquet").select(F.lit("parquet").alias("sink"), F.col("day").cast("long").alias("day"), "total")
    back = csv.scan_csv_inferred(spark, f"{target}/csv").select(F.lit("csv").alias("sink"), F.col("day").cast("long").alias("day"), "total")
    said = spark.read.json(report).select(F.lit("report").alias("sink"), F.col("final_rows").alias("day"), F.col("invalid_rows").cast("double").alias("total"))
    return rounded(parquet.union(back).union(said), "total")


def clean_readings(spark: SparkSession, data: str) -> DataFrame:
    """Events as hourly readings; midnight readings break the hour rule."""
    events = table(spark, data, "events")
    raw = events.select(
        money_text(cents("value")).alias("Temperature"),
        F.hour("ts").cast("string").alias("HOUR"),
        (F.weekday("ts") + 1).cast("string").alias("Día de semana"),
        money_text(F.col("user_id") * 7, ".").alias("Energy consumption"),
    )
    return rounded(clean(raw, ENERGY).data, "temperatura", "consumo_energia")


def clean_measurements(spark: SparkSession, data: str) -> DataFrame:
    """Line items as measurements; ages over 120 and high levels break the rules."""
    lines = table(spark, data, "lineitem")
    raw = lines.select(
        (F.col("l_suppkey") % 130).cast("string").alias("Age"),
        F.col("l_quantity").cast("int").cast("string").alias("BMI"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("Physical activity"),
        money_text(F.floor(cents("l_extendedprice") / 100)).alias("Glucose Level"),
    )
    return rounded(clean(raw, GLUCOSE).data, "imc", "nivel_glucosa")


def clean_readings_imputed(spark: SparkSession, data: str) -> DataFrame:
    """Readings whose unreadable and absent figures are imputed within the weekday."""
    key = F.col("event_id")
    raw = table(spark, data, "events").select(
        F.when(key % 6 == 0, F.lit("n/a")).otherwise(money_text(cents("value"))).alias("Temperature"),
        F.hour("ts").cast("string").alias("HOUR"),
        (F.weekday("ts") + 1).cast("string").alias("Día de semana"),
        F.when(key % 9 != 0, money_text(F.col("user_id") * 7, ".")).alias("Energy consumption"),
    )
    spec = ENERGY.optional("temperatura", "consumo_energia")
    return rounded(clean(raw, spec).data, "temperatura", "consumo_energia")


def clean_measurements_imputed(spark: SparkSession, data: str) -> DataFrame:
    """Measurements where figures that are unreadable or break a rule are imputed by activity."""
    quantity = F.col("l_quantity").cast("int")
    raw = table(spark, data, "lineitem").select(
        (F.col("l_suppkey") % 130).cast("string").alias("Age"),
        F.when(quantity > 45, F.lit("?")).otherwise(quantity.cast("string")).alias("BMI"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("Physical activity"),
        money_text(F.floor(cents("l_extendedprice") / 100)).alias("Glucose Level"),
    )
    spec = GLUCOSE.optional("imc", "nivel_glucosa")
    return rounded(clean(raw, spec).data, "imc", "nivel_glucosa")


# Regression


def split_orders(spark: SparkSession, data: str) -> DataFrame:
    orders = table(spark, data, "orders").select("o_orderkey")
    marked = train_test_split(orders, ["o_orderkey"])
    return train_test_split(marked, ["o_orderkey"], exact=True, out="is_test_exact")


def charge_model(spark: SparkSession, data: str) -> LinearModel:
    return regression.fit(charges(spark, data), FEATURES, LABEL, "charge")


def charge_coefficients(spark: SparkSession, data: str) -> DataFrame:
    return regression.coefficient_table(spark, charge_model(spark, data))


def ols_fit(spark: SparkSession, data: str) -> DataFrame:
    return rounded(charge_coefficients(spark, data), "coefficient")


def ols_equation(spark: SparkSession, data: str) -> DataFrame:
    return regression.equation(charge_coefficients(spark, data)).select("target", "equation")


def charge_metrics(spark: SparkSession, data: str) -> DataFrame:
    scored = regression.predict(charges(spark, data), charge_model(spark, data))
    return regression.evaluate(scored, LABEL)


def ols_metrics(spark: SparkSession, data: str) -> DataFrame:
    return rounded(charge_metrics(spark, data), "mse", "rmse", "r2", digits=3)


def performance_band(spark: SparkSession, data: str) -> DataFrame:
    banded = regression.performance_band(charge_metrics(spark, data))
    return rounded(banded, "r2").select("n", "r2", "band")


def coefficient_sign(spark: SparkSession, data: str) -> DataFrame:
    signs = regression.coefficient_signs(charge_coefficients(spark, data))
    return rounded(signs.select("term", "coefficient", "effect"), "coefficient")


def coefficient_impact(spark: SparkSession, data: str) -> DataFrame:
    ranked = regression.coefficient_impact(charge_coefficients(spark, data))
    return rounded(ranked.select("term", "coefficient", "impact"), "coefficient", "impact")


def cross_validate(spark: SparkSession, data: str) -> DataFrame:
    scores = regression.cross_validate(charges(spark, data), FEATURES, LABEL, LINE_KEY)
    found = regression.cross_validation_table(spark, scores)
    return rounded(rounded(found, "mse", digits=3), "r2", digits=6)


def dated_orders(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        (F.col("o_custkey") % 100).alias("client"),
        (F.col("o_totalprice") / 1000 + F.dayofyear("o_orderdate") * 3).alias("total"),
    )


def cross_validate_by_date(spark: SparkSession, data: str) -> DataFrame:
    """Folds, fits and scores in the order of a date, many orders to a day."""
    scores = regression.cross_validate(dated_orders(spark, data), ["priority", "client"], "total", ["o_orderdate", "o_orderkey"])
    return rounded(regression.cross_validation_table(spark, scores), "mse", "r2", digits=5)


def ols_ill_conditioned(spark: SparkSession, data: str) -> DataFrame:
    """Two columns that differ by a few times 1e-9 of their size, each with an effect of its own."""
    share = F.col("l_quantity") / 50
    lines = charges(spark, data).select(
        share.alias("x1"),
        (share + F.lit(1e-9) * F.col("l_linenumber")).alias("x2"),
        "l_tax",
        (F.col(LABEL) / 1000 + 20 * F.col("l_linenumber")).alias("y"),
    )
    m = regression.fit(lines, ["x1", "x2", "l_tax"], "y")
    b1, b2, b3 = m.coefficients
    row = (m.rank_deficient, float(m.intercept), b1 + b2, b2 / 1e9, b3)
    found = spark.createDataFrame([row], "dependent boolean, intercept double, sum double, apart double, l_tax double")
    return rounded(found, "intercept", "sum", "apart", "l_tax", digits=1)


def folds_by_date(spark: SparkSession, data: str) -> DataFrame:
    """Folds in the order of a date, many orders to a day."""
    folds = regression.assign_folds(table(spark, data, "orders"), ["o_orderdate", "o_orderkey"], 5)
    return folds.select("o_orderkey", "fold")


def folds_by_text(spark: SparkSession, data: str) -> DataFrame:
    folds = regression.assign_folds(table(spark, data, "customer"), ["c_mktsegment", "c_name"], 5)
    return folds.select("c_custkey", "fold")


def train_report(spark: SparkSession, data: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    report = train(charges(spark, data), FEATURES, LABEL, keys, LINE_KEY, "charge")
    return rounded(report.summary(spark), "value", digits=3)


def train_explained(spark: SparkSession, data: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return train(charges(spark, data), FEATURES, LABEL, keys, LINE_KEY, "charge").explanation(spark)


def correlation_wide(spark: SparkSession, data: str) -> DataFrame:
    """Each of the 64 components of the embeddings with each other one."""
    vectors = table(spark, data, "embeddings")
    parts = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)]
    matrix = stats.correlation_matrix(vectors.select(*parts), [f"e{i}" for i in range(64)])
    return rounded(matrix, "r", digits=6)


def correlation_tiles(spark: SparkSession, data: str) -> DataFrame:
    """Components of the embeddings, half of them with gaps, in tiles of a matrix of 100 columns."""
    vectors = table(spark, data, "embeddings")
    parts = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)]
    gaps = [F.when((F.col("vec_id") + i) % 5 != 0, F.get("embedding", F.lit(i)).cast("double") * 2 + 1).alias(f"g{i}") for i in range(36)]
    wide = vectors.select(*parts, *gaps)
    return rounded(tiles.correlation_table(wide, wide.columns, block=24, tasks=4, stripe=7), "r", digits=6)


def describe_decimal(spark: SparkSession, data: str) -> DataFrame:
    price = (cents("o_totalprice") / 100).cast("decimal(38,2)").alias("price")
    summary = stats.describe(table(spark, data, "orders").select(price), ["price"])
    return rounded(summary.withColumn("mean", F.col("mean").cast("double")), "mean", "std", "q25", "q50", "q75")


# Scoring


def with_short_numbers(model: LinearModel) -> LinearModel:
    """Coefficients at four decimals, so that scores are the same in any engine."""
    return LinearModel(
        model.features,
        model.target,
        round(model.intercept, 4),
        tuple(round(c, 4) for c in model.coefficients),
        model.name,
    )


def stored_charge_model(spark: SparkSession, data: str) -> str:
    path = staging_path(spark, "model")
    save_models(spark, [replace(with_short_numbers(charge_model(spark, data)), display="Charge of a line")], path)
    return path


def model_table_roundtrip(spark: SparkSession, data: str) -> DataFrame:
    return read_model_table(spark, stored_charge_model(spark, data)).drop("fitted_at")


def model_versions(spark: SparkSession, data: str) -> DataFrame:
    """Saved, partly replaced, and a save that did not end: every model as of each version."""
    path = staging_path(spark, "models")
    lines = charges(spark, data)
    fits = {c: with_short_numbers(regression.fit(lines, [c], LABEL, c)) for c in FEATURES}
    save_models(spark, list(fits.values()), path)
    save_models(spark, [replace(fits["l_tax"], intercept=-1.5, display="Second"), replace(fits["l_tax"], name="new", target="")], path)
    packed(spark, [replace(fits["l_tax"], intercept=9.0)]).write.parquet(f"{path}/models/run=unfinished")
    asked = [(1, 1), (2, 2), (3, None)]
    found = [read_model_table(spark, path, v).drop("fitted_at").withColumn("asked", F.lit(i)) for i, v in asked]
    return found[0].union(found[1]).union(found[2])


def score_table(spark: SparkSession, data: str) -> DataFrame:
    model = load_models(spark, stored_charge_model(spark, data), ["charge"])["charge"]
    scored = regression.predict(table(spark, data, "lineitem"), model)
    kept = ["l_orderkey", "l_partkey", "l_linenumber", *FEATURES, "prediction"]
    return rounded(scored.select(*kept), "prediction", digits=6)


def score_named_features(spark: SparkSession, data: str) -> DataFrame:
    """The same model on columns that only agree with it after normalization."""
    model = load_models(spark, stored_charge_model(spark, data), ["charge"])["charge"]
    lines = table(spark, data, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("L Extendedprice"),
        F.col("l_discount").alias("L_DISCOUNT!"),
        F.col("l_tax").alias("l táx"),
    )
    renamed = LinearModel(
        ("L_Extendedprice", "l discount", "L_TAX"),
        model.target,
        model.intercept,
        model.coefficients,
        model.name,
    )
    scored = score_named(lines, renamed).select(
        "l_orderkey", "l_linenumber", F.col("L Extendedprice").alias("price"), "prediction"
    )
    return rounded(scored, "prediction", digits=6)


def exercise_models(spark: SparkSession, data: str) -> dict[str, LinearModel]:
    """Two usable models and one with a variable the form does not offer."""
    lines = charges(spark, data)
    renames = {
        "dolar": ("dia", "Inflación", "tasa_interes", "precio_dolar"),
        "glucosa": ("edad", "IMC", "actividad_fisica", "nivel_glucosa"),
        "energia": ("temperatura", "hora", "humedad", "consumo_energia"),
    }
    columns = ["l_quantity", "l_discount", "l_tax"]
    base = with_short_numbers(regression.fit(lines, columns, LABEL))
    models = {
        key: LinearModel(tuple(names[:3]), names[3], base.intercept, base.coefficients, key)
        for key, names in renames.items()
    }
    # One has a display name of its own and leaves the target to the exercise.
    models["glucosa"] = replace(models["glucosa"], display="Glucosa II", target="")
    return models


def scoring_requests(spark: SparkSession, data: str) -> DataFrame:
    """One request per order, with every kind of mistake among them."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 5
    first = F.when(key % 7 == 0, F.lit(" \t\n")).otherwise((key % 50).cast("string"))
    second = (
        F.when(key % 11 == 0, F.lit("abc"))
        .when(key % 17 == 0, F.lit("1d"))
        .when(key % 19 == 0, F.lit("\t1e-2 "))
        .otherwise(F.concat(F.lit(" 0.0"), (key % 10).cast("string")))
    )
    third = F.when(key % 13 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("0.0"), (key % 8).cast("string"))
    )
    exercise = (
        F.when(kind == 0, F.lit("dolar"))
        .when(kind == 1, F.lit("\tglucosa "))
        .when(kind == 2, F.lit("energia"))
        .when(kind == 3, F.lit("euro"))
        .otherwise(F.lit("glucosa"))
    )
    plain = trimmed(exercise)

    def form(*names: str) -> Column:
        pairs = [x for name, v in zip(names, (first, second, third)) for x in (F.lit(name), v)]
        return F.create_map(*pairs)

    fields = (
        F.when(plain == "dolar", form("dia", "inflacion", "tasa_interes"))
        .when(plain == "glucosa", form("edad", "imc", "actividad_fisica"))
        .otherwise(form("temperatura", "hora", "dia_semana"))
    )
    return table(spark, data, "orders").select(
        key.alias("request_id"), exercise.alias("exercise"), fields.alias("fields")
    )


def answer_requests(spark: SparkSession, data: str) -> DataFrame:
    answers = score_requests(
        scoring_requests(spark, data), EXERCISES, exercise_models(spark, data), MESSAGES
    )
    kept = ["request_id", "exercise", "error", "title", "model", "target", "value"]
    return rounded(answers.select(*kept), "value", digits=6)


HOT_ORDER = 7


def order_models(spark: SparkSession, data: str, path: str) -> None:
    """A model for nearly every order, in two versions."""
    key = F.col("o_orderkey")

    def term(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("term"), value.cast("double").alias("coefficient"))

    two = F.array(term("Quantity", key % 7 + 0.5), term("Täx ", key % 5 * 0.25))
    models = table(spark, data, "orders").where(key % 50 != 0).select(
        F.concat(F.lit("m"), key).alias("model"),
        F.when(key % 3 == 0, "").otherwise(F.lit("cost")).alias("target"),
        F.when(key % 10 == 1, F.concat(F.lit("Model of order "), key)).otherwise("").alias("display"),
        (key % 100 / 4).cast("double").alias("intercept"),
        F.when(key % 41 == 0, F.concat(two, F.array(term("Weight", F.lit(1))))).otherwise(two).alias("terms"),
        F.lit(False).alias("rank_deficient"),
        F.lit(None).cast("timestamp").alias("fitted_at"),
        key.alias("key"),
    )
    save_model_rows(models, path)
    save_model_rows(models.where("key % 3 = 1").withColumn("intercept", F.col("intercept") + 1000), path)


def score_requests_many(spark: SparkSession, data: str) -> DataFrame:
    """Every line scored by the model of its order, but nine in ten by the model of one order."""
    path = staging_path(spark, "order-models")
    order_models(spark, data, path)
    key = F.col("o_orderkey")
    fields = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("label")) for n, t in (("quantity", "Quantity"), ("tax", "Tax"))])
    exercises = table(spark, data, "orders").select(
        F.concat(F.lit("e"), key).alias("exercise"),
        F.concat(F.lit("Order "), "o_orderstatus").alias("title"),
        F.concat(F.lit("m"), key).alias("model"),
        F.lit("price").alias("target"),
        F.lit("Model").alias("display"),
        fields.alias("fields"),
    )
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    own = F.when((F.col("l_partkey") + line) % 10 < 9, F.lit(HOT_ORDER)).when(order % 13 == 0, -order).otherwise(order)
    quantity = F.when((order % 17 == 0) & (line == 3), " ").otherwise(F.col("l_quantity").cast("int").cast("string"))
    tax = F.when((order % 19 == 0) & (line == 2), "none").otherwise(F.concat(F.lit(" "), (cents("l_tax") / 100).cast("string")))
    asked = table(spark, data, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.concat(F.lit(" e"), own).alias("exercise"),
        F.create_map(F.lit("quantity"), quantity, F.lit("tax"), tax).alias("fields"),
    )
    return rounded(score_with_many_models(spark, asked, path, exercises).drop("value_text", "l_suppkey"), "value", digits=6)


QUERIES: dict[str, Query] = {
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "csv_headers_many": csv_headers_many,
    "infer_types": infer_types,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "head_rows": head_rows,
    "normalize_columns": normalize_columns,
    "conform_schema": conform_schema,
    "required_columns": required_columns,
    "parse_locale_numbers": parse_locale_numbers,
    "validate_rules": validate_rules,
    "validate_counts": validate_counts,
    "drop_nulls": drop_null_rows,
    "null_counts": null_counts,
    "key_bounds": key_bounds,
    "profile_columns": profile_columns,
    "describe_table": describe_table,
    "correlation_matrix": correlation_matrix,
    "trend_lines": trend_lines,
    "dedup_keep_first": dedup_keep_first,
    "dedup_exact": dedup_exact,
    "gap_fill_global": gap_fill_global,
    "gap_fill_per_key": gap_fill_per_key,
    "carry_forward_backward": carry_forward_backward,
    "impute_global": impute_global,
    "impute_grouped": impute_grouped,
    "impute_grouped_sliced": impute_grouped_sliced,
    "impute_grouped_ties": impute_grouped_ties,
    "impute_grouped_ties_sliced": impute_grouped_ties_sliced,
    "quartiles_exact": quartiles_exact,
    "quartiles_narrowed": quartiles_narrowed,
    "median_exact": median_exact,
    "quartiles_approx": quartiles_approx,
    "iqr_bounds": iqr_bounds,
    "outlier_flags": outlier_flags,
    "winsorize": winsorize,
    "clean_daily_series": clean_daily_series,
    "quality_report": quality_report,
    "clean_csv_daily": clean_csv_daily,
    "clean_readings": clean_readings,
    "clean_measurements": clean_measurements,
    "clean_readings_imputed": clean_readings_imputed,
    "clean_measurements_imputed": clean_measurements_imputed,
    "train_test_split": split_orders,
    "ols_fit": ols_fit,
    "ols_equation": ols_equation,
    "ols_metrics": ols_metrics,
    "performance_band": performance_band,
    "coefficient_sign": coefficient_sign,
    "coefficient_impact": coefficient_impact,
    "cross_validate": cross_validate,
    "cross_validate_by_date": cross_validate_by_date,
    "ols_ill_conditioned": ols_ill_conditioned,
    "folds_by_date": folds_by_date,
    "folds_by_text": folds_by_text,
    "train_report": train_report,
    "train_explained": train_explained,
    "correlation_wide": correlation_wide,
    "correlation_tiles": correlation_tiles,
    "describe_decimal": describe_decimal,
    "model_table_roundtrip": model_table_roundtrip,
    "model_versions": model_versions,
    "score_requests_many": score_requests_many,
    "score_table": score_table,
    "score_named_features": score_named_features,
    "score_requests": answer_requests,
}

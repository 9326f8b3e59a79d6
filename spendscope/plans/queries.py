"""The registered queries: each reads whole test tables and returns a DataFrame.

Most are lazy. Those that write and read back (sources, sinks), or store the interesting users
first so that joins know their size, run jobs while they are built.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope.operators import criteria, gaps, profiles, runmetrics, segments, sketches, stats
from spendscope.operators.features import with_features
from spendscope.operators.quantiles import exact_quantile
from spendscope.operators.usertotals import dimension_stats, user_dimension_totals
from spendscope.params import Params
from spendscope.plans.analysis import analyse
from spendscope.schemas import TRANSACTIONS
from spendscope.session import scratch_path, stored
from spendscope.sources import readers, sinks
from spendscope.sources.testdata import table, transactions

Query = Callable[[SparkSession, str], DataFrame]

# The default thresholds select nearly nobody, or everybody, in the test tables; these select some.
TUNED = Params(
    daily_rate=2.7, distance_km=153, categories=25, gap_seconds=3600, short_gaps=9,
    window_transactions=3, amount_decimals=2,
)
DEFAULTS = Params(amount_decimals=2)
DIGITS = 6

REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def _tx(spark: SparkSession, sf_dir: str, with_state: bool = False, params: Params = TUNED) -> DataFrame:
    return with_features(transactions(spark, sf_dir, with_state), params)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _profiles(spark: SparkSession, sf_dir: str, params: Params = TUNED) -> tuple[DataFrame, DataFrame]:
    tx = _tx(spark, sf_dir, params=params)
    return tx, profiles.user_profiles(tx, params, facets=("category",))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interesting users as a table, so that the planner knows its size."""
    flags = criteria.flag_users(_tx(spark, sf_dir), TUNED)
    return stored(criteria.interesting_users(flags), "interesting-users")


def _totals_and_users(spark: SparkSession, sf_dir: str, dimensions: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """One table of totals for both the criteria and the comparison, and the interesting users."""
    tx = _tx(spark, sf_dir, with_state="state" in dimensions)
    totals = stored(user_dimension_totals(tx, list(dict.fromkeys([*dimensions, "category"])), TUNED), "totals")
    built = profiles.user_profiles(tx, TUNED, facets=("category",), totals=totals)
    users = stored(criteria.interesting_users(criteria.user_flags(built, tx, TUNED)), "interesting-users")
    return totals.where(F.col("dimension").isin(*dimensions)), users


# Sources and sinks


@query
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "transactions-csv")
    sinks.write_csv(transactions(spark, sf_dir), path)
    return readers.read_csv(spark, path + "-absent", path)


@query
def csv_scan_inferred(spark, sf_dir):
    path = scratch_path(spark, "transactions-csv")
    sinks.write_csv(transactions(spark, sf_dir), path)
    read = readers.read_csv_inferred(spark, path)
    types = F.lit(", ".join(f"{c} {t}" for c, t in read.dtypes))
    typed = (F.col(c).cast(TRANSACTIONS[c].dataType).alias(c) for c in read.columns)
    return read.select(*typed, types.alias("inferred_types"))


@query
def csv_scan_lenient(spark, sf_dir):
    """Good and bad rows by user, where some amounts and users are no numbers and some times no times."""
    number = F.col("trans_num")
    path = scratch_path(spark, "transactions-csv")
    spoilt = transactions(spark, sf_dir).withColumns(
        {
            "amt": F.when(number % 97 == 0, F.lit("1,250.00")).otherwise(F.col("amt").cast("string")),
            "trans_date_trans_time": F.when(number % 89 == 0, F.lit("never")).otherwise(
                F.col("trans_date_trans_time").cast("string")
            ),
            "cc_num": F.when(number % 83 == 0, F.lit("unknown")).otherwise(F.col("cc_num").cast("string")),
        }
    )
    sinks.write_csv(spoilt, path)
    read = readers.read_csv(spark, path, lenient=True)
    return read.groupBy("cc_num").agg(
        F.count_if(F.col(readers.CORRUPT).isNull()).alias("good_rows"),
        F.count(readers.CORRUPT).alias("bad_rows"),
        F.count("amt").alias("amounts"),
        F.count("trans_date_trans_time").alias("times"),
    )


@query
def parquet_result_sink(spark, sf_dir):
    path = scratch_path(spark, "category-stats")
    sinks.write_parquet(stats.category_stats(_tx(spark, sf_dir), TUNED), path)
    return readers.read_parquet(spark, path)


@query
def table_shape(spark, sf_dir):
    return stats.table_shape(transactions(spark, sf_dir))


@query
def preview_rows(spark, sf_dir):
    return stats.preview(transactions(spark, sf_dir), 5, "trans_num")


def _with_gaps_in_columns(spark, sf_dir):
    return stats.null_out(
        transactions(spark, sf_dir), {"category": "cat_7", "merchant": "m_42", "amt": 10.0}
    )


@query
def column_profile(spark, sf_dir):
    return stats.column_profile(_with_gaps_in_columns(spark, sf_dir))


@query
def type_counts(spark, sf_dir):
    return stats.type_counts(stats.column_profile(_with_gaps_in_columns(spark, sf_dir)))


@query
def missing_values(spark, sf_dir):
    return stats.missing_values(stats.column_profile(_with_gaps_in_columns(spark, sf_dir)))


# Features


@query
def features(spark, sf_dir):
    tx = _tx(spark, sf_dir).select(
        "trans_num", "cc_num", "trans_date_trans_time", "hour", "day_of_week", "is_weekend", "month",
        "amount_bin", "geo_distance_km",
    )
    return _rounded(tx, "geo_distance_km")


@query
def features_without_position(spark, sf_dir):
    """Input that lacks the position columns: the distance is NULL, and so are statistics of it."""
    tx = with_features(transactions(spark, sf_dir).drop("lat", "merch_long"), TUNED)
    return tx.groupBy("category").agg(
        F.count(F.lit(1)).alias("rows"), F.count("geo_distance_km").alias("distances"), F.max("hour").alias("last_hour")
    )


@query
def renamed_by_position(spark, sf_dir):
    return stats.hourly_stats(_tx(spark, sf_dir), TUNED).toDF("hour_of_day", "purchases", "mean_amount", "people")


@query
def amount_bin_hist(spark, sf_dir):
    return stats.amount_bin_counts(_tx(spark, sf_dir))


@query
def amount_bin_hist_nullable(spark, sf_dir):
    shifted = transactions(spark, sf_dir).withColumn("amt", F.col("amt") - 5)
    return stats.amount_bin_counts(with_features(shifted, Params(null_bin=True)))


# Statistics


@query
def category_stats(spark, sf_dir):
    return stats.category_stats(_tx(spark, sf_dir), TUNED)


@query
def category_stats_ext(spark, sf_dir):
    return stats.category_stats_extended(_tx(spark, sf_dir), TUNED)


@query
def hourly_stats(spark, sf_dir):
    return stats.hourly_stats(_tx(spark, sf_dir), TUNED)


@query
def state_stats(spark, sf_dir):
    return stats.state_stats(_tx(spark, sf_dir, with_state=True), TUNED)


@query
def top_category(spark, sf_dir):
    return stats.top_categories(stats.category_stats(_tx(spark, sf_dir), TUNED), 1).select("category")


@query
def top10_categories(spark, sf_dir):
    return stats.top_categories(stats.category_stats(_tx(spark, sf_dir), TUNED), 10)


@query
def peak_hour_global(spark, sf_dir):
    return stats.busiest_hour(stats.hourly_stats(_tx(spark, sf_dir), TUNED))


# Mergeable summaries, each held against the exact result


def _in_parts(tx, n=3):
    """The rows as several inputs that don't know of each other."""
    return [tx.where(F.col("trans_num") % n == i) for i in range(n)]


def _within(estimated, exact, error):
    return (F.abs(F.col(estimated) - F.col(exact)) <= F.col(exact) * error).alias("within_bound")


@query
def distinct_users_sketch(spark, sf_dir):
    """Users per category, hour and state by merging the sketches of three inputs."""
    tx = _tx(spark, sf_dir, with_state=True)
    dimensions = ("category", "hour", "state")
    merged = sketches.merge_dimension_sketches(
        *(sketches.dimension_sketches(part, dimensions, TUNED) for part in _in_parts(tx))
    )
    totals = user_dimension_totals(tx, dimensions, TUNED)
    compared = []
    for d in dimensions:
        exact = dimension_stats(totals, d, "transactions").withColumnRenamed(d, "value")
        found = sketches.sketched_stats(merged, d, "merged").withColumnRenamed("unique_users", "estimated")
        found = found.withColumnRenamed("avg_amount", "merged_amount").withColumnRenamed(d, "name")
        both = exact.join(found, F.col("value").eqNullSafe(F.col("name")))
        same = (F.col("merged") == F.col("transactions")) & F.col("merged_amount").eqNullSafe(F.col("avg_amount"))
        compared.append(
            both.select(
                F.lit(d).alias("dimension"), "value", "transactions", "unique_users", same.alias("same_totals"),
                _within("estimated", "unique_users", sketches.distinct_error()),
            )
        )
    return compared[0].union(compared[1]).union(compared[2])


@query
def user_facets_sketch(spark, sf_dir):
    """Distinct categories and merchants per user by merging the sketches of three inputs."""
    tx = _tx(spark, sf_dir)
    facets = ("category", "merchant")
    merged = sketches.merge_user_sketches(*(sketches.user_sketches(part, facets) for part in _in_parts(tx)))
    found = sketches.sketched_facets(merged).toDF("user", "some_categories", "some_merchants")
    exact = profiles.user_facets(user_dimension_totals(tx, facets, TUNED), facets)
    error = sketches.distinct_error()
    return exact.join(found, F.col("cc_num").eqNullSafe(F.col("user"))).select(
        *exact.columns,
        (_within("some_categories", "unique_categories", error) & _within("some_merchants", "unique_merchants", error)).alias("within_bound"),
    )


@query
def amount_quantiles_sketch(spark, sf_dir):
    """Quantiles of the amounts per category by merging the sketches of three inputs: is their rank near enough?"""
    tx = transactions(spark, sf_dir)
    merged = sketches.merge_value_sketches(*(sketches.value_sketches(part, "amt", ["category"]) for part in _in_parts(tx)))
    error = sketches.rank_error()
    compared = []
    for p in (0.5, 0.95):
        found = sketches.sketched_quantile(merged, p, "found").withColumnRenamed("category", "name")
        ranks = tx.join(found, F.col("category").eqNullSafe(F.col("name"))).groupBy("category").agg(
            F.count("amt").alias("n"),
            F.count_if(F.col("amt") < F.col("found")).alias("below"),
            F.count_if(F.col("amt") <= F.col("found")).alias("upto"),
        )
        near = (F.col("below") <= F.col("n") * (p + error)) & (F.col("upto") >= F.col("n") * (p - error))
        compared.append(ranks.select("category", F.lit(p).alias("p"), "n", near.alias("within_bound")))
    return compared[0].union(compared[1])


# Profiles


@query
def user_base_profile(spark, sf_dir):
    built = profiles.user_profiles(_tx(spark, sf_dir), TUNED, facets=("category", "merchant"))
    return _rounded(built, "std_transaction", "avg_geo_distance").drop(
        "avg_distance", "max_distance", "std_distance"
    )


@query
def user_span_exact(spark, sf_dir):
    built = profiles.user_totals(_tx(spark, sf_dir), replace(TUNED, span="exact"))
    return built.select("cc_num", "activity_span_days", "transactions_per_day")


@query
def user_hour_counts(spark, sf_dir):
    return profiles.user_hour_counts(_tx(spark, sf_dir))


@query
def user_peak_hour(spark, sf_dir):
    return profiles.peak_hours(_tx(spark, sf_dir))


@query
def user_peak_hour_ranked(spark, sf_dir):
    return profiles.peak_hours_ranked(_tx(spark, sf_dir))


@query
def user_geo_stats(spark, sf_dir):
    built = profiles.fill_deviations(profiles.user_geo_stats(_tx(spark, sf_dir), TUNED))
    return _rounded(built, "avg_distance", "max_distance", "std_distance")


@query
def user_profiles(spark, sf_dir):
    built = profiles.user_profiles(_tx(spark, sf_dir), TUNED)
    return _rounded(
        built, "std_transaction", "avg_geo_distance", "avg_distance", "max_distance", "std_distance"
    )


# Criteria


@query
def high_frequency(spark, sf_dir):
    return criteria.high_frequency(profiles.user_totals(_tx(spark, sf_dir), TUNED), TUNED)


@query
def high_frequency_exact_span(spark, sf_dir):
    params = replace(TUNED, span="exact")
    return criteria.high_frequency(profiles.user_totals(_tx(spark, sf_dir), params), params)


@query
def geo_mobile(spark, sf_dir):
    return criteria.geo_mobile(profiles.user_totals(_tx(spark, sf_dir), TUNED), TUNED)


@query
def diverse(spark, sf_dir):
    totals = user_dimension_totals(_tx(spark, sf_dir), ["category"], TUNED)
    return criteria.diverse(profiles.user_facets(totals, ["category"]), TUNED)


@query
def amount_threshold_rank(spark, sf_dir):
    return criteria.amount_threshold(profiles.user_totals(_tx(spark, sf_dir), TUNED), params=TUNED)


@query
def amount_threshold_interp(spark, sf_dir):
    params = replace(TUNED, amount_method="interpolated")
    found = criteria.amount_threshold(profiles.user_totals(_tx(spark, sf_dir), params), params=params)
    return _rounded(found, "threshold")


@query
def amount_threshold_all_tx(spark, sf_dir):
    return exact_quantile(transactions(spark, sf_dir), "amt", TUNED.amount_quantile)


@query
def high_amount(spark, sf_dir):
    return criteria.high_amount(profiles.user_totals(_tx(spark, sf_dir), TUNED), params=TUNED)


@query
def high_amount_interp(spark, sf_dir):
    params = replace(TUNED, amount_method="interpolated")
    return criteria.high_amount(profiles.user_totals(_tx(spark, sf_dir), params), params=params)


@query
def high_amount_all_tx(spark, sf_dir):
    # The users' averages stay far below the 95th percentile of all amounts here, but not below the 70th.
    params = replace(TUNED, amount_population="transactions", amount_quantile=0.7)
    tx = _tx(spark, sf_dir)
    return criteria.high_amount(profiles.user_totals(tx, params), tx, params)


@query
def tx_gaps(spark, sf_dir):
    found = gaps.with_gaps(transactions(spark, sf_dir), TUNED)
    return found.select("trans_num", "cc_num", "trans_date_trans_time", "time_diff")


@query
def tx_gaps_exact(spark, sf_dir):
    found = gaps.with_gaps(transactions(spark, sf_dir), replace(TUNED, gap="exact"))
    return found.select("trans_num", "cc_num", "trans_date_trans_time", "time_diff")


@query
def short_gap_counts(spark, sf_dir):
    return gaps.short_gap_counts(transactions(spark, sf_dir), TUNED)


@query
def burst_users(spark, sf_dir):
    return gaps.burst_users(transactions(spark, sf_dir), TUNED)


@query
def burst_users_exact(spark, sf_dir):
    return gaps.burst_users(transactions(spark, sf_dir), replace(TUNED, gap="exact"))


@query
def burst_users_window(spark, sf_dir):
    return gaps.window_burst_users(transactions(spark, sf_dir), TUNED)


@query
def user_flags(spark, sf_dir):
    return criteria.flag_users(_tx(spark, sf_dir), TUNED)


@query
def user_flags_defaults(spark, sf_dir):
    return criteria.flag_users(_tx(spark, sf_dir, params=DEFAULTS), DEFAULTS)


@query
def user_flags_prototype(spark, sf_dir):
    params = replace(TUNED, span="exact", amount_method="interpolated", gap="exact")
    return criteria.flag_users(_tx(spark, sf_dir), params)


@query
def interesting_users(spark, sf_dir):
    return criteria.interesting_users(criteria.flag_users(_tx(spark, sf_dir), TUNED))


@query
def interesting_users_union(spark, sf_dir):
    tx, built = _profiles(spark, sf_dir)
    return criteria.interesting_users_union(built, tx, TUNED)


@query
def interesting_summary(spark, sf_dir):
    return criteria.interesting_summary(criteria.flag_users(_tx(spark, sf_dir), TUNED))


# Segments


@query
def segment_row_share(spark, sf_dir):
    return segments.row_share_of(*_totals_and_users(spark, sf_dir, ("hour",)))


def _segment_columns(df):
    return df.select("trans_num", "cc_num", "trans_date_trans_time", "category", "amt", "amount_bin")


@query
def segment_interesting(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return _segment_columns(segments.interesting_transactions(tx, _users(spark, sf_dir)))


@query
def segment_normal(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return _segment_columns(segments.normal_transactions(tx, _users(spark, sf_dir)))


def _compared(spark, sf_dir, dimension):
    compared = segments.compare_totals(*_totals_and_users(spark, sf_dir, (dimension,))).drop("dimension")
    own = _tx(spark, sf_dir, with_state=dimension == "state").schema[dimension].dataType
    return compared.withColumn("value", F.col("value").cast(own)).withColumnRenamed("value", dimension)


@query
def compare_category(spark, sf_dir):
    return _compared(spark, sf_dir, "category")


@query
def compare_hour(spark, sf_dir):
    return _compared(spark, sf_dir, "hour")


@query
def compare_state(spark, sf_dir):
    return _compared(spark, sf_dir, "state")


@query
def compare_amount_bin(spark, sf_dir):
    return _compared(spark, sf_dir, "amount_bin")


@query
def compare_all_dimensions(spark, sf_dir):
    return segments.compare_totals(*_totals_and_users(spark, sf_dir, segments.DIMENSIONS))


@query
def compare_category_by_join(spark, sf_dir):
    interesting, normal = segments.split(_tx(spark, sf_dir), _users(spark, sf_dir))
    return segments.compare_split(normal, interesting, "category", TUNED)


@query
def top_over_represented(spark, sf_dir):
    return segments.over_represented(_compared(spark, sf_dir, "category"))


# The whole analysis, one of its tables each


def _analysed(spark, sf_dir):
    return analyse(transactions(spark, sf_dir, with_state=True), TUNED)


@query
def whole_analysis_categories(spark, sf_dir):
    return _analysed(spark, sf_dir).category_stats


@query
def whole_analysis_hours(spark, sf_dir):
    return _analysed(spark, sf_dir).hourly_stats


@query
def whole_analysis_states(spark, sf_dir):
    return _analysed(spark, sf_dir).state_stats


@query
def whole_analysis_flags(spark, sf_dir):
    return _analysed(spark, sf_dir).flags


@query
def whole_analysis_row_share(spark, sf_dir):
    return _analysed(spark, sf_dir).row_share


@query
def whole_analysis_comparison(spark, sf_dir):
    return _analysed(spark, sf_dir).comparison


@query
def whole_analysis_tops(spark, sf_dir):
    """Most frequent categories, most over-represented ones, and the busiest hour."""
    done = _analysed(spark, sf_dir)
    return (
        done.top_categories.select(F.lit("category").alias("kind"), "category", F.col("total_transactions").alias("n"))
        .union(done.over_represented.select(F.lit("over"), "category", F.lit(None).cast("long")))
        .union(done.peak_hour.select(F.lit("hour"), F.col("peak_hour").cast("string"), "transaction_count"))
    )


# Run metrics, measured on lineitem: line status is the variant, return flag the stage


def _experiment():
    nodes = F.when(F.col("l_linenumber") % 2 == 0, "1dn").otherwise("3dn")
    variant = F.when(F.col("l_linestatus") == "O", "optimized").otherwise("base")
    return F.concat_ws("_", F.lit("exp"), nodes, variant)


def _run_metrics(spark, sf_dir):
    """Four runs in the nested layout; a run has as many stages as there are return flags."""
    stage_times = (
        table(spark, sf_dir, "lineitem")
        .groupBy(_experiment().alias("experiment_name"), "l_returnflag")
        .agg(
            F.sum("l_quantity").alias("seconds"),
            F.count(F.lit(1)).alias("n"),
            F.max("l_linenumber").alias("lines"),
        )
    )
    return stage_times.groupBy("experiment_name").agg(
        F.sum("seconds").alias("total_execution_time_sec"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("l_returnflag", "seconds")))).alias("stages"),
        F.struct(
            (F.max("lines") * 1024).cast("int").alias("driver_memory_mb"),
            F.lit(1024).alias("executor_memory_mb"),
            (F.sum("lines") * 1024).cast("int").alias("total_executor_memory_mb"),
            F.max("lines").cast("int").alias("num_executors"),
        ).alias("memory_allocated"),
        F.sum("n").alias("rows_processed"),
    )


def _flat_runs(spark, sf_dir):
    path = scratch_path(spark, "metrics-json")
    sinks.write_json(_run_metrics(spark, sf_dir), path)
    return runmetrics.flatten_metrics(readers.read_metrics_json(spark, path))


@query
def metrics_scan_json(spark, sf_dir):
    return _flat_runs(spark, sf_dir).select("*", F.explode("stages").alias("stage", "seconds")).drop("stages")


@query
def metrics_csv_sink(spark, sf_dir):
    path = scratch_path(spark, "metrics-csv")
    sinks.write_csv(_flat_runs(spark, sf_dir), path)
    read = spark.read.options(**readers.CSV_OPTIONS).csv(path)
    return read.select(
        "experiment", F.col("execution_time").cast("double"), F.col("rows_processed").cast("bigint"),
        F.explode(F.from_json("stages", "map<string,double>")).alias("stage", "seconds"),
    )


@query
def metrics_kv_fallback(spark, sf_dir):
    runs = _run_metrics(spark, sf_dir)
    on_three = F.col("experiment_name").contains("3dn")
    json_path, text_path = scratch_path(spark, "metrics-json"), scratch_path(spark, "metrics-text")
    sinks.write_json(
        runs.withColumn("total_execution_time_sec", F.when(~on_three, F.col("total_execution_time_sec"))),
        json_path,
    )
    # One run without a time in either place must be dropped.
    lines = F.array(
        F.concat(F.lit("execution_time_sec="), F.col("total_execution_time_sec").cast("string")),
        F.concat(F.lit("rows_processed="), F.col("rows_processed").cast("string")),
    )
    sinks.write_metrics_text(
        runs.where(F.col("experiment_name") != "exp_3dn_base").select(
            F.col("experiment_name").alias("experiment"), F.explode(lines).alias("line")
        ),
        text_path,
    )
    flat = runmetrics.flatten_metrics(readers.read_metrics_json(spark, json_path))
    text = readers.read_metrics_text(spark, text_path)
    return runmetrics.with_text_fallback(flat, text).select("experiment", "execution_time", "rows_processed")


@query
def metrics_labels(spark, sf_dir):
    return runmetrics.with_labels(
        _run_metrics(spark, sf_dir).select(F.col("experiment_name").alias("experiment"))
    )


@query
def stage_rows(spark, sf_dir):
    return runmetrics.stage_rows(_run_metrics(spark, sf_dir), "experiment_name")


@query
def variant_ratio(spark, sf_dir):
    return runmetrics.variant_ratio(
        table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity", "F", "O"
    )


@query
def speedups(spark, sf_dir):
    runs = _run_metrics(spark, sf_dir)
    return runmetrics.speedups(runs, name="experiment_name", value="total_execution_time_sec")


@query
def memory_totals(spark, sf_dir):
    return runmetrics.with_memory_total(runmetrics.flatten_metrics(_run_metrics(spark, sf_dir))).select(
        "experiment", "driver_memory_mb", "total_executor_memory_mb", "total_memory_mb"
    )

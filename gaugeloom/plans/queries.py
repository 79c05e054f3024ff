"""Named queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.functions.payload import parse_payload
from gaugeloom.functions.text import cells_match, valid_series_name
from gaugeloom.operators import (
    arima,
    clean,
    compare,
    diagnose,
    lags,
    profile,
    readings,
    resample,
    series,
)
from gaugeloom.plans.stages import run_pipeline, stage_counts
from gaugeloom.scale import new_shared_path, number_rows, stage
from gaugeloom.schema import GRID_POINTS, KEY, Mode, PipelineOptions
from gaugeloom.sources import adapters, pages, paging, sinks

Query = Callable[[SparkSession, str], DataFrame]

# Grid size of the registered queries: that of the operators.
POINTS = GRID_POINTS
PAGE = 1000


def _rounded(column: str, digits: int) -> Column:
    return F.round(column, digits).alias(column)


def _events(spark: SparkSession, directory: str) -> DataFrame:
    return adapters.table(spark, directory, "events")


def _readings(spark: SparkSession, directory: str) -> DataFrame:
    return adapters.events_readings(_events(spark, directory))


def _legacy_readings(spark: SparkSession, directory: str) -> DataFrame:
    return adapters.legacy_events_readings(_events(spark, directory))


def _features(spark: SparkSession, directory: str) -> DataFrame:
    return readings.parse_feature_rows(_readings(spark, directory), Mode.CORRECTED)


def _legacy_features(spark: SparkSession, directory: str) -> DataFrame:
    return readings.parse_feature_rows(_legacy_readings(spark, directory), Mode.LEGACY)


def _series(spark: SparkSession, directory: str) -> DataFrame:
    return series.split_numeric_series(_features(spark, directory), Mode.CORRECTED)


def _cleaned(spark: SparkSession, directory: str) -> DataFrame:
    return clean.remove_outliers(stage(_series(spark, directory), "series"))


def _orders(spark: SparkSession, directory: str) -> DataFrame:
    return adapters.orders_series(adapters.table(spark, directory, "orders"))


def _lineitem(spark: SparkSession, directory: str) -> DataFrame:
    return adapters.lineitem_series(adapters.table(spark, directory, "lineitem"))


def _grid(spark: SparkSession, directory: str, **options) -> DataFrame:
    return resample.interpolate_series(_cleaned(spark, directory), POINTS, **options)


def _lines(spark: SparkSession, directory: str) -> DataFrame:
    """The lines of the grid, staged: several passes read them."""
    return stage(resample.grid_lines(_cleaned(spark, directory), POINTS), "lines")


def _lined(spark: SparkSession, directory: str) -> DataFrame:
    return lags.of_lines(_lines(spark, directory), POINTS)


# --- sources, paging, sinks --------------------------------------------------


def read_pages(spark, directory):
    """Number pages, write them as `SqlData{n}.csv` once, read them by column name."""
    path = new_shared_path(spark, "pages")
    numbered = paging.keyset_pages(_readings(spark, directory), ("seq",), PAGE)
    pages.write_page_files(numbered, path)
    return pages.read_pages(spark, path).select(
        "page_no", "sn", "date", "data", "slave_id", "type_id"
    )


def read_page_rows(spark, directory):
    """The same pages as one folder of page rows."""
    path = new_shared_path(spark, "pages")
    numbered = paging.keyset_pages(_readings(spark, directory), ("seq",), PAGE)
    pages.write_pages(numbered, path)
    return pages.read_page_rows(spark, path).select(
        "page_no", "sn", "date", "data", "slave_id", "type_id"
    )


def _order_pages(table: DataFrame) -> DataFrame:
    return table.select("page_no", "row_number", "o_custkey", "o_orderkey")


def offset_pages(spark, directory):
    orders = adapters.table(spark, directory, "orders")
    return _order_pages(paging.offset_pages(orders, ("o_custkey", "o_orderkey"), PAGE))


def keyset_pages(spark, directory):
    orders = adapters.table(spark, directory, "orders")
    return _order_pages(paging.keyset_pages(orders, ("o_custkey", "o_orderkey"), PAGE))


def keyset_page(spark, directory):
    """The page after a composite key."""
    orders = adapters.table(spark, directory, "orders")
    return paging.keyset_page(
        orders, ("o_custkey", "o_orderkey"), (50, 700), PAGE
    ).select("o_custkey", "o_orderkey", "o_totalprice")


def page_numbering(spark, directory):
    """Numbering by a key that is not unique: the other columns decide."""
    lineitem = adapters.table(spark, directory, "lineitem")
    keys = (
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    return paging.page_numbering(lineitem, keys, PAGE).select(
        "row_number", "page_no", "l_orderkey", "l_linenumber", "l_partkey"
    )


def last_key(spark, directory):
    orders = adapters.table(spark, directory, "orders")
    keys = ("o_custkey", "o_orderkey")
    return paging.last_key(paging.keyset_pages(orders, keys, PAGE), keys)


def page_summary(spark, directory):
    orders = adapters.table(spark, directory, "orders")
    both = (
        paging.page_summary(orders, mode, PAGE).withColumn("mode", F.lit(mode.value))
        for mode in (Mode.LEGACY, Mode.CORRECTED)
    )
    legacy, corrected = both
    return legacy.unionByName(corrected)


def write_series(spark, directory):
    """Write the series once, read them back, count each."""
    path = new_shared_path(spark, "written")
    sinks.write_series(_series(spark, directory), path)
    written = spark.read.parquet(path)
    return written.groupBy(*KEY).agg(
        F.count("*").alias("rows"),
        F.count_distinct("bucket").alias("folders"),
        F.round(F.sum("value"), 4).alias("total"),
    )


def read_series(spark, directory):
    """Write the series and their index, then read some devices' series through it."""
    path = new_shared_path(spark, "indexed")
    sinks.write_series(_series(spark, directory), path)
    sinks.index_series(spark, path)
    wanted = [("1", "k"), ("1", "value"), ("7", "value"), ("none", "value")]
    return sinks.read_series(spark, path, wanted).drop("bucket")


def write_once(spark, directory):
    """Write the readings once, read them back."""
    path = new_shared_path(spark, "written")
    sinks.write_once(_readings(spark, directory), path)
    return spark.read.parquet(path)


def valid_names(spark, directory):
    """Name check over page addresses, documents' sources and customer names."""
    names = (
        adapters.table(spark, directory, "pages").select(F.col("url").alias("name"))
    ).unionAll(
        adapters.table(spark, directory, "customer").select("c_name")
    ).unionAll(
        adapters.table(spark, directory, "documents").select("text")
    )
    return names.groupBy(valid_series_name(F.col("name")).alias("valid")).agg(
        F.count("*").alias("names")
    )


# --- readings and payloads ---------------------------------------------------


def select_raw(spark, directory):
    return readings.select_raw(_readings(spark, directory))


def group_by_device(spark, directory):
    """Two pages together, per device."""
    both = [_readings(spark, directory), _legacy_readings(spark, directory)]
    return readings.device_counts(readings.group_by_device(both))


def distinct_devices(spark, directory):
    return readings.distinct_devices(_readings(spark, directory))


def _pairs(table: DataFrame, mode: Mode) -> DataFrame:
    return table.select(
        "sn",
        "seq",
        F.posexplode(parse_payload(F.col("data"), mode)).alias("pos", "entry"),
    ).select("sn", "seq", "pos", "entry.feature", "entry.value")


def parse_payload_corrected(spark, directory):
    return _pairs(_readings(spark, directory), Mode.CORRECTED)


def parse_payload_literal(spark, directory):
    """Corrected mode on dict literals with u'' text."""
    return _pairs(_legacy_readings(spark, directory), Mode.CORRECTED)


def parse_payload_legacy(spark, directory):
    return _pairs(_legacy_readings(spark, directory), Mode.LEGACY)


def parse_payload_legacy_json(spark, directory):
    """Legacy rules on JSON whose first value is a bare number: no pairs."""
    table = _readings(spark, directory)
    return table.select(
        "sn",
        "seq",
        F.size(parse_payload(F.col("data"), Mode.LEGACY)).alias("entries"),
    )


def parse_feature_rows(spark, directory):
    return _features(spark, directory)


def bad_payloads(spark, directory):
    """Conversation turns are no payloads."""
    turns = adapters.table(spark, directory, "conversations").select(
        "conv_id", "turn", F.col("text").alias("data")
    )
    return readings.bad_payloads(turns).select("conv_id", "turn")


def bad_readings(spark, directory):
    """Payloads of both spellings, those of high values without their last mark."""
    events = _events(spark, directory)
    high = events.where("value > 25").select(F.col("event_id").alias("seq"))
    both = _readings(spark, directory).unionByName(
        _legacy_readings(spark, directory).withColumn("seq", -F.col("seq") - 1)
    )
    damaged = both.join(high.withColumn("high", F.lit(True)), "seq", "left").withColumn(
        "data", F.when(F.col("high"), F.expr("left(data, length(data) - 1)")).otherwise(F.col("data"))
    )
    return readings.bad_payloads(damaged).select("seq", "sn", "data")


def device_positions(spark, directory):
    """Devices numbered in the order of their text."""
    devices = readings.distinct_devices(_readings(spark, directory))
    return number_rows(devices, ["sn"], name="position").select("position", "sn")


def feature_order(spark, directory):
    return readings.feature_order(_legacy_features(spark, directory))


def pivot_features(spark, directory):
    return readings.pivot_features(
        _legacy_features(spark, directory), ("k", "value", "label", "paid")
    )


def merge_and_sort(spark, directory):
    features = _features(spark, directory)
    chunks = [features.where("feature = 'k'"), features.where("feature = 'value'")]
    wide = [
        readings.pivot_features(chunk, (name,))
        for chunk, name in zip(chunks, ("k", "value"))
    ]
    k, value = wide
    value = value.withColumn("seq", F.col("seq") + F.lit(1 << 40))
    return readings.merge_and_sort([k, value]).select(
        "sn", "date", "position", "k", "value"
    )


def merge_and_sort_all(spark, directory):
    """A chunk per feature, none left out, in the order of their names."""
    return readings.merge_features(_features(spark, directory)).select(
        "sn", "date", "position", "feature", "value"
    )


# --- series and cleaning -----------------------------------------------------


def split_numeric_corrected(spark, directory):
    return _series(spark, directory)


def split_numeric_legacy(spark, directory):
    features = stage(_legacy_features(spark, directory), "features")
    return series.split_numeric_series(features, Mode.LEGACY)


def split_numeric_booleans(spark, directory):
    """Series of JSON booleans become 1 and 0 unless numbers are among them."""
    flagged = adapters.flagged_events_readings(_events(spark, directory))
    features = stage(readings.parse_feature_rows(flagged, Mode.CORRECTED), "features")
    return series.split_numeric_series(features, Mode.CORRECTED, booleans=True)


def legacy_float_series(spark, directory):
    features = stage(_legacy_features(spark, directory), "features")
    return series.legacy_float_series(features)


def drop_nulls(spark, directory):
    """Feature rows whose text is a number, the others being NULL."""
    cells = _features(spark, directory).withColumn(
        "value", F.col("value").try_cast("double")
    )
    return series.drop_nulls(cells).select(*KEY, "date", "seq", "value")


def _quantile_columns(table: DataFrame) -> DataFrame:
    return table.select(
        *KEY, "n", _rounded("q25", 6), _rounded("q50", 6), _rounded("q75", 6)
    )


def legacy_quantile(spark, directory):
    return _quantile_columns(
        clean.legacy_quantiles(stage(_series(spark, directory), "series"))
    )


def legacy_quantile_lineitem(spark, directory):
    return _quantile_columns(clean.legacy_quantiles(_lineitem(spark, directory)))


def outlier_bounds(spark, directory):
    bounds = clean.outlier_bounds(stage(_series(spark, directory), "series"))
    return bounds.select(
        *KEY,
        "n",
        *(_rounded(name, 6) for name in ("q25", "q75", "iqr", "lower", "upper")),
        "n_dropped",
    )


def remove_outliers(spark, directory):
    return _cleaned(spark, directory)


def remove_outliers_orders(spark, directory):
    return clean.remove_outliers(_orders(spark, directory))


def remove_outliers_lineitem(spark, directory):
    return (
        clean.remove_outliers(_lineitem(spark, directory))
        .groupBy(*KEY)
        .agg(F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total"))
    )


def finite_check(spark, directory):
    """Logarithms of quantities shifted to zero are not all finite."""
    lineitem = _lineitem(spark, directory)
    logs = lineitem.withColumn(
        "value",
        F.when(F.col("value") == 1, F.lit(float("-inf"))).otherwise(F.col("value")),
    )
    return logs.groupBy(*KEY, profile.is_finite(F.col("value")).alias("finite")).agg(
        F.count("*").alias("rows")
    )


# --- time and grid -----------------------------------------------------------


def epoch_seconds(spark, directory):
    return resample.epoch_seconds(_cleaned(spark, directory))


def dedupe_timestamps(spark, directory):
    return resample.dedupe_timestamps(_lineitem(spark, directory))


def linspace_grid(spark, directory):
    return resample.linspace_grid(_cleaned(spark, directory), POINTS).select(
        *KEY, "idx", _rounded("time", 3)
    )


def interpolate_series(spark, directory):
    return _grid(spark, directory).select(
        *KEY, "idx", _rounded("time", 3), _rounded("data", 6)
    )


def interpolate_legacy(spark, directory):
    """Events come in no order of time: times are sorted, values stay in event order.

    The whole grid, summed up by series and 1,000 points.
    """
    grid = resample.interpolate_series(
        _cleaned(spark, directory), POINTS, mode=Mode.LEGACY, order=("seq",)
    )
    return grid.groupBy(*KEY, F.floor(F.col("idx") / 1000).alias("block")).agg(
        F.count("*").alias("points"),
        F.round(F.avg("time"), 2).alias("time"),
        F.round(F.avg("data"), 6).alias("data"),
        F.round(F.min("data"), 6).alias("low"),
        F.round(F.max("data"), 6).alias("high"),
    )


def zip_in_input_order(spark, directory):
    """Long day-grained series: sorted times beside values in row order."""
    return resample.zip_in_input_order(_lineitem(spark, directory), ("seq",)).select(
        *KEY, F.col("time").cast("double").alias("time"), "data"
    )


def interpolate_lineitem(spark, directory):
    """Long day-grained series with many rows per time."""
    return resample.interpolate_series(_lineitem(spark, directory), POINTS).select(
        *KEY, "idx", _rounded("time", 3), _rounded("data", 6)
    )


# --- profiles ----------------------------------------------------------------


def summary_statistics(spark, directory):
    return profile.summary_statistics(_grid(spark, directory)).select(
        *KEY, "file", _rounded("var", 6), _rounded("mean", 9)
    )


def statistics_order(spark, directory):
    """Statistics of raw series in the order of their file names."""
    statistics = profile.summary_statistics(_cleaned(spark, directory), "value")
    return profile.in_file_order(statistics).select(
        "position", "file", _rounded("mean", 9)
    )


def _trend_columns(table: DataFrame) -> DataFrame:
    return table.select(*KEY, "file", _rounded("coef", 10), _rounded("intercept", 2))


def linear_trend(spark, directory):
    return _trend_columns(profile.linear_trend(_cleaned(spark, directory)))


def linear_trend_from_timestamps(spark, directory):
    return _trend_columns(
        profile.linear_trend_from_timestamps(_grid(spark, directory))
    )


def histogram(spark, directory):
    """Grid values to 6 digits, so that no bin hangs on the last bit."""

    def points(lines: DataFrame, *keep: str) -> DataFrame:
        return resample.grid_points(lines, POINTS, *keep).withColumn("data", F.round("data", 6))

    return profile.histogram(_lines(spark, directory), points=points)


def series_plot_data(spark, directory):
    return profile.series_plot_data(_cleaned(spark, directory), 20)


def series_points(spark, directory):
    return profile.series_points(_orders(spark, directory)).select(
        *KEY, "date", "seq", "measurement"
    )


# --- diagnosis and models ----------------------------------------------------


def _statistic_columns(table: DataFrame) -> DataFrame:
    return table.select(*KEY, "n", _rounded("r1", 8), _rounded("q", 6))


def ljung_box_q(spark, directory):
    return _statistic_columns(diagnose.ljung_box_q(_cleaned(spark, directory)))


def ljung_box_q_lineitem(spark, directory):
    """Long series with many rows per time."""
    return _statistic_columns(diagnose.ljung_box_q(_lineitem(spark, directory)))


def ljung_box(spark, directory):
    """With p-values."""
    return diagnose.ljung_box(_cleaned(spark, directory)).select(
        *KEY, "n", _rounded("q", 6), _rounded("p_value", 8)
    )


def classify_series(spark, directory):
    return diagnose.classify_series(_cleaned(spark, directory)).select(
        *KEY, "n", "kind", "message", "should_continue"
    )


def classify_every_series(spark, directory):
    """Every feature of every device: those without numbers are empty."""
    listed = series.series_list(_features(spark, directory))
    return diagnose.classify_series(
        _cleaned(spark, directory), every_series=listed
    ).select(*KEY, "kind", "should_continue")


def keep_signals(spark, directory):
    cleaned = stage(_cleaned(spark, directory), "cleaned")
    return diagnose.keep_signals(cleaned, diagnose.classify_series(cleaned)).select(
        *KEY, "time", "data"
    )


def difference(spark, directory):
    return diagnose.difference(_grid(spark, directory, previous=True)).select(
        *KEY, "idx", _rounded("data", 6)
    )


def dickey_fuller(spark, directory):
    return diagnose.dickey_fuller(_grid(spark, directory, previous=True)).select(
        *KEY, "n", _rounded("statistic", 5), _rounded("critical", 6), "stationary"
    )


def is_stationary(spark, directory):
    return lags.is_stationary(_lined(spark, directory))


def difference_order(spark, directory):
    return lags.difference_order(_lined(spark, directory))


def unit_root(spark, directory):
    """The test of raw series, with the lags that the AIC chooses."""
    numbered = stage(lags.numbered(_cleaned(spark, directory)), "numbered_series")
    return lags.augmented_dickey_fuller(numbered).select(
        *KEY, "n", "lags", "rows", _rounded("statistic", 5), _rounded("critical", 6), "stationary"
    )


def unit_root_one_lag(spark, directory):
    """The test of raw series with one lagged step."""
    numbered = lags.numbered(_cleaned(spark, directory))
    return lags.augmented_dickey_fuller(numbered, lags=1).select(
        *KEY, "n", "rows", _rounded("statistic", 5), _rounded("critical", 6), "stationary"
    )


def candidate_orders(spark, directory):
    """BIC of all orders of every grid series at its own number of differences."""
    return lags.candidate_orders(_lined(spark, directory)).select(*KEY, "p", "d", "q", _rounded("bic", 2))


def order_by_regression(spark, directory):
    return lags.order_by_regression(_lined(spark, directory)).select(
        *KEY, "status", "p", "d", "q", _rounded("bic", 2), "tested", "failed", "message"
    )


def autoregression_bics(spark, directory):
    """Candidates without innovations and up to one lag, with and without a difference."""
    sums = lags.lag_sums(
        _lined(spark, directory), differences=1, step_lags=0, value_lags=1
    )
    return lags.regression_bics(sums, 1, 0, 0).select(*KEY, "p", "d", "q", _rounded("bic", 2))


def arima_bic_walk(spark, directory):
    """Random walk and white noise candidates, which have a closed form."""
    return arima.closed_form_bics(_grid(spark, directory, previous=True)).select(
        *KEY, "p", "d", "q", _rounded("bic", 4)
    )


def lowest_bic(spark, directory):
    """Arg-min over candidates made of events: ties and failures included."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    candidates = _events(spark, directory).select(
        F.col("user_id").cast("string").alias("sn"),
        F.col("event_type").alias("feature"),
        F.floor(k / 10).cast("int").alias("p"),
        (k % 10).cast("int").alias("q"),
        F.lit(1).alias("d"),
        F.when(F.col("value") >= 2, F.floor("value").cast("double")).alias("bic"),
    )
    return arima.lowest_bic(candidates)


# --- comparison --------------------------------------------------------------


def _measured(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("value").cast("string").alias("value"),
        F.regexp_extract("props", r"(\d+)", 1).alias("k"),
    )


def _remeasured(events: DataFrame) -> DataFrame:
    """Values to one digit, k with a leading zero below ten."""
    return events.select(
        "event_id",
        F.round("value", 1).cast("string").alias("value"),
        F.regexp_replace(
            F.lpad(F.regexp_extract("props", r"(\d+)", 1), 2, "0"), "^$", "0"
        ).alias("k"),
    )


def _key_columns(table: DataFrame) -> DataFrame:
    return table.select("path", "kind")


def missing_keys(spark, directory):
    """Customers whose number no supplier has."""
    customer = adapters.table(spark, directory, "customer").select(
        F.col("c_custkey").alias("key")
    )
    supplier = adapters.table(spark, directory, "supplier").select(
        F.col("s_suppkey").alias("key")
    )
    return _key_columns(compare.missing_keys(customer, supplier, ["key"]))


def missing_labels(spark, directory):
    """Documents without a label."""
    documents, labels = (
        adapters.table(spark, directory, name).select(F.col("doc_id").alias("key"))
        for name in ("documents", "labels")
    )
    return _key_columns(compare.missing_keys(documents, labels, ["key"]))


def unexpected_keys(spark, directory):
    """Orders without a line."""
    lineitem = adapters.table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("key")
    )
    orders = adapters.table(spark, directory, "orders").select(
        F.col("o_orderkey").alias("key")
    )
    return _key_columns(compare.unexpected_keys(lineitem, orders, ["key"]))


def row_count_diff(spark, directory):
    return compare.row_count_diff(
        adapters.table(spark, directory, "orders"),
        adapters.table(spark, directory, "lineitem"),
    ).select("path", "kind", "expected", "actual")


def cell_diff(spark, directory):
    events = _events(spark, directory)
    return compare.cell_diff(
        _measured(events), _remeasured(events), ["event_id"], ["value", "k"], relative=1e-3
    ).select("path", "column_no", "kind", "expected", "actual")


def positional_diff(spark, directory):
    events = _events(spark, directory)
    return compare.positional_diff(
        _measured(events), _remeasured(events), ["event_id"], ["value", "k"], relative=1e-3
    ).select("row_no", "column_no", "expected", "actual")


def cells_match_counts(spark, directory):
    events = _events(spark, directory)
    both = _measured(events).join(
        _remeasured(events).select("event_id", F.col("value").alias("other")), "event_id"
    )
    return both.select(
        "event_id",
        cells_match(F.col("value"), F.col("other"), 1e-2, 1e-12).alias("same"),
    )


def content_hash_diff(spark, directory):
    """Documents against their lower-case copies."""
    documents = adapters.table(spark, directory, "documents").select("doc_id", "text")
    return compare.content_hash_diff(
        documents, documents.withColumn("text", F.lower("text")), ["doc_id"], "text"
    ).select("path", "expected", "actual")


def compare_tables(spark, directory):
    """All differences of the measured and the remeasured events."""
    events = _events(spark, directory)
    return compare.compare_tables(
        _measured(events), _remeasured(events), ["event_id"], relative=1e-3
    ).differences.select("path", "column_no", "kind", "expected", "actual")


def multiset_diff(spark, directory):
    """Lines by order, a key that repeats, against a changed copy.

    The copy lacks early lines, holds returned ones twice and more of each second line.
    """
    lines = adapters.table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    more = F.when(F.col("l_linenumber") == 2, 1.0).otherwise(0.0)
    copies = F.when(F.col("l_returnflag") == "R", 2).otherwise(1)
    changed = (
        lines.where("l_shipdate >= date'1994-01-01'")
        .withColumn("l_quantity", F.col("l_quantity") + more)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    )
    return compare.multiset_diff(
        lines, changed, ["l_orderkey"], ["l_linenumber", "l_quantity", "l_returnflag"]
    ).select("path", "column_no", "kind", "expected", "actual")


def compare_folders(spark, directory):
    """Page files with line breaks in quoted cells; other numbers and blanks on one side."""
    paged = stage(
        paging.keyset_pages(_readings(spark, directory), ("seq",), PAGE).withColumn(
            "data", F.concat("data", F.lit("\n"), F.col("sn"))
        ),
        "paged",
    )
    changed = paged.withColumns(
        {
            "slave_id": F.col("slave_id") + F.when(F.col("seq") % 10 == 0, 1).otherwise(0),
            "date": F.when(F.col("seq") % 7 == 0, "").otherwise(F.col("date")),
        }
    )
    folders = []
    for table in (paged, changed):
        folders.append(new_shared_path(spark, "folder"))
        pages.write_page_files(table, folders[-1])
    return compare.compare_folders(spark, *folders).differences


# --- all stages --------------------------------------------------------------


def _staged(spark, directory):
    return run_pipeline(
        _readings(spark, directory),
        PipelineOptions(mode=Mode.CORRECTED, points=POINTS),
    )


def stage_counts_query(spark, directory):
    return stage_counts(_staged(spark, directory))


def stage_outputs(spark, directory):
    """Statistics, trend and verdict of every series from one run of all stages."""
    result = _staged(spark, directory)
    return (
        result.statistics.join(result.trend.drop("file"), list(KEY))
        .join(result.verdicts, list(KEY))
        .select(
            *KEY,
            "file",
            "kind",
            _rounded("var", 6),
            _rounded("mean", 9),
            _rounded("coef", 10),
        )
    )


def series_profile(spark, directory):
    """Readings to statistics: parse, split, clean, summarise."""
    return profile.summary_statistics(_cleaned(spark, directory), "value").select(
        *KEY, "file", _rounded("var", 6), _rounded("mean", 9)
    )


QUERIES: dict[str, Query] = {
    "series_profile": series_profile,
    "read_pages": read_pages,
    "read_page_rows": read_page_rows,
    "offset_pages": offset_pages,
    "keyset_pages": keyset_pages,
    "keyset_page": keyset_page,
    "page_numbering": page_numbering,
    "last_key": last_key,
    "page_summary": page_summary,
    "write_series": write_series,
    "read_series": read_series,
    "write_once": write_once,
    "valid_series_name": valid_names,
    "select_raw": select_raw,
    "group_by_device": group_by_device,
    "distinct_devices": distinct_devices,
    "parse_payload_corrected": parse_payload_corrected,
    "parse_payload_literal": parse_payload_literal,
    "parse_payload_legacy": parse_payload_legacy,
    "parse_payload_legacy_json": parse_payload_legacy_json,
    "parse_feature_rows": parse_feature_rows,
    "bad_payloads": bad_payloads,
    "bad_readings": bad_readings,
    "device_positions": device_positions,
    "feature_order": feature_order,
    "pivot_features": pivot_features,
    "merge_and_sort": merge_and_sort,
    "merge_and_sort_all": merge_and_sort_all,
    "drop_nulls": drop_nulls,
    "split_numeric_corrected": split_numeric_corrected,
    "split_numeric_legacy": split_numeric_legacy,
    "split_numeric_booleans": split_numeric_booleans,
    "legacy_float_series": legacy_float_series,
    "legacy_quantile": legacy_quantile,
    "legacy_quantile_lineitem": legacy_quantile_lineitem,
    "outlier_bounds": outlier_bounds,
    "remove_outliers": remove_outliers,
    "remove_outliers_orders": remove_outliers_orders,
    "remove_outliers_lineitem": remove_outliers_lineitem,
    "finite_check": finite_check,
    "epoch_seconds": epoch_seconds,
    "dedupe_timestamps": dedupe_timestamps,
    "linspace_grid": linspace_grid,
    "interpolate_series": interpolate_series,
    "interpolate_lineitem": interpolate_lineitem,
    "interpolate_legacy": interpolate_legacy,
    "zip_in_input_order": zip_in_input_order,
    "summary_statistics": summary_statistics,
    "statistics_order": statistics_order,
    "linear_trend": linear_trend,
    "linear_trend_from_timestamps": linear_trend_from_timestamps,
    "histogram": histogram,
    "series_plot_data": series_plot_data,
    "series_points": series_points,
    "ljung_box_q": ljung_box_q,
    "ljung_box_q_lineitem": ljung_box_q_lineitem,
    "ljung_box": ljung_box,
    "classify_series": classify_series,
    "classify_every_series": classify_every_series,
    "keep_signals": keep_signals,
    "difference": difference,
    "dickey_fuller": dickey_fuller,
    "is_stationary": is_stationary,
    "difference_order": difference_order,
    "unit_root": unit_root,
    "unit_root_one_lag": unit_root_one_lag,
    "candidate_orders": candidate_orders,
    "order_by_regression": order_by_regression,
    "autoregression_bics": autoregression_bics,
    "arima_bic_walk": arima_bic_walk,
    "lowest_bic": lowest_bic,
    "missing_keys": missing_keys,
    "missing_labels": missing_labels,
    "unexpected_keys": unexpected_keys,
    "row_count_diff": row_count_diff,
    "cell_diff": cell_diff,
    "positional_diff": positional_diff,
    "cells_match": cells_match_counts,
    "content_hash_diff": content_hash_diff,
    "compare_tables": compare_tables,
    "multiset_diff": multiset_diff,
    "compare_folders": compare_folders,
    "stage_counts": stage_counts_query,
    "stage_outputs": stage_outputs,
}

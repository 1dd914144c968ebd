"""Metric rollups, alarms and health from METRIC, trade and candle tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.config import AlarmRule
from marketlake.storage import stored

HEALTHY, WARNING, CRITICAL, UNKNOWN = "HEALTHY", "WARNING", "CRITICAL", "UNKNOWN"


def metric_rollup(metrics: DataFrame, period_seconds: int) -> DataFrame:
    """Every statistic of a metric per period and exchange dimension."""
    return (
        metrics.groupBy(
            "name",
            F.try_element_at("dimensions", F.lit("Exchange")).alias("exchange"),
            F.window("timestamp", f"{period_seconds} seconds")["start"].alias("period_start"),
        )
        .agg(
            F.avg("value").alias("avg"), F.sum("value").alias("sum"), F.max("value").alias("max"),
            F.min("value").alias("min"), F.count("value").alias("samples"),
        )
    )


def metric_rollups(metrics: DataFrame, periods: Sequence[int]) -> DataFrame:
    """``metric_rollup`` for several periods with ``period_seconds``, from one scan.

    Points are aggregated once at the largest period that divides all others; the rest is merged from those parts.
    """
    parts = metric_rollup(metrics, gcd(*periods)).withColumn("_s", F.unix_seconds("period_start"))
    starts = F.explode(F.array(*[
        F.struct(F.lit(p).alias("seconds"), F.timestamp_seconds(F.floor(F.col("_s") / p) * p).alias("start"))
        for p in periods
    ]))
    return (
        parts.withColumn("_at", starts)
        .groupBy(
            "name", "exchange", F.col("_at.seconds").alias("period_seconds"), F.col("_at.start").alias("period_start")
        )
        .agg(
            F.try_divide(F.sum("sum"), F.sum("samples")).alias("avg"), F.sum("sum").alias("sum"),
            F.max("max").alias("max"), F.min("min").alias("min"), F.sum("samples").alias("samples"),
        )
    )


def across_dimensions(metrics: DataFrame) -> DataFrame:
    """The same metrics without dimensions, so a rollup covers all exchanges together."""
    return metrics.withColumn("dimensions", F.lit(None).cast("map<string,string>"))


def breaches(rule: AlarmRule) -> Column:
    value = F.col(rule.statistic)
    return value > rule.threshold if rule.above else value < rule.threshold


def metric_alarm(rollup: DataFrame, rule: AlarmRule, keep: tuple[str, ...] = ()) -> DataFrame:
    """State per period: ALARM once ``periods`` adjacent periods breach, OK otherwise.

    One row per period and dimension comes in, so series are short whatever the record volume.
    """
    seconds = F.unix_seconds(F.col("period_start").cast("timestamp"))
    adjacent = (
        Window.partitionBy("name", "exchange").orderBy("_s")
        .rangeBetween(-(rule.periods - 1) * rule.period_seconds, 0)
    )
    return (
        rollup.filter(F.col("name") == rule.metric)
        .withColumns({"_s": seconds, "breach": breaches(rule)})
        .withColumn("_breaches", F.count_if(F.col("breach")).over(adjacent))
        .select(
            "name", "exchange", "period_start", F.col(rule.statistic).alias("value"), "breach",
            F.when(F.col("_breaches") >= rule.periods, "ALARM").otherwise("OK").alias("state"),
            *keep,
        )
    )


@dataclass(frozen=True)
class Check:
    """One health check: an aggregate, and the status and message its value ``v`` leads to."""

    component: str
    detail: str
    value: Column
    status: Callable[[Column], Column]
    message: Callable[[Column], Column]

    def result(self, v: Column, at: Column) -> Column:
        return F.struct(
            F.lit(self.component).alias("component"),
            self.status(v).alias("status"),
            self.message(v).alias("message"),
            F.create_map(F.lit(self.detail), v.cast("string")).alias("details"),
            at.cast("timestamp").alias("checked_at"),
        )


def _classify(v: Column, warning: Column, critical: Column) -> Column:
    return F.when(v.isNull(), UNKNOWN).when(critical, CRITICAL).when(warning, WARNING).otherwise(HEALTHY)


def run_checks(df: DataFrame, checks: list[Check], at: Column) -> DataFrame:
    """All checks of a table from one aggregation over it."""
    values = df.agg(*[check.value.alias(f"_v{i}") for i, check in enumerate(checks)])
    return values.select(F.inline(F.array(*[c.result(F.col(f"_v{i}"), at) for i, c in enumerate(checks)])))


def _named(name: str) -> Column:
    return F.when(F.col("name") == name, F.col("value"))


def quality_check() -> Check:
    """Mean quality score: below 0.7 critical, below 0.8 warning, none unknown."""

    def message(v: Column) -> Column:
        score = F.format_string("%.2f", v)
        return (
            F.when(v.isNull(), F.lit("No data quality metrics available"))
            .when(v < 0.7, F.concat(F.lit("Low data quality score: "), score))
            .when(v < 0.8, F.concat(F.lit("Below target data quality score: "), score))
            .otherwise(F.concat(F.lit("Data quality is good: "), score))
        )

    return Check(
        "Data Quality", "quality_score", F.avg(_named("DataQualityScore")),
        lambda v: _classify(v, v < 0.8, v < 0.7), message,
    )


def lag_check() -> Check:
    """Largest processing lag: over 5 minutes critical, over 1 minute warning; no data counts as 0."""

    def message(v: Column) -> Column:
        seconds = F.format_string("%.1f", v / 1000)
        return (
            F.when(v > 300_000, F.concat(F.lit("High lag: "), seconds, F.lit(" seconds")))
            .when(v > 60_000, F.concat(F.lit("Elevated lag: "), seconds, F.lit(" seconds")))
            .otherwise(F.lit("Stream is healthy"))
        )

    return Check(
        "Stream Lag", "lag_ms", F.coalesce(F.max(_named("LagMilliseconds")), F.lit(0.0)),
        lambda v: _classify(v, v > 60_000, v > 300_000), message,
    )


def errors_check(at: Column, minutes: int = 5) -> Check:
    """Errors of the last minutes: more than 10 critical, more than 5 warning."""
    now = at.cast("timestamp")
    recent = (F.col("timestamp") > now - F.make_dt_interval(mins=F.lit(minutes))) & (F.col("timestamp") <= now)

    def message(v: Column) -> Column:
        count = F.concat(v.cast("string"), F.lit(f" errors in last {minutes} minutes"))
        return (
            F.when(v > 10, F.concat(F.lit("High error rate: "), count))
            .when(v > 5, F.concat(F.lit("Elevated error rate: "), count))
            .otherwise(F.lit("Processing is healthy"))
        )

    total = F.coalesce(F.sum(F.when(recent, _named("InvalidRecords"))), F.lit(0.0)).cast("bigint")
    return Check(
        "Stream Processing", "error_count", total, lambda v: _classify(v, v > 5, v > 10), message
    )


def freshness_check() -> Check:
    """Candles in sight; none is a warning."""
    return Check(
        "Candle Table", "recent_records", F.count(F.lit(1)),
        lambda v: _classify(v, v == 0, F.lit(False)),
        lambda v: F.when(v == 0, F.lit("No recent data found")).otherwise(F.lit("Candle table is healthy")),
    )


def health_quality(metrics: DataFrame, at: Column) -> DataFrame:
    return run_checks(metrics.filter(F.col("name") == "DataQualityScore"), [quality_check()], at)


def health_lag(metrics: DataFrame, at: Column) -> DataFrame:
    return run_checks(metrics.filter(F.col("name") == "LagMilliseconds"), [lag_check()], at)


def health_errors(metrics: DataFrame, at: Column, minutes: int = 5) -> DataFrame:
    return run_checks(metrics.filter(F.col("name") == "InvalidRecords"), [errors_check(at, minutes)], at)


def health_freshness(candles: DataFrame, at: Column, hours: int = 1) -> DataFrame:
    recent = F.col("interval_start") >= at - F.make_dt_interval(hours=F.lit(hours))
    return run_checks(candles.filter(recent), [freshness_check()], at)


def health_checks(metrics: DataFrame, candles: DataFrame, at: Column) -> DataFrame:
    """Every check; the metric table is read once for its three."""
    named = metrics.filter(F.col("name").isin("DataQualityScore", "LagMilliseconds", "InvalidRecords"))
    on_metrics = run_checks(named, [quality_check(), lag_check(), errors_check(at)], at)
    return on_metrics.unionByName(health_freshness(candles, at))


def health_rollup(checks: DataFrame) -> DataFrame:
    """Checks per status and the overall status: the worst one, where UNKNOWN does not count."""
    status = F.col("status")
    worst = F.max(F.when(status == CRITICAL, 2).when(status == WARNING, 1).otherwise(0))
    overall = F.when(worst == 2, CRITICAL).when(worst == 1, WARNING).otherwise(HEALTHY)
    return checks.agg(
        *[F.count_if(status == s).alias(s.lower()) for s in (CRITICAL, WARNING, HEALTHY, UNKNOWN)],
        overall.alias("overall_status"),
    )


def symbol_coverage(trades: DataFrame, period_seconds: int = 300, ts: str = "ts") -> DataFrame:
    return trades.groupBy(
        "symbol", F.window(ts, f"{period_seconds} seconds")["start"].alias("period_start")
    ).agg(F.count(F.lit(1)).alias("trades"))


def data_freshness(trades: DataFrame, at: Column, ts: str = "ts") -> DataFrame:
    """Seconds between ``at`` and the newest trade."""
    newest = F.unix_millis(F.max(F.col(ts).cast("timestamp")))
    return trades.agg(((F.unix_millis(at.cast("timestamp")) - newest) / 1000.0).alias("data_freshness_seconds"))


def ingest_delay(records: DataFrame, processed_at: str = "processed_at", ts: str = "ts") -> DataFrame:
    """Mean milliseconds from trade to processing, per exchange and overall (null exchange)."""
    delay = F.unix_millis(F.col(processed_at).cast("timestamp")) - F.unix_millis(F.col(ts).cast("timestamp"))
    return (
        records.withColumn("_delay", delay)
        .groupBy("exchange").agg(F.sum("_delay").alias("_sum"), F.count("_delay").alias("_n"))
        .rollup("exchange")
        .agg(
            F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_delay_ms"),
            F.sum("_n").alias("records"),
        )
    )


def latency_summary(samples: DataFrame, percentiles: tuple[int, ...] = (95, 99)) -> DataFrame:
    """Per component: error rate, throughput and latency statistics.

    Input: component, sent_at, done_at (times), latency_us (bigint, null for an error). A percentile is
    the value at position int(n * p / 100) of the sorted latencies. Latencies are first counted by value;
    positions then come from running counts inside value ranges of 2**20 microseconds, offset by the
    ranges before, so no component is ever sorted in one task. Totals come from the same counts, errors
    being those of the null latency. The counts are stored, so the samples are read and shuffled once, at once.
    """
    every = (
        samples.groupBy("component", F.shiftright("latency_us", 20).alias("range"), "latency_us")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.unix_micros(F.col("sent_at").cast("timestamp"))).alias("_from"),
            F.max(F.unix_micros(F.col("done_at").cast("timestamp"))).alias("_to"),
        )
    )
    every = stored(every, "latencies")
    good = F.col("latency_us").isNotNull()
    totals = every.groupBy("component").agg(
        F.coalesce(F.sum(F.when(good, F.col("n"))), F.lit(0)).alias("records_processed"),
        F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("errors"),
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
        F.try_divide(F.sum(F.col("latency_us") * F.col("n")), F.sum(F.when(good, F.col("n")))).alias("_avg"),
        F.max("latency_us").alias("_max"),
        F.min("latency_us").alias("_min"),
    )
    counted = every.filter(good).drop("_from", "_to")
    in_component = Window.partitionBy("component")
    ranges = (
        counted.groupBy("component", "range").agg(F.sum("n").alias("range_n"))
        .withColumn("total", F.sum("range_n").over(in_component))
        .withColumn(
            "before",
            F.sum("range_n").over(in_component.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .withColumn("before", F.coalesce("before", F.lit(0)))
    )
    running = Window.partitionBy("component", "range").orderBy("latency_us")
    placed = (
        counted.join(ranges, ["component", "range"])
        .withColumn("upto", F.col("before") + F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    )

    def value_at(percent: int) -> Column:
        # 0-based position, as in int(n * p / 100); the value covering it ends just above it.
        position = F.floor(F.col("total") * percent / 100)
        return F.min(F.when(F.col("upto") > position, F.col("latency_us")))

    picked = placed.groupBy("component").agg(*[value_at(p).alias(f"_p{p}") for p in percentiles])
    seconds = (F.col("_to") - F.col("_from")) / 1e6
    sent = F.col("records_processed") + F.col("errors")

    def millis(name: str) -> Column:
        return F.coalesce(F.col(name) / 1000.0, F.lit(0.0))

    return totals.join(picked, "component", "left").select(
        "component",
        "records_processed",
        "errors",
        F.coalesce(F.try_divide("errors", sent), F.lit(0.0)).alias("error_rate"),
        F.when(seconds > 0, F.col("records_processed") / seconds).otherwise(0.0).alias("throughput_rps"),
        millis("_avg").alias("avg_latency_ms"),
        *[millis(f"_p{p}").alias(f"p{p}_latency_ms") for p in percentiles],
        millis("_max").alias("max_latency_ms"),
        millis("_min").alias("min_latency_ms"),
    )


def latest_log_rows(
    rows: DataFrame, time: str, columns: tuple[str, ...], limit: int = 100, ties: tuple[str, ...] = ()
) -> DataFrame:
    """The newest rows, rows of one time by ``ties``; a top-k per task and one merge, not a full sort."""
    return rows.orderBy(F.desc(time), *[F.desc(c) for c in ties]).select(*columns).limit(limit)

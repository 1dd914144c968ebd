"""Record scoring, routing and quality rollups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.config import QualityBounds
from marketlake.functions.once import evaluated
from marketlake.functions.parsing import event_time, field, number
from marketlake.functions.paths import landing_time
from marketlake.functions.quality import (
    error_type,
    fault_messages,
    floor_zero,
    penalised_score,
    record_faults,
    unpacked_fields,
)

VALID, INVALID, FAILED = "valid", "invalid", "failed"


def score_records(
    records: DataFrame, bounds: QualityBounds = QualityBounds(), now: Column | None = None
) -> DataFrame:
    """Add parsed (typed fields), quality_score, errors and status to rows holding a ``record`` map.

    A record that cannot be processed at all (no JSON object, a null exchange, an unreadable price that
    passed the threshold) is ``failed``, not ``invalid``.
    """
    record = F.col("record")
    pack, fields = unpacked_fields("parsed")
    faults = record_faults(fields, bounds, F.current_timestamp() if now is None else now)
    readable, score = record.isNotNull(), F.col("_raw_score")
    exchange_null = fields.present["exchange"] & fields.exchange.isNull()
    price_unusable = fields.present["price"] & fields.price.isNull()
    passes = score >= bounds.threshold
    # Every fault costs something, so a full score needs no message list.
    errors = F.when(score < 1.0, fault_messages(faults)).otherwise(F.array().cast("array<string>"))
    judged = (
        records.withColumn("parsed", pack(record))
        .withColumn("_raw_score", penalised_score(faults))
        .withColumns(
            {
                "quality_score": F.when(readable, floor_zero(score)),
                "errors": F.when(readable, errors),
                "status": (
                    F.when(~readable | exchange_null, FAILED)
                    .when(passes & price_unusable, FAILED)
                    .when(passes, VALID)
                    .otherwise(INVALID)
                ),
            }
        )
        .drop("_raw_score")
    )
    return evaluated(judged, "parsed", "quality_score", "errors", "status")


def typed_records(scored: DataFrame, now: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Scored records as typed trade columns; ``landed`` is the time a record is filed and ordered under."""
    record = F.col("record")
    stamp = field(record, "timestamp")
    return scored.select(
        *keep,
        F.col("parsed.exchange").alias("exchange"),
        F.coalesce(field(record, "symbol"), F.lit("unknown")).alias("symbol"),
        stamp.alias("timestamp"),
        F.col("parsed.price").alias("price"),
        F.col("parsed.volume").alias("volume"),
        number(field(record, "bid")).alias("bid"),
        number(field(record, "ask")).alias("ask"),
        field(record, "trade_id").alias("trade_id"),
        "quality_score",
        event_time(stamp).alias("ts"),
        landing_time(event_time(stamp), F.col("parsed.has_timestamp"), now).alias("landed"),
    )


@dataclass(frozen=True)
class Routed:
    valid: DataFrame
    failed: DataFrame


def failure_reason(status: Column, errors: Column) -> Column:
    quoted = F.transform(
        errors,
        lambda e: F.when(e.contains("'") & ~e.contains('"'), F.concat(F.lit('"'), e, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(e, F.lit("'"), F.lit("\\'")), F.lit("'"))
        ),
    )
    listed = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    return F.when(status == INVALID, F.concat(F.lit("Data quality validation failed: "), listed)).otherwise(
        "Processing error: unreadable record"
    )


def split_valid_invalid(scored: DataFrame, record_id: str = "record_id", dlq_enabled: bool = False) -> Routed:
    """Valid rows, and the failed list: unprocessable records, plus invalid ones when the DLQ is on."""
    rejected = F.col("status").isin(INVALID, FAILED) if dlq_enabled else F.col("status") == FAILED
    failed = scored.filter(rejected).select(
        F.col(record_id).alias("record_id"),
        "status",
        failure_reason(F.col("status"), F.col("errors")).alias("reason"),
    )
    return Routed(scored.filter(F.col("status") == VALID), failed)


def _totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("status") == VALID).alias("valid_records"),
        F.count_if(F.col("status") != VALID).alias("invalid_records"),
    ]


def _with_alert(totals: DataFrame, alert_share: float) -> DataFrame:
    bad = F.col("invalid_records") / F.col("total_records")
    text = F.concat(
        F.lit("High error rate detected: "), F.col("invalid_records").cast("string"), F.lit("/"),
        F.col("total_records").cast("string"), F.lit(" records failed"),
    )
    return totals.withColumn("alert", F.when((F.col("total_records") > 0) & (bad > alert_share), text))


def batch_stats(scored: DataFrame, alert_share: float = 0.1) -> DataFrame:
    """Totals of a batch and the alert text when too many records were rejected."""
    return _with_alert(scored.agg(*_totals()), alert_share)


def observe_totals(scored: DataFrame) -> tuple[DataFrame, Observation]:
    """``scored`` whose totals are counted while another job evaluates it; see ``observed_stats``."""
    observation = Observation()
    return scored.observe(observation, *_totals()), observation


def observed_stats(spark: SparkSession, observation: Observation, alert_share: float = 0.1) -> DataFrame:
    """``batch_stats`` without a job of its own, once an action has evaluated all observed rows."""
    totals = observation.get
    names = ("total_records", "valid_records", "invalid_records")
    row = spark.createDataFrame([tuple(totals[n] for n in names)], ", ".join(f"{n} long" for n in names))
    return _with_alert(row, alert_share)


def emit_metrics(scored: DataFrame, at: Column, processing_seconds: float | None = None) -> DataFrame:
    """METRIC rows of a batch: per exchange for valid records, totals for all, and how long it took if given.

    One grouping by exchange yields every row, so the records are read once; a second grouping over those
    few rows adds up the totals.
    """
    valid = F.col("status") == VALID
    exchange = F.coalesce(field(F.col("record"), "exchange"), F.lit("unknown"))
    per_exchange = scored.groupBy(F.when(valid, exchange).alias("exchange")).agg(
        F.count_if(valid).alias("n_valid"),
        F.avg(F.when(valid, F.col("quality_score"))).alias("score"),
        F.count(F.lit(1)).alias("n"),
    )
    nobody = F.lit(None).cast("string")

    def row(name: str, value: Column, unit: str, owner: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
            owner.alias("exchange"),
        )

    totals = [
        row("TotalRecords", F.col("n"), "Count", nobody),
        row("ValidRecords", F.col("n_valid"), "Count", nobody),
        row("InvalidRecords", F.col("n") - F.col("n_valid"), "Count", nobody),
    ]
    own = [
        row("RecordsProcessed", F.col("n_valid"), "Count", F.col("exchange")),
        row("DataQualityScore", F.col("score"), "None", F.col("exchange")),
    ]
    rows = F.when(F.col("exchange").isNull(), F.array(*totals)).otherwise(F.array(*totals, *own))
    times = [] if processing_seconds is None else [("ProcessingTime", "Seconds", None, float(processing_seconds))]
    took = scored.sparkSession.createDataFrame(times, "name string, unit string, exchange string, value double")
    return (
        per_exchange.select(F.inline(rows))
        .groupBy("name", "unit", "exchange")
        .agg(F.sum("value").alias("value"))
        .unionByName(took)
        .select(
            "name",
            "value",
            "unit",
            at.cast("timestamp").alias("timestamp"),
            F.when(F.col("exchange").isNotNull(), F.create_map(F.lit("Exchange"), "exchange")).alias("dimensions"),
        )
    )


def metric_points(scored: DataFrame, at: Column, ts: Column) -> DataFrame:
    """One METRIC row per record and measure: processed, score and lag, or invalid."""
    valid = F.col("status") == VALID
    exchange = F.coalesce(field(F.col("record"), "exchange"), F.lit("unknown"))

    def row(name: str, value: Column, unit: str, dims: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
            dims.alias("dimensions"),
        )

    tagged, untagged = F.create_map(F.lit("Exchange"), exchange), F.lit(None).cast("map<string,string>")
    lag = F.unix_millis(at.cast("timestamp")) - F.unix_millis(ts.cast("timestamp"))
    good = F.array(
        row("RecordsProcessed", F.lit(1), "Count", tagged),
        row("DataQualityScore", F.col("quality_score"), "None", tagged),
        row("LagMilliseconds", lag, "Milliseconds", tagged),
    )
    bad = F.array(row("InvalidRecords", F.lit(1), "Count", untagged))
    return scored.select(
        F.inline(F.when(valid, good).otherwise(bad)), at.cast("timestamp").alias("timestamp")
    ).select("name", "value", "unit", "timestamp", "dimensions")


def data_quality_metrics(scored: DataFrame) -> DataFrame:
    """Per exchange, symbol and day: record counts, mean score and price and volume ranges.

    Records that can't be read count as invalid ones of exchange and symbol ``unknown`` without a day.
    """
    record = F.col("record")
    price, volume = F.col("parsed.price"), F.col("parsed.volume")
    valid = F.col("status") == VALID
    day = F.to_date(event_time(field(record, "timestamp")))
    return (
        scored.groupBy(
            F.coalesce(field(record, "exchange"), F.lit("unknown")).alias("exchange"),
            F.coalesce(field(record, "symbol"), F.lit("unknown")).alias("symbol"),
            day.alias("date"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(valid).alias("valid_records"),
            F.count_if(~valid).alias("invalid_records"),
            F.avg("quality_score").alias("quality_score"),
            F.avg(price).alias("avg_price"),
            F.avg(volume).alias("avg_volume"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
        )
    )


def validation_error_types(scored: DataFrame, at: Column | None = None, period_seconds: int = 300) -> DataFrame:
    """How often each kind of validation error occurred; with ``at``, the records' time, in each period."""
    period = [] if at is None else [F.window(at, f"{period_seconds} seconds")["start"].alias("period_start")]
    return (
        scored.select(F.explode("errors").alias("message"), *([] if at is None else [at]))
        .groupBy(*period, error_type(F.col("message")).alias("error_type"))
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def late_records(scored: DataFrame, now: Column, bounds: QualityBounds = QualityBounds()) -> DataFrame:
    """Records whose event time is outside the tolerance; they stay in the main flow with a penalty."""
    tolerance, at = bounds.tolerance_seconds * 1000, F.unix_millis(now.cast("timestamp"))
    own = event_time(field(F.col("record"), "timestamp"))
    millis = F.coalesce("parsed.millis", F.unix_millis(own.cast("timestamp")))
    return scored.filter(~millis.between(at - tolerance, at + tolerance))

"""Validation and dead-letter routing (FLT1, PRJ3, PRJ5, SNK2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values of the reference's validation rule ------------------------
MAX_AGE_SECONDS = 86_400
MOBILE_OS = ("Android", "iOS")
# -----------------------------------------------------------------------------

# Raw transaction message: every field arrives as text and is cast leniently.
RAW_TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("location", T.StructType([T.StructField("lat", T.StringType()),
                                             T.StructField("lng", T.StringType())])),
    T.StructField("device_info", T.StructType([T.StructField("os", T.StringType()),
                                                T.StructField("app_version", T.StringType()),
                                                T.StructField("device_model", T.StringType())])),
    T.StructField("status", T.StringType()),
    T.StructField("commission_type", T.StringType()),
    T.StructField("commission_amount", T.StringType()),
    T.StructField("vat_amount", T.StringType()),
    T.StructField("total_amount", T.StringType()),
    T.StructField("customer_type", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
])
REQUIRED = ("transaction_id", "timestamp", "customer_id", "merchant_id", "merchant_category",
            "payment_method", "amount", "location", "status", "commission_type",
            "commission_amount", "vat_amount", "total_amount", "customer_type", "risk_level")


def to_json_value(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ5: one JSON text column ``value`` per row."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def parse_transactions(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """PRJ3 (+PRJ1, PRJ4): JSON text -> typed columns; ``parse_ok`` false when a
    required field is missing or not castable.  ``device_info`` defaults to an
    empty struct, ``failure_reason`` to NULL."""
    d = F.from_json(F.col(value_col).cast("string"), RAW_TRANSACTION).alias("d")
    x = raw.select(d, F.col(value_col).cast("string").alias("original_data"))
    ts = F.try_to_timestamp(F.regexp_replace("d.timestamp", "Z$", ""))
    typed = x.select(
        F.col("d.transaction_id").alias("transaction_id"),
        ts.alias("event_time"),
        F.col("d.customer_id").alias("customer_id"),
        F.col("d.merchant_id").alias("merchant_id"),
        F.col("d.merchant_category").alias("merchant_category"),
        F.col("d.payment_method").alias("payment_method"),
        F.expr("try_cast(d.amount AS BIGINT)").alias("amount"),
        F.expr("try_cast(d.location.lat AS DOUBLE)").alias("lat"),
        F.expr("try_cast(d.location.lng AS DOUBLE)").alias("lng"),
        F.col("d.device_info.os").alias("device_os"),
        F.col("d.status").alias("status"),
        F.col("d.commission_type").alias("commission_type"),
        F.expr("try_cast(d.commission_amount AS BIGINT)").alias("commission_amount"),
        F.expr("try_cast(d.vat_amount AS BIGINT)").alias("vat_amount"),
        F.expr("try_cast(d.total_amount AS BIGINT)").alias("total_amount"),
        F.col("d.customer_type").alias("customer_type"),
        F.expr("try_cast(d.risk_level AS INT)").alias("risk_level"),
        F.col("d.failure_reason").alias("failure_reason"),
        "original_data",
    )
    need = ["transaction_id", "event_time", "customer_id", "merchant_id", "merchant_category",
            "payment_method", "amount", "lat", "lng", "status", "commission_type",
            "commission_amount", "vat_amount", "total_amount", "customer_type", "risk_level"]
    ok = F.lit(True)
    for c in need:
        ok = ok & F.col(c).isNotNull()
    return typed.withColumn("parse_ok", ok)


def validation_errors(df: DataFrame, as_of: str, ts="ts", amount="amount", vat="vat_amount",
                      commission="commission_amount", total="total_amount",
                      method="payment_method", os_col="device_os") -> DataFrame:
    """FLT1: ``errors`` array of ERR_AMOUNT / ERR_TIME / ERR_DEVICE codes.

    ``as_of`` replaces the wall clock so results are reproducible.  A missing
    OS on a mobile payment is an error (``coalesce`` avoids ``NULL NOT IN``).
    """
    now = F.lit(as_of).cast(df.schema[ts].dataType)
    limit = now - F.expr(f"INTERVAL {MAX_AGE_SECONDS} SECONDS")
    err_amount = F.when(F.col(total) != F.col(amount) + F.col(vat) + F.col(commission), F.lit("ERR_AMOUNT"))
    err_time = F.when((F.col(ts) > now) | (F.col(ts) < limit), F.lit("ERR_TIME"))
    err_device = F.when((F.col(method) == "mobile") & ~F.coalesce(F.col(os_col), F.lit("")).isin(*MOBILE_OS),
                        F.lit("ERR_DEVICE"))
    return df.withColumn("errors", F.array_compact(F.array(err_amount, err_time, err_device)))


def route_dead_letter(validated: DataFrame, id_col="transaction_id") -> tuple[DataFrame, DataFrame]:
    """SNK2: (valid rows, dead-letter rows ``{id, errors, original_data}``)."""
    bad = F.size("errors") > 0
    valid = validated.where(~bad).drop("errors")
    cols = [c for c in validated.columns if c != "errors"]
    dead = validated.where(bad).select(
        F.col(id_col), F.col("errors"), F.to_json(F.struct(*cols)).alias("original_data"))
    return valid, dead


def keep_if(df: DataFrame, flag: str) -> DataFrame:
    """Keep rows whose boolean ``flag`` is true.

    A plain ``where(flag)`` is pushed below projections, and when ``flag``
    is built from fields of a parsed JSON struct every conjunct re-inlines the
    parse.  Emitting each row 0 or 1 times from a generator keeps the parse
    evaluated once per row in the projection (predicates are not pushed
    through a generator)."""
    keep = F.explode(F.array_compact(F.array(F.when(F.col(flag), F.lit(True)))))
    return df.select("*", keep.alias("__keep")).drop("__keep")

"""Promotional credit: burn-down dates and payment method."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLDS = (100, 200, 300, 400)
COMMERCIAL_MODELS = ("PAYG", "Commit")


def burn_down(grants: DataFrame, billing: DataFrame, per_grant: bool = False) -> DataFrame:
    """Daily promo spend per granted org with its running total.

    The total runs over all days of an org, so a day that two grants cover counts twice;
    ``per_grant`` keeps a total for each expiry date instead. Spend is summed per org and day before the window, so the window holds at most one
    row per day and grant of an org.
    """
    spent = billing.filter((F.col("metric_type") == "PromoCredit") & F.col("commercial_model").isin(*COMMERCIAL_MODELS))
    daily = spent.groupBy("org_id", "date").agg(F.sum("bill_amount_usd").alias("bill_amount_usd"))
    granted = grants.select("org_id", "credit_expiration_date").distinct()
    whole = ["org_id", "credit_expiration_date"] if per_grant else ["org_id"]
    order = ["date"] if per_grant else ["date", "credit_expiration_date"]
    running = Window.partitionBy(*whole).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.join(granted, "org_id")
        .filter(F.col("credit_expiration_date") >= F.col("date"))
        .withColumn("running_total", F.sum("bill_amount_usd").over(running))
    )


def threshold_dates(burned: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """First day each org's running total reaches each threshold."""
    return burned.groupBy("org_id", "credit_expiration_date").agg(
        *[
            F.min(F.when(F.abs("running_total") >= t, F.col("date"))).alias(f"date_reach_{t}")
            for t in thresholds
        ]
    )


def payment_flag() -> Column:
    """Whether an org can pay, by its billing method."""
    method = F.col("billing_method")
    return F.when(method == "STRIPE", F.coalesce("has_payment_method_attached", F.lit(False))).when(
        method.isin("MARKETPLACE", "MANUAL"), F.lit(True)
    )


def credit_report(dates: DataFrame, orgs: DataFrame, customers: DataFrame, filters: Sequence[Column] = ()) -> DataFrame:
    """Orgs that used up 200 of their credit, newest first, with payment flag and chosen filters."""
    paying = customers.select(F.col("id").alias("billing_customer_id"), "has_payment_method_attached")
    joined = dates.join(orgs.withColumnRenamed("id", "org_id"), "org_id").join(paying, "billing_customer_id", "left")
    for f in filters:
        joined = joined.filter(f)
    return (
        joined.withColumn("has_payment_method", payment_flag())
        .filter("date_reach_200 is not null")
        .drop("has_payment_method_attached", "billing_customer_id")
        .orderBy(F.col("date_reach_200").desc(), "org_id")
    )

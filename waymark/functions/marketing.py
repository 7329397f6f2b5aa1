"""Marketing field expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import contains_any
from waymark.operators.lookup import broadcast_if_small

# Referrers that count as organic search.
SEARCH_REFERRERS = ["www.google", "www.bing", "duckduckgo.com", "baidu.com"]


def derived_medium(campaign: Column, referrer: Column, medium: Column) -> Column:
    """Without a campaign: a search referrer is organic, no referrer is direct; else the medium."""
    untagged = campaign.isNull()
    return (
        F.when(untagged & contains_any(referrer, SEARCH_REFERRERS), F.lit("organic_search"))
        .when(untagged & referrer.isNull(), F.lit("direct"))
        .otherwise(F.lower(medium))
    )


def null_status(column: Column) -> Column:
    return F.when(column.isNull(), F.lit("null_value")).otherwise(F.lit("not_null"))


def canonical_values(df: DataFrame, column: str, spellings: DataFrame) -> DataFrame:
    """Replace known spellings of ``column`` by their canonical value, else lower-case it.

    ``spellings`` has one row per ``raw`` value with its ``canonical`` form.
    """
    known = spellings.select(F.col("raw").alias("__raw"), F.col("canonical").alias("__canonical"))
    return (
        df.join(broadcast_if_small(known), F.col(column) == F.col("__raw"), "left")
        .withColumn(column, F.coalesce("__canonical", F.lower(F.col(column))))
        .drop("__raw", "__canonical")
    )


def any_present(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()

"""Left joins: identity records by transaction id, and three small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.features import normalize_email

def attach_identity(transactions: DataFrame, identity: DataFrame, key: str = "TransactionID", spread_by: str = "offset") -> DataFrame:
    """Left equi-join that keeps rows without a key from piling up in one partition.

    Rows with a NULL key can never match, so a second join key scatters them by ``spread_by``;
    a hot non-NULL key is split by the adaptive skew-join rule.
    """
    scatter = F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(F.lit(0).cast("bigint"))
    left = transactions.withColumn("_scatter", scatter)
    right = identity.withColumn("_scatter", F.lit(0).cast("bigint"))
    return left.join(right, [key, "_scatter"], "left").drop("_scatter")


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key: of rows that repeat it, the smallest by all their columns. Rows without a key match nothing.

    Whether the result is broadcast is Spark's decision, from its size in bytes as planned or as measured.
    """
    rest = [c for c in dim.columns if c != key]
    least = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(key, "_row.*").select(*dim.columns)


def attach_dimensions(df: DataFrame, product: DataFrame, email: DataFrame, hour: DataFrame) -> DataFrame:
    """Risk columns of product, purchaser email domain and hour; a miss leaves NULLs.

    Each dimension has one row per key (see ``one_per_key``).
    """
    product_side = product.select(F.col("product_cd").alias("_product"), F.col("risk_tier").alias("product_risk_tier"))
    email_side = email.select(
        F.col("domain").alias("_domain"),
        F.col("risk_score").cast("double").alias("p_email_risk_score"),
        F.col("is_anonymous").alias("p_email_is_anonymous"),
    )
    hour_side = hour.select(
        F.col("hour_of_day").alias("_hour"),
        F.col("risk_level").alias("hour_risk_level"),
        F.col("risk_score").cast("double").alias("hour_risk_score"),
    )
    added = ("product_risk_tier", "p_email_risk_score", "p_email_is_anonymous", "hour_risk_level", "hour_risk_score")
    keyed = df.drop(*added).withColumn("_email", normalize_email(F.col("P_emaildomain")))
    return (
        keyed.join(product_side, F.col("ProductCD") == F.col("_product"), "left")
        .join(email_side, F.col("_email") == F.col("_domain"), "left")
        .join(hour_side, F.col("transaction_hour") == F.col("_hour"), "left")
        .drop("_product", "_domain", "_hour", "_email")
    )

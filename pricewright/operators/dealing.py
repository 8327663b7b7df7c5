"""Deals scored against estimated prices."""

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import DataFrame, functions as F

from ..constants import ALERT_DISCOUNT, BEST_DEALS
from ..functions.deals import alert_label, discount, ensemble_price, title_price


def score_deals(deals: DataFrame, threshold: float = ALERT_DISCOUNT) -> DataFrame:
    """Add estimate, discount and the label alert or skip. Works on streams."""
    return (
        deals.withColumn("estimate", ensemble_price(F.col("frontier"), F.col("specialist")))
        .withColumn("discount", discount(F.col("estimate"), F.col("price")))
        .withColumn("status", alert_label(F.col("discount"), threshold))
    )


def curate_deals(deals: DataFrame, count: int = BEST_DEALS) -> DataFrame:
    """The best deals whose title states a product price, by discount on it."""
    priced = deals.withColumn("price", title_price(F.col("title"))).where("price is not null")
    return score_deals(priced).orderBy(F.desc("discount"), "deal_id").limit(count).select(
        "deal_id", "title", "price", "estimate", "discount", "url"
    )


def weighted_ensemble(estimates: DataFrame, weights: Mapping[str, float] | DataFrame) -> DataFrame:
    """Weighted sum of any number of predictors per deal (deal_id, predictor, estimate)."""
    if isinstance(weights, DataFrame):
        weighed = estimates.join(weights.select("predictor", "weight"), "predictor")
    else:
        table = F.create_map(*chain.from_iterable((F.lit(p), F.lit(float(w))) for p, w in weights.items()))
        weighed = estimates.withColumn("weight", F.try_element_at(table, F.col("predictor"))).where("weight is not null")
    return weighed.groupBy("deal_id").agg(F.sum(F.col("estimate") * F.col("weight")).alias("estimate"))


def deal_alerts(deals: DataFrame, threshold: float = ALERT_DISCOUNT) -> DataFrame:
    return score_deals(deals, threshold).where("status = 'alert'").select(
        "deal_id", "title", "price", "estimate", "discount", "url"
    )


def alert_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count_if(F.col("status") == "alert").alias("alerts"), F.count("*").alias("deals"))


def alerts_per_window(scored: DataFrame, width: str = "1 hour") -> DataFrame:
    """Alerts and deals of every window of event time that had a deal. Works on streams with a watermark."""
    return scored.groupBy(F.window("ts", width).alias("_window")).agg(
        F.count_if(F.col("status") == "alert").alias("alerts"), F.count("*").alias("deals"),
    ).select(F.col("_window.start").alias("start"), F.col("_window.end").alias("end"), "alerts", "deals")


def alert_sessions(scored: DataFrame, gap: str = "1 day") -> DataFrame:
    """Runs of alerts for one page that lie less than ``gap`` apart: when they begin, when ``gap`` has passed after the last, how many, the best discount.

    Works on streams with a watermark. Alerts without page or time are in no session.
    """
    alerts = scored.where("status = 'alert' and url is not null and ts is not null")
    return alerts.groupBy("url", F.session_window("ts", gap).alias("_session")).agg(
        F.count("*").alias("alerts"), F.max("discount").alias("best_discount"),
    ).select("url", F.col("_session.start").alias("start"), F.col("_session.end").alias("end"), "alerts", "best_discount")

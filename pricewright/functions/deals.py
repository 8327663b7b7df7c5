"""Value of a deal: estimate, discount, and whether a title names a price."""

from pyspark.sql import Column, functions as F

from ..constants import ALERT_DISCOUNT, FRONTIER_WEIGHT, SPECIALIST_WEIGHT

TITLE_PRICE = r"(?i)\bfor \$(\d[\d,]*(?:\.\d+)?)"
NOT_A_PRICE = r"(?i)\$[\d,.]+ off\b|\bends tonight\b|\bshipping\b.* over \$"


def ensemble_price(frontier: Column, specialist: Column) -> Column:
    return frontier * F.lit(FRONTIER_WEIGHT) + specialist * F.lit(SPECIALIST_WEIGHT)


def discount(estimate: Column, price: Column) -> Column:
    """Share of the estimate saved; 0 when there is no positive estimate."""
    return F.when(estimate > 0, (estimate - price) / estimate).otherwise(F.lit(0.0))


def alert_label(saved: Column, threshold: float = ALERT_DISCOUNT) -> Column:
    return F.when(saved >= threshold, F.lit("alert")).otherwise(F.lit("skip"))


def title_price(title: Column) -> Column:
    """The price a title states for the product itself; null for other amounts."""
    number = F.translate(F.regexp_extract(title, TITLE_PRICE, 1), ",", "").try_cast("double")
    return F.when(~title.rlike(NOT_A_PRICE), number)

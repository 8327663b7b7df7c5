"""Parsing prices, weights and model answers; dollars and bins."""

from itertools import chain

from pyspark.sql import Column, functions as F

from ..constants import MAX_PRICE, MIN_PRICE, POUNDS_PER_UNIT
from .text import collapse_whitespace, strip_whitespace

# What counts as a number. A bare cast would also take `1.0d` and `5f`.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^(?i:nan|[+-]?inf(inity)?)$"

# What each mode takes for the first number of an answer.
OUTPUT_MODES = {
    "signed": r"[-+]?\d*\.?\d+",
    "notebook": r"\d+\.?\d*",
    "bounded": r"\d+\.?\d*",
    "raw": r"\d+\.?\d*",
}
BOUNDED_LIMIT = 10_000


def to_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def without_money_signs(text: Column) -> Column:
    return strip_whitespace(F.translate(text, "$,", ""))


def parse_price(price: Column) -> Column:
    """``$1,299.00`` -> 1299.0; null if empty, a range, or not a number."""
    return to_number(without_money_signs(price))


def price_in_range(price: Column, low: float = MIN_PRICE, high: float = MAX_PRICE) -> Column:
    """Both ends included. NaN sorts above every number, so it fails too."""
    return price.between(F.lit(low), F.lit(high))


def weight_pounds(item_weight: Column) -> Column:
    """``16 Ounces`` -> 1.0. Unknown, singular or missing units give 0.0.

    Rounded half up to 4 places, which at exact ties may differ by 1e-4 from
    rounding the binary value half to even.
    """
    parts = F.split(collapse_whitespace(item_weight), " ")
    units = F.create_map(*chain.from_iterable((F.lit(u), F.lit(m)) for u, m in POUNDS_PER_UNIT.items()))
    factor = F.try_element_at(units, F.lower(F.try_element_at(parts, F.lit(2))))
    amount = to_number(F.try_element_at(parts, F.lit(1)))
    return F.coalesce(F.round(amount * factor, 4), F.lit(0.0))


def dollars(price: Column) -> Column:
    """Nearest dollar, half to even, as BIGINT."""
    return F.bround(price, 0).cast("bigint")


def completion(price: Column) -> Column:
    return F.concat(dollars(price).cast("string"), F.lit(".00"))


def completion_to_price(text: Column) -> Column:
    return to_number(strip_whitespace(text))


def parse_output(output: Column, mode: str = "signed") -> Column:
    """The first number in a model's answer, 0.0 if there is none.

    signed: reads a sign and a leading point, floors at 0.
    notebook, raw: unsigned, must begin with a digit.
    bounded: as raw, but 0 unless strictly between 0 and 10,000.
    """
    first = F.regexp_extract(without_money_signs(output), OUTPUT_MODES[mode], 0).try_cast("double")
    number = F.coalesce(first, F.lit(0.0))
    if mode == "signed":
        return F.greatest(number, F.lit(0.0))
    if mode == "bounded":
        return F.when(number < BOUNDED_LIMIT, number).otherwise(F.lit(0.0))
    return number


def parse_number_output(output: Column, mode: str = "signed") -> Column:
    """A numeric answer of any width: a double floored at 0, 0.0 for null."""
    number = F.greatest(F.coalesce(output.cast("double"), F.lit(0.0)), F.lit(0.0))
    if mode == "bounded":
        return F.when(number < BOUNDED_LIMIT, number).otherwise(F.lit(0.0))
    return number


def absolute_error(predicted: Column, actual: Column) -> Column:
    return F.abs(predicted - actual)


def price_interval(price: Column, mae: Column) -> tuple[Column, Column]:
    return F.greatest(F.lit(0.0), price - mae), price + mae

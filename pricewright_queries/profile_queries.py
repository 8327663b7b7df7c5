"""H1-H3: histograms and profiles."""

from pyspark.sql import functions as F

from pricewright.functions.tokens import count_tokens
from pricewright.operators import profiling
from pricewright.operators.ranges import range_counts

from . import views
from .registry import query


def _bins(values: str) -> str:
    return f"""
    with v as ({values}),
    r as (select x, min(x) over () as lo, (max(x) over () - min(x) over ()) / 50 as step from v),
    edges as (select i, lo + i * step as low, case when i = 49 then 'Infinity'::double else lo + (i + 1) * step end as high
      from range(50) as e(i), (select lo, step from r limit 1))
    select i as bin, count(x) as items from edges left join r on x >= low and x < high group by i"""


@query("h1_price_histogram", """
    select b as bin, b * 20 as low, case when b < 49 then (b + 1) * 20 end as high, count(price) as items
    from range(50) as e(b) left join product on case when b = 49 then price > 980
      else price >= b * 20 and (price < (b + 1) * 20 or (b = 48 and price = 980)) end
    group by b""", "product")
def price_histogram(spark, sf_dir):
    return profiling.price_histogram(views.product(spark, sf_dir))


@query("h2_text_length_histogram", "select * from (" + _bins("select length(text)::double as x from product") + ")", "product")
def text_length_histogram(spark, sf_dir):
    lengths = views.product(spark, sf_dir).select(F.length("text").alias("n"))
    return profiling.length_histogram(lengths, "n")


@query("h2_token_histogram", "select * from (" + _bins(
    f"select len(regexp_extract_all(text, '{views.PIECE}'))::double as x from documents") + ")")
def token_histogram(spark, sf_dir):
    counts = views.documents(spark, sf_dir).select(count_tokens(F.col("text")).alias("n"))
    return profiling.length_histogram(counts, "n")


@query("h3_category_profile", """
    select category, count(*) as items, round(avg(price), 6) as mean_price, round(avg(length(text)), 6) as mean_text_length
    from product group by category""", "product")
def category_profile(spark, sf_dir):
    return profiling.category_profile(views.product(spark, sf_dir)).withColumns({
        "mean_price": F.round("mean_price", 6), "mean_text_length": F.round("mean_text_length", 6)})


@query("h1_price_bands", """
    select p_partkey as band, count(product_id) as items, min(price) as least, max(price) as most
    from (select p_partkey, p_size * 8.0::double as low, p_size * 8.0::double + case when p_partkey % 7 = 0 then 500 else p_size end as high from part)
    left join product on price between low and high group by p_partkey""", "product")
def price_bands(spark, sf_dir):
    """Products by bands of price that overlap, short and long, one for each part."""
    low = F.col("p_size") * F.lit(8.0)
    bands = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("band"), low.alias("low"), (low + F.when(F.col("p_partkey") % 7 == 0, 500).otherwise(F.col("p_size"))).alias("high"))
    # Prices stand in cents.
    met = range_counts(views.product(spark, sf_dir).select("product_id", "price"), bands, "price", "low", "high", width=0.01)
    counts = met.where("items > 0").groupBy("band").agg(F.sum("items").alias("items"), F.min("least").alias("least"), F.max("most").alias("most"))
    return bands.select("band").join(counts, "band", "left").select("band", F.coalesce("items", F.lit(0)).alias("items"), "least", "most")

"""Weights, draws, positions, splits."""

from pyspark.sql import functions as F

from pricewright.operators import ranking, sampling, splitting
from pricewright.plans.listings import split_listings
from pricewright.session import stage

from . import views
from .registry import query

EVENT_MULTIPLIERS = {"view": 0.05, "click": 0.5}
DRAW = 2_000

_EVENT_WEIGHTS = """
    with base as (select event_id, event_type, value from events where value between 0.5 and 999.49),
    scaled as (select *, (value - min(value) over ()) / (max(value) over () - min(value) over () + 1e-9::double) as s from base),
    weighed as (select *, s * s * case event_type when 'view' then 0.05::double when 'click' then 0.5::double else 1.0::double end as w from scaled),
    drawn as (select event_id, event_type, value from weighed where w > 0
      order by -ln((%s + 0.5::double) / pow(2.0::double, 52)) / w, event_id limit %d)
""" % (views.uniform_bits("event_id"), DRAW)


def _events(spark, sf_dir):
    return views.table(spark, sf_dir, "events").where(F.col("value").between(0.5, 999.49)).select(
        "event_id", F.col("event_type").alias("category"), F.col("value").alias("price"))


@query("d1_price_weight", "select product_id, weight_price from weights", "weights")
def price_weight(spark, sf_dir):
    return sampling.price_weight(views.product(spark, sf_dir)).select("product_id", "weight_price")


@query("d2_category_weight", "select product_id, weight_price * multiplier as sampling_weight from weights", "weights")
def category_weight(spark, sf_dir):
    return sampling.category_weight(views.product(spark, sf_dir)).select("product_id", "sampling_weight")


@query("d3_weight_report", """
    select category, count(*) as items, round(sum(weight_price), 6) as weight_before,
      round(sum(weight_price * multiplier), 6) as weight_after, max(multiplier) as multiplier
    from weights group by category""", "weights")
def weight_report(spark, sf_dir):
    return sampling.weight_report(views.product(spark, sf_dir)).select(
        "category", "items", F.round("weight_before", 6).alias("weight_before"),
        F.round("weight_after", 6).alias("weight_after"), "multiplier")


@query("d4_sampling_probability", """
    select product_id, round(weight_price * multiplier / sum(weight_price * multiplier) over (), 9) as probability
    from weights""", "weights")
def sampling_probability(spark, sf_dir):
    return sampling.sampling_probability(views.product(spark, sf_dir)).select(
        "product_id", F.round("probability", 9).alias("probability"))


@query("d5_weighted_sample", f"{_EVENT_WEIGHTS} select event_id, event_type as category, value as price from drawn")
def weighted_sample(spark, sf_dir):
    return sampling.weighted_sample(_events(spark, sf_dir), DRAW, "event_id", multipliers=EVENT_MULTIPLIERS)


@query("d6_fetch_selected", f"{_EVENT_WEIGHTS} select e.* exclude (ts) from events e join drawn using (event_id)")
def fetch_selected(spark, sf_dir):
    index = sampling.category_weight(_events(spark, sf_dir), EVENT_MULTIPLIERS)
    chosen = sampling.select_by_weight(index, DRAW, "event_id")
    return sampling.fetch_selected(views.table(spark, sf_dir, "events").drop("ts"), chosen, "event_id")


@query("d7_shuffle_key", f"select event_id, {views.uniform_bits('event_id')} as shuffle_key from events")
def shuffle_key(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select("event_id")
    return ranking.with_shuffle_key(events, "event_id")


@query("d7_shuffle_rows", f"""
    select event_id, value, row_number() over (order by {views.uniform_bits('event_id')}, event_id) - 1 as place from events""")
def shuffle_rows(spark, sf_dir):
    """The rows with the places in which they come out."""
    shuffled = ranking.shuffle_rows(views.table(spark, sf_dir, "events").select("event_id", "value"), "event_id")
    told = stage(shuffled.withColumn("_out", F.monotonically_increasing_id()), "shuffled")
    partition = F.shiftright("_out", 33)
    return ranking.with_running_total(told, partition, [F.col("_out")], before="place", total="_n").drop("_out", "_n")


@query("d8_row_position", f"""
    select event_id, row_number() over (order by {views.uniform_bits('event_id')}, event_id) - 1 as pos,
      count(*) over () as n_rows from events""")
def row_position(spark, sf_dir):
    return ranking.with_position(views.table(spark, sf_dir, "events").select("event_id"), "event_id")


@query("d9_sample_distribution", f"""{_EVENT_WEIGHTS}
    select event_type as category, count(*) as items, 100.0::double * count(*) / sum(count(*)) over () as share_pct
    from drawn group by event_type""")
def sample_distribution(spark, sf_dir):
    return sampling.sample_distribution(weighted_sample(spark, sf_dir))


@query("d10_split_dataset", "select product_id, split, pos from product_split", "product_split")
def split_dataset(spark, sf_dir):
    return views.product_split(spark, sf_dir).select("product_id", "split", "pos")


@query("d10_split_fixed_sizes", f"""
    select event_id, case when p < 80 then 'train' when p < 81 then 'val' else 'test' end as split,
      case when p < 80 then p when p < 81 then p - 80 else p - 81 end as pos
    from (select event_id, row_number() over (order by {views.uniform_bits('event_id')}, event_id) - 1 as p from events)
    where p < 82""")
def split_fixed_sizes(spark, sf_dir):
    """The branch that drops the rest, with sizes small enough to reach it."""
    events = views.table(spark, sf_dir, "events").select("event_id")
    return splitting.split_dataset(events, "event_id", full_ends=(80, 81, 82))


@query("d11_split_report", """
    select split, count(*) as items, 100.0::double * count(*) / sum(count(*)) over () as share_pct
    from product_split group by split""", "product_split")
def split_report(spark, sf_dir):
    return splitting.split_report(views.product_split(spark, sf_dir))


@query("d12_head_subset", f"""
    select event_id, value from events order by {views.uniform_bits('event_id')}, event_id limit 5000""")
def head_subset(spark, sf_dir):
    return ranking.head_subset(views.table(spark, sf_dir, "events").select("event_id", "value"), 5_000, "event_id")


@query("d13_uniform_sample", f"""
    select event_id, value from events order by {views.uniform_bits('event_id')}, event_id limit 200""")
def uniform_sample(spark, sf_dir):
    return ranking.uniform_sample(views.table(spark, sf_dir, "events").select("event_id", "value"), 200, "event_id")


@query("d14_eval_price_range", f"""
    select min(value) as min_price, max(value) as max_price from (
      select value from events order by {views.uniform_bits('event_id')}, event_id limit 200)""")
def eval_price_range(spark, sf_dir):
    return sampling.eval_price_range(uniform_sample(spark, sf_dir).withColumnRenamed("value", "price"))


@query("l1_split_whole_listings", """
    select product_id, case when place < train_end then 'train' when place < val_end then 'val' else 'test' end as split,
      place - case when place < train_end then 0 when place < val_end then train_end else val_end end as pos
    from (select *, floor(n * 0.9756::double)::bigint as train_end, floor(n * 0.9878::double)::bigint as val_end
      from (select product_id, row_number() over (order by bits, product_id) - 1 as place, count(*) over () as n from unique_product))""",
    "unique_product")
def split_whole_listings(spark, sf_dir):
    """Without a sample size nothing is drawn, and no unique row is lost."""
    return split_listings(views.raw_listing(spark, sf_dir), max_length=views.MAX_TEXT).select("product_id", "split", "pos")


@query("l1_split_listings", f"""
    select p.product_id, p.title, p.category, p.price, p.text, p.weight, split, pos from (
      select product_id, case when place < train_end then 'train' when place < val_end then 'val' else 'test' end as split,
        place - case when place < train_end then 0 when place < val_end then train_end else val_end end as pos
      from (select *, floor(n * 0.9756::double)::bigint as train_end, floor(n * 0.9878::double)::bigint as val_end
        from (select product_id, row_number() over (order by bits, product_id) - 1 as place, count(*) over () as n
          from (select * from (
              select *, s * s * case category when 'Automotive' then 0.05::double when 'Tools_and_Home_Improvement' then 0.5::double
                  else 1.0::double end as w
              from (select *, (price - min(price) over ()) / ((max(price) over () - min(price) over ()) + 1e-9::double) as s
                from unique_product)) where w > 0
            order by -ln((bits + 0.5::double) / pow(2.0::double, 52)) / w, product_id limit 300)))) s
    join product p using (product_id)""", "unique_product product")
def split_listings_query(spark, sf_dir):
    """Draws fewer rows than there are, so that the weights decide."""
    return split_listings(views.raw_listing(spark, sf_dir), 300, max_length=views.MAX_TEXT).select(
        "product_id", "title", "category", "price", "text", "weight", "split", "pos")

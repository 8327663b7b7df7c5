"""Cleaning and de-duplication."""

from pyspark.sql import functions as F

from pricewright.functions.details import parse_details, serialize_details
from pricewright.functions.numbers import parse_price, price_in_range, weight_pounds
from pricewright.functions.text import collapse_whitespace, strip_part_numbers
from pricewright.operators import cleaning, dedup, ingest_dedup, prompting

from . import views
from .registry import query


@query("c1_parse_price", "select product_id, price_value from priced", "priced")
def parse_price_query(spark, sf_dir):
    return views.raw_listing(spark, sf_dir).select("product_id", parse_price(F.col("price")).alias("price_value"))


@query("c2_price_in_range", "select product_id, price_value between 0.50 and 999.49 as in_range from priced", "priced")
def price_in_range_query(spark, sf_dir):
    return views.raw_listing(spark, sf_dir).select(
        "product_id", price_in_range(parse_price(F.col("price"))).alias("in_range"))


@query("c3_price_validity_report", """
    select total, valid, invalid, out_of_range, 100.0::double * valid / total as valid_pct,
      100.0::double * invalid / total as invalid_pct, 100.0::double * out_of_range / total as out_of_range_pct
    from (select count(*) as total, count(*) filter (price_value between 0.50 and 999.49) as valid,
            count(*) filter (price_value is null) as invalid,
            count(*) filter (price_value not between 0.50 and 999.49) as out_of_range from priced)""", "priced")
def price_validity(spark, sf_dir):
    return cleaning.price_validity_report(views.raw_listing(spark, sf_dir))


@query("c4_parse_details", """
    select product_id, case when object is null then 0 else len(json_keys(object)) end::bigint as n_keys,
      item_weight, json_extract_string(object, '$.Brand') as brand
    from priced""", "priced")
def parse_details_query(spark, sf_dir):
    parsed = views.raw_listing(spark, sf_dir).select("product_id", parse_details(F.col("details")).alias("d"))
    return parsed.select(
        "product_id", F.size("d").cast("bigint").alias("n_keys"),
        F.try_element_at("d", F.lit("Item Weight")).alias("item_weight"),
        F.try_element_at("d", F.lit("Brand")).alias("brand"))


@query("c5_weight_pounds", "select product_id, weight from weighed", "weighed")
def weight_query(spark, sf_dir):
    item_weight = F.try_element_at(parse_details(F.col("details")), F.lit("Item Weight"))
    return views.raw_listing(spark, sf_dir).select("product_id", weight_pounds(item_weight).alias("weight"))


@query("c6_build_text", "select product_id, text from texted", "texted")
def build_text(spark, sf_dir):
    return cleaning.build_text(views.raw_listing(spark, sf_dir), max_length=views.MAX_TEXT).select("product_id", "text")


@query("c7_strip_part_numbers", views.clean_text("documents", "doc_id", "text"))
def strip_part_numbers_query(spark, sf_dir):
    flat = views.documents(spark, sf_dir).select("doc_id", collapse_whitespace(F.col("text")).alias("text"))
    return flat.select("doc_id", strip_part_numbers(F.col("text")).alias("text"))


@query("c8_serialize_details", "select product_id, details_json from priced", "priced")
def serialize_details_query(spark, sf_dir):
    return views.raw_listing(spark, sf_dir).select(
        "product_id", serialize_details(F.col("details")).alias("details_json"))


@query("c9_min_text_filter", "select product_id, length(text) as n_chars from texted where length(text) >= 300", "texted")
def min_text(spark, sf_dir):
    texted = cleaning.build_text(views.raw_listing(spark, sf_dir), max_length=views.MAX_TEXT).select("product_id", "text")
    return cleaning.min_text_filter(texted).select("product_id", F.length("text").cast("bigint").alias("n_chars"))


@query("c10_clean_items", "select * from product", "product")
def clean_items(spark, sf_dir):
    return cleaning.clean_items(views.raw_listing(spark, sf_dir), max_length=views.MAX_TEXT)


@query("c10_label_rejects", """
    select product_id, case when price_value is null then 'unparseable_price'
      when price_value not between 0.50 and 999.49 then 'price_out_of_range'
      when length(text) < 300 then 'text_too_short' end as reject_reason from texted""", "texted")
def label_rejects(spark, sf_dir):
    return cleaning.label_rejects(views.raw_listing(spark, sf_dir)).select("product_id", "reject_reason")


@query("c11_cleaning_report", """
    select category, raw_rows, kept, raw_rows - kept as rejected,
      100.0::double * (raw_rows - kept) / raw_rows as rejected_pct, 100.0::double * kept / raw_rows as kept_pct
    from (select category, count(*) as raw_rows,
            count(*) filter (price_value between 0.50 and 999.49 and length(text) >= 300) as kept
          from texted group by category)""", "texted")
def cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(views.raw_listing(spark, sf_dir))


@query("c11_grouped_report", """
    select grouping_id(category, split, reason) as grouping, category, split, reason, count(*) as items
    from (select category, split, case when price_value is null then 'unparseable_price'
            when price_value not between 0.50 and 999.49 then 'price_out_of_range'
            when length(text) < 300 then 'text_too_short' end as reason
          from texted left join (select product_id, split from product_split) using (product_id))
    group by grouping sets ((category, split), (category, reason), (category), (split), (reason), ())""", "texted product_split")
def grouped_report(spark, sf_dir):
    return cleaning.grouped_report(views.raw_listing(spark, sf_dir), views.product_split(spark, sf_dir))


@query("c12_before_after_sample", """
    select product_id, price as raw_price,
      substr(array_to_string(description, ' ') || array_to_string(features, ' '), 1, 200) as raw_text,
      price_value as price, weight, substr(text, 1, 300) as text
    from texted where price_value between 0.50 and 999.49 and length(text) >= 300
    order by product_id limit 1""", "texted")
def before_after(spark, sf_dir):
    return cleaning.before_after_sample(views.raw_listing(spark, sf_dir))


@query("u1_dedup_title", "select product_id, title from by_title", "by_title")
def dedup_title(spark, sf_dir):
    return dedup.dedup_title(views.product(spark, sf_dir)).select("product_id", "title")


@query("u2_dedup_text", "select product_id, title, price, text from unique_product", "unique_product")
def dedup_text(spark, sf_dir):
    return dedup.dedup_title_then_text(views.product(spark, sf_dir)).select("product_id", "title", "price", "text")


@query("u2_dedup_ingests", "select product_id, title, price, text from unique_product", "unique_product")
def dedup_ingests(spark, sf_dir):
    """Three ingests, the second with rows of the first again, leave what one would."""
    products = views.product(spark, sf_dir)
    parts = [F.col("product_id") % 3 == 0, F.col("product_id") % 3 <= 1, F.col("product_id") % 3 == 2]
    name = None
    for part in parts:
        name = ingest_dedup.ingest(spark, name, products.where(part))
    left = ingest_dedup.ingested_survivors(ingest_dedup.read_index(spark, name))
    return products.join(left, "product_id", "left_semi").select("product_id", "title", "price", "text")


@query("u2_dedup_text_alone", f"""
    select product_id, doc_text as text from (
      select doc_id as product_id, text as doc_text,
        row_number() over (partition by text order by {views.uniform_bits('doc_id')}, doc_id) as copy
      from documents) where copy = 1""")
def dedup_text_alone(spark, sf_dir):
    documents = views.documents(spark, sf_dir).select(F.col("doc_id").alias("product_id"), "text")
    return dedup.dedup_text(documents)


@query("u2_dedup_null_texts", f"""
    select product_id, summary from (
      select *, row_number() over (partition by coalesce(summary, 'id ' || product_id) order by {views.uniform_bits('product_id')}, product_id) as copy
      from prepared) where copy = 1""", "prepared")
def dedup_null_texts(spark, sf_dir):
    """A prepared dataset, whose texts are all null: copies are told by their summaries, and rows without one stay."""
    products = prompting.attach_summaries(views.product_split(spark, sf_dir), views.summaries(spark, sf_dir))
    return dedup.dedup_text(products).select("product_id", "summary")


@query("u3_dedup_report", """
    select (select count(*) from product) as "before", (select count(*) from by_title) as after_title,
      (select count(*) from unique_product) as after_text""", "product by_title unique_product")
def dedup_report(spark, sf_dir):
    return dedup.dedup_report(views.product(spark, sf_dir))

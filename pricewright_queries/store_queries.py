"""Listings and datasets at rest."""

from pyspark.sql import functions as F

from pricewright.constants import CATEGORIES
from pricewright.session import stage_path
from pricewright.sources import catalog, datasets

from . import views
from .registry import query

LITE_SIZES = {"train": 200, "val": 5, "test": 5}


def _catalog(spark, sf_dir) -> str:
    path = stage_path(spark, "catalog")
    catalog.write_catalog(views.raw_listing(spark, sf_dir), path)
    return path


def _dataset(spark, sf_dir) -> str:
    path = stage_path(spark, "dataset")
    datasets.write_splits(views.product_split(spark, sf_dir), path)
    return path


@query("s1_read_catalog", """
    select product_id, category, title, price, details from raw_listing where category = 'Automotive'""", "raw_listing")
def read_catalog(spark, sf_dir):
    return catalog.read_catalog(spark, _catalog(spark, sf_dir), "Automotive").select(
        "product_id", "category", "title", "price", "details")


@query("s2_read_catalogs", """
    select product_id, category, title, price, description, features, details from raw_listing""", "raw_listing")
def read_catalogs(spark, sf_dir):
    return catalog.read_catalogs(spark, _catalog(spark, sf_dir)).select(
        "product_id", "category", "title", "price", "description", "features", "details")


@query("s2_union_catalogs", "select category, product_id, title from raw_listing", "raw_listing")
def union_catalogs(spark, sf_dir):
    raw = views.raw_listing(spark, sf_dir)
    return catalog.union_catalogs({
        c: raw.where(F.col("category") == c).select("product_id", "title") for c in CATEGORIES
    }).select("category", "product_id", "title")


@query("s2_with_product_id", """
    select row_number() over (order by md5(to_json({
        title: title, category: category, price: price, description: description, features: features, details: details}))) - 1 as product_id,
      title, price, array_to_string(description, chr(10)) as description, features[1] as feature, details
    from raw_listing""", "raw_listing")
def with_product_id(spark, sf_dir):
    raw = views.raw_listing(spark, sf_dir).select("title", "category", "price", "description", "features", "details")
    return catalog.with_product_id(raw).select(
        "product_id", "title", "price", F.array_join("description", "\n").alias("description"),
        F.get("features", F.lit(0)).alias("feature"), "details")


@query("s3_describe_raw", """
    with one as (select * from raw_listing order by product_id limit 1)
    select 'product_id' as "column", product_id::varchar as "value" from one
    union all select 'title', substr(title, 1, 100) from one
    union all select 'category', substr(category, 1, 100) from one
    union all select 'price', substr(price, 1, 100) from one
    union all select 'description', substr('[' || array_to_string(description, ', ') || ']', 1, 100) from one
    union all select 'features', substr('[' || array_to_string(features, ', ') || ']', 1, 100) from one
    union all select 'details', substr(details, 1, 100) from one""".replace("with one as", "select * from (with one as") + ")",
    "raw_listing")
def describe_raw(spark, sf_dir):
    return catalog.describe_raw(views.raw_listing(spark, sf_dir))


@query("s4_ingest_missing", """
    select category, case when category = 'Appliances' then 'already stored' else 'stored' end as status,
      case when category <> 'Appliances' then count(*) end as raw_rows,
      case when category <> 'Appliances'
        then count(*) filter (price_value between 0.50 and 999.49 and length(text) >= 300) end as kept
    from texted group by category""", "texted")
def ingest_missing(spark, sf_dir):
    source, target = _catalog(spark, sf_dir), stage_path(spark, "ingested")

    def load(category):
        return catalog.read_catalog(spark, source, category)

    catalog.ingest_missing(spark, load, target, ["Appliances"])
    return catalog.ingest_missing(spark, load, target).drop("error")


@query("s5_write_splits", "select product_id, split, pos, title, price, text, weight, summary from product_split", "product_split")
def write_splits(spark, sf_dir):
    return datasets.read_split(spark, _dataset(spark, sf_dir)).select(
        "product_id", "split", "pos", "title", "price", "text", "weight", "summary")


@query("s6_write_lite", """
    select product_id, split, pos from product_split
    where (split = 'train' and pos < 200) or (split <> 'train' and pos < 5)""", "product_split")
def write_lite(spark, sf_dir):
    path = stage_path(spark, "lite")
    datasets.write_lite(datasets.read_split(spark, _dataset(spark, sf_dir)), path, LITE_SIZES)
    return datasets.read_split(spark, path).select("product_id", "split", "pos")


@query("s7_verify_dataset", """
    select split, count(*) as items, '' as missing_fields,
      max(case when pos = 0 then substr(title, 1, 60) end) as sample_title,
      max(case when pos = 0 then price end) as sample_price
    from product_split group by split""", "product_split")
def verify_dataset(spark, sf_dir):
    return datasets.verify_dataset(spark, _dataset(spark, sf_dir))


@query("s8_read_split", "select product_id, pos, title, price from product_split where split = 'test'", "product_split")
def read_split(spark, sf_dir):
    return datasets.read_split(spark, _dataset(spark, sf_dir), "test").select("product_id", "pos", "title", "price")


@query("s9_write_prompts", "select product_id, split, pos, prompt, completion from prompt", "prompt")
def write_prompts(spark, sf_dir):
    path = stage_path(spark, "prompts")
    datasets.write_prompts(views.prompts(spark, sf_dir), path)
    return datasets.read_split(spark, path).select("product_id", "split", "pos", "prompt", "completion")

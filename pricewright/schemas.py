"""Declared schemas of the tables that flow between operators."""

from pyspark.sql import types as T

RAW_LISTING = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("description", T.ArrayType(T.StringType())),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("details", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("summary", T.StringType()),
])

PRODUCT_FIELDS = ("title", "category", "price", "text", "weight", "summary")

DEAL = T.StructType([
    T.StructField("deal_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("url", T.StringType()),
    T.StructField("specialist", T.DoubleType()),
    T.StructField("frontier", T.DoubleType()),
])

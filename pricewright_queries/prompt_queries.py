"""Summaries, tokens, prompts."""

from pyspark.sql import functions as F

from pricewright.functions import prompts as columns
from pricewright.functions.numbers import completion
from pricewright.functions.text import effective_text
from pricewright.functions.tokens import count_tokens, truncate_tokens
from pricewright.operators import prompting
from pricewright.plans.prompts import publish_prompts
from pricewright.session import stage_path
from pricewright.sources import datasets

from . import views
from .registry import query


@query("p1_format_summary", "select product_id, summary from summaries", "summaries")
def format_summary(spark, sf_dir):
    return views.summaries(spark, sf_dir)


@query("p2_summary_title", """
    select product_id, substr(replace(split_part(summary, chr(10), 1), 'Title: ', ''), 1, 28) as title_head
    from summaries""", "summaries")
def summary_title(spark, sf_dir):
    return views.summaries(spark, sf_dir).select(
        "product_id", columns.summary_title(F.col("summary")).alias("title_head"))


@query("p2_parse_summary", r"""
    select product_id,
      nullif(regexp_extract(summary, '(?s)(?:^|\n)Title: (.*?)(?:\n(?:Title|Category|Brand|Description|Details): |\z)', 1), '') as title,
      nullif(regexp_extract(summary, '(?s)(?:^|\n)Category: (.*?)(?:\n(?:Title|Category|Brand|Description|Details): |\z)', 1), '') as category,
      nullif(regexp_extract(summary, '(?s)(?:^|\n)Brand: (.*?)(?:\n(?:Title|Category|Brand|Description|Details): |\z)', 1), '') as brand,
      nullif(regexp_extract(summary, '(?s)(?:^|\n)Description: (.*?)(?:\n(?:Title|Category|Brand|Description|Details): |\z)', 1), '') as description,
      nullif(regexp_extract(summary, '(?s)(?:^|\n)Details: (.*?)(?:\n(?:Title|Category|Brand|Description|Details): |\z)', 1), '') as details
    from summaries""", "summaries")
def parse_summary(spark, sf_dir):
    return views.summaries(spark, sf_dir).select(
        "product_id", columns.parse_summary(F.col("summary")).alias("s")).select("product_id", "s.*")


@query("p3_attach_summaries", """
    select product_id, price, cast(null as varchar) as text, s.summary
    from product p left join summaries s using (product_id)""", "product summaries")
def attach_summaries(spark, sf_dir):
    return prompting.attach_summaries(views.product(spark, sf_dir), views.summaries(spark, sf_dir)).select(
        "product_id", "price", "text", "summary")


@query("p4_effective_text", "select product_id, body from tokenized", "tokenized")
def effective_text_query(spark, sf_dir):
    return views.prepared(spark, sf_dir).select(
        "product_id", effective_text(F.col("summary"), F.col("text")).alias("body"))


@query("p5_count_tokens", f"select doc_id, len(regexp_extract_all(text, '{views.PIECE}')) as n_tokens from documents")
def count_tokens_query(spark, sf_dir):
    return views.documents(spark, sf_dir).select("doc_id", count_tokens(F.col("text")).alias("n_tokens"))


@query("p6_truncate_tokens", f"""
    select doc_id, case when len(pieces) > 98 then array_to_string(pieces[1:98], '') else text end as text
    from (select doc_id, text, regexp_extract_all(text, '{views.PIECE}') as pieces from documents)""")
def truncate_tokens_query(spark, sf_dir):
    return views.documents(spark, sf_dir).select("doc_id", truncate_tokens(F.col("text")).alias("text"))


@query("p7_training_prompt", f"""
    select product_id, 'What does this cost to the nearest dollar?' || chr(10) || chr(10)
      || regexp_replace(body, '{views.EDGES}', '', 'g') || chr(10) || chr(10) || 'Price is $'
      || round_even(price, 0)::bigint || '.00' as prompt,
      round_even(price, 0)::bigint || '.00' as completion from tokenized""", "tokenized")
def training_prompt(spark, sf_dir):
    body = effective_text(F.col("summary"), F.col("text"))
    return views.prepared(spark, sf_dir).select(
        "product_id", columns.training_prompt(body, F.col("price")).alias("prompt"),
        completion(F.col("price")).alias("completion"))


@query("p8_inference_prompt", f"""
    select product_id, 'What does this cost to the nearest dollar?' || chr(10) || chr(10)
      || regexp_replace(body, '{views.EDGES}', '', 'g') || chr(10) || chr(10) || 'Price is $' as prompt
    from tokenized""", "tokenized")
def inference_prompt(spark, sf_dir):
    body = effective_text(F.col("summary"), F.col("text"))
    return views.prepared(spark, sf_dir).select("product_id", columns.inference_prompt(body).alias("prompt"))


@query("p9_build_prompts", "select product_id, split, pos, prompt, completion, truncated from prompt", "prompt")
def build_prompts(spark, sf_dir):
    return views.prompts(spark, sf_dir)


@query("p10_truncation_report", """
    select split, items, truncated, 100.0::double * truncated / items as truncated_pct,
      100.0::double * truncated / items > 10 as high
    from (select split, count(*) as items, count(*) filter (truncated) as truncated from prompt group by split)""", "prompt")
def truncation_report(spark, sf_dir):
    return prompting.truncation_report(views.prompts(spark, sf_dir))


@query("p11_token_profile", """
    select count(*) as items, round(avg(n), 6) as mean_tokens, median(n)::double as median_tokens,
      round(quantile_cont(n, 0.95), 6) as p95_tokens, max(n) as max_tokens
    from (select len(pieces) as n from tokenized where split = 'train')""", "tokenized")
def token_profile(spark, sf_dir):
    return prompting.token_profile(views.prepared(spark, sf_dir)).withColumns({
        "mean_tokens": F.round("mean_tokens", 6), "p95_tokens": F.round("p95_tokens", 6)})


@query("p12_cutoff_sweep", """
    select cutoff, round(100.0::double * count(*) filter (n > cutoff - 30) / count(*), 6) as truncated_pct, cutoff = 128 as chosen
    from (select len(pieces) as n from tokenized where split = 'train'),
      (values (64), (96), (128), (160), (192), (256)) as c(cutoff) group by cutoff""", "tokenized")
def cutoff_sweep(spark, sf_dir):
    return prompting.cutoff_sweep(views.prepared(spark, sf_dir)).withColumn(
        "truncated_pct", F.round("truncated_pct", 6))


@query("p13_prompt_word_stats", f"""
    select count(*) as items, round(avg(n), 6) as mean_words, -quantile_disc(-n, 0.5) as median_words, max(n) as max_words
    from (select len(regexp_extract_all(prompt, '[^\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+')) as n
          from prompt where split = 'train')""", "prompt")
def prompt_word_stats(spark, sf_dir):
    return prompting.prompt_word_stats(views.prompts(spark, sf_dir)).withColumn(
        "mean_words", F.round("mean_words", 6))


@query("p14_mask_answer", """
    select product_id, split_part(prompt, 'Price is $', 1) || 'Price is $[answer hidden]' as masked
    from prompt where split = 'train'""", "prompt")
def mask_answer(spark, sf_dir):
    return views.prompts(spark, sf_dir).where("split = 'train'").select(
        "product_id", columns.mask_answer(F.col("prompt")).alias("masked"))


@query("p15_prompt_sample", "select split, prompt, completion from prompt where pos = 0 and split in ('train', 'test')", "prompt")
def prompt_sample(spark, sf_dir):
    return prompting.prompt_sample(views.prompts(spark, sf_dir))


@query("l2_publish_prompts", "select product_id, split, pos, prompt, completion from prompt", "prompt")
def publish(spark, sf_dir):
    source, target = stage_path(spark, "prepared"), stage_path(spark, "published")
    datasets.write_splits(views.prepared(spark, sf_dir), source)
    publish_prompts(spark, source, target)
    return datasets.read_split(spark, target).select("product_id", "split", "pos", "prompt", "completion")

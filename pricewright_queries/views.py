"""Derived tables on the driver's parquet files, for Spark and for DuckDB.

Each view is written twice: as DataFrame code over the library, and as plain
SQL that shares nothing with it.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.functions.details import parse_details
from pricewright.functions.prompts import format_summary
from pricewright.operators.cleaning import clean_items, joined_list
from pricewright.operators.prompting import build_prompts
from pricewright.operators.splitting import split_dataset
from pricewright.session import stage, stage_generation

MAX_TEXT = 4000

_staged: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A view several queries start from: stored once, until stages are dropped."""
    key = (*stage_generation(spark), sf_dir, name)
    if key not in _staged:
        _staged[key] = stage(build(spark, sf_dir), name)
    return _staged[key]


def raw_listing(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """A listing for every document that has an event and a part; with ``only``, of the documents named there."""
    texts = documents(spark, sf_dir)
    if only is not None:
        texts = texts.join(only, "doc_id", "left_semi")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    joined = texts.join(events, F.col("event_id") == F.col("doc_id")).join(
        parts, F.col("p_partkey") == F.col("doc_id")
    )
    return joined.selectExpr(
        "doc_id as product_id",
        "substring_index(text, '.', 1) as title",
        """case when doc_id % 3 = 0 then 'Automotive' else element_at(array(
             'Electronics', 'Office_Products', 'Tools_and_Home_Improvement', 'Cell_Phones_and_Accessories',
             'Toys_and_Games', 'Appliances', 'Musical_Instruments', 'Automotive'), cast(doc_id % 8 as int) + 1)
           end as category""",
        """case when doc_id % 10 = 7 then ''
             when doc_id % 10 = 9 then concat('from ', cast(cast(value * 3 as decimal(12,2)) as string))
             when cast(value * 3 as decimal(12,2)) >= 1000
               then concat('$1,', substr(cast(cast(value * 3 as decimal(12,2)) as string), 2))
             else concat('$', cast(cast(value * 3 as decimal(12,2)) as string)) end as price""",
        r"split(text, '\\n') as description",
        """array(concat('Model B0', lpad(cast((doc_id * 7919) % 100000000 as string), 8, '0')),
             concat('Brand: ', p_brand)) as features""",
        """case when doc_id % 11 = 5 then ''
             when doc_id % 11 = 6 then '{broken'
             when doc_id % 13 = 6 then concat('{"Brand": "', p_brand, '"}')
             else concat('{"Item Weight": "', cast(p_size as string), ' ', element_at(array(
               'pounds', 'ounces', 'grams', 'milligrams', 'kilograms', 'pound', 'Pounds'),
               cast(doc_id % 7 as int) + 1), '", "Brand": "', p_brand, '"}') end as details""",
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "product", lambda s, d: clean_items(raw_listing(s, d), max_length=MAX_TEXT))


def product_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_dataset(product(spark, sf_dir))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary for every document that has a label."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("product_id"))
    # Texts without a label stay where they are: they are left out before the listing is joined.
    raw = raw_listing(spark, sf_dir, labels.withColumnRenamed("product_id", "doc_id"))
    brand = F.try_element_at(parse_details(F.col("details")), F.lit("Brand"))
    return raw.select(
        "product_id",
        format_summary(
            F.col("title"), F.col("category"), brand, joined_list(raw, "description", "\n"), joined_list(raw, "features")
        ).alias("summary"),
    )


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split products; those with a label also have a summary."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Positions are settled on ids and places in files alone; the texts move once, by id, to both their split and their summary.
        place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
        rows = product(spark, sf_dir).select("*", *place).drop("summary")
        placed = split_dataset(stage(rows.select("product_id", "_file", "_row"), "product-places"))
        placed = placed.select("product_id", F.struct("_file", "_row").alias("_at"), "split", "pos")
        # Ids that repeat are told apart by a condition that is no key of the join.
        here = F.struct("_file", "_row")
        joined = rows.join(placed, (rows["product_id"] == placed["product_id"]) & (here <= F.col("_at")) & (here >= F.col("_at")))
        return joined.drop(placed["product_id"]).drop("_file", "_row", "_at").join(summaries(spark, sf_dir), "product_id", "left")

    return once(spark, sf_dir, "prepared", build)


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_prompts(prepared(spark, sf_dir))


def model_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = F.array(*[
        F.struct(F.lit(name).alias("model_name"), F.lit(k).alias("k"))
        for k, name in enumerate(("model_a", "model_b", "model_c"))
    ])
    amount = "cast(cast(value as decimal(12,2)) as string)"
    return (
        table(spark, sf_dir, "events").select("event_id", "value", F.inline(models)).selectExpr(
            "event_id as item_id", "model_name", "value as actual",
            f"""case when (event_id + k) % 6 = 0 then concat('$', {amount})
                  when (event_id + k) % 6 = 1 then {amount}
                  when (event_id + k) % 6 = 2 then concat('about $', {amount}, ' or so')
                  when (event_id + k) % 6 = 3 then concat('-', {amount})
                  when (event_id + k) % 6 = 4 then '.5'
                  else 'N/A' end as output""",
        )
    )


def deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = "cast(cast(value as decimal(12,2)) as string)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as deal_id", "cast(ts as timestamp) as ts", "value as price",
        f"""case when event_id % 4 = 0 then concat('Widget ', cast(event_id as string), ' for $', {amount})
              when event_id % 4 = 1 then concat('$', {amount}, ' OFF Widget')
              when event_id % 4 = 2 then 'Deal ends tonight'
              else 'Free shipping on orders over $25' end as title""",
        "concat('Title: Widget ', cast(event_id as string)) as description",
        "concat('https://deals.example/', cast(event_id % 500 as string)) as url",
        "value * 1.25D as specialist",
        "case when event_id % 50 = 0 then 0.0D else value * (1 + (event_id % 10) / 5.0D) end as frontier",
    )


SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
EDGES = rf"^{SPACE}+|{SPACE}+$"
WORD = r"\p{L}\p{N}_"
PIECE = rf"{SPACE}*(?:[{WORD}]+|[^{WORD}\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}])"
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def uniform_bits(column: str) -> str:
    return f"('0x' || substr(md5('42:' || {column}), 1, 13))::BIGINT"


def clean_text(source: str, key: str, column: str, cut: str = "") -> str:
    """Subquery (key, text): whitespace collapsed, part numbers removed by position."""
    body = f"""case when p = 0 then t else array_to_string([
        case when regexp_full_match(w, '[A-Z0-9]{{7,}}') then '' else w end
        for w in regexp_extract_all(substr(t, 1, ending), '[{WORD}]+|[^{WORD}]+')], '') || substr(t, ending + 1) end"""
    return f"""
    with flat as (select {key}, trim(regexp_replace({column}, '{SPACE}+', ' ', 'g')) as t from {source}),
    placed as (select *, least(length(regexp_extract(t, '(?s)^.*[A-Z]')),
                               length(regexp_extract(t, '(?s)^.*\\p{{Nd}}'))) as p from flat),
    ended as (select *, p + length(regexp_extract(substr(t, p + 1), '^[{WORD}]*')) as ending from placed)
    select {key}, {f'substr({body}, 1, {cut})' if cut else body} as text from ended"""


_CTES = {
    "raw_listing": ((), """
    select d.doc_id as product_id,
      split_part(d.text, '.', 1) as title,
      case when d.doc_id % 3 = 0 then 'Automotive' else list_extract([
        'Electronics','Office_Products','Tools_and_Home_Improvement','Cell_Phones_and_Accessories',
        'Toys_and_Games','Appliances','Musical_Instruments','Automotive'], cast(d.doc_id % 8 as int) + 1) end as category,
      case when d.doc_id % 10 = 7 then ''
           when d.doc_id % 10 = 9 then concat('from ', cast(cast(e.value * 3 as decimal(12,2)) as varchar))
           when cast(e.value * 3 as decimal(12,2)) >= 1000 then concat('$1,', substr(cast(cast(e.value * 3 as decimal(12,2)) as varchar), 2))
           else concat('$', cast(cast(e.value * 3 as decimal(12,2)) as varchar)) end as price,
      string_split(d.text, chr(10)) as description,
      [concat('Model B0', lpad(cast((d.doc_id * 7919) % 100000000 as varchar), 8, '0')), concat('Brand: ', p.p_brand)] as features,
      case when d.doc_id % 11 = 5 then ''
           when d.doc_id % 11 = 6 then '{broken'
           when d.doc_id % 13 = 6 then concat('{"Brand": "', p.p_brand, '"}')
           else concat('{"Item Weight": "', cast(p.p_size as varchar), ' ', list_extract([
             'pounds','ounces','grams','milligrams','kilograms','pound','Pounds'], cast(d.doc_id % 7 as int) + 1),
             '", "Brand": "', p.p_brand, '"}') end as details
    from documents d join events e on e.event_id = d.doc_id join part p on p.p_partkey = d.doc_id"""),
    "stripped": (("raw_listing",), f"""
    select *, regexp_replace(replace(replace(price, '$', ''), ',', ''), '{EDGES}', '', 'g') as bare,
      case when json_valid(details) then details end as object
    from raw_listing"""),
    "priced": (("stripped",), f"""
    select *, case when regexp_full_match(bare, '{NUMBER}') then try_cast(bare as double) end as price_value,
      case when object is null then '{{}}' else
        '{{' || array_to_string(
          ['"' || k || '": "' || json_extract_string(object, '$."' || k || '"') || '"' for k in json_keys(object)], ', '
        ) || '}}' end as details_json,
      json_extract_string(object, '$."Item Weight"') as item_weight
    from stripped"""),
    "weighed": (("priced",), f"""
    select *, case when item_weight is null then 0.0 else coalesce(round(
        try_cast(split_part(item_weight, ' ', 1) as double) * case lower(split_part(item_weight, ' ', 2))
          when 'pounds' then 1.0::double when 'ounces' then 1.0::double / 16
          when 'grams' then 1.0::double / 453.592::double when 'milligrams' then 1.0::double / 453592
          when 'kilograms' then 1.0::double / 0.453592::double end, 4), 0.0) end as weight,
      title || chr(10) || array_to_string(description, ' ') || chr(10) || array_to_string(features, ' ')
        || chr(10) || details_json as combined
    from priced"""),
    "texted": (("weighed",), f"""
    select w.*, c.text from weighed w join ({clean_text('weighed', 'product_id', 'combined', '4000')}) c using (product_id)"""),
    "product": (("texted",), """
    select product_id, title, category, price_value as price, text, weight, cast(null as varchar) as summary
    from texted where price_value between 0.50 and 999.49 and length(text) >= 300"""),
    "hashed": (("product",), f"select *, {uniform_bits('product_id')} as bits from product"),
    "by_title": (("hashed",), """
    select * from hashed qualify row_number() over (partition by title order by bits, product_id) = 1"""),
    "unique_product": (("by_title",), """
    select * from by_title qualify row_number() over (partition by text order by bits, product_id) = 1"""),
    "product_split": (("hashed",), """
    select h.* exclude (bits, n, place), case when place < train_end then 'train' when place < val_end then 'val' else 'test' end as split,
      place - case when place < train_end then 0 when place < val_end then train_end else val_end end as pos
    from (select *, floor(n * 0.9756::double)::bigint as train_end, floor(n * 0.9878::double)::bigint as val_end
          from (select *, row_number() over (order by bits, product_id) - 1 as place, count(*) over () as n from hashed)) h"""),
    "weights": (("product",), """
    select *, ((price - lo) / ((hi - lo) + 1e-9::double)) * ((price - lo) / ((hi - lo) + 1e-9::double)) as weight_price,
      case category when 'Automotive' then 0.05::double when 'Tools_and_Home_Improvement' then 0.5::double else 1.0::double end as multiplier
    from (select *, min(price) over () as lo, max(price) over () as hi from product)"""),
    "summaries": (("priced",), """
    select product_id, concat_ws(chr(10),
      case when title <> '' then 'Title: ' || title end,
      case when category <> '' then 'Category: ' || category end,
      case when json_extract_string(object, '$.Brand') <> '' then 'Brand: ' || json_extract_string(object, '$.Brand') end,
      case when array_to_string(description, chr(10)) <> '' then 'Description: ' || array_to_string(description, chr(10)) end,
      case when array_to_string(features, ' ') <> '' then 'Details: ' || array_to_string(features, ' ') end) as summary
    from priced where product_id in (select doc_id from labels)"""),
    "prepared": (("product_split", "summaries"), """
    select p.* exclude (summary), s.summary from product_split p left join summaries s using (product_id)"""),
    "tokenized": (("prepared",), f"""
    select *, regexp_extract_all(body, '{PIECE}') as pieces
    from (select *, coalesce(nullif(summary, ''), text, '') as body from prepared)"""),
    "prompt": (("tokenized",), f"""
    select product_id, split, pos, price, truncated,
      'What does this cost to the nearest dollar?' || chr(10) || chr(10) || regexp_replace(cut, '{EDGES}', '', 'g')
        || chr(10) || chr(10) || 'Price is $' || case when split = 'test' then '' else completion end as prompt, completion
    from (select *, len(pieces) > 98 as truncated, round_even(price, 0)::bigint || '.00' as completion,
            case when len(pieces) > 98 then array_to_string(pieces[1:98], '') else body end as cut
          from tokenized)"""),
    "model_output": ((), """
    select event_id as item_id, m.model_name, value as actual,
      case when (event_id + m.k) % 6 = 0 then concat('$', cast(cast(value as decimal(12,2)) as varchar(20)))
           when (event_id + m.k) % 6 = 1 then cast(cast(value as decimal(12,2)) as varchar(20))
           when (event_id + m.k) % 6 = 2 then concat('about $', cast(cast(value as decimal(12,2)) as varchar(20)), ' or so')
           when (event_id + m.k) % 6 = 3 then concat('-', cast(cast(value as decimal(12,2)) as varchar(20)))
           when (event_id + m.k) % 6 = 4 then '.5'
           else 'N/A' end as output
    from events cross join (values ('model_a', 0), ('model_b', 1), ('model_c', 2)) as m(model_name, k)"""),
    "scored": (("model_output",), r"""
    select *, abs(predicted - actual) as abs_error from (
      select *, greatest(0.0, coalesce(try_cast(nullif(regexp_extract(
        replace(replace(output, '$', ''), ',', ''), '[-+]?\d*\.?\d+'), '') as double), 0.0)) as predicted
      from model_output)"""),
    "sampled": (("scored",), f"""
    select s.* from scored s where item_id in (
      select event_id from events order by {uniform_bits('event_id')}, event_id limit 200)"""),
    "results": (("sampled",), """
    select model_name, avg(abs_error) as mae, count(*) as sample_size from sampled group by 1"""),
    "deal": ((), """
    select event_id as deal_id, ts, value as price,
      case when event_id % 4 = 0 then concat('Widget ', cast(event_id as varchar(20)), ' for $', cast(cast(value as decimal(12,2)) as varchar(20)))
           when event_id % 4 = 1 then concat('$', cast(cast(value as decimal(12,2)) as varchar(20)), ' OFF Widget')
           when event_id % 4 = 2 then 'Deal ends tonight'
           else 'Free shipping on orders over $25' end as title,
      concat('Title: Widget ', cast(event_id as varchar(20))) as description,
      concat('https://deals.example/', cast(event_id % 500 as varchar(20))) as url,
      value * 1.25 as specialist,
      case when event_id % 50 = 0 then 0.0 else value * (1 + (event_id % 10) / 5.0) end as frontier
    from events"""),
    "judged": (("deal",), """
    select *, case when discount >= 0.40 then 'alert' else 'skip' end as status
    from (select *, case when estimate > 0 then (estimate - price) / estimate else 0.0 end as discount
          from (select *, frontier * 0.7::double + specialist * 0.3::double as estimate from deal))"""),
}


def with_views(select: str, *names: str) -> str:
    """``select`` preceded by the named views and all they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    views = ",\n".join(f"{name} as materialized ({_CTES[name][1]})" for name in ordered)
    return f"with {views}\n{select}" if views else select

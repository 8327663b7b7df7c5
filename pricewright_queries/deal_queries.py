"""Deals, alerts, intervals, and the stream."""

from pyspark.sql import functions as F

from pricewright.functions.deals import discount, ensemble_price
from pricewright.operators import dealing, evaluation
from pricewright.operators.asof import asof_join
from pricewright.session import stage_path
from pricewright.streaming.deals import read_deals, read_scored, stream_deals, stream_first_alerts

from . import views
from .evaluation_queries import _results
from .registry import query


@query("a1_curate_deals", r"""
    select deal_id, title, stated as price, estimate, (estimate - stated) / estimate as discount, url
    from (select *, try_cast(regexp_extract(title, 'for \$(\d[\d,]*(\.\d+)?)', 1) as double) as stated from judged)
    where stated is not null and title not like '%OFF%' and title not like '%ends tonight%' and title not like '%shipping%over $%'
    order by case when estimate > 0 then (estimate - stated) / estimate else 0 end desc, deal_id limit 5""", "judged")
def curate_deals(spark, sf_dir):
    return dealing.curate_deals(views.deal(spark, sf_dir))


@query("a2_ensemble_price", "select deal_id, estimate from judged", "judged")
def ensemble(spark, sf_dir):
    return views.deal(spark, sf_dir).select(
        "deal_id", ensemble_price(F.col("frontier"), F.col("specialist")).alias("estimate"))


@query("a2_weighted_ensemble", "select deal_id, round(estimate, 6) as estimate from judged", "judged")
def weighted_ensemble(spark, sf_dir):
    predictors = F.inline(F.array(*[
        F.struct(F.lit(p).alias("predictor"), F.col(p).alias("estimate")) for p in ("specialist", "frontier")]))
    estimates = views.deal(spark, sf_dir).select("deal_id", predictors)
    return dealing.weighted_ensemble(estimates, {"frontier": 0.7, "specialist": 0.3}).withColumn(
        "estimate", F.round("estimate", 6))


@query("a3_discount", """
    select deal_id, case when frontier > 0 then (frontier - price) / frontier else 0.0 end as discount from deal""", "deal")
def discounts(spark, sf_dir):
    """Against one predictor alone, whose zeros reach the guard."""
    return views.deal(spark, sf_dir).select("deal_id", discount(F.col("frontier"), F.col("price")).alias("discount"))


@query("a4_deal_alerts", "select deal_id, title, price, estimate, discount, url from judged where status = 'alert'", "judged")
def deal_alerts(spark, sf_dir):
    return dealing.deal_alerts(views.deal(spark, sf_dir))


@query("a4_deal_labels", "select deal_id, discount, status from judged", "judged")
def deal_labels(spark, sf_dir):
    return dealing.score_deals(views.deal(spark, sf_dir)).select("deal_id", "discount", "status")


@query("a5_alert_summary", "select count(*) filter (status = 'alert') as alerts, count(*) as deals from judged", "judged")
def alert_summary(spark, sf_dir):
    return dealing.alert_summary(dealing.score_deals(views.deal(spark, sf_dir)))


@query("a5_alerts_per_hour", """
    select time_bucket(interval 1 hour, ts) as start, time_bucket(interval 1 hour, ts) + interval 1 hour as "end",
      count(*) filter (status = 'alert') as alerts, count(*) as deals from judged group by 1, 2""", "judged")
def alerts_per_hour(spark, sf_dir):
    windows = dealing.alerts_per_window(dealing.score_deals(views.deal(spark, sf_dir)))
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("a5_alert_sessions", """
    select url, min(ts) as start, max(ts) + interval 2 day as "end", count(*) as alerts, max(discount) as best_discount from (
      select *, sum(begins) over (partition by url order by ts, deal_id) as island from (
        select *, case when ts - lag(ts) over (partition by url order by ts, deal_id) < interval 2 day then 0 else 1 end as begins
        from judged where status = 'alert'))
    group by url, island""", "judged")
def alert_sessions(spark, sf_dir):
    sessions = dealing.alert_sessions(dealing.score_deals(views.deal(spark, sf_dir)), "2 days")
    return sessions.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("a6_stream_deals", "select deal_id, ts, title, price, estimate, discount, url, status from judged", "judged")
def stream(spark, sf_dir):
    source = stage_path(spark, "deals-arriving")
    views.deal(spark, sf_dir).repartition(4).write.parquet(source)
    scored = stage_path(spark, "deals-scored")
    stream_deals(read_deals(spark, source, 2), scored, stage_path(spark, "deals-checkpoint")).awaitTermination()
    return read_scored(spark, scored).select(
        "deal_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "title", "price", "estimate", "discount", "url", "status")


REPEAT_SECONDS = 3 * 86_400


@query("a6_stream_first_alert", f"""
    select deal_id, ts, price, url from (
      with recursive alerts as (select deal_id, ts, price, url from judged where status = 'alert'),
      sent as (
        select url, min(struct_pack(ts := ts, deal_id := deal_id)) as at from alerts group by url
        union all
        select a.url, min(struct_pack(ts := a.ts, deal_id := a.deal_id)) as at
        from sent s join alerts a on a.url = s.url and a.ts >= s.at.ts + interval {REPEAT_SECONDS} second group by a.url)
      select a.* from alerts a join sent s on a.url = s.url and a.deal_id = s.at.deal_id and a.ts = s.at.ts)""", "judged")
def stream_first_alert(spark, sf_dir):
    """Deals arrive in three runs of the stream, in the order of their times."""
    deals = views.deal(spark, sf_dir)
    source, scored, checkpoint = (stage_path(spark, name) for name in ("deals-in-order", "first-alerts", "first-checkpoint"))
    cuts = [r for (r,) in deals.select(F.explode(F.percentile_approx(F.unix_micros("ts"), [0.33, 0.67]))).collect()]
    moment = F.unix_micros("ts")
    parts = [moment <= cuts[0], (moment > cuts[0]) & (moment <= cuts[1]), moment > cuts[1]] if cuts else [F.lit(True)]
    for part in parts:
        deals.where(part).write.mode("append").parquet(source)
        stream_first_alerts(read_deals(spark, source), scored, checkpoint, REPEAT_SECONDS).awaitTermination()
    return spark.read.parquet(scored).select("deal_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "price", "url")


@query("a2_asof_estimate", """
    select l.deal_id, l.url, l.ts, r.estimate as estimate, r.deal_id as estimate_of
    from (select * from judged where deal_id % 2 = 1) l asof left join (select * from judged where deal_id % 2 = 1 and deal_id % 3 <> 0) r
    on l.url = r.url and l.ts >= r.ts""", "judged")
def asof_estimate(spark, sf_dir):
    """The last estimate of the same page, no later than the deal."""
    judged = dealing.score_deals(views.deal(spark, sf_dir)).where("deal_id % 2 = 1")
    estimates = judged.where("deal_id % 3 <> 0").select("url", "ts", "estimate", F.col("deal_id").alias("estimate_of"))
    deals = judged.select("deal_id", "url", "ts")
    return asof_join(deals, estimates, ["url"], "ts", ["estimate", "estimate_of"], tie="estimate_of").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("a7_price_interval", """
    select item_id, model_name, round(greatest(0.0, predicted - mae), 6) as low, round(predicted + mae, 6) as high
    from scored join results using (model_name)""", "scored results")
def interval(spark, sf_dir):
    scored = evaluation.score(views.model_output(spark, sf_dir))
    return evaluation.with_interval(scored, _results(spark, sf_dir)).select(
        "item_id", "model_name", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))

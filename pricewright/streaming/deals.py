"""Deals scored as they arrive."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..constants import ALERT_DISCOUNT
from ..operators.dealing import alert_sessions, alerts_per_window, score_deals
from ..schemas import DEAL
from ..session import ship_package


def read_deals(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Deals from files that keep arriving in a folder."""
    return spark.readStream.schema(DEAL).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_deals(
    deals: DataFrame, path: str, checkpoint: str, threshold: float = ALERT_DISCOUNT, available_now: bool = True
) -> StreamingQuery:
    """Score a stream of deals into ``path``, partitioned by batch and status.

    Scoring is per row, so the stream keeps no state. A replayed batch
    overwrites its own folder: each deal is stored exactly once.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("status").parquet(f"{path}/batch_id={batch_id}")

    writer = score_deals(deals, threshold).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_scored(spark: SparkSession, path: str, status: str | None = None) -> DataFrame:
    """Stored deals; with a status only that partition is read."""
    scored = spark.read.parquet(path).drop("batch_id")
    return scored if status is None else scored.where(F.col("status") == status)


def _first_of(seconds: int) -> Callable:
    """For one URL: the alerts no other one was sent for in the ``seconds`` before; the state is when the last was sent."""
    wait = pd.Timedelta(seconds=seconds)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["ts", "deal_id"])
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        sent = []
        for i, moment in enumerate(rows["ts"]):
            if last is None or moment >= last + wait:
                sent.append(i)
                last = moment
        state.update((last.value // 1000,))
        # Forgotten once the watermark has passed what it can suppress.
        until = (last + wait).value // 1_000_000
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        if sent:
            yield rows.iloc[sent]

    return run


def first_alerts(deals: DataFrame, repeat_seconds: int, late: str = "1 hour", threshold: float = ALERT_DISCOUNT) -> DataFrame:
    """Of a stream of deals the alerts, but none for a URL within ``repeat_seconds`` after the last that was sent for it.

    Deals up to ``late`` behind the newest one seen are taken; such a late deal is held against the alerts already sent, and later ones are dropped. Only alerts are
    shuffled, by URL; the state holds one time for each URL of late. Within a batch deals count in the order of their times.
    """
    ship_package(deals.sparkSession)
    alerts = score_deals(deals, threshold).where("status = 'alert' and url is not null and ts is not null").withWatermark("ts", late)
    alerts = alerts.select("deal_id", "ts", "title", "price", "estimate", "discount", "url")
    return alerts.groupBy("url").applyInPandasWithState(
        _first_of(repeat_seconds), alerts.schema, "last long", "append", GroupStateTimeout.EventTimeTimeout)


def stream_first_alerts(
    deals: DataFrame, path: str, checkpoint: str, repeat_seconds: int, late: str = "1 hour", available_now: bool = True
) -> StreamingQuery:
    """Store ``first_alerts`` of a stream under ``path``; a replayed batch overwrites its own folder."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = first_alerts(deals, repeat_seconds, late).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_alert_counts(
    deals: DataFrame, path: str, checkpoint: str, window: str | None = "1 hour", gap: str = "1 day", late: str = "1 hour", available_now: bool = True
) -> StreamingQuery:
    """Store ``alerts_per_window`` of a stream under ``path``, or with ``window`` None its ``alert_sessions``.

    A window is stored once, when the newest deal (a session: the newest alert) is ``late`` past its end; deals later than that are dropped.
    """
    scored = score_deals(deals).withWatermark("ts", late)
    counts = alert_sessions(scored, gap) if window is None else alerts_per_window(scored, window)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

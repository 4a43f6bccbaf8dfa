"""Streaming versions: cost rollup in event time, and dedup against the last kept texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.controls import BAND, NEAR
from millrace.operators.traces import dollars
from millrace.shipping import ship


def cost_rollup(events: DataFrame, ts: str = "ts", window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Dollars of a stream (or table) of usage events by window of event time; later ones than `late` are dropped."""
    got = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, window)).agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("searches").alias("searches"))
    usd = dollars(F.col("input_tokens"), F.col("output_tokens"), F.col("searches"))
    return got.select(F.col("window.start").alias("start"), "input_tokens", "output_tokens", "searches", usd.alias("usd"))


class _Recent(StatefulProcessor):
    """Keeps the word sets of the last texts kept for a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._recent = handle.getValueState("recent", "words array<array<string>>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        recent = [set(w) for w in self._recent.get()[0]] if self._recent.exists() else []
        for batch in rows:
            kept = []
            for at, text in enumerate(batch["text"].fillna("")):
                own = set(text.lower().split())
                if own and any(len(own & other) / len(own | other) >= NEAR for other in recent):
                    continue
                kept.append(at)
                if own:
                    recent = [*recent[1 - BAND :], own]
            yield batch.iloc[kept]
        self._recent.update(([sorted(w) for w in recent],))

    def close(self) -> None:
        pass


def surface_dedup(rows: DataFrame, key: str) -> DataFrame:
    """Texts of a stream that are no near copy of their key's last kept ones, in arrival order (needs the RocksDB state store)."""
    ship(rows.sparkSession)
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=_Recent(), outputStructType=rows.schema, outputMode="Append", timeMode="None")

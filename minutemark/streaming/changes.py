"""Change detection and on-screen time over streams of frame reads."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def changes_stream(reads: DataFrame) -> DataFrame:
    """meeting, ord, t_us, name of the reads whose name differs from the one before, over batches.

    The state of a meeting is its last name. Reads of a meeting must come in the
    order of their batches; within one they are sorted here.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["t_us", "ord"])
        before = state.get[0] if state.exists else None
        last = rows["name"].shift(1)
        last.iloc[0] = before
        changed = rows["name"].ne(last)
        if not state.exists:
            changed.iloc[0] = True
        state.update((rows["name"].iloc[-1],))
        yield rows.loc[changed, ["meeting", "ord", "t_us", "name"]]

    return reads.select("meeting", "ord", "t_us", "name").groupBy("meeting").applyInPandasWithState(
        step, "meeting long, ord long, t_us long, name string", "last string", "append", GroupStateTimeout.NoTimeout
    )


def named_per_window(reads: DataFrame, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Reads and named reads of each meeting in windows of event time (column ts), late rows allowed for."""
    return (
        reads.withWatermark("ts", late)
        .groupBy(F.window("ts", window).alias("w"), "meeting")
        .agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("name") != "No Speaker").alias("named"))
        .select("meeting", F.col("w.start").alias("start"), "frames", "named")
    )


def run_available(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, into files under ``path``, and read the result."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/rows")
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")

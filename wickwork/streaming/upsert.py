"""Candles that arrive as a stream: upserts by micro-batch. (An addition: batch saves take the same path.)"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wickwork.sources.store import save


def write_stream(stream: DataFrame, data_dir: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Late and repeated candles win over stored ones, so a batch that runs again changes nothing."""
    return (
        stream.writeStream.foreachBatch(lambda batch, _: save(batch, data_dir))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

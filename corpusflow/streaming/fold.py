"""R2: last write per key wins over a log of state updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery


def state_fold(log: DataFrame, keys: list[str], value: str, order: list[str], out: str | None = None) -> DataFrame:
    """Batch fold: per key the value of the latest update by ``order`` (a total order,
    e.g. (ts, event_id)). ``max_by`` is a partial aggregate, so a hot key is combined
    map-side before the shuffle."""
    return log.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*[F.col(o) for o in order])).alias(out or value))


def start_streaming_fold(
    stream: DataFrame, keys: list[str], value: str, order: list[str], sink_format: str, checkpoint: str, **options
) -> StreamingQuery:
    """Streaming fold: the same aggregate in update mode; state holds one row per key.
    ``sink_format`` may be any sink that accepts update mode (``memory`` in tests)."""
    agg = state_fold(stream, keys, value, order)
    w = agg.writeStream.outputMode("update").format(sink_format).option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    if sink_format == "memory":
        w = w.queryName(options.get("queryName", "state_fold"))
    return w.start()


# --- the fold as a stateful operator -----------------------------------------------------------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _LastWrite(StatefulProcessor):
    """Per key the latest update by order, in a value state; a batch's updates in any order."""

    def __init__(self, keys: list[str], value: str, order: list[str], state: T.StructType, ttl_ms: int | None):
        self.names, self.value, self.order, self.state, self.ttl_ms = [*keys, *order, value], value, order, state, ttl_ms

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.state, self.ttl_ms)

    def handleInputRows(self, key, rows, timers):
        columns = [*self.order, self.value]
        best = max((tuple(r[c] for c in columns) for r in rows), key=_rank, default=None)
        held = self.last.get()  # None: no such state
        if best is not None and (held is None or _rank(best) > _rank(held)):
            self.last.update(best)
            yield Row(**dict(zip(self.names, (*key, *best))))

    def close(self) -> None:
        pass


def _rank(update: tuple) -> list[tuple]:
    """An update's place in the order (all but its last field), nulls first as in ``max_by``."""
    return [(x is not None, x) for x in tuple(update)[:-1]]


def keyed_fold(stream: DataFrame, keys: list[str], value: str, order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """R2 on a stream: a row (keys, order, value) whenever a key's last write changes, by ``transformWithState``. State
    holds one row a key, whatever the order in which updates come; with ``ttl_ms`` a key that
    hasn't changed for so long is forgotten. ``order`` columns aren't null."""
    fields = {f.name: f for f in stream.schema.fields}
    state = T.StructType([fields[c] for c in (*order, value)])
    out = T.StructType([fields[c] for c in (*keys, *order, value)])
    processor = _LastWrite(keys, value, order, state, ttl_ms)
    return stream.select(*out.names).groupBy(*keys).transformWithState(processor, out, "Append", "ProcessingTime" if ttl_ms else "None")


def drain_keyed_fold(stream: DataFrame, keys: list[str], value: str, order: list[str], log_dir: str, checkpoint: str) -> None:
    """Append the changes of all that is there now to a Parquet log, exactly once. The operator needs the
    RocksDB state store; the session's own setting is put back. Without a time to live: with one the operator asks
    for batches for ever, so such a stream is started with a processing-time trigger, not drained."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        changes = keyed_fold(stream, keys, value, order)
        q = changes.writeStream.format("parquet").option("path", log_dir).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)

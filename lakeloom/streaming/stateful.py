"""Per-partition offset tracking with keyed state and timers.

``offset_gaps`` keeps the last record of every (topic, partition) across
batches, reports the offsets that are missing between records, and closes a
partition that has been silent for some event time: its last record is emitted
and its state dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEYED = ("kind string, topic_key string, partition_key string, from_offset bigint, to_offset bigint, "
          "n_missing bigint, data string")


def _processor(idle_ms: int, ttl_ms: int | None):
    # Defined here so that it travels with the plan; workers need no copy of this package.
    from pyspark.sql.streaming import StatefulProcessor

    class Gaps(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.last = handle.getValueState("last", "offset bigint, at_ms bigint, data string", ttl_ms)
            self.totals = handle.getMapState("totals", "name string", "n bigint", ttl_ms)

        def _add(self, name, n):
            key = (name,)
            held = self.totals.getValue(key)[0] if self.totals.containsKey(key) else 0
            self.totals.updateValue(key, (held + n,))
            return held + n

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            # Batches of a key come unsorted; only offsets and times are held, and one payload.
            offsets, newest, top = [], None, -1
            at = 0
            for part in rows:
                offsets.append(part["offset"].to_numpy())
                i = int(part["offset"].to_numpy().argmax())
                at = max(at, int(part["at_ms"].max()))
                if newest is None or offsets[-1][i] > top:
                    top, newest = int(offsets[-1][i]), part["data"].iloc[i]
            seen = np.unique(np.concatenate(offsets))
            old = self.last.get() if self.last.exists() else None
            if old is not None:  # replayed records say nothing new
                seen = seen[seen > old[0]]
                at = max(at, old[1])
            if len(seen):
                before = np.concatenate(([old[0] if old is not None else seen[0] - 1], seen[:-1]))
                missing = seen - before - 1
                gap = missing > 0
                self.last.update((int(seen[-1]), at, newest))
                self._add("missing", int(missing[gap].sum()))
                if gap.any():
                    yield pd.DataFrame({
                        "kind": "gap", "topic_key": key[0], "partition_key": key[1], "from_offset": before[gap],
                        "to_offset": seen[gap], "n_missing": missing[gap], "data": None})
            if idle_ms >= 0:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(at + idle_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import pandas as pd

            if self.last.exists():
                offset, _, data = self.last.get()
                yield pd.DataFrame({"kind": ["idle"], "topic_key": [key[0]], "partition_key": [key[1]], "from_offset": [offset],
                                    "to_offset": [offset], "n_missing": [self._add("missing", 0)], "data": [data]})
                self.last.clear()
                self.totals.clear()

        def close(self):
            pass

    return Gaps()


def _front():
    # Defined here so that it travels with the plan; workers need no copy of this package.
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            n = batch.num_rows
            topic, partition = (batch.column(i).dictionary_encode() for i in (0, 1))
            code = topic.indices.to_numpy().astype(np.int64) * len(partition.dictionary) + partition.indices.to_numpy()
            offset = batch.column(2).to_numpy()
            at = np.unique(batch.column(3).cast(pa.int64()).to_numpy(), return_inverse=True)[1]
            order = np.lexsort((-offset, code))
            code, offset = code[order], offset[order]
            own = np.cumsum(np.append(0, code[1:] != code[:-1])) * n + at[order]
            # The newest time of the greater offsets: what precedes the records of this offset.
            first = np.append(True, (code[1:] != code[:-1]) | (offset[1:] != offset[:-1]))
            start = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
            newest = np.append(-1, np.maximum.accumulate(own))[start]
            needed = np.empty(n, bool)
            needed[order] = newest < own
            yield batch.set_column(5, "data", pc.if_else(pa.array(needed), batch.column(5), pa.scalar(None, batch.column(5).type)))

    return run


def offset_gaps(records: DataFrame, ts: str = "timestamp", delay: str = "10 minutes",
                idle_ms: int = 3_600_000, ttl_ms: int | None = None) -> DataFrame:
    """Gap and idle rows of a stream of (topic, partition, offset, ``ts``, data).

    kind ``gap``: ``n_missing`` offsets lie between two records that follow
    each other, in one batch or over two. kind ``idle``: the watermark is
    ``idle_ms`` past the partition's newest record, which is given with the
    count of all offsets missing before it; the state is gone then. Offsets at
    or below the last one are replays and are left out. Records without a
    partition form a partition of their own; records without an offset or a
    time cannot be placed and are left out.

    With ``ttl_ms`` state runs out by processing time instead and no idle rows
    come. Needs the RocksDB state store (``recovery.ROCKSDB``). A task holds
    the offsets (8 bytes each) of one partition's records of one batch.
    """
    own = records.where(F.col("offset").isNotNull() & F.col(ts).isNotNull())
    # Keys of state functions are never null: a letter stands before what there is.
    keys = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(f"{c}_key") for c in ("topic", "partition")]
    own = own.select(*keys, F.col("offset").cast("bigint"), F.col(ts).alias("at"), F.unix_millis(ts).alias("at_ms"), "data")
    # Only the last record's payload is shown. One that a greater offset of the same time or a
    # later one outdoes is never last, whatever the watermark leaves out.
    own = own.mapInArrow(_front(), own.schema)
    if ttl_ms is None:
        own = own.withWatermark("at", delay)
    out = own.groupBy("topic_key", "partition_key").transformWithStateInPandas(
        _processor(idle_ms if ttl_ms is None else -1, ttl_ms), _KEYED, "Append",
        "EventTime" if ttl_ms is None else "ProcessingTime")
    back = [F.when(F.col(f"{c}_key") != "", F.substring(f"{c}_key", 2, 1 << 30)).cast(kind).alias(c)
            for c, kind in (("topic", "string"), ("partition", "int"))]
    return out.select("kind", *back, "from_offset", "to_offset", "n_missing", "data")

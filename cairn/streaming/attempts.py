"""ST5: what becomes of each cited address, as keyed state with event-time timers.

    new -> requested -> archived, or failed after so many requests; not_archived when nothing was requested

A request is looked at again only after ``recheck_days``. The state of an address is written to the state store, with that
of others in its bucket, and a timer for the first such day; when the watermark passes it, the address is announced as due, whether or not anything else happened.
Time is that of the rows, never the clock's, so a replay gives the same rows however the input is cut into runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The store that keeps timers; the session's own choice is put back once the query is started.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FINAL = ("archived", "failed", "unresolved_redirect")
SHAPE = "url string, at_us long, status string, attempts int"
_STATE = "url array<string>, status array<string>, attempts array<int>, requested_us array<bigint>, due array<boolean>, timer_ms bigint"
#: Addresses that share a key of the state store, about: a visit to the store costs as much as hundreds of them.
EACH = 250


class Attempts(StatefulProcessor):
    """A bucket of addresses a key; a row is a lookup: was there an answer, was a copy found, was a request accepted.

    The state of a bucket's addresses is read and written together, with one timer for the first of them that is due.
    """

    def __init__(self, recheck_days: int, max_attempts: int):
        self.recheck_us, self.max_attempts = recheck_days * 86_400_000_000, max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("attempt", _STATE)

    def _rows(self, rows: list[tuple[str | None, int, str, int]]) -> pd.DataFrame:
        text = lambda values: pd.Series(values, dtype=object)  # noqa: E731  the state server's serializer takes no Arrow-backed strings
        return pd.DataFrame({"url": text([r[0] for r in rows]), "at_us": pd.Series([r[1] for r in rows], dtype="int64"), "status": text([r[2] for r in rows]), "attempts": pd.Series([r[3] for r in rows], dtype="int32")})

    def _timer(self, requested: int) -> int:
        """The first millisecond at which a request of that time is due."""
        return -(-(requested + self.recheck_us) // 1000)

    def _read(self) -> tuple[dict[str | None, tuple[str, int, int, bool]], int | None]:
        """Status, attempts, time of the request and whether it was announced as due, by address; and the timer that runs."""
        *columns, timer = self.state.get() if self.state.exists() else ([], [], [], [], [], None)
        return {url: rest for url, *rest in zip(*columns, strict=True)}, timer

    def _write(self, known: dict[str | None, tuple[str, int, int, bool]], timer: int | None) -> None:
        first = min((self._timer(requested) for status, _, requested, due in known.values() if status == "requested" and not due), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        self.state.update((list(known), *(list(c) for c in zip(*known.values(), strict=True)), first))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, timer = self._read()
        lookups = pd.concat(list(rows)).sort_values(["at_us", "id"])
        out = []
        for url, now, redirect, answered, found, saved in zip(*(lookups[c].tolist() for c in ("url", "at_us", "redirect", "answered", "found", "saved")), strict=True):
            url = url if isinstance(url, str) else None
            status, attempts, requested, due = known.get(url, ("new", 0, 0, False))
            if status in FINAL:
                continue
            if redirect:
                status = "unresolved_redirect"
            elif status == "requested" and not due and now < requested + self.recheck_us:
                continue
            else:
                if status == "requested" and not due:
                    out.append((url, requested + self.recheck_us, "due", attempts))
                    due = True
                if not answered:
                    status = "not_archived" if status == "new" else status
                elif found:
                    status = "archived"
                elif attempts >= self.max_attempts:
                    status = "failed"
                elif saved:
                    status, attempts, requested, due = "requested", attempts + 1, now, False
                elif status != "requested":
                    status = "not_archived"
            known[url] = status, attempts, requested, due
            out.append((url, now, status, attempts))
        self._write(known, timer)
        yield self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, _ = self._read()
        passed, out = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()), []
        for url, (status, attempts, requested, due) in known.items():
            if status == "requested" and not due and self._timer(requested) <= passed:
                known[url] = status, attempts, requested, True
                out.append((url, requested + self.recheck_us, "due", attempts))
        # the expired timer is gone by itself
        self._write(known, None)
        yield self._rows(out)

    def close(self) -> None:
        pass


def buckets_for(addresses: int) -> int:
    return max(1, -(-addresses // EACH))


def attempt_log(lookups: DataFrame, *, recheck_days: int = 30, max_attempts: int = 3, late: str = "0 seconds", buckets: int = 256) -> DataFrame:
    """(url, at, status, attempts): every change of every address, from a stream of lookups(url, id, at, redirect, answered, found, saved).

    Of an address's rows those that come while its request isn't due yet change nothing, and nothing follows a final
    status. A lookup without an answer leaves the status; a new address becomes not_archived. Rows later than
    ``late`` behind the newest are dropped by the watermark; equal times go by ``id``.

    Addresses are dealt into ``buckets`` by their hash, and a bucket is one key of the state store. ``buckets_for`` an expected
    number of addresses keeps them small; a checkpoint goes on with the number it was begun with.
    """
    timed = lookups.withWatermark("at", late).withColumn("at_us", F.unix_micros("at"))  # a number, as pandas would see the session's time zone
    dealt = timed.withColumn("bucket", F.pmod(F.xxhash64("url"), F.lit(buckets)))
    changes = dealt.groupBy("bucket").transformWithStateInPandas(Attempts(recheck_days, max_attempts), SHAPE, "append", "eventTime")
    return changes.select("url", F.timestamp_micros("at_us").alias("at"), "status", "attempts")


def run_attempts(lookups: DataFrame, out: str, checkpoint: str, **rules):
    """Read what is there, append the changes to ``out`` and stop; another run goes on from the checkpoint."""
    spark = lookups.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        return attempt_log(lookups, **rules).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)

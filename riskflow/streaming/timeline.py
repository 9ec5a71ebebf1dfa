"""Per-user ordered processing on streams: IP-change detection, impossible travel and the wire rule.

``lag`` is not available on streams. Here chained ``transformWithState`` operators order the rows:

1. by (slot, time bucket), a slot being the users of one hash value: arriving rows wait in list state, in chunks, under
   an event-time timer. When the watermark passes them they are processed in (time, login_id) order, NULL ids first, and
   compared with their user's predecessor in the bucket. A user's first row in the bucket, whose predecessor lies in an
   earlier bucket, and the latest one go on as edges.
2. by slot, edges only: the last row of each user is carried in map state and compared with the next bucket's
   first row. Results of the first step pass through under spread keys, so a user with a third of all
   rows is a third of the edges at most, never of the rows.
3. for the wire rule, by (slot, span of a few hours): wires wait until the watermark passes them, when all changes
   before them have come out of step 2, and meet their user's changes of the hour before.

Calls and state accesses cost about a millisecond a key: their number is that of slots and buckets, not of users and
hours. No frame is larger than a slot's bucket; ``slots`` should grow with the rows of a bucket. A row goes out once
the watermark is more than a millisecond past it, everywhere alike; as event time it carries the watermark of that
moment, which is what the next operator may see. Timers also end the state: a bucket's when the watermark passes its
end, a span's when no wire can reach it. A user's last row is kept for good (like the batch form) or, with ``expire_after``, for that time; a login
further than that from the one before has no predecessor, however the rows were split into micro-batches.

Streams need the RocksDB state store; the functions here set it on the session.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskflow.constants import HIGH_VALUE_AMOUNT, RECENT_IP_CHANGE_MINUTES, TRAVEL_MILES_THRESHOLD, TRAVEL_MINUTES_THRESHOLD, WIRE_TYPE
from riskflow.functions.geo import miles_between

#: Width of a user's time bucket. It bounds what one call holds and the state, not the latency of results.
BUCKET = "7 days"
#: Hash values of users in steps 1 and 2: a call holds the rows of one in a bucket.
SLOTS = 1024
#: Step 3 keeps a call as small by fewer slots and shorter spans, in lookbacks.
WIRE_SLOTS, SPAN = 256, 6
#: Keys over which the results of step 1 are spread on their way through step 2, and rows of a state entry at most.
SPREAD, CHUNK = 64, 1000

_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: A login on its way through the operators, as JSON (with its user); state entries are lines of it.
_ROW = "us long, login_id string, ip string, lat double, lon double, city string"
#: What steps 1 and 2 give: a row and its predecessor. ``at`` is the event time.
_STEP = "user_id string, bucket long, kind int, at timestamp, row string, prev string"
_Step = Row(*(x.split()[0] for x in _STEP.split(", ")))
_RESULT, _FIRST, _LAST = 0, 1, 2
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)

#: (previous row, row) -> whether the pair is a result.
Pair = Callable[[dict, dict], bool]


def _changed(prev: dict, row: dict) -> bool:
    return prev.get("ip") is not None and row.get("ip") is not None and prev["ip"] != row["ip"]


def _any(prev: dict, row: dict) -> bool:
    return True


def _parsed(line: str) -> tuple[tuple, dict, str]:
    """(order, row, line): by (time, id), NULL ids first, as the batch window orders."""
    row = json.loads(line)
    return (row["us"], "login_id" in row, row.get("login_id", "")), row, line


def _due(us: int, watermark_ms: int) -> bool:
    return us // 1000 + 1 < watermark_ms


def _timer(handle: StatefulProcessorHandle, us: int, watermark_ms: int) -> None:
    """At the first watermark for which ``us`` is due, or the next one."""
    handle.registerTimer(max(us // 1000 + 1, watermark_ms + 1))


def _at(watermark_ms: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(milliseconds=watermark_ms)


def _near(prev: dict, row: dict, expire_us: int | None) -> bool:
    return expire_us is None or row["us"] - prev["us"] <= expire_us


class _Frames(StatefulProcessor):
    """A processor of rows, fed from and giving data frames: Spark converts these in one go, and sends on the ones that
    are full, where it would first gather all rows that a task's timers give."""

    def __init__(self, rows: StatefulProcessor, names: tuple[str, ...]):
        self.rows, self.names = rows, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows.init(handle)

    def _frames(self, found: Iterator[Row]) -> Iterator[pd.DataFrame]:
        while some := list(islice(found, CHUNK)):
            yield pd.DataFrame(some, columns=self.names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        plain = (r for f in rows for r in f.itertuples(index=False))
        return self._frames(iter(self.rows.handleInputRows(key, plain, timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._frames(iter(self.rows.handleExpiredTimer(key, timerValues, expiredTimerInfo)))

    def close(self) -> None:
        self.rows.close()


def _chunks(lines: list[str]) -> list[tuple[str]]:
    return [("\n".join(lines[i : i + CHUNK]),) for i in range(0, len(lines), CHUNK)]


class _Buckets(StatefulProcessor):
    """Step 1, keyed by slot and bucket."""

    def __init__(self, pair: Pair, expire_us: int | None, bucket_us: int):
        self.pair, self.expire_us, self.bucket_us = pair, expire_us, bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "lines string")
        #: JSON of (user, latest line) pairs.
        self.last = handle.getValueState("last", "lines string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        low = None
        while chunk := [(r.us, r.row) for r in islice(rows, CHUNK)]:
            self.pending.appendList(_chunks([line for _, line in chunk]))
            low = min(chunk)[0] if low is None else min(low, min(chunk)[0])
        _timer(self.handle, low, 0)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        bucket, now = key[1], timerValues.getCurrentWatermarkInMs()
        waiting = sorted((_parsed(x) for lines in self.pending.get() for x in lines[0].split("\n")), key=lambda r: r[0])
        ready = [r for r in waiting if _due(r[0][0], now)]
        end, last = (bucket + 1) * self.bucket_us, None
        if ready:
            left = waiting[len(ready) :]
            self.pending.clear()
            if left:
                self.pending.put(_chunks([x for _, _, x in left]))
            last = dict(json.loads(self.last.get()[0])) if self.last.exists() else {}
            prevs: dict[str, dict] = {}
            for _, row, line in ready:
                user = row.get("user")
                prev = prevs.get(user)
                if prev is None and user in last:
                    prev = json.loads(last[user])
                if prev is None:
                    yield _Step(user, bucket, _FIRST, _at(now), line, None)
                elif _near(prev, row, self.expire_us) and self.pair(prev, row):
                    yield _Step(user, bucket, _RESULT, _at(now), line, last[user])
                prevs[user], last[user] = row, line
            for user in prevs:
                yield _Step(user, bucket, _LAST, _at(now), last[user], None)
            waiting = left
        if not waiting and _due(end, now):
            self.last.clear()
            return
        if last is not None:
            self.last.update((json.dumps(list(last.items())),))
        _timer(self.handle, waiting[0][0][0] if waiting else end, now)

    def close(self) -> None:
        pass


class _Users(StatefulProcessor):
    """Step 2, keyed by a spread key (results, which pass) or a slot (edges, which meet their user's last row)."""

    def __init__(self, pair: Pair, expire_us: int | None):
        self.pair, self.expire_us = pair, expire_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getMapState("last", "user string", "line string")

    def _ends(self, lines: list[str], now: int) -> None:
        """A timer for the first of these rows to expire, at most one an interval; it sets the next one."""
        first = min(json.loads(x)["us"] for x in lines) + self.expire_us
        _timer(self.handle, -(-first // self.expire_us) * self.expire_us, now)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] != "":
            for r in rows:
                yield _Step(*(getattr(r, c) for c in _Step))
            return
        now, lasts = timerValues.getCurrentWatermarkInMs(), []
        for user, edges in groupby(sorted(rows, key=lambda r: (r.user_id, r.bucket, r.kind)), key=lambda r: r.user_id):
            last = self.last.getValue((user,)) if self.last.containsKey((user,)) else None
            last = None if last is None else last[0]
            prev = None if last is None else json.loads(last)
            for r in edges:
                row = json.loads(r.row)
                if r.kind == _LAST:
                    prev, last = row, r.row
                elif prev is not None and _near(prev, row, self.expire_us) and self.pair(prev, row):
                    yield _Step(user, r.bucket, _RESULT, _at(now), r.row, last)
            self.last.updateValue((user,), (last,))
            lasts.append(last)
        if self.expire_us is not None:
            self._ends(lasts, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, left = timerValues.getCurrentWatermarkInMs(), []
        for (user,), (line,) in list(self.last.iterator()):
            if _due(json.loads(line)["us"] + self.expire_us, now):
                self.last.removeKey((user,))
            else:
                left.append(line)
        if left:
            self._ends(left, now)
        return iter(())

    def close(self) -> None:
        pass


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(slots)).cast("int")


def _sequence(logins: DataFrame, pair: Pair, watermark: str, expire_us: int | None, bucket: str, slots: int) -> DataFrame:
    """Steps 1 and 2. Event time must be a zoned TIMESTAMP for watermarks (session time zone UTC)."""
    for name, value in _STATE_STORE.items():
        logins.sparkSession.conf.set(name, value)
    us = F.unix_micros("at")

    def number(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    # Like the batch twins, logins without a user or a time take part in no sequence.
    row = F.struct(us.alias("us"), F.col("user_id").alias("user"), "login_id", F.col("ip_address").alias("ip"), number("latitude").alias("lat"), number("longitude").alias("lon"), "city")
    rows = (
        logins.filter(F.col("user_id").isNotNull() & F.col("login_time").isNotNull())
        .withColumn("at", F.col("login_time").cast("timestamp"))
        .withWatermark("at", watermark)
        .select(_slot(slots).alias("slot"), F.floor(us / _us(bucket)).alias("bucket"), us.alias("us"), F.to_json(row).alias("row"), "at")
    )
    first = rows.groupBy("slot", "bucket").transformWithStateInPandas(_Frames(_Buckets(pair, expire_us, _us(bucket)), tuple(_Step)), _STEP, "append", "eventtime", eventTimeColumnName="at")
    edge = F.col("kind") != _RESULT
    spread = F.when(edge, F.lit("")).otherwise(F.pmod(F.xxhash64("user_id", "bucket"), F.lit(SPREAD)).cast("string"))
    keyed = first.withColumns({"part": spread, "own": F.when(edge, _slot(slots).cast("string")).otherwise(F.lit(""))})
    found = keyed.groupBy("part", "own").transformWithStateInPandas(_Frames(_Users(pair, expire_us), tuple(_Step)), _STEP, "append", "eventtime", eventTimeColumnName="at")
    row, prev = F.from_json("row", _ROW).alias("r"), F.from_json("prev", _ROW).alias("p")
    return found.select("user_id", "at", row, prev).select(
        "user_id", "at", "r.*", F.col("p.us").alias("prev_us"), F.col("p.lat").alias("prev_lat"), F.col("p.lon").alias("prev_lon")
    )


def ip_change_stream(logins: DataFrame, watermark: str = "10 minutes", expire_after: str | None = None, bucket: str = BUCKET, slots: int = SLOTS) -> DataFrame:
    """Streaming twin of ``operators.features.ip_changes`` (append mode)."""
    found = _sequence(logins, _changed, watermark, None if expire_after is None else _us(expire_after), bucket, slots)
    return found.select(
        "user_id", F.col("ip").alias("new_ip"), F.timestamp_micros("us").alias("ip_change_time"),
        F.col("lat").alias("ip_lat"), F.col("lon").alias("ip_lon"), "login_id",
    )


def travel_stream(
    logins: DataFrame,
    watermark: str = "10 minutes",
    miles: float = TRAVEL_MILES_THRESHOLD,
    minutes: float = TRAVEL_MINUTES_THRESHOLD,
    bucket: str = BUCKET,
    slots: int = SLOTS,
) -> DataFrame:
    """Streaming twin of ``operators.travel.impossible_travel`` (append mode)."""
    # Whole-second minutes: a real gap just under (window + 1 s) can still count.
    pairs = _sequence(logins, _any, watermark, int(minutes * 60_000_000) + 1_000_000, bucket, slots)
    gap = (F.floor(F.col("us") / 1_000_000) - F.floor(F.col("prev_us") / 1_000_000)) / 60.0
    pairs = pairs.withColumns({"gap": gap, "apart": miles_between("prev_lat", "prev_lon", "lat", "lon")})
    return pairs.filter((F.col("gap") <= F.lit(float(minutes))) & (F.col("apart") >= F.lit(float(miles)))).select(
        "user_id", F.timestamp_micros("us").alias("login_time"), F.timestamp_micros("prev_us").alias("prev_time"),
        F.round("gap", 2).alias("minutes_between_logins"), F.round("apart", 2).alias("miles_traveled"), F.col("ip").alias("ip_address"), "city",
    )


_WIRE = "user_id string, transaction_id string, amount double, wire_us long, new_ip string, change_us long"
_Wire = Row(*(x.split()[0] for x in _WIRE.split(", ")))


class _Spans(StatefulProcessor):
    """Step 3: the wires and changes of a slot's span (changes also in the spans that their window reaches), as lines
    of JSON arrays."""

    def __init__(self, lookback: int):
        self.lookback = lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.changes = handle.getListState("changes", "lines string")
        self.wires = handle.getListState("wires", "lines string")

    def _end(self, key) -> int:
        return (key[1] + 1) * SPAN * self.lookback * 1_000_000

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = self._end(key)
        while chunk := list(islice(rows, CHUNK)):
            if changes := [json.dumps((r.us, r.user_id, r.new_ip)) for r in chunk if r.transaction_id is None]:
                self.changes.appendList(_chunks(changes))
            if wires := [(r.us, r.user_id, r.transaction_id, r.amount) for r in chunk if r.transaction_id is not None]:
                self.wires.appendList(_chunks([json.dumps(w) for w in wires]))
                first = min(first, min(w[0] for w in wires))
        _timer(self.handle, first, 0)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        wires = sorted((json.loads(x) for lines in self.wires.get() for x in lines[0].split("\n")), key=lambda w: w[0])
        due = [w for w in wires if _due(w[0], now)]
        if due:
            left = wires[len(due) :]
            self.wires.clear()
            if left:
                self.wires.put(_chunks([json.dumps(w) for w in left]))
            found: dict[str, list] = {w[1]: [] for w in due}
            for lines in self.changes.get():
                for when, user, ip in map(json.loads, lines[0].split("\n")):
                    if user in found:
                        found[user].append((when, ip))
            for changes in found.values():
                changes.sort(key=lambda c: c[0])
            times = {user: [c[0] for c in changes] for user, changes in found.items()}
            for us, user, txn, amount in due:
                # Whole seconds, as in the batch form.
                low = (us // 1_000_000 - self.lookback) * 1_000_000
                for when, ip in found[user][bisect_left(times[user], low) : bisect_left(times[user], us + 1)]:
                    yield _Wire(user, txn, amount, us, ip, when)
            wires = left
        if wires:
            _timer(self.handle, wires[0][0], now)
        elif _due(self._end(key), now):
            self.changes.clear()
        else:
            _timer(self.handle, self._end(key), now)

    def close(self) -> None:
        pass


def wire_rule_stream(
    transactions: DataFrame,
    logins: DataFrame,
    watermark: str = "10 minutes",
    lookback_minutes: float = RECENT_IP_CHANGE_MINUTES,
    bucket: str = BUCKET,
    slots: int = SLOTS,
    wire_slots: int = WIRE_SLOTS,
) -> DataFrame:
    """High-value wires with an IP change of the same user in the preceding hour, from the two raw streams in one
    query: the changes that step 2 finds go straight on to the wires. Wires without a user or a time match nothing."""
    lookback = int(lookback_minutes * 60)

    def span(us: Column) -> Column:
        return F.floor(us / (SPAN * lookback * 1_000_000))

    null = F.lit(None)
    changes = _sequence(logins, _changed, watermark, None, bucket, slots).select(
        "user_id", F.explode(F.sequence(span(F.col("us")), span(F.col("us") + (lookback + 1) * 1_000_000))).alias("span"), "us", F.col("ip").alias("new_ip"),
        null.cast("string").alias("transaction_id"), null.cast("double").alias("amount"), "at",
    )
    us = F.unix_micros("at")
    wires = transactions.filter((F.col("transaction_type") == WIRE_TYPE) & (F.col("amount") >= HIGH_VALUE_AMOUNT))
    wires = wires.filter(F.col("user_id").isNotNull() & F.col("transaction_time").isNotNull() & F.col("transaction_id").isNotNull())
    wires = wires.withColumn("at", F.col("transaction_time").cast("timestamp")).withWatermark("at", watermark)
    wires = wires.select("user_id", span(us).alias("span"), us.alias("us"), null.cast("string").alias("new_ip"), "transaction_id", F.col("amount").cast("double").alias("amount"), "at")
    pairs = wires.union(changes).withColumn("slot", _slot(wire_slots)).groupBy("slot", "span").transformWithStateInPandas(_Frames(_Spans(lookback), tuple(_Wire)), _WIRE, "append", "eventtime")
    gap = F.floor(F.col("wire_us") / 1_000_000) - F.floor(F.col("change_us") / 1_000_000)
    return pairs.select(
        "transaction_id", "user_id", "amount", F.timestamp_micros("wire_us").alias("transaction_time"), "new_ip",
        F.timestamp_micros("change_us").alias("ip_change_time"), F.round(gap / 60.0, 2).alias("minutes_since_ip_change"),
    )


def _us(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(float(n) * mult[unit.rstrip("s")] * 1_000_000)


# Spark also starts a Python process beside the driver to read the state's layout; it does not see shipped
# packages. The processors therefore travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

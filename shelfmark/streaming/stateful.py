"""Keyed state of change feeds with ``transformWithState``: streaks, approvals, late rows, deltas of closed days.

Times travel as microseconds: the processors see every row, those behind the watermark too, and decide themselves what a
late row means. State lives in RocksDB under the checkpoint, and only what is touched is written: an entry per key, or, where
keys are many and small, per bucket of keys, as every call to the store is a message to the executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfmark import constants as C

#: Settings a query with keyed state is started with.
STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
ORDER = "at bigint, id bigint"
DAY_MICROS = 86_400_000_000
#: Buckets of keys that share an entry of the state; fixed by the first run of a checkpoint. An entry is read and written whole,
#: so a feed whose state or batches hold far more than 10**8 keys wants more.
BUCKETS = 4096


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _plain(ts: str) -> Column:
    """Event time as microseconds, free of the watermark: rows behind it are not filtered out before they are seen."""
    return F.unix_micros(ts)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _value(state) -> tuple | None:
    """The value, null without one: a single call to the store."""
    found = state.get()
    return None if found is None else tuple(found)


class Streak(StatefulProcessor):
    """Last hit of a key, and in a list the nulls after it, so that late hits and nulls take their place."""

    def __init__(self, key: str, forgets: bool):
        self.key, self.forgets = key, forgets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hit = handle.getValueState("hit", ORDER)
        self.count = handle.getValueState("count", "n bigint, last bigint, touched bigint")
        self.nulls = handle.getListState("nulls", ORDER)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        hit = before = _value(self.hit)
        fresh = []
        for r in rows:
            if r["hit_at"] is not None and (hit is None or (r["hit_at"], r["hit_id"]) > hit):
                hit = (r["hit_at"], r["hit_id"])
            fresh += zip(r["null_at"], r["null_id"])
        fresh = [x for x in fresh if hit is None or x > hit]
        n, last, touched = _value(self.count) or (0, None, None)
        if hit != before:
            self.hit.update(hit)
            if n:
                fresh += [x for x in map(tuple, self.nulls.get()) if x > hit]
                self.nulls.clear()
            n, last = 0, None
        if fresh:
            self.nulls.appendList(fresh)
        n, last = n + len(fresh), max([x for x, _ in fresh] + ([last] if last is not None else []), default=None)
        touched = max(x for x in (touched, last, hit and hit[0]) if x is not None)
        self.count.update((n, last, touched))
        if self.forgets:
            self.handle.registerTimer(touched // 1000 + 1)
        yield Row(**{self.key: key[0], "streak": n, "last_null": last})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        count = _value(self.count)
        if count and count[2] // 1000 + 1 <= timerValues.getCurrentWatermarkInMs():
            for state in (self.hit, self.count, self.nulls):
                state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _combined(key: str):
    """Of a batch's rows, per key: the last hit and the nulls after it. What lies before a hit never counts again."""
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.sort_values(["at", "id"]).reset_index(drop=True)
            groups = f[key].astype(object).where(f[key].notna(), None)
            out: dict = {}
            for k, at, i, null in zip(groups, f["at"], f["id"], f["null"]):
                own = out.setdefault(k, [None, None, [], []])
                if null:
                    own[2].append(at)
                    own[3].append(i)
                else:
                    own[:] = at, i, [], []
            yield pd.DataFrame([(k, *own) for k, own in out.items()], columns=[key, "hit_at", "hit_id", "null_at", "null_id"]).astype(
                {"hit_at": "Int64", "hit_id": "Int64"})
    return run


def null_streaks(stream: DataFrame, key: str, ts: str, row_id: str, is_null: Column,
                 keep_days: int | None = None) -> DataFrame:
    """(key, streak, last_null) of every key that a batch touches: its nulls after its last hit in (ts, row_id).

    However late a row arrives, the result is that of the batch form over all rows so far. Rows without a time or id are
    left out. Batches are reduced to one row per key and task before they are shuffled, so that a key with a third of
    the rows sends its last hit and the nulls after it. With ``keep_days`` a key is forgotten once the watermark, the greatest
    time less so many days, has passed its newest row.
    """
    k = _kind(stream, key)
    if keep_days:
        stream = stream.withWatermark(ts, f"{keep_days} days")
    rows = stream.where(F.col(ts).isNotNull() & F.col(row_id).isNotNull()).select(
        key, _plain(ts).alias("at"), F.col(row_id).cast("bigint").alias("id"), F.coalesce(is_null, F.lit(False)).alias("null"))
    partial = rows.mapInPandas(_combined(key), f"{key} {k}, hit_at bigint, hit_id bigint, null_at array<bigint>, null_id array<bigint>")
    out = partial.groupBy(key).transformWithState(
        Streak(key, bool(keep_days)), f"{key} {k}, streak bigint, last_null bigint", "Update", "EventTime" if keep_days else "None")
    return out.withColumn("last_null", F.timestamp_micros("last_null"))


class Approval(StatefulProcessor):
    """Per bucket the requests of its tokens and their undecided actions; a timer decides them in order once the watermark has passed."""

    def __init__(self, ttl_micros: int, keep_micros: int, kind: str):
        self.ttl, self.keep, self.kind = ttl_micros, keep_micros, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tokens = handle.getValueState(
            "tokens", f"timer bigint, token array<{self.kind}>, created array<bigint>, settled array<boolean>, "
                      f"owner array<{self.kind}>, at array<bigint>, seq array<bigint>, action array<string>")

    def _load(self) -> tuple[int | None, dict]:
        """The time of the bucket's timer, and token -> [request, whether it is settled, undecided actions]."""
        timer, token, created, settled, owner, *actions = _value(self.tokens) or (None, *[[]] * 7)
        known = {t: [at, done, []] for t, at, done in zip(token, created, settled)}
        for t, *action in zip(owner, *actions):
            known[t][2].append(tuple(action))
        return timer, known

    def _save(self, timer: int | None, known: dict) -> None:
        if not known:
            self.tokens.clear()
            return
        due = min(self._next(*own) for own in known.values())
        if due != timer:
            self.handle.registerTimer(due)
        waiting = [(t, *action) for t, own in known.items() for action in own[2]]
        self.tokens.update((due, list(known), [own[0] for own in known.values()], [own[1] for own in known.values()],
                            *([w[i] for w in waiting] for i in range(4))))

    @staticmethod
    def _due(micros: int) -> int:
        return micros // 1000 + 1

    def _next(self, created: int | None, settled: bool, waiting: list[tuple]) -> int:
        """When a token is to be looked at again: at its first undecided action, without one when it is forgotten."""
        return self._due(min(w[0] for w in waiting) if waiting else created + self.keep)

    def _outcome(self, own: list, at: int, action: str) -> str:
        created, settled, _ = own
        if created is None:
            return "unknown-token"
        if at < created or settled:
            return "no-pending"
        own[1] = True
        if action == "cancel":
            return "cancelled"
        return "expired" if at - created > self.ttl else "executed"

    def _decide(self, known: dict, token, watermark: int) -> Iterator[Row]:
        """Outcomes of the token's actions the watermark has passed; the others wait. A token with nothing left is forgotten."""
        own = known[token]
        for at, seq, action in sorted(w for w in own[2] if self._due(w[0]) <= watermark):
            yield Row(token=token, action=action, at=at, seq=seq, outcome=self._outcome(own, at, action))
        own[2] = [w for w in own[2] if self._due(w[0]) > watermark]
        if not own[2] and (own[0] is None or self._due(own[0] + self.keep) <= watermark):
            del known[token]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        timer, known = self._load()
        touched = {}
        for r in rows:
            token = r["token"]
            if r["action"] is None and token is None:
                continue
            touched[token] = True
            own = known.setdefault(token, [None, False, []])
            if r["action"] is not None:
                own[2].append((r["at"], r["seq"], r["action"]))
            else:
                own[0] = r["at"] if own[0] is None else min(r["at"], own[0])
        for token in touched:
            yield from self._decide(known, token, timerValues.getCurrentWatermarkInMs())
        if touched:
            self._save(timer, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timer, known = self._load()
        watermark = timerValues.getCurrentWatermarkInMs()
        due = [t for t, own in known.items() if self._next(*own) <= watermark]
        for token in due:
            yield from self._decide(known, token, watermark)
        if due:
            self._save(timer, known)

    def close(self) -> None:
        pass


def approval_outcomes(stream: DataFrame, delay: str, ttl_days: int = C.APPROVAL_TTL_DAYS, keep_days: int = 366,
                      buckets: int = BUCKETS) -> DataFrame:
    """(token, action, at, seq, outcome) of every action, once the watermark has passed it.

    ``stream`` holds requests (token, ts) and actions (token, ts, action, seq); a row without an action is a request, one
    without a token as well moves the watermark alone. The first action at or after its token's request settles it:
    executed, cancelled, or expired when it confirms more than ``ttl_days`` later; further and earlier ones find no pending
    request, or an unknown token where none came within ``delay``. Actions are held back until no earlier row is expected
    and decided in (ts, seq) order, so batches may arrive in any order within ``delay``. A token is forgotten ``keep_days``
    after its request. Tokens share the state of their bucket.
    """
    kind = _kind(stream, "token")
    rows = stream.withWatermark("ts", delay).select(
        _bucket("token", buckets), "token", _plain("ts").alias("at"), "action", F.col("seq").cast("bigint").alias("seq"))
    out = rows.groupBy("bucket").transformWithState(
        Approval(ttl_days * DAY_MICROS, keep_days * DAY_MICROS, kind),
        f"token {kind}, action string, at bigint, seq bigint, outcome string", "Update", "EventTime")
    return out.withColumn("at", F.timestamp_micros("at"))


class Lateness(StatefulProcessor):
    """Whether a row is behind the watermark, repeats its key, or is kept; a key is remembered until the watermark passes it."""

    def __init__(self, key: str, kind: str):
        self.key, self.kind = key, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", f"timer bigint, keys array<{self.kind}>, at array<bigint>")

    def _load(self) -> tuple[int | None, dict]:
        """The time of the bucket's timer, and key -> time of the row that was kept."""
        timer, keys, at = _value(self.seen) or (None, [], [])
        return timer, dict(zip(keys, at))

    def _save(self, timer: int | None, seen: dict) -> None:
        if not seen:
            self.seen.clear()
            return
        due = min(seen.values()) // 1000 + 1
        if due != timer:
            self.handle.registerTimer(due)
        self.seen.update((due, list(seen), list(seen.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        behind = timerValues.getCurrentWatermarkInMs() * 1000
        timely = []
        for r in rows:
            k, at = r[self.key], r["at"]
            if at is not None and at < behind:
                yield Row(**{self.key: k, "at": at, "verdict": "late"})
            else:
                timely.append((k, at))
        if not timely:
            return
        timer, seen = self._load()
        before = len(seen)
        for k, at in sorted(timely, key=lambda row: (row[1] is None, row[1] or 0)):
            verdict = "duplicate" if k in seen else "kept"
            seen.setdefault(k, at if at is not None else behind)
            yield Row(**{self.key: k, "at": at, "verdict": verdict})
        if len(seen) > before:
            self._save(timer, seen)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timer, seen = self._load()
        watermark = timerValues.getCurrentWatermarkInMs()
        rest = {k: at for k, at in seen.items() if at // 1000 + 1 > watermark}
        if len(rest) < len(seen):
            self._save(timer, rest)
        return iter(())

    def close(self) -> None:
        pass


def late_or_duplicate(stream: DataFrame, key: str, ts: str, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, ts, verdict) of every row: late, duplicate or kept.

    Late is what lies behind the watermark, the greatest event time of earlier batches less ``delay``; of the others the
    first of a key is kept. A row without a time is never late. A key is forgotten when the watermark has passed it: what
    repeats it then is late as well. Keys share the state of their bucket.
    """
    kind = _kind(stream, key)
    rows = stream.withWatermark(ts, delay).select(_bucket(key, buckets), key, _plain(ts).alias("at"))
    out = rows.groupBy("bucket").transformWithState(
        Lateness(key, kind), f"{key} {kind}, at bigint, verdict string", "Update", "EventTime")
    return out.select(key, F.timestamp_micros("at").alias(ts), "verdict")


class DayDelta(StatefulProcessor):
    """The last closed day of a key and its value."""

    def __init__(self, dims: Sequence[str]):
        self.dims = list(dims)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "rows bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = _value(self.last)
        now = before
        for day, n in sorted((r["day"], r["rows"]) for r in rows):
            now = (n,)
            delta = n - (before[0] if before else n)
            before = now
            yield Row(day=day, **dict(zip(self.dims, key)), rows=n, rows_delta=delta)
        self.last.update(now)

    def close(self) -> None:
        pass


def closed_day_deltas(stream: DataFrame, ts: str, dims: Sequence[str], delay: str) -> DataFrame:
    """(day, dims, rows, rows_delta): each day's count once, when the watermark has passed its end, less that of the day before.

    The counts are a windowed aggregation in append mode, combined before the shuffle; its state is the open days. The
    delta's state is one number per ``dims``; the first day of a key has the delta 0.
    """
    day = F.window(F.col(ts), "1 day")
    counts = stream.withWatermark(ts, delay).groupBy(day, *dims).agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.select(F.datediff(F.to_date("window.start"), F.lit("1970-01-01").cast("date")).cast("bigint").alias("day"), *dims, "rows")
    kinds = ", ".join(f"{d} {_kind(stream, d)}" for d in dims)
    out = counts.groupBy(*dims).transformWithState(DayDelta(dims), f"day bigint, {kinds}, rows bigint, rows_delta bigint", "Append", "None")
    return out.withColumn("day", F.date_from_unix_date(F.col("day").cast("int")))


def newest(published: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows published per batch (``batch_id``), the last one of every key."""
    values = [c for c in published.columns if c not in keys and c != "batch_id"]
    out = published.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return out.select(*keys, *[F.col("_v")[c].alias(c) for c in values])

"""Streaming rows (T): each query streams the whole events table and returns what was published."""

from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.plans.joins import APPROVALS, folder_tree
from shelfmark.plans.registry import query, table
from shelfmark.plans.windows import DELTA_SQL, STREAK_SQL
from shelfmark.session import shared_path
from shelfmark.streaming import feeds as T
from shelfmark.streaming import stateful as S

c, lit = F.col, F.lit
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


#: Files of a batch where an arrival must be one batch.
ALL_FILES = 1 << 30


def events(s, sf):
    return table(s, sf, "events").withColumn("ts", c("ts").cast("timestamp"))


def cores(s):
    return s.sparkContext.defaultParallelism


def ntz(text):
    return lit(text).cast("timestamp")


@query("T1", "change_feed_consume", "select event_id, event_type from events where ts >= timestamp '2024-01-10'")
def _(s, sf):
    src, out, chk = shared_path(s, "feed"), shared_path(s, "out"), shared_path(s, "chk")
    e = events(s, sf)
    e.filter(c("ts") < ntz("2024-01-10")).write.parquet(src)
    T.consume_feed(T.file_feed(s, src, EVENTS), T.batch_writer(out), chk, first_run=True)
    e.filter(c("ts") >= ntz("2024-01-10")).write.mode("append").parquet(src)
    T.consume_feed(T.file_feed(s, src, EVENTS), T.batch_writer(out), chk, first_run=False)
    return s.read.schema(EVENTS).parquet(out).select("event_id", "event_type")


@query("T2", "stream_dedup", "select event_id, event_type from events")
def _(s, sf):
    src, out, chk = shared_path(s, "feed"), shared_path(s, "out"), shared_path(s, "chk")
    e = events(s, sf)
    e.write.parquet(src)
    e.filter(c("event_type") != "view").write.mode("append").parquet(src)
    T.drain(T.dedup(T.file_feed(s, src, EVENTS), "event_id", "ts", "31 days"), T.batch_writer(out), chk, state_partitions=cores(s))
    return s.read.schema(EVENTS).parquet(out).select("event_id", "event_type")


NONE_YET = "2024-01-10"     # the first arrival ends here, the second brings the whole table again


def two_arrivals(s, sf, src):
    """The rows before NONE_YET, and a function that adds the whole table."""
    e = events(s, sf)
    e.filter(c("ts") < ntz(NONE_YET)).write.parquet(src)
    return lambda: e.write.mode("append").parquet(src)


@query("T3", "stream_filter_chain", f"""with a as (select 1 as arrival, * from events where ts < timestamp '{NONE_YET}' union all select 2, * from events),
r as (select *, case when value < 2 then 'nofile' when event_type = 'error' then 'trashed' when event_type = 'signup' then 'folder' when (props->>'k')::int < 20 then 'nonvideo' end as early,
  case when ts < timestamp '2024-01-15' - interval 240 hour then 'old' when event_type = 'view' then 'no-output' end as late from a)
select event_id, case when early is not null then early when arrival = 2 and ts < timestamp '{NONE_YET}' and late is null then 'dup' else late end as reason from r""")
def _(s, sf):
    src, out, chk, led = (shared_path(s, x) for x in ("feed", "out", "chk", "ledger"))

    def reason(seen):
        return T.skip_reason(c("value") >= 2, c("event_type") == "error", c("event_type") == "signup",
                             F.get_json_object("props", "$.k").cast("int") >= 20, seen, c("ts"), ntz("2024-01-15"),
                             c("event_type") != "view", hours=240)
    handler = T.announce(T.Ledger(led, "event_id", "ts").create(s), reason, out)
    more = two_arrivals(s, sf, src)
    T.drain(T.file_feed(s, src, EVENTS, ALL_FILES), handler, chk)
    more()
    T.drain(T.file_feed(s, src, EVENTS, ALL_FILES), handler, chk)
    return s.read.schema("event_id bigint, reason string").parquet(out).drop("batch_id")


@query("T3", "change_feed_job", f"""with f as (select 'c' || c_custkey as folder_id, c_mktsegment as name, 'n' || c_nationkey as parent_id from customer
  union all select 'n' || n_nationkey, n_name, 'r' || n_regionkey from nation),
a as (select 1 as arrival, * from events where ts < timestamp '{NONE_YET}' union all select 2, * from events),
ch as (select arrival, event_id, ts, case when value >= 2 then event_id || case when (props->>'k')::int < 20 then '.txt' else '.MP4' end end as name, 'c' || user_id as parent,
  event_type = 'error' as trashed, event_type = 'signup' as is_folder from a),
j as (select ch.*, o.name is not null as inside, p.name as case_name, case when ch.name is null then 'nofile' when trashed then 'trashed' when is_folder then 'folder'
   when ch.name not like '%.MP4' then 'nonvideo' end as early, case when ts < timestamp '2024-01-15' - interval 240 hour then 'old' when o.name is null then 'no-output' end as late
  from ch left join f o on ch.parent = o.folder_id and o.name = 'MACHINERY' left join f p on o.parent_id = p.folder_id),
r as (select *, coalesce(early, case when arrival = 2 and ts < timestamp '{NONE_YET}' and late is null then 'dup' else late end) as reason from j)
select event_id, reason, case_name, case when reason is null then case when count(*) filter (where reason is null) over (partition by arrival, parent) = 1 then 'complete' else 'revised' end end as kind from r""")
def _(s, sf):
    src, out, chk, led = (shared_path(s, x) for x in ("feed", "out", "chk", "ledger"))
    number = F.col("event_id").cast("string")
    name = F.when(c("value") >= 2, F.concat(number, F.when(F.get_json_object("props", "$.k").cast("int") < 20, ".txt").otherwise(".MP4")))
    changes = "event_id bigint, ts timestamp, name string, parent string, trashed boolean, is_folder boolean"
    handler = T.change_feed(T.Ledger(led, "event_id", "ts").create(s), folder_tree(s, sf), "MACHINERY", ["mp4"], out, ntz("2024-01-15"), 240)
    e = events(s, sf).select("event_id", "ts", name.alias("name"), F.concat(F.lit("c"), c("user_id").cast("string")).alias("parent"),
                             (c("event_type") == "error").alias("trashed"), (c("event_type") == "signup").alias("is_folder"))
    for more in (e.filter(c("ts") < ntz(NONE_YET)), e):
        more.write.mode("append").parquet(src)
        T.drain(T.file_feed(s, src, changes, ALL_FILES), handler, chk)
    return s.read.schema("event_id bigint, reason string, case_name string, kind string").parquet(out).drop("batch_id")


@query("T4", "late_data_cutoff", "select event_id from events where event_type = 'signup' or ts >= timestamp '2024-01-20' - interval 6 hour")
def _(s, sf):
    src, out, chk = shared_path(s, "feed"), shared_path(s, "out"), shared_path(s, "chk")
    events(s, sf).withColumn("ts", F.when(c("event_type") != "signup", c("ts"))).write.parquet(src)
    T.drain(T.file_feed(s, src, EVENTS), T.late_cutoff("ts", out, asof=ntz("2024-01-20")), chk)
    return s.read.schema(EVENTS).parquet(out).select("event_id")


@query("T4", "late_data_watermark", f"""with w as (select epoch_ms(max(ts)) - 6 * 3600000 as mark from events where ts < timestamp '{NONE_YET}')
select event_id, 'kept' as verdict from events where ts < timestamp '{NONE_YET}' union all
select event_id, case when epoch_us(ts) < mark * 1000 then 'late' when ts < timestamp '{NONE_YET}' then 'duplicate' else 'kept' end from events, w""")
def _(s, sf):
    src, out, chk = shared_path(s, "feed"), shared_path(s, "out"), shared_path(s, "chk")
    more = two_arrivals(s, sf, src)
    for arrive in (lambda: None, more):
        arrive()
        verdicts = S.late_or_duplicate(T.file_feed(s, src, EVENTS, ALL_FILES), "event_id", "ts", f"{C.NEW_ITEM_HOURS} hours")
        T.drain(verdicts, T.batch_writer(out), chk, "update", cores(s), S.STORE)
    return s.read.schema("event_id bigint, verdict string").parquet(out).drop("batch_id")


@query("T5", "poll_until_drained", "select event_id, event_type from events")
def _(s, sf):
    src, out, chk, led = (shared_path(s, x) for x in ("feed", "out", "chk", "ledger"))
    e = events(s, sf)
    ledger = T.Ledger(led, "event_id", "ts").create(s)
    e.filter(c("event_type") != "view").write.parquet(src)
    T.drain(T.file_feed(s, src, EVENTS), T.deliver_once(ledger, out), chk)
    e.filter(c("event_type") != "click").write.mode("append").parquet(src)      # overlaps the first poll
    T.drain(T.file_feed(s, src, EVENTS), T.deliver_once(ledger, out), chk)
    return s.read.schema(EVENTS).parquet(out).select("event_id", "event_type")


@query("T6", "stateful_streak", f"{STREAK_SQL} select user_id, streak, last_null, streak >= 3 as permanent from s")
def _(s, sf):
    src, out, chk = (shared_path(s, x) for x in ("feed", "out", "chk"))
    e = events(s, sf)
    # the days after the 20th come first, so that half of the rows arrive late
    for lo, hi in (("2024-01-20", "2024-12-31"), ("2024-01-01", "2024-01-20")):
        e.filter((c("ts") >= ntz(lo)) & (c("ts") < ntz(hi))).write.mode("append").parquet(src)
        streaks = S.null_streaks(T.file_feed(s, src, EVENTS), "user_id", "ts", "event_id", c("event_type").isin("error", "view"))
        T.drain(streaks, T.batch_writer(out), chk, "update", cores(s), S.STORE)
    found = S.newest(s.read.schema("user_id bigint, streak bigint, last_null timestamp, batch_id bigint").parquet(out), ["user_id"])
    return found.withColumn("last_null", c("last_null").cast("timestamp_ntz")).withColumn("permanent", c("streak") >= C.NULL_STREAK_LIMIT)


@query("T7", "approval_pairs_stream", """select s.event_id as token, p.event_id as action_id from events s join events p on p.event_id = s.event_id + 1
where s.event_type = 'signup' and p.event_type = 'purchase'
  and p.ts + to_hours(((p.props->>'k')::int * 24) // 10) <= s.ts + interval 7 day""")
def _(s, sf):
    src, out, chk = (shared_path(s, x) for x in ("feed", "out", "chk"))
    events(s, sf).write.parquet(src)
    hours = F.floor(F.get_json_object("props", "$.k").cast("int") * 24 / 10)
    req = T.file_feed(s, src, EVENTS).filter(c("event_type") == "signup").select(c("event_id").alias("token"), c("ts").alias("created_at"))
    act = T.file_feed(s, src, EVENTS).filter(c("event_type") == "purchase").select(
        (c("event_id") - 1).alias("action_token"), c("event_id").alias("action_id"),
        F.timestamp_micros(F.unix_micros("ts") + hours * 3_600_000_000).alias("at"))
    T.drain(T.pending_approvals(req, act).select("token", "action_id"), T.batch_writer(out), chk, state_partitions=cores(s))
    return s.read.schema("token bigint, action_id bigint").parquet(out).drop("batch_id")


def tick(s, src):
    """A row without token or type that lies two months after all others: it moves the watermark past them."""
    end = s.read.schema(EVENTS).parquet(src).agg((F.max("ts") + F.expr("interval 62 days")).alias("ts"))
    none = F.lit(None)
    end.select(none.cast("bigint").alias("event_id"), "ts", none.cast("bigint").alias("user_id"), none.cast("string").alias("event_type"),
               none.cast("double").alias("value"), none.cast("string").alias("props")).write.mode("append").parquet(src)


@query("T7", "pending_approval_stream", f"with {APPROVALS} select token, action, seq, outcome from oc")
def _(s, sf):
    src, out, chk = (shared_path(s, x) for x in ("feed", "out", "chk"))
    e = events(s, sf)
    confirm, cancel = c("event_type") == "purchase", (c("event_type") == "error") & (c("value") > 60)
    request = (c("event_type") == "signup") & (c("value") > 80)

    def outcomes():
        rows = T.file_feed(s, src, EVENTS).filter(request | confirm | cancel | c("event_type").isNull())
        return S.approval_outcomes(rows.select(
            c("user_id").alias("token"), "ts", F.when(confirm, "confirm").when(cancel, "cancel").alias("action"),
            c("event_id").alias("seq")), "31 days").select("token", "action", "seq", "outcome")

    # the second half of the month arrives first
    for more in (e.filter(c("ts") >= ntz("2024-01-15")), e.filter(c("ts") < ntz("2024-01-15"))):
        more.write.mode("append").parquet(src)
        T.drain(outcomes(), T.batch_writer(out), chk, "update", cores(s), S.STORE)
    tick(s, src)
    T.drain(outcomes(), T.batch_writer(out), chk, "update", cores(s), S.STORE)
    return s.read.schema("token bigint, action string, seq bigint, outcome string").parquet(out).drop("batch_id")


@query("T8", "daily_snapshot_state", DELTA_SQL)
def _(s, sf):
    src, out, chk = (shared_path(s, x) for x in ("feed", "out", "chk"))
    e = events(s, sf)

    def deltas():
        return S.closed_day_deltas(T.file_feed(s, src, EVENTS), "ts", ["event_type"], "1 day")

    for more in (e.filter(c("ts") < ntz("2024-01-12")), e.filter(c("ts") >= ntz("2024-01-12"))):
        more.write.mode("append").parquet(src)
        T.drain(deltas(), T.batch_writer(out), chk, "append", cores(s), S.STORE)
    tick(s, src)
    T.drain(deltas(), T.batch_writer(out), chk, "append", cores(s), S.STORE)
    found = s.read.schema("day date, event_type string, rows bigint, rows_delta bigint").parquet(out).drop("batch_id")
    return found.filter("rows_delta <> 0")

"""Retweet-style counters in batch, over windows and as a stream.

An event stands for a sighting: the user is the message, the event type its
language, the whole part of the value its count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.catalog.registry import epoch, query, table
from skeinwork.operators.counters import retweet_delta, retweet_report as report_of
from skeinwork.operators.user_aggregate import aggregate_by_key
from skeinwork.session import materialize, scratch_path, setting
from skeinwork.sources.sinks import write_retweet_log
from skeinwork.sources.stream import read_stream, retweets_only as only_retweets
from skeinwork.sources.text_records import parse_retweet_log, read_retweet_log
from skeinwork.streaming import retweets as rt
from skeinwork.streaming.retweets import retweet_windows as windows_of
from skeinwork.streaming.retweets import start_retweet_stream, with_window_totals

SIZE, SLIDE, DELAY = 3600, 300, 600     # seconds: events are minutes apart


# users with this remainder write in a language that is not known
UNKNOWN = 7
LANG = f"case when user_id % 10 = {UNKNOWN} then null else event_type end"


def _sightings(events: DataFrame) -> DataFrame:
    return events.select(
        "ts",
        "event_id",
        F.col("user_id").alias("tweet_id"),
        F.floor("value").cast("bigint").alias("retweet_count"),
        F.when(F.col("user_id") % 10 != UNKNOWN, F.col("event_type")).alias("lang"),
        F.col("props").alias("text"),
    )


@query(f"""
with delta as (
  select user_id as tweet_id, max(floor(value))::bigint as max_count, min(floor(value))::bigint as min_count,
         case when user_id % 10 <> {UNKNOWN} then arg_max(event_type, event_id) end as code, arg_max(props, event_id) as text
  from events group by user_id),
counted as (select *, max_count - min_count + 1 as retweets from delta),
totals as (select *, sum(retweets) over (partition by code)::bigint as total_retweets from counted)
select code, total_retweets, tweet_id, max_count, min_count, retweets, text from totals where retweets > 1
""")
def retweet_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sightings(table(spark, sf_dir, "events")).withColumn("code", F.col("lang"))
    delta = retweet_delta(rows, "tweet_id", "retweet_count", "retweet_count", ["code", "text"], ["ts", "event_id"])
    return report_of(delta, "code").select(
        "code", "total_retweets", "tweet_id", "max_count", "min_count", "retweets", "text"
    )


@query("""
select event_id as seconds, upper(event_type) as language, event_type as code, user_id + 1 as total_retweets,
       user_id::varchar as tweet_id, floor(value)::bigint + 2 as max_count, floor(value)::bigint as min_count,
       3::bigint as retweets, 'one, two, ' || props as text
from events
""")
def retweet_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    whole = F.floor("value").cast("bigint")
    lines = e.select(
        F.concat_ws(
            ",",
            F.concat(F.lit("("), F.col("event_id").cast("string"), F.lit(")")),
            F.upper("event_type"),
            "event_type",
            (F.col("user_id") + 1).cast("string"),
            F.col("user_id").cast("string"),
            (whole + 2).cast("string"),
            whole.cast("string"),
            F.lit("3"),
            F.concat(F.lit("one, two, "), "props"),
        ).alias("value")
    )
    return parse_retweet_log(lines)


TOP = 10


def _take(state: dict, rows: pa.RecordBatch) -> dict:
    """Count, sum of the whole values, and the largest (value, id) pairs."""
    values, ids = rows.column("n").to_pylist(), rows.column("event_id").to_pylist()
    largest = heapq.nlargest(TOP, [*state["largest"], *zip(values, ids)])
    return {"rows": state["rows"] + len(ids), "total": state["total"] + sum(values), "largest": largest}


def _merge(a: dict, b: dict) -> dict:
    return {"rows": a["rows"] + b["rows"], "total": a["total"] + b["total"], "largest": heapq.nlargest(TOP, a["largest"] + b["largest"])}


def _result(state: dict) -> dict:
    return {"rows": state["rows"], "total": state["total"], "largest": " ".join(f"{n}:{i}" for n, i in state["largest"])}


@query(f"""
with e as (
  select case when user_id % 3 = 0 then null else event_type end as kind, case when user_id % 2 = 0 then 0 else user_id end as tweet_id,
         floor(value)::bigint as n, event_id from events),
ranked as (select *, row_number() over (partition by kind, tweet_id order by n desc, event_id desc) as r from e)
select kind, tweet_id, count(*) as rows, sum(n)::bigint as total,
       string_agg(n || ':' || event_id, ' ' order by r) filter (r <= {TOP}) as largest
from ranked group by kind, tweet_id
""")
def largest_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded list per key by the user's own zero, step and merge; half of the rows have one of three keys."""
    user = F.col("user_id")
    rows = table(spark, sf_dir, "events").select(
        F.when(user % 3 != 0, F.col("event_type")).alias("kind"), F.when(user % 2 == 0, F.lit(0)).otherwise(user).cast("bigint").alias("tweet_id"),
        F.floor("value").cast("bigint").alias("n"), "event_id",
    )
    zero = lambda: {"rows": 0, "total": 0, "largest": []}
    return aggregate_by_key(rows, ["kind", "tweet_id"], zero, _take, _merge, _result, "rows bigint, total bigint, largest string")


WINDOWS = f"""
with panes as (
  select event_id, user_id as tweet_id, floor(value)::bigint as n, {LANG} as lang, props as text,
         (epoch_us(ts) // {SLIDE * 1_000_000}) * {SLIDE} as pane
  from events),
placed as (
  select panes.*, pane - k * {SLIDE} as window_start from panes, generate_series(0, {SIZE // SLIDE - 1}) as s(k)),
counted as (
  select window_start, tweet_id, max(n) as max_count, min(n) as min_count, max(n) - min(n) + 1 as retweets,
         case when tweet_id % 10 <> {UNKNOWN} then arg_max(lang, event_id) end as lang, arg_max(text, event_id) as text
  from placed group by window_start, tweet_id),
totals as (
  select *, sum(retweets) over (partition by window_start, lang)::bigint as total_retweets from counted)
"""
COLUMNS = "window_start, lang, total_retweets, tweet_id, max_count, min_count, retweets, text"


@query(f"{WINDOWS} select {COLUMNS} from totals")
def retweet_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sightings(table(spark, sf_dir, "events"))
    counted = materialize(windows_of(rows, SIZE, SLIDE, order=["ts", "event_id"]), "windows")
    out = with_window_totals(counted)
    return out.withColumn("window_start", epoch("SECOND", F.col("window.start"))).select(*COLUMNS.split(", "))


CLOSED = f"""
{WINDOWS},
limits as (
  select (epoch_us(max(ts)) - {DELAY * 1_000_000}) // 1000000 as last, (epoch_us(min(ts)) // {SLIDE * 1_000_000}) * {SLIDE} as first from events),
closed as (select totals.*, first from totals, limits where window_start + {SIZE} <= last and window_start >= first)
"""


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream; the table may be a file or a folder of files.

    A file source takes a single file only by a pattern, so the path is written as one.
    """
    schema = table(spark, sf_dir, "events").schema.simpleString().removeprefix("struct<").removesuffix(">")
    stream = read_stream(spark, f"{sf_dir}/events.parque[t]", "parquet", schema.replace(":", " "))
    return _sightings(stream.withColumn("ts", F.col("ts").cast("timestamp")))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream")
    job = start_retweet_stream(
        _stream(spark, sf_dir), f"{out}/out", f"{out}/state", f"{DELAY} seconds", SIZE, SLIDE,
        available_now=True, order=["ts", "event_id"],
    )
    job.awaitTermination()
    return rt.read_report(spark, f"{out}/out")


@query(f"""
{CLOSED}
select {COLUMNS}, window_start + {SIZE} - first as seconds, lower(lang) as language from closed
""")
def retweet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows as a stream: those closed by the watermark, after the warm-up."""
    start = epoch("SECOND", F.col("window_start").cast("timestamp_ntz"))
    done = _report(spark, sf_dir).withColumns({"window_start": start, "lang": F.col("code")})
    return done.select(*COLUMNS.split(", "), "seconds", "language")


@query(f"""
{CLOSED}
select {COLUMNS}, window_start + {SIZE} - first as seconds, lower(lang) as language from closed
""")
def stopped_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a stream that runs on its trigger until it is stopped, and goes on from its checkpoint when more events are there."""
    path, out = scratch_path(spark, "events"), scratch_path(spark, "stopped")
    events = table(spark, sf_dir, "events")
    half = events.agg(F.percentile_approx(F.col("ts").cast("timestamp"), 0.5).alias("ts")).first()["ts"]
    early = F.col("ts").cast("timestamp") <= F.lit(half)
    for turn, part in enumerate((events.where(early), events.where(~early))):
        part.write.parquet(f"{path}/{turn}")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/*")
        job = start_retweet_stream(
            _sightings(stream.withColumn("ts", F.col("ts").cast("timestamp"))), f"{out}/out", f"{out}/state", f"{DELAY} seconds", SIZE, SLIDE,
            order=["ts", "event_id"],
        )
        job.processAllAvailable()
        job.stop()
        job.awaitTermination()
    start = epoch("SECOND", F.col("window_start").cast("timestamp_ntz"))
    done = rt.read_report(spark, f"{out}/out").withColumns({"window_start": start, "lang": F.col("code")})
    return done.select(*COLUMNS.split(", "), "seconds", "language")


@query(f"""
{CLOSED}
select window_start + {SIZE} - first as seconds, coalesce(lower(lang), '') as language, coalesce(lang, '') as code, total_retweets,
       tweet_id::varchar as tweet_id, max_count, min_count, retweets, text
from closed
""")
def retweet_log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the stream written as a log with a header line, and read back without it."""
    path = scratch_path(spark, "log")
    write_retweet_log(_report(spark, sf_dir), path)
    return read_retweet_log(spark, f"{path}/*")


@query("""
select event_id, user_id as retweeted_id, floor(value)::bigint as retweet_count
from events where value > 20 and user_id % 3 <> 0
""")
def retweets_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") > 20).alias("is_retweet"), F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("retweeted_id"),
        F.floor("value").cast("bigint").alias("retweet_count"),
    )
    return only_retweets(rows).drop("is_retweet")


SLICE_ROWS = 2_000_000      # events of about one slice of the joined stream; a bound on its state, not on results


def _slices(events: DataFrame) -> Iterator[DataFrame]:
    """The events cut by their time into slices of about `SLICE_ROWS` rows, earliest first."""
    n = -(-events.count() // SLICE_ROWS)
    if n < 2:
        yield events
        return
    cuts = sorted(set(events.agg(F.percentile_approx("ts", [k / n for k in range(1, n)]).alias("cuts")).first()["cuts"] or []))
    placed = events.withColumn("_slice", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col("ts"))))
    path = scratch_path(events.sparkSession, "slices")
    # a slice is written by several tasks
    placed.repartition("_slice", F.pmod(F.xxhash64("event_id"), F.lit(8))).write.partitionBy("_slice").parquet(path)
    staged = events.sparkSession.read.schema(placed.schema).parquet(path)
    for k in range(len(cuts) + 1):
        yield staged.where(F.col("_slice") == k).select(*events.columns)


@query(f"""
{WINDOWS}
select window_start, tweet_id, retweets, total_retweets from totals
where window_start + {SIZE} <= (select (epoch_us(max(ts)) - {DELAY * 1_000_000}) // 1000000 from events)
""")
def joined_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language totals as a second aggregation of the stream, joined back to the windows by a stream-stream join.

    The events come slice by slice in the order of their time, so the state holds
    what the open panes of one slice need and not the table. One query keeps panes
    and makes the windows, once, as a table of blocks of tweets; a second one reads
    that table as a stream for the totals and for the join, whose state has a row
    per block. The two take turns: each goes on from its checkpoint when the files
    of the other are complete, as rows of a slice that come after others of it
    would be late. The totals reach the join one batch after the windows they
    sum, a batch without new files. With the last slice comes one event more that
    is months later and only moves the watermark. NULL languages join, too.

    A partition of the state costs files per batch, however few rows it has, so
    there are no more of them than cores.
    """
    path, out = scratch_path(spark, "events"), scratch_path(spark, "joined")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    last = events.agg(F.max("ts").alias("ts")).first()["ts"]
    mark = events.limit(1).withColumn("ts", F.lit(last) + F.expr("interval 90 days"))
    partitions = "spark.sql.shuffle.partitions"
    fewest = min(int(spark.conf.get(partitions)), spark.sparkContext.defaultParallelism)
    stream = lambda: _sightings(spark.readStream.schema(events.schema).parquet(f"{path}/*"))
    parts = list(_slices(events))
    for turn, part in enumerate(parts):
        (part.unionByName(mark) if turn == len(parts) - 1 else part).write.parquet(f"{path}/{turn}")
        with setting(spark, partitions, fewest):
            made = rt.start_windows_stream(
                stream(), f"{out}/windows", f"{out}/windows_state", f"{DELAY} seconds", SIZE, SLIDE, order=["ts", "event_id"])
        made.awaitTermination()
        schema = spark.read.parquet(f"{out}/windows/*").schema
        closed = lambda: rt.closed_windows_stream(spark, f"{out}/windows/*", schema)
        joined = rt.joined_stream(closed(), rt.totals_stream(closed()))
        writer = joined.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{out}/state")
        with setting(spark, partitions, fewest):
            job = writer.trigger(availableNow=True).start(f"{out}/rows")
        job.awaitTermination()
    found = spark.read.schema(joined.schema).parquet(f"{out}/rows").withColumn("end", F.col("window") + F.expr(f"interval {SIZE} seconds"))
    found = found.where(F.col("end") <= F.lit(last) - F.expr(f"interval {DELAY} seconds"))
    start = epoch("SECOND", F.col("window").cast("timestamp_ntz"))
    return found.select(start.alias("window_start"), "total_retweets", F.inline("tweets")).select("window_start", "tweet_id", "retweets", "total_retweets")

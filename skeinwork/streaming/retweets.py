"""Retweet counts over sliding event-time windows, in batch and as a stream."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from skeinwork.functions.langname import with_language_name
from skeinwork.functions.text import clean_tweet, one_line, script_override
from skeinwork.operators.counters import delta_aggregates, with_delta, with_retweets
from skeinwork.operators.langid import detect_lang
from skeinwork.operators.skew import LEAST_ROWS, group_totals, join_totals, same_keys, with_group_totals
from skeinwork.session import path_exists, remove_path

# Window, slide and trigger of the job.
WINDOW, SLIDE, TRIGGER = 60, 5, 5       # seconds

# Bounds of a task of the report, in panes; they bound its memory, not results.
TASK_PANES, MOST_PANES = 150_000, 400_000
BLOCK_TWEETS = 4_000    # tweets of a window that travel to the stream-stream join as one row, about


def with_language(df: DataFrame, profiles: DataFrame, keys: list[str], text: str = "text", out: str = "lang") -> DataFrame:
    """Language code of each message: trigram detection on the cleaned text, then the script rule.

    A batch frame with unique `keys`; on a stream it runs inside the batch function.
    """
    cleaned = df.withColumn("_cleaned", clean_tweet(F.col(text)))
    found = detect_lang(cleaned, keys, "_cleaned", profiles).drop("score").withColumnsRenamed({k: f"_of_{k}" for k in keys})
    joined = cleaned.join(found, same_keys(keys, "_of_"), "left")
    return joined.withColumn(out, script_override(F.col("detected"), F.col("_cleaned"))).drop("_cleaned", "detected", *(f"_of_{k}" for k in keys))


def retweet_panes(
    df: DataFrame,
    size: int = WINDOW,
    slide: int = SLIDE,
    ts: str = "ts",
    id: str = "tweet_id",
    count: str = "retweet_count",
    carry: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Per pane and id: max, min and the carried columns of the last row, in batch and on a stream.

    A pane is the longest piece of time that no window cuts: every row lies in
    one pane, where it lies in size / slide windows.
    """
    carry, order = carry or ["lang", "text"], order or [ts]
    pane = F.window(ts, f"{math.gcd(size, slide)} seconds").alias("pane")
    grouped = df.groupBy(pane, F.col(id).alias("tweet_id"))
    return grouped.agg(*delta_aggregates(count, count, carry, order))


def _without_zone(panes: DataFrame, column: str) -> bool:
    return panes.schema[column].dataType["start"].dataType == TimestampNTZType()


def _since_epoch(panes: DataFrame, ts: str, column: str = "pane") -> Column:
    """Whole seconds since 1970 of a pane's time, with or without a time zone."""
    without_zone = _without_zone(panes, column)
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(ts)) if without_zone else F.unix_seconds(ts)


def _window_at(panes: DataFrame, seconds: Column, size: int, column: str = "pane") -> Column:
    """The window that starts so many seconds after 1970, as `F.window` makes it."""
    if _without_zone(panes, column):
        at = lambda s: F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.expr("interval '1' second") * s
    else:
        at = F.timestamp_seconds
    return F.struct(at(seconds).alias("start"), at(seconds + size).alias("end"))


def _window_numbers(seconds: Column, size: int, slide: int) -> tuple[Column, Column]:
    """First and last of the windows with this time; window n starts at n * slide."""
    return F.floor((seconds - size) / slide) + 1, F.floor(seconds / slide)


def in_slices(panes: DataFrame, size: int, slide: int, length: int) -> DataFrame:
    """Panes once per slice of `length` windows that holds one of their windows, with its number as `_slice`."""
    first, last = _window_numbers(_since_epoch(panes, "pane.start"), size, slide)
    return panes.withColumn("_slice", F.explode(F.sequence(F.floor(first / length), F.floor(last / length))))


def windows_of_panes(
    panes: DataFrame, size: int, slide: int, carry: list[str], last_by_time: bool, slice_length: int | None = None,
) -> DataFrame:
    """Per window and id: max, min, max - min + 1, and the carried columns of the last row (batch frames).

    A window belongs to the last of its panes with the id, so each (window, id)
    is made once, from the panes before that one which share a window with it;
    windows are not aggregated and only panes are shuffled. An id has at most
    one row per pane. `last_by_time` says that rows are ordered by their time
    first: then the last row of a window lies in its last pane.

    With `slice_length`, panes come from `in_slices` of that length. Each window
    is made in its own slice, and panes that lie by `_slice` are not shuffled.
    """
    if slide > size:
        raise ValueError(f"windows of {size} seconds every {slide} seconds leave gaps")
    part = ["tweet_id"] if slice_length is None else ["tweet_id", "_slice"]
    by_time = Window.partitionBy(*part).orderBy("_at")
    last = [F.col("_latest.carry")[c].alias(c) for c in carry] if last_by_time else ["_latest"]
    held = ["max_count", "min_count"] + ([] if last_by_time else ["_latest"])
    reach = by_time.rowsBetween(1 - size // math.gcd(size, slide), 0)
    from_no, to_no = _window_numbers(F.col("_at"), size, slide)
    if slice_length is not None:
        from_no = F.greatest(from_no, F.col("_slice") * slice_length)
        to_no = F.least(to_no, (F.col("_slice") + 1) * slice_length - 1)
    to_no = F.least(to_no, F.floor((F.col("_next") - size) / slide))     # without a next pane it does not count
    placed = (
        panes.select(_since_epoch(panes, "pane.start").alias("_at"), *part, "max_count", "min_count", *last)
        .withColumns({
            "_next": F.lead("_at").over(by_time), "_before": F.lag("_at").over(by_time),
            "_held": F.collect_list(F.struct(F.col("_at").alias("at"), *held)).over(reach),
        })
        .withColumn("_no", F.explode(F.when(from_no <= to_no, F.sequence(from_no, to_no))))
        .withColumn("_start", F.col("_no") * slide)
    )
    # most windows hold one pane of an id: their figures are those of the pane
    alone = F.col("_before").isNull() | (F.col("_before") < F.col("_start"))
    placed = placed.withColumn("_inside", F.when(~alone, F.filter("_held", lambda p: p["at"] >= F.col("_start"))))
    columns = {c: F.when(alone, F.col(c)).otherwise(of(F.col("_inside")[c])) for c, of in zip(held, (F.array_max, F.array_min, F.array_max))}
    kept = carry if last_by_time else ["_latest"]
    found = placed.select(
        _window_at(panes, F.col("_start"), size).alias("window"), *part, *(columns[c].alias(c) if c in columns else c for c in ["max_count", "min_count", *kept]))
    return with_retweets(found, carry) if last_by_time else with_delta(found, carry)


def retweet_windows(
    df: DataFrame,
    size: int = WINDOW,
    slide: int = SLIDE,
    ts: str = "ts",
    id: str = "tweet_id",
    count: str = "retweet_count",
    carry: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Per window and id: max, min, max - min + 1, and the carried columns of the last row.

    Sizes are in seconds. In batch the windows are made from panes. On a stream
    (set a watermark first) this is one aggregation over sliding windows, for
    operators that go on with the stream; `start_retweet_stream` keeps panes in
    the state instead.
    """
    carry, order = carry or ["lang", "text"], order or [ts]
    if df.isStreaming:
        window = F.window(ts, f"{size} seconds", f"{slide} seconds").alias("window")
        return with_delta(df.groupBy(window, F.col(id).alias("tweet_id")).agg(*delta_aggregates(count, count, carry, order)), carry)
    return windows_of_panes(retweet_panes(df, size, slide, ts, id, count, carry, order), size, slide, carry, order[0] == ts)


def with_window_totals(windows: DataFrame, lang: str = "lang") -> DataFrame:
    """Total of the language in the same window next to each tweet (batch frames)."""
    return with_group_totals(windows, ["window", lang], "retweets", "total_retweets", spread_by=["tweet_id"])


def totals_stream(windows: DataFrame, lang: str = "lang") -> DataFrame:
    """Language totals per window as a second aggregation of the stream (append mode)."""
    return windows.groupBy("window", lang).agg(F.sum("retweets").alias("total_retweets"))


def closed_windows_stream(spark, path: str, schema) -> DataFrame:
    """The table of windows that a stream writes below `path`, as a stream; `window` is the start of the window.

    Windows reach the table in the order in which they close, so no row comes
    after the watermark on their start.
    """
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withColumn("window", F.col("window.start")).withWatermark("window", "0 seconds")


def joined_stream(windows: DataFrame, totals: DataFrame, lang: str = "lang") -> DataFrame:
    """Tweets with their language total by a stream-stream join on (window, language), append mode.

    Build `totals` (see `totals_stream`) from a second `readStream` of the
    source: a self-join of one stream loses the watermark of its copied side.
    Totals reach the join one batch after the windows they sum.
    """
    right = totals.select(F.col("window").alias("_window"), F.col(lang).alias("_lang"), "total_retweets")
    same = (F.col("window") == F.col("_window")) & F.col(lang).eqNullSafe(F.col("_lang"))
    return windows.join(right, same).drop("_window", "_lang")


def _log_columns(rows: DataFrame, started: Column, lang: str, text: str) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", started, F.col("window.end"))
    return with_language_name(rows, lang, "language").select(
        seconds.alias("seconds"),
        "language",
        F.col(lang).alias("code"),
        "total_retweets",
        "tweet_id",
        "max_count",
        "min_count",
        "retweets",
        one_line(F.col(text)).alias("text"),
        F.col("window.start").alias("window_start"),
    )


def report_rows(windows: DataFrame, started: Column, lang: str = "lang", text: str = "text") -> DataFrame:
    """Log rows of complete windows: seconds since start, names, totals, one-line text.

    Windows that start before the first event are left out (warm-up).
    """
    return _log_columns(with_window_totals(windows.where(F.col("window.start") >= started), lang), started, lang, text)


def _first_event(panes: DataFrame, path: str) -> Column:
    """Start of the first pane with an event, remembered below `path` across restarts."""
    spark, saved = panes.sparkSession, f"{path}/started"
    if not path_exists(spark, f"{saved}/_SUCCESS"):
        panes.agg(F.min("pane.start").alias("started")).write.mode("overwrite").parquet(saved)
    return F.lit(spark.read.parquet(saved).first()["started"])


def batch_watermark(spark, checkpoint: str, batch_id: int) -> Column:
    """The watermark that a batch of the query runs with; the query notes it in its checkpoint before the batch."""
    noted = f"{checkpoint}/offsets/{batch_id}"
    millis = 0
    if path_exists(spark, noted):
        found = spark.read.text(noted).select(F.get_json_object("value", "$.batchWatermarkMs").alias("at")).where("at is not null").first()
        millis = int(found["at"]) if found else 0
    return F.timestamp_millis(F.lit(millis))


def slice_sizes(panes: DataFrame, size: int, slide: int) -> dict:
    """Panes in all, and of the largest slice of 8, 4, 2 and 1 times the windows that share a pane, by that number; empty without panes."""
    _, last = _window_numbers(_since_epoch(panes, "pane.start"), size, slide)
    sizes = panes.groupBy(F.floor(last / -(-size // slide)).alias("_size")).agg(F.count(F.lit(1)).alias("_n"))
    times = F.explode(F.array(*map(F.lit, (8, 4, 2, 1)))).alias("_times")
    largest = sizes.select("*", times).groupBy("_times", F.floor(F.col("_size") / F.col("_times"))).agg(F.sum("_n").alias("_n"))
    return {r["_times"]: r for r in largest.groupBy("_times").agg(F.max("_n").alias("most"), F.sum("_n").alias("total")).collect()}


def slice_windows(panes: DataFrame, size: int, slide: int, found: dict | None = None) -> tuple[int, int]:
    """Windows of a slice of the report, 0 when too many panes share one time, and the panes in all.

    A slice lies in one task. It gets 8, 4, 2 or 1 times the windows that share
    a pane (a pane is repeated for each slice it reaches: the longer, the less
    often), as long as the slices are small enough for all cores and for memory.
    """
    spark = panes.sparkSession
    found = slice_sizes(panes, size, slide) if found is None else found
    if not found:
        return 0, 0
    total = found[1]["total"]
    share = total // (2 * spark.sparkContext.defaultParallelism)
    for times, bound in ((8, TASK_PANES), (4, TASK_PANES), (2, TASK_PANES), (1, MOST_PANES)):
        if found[times]["most"] <= max(LEAST_ROWS, min(share, bound)):
            return times * -(-size // slide), total
    return 0, total


def slice_tasks(spark, n: int) -> int:
    """Tasks for so many panes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_PANES))


def ordered_slices(
    panes: DataFrame, size: int, slide: int, carry: list[str], last_by_time: bool, length: int, tasks: int,
    closed: Callable[[DataFrame], DataFrame], lang: str,
) -> DataFrame:
    """The `closed` windows with `total_retweets`, dealt out by time: only panes are shuffled, and partitions follow the time.

    A window with all its tweets lies in one partition, so the totals and the
    order of its rows are made there, without an exchange of windows.
    """
    dealt = in_slices(panes, size, slide, length).repartitionByRange(tasks, "_slice")
    rows = closed(windows_of_panes(dealt, size, slide, carry, last_by_time, length))
    # sorted for the totals; the order by the total then finds each language's rows in order
    rows = rows.withColumn("_start", _since_epoch(panes, "window.start")).drop("window")
    rows = rows.sortWithinPartitions("_start", lang, "_slice", F.desc("retweets"), "tweet_id")
    rows = rows.withColumn("total_retweets", F.sum("retweets").over(Window.partitionBy("_start", lang, "_slice")))
    return rows.withColumn("window", _window_at(panes, F.col("_start"), size)).drop("_slice", "_start")


def report_order() -> list[Column]:
    return [F.col("window_start"), F.desc("total_retweets"), F.desc("retweets"), F.col("tweet_id")]


def kept_panes(batch: DataFrame, batch_id: int, checkpoint: str, size: int) -> tuple[DataFrame, Column]:
    """The panes that a batch of closed panes can make windows from, and which windows it closes.

    Closed panes that open windows still need are kept below `checkpoint`, in a
    folder per batch that holds those of the batch before and the new ones. A
    repeated batch reads the same folder.
    """
    spark, folder = batch.sparkSession, f"{checkpoint}/panes/batch_id={{}}"
    own, before = folder.format(batch_id), folder.format(batch_id - 1)
    passed, now = (batch_watermark(spark, checkpoint, b) for b in (batch_id - 1, batch_id))
    panes = batch
    if path_exists(spark, f"{before}/_SUCCESS"):
        old = spark.read.schema(batch.schema).parquet(before)
        panes = old.where(F.col("pane.start") + F.expr(f"interval {size} seconds") > passed).unionByName(batch)
    panes.write.mode("overwrite").parquet(own)
    remove_path(spark, folder.format(batch_id - 2))
    return spark.read.schema(batch.schema).parquet(own), (F.col("window.end") > passed) & (F.col("window.end") <= now)


def report_sink(
    path: str, checkpoint: str, size: int = WINDOW, slide: int = SLIDE, lang: str = "lang", text: str = "text",
    profiles: DataFrame | None = None, carry: list[str] | None = None, last_by_time: bool = True,
):
    """foreachBatch function for a stream of closed panes: the report of the windows that this batch closes.

    A window is closed when the watermark has passed its end; all its panes have
    left the stream then (see `kept_panes`), so its totals are complete here. A
    repeated batch overwrites its own results. With `profiles`, the language is
    detected here, once per closed window and tweet. The rows are in descending
    order of the total.

    Panes are dealt out by time, so that windows are not shuffled; where one time
    has too many panes for a task, or a language is detected, windows are spread
    by tweet, written, and ordered by a range exchange.
    """
    carry = carry or [lang, text]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, totals = batch.sparkSession, None
        panes, closes = kept_panes(batch, batch_id, checkpoint, size)
        length, n = slice_windows(panes, size, slide)
        if n == 0:
            return
        started = _first_event(panes, path)
        closed = lambda windows: windows.where(closes & (F.col("window.start") >= started))
        report = f"{path}/windows/batch_id={batch_id}"
        if length and profiles is None:
            rows = ordered_slices(panes, size, slide, carry, last_by_time, length, slice_tasks(spark, n), closed, lang)
            _log_columns(rows, started, lang, text).sortWithinPartitions(*report_order()).write.mode("overwrite").parquet(report)
            return
        rows = closed(windows_of_panes(panes, size, slide, carry, last_by_time))
        if profiles is not None:
            rows = with_language(rows, profiles, ["window", "tweet_id"], text, lang)
        # read for the totals, for the ranges of the order, and for the report
        kept = f"{checkpoint}/closed/batch_id={batch_id}"
        try:
            rows.write.mode("overwrite").parquet(kept)
            rows = spark.read.schema(rows.schema).parquet(kept)
            totals = group_totals(rows, ["window", lang], "retweets", "total_retweets").persist()
            found = _log_columns(join_totals(rows, totals, ["window", lang], ["tweet_id"]), started, lang, text)
            found.orderBy(*report_order()).write.mode("overwrite").parquet(report)
        finally:
            if totals is not None:
                totals.unpersist()
            remove_path(spark, kept)

    return write


def tweet_blocks(windows: DataFrame, size: int, lang: str = "lang", blocks: int = 1, also: list[str] | None = None) -> DataFrame:
    """Tweets of a window of `size` seconds and language in about `blocks` rows: `tweets` has the tweets of a block, `retweets` their sum.

    For `totals_stream` and `joined_stream`, whose state then has a row per block
    and not per tweet; `F.inline("tweets")` has the tweets again. Blocks are cut
    by a hash of the tweet. Columns of `also` take part in the key and go.
    """
    start = _since_epoch(windows, "window.start", "window").alias("_start")     # a narrow key
    block = F.pmod(F.xxhash64("tweet_id"), F.lit(blocks)).alias("_block")
    tweets = F.collect_list(F.struct("tweet_id", "retweets")).alias("tweets")
    held = windows.groupBy(start, F.col(lang), *(also or []), block).agg(F.sum("retweets").alias("retweets"), tweets)
    return held.select(_window_at(windows, F.col("_start"), size, "window").alias("window"), lang, "retweets", "tweets")


def windows_sink(path: str, checkpoint: str, size: int, slide: int, carry: list[str], last_by_time: bool, lang: str):
    """foreachBatch function for a stream of closed panes: the windows that this batch closes, as `tweet_blocks`, in a folder of its own.

    A repeated batch overwrites its folder. Panes are dealt out by time where
    they can be, so that windows are not shuffled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, also = batch.sparkSession, []
        panes, closes = kept_panes(batch, batch_id, checkpoint, size)
        found = slice_sizes(panes, size, slide)
        length, n = slice_windows(panes, size, slide, found)
        if length:
            also = ["_slice"]
            # tasks end at the same time when there are several for a core
            tasks = max(slice_tasks(spark, n), 4 * spark.sparkContext.defaultParallelism)
            panes = in_slices(panes, size, slide, length).repartitionByRange(tasks, "_slice")
        rows = windows_of_panes(panes, size, slide, carry, last_by_time, length or None).where(closes)
        # the panes of a window lie in two of these slices at most
        blocks = -(-found[1]["most"] // BLOCK_TWEETS) if n else 1
        tweet_blocks(rows, size, lang, blocks, also).write.mode("overwrite").parquet(f"{path}/{batch_id}")

    return write


REPORT_SCHEMA = (
    "seconds bigint, language string, code string, total_retweets bigint, tweet_id {id}, max_count bigint, min_count bigint, "
    "retweets bigint, text string, window_start timestamp"
)


def read_report(spark, path: str, id_type: str = "bigint") -> DataFrame:
    """What the stream has reported so far; no rows before the first window has closed."""
    schema = REPORT_SCHEMA.format(id=id_type)
    if not path_exists(spark, f"{path}/windows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/windows").drop("batch_id")


def start_retweet_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = "10 seconds",
    size: int = WINDOW,
    slide: int = SLIDE,
    ts: str = "ts",
    available_now: bool = False,
    profiles: DataFrame | None = None,
    **columns,
) -> StreamingQuery:
    """Run the windowed counts to a table below `path`; restart with the same checkpoint.

    The state holds a row per id and open pane, and a row that comes after its
    pane has closed is late. Runs every `TRIGGER` seconds until it is stopped,
    or with `available_now` until all that is there has been read.
    `df` has a language column, or gets one from the trigram `profiles`.
    """
    carry = columns.pop("carry", None) or (["lang", "text"] if profiles is None else ["text"])
    order = columns.pop("order", None) or [ts]
    panes = retweet_panes(df.withWatermark(ts, watermark), size, slide, ts, carry=carry, order=order, **columns)
    lang, text = carry[:2] if profiles is None else ("lang", carry[0])
    sink = report_sink(path, checkpoint, size, slide, lang, text, profiles, carry, order[0] == ts)
    writer = panes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{TRIGGER} seconds")
    return writer.start()


def start_windows_stream(
    df: DataFrame, path: str, checkpoint: str, watermark: str = "10 seconds", size: int = WINDOW, slide: int = SLIDE, ts: str = "ts",
    lang: str = "lang", order: list[str] | None = None, **columns,
) -> StreamingQuery:
    """The closed windows of what is there, to a table of `tweet_blocks` below `path`; goes on from its checkpoint.

    As in `start_retweet_stream`, the state holds a row per id and open pane.
    The table is complete up to the watermark when the query has ended: read it
    (`closed_windows_stream` with `path/*`) between two runs, as the files of a
    batch do not appear at once.
    """
    order = order or [ts]
    panes = retweet_panes(df.withWatermark(ts, watermark), size, slide, ts, carry=[lang], order=order, **columns)
    sink = windows_sink(path, checkpoint, size, slide, [lang], order[0] == ts, lang)
    return panes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()

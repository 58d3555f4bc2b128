import datetime as dt
import json
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from skeinwork.operators.langid import build_profiles
from skeinwork.plans.retweets import log_report
from skeinwork.sources.sinks import write_retweet_log
from skeinwork.sources.stream import read_stream, retweets_only
from skeinwork.streaming import retweets as rt

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"ts": (T0 + dt.timedelta(seconds=s)).isoformat() + "Z", "is_retweet": re, "retweeted_id": i, "retweet_count": n, "text": t})
        for s, re, i, n, t in rows
    ]
    (folder / name).write_text("\n".join(lines))


FIRST = [
    (0, True, 1, 10, "a\r\nb"), (3, True, 1, 14, "later"), (7, True, 2, 3, "x"), (8, False, 9, 9, "no retweet"),
    (62, True, 1, 20, "again"), (64, True, 3, 5, "y"), (140, True, 2, 8, "z"),
]
SECOND = [(141, True, 3, 5, "w"), (10, True, 1, 999, "too late"), (300, True, 1, 30, "end")]


def tagged(df):
    lang = F.when(F.col("retweeted_id") == 3, F.lit("fr")).otherwise(F.lit("en"))
    return retweets_only(df).select("ts", F.col("retweeted_id").alias("tweet_id"), "retweet_count", "text", lang.alias("lang"))


def test_stream_equals_batch_over_restart(spark, tmp_path, rows):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for name, data in (("1.json", FIRST), ("2.json", SECOND)):
        put(src, name, data)
        job = rt.start_retweet_stream(tagged(read_stream(spark, str(src))), out, state, "10 seconds", available_now=True)
        job.awaitTermination()
    got = spark.read.parquet(f"{out}/windows").drop("batch_id")

    put(tmp_path / "batch", "1.json", FIRST + [r for r in SECOND if r[4] != "too late"])
    batch = tagged(spark.read.schema(read_stream(spark, str(src)).schema).json(str(tmp_path / "batch")))
    windows = rt.retweet_windows(batch)
    closed = windows.where(F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=290)).cast("timestamp"))
    started = batch.agg(F.min("ts").alias("t")).first()["t"]
    want = rt.report_rows(closed, F.lit(started))
    assert rows(got) == rows(want) and got.count() > 20
    assert got.where("text like '%\\n%' or text like '%\\r%'").count() == 0
    assert got.where("retweets = 999 or max_count = 999").count() == 0
    assert got.agg(F.min("seconds")).first()[0] == 60
    first = got.where("seconds = 60").orderBy("tweet_id").collect()
    write_retweet_log(got, str(tmp_path / "log"))
    report = log_report(spark, f"{tmp_path}/log/*")
    assert [(r["tweet_id"], r["retweets"], r["text"]) for r in report.where("code = 'en'").collect()] == [
        ("1", 11, "again"), ("2", 6, "z")
    ]
    assert [(r["tweet_id"], r["retweets"], r["total_retweets"], r["text"]) for r in first] == [(1, 5, 6, "later"), (2, 1, 6, "x")]


def test_batch_windows_match_direct_windows(spark, rows, tmp_path):
    put(tmp_path / "in", "1.json", FIRST)
    df = tagged(spark.read.schema(read_stream(spark, str(tmp_path / "in")).schema).json(str(tmp_path / "in")))
    direct = df.groupBy(F.window("ts", "60 seconds", "5 seconds").alias("window"), "tweet_id").agg(
        F.max("retweet_count").alias("max_count"), F.min("retweet_count").alias("min_count"), F.max_by("text", "ts").alias("text")
    )
    columns = ["window", "tweet_id", "max_count", "min_count", "text"]
    assert rows(rt.retweet_windows(df).select(*columns)) == rows(direct.select(*columns))
    odd = rt.retweet_windows(df, size=60, slide=7)
    assert odd.count() > 0


def test_stream_stream_join(spark, rows, tmp_path):
    """Chained aggregation and join need further batches for the watermark to reach them."""
    src = tmp_path / "in"
    for i, data in enumerate([FIRST, *([(300 + 100 * k, True, 1, 30, "end")] for k in range(4))]):
        put(src, f"{i}.json", data)
        os.utime(src / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    schema = read_stream(spark, str(src)).schema

    def windows():
        source = tagged(read_stream(spark, str(src), maxFilesPerTrigger="1"))
        return rt.retweet_windows(source.withWatermark("ts", "10 seconds"))

    job = (
        rt.joined_stream(windows(), rt.totals_stream(windows())).writeStream.format("memory").queryName("joined_windows").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    job.awaitTermination()
    columns = ["window", "tweet_id", "retweets", "total_retweets"]
    got = rows(spark.table("joined_windows").select(*columns))
    batch = rt.with_window_totals(rt.retweet_windows(tagged(spark.read.schema(schema).json(str(src))))).select(*columns)
    closed = batch.where(F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=290)).cast("timestamp"))
    assert set(rows(closed)) <= set(got) <= set(rows(batch)) and len(got) == len(set(got))


def test_language_on_a_stream(spark, tmp_path, rows):
    """Detected once per closed window and tweet; an unknown language is reported, too."""
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")], "text string, lang string")
    profiles = build_profiles(docs, "text", "lang")
    put(tmp_path / "in", "1.json", [
        (0, True, 1, 1, "RT @le_chat: the dog"), (1, True, 2, 1, "le chien http://the.dog/the"), (2, True, 3, 1, "12"), (500, True, 1, 1, "the")])
    stream = retweets_only(read_stream(spark, str(tmp_path / "in"))).select("ts", F.col("retweeted_id").alias("tweet_id"), "retweet_count", "text")
    out = str(tmp_path / "out")
    rt.start_retweet_stream(stream, out, str(tmp_path / "state"), available_now=True, profiles=profiles).awaitTermination()
    got = rt.read_report(spark, out).where("seconds = 60").select("tweet_id", "code", "language", "total_retweets")
    assert rows(got) == [(1, "en", "English", 1), (2, "fr", "French", 1), (3, None, None, 1)]


def test_stream_leaves_nothing_but_its_report(spark, tmp_path):
    from skeinwork.session import shared_dir

    def scratch():
        return sorted(str(p) for p in pathlib.Path(shared_dir(spark)).rglob("*") if p.is_dir())

    src, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    before = scratch()
    for i, data in enumerate((FIRST, SECOND)):
        put(src, f"{i}.json", data)
        rt.start_retweet_stream(tagged(read_stream(spark, str(src))), str(out), state, "10 seconds", available_now=True).awaitTermination()
    assert scratch() == before
    assert sorted(p.name for p in out.iterdir()) == ["started", "windows"]


def test_report_before_any_window_has_closed(spark, tmp_path):
    put(tmp_path / "in", "1.json", FIRST[:2])
    rt.start_retweet_stream(tagged(read_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "state"), "10 seconds", available_now=True).awaitTermination()
    report = rt.read_report(spark, str(tmp_path / "out"))
    assert report.count() == 0 and "total_retweets" in report.columns


def test_state_holds_panes_not_windows(spark, tmp_path, rows):
    """On its trigger until stopped: a row per id and open pane in the state; panes of closed windows go."""
    src, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    put(src, "1.json", [(s, True, s % 3, s, "t") for s in range(0, 100)])
    job = rt.start_retweet_stream(tagged(read_stream(spark, str(src))), out, str(state), "10 seconds")
    job.processAllAvailable()
    # 100 seconds have 20 panes with three ids each; the watermark, at 89 s, has closed 17 of them
    assert job.lastProgress["stateOperators"][0]["numRowsTotal"] == 3 * 3
    job.stop()
    put(src, "2.json", [(200, True, 9, 1, "t")])
    job = rt.start_retweet_stream(tagged(read_stream(spark, str(src))), out, str(state), "10 seconds", available_now=True)
    job.awaitTermination()
    got = rt.read_report(spark, out)
    # windows end at 60, 65, ..., 190 and hold what lies in them
    want = [(e, i, max(v) - min(v) + 1) for e in range(60, 191, 5) for i in range(3) if (v := [s for s in range(max(0, e - 60), min(e, 100)) if s % 3 == i])]
    assert sorted(tuple(r) for r in got.select("seconds", "tweet_id", "retweets").collect()) == sorted(want)
    left = sorted((state / "panes").iterdir())
    assert len(left) <= 2 and spark.read.parquet(str(left[-1])).count() <= 3 * 20 + 1


def test_last_row_not_by_time(spark, rows, tmp_path):
    """An order that does not begin with the time: the last row of a window may lie in any of its panes."""
    put(tmp_path / "in", "1.json", FIRST)
    df = tagged(spark.read.schema(read_stream(spark, str(tmp_path / "in")).schema).json(str(tmp_path / "in")))
    direct = df.groupBy(F.window("ts", "60 seconds", "5 seconds").alias("window"), "tweet_id").agg(F.max_by("text", F.struct("retweet_count", "lang", "text")).alias("text"))
    got = rt.retweet_windows(df, order=["retweet_count"]).select("window", "tweet_id", "text")
    assert rows(got) == rows(direct)


def test_window_that_is_no_multiple_of_its_slide(spark, rows, tmp_path):
    put(tmp_path / "in", "1.json", FIRST)
    df = tagged(spark.read.schema(read_stream(spark, str(tmp_path / "in")).schema).json(str(tmp_path / "in")))
    direct = df.groupBy(F.window("ts", "60 seconds", "7 seconds").alias("window"), "tweet_id").agg(
        F.max("retweet_count").alias("max_count"), F.min("retweet_count").alias("min_count"), F.max_by("text", "ts").alias("text"))
    got = rt.retweet_windows(df, size=60, slide=7).select("window", "tweet_id", "max_count", "min_count", "text")
    assert rows(got) == rows(direct)


def test_joined_stream_in_slices(spark, rows, tmp_path, monkeypatch):
    """Events in slices by time give the windows of the batch, and no slice's state holds all of them."""
    from skeinwork.catalog import counters
    from skeinwork.catalog.registry import QUERIES

    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(minutes=(i * 37) % 3000), i % 7, "view" if i % 3 else "buy", float(i % 11), f"p{i}") for i in range(240)]
    data += [(240, None, 1, "view", 1.0, "p"), (241, start, 1, None, 2.0, None), (241, start, 1, None, 2.0, None)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(counters, "SLICE_ROWS", 60)
    cut = [s.count() for s in counters._slices(spark.read.parquet(str(tmp_path / "events.parquet")).withColumn("ts", F.col("ts").cast("timestamp")))]
    assert len(cut) > 3 and max(cut) < 100 and sum(cut) >= 242
    got = rows(QUERIES["joined_stream"](spark, str(tmp_path)))
    limit = int((start + dt.timedelta(minutes=2999 - 10) - dt.datetime(1970, 1, 1)).total_seconds())
    whole = QUERIES["retweet_windows"](spark, str(tmp_path)).where(F.col("window_start") + counters.SIZE <= limit)
    assert got == rows(whole.select("window_start", "tweet_id", "retweets", "total_retweets"))


def test_joined_stream_has_few_files_of_state(spark, tmp_path):
    """As many partitions of the state as cores, also where shuffles have more; the session's setting stays."""
    import skeinwork.catalog.counters  # noqa: F401  (registers its queries)
    from skeinwork.catalog.registry import QUERIES
    from skeinwork.session import shared_dir

    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(minutes=i * 9), i % 5, "view", float(i % 11), "p") for i in range(60)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "events.parquet"))
    home = pathlib.Path(shared_dir(spark), "skeinwork", spark.sparkContext.applicationId)
    folders = lambda: set(home.glob("joined-*/*state/state/*/[0-9]*"))
    before, setting = folders(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert QUERIES["joined_stream"](spark, str(tmp_path)).count() > 100
        assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", setting)
    used = [int(f.name) for f in folders() - before]
    assert used and max(used) < spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("most", [20_000, 0])
def test_windows_stream_in_blocks(spark, rows, tmp_path, monkeypatch, most):
    """Blocks of tweets hold the closed windows of the batch once, over restarts, whether they are dealt out by time or spread."""
    monkeypatch.setattr(rt, "BLOCK_TWEETS", 4)
    for bound in ("LEAST_ROWS", "TASK_PANES", "MOST_PANES"):
        monkeypatch.setattr(rt, bound, most)
    src, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    lang = F.when(F.col("retweet_count") % 3 == 0, F.lit("fr")).when(F.col("retweet_count") % 3 == 1, F.lit("en"))
    data = [((s * 37) % 900, True, None if s % 23 == 0 else s % 41, None if s % 41 == 7 else s % 17, "t") for s in range(700)]
    for turn, (low, high) in enumerate(((0, 300), (300, 600), (600, 900))):
        end = [(5000, True, 1, 1, "end")] if high == 900 else []
        put(src, f"{turn}.json", [r for r in data if low <= r[0] < high] + end)
        stream = read_stream(spark, str(src)).withColumnRenamed("retweeted_id", "tweet_id").withColumn("lang", lang).drop("is_retweet")
        job = rt.start_windows_stream(stream, out, str(state), "10 seconds")
        job.awaitTermination()
        # a row per id and open pane
        assert job.lastProgress["stateOperators"][0]["numRowsTotal"] <= 42 * 3
    blocks = spark.read.parquet(f"{out}/*")
    assert blocks.agg(F.max(F.size("tweets"))).first()[0] > 1
    batch = spark.read.schema(read_stream(spark, str(src)).schema).json(str(src)).withColumnRenamed("retweeted_id", "tweet_id").withColumn("lang", lang)
    whole = rt.retweet_windows(batch, carry=["lang"]).where(F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=4990)).cast("timestamp"))
    assert rows(blocks.select("window", "lang", F.inline("tweets"))) == rows(whole.select("window", "lang", "tweet_id", "retweets"))
    totals = lambda df: rows(df.groupBy("window", "lang").agg(F.sum("retweets").alias("total")))
    assert totals(blocks) == totals(whole)


@pytest.mark.parametrize("options", [{}, {"size": 60, "slide": 7}, {"order": ["retweet_count"]}])
def test_report_by_slices_of_time(spark, rows, tmp_path, monkeypatch, options):
    """Windows dealt out by time, in several slices, and windows spread by tweet give the same report in the same order."""
    data = [((s * 37) % 2900, True, None if s % 23 == 0 else s % 11, s % 17, f"t{s}\n") for s in range(700)]
    put(tmp_path / "in", "1.json", data + [(9000, True, 1, 1, "end")])
    lang = F.when(F.col("retweet_count") % 3 == 0, F.lit("fr")).when(F.col("retweet_count") % 3 == 1, F.lit("en"))
    stream = read_stream(spark, str(tmp_path / "in")).withColumnRenamed("retweeted_id", "tweet_id").withColumn("lang", lang).drop("is_retweet")
    reports, slice_windows = [], rt.slice_windows
    for name, most in (("slices", 20_000), ("spread", 0)):
        lengths = []
        for bound in ("LEAST_ROWS", "TASK_PANES", "MOST_PANES"):
            monkeypatch.setattr(rt, bound, most)
        monkeypatch.setattr(rt, "slice_windows", lambda *a: (lengths.append(slice_windows(*a)), lengths[-1])[1])
        rt.start_retweet_stream(stream, str(tmp_path / name), str(tmp_path / f"{name}_state"), "10 seconds", available_now=True, **options).awaitTermination()
        assert {length > 0 for length, n in lengths if n} == {most > 0}
        reports.append(spark.read.parquet(f"{tmp_path}/{name}/windows"))
    assert rows(reports[0]) == rows(reports[1]) and reports[0].count() > 3000
    for report in reports:
        # the part files of a batch, one after another
        parts = sorted({r[0] for r in report.select(F.input_file_name()).distinct().collect()})
        assert len(parts) > 1
        found = [r for part in parts for r in spark.read.parquet(part).coalesce(1).collect()]
        key = [(r["window_start"], -r["total_retweets"], -r["retweets"], r["tweet_id"] is not None, r["tweet_id"] or 0) for r in found]
        assert key == sorted(key)


def test_windows_are_made_where_their_panes_lie(spark, tmp_path):
    """The report shuffles panes, once, and no windows: the one exchange is that of the panes."""
    put(tmp_path / "in", "1.json", FIRST)
    df = tagged(spark.read.schema(read_stream(spark, str(tmp_path / "in")).schema).json(str(tmp_path / "in")))
    panes = rt.retweet_panes(df).localCheckpoint()
    assert rt.slice_windows(panes, 60, 5) == (8 * 12, panes.count())
    report = rt.ordered_slices(panes, 60, 5, ["lang", "text"], True, 12, 3, lambda windows: windows, "lang")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning(_slice" in plan
    whole = rt.with_window_totals(rt.retweet_windows(df))
    columns = ["window", "tweet_id", "retweets", "total_retweets", "text"]
    assert sorted(map(tuple, report.select(*columns).collect())) == sorted(map(tuple, whole.select(*columns).collect()))

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skeinwork.operators import graph as g
from skeinwork.operators import skew
from skeinwork.plans.costar import costar_report, run


def brute(pairs, source, depth):
    near = defaultdict(set)
    films = defaultdict(set)
    for person, film in pairs:
        films[film].add(person)
    for cast in films.values():
        for p in cast:
            near[p] |= cast - {p}
    level, frontier, walks = {source: 0}, {source}, []
    step = {source}
    for i in range(1, depth + 1):
        step = {n for p in step for n in near[p]}
        walks.append(step)
        frontier = {n for p in frontier for n in near[p]} - set(level)
        level.update({p: i for p in frontier})
    return near, level, walks


def random_pairs(seed):
    rnd = random.Random(seed)
    pairs = {(f"p{rnd.randrange(60)}", f"f{rnd.randrange(70)}") for _ in range(130)}
    pairs |= {(f"p{i}", "hot") for i in range(25, 45)}          # one film with a large share of the rows
    return sorted(pairs | {("p0", "f0"), ("lonely", "solo")})


@pytest.mark.parametrize("limit", [g.BROADCAST_ROWS, 0])
def test_against_brute_force(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(g, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(skew, "LEAST_ROWS", 5)
    monkeypatch.setattr(skew, "task_rows", lambda spark, rows: 5)
    pairs = random_pairs(7)
    near, level, walks = brute(pairs, "p0", 5)
    df = spark.createDataFrame(pairs + pairs[:9], "person string, film string")
    graph = g.co_membership(df, "person", "film")
    assert "hot" in {r["item"] for r in graph.hot_items.collect()}
    assert dict(rows(g.bfs_levels(graph, "p0", 5))) == level
    got = defaultdict(set)
    for person, i in rows(g.walk_levels(graph, "p0", 5)):
        got[i].add(person)
    assert [got[i + 1] for i in range(5)] == walks
    assert {r[0] for r in rows(g.vertices(graph))} == {p for p in near if near[p]}
    meetings = {r["person"]: r["meetings"] for r in g.costar_counts(graph).collect()}
    films = defaultdict(set)
    for p, f in pairs:
        films[f].add(p)
    assert meetings == {p: sum(len(films[f]) - 1 for f in films if p in films[f]) for p, _ in pairs}


def test_two_person_film_walks_back(spark, rows):
    graph = g.co_membership(spark.createDataFrame([("a", "x"), ("b", "x")], "p string, f string"), "p", "f")
    walks = g.walk_levels(graph, "a", 3)
    assert rows(walks) == [("a", 2), ("b", 1), ("b", 3)]
    assert rows(g.walk_summary(walks)) == [(1, 1, 1), (2, 1, 0), (3, 1, 0)]
    assert rows(g.walk_members(walks, 2)) == [("a",)]
    assert rows(g.bfs_levels(graph, "a", 3)) == [("a", 0), ("b", 1)]
    assert rows(g.bfs_levels(graph, "absent", 3)) == [("absent", 0)]


def test_summary(spark, rows):
    pairs = [("a", "1"), ("b", "1"), ("c", "1"), ("c", "2"), ("d", "2"), ("x", "9"), ("y", "9")]
    graph = g.co_membership(spark.createDataFrame(pairs, "p string, f string"), "p", "f")
    people = g.vertices(graph).withColumn("group", F.when(F.col("person").isin("b", "c"), F.lit("F")).otherwise(F.lit("M")))
    levels = g.bfs_levels(graph, "a", 3)
    assert rows(g.level_summary(levels, people, "group", 3)) == [
        (1, 2, 0, 2, 0.0, 100.0, 2, round(2 / 6, 6)), (2, 1, 1, 0, 25.0, 0.0, 3, 0.5), (3, 0, 0, 0, 0.0, 0.0, 3, 0.5)
    ]
    assert rows(g.distances(people, levels).where("level is null").select("person")) == [("x",), ("y",)]
    assert rows(g.level_members(levels, people, 1).select("group", "person", "number")) == [("F", "b", 1), ("F", "c", 2)]
    assert g.count_items(graph.members, "item").first()[0] == 3
    assert g.count_items(graph.members, "item", approximate=True).first()[0] == 3


def test_report_from_files(spark, tmp_path):
    (tmp_path / "m").write_text("A\tF (2012)\n\t\t\tOld (2001)\n\nB\tF (2012)\n\t\t\tG (2013)\n")
    (tmp_path / "f").write_text("A\tG (2013)\n\nC\tOld (2001)\n")
    args = (spark, str(tmp_path / "m"), str(tmp_path / "f"), "A")
    report = costar_report(*args, max_level=2)
    assert report["films"].first()[0] == 2
    assert tuple(report["totals"].first()) == (3, 2, 1)
    assert [tuple(r)[:4] for r in report["levels"].orderBy("level").collect()] == [(1, 1, 1, 0), (2, 1, 0, 1)]
    assert [(r["group"], r["person"], r["number"]) for r in report["members"].collect()] == [("F", "A", 1)]
    walks = costar_report(*args, max_level=3, walks=True)
    # A - B - a: everyone has a walk of length 3, those next to A have none of length 2
    assert [(r["level"], r["people"], r["males"], r["females"], r["pct_males"]) for r in walks["levels"].orderBy("level").collect()] == [
        (1, 1, 1, 0, 50.0), (2, 2, 0, 1, 0.0), (3, 1, 0, -1, 0.0)]
    assert [(r["group"], r["person"], r["number"]) for r in walks["members"].collect()] == [("M", "B", 1)]
    run(*args, str(tmp_path / "out"))
    assert (tmp_path / "out/levels").exists()


def _above(plan, scan):
    """Lines of a plan above the line `scan`, up to the nearest join."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    lines, at, out = plan.splitlines(), scan, []
    level = depth(lines[scan])
    while at > 0 and "Join" not in (out[-1] if out else ""):
        at -= 1
        if depth(lines[at]) < level:
            level = depth(lines[at])
            out.append(lines[at])
    return out


def test_a_round_does_not_shuffle_the_memberships(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_ROWS", 5)
    monkeypatch.setattr(skew, "task_rows", lambda spark, rows: 5)
    graph = g.co_membership(spark.createDataFrame(random_pairs(2), "person string, film string"), "person", "film")
    frontier = spark.createDataFrame([("p0",), ("p1",)], "person string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = g.neighbours(graph, frontier, g.BROADCAST_ROWS + 1)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scans = [i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line]
    assert len(scans) == 2
    for scan in scans:
        above = _above(plan, scan)
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above), plan


@pytest.mark.parametrize("ids", [[5, 6, 7, 40_000, 100_000], [-3, -2, -1, 0, 1], [0, 1 << 40, 3, 1 << 62, 9], [32767, 32768, 32769, 65536, 1]])
def test_numbers_near_and_far(spark, rows, ids):
    """People in a line; numbers that lie far apart are numbered anew."""
    pairs = [(p, f"f{i + k}") for i, p in enumerate(ids) for k in (0, 1)]
    graph = g.co_membership(spark.createDataFrame(pairs, "person long, film string"), "person", "film")
    assert rows(g.bfs_levels(graph, ids[0], 6)) == sorted(((p, i) for i, p in enumerate(ids)), key=repr)


def test_bits(spark, rows):
    some = spark.createDataFrame([(i,) for i in (1, 8, 9, 32768, 32769, 0, -1, -40000)], "person long")
    every = spark.createDataFrame([(i,) for i in range(-40010, 33000, 1)], "person long")
    left = {r[0] for r in g.not_in_bits(every, g.bits_of(some)).collect()}
    assert left == set(range(-40010, 33000)) - {1, 8, 9, 32768, 32769, 0, -1, -40000}


def test_count_items(spark):
    df = spark.createDataFrame([(i % 700,) for i in range(3000)] + [(None,)], "item int")
    assert g.count_items(df, "item").first()[0] == 700
    assert abs(g.count_items(df, "item", approximate=True).first()[0] - 700) <= 70


@pytest.mark.parametrize("kind", ["long", "string"])
def test_empty_graph(spark, kind):
    graph = g.co_membership(spark.createDataFrame([], f"person {kind}, film string"), "person", "film")
    source = 5 if kind == "long" else "p"
    assert [tuple(r) for r in g.bfs_levels(graph, source, 3).collect()] == [(source, 0)]
    assert g.walk_levels(graph, source, 3).count() == 0 and g.vertices(graph).count() == 0


def test_lists_are_parsed_once(spark, tmp_path):
    """The films are counted from the rows that the graph is made of; a film of a person without a name counts."""
    from skeinwork.plans.costar import report_of
    from skeinwork.sources.text_records import with_title

    raw = [("M", "a", "One (2012) [x]"), ("M", "b", "One (2012)"), ("F", None, "Two (2013)"), ("F", "c", "no year"), ("F", "c", "(2014) (sub) (2015/II)"), ("F", "c", None)]
    found = with_title(spark.createDataFrame(raw, "group string, person string, raw string"))
    assert sorted((r.movie, r.year) for r in found.collect()) == [("(2014)", 2014), ("One (2012)", 2012), ("One (2012)", 2012), ("Two (2013)", 2013)]
    films = report_of(found, "a")["films"]
    assert films.collect() == [(3,)] and "regexp_extract" not in films._jdf.queryExecution().optimizedPlan().toString()

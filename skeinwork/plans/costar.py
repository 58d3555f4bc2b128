"""Distances from one person in the graph of shared films."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators.graph import (
    bfs_levels,
    co_membership,
    count_items,
    level_members,
    level_summary,
    numbered_members,
    vertices,
    walk_levels,
    walk_members,
    walk_shares,
)
from skeinwork.operators.text_ids import with_group_id
from skeinwork.session import materialize
from skeinwork.sources.sinks import write_numbered, write_report
from skeinwork.sources.text_records import read_memberships

# First year, levels.
MIN_YEAR, MAX_LEVEL = 2011, 6


def costar_report(
    spark: SparkSession, male: str, female: str, source: str, group: str = "M",
    min_year: int = MIN_YEAR, max_level: int = MAX_LEVEL, walks: bool = False,
) -> dict[str, DataFrame]:
    """Tables `films`, `totals`, `levels` and `members` (those at the last level).

    walks=True counts walks of each length instead of shortest distances; its
    members are those with a walk of the last length and none one step shorter.
    """
    return report_of(read_memberships(spark, male, female, min_year), source, group, max_level, walks)


def report_of(memberships: DataFrame, source: str, group: str = "M", max_level: int = MAX_LEVEL, walks: bool = False) -> dict[str, DataFrame]:
    """The report from (group, person, movie) rows; the same name in two groups is two people."""
    # parsed once: read for the graph and for the films
    rows = materialize(with_group_id(memberships).select("person_id", "movie"), "memberships")
    graph = co_membership(rows, "person_id", "movie")
    people = materialize(
        vertices(graph).withColumns({"group": F.substring("person", 1, 1), "name": F.substring("person", 3, 1 << 30)}),
        "people",
    )
    start = f"{group}:{source}"
    if walks:
        levels = walk_levels(graph, start, max_level)
        summary = walk_shares(levels, people, "group", max_level)
        members = numbered_members(walk_members(levels, max_level).join(people.drop("name"), "person").select("group", "person"))
    else:
        levels = bfs_levels(graph, start, max_level)
        summary = level_summary(levels, people, "group", max_level)
        members = level_members(levels, people.drop("name"), max_level)
    totals = people.agg(
        F.count(F.lit(1)).alias("people"),
        F.count_if(F.col("group") == "M").alias("males"),
        F.count_if(F.col("group") == "F").alias("females"),
    )
    named = members.withColumn("person", F.substring("person", 3, 1 << 30))
    return {"films": count_items(rows, "movie"), "totals": totals, "levels": summary, "members": named}


def run(spark: SparkSession, male: str, female: str, source: str, out: str) -> None:
    report = costar_report(spark, male, female, source)
    for name in ("films", "totals", "levels"):
        write_report(report[name], f"{out}/{name}")
    write_numbered(report["members"], f"{out}/members")

"""Distances in the graph of people who share an item (film, order, day ...).

The pair list of an item with m people has m * m rows, so it is never built.
A step goes person -> item -> person instead: both joins are linear in the
membership table, and one count per item says who has a neighbour in the
frontier.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from skeinwork.functions.text import percent
from skeinwork.operators.numbering import global_index
from skeinwork.operators.skew import cut_hot, hot_among, hot_keys, repeat_hot, salted_join
from skeinwork.session import materialize, materialize_bucketed, materialize_counted

BROADCAST_ROWS = 200_000    # a frontier up to this many ids (numbers or names, some MB) is broadcast
BUCKET_ROWS = 2_000_000     # memberships in a bucket
SPARSE = 64                 # person numbers may span so many values per membership; wider ones are numbered anew


@dataclass
class CoMembership:
    """Distinct (person, item) rows, and (item, people) counts.

    For the steps of a search the memberships are written in buckets by item,
    and by person when a frontier is large: a round shuffles what the frontier
    touches, not the memberships.
    """

    members: DataFrame
    per_item: DataFrame

    @cached_property
    def hot_items(self) -> DataFrame | None:
        return hot_among(self.per_item.withColumnRenamed("people", "_n"), ["item"])

    @cached_property
    def buckets(self) -> int:
        rows = self.per_item.agg(F.sum("people")).first()[0] or 0
        return max(int(self.members.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + rows // BUCKET_ROWS)

    @cached_property
    def by_item(self) -> DataFrame:
        """The memberships in items of two or more people (the others lead nowhere), in buckets by item and piece of a hot item."""
        two = self.per_item.where("people > 1").select("item")
        shared = salted_join(self.members, two, ["item"], ["person"], self.hot_items)
        return materialize_bucketed(cut_hot(shared, ["item"], self.hot_items, ["person"]), self.buckets, "item", "_piece")

    @property
    def shared(self) -> DataFrame:
        """(person, item) in items of two or more people."""
        return self.by_item.select("person", "item")

    @cached_property
    def hot_people(self) -> DataFrame | None:
        return hot_keys(self.shared, ["person"])

    @cached_property
    def by_person(self) -> DataFrame:
        """`shared` in buckets by person and piece of a hot person."""
        return materialize_bucketed(cut_hot(self.shared, ["person"], self.hot_people, ["item"]), self.buckets, "person", "_piece")

    @cached_property
    def numbered(self) -> tuple[CoMembership, DataFrame | None]:
        """The same graph with people as whole numbers close together, and (person, number), None if they are such numbers already."""
        if isinstance(self.members.schema["person"].dataType, IntegralType):
            low, high, rows = self.members.agg(F.min("person"), F.max("person"), F.count("person")).first()
            if not rows or high - low <= SPARSE * rows:
                return self, None
        names = materialize(global_index(self.members.select("person").distinct(), ["person"], "number"), "people")
        rows = salted_join(self.members, names, ["person"], ["item"], hot_keys(self.members, ["person"]))
        members = materialize(rows.select(F.col("number").alias("person"), "item"), "numbered_members")
        return CoMembership(members, self.per_item), names


def co_membership(members: DataFrame, person: str, item: str) -> CoMembership:
    """Write the distinct memberships and the people per item once; what else is needed is found on first use."""
    pairs = members.select(F.col(person).alias("person"), F.col(item).alias("item"))
    table = materialize(pairs.where("person is not null and item is not null").distinct(), "members")
    return CoMembership(table, materialize(table.groupBy("item").agg(F.count(F.lit(1)).alias("people")), "per_item"))


def costar_counts(graph: CoMembership) -> DataFrame:
    """Per person: items, and (co-star, item) meetings = rows of the ordered pair list."""
    return (
        salted_join(graph.members, graph.per_item, ["item"], ["person"], graph.hot_items)
        .groupBy("person")
        .agg(F.count(F.lit(1)).alias("items"), F.sum(F.col("people") - 1).alias("meetings"))
    )


def count_items(members: DataFrame, item: str, approximate: bool = False) -> DataFrame:
    """Number of distinct items, one row."""
    counted = F.approx_count_distinct(item) if approximate else F.count_distinct(item)
    return members.agg(counted.alias("items"))


def vertices(graph: CoMembership) -> DataFrame:
    """People with at least one co-star."""
    return graph.shared.select("person").distinct()


def neighbours(graph: CoMembership, frontier: DataFrame, size: int | None = None) -> DataFrame:
    """Distinct people who share an item with someone else in `frontier`.

    `frontier` has one column `person` without repeats. An item with one
    frontier member reaches all the others; with two or more it reaches
    everyone in it. The memberships are not shuffled: they lie in buckets.
    """
    if size is None:
        size = frontier.count()
    if size <= BROADCAST_ROWS:
        touched = graph.by_item.join(F.broadcast(frontier), "person")
    else:
        touched = graph.by_person.join(repeat_hot(frontier, ["person"], graph.hot_people), ["person", "_piece"])
    per_item = touched.groupBy("item").agg(
        F.count(F.lit(1)).alias("_inside"), F.min("person").alias("_only")
    )
    reached = graph.by_item.join(repeat_hot(per_item, ["item"], graph.hot_items), ["item", "_piece"])
    return reached.where((F.col("_inside") > 1) | (F.col("person") != F.col("_only"))).select("person").distinct()


def _source_frame(graph: CoMembership, source) -> DataFrame:
    kind = graph.members.schema["person"].dataType
    return graph.members.sparkSession.range(1).select(F.lit(source).cast(kind).alias("person"))


def _in_numbers(graph: CoMembership, source) -> tuple[CoMembership, DataFrame | None, DataFrame]:
    """The numbered graph, the names of its people, and the source as its number (no row if it is not in the graph)."""
    own, names = graph.numbered
    start = _source_frame(graph, source)
    return own, names, start if names is None else names.join(F.broadcast(start), "person").select(F.col("number").alias("person"))


def _with_names(levels: DataFrame, names: DataFrame | None) -> DataFrame:
    if names is None:
        return levels
    return levels.withColumnRenamed("person", "number").join(names, "number").select("person", "level")


def bits_of(people: DataFrame) -> DataFrame:
    """(range, bits): a bitmap of the numbers that occur, a row per range of 32,768 numbers."""
    return people.groupBy(F.bitmap_bucket_number("person").alias("range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("person")).alias("bits")
    )


def not_in_bits(people: DataFrame, bits: DataFrame) -> DataFrame:
    """The people whose bit is not set; one join against a row per range."""
    at = F.bitmap_bit_position("person")
    byte = F.conv(F.hex(F.substr("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (at % 8).cast("int")) == 1
    found = people.withColumn("range", F.bitmap_bucket_number("person")).join(bits, "range", "left")
    return found.where(F.col("bits").isNull() | ~is_set).select("person")


def bfs_levels(graph: CoMembership, source, max_level: int = 6) -> DataFrame:
    """Shortest distance from `source`: (person, level), the source at level 0.

    Each round is written before the next one starts, so the plan stays the
    same size; its rows are counted while they are written. Who was seen before
    is a bitmap per range of numbers, one bit a person, to which a round adds its
    own: a round reads that one table, whatever its number.
    """
    own, names, start = _in_numbers(graph, source)
    frontier, size, levels = materialize(start, "level"), 1, []
    seen = materialize(bits_of(frontier), "seen")
    for level in range(1, max_level + 1):
        fresh, size = materialize_counted(not_in_bits(neighbours(own, frontier, size), seen), "level")
        if size == 0:
            break
        levels.append(fresh.withColumn("level", F.lit(level)))
        if level < max_level:
            both = seen.unionByName(bits_of(fresh))
            seen = materialize(both.groupBy("range").agg(F.bitmap_or_agg("bits").alias("bits")), "seen")
        frontier = fresh
    first = _source_frame(graph, source).withColumn("level", F.lit(0))
    return first.unionByName(_with_names(reduce(DataFrame.unionByName, levels), names)) if levels else first


def walk_levels(graph: CoMembership, source, max_level: int = 6) -> DataFrame:
    """(person, level) for every level with a walk of exactly that length.

    A person may be in several levels, and the source returns at level 2.
    """
    own, names, frontier = _in_numbers(graph, source)
    size, levels = 1, []
    for level in range(1, max_level + 1):
        frontier, size = materialize_counted(neighbours(own, frontier, size), "walk")
        levels.append(frontier.withColumn("level", F.lit(level)))
        if size == 0:
            break
    return _with_names(reduce(DataFrame.unionByName, levels), names)


def distances(people: DataFrame, levels: DataFrame) -> DataFrame:
    """Every vertex with its level; NULL = not reached."""
    return people.join(levels, "person", "left")


def level_summary(levels: DataFrame, people: DataFrame, group: str, max_level: int = 6) -> DataFrame:
    """Per level: newly reached people and shares by group, running total and ratio.

    `people` is the vertex set with a group column holding `M` and `F`. One
    aggregation each over vertices and levels; what follows has max_level rows.
    """
    male, female = F.col(group) == "M", F.col(group) == "F"
    totals = people.agg(
        F.count(F.lit(1)).alias("_all"),
        F.count_if(male).alias("_all_m"),
        F.count_if(female).alias("_all_f"),
    )
    counted = (
        levels.where(F.col("level").between(1, max_level))
        .join(people, "person")
        .groupBy("level")
        .agg(F.count_if(male).alias("males"), F.count_if(female).alias("females"), F.count(F.lit(1)).alias("people"))
    )
    so_far = Window.partitionBy(F.lit(0)).orderBy("level")
    frame = people.sparkSession.range(1, max_level + 1).select(F.col("id").cast("int").alias("level"))
    rows = frame.join(F.broadcast(counted), "level", "left").na.fill(0, ["males", "females", "people"])
    # one row of totals next to at most max_level rows
    rows = rows.withColumn("_one", F.lit(1)).join(F.broadcast(totals.withColumn("_one", F.lit(1))), "_one")
    return rows.select(
        "level",
        "people",
        "males",
        "females",
        F.round(percent(F.col("males"), F.col("_all_m")), 6).alias("pct_males"),
        F.round(percent(F.col("females"), F.col("_all_f")), 6).alias("pct_females"),
        F.sum("people").over(so_far).alias("reached"),
        F.round(F.try_divide(F.sum("people").over(so_far), F.col("_all")), 6).alias("reached_ratio"),
    )


def walk_shares(levels: DataFrame, people: DataFrame, group: str, max_level: int = 6) -> DataFrame:
    """Per walk length: people, by how many more than one step before by group, and those as shares of the group.

    A row for every length, with or without people.
    """
    male, female = F.col(group) == "M", F.col(group) == "F"
    totals = people.agg(F.count(F.lit(1)).alias("_all"), F.count_if(male).alias("_all_m"), F.count_if(female).alias("_all_f"))
    counted = levels.where(F.col("level").between(1, max_level)).join(people, "person").groupBy("level").agg(
        F.count(F.lit(1)).alias("people"), F.count_if(male).alias("_m"), F.count_if(female).alias("_f")
    )
    frame = people.sparkSession.range(1, max_level + 1).select(F.col("id").cast("int").alias("level"), F.lit(1).alias("_one"))
    rows = frame.join(F.broadcast(counted), "level", "left").na.fill(0, ["people", "_m", "_f"])
    # one row of totals next to max_level rows
    rows = rows.join(F.broadcast(totals.withColumn("_one", F.lit(1))), "_one")
    in_order = Window.partitionBy(F.lit(0)).orderBy("level")
    more = lambda c: F.col(c) - F.coalesce(F.lag(c).over(in_order), F.lit(0))
    return rows.withColumns({"males": more("_m"), "females": more("_f")}).select(
        "level", "people", "males", "females",
        F.round(percent(F.col("males"), F.col("_all_m")), 6).alias("pct_males"),
        F.round(percent(F.col("females"), F.col("_all_f")), 6).alias("pct_females"),
        F.round(F.try_divide(F.col("people"), F.col("_all")), 6).alias("ratio"),
    )


def walk_summary(levels: DataFrame, max_level: int = 6) -> DataFrame:
    """People per walk length and the difference to the length before."""
    in_order = Window.partitionBy(F.lit(0)).orderBy("level")     # max_level rows
    counted = levels.where(F.col("level") <= max_level).groupBy("level").agg(F.count(F.lit(1)).alias("people"))
    return counted.withColumn(
        "newly", F.col("people") - F.coalesce(F.lag("people").over(in_order), F.lit(0))
    )


def walk_members(levels: DataFrame, level: int) -> DataFrame:
    """People with a walk of length `level` and none of length `level` - 1."""
    now = levels.where(F.col("level") == level).select("person")
    before = levels.where(F.col("level") == level - 1).select("person")
    return now.join(before, "person", "left_anti")


def numbered_members(people: DataFrame, group: str = "group", name: str = "person") -> DataFrame:
    """Number people from 1 within each group, by name.

    A group may hold any share of the people, so the number is a global
    position minus the first position of the group.
    """
    indexed = global_index(people, [group, name], "_idx")
    first = indexed.groupBy(group).agg(F.min("_idx").alias("_first"))
    return (
        indexed.join(first, group)
        .withColumn("number", F.col("_idx") - F.col("_first") + 1)
        .drop("_idx", "_first")
    )


def level_members(levels: DataFrame, people: DataFrame, level: int, group: str = "group") -> DataFrame:
    """Numbered list per group of the people at one level."""
    chosen = levels.where(F.col("level") == level).join(people, "person")
    return numbered_members(chosen.select(group, "person"), group)

"""Distances between customers who were served by one supplier on one day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.catalog.registry import query, table
from skeinwork.operators import graph as g
from skeinwork.plans.costar import costar_report
from skeinwork.session import materialize, scratch_path
from skeinwork.sources.sinks import write_numbered
from skeinwork.sources.text_records import read_membership

SOURCE, LEVELS = 0, 6

MEMBERS = """
m as (
  select distinct o_custkey as person, l_suppkey || '@' || l_shipdate::date as item
  from orders join lineitem on o_orderkey = l_orderkey)
"""
EDGES = f"""
{MEMBERS},
e as (select distinct a.person as src, b.person as dst from m a join m b using (item) where a.person <> b.person)
"""
WALKS = f"""
with recursive {EDGES},
r(person, level) as (
  select {SOURCE}::bigint, 0 union select e.dst, r.level + 1 from r join e on r.person = e.src where r.level < {LEVELS})
"""
PEOPLE = """
people as (
  select v.person, case when c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD') then 'M' else 'F' end as "group"
  from (select distinct src as person from e) v join customer on c_custkey = v.person)
"""


def _graph(spark: SparkSession, sf_dir: str) -> g.CoMembership:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    served = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("person"),
        F.concat_ws("@", F.col("l_suppkey").cast("string"), F.col("l_shipdate").cast("date").cast("string")).alias("item"),
    )
    return g.co_membership(served, "person", "item")


def _people(spark: SparkSession, sf_dir: str, graph: g.CoMembership) -> DataFrame:
    group = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), F.lit("M")).otherwise(F.lit("F"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), group.alias("group"))
    return g.vertices(graph).join(customers, "person")


@query(f"""
with {MEMBERS}
select a.person, count(distinct a.item) as items, count(*) filter (a.person <> b.person) as meetings
from m a join m b using (item) group by a.person
""")
def costar_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.costar_counts(_graph(spark, sf_dir))


@query(f"with {MEMBERS} select count(distinct item) as items from m")
def count_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.count_items(_graph(spark, sf_dir).members, "item")


@query(f"{WALKS} select person, min(level) as level from r group by person")
def bfs_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.bfs_levels(_graph(spark, sf_dir), SOURCE, LEVELS)


@query(f"""
{WALKS}, d as (select person, min(level) as level from r group by person)
select v.person, d.level from (select distinct src as person from e) v left join d using (person)
""")
def graph_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = _graph(spark, sf_dir)
    return g.distances(g.vertices(graph), g.bfs_levels(graph, SOURCE, LEVELS))


@query(f"""
{WALKS}, c as (select level, count(*) as people from r where level > 0 group by level)
select level, people, people - coalesce(lag(people) over (order by level), 0) as newly from c
""")
def walk_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.walk_summary(g.walk_levels(_graph(spark, sf_dir), SOURCE, LEVELS), LEVELS)


@query(f"""
{WALKS}, {PEOPLE},
d as (select person, min(level) as level from r group by person),
t as (select count(*) as n, count(*) filter ("group" = 'M') as m, count(*) filter ("group" = 'F') as f from people),
c as (
  select i.level::int as level, count(people.person) as people, count(*) filter ("group" = 'M') as males,
         count(*) filter ("group" = 'F') as females
  from generate_series(1, {LEVELS}) i(level) left join d on d.level = i.level left join people on people.person = d.person
  group by i.level)
select level, people, males, females,
       round(males * 100.0 / m, 6)::double as pct_males, round(females * 100.0 / f, 6)::double as pct_females,
       (sum(people) over (order by level))::bigint as reached,
       round((sum(people) over (order by level)) / n, 6)::double as reached_ratio
from c, t
""")
def level_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = _graph(spark, sf_dir)
    people = materialize(_people(spark, sf_dir, graph), "people")
    return g.level_summary(g.bfs_levels(graph, SOURCE, LEVELS), people, "group", LEVELS)


@query(f"""
{WALKS}, {PEOPLE},
d as (select person, min(level) as level from r group by person)
select "group", person, row_number() over (partition by "group" order by person) as number
from d join people using (person) where level = 3
""")
def level_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = _graph(spark, sf_dir)
    return g.level_members(g.bfs_levels(graph, SOURCE, LEVELS), _people(spark, sf_dir, graph), 3)


@query(f"""
{WALKS}, {PEOPLE},
d as (select person, min(level) as level from r group by person)
select "group", row_number() over (partition by "group" order by person) || '. ' || person as line from d join people using (person) where level = 2
""")
def numbered_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered list of each group as text files, read back."""
    graph, path = _graph(spark, sf_dir), scratch_path(spark, "numbered")
    listed = g.level_members(g.bfs_levels(graph, SOURCE, 2), _people(spark, sf_dir, graph), 2)
    write_numbered(listed.withColumn("person", F.col("person").cast("string")), path)
    return spark.read.text(path).select("group", F.col("value").alias("line"))


@query(f"""
{WALKS}
select person from r where level = 4 and person not in (select person from r where level = 3)
""")
def walk_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.walk_members(g.walk_levels(_graph(spark, sf_dir), SOURCE, LEVELS), 4)


@query("""
with titles as (
  select p_brand || '#' || p_partkey as person,
         p_name || ' (' || (1990 + p_size) || case when p_size > 25 then '/II' else '' end || ') [' || p_type || '] <3>' as raw
  from part
  union all
  select p_brand || '#' || p_partkey,
         case p_type when 'PROMO' then '"' || p_name || '" (2013)'
                     when 'SMALL' then p_name || ' (????)'
                     when 'ECONOMY' then p_name
                     else p_name || ' (sub) (' || (1990 + p_size) || ') (TV)' end
  from part),
keyed as (
  select person, regexp_extract(raw, '^(.*?\\((\\d{4}|\\?{4})[^)]*\\))', 1) as movie from titles where raw not like '"%')
select 'M' as "group", person, movie, try_cast(regexp_extract(movie, '\\((\\d{4}|\\?{4})[^(]*$', 1) as int) as year
from keyed where movie <> ''
""")
def membership_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph records written to the shared folder and read back."""
    year = (F.col("p_size") + 1990).cast("string")
    first = F.concat(
        "p_name", F.lit(" ("), year, F.when(F.col("p_size") > 25, F.lit("/II")).otherwise(F.lit("")),
        F.lit(") ["), "p_type", F.lit("] <3>"),
    )
    second = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit('"'), "p_name", F.lit('" (2013)')))
        .when(F.col("p_type") == "SMALL", F.concat("p_name", F.lit(" (????)")))
        .when(F.col("p_type") == "ECONOMY", F.col("p_name"))
        .otherwise(F.concat("p_name", F.lit(" (sub) ("), year, F.lit(") (TV)")))
    )
    person = F.concat_ws("#", "p_brand", F.col("p_partkey").cast("string"))
    record = F.concat(person, F.lit("\t"), first, F.lit("\n\t\t\t"), second)
    path = scratch_path(spark, "membership")
    table(spark, sf_dir, "part").select(record.alias("value")).write.option("lineSep", "\n\n").text(path)
    return read_membership(spark, path, "M")


FIRST_YEAR, NAMES = 1994, 900


@query(f"""
with recursive served as (
  select case when c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD') then 'M' else 'F' end as "group", 'P' || (c_custkey % {NAMES}) as name,
         l_suppkey % 40 || '@' || l_shipdate::date as item, year(l_shipdate) as y
  from orders join lineitem on o_orderkey = l_orderkey join customer on c_custkey = o_custkey),
m as (select distinct "group" || ':' || name as person, item from served where y >= {FIRST_YEAR}),
e as (select distinct a.person as src, b.person as dst from m a join m b using (item) where a.person <> b.person),
r(person, level) as (select 'M:P0', 0 union select e.dst, r.level + 1 from r join e on r.person = e.src where r.level < {LEVELS}),
people as (select distinct src as person, src[1] as "group", substr(src, 3) as name from e),
t as (select count(*) as n, count(*) filter ("group" = 'M') as m, count(*) filter ("group" = 'F') as f from people),
c as (
  select i.level::int as level, count(people.person) as people, count(*) filter ("group" = 'M') as m, count(*) filter ("group" = 'F') as f
  from generate_series(1, {LEVELS}) i(level) left join r on r.level = i.level left join people on people.person = r.person group by i.level),
d as (
  select level, people, m - coalesce(lag(m) over (order by level), 0) as males, f - coalesce(lag(f) over (order by level), 0) as females from c),
listed as (
  select "group", name, row_number() over (partition by "group" order by person) as number from people
  where person in (select person from r where level = {LEVELS}) and person not in (select person from r where level = {LEVELS - 1}))
select 'level' as kind, level, people, males, females, round(males * 100.0 / m, 6)::double as pct_males,
       round(females * 100.0 / f, 6)::double as pct_females, round(people / n, 6)::double as ratio,
       null::varchar as "group", null::varchar as name, null::bigint as number
from d, t
union all select 'total', null, n, m, f, null, null, null, null, null, null from t
union all select 'films', null, count(distinct item), null, null, null, null, null, null, null, null from m
union all select 'member', null, null, null, null, null, null, null, "group", name, number from listed
""")
def walk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report in walk mode: lists written as text and read back from a first year on; one name may be in both lists."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    served = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).join(customers, F.col("c_custkey") == F.col("o_custkey"))
    male = F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD")
    title = F.concat(
        (F.col("l_suppkey") % 40).cast("string"), F.lit("@"), F.col("l_shipdate").cast("date").cast("string"),
        F.lit(" ("), F.year("l_shipdate").cast("string"), F.lit(") [role]"),
    )
    record = F.concat(F.lit("P"), (F.col("c_custkey") % NAMES).cast("string"), F.lit("\t"), title, F.lit("\n\t\t\t"), F.lit('"A series" (2013)'))
    path = scratch_path(spark, "lists")
    for folder, rows in (("male", served.where(male)), ("female", served.where(~male))):
        rows.select(record.alias("value")).write.option("lineSep", "\n\n").text(f"{path}/{folder}")
    report = costar_report(spark, f"{path}/male", f"{path}/female", "P0", min_year=FIRST_YEAR, max_level=LEVELS, walks=True)
    parts = {
        "level": report["levels"],
        "total": report["totals"],
        "films": report["films"].withColumnRenamed("items", "people"),
        "member": report["members"].withColumnRenamed("person", "name"),
    }
    columns = {
        "level": "int", "people": "bigint", "males": "bigint", "females": "bigint", "pct_males": "double", "pct_females": "double", "ratio": "double",
        "group": "string", "name": "string", "number": "bigint",
    }
    found = None
    for kind, df in parts.items():
        has = lambda c: F.col(c) if c in df.columns else F.lit(None)
        one = df.select(F.lit(kind).alias("kind"), *[has(c).cast(t).alias(c) for c, t in columns.items()])
        found = one if found is None else found.unionByName(one)
    return found

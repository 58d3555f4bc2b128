"""URL filter: rules for hosts and paths, and for the rest trust that spreads between hosts.

Rules decide first. A page that no rule fits is judged by its host: trust is a
personalised PageRank that starts at the hosts of allowed pages and follows the
links; distrust starts at the hosts of blocked pages and follows them backwards
(who links to a blocked host is suspect). Both are shares that sum to 1. A host
is blocked when its distrust exceeds its trust by more than `THRESHOLD` times
its share of all pages.

Host edges are links of the pages to other hosts, counted once per page, and,
with `family`, edges both ways between a host and the domain above it, so that
pages whose links stay on their own host still inform on their neighbours.
A host without an edge keeps its mass.

Masses are shares of one, so they shrink with the number of hosts; a host's share
of all pages is what it would have if its distrust were average.

Defined results: a null url, or one without `://`, has an empty host and path,
fits no rule and is allowed. Null html has no links. Repeated pages count as
often as they occur. Of equally long rules that fit, the last by text decides. A
url or html of any length is read whole, in its row. Without seeds trust and
distrust are 0 and everything is allowed; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators.skew import hot_among, hot_keys, salted_join
from skeinwork.session import materialize

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
ROUNDS = 12
THRESHOLD = 0.5
PUBLIC_SUFFIX = r"^[^.]*$|^(?:ac|co|com|edu|gov|ne|net|or|org)\.[a-z]{2}$"      # fixed values: domains under which anyone can register
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""


def _lowered(host: Column) -> Column:
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.coalesce(_lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _domains(host: Column) -> Column:
    """A host and every domain above it; a host has few labels."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(domain, prefix, rule, ruled, nth) of rules `(verdict, "host/path")`."""
    rows = [(*_parted(rule), rule, kind, n) for n, (kind, rule) in enumerate(rules)]
    return spark.createDataFrame(rows, "domain string, prefix string, rule string, ruled string, nth long")


def _parted(rule: str) -> tuple[str, str]:
    name, slash, rest = rule.partition("/")
    return name, slash + rest


def longest_rules(urls: DataFrame, rules: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(host, path, rule, ruled) of the distinct `urls` that a rule fits: the longest one, of equally long ones the last by text.

    A rule fits its domain and all hosts below it where the path starts with
    its prefix. Rules meet hosts by an equi-join on the domains of a host, so
    there may be any number of them; then the urls of a host meet its rules.
    `hot` are the hosts with a large share of the urls.
    """
    hosts = urls.select("host").distinct().select("host", F.explode(_domains(F.col("host"))).alias("domain"))
    near = materialize(hosts.join(rules, "domain").drop("domain"), "rules_of_hosts")
    met = salted_join(urls, near, ["host"], ["path"], hot).where(F.expr("startswith(path, prefix)"))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "nth", "ruled")).alias("x")
    return met.groupBy("host", "path").agg(best).select("host", "path", "x.rule", "x.ruled")


def host_edges(pages: DataFrame, host: str, html: str, family: bool = True) -> DataFrame:
    """(src, dst, weight): pages of `src` that link to `dst`; family edges have weight 1."""
    found = F.transform(
        F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1)), lambda link: _lowered(F.regexp_extract(link, "//([^/?#]*)", 1))
    )
    links = pages.where(F.col(host) != "").select(F.col(host).alias("src"), F.explode(F.array_distinct(found)).alias("dst"))
    edges = links.where("dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    if not family:
        return edges
    hosts = pages.select(F.col(host).alias("h")).where("h <> ''").union(edges.select("dst")).distinct()
    # the domains above a host that someone can own: not a top-level domain, nor one like co.uk
    above = F.filter(_domains(F.col("h")), lambda d: ~d.rlike(PUBLIC_SUFFIX))
    chain = hosts.withColumn("above", above).where(F.size("above") > 1).select(F.explode(F.arrays_zip(
        F.slice("above", 1, F.size("above") - 1).alias("child"), F.slice("above", 2, F.size("above") - 1).alias("parent"))).alias("e"))
    pairs = chain.select(F.col("e.child").alias("src"), F.col("e.parent").alias("dst")).distinct()
    both = pairs.union(pairs.select("dst", "src")).withColumn("weight", F.lit(1.0))
    return edges.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread_trust(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, mass) after some rounds of personalised PageRank.

    `seeds` has (kind, host, mass), mass summing to 1 per kind: `allow` follows
    the edges, `block` goes against them.
    """
    forward = edges.select(F.lit(ALLOW).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "weight")
    backward = edges.select(F.lit(BLOCK).alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "weight")
    flows = forward.union(backward)
    total = flows.groupBy("kind", "host").agg(F.sum("weight").alias("all"))
    flows = materialize(flows.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("weight") / F.col("all")).alias("share")), "flows")
    sources = flows.select("kind", "host").distinct()
    # mass on a host without an edge to follow stays there
    stay = seeds.select("kind", "host").join(sources, ["kind", "host"], "left_anti")
    ends = flows.select("kind", F.col("to").alias("host")).distinct().join(sources, ["kind", "host"], "left_anti")
    loops = stay.union(ends).distinct().select("kind", "host", F.col("host").alias("to"), F.lit(1.0).alias("share"))
    flows = materialize(flows.union(loops), "flows")
    seeds = materialize(seeds, "seeds")
    start = seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("mass"))
    mass = seeds
    for turn in range(1, rounds + 1):
        moved = flows.join(mass, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
        mass = moved.union(start).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if turn % 3 == 0:
            mass = materialize(mass, "mass")
    return mass


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
    family: bool = True, threshold: float = THRESHOLD, rounds: int = ROUNDS,
) -> DataFrame:
    """Per page: id, `host`, `path`, `rule`, `verdict`, and `trust` and `distrust` of the host.

    `rules` is a list, or a table as `rule_table` makes it.
    """
    parts = pages.select(F.col(id).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), F.col(html).alias("html"))
    rules = rule_table(pages.sparkSession, rules) if isinstance(rules, list) else rules
    counted = materialize(parts.where("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages")), "urls")
    hot = hot_keys(counted, ["host"])
    fitted = longest_rules(counted.select("host", "path"), rules, hot).withColumnsRenamed({"host": "_host", "path": "_path"})
    urls = materialize(
        counted.join(fitted, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left").drop("_host", "_path"), "ruled_urls"
    )
    pages_of = lambda kind: F.coalesce(F.sum(F.when(F.col("ruled") == kind, F.col("pages"))), F.lit(0)).alias(kind)
    per_host = materialize(urls.groupBy("host").agg(F.sum("pages").alias("pages"), pages_of(ALLOW), pages_of(BLOCK)), "hosts")
    pages_all, allowed, blocked = per_host.agg(F.sum("pages"), F.sum(ALLOW), F.sum(BLOCK)).first()
    seeds = None
    for kind, count in ((ALLOW, allowed), (BLOCK, blocked)):
        one = per_host.where(F.col(kind) > 0).select(F.lit(kind).alias("kind"), "host", (F.col(kind) / F.lit(count or 1)).alias("mass"))
        seeds = one if seeds is None else seeds.union(one)
    mass = spread_trust(materialize(host_edges(parts, "host", "html", family), "edges"), seeds, rounds=rounds)
    sides = mass.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == ALLOW, F.col("mass"))).alias("trust"), F.sum(F.when(F.col("kind") == BLOCK, F.col("mass"))).alias("distrust")
    )
    hosts = materialize(
        per_host.join(sides, "host", "left").na.fill(0.0, ["trust", "distrust"]).select(
            "host", "trust", "distrust",
            F.when(F.col("distrust") - F.col("trust") > threshold * F.col("pages") / F.lit(pages_all or 1), BLOCK).otherwise(ALLOW).alias("by_host"),
        ),
        "judged_hosts",
    )
    # one verdict per url, then back to the pages: a url or host may have a large share of them
    judged = salted_join(urls, hosts, ["host"], ["path"], hot).select(
        "host", "path", "rule", F.coalesce("ruled", "by_host").alias("verdict"), "trust", "distrust"
    )
    known = salted_join(parts.where("host <> ''").select("id", "host", "path"), materialize(judged, "judged_urls"), ["host", "path"], ["id"], hot_among(
        counted.withColumnRenamed("pages", "_n"), ["host", "path"]))
    nowhere = parts.where("host = ''").select(
        "id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(ALLOW).alias("verdict"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust")
    )
    return known.unionByName(nowhere).withColumnRenamed("id", id)

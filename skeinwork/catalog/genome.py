"""Reads, regions, intervals and variants, built from the order and event tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeinwork.catalog.registry import epoch, query, table
from skeinwork.functions.coords import bed_end, bed_start, region_string
from skeinwork.plans import fastq as mates
from skeinwork.plans import variants as calling
from skeinwork.sources.bed import read_bed
from skeinwork.sources.files import list_inputs, read_folder
from skeinwork.sources.sinks import write_bed, write_regions, write_vcf
from skeinwork.functions.reads import decode_quality, fix_quality, guess_quality, is_main_mapped, with_read_group
from skeinwork.operators import intervals as iv
from skeinwork.operators.numbering import global_index
from skeinwork.operators.records import interleave
from skeinwork.operators.regions import balance_regions as balanced
from skeinwork.operators.regions import chunk_apply as apply_to_chunks
from skeinwork.operators.regions import coordinate_order, range_partitioned
from skeinwork.operators.regions import region_apply as apply_to_regions
from skeinwork.operators.regions import region_apply_streams as apply_to_streams
from skeinwork.operators.skew import spread
from skeinwork.operators.variants import sorted_variants, vcf_concordance as concordance
from skeinwork.plans.variants import mark_duplicate_pairs, mark_duplicate_reads, with_fixed_quality
from skeinwork.session import materialize, scratch_path
from skeinwork.sources.dictionary import parse_dict
from skeinwork.sources.fastq import read_fastq
from skeinwork.sources.sam import parse_sam, with_reference_index
from skeinwork.sources.vcf import parse_vcf, parse_vcf_keys

REGIONS, ROWS_PER_REGION = 8, 5_000


# ---- regions and coordinate order -------------------------------------------------

PLACED = """
select l_suppkey % 26 - 1 as ref_index, epoch_us(l_shipdate) // 86400000000 as pos,
       l_orderkey, l_partkey, l_linenumber, l_extendedprice
from lineitem
"""
TIES = ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"]
ORDER = "(ref_index = -1)::int, ref_index, pos, l_orderkey, l_partkey, l_linenumber, l_extendedprice"


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 26 - 1).alias("ref_index"), epoch("DAY", F.col("l_shipdate")).alias("pos"), *TIES
    )


@query(f"with p as ({PLACED}) select *, row_number() over (order by {ORDER}) as rn from p")
def coordinate_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = global_index(_placed(spark, sf_dir), coordinate_order("ref_index", "pos", *TIES))
    return indexed.withColumn("rn", F.col("idx") + 1).drop("idx")


@query(f"with p as ({PLACED}) select *, (ntile({REGIONS}) over (order by {ORDER}) - 1)::int as region from p")
def balance_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced(_placed(spark, sf_dir), coordinate_order("ref_index", "pos", *TIES), REGIONS)


def _summary_of_region(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, ends and the number of neighbouring rows in order, over all chunks of a region."""
    last, rows, in_order = None, 0, 0
    for chunk in chunks:
        if last is None:
            region, first_pos = int(chunk["region"].iloc[0]), int(chunk["pos"].iloc[0])
        key = chunk["ref_index"].replace(-1, 1 << 20) * (1 << 32) + chunk["pos"]
        in_order += int((key.diff() >= 0).sum()) + int(last is not None and last <= key.iloc[0])
        last, last_pos, rows = key.iloc[-1], int(chunk["pos"].iloc[-1]), rows + len(chunk)
    yield pd.DataFrame(
        {"region": [region], "n": [rows], "first_pos": [first_pos], "last_pos": [last_pos], "in_order": [in_order]}
    )


def even_regions(rows: str, order: str, per_region: int) -> str:
    """SQL that numbers the rows of a table in order and cuts them into even regions of bounded size."""
    return f"""
numbered_rows as (select *, row_number() over (order by {order}) as rn, count(*) over () as total from {rows}),
sized as (select *, ceil(total / {per_region})::bigint as n from numbered_rows),
parts as (select *, total // n as small, total % n as extra from sized),
in_regions as (
  select *, (case when rn <= extra * (small + 1) then (rn - 1) // (small + 1)
             else extra + (rn - 1 - extra * (small + 1)) // small end)::int as region from parts)
"""


@query(f"""
with p as ({PLACED}), {even_regions("p", ORDER, ROWS_PER_REGION)},
r as (select * from in_regions)
select region, count(*) as n, arg_min(pos, rn) as first_pos, arg_max(pos, rn) as last_pos, count(*) - 1 as in_order
from r group by region
""")
def region_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = coordinate_order("ref_index", "pos", *TIES)
    regions = balanced(_placed(spark, sf_dir), order, rows_per_region=ROWS_PER_REGION)
    schema = "region int, n bigint, first_pos bigint, last_pos bigint, in_order bigint"
    return apply_to_regions(regions, "region", order, _summary_of_region, schema)


def _covered_reads(targets: Iterator[pa.RecordBatch], reads: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads of a region, and how many begin in one of its targets, which are held as two sorted arrays."""
    held = [(b.column("low").to_numpy(), b.column("high").to_numpy()) for b in targets]
    low, high = (np.sort(np.concatenate([h[i] for h in held])) if held else np.zeros(0, np.int64) for i in (0, 1))
    rows = inside = price = 0
    for batch in reads:
        pos = batch.column("pos").to_numpy()
        # more targets begin at or before a position than end before it
        within = np.searchsorted(low, pos, "right") > np.searchsorted(high, pos, "left")
        rows, inside = rows + len(pos), inside + int(within.sum())
        price += int(np.floor(batch.column("l_extendedprice").to_numpy()[within]).sum())
    yield pa.RecordBatch.from_pydict({"targets": [len(low)], "reads": [rows], "inside": [inside], "price": [price]})


@query(f"""
with p as ({PLACED}),
r as (select *, (ntile({REGIONS}) over (order by {ORDER}) - 1)::int as region from p where l_linenumber < 6),
t as (select (p_partkey % {REGIONS + 2})::int as region, 8000 + p_partkey * 13 % 3000 as low, 8000 + p_partkey * 13 % 3000 + 2 as high from part),
marked as (select region, floor(l_extendedprice)::bigint as price, exists (select 1 from t where t.region = r.region and pos between low and high) as inside from r),
counted as (select region, count(*) as reads, count(*) filter (inside) as inside, coalesce(sum(price) filter (inside), 0)::bigint as price from marked group by region)
select coalesce(a.targets, 0) as targets, coalesce(reads, 0) as reads, coalesce(inside, 0) as inside, coalesce(price, 0) as price
from (select region, count(*) as targets from t group by region) a full join counted using (region)
""")
def region_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables per region as sorted streams; two regions have targets only."""
    placed = _placed(spark, sf_dir).where("l_linenumber < 6")
    reads = balanced(placed, coordinate_order("ref_index", "pos", *TIES), REGIONS).select("region", "ref_index", "pos", "l_extendedprice")
    key = F.col("p_partkey")
    low = 8000 + key * 13 % 3000
    targets = table(spark, sf_dir, "part").select((key % (REGIONS + 2)).cast("int").alias("region"), low.alias("low"), (low + 2).alias("high"))
    schema = "targets bigint, reads bigint, inside bigint, price bigint"
    return apply_to_streams(reads, targets, "region", ["ref_index", "pos"], ["low"], _covered_reads, schema)


def _reversed_names(chunk: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"p_partkey": chunk["p_partkey"], "name": chunk["p_name"].str[::-1]})


@query("select p_partkey, reverse(p_name) as name from part")
def chunk_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return apply_to_chunks(parts, _reversed_names, "p_partkey bigint, name string")


BLOCK_ROWS = 100_000


@query("""
select count(*) as rows, sum(l_partkey)::bigint as total, 6::bigint as parts, true as in_order from lineitem
""")
def range_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted partitions that hold one range of the key each: none begins before the one before it has ended, rows inside are in order."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    ranged = range_partitioned(lines, 6, "l_partkey", "l_orderkey", "l_linenumber").withColumns(
        {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
    )
    # a partition is looked at in blocks of rows that follow each other: no task sorts all of it again
    block = F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK_ROWS).alias("block")
    ranged = materialize(ranged, "ranges").select("*", block)
    before = Window.partitionBy("part", "block").orderBy("at")
    key = F.struct("l_partkey", "l_orderkey", "l_linenumber")
    steps = ranged.withColumn("ok", F.coalesce(F.lag(key).over(before) <= key, F.lit(True)))
    blocks = steps.groupBy("part", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("s"), F.min(key).alias("low"), F.max(key).alias("high"), F.bool_and("ok").alias("ok")
    )
    # a row per block
    in_turn = F.coalesce(F.lag("high").over(Window.partitionBy(F.lit(0)).orderBy("part", "block")) <= F.col("low"), F.lit(True))
    return blocks.withColumn("ok", F.col("ok") & in_turn).agg(
        F.sum("n").alias("rows"), F.sum("s").alias("total"), F.count_distinct("part").alias("parts"), F.bool_and("ok").alias("in_order")
    )


# ---- intervals --------------------------------------------------------------------

EVENTS = """
ev as (
  select event_type as chrom, epoch_us(ts) // 60000000 as "start", epoch_us(ts) // 60000000 + ceil(value)::bigint as "end"
  from events)
"""
ISLANDS = f"""
{EVENTS},
flagged as (
  select *, "start" > max("end") over (partition by chrom order by "start", "end"
                                       rows between unbounded preceding and 1 preceding) + {iv.READ_GAP} as gap from ev),
numbered as (
  select *, sum(case when gap then 1 else 0 end) over (partition by chrom order by "start", "end") as island from flagged),
islands as (select chrom, min("start") as "start", max("end") as "end" from numbered group by chrom, island)
"""


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = epoch("MINUTE", F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("chrom"), start.alias("start"), (start + F.ceil("value").cast("bigint")).alias("end"), "value"
    )


@query(f"with {ISLANDS} select * from islands")
def coverage_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.coverage_islands(_intervals(spark, sf_dir))


@query("""
with ev as (
  select case when value > 50 then upper(event_type) else event_type end as name, event_type as chrom,
         epoch_us(ts) // 60000000 as "start", epoch_us(ts) // 60000000 + ceil(value)::bigint as "end"
  from events),
flagged as (
  select *, "start" - 5 >= max("end") over (partition by chrom order by "start", "end"
                                            rows between unbounded preceding and 1 preceding) as gap from ev),
numbered as (
  select *, sum(case when gap then 1 else 0 end) over (partition by chrom order by "start", "end") as island from flagged),
merged as (
  select chrom, min("start") as s, max("end") as "end" from numbered group by chrom, island)
select (select min(name) from ev where ev.chrom = merged.chrom and ev."start" = merged.s) as chrom,
       greatest(s - 5, 1) as "start", "end" from merged
""")
def merge_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("value") > 50, F.upper("chrom")).otherwise(F.col("chrom"))
    return iv.merge_intervals(_intervals(spark, sf_dir).withColumn("chrom", mixed), 5)


@query(f"""
with {ISLANDS}
select chrom || ':' || "start" || '-' || "end" as region, "start" - 1 as bed_start, "end" as bed_end, "end" - 1 as short_end
from islands
""")
def region_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    islands = iv.coverage_islands(_intervals(spark, sf_dir))
    start, end = F.col("start"), F.col("end")
    return islands.select(
        region_string(F.col("chrom"), start, end).alias("region"),
        bed_start(start).alias("bed_start"),
        bed_end(end).alias("bed_end"),
        bed_end(end, half_open=False).alias("short_end"),
    )


@query("""
with ev as (
  select event_type as chrom, user_id, event_id, epoch_us(ts) // 60000000 as "start",
         epoch_us(ts) // 60000000 + ceil(value)::bigint as "end" from events)
select user_id, count(*) as n, arg_min(chrom, event_id) as first_chrom, arg_min("start", event_id) as first_start,
       arg_max("end", event_id) as last_end,
       count(*) || 'regions_' || arg_min(chrom, event_id) || '-' || arg_min("start", event_id) as label
from ev group by user_id
""")
def range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = epoch("MINUTE", F.col("ts"))
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("chrom"), "user_id", "event_id", start.alias("start"),
        (start + F.ceil("value").cast("bigint")).alias("end"),
    )
    return iv.range_summary(rows, ["user_id"], ["event_id"])


@query(f"""
with {ISLANDS}
select 'all' as chrom, ev.chrom as kind, greatest(ev."start", i."start") as "start", least(ev."end", i."end") as "end"
from ev join islands i on ev."start" < i."end" and i."start" < ev."end"
""")
def interval_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _intervals(spark, sf_dir).drop("value")
    islands = materialize(iv.coverage_islands(events).withColumn("chrom", F.lit("all")), "islands")
    a = events.select(F.lit("all").alias("chrom"), F.col("chrom").alias("kind"), "start", "end")
    return iv.interval_intersect(a, islands, bin_width=240)


@query("""
with a as (
  select event_type as chrom, event_id, epoch_us(ts) // 1000000 as "start",
         epoch_us(ts) // 1000000 + case when event_id % 400 = 0 then 10000000 when event_id % 11 = 0 then 5000 else 1 end as "end" from events),
b as (
  select event_type as chrom, epoch_us(ts) // 1000000 + 777 as "start",
         epoch_us(ts) // 1000000 + 777 + case when event_id % 300 = 0 then 10000000 when event_id % 7 = 0 then 0 else 60 end as "end" from events
  where event_id % 5 = 0)
select a.event_id, count(*) as overlaps, sum(least(a."end", b."end") - greatest(a."start", b."start"))::bigint as shared,
       min(greatest(a."start", b."start")) as first_start
from a join b on a.chrom = b.chrom and a."start" < b."end" and b."start" < a."end" group by a.event_id
""")
def mixed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of intervals whose lengths go from 0 and 1 to 10,000,000."""
    second, n = epoch("SECOND", F.col("ts")), F.col("event_id")
    events = table(spark, sf_dir, "events")
    length = F.when(n % 400 == 0, F.lit(10_000_000)).when(n % 11 == 0, F.lit(5_000)).otherwise(F.lit(1))
    a = events.select(F.col("event_type").alias("chrom"), "event_id", second.alias("start"), (second + length).alias("end"))
    other = F.when(n % 300 == 0, F.lit(10_000_000)).when(n % 7 == 0, F.lit(0)).otherwise(F.lit(60))
    b = events.where(n % 5 == 0).select(F.col("event_type").alias("chrom"), (second + 777).alias("start"), (second + 777 + other).alias("end"))
    found = iv.interval_intersect(a, b, bin_width=64)
    return found.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("overlaps"), F.sum(F.col("end") - F.col("start")).alias("shared"), F.min("start").alias("first_start")
    )


# ---- reads ------------------------------------------------------------------------

@query("""
select l_orderkey, l_partkey, l_linenumber as flag, l_suppkey % 30 as ref_index, 'GROUP1' as rgid, 'LIB1' as rglb,
       'ILLUMINA' as rgpl, 'UNITI' as rgpu, 'SAMPLE1' as rgsm
from lineitem where l_linenumber & 4 = 0 and l_suppkey % 30 between 1 and 24
""")
def read_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").alias("flag"), (F.col("l_suppkey") % 30).alias("ref_index")
    )
    return with_read_group(reads.where(is_main_mapped(F.col("flag"), F.col("ref_index"))))


QUALS = """
texts as (
  select p_partkey, p_size, case when p_partkey % 13 = 0 then null when p_partkey % 17 = 0 then '*' when p_partkey % 19 = 0 then '!~'
                                 when p_size > 25 then upper(p_name) else replace(p_name, ' ', '~') end as qual from part),
decoded as (select *, case when qual <> '*' then [(ascii(c) - 33)::bigint for c in string_split(qual, '')] end as quals from texts),
guessed as (select *, case when list_max(quals) <= 60 then 'SANGER' when list_max(quals) > 60 then 'ILLUMINA' end as encoding from decoded)
"""


def _qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit("~")))
    odd = lambda n: F.col("p_partkey") % n == 0
    text = F.when(odd(13), F.lit(None)).when(odd(17), F.lit("*")).when(odd(19), F.lit("!~")).otherwise(text)
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", decode_quality(text).alias("quals"))


def _total(quals):
    return F.aggregate(quals, F.lit(0).cast("bigint"), lambda total, q: total + q)


@query(f"""
with {QUALS}
select p_partkey, encoding, list_sum(quals)::bigint as total,
       case when list_min(quals) >= 31 then list_sum(quals)::bigint - 31 * len(quals) end as fixed_total
from guessed
""")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _qualities(spark, sf_dir)
    return q.select(
        "p_partkey",
        guess_quality(F.col("quals")).alias("encoding"),
        _total(F.col("quals")).alias("total"),
        _total(fix_quality(F.col("quals"), on_error="null")).alias("fixed_total"),
    )


@query(f"""
with {QUALS},
first as (select p_size, arg_min(encoding, p_partkey) as encoding from guessed where encoding is not null group by p_size)
select p_partkey, p_size as region, first.encoding,
       case when first.encoding = 'ILLUMINA' then case when list_min(quals) >= 31 then list_sum(quals)::bigint - 31 * len(quals) end
            else list_sum(quals)::bigint end as total
from decoded left join first using (p_size)
""")
def region_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _qualities(spark, sf_dir).withColumnRenamed("p_size", "region")
    fixed = with_fixed_quality(reads, "region", ["p_partkey"], on_error="null")
    return fixed.select("p_partkey", "region", "encoding", _total(F.col("quals")).alias("total"))


def _sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    whole = lambda c: F.col(c).cast("bigint").cast("string")
    return spread(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws(
            "\t", s("l_orderkey"), s("l_linenumber"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 26).cast("string")),
            s("l_partkey"), F.lit("60"),
            F.when(F.col("l_linenumber") == 2, F.lit("*")).otherwise(F.concat(s("l_linenumber"), F.lit("S"), whole("l_quantity"), F.lit("M2I3D4M"))),
            F.lit("="), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.when(F.col("l_linenumber") == 3, F.lit("*")).otherwise(F.lit("IIII")), F.lit("NM:i:0"), F.lit("RG:Z:GROUP1"),
        ).alias("value")
    )


def _dict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.when(F.col("n_regionkey") == 0, F.lit("unknown")).otherwise((F.col("n_regionkey") * 100).cast("string"))
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("position"),
        F.concat(F.lit("@SQ\tSN:chr"), F.col("n_nationkey").cast("string"), F.lit("\tLN:"), length, F.lit("\tUR:x")).alias("value"),
    )


@query("""
select (row_number() over (order by n_nationkey) - 1)::int as ref_index, 'chr' || n_nationkey as name,
       (n_regionkey * 100)::bigint as length from nation
""")
def dict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dict(_dict_lines(spark, sf_dir))


@query("""
select l_orderkey::varchar as qname, l_linenumber as flag, 'chr' || (l_suppkey % 26) as rname, l_partkey as pos,
       case when l_linenumber <> 2 then l_partkey + l_quantity::bigint + 7 - 1 end as end_pos, 2::int as n_tags,
       case when l_linenumber <> 3 then 160::bigint end as quality_sum,
       case when l_suppkey % 26 < 25 then l_suppkey % 26 else -1 end::int as ref_index
from lineitem
""")
def sam_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = parse_sam(_sam_lines(spark, sf_dir))
    reads = with_reference_index(reads, parse_dict(_dict_lines(spark, sf_dir)))
    return reads.select(
        "qname", "flag", "rname", "pos", "end_pos", F.size("tags").alias("n_tags"),
        _total(F.col("quals")).alias("quality_sum"), "ref_index",
    )


@query("""
with r as (
  select event_id, event_type, value > 20 as reverse, user_id % 10 = 3 as unmapped, epoch_us(ts) // 86400000000 as pos,
         epoch_us(ts) // 86400000000 + floor(value)::bigint as end_pos,
         case when event_id % 11 <> 0 then floor(value)::bigint end as score from events)
select event_id, not unmapped and row_number() over (
         partition by unmapped, event_type, reverse, case when reverse then end_pos else pos end order by score desc nulls last, event_id) > 1 as is_duplicate
from r
""")
def duplicate_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, whole = epoch("DAY", F.col("ts")), F.floor("value").cast("bigint")
    reads = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("ref_index"),
        F.when(F.col("user_id") % 10 == 3, F.lit(4)).when(F.col("value") > 20, F.lit(16)).otherwise(F.lit(0)).alias("flag"),
        day.alias("pos"),
        (day + whole).alias("end_pos"),
        F.when(F.col("event_id") % 11 != 0, F.array(whole)).alias("quals"),
    )
    return mark_duplicate_reads(reads, "event_id").select("event_id", "is_duplicate")


@query("""
with raw as (
  select (((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 100 + l_quantity::bigint as read_id,
         'q' || l_orderkey || '/' || (l_linenumber + 1) // 2 as qname, l_linenumber % 2 = 1 as first, l_tax > 0.04 as reverse,
         l_quantity = 7 as unmapped, l_quantity = 9 as other, l_linenumber = 7 as alone, l_suppkey % 3 as ref, l_partkey % 40 + 100 as pos,
         l_quantity::bigint % 4 as head, l_partkey % 3 as tail, l_quantity::bigint as score
  from lineitem),
ends as (
  select *, case when reverse then pos + 30 + 5 - 1 + tail else pos - head end as five from raw where not unmapped and not other),
named as (
  select qname, count(*) as n, count(*) filter (first and not alone) as firsts, count(*) filter (not first and not alone) as seconds, sum(score) as score,
         list_sort(list((ref, five, reverse))) as key from ends group by qname),
pairs as (select * from named where n = 2 and firsts = 1 and seconds = 1),
kept_pairs as (select qname, row_number() over (partition by key order by score desc, qname) > 1 as lost from pairs),
taken as (select distinct unnest(key) as e from pairs),
singles as (select * from ends where qname not in (select qname from pairs)),
kept_singles as (
  select read_id, row_number() over (partition by ref, five, reverse order by score desc, read_id) > 1
                  or (ref, five, reverse) in (select e from taken) as lost from singles)
select raw.read_id, coalesce(s.lost, p.lost and not raw.unmapped and not raw.other, false) as is_duplicate
from raw left join kept_singles s using (read_id) left join kept_pairs p on p.qname = raw.qname
""")
def duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates over mates: clipped ends, both strands, names with more reads than a pair has, single reads next to pairs."""
    n, whole = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    bit = lambda condition, value: F.when(condition, F.lit(value)).otherwise(F.lit(0))
    alone = n == 7
    flag = (
        bit(~alone, 1) + bit(~alone & (n % 2 == 1), 64) + bit(~alone & (n % 2 == 0), 128) + bit(F.col("l_tax") > 0.04, 16)
        + bit(F.col("l_quantity") == 7, 4) + bit(F.col("l_quantity") == 9, 256)
    )
    part = lambda length, op: F.when(length > 0, F.concat(length.cast("string"), F.lit(op))).otherwise(F.lit(""))
    reads = table(spark, sf_dir, "lineitem").select(
        ((((F.col("l_orderkey") * 8 + n) * 100000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey")) * 100 + whole).alias("read_id"),
        F.concat(F.lit("q"), F.col("l_orderkey").cast("string"), F.lit("/"), F.floor((n + 1) / 2).cast("string")).alias("qname"),
        flag.alias("flag"), (F.col("l_suppkey") % 3).alias("ref_index"), (F.col("l_partkey") % 40 + 100).alias("pos"),
        F.concat(part(whole % 4, "S"), F.lit("30M2I5D"), part(F.col("l_partkey") % 3, "H")).alias("cigar"), F.array(whole).alias("quals"),
    )
    return mark_duplicate_pairs(reads, "read_id").select("read_id", "is_duplicate")


# ---- FASTQ ------------------------------------------------------------------------

@query("""
with lines as (
  select c_custkey as rec, 1 as mate, '@' || c_name || chr(10) || c_mktsegment || chr(10) || '+' || chr(10) || c_nationkey as r from customer
  union all
  select s_suppkey, 2, '@' || s_name || chr(10) || 'ACGT' || chr(10) || '+' || chr(10) || s_nationkey from supplier)
select rec, string_agg(r, chr(10) order by mate) as record from lines group by rec
""")
def interleave_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    def four_lines(df: DataFrame, rec: str, name: str, second, last: str) -> DataFrame:
        lines = F.array(F.concat(F.lit("@"), name), second, F.lit("+"), F.col(last).cast("string"))
        return df.select(F.col(rec).alias("rec"), F.posexplode(lines).alias("line_no", "line"))

    mate1 = four_lines(table(spark, sf_dir, "customer"), "c_custkey", "c_name", F.col("c_mktsegment"), "c_nationkey")
    mate2 = four_lines(table(spark, sf_dir, "supplier"), "s_suppkey", "s_name", F.lit("ACGT"), "s_nationkey")
    return interleave(mate1, mate2)


@query("""
select '@' || o_orderkey || '|' || o_orderpriority || '|+|@' || o_custkey as record, 4::int as n_lines from orders
""")
def fastq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as FASTQ text to the shared folder and read back by line number."""
    text = F.concat(
        F.lit("@"), F.col("o_orderkey").cast("string"), F.lit("\n"), "o_orderpriority", F.lit("\n+\n@"), F.col("o_custkey").cast("string")
    )
    path = scratch_path(spark, "fastq")
    table(spark, sf_dir, "orders").select(text.alias("value")).write.text(path)
    return read_fastq(spark, path).select(F.array_join("lines", "|").alias("record"), F.size("lines").alias("n_lines"))


# ---- variants ---------------------------------------------------------------------

VCF = """
vcf as (
  select case l_suppkey % 30 when 0 then 'chrM' when 23 then 'chrX' when 24 then 'chrY' when 25 then 'HLA' when 26 then 'chr1234567890abc'
                             when 27 then 'chr99' when 28 then 'chr99999999999' when 29 then 'chr0' else 'chr' || (l_suppkey % 30) end as chrom,
         case l_suppkey % 30 when 0 then null when 25 then null when 26 then null when 27 then 99 when 28 then null when 29 then 0
                             else l_suppkey % 30 end::int as chrom_no,
         l_partkey as pos, l_orderkey || ':' || l_linenumber as id, l_returnflag as ref, l_linestatus as alt,
         l_discount
  from lineitem),
lines as (
  select *, chrom || chr(9) || pos || chr(9) || id || chr(9) || ref || chr(9) || alt || chr(9) || '.' as line from vcf)
"""


def _vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_suppkey") % 30
    chrom = (
        F.when(n == 0, F.lit("chrM")).when(n == 23, F.lit("chrX")).when(n == 24, F.lit("chrY")).when(n == 25, F.lit("HLA"))
        .when(n == 26, F.lit("chr1234567890abc")).when(n == 27, F.lit("chr99")).when(n == 28, F.lit("chr99999999999")).when(n == 29, F.lit("chr0"))
        .otherwise(F.concat(F.lit("chr"), n.cast("string")))
    )
    line = F.concat_ws(
        "\t", chrom, F.col("l_partkey").cast("string"), F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "l_returnflag", "l_linestatus", F.lit("."),
    )
    return spread(table(spark, sf_dir, "lineitem")).select(line.alias("value"), "l_discount")


@query(f"with {VCF} select chrom, chrom_no, pos, id, ref, alt, line from lines where chrom <> 'HLA'")
def variant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_variants(parse_vcf(_vcf_lines(spark, sf_dir)))


@query(f"""
with {VCF}
select row_number() over (order by chrom_no, pos, line) as rn, line from lines where chrom_no is not null
""")
def variant_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = parse_vcf(_vcf_lines(spark, sf_dir), on_error="drop")      # global_index keeps the rows
    return global_index(variants.select("chrom_no", "pos", "line"), ["chrom_no", "pos", "line"]).select((F.col("idx") + 1).alias("rn"), "line")


@query(f"""
with {VCF},
a as (select distinct chrom, pos, ref, alt from lines where l_discount <= 0.05 and chrom like 'chr%'),
b as (select distinct chrom, pos, ref, alt from lines where l_discount >= 0.05 and chrom like 'chr%')
select count(*) as total, count(b.chrom) as matches, count(*) - count(b.chrom) as diff
from a left join b using (chrom, pos, ref, alt)
""")
def vcf_concordance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = materialize(_vcf_lines(spark, sf_dir), "vcf")
    return concordance(
        parse_vcf_keys(lines.where("l_discount <= 0.05")), parse_vcf_keys(lines.where("l_discount >= 0.05"))
    )


# ---- files written and read back -----------------------------------------------------

@query("""
select '@' || o_orderkey || '/1|' || o_orderpriority || '|+|@' || o_custkey || '|@' || o_orderkey || '/2|ACGT|+|IIII' as record from orders
""")
def interleave_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two mates, each two folders of FASTQ files, interleaved into gzip chunks that are read back."""
    path = scratch_path(spark, "mates")
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    mate = {
        1: F.concat(F.lit("@"), key, F.lit("/1\n"), "o_orderpriority", F.lit("\n+\n@"), F.col("o_custkey").cast("string")),
        2: F.concat(F.lit("@"), key, F.lit("/2\nACGT\n+\nIIII")),
    }
    for lane in (0, 1):
        for k, text in mate.items():
            orders.where(F.col("o_orderkey") % 2 == lane).select(text.alias("value")).write.text(f"{path}/mate{k}/lane{lane}")
    mates.run(spark, f"{path}/mate1/*", f"{path}/mate2/*", f"{path}/chunks", 5)
    # mates are neighbours in a chunk
    reads = read_fastq(spark, f"{path}/chunks").withColumn("pair", F.floor(F.col("rec") / 2))
    both = F.transform(F.sort_array(F.collect_list(F.struct("rec", "lines"))), lambda x: F.array_join(x["lines"], "|"))
    return reads.groupBy("file", "pair").agg(F.array_join(both, "|").alias("record")).select("record")


CHUNKS = 7


@query(f"""
with pairs as (
  select '@' || p_partkey || '/1|' || p_name || '|+|' || p_brand || '|@' || p_partkey || '/2|ACGT|+|@III' as record, row_number() over (order by p_partkey) as i
  from part),
chunks as (select *, ntile({CHUNKS}) over (order by i) - 1 as c from pairs)
select 'Chunks_' || c || '.fq.gz' as name, i - min(i) over (partition by c) as position, record from chunks
""")
def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the chunks, their number, and the records of each in order."""
    path, key = scratch_path(spark, "chunks"), F.col("p_partkey").cast("string")
    parts = table(spark, sf_dir, "part").orderBy("p_partkey")
    one = F.concat(F.lit("@"), key, F.lit("/1\n"), "p_name", F.lit("\n+\n"), "p_brand")
    two = F.concat(F.lit("@"), key, F.lit("/2\nACGT\n+\n@III"))
    for mate, text in (("one", one), ("two", two)):
        parts.select(text.alias("value")).coalesce(1).write.text(f"{path}/{mate}")
    mates.run(spark, f"{path}/one", f"{path}/two", f"{path}/out", CHUNKS)
    reads = read_fastq(spark, f"{path}/out").withColumn("position", F.floor(F.col("rec") / 2))
    both = F.transform(F.sort_array(F.collect_list(F.struct("rec", "lines"))), lambda x: F.array_join(x["lines"], "|"))
    return reads.groupBy(F.element_at(F.split("file", "/"), -1).alias("name"), "position").agg(F.array_join(both, "|").alias("record"))


@query(f"""
with {ISLANDS} select chrom, "start" - 1 as "start", "end", chrom || ':' || "start" || '-' || "end" as region from islands
""")
def bed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Islands as a BED file and as region strings, both read back."""
    path = scratch_path(spark, "bed")
    islands = materialize(iv.coverage_islands(_intervals(spark, sf_dir)), "islands")
    write_bed(islands, f"{path}/bed")
    write_regions(islands, f"{path}/regions")
    bed = read_bed(spark, f"{path}/bed").drop("rest")
    named = F.concat("chrom", F.lit(":"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string"))
    regions = spark.read.text(f"{path}/regions").withColumnRenamed("value", "region")
    return bed.withColumn("region", named).join(regions, "region").select("chrom", "start", "end", "region")


@query("""
select n_regionkey::varchar as folder, n_name as value, (select count(*) from region)::bigint as folders,
       sum(length(n_name) + 1) over ()::bigint as bytes from nation
""")
def folder_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in one folder per region, read as one data set; the size of all files."""
    path = scratch_path(spark, "folder")
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), "n_regionkey").write.partitionBy("n_regionkey").text(path)
    found = read_folder(spark, f"{path}/*", "*.txt").select(
        F.regexp_extract("file_path", r"n_regionkey=(\d+)", 1).alias("folder"), "value"
    )
    sizes = list_inputs(spark, f"{path}/*", "*.txt").agg(F.sum("length").alias("bytes")).first()["bytes"]
    folders = found.select("folder").distinct().count()
    return found.withColumns({"folders": F.lit(folders).cast("bigint"), "bytes": F.lit(sizes).cast("bigint")})


@query(f"""
with {VCF}
select line from lines where chrom like 'chr%' and l_discount < 0.02
union all select concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', 'sample')
""")
def vcf_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A VCF table written with its column line, and all its lines."""
    path = scratch_path(spark, "vcf_file")
    write_vcf(parse_vcf(_vcf_lines(spark, sf_dir).where("l_discount < 0.02")), path, sample="sample")
    return spark.read.text(path).withColumnRenamed("value", "line")


# ---- the whole job ---------------------------------------------------------------------

def _call(reads: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
    """A line per target of the region that reads begin in; duplicates do not count."""
    lines, kept = [], reads[~reads["is_duplicate"]]
    for chrom, own in targets.groupby("chrom"):
        pos = kept.loc[kept["rname"] == chrom, "pos"].sort_values()
        counts = pos.searchsorted(own["end"], "right") - pos.searchsorted(own["start"], "right")
        for start, end, n in zip(own["start"], own["end"], counts):
            if n:
                lines.append(f"{chrom}\t{start + 1}\t{n}\tA\tC\t{reads['rgsm'].iloc[0]}\t.\tEND={end}")
    return pd.DataFrame({"value": lines}, dtype=object)


@query(f"""
with raw as (
  select (((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 100 + l_quantity::bigint as read_id, case when l_linenumber = 4 then 4 when l_tax > 0.04 then 16 else 0 end as flag,
         l_suppkey % 28 as ref_index, 'chr' || (l_suppkey % 28) as rname,
         epoch_us(l_shipdate) // 86400000000 * 4 + l_partkey % 4 as pos, l_quantity::bigint as quantity
  from lineitem),
reads as (select *, pos + quantity as end_pos from raw where flag & 4 = 0 and ref_index between 1 and 24),
marked as (
  select *, row_number() over (partition by ref_index, flag, case when flag = 16 then end_pos else pos end
                               order by quantity desc, read_id) > 1 as is_duplicate from reads),
{even_regions("marked", "ref_index, pos, read_id", ROWS_PER_REGION)},
flagged as (
  select region, rname, pos, end_pos, pos > max(end_pos) over (partition by region, rname order by pos, end_pos
                                      rows between unbounded preceding and 1 preceding) + {iv.READ_GAP} as gap from in_regions),
islands as (
  select region, rname, min(pos) as "start", max(end_pos) as "end" from (
    select *, sum(case when gap then 1 else 0 end) over (partition by region, rname order by pos, end_pos) as island from flagged)
  group by region, rname, island),
targets as (select 'chr' || (p_partkey % 22 + 1) as chrom, 34000 + p_partkey * 7 % 9000 as "start", 34000 + p_partkey * 7 % 9000 + 25 as "end" from part),
own as (
  select region, chrom, greatest(i."start" - 1, t."start") as "start", least(i."end", t."end") as "end"
  from islands i join targets t on t.chrom = i.rname and i."start" - 1 < t."end" and t."start" < i."end"),
called as (
  select own.chrom, own."start", own."end", own.region, count(*) as n
  from own join in_regions r on r.region = own.region and r.rname = own.chrom and not r.is_duplicate and r.pos > own."start" and r.pos <= own."end"
  group by all),
-- equal targets give equal lines, once each
times as (select region, chrom, "start", "end", count(*) as k from own group by all)
select chrom, substr(chrom, 4)::int as chrom_no, "start" + 1 as pos, n::varchar as id, 'A' as ref, 'C' as alt,
       chrom || chr(9) || ("start" + 1) || chr(9) || n || chr(9) || 'A' || chr(9) || 'C' || chr(9) || 'SAMPLE1' || chr(9) || '.' || chr(9) || 'END=' || "end" as line
from (select chrom, "start", "end", region, n // k as n, unnest(range(k)) from called join times using (region, chrom, "start", "end"))
""")
def call_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, duplicates, regions, covered and target intervals, caller, one ordered table."""
    day, index = epoch("DAY", F.col("l_shipdate")), F.col("l_suppkey") % 28
    quantity = F.col("l_quantity").cast("bigint")
    flag = F.when(F.col("l_linenumber") == 4, F.lit(4)).when(F.col("l_tax") > 0.04, F.lit(16)).otherwise(F.lit(0))
    reads = table(spark, sf_dir, "lineitem").select(
        ((((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey")) * 100 + quantity).alias("read_id"), flag.alias("flag"), index.alias("ref_index"),
        F.concat(F.lit("chr"), index.cast("string")).alias("rname"), (day * 4 + F.col("l_partkey") % 4).alias("pos"),
        (day * 4 + F.col("l_partkey") % 4 + quantity).alias("end_pos"), F.array(quantity).alias("quals"),
    )
    start = 34000 + F.col("p_partkey") * 7 % 9000
    targets = table(spark, sf_dir, "part").select(
        F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string")).alias("chrom"), start.alias("start"), (start + 25).alias("end")
    )
    return calling.call_variants(reads, targets, _call, rows_per_region=ROWS_PER_REGION)

"""From aligned reads through even regions to one ordered variant table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions.reads import (
    FIRST_FLAG,
    OTHER_FLAGS,
    PAIRED_FLAG,
    REVERSE_FLAG,
    SECOND_FLAG,
    UNMAPPED_FLAG,
    fix_quality,
    five_prime,
    guess_quality,
    is_main_mapped,
    with_read_group,
)
from skeinwork.operators.duplicates import mark_duplicates
from skeinwork.operators.intervals import coverage_islands, interval_intersect
from skeinwork.operators.regions import balance_regions, region_apply_with
from skeinwork.operators.skew import hot_keys, salted_join
from skeinwork.operators.variants import sorted_variants, vcf_concordance
from skeinwork.session import materialize
from skeinwork.sources.sinks import write_vcf
from skeinwork.sources.vcf import parse_vcf, read_vcf_keys


def with_fixed_quality(reads: DataFrame, region: str, order: list, on_error: str = "fail") -> DataFrame:
    """Encoding of a region is guessed from its first read with qualities and applied to all its reads.

    One short row per region is computed by a combined minimum and written, so
    Spark broadcasts those rows while their bytes allow it.
    `on_error="null"` drops qualities below the range instead of failing.
    """
    guessed = guess_quality(F.col("quals"))
    first = materialize(
        reads.where(guessed.isNotNull()).groupBy(region).agg(F.min_by(guessed, F.struct(*order)).alias("encoding")), "encodings"
    )
    quals = F.when(F.col("encoding") == "ILLUMINA", fix_quality(F.col("quals"), on_error)).otherwise(F.col("quals"))
    return reads.join(first, region, "left").withColumn("quals", quals)


def mark_duplicate_reads(reads: DataFrame, id: str) -> DataFrame:
    """Reads with the same reference, 5' position and strand; the best sum of qualities stays.

    Unmapped reads have no position: none of them is a duplicate.
    """
    unmapped = F.col("flag").bitwiseAND(F.lit(UNMAPPED_FLAG)) != 0
    reverse = F.col("flag").bitwiseAND(F.lit(16)) != 0
    quality = F.aggregate("quals", F.lit(0).cast("bigint"), lambda total, q: total + q)
    keyed = reads.where(~unmapped).withColumns(
        {"_reverse": reverse, "_five_prime": F.when(reverse, F.col("end_pos")).otherwise(F.col("pos")), "_score": quality}
    )
    marked = mark_duplicates(keyed, ["ref_index", "_five_prime", "_reverse"], "_score", id).drop("_reverse", "_five_prime", "_score")
    return marked.unionByName(reads.where(unmapped).withColumn("is_duplicate", F.lit(False)))


def mark_duplicate_pairs(reads: DataFrame, id: str) -> DataFrame:
    """Duplicates among pairs of mates, and among reads without a mapped mate.

    Needs qname, flag, ref_index, pos, cigar and quals, and a unique `id`. Two
    mapped primary reads of one name, the first and the second of a pair, are a
    pair; its key are both 5' ends (reference, position before clipping, strand),
    whatever their order. The pair with the best sum of qualities stays, of equal
    ones that with the smallest name. Any other mapped primary read is single:
    it is a duplicate where a pair has an end at its own, else all but the best
    single one are. A name with more than two reads is no pair. Unmapped,
    secondary and supplementary reads, and reads without a CIGAR, are never
    duplicates.

    Mates meet in an aggregation by name that keeps one end of either mate; the
    winners of a key are combined minima, so no key's rows come together in one task.
    """
    has = lambda bits: F.col("flag").bitwiseAND(F.lit(bits)) != 0
    end = F.struct(F.col("ref_index").alias("ref"), "_five_prime", has(REVERSE_FLAG).alias("reverse"))
    quality = F.coalesce(F.aggregate("quals", F.lit(0).cast("bigint"), lambda total, q: total + q), F.lit(0).cast("bigint"))
    placed = F.when(~has(UNMAPPED_FLAG) & ~has(OTHER_FLAGS), five_prime(F.col("flag"), F.col("pos"), F.col("cigar")))
    ends = materialize(
        reads.withColumn("_five_prime", placed).where("_five_prime is not null").select(
            F.col(id).alias("_id"), F.col("qname").alias("_name"), end.alias("_end"), quality.alias("_score"),
            F.when(has(PAIRED_FLAG), F.when(has(FIRST_FLAG) & ~has(SECOND_FLAG), 1).when(has(SECOND_FLAG) & ~has(FIRST_FLAG), 2)).alias("_mate"),
        ),
        "read_ends",
    )
    mate = lambda n, what: F.min(F.when(F.col("_mate") == n, F.col(what)))
    named = ends.where("_name is not null").groupBy("_name").agg(
        F.count(F.lit(1)).alias("_reads"), F.array_sort(F.array(mate(1, "_end"), mate(2, "_end"))).alias("_ends"),
        F.count_if(F.col("_mate") == 1).alias("_firsts"), F.count_if(F.col("_mate") == 2).alias("_seconds"), F.sum("_score").alias("_score"),
    )
    pairs = materialize(named.where("_reads = 2 and _firsts = 1 and _seconds = 1").select("_name", "_ends", "_score"), "read_pairs")
    best = lambda name: F.min(F.struct((-F.col("_score")).alias("s"), F.col(name).alias("n")))["n"]
    winners = pairs.groupBy("_ends").agg(best("_name").alias("_name")).select("_name", F.lit(True).alias("_kept"))
    marked = materialize(pairs.select("_name").join(winners, "_name", "left").select("_name", F.col("_kept").isNull().alias("_second_best")), "marked_pairs")
    # a name may have any number of reads that are no pair
    hot = hot_keys(ends, ["_name"])
    paired = materialize(salted_join(ends.select("_id", "_name"), marked, ["_name"], ["_id"], hot).select("_id", "_second_best"), "paired_reads")
    single = ends.join(paired.select("_id"), "_id", "left_anti")
    taken = pairs.select(F.explode("_ends").alias("_end")).distinct().select("_end", F.lit(True).alias("_taken"))
    left = single.groupBy("_end").agg(best("_id").alias("_id")).join(taken, "_end", "left_anti").select("_id")
    lost = single.select("_id").join(left, "_id", "left_anti").unionByName(paired.where("_second_best").select("_id"))
    flags = materialize(lost, "duplicate_ids").withColumn("_lost", F.lit(True))
    return reads.join(flags, F.col(id) == F.col("_id"), "left").withColumn("is_duplicate", F.col("_lost").isNotNull()).drop("_id", "_lost")


def covered_regions(reads: DataFrame) -> DataFrame:
    """Covered intervals of each region: (region, chrom, start, end), 1-based inclusive."""
    named = reads.select(
        F.concat_ws("\t", F.col("region").cast("string"), "rname").alias("chrom"),
        F.col("pos").alias("start"),
        F.col("end_pos").alias("end"),
    )
    parts = F.split("chrom", "\t")
    return coverage_islands(named).select(
        F.get(parts, F.lit(0)).cast("int").alias("region"), F.get(parts, F.lit(1)).alias("chrom"), "start", "end"
    )


def target_regions(targets: DataFrame, covered: DataFrame) -> DataFrame:
    """Per region, its target intervals (BED: chrom, start, end) clipped to its covered intervals."""
    half_open = covered.select("region", "chrom", (F.col("start") - 1).alias("start"), "end")
    return interval_intersect(half_open, targets.select("chrom", "start", "end"))


def call_variants(
    reads: DataFrame,
    targets: DataFrame,
    caller: Callable,
    regions: int | None = None,
    rows_per_region: int | None = None,
    read_id: str = "read_id",
    read_group: dict[str, str] | None = None,
    on_error: str = "fail",
    duplicates: Callable[[DataFrame, str], DataFrame] = mark_duplicate_reads,
) -> DataFrame:
    """Reads to an ordered variant table.

    Mapped reads of the main chromosomes; duplicates marked; read group;
    regions of even size; qualities in one encoding; the covered intervals of a
    region and its targets in them; `caller` per region; the lines of all
    regions in one order. `caller` gets the reads of one region in coordinate
    order and the region's targets, as pandas frames, and returns a frame with
    one column `value` of VCF lines. `read_id` must be unique. `duplicates` is
    `mark_duplicate_reads`, or `mark_duplicate_pairs` for reads with mates.
    """
    main = reads.where(is_main_mapped(F.col("flag"), F.col("ref_index")))
    order = ["ref_index", "pos", read_id]
    # the read group is the same for all reads: it does not travel through the order
    balanced = with_read_group(balance_regions(duplicates(main, read_id), order, regions, rows_per_region), **(read_group or {}))
    balanced = balanced.select(*(c for c in balanced.columns if c != "region"), "region")
    fixed = materialize(with_fixed_quality(balanced, "region", order, on_error), "region_reads")
    own = materialize(target_regions(targets, covered_regions(fixed)), "region_targets")
    lines = region_apply_with(fixed, own, "region", order, ["chrom", "start", "end"], caller, "value string")
    return sorted_variants(parse_vcf(lines))


def run(reads: DataFrame, targets: DataFrame, caller: Callable, rows_per_region: int, out: str, **how) -> None:
    write_vcf(call_variants(reads, targets, caller, rows_per_region=rows_per_region, **how), out)


def compare(spark: SparkSession, reference: str, found: str) -> DataFrame:
    """total, matches and diff of two VCF files."""
    return vcf_concordance(read_vcf_keys(spark, reference), read_vcf_keys(spark, found))

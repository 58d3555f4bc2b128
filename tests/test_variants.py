import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skeinwork.functions.coords import chrom_number
from skeinwork.functions.reads import alignment_end, decode_quality, fix_quality, guess_quality
from skeinwork.operators.variants import sorted_variants, vcf_concordance
from skeinwork.plans import variants as job
from skeinwork.sources.dictionary import parse_dict
from skeinwork.plans.variants import mark_duplicate_pairs
from skeinwork.sources.sam import parse_sam, with_reference_index
from skeinwork.sources.vcf import parse_vcf


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_chromosome_numbers(spark):
    names = ["chr1", "chr22", "chrX", "chrY", "chrM", "chr6_hap", "X", "chr"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(chrom_number(F.col("n")).alias("c"))
    assert [r["c"] for r in df.collect()] == [1, 22, 23, 24, None, None, None, None]


def test_qualities(spark):
    quals = decode_quality(F.lit("II5"))
    assert one(spark, quals) == [40, 40, 20] and one(spark, guess_quality(quals)) == "SANGER"
    numbers = lambda *q: F.array(*[F.lit(x) for x in q])
    assert one(spark, guess_quality(numbers(60))) == "SANGER" and one(spark, guess_quality(numbers(61))) == "ILLUMINA"
    assert one(spark, fix_quality(numbers(31, 62))) == [0, 31]
    assert one(spark, fix_quality(numbers(30), on_error="null")) is None
    with pytest.raises(PySparkException):
        one(spark, fix_quality(numbers(30)))
    assert one(spark, alignment_end(F.lit(100), F.lit("5S20M2I3D10M"))) == 132


def test_concordance(spark, rows):
    schema = "chrom string, pos bigint, ref string, alt string"
    a = spark.createDataFrame([("chr1", 1, "A", "C"), ("chr1", 1, "A", "C"), ("chr1", 2, "A", "C"), ("chrX", 3, "A", "T")], schema)
    b = spark.createDataFrame([("chr1", 1, "A", "C"), ("chrX", 3, "A", "G"), ("chr2", 9, "A", "G")], schema)
    assert rows(vcf_concordance(a, b)) == [(3, 1, 2)]
    assert rows(vcf_concordance(a, a)) == [(3, 3, 0)]


def make_reads(spark):
    header = ["@HD"] + [f"@SQ\tSN:{n}\tLN:1000" for n in ["chrM", "chr1", "chr2"]]
    d = parse_dict(spark.createDataFrame(list(enumerate(header)), "position int, value string"))
    lines = []
    for i in range(60):
        qual = "h" * 4 if i % 3 == 0 else "k~~k"
        lines.append("\t".join([f"r{i:02}", "16" if i % 4 == 0 else "0", "chr1" if i % 2 else "chr2", str(1 + (i * 37) % 500), "60", "4M", "=", "0", "0", "ACGT", qual]))
    return with_reference_index(parse_sam(spark.createDataFrame([(x,) for x in lines], "value string")), d)


def first_base_caller():
    """A line per read that begins in a target of its region."""

    def call(reads, targets):
        lines = ["#comment"]
        for r in reads.itertuples():
            own = targets[(targets["chrom"] == r.rname) & (targets["start"] < r.pos) & (r.pos <= targets["end"])]
            if len(own) and not r.is_duplicate:
                lines.append(f"{r.rname}\t{r.pos}\t{r.qname}\tA\tC\t{max(r.quals)}")
        return pd.DataFrame({"value": lines})

    return call


def test_reads_to_ordered_variants(spark, tmp_path):
    reads, call_first_base = make_reads(spark), first_base_caller()
    everywhere = spark.createDataFrame([("chr1", 0, 1000), ("chr2", 0, 250)], "chrom string, start bigint, end bigint")
    call = lambda n: job.call_variants(reads, everywhere, call_first_base, n, read_id="qname")
    got = call(4).collect()
    places = [(r["chrom_no"], r["pos"]) for r in got]
    want = sorted((1 if i % 2 else 2, 1 + (i * 37) % 500) for i in range(60))
    assert places == [p for p in want if p[0] == 1 or p[1] <= 250]
    assert max(int(r["line"].split("\t")[5]) for r in got) == 126 - 33 - 31      # shifted encoding was fixed
    job.run(reads, everywhere, call_first_base, 15, str(tmp_path / "final"), read_id="qname")
    compared = job.compare(spark, str(tmp_path / "final"), str(tmp_path / "final"))
    assert compared.first()["diff"] == 0 and compared.first()["total"] == len(want) - sum(p[0] == 2 and p[1] > 250 for p in want)
    twice = sorted_variants(call(4).unionByName(call(2)), dedup=True)
    assert twice.count() == len(got)


def test_unmapped_reads_and_bad_qualities(spark, rows):
    schema = "id int, region int, ref_index int, pos bigint, end_pos bigint, flag int, quals array<int>"
    data = [(1, 0, 1, 10, 20, 4, [70]), (2, 0, 1, 10, 20, 4, [70]), (3, 0, 1, 10, 20, 0, [70]), (4, 0, 1, 10, 20, 0, [5]), (5, 0, 1, 10, 20, 0, None)]
    df = spark.createDataFrame(data, schema)
    assert rows(job.mark_duplicate_reads(df, "id").select("id", "is_duplicate")) == [(1, False), (2, False), (3, False), (4, True), (5, True)]
    fixed = job.with_fixed_quality(df, "region", ["id"], on_error="null")
    assert {r["id"]: r["quals"] for r in fixed.collect()} == {1: [39], 2: [39], 3: [39], 4: None, 5: None}


def test_covered_and_target_regions(spark, rows):
    reads = make_reads(spark).withColumn("region", (F.col("ref_index") - 1).cast("int"))
    covered = job.covered_regions(reads)
    spans = sorted((1 + (i * 37) % 500, 4 + (i * 37) % 500) for i in range(60) if i % 2)
    merged = [list(spans[0])]
    for s, e in spans[1:]:
        if s <= merged[-1][1] + 51:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    assert rows(covered.where("region = 0").select("start", "end")) == sorted(map(tuple, merged), key=repr)
    targets = spark.createDataFrame([("chr1", 0, 100), ("chr3", 0, 9)], "chrom string, start bigint, end bigint")
    clipped = job.target_regions(targets, covered)
    assert all(r["start"] >= 0 and r["end"] <= 100 and r["chrom"] == "chr1" and r["region"] == 0 for r in clipped.collect())


def test_duplicate_reads(spark, rows):
    schema = "id int, ref_index int, pos bigint, end_pos bigint, flag int, quals array<int>"
    data = [(1, 1, 10, 20, 0, [1, 2]), (2, 1, 10, 25, 0, [5]), (3, 1, 5, 20, 16, [9]), (4, 1, 9, 20, 16, [9]), (5, 2, 10, 20, 0, [1])]
    marked = job.mark_duplicate_reads(spark.createDataFrame(data, schema), "id")
    assert rows(marked.select("id", "is_duplicate")) == [(1, True), (2, False), (3, False), (4, True), (5, False)]


def test_clipped_ends(spark):
    from skeinwork.functions.reads import clipped, five_prime

    data = [("5S10M", 0, 100), ("2H3S10M4S1H", 16, 100), ("10M", 16, 100), ("*", 0, 100), (None, 0, 100), ("3S4H", 0, 7), ("10M2I3D5S", 16, 1)]
    df = spark.createDataFrame(data, "cigar string, flag int, pos long")
    got = df.select(clipped(F.col("cigar"), True), clipped(F.col("cigar"), False), five_prime(F.col("flag"), F.col("pos"), F.col("cigar")))
    assert [tuple(r) for r in got.collect()][:3] == [(5, 0, 95), (5, 5, 114), (0, 0, 109)]
    assert [r[2] for r in got.collect()][3:] == [None, None, 0, 18]


PAIRS = "read_id long, qname string, flag int, ref_index int, pos long, cigar string, quals array<int>"


def test_duplicate_pairs(spark):
    q = lambda n: [n]
    rows = [
        # two pairs with the same ends, mates the other way round; one is clipped
        (1, "a", 1 | 64, 1, 100, "10M", q(5)), (2, "a", 1 | 128 | 16, 1, 200, "10M", q(5)),
        (3, "b", 1 | 128, 1, 103, "3S7M", q(9)), (4, "b", 1 | 64 | 16, 1, 200, "8M2S", q(9)),
        # the same ends on another strand or reference are another pair
        (5, "c", 1 | 64, 1, 100, "10M", q(1)), (6, "c", 1 | 128, 1, 209, "10M", q(1)),
        (7, "d", 1 | 64, 2, 100, "10M", q(1)), (8, "d", 1 | 128 | 16, 2, 200, "10M", q(1)),
        # single reads: at an end of a pair, and among themselves
        (9, "e", 0, 1, 100, "10M", q(99)), (10, "f", 0, 3, 50, "10M", q(1)), (11, "g", 0, 3, 50, "10M", q(2)), (12, None, 0, 3, 50, "10M", None),
        # a name with three reads is no pair; unmapped, secondary and unplaced reads are nothing
        (13, "h", 1 | 64, 4, 1, "10M", q(1)), (14, "h", 1 | 128, 4, 1, "10M", q(2)), (15, "h", 1 | 64, 4, 1, "10M", q(3)),
        (16, "a", 4, 1, 100, "10M", q(1)), (17, "a", 256, 1, 100, "10M", q(1)), (18, "i", 0, 1, 100, "*", q(1)),
        # a mate that is not mapped leaves a single read
        (19, "j", 1 | 64, 5, 10, "10M", q(1)), (20, "j", 1 | 128 | 4, 5, 10, "10M", q(1)), (21, "k", 0, 5, 10, "10M", q(2)),
    ]
    df = spark.createDataFrame(rows, PAIRS).repartition(4)
    got = {r["read_id"] for r in mark_duplicate_pairs(df, "read_id").where("is_duplicate").collect()}
    assert got == {1, 2, 9, 10, 12, 13, 14, 19}
    assert mark_duplicate_pairs(df.limit(0), "read_id").count() == 0


def test_chromosome_names_with_signs(spark):
    names = ["chr-5", "chr5", "chr+5", "chr 5", "chr05", "chrX", "chr0", "chr-0"]
    df = spark.createDataFrame([(n,) for n in names], "chrom string")
    assert [r[0] for r in df.select(chrom_number(F.col("chrom"))).collect()] == [None, 5, None, None, None, 23, 0, None]


def test_a_dropped_line_is_not_split(spark):
    """Lines to drop go before the projection that splits; what is kept is the same."""
    lines = ["chr1\t5\tx\tA\tC\t.", "chrM\t5\tx\tA\tC\t.", "chr2\tq\tx\tA\tC\t.", "chr3", "chr4\t7", "#chr1\t5", "chrY\t9\ty\tA\tC"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    dropped = [tuple(r) for r in parse_vcf(df, on_error="drop").collect()]
    assert dropped == [tuple(r) for r in parse_vcf(df).collect() if r["chrom_no"] is not None and r["pos"] is not None]
    assert [r[0] for r in dropped] == ["chr1", "chr4", "chrY"]


def test_lines_to_drop_are_split_once(spark, rows):
    """The test of a line stands in one expression: the text of the line is made a few times, not once per use of a field."""
    from skeinwork.sources.vcf import parse_vcf

    kept = ["chr1\t5\tx\tA\tC", "chrX\t7", "chr0\t-3\tid"]
    bad = ["chrM\t5\tx", "chr1", "chr2\t\tx", "chr3\tfive", "HLA\t5", "chr01\t4", "", None, "chr99999999999\t1"]
    parts = spark.createDataFrame([(v,) for v in kept + bad], "half string").select(F.concat("half", F.lit("")).alias("value"))
    found = parse_vcf(parts, on_error="drop")
    assert rows(found.select("chrom_no", "pos", "line")) == rows(spark.createDataFrame(
        [(1, 5, kept[0]), (23, 7, kept[1]), (0, -3, kept[2])], "chrom_no int, pos bigint, line string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(") <= 4


def test_the_read_group_does_not_travel_through_the_order(spark, monkeypatch):
    """Constant columns are put to the reads after they have got their regions; the caller gets the same columns."""
    taken, given = [], job.balance_regions
    monkeypatch.setattr(job, "balance_regions", lambda df, *rest, **named: (taken.append(df.columns), given(df, *rest, **named))[1])
    reads = spark.createDataFrame([(i, 0, 1, "chr1", 10 * i, 10 * i + 5, [30]) for i in range(6)],
                                  "read_id bigint, flag int, ref_index int, rname string, pos bigint, end_pos bigint, quals array<bigint>")
    targets = spark.createDataFrame([("chr1", 0, 100)], "chrom string, start bigint, end bigint")
    names = lambda own, _: pd.DataFrame({"value": ["chr1\t1\t" + ",".join(own.columns)] if len(own) else []}, dtype=object)
    found = job.call_variants(reads, targets, names, regions=1).collect()
    assert not [c for c in taken[0] if c.startswith("rg")]
    seen = found[0]["id"].split(",")
    assert {"rgid", "rglb", "rgpl", "rgpu", "rgsm", "is_duplicate", "quals", "region"} <= set(seen)

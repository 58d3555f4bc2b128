import gzip
import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skeinwork.operators.graph import numbered_members
from skeinwork.plans import fastq as fastq_job
from skeinwork.plans.pagecounts import pagecount_report
from skeinwork.plans.pagecounts import run as run_pagecounts
from skeinwork.plans.retweets import log_report
from skeinwork.sources import sinks
from skeinwork.sources.bed import read_bed, read_bed_header
from skeinwork.sources.dictionary import read_dict
from skeinwork.sources.fastq import read_fastq
from skeinwork.sources.files import list_inputs, read_folder
from skeinwork.sources.sam import read_sam
from skeinwork.sources.text_records import RETWEET_LOG_HEADER, read_memberships, read_pagecounts, read_retweet_log
from skeinwork.sources.vcf import VCF_HEADER, read_vcf, read_vcf_keys


def put(path: pathlib.Path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def lines_of(folder) -> list[str]:
    out = []
    for part in sorted([*pathlib.Path(folder).glob("part-*"), *pathlib.Path(folder).glob("Chunks_*")]):
        opened = gzip.open(part, "rt") if part.suffix == ".gz" else part.open()
        with opened as f:
            out += f.read().splitlines()
    return out


def test_pagecounts(spark, tmp_path, rows):
    path = put(tmp_path / "pages", "fr Accueil 120 9000\nfr.co Tour 30 100\nfr fr 7 10\nzz Only 5 1\n")
    assert rows(pagecount_report(spark, path)) == [("French", "fr", 150, "Accueil", 120), ("zz", "zz", 5, "Only", 5)]
    run_pagecounts(spark, path, str(tmp_path / "report"))
    assert lines_of(tmp_path / "report")[0] == "language,code,total_views,top_title,top_views"


def test_pagecount_errors(spark, tmp_path, rows):
    path = put(tmp_path / "pages", "fr A 1 1\nfr B x 1\nfr\n")
    with pytest.raises(PySparkException):
        read_pagecounts(spark, path).collect()
    assert rows(read_pagecounts(spark, path, "drop")) == [("fr", "A", 1)]
    assert read_pagecounts(spark, path, "null").count() == 3


LOG = f"""{RETWEET_LOG_HEADER}
(60),French,fr,9,11,8,5,4,bonjour, toi
(65),French,fr,9,11,9,5,5,bonjour, toi
{RETWEET_LOG_HEADER}
(65),French,fr,9,12,3,3,1,
"""


def test_retweet_log(spark, tmp_path, rows):
    path = put(tmp_path / "log", LOG)
    assert rows(log_report(spark, path)) == [("French", "fr", 6, "11", 5, "bonjour, toi")]
    assert rows(log_report(spark, path, truncate_text=True)) == [("French", "fr", 6, "11", 5, "bonjour")]
    assert read_retweet_log(spark, path).where("text = ''").count() == 1


MALE = 'A, One (I)\tFilm X (2012)  [Bob]  <3>\n\t\t\t"Series" (2013)\n\t\t\tY (sub) (2014/II) (TV)\n\nB, Two\tZ (????)\n\t\t\tFilm X (2012)\n'
FEMALE = "A, One (I)\tOld (1999)\n\t\t\tFilm X (2012)\n\t\t\tnameless\n"


def test_memberships(spark, tmp_path, rows):
    m, f = put(tmp_path / "m", MALE), put(tmp_path / "f", FEMALE)
    all_rows = read_memberships(spark, m, f).select("group", "person", "movie", "year")
    assert all_rows.count() == 6
    assert rows(all_rows.where("year is null")) == [("M", "B, Two", "Z (????)", None)]
    assert rows(read_memberships(spark, m, f, 2011).select("group", "movie").distinct()) == [
        ("F", "Film X (2012)"), ("M", "Film X (2012)"), ("M", "Y (sub) (2014/II)")
    ]


def fastq_text(n: int, mate: int) -> str:
    return "".join(f"@r{i}/{mate}\nAC{i}\n+\n@II{i}\n" for i in range(n))


def test_fastq_numbers_over_many_splits(spark, tmp_path, rows):
    path = put(tmp_path / "one.fq", fastq_text(3000, 1))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "5000")
    try:
        got = read_fastq(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        reads = {r["rec"]: r["lines"] for r in got.collect()}
    finally:
        spark.conf.set(setting, before)
    assert reads == {i: [f"@r{i}/1", f"AC{i}", "+", f"@II{i}"] for i in range(3000)}


def test_interleaved_chunks(spark, tmp_path):
    one, two = put(tmp_path / "fastq1.fq", fastq_text(50, 1)), put(tmp_path / "fastq2.fq", fastq_text(50, 2))
    fastq_job.run(spark, one, two, str(tmp_path / "chunks"), 3)
    assert sorted(p.name for p in (tmp_path / "chunks").glob("*.gz")) == [f"Chunks_{i}.fq.gz" for i in range(3)]
    want = []
    for i in range(50):
        for mate in (1, 2):
            want += [f"@r{i}/{mate}", f"AC{i}", "+", f"@II{i}"]
    assert lines_of(tmp_path / "chunks") == want
    folder = read_folder(spark, str(tmp_path / "chunks"), "*.gz")
    assert folder.select("file_path").distinct().count() == 3 and folder.count() == len(want)
    assert list_inputs(spark, str(tmp_path / "chunks"), "*.gz").count() == 3


def test_chunks_of_even_size_and_empty_ones(spark, tmp_path):
    one, two = put(tmp_path / "fastq1.fq", fastq_text(5, 1)), put(tmp_path / "fastq2.fq", fastq_text(5, 2))
    fastq_job.run(spark, one, two, str(tmp_path / "chunks"), 7)
    lines = {}
    for part in (tmp_path / "chunks").glob("*.gz"):
        with gzip.open(part, "rt") as f:
            lines[part.name] = len(f.read().splitlines())
    assert lines == {f"Chunks_{i}.fq.gz": 8 if i < 5 else 0 for i in range(7)}
    assert read_fastq(spark, str(tmp_path / "chunks")).count() == 10


def test_mates_of_several_files(spark, tmp_path):
    """Files pair up by the order of their paths, also when their names are equal."""
    want = []
    for lane, n in (("lane1", 7), ("lane2", 4)):
        for mate in (1, 2):
            (tmp_path / f"mate{mate}" / lane).mkdir(parents=True)
            put(tmp_path / f"mate{mate}" / lane / "r.fq", fastq_text(n, mate).replace("@r", f"@{lane}-"))
        for i in range(n):
            for mate in (1, 2):
                want += [f"@{lane}-{i}/{mate}", f"AC{i}", "+", f"@II{i}"]
    fastq_job.run(spark, f"{tmp_path}/mate1/*", f"{tmp_path}/mate2/*", str(tmp_path / "chunks"), 2)
    assert lines_of(tmp_path / "chunks") == want
    put(tmp_path / "mate2" / "lane2" / "r.fq", fastq_text(3, 2))
    with pytest.raises(ValueError):
        fastq_job.run(spark, f"{tmp_path}/mate1/*", f"{tmp_path}/mate2/*", str(tmp_path / "other"), 2)


DICT = "@HD\tVN:1.0\n@SQ\tSN:chrM\tLN:16571\n@SQ\tSN:chr1\tLN:x\n@SQ\tSN:chr2\tLN:300\n"


def sam_line(name, flag, chrom, pos, cigar="4M", qual="IIII", *tags):
    return "\t".join([name, str(flag), chrom, str(pos), "60", cigar, "=", "0", "0", "ACGT", qual, *tags])


def test_sam_and_dictionary(spark, tmp_path, rows):
    d = read_dict(spark, put(tmp_path / "d.dict", DICT))
    assert rows(d) == [(0, "chrM", 16571), (1, "chr1", 0), (2, "chr2", 300)]
    text = "\n".join([
        "@HD\tVN:1.0", sam_line("a", 0, "chr1", 100, "5S20M2I3D10M", "II5", "NM:i:0", "X:Z:1"),
        sam_line("b", 4, "chr1", 1), sam_line("c", 16, "chrM", 1), sam_line("d", 16, "chr2", 7), sam_line("e", 0, "chrUn", 7),
        sam_line("f", 0, "chr2", "bad"),
    ])
    path = put(tmp_path / "a.sam", text)
    reads = read_sam(spark, path, d)
    assert rows(reads.select("qname", "ref_index", "end_pos").where("qname in ('a', 'e', 'f')")) == [
        ("a", 1, 132), ("e", -1, 10), ("f", 2, None)
    ]
    bare = read_sam(spark, put(tmp_path / "b.sam", sam_line("g", 0, "chr2", 7, "*", "*")), d).first()
    assert bare["quals"] is None and bare["end_pos"] is None
    first = reads.where("qname = 'a'").first()
    assert first["tags"] == ["NM:i:0", "X:Z:1"] and first["quals"] == [40, 40, 20]
    assert [r[0] for r in rows(read_sam(spark, path, d, main_only=True).select("qname"))] == ["a", "d", "f"]


VCF = "##contig=<ID=chr1>\n#CHROM\tPOS\n" + "".join(
    f"{c}\t{p}\t.\tA\t{alt}\t50\tPASS\t.\tGT\t1\n" for c, p, alt in
    [("chrX", 5, "C"), ("chr2", 9, "C"), ("chr10", 1, "C"), ("chr2", 3, "T"), ("chrM", 1, "G"), ("chrY", 2, "C")]
)


def test_vcf(spark, tmp_path, rows):
    path = put(tmp_path / "a.vcf", VCF)
    v = read_vcf(spark, path)
    assert [r[0] for r in rows(v.where("chrom_no is null").select("chrom"))] == ["chrM"]
    with pytest.raises(PySparkException):
        read_vcf(spark, path, "fail").collect()
    sinks.write_vcf(read_vcf(spark, path, "drop"), str(tmp_path / "out"))
    written = lines_of(tmp_path / "out")
    assert written[0] == f"{VCF_HEADER}\tls"
    assert [x.split("\t")[:2] for x in written[1:]] == [
        ["chr2", "3"], ["chr2", "9"], ["chr10", "1"], ["chrX", "5"], ["chrY", "2"]
    ]
    assert read_vcf_keys(spark, path).count() == 7      # the header line names chr1 in its first field


def test_bed_and_regions(spark, tmp_path, rows):
    path = put(tmp_path / "a.bed", "track x\n#c\nchr1\t9\t20\tgene\t1\nchr1\t30\t40\n")
    assert rows(read_bed(spark, path)) == [("chr1", 30, 40, None), ("chr1", 9, 20, "gene\t1")]
    assert read_bed_header(spark, path).count() == 2
    df = spark.createDataFrame([("chr1", 10, 20), ("chr1", 30, 40)], "chrom string, start bigint, end bigint")
    sinks.write_bed(df, str(tmp_path / "bed"))
    sinks.write_bed(df, str(tmp_path / "bed_short"), half_open=False)
    sinks.write_regions(df, str(tmp_path / "regions"))
    assert lines_of(tmp_path / "bed") == ["chr1\t9\t20", "chr1\t29\t40"]
    assert lines_of(tmp_path / "bed_short") == ["chr1\t9\t19", "chr1\t29\t39"]
    assert lines_of(tmp_path / "regions") == ["chr1:10-20", "chr1:30-40"]


def test_numbered_lists_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("M", "b"), ("F", "z"), ("M", "a"), ("F", "y"), ("M", "c")], "group string, person string")
    sinks.write_numbered(numbered_members(df), str(tmp_path / "lists"))
    assert lines_of(tmp_path / "lists/group=M") == ["1. a", "2. b", "3. c"]
    assert lines_of(tmp_path / "lists/group=F") == ["1. y", "2. z"]
    sinks.write_report(df.orderBy("person"), str(tmp_path / "report"), single_file=True)
    assert lines_of(tmp_path / "report") == ["group,person", "M,a", "M,b", "M,c", "F,y", "F,z"]
    assert sinks.tuple_lines(df.limit(1).select(F.lit("a").alias("a"), F.lit(None).cast("int").alias("b"))).first()[0] == "(a,null)"


def test_chunks_are_sorted_by_blocks_of_text(spark, tmp_path, monkeypatch):
    """A chunk's task gets a row per block of records, and the lines of the chunk in order."""
    import gzip

    from skeinwork.plans import fastq as job

    for mate in (1, 2):
        (tmp_path / f"m{mate}").mkdir()
        (tmp_path / f"m{mate}" / "a.fq").write_text("".join(f"@r{i}/{mate}\n{'A' * (i % 3)}\n+\n\n" for i in range(23)))
    monkeypatch.setattr(job, "BLOCK_RECORDS", 4)
    taken, write = [], job.write_chunks
    monkeypatch.setattr(job, "write_chunks", lambda df, *rest, **named: (taken.append(df.count()), write(df, *rest, **named)))
    job.run(spark, str(tmp_path / "m1"), str(tmp_path / "m2"), str(tmp_path / "out"), 3)
    assert taken[0] <= 9
    found = "".join(gzip.open(tmp_path / "out" / f"Chunks_{c}.fq.gz", "rt").read() for c in range(3))
    assert found == "".join(f"@r{i}/{m}\n{'A' * (i % 3)}\n+\n\n" for i in range(23) for m in (1, 2))

"""Aligned reads: predicates, qualities, alignment end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Flag bits, accepted reference numbers, quality rules, read group.
PAIRED_FLAG, UNMAPPED_FLAG, REVERSE_FLAG, FIRST_FLAG, SECOND_FLAG, OTHER_FLAGS = 1, 4, 16, 64, 128, 256 + 2048     # OTHER: secondary, supplementary
FIRST_REFERENCE, LAST_REFERENCE = 1, 24
SANGER_MAX_QUALITY = 60
QUALITY_SHIFT = 31
READ_GROUP = {"rgid": "GROUP1", "rglb": "LIB1", "rgpl": "ILLUMINA", "rgpu": "UNITI", "rgsm": "SAMPLE1"}


def is_main_mapped(flag: Column, ref_index: Column) -> Column:
    """Mapped, on chr1..chr22, chrX or chrY (index 0 is chrM)."""
    mapped = flag.bitwiseAND(F.lit(UNMAPPED_FLAG)) == 0
    return mapped & ref_index.between(FIRST_REFERENCE, LAST_REFERENCE)


def with_read_group(df: DataFrame, **values: str) -> DataFrame:
    """Constant read-group columns."""
    return df.withColumns({k: F.lit(v) for k, v in {**READ_GROUP, **values}.items()})


def decode_quality(qual: Column) -> Column:
    """Quality text to numbers: character code minus 33; NULL for `*` (no qualities) and NULL."""
    return F.when(qual != "*", F.transform(F.split(qual, ""), lambda c: F.ascii(c) - F.lit(33)))


def guess_quality(quals: Column) -> Column:
    """SANGER when no quality is above 60, else ILLUMINA; NULL without qualities."""
    top = F.array_max(quals)
    return F.when(top <= SANGER_MAX_QUALITY, F.lit("SANGER")).when(top > SANGER_MAX_QUALITY, F.lit("ILLUMINA"))


def fix_quality(quals: Column, on_error: str = "fail") -> Column:
    """Subtract 31 from each quality; a negative result is an error or NULL."""
    fixed = F.transform(quals, lambda q: q - F.lit(QUALITY_SHIFT))
    bad = F.exists(fixed, lambda q: q < 0)
    if on_error == "null":
        return F.when(~bad, fixed)
    message = F.lit("quality below the range of the shifted encoding")
    return F.when(bad, F.raise_error(message).cast("array<int>")).otherwise(fixed)


def reference_length(cigar: Column) -> Column:
    """Reference bases covered by a CIGAR string (operations M, D, N, =, X)."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))


def alignment_end(pos: Column, cigar: Column) -> Column:
    """1-based inclusive end of an alignment; NULL without a CIGAR (`*`)."""
    return F.when(cigar != "*", pos + reference_length(cigar) - F.lit(1))


def clipped(cigar: Column, leading: bool) -> Column:
    """Bases clipped (S and H) at the beginning or end of a CIGAR string."""
    run = F.regexp_extract(cigar, r"^((?:\d+[SH])+)" if leading else r"((?:\d+[SH])+)$", 1)
    lengths = F.regexp_extract_all(run, F.lit(r"(\d+)[SH]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))


def five_prime(flag: Column, pos: Column, cigar: Column) -> Column:
    """Where the 5' end of a read would lie if nothing of it were clipped; NULL without a CIGAR."""
    reverse = flag.bitwiseAND(F.lit(REVERSE_FLAG)) != 0
    return F.when(reverse, alignment_end(pos, cigar) + clipped(cigar, False)).otherwise(F.when(cigar != "*", pos - clipped(cigar, True)))

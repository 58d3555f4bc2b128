"""Chromosome numbers and interval notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chrom_number(chrom: Column) -> Column:
    """chrX to 23, chrY to 24, `chr` and a whole number to that number; NULL for anything else.

    Numbers outside 1 to 24 are kept: `is_main_mapped` and the callers decide on them.
    """
    name = F.substr(chrom, F.lit(4))
    number = name.try_cast("int")
    strict = F.when((number >= 0) & (number.cast("string") == name), number)      # no blanks, signs or fractions
    named = F.when(name == "X", F.lit(23)).when(name == "Y", F.lit(24)).otherwise(strict)
    return F.when(chrom.startswith("chr"), named)


def bed_start(start: Column) -> Column:
    return start - F.lit(1)


def bed_end(end: Column, half_open: bool = True) -> Column:
    """Half-open BED end; half_open=False gives the end - 1 convention."""
    return end if half_open else end - F.lit(1)


def region_string(chrom: Column, start: Column, end: Column) -> Column:
    """`name:start-end`, 1-based inclusive."""
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def reference_order(ref_index: Column) -> list[Column]:
    """Sort key in which reference -1 (unmapped) comes last."""
    return [F.when(ref_index == -1, F.lit(1)).otherwise(F.lit(0)), ref_index]

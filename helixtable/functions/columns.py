"""Scalar functions on columns: labels, parsing, coordinates. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of accessions and of headers.
ASSEMBLY = r"^GC[AF]_[0-9]+(\.[0-9]+)?$"
PROTEIN = r"^[A-Z]{3}[0-9]{5}(\.[0-9]+)?$"
GENERAL = r"[A-Z]{2,}_?[0-9]+\.[0-9]{1,2}"
CHROMOSOME = r"[A-Za-z]+_?[0-9]+[._]?[0-9]*"
TAG = r"\|tag:(\w{6})"
LOCATION = r"^([^:]*):(\d+)-(\d+)"
FASTA_SUFFIX = r"(?i)\.(fasta|fna|fas|fa)$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def species_from_file(name: Column) -> Column:
    """File name without its FASTA suffix, in any case."""
    return F.regexp_replace(name, FASTA_SUFFIX, "")


def file_stem(name: Column) -> Column:
    """File name up to its last dot."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def ungap(sequence: Column) -> Column:
    return F.translate(sequence, "-*", "")


def fasta_header(subject: Column, start: Column, end: Column, tag: Column) -> Column:
    return F.concat(subject, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("|tag:"), tag)


def tag_of(query_id: Column) -> Column:
    """The first tag in a query id, null if there is none."""
    return blank_to_null(F.regexp_extract(query_id, TAG, 1))


def without_tags(query_id: Column) -> Column:
    return F.regexp_replace(query_id, TAG, "")


def location(definition: Column) -> list[Column]:
    """Chromosome, start and end from text like chromosome:start-end...; '' where it is not like that."""
    return [F.regexp_extract(definition, LOCATION, k) for k in (1, 2, 3)]


def accession(text: Column) -> Column:
    """First accession-like part of a chromosome's name, null if there is none."""
    return F.regexp_substr(text, F.lit(CHROMOSOME))


def strand(start: Column, end: Column) -> Column:
    """'+' where start < end, else '-'; null if either is null. To be taken before coordinates are put in order."""
    return F.when(start < end, "+").when(start >= end, "-")


def ordered(start: Column, end: Column) -> tuple[Column, Column]:
    """Lower and upper coordinate; null if either is null (least and greatest alone skip nulls)."""
    known = start.isNotNull() & end.isNotNull()
    return F.when(known, F.least(start, end)), F.when(known, F.greatest(start, end))


def completeness_label(code: Column) -> Column:
    return F.when(code == "W", "Complete").when(code.isin("N", "C", "B"), "Truncated").when(code == "NC", "Bitruncated")


def completeness_rank(label: Column) -> Column:
    return F.when(label == "Complete", 1).when(label == "Truncated", 2).when(label == "Bitruncated", 3).when(label == "No Hit", 4)


def contingency_label(code: Column) -> Column:
    return F.when(code == "-", "Complete").when(code == "NC", "Bitruncated").when(code == "N", "N-Truncated").when(code == "C", "C-Truncated")


def tile_label(code: Column) -> Column:
    return F.when(code.isin("N", "C", "B"), code).otherwise("")


def accession_kind(text: Column) -> Column:
    return F.when(text.rlike(ASSEMBLY), "assembly").when(text.rlike(PROTEIN), "protein").when(text.rlike(GENERAL), "accession").otherwise("search term")


def safe_name(text: Column) -> Column:
    return F.translate(text, " ", "_")


def level_rank(level: Column) -> Column:
    """Order of assembly levels; both spellings of the first are known, others give null."""
    return F.when(level.isin("Complete", "Complete Genome"), 1).when(level == "Chromosome", 2).when(level == "Scaffold", 3).when(level == "Contig", 4)


def long_of(text: Column) -> Column:
    """Whole part of a number in text, null if it is none."""
    return text.try_cast("double").cast("long")

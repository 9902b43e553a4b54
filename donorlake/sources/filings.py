"""Itemisations of electronic filings by form version (SRC9).

A filing is a text file whose first line names the version of its form and
fixes the separator of all its lines; what stands at which position of a line
depends on the form type of the line and on that version. Layouts are an
interval table (form type pattern, first and last version, columns). The
version is read from a bounded head of each file and travels with the file's
byte ranges, each line finds its layout by one lookup of literals in the JVM,
and its fields are taken by the positions that the layout gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorlake.sources import ranges as rg

FIELD_SEPARATOR = "\x1c"


@dataclass(frozen=True)
class Layout:
    """``columns`` in order of position for lines whose form type matches
    ``form`` (a pattern for its beginning, case ignored), in filings of
    versions ``first`` to ``last``, both included."""

    form: str
    first: str
    last: str
    columns: tuple[str, ...]


_ADDRESS = ("contributor_street_1", "contributor_street_2", "contributor_city", "contributor_state", "contributor_zip_code")
_PERSON = ("contributor_last_name", "contributor_first_name", "contributor_middle_name", "contributor_prefix",
           "contributor_suffix")

# The published positions of schedule A lines by form version.
SCHEDULE_A = (
    Layout("SA", "3.0", "5.99", (
        "form_type", "filer_committee_id_number", "entity_type", "contributor_name", *_ADDRESS, "election_code",
        "election_other_description", "contributor_employer", "contributor_occupation", "contribution_aggregate",
        "contribution_date", "contribution_amount", "contribution_purpose_code", "contribution_purpose_descrip")),
    Layout("SA", "6.0", "7.99", (
        "form_type", "filer_committee_id_number", "transaction_id", "back_reference_tran_id_number",
        "back_reference_sched_name", "entity_type", "contributor_organization_name", *_PERSON, *_ADDRESS,
        "election_code", "election_other_description", "contribution_date", "contribution_amount",
        "contribution_aggregate", "contribution_purpose_code", "contribution_purpose_descrip",
        "contributor_employer", "contributor_occupation")),
    Layout("SA", "8.0", "8.99", (
        "form_type", "filer_committee_id_number", "transaction_id", "back_reference_tran_id_number",
        "back_reference_sched_name", "entity_type", "contributor_organization_name", *_PERSON, *_ADDRESS,
        "election_code", "election_other_description", "contribution_date", "contribution_amount",
        "contribution_aggregate", "contribution_purpose_descrip", "contributor_employer", "contributor_occupation")),
)


def header_facts(files: DataFrame) -> DataFrame:
    """Files with ``sep``, ``quote`` and ``version`` from their header line
    (third field; NULL where there is none)."""
    modern = F.col("head").contains(FIELD_SEPARATOR)
    fields = F.split("head", F.when(modern, F.lit(FIELD_SEPARATOR)).otherwise(F.lit(",")), -1)
    said = F.regexp_extract(F.coalesce(F.try_element_at(fields, F.lit(3)), F.lit("")), r"(\d+(?:\.\d+)?)", 1)
    return files.withColumn("_said", said).select(
        *[c for c in files.columns if c != "head"],
        F.when(modern, F.lit(FIELD_SEPARATOR)).otherwise(F.lit(",")).alias("sep"),
        F.when(modern, F.lit("")).otherwise(F.lit('"')).alias("quote"),
        F.when(F.upper(F.trim(F.element_at(fields, 1))) == "HDR",
               F.expr("try_cast(nullif(_said, '') as decimal(6, 2))")).alias("version"))


def layout_of(form, version, layouts: Sequence[Layout]):
    """Number of the first layout that fits, NULL without one."""
    out = F.lit(None).cast("int")
    for i, x in reversed(list(enumerate(layouts))):
        fits = F.lower(form).rlike(f"^(?i:{x.form})") & version.between(F.lit(Decimal(x.first)), F.lit(Decimal(x.last)))
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def itemizations(spark: SparkSession, path: str, columns: Sequence[str], layouts: Sequence[Layout] = SCHEDULE_A,
                 prefix: str = "SA", drop_prefix: str = "SA3L", date_pattern: str = r"date=(\d{4}-\d{2}-\d{2})",
                 glob: str = "*.fec", encoding: str = "utf-8",
                 split_bytes: int = rg.SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """SRC9: (partition_date and ``columns`` as text of every line whose form
    type begins with ``prefix``, those of ``drop_prefix`` left out; lines of
    that kind that no layout fits, with file, version and fields). A column
    that a version does not have is ''; the partition date is what
    ``date_pattern`` finds in the file's name, '' where it finds nothing."""
    files = rg.files_of(spark, path, glob)
    n = rg.tasks_for(files, split_bytes)
    facts = header_facts(rg.with_first_line(files, n, encoding)).withColumn(
        "partition_date", F.regexp_extract("file", date_pattern, 1))
    # quotes are only used with commas; a file's ranges share its facts
    found = rg.with_quote_state(rg.ranges_of(facts, split_bytes), None, n).repartition(n, "file", "begin")
    lines = rg.read_ranges(found, None, header=True, encoding=encoding, carry=["file", "partition_date", "version"])
    form = F.trim(F.coalesce(F.try_element_at("fields", F.lit(1)), F.lit("")))
    lines = lines.filter(F.lower(form).startswith(prefix.lower()) & ~F.lower(form).startswith(drop_prefix.lower()))
    lines = lines.withColumn("_layout", layout_of(form, F.col("version"), layouts))
    # positions by layout: one literal table, from 1, 0 where it has no such column
    places = F.array(*[F.array(*[F.lit(x.columns.index(c) + 1 if c in x.columns else 0) for c in columns]) for x in layouts])
    at = F.element_at(places, F.col("_layout") + 1)
    placed = lines.filter("_layout IS NOT NULL").withColumn("_at", at)
    field = [F.when(F.col("_at")[i] == 0, F.lit("")).otherwise(
        F.coalesce(F.try_element_at("fields", F.greatest(F.col("_at")[i], F.lit(1))), F.lit(""))).alias(c)
        for i, c in enumerate(columns)]
    return (placed.select("partition_date", *field),
            lines.filter("_layout IS NULL").select("file", "partition_date", F.col("version").cast("string").alias("version"), "fields"))

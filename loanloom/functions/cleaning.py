"""Cleaning of raw application fields as column expressions; all of it collapses into one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.sources.tables import UNUSED_FIELDS

# Employment length texts and the years they stand for.
EMPLOYMENT_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}
GRADES = "ABCDEFG"
CREDIT_HISTORY_AS_OF = "2020-01-01"


def employment_years(c: Column) -> Column:
    """Years in the job, -1 where the text is missing or unknown."""
    known = F.create_map(*[F.lit(x) for kv in EMPLOYMENT_YEARS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, c), F.lit(-1)).cast("tinyint")


def grade_rank(c: Column) -> Column:
    """A to G as 1 to 7, NULL for anything else."""
    spot = F.instr(F.lit(GRADES), c)
    return F.when((F.length(c) == 1) & (spot > 0), spot)


def subgrade_rank(c: Column) -> Column:
    """A1 to G5 as 1 to 35: five steps per letter, an unknown letter counts from zero, a bad digit is -1."""
    letter = F.instr(F.lit(GRADES), F.substring(c, 1, 1))
    start = F.when((F.length(c) > 0) & (letter > 0), (letter - 1) * 5).otherwise(0)
    digit = F.substring(c, 2, 1).try_cast("int")
    return F.coalesce(start + digit, F.lit(-1)).cast("int")


def credit_history_months(c: Column, as_of: str = CREDIT_HISTORY_AS_OF) -> Column:
    """Whole 30-day months from a 'Dec-2000' text to the reference date."""
    opened = F.to_date(F.try_to_timestamp(c, F.lit("MMM-yyyy")))
    return F.floor(F.datediff(F.to_date(F.lit(as_of)), opened) / 30).cast("int")


def clean_loans(df: DataFrame) -> DataFrame:
    """Parse lengths, dates and grades. The key column stays: it is what replaces row position."""
    have = set(df.columns)
    made: dict[str, Column] = {}
    if "employmentLength" in have:
        made["employmentLength"] = employment_years(F.col("employmentLength"))
    if "issueDate" in have:
        day = F.try_to_timestamp(F.col("issueDate").cast("string"), F.lit("yyyy-MM-dd"))
        made["issueDate_month"], made["issueDate_year"] = F.month(day), F.year(day)
    if "earliesCreditLine" in have:
        made["creditHistory_months"] = credit_history_months(F.col("earliesCreditLine"))
    if "grade" in have:
        made["grade"] = grade_rank(F.col("grade"))
    if "subGrade" in have:
        made["subGrade"] = subgrade_rank(F.col("subGrade"))
    gone = {*UNUSED_FIELDS, "issueDate", "earliesCreditLine"}
    kept = [made.pop(c).alias(c) if c in made else F.col(c) for c in df.columns if c not in gone]
    return df.select(*kept, *[v.alias(n) for n, v in made.items()])


def feature_columns(df: DataFrame, label: str = "isDefault", key: str = "id") -> list[str]:
    """Every column but the label and the key."""
    return [c for c in df.columns if c not in (label, key)]


def null_for_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, done once at the source."""
    float_cols = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in float_cols else F.col(c) for c in df.columns])

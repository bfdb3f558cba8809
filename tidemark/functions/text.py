"""Text and date repair as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def strip(text: Column) -> Column:
    """Drop white space of every kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def title_case(text: Column) -> Column:
    """Every run of letters with its first letter in upper case, the rest lower: O'Brien Mary-Jane."""
    def capital(run: Column) -> Column:
        return F.concat(F.upper(F.left(run, F.lit(1))), F.substr(run, F.lit(2)))

    lower = F.lower(text)
    runs = F.regexp_extract_all(lower, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    # a single plain word, as most are, is not taken apart; signs and digits may follow it
    return F.when(text.rlike(r"^[A-Za-z]+[\x00-@\[-`{-\x7F]*$"), capital(lower)).otherwise(F.array_join(F.transform(runs, capital), ""))


def mapped(value: Column, labels: Mapping[str, str]) -> Column:
    """Replace exact keys; anything else stays."""
    out = value
    for key, label in labels.items():
        out = F.when(value == key, label).otherwise(out)
    return out


def repaired_email(text: Column) -> Column:
    """Trimmed, lower case, .con mended; NULL when it is no address."""
    tidy = F.regexp_replace(F.lower(strip(text)), r"\.con$", ".com")
    return F.when(tidy.rlike(EMAIL), tidy)


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def parsed_date(text: Column) -> Column:
    """yyyy-M-d, else d/M/yyyy, else NULL.

    Only text of a pattern's shape is parsed by it: a text that cannot be parsed costs an exception, far more than the look.
    """
    number = r"\s*[+-]?\d+\s*"
    shapes = {sep: text.rlike(f"^{sep.join([number] * 3)}$") for sep in "-/"}
    return F.coalesce(
        F.when(shapes["-"], F.try_to_date(text, "yyyy-M-d")), F.when(shapes["/"], F.try_to_date(text, "d/M/yyyy"))
    )


def us_date(text: Column) -> Column:
    """M/d/yyyy text as a date, NULL where it is none."""
    return F.try_to_date(text, "M/d/yyyy")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a UTC wall-clock time that no session zone shifts."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

"""String expressions: file names, labels, number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output formats.
MONTH_FILE_FORMAT = "yellow_tripdata_%04d-%02d.parquet"
WEEKDAY_LABELS_SUNDAY_FIRST = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
LABEL_MAX = 31          # labels longer than this are cut
LABEL_KEEP = 28         # to this many characters, then "..."


def month_file_name(year: Column, month: Column) -> Column:
    """``yellow_tripdata_YYYY-MM.parquet`` for a year and month column."""
    y, m = year.cast("int"), month.cast("int")
    # A formatter per row is slow: years of four digits, the usual ones, are put together from their text.
    usual = F.concat(F.lit("yellow_tripdata_"), y.cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"),
                     F.lit(".parquet"))
    return F.when(y.between(1000, 9999) & m.between(0, 99), usual).otherwise(F.format_string(MONTH_FILE_FORMAT, y, m))


def short_label(c: Column) -> Column:
    """Cut a label over 31 characters to 28 characters plus ``...``."""
    s = c.cast("string")
    return F.when(F.length(s) > LABEL_MAX,
                  F.concat(F.substring(s, 1, LABEL_KEEP), F.lit("..."))).otherwise(s)


def weekday_label(dow0: Column) -> Column:
    """Label for a 0..6 weekday number with Sunday = 0."""
    return F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_LABELS_SUNDAY_FIRST]),
                        dow0.cast("int") + 1)


def fmt_num(c: Column, ndigits: int = 2) -> Column:
    """Thousands separators and fixed decimals; ``-`` for null."""
    return F.coalesce(F.format_number(c, ndigits), F.lit("-"))


def fmt_money(c: Column, ndigits: int = 2) -> Column:
    """``$1234.56``, without separators; ``-`` for null."""
    return F.coalesce(F.format_string(f"$%.{ndigits}f", c.cast("double")), F.lit("-"))


def passenger_group(c: Column) -> Column:
    """``Unknown`` for null, ``4+`` from four up, else the number as text."""
    return (F.when(c.isNull(), F.lit("Unknown"))
             .when(c >= 4, F.lit("4+"))
             .otherwise(c.cast("string")))

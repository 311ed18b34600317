"""Column expressions; all are built-in functions and stay inside code generation."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# Fixed values here: the status words, the separator of ids, the ISO and day forms, the mark #!name#.


def kpi_text(duration: Column | str, threshold) -> Column:
    """``NOK`` above the threshold; at the threshold and below it ``OK``."""
    return F.when(_col(duration) > _lit(threshold), "NOK").otherwise("OK")


def kpi_value(duration: Column | str, threshold) -> Column:
    """1 above the threshold, else 0."""
    return F.when(_col(duration) > _lit(threshold), 1).otherwise(0)


def document_id(process: Column | str, activity: Column | str, trace: Column | str) -> Column:
    """Parts joined by ``_``; a null part is left out together with its separator."""
    return F.concat_ws("_", _col(process), _col(activity), _col(trace))


def phase_id(phase: Column | str, instance: Column | str) -> Column:
    return F.concat_ws("_", _col(phase), _col(instance))


def utc_wall(ts: Column | str) -> Column:
    """A time as UTC wall time without a zone, in any session zone; times without a zone are UTC already."""
    plain = _col(ts).cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), plain)
    return F.when(F.typeof(_col(ts)) == "timestamp_ntz", plain).otherwise(shifted)


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text in UTC with milliseconds."""
    text = utc_wall(ts).cast("string")  # formatting by pattern would go by the session zone
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis, F.lit("Z"))


def day_name(prefix: str, ts: Column | str) -> Column:
    """Name of the daily target of the UTC day, such as ``bam-2024.01.31``."""
    return F.concat(F.lit(prefix), F.translate(utc_wall(ts).cast("date").cast("string"), "-", "."))


def millis_between(start: Column | str, end: Column | str) -> Column:
    """Whole milliseconds from start to end, each cut to the millisecond first."""
    return F.timestamp_diff(
        "MILLISECOND",
        F.date_trunc("millisecond", _col(start)),
        F.date_trunc("millisecond", _col(end)),
    )


def fill_template(template: Column | str, values: Mapping[str, Column]) -> Column:
    """Put values in the places ``#!name#`` of a text, as they stand; null becomes empty."""
    text = _lit(template)
    for name, value in values.items():
        text = F.replace(text, F.lit(f"#!{name}#"), F.coalesce(value.cast("string"), F.lit("")))
    return text

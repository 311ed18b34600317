from spanwatch.functions.expressions import (
    day_name,
    document_id,
    fill_template,
    iso_utc,
    kpi_text,
    kpi_value,
    millis_between,
    phase_id,
    utc_wall,
)

__all__ = [
    "day_name",
    "document_id",
    "fill_template",
    "iso_utc",
    "kpi_text",
    "kpi_value",
    "millis_between",
    "phase_id",
    "utc_wall",
]

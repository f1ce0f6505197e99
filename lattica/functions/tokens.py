"""Source tokens to typed observations: columns of struct<raw, value, status>.

A null is never a zero.  An unknown token fails the query when it is computed;
with ``strict=False`` it becomes the status ``invalid`` instead, for the gates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NUMERIC

DECIMAL = "decimal(38,6)"


def strip(raw: Column) -> Column:
    """Trim every kind of white space, ideographic spaces too."""
    return F.regexp_replace(raw, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def clean_text(raw: Column) -> Column:
    """Trimmed; empty becomes null."""
    return F.nullif(strip(raw), F.lit(""))


def number(raw: Column) -> Column:
    """A count with thousands commas, else null."""
    return F.regexp_replace(strip(raw), ",", "").try_cast(DECIMAL)


def _unknown(raw: Column, strict: bool, what: str) -> Column:
    if not strict:
        return F.lit("invalid")
    return F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(raw, F.lit("null")))).cast("string")


def _observation(raw: Column, status: Column, value: Column, keeps=NUMERIC) -> Column:
    return F.struct(strip(raw).alias("raw"), F.when(status.isin(*keeps), value).alias("value"), status.alias("status"))


def _count_status(raw: Column, strict: bool) -> Column:
    t, n = strip(raw), number(raw)
    return (
        F.when(raw.isNull() | (t == ""), "source_absent")
        .when(t.isin("X", "x"), "suppressed")
        .when(t == "...", "not_surveyed")
        .when(t == "-", "not_applicable")
        .when(n.isNull() | (n < 0), _unknown(raw, strict, "count token"))
        .when(n == 0, "observed_zero")
        .otherwise("observed")
    )


def estat_count(raw: Column, strict: bool = True) -> Column:
    """A published count: number, or a sign for suppressed, not surveyed, not applicable, absent."""
    return _observation(raw, _count_status(raw, strict), number(raw))


def s12_count(raw: Column, existence: Column, duplicate: Column, strict: bool = True) -> Column:
    """A ridership count: the record's existence code, then its duplicate code, then the token decide."""
    status = (
        F.when(~F.coalesce(existence.isin("1", "2", "3", "4") & duplicate.isin("1", "2", "3"), F.lit(False)), _unknown(F.concat_ws("/", existence, duplicate), strict, "existence or duplicate code"))
        .when((existence == "4") | (duplicate == "3"), "station_absent")
        .when(existence == "3", "not_public")
        .when(existence == "2", "source_absent")
        .when(duplicate == "2", "duplicate_on_other_record")
        .otherwise(_count_status(raw, strict))
    )
    return _observation(raw, status, number(raw))


def census_count(raw: Column, code: Column, strict: bool = True) -> Column:
    """A census count: code 2 is suppressed even with a number, code 1 holds others' counts and needs a number."""
    plain = _count_status(raw, strict)
    status = (
        F.when(~F.coalesce(code.isin("0", "1", "2"), F.lit(False)), _unknown(code, strict, "processing code"))
        .when(code == "2", "suppressed")
        .when((code == "1") & plain.isin(*NUMERIC), "aggregation_destination")
        .when(code == "1", _unknown(raw, strict, "destination without a number"))
        .otherwise(plain)
    )
    return _observation(raw, status, number(raw), (*NUMERIC, "aggregation_destination"))


def district_cell(raw: Column, unit: Column, million: str = "百万円", strict: bool = True) -> Column:
    """A cell of a district sheet: a zero in millions is below the rounding unit, not nothing."""
    n = raw.try_cast(DECIMAL)
    status = (
        F.when(raw.isNull() | (raw == ""), "not_reported")
        .when(raw.isin("x", "X"), "suppressed")
        .when(raw == "-", "not_applicable")
        .when(n.isNull(), _unknown(raw, strict, "district token"))
        .when((n == 0) & (unit == million), "below_rounding_unit")
        .otherwise("observed")
    )
    return _observation(raw, status, n, ("observed", "below_rounding_unit"))


def plain_or_symbol(raw: Column) -> Column:
    """Digits and commas are a number, anything else an unresolved symbol."""
    good = F.coalesce(raw.rlike("^[0-9,]+$") & raw.rlike("[0-9]"), F.lit(False))
    return F.struct(strip(raw).alias("raw"), F.when(good, number(raw)).alias("value"), F.when(good, "observed").otherwise("symbol_unresolved").alias("status"))


def integral(value: Column) -> Column:
    """The value as a long; a fraction fails."""
    return F.when(value.isNull() | (value == F.floor(value)), value.cast("long")).otherwise(F.raise_error(F.concat(F.lit("not integral: "), value.cast("string"))).cast("long"))


def triplet(name: str, observation: str) -> list[Column]:
    """Flat columns ``name_raw``, ``name_value``, ``name_status`` of an observation column."""
    return [F.col(f"{observation}.{part}").alias(f"{name}_{part}") for part in ("raw", "value", "status")]


def missing_reason(status: Column) -> Column:
    """A text for a reader, null where a value is there."""
    texts = {"suppressed": "withheld by the source", "not_public": "not published", "not_surveyed": "not surveyed", "not_applicable": "not applicable", "source_absent": "no source row", "duplicate_on_other_record": "counted on another record", "station_absent": "station did not exist", "outside_scope": "outside the scope", "ambiguous_multiple_records": "several records disagree"}
    out = F.when(status.isin(*NUMERIC), F.lit(None).cast("string"))
    for k, v in texts.items():
        out = out.when(status == k, v)
    return out.otherwise(status)


def money_label(value: Column, status: Column) -> Column:
    """Millions shown in hundreds of millions; a reason instead of a number where there is none."""
    return F.when(value.isNotNull(), F.concat(F.format_number(value.cast("double") / 100, 1), F.lit(" 億円"))).otherwise(F.coalesce(missing_reason(status), F.lit("—")))


def format_value(value: Column) -> Column:
    """A dash for null; zero stays zero."""
    return F.coalesce(F.format_number(value, 0), F.lit("—"))

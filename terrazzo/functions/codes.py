"""District numbers 1..20, five-character area codes (75100 + district) and income zone codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_DISTRICT, LAST_DISTRICT = 1, 20
CODE_BASE = 75100
ZONE_PREFIX = "75"


def area_codes() -> list[str]:
    return [str(CODE_BASE + n) for n in range(FIRST_DISTRICT, LAST_DISTRICT + 1)]


def in_city(district: Column | str) -> Column:
    """The district is one of the twenty."""
    return (F.col(district) if isinstance(district, str) else district).between(FIRST_DISTRICT, LAST_DISTRICT)


def is_area_code(code: Column | str) -> Column:
    """Text is one of the twenty area codes; 75100 (the whole city) is not.

    A membership test, which unlike a pattern is pushed into Parquet scans.
    """
    return (F.col(code) if isinstance(code, str) else code).isin(area_codes())


def district_of_code(code: Column | str) -> Column:
    """`'75107'` to 7."""
    code = F.col(code) if isinstance(code, str) else code
    return (code.try_cast("int") - CODE_BASE).try_cast("smallint")


def code_of_district(district: Column | str) -> Column:
    """7 to `'75107'`."""
    district = F.col(district) if isinstance(district, str) else district
    return F.concat(F.lit("751"), F.lpad(district.cast("string"), 2, "0"))


def district_of_zone(zone: Column | str) -> Column:
    """`'751072605'` to 7: characters 4 and 5."""
    zone = F.col(zone) if isinstance(zone, str) else zone
    return F.substring(zone, 4, 2).try_cast("smallint")


def district_of_request(text: Column | str) -> Column:
    """District asked for as `'75101'`, `'1'`; null for `'all'`, empty and anything else."""
    text = F.col(text) if isinstance(text, str) else text
    number = F.trim(text).try_cast("int")
    return F.when(
        number.between(CODE_BASE + FIRST_DISTRICT, CODE_BASE + LAST_DISTRICT), number - CODE_BASE
    ).when(in_city(number), number)


def parse_district(request: str | int | None) -> int | None:
    """The same rule for one argument of a report."""
    text = "" if request is None else str(request).strip()
    digits = text.lstrip("+")
    if not (digits.isascii() and digits.isdigit()):
        return None
    number = int(text)
    if CODE_BASE + FIRST_DISTRICT <= number <= CODE_BASE + LAST_DISTRICT:
        return number - CODE_BASE
    return number if FIRST_DISTRICT <= number <= LAST_DISTRICT else None

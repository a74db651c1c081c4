"""Column functions: identifiers, text fields, guarded numerics, digests.

Everything here returns a Column built from Spark built-ins, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal notation accepted as a number; a suffix such as "1.5d" is text.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space on both ends."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def strip_version(c: Column | str, trim_first: bool = False) -> Column:
    """Identifier without its version suffix, for comparison keys only.

    The default splits at the first dot and then trims, with null or empty input
    giving ``""``; ``trim_first`` trims before the split.
    """
    text = F.coalesce(_col(c), F.lit(""))
    if trim_first:
        return F.substring_index(strip(text), ".", 1)
    return strip(F.substring_index(text, ".", 1))


def finite_or_null(c: Column | str) -> Column:
    """Text to double; anything unparsable or non-finite becomes null."""
    text = _col(c)
    value = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return only_finite(value)


def only_finite(c: Column | str) -> Column:
    value = _col(c)
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def after_first(c: Column | str, delimiter: str) -> Column:
    """Text after the first delimiter, trimmed; ``""`` when there is none."""
    text = _col(c)
    at = F.instr(text, delimiter)
    return F.when(at > 0, strip(F.substr(text, at + F.lit(len(delimiter))))).otherwise(F.lit(""))


def after_last(c: Column | str, delimiter: str) -> Column:
    """Text after the last delimiter, trimmed; the whole text when there is none."""
    return strip(F.substring_index(_col(c), delimiter, -1))


def normalise_key(c: Column | str) -> Column:
    return F.lower(strip(c))


def normalise_value(c: Column | str) -> Column:
    """Trim and turn non-breaking spaces into plain ones."""
    return F.regexp_replace(strip(c), r"\u00A0", " ")


def regex_first(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First capture, or null when the pattern does not occur."""
    found = F.regexp_extract(_col(c), pattern, group)
    return F.when(_col(c).rlike(pattern), found)


def regex_last(c: Column | str, pattern: str, max_chars: int = 170) -> Column:
    """Last whole match, trimmed and cut to ``max_chars``; ``""`` without a match."""
    hits = F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(0))
    return F.coalesce(F.substring(strip(F.try_element_at(hits, F.lit(-1))), 1, max_chars), F.lit(""))


def ratio(a: Column | str, b: Column | str) -> Column:
    """Quotient, null on a zero denominator."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def pct(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(F.lit(100.0) * _col(a), _col(b).cast("double"))


def signif(c: Column | str, digits: int) -> Column:
    """Round to a number of significant digits."""
    x = _col(c).cast("double")
    power = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * power) / power)


def map_get(m: Column | str, key: str, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(_col(m), F.lit(key)), F.lit(default))


def list_equals(c: Column | str, values: list[str]) -> Column:
    return F.coalesce(_col(c) == F.array(*[F.lit(v) for v in values]), F.lit(False))


def list_empty(c: Column | str) -> Column:
    return F.coalesce(F.size(_col(c)) == 0, F.lit(True))


def sha256(c: Column | str) -> Column:
    return F.sha2(_col(c).cast("string"), 256)


def analysis_id(*fields: Column | str) -> Column:
    """Identity of an analysis: digest over its named inputs, in the given order."""
    return F.sha2(F.to_json(F.struct(*[_col(f) for f in fields])), 256)


def row_digest_lanes(columns: list[str], lanes: int = 4) -> list[Column]:
    """Four 60-bit integers out of the SHA-256 of a row, summable without overflow in a decimal."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    digest = F.sha2(F.concat_ws("\u001f", *cells), 256)
    return [
        F.conv(F.substring(digest, 16 * i + 1, 15), 16, 10).cast("decimal(38,0)").alias(f"lane_{i}")
        for i in range(lanes)
    ]

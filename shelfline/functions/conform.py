"""Cleansing and conforming rules for raw price records, as Column expressions.

All rules run inside whole-stage codegen (no Python per row).  Notes on
edge cases:

* whitespace trimming takes the characters of Unicode ``\\s`` (Java ``(?U)``); the
  C0 separator characters 0x1C-0x1F are not trimmed.
* a settlement code counts as numeric when it is made of ASCII digits.
* ``nan``/``inf``/``infinity`` prices are accepted as text (like a float
  parser would) and become NULL when typed as ``decimal(12,4)``; so does any
  value out of the decimal range.  ``typing_losses`` counts them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.schemas import PRICE

UNKNOWN_PREFIX = "(unknown:"
DIGITS = "0123456789"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# White space as Java's (?U)\s has it.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing (Unicode) whitespace, without a regular expression per value."""
    return F.btrim(_col(c), F.lit(WHITE))


def strip_quotes(c: str | Column) -> Column:
    """Remove double quotes at both ends."""
    return F.btrim(_col(c), F.lit('"'))


def clean_field(c: str | Column) -> Column:
    """Strip whitespace, then strip double quotes at both ends (no second trim)."""
    return strip_quotes(strip_ws(c))


def is_ascii_digits(c: str | Column) -> Column:
    """Non-empty and made of 0-9 only (no regular expression)."""
    x = _col(c)
    return (x != "") & (F.btrim(x, F.lit(DIGITS)) == "")


def blank_to_null(c: str | Column) -> Column:
    """Trim; a blank value becomes NULL."""
    return F.nullif(strip_ws(_col(c).cast("string")), F.lit(""))


def _zfill(c: Column, width: int = 5) -> Column:
    """Left-pad with zeros to ``width`` after an optional sign; never truncates."""
    signed = c.rlike(r"^[+-]")
    body = F.substring(c, 2, 1 << 30)
    padded = F.when(signed, F.concat(F.substring(c, 1, 1), F.lpad(body, width - 1, "0"))) \
              .otherwise(F.lpad(c, width, "0"))
    return F.when(F.length(c) < width, padded).otherwise(c)


def settlement_code_parts(c: str) -> dict[str, Column]:
    """Intermediate columns of the settlement-code rule over column ``c`` (already cleaned).

    ``_code`` the trimmed code, ``_dash`` the place of its first dash, and
    ``_pre`` the part before it, trimmed where there is a dash.  Separate
    columns, so a plan works each out once per row.
    """
    code = strip_ws(c)
    dash = F.instr(code, "-")
    pre = F.when(dash > 0, strip_ws(F.substring_index(code, "-", 1))).otherwise(code)
    return {"_code": code, "_dash": dash, "_pre": pre}


def settlement_code_of_parts() -> Column:
    """Canonical settlement code from ``settlement_code_parts`` columns.

    ``068134`` -> ``68134``, ``2659`` -> ``02659``, ``068134-04`` -> ``68134-04``;
    a non-numeric code is kept as is; all zeros -> ``00000``.  With a dash,
    the part before the first dash is normalised and the rest re-attached.
    """
    code, dash, pre = F.col("_code"), F.col("_dash"), F.col("_pre")
    bare = F.ltrim(pre, F.lit("0"))
    plain = F.when((pre == "") | ~is_ascii_digits(pre), pre).otherwise(
        F.when(F.length(bare) >= 5, bare).otherwise(F.lpad(bare, 5, "0")))
    return F.when(dash > 0, F.concat(plain, F.lit("-"), F.substring(code, dash + 1, 1 << 30))).otherwise(plain)


def settlement_probes(code: str | Column) -> tuple[Column, Column, Column]:
    """Lookup probes in order: as is, zero-filled to 5, leading zeros stripped."""
    c = _col(code)
    stripped = F.ltrim(c, F.lit("0"))
    return c, _zfill(c, 5), F.when(stripped == "", c).otherwise(stripped)


def unknown_name(code: str | Column) -> Column:
    return F.concat(F.lit(UNKNOWN_PREFIX), _col(code), F.lit(")"))


def is_unknown(name: str | Column) -> Column:
    return _col(name).startswith(UNKNOWN_PREFIX)


# Fixed value: what a float parser accepts, written as a pattern (digits may
# be grouped with single underscores).
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_PATTERN = (
    r"(?i)^\s*[+-]?(?:(?:" + _DIGITS + r")(?:\.(?:" + _DIGITS + r")?)?|\.(?:" + _DIGITS + r"))"
    r"(?:e[+-]?" + _DIGITS + r")?\s*$"
)
NONFINITE_PATTERN = r"(?i)^\s*[+-]?(?:nan|inf|infinity)\s*$"


def price_text(c: str | Column) -> Column:
    """Trimmed and unquoted price text with a decimal point."""
    return F.replace(clean_field(c), F.lit(","), F.lit("."))


def valid_price_text(c: str | Column) -> Column:
    """A ``price_text`` that is a number, kept as written; else ''."""
    x = _col(c)
    return F.when((x != "") & is_float_text(x), x).otherwise(F.lit(""))


def is_float_text(c: str | Column) -> Column:
    """What a float parser accepts (see ``FLOAT_PATTERN``).

    Plain decimals (digits with at most one point) are recognised without a
    regular expression; everything else is checked with the full pattern.
    """
    x = _col(c)
    # What digits at both ends leave of a plain decimal is its point, if any.
    plain = F.btrim(x, F.lit(DIGITS)).isin("", ".") & ~x.isin("", ".")
    return plain | x.rlike(FLOAT_PATTERN) | x.rlike(NONFINITE_PATTERN)


def price_value(text: str | Column) -> Column:
    """Typed price: blank -> NULL, else ``decimal(12,4)`` (NULL when it does not fit)."""
    return trimmed_price_value(blank_to_null(text))


def trimmed_price_value(cell: str | Column) -> Column:
    """``price_value`` of a text that is trimmed, and NULL where blank."""
    return F.replace(_col(cell), F.lit("_"), F.lit("")).try_cast(PRICE)


def typing_losses(text: str | Column) -> Column:
    """1 when a non-blank price text cannot be typed as ``decimal(12,4)``."""
    return F.when(price_value(text).isNull() & blank_to_null(text).isNotNull(), 1).otherwise(0)


def delimiter_of(first_line: str | Column) -> Column:
    """``;`` iff the line has more semicolons than commas, else ``,``."""
    line = _col(first_line)
    semis = F.length(line) - F.length(F.regexp_replace(line, ";", ""))
    commas = F.length(line) - F.length(F.regexp_replace(line, ",", ""))
    return F.when(semis > commas, F.lit(";")).otherwise(F.lit(","))


def first_line(text: str | Column) -> Column:
    """Text up to the first line break (``\\r\\n``, ``\\n`` or ``\\r``)."""
    return F.regexp_extract(_col(text), r"^([^\r\n]*)", 1)


def file_stem(name: str | Column) -> Column:
    """File name without a trailing lower-case ``.csv``."""
    n = _col(name)
    return F.when(n.endswith(".csv"), F.substring(n, F.lit(1), F.length(n) - 4)).otherwise(n)


def company_from_file(name: str | Column) -> tuple[Column, Column]:
    """(company_name, uic) of ``<company>_<uic>.csv``: split on the last ``_``.

    Only a lower-case ``.csv`` is removed; without ``_`` the name is the whole
    stem and the UIC is ''.
    """
    stem = file_stem(name)
    has_sep = F.instr(stem, "_") > 0
    last = F.substring_index(stem, "_", -1)
    company = F.when(has_sep, F.substring(stem, F.lit(1), F.length(stem) - F.length(last) - 1)) \
               .otherwise(stem)
    uic = F.when(has_sep, last).otherwise(F.lit(""))
    return company, uic


def date_attributes(iso: str | Column) -> list[Column]:
    """date, year, month, day, weekday (Monday = 0) of an ISO date string."""
    d = F.to_date(_col(iso))
    return [d.alias("date"), F.year(d).alias("year"), F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"), F.weekday(d).alias("weekday")]

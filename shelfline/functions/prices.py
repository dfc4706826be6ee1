"""Price rules of the serving layer, as Column expressions.

Two effective-price rules exist and both are kept:

* ``effective_price`` (browse projection, grouped prices): a missing retail
  price stays missing unless a positive promo price exists.
* ``effective_price_zero_filled`` (the three reports): a missing retail
  price counts as 0.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(12,4)"

# The price offsets a report accepts.  Anything else means the
# current day.
OFFSET_CURRENT = "current"
OFFSET_DAY1 = "day1"
OFFSET_DAY2 = "day2"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def effective_price(retail: str | Column = "retail_price",
                    promo: str | Column = "promo_price") -> Column:
    """Null-keeping price: least(retail, promo) when promo > 0, else retail.

    ``least`` skips NULLs, so a missing retail with a positive promo gives the
    promo; a promo of 0 or below is ignored; both missing gives NULL.
    """
    r, p = _col(retail), _col(promo)
    return F.coalesce(F.when(p.isNotNull() & (p > 0), F.least(r, p)).otherwise(r), r)


def effective_price_zero_filled(retail: str | Column = "retail_price",
                                promo: str | Column = "promo_price") -> Column:
    """Report price: missing retail counts as 0, positive promo caps it."""
    r, p = F.coalesce(_col(retail), F.lit(0).cast(PRICE_TYPE)), _col(promo)
    return F.when(p.isNotNull() & (p > 0), F.least(r, p)).otherwise(r)


def positive_promo(promo: str | Column = "promo_price") -> Column:
    """The promo price when it is above zero, else NULL (grouped promo stats)."""
    p = _col(promo)
    return F.when(p.isNotNull() & (p > 0), p)


def price_columns_for_offset(offset: str | None) -> tuple[str, str]:
    """Names of the (retail, promo) pair a report reads for ``offset``."""
    if offset == OFFSET_DAY1:
        return "retail_price_day1", "promo_price_day1"
    if offset == OFFSET_DAY2:
        return "retail_price_day2", "promo_price_day2"
    return "retail_price", "promo_price"


def format_date_bg(iso: str | Column) -> Column:
    """``YYYY-MM-DD`` -> ``DD.MM.YYYY``; NULL or '' -> ''; not three parts -> unchanged."""
    c = _col(iso).cast("string")
    parts = F.split(c, "-", -1)
    return (F.when(c.isNull() | (c == ""), F.lit(""))
            .when(F.size(parts) == 3,
                  F.concat_ws(".", parts.getItem(2), parts.getItem(1), parts.getItem(0)))
            .otherwise(c))


def format_price_2dp(price: str | Column) -> Column:
    """NULL -> an em dash, else the price with two decimals (half up on the decimal)."""
    c = _col(price)
    rounded = F.round(c.cast(PRICE_TYPE), 2).cast("decimal(14,2)")
    return F.when(c.isNull(), F.lit("—")).otherwise(rounded.cast("string"))


# Fixed value: the shape a user-typed price bound must have.
PRICE_BOUND_PATTERN = r"^\d+([.,]\d{1,2})?$"


BOUND_TYPE = "decimal(38,2)"
BOUND_MAX = "9" * 36


def parse_price_bound(text: str | Column) -> Column:
    """User price bound as a decimal: blank or malformed -> NULL (no bound).

    A number with more digits than a decimal holds is above every price; it
    becomes the largest one.
    """
    t = F.trim(_col(text).cast("string"))
    number = F.coalesce(F.regexp_replace(t, ",", ".").try_cast(BOUND_TYPE), F.lit(BOUND_MAX).cast(BOUND_TYPE))
    return F.when(t.rlike(PRICE_BOUND_PATTERN), number)


def parse_price_bound_value(text: str | None) -> Decimal | None:
    """Driver-side check of a price-bound parameter (same rule as above)."""
    import re

    if text is None:
        return None
    t = str(text).strip()
    if not t or not re.match(PRICE_BOUND_PATTERN, t):
        return None
    return min(Decimal(t.replace(",", ".")), Decimal(BOUND_MAX))

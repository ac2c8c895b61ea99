"""Numbers as text, rounded as C and Python do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientela.functions.columns import as_column

HIGH_BITS = 56
LOW_BITS = 20


def fixed(value: Column | str, digits: int) -> Column:
    """Text of a number with ``digits`` decimals, like ``f"{v:.2f}"``.

    Rounds the binary value itself, ties to even. ``format_string`` rounds the
    shortest decimal text instead: 0.865, slightly below its decimal text, would
    print as 0.87 rather than 0.86. Sign and whole part are taken off first, so only
    the fraction is scaled; numbers from 2^53 on have none. Null, NaN and infinity
    give null.
    """
    number = as_column(value).cast("double")
    known = F.abs(number) < F.lit(float(1 << 62))
    size = F.when(known, F.abs(number))
    whole = F.floor(size)
    unit = f"{1 << (HIGH_BITS + LOW_BITS)}BD"
    ten = 10**digits
    # The fraction times 2^76 as a whole number; both steps are exact in binary.
    exact = (size - whole.cast("double")) * float(1 << HIGH_BITS)
    high = F.floor(exact)
    tail = (exact - high.cast("double")) * float(1 << LOW_BITS)
    low = F.floor(tail)
    more = tail > low.cast("double")
    scaled = high.cast("decimal(20,0)") * F.lit(1 << LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(8,0)")
    total = (scaled * F.lit(ten).cast("decimal(8,0)")).cast("decimal(38,0)")
    kept = F.call_function("div", total, F.expr(unit))
    rest = ((total - (kept.cast("decimal(15,0)") * F.expr(unit)).cast("decimal(38,0)")) * 2).cast("decimal(38,0)")
    # With no decimals the digit before a tie is the last of the whole part.
    odd = (whole % 2 == 1) if digits == 0 else (kept % 2 == 1)
    kept = kept + ((rest > F.expr(unit)) | ((rest == F.expr(unit)) & (more | odd))).cast("int")
    # A fraction that rounds up to one is carried into the whole part.
    carried = whole + (kept >= ten).cast("int")
    text = carried.cast("string")
    if digits:
        text = F.concat(text, F.lit("."), F.lpad((kept % ten).cast("string"), digits, "0"))
    return F.when(number < 0, F.concat(F.lit("-"), text)).otherwise(text)


def percent(value: Column | str, digits: int = 1) -> Column:
    """Share as a percentage text, like ``f"{v:.1%}"``."""
    return F.concat(fixed(as_column(value) * 100.0, digits), F.lit("%"))

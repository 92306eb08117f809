"""32-bit activity bitmaps from date lists (operators F4, F5).

Bit for day offset ``k`` (0 = run date) is ``2^(31-k)``: the run date is the
leftmost bit of the 32-character rendering.  The bitmap is built with one
higher-order fold per row, so it is a narrow projection (no date-spine cross
join, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_DAYS = 31
MASK_32 = 0xFFFFFFFF
# fixed value: bits 31..25, i.e. the run date and the six days before it
WEEK_MASK = int("11111110000000000000000000000000", 2)


def activity_bitmap(dates: Column, run_date: Column, legacy_offset: bool = False) -> Column:
    """OR of ``1 << (31 - k)`` over the distinct active days ``k`` in ``[0, 30]``.

    ``legacy_offset=True`` uses the exponent ``32 - k`` and keeps the low 32 bits,
    which loses the run date (reproduces the lab variant).
    """
    in_window = F.filter(dates, lambda d: F.datediff(run_date, d).between(0, WINDOW_DAYS - 1))
    top = 32 if legacy_offset else 31
    bits = F.transform(in_window, lambda d: F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(top) - F.datediff(run_date, d)))
    folded = F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(b))
    return folded.bitwiseAND(F.lit(MASK_32))


def bits_text(bitmap: Column) -> Column:
    """The bitmap as a 32-character 0/1 string, most recent day first."""
    return F.lpad(F.bin(bitmap), 32, "0")


def monthly_active(bitmap: Column) -> Column:
    return F.bit_count(bitmap) > 0


def weekly_active(bitmap: Column) -> Column:
    return F.bit_count(bitmap.bitwiseAND(F.lit(WEEK_MASK))) > 0

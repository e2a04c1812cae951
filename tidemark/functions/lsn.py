"""Log sequence numbers: ``hi/lo`` hex text and its 64-bit value.

Text order is wrong for these ("0/9" > "0/10"), so everything ordered by log
position uses the numeric form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the high half of a log position counts 2^32 steps.
_HIGH = 4294967296


def lsn_to_num(lsn: Column) -> Column:
    """``hi/lo`` hex text to a decimal(20,0); null for text of another form."""
    well_formed = lsn.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    high = F.conv(F.substring_index(lsn, "/", 1), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring_index(lsn, "/", -1), 16, 10).cast("decimal(20,0)")
    return F.when(
        well_formed,
        (high * F.lit(_HIGH).cast("decimal(10,0)") + low).cast("decimal(20,0)"),
    )


def num_to_lsn(num: Column) -> Column:
    """The inverse; the low half keeps eight digits, as in ``0/00ABC123``."""
    step = F.lit(_HIGH).cast("decimal(20,0)")
    value = num.cast("decimal(20,0)")
    high = F.floor(value / step).cast("bigint")
    low = (value % step).cast("bigint")
    return F.concat(F.hex(high), F.lit("/"), F.lpad(F.hex(low), 8, "0"))

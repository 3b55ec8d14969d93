"""Money strings and pay points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rategrid.functions.text import WHITE_SPACE, trim_space

# Fixed value: footnote marks seen after a level name or a pay point.
FOOTNOTE_MARKS = "*#^"


def money_to_double(text: Column) -> Column:
    """Strip ``$``, ``,`` and blanks; anything but a plain decimal becomes NULL."""
    bare = F.translate(text, "$," + WHITE_SPACE, "")
    return F.when(bare.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), bare.try_cast("double"))


def is_money(text: Column) -> Column:
    """Whether ``money_to_double`` gives a number; for tests on many cells."""
    return text.rlike(
        r"(?U)^[$,\s]*(?:-[$,\s]*)?[0-9][$,\s0-9]*(?:\.[$,\s]*[0-9][$,\s0-9]*)?$"
    )


def dollar_label(amount: Column) -> Column:
    """Axis label, for example ``$20,000``."""
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def strip_footnote_marks(text: Column) -> Column:
    """Level name without trailing footnote marks."""
    return F.regexp_replace(trim_space(text), r"(?U)[\s*#^]+$", "")


def strip_footnote_digit(pay_point: Column) -> Column:
    """Pay points have one digit; a second one is a footnote and is dropped."""
    return F.regexp_replace(strip_footnote_marks(pay_point), r"^([0-9])[0-9]$", "$1")

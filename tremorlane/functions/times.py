"""Event time parsing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted layouts are yyyy-MM-dd HH:mm:ss and
# yyyy.MM.dd HH:mm:ss.
DATE_SEPARATORS = ("-", ".")


def _layout(separator: str) -> str:
    # Every field at full width, nothing before or after, no year zero.
    mark = re.escape(separator)
    return rf"\A(?!0000)\d{{4}}{mark}\d\d{mark}\d\d \d\d:\d\d:\d\d\z"


def parse_event_time(text: Column, separators: Sequence[str] = DATE_SEPARATORS) -> Column:
    """Wall-clock time of the first layout that fits, else NULL.

    The text is checked against each layout before the conversion. A failed
    date-pattern parse costs an exception per row (about twice the time of the
    whole expression where both layouts are common), and a bare cast would
    accept fractions, zones and short fields. The result has no time zone, so
    it does not depend on the session's zone or on its daylight saving gaps.
    """
    return F.coalesce(
        *(
            F.when(
                text.rlike(_layout(separator)),
                F.replace(text, F.lit(separator), F.lit("-")).try_cast("timestamp_ntz"),
            )
            for separator in separators
        )
    )

"""Display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _txt(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    # A missing value prints as the word None.
    return F.coalesce(col.cast("string"), F.lit("None"))


def display_label(trip_col="trip_id", route_name_col="route_short_name",
                  headsign_col="trip_headsign") -> Column:
    """``Trip: x | Route: y | Headsign: z``."""
    return F.concat(F.lit("Trip: "), _txt(trip_col), F.lit(" | Route: "), _txt(route_name_col),
                    F.lit(" | Headsign: "), _txt(headsign_col))

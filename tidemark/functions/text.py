"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what snapshots write for booleans
TRUE_TEXTS, FALSE_TEXTS = ("t", "true", "1"), ("f", "false", "0")


def bool_of_text(c: Column) -> Column:
    """Boolean of a text in any case and with spaces around; null where it is neither."""
    bare = F.lower(F.trim(c))
    return F.when(bare.isin(*TRUE_TEXTS), True).when(bare.isin(*FALSE_TEXTS), False)

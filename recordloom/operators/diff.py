"""Comparing two snapshots of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compared(old: DataFrame, new: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Every key of either side with its state: added, missing, changed or matched. One full join on the key."""
    a = old.select(*key, F.struct(*values).alias("__old"))
    b = new.select(*key, F.struct(*values).alias("__new"))
    state = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "missing").when(F.col("__old").eqNullSafe(F.col("__new")), "matched").otherwise("changed")
    return a.join(b, list(key), "full").select(*key, state.alias("state"), "__old", "__new")


def events(old: DataFrame, new: DataFrame, key: Sequence[str], status: str) -> DataFrame:
    """What happened between two snapshots: ``added`` rows and changes of a status, with both values."""
    c = compared(old, new, key, [status]).where("state in ('added', 'changed')")
    kind = F.when(F.col("state") == "added", "added").otherwise("status_changed")
    return c.select(*key, kind.alias("event_type"), F.col(f"__old.{status}").alias("from_value"), F.col(f"__new.{status}").alias("to_value"))

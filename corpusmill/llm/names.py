"""Names for columns that an operator adds for a while to a table whose columns it does not know."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, lengthened until no column of `df` and none of the names before it is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found

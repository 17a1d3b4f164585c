"""Column-name helpers that run on the driver (headers are metadata-sized)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column reference that survives dots, spaces and back-ticks in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def tidy_name(name) -> str:
    """Strip a column name and collapse inner whitespace; case is kept."""
    return " ".join(str(name).split())


def unique_names(names: list[str], on_collision: str = "suffix") -> list[str]:
    """Give repeated names `_1`, `_2`, … in column order.

    Names that differ only in case collide too, since Spark resolves and writes columns without
    regard to case.
    """
    taken = {n.lower() for n in names}
    seen: set[str] = set()
    out = []
    for name in names:
        if name.lower() not in seen:
            out.append(name)
        elif on_collision == "error":
            raise ValueError(f"duplicate column name: {name!r}")
        else:
            k = 1
            while f"{name}_{k}".lower() in taken:
                k += 1
            out.append(f"{name}_{k}")
            taken.add(out[-1].lower())
        seen.add(out[-1].lower())
    return out

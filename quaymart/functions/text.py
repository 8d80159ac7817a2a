"""String helpers with the NULL rules of the SQL dialect they stand for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_skip_null(*parts: Column | str) -> Column:
    """``CONCAT(a, b)``: NULL parts count as empty text (``||`` is ``F.concat``)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def contains_ci(col: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; NULL text does not match."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.contains(F.lower(c), F.lit(needle.lower())), F.lit(False))


def distinct_list(col: Column | str, sep: str = ", ") -> Column:
    """Sorted distinct values joined by ``sep``; NULL when there is none.

    ``collect_set`` is combined map-side and holds only the distinct values, so
    unlike ``listagg(DISTINCT ...)`` next to other aggregates it needs no
    row-multiplying Expand. Meant for short code lists such as payment types.
    """
    return F.nullif(F.array_join(F.sort_array(F.collect_set(col)), sep), F.lit(""))

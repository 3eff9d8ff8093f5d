"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(columns: Sequence[str]) -> Column:
    """Key values joined by ``_``; a NULL counts as an empty part so the arity stays."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def single_line(text: Column) -> Column:
    """The text without carriage returns and line feeds."""
    return F.regexp_replace(text, "[\\r\\n]", "")


def resplit(text: Column, old: str, new: str) -> Column:
    """Split on the literal ``old`` and join again with ``new``, empty parts included."""
    return F.array_join(F.split(text, f"\\Q{old}\\E", -1), new)


def numbered_label(prefix: Column, number: Column, suffix: Column) -> Column:
    """``prefix-number-suffix``; NULL when a part is NULL."""
    return F.concat(prefix, F.lit("-"), number.cast("string"), F.lit("-"), suffix)

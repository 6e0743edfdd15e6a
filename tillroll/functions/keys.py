"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import as_col


def surrogate_key(
    *cols: Column | str, null_token: str = V.KEY_NULL, sep: str = V.KEY_SEPARATOR
) -> Column:
    """md5 over the texts of the columns; a NULL counts as ``null_token``."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def record_hash(*cols: Column | str, sep: str = V.KEY_SEPARATOR) -> Column:
    """md5 over the texts of the columns; NULLs are skipped."""
    return F.md5(F.concat_ws(sep, *[as_col(c).cast("string") for c in cols]))

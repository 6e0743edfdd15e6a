"""Masking, hashing and coarsening of personal attributes, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import as_col, below, day


def postal_prefix(c: Column | str) -> Column:
    """First three characters plus ``**`` once dashes and outer blanks are gone."""
    code = F.regexp_replace(F.replace(as_col(c), F.lit("-"), F.lit("")), r"^\s+|\s+$", "")
    short = F.length(code) < 3
    return F.when(code.isNull(), F.lit(None).cast("string")).when(short, "***").otherwise(
        F.concat(F.left(code, F.lit(3)), F.lit("**"))
    )


def mask_email(c: Column | str) -> Column:
    """Keep the domain and the outer letters of the local part."""
    address = as_col(c)
    local = F.substring_index(address, "@", 1)
    domain = F.substring_index(address, "@", -1)
    one_at = F.length(address) - F.length(F.replace(address, F.lit("@"), F.lit(""))) == 1
    tail = F.when(F.length(local) > 1, F.right(local, F.lit(1))).otherwise("")
    return F.when(
        one_at, F.concat(F.left(local, F.lit(1)), F.lit("***"), tail, F.lit("@"), domain)
    ).when(address.isNotNull(), "***@***")


def hash_pii(c: Column | str, salt: str) -> Column:
    """md5 of the trimmed lower-case text followed by the salt."""
    return F.md5(F.concat(F.lower(F.trim(as_col(c))), F.lit(salt)))


def sha_lower(c: Column | str) -> Column:
    return F.sha2(F.lower(as_col(c)), 256)


def sha(c: Column | str) -> Column:
    return F.sha2(as_col(c), 256)


def age_bracket(born: Column | str, as_of) -> Column:
    """Bracket of the age in whole 365-day years."""
    years = F.floor(F.datediff(day(as_of), as_col(born)) / F.lit(365))
    return F.when(as_col(born).isNotNull(), below(years, V.AGE_LADDER, V.AGE_TOP))

"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column) -> Column:
    """60-bit key from the value's MD5; NULL when every input is NULL, so unmatched rows never join."""
    if len(cols) == 1:
        text = cols[0].cast("string")
    else:
        # length-prefixed parts, so ('ab', 'c') and ('a', 'bc') or NULL and '' never meet
        parts = [F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-"))
                 for c in cols]
        text = F.when(F.coalesce(*[c.cast("string") for c in cols]).isNotNull(), F.concat_ws("|", *parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")

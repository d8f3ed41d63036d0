"""Content-derived surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column | str) -> Column:
    """md5 over the natural key: the same row gets the same key in every run.

    Each part is written as `length:text` (`~` for NULL), so that different
    keys never yield the same text. Pass strings and integers only; the text of
    doubles and timestamps depends on the engine.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.md5(
        F.concat_ws(
            "|",
            *[
                F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~"))
                for t in texts
            ],
        )
    )

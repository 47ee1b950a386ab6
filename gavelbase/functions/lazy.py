"""Arrow UDFs that are made when first used, so that modules import without a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(schema: str) -> Callable:
    def wrap(f: Callable) -> Callable[..., Column]:
        made = cache(lambda: F.pandas_udf(f, schema))

        @wraps(f)
        def call(*cols) -> Column:
            return made()(*cols)

        return call

    return wrap

"""Bounded samples by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 40


def sampled(df: DataFrame, key: str, n: int, then: tuple[str, ...] = (), seed: int = 0) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest hash of ``key``, all if there are fewer; ties by key and ``then``.

    Rows are counted first and only about 2 n of them, by hash, are ordered, so what
    the tasks hand over does not grow with their number.
    """
    rate = min(1.0, (2 * n + 200) / max(1, df.count()))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_RANGE))
    return df.filter(place < int(rate * _RANGE)).orderBy(place, key, *then).limit(n)

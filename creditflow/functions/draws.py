"""Uniform draws in [0, 1) that depend only on a key and a salt.

Model scores are draws from fixed distributions. Taking the draw from a hash of the key
makes a replayed message, a retried task and a recomputed partition score alike. Where
fresh randomness is wanted, pass ``F.rand()`` in place of a keyed draw.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Draw = Callable[[str], Column]


def uniform(key: str, salt: str) -> Column:
    """The first 32 bits of ``md5(key:salt)`` as a fraction; ``key`` is a SQL expression."""
    digest = f"md5(cast(concat(cast({key} AS string), ':{salt}') AS binary))"
    return F.expr(f"cast(conv(substring({digest}, 1, 8), 16, 10) AS bigint) / 4294967296D")


def keyed_draws(key: str) -> Draw:
    """A source of draws, one per salt, all tied to the SQL expression ``key``."""
    return lambda salt: uniform(key, salt)

"""Cut a long history down to the keys a narrow run needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys are at most 40 characters, so this many stay well under 100 MB.
BROADCAST_ROWS = 500_000
# So few rows have their keys named in the plan: a scan of a bucketed, sorted history then
# skips buckets, row groups by their least and greatest key, and others by Bloom filter.
NAMED_ROWS = 1000


def keep_matching(
    history: DataFrame,
    wanted: DataFrame,
    key: str,
    wanted_rows: int,
    limit: int | None = None,
) -> DataFrame:
    """History rows whose key occurs in ``wanted``, if ``wanted`` is small.

    ``wanted_rows`` is a counted upper bound on the rows of ``wanted``. Within
    the limit the keys are broadcast, so history is filtered at the scan and its
    shuffle carries matches only; beyond it history passes unchanged and the
    join that follows does the same work with a shuffle. Both give one result,
    as that join drops or ignores unmatched history rows anyway.
    """
    if wanted_rows > (BROADCAST_ROWS if limit is None else limit):
        return history
    keys = wanted.filter(F.col(key).isNotNull()).select(key).distinct()
    if wanted_rows <= NAMED_ROWS:
        history = history.filter(F.col(key).isin([row[0] for row in keys.collect()]))
    return history.join(F.broadcast(keys), key, "left_semi")

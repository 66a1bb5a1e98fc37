"""Last write wins on a key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: Sequence[str], version: Sequence[str], keep_version: bool = False) -> DataFrame:
    """One row per key: the one with the highest version, without the version columns unless asked for.

    Filters on key columns reach the scan. The maximum of a struct is aggregated on sorted rows, before
    and after the shuffle, as ``row_number() = 1`` would be; it pays where keys are written repeatedly.
    Equal versions are settled by the other columns.
    """
    rest = [c for c in df.columns if c not in key and c not in version]
    newest = F.max(F.struct(*version, *rest)).alias("__newest")
    picked = df.groupBy(*key).agg(newest)
    kept = [c for c in df.columns if keep_version or c not in version]
    return picked.select(*[c if c in key else F.col(f"__newest.{c}").alias(c) for c in kept])

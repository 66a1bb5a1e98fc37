"""Rows as shown to a reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Display names of the hit columns as JSON fields, and the order of the group page.
JSON_NAMES = {
    "observationgroup": "observation group",
    "observationorder": "observation number",
    "frequency": "frequency",
    "snr": "SNR",
    "driftrate": "driftrate",
    "uncorrectedfrequency": "uncorrected frequency",
}
GROUP_PAGE = [
    "observationgroup",
    "grouphit",
    "source",
    "ra",
    "dec",
    "mjd",
    "filename1",
    "filename2",
    "filename3",
    "filename4",
    "filename5",
    "filename6",
]


def hits_json(hits: DataFrame) -> DataFrame:
    """One JSON object per hit, column ``json``."""
    return hits.select(F.to_json(F.struct(*[F.col(c).alias(name) for c, name in JSON_NAMES.items()])).alias("json"))


def hit_records(hits: DataFrame) -> DataFrame:
    """Hits as page records: the table's columns, ``snr`` shown as ``SNR``."""
    return hits.select(*[F.col(c).alias("SNR" if c == "snr" else c) for c in JSON_NAMES])


def group_records(groups: DataFrame) -> DataFrame:
    """Groups as page records, columns in page order."""
    return groups.select(*GROUP_PAGE)

"""Delimited hit messages: encoding, and parsing with a reason for what cannot be parsed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.schema import HITS

# The separator, and the number of fields (a source symbol, then the hit columns).
SEPARATOR = ";"
FIELDS = 1 + len(HITS.fields)


def message_of(symbol: Column) -> Column:
    """The message of a hit: the symbol and the hit's columns."""
    return F.concat_ws(SEPARATOR, symbol, *[F.col(f.name).cast("string") for f in HITS.fields])


def encode_hits(hits: DataFrame, symbol: Column) -> DataFrame:
    """Keyed messages: ``key`` is the source symbol, ``value`` the symbol and the hit's columns."""
    return hits.select(symbol.alias("key"), message_of(symbol).alias("value"))


def _number(text: Column, kind: T.DataType) -> Column:
    """The text as a number, null if it is none. Reading a double from text that is none costs an exception, so
    text that begins with a letter other than that of "inf" or "nan" isn't tried."""
    number, first = text.try_cast(kind), F.ascii(text)
    if not isinstance(kind, T.DoubleType):
        return number
    word = first.between(ord("A"), ord("z")) & ~first.isin(*map(ord, "INin"))
    return F.when(word, F.lit(None).cast(kind)).otherwise(number)


def parse_hits(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds the hit columns and a ``reason``, null for a good message.

    The first field, the symbol, is not read, and fields after the last column are ignored.
    """
    text = F.col(value).cast("string")
    # Exploding an array of one keeps the optimizer from copying the split, and all that the value
    # is made from, into each use of the tokens and into the filter on the reason.
    messages = messages.withColumn("__tokens", F.explode(F.array(F.split(text, SEPARATOR))))
    tokens = F.col("__tokens")
    # the same for the fields and the reason, or each test below would read its number from the text anew
    fields = [_number(F.get(tokens, i), f.dataType).alias(f.name) for i, f in enumerate(HITS.fields, start=1)]
    messages = messages.withColumn("__fields", F.explode(F.array(F.struct(*fields))))
    parsed = {f.name: F.col(f"__fields.{f.name}") for f in HITS.fields}
    bad_number, endless = F.lit(False), F.lit(False)
    for f, column in zip(HITS.fields, parsed.values(), strict=True):
        bad_number = bad_number | column.isNull()
        if isinstance(f.dataType, T.DoubleType):
            endless = endless | F.isnan(column) | (F.abs(column) == F.lit(math.inf))
    reason = (
        F.when(text.isNull(), "no value")
        .when(F.trim(text) == "", "empty value")
        .when(F.size(tokens) < FIELDS, "too few fields")
        .when(bad_number, "not a number")
        .when(endless, "not finite")
    )
    messages = messages.withColumn("__reason", F.explode(F.array(reason)))
    return messages.withColumns({**parsed, "reason": F.col("__reason")}).drop("__tokens", "__fields", "__reason")


def good_hits(parsed: DataFrame, *extra: str) -> DataFrame:
    """The hits of the good messages, with any extra columns asked for."""
    return parsed.where(F.col("reason").isNull()).select(*[f.name for f in HITS.fields], *extra)


def bad_messages(parsed: DataFrame, *extra: str, value: str = "value") -> DataFrame:
    """The messages that could not be parsed, with the reason."""
    text = F.col(value).cast("string").alias("value")
    return parsed.where(F.col("reason").isNotNull()).select(text, "reason", *extra)

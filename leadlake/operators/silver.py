"""Bronze -> silver: parse, type, clean, keep the latest version per lead."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leadlake.functions.jsonfields import json_double, json_integer, json_timestamp
from leadlake.functions.numeric import safe_ratio
from leadlake.schemas import MESSAGE_FIELDS
from leadlake.sources.lake import filter_date_window

_TEXT_SCHEMA = StructType([StructField(k, StringType()) for k, _, _ in MESSAGE_FIELDS])


def _typed(text: Column, kind: str, strict: bool = True) -> Column:
    if kind == "string":
        return text
    if kind == "timestamp":
        return json_timestamp(text, strict)
    if kind == "double":
        return json_double(text, strict)
    return json_integer(text, kind, strict)


def parse_messages(bronze: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Extract and type the lead fields of ``raw_json`` with a single parse.

    The parsed struct is expanded with ``inline`` (a ``Generate`` node): a
    filter on a parsed field (such as the web-time filter of ``clean_leads``)
    then stays above the parse instead of being pushed below it with the
    ``from_json`` call inlined, which would parse every message twice.

    ``mode="FAILFAST"`` raises on malformed JSON (as the warehouse SQL does);
    ``"PERMISSIVE"`` turns such rows into NULL fields instead.
    """
    doc = F.from_json(F.col("raw_json"), _TEXT_SCHEMA, {"mode": mode})
    staged = bronze.select("kafka_key", "kafka_timestamp", "ingestion_date",
                           F.inline(F.array(doc)))
    return staged.select(
        "kafka_key", "kafka_timestamp", "ingestion_date",
        *[_typed(F.col(f"`{key}`"), kind).alias(name) for key, name, kind in MESSAGE_FIELDS],
    )


_CORRUPT = "_corrupt_record"


def annotate_messages(bronze: DataFrame) -> DataFrame:
    """Parse without failing: the columns of ``parse_messages`` plus
    ``raw_json`` and ``parse_error`` -- NULL for a good message,
    ``malformed_json`` when the text is not a JSON object, ``bad_value:<field>``
    when a field cannot be typed (e.g. a non-number where a number belongs).

    Lets a job at scale keep going past bad messages and route them to a
    quarantine table instead of dropping them (``split_parsed``). Write the
    annotated rows once (e.g. partitioned by a good/bad flag) when both sides
    are consumed, so the messages are parsed once.
    """
    schema = StructType(_TEXT_SCHEMA.fields + [StructField(_CORRUPT, StringType())])
    doc = F.from_json(F.col("raw_json"), schema,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    staged = bronze.select("kafka_key", "raw_json", "kafka_timestamp", "ingestion_date",
                           F.inline(F.array(doc)))
    typed = {name: _typed(F.col(f"`{key}`"), kind, strict=False)
             for key, name, kind in MESSAGE_FIELDS}
    error = F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed_json"))
    for key, name, kind in MESSAGE_FIELDS:
        if kind != "string":
            error = error.when(F.col(f"`{key}`").isNotNull() & typed[name].isNull(),
                               F.lit(f"bad_value:{name}"))
    return staged.select("kafka_key", "kafka_timestamp", "ingestion_date",
                         *[c.alias(n) for n, c in typed.items()], "raw_json",
                         error.alias("parse_error"))


def split_parsed(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows in the ``parse_messages`` shape, bad rows with their raw
    text and reason) from ``annotate_messages``."""
    good = annotated.where(F.col("parse_error").isNull()).drop("raw_json", "parse_error")
    bad = annotated.where(F.col("parse_error").isNotNull()).select(
        "kafka_key", "kafka_timestamp", "ingestion_date", "raw_json", "parse_error")
    return good, bad


def clean_leads(parsed: DataFrame) -> DataFrame:
    """Fill visits/country, derive time per visit, drop rows without web time."""
    return (parsed
            .withColumns({
                "total_visits_filled": F.coalesce(F.col("total_visits"), F.lit(0)),
                "country_filled": F.coalesce(F.col("country"), F.lit("Unknown")),
                "average_time_per_visit": safe_ratio("total_time_spent_on_website",
                                                     "total_visits"),
            })
            .where(F.col("total_time_spent_on_website") > 0))


def dedup_latest(df: DataFrame, key: str | Sequence[str], order_desc: Sequence[str],
                 tie_breakers: Sequence[Column | str] = ()) -> DataFrame:
    """Keep one row per key: the greatest ``order_desc`` (NULLs last).

    Planned as a shuffle on the key with a per-partition top-1 limit before the
    exchange (``WindowGroupLimit``), so a hot key sends at most one row per
    map task through the shuffle. ``tie_breakers`` (ascending) make the winner
    deterministic when the order columns tie.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() for c in order_desc]
    order += [F.col(c) if isinstance(c, str) else c for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def build_silver(bronze: DataFrame, start_date: str | dt.date | None = None,
                 end_date: str | dt.date | None = None,
                 tie_breakers: Sequence[Column | str] = (),
                 mode: str = "FAILFAST") -> DataFrame:
    """The silver relation: one row per ``lead_number`` (latest version).

    ``mode="PERMISSIVE"`` goes past messages that can't be parsed or typed;
    ``silver_and_quarantine`` also returns them."""
    if mode == "PERMISSIVE":
        return silver_and_quarantine(bronze, start_date, end_date, tie_breakers)[0]
    windowed = filter_date_window(bronze, "ingestion_date", start_date, end_date)
    return _latest(clean_leads(parse_messages(windowed, mode)), tie_breakers)


def silver_and_quarantine(bronze: DataFrame, start_date: str | dt.date | None = None,
                          end_date: str | dt.date | None = None,
                          tie_breakers: Sequence[Column | str] = ()) -> tuple[DataFrame, DataFrame]:
    """The silver relation of the good messages, and the bad ones with their reason."""
    windowed = filter_date_window(bronze, "ingestion_date", start_date, end_date)
    good, bad = split_parsed(annotate_messages(windowed))
    return _latest(clean_leads(good), tie_breakers), bad


def _latest(cleaned: DataFrame, tie_breakers: Sequence[Column | str]) -> DataFrame:
    return dedup_latest(cleaned, "lead_number", ["ingestion_time", "kafka_timestamp"], tie_breakers)

"""Loaders for the small lookup files: error codes, devices, alerts, names.

Each takes lines (``value``), so a text file, a table column or a test row all work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsledger.functions.cleaning import similar_message
from opsledger.operators.dedup import last_per_key

# Texts for alerts without engineer wording.
NO_ENGINEER_TEXT = "No Eng Message"
NO_FLAGS_TEXT = "Did Not match Regex"
ALERT_FIELDS = ("idx", "code", "family", "name", "file", "level", "f1", "f2", "f3",
                "effect", "user_text", "f4", "engineer_text")


def _text_field(index: int):
    return F.trim(F.get(F.split("value", ","), F.lit(index)))


def _accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull())


def parse_codes(lines: DataFrame) -> DataFrame:
    """``message, code[, ...]`` lines with both fields; lines without a number carry ``parse_error``."""
    message, code = similar_message(_text_field(0)), _text_field(1).try_cast("int")
    return lines.withColumn("message", message).withColumn("code", code).withColumn(
        "parse_error", F.when(F.col("message").isNull() | F.col("code").isNull(), "no code"))


def error_codes(lines: DataFrame, position: str = "position") -> DataFrame:
    """One code per message; the last line of a message wins.

    Messages are normalised like the log messages they are matched with.
    """
    return last_per_key(_accepted(parse_codes(lines)), ["message"], [position], ["code"])


def devices(lines: DataFrame, position: str = "position") -> DataFrame:
    """``name, ip, realm, model`` lines to one row per device name."""
    parsed = lines.select(
        _text_field(0).alias("topic"),
        _text_field(1).alias("ip"),
        _text_field(2).alias("realm"),
        _text_field(3).alias("model"),
        F.col(position).alias("position"),
    ).where(F.col("model").isNotNull())
    return last_per_key(parsed, ["topic"], ["position"], ["ip", "realm", "model"])


def rejected_devices(lines: DataFrame) -> DataFrame:
    """Device lines that :func:`devices` leaves out, with the reason in ``parse_error``."""
    return lines.where(_text_field(3).isNull()).withColumn("parse_error", F.lit("missing fields"))


def parse_alerts(lines: DataFrame) -> DataFrame:
    """Quoted 13-field alert lines as ``error, message``; lines without a code carry ``parse_error``."""
    schema = ", ".join(f"{c} string" for c in ALERT_FIELDS)
    row = F.from_csv("value", schema, {"quote": '"', "escape": '"'})
    flagged = None
    for flag in ("f1", "f2", "f3", "f4"):
        ok = F.coalesce(F.col("_row")[flag].isin("TRUE", "FALSE"), F.lit(False))
        flagged = ok if flagged is None else flagged & ok
    wording = F.coalesce(F.nullif(F.trim(F.col("_row")["engineer_text"]), F.lit("")), F.lit(NO_ENGINEER_TEXT))
    return lines.withColumn("_row", row).select(
        *lines.columns, F.lower(F.trim(F.col("_row")["code"])).alias("error"),
        F.when(flagged, wording).otherwise(NO_FLAGS_TEXT).alias("message"),
    ).withColumn("parse_error", F.when(F.col("error").isNull(), "no code"))


def alerts(lines: DataFrame, position: str = "position") -> DataFrame:
    """``code -> message``; the last line of a code wins."""
    return last_per_key(_accepted(parse_alerts(lines)), ["error"], [position], ["message"])


def parse_names(lines: DataFrame) -> DataFrame:
    """``id "NAME"`` lines as ``node, name``; lines without a quoted name or an id carry ``parse_error``."""
    parts = F.split("value", '"')
    node = F.trim(F.get(parts, F.lit(0))).try_cast("bigint")
    problem = F.when(F.coalesce(F.size(parts), F.lit(0)) <= 1, "no name").when(node.isNull(), "no id")
    return lines.select("*", node.alias("node"), F.get(parts, F.lit(1)).alias("name"), problem.alias("parse_error"))


def quoted_names(lines: DataFrame, position: str = "position") -> DataFrame:
    """One name per id; the last line of an id wins, lines without a quoted name are skipped."""
    return last_per_key(_accepted(parse_names(lines)), ["node"], [position], ["name"])

"""Web access-log parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The combined log format, one group per field.
FIELDS = ("ip", "client", "user", "date_text", "request", "status_text", "bytes_text", "referer", "agent")
LINE = r'^(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"$'
DATE = r"^\[(\d{1,2})/(\w{3})/(\d{4}):(\d{1,2}:\d{1,2}:\d{1,2}) .+\]$"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_MARK = "\u0001"


def split_fields(line: Column) -> Column:
    """The nine fields of a valid line; for any other line an array of another size.

    The pattern runs once: matched groups are re-joined by a control character and split again. A line
    that holds this character itself takes its groups one by one.
    """
    joined = F.regexp_replace(line, LINE, _MARK.join(f"${i}" for i in range(1, 10)))
    one_by_one = F.when(line.rlike(LINE), F.array(*[F.regexp_extract(line, LINE, i) for i in range(1, 10)]))
    return F.when(line.contains(_MARK), F.coalesce(one_by_one, F.array(line))).otherwise(F.split(joined, _MARK))


def field(parts: Column, name: str) -> Column:
    return F.get(parts, F.lit(FIELDS.index(name)))


def event_time(date_text: Column) -> Column:
    """``[dd/MMM/yyyy:HH:mm:ss zone]`` with the zone dropped, as TIMESTAMP_NTZ; NULL if damaged."""
    named = F.regexp_replace(date_text, DATE, "$3-$2-$1 $4")
    place = F.position(F.substring(named, 6, 3), F.lit(MONTHS))
    month = F.when(place % 3 == 1, F.lpad(F.floor((place + 2) / 3).cast("string"), 2, "0"))
    return F.concat(F.substring(named, 1, 5), month, F.substring(named, 9, 12)).try_cast("timestamp_ntz")


def request_url(request: Column) -> Column:
    """Middle part of ``METHOD url PROTOCOL``; NULL for any other shape."""
    parts = F.split(request, " ")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(1)))


def token(line: Column, index: int) -> Column:
    """Blank-separated token by position with quotes stripped (the quick URL form)."""
    return F.replace(F.get(F.split(line, " "), F.lit(index)), F.lit('"'), F.lit(""))


def last_quoted(line: Column) -> Column:
    """Text of the last quoted chunk."""
    return F.element_at(F.split(F.regexp_replace(line, '"+$', ""), '"'), -1)


def status_class(status: Column) -> Column:
    return (
        F.when(status.between(200, 299), "Success")
        .when(status.between(500, 599), "Failure")
        .otherwise("Other")
    )

"""Regex-based field extraction for CDN access-log lines (JVM regex,
evaluated inside whole-stage codegen; no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns that must equal the reference's meaning -------
# IPv4 address anywhere in the line (group 0, first match).
IP_PATTERN = r"((?:(?:25[0-5]|2[0-4]\d|((1\d{2})|([1-9]?\d)))\.){3}(?:25[0-5]|2[0-4]\d|((1\d{2})|([1-9]?\d))))"
# Video file name (group 0); the dot is escaped here (see README, D6).
VIDEO_PATTERN = r"([0-9]+)\.mp4"
# A line that requests a video file (full match).
VIDEO_LINE_PATTERN = r"^.*([0-9]+)\.mp4.*$"
# Hour of the request (group 2); the year is a parameter, 2017 by default.
HOUR_PATTERN_TEMPLATE = r"^.*({year}):([0-9]{{2}}):[0-9]{{2}}:[0-9]{{2}}.*$"
DEFAULT_LOG_YEAR = "2017"
# Status 200/206/304 followed by the response size (group 2, full match).
SIZE_PATTERN = r"^.*\s(200|206|304)\s([0-9]+)\s.*$"
# ---------------------------------------------------------------------------

GIB = 1073741824


def hour_pattern(year: str = DEFAULT_LOG_YEAR) -> str:
    return HOUR_PATTERN_TEMPLATE.format(year=year)


def extract_ip(line: Column) -> Column:
    """First IPv4 address in the line, NULL when there is none."""
    return F.regexp_substr(line, F.lit(IP_PATTERN))


def extract_video(line: Column) -> Column:
    """Video file name such as ``12.mp4``; '' when absent."""
    return F.regexp_extract(line, VIDEO_PATTERN, 0)


def is_video_line(line: Column) -> Column:
    return line.rlike(VIDEO_LINE_PATTERN)


def has_status_and_size(line: Column) -> Column:
    return line.rlike(SIZE_PATTERN)


def extract_hour(line: Column, year: str = DEFAULT_LOG_YEAR) -> Column:
    """Two-digit hour text; NULL when the timestamp of ``year`` is absent."""
    return F.nullif(F.regexp_extract(line, hour_pattern(year), 2), F.lit(""))


def extract_size(line: Column) -> Column:
    """Response size in bytes; NULL when absent or not a valid bigint (the
    group is '' without a match, and '' does not cast)."""
    return F.regexp_extract(line, SIZE_PATTERN, 2).try_cast("bigint")

"""Log line parsers: a DataFrame with a ``value STRING`` column in, typed columns out.

``keep`` names further input columns to carry along (an id, a message offset).
Lines that do not match are dropped by the batch parsers; ``malformed_lines``
returns exactly those. The stream parsers drop nothing and give NULL for what a
message lacks.
"""

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from hitscope.fixed_values import (
    PRODUCT_CATEGORIES,
    STREAM_METHOD_PATTERN,
    STREAM_PROTOCOL_PATTERN,
    TOKEN_IP,
    TOKEN_METHOD,
    TOKEN_SIZE,
    TOKEN_STATUS,
    TOKEN_TIME,
    TOKEN_URL,
)
from hitscope.functions import (
    category_from_path,
    product_category,
    product_id_from_path,
    product_id_from_query,
    request_time,
)

#: Columns of ``parse_stream_tokens``.
LOG_SCHEMA = StructType([
    StructField("ip", StringType()),
    StructField("ts", TimestampType()),
    StructField("method", StringType()),
    StructField("url", StringType()),
    StructField("status", IntegerType()),
])

#: Columns of ``parse_access_log`` and ``parse_extended_log``.
PARSED_SCHEMA = StructType([f for f in LOG_SCHEMA.fields if f.name != "status"] + [
    StructField("status", LongType()),
    StructField("response_size", LongType()),
    StructField("product_id", StringType()),
    StructField("category", StringType()),
])

# The line patterns of fixed_values.py with each lazy step inside an atomic
# group. Whatever follows a delimiter may start anywhere, so if it cannot be
# found after the first occurrence of the delimiter it cannot be found after a
# later one either: both forms match the same lines with the same groups, but
# this one reads a line once, where the plain one retries every combination of
# delimiters on a long line that does not match.
# (?d) lets "." stop at \n only, not at \r or the Unicode line ends.
_REQUEST = r'(\d+\.\d+\.\d+\.\d+) - - \[(?>(.*?)\] ")(?>(.*?) )'
LINE_FORMATS = {
    "current": _REQUEST + r'(?>(.*?) HTTP/).*?" (\d+) (\d+)',
    "extended": _REQUEST + r'(?>(.*?) HTTP)(?>.*?" (\d+) (\d+) ")(?>.*?" ").*?" \d+',
    "basic": _REQUEST + r'(?>(.*?) HTTP).*" (\d+) (\d+)',
}
# The same for the two stream patterns that look for a start and then for an end:
# where the first start in a line finds no end, no later one does. (?m) tries
# each line of a message once, from its beginning.
STREAM_TIME = r'(?m)^(?>.*?\[)(.*?)\]'
STREAM_URL = r'(?m)^(?>.*?"\w+ )(.*?) HTTP'

_FIELDS = ("ip", "time_text", "method", "url", "status_text", "size_text")


def one_field_pattern(line_format: str, field: str) -> tuple[str, int]:
    """The line pattern with one group, and how many characters that group takes beyond the field.

    A field that may be empty is taken with the text that ends it, so that only
    a line that does not match gives an empty group.
    """
    pattern, capturing = LINE_FORMATS[line_format], r"\((?!\?)"
    at = [m.start() for m in re.finditer(capturing, pattern)][_FIELDS.index(field)]
    lazy = re.match(r"\(\.\*\?\)([^()]*)\)", pattern[at:])
    end = at + lazy.end() if lazy else pattern.index(")", at) + 1
    own = f"(.*?{lazy[1]}))" if lazy else pattern[at:end]
    plain = lambda text: re.sub(capturing, "(?:", text)
    return f"(?d)^{plain(pattern[:at])}{own}{plain(pattern[end:])}", len(lazy[1].replace("\\", "")) if lazy else 0


def _matched_fields(lines: DataFrame, line_format: str, keep: Sequence[str], wanted: Sequence[str] = _FIELDS) -> DataFrame:
    """The wanted raw fields of each line that matches, from one regex pass.

    A filter plus one ``regexp_extract`` per field would run the pattern up to
    seven times. For no field a filter will do, for one a single
    ``regexp_extract``. Else the whole line is rewritten to its groups, one per row of
    text (no group can hold a line feed), or to as many empty ones if it does not
    match, and ``inline`` emits a row only for the former.
    """
    if not wanted:
        return lines.where(F.col("value").rlike("(?d)^" + LINE_FORMATS[line_format])).select(*keep)
    if len(wanted) == 1:
        pattern, beyond = one_field_pattern(line_format, wanted[0])
        row = F.struct(F.regexp_extract("value", pattern, 1).alias("found"))
        found = lines.select(*keep, F.inline(F.array(row))).where("found != ''")
        field = F.expr(f"left(found, char_length(found) - {beyond})") if beyond else F.col("found")
        return found.select(*keep, field.alias(wanted[0]))
    # The address comes first, as it is never empty.
    taken = ["ip", *(f for f in _FIELDS if f in wanted and f != "ip")]
    whole_line = rf"(?d)(?:^{LINE_FORMATS[line_format]}(?s:.*)|^(?s:.*))"
    groups = "\n".join(f"${_FIELDS.index(f) + 1}" for f in taken)
    fields = F.col("fields")
    row = F.struct(*[fields[i].alias(name) for i, name in enumerate(taken)])
    return lines.select(
        *keep, F.split(F.regexp_replace("value", whole_line, groups), "\n").alias("fields")
    ).select(*keep, F.inline(F.when(fields[0] != "", F.array(row))))


def _parse(
    lines: DataFrame,
    line_format: str,
    keep: Sequence[str],
    columns: Sequence[str] | None,
    derived: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """The columns asked for, in the order of *derived*, which has the raw field and the expression of each."""
    unknown = set(columns or ()) - derived.keys()
    if unknown:
        raise ValueError(f"no such columns of a parsed line: {', '.join(sorted(unknown))}")
    asked = {name: derived[name] for name in derived if columns is None or name in columns}
    wanted = [f for f in _FIELDS if any(field == f for field, _ in asked.values())]
    fields = _matched_fields(lines, line_format, keep, wanted)
    return fields.select(*keep, *[column.alias(name) for name, (_, column) in asked.items()])


def _parsed_columns(product_id: Column, category: Column) -> dict[str, tuple[str, Column]]:
    return {
        "ip": ("ip", F.col("ip")),
        "ts": ("time_text", request_time(F.col("time_text"))),
        "method": ("method", F.col("method")),
        "url": ("url", F.col("url")),
        "status": ("status_text", F.col("status_text").try_cast("bigint")),
        "response_size": ("size_text", F.col("size_text").try_cast("bigint")),
        "product_id": ("url", product_id),
        "category": ("url", category),
    }


def parse_access_log(
    lines: DataFrame,
    keep: Sequence[str] = (),
    categories: Mapping[str, Sequence[str]] = PRODUCT_CATEGORIES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Current format; product id from the query string, category from the word table.

    Here and in the other two parsers of whole logs, *columns* are those that the result shall have (all by default): the
    fewer, the less of a line is taken apart.
    """
    url = F.col("url")
    derived = _parsed_columns(product_id_from_query(url), product_category(url, categories))
    return _parse(lines, "current", keep, columns, derived)


def parse_extended_log(lines: DataFrame, keep: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Lines with referer, agent and a trailing number; product id and category from the path."""
    url = F.col("url")
    return _parse(lines, "extended", keep, columns, _parsed_columns(product_id_from_path(url), category_from_path(url)))


def parse_basic_log(lines: DataFrame, keep: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Six plain columns, time left as text."""
    plain = _parsed_columns(F.lit(None), F.lit(None))
    derived = {"ip": plain["ip"], "timestamp_text": ("time_text", F.col("time_text"))}
    derived |= {name: plain[name] for name in ("method", "url", "status", "response_size")}
    return _parse(lines, "basic", keep, columns, derived)


def malformed_lines(lines: DataFrame, line_format: str = "current") -> DataFrame:
    """Lines the batch parser of that format drops, NULL lines included."""
    matches = F.col("value").rlike("(?d)^" + LINE_FORMATS[line_format])
    return lines.where(~F.coalesce(matches, F.lit(False)))


def _with_column_once(rows: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed in one place.

    Catalyst copies the expression of a plain column into each filter on it,
    the implied NOT NULL of a window among them, where it runs again.
    ``inline`` of one row holds it in place; filters on other columns still
    move below it.
    """
    return rows.select("*", F.inline(F.array(F.struct(column.alias(name)))))


def _split(messages: DataFrame, tokens: int, keep: Sequence[str]) -> DataFrame:
    # A limit spares splitting the rest of the line.
    split = F.split("value", " ", tokens + 1)
    return _with_column_once(messages.select(*keep, "value"), "tokens", split)


def _token(i: int) -> Column:
    return F.get("tokens", F.lit(i))


def parse_stream_tokens(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fields by position among blanks, without the leading ``[`` and ``"``.

    The time is the fourth token with the offset from the fifth.
    """
    fields = _split(messages, TOKEN_STATUS + 1, keep).select(
        *keep,
        _token(TOKEN_IP).alias("ip"),
        F.concat_ws(" ", F.slice("tokens", TOKEN_TIME + 1, 2)).alias("time_text"),
        F.ltrim(_token(TOKEN_METHOD), F.lit('"')).alias("method"),
        _token(TOKEN_URL).alias("url"),
        _token(TOKEN_STATUS).try_cast("int").alias("status"),
    )
    time = request_time(F.btrim("time_text", F.lit("[]")))
    return _with_column_once(fields, "ts", time).select(*keep, "ip", "ts", "method", "url", "status")


def parse_stream_regex(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fields by pattern, '' where one is not found; address, status and size by position.

    As status and size go by position, a blank in the url moves them. The
    protocol keeps its closing quote.
    """
    return _split(messages, TOKEN_SIZE + 1, keep).select(
        *keep,
        _token(TOKEN_IP).alias("ip"),
        F.regexp_extract("value", STREAM_TIME, 1).alias("timestamp_text"),
        F.regexp_extract("value", STREAM_METHOD_PATTERN, 1).alias("method"),
        F.regexp_extract("value", STREAM_URL, 1).alias("url"),
        F.regexp_extract("value", STREAM_PROTOCOL_PATTERN, 0).alias("protocol"),
        _token(TOKEN_STATUS).try_cast("int").alias("status"),
        _token(TOKEN_SIZE).try_cast("int").alias("size"),
    )

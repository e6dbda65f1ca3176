"""Apache Common Log Format parsing as one regex pass per line.

The nine-group pattern below is a fixed value: its greedy ``(.*)`` endpoint
group absorbs the protocol (the protocol group is always empty) and, having
no end anchor, it accepts trailing text after the size field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The access-log pattern (9 groups) and English month abbreviations.
LOG_PATTERN = (
    '^(\\S+) (\\S+) (\\S+) \\[([\\w:/]+\\s[+\\-]\\d{4})\\] "(\\S*)\\s*(.*)\\s*(\\S*)" (\\d{3}) (\\S+)'
)
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

LOG_FIELDS = ["host", "client_identd", "user_id", "date_time", "method", "endpoint",
              "protocol", "response_code", "content_size"]

# The pattern plus a tail that swallows the rest of the line, so one
# regexp_replace rewrites a matching line into its nine groups separated by
# LF (no group can hold LF: \S groups exclude it and '.' stops at it).  (?d): '.'
# stops at LF only, not at CR, U+0085, U+2028 or U+2029.
_WHOLE_LINE = "(?d)" + LOG_PATTERN + "[\\s\\S]*\\z"
_GROUPS = "\n".join(f"${i}" for i in range(1, 10))


def _typed_fields(rewritten: Column, raw: Column, lenient: bool,
                  matched: Column | None = None, g: Column | None = None) -> list[Column]:
    if matched is None:
        matched = F.length(rewritten) < F.length(raw)
    if g is None:
        g = F.split(rewritten, "\n")

    def grp(i: int) -> Column:
        return F.when(matched, g.getItem(i - 1))

    ts = grp(4)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(ts, 4, 3)).cast("int")
    to_int = (lambda c: c.try_cast("int")) if lenient else (lambda c: c.cast("int"))
    make_ts = F.try_make_timestamp_ntz if lenient else F.make_timestamp_ntz
    date_time = make_ts(
        to_int(F.substring(ts, 8, 4)),
        F.when(month > 0, month) if lenient else month,
        to_int(F.substring(ts, 1, 2)),
        to_int(F.substring(ts, 13, 2)),
        to_int(F.substring(ts, 16, 2)),
        to_int(F.substring(ts, 19, 2)),
    )
    size_text = grp(9)
    to_long = (lambda c: c.try_cast("bigint")) if lenient else (lambda c: c.cast("bigint"))
    content_size = F.when(size_text == "-", F.lit(0).cast("bigint")).otherwise(to_long(size_text))
    valid = matched
    if lenient:
        valid = matched & date_time.isNotNull() & content_size.isNotNull()
    return [
        grp(1).alias("host"),
        grp(2).alias("client_identd"),
        grp(3).alias("user_id"),
        F.when(valid, date_time).alias("date_time"),
        grp(5).alias("method"),
        grp(6).alias("endpoint"),
        grp(7).alias("protocol"),
        grp(8).cast("int").alias("response_code"),
        F.when(valid, content_size).alias("content_size"),
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
    ]


def parse_log_line(line, lenient: bool = False) -> Column:
    """Struct of the nine typed log fields plus ``is_valid`` for a line column.

    A matching line is always rewritten into a strictly shorter string (nine
    fields, eight separators, while the pattern itself needs at least ten
    separator characters), a non-matching one is returned unchanged, so a
    length comparison tells them apart without running the regex again.

    ``lenient=False`` keeps the reference behaviour: a matching line whose time
    or size field does not convert raises (ANSI cast error).  ``lenient=True``
    turns such a line into an invalid one instead.
    """
    raw = F.col(line) if isinstance(line, str) else line
    return F.struct(*_typed_fields(F.regexp_replace(raw, _WHOLE_LINE, _GROUPS), raw, lenient))


def split_protocol(df: DataFrame) -> DataFrame:
    """Non-compatible mode: move a trailing ``HTTP/x`` token of ``endpoint``
    into ``protocol`` (the reference's greedy group always leaves it in the
    endpoint and the protocol empty)."""
    proto = F.regexp_extract("endpoint", "\\s(HTTP/\\S*)$", 1)
    return (df.withColumn("_proto", proto)
              .withColumn("endpoint", F.when(F.col("_proto") != "", F.regexp_replace(
                  "endpoint", "\\s+HTTP/\\S*$", "")).otherwise(F.col("endpoint")))
              .withColumn("protocol", F.when(F.col("_proto") != "", F.col("_proto"))
                          .otherwise(F.col("protocol")))
              .drop("_proto"))


def log_fields(df: DataFrame, line_col: str = "raw", lenient: bool = False,
               compat: bool = True) -> DataFrame:
    """The parsed fields of ``df[line_col]`` followed by the line as ``raw``.

    The regex rewrite is projected first and the fields read from it in a
    second projection; Catalyst does not collapse projections that would
    repeat a non-trivial expression, so the pattern runs once per line."""
    step = df.select(F.col(line_col).alias("raw"),
                     F.regexp_replace(F.col(line_col), _WHOLE_LINE, _GROUPS).alias("_rw"))
    step = step.select("raw", (F.length("_rw") < F.length("raw")).alias("_ok"),
                       F.split(F.col("_rw"), "\n").alias("_g"))
    out = step.select(*_typed_fields(None, F.col("raw"), lenient, F.col("_ok"), F.col("_g")), "raw")
    return out if compat else split_protocol(out)

"""Log-line parsing (FUN-14, FUN-15) with Java regular expressions run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.keys import running_totals

# Fixed format of the service log lines:
# "<yyyy-MM-dd HH:mm:ss>[,ms] - <logger> - <LEVEL> - <function>:<line> - <message>"
# Milliseconds are optional (the logger's date format writes none).
LINE_PATTERN = (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?:,(\d{3}))? - (\S+) - ([A-Z]+) - "
                r"(\w+):(\d+) - (.*)$")
TRACE_PATTERN = r"\[trace_id=([^\]]+)\]"
REQUEST_PATTERN = r"(Request|Response): ([A-Z]+) (\S+)"
STATUS_PATTERN = r"Status: (\d{3})"
DURATION_PATTERN = r"Duration: ([0-9.]+)(ms|s)\b"
CLIENT_PATTERN = r"(?:Client:|Request: [A-Z]+ \S+ from) (\S+)"
# A probability is written as a share or, in the service's own lines, in percent.
PROBABILITY_PATTERN = r"[Pp]robability[=:] ?([0-9.]+%?)"
# Severity order used by "level at or above".
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


def _x(c: Column, pattern: str, idx: int) -> Column:
    """One regex group; no match (empty string) becomes null. The regex runs once."""
    return F.nullif(F.regexp_extract(c, pattern, idx), F.lit(""))


def parse_log_line(df: DataFrame, text_col: str = "value") -> DataFrame:
    """FUN-14: split a line into time, logger, level, function, line number and message.

    One anchored ``rlike`` validates the whole line against ``LINE_PATTERN``;
    the fields then come from a single ``split`` on " - " (logger, level and
    function cannot contain that separator, so the fifth part is the whole
    message). Lines that do not match give nulls, as a regex extract would.
    """
    t = F.col(text_col)
    # lower projection: the regex check and the split run once per line (not per field)
    staged = df.select("*", t.rlike(LINE_PATTERN).alias("__ok"), F.split(t, " - ", 5).alias("__p"))
    ok, parts = F.col("__ok"), F.col("__p")

    def field(i):
        return F.when(ok, parts[i])

    head = parts[0]
    base = F.try_to_timestamp(F.substring(head, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    ms = F.when(F.length(head) > 19, F.substring(head, 21, 3).cast("int")).otherwise(F.lit(0))
    fl = parts[3]
    return staged.select(
        *df.columns,
        F.when(ok, F.timestamp_add("MILLISECOND", ms, base)).alias("log_ts"),
        field(1).alias("logger"),
        field(2).alias("level"),
        F.when(ok, F.substring_index(fl, ":", 1)).alias("function"),
        F.when(ok, F.substring_index(fl, ":", -1).try_cast("int")).alias("line"),
        field(4).alias("message"),
    )


def parse_request_fields(df: DataFrame, text_col: str = "value") -> DataFrame:
    """FUN-15: trace id, kind, method, path, client, status, duration (seconds), probability.

    Each pattern runs once per line (a lower projection holds the matches);
    the request triple and the duration unit are then cut with string functions.
    """
    t = F.col(text_col)
    staged = df.select("*",
                       _x(t, REQUEST_PATTERN, 0).alias("__req"),
                       _x(t, DURATION_PATTERN, 0).alias("__dur"), _x(t, PROBABILITY_PATTERN, 1).alias("__prob"))
    req = F.split(F.col("__req"), " ")
    dur_txt = F.regexp_replace(F.col("__dur"), "^Duration: ", "")
    is_ms = dur_txt.endswith("ms")
    num = F.when(is_ms, F.expr("substring(regexp_replace(__dur, '^Duration: ', ''), 1, "
                               "length(regexp_replace(__dur, '^Duration: ', '')) - 2)")) \
           .otherwise(F.expr("substring(regexp_replace(__dur, '^Duration: ', ''), 1, "
                             "length(regexp_replace(__dur, '^Duration: ', '')) - 1)")).try_cast("double")
    return staged.select(
        *df.columns,
        _x(t, TRACE_PATTERN, 1).alias("trace_id"),
        F.regexp_replace(req[0], ":$", "").alias("kind"),
        req[1].alias("method"),
        req[2].alias("path"),
        _x(t, CLIENT_PATTERN, 1).alias("client"),
        _x(t, STATUS_PATTERN, 1).try_cast("int").alias("status"),
        F.when(is_ms, num / 1000.0).otherwise(num).alias("duration_s"),
        F.when(F.col("__prob").endswith("%"), F.rtrim("__prob", F.lit("%")).try_cast("double") / 100)
        .otherwise(F.col("__prob").try_cast("double")).alias("probability"),
    )


def level_rank(level) -> Column:
    """Numeric severity (unknown levels null) for "at or above" filters."""
    m = F.create_map(*[x for i, lv in enumerate(LEVELS) for x in (F.lit(lv), F.lit(i))])
    return F.try_element_at(m, level if isinstance(level, Column) else F.col(level))


def pair_requests(lines: DataFrame, order: Sequence[str] = ("log_us", "line_no"), by: Sequence[str] = ("trace_id", "method", "path")) -> DataFrame:
    """JON-07: request lines paired with their responses, one row per request or response.

    Inside a trace, method and path the k-th request belongs to the k-th response, in ``order``. Output: ``by``, ``k``,
    ``request_<c>`` and ``response_<c>`` of the order columns, status and duration of the response, ``status_pair``:
    ``paired``, ``open`` (a request without a response so far) or ``lost`` (a response without its request). Positions come
    from global running counts (H1), so a trace of any length is many tasks, and the join is on the position too.
    """
    rows = lines.where(F.col("kind").isin("Request", "Response")).select("kind", *by, *order, "status", "duration_s")
    # one struct as the group, so that missing parts (a line without a trace) are a group like others
    rows = rows.withColumn("__g", F.struct(*by, "kind"))
    ranked = running_totals(rows, list(order), {"k": F.lit(1).cast("bigint")}, groups=["__g"])
    side = lambda kind, own: ranked.where(F.col("kind") == kind).select(
        *[F.col(c).alias(f"__{kind}_{c}") for c in [*by, "k"]], *[F.col(c).alias(f"{kind.lower()}_{c}") for c in order], *own)
    q, p = side("Request", []), side("Response", ["status", "duration_s"])
    on = [F.col(f"__Request_{c}").eqNullSafe(F.col(f"__Response_{c}")) for c in by] + [F.col("__Request_k") == F.col("__Response_k")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    j = q.join(p, cond, "full")
    pair = F.when(F.col("__Request_k").isNull(), "lost").when(F.col("__Response_k").isNull(), "open").otherwise("paired")
    return j.select(*[F.coalesce(f"__Request_{c}", f"__Response_{c}").alias(c) for c in [*by, "k"]],
                    *[f"{kind}_{c}" for kind in ("request", "response") for c in order], "status", "duration_s", pair.alias("status_pair"))

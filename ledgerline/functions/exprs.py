"""Scalar expressions: every function is ``Column -> Column`` built from
``pyspark.sql.functions`` so the whole plan stays inside whole-stage codegen.
No Python UDF is used anywhere in the engine.

The fixed values that must equal the source application's behaviour (marker
strings, status words, tags, validation messages) are collected in
``ledgerline.functions.constants``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

MONEY_TYPE = "decimal(18,4)"
SUM_TYPE = "decimal(38,4)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# ids (FN1-FN3)
# --------------------------------------------------------------------------
def gid_digits(c) -> Column:
    """FN1: trailing digits of a global id; no digits (or null) -> null."""
    return F.nullif(F.regexp_extract(col(c), r"([0-9]+)$", 1), F.lit(""))


def last_segment(c) -> Column:
    """FN2: text after the last '/'; null stays null."""
    return F.substring_index(col(c), "/", -1)


def gid_tail(c) -> Column:
    """FN3: last '/' segment only when the value is a gid, else unchanged."""
    c = col(c)
    return F.when(c.contains("gid://"), F.substring_index(c, "/", -1)).otherwise(c)


# --------------------------------------------------------------------------
# time (FN4-FN9, FN16-FN17)
# --------------------------------------------------------------------------
def parse_ts(c) -> Column:
    """FN4/FN5: ISO-8601 text (``Z`` or offset) -> timestamp; bad text -> null."""
    return F.try_to_timestamp(col(c))


def utc_naive(ts) -> Column:
    """Publish an instant as UTC wall clock (TIMESTAMP_NTZ); session tz is UTC."""
    return col(ts).cast("timestamp_ntz")


def local_date(ts, tz) -> Column:
    """FN6/FN7: calendar date of an instant in the store's time zone (a column)."""
    return F.to_date(F.from_utc_timestamp(col(ts), col(tz)))


def window_starts(start, end) -> Column:
    """FN9: first days of one-month windows from ``start`` (any day of a month)
    on, as long as they are not after ``end``. Each is one month after the one
    before, so a day that a month lacks moves the later windows as well."""
    months = F.greatest(F.floor(F.months_between(col(end), col(start))).cast("int"), F.lit(0)) + 1
    every = F.aggregate(F.sequence(F.lit(1), months), F.array(col(start)),
                        lambda done, _: F.concat(done, F.array(F.add_months(F.element_at(done, -1), F.lit(1)))))
    return F.filter(every, lambda d: d <= col(end))


def window_end(start) -> Column:
    """FN9: last day of the window: the day before the same day of the next month."""
    return F.date_sub(F.add_months(col(start), 1), 1)


def seconds_between(a, b) -> Column:
    """FN15: whole seconds from a to b (truncated)."""
    return F.timestamp_diff("SECOND", col(a), col(b))


def hours_before(ts, hours: int) -> Column:
    """FN16: ts - N hours."""
    return col(ts) - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(hours))


# --------------------------------------------------------------------------
# money and numbers (P5, A2, FN5, FN11)
# --------------------------------------------------------------------------
def amount(c) -> Column:
    """Coercing parse of a money string to DECIMAL(18,4); bad/empty -> null."""
    return col(c).try_cast(MONEY_TYPE)


def money(bag, default0: bool = True) -> Column:
    """P5: ``bag.shopMoney.amount`` as DECIMAL(18,4); missing -> 0 (or null)."""
    v = col(bag).getField("shopMoney").getField("amount").try_cast(MONEY_TYPE)
    return F.coalesce(v, F.lit(0).cast(MONEY_TYPE)) if default0 else v


def money_double(bag, default0: bool = True) -> Column:
    return money(bag, default0).cast("double")


def sum_money(arr, path) -> Column:
    """A2: sum of a money path over an array of structs; empty/null array -> 0."""
    zero = F.lit(0).cast(SUM_TYPE)
    return F.coalesce(
        F.aggregate(col(arr), zero,
                    lambda acc, x: (acc + F.coalesce(path(x).try_cast(MONEY_TYPE), zero)).cast(SUM_TYPE)),
        zero)


def first(arr) -> Column:
    """First element of a nested list; empty or null list -> null."""
    return F.get(col(arr), 0)


# --------------------------------------------------------------------------
# lists and text (FN10, FN12, FN13, FN18)
# --------------------------------------------------------------------------
def join_list(arr, sep: str = ", ") -> Column:
    """FN10: join with ', '; empty or null list -> null."""
    return F.nullif(F.array_join(col(arr), sep), F.lit(""))


def tags_array(c) -> Column:
    """FN12 (typed column): a list stays, null -> []."""
    return F.coalesce(col(c), F.array().cast("array<string>"))


def tags_from_text(c) -> Column:
    """FN12 (string column): null or '' -> [], other text -> [text]."""
    c = col(c)
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.array(c))


# JSON string escaping as the loaders' serializer writes it: backslash and
# quote, the five short escapes, every other control character (below 0x20)
# as a lower-case \\u00xx escape; everything else (non-ASCII included) as is.
_SHORT_ESCAPES = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
_JSON_ESCAPES = [("\\", "\\\\"), ('"', '\\"')] + [
    (chr(i), _SHORT_ESCAPES.get(chr(i), "\\u%04x" % i)) for i in range(0x20)]


def json_string(x) -> Column:
    """JSON text of one string value; null -> 'null'."""
    v = col(x)
    for raw, esc in _JSON_ESCAPES:
        v = F.replace(v, F.lit(raw), F.lit(esc))
    return F.when(col(x).isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), v, F.lit('"')))


def json_list_text(arr) -> Column:
    """FN13: JSON text of a list of strings with ', ' separators, non-ASCII
    kept (the loaders' serializer with ensure_ascii off). A null list stays
    null (the caller decides the fill)."""
    a = col(arr)
    return F.when(a.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("["), F.array_join(F.transform(a, json_string), ", "), F.lit("]")))


def left(c, n: int) -> Column:
    """FN18: truncate to n characters."""
    return F.substring(col(c), 1, n)


def ellipsize(c, n: int = 150) -> Column:
    """FN18: first n characters plus '...' only when longer."""
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


# --------------------------------------------------------------------------
# store URLs, tokens, job names (FN19-FN23, FN26)
# --------------------------------------------------------------------------
def normalize_url(c) -> Column:
    """FN19: trim, drop scheme, cut at the first '/'."""
    return F.substring_index(F.regexp_replace(F.trim(col(c)), "https?://", ""), "/", 1)


def valid_store_url(c) -> Column:
    """FN20: non-empty, ends with the store suffix, no '/' and no space."""
    c = col(c)
    return (F.coalesce(c, F.lit("")) != "") & F.coalesce(c.endswith(K.STORE_SUFFIX), F.lit(False)) \
        & ~F.coalesce(c.contains("/"), F.lit(False)) & ~F.coalesce(c.contains(" "), F.lit(False))


def mask_token(c) -> Column:
    """FN21: first 10 + stars + last 5. Tokens shorter than 16 are fully masked
    (the 10-15 character case would otherwise show the whole token)."""
    c = col(c)
    n = F.length(c)
    return F.when(c.isNull() | (n < 16), F.lit("********")).otherwise(
        F.concat(F.substring(c, 1, 10), F.repeat(F.lit("*"), n - 15), F.substring(c, -5, 5)))


def job_name(c) -> Column:
    """FN22: runner job name from a store name."""
    x = F.lower(F.replace(col(c), F.lit(K.STORE_SUFFIX), F.lit("")))
    x = F.regexp_replace(x, "[^a-z0-9-]", "-")
    x = F.regexp_replace(x, "-+", "-")
    x = F.trim(x, F.lit("-"))
    return F.when(x.startswith(K.JOB_NAME_PREFIX), x).otherwise(F.concat(F.lit(K.JOB_NAME_PREFIX), x))


def runner_state_label(c) -> Column:
    """FN23: runner execution state (name or numeric code) -> display status."""
    code_to_name = F.create_map(*[F.lit(x) for kv in K.RUNNER_STATE_CODES for x in kv])
    name_to_label = F.create_map(*[F.lit(x) for kv in K.RUNNER_STATE_LABELS for x in kv])
    s = col(c)
    name = F.when(s.rlike("^[0-9]+$"), F.coalesce(code_to_name[s], F.lit("Unknown"))).otherwise(s)
    return F.coalesce(name_to_label[name], name)


def marker_job_name(msg) -> Column:
    """FN26: runner job name carried by a marker log line, else null."""
    m = col(msg)
    return F.when(m.contains(K.JOB_NAME_MARKER),
                  F.trim(F.element_at(F.split(m, K.JOB_NAME_MARKER), 2)))


# --------------------------------------------------------------------------
# status and log classification (FN24, DQ2, DQ6)
# --------------------------------------------------------------------------
def board_status(status) -> Column:
    """FN24 (jobs board): running and pending both show Running."""
    s = col(status)
    return (F.when(s.isin("running", "pending"), F.lit("Running"))
            .when(s == "completed", F.lit("Completed"))
            .when(s == "failed", F.lit("Failed"))
            .otherwise(F.initcap(s)))


def store_status(status) -> Column:
    """FN24 (connected stores): label of the store from its latest job."""
    s = col(status)
    return (F.when(s == "completed", F.lit(K.STORE_ACTIVE))
            .when(s == "running", F.lit(K.STORE_RUNNING))
            .when(s == "failed", F.lit(K.STORE_FAILED))
            .when(s == "cancelled", F.lit(K.STORE_CANCELLED))
            .otherwise(F.lit(K.STORE_NOT_SYNCED)))


def log_level(line) -> Column:
    """DQ2: ordered substring rules; any 'error' makes the line ERROR."""
    x = col(line)
    return (F.when(x.contains("[ERROR]") | x.contains("Error") | x.contains("error"), F.lit("ERROR"))
            .when(x.contains("[WARNING]") | x.contains("Warning"), F.lit("WARNING"))
            .otherwise(F.lit("INFO")))


def log_component(line) -> Column:
    """DQ2: component by ordered rules on the lower-cased line."""
    x = F.lower(col(line))
    return (F.when(x.contains("customer"), F.lit("customers"))
            .when(x.contains("order") & x.contains("items"), F.lit("order_items"))
            .when(x.contains("order"), F.lit("orders"))
            .when(x.contains("product"), F.lit("products"))
            .otherwise(F.lit("main")))


def progress_stage(line) -> Column:
    """DQ6: progress percentage of a tagged line, null when untagged."""
    x = col(line)
    e = F.lit(None).cast("int")
    for tag, pct in reversed(K.PROGRESS_TAGS):
        e = F.when(x.contains(tag), F.lit(pct)).otherwise(e)
    return e

"""Column expressions on tool names, results, JSON and timestamps. All stay in generated code."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanforge.config import DEFAULT, EngineConfig


def filled(x: Column) -> Column:
    """Null for the empty string too."""
    return F.nullif(x, F.lit(""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def bare_tool(name: Column, config: EngineConfig = DEFAULT) -> Column:
    """The name behind the last server prefix."""
    return F.substring_index(name, config.prefix, -1)


def error_kind(result: Column, success: Column, config: EngineConfig = DEFAULT) -> Column:
    """The kind of error that a result shows, or null. Only its head is read; the first signature wins."""
    text = F.coalesce(result, F.lit(""))
    head = F.substring(text, 1, config.head)
    found = F.when(text == "", F.when(~success, F.lit("empty_failed")))
    for kind, mark in config.signatures:
        found = found.when(F.contains(head, F.lit(mark)), F.lit(kind))
    return found.when(F.startswith(head, F.lit("Error:")) | F.contains(head, F.lit('"error"')), F.lit("other_error"))


def is_empty(result: Column, config: EngineConfig = DEFAULT) -> Column:
    """Whether a result says that it found nothing."""
    head = F.substring(F.coalesce(result, F.lit("")), 1, config.head)
    return reduce(or_, (F.contains(head, F.lit(m)) for m in config.empty_marks))


# Forms of timestamps besides ISO, tried in this order.
TIMESTAMP_FORMS = (
    "M/d/yyyy, h:mm:ss.SSS a", "M/d/yyyy, h:mm:ss a", "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss",
)


def parsed_timestamp(raw: Column) -> Column:
    """A timestamp from ISO text or one of the other forms, null if none fits; text without a zone is UTC."""
    return F.coalesce(F.try_to_timestamp(raw), *(F.try_to_timestamp(raw, F.lit(f)) for f in TIMESTAMP_FORMS))


def normal_timestamp(raw: Column) -> Column:
    """UTC text in milliseconds that sorts; text that cannot be read stays as it is."""
    return F.coalesce(F.date_format(parsed_timestamp(raw), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), raw)


def known_intent(raw: Column, config: EngineConfig = DEFAULT) -> Column:
    """The intent of the vocabulary that the text names, else null."""
    text = F.lower(F.btrim(F.btrim(raw), F.lit(".,;")))
    out = F.lit(None).cast("string")
    for name in config.intents:
        out = F.when(text == name.lower(), F.lit(name)).otherwise(out)
    return out


# Fixed value: how an intent is named.
INTENT = r'(?i)intent"?\s*[:=]\s*"?([^\n\r;"\\,}]+)'


def first_intent(text: Column, config: EngineConfig = DEFAULT, *, only_first: bool = False) -> Column:
    """The first match that names a known intent; with ``only_first``, no match behind the first is asked."""
    if only_first:
        return known_intent(filled(F.regexp_extract(text, INTENT, 1)), config)
    found = F.transform(F.regexp_extract_all(text, F.lit(INTENT), F.lit(1)), lambda x: known_intent(x, config))
    return F.get(F.filter(found, lambda x: x.isNotNull()), 0)


def canonical_json(raw: Column) -> Column:
    """Compact JSON with sorted keys; other text trimmed; nothing gives an empty object. Numbers equal in value
    share a form, so 1 and 1.0 are one key."""
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("{}")).otherwise(F.coalesce(F.to_json(F.try_parse_json(raw)), F.btrim(raw)))


def interaction_key(tool: Column, arguments: Column, config: EngineConfig = DEFAULT) -> Column:
    return F.concat(bare_tool(tool, config), F.lit("|"), canonical_json(arguments))


def repaired_escaping(text: Column, rounds: int = 3) -> Column:
    """(text, rounds): literal escapes of line ends, tabs and quotes undone, as long as there is no real line end."""
    now, n = text, F.lit(0)
    for _ in range(rounds):
        apply = ~F.contains(now, F.lit("\n")) & F.contains(now, F.lit("\\n"))
        undone = F.replace(F.replace(F.replace(F.replace(now, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
        now, n = F.when(apply, undone).otherwise(now), n + apply.cast("int")
    return F.struct(now.alias("text"), n.alias("rounds"))


def protocol_date(raw: Column) -> Column:
    """A date that was stored as a timestamp, as a date again."""
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}T"), F.substring(raw, 1, 10)).otherwise(raw)


def is_operation_id(x: Column) -> Column:
    return x.rlike("^[0-9a-fA-F]{32}$")


def as_count(x: Column) -> Column:
    """A whole number from text, 0 if it is none."""
    return F.coalesce(F.try_cast(x, "bigint") if hasattr(F, "try_cast") else x.try_cast("bigint"), F.lit(0).cast("bigint"))


def front_matter_name(body: Column) -> Column:
    return filled(F.btrim(F.regexp_extract(body, r"(?m)^---\s*\nname:\s*([^\n]+)", 1)))

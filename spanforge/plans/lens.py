"""The driver's tables seen as spans. The mappings are SQL expressions that Spark and DuckDB read alike, so the same text
serves queries and oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.config import merged

WEEK_OP = "concat('op', user_id, '-w', CAST(floor((day(ts) - 1) / 7) AS BIGINT))"
USER_OP = "concat('u', user_id)"
#: Operations of which some are only before the split and some only after it.
HOUR_OP = "concat('u', user_id, '-', hour(ts))"
K = "CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS INT)"
TOOL = (
    "CASE event_type WHEN 'click' THEN 'srv___get' WHEN 'purchase' THEN 'srv___create' WHEN 'signup' THEN 'load_skill' "
    "ELSE 'srv___search' END"
)
ARGUMENTS = (
    "CASE WHEN ord % 17 = 0 THEN '{\"k\": \"x\"}' WHEN ord % 19 = 0 THEN '{}' WHEN ord % 23 = 0 THEN 'nope' "
    "WHEN ord % 29 = 0 THEN '{\"k\": 1, \"z\": 2}' ELSE props END"
)
RESULT = (
    "CASE WHEN event_type = 'error' THEN CASE k % 9 WHEN 0 THEN 'x not found in registry' WHEN 1 THEN 'Unknown reference type 4' "
    "WHEN 2 THEN 'f not found on service' WHEN 3 THEN 'Error: Script x' WHEN 4 THEN 'circuit open' WHEN 5 THEN 'validation_error' "
    "WHEN 6 THEN 'Error: timeout' WHEN 7 THEN '{\"error\": 1}' ELSE '' END "
    "WHEN event_type = 'signup' THEN concat('---', chr(10), 'name: skill', k % 5, chr(10), '---', chr(10), 'body ', k % 11) "
    "WHEN value < 15 THEN '{\"count\":0}' WHEN k = 42 THEN rpad('{\"data\":[1', 8192, 'x') ELSE concat('{\"data\":[', k, ']}') END"
)
#: (name, expression) of the columns of spans; each may use those before it.
COLUMNS = (
    ("agent", "concat('agent', ord % 2)"), ("tool", TOOL), ("arguments", ARGUMENTS), ("result", RESULT), ("success", "event_type <> 'error'"),
    ("duration", "value * 100"), ("name", "concat('execute_tool ', event_type)"), ("is_write", "event_type = 'purchase'"),
    ("is_a2a", "false"), ("call_id", "CASE WHEN ord % 3 = 0 THEN concat('c', ord) ELSE '' END"),
    ("definitions", "CASE WHEN ord % 10 = 0 THEN concat('[', rpad('', CAST(k % 4 AS INT), 'd'), ']') ELSE '' END"),
)
CHATS = (
    ("name", "CASE WHEN ord % 5 = 0 THEN 'invoke_agent a' ELSE 'chat m' END"), ("input", "CAST(k * 50 AS VARCHAR(20))"),
    ("cache_read", "CAST((ord % 100) * 40 AS VARCHAR(20))"), ("cache_write", "'7.0'"), ("output", "CAST(k AS VARCHAR(20))"),
    ("reasoning", "CAST(k % 7 AS VARCHAR(20))"), ("input_text", "'asked'"), ("output_text", "rpad('', CAST(k % 4 AS INT), 'y')"),
)
BOXES = "concat('POST /api/projects/p/toolboxes/tb', k % 3, '/versions/', k % 2, '/mcp')"
HANDOFF = (
    "CASE k WHEN 0 THEN 'intent: full triage.' WHEN 10 THEN 'intent=Bogus; intent=Enrichment' WHEN 30 THEN '{\"intent\": \"Write Request\"}' "
    "WHEN 40 THEN 'INTENT=Explanation; id=1' ELSE 'no mention' END"
)
#: What a run was asked, by ``m``, its first place.
ASKED = (
    "CASE m % 5 WHEN 0 THEN '[{\"role\": \"user\", \"parts\": [{\"content\": \"please run intent=Explanation, now\"}]}]' WHEN 1 THEN '{\"request\": \"intent: Bogus; intent: full triage\"}' "
    "ELSE 'Automated flow' END"
)
#: Objects in objects; what is no JSON makes the whole none.
NESTED = (
    "concat('{\"call\": ', arguments, ', \"at\": ', CASE WHEN ord % 2 = 0 THEN '{\"tool\": \"t\"}' ELSE 'null' END, ', \"more\": {\"deep\": {\"n\": ', ord, "
    "', \"o\": ', CASE WHEN ord % 3 = 0 THEN '1.5' ELSE '[{}]' END, '}}}')"
)
SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"
INTENT = "CASE WHEN CAST(regexp_extract(op_id, '([0-9]+)', 1) AS INT) % 3 = 0 THEN 'Full Triage' ELSE CAST(NULL AS VARCHAR(20)) END"

CONFIG = merged(
    {
        "expected": {"agent0|Full Triage": ["load_skill", "srv___get", "srv___create"], "agent1": ["srv___get", "srv___create"], "agent1|Full Triage": []},
        "most_tokens": 4000, "most_ms": 9000.0,
    }
)
# Tools with the schemas that calls are held against.
SCHEMAS = (
    ("get", '{"properties": {"k": {"type": "integer"}}, "required": ["k"]}'),
    ("search", '{"properties": {"k": {"type": "integer", "enum": [' + ", ".join(map(str, range(50))) + "]}}}"),
    ("create", '{"properties": {"k": {"type": ["string", "integer"]}}, "additionalProperties": false}'),
)
MANIFESTS = (("tb0", ["*"], ["get", "search"]), ("tb1", ["1"], ["get", "create"]), ("tb2", ["9"], ["create"]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _extended(rows: DataFrame, columns: tuple[tuple[str, str], ...]) -> DataFrame:
    for name, text in columns:
        rows = rows.withColumn(name, F.expr(text.replace("VARCHAR(20)", "STRING")))
    return rows


def base(spark: SparkSession, sf_dir: str, *, op: str = WEEK_OP, where: str = "true") -> DataFrame:
    rows = table(spark, sf_dir, "events").where(where).withColumnRenamed("event_id", "ord")
    return rows.withColumns({"k": F.expr(K), "op_id": F.expr(op)})


def spans(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _extended(base(spark, sf_dir, **options), COLUMNS)


def chats(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _extended(base(spark, sf_dir, **options), (COLUMNS[0], *CHATS))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extended(base(spark, sf_dir), (COLUMNS[0], ("name", BOXES)))


def handoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extended(base(spark, sf_dir), (COLUMNS[0], ("tool", "concat('agent', (ord + 1) % 2)"), ("arguments", HANDOFF), ("is_a2a", "true")))


def tools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, s, i) for i, (n, s) in enumerate(SCHEMAS)], "tool string, schema string, ord int")


def manifests(spark: SparkSession) -> DataFrame:
    rows = [(box, versions, i, t, "{}") for box, versions, names in MANIFESTS for i, t in enumerate(names)]
    return spark.createDataFrame(rows, "toolbox string, versions array<string>, ord int, tool string, schema string")


def expected(spark: SparkSession) -> DataFrame:
    """key, want (bare names)."""
    rows = [(k, [t.rsplit("___", 1)[-1] for t in v]) for k, v in CONFIG.expected.items()]
    return spark.createDataFrame(rows, "key string, want array<string>")


def _select(columns: tuple[tuple[str, str], ...], source: str, where: str = "true") -> str:
    """Nested selects, as each column may use those before it."""
    out = f"(SELECT * FROM {source} WHERE {where})"
    for name, text in columns:
        out = f"(SELECT *, {text} AS {name} FROM {out})"
    return out


def sql(name: str = "", *, op: str = WEEK_OP, where: str = "true") -> str:
    """Common table expressions with the lens for DuckDB: base, spans, steps, chats, boxes, handoffs, each with ``name`` appended."""
    kinds = " ".join(f"WHEN contains(substr(result, 1, 600), '{mark}') THEN '{kind}'" for kind, mark in CONFIG.signatures)
    marks = " OR ".join(f"contains(substr(result, 1, 600), '{m}')" for m in CONFIG.empty_marks)
    classified = (
        ("bare_tool", "string_split(tool, '___')[-1]"),
        ("error_kind", f"CASE WHEN result = '' THEN CASE WHEN NOT success THEN 'empty_failed' END {kinds} "
                       "WHEN starts_with(result, 'Error:') OR contains(substr(result, 1, 600), '\"error\"') THEN 'other_error' END"),
        ("errored", "error_kind IS NOT NULL"), ("empty", f"({marks})"), ("truncated", "length(result) = 8192"),
    )
    events = f"(SELECT event_id AS ord, * EXCLUDE (event_id) FROM events WHERE {where})"
    agent = COLUMNS[0]
    handoff = (agent, ("tool", "concat('agent', (ord + 1) % 2)"), ("arguments", HANDOFF))
    return (
        f"base{name} AS {_select((('k', K), ('op_id', op)), events)}, spans{name} AS {_select(COLUMNS, f'base{name}')}, "
        f"steps{name} AS {_select(classified, f'spans{name}')}, chats{name} AS {_select((agent, *CHATS), f'base{name}')}, "
        f"boxes{name} AS {_select((agent, ('name', BOXES)), f'base{name}')}, handoffs{name} AS {_select(handoff, f'base{name}')}"
    )

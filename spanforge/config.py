"""What the operators take as given, as data: vocabularies, limits and the gating set."""

from __future__ import annotations

from dataclasses import dataclass, field

# Error kinds with their signatures, in order of precedence.
SIGNATURES = (
    ("invalid_entity", "not found in registry"),
    ("invalid_reference_type", "Unknown reference type"),
    ("invalid_projection_field", "not found on service"),
    ("missing_script", "Error: Script"),
    ("circuit_open", "circuit open"),
    ("validation_error", "validation_error"),
    ("rate_limited", "rate_limited"),
    ("quota_exceeded", "quota_exceeded"),
)
# Marks of a result that holds nothing.
EMPTY_MARKS = ('"count":0', '"count_hint":0', '"matches":[]', '"data":[]', '"count": 0', '"count_hint": 0', '"matches": []', '"data": []')
# Intents that expectations may be keyed by.
INTENTS = (
    "Full Triage", "Normalization Only", "Classification Only", "Enrichment", "Resolved Ticket Review",
    "Information Request", "Write Request", "Explanation", "Detail Expansion",
)
# Kinds of errors of calls that could not have succeeded.
AVOIDABLE = ("missing_script", "invalid_reference_type", "invalid_entity", "invalid_projection_field", "empty_failed")
# Checks that hold back a release.
GATING = ("no_wasted_calls", "no_dead_ends", "trajectory", "valid_tool_args")
# Fixed value: how an attribute begins whose content is in another table.
PLACEHOLDER = "This attribute has moved to the genAIContent table"


@dataclass(frozen=True)
class EngineConfig:
    signatures: tuple[tuple[str, str], ...] = SIGNATURES
    empty_marks: tuple[str, ...] = EMPTY_MARKS
    intents: tuple[str, ...] = INTENTS
    avoidable: tuple[str, ...] = AVOIDABLE
    gating: tuple[str, ...] = GATING
    head: int = 600
    #: Characters of arguments that lists of calls show.
    head_arguments: int = 200
    truncated_at: int = 8192
    cascade_from: int = 4
    most_empty: float = 0.25
    most_tokens: int | None = None
    most_ms: float | None = None
    prefix: str = "___"
    agents: tuple[str, ...] = ()
    write_tools: tuple[str, ...] = ()
    write_prefixes: tuple[str, ...] = ()
    placeholder: str = PLACEHOLDER
    #: (agent or agent|intent) -> tools in order.
    expected: dict[str, tuple[str, ...]] = field(default_factory=dict)


DEFAULT = EngineConfig()


def merged(settings: dict | None = None, base: EngineConfig = DEFAULT) -> EngineConfig:
    """``base`` with ``settings`` laid over it, one level deep; keys that start with ``_`` are comments."""
    from dataclasses import replace

    known = {k: v for k, v in (settings or {}).items() if not k.startswith("_")}
    expected = known.get("expected")
    if expected is not None:
        known["expected"] = base.expected | {k: tuple(v) for k, v in expected.items() if not k.startswith("_")}
    return replace(base, **{k: tuple(v) if isinstance(v, list) else v for k, v in known.items()})

"""Pseudonyms for what identifies people and organisations: candidates, tokens, the sweep, and proof that nothing is left.

Candidates and tokens are Spark expressions. Only the sweep, the residual check and the decoding of text that is JSON or holds
escapes are Python, in Arrow batches; the first two share one automaton over the reviewed literals, so what the one replaces, the other finds.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators.literals import View, automaton, edited, folded, strings_of

# Shapes of literals, by kind, in order of precedence; kinds with ? are for review.
EMAIL = r"[\w.+-]+@[\w-]+\.[\w.-]+"
PHONE = r"(?<![\w.])(?:\+?\d{1,3}[\s-]?)?(?:\\?\(\d{3}\\?\)|\d{3})[\s.-]?\d{3}[\s.-]?\d{4}(?!\w|\.\d)"
SHAPES = (
    ("EMAIL", EMAIL),
    ("PHONE", PHONE),
    ("IP?", r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w.])"),
    ("PHONE?", r"(?<![\w.-])\d{3}-\d{4}(?![\w-])"),
    ("PLACE?", r"(?<![\w.-])\d{5}-\d{4}(?![\w-])"),
    ("USER?", r"\b[A-Z][A-Z0-9-]{1,14}\\{1,2}[A-Za-z][\w.-]{1,30}"),
    ("DOMAIN?", r"(?i)(?<![\w@.-])(?=[a-z0-9][a-z0-9-]*+\.)(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+(?:com|net|org|local|lan|corp|internal|io|us|gov|edu|biz|info|co|ca)(?![\w-])"),
    ("HOST?", r"\b[A-Z][A-Z0-9]*(?:-[A-Z0-9]+)*-[A-Z]*\d+[A-Z0-9]*\b"),
)
# Words that join parts of a name, and words that come before one.
CONNECTORS = "of|de|del|da|la|le|van|von|der|and|&"
CUES = "hi|hello|hey|dear|thanks|thank you|regards|cheers|contact|caller|user|requester|from|by|for|with|cc"
GREETINGS = "hi|hello|hey|dear|thanks|regards|cheers|thank|you"
# A word begins where no letter is before it, and none that a mark joins to it. What a match begins with is looked at first, as it rules out most places.
CAPITAL = r"(?=\p{Lu})(?<!\p{L})(?<!\p{L}['`.-])\p{Lu}\p{L}*+(?:['`.-]\p{L}++)*+\.?"
NEXT_WORD = rf"[^\S\n]+(?:(?:{CONNECTORS})\s+)?"
# A run of words; the last + is possessive, which keeps a run of thousands of words off the stack.
PHRASE = rf"(?U){CAPITAL}(?:{NEXT_WORD}{CAPITAL})++"
# A single word behind a cue, unless both are of one run: a cue in lower case, one with a mark, or one on the line before.
_LOWER = "|".join(f"{x[0]}(?i:{x[1:]})" for x in CUES.split("|"))
CUED = rf"(?U)(?=\p{{Lu}})(?<=\b(?:{_LOWER})[,:]?\s{{0,20}}|\b(?i:{CUES})(?:[,:]\s{{0,20}}|[^\S\n]{{0,9}}\n\s{{0,10}}))({CAPITAL})(?!{NEXT_WORD}\p{{Lu}})"
GREETED = rf"(?U)^(?:(?i:{GREETINGS})[.,]*\s+)+"
# Names of tools.
TOOL_NAME = r"^[\w.-]*___[\w.-]+$|^(cw_|load_skill|run_skill|tool_)"
LEAST, LEAST_NAME, MOST = 4, 3, 120
# JSON keys whose values are proposed whole, and the kind by what a key holds.
SENSITIVE = frozenset(
    "contact contactname contactemailaddress contactemail contactphone firstname lastname nickname fullname name email emailaddress phone "
    "phonenumber mobilephone company companyname site sitename addressline1 addressline2 city state zip country summary description "
    "initialdescription text notes note auditnote title query identifier companyidentifier username membername enteredby updatedby "
    "createdby closedby".split()
)
KEY_KINDS = (("email", "EMAIL"), ("phone", "PHONE"), ("company", "COMPANY"), ("site", "PLACE"), ("address", "PLACE"), ("contact", "PERSON"), ("name", "PERSON"))
# Attributes whose values are what people and tools have said.
PAYLOADS = (
    "gen_ai.tool.call.arguments", "gen_ai.tool.call.result", "gen_ai.input.messages", "gen_ai.output.messages", "gen_ai.system_instructions",
)
#: A reviewed list is sent to all executors; a longer one is refused.
MOST_LITERALS = 50_000
#: Texts that a task of the sweep turns into strings at once.
PIECE = 128


def decoded(text: str) -> Iterator[tuple[str | None, str, bool]]:
    """(key, string, whether in a schema) of every string in ``text``, nested JSON decoded and escapes undone."""
    for leaf in strings_of(text) or ([(None, text, False)] if "\\" in text else []):
        # A lone half of a pair of escapes is no character of a string.
        yield leaf[0], View(leaf[1]).text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace"), leaf[2]


def decoded_strings(text: str) -> Column:
    """The strings that decoding finds in a text; null for one that is neither JSON nor holds an escape."""
    @F.pandas_udf("array<struct<key: string, value: string, schema: boolean>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if x is None else [{"key": k, "value": v, "schema": s} for k, v, s in decoded(x)] for x in batch], dtype=object)

    return run(F.when(may_decode(F.col(text)), F.col(text)))


def may_decode(text: Column) -> Column:
    """Whether a text may be JSON or holds an escape."""
    return F.contains(text, F.lit("\\")) | text.rlike(r"^\s*[\[{]")


def candidates(texts: DataFrame, text: str = "text", *, known: tuple[str, ...] = (), stop: tuple[str, ...] = (), schema: str | None = None) -> DataFrame:
    """literal, kind, n: what looks like an identity, for review. The kind of the first shape that finds a literal holds.
    ``known`` (lower case) are vocabularies that names are not proposed from, ``stop`` domains of vendors, and ``schema`` a
    condition on rows that hold schemas or skills, where no names are sought. Decoded strings are searched next to the text as it
    is, outside of schemas, and values of sensitive keys are proposed; ``n`` counts in the text as it is, or else in those."""
    # Kinds by place, those of keys before all shapes; a number is summed up by hash, where a name would need a sort.
    kinds = [*dict.fromkeys(kind for _, kind in KEY_KINDS), "VALUE", *(kind for kind, _ in SHAPES), "NAME?"]
    first = len(kinds) - len(SHAPES) - 1

    def marked(literals: Column, place: int) -> Column:
        return F.transform(literals, lambda x: F.struct(x.alias("literal"), F.lit(first + place).alias("place")))

    def searched(text: Column) -> Column:
        digits, none = text.rlike(r"\d"), F.array().cast("array<string>")
        # What a shape can't do without is looked for first.
        guards = {"EMAIL": F.contains(text, F.lit("@")), "USER?": F.contains(text, F.lit("\\")), "DOMAIN?": F.contains(text, F.lit("."))}
        found = [
            marked(F.when(guards.get(kind, digits), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none), place)
            for place, (kind, pattern) in enumerate(SHAPES)
        ]
        # A greeting at the front is no part of a name; what is left behind it is named, be it one word.
        runs = F.transform(F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0)), lambda x: F.regexp_replace(x, GREETED, ""))
        runs = F.filter(runs, lambda x: ~x.rlike(rf"(?U)^(?i:{GREETINGS})[.,]*$"))
        names = F.concat(runs, F.regexp_extract_all(text, F.lit(CUED), F.lit(1)))
        names = marked(F.transform(names, lambda x: F.rtrim(x, F.lit("."))), len(SHAPES))
        if schema:
            names = F.when(F.col("_schema"), F.slice(names, 1, 0)).otherwise(names)
        return F.concat(*found, names)

    def keyed(x: Column) -> Column:
        key = F.lower(x["key"])
        place = F.lit(kinds.index("VALUE"))
        for part, name in reversed(KEY_KINDS):
            place = F.when(F.contains(key, F.lit(part)), F.lit(kinds.index(name))).otherwise(place)
        return F.struct(F.btrim(x["value"]).alias("literal"), place.alias("place"))

    rows = texts.withColumn("_schema", F.expr(schema or "false"))
    strings = F.filter("_d", lambda x: ~x["schema"])
    values = F.transform(F.filter(strings, lambda x: F.coalesce(F.lower(x["key"]).isin(*SENSITIVE), F.lit(False))), keyed)
    raw = rows.select(F.explode(searched(F.col(text))).alias("x"))
    # Few texts hold JSON or escapes, and only these go to Python; what the text as it is shows of a literal already is not counted twice.
    some = rows.where(may_decode(F.col(text))).withColumn("_d", decoded_strings(text)).where(F.size("_d") > 0)
    some = some.select(searched(F.col(text)).alias("_r"), values.alias("_v"), strings.alias("_s"), "_schema")
    seen = F.transform("_r", lambda x: x["literal"])
    inside = F.flatten(F.transform("_s", lambda x: searched(x["value"])))
    more = some.select("_v", F.filter(inside, lambda x: ~F.array_contains(seen, x["literal"])).alias("_i"))
    rows = raw.union(more.select(F.explode(F.concat("_v", "_i")).alias("x"))).select("x.*")
    size = F.length("literal")
    least = F.when(F.col("place") == kinds.index("NAME?"), LEAST_NAME).otherwise(LEAST)
    digits = F.length(F.regexp_replace("literal", r"\D", ""))
    rows = rows.where((size >= least) & (size <= MOST) & ~F.col("literal").rlike(TOOL_NAME))
    rows = rows.where((~F.col("place").isin([i for i, kind in enumerate(kinds) if kind == "PHONE"])) | ((digits >= 10) & ~F.col("literal").rlike(r"^\d{4}-\d{2}-\d{2}")))
    if known:
        words = F.transform(F.split(F.lower("literal"), r"\s+"), lambda w: F.btrim(w, F.lit(".'`-")))
        new = F.exists(words, lambda w: (w != "") & ~w.isin(*known))
        rows = rows.where((F.col("place") != kinds.index("NAME?")) | new)
    for domain in stop:
        rows = rows.where((F.col("place") != kinds.index("DOMAIN?")) | ~((F.lower("literal") == domain) | F.endswith(F.lower("literal"), F.lit("." + domain))))
    found = rows.groupBy("literal").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    return found.select("literal", F.get(F.array(*map(F.lit, kinds)), F.col("place")).alias("kind"), "n")


def without_skills(found: DataFrame, texts: DataFrame, text: str = "text") -> DataFrame:
    """``found`` (literal, kind, ...) without the names that a skill file holds: what we wrote ourselves names nobody. Skill files are the ``texts``
    that begin as such. One automaton over the names passes over each of them."""
    names = found.where("kind = 'NAME?'").select(F.lower("literal").alias("literal"))
    literals = _listed(names)
    bodies = texts.where(F.col(text).rlike(r"\A\s*---\nname:")).select(F.col(text).alias("text"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hits = automaton(tuple(literals)), set()
        for batch in batches:
            for x in batch.column(0):
                hits |= known.within(x.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(hits), pa.string())], names=["_held"])

    ours = bodies.mapInArrow(held, "_held string").distinct()
    return found.join(ours, (F.col("kind") == "NAME?") & (F.lower("literal") == F.col("_held")), "left_anti")


def token(literal: Column, kind: Column, salt: str) -> Column:
    """KIND_ and eight hex digits of a salted digest, the same for any case."""
    if len(salt) < 16:
        raise ValueError("a salt has 16 characters at least")
    return F.concat(F.upper(F.rtrim(kind, F.lit("?"))), F.lit("_"), F.substring(F.sha2(F.concat(F.lit(salt), F.lower(literal)).cast("binary"), 256), 1, 8))


def tokens(literals: DataFrame, salt: str) -> DataFrame:
    """key (lower case), kind, token: one for each literal in any case, of the kind that comes first."""
    first = literals.groupBy(F.lower("literal").alias("key")).agg(F.min("kind").alias("kind"))
    return first.withColumn("token", token(F.col("key"), F.col("kind"), salt))


def fingerprint(salt: str) -> str:
    """Tells salts apart without telling them."""
    return hashlib.sha256(b"scrub-salt-fingerprint-v1|" + salt.encode()).hexdigest()[:12]


def reviewed(rows: DataFrame, protected: DataFrame) -> DataFrame:
    """literal, kind of a reviewed list (key, value): a key that starts with ``_`` is a comment, unless its value is a kind.
    A literal of the protected vocabulary (literal) is refused."""
    kind = r"^[A-Z][A-Z_]*\??$"
    kept = rows.where(~F.startswith("key", F.lit("_")) | F.col("value").rlike(kind)).select(F.col("key").alias("literal"), F.col("value").alias("kind"))
    marked = kept.join(protected.select(F.lower("literal").alias("_p")).distinct(), F.lower("literal") == F.col("_p"), "left")
    refused = F.raise_error(F.concat(F.lit("protected: "), "literal"))
    return marked.select(F.when(F.col("_p").isNotNull(), refused).otherwise(F.col("literal")).alias("literal"), "kind")


@dataclass(frozen=True)
class Sweeper:
    """Replaces e-mail addresses, phone numbers and listed literals, in this order; in JSON text, in values only."""

    salt: str
    #: Tokens by literal in lower case.
    listed: dict[str, str]

    def run(self) -> Callable[[str], str]:
        known, email, phone = automaton(tuple(self.listed)), re.compile(EMAIL), re.compile(PHONE)
        tokens = {folded(k): v for k, v in self.listed.items()}

        def named(kind: str) -> Callable[[re.Match], str]:
            return lambda m: f"{kind}_{hashlib.sha256((self.salt + m[0].lower()).encode()).hexdigest()[:8]}"

        def change(text: str) -> str:
            text = phone.sub(named("PHONE"), email.sub(named("EMAIL"), text))
            return known.replaced(text, tokens.__getitem__)

        return lambda text: edited(text, change)

    def concerns(self, text: Column) -> Column:
        """Whether a text may change: without a list, one that has neither an address nor the digits of a number, nor holds others, does not."""
        if self.listed:
            return F.lit(True)
        return F.contains(text, F.lit("@")) | text.rlike(r"\d{3}") | F.contains(text, F.lit("\\"))


def _sweeper(found: DataFrame, salt: str) -> Sweeper:
    """From the literals of a reviewed list (literal, kind), whose size is checked."""
    rows = tokens(found, salt).limit(MOST_LITERALS + 1).collect()
    if len(rows) > MOST_LITERALS:
        raise ValueError(f"more than {MOST_LITERALS} literals")
    return Sweeper(salt, {r["key"]: r["token"] for r in rows})


def swept(df: DataFrame, columns: list[str], found: DataFrame, salt: str) -> DataFrame:
    """``df`` with the text of ``columns`` swept. ``found``: literal, kind, of a reviewed list."""
    sweeper = _sweeper(found, salt)

    @F.arrow_udf("string")
    def sweep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = sweeper.run()
        for batch in batches:
            # A few texts at a time are strings of Python, however many a batch holds.
            for i in range(0, max(1, len(batch)), PIECE):
                yield pa.array([None if x is None else one(x) for x in batch[i : i + PIECE].to_pylist()], pa.string())

    may = {c: sweeper.concerns(F.col(c)) for c in columns}
    return df.withColumns({c: F.when(may[c], sweep(F.when(may[c], F.col(c)))).otherwise(F.col(c)) for c in columns})


def payloads(rows: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``rows`` (with the bag ``d``) but these, and name and value of each attribute or column of ``columns`` that
    holds what people and tools have said, if it holds anything."""
    given = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    inside = [F.struct(F.lit(a).alias("name"), F.col("d")[a].alias("value")) for a in PAYLOADS]
    some = F.filter(F.array(*inside, *given), lambda x: F.coalesce(x["value"], F.lit("")) != "")
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns if c not in ("d", *columns)), F.inline(some))


def scrubbed(rows: DataFrame, found: DataFrame, salt: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with all values of the bag ``d`` and the text of ``columns`` swept; keys of the bag stay."""
    sweeper = _sweeper(found, salt)

    @F.pandas_udf("array<string>")
    def sweep(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = sweeper.run()
        for batch in batches:
            yield batch.map(lambda values: None if values is None else [x if x is None else one(x) for x in values])

    names = [f"`{c}`" for c in columns]
    texts = F.concat(F.coalesce(F.map_values("d"), F.array().cast("array<string>")), F.array(*names).cast("array<string>"))
    done = rows.withColumn("_swept", sweep(texts)).withColumn("_n", F.coalesce(F.cardinality("d"), F.lit(0)))
    bag = F.when(F.col("d").isNotNull(), F.map_from_arrays(F.map_keys("d"), F.slice("_swept", 1, F.col("_n"))))
    return done.withColumns({"d": bag} | {c: F.get("_swept", F.col("_n") + i) for i, c in enumerate(columns)}).drop("_swept", "_n")


def sidecar(spark: SparkSession, found: DataFrame, salt: str, source: str) -> DataFrame:
    """One row to keep next to swept data: which salt, how many literals and tokens, from what."""
    counted = found.agg(F.count("*").alias("literals"), F.count_distinct(F.lower("literal")).alias("tokens_issued"))
    return counted.select(F.lit(fingerprint(salt)).alias("salt_fingerprint"), "literals", "tokens_issued", F.lit(source).alias("source"), F.current_timestamp().alias("scrubbed_utc"))


def _listed(found: DataFrame) -> list[str]:
    """The literals of a reviewed list, whose size is checked."""
    rows = found.select("literal").where("literal <> ''").distinct().limit(MOST_LITERALS + 1).collect()
    if len(rows) > MOST_LITERALS:
        raise ValueError(f"more than {MOST_LITERALS} literals")
    return [r["literal"] for r in rows]


def still_there(texts: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """literal, n: literals that texts still hold, as they are or decoded, in any case, bounded as the sweep bounds them, and in how many texts. The
    automaton of the sweep passes over each text once, and over each string that decoding finds; only counts leave a task."""
    literals = _listed(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = automaton(tuple(literals))
        spelled: dict[str, list[str]] = {}
        for x in literals:
            spelled.setdefault(folded(x), []).append(x)
        hits: Counter = Counter()
        for batch in batches:
            for x in batch.column(0):
                whole = x.as_py() or ""
                inside = {hit for part in (whole, *(leaf.text for leaf in strings_of(whole) or ())) for _, _, hit in known.found(part)}
                hits.update(literal for hit in inside for literal in spelled[hit])
        yield pa.RecordBatch.from_arrays([pa.array(list(hits), pa.string()), pa.array(list(hits.values()), pa.int64())], names=["literal", "n"])

    return texts.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "literal string, n long").groupBy("literal").agg(F.sum("n").alias("n"))

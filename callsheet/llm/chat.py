"""Chat formatting: schema fingerprints choose declarative mappings into canonical turns.

A record's fingerprint is the hash of its nested field paths, as far as any
known layout uses them. Each mapping states which fields hold the turns; the
paths of its fields give the fingerprints it answers to. Records come as a
JSON column (hashed row by row) or as typed columns (one hash of the schema);
tables with a row for each turn are grouped by conversation. DataFrame
functions only.

The template writes ``<|im_start|>role``, a line end, the text and
``<|im_end|>`` with a line end for each turn. Inside texts and roles a
backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a control
string, and reading back undoes it exactly. The output is kept in segments,
each under the loss mask or not: the assistant's texts are, nothing else is.

Defined results: null text or role is empty; turns are ordered by turn number
(null first), then role and text, so ties and repeated rows have one order;
rows of a null conversation are one conversation; records of an unknown
fingerprint have layout null and no turns; extra fields are ignored. One
conversation becomes one string, so it must fit a row, as its digest asks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A mapping: a list of messages (``items``), or fields that are turns by themselves (``parts``)."""

    name: str
    items: tuple[str, str, str] | None = None  # list, role, text
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()  # role, fields joined by an empty line
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()  # names that stand for a canonical role

    def paths(self) -> list[str]:
        if self.items:
            a, *fields = self.items
            return [a, *(f"{a}[].{f}" for f in fields)]
        return [f for _, fields in self.parts for f in fields if f not in self.optional]

    def fingerprints(self) -> list[str]:
        """Of every choice of its optional fields."""
        options = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [fingerprint([*self.paths(), *o]) for o in options]


@dataclass(frozen=True)
class RowLayout:
    """A table with one row for each turn."""

    conversation: str
    turn: str
    role: str
    text: str


_SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("messages", items=("messages", "role", "content"), optional=("system",)),
    Layout("from_value", items=("conversations", "from", "value"), optional=("system",), roles=_SPEAKERS),
    Layout("speaker_turns", items=("turns", "speaker", "utterance"), roles=_SPEAKERS),
    Layout("prompt_response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("prompt_completion", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("instruction", parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
           optional=("system", "input")),
    Layout("question_answer", parts=(("user", ("question",)), ("assistant", ("answer",)))),
)
ROW_LAYOUTS = (RowLayout("conv_id", "turn", "role", "text"), RowLayout("conversation_id", "position", "speaker", "utterance"))
_LISTS = tuple(x.items[0] for x in LAYOUTS if x.items)
KNOWN = sorted({p for x in LAYOUTS for p in (*x.paths(), *x.optional)})


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def schema_paths(kind: DataType, prefix: str = "") -> list[str]:
    """The nested field paths of a schema."""
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    if isinstance(kind, StructType):
        sep = f"{prefix}." if prefix else ""
        return [p for f in kind.fields for p in (f"{sep}{f.name}", *schema_paths(f.dataType, f"{sep}{f.name}"))]
    return []


def row_layout(df: DataFrame) -> RowLayout | None:
    """The row layout whose fields the table has: by the fingerprint of the paths that row layouts know."""
    known = {f for x in ROW_LAYOUTS for f in vars(x).values()}
    print_ = fingerprint([p for p in schema_paths(df.schema) if p in known])
    by_print = {fingerprint(list(vars(x).values())): x for x in ROW_LAYOUTS}
    return by_print.get(print_) or next((x for x in ROW_LAYOUTS if set(vars(x).values()) <= set(df.columns)), None)


def json_fingerprint(record: Column) -> Column:
    """The same hash, of a JSON record; a list's fields are those of any of its elements."""
    paths = [F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))]
    def below(name: str):
        return lambda key: F.concat(F.lit(f"{name}[]."), key)

    for name in _LISTS:
        items = F.from_json(F.get_json_object(record, f"$.{name}"), "array<map<string,string>>")
        keys = F.flatten(F.transform(items, lambda m: F.map_keys(m)))
        paths.append(F.transform(F.coalesce(keys, F.array().cast("array<string>")), below(name)))
    known = F.array(*(F.lit(p) for p in KNOWN))
    return F.sha2(F.concat_ws("\n", F.array_sort(F.array_intersect(F.concat(*paths), known))), 256)


def _turns(layout: Layout, record: Column) -> Column:
    def field(name: str) -> Column:
        return F.get_json_object(record, f"$.{name}")

    def turn(role: Column, text: Column) -> Column:
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if layout.items:
        name, role, text = layout.items
        roles = F.create_map(*(F.lit(x) for pair in layout.roles for x in pair)) if layout.roles else None

        def mapped(m: Column) -> Column:
            said = m[role]
            return turn(F.coalesce(roles[said], said) if roles is not None else said, m[text])

        listed = F.transform(F.from_json(field(name), "array<map<string,string>>"), mapped)
        system = F.when(field("system").isNotNull(), F.array(turn(F.lit("system"), field("system")))) \
            .otherwise(F.array().cast(TURNS)) if "system" in layout.optional else F.array().cast(TURNS)
        return F.concat(system, listed)
    turns = [F.when(F.lit(fields[0] not in layout.optional) | field(fields[0]).isNotNull(), turn(
        F.lit(role), F.concat_ws("\n\n", *(field(f) for f in fields)))) for role, fields in layout.parts]
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def canonical_records(df: DataFrame, record: str) -> DataFrame:
    """The rows with ``layout`` and ``turns`` of the JSON in a column."""
    found = df.withColumn("_print", json_fingerprint(F.col(record)))
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for x in LAYOUTS:
        hit = F.col("_print").isin(x.fingerprints())
        layout = F.when(hit, F.lit(x.name)).otherwise(layout)
        turns = F.when(hit, _turns(x, F.col(record)).cast(TURNS)).otherwise(turns)
    return found.withColumns({"layout": layout, "turns": turns}).drop("_print")


def canonical(df: DataFrame) -> DataFrame:
    """conv_id and turns, of a table with a row a turn; else the rows with layout and turns of their typed columns."""
    rows = row_layout(df)
    if rows is None:
        return canonical_records(df.withColumn("_record", F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))), "_record") \
            .drop("_record")
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (rows.role, rows.text)]
    picked = df.select(F.col(f"`{rows.conversation}`").alias("conv_id"),
                       F.struct(F.col(f"`{rows.turn}`").alias("turn"), text[0].alias("role"), text[1].alias("text")).alias("t"))
    return picked.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(conversations: DataFrame) -> DataFrame:
    """Adds ``segments``, (text, loss) in order; together they are the formatted conversation."""
    def segments(t: Column) -> Column:
        head = F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
                       F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss")))

    return conversations.withColumn("segments", F.flatten(F.transform("turns", segments)))


def read_back(output: DataFrame) -> DataFrame:
    """Adds the formatted text, its turns as parsed from it, and the unescaped texts under the loss mask."""
    whole = output.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    split = whole.withColumn("_marked", F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30))

    def parsed(x: Column) -> Column:
        head = F.substring_index(x, "\n", 1)
        body = F.substring_index(F.substr(x, F.length(head) + 2), END, 1)
        return F.struct(unescape(F.replace(head, F.lit(LINE), F.lit("\n"))).alias("role"), unescape(body).alias("text"))

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return split.withColumns({"read_turns": F.transform("_marked", parsed), "loss_texts": loss}).drop("_marked")


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, the counts and checksums of what is read back from the output."""
    back = read_back(formatted(conversations))
    said = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.withColumn("_loss", F.array_join("loss_texts", "")).select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))

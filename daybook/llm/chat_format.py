r"""Chat formatting by schema fingerprint (DataFrame operations only).

A layout is declared as data: the nested field paths it consists of and where
role and text sit in them. Its fingerprint is the SHA-256 of its sorted paths.
A table is matched by the paths of its schema, a JSON record by the paths of
its own value (``schema_of_variant``), row by row, so one column may mix
prompt, instruction and message layouts. Each layout turns into canonical
turn rows ``(conv_id, turn, role, text)``.

Template, per turn::

    <turn ROLE>\n TEXT </turn>\n        (without the blanks)

ROLE is URL-encoded. In TEXT a backslash is doubled, then ``<turn`` becomes
``<\turn`` and ``</turn`` becomes ``<\/turn``: no text can hold a control
string, and the reverse replacements restore it exactly.

Defined results: null text or role counts as empty; turns are ordered by
turn, role, text (nulls first), so ties and repeated rows are kept in a fixed
order; rows with a null conversation id form one conversation; a record whose
fingerprint is unknown gives no turns and ``layout`` is null; an empty table
gives an empty result; columns outside a layout's paths are ignored. A
conversation is one output row, so all its turns meet in one task.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """``paths``: nested fields, ``[]`` for array elements. ``turns``: (role, paths joined by a blank line)
    for flat layouts. ``items``: (array, role field, text field) for message lists. ``rows``: (conversation,
    turn, role, text) columns of a table with a row per turn."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None
    rows: tuple[str, str, str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths) -> str:
    return hashlib.sha256("|".join(sorted(paths)).encode()).hexdigest()


LAYOUTS = (
    Layout("turn_rows", ("conv_id", "role", "text", "turn"), rows=("conv_id", "turn", "role", "text")),
    Layout("messages", ("messages[].content", "messages[].role"), items=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), items=("conversations", "from", "value")),
    Layout("prompt_completion", ("prompt", "completion"), turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt_response", ("system", "prompt", "response"), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", ("instruction", "output"), turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", ("instruction", "input", "output"), turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question_answer", ("question", "answer"), turns=(("user", ("question",)), ("assistant", ("answer",)))),
)
# Other names of the canonical roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """The nested leaf paths of a schema, ``[]`` marking array elements."""
    out: list[str] = []
    for f in schema.fields:
        kind, path = f.dataType, f"{prefix}{f.name}"
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, f"{path}[]"
        out += schema_paths(kind, f"{path}.") if isinstance(kind, T.StructType) else [path]
    return out


def table_layout(schema: T.StructType, layouts=LAYOUTS) -> Layout | None:
    """The layout of a table: by the fingerprint of its paths, else by that of the largest layout they contain."""
    paths = schema_paths(schema)
    by_print = {x.fingerprint: x for x in layouts}
    if (own := by_print.get(fingerprint(paths))) is not None:
        return own
    inside = [x for x in layouts if set(x.paths) <= set(paths)]
    return max(inside, key=lambda x: len(x.paths), default=None)


def table_turns(df: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns of a typed table with a row per turn or per conversation (then with a ``conv_id``)."""
    layout = table_layout(df.schema, layouts)
    if layout is None:
        raise ValueError(f"no layout has the paths {schema_paths(df.schema)}")
    if layout.rows:
        conv, turn, role, text = layout.rows
        return df.select(
            F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(text).alias("text"), F.lit(layout.name).alias("layout"),
        )  # fmt: skip; roles of turn rows are taken as they are, names in records are mapped
    if layout.items:
        name, role, text = layout.items
        turns = F.transform(F.col(name), lambda x: F.struct(x[role].cast("string").alias("role"), x[text].cast("string").alias("text")))
    else:
        turns = F.array(*(F.struct(F.lit(r).alias("role"), _joined([F.col(p).cast("string") for p in ps]).alias("text")) for r, ps in layout.turns))
    return _exploded(df.select(F.col("conv_id").cast("long").alias("conv_id"), turns.alias("turns"), F.lit(layout.name).alias("layout")))


def _role(c: Column) -> Column:
    out = F.when(c.isin(*ROLE_NAMES), F.create_map(*(F.lit(x) for kv in ROLE_NAMES.items() for x in kv))[c])
    return out.otherwise(F.coalesce(c, F.lit("")))


def _joined(parts: list[Column]) -> Column:
    """The parts that are neither null nor empty, a blank line between them."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), "\n\n")


def _exploded(df: DataFrame) -> DataFrame:
    rows = df.select("conv_id", "layout", F.posexplode("turns").alias("turn", "x"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _role(F.col("x.role")).alias("role"), F.col("x.text").alias("text"), "layout")


def json_shape(paths) -> str:
    """What ``record_shape`` gives for a record with these paths."""
    tree: dict = {}
    for p in paths:
        at, names = tree, re.split(r"\.|(?=\[\])", p)
        for n in names:
            at = at.setdefault(n, {})

    def show(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{show(node['[]'])}>"
        return "OBJECT<" + ", ".join(f"{k}: {show(v)}" for k, v in sorted(node.items())) + ">" if node else "_"

    return show(tree)


def record_shape(variant: Column) -> Column:
    """The nested field names of a JSON value, its scalar types left out."""
    return F.regexp_replace(F.schema_of_variant(variant), r"\b(?!ARRAY<|OBJECT<)[A-Z]+(\(\d+,\d+\))?(?=[,>]|$)", "_")


def record_turns(records: DataFrame, id_col: str, json_col: str, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns of JSON records of mixed layouts; ``unknown_records`` finds the others."""
    found = _fingerprinted(records, id_col, json_col)
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    name = F.lit(None).cast("string")
    for x in layouts:
        if x.rows:
            continue
        hit = F.col("print") == F.sha2(F.lit(json_shape(x.paths)), 256)
        if x.items:
            field, role, text = x.items
            own = F.variant_get("v", f"$.{field}", f"array<struct<`{role}`:string,`{text}`:string>>")
            own = own.cast("array<struct<role:string,text:string>>")  # fields by position
        else:
            own = F.array(*(F.struct(F.lit(r).alias("role"), _joined([F.variant_get("v", f"$.{p}", "string") for p in ps]).alias("text")) for r, ps in x.turns))
        turns, name = F.when(hit, own).otherwise(turns), F.when(hit, F.lit(x.name)).otherwise(name)
    return _exploded(found.select("conv_id", name.alias("layout"), turns.alias("turns")))


def unknown_records(records: DataFrame, id_col: str, json_col: str, layouts=LAYOUTS) -> DataFrame:
    """Records that no layout fits: ``conv_id, shape``."""
    known = [json_shape(x.paths) for x in layouts if not x.rows]
    found = _fingerprinted(records, id_col, json_col)
    return found.where(~F.coalesce(F.col("shape").isin(known), F.lit(False))).select("conv_id", "shape")


def _fingerprinted(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    parsed = records.select(F.col(id_col).cast("long").alias("conv_id"), F.try_parse_json(F.col(json_col)).alias("v"))
    parsed = parsed.withColumn("shape", record_shape(F.col("v")))
    return parsed.withColumn("print", F.sha2(F.col("shape"), 256))


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("<turn"), F.lit("<\\turn"))
    return F.replace(text, F.lit("</turn"), F.lit("<\\/turn"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("<\\/turn"), F.lit("</turn"))
    text = F.replace(text, F.lit("<\\turn"), F.lit("<turn"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, layout, formatted, pieces``: pieces cut ``formatted`` into spans, ``loss`` true under the loss mask."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = turns.groupBy("conv_id").agg(
        F.min("layout").alias("layout"),
        F.sort_array(F.collect_list(F.struct("turn", F.col("role"), text.alias("text")))).alias("t"),
    )
    pieces = F.flatten(
        F.transform(
            "t",
            lambda x: F.array(
                F.struct(F.concat(F.lit("<turn "), F.url_encode(x["role"]), F.lit(">\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(x["text"]).alias("text"), (x["role"] == trained_role).alias("loss")),
                F.struct(F.lit("</turn>\n").alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    rows = rows.select("conv_id", "layout", pieces.alias("pieces"))
    return rows.select("conv_id", "layout", F.array_join(F.col("pieces.text"), "").alias("formatted"), "pieces")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``(role, text)``."""
    parts = F.split(formatted, "</turn>\n", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            F.url_decode(F.regexp_extract(p, "^<turn ([^>]*)>\n", 1)).alias("role"),
            unescape(F.regexp_replace(p, "^<turn [^>]*>\n", "")).alias("text"),
        ),
    )


def digest(chats: DataFrame) -> DataFrame:
    """What can be read back from the output of ``format_chats``, as counts and SHA-256 digests."""
    said = F.array_join(F.transform(read_back(F.col("formatted")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
    read = chats.select("conv_id", "formatted", said.alias("said"), loss.alias("loss"), F.size(read_back(F.col("formatted"))).cast("long").alias("n_turns"))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

"""Conversations of any layout, as canonical turns and as formatted training text.

Layouts are recognised by a fingerprint: the hash of the sorted nested field paths of a record. A
fingerprint selects a declarative mapping (one SQL expression over the record) to canonical turns,
an array of (role, text). ``to_turns`` fingerprints the type of a struct column; ``json_to_turns``
fingerprints every JSON record on its own, so one column may mix layouts.

``format_turns`` renders turns with control strings, which are escaped inside roles and texts so that
``read_back`` recovers them exactly, and adds a loss mask: the spans of the assistant texts.

Only DataFrame functions are used.

Defined cases: a null role or text counts as empty; turns with equal numbers are ordered by role, then
text, and repeated rows are repeated turns; rows without a conversation id are a conversation each; roles
keep their names, but those of ROLES in layouts that other tools write (all but ``turns`` and ``numbered``); an
unknown layout has null turns (``to_turns`` refuses it, as every row would be lost); a record without
turns formats as the empty text; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

TURNS = "array<struct<role:string,text:string>>"

#: other names of the roles
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

# ------------------------------------------------------------------------------- layouts

#: layout -> (field paths, turns as SQL over the record `r`)
LAYOUTS = {
    "messages": (("messages", "messages[].role", "messages[].content"),
                 "transform(r.messages, m -> named_struct('role', m.role, 'text', m.content))"),
    "turns": (("turns", "turns[].role", "turns[].text"),
              "transform(r.turns, m -> named_struct('role', m.role, 'text', m.text))"),
    "numbered": (("turns", "turns[].turn", "turns[].role", "turns[].text"),
                 "transform(array_sort(r.turns), m -> named_struct('role', m.role, 'text', m.text))"),
    "from_value": (("conversations", "conversations[].from", "conversations[].value"),
                   "transform(r.conversations, m -> named_struct('role', m.`from`, 'text', m.value))"),
    "prompt": (("prompt", "completion"),
               "array(named_struct('role', 'user', 'text', r.prompt), named_struct('role', 'assistant', 'text', r.completion))"),
    "prompt_response": (("prompt", "response"),
                        "array(named_struct('role', 'user', 'text', r.prompt), named_struct('role', 'assistant', 'text', r.response))"),
    "question": (("question", "answer"),
                 "array(named_struct('role', 'user', 'text', r.question), named_struct('role', 'assistant', 'text', r.answer))"),
    "instruction": (("instruction", "output"),
                    "array(named_struct('role', 'user', 'text', r.instruction), named_struct('role', 'assistant', 'text', r.output))"),
    "instruction_input": (("instruction", "input", "output"),
                          r"""array(named_struct('role', 'user', 'text', concat_ws('\n\n', r.instruction, nullif(r.input, ''))),
                           named_struct('role', 'assistant', 'text', r.output))"""),
    "system_prompt": (("system", "prompt", "response"),
                      """array(named_struct('role', 'system', 'text', r.system), named_struct('role', 'user', 'text', r.prompt),
                       named_struct('role', 'assistant', 'text', r.response))"""),
}


def paths(kind: DataType, at: str = "") -> list[str]:
    """The nested field paths of a type; an array adds [] and a map {} to the path."""
    if isinstance(kind, StructType):
        found = []
        for field in kind.fields:
            path = f"{at}.{field.name}" if at else field.name
            found += [path, *paths(field.dataType, path)]
        return found
    if isinstance(kind, ArrayType):
        return paths(kind.elementType, f"{at}[]")
    if isinstance(kind, MapType):
        return paths(kind.valueType, f"{at}{{}}")
    return []


def fingerprint(found: list[str] | tuple[str, ...]) -> str:
    """Hash of a set of field paths, whatever their order and letter case."""
    return hashlib.md5("\n".join(sorted({p.lower() for p in found})).encode()).hexdigest()


def layouts_by_fingerprint() -> dict[str, str]:
    return {fingerprint(found): name for name, (found, _) in LAYOUTS.items()}


#: the layouts of rows that were gathered here: their roles are kept as they are
OWN_LAYOUTS = ("turns", "numbered")


def _mapped(layout: str, record: str) -> Column:
    """The canonical turns of a record of this layout; other names of the roles are replaced in foreign layouts."""
    turns = F.expr(LAYOUTS[layout][1].replace("r.", f"{record}.")).cast(TURNS)
    if layout in OWN_LAYOUTS:
        return turns
    return F.transform(turns, lambda t: F.struct(canonical_role(t["role"]).alias("role"), t["text"].alias("text")))


def to_turns(records: DataFrame, record: str, into: str = "canonical") -> DataFrame:
    """``records`` with its struct column ``record`` replaced by canonical turns, by the type's fingerprint."""
    layout = layouts_by_fingerprint().get(fingerprint(paths(records.schema[record].dataType)))
    if layout is None:
        raise ValueError(f"no mapping for the fields {paths(records.schema[record].dataType)}")
    others = [F.col(c) for c in records.columns if c not in (record, into)]
    return records.select(*others, _mapped(layout, f"`{record}`").alias(into))


#: what the mappings read from JSON; absent fields are null
_JSON = (
    "struct<messages:array<struct<role:string,content:string>>,"
    "turns:array<struct<turn:bigint,role:string,text:string>>,"
    "conversations:array<struct<`from`:string,value:string>>,"
    "prompt:string,completion:string,response:string,question:string,answer:string,"
    "instruction:string,input:string,output:string,system:string>"
)


def _json_fingerprint(text: Column) -> Column:
    """The same fingerprint of one JSON object: its keys, and the keys of the objects in its arrays."""
    keys = F.json_object_keys(text)
    inner = F.transform(
        keys,
        lambda k: F.transform(
            F.coalesce(
                F.json_object_keys(F.call_function("get_json_object", text, F.concat(F.lit("$['"), k, F.lit("'][0]")))),
                F.array().cast("array<string>"),
            ),
            lambda j: F.concat(k, F.lit("[]."), j),
        ),
    )
    found = F.transform(F.concat(keys, F.flatten(inner)), F.lower)
    return F.md5(F.array_join(F.sort_array(F.array_distinct(found)), "\n"))


def json_to_turns(records: DataFrame, text: str, into: str = "canonical") -> DataFrame:
    """``records`` with ``layout`` and canonical turns for each JSON object in the column ``text``.

    Unknown layouts and unreadable text have a null layout and null turns; nothing is dropped.
    """
    others = [F.col(c) for c in records.columns if c not in ("layout", into)]
    df = records.select(*others, _json_fingerprint(F.col(text)).alias("_print"), F.from_json(text, _JSON).alias("_r"))
    layout = turns = F.lit(None)
    for name, (found, _) in LAYOUTS.items():
        here = F.col("_print") == fingerprint(found)
        layout = F.when(here, name).otherwise(layout)
        turns = F.when(here, _mapped(name, "_r")).otherwise(turns)
    return df.select(*others, layout.cast("string").alias("layout"), turns.cast(TURNS).alias(into))


def gather(rows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Rows of single turns (turn, role, text) as one record per conversation. Rows without an id are not brought
    together: each is a conversation."""
    one = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    known = rows.where(F.col(conversation).isNotNull()).groupBy(conversation)
    alone = rows.where(F.col(conversation).isNull()).select(conversation, F.struct(F.array(one).alias("turns")).alias("record"))
    return known.agg(F.struct(F.collect_list(one).alias("turns")).alias("record")).unionByName(alone)


def canonical_role(role: Column) -> Column:
    """Other names of the roles, as in ROLES, replaced."""
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(names[F.lower(role)], role)


# ------------------------------------------------------------------------------ template


def escape(text: Column) -> Column:
    """No control string is left: backslashes double, ``<|`` gets one between its characters."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """``<`` and a single backslash only come from ``escape``, so both steps can be undone in turn."""
    single = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(single, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As ``escape``; a line break, which ends the role, becomes ``<``, backslash, ``n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def format_turns(records: DataFrame, turns: str = "canonical") -> DataFrame:
    """``records`` with ``formatted`` and ``loss_mask``, the (start, length) of each assistant text, in code points."""
    others = [F.col(c) for c in records.columns if c not in ("formatted", "loss_mask", "_parts")]
    parts = F.transform(
        F.coalesce(F.col(turns), F.array().cast(TURNS)),
        lambda t: F.struct(
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == ASSISTANT).alias("loss"),
        ),
    )
    df = records.select(*others, parts.alias("_parts"))
    tail = F.lit(END + "\n")
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], tail)), "")

    def step(acc: Column, p: Column) -> Column:
        start = acc["pos"] + F.char_length(p["head"])
        size = F.char_length(p["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        none = F.array().cast("array<struct<start:int,length:int>>")
        return F.struct(
            (start + size + len(END) + 1).alias("pos"), F.concat(acc["out"], F.when(p["loss"], span).otherwise(none)).alias("out")
        )

    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))
    mask = F.aggregate("_parts", zero, step, lambda acc: acc["out"])
    return df.select(*others, text.alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: str | Column) -> Column:
    """The turns in a formatted text."""
    text = F.col(formatted) if isinstance(formatted, str) else formatted
    closed = F.split(text, r"<\|im_end\|>\n")
    pieces = F.slice(closed, 1, F.size(closed) - 1)

    def turn(piece: Column) -> Column:
        inside = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(inside, "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"), unescape(F.substr(inside, F.char_length(role) + 2)).alias("text")
        )

    return F.transform(pieces, turn)


def loss_texts(formatted: str = "formatted", mask: str = "loss_mask") -> Column:
    """The texts under the loss mask, as they were before escaping."""
    return F.transform(mask, lambda m: unescape(F.substr(F.col(formatted), m["start"] + 1, m["length"])))

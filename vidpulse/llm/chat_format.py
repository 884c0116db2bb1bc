"""Chat formatting: schema fingerprints choose declarative mappings.

A record is in one of many layouts.  Its fingerprint is the hash of its
nested field paths (of those that some layout declares, so extra fields do
not matter); the layout with that fingerprint maps the record to canonical
turns.  A record of no known layout keeps null turns.

Records that are structs (``format_structs``) have their paths in the schema,
so one fingerprint holds for the table and nothing is parsed.  Rows that are
turns become such records, one per conversation (``records_of_rows``).
Records that arrive as JSON (``format_records``) have one each.

The template writes ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line
feed per turn.  A control string inside a role or text gets one more
backslash after its first character, so none is left and reading back takes
one away.  The loss mask is a list of (start, end) code-point spans: exactly
the assistant texts.  Column expressions only; no Python on the executors.

Defined results: null text and role count as empty; turns sort by turn (null
first), then role, then text, repeated rows included; a null conv_id is one
conversation; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.llm import spans as S
from vidpulse.llm.common import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: What follows the first character of each control string (fixed values).
_REST = r"(?:s>|/s>|/?INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>)"

#: Canonical names of the roles of some layouts (fixed values).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Layouts by name: a list of turn objects (list, role field, text field, role
#: names), or fields that are turns (role, fields joined by a blank line).
LISTS = {
    "messages": ("messages", "role", "content", {}),
    "conversations": ("conversations", "from", "value", ROLES),
    "dialog": ("dialog", "speaker", "text", ROLES),
    # rows that are turns, gathered per conversation
    "rows": ("turns", "role", "text", {}),
    "rows_content": ("turns", "role", "content", {}),
    "rows_from": ("turns", "from", "value", ROLES),
    "rows_speaker": ("turns", "speaker", "text", ROLES),
}
FIELDS = {
    "prompt": [("user", ["prompt"]), ("assistant", ["completion"])],
    "prompt_response": [("user", ["prompt"]), ("assistant", ["response"])],
    "instruction": [("user", ["instruction"]), ("assistant", ["output"])],
    "instruction_input": [("user", ["instruction", "input"]), ("assistant", ["output"])],
    "system_prompt": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])],
    "question": [("user", ["question"]), ("assistant", ["answer"])],
}

#: Spark's JSON reader gives null for a string of over 20,000,000 characters unless told otherwise.
WHOLE = {name: str(2**31 - 1) for name in ("maxStringLen", "maxNumLen", "maxNestingDepth")}


def layout_paths() -> dict[str, list[str]]:
    """Nested field paths of each layout, sorted."""
    lists = {name: sorted([at, f"{at}[].{role}", f"{at}[].{text}"]) for name, (at, role, text, _) in LISTS.items()}
    return lists | {name: sorted(f for _, fields in turns for f in fields) for name, turns in FIELDS.items()}


def field_paths(record: Column) -> Column:
    """Sorted nested field paths of a JSON object: ``a``, ``a.b``, ``a[].b``."""
    none = F.array().cast("array<string>")

    def paths(values: Column) -> Column:
        def of_key(key: Column) -> Column:
            value = F.try_element_at(values, key)
            inner = F.transform(F.coalesce(F.json_object_keys(value), none), lambda k: F.concat(key, F.lit("."), k))
            items = F.from_json(F.when(value.startswith("["), value), "array<string>", WHOLE)
            each = F.flatten(F.transform(F.coalesce(items, none), lambda v: F.coalesce(F.json_object_keys(v), none)))
            return F.concat(F.array(key), inner, F.transform(each, lambda k: F.concat(key, F.lit("[]."), k)))

        return F.flatten(F.transform(F.coalesce(F.json_object_keys(record), none), of_key))

    return F.array_sort(F.array_distinct(let(F.from_json(record, "map<string,string>", WHOLE), paths)))


def _hash(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def fingerprint(record: Column) -> Column:
    """Hash of the record's declared field paths."""
    known = F.array(*[F.lit(p) for p in sorted({p for paths in layout_paths().values() for p in paths})])
    return _hash(F.array_intersect(field_paths(record), known))


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a struct type: ``a``, ``a.b``, ``a[].b``."""
    out = []
    for field in kind.fields:
        inner = field.dataType
        of, mark = (inner.elementType, "[].") if isinstance(inner, T.ArrayType) else (inner, ".")
        out.append(at + field.name)
        if isinstance(of, T.StructType):
            out += schema_paths(of, at + field.name + mark)
    return out


def schema_fingerprint(kind: T.StructType) -> str:
    """Hash of the declared field paths of a schema; equals ``fingerprint`` of its records."""
    known = {p for paths in layout_paths().values() for p in paths}
    return hashlib.sha256("\n".join(sorted(known.intersection(schema_paths(kind)))).encode()).hexdigest()


def layout_of(mark: str) -> str | None:
    """Name of the layout with this fingerprint."""
    marks = {hashlib.sha256("\n".join(paths).encode()).hexdigest(): name for name, paths in layout_paths().items()}
    return marks.get(mark)


def _mapped(own: Column, layout: str) -> Column:
    """array<struct<role, text>> of a struct of this layout."""
    def turn(role: Column, text: Column) -> Column:
        return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))

    if layout in FIELDS:
        return let(own, lambda o: F.array(*[turn(F.lit(role), F.concat_ws("\n\n", *[o[f] for f in names])) for role, names in FIELDS[layout]]))
    at, role, text, names = LISTS[layout]

    def role_of(own_role: Column) -> Column:
        named = functools.reduce(lambda c, kv: c.when(own_role == kv[0], kv[1]), names.items(), F.when(F.lit(False), ""))
        return F.coalesce(named.otherwise(own_role.cast("string")), F.lit(""))

    return F.transform(own[at], lambda x: turn(role_of(x[role]), x[text]))


def canonical_turns(record: Column, mark: Column) -> Column:
    """array<struct<role, text>> of a JSON record by the layout that ``mark``
    (its fingerprint) selects; null if there is none."""
    chosen = F.when(F.lit(False), F.lit(None))
    for name, paths in layout_paths().items():
        if name in LISTS:
            at, role, text, _ = LISTS[name]
            kind = f"`{at}` array<struct<`{role}`:string,`{text}`:string>>"
        else:
            kind = ", ".join(f"`{f}` string" for _, names in FIELDS[name] for f in names)
        chosen = chosen.when(mark == _hash(F.array(*map(F.lit, paths))), _mapped(F.from_json(record, kind, WHOLE), name))
    return chosen


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]\\*)(?={_REST})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]\\*)\\(?={_REST})", "$1")


def formatted(turns: Column) -> Column:
    """struct<formatted, loss: array<struct<start, end>>>."""
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))

    def build(p: Column) -> Column:
        text = F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n"))), "")
        sizes = F.transform(p, lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END) + 1)
        bodies = F.zip_with(p, S.running(sizes, lambda a, b: a + b), lambda x, upto: F.struct(
            x["loss"].alias("loss"), (upto - len(END) - 1 - F.length(x["body"])).alias("start"), (upto - len(END) - 1).alias("end")))
        loss = F.transform(F.filter(bodies, lambda b: b["loss"]), lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
        return F.struct(text.alias("formatted"), loss.alias("loss"))

    return let(parts, build)


def read_turns(text: Column) -> Column:
    """Turns of a formatted text, unescaped."""
    pieces = F.split(text, r"<\|im_end\|>\n", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(bodies, lambda b: let(F.split(F.substr(b, F.lit(len(START) + 1)), r"<\|im_sep\|>", 2), lambda x: F.struct(
        unescape(x[0]).alias("role"), unescape(x[1]).alias("text"))))


def read_loss(text: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between."""
    return let(S.parts_of(text), lambda parts: F.array_join(F.transform(loss, lambda s: unescape(S.piece(text, parts, s["start"], s["end"] - s["start"]))), ""))


def records_of_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, record): each conversation's rows as one struct whose list
    ``turns`` keeps the names that the rows use for role and text (the first
    declared pair that is there)."""
    pair = next(((r, t) for at, r, t, _ in LISTS.values() if at == "turns" and {r, t} <= set(rows.columns)), None)
    if pair is None:
        raise ValueError(f"no declared layout has its columns among {rows.columns}")
    content = F.struct(F.col(turn).alias("turn"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in pair])
    grouped = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(content)).alias("turns"))
    turns = F.transform("turns", lambda t: F.struct(*[t[c].alias(c) for c in pair]))
    return grouped.select("conv_id", F.struct(turns.alias("turns")).alias("record"))


def format_structs(records: DataFrame) -> DataFrame:
    """(conv_id, record: a struct) to the columns of ``format_records``: the
    fingerprint of the schema selects the mapping."""
    mark = schema_fingerprint(records.schema["record"].dataType)
    layout = layout_of(mark)
    turns = _mapped(F.col("record"), layout) if layout else F.lit(None).cast("array<struct<role:string,text:string>>")
    return records.select("conv_id", F.lit(mark).alias("fingerprint"), formatted(turns).alias("f")).select("conv_id", "fingerprint", "f.*")


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, record) to (conv_id, layout fingerprint, formatted, loss)."""
    marked = records.withColumn("fingerprint", fingerprint(F.col("record")))
    turns = marked.withColumn("turns", canonical_turns(F.col("record"), F.col("fingerprint")))
    return turns.select("conv_id", "fingerprint", formatted(F.col("turns")).alias("f")).select("conv_id", "fingerprint", "f.*")

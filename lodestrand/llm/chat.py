"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record's nested field paths, with scalar types left out, are its shape; the shape's hash is its fingerprint.  A fingerprint
selects a declarative mapping (``LAYOUTS``) that turns prompt, instruction and message layouts into canonical turns
(role, text).  A record with a fingerprint of no layout, say for an id or a name beside what is needed, goes by the most demanding layout
whose paths it has; its layout then ends in a plus sign.  Turns of a conversation are then put in order, escaped, marked and joined into one string, with a loss
mask over what the assistant says.

Every marker of the template, and every control string of common chat models, begins with ``<`` or ``[``.  In a text those
two and the escape sign itself are written as two-sign codes, so no control string can occur inside a text, and the codes
read back to exactly the text.

Defined results: a null text is empty; a null role is an empty role; turns sort by turn (null first), then role, then
text; repeated rows are turns of their own; a record without the paths of any layout gives no turn and a null
layout (``unread`` gives these); an empty table gives no row; other columns are ignored; rows with a null conv_id are one conversation.  A conversation is one string, so it ends at Spark's limit of 2 GB for a value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let

_TURN, _SAYS, _END = "<|turn|>", "<|says|>", "<|end|>"
_CODES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}
_TURNS = "array<struct<role:string,text:string>>"

#: name -> (shape, kind, fields).  one: the record is a turn (role, text); list: a path of turns (path, role, text);
#: pair: (system or None, prompt, context or None, answer).
LAYOUTS = {
    "turn": ("OBJECT<role, text>", "one", ("role", "text")),
    "message": ("OBJECT<content, role>", "one", ("role", "content")),
    "said": ("OBJECT<from, value>", "one", ("from", "value")),
    "speaker": ("OBJECT<speaker, text>", "one", ("speaker", "text")),
    "messages": ("OBJECT<messages: ARRAY<OBJECT<content, role>>>", "list", ("$.messages", "role", "content")),
    "turns": ("OBJECT<turns: ARRAY<OBJECT<role, text>>>", "list", ("$.turns", "role", "text")),
    "conversations": ("OBJECT<conversations: ARRAY<OBJECT<from, value>>>", "list", ("$.conversations", "from", "value")),
    "bare_messages": ("ARRAY<OBJECT<content, role>>", "list", ("$", "role", "content")),
    "prompt_completion": ("OBJECT<completion, prompt>", "pair", (None, "prompt", None, "completion")),
    "prompt_response": ("OBJECT<prompt, response>", "pair", (None, "prompt", None, "response")),
    "question_answer": ("OBJECT<answer, question>", "pair", (None, "question", None, "answer")),
    "instruction": ("OBJECT<instruction, output>", "pair", (None, "instruction", None, "output")),
    "instruction_input": ("OBJECT<input, instruction, output>", "pair", (None, "instruction", "input", "output")),
    "system_prompt": ("OBJECT<completion, prompt, system>", "pair", ("system", "prompt", None, "completion")),
    "system_instruction": ("OBJECT<instruction, output, system>", "pair", ("system", "instruction", None, "output")),
}


def shape(record: Column) -> Column:
    """Nested field paths of a VARIANT, scalar types left out."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z_]+(?:\([0-9, ]*\))?", "")


def fingerprint(record: Column) -> Column:
    return F.sha2(shape(record), 256)


def _keys(record: Column, path: str) -> Column:
    """Names of the fields of the object at a path; none if there is none."""
    return F.coalesce(F.map_keys(F.try_variant_get(record, path, "map<string,variant>")), F.expr("cast(array() as array<string>)"))


def layout_of(record: Column) -> Column:
    """The layout's name by the fingerprint, else, with a plus sign, by the paths that are there; null for none."""
    pairs = [x for name, (s, _, _) in LAYOUTS.items() for x in (F.sha2(F.lit(s), 256), F.lit(name))]

    def needs(kind: str, fields: tuple) -> tuple[str, list[str]]:
        return (f"{fields[0]}[0]", list(fields[1:])) if kind == "list" else ("$", [f for f in fields if f])

    asked = sorted(((name, *needs(kind, fields)) for name, (_, kind, fields) in LAYOUTS.items()), key=lambda x: (x[1] == "$", -len(x[2])))
    near = F.lit(None).cast("string")
    for name, path, names in reversed(asked):
        near = F.when(F.size(F.array_except(F.array(*map(F.lit, names)), _keys(record, path))) == 0, f"{name}+").otherwise(near)
    return F.coalesce(F.create_map(*pairs)[fingerprint(record)], near)


def _role(name: Column, key: str) -> Column:
    """A field that is called role has canonical values; those of other fields go by their aliases."""
    if key == "role":
        return F.coalesce(name, F.lit(""))
    return F.coalesce(F.create_map(*(F.lit(x) for kv in ALIASES.items() for x in kv))[F.lower(name)], name, F.lit(""))


def _mapped(record: Column, kind: str, fields: tuple) -> Column:
    def get(key: str) -> Column:
        return F.try_variant_get(record, f"$.{key}", "string")

    def turn(role: Column, text: Column) -> Column:
        return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if kind == "one":
        return F.array(turn(_role(get(fields[0]), fields[0]), get(fields[1])))
    if kind == "list":
        path, role, text = fields
        rows = F.try_variant_get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(rows, lambda t: turn(_role(t[role], role), t[text]))
    system, prompt, context, answer = fields
    asked = F.coalesce(get(prompt), F.lit(""))
    if context:
        asked = F.concat(asked, F.when(F.coalesce(get(context), F.lit("")) != "", F.concat(F.lit("\n\n"), get(context))).otherwise(""))
    turns = F.array(turn(F.lit("user"), asked), turn(F.lit("assistant"), get(answer)))
    if system:
        turns = F.when(F.coalesce(get(system), F.lit("")) != "", F.concat(F.array(turn(F.lit("system"), get(system))), turns)).otherwise(turns)
    return turns


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """records with layout and turns (array of role, text), chosen by each record's fingerprint."""
    chosen = F.rtrim(F.col("layout"), F.lit("+"))
    cases = reduce(lambda acc, kv: acc.when(chosen == kv[0], _mapped(F.col(record), kv[1][1], kv[1][2]).cast(_TURNS)), LAYOUTS.items(), F.when(F.lit(False), F.lit(None).cast(_TURNS)))
    return records.withColumn("layout", layout_of(F.col(record))).withColumn("turns", F.coalesce(cases, F.lit(None).cast(_TURNS)))


def unread(records: DataFrame) -> DataFrame:
    """What of ``canonical_turns`` no layout reads, which ``F.inline("turns")`` leaves out."""
    return records.filter("layout is null")


def escape(text: Column) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), _CODES, text)


def unescape(text: Column) -> Column:
    """Undo ``escape``: the sign itself last, as only its code may leave one behind."""
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[1]), F.lit(kv[0])), _CODES[::-1], text)


def format_turns(rows: DataFrame, key: str = "conv_id", order: tuple[str, ...] = ("turn",), loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """key, formatted, loss_spans (code points, ends exclusive, and the turn, from 1) of every conversation; rows: key, order, role, text.

    Offsets are running sums over a conversation's rows in order; the same partitioning serves the final join of the text.
    """
    says = F.concat(F.lit(_TURN), escape(F.col("role")), F.lit(_SAYS))
    said = escape(F.col("text"))
    by = [*(F.col(c) for c in order), F.col("role"), F.col("text")]
    seen = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    marked = rows.withColumn("_n", seen).withColumn("_head", says).withColumn("_said", said)
    marked = marked.select(key, "_n", F.concat("_head", "_said", F.lit(_END)).alias("_seg"), F.length("_head").alias("_at"), F.length("_said").alias("_len"), F.col("role").isin(*loss_roles).alias("_loss"))
    before = F.coalesce(F.sum(F.length("_seg")).over(Window.partitionBy(key).orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = marked.withColumn("_from", before + F.col("_at"))
    span = F.when(F.col("_loss"), F.struct(F.col("_from").alias("start"), (F.col("_from") + F.col("_len")).alias("end"), F.col("_n").alias("turn")))
    held = placed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_n", "_seg"))).alias("_s"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return held.select(key, F.array_join(F.transform("_s", lambda s: s["_seg"]), "").alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda s: s != "")
    head = F.lit(len(_TURN) + 1)
    return F.transform(parts, lambda s: F.struct(unescape(F.substring_index(s.substr(head, F.length(s)), _SAYS, 1)).alias("role"), unescape(F.substring_index(s, _SAYS, -1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    A span is looked up in its turn, so that a conversation takes time in proportion to its length; one that does not cover just what its turn
    says is cut out of the whole string instead.
    """

    def cut(parts: Column, s: Column) -> Column:
        said = F.substring_index(F.get(parts, s["turn"] - 1), _SAYS, -1)
        whole = formatted.substr(s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))
        return unescape(F.when(F.length(said) == s["end"] - s["start"], said).otherwise(whole))

    return F.array_join(let(F.split(formatted, r"<\|end\|>"), lambda parts: F.transform(spans, lambda s: cut(parts, s))), "")

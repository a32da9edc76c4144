"""Chat formatting with schema fingerprints.

The nested field paths of a table, hashed, select a declarative mapping that turns its layout (messages, prompt and
response, instruction and output, each with or without a system text, or a row per turn) into canonical turns. Where a table
unites several layouts, the paths of the fields that a row has are hashed and select the mapping of that row. Canonical turns are rendered with a template
in which no text can forge a control string, and read back from the rendered text alone. DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>\n"

TURNS = "array<struct<role: string, text: string>>"


def field_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """Nested field paths; [] stands for the elements of an array. Leaf types do not count, names count in lower case."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from field_paths(f.dataType, f"{at}.{f.name.lower()}" if at else f.name.lower())
    elif isinstance(kind, T.ArrayType):
        yield from field_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _text(column: str | Column) -> Column:
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def _turn(role: str | Column, text: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else _text(role)).alias("role"), text.alias("text"))


def _messages(column: str, role: str, text: str, names: dict[str, str]) -> Column:
    """Turns of an array of structs, its roles renamed to canonical ones; null arrays and elements give no turn."""

    def named(m: Column) -> Column:
        out = _text(m[role])
        for old, new in names.items():
            out = F.when(m[role] == old, F.lit(new)).otherwise(out)
        return F.struct(out.alias("role"), _text(m[text]).alias("text"))

    return F.coalesce(F.transform(F.filter(column, lambda m: m.isNotNull()), named), F.array().cast(TURNS))


def _asked(question: Column, answer: str) -> Column:
    return F.array(_turn("user", question), _turn("assistant", _text(answer)))


def _with_input(question: str, more: str) -> Column:
    return F.when(_text(more) == "", _text(question)).otherwise(F.concat(_text(question), F.lit("\n\n"), _text(more)))


def _mappings() -> dict[tuple[str, ...], Callable[[], Column]]:
    """Layouts, each the paths of the fields that carry the turns, and their mappings to canonical turns."""
    questions = {
        ("prompt",): lambda: _text("prompt"), ("instruction",): lambda: _text("instruction"),
        ("instruction", "input"): lambda: _with_input("instruction", "input"),
    }
    plain: dict[tuple[str, ...], Callable[[], Column]] = {
        ("messages[].role", "messages[].content"): lambda: _messages("messages", "role", "content", {}),
        ("conversations[].from", "conversations[].value"): lambda: _messages("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
        ("turns[].role", "turns[].text"): lambda: _messages("turns", "role", "text", {}),
    }
    for paths, question in questions.items():
        for answer in ("response", "completion", "output"):
            plain[*paths, answer] = lambda question=question, answer=answer: _asked(question(), answer)
    system = lambda make: F.concat(F.array(_turn("system", _text("system"))), make())
    return plain | {("system", *paths): lambda make=make: system(make) for paths, make in plain.items()}


MAPPINGS = _mappings()
_BY_FINGERPRINT = {fingerprint(paths): make for paths, make in MAPPINGS.items()}
_ROW_PER_TURN = ("turn", "role", "text")


def layouts(paths: set[str]) -> list[tuple[str, ...]]:
    """The layouts whose fields are all among these paths, without those that lie within another one of them."""
    whole = [p for p in [*MAPPINGS, _ROW_PER_TURN] if paths.issuperset(p)]
    return [p for p in whole if not any(set(p) < set(q) for q in whole)]


def _by_row(found: list[tuple[str, ...]]) -> Column:
    """The turns of a row of a table of several layouts: by the fingerprint of the paths of those whose own fields the row has."""
    parts = []
    for layout in found:
        shared = {path for other in found if other != layout for path in other}
        own = {path.partition("[]")[0] for path in layout if path not in shared}
        there = reduce(or_, (F.col(name).isNotNull() for name in sorted(own)))
        parts.append(F.when(there, F.array(*map(F.lit, layout))).otherwise(F.array().cast("array<string>")))
    given = F.array_sort(F.array_distinct(F.concat(*parts)))
    given = F.when(F.size(given) == 0, F.array(*map(F.lit, sorted(found[0])))).otherwise(given)
    code = F.sha2(F.array_join(given, "\n"), 256)
    clash = F.concat(F.lit("a row has the fields of several layouts: "), F.array_join(given, ", "))
    turns = F.raise_error(clash).cast(TURNS)
    for layout in found:
        turns = F.when(code == fingerprint(layout), _BY_FINGERPRINT[fingerprint(layout)]()).otherwise(turns)
    return turns


def canonical(rows: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """One row per conversation: the id, and turns, an array of (role, text).

    The fields that carry turns are those of the largest layouts that the table's paths hold; other columns are left aside.
    The fingerprint of these fields selects the mapping. A table may unite layouts, such as messages in some rows and
    prompt and response in others: then each row is mapped by the fields that it has, a row without any as the first
    layout, and one that has fields of two at once raises, as no mapping would keep them all.

    Nulls count as empty texts. Tables with a row per turn are gathered by id, a null id as one conversation; turns are in
    the order of turn (null first), then role, then text, so that repeated and tied rows have an order too. No layout, and a row per
    turn beside another layout, raise ValueError.
    """
    others = T.StructType([f for f in rows.schema.fields if f.name.lower() != id_column.lower()])
    paths = set(field_paths(others))
    found = layouts(paths)
    if not found or len(found) > 1 and _ROW_PER_TURN in found:
        raise ValueError(f"no mapping for the fields {sorted(paths)}: layouts {found}")
    if found == [_ROW_PER_TURN]:
        turns = F.sort_array(F.collect_list(F.struct(F.col("turn"), _text("role").alias("role"), _text("text").alias("text"))))
        return rows.groupBy(id_column).agg(turns.alias("turns")).select(id_column, F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"))
    turns = _BY_FINGERPRINT[fingerprint(found[0])]() if len(found) == 1 else _by_row(found)
    return rows.select(id_column, turns.alias("turns"))


def escaped(text: Column, role: bool = False) -> Column:
    """text without the beginning of any control string, and for a role without line ends; unescaped() reverses it."""
    out = F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("<%7C"))
    return F.replace(out, F.lit("\n"), F.lit("%0A")) if role else out


def unescaped(text: Column) -> Column:
    for code, plain in (("%0A", "\n"), ("%7C", "|"), ("%25", "%")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def formatted(conversations: DataFrame) -> DataFrame:
    """The columns of canonical(), and: formatted, the rendered conversation; loss_mask, the ranges (start, end) of its
    code points on which a model is trained, one for each assistant text that is not empty."""
    head = lambda t: F.concat(F.lit(START), escaped(t["role"], role=True), F.lit("\n"))
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn")))
    out = conversations.withColumn("parts", parts)
    out = out.withColumn("formatted", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
    none = F.array().cast("array<struct<start: int, end: int>>")

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(p["learn"] & (end > start), F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    mask = F.aggregate("parts", F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])
    return out.withColumn("loss_mask", mask).drop("parts")


def read_back(rendered: DataFrame) -> DataFrame:
    """Adds to formatted(): read, the turns found in the rendered text; loss_text, the unescaped text under the mask."""
    turn = lambda s: F.struct(
        unescaped(F.substring_index(s, "\n", 1)).alias("role"),
        unescaped(F.substr(s, F.instr(s, "\n") + 1, F.length(s) - F.instr(s, "\n") - len(END))).alias("text"),
    )
    # What stands before the first mark, nothing, is no turn; all that follows a mark is one, however many went in.
    parts = F.split("formatted", r"<\|im_start\|>")
    parts = F.slice(parts, F.lit(2), F.size(parts))
    masked = F.transform("loss_mask", lambda r: unescaped(F.substr("formatted", r["start"] + 1, r["end"] - r["start"])))
    return rendered.withColumn("read", F.transform(parts, turn)).withColumn("loss_text", F.array_join(masked, ""))


def digests(rendered: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Per conversation, from the rendered text: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(rendered).select(
        id_column, F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

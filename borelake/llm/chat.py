"""Chat formatting: many record layouts to one template, by DataFrame functions alone.

Each record is JSON. Which of the declared nested field paths it has is hashed to its schema
fingerprint; the fingerprint selects the mapping that turns the record into turns. Fields that no
mapping names do not matter. The turns of a chat, ordered by position, then role and text, are
written with one template:

    <|im_start|>role<|im_sep|>text<|im_end|>\\n

Inside roles and texts a backslash is doubled, and one is put into each control string of this and
other common templates (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), so no text can open or
close a turn; ``unescaped`` restores every text exactly.

Defined results: a null role or text is empty; a record of no known layout, or that is not JSON, has
layout null and is returned by ``unmapped``, never formatted in part; repeated rows are repeated turns; a null chat id is
one chat; other columns are ignored; an empty table gives no rows. A chat is one value, so one chat
must fit in a task; chats are otherwise independent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns.

    ``fields``: for a flat record, (role or path of the role, path of the text) per turn; several
    text paths are joined by an empty line. ``items``: for a list, its path and the two field names.
    ``optional`` paths may be absent.
    """

    name: str
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        if self.items:
            return {f"{self.items[0]}[0].{name}" for name in self.items[1:]}
        return {p for role, texts in self.fields for p in (role, *texts) if p.startswith("$")}


# Field and role names of widespread chat data layouts.
LAYOUTS = (
    Layout("turn", fields=(("$.role", ("$.text",)),)),
    Layout("prompt_response", fields=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("prompt_completion", fields=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("question_answer", fields=(("user", ("$.question",)), ("assistant", ("$.answer",)))),
    Layout(
        "instruction", optional=("$.input",),
        fields=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",))),
    ),
    Layout("messages", items=("$.messages", "role", "content")),
    Layout(
        "conversations", items=("$.conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
)


def _digest(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints_of(layout: Layout) -> list[str]:
    """The schema fingerprints that select a layout: with and without its optional fields."""
    needed = layout.paths() - set(layout.optional)
    some = chain.from_iterable(combinations(layout.optional, n) for n in range(len(layout.optional) + 1))
    return [_digest([*needed, *extra]) for extra in some]


def schema_fingerprint(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """SHA-256 of the declared paths that a variant holds, sorted, a line each."""
    known = sorted(set().union(*(layout.paths() for layout in layouts)))
    present = [F.when(F.try_variant_get(record, p, "variant").isNotNull(), F.lit(p)) for p in known]
    return F.sha2(F.array_join(F.array_compact(F.array(*present)), "\n"), 256)


def _turns(layout: Layout, record: Column) -> Column:
    def text(path: str) -> Column:
        return F.try_variant_get(record, path, "string")

    def turn(role: Column, words: Column) -> Column:
        role = reduce(lambda done, pair: F.when(role == pair[0], F.lit(pair[1])).otherwise(done), layout.roles, role)
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(words, F.lit("")).alias("text"))

    if layout.items:
        path, role, words = layout.items
        held = F.try_variant_get(record, path, f"array<struct<`{role}` string, `{words}` string>>")
        return F.transform(held, lambda m: turn(m[role], m[words]))
    return F.array(*[
        turn(
            text(role) if role.startswith("$") else F.lit(role),
            text(words[0]) if len(words) == 1 else F.array_join(F.array_compact(F.array(*map(text, words))), "\n\n"),
        )
        for role, words in layout.fields
    ])


def canonical(
    records: DataFrame, id_col: str = "chat_id", position_col: str = "position", payload_col: str = "payload",
    layouts: Sequence[Layout] = LAYOUTS,
) -> DataFrame:
    """``chat_id, position, layout, turns array<struct<role, text>>`` per record of JSON text."""
    parsed = records.select(
        F.col(id_col).alias("chat_id"), F.col(position_col).alias("position"),
        F.try_parse_json(payload_col).alias("record"),
    ).withColumn("schema", schema_fingerprint(F.col("record"), layouts))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role: string, text: string>>")
    for one in layouts:
        mine = F.col("schema").isin(fingerprints_of(one))
        layout = F.when(mine, F.lit(one.name)).otherwise(layout)
        turns = F.when(mine, _turns(one, F.col("record"))).otherwise(turns)
    return parsed.select("chat_id", "position", layout.alias("layout"), turns.alias("turns"))


def unmapped(canonical_records: DataFrame) -> DataFrame:
    """The records that no layout takes."""
    return canonical_records.where(F.col("layout").isNull() | F.col("turns").isNull())


def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"(<(?=\||/?s>)|\[(?=/?INST\]))", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(canonical_records: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``chat_id, formatted, segments array<struct<text, loss>>`` per chat.

    The segments, joined, are the formatted text; those with ``loss`` are the loss mask.
    """
    # Exploding null gives no row. A filter would be pushed below the mapping and map each record twice.
    mapped = F.when(F.col("layout").isNotNull(), F.col("turns"))
    turns = canonical_records.select("chat_id", "position", F.posexplode(mapped).alias("inner", "turn"))
    written = turns.select(
        "chat_id",
        F.struct("position", "inner", "turn.role", "turn.text").alias("place"),
        F.array(
            F.struct(F.concat(F.lit(START), escaped(F.col("turn.role")), F.lit(MIDDLE)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(F.col("turn.text")).alias("text"), (F.col("turn.role") == loss_role).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        ).alias("parts"),
    )
    chats = written.groupBy("chat_id").agg(F.sort_array(F.collect_list(F.struct("place", "parts"))).alias("turns"))
    chats = chats.select("chat_id", F.flatten(F.col("turns.parts")).alias("segments"))
    return chats.select("chat_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from a formatted chat."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(written: Column) -> Column:
        halves = F.split(written, r"<\|im_sep\|>")
        return F.struct(
            unescaped(F.substr(halves[0], F.lit(len(START) + 1))).alias("role"), unescaped(halves[1]).alias("text")
        )

    return F.transform(turns, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")

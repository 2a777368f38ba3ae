"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only.

Control strings inside texts are escaped so that the formatted string can always be parsed back: ``\\`` becomes ``\\b``,
``#`` becomes ``\\h`` and ``<`` becomes ``\\l``. An escaped text therefore holds neither ``#`` nor ``<``, and no marker of
the template (all of which hold one of them) can arise inside it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Markers, loss roles and the allowed turns. Markers must hold ``#`` or ``<``."""

    prefixes: dict[str, str] = field(
        default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
    )
    other_prefix: str = "### @"  # followed by the escaped role and other_sep
    other_sep: str = ": "
    end: str = " </turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: role before (start: "") -> roles that may follow
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )


DEFAULT = ChatTemplate()
#: In this order when escaping; undone in reverse, so that the backslash comes first and last.
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))


def escape(c: Column) -> Column:
    for plain, coded in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def _prefix(role: Column, t: ChatTemplate) -> Column:
    out = F.concat(F.lit(t.other_prefix), _escape_role(role), F.lit(t.other_sep))
    for name, prefix in t.prefixes.items():
        out = F.when(role == name, F.lit(prefix)).otherwise(out)
    return out


def format_conversations(conversations: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """One row per conversation from rows of (conv_id, turn, role, text).

    Returns conv_id, formatted (string), segments (array of text, loss: their texts joined are ``formatted``), valid
    (the role machine accepted every turn) and first_error (0-based place of the first refused turn, else null).

    Rows are ordered by turn, then role, then text (null first), so ties and repeated rows have one defined order and
    all stay. A null role or text counts as empty; rows with a null conv_id form one conversation. An empty table gives
    an empty result; other columns are ignored. Refused conversations are formatted too; drop them by ``valid``.
    """
    t = template
    turns = (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    segments = F.flatten(
        F.transform(
            "turns",
            lambda x: F.array(
                F.struct(_prefix(x.role, t).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(x.text).alias("text"), x.role.isin(*t.loss_roles).alias("loss")),
                F.struct(F.lit(t.end).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    steps = F.transform("turns", lambda x, i: F.struct(F.when(i > 0, F.element_at("turns", i).role).otherwise("").alias("before"), x.role.alias("role"), i.alias("i")))
    wrong = F.filter(steps, lambda s: ~_may_follow(s.before, s.role, t))
    return turns.select(
        "conv_id",
        segments.alias("segments"),
        F.try_element_at(F.transform(wrong, lambda s: s.i), F.lit(1)).alias("first_error"),
    ).select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"),
        "segments",
        F.col("first_error").isNull().alias("valid"),
        "first_error",
    )


def _may_follow(before: Column, role: Column, t: ChatTemplate) -> Column:
    ok = F.lit(False)
    for state, nexts in t.transitions.items():
        ok = ok | ((before == state) & role.isin(*nexts))
    return ok


def parse_formatted(formatted: Column, template: ChatTemplate = DEFAULT) -> Column:
    """array<struct<role, text>> read back from a formatted string: the inverse of :func:`format_conversations`."""
    t = template
    parts = F.split(formatted, re.escape(t.end))
    bodies = F.slice(parts, F.lit(1), F.size(parts) - 1)  # what follows the last end marker is empty

    def turn(body: Column) -> Column:
        rest = F.substr(body, F.lit(len(t.other_prefix) + 1))
        cut = F.locate(t.other_sep, rest)
        role = unescape(F.replace(F.substr(rest, F.lit(1), cut - 1), F.lit("\\c"), F.lit(":")))
        text = F.substr(rest, cut + len(t.other_sep))
        for name, prefix in t.prefixes.items():
            hit = F.startswith(body, F.lit(prefix))
            role = F.when(hit, F.lit(name)).otherwise(role)
            text = F.when(hit, F.substr(body, F.lit(len(prefix) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(bodies, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: unescape(s.text)), "")


def conversation_digest(formatted: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """Digest columns, all read back from the output of :func:`format_conversations`."""
    turns = parse_formatted(F.col("formatted"), template)
    lines = F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n")))
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss_text(F.col("segments"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )

"""Chat formatting by a finite-state machine over roles, in DataFrame functions only.

A template says how a turn of each role begins, how turns end, which roles may follow
which, and whose texts a model learns from. A turn becomes three segments: heading, text
and end, each with its loss flag. Control strings inside a text are replaced by escape
codes, so that the formatted text can be cut at its marks again and every text comes back
as it was.

A conversation is formatted in parts of ``BLOCK`` turn numbers. Each part carries what it
does to every state of the machine; those maps, not the turns, are put together to judge
the order of a whole conversation.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.frames import own_names

#: Turn numbers in one part of a conversation.
BLOCK = 256
ESCAPE, CODES = "\\", "abcdefghijklmnopqrstuvwxyz"
START, BAD = "start", "bad"


@dataclasses.dataclass(frozen=True)
class Template:
    """How turns are written, in which order they may come, and which texts are learned."""

    headings: Mapping[str, str]
    learned: frozenset[str]
    #: Roles that may come after each role, and at the start.
    follows: Mapping[str, tuple[str, ...]]
    #: Roles that a finished conversation may end with.
    last: frozenset[str]
    end: str = "</turn>\n"
    #: A role without a heading of its own is written between these; a missing one has the third.
    other: str = "### Other: "
    role_end: str = "</role> "
    missing: str = "### Unnamed: "

    def __post_init__(self) -> None:
        begins = [*self.headings.values(), self.other, self.missing]
        if any(a != b and a.startswith(b) for a in begins for b in begins) or len(set(begins)) < len(begins):
            raise ValueError("a heading must not begin with another one")
        for mark in (self.end, self.role_end):
            if any(mark.strip()[0] in text for text in (*begins, mark.strip()[1:])):
                raise ValueError("an end mark's first character must occur once in it and in no heading")
        controls = self.controls()
        if len(controls) > len(CODES) or any(ESCAPE in c or c[0] in CODES + "_" for c in controls):
            raise ValueError("control strings are up to 26, without the escape character, and begin with no letter")

    def controls(self) -> list[str]:
        """Strings that no escaped text holds."""
        marks = [self.end, self.role_end, *self.headings.values(), self.other, self.missing]
        return [m.strip() for m in marks]


PLAIN = Template(
    headings={"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "},
    learned=frozenset({"assistant"}),
    follows={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    last=frozenset({"assistant"}),
)


def escaped(text: Column, template: Template) -> Column:
    """``text`` without control strings: the escape character first, then each control string, becomes a code.

    Codes begin with a character that no control string holds and end with one that none
    begins with, so a replacement never makes a new control string.
    """
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "_"))
    for code, control in zip(CODES, template.controls(), strict=False):
        text = F.replace(text, F.lit(control), F.lit(ESCAPE + code))
    return text


def unescaped(text: Column, template: Template) -> Column:
    """The reverse of :func:`escaped`."""
    for code, control in zip(CODES, template.controls(), strict=False):
        text = F.replace(text, F.lit(ESCAPE + code), F.lit(control))
    return F.replace(text, F.lit(ESCAPE + "_"), F.lit(ESCAPE))


def _heading(role: Column, template: Template) -> Column:
    named = F.when(role.isNull(), template.missing)
    for name, heading in template.headings.items():
        named = named.when(role == name, heading)
    return named.otherwise(F.concat(F.lit(template.other), escaped(role, template), F.lit(template.role_end)))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _segments(turn: Column, template: Template) -> Column:
    """The three segments of a turn (role, text)."""
    role, no = turn["role"], F.lit(False)
    learned = F.coalesce(role.isin(*template.learned), no)
    text = escaped(F.coalesce(turn["text"], F.lit("")), template)
    return F.array(
        _segment(_heading(role, template), no), _segment(text, learned), _segment(F.lit(template.end), no)
    )


def _after(state: Column, role: Column, template: Template) -> Column:
    """The state after a turn: its role if that may follow, else the bad state, which is never left."""
    allowed = F.lit(False)
    for before, roles in template.follows.items():
        allowed = allowed | ((state == before) & role.isin(*roles))
    return F.when(F.coalesce(allowed, F.lit(False)), role).otherwise(F.lit(BAD))


def format_turns(turns: DataFrame, template: Template = PLAIN, block: int = BLOCK) -> DataFrame:
    """conv_id, part, n_turns, segments (array of text and loss) and moves of every conversation.

    ``turns`` has conv_id, turn, role and text. A conversation's parts hold ``block`` turn
    numbers each and follow one another by ``part``; a missing turn number comes first, in
    a part of its own. Equal numbers, repeated rows included, are turns each, in the order
    of role and text. A null text is empty; a null or unknown role is written with a
    heading of its own and makes the order bad. Rows with a null conv_id are one
    conversation. ``moves`` maps each state to the state after the part. Other columns are
    not carried; a table without rows gives none.
    """
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    parts = (
        turns.select("conv_id", "turn", "role", "text")
        .groupBy("conv_id", F.floor(F.col("turn") / block).alias("part"))
        .agg(said.alias("said"))
    )
    roles = F.transform("said", lambda t: t["role"])
    moves = F.create_map(
        *[
            x
            for state in (*template.follows, BAD)
            for x in (F.lit(state), F.aggregate(roles, F.lit(state), lambda s, r: _after(s, r, template)))
        ]
    )
    return parts.select(
        "conv_id",
        "part",
        F.size("said").cast("long").alias("n_turns"),
        F.flatten(F.transform("said", lambda t: _segments(t, template))).alias("segments"),
        moves.alias("moves"),
    )


def formatted(parts: DataFrame) -> DataFrame:
    """``parts`` plus ``formatted``, the text of a part as it is trained on; an own column of that name is replaced."""
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return own_names(parts, ["formatted"]).withColumn("formatted", text)


def _last_state(parts: Column) -> Column:
    """The state after an ordered array of parts (their entries in ``moves``), from the start."""
    return F.aggregate(parts, F.lit(START), lambda state, p: F.element_at(F.map_from_entries(p["moves"]), state))


def _order(state: Column, template: Template) -> list[Column]:
    return [(state != BAD).alias("in_order"), state.isin(*template.last).alias("finished")]


def order_of(parts: DataFrame, template: Template = PLAIN) -> DataFrame:
    """conv_id, in_order (each role may follow the one before it) and finished (a last role ends it too)."""
    own = F.struct("part", F.map_entries("moves").alias("moves"))
    states = parts.groupBy("conv_id").agg(_last_state(F.sort_array(F.collect_list(own))).alias("state"))
    return states.select("conv_id", *_order(F.col("state"), template))


def _read(turn: Column, template: Template) -> Column:
    """role and text of a turn as it stands between two end marks."""

    def after(text: Column, n: int | Column) -> Column:
        return F.substr(text, F.lit(1) + n)

    named = after(turn, F.lit(len(template.other)))
    at = F.instr(named, F.lit(template.role_end))
    role = F.when(turn.startswith(F.lit(template.missing)), F.lit(None).cast("string"))
    text = F.when(turn.startswith(F.lit(template.missing)), after(turn, F.lit(len(template.missing))))
    for name, heading in template.headings.items():
        begins = turn.startswith(F.lit(heading))
        role, text = role.when(begins, name), text.when(begins, after(turn, F.lit(len(heading))))
    role = role.otherwise(unescaped(F.substr(named, F.lit(1), at - 1), template))
    text = text.otherwise(after(named, at + (len(template.role_end) - 1)))
    return F.struct(role.alias("role"), unescaped(text, template).alias("text"))


def read_back(parts: DataFrame, template: Template = PLAIN) -> DataFrame:
    """conv_id, part, turns (array of role and text), learned and n_chars, from the output of :func:`format_turns` alone.

    Turns are cut from the formatted text at its marks; ``learned`` is what the segments
    with a loss say, without escape codes; ``n_chars`` counts the formatted text's code points.
    """
    cut = F.split("formatted", r"\Q" + template.end + r"\E")
    turns = F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), lambda t: _read(t, template))
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
    return formatted(parts).select(
        "conv_id",
        "part",
        turns.alias("turns"),
        F.array_join(learned, "").alias("learned"),
        F.length("formatted").alias("n_chars"),
        "moves",
    )


#: A conversation that says the template's own marks.
AWKWARD = "\\### Assistant: </turn> ok"


def awkward_turns(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant who both say control strings."""
    turns = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]))
    return spark.range(1).select(turns.alias("t")).select(
        F.lit(-7).cast("long").alias("conv_id"), "t.turn", "t.role", F.lit(AWKWARD).alias("text")
    )


def digest_rows(turns: DataFrame, template: Template = PLAIN) -> DataFrame:
    """One row per conversation: its turns, learned text and order, read back from the output.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, in_order and
    finished. A null role counts as an empty one in the digest; nulls, repeated rows and
    extra columns are taken as in :func:`format_turns`. A digest is over one string, so a
    conversation's parts meet here, and only here, in one row.
    """
    # Parts of a conversation stay together: one exchange serves both groupings.
    together = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    read = read_back(format_turns(together, template), template)
    said = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    own = F.struct("part", F.array_join(said, "").alias("said"), "learned", F.map_entries("moves").alias("moves"))
    whole = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(own)).alias("parts"),
        F.sum(F.size("turns")).alias("n_turns"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    whole = whole.select(
        "*",
        F.array_join("parts.said", "").alias("said"),
        F.array_join("parts.learned", "").alias("learned"),
        _last_state(F.col("parts")).alias("state"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
        *_order(F.col("state"), template),
    )


def checking_sql(template: Template = PLAIN) -> str:
    """SQL for the rows of :func:`digest_rows`, from the turns alone."""

    def lit(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def esc(column: str) -> str:
        text = f"replace({column}, {lit(ESCAPE)}, {lit(ESCAPE + '_')})"
        for code, control in zip(CODES, template.controls(), strict=False):
            text = f"replace({text}, {lit(control)}, {lit(ESCAPE + code)})"
        return text

    headings = " ".join(f"WHEN role = {lit(r)} THEN {len(h)}" for r, h in template.headings.items())
    other = len(template.other) + len(template.role_end)
    allowed = ", ".join(f"({lit(a)}, {lit(b)})" for a, roles in template.follows.items() for b in roles)
    last = ", ".join(map(lit, sorted(template.last)))
    learned = ", ".join(map(lit, sorted(template.learned)))
    return f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, {lit(AWKWARD)} FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
), placed AS (
  SELECT *, row_number() OVER w AS place, lag(coalesce(role, ''), 1, {lit(START)}) OVER w AS before,
    CASE WHEN role IS NULL THEN {len(template.missing)} {headings} ELSE {other} + length({esc('role')}) END AS heading
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role IN ({learned})), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role IN ({learned})), '')) AS loss_sha256,
  sum(heading + length({esc('text')}) + {len(template.end)})::BIGINT AS formatted_chars,
  bool_and(coalesce((before, role) IN ({allowed}), FALSE)) AS in_order,
  coalesce(bool_and(coalesce((before, role) IN ({allowed}), FALSE)) AND arg_max(coalesce(role, ''), place) IN ({last}), FALSE) AS finished
FROM placed GROUP BY conv_id
"""

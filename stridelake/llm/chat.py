"""Chat formatting: a declarative template, a state machine over roles, segments with loss flags.

All of it is DataFrame functions. A conversation becomes one row: its turns are brought together by one
shuffle, the roles are folded through the transition table, every turn becomes three segments (opening,
escaped text, closing) and the segments are joined to the formatted text. A conversation is thus
bounded by what a row may hold; conversations are spread over tasks by their id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.llm.shared import table


@dataclass(frozen=True)
class Role:
    """What stands before and after a turn's text, and whether the text is learnt."""

    opening: str
    closing: str
    learnt: bool = False


@dataclass(frozen=True)
class Template:
    """``other`` is used for roles that are not listed; ``{role}`` in its opening is the role, percent-encoded.

    ``transitions`` maps a state to the roles that may follow it; a role's name is the state after it. A conversation
    is valid if every role may follow and the last state is in ``final``. ``controls`` are the strings with
    a meaning: each starts with one of ``leads``, and no lead stands elsewhere in it.
    """

    roles: dict[str, Role]
    other: Role
    start: str = "<s>"
    transitions: dict[str, tuple[str, ...]] = field(default_factory=dict)
    final: tuple[str, ...] = ()
    leads: str = "<["
    controls: tuple[str, ...] = ()


INSTRUCT = Template(
    roles={
        "system": Role("[SYS] ", " [/SYS]"),
        "user": Role("[INST] ", " [/INST]"),
        "assistant": Role("[ANS] ", " </s>", learnt=True),
    },
    other=Role("[ROLE:{role}] ", " [/ROLE]"),
    transitions={
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    final=("assistant",),
    controls=("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[ROLE:", "[/ROLE]"),
)


def _tails(template: Template) -> str:
    return "|".join(re.escape(c[1:]) for c in template.controls)


def _leads(template: Template) -> str:
    return "[" + "".join(re.escape(c) for c in template.leads) + "]"


def escaped(text: Column, template: Template = INSTRUCT) -> Column:
    """A backslash goes between the lead and the rest of every control string, and one more where there are some."""
    return F.regexp_replace(text, rf"({_leads(template)})(?=\\*(?:{_tails(template)}))", r"$1\\")


def unescaped(text: Column, template: Template = INSTRUCT) -> Column:
    return F.regexp_replace(text, rf"({_leads(template)})\\(?=\\*(?:{_tails(template)}))", "$1")


def _by_role(template: Template, role: Column, value) -> Column:
    cases = None
    for name, r in template.roles.items():
        cases = F.when(role == name, value(r)) if cases is None else cases.when(role == name, value(r))
    return cases.otherwise(value(template.other)) if cases is not None else value(template.other)


def _opening(template: Template, role: Column) -> Column:
    before, _, after = template.other.opening.partition("{role}")
    other = F.concat(F.lit(before), F.url_encode(role), F.lit(after))
    cases = other
    for name, r in template.roles.items():
        cases = F.when(role == name, F.lit(r.opening)).otherwise(cases)
    return cases


def formatted(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Rows (conv_id, n_turns, segments, formatted, loss_spans, valid, bad_turn), one per conversation.

    ``segments`` are (text, loss, start), start counting code points from the beginning of ``formatted``, which
    joins their texts after the template's start. ``loss_spans`` are (start, length) of the segments that are
    learnt. ``valid`` is the verdict of the state machine, ``bad_turn`` the position (from 0) of the first turn that
    it does not allow, the number of turns if only the end is missing, null if valid. Every conversation
    is formatted, valid or not.

    Turns are ordered by turn, then role and text, null turns first; repeated rows are turns of their own. Null
    roles and texts count as empty, and rows with a null conv_id form one conversation, as in GROUP BY.
    An empty table gives no rows; other columns are not looked at.
    """
    empty = F.lit("")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    of_role = F.col("role")
    parts = rows.select(
        "conv_id", "role",
        F.row_number().over(in_order).alias("at"),
        F.array(
            F.struct(_opening(template, of_role).alias("text"), F.lit(False).alias("loss")),
            F.struct(
                escaped(F.col("text"), template).alias("text"),
                _by_role(template, of_role, lambda r: F.lit(r.learnt)).alias("loss"),
            ),
            F.struct(_by_role(template, of_role, lambda r: F.lit(r.closing)).alias("text"), F.lit(False).alias("loss")),
        ).alias("parts"),
    )
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.length(p["text"]))
    before = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("size", size).withColumn(
        "first", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.lit(len(template.start))
    )

    def start(i: int) -> Column:
        return F.col("first") + sum((F.length(F.col("parts")[j]["text"]) for j in range(i)), F.lit(0))

    segments = F.array(
        *(F.struct(F.col("parts")[i]["text"].alias("text"), F.col("parts")[i]["loss"].alias("loss"), start(i).alias("start")) for i in range(3))
    )
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "role", segments.alias("segments")))).alias("turns")
    )
    allowed = [(s, r) for s, after in template.transitions.items() for r in after]

    def follows(state: Column, role: Column) -> Column:
        pairs = F.lit(False)
        for s, r in allowed:
            pairs = pairs | ((state == s) & (role == r))
        return pairs

    machine = F.aggregate(
        "turns",
        F.struct(F.lit("").alias("state"), F.lit(True).alias("going"), F.lit(0).alias("at")),
        lambda done, t: F.when(
            done["going"] & follows(done["state"], t["role"]),
            F.struct(t["role"].alias("state"), F.lit(True).alias("going"), (done["at"] + 1).alias("at")),
        ).otherwise(F.struct(done["state"].alias("state"), F.lit(False).alias("going"), done["at"].alias("at"))),
    )
    placed = gathered.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), machine.alias("end"),
        F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"),
    )
    valid = F.col("end.going") & F.col("end.state").isin(*template.final)
    return placed.select(
        "conv_id", "n_turns", "segments",
        F.concat(F.lit(template.start), F.array_join(F.transform("segments", lambda s: s["text"]), "")).alias("formatted"),
        F.transform(
            F.filter("segments", lambda s: s["loss"]),
            lambda s: F.struct(s["start"].alias("start"), F.length(s["text"]).alias("length")),
        ).alias("loss_spans"),
        valid.alias("valid"),
        F.when(~valid, F.col("end.at")).alias("bad_turn"),
    )


def parsed(text: Column, template: Template = INSTRUCT) -> Column:
    """The turns, as structs (role, text), of a formatted text."""
    before, _, after = template.other.opening.partition("{role}")
    kinds = [*template.roles.values(), template.other]
    openings = "|".join([*(re.escape(r.opening) for r in template.roles.values()), f"{re.escape(before)}[^\\]]*{re.escape(after)}"])
    closings = "|".join(dict.fromkeys(re.escape(r.closing) for r in kinds))
    pattern = F.lit(rf"(?s)({openings})(.*?)(?:{closings})")
    heads, bodies = F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))

    def turn(head: Column, body: Column) -> Column:
        size = F.length(head) - len(before) - len(after)
        role = F.url_decode(F.substring(head, F.lit(len(before) + 1), size))
        for name, r in template.roles.items():
            role = F.when(head == r.opening, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescaped(body, template).alias("text"))

    return F.zip_with(heads, bodies, turn)


def learnt(text: Column, spans: Column, template: Template = INSTRUCT) -> Column:
    """The text under the loss mask, unescaped, in order."""
    pieces = F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]), template))
    return F.array_join(pieces, "")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def digests(turns: DataFrame) -> DataFrame:
    """Read back from ``formatted`` and ``loss_spans`` alone."""
    out = formatted(turns)
    read = out.select(
        "conv_id", parsed(F.col("formatted")).alias("turns"), learnt(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "formatted", "valid",
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op1_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, turn = (turns.schema[n].dataType.simpleString() for n in ("conv_id", "turn"))
    added = spark.range(2).select(
        F.lit(-1).cast(conv).alias("conv_id"),
        F.col("id").cast(turn).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return digests(turns.unionByName(added))


_MARKED = r"[<\[]\\*(?:s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ANS\]|ROLE:|/ROLE\])"

ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
marked AS (SELECT *, length(text) + len(regexp_extract_all(text, '{_MARKED}')) AS n FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(n + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 ELSE NULL END) AS BIGINT)
         AS formatted_chars,
       regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE '?' END, ''
         ORDER BY turn NULLS FIRST, role, text), 's?(ua)+') AS valid
FROM marked GROUP BY conv_id
"""

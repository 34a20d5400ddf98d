"""Chat formatting: a finite-state machine over roles, a declarative template, and text segments with loss flags.

Everything is a DataFrame expression. A conversation is one record: its turns meet in one row, because the formatted
text and its digests are defined over the whole conversation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How one role is written, and whether its text counts in the loss."""

    open: str
    close: str
    loss: bool = False


# The markers of the default template.
DEFAULT_ROLES = {
    "system": Turn("<<SYS>>", "<</SYS>>"),
    "user": Turn("[INST]", "[/INST]"),
    "assistant": Turn("<s>", "</s>", loss=True),
}
DEFAULT_MOVES = {
    ("start", "system"): "briefed",
    ("start", "user"): "asked",
    ("briefed", "user"): "asked",
    ("asked", "assistant"): "answered",
    ("answered", "user"): "asked",
}


@dataclass(frozen=True)
class Template:
    """Roles, the moves of the machine, its accepting states, and the three markers around a turn of another role.

    A marker must not contain a backslash and only its first character may be ``<`` or ``[`` (or doubled, ``<<``).
    """

    roles: dict[str, Turn] = field(default_factory=lambda: dict(DEFAULT_ROLES))
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: dict(DEFAULT_MOVES))
    accept: tuple[str, ...] = ("answered",)
    other: tuple[str, str, str] = ("[TURN]", "[TEXT]", "[/TURN]")

    def markers(self) -> list[str]:
        return [m for t in self.roles.values() for m in (t.open, t.close)] + list(self.other)


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Backslashes doubled, then one put behind the first character of every marker."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for marker in template.markers():
        text = F.replace(text, F.lit(marker), F.lit(marker[0] + "\\" + marker[1:]))
    return text


def unescape(text: Column) -> Column:
    """The inverse: of each backslash and a second one behind it, only the second stays."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def final_state(roles: Column, template: Template = DEFAULT) -> Column:
    """The state that the role order leads to; ``invalid`` once a move is not allowed."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    return F.aggregate(roles, F.lit("start"), lambda state, role: F.coalesce(F.element_at(moves, F.concat(state, F.lit("\n"), role)), F.lit("invalid")))


def _segments(turn: Column, template: Template) -> Column:
    role, text = turn["role"], escape(turn["text"], template)

    def three(opens: Column, closes: Column, loss: bool) -> Column:
        return F.array(*[F.struct(t.alias("text"), F.lit(flag).alias("loss")) for t, flag in ((opens, False), (text, loss), (closes, False))])

    first, middle, last = template.other
    out = three(F.concat(F.lit(first), escape(role, template), F.lit(middle)), F.lit(last), False)
    for name, how in template.roles.items():
        out = F.when(role == name, three(F.lit(how.open), F.lit(how.close), how.loss)).otherwise(out)
    return out


def format_chats(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, state, valid, segments (text, loss) and formatted.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one result. Null role
    or text is empty, a null conv_id is a conversation of its own; other columns are ignored. No turns, no rows.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    chats = chats.withColumn("segments", F.flatten(F.transform("turns", lambda t: _segments(t, template))))
    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.select("conv_id", state.alias("state"), state.isin(*template.accept).alias("valid"), "segments", formatted.alias("formatted"))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """Roles and texts, read back from formatted text alone."""

    def quoted(marker: str) -> str:
        return "".join(f"\\{c}" if not c.isalnum() else c for c in marker)

    first, middle, last = template.other
    pairs = [(t.open, t.close) for t in template.roles.values()] + [(first, last)]
    pattern = "(?s)" + "|".join(f"{quoted(a)}.*?{quoted(b)}" for a, b in pairs)

    def parse(piece: Column) -> Column:
        def inner(opens: str, closes: str) -> Column:
            return F.substring(piece, F.lit(len(opens) + 1), F.length(piece) - len(opens) - len(closes))

        body = inner(first, last)
        out = F.struct(
            unescape(F.substring_index(body, middle, 1)).alias("role"),
            unescape(F.substring(body, F.length(F.substring_index(body, middle, 1)) + len(middle) + 1, F.length(body))).alias("text"),
        )
        for name, how in template.roles.items():
            known = F.struct(F.lit(name).alias("role"), unescape(inner(how.open, how.close)).alias("text"))
            out = F.when(F.startswith(piece, F.lit(how.open)), known).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), parse)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What the formatted output says when it is read back."""
    read = chats.withColumn("read", read_turns(F.col("formatted"), template)).withColumn("under_loss", read_loss(F.col("segments")))
    joined = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("under_loss").cast("long").alias("loss_chars"),
        F.sha2("under_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def sql(template: Template = DEFAULT, extra: str = "") -> str:
    """The same digests over ``conversations`` in DuckDB SQL. ``extra`` is a SELECT of more turns."""
    q = lambda s: "'" + s.replace("'", "''") + "'"

    def escaped(column: str) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        for m in template.markers():
            out = f"replace({out}, {q(m)}, {q(m[0] + chr(92) + m[1:])})"
        return out

    first, middle, last = template.other
    around = " ".join(f"WHEN role = {q(r)} THEN {len(t.open) + len(t.close)}" for r, t in template.roles.items())
    loss = ", ".join(q(r) for r, t in template.roles.items() if t.loss)
    moves = " ".join(f"WHEN state = {q(a)} AND role = {q(r)} THEN {q(b)}" for (a, r), b in template.moves.items())
    return f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations {extra}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM turns),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 'start' AS state FROM (SELECT DISTINCT conv_id FROM turns)
  UNION ALL
  SELECT r.conv_id, r.i, CASE {moves} ELSE 'invalid' END FROM walk w JOIN ranked r
    ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1),
last AS (SELECT conv_id, arg_max(state, i) IN ({', '.join(q(s) for s in template.accept)}) AS valid FROM walk GROUP BY conv_id),
sums AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role IN ({loss})), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role IN ({loss})), '')) AS loss_sha256,
    CAST(sum(length({escaped('text')}) + CASE {around}
      ELSE {len(first + middle + last)} + length({escaped('role')}) END) AS BIGINT) AS formatted_chars
  FROM ranked GROUP BY conv_id)
SELECT sums.*, last.valid FROM sums JOIN last ON sums.conv_id IS NOT DISTINCT FROM last.conv_id"""

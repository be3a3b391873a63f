"""Chat formatting: a finite-state machine over roles and a declarative template.

Every turn yields three segments (opening, text, closing), each with a loss flag; only the
text of a role marked ``loss`` is trained on.  Control strings inside a text are escaped
reversibly: backslashes are doubled, then a backslash goes behind the first character of
every control string, so none occurs in an escaped text and the output can be read back.

Defined results: NULL text is the empty text, a NULL role the empty role.  Turns are ordered
by (turn, role, text), so ties have one order; a NULL turn comes first.  A conversation that
the state machine rejects is still formatted, with ``valid`` false and the first offending turn.
All steps are DataFrame functions; the turns of one conversation meet only where its output
is put together, after a map-side partial collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: role -> (opening, closing, loss).  Any other role is written with ``OTHER``.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>", False),
    "user": ("<s>[INST] ", " [/INST]", False),
    "assistant": ("<a> ", " </s>", True),
}
#: A role outside the template: opening, between role and text, closing.
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
CONTROL = ["<<SYS>>", "<</SYS>>", "<s>", "</s>", "<a>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[TEXT]"]
#: state -> roles that may follow; the state is the role of the turn before.
TRANSITIONS = {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}
FINAL = ["assistant"]


def _quote(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|/<>" else c for c in s)


def escape(text: Column, control: list[str] = CONTROL) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in control:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_segments(turns: DataFrame, template=TEMPLATE, other=OTHER, control=CONTROL,
                  transitions=TRANSITIONS, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv, turn, role, text, ``ok`` (the state machine allows it here) and
    ``segments`` array<struct<text, loss>>."""
    r, x = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), x.alias("text"))
    before = F.lag("role", 1, "").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    ok = F.lit(False)
    for state, nexts in transitions.items():
        ok = ok | ((F.col("_state") == state) & F.col("role").isin(nexts))
    return (rows.withColumn("_state", before).withColumn("ok", ok)
            .withColumn("segments", _segments(template, other, control)).drop("_state"))


def _segments(template, other, control) -> Column:
    def part(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    body = escape(F.col("text"), control)
    out = F.array(part(F.concat(F.lit(other[0]), escape(F.col("role"), control), F.lit(other[1])), False),
                  part(body, False), part(F.lit(other[2]), False))
    for name, (opening, closing, loss) in template.items():
        out = F.when(F.col("role") == name, F.array(
            part(F.lit(opening), False), part(body, loss), part(F.lit(closing), False))).otherwise(out)
    return out


def format_conversations(turns: DataFrame, template=TEMPLATE, other=OTHER, control=CONTROL,
                         transitions=TRANSITIONS, final=FINAL, **names) -> DataFrame:
    """One row per conversation: conv_id, valid, bad_turn, segments, formatted."""
    rows = turn_segments(turns, template, other, control, transitions, **names)
    one = F.struct("turn", "role", "text", "ok", "segments")
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    return whole.select(
        "conv_id",
        (F.forall("t", lambda t: t["ok"]) & F.element_at("t", -1)["role"].isin(final)).alias("valid"),
        F.try_element_at(F.filter("t", lambda t: ~t["ok"])["turn"], F.lit(1)).alias("bad_turn"),
        F.flatten(F.col("t.segments")).alias("segments")).withColumn(
        "formatted", F.array_join(F.col("segments.text"), ""))


def read_back(formatted: Column, template=TEMPLATE, other=OTHER) -> Column:
    """Turns array<struct<role, text>> parsed from the formatted text alone."""
    def grab(opening: str, closing: str, mid: str | None = None) -> str:
        if mid is None:
            return f"{_quote(opening)}.*?{_quote(closing)}"
        return f"{_quote(opening)}.*?{_quote(mid)}.*?{_quote(closing)}"
    pattern = "(?s)" + "|".join([grab(o, c) for o, c, _ in template.values()] + [grab(other[0], other[2], other[1])])

    def turn(m: Column) -> Column:
        inner = F.substring(m, F.lit(len(other[0]) + 1), F.length(m) - len(other[0]) - len(other[2]))
        at = F.instr(inner, other[1])
        out = F.struct(unescape(F.substring(inner, F.lit(1), at - 1)).alias("role"),
                       unescape(F.substring(inner, at + len(other[1]), F.length(inner))).alias("text"))
        for name, (opening, closing, _) in template.items():
            body = F.substring(m, F.lit(len(opening) + 1), F.length(m) - len(opening) - len(closing))
            out = F.when(F.startswith(m, F.lit(opening)), F.struct(
                F.lit(name).alias("role"), unescape(body).alias("text"))).otherwise(out)
        return out
    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), turn)

"""Personal data: regular expressions propose spans, checksums confirm, context adjusts the score.

Kinds: email, ip, card (Luhn), phone are the base and follow one fixed rule each; iban (mod-97),
idnum (a grouped nine-digit number) and secret (a key of ``SECRET_CHARS`` characters with letters, digits and enough
different characters) are added, the last two only with a context word near them.  A
base match that its validator accepts is always a span; its score says how sure the method is.

All steps are DataFrame functions.  Positions come from ``split`` and ``regexp_extract_all``
on the same pattern: pieces and matches alternate, so running lengths give the offsets (code
points, end exclusive).  Patterns are possessive where that matches the same strings and start
only where a run starts, so long runs cost linear time and no deep recursion.

Defined results: NULL text is the empty text; empty text has no spans; texts are read whole; rows that repeat an id or text
are read each by itself; a column of the input that is called like the added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in their listed order.
KINDS = ["email", "ip", "card", "phone", "iban", "idnum", "secret"]
BASE = KINDS[:4]
#: Least and greatest length of a secret, and how many different characters it has at least.
SECRET_CHARS, SECRET_DISTINCT = (16, 128), 8
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "idnum": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": rf"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{{{SECRET_CHARS[0]},{SECRET_CHARS[1]}}}+(?![A-Za-z0-9_/+-])",
}
#: A text without such a string has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "idnum": "-"}
#: Likewise, as a pattern; else two digits with at most a space or hyphen between them.
MAY = {"secret": "(?i)token|secret|passw|key|bearer"}
#: Words that raise a score when they stand within ``CONTEXT_CHARS`` before a span.
CONTEXT = {
    "email": "(?i)e-?mail|contact|write",
    "ip": "(?i)\\bip\\b|address|host|server",
    "card": "(?i)card|visa|credit|payment|carte|tarjeta|karte",
    "phone": "(?i)phone|call|tel|mobile|fax",
    "iban": "(?i)iban|account|bank|konto|compte|cuenta",
    "idnum": "(?i)ssn|social|security|\\bid\\b|number",
    "secret": "(?i)(?:token|secret|passw(?:or)?d|(?:api|access|private)[_-]?key|bearer)[\\x20\"']*[:=\\x20][\\x20\"']*$",
}
CONTEXT_CHARS = 40
#: Score of a confirmed match without context words, and what a context word adds.
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "idnum": 0.3, "secret": 0.3}
BOOST = 0.2
#: Added kinds count as spans from this score on.
THRESHOLD = 0.5


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    n = F.length(digits)

    def step(acc, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return acc + F.when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def mod97(iban: Column) -> Column:
    """ISO 7064 mod 97-10 of an account number without spaces."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")) <= 3
        small = lambda p: F.coalesce(F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 3).cast("int") <= 255,
                                     F.lit(False))
        return F.forall(F.split(m, r"\."), lambda p: part(p) & small(p))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        s = F.replace(m, F.lit(" "), F.lit(""))
        return F.when(F.length(s).between(15, 34), mod97(s)).otherwise(False)
    if kind == "secret":
        different = F.size(F.array_distinct(F.split(m, "")))
        return F.rlike(m, F.lit("[0-9]")) & F.rlike(m, F.lit("[A-Za-z]")) & (different >= SECRET_DISTINCT)
    return F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    """array<struct<start, end, text>> of all matches of the kind's pattern, in order."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.transform(F.split(text, PATTERNS[kind], -1), lambda p: F.length(p))
    kind_of = "array<struct<start:int,end:int,text:string>>"

    def step(acc, x):
        start = acc["at"] + x["piece"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("text")))).alias("out"))
    located = F.aggregate(F.arrays_zip(F.slice(pieces, F.lit(1), F.size(found)).alias("piece"), found.alias("m")),
                          F.struct(F.lit(0).alias("at"), F.array().cast(kind_of).alias("out")), step)["out"]
    empty = F.array().cast(kind_of)
    may = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.rlike(text, F.lit(MAY.get(kind, "[0-9][\\x20-]?[0-9]")))
    return F.when(may, F.when(F.size(found) > 0, located).otherwise(empty)).otherwise(empty)


def _scored(text: Column, kind: str) -> Column:
    def one(s):
        near = F.substring(text, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)) + 1,
                           F.least(s["start"], F.lit(CONTEXT_CHARS)))
        score = F.lit(SCORE[kind]) + F.when(F.rlike(near, F.lit(CONTEXT[kind])), F.lit(BOOST)).otherwise(F.lit(0.0))
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"),
                        F.lit(kind).alias("kind"), F.round(score, 2).alias("score"))
    spans = F.transform(F.filter(_matches(text, kind), lambda s: _valid(kind, s["text"])), one)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def find_pii(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with a column ``out``: array<struct<start, rank, end, kind, score>> by start, then kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(out, F.array_sort(F.concat(*[_scored(body, k) for k in KINDS])))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

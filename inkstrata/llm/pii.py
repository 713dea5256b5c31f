"""Personal data: patterns propose spans, checksums confirm them, context adjusts a score.

Built from DataFrame expressions only. The patterns are the plain ones with
possessive repeats and a start condition, which changes no match but keeps every
scan linear: what fails at the start of a run of characters fails inside it too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.llm import spans as sp

CONTEXT_CHARS = 40
CONTEXT_WEIGHT = 0.35
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rule:
    """``pattern`` for Spark and ``plain`` for SQL find the same spans.

    ``prior`` is the score of a confirmed span, raised by ``CONTEXT_WEIGHT`` where
    ``context`` is found nearby. A rule of the base keeps every confirmed span; others
    need ``THRESHOLD``.
    """

    kind: str
    pattern: str
    plain: str
    confirm: Callable[[Column, Column], Column]
    sql_confirm: str
    context: str
    prior: float
    base: bool = False


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.length(digits)

    def term(at: Column) -> Column:
        digit = F.substring(digits, at, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when((size - at) % 2 == 1, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda a, at: a + term(at))
    return (size > 0) & (total % 10 == 0)


def mod97(value: Column) -> Column:
    """Whether an account number has remainder 1 modulo 97, its first four characters put last; blanks do not count."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, F.lit(1), F.lit(4)))

    def step(rest: Column, at: Column) -> Column:
        code = F.ascii(F.substring(moved, at, F.lit(1)))
        letter = (rest * 100 + code - 55) % 97
        return F.when(code >= 65, letter).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _alone(text: Column, s: Column) -> Column:
    """No letter or digit right before or after the span."""
    before = F.substring(text, s["start"], F.when(s["start"] > 0, 1).otherwise(0))
    after = F.substring(text, s["end"] + 1, F.lit(1))
    return ~before.rlike("[A-Za-z0-9]") & ~after.rlike("[A-Za-z0-9]")


def _small_parts(text: Column, s: Column) -> Column:
    # parts of more than three digits are too large unless they start with zeros
    short = F.regexp_replace(s["value"], r"(^|\.)0+([0-9])", "$1$2")
    return F.forall(F.split(short, r"\."), lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


def _card(text: Column, s: Column) -> Column:
    digits = _digits(s["value"])
    return F.length(digits).between(14, 19) & luhn(digits)


def _phone(text: Column, s: Column) -> Column:
    return F.length(_digits(s["value"])).between(10, 15)


_SQL_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_SQL_LUHN = (
    f"list_sum([CASE WHEN (length({_SQL_DIGITS}) - i) % 2 = 1 THEN CASE WHEN CAST(substr({_SQL_DIGITS}, i, 1) AS INT) > 4"
    f" THEN 2 * CAST(substr({_SQL_DIGITS}, i, 1) AS INT) - 9 ELSE 2 * CAST(substr({_SQL_DIGITS}, i, 1) AS INT) END"
    f" ELSE CAST(substr({_SQL_DIGITS}, i, 1) AS INT) END FOR i IN range(1, length({_SQL_DIGITS}) + 1)]) % 10 = 0"
)
_SQL_ALONE = (
    "NOT regexp_matches(CASE WHEN s > 0 THEN substr(text, CAST(s AS BIGINT), 1) ELSE '' END, '[A-Za-z0-9]')"
    " AND NOT regexp_matches(substr(text, CAST(e AS BIGINT) + 1, 1), '[A-Za-z0-9]')"
)
_SQL_MOD97 = (
    "list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(substr(replace(value, ' ', ''), 5) || substr(replace(value, ' ', ''), 1, 4), ''),"
    " lambda c: CAST(CASE WHEN ascii(c) >= 65 THEN ascii(c) - 55 ELSE ascii(c) - 48 END AS BIGINT))),"
    " lambda a, x: (CASE WHEN x > 9 THEN a * 100 ELSE a * 10 END + x) % 97) = 1"
)

# The kinds that every report counts, in this order, then the added ones.
RULES = (
    Rule(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        lambda text, s: F.lit(True),
        "true",
        "mail|contact|write to",
        0.8,
        True,
    ),
    Rule(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        _small_parts,
        r"len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(p AS BIGINT), 256) > 255)) = 0",
        "address|host|server|ip",
        0.6,
        True,
    ),
    Rule(
        "card",
        r"[0-9]++(?:[\x20-][0-9]++)*+",
        r"[0-9]([\x20-]?[0-9])+",
        _card,
        f"length({_SQL_DIGITS}) BETWEEN 14 AND 19 AND {_SQL_LUHN}",
        "card|visa|credit|pay",
        0.7,
        True,
    ),
    Rule(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        _phone,
        f"length({_SQL_DIGITS}) BETWEEN 10 AND 15",
        "call|phone|tel|fax|mobile",
        0.6,
        True,
    ),
    Rule(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+)",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
        lambda text, s: _alone(text, s) & mod97(s["value"]),
        f"{_SQL_ALONE} AND {_SQL_MOD97}",
        "iban|account|bank|konto|cuenta|compte",
        0.7,
    ),
    Rule(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        _alone,
        _SQL_ALONE,
        "ssn|social security|security number",
        0.3,
    ),
)
BASE = [rule.kind for rule in RULES if rule.base]


def _scored(text: Column, rule: Rule) -> Column:
    """Confirmed spans of a rule with their scores."""

    def score(s: Column) -> Column:
        start = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        near = F.lower(F.substring(text, start + 1, s["end"] - start + CONTEXT_CHARS))
        return F.lit(rule.prior) + F.when(near.rlike(rule.context), F.lit(CONTEXT_WEIGHT)).otherwise(0.0)

    confirmed = F.filter(sp.find_all(text, rule.pattern), lambda s: rule.confirm(text, s))
    made = F.transform(
        confirmed,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(RULES.index(rule)).alias("rank"),
            s["end"].alias("end"),
            F.lit(rule.kind).alias("kind"),
            s["value"].alias("value"),
            F.least(score(s), F.lit(1.0)).alias("score"),
        ),
    )
    return made if rule.base else F.filter(made, lambda s: s["score"] >= THRESHOLD)


def find_personal_data(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with the column ``out``: spans by start, then kind.

    ``array<struct<start, rank, end, kind, value, score>>``; offsets are code points.
    A null or empty text has none. A column of the name ``out`` is replaced.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    every = F.concat(*[_scored(whole, rule) for rule in RULES])
    return docs.withColumn(out, F.array_sort(every))


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of each document."""
    found = find_personal_data(docs.select("doc_id", "text")).select("doc_id", "pii")
    counts = [sp.count_kind(F.col("pii"), kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("pii", lambda s: s["kind"].isin(BASE))
    return found.select("doc_id", *counts, F.sha2(sp.joined(base), 256).alias("base_sha256"), sp.joined(F.col("pii")).alias("spans"))


def sql() -> str:
    def keep(rule: Rule) -> str:
        if rule.base:
            return rule.sql_confirm
        near = f"lower(substr(text, greatest(CAST(s AS BIGINT) - {CONTEXT_CHARS}, 0) + 1, CAST(e AS BIGINT) - greatest(CAST(s AS BIGINT) - {CONTEXT_CHARS}, 0) + {CONTEXT_CHARS}))"
        return f"{rule.sql_confirm} AND {rule.prior} + CASE WHEN regexp_matches({near}, '{rule.context}') THEN {CONTEXT_WEIGHT} ELSE 0 END >= {THRESHOLD}"

    finds = [sp.sql_find("t", rule.kind, rank, rule.plain, keep(rule)) for rank, rule in enumerate(RULES)]
    return sp.sql_report("documents", finds, BASE)

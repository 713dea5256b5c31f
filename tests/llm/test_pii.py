import hashlib
import re

import pytest

from inkstrata.llm import pii
from tests.llm.helpers import documents, odd

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def expected(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


TEXTS = [
    "mail a.b%c+d@ex-ample.co.uk, x@y.z%q@r.s or bad@host and p@q..r",
    "😀 é write to joe@mail.org: 1.2.3.4 and 999.1.1.1 and 1.2.3.4.5.6.7.8 and 007.000.01.255",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111  1111 1111 1111, 12345678901234567890123",
    "call +1 (555) 123-4567 or +49.30.1234567 or +1 2 or +123456789012345678",
    "1 2 3 4 5 6 7 8 9 " * 2000 + "+12 345 678 901",
    "a" * 50_000 + "@" + "b.c" * 10,
    "4" * 30_000 + " 0.0.0.0",
    "1.1.1.1 " * 700,
]


def rows(spark, texts):
    return {r.doc_id: r for r in pii.report(documents(spark, texts)).collect()}


def test_base_spans_are_those_of_the_patterns(spark):
    texts = list(enumerate(TEXTS, 10))
    got = rows(spark, texts)
    for doc, text in texts:
        want = expected(text)
        assert [s for s in got[doc].spans.split(",") if s and s.split(":")[0] in BASE] == want
        assert got[doc].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in BASE:
            assert got[doc][f"n_{kind}"] == sum(s.startswith(kind + ":") for s in want)


@pytest.mark.parametrize(
    "text, found",
    [
        ("iban DE89370400440532013000.", True),
        ("iban DE89370400440532013001.", False),
        ("xDE89370400440532013000", False),
        ("GB82WEST12345698765432", True),
        ("iban DE89 3704 0044 0532 0130 00, please", True),
        ("iban DE89 3704 0044 0532 0130 01", False),
        ("GB82 WEST 1234 5698 7654 32", True),
        ("NO93 8601 1117 947 is the account", True),
        ("iban DE89 37040044 0532 0130 00", False),
    ],
)
def test_account_numbers_need_their_checksum(spark, text, found):
    assert ("iban" in rows(spark, [(1, text)])[1].spans) == found


def test_context_decides_on_weak_kinds(spark):
    got = rows(spark, [(1, "social security 078-05-1120"), (2, "part 078-05-1120"), (3, "social security 1078-05-1120")])
    assert [("ssn" in got[i].spans) for i in (1, 2, 3)] == [True, False, False]
    scored = pii.find_personal_data(documents(spark, [(1, "my card 4111111111111111")])).first()
    assert scored.pii[0].score > 0.9 and scored.shard == "own"


def test_odd_rows_and_empty_table(spark):
    got = pii.report(documents(spark, odd())).collect()
    assert len(got) == len(odd()) and all(r.spans == "" for r in got)
    assert pii.report(documents(spark, [])).count() == 0

"""Personal data: base spans against `re`, bootstrapping on a fixture."""

import hashlib
import random
import re

from stride.llm import private_data as P

KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(FORMS[k], text or "") if valid(k, m[0])]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def random_text(rng):
    bits = ["a.b", "@", "x-y.com", ".", "1", "22", "255", "256", "007", "4111 1111 1111 1111", "4111111111111111", "-", " ", "+1 (555) 010-9999", "+",
            "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "é", "😀", "\n", "_", "%", "000000255.1.1.1", "79927398713", "4539 1488 0343 6467", "user@host", "x@y..z.w"]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(0, 45)))


def test_base_spans_equal_re(make):
    rng = random.Random(7)
    texts = [None, "", "9" * 60_000, "1 " * 20_000, "a" * 50_000 + "@", "a." * 20_000, "x@" + "a." * 20_000 + "b"] + [random_text(rng) for _ in range(200)]
    rows = list(enumerate(texts)) + [(None, "mail a@b.co"), (None, "mail a@b.co"), (8, texts[8])]
    docs = make([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, email string, tokens string")
    got = P.digest(P.find(docs)).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, [sum(s[0] == k for s in base(t)) for k in KINDS], hashlib.sha256(joined(base(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in got) == want


def test_patterns_discover_unseen_identifiers(make):
    rows = [(i, f"Some text. Please call office +1 (555) 010-{1000 + i} for help, order 1234{i}.") for i in range(8)]
    rows += [(20, "You may call office 555-010-7777 today."), (21, "We bought 555-010-9999 pieces."), (22, "Please call office tomorrow.")]
    got = {r.doc_id: r.spans for r in P.digest(P.find(make(rows))).collect()}
    text = dict(rows)[20]
    begin = text.index("555")
    assert got[20] == f"ctx_phone:{begin}:{begin + len('555-010-7777')}"
    assert got[21] == got[22] == "" and all(got[i].startswith("phone:") and "ctx" not in got[i] for i in range(8))


def test_rounds_spread_through_the_graph(make):
    """A second pattern is learned from instances that the first one discovered."""
    rows = [(100 + i, f"please call office +1 (555) 010-{1000 + i} now") for i in range(12)]
    found = [f"555-020-{2000 + i}" for i in range(4)]
    rows += [(10 + i, f"please call office {n} now") for i, n in enumerate(found)]
    rows += [(20 + i, f"my direct line {n} is open") for i, n in enumerate(found)]
    rows += [(30, "my direct line 555-030-3000 is open")]
    got = {r.doc_id: r.spans for r in P.digest(P.find(make(rows))).collect()}
    assert all(got[10 + i].startswith("ctx_phone") for i in range(4))
    assert got[30].startswith("ctx_phone")
    one_round = {r.doc_id: r.spans for r in P.digest(P.find(make(rows), P.Bootstrap(iterations=1))).collect()}
    assert one_round[30] == "" and one_round[10].startswith("ctx_phone")


def test_rare_or_mixed_patterns_find_nothing(make):
    rows = [(1, "call office +1 (555) 010-1000"), (2, "call office 555-010-7777")]
    rows += [(10 + i, f"number was +1 (555) 010-{2000 + i}") for i in range(3)] + [(20 + i, f"number was {70000 + i}") for i in range(9)]
    assert not any("ctx" in r.spans for r in P.digest(P.find(make(rows))).collect())


def test_numbers_with_blanks_addresses_and_earlier_numbers(make):
    seeds = [(i, f"Please call office +1 (555) 010-{1000 + i} or write to anna{i}@example.com, phone 2: +1 (555) 030-{1000 + i}.") for i in range(12)]
    said = {
        20: ("You may call office (555) 010-7777 today.", "ctx_phone", "(555) 010-7777"),
        21: ("You may call office 555 010 - 7777.", "ctx_phone", "555 010 - 7777"),
        22: ("Or write to jane@corp, they said.", "ctx_email", "jane@corp"),
        23: ("Room 7, phone 2: 555-030-7777.", "ctx_phone", "555-030-7777"),
        24: ("You may call office jane@corp now.", None, None),
        25: ("You may call office 12 of 30 days.", None, None),
    }
    got = {r.doc_id: r.spans for r in P.digest(P.find(make(seeds + [(i, t) for i, (t, _, _) in said.items()]))).collect()}
    for i, (text, kind, part) in said.items():
        assert got[i] == (f"{kind}:{text.index(part)}:{text.index(part) + len(part)}" if kind else ""), i
    assert all("ctx" not in got[i] and got[i].count("phone") == 2 for i in range(12))


def test_many_number_chunks_stay_apart(make):
    """Chunks holding a base entity, or more digits than an identifier has, are tokens of their own."""
    docs = make([(1, "a 1.2.3.4 55 b"), (2, "a 555-010-7777 555-020-7777 555-030-7777 b"), (3, "a 12345 12345 12345 12345 b"), (4, "a 12345 12345. b 6")])
    got = {r.doc_id: [(t.match, t.left) for t in r.tokens] for r in P._occurrences(docs).collect()}
    assert got[1] == [("1.2.3.4", "a "), ("55", "a 0 ")]
    assert [m for m, _ in got[2]] == ["555-010-7777", "555-020-7777", "555-030-7777"]
    assert got[3] == [("12345", "a "), ("12345", "a 0 "), ("12345", "0 0 "), ("12345", "0 0 ")]
    assert got[4] == [("12345 12345.", "a "), ("6", "a 0 b ")]


def test_empty_and_plan(make):
    assert P.find(make([])).count() == 0
    plan = P.digest(P.find(make([(1, "a@b.co")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

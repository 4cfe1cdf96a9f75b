"""Secret scans: base spans against `re`, linking, redaction."""

import hashlib
import random
import re

from stride.llm import secret_scan as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = ("assign", "access", "hex")


def base(text):
    text = text or ""
    out = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(((m.start(), KINDS.index(k), m.end(), k) for k, m in out))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def random_text(rng):
    bits = ["password", "Token", "API_KEY", "secret", "=", ":", " ", '"', "'", "abc", "deadbeef" * 3, "AKIA", "ABCDEFGH12345678", "é", "😀",
            "\n", "x" * 7, "token: token: abcdefgh", "ſecret=abcdef99", "user=bob1", "pwd=hunter22", "https://h.example/x", "0" * 30]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))


def test_base_spans_equal_re(make):
    rng = random.Random(11)
    texts = [None, "", "password=" + "a" * 100_000, "😀" * 50 + " token='abcdef' " + "é" * 30 + "AKIA" + "Z" * 16] + [random_text(rng) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "token=abcdefg"), (3, texts[3])]
    docs = make([(i, t, "x", 3) for i, t in rows], "doc_id bigint, text string, base string, n_hex int")
    got = S.digest(S.scan(docs)).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, [sum(s[3] == k for s in base(t)) for k in KINDS], hashlib.sha256(joined(base(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in got) == want
    for r in got:  # base spans stay among all spans
        t = next(t for i, t in rows if i == r.doc_id)
        assert set(joined(base(t)).split(",")) - {""} <= set(r.spans.split(","))


def test_weak_parts_need_company(make):
    rows = [
        (1, "login: alice99 and then pwd: hunter22 at https://db.example.com/x"),
        (2, "pwd: hunter22 stands alone"), (3, "login: alice99 stands alone https://db.example.com"),
        (4, "login: alice99 " + "far " * 200 + " pwd: hunter22"),
        (5, "account = ops-team\npassword = longenough1\nhttps://api.example.com"),
    ]
    got = {r.doc_id: r.spans for r in S.digest(S.scan(make(rows))).collect()}
    assert [s.split(":")[0] for s in got[1].split(",")] == ["link_id", "link_secret", "link_endpoint"]
    assert got[2] == got[3] == got[4] == ""
    assert sorted(s.split(":")[0] for s in got[5].split(",")) == ["assign", "link_endpoint", "link_id"]


def test_endpoint_of_base_parts_is_linked(make):
    """Identifier and secret may both be base spans; the endpoint is then the only weak part."""
    key = "AKIA" + "Z" * 16
    rows = [(1, f"{key} token=abcdef123 https://h.example/x"), (2, f"{key} " + "0" * 24 + " s3://b/x"), (3, f"{key} https://h.example/x"),
            (4, f"{key} token=abcdef123 " + "far " * 200 + "https://h.example/x")]
    docs = make(rows)
    got = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",")] for r in S.digest(S.scan(docs)).collect()}
    assert got == {1: ["access", "assign", "link_endpoint"], 2: ["access", "hex", "link_endpoint"], 3: ["access"], 4: ["access", "assign"]}
    assert {r.doc_id: r.text for r in S.redact(docs).collect()}[1] == "[SECRET] [SECRET] [SECRET]"


def test_redaction(make):
    rows = [(1, "a token=abcdef123 b " + "0" * 24 + " c", 5), (2, "nothing", 6), (3, None, 7), (None, "secret: 'zzzzzzz'", 8)]
    docs = make(rows, "doc_id bigint, text string, _ss int")
    got = sorted(((r.doc_id or 0), r.text, r._ss) for r in S.redact(docs).collect())
    assert got == [(0, "[SECRET]'", 8), (1, "a [SECRET] b [SECRET] c", 5), (2, "nothing", 6), (3, None, 7)]


def test_redaction_of_a_very_long_text(make):
    """2,000 secrets in one text of 200,000 words, beside a text without any."""
    parts = ["word " * 100 + f"token={n:024x}!" for n in range(2000)]
    rows = [(1, " ".join(parts)), (2, "plain " * 200_000)]
    got = {r.doc_id: r.text for r in S.redact(make(rows)).collect()}
    assert got[2] == rows[1][1] and got[1] == " ".join("word " * 100 + "[SECRET]!" for _ in parts)


def test_empty_and_plan(make):
    assert S.scan(make([])).count() == 0
    plan = S.digest(S.scan(make([(1, "token=abcdefg")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Periodic runs against a plain walk of every diagonal."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from stride.llm import periodic_runs as P
from stride.llm.queries import queries, reread
from tests.conftest import SF_SMALL


def plain_runs(w, r=P.RunRules()):
    n, out = len(w), {}
    for q in range(1, n // r.repeats + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            a = i - q
            while i < n and w[i] == w[i - q]:
                i += 1
            if i - a >= max(r.min_length, r.repeats * q):
                out.setdefault((a, i - a), q)
    return sorted((a, n, q) for (a, n), q in out.items())


def plain_row(doc_id, text, order=None):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if order and order(doc_id, len(w)) is not None:
        w = [w[j] for j in order(doc_id, len(w))]
    runs = plain_runs(w)
    gone = {j for a, n, q in runs for j in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(w), len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))


def order_of(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[-1]))


def test_query_equals_plain_walk_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs = [(d, t) for d, t in docs if len((t or "").split()) <= 3000]  # the plain walk is quadratic
    got = {r.doc_id: tuple(r) for r in queries()["op13_periodic_runs"](spark, SF_SMALL).collect()}
    assert [got[d] for d, _ in docs] == [plain_row(d, t, reread) for d, t in docs]
    assert sum(r[2] > 0 for r in got.values()) > 5


def test_reading_order():
    for doc_id in range(300):
        for n in (0, 1, 2, 7, 500):
            h = zlib.crc32(str(doc_id).encode())
            got = reread(doc_id, n)
            if h % 10 or not n:
                assert got is None
                continue
            g, want = h // 10, []
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(n):
                want.append(i if i < a else a + (i - a) % p)
            assert list(got) == want
    assert reread(None, 5) is None


@pytest.mark.parametrize("rules", [P.RunRules(), P.RunRules(1), P.RunRules(10, 4)])
def test_runs_of_random_texts(rules):
    import numpy as np

    rng = random.Random(rules.min_length)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 4)):
            w, size = [], rng.randrange(1, 150)
            while len(w) < size:
                unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 25))]
                w += (unit * 9)[: rng.randrange(1, 9 * len(unit))]
            texts.append(w)
        word = np.array([x for w in texts for x in w])
        got = P.runs_of(word, np.repeat(np.arange(len(texts)), [len(w) for w in texts]), max(map(len, texts)), rules)
        want, zero = [], 0
        for w in texts:
            want += [(a + zero, n, q) for a, n, q in plain_runs(w, rules)]
            zero += len(w)
        assert [tuple(r) for r in got.T.tolist()] == want


def test_cases(make):
    text = "a b c " * 10 + "x y " * 13 + "z"
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "w " * 200_000), (5, text), (5, text), (None, text), (6, "é  " * 30 + "\x00 \x1c"), (7, "a b"),
            (8, " ".join(f"w{n % 40}" for n in range(120))), (9, " ".join(f"w{n % 40}" for n in range(119)))]
    docs = make([(i, t, 1, "r") for i, t in rows], "doc_id bigint, text string, n_words int, runs string")
    for parts in (1, len(rows)):
        found = P.find(docs.repartition(parts))
        got = [tuple(r) for r in P.digest(found).collect()]
        assert order_of([r for r in got if r[0] != 4]) == order_of([plain_row(i, t) for i, t in rows if i != 4])
    by = {r.doc_id: r for r in found.collect()}
    assert by[4].runs[0] == (0, 200_000, 1) and len(by[4].runs) == 1 and by[4].collapsed == "w"
    assert by[5].collapsed == "a b c x y z" and [tuple(r) for r in by[5].runs] == [(0, 30, 3), (30, 26, 2)]
    assert [len(by[i].runs) for i in (8, 9)] == [1, 0]
    assert P.find(make([])).count() == 0


def test_empty_tables_digest(make):
    assert P.digest(P.find(make([]))).count() == 0

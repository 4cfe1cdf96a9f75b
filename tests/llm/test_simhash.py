"""SimHash components against a plain comparison of all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from stride.llm import simhash as S
from stride.llm.queries import queries
from tests.conftest import SF_SMALL


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """(doc_id, bits) rows -> component per row, by a search over all pairs."""
    found = sorted({b for _, b in prints})
    of = {b: b for b in found}

    def top(b):
        while of[b] != b:
            b = of[b]
        return b

    for i, a in enumerate(found):
        for b in found[:i]:
            if (a ^ b).bit_count() <= 2:
                of[top(a)] = top(b)
    least = {}
    for d, b in prints:
        if d is not None:
            least[top(b)] = min(least.get(top(b), d), d)
    return [(d, format(b, "016x"), least.get(top(b))) for d, b in prints]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_query_equals_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    got = [tuple(r) for r in queries()["op12_simhash_neardup"](spark, SF_SMALL).collect()]
    assert order(got) == order(plain_components(rows))
    assert any(c != d for d, _, c in got)


def test_cases(make):
    long = "mot " * 70_000 + "fin de tout"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, long), (7, long), (None, "one"), (None, "two"),
            (8, "é b\x00c  d e\x1cf"), (9, "a b c d"), (10, "\U0001f600 x")]
    docs = make([(i, t, "k", 3) for i, t in rows], "doc_id bigint, text string, key string, bits int")
    for parts in (1, len(rows)):
        got = [tuple(r) for r in S.classes(docs.repartition(parts)).collect()]
        assert order(got) == order(plain_components([(i, plain_print(t)) for i, t in rows]))
    assert {c for d, _, c in got if d in (1, 2, 3)} == {1}
    assert S.classes(make([])).count() == 0


def linked(spark, bits, rules):
    rows = spark.createDataFrame([(b - (1 << 64) if b >> 63 else b,) for b in bits], "bits bigint")
    return {tuple(x % (1 << 64) for x in r) for r in S.links(rows, rules).collect()}


@pytest.mark.parametrize("crowd", [0, 3, 64])
def test_links_reach_what_all_pairs_reach(spark, crowd):
    """Also where a segment is shared by many; every link is within two bits."""
    rng = random.Random(crowd)
    base = [rng.getrandbits(64) for _ in range(4)]
    bits = set(base)
    for _ in range(150):  # dense clusters around few centres, and chains
        b = rng.choice(base)
        for _ in range(rng.randrange(5)):
            b ^= 1 << rng.choice([0, 1, 2, 31, 32, 33, 63, rng.randrange(64)])
        bits.add(b)
    for _ in range(60):  # one segment in common, the other at random
        bits.add(base[0] & 0xFFFFFFFF | rng.getrandbits(32) << 32)
    bits = sorted(bits)
    got = linked(spark, bits, S.SimHashRules(crowd=crowd))
    assert all((a ^ b).bit_count() in (1, 2) for a, b in got)
    want = {b: c for _, b, c in plain_components([(b, b) for b in bits])}
    of = {b: b for b in bits}

    def top(b):
        while of[b] != b:
            b = of[b]
        return b

    for a, b in got:
        of[top(a)] = top(b)
    least = {}
    for b in bits:
        least[top(b)] = min(least.get(top(b), b), b)
    assert {format(b, "016x"): least[top(b)] for b in bits} == want


def test_variants_meet_exactly_where_a_segment_is_near(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (-1,), (1 << 40,)], "bits bigint")
    got = S.variants(S.segments(rows))
    assert got.count() == 5 * 66 and got.select("bits", "key").distinct().count() == 5 * 66
    met = got.groupBy("key").agg(F.sort_array(F.collect_list("bits")).alias("b")).where(F.size("b") > 1).collect()
    pairs = {tuple(r.b) for r in met}
    assert (0, 1) in {p[:2] for p in pairs} and not any(-1 in p for p in pairs)


def test_majority_over_slices(monkeypatch):
    import numpy as np

    rng = random.Random(8)
    sizes = [0, 3, 1, 0, 9, 4, 0]
    values = np.array([rng.getrandbits(64) for _ in range(sum(sizes))], dtype=np.uint64)
    whole = S.majority(values, sizes).tolist()
    for n in (1, 2, 5, 16):
        monkeypatch.setattr(S, "SLICE", n)
        assert S.majority(values, sizes).tolist() == whole
    assert whole[0] == whole[3] == whole[6] == 0 and whole[2] == int(values[3])

"""BagMinHash: unbiased signatures, and classes against brute force."""

import collections
import random

import numpy as np

from stride.llm import bagminhash as B
from stride.llm.components import components
from tests.conftest import SF_SMALL


def multiset(text, size=5):
    words = (text or "").lower().encode().split()
    if not words:
        return collections.Counter()
    if len(words) < size:
        return collections.Counter([tuple(words)])
    return collections.Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def jaccard(a, b):
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def brute_classes(rows, threshold=0.8):
    """doc_id -> smallest doc_id of its connected class."""
    bags = [multiset(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(bags[i], bags[j]) >= threshold:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    return {d: min(g) for g in groups.values() for d in g}


def test_multisets_equal_plain_version():
    texts = ["a b c d e f g", "", None, "one two", "x x x x x x x x", "The THE the the the the", "q\tw\ne r  t y"]
    key, weight, who = B.multisets(texts, 5)
    for k, t in enumerate(texts):
        assert sorted(weight[who == k]) == sorted(multiset(t).values())


def test_registers_agree_with_the_weighted_similarity():
    rng = random.Random(1)
    m, errors = 512, []
    for trial in range(12):
        keys = np.array([rng.getrandbits(64) for _ in range(60)], dtype=np.uint64)
        wa = np.array([rng.choice([0, 1, 1, 2, 3, 7, 20]) for _ in keys])
        wb = np.array([w if rng.random() < 0.6 else rng.choice([0, 1, 2, 5, 9]) for w in wa])
        sig = [B.signatures(keys[w > 0], w[w > 0], np.zeros((w > 0).sum(), int), 1, m)[0] for w in (wa, wb)]
        exact = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
        errors.append((sig[0] == sig[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.1


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f g h i j", "k l m n o p", "one", "a b c d e f g h i j k l m"]
    together = B.signatures(*B.multisets(texts, 5), 4, 156)
    for k, t in enumerate(texts):
        assert (B.signatures(*B.multisets([t], 5), 1, 156)[0] == together[k]).all()


def test_classes_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: r.class_id for r in B.classes(docs).collect()} == brute_classes(rows)


def test_chains_groups_and_odd_rows(make):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(200)]
    rows, chain = [], list(base)
    for k in range(12):  # a chain: neighbours are similar, its ends are not
        rows.append((100 + k, " ".join(chain)))
        chain[k * 15:k * 15 + 4] = [word() for _ in range(4)]
    for k in range(40):  # near copies of another text
        copy = [word() if k else w for w in ()] or [f"w{i}" for i in range(150)]
        copy[rng.randrange(150)] = word()
        rows.append((200 + k, " ".join(copy)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "few words"), (304, "Few  WORDS"), (305, "z " * 30_000), (306, "z " * 30_000)]
    docs = make([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, id string, cls int")
    got = {r.doc_id: r.class_id for r in B.classes(docs).collect()}
    assert got == brute_classes(rows)
    kept = B.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_repeated_rows_and_null_ids(make):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make([(7, text), (7, text), (None, text), (None, "other words that stand alone"), (None, "other words that stand alone")])
    assert len(B.classes(docs).collect()) == 5
    kept = sorted((r.doc_id or 0, r.text) for r in B.keep_one(docs).collect())
    assert kept == [(0, "other words that stand alone"), (7, text)]


def test_empty_table(make):
    assert B.classes(make([])).count() == 0 and B.keep_one(make([])).count() == 0


def test_components(make, spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (5, 5), (None, 3), (100, 101)] + [(500, k) for k in range(501, 560)]
    got = {r.node: r.root for r in components(make(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}, **{k: 500 for k in range(500, 560)}}
    assert components(make([], "a bigint, b bigint"), "a", "b").count() == 0


def test_crowded_bands_block_by_block(make):
    """A group whose texts are similar to a base but often not to one another, compared in blocks of eight."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(120):
        words = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 5)):
            words[at] = f"x{k}y{at}"
        rows.append((k, " ".join(words)))
    got = {r.doc_id: r.class_id for r in B.classes(make(rows), B.Banding(block=8)).collect()}
    assert got == brute_classes(rows) and len(set(got.values())) > 3


def test_block_similarities_equal_pairs():
    texts = ["a b c d e f g", "a b c d e f g h", "z z z z z z z z z", "z z z z z z z", "", "q"]
    bags = [multiset(t) for t in texts]
    got = B.block_similarities(texts, np.array([0, 2, 4]), np.array([1, 3, 5]), 5, columns=2)
    want = [[jaccard(bags[i], bags[j]) for j in (1, 3, 5)] for i in (0, 2, 4)]
    assert np.allclose(got, want)

"""Toxicity: held-out quality, gapped and inserted-character insults, defined cases."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stride.llm import queries as Q
from stride.llm import toxicity as T
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    return T.train(docs, labels.where(~Q.held_out("doc_id", 5, 0)))


def plain_features(word, k):
    """Gapped subsequences of three characters of a marked word with their weights, and the word's norm."""
    out, word = {}, f"\x01{word}\x02"
    for a in range(len(word)):
        for b, c in itertools.combinations(range(a + 1, min(a + k.max_span, len(word))), 2):
            out.setdefault(word[a] + word[b] + word[c], []).append(k.decay ** (c - a + 1))
    return out, np.sqrt(sum(w * w for v in out.values() for w in v))


def plain_similarity(x, y):
    (fx, nx), (fy, ny) = x, y
    return min(1.0, sum(sum(v) * sum(fy[f]) for f, v in fx.items() if f in fy) / (nx * ny))


def test_kernel_equals_plain_version():
    k = T.Kernel(floor=0.0)
    words = ["idiot", "idioot", "idxiot", "moron", "worthless", "wrthless", "abc", "réeuxment", "réeuxvi"]
    marks = T.Landmarks(words, k)
    codes = [np.array([ord(c) for c in w], np.uint32) for w in words]
    sizes = np.array([len(c) for c in codes])
    found, rows = marks.similarities(np.concatenate(codes), np.cumsum(sizes) - sizes, sizes)
    full = np.zeros((len(words), len(words)))
    full[found] = rows
    known = [plain_features(w, k) for w in words]
    want = [[plain_similarity(x, y) for y in known] for x in known]
    assert full == pytest.approx(np.array(want), abs=1e-6)


def test_scores_equal_plain_version(spark, model):
    """Words, kernel, pooled landmarks, margin and sigmoid of 50 texts, one word after the other."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("length(text) < 500").orderBy("doc_id").limit(50)
    k, marks = model.kernel, [plain_features(w, model.kernel) for w in model.landmarks]
    similar = {}

    def row(word):
        if word not in similar:
            own = plain_features(word, k)
            s = np.array([plain_similarity(own, m) for m in marks])
            similar[word] = np.where(s >= k.floor, s, 0.0)
        return similar[word]

    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    rows = docs.collect()
    assert len(rows) == 50
    for r in rows:
        # symbols inside a word fall out; single letters up to three characters apart are one word
        text = re.sub(r"(?<=[^\W_])(?:[^\w\s]|_)(?=[^\W_])", "", r.text.lower())
        words = re.findall(r"(?<![^\W_])[^\W_](?:[\W_]{1,3}(?![^\W_]{2})[^\W_])+(?![^\W_])|[^\W_]+", text)
        words = {re.sub(r"[\W_]", "", w) for w in words}
        pooled = np.max([row(w) for w in words if len(w) >= 3] or [np.zeros(len(marks))], axis=0)
        margin = pooled @ model.weights + model.bias
        want = 1 / (1 + np.exp(-np.clip(model.scale * margin + model.shift, -30, 30)))
        assert got[r.doc_id] == pytest.approx(want, abs=1e-5), r.text


def test_new_words_in_slices(model, monkeypatch):
    """Any slice size gives the same similarities, also where one word is longer than a slice."""
    texts = ["idiot moron " * 3 + "w" * 500, "i--d--i--o--t", "zzz " * 20, ""]
    kinds = T.character_kinds()
    whole = T.pooled(texts, T.Memory(T.Landmarks(model.landmarks, model.kernel)), kinds)
    for n in (1, 9, 40):
        monkeypatch.setattr(T, "SLICE_CHARS", n)
        assert (T.pooled(texts, T.Memory(T.Landmarks(model.landmarks, model.kernel)), kinds) == whole).all()
    assert whole[0].any()


def test_held_out(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", "toxic")
    rows = Q.op6_toxicity(spark, SF_CHECK).where("held_out").join(labels, "doc_id").toPandas()
    s, y = rows["score"].to_numpy(), rows["toxic"].to_numpy()
    auc = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()
    assert auc > 0.75 and ((s >= 0.5) == (y == 1)).mean() > 0.9


def test_inserted_and_gapped_insults(make, model):
    prose = "thaner the only and of ering thly to that"
    texts = [prose, f"{prose} idiot {prose}", f"{prose} id1iot {prose}", f"{prose} i.d.i.o.t {prose}", f"{prose} i d i o t {prose}", f"{prose} IDIOT!!! {prose}",
             f"{prose} i--d--i--o--t {prose}", f"{prose} i . d . i . o . t {prose}"]
    scores = {r.doc_id: r.score for r in T.score(make(list(enumerate(texts))), model).collect()}
    assert all(scores[k] > scores[0] + 0.3 for k in range(1, len(texts)))
    assert scores[1] == pytest.approx(scores[3]) == pytest.approx(scores[4]) == pytest.approx(scores[5]) == pytest.approx(scores[6]) == pytest.approx(scores[7])


def test_cases(make, model):
    rows = [(1, None), (2, ""), (3, "..."), (4, "x" * 200_000), (None, "idiot moron"), (5, "ab"), (1, None)]
    docs = make([(i, t, "s", 0) for i, t in rows], "doc_id bigint, text string, score string, predicted int")
    got = T.score(docs, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3, 5)}) == 1
    assert T.score(docs.limit(0), model).count() == 0


def test_one_label_only(make):
    docs = make([(1, "a b c"), (2, None)])
    labels = make([(1, 0), (2, 0), (3, None), (None, 1)], "doc_id bigint, toxic int")
    flat = T.train(docs, labels)
    assert [r.score for r in T.score(docs, flat).collect()] == [0.0, 0.0]
    assert T.train(docs.limit(0), labels).rate == 0.0

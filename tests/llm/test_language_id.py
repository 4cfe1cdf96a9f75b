"""Language identification: held-out accuracy and defined cases."""

import pytest
from pyspark.sql import functions as F

from stride.llm import language_id as L
from stride.llm import queries as Q
from tests.conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    return L.train(docs.where(~Q.held_out("doc_id", 4, 2)))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    rows = Q.op3_language_id(spark, SF_CHECK).where("held_out").join(docs, "doc_id")
    n, right = rows.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right / n >= 0.97


def test_cases(make, model):
    rows = [(1, None), (2, ""), (3, "123 ... ٠"), (4, "The and of the with thing"), (5, "y" * 100_000), (None, "das und der nicht"), (4, "The and of the with thing")]
    docs = make([(i, t, "x", 1.0) for i, t in rows], "doc_id bigint, text string, lang_pred string, score double")
    got = {(r.doc_id, i): (r.lang_pred, r.score) for i, r in enumerate(L.predict(docs, model).collect())}
    by_id = {}
    for (i, _), v in got.items():
        by_id.setdefault(i, []).append(v)
    assert by_id[1] == by_id[2] == by_id[3] == [("und", 0.0)]
    assert by_id[4][0][0] == "en" and len(by_id[4]) == 2 and by_id[4][0] == by_id[4][1]
    assert by_id[None][0][0] == "de"
    assert all(0 <= s <= 1 for v in by_id.values() for _, s in v)
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 5]


def test_scores_do_not_depend_on_neighbours(make, model):
    texts = ["The and of", "la les des que", "", "x", "der die das"]
    alone = [L.score_texts([t], model.languages, model.log_prob, model.letters, model.grams) for t in texts]
    together = L.score_texts(texts, model.languages, model.log_prob, model.letters, model.grams)
    assert [a[0][0] for a in alone] == together[0]
    assert [a[1][0] for a in alone] == pytest.approx(together[1])


def test_nothing_to_learn_from(make):
    docs = make([(1, "words here", None)], "doc_id bigint, text string, lang string")
    empty = L.train(docs)
    assert L.predict(docs, empty).first().lang_pred == "und"
    assert L.predict(docs.limit(0), empty).count() == 0


def plain_buckets(text, bits=15):
    """The hashed n-grams of a text, one character after the other."""
    mult = [0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35]
    chars, kept = [c if c.isalpha() else " " for c in text.lower() + " "], []
    for k, c in enumerate(chars):
        if c != " " or (k and chars[k - 1] != " "):
            kept.append(ord(c))
    out = []
    for n in (1, 2, 3):
        for k in range(len(kept) - n + 1):
            if n == 1 and kept[k] == 32:
                continue
            h = n * 0x632BE5AB & 0xFFFFFFFF
            for j in range(n):
                h = (h ^ kept[k + j]) * mult[j] & 0xFFFFFFFF
                h ^= h >> 15
            out.append(h >> (32 - bits))
    return out


def test_equals_plain_naive_bayes(spark):
    """Counts, smoothing and posteriors in plain Python, on whole texts; all rows fit the training bound."""
    import math
    from collections import Counter

    table = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    learn = [(t, x) for d, t, x in table if d % 3 and t and x]
    counts = {x: Counter() for _, x in learn}
    for t, x in learn:
        counts[x].update(plain_buckets(t))
    names = sorted(counts)
    size = {x: sum(counts[x].values()) + 0.5 * 2**15 for x in names}
    model = L.train(spark.createDataFrame([(d, t, x) for d, t, x in table if d % 3], "doc_id bigint, text string, lang string"), 1_000_000)
    got = {r.doc_id: r for r in L.predict(spark.createDataFrame([r[:2] for r in table], "doc_id bigint, text string"), model).collect()}
    for d, t, _ in table:
        grams = Counter(plain_buckets(t or ""))
        if not grams:
            assert (got[d].lang_pred, got[d].score) == ("und", 0.0)
            continue
        total = [sum(n * math.log((counts[x][b] + 0.5) / size[x]) for b, n in grams.items()) for x in names]
        best = max(range(len(names)), key=lambda k: total[k])
        # the model keeps its logarithms as 32-bit numbers
        slack = 1e-6 * sum(grams.values())
        assert got[d].lang_pred == names[best] or max(total) - total[names.index(got[d].lang_pred)] < slack
        want = 1 / sum(math.exp(v - max(total)) for v in total)
        assert got[d].score == pytest.approx(want, abs=max(1e-6, 2 * slack))

"""The pipeline's stages, each against brute force on its own input."""

import pytest

import corpus_pipeline as C
from stride.llm import secret_scan as S
from tests.conftest import SF_SMALL
from tests.llm.test_bagminhash import brute_classes
from tests.llm.test_decontamination import brute
from tests.llm.test_packing import check


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    secret = docs.where("doc_id = 1").selectExpr("doc_id + 100000 AS doc_id", "concat(text, ' token = \"0123456789abcdef\" and ', reverse(text)) AS text", "lang", "source", "n_chars")
    docs = docs.unionByName(secret)
    out = [docs]
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    assert all(sorted(d.columns) == sorted(steps[0].columns) for d in steps[:-1])
    assert "sequence_id" in steps[-1].columns


def test_language_stage_keeps_clean_documents(steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert set(after) <= set(before) and len(after) >= 0.97 * len(before)


def test_one_of_each_near_duplicate_class_stays(steps):
    before, after = rows(steps[1]), rows(steps[2])
    assert sorted(d for d, _ in after) == sorted(set(brute_classes(before).values())) and set(after) <= set(before)


def test_contaminated_documents_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = [(d, t) for d, t in rows(steps[2]) if not brute(t, items)[4]]
    assert sorted(rows(steps[3])) == sorted(want) and len(want) < len(rows(steps[2]))


def test_secrets_are_gone_and_documents_stay(steps):
    before, after = dict(rows(steps[3])), dict(rows(steps[4]))
    assert before.keys() == after.keys()
    assert S.scan(steps[4]).where("size(base) > 0").count() == 0
    assert sum(before[d] != after[d] for d in before) == S.scan(steps[3]).where("size(all_spans) > 0").count()
    assert "0123456789abcdef" in before[100001] and "[SECRET]" in after[100001]
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_everything_is_packed(steps):
    got = steps[5].collect()
    n = check(rows(steps[4]), got)
    assert n <= -(-sum(r.length for r in got) // 4096) + 1


def test_run_equals_the_stages(spark, steps, tmp_path):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    steps[0].write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = sorted(map(tuple, C.run(spark, str(tmp_path)).select(columns).collect()))
    assert run == sorted(map(tuple, steps[5].select(columns).collect()))


def test_odd_rows_pass_through(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "The and of the with thing to by for", "en", "s", 35)] * 2,
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() <= 2
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in C.STAGES:
        empty = stage(spark, empty, SF_SMALL)
    assert empty.count() == 0

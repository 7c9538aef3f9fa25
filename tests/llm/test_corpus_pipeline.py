import brute
import corpus_pipeline
import pytest

from hourgrid.llm import decontaminate, quality, surrogates
from hourgrid.llm.queries import ENCODER, KEY, ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs.toPandas())
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
        out.append(docs.toPandas())
        docs = spark.createDataFrame(out[-1])
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(corpus_pipeline.STAGES) == 5
    for frame in stages[1:-1]:
        assert list(frame.columns) == list(stages[0].columns)
    assert "sequence_id" in stages[-1].columns


def test_quality_stage(spark, stages):
    judged = quality.judge(spark.createDataFrame(stages[0])).toPandas()
    assert set(stages[1].doc_id) == set(judged[judged.kept].doc_id) and len(stages[1]) < len(stages[0])
    assert set(stages[1].doc_id) <= {i for i, t in zip(stages[0].doc_id, stages[0].text) if len(brute.words(t)) >= 50}


def test_near_copy_stage(stages):
    texts = dict(zip(stages[1].doc_id, stages[1].text))
    want = {i for i, c in brute.components(texts, 5, 80).items() if i == c}
    assert set(stages[2].doc_id) == want and len(want) < len(texts)


def test_benchmark_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {i for i, t in zip(stages[2].doc_id, stages[2].text) if not brute.hits(t, items, 10)[1]}
    assert set(stages[3].doc_id) == want


def test_surrogate_stage(spark, stages):
    before, after = (dict(zip(s.doc_id, s.text)) for s in (stages[3], stages[4]))
    assert before.keys() == after.keys()
    found = surrogates.replace(spark.createDataFrame(stages[3]), KEY).toPandas()
    assert after == dict(zip(found.doc_id, found.text))
    assert all((before[i] == after[i]) == (n == 0) for i, n in zip(found.doc_id, found.n_entities))
    assert all(n == len(t) for n, t in zip(stages[4].n_chars, stages[4].text))


def test_packing_stage(stages):
    assert set(stages[5].doc_id) == set(stages[4].doc_id) and stages[5].length.max() <= 2048
    ends = (stages[5].offset + stages[5].length).groupby(stages[5].sequence_id).max()
    assert ends.sum() == stages[5].length.sum()


def test_whole_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    order = lambda f: f[columns].sort_values(columns).reset_index(drop=True)
    assert order(got).equals(order(stages[5]))


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] and set(ORACLE) <= set(QUERIES)
    assert len(ENCODER) == 3 and decontaminate.LISTS >= 2

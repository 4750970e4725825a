import pytest

import corpus_pipeline as pipeline
from prevascope.llm import toxicity
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm import test_contamination, test_exact_dedup, test_near_dedup
from tests.llm.rows import SCHEMA, awkward


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=repr)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage keeps of the sample."""
    docs, out = table(spark, SAMPLE, "documents"), []
    for name, stage in pipeline.STAGES:
        from prevascope.session import materialise

        before, docs = docs, materialise(stage(spark, docs, SAMPLE), name)
        out.append((name, before, docs))
    return out


def test_stages_in_order(stages):
    assert [n for n, *_ in stages] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "pieces"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and 0 < after.count() <= before.count()


def test_each_stage_equals_plain_python(spark, stages):
    (_, docs, clean), (_, _, single), (_, _, apart), (_, _, pure), (_, _, encoded) = stages
    model = toxicity.train(docs, table(spark, SAMPLE, "labels"))
    assert ids(clean) == ids(toxicity.score(docs, model).where("predicted = 0"))
    assert ids(single) == sorted((r[0] for r in test_exact_dedup.brute(pairs(clean)) if r[3]), key=repr)
    assert ids(apart) == sorted((r[0] for r in test_near_dedup.brute(pairs(single)) if r[3]), key=repr)
    bench = [tuple(r) for r in table(spark, SAMPLE, "benchmark").collect()]
    assert ids(pure) == sorted((r[0] for r in test_contamination.brute(pairs(apart), bench) if not r[5]), key=repr)
    assert {r.doc_id for r in encoded.collect()} == set(ids(pure)) and encoded.where("not round_trip").isEmpty()
    texts = dict(pairs(docs))
    assert all(texts[r.doc_id] == r.text for r in pure.collect())


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    single = pipeline.drop_exact_copies(spark, docs, SAMPLE)
    assert ids(single) == sorted([2, 4, 5, 7, 8, 9, 10, None], key=repr)
    same_id = [(1, "a b c d e f g", "en", "a", 1), (1, "a b c d e f g ", "en", "a", 1), (1, "a b c d e f g", "en", "a", 1), (2, "A b c d e f g", "en", "a", 1)]
    assert ids(pipeline.drop_near_copies(spark, spark.createDataFrame(same_id, SCHEMA), SAMPLE)) == [1]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SAMPLE).collect() == []
        assert len(stage(spark, docs, SAMPLE).collect()) > 0

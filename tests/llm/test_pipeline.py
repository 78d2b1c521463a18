"""The pipeline's stages, each on what the one before it kept."""

import corpus_pipeline
from footfall.llm.tables import hand_over, table
from tests.conftest import SF
from tests.llm.test_operators import brute_components, brute_counts, given
from tools.compare import compare, oracle


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    outs = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = hand_over(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        outs.append(dict(given(docs)))
    before = dict(given(table(spark, SF, "documents")))
    good, exact, near, mixed = outs
    assert all(not brute_counts(t)[-1] for t in good.values())
    assert sorted(exact) == sorted({t: i for i, t in sorted(good.items())}.values())
    components = brute_components(sorted(exact.items()), 80)
    assert sorted(near) == [r[0] for r in sorted(components) if r[3]]
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    clean = {i for i in near if i in labels and labels[i].quality == 1 and labels[i].toxic == 0}
    assert clean <= set(mixed) <= set(before)


def test_odd_rows_pass_every_stage(spark, odd, monkeypatch):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    for start in (odd, odd.limit(0)):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = hand_over(stage(spark, docs, SF), "stage")
            assert docs.columns == odd.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_sql_twins(spark):
    import __spark_entry__ as entry

    con = oracle(SF)
    for name, sql in entry.LLM_SQL.items():
        assert compare(entry.queries()[name](spark, SF), con, sql) == "", name
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {n.split("_")[0] for n in entry.LLM}

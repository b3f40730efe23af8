"""The pipeline's stages on the small tables: each judged on its own input."""

import collections

import pytest

import corpus_pipeline
from terrane.llm import decontaminate, pii
from terrane.session import stored
from tests.llm.test_text_operators import AWKWARD, SF, brute_classes, frame


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        out.append((name, before, docs))
    return out


def test_stages_keep_the_columns(stages):
    assert [n for n, _, _ in stages] == ["quality", "near-duplicates", "decontamination", "personal data", "mixture"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality_stage_drops_what_is_labelled_bad(spark, stages):
    _, before, after = stages[0]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    assert all((r.doc_id in kept) == (label[r.doc_id] == 1) for r in before.collect() if r.doc_id in label)


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    classes = brute_classes([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(classes.values()))


def test_contaminated_documents_go(spark, stages):
    _, before, after = stages[2]
    match = decontaminate.Matcher([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before.collect() if not match(r.text))


def test_no_base_span_is_left(stages):
    _, before, after = stages[3]
    assert before.count() == after.count() and not any(pii.base_spans(r.text) for r in after.collect())


def test_mixture_has_only_what_is_taken(stages):
    _, before, after = stages[4]
    ids = collections.Counter(r.doc_id for r in before.collect())
    assert all(r.taken > 0 and ids[r.doc_id] for r in after.collect())


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.taken) for r in got.collect()) == sorted((r.doc_id, r.taken) for r in stages[-1][2].collect())


def test_stages_on_awkward_rows_and_an_empty_table(spark):
    extra = ("taken", "log_weight", "key", "class_id", "spans", "first_slot")
    some = [(n, f"plain words of document {n} about the river and the mill. They go on for a while, and end here.") for n in range(100, 130)]
    for rows in (AWKWARD + some + [(200, "write to a.b@c.org now")] * 3, []):
        docs = frame(spark, rows, extra)
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stored(stage(spark, docs, SF), "awkward")
            assert set(docs.columns) >= set(before.columns) - {"taken", "first_slot", "log_weight"}
            if name != "mixture":
                assert docs.columns == before.columns and docs.count() <= before.count()
        kept = [r.text for r in docs.collect()]
        assert bool(kept) == bool(rows) and not any("a.b@c.org" in (t or "") for t in kept)

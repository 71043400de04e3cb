"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns have defined results."""

import public_tokenizers
import pytest

import corpus_pipeline
from tallymart.llm import decontamination, grammar, licenses, mixing, near, pii, rules, sharding, token_counts, toxicity

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def test_reports_keep_every_row(spark, edges, nothing):
    labels = spark.createDataFrame([(0, 1, 1), (7, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    reports = {
        "mixing": mixing.mix_report,
        "near": near.near_report,
        "rules": rules.quality_report,
        "toxicity": lambda d: toxicity.toxic_report(d, labels),
        "sharding": lambda d: sharding.shard_report(d, 3),
        "counts": lambda d: token_counts.token_report(d, BYTES),
        "grammar": lambda d: grammar.grammar_report(d, WORDS),
        "pii": pii.pii_report,
    }
    for name, report in reports.items():
        ids = sorted((r["doc_id"] for r in report(edges).collect()), key=repr)
        assert ids == sorted((r["doc_id"] for r in edges.collect()), key=repr), name
        assert report(nothing).collect() == [], name


def test_filters_keep_columns(spark, edges, nothing):
    items = spark.createDataFrame([(1, "w1 w2"), (2, None), (3, "")], "item_id bigint, text string")
    for change in (
        rules.without_rejects,
        near.deduplicated,
        lambda d: decontamination.without_leaks(d, items),
        mixing.mixed,
    ):
        assert change(edges).columns == edges.columns
        assert change(nothing).collect() == []


def test_shards_keep_columns(edges, nothing):
    cut = sharding.interleave(edges, 4)
    assert cut.columns[: len(edges.columns)] == edges.columns
    assert cut.count() == edges.count()
    assert sharding.interleave(nothing, 4).collect() == []


def test_scans_without_hits(edges, nothing, spark):
    items = spark.createDataFrame([(1, None)], "item_id bigint, text string")
    assert licenses.license_report(edges).collect() == []
    assert licenses.license_report(nothing).collect() == []
    assert decontamination.leak_report(edges, items).collect() == []
    assert decontamination.leak_report(edges, items.limit(0)).collect() == []
    assert decontamination.leak_report(nothing, items).collect() == []


def test_defined_values(edges):
    by = {r["doc_id"]: r for r in near.near_report(edges).collect() if r["doc_id"] is not None}
    assert (by[1]["component_id"], by[1]["kept"], by[0]["kept"]) == (0, False, True)
    assert (by[2]["n_shingles"], by[2]["component_id"]) == (0, 2)
    assert by[8]["n_shingles"] == 1
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix_report(edges).collect()}
    assert (sizes[2], sizes[3], sizes[4], sizes[5], sizes[9]) == (0, 0, 0, 30_000, 1)
    assert near.deduplicated(edges).where("doc_id = 7").count() == 1


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_on_edges(spark, edges, nothing, stage):
    _, change = corpus_pipeline.STAGES[stage]
    for docs in (edges, nothing):
        made = change(spark, docs, "/root/testdata/sf0.001")
        assert made.columns[: len(docs.columns)] == docs.columns
        made.collect()

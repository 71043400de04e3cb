"""The pipeline on the small tables: each stage's promise holds on what the stage before it kept."""

import oracle
import pytest

import corpus_pipeline
from tallymart.llm import mixing, near, rules
from tallymart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stage(spark, made[-1], FOLDER).cache())
    return made


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, steps):
    docs, good, single, clean, mixed, shards = steps
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "mixing", "sharding"]
    for frame in steps[:-1]:
        assert frame.columns == docs.columns
    assert ids(good) == ids(rules.quality_report(docs).where("kept"))
    from test_near import brute

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert ids(single) == sorted({root for _, root in brute(rows, 5).values()})
    leaked = {r[0] for r in oracle.connect(FOLDER).execute(ORACLES["op2_decontamination"]).fetchall()}
    assert ids(clean) == [i for i in ids(single) if i not in leaked]
    copies = [r["doc_id"] for r in mixing.mix_report(clean).collect() for _ in range(r["copies"])]
    assert ids(mixed) == sorted(copies)
    assert ids(shards) == ids(mixed)
    counts = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1


def test_run_is_the_stages(spark, steps):
    assert ids(corpus_pipeline.run(spark, FOLDER)) == ids(steps[-1])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), ORACLES[name])[:3] == []


def test_groups_on_the_table(spark):
    from test_near import brute

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_report(docs).collect()} == want

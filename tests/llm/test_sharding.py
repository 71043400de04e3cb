import hashlib
from collections import Counter

from corpus_cases import docs_frame, text_of

from tallymart.llm import sharding


def unit(value, seed="shard"):
    value = "" if value is None else value
    return int(hashlib.md5(f"{seed}\t{value}".encode()).hexdigest()[:13], 16) / 2**52


def test_matches_brute_force(spark):
    sources = ["a", "a", "a", "b", "c", None]
    rows = [(i, text_of(i, 5), "en", sources[i % 6]) for i in range(997)]
    found = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(docs_frame(spark, rows), 8, rows_per_range=50).collect()}
    order = []
    for s in ("a", "b", "c", None):
        own = sorted(unit(i) for i, _, _, x in rows if x == s)
        at = {u: k for k, u in enumerate(own)}
        order += [((at[unit(i)] + unit(s, "shard-phase")) / len(own), s is None, s or "", i) for i, _, _, x in rows if x == s]
    order.sort()
    firsts: dict = {}
    for position, (*_, i) in enumerate(order):
        shard = position * 8 // len(order)
        firsts.setdefault(shard, position)
        assert found[i] == (shard, position - firsts[shard])
    counts = Counter(s for s, _ in found.values())
    assert max(counts.values()) - min(counts.values()) <= 1


def test_every_shard_holds_the_mixture(spark):
    rows = [(i, "x", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(1200)]
    cells = Counter((r["shard"], r["source"]) for r in sharding.interleave(docs_frame(spark, rows), 6).collect())
    for source in {s for _, s in cells}:
        per = [cells[(k, source)] for k in range(6)]
        assert max(per) - min(per) <= 2


def test_report_and_files(spark, tmp_path, edges):
    report = sharding.shard_report(edges, 4).collect()
    assert {r["law"] for r in report} == {"rows"}
    assert min(r["size"] for r in report) == 8
    sharding.write_shards(edges, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == edges.count()
    assert sorted((r["shard"], r["slot"]) for r in back.collect()) == sorted((r["shard"], r["slot"]) for r in report)

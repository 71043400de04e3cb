import random
import zlib
from hashlib import sha256

import pytest
from corpus_cases import docs_frame, text_of

from tallymart.llm import manifest
from tallymart.llm.manifest import Shape


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """{(doc_id, leaf): (subroot, root, proof, folded)} of (doc_id, text, lang, source, n_chars)."""

    def climb(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([h(*found[-1][k : k + 2]) for k in range(0, len(found[-1]), 2)])
        return found

    def path(tree, at):
        for level in tree[:-1]:
            other = at ^ 1
            yield (at & 1, level[other] if other < len(level) else None)
            at //= 2

    groups = {}
    for i, t, lang, source, n in rows:
        leaf = h(*map(field, (i, source, lang, n, t)))
        hit = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
        now = h(*map(field, (i, source, lang, n + 1, t))) if hit else leaf
        groups.setdefault(lang, []).append(((i is not None, i or 0), leaf, now, i))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: climb([x[1] for x in sorted(groups[k], key=lambda x: x[:3])]) for k in names}
    top = climb([trees[k][-1][0] for k in names])
    found = []
    for number, k in enumerate(names):
        for at, (_, leaf, now, i) in enumerate(sorted(groups[k], key=lambda x: x[:3])):
            steps = [*path(trees[k], at), *path(top, number)]
            for odd, other in steps:
                now = h(now) if other is None else h(other, now) if odd else h(now, other)
            found.append((i, leaf, trees[k][-1][0], top[-1][0], h(*[s for _, s in steps if s]), now, now == top[-1][0]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("shape", [Shape(), Shape(1), Shape(2)])
@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 70, "de": 1, None: 5, "fr": 16, "é": 17, "z": 2}, {f"l{k}": 1 for k in range(11)}])
def test_matches_brute_force(spark, shape, sizes):
    r = random.Random(3)
    langs = [k for k, n in sizes.items() for _ in range(n)]
    ids = r.sample(range(10_000), len(langs))
    rows = [(i, r.choice([None, "", "é x", text_of(i, 20)]), k, r.choice(["a", None])) for i, k in zip(ids, langs, strict=True)]
    frame = docs_frame(spark, rows).repartition(5)
    want = brute([(*x, len(x[1] or "")) for x in rows])
    assert sorted(map(tuple, manifest.tampered_report(frame, shape).collect()), key=repr) == want


def test_edges(spark, edges, nothing):
    rows = [tuple(x)[:5] for x in edges.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted(map(tuple, manifest.tampered_report(edges, Shape(2)).collect()), key=repr) == brute(rows)
    assert manifest.tampered_report(nothing).collect() == []


def test_no_length_is_not_tampered_with(spark):
    hit = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 0)
    frame = docs_frame(spark, [(hit, "x", "en", "a"), (hit + 100_000, "y", "en", "a")]).selectExpr("doc_id", "text", "lang", "source", "cast(if(doc_id < 1000, null, n_chars) AS bigint) n_chars")
    assert {x["verified"] for x in manifest.tampered_report(frame).where(f"doc_id = {hit}").collect()} == {True}


def test_other_keys_and_changes(spark):
    rows = [(f"t{k % 3}", f"k{k:03}", h(str(k)), h(str(k), "!" if k == 44 else "")) for k in range(90)]
    leaves = spark.createDataFrame(rows, "tree string, key string, leaf string, now string").withColumn("now", manifest.F.expr("if(key = 'k044', now, leaf)"))
    found = {x["key"]: x["verified"] for x in manifest.manifest(leaves, Shape(2)).collect()}
    assert [k for k, ok in found.items() if not ok] == ["k044"]

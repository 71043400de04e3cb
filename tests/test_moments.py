import numpy as np
import pandas as pd
import pytest

from tallymart.operators import moments


def frame(spark, data, parts):
    rows = [tuple(None if v is None else float(v) for v in row) for row in data]
    return spark.createDataFrame(rows, ", ".join(f"c{k} double" for k in range(len(data[0])))).repartition(parts)


@pytest.mark.parametrize("parts", [1, 7])
def test_fifty_columns_with_gaps(spark, parts):
    r = np.random.default_rng(3)
    base = r.normal(size=(600, 50)) + r.normal(size=(600, 1)) * 0.7 + 1e7 * np.arange(50)
    gaps = r.random(base.shape) < np.linspace(0, 0.9, 50)
    data = [[None if g else v for v, g in zip(row, gap, strict=True)] for row, gap in zip(base, gaps, strict=True)]
    want = pd.DataFrame(np.where(gaps, np.nan, base)).corr()
    found = moments.correlations(frame(spark, data, parts), [f"c{k}" for k in range(50)]).collect()
    assert len(found) == 50 * 49 // 2
    for x in found:
        assert x["correlation"] == pytest.approx(want.iat[int(x["left"][1:]), int(x["right"][1:])], abs=1e-7)


def test_undefined_pairs(spark):
    nan, inf = float("nan"), float("inf")
    data = [[0.1, 1, None, nan, 1], [0.1, 2, 5, 1, inf], [0.1, 4, None, None, 3], [0.1, 9, None, 7, None]]
    found = {(x["left"], x["right"]): x["correlation"] for x in moments.correlations(frame(spark, data, 4), [f"c{k}" for k in range(5)]).collect()}
    assert len(found) == 10
    assert found["c0", "c1"] is None and found["c1", "c2"] is None  # no spread, a single row in common
    assert all(np.isnan(found["c1", c]) for c in ("c3", "c4"))
    assert found["c2", "c3"] is None
    empty = moments.correlations(frame(spark, data, 1).limit(0), ["c0", "c1", "c2"]).collect()
    assert [x["correlation"] for x in empty] == [None] * 3


def test_moments_do_not_hang_on_the_layout(spark):
    r = np.random.default_rng(5)
    data = [list(row) for row in 1e9 + r.normal(size=(500, 3))]
    runs = [sorted(moments.cross_moments(frame(spark, data, n), ["c0", "c1", "c2"]).collect()) for n in (1, 4, 16)]
    for other in runs[1:]:
        for a, b in zip(runs[0], other, strict=True):
            assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-6)

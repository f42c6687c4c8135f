import math
import random

import pytest

import advisorium.llm.vector_topk as m


def brute(rows, k):
    seen = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted({i for i, _ in seen if i % 10 == 0}):
        best = {}
        for i, a in seen:
            for j, b in seen:
                if i == q and j != q and len(a) == len(b):
                    best[j] = max(best.get(j, -(10**18)), sum(x * y for x, y in zip(a, b)))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, r, j, s) for r, (j, s) in enumerate(top, 1)]
    return out


@pytest.mark.parametrize("blocks", [(4096, 1024), (7, 2)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(16)]) for i in range(60)]
    rows += [(60 + i, list(rows[i][1])) for i in range(10)] + [rows[0], rows[1], (3, [0.5] * 16)]
    rows += [(100, None), (101, [1.0, None] + [0.0] * 14), (110, [float("nan")] * 16), (112, [float("inf")] * 16), (120, []), (130, [1.0, 2.0]), (131, [0.5, 0.5]), (None, [0.1] * 16)]
    monkeypatch.setattr(m, "BASE_BLOCK", blocks[0])
    monkeypatch.setattr(m, "QUERY_BLOCK", blocks[1])
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = sorted(map(tuple, m.exact_topk(df, "vec_id % 10 = 0", k=5).collect()))
    assert got == sorted(brute(rows, 5))


def test_few_and_none(spark):
    one = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in m.exact_topk(one, "vec_id % 100 = 0").collect()] == [(0, 1, 1, 1024 * 2048)]
    assert m.exact_topk(spark.createDataFrame([], one.schema), "vec_id % 100 = 0").collect() == []

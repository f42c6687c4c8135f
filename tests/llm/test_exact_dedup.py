import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from advisorium.llm.exact_dedup import exact_dedup

ROWS = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "a "), (7, "é" * 5000), (9, "é" * 5000), (8, "A"), (2, "a"), (10, "b")]


def want(rows, best):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return sorted(
        (i, best(groups[t or ""]), len(groups[t or ""]), i == best(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows
    )


@pytest.mark.parametrize("keep,best", [("max", max), ("min", min)])
@pytest.mark.parametrize("weak", [False, True])
def test_groups(spark, keep, best, weak):
    docs = spark.createDataFrame([(i, t, 0) for i, t in ROWS], "doc_id long, text string, keep_id int")
    extra = {"digest": lambda c: (F.length(c) % 3).cast("string").cast("binary")} if weak else {}
    got = exact_dedup(docs, keep, memtable_rows=3, **extra).collect()
    assert sorted(map(tuple, got)) == want(ROWS, best)


def test_empty_and_null_id(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = exact_dedup(spark.createDataFrame([(None, "x"), (3, "x")], "doc_id long, text string")).collect()
    assert sorted((r.keep_id, r.group_size, r.kept) for r in got) == [(3, 2, False), (3, 2, True)]

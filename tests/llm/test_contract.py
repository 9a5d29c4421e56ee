"""What is registered for the training-data operators."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from __spark_entry__ import oracle_sql, queries
from gridledger.llm import ann, jaccard
from gridledger.llm.oracles import ORACLES
from gridledger.llm.queries import QUERIES


def test_every_operator_has_its_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(oracle_sql())


def test_vectors_get_all_there_are(spark):
    """Small tables and far-off vectors at production defaults: 20 rows, or all candidates."""
    rng = np.random.default_rng(4)
    for n in (5, 12, 30):
        rows = [(i, rng.standard_normal(64).astype(float).tolist()) for i in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = ann.nearest(df, df.filter("vec_id % 20 = 0")).collect()
        for q in range(0, n, 20):
            scores = sorted(((-float(np.dot(rows[q][1], v)), i) for i, v in rows if i != q))[:20]
            mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
            assert len(mine) == min(20, n - 1)
            if n - 1 <= 20:
                assert [i for _, i in mine] == [i for _, i in scores]
    away = [(0, [1.0] * 64)] + [(i, [-1.0 - i / 1000 - j / 100 for j in range(64)]) for i in range(1, 60)]
    df = spark.createDataFrame(away, "vec_id long, embedding array<double>")
    assert [r.vec_id for r in ann.nearest(df, df.filter("vec_id = 0")).orderBy("rank").collect()] == list(range(1, 21))


def test_blocks_are_numbered_alike_when_run_again():
    keys, texts = pa.array([1, 2, 3]), pa.array(["a b c d e f", "a b c d e f g", ""])
    batch = pa.RecordBatch.from_arrays([keys, texts], names=["key", "text"])
    first, second = (list(jaccard._cells(4, 3, pa.int64())(iter([batch]))) for _ in range(2))
    assert len(first) == 1 and first[0].equals(second[0])

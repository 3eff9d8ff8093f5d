import math
import random

import pytest
from pyspark.sql import functions as F

from tideload.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(1024 * x) for x in v]
    out = []
    for q, a in good.items():
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, k=10, every=10, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % every == 0, k=k, **options).collect())


def vectors(count, width, seed):
    import struct

    rng = random.Random(seed)
    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    return [(i, [single(rng.gauss(0, 0.1)) for _ in range(width)]) for i in range(count)]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 100, "query_block": 7}])
def test_equals_brute_force(spark, options):
    rows = vectors(700, 16, 1)
    rows += [(700 + i, rows[5][1]) for i in range(300)]  # one very common vector, all ties
    assert run(spark, rows, **options) == brute(rows, 10, 10)


def test_defined_cases(spark):
    rows = vectors(30, 3, 2) + [(40, None), (50, [1.0, None, 2.0]), (60, [float("nan")] * 3), (70, [float("inf"), 0.0, 0.0])]
    rows += [(80, []), (90, [0.5]), (100, [0.0, 0.0, 0.0]), (110, [1e6, -1e6, 1e6]), (None, [1.0, 1.0, 1.0])]
    assert run(spark, rows) == brute(rows, 10, 10)
    assert run(spark, rows + rows) == brute(rows, 10, 10)
    few = vectors(4, 3, 3)
    assert run(spark, few) == brute(few, 10, 10)
    assert run(spark, []) == []
    # Beyond the whole numbers a double holds.
    large = [(i, [float(int(x * 1e6)) for x in v]) for i, v in vectors(200, 4, 5)]
    assert run(spark, large, k=3) == brute(large, 3, 10)


def test_numbers_beyond_a_long_are_refused(spark):
    schema = "vec_id long, embedding array<double>"
    large = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1.0, 2.0])], schema)
    with pytest.raises(Exception, match="does not fit a long"):
        top_k(large, F.col("vec_id") == 0)
    with pytest.raises(OverflowError):
        top_k(spark.createDataFrame([(0, [1e8, 1.0]), (1, [1.0, 2.0])], schema), F.col("vec_id") == 0)
    assert [r.score for r in top_k(spark.createDataFrame([(0, [1e4, 1.0]), (1, [1.0, 2.0])], schema), F.col("vec_id") == 0).collect()]

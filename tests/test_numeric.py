from __future__ import annotations

import random

from pyspark.sql import functions as F

from voltide.functions.numeric import exact_round, fixed_text, percent_text


def test_text_and_rounding_match_python(spark):
    rng = random.Random(4)
    values = [0.0, 5e-05, 0.00125, 0.00115, 2.675, 1.005, -2.5, -0.00001, 0.5, 1.5, 2.5, 1e11 + 0.25, 123456.789, 1e15, 1e-300]
    values += [round(rng.uniform(-100, 100), 5) / 10 ** rng.randint(0, 5) for _ in range(3000)]
    values += [rng.randint(-9999, 9999) / 2**k for k in range(12) for _ in range(50)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    x = F.col("x")
    got = rows.select(
        "x", *[fixed_text(x, d).alias(f"t{d}") for d in (1, 2, 4, 6)], *[exact_round(x, d).alias(f"r{d}") for d in (1, 2, 4, 6)],
        percent_text(x, 2).alias("p"),
    ).collect()
    for row in got:
        v = row["x"]
        for d in (1, 2, 4, 6):
            assert row[f"t{d}"] == f"{v:.{d}f}", v
            assert row[f"r{d}"] == round(v, d), v
        if abs(v) < 1e9:
            assert row["p"] == f"{v:.2%}", v


def test_special_values(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r[0] for r in rows.select(fixed_text(F.col("x"), 2)).collect()] == ["nan", "inf", "-inf", None]


def test_large_texts_match_python(spark):
    values = [123456789012345.67, -123456789012345.67, 1e12 - 2**-13,
              999999999999.99999, 2.0**52 + 1, 2.0**53 - 1, 2.0**62, 2.0**63, 1.5 * 2.0**70, 9.87e30, -1e30]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for row in rows.select("x", *[fixed_text(F.col("x"), d).alias(f"t{d}") for d in (2, 4)]).collect():
        assert (row.t2, row.t4) == (f"{row.x:.2f}", f"{row.x:.4f}")

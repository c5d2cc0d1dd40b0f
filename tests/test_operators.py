"""Counting in ranges against brute force, and the query over it on one large segment."""

import threading

from rawscan import operators
from rawscan.plans import catalog


def test_range_count_counts_as_an_outer_join(spark):
    rows = [(k, seg) for seg in ("a", "b", None) for k in [None, -41, -20, -1, 0, 1, 1, 1, 19, 20, 21, 39, 40, 60, 1 << 60]]
    df = spark.createDataFrame(rows, "k bigint, seg string")
    for first, last, width in ((1, 20, 20.0), (1, 20, 7.0), (-30, 30, 20.0), (5, 4, 20.0)):
        left = df.selectExpr("k", "seg", f"k + {first} AS lo", f"k + {last} AS hi")
        want = {k: 0 for k, _ in rows}
        for k, seg in rows:
            want[k] += sum(None not in (k, seg, j) and seg == s and k + first <= j <= k + last for j, s in rows)
        found = operators.range_count(left, df, "k", "seg", "k", "lo", "hi", width).collect()
        assert len(found) == len(want) and {r.k: r.n for r in found} == want
        assert operators.range_count(left, df.limit(0), "k", "seg", "k", "lo", "hi", width).where("n = 0").count() == len(want)
        assert operators.range_count(left.limit(0), df, "k", "seg", "k", "lo", "hi", width).count() == 0


def test_outer_theta_ends_on_one_segment_of_many_customers(spark, tmp_path):
    n, late = 200_000, threading.Event()
    spark.range(n).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "'BUILDING' AS c_mktsegment").write.parquet(f"file://{tmp_path}/customer.parquet")
    timer = threading.Timer(60, lambda: (late.set(), spark.sparkContext.cancelAllJobs()))
    timer.start()
    try:
        found = catalog.queries()["host_outer_theta"](spark, f"file://{tmp_path}").groupBy("n").count().collect()
    except Exception:
        assert not late.is_set(), "no end after 60 s"
        raise
    finally:
        timer.cancel()
    assert {r.n: r["count"] for r in found} == {20: n - 20, **{i: 1 for i in range(20)}}

"""Marked duplicates in one large group."""

from helixframe.operators import reads as O
from helixframe.plans import read_queries as Q


def test_a_large_group_keeps_one_read_and_needs_no_window(spark, sf):
    one = Q.reads(spark, sf).where("NOT unmapped AND read_no = 1").limit(1).drop("qname", "qual")
    copies = spark.sql("SELECT concat('c', lpad(id, 4, '0')) AS qname, repeat(CASE WHEN id % 7 = 3 THEN 'I' ELSE '5' END, 64) AS qual FROM range(1000)")
    got = O.mark_duplicates(one.crossJoin(copies))
    assert [r["qname"] for r in got.where("NOT dup").collect()] == ["c0003"] and got.count() == 1000
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()

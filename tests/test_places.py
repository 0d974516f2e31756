"""Places in coordinate order of all reads."""

from helixframe.operators import reads as O
from helixframe.plans import read_queries as Q
from helixframe.plans import registry


def test_every_read_has_its_place_and_unmapped_reads_come_last(spark, sf):
    reads = Q.reads(spark, sf)
    index = {r["sn"]: r["idx"] for r in Q.dictionary(spark).collect()}
    want = sorted((r["unmapped"], index.get(r["rname"], 99), r["pos"], r["qname"], r["read_no"]) for r in reads.collect())
    got = sorted(registry.QUERIES["coordinate_places"](spark, sf).collect(), key=lambda r: r["place"])
    assert len(want) > 1000 and [r["place"] for r in got] == list(range(1, len(want) + 1))
    assert [(r["qname"], r["read_no"]) for r in got] == [w[3:] for w in want]
    assert O.coordinate_places(reads.where("false"), Q.dictionary(spark)).count() == 0

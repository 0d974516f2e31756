"""Mates: records are dealt out by name once, and names of very many records are ranked and joined over the cluster."""

import random

import pytest
from test_keys_and_intervals import SKEWED, plan_of, settings

from helixframe.operators import reads as O
from helixframe.plans import read_queries as Q
from helixframe.plans.fixtures import ODD_READS, load
from helixframe.sources import shared

COLUMNS = "qname string, read_no int, paired boolean, unmapped boolean, mate_unmapped boolean, neg boolean, mate_neg boolean, not_primary boolean, supplementary boolean, rname string, pos long, cigar string, rnext string, pnext long, tlen long, seq string, qual string"


def some(n, names):
    """Reads of which many agree in all but their bases or qualities; each has a tlen of its own."""
    rng = random.Random(3)
    text = lambda letters: "".join(rng.choice(letters) for _ in range(2))
    return [
        (rng.choice(names), rng.choice((1, 1, 2, 2, 0)), rng.random() < 0.95, rng.random() < 0.1, False, rng.random() < 0.5, False, rng.random() < 0.1, rng.random() < 0.1, "c", rng.randrange(4), "4M", "*", 0, 1000 + k, text("AC"), text("I5"))
        for k in range(n)
    ]


def fixed_plainly(rows):
    """(qname, read_no, seq, qual, pos, rnext, pnext, tlen) by the rule, one name after the other."""
    primary = {}
    for r in rows:
        if r[0] not in (None, "*") and r[2] and r[1] in (1, 2) and not r[7] and not r[8]:
            primary.setdefault((r[0], r[1]), []).append(r)
    order = lambda r: (r[9], r[10], r[5], r[11], r[3], r[15], r[16])
    for rs in primary.values():
        rs.sort(key=order)
    out = []
    for r in rows:
        own, mates = primary.get((r[0], r[1]), []), primary.get((r[0], 3 - r[1]), [])
        of_pair = r[0] not in (None, "*") and r[2] and r[1] in (1, 2)
        at = 0 if r[7] or r[8] else next((k for k, o in enumerate(own) if o is r), 0)
        if not of_pair or at >= len(mates):
            out.append((r[0], r[1], r[15], r[16], r[10], r[12], r[13], r[14]))
            continue
        m = mates[at]
        span = abs(r[10] - m[10]) + 4
        left = r[10] < m[10] or (r[10] == m[10] and r[1] == 1)
        out.append((r[0], r[1], r[15], r[16], r[10], m[9], m[10], 0 if r[3] or m[3] else span if left else -span))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("qname", "read_no", "seq", "qual", "pos", "rnext", "pnext", "tlen").collect()), key=repr)


def distinct(rows):
    """Without reads that agree in all that the order asks for: which of them comes first is open."""
    return list({(r[0], r[1], *r[5:12], r[3], r[15], r[16]): r for r in rows}.values())


@pytest.mark.parametrize("crowded, broadcast", [(10_000, 32 << 20), (10_000, 0), (12, 32 << 20), (1, 0)])
def test_mates_are_those_of_the_rule_whatever_a_name_has(spark, monkeypatch, crowded, broadcast):
    rows = distinct(some(700, ["*", None, "a", "b", *[f"r{k}" for k in range(40)]]) + some(300, ["hot"]))
    monkeypatch.setattr(O, "CROWDED", crowded)
    monkeypatch.setattr(shared.is_small, "__defaults__", (broadcast,))
    assert found(O.fix_mate_information(spark.createDataFrame(rows, COLUMNS).repartition(5))) == fixed_plainly(rows)
    assert O.fix_mate_information(spark.createDataFrame([], COLUMNS)).count() == 0


@pytest.mark.parametrize("odd", [False, True])
def test_records_are_dealt_out_by_name_once(spark, sf, monkeypatch, odd):
    monkeypatch.setattr(O, "TASK_RECORDS", 1000)
    query = Q.QUERIES["fix_mate_information_odd" if odd else "fix_mate_information"]
    with settings(spark, SKEWED):
        plan = plan_of(query(spark, sf)).split("== Initial Plan ==")[0]
        rows = load(spark, sf, ODD_READS).count() if odd else Q.reads(spark, sf).count()
        assert query(spark, sf).count() == rows
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    assert "md5" not in plan  # neither bases nor qualities: the reads here have them from md5

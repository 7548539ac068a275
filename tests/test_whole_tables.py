"""Queries over whole tables against brute force."""

import os

import duckdb
import pytest

from vistaloom.plans import queries
from vistaloom.plans.registry import with_lifts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows(sql):
    return duckdb.sql(with_lifts(sql, lambda t: f"'{SF}/{t}.parquet'")).fetchall()


def got(spark, name, *columns):
    return sorted((tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SF).collect()), key=repr)


def test_erosion_of_every_order(spark):
    want = []
    for key, customer in rows("select o_orderkey, o_custkey from {orders}"):
        w, h = 3 + key % 28, 4 + customer % 25
        want.append((key, (w - 10) * (h - 10) if w > 10 and h > 10 else w * h))
    assert got(spark, "f15_seed_erosion", "frame", "area") == sorted(want, key=repr)


def test_lookup_in_every_scene(spark):
    clean = [(f, r, i, o.strip(), c.strip() or o.strip()) for f, r, i, o, c in rows("select frame, run, item, obj, canon from l_items") if o.strip()]
    named = {}
    for f, _, _, o, c in sorted(clean):
        named[f % 20, o.lower()] = c.lower()
    want = [(f, r, i, named[f % 20, o.lower()]) for f, r, i, o, _ in clean]
    assert got(spark, "j12_canonical_lookup", "frame", "run", "item", "canonical") == sorted(want, key=repr)


def test_every_answer_is_parsed(spark):
    want = []
    for (f,) in rows("select frame from l_json"):
        found = {0: [("chair", "Chair"), (f"t{f}", None)], 1: [(" lamp ", "")], 2: [("a[1]", "b")], 5: [('q"]', None)]}
        want += [(f, k, *x) for k, x in enumerate(found.get(f % 7, []))]
    assert got(spark, "f23_label_parse", "frame", "n", "object", "canonical") == sorted(want, key=repr)

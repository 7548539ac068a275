"""Every query against its SQL on the smallest tables, and its name in the registry once."""

import fnmatch
import math
import os

import duckdb
import pytest

from vistaloom.plans import queries
from vistaloom.plans.registry import TABLES, needed, with_lifts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
SOME = ["select_pairs", "j1_*", "p7_*", "w1_*", "w4_*", "w5_*", "w6_*", "w7_*", "w9_*", "w11_*", "w16_*", "a5_*", "a6_*", "a9_*", "a13_*", "j9_*", "j4_*", "f10_*", "f20_*", "g?_*", "k2_*", "x2_*", "x23_*", "p11_*", "s11_*"]
NAMES = [n for n in queries.QUERIES if any(fnmatch.fnmatch(n, p) for p in SOME)]


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in answer.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall()), key=repr)
    assert sorted(names) == columns and got == want


def test_lifts_nest():
    assert needed("select * from l_frames") == ["l_seen", "l_all", "l_frames"]
    assert with_lifts("with recursive a as (select 1) select * from a, l_labels", str).startswith("with recursive l_labels as (")

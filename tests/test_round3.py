"""Findings of the third round: what is shuffled, and what is worked out once for many pairs."""

import os

import numpy as np
import pytest
from test_round2 import SF, against_sql, plan, shared  # noqa: F401

from vistaloom.operators import pairs, visibility
from vistaloom.plans.lifts import pixels_of_residue
from vistaloom.plans.registry import Tables

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def dealt(spark, name):
    """What a query deals to its tasks by scene: the projection below its last exchange."""
    return plan(spark, name).split("RepartitionByExpression", 1)[1].splitlines()[1]


def test_frames_are_dealt_before_they_have_poses(spark):
    assert "array(" not in dealt(spark, "f8_reproject")


def test_traced_pairs_are_never_joined(spark):
    got, want = against_sql(spark, "x23_pair_trace")
    assert want and got == want and "Join" not in plan(spark, "x23_pair_trace")
    assert len({r[2] for r in got}) == len(pairs.REASONS)


def test_spread_out_places():
    places = np.random.default_rng(7).uniform(-1.5, 1.5, (1500, 6)).round(1)
    kept = []
    for p in places.tolist():
        if all(np.sqrt(sum((a - b) ** 2 for a, b in zip(p, q, strict=True))) >= 1.2 for q in kept):
            kept.append(p)
    got = pairs.spread_out(places, 1.2)
    assert 1 < len(kept) < len(places) and places[got].tolist() == kept
    assert pairs.spread_out(places[:0], 1.2).tolist() == []


def test_sets_meet_once_for_all_frames_of_two_places(spark, shared):  # noqa: F811
    got, want = against_sql(spark, "u2_set_algebra", shared)
    assert want and got == want
    told = plan(spark, "u2_set_algebra")
    assert "explode(yaws_b" in told.split("array_intersect", 1)[0]  # worked out below what makes pairs of frames


def test_footprints_follow_from_the_rule_of_pixels(spark, shared):  # noqa: F811
    t = Tables(spark, shared)
    f = t.lift("l_frames").selectExpr("scene_id", "ord", "event_id % 15 residue")
    a, b = (sorted(map(tuple, df.select("scene_id", "ord", "inst_id", "n_px", "n_valid").collect())) for df in (visibility.footprints(t.lift("l_px")), visibility.footprints_by_rule(f, pixels_of_residue(t), ["residue"])))
    assert a and a == b


def test_frames_with_one_verdict_meet_once(spark, shared):  # noqa: F811
    got, want = against_sql(spark, "p12_filter_pairs", shared)
    assert want and got == want
    told = plan(spark, "p12_filter_pairs")
    assert "explode(each_" in told.split("Join Inner", 1)[0] and "Aggregate" in told.split("Join Inner", 1)[1]

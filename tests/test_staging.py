"""Staged tables: one write, counted users, nothing left behind."""
import os

import pytest

from tessera import staging as G
from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.session import checkpoint_root
from tessera.sources.tables import movies, ratings
from support import SF_SMALL, rows


def scratch(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_scope_removes_what_is_staged_inside(spark):
    df = spark.range(5)
    before = scratch(spark)
    with G.staging(spark):
        kept = G.stage(df, "scope-outer")
        with pytest.raises(ValueError), G.staging(spark):
            assert rows(G.stage(df, "scope-inner")) == rows(df)
            assert len(scratch(spark) - before) == 2
            raise ValueError
        assert rows(kept) == rows(df) and len(scratch(spark) - before) == 1
    assert scratch(spark) == before


def test_shared_tables_are_written_once_and_counted(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(7)

    before = scratch(spark)
    first, second = G.shared(spark, "t:count", build), G.shared(spark, "t:count", build)
    assert len(built) == 1 and G.users(spark, "t:count") == 2 and first.count() == second.count() == 7
    G.release(spark, "t:count")
    assert G.users(spark, "t:count") == 1 and len(scratch(spark) - before) == 1
    G.release(spark, "t:count")
    assert G.users(spark, "t:count") == 0 and scratch(spark) == before
    G.release(spark, "t:count")  # nothing to give back
    for _ in range(3):
        G.shared(spark, "t:count", build)
    G.release(spark, "t:count", everybody=True)
    assert len(built) == 2 and scratch(spark) == before


def test_unseen_predictions_compute_similarity_once_and_leave_nothing(spark, monkeypatch):
    r = ratings(spark, SF_SMALL)
    staged = []
    monkeypatch.setattr(P, "stage", lambda df, name: staged.append(df) or G.stage(df, name))
    before = scratch(spark)
    with G.staging(spark):
        pred = P.predictions(r, S.similarity(r), movies(spark, SF_SMALL), "unseen")
        plan = pred._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [_p" not in plan and pred.count() > 0  # the pairs are in the staged plan alone
    assert len(staged) == 1 and scratch(spark) == before
    pairs = staged[0]._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count("Join Inner, ") == 1


def test_unseen_predictions_need_few_shuffles(spark):
    r = ratings(spark, SF_SMALL)
    with G.staging(spark):
        pred = P.predictions(r, S.similarity(r), movies(spark, SF_SMALL), "unseen")
        pred.collect()
        plan = pred._jdf.queryExecution().executedPlan().toString()
        final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("ShuffleQueryStage") < 16

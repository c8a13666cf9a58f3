"""Intermediate tables have an owner."""

from __future__ import annotations

import os

import pytest

from riskloom.session import materialise, new_path, work_dir, work_scope


def folders(spark):
    return set(os.listdir(work_dir(spark).removeprefix("file:")))


def test_a_scope_deletes_what_was_stored_inside(spark):
    before = materialise(spark.range(3))
    start = folders(spark)
    with work_scope(spark) as made:
        kept, gone = materialise(spark.range(5)), materialise(spark.range(7))
        with work_scope(spark):
            assert materialise(spark.range(2)).count() == 2
        assert len(made) == 2 and len(folders(spark) - start) == 2
        result = gone.count()
        made.pop(0)  # this one is wanted later
        new_path(spark, "never-written")
    assert result == 7 and len(folders(spark) - start) == 1
    assert kept.count() == 5 and before.count() == 3


def test_a_scope_cleans_up_after_an_error(spark):
    start = folders(spark)
    with pytest.raises(RuntimeError), work_scope(spark):
        materialise(spark.range(5))
        raise RuntimeError("stop")
    assert folders(spark) == start
    assert materialise(spark.range(4)).count() == 4  # outside a scope nothing is deleted

"""Intermediate tables of a block are gone after it, and only those."""

import os

import pytest
from panels import store_panel

from larder.plans import backtest as bt
from larder.session import exists, fresh_folder, scratch
from larder.sources.staging import stage

WALK = bt.Walk(folds=2, test_weeks=4, min_train_weeks=10)


def test_tables_of_a_block_are_removed_and_others_stay(spark, tmp_path):
    kept = stage(spark.range(3))
    saved = f"{tmp_path}/folds"
    with scratch(spark) as folder:
        bt.backtest(store_panel(spark), walk=WALK).folds.write.parquet(saved)
        assert len(os.listdir(folder.removeprefix("file:"))) >= 3
    assert not exists(spark, folder)
    assert kept.count() == 3 and spark.read.parquet(saved).count() == 2
    assert "scratch-" not in fresh_folder(spark, "x")


def test_an_error_removes_them_too_and_blocks_nest(spark):
    with pytest.raises(KeyError):
        with scratch(spark) as outer:
            table = stage(spark.range(2))
            with scratch(spark) as inner:
                stage(spark.range(2))
                assert inner.startswith(outer)
            assert not exists(spark, inner) and table.count() == 2
            raise KeyError
    assert not exists(spark, outer)


def test_a_block_without_tables(spark):
    with scratch(spark) as folder:
        pass
    assert not exists(spark, folder)

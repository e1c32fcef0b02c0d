"""Intermediate tables of steps in a row."""

import os
import time
from contextlib import nullcontext

from pyspark.sql import functions as F
from reviewmill import session
from reviewmill.session import materialise, shared_folder, step_tables


def _folders(spark):
    root = f"{shared_folder(spark).removeprefix('file:')}/tables"
    return {name for name in os.listdir(root) if name.startswith("step-")}


def test_tables_of_a_step_go_with_the_next(spark):
    before = _folders(spark) if os.path.isdir(f"{shared_folder(spark).removeprefix('file:')}/tables") else set()
    start = spark.range(10)
    with step_tables(start, first=True):
        one = materialise(start)
    (first,) = _folders(spark) - before
    stored = materialise(one)  # outside a step: stays
    with step_tables(stored):
        two = materialise(stored)
    (second,) = _folders(spark) - before
    assert second != first
    # The next step reads the last one's tables without their being stored elsewhere: they stay.
    with step_tables(two):
        three = materialise(two)
    assert second in _folders(spark) and two.count() == three.count() == 10
    with step_tables(stored, first=True):
        pass
    assert second in _folders(spark) and three.count() == 10


def test_each_step_gives_the_drivers_memory_back(spark, monkeypatch):
    calls = []
    give_back = session._give_back
    monkeypatch.setattr(session, "_give_back", lambda s: calls.append(give_back(s)))
    monkeypatch.setattr(session, "suppress", lambda *_: nullcontext())  # the command is there and is reached
    start = spark.range(3)
    for first in (True, False):
        with step_tables(start, first=first):
            start = materialise(start)
    assert calls == [None, None] and start.count() == 3


def test_stored_table_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(n).getName() for n in range(found.size()))
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    before, setting = files(), session.materialise(spark.range(10)).sparkSession.conf.get(session._CLEANUP)
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert session.materialise(df.join(df.withColumnRenamed("count", "n"), "k")).count() == 10
    fresh = files() - before
    end = time.time() + 10
    while len(fresh & files()) > 1 and time.time() < end:
        time.sleep(0.2)
    # The count of the stored rows is a query of its own, with one shuffle.
    assert len(fresh & files()) <= 1
    assert spark.conf.get(session._CLEANUP) == setting == "false"

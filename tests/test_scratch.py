"""What queries write in the shared folder goes with its release."""

import os

import __spark_entry__ as entry
from tablewright import session
from tablewright.plans import cache

SF = "/root/testdata/sf0.001"
WRITERS = ("orders_year_pruned", "documents_csv_round_trip", "movies_load", "save_clean", "hr_csv_landing")


def _entries(spark):
    folder = session.shared_dir(spark)
    return sorted(e for e in os.listdir(folder) if os.path.isdir(os.path.join(folder, e)))


def test_a_block_deletes_what_its_queries_wrote(spark):
    before = _entries(spark)
    outside = session.scratch_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    for fails in (False, True):
        try:
            with session.scratch(spark):
                for key in WRITERS:
                    assert entry.queries()[key](spark, SF).count() >= 0
                assert len(_entries(spark)) > len(before) + 1
                if fails:
                    raise KeyError("x")
        except KeyError:
            pass
        assert spark.read.parquet(outside).count() == 3
        assert _entries(spark) == sorted([*before, os.path.basename(outside)])


def _tables(spark):
    folder = os.path.join(session.shared_dir(spark), "tables")
    return sorted(os.listdir(folder)) if os.path.exists(folder) else []


def test_release_leaves_nothing_in_the_shared_folder(spark):
    cache.release(spark)
    before = _tables(spark)
    spark.conf.set(cache.MODE_CONF, "table")
    try:
        for key in (*WRITERS, "norm_row_counts"):
            entry.queries()[key](spark, SF).collect()
        assert len(_tables(spark)) > len(before)
        cache.release(spark)
    finally:
        spark.conf.unset(cache.MODE_CONF)
    assert _tables(spark) == before and session._SCRATCH[session.session_id(spark)] == []
    # queries still run afterwards
    assert entry.queries()["norm_row_counts"](spark, SF).count() == 4


def test_files_of_the_executors_stay(spark):
    path = session.scratch_path(spark, "handed")
    session.write_bytes(spark, path, b"x")
    spark.sparkContext.addFile(path)
    session.release_scratch(spark)
    assert os.path.exists(path) and session._SCRATCH[session.session_id(spark)] == [path]
    session._SCRATCH[session.session_id(spark)].clear()

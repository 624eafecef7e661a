"""The shared folder and staged tables."""

import os

from pairwarden import session as s


class FakeSession:
    def __init__(self, **settings):
        known = {f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: known.get(key, default)})()


def test_shared_folder_comes_from_the_session():
    both = FakeSession(checkpoint_dir="hdfs://shared/x/", sql_warehouse_dir="hdfs://warehouse")
    assert s.shared_folder(both) == "hdfs://shared/x"
    assert s.shared_folder(FakeSession(sql_warehouse_dir="hdfs://warehouse/")) == "hdfs://warehouse"


def test_staged_tables_survive_and_can_be_dropped(spark):
    staged = s.stage(spark.range(10), "demo")
    assert staged.count() == 10
    folder = s._application_folder(spark)
    folder = folder.removeprefix("file:")
    assert os.path.isdir(folder)
    s.drop_staged(spark)
    assert not os.path.isdir(folder)


def test_a_scope_drops_what_is_staged_in_it(spark):
    from pathlib import Path

    from pairwarden.session import stage, staged_scope

    with staged_scope(spark):
        outer = stage(spark.range(3), "outer")
        with staged_scope(spark):
            inner, kept = stage(spark.range(3), "inner"), stage(spark.range(3), "kept", outlive=True)
            found = [Path(f.inputFiles()[0].removeprefix("file:")).parent for f in (inner, kept, outer)]
        assert [p.exists() for p in found] == [False, True, True]
        assert kept.count() == 3
    assert not any(p.exists() for p in found)

"""Work folders and their end."""

import os

from hangarflow.session import scratch, staged, work_dir


def local(path):
    return path.removeprefix("file://")


def test_scratch_removes_what_was_staged_inside(spark):
    out = work_dir(spark)
    with scratch(spark) as outer:
        first = staged(spark.range(5))
        with scratch(spark) as inner:
            assert staged(spark.range(3)).count() == 3 and os.path.isdir(local(inner)) and inner.startswith(outer)
        assert not os.path.exists(local(inner)) and first.count() == 5
        first.write.parquet(out)
    assert not os.path.exists(local(outer)) and spark.read.parquet(out).count() == 5
    assert not work_dir(spark).startswith(outer)

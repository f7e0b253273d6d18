"""Runs own the tables written in them: dropped at the end, taken up again after a failure."""

import os
import subprocess
import sys
import textwrap

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from revlens.plans.queries import QUERIES
from revlens.session import Run, drop_table, materialize


def _count(spark, calls, name, fail=False):
    """A table of one step; ``calls`` counts the rows really computed."""
    def seen(batches):
        for b in batches:
            if fail:
                raise ValueError("lost")
            calls.add(b.num_rows)
            yield b
    return materialize(spark.range(10).mapInArrow(seen, "id long"), name)


def _folder(run):
    return run.folder.removeprefix("file:")


def test_nothing_is_left_after_a_query_is_consumed(spark):
    with Run(spark) as run:
        rows = QUERIES["tfidf"](spark, SF_SMALL).count()
        steps = run.manifest()
        assert rows > 0 and len(steps) >= 2 and all(done for _, _, done in steps)
    assert not os.path.exists(_folder(run)) and run.manifest() == []
    with pytest.raises(Exception, match="lost"), Run(spark) as failed:
        _count(spark, spark.sparkContext.accumulator(0), "a")
        _count(spark, spark.sparkContext.accumulator(0), "b", fail=True)
    assert not os.path.exists(_folder(failed))


def test_failed_run_goes_on_where_it_stopped(spark):
    first, again, last = (spark.sparkContext.accumulator(0) for _ in range(3))
    with pytest.raises(Exception, match="lost"), Run(spark, "resumed") as run:
        drop_table(_count(spark, first, "a"))  # kept for the rerun
        _count(spark, first, "b", fail=True)
    assert [(s, done) for s, _, done in run.manifest()][:1] == [("00000-a", True)]
    assert not any(done for s, _, done in run.manifest() if s != "00000-a")
    with Run(spark, "resumed") as run:
        a, b = _count(spark, again, "a"), _count(spark, last, "b")
        assert sorted(r.id for r in a.union(b).collect()) == sorted([*range(10)] * 2)
    assert (first.value, again.value, last.value) == (10, 0, 10)
    assert not os.path.exists(_folder(run))


def test_a_changed_step_and_all_after_it_are_written_anew(spark):
    calls = spark.sparkContext.accumulator(0)
    with pytest.raises(RuntimeError), Run(spark, "changed") as run:
        materialize(spark.range(3), "a")
        _count(spark, calls, "b")
        raise RuntimeError
    with Run(spark, "changed"):
        a = materialize(spark.range(5).select(F.col("id").alias("k")), "a")
        _count(spark, calls, "b")
        assert a.count() == 5
    assert calls.value == 20
    with pytest.raises(ValueError, match="name"):
        Run(spark, "../else")


def test_killed_driver_leaves_a_run_that_resumes(tmp_dir):
    """Two applications with the same shared folder; the first one dies between two steps."""
    code = textwrap.dedent(f"""
        import os, sys
        from pyspark.sql import functions as F
        from revlens.session import Run, build_session, materialize
        spark = build_session("local[2]", extra={{"spark.checkpoint.dir": {tmp_dir!r}, "spark.driver.memory": "1g"}})
        with Run(spark, "killed") as run:
            a = materialize(spark.range(4).select("id", F.lit(sys.argv[1]).alias("by")), "a")
            if sys.argv[1] == "one":
                os._exit(9)
            b = materialize(a.groupBy("by").count(), "b")
            print("rows", [tuple(r) for r in b.collect()])
    """)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root}
    runs = [subprocess.run([sys.executable, "-c", code, who], env=env, capture_output=True, text=True, timeout=180)
            for who in ("one", "two")]
    assert runs[0].returncode == 9 and runs[1].returncode == 0, runs[1].stderr
    assert "rows [('one', 4)]" in runs[1].stdout
    assert not [f for f in os.listdir(tmp_dir) if f.startswith("revlens-run")]

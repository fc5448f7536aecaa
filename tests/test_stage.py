"""Stage tables: nested stages do not block each other, other errors are not hidden."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT, SF001
from voltframe.plans.stage import input_version, staged
from voltframe.session import cut_lineage, ensure_checkpoint_dir, release_tables


def test_merged_query_first_in_a_fresh_process():
    code = ("from voltframe.session import local_session; import __spark_entry__ as e; s = local_session(cores=4);"
            f"print('rows', e.queries()['pair_data'](s, {SF001!r}).count())")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert "rows" in out.stdout, out.stderr[-2000:]


def test_nested_stage_builds(spark):
    inner = staged(spark, "t_inner", lambda: spark.range(3).toDF("x"))
    assert staged(spark, "t_outer", lambda: inner.selectExpr("x + 1 AS y")).count() == 3
    assert staged(spark, "t_outer", lambda: 1 / 0).count() == 3     # written before: not rebuilt


def test_input_version_follows_the_files(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a"))
    v1 = input_version(spark.read.parquet(str(tmp_path / "a")))
    spark.range(6).write.mode("overwrite").parquet(str(tmp_path / "a"))
    assert input_version(spark.read.parquet(str(tmp_path / "a"))) != v1


def test_checkpoint_folder_is_never_guessed(spark, monkeypatch):
    import voltframe.session as ses
    monkeypatch.setattr(ses, "checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(spark)


def test_release_tables(spark):
    df = cut_lineage(spark.range(4), "t")
    assert df.count() == 4
    assert release_tables(spark) >= 1

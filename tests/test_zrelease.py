"""Runs last: the application's work folder goes, the shared folder stays."""

import os

from checks import fixture as fx
from txnlake.session import release, shared_dir, work_path


def test_release(spark, sf_dir):
    fx.table(spark, sf_dir, "silver")
    path = work_path(spark, "x")
    spark.range(1).write.parquet(path)
    release(spark)
    assert not os.path.exists(path)
    assert os.path.isdir(shared_dir(spark))
    assert fx.table(spark, sf_dir, "silver").count() > 0

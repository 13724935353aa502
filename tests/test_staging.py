"""Scratch folders: where they lie, and that a job can clear its own."""

from __future__ import annotations

import os

import pytest

from cadastra.sources import staging


class Conf:
    def __init__(self, **values):
        self.conf = {k.replace("_", "."): v for k, v in values.items()}


def test_a_cluster_needs_a_shared_folder(spark):
    for master in ("local-cluster[3,2,1000]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError, match="share"):
            staging.scratch_root(Conf(spark_master=master))
    assert staging.scratch_root(Conf(spark_master="local[4]"))
    shared = Conf(spark_master="yarn")
    shared.conf["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert staging.scratch_root(shared) == "hdfs://x/y"


def test_a_job_clears_its_own_folders_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "_made", [])
    monkeypatch.setattr(staging, "scratch_root", lambda _: str(tmp_path))
    (tmp_path / "cadastra-of-another-run").mkdir()
    staged = staging.stage(spark.range(5), "one")
    assert staged.count() == 5
    lasting = staging.fresh_dir(spark, "upsert")
    spark.range(1).write.parquet(lasting)
    never_written = staging.fresh_dir(spark, "two")
    assert staging.discard_scratch(spark) == 1 and not os.path.exists(never_written)
    assert sorted(os.listdir(tmp_path)) == sorted(["cadastra-of-another-run", os.path.basename(lasting)])
    assert staging.discard_scratch(spark) == 0

from types import SimpleNamespace

import pytest

from clonelens.llm.common import shared_dir


def session(conf):
    context = SimpleNamespace(master="spark://m:7077", getConf=lambda: SimpleNamespace(get=lambda k: None))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__), sparkContext=context)


def test_a_cluster_gets_no_machine_local_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session({"spark.sql.warehouse.dir": "file:/opt/warehouse"}))
    assert shared_dir(session({"spark.sql.warehouse.dir": "hdfs://nn/warehouse"})) == "hdfs://nn/warehouse/_checkpoints"
    assert shared_dir(session({"spark.sql.warehouse.dir": "file:/w", "spark.checkpoint.dir": "s3a://b/c/"})) == "s3a://b/c"

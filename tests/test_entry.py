import os
import shutil
import subprocess
import sys
from types import SimpleNamespace

import pytest

from clonelens.operators.checkpoints import checkpoint_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_the_optional_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/clonelens", tmp_path / "clonelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'clone_rank' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_a_broken_subpackage_is_not_hidden(tmp_path):
    shutil.copytree(f"{ROOT}/clonelens", tmp_path / "clonelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert run.returncode and "a_module_that_is_not_there" in run.stderr


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_followed_counts(spark, tmp_path):
    from clonelens.streaming.collapse import current, follow, line_counts

    for k in range(2):
        spark.createDataFrame([("a",), ("b",), ("a",)][: 3 - k], "line string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("line string").parquet(str(tmp_path / "in"))
        follow(line_counts(stream, ["line"]), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert {r.line: r.occurrence for r in current(spark, str(tmp_path / "out"), ["line"]).collect()} == {"a": 3, "b": 2}


@pytest.mark.parametrize("warehouse", ["file:/opt/warehouse", "hdfs://nn/warehouse"])
def test_a_cluster_gets_no_machine_local_folder(warehouse):
    conf = {"spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master="spark://m:7077"))
    if warehouse.startswith("file:"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_folder(session)
    else:
        assert checkpoint_folder(session) == "hdfs://nn/warehouse/_checkpoints"
    conf["spark.checkpoint.dir"] = "s3a://b/c"
    assert checkpoint_folder(session) == "s3a://b/c"

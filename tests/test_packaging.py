"""The package without its optional part, and in another folder."""

import os
import shutil
import subprocess
import sys
import textwrap

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, cwd, **env):
    return subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=cwd, env=os.environ | env, capture_output=True, text=True, timeout=300)


@pytest.mark.parametrize("pipeline", [False, True])
def test_queries_without_the_optional_part(tmp_path, pipeline):
    there = tmp_path / "repo"
    shutil.copytree(ROOT, there, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", *[] if pipeline else ["corpus_pipeline.py"]))
    done = run("import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))", there, PYTHONPATH=str(there))
    assert done.returncode == 0, done.stderr
    names, known = (x.split() for x in done.stdout.splitlines()[-2:])
    assert "macro_f05" in names and "pipeline" not in names and not any(n.startswith("op") for n in names) and set(known) <= set(names)


def test_nothing_else_imports_the_optional_part():
    for folder, _, files in os.walk(os.path.join(ROOT, "kithline")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "llm" not in f.read(), name


def test_workers_get_the_package(tmp_path):
    done = run(
        f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from kithline.packaging import ship
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        ship(spark)
        def run(batches):
            import kithline.schema, pyarrow as pa
            for b in batches:
                yield pa.record_batch({{"path": [kithline.schema.__file__] * b.num_rows}})
        print("PATH", spark.range(1).mapInArrow(run, "path string").first()[0])
        """,
        tmp_path,
        PYTHONPATH="",
    )
    assert "kithline.zip" in done.stdout, done.stderr[-2000:]

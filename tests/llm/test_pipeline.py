from __future__ import annotations

import re
import shutil

import pytest


@pytest.fixture(scope="module")
def stages(spark, data):
    import corpus_pipeline

    docs, out = spark.read.parquet(f"{data}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, data).cache()
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_and_rows(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns and after.count() <= before.count(), name


def test_each_decision_takes_effect(spark, data, stages):
    from barloom.llm import decontam, simhash, toxicity

    by = {name: (before, after) for name, before, after in stages}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = by["toxicity"]
    scores = toxicity.score(before, toxicity.fit(before, spark.read.parquet(f"{data}/labels.parquet")))
    assert ids(after) == ids(scores.where("predicted = 0"))
    before, after = by["simhash_near_dedup"]
    assert ids(after) == {r.component_id for r in simhash.near_duplicates(before).collect()}
    before, after = by["benchmark_decontamination"]
    assert ids(after) == ids(decontam.decontaminate(before, spark.read.parquet(f"{data}/benchmark.parquet")).where("not contaminated"))
    before, after = by["secret_scan"]
    assert ids(after) == ids(before)
    texts = [r.text for r in after.collect()]
    assert not any(re.search(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{12}|token = \"[0-9a-f]{20}", t) for t in texts)
    before, after = by["best_fit_packing"]
    assert ids(after) == ids(before)


def test_run_gives_the_last_stage(spark, data, stages):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, data)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert got.select(key).exceptAll(stages[-1][2].select(key)).isEmpty() and got.count() == stages[-1][2].count()


def test_run_on_an_empty_table(spark, data, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{data}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rest_works_without_this_part(tmp_path):
    """With the folders and the pipeline deleted, the entry still imports and has the other queries."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'bars_daily' in q and not any(k.startswith('op') and k[2:3].isdigit() for k in q) and 'pipeline' not in q; e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    run = lambda *args: subprocess.run([sys.executable, "-m", "pytest", "-q", *args], cwd=copy, capture_output=True, text=True, timeout=600)
    every = run("--collect-only", "tests")
    assert every.returncode == 0 and "error" not in every.stdout.lower(), every.stdout
    done = run("-x", "tests/test_functions.py", "tests/test_queries.py", "-k", "test_functions or test_entry or bars_daily or max_drawdown")
    assert done.returncode == 0, done.stdout

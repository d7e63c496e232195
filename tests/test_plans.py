"""The prompt pipeline end to end, the queries against SQL, and the entry without its optional part."""

from __future__ import annotations

import numbers
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeweave.operators import sampling as P
from lodeweave.plans import corpus
from lodeweave.plans import registry
from lodeweave.sources import readers as R

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]


def test_prompt_pipeline(spark):
    texts = [f"Question number {i} about topic {i * i} and its many details, please answer." for i in range(30)]
    chat = [(i + 1, [("user", t), ("assistant", "yes")]) for i, t in enumerate([*texts, texts[0].upper(), texts[1] + "!", "hi there", "x"])]
    school = [(i + 1, f"How many apples are {i} and {i + 1} apples in {i + 7} baskets?", f"sum\n#### {2 * i + 1}") for i in range(20)]
    tables = {"chat|": spark.createDataFrame(chat, "_seq long, messages array<struct<role: string, content: string>>"), "school|main": spark.createDataFrame(school, "_seq long, question string, answer string")}
    catalog = R.catalog(spark, [{"dataset": "chat", "domain": "roleplay", "cap": 100, "adapter": "smoltalk"}, {"dataset": "school", "config": "main", "domain": "reasoning", "cap": 100, "adapter": "gsm8k"}])
    rows = corpus.judged(corpus.scanned(tables, catalog, P.allocate(catalog, 200)))
    reasons = {r[0]: r.n for r in rows.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons["duplicate_prompt"] == 1 and reasons["near_duplicate"] >= 1 and reasons["prompt_too_short"] == 2
    accepted = rows.filter("reason IS NULL")
    parts = corpus.split(accepted, 30, 6)
    assert parts.count() == 36 and 5 <= parts.filter("part = 'val'").count() <= 7
    report = corpus.report(rows, parts)
    assert sum(r.n for r in report["train"].collect()) + sum(r.n for r in report["val"].collect()) == 36
    assert sum(r.kept for r in report["sources"].collect()) == accepted.count() == rows.count() - sum(n for k, n in reasons.items() if k)


def test_trajectory_harvest(spark):
    dialog = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    table = spark.createDataFrame([(i, dialog) for i in range(5)] + [(9, dialog[:2])], "_seq long, messages array<struct<role: string, content: string>>")
    catalog = R.catalog(spark, [{"dataset": "chat", "domain": "roleplay", "cap": 3, "adapter": "chat"}])
    got = corpus.trajectories({"chat|": table}, catalog, 10)
    assert got.count() == 3 and not got.filter("seed_only").count()
    verdicts = corpus.trajectory_verdicts(got)
    assert {r.reason for r in verdicts.collect()} == {"verify_failed"}  # scaffolds are empty turns


def plain(rows, columns):
    """Rows as sorted texts; numbers alike whatever their types."""

    def value(v):
        if pd.isna(v):
            return ""
        return f"{float(v):.6f}" if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(value, r)) for r in rows[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and plain(got, columns) == plain(want, columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 4


def test_rest_works_without_the_optional_part(tmp_path):
    for name in ("__spark_entry__.py", "lodeweave"):
        subprocess.run(["cp", "-r", str(REPO / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "lodeweave" / "llm")], check=False)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})

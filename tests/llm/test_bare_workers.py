"""Queries on workers that have the libraries but not this package."""

import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, {repo!r})
from skewdex.llm import queries
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", {root!r} + "/shared").config("spark.sql.warehouse.dir", {root!r} + "/warehouse").getOrCreate()
)
def there(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("skewdex") is None, "the worker has the package"
        yield batch
spark.range(1).mapInArrow(there, "id long").collect()
for query in queries.QUERIES:
    if query.__name__.split("_")[0] in {names!r}:
        print(query.__name__, len(query(spark, {root!r}).collect()), flush=True)
"""
NAMES = ("op6", "op9", "op10", "op11", "op12", "op13")


def test_workers_without_the_package(tmp_path):
    texts = [None, "", "one two three", "thehouse thehouse the house", "One two three", "x" * 60 + " " + "seven words " * 9]
    pq.write_table(pa.table({"doc_id": pa.array(range(6), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([0, 1], pa.int64()), "text": ["two", "words of"]}), tmp_path / "benchmark.parquet")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", RUN.format(repo=REPO, root=str(tmp_path), names=NAMES)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    if "the worker has the package" in done.stderr:
        pytest.skip("the package is installed for all")
    assert done.returncode == 0, done.stderr[-3000:]
    found = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert {name.split("_")[0]: int(n) for name, n in found.items()} == {"op6": 6, "op9": 6, "op10": 6, "op11": 3, "op12": 1, "op13": 6}

"""Stored files of which each is small."""

import glob
import os
import time
from threading import Event, Thread

import __spark_entry__
from pyspark.sql import functions as F
from skewdex.operators import tfidf
from skewdex.sources import index_store, staging, texts


def test_small_files_share_a_task(spark, tmp_path):
    for at in range(400):
        (tmp_path / f"{at}.txt").write_bytes(b"a" * (at + 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    try:
        files = texts.read_files(spark, str(tmp_path))
        assert files.select("url", "content").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
        assert sorted(r.n for r in files.selectExpr("length(content) AS n").collect()) == list(range(1, 401))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_written_by_tasks_and_not_in_a_folder_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(texts, "FOLDER_FILES", 50)
    rows = [(f"doc_id={at % 300}.txt", b"\xff" * at) for at in range(1, 401)]
    folders = texts.write_files(spark.createDataFrame(rows, "name string, content binary").repartition(3), str(tmp_path / "x"))
    assert len(folders) == 9 and sorted(folders) == sorted(str(f) for f in (tmp_path / "x").iterdir())
    (tmp_path / "x" / "of-a-failed-run").mkdir()
    (tmp_path / "x" / "of-a-failed-run" / "0.doc_id=7.txt").write_bytes(b"no")
    got = texts.read_files(spark, *folders).selectExpr("regexp_extract(url, '[0-9]+[.](.*)$', 1) AS name", "content", "length").collect()
    assert sorted((r.name, bytes(r.content), r.length) for r in got) == sorted((name, data, len(data)) for name, data in rows)


def test_no_files(spark, tmp_path):
    none = texts.write_files(spark.createDataFrame([], "name string, content binary"), str(tmp_path / "x"))
    assert texts.read_files(spark, *none).collect() == []


def test_the_query_makes_no_folder_for_each_file(spark, tmp_path):
    rows = [(i, f"Title {i}\nking queen cook {'dinner ' * i}", "src1", 100) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    was, root = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/files-*")), spark.conf.get("spark.checkpoint.dir")
    got = __spark_entry__.build_index_files(spark, str(tmp_path)).collect()
    assert {r.ebook_id for r in got} == set(range(300))
    (new,) = set(glob.glob(f"{root}/files-*")) - was
    assert sum(1 for _ in os.walk(f"{new}/texts")) < 30 and sum(len(files) for *_, files in os.walk(f"{new}/texts")) == 300


def left_of(spark, before):
    """What of the shuffles that came after ``before`` is still there a little later."""
    for _ in range(30):
        if not shuffled(spark) - before:
            break
        time.sleep(0.1)
    return shuffled(spark) - before


def test_a_saved_table_leaves_nothing_else(spark, tmp_path):
    """Neither what its builder staged nor what it shuffled."""
    docs = spark.createDataFrame([(i % 3, i, f"king {'queen ' * (i % 5)} word{i}") for i in range(200)], "g int, d int, text string")
    root = spark.conf.get("spark.checkpoint.dir")
    before, tables = shuffled(spark), set(os.listdir(root))
    saved = staging.materialize(spark, str(tmp_path / "saved"), lambda: tfidf.tfidf(docs, ["g"], ["d"], broadcast_rows=10))
    assert not left_of(spark, before) and set(os.listdir(root)) == tables
    index = saved.selectExpr("string(g) AS bookshelf_url", "d AS ebook_id", "concat('t', d) AS ebook_title", "term", "weight")
    index_store.write_index(index, str(tmp_path / "index"))
    assert index_store.read_index(spark, str(tmp_path / "index")).count() == index.count()


def test_threads_delete_only_what_they_staged(spark, tmp_path):
    first, second, kept = Event(), Event(), []

    def waits():
        kept.append(staging.stage(spark.range(3), "three"))
        first.set()
        second.wait(60)
        return kept[0]

    slow = Thread(target=lambda: kept.append(staging.materialize(spark, str(tmp_path / "a"), waits).count()))
    slow.start()
    first.wait(60)
    staging.materialize(spark, str(tmp_path / "b"), lambda: staging.stage(spark.range(2), "two"))
    second.set()
    slow.join(60)
    assert kept[1] == 3 and not os.path.exists(kept[0].inputFiles()[0].removeprefix("file:").removeprefix("//"))


def shuffled(spark):
    """Files of shuffles that lie on the local disks."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {name for name in found.split() if "shuffle_" in name}


def test_what_a_staged_table_took_to_shuffle_is_deleted(spark):
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled(spark)
    was = spark.conf.get(key, None)
    rows = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).count()
    assert len(staging.stage(rows, "counted").collect()) == 1000
    assert not left_of(spark, before) and spark.conf.get(key, None) == was

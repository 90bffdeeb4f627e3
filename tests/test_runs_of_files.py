import os

import pytest
from bilinea.sources import compaction, listing, readers, writers
from pyspark.errors import AnalysisException


def put(root, corpus, name, text, when):
    os.makedirs(f"{root}/{corpus}", exist_ok=True)
    with open(f"{root}/{corpus}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    os.utime(f"{root}/{corpus}/{name}", (when, when))


def pages(spark, table):
    return {(r["corpus"], r["file"]): (r["page_no"], r["html"]) for r in compaction.read_compacted(spark, table).collect()}


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    root, table = f"{tmp_path}/html", f"{tmp_path}/table"
    put(root, "a b", "001.html", "<p>ā</p>\n", 1_000_000)
    put(root, "c", "x.html", "one", 2_000_000)
    assert compaction.compact_pages(spark, root, table) == 2 and compaction.compact_pages(spark, root, table) == 0
    assert pages(spark, table) == {("a b", "001.html"): (1, "<p>ā</p>\n"), ("c", "x.html"): (-1, "one")}
    put(root, "c", "x.html", "two", 2_000_500)  # changed
    put(root, "c", "9.html", "old", 500_000)  # new, and older than all
    put(root, "a b", "note.txt", "no page", 3_000_000)
    assert compaction.pending_files(spark, root, table).count() == 2
    assert compaction.compact_pages(spark, root, table) == 2 and compaction.compact_pages(spark, root, table) == 0
    assert pages(spark, table) == {("a b", "001.html"): (1, "<p>ā</p>\n"), ("c", "x.html"): (-1, "two"), ("c", "9.html"): (9, "old")}
    assert sorted(map(tuple, compaction.read_compacted(spark, table).collect())) == sorted(map(tuple, readers.read_pages(spark, root).collect()))
    os.remove(f"{root}/c/9.html")
    assert compaction.compact_pages(spark, root, table) == 0 and len(pages(spark, table)) == 3


def test_a_run_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    root, table = f"{tmp_path}/html", f"{tmp_path}/table"
    put(root, "c", "1.html", "one", 1_000_000)
    compaction.compact_pages(spark, root, table)
    put(root, "c", "1.html", "two!", 1_000_100)
    before = pages(spark, table)
    writer = type(spark.range(1).write)
    whole = writer.parquet

    def breaks(self, path, *args, **more):
        if "/ledger/" in path:
            raise OSError("lost")
        return whole(self, path, *args, **more)

    monkeypatch.setattr(writer, "parquet", breaks)
    with pytest.raises(OSError):
        compaction.compact_pages(spark, root, table)
    monkeypatch.undo()
    assert pages(spark, table) == before
    assert compaction.compact_pages(spark, root, table) == 1 and pages(spark, table) == {("c", "1.html"): (1, "two!")}


def test_content_is_read_under_a_pushed_filter(spark, tmp_path):
    put(f"{tmp_path}/html", "c", "1.html", "one", 1_000_000)
    found = compaction.files(spark, f"{tmp_path}/html", content=True).where("changed >= timestamp'2020-01-01'")
    assert "GreaterThanOrEqual(modificationTime" in found._jdf.queryExecution().executedPlan().toString()
    slim = compaction.files(spark, f"{tmp_path}/html")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in slim.split("ReadSchema")[1]


def test_tasks_list_what_spark_lists(spark, tmp_path):
    root = f"{tmp_path}/ht ml"
    names = ["1.html", "a b.html", "c+d%41.html", "é.html", "_h.html", "_h=1.html", ".html", ".h.html", "1.html._COPYING_", "n.txt", "x.HTML", "2.html.gz", "file=3.html", "x\ny.html"]
    for corpus in ("c", "corpus=d e", "_f", "é%2F"):
        for k, name in enumerate(names):
            put(root, corpus, name, "p" * k, 1_000_000 + k / 8)
    put(root, "c", "empty.html", "", 1_000_000)
    put(root, "c/deeper", "1.html", "p", 1_000_000)
    put(root, "c/w.html", "part-0", "p", 1_000_000)
    put(root, "c/w.html", "part-1", "pp", 2_000_000)
    put(root, "c/w.html", "_SUCCESS", "p", 1_000_000)
    put(root, "c/w.html", "other", "p", 1_000_000)
    put(root, ".", "top.html", "p", 1_000_000)
    os.symlink(f"{root}/c/1.html", f"{root}/c/link.html")
    os.symlink(f"{root}/c/none.html", f"{root}/c/dangling.html")
    for corpus in ("*", "c", "{c,_f}", "[a-c]*", "corpus=d ?"):
        found = listing.list_files(spark, root, corpus, r"\.html")
        want = compaction.files(spark, root, corpus)
        assert found.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and want.count() >= 6
    assert compaction.compact_pages(spark, root, f"{tmp_path}/table") == compaction.files(spark, root).count()


def test_compacting_lists_and_reads_in_tasks(spark, tmp_path, monkeypatch):
    root, table = f"{tmp_path}/html", f"{tmp_path}/table"
    rows = spark.range(30).selectExpr("concat('c ', id % 3) AS corpus", "concat(id, '.html') AS file", "repeat('é', 300000) AS html")  # several batches
    writers.export_chunks(rows, root, "html")

    def driver_lists(*args, **more):
        raise AssertionError("Spark lists files for the driver")

    monkeypatch.setattr(compaction, "files", driver_lists)
    monkeypatch.setattr(readers, "files_below", driver_lists)
    monkeypatch.setattr(compaction, "files_below", driver_lists)
    assert compaction.compact_pages(spark, root, table, "corpus=c 1") == 10
    assert compaction.compact_pages(spark, root, table) == 20 and compaction.compact_pages(spark, root, table) == 0
    assert pages(spark, table) == {(f"c {k % 3}", f"{k}.html"): (k, "é" * 300000 + "\n") for k in range(30)}


def test_bytes_that_are_no_text_stay(spark, tmp_path):
    root, table = f"{tmp_path}/html", f"{tmp_path}/table"
    os.makedirs(f"{root}/c")
    with open(f"{root}/c/1.html", "wb") as f:
        f.write(b"a\xff\x00b")
    assert compaction.compact_pages(spark, root, table) == 1
    assert bytes(compaction.read_compacted(spark, table).selectExpr("cast(html AS binary) AS b").first()["b"]) == b"a\xff\x00b"


def test_stores_that_tasks_do_not_reach_are_listed_by_spark(spark, tmp_path, monkeypatch):
    root, table = f"{tmp_path}/html", f"{tmp_path}/table"
    assert listing.store_of(spark, root).local == root
    put(root, "c", "1.html", "one", 1_000_000)
    assert compaction.compact_pages(spark, root, table) == 1
    monkeypatch.setattr(listing, "store_of", lambda *args: None)
    assert compaction.compact_pages(spark, root, table) == 0  # both ways write the same ledger
    put(root, "c", "1.html", "two", 1_000_001)
    put(root, "d", "2.html", "more", 500_000)
    assert compaction.pending_files(spark, root, table).count() == 2 and compaction.compact_pages(spark, root, table) == 2
    monkeypatch.undo()
    assert compaction.compact_pages(spark, root, table) == 0 and pages(spark, table) == {("c", "1.html"): (1, "two"), ("d", "2.html"): (2, "more")}


def test_a_folder_that_is_not_there_is_an_error(spark, tmp_path):
    put(f"{tmp_path}/html", "c", "1.html", "one", 1_000_000)
    for root, corpus in ((f"{tmp_path}/none", "*"), (f"{tmp_path}/html", "d*")):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            compaction.compact_pages(spark, root, f"{tmp_path}/table", corpus)


def test_runs_of_a_map_count_once_committed(spark, tmp_path):
    path = f"{tmp_path}/map"
    rows = lambda *r: spark.createDataFrame(list(r), "corpus string, html string, para_start int, para_end int, pos long")
    assert readers.committed_runs(spark, path) == [] and readers.read_runs(spark, path).count() == 0
    assert writers.write_run(rows(("a", "1.html", 1, 4, 0), ("a", "2.html", 5, 6, 1), ("b", "1.html", 1, 1, 0)), path, "monday")
    half = rows(("a", "2.html", 9, 9, 1), ("a", "3.html", 7, 7, 2))
    writers.write_para_map_rows(half, f"{path}/run=tuesday", "html", "overwrite")  # and then the job was lost
    shown = lambda: sorted(tuple(r[c] for c in ("corpus", "html", "para_start", "para_end", "pos")) for r in readers.read_runs(spark, path).collect())
    before = [("a", "1.html", 1, 4, 0), ("a", "2.html", 5, 6, 1), ("b", "1.html", 1, 1, 0)]
    assert shown() == before
    assert writers.write_run(rows(("a", "2.html", 5, 8, 1), ("a", "3.html", 9, 9, 2)), path, "tuesday")
    after = [("a", "1.html", 1, 4, 0), ("a", "2.html", 5, 8, 1), ("a", "3.html", 9, 9, 2), ("b", "1.html", 1, 1, 0)]
    assert shown() == after
    assert not writers.write_run(half, path, "tuesday") and not writers.write_run(half, path, "monday") and shown() == after
    assert readers.committed_runs(spark, path) == ["monday", "tuesday"]


def test_a_map_written_by_tasks_that_end_in_any_order(spark, tmp_path):
    path, setting = f"{tmp_path}/map", "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # as many files as a large map has
    rows = spark.range(400).selectExpr("'c' as corpus", "concat(id, '.html') as html", "id as pos", "cast(id as int) as para_start", "cast(id as int) as para_end")
    ends = 1_000_000
    for run in (rows, rows.where("pos % 3 = 0").selectExpr("corpus", "html", "pos", "para_start", "-1 as para_end")):
        before = set(os.listdir(f"{path}/corpus=c")) if os.path.exists(path) else set()
        writers.write_para_map(run, path)
        new = sorted(n for n in set(os.listdir(f"{path}/corpus=c")) - before if n.endswith(".json"))
        for k, name in enumerate(reversed(new)):  # the first part ends last
            os.utime(f"{path}/corpus=c/{name}", (ends + k, ends + k))
        ends += 1_000
    spark.conf.unset(setting)
    assert len(new) > 1
    found = sorted((r["pos"], r["html"], r["para_end"]) for r in readers.read_para_map(spark, path, files="*.json").collect())
    assert found == [(k, f"{k}.html", -1 if k % 3 == 0 else k) for k in range(400)]


def test_exported_texts_are_a_file_each(spark, tmp_path):
    root = f"{tmp_path}/out"
    rows = [("a b", "1.html", "one\ntwo"), ("a b", "_2.html", ""), ("c%/", "x:3.html", "ā"), ("c%/", "..html", None)]
    writers.export_chunks(spark.createDataFrame(rows, "corpus string, file string, html string"), root, "html")
    found = {os.path.relpath(os.path.join(d, f), root) for d, _, files in os.walk(root) for f in files if not f.startswith(".")}
    assert found == {"corpus=a b/file=1.html", "corpus=a b/file=_2.html", "corpus=c%25%2F/file=x%3A3.html", "corpus=c%25%2F/file=..html"}
    more = [("a b", "1.html", "new"), ("d", "4.html", "four")]
    writers.export_chunks(spark.createDataFrame(more, "corpus string, file string, html string"), root, "html", keep=True)
    got = {(r["corpus"], r["file"]): r["html"] for r in readers.read_pages(spark, root).collect()}
    assert got[("a b", "1.html")] == "new\n" and got[("d", "4.html")] == "four\n" and got[("a b", "_2.html")] == "\n" and len(got) == 5
    writers.export_chunks(spark.createDataFrame(more, "corpus string, file string, html string"), root, "html")
    assert readers.read_pages(spark, root).count() == 2


def test_listing_pages_takes_few_tasks(spark, tmp_path):
    root = f"{tmp_path}/out"
    rows = spark.range(300).selectExpr("'c' AS corpus", "concat(id, '.html') AS file", "'p' AS html")
    rows.write.partitionBy("corpus", "file").text(root)  # folders, as Spark writes them
    put(root, "c/deeper", "1.html", "no page", 1_000_000)
    spark.sparkContext.setJobGroup("listing", "")
    pages_ = readers.read_pages(spark, root)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert all(tracker.getStageInfo(s).numTasks <= 16 for s in stages) and pages_.count() == 300

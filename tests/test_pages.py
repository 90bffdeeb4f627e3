import random
from itertools import groupby

import pytest
from bilinea.functions import schemas
from bilinea.operators import pages
from bilinea.sources import readers, writers
from pyspark.sql import functions as F

KEY = ["corpus", "file"]
PAGE = """﻿<html><div id="south"><span id="note1">
 first </span><SPAN ID="note2"></SPAN><span id="note1">second</span></div>
<div id="center"><div>甲&amp;乙<br>丙<a onmouseover="note(this,5)">丁</a><a onMouseover="note( this,6)">x</a>
<a onmouseover="local(this , 2 )">戊</a><a onmouseover="local(this,9)">己</a><a onmouseover="note(this,7);local(this,2)">庚</a></div></div>
<p>out</p><div id="center">again<a onmouseover="note(this,5)">lost</div></html>"""


def one(spark, html):
    return spark.createDataFrame([("c", "01.html", html)], "corpus string, file string, html string")


def test_segments_and_markers(spark):
    page = one(spark, PAGE)
    glossary = spark.createDataFrame([(5, "dhamma"), (7, "  ")], "id int, pali_word string")
    notes = pages.extract_local_notes(page)
    assert {(r["note_id"], r["text"]) for r in notes.collect()} == {(1, "second"), (2, "")}
    shown = pages.resolve_local_notes(pages.resolve_glossary(pages.extract_segments(page, "center"), glossary), notes)
    got = pages.assemble_text(shown).collect()
    assert len(got) == 1 and (got[0]["notes"], got[0]["locals"]) == (1, 1)
    assert got[0]["text"] == "甲&乙\n丙[[dhamma#丁]]x\n{{note|trigger=戊|text=}}己庚again"


def test_void_tags_count_only_when_strict(spark):
    html = '<div id="east">a<br>b<img src="x"></div>c<div id="other">d</div></p></p>e'
    text = lambda strict: pages.extract_section(one(spark, html), "east", strict).first()["text"]
    assert text(False) == "a\nb"
    assert text(True) == "a\nbcde"[: len(text(True))] and text(True).startswith("a\nbc")


def test_null_and_blank_pages(spark):
    rows = [("c", "1", None), ("c", "2", ""), ("c", "3", '<div id="east"> 　 </div>'), ("c", "4", "<div>no section</div>")]
    page = spark.createDataFrame(rows, "corpus string, file string, html string")
    assert pages.extract_section(page, "east").count() == 0




def test_manifest(spark):
    config = spark.createDataFrame([("a", "u/{n}-{n_raw}", 1, 2), ("b", "v/{n}", 1, 0), ("z", "w/{n}", 1, 4)], schemas.CORPUS_CONFIG)
    got = {(r["corpus"], r["n"]): (r["url"], r["file"]) for r in pages.url_manifest(config, 9, 10).collect()}
    assert got[("a", 9)] == ("u/09-9", "09.html") and got[("b", 9)] == ("v/9", "9.html") and got[("z", 10)] == ("w/0010", "0010.html")
    assert pages.url_manifest(config, 10000, 10000).where("corpus = 'z'").first()["file"] == "10000.html"
    assert pages.url_manifest(config, 3, 2).count() == 0


@pytest.mark.parametrize(("start", "end", "kept"), [(None, None, "abc 01_2 007 1 5"), (5, None, "01_2 007 5"), (None, 7, "007 1 5"), (0, 6, "1 5")])
def test_page_number_filter(spark, start, end, kept):
    rows = spark.createDataFrame([(f"{s}.html",) for s in ("abc", "01_2", "007", "1", "5")], "file string")
    assert {r["file"] for r in pages.filter_by_page_number(rows, start, end).collect()} == {f"{s}.html" for s in kept.split()}


def test_retargeting(spark):
    rows = spark.createDataFrame([("001.html", 1, 2), ("a.b.html", 3, 4), ("bare", 5, 6), (".hidden", 7, 8)], "html string, para_start int, para_end int")
    assert [r["text"] for r in pages.retarget_para_map(rows).collect()] == ["001.txt", "a.b.txt", "bare.txt", ".hidden.txt"]


def test_readers_and_writers(spark, tmp_path):
    root = tmp_path / "html"
    for name, html in (("c/2.html", PAGE), ("c/10.html", "x"), ("c c/a.html", "y")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(html, encoding="utf-8")
    (root / "c/para_map.jsonl").write_text('{"html":"2.html","para_start":1,"para_end":3}\n\n{"html":"10.html","para_start":4,"para_end":5}\n{"html":"2.html","para_start":1,"para_end":2}\n')
    (root / "c/meta.json").write_text('{\n"corpus": "c", "book_id": 7, "chapter_start": 1, "chapter_end": 2,\n"n_digits": 0, "para_start": 0, "para_end": 0}')
    got = {(r["corpus"], r["file"], r["page_no"]) for r in readers.read_pages(spark, str(root)).collect()}
    assert got == {("c", "2.html", 2), ("c", "10.html", 10), ("c c", "a.html", -1)}
    assert readers.read_pages(spark, str(root), "c").where("file = '2.html'").first()["html"] == PAGE
    para_map = readers.read_para_map(spark, str(root))
    assert [tuple(r) for r in para_map.orderBy("pos").collect()] == [("c", "2.html", 1, 2, 0), ("c", "10.html", 4, 5, 1)]
    assert pages.pending_pages(readers.read_pages(spark, str(root)), para_map).count() == 1
    meta = readers.read_corpus_meta(spark, str(root), config=spark.createDataFrame([("c", "u", 1, 1), ("d", "u", 9, 3)], schemas.CORPUS_CONFIG))
    assert {(r["corpus"], r["book_id"], r["para_end"]) for r in meta.collect()} == {("c", 7, 0), ("d", 9, None)}
    writers.write_para_map(para_map, f"{tmp_path}/map")
    assert spark.read.json(f"{tmp_path}/map").count() == 2
    chunks = spark.createDataFrame([("c", "1.txt", "甲\n乙"), ("c", "2.txt", " \n")], "corpus string, file string, text string")
    writers.export_chunks(chunks, f"{tmp_path}/text")
    writers.write_chunks(chunks, f"{tmp_path}/chunks")
    assert spark.read.parquet(f"{tmp_path}/chunks").count() == 2
    (tmp_path / "chunk/c").mkdir(parents=True)
    for name, text in (("1.txt", "甲\n乙"), ("2.txt", " \n")):
        (tmp_path / "chunk/c" / name).write_text(text)
    assert {(r["file"], r["status"]) for r in readers.read_chunks(spark, f"{tmp_path}/chunk").collect()} == {("1.txt", "ok"), ("2.txt", "blank_text")}
    writers.write_meta(readers.read_corpus_meta(spark, str(root)), f"{tmp_path}/meta")
    assert spark.read.schema(schemas.CORPUS_META).json(f"{tmp_path}/meta").select(F.col("book_id")).first()[0] == 7


def test_plain_pages_are_walked_as_others():
    """Random markup, plain or not, has the segments that the parser finds; plain pages do not need the parser."""
    r = random.Random(5)
    plain = ['<div id="east">', "<div>", "</div>", "<br>", "<br/>", '<a onmouseover="note(this, 7)">', "<a>", "</a>", "text ", "> \n", '<span id="note3">', "</span>", "<p/>", "</br>", '<img id="east">', '<div id="x" id="east">']
    other = ["<script>", "</script>", "&amp;", "<!-- <div id=\"east\"> -->", "<DIV ID=east>", "< ", "<div id=\"e&#97;st\">", "<", "<title>", "</title>", "<textarea>", "<a href=x>", "<?x>", "<noscript>"]
    walked = 0
    for i in range(6000):
        html = "".join(r.choice(plain if i % 2 or r.random() < 0.8 else other) for _ in range(r.randrange(1, 14)))
        for strict in (False, True):
            slow, quick = pages.Section("east", strict), pages.Section("east", strict)
            slow.feed(html)
            if quick.walk_plain(html):
                walked += 1
                joined = lambda s: [(k, n, "".join(t for _, _, t in g)) if k == "text" else x for (k, n), g in groupby(s, lambda x: x[:2]) for g in [list(g)] for x in (g if k != "text" else g[:1])]
                assert joined(quick.segments) == joined(slow.segments), html
    assert walked > 5000

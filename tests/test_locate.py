import random

import pytest
from bilinea.operators import paragraphs
from bilinea.streaming import locate

PAGE = "book int, page_pos long, corpus string, html string, text string"


def books(seed):
    """Pages and paragraphs with gaps, blank pages, a page that does not fit, and a book without paragraphs."""
    r = random.Random(seed)
    pages, source = [(9, 0, "c", "0.html", "nothing here")], []
    for book in (1, 2, 3, 4):
        own = [(book, n, "a" * r.randrange(1, 30)) for n in range(3, 60) if book != 2 or n != 31]
        source += own
        i = k = 0
        while i < len(own):
            n = r.randrange(1, 6)
            text = "".join(t for _, _, t in own[i : i + n])[: -r.randrange(1, 3)] or "a"
            text = "zzz" if (book, k) == (3, 6) else " " if k == 4 else text
            pages.append((book, k, "c", f"{k}.html", text))
            i, k = i + (n if text != " " else 0), k + 1
    return pages, source


@pytest.mark.parametrize("seed, runs, chunk", [(1, 3, 4), (2, 2, 256)])
def test_runs_give_the_map_of_one_batch(spark, tmp_path, seed, runs, chunk):
    pages, source = books(seed)
    rows = spark.createDataFrame(source, "book int, paragraph int, text string")
    cursors = paragraphs.cursor_start(spark.createDataFrame([(4, 7)], "book int, para_end int"), rows)
    whole = spark.createDataFrame(pages, PAGE)
    expected = sorted(map(str, paragraphs.match_pages_to_paragraphs(whole, rows, cursors).collect()))
    r = random.Random(seed)
    cuts = {b: sorted(r.randrange(25) for _ in range(runs - 1)) for b in (1, 2, 3, 4, 9)}
    for k in range(runs):
        some = [p for p in pages if sum(p[1] >= c for c in cuts[p[0]]) == k]
        if some:
            spark.createDataFrame(some, PAGE).write.mode("append").parquet(f"{tmp_path}/pages")
        stream = spark.readStream.schema(PAGE).parquet(f"{tmp_path}/pages")
        query = locate.started(spark, locate.locate_stream(stream, rows, cursors, chunk), f"{tmp_path}/map", f"{tmp_path}/checkpoint")
        query.awaitTermination(300)
        assert not query.isActive
    got = spark.read.schema(paragraphs.RESULT).parquet(f"{tmp_path}/map").collect()
    assert sorted(map(str, got)) == expected and len({r["status"] for r in got}) > 2
    assert spark.conf.get(locate.PROVIDER, None) != locate.ROCKSDB


def test_chunks_hold_paragraphs_from_the_cursor_on(spark):
    rows = spark.createDataFrame([(1, n, f"t{n}") for n in range(10)] + [(1, 4, "another"), (2, 1, None)], "book int, paragraph int, text string")
    cursors = spark.createDataFrame([(1, 3), (2, 1)], "book int, cursor int")
    got = {(r["book"], r["chunk"]): (r["numbers"], r["lengths"]) for r in locate.initial_chunks(rows, cursors, 4).collect()}
    assert got == {(1, 0): ([3], [2]), (1, 1): ([4, 5, 6, 7], [2] * 4), (1, 2): ([8, 9], [2, 2]), (2, 0): ([1], [0])}

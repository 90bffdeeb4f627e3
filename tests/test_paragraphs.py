import random

import numpy as np
from bilinea.functions.text import normalize_head, normalized_start
from bilinea.operators import paragraphs
from pyspark.sql import functions as F


def by_steps(pages, source, cursor):
    """Paragraph by paragraph. source: number -> (length, head)."""
    for place, length, head in pages:
        if cursor not in source:
            yield place, None, None, "exhausted"
            return
        n = min(len(head), len(source[cursor][1]))
        if head[:n] != source[cursor][1][:n]:
            yield place, None, None, "head_mismatch"
            return
        taken, so_far, at = [], 0, cursor
        while at in source and so_far < length:
            taken.append(at)
            so_far += source[at][0]
            at += 1
        if so_far >= length and at in source and abs(so_far - source[at - 1][0] - length) <= abs(so_far - length):
            taken.pop()
        if not taken:
            yield place, None, None, "no_paragraph"
            return
        yield place, taken[0], taken[-1], "ok"
        cursor = taken[-1] + 1


def walked(r, pages, source, cursor, bits):
    """The walk over pages and paragraphs from the cursor on, given in so many bits, cut anywhere."""
    numbers = [n for n in sorted(source) if cursor is not None and n >= cursor]
    walk = paragraphs.Walk(cursor)
    cut = lambda rows: [0, *sorted(r.randrange(len(rows) + 1) for _ in range(bits - 1)), len(rows)]
    p, q = cut(pages), cut(numbers)
    for k in range(bits):
        some = numbers[q[k] : q[k + 1]]
        walk.add(pages[p[k] : p[k + 1]], some, [source[n][0] for n in some], [source[n][1] for n in some])
        yield from walk.steps(k == bits - 1)


def test_walk_matches_single_steps():
    r = random.Random(4)
    for _ in range(5000):
        numbers = sorted(r.sample(range(1, 15), r.randrange(0, 12)))
        source = {n: (r.randrange(0, 9), r.choice(["", "a", "ab", "abc", "x"]) if r.random() < 0.1 else "a") for n in numbers}
        pages = [(i, r.randrange(1, 25), r.choice(["a", "ab", ""])) for i in range(r.randrange(1, 6))]
        cursor = r.choice([*numbers, 1, None])
        expected = list(by_steps(pages, source, cursor))
        assert list(walked(r, pages, source, cursor, 1)) == expected and list(walked(r, pages, source, cursor, 4)) == expected, (pages, source, cursor)


def test_books_with_resume_and_blank_pages(spark):
    source = spark.createDataFrame([(1, 1, "Evaṃ me"), (1, 2, "sutaṃ　x"), (1, 3, "ekaṃ"), (1, 4, "zzz"), (2, 5, "bbb"), (2, 6, "cc")], "book int, paragraph int, text string")
    page = spark.createDataFrame(
        [(1, 0, "c", "1.html", "EVAṂ ME. sutaṃ x"), (1, 1, "c", "2.html", " 　"), (1, 2, "c", "3.html", "ekaṃ"), (1, 3, "c", "4.html", "more"), (2, 0, "d", "1.html", "cc"), (3, 0, "e", "1.html", "no book")],
        "book int, page_pos long, corpus string, html string, text string",
    )
    done = spark.createDataFrame([(2, 5), (2, 3)], "book int, para_end int")
    cursors = paragraphs.cursor_start(done, source)
    assert {tuple(r) for r in cursors.collect()} == {(1, 1), (2, 6)}
    got = {(r["book"], r["html"]): (r["para_start"], r["para_end"], r["status"]) for r in paragraphs.match_pages_to_paragraphs(page, source, cursors).collect()}
    assert got == {(1, "1.html"): (1, 2, "ok"), (1, "3.html"): (3, 3, "ok"), (1, "4.html"): (None, None, "head_mismatch"), (2, "1.html"): (6, 6, "ok"), (3, "1.html"): (None, None, "exhausted")}
    none = spark.createDataFrame([], "book int, page_pos long, corpus string, html string, text string")
    assert paragraphs.match_pages_to_paragraphs(none, source, cursors).count() == 0


def test_a_long_book_is_held_in_bits(spark):
    """Two million paragraphs, in the order of the stream: what the walk holds stays small, and all pages are found."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(60, 400, 2_000_000)
    ends = np.cumsum(rng.integers(1, 90, 60_000))
    ends = ends[ends < len(lengths)]
    before = np.concatenate([[0], np.cumsum(lengths)])
    sizes = np.diff(before[np.concatenate([[0], ends])]) + rng.integers(-20, 20, len(ends))  # the odd characters of a page
    walk, held, found, at = paragraphs.Walk(1), 0, [], 0
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for a in range(0, len(lengths), 10_000):
        b = min(len(lengths), a + 10_000)
        until = int(np.searchsorted(starts, before[b]))
        walk.add([(k, int(sizes[k]), "") for k in range(at, until)], range(a + 1, b + 1), lengths[a:b], [""] * (b - a))
        at = until
        found += list(walk.steps(b == len(lengths)))
        held = max(held, len(walk.numbers) + len(walk.pages))
    assert len(found) == len(ends) and all(s == "ok" for *_, s in found) and held < 20_000
    assert found[0][1] == 1 and all(p[2] + 1 == q[1] for p, q in zip(found, found[1:]))


def test_the_stream_runs_through_arrow_batches(spark):
    """A book of 30,000 paragraphs in batches of 1,000 rows, beside small ones; the same as one after the other."""
    r = random.Random(8)
    source = {b: [(n, r.randrange(0, 60)) for n in range(5, 5 + size)] for b, size in ((1, 30_000), (2, 7), (3, 400))}
    page = {}
    for b, rows in source.items():
        i, k = 0, 0
        while i < len(rows):
            n = r.randrange(1, 40)
            size = max(1, sum(x for _, x in rows[i : i + n]) + r.randrange(-3, 4))
            page[b, k] = size
            i, k = i + n, k + 1
    text = lambda n: "" if n == 0 else "a" * n
    some = spark.createDataFrame([(b, k, "c", f"{k}.html", text(n)) for (b, k), n in page.items()], "book int, page_pos long, corpus string, html string, text string")
    rows = spark.createDataFrame([(b, n, text(x)) for b, own in source.items() for n, x in own], "book int, paragraph int, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    none = spark.createDataFrame([], "book int, para_end int")
    got = sorted((x["book"], x["page_pos"], x["para_start"], x["para_end"], x["status"]) for x in paragraphs.match_pages_to_paragraphs(some, rows, paragraphs.cursor_start(none, rows)).collect())
    expected = []
    for b, own in source.items():
        heads = {n: (x, "a" * min(30, x)) for n, x in own}
        expected += [(b, *step) for step in by_steps([(k, n, "a" * min(30, n)) for (c, k), n in sorted(page.items()) if c == b], heads, 5)]
    assert got == sorted(expected, key=lambda x: x[:2]) and len(got) > 700


def test_pages_meet_their_paragraphs_however_either_side_is_dealt(spark):
    # paragraphs are many more bytes than pages, so adaptive execution would read both in partitions of other sizes
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        source = spark.range(6000).selectExpr("cast(id div 12 as int) as book", "cast(id % 12 + 1 as int) as paragraph", "concat('p', md5(cast(id as string))) as text")
        page = source.where("paragraph % 4 = 1").selectExpr("book", "cast(paragraph as long) as page_pos", "'c' as corpus", "concat(paragraph, '.html') as html", "concat(text, repeat('x', 99)) as text")
        found = paragraphs.match_pages_to_paragraphs(page, source, paragraphs.cursor_start(spark.createDataFrame([], "book int, para_end int"), source))
        rows = sorted((r["book"], r["page_pos"], r["para_start"], r["para_end"], r["status"]) for r in found.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows == [(b, p, p, p + 3, "ok") for b in range(500) for p in (1, 5, 9)]


def test_starts_of_texts(spark):
    """What a text's first characters are without a look at the rest of it."""
    r = random.Random(2)
    signs = [*"abZÉßİΣσ_7 ,.-", "́", "ʰ", "한", "𝔸", "😀", "\n", "ǅ", "①"]
    rows = [(i, "".join(r.choice(signs) for _ in range(r.choice([0, 1, 20, 40, 200])))) for i in range(2000)]
    rows += [(2000, None), (2001, "." * 300_000 + "x" * 40), (2002, "a" * 29 + "Σ"), (2003, "a" * 29 + "Σb"), (2004, "a" * 29 + "Σ b")]
    df = spark.createDataFrame(rows, "i long, t string")
    for n in (1, paragraphs.HEAD):
        same = normalized_start(F.col("t"), n).eqNullSafe(F.substring(normalize_head(F.col("t")), 1, n))
        assert df.where(~same).count() == 0
    long = spark.range(40).select((F.repeat(F.lit("Word, word. "), 100_000)).alias("text"))
    head = paragraphs.measured(long, "text").select("head").distinct().collect()
    assert [tuple(h) for h in head] == [("wordword" * 3 + "wordwo",)]

"""Pages: which to fetch, which are there, their sections, anchors and local notes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.functions.text import is_blank, ordered_join, page_number, strip, with_value, zero_padded

#: Elements that never have an end tag; a fixed list of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start and end of a page range that is left open; fixed values.
FIRST_PAGE, LAST_PAGE = 1, 999999
#: Plain markup: text, or a tag in lower case whose attributes are all quoted, without a reference anywhere.
PLAIN = re.compile(r'([^<&]+)|<([a-z][a-z0-9]*)((?: [a-z]+="[^"<>&]*")*)(/?)>|</([a-z][a-z0-9]*)>')
ATTRIBUTE = re.compile(r' ([a-z]+)="([^"]*)"')
#: Elements whose content is no markup; a fixed list of the HTML standard.
RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())


def url_manifest(config: DataFrame, start: int | Column, end: int | Column) -> DataFrame:
    """corpus, n, url, file: a row for each chapter from start to end. `{n}` in the template is the number with the
    corpus's padding, `{n_raw}` the number itself. No rows where start is beyond end."""
    as_column = lambda x: F.lit(x) if isinstance(x, int) else x
    first, last = as_column(start), as_column(end)
    rows = config.where(first <= last).select("corpus", "url_template", "n_digits", F.explode(F.sequence(first, last)).alias("n"))
    shown = zero_padded(F.col("n"), F.col("n_digits"))
    url = F.replace(F.replace(F.col("url_template"), F.lit("{n}"), shown), F.lit("{n_raw}"), F.col("n").cast("string"))
    return rows.select("corpus", "n", url.alias("url"), F.concat(shown, F.lit(".html")).alias("file"))


def filter_by_page_number(pages: DataFrame, start: int | None = None, end: int | None = None, file: str = "file") -> DataFrame:
    """Pages whose stem is a number in the range; without either bound all pages, numbered or not. 0 leaves a bound open."""
    if start is None and end is None:
        return pages
    return pages.where(page_number(F.col(file)).between(start or FIRST_PAGE, end or LAST_PAGE))


def pending_pages(pages: DataFrame, para_map: DataFrame) -> DataFrame:
    """Pages that the paragraph map has no row for."""
    return pages.join(para_map.select("corpus", F.col("html").alias("file")), ["corpus", "file"], "left_anti")


def missing_sources(wanted: DataFrame, there: DataFrame, keys: list[str] = ("corpus", "file")) -> DataFrame:
    """Rows of wanted whose keys are not among those that are there."""
    return wanted.join(there.select(*keys), list(keys), "left_anti")


class Section(HTMLParser):
    """Walks a page and gathers the segments of the element with an id: ordered (kind, ref_id, text), kind `text`,
    `note` or `local`.

    strict counts each start tag as a level, even of elements that have no end tag, so these make a section run on;
    otherwise they open nothing. A later element with the id opens the section again.
    """

    def __init__(self, target: str, strict: bool) -> None:
        super().__init__()
        self.target, self.strict = target, strict
        self.depth = 0
        self.anchor: tuple[str, int] | None = None
        self.inner: list[str] = []
        self.segments: list[tuple[str, int | None, str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        if not self.depth:
            self.depth = int(given.get("id") == self.target and (self.strict or tag not in VOID))
            return
        if self.strict or tag not in VOID:
            self.depth += 1
        if tag == "br":
            self.segments.append(("text", None, "\n"))
        elif tag == "a" and self.anchor is None:
            self.anchor = anchor_of(given.get("onmouseover") or "")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if self.strict or tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if not self.depth or (tag in VOID and not self.strict):
            return
        if tag == "a" and self.anchor is not None:
            self.segments.append((*self.anchor, "".join(self.inner)))
            self.anchor, self.inner = None, []
        self.depth -= 1

    def handle_data(self, data: str) -> None:
        if not self.depth:
            return
        if self.anchor is None:
            self.segments.append(("text", None, data))
        else:
            self.inner.append(data)


    def walk_plain(self, html: str) -> bool:
        """Walks a page of plain markup, as feed() does, up to where its last section ends. False: it has other markup, and
        what was gathered does not count."""
        at, opened, last = 0, False, html.rfind(self.target)
        while at < len(html):
            m = PLAIN.match(html, at)
            if m is None:
                return False
            data, tag, attrs, closed, end = m.groups()
            at = m.end()
            if data:
                self.handle_data(data)
            elif end:
                self.handle_endtag(end)
            elif tag in RAW:
                return False
            else:
                (self.handle_startendtag if closed else self.handle_starttag)(tag, ATTRIBUTE.findall(attrs))
            opened = opened or self.depth > 0
            if opened and not self.depth and at > last and "&" not in html[at:]:
                break
        return True


def anchor_of(handler: str) -> tuple[str, int] | None:
    """What an anchor's handler calls: note(this, N) or local(this, N), the former first."""
    for kind in ("note", "local"):
        _, call, rest = handler.partition(f"{kind}(this")
        while call:
            number, closed, _ = rest.partition(")")
            number = number.strip()
            if closed and number.startswith(",") and number[1:].strip().isdecimal():
                return kind, int(number[1:])
            _, call, rest = rest.partition(f"{kind}(this")
    return None


def segments_of(html: str, target: str, strict: bool) -> list[tuple[str, int | None, str]]:
    walker = Section(target, strict)
    if not walker.walk_plain(html):
        walker = Section(target, strict)
        walker.feed(html)
    merged: list[tuple[str, int | None, str]] = []
    for kind, ref, text in walker.segments:
        if merged and kind == "text" == merged[-1][0]:
            merged[-1] = ("text", None, merged[-1][2] + text)
        else:
            merged.append((kind, ref, text))
    return merged


def extract_segments(pages: DataFrame, target: str, strict: bool = False, keys: list[str] = ("corpus", "file")) -> DataFrame:
    """keys, pos, kind, ref_id, text: the segments of each page's section, in order. Pages without the section, and null
    pages, have none. A page's walk is a helper on Arrow batches; there is no shuffle."""
    given = pages.select(*keys, "html")
    fields = ", ".join(f"`{k}` {given.schema[k].dataType.simpleString()}" for k in keys)

    kinds = pa.struct([("kind", pa.string()), ("ref_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segments_of(h, target, strict) if h else [] for h in batch.column(len(keys)).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            flat = [segment for s in found for segment in s]
            parts = [pa.array([segment[i] for segment in flat], kinds[i].type) for i in range(3)]
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, fields=list(kinds)))
            yield pa.record_batch([*batch.columns[: len(keys)], listed], names=[*keys, "segments"])

    walked = given.mapInArrow(run, f"{fields}, segments array<struct<kind: string, ref_id: long, text: string>>")
    return walked.select(*keys, F.posexplode("segments").alias("pos", "s")).select(*keys, "pos", "s.kind", "s.ref_id", "s.text")


def extract_section(pages: DataFrame, target: str, strict: bool = False, keys: list[str] = ("corpus", "file")) -> DataFrame:
    """keys, text: the section's text with line breaks for <br>; pages where it is blank are left out."""
    text = extract_segments(pages, target, strict, keys).groupBy(*keys).agg(ordered_join(F.col("pos"), F.col("text")).alias("text"))
    return text.where(~is_blank(F.col("text")))


def extract_local_notes(pages: DataFrame, keys: list[str] = ("corpus", "file")) -> DataFrame:
    """keys, note_id, text: the stripped inside of each <span id="noteN">, up to the first </span>; the last of a number
    counts. Within a page, so nothing is shuffled."""
    pattern = r'(?is)<span\s+id="note([0-9]+)">(.*?)</span>'
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)).alias("n"), F.regexp_extract_all("html", F.lit(pattern), F.lit(2)).alias("t"))
    notes = F.sort_array(F.transform(found, lambda x, i: F.struct(x["n"].cast("long").alias("note_id"), i.alias("i"), strip(x["t"]).alias("text"))))
    # sorted, the last note of a number is the one that no other of the number follows
    last = with_value(notes, lambda n: F.filter(n, lambda x, i: F.coalesce(F.get(n, i + 1)["note_id"] != x["note_id"], F.lit(True))))
    some = pages.where(F.lower("html").contains('id="note'))  # the pattern is tried on no other page
    return some.select(*keys, F.explode(last).alias("n")).select(*keys, "n.note_id", "n.text")


def resolve_glossary(segments: DataFrame, glossary: DataFrame) -> DataFrame:
    """segments with `shown` and `hit`: a note whose id has a word is [[word#text]], any other shows its text. glossary
    (id, pali_word) has one row per id and may be broadcast by its size. If it is not, only notes go by their id: all
    other segments, most of the text, are spread by a hash that no word has."""
    words = glossary.where(~is_blank(F.col("pali_word"))).select(F.lit(True).alias("_note"), F.col("id").cast("long").alias("_id"), strip(F.col("pali_word")).alias("_word"))
    note = F.coalesce((F.col("kind") == "note") & F.col("ref_id").isNotNull(), F.lit(False))
    rest = [c for c in segments.columns if c != "text"]
    keyed = segments.withColumns({"_note": note, "_id": F.when(note, F.col("ref_id").cast("long")).otherwise(F.xxhash64(*rest, F.length("text")))})
    joined = keyed.join(words, ["_note", "_id"], "left")
    hit = F.col("_word").isNotNull()
    shown = F.when(hit, F.concat(F.lit("[["), "_word", F.lit("#"), "text", F.lit("]]"))).otherwise(F.col("text"))
    return joined.select(*segments.columns, shown.alias("shown"), hit.alias("hit"))


def resolve_local_notes(segments: DataFrame, notes: DataFrame, keys: list[str] = ("corpus", "file")) -> DataFrame:
    """segments of resolve_glossary, with the page's own notes put in: a local anchor whose number the page has, even an
    empty note, is {{note|trigger=…|text=…}}. notes have one row per page and number. Segments are joined by page, which
    is how assemble_text groups them, so the text moves once for both."""
    own = notes.groupBy(*keys).agg(F.collect_set(F.struct("note_id", "text")).alias("_notes"))
    note = F.get(F.filter("_notes", lambda n: n["note_id"] == F.col("ref_id")), F.lit(0))["text"]
    joined = segments.join(own, list(keys), "left").withColumn("_note", F.when(F.col("kind") == "local", note))
    hit = F.col("_note").isNotNull()
    marked = F.concat(F.lit("{{note|trigger="), "text", F.lit("|text="), "_note", F.lit("}}"))
    rest = [c for c in segments.columns if c not in ("shown", "hit")]
    return joined.select(*rest, F.when(hit, marked).otherwise(F.col("shown")).alias("shown"), (hit | F.col("hit")).alias("hit"))


def assemble_text(segments: DataFrame, keys: list[str] = ("corpus", "file")) -> DataFrame:
    """keys, text, notes, locals: each page's shown segments in order, and how many anchors of either kind were resolved.
    Blank pages are left out."""
    count = lambda kind: F.count_if(F.col("hit") & (F.col("kind") == kind))
    out = segments.groupBy(*keys).agg(ordered_join(F.col("pos"), F.col("shown")).alias("text"), count("note").alias("notes"), count("local").alias("locals"))
    return out.where(~is_blank(F.col("text")))


def retarget_para_map(para_map: DataFrame) -> DataFrame:
    """The paragraph map with the chapter's text file, under `text`, in place of the page's."""
    rest = [c for c in para_map.columns if c != "html"]
    return para_map.select(F.regexp_replace("html", r"(?s)(?<=.)\.[^.]*$", "").alias("_stem"), *rest).select(F.concat("_stem", F.lit(".txt")).alias("text"), *rest)

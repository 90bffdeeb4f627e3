"""Line-first quality rules: rules judge each line, failing lines go, and a document that loses too much text goes too.

Everything is a Spark expression over one row; no row leaves its task, so the step has no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.functions.text import with_value
from bilinea.llm.common import NOT_SPACE, words

#: A line ends well if its last visible character is one of these.
ENDINGS = ".!?:;,…。！？；：”’»\"')]"
#: So does one that has at most two words after its last sentence end: the fragment does not condemn the sentences.
FRAGMENT = r"[.!?…。！？][\"')\]]*\s+\S+(?:\s+\S+)?\s*$"
#: Three or more separators make a line of menu entries.
SEPARATORS = r"(?:[|»›•·>][^|»›•·>]*){3}"
#: A line that is nothing but one of these, in any case and apart from closing marks, is navigation.
MENU_WORDS = ("home", "menu", "login", "log in", "sign in", "sign up", "next", "previous", "back to top", "skip to content", "read more", "share", "share this", "search", "sitemap", "site map")
#: Phrases of legal and technical boilerplate, in lower case.
BOILERPLATE = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies", "uses cookies", "enable javascript", "lorem ipsum", "click here", "subscribe to our")
#: Boilerplate is looked for in lines of at most so many characters: longer ones are prose that mentions it.
BOILERPLATE_LINE = 250
#: White space that may follow a line's last visible character.
VISIBLE_END = " \t\n\x0b\f\r"
#: Words in removed lines, as a share of all words, above which a document is rejected.
MAX_LOST = 0.5
#: Words in a window that counts as repeated when the text has it twice.
WINDOW = 8


def bad_line(line: Column) -> Column:
    """Whether a line with a word in it fails the punctuation, the navigation or the boilerplate rule."""
    last = F.right(F.rtrim(line, F.lit(VISIBLE_END)), F.lit(1))
    menu = F.lower(F.btrim(line, F.lit(VISIBLE_END + ".!:»>"))).isin(*MENU_WORDS)
    legal = with_value(F.lower(line), lambda low: reduce(or_, [low.contains(p) for p in BOILERPLATE]))
    unended = ~F.lit(ENDINGS).contains(last) & ~line.rlike(FRAGMENT)
    return unended | line.rlike(SEPARATORS) | menu | ((F.length(line) <= BOILERPLATE_LINE) & legal)


def window_hashes(hashes: Column) -> Column:
    """The hash of each window of WINDOW = 8 words: pairs of words, pairs of pairs, and pairs of those."""
    joined = lambda h, k: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + k)))
    eights = with_value(hashes, lambda h1: with_value(joined(h1, 1), lambda h2: with_value(joined(h2, 2), lambda h4: joined(h4, 4))))
    return F.slice(eights, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))


def repeated_words(grams: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more; grams: the hash of each window, by place.

    Sorting puts equal windows side by side. The cost is n log n in the text's words, and only texts that have an equal
    pair at all pay it.
    """

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def twice(pairs: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(pairs, j)["g"] == x["g"], F.lit(False))
        return F.transform(F.filter(pairs, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])

    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    found = with_value(pairs, lambda p: with_value(F.sort_array(twice(p)), covered))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), found).otherwise(0).cast("long")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with struct column `quality`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    lost_words, kept, clean_text.

    Words, lines and windows are those of the whole text; a null or empty text has none and fails the base rules. Equal
    windows are found by 64-bit hash. clean_text is the text without its failing lines (null stays null).
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    out = docs.withColumn("_text", F.col(text_col))
    out = out.withColumn("_words", words(text)).withColumn("_lines", F.split(text, "\n"))
    # each line is judged once: whether it has a word, and whether it fails
    judged = lambda x: F.struct(x.alias("line"), x.rlike(NOT_SPACE).alias("spoken"), (x.rlike(NOT_SPACE) & bad_line(x)).alias("bad"))
    out = out.withColumn("_judged", F.transform("_lines", judged))
    lines = lambda keep: F.transform(F.filter("_judged", keep), lambda x: x["line"])
    out = out.withColumn("_spoken", lines(lambda x: x["spoken"])).withColumn("_bad", lines(lambda x: x["bad"]))
    out = out.withColumn("_grams", with_value(F.transform("_words", lambda w: F.xxhash64(w)), window_hashes))
    n_words = F.size("_words").cast("long")
    out = out.withColumn("_repeats", repeated_words(F.col("_grams")))
    failed = (n_words < 20) | (100 * F.col("_repeats") > 30 * n_words)
    lost = F.when(F.size("_bad") > 0, F.size(words(F.array_join("_bad", "\n")))).otherwise(0).cast("long")
    out = out.withColumn("_lost", lost)
    clean = F.when(F.size("_bad") > 0, F.array_join(lines(lambda x: ~x["bad"]), "\n")).otherwise(F.col("_text"))
    quality = F.struct(
        n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_spoken") - F.size(F.array_distinct("_spoken"))).cast("long").alias("n_dup_lines"),
        F.col("_repeats").alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.col("_lost").alias("lost_words"),
        (~failed & (F.col("_lost") <= MAX_LOST * n_words)).alias("kept"),
        clean.alias("clean_text"),
    )
    return out.withColumn("quality", quality).drop("_text", "_words", "_lines", "_judged", "_spoken", "_bad", "_grams", "_repeats", "_lost")


def filtered(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents that stay, with their columns; the text has lost its failing lines and length_col, if there is
    one, tells its new length in characters."""
    columns = docs.columns
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text_col).alias("text"))
    # not a where: Spark would move that below the measures and take them twice
    out = measure(given).select("row", F.explode(F.filter(F.array("quality"), lambda q: q["kept"])).alias("quality"))
    new = {text_col: F.col("quality.clean_text")} | ({length_col: F.length("quality.clean_text").cast("long")} if length_col in columns else {})
    return out.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col("row")[c].alias(c) for c in columns])

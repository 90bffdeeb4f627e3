"""Column functions on text: white space, words and numbers as the corpus format defines them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points of the 29 white-space characters. Java's own \s lacks most of them.
SPACES = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: The same as text, and as the inside of a character class.
SPACE_CHARS = "".join(map(chr, SPACES))
#: Low ones stand alone, since Java looks these up in a table, and others as ranges, which it tries one by one.
SPACE_CLASS = "".join(f"\\x{{{c:x}}}" for c in SPACES if c < 0x100) + r"\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}"


def without_spaces(text: Column) -> Column:
    """text without any white space."""
    return F.translate(text, SPACE_CHARS, "")


def strip(text: Column) -> Column:
    """text without white space at either end."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def rstrip(text: Column) -> Column:
    """text without white space at its end."""
    return F.rtrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    """Whether text is null or has nothing but white space."""
    return F.coalesce(strip(text) == "", F.lit(True))


def normalize_head(text: Column) -> Column:
    """text in lower case with letters, numbers and underscores alone; white space and combining marks go."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", ""))


def normalized_start(text: Column, characters: int) -> Column:
    """The first so many characters of normalize_head(text). No more of the text is looked at than they need; a capital
    sigma alone asks for all of it, since its small form depends on what follows."""
    start = F.regexp_extract(text, r"^(?:[^\p{L}\p{N}_]*+[\p{L}\p{N}_]){0,%d}+" % characters, 0)
    whole = F.substring(normalize_head(text), 1, characters)
    return F.when(start.contains("Σ"), whole).otherwise(F.substring(normalize_head(start), 1, characters))


def zero_padded(number: Column, digits: Column) -> Column:
    """The decimal number with zeros in front up to so many digits; longer numbers stay whole, 0 digits or fewer pad
    nothing, and a minus sign stays in front."""
    shown = number.cast("string")
    short = F.length(shown) < digits
    padded = F.when(shown.startswith("-"), F.concat(F.lit("-"), F.lpad(F.substring(shown, F.lit(2), F.length(shown)), digits - 1, F.lit("0"))))
    return F.when(short, F.coalesce(padded, F.lpad(shown, digits, F.lit("0")))).otherwise(shown)


def page_number(file_name: Column) -> Column:
    """The number that a file's stem spells, -1 if it spells none. White space around it, a sign and single underscores
    between digits are allowed."""
    stem = strip(F.regexp_replace(file_name, r"(?s)(?<=.)\.[^.]*$", ""))
    digits = F.regexp_replace(stem, r"(?<=[0-9])_(?=[0-9])", "")
    return F.coalesce(F.when(digits.rlike(r"^[+-]?[0-9]+$"), digits.try_cast("long")), F.lit(-1))


def record_id(book: Column, paragraph: Column, word_begin: Column, word_end: Column) -> Column:
    """book-paragraph-word_begin-word_end."""
    return F.concat_ws("-", book, paragraph, word_begin, word_end)


def split_record_id(column: Column) -> Column:
    """A struct of the four numbers of a record id; null where it does not have four."""
    part = F.split(column, "-")
    return F.when(F.size(part) == 4, F.struct(*[F.get(part, F.lit(i)).try_cast("int").alias(name) for i, name in enumerate(("book", "paragraph", "word_begin", "word_end"))]))


def with_value(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def ordered_join(place: Column, text: Column, separator: str = "") -> Column:
    """Aggregate: the texts of a group joined in order of place, nulls left out."""
    # sort_array and a field of an array run at once; array_sort and transform would evaluate an expression for each pair or row
    rows = F.sort_array(F.collect_list(F.struct(place.alias("place"), text.alias("text"))))
    return F.array_join(rows["text"], separator)

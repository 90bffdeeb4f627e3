"""Periodic runs of words, found by block convolution.

A run is a stretch of words that repeats with some period and that no neighbour continues. The words of a text are
numbered, and the text is searched at dyadic scales. At scale B it is cut into blocks of B words. For every block the sum
of squared differences to each place of the window that follows, at distances B to 2B - 1, is computed at once by a number
theoretic transform: sum(b^2) + sum(w^2) - 2 sum(b w), in whole numbers modulo a prime. Where the sum is zero the block
may stand there again. A run of period q that holds four periods or more has a whole block of the scale B <= q < 2B in its
first two periods, and this block stands again q words further, so no run is missed. Each such distance is a seed: its
words are compared, and it is extended both ways as long as words q apart are equal.

Blocks of the same scale, of all texts of a slice, are transformed side by side as the columns of one matrix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, cmp_to_key

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.llm.common import slices, small_batches

#: 11 * 2^21 + 1, a prime: products of two residues, and sums of some of them, are whole numbers in a double.
PRIME = 11 * 2**21 + 1
#: The longest block that is transformed whole; longer ones are convolved piece by piece.
LARGEST = 1 << 20
#: Numbers in a matrix, about: it stays in the cache.
AT_ONCE = 1 << 15
#: Stages of a transform between two reductions of all values: each may double them.
LAZY = 3
#: A run has so many words and so many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4

FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


# Transforms


@cache
def root() -> int:
    """A primitive root of the prime."""
    return next(g for g in range(2, PRIME) if all(pow(g, (PRIME - 1) // f, PRIME) != 1 for f in (2, 11)))


@cache
def powers(half: int, back: bool) -> np.ndarray:
    """The powers of a root of unity of order 2 * half, as a column; back: of its inverse."""
    w = pow(root(), (PRIME - 1) // (2 * half), PRIME)
    w = pow(w, -1, PRIME) if back else w
    out, n = np.ones(half, dtype=np.int64), 1
    while n < half:
        out[n : 2 * n] = out[:n] * pow(w, n, PRIME) % PRIME
        n *= 2
    return out.astype(np.float64)[:, None]


def reduce(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, in place: from 0 to the prime, both included."""
    whole = x * (1 / PRIME)
    np.floor(whole, out=whole)
    whole *= PRIME
    x -= whole
    return x


def forward(x: np.ndarray) -> np.ndarray:
    """The transform of each column, in place, in bit-reversed order."""
    half, stage = len(x) // 2, 0
    while half:
        v = x.reshape(-1, 2, half, x.shape[1])
        a, b = v[:, 0], v[:, 1]
        difference = a - b
        a += b
        difference *= powers(half, False)
        b[...] = reduce(difference)
        half, stage = half // 2, stage + 1
        if stage % LAZY == 0:
            reduce(x)
    return reduce(x)


def backward(x: np.ndarray) -> np.ndarray:
    """The columns whose transforms x holds in bit-reversed order, in place, times their length."""
    half, stage = 1, 0
    while half < len(x):
        v = x.reshape(-1, 2, half, x.shape[1])
        a, b = v[:, 0], v[:, 1]
        turned = reduce(b * powers(half, True))
        np.subtract(a, turned, out=b)
        a += turned
        half, stage = half * 2, stage + 1
        if stage % LAZY == 0:
            reduce(x)
    return reduce(x)


def correlate(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Of columns of B and 2B numbers: row d is the sum over i of blocks[i] * windows[d + i], modulo the prime, d < B."""
    size = len(blocks)
    turned = np.zeros_like(windows)
    turned[:size] = blocks[::-1]
    product = reduce(forward(turned) * forward(windows))
    scale = pow(2 * size, -1, PRIME)
    return reduce(backward(product)[size - 1 : 2 * size - 1] * scale)


# Seeds


def seeds(x: np.ndarray, edges: np.ndarray, size: int, largest: int = LARGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, distance) of all blocks of a scale and distances from size to 2 * size - 1 at which they stand again,
    in order. x: the words' numbers, one text after the other; edges: where each text starts, and the end.

    Sums are known modulo the prime, so a few of the places are none: words are to be compared.
    """
    n = np.diff(edges)
    each = np.where(n >= max(LEAST_WORDS, LEAST_PERIODS * size), n // size - 1, 0)
    text = np.repeat(np.arange(len(n)), each)
    start = edges[text] + size * (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each))
    piece = min(size, largest)
    squares = np.concatenate([[0], np.cumsum(x * x % PRIME)])
    # the squares of the `size` words from each place on, and each place's words; what lies beyond the end is left out below
    sums = np.concatenate([(squares[size:] - squares[:-size]) % PRIME, np.zeros(3 * size)]).astype(np.float64) if len(x) >= size else np.zeros(0)
    values = np.concatenate([x, np.zeros(3 * size)])
    from_here, twice = sliding_window_view(values, piece), sliding_window_view(values, 2 * piece)
    columns, found = max(1, AT_ONCE // (2 * piece)), [(np.zeros(0, np.int64),) * 3]
    steps = np.arange(piece)[:, None]
    for at in range(0, len(start), columns):
        s, end = start[at : at + columns], edges[text[at : at + columns] + 1]
        for shift in range(size, 2 * size, piece):
            products = np.zeros((piece, len(s)))
            for part in range(0, size, piece):
                products += correlate(from_here[s + part].T, twice[s + (part + shift)].T.copy())
            places = steps + (s + shift)
            multiple = (sums[s] + sums[places] - 2 * products) / PRIME
            d, k = np.nonzero(multiple == np.rint(multiple))
            inside = places[d, k] + size <= end[k]
            d, k = d[inside], k[inside]
            found.append((text[at + k], s[k], d + shift))
    text, start, distance = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((start, distance, text))
    return text[order], start[order], distance[order]


def reach(equal_to: np.ndarray, other: np.ndarray, backwards: bool) -> int:
    """How many places from the start (or the end) on are equal."""
    n, done, step = len(equal_to), 0, 64
    while done < n:
        until = min(n, done + step)
        cut = slice(n - until, n - done) if backwards else slice(done, until)
        unlike = np.flatnonzero(equal_to[cut] != other[cut])
        if len(unlike):
            return done + (until - done - 1 - int(unlike[-1]) if backwards else int(unlike[0]))
        done, step = until, step * 2
    return n


def runs(x: np.ndarray, edges: np.ndarray, largest: int = LARGEST) -> list[list[tuple[int, int, int]]]:
    """For each text its runs (start, length, period), by start and then period; starts count from the text's own."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(edges) - 1)]  # (start, end, period) in x
    longest, size = int(np.diff(edges).max(initial=0)), 1
    while longest >= max(LEAST_WORDS, LEAST_PERIODS * size):
        text, start, distance = seeds(x, edges, size, largest)
        # the first block of a run is followed by two more periods at least
        inside = start + 3 * distance <= edges[text + 1]
        text, start, distance = text[inside], start[inside], distance[inside]
        goes_on = (x[start + distance] == x[start + 2 * distance]) & (x[start + 2 * distance - 1] == x[start + 3 * distance - 1])
        text, start, distance = text[goes_on], start[goes_on], distance[goes_on]
        cuts = np.flatnonzero(np.diff(text, prepend=-1, append=len(edges)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            extend(x, int(edges[text[a]]), int(edges[text[a] + 1]), start[a:b], distance[a:b], size, found[text[a]])
        size *= 2
    return [sorted((a - int(first), b - a, q) for a, b, q in own) for own, first in zip(found, edges)]


def extend(x: np.ndarray, first: int, end: int, start: np.ndarray, distance: np.ndarray, size: int, found: list[tuple[int, int, int]]) -> None:
    """Adds the runs that the seeds of a text belong to, by rising distance.

    A seed within a run whose period divides its distance is a repetition of that run, and no run of its own.
    """
    open_ = np.ones(len(start), dtype=bool)
    for a, b, q in found:
        open_ &= ~((start >= a) & (start + size + distance <= b) & (distance % q == 0))
    while open_.any():
        k = int(np.argmax(open_))
        s, d = int(start[k]), int(distance[k])
        right = s + reach(x[s : end - d], x[s + d : end], False)
        if right < s + size:  # the sum was a multiple of the prime, but not zero
            open_[k] = False
            continue
        left = s - reach(x[first:s], x[first + d : s + d], True)
        right += d
        open_ &= ~((start >= left) & (start + size + distance <= right) & (distance == d))
        if right - left >= max(LEAST_WORDS, LEAST_PERIODS * d):
            found.append((left, right, d))


# Texts


def planted(words: list[bytes], digest: int | None) -> list[bytes]:
    """The words with the repetition that a document's number asks for, in one of ten documents; none without a number."""
    n = len(words)
    if digest is None or digest % 10 or not n:
        return words
    g = digest // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, the same for equal ones, and where each text starts."""
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    return np.asarray(flat.indices).astype(np.int64) + 1, edges


def higher(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Orders runs by falling exponent, compared as fractions, then by start and period."""
    x, y = a[1] * b[2], b[1] * a[2]
    return (y > x) - (y < x) or (a > b) - (a < b)


def without_repetitions(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those that stand in a run after its first period."""
    if not found:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = True, collapsed: bool = False, carry: list[Column] = ()) -> DataFrame:
    """One row per document: doc_id, n_runs, the run with the greatest exponent (start, length, period, exponent_milli),
    digests of all runs and of the text without repetitions; with collapsed that text as well, and what is carried.

    plant: documents are changed first as their ids ask for. Words are parted by ASCII white space. Null and empty texts
    have no words and no run; rows with a null id are not changed; repeated rows are told alike; an empty table gives no
    rows. Texts of any length are searched whole, and every run of a text is found.
    """
    small_batches(docs.sparkSession)
    digest = F.crc32(F.col(id_col).cast("string")) if plant else F.lit(None).cast("long")
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), digest.alias("digest"), *carry)
    own = given.select("doc_id").schema.simpleString()[len("struct<") : -1]
    more = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[3:])
    schema = f"{own}, {FIELDS}" + ", collapsed string" * collapsed + (f", {more}" if more else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, n in slices(whole.column(1)):
                batch = whole.slice(at, n)
                texts = [planted((t or "").encode().split(), h) for t, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                rows = [told(words, own) for words, own in zip(texts, runs(*numbered(texts)))]
                columns = list(zip(*rows))[: 7 + collapsed]
                types = [pa.int64()] * 5 + [pa.string()] * (2 + collapsed)
                yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types)), *batch.columns[3:]], names=names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", *["collapsed"] * collapsed, *[f.name for f in given.schema.fields[3:]]]
    return given.mapInArrow(run, schema)


def told(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    best = min(found, key=cmp_to_key(higher), default=None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    kept = b" ".join(without_repetitions(words, found))
    about = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(found), *about, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), kept.decode()


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the texts that hold a run freed of its repetitions; other texts, null ones too, stay as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = label(docs, id_col, text_col, plant=False, collapsed=True, carry=[row])
    text = F.when(F.col("n_runs") > 0, F.col("collapsed")).otherwise(F.col(f"row.`{text_col}`").cast("string")).alias(text_col)
    return marked.select(*[text if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])

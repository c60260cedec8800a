"""Fill-in-middle transformation (operator 12).

A document is cut into prefix, middle and suffix at two places counted in units: characters (code
points), words or lines.  Where a unit's boundary lies in the UTF-8 bytes comes from a wavelet matrix
over the classes of the bytes (inside a character, blank, line end, first of a word, other): three
bit planes with a count of ones every 64 bits.  A rank query tells how many bytes of a class stand
before a place, the ranks of a unit's classes add up to its boundaries there, and bisection on
them finds the place of a given boundary.  One matrix serves many texts at once, and all their cuts are
looked up together, step by step.

Work is row by row: no shuffle, and a lost task reads its rows again.  Texts are taken in groups
of at most ``GROUP_BYTES`` bytes (a longer text is a group of its own), so memory follows the longest
text and not the batch.

Defined results: a null text is an empty text; empty texts, texts that hold a marker and rows with a null
id or null draws are left plain.  Repeated rows give repeated results, other columns are ignored,
an empty table gives an empty result.  Both cuts may fall together: the middle is then empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What marks prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
GROUP_BYTES = 4 << 20

INSIDE, BLANK, LINE_END, WORD_START, OTHER = range(5)
PLANES = 3
#: Units: the classes whose bytes are boundaries, and whether a unit ends behind such a byte or begins at it.
UNITS = {"char": ((BLANK, LINE_END, WORD_START, OTHER), False), "word": ((WORD_START,), False), "line": ((LINE_END,), True)}


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each byte; ``starts``: where texts begin."""
    kind = np.full(256, OTHER, np.uint8)
    kind[0x80:0xC0] = INSIDE
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
    kind[0x0A] = LINE_END
    out = kind[data]
    gap = (out == BLANK) | (out == LINE_END)
    after = np.empty(len(out), bool)            # at the begin of a text, or behind a gap
    after[:1] = True
    after[1:] = gap[:-1]
    after[starts[starts < len(out)]] = True
    out[after & (out == OTHER)] = WORD_START
    return out


class Bits:
    """A bit vector with counts of ones in front of every 64 bits."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Rank of any class at any place, by one step for each bit plane."""

    def __init__(self, classes: np.ndarray):
        self.n, self.planes = len(classes), []
        for bit in reversed(range(PLANES)):
            ones = (classes >> bit & 1).astype(bool)
            zeros = int(len(ones) - np.count_nonzero(ones))
            self.planes.append((bit, Bits(ones), zeros))
            classes = np.concatenate([classes[~ones], classes[ones]])

    def rank(self, cls: int, at: np.ndarray) -> np.ndarray:
        """Bytes of class ``cls`` in front of each place."""
        low = np.zeros(1, np.int64)
        for bit, plane, zeros in self.planes:
            if cls >> bit & 1:
                low, at = zeros + plane.rank1(low), zeros + plane.rank1(at)
            else:
                low, at = low - plane.rank1(low), at - plane.rank1(at)
        return at - low

    def boundaries(self, classes: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Bytes of any of ``classes`` in front of each place (by the other classes if those are fewer)."""
        others = [c for c in range(1 << PLANES) if c not in classes and c <= OTHER]
        if len(others) < len(classes):
            return at - sum(self.rank(c, at) for c in others)
        return sum(self.rank(c, at) for c in classes)

    def place(self, classes: tuple[int, ...], low: np.ndarray, high: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The least place in [low, high] with ``count`` boundaries in front of it; ``high`` has as many at least."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            mid = (low + high) >> 1
            enough = self.boundaries(classes, mid) >= count
            high = np.where(enough, mid, high)
            low = np.where(enough, low, np.minimum(mid + 1, high))
        return low


class Texts:
    """Units and cuts of a group of texts (UTF-8 bytes)."""

    def __init__(self, texts: list[bytes], unit: str):
        self.classes, self.behind = UNITS[unit]
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in texts], np.int64)
        self.matrix = WaveletMatrix(byte_classes(data, self.starts))
        self.first = self.matrix.boundaries(self.classes, self.starts)
        found = self.matrix.boundaries(self.classes, self.ends) - self.first
        if self.behind:         # what follows the last boundary is a unit too
            last = self.matrix.place(self.classes, self.starts, self.ends, self.first + found)
            found = found + (last < self.ends)
        self.units = found

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Byte place, within its text, at which each text's first ``units`` units end."""
        if self.behind:
            whole = units >= self.units
            want = self.first + np.where(whole, 0, units)
            at = np.where(whole, self.ends, self.matrix.place(self.classes, self.starts, self.ends, want))
        else:                   # unit number ``units`` begins one byte in front of the place with one boundary more
            whole = units >= self.units
            want = self.first + np.where(whole, 0, units + 1)
            at = self.matrix.place(self.classes, self.starts, self.ends, want)
            at = np.where(whole, self.ends, at - 1)
        return np.where(units == 0, 0, at - self.starts)


def _groups(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def draws(id_col: Column) -> list[Column]:
    """Four numbers of 32 bits drawn from an id: two cuts, whether to cut, which form."""
    digest = F.sha2(F.concat(F.lit("1:"), id_col.cast("string")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", plain_percent: int = 10,
              spm_percent: int = 20, numbers: list[Column] | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n (units), form, prefix_units, middle_units, output; ``numbers``: other draws than those of the id."""
    shape = f"doc_id {dict(df.dtypes)[id_col]}, n bigint, form string, prefix_units bigint, middle_units bigint, output string"
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     *[c.alias(f"h{i}") for i, c in enumerate(numbers or draws(F.col(id_col)), 1)])

    def one(text: bytes, form: str, a: int, b: int) -> bytes:
        p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
        if form == "plain":
            return text
        if form == "psm":
            return b"".join([p, text[:a], s, text[b:], m, text[a:b]])
        return b"".join([s, text[b:], p, text[:a], m, text[a:b]])

    marks = [x.encode() for x in (PREFIX, SUFFIX, MIDDLE)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            h = [batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5)]
            for begin, end in _groups(texts, group_bytes):
                some = texts[begin:end]
                found = Texts(some, unit)
                known = ~np.any([np.isnan(x[begin:end].astype(float)) for x in h], axis=0)
                h1, h2, h3, h4 = (np.where(known, x[begin:end], 0).astype(np.int64) for x in h)
                n = found.units
                low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
                a, b = found.cut(low), found.cut(high)
                plain = ~known | (n == 0) | (h3 % 100 >= 100 - plain_percent) | np.array(
                    [any(k in t for k in marks) for t in some], bool)
                form = np.where(plain, "plain", np.where(h4 % 100 < spm_percent, "spm", "psm")).tolist()
                out = [one(*x) for x in zip(some, form, a.tolist(), b.tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(begin, end - begin), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                    pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain),
                    pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    return rows.mapInArrow(cut, shape)


def restore(output: Column, form: Column) -> Column:
    """The text again.  A cut text holds no marker of its own, so the three markers split it."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    a, b, middle = (F.get(parts, i) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(a, middle, b)).when(form == "spm", F.concat(b, middle, a)).otherwise(output)

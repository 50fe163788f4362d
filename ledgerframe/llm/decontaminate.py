"""Benchmark decontamination by template canonicalisation.

Words are cut at white space, stripped of ASCII punctuation and possessive endings
and folded; a number is cut from the unit glued to it.  Numbers (with decimals,
fractions, times), names (capitalised words of any script) and units next to a number
become typed placeholders, so a question with other numbers, names or units keeps its
template.  A capitalised word that opens a sentence has two readings, word and name.
Windows of ``WINDOW`` tokens (shorter items: the whole item) are joined by two
hashes: of their plain words, whatever these are, and of both readings of their
template where at least ``LITERALS`` tokens are literal.  Where a document and an
item share one, they are compared token by token; windows whose tokens are equal or
slots of one type, at least ``LITERALS`` of them equal, form runs.  A run of which
``NEEDED`` tokens (or all but two of a shorter item) are consistent is a hit: a name
of the item stands for one value of the document, numbers and units for any.  Items
of fewer than ``SHORTEST`` tokens are hits where they stand word for word.

The windows of the benchmark are broadcast while they number at most
``MAX_BROADCAST``; every document is then judged where it is read, without a
shuffle.  Beyond that, windows of both sides meet in a shuffled hash join and the
runs are formed per document.

Defined cases: NULL or empty texts and items match nothing; an item of few words
is held by every text with these words in a row, so a one-word item by each text
with that word; repeated documents are judged one by one, repeated items each count; an
empty table of documents or items gives no hits; extra columns are not read;
texts of any length are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, importable, map_arrow, row_struct, stored, text_or_empty, unpack
from .textops import FOLDED, Buffer, RangeHash, mixed, powers, slices

WINDOW, NEEDED, LITERALS, SHORTEST, SLIPS = 8, 13, 4, 6, 4
MAX_BROADCAST = 2_000_000
#: Tokens compared at once.
STEP = 1_000_000
#: Units of measure, which count as such next to a number.
CURRENCY = "$ € £".split()
UNITS = ("% $ € £ mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec second seconds min minute minutes "
         "h hr hour hours day days week weeks month months year years inch inches foot feet yard yards "
         "mile miles meter meters metre metres kilometer kilometers gram grams kilogram kilograms "
         "pound pounds ounce ounces liter liters litre litres dollar dollars euro euros cent cents "
         "percent degree degrees mph kmh").split()
#: Ends that are not part of a name, and signs before a number besides the ASCII ones.
POSSESSIVE = [x.encode() for x in ("'s", "’s")]
SIGNS = [x.encode() for x in "€£¥−"]
NUM, NAME, UNIT = (np.uint64(x) for x in (11, 13, 17))

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
#: Bytes of names: letters, apostrophes and hyphens, and all of other characters.
_LETTER = _UPPER | _LOWER
_LETTER[[39, 45, *range(128, 256)]] = True
#: Bytes of numbers, with decimals, fractions, times and ranges.
_NUMERIC = _DIGIT.copy()
_NUMERIC[[44, 45, 46, 47, 58]] = True
#: 2 upper case, 1 lower case, by code point; all cased scripts lie below.
_CASE = np.array([2 if c.isupper() or c.istitle() else int(c.islower()) for c in map(chr, range(0x1F000))],
                 np.uint8)
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 58, 59, 63]] = True


def counted(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    return np.concatenate([[0], np.cumsum(flags)])


def hash_of(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(RangeHash(raw, FOLDED)(np.array([0]), np.array([len(raw)]))[0])


_UNIT, _CURRENCY = (mixed(np.array([hash_of(u) for u in words], np.uint64)) for words in (UNITS, CURRENCY))


@dataclass
class Tokens:
    """Template tokens of several texts."""

    token: np.ndarray  # hash of the literal, or a placeholder
    value: np.ndarray  # hash of the word itself
    slot: np.ndarray  # whether the token is a placeholder
    opening: np.ndarray  # whether it is a literal that may be a name
    of: np.ndarray  # number of the text
    nth: np.ndarray  # place in the text

    def named(self) -> np.ndarray:
        """The tokens with every possible name as a placeholder."""
        return np.where(self.opening, NAME, self.token)


def cased(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an upper-case or a lower-case character starts at each byte."""
    upper, lower = _UPPER[buf], _LOWER[buf]
    at = np.nonzero(buf >= 0xC2)[0]
    if len(at):
        lead = buf[at].astype(np.int64)
        b1, b2, b3 = (buf[np.minimum(at + k, len(buf) - 1)].astype(np.int64) & 63 for k in (1, 2, 3))
        point = np.where(lead < 0xE0, (lead & 31) << 6 | b1, np.where(
            lead < 0xF0, (lead & 15) << 12 | b1 << 6 | b2, (lead & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        point = np.minimum(point, len(_CASE) - 1)
        upper[at], lower[at] = _CASE[point] == 2, _CASE[point] == 1
    return upper, lower


def ends_with(buf: np.ndarray, first: np.ndarray, last: np.ndarray, end: bytes) -> np.ndarray:
    out = last - first > len(end)
    for k, c in enumerate(reversed(end), 1):
        out &= (buf[last - k] | 32 if 65 <= c & 223 <= 90 else buf[last - k]) == c
    return out


def starts_with(buf: np.ndarray, first: np.ndarray, last: np.ndarray, start: bytes) -> np.ndarray:
    out = last - first > len(start)
    for k, c in enumerate(start):
        out &= buf[np.minimum(first + k, len(buf) - 1)] == c
    return out


def tokens(texts: list[bytes]) -> Tokens:
    b = Buffer(texts)
    start, end, of = b.words()
    buf = b.buf
    newline = counted((buf == 10) | (buf == 13))
    opens = np.ones(len(start), bool)
    opens[1:] = (of[1:] != of[:-1]) | _STOP[buf[end[:-1] - 1]] | (newline[start[1:]] > newline[end[:-1]])
    first, last = start.copy(), end.copy()
    for _ in range(8):  # "$" and "%" alone stay as words
        first += (last - first > 1) & _PUNCT[buf[np.minimum(first, len(buf) - 1)]]
        last -= (last - first > 1) & _PUNCT[buf[last - 1]]
    for mark in POSSESSIVE:  # the owner's name is the word
        last -= len(mark) * ends_with(buf, first, last, mark)
    for sign in SIGNS:
        signed = starts_with(buf, first, last, sign)
        first += len(sign) * (signed & _DIGIT[buf[np.minimum(first + len(sign), len(buf) - 1)]])
    # a number and what is glued to it are two words
    numeric = counted(_NUMERIC[buf])
    digit = _DIGIT[buf[np.minimum(first, len(buf) - 1)]]
    glued = digit & (numeric[last] - numeric[first] < last - first)
    if glued.any():
        other = np.nonzero(~_NUMERIC[buf])[0]
        split = np.where(glued, other[np.minimum(np.searchsorted(other, first), len(other) - 1)], last)
        word = np.repeat(np.arange(len(of)), 1 + glued)
        second = np.zeros(len(word), bool)
        second[1:] = word[1:] == word[:-1]
        first, last = np.where(second, split[word], first[word]), np.where(second, last[word], split[word])
        for _ in range(8):
            last -= (last - first > 1) & ~second & _PUNCT[buf[last - 1]]
        of, opens = of[word], opens[word] & ~second
    value = mixed(RangeHash(buf, FOLDED)(first, last))
    n = last - first
    at = np.minimum(first, len(buf) - 1)
    number = _DIGIT[buf[at]] & (numeric[last] - numeric[first] == n)
    upper, lower = cased(buf)
    lower, letters = counted(lower), counted(_LETTER[buf])
    name = upper[at] & (letters[last] - letters[first] == n) & (lower[last] > lower[first])
    opening, name = name & opens, name & ~opens
    after = np.zeros(len(first), bool)
    after[1:] = number[:-1] & (of[1:] == of[:-1])
    before = np.zeros(len(first), bool)
    before[:-1] = number[1:] & (of[1:] == of[:-1])
    unit = np.isin(value, _UNIT) & after | np.isin(value, _CURRENCY) & before
    token = np.where(number, NUM, np.where(name, NAME, np.where(unit, UNIT, value)))
    counts = np.bincount(of, minlength=len(texts))
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return Tokens(token, value, number | name | unit, opening, of, nth)


def rolling(token: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
    """Hashes of the runs of ``length`` tokens that start at given places."""
    n = len(token)
    forward, back = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(token) * forward[:n], out=sums[1:])
    return lambda at, length: mixed((sums[at + length] - sums[at]) * back[at] + np.uint64(length))


def windows(t: Tokens, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``length`` tokens and the token each one starts at:
    of their words, and of both readings of their template where it has enough
    literals.  A window without slots has one hash, its words being its template."""
    n = len(t.of) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.nonzero(t.of[:n] == t.of[length - 1:])[0]
    if length < SHORTEST:
        return rolling(t.value)(at, length), at
    slots, opening = counted(t.slot), counted(t.opening)
    slots, opening = slots[at + length] - slots[at], opening[at + length] - opening[at]
    readings = [(t.value, at[slots > 0]), (t.token, at[length - slots >= LITERALS]),
                (t.named(), at[(opening > 0) & (length - slots - opening >= LITERALS)])]
    return (np.concatenate([rolling(token)(a, length) for token, a in readings]),
            np.concatenate([a for _, a in readings]))


@dataclass
class Benchmark:
    """Windows of the items, by hash, and their tokens."""

    key: np.ndarray
    item: np.ndarray
    at: np.ndarray  # place in the item
    lengths: tuple[int, ...]  # window lengths in use
    size: np.ndarray
    first: np.ndarray  # place of each item in ``tokens``
    tokens: Tokens


def index_items(texts: list[bytes]) -> Benchmark:
    """Index of the items; each row is an item of its own, by its number."""
    t = tokens(texts)
    counts = np.bincount(t.of, minlength=len(texts))
    own = np.minimum(counts, WINDOW)
    key, item, at, lengths = [], [], [], []
    for length in sorted(set(own[own > 0].tolist())):
        k, a = windows(t, length)
        right = own[t.of[a]] == length
        key.append(k[right])
        item.append(t.of[a][right])
        at.append(t.nth[a][right])
        lengths.append(length)
    key, item, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (key, item, at))
    order = np.argsort(key, kind="stable")
    return Benchmark(key[order].astype(np.uint64), item[order], at[order], tuple(lengths), counts,
                     np.cumsum(counts) - counts, t)


def needed(size: np.ndarray) -> np.ndarray:
    return np.maximum(np.minimum(size, SHORTEST), np.minimum(NEEDED, size - 2))


def consistent(item: np.ndarray, doc: np.ndarray) -> bool:
    """Whether item and document values map to each other one to one."""
    pairs = set(zip(item.tolist(), doc.tolist(), strict=True))
    return len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def consistent_part(item: np.ndarray, doc: np.ndarray, name: np.ndarray) -> slice:
    """The part of a run in which a name of the item has one value in the document:
    all of it if at most one of SLIPS names departs from the usual value, else the
    longest part where none does.  Numbers and units may take any value."""
    at = np.nonzero(name)[0]
    theirs, mine = item[at], doc[at]
    if consistent(theirs, mine):
        return slice(0, len(item))
    times = Counter(zip(theirs.tolist(), mine.tolist(), strict=True))
    usual: dict[int, int] = {}
    for (a, _), n in times.items():
        usual[a] = max(n, usual.get(a, 0))
    if (len(at) - sum(usual.values())) * SLIPS <= len(at):
        return slice(0, len(item))
    best, start, last = slice(0, 0), 0, {}
    for k, a, b in [*zip(at.tolist(), theirs.tolist(), mine.tolist(), strict=True), (len(item), None, None)]:
        before, value = last.get(a, (-1, b))
        if a is None or value != b and before >= start:
            if k - start > best.stop - best.start:
                best = slice(start, k)
            start = max(start, before + 1)
        last[a] = k, b
    return best


def diagonals(t: Tokens, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, item, and the token at which the item would start, of all pairs that
    share a window there."""
    doc, item, diag = ([np.zeros(0, np.int64)] for _ in range(3))
    for length in bench.lengths:
        key, a = windows(t, length)
        lo = np.searchsorted(bench.key, key)
        some = lo < len(bench.key)
        some[some] = bench.key[lo[some]] == key[some]
        key, a, lo = key[some], a[some], lo[some]
        n = np.searchsorted(bench.key, key, "right") - lo
        a, row = np.repeat(a, n), np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc.append(t.of[a])
        item.append(bench.item[row])
        diag.append(a - bench.at[row])
    doc, item, diag = map(np.concatenate, (doc, item, diag))
    order = np.lexsort((diag, item, doc))
    doc, item, diag = doc[order], item[order], diag[order]
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(diag) != 0)
    return doc[new], item[new], diag[new]


def runs(t: Tokens, bench: Benchmark, doc: np.ndarray, item: np.ndarray, diag: np.ndarray) \
        -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(text, item, tokens of the text, tokens of the item) of every run that is long
    enough.  A run consists of windows in which each token is equal or a slot of one
    type, at least LITERALS of them equal (of an item below SHORTEST: all)."""
    b = bench.tokens
    mine, theirs = t.named(), b.named()
    slot, slots = t.slot | t.opening, b.slot | b.opening
    counts = np.bincount(t.of)
    first = np.cumsum(counts) - counts
    size = bench.size[item]
    lo = np.maximum(diag, first[doc])
    n = np.minimum(diag + size, first[doc] + counts[doc]) - lo
    step = np.cumsum(n) // STEP
    for part in np.split(np.arange(len(doc)), np.nonzero(np.diff(step))[0] + 1):
        end = np.cumsum(n[part])
        c = np.repeat(part, n[part])
        here = np.repeat(lo[part] - (end - n[part]), n[part]) + np.arange(len(c))
        there = here - diag[c] + bench.first[item[c]]
        same = t.value[here] == b.value[there]
        fits = same | slot[here] & slots[there] & (mine[here] == theirs[there])
        width = np.minimum(size, WINDOW)[c]
        at = np.nonzero(np.arange(len(c)) + width <= np.repeat(end, n[part]))[0]
        width = width[at]
        same, fits = counted(same), counted(fits)
        least = np.where(size[c[at]] < SHORTEST, width, LITERALS)
        good = (fits[at + width] - fits[at] == width) & (same[at + width] - same[at] >= least)
        at, width = at[good], width[good]
        new = np.ones(len(at), bool)
        new[1:] = (c[at[1:]] != c[at[:-1]]) | (at[1:] > at[:-1] + width[:-1])
        starts = np.nonzero(new)[0]
        ends = np.append(starts[1:], len(at))[:len(starts)] - 1
        starts, ends = at[starts], at[ends] + width[ends]
        long = ends - starts >= needed(size[c[starts]])
        for x, y in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            yield int(doc[c[x]]), int(item[c[x]]), here[x:y], there[x:y]


def hits(texts: list[bytes], bench: Benchmark) -> Iterator[tuple[int, int, int, int]]:
    """(number of the text, number of the item, tokens covered, slots refilled) of
    the longest consistent part of a run of each pair."""
    t, b = tokens(texts), bench.tokens
    found = diagonals(t, bench)
    if not len(found[0]):
        return
    names = b.named() == NAME
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for d, i, here, there in runs(t, bench, *found):
        if len(here) <= best.get((d, i), (0, 0))[0]:
            continue
        mine, theirs = t.value[here], b.value[there]
        part = consistent_part(theirs, mine, names[there])
        covered = part.stop - part.start
        if covered >= needed(bench.size[i]) and covered > best.get((d, i), (0, 0))[0]:
            best[d, i] = covered, int((mine[part] != theirs[part]).sum())
    for (d, i), (covered, refilled) in sorted(best.items()):
        yield d, i, covered, refilled


def read_items(benchmark: DataFrame, text_col: str, item_col: str) -> DataFrame:
    return benchmark.select(col(item_col).alias("item_id"), text_or_empty(text_col).alias("text"))


def small_enough(items: DataFrame, most: int) -> bool:
    """Whether the items have at most ``most`` words, so that they may be broadcast."""
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0]
    return (words or 0) <= most


def collected(items: DataFrame) -> tuple[list, Benchmark]:
    rows = items.orderBy("item_id", "text").collect()
    return [r[0] for r in rows], index_items([r[1].encode() for r in rows])


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               item_col: str = "item_id", item_text_col: str = "text",
               most: int = MAX_BROADCAST) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, covered (tokens),
    refilled (slots with another value)."""
    items = read_items(benchmark, item_text_col, item_col)
    rows = docs.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    types = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {types[0]}, item_id {types[1]}, covered int, refilled int"
    if not small_enough(items, most):
        return _find_by_join(rows, items, schema)
    shared = docs.sparkSession.sparkContext.broadcast(collected(items))

    def run(batches):
        ids, bench = shared.value
        for b, texts in slices(batches):
            found = list(hits(texts, bench))
            if found:
                d, i, covered, refilled = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(d)), pa.array([ids[x] for x in i]).cast(item_type),
                     pa.array(covered, pa.int32()), pa.array(refilled, pa.int32())],
                    names=["doc_id", "item_id", "covered", "refilled"])

    item_type = _arrow_type(items, "item_id")
    return map_arrow(rows, run, schema)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _find_by_join(rows: DataFrame, items: DataFrame, schema: str) -> DataFrame:
    """Items too many to broadcast: windows of both sides are joined by hash, and
    each document is judged against the items it shares a window with."""
    def emit(batches):
        for b, texts in slices(batches):
            t = tokens(texts)
            for length in lengths:
                key, a = windows(t, length)
                once = np.unique(np.stack([t.of[a], key.view(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("uid").take(pa.array(once[0])), pa.array(once[1])], names=["uid", "key"])

    def emit_items(batches):
        for b, texts in slices(batches):
            bench = index_items(texts)
            once = np.unique(np.stack([bench.item, bench.key.view(np.int64)]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid").take(pa.array(once[0])), pa.array(once[1]),
                 pa.array(np.minimum(bench.size, WINDOW)[once[0]], pa.int32())],
                names=["item_uid", "key", "length"])

    items = stored(items.withColumn("uid", F.monotonically_increasing_id()), "items")
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "item-docs")
    theirs = stored(map_arrow(items.select("uid", "text"), emit_items,
                              "item_uid long, key long, length int"), "item-windows")
    lengths = sorted(r[0] for r in theirs.select("length").distinct().collect())
    ours = map_arrow(rows.select("uid", "text"), emit, "uid long, key long")
    pairs = ours.join(theirs.drop("length"), "key").select("uid", "item_uid").distinct()
    joined = pairs.join(rows, "uid").join(items.select(
        F.col("uid").alias("item_uid"), "item_id", F.col("text").alias("item_text")), "item_uid")

    def judge(batches):
        for b in batches:
            out = []
            for k, (text, item) in enumerate(zip(b.column("text").to_pylist(),
                                                 b.column("item_text").to_pylist(), strict=True)):
                out += [(k, c, r) for _, _, c, r in hits([text.encode()], index_items([item.encode()]))]
            if out:
                at, covered, refilled = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(at)), b.column("item_id").take(pa.array(at)),
                     pa.array(covered, pa.int32()), pa.array(refilled, pa.int32())],
                    names=["doc_id", "item_id", "covered", "refilled"])

    return map_arrow(joined.select("doc_id", "item_id", "text", "item_text"), judge, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               item_col: str = "item_id", item_text_col: str = "text",
               most: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    items = read_items(benchmark, item_text_col, item_col)
    if not small_enough(items, most):  # rows go by a stored number, ids may be NULL or shared
        rows = stored(docs.select(row_struct(docs).alias("row"),
                                  F.monotonically_increasing_id().alias("uid")), "leak-docs")
        texts = rows.select(F.col("uid").alias("doc_id"), F.col("row").getField(text_col).alias("text"))
        leaks = find_leaks(texts, benchmark, "text", "doc_id", item_col, item_text_col, most) \
            .select(F.col("doc_id").alias("uid")).distinct()
        return unpack(rows.join(leaks, "uid", "left_anti"), "row", docs.columns)
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(collected(items)[1])

    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        out = np.ones(len(text), bool)
        rows, at = pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["text"]), 0
        for b, texts in slices([rows]):
            for d, _, _, _ in hits(texts, shared.value):
                out[at + d] = False
            at += b.num_rows
        return pd.Series(out)

    return docs.where(clean(text_or_empty(text_col)))

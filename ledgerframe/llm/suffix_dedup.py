"""Removal of repeated byte strings by per-shard suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier:
in a document with a smaller id, or earlier in the same one.  Strings are judged
on the input and never cross documents.

*Shards.*  Every window of ``LENGTH`` bytes is assigned to its minimizer, the
``K``-byte string in it with the smallest hash, so equal windows share one.  Runs
of windows with one minimizer form a *segment*.  Minimizers seen once cannot hold
a repeat.  Strings that are frequent in a small sample come last in the order of
minimizers: windows that reach out of a common passage then fall to a rare string
of their own text (this balances the shards and cannot change the result).

*Steps.*  (1) Segments are found where documents are read; equal segments of a
task are settled there, which leaves at most one per task of any hot passage.
(2) A shuffle by minimizer settles equal segments of different tasks: only the
first keeps its windows.  Minimizers with two or more different segments need
their bytes compared: (3) the bytes are cut from the documents and sent to the
shards; (4) each shard builds a suffix array by Larsson-Sadakane refinement,
takes common prefixes by Kasai's recurrence (over all segments in step) and keeps
the earliest of every run of suffixes that share ``LENGTH`` bytes.  A minimizer with
more than ``SPLIT`` different segments is spread over several shards; (5) their
sorted windows are merged across shards by binary search.  (6) The removed ranges
meet the documents again.

Rows travel in blocks (arrays in binary columns); a block or shard has a bounded
size however many rows a key has.

Defined cases: a NULL text counts as empty; texts below ``LENGTH`` bytes lose nothing;
rows that share an id are told apart and ordered by the hash of their text, and a
row repeated whole is one document, judged once; NULL ids come first; ids are
integers; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, col, importable, map_arrow, sampled_texts, stored, text_or_empty
from .textops import Buffer, RangeHash, mixed, slices

LENGTH, K = 100, 24
WINDOWS = LENGTH - K + 1
#: Records gathered by a task before it settles and sends them.
GATHERED = 600_000
#: Text bytes behind one bucket of documents or segments, and buckets at most.
BUCKET_BYTES, MAX_BUCKETS = 6_000_000, 65_536
#: Different segments of one minimizer in a shard.
SPLIT = 20_000
#: Bytes of the sample that finds common strings, and the share that makes one common.
SAMPLE_BYTES, COMMON = 6_000_000, 0.004
#: Longer texts are handled in pieces that overlap by a window.
PIECE = 4_000_000

Arrays = dict[str, np.ndarray]
RECORD = {"mini": np.uint32, "content": np.uint64, "nwin": np.uint8, "id": np.int64, "xx": np.int64,
          "db": np.int32, "start": np.int32}
RANGE = {"id": np.int64, "xx": np.int64, "start": np.int32, "end": np.int32}
FETCH = {"id": np.int64, "xx": np.int64, "start": np.int32, "nwin": np.uint8, "mini": np.uint32,
         "shard": np.int32, "part": np.int32}
SEGMENT = {"id": np.int64, "xx": np.int64, "db": np.int32, "start": np.int32, "size": np.int32}
WINDOW = {"print": np.uint64, "id": np.int64, "xx": np.int64, "db": np.int32, "start": np.int32}


def take(a: Arrays, at) -> Arrays:
    return {k: v[at] for k, v in a.items()}


def packed(a: Arrays, kinds: dict) -> bytes:
    return b"".join(a[k].astype(t).tobytes() for k, t in kinds.items())


def unpacked(blocks: list[bytes], kinds: dict) -> Arrays:
    width = sum(np.dtype(t).itemsize for t in kinds.values())
    parts: dict[str, list] = {k: [] for k in kinds}
    for block in blocks:
        n, at = len(block) // width, 0
        for k, t in kinds.items():
            parts[k].append(np.frombuffer(block, t, n, at))
            at += n * np.dtype(t).itemsize
    return {k: np.concatenate(v) if v else np.zeros(0, kinds[k]) for k, v in parts.items()}


def grouped(key: np.ndarray):
    """(value, places) of each distinct key, places in order."""
    order = np.argsort(key, kind="stable")
    cuts = np.nonzero(np.diff(key[order]))[0] + 1
    for at in np.split(order, cuts) if len(order) else []:
        yield int(key[at[0]]), at


# -- (1) segments ---------------------------------------------------------------
def string_hashes(buf: np.ndarray, ranges: RangeHash) -> np.ndarray:
    """Hash of the K bytes at every place."""
    n = len(buf) - K + 1
    return mixed((ranges.sums[K:] - ranges.sums[:n]) * ranges.back[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every full window, by block prefixes and suffixes."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:len(x)] = x
    rows = full.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def segments(texts: list[bytes], common: np.ndarray) -> Arrays:
    """of (number of the text), start, nwin, mini, content of every segment.
    ``common`` marks the leading 20 bits of frequent string hashes."""
    b = Buffer(texts)
    long = np.nonzero(b.size >= LENGTH)[0]
    if not len(long):
        return {k: np.zeros(0, np.int64) for k in ("of", "start", "nwin", "mini", "content")}
    ranges = RangeHash(b.buf)
    strings = string_hashes(b.buf, ranges)
    key = ((strings >> np.uint64(25)) << np.uint64(24)) | np.arange(len(strings), dtype=np.uint64)
    key |= common[strings >> np.uint64(44)].astype(np.uint64) << np.uint64(63)
    least = sliding_min(key, WINDOWS)
    edge = np.zeros(len(least) + 1, np.int8)
    edge[b.start[long]] += 1
    edge[b.end[long] - LENGTH + 1] -= 1
    valid = np.cumsum(edge[:-1], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    start = np.nonzero(new)[0]
    stop = np.zeros(len(valid), bool)
    stop[:-1] = valid[:-1] & (~valid[1:] | (least[1:] != least[:-1]))
    stop[-1] = valid[-1]
    nwin = np.nonzero(stop)[0] + 1 - start
    of = np.searchsorted(b.end, start)
    mini = mixed(least[start] >> np.uint64(24)) >> np.uint64(32)
    content = mixed(ranges(start, start + nwin + LENGTH - 1) + nwin.astype(np.uint64))
    return {"of": of, "start": start - b.start[of], "nwin": nwin, "mini": mini, "content": content}


def pieces(b: pa.RecordBatch, texts: list[bytes]):
    """(rows, texts, offsets): a text beyond PIECE is cut, with a window's overlap."""
    if len(texts) > 1 or len(texts[0]) <= PIECE:
        yield b, texts, 0
        return
    for lo in range(0, max(1, len(texts[0]) - LENGTH + 1), PIECE):
        yield b, [texts[0][lo:lo + PIECE + LENGTH - 1]], lo


def settle(a: Arrays) -> tuple[Arrays, Arrays]:
    """First of equal segments, and the others."""
    order = np.lexsort((a["start"], a["xx"], a["id"], a["content"], a["mini"]))
    a = take(a, order)
    again = np.zeros(len(order), bool)
    again[1:] = (a["mini"][1:] == a["mini"][:-1]) & (a["content"][1:] == a["content"][:-1])
    # the same place of the same document, given twice, is one
    same = np.zeros(len(order), bool)
    same[1:] = again[1:] & (a["id"][1:] == a["id"][:-1]) & (a["xx"][1:] == a["xx"][:-1]) \
        & (a["start"][1:] == a["start"][:-1])
    if same.any():
        a, again = take(a, ~same), again[~same]
    return take(a, ~again), take(a, again)


def in_text_order(a: Arrays) -> Arrays:
    return take(a, np.lexsort((a["start"], a["xx"], a["id"])))


def find_segments(buckets: int, common: np.ndarray):
    def flush(parts: list[Arrays]):
        a = {k: np.concatenate([p[k] for p in parts]).astype(t) for k, t in RECORD.items()}
        first, rest = settle(a)
        out = []
        for settled, part, key in ((False, first, first["mini"] % np.uint32(buckets)),
                                   (True, rest, rest["db"] % buckets)):
            part = in_text_order({**part, "key": key})
            out += [(bucket, settled, packed(take(part, at), RECORD)) for bucket, at in grouped(part["key"])]
        names = ["bucket", "settled", "block"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out, strict=True), (pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=names)

    def run(batches):
        parts, n = [], 0
        for rows, whole in slices(batches):
            for b, texts, offset in pieces(rows, whole):
                s = segments(texts, common)
                of = s.pop("of")
                s["start"] = s["start"] + offset
                for k in ("id", "xx", "db"):
                    s[k] = b.column(k).to_numpy()[of]
                if len(of):
                    parts.append(s)
                    n += len(of)
                if n >= GATHERED:
                    yield flush(parts)
                    parts, n = [], 0
        if parts:
            yield flush(parts)

    return run


# -- (2) equal segments of different tasks -------------------------------------------
FOUND = "kind string, db int, block binary"


def found_table(rows: list[tuple]) -> pa.Table:
    kinds, dbs, blocks = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"kind": pa.array(kinds, pa.string()), "db": pa.array(dbs, pa.int32()),
                     "block": pa.array(blocks, pa.binary())})


def range_blocks(a: Arrays, end: np.ndarray) -> list[tuple]:
    a = in_text_order({**a, "end": end})
    return [("range", db, packed(take(a, at), RANGE)) for db, at in grouped(a["db"])]


def settle_bucket(split: int):
    def run(table: pa.Table) -> pa.Table:
        settled = table.column("settled").to_pylist()
        blocks = table.column("block").to_pylist()
        first, rest = settle(unpacked([x for x, s in zip(blocks, settled, strict=True) if not s], RECORD))
        rows = range_blocks(rest, rest["start"] + rest["nwin"] + np.int32(LENGTH - 1))
        done = unpacked([x for x, s in zip(blocks, settled, strict=True) if s], RECORD)
        rows += range_blocks(done, done["start"] + done["nwin"] + np.int32(LENGTH - 1))
        # minimizers with different segments: their bytes are to be compared
        _, group, count = np.unique(first["mini"], return_inverse=True, return_counts=True)
        several = count[group] > 1
        want, group = take(first, several), group[several]
        n = count[group]
        place = np.arange(len(group)) - np.searchsorted(group, group)  # first is in order of mini
        want["shard"] = np.full(len(group), table.column("bucket")[0].as_py(), np.int32)
        parts = -(-n // split)
        want["part"] = np.where(parts > 1, 1 + place % np.maximum(parts, 1), 0).astype(np.int32)
        want = in_text_order(want)
        rows += [("fetch", db, packed(take(want, at), FETCH)) for db, at in grouped(want["db"])]
        return found_table(rows)

    return run


# -- (3) bytes of the segments to compare ----------------------------------------------
def doc_places(table: pa.Table) -> dict[tuple[int, int], int]:
    ids, xx = table.column("id").to_pylist(), table.column("xx").to_pylist()
    return {pair: i for i, pair in enumerate(zip(ids, xx, strict=True))}


def cut_segments(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    want = in_text_order(unpacked(wanted.column("block").to_pylist(), FETCH))
    texts = docs.column("text").cast(pa.binary())
    places = doc_places(docs)
    db = docs.column("db")[0].as_py() if len(docs) else 0
    want["size"] = want["nwin"].astype(np.int32) + np.int32(LENGTH - 1)
    cuts, last, raw = [], None, b""
    for i, x, s, n in zip(*(want[k].tolist() for k in ("id", "xx", "start", "size")), strict=True):
        if (i, x) != last:
            last, raw = (i, x), texts[places[i, x]].as_py()
        cuts.append(raw[s:s + n])
    want["db"] = np.full(len(cuts), db, np.int32)
    rows = []
    for _, at in grouped(want["shard"].astype(np.int64) << 32 | want["part"]):
        rows.append((int(want["shard"][at[0]]), int(want["part"][at[0]]),
                     packed(take(want, at), SEGMENT), b"".join([cuts[j] for j in at])))
    shard, part, block, text = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"shard": pa.array(shard, pa.int32()), "part": pa.array(part, pa.int32()),
                     "block": pa.array(block, pa.binary()), "bytes": pa.array(text, pa.binary())})


# -- (4) suffix array of a shard -----------------------------------------------------
def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by Larsson-Sadakane refinement.  Symbol 0 ends a segment; ends
    count as different from each other, in text order."""
    n, h = len(symbols), 7
    left = np.searchsorted(np.nonzero(symbols == 0)[0], np.arange(n))
    left = np.nonzero(symbols == 0)[0][left] - np.arange(n)  # symbols before the end
    wide = np.zeros(n + h, np.uint64)
    wide[:n] = symbols
    key = np.zeros(n, np.uint64)
    for k in range(h):
        key = (key << np.uint64(9)) | np.where(left > k, wide[k:n + k], 0).astype(np.uint64)
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    new = np.ones(n, bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (left[sa[1:]] < h)
    rank = np.empty(n, np.int64)

    def number(at: np.ndarray, new: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Ranks (last place of the group) for the suffixes sa[at]; the places left
        in groups of two or more."""
        starts = np.nonzero(new)[0]
        ends = np.append(starts[1:], len(at)) - 1
        group = np.cumsum(new) - 1
        rank[where] = at[ends][group]
        return at[(ends - starts)[group] > 0]

    open_ = number(np.arange(n), new, sa)
    while len(open_):
        pos = sa[open_]
        group, then = rank[pos], rank[pos + h]
        order = np.lexsort((then, group))
        pos, group, then = pos[order], group[order], then[order]
        sa[open_] = pos
        new = np.ones(len(pos), bool)
        new[1:] = (group[1:] != group[:-1]) | (then[1:] != then[:-1])
        open_ = number(open_, new, pos)
        h *= 2
    return sa


def common_prefixes(symbols: np.ndarray, sa: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Kasai's common prefixes with the suffix before in ``sa``: every segment keeps
    the length it has matched, less one, from one place to the next."""
    place = np.empty(len(sa), np.int64)
    place[sa] = np.arange(len(sa))
    out = np.zeros(len(sa), np.int32)
    by_size = np.argsort(-size, kind="stable")
    start, size = start[by_size], size[by_size]
    matched = np.zeros(len(start), np.int64)
    for t in range(int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -t, "left"))  # segments longer than t
        i = start[:n] + t
        j = sa[place[i] - 1]  # every segment's end sorts before: place > 0
        k = np.maximum(matched[:n] - 1, 0)
        on = np.arange(n)
        while len(on):
            a, b = symbols[i[on] + k[on]], symbols[j[on] + k[on]]
            on = on[(a == b) & (a != 0)]
            k[on] += 1
        matched[:n] = k
        out[place[i]] = k
    return out


def window_groups(a: Arrays, text: bytes) -> tuple[Arrays, np.ndarray]:
    """All windows of the segments, and the group of equal ones that each is in."""
    size = a["size"].astype(np.int64)
    start = np.cumsum(size + 1) - size - 1
    symbols = np.zeros(int(size.sum()) + len(size), np.uint16)
    inside = np.ones(len(symbols), bool)
    inside[start + size] = False
    symbols[inside] = np.frombuffer(text, np.uint8).astype(np.uint16) + 1
    sa = suffix_array(symbols)
    lcp = common_prefixes(symbols, sa, start, size)
    group = np.cumsum(lcp < LENGTH)
    segment = np.searchsorted(start, sa, "right") - 1
    offset = sa - start[segment]
    whole = offset + LENGTH <= size[segment]
    segment, offset, group = segment[whole], offset[whole], group[whole]
    windows = {k: a[k][segment] for k in ("id", "xx", "db")}
    windows["start"] = (a["start"][segment] + offset).astype(np.int32)
    windows["at"] = start[segment] + offset - segment  # place in ``text``
    return windows, group


def earliest(w: Arrays, group: np.ndarray) -> tuple[Arrays, Arrays]:
    """The first window of each group, and the others."""
    order = np.lexsort((w["start"], w["xx"], w["id"], group))
    w, group = take(w, order), group[order]
    again = np.zeros(len(order), bool)
    again[1:] = group[1:] == group[:-1]
    return take(w, ~again), take(w, again)


def removed(w: Arrays) -> list[tuple]:
    """Range blocks of repeated windows; neighbours are joined."""
    w = in_text_order(w)
    n = len(w["id"])
    new = np.ones(n, bool)
    new[1:] = (w["id"][1:] != w["id"][:-1]) | (w["xx"][1:] != w["xx"][:-1]) \
        | (w["start"][1:] > w["start"][:-1] + LENGTH)
    starts = np.nonzero(new)[0]
    stops = np.append(starts[1:], n) - 1
    return range_blocks(take(w, starts), w["start"][stops] + np.int32(LENGTH)) if n else []


def judge_shard(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        a = unpacked(table.column("block").to_pylist(), SEGMENT)
        text = b"".join(table.column("bytes").to_pylist())
        w, group = window_groups(a, text)
        first, rest = earliest(w, group)
        rows = removed(rest)
        if table.column("part")[0].as_py():  # other shards may hold the same windows
            first["print"] = mixed(RangeHash(np.frombuffer(text, np.uint8))(
                first["at"], first["at"] + LENGTH))
            first = take(first, np.argsort(first["print"], kind="stable"))
            edges = np.searchsorted(first["print"], np.linspace(0, 2.0 ** 64, buckets + 1)[1:-1]
                                    .astype(np.uint64))
            rows += [("window", i, packed(take(first, slice(lo, hi)), WINDOW))
                     for i, (lo, hi) in enumerate(zip([0, *edges], [*edges, len(first["id"])], strict=True))
                     if hi > lo]
        return found_table(rows)

    return run


# -- (5) merging across shards ------------------------------------------------------
def merge_shards(table: pa.Table) -> pa.Table:
    """Sorted windows of several shards: each later run is looked up in the merged
    ones by binary search; of equal windows the earlier stays, the other goes."""
    blocks = table.column("block").to_pylist()
    merged, rows = unpacked(blocks[:1], WINDOW), []
    for block in blocks[1:]:
        run = unpacked([block], WINDOW)
        at = np.searchsorted(merged["print"], run["print"])
        hit = at < len(merged["print"])
        hit[hit] = merged["print"][at[hit]] == run["print"][hit]
        mine, theirs = take(run, hit), take(merged, at[hit])
        order = np.lexsort(tuple(np.concatenate([mine[k], theirs[k]]) for k in ("start", "xx", "id")))
        nth = np.empty(len(order), np.int64)
        nth[order] = np.arange(len(order))
        n = len(mine["id"])
        sooner = nth[:n] < nth[n:]
        rows += removed({k: np.where(sooner, theirs[k], mine[k]) for k in mine})
        kept = at[hit][sooner]
        for k in merged:
            merged[k] = merged[k].copy()
            merged[k][kept] = mine[k][sooner]
        fresh = take(run, ~hit)
        to = at[~hit]
        merged = {k: np.insert(merged[k], to, fresh[k]) for k in merged}
    return found_table(rows)


# -- (6) result -------------------------------------------------------------------------
def cut_documents(docs: pa.Table, ranges: pa.Table, texts: bool = False) -> pa.Table:
    """The removed spans of each row; with ``texts`` the text that is left instead."""
    a = unpacked(ranges.column("block").to_pylist(), RANGE) if len(ranges) else unpacked([], RANGE)
    a = in_text_order(a)
    pair = np.nonzero(np.diff(a["id"]) | np.diff(a["xx"]))[0] + 1
    by_doc = {(int(a["id"][at[0]]), int(a["xx"][at[0]])): at
              for at in np.split(np.arange(len(a["id"])), pair) if len(at)}
    rows = []
    for i, x, raw in zip(docs.column("id").to_pylist(), docs.column("xx").to_pylist(),
                         docs.column("text").cast(pa.binary()).to_pylist(), strict=True):
        at, spans = by_doc.get((i, x)), []
        if at is not None:
            lo, hi = a["start"][at], np.maximum.accumulate(a["end"][at])
            new = np.ones(len(at), bool)
            new[1:] = lo[1:] > hi[:-1]
            first = np.nonzero(new)[0]
            spans = list(zip(lo[first].tolist(), hi[np.append(first[1:], len(at)) - 1].tolist(), strict=True))
        edges = [0, *[e for s in spans for e in s], len(raw)]
        kept = b"".join(raw[lo:hi] for lo, hi in zip(edges[::2], edges[1::2], strict=True))
        if texts:
            rows.append(kept.decode("utf-8", "replace"))
            continue
        rows.append((len(raw), len(raw) - len(kept), [{"start": s, "end": e} for s, e in spans],
                     hashlib.sha256(kept).hexdigest()))
    if texts:
        return pa.table({"doc_id": docs.column("doc_id"), "text": pa.array(rows, pa.string())})
    n, gone, spans, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": pa.array(n, pa.int64()),
                     "n_removed": pa.array(gone, pa.int64()), "spans": pa.array(spans, span),
                     "kept_sha256": pa.array(sha, pa.string())})


def common_strings(rows: DataFrame, total: int) -> np.ndarray:
    """Marks of the strings found in a ``COMMON`` share of a bounded sample of
    documents (texts up to 64 KB, about SAMPLE_BYTES in all; copies of a text come as
    one with their number)."""
    texts, times = sampled_texts(rows, max(1, total // SAMPLE_BYTES))
    marks = np.zeros(1 << 20, bool)
    counts = np.zeros(1 << 20, np.int64)
    for t, n in zip(texts, times.tolist(), strict=True):
        if len(t) >= K:
            raw = np.frombuffer(t, np.uint8)
            counts[np.unique(string_hashes(raw, RangeHash(raw)) >> np.uint64(44)).astype(np.int64)] += n
    if counts.any():
        marks[counts >= max(8, COMMON * times.sum() + 4 * np.sqrt(counts.mean()))] = True
    return marks


def _cut(docs: DataFrame, text_col: str, id_col: str, split: int, cut, columns: str) -> DataFrame:
    """doc_id and ``columns`` of every row, by ``cut`` of rows and their ranges."""
    spark = docs.sparkSession
    importable(spark)
    text = text_or_empty(text_col)
    rows = docs.select(col(id_col).alias("doc_id"),
                       F.coalesce(col(id_col).cast("long"), F.lit(-2 ** 63)).alias("id"),
                       F.xxhash64(text).alias("xx"), text.alias("text"))
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = int(min(MAX_BUCKETS, max(16, total // BUCKET_BYTES)))
    rows = rows.withColumn("db", F.pmod(F.xxhash64("id", "xx"), F.lit(buckets)).cast("int"))
    keyed = rows.select("doc_id", "id", "xx", "db", "text").groupBy("db")
    with arrow_rows(spark, 500):
        blocks = map_arrow(rows.select("id", "xx", "db", "text"),
                           find_segments(buckets, common_strings(rows, total)),
                           "bucket int, settled boolean, block binary")
        found = stored(blocks.groupBy("bucket").applyInArrow(settle_bucket(split), FOUND), "segments")
        cuts = rows.select("id", "xx", "db", "text").groupBy("db").cogroup(
            found.where("kind = 'fetch'").groupBy("db")).applyInArrow(
            cut_segments, "shard int, part int, block binary, bytes binary")
        judged = stored(cuts.groupBy("shard", "part").applyInArrow(judge_shard(buckets), FOUND), "shards")
    merged = judged.where("kind = 'window'").groupBy("db").applyInArrow(merge_shards, FOUND)
    ranges = found.where("kind = 'range'").unionByName(judged.where("kind = 'range'")) \
        .unionByName(merged)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return keyed.cogroup(ranges.groupBy("db")).applyInArrow(cut, f"doc_id {id_type}, {columns}")


def repeated_ranges(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    split: int = SPLIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, spans array<struct<start,
    end>> (maximal removed runs, bytes), kept_sha256."""
    def cut(rows, ranges):
        return cut_documents(rows, ranges)

    return _cut(docs, text_col, id_col, split, cut, "n_bytes long, n_removed long, "
                "spans array<struct<start:int,end:int>>, kept_sha256 string")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    return repeated_ranges(docs, **options).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def drop_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id and the text without the removed bytes (a character cut in two becomes
    the replacement character)."""
    def cut(rows, ranges):
        return cut_documents(rows, ranges, texts=True)

    return _cut(docs, text_col, id_col, SPLIT, cut, "text string")

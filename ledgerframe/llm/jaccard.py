"""Near-duplicate join on word shingles by PartEnum signatures.

A document's set holds its distinct ``SHINGLE``-word shingles (words folded A-Z);
two documents link when their sets have a Jaccard similarity of 3/4 or more.

*Signatures.*  Sets of size ``s`` that link differ in at most ``s / 3`` elements.
Sizes form bands, one for each power of two ``n``; a band divides the feature domain
by hash into ``n`` partitions, and a set's signature in a partition is what it has
there.  Two linked sets of a band disagree in at most ``s // 3`` partitions.  All
signatures have one global order - those with rare shingles first, those of more
elements before, empty ones last - so the first ``s // 3 + 1`` of both sets have one
in common, and only these are kept.  Where a set has fewer non-empty signatures
than that, it also gives those of the finest division, one partition for each
feature, which always has enough.  A set that can link into the next band gives
signatures there too.  So every link shares a non-empty signature, and no
partition of absent features ever forms a group.

*Links.*  Equal sets are one class from the start.  Of classes that share a
signature the smallest is the centre; groups with one centre are one group, and
every class is compared with its centres.  For groups that are not one component
then, other centres follow where the group is large, and last the pairs of classes
in different components, in blocks.  A pair is first tested by the distance of two
histograms of shingles (a lower bound of the sets' difference), then exactly on the
texts.  Components of links are found by large-star and small-star steps.

Rows travel in blocks (arrays in binary columns); equal classes of a task are
merged before the shuffle; the shingles called frequent are found in a bounded
sample, which only orders signatures and cannot change the result.

Defined cases: without words or text a set is empty and links with nothing; texts
of fewer than ``SHINGLE`` words are one shingle; rows with the same set always
link; NULL ids never name a component unless all its ids are NULL; ids are
integers; repeated rows each give a row; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, col, give_back, importable, map_arrow, row_struct, sampled_texts, stored, \
    text_or_empty, unpack
from .textops import FOLDED, Buffer, RangeHash, mixed, slices

SHINGLE = 5
#: Text bytes behind one bucket of signatures, and buckets at most.
BUCKET_BYTES, MAX_BUCKETS = 12_000_000, 65_536
#: Signatures gathered by a task before they are sent.
GATHERED = 300_000
SAMPLE_BYTES, FREQUENT = 6_000_000, 0.002
#: Rounds of other centres for groups of LARGE classes; classes in a block of pairs.
CENTRES, LARGE, BLOCK = 1, 64, 512


# -- sets -------------------------------------------------------------------------
def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of every distinct shingle, in that order."""
    b = Buffer(texts)
    start, end, of = b.words()
    word = mixed(RangeHash(b.buf, FOLDED)(start, end))
    count = np.bincount(of, minlength=len(texts))
    first = np.cumsum(count) - count
    at = np.nonzero(np.arange(len(of)) + SHINGLE <= (first + count)[of])[0]
    parts, owners = [], []
    key = np.full(len(at), SHINGLE, np.uint64)
    for k in range(SHINGLE):
        key = mixed(key * np.uint64(3) + word[at + k])
    parts.append(key)
    owners.append(of[at])
    for n in range(1, SHINGLE):  # shorter texts: the whole sequence
        few = np.nonzero(count == n)[0]
        key = np.full(len(few), n, np.uint64)
        for k in range(n):
            key = mixed(key * np.uint64(3) + word[first[few] + k])
        parts.append(key)
        owners.append(few)
    key, of = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((key, of))
    key, of = key[order], of[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    return of[new], key[new]


def summed(value: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sum of uint64 values modulo 2**64 at each place."""
    out = np.zeros(size, np.uint64)
    np.add.at(out, at, value)
    return out


def classes(of: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each set, and the hash that names its class."""
    size = np.bincount(of, minlength=n)
    name = mixed(summed(mixed(key ^ np.uint64(0x5851F42D4C957F2D)), of, n) + size.astype(np.uint64))
    return size, name.view(np.int64)


def histograms(of: np.ndarray, key: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Counts of each set's shingles in bins by their leading bits, four bits each; a
    set has as many bins as the power of two below its size.  Empty if a count does
    not fit."""
    log = np.maximum(np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1, 1)
    bins = 1 << log
    offset = np.cumsum(bins) - bins
    counts = np.bincount(offset[of] + (key >> (64 - log).astype(np.uint64)[of]).astype(np.int64),
                         minlength=int(bins.sum()))
    fits = np.maximum.reduceat(counts, offset) < 16 if len(bins) else np.zeros(0, bool)
    packed = (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    return [packed[o // 2:(o + n) // 2] if ok else b""
            for o, n, ok in zip(offset.tolist(), bins.tolist(), fits.tolist(), strict=True)]


def bin_rows(packed: list[bytes], bins: int) -> np.ndarray:
    """Histograms of equal length as rows of ``bins`` counts (half of theirs: folded)."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    out = np.empty((len(packed), 2 * raw.shape[1]), np.int16)
    out[:, ::2], out[:, 1::2] = raw & 15, raw >> 4
    while out.shape[1] > bins:
        out = out[:, ::2] + out[:, 1::2]
    return out


def most_different(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Largest difference of linked sets of these sizes (above it there is no link)."""
    return (s + t) // 7


# -- signatures -------------------------------------------------------------------------
def first_of_each(of: np.ndarray, order_key: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Places of the ``limit[of]`` smallest keys of each owner."""
    order = np.lexsort((order_key, of))
    owner = of[order]
    begin = np.searchsorted(owner, owner)
    return order[np.arange(len(owner)) - begin < limit[owner]]


def in_band(of: np.ndarray, key: np.ndarray, rare: np.ndarray, size: np.ndarray,
            n_parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, signature) for sets in bands of ``n_parts`` partitions (0: not in one).
    ``of`` ascends."""
    limit = np.where(n_parts > 0, size // 3 + 1, 0)
    on = n_parts[of] > 0
    of, key, rare = of[on], key[on], rare[on]
    offset = np.cumsum(n_parts) - n_parts
    part = (mixed(key + np.uint64(0x2545F4914F6CDD1D)) & (n_parts[of] - 1).astype(np.uint64)).astype(np.int64)
    place = offset[of] + part
    total = int(n_parts.sum())
    count = np.bincount(place, minlength=total)
    some = np.nonzero(count)[0]
    seen_rare = np.bincount(place[rare], minlength=total)[some] > 0
    sums = summed(mixed(key), place, total)[some]
    owner = np.repeat(np.arange(len(n_parts)), n_parts)[some]
    band = n_parts[owner].astype(np.uint64)
    sig = mixed(mixed(sums + band) + (some - offset[owner]).astype(np.uint64))
    rank = (np.where(seen_rare, 0, 8) + 7 - np.minimum(count[some], 7)).astype(np.uint64)
    pick = first_of_each(owner, (rank << np.uint64(60)) | (sig >> np.uint64(4)), limit)
    out_of, out_sig = [owner[pick]], [sig[pick]]
    # too few non-empty partitions: the finest division as well
    poor = (np.bincount(owner, minlength=len(n_parts)) < limit)
    at = np.nonzero(poor[of])[0]
    if len(at):
        sig = mixed(key[at] ^ mixed(n_parts[of[at]].astype(np.uint64) + np.uint64(1 << 40)))
        pick = first_of_each(of[at], (np.where(rare[at], 0, 1).astype(np.uint64) << np.uint64(60))
                             | (sig >> np.uint64(4)), limit)
        out_of.append(of[at][pick])
        out_sig.append(sig[pick])
    return np.concatenate(out_of), np.concatenate(out_sig)


def signatures(of: np.ndarray, key: np.ndarray, size: np.ndarray, frequent: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, signature), all bands."""
    rare = ~frequent[key >> np.uint64(44)]
    exponent = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
    own = np.where(size > 0, 1 << exponent.astype(np.int64), 0)
    above = np.where(4 * size >= 3 * 2 * own, 2 * own, 0)
    a, b = in_band(of, key, rare, size, own), in_band(of, key, rare, size, above)
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


# -- blocks ---------------------------------------------------------------------------------
DOC = np.dtype([("id", "<i8"), ("xx", "<i8"), ("n", "<i4"), ("class", "<i8"), ("bytes", "<i4")])
SIG = np.dtype([("sig", "<u4"), ("class", "<i8")])
MEMBER = np.dtype([("centre", "<i8"), ("class", "<i8")])
BLOCKS = "kind string, bucket int, block binary"


def block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, block = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(bucket, pa.int32()),
                                       pa.array(block, pa.binary())], names=["kind", "bucket", "block"])


def by_bucket(bucket: np.ndarray):
    """(bucket, places) of each."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.nonzero(np.diff(bucket[order]))[0] + 1
    return [(int(bucket[at[0]]), at) for at in np.split(order, cuts) if len(at)]


def doc_block(docs: np.ndarray, hists: list[bytes]) -> bytes:
    return len(docs).to_bytes(4, "little") + docs.tobytes() + b"".join(hists)


def read_doc_block(block: bytes) -> tuple[np.ndarray, list[bytes]]:
    docs = np.frombuffer(block, DOC, int.from_bytes(block[:4], "little"), 4)
    ends = 4 + docs.nbytes + np.cumsum(docs["bytes"].astype(np.int64))
    return docs, [block[e - n:e] for e, n in zip(ends.tolist(), docs["bytes"].tolist(), strict=True)]


def find_signatures(buckets: int, frequent: np.ndarray):
    """Signature and document blocks, where documents are read."""
    def flush(sig: list, name: list) -> list[tuple]:
        sig, name = np.concatenate(sig), np.concatenate(name)
        order = np.lexsort((sig, name))
        sig, name = sig[order], name[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])
        out = np.empty(int(new.sum()), SIG)
        out["sig"], out["class"] = sig[new] >> np.uint64(32), name[new]
        bucket = ((sig[new] & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32)
        return [("sig", b, out[at].tobytes()) for b, at in by_bucket(bucket)]

    def run(batches):
        sigs, names, n = [], [], 0
        for b, texts in slices(batches):
            of, key = shingle_sets(texts)
            size, name = classes(of, key, len(texts))
            _, first = np.unique(name, return_index=True)  # equal sets sign once
            sign = np.zeros(len(texts), bool)
            sign[first] = size[first] > 0
            hists = [h if s else b"" for h, s in zip(histograms(of, key, size), sign.tolist(), strict=True)]
            docs = np.empty(len(texts), DOC)
            docs["id"], docs["xx"] = b.column("id").to_numpy(), b.column("xx").to_numpy()
            docs["n"], docs["class"], docs["bytes"] = size, name, [len(h) for h in hists]
            yield block_batch([("doc", bucket, doc_block(docs[at], [hists[i] for i in at]))
                               for bucket, at in by_bucket((docs["xx"] % buckets).astype(np.int32))])
            of, key = of[sign[of]], key[sign[of]]
            owner, sig = signatures(of, key, np.where(sign, size, 0), frequent)
            sigs.append(sig)
            names.append(name[owner])
            n += len(sig)
            if n >= GATHERED:
                yield block_batch(flush(sigs, names))
                sigs, names, n = [], [], 0
        if n:
            yield block_batch(flush(sigs, names))

    return run


def form_groups(table: pa.Table) -> pa.Table:
    """(centre, class) of all classes that share a signature with a smaller one, the
    smallest being the centre; document blocks pass through."""
    rows, blocks = [], []
    for kind, bucket, block in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "block")),
                                   strict=True):
        if kind == "doc":
            rows.append((kind, bucket, block))
        else:
            blocks.append(np.frombuffer(block, SIG))
    if blocks:
        a = np.concatenate(blocks)
        order = np.lexsort((a["class"], a["sig"]))
        sig, name = a["sig"][order], a["class"][order]
        opens = np.ones(len(sig), bool)
        opens[1:] = sig[1:] != sig[:-1]
        centre = name[np.nonzero(opens)[0]][np.cumsum(opens) - 1]
        other = name != centre
        out = np.empty(int(other.sum()), MEMBER)
        out["centre"], out["class"] = centre[other], name[other]
        rows.append(("group", 0, np.unique(out).tobytes()))
        del a, order, sig, name, opens, centre, other, out, blocks
    give_back()
    return pa.Table.from_batches([block_batch(rows)])


def doc_rows_of(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for block in b.column("block").to_pylist():
                docs, hists = read_doc_block(block)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.ascontiguousarray(docs[k])) for k in ("id", "xx", "n", "class")),
                     pa.array(hists, pa.binary())], names=["id", "xx", "n", "class", "hist"])

    return map_arrow(blocks.where("kind = 'doc'").select("block"), run,
                     "id long, xx long, n int, class long, hist binary")


def members_of(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for block in b.column("block").to_pylist():
                a = np.frombuffer(block, MEMBER)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a[k])) for k in MEMBER.names],
                                                 names=list(MEMBER.names))

    return map_arrow(blocks.where("kind = 'group'").select("block"), run, "centre long, class long").distinct()


# -- pairs -------------------------------------------------------------------------------------
def close(hist_a: list[bytes], hist_b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether each pair's histograms leave a link possible."""
    out = np.ones(len(hist_a), bool)
    most = most_different(n_a.astype(np.int64), n_b.astype(np.int64))
    size = np.array([(len(x), len(y)) for x, y in zip(hist_a, hist_b, strict=True)], np.int64).reshape(-1, 2)
    for x, y in np.unique(size, axis=0).tolist():
        if x and y:
            every = np.nonzero((size[:, 0] == x) & (size[:, 1] == y))[0]
            step = max(1, 4_000_000 // max(x, y))
            for at in (every[lo:lo + step] for lo in range(0, len(every), step)):
                bins = 2 * min(x, y)
                a, b = bin_rows([hist_a[i] for i in at], bins), bin_rows([hist_b[i] for i in at], bins)
                out[at] = np.abs(a - b).sum(axis=1) <= most[at]
    return out


def near_enough(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose sizes and histograms leave a link possible."""
    left = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("hist").alias("h_a"))
    right = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("hist").alias("h_b"))
    sized = pairs.join(left, "a").join(right, "b") \
        .where((4 * F.col("n_a") >= 3 * F.col("n_b")) & (4 * F.col("n_b") >= 3 * F.col("n_a")))

    def run(batches):
        for b in batches:
            ok = close(*(b.column(c).to_pylist() for c in ("h_a", "h_b")),
                       *(b.column(c).to_numpy() for c in ("n_a", "n_b")))
            yield b.select(["a", "b"]).take(pa.array(np.nonzero(ok)[0]))

    return map_arrow(sized.select("a", "b", "n_a", "n_b", "h_a", "h_b"), run, "a long, b long")


def linked(texts_a: list[bytes], texts_b: list[bytes]) -> np.ndarray:
    """Whether each pair of texts links, by their whole sets."""
    names: dict[bytes, int] = {}
    at = [np.array([names.setdefault(t, len(names)) for t in texts], np.int64) for texts in (texts_a, texts_b)]
    of, key = shingle_sets(list(names))
    size = np.bincount(of, minlength=len(names))
    first = np.cumsum(size) - size
    n = len(texts_a)
    pair = np.concatenate([np.repeat(np.arange(n), size[x]) for x in at])
    place = np.concatenate([np.repeat(first[x] - (np.cumsum(size[x]) - size[x]), size[x])
                            + np.arange(size[x].sum()) for x in at])
    key = key[place]
    order = np.lexsort((key, pair))
    pair, key = pair[order], key[order]
    same = (pair[1:] == pair[:-1]) & (key[1:] == key[:-1])
    both = np.bincount(pair[1:][same], minlength=n)
    return 100 * both >= 75 * (size[at[0]] + size[at[1]] - both)


def check_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that link.  Rows stream with both texts, so no task holds a group."""
    rows = pairs.join(texts.select(F.col("class").alias("b"), F.col("text").alias("t_b")), "b") \
        .join(texts.select(F.col("class").alias("a"), F.col("text").alias("t_a")), "a")

    def run(batches):
        for whole in batches:
            for b, texts_a in slices([whole], "t_a", most=512):
                ok = linked(texts_a, b.column("t_b").cast(pa.binary()).to_pylist())
                yield b.select(["a", "b"]).take(pa.array(np.nonzero(ok)[0]))

    return map_arrow(rows.select("a", "b", "t_a", "t_b"), run, "a long, b long")


def pairs_between(table: pa.Table) -> pa.Table:
    """Pairs of classes of one group, in different components, that sizes and
    histograms leave possible; a pair that several groups hold is given by the one
    with the smallest centre.  Several groups come at once; of a large one, two
    blocks."""
    give_back()
    centre, name, comp, n, block, low, high = (table.column(c).to_numpy() for c in (
        "centre", "class", "comp", "n", "block", "low", "high"))
    hist, centres = table.column("hist").to_pylist(), table.column("centres").to_pylist()
    order = np.lexsort((n, centre))
    found = [np.zeros((0, 2), np.int64)]
    for at in np.split(order, np.nonzero(np.diff(centre[order]))[0] + 1):
        stop = np.searchsorted(n[at], n[at] * 4 // 3, "right")  # sizes that can link, in order of size
        for lo in range(0, len(at), 256):
            rows = np.arange(lo, min(lo + 256, len(at)))
            i = np.repeat(rows, stop[rows] - rows)
            j = i + np.arange(len(i)) - np.searchsorted(i, i)
            x, y = at[i], at[j]
            on = (comp[x] != comp[y]) & ((low[x] == high[x]) | (block[x] != block[y]))
            x, y = x[on], y[on]
            for k in range(0, len(x), 50_000):
                a, b = x[k:k + 50_000], y[k:k + 50_000]
                ok = close([hist[i] for i in a], [hist[i] for i in b], n[a], n[b])
                a, b = a[ok], b[ok]
                own = np.array([min(set(centres[i]).intersection(centres[j])) == c for i, j, c in zip(
                    a.tolist(), b.tolist(), centre[a].tolist(), strict=True)], bool)
                a, b = name[a[own]], name[b[own]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


# -- components ----------------------------------------------------------------------------------
def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(class, comp) of every linked class; comp is the smallest class reached.
    Large-star and small-star steps until all edges form stars.  ``known``:
    components found before, of other links; only theirs are joined then."""
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if known is not None:
        for end in ("u", "v"):
            edges = edges.join(known.select(F.col("class").alias(end), "comp"), end, "left") \
                .withColumn(end, F.coalesce("comp", end)).select("u", "v")
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "links")
    while True:
        ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("v", F.lit(0), F.lit(1)))
        mixed_ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
            .where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0))
        if not mixed_ends.limit(1).count():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored(small, "stars")
    stars = edges.select(F.col("u").alias("class"), F.col("v").alias("comp"))
    if known is not None:  # a class of a known component follows that
        moved = known.join(stars.select(F.col("class").alias("comp"), F.col("comp").alias("to")), "comp", "left") \
            .select("class", F.coalesce("to", "comp").alias("comp"))
        stars = moved.unionByName(stars.join(known.select("class"), "class", "left_anti"))
    return stars.unionByName(stars.select(F.col("comp").alias("class"), "comp")).distinct()


def frequent_shingles(rows: DataFrame, total: int) -> np.ndarray:
    """Marks of shingles found in a ``FREQUENT`` share of a bounded sample of
    documents (texts up to 64 KB, about SAMPLE_BYTES in all; copies of a text come as
    one with their number)."""
    texts, times = sampled_texts(rows, max(1, total // SAMPLE_BYTES))
    marks, counts = np.zeros(1 << 20, bool), np.zeros(1 << 20)
    sample = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(times)], names=["text", "n"])
    for b, some in slices([sample]):  # this runs on the driver: the arrays of one step at a time
        of, key = shingle_sets(some)
        once = np.unique(of << 20 | (key >> np.uint64(44)).astype(np.int64))
        counts += np.bincount(once & ((1 << 20) - 1), b.column("n").to_numpy()[once >> 20], minlength=1 << 20)
    if texts:
        marks[counts >= max(4, FREQUENT * times.sum() + 4 * np.sqrt(counts.mean()))] = True
    give_back()
    return marks


#: Rows of an Arrow batch that holds texts.
TEXT_ROWS = 500
#: Rows of (id, hash, class) that may be broadcast to fetch texts: some 10 MB.
MAX_BROADCAST = 300_000


def texts_of(pairs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(class, text) of every class in ``pairs``, from one document of each."""
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))) \
        .distinct().join(sets, "class").select("class", "id", "xx")
    wanted = stored(wanted, "wanted")
    if wanted.count() <= MAX_BROADCAST:
        wanted = F.broadcast(wanted)
    found = rows.select("id", "xx", "text").join(wanted, ["id", "xx"])
    return stored(found.groupBy("class").agg(F.max("text").alias("text")), "texts")


def _link(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all documents (id, xx, n, class, hist), and (class, comp) of every
    linked class."""
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = int(min(MAX_BUCKETS, max(16, total // BUCKET_BYTES)))
    blocks = map_arrow(rows, find_signatures(buckets, frequent_shingles(rows, total)), BLOCKS, alone=True)
    found = stored(blocks.groupBy("bucket").applyInArrow(form_groups, BLOCKS), "groups")
    doc_rows = doc_rows_of(found)
    members = stored(members_of(found), "members")
    in_groups = members.select("class").union(members.select("centre")).distinct()
    sets = doc_rows.groupBy("class").agg(
        F.min(F.struct((F.length("hist") == 0).alias("bare"), "id", "xx", "n", "hist")).alias("r"))
    sets = stored(sets.join(in_groups, "class", "left_semi").select("class", "r.id", "r.xx", "r.n", "r.hist"),
                  "sets")
    comps, tested = None, None

    def test(pairs: DataFrame, possible: bool = False) -> None:
        """Test pairs not tested before, and join the components of those that link.
        ``possible``: sizes and histograms have been compared."""
        nonlocal comps, tested
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        near = pairs if possible else stored(near_enough(pairs, sets), "near")
        found = check_links(near, texts_of(near, sets, rows))
        comps = stored(components(stored(found, "linked"), comps), "components")
        tested = pairs if tested is None else tested.unionByName(pairs)

    test(members.select(F.col("centre").alias("a"), F.col("class").alias("b")))
    sizes = members.groupBy("centre").agg(F.count("*").alias("size")).where("size > 1")
    several = stored(members.join(sizes, "centre"), "several")  # pairs with the centre are done
    for turn in range(CENTRES + 1):
        named = several.join(comps, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
        split = named.groupBy("centre").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.min_by(F.struct("class", "comp"), F.xxhash64("class", F.lit(turn))).alias("next"))
        named = stored(named.join(split.where("low <> high").select("centre", "next"), "centre"), "split")
        large = named.where((F.col("size") >= LARGE) & (F.col("comp") != F.col("next.comp")))
        if turn == CENTRES or not large.limit(1).count():
            break
        test(large.select(F.col("next.class").alias("a"), F.col("class").alias("b")))
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    # a class has at most as many centres as signatures
    held = named.groupBy("class").agg(F.collect_set("centre").alias("centres"))
    blocked = (named.join(held, "class").join(sets.select("class", "n", "hist"), "class")
               .withColumn("block", F.pmod(F.xxhash64("class"), parts).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
               .select("centre", "class", "comp", "n", "hist", "centres", "block",
                       F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                       F.when((parts > 1) | (F.col("size") >= LARGE), F.col("centre"))
                       .otherwise(F.pmod(F.xxhash64("centre"), F.lit(4 * buckets))).alias("task")))
    test(blocked.groupBy("task", "low", "high").applyInArrow(pairs_between, "a long, b long"), possible=True)
    return doc_rows, comps


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable
    by links), class_id (equal sets share it; NULL for an empty set)."""
    spark = docs.sparkSession
    importable(spark)
    text = text_or_empty(text_col)
    nothing = F.lit(-2 ** 63)
    rows = docs.select(F.coalesce(col(id_col).cast("long"), nothing).alias("id"),
                       F.xxhash64(text).alias("xx"), text.alias("text"))
    with arrow_rows(spark, TEXT_ROWS):
        doc_rows, comps = _link(rows)
    named = doc_rows.select(F.when(F.col("id") != nothing, F.col("id")).alias("id"), "n",
                            F.when(F.col("n") > 0, F.col("class")).alias("class"))
    empty = named.where("n = 0").select("id", "n", F.col("id").alias("component_id"), "class")
    named = named.where("n > 0").join(comps, "class", "left") \
        .withColumn("comp", F.coalesce("comp", "class"))
    first = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    out = named.join(first, "comp").select("id", "n", "component_id", "class").unionByName(empty)
    kind = docs.select(col(id_col)).schema[0].dataType
    return out.select(F.col("id").cast(kind).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      F.col("component_id").cast(kind).alias("component_id"),
                      F.col("class").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id.  Rows
    with a NULL id stay; rows that share an id stay or go together."""
    found = near_duplicates(docs, text_col, id_col)
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    if gone.count() <= MAX_BROADCAST:
        gone = F.broadcast(gone)
    rows = docs.select(col(id_col).alias("id"), row_struct(docs).alias("row"))
    return unpack(rows.join(gone, "id", "left_anti"), "row", docs.columns)

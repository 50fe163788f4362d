"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A (a ``tokenizers`` file, byte-level BPE) reads a space and the text,
tokenizer B (a ``sentencepiece`` model, which adds the space) the text.  The byte ranges
of their tokens come from the tokenizers' own spans: the character offsets of A and the
begin and end of B's pieces are coarse cuts, exact wherever a span is as wide as the
token's bytes; tokens that share a character (its bytes fall on several tokens of A, or
on byte-fallback tokens of B) are refined by the token's decoded bytes.  Whether tokens
give their texts back is seen on the decoded bytes of many lines at once.  Offsets where
both have an end cut the tokens into groups; two tokens are linked when their ranges
overlap.  (The installed sentencepiece names the immutable proto plainly ``proto``; it
carries the same spans.)

Neither tokenizer merges across a single space between other characters: A splits
there before it merges, and no piece of B has a space after another character.  Texts
are therefore cut there into chunks, whole words most of the time, and a block of texts
tokenizes each chunk once.  Where a file allows such merges (checked when it is loaded)
a text is one chunk.

Plan: a task turns about ``BLOCK_BYTES`` of texts into one row with the pairs of ids its
links hold and their counts, and a row for each document, a list of chunks.  Spark adds the
pairs up over the corpus, finds each B id's highest count (at most one row for each id
of B's vocabulary, so it is broadcast), and joins the counts back to the blocks by
pair.  A block holds each of its pairs once, so a pair that every document holds is one
row of a block, not of a document; what is joined, shuffled and held grows with the
blocks and is bounded for each of them.

Rows: NULL and empty texts, and texts that the joined tokens do not give back (B reads
U+2581 as a space), have no tokens.  Strings of special tokens are plain text.  Rows
that repeat, share an id or have none are rows of their own.  An empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import gc
import hashlib
import itertools
import json
import operator
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import gather
from .common import arrow_rows, col, importable, stored, text_or_empty

#: About so many bytes of texts share one row of pairs; a longer text has its own.
BLOCK_BYTES = 4_000_000
#: Characters of chunks tokenized together, about.
LINE = 2_000
#: A chunk starts at one space between two other characters.
CHUNK = re.compile(r"(?<=\S)(?= \S)")
#: White space, as the patterns have it.
WHITE = [chr(i) for i in range(0x3001) if chr(i).isspace()]
#: Chunks that may follow each other in one line.
WHOLE = re.compile(r" \S(?:.*\S)?", re.DOTALL)
#: sentencepiece's space mark and byte tokens.
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
NORMAL_PIECE, BYTE_TYPE = 1, 6
ID_AND_END = operator.attrgetter("id", "end")
ID_BITS = 32


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable bytes stand
    for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def refined_ends(coarse: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes: ``coarse`` has (start, end) of every span.  A span as wide
    as its token's bytes is taken as it is; a run of others is cut by their sizes, from
    the last end before it."""
    start, end = coarse[:, 0], coarse[:, 1]
    exact = end - start == size
    if exact.all():
        return end.copy()
    total = np.cumsum(size)
    # the end of the last exact token before each, and how many bytes follow it
    last = np.maximum.accumulate(np.where(exact, np.arange(len(size)), -1))
    base = np.where(last >= 0, end[last] - total[last], 0)
    return base + total


def _flat(lists, n: int = -1) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, n)


def _starts(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter(sizes, np.int64))])


class Tokens:
    """The tokens of some lines, one after the other: ids, ends in bytes, and how many
    tokens and bytes lie before each line.  Without ends if not all lines are ``spelled``."""

    def __init__(self, tool: Aligner, lines: list[str], ours: list, theirs: list):
        raw = [line.encode() for line in lines]
        self.bytes = _starts(map(len, raw))
        self.buf = np.frombuffer(b"".join(raw), np.uint8)
        pieces = [t.pieces for t in theirs]
        self.a_first, self.b_first = _starts(map(len, ours)), _starts(map(len, pieces))
        self.a_ids = _flat((x.ids for x in ours), self.a_first[-1])
        rows = _flat(map(ID_AND_END, itertools.chain.from_iterable(pieces)), 2 * self.b_first[-1]).reshape(-1, 2)
        self.b_ids = rows[:, 0].copy()
        self.spelled = self._spell(*tool.a_spelling, self.a_ids, self.a_first) \
            and self._spell(*tool.b_spelling, self.b_ids, self.b_first)
        if not self.spelled:
            return
        # character offsets of A as bytes of all lines: a character starts at every byte
        # that continues none
        self.chars = np.append(np.flatnonzero((self.buf & 0xC0) != 0x80), len(self.buf))
        spans = _flat(itertools.chain.from_iterable(x.offsets for x in ours), 2 * self.a_first[-1])
        spans = self.chars[spans.reshape(-1, 2) + np.repeat(_starts(map(len, lines))[:-1],
                                                            np.diff(self.a_first))[:, None]]
        self.a_ends = refined_ends(spans, tool.a_size[self.a_ids])
        # B's spans lie in the text, without the space that it adds, each from the end of
        # the one before
        ends = rows[:, 1] + 1 + np.repeat(self.bytes[:-1], np.diff(self.b_first))
        begins = np.concatenate([[0], ends[:-1]])[:len(ends)]
        begins[self.b_first[:-1]] = self.bytes[:-1]
        self.b_ends = refined_ends(np.stack([begins, ends], axis=1), tool.b_size[self.b_ids])

    def _spell(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray,
               first: np.ndarray) -> bool:
        """Whether the ids spell every line byte for byte: all lines together, and each as
        many bytes as it has."""
        upto = np.concatenate([[0], np.cumsum(size[ids])])
        return np.array_equal(upto[first], self.bytes) \
            and np.array_equal(gather(letters, start[ids], size[ids]), self.buf)


class Links:
    """Groups and links of chunks that lie one after the other in some tokens, which
    both end with every chunk."""

    def __init__(self, tool: Aligner, tokens: Tokens, ends: np.ndarray):
        a, a_ends, b, b_ends = tokens.a_ids, tokens.a_ends, tokens.b_ids, tokens.b_ends
        every = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")    # two runs in order
        again = every[1:] == every[:-1]
        both = every[1:][again]
        cuts = every[np.concatenate([[True], ~again])[:len(every)]]     # each stretch between cuts is one link
        self.pairs = a[np.searchsorted(a_ends, cuts)] << ID_BITS | b[np.searchsorted(b_ends, cuts)]
        upto = [np.searchsorted(x, ends, side="right") for x in (a_ends, b_ends, both, cuts)]
        self.sizes = np.diff(np.array(upto), prepend=0)        # n_a, n_b, n_groups, n_links of each chunk
        # written groups: an id ends with ',' inside its group, A's last with '|', B's with ';'
        a_group, b_group = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        a_text = tool.a_text[(both[a_group] == a_ends).astype(int), a]
        b_text = tool.b_text[(both[b_group] == b_ends).astype(int), b]
        by_group = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        written = np.concatenate([a_text, b_text])[by_group]
        width = written.dtype.itemsize
        letters = np.frombuffer(written.tobytes(), np.uint8)
        kept = letters[letters != 0].tobytes()
        at = np.concatenate([[0], np.cumsum((letters != 0).reshape(-1, width).sum(axis=1))])
        at = at[np.concatenate([[0], upto[0] + upto[1]])]
        self.groups = [kept[i:j] for i, j in itertools.pairwise(at.tolist())]


class Aligner:
    """Both tokenizers."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        settings = json.loads(a_file)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) \
                else token.encode()
        split_a = settings["normalizer"] is None and settings["pre_tokenizer"]["type"] == "ByteLevel" \
            and settings["pre_tokenizer"].get("use_regex", True)

        model = sentencepiece_model_pb2.ModelProto.FromString(b_file)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.b_bytes = [bytes([int(BYTE_PIECE.fullmatch(p.piece)[1], 16)]) if p.type == BYTE_TYPE
                        else p.piece.replace(SPACE_MARK, " ").encode() for p in model.pieces]
        split_b = not model.normalizer_spec.precompiled_charsmap \
            and not model.normalizer_spec.remove_extra_whitespaces \
            and not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p.piece) for p in model.pieces) \
            and all(p.type in (NORMAL_PIECE, BYTE_TYPE, 2, 3) for p in model.pieces)
        self.splits = split_a and split_b
        self.a_size = np.array([len(b) for b in self.a_bytes])
        self.b_size = np.array([len(b) for b in self.b_bytes])
        self.a_spelling, self.b_spelling = (
            (np.frombuffer(b"".join(x), np.uint8), np.cumsum(n) - n, n)
            for x, n in ((self.a_bytes, self.a_size), (self.b_bytes, self.b_size)))
        self.a_text = np.array([[b"%d%s" % (i, end) for i in range(len(self.a_bytes))] for end in (b",", b"|")])
        self.b_text = np.array([[b"%d%s" % (i, end) for i in range(len(self.b_bytes))] for end in (b",", b";")])

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut where neither tokenizer merges."""
        if not self.splits:
            return [" " + text]
        for s in WHITE:
            if s in text and (s + " " in text or " " + s in text or text[0] == s or text[-1] == s):
                return CHUNK.split(" " + text)
        return [" " + word for word in text.split(" ")]  # every space is such a cut

    def tokens(self, lines: list[str]) -> tuple[Tokens, list[bool]]:
        """The tokens of the lines that both tokenizers give back byte for byte, and
        which those are.  A line is a space and a text."""
        ours = self.a.encode_batch(lines, add_special_tokens=False)
        theirs = self.b.encode([line[1:] for line in lines], return_type="proto", num_threads=1)
        found = Tokens(self, lines, ours, theirs)
        if found.spelled:
            return found, [True] * len(lines)
        good = []
        for line, a, b in zip(lines, ours, theirs, strict=True):
            raw = line.encode()
            good.append(b"".join(map(self.a_bytes.__getitem__, a.ids)) == raw
                        and b"".join([self.b_bytes[p.id] for p in b.pieces]) == raw)
        return Tokens(self, *(list(itertools.compress(x, good)) for x in (lines, ours, theirs))), good

    def links(self, chunks: list[str]) -> Iterator[tuple[list[int], Links]]:
        """(numbers of chunks, their links), a few lines at a time.  Chunks that neither
        tokenizer would merge are put into one line; those missing in the end are not
        given back by a tokenizer."""
        lines: list[list[int]] = [[]]
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        length, whole = 0, False
        for i, c in enumerate(chunks):
            joins = WHOLE.fullmatch(c) is not None
            if lines[-1] and (not joins or not whole or length > LINE):
                lines.append([])
                length = 0
            lines[-1].append(i)
            length, whole = length + len(c), joins and self.splits
        waiting = [line for line in lines if line][::-1]
        while waiting:
            some, length = [], 0
            while waiting and length < LINE * 100:
                some.append(waiting.pop())
                length += int(sizes[some[-1]].sum())
            tokens, good = self.tokens(["".join([chunks[i] for i in line]) for line in some])
            if not all(good):
                # alone, the chunks of a bad line that are good themselves
                kept = list(itertools.compress(some, good))
                parts = [[i] for line, g in zip(some, good, strict=True) if not g and len(line) > 1 for i in line]
                waiting += [line for line in kept + parts][::-1]
                continue
            used = [i for line in some for i in line]
            yield used, Links(self, tokens, tokens.chars[np.cumsum(sizes[used])])


_ALIGNERS: dict[int, Aligner] = {}


def aligner(a_file: bytes, b_file: bytes) -> Aligner:
    """One for each worker and pair of files."""
    key = hash((a_file, b_file))
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_file, b_file)
    return _ALIGNERS[key]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about BLOCK_BYTES of texts; a longer text comes alone."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            n = len(t)
            if ids and size + n > BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += n
    if ids:
        yield ids, texts


class Block:
    """The chunks of some texts, each aligned once.  ``docs`` has the chunks of each text
    as numbers in the order they were aligned in; none for a text without tokens."""

    def __init__(self, tool: Aligner, texts: list[str]):
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        cut = (tool.chunks(t) if t else [] for t in texts)
        docs = [np.fromiter(map(number.__getitem__, c), np.int64, len(c)) for c in cut]
        place, self.groups = np.full(len(number), -1), []
        sizes, pairs = [np.zeros((4, 0), np.int64)], [np.zeros(0, np.int64)]
        for used, links in tool.links(list(number)):
            place[used] = np.arange(len(used)) + len(self.groups)
            self.groups += links.groups
            sizes.append(links.sizes)
            pairs.append(links.pairs)
        self.docs = [place[d] for d in docs]
        self.docs = [d if (d >= 0).all() else d[:0] for d in self.docs]
        self.sizes = np.concatenate(sizes, axis=1)
        self.first = _starts(self.sizes[3])
        used = np.bincount(np.concatenate([*self.docs, np.zeros(0, np.int64)]), minlength=len(self.groups))
        self.pairs, self.at = np.unique(np.concatenate(pairs), return_inverse=True)
        self.times = np.bincount(self.at, weights=np.repeat(used, self.sizes[3]),
                                 minlength=len(self.pairs)).astype(np.int64)

    def documents(self) -> dict[str, list]:
        out = {k: [] for k in ("n_a", "n_b", "n_groups", "groups_sha256")}
        for d in self.docs:
            n_a, n_b, n_groups, _ = self.sizes[:, d].sum(axis=1).tolist()
            out["n_a"].append(n_a)
            out["n_b"].append(n_b)
            out["n_groups"].append(n_groups)
            text = b"".join([self.groups[i] for i in d.tolist()])[:-1]
            out["groups_sha256"].append(hashlib.sha256(text).hexdigest() if len(d) else "")
        return out


def _ints(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))


def _blocks(data, id_type: pa.DataType):
    """``mapInArrow`` body: for each block of texts one row with its pairs and one row
    for each document."""
    def run(batches):
        tool, number = aligner(*data.value), TaskContext.get().partitionId() << 32
        for ids, texts in _texts(batches):
            # spans are many small tuples without cycles: no use in searching them for any
            gc.disable()
            try:
                block = Block(tool, texts)
                docs, n = block.documents(), len(ids)
            finally:
                gc.enable()
            own = {"pair": pa.array(block.pairs), "times": pa.array(block.times),
                   "first": pa.array(block.first.astype(np.int32)), "at": pa.array(block.at.astype(np.int32))}
            # the arrays of the block stand in the first row, the documents in the others
            own = {k: pa.ListArray.from_arrays(pa.array([0] + [len(v)] * (n + 1), pa.int32()), v)
                   for k, v in own.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * (n + 1), pa.int64()), pa.array([False] + [True] * n),
                 pa.array([None, *ids], id_type),
                 *[pa.array([0, *docs[k]], pa.int64()) for k in ("n_a", "n_b", "n_groups")],
                 pa.array(["", *docs["groups_sha256"]], pa.string()), _ints([np.zeros(0), *block.docs]),
                 *own.values()],
                names=["block", "is_doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "chunks", *own])
            number += 1
    return run


def _count(block: pa.Table, known: pa.Table) -> pa.Table:
    """Cogroup body: one block and the corpus counts of its pairs -> its documents."""
    order = np.argsort(known.column("pair").to_numpy())
    n, best = known.column("n").to_numpy()[order], known.column("best").to_numpy(zero_copy_only=False)[order]
    is_doc = block.column("is_doc").to_numpy(zero_copy_only=False)
    row = block.slice(int(np.flatnonzero(~is_doc)[0]), 1)
    first, at = (row.column(c)[0].values.to_numpy() for c in ("first", "at"))
    docs = block.filter(pa.array(is_doc)).combine_chunks()
    chunks = docs.column("chunks").combine_chunks()
    ends = chunks.offsets.to_numpy() - chunks.offsets[0].as_py()
    listed = chunks.flatten().to_numpy()
    totals = []
    # running sums over the links of all chunks give each chunk's, and those each document's
    for x in (np.ones(len(n), np.int64), best.astype(np.int64), n):
        upto = np.concatenate([[0], np.cumsum(x[at])])
        upto = np.concatenate([[0], np.cumsum((upto[first[1:]] - upto[first[:-1]])[listed])])
        totals.append(pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64()))
    return pa.table([*[docs.column(c) for c in REPORT[:4]], *totals, docs.column("groups_sha256")], names=REPORT)


TOKENS = pa.struct([("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())),
                    ("cuts", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("byte", pa.int32())])))])
REPORT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Alignment:
    """Both tokenizers over ``docs``: :meth:`tokens`, :meth:`pair_counts`, :meth:`report`."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, text_col: str = "text",
                 id_col: str = "doc_id"):
        self.spark = docs.sparkSession
        importable(self.spark)
        files = []
        for path in (a_path, b_path):
            with open(path, "rb") as f:
                files.append(f.read())
        self.data = self.spark.sparkContext.broadcast(tuple(files))
        self.rows = docs.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
        self.id_type = self.rows.schema["doc_id"].dataType.simpleString()
        self._blocks = self._counts = None

    def tokens(self) -> DataFrame:
        """doc_id, a_ids, b_ids, and where both end: cuts array<struct<a,b,byte>>
        (tokens of A, tokens of B and bytes before the cut)."""
        data = self.data

        def run(batches):
            tool = aligner(*data.value)
            for batch in batches:
                rows = []
                for text in batch.column("text").to_pylist():
                    t, _ = tool.tokens([" " + text] if text else [])
                    both = np.intersect1d(t.a_ends, t.b_ends)
                    cuts = zip(np.searchsorted(t.a_ends, both) + 1, np.searchsorted(t.b_ends, both) + 1, both,
                               strict=True)
                    rows.append({"a_ids": t.a_ids.tolist(), "b_ids": t.b_ids.tolist(),
                                 "cuts": [{"a": int(x), "b": int(y), "byte": int(z)} for x, y, z in cuts]})
                whole = pa.array(rows, TOKENS)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *whole.flatten()],
                                                 names=["doc_id", "a_ids", "b_ids", "cuts"])

        return self.rows.mapInArrow(run, f"doc_id {self.id_type}, a_ids array<int>, b_ids array<int>, "
                                         "cuts array<struct<a:int,b:int,byte:int>>")

    def blocks(self) -> DataFrame:
        if self._blocks is None:
            from pyspark.sql.pandas.types import to_arrow_type

            made = self.rows.mapInArrow(
                _blocks(self.data, to_arrow_type(self.rows.schema["doc_id"].dataType)),
                f"block long, is_doc boolean, doc_id {self.id_type}, n_a long, n_b long, n_groups long, "
                "groups_sha256 string, chunks array<int>, "
                "pair array<long>, times array<long>, first array<int>, at array<int>")
            with arrow_rows(self.spark, 500):
                self._blocks = stored(made, "alignment")
        return self._blocks

    def pair_counts(self) -> DataFrame:
        """a_id, b_id, n (links corpus-wide), best (n is the highest of its B id)."""
        if self._counts is None:
            entries = self.blocks().where("not is_doc").select(F.explode(F.arrays_zip("pair", "times")).alias("e"))
            # pairs of texts that hold no link count 0 times: they are left out
            counts = entries.where("e.times > 0").groupBy(F.col("e.pair").alias("pair")) \
                .agg(F.sum("e.times").alias("n"))
            counts = stored(counts.select(
                F.shiftright("pair", ID_BITS).cast("int").alias("a_id"),
                F.col("pair").bitwiseAND((1 << ID_BITS) - 1).cast("int").alias("b_id"), "n"), "pair-counts")
            # one row for each id of B at most
            top = F.broadcast(counts.groupBy("b_id").agg(F.max("n").alias("most")))
            self._counts = counts.join(top, "b_id").select(
                "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))
        return self._counts

    def report(self) -> DataFrame:
        """The columns of ``REPORT`` for every row."""
        blocks = self.blocks()
        pair = F.shiftleft(F.col("a_id").cast("long"), ID_BITS).bitwiseOR(F.col("b_id").cast("long"))
        counts = self.pair_counts().select(pair.alias("pair"), "n", "best")
        used = blocks.where("not is_doc").select(F.col("block").alias("of"), F.explode("pair").alias("pair"))
        known = used.join(counts, "pair", "left").select(
            "of", "pair", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("best", F.lit(False)).alias("best"))
        return blocks.drop("pair", "times").groupBy("block") \
            .cogroup(known.groupBy("of")).applyInArrow(
                _count, f"doc_id {self.id_type}, n_a long, n_b long, n_groups long, n_links long, "
                        "n_best long, count_sum long, groups_sha256 string")

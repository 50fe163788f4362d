"""Byte-pair encoding and decoding by per-prefix dynamic programming.

For every prefix of a pre-token there is exactly one token that can end its
encoding.  A suffix automaton over the vocabulary (a trie of the reversed
tokens) lists the tokens that end at each position; a token ``t`` of length
``n`` is the one if the last token of the prefix ``n`` bytes shorter is
*compatible* with it, that is, if the two stay apart when their joined bytes are
encoded.  The last tokens are stored per prefix and the back-pointers followed.

The pair test undoes merges from the top: the younger of the two edge tokens is
split until both are single bytes, and at each state the pair at the border must
not be a merge older than the one undone last (the left one wins ties).

Work runs in ``mapInArrow`` tasks: distinct chunks of a batch are encoded together
in numpy, position by position over all chunks; pre-tokens longer than
``LONG_BYTES`` use the same steps one by one.  Chunks seen before are looked up
(a bounded table per worker).  The vocabulary file (about 2 MB whatever the data)
is broadcast.

Defined cases: a NULL text counts as empty and has no ids; the strings of added
tokens are found in texts and get their own ids; texts of any length are encoded
whole; repeated rows and ids give equal rows; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import CACHES, col, map_arrow, text_or_empty

#: Fixed value: the pre-token pattern of byte-level BPE (use_regex).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LONG_BYTES = 48
#: Chunks remembered by a worker; beyond it the table starts anew.
REMEMBERED = 800_000
NONE = -1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class IntTable:
    """Open-addressing map from non-negative int64 keys to ints, looked up by arrays."""

    def __init__(self, entries: dict[int, int]):
        bits = max(4, (4 * len(entries)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, NONE, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        keys = np.fromiter(entries.keys(), np.int64, len(entries))
        values = np.fromiter(entries.values(), np.int32, len(entries))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == NONE
            _, first = np.unique(slot, return_index=True)
            put = np.zeros(len(keys), bool)
            put[first] = True
            put &= free
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.nonzero((found != keys) & (found != NONE))[0]
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            found = self.keys[slot]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (found != NONE)
            open_, slot = open_[on], slot[on]
        return out


def gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[start:start + count] of each pair, one after another."""
    ends = np.cumsum(count)
    return flat[np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]


class Codec:
    def __init__(self, tokenizer_json: bytes):
        spec = json.loads(tokenizer_json)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        # merge rank of each token (single bytes: -1) and the two halves it was made of
        self.rank = np.full(size, -1, np.int32)
        self.left, self.right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        pairs = {}
        for rank, (a, b) in enumerate(merges):
            made, a, b = vocab[a + b], vocab[a], vocab[b]
            pairs[a << 20 | b] = rank
            if self.rank[made] < 0 and len(self.token_bytes[made]) > 1:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        self.pair_rank, self.pairs = IntTable(pairs), pairs
        self.single = np.full(256, NONE, np.int32)
        steps: dict[int, int] = {}
        ends = [NONE]
        for token, i in vocab.items():
            raw = self.token_bytes[i]
            if len(raw) == 1:
                self.single[raw[0]] = i
            elif self.rank[i] < 0:
                continue  # no merge makes it
            state = 0
            for byte in reversed(raw):
                key = state << 8 | byte
                if key not in steps:
                    steps[key] = len(ends)
                    ends.append(NONE)
                state = steps[key]
            ends[state] = i
        self.step, self.steps = IntTable(steps), steps
        self.end = np.array(ends, np.int32)
        self.ends = ends
        self.token_size = np.array([len(b) for b in self.token_bytes], np.int64)
        self.pattern = regex.compile(PATTERN)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.added, key=len, reverse=True))) + ")") if self.added else None
        # three white-space characters around a plain space: a cut there would differ
        self.spaces = regex.compile(r"\p{White_Space} (?:\p{White_Space}|\Z)")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # -- pair compatibility -------------------------------------------------
    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the tokens a, b stay apart when their joined bytes are encoded."""
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        bound = np.full(len(a), 1 << 30, np.int32)  # border merges of a rank below it come first
        while len(at):
            rank = self.pair_rank.get(a << 20 | b)
            broken = (rank >= 0) & (rank < bound)
            out[at[broken]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~broken & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[on], a[on], b[on], ra[on], rb[on]
            undo_a = ra > rb
            bound = np.where(undo_a, ra, rb + 1).astype(np.int32)
            a, b = np.where(undo_a, self.right[a], a).astype(np.int64), \
                np.where(undo_a, b, self.left[b]).astype(np.int64)
        return out

    def compatible_one(self, a: int, b: int) -> bool:
        bound = 1 << 30
        while True:
            rank = self.pairs.get(a << 20 | b, NONE)
            if 0 <= rank < bound:
                return False
            ra, rb = int(self.rank[a]), int(self.rank[b])
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                bound, a = ra, int(self.right[a])
            else:
                bound, b = rb + 1, int(self.left[b])

    # -- dynamic programming ------------------------------------------------
    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in one array, and where each one starts and how many it has."""
        start, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat, used = [], 0
        short = np.nonzero(sizes <= LONG_BYTES)[0]
        for lo in range(0, len(short), 50_000):
            part = short[lo:lo + 50_000]
            ids, counts = self._encode_short([words[i] for i in part.tolist()])
            start[part], count[part] = used + np.cumsum(counts) - counts, counts
            flat.append(ids)
            used += len(ids)
        tested: dict[int, bool] = {}
        for i in np.nonzero(sizes > LONG_BYTES)[0].tolist():
            ids = self._encode_long(words[i], tested)
            start[i], count[i] = used, len(ids)
            flat.append(ids)
            used += len(ids)
        return np.concatenate(flat or [np.zeros(0, np.int32)]), start, count

    def _encode_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        depth = np.arange(len(text)) - np.repeat(first, size) + 1  # prefix length at each end
        # automaton: every token that ends at each position
        where, length, token = [], [], []
        state, at, n = np.zeros(len(text), np.int64), np.arange(len(text)), 0
        while len(at):
            n += 1
            state = self.step.get(state << 8 | text[at - (n - 1)]).astype(np.int64)
            on = state >= 0
            state, at = state[on], at[on]
            t = self.end[state]
            is_token = t >= 0
            where.append(at[is_token])
            length.append(np.full(int(is_token.sum()), n, np.int32))
            token.append(t[is_token])
            on = depth[at] > n
            state, at = state[on], at[on]
        where, length, token = map(np.concatenate, (where, length, token))
        # by prefix length, then position, longest token first
        order = np.lexsort((-length, where, depth[where]))
        where, length, token = where[order], length[order], token[order]
        level = np.searchsorted(depth[where], np.arange(1, int(size.max(initial=0)) + 2))
        last = np.full(len(text), NONE, np.int32)
        for lo, hi in zip(level[:-1], level[1:], strict=True):
            w, n, t = where[lo:hi], length[lo:hi], token[lo:hi]
            whole = n == depth[w]
            before = np.where(whole, 0, last[np.maximum(w - n, 0)])
            new = np.ones(len(w), bool)
            new[1:] = w[1:] != w[:-1]
            turn = np.arange(len(w)) - np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
            for k in range(int(turn.max(initial=-1)) + 1):  # the k-th longest of each position
                pick = np.nonzero((turn == k) & (last[w] == NONE))[0]
                if not len(pick):
                    continue
                ok = whole[pick].copy()
                test = np.nonzero(~ok & (before[pick] >= 0))[0]
                ok[test] = self.compatible(before[pick][test], t[pick][test])
                got = pick[ok]
                last[w[got]] = t[got]
        return self._back(last, first, size)

    def _back(self, last: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follow the back-pointers of all words at once: ids, and their number by word."""
        word, at = np.nonzero(size)[0], (first + size - 1)[size > 0]
        words, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        while len(word):
            t = last[at]
            words.append(word)
            ids.append(t)
            at = at - self.token_size[t]
            on = at >= first[word]
            word, at = word[on], at[on]
        words, ids = np.concatenate(words)[::-1], np.concatenate(ids)[::-1]
        return ids[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(size))

    def _encode_long(self, word: bytes, tested: dict[int, bool]) -> np.ndarray:
        last: list[int] = []
        for end in range(1, len(word) + 1):
            state, ending, n = 0, [], 0
            while n < end:
                state = self.steps.get(state << 8 | word[end - n - 1], NONE)
                if state < 0:
                    break
                n += 1
                if self.ends[state] >= 0:
                    ending.append((n, self.ends[state]))
            for n, t in reversed(ending):
                if n == end:
                    break
                key = last[end - n - 1] << 20 | t
                if key not in tested:
                    tested[key] = self.compatible_one(last[end - n - 1], t)
                if tested[key]:
                    break
            last.append(t)
        ids, at = [], len(word)
        while at:
            ids.append(last[at - 1])
            at -= len(self.token_bytes[ids[-1]])
        return np.array(ids[::-1], np.int32)

    # -- texts ----------------------------------------------------------------
    def chunks(self, text: str) -> list[str]:
        """The text cut at plain spaces where pre-tokens are cut anyway."""
        if self.spaces.search(text):
            return self.pattern.findall(text)
        head, *rest = text.split(" ")
        return [head, *[" " + piece for piece in rest]]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks not seen before, and remember them."""
        fresh = [c for c in chunks if c not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.forget()
            fresh = list(chunks)
        if not fresh:
            return
        words: dict[str, int] = {}
        parts, counts, find, place = [], [], self.pattern.findall, words.setdefault
        for c in fresh:
            found = find(c)
            counts.append(len(found))
            parts += [place(w, len(words)) for w in found]
        ids, start, count = self.encode_words([w.encode() for w in words])
        parts = np.array(parts, np.int64)
        flat = gather(ids, start[parts], count[parts])
        ends = np.cumsum(count[parts])
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        known = len(self.known)
        self.known.update(zip(fresh, range(known, known + len(fresh)), strict=True))
        self.start = np.concatenate([self.start, self.used + ends[:-1]])
        self.count = np.concatenate([self.count, np.diff(ends)])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.used += len(flat)

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text; its chunks must not all fit the table at once."""
        out = []
        for k, part in enumerate(self.split_added.split(text) if self.split_added else [text]):
            if k % 2:
                out.append(np.array([self.added[part]], np.int32))
                continue
            chunks = self.chunks(part)
            for lo in range(0, len(chunks), REMEMBERED // 2):
                piece = chunks[lo:lo + REMEMBERED // 2]
                try:
                    rows = list(map(self.known.__getitem__, piece))
                except KeyError:
                    self.learn(set(piece))
                    rows = list(map(self.known.__getitem__, piece))
                rows = np.array(rows, np.int64)
                out.append(gather(self.flat, self.start[rows], self.count[rows]))
        return np.concatenate(out)

    def prepare(self, texts: list[str]) -> None:
        """Learn the chunks of several texts together."""
        fresh: set[str] = set()
        for text in texts:
            for k, part in enumerate(self.split_added.split(text) if self.split_added else [text]):
                if not k % 2:
                    fresh.update(self.chunks(part))
        if len(fresh) <= REMEMBERED // 2:
            self.learn(fresh)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_CODECS: dict[bytes, Codec] = {}
CACHES.append(_CODECS)


def codec(tokenizer_json: bytes) -> Codec:
    """One codec per worker process and vocabulary."""
    key = hashlib.sha256(tokenizer_json).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(tokenizer_json)
    return _CODECS[key]


#: Texts encoded together: characters per step.
STEP_CHARS = 2_000_000


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(rows, texts) of about STEP_CHARS characters."""
    for batch in batches:
        texts, at, lo, chars = batch.column("text").to_pylist(), 0, 0, 0
        for at, text in enumerate(texts, 1):
            chars += len(text)
            if chars >= STEP_CHARS:
                yield batch.slice(lo, at - lo), texts[lo:at]
                lo, chars = at, 0
        if lo < len(texts):
            yield batch.slice(lo), texts[lo:]


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
           id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, ids (array<int>).  ``tokenizer_path`` is a
    byte-level BPE file of the tokenizers library, read on the driver."""
    data = _broadcast(docs, tokenizer_path)

    def run(batches):
        c = codec(data.value)
        for batch, texts in _steps(batches):
            c.prepare(texts)
            ids = [c.encode(t) for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))],
                names=["doc_id", "ids"])

    return map_arrow(_slim(docs, text_col, id_col), run, f"doc_id {_type(docs, id_col)}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids",
           id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, text.  NULL ids give an empty text."""
    data = _broadcast(encoded, tokenizer_path)

    def run(batches):
        c = codec(data.value)
        for batch in batches:
            texts = [c.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    rows = encoded.select(col(id_col).alias("doc_id"), col(ids_col).alias("ids"))
    return map_arrow(rows, run, f"doc_id {_type(encoded, id_col)}, text string")


def round_trip(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
               id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256."""
    data = _broadcast(docs, tokenizer_path)

    def run(batches):
        c = codec(data.value)
        for batch, texts in _steps(batches):
            c.prepare(texts)
            counts, digests, decoded = [], [], []
            for text in texts:
                ids = c.encode(text)
                counts.append(len(ids))
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(
        _slim(docs, text_col, id_col), run, f"doc_id {_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _slim(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return docs.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))


def _type(df: DataFrame, name: str) -> str:
    return df.select(col(name)).schema[0].dataType.simpleString()


def _broadcast(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())

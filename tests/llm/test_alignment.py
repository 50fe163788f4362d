import functools
import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerframe.llm import alignment as A

from .conftest import prose, rows_of

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["naïve café 日本語 текст 😀", "  two  spaces \n\t tabs ", "a▁b", "<|endoftext|> x <s> </s> <unk> <0x0A>", "\x00\x7f",
       "é", " ", "\n", "1234567890 x=3;y", "don't we'll I'M", "ﬁ ½ ​ \r\n", "a" * 3000, "日" * 500, "🏳️‍🌈 flag", "x " * 400,
       "end ", " start", "tab\there a b", "ab̀ c"]


@pytest.fixture(scope="module")
def tool():
    return A.Aligner(*(open(f, "rb").read() for f in FILES))


@functools.cache
def tools():
    t = Tokenizer.from_file(str(FILES[0]))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=str(FILES[1]))
    return t, sp, {i: s for s, i in t.get_vocab().items()}, A.byte_letters()


def whole(text):
    """(A ids, A ends, B ids, B ends) of a text tokenized in one piece, by byte counting."""
    t, sp, vocab, letters = tools()
    a = t.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)

    def piece(i):
        s = sp.id_to_piece(i)
        return bytes([int(s[3:5], 16)]) if sp.is_byte(i) else s.replace("▁", " ").encode()

    a_bytes, b_bytes = [bytes(letters[c] for c in vocab[i]) for i in a], [piece(i) for i in b]
    raw = (" " + text).encode()
    if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], [], [], []
    return a, list(np.cumsum([len(x) for x in a_bytes])), b, list(np.cumsum([len(x) for x in b_bytes]))


def brute(texts):
    docs = []
    for text in texts:
        a, ae, b, be = whole(text or "")
        links = [(x, y) for x, s, e in zip(a, [0, *ae], ae) for y, u, v in zip(b, [0, *be], be)
                 if max(s, u) < min(e, v)]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ae) & set(be)):
            x, y = ae.index(cut) + 1, be.index(cut) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
    counts = Counter(p for d in docs for p in d[3])
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [(na, nb, ng, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if na else "") for na, nb, ng, links, g in docs]


def test_report_equals_brute_force(spark, edge_docs):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(30)] + ODD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in A.REPORT[1:]) for r in rows_of(A.Alignment(docs, *FILES).report())}
    assert got == dict(enumerate(brute(texts)))
    edge = [(r["doc_id"], r["text"]) for r in edge_docs.where("coalesce(length(text), 0) < 5000").collect()]
    docs = edge_docs.where("coalesce(length(text), 0) < 5000")
    got = sorted([str(tuple(r[c] for c in A.REPORT)) for r in rows_of(A.Alignment(docs, *FILES).report())])
    assert got == sorted(str((i, *r)) for (i, _), r in zip(edge, brute([t for _, t in edge]), strict=True))


def test_long_texts_nulls_and_empty_tables(spark, edge_docs, no_docs):
    got = rows_of(A.Alignment(edge_docs, *FILES).report())
    assert len(got) == edge_docs.count()
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in got)
    assert [r["groups_sha256"] for r in got if r["doc_id"] in (4, 5)] == ["", ""]
    assert A.Alignment(no_docs, *FILES).report().count() == 0
    assert A.Alignment(no_docs, *FILES).tokens().count() == 0


def test_small_blocks_and_lines_change_nothing(tool, monkeypatch):
    rng = random.Random(4)
    texts = [prose(rng, 50) for _ in range(20)] + ODD
    whole_block = A.Block(tool, texts).documents()
    monkeypatch.setattr(A, "LINE", 5)
    parts = [A.Block(tool, [t]).documents() for t in texts]
    assert whole_block == {k: [p[k][0] for p in parts] for k in whole_block}


def test_chunks_change_no_token(tool):
    rng = random.Random(6)
    letters = ["a", "B", "1", " ", " ", " ", "\n", "é", "日", "'s", ".", "▁", "\t", "  ", "😀", "\u00a0", "-", "\x1c",
               "\u2003", "\u0300", "\u200b"]
    assert tool.splits
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(3_000)]
    lines, good = tool.tokens([" " + t for t in texts])
    at, seen = 0, 0
    block = A.Block(tool, texts)
    for text, ok, chunks, digest in zip(texts, good, block.docs, block.documents()["groups_sha256"], strict=True):
        a, ae, b, be = whole(text)
        assert ok == bool(a) == bool(len(chunks)) == bool(digest), text
        if not ok:
            continue
        i, j, k, m = (*lines.a_first[at:at + 2], *lines.b_first[at:at + 2])
        assert lines.a_ids[i:j].tolist() == a and lines.b_ids[k:m].tolist() == b, text
        assert (lines.a_ends[i:j] - lines.bytes[at]).tolist() == ae, text
        assert (lines.b_ends[k:m] - lines.bytes[at]).tolist() == be, text
        assert digest == brute([text])[0][6], text
        at, seen = at + 1, seen + len(tool.chunks(text))
    assert seen > 1.2 * at


def test_plain_texts_are_cut_and_checked_without_patterns_and_lists(tool, monkeypatch):
    """Texts whose spaces are all single need no pattern, lines that come back no list of
    bytes for each token; the cuts are those of the pattern."""
    white = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    assert white == A.WHITE
    texts = ["plain text", "x", "two\nlines of text", *ODD]
    texts += [t for w in white for t in (f"a{w}b c", f"a{w} b", f"a {w}b", f"{w}a b", f"a b{w}", w)]
    assert [tool.chunks(t) for t in texts] == [A.CHUNK.split(" " + t) for t in texts]

    class Unused:
        def split(self, text):
            raise AssertionError(text)

        def __getitem__(self, i):
            raise AssertionError(i)

    monkeypatch.setattr(A, "CHUNK", Unused())
    assert tool.chunks("two\nlines of text") == [" two\nlines", " of", " text"]
    monkeypatch.setattr(tool, "a_bytes", Unused())
    tokens, good = tool.tokens([" two\nlines of text", " naïve 日本語 text", " x"])
    assert good == [True] * 3 and tokens.a_first[-1] == len(tokens.a_ends)
    a, ae, b, be = whole("two\nlines of text")
    assert (tokens.a_ids[:len(a)].tolist(), tokens.a_ends[:len(a)].tolist()) == (a, ae)
    assert (tokens.b_ids[:len(b)].tolist(), tokens.b_ends[:len(b)].tolist()) == (b, be)


def test_files_that_merge_across_spaces_are_read_whole(tool):
    data = json.loads(open(FILES[0]).read())
    data["pre_tokenizer"]["use_regex"] = False
    other = A.Aligner(json.dumps(data).encode(), open(FILES[1], "rb").read())
    assert not other.splits and other.chunks("a b c") == [" a b c"]


def test_tokens_and_pair_counts(spark):
    texts = ["plain words here", "日本 words", "a▁b", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = A.Alignment(docs, *FILES)
    rows = {r["doc_id"]: r for r in rows_of(done.tokens())}
    for i, text in enumerate(texts):
        a, ae, b, be = whole(text or "")
        assert (rows[i]["a_ids"], rows[i]["b_ids"]) == (a, b)
        assert [c["byte"] for c in rows[i]["cuts"]] == sorted(set(ae) & set(be))
    pairs = rows_of(done.pair_counts())
    report = rows_of(done.report())
    assert sum(r["n"] for r in pairs) == sum(r["n_links"] for r in report)
    assert {r["b_id"] for r in pairs} == {r["b_id"] for r in pairs if r["best"]}

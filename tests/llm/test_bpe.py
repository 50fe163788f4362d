import hashlib
import random

import numpy as np
import pandas as pd
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from ledgerframe.llm import bpe  # noqa: E402

from .conftest import rows_of  # noqa: E402

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return bpe.Codec(f.read())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_random_texts_encode_as_the_library_does(library, codec):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "日", "😀", "'s", "'ll", "'", "1", "23", "!", "...",
             "<|endoftext|>", "\x1c", " ", "aaaa", "the", "ing", "\r\n", "   ", "_", "​", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2ff), rng.randint(0x370, 0xd7ff)]))
                      for _ in range(rng.randint(1, 30))) for _ in range(1000)]
    texts += ["a" * 500, "ab" * 700, " " * 300, "=" * 1000, "\n" * 77 + "x", "thethethe" * 40, "x" * 48, "x" * 49]
    codec.prepare(texts[:2000])
    for t in texts:
        ids = codec.encode(t)
        assert ids.tolist() == ids_of(library, t), repr(t)
        assert codec.decode(ids) == t


def test_long_and_short_words_share_one_rule(codec):
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abetionths") for _ in range(rng.randint(1, 48))).encode()
        ids, start, count = codec.encode_words([word])
        assert ids.tolist() == codec._encode_long(word, {}).tolist()
        assert (start.tolist(), count.tolist()) == ([0], [len(ids)])


def test_table_of_chunks_starts_anew(library, codec, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    codec.forget()
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("etaoin") for _ in range(6)) for _ in range(500))
    assert codec.encode(text).tolist() == ids_of(library, text)


def test_queries_over_edge_rows(edge_docs, no_docs, library):
    texts = sorted((r.text or "") for r in edge_docs.collect())
    got = rows_of(bpe.round_trip(edge_docs, PATH))
    want = []
    for t in texts:
        ids = np.array(ids_of(library, t), "<u4")
        want.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(want)
    encoded = bpe.encode(edge_docs, PATH)
    assert sorted(r["text"] for r in rows_of(bpe.decode(encoded, PATH))) == texts
    assert bpe.round_trip(no_docs, PATH).count() == 0


def test_documents_match_the_library(spark, library):
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet").set_index("doc_id")["text"]
    got = rows_of(bpe.encode(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH))
    assert {r["doc_id"]: r["ids"] for r in got} == {i: ids_of(library, t) for i, t in docs.items()}

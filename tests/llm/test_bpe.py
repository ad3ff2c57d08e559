import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from keyscore.llm import bpe


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return bpe.load(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), P.PATTERN)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_same_ids_as_the_library(ranks, library):
    rng = random.Random(3)
    alphabet = "abcdefgh  \n\t'sßéñö123٣²½\x1c\x85\xa0 ​漢字🙂Ａ́_-.,!<|endoftext|>"
    cases = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    cases += ["a" * 1000, "ab" * 3000, "\n" * 700 + "x", " " * 5000, "-=" * 400, "thethethe" * 90, "x" * 255, "y" * 257, "don't I'LL we'll"]
    for text, data in zip(cases, ranks.encode_all(cases)):
        assert ids(data) == library.encode_ordinary(text), text
        assert ranks.decode(data) == text.encode()


def test_long_text_in_blocks(ranks, library):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("etaoin") for _ in range(rng.randint(1, 9))) for _ in range(150_000))
    assert ids(ranks.encode_all([text])[0]) == library.encode_ordinary(text)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 0), (1, "a b", 0), (None, None, 1), (3, "", 2)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id or -1, r.n_tokens) for r in bpe.round_trip(docs).collect())
    assert got == [(-1, 0), (1, 2), (1, 2), (3, 0)]
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = bpe.op3_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        want = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()

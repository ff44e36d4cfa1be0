import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from paneltide.llm import bpe

SCHEMA = "doc_id long, text string, ids int, key string"


@pytest.fixture(scope="module")
def own():
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    rnd = random.Random(7)
    alphabet = ["a", "they're", " ", "  ", "\n", "é", "1234", "!", "'ll", "'", "日本", "\t\n ", "🙂", "word", "'v"]
    made = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 700))) for _ in range(60)]
    return [*made, "", None, "x" * 900, " " * 900, "ab " * 300, "a" * 130 + " b" * 200, "<|endoftext|> x"]


def test_chunked_encoding_equals_whole_texts_and_round_trips(spark, own):
    texts = _texts()
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)] + [(2, texts[2], 9, None), (None, "hello there " * 30, 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(
        (tuple(r) for r in bpe.encode(docs, chunk=64, overlap=24).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )
    want = sorted(((i, own.encode_ordinary(t or "")) for i, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == want
    back = bpe.decode(spark.createDataFrame([(i, ids) for i, ids in got], "doc_id long, ids array<int>"))
    assert sorted((r[0], bytes(r[1])) for r in back.collect() if r[0] is not None) == sorted(
        (i, (t or "").encode()) for i, t, *_ in rows if i is not None
    )


def test_digests(spark, own):
    docs = spark.createDataFrame([(1, "They're here. ", 0, ""), (2, None, 0, "")], SCHEMA)
    rows = {r["doc_id"]: r for r in bpe.digests(docs).collect()}
    ids = own.encode_ordinary("They're here. ")
    assert rows[1]["n_tokens"] == len(ids)
    assert rows[1]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert rows[1]["decoded_sha256"] == hashlib.sha256(b"They're here. ").hexdigest()
    assert rows[2]["n_tokens"] == 0
    assert rows[2]["ids_sha256"] == rows[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_very_long_white_space(own):
    text = "a" + " " * 60_000 + "b"
    assert list(bpe.encode_text(text, bpe.read_ranks(P.path(bpe.VOCABULARY)), P.PATTERN)) == own.encode_ordinary(text)


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA)).where(F.lit(True)).count() == 0

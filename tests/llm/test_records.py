import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paneltide.llm import records
from paneltide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _brute(library, docs):
    out, at = [], 0
    for i, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark, library):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(tuple(r) for r in QUERIES["op12_record_files"](spark, SF).collect()) == _brute(library, docs)


def test_checksums():
    # the published check value of CRC-32C
    assert records.crc32c([b"123456789", b""]).tolist() == [0xE3069283, 0]

    def plain(data):
        c = 0xFFFFFFFF
        for x in data:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (records._POLYNOMIAL * (c & 1))
        return c ^ 0xFFFFFFFF

    rnd = random.Random(1)
    parts = [rnd.randbytes(n) for n in (1, 2, 3, 255, 256, 257, 511, 513, 5000, 20_001)]
    assert records.crc32c(parts).tolist() == [plain(p) for p in parts]
    assert records.crc32c([]).tolist() == []


def test_damage_is_an_error():
    good = b"".join(records.frame([b"one", b"", b"three" * 1000]))
    assert [p for ps in records.unframe(good) for p in ps] == [b"one", b"", b"three" * 1000]
    for at in (0, 9, 13, 16, 19, 40, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 4
        with pytest.raises(ValueError, match="record"):
            list(records.unframe(bytes(bad)))
    with pytest.raises(ValueError, match="record"):
        list(records.unframe(good[:-5]))


def _texts():
    rnd = random.Random(2)
    signs = list("ab  \n\n\t'sé数.,!1٣½  \x1c\x85") + ["'ll", " the", " of\n", "\r\n", "<|endoftext|>", "🙂", "A.B"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(300)]
    return [*texts, None, "", " ", "\n", " " * 500, "x" * 3000, "word " * 4000, "no<|endoftext|>gap"]


def test_a_word_is_learnt_once_with_all_the_marks_that_end_it(library, monkeypatch):
    enc, given, learn = records.Encoder(library.to_str()), [], records.Encoder._learn
    monkeypatch.setattr(records.Encoder, "_learn", lambda self, pieces: (given.extend(pieces), learn(self, pieces))[1])
    texts = ["a zweiß. zweiß, zweiß!? zweiß;", "b zweiß... don't. it's, 3. 3, ...\nzweiß. x", "c zweiß. ʰ! ª, 漢. zweiß'. a.b. ɐ?\n. x"]
    got = [np.frombuffer(b, f"<u{enc.width}").tolist() for t in texts for b in enc.encode([t])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert given.count(" zweiß") == 1 and not {" zweiß.", " zweiß,", "\nzweiß."} & set(given)


def test_cut_texts_have_the_librarys_ids(library, monkeypatch):
    monkeypatch.setattr(records, "_KNOWN", 50)  # pieces are forgotten all the time
    enc = records.Encoder(records.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    texts = [t or "" for t in _texts()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for lo in range(0, len(texts), 40):
        got = enc.encode(texts[lo : lo + 40])
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == want[lo : lo + 40]
    monkeypatch.setattr(records, "_WINDOW", 16)
    assert [np.frombuffer(b"".join(enc.encode([w])[0] for w in enc.windows(t)), "<u2").tolist() for t in texts] == want


def test_order_nulls_repeats_files_and_shuffled_reads(spark, library):
    docs = [(i * 7 % 311, t) for i, t in enumerate(_texts())]
    docs += [(None, "no id"), (None, None), (5, "same id"), (5, "same id"), (-3, "below")] + [(400, "copy of one row")] * 200
    df = spark.createDataFrame([(t, i, 1, "f") for i, t in docs], "text string, doc_id long, part int, file string")
    index = records.write_records(df, file_bytes=4096)
    got = sorted((tuple(r) for r in records.digests(index, read_bytes=1000).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in docs), key=lambda i: (i is not None, i or 0))
    # rows of one id may stand in either order of their texts
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    rows = records.read_records(index, read_bytes=1000).collect()
    shuffled = records.read_records(index, shuffle_seed=4, read_bytes=1000).collect()
    assert [r["doc_id"] for r in shuffled] != [r["doc_id"] for r in rows]
    assert sorted(map(str, shuffled)) == sorted(map(str, rows))
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append(list(r["ids"]))
    assert {i: sorted(x) for i, x in found.items()} == {i: sorted(x) for i, x in texts.items()}
    assert {(r["doc_id"], r["start"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows} == set(got)
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert index.select("file").distinct().count() > 3
    # any rows of the index can be read on their own, at their global place
    some = index.where("doc_id = 400")
    assert records.read_records(some).count() == 200
    none = records.write_records(df.limit(0))
    assert records.digests(none).collect() == [] and records.read_records(none, shuffle_seed=1).collect() == []


def test_files_of_failed_attempts_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    index = records.write_records(df, f"file://{tmp_path}/out")
    (tmp_path / "out" / "part-000000-0000-lost.rec").write_bytes(b"half a rec")
    assert records.digests(index).count() == 50
    # the files alone are whole: framed records one after another
    for f in (tmp_path / "out").glob("*.rec"):
        if "lost" not in f.name:
            for parts in records.unframe(f.read_bytes()):
                assert all(struct.unpack_from("<BBq", p)[:2] == (1, 2) for p in parts)
    assert (tmp_path / "out" / "index").exists()

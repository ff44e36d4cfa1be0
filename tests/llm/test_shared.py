import random
import tracemalloc

import numpy as np
import pyarrow as pa

from paneltide.llm import decontaminate, langid, minhash
from paneltide.llm.shared import text_blocks


def _batch(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])


def _peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_blocks_hold_every_row_in_order_and_are_bounded():
    texts = [None, "é", "", "abc", "😀", "abcdefgh", None]
    got = list(text_blocks([_batch(texts), _batch([]), _batch(["x"], [9])], 1, 3))
    assert [t for _, b in got for t in b] == [*texts, "x"]
    assert [i for p, _ in got for i in p.column(0).to_pylist()] == [*range(7), 9]
    assert [b for _, b in got] == [[None, "é", ""], ["abc"], ["😀"], ["abcdefgh"], [None], ["x"]]
    assert [len(b) for _, b in text_blocks([_batch(texts).slice(1, 4)], 1, 6, each=3)] == [2, 2]
    assert [b for _, b in text_blocks([pa.RecordBatch.from_arrays([pa.nulls(2)], names=["text"])], 0, 3)] == [[None, None]]


def test_a_large_batch_is_not_held_as_python_texts():
    batch = _batch([f"{i} " + "x" * 1000 for i in range(20_000)])  # 20 MB
    assert _peak_mb(lambda: [len(t) for _, t in text_blocks([batch], 1, 1 << 16)]) < 5


class _Frame:
    """Stands for a DataFrame and keeps the function that workers would run."""

    def mapInArrow(self, run, schema):
        return run


def test_memory_of_signatures_does_not_grow_with_the_texts_of_a_batch():
    words = random.Random(3)
    texts = [" ".join(str(words.randrange(10**6)) for _ in range(8)) for _ in range(1500)]
    run = minhash._sketch(_Frame(), 5, False, 48, 7, 1)
    assert _peak_mb(lambda: [b.num_rows for b in run(iter([_batch(texts)]))]) < 80
    whole = pa.Table.from_batches(run(iter([_batch(texts)])))
    each = pa.Table.from_batches(run(iter([_batch(texts[:700], range(700)), _batch(texts[700:], range(700, 1500))])))
    assert whole.equals(each)


def test_places_of_a_frequent_passage_are_laid_in_parts(monkeypatch):
    common = "one two three four five six seven eight"
    items = [f"{common} w{i} x{i} y{i} z{i}" for i in range(300)]
    index = decontaminate.build(list(range(300)), items, 5)
    texts = [f"{common} " * 200 + items[7], items[250] + " " + items[250], None]
    want = decontaminate.leaks_of(texts, index, 0.8)
    assert [[x["item_id"] for x in r] for r in want] == [[7], [250], []]
    text_of = decontaminate.hash_words(texts)
    grams = decontaminate.shingles(text_of.hashes, 5)
    hit = np.flatnonzero(np.isin(grams, index.known))
    at = np.searchsorted(index.known, grams[hit])
    text = np.searchsorted(text_of.first, hit, side="right") - 1
    args = (index, 5, text_of.first, hit, at, text)
    windows = decontaminate._windows(*args)
    monkeypatch.setattr(decontaminate, "_PLACES", 1000)
    assert (decontaminate._windows(*args) == windows).all()
    assert _peak_mb(lambda: decontaminate._windows(*args)) < 2
    assert decontaminate.leaks_of(texts, index, 0.8) == want


def test_a_kept_text_goes_to_the_workers_once(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(5, "one two three four five six")], "item_id long, text string")
    found = decontaminate.find_leaks(docs, items)
    judged = langid.identify(docs, langid.fit(docs))
    for df in (found, judged):
        below = df._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow", 1)[1].splitlines()[1:]
        assert below and "__" not in "".join(below)
    assert [(r["doc_id"], r["text"], r["lang"], [x["item_id"] for x in r["leaks"]]) for r in found.orderBy("doc_id").collect()] == [
        (1, "one two three four five six", "en", [5]), (2, None, "en", []),
    ]
    assert found.columns == [*docs.columns, "leaks"] and judged.columns == [*docs.columns, "lang_pred", "score"]
    # the text itself may be left out or replaced
    assert [r["leaks"][0]["item_id"] for r in decontaminate.find_leaks(docs, items, keep=["doc_id"]).where("doc_id = 1").collect()] == [5]
    assert decontaminate.find_leaks(docs, items, into="text").columns == ["doc_id", "lang", "text"]

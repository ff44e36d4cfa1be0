"""Language-model scores by context-tree weighting, beside an add-one unigram base.

A byte is eight binary decisions; each decision, given the bits of its byte so far, has a tree
of contexts of 0 to 3 preceding bytes.  Every node has a Krichevsky-Trofimov estimate from its
counts of zeros and ones, and weights it by half against the product of its children's; so the
model is a mixture over all depths.  Weights go up the tree, predictions come down it: at a
node with weight w the probability is w times its own estimate plus 1 - w times the deeper one,
and where a context was never seen the rest of the mixture says one half.  A text is its bytes
with A-Z in lower case, after three zero bytes, and an end symbol.

Counts are gathered over all training texts.  Contexts and tokens of a share of 2**-17 and
2**-20 or more of the corpus are at most 2**17 and 2**20 by arithmetic; these are broadcast,
and what remains of every text is joined with the counts by a shuffle, where no key can be
frequent.  No context, token or text is left out.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored, crc_bucket, spans_of

#: No token: it is white space.
END = "\n"
_END_BYTE = 0xFF  # in no UTF-8 text
_BLOCK = 1 << 20
_FLUSH = 300_000
_HEAD_CONTEXTS = 1 << 17
_HEAD_TOKENS = 1 << 20
_NODES = 256  # heap index of a bit prefix; 0 is unused
_HALF = np.log(0.5)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for x > 0, by Stirling's series above 10."""
    x = np.asarray(x, np.float64)
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(10):
        low = y < 10
        shift[low] += np.log(y[low])
        y[low] += 1
    inv = 1 / y
    series = inv / 12 * (1 - inv**2 / 30 * (1 - inv**2 * 2 / 7 * (1 - inv**2 * 3 / 4)))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def _nodes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the estimator's block probability, estimate of a one) of every bit prefix; counts
    are (contexts, 256) of the next byte."""
    heap = np.zeros((len(counts), 512))
    heap[:, 256:] = counts
    for q in range(255, 0, -1):
        heap[:, q] = heap[:, 2 * q] + heap[:, 2 * q + 1]
    zeros, ones = heap[:, 0::2], heap[:, 1::2]
    own = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1)
    own[:, 0] = 0
    return own, (ones + 0.5) / (zeros + ones + 1)


def _mixed(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln weighted probability, weight of the own estimate) from the children's product."""
    both = np.logaddexp(_HALF + own, _HALF + below)
    return both, np.exp(_HALF + own - both)


def _down(acc: np.ndarray, rest: np.ndarray, w: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return acc + rest * w * one, rest * (1 - w)


_SYMBOL = np.arange(256)
_PATH = [(256 + _SYMBOL) >> (8 - k) for k in range(8)]
_BIT = [(_SYMBOL >> (7 - k)) & 1 for k in range(8)]


def _symbols(one: np.ndarray) -> np.ndarray:
    """log10 probability of each of the 256 symbols from the probability of a one at each node."""
    return sum(np.log10(np.where(bit, one[:, at], 1 - one[:, at])) for at, bit in zip(_PATH, _BIT, strict=True))


def _bytes(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams of three context bytes and a symbol, their text, bytes of each text)."""
    parts = [b"\0\0\0" + (t or "").encode("utf-8", "surrogatepass").lower() + bytes([_END_BYTE]) for t in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts)) - 3
    a = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    gram = a[:-3] << np.uint32(24) | a[1:-2] << np.uint32(16) | a[2:-1] << np.uint32(8) | a[3:]
    owner = np.repeat(np.arange(len(parts)), size + 3)[3:]
    begins = np.cumsum(size + 3) - size - 3
    inside = np.ones(len(gram), bool)
    for k in range(3):  # a gram whose symbol is a text's padding
        at = begins + k - 3
        inside[at[at >= 0]] = False
    return gram[inside], owner[inside], size - 1


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _gram_counts(texts: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            part = b.column(0).to_pylist()
            for lo, hi in spans_of([len(t or "") for t in part], 4 * _BLOCK):
                gram, n = np.unique(_bytes(part[lo:hi])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(n)], names=["gram", "n"])

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _token_counts(texts: DataFrame) -> DataFrame:
    def emit(found: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("utf-8", "replace") for w in found], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], names=["token", "n"])

    def run(batches):
        found: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(_tokens(t))
                found[END.encode()] += 1
                if len(found) > _FLUSH:
                    yield emit(found)
                    found = Counter()
        yield emit(found)

    return texts.mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _matrix(symbols: np.ndarray, n: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros((rows, 256))
    np.add.at(out, (row, symbols), n)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


class _Upper:
    """The tree's root and contexts of one byte: at most 257 nodes sets, made on the driver."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]]):
        counts = np.array([np.frombuffer(c, np.float64) for _, _, c in rows]).reshape(len(rows), 256)
        up = np.array([np.frombuffer(p, np.float64) for _, p, _ in rows]).reshape(len(rows), _NODES)
        own, one = _nodes(counts)
        weighted, w = _mixed(own, up)
        root, root_one = _nodes(counts.sum(axis=0, keepdims=True))
        _, root_w = _mixed(root, weighted.sum(axis=0, keepdims=True))
        acc, rest = _down(np.zeros((1, _NODES)), np.ones((1, _NODES)), root_w, root_one)
        self.unseen = _symbols(acc + rest / 2)[0]
        self.at = {c: i for i, (c, _, _) in enumerate(rows)}
        self.acc, self.rest = _down(acc, rest, w, one) if rows else (acc, rest)
        self.symbols = _symbols(self.acc + self.rest / 2)


def _two_bytes(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Of one context of two bytes: (contexts, their counts, own ln probability and estimates of
    both depths, ln weighted probability and weight of the shorter)."""
    gram, n = t.column("gram").to_numpy(), t.column("n").to_numpy()
    contexts, row = np.unique(gram >> 8, return_inverse=True)
    counts = _matrix(gram & 255, n, row, len(contexts))
    deep, deep_one = _nodes(counts)
    own, one = _nodes(counts.sum(axis=0, keepdims=True))
    weighted, w = _mixed(own, deep.sum(axis=0, keepdims=True))
    return contexts, counts, deep_one, one, weighted, w


def fit(texts: DataFrame, store: Stored) -> tuple[DataFrame, DataFrame, _Upper, int]:
    """(contexts, token counts, upper tree, symbols counted) from a column of texts.  Contexts
    are (depth, context, n, logs): depth 3 or 2, and the log10 probability of each symbol; at
    depth 2 it is that after a third byte that was never seen there."""
    grams = store.put(_gram_counts(texts), "grams")
    tokens = store.put(_token_counts(texts), "tokens")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    keyed = grams.withColumns({"two": F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)), "one": F.shiftright("gram", 8).bitwiseAND(F.lit(0xFF))})

    def up_two(t: pa.Table) -> pa.Table:
        _, counts, *_, weighted, _ = _two_bytes(t)
        return pa.table({"one": t.column("one")[:1], "p": _binary(weighted), "c": _binary(counts.sum(axis=0, keepdims=True))})

    def up_one(t: pa.Table) -> pa.Table:
        sums = [_binary(sum(np.frombuffer(x, np.float64) for x in t.column(c).to_pylist())[None, :]) for c in ("p", "c")]
        return pa.table({"one": t.column("one")[:1], "p": sums[0], "c": sums[1]})

    one = keyed.groupBy("two").applyInArrow(up_two, "one long, p binary, c binary").groupBy("one").applyInArrow(up_one, "one long, p binary, c binary")
    upper = _Upper([(r["one"], bytes(r["p"]), bytes(r["c"])) for r in one.orderBy("one").collect()])  # at most 256 rows
    shared = texts.sparkSession.sparkContext.broadcast(upper)

    def down(t: pa.Table) -> pa.Table:
        contexts, counts, deep_one, own_one, _, w = _two_bytes(t)
        i = shared.value.at[t.column("one")[0].as_py()]
        acc, rest = _down(shared.value.acc[i : i + 1], shared.value.rest[i : i + 1], w, own_one)
        logs = np.concatenate((_symbols(acc + rest * deep_one), _symbols(acc + rest / 2))).astype(np.float32)
        keys = np.concatenate((contexts, [t.column("two")[0].as_py()]))
        n = np.concatenate((counts.sum(axis=1), [counts.sum()])).astype(np.int64)
        depth = np.array([3] * len(contexts) + [2], np.int32)
        ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * 256)
        lists = pa.ListArray.from_arrays(ends, pa.array(logs.reshape(-1)))
        return pa.table({"depth": depth, "context": keys, "n": n, "logs": lists})

    contexts = keyed.groupBy("two").applyInArrow(down, "depth int, context long, n long, logs array<float>")
    return store.put(contexts, "contexts"), tokens, upper, total


class _Tables:
    """What a scoring task looks up; made once in each Python worker from the broadcast rows."""

    def __init__(self, deep, two, upper: _Upper):
        self.place = np.zeros(1 << 24, np.int32)  # pages that no context touches take no memory
        self.place[deep[0]] = np.arange(1, len(deep[0]) + 1)
        self.logs = np.concatenate((np.zeros(256, np.float32), deep[1]))
        self.two = np.zeros(1 << 16, np.int32)
        self.two[two[0]] = np.arange(1 + 256, len(two[0]) + 1 + 256)
        self.one = np.zeros(256, np.int32)
        rows = [upper.unseen.astype(np.float32), *(upper.unseen.astype(np.float32) for _ in range(256))]
        for c, i in upper.at.items():
            rows[1 + c] = upper.symbols[i].astype(np.float32)
        self.short = np.concatenate((*rows, two[1]))

    def known(self, gram: np.ndarray) -> np.ndarray:
        return self.place[gram >> np.uint32(8)]

    def fallback(self, gram: np.ndarray) -> np.ndarray:
        at = self.two[gram >> np.uint32(8) & np.uint32(0xFFFF)]
        at = np.where(at > 0, at, 1 + (gram >> np.uint32(8) & np.uint32(0xFF)).astype(np.int32))
        return self.short[at.astype(np.int64) * 256 + (gram & np.uint32(255))]


_cache: dict[int, _Tables] = {}

_ROW = "row long, id long, held_out boolean, n_tokens long, n_bytes long, n long, known long, base double, score double, token string, gram long"


def _scored(rows: DataFrame, model, words) -> DataFrame:
    """A row for each text with what the broadcast part knows, and rows for the rest: a token or
    a gram of a text with its number, and for a gram the log10 probability of shorter contexts."""

    def run(batches):
        deep, two, upper = model.value
        tables = _cache.get(id(upper))
        if tables is None:
            _cache.clear()
            tables = _cache.setdefault(id(upper), _Tables(deep, two, upper))
        head = words.value
        number = TaskContext.get().partitionId() << 36
        names = [x.split()[0] for x in _ROW.split(", ")]
        for b in batches:
            ids, held, texts = b.column(0), b.column(1), b.column(2).to_pylist()
            for lo, hi in spans_of([len(t or "") for t in texts], _BLOCK):
                n = hi - lo
                row = np.arange(number, number + n)
                number += n
                gram, owner, size = _bytes(texts[lo:hi])
                at = tables.known(gram)
                value = tables.logs[at.astype(np.int64) * 256 + (gram & np.uint32(255))]
                score = np.bincount(owner, weights=value, minlength=n)
                rare = np.flatnonzero(at == 0)
                key, times = np.unique(owner[rare].astype(np.uint64) << np.uint64(32) | gram[rare], return_counts=True)
                rare_gram = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                known, base, count = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
                of, token, many = [], [], []
                for i, t in enumerate(texts[lo:hi]):
                    found = Counter(_tokens(t))
                    found[END.encode()] = 1
                    count[i] = sum(found.values())
                    for w, m in found.items():
                        x = head.get(w)
                        if x is None:
                            of.append(i)
                            token.append(w)
                            many.append(m)
                        else:
                            known[i] += m
                            base[i] += m * x
                r, g = len(of), len(key)
                total = n + r + g

                def put(kind, *parts, total=total):
                    out, mask = np.zeros(total, kind), np.ones(total, bool)
                    for start, values in parts:
                        out[start : start + len(values)] = values
                        mask[start : start + len(values)] = False
                    return pa.array(out, mask=mask)

                def tail(x, kind, total=total, n=n):
                    return pa.concat_arrays([x.slice(lo, n).cast(kind), pa.nulls(total - n, kind)])

                words_ = pa.array([w.decode("utf-8", "replace") for w in token], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        put(np.int64, (0, row), (n, row[np.array(of, int)]), (n + r, row[(key >> np.uint64(32)).astype(int)])),
                        tail(ids, pa.int64()),
                        tail(held, pa.bool_()),
                        put(np.int64, (0, count)),
                        put(np.int64, (0, size)),
                        put(np.int64, (n, many), (n + r, times)),
                        put(np.int64, (0, known)),
                        put(np.float64, (0, base)),
                        put(np.float64, (0, score), (n + r, tables.fallback(rare_gram))),
                        pa.concat_arrays([pa.nulls(n, pa.string()), words_, pa.nulls(g, pa.string())]),
                        put(np.int64, (n + r, rare_gram)),
                    ],
                    names=names,
                )

    return rows.mapInArrow(run, _ROW)


def score(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = 7, held_out: int = 2
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every
    row, learning from the rows whose crc32 of the id as text modulo ``buckets`` is not
    ``held_out``.  Scores are log10 probabilities; bits_per_byte is the model's code length of
    the text with its end, for each byte of the text (null for an empty one).

    Defined results: a null text counts as empty, which is its end alone; a null id counts as an
    empty one; repeated rows each get their own row and count each; with nothing to learn from
    every bit has probability one half; other columns are not read.
    """
    spark = docs.sparkSession
    store = Stored(spark, "ctw")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (crc_bucket(F.col(id_col), buckets) == held_out).alias("held_out"), F.col(text_col).alias("text")
    )
    contexts, tokens, upper, total = fit(rows.where(~F.col("held_out")).select("text"), store)
    n_all, v = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    of_all = float(n_all + v + 1)

    # at most _HEAD_CONTEXTS contexts of three bytes and 2**16 of two, 1 KB each
    frequent = contexts.where((F.col("depth") == 2) | (F.col("n") * _HEAD_CONTEXTS >= total)).toArrow()
    depth = frequent.column("depth").to_numpy()
    logs = frequent.column("logs").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 256)
    keys = frequent.column("context").to_numpy()

    def part(d: int) -> tuple[np.ndarray, np.ndarray]:
        return keys[depth == d], logs[depth == d].reshape(-1)

    model = spark.sparkContext.broadcast((part(3), part(2), upper))
    head = tokens.where(F.col("n") * _HEAD_TOKENS >= n_all).toArrow()  # at most _HEAD_TOKENS
    words = spark.sparkContext.broadcast(
        {w.encode(): float(np.log10((c + 1) / of_all)) for w, c in zip(head.column("token").to_pylist(), head.column("n").to_pylist(), strict=True)}
    )
    found = store.put(_scored(rows, model, words), "scored")

    whole = found.where("token is null and gram is null").select("row", "id", "held_out", "n_tokens", "n_bytes", "known", "base", "score")
    rare = tokens.where(F.col("n") * _HEAD_TOKENS < n_all).select(F.col("token").alias("w"), F.col("n").alias("c"))
    of_tokens = (
        found.where("token is not null").select("row", "token", "n").join(rare, F.col("token") == F.col("w"), "left")
        .select("row", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"),
                (F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(of_all))).alias("base"), F.lit(0.0).alias("score"))
    )
    symbols = contexts.where((F.col("depth") == 3) & (F.col("n") * _HEAD_CONTEXTS < total)).select(F.col("context").alias("c"), "logs")
    of_grams = (
        found.where("gram is not null").select("row", "n", "score", "gram", F.shiftright("gram", 8).alias("context"))
        .join(symbols, F.col("context") == F.col("c"), "left")
        .select("row", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"),
                (F.col("n") * F.coalesce(F.element_at("logs", (F.col("gram") % 256 + 1).cast("int")).cast("double"), "score")).alias("score"))
    )
    sums = of_tokens.unionByName(of_grams).groupBy("row").agg(*(F.sum(c).alias(f"more_{c}") for c in ("known", "base", "score")))
    return whole.join(sums.hint("merge"), "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
        (-(F.col("score") + F.coalesce("more_score", F.lit(0.0))) * float(np.log2(10)) / F.when(F.col("n_bytes") > 0, F.col("n_bytes"))).alias("bits_per_byte"),
    )

"""Token-id output as length-delimited binary records, with an offset index.

A text is encoded with the ``tokenizers`` library and its ids become one record of a file:

    length of the data, 64-bit little-endian | masked CRC-32C of those 8 bytes |
    data | masked CRC-32C of the data

which is the framing of TFRecord files.  The data are one flag byte (1: the row has an id), one
byte for the width of an id (2 or 4), the row's id as a 64-bit integer, and the token ids.

Rows are range-partitioned and sorted by id, so the files, in order of their part, hold all
rows in ascending order.  Every writing task puts its records into files of its own attempt's
name and returns their offsets; the stored index names only files of attempts that succeeded,
so retried and speculative tasks do no harm.  A reader takes byte ranges from the index and
checks both checksums of every record.

The library's cost lies in handling whole strings, so a text is cut where a pre-token must end
(before a single blank or line feed between two characters that are no white space), and only
words that the task has not met lately are given to the library; they are laid end to end,
since these cuts are pre-token borders there too.  Marks such as a full stop that end a word
after a letter are a pre-token of their own, so the word is learnt without them.  A text with white space beside other white
space is cut by a pattern that leaves such runs whole.

Defined results: a null text counts as empty, and is its end id alone; rows without an id come
first; rows that share an id are ordered by their text; repeated rows each have their own
record; other columns are not read, so their names cannot clash; an empty table gives an empty
index.  A text of any length is cut and encoded a window at a time; a run without any blank
between two other characters is one piece.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored, spans_of

VOCABULARY = "byte_bpe_50k.json"
INDEX = "part int, file string, offset long, length long, doc_id long, start long, n_tokens long"

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: The pieces between the cuts: other white space does not end one.
_TAIL = r"(?:(?:\s{2,}|[^\S \n])\S*)*"
_PIECES = re.compile(rf"[ \n]?\S+{_TAIL}|\s+(?:\S+{_TAIL})?")
_JOINABLE = re.compile(r"[ \n]\S")
_WINDOW = 1 << 18  # code points of one text encoded at once
_SPAN = 1 << 21  # code points of several texts encoded at once
_FRAMED = 1 << 22  # bytes framed at once
_KNOWN = 1 << 20  # words a task remembers
_LONG_PIECE = 32
#: Marks that, at the end of a word and after one of the letters below this, are a pre-token of their own.
_MARKS = ".,!?;:#$%&"
_LETTERS_BELOW = "\u0250"
_LEARNT = 1 << 17  # code points of words given to the library at once

# ------------------------------------------------------------------ checksums

_POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
_MASK = 0xA282EAD8
_BLOCK = 256


@lru_cache(maxsize=None)
def _pair_table() -> np.ndarray:
    """The CRC register after two more bytes, for each of its low 16 bits."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        table = (table >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (table & np.uint32(1)))
    return table


@lru_cache(maxsize=None)
def _shift_tables(power: int) -> np.ndarray:
    """For each byte of a register and each value of it: the register after 2**power zero bytes."""
    if power == 0:
        one = (np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).astype(np.uint32)
        low = _pair_table()[(one & np.uint32(255)) << np.uint32(8)]  # one byte: the pair table at a shifted place
        return low ^ (one >> np.uint32(8))
    half = _shift_tables(power - 1)
    return _shift(half, half)


def _shift(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    r = register
    return tables[0][r & 255] ^ tables[1][(r >> 8) & 255] ^ tables[2][(r >> 16) & 255] ^ tables[3][r >> 24]


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of every byte string.  The strings are filled up in front to whole blocks, which
    leaves a register of zero as it is; blocks advance side by side and are then combined."""
    n = np.array([len(p) for p in parts], dtype=np.int64)
    blocks = -(-n // _BLOCK)
    flat = np.frombuffer(b"".join(chain.from_iterable((bytes(int(-k % _BLOCK)), p) for k, p in zip(n, parts, strict=True))), "<u2")
    columns = flat.reshape(-1, _BLOCK // 2).T.astype(np.uint32)
    table, raw = _pair_table(), np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        raw = table[(raw ^ column) & np.uint32(0xFFFF)] ^ (raw >> np.uint32(16))
    whole, first = np.zeros(len(n), np.uint32), np.concatenate(([0], np.cumsum(blocks)))[:-1]
    order = np.argsort(-blocks, kind="stable")
    step = _shift_tables(_BLOCK.bit_length() - 1)
    # all strings advance together, those with more blocks for longer
    for j in range(int(blocks.max(initial=0))):
        live = order[: np.searchsorted(-blocks[order], -j, side="left")]
        whole[live] = _shift(step, whole[live]) ^ raw[first[live] + j]
    start = np.full(len(n), 0xFFFFFFFF, np.uint32)
    for bit in range(int(n.max(initial=0)).bit_length()):
        start = np.where((n >> bit) & 1 == 1, _shift(_shift_tables(bit), start), start)
    return whole ^ start ^ np.uint32(0xFFFFFFFF)


def masked_crc32c(parts: list[bytes]) -> np.ndarray:
    """Rotated and offset, so that a checksum over data that holds checksums stays sound."""
    c = crc32c(parts)
    return ((c >> np.uint32(15)) | (c << np.uint32(17))) + np.uint32(_MASK)


def frame(parts: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in parts]
    of_heads, of_data = masked_crc32c(heads), masked_crc32c(parts)
    return [b"".join((h, struct.pack("<I", a), p, struct.pack("<I", b))) for h, a, p, b in zip(heads, of_heads.tolist(), parts, of_data.tolist(), strict=True)]


def unframe(data: bytes) -> Iterator[list[bytes]]:
    """Lists of the data of consecutive records; damaged ones are an error."""
    at, heads, parts, sums, size = 0, [], [], [], 0
    while at < len(data):
        n = struct.unpack_from("<Q", data, at)[0] if at + 12 <= len(data) else len(data)
        if at + n + 16 > len(data):
            raise ValueError("a record's length is damaged, or the record is cut off")
        heads.append(data[at : at + 8])
        parts.append(data[at + 12 : at + 12 + n])
        sums.append((struct.unpack_from("<I", data, at + 8)[0], struct.unpack_from("<I", data, at + 12 + n)[0]))
        at, size = at + n + 16, size + n
        if size > 1 << 22 or at == len(data):
            if list(zip(masked_crc32c(heads).tolist(), masked_crc32c(parts).tolist(), strict=True)) != sums:
                raise ValueError("a record does not fit its checksums")
            yield parts
            heads, parts, sums, size = [], [], [], 0


# ------------------------------------------------------------------ encoding


def _strings(words: pa.StringArray) -> list[str]:
    """The words, none of which holds a blank."""
    ends = pa.array([0, len(words)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, words), " ")[0].as_py().split(" ") if len(words) else []


class Encoder:
    """Ids of texts by the ``tokenizers`` library, as bytes of ``width`` bytes an id."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        pre = self.library.pre_tokenizer
        self.apart = self.library.normalizer is None and type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        #: of every id, the bytes that it stands for: characters of a byte-level vocabulary
        self.n_bytes = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.n_bytes[i] = len(token)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes | None] = {}  # ids of a word after a blank or from its line feed on
        self.again: set[str] = set()  # known words that were met again

    def _packed(self, ids) -> bytes:
        return np.asarray(ids, dtype=f"<u{self.width}").tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._packed(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of pieces that start with a blank or line feed and another character."""
        for lo, hi in spans_of([len(p) for p in pieces], _LEARNT):
            part = pieces[lo:hi]
            ids = np.array(self.library.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype=np.int64)
            ends = np.concatenate(([0], np.cumsum(self.n_bytes[ids])))
            borders = np.frombuffer(pa.array(part, pa.string()).buffers()[1], np.int32, len(part) + 1)
            cuts = np.searchsorted(ends, borders) * self.width
            packed = self._packed(ids)
            yield from map(packed.__getitem__, map(slice, cuts[:-1].tolist(), cuts[1:].tolist()))

    def _meet(self, words: set[str]) -> set[str]:
        """Make all words known; those to forget again at once."""
        new = words.difference(self.known)
        self.again |= words - new
        learn, marked, bodies = set(), [], []
        for w in new:
            # a word with white space at an end, beside the line feed that it starts with, is no
            # whole piece: its neighbours belong to it
            bare = len(w.strip())
            if bare and bare >= len(w) - (w[0] == "\n"):
                # the marks that a word ends with are learnt once, not with every word
                b = w.rstrip(_MARKS)
                if len(b) < len(w) and b[-1:].isalpha() and b[-1] < _LETTERS_BELOW:
                    marked.append(w)
                    bodies.append(b)
                else:
                    learn.add(w)
        learn = list(learn.union(set(bodies).difference(self.known)))
        marks = [w[len(b) :] for w, b in zip(marked, bodies, strict=True)]
        kinds = list(set(marks))
        tail = dict(zip(kinds, self._whole(kinds), strict=True))
        self.known.update(dict.fromkeys(new))
        self.known.update(zip(learn, self._learn([w if w[0] == "\n" else " " + w for w in learn]), strict=True))
        self.known.update(zip(marked, map(add, map(self.known.__getitem__, bodies), map(tail.__getitem__, marks)), strict=True))
        return {w for w in chain(new, learn) if len(w) > _LONG_PIECE}

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """As ``encode``, for texts with white space beside other white space."""
        split = [_PIECES.findall(t) for t in texts]
        used = list(set().union(*split))
        joined = [p for p in used if _JOINABLE.match(p)]
        ids = dict(zip(joined, self._learn(joined), strict=True))
        alone = [p for p in used if p not in ids]
        ids.update(zip(alone, self._whole(alone), strict=True))
        return [b"".join(map(ids.__getitem__, s)) for s in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        # an added token may hold any characters and is matched before the text is cut
        plain = [self.apart and not any(a in t for a in self.added) for t in texts]
        # cut at every blank and before every line feed; a word keeps its line feed, not its blank
        cuttable = pa.array([t if p else "" for t, p in zip(texts, plain, strict=True)], pa.string())
        split = pc.split_pattern(pc.replace_substring(cuttable, "\n", " \n"), " ")
        starts = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        of, firsts = coded.indices.to_numpy(), _strings(coded.dictionary.take(coded.indices.take(pa.array(starts[:-1]))))
        later = np.ones(len(of), bool)
        later[starts[:-1]] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[of[later]] = True
        words = _strings(coded.dictionary.filter(pa.array(used)))
        forget = self._meet(set(words))
        ids = list(map(self.known.__getitem__, words))
        bad = np.array([i is None for i in ids], bool)
        # the words' ids laid end to end, and where each text's begin and end in them
        place = np.cumsum(used) - 1
        flat = pa.array([i or b"" for i in ids], pa.binary()).take(pa.array(place[of[later]]))
        laid = memoryview(flat.buffers()[2] or b"")
        counts = np.concatenate(([0], np.cumsum(later)))[starts]
        ends = np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1)[counts].tolist() if len(flat) else [0] * len(starts)
        whole = np.diff(np.concatenate(([0], np.cumsum(bad[place[of[later]]])))[counts]) == 0
        out: list[bytes | None] = []
        for f, start, lo, hi, good in zip(firsts, self._whole(firsts), ends[:-1], ends[1:], whole.tolist(), strict=True):
            out.append(b"".join((start, laid[lo:hi])) if good and not f[-1:].isspace() else None)
        cut = [i for i, x in enumerate(out) if plain[i] and x is None]
        uncut = [i for i, p in enumerate(plain) if not p]
        for which, run in ((cut, self._pieces), (uncut, self._whole)):
            for i, x in zip(which, run([texts[i] for i in which]), strict=True):
                out[i] = x
        for w in forget:
            del self.known[w]
        if len(self.known) > _KNOWN:  # what was met only once is forgotten, then everything
            self.known = {w: self.known[w] for w in self.again if w in self.known} if len(self.again) < _KNOWN // 2 else {}
            self.again = set()
        return out

    def windows(self, text: str) -> Iterator[str]:
        """The text in windows that end where a pre-token ends."""
        lo = 0
        while self.apart and len(text) - lo > _WINDOW and not any(a in text for a in self.added):
            cut = _CUT.search(text, lo + _WINDOW)
            if not cut:
                break
            yield text[lo : cut.start()]
            lo = cut.start()
        yield text[lo:]


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


# ------------------------------------------------------------------ writing


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = path[5:]
    return pafs.FileSystem.from_uri(path)


def write_records(
    docs: DataFrame,
    path: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int | None = 0,
    file_bytes: int = 1 << 28,
) -> DataFrame:
    """Encode every text, write the files below ``path`` (a folder that all executors share; the
    checkpoint folder by default) and return their index, stored beside them: (part, file, offset,
    length, doc_id, start, n_tokens), where ``start`` counts the ids before it in its file."""
    store = Stored(docs.sparkSession, "records")
    base = path or store.base
    words = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary or public_tokenizers.path(VOCABULARY)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    # equal ids are ordered by text; the row number only spreads rows that are wholly equal
    keyed = rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("i"))
    by = [F.col("doc_id").asc_nulls_first(), "h", "i"]
    ordered = keyed.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")

    def run(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        enc = _encoder(words.value)
        end = b"" if end_id is None else enc._packed([end_id])
        fs, folder = _filesystem(base)
        fs.create_dir(folder, recursive=True)
        name, out, at, start, number = None, None, 0, 0, 0

        def put(ids: list, coded: list[bytes]) -> pa.RecordBatch:
            """Append the records to the file; their rows of the index."""
            nonlocal name, out, at, start, number
            heads = [struct.pack("<BBq", i is not None, enc.width, i or 0) for i in ids]
            index = []
            for i, c, f in zip(ids, coded, frame([h + c for h, c in zip(heads, coded, strict=True)]), strict=True):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at, start = f"{folder}/part-{part:06d}-{number:04d}-{attempt}.rec", 0, 0
                    out, number = fs.open_output_stream(name), number + 1
                out.write(f)
                n = len(c) // enc.width
                index.append((part, os.path.basename(name), at, len(f), i, start, n))
                at, start = at + len(f), start + n
            types = (pa.int32(), pa.string(), *[pa.int64()] * 5)
            columns = [pa.array(c, t) for c, t in zip(zip(*index, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["part", "file", "offset", "length", "doc_id", "start", "n_tokens"])

        try:
            ids, coded, size = [], [], 0
            for b in batches:
                lengths = pc.utf8_length(b.column(1)).to_pylist()
                for lo, hi in spans_of(lengths, max(_SPAN, _WINDOW)):
                    texts = b.column(1).slice(lo, hi - lo).to_pylist()
                    if hi - lo == 1 and lengths[lo] > _WINDOW:
                        found = [b"".join(enc.encode([w])[0] for w in enc.windows(texts[0]))]
                    else:
                        found = enc.encode(texts)
                    ids += b.column(0).slice(lo, hi - lo).to_pylist()
                    coded += [c + end for c in found]
                    size += sum(map(len, found))
                    if size > _FRAMED:
                        yield put(ids, coded)
                        ids, coded, size = [], [], 0
            if ids:
                yield put(ids, coded)
        finally:
            if out is not None:
                out.close()

    index = ordered.mapInArrow(run, INDEX).withColumn("file", F.concat(F.lit(base.rstrip("/") + "/"), "file"))
    if path:
        index.write.parquet(f"{path}/index")
        return docs.sparkSession.read.schema(index.schema).parquet(f"{path}/index")
    return store.put(index, "index")


# ------------------------------------------------------------------ reading


def with_global_start(index: DataFrame) -> DataFrame:
    """The index with ``start`` counted over all files.  The window sees one row for each file."""
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    return index.join(bases, "file").withColumn("start", F.col("start") + F.col("__base")).drop("__base")


def _read(file: str, lo: int, hi: int) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    fs, path = _filesystem(file)
    with fs.open_input_file(path) as f:
        data = f.read_at(hi - lo, lo)
    for parts in unframe(data):
        out = []
        for p in parts:
            has_id, width, i = struct.unpack_from("<BBq", p)
            out.append((i if has_id else None, np.frombuffer(p, f"<u{width}", offset=10)))
        yield out


def _ranges(index: DataFrame, read_bytes: int) -> DataFrame:
    """Consecutive records of a file as one byte range each, dealt out evenly."""
    starts = with_global_start(index)
    ranges = starts.groupBy("file", F.floor(F.col("offset") / read_bytes).alias("k")).agg(
        F.min("offset").alias("lo"), F.max(F.col("offset") + F.col("length")).alias("hi"), F.min("start").alias("start")
    )
    total = index.agg(F.sum("length")).first()[0] or 0
    return ranges.select("file", "lo", "hi", "start").repartition(max(1, min(100_000, -(-total // read_bytes))))


def read_records(index: DataFrame, *, shuffle_seed: int | None = None, read_bytes: int = 1 << 25) -> DataFrame:
    """(doc_id, start, ids) of the records that ``index``, or any rows of it, names, read from the
    files: in file order within each task or, with a seed, in a random order over all files, where
    every record is fetched by its offset."""
    if shuffle_seed is None:
        units = _ranges(index, read_bytes)
    else:
        dice = F.xxhash64("file", "offset", F.lit(shuffle_seed))
        rows = with_global_start(index).select("file", F.col("offset").alias("lo"), (F.col("offset") + F.col("length")).alias("hi"), "start")
        total = index.agg(F.sum("length")).first()[0] or 0
        units = rows.repartitionByRange(max(1, min(100_000, -(-total // read_bytes))), dice).sortWithinPartitions(dice)

    def run(batches):
        for file, lo, hi, start in _units(batches):
            for part in _read(file, lo, hi):
                lengths = [len(ids) for _, ids in part]
                ends = np.cumsum([0, *lengths])
                flat = np.concatenate([ids.astype(np.int32) for _, ids in part])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
                columns = [pa.array([i for i, _ in part], pa.int64()), pa.array(start + ends[:-1], pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])
                start += int(ends[-1])

    return units.mapInArrow(run, "doc_id long, start long, ids array<int>")


def _units(batches):
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)


def digests(index: DataFrame, *, read_bytes: int = 1 << 25) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read back from the files: the CRC-32
    is that of the ids as little-endian 32-bit integers."""

    def run(batches):
        for file, lo, hi, start in _units(batches):
            for part in _read(file, lo, hi):
                n = np.array([len(ids) for _, ids in part], np.int64)
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in part]
                columns = ([i for i, _ in part], start + np.cumsum(n) - n, n, sums)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                start += int(n.sum())

    return _ranges(index, read_bytes).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

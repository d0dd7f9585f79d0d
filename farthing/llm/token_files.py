"""Token ids of whole texts in Huffman-coded files.

Texts are dealt by ranges of doc_id and encoded once; a task keeps the ids of its range
in packed files and counts them. From the sums of all counts comes one code, with
which a second job writes the final files, one for each packed one. A file holds, all
little-endian: magic, number of texts, of ids and of block offsets; the texts' doc_ids and
numbers of ids; the blocks' bit offsets; the bit stream. The code lengths of the whole
set are one file beside them.

Words are encoded once per worker: a word between ASCII spaces always gives the same
ids, because the tokenizer's rules never look across white space; a bounded memory
of words serves all tasks of a worker. A word of Latin letters alone is one unit to those rules,
so it goes straight to the tokenizer's model; any other takes the whole tokenizer.

Defined results: null is an empty text, with only the end id; ties of doc_id keep any
order among equal texts, else that of the text's code; no rows give no files and
no rows; a null doc_id comes first; other columns are ignored.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farthing.llm import huffman
from farthing.llm.common import fan_out, in_batches, kept, new_folder, pieces, stored, utf8
from farthing.llm.files import Writer, get, put

END_ID = 1
#: Words that a worker remembers; past that it starts anew.
MEMORY = 700_000
#: Bytes of text in a range, and of ids in a file, about.
FILE_BYTES = 8 << 20
MAGIC, PACKED = 0x31465548, 0x31444950


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_LETTERS = _byte_letters()


class Words(dict):
    """Ids of words as bytes; one that is not there is encoded and remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        self[word] = ids = self.encode(word)
        return ids


class _Ends(dict):
    """Whether a character is a letter and ends in one when it is composed and lower-cased."""

    def __missing__(self, char: str) -> bool:
        self[char] = found = char.isalpha() and unicodedata.normalize("NFC", char).lower()[-1].isalpha()
        return found


_ENDS = _Ends()


class Encoder:
    """Ids of texts as bytes, by words."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.pack = {n: struct.Struct(f"<{n}{'H' if self.kind.itemsize == 2 else 'I'}").pack for n in range(64)}
        self.known = Words(self._encode)
        self.plain = self._takes_letters()

    def _takes_letters(self) -> bool:
        """Whether this tokenizer treats letters as ``_unit`` says: lower-cased, one unit."""
        words = ["The", "élan", "ÉCOLE", "straße", "x", "ñandú", "Wörterbücher"]
        whole = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        return whole == [[t.id for t in self.tokenizer.model.tokenize(self._unit(w))] for w in words]

    @staticmethod
    def _unit(word: str) -> str | None:
        """What the model sees of a word of Latin letters alone; None for other words."""
        if word.isascii():
            return word.lower() if word.isalpha() else None
        low = word.lower()
        if word.isalpha() and low.isalpha() and max(low) < "\u0250" and max(word) < "\u0250":
            return "".join([_LETTERS[b] for b in low.encode()])
        return None

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """A word as two parts that are encoded apart: a full stop or comma after a letter is one.

        It must be a letter still when it is composed and lower-cased, as the tokenizer does: some end in a mark then,
        which makes one unit with what follows.
        """
        if word[-1:] in (b".", b",") and len(word) > 1:
            body = word[:-1]
            if body[-1:].isalpha():
                return body, word[-1:]
            if body[-1] >= 0x80 and _ENDS[body[-4:].decode("utf-8", "ignore")[-1:]]:
                return body, word[-1:]
        return word, b""

    def _bytes(self, ids: list[int]) -> bytes:
        return self.pack[len(ids)](*ids) if len(ids) < 64 else np.array(ids, self.kind).tobytes()

    def _encode(self, word: bytes) -> bytes:
        body, stop = self._parts(word)
        if stop:
            return self.known[body] + self.known[stop]
        text = word.decode("utf-8", "replace")
        unit = self._unit(text) if self.plain else None
        if unit is None:
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return self.known.get(word.lower()) or self._bytes([t.id for t in self.tokenizer.model.tokenize(unit)])

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self.known) > MEMORY:
            self.known.clear()
        get = self.known.__getitem__
        return [b"".join(map(get, t.split())) if t else b"" for t in texts]


def _encoder(path: str) -> Encoder:
    return kept(f"encoder {path}", lambda: Encoder(path))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list]]:
    for a, b in pieces(batch, "text"):
        part = batch.slice(a, b - a)
        yield part, part.column("text").to_pylist()


def _header(magic: int, docs: np.ndarray, sizes: np.ndarray, *numbers: int) -> bytes:
    return b"".join(x.astype("<i8").tobytes() for x in (np.array([magic, len(docs), *numbers]), docs, sizes))


def _doc_ids(parts: list[pa.Array]) -> np.ndarray:
    return pa.concat_arrays(parts).cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()


def pack(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Ids of all texts in packed files, in ascending order: a row per file, and one per id and task.

    File rows have (part, serial, name, n_docs, n_tokens), count rows (id, n).
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-int(size) // FILE_BYTES))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", utf8())
    kinds = [("part", pa.int32()), ("serial", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("id", pa.int32()), ("n", pa.int64())]
    schema = pa.schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part, end, press = TaskContext.get().partitionId(), np.array([end_id], encoder.kind).tobytes(), zstandard.ZstdCompressor(level=1)
        total = np.zeros(0, np.int64)
        held, docs_, count, serial = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, docs_, count, serial, total
            raw = np.frombuffer(b"".join(held), np.uint8).reshape(-1, encoder.kind.itemsize)
            sizes = np.array([len(h) for h in held], np.int64) // encoder.kind.itemsize
            found = np.bincount(raw.reshape(-1).view(encoder.kind), minlength=len(total))
            found[: len(total)] += total
            total = found
            planes = [press.compress(np.ascontiguousarray(raw[:, k]).tobytes()) for k in range(raw.shape[1])]
            data = _header(PACKED, _doc_ids(docs_), sizes, len(raw), len(planes), *map(len, planes))
            row = {"part": part, "serial": serial, "name": put(folder, f"ids-{part:05d}-{serial:05d}", data + b"".join(planes)), "n_docs": len(sizes), "n_tokens": len(raw)}
            held, docs_, count, serial = [], [], 0, serial + 1
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for piece, texts in _texts(batch):
                held += [t + end for t in encoder.encode(texts)]
                docs_.append(piece.column("doc_id"))
                count += sum(map(len, held[-len(texts) :]))
                if count >= FILE_BYTES:  # a range with long texts makes more than one file
                    yield flush()
        if held:
            yield flush()
        at = np.flatnonzero(total)
        nothing = [pa.nulls(len(at), k) for _, k in kinds[:5]]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array(at.astype(np.int32)), pa.array(total[at])], schema=schema)

    return in_batches(rows, work, "part int, serial int, name string, n_docs bigint, n_tokens bigint, id int, n bigint", f"encoder {tokenizer}")


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, numbers of ids and all ids of one packed file."""
    magic, n_docs, n_ids, n_planes = np.frombuffer(data, "<i8", 4)
    if magic != PACKED:
        raise ValueError("not a packed file")
    at = 8 * (4 + int(n_planes))
    lengths = np.frombuffer(data, "<i8", n_planes, 32)
    docs, sizes = np.frombuffer(data, "<i8", n_docs, at), np.frombuffer(data, "<i8", n_docs, at + 8 * n_docs)
    at += 16 * int(n_docs)
    raw = np.empty((n_ids, n_planes), np.uint8)
    for k, length in enumerate(lengths.tolist()):
        raw[:, k] = np.frombuffer(zstandard.decompress(data[at : at + length], max_output_size=int(n_ids)), np.uint8)
        at += length
    return docs, sizes, raw.reshape(-1).view(f"<u{int(n_planes)}")


def write(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """The files of all texts: (part, serial, name, n_docs, n_tokens, n_bytes) of each, and the code's file."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    packed = stored(pack(docs, tokenizer, folder, end_id), "packed")
    found = packed.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # one number per id
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, np.int64)
    counts[found["id"].to_numpy(int)] = found["n"].to_numpy()
    lengths = huffman.code_lengths(counts)
    book = put(folder, "code", lengths.tobytes())
    shared = spark.sparkContext.broadcast(lengths)
    files = packed.where("name is not null").select("part", "serial", "name", "n_docs", "n_tokens")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared.value
        codes = huffman.canonical(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                docs, sizes, ids = unpack(get(row["name"]))
                stream, marks = huffman.encode(ids, codes, lengths)
                out = Writer(folder, f"part-{row['part']:05d}-{row['serial']:05d}")
                out.write(_header(MAGIC, docs, sizes, len(ids), len(marks)))
                out.write(marks.astype("<i8").tobytes())
                out.write(stream)
                out.close()
                yield pa.RecordBatch.from_pylist([row | {"name": out.name, "n_bytes": out.bytes}], pa.schema(_FILE))

    coded = in_batches(fan_out(files, files.count()), work, "part int, serial int, name string, n_docs bigint, n_tokens bigint, n_bytes bigint")
    return stored(coded, "token-files"), book


_FILE = [("part", pa.int32()), ("serial", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]


def read_file(data: bytes, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, numbers of ids and all ids of one file."""
    magic, n_docs, n_ids, n_marks = np.frombuffer(data, "<i8", 4)
    if magic != MAGIC:
        raise ValueError("not a token file")
    docs = np.frombuffer(data, "<i8", n_docs, 32)
    sizes = np.frombuffer(data, "<i8", n_docs, 32 + 8 * n_docs)
    marks = np.frombuffer(data, "<i8", n_marks, 32 + 16 * n_docs)
    stream = data[32 + 16 * n_docs + 8 * n_marks :]
    return docs, sizes, huffman.decode(stream, marks, int(n_ids), table)


def read(files: DataFrame, book: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every text, from the files alone.

    ``ids`` are little-endian unsigned 32-bit integers; ``start`` counts the ids of all
    texts before. One small row per file is put in order to number them.
    """
    shared = files.sparkSession.sparkContext.broadcast(np.frombuffer(get(book), np.uint8))
    before = Window.orderBy("part", "serial").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(shared.value)
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist()):
                docs, sizes, ids = read_file(get(name), table)
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4")
                for a in range(0, len(docs), 512):
                    own = range(a, min(a + 512, len(docs)))
                    held = [raw[ends[i] - sizes[i] : ends[i]].tobytes() for i in own]
                    least = np.iinfo(np.int64).min
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if docs[i] == least else int(docs[i]) for i in own], pa.int64()),
                            pa.array(base + ends[a : a + 512] - sizes[a : a + 512]), pa.array(sizes[a : a + 512].astype(np.int64)),
                            pa.array([zlib.crc32(h) for h in held], pa.int64()), pa.array(held, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                    )

    dealt = fan_out(placed, files.count())
    return in_batches(dealt, work, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")

"""Token ids in binary files, compressed document by document with a shared dictionary.

A zstandard dictionary is trained on the serialized id arrays of a bounded
sample of the documents. Every document is tokenized, serialized and
compressed by itself, dealt out by ranges of its doc_id and written in that
order; a file keeps the hash of its dictionary and, at its end, where every
document's frame starts. So a short document costs one seek and one small
frame to read, and none of its neighbours.

A folder holds ``dictionary`` (one file), ``files/*.tok`` and ``manifest``
(a Parquet table of the files that count, in order). A task that is run again
writes a file of another name; the manifest lists those of the tasks that
Spark accepted, so what failed attempts leave behind is never read.

File format (little-endian): the 8 bytes of ``MAGIC``, the dictionary's
xxHash (8 bytes); the frames, each a zstandard frame of the document's ids as
unsigned 32-bit numbers; the index, 32 bytes a document: doc_id (signed,
64 bits), whether it is NULL, the end of its frame in the file and its number
of ids (each unsigned, 64 bits); the place of the index, the index's xxHash
(8 bytes each) and ``MAGIC`` again.
"""

from __future__ import annotations

import array
import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.common import hash_sample, materialize, row_key, ship_by_value
from tessera.session import ensure_checkpoint_dir

#: Fixed value: what a file begins and ends with.
MAGIC = b"TOKFILE1"
_INDEX = np.dtype([("doc_id", "<i8"), ("no_id", "<u8"), ("end", "<u8"), ("n_tokens", "<u8")])
_HEAD, _FOOT = "<8sQ", "<QQ8s"

#: Documents that the dictionary is trained on and bytes of ids taken in all, its size, and the compression level.
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 2000, 16 << 20, 112_640, 3
#: Bytes of frames in a file, and parts of texts whose ids a worker remembers (at most twice so many).
FILE_BYTES, REMEMBERED = 64 << 20, 1 << 18
#: Characters of texts that a worker encodes at a time.
TEXT_AT_ONCE = 8 << 20

#: Latin letters. Runs of them, with an apostrophe inside or not, and what stands between the runs, are
#: cut apart by a byte-level tokenizer in any case, and so is a text before a space.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_UNIT = re.compile(f" ?[{_LETTERS}]+(?:'+[{_LETTERS}]+)*|(?:'[{_LETTERS}']*| (?![{_LETTERS}])|[^{_LETTERS}' ])+")
#: A space with white space on both sides does not always end a unit, nor does white space of two characters;
#: letters beyond Latin-1 may join with Latin ones.
_INSIDE_SPACE, _TWO_SPACES, _BEYOND = re.compile(r" (?<=\s )(?=\s|\Z)"), re.compile(r"\s\s"), re.compile("[^\x00-\xff]")


def _byte_letters() -> dict[int, str]:
    """What stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path there; a path without a scheme is a local one."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class _Remembered(dict):
    """The latest results of a function: a young and an old generation of at most ``most`` each."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Rules(NamedTuple):
    """What to know of a tokenizer: whether a text may be encoded in parts, and its special strings."""

    by_parts: bool
    special: tuple[str, ...]

    @classmethod
    def of(cls, tokenizer: bytes) -> Rules:
        made_of = json.loads(tokenizer)
        cut, added, model = made_of.get("pre_tokenizer") or {}, made_of.get("added_tokens") or (), made_of["model"]
        by_parts = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        by_parts = by_parts and model["type"] == "BPE" and not model.get("ignore_merges") and not made_of.get("normalizer")
        by_parts = by_parts and not any(x.get("lstrip") or x.get("rstrip") or " " in x["content"] for x in added)
        return cls(bool(by_parts), tuple(x["content"] for x in added))


class Encoder:
    """Texts to serialized ids; remembers the ids of frequent parts of texts where the tokenizer allows it."""

    def __init__(self, tokenizer: bytes, rules: Rules, end_id: int | None, remembered: int = REMEMBERED):
        self.tokenizer, self.rules = Tokenizer.from_buffer(tokenizer), rules
        self.end = b"" if end_id is None else struct.pack("<I", end_id)
        self.tokenize, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.parts, self.units = _Remembered(self._part, remembered), _Remembered(self._unit, remembered // 16)
        self.marks = {m: self._whole(m) for m in ".,;:!?"}

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str, before: str = "\u0120") -> bytes:
        """The ids of a word after a space (or what ``before`` stands for): one pre-token, which goes to the model itself."""
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array.array("I", [t.id for t in self.tokenize(before + spelled)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if unit.isalpha():
            return self._word(unit, "")
        if unit[0] == " " and unit[1:].isalpha():
            return self.parts[unit[1:]]
        return self._whole(unit)

    def _part(self, part: str) -> bytes:
        """The ids of a space and what follows it up to the next."""
        if part.isalpha():
            return self._word(part)
        if part[-1:] in self.marks and part[:-1].isalpha():
            return self.parts[part[:-1]] + self.marks[part[-1]]
        return self._cut(" " + part)

    def _cut(self, text: str) -> bytes:
        if _BEYOND.search(text) or _TWO_SPACES.search(text) or any(x in text for x in self.rules.special):
            return self._whole(text)
        units = self.units
        return b"".join([units[u] for u in _UNIT.findall(text)])

    def batch(self, texts: list[str]) -> list[bytes]:
        """The serialized ids of every text, each with the end id."""
        whole = [not self.rules.by_parts or _INSIDE_SPACE.search(t) is not None for t in texts]
        ids = iter(self._by_parts([t for t, w in zip(texts, whole, strict=True) if not w]))
        return [self._whole(t) + self.end if w else next(ids) for t, w in zip(texts, whole, strict=True)]

    def _by_parts(self, texts: list[str]) -> list[bytes]:
        """Every different part of the texts is looked up once; the texts' ids are gathered from those of the parts."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        # Where the texts' parts begin and end; each text has one at least.
        bounds, codes = np.asarray(cut.offsets), pc.dictionary_encode(cut.flatten())
        remembered, n = self.parts, len(codes.dictionary)
        ids = [remembered[p] for p in codes.dictionary.to_numpy(zero_copy_only=False)]
        # A text's first part has no space before it, and after its last one comes the end.
        ids += [self._cut(t.partition(" ")[0]) for t in texts]
        ids.append(self.end)
        at = np.arange(len(texts))
        codes = np.insert(np.asarray(codes.indices), bounds[1:], len(ids) - 1)
        codes[bounds[:-1] + at] = n + at
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, every_id = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(ids), np.uint32)
        sizes = sizes[codes]
        ends = np.cumsum(sizes)
        small = np.int32 if max(len(every_id), ends[-1]) < 1 << 31 else np.int64
        places = np.repeat((first[codes] - ends + sizes).astype(small), sizes)
        places += np.arange(len(places), dtype=small)
        joined, ends = every_id[places].tobytes(), (4 * ends[bounds[1:] + at]).tolist()
        return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts in slices of at most ``TEXT_AT_ONCE`` characters (a longer text by itself), and where each begins."""
    start, size, held = 0, 0, []
    for k, t in enumerate(texts):
        text = t.as_py()
        if held and size + len(text) > TEXT_AT_ONCE:
            yield start, held
            start, size, held = k, 0, []
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def _encoder(held: dict) -> Encoder:
    """The encoder of a broadcast dict; a worker makes one and keeps it there for its later tasks."""
    if "encoder" not in held:
        held["encoder"] = Encoder(held["tokenizer"], Rules(*held["rules"]), held["end_id"])
    return held["encoder"]


def train_dictionary(rows: DataFrame, held: dict, sample: int = SAMPLE) -> bytes:
    """A dictionary from ``sample`` documents, chosen by hash; empty if there is too little to train on."""
    shared = rows.sparkSession.sparkContext.broadcast(held)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for b in batches:
            # A sample of ids; of a long document its first 64 kB are enough for the dictionary.
            ids = [x[: 1 << 16] for _, texts in _slices(b.column(0)) for x in encoder.batch(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    samples, room = [], SAMPLE_BYTES
    for r in hash_sample(rows, sample, "doc_id", "key").select("text").mapInArrow(encode, "ids binary").toLocalIterator():
        room -= len(r.ids)
        if room < 0:
            break
        samples.append(bytes(r.ids))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **shared)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = 2,
    file_bytes: int = FILE_BYTES,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the documents' ids into a new folder; returns the manifest.

    ``file, path, n_docs, n_tokens, bytes, first_token, first_doc``: the files
    in order, with how many documents and ids stand before each. Documents go by
    doc_id (NULL last), then text hash; ``end_id`` ends every one. A NULL text is
    empty; repeated rows are written one by one; an empty table gives no files.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        tokenizer = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held = {"tokenizer": tokenizer, "rules": tuple(Rules.of(tokenizer)), "end_id": end_id}
    dictionary = train_dictionary(rows, held, sample)
    _put(folder, "dictionary", dictionary)
    shared = spark.sparkContext.broadcast(held | {"dictionary": dictionary})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        encoder, compressor = _encoder(held), _compressor(held["dictionary"])
        for b in batches:
            for start, texts in _slices(b.column(2)):
                part, ids = b.slice(start, len(texts)), encoder.batch(texts)
                arrays = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([compressor.compress(x) for x in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *arrays], ["doc_id", "key", "n_tokens", "frame"])

    frames = materialize(rows.mapInArrow(encode, "doc_id long, key long, n_tokens long, frame binary"))
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    # Equal rows may go to different files: only their place tells them apart.
    dealt = frames.withColumn("no_id", F.col("doc_id").isNull()).withColumn("tie", F.monotonically_increasing_id())
    order = ["no_id", "doc_id", "key", "tie"]
    dealt = dealt.repartitionByRange(max(1, -(-size // file_bytes)), *order).sortWithinPartitions(*order)
    digest = xxhash.xxh64_intdigest(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = None
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                path = posixpath.join(folder, "files", f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok")
                out = _Writer(path, digest)
            for row in zip(*(b.column(c) for c in ("doc_id", "n_tokens", "frame")), strict=True):
                out.add(*(x.as_py() for x in row))
        if out is not None:
            n_docs, n_tokens, n_bytes = out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([path]), *(pa.array([x], pa.int64()) for x in (n_docs, n_tokens, n_bytes))],
                ["file", "path", "n_docs", "n_tokens", "bytes"],
            )

    _put(folder, "files/_format", MAGIC)  # makes the folder
    files = dealt.select("doc_id", "n_tokens", "frame").mapInArrow(write, "file int, path string, n_docs long, n_tokens long, bytes long")
    files.write.parquet(posixpath.join(folder, "manifest"))
    return manifest(spark, folder)


class _Writer:
    """One file: frames as they come, then the index."""

    def __init__(self, path: str, digest: int):
        fs, place = _filesystem(path)
        self.out, self.end, self.entries = fs.open_output_stream(place), struct.calcsize(_HEAD), []
        self.out.write(struct.pack(_HEAD, MAGIC, digest))

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.out.write(frame)
        self.end += len(frame)
        self.entries.append((doc_id or 0, doc_id is None, self.end, n_tokens))

    def close(self) -> tuple[int, int, int]:
        index = np.array(self.entries, _INDEX)
        self.out.write(index.tobytes())
        self.out.write(struct.pack(_FOOT, self.end, xxhash.xxh64_intdigest(index.tobytes()), MAGIC))
        self.out.close()
        return len(index), int(index["n_tokens"].sum()), self.end + index.nbytes + struct.calcsize(_FOOT)


def _put(folder: str, name: str, data: bytes) -> None:
    fs, place = _filesystem(posixpath.join(folder, name))
    fs.create_dir(posixpath.dirname(place), recursive=True)
    with fs.open_output_stream(place) as out:
        out.write(data)


def _dictionary(folder: str) -> bytes:
    fs, place = _filesystem(posixpath.join(folder, "dictionary"))
    with fs.open_input_stream(place) as f:
        return f.read()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder in order, with the ids and documents before each (one row a file)."""
    files = spark.read.schema("file int, path string, n_docs long, n_tokens long, bytes long").parquet(posixpath.join(folder, "manifest"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    total = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(name) for c, name in (("n_tokens", "first_token"), ("n_docs", "first_doc"))]
    return files.select("*", *total)


class TokenFile:
    """A file of token ids: its index, and the ids of any document by its number in the file."""

    def __init__(self, path: str, dictionary: bytes):
        fs, place = _filesystem(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        head = self.file.read_at(struct.calcsize(_HEAD), 0)
        index_at, digest, magic = struct.unpack(_FOOT, self.file.read_at(struct.calcsize(_FOOT), size - struct.calcsize(_FOOT)))
        if struct.unpack(_HEAD, head) != (MAGIC, xxhash.xxh64_intdigest(dictionary)) or magic != MAGIC:
            raise ValueError(f"{path} is no file of token ids with this dictionary")
        index = self.file.read_at(size - struct.calcsize(_FOOT) - index_at, index_at)
        if xxhash.xxh64_intdigest(index) != digest:
            raise ValueError(f"the index of {path} is damaged")
        self.index = np.frombuffer(index, _INDEX)
        self.starts = np.concatenate(([struct.calcsize(_HEAD)], self.index["end"].astype(np.int64)))
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self._expand = zstandard.ZstdDecompressor(**shared)

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, k: int) -> np.ndarray:
        """The ids of the k-th document: one read of its frame."""
        return self._ids(self.file.read_at(int(self.starts[k + 1] - self.starts[k]), int(self.starts[k])))

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self._expand.decompress(frame), "<u4")

    def __iter__(self) -> Iterator[np.ndarray]:
        for k in range(len(self)):
            yield self[k]


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """All documents of a folder, from its files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the
    unsigned CRC-32 of the document's ids as little-endian 32-bit numbers.
    """
    dictionary = _dictionary(folder)
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                file = TokenFile(path, dictionary)
                done = 0
                while done < len(file):
                    part = file.index[done : done + 1000]
                    ids = [file[k] for k in range(done, done + len(part))]
                    counts = np.array([len(x) for x in ids], np.int64)
                    if (counts != part["n_tokens"].astype(np.int64)).any():
                        raise ValueError(f"{path} is damaged")
                    starts = first + np.cumsum(counts) - counts
                    first += int(counts.sum())
                    done += len(part)
                    columns = [pa.array(part["doc_id"], mask=part["no_id"].astype(bool)), pa.array(starts), pa.array(counts), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names)

    files = manifest(spark, folder).select("path", "first_token")
    return files.repartition(max(1, files.count()), "path").mapInArrow(read, kinds)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with a doc_id: the index of every file, and the frames asked for alone."""
    dictionary = _dictionary(folder)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                file = TokenFile(path, dictionary)
                at = np.flatnonzero((file.index["doc_id"] == doc_id) & (file.index["no_id"] == 0)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array([file[k].tobytes() for k in at], pa.binary())], ["path", "at", "ids"])

    found = manifest(spark, folder).select("path").mapInArrow(look, "path string, at long, ids binary").orderBy("path", "at").collect()
    return [np.frombuffer(r.ids, "<u4") for r in found]


def new_folder(spark: SparkSession) -> str:
    """A name for a folder of token files in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-tokens-{uuid.uuid4().hex}"


ship_by_value(__name__)

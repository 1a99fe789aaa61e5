"""Token ids in shards: each document compressed on its own with one shared dictionary.

A zstandard dictionary is trained on the serialized ids of a bounded sample. Documents
lie in the shards in ascending id order, each as its own frame, so that a short document
is read without its neighbours. A shard is

    magic, width of an id in bytes (1 byte), SHA-256 of the dictionary (32 bytes),
    frames, index, offset of the index (8 bytes), magic

and its index is an Arrow stream of key, offset, size and n_tokens. A task writes under
a name of its own attempt and renames at the end, so a repeated task replaces its file.

The dictionary (``dictionary-<SHA-256>``), a table of the shards (``manifest``) and what else a reader
must know (``format.json``, written last) lie beside the shards, so that anyone can
read the folder: ``open_folder``.

Defined results: a null or empty text is its end token alone. Null ids come first, repeated
ids side by side in the order of their texts. An empty table makes no shard and no rows.
Extra columns of the input are not written. A sample too small to train on gives an
empty dictionary.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow.fs import FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.byte_bpe import document_encoder, vocabulary_path, vocabulary_size
from eventmart.llm.pretokens import BYTES_AT_ONCE
from eventmart.llm.runtime import first_by_hash, one_a_key, prepare, text_slices

END = 0
MAGIC = b"TOKSHRD1"
LEVEL = 3
SHARD_BYTES = 64 << 20
# Documents the dictionary is trained on, the length of a sample (long documents make
# several), and the dictionary's size.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 16_384, 65_536

MANIFEST = "shard int, part int, path string, n_docs long, n_tokens long"


@dataclass(frozen=True)
class Format:
    """What all shards of one write share."""

    width: int
    dictionary: bytes

    @property
    def digest(self) -> bytes:
        return hashlib.sha256(self.dictionary).digest()

    def _shared(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None

    def compressor(self) -> zstandard.ZstdCompressor:
        shared = self._shared()
        if shared:
            shared.precompute_compress(level=LEVEL)  # once, and not for every document
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._shared())


def serialize(ids: bytes, width: int) -> bytes:
    """32-bit ids in the shard's width."""
    return ids if width == 4 else np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()


def train(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too short samples
        return b""


@lru_cache(maxsize=8)
def _filesystem(root: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(root)


def _open(root: str):
    """File system and path of a folder given as a URI or absolute path."""
    return _filesystem(root)


def rename(fs, source: str, target: str) -> None:
    """Moves a file to its name, also where another attempt left one and the store won't replace it."""
    if fs.get_file_info(target).type != FileType.NotFound:
        fs.delete_file(target)
    fs.move(source, target)


def _put(root: str, name: str, data: bytes) -> None:
    """A whole small file, from the driver."""
    fs, folder = _open(root)
    with fs.open_output_stream(f"{folder}/.{name}") as out:
        out.write(data)
    rename(fs, f"{folder}/.{name}", f"{folder}/{name}")


def _get(root: str, name: str) -> bytes:
    fs, folder = _open(root)
    with fs.open_input_file(f"{folder}/{name}") as file:
        return file.read()


class ShardWriter:
    """Writes one shard file."""

    def __init__(self, root: str, name: str, attempt: int, form: Format):
        self._fs, folder = _open(root)
        self._path, self._hidden = f"{folder}/{name}", f"{folder}/.{name}.{attempt}"
        self._form, self._compress = form, form.compressor().compress
        self._out = self._fs.open_output_stream(self._hidden)
        self._out.write(MAGIC + bytes([form.width]) + form.digest)
        self.size = len(MAGIC) + 33
        self._index: list[tuple] = []
        self.n_tokens = 0

    def add(self, key, ids: bytes) -> None:
        frame = self._compress(serialize(ids, self._form.width))
        self._out.write(frame)
        self._index.append((key, self.size, len(frame), len(ids) // 4))
        self.size += len(frame)
        self.n_tokens += len(ids) // 4

    def close(self) -> int:
        key, offset, size, n_tokens = zip(*self._index)
        index = pa.RecordBatch.from_pydict({"key": list(key), "offset": list(offset), "size": list(size), "n_tokens": list(n_tokens)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_batch(index)
        self._out.write(sink.getvalue().to_pybytes() + self.size.to_bytes(8, "little") + MAGIC)
        self._out.close()
        rename(self._fs, self._hidden, self._path)
        return len(self._index)


class ShardReader:
    """Reads a shard: its index, and any document's ids by its place."""

    def __init__(self, root: str, name: str, form: Format):
        fs, folder = _open(root)
        self._file = fs.open_input_file(f"{folder}/{name}")
        head = self._file.read_at(len(MAGIC) + 33, 0)
        tail = self._file.read_at(len(MAGIC) + 8, self._file.size() - len(MAGIC) - 8)
        if head[: len(MAGIC)] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{name} is no complete token shard")
        if head[len(MAGIC) + 1 :] != form.digest:
            raise ValueError(f"{name} was written with another dictionary")
        self.width = head[len(MAGIC)]
        begin = int.from_bytes(tail[:8], "little")
        self.index = pa.ipc.open_stream(self._file.read_at(self._file.size() - len(MAGIC) - 8 - begin, begin)).read_all()
        self._decompress = form.decompressor().decompress

    def ids(self, offset: int, size: int) -> np.ndarray:
        """The ids of one document as unsigned 32-bit numbers."""
        return np.frombuffer(self._decompress(self._file.read_at(size, offset)), dtype=f"<u{self.width}").astype("<u4")

    def close(self) -> None:
        self._file.close()


def sample_format(frame: DataFrame, key: str, text: str) -> Format:
    """A format whose dictionary is trained on the documents with the lowest key hashes, one a key."""
    prepare(frame.sparkSession)
    keys = frame.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    chosen = first_by_hash(keys, "_key", SAMPLE_DOCS)
    texts = one_a_key(
        frame.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key"),  # SAMPLE_DOCS keys
        "_key",
        "_text",
    )
    width = 2 if vocabulary_size(vocabulary_path()) <= 1 << 16 else 4

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = document_encoder(vocabulary_path())
        for batch in text_slices(batches, 0, BYTES_AT_ONCE):
            whole = [serialize(ids, width) for ids in encoder.encode_all(batch.column(0))]
            found = [x[i : i + SAMPLE_BYTES] for x in whole for i in range(0, len(x), SAMPLE_BYTES)]
            yield pa.RecordBatch.from_pydict({"sample": pa.array(found, pa.binary())})

    rows = texts.select("_text").mapInArrow(serialized, "sample binary").collect()
    return Format(width, train(sorted(bytes(row["sample"]) for row in rows)))


def write(frame: DataFrame, key: str, text: str, root: str, form: Format, end_id: int = END) -> DataFrame:
    """Writes all documents to shards below ``root`` (an existing folder); returns the manifest."""
    prepare(frame.sparkSession)
    tail = int(end_id).to_bytes(4, "little")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        encoder = document_encoder(vocabulary_path())
        writer, part, done = None, 0, []

        def close() -> None:
            done.append((shard, part, f"shard-{shard:06d}-{part:04d}.tok", writer.close(), writer.n_tokens))

        for batch in text_slices(batches, 1, BYTES_AT_ONCE):
            for key_, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                writer = writer or ShardWriter(root, f"shard-{shard:06d}-{part:04d}.tok", attempt, form)
                writer.add(key_, ids + tail)
                if writer.size >= SHARD_BYTES:
                    close()
                    writer, part = None, part + 1
        if writer:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(("shard", "part", "path", "n_docs", "n_tokens"), row)) for row in done], schema=_ARROW_MANIFEST)

    ordered = (
        frame.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .repartitionByRange("_key")
        .sortWithinPartitions("_key", "_text")
    )
    ordered.mapInArrow(written, MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    dictionary = f"dictionary-{form.digest.hex()}"
    _put(root, dictionary, form.dictionary)
    told = {"width": form.width, "dictionary": dictionary, "end_id": int(end_id)}
    _put(root, "format.json", json.dumps(told).encode())
    return _manifest(frame.sparkSession, root)


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def open_folder(spark: SparkSession, root: str) -> tuple[DataFrame, Format]:
    """The manifest and format of a folder of shards, from its files alone."""
    told = json.loads(_get(root, "format.json"))
    form = Format(told["width"], _get(root, told["dictionary"]))
    if told["dictionary"] != f"dictionary-{form.digest.hex()}":
        raise ValueError(f"{root} holds another dictionary than its shards were written with")
    return _manifest(spark, root), form


_ARROW_MANIFEST = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)


def read(manifest: DataFrame, root: str, form: Format, key_type: str = "long") -> DataFrame:
    """``key``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document in the shards."""
    spark = manifest.sparkSession
    prepare(spark)
    # One row a shard: its place in the whole is the sum of those before it.
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    width = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism, 100_000))

    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = ShardReader(root, name, form)
                counts = reader.index.column("n_tokens").to_numpy()
                checks = [
                    zlib.crc32(reader.ids(offset, size))
                    for offset, size in zip(reader.index.column("offset").to_pylist(), reader.index.column("size").to_pylist())
                ]
                reader.close()
                yield pa.RecordBatch.from_arrays(
                    [
                        reader.index.column("key").combine_chunks(),
                        pa.array(base + np.cumsum(counts) - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(checks, pa.int64()),
                    ],
                    names=["key", "start", "n_tokens", "ids_crc32"],
                )

    shards = placed.select("path", "base").repartition(width)
    return shards.mapInArrow(loaded, f"key {key_type}, start long, n_tokens long, ids_crc32 long")


def make_folder(spark: SparkSession, path: str) -> str:
    """Creates a folder through Hadoop's file systems, wherever the path points."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    return path

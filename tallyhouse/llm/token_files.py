"""Token ids in Arrow files of equal-length sequences, open to random access without copies.

A shard is one Arrow IPC file, that is, an Arrow stream with a footer. Its record batches hold ``sequence``,
a fixed-size list of ``sequence_length`` ids, and ``mask``, a fixed-size list of as many booleans; all but
the last batch have ``sequences_per_batch`` rows. The ids of the documents follow one another in ascending
order of document, each closed by an end id, and only the last sequence of a shard is filled up (ids 0, mask
false). So id ``k`` of a shard lies in sequence ``k // sequence_length``, and a memory map of the file hands
out any sequence, or batch of sequences, as a view of the file.

A second Arrow file beside each shard lists its documents: id, first position in the shard, number of ids.
The manifest, a Parquet table, has one row per shard with the number of ids in all shards before it.

Documents are dealt to shards by ranges of their id. A shard is written under a name of the attempt and then
moved to its own name, so a task that is run again leaves one whole file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.pieces import PieceEncoder
from tallyhouse.llm.text import blocks
from tallyhouse.plans.lineage import qualified, scratch_path

SEQUENCE_LENGTH = 2048
SEQUENCES_PER_BATCH = 64
SHARD_BYTES = 64 << 20
_MANIFEST = "shard string, n_docs bigint, n_tokens bigint, first_id bigint, last_id bigint"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class FileEncoder:
    """Ids of texts as the library gives them for a tokenizer file as it is, without special tokens around them.

    A text that holds one of the file's added tokens is encoded by the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.pieces, self.size = load_encoder(path)
        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return self.pieces.encode(text)


@lru_cache(maxsize=2)
def load_file_encoder(path: str) -> FileEncoder:
    return FileEncoder(path)


@lru_cache(maxsize=2)
def load_encoder(path: str) -> tuple[PieceEncoder, int]:
    """Encoder of a tokenizer file of the tokenizers library, and the size of its vocabulary. Added tokens in a
    text are ordinary text to it; ``load_file_encoder`` gives them their own ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return PieceEncoder(_piece_encoder(tokenizer)), tokenizer.get_vocab_size()


def _piece_encoder(tokenizer) -> Callable[[str], bytes]:
    """Ids of one match of the pattern. Where the tokenizer is its model over bytes and nothing more, the model is
    asked directly, which takes half the time of another pass through all steps."""
    from tokenizers import pre_tokenizers

    steps, added = tokenizer.pre_tokenizer, tokenizer.get_added_tokens_decoder().values()
    plain = isinstance(steps, pre_tokenizers.ByteLevel) and steps.use_regex and not steps.add_prefix_space and not (
        tokenizer.normalizer or tokenizer.truncation or tokenizer.padding) and all(t.special for t in added)
    if not plain:
        return lambda piece: array("I", tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
    letters, tokenize = _byte_letters(), tokenizer.model.tokenize
    return lambda piece: array(
        "I", [t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))]).tobytes()


def _byte_letters() -> dict[int, int]:
    """The character that byte-level vocabularies write for each byte: itself if visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + k for k, b in enumerate(hidden)}


def file_schema(sequence_length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field("sequence", pa.list_(id_type, sequence_length)),
                      pa.field("mask", pa.list_(pa.bool_(), sequence_length))])


class ShardWriter:
    """Packs ids into equal sequences and writes them batch by batch."""

    def __init__(self, sink, vocabulary_size: int, sequence_length: int, sequences_per_batch: int):
        self.kind = np.uint16 if vocabulary_size <= 1 << 16 else np.uint32
        self.length, self.size = sequence_length, sequence_length * sequences_per_batch
        self.schema = file_schema(sequence_length, pa.from_numpy_dtype(self.kind))
        self.out = pa.ipc.new_file(sink, self.schema)
        self.waiting, self.n_waiting, self.n_tokens = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind))
        self.n_waiting += len(ids)
        self.n_tokens += len(ids)
        if self.n_waiting >= self.size:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.size * self.size
            for a in range(0, whole, self.size):
                self._write(flat[a:a + self.size], self.size)
            self.waiting, self.n_waiting = [flat[whole:].copy()], len(flat) - whole

    def _write(self, ids: np.ndarray, n: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:n] = True
        lists = lambda values: pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
        self.out.write_batch(pa.RecordBatch.from_arrays([lists(ids), lists(mask)], schema=self.schema))

    def close(self) -> None:
        if self.n_waiting:
            flat = np.zeros(-(-self.n_waiting // self.length) * self.length, self.kind)
            flat[:self.n_waiting] = np.concatenate(self.waiting)
            self._write(flat, self.n_waiting)
        self.out.close()


class Shard:
    """Reads a shard; a local file is mapped into memory, and the arrays returned are views of it."""

    def __init__(self, path: str):
        files, name = file_system(path)
        local = isinstance(files, fs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else files.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("sequence").type.list_size
        self.per_batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1

    def batch(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids of batch ``i``, one row per sequence, and its masks."""
        found = self.file.get_batch(i)
        return found.column(0).flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length), found.column(1)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``."""
        ids, masks = self.batch(i // self.per_batch)
        row = i % self.per_batch
        return ids[row], masks[row].values.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` on, over as many batches as they span."""
        size, out = self.per_batch * self.length, []
        while n > 0:
            flat = self.batch(start // size)[0].reshape(-1)[start % size:start % size + n]
            out.append(flat)
            start, n = start + len(flat), n - len(flat)
        return np.concatenate(out) if out else np.zeros(0, np.uint16)


def file_system(uri: str):
    """The file system and the name in it; the scheme that Hadoop has for S3 is another one here."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


def _write_file(files, name: str, write) -> None:
    """Write under a name of this attempt, then move to the shard's name."""
    draft = f"{name}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(draft) as sink:
        write(sink)
    files.move(draft, name)


def write_shards(docs: DataFrame, path: str, folder: str | None = None, id_column: str = "doc_id",
                 text_column: str = "text", end_id: int = 0, sequence_length: int = SEQUENCE_LENGTH,
                 sequences_per_batch: int = SEQUENCES_PER_BATCH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode all documents, write them as shards and return the manifest, read back from ``folder``.

    A null text is empty, and every document gets an end id. Rows with a null id are refused by an error,
    since they have no place in the order. Rows of one id are ordered by text; equal rows are kept. A shard
    holds a range of ids with about ``shard_bytes`` of text. Other columns are left out.

    ``folder`` is where Spark says it is, with or without scheme; it has to be one that all machines see.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    folder = qualified(spark, folder)
    rows = docs.select(
        F.when(F.col(f"`{id_column}`").isNull(), F.raise_error(F.lit("a document without id has no place")))
        .otherwise(F.col(f"`{id_column}`")).cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n_shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // shard_bytes))

    def run(batches):
        encoder = load_file_encoder(path)
        writer = None
        doc_ids, starts = array("q"), array("q")
        files, base = file_system(folder)

        def encode_all(sink):
            nonlocal writer
            writer = ShardWriter(sink, encoder.size, sequence_length, sequences_per_batch)
            end = array("I", [end_id]).tobytes()
            for some, _ in blocks(chain([first], batches), "text"):
                doc_ids.extend(some.column(0).to_pylist())
                for text in some.column(1).to_pylist():
                    starts.append(writer.n_tokens)
                    writer.add(np.frombuffer(encoder.encode(text) + end, "<u4"))
            writer.close()

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        files.create_dir(base, recursive=True)
        name = f"ids-{first.column(0)[0].as_py() + (1 << 63):020d}-{uuid.uuid5(uuid.NAMESPACE_OID, folder).hex[:8]}"
        _write_file(files, f"{base}/{name}.arrow", encode_all)
        ends = np.append(np.frombuffer(starts, np.int64)[1:], writer.n_tokens)
        index = pa.table([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                          pa.array(ends - np.frombuffer(starts, np.int64))], schema=_INDEX)

        def write_index(sink):
            with pa.ipc.new_file(sink, _INDEX) as out:
                out.write_table(index)

        _write_file(files, f"{base}/{name}.index.arrow", write_index)
        yield pa.RecordBatch.from_pylist([{
            "shard": f"{folder}/{name}.arrow", "n_docs": len(doc_ids), "n_tokens": writer.n_tokens,
            "first_id": doc_ids[0], "last_id": doc_ids[-1]}])

    manifest = (rows.repartitionByRange(n_shards, "id").sortWithinPartitions("id", "text")
                .mapInArrow(run, _MANIFEST))
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, with ``base``, the number of ids in the shards before it.

    The running sum is over shards, which are some 64 MB of text each, not over documents.
    """
    before = Window.orderBy("first_id", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest") \
        .withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """From the files alone, one row per document: id, ``start`` over all shards, ``n_tokens`` and
    ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["shard"])
                index = pa.ipc.open_file(_open(row["shard"].removesuffix(".arrow") + ".index.arrow")).read_all()
                starts, sizes = index["start"].to_numpy(), index["n_tokens"].to_numpy()
                sums = np.fromiter((zlib.crc32(shard.ids(int(a), int(n)).astype("<u4").tobytes())
                                    for a, n in zip(starts, sizes)), np.int64, len(starts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc_id"].to_numpy()), pa.array(starts + row["base"]), pa.array(sizes),
                     pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _open(uri: str):
    files, name = file_system(uri)
    return files.open_input_file(name)

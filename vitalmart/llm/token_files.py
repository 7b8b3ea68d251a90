"""Token ids in Arrow stream files with fixed-size-list batches.

Documents are range-partitioned by id and sorted, so the files hold the ids of all documents
one after another in id order. A file is an Arrow stream; each row of a batch is one sequence
of exactly ``length`` ids with a mask of as many flags, and every batch but the last of a file
has the same number of rows. So the place of sequence k follows from k alone, and a reader
that maps the file gets sequences and masks as views, without a copy. Only the last sequence
of a file is padded; padding has mask false.

Tasks write files under names of their own and report them in a manifest, which is stored;
only files in the manifest count, so a task that runs twice does no harm.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitalmart.llm.common import parts_for, shared_path, slices, stored, take_over, text_bytes, texts
from vitalmart.llm.pieces import SPACE, PieceTable, check_settings

LENGTH = 2048
ROWS = 64
FILE_TEXT_BYTES = 24 << 20
END_ID = 2
IN_A_ROW = 2_000
SLICE = 4 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class LibraryEncoder:
    """The tokenizers library behind a bounded table of pieces it has encoded."""

    _open: dict[str, LibraryEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        check_settings(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = id_kind(size)
        # Tokens that begin with a space: of pieces in a row, each begins with one of these.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.opens = np.zeros(max([size, *(i + 1 for i in vocabulary.values())]), bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.table = PieceTable(self._library, special)

    @classmethod
    def of(cls, path: str) -> LibraryEncoder:
        """One per worker process and file."""
        take_over("token_files", cls._open.clear)
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _library(self, parts: list[str]) -> list[bytes]:
        """Packed ids of each piece. Pieces that begin with their only space are encoded many in
        a row, as one text, and cut at the tokens that begin with a space."""
        out: list[bytes] = [b""] * len(parts)
        rows = [n for n, p in enumerate(parts) if p.startswith(" ") and p.count(" ") == 1]
        alone = [n for n, p in enumerate(parts) if not (p.startswith(" ") and p.count(" ") == 1)]
        for at in range(0, len(rows), IN_A_ROW):
            some = rows[at : at + IN_A_ROW]
            found = self.tokenizer.encode_batch_fast(["".join([parts[n] for n in some])], add_special_tokens=False)
            ids = np.array(found[0].ids, self.kind)
            starts = np.flatnonzero(self.opens[ids]) * ids.itemsize
            if len(starts) != len(some):  # some piece has such a token inside
                alone += some
                continue
            raw, cuts = ids.tobytes(), [*starts.tolist(), ids.nbytes]
            for n, i, j in zip(some, cuts, cuts[1:]):
                out[n] = raw[i:j]
        for at in range(0, len(alone), 5_000):  # the library's results are large while they last
            some = alone[at : at + 5_000]
            found = self.tokenizer.encode_batch_fast([parts[n] for n in some], add_special_tokens=False)
            for n, x in zip(some, found, strict=True):
                out[n] = np.array(x.ids, self.kind).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        return self.table.encode(texts)


def id_kind(vocabulary: int) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def file_schema(kind: str, length: int) -> pa.Schema:
    ids = pa.from_numpy_dtype(np.dtype(kind))
    return pa.schema(
        [
            pa.field("ids", pa.list_(pa.field("item", ids, nullable=False), length), nullable=False),
            pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), nullable=False),
        ],
        {"vitalmart.length": str(length), "vitalmart.ids": kind},
    )


class SequenceWriter:
    """Packs ids into sequences and writes full batches; holds one batch at most."""

    def __init__(self, path: str, kind: str, length: int = LENGTH, rows: int = ROWS):
        self.kind, self.length, self.full = kind, length, rows * length
        system, name = _opened(path)
        self.sink = system.open_output_stream(name)
        self.schema = file_schema(kind, length)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        if self.n_held >= self.full:
            flat = np.concatenate(self.held)
            cut = len(flat) // self.full * self.full
            for at in range(0, cut, self.full):
                self._batch(flat[at : at + self.full], self.full)
            self.held, self.n_held = [flat[cut:]], len(flat) - cut

    def _batch(self, flat: np.ndarray, real: int) -> None:
        ids, mask = self.schema.field("ids").type, self.schema.field("mask").type
        self.out.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(flat), type=ids),
                    pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < real), type=mask),
                ],
                schema=self.schema,
            )
        )

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held).astype(self.kind, copy=False)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            padded[: len(flat)] = flat
            self._batch(padded, len(flat))
        self.out.close()
        self.sink.close()


class SequenceFile:
    """Random access to a file's sequences; views of the mapped file where it is local."""

    def __init__(self, path: str):
        system, name = _opened(path)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else system.open_input_file(name)
        reader = pa.ipc.open_stream(self.source)
        self.length = int(reader.schema.metadata[b"vitalmart.length"])
        batches = list(reader)
        self.rows = batches[0].num_rows if batches else 1
        self.ids = [b.column("ids").flatten().to_numpy() for b in batches]
        self.masks = [b.column("mask") for b in batches]

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence ``k``, not copied."""
        batch, row = divmod(k, self.rows)
        at = row * self.length
        return self.ids[batch][at : at + self.length], self.masks[batch].flatten().slice(at, self.length)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on; a view if they lie in one batch."""
        size, found = self.rows * self.length, []
        while n > 0:
            batch, at = divmod(start, size)
            piece = self.ids[batch][at : at + n]
            found.append(piece)
            start, n = start + len(piece), n - len(piece)
        return found[0] if len(found) == 1 else np.concatenate([np.empty(0, "<u2"), *found]) if found else np.empty(0, "<u2")


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = END_ID,
    length: int = LENGTH,
    rows: int = ROWS,
    file_text_bytes: int = FILE_TEXT_BYTES,
) -> DataFrame:
    """Encodes whole texts with the tokenizers library and writes them as sequence files.

    ``end_id`` follows the ids of each document (None: nothing does). Files go below ``path``,
    or a fresh folder of the shared one; about ``file_text_bytes`` of text make a file. Returns
    the stored manifest: ``doc_id``, ``part`` (files in id order), ``file``, ``at`` (place of
    the first id in the file) and ``n_tokens``. NULL texts count as empty. NULL ids come
    first; rows of one id follow each other in the order of their texts; repeated rows are
    all written. An empty table gives no files. Other columns are left out.
    """
    spark = docs.sparkSession
    folder = path or shared_path(spark, "token-files")
    system, name = _opened(folder)
    system.create_dir(name, recursive=True)
    frame = texts(docs, id_col, text_col)
    parts = parts_for(text_bytes(frame), file_text_bytes)
    ranged = frame.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    names = ["doc_id", "part", "file", "at", "n_tokens"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = LibraryEncoder.of(tokenizer)
        kind = encoder.kind  # an end id beyond it fails loudly
        end = b"" if end_id is None else np.array([end_id], kind).tobytes()
        part = TaskContext.get().partitionId()
        file = f"{folder}/part-{part:07d}-{uuid.uuid4().hex}.arrows"
        out = None
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                if out is None and batch.num_rows:
                    out = SequenceWriter(file, kind, length, rows)
                ids, n = encoder.table.encode_column(batch.column("text"), kind, end)
                at = out.total + np.cumsum(n) - n if out else n
                if out:
                    out.add(ids)
                k = len(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([part] * k, pa.int64()), pa.array([file] * k), pa.array(at, pa.int64()), pa.array(n, pa.int64())],
                    names,
                )
        if out:
            out.close()

    schema = frame.select("doc_id").schema
    for column, kind in (("part", "long"), ("file", "string"), ("at", "long"), ("n_tokens", "long")):
        schema = schema.add(column, kind)
    return stored(ranged.mapInArrow(write, schema), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """The documents of a manifest from its files.

    Returns ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``,
    packed as little-endian unsigned 32-bit integers. Rows as in the manifest, empty if that is.
    The sums over files see one row a file.
    """
    sizes = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    placed = manifest.join(bases, "part").select(
        "doc_id", "file", "at", (F.col("base") + F.col("at")).alias("start"), "n_tokens"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids = []
                for file, first, n in zip(
                    batch.column("file").to_pylist(), batch.column("at").to_pylist(), batch.column("n_tokens").to_pylist(), strict=True
                ):
                    if file != name:
                        name, source = file, SequenceFile(file)
                    ids.append(source.tokens(first, n).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    schema = placed.select("doc_id", "start", "n_tokens").schema.add("ids", "binary")
    return placed.mapInArrow(read, schema)


def op1_token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The digest of the contract from the files read back."""
    return read_tokens(write_tokens(docs, tokenizer)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )

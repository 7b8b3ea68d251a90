"""BPE encoding and decoding through a prefix-sharing trie.

The merge procedure gives every prefix of a word exactly one encoding, and that encoding is
its last token behind the encoding of the rest. So one number per prefix, the last token,
holds all encodings. Distinct words of a batch go into a trie; a depth-first walk finds the
last token of each node from those of its ancestors, so a prefix many words share is encoded
once. A token may end a prefix if it is compatible with the last token before it: merging
the bytes of both leaves exactly these two.

Documents are mapped where they are; nothing is shuffled. A task keeps a bounded table of
words it has encoded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalmart.llm.common import computed, named, slices, take_over
from vitalmart.llm.pieces import PieceTable, check_settings

#: Fixed value: the pattern that splits text before merges in byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PAIRS = 300_000
BYTES = [bytes([b]) for b in range(256)]
NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, to the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        spec = check_settings(path)
        letters = byte_letters()
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.bytes_of: dict[int, bytes] = {
            i: as_bytes(t) for t, i in vocab.items() if t not in self.special
        }
        self.packed: dict[int, bytes] = {i: np.array([i], "<u4").tobytes() for i in self.bytes_of}
        self.rank: dict[int, int] = {vocab[c]: -1 for c in letters if c in vocab}
        self.split: dict[int, tuple[int, int]] = {}
        self.pair_rank: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.pair_rank[left, right] = r
            if made not in self.rank:
                self.rank[made] = r
                self.split[made] = (left, right)
        self.token_of: dict[bytes, int] = {}
        made = set(k for k, r in self.rank.items() if r < 0)
        for token, (a, b) in self.split.items():  # in the order of merges
            if a in made and b in made and self.compatible(a, b, self.rank[token]):
                made.add(token)
        self.token_of = {self.bytes_of[t]: t for t in made}
        self.longest = max(map(len, self.token_of))
        self.known: dict[int, bool] = {}

    def compatible(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether no merge of a rank under ``before`` joins the two across their border.

        Undoes merges latest first, so that the two symbols at the border are those that
        stood there at each time. Of equal merges the leftmost comes first.
        """
        limit = before
        rank = self.rank
        while True:
            if self.pair_rank.get((left, right), NEVER) < limit:
                return False
            if rank[left] > rank[right]:
                limit = rank[left]
                left = self.split[left][1]
            elif rank[right] >= 0:
                limit = rank[right] + 1
                right = self.split[right][0]
            else:
                return True

    def learn_pair(self, pair: int) -> bool:
        """Whether the two tokens of a packed pair may follow each other; kept in a bounded table."""
        if len(self.known) > PAIRS:
            self.known.clear()
        found = self.known[pair] = self.compatible(pair >> 20, pair & 0xFFFFF)
        return found


class Trie:
    """Distinct words; a node is the dict of its children by byte, ``None`` marks a word."""

    def __init__(self, words: Iterable[bytes]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for b in w:
                child = node.get(b)
                if child is None:
                    child = node[b] = {}
                node = child
            node[None] = None

    def encode(self, merges: Merges) -> Iterator[tuple[bytes, bytes]]:
        """Every word with its packed ids, depth first."""
        path = b""
        last: list[int] = [-1]
        token_of, bytes_of, known = merges.token_of, merges.bytes_of, merges.known
        longest, packed = merges.longest, merges.packed
        stack = [(self.root, 0, b"")]
        while stack:
            node, depth, byte = stack.pop()
            if depth:
                path = path[: depth - 1] + byte
                del last[depth:]
                # short tokens first: exactly one fits, and it is a short one most often
                for start in range(depth - 1, max(0, depth - longest) - 1, -1):
                    token = token_of.get(path[start:])
                    if token is None:
                        continue
                    if not start:
                        last.append(token)
                        break
                    pair = last[start] << 20 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = merges.learn_pair(pair)
                    if fits:
                        last.append(token)
                        break
                else:
                    raise ValueError(f"the vocabulary lacks byte {byte!r}")
            for b, child in node.items():
                if b is not None:
                    stack.append((child, depth + 1, BYTES[b]))
                else:
                    ids, at = [], depth
                    while at:
                        ids.append(packed[last[at]])
                        at -= len(bytes_of[last[at]])
                    ids.reverse()
                    yield path, b"".join(ids)


class Codec:
    """Encodes and decodes batches of texts; holds a bounded table of known pieces."""

    _open: dict[str, Codec] = {}

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.pattern = regex.compile(SPLIT)
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_ids = {k: np.array([v], "<u4").tobytes() for k, v in self.merges.special.items()}
        size = 1 + max([*self.merges.bytes_of, *self.merges.special.values()])
        self.decoded = [b""] * size
        for i, b in self.merges.bytes_of.items():
            self.decoded[i] = b
        for t, i in self.merges.special.items():
            self.decoded[i] = t.encode()
        self.table = PieceTable(self.learn, special)

    @classmethod
    def of(cls, path: str) -> Codec:
        """One per worker process and file."""
        take_over("bpe", cls._open.clear)
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def words(self, text: str) -> list[str]:
        """What merges apply to: matches of the pattern, and special tokens."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.pattern.findall(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.pattern.findall(text[at:])

    def learn(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece, by one walk of one trie of their new words."""
        words = [self.words(p) for p in pieces]
        ids = dict(self.special_ids)
        for w in {w for ws in words for w in ws}.difference(ids):
            if w[0] == " ":
                found = self.table.known(w[1:].encode())
                if found is not None:
                    ids[w] = found
        fresh = {w.encode() for ws in words for w in ws if w not in ids}
        for w, packed in Trie(fresh).encode(self.merges):
            ids[w.decode()] = packed
        get = ids.__getitem__
        return [b"".join(map(get, ws)) for ws in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        return self.table.encode(texts)

    def decode(self, ids: bytes) -> str:
        get = self.decoded.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Ids of every whole text under the byte-level BPE file ``tokenizer``.

    Returns one row per row of ``docs``: ``doc_id``, the columns named in ``carry`` and
    ``ids``, the token ids packed as little-endian unsigned 32-bit integers. The file must be
    at the same path on every executor. NULL and empty texts have no ids; strings of special
    tokens inside a text become these tokens; equal texts get equal ids; an empty table gives
    an empty result. Columns not in ``carry`` are left out, and so are those in it that are
    named like the new ones.
    """
    columns = (id_col, *[c for c in carry if c != id_col])

    def run(batch: list[str]):
        return [pa.array(Codec.of(tokenizer).encode(batch), pa.binary())]

    coded = computed(docs, columns, text_col, [T.StructField("ids", T.BinaryType())], run, 2 << 20)
    return coded.select(F.col("c0").alias("doc_id"), *named(columns, ("doc_id", id_col, "ids")), "ids")


def decode(df: DataFrame, tokenizer: str, *, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of the packed ids; special tokens as their strings.

    Bytes that are not UTF-8 become U+FFFD; NULL ids give NULL. A column ``decoded`` of the
    input is replaced.
    """
    frame = df.drop("decoded")
    names = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(tokenizer)
        for whole in batches:
            for batch in slices(whole, ids_col):
                out = [None if x is None else codec.decode(x) for x in batch.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*names, "decoded"])

    schema = T.StructType([*frame.schema, T.StructField("decoded", T.StringType())])
    return frame.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` as `encode` and then `decode` give them, in one pass.

    One Python worker a task does both, which halves the memory of a task. The text is decoded
    from the packed ids alone.
    """

    def run(batch: list[str]):
        codec = Codec.of(tokenizer)
        ids = codec.encode(batch)
        return [pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.string())]

    fields = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    return computed(docs, (id_col,), text_col, fields, run, 2 << 20).withColumnRenamed("c0", "doc_id")


def op2_bpe(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The digest of the contract: ids by the trie, then text from these ids."""
    coded = round_trip(docs, tokenizer)
    return coded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )

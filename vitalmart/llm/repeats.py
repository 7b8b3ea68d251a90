"""Exact substring dedup through enhanced suffix arrays.

A repeat of ``length`` bytes holds an anchor: of the ``K``-byte strings in every window of
``length`` bytes, the one of the smallest hash. Equal windows have equal anchors, so

1. each block of documents sends the hashes of its anchors, once each, to the hash's bucket;
   the bucket answers which of them other documents have too;
2. the block cuts the windows of these anchors out, consecutive ones of one anchor as one
   piece, and sends each distinct piece, with its places, to the bucket of its anchor;
3. the bucket sorts the suffixes of its distinct pieces, finds the common prefixes of
   neighbours and scans them with a stack for the tree of common-prefix intervals. An interval
   whose suffixes are preceded by different bytes is a maximal repeat, and its leaves are all
   of its occurrences. A suffix is covered as far as the deepest interval with a smaller id;
4. the block applies the spans it gets back.

Text is shuffled once, by block; all else is anchors and repeated pieces. Pieces that many
blocks share are sent once a block, and anchors found in very many blocks send their windows
one by one, dealt by the windows' own hashes, so no bucket gathers one key without bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.buckets import bucket_cuts, long_keys, short_keys
from vitalmart.llm.common import MAX_ID, id_or_last, parts_for, text_bytes, texts

LENGTH = 50
K = 20
BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 1 << 20  # of all text, for each bucket of anchors
PIECE = 1 << 17
HOT_BLOCKS = 2000
SORT_BYTES = 1 << 18  # of pieces, for each suffix array
ALONE = 2**16 - 1  # marks a window of a hot anchor, which is sent by itself
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def hashes(data: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of the ``k`` bytes at each place, by doubling."""
    power, size, whole = _BASE, 1, _BYTES[data]
    have, n = None, 0  # hash and size of the part of k that is done
    while True:
        if k & size:
            if have is None:
                have, n = whole, size
            else:  # the new part goes in front
                m = len(data) - n - size + 1
                have, n = whole[:m] * np.uint64(pow(_BASE, n, 1 << 64)) + have[size : size + m], n + size
        size *= 2
        if size > k:
            return _mix(have)
        m = len(whole) - size // 2
        whole = whole[:m] * np.uint64(power) + whole[size // 2 :]
        power = power * power % (1 << 64)


def smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of ``width`` values from each place on."""

    def lesser(v, p, step):
        m = len(v) - step
        right = v[step:] < v[:m]
        return np.where(right, v[step:], v[:m]), np.where(right, p[step:], p[:m])

    v, p, size = values, np.arange(len(values), dtype=np.int32), 1
    while size * 2 <= width:
        v, p = lesser(v, p, size)
        size *= 2
    if size < width:
        v, p = lesser(v, p, width - size)
    return p


@dataclass
class Anchors:
    """Runs of windows with one anchor: first window, windows, hash and place of the anchor."""

    first: np.ndarray
    count: np.ndarray
    key: np.ndarray
    place: np.ndarray


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> Anchors:
    """Anchors of all windows that lie within a document; memory is bounded by ``PIECE``."""
    n = len(data) - length + 1
    parts: list[tuple[np.ndarray, ...]] = []
    k = min(K, length)
    inside = np.zeros(max(n, 0) + 1, np.int32)
    has = ends - starts >= length
    np.add.at(inside, starts[has], 1)
    np.add.at(inside, ends[has] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    edge = np.zeros(max(n, 0), bool)
    edge[starts[has]] = True
    for at in range(0, n, PIECE):
        stop = min(at + PIECE, n)
        h = hashes(data[at : stop + length - 1], k)
        p = smallest_in_window(h, length - k + 1)
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | edge[at + 1 : stop] | ~inside[at : stop - 1]
        new &= inside[at:stop]
        first = np.flatnonzero(new)
        if not len(first):
            continue
        number = np.cumsum(new)[inside[at:stop]] - 1
        parts.append((first + at, np.bincount(number, minlength=len(first)), h[p[first]], p[first] + at))
    if not parts:
        none = np.empty(0, np.int64)
        return Anchors(none, none, np.empty(0, np.uint64), none)
    return Anchors(*(np.concatenate(x) for x in zip(*parts, strict=True)))


# --- enhanced suffix array -----------------------------------------------------------------


@dataclass
class Interval:
    """A node of the tree of common-prefix intervals over suffixes ``low`` to ``high``."""

    length: int
    low: int
    high: int
    least: int  # smallest id among its suffixes
    maximal: bool  # its suffixes are preceded by different bytes
    kids: list[Interval] = field(default_factory=list)


class SuffixArray:
    """Suffixes of several byte strings, each with the common prefix with the one before it."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        n = len(self.data)
        place = np.arange(n, dtype=np.int32)
        self.owner = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)
        self.offset = place - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
        self.left = np.repeat(sizes.astype(np.int32), sizes) - self.offset
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        word = np.zeros(n, np.uint64)
        for j in range(8):
            byte = np.where(self.left > j, padded[j : j + n], 0).astype(np.uint64)
            word = (word << np.uint64(8)) | byte
        order = np.lexsort((np.minimum(self.left, 8), word))
        a, b = word[order], np.minimum(self.left, 8)[order]
        ranks = [self._ranks(order, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))]
        k = 8
        while k < (sizes.max() if n else 0):
            r = ranks[-1]
            key = r.astype(np.int64) * (n + 1)
            key += np.where(self.left > k, r[np.minimum(place + k, n - 1)] + 1, 0)
            order = np.argsort(key, kind="stable")
            s = key[order]
            ranks.append(self._ranks(order, s[1:] != s[:-1]))
            k *= 2
        self.order = order.astype(np.int32)
        self.common = self._common(ranks)

    @staticmethod
    def _ranks(order: np.ndarray, differ: np.ndarray) -> np.ndarray:
        out = np.zeros(len(order), np.int32)
        if len(order):
            out[order[1:]] = np.cumsum(differ, dtype=np.int32)
        return out

    def _common(self, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each suffix with the one before it in the order; 0 for the first."""
        n = len(self.data)
        a, b = self.order[:-1], self.order[1:]
        most = np.minimum(self.left[a], self.left[b])
        done = np.zeros(len(a), np.int32)
        for level in range(len(ranks) - 1, -1, -1):
            r, k = ranks[level], 8 << level
            x, y = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            done += np.where((done + k <= most) & (r[x] == r[y]), np.int32(k), np.int32(0))
        for _ in range(8):
            x, y = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            done += (done < most) & (self.data[x] == self.data[y])
        return np.concatenate([np.zeros(1, np.int32), done]) if n else done

    def before(self) -> np.ndarray:
        """The byte before each suffix in the order; a different negative number at each start."""
        at = self.order
        return np.where(self.offset[at] > 0, self.data[np.maximum(at - 1, 0)].astype(np.int32), -1 - at)

    def trees(self, least_length: int, ids: np.ndarray) -> list[Interval]:
        """Roots of the interval trees of common prefixes of ``least_length`` or more.

        ``ids`` has the id of each string. Trees whose suffixes are all preceded by one byte
        are left out: the suffixes one byte earlier have the same tree, one byte longer.
        """
        n = len(self.order)
        near = self.common >= least_length
        heads = np.flatnonzero(~near)
        last = np.append(heads[1:], n) - 1
        heads, last = heads[last > heads], last[last > heads]
        if not len(heads):
            return []
        before = self.before()
        varies = np.zeros(n, np.int32)
        varies[1:] = np.cumsum(before[1:] != before[:-1], dtype=np.int32)
        del before
        owner_id = ids[self.owner[self.order]]
        out = []
        for low, high in zip(heads.tolist(), last.tolist(), strict=True):
            if varies[high] > varies[low]:
                out.append(self._scan(low, high, owner_id[low : high + 1].tolist(), varies))
        return out

    def _scan(self, low: int, high: int, ids: list[int], varies: np.ndarray) -> Interval:
        """One pass with a stack over suffixes ``low`` to ``high``."""
        common = self.common[low + 1 : high + 1].tolist() + [0]
        stack: list[Interval] = []
        for k, depth in enumerate(common):
            at = low + k
            # the interval this suffix opens, if the next one shares more than the stack's top
            done: Interval | None = None
            start, least = at, ids[k]
            while stack and stack[-1].length > depth:
                top = stack.pop()
                top.high = at
                top.least = min(top.least, least)
                if done is not None:
                    top.kids.append(done)
                top.maximal = bool(varies[at] > varies[top.low])
                done, start, least = top, top.low, top.least
            if not depth:
                return done
            if stack and stack[-1].length == depth:
                stack[-1].least = min(stack[-1].least, least)
                if done is not None:
                    stack[-1].kids.append(done)
            else:
                stack.append(Interval(depth, start, at, least, False, [done] if done is not None else []))
        raise AssertionError("the scan ends with depth 0")


def maximal_repeats(strings: list[bytes], least_length: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Every maximal repeat of the strings with all its occurrences (string, place)."""
    array = SuffixArray(strings)
    out, stack = [], array.trees(least_length, np.arange(len(strings)))
    while stack:
        node = stack.pop()
        stack += node.kids
        if node.maximal:
            at = array.order[node.low : node.high + 1]
            places = sorted(zip(array.owner[at].tolist(), array.offset[at].tolist(), strict=True))
            first = int(at[0])
            out.append((array.data[first : first + node.length].tobytes(), places))
    return sorted(out)


def earlier_matches(strings: list[bytes], ids: np.ndarray, least_length: int) -> list[tuple[int, int, int]]:
    """Parts (string, start, end) that also stand in a string of a smaller id.

    Every suffix is covered to the length of the deepest maximal interval around it that has a
    smaller id than its own string.
    """
    array = SuffixArray(strings)
    owner, offset = array.owner[array.order], array.offset[array.order]
    own = ids[owner]
    cover = np.zeros(len(owner), np.int64)
    stack = array.trees(least_length, ids)
    while stack:  # parents come before their kids, so deeper ones overwrite
        node = stack.pop()
        stack += node.kids
        if node.maximal:
            part = slice(node.low, node.high + 1)
            cover[part] = np.where(own[part] > node.least, node.length, cover[part])
    hit = np.flatnonzero(cover)
    return list(zip(owner[hit].tolist(), offset[hit].tolist(), (offset[hit] + cover[hit]).tolist(), strict=True))


# --- blocks and buckets --------------------------------------------------------------------


def _flat(docs: pd.DataFrame) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The block's texts in one string, in an order the rows alone determine; ids and ends."""
    docs = docs.sort_values(["id", "text"], kind="stable")
    raw = [t.encode() for t in docs["text"]]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
    return b"".join(raw), docs["id"].to_numpy(np.int64), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends


def _distinct(found: Anchors, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and whether more than one id has them."""
    order = np.lexsort((ids, found.key))
    key, owner = found.key[order], ids[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    last = np.append(heads[1:], len(key)) - 1
    return key[heads], owner[heads] != owner[last] if len(key) else np.empty(0, bool)


def repeated_pieces(
    frame: DataFrame, length: int, block_bytes: int, bucket_bytes: int, hot_blocks: int
) -> tuple[DataFrame, DataFrame]:
    """The documents by block, and the pieces of every block whose anchors other ids have too,
    packed for the buckets of their anchors.

    ``frame`` has ``doc_id`` and ``text`` without NULL texts.
    """
    if length < K:
        raise ValueError(f"repeats of under {K} bytes have no anchors")
    total = text_bytes(frame)
    n_blocks = parts_for(total, block_bytes)
    bits = max(4, (parts_for(total, bucket_bytes) - 1).bit_length())
    blocks = frame.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).alias("block"), "doc_id", id_or_last("doc_id").alias("id"), "text"
    )

    def anchors_of(group: pd.DataFrame):
        raw, ids, starts, ends = _flat(group)
        data = np.frombuffer(raw, np.uint8)
        found = anchors(data, starts, ends, length)
        doc = np.searchsorted(ends, found.first, "right")
        return raw, ids, starts, doc, found

    def ask(group: pd.DataFrame) -> pd.DataFrame:
        _, ids, _, doc, found = anchors_of(group)
        keys, several = _distinct(found, ids[doc])
        rows = [
            (group["block"].iloc[0], b, short_keys(keys[i:j], bits), np.packbits(several[i:j]).tobytes())
            for b, i, j in zip(*map(np.ndarray.tolist, bucket_cuts(keys, bits)), strict=True)
        ]
        return pd.DataFrame(rows, columns=["block", "bucket", "keys", "several"])

    asked = blocks.groupBy("block").applyInPandas(ask, "block bigint, bucket bigint, keys binary, several binary")

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [long_keys(k) for k in rows["keys"]]
        several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=len(k)) for s, k in zip(rows["several"], keys, strict=True)])
        _, place, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = (times[place] > 1) | (np.bincount(place, several) > 0)[place]
        hot = times[place] > hot_blocks
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        packed = [[np.packbits(x).tobytes() for x in np.split(y, cuts)] for y in (shared, hot)]
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "shared": packed[0], "hot": packed[1]})

    answers = asked.groupBy("bucket").applyInPandas(answer, "block bigint, bucket bigint, shared binary, hot binary")

    def cut(group: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        columns = ["block", "bucket", "bytes", "sizes", "anchors", "least", "piece", "ids", "docs", "starts"]
        if group.empty or replies.empty:
            return pd.DataFrame(columns=columns)
        raw, ids, starts, doc, found = anchors_of(group)
        keys, _ = _distinct(found, ids[doc])
        shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        said = replies.set_index("bucket")
        for b, i, j in zip(*map(np.ndarray.tolist, bucket_cuts(keys, bits)), strict=True):
            shared[i:j] = np.unpackbits(np.frombuffer(said["shared"][b], np.uint8), count=j - i)
            hot[i:j] = np.unpackbits(np.frombuffer(said["hot"][b], np.uint8), count=j - i)
        place = np.searchsorted(keys, found.key)
        some = np.flatnonzero(shared[place])
        pieces: dict[int, dict[tuple[bytes, int], list[tuple[int, int, int]]]] = {}
        top = 64 - bits
        taken = (found.first, found.count, found.key, found.place, doc, hot[place])
        for first, count, key, at, d, alone in zip(*(x[some].tolist() for x in taken), strict=True):
            spans = [(w, w + length) for w in range(first, first + count)] if alone else [(first, first + count + length - 1)]
            for a, b in spans:
                piece = raw[a:b]
                bucket = (xxhash.xxh3_64_intdigest(piece) if alone else key) >> top
                mark = (piece, ALONE if alone else at - a)
                pieces.setdefault(bucket, {}).setdefault(mark, []).append((int(ids[d]), d, a - int(starts[d])))
        block = group["block"].iloc[0]
        rows = []
        for bucket, held in pieces.items():
            places = [p for ps in held.values() for p in ps]
            rows.append(
                (
                    block,
                    bucket,
                    b"".join([p for p, _ in held]),
                    np.array([len(p) for p, _ in held], np.uint16).tobytes(),
                    np.array([a for _, a in held], np.uint16).tobytes(),
                    np.array([min(ps)[0] for ps in held.values()], np.int64).tobytes(),
                    np.repeat(np.arange(len(held), dtype=np.uint32), [len(ps) for ps in held.values()]).tobytes(),
                    np.array([i for i, _, _ in places], np.int64).tobytes(),
                    np.array([d for _, d, _ in places], np.int32).tobytes(),
                    np.array([s for _, _, s in places], np.int64).tobytes(),
                )
            )
        return pd.DataFrame(rows, columns=columns)

    cut_schema = "block bigint, bucket bigint, bytes binary, sizes binary, anchors binary, least binary, piece binary, ids binary, docs binary, starts binary"
    pieces = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(cut, cut_schema)
    return blocks, pieces


class Bucket:
    """The distinct pieces of a bucket: ``strings``, the smallest id of each (``smallest``), those
    of each anchor (``of_anchor``, without single windows of hot anchors), and ``of_row``, the
    numbers of each row's pieces."""

    def __init__(self, rows: pd.DataFrame):
        number: dict[bytes, int] = {}
        least: list[int] = []
        self.of_anchor: dict[bytes, list[int]] = {}
        self.of_row: list[np.ndarray] = []
        packed = ((rows["sizes"], np.uint16), (rows["anchors"], np.uint16), (rows["least"], np.int64))
        for raw, *packs in zip(rows["bytes"], *(c for c, _ in packed), strict=True):
            at, mine = 0, []
            for size, anchor, i in zip(*(np.frombuffer(p, k).tolist() for p, (_, k) in zip(packs, packed, strict=True)), strict=True):
                piece = raw[at : at + size]
                at += size
                k = number.setdefault(piece, len(number))
                if k == len(least) and anchor != ALONE:
                    self.of_anchor.setdefault(piece[anchor : anchor + K], []).append(k)
                if k == len(least):
                    least.append(i)
                elif i < least[k]:
                    least[k] = i
                mine.append(k)
            self.of_row.append(np.array(mine, np.int64))
        self.strings, self.smallest = list(number), np.array(least, np.int64)

    def runs(self) -> Iterator[list[int]]:
        """Pieces of anchors with several forms, some anchors at a time: only pieces of one
        anchor can share a window."""
        some: list[int] = []
        held, last = 0, len(self.of_anchor) - 1
        for n, ks in enumerate(self.of_anchor.values()):
            if len(ks) > 1:
                some += ks
                held += sum(len(self.strings[k]) for k in ks)
            if some and (held >= SORT_BYTES or n == last):
                yield some
                some, held = [], 0


def remove_repeats(
    docs: DataFrame,
    *,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_blocks: int = HOT_BLOCKS,
) -> DataFrame:
    """Finds every byte covered by a ``length``-byte string that a smaller id's text holds too.

    Texts are UTF-8 bytes; strings are judged on the input and do not cross documents. Returns
    one row per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans`` (removed runs, maximal, in
    order, ends exclusive) and ``kept`` (the other bytes, joined). NULL and empty texts have
    no bytes; a NULL id is larger than all others, and equal ids are not smaller than each
    other, so rows of one id never remove from each other; an empty table gives no row.
    """
    blocks, pieces = repeated_pieces(texts(docs, id_col, text_col), length, block_bytes, bucket_bytes, hot_blocks)

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        held = Bucket(rows)
        strings, smallest = held.strings, held.smallest
        parts: dict[int, list[tuple[int, int]]] = {}
        for some in held.runs():
            for n, a, b in earlier_matches([strings[k] for k in some], smallest[some], length):
                parts.setdefault(some[n], []).append((a, b))
        sizes = np.array([len(s) for s in strings], np.int64)
        out = []
        columns = ("block", "piece", "ids", "docs", "starts")
        for block, piece, ids, docs, starts, mine in zip(*(rows[c] for c in columns), held.of_row, strict=True):
            k = mine[np.frombuffer(piece, np.uint32)]
            ids, docs, starts = np.frombuffer(ids, np.int64), np.frombuffer(docs, np.int32), np.frombuffer(starts, np.int64)
            later = ids > smallest[k]  # a smaller id has the piece whole
            begin, end, owner = [starts[later]], [(starts + sizes[k])[later]], [docs[later]]
            for n in np.flatnonzero(~later).tolist():
                for a, b in parts.get(int(k[n]), ()):
                    begin.append(starts[n : n + 1] + a)
                    end.append(starts[n : n + 1] + b)
                    owner.append(docs[n : n + 1])
            begin, end, owner = map(np.concatenate, (begin, end, owner))
            if len(begin):
                out.append((block, owner.tobytes(), begin.tobytes(), end.tobytes()))
        return pd.DataFrame(out, columns=["block", "docs", "begin", "end"])

    spans = pieces.groupBy("bucket").applyInPandas(match, "block bigint, docs binary, begin binary, end binary")

    def apply(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "text"], kind="stable")
        docs = np.frombuffer(b"".join(found["docs"]), np.int32)
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        begin, end = (np.frombuffer(b"".join(found[c]), np.int64)[order] for c in ("begin", "end"))
        rows = []
        for n, (doc_id, text) in enumerate(zip(group["doc_id"], group["text"], strict=True)):
            raw = text.encode()
            a, b = np.searchsorted(docs, n, "left"), np.searchsorted(docs, n, "right")
            depth = np.zeros(len(raw) + 1, np.int32)
            np.add.at(depth, begin[a:b], 1)
            np.add.at(depth, end[a:b], -1)
            gone = np.cumsum(depth)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append((doc_id, len(raw), [{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()], kept))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "spans", "kept"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    schema = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(apply, schema)


def repeat_groups(
    docs: DataFrame,
    *,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_blocks: int = HOT_BLOCKS,
) -> DataFrame:
    """Repeats of ``length`` bytes or more that texts of several ids hold, with all occurrences.

    One row per occurrence: ``repeat`` (its bytes), ``doc_id`` and ``place`` (in bytes). Every
    string of ``length`` bytes that several ids hold lies in one repeat at least whose
    occurrences are all of that string's. A repeat is a maximal one of the pieces around one
    anchor: its occurrences there are preceded by different bytes, or begin a piece; a longer
    common passage is a chain of repeats that overlap. Rows of one id count as one text with
    several occurrences. NULL texts hold nothing; a NULL id is an id; no row gives no row.
    """
    _, pieces = repeated_pieces(texts(docs, id_col, text_col), length, block_bytes, bucket_bytes, hot_blocks)

    def groups(rows: pd.DataFrame) -> pd.DataFrame:
        held = Bucket(rows)
        places: list[list[tuple[int, int]]] = [[] for _ in held.strings]
        columns = ("piece", "ids", "starts")
        for piece, ids, starts, mine in zip(*(rows[c] for c in columns), held.of_row, strict=True):
            k = mine[np.frombuffer(piece, np.uint32)].tolist()
            for n, i, at in zip(k, np.frombuffer(ids, np.int64).tolist(), np.frombuffer(starts, np.int64).tolist(), strict=True):
                places[n].append((i, at))
        # A piece that several places have whole, and the maximal intervals of each anchor's tree.
        found: dict[bytes, set[tuple[int, int]]] = {s: {(k, 0)} for k, s in enumerate(held.strings)}
        for some in held.runs():
            for repeat, where in maximal_repeats([held.strings[k] for k in some], length):
                found.setdefault(repeat, set()).update((some[n], at) for n, at in where)
        out = []
        for repeat, where in found.items():
            spots = [(i, start + at) for k, at in where for i, start in places[k]]
            if len({i for i, _ in spots}) > 1:
                out += [(repeat, None if i == MAX_ID else i, at) for i, at in spots]
        frame = pd.DataFrame(out, columns=["repeat", "doc_id", "place"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    return pieces.groupBy("bucket").applyInPandas(groups, "repeat binary, doc_id bigint, place bigint")


def op3_repeats(docs: DataFrame) -> DataFrame:
    """The digest of the contract from the operator's spans and kept bytes."""
    out = remove_repeats(docs)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

"""Texts cut into pieces that encode alone, and a bounded table of pieces already encoded.

Under the split pattern of byte-level vocabularies no token spans the place before a space
that a non-space follows. So the ids of a text are those of its pieces, one after another,
and a piece seen before need not be encoded again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: The letter that stands for a space in byte-level vocabularies, and settings of
#: a tokenizer file under which texts are split as here and words merged by rank alone.
SPACE = "Ġ"
SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
MERGING = {
    "type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
    "byte_fallback": False, "ignore_merges": False,
}

#: UTF-8 of white space, and of what Python takes for it; cuts need another byte.
_NO_CUT = re.compile(
    rb" (?=[\x09-\x0d\x1c-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\Z)"
)
_FIRST = b"\xff"  # marks a piece that has no space before it; no UTF-8 text has this byte
GENERATION = 300_000
STOPS = b",."


def check_settings(path: str) -> dict:
    """The contents of a tokenizer file, refused if it would split or merge in another way."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    wrong = [] if spec.get("normalizer") is None else ["normalizer"]
    for part, wanted in (("pre_tokenizer", SPLITTER), ("model", MERGING)):
        have = spec.get(part) or {}
        # Files leave out settings that are off.
        wrong += [f"{part}.{k}" for k, v in wanted.items() if (have.get(k, v) if k != "type" else have.get(k)) != v]
    wrong += ["added_tokens"] * any(t.get(k) for t in spec.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip"))
    if wrong:
        raise ValueError(f"{path}: no plain byte-level BPE, see {', '.join(wrong)}")
    return spec


def keys_of(raw: bytes) -> list[bytes]:
    """The pieces of a text: each but the first stands for a space and what follows it."""
    parts = raw.split(b" ")
    if _NO_CUT.search(raw):
        out = parts[:1]
        # a space that white space or the end follows stays inside its piece
        at = len(parts[0])
        for p in parts[1:]:
            if _NO_CUT.match(raw, at):
                out[-1] += b" " + p
            else:
                out.append(p)
            at += 1 + len(p)
        parts = out
    if parts[0]:
        parts[0] = _FIRST + parts[0]
        return parts
    return parts[1:]


def piece_of(key: bytes) -> str:
    return (key[1:] if key[:1] == _FIRST else b" " + key).decode()


class PieceTable:
    """Packed ids of pieces in two generations; a piece that is used moves to the younger one.

    ``learn`` gives the packed ids of new pieces. Texts with one of the ``special`` strings go
    to ``learn`` whole.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes]], special: list[str], generation: int = GENERATION):
        self.learn, self.special, self.generation = learn, [s.encode() for s in special], generation
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def known(self, key: bytes) -> bytes | None:
        found = self.young.get(key)
        return self.old.get(key) if found is None else found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        raws = [t.encode() for t in texts]
        whole = [any(s in r for s in self.special) for r in raws]
        keys = [[] if w else keys_of(r) for r, w in zip(raws, whole, strict=True)]
        needed: set[bytes] = set()
        for k in keys:
            needed.update(k)
        found = list(needed)
        get = dict(zip(found, self.packed(found), strict=True)).__getitem__
        out = [b"".join(map(get, k)) for k in keys]
        for n in [n for n, w in enumerate(whole) if w]:
            out[n] = self.learn([texts[n]])[0]
        return out

    def packed(self, keys: list[bytes]) -> list[bytes]:
        """Packed ids of distinct pieces."""
        if len(self.young) > self.generation:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        out = list(map(young.get, keys))
        stems, wanted = [], {}
        for n in [n for n, ids in enumerate(out) if ids is None]:
            k = keys[n]
            ids = old.get(k)
            if ids is not None:
                out[n] = young[k] = ids
            elif k[-1] in STOPS and k[-2:-1].isalpha():
                stems.append(n)  # a stop behind an ASCII letter is a token of its own
            else:
                wanted[k] = n
        ends = {k: _FIRST + bytes([k]) for k in STOPS} if stems else {}
        for e in ends.values():
            if self.known(e) is None:
                wanted.setdefault(e, -1)
        for n in stems:
            stem = keys[n][:-1]
            if stem not in young and stem not in old:
                wanted.setdefault(stem, -1)
        if wanted:
            for (k, n), ids in zip(wanted.items(), self.learn(list(map(piece_of, wanted))), strict=True):
                young[k] = ids
                if n >= 0:
                    out[n] = ids
        # Pieces made from stems are made anew where they are needed, and take no lasting room.
        stop = {k: self.known(e) for k, e in ends.items()}
        for n in stems:
            ids = young.get(keys[n][:-1])
            out[n] = (old[keys[n][:-1]] if ids is None else ids) + stop[keys[n][-1]]
        return out

    def encode_column(self, texts: pa.Array, kind: str, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, each followed by ``end``, and how many each
        has with it. NULL texts are empty."""
        texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
        raws = texts.cast(pa.large_binary())
        odd = [n for n, r in enumerate(raws.to_pylist()) if _NO_CUT.search(r) or any(s in r for s in self.special)]
        plain = np.ones(len(texts), bool)
        plain[odd] = False
        ids, counts = self._plain(raws.filter(pa.array(plain)) if odd else raws, kind, end)
        if not odd:
            return ids, counts
        own = [np.frombuffer(x + end, kind) for x in self.encode(texts.take(pa.array(odd)).to_pylist())]
        parts, n_ids, at = [], np.empty(len(texts), np.int64), 0
        n_ids[plain], n_ids[odd] = counts, [len(x) for x in own]
        cuts = np.cumsum(counts)
        before = 0
        for x, n in zip(own, odd, strict=True):  # runs of plain texts between the odd ones
            upto = int(cuts[n - before - 1]) if n > before else 0
            parts += [ids[at:upto], x]
            at, before = max(at, upto), before + 1
        return np.concatenate([*parts, ids[at:]]), n_ids

    def _plain(self, raws: pa.Array, kind: str, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_column``, of texts where every space begins a piece."""
        if not len(raws):
            return np.empty(0, kind), np.empty(0, np.int64)
        split = pa.compute.split_pattern(raws, b" ")
        starts = split.offsets.to_numpy()
        words = split.values
        first = np.zeros(len(words), bool)
        first[starts[:-1]] = True
        heads = words.filter(pa.array(first)).to_pylist()
        rest = words.filter(pa.array(~first)).dictionary_encode()
        known = {w: n for n, w in enumerate(dict.fromkeys(heads))}
        keys = [_FIRST + w for w in known if w]
        spaced = rest.dictionary.to_pylist()
        packed = self.packed([*keys, *spaced])
        own = dict(zip(keys, packed))
        pool = [own.get(_FIRST + w, b"") for w in known] + packed[len(keys) :] + [end]
        # Each text as numbers of pieces in the pool, the end behind the last.
        codes = np.empty(len(words) + len(raws), np.int64)
        last = starts[1:] + np.arange(len(raws))
        inner = np.ones(len(codes), bool)
        inner[last] = False
        codes[last] = len(pool) - 1
        flat = np.empty(len(words), np.int64)
        flat[first] = [known[w] for w in heads]
        flat[~first] = rest.indices.to_numpy() + len(known)
        codes[inner] = flat
        size = np.dtype(kind).itemsize
        sizes = np.fromiter(map(len, pool), np.int64, len(pool)) // size
        begins = np.cumsum(sizes) - sizes
        of_word = sizes[codes]
        upto = np.cumsum(of_word)
        places = np.repeat(begins[codes] - (upto - of_word), of_word) + np.arange(int(upto[-1]))
        ids = np.frombuffer(b"".join(pool), kind)[places]
        return ids, np.diff(upto[last], prepend=0)

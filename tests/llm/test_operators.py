"""Each operator against brute force over the whole given table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from checks.compare import difference, duck
from tokenizers import Tokenizer

from vitalmart.llm import bpe, decontaminate, fingerprint, lines, ngram_join, quality, queries, repeats, secrets, token_files, urls
from vitalmart.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.TOKENIZER)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("name", queries.ORACLE)
def test_twins(spark, sf_dir, name):
    assert difference(spark, duck(sf_dir), queries.QUERIES[name], queries.ORACLE[name], sf_dir) is None


def test_token_files(spark, sf_dir, texts_of, library):
    rows = sorted(tuple(r) for r in queries.op1_token_files(spark, sf_dir).collect())
    at, want = 0, []
    for doc_id in sorted(texts_of):
        ids = np.array([*library.encode(texts_of[doc_id], add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert rows == want


def test_token_files_over_many_files_are_views(documents, texts_of, library):
    manifest = token_files.write_tokens(documents, queries.TOKENIZER, length=64, rows=4, file_text_bytes=100_000)
    found = sorted((r["start"], bytes(r["ids"])) for r in token_files.read_tokens(manifest).collect())
    stream = np.frombuffer(b"".join(ids for _, ids in found), "<u4")
    assert [s for s, _ in found] == list(np.cumsum([0] + [len(i) // 4 for _, i in found[:-1]]))
    files = [r["file"] for r in manifest.groupBy("file", "part").count().orderBy("part").collect()]
    assert len(files) > 1
    joined = []
    for name in files:
        file = token_files.SequenceFile(name)
        real = sum(int(np.sum(m.flatten().to_numpy(zero_copy_only=False))) for m in file.masks)
        joined.append(file.tokens(0, real))
        ids, mask = file.sequence(1)
        assert len(ids) == len(mask) == 64 and not ids.flags.owndata
        start, size = file.source.address if hasattr(file.source, "address") else None, file.source.size()
        assert start is None or start <= ids.ctypes.data < start + size
    assert np.array_equal(np.concatenate(joined), stream)


def test_bpe_round_trip(spark, sf_dir, texts_of, library):
    for r in queries.op2_bpe(spark, sf_dir).collect():
        ids = np.array(library.encode(texts_of[r["doc_id"]], add_special_tokens=False).ids, "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(ids.tobytes()))
        assert r["decoded_sha256"] == sha(texts_of[r["doc_id"]].encode())


# Pieces that sit at the borders of the split pattern.
PIECES = [" ", "  ", "\n", "\t", " \n", "\u00a0", "\u3000", "\x1c", "\x85", "a", "the", "'s", "'ll", "don't", "1", "23", "é", "ß", "日本", "😀", "!", "..."]
PIECES += ["<|endoftext|>", "<|endof", " <|endoftext|>", "\r\n", "Aaa", "aaaa", "_", "==", "\u200b", "İ", "\x00"]


def test_encoders_on_odd_texts(library):
    rng = random.Random(3)
    trie, cached = bpe.Codec(queries.TOKENIZER), token_files.LibraryEncoder(queries.TOKENIZER)
    for _ in range(4000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9)))
        want = library.encode(text, add_special_tokens=False).ids
        packed = trie.encode([text])[0]
        assert np.frombuffer(packed, "<u4").tolist() == want
        assert np.frombuffer(cached.encode([text])[0], cached.kind).tolist() == want
        assert trie.decode(packed) == library.decode(want, skip_special_tokens=False)


def test_piece_table_generations(library):
    codec = bpe.Codec(queries.TOKENIZER)
    codec.table.generation = 5
    for n in range(30):
        text = f"some words {n} and {n * 7} more words {n % 3}"
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(codec.table.young) + len(codec.table.old) < 60


def repeated_bytes(docs: dict[int, bytes], n: int) -> dict[int, bytearray]:
    first: dict[bytes, int] = {}
    for i in sorted(docs):
        for a in range(len(docs[i]) - n + 1):
            first.setdefault(docs[i][a : a + n], i)
    out = {}
    for i, s in docs.items():
        gone = bytearray(len(s))
        for a in range(len(s) - n + 1):
            if first[s[a : a + n]] < i:
                gone[a : a + n] = b"\1" * n
        out[i] = gone
    return out


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 40_000}, {"block_bytes": 40_000, "bucket_bytes": 40_000, "hot_blocks": 2}])
def test_repeats(documents, texts_of, limits):
    docs = {i: t.encode() for i, t in texts_of.items()}
    want = repeated_bytes(docs, 50)
    assert any(map(any, want.values()))
    for r in repeats.remove_repeats(documents, **limits).collect():
        gone = bytearray(r["n_bytes"])
        for s in r["spans"]:
            assert s["end"] > s["start"]
            gone[s["start"] : s["end"]] = b"\1" * (s["end"] - s["start"])
        assert gone == want[r["doc_id"]]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
        assert bytes(r["kept"]) == bytes(c for c, g in zip(docs[r["doc_id"]], gone) if not g)


def test_maximal_repeats():
    rng = random.Random(1)
    for _ in range(40):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(3, 40))) for _ in range(4)]
        strings = [rng.choice(base) + rng.choice(base) + bytes([65 + i]) + rng.choice(base) for i in range(5)]
        least = rng.choice([3, 5, 9])
        places = defaultdict(list)
        for i, s in enumerate(strings):
            for a in range(len(s)):
                for b in range(a + least, len(s) + 1):
                    places[s[a:b]].append((i, a))
        want = []
        for w, at in places.items():
            left = {strings[i][a - 1] if a else (i, a) for i, a in at}
            right = {strings[i][a + len(w)] if a + len(w) < len(strings[i]) else (i, a) for i, a in at}
            if len(at) > 1 and len(left) > 1 and len(right) > 1:
                want.append((w, sorted(at)))
        assert repeats.maximal_repeats(strings, least) == sorted(want)


SECRETS = [
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
]


def base_spans(text: str) -> str:
    found = []
    for rank, (kind, pattern, group, least) in enumerate(SECRETS):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text) if len(m[group]) >= least]
    return ",".join(x[2] for x in sorted(found))


def test_secrets(spark):
    rng = random.Random(2)
    parts = ["password", "PassWd", "token", "api_key", "apikey=", "secret", ":", "=", " ", '"', "'", "abcdefghijklmnop", "AKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "é", "😀", "\n", "x"]
    parts += ["ghp_" + "a1B2" * 10, "-----BEGIN RSA PRIVATE KEY-----"]
    docs = {n: "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for n in range(600)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    some = Counter()
    for r in secrets.op5_secrets(frame).collect():
        want = base_spans(docs[r["doc_id"]])
        assert r["base_sha256"] == sha(want.encode()), docs[r["doc_id"]]
        kinds = Counter(x.split(":")[0] for x in want.split(",") if x)
        assert (kinds["assign"], kinds["access"], kinds["hex"]) == (r["n_assign"], r["n_access"], r["n_hex"])
        assert {x for x in want.split(",") if x} <= set(r["spans"].split(","))
        some += Counter(x.split(":")[0] for x in r["spans"].split(",") if x)
    assert all(some[k] for k in ("assign", "access", "hex", "github", "pem"))


def test_trigram_queries():
    ask = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert ask["hex"] is None
    assert ask["access"] == frozenset({frozenset({"aki", "kia"})})
    assert frozenset({"tok", "oke", "ken"}) in ask["assign"] and len(ask["assign"]) == 6


def test_urls(spark, sf_dir):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op6_url_filter(spark, sf_dir).collect():
        url, host, path = pages[r["page_id"]] or "", "", ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host, best = host.translate(LOW), None
        for rule in urls.RULES:
            name, _, start = rule.partition("/")
            fits = (host == name or host.endswith("." + name)) and path.startswith("/" + start)
            best = rule if fits and (best is None or len(rule) > len(best)) else best
        assert (r["host"], r["path"], r["rule"]) == (host, path, best)
        assert r["verdict"] in ("allow", "block") and (best is None or r["verdict"] == urls.RULES[best])


def test_segments_are_the_likeliest():
    counts, total = {"cheap": 9, "pills": 7, "pill": 3, "s": 2, "che": 4, "ap": 1}, 100
    assert urls.segment("cheappills", counts, total) == ["cheap", "pills"]
    rng = random.Random(4)

    def chance(words):
        return sum(np.log(counts[w] / total) if w in counts else np.log(10 / total) - len(w) * np.log(10) for w in words)

    for _ in range(50):
        label = "".join(rng.choice(["che", "ap", "pill", "s", "q"]) for _ in range(4))[:9]
        splits = []
        for cut in range(1 << (len(label) - 1)):
            words, last = [], 0
            for k in range(1, len(label)):
                if cut >> (k - 1) & 1:
                    words.append(label[last:k])
                    last = k
            splits.append([*words, label[last:]])
        assert chance(urls.segment(label, counts, total)) == pytest.approx(max(map(chance, splits)))


def test_url_verdicts_without_a_rule(spark):
    html = "cheap pills good news " * 5
    rows = [(n, f"http://cheappills{n % 3}.example.com/de/{n}", html) for n in range(9)]
    rows += [(100 + n, f"http://goodnews{n % 3}.example.org/fr/{n}", html) for n in range(9)]
    rows += [(200, "http://cheappills.example.net/x", html), (201, "http://goodnews.example.net/x", html)]
    found = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert (found[200]["verdict"], found[201]["verdict"]) == ("block", "allow")


@pytest.mark.parametrize("block_bytes", [16 << 20, 700])
def test_decontaminate(spark, sf_dir, documents, texts_of, block_bytes):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = spark.createDataFrame([(900, "the"), (901, "and the"), (902, "!!"), (None, None)], "item_id bigint, text string")
    items = items.unionByName(spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    windows = defaultdict(set)
    for r in items.collect():
        w = words.findall((r["text"] or "").translate(LOW))
        size = min(13, len(w))
        for k in range(len(w) - size + 1) if size else ():
            windows[tuple(w[k : k + size])].add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    for r in decontaminate.find_items(documents, items, block_bytes=block_bytes).collect():
        w = words.findall(texts_of[r["doc_id"]].translate(LOW))
        hit, names = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    names |= windows[tuple(w[k : k + size])]
        assert r["n_words"] == len(w) and r["items"] == sorted(names)
        assert {k for s in r["spans"] for k in range(s["start"], s["end"])} == hit


def test_benchmark_items_do_not_pass_through_the_driver(spark, monkeypatch):
    def refuse(*args, **kwargs):
        raise AssertionError("items on the driver")

    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", refuse)
    monkeypatch.setattr(decontaminate, "windows_of", refuse)  # pickled by name: only the driver's is replaced
    items = spark.range(200).selectExpr("id as item_id", "concat_ws(' ', transform(sequence(1, 40), k -> concat('w', id, 'x', k))) as text")
    found = decontaminate.find_items(items.selectExpr("item_id as doc_id", "text"), items, block_bytes=3000)
    assert found.count() == 200 and all(r["items"] == [str(r["doc_id"])] for r in found.collect())


def test_quality_on_held_out_labels(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op8_quality(spark, sf_dir).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) >= 0.85 * len(held)


def test_network_learns_and_reads_whole_texts():
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(20, 300)))
    bad = lambda: " ".join(rng.choice(["ALPHA!!", "BETA!!", "GAMMA!!"]) for _ in range(rng.randint(20, 300)))
    docs = [(f().encode(), y) for _ in range(150) for f, y in ((good, 1), (bad, 0))]
    net = quality.fit([d for d, _ in docs], [y for _, y in docs], epochs=6)
    fresh = [good().encode() for _ in range(40)] + [bad().encode() for _ in range(40)]
    said = quality.probabilities(net, fresh) > 0.5
    assert said[:40].mean() > 0.95 and said[40:].mean() < 0.05
    alone = [float(quality.probabilities(net, [d])[0]) for d in fresh]
    assert np.allclose(alone, quality.probabilities(net, fresh), atol=1e-5)
    # bytes far behind the start change the score
    long = good().encode() * 50
    assert quality.probabilities(net, [long + b" ALPHA!! BETA!!" * 400])[0] < quality.probabilities(net, [long])[0]
    assert quality.fit([], []).base == 0 and 0 <= quality.probabilities(net, [b""])[0] <= 1


@pytest.mark.parametrize(("words", "similarity", "block"), [(3, (90, 100), 1000), (5, (80, 100), 2), (1, (50, 100), 3)])
def test_ngram_join(documents, texts_of, words, similarity, block):
    cut = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for i, t in texts_of.items():
        w = cut.findall(t.translate(LOW))
        k = min(words, len(w))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if k else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and both * sum(similarity) >= similarity[0] * (len(sets[a]) + len(sets[b])):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert any(find(i) != i for i in ids)
    for r in ngram_join.join(documents, words=words, similarity=similarity, block=block).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]))


def test_trie_links_span_all_links():
    rng = random.Random(8)
    for _ in range(60):
        base = [rng.sample(range(60), rng.randint(3, 25)) for _ in range(3)]
        sets = [np.unique(np.array([t if rng.random() > 0.06 else rng.randint(0, 90) for t in rng.choice(base)], np.uint64)) for _ in range(30)]
        similarity = rng.choice([(9, 10), (8, 10), (1, 2)])
        links = ngram_join.spanning_links(list(range(30)), sets, similarity)
        pairs = [(a, b) for a in range(30) for b in range(a) if ngram_join.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), similarity)]
        assert {tuple(sorted(x, reverse=True)) for x in links} <= set(pairs)
        groups = []
        for edges in (links, pairs):
            root = list(range(30))
            for _ in range(30):
                for a, b in edges:
                    root[a] = root[b] = min(root[a], root[b])
            groups.append(root)
        assert groups[0] == groups[1]


def test_components(spark):
    rng = random.Random(9)
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(500, 500), (None, 3)]
    root = {n: n for e in edges if None not in e for n in e}
    for _ in range(200):
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {n: c for n, c in root.items() if n != 500}


def test_fingerprints(spark, sf_dir, texts_of):
    ids = sorted(texts_of, reverse=True)
    rows = {r["doc_id"]: r for r in queries.op10_fingerprint(spark, sf_dir).collect()}
    prints = {}
    for n, i in enumerate(ids):
        text, other, r = texts_of[i], texts_of[ids[(n + 1) % len(ids)]], rows[i]
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(changed.encode()))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert [r["edited_fingerprint"]] == fingerprint.fingerprints([changed])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    near = [(r["near_edited"], r["near_next"]) for r in rows.values() if r["n_chars"] >= 100]
    assert sum(a > b for a, b in near) >= 0.99 * len(near)


def test_phrase_sets_show_a_short_passage_of_long_texts(spark):
    rng = random.Random(4)
    passage, a, b = ("".join(rng.choices("abcdefghij klmnopqrst", k=k)) for k in (600, 30_000, 30_000))
    rows = [(1, a[:9000] + passage + a[9000:]), (2, b[:20_000] + passage + b[20_000:]), (3, None)]
    sets = {r["doc_id"]: r["phrases"] for r in fingerprint.phrase_sets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    inside = fingerprint.phrases([passage.encode()])[0]
    for level, mine in enumerate(inside):
        common = set(sets[1][level]) & set(sets[2][level]) & set(mine.tolist())
        assert len(common) >= len(mine) // 2 > 0
        assert [f"{n:08x}" for n in sets[1][level][:32]] == re.findall("." * 8, fingerprint.fingerprints([rows[0][1]])[0].split("-")[level])
    assert sets[3] == [[], []]


def test_phrases_do_not_depend_on_the_offset():
    rng = random.Random(10)
    word = lambda n: bytes(rng.choice(b"abcdefghij klmnop") for _ in range(n))
    shared = word(4000)
    a, b, c = fingerprint.phrases([shared, word(777) + shared, word(4000)])
    for level in range(2):
        assert len(np.intersect1d(a[level], b[level])) >= 0.95 * len(a[level])
        assert len(np.intersect1d(a[level], c[level])) <= 0.3 * len(a[level])


def test_buckets_in_order(documents, texts_of):
    frame = fingerprint.in_order(documents.select("doc_id", "text"), bucket_text_bytes=20_000)
    rows = frame.select("bucket", "copy", "doc_id").collect()
    ids = sorted((r["doc_id"] for r in rows if not r["copy"]), reverse=True)
    assert ids == sorted(texts_of, reverse=True)
    by = defaultdict(list)
    for r in rows:
        by[r["bucket"]].append((r["copy"], r["doc_id"]))
    assert len(by) > 5
    follow = {}
    for members in by.values():
        assert [m for m in members if m[0]] == members[-1:]
        follow |= {a[1]: b[1] for a, b in zip(members, members[1:])}
    assert follow == {a: b for a, b in zip(ids, ids[1:] + ids[:1])}


def test_lines_near_the_threshold_are_exact(spark):
    rows = [(100 * n + s, f"A line that stands on {n:03d} sites.\nOwn line of {n} and {s}, long enough.", f"s{s}") for n in range(1, 12) for s in range(n)]
    out = lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), min_sites=6)
    for r in out.collect():
        n, s = divmod(r["doc_id"], 100)
        gone = n >= 6 and s > 0
        assert r["n_removed"] == gone and r["n_lines"] == 2
        assert r["text"] == ("" if gone else f"A line that stands on {n:03d} sites.\n") + f"Own line of {n} and {s}, long enough."


def test_pieces_in_a_row_have_the_ids_they_have_alone(library):
    rng = random.Random(12)
    letters = ["a", "B", "é", "日", "😀", ".", ",", "\n", "\t", " ", "1", "23", "'s", "'", "_", "#", "\r\n", "zz", "\x1c"]
    encoder = token_files.LibraryEncoder(queries.TOKENIZER)
    pieces = [" " + "x"[: rng.randint(0, 1)] + "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(9000)]
    pieces += ["start", " end ", " a  b", ".", " ", "", " 's"]
    got = encoder._library(pieces)
    for p, ids in zip(pieces, got, strict=True):
        if p[:1] == " " and p[1:2].isspace():
            continue  # no piece: white space behind the space
        assert np.frombuffer(ids, encoder.kind).tolist() == library.encode(p, add_special_tokens=False).ids, repr(p)


@pytest.mark.parametrize(
    ("part", "key", "value"),
    [("normalizer", None, {"type": "NFC"}), ("pre_tokenizer", "add_prefix_space", True), ("pre_tokenizer", "type", "Whitespace"), ("model", "ignore_merges", True)],
)
def test_other_tokenizer_settings_are_refused(tmp_path, part, key, value):
    import json

    with open(queries.TOKENIZER, encoding="utf-8") as f:
        spec = json.load(f)
    if key is None:
        spec[part] = value
    else:
        spec[part][key] = value
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    for reader in (bpe.Merges, token_files.LibraryEncoder):
        with pytest.raises(ValueError, match=part):
            reader(path)


def test_columns_of_texts_have_the_ids_of_each(library):
    import pyarrow as pa

    rng = random.Random(5)
    words = ["plain", "Words", "stop.", "comma,", "日本", "é\nA", "x's", "", "<|endoftext|>", "a\tb", "12", "ends "]
    for odd in (False, True):
        texts = [" ".join(rng.choice(words[: None if odd else 7]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
        texts += ["", " ", "one", " lead", "x " * 5] if odd else ["", "one", " lead"]
        encoder = token_files.LibraryEncoder(queries.TOKENIZER)
        for slice_ in (pa.array(texts), pa.array([*texts, None]).slice(3), pa.array([], pa.string())):
            ids, counts = encoder.table.encode_column(slice_, encoder.kind, np.array([2], encoder.kind).tobytes())
            want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in slice_.to_pylist()]
            assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]

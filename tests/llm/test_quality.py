"""A score depends on the text alone: not on its batch, its partition or its neighbours."""

from math import exp, tanh

import numpy as np
from pyspark.sql import functions as F

from vitalmart.llm import quality


def one_score(net, data: bytes) -> float:
    """The network written out for one document, window by window."""
    blocks = -(-(len(data) + quality.WIDTH - 1) // quality.BLOCK)
    flat = data + bytes(quality.BLOCK + quality.WIDTH)
    starts = range(max(1, len(data)))
    step, size = quality.STEP_BLOCKS * quality.BLOCK, quality.CHUNK_BLOCKS * quality.BLOCK
    n_chunks = 1 + max(0, -(-(blocks - quality.CHUNK_BLOCKS) // quality.STEP_BLOCKS))
    hidden = []
    for k in range(n_chunks):
        inside = [p for p in starts if k * step <= p < k * step + size]
        values = [sum(net.table[j][flat[p + j]].astype(float) for j in range(quality.WIDTH)) for p in inside]
        hidden.append([tanh(x) for x in np.max(values, axis=0) + net.bias])
    z = np.concatenate([np.mean(hidden, axis=0), np.max(hidden, axis=0)]) @ net.out + net.base
    return 1 / (1 + exp(-z))


def network(seed=3):
    docs = [f"plain words number {n} and more of them".encode() for n in range(40)]
    bad = [f"WORDS!! {n} $$$ !!".encode() for n in range(40)]
    return quality.fit(docs + bad, [1] * 40 + [0] * 40, epochs=3, seed=seed)


def test_score_is_that_of_the_network_written_out():
    net = network()
    docs = [b"", b"a", b"x" * 58, b"y" * 59, b"z" * 60, b"w" * 64, b"Words and !! $$$ more " * 9, b"0123456789" * 130, b"!!"]
    found = quality.probabilities(net, docs)
    assert np.allclose(found, [one_score(net, d) for d in docs], atol=1e-5)
    assert np.array_equal(found[::-1], quality.probabilities(net, docs[::-1]))


def test_equal_texts_score_equal_whatever_the_partitions(spark, documents):
    net = network()
    scored = {n: {r["doc_id"]: r["score"] for r in quality.score(documents.repartition(n), net).collect()} for n in (1, 50)}
    assert scored[1] == scored[50]
    copies = documents.groupBy("text").agg(F.collect_list("doc_id").alias("ids")).where(F.size("ids") > 1).collect()
    assert copies and all(len({scored[1][i] for i in r["ids"]}) == 1 for r in copies)
    kept = {n: sorted(r["doc_id"] for r in quality.keep_good(documents.repartition(n), net).select("doc_id").collect()) for n in (1, 50)}
    assert kept[1] == kept[50]

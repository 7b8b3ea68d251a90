"""Groups spelling variants: words that one inserted, deleted or replaced code point separates.

Two different words, the longer of L code points, are near if their common prefix and common
suffix together reach L - 1. So some multiple ``a`` of ``open_places`` exists for which they
share the first ``a`` and the last ``L - a - open_places`` code points. Words meet in the
blocks of (L, a, shared ends), where at most ``open_places`` code points are free: a block
holds no more words than the alphabet has strings of that many code points or one fewer,
however large the corpus is. Each near pair counts in one block alone, that of the largest
``a`` in its common prefix.

Blocks of equal size are stacked and compared as dense padded code-point matrices, once from
the left for prefixes and once from the right for suffixes; a large block is cut into tiles
and compared tile by tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.llm.common import stored, take_over

# Letters of a run, and the capitals that become small ones.
LETTERS = r"[a-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 6
MIN_COUNT = 5
TIMES = 5
SLIP = 199
OPEN_PLACES = 3
TILE = 512
BLOCK_WORDS = 50_000  # of blocks compared at once
CELLS = 4 << 20  # bytes of one dense comparison


# --- words ---------------------------------------------------------------------------------


def runs_of(text: Column) -> Column:
    """Runs of letters, A-Z in lower case, in order."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), F.lit(LETTERS), F.lit(0))


def with_slips(run: Column, doc_id: Column, every: int = SLIP) -> Column:
    """The run as the table has it, one in ``every`` with a code point left out: where it is
    left out depends on the id and the run alone."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, short).otherwise(run)


def word_counts(words: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of words long and frequent enough; counted before the shuffle too, so
    that a very common word is one row a map task."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def words_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``word``: every run of letters with its slips, one row an occurrence. NULL texts have
    none; a NULL id counts as an empty one. Runs too short to give a word are left out."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.filter(runs_of(F.col(text_col)), lambda r: F.length(r) >= min_chars)).alias("run"))
    return runs.select(with_slips(F.col("run"), F.col("id")).alias("word"))


# --- near words ----------------------------------------------------------------------------


def blocks_of(words: DataFrame, open_places: int = OPEN_PLACES) -> DataFrame:
    """``longer`` (L), ``at`` (a), ``ends`` (shared ends) and the words of each block of two
    words or more. A word is the longer one of blocks of its own length, the shorter one of
    blocks one longer."""
    size = F.length("word")
    lengths = words.withColumn("longer", F.explode(F.array(size, size + 1)))
    places = lengths.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("longer") - 1, F.lit(open_places))))
    tail = F.greatest(F.col("longer") - F.col("at") - open_places, F.lit(0))
    # The length of the first part is known from ``at``, so the two parts need no mark between.
    ends = F.concat(F.substring("word", F.lit(1), F.col("at")), F.substring(F.col("word"), F.length("word") - tail + 1, tail))
    keyed = places.select("longer", "at", ends.alias("ends"), F.struct("word", "n").alias("entry"))
    blocks = keyed.groupBy("longer", "at", "ends").agg(F.collect_list("entry").alias("entries"))
    return blocks.where(F.size("entries") > 1)


def code_points(words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words as rows of code points, padded behind and padded in front."""
    width = int(lengths.max())
    left = np.array(words, f"<U{width}").view("<u4").reshape(len(words), width)
    places = np.arange(width) - (width - lengths)[:, None]
    right = np.where(places >= 0, np.take_along_axis(left, np.maximum(places, 0), 1), 0)
    return left, right.astype("<u4")


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal code points from the first column on, of every row of ``a`` with every row of ``b``
    (the last axis is the columns, the one before it the rows, further axes are stacked)."""
    equal = a[..., :, None, :] == b[..., None, :, :]
    # Padding is never equal to a code point, and equal rows are not compared.
    unlike = np.concatenate([~equal, np.ones((*equal.shape[:-1], 1), bool)], -1)
    return unlike.argmax(-1)


def near_in(left: np.ndarray, right: np.ndarray, lengths: np.ndarray, rows: np.ndarray, others: np.ndarray, longer: np.ndarray, at: np.ndarray, open_places: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of stacked blocks (or of two tiles of a block).

    ``rows`` and ``others`` have a stack of row numbers for each block. A pair counts if one
    of its words has ``longer`` code points and its common prefix lies at ``at``.
    """
    prefix = common(left[rows], left[others])
    suffix = common(right[rows][..., ::-1], right[others][..., ::-1])
    most = np.maximum(lengths[rows][..., :, None], lengths[others][..., None, :])
    of_block = (longer[:, None, None], (at // open_places)[:, None, None])
    found = (most == of_block[0]) & (np.minimum(prefix, most - 1) // open_places == of_block[1])
    found &= (prefix + suffix >= most - 1) & (rows[..., :, None] < others[..., None, :])
    stack, i, j = np.nonzero(found)
    return rows[stack, i], others[stack, j]


def near_rows(words: list[str], sizes: np.ndarray, longer: np.ndarray, at: np.ndarray, open_places: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs, as row numbers, of blocks that lie one behind the other in ``words``."""
    lengths = np.array([len(w) for w in words])
    left, right = code_points(words, lengths)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    pairs = []
    for size in np.unique(sizes).tolist():
        chosen = np.flatnonzero(sizes == size)
        cuts = [(k, min(k + tile, size)) for k in range(0, size, tile)]
        step = max(1, CELLS // (min(size, tile) ** 2 * left.shape[1]))
        for k in range(0, len(chosen), step):
            some = chosen[k : k + step]
            for x, (a, b) in enumerate(cuts):
                for c, d in cuts[x:]:
                    rows, others = (starts[some][:, None] + np.arange(*span) for span in ((a, b), (c, d)))
                    pairs.append(near_in(left, right, lengths, rows, others, longer[some], at[some], open_places))
    one, two = zip(*pairs)
    return np.concatenate(one), np.concatenate(two)


def nearest(words: np.ndarray, counts: np.ndarray, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
    """Of each word with near words here: how many, and the most frequent of them."""
    who, near = np.concatenate([one, two]), np.concatenate([two, one])
    order = np.lexsort((words[near], -counts[near], words[who]))
    who, near = who[order], near[order]
    firsts = np.flatnonzero(np.concatenate([[True], words[who][1:] != words[who][:-1]])) if len(who) else who
    times = np.diff(np.append(firsts, len(who)))
    names = [pa.array(words[x[firsts]].tolist(), pa.string()) for x in (who, near)]
    return pa.RecordBatch.from_arrays([names[0], pa.array(times, pa.int64()), names[1], pa.array(counts[near[firsts]], pa.int64())], ["word", "n_near", "near", "near_n"])


def runs_of_blocks(batch: pa.RecordBatch, most: int = BLOCK_WORDS) -> Iterator[pa.RecordBatch]:
    """The batch in runs of blocks that hold about ``most`` words, one block at least."""
    ends = np.cumsum(batch.column("entries").value_lengths().to_numpy())
    start, floor = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(ends.searchsorted(floor + most, "right")))
        yield batch.slice(start, stop - start)
        start, floor = stop, int(ends[stop - 1])


def near_words(words: DataFrame, open_places: int = OPEN_PLACES, tile: int = TILE) -> DataFrame:
    """``word``, ``n_near``, ``near`` and ``near_n`` (the near word of largest ``n``, of these
    the smallest in code-point order) of words that have one. ``words`` are distinct ``word``
    with their ``n``, of one code point at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("spellings")
        for whole in batches:
            for batch in runs_of_blocks(whole):
                entries = batch.column("entries")
                flat = entries.flatten()
                names = flat.field("word").to_pylist()
                sizes, longer, at = (x.to_numpy() for x in (entries.value_lengths(), batch.column("longer"), batch.column("at")))
                one, two = near_rows(names, sizes, longer, at, open_places, tile)
                yield nearest(np.array(names), flat.field("n").to_numpy(), one, two)

    found = blocks_of(words, open_places).mapInArrow(run, "word string, n_near bigint, near string, near_n bigint")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.near", "best.near_n")


# --- groups --------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of its forms, of all rows of ``word`` and ``form``.

    Every round goes twice as far as the one before, until nothing moves. Counts grow
    ``TIMES``-fold from word to form, so chains are short and have no cycles.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "spelling-roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def spelling_groups(words: DataFrame, *, times: int = TIMES, open_places: int = OPEN_PLACES) -> DataFrame:
    """Every word with its near words and its form, from distinct ``word`` and ``n``.

    ``form`` is the near word of largest ``n`` (of these the smallest in code-point order) if
    it has ``times`` as many as the word, with its count ``form_n``, else NULL; ``root`` is
    reached by following forms, a word without a form is its own; ``n_near`` is 0 without
    near words. No row gives no row. Other columns are left out; NULL words are too.
    """
    words = stored(words.select("word", "n").where("word <> ''"), "spelling-words")
    near = words.join(near_words(words, open_places), "word", "left")
    enough = F.col("near_n") >= times * F.col("n")
    near = stored(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n"),
        ),
        "spelling-near",
    )
    ends = roots(near.where("form is not null"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spellings(docs: DataFrame) -> DataFrame:
    """The contract's words, counts and multiples."""
    return spelling_groups(word_counts(words_of(docs)))

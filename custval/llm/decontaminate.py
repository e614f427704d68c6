"""Benchmark decontamination with spaced seeds.

A seed is a window of words of which a fixed mask ignores some, so it still
matches where a word was replaced.  The seeds of the benchmark and those of the
training documents meet in an equi-join on mask and hash; a bitmap of the
benchmark's seeds, of fixed size, spares the documents' hopeless seeds the
shuffle.  Each hit brings the words around it along, and counts if a stretch of
aligned words about it agrees in all but a few.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custval.llm.arrays import BYTE_VALUES, Words, binary_buffers, blocks, mix64
from custval.llm.chunks import row_key

#: words of a window that a seed reads: by (words, replaced words) sets of masks of which one agrees wherever the replaced words are
MASKS = {(13, 2): ("111110111", "1101011111", "111011000111", "11111001011", "1110011111"),
         (10, 2): ("1111011", "11001111", "1110100011", "1101010101", "10110111")}
#: words of an aligned stretch, and how many of them must agree
STRETCH, SIMILARITY = 13, 0.8
#: the bitmap of benchmark seeds has 2**26 bits (8 MB), whatever the benchmark
BITMAP_BITS = 26

_U = np.uint64
#: words are runs of letters, digits and bytes beyond ASCII; A-Z count as a-z
_VALUES = BYTE_VALUES.copy()
for _c in range(128):
    if not chr(_c).isalnum():
        _VALUES[_c] = 0
    elif chr(_c).isupper():
        _VALUES[_c] = BYTE_VALUES[ord(chr(_c).lower())]


def covering_masks(words: int, replaced: int) -> tuple[str, ...]:
    """Masks of which at least one agrees somewhere in ``words`` aligned words, whichever ``replaced`` of them differ.

    What covers fewer words covers more.  Without a set in ``MASKS`` the words
    are cut into two blocks more than can be hit, and each pair of blocks is a mask.
    """
    known = [n for n, r in MASKS if r == replaced and n <= words]
    if known:
        return MASKS[max(known), replaced]
    n = min(replaced + 2, words)
    edges = [words * k // n for k in range(n + 1)]
    return tuple(sorted({"".join("1" if any(edges[b] <= k < edges[b + 1] for b in kept) else "0" for k in range(words)).strip("0")
                         for kept in combinations(range(n), n - replaced)}))


_SEEDS = "id long, mask int, hash long, place long, around array<long>, n_words long"


def _seeds(words: Words, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of one text under a mask."""
    size = len(mask)
    m = len(words.hash) - size + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, _U)
    first = np.flatnonzero(words.doc[:m] == words.doc[size - 1:])
    h = np.full(m, number + 1, _U)
    for k in (k for k, bit in enumerate(mask) if bit == "1"):
        h = h * _U(0xD1342543DE82EF95) + words.hash[k: k + m]
    return first, mix64(h[first])


def _around(words: Words, first: np.ndarray, size: int, stretch: int, none: int) -> np.ndarray:
    """Word hashes from ``stretch - size`` words before each seed to as many behind it; ``none`` beyond the text."""
    at = first[:, None] + np.arange(size - stretch, stretch)
    inside = np.clip(at, 0, max(0, len(words.hash) - 1))
    own = (at == inside) & (words.doc[inside] == words.doc[first][:, None])
    return np.where(own, words.hash[inside] | _U(2), _U(none)).view(np.int64)


def _with_seeds(table: DataFrame, id_col: str, text_col: str, masks: list[str], reads: np.ndarray, stretch: int, none: int, bitmap=None) -> DataFrame:
    """The seeds of every text under the masks that ``reads`` has for its number of words, or those of them in the bitmap."""
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None
        for batch in batches:
            for a, _, data, cut in blocks(*binary_buffers(batch["data"])):
                words = Words(data, cut, _VALUES)
                ids = batch["id"].slice(a, len(cut) - 1).to_numpy(zero_copy_only=False)
                read = reads[:, np.minimum(np.diff(words.first), stretch)]
                for number, mask in enumerate(masks):
                    if not read[number].any():
                        continue
                    first, h = _seeds(words, mask, number)
                    if not read[number].all():
                        own = read[number][words.doc[first]]
                        first, h = first[own], h[own]
                    if bits is not None:
                        slot = (h >> _U(64 - BITMAP_BITS)).astype(np.int64)
                        hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                        first, h = first[hit], h[hit]
                    for k in range(0, len(first), 1 << 15):
                        f = first[k: k + (1 << 15)]
                        doc, near = words.doc[f], _around(words, f, len(mask), stretch, none)
                        yield pa.record_batch({
                            "id": pa.array(ids[doc], pa.int64()), "mask": pa.array(np.full(len(f), number), pa.int32()),
                            "hash": pa.array(h[k: k + (1 << 15)].view(np.int64)), "place": pa.array(f - words.first[doc], pa.int64()),
                            "around": pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), near.ravel()),
                            "n_words": pa.array(np.diff(words.first)[doc], pa.int64())})

    return (table.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("data")).mapInArrow(run, _SEEDS))


def _bitmap(seeds: DataFrame) -> tuple[bytes, set[int]]:
    """Which leading ``BITMAP_BITS`` bits occur among the seeds (rows of 4 KB, 8 MB at most), and which masks."""
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_BITS) + 1
    parts = (seeds.groupBy(F.bitmap_bucket_number(slot).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"), F.collect_set("mask").alias("masks")).collect())
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for p in parts:
        at = (p["part"] - 1) * 4096
        out[at: at + 4096] = np.frombuffer(p["bits"], np.uint8)
    return out.tobytes(), {k for p in parts for k in p["masks"]}


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] | None = None,
                 stretch: int = STRETCH, similarity: float = SIMILARITY) -> DataFrame:
    """Documents that hold a passage of a benchmark item, words replaced or not.

    A hit counts if, of ``stretch`` aligned words that include the seed (all of
    the item's if it has fewer), at least the share ``similarity`` agree.  Every
    such stretch has a seed (``covering_masks``), unless other ``masks`` are
    given for items of at least ``stretch`` words; shorter items have masks by
    their number of words, down to the whole item where no word may differ.
    Returns per document and item with such a hit ``doc_id``, ``item_id``,
    ``n_hits`` (seed places in the document), ``first_word``, ``last_word``
    (of the stretches' seeds, end exclusive) and ``agreeing`` (the most words
    that agree).  Items with the same text are one, named by the smallest id;
    items without a word match nothing.  Null or empty texts and rows
    without an id match nothing, rows that share an id count as one document;
    other columns are not read.
    """
    if masks and max(len(m) for m in masks) > stretch:
        raise ValueError("masks must be no longer than the stretch")
    by_words = {n: covering_masks(n, n - max(1, math.ceil(similarity * n))) for n in range(1, stretch + 1)}
    by_words[stretch] = masks or by_words[stretch]
    every = list(dict.fromkeys(m for n in range(stretch, 0, -1) for m in by_words[n]))
    reads = np.array([[m in by_words.get(n, ()) for n in range(stretch + 1)] for m in every])
    items = benchmark.groupBy(F.col(item_text_col).alias("text")).agg(F.min(item_col).alias("item"))
    tests = _with_seeds(items, "item", "text", every, reads, stretch, 0)
    bits, used = _bitmap(tests)
    bitmap = docs.sparkSession.sparkContext.broadcast(bits)
    in_use = np.repeat([[k in used] for k in range(len(every))], stretch + 1, axis=1)
    train = _with_seeds(docs, id_col, text_col, every, in_use, stretch, 1, bitmap)
    t = tests.select("mask", "hash", F.col("id").alias("item_id"), F.col("around").alias("theirs"),
                     F.ceil(similarity * F.least(F.col("n_words"), F.lit(stretch))).alias("need"))
    hits = train.select(F.col("id").alias("doc_id"), "mask", "hash", "place", "around").join(t, ["mask", "hash"])
    same = F.zip_with("around", "theirs", lambda x, y: (x == y).cast("int"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - stretch + 1),
                                   lambda k: F.aggregate(F.slice(F.col("same"), k, stretch), F.lit(0), lambda n, x: n + x)))
    return (hits.withColumn("same", same).withColumn("agreeing", best).where("agreeing >= need")
            .groupBy("doc_id", "item_id")
            .agg(F.count_distinct("place").alias("n_hits"), F.min("place").alias("first_word"), F.max(F.col("place") + 2 * stretch - F.size("same")).alias("last_word"),
                 F.max("agreeing").cast("long").alias("agreeing")))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", min_words: int = 3) -> DataFrame:
    """Rows of ``docs`` without a passage of the benchmark, all columns.

    Rows that share an id go together; a row without an id is searched under a
    hash of its text and goes or stays by itself.  Hits of fewer than
    ``min_words`` agreeing words, which only items of one or two words have,
    remove nothing: ``contaminated`` reports them.  Null and empty texts stay; an
    empty benchmark removes nothing.
    """
    key = row_key(id_col, text_col)
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    bad = (contaminated(keyed, benchmark, "key", "text", item_col, item_text_col).where(F.col("agreeing") >= min_words)
           .select(F.col("doc_id").alias("__bad")).distinct())
    return docs.join(bad, key == bad["__bad"], "left_anti")

"""Repeated passages by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``WINDOW`` consecutive words. Every word covered by a window that also starts elsewhere is removed.

Anchors route the work. A window's anchor is its smallest run of ``SEED`` words by hash (the first one, if it repeats),
so equal windows have equal anchors at equal places in them. The windows of one anchor follow each other; its context is
what they hold, at most ``WINDOW - SEED`` words before and after it.

1. Each text gives its anchors, some 7 for 100 words, as (seed, context) hashes. Contexts are counted, and two places of
   each are kept. Only seeds that stand in two places or more can hold repeats.
2. One passage of each context of such a seed goes to the seed's reference block, and a second one, from another place, if
   the context occurs twice or more; further copies add nothing. A block's passages are indexed by sorted suffixes, aligned
   at their seeds. Each passage is parsed greedily against all others: a factor is the longest match from where the last
   one ended. Windows inside a factor are repeated; only those across the end of a factor are looked up on their own, as
   a greedy factor may end inside a window that repeats elsewhere. Nothing is repeated but by such a factor or look-up.
3. A seed with more than ``BLOCK`` passages (a very common phrase) would make a block too large. Every window around it
   holds ``HALF`` more words on its left or on its right, so its passages go to the blocks of these two longer phrases.
   If one of these is still too common, its windows' hashes are counted instead: linear, exact, and never gathered.
4. The verdict of a context holds wherever it occurs. Each text gets its repeated windows back and drops their words.

Hashes have 64 bits for seed and context each; a row is named by its id and 64 bits of its text; passages are compared word
by word (64-bit hashes of words).

Nulls and repeats: a null or short text has no windows. Rows without doc_id, and rows that share one, are told apart by
their text: rows with equal id and text are one text that occurs that many times. Empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import BASE, WordHashes, discard, gram_hashes, mixed, raw_texts, signed, small_batches, stored

WINDOW = 35
SEED = 8
REACH = WINDOW - SEED
#: Words of a full passage: a seed and its reach on both sides.
PASSAGE = 2 * REACH + SEED
#: Most passages of one seed in a reference block.
BLOCK = 8192
#: Words that every window has beside its seed on one side or the other.
HALF = (REACH + 1) // 2
#: Passages that are handed on together.
BATCH = 16_384

ANCHORS = "seed bigint, context bigint, id bigint, mark bigint, spot bigint"


def _document(doc_id, text: bytes) -> tuple[int, int]:
    """Key of a row: its id and 64 bits of its text, so that only texts of one id could be mistaken for each other."""
    return doc_id or 0, xxhash.xxh3_64_intdigest(text) - (1 << 63)


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of one text: their hashes, places, and how many words their windows hold before and after."""
    if len(words) < WINDOW:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    seeds = gram_hashes(words, SEED)
    owners = sliding_window_view(seeds, REACH + 1).argmin(axis=1) + np.arange(len(words) - WINDOW + 1)
    first = np.flatnonzero(np.diff(owners, prepend=-1))
    at = owners[first]
    last = np.append(first[1:], len(owners)) - 1
    return seeds[at], at, at - first, last + REACH - at


def _spots(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Place and reach of anchors in one number each."""
    return at << 12 | left << 6 | right


def _unpacked(spots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spots >> 12, spots >> 6 & 63, spots & 63


def _powers(count: int) -> np.ndarray:
    powers = np.empty(count + 1, np.uint64)
    powers[0] = 1
    powers[1:] = BASE
    return np.multiply.accumulate(powers)


INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def _contexts(words: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of the contexts of anchors, which also hold where in its context an anchor lies."""
    low, high = at - left, at + SEED + right
    powers = _powers(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    back = np.full(len(words) + 1, INVERSE, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    spread = (sums[high] - sums[low]) * back[low]
    return mixed(spread ^ mixed((left << 6 | right).astype(np.uint64)))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for batch in small_batches(batches, "text"):
        found = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
            words = memo.of(text.split())
            seeds, *reach = anchors(words)
            if len(seeds):
                row = [np.full(len(seeds), number, np.int64) for number in _document(doc_id, text)]
                found.append((signed(seeds), signed(_contexts(words, *reach)), *row, _spots(*reach)))
        if found:
            columns = [pa.array(np.concatenate(column)) for column in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "context", "id", "mark", "spot"])


PASSAGES = "key bigint, seed bigint, context bigint, large boolean, left int, words binary"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of the wanted anchors of each text: ``wanted`` lists (spot, seed, context, large)."""
    memo = WordHashes()
    for batch in small_batches(batches, "text"):
        wanted = batch.column("wanted")
        spots, seeds, contexts, large = wanted.flatten().flatten()
        spots, begin = spots.to_numpy(), 0
        for text, count in zip(raw_texts(batch), pc.list_value_length(wanted).to_pylist()):
            words = memo.of(text.split())
            for first in range(begin, begin + count, BATCH):
                many = min(BATCH, begin + count - first)
                at, left, right = _unpacked(spots[first : first + many])
                sizes = left + SEED + right
                ends = np.cumsum(sizes)
                taken = words[np.arange(ends[-1]) + np.repeat(at - left - ends + sizes, sizes)]
                offsets = np.concatenate([[0], 8 * ends]).astype(np.int32)
                cut = pa.Array.from_buffers(pa.binary(), many, [None, pa.py_buffer(offsets), pa.py_buffer(taken)])
                seed = seeds.slice(first, many)
                columns = [seed, seed, contexts.slice(first, many), large.slice(first, many), pa.array(left.astype(np.int32)), cut]
                yield pa.RecordBatch.from_arrays(columns, ["key", "seed", "context", "large", "left", "words"])
            begin += count


def _passage_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["key", "seed", "context", "large", "left", "words"])


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of a common seed under the keys of the two longer phrases, as far as they reach."""
    for batch in batches:
        rows = []
        for seed, context, left, raw in zip(*(batch.column(c).to_pylist() for c in ("seed", "context", "left", "words"))):
            words = len(raw) // 8
            for side, low, high in ((1, left - HALF, left + SEED), (2, left, left + SEED + HALF)):
                if 0 <= low and high <= words:
                    key = xxhash.xxh3_64_intdigest(raw[8 * low : 8 * high], side) - (1 << 63)
                    rows.append((key, seed, context, False, left, raw))
        yield _passage_batch(rows)


class ReferenceBlock:
    """The sorted suffixes of a block's passages, and the greedy parse of each passage against all others.

    Passages stand in rows of ``PASSAGE`` symbols, their seeds in one column. A symbol is a word among the passages of one
    key, so that only aligned passages of one key match; what a passage lacks is 0.
    """

    def __init__(self, keys: np.ndarray, lefts: np.ndarray, sizes: np.ndarray, words: np.ndarray):
        self.first = REACH - lefts
        self.stop = self.first + sizes
        column = np.arange(PASSAGE)
        real = (column >= self.first[:, None]) & (column < self.stop[:, None])
        self.symbols = np.zeros(real.shape, np.uint64)
        self.symbols[real] = mixed(words ^ np.repeat(mixed(keys.astype(np.uint64)), sizes))
        # Suffixes are sorted from the last column on: a stable sort by one symbol keeps the order of what follows it.
        order = np.arange(len(keys))
        self.order, self.place = {}, {}
        for at in range(PASSAGE - 1, -1, -1):
            order = order[np.argsort(self.symbols[order, at], kind="stable")]
            if at <= REACH:
                self.order[at], self.place[at] = order, np.empty_like(order)
                self.place[at][order] = np.arange(len(order))

    def longest(self, rows: np.ndarray, column: int) -> np.ndarray:
        """Length of the longest match with another passage, from a column on: one of the suffix's two neighbours has it."""
        order, place = self.order[column], self.place[column][rows]
        best = np.zeros(len(rows), np.int64)
        for side in (-1, 1):
            there = np.flatnonzero((place + side >= 0) & (place + side < len(order)))
            same = self.symbols[rows[there], column:] == self.symbols[order[place[there] + side], column:]
            length = np.where(same.all(axis=1), PASSAGE - column, same.argmin(axis=1))
            best[there] = np.maximum(best[there], length)
        return np.minimum(best, self.stop[rows] - column)

    def repeated_windows(self) -> np.ndarray:
        """For each passage a mask of its repeated windows; bit j is the window from column j."""
        masks, end = np.zeros(len(self.first), np.int64), self.first.copy()
        for column in range(REACH + 1):
            here = (self.first <= column) & (column + WINDOW <= self.stop)
            inside = here & (column + WINDOW <= end)
            masks[inside] |= 1 << column
            # What is left starts a factor, or lies across the end of one.
            rows = np.flatnonzero(here & ~inside)
            length = self.longest(rows, column)
            masks[rows[length >= WINDOW]] |= 1 << column
            begins = end[rows] == column
            end[rows[begins]] = column + np.maximum(length[begins], 1)
        return masks


def _differs(rows: pa.Table, back: int) -> np.ndarray:
    """Which rows have another key, seed or context than the one so many rows before."""
    out = np.ones(rows.num_rows, bool)
    if rows.num_rows > back:
        out[back:] = False
        for name in ("key", "seed", "context"):
            values = rows.column(name).to_numpy()
            out[back:] |= values[back:] != values[:-back]
    return out


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the passages of one partition; its rows come sorted by key, seed and context."""
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        kept = rows if kept is None else pa.concat_tables([kept, rows])
        # Two passages of a context tell all; more come where rows share id and text.
        kept = kept.filter(pa.array(_differs(kept, 2)))
        if kept.num_rows > 2 * BLOCK:
            keys = kept.column("key").to_numpy()
            cut = int(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[-1])
            if cut:  # the last key may go on
                yield from _blocks(kept.slice(0, cut))
                kept = kept.slice(cut).combine_chunks()
    if kept is not None and kept.num_rows:
        yield from _blocks(kept)


def _blocks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    words = rows.column("words")
    block = ReferenceBlock(
        rows.column("key").to_numpy(),
        rows.column("left").to_numpy().astype(np.int64),
        pc.binary_length(words).to_numpy().astype(np.int64) // 8,
        np.frombuffer(b"".join(words.to_pylist()), np.uint64),
    )
    masks = block.repeated_windows()
    told = np.flatnonzero((masks != 0) & _differs(rows, 1))
    columns = [rows.column(c).to_numpy()[told] for c in ("seed", "context")]
    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(masks[told])], ["seed", "context", "mask"])


WINDOWS = "key bigint, seed bigint, context bigint, column int, window bigint"


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window hashes of passages."""
    for batch in batches:
        out = []
        for key, seed, context, left, words in zip(*(batch.column(c).to_pylist() for c in ("key", "seed", "context", "left", "words"))):
            hashes = gram_hashes(np.frombuffer(words, np.uint64), WINDOW)
            out += [(key, seed, context, REACH - left + k, h) for k, h in enumerate(signed(hashes).tolist())]
        columns = list(zip(*out)) if out else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["key", "seed", "context", "column", "window"])


def repeated_contexts(texts: DataFrame) -> DataFrame:
    """``id, mark, spots``: for each text with repeated windows the anchors' places and masks of windows."""
    found = stored(texts.mapInArrow(_anchor_rows, ANCHORS))
    place = F.struct("id", "mark", "spot")
    contexts = found.groupBy("seed", "context").agg(F.count("*").alias("n"), F.min(place).alias("one"), F.max(place).alias("other"))
    # A second place is kept only where there is one: null, but for repeats.
    other = F.when(F.col("other") != F.col("one"), F.col("other"))
    contexts = stored(contexts.select("seed", "context", (F.col("n") > 1).alias("twice"), "one", other.alias("other")))
    seeds = contexts.groupBy("seed").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("passages")).where("passages > 1")
    wanted = contexts.join(seeds, "seed").select(
        "seed", "context", (F.col("passages") > BLOCK).alias("large"), F.explode(F.array_compact(F.array("one", "other"))).alias("place")
    )
    want = F.struct("place.spot", "seed", "context", "large")
    wanted = wanted.groupBy("place.id", "place.mark").agg(F.collect_list(want).alias("wanted"))
    passages = stored(texts.join(wanted, ["id", "mark"]).select("text", "wanted").mapInArrow(_passages, PASSAGES))
    columns = ["key", "seed", "context", "left", "words"]
    halves = stored(passages.where("large").mapInArrow(_halves, PASSAGES))
    sizes = halves.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    longer = halves.join(sizes, "key")
    small = passages.where("NOT large").select(*columns).unionByName(longer.where(F.col("n") <= BLOCK).select(*columns))
    blocks = small.repartition("key").sortWithinPartitions("key", "seed", "context")
    factored = blocks.mapInArrow(_block_rows, "seed bigint, context bigint, mask bigint")
    windows = longer.where(F.col("n") > BLOCK).mapInArrow(_window_rows, WINDOWS)
    # Two passages of one key are two places, so a window that comes twice there is repeated.
    common = windows.groupBy("key", "column", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    counted = windows.join(common, ["key", "column", "window"]).groupBy("seed", "context").agg(
        F.expr("bit_or(shiftleft(1L, `column`))").alias("mask")
    )
    masks = stored(factored.unionByName(counted))
    discard(contexts, passages, halves)
    return found.join(masks, ["seed", "context"]).groupBy("id", "mark").agg(F.collect_set(F.struct("spot", "mask")).alias("spots"))


def removed_words(count: int, at: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which of a text's words lie in a repeated window, by the places of its anchors and their masks."""
    column = np.arange(REACH + 1)
    begins = (at[:, None] - REACH + column)[(masks[:, None] >> column & 1) > 0]
    edges = np.bincount(begins, minlength=count + 1) - np.bincount(begins + WINDOW, minlength=count + 1)
    return np.cumsum(edges[:count]) > 0


CUT = "doc_id bigint, n_words bigint, n_removed bigint, removed array<array<int>>, kept string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        counts, gone, spans, kept, begin = [], [], [], [], 0
        spots = batch.column("spots")
        places, masks = (x.to_numpy() for x in spots.flatten().flatten())
        places = _unpacked(places)[0]
        for text, size in zip(raw_texts(batch), pc.list_value_length(spots).fill_null(0).to_pylist()):
            words = text.split()
            removed = removed_words(len(words), places[begin : begin + size], masks[begin : begin + size])
            begin += size
            counts.append(len(words)), gone.append(int(removed.sum()))
            spans.append(np.flatnonzero(np.diff(removed, prepend=False, append=False)).reshape(-1, 2).tolist())
            kept.append(b" ".join([w for w, r in zip(words, removed) if not r] if removed.any() else words))
        columns = [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int32())))]
        columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "removed", "kept"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_document(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), raw_texts(batch))]
        ids, marks = zip(*keys) if keys else ((), ())
        yield batch.append_column("id", pa.array(ids, pa.int64())).append_column("mark", pa.array(marks, pa.int64()))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept`` of every row of ``docs``: the removed spans ``[begin, end)`` of words,
    and the text without them."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = texts.mapInArrow(_keyed, "doc_id bigint, text string, id bigint, mark bigint")
    spots = repeated_contexts(keyed)
    return keyed.join(spots, ["id", "mark"], "left").select("doc_id", "text", "spots").mapInArrow(_cut, CUT)


def digests(docs: DataFrame) -> DataFrame:
    """The counts of ``without_repeats`` and the hash of what it keeps."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

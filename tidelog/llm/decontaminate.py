"""Benchmark decontamination with an FM-index for every shard of documents.

A shard is a run of documents of one task, about ``SHARD_WORDS`` words. Its index holds the sorted suffixes' transform
(``bwt``) in a wavelet tree of ranks, and the text positions of every ``SAMPLE``-th suffix. All test phrases are searched
backwards at once: each step narrows a pair of suffix ranks per phrase by two rank queries. Occurrences are located by
walking from their suffix to a sampled one. Their word spans are merged per document.

Words: A-Z lowered, then runs of characters other than ASCII ones that are no digit and no letter. A phrase is a run of
``WINDOW`` words of an item, or the whole item if it is shorter.

The tree's alphabet is the phrases' vocabulary. All other words, and the end of each document, are one symbol there and
unlike each other in the sort, so a suffix is told apart at its first such word; their positions are all sampled.

Phrases are a stated query set. Items are cut into pieces that overlap, so that each phrase is whole in one, and pieces
are dealt by hash to blocks of about half of ``BLOCK_WORDS`` words. Each block is collected, sent to the tasks and
searched in a job of its own, and destroyed before the next is sent: neither the driver nor a task holds two blocks,
however large the benchmark and its items are. With one block, documents are only read; with more, they are written
once with a key for each row, and what the blocks found is merged by that key.

Nulls and repeats: null or wordless texts have no words and no hits. An item without words has no phrase; an item
without id is searched under the empty id. Every document row gives one result row, also where ids are null or repeat.
Empty tables give empty results.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import discard, fresh_name, raw_texts, small_batches, stored

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLE = 16
BLOCK_WORDS = 400_000
#: Phrases that begin in one piece of an item.
PIECE = 4096
#: Bytes of shards' texts that wait for each other; a longer single document is a shard of its own.
SHARD_BYTES = 6 << 20
#: The same where texts are rewritten, which holds each of them several times.
REWRITTEN_BYTES = 2 << 20

#: On UTF-8 bytes: all bytes of characters beyond ASCII are word bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Phrases:
    """Distinct phrases of one block of items: word ids from 1, one row each; shorter phrases are padded with 0."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + WINDOW]), set()).add(item_id)
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.words = np.zeros((len(found), WINDOW), np.int64)
        for row, phrase in enumerate(found):
            self.words[row, : len(phrase)] = phrase


class WaveletTree:
    """Rank of a symbol in a prefix of a sequence: one bit vector per bit of the alphabet, as counts of set bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=counts[1:])
            zeros = len(symbols) - int(counts[-1])
            self.levels.append((bit, counts, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each ``end``."""
        begin = np.zeros_like(end)
        for bit, counts, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            begin_ones, end_ones = counts[begin], counts[end]
            begin = np.where(one, zeros + begin_ones, begin - begin_ones)
            end = np.where(one, zeros + end_ones, end - end_ones)
        return end - begin


def sorted_suffixes(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling; only suffixes that still tie are sorted again."""
    count = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(count, np.int64)
    change = np.flatnonzero(np.diff(symbols[order], prepend=symbols[order[:1]] - 1))
    rank[order] = np.repeat(change, np.diff(np.append(change, count)))
    tied = order[np.repeat(np.diff(np.append(change, count)) > 1, np.diff(np.append(change, count)))]
    length = 1
    while len(tied):
        after = tied + length
        follow = np.where(after < count, rank[np.minimum(after, count - 1)] + 1, 0)
        by = np.argsort(rank[tied] * np.int64(count + 1) + follow, kind="stable")
        tied, follow = tied[by], follow[by]
        group = rank[tied]
        order[_places(group)] = tied
        new = np.empty(len(tied), bool)
        new[0] = True
        new[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(tied)))
        rank[tied] = np.repeat(_places(group)[starts], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        length *= 2
    return order


def _places(group: np.ndarray) -> np.ndarray:
    """Rows of the suffix order that sorted members of groups take; a group's number is its first row."""
    starts = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    sizes = np.diff(np.append(starts, len(group)))
    return group + np.arange(len(group)) - np.repeat(starts, sizes)


class FMIndex:
    """Index of one sequence over symbols 0 .. ``top``; 0 stands for words that no phrase has."""

    def __init__(self, symbols: np.ndarray, top: int):
        count = len(symbols)
        # Symbol 0 sorts below all others, and its occurrences differ from each other by their place.
        zero = symbols == 0
        alone = np.cumsum(zero)
        suffixes = sorted_suffixes(np.where(zero, alone, symbols + int(alone[-1])))
        self.bwt = symbols[suffixes - 1]
        self.tree = WaveletTree(self.bwt.astype(np.int32), max(1, int(top).bit_length()))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        # A walk ends at a sampled suffix, or at one that follows symbol 0.
        self.sampled = (suffixes % SAMPLE == 0) | (self.bwt == 0)
        self.place = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]
        self.count = count

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-but-one row of the suffixes that begin with each phrase."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.count, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            word = phrases[live, lengths[live] - back]
            ranks = self.tree.rank(np.tile(word, 2), np.concatenate([low[live], high[live]]))
            low[live] = self.below[word] + ranks[: len(live)]
            high[live] = self.below[word] + ranks[len(live) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        while len(walking):
            at = rows[walking]
            done = self.sampled[at]
            ended = walking[done]
            out[ended] = self.samples[self.place[at[done]]] + steps[ended]
            walking = walking[~done]
            at = at[~done]
            symbol = self.bwt[at]
            rows[walking] = self.below[symbol] + self.tree.rank(symbol, at.astype(np.int64))
            steps[walking] += 1
        return out


def occurrences(index: FMIndex, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Phrase number and text position of all occurrences."""
    low, high = index.search(phrases.words, phrases.lengths)
    sizes = high - low
    which = np.repeat(np.arange(len(sizes)), sizes)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
    return which, index.locate(rows)


def search_shard(texts: list[list[bytes]], blocks) -> list[tuple[np.ndarray, set[str]]]:
    """For each document its hit words (a mask) and the items found in it. ``blocks`` are loaded one after another."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    hit, items = np.zeros(int(sizes.sum()) + 1, np.int64), [set() for _ in texts]
    for block in blocks:
        phrases = block.value
        if not len(phrases.items):
            continue
        known = phrases.vocabulary.get
        symbols = np.zeros(int(sizes.sum()), np.int64)
        for start, text in zip(starts, texts):
            symbols[start : start + len(text)] = [known(w, 0) for w in text]
        which, at = occurrences(FMIndex(symbols, len(phrases.vocabulary)), phrases)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + phrases.lengths[which], -1)
        owners = np.searchsorted(starts, at, side="right") - 1
        pairs = np.unique(np.stack([owners, which]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
        for doc, phrase in pairs.T:
            items[doc].update(phrases.items[phrase])
    covered = np.cumsum(hit) > 0
    return [(covered[start : start + len(text)], found) for start, text, found in zip(starts, texts, items)]


def spans(mask: np.ndarray) -> list[list[int]]:
    """Merged word spans ``[begin, end)`` of a mask."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


FOUND = "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<array<int>>"
#: Separators of words in lower-cased text, as ``WORD`` has it.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shards(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[list, list[list[bytes]]]]:
    keys, texts, size = [], [], 0
    for batch in small_batches(batches, "text", SHARD_BYTES):
        for one, text in zip(batch.column(key).to_pylist(), raw_texts(batch)):
            words = words_of(text)
            if size and size + len(words) > SHARD_WORDS:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(one), texts.append(words)
            size += len(words) + 1
    if keys:
        yield keys, texts


def pieces(benchmark: DataFrame) -> DataFrame:
    """``item, words, n`` of the benchmark's pieces: every phrase of an item is whole in one of its pieces."""
    named = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.array_remove(F.split(F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER), BETWEEN), "").alias("all"),
    )
    begins = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - WINDOW), F.lit(PIECE))
    cut_up = named.where(F.size("all") > 0).select("item", "all", F.explode(begins).alias("begin"))
    words = F.slice("all", F.col("begin") + 1, F.lit(PIECE + WINDOW - 1))
    return cut_up.select("item", F.array_join(words, " ").alias("words"), F.size(words).cast("bigint").alias("n"))


def phrase_blocks(benchmark: DataFrame) -> tuple[int, Callable[[int], Broadcast]]:
    """The number of blocks of the benchmark's phrases, and how to collect and send one of them."""
    cut_up = stored(pieces(benchmark))
    blocks = max(1, -(-2 * (cut_up.agg(F.sum("n").alias("n")).first().n or 0) // BLOCK_WORDS))

    def send(block: int) -> Broadcast:
        rows = cut_up.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).collect()
        return cut_up.sparkSession.sparkContext.broadcast(Phrases([(r.item, r.words.encode()) for r in rows]))

    return blocks, send


def _found(rows: DataFrame, key: str, kind: str, block: Broadcast) -> DataFrame:
    """``key, n_words, items, spans`` of every row of ``rows`` (key, text), for the phrases of one block."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _shards(batches, key):
            found = search_shard(texts, [block])
            columns = [
                pa.array(keys, pa.int64() if kind == "bigint" else pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([sorted(items) for _, items in found], pa.list_(pa.string())),
                pa.array([spans(mask) for mask, _ in found], pa.list_(pa.list_(pa.int32()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "items", "spans"])

    return rows.mapInArrow(searched, f"`{key}` {kind}, n_words bigint, items array<string>, spans array<array<int>>")


def union_of(parts: list[list[list[int]]]) -> list[list[int]]:
    """Merged spans of several blocks; spans that touch become one, as in a mask."""
    out: list[list[int]] = []
    for begin, end in sorted(tuple(s) for part in parts for s in part):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _hits(rows: DataFrame, key: str, blocks: int, send: Callable[[int], Broadcast]) -> DataFrame:
    """``key, items, spans`` of the written ``rows`` (key, text) with a hit, over all blocks, one job each."""
    parts = []
    for block in range(blocks):
        phrases = send(block)
        parts.append(stored(_found(rows, key, "string", phrases).where(F.size("items") > 0).drop("n_words")))
        phrases.destroy()
    every = functools.reduce(DataFrame.union, parts)
    # At most one entry for each block and row.
    every = every.groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.collect_list("spans").alias("parts"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = pa.array([union_of(p) for p in batch.column("parts").to_pylist()], pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("items"), joined], [key, "items", "spans"])

    out = stored(every.mapInArrow(merged, f"`{key}` string, items array<string>, spans array<array<int>>"))
    discard(*parts)
    return out


def _hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every row of ``docs``; spans are merged runs of hit words."""
    blocks, send = phrase_blocks(benchmark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if blocks == 1:
        found = _found(texts, "doc_id", "bigint", send(0))
        return found.select("doc_id", "n_words", _hit_words().alias("n_hit"), "items", "spans")
    rows = stored(texts.withColumn("key", F.expr("uuid()")))
    hits = _hits(rows.select("key", "text"), "key", blocks, send)
    words = F.array_remove(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), BETWEEN), "")
    counted = rows.select("doc_id", "key", F.size(words).cast("bigint").alias("n_words")).join(hits, "key", "left")
    counted = counted.withColumns({c: F.coalesce(c, F.array().cast(hits.schema[c].dataType)) for c in ("items", "spans")})
    return counted.select("doc_id", "n_words", _hit_words().alias("n_hit"), "items", "spans")


def digest_items(items: str):
    """Lowercase hex of the SHA-256 of sorted, comma-joined item ids."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def cut(text: bytes, removed: list[list[int]]) -> bytes:
    """The text without its words of the given spans; what stands between removed words of a span goes too."""
    places = [m.span() for m in WORD.finditer(text.lower())]
    out, at = [], 0
    for begin, end in removed:
        out.append(text[at : places[begin][0]])
        at = places[end - 1][1]
    out.append(text[at:])
    return b"".join(out)


def _without(batch: pa.RecordBatch, new: list, at: int) -> pa.RecordBatch:
    """The batch with new texts; ``n_chars``, if there, is counted again where a text changed."""
    raw = batch.column(at).to_pylist()
    out = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
    if "n_chars" in batch.schema.names:
        place = batch.schema.names.index("n_chars")
        counts = [c if x == y else len(y) for x, y, c in zip(raw, new, batch.column(place).to_pylist())]
        out = out.set_column(place, batch.schema.field(place), pa.array(counts, batch.schema.field(place).type))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the benchmark's words cut out of their texts; all other columns stay as they are.

    A text without hits stays as it is, byte for byte; ``n_chars``, if there, is counted again where text was cut.
    """
    blocks, send = phrase_blocks(benchmark)
    at, block = docs.columns.index("text"), send(0) if blocks == 1 else None

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", REWRITTEN_BYTES):
            new = batch.column("text").to_pylist()
            texts = [words_of((t or "").encode()) for t in new]
            for row, (mask, _) in enumerate(search_shard(texts, [block])):
                if mask.any():
                    new[row] = cut(new[row].encode(), spans(mask)).decode()
            yield _without(batch, new, at)

    if block:
        return docs.mapInArrow(cleaned, docs.schema)
    key, removed = fresh_name("key"), fresh_name("spans")
    rows = stored(docs.withColumn(key, F.expr("uuid()")))
    hits = _hits(rows.select(key, F.col("text").cast("string").alias("text")), key, blocks, send)
    marked = rows.join(hits.select(key, F.col("spans").alias(removed)), key, "left").select(*[F.col(f"`{c}`") for c in docs.columns], removed)

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", REWRITTEN_BYTES):
            new = batch.column("text").to_pylist()
            for row, found in enumerate(batch.column(removed).to_pylist()):
                if found:
                    new[row] = cut(new[row].encode(), found).decode()
            yield _without(batch.drop_columns([removed]), new, at)

    return marked.mapInArrow(rewritten, docs.schema)

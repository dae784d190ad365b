"""Documents linked by the Jaccard similarity of their n-gram sets: a blocked sparse product of the incidence matrix.

A row of the matrix is a document's set of distinct runs of four words (A-Z lowered; the whole text if shorter), a column is
an n-gram. Two documents are linked when their sets overlap by ``THRESHOLD`` per cent or more, so a set of size ``n`` has at
least ``least(n) = ceil(0.85 n)`` n-grams in common with any partner, and lacks at most ``n - least(n)`` of them.

1. Rows that cannot have a partner leave. In the order of hashes, the first ``l`` common n-grams of linked sets lie in the
   first ``n - least(n) + l`` of both. So only that block of columns is counted over all documents, and a row stays only if
   enough of its block occurs in other rows. Rows with equal sets then become one row (a node), and this runs once more.
2. Over what is left, columns are ordered by their number of rows, rare ones first. Linked rows meet in the first
   ``n - least(n) + 1`` columns of this order, so the product needs only these; columns of one row drop out.
3. The product runs against centres first: in each column every row meets the row that shares most columns with others.
   Rows that are then in one component need not meet again, which keeps a group of thousands of near copies linear. What is
   left open meets rows of other components, but only in columns that come early enough in both rows for the bound of
   these two sizes. Pairs whose overlap in the first columns, added to all columns past them, is below that bound are discarded.
4. The overlap of the pairs that remain is accumulated over blocks of columns of the full sets, and a pair is discarded at the
   first block after which even all remaining columns cannot lift it to the bound. No pair above the threshold is lost, so
   components are exact (up to 64-bit hashes of n-grams).

Nulls and repeats: a null or wordless text has an empty set and is linked with nothing. Rows without doc_id are linked with
nothing and have no component. Rows that share a doc_id are one document with the links of all its texts. Empty tables give
empty results; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WordHashes, gram_hashes, raw_texts, sent, signed, small_batches, stored
from tidelog.llm.components import forest

GRAM = 4
THRESHOLD = 85
#: Further part of a set, in per cent, that the first block of columns holds; more tells rows apart better and costs shuffle.
WIDER = 5
#: Rounds against centres before open rows meet all others.
ROUNDS = 2
#: Blocks of columns in which full overlaps are accumulated.
BLOCKS = 8

ROWS = "doc_id bigint, n bigint, set_id binary, block array<bigint>"
SETS = "set_id binary, grams array<bigint>"


def least(n):
    """Fewest n-grams that a set of ``n`` shares with a partner, which is also the partner's least size."""
    return -(-THRESHOLD * n // 100)


def wider(n: int) -> int:
    """How many common n-grams the first block of columns of a set of ``n`` is wide enough for."""
    return max(1, WIDER * n // 100)


def gram_set(words: list[bytes], memo: WordHashes) -> np.ndarray:
    """Distinct n-gram hashes of lower-cased words, ascending as signed numbers."""
    if not words:
        return np.zeros(0, np.int64)
    return np.unique(signed(gram_hashes(memo.of(words), min(GRAM, len(words)))))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for batch in small_batches(batches, "text"):
        sets = [gram_set(text.lower().split(), memo) for text in raw_texts(batch)]
        first = [x[: len(x) - least(len(x)) + wider(len(x))] for x in sets]
        ids = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
        counts = pa.array([len(x) for x in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, pa.array(ids, pa.binary()), _lists(first)], ["doc_id", "n", "set_id", "block"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for batch in small_batches(batches, "text", 2 << 20):
        sets = [x for x in (gram_set(text.lower().split(), memo) for text in raw_texts(batch)) if len(x)]
        ids = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([ids, _lists(sets)], ["set_id", "grams"])


def enough(one: int, two: int) -> int:
    """Least overlap of linked sets of these sizes: 100 * o >= 85 * (one + two - o)."""
    return -(-THRESHOLD * (one + two) // (100 + THRESHOLD))


_EDGES = np.array([-(2**63) + k * (2**64 // BLOCKS) for k in range(1, BLOCKS)], np.int64)


def overlap_reaches(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two ascending sets are linked, by their overlap accumulated over blocks of columns."""
    need, shared, a, b = enough(len(one), len(two)), 0, 0, 0
    if min(len(one), len(two)) < need:
        return False
    ends = zip([*np.searchsorted(one, _EDGES), len(one)], [*np.searchsorted(two, _EDGES), len(two)])
    for a_end, b_end in ends:
        both = np.concatenate([one[a:a_end], two[b:b_end]])
        both.sort(kind="stable")
        shared += int((both[1:] == both[:-1]).sum())
        a, b = a_end, b_end
        if shared + min(len(one) - a, len(two) - b) < need:
            return False
    return shared >= need


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[low:high] for low, high in zip(ends, ends[1:])]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [overlap_reaches(one, two) for one, two in zip(_arrays(batch.column("one")), _arrays(batch.column("two")))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


# --- rows that may have a partner ---


def _ceil(n: str) -> Column:
    return F.expr(f"({THRESHOLD} * {n} + 99) div 100")


def _with_company(rows: DataFrame) -> DataFrame:
    """``id`` of the rows (id, n, block) of which enough of the first columns occur in other rows."""
    entries = rows.select("id", "n", F.explode("block").alias("column"))
    shared = entries.groupBy("column").agg(F.count("*").alias("rows")).where("rows > 1").select("column")
    # A partner may be as small as least(n), whose own block is wide enough for fewer common columns.
    due = F.greatest(F.lit(1), F.expr(f"{WIDER} * (({THRESHOLD} * n + 99) div 100) div 100"))
    met = entries.join(shared, "column").groupBy("id", "n").agg(F.count("*").alias("met"))
    return met.where(F.col("met") >= due).select("id")


def _only(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is among ``wanted`` (a written table)."""
    return rows.join(sent(wanted), column, "left_semi")


# --- the product ---


def _index(sets: DataFrame) -> DataFrame:
    """``node, n, place, column`` of the columns, rare ones first, in which linked rows (node, n, grams) must meet.

    ``place`` counts a row's columns from 1 in that order.
    """
    entries = sets.select("node", "n", F.explode("grams").alias("column"))
    counts = entries.groupBy("column").agg(F.count("*").alias("rows")).where("rows > 1")
    common = (
        entries.join(counts, "column")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("rows", "column"))).alias("common"))
    )
    # Columns that no other row has come first in the order; they are part of the prefix, but nothing meets there.
    alone = F.col("n") - F.size("common")
    take = (F.col("n") - _ceil("n") + 1 - alone).cast("int")
    first = common.withColumns({"take": take, "alone": alone}).where("take > 0")
    placed = first.select("node", "n", "alone", F.posexplode(F.slice("common", 1, F.col("take"))).alias("at", "c"))
    return placed.select("node", "n", (F.col("alone") + F.col("at") + 1).alias("place"), F.col("c.column").alias("column"))


def _sizes_allow(one: str, two: str) -> Column:
    return 100 * F.least(one, two) >= THRESHOLD * F.greatest(one, two)


def _labelled(index: DataFrame, links: DataFrame) -> DataFrame:
    """The index with each row's component, and whether it is ``open``: outside the largest component of its column."""
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    held = index.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = held.groupBy("column", "component").count()
    largest = parts.groupBy("column").agg(
        F.max_by("component", F.struct("count", -F.col("component"))).alias("most"), F.count("*").alias("parts")
    )
    open_ = F.col("component") != F.col("most")
    return stored(held.join(largest.where("parts > 1"), "column").withColumn("open", open_).drop("most", "parts"))


def _against_centres(held: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of rows and their columns' centres; the centre is open itself where a column has been centred before."""
    weighed = held.join(held.groupBy("node").agg(F.count("*").alias("meets")), "node")
    order = F.struct("open", "meets", -F.col("node"))
    centres = weighed.groupBy("column").agg(F.max_by(F.struct("node", "n", "component"), order).alias("c"))
    met = held.join(centres, "column").where(F.col("component") != F.col("c.component")).where(_sizes_allow("n", "c.n"))
    return met.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()


def _rest(held: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs of open rows and rows of other components that may still reach the bound of their sizes.

    Linked rows with the bound ``o`` share a column at most ``n - o + 1`` places into either.
    """
    carried = ["node", "n", "place", "component", "open"]
    one = held.where("open").select("column", *(F.col(c).alias(f"{c}_x") for c in carried))
    two = held.select("column", *(F.col(c).alias(f"{c}_y") for c in carried))
    once = ~F.col("open_y") | (F.col("node_x") < F.col("node_y"))
    apart = F.col("component_x") != F.col("component_y")
    bound = F.expr(f"({THRESHOLD} * (n_x + n_y) + {99 + THRESHOLD}) div {100 + THRESHOLD}")
    early = (F.col("place_x") + bound <= F.col("n_x") + 1) & (F.col("place_y") + bound <= F.col("n_y") + 1)
    met = one.join(two, (one["column"] == two["column"]) & early & apart & once)
    pairs = met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()
    first = index.groupBy("node", "n").agg(F.collect_list("column").alias("columns"))
    sides = [first.select(*(F.col(c).alias(f"{c}_{side}") for c in first.columns)).withColumnRenamed(f"node_{side}", side) for side in "ab"]
    overlap = F.size(F.array_intersect("columns_a", "columns_b"))
    # Past its first columns a row has least(n) - 1 others.
    reach = overlap + _ceil("greatest(n_a, n_b)") - 1
    enough_left = (100 + THRESHOLD) * reach >= THRESHOLD * (F.col("n_a") + F.col("n_b"))
    return pairs.join(sides[0], "a").join(sides[1], "b").where(enough_left).select("a", "b")


def links_between(sets: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect the nodes of ``sets`` (node, n, grams) as all links between them do."""
    spark = sets.sparkSession

    def verified(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("node").alias("a"), F.col("grams").alias("one"))
        two = sets.select(F.col("node").alias("b"), F.col("grams").alias("two"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(_linked, "a bigint, b bigint")

    index = stored(_index(sets))
    links = tried = spark.createDataFrame([], "a bigint, b bigint")
    held = _labelled(index, links)
    for _ in range(ROUNDS):
        pairs = stored(_against_centres(held).join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(pairs)
        links = forest(links.union(verified(pairs)))
        held = _labelled(index, links)
    rest = stored(_rest(held, index).join(tried, ["a", "b"], "left_anti"))
    return links.union(verified(rest))


def ngram_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(texts.mapInArrow(_rows, ROWS).withColumn("id", F.monotonically_increasing_id()))
    able = rows.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    company = stored(_with_company(able))
    held = stored(_only(able, company, "id").select("doc_id", "n", "set_id", "block"))
    classes = held.groupBy("set_id").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc"), F.first("block").alias("block"))
    nodes = stored(classes.withColumn("id", F.monotonically_increasing_id()))
    able_nodes = stored(nodes.join(_with_company(nodes), "id", "left_semi").select("id", "n", "doc", "set_id"))
    wanted = stored(able_nodes.select(F.col("doc").alias("doc_id")).distinct())
    named = able_nodes.select(F.col("id").alias("node"), "n", "set_id")
    sets = stored(_only(texts, wanted, "doc_id").mapInArrow(_sets, SETS).join(named, "set_id").select("node", "n", "grams"))
    if sets.count() > able_nodes.count():  # rows that repeat a doc_id and its text
        sets = stored(sets.dropDuplicates(["node"]))
    links = links_between(sets)
    members = held.select("doc_id", "set_id").join(nodes.select("set_id", F.col("id").alias("node")), "set_id").select("doc_id", "node").distinct()
    # A document in several classes (rows that share its doc_id) ties these together.
    ties = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.collect_set("node").alias("nodes")).where("size(nodes) > 1")
    found = forest(links.union(ties.select(F.explode("nodes").alias("a"), "b")))
    placed = members.join(found.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left")
    placed = stored(placed.select("doc_id", F.coalesce("root", "node").alias("root")))
    first = placed.groupBy("root").agg(F.min("doc_id").alias("component"))
    of_doc = placed.join(first, "root").groupBy("doc_id").agg(F.min("component").alias("component"))
    out = rows.select("doc_id", "n").join(of_doc, "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))

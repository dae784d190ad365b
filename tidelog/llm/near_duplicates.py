"""MinHash near-duplicates: universal hash minima, banding, signature check, full-set check, star components.

A document's set holds its distinct runs of five words (A-Z lowered; the whole text if shorter). Documents with equal
sets are one class before anything is compared, so groups of exact copies of any size cost one entry a band. Classes
are linked when their sets overlap by ``THRESHOLD`` per cent or more, checked on full sets.

Candidates come from bands of ``ROWS`` minima. Two sets at similarity 0.75 miss all ``BANDS`` bands with probability
(1 - 0.75**4)**48, about 1e-8. A bucket of a band never yields all of its pairs: every member is compared with a centre,
the member that meets most others, for ``STARS`` rounds; members that are by then in one component need no further
comparison, and a centre leaves its bucket. Only pairs of different components that are then left in a bucket are not yet
compared. These are all compared, whatever their number, unless profiles of what a set shares with other ones rule the
pair out.

Most buckets of two to ``FEW`` members come by chance, and their number grows with the square of the input. All pairs of such
buckets are compared by signature first; only documents that agree with another one there, or are in a larger bucket, go on.
Sets are built and moved for these alone.

Nulls and repeats: a null or wordless text has an empty set and is linked with nothing. Rows without doc_id are linked
with nothing, have no component and are kept. Rows that share a doc_id are one document with the links of all its texts;
``deduplicate`` keeps one of them. Empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WordHashes, fresh_name, gram_hashes, raw_texts, sent, signed, small_batches, stored
from tidelog.llm.components import forest

SHINGLE = 5
THRESHOLD = 75
BANDS, ROWS = 48, 4
STARS = 2
#: Members of a bucket of which all pairs are compared by signature before anything else.
FEW = 4
#: A pair whose signatures agree in fewer of the 192 places than this is no candidate: 5.5 standard errors below 0.75.
LEAST_AGREEMENT = int(0.75 * BANDS * ROWS - 5.5 * (BANDS * ROWS * 0.75 * 0.25) ** 0.5)
#: Tables of up to so many pairs or documents (a few numbers a row) are broadcast to the rows that they are joined with.
SENT_PAIRS = 200_000
#: Most sets that a rare shingle is in.
RARE = 16
#: Shingles hashed at once; bounds the memory of one long document.
BLOCK = 2048

_random = np.random.default_rng(10)
MULTIPLY = _random.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
del _random

SIGNED = "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>, signature binary"


def shingle_set(words: list[bytes], memo: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of lower-cased words."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(memo.of(words), min(SHINGLE, len(words))))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minima of multiply-shift hashes, one for each member of the family."""
    least = np.full(len(ADD), 2**32 - 1, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        block = shingles[at : at + BLOCK]
        hashed = np.multiply.outer(MULTIPLY, block)
        hashed += ADD[:, None]
        hashed >>= np.uint64(32)
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    band_no = np.arange(BANDS, dtype=np.uint64)
    for batch in small_batches(batches, "text"):
        counts, ids, bands, signatures = [], [], [], []
        for text in raw_texts(batch):
            shingles = shingle_set(text.lower().split(), memo)
            counts.append(len(shingles))
            if not len(shingles):
                ids.append(None), bands.append(None), signatures.append(None)
                continue
            least = minima(shingles)
            keys = band_no
            for row in least.reshape(BANDS, ROWS).T:
                keys = keys * np.uint64(0x9E3779B97F4A7C15) + row
                keys = keys ^ (keys >> np.uint64(29))
            ids.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            bands.append(signed(keys))
            signatures.append(least.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_id", "bands", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for batch in small_batches(batches, "text", 4 << 20):
        sets = [shingle_set(text.lower().split(), memo) for text in raw_texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
            ["doc_id", "size", "set"],
        )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("one", "two"))
        same = (one == two).reshape(batch.num_rows, -1).sum(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(same >= LEAST_AGREEMENT))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
            one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            small, large = (one, two) if len(one) <= len(two) else (two, one)
            shared = 0
            if 100 * len(small) >= THRESHOLD * len(large):
                at = np.searchsorted(large, small)
                shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            keep.append(100 * shared >= THRESHOLD * (len(one) + len(two) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _few(rows: DataFrame) -> bool:
    return rows.count() <= SENT_PAIRS


def _sent(rows: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``SENT_PAIRS`` rows; a larger one is joined by Spark's choice."""
    return F.broadcast(rows) if _few(rows) else rows


def _with_both(pairs: DataFrame, values: DataFrame, column: str, few: bool) -> DataFrame:
    """Written ``pairs`` with the values of both documents.

    A ``few`` pairs go to the values, so that one join is made where the first value is, and only the pairs' values are moved.
    Signatures, all of one size, then meet by the pair; a set is moved once for all pairs that it is the second of.
    """
    one = values.select(F.col("doc_id").alias("a"), F.col(column).alias("one"))
    two = values.select(F.col("doc_id").alias("b"), F.col(column).alias("two"))
    if few:
        pairs = F.broadcast(pairs)
        if column == "signature":
            return one.join(pairs, "a").join(two.join(pairs, "b"), ["a", "b"]).select("a", "b", "one", "two")
        two = two.join(pairs, "b", "left_semi")
    return one.join(pairs, "a").join(two, "b").select("a", "b", "one", "two")


def _ends(pairs: DataFrame, name: str) -> DataFrame:
    return pairs.select(F.col("a").alias(name)).union(pairs.select(F.col("b").alias(name)))


def _pairs(entries: DataFrame, left: str, right: str) -> DataFrame:
    return entries.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def _labels(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket entries with the component of their document, from the links of a forest."""
    found = _sent(links).select(F.col("a").alias("doc"), F.col("b").alias("component"))
    return entries.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "set"):
        sets = [np.frombuffer(x, np.int64) for x in batch.column("set").to_pylist()]
        docs = np.repeat(batch.column("doc_id").to_numpy(), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(np.concatenate(sets))], ["doc", "shingle"])


def _profiles(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """``doc, size, common, rare, m0..m3`` of the sets of ``entries``; see ``_possible``.

    Shingles that no other set has are left out; those that up to ``RARE`` sets have are marked in 256 bits. Ids with
    several texts get no profile, which rules nothing out.
    """
    own = sets.join(sent(stored(entries.select(F.col("doc").alias("doc_id")).distinct())), "doc_id", "left_semi")
    sizes = own.groupBy(F.col("doc_id").alias("doc")).agg(F.count("*").alias("texts"), F.max("size").alias("size"))
    spread = stored(own.mapInArrow(_spread, "doc bigint, shingle bigint"))
    held = spread.join(spread.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "shingle")
    rare = F.col("n") <= RARE
    marks = [
        F.expr(f"bit_or(IF(n <= {RARE} AND (shingle & 3) = {k}, shiftleft(1L, CAST(shiftright(shingle, 2) & 63 AS INT)), 0L))").alias(f"m{k}")
        for k in range(4)
    ]
    counts = held.groupBy("doc").agg(F.count_if(~rare).alias("common"), F.count_if(rare).alias("rare"), *marks)
    return stored(sizes.where("texts = 1").drop("texts").join(counts, "doc", "left").fillna(0))


def _possible() -> Column:
    """Whether two profiles (``_x``, ``_y``) may belong to sets at the threshold.

    They share at most the fewer common shingles, and at most as many rare ones as marks agree, besides those that fell
    on a mark that was already set.
    """
    bits = {side: sum((F.bit_count(f"m{k}_{side}") for k in range(1, 4)), F.bit_count(f"m0_{side}")) for side in "xy"}
    agree = sum((F.bit_count(F.col(f"m{k}_x").bitwiseAND(F.col(f"m{k}_y"))) for k in range(1, 4)), F.bit_count(F.col("m0_x").bitwiseAND(F.col("m0_y"))))
    rare = F.least("rare_x", "rare_y", agree + F.least(F.col("rare_x") - bits["x"], F.col("rare_y") - bits["y"]))
    shared = F.least("common_x", "common_y") + rare
    return F.coalesce(100 * shared >= THRESHOLD * (F.col("size_x") + F.col("size_y") - shared), F.lit(True))


def _buckets(dealt: DataFrame) -> DataFrame:
    """``key, doc, n``: members of the buckets of ``dealt`` (doc, key) that hold several, with their number."""
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(dealt.join(shared, "key").select("key", "doc", "n"))
    members = met.groupBy("key", "n").agg(F.min("doc").alias("least"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("who"))
    # Buckets with the same members, as most pairs have in many bands, count once.
    once = members.groupBy("n", "least", "who").agg(F.min("key").alias("key")).select("key")
    return stored(met.join(once, "key", "left_semi").distinct())


def _promising(entries: DataFrame, signatures: DataFrame) -> DataFrame:
    """``entries`` of large buckets, and of the documents that agree with another one in a bucket of ``FEW`` at most."""
    few = entries.where(F.col("n") <= FEW).groupBy("key").agg(F.collect_set("doc").alias("docs"))
    pairs = stored(few.select(F.explode("docs").alias("a"), "docs").select("a", F.explode("docs").alias("b")).where("a < b").distinct())
    near = stored(_with_both(pairs, signatures, "signature", _few(pairs)).mapInArrow(_agreeing, "a bigint, b bigint"))
    agreeing = _ends(near, "doc")
    agreeing = F.broadcast(agreeing) if _few(near) else agreeing.distinct()
    return stored(entries.where(F.col("n") > FEW).union(entries.where(F.col("n") <= FEW).join(agreeing, "doc", "left_semi").select(entries.columns)))


def links_between_classes(signed_docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` (each the smallest doc_id of its class) that connect what near-duplicate classes of ``signed_docs`` connect.

    Those of the star rounds lead to the smallest member of a component; the rest are pairs as they were compared.
    """
    spark = texts.sparkSession
    reps = stored(
        signed_docs.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    )
    dealt = reps.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("key"))
    entries = _buckets(dealt)
    met = entries.select(F.col("doc").alias("doc_id")).distinct()
    signatures = stored(reps.select("doc_id", "signature").join(met, "doc_id", "left_semi"))
    entries = _promising(entries, signatures)
    involved = stored(entries.groupBy("doc").agg(F.sum("n").alias("meets")))
    sets = stored(texts.join(_sent(involved).select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_sets, "doc_id bigint, size bigint, set binary"))

    def verified(pairs: DataFrame) -> DataFrame:
        near = stored(_with_both(pairs, signatures, "signature", _few(pairs)).mapInArrow(_agreeing, "a bigint, b bigint"))
        few = _few(near)
        own = sets if few else sets.join(sent(stored(_ends(near, "doc_id").distinct())), "doc_id", "left_semi")
        return stored(_with_both(near, own, "set", few).mapInArrow(_linked, "a bigint, b bigint"))

    weighed = stored(entries.join(_sent(involved), "doc"))
    links = spark.createDataFrame([], "a bigint, b bigint")
    tried = spark.createDataFrame([], "a bigint, b bigint")
    labelled = weighed.withColumn("component", F.col("doc"))
    for _ in range(STARS):
        # Only members outside the largest component of a bucket still need a comparison; each later centre is one of them.
        centres = labelled.groupBy("key").agg(
            F.max_by(F.struct("doc", "component"), F.struct("open", "meets", -F.col("doc"))).alias("centre")
            if "open" in labelled.columns
            else F.max_by(F.struct("doc", "component"), F.struct("meets", -F.col("doc"))).alias("centre")
        )
        starred = stored(labelled.join(centres, "key"))
        apart = starred.where("component <> centre.component").select("doc", F.col("centre.doc").alias("centre"))
        pairs = stored(_pairs(apart, "doc", "centre").join(_sent(tried), ["a", "b"], "left_anti"))
        tried = tried.union(pairs)
        links = forest(links.union(verified(pairs)))
        # A pair with the centre has been compared or needs no comparison, so the centre leaves its bucket.
        weighed = starred.where("doc <> centre.doc").select(*weighed.columns)
        labelled = _labels(weighed, links)
        largest = labelled.groupBy("key", "component").count().groupBy("key").agg(
            F.max_by("component", F.struct("count", -F.col("component"))).alias("most"), F.count("*").alias("parts")
        )
        labelled = stored(
            labelled.join(largest.where("parts > 1"), "key").withColumn("open", F.col("component") != F.col("most")).drop("most", "parts")
        )
    # What is left: an open member against every member of another component that it may still be near.
    # A pair counts in the first bucket that both are in; a document is in at most one bucket a band.
    buckets = labelled.groupBy("doc").agg(F.collect_set("key").alias("buckets"))
    labelled = labelled.join(_sent(_profiles(labelled, sets)), "doc", "left").join(buckets, "doc")
    carried = ["doc", "component", "size", "common", "rare", "m0", "m1", "m2", "m3", "buckets"]
    one = labelled.where("open").select("key", *[F.col(c).alias(f"{c}_x") for c in carried])
    two = labelled.select("key", *[F.col(c).alias(f"{c}_y") for c in carried])
    first = F.array_min(F.array_intersect("buckets_x", "buckets_y")) == one.key
    met = one.join(two, (one.key == two.key) & (F.col("component_x") != F.col("component_y")) & _possible() & first)
    rest = _pairs(met, "doc_x", "doc_y").join(_sent(tried), ["a", "b"], "left_anti")
    return links.union(verified(stored(rest)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed_docs = stored(texts.mapInArrow(_signatures, SIGNED))
    links = links_between_classes(signed_docs, texts)
    classes = signed_docs.where("set_id IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "set_id")
    least = classes.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    # Documents in several classes (rows that share a doc_id) tie these together.
    repeated = classes.groupBy("doc_id").agg(F.min("set_id").alias("one"), F.max("set_id").alias("other"))
    repeated = stored(repeated.where("one <> other").select("doc_id"))
    if not repeated.isEmpty():
        ties = classes.join(_sent(repeated), "doc_id").join(least, "set_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        links = links.union(ties)
    found = _sent(forest(links)).select(F.col("a").alias("rep"), F.col("b").alias("component"))
    named = least.join(found, "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component"))
    out = signed_docs.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less every document that is not the smallest doc_id of its component.

    Of rows that share a doc_id one stays (smallest text first); those are gathered only where an id repeats.
    """
    found = stored(near_duplicates(docs).where("doc_id IS NOT NULL"))
    gone, repeated, place = fresh_name("gone"), fresh_name("repeated"), fresh_name("place")
    dropped = stored(found.where("NOT kept").select(F.col("doc_id").alias(gone)).distinct())
    again = stored(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(repeated)))
    kept = docs.join(sent(dropped), F.col("doc_id").cast("bigint") == F.col(gone), "left_anti")
    if again.isEmpty():
        return kept
    # Rows as text, as columns of some kinds have no order.
    one = Window.partitionBy("doc_id").orderBy("text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    same = F.col("doc_id").cast("bigint") == F.col(repeated)
    single = kept.join(again, same, "left_anti")
    first = kept.join(again, same, "left_semi").withColumn(place, F.row_number().over(one))
    return single.unionByName(first.where(F.col(place) == 1).drop(place))

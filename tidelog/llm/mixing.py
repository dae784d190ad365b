"""Mixing to target weights: soft domain membership, then document rates by projected-gradient least squares.

Domains are what the labelled table tells apart (``DOMAINS``). A naive-Bayes model over the presence of hashed words that
tell the domains apart (by a chi-squared test), fitted on labelled documents, gives every document posteriors p[d],
tempered on held-out labels so that they are not surer than they should be. Rates r >= 0 are then fitted so that the expected tokens of each domain, sum of r * tokens * p[d], meet the
targets in the least-squares sense (each domain's error relative to its target). The gradient of a document's rate
depends on its posteriors and on one number per domain. Posteriors are rounded to ``PLACES`` places, and documents with
the same posteriors have the same rate, so the fit runs over one row per distinct posterior vector with its documents'
tokens, pre-aggregated once. Each step is one combined aggregate over these, and the step's few numbers are all that
the driver sees. A document's rate is folded from the steps' numbers when it is needed.

Starting from rates of 1, documents of a domain that is short are repeated and those of one in excess thinned; only
documents that lie in an excess domain almost for sure can fall to 0. ``copies`` rounds a rate up or down by a hash of
the id, so that expected tokens are kept. ``mix`` applies it: documents with no copy leave the table, the others stay
as one row each, with ``copies`` to say how often the document is to be read.

Targets are given, or follow from the table (``thinned_targets``): the mix in which a document counts the less, the
likelier it is in a domain that is to go. They lie where rates can meet them, however much of that domain there is.

Fitting takes at most ``FIT_ROWS`` labelled documents, those with the smallest hashes (a documented bound); token
counts, posteriors and the fit of the rates take all documents. Only DataFrame functions are used.

Nulls and repeats: a null text has no tokens, prior posteriors and a rate like any other; each row gives one row;
repeated label rows of a document count once (largest label); null labels are not learned from. Without labels all
domains are equally likely. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import let, smallest_hashes, stored

#: Domain and its share of all tokens in the mix.
DOMAINS = {"good": 0.90, "poor": 0.06, "toxic": 0.04}
FIT_ROWS = 20_000
BUCKETS = 1 << 16
#: Buckets to a word of bits: 1 << 6.
WORD = 64
SMOOTHING = 0.5
#: Chi-squared value from which a word bucket counts, and labelled documents it must be in.
TELLING, LEAST_SEEN = 25.0, 5
STEPS = 40
#: Decimal places of a posterior.
PLACES = 3
#: Steps after which the rates so far are written, so that a step folds a few others and not all before it.
FOLD = 6
#: Relative error of all domains, or a tenth of it as their change, at which the fit ends early.
CLOSE = 1e-4
#: Errors of domains with smaller targets count relative to this.
LEAST_SHARE = 0.02
TEMPERATURES = [2.0**k for k in range(-6, 3)]
#: Posterior of a thinned domain from which a document is to go whole.
GONE = 0.5

_NAMES = list(DOMAINS)


def _buckets(text: Column) -> Column:
    """Hash buckets of the lower-cased words and of the symbols that words end in."""
    words = F.split(F.regexp_replace(F.lower(text), "([#*$%&|<>!.,]+)", " $1 "), "[\\x20\\x09-\\x0D]+")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")


def _constant(values: list, kind: str = "double") -> Column:
    """A constant array; written as text, so that the plan holds one literal and not thousands."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _ranks(place: list[int]) -> tuple[list[int], list[int]]:
    """A bit for each bucket that has a row, in signed words of ``WORD``, and the number of rows before each word."""
    bits, before, rows = [], [], 0
    for at in range(0, BUCKETS, WORD):
        word = sum(1 << k for k, row in enumerate(place[at : at + WORD]) if row)
        bits.append(word - (1 << WORD) if word >> (WORD - 1) else word)
        before.append(rows)
        rows += word.bit_count()
    return bits, before


def _evidence(buckets: Column, model: tuple[list[int], list[float]]) -> Column:
    """Summed log-odds of each domain over the distinct telling words of a text: an array in the order of the domains."""
    place, weights = model
    count = len(_NAMES)
    # Rows ascend with buckets, so a bucket's row is its rank among those that have one. A row number for each bucket would
    # make each text of a plan, of which the driver makes several a query, half a megabyte.
    bits, before = _ranks(place)
    in_word = F.transform(
        F.array_distinct(buckets),
        lambda b: F.struct(
            F.shiftright(b, 6).alias("at"),
            # The bucket's own bit becomes the sign; those of later buckets leave the word.
            F.call_function("shiftleft", F.get(_constant(bits, "bigint"), F.shiftright(b, 6)), F.lit(WORD - 1) - b % WORD).alias("upto"),
        ),
    )
    telling = F.filter(in_word, lambda w: w["upto"] < 0)
    told = F.transform(telling, lambda w: F.get(_constant(before, "int"), w["at"]) + F.bit_count(w["upto"]))

    start = F.struct(*[F.lit(0.0).alias(f"d{d}") for d in range(count)])

    def summed(table: Column) -> Column:
        def add(total: Column, row: Column) -> Column:
            return F.struct(*[(total[f"d{d}"] + F.element_at(table, (row - 1) * count + d + 1)).alias(f"d{d}") for d in range(count)])

        return F.aggregate(told, start, add, lambda t: F.array(*[t[f"d{d}"] for d in range(count)]))

    # Named once, so that the plan and its texts hold the weights once.
    return let(_constant(weights or [0.0]), summed)


def _softmax(values: list[Column]) -> list[Column]:
    top = F.greatest(*values)
    powers = [F.exp(v - top) for v in values]
    total = sum(powers[1:], powers[0])
    return [p / total for p in powers]


class Membership:
    """Posteriors of the domains: word weights, priors and a temperature."""

    def __init__(self, weights: tuple[list[int], list[float]], priors: list[float], temperature: float):
        self.weights, self.priors, self.temperature = weights, priors, temperature

    def posteriors(self, means: str | Column) -> list[Column]:
        return [F.round(p, PLACES).alias(f"p_{name}") for name, p in zip(_NAMES, self.of(means))]

    def of(self, means: str | Column) -> list[Column]:
        return _softmax([self.temperature * F.get(means, F.lit(d)) + math.log(p) for d, p in enumerate(self.priors)])


def _telling(counts: dict[int, list[int]], sizes: list[int]) -> tuple[list[int], list[float]]:
    """The buckets that tell domains apart: a row number for each bucket (0: none; they ascend), and a row's log-odds by domain."""
    place, weights, total = [0] * BUCKETS, [], sum(sizes)
    for bucket in sorted(counts):
        seen = sum(counts[bucket])
        if seen < LEAST_SEEN:
            continue
        odds, tell = [], 0.0
        for here, size in zip(counts[bucket], sizes):
            there, others = seen - here, total - size
            with_, without = (here + SMOOTHING) / (size + 1), (there + SMOOTHING) / (others + 1)
            odds.append(math.log(with_ / without))
            spread = seen * (total - seen) * size * others
            tell = max(tell, total * (here * (others - there) - there * (size - here)) ** 2 / spread if spread else 0.0)
        if tell >= TELLING:
            weights += odds
            place[bucket] = len(weights) // len(_NAMES)
    return place, weights


def learn(docs: DataFrame, labels: DataFrame) -> Membership:
    """Fit on four fifths of a bounded sample of labelled documents; temper on the rest."""
    named = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    named = named.select("doc_id", _domain().alias("domain"), F.xxhash64("doc_id").alias("hash")).where("doc_id IS NOT NULL AND domain IS NOT NULL")
    sample = stored(smallest_hashes(named, "hash", FIT_ROWS))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # FIT_ROWS rows of two numbers: a size that is known.
    rows = stored(texts.join(F.broadcast(sample), "doc_id").select("domain", "hash", _buckets(F.coalesce("text", F.lit(""))).alias("buckets")))
    train, held = rows.where("pmod(hash, 5) <> 0"), rows.where("pmod(hash, 5) = 0")
    present = train.select("domain", F.explode(F.array_distinct("buckets")).alias("bucket"))
    # At most a row for each bucket and domain, whatever the input.
    counts = present.groupBy("bucket").pivot("domain", _NAMES).count().fillna(0)
    # Buckets that count; the others need not go to the driver.
    counts = counts.where(sum((F.col(name) for name in _NAMES[1:]), F.col(_NAMES[0])) >= LEAST_SEEN).collect()
    sizes = {r.domain: r["count"] for r in train.groupBy("domain").count().collect()}
    weights = _telling({r.bucket: [r[name] for name in _NAMES] for r in counts}, [sizes.get(name, 0) for name in _NAMES])
    known = sum(sizes.values())
    priors = [(sizes.get(name, 0) + 1) / (known + len(_NAMES)) for name in _NAMES]
    scored = held.select("domain", _evidence(F.col("buckets"), weights).alias("means"))
    losses = []
    for t in TEMPERATURES:
        own = Membership(weights, priors, t).of("means")
        right = F.coalesce(*[F.when(F.col("domain") == name, p) for name, p in zip(_NAMES, own)])
        losses.append(F.round(F.sum(-F.log(F.greatest(right, F.lit(1e-12)))), 6))
    loss = list(scored.agg(*losses).first())
    best = min(range(len(TEMPERATURES)), key=lambda k: loss[k]) if loss[0] is not None else 0
    return Membership(weights, priors, TEMPERATURES[best])


def memberships(docs: DataFrame, model: Membership) -> DataFrame:
    """``doc_id, source, n_tokens`` and ``p_<domain>`` of every row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    means = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("bigint").alias("n_tokens"),
        _evidence(_buckets(text), model.weights).alias("means"),
    )
    return means.select("doc_id", "source", "n_tokens", *model.posteriors("means"))


def _rates(steps: list[tuple[list[float], float]], start: Column, posterior: Callable[[str], Column] = F.col) -> Column:
    """The rate (``r``) and its extrapolation (``y``) after the given steps, each a slope per domain and a momentum."""
    if not steps:
        return start
    flat = _constant([x for slopes, momentum in steps for x in (*slopes, momentum)])
    width = len(_NAMES) + 1

    def move(state: Column, at: Column) -> Column:
        slope = sum((F.element_at(flat, at * width + d + 1) * posterior(f"p_{name}") for d, name in enumerate(_NAMES)), F.lit(0.0))
        new = F.greatest(F.lit(0.0), state["y"] - slope)
        return F.struct(new.alias("r"), (new + F.element_at(flat, at * width + width) * (new - state["r"])).alias("y"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), start, move)


def _begin() -> Column:
    return F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))


def rate_after(steps: list[tuple[list[float], float]], posterior: Callable[[str], Column] = F.col) -> Column:
    """The rate of a row after the fitted steps; ``posterior`` gives its ``p_<domain>``."""
    return F.round(_rates(steps, _begin(), posterior)["r"], 6)


def fit_rates(rows: DataFrame, targets: dict[str, float] | None = None) -> tuple[list[tuple[list[float], float]], dict[str, float]]:
    """The steps that lead to the fitted rates of ``rows`` (n_tokens, p_<domain>), and each domain's expected tokens.

    Accelerated projected gradient in the metric of the documents' tokens, in which the step size is at least the
    inverse of the weighted Gram matrix' trace.
    """
    shares = targets or DOMAINS
    posteriors = [f"p_{name}" for name in _NAMES]
    rows = stored(rows.groupBy(*posteriors).agg(F.sum("n_tokens").alias("n_tokens")).withColumn("at", _begin()))
    sums = [F.sum("n_tokens").alias("total")]
    sums += [F.sum(F.col("n_tokens") * F.col(f"p_{name}") ** 2).alias(name) for name in _NAMES]
    first = rows.agg(*sums).first()
    if not first.total:
        return [], {name: 0.0 for name in _NAMES}
    goal = {name: max(shares[name], 1e-9) for name in _NAMES}
    # Errors count relative to a domain's target, but for targets near 0.
    weight = {name: 1 / max(goal[name], LEAST_SHARE) for name in _NAMES}
    rate_of_step = 1 / sum(weight[name] * first[name] / first.total for name in _NAMES)
    steps: list[tuple[list[float], float]] = []
    fresh: list[tuple[list[float], float]] = []  # not yet in the written rates
    reached: dict[str, float] = {}
    before, t = {}, 1.0
    for _ in range(STEPS):
        moved = rows.select(*posteriors, "n_tokens", _rates(fresh, F.col("at")).alias("at"))
        if len(fresh) == FOLD:
            rows, fresh = stored(moved), []
            moved = rows
        expected = moved.agg(*[F.sum(F.col("at.y") * F.col("n_tokens") * F.col(f"p_{name}")).alias(name) for name in _NAMES]).first()
        # Rounded: sums of doubles differ in their last places between runs.
        reached = {name: round(expected[name] / first.total, 10) for name in _NAMES}
        error = max(abs(reached[name] - goal[name]) * weight[name] for name in _NAMES)
        change = max(abs(reached[name] - before.get(name, 0.0)) * weight[name] for name in _NAMES)
        if error < CLOSE or change < CLOSE / 10:
            break
        before = reached
        following = (1 + math.sqrt(1 + 4 * t * t)) / 2
        slopes = [rate_of_step * weight[name] * (reached[name] - goal[name]) for name in _NAMES]
        steps.append((slopes, (t - 1) / following))
        fresh.append(steps[-1])
        t = following
    return steps, {name: reached[name] * first.total for name in _NAMES}


def thinned_targets(rows: DataFrame, domain: str) -> dict[str, float] | None:
    """Target shares that thin out one domain of ``rows`` (n_tokens, p_<domain>), from their own expected tokens.

    A document's rate falls in proportion to its posterior of ``domain``, from 1 to 0 at ``GONE``; the other domains
    together keep the tokens they have. ``None`` if no row has tokens.
    """
    n, gone = F.col("n_tokens"), F.col(f"p_{domain}")
    rate = F.greatest(F.lit(0.0), 1 - gone / GONE)
    sums = [F.sum(n).alias("total"), F.sum(n * (1 - gone)).alias("others"), F.sum(n * (1 - gone) * rate).alias("left")]
    sums += [F.sum(n * F.col(f"p_{name}") * rate).alias(name) for name in _NAMES]
    found = rows.agg(*sums).first()
    if not found.total:
        return None
    grown = found.others / found.left if found.left else 1.0
    return {name: round(grown * found[name] / found.total, 10) for name in _NAMES}


def _copies(rate: Column, key: Column) -> Column:
    """How often to read a row: its rate, with the fraction settled by a hash of its key."""
    place = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (F.floor(rate) + (place < rate - F.floor(rate)).cast("int")).cast("bigint")


def document_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, thinned: str | None = None) -> DataFrame:
    """``doc_id, source, n_tokens, p_<domain>, rate, copies`` of every row of ``docs``.

    ``thinned`` names a domain to thin out, in place of given targets.
    """
    rows = stored(memberships(docs, learn(docs, labels)))
    steps, _ = fit_rates(rows, thinned_targets(rows, thinned) if thinned else targets)
    rated = rows.withColumn("rate", rate_after(steps))
    return rated.withColumn("copies", _copies(F.col("rate"), F.col("doc_id")))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, thinned: str | None = None) -> DataFrame:
    """The rows of ``docs`` with at least one copy, with ``rate`` and ``copies``, which replace columns of these names.

    Of a repeated doc_id the largest rate counts, and rows without doc_id have the rate 1. A rate is an expression over a row's
    own text, so the texts are rated where they are; only rows that share a doc_id are looked up among these.
    """
    model = learn(docs, labels)
    rows = stored(memberships(docs, model))
    steps, _ = fit_rates(rows, thinned_targets(rows, thinned) if thinned else targets)
    # All columns of the caller in one, so that none is mistaken for a column of ours.
    kept = [c for c in docs.columns if c not in ("rate", "copies")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    packed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text, F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    again = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.max(rate_after(steps)).alias("best"))
    again = stored(again.where("n > 1").select("doc_id", "best"))
    packed = packed.withColumn("best", F.lit(None).cast("double")) if again.isEmpty() else packed.join(again, "doc_id", "left")

    def decided(p: Column) -> Column:
        return let(F.coalesce("best", rate_after(steps, lambda name: p[name])), lambda rate: F.struct(rate.alias("rate"), _copies(rate, F.col("doc_id")).alias("copies")))

    own = let(_evidence(_buckets(F.col("text")), model.weights), lambda means: let(F.struct(*model.posteriors(means)), decided))
    nameless = F.struct(F.lit(1.0).alias("rate"), F.lit(1).cast("bigint").alias("copies"))
    # One row or none for each, made in one step: a filter would work out every text's rate twice.
    mixed = F.filter(F.array(F.when(F.col("doc_id").isNull(), nameless).otherwise(own)), lambda m: m["copies"] > 0)
    return packed.select("row", F.explode(mixed).alias("mixed")).select("row.*", "mixed.rate", "mixed.copies")

"""Quality rules: counts per text, fixed limits, and robust multivariate outliers per language and source.

The verdict is a minimum-covariance-determinant (MCD) estimate for every group of language and source. From each of the
``STARTS``, concentration steps fit centre and covariance of the ``SUBSET`` share of documents that lie nearest, until no
estimate changes; of a group's estimates the one with the smallest determinant counts. Documents farther than the
``CUTOFF`` from the group's centre, by Mahalanobis distance, are rejected. Groups whose subset has fewer than
``LEAST_GROUP`` documents, and those of null language or source, are judged by the estimate over all documents.

The nearest share is taken in whole classes of distance (``CLASSES`` for each factor of two), so a subset may be larger
than the share by its last class; determinants are compared as they are. Sums are exact, so a subset that stays the same
gives the very same estimate, and the steps of a group end there. Steps over classes can also come back to an earlier
subset, and would go round from there; they end as soon as an estimate comes back, as the smallest determinant that a
start has reached is kept all along. ``MOST_STEPS`` bounds paths that do neither.

Only DataFrame functions: the words of a text stay in its row, statistics are whole numbers (so that sums do not depend
on the order of rows), each group's estimate is a row of combined sums, and the share nearest to a centre is found from
sums per distance class, in one pass a step. The steps run over distinct statistic vectors with their numbers of
documents, counted once, so repeated texts cost nothing there. No step sorts, shuffles or gathers a group, whatever its size.

Nulls and repeats: a null text is empty and fails the base rules; language and source may be null; each row gives one
row. Ties share a distance and a verdict. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import fresh_name, sent, stored

#: ``[^\\x20\\x09-\\x0D]+`` words lie between these.
SPACES = "[\\x20\\x09-\\x0D]+"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Share of a group that is taken as clean; the rest may be arbitrarily bad.
SUBSET = 0.75
#: Where concentration begins: median and spread without correlation; the moments of documents within ``FENCE`` spreads
#: of the median in every statistic; the moments of all documents.
STARTS = ("median", "fenced", "all")
FENCE = 3.0
#: Steps after which estimates that still change are taken as they are.
MOST_STEPS = 40
LEAST_GROUP = 50
#: Squared Mahalanobis distance beyond which a document is rejected. Far past the 0.9999 quantile of the chi-squared
#: distribution with four degrees of freedom (23.5): most clean texts have no symbols and no repeats at all, so the
#: spread is close to its floor (``RIDGE``) there, and one repeated line in a short text already lies at about 200.
CUTOFF = 280.0
#: Estimates of up to so many groups (rows of about 150 bytes) are broadcast; more are joined by Spark's choice.
BROADCAST_GROUPS = 50_000
#: Fixed-point places of the transformed statistics.
SCALE = 1024
#: Variance added to each diagonal element, in squared units of the statistics: constant columns stay invertible.
RIDGE = (0.05, 0.02, 0.02, 0.02)
DIMENSIONS = ("s_length", "s_symbols", "s_lines", "s_repeats")
#: Pairs of dimensions of the covariance's lower triangle.
PAIRS = [(i, j) for i in range(len(DIMENSIONS)) for j in range(i + 1)]
#: Distance classes per factor of two, for the quantile of the distances.
CLASSES = 32


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; a plain column would be computed for every element again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside runs of eight words that occur twice or more in the text.

    The runs' hashes are sorted with their places, so equal ones are neighbours; the covered words are then counted
    from the sorted places. All of it stays in the row and takes n log n steps.
    """
    count = F.size(words)
    starts = F.sequence(F.lit(1), count - (REPEAT_WINDOW - 1))
    runs = F.array_sort(F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(words, i, REPEAT_WINDOW)).alias("h"), i.alias("i"))))

    def repeated(sorted_runs: Column) -> Column:
        last = F.size(sorted_runs) - 1
        marked = F.filter(
            sorted_runs,
            lambda run, at: ((at > 0) & (F.get(sorted_runs, at - 1)["h"] == run["h"]))
            | ((at < last) & (F.get(sorted_runs, at + 1)["h"] == run["h"])),
        )
        return F.array_sort(F.transform(marked, lambda run: run["i"]))

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("at")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(REPEAT_WINDOW), i - a["at"])).alias("n"), i.alias("at")),
            lambda a: a["n"].cast("bigint"),
        )

    found = _let(runs, lambda r: _let(repeated(r), covered))
    return F.when(count >= REPEAT_WINDOW, found).otherwise(F.lit(0).cast("bigint"))


def _repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return _let(lines, lambda kept: (F.size(kept) - F.size(F.array_distinct(kept))).cast("bigint"))


def statistics(docs: DataFrame) -> DataFrame:
    """The base counts of every row, with its language, source and base verdict."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.length(F.regexp_replace(text, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        _repeated_lines(text).alias("n_dup_lines"),
        _let(
            F.array_remove(F.split(text, SPACES), ""),
            lambda words: F.struct(F.size(words).cast("bigint").alias("n"), _repeated_words(words).alias("repeated")),
        ).alias("words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select(
        "doc_id",
        "lang",
        "source",
        F.col("words.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("words.repeated").alias("n_repeat_words"),
    ).withColumn("base_failed", failed)


def transformed(stats: DataFrame) -> DataFrame:
    """Statistic vectors in fixed point: mean word length, and roots of the shares of symbols, lines and repeats.

    All are shares of the text, so that a long document is no outlier for its length.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))

    def fixed(value: Column) -> Column:
        return F.round(value * SCALE).cast("bigint")

    return stats.select(
        "*",
        fixed(4 * F.log(1 + F.col("word_chars") / words)).alias("s_length"),
        fixed(4 * F.sqrt(F.col("n_symbols") / words)).alias("s_symbols"),
        fixed(4 * F.sqrt(F.col("n_dup_lines") / words)).alias("s_lines"),
        fixed(4 * F.sqrt(F.col("n_repeat_words") / words)).alias("s_repeats"),
    )


def _moments(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and covariance of each group from the exact sums of its classes (see ``_sums``)."""
    total = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums.columns if c not in (*keys, "class")])
    mean = {i: F.col(f"t{i}").cast("double") / F.col("n") for i in range(len(DIMENSIONS))}
    out = [F.col(k) for k in keys] + [F.col("n")] + [mean[i].alias(f"m{i}") for i in mean]
    for i, j in PAIRS:
        ridge = RIDGE[i] * SCALE * SCALE if i == j else 0.0
        out.append((F.col(f"t{i}{j}").cast("double") / F.col("n") - mean[i] * mean[j] + ridge).alias(f"c{i}{j}"))
    return total.select(*out)


def _factor(moments: DataFrame) -> DataFrame:
    """The covariance's Cholesky factor as columns ``l<row><column>``."""
    for i in range(len(DIMENSIONS)):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}")
            moments = moments.withColumn(f"l{i}{j}", value)
    return moments


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from its group's centre, by forward substitution."""
    solved: list[Column] = []
    for i, dimension in enumerate(DIMENSIONS):
        rest = F.col(dimension) - F.col(f"m{i}")
        for k, value in enumerate(solved):
            rest = rest - F.col(f"l{i}{k}") * value
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in solved[1:]), solved[0] * solved[0])


def _sums(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Count ``n`` and exact sums of the statistics and their products for each of ``keys``, over weighted vectors."""
    weight = F.col("weight").cast("decimal(38,0)")
    sums = [F.sum("weight").alias("n")]
    sums += [F.sum((F.col(d) * F.col("weight")).cast("decimal(38,0)")).alias(f"t{i}") for i, d in enumerate(DIMENSIONS)]
    sums += [F.sum(((F.col(DIMENSIONS[i]) * F.col(DIMENSIONS[j])).cast("decimal(38,0)") * weight).cast("decimal(38,0)")).alias(f"t{i}{j}") for i, j in PAIRS]
    return vectors.groupBy(*keys).agg(*sums)


def _nearest(sums: DataFrame, keys: list[str]) -> DataFrame:
    """The classes of each group that hold its nearest share of documents, up to the class with the last of them.

    A group has a bounded number of classes, whatever its size.
    """
    within = Window.partitionBy(*keys)
    upto = within.orderBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = sums.withColumn("before", F.sum("n").over(upto) - F.col("n")).withColumn("total", F.sum("n").over(within))
    return reached.where(F.col("before") < SUBSET * F.col("total")).drop("before", "total")


def _distance_class(distance: Column) -> Column:
    return F.floor(CLASSES * F.log2(1e-6 + distance)).cast("bigint")


def _sent(estimate: DataFrame) -> DataFrame:
    """A written table of estimates, marked for broadcast if it has few groups: rows are then not dealt by group."""
    return F.broadcast(estimate) if estimate.count() <= BROADCAST_GROUPS else estimate


def _spreads(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each group's median and spread (from its quartiles) as an estimate without correlation."""
    quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    first = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.percentile_approx(d, quartiles, 1000).alias(f"q{i}") for i, d in enumerate(DIMENSIONS)]
    )
    columns = [F.col(k) for k in keys] + [F.col("n")]
    columns += [F.get(f"q{i}", F.lit(1)).cast("double").alias(f"m{i}") for i in range(len(DIMENSIONS))]
    for i, j in PAIRS:
        spread = (F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349
        columns.append((spread * spread + RIDGE[i] * SCALE * SCALE if i == j else F.lit(0.0)).alias(f"c{i}{j}"))
    return first.select(*columns)


def _fenced() -> Column:
    """Whether a vector lies within the fence around its group's median (``m``, ``l`` of ``_spreads``)."""
    inside = F.lit(True)
    for i, dimension in enumerate(DIMENSIONS):
        inside = inside & (F.abs(F.col(dimension) - F.col(f"m{i}")) <= FENCE * F.col(f"l{i}{i}"))
    return inside


def _log_determinant() -> Column:
    """Logarithm of the covariance's determinant, from its factor; rounded, so that equal estimates tie."""
    return F.round(2 * sum((F.log(f"l{i}{i}") for i in range(1, len(DIMENSIONS))), F.log("l00")), 9)


def estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The MCD estimate of each group of ``rows``: its size ``n`` (of the subset), centre and factor in one row."""
    vectors = stored(rows.groupBy(*keys, *DIMENSIONS).agg(F.count("*").alias("weight")))
    by_start = [*keys, "start"]
    spreads = stored(_factor(_spreads(rows, keys)))
    fenced = vectors.join(_sent(spreads.drop("n")), keys).where(_fenced()).select(*vectors.columns)
    begun = {"fenced": _moments(_sums(fenced, keys), keys), "all": _moments(_sums(vectors, keys), keys)}
    current = spreads.withColumn("start", F.lit("median"))
    for start in STARTS[1:]:
        current = current.unionByName(_factor(begun[start]).withColumn("start", F.lit(start)))
    fitted = [c for c in spreads.columns if c not in keys]
    fit = F.struct(_log_determinant().alias("d"), "start", *fitted)
    # Centre and covariance tell estimates apart; ``path`` holds those that a start has come through.
    place = [c for c in fitted if c[0] in "mc"]
    unfitted = F.lit(None).cast(current.select(fit.alias("f")).schema["f"].dataType).alias("fit")
    current = stored(current.select("*", unfitted, F.array(F.struct(*place)).alias("path"), F.lit(True).alias("open")))
    for _ in range(MOST_STEPS):
        # Groups whose subset stays the same or comes back are done. All there is to a step is one small table: estimates,
        # the best so far, the way there, what is open.
        opened = current.where("open").select(*by_start, *[c for c in fitted if c != "n"])
        groups = opened.count()
        if not groups:
            break
        placed = vectors.join(F.broadcast(opened) if groups <= BROADCAST_GROUPS else opened, keys)
        placed = placed.select(*by_start, *DIMENSIONS, "weight", _distance_class(_distance()).alias("class"))
        moved = _factor(_moments(_nearest(_sums(placed, [*by_start, "class"]), by_start), by_start))
        moved = moved.select(*by_start, F.struct(*fitted).alias("moved"), fit.alias("found"))
        stepped = current.select(*by_start, F.struct(*fitted).alias("before"), "fit", "path", "open").join(moved, by_start, "left")
        after = F.coalesce("moved", "before")
        at = F.struct(*[after[c].alias(c) for c in place])
        fresh = F.col("open") & ~F.array_contains("path", at)
        path = F.when(fresh, F.array_append("path", at)).otherwise(F.col("path"))
        columns = [*[after[c].alias(c) for c in fitted], F.least("fit", "found").alias("fit"), path.alias("path"), fresh.alias("open")]
        current = stored(stepped.select(*by_start, *columns))
    best = current.groupBy(*keys).agg(F.min("fit").alias("fit"))
    return stored(best.select(*keys, *[F.col(f"fit.{c}").alias(c) for c in fitted]))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts, ``base_failed``, ``kept`` and ``distance`` (squared) of every row of ``docs``."""
    rows = stored(transformed(statistics(docs)))
    # Each document counts in its own group and in that of all documents, so one pass fits both.
    own = F.struct(F.col("lang"), F.col("source"))
    groups = F.array(F.when(F.col("lang").isNotNull() & F.col("source").isNotNull(), own), F.struct(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")))
    usable = rows.where("NOT base_failed").select(F.explode(F.array_compact(groups)).alias("g"), *DIMENSIONS)
    name = F.coalesce(F.to_json("g"), F.lit("{}")).alias("name")
    estimate = estimates(usable.select(name, *DIMENSIONS), ["name"])
    fitted = [c for c in estimate.columns if c not in ("name", "n")]
    groups_own = estimate.where((F.col("n") >= LEAST_GROUP) & (F.col("name") != "{}")).drop("n")
    # One row, so a broadcast of fixed size; without usable documents it is empty and nothing is judged by it.
    common = F.broadcast(estimate.where("name = '{}'").select(F.lit("all").alias("everything"), *[F.col(c).alias(f"o_{c}") for c in fitted]))
    named = rows.withColumn("name", F.when(F.col("lang").isNotNull() & F.col("source").isNotNull(), F.to_json(own))).withColumn("everything", F.lit("all"))
    judged_rows = named.join(_sent(groups_own), "name", "left").join(common, "everything", "left")
    judged_rows = judged_rows.select(*rows.columns, *[F.coalesce(c, f"o_{c}").alias(c) for c in fitted])
    out = judged_rows.withColumn("distance", _distance())
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).alias("kept"),
        F.round("distance", 6).alias("distance"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Rows that share a doc_id go if one of them is rejected; rows without
    doc_id are judged by the base rules alone."""
    verdicts = judged(docs.where("doc_id IS NOT NULL"))
    name = fresh_name("rejected")
    rejected = stored(verdicts.where("NOT kept").select(F.col("doc_id").alias(name)).distinct())
    named = docs.where("doc_id IS NOT NULL").join(sent(rejected), F.col("doc_id").cast("bigint") == F.col(name), "left_anti")
    return named.unionByName(docs.where("doc_id IS NULL").where(~_failed()))


def _failed() -> Column:
    """The base verdict of a row as one expression over its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return _let(
        F.array_remove(F.split(text, SPACES), ""),
        lambda words: (F.size(words) < LEAST_WORDS) | (100 * _repeated_words(words) > MOST_REPEATED * F.size(words)),
    )


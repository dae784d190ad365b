"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams that every match must contain: alternatives are ORed
clauses, a clause is a set of trigrams that must all occur. The index holds postings (trigram, document) for the
trigrams that the rules' queries name, upper and lower case being one. Intersecting postings (a clause's trigrams
counted per document) gives the candidates of each rule, and only these are searched with the rule's expression. A rule
with a clause without trigrams, such as runs of hex digits, scans all texts.

Only DataFrame functions. The rules are fixed, so the table of clauses has a fixed size. Postings are grouped by
document, so a frequent trigram gathers nowhere. Texts are shuffled once, to meet their candidate rules.

Nulls and repeats: a null text is empty; each row gives one row; rows that share a doc_id share their candidate rules,
which changes no result; rows without doc_id are searched with every rule. Empty tables give empty results; other
columns are not read. Spans are in code points, end exclusive; spans of different kinds may overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


@dataclass(frozen=True)
class Rule:
    """``pattern`` is valid for Java and Python; a match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: Base rules first; the order of kinds is the order of the list.
RULES = (
    Rule(
        "assign",
        "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]+", 0, 16),
    Rule("private_key", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("git_host", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("signed_token", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{5,}"),
    Rule("live_key", "[rs]k_live_[A-Za-z0-9]{16,}"),
)
BASE = ("assign", "access", "hex")
KINDS = tuple(rule.kind for rule in RULES)

#: Most strings that a part of an expression is spelled out to; beyond, the part adds no trigram.
MOST_STRINGS = 24


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _spelled(parts: Iterable) -> set[str] | None:
    """All strings that a parsed expression matches, in lower case, if these are few."""
    done = {""}
    for part in parts:
        more = _spelled_part(*part)
        done = {a + b for a in done for b in more} if more is not None else None
        if done is None or len(done) > MOST_STRINGS:
            return None
    return done


def _spelled_part(op, value) -> set[str] | None:
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
        return {chr(v).lower() for _, v in value}
    if name == "SUBPATTERN":
        return _spelled(value[3])
    if name == "BRANCH":
        options = [_spelled(option) for option in value[1]]
        return None if None in options else set().union(*options)
    if name == "MAX_REPEAT" and value[1] <= 2:
        once = _spelled(value[2])
        if once is None:
            return None
        out, power = set(), {""}
        for times in range(value[1] + 1):
            out |= power if times >= value[0] else set()
            power = {a + b for a in power for b in once}
        return out
    return None


def trigram_clauses(pattern: str) -> list[frozenset[str]] | None:
    """Clauses of trigrams, one of which every match has in full; None where a match may have no trigram."""
    clauses, exact = {frozenset()}, {""}

    def joined(found: set[frozenset[str]], strings: set[str]) -> set[frozenset[str]]:
        return {a | _grams(s) for a in found for s in strings}

    for op, value in re._parser.parse(pattern):
        more = _spelled_part(op, value)
        longer = {a + b for a in exact for b in more} if more is not None else None
        if longer is not None and len(longer) <= MOST_STRINGS:
            exact = longer
            continue
        clauses, exact = joined(clauses, exact), {""} if more is None else more
    clauses = joined(clauses, exact)
    clauses = {c for c in clauses if not any(o < c for o in clauses)}
    return None if frozenset() in clauses else sorted(clauses, key=sorted)


QUERIES = {rule.kind: trigram_clauses(rule.pattern) for rule in RULES}


def postings(docs: DataFrame) -> DataFrame:
    """The index: ``gram, doc_id`` for the trigrams that the rules name."""
    wanted = sorted({gram for clauses in QUERIES.values() for clause in clauses or () for gram in clause})
    lowered = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.lower("text").alias("text"))
    held = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(gram)), F.lit(gram)) for gram in wanted]))
    return lowered.select("doc_id", F.explode(held).alias("gram"))


def candidates(index: DataFrame) -> DataFrame:
    """``doc_id, rules``: the rules whose queries the postings of a document meet."""
    spark = index.sparkSession
    rows = [(kind, no, gram, len(clause)) for kind, found in QUERIES.items() for no, clause in enumerate(found or ()) for gram in sorted(clause)]
    clauses = spark.createDataFrame(rows, "kind string, clause int, gram string, size int")
    met = index.distinct().join(F.broadcast(clauses), "gram").groupBy("doc_id", "kind", "clause", "size").count().where("count = size")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("rules"))


def _spans(text: Column, rule: Rule) -> Column:
    """``begin, end`` of a rule's matches: matches and the pieces between them, laid end to end."""
    pattern = F.lit(rule.pattern)
    pieces, matches = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    rows = F.arrays_zip(F.transform(pieces, F.length).alias("p"), F.transform(matches, F.length).alias("m"), F.transform(kept, F.length).alias("k"))
    laid = F.aggregate(
        F.filter(rows, lambda r: r["m"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("out")),
        lambda a, r: F.struct(
            (a["at"] + r["p"] + r["m"]).alias("at"),
            F.when(
                r["k"] >= rule.least,
                F.concat(a["out"], F.array(F.struct((a["at"] + r["p"]).alias("begin"), (a["at"] + r["p"] + r["m"]).alias("end")))),
            ).otherwise(a["out"]).alias("out"),
        ),
        lambda a: a["out"],
    )
    return laid


def _named(spans: Column, no: int, kind: str) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["begin"].alias("begin"), F.lit(no).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row of ``docs``; a span has kind, begin and end, in the order of begin and kind."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = stored(candidates(stored(postings(texts))))
    rows = texts.join(chosen, "doc_id", "left")
    none = F.array().cast("array<struct<begin:int,end:int>>")
    found = []
    for no, rule in enumerate(RULES):
        searched = F.col("doc_id").isNull() | F.coalesce(F.array_contains("rules", rule.kind), F.lit(False))
        if QUERIES[rule.kind] is None:
            # Scanned in full; a text without a run that is long enough is left at its first scan.
            searched = F.col("text").rlike(f"{rule.pattern[:-1]}{{{rule.least}}}") if rule.pattern.endswith("+") else F.lit(True)
        spans = F.when(searched, _spans(F.col("text"), rule)).otherwise(none)
        found.append(_named(spans, no, rule.kind))
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans, their hash, and all spans as text."""
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    base = F.filter("spans", lambda s: s["no"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))

"""Personal data: generated candidate spans, boosted trees over format and context, calibrated thresholds.

The base kinds (email, ip, card, phone) follow fixed formats; their spans always stay. Generators with high recall then
propose looser, overlapping spans: obfuscated addresses ("name at host dot tld"), digit groups with unusual separators,
and numbers without a country code. Trees boosted on rewritten base matches against look-alikes score each proposal by its format
(digits, separators, groups, length) and its context (cue words and characters around it); proposals over the kind's
threshold are added where they overlap no base span and no better proposal.

Training: labels come from the formats themselves. Positives are base matches rewritten in the loose forms that the
generators look for, in their own surroundings. Negatives are base candidates that failed their check (a sum, a length, a
number over 255), look-alikes built in place of base matches (prose with "at", lists, dates, wrong sums), and what the
generators propose away from base spans. Some of the last may be real: those that a model fitted without them scores above
its lowest ``SPIES`` of positives are left out. All examples of all documents are fitted: features are put into fixed bins
(``CUTS``), equal rows are counted, and every level of a tree is one pass in which tasks add up histograms of gradients. These
are whole numbers, so sums do not depend on how rows are dealt. The driver gets sums of fixed size only. The threshold of a
kind is the lowest score at which all held-out examples (every fifth hash in order, with all that was built from its match)
reach ``PRECISION``; margins are rounded to 1/``STEP``, so that these too are counted by value. A
kind with fewer than two different base matches has no model and adds nothing.
Every text is searched whole, and all its proposals are scored.

Nulls and repeats: a null text is empty, every row gives one row, also where ids are null or repeat; empty tables give
empty results; other columns are not read. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidelog.llm.common import small_batches, stored

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: Share of the positives, those with the lowest scores, that tells how low a real span may score.
SPIES = 0.1
TREES, DEPTH, RATE = 40, 3, 0.2
#: Hashes of candidates lie below this.
TOP = 1 << 62
#: Cuts between the bins of a feature: shares, then whole numbers, then steps of 7 %, and the limit of an address part.
CUTS = np.sort(np.concatenate([np.arange(32) / 32, np.arange(1, 64) + 0.5, 64.5 * 1.07 ** np.arange(143), [255.5]]))
BINS = len(CUTS) + 1
#: Units of a gradient and of a margin; sums of whole numbers are exact.
UNIT, STEP = 1 << 20, 1 << 10
#: Hashes that one task ranks, about, and distinct rows in one block of the passes.
RANKED, BLOCK = 4096, 50_000

Span = tuple[int, int]

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A group of digits is taken whole at once: what follows it is no digit, so a shorter group could not go on either.
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Fixed words of contact and payment in the corpus' languages, looked for just before a candidate.
CUES = re.compile(r"(?i)mail|e-mail|contact|phone|call|tel|fax|mobile|card|visa|iban|konto|karte|carte|tarjeta|ip|host|server|address|token|version|isbn|order")

AT_WORD = re.compile(r"(?i)[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\sat\s|@)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\(dot\)|\[dot\]|\sdot\s|\.)\s?[A-Za-z0-9-]{2,63}){1,4}")
LOOSE_IP = re.compile(r"[0-9]{1,3}(?:\s?[.,]\s?[0-9]{1,3}){3}")
LOOSE_CARD = re.compile(r"[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{4}){2}[\x20._/-]{1,2}[0-9]{1,7}")
LOOSE_CALL = re.compile(r"(?:\(?[0-9]{2,4}\)?[\x20./-]{1,2}){2,4}[0-9]{2,5}")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int, bool]]:
    """Leftmost non-overlapping addresses, found from their ``@``: linear also in texts of one long word."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL_CHARACTERS:
            begin -= 1
        host = DOMAIN.match(text, at + 1) if begin < at else None
        if host:
            out.append((begin, host.end(), True))
            done = host.end()
        elif begin < at:
            out.append((begin, at + 1, False))
        at = text.find("@", max(at + 1, done))
    return out


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """Base candidates ``kind, begin, end, passed`` of a text."""
    out = [("email", *x) for x in emails(text)] if "@" in text else []
    for m in DOTTED.finditer(text):
        out.append(("ip", *m.span(), all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))))
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 8:
            digits = re.sub("[^0-9]", "", m[0])
            out.append(("card", *m.span(), 13 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in CALL.finditer(text):
            out.append(("phone", *m.span(), 9 <= sum(c.isdigit() for c in m[0]) <= 15))
    return out


def proposals(text: str, kinds: tuple[str, ...] = KINDS) -> list[tuple[str, int, int]]:
    """Looser spans of each kind; they may overlap each other and base spans."""
    out = []
    for at in re.finditer(r"(?i)@|\(at\)|\[at\]|\sat\s", text) if "email" in kinds else ():
        # Back from the mark over the local part, so that addresses side by side are all found; no address is longer on
        # either side than the window.
        end = at.start() - (at.start() > 0 and text[at.start() - 1].isspace())
        begin = end
        while begin > max(0, end - 64) and text[begin - 1] in LOCAL_CHARACTERS:
            begin -= 1
        m = AT_WORD.match(text, begin, at.end() + 320) if begin < end else None
        if m:
            out.append(("email", *m.span()))
    for kind, pattern in (("ip", LOOSE_IP), ("card", LOOSE_CARD), ("phone", LOOSE_CALL)):
        if kind in kinds:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


FEATURES = 21


def features(text: str, begin: int, end: int) -> list[float]:
    """Format of a span and its context."""
    span = text[begin:end]
    before, after = text[max(0, begin - 24) : begin], text[end : end + 24]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    length = len(span)
    return [
        length,
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        max((int(g[:6]) for g in groups), default=0),
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("(") + span.count(")"),
        float("@" in span),
        float(span[:1] == "+"),
        sum(c.isalpha() for c in span) / length,
        float(luhn(digits)) if 12 < len(digits) < 20 else 0.5,
        float(before[-1:].isalnum() or after[:1].isalnum()),
        float(bool(CUES.search(before))),
        float(after[:1] in ".,;:" and after[:1] != ""),
        sum(c.isdigit() for c in before + after),
        float(all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        len(re.findall(r"[.,]\s", span)),
        len(re.findall(r"(?i)[(\[](?:at|dot)[)\]]|\sdot\s", span)),
    ]


AT_FORMS = (" (at) ", " [at] ", " at ", "(at)", "[at]", " @ ")
DOT_FORMS = (" (dot) ", ".", " dot ", " [dot] ", "(dot)", "[dot]")
IP_FORMS = (" . ", ". ", " .", ",", " , ", " ,")
CARD_FORMS = (".", "_", "/", "  ", "--", "__")


def rewritten(kind: str, span: str, mark: int) -> list[tuple[int, str]]:
    """Loose forms of a base match (label 1) and look-alikes made from it (label 0); ``mark`` picks among them."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        local, host = span.split("@")
        parts = host.split(".")
        out = [(1, local + at + DOT_FORMS[(mark + k) % 6].join(parts)) for k, at in enumerate(AT_FORMS)]
        parts[-1] = parts[-1].capitalize()
        return out + [(0, local + at + stop.join(parts)) for at in (" at ", " @ ") for stop in (". ", ".\n", " . ")]
    if kind == "ip":
        parts = [p.lstrip("0")[-3:] or "0" for p in span.split(".")]
        small = [str(int(p) % (mark % 255 + 1)) for p in parts]  # sizes must not tell real ones from lists
        wrong = list(parts if mark % 2 else small)
        wrong[mark % 4] = str(256 + mark % 744)
        first, rest = mark % 90 + 10, [f"{mark // 1000**k % 1000:03d}" for k in (1, 2, 3)]
        lists = [", ".join(parts), ", ".join(small), ", ".join(str(first + k) for k in range(4)), ",".join([str(first), *rest])]
        real = [(1, form.join((parts, small)[(mark + k) % 2])) for k, form in enumerate(IP_FORMS)]
        return real + [(0, form.join(wrong)) for form in IP_FORMS[:4]] + [(0, x) for x in lists]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + mark % 9) % 10)
        return [(label, form.join((d[:4], d[4:8], d[8:12], d[12:]))) for form in CARD_FORMS for label, d in ((1, digits), (0, wrong))]
    own = digits[max(1, len(digits) - 10) :]
    half = (len(own) - 4) // 2
    a, b, c = own[:half], own[half:-4], own[-4:]
    out = [(1, x) for x in (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}) {b} {c}", f"{a}/{b}-{c}")]
    year, month, day, fours = 1900 + mark % 200, 1 + mark % 12, 1 + mark % 28, f"{mark:016d}"[-16:]
    dates = [f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year}", f"{day:02d}/{month:02d}/{year}", f"{year} {month:02d} {day:02d}"]
    rows = [f"{fours[:4]}{s}{fours[4:8]}{s}{fours[8:12]}{s}{fours[12:]}" for s in " -"]
    return out + [(0, x) for x in (*dates, *rows, f"{fours[:2]} {fours[2:4]} {fours[4:6]}")]


def loose_examples(text: str, kind: str, begin: int, end: int, mark: int) -> list[tuple[int, list[float]]]:
    """Labels and features of what the generators propose where a base match is rewritten in its surroundings."""
    before, after, out = text[max(0, begin - 64) : begin], text[end : end + 64], []
    for label, new in rewritten(kind, text[begin:end], mark):
        changed, at = before + new + after, len(before)
        spans = [(b, e) for _, b, e in proposals(changed, (kind,)) if b < at + len(new) and at < e]
        best = max(spans, key=lambda s: min(s[1], at + len(new)) - max(s[0], at), default=None)
        if best and 2 * (min(best[1], at + len(new)) - max(best[0], at)) > len(new):
            out.append((label, features(changed, *best)))
    return out


def apart(spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that overlap none of ``base``."""
    ordered = sorted((b, e) for _, b, e in base)
    begins, last = [b for b, _ in ordered], np.maximum.accumulate([0, *(e for _, e in ordered)]).tolist()
    return [s for s in spans if last[bisect_left(begins, s[2])] <= s[1]]


@dataclass
class Boosted:
    """Boosted trees of fixed depth with Platt-scaled scores and a threshold; ``None`` threshold adds nothing."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    base: float
    slope: float
    shift: float
    threshold: float | None
    #: Examples that it was fitted and calibrated on.
    examples: int = 0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree[2][places(x, *tree[:2], DEPTH)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(np.rint(self.margin(x) * STEP))

    def scaled(self, steps: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (steps / STEP) + self.shift, -40, 40)))


def places(x: np.ndarray, column: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Place of each row among the nodes of a tree at ``depth``."""
    node = np.zeros(len(x), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (x[np.arange(len(x)), column[node]] > cut[node])
    return node - (2**depth - 1)


def calibrated(model: Boosted, steps: np.ndarray, real: np.ndarray, weight: np.ndarray) -> None:
    """Set scale and threshold from the held-out margins (in ``STEP``), with how many examples have each."""
    held_margin, yh = steps / STEP, real.astype(float)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps for the two calibration parameters
        p = 1 / (1 + np.exp(-np.clip(slope * held_margin + shift, -40, 40)))
        design = np.stack([held_margin, np.ones_like(held_margin)])
        change = np.linalg.solve(
            (design * (weight * p * (1 - p))) @ design.T + 1e-3 * np.eye(2), design @ (weight * (yh - p)) - 1e-3 * np.array([slope - 1, shift])
        )
        slope, shift = slope + change[0], shift + change[1]
    model.slope, model.shift = float(max(slope, 1e-3)), float(shift)
    score = model.scaled(steps)
    order = np.argsort(-score, kind="stable")
    precise = np.cumsum((weight * yh)[order]) / np.cumsum(weight[order])
    ends = np.append(np.diff(score[order]) != 0, True)  # equal scores are taken together
    good = np.flatnonzero((precise >= PRECISION) & ends[: len(precise)])
    # Half-way to the next score below, as all scores between make the same choice of held-out rows.
    ranked = np.append(score[order], 0.0)
    model.threshold = max(0.5, float(ranked[good[-1]] + ranked[good[-1] + 1]) / 2) if len(good) else None


#: Labels of examples: a look-alike, a real one, and a proposal away from base spans.
FAILED, REAL, PROPOSED = 0, 1, 2
EXAMPLE = "kind string, label int, hash bigint, x binary"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        rows = []
        for text in batch.column("text").to_pylist():
            base = candidates(text or "")
            passed = [(kind, begin, end) for kind, begin, end, good in base if good]
            looser = [(*span, None) for span in apart(proposals(text or ""), passed)]
            for kind, begin, end, good in base + looser:
                mark = xxhash.xxh3_64_intdigest(text[max(0, begin - 24) : end + 24].encode()) >> 2
                if good:
                    rows += [(kind, label, mark, x) for label, x in loose_examples(text, kind, begin, end, mark)]
                else:
                    rows.append((kind, FAILED if good is False else PROPOSED, mark, features(text, begin, end)))
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        columns[3] = [x.tobytes() for x in np.searchsorted(CUTS, np.array(columns[3])).astype(np.uint8)] if rows else ()
        types = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["kind", "label", "hash", "x"])


def counted_examples(docs: DataFrame) -> DataFrame:
    """``kind, label, place, x, weight``: all examples by their bins, with how many there are.

    ``place`` is the rank of the example's hash among the different ones of its kind and label, modulo 10. Equal candidates
    in equal surroundings count once, however often they are copied. Ranks come from ranges of hashes of about ``RANKED``.
    """
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_examples, EXAMPLE)
    found = stored(found.distinct())
    marks = found.select("kind", "label", "hash").distinct()
    part = F.floor(F.col("hash").cast("double") * (found.count() // RANKED + 1) / TOP)
    ranked = marks.withColumn("part", part).withColumn("no", F.row_number().over(Window.partitionBy("kind", "label", "part").orderBy("hash")))
    ranked = stored(ranked)
    upto = Window.partitionBy("kind", "label").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranked.groupBy("kind", "label", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    placed = ranked.join(before, ["kind", "label", "part"]).select("kind", "label", "hash", ((F.col("no") - 1 + F.col("before")) % 10).alias("place"))
    return stored(found.join(placed, ["kind", "label", "hash"]).groupBy("kind", "label", "place", "x").agg(F.count("*").alias("weight")))


@dataclass
class Block:
    """Examples as arrays; ``margin`` has a column for each of the two models that leave out a half of the proposals."""

    kind: np.ndarray
    label: np.ndarray
    place: np.ndarray
    weight: np.ndarray
    x: np.ndarray
    margin: np.ndarray

    def where(self, rows: np.ndarray) -> "Block":
        return Block(self.kind[rows], self.label[rows], self.place[rows], self.weight[rows], self.x[rows], self.margin[rows])

    def left_out(self, side: int) -> np.ndarray:
        return (self.label == PROPOSED) & (self.place % 2 == side)


def _blocks(rows: Iterable[Row]) -> Iterator[Block]:
    rows = list(rows)
    if rows:
        kind, label, place, x, weight = zip(*rows)
        bins = np.frombuffer(b"".join(x), np.uint8).reshape(-1, FEATURES)
        numbers = (np.array(c, np.int64) for c in ([KINDS.index(k) for k in kind], label, place, weight))
        yield Block(*numbers, bins, np.zeros((len(rows), 2)))


Key = tuple[int, int]
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def _histograms(block: Block, trees: dict[Key, Tree], depth: int, spying: bool) -> dict[Key, np.ndarray]:
    """Sums of gradient and curvature by feature, node at ``depth`` and bin, for each kind and model."""
    out = {}
    for (kind, side), (column, cut, _) in trees.items():
        rows = (block.kind == kind) & (block.place % 5 != 0)
        of = block.where(rows & ~block.left_out(side) if spying else rows)
        if not len(of.kind):
            continue
        p = 1 / (1 + np.exp(-of.margin[:, side]))
        sums = [np.rint(UNIT * v) * of.weight for v in ((of.label == REAL) - p, p * (1 - p))]
        at = places(of.x, column, cut, depth) * BINS
        size = BINS << depth
        out[kind, side] = np.array([[np.bincount(at + of.x[:, c], v, size) for c in range(FEATURES)] for v in sums]).reshape(2, FEATURES, -1, BINS)
    return out


def _added(one: dict, two: dict) -> dict:
    return {k: one[k] + two[k] if k in one and k in two else one.get(k, two.get(k)) for k in {**one, **two}}


def _tallies(block: Block) -> dict[tuple[int, int, int, int], Counter]:
    """How many examples of each kind, label and place have each margin (in ``STEP``), for both models."""
    out: dict = {}
    steps = np.rint(block.margin * STEP).astype(np.int64)
    for side in (0, 1):
        keys, at = np.unique(np.stack([block.kind, block.label, block.place, steps[:, side]]), axis=1, return_inverse=True)
        for key, n in zip(keys.T.tolist(), np.bincount(at.ravel(), block.weight).tolist()):
            out.setdefault((*key[:3], side), Counter())[key[3]] += int(n)
    return out


def _advanced(block: Block, trees: dict[Key, Tree]) -> Block:
    margin = block.margin.copy()
    for (kind, side), (column, cut, leaf) in trees.items():
        rows = np.flatnonzero(block.kind == kind)
        margin[rows, side] += leaf[places(block.x[rows], column, cut, DEPTH)]
    return Block(block.kind, block.label, block.place, block.weight, block.x, margin)


def _begun(block: Block, base: dict[Key, float]) -> Block:
    margin = np.zeros_like(block.margin)
    for (kind, side), value in base.items():
        margin[block.kind == kind, side] = value
    return Block(block.kind, block.label, block.place, block.weight, block.x, margin)


def _total(blocks: RDD[Block], what) -> dict:
    """Sums over all blocks; those of many blocks are added up in tasks first."""
    return blocks.map(what).treeAggregate({}, _added, _added, depth=1 if blocks.getNumPartitions() <= 16 else 2)


def _best(g: np.ndarray, h: np.ndarray) -> tuple[int, int, list[float]]:
    """Feature and cut that lower the logistic loss most, by second-order gain, and the steps on both sides."""
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    total_g, total_h = g[0].sum(), h[0].sum()
    gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
    gain[(left_h == 0) | (left_h == total_h)] = 0
    column = int(gain.max(axis=1).argmax())
    at = int(gain[column].argmax())
    if gain[column, at] <= 1e-9:
        return 0, BINS, [RATE * total_g / (total_h + 1), 0.0]
    one, two = left_g[column, at], total_g - left_g[column, at]
    steps = [RATE * one / (left_h[column, at] + 1), RATE * two / (total_h - left_h[column, at] + 1)]
    # Cuts with no row in between are alike; the one half-way is taken.
    alike = np.flatnonzero((left_g[column] == one) & (left_h[column] == left_h[column, at]))
    return column, int(np.abs(CUTS[alike] - (CUTS[alike[0]] + CUTS[alike[-1]]) / 2).argmin()) + int(alike[0]), steps


def boost(blocks: RDD[Block], base: dict[Key, float], spying: bool) -> tuple[dict[Key, list[Tree]], RDD[Block]]:
    """The trees (over bins) of every kind and model, one pass a level, and the blocks with their margins."""
    grown: dict[Key, list[Tree]] = {key: [] for key in base}
    last, blocks = None, blocks.map(partial(_begun, base=base)).persist()
    for _ in range(TREES if base else 0):
        size = 2**DEPTH
        trees = {key: (np.zeros(size - 1, np.int64), np.full(size - 1, BINS), np.zeros(size)) for key in base}
        for depth in range(DEPTH):
            sums = _total(blocks, partial(_histograms, trees=trees, depth=depth, spying=spying))
            if last and depth == 0:  # this pass has kept the new margins
                last.unpersist()
            for key, (g, h) in sums.items():
                column, cut, leaf = trees[key]
                for node in range(2**depth):
                    at = 2**depth - 1 + node
                    column[at], cut[at], steps = _best(g[:, node] / UNIT, h[:, node] / UNIT)
                    if depth == DEPTH - 1:
                        leaf[2 * node : 2 * node + 2] = steps
        for key, tree in trees.items():
            grown[key].append(tree)
        last, blocks = blocks, blocks.map(partial(_advanced, trees=trees)).persist()
    if last:
        blocks.count()
        last.unpersist()
    return grown, blocks


def _log_odds(tallies: dict, kind: int, side: int | None) -> float | None:
    """Log-odds of the fitted examples of a kind, if there are enough to fit and to test."""
    n: Counter = Counter()
    for (k, label, place, of), margins in tallies.items():
        if k == kind and of == 0 and not (side is not None and label == PROPOSED and place % 2 == side):
            n[label == REAL, place % 5 == 0] += sum(margins.values())
    if min(n[real, held] for real in (True, False) for held in (True, False)) < 5:
        return None
    return float(np.log(n[True, False] / n[False, False]))


def _low(margins: Counter, share: float) -> int:
    """The margin that ``share`` of the examples lie below."""
    values, counts = (np.array(c) for c in zip(*sorted(margins.items())))
    return int(values[np.searchsorted(np.cumsum(counts), share * (counts.sum() - 1), side="right")])


def _sure(block: Block, low: dict[Key, int]) -> Block:
    """Without the proposals that score like positives in the model that has not seen them."""
    sure = np.ones(len(block.kind), bool)
    for (kind, side), least in low.items():
        sure &= ~((block.kind == kind) & block.left_out(side) & (np.rint(block.margin[:, side] * STEP) >= least))
    return block.where(sure)


def train(docs: DataFrame) -> dict[str, Boosted]:
    """A model for each kind, fitted and calibrated on all examples of all documents."""
    models = {kind: Boosted([], 0.0, 1.0, 0.0, None) for kind in KINDS}
    examples = counted_examples(docs)
    blocks = examples.repartition(examples.count() // BLOCK + 1).rdd.mapPartitions(_blocks).persist()
    first = _total(blocks, _tallies)
    odds = {(k, side): _log_odds(first, k, side) for k in range(len(KINDS)) for side in (0, 1)}
    _, spied = boost(blocks, {key: base for key, base in odds.items() if base is not None}, True)
    real = {}
    for (kind, label, _, side), margins in _total(spied, _tallies).items():
        if label == REAL:
            real[kind, side] = real.get((kind, side), Counter()) + margins
    sure = spied.map(partial(_sure, low={key: _low(margins, SPIES) for key, margins in real.items()})).persist()
    base = {(k, 0): _log_odds(_total(sure, _tallies), k, None) for k in range(len(KINDS))}
    base = {key: value for key, value in base.items() if value is not None}
    grown, fitted = boost(sure, base, False)
    last = _total(fitted, _tallies) if base else {}
    for (kind, _), value in base.items():
        cuts = np.append(CUTS, np.inf)
        trees = [(column, cuts[np.minimum(cut, len(CUTS))], leaf) for column, cut, leaf in grown[kind, 0]]
        held: Counter = Counter()
        for (k, label, place, side), margins in last.items():
            if k == kind and side == 0 and place % 5 == 0:
                held.update({(m, label == REAL): n for m, n in margins.items()})
        n = sum(sum(margins.values()) for (k, _, _, side), margins in last.items() if k == kind and side == 0)
        models[KINDS[kind]] = Boosted(trees, value, 1.0, 0.0, None, n)
        steps, is_real = zip(*sorted(held))
        calibrated(models[KINDS[kind]], np.array(steps), np.array(is_real), np.array([held[x] for x in sorted(held)], float))
    for kept in (blocks, spied, sure, fitted):
        kept.unpersist()
    return models


def found_in(text: str, models: dict[str, Boosted]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the spans that the models add."""
    base = [(kind, begin, end) for kind, begin, end, passed in candidates(text) if passed]
    scored = []
    proposed: dict[str, list[Span]] = {}
    for kind, begin, end in apart(proposals(text), base):
        if models[kind].threshold is not None:
            proposed.setdefault(kind, []).append((begin, end))
    for kind, spans in proposed.items():
        model = models[kind]
        scores = model.score(np.array([features(text, *s) for s in spans]))
        scored += [(-float(p), begin, end, kind) for p, (begin, end) in zip(scores, spans) if p >= model.threshold]
    added: list[tuple[int, int, str]] = []  # apart from each other, in order
    for _, begin, end, kind in sorted(scored):
        at = bisect_left(added, (end,))
        if at == 0 or added[at - 1][1] <= begin:
            added.insert(at, (begin, end, kind))
    return base, [(kind, begin, end) for begin, end, kind in added]


FOUND = "doc_id bigint, base array<struct<kind:string,begin:int,end:int>>, added array<struct<kind:string,begin:int,end:int>>"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))


def _rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": k, "begin": b, "end": e} for k, b, e in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))]


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added``: the spans of every row of ``docs``, by kind and place."""
    models = docs.sparkSession.sparkContext.broadcast(train(docs))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [found_in(text or "", models.value) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_rows(b) for b, _ in found], SPANS), pa.array([_rows(a) for _, a in found], SPANS)],
                ["doc_id", "base", "added"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(search, FOUND)


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans, their hash, and all spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    order = F.array(*map(F.lit, KINDS))
    placed = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(F.array_position(order, s["kind"]).alias("no"), s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    return found.select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), placed.alias("all"), F.size("added").cast("bigint").alias("n_added")
    ).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", _joined("all").alias("spans"), "n_added")


def redacted(text: str, models: dict[str, Boosted]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named after the first."""
    base, added = found_in(text, models)
    out, at, last = [], 0, None
    for begin, end, kind in sorted((b, e, k) for k, b, e in base + added):
        if last is not None and begin < at:
            if end > at:
                at = end
            continue
        out.append(text[at:begin])
        out.append(f"[{kind.upper()}]")
        at, last = end, kind
    out.append(text[at:])
    return "".join(out)


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with personal data replaced in their texts; all other columns stay as they are.

    Texts without a span stay as they are; ``n_chars``, if there, is counted again where a text changed.
    """
    models = docs.sparkSession.sparkContext.broadcast(train(docs))
    columns, at = docs.columns, docs.columns.index("text")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            raw = batch.column("text").to_pylist()
            new = [t if t is None else redacted(t, models.value) for t in raw]
            out = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if "n_chars" in columns:
                place = columns.index("n_chars")
                counts = [c if x == y else len(y) for x, y, c in zip(raw, new, batch.column(place).to_pylist())]
                out = out.set_column(place, batch.schema.field(place), pa.array(counts, batch.schema.field(place).type))
            yield out

    return docs.mapInArrow(cleaned, docs.schema)

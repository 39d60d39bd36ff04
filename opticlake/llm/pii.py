"""Personal data: rules, high-recall candidates, boosted trees and calibrated thresholds.

The base spans of each kind (email, ip, card, phone) come from rules and always stay. Wider generators propose more,
overlapping spans: addresses written out (`name at host dot com`), numbers without a plus or with other separators,
parts of longer numbers. Gradient-boosted trees (Spark ML) see the format and the context of a candidate. They learn
from examples whose truth does not rest on the rule's verdict on the span: base spans rewritten where they stand, into
written-out addresses, numbers without a plus, other groups and separators and cards of 12 to 15 digits (right), and
look-alikes in their place: wrong check digits, dates, amounts, order numbers, parts over 255, prose with `at` (wrong).
Candidates of the texts beyond the base are examples (wrong) only where something speaks against them: they cut into a
base span or a longer word or number, or fail the checksum or range; the others are not learnt from. A logistic
calibration on the other half of the documents turns the margin into a probability, and each kind gets the least threshold
at which at least PRECISION of the held-out examples are right. What passes, and overlaps no base span and no better
candidate, is added.

Candidates of digits are all stretches of up to MOST_GROUPS groups that have as many digits as their kind may have, wherever they
stand in a run of groups; groups of a candidate are at most three separators apart. Written-out addresses have any length.

The trees are fitted on the examples of half of all documents, split by a hash of doc_id, and calibration and thresholds
come from those of the other half. Examples that are alike are one row with their number as weight; there are few kinds of
them, so the fit grows much slower than the texts. Of the other half the driver gets counts per margin, in steps of 1 / STEPS.

Edge cases: NULL text is empty, and an empty text has no spans; with too few candidates to learn from (one class only)
only base spans are given; rows are judged one by one, so repeated rows give the same answer; further columns are not
looked at. All searches take time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake.llm.catalog import query
from opticlake.llm.vectors import matrix
from opticlake.session import materialize

KINDS = ["email", "ip", "card", "phone"]
PRECISION, STEPS = 0.995, 4096
MOST_GROUPS = 8  # of digits in a candidate; a run may have any number of them
Span = tuple[int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"[0-9]+")
# Candidates: written-out addresses, and groups of digits with short separators.
_SAID = re.compile(
    r"(?<![\w.])[\w.+-]+(?:\x20?@\x20?|\x20?\(at\)\x20?|\x20?\[at\]\x20?|\x20at\x20)[A-Za-z0-9-]+"
    r"(?:(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?|\x20dot\x20)[A-Za-z0-9-]+)+", re.ASCII)
_GOES_ON_LEFT, _GOES_ON_RIGHT = re.compile(r"[0-9][\x20().-]{1,3}$"), re.compile(r"[\x20().-]{1,3}[0-9]")
_SPELL = str.maketrans("0123456789", "abcdefghij")
_SAYS = ("@", " dot ", "dot)", "dot]", "(at)", "[at]")
#: Digits in groups, with one to three separators between them: a run. A candidate is any stretch of groups of a run.
_GROUPS = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9]+(?:[\x20().-]{1,3}[0-9]+)*", re.ASCII)
#: Numbers of digits that a candidate of a kind has.
_DIGITS = {"phone": range(7, 16), "card": range(12, 20), "ip": range(4, 13)}
_MOST_DIGITS = max(r[-1] for r in _DIGITS.values())
_HINTS = {
    "email": ("mail", "contact", "kontakt", "correo", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "carte", "karte", "tarjeta", "visa", "credit", "payment"), "phone": ("tel", "phone", "call", "fax", "mobil", "handy"),
}
FEATURES = 34


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _only(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[Span]:
    """From each @ to both sides, as no address has a second one before its domain."""
    free = 0
    at = text.find("@")
    while at >= 0:
        local = text[free:at]
        start = free + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> dict[str, list[Span]]:
    """The confirmed matches of each kind's rule, left to right, without overlap within a kind."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    found["email"] = list(_emails(text))
    if _DIGIT.search(text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        found["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_only(m[0])) <= 15]
    return found


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, Span]]:
    """High-recall proposals, overlapping, the base spans among them."""
    found = {(kind, span) for kind, spans in base.items() for span in spans}
    if any(mark in text for mark in _SAYS):
        found |= {("email", m.span()) for m in _SAID.finditer(text)}
    if _DIGIT.search(text):
        for m in _GROUPS.finditer(text):
            parts = [p.span() for p in _RUN.finditer(text, m.start(), m.end())]
            for i, (start, _) in enumerate(parts):
                digits = 0
                marked = start - 1 if start and text[start - 1] in "+(" else start
                for a, end in parts[i : i + MOST_GROUPS]:
                    digits += end - a
                    if digits > _MOST_DIGITS:
                        break
                    kinds = [k for k in ("phone", "card") if digits in _DIGITS[k]]
                    kinds += ["ip"] if digits in _DIGITS["ip"] and text.count(".", start, end) == 3 else []
                    found.update((k, (s, end)) for k in kinds for s in {start, marked})
    return sorted(found)


def features(text: str, kind: str, span: Span) -> list[float]:
    """Format of the span and what stands around it."""
    start, end = span
    said = text[start:end]
    digits = _only(said)
    groups = re.findall(r"[0-9]+", said)
    left, right = text[max(0, start - 24) : start].lower(), text[end : end + 4]
    before, after = left[-1:], right[:1]
    return [
        *[float(kind == k) for k in KINDS], float(len(digits)), float(len(groups)), float(len(said)),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(bool(digits) and luhn(digits[:64])), float(said[:1] == "+"), float("(" in said), float(said.count(".")),
        float(" " in said), float("@" in said), float(all(map(_small, groups)) if groups else 0),
        float(before.isalnum() or before in ("+", "(", ".", "-", "_")), float(after.isalnum() or after in ("@", "_")),
        float(after in (".", "-", ")") and right[1:2].isdigit()), float(any(h in left for h in _HINTS[kind])),
        float(said.count("-")), float(said.count(" ")), float(any(m in said for m in ("(at)", "[at]"))), float(" at " in said),
        float(any(m in said for m in (" dot ", "dot)", "dot]"))), float(len(groups[0]) if groups else 0), float(len(groups[-1]) if groups else 0),
        float(any(len(g) == 4 and g[:2] in ("19", "20") for g in groups[:1] + groups[-1:])), float(len(groups[1]) if len(groups) > 1 else 0),
        float(len({c for c in said if c in " .-()"})), float(bool(_GOES_ON_LEFT.search(left))), float(bool(_GOES_ON_RIGHT.match(right))),
        float(kind in ("email", "phone") or (luhn(digits[:64]) if kind == "card" else all(map(_small, groups)))),
        float(len(groups) == 4 and all(map(_small, groups))),
    ]


def _with_check(digits: str) -> str:
    """Digits, the last of them made the check digit."""
    return next(digits[:-1] + d for d in "0123456789" if luhn(digits[:-1] + d))


def _cut(digits: str, sizes: tuple[int, ...], between: str) -> str:
    """Digits in groups of these sizes; what is over comes first."""
    over = len(digits) - sum(sizes)
    ends = [over + sum(sizes[:i]) for i in range(len(sizes) + 1)]
    return between.join(filter(None, [digits[:over], *[digits[a:b] for a, b in zip(ends, ends[1:], strict=False)]]))


def _rewritten(kind: str, said: str, rng: random.Random) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Other forms of a base span that say the same, and look-alikes; each as (words before it, form)."""
    hint = rng.choice(_HINTS[kind]) + rng.choice([" ", ": ", ". "])
    if kind == "email":
        local, _, domain = said.rpartition("@")
        marks, dots = [" (at) ", "(at)", " [at] ", "[at]", " at "], [" dot ", "(dot)", " (dot) ", "[dot]", " [dot] "]
        over = domain.partition(".")[2]
        domains = [domain, over] if "." in over else [domain]  # with the first part of the host and without
        right = [("", local + m + d.replace(".", rng.choice(dots))) for d in domains for m in marks] + [
            ("", local + m + d) for d in domains for m in marks[:4]] + [("", f"{local} @ {d}") for d in domains]
        verbs = ["look", "available", "hosted", "us", "see", "arrive", "published", "found", "more", "stay"]
        # Most of the forms without digits and some with a dot in the name, as addresses have them or not.
        at = len(local) // 2
        inner = local[:at] + "." + local[at:] if at else local
        right = [(b, f.replace(local, own, 1)) for own in (local, inner) for b, f in right]
        spelt = [(b, f.translate(_SPELL)) for b, f in right]
        return right + spelt, [("", f"{v} at {d}") for d in domains for v in rng.sample(verbs, 6)] + [
            ("", f"{v} at {d.translate(_SPELL)}") for d in domains for v in rng.sample(verbs, 6)]
    digits = _only(said)
    if kind == "ip":
        parts = said.split(".")
        wrong = [*parts]
        wrong[rng.randrange(4)] = str(rng.randrange(256, 1000))
        forms = [". ", " . ", "(.)", " ."]
        return [("", f.join(parts)) for f in forms], [("", f.join(wrong)) for f in forms] + [("", ".".join(wrong))]
    if kind == "phone":
        home = digits[-10:]
        right = [("", said[1:]), (hint, digits), (hint, home)]
        for d in (digits, home):
            right += [("", _cut(d, (3, 3, 4) if len(d) >= 10 else (4, 4), c)) for c in (" ", "-", ".")]
        right += [("", f"({home[:3]}) {_cut(home[3:], (4,), c)}") for c in ("-", " ")] + [("", f"00{_cut(digits, (3, 4), ' ')}")]
        day, month, year = f"{rng.randrange(1, 29):02}", f"{rng.randrange(1, 13):02}", str(rng.randrange(1900, 2100))
        amount = [f"{rng.randrange(10, 9999)}.{rng.randrange(100):02}" for _ in range(2)]
        return right, [("", digits), ("", home), ("", home[-8:]), ("order ", digits), ("", f"{year}-{month}-{day}"), ("", f"{day}.{month}.{year}"),
                       ("", f"{day}-{month}-{year}"), ("", f"{year}-{month}-{day} {day}"), ("", " - ".join(amount)), ("", f"{year} - {int(year) + 9}"),
                       ("", _cut(home, (3, 3, 3), " ")), ("", f"{year}{month}{day}")]
    right = [("", _cut(_with_check(digits[:16]), (4, 4, 4, 4), c)) for c in (".", " - ", " . ")]
    for n, sizes in ((12, (4, 4, 4)), (13, (4, 4, 4, 1)), (14, (4, 6, 4)), (15, (4, 6, 5))):
        right += [("", _cut(_with_check(digits[:n]), sizes, c)) for c in (" ", "-")] + [(hint, _with_check(digits[:n]))]
    wrong = [(b, form[:-1] + str((int(form[-1]) + rng.randrange(1, 10)) % 10)) for b, form in right]
    return right, wrong + [("", str(rng.randrange(10 ** (n - 1), 10**n))) for n in range(12, 20)]


def examples(h: int, text: str) -> list[tuple[str, int, list[float], float]]:
    """(kind, start, features, whether right) of what a text has to learn from."""
    base = base_spans(text)
    sure = {(k, s) for k, spans in base.items() for s in spans}
    rows = []
    for kind, span in candidates(text, base):
        x, digits = features(text, kind, span), _only(text[span[0] : span[1]])
        cuts = any(a < span[1] and span[0] < b for _, (a, b) in sure) or x[16] or x[17] or x[18]
        fails = kind == "card" and not luhn(digits) or kind == "ip" and not x[15]
        if (kind, span) in sure or cuts or fails:
            rows.append((kind, span[0], x, float((kind, span) in sure)))
    for kind, (a, b) in sorted(sure):
        rng = random.Random(f"{h} {kind} {a}")
        for forms, truth in zip(_rewritten(kind, text[a:b], rng), (1.0, 0.0), strict=True):
            for before, form in forms:
                left = text[max(0, a - 40) : a] + before
                said, own = left + form + text[b : b + 40], (len(left), len(left) + len(form))
                for other, span in candidates(said, base_spans(said)):
                    if span == own or truth and span[0] < own[1] and own[0] < span[1]:  # parts of look-alikes say nothing new
                        rows.append((other, a, features(said, other, span), float(truth and other == kind and span == own)))
    return rows


Tree = tuple  # (feature, threshold, left, right) or a number


def _trees(model) -> list[tuple[float, Tree]]:
    """Weights and trees of a fitted Spark model, read from its text form."""

    def read(lines: list[str]) -> Tree:
        line = lines.pop(0).strip()
        if line.startswith("Predict:"):
            return float(line.split(":")[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= ([^)]+)\)", line).groups()
        low = read(lines)
        lines.pop(0)
        return int(feature), float(threshold), low, read(lines)

    return [(w, read(t.toDebugString.strip().split("\n")[1:])) for w, t in zip(model.treeWeights, model.trees, strict=True)]


def _leaf(tree: Tree, x: list[float]) -> float:
    while isinstance(tree, tuple):
        feature, threshold, low, high = tree
        tree = low if x[feature] <= threshold else high
    return tree


@dataclass
class Scorer:
    trees: list[tuple[float, Tree]] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def margin(self, x: list[float]) -> float:
        return sum(w * _leaf(t, x) for w, t in self.trees)

    def probability(self, x: list[float]) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * self.margin(x) + self.shift))))

    def spans(self, text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
        """Base spans, and all spans."""
        base = base_spans(text)
        every = {k: list(v) for k, v in base.items()}
        if self.trees:
            sure = {(k, s) for k, spans in base.items() for s in spans}
            ranked = sorted((-p, k, s) for k, s in candidates(text, base) if (k, s) not in sure
                            and (p := self.probability(features(text, k, s))) >= self.thresholds.get(k, 2.0))
            # Taken spans as disjoint stretches, in order; a candidate has to fit between two of them.
            taken: list[Span] = []
            for a, b in sorted(s for _, s in sure):
                if taken and a < taken[-1][1]:
                    taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
                else:
                    taken.append((a, b))
            for _, kind, (a, b) in ranked:
                at = bisect_left(taken, (b,))
                if not at or taken[at - 1][1] <= a:
                    taken.insert(at, (a, b))
                    every[kind].append((a, b))
        return base, {k: sorted(v) for k, v in every.items()}


def _calibrate(margins: np.ndarray, truth: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the held-out margins, each seen `n` times."""
    slope, shift = 1.0, 0.0
    right, wrong = n[truth > 0].sum(), n[truth == 0].sum()
    target = np.where(truth > 0, (right + 1) / (right + 2), 1 / (wrong + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        w, off = n * np.maximum(p * (1 - p), 1e-6), n * (p - target)
        grad = np.array([(off * margins).sum(), off.sum()])
        hess = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-3]])
        slope, shift = np.array([slope, shift]) - np.linalg.solve(hess, grad)
    return float(slope), float(shift)


def train(docs: DataFrame) -> Scorer:
    """Trees, calibration and thresholds from the examples of all documents."""
    marked = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("_h", F.xxhash64("doc_id"))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, text in zip(batch.column("_h").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [(h // 1_000_000 % 2 != 0, *row) for row in examples(h, text)]
            names, types = ["learn", "kind", "start", "x", "label"], [pa.bool_(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    every = marked.select("_h", "text").mapInArrow(propose, "learn boolean, kind string, start long, x array<double>, label double")
    rows = materialize(every.groupBy("learn", "kind", "x", "label").agg(F.count(F.lit(1)).alias("n")), "pii-examples")
    sizes = {r["learn"]: r for r in rows.groupBy("learn").agg(F.sum("n").alias("n"), F.count_distinct("label").alias("labels")).collect()}
    if any(half not in sizes or sizes[half]["n"] < 50 or sizes[half]["labels"] < 2 for half in (True, False)):
        return Scorer()
    # One task takes them, sorted: they are few, and sums run in the same order each time.
    frame = rows.where("learn").coalesce(1).sortWithinPartitions("x", "label").select(
        array_to_vector("x").alias("v"), "label", F.col("n").cast("double").alias("n"))
    model = GBTClassifier(featuresCol="v", labelCol="label", weightCol="n", maxIter=30, maxDepth=5, maxBins=32, seed=7).fit(frame)
    scorer = Scorer(_trees(model))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = [math.floor(scorer.margin(x.tolist()) * STEPS) for x in matrix(batch.column("x"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), pa.array(steps, pa.int64()), batch.column("label"), batch.column("n")], names=["kind", "step", "label", "n"])

    # A margin has a few thousand steps, however many examples there are.
    judged = rows.where("NOT learn").select("kind", "x", "label", "n").mapInArrow(judge, "kind string, step long, label double, n long")
    test = judged.groupBy("kind", "step", "label").agg(F.sum("n").alias("n")).orderBy("kind", "step", "label").toArrow()
    margins, truth, n = test["step"].to_numpy() / STEPS, test["label"].to_numpy(), test["n"].to_numpy()
    kinds = np.array(test["kind"].to_pylist())
    scorer.slope, scorer.shift = _calibrate(margins, truth, n)
    sure = 1 / (1 + np.exp(-np.clip(scorer.slope * margins + scorer.shift, -50, 50)))
    for kind in KINDS:
        own = kinds == kind
        # From the largest score down; a step counts whole, right and wrong ones.
        scores, at = np.unique(-sure[own], return_inverse=True)
        right = np.cumsum(np.bincount(at, (n * truth)[own])) / np.cumsum(np.bincount(at, n[own])) if len(scores) else np.zeros(0)
        good = np.flatnonzero(right >= PRECISION)
        # The least score at which the candidates from there up are right often enough; never below one half.
        scorer.thresholds[kind] = max(0.5, float(-scores[good[-1]])) if len(good) else 2.0
    del test
    pa.default_memory_pool().release_unused()
    return scorer


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def find_pii(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """Rows of doc_id, numbers of base spans per kind, base_sha256, spans (base and added), n_added."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, every = scorer.spans(text or "")
                out.append((*[len(base[k]) for k in KINDS], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every),
                            sum(map(len, every.values())) - sum(map(len, base.values()))))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[i] for r in out], t) for i, t in enumerate(types)]],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """All rows and columns, with each span of the text replaced by its kind; overlapping spans become one."""

    def clean(text: str) -> str:
        every = sorted((a, b, k) for k, spans in scorer.spans(text)[1].items() for a, b in spans)
        out, done = [], 0
        for a, b, kind in every:
            if a >= done:
                out += [text[done:a], f"[{kind.upper()}]"]
            done = max(done, b)
        return "".join([*out, text[done:]])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else clean(t) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(replace, T.StructType(docs.schema.fields))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return find_pii(docs, train(docs))

"""Mixing to target weights: soft domains, and document rates by projected-gradient least squares.

Everything here is DataFrame operations and SQL functions. The domains are those of a labelled
table; a naive Bayes classifier over the words that tell them apart gives every document a chance
for each domain, and rates are fitted so that the expected tokens of each domain meet its target.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import hashed_share
from .shared import LOCATOR, located, text_of, unpacked, work_folder, written

#: Labelled rows the classifier is fitted on, first by a hash of doc_id.
SAMPLE_ROWS = 8000
#: Words that tell domains apart; they are broadcast, so their number is fixed.
FEATURES = 4096
#: Rows of a word's domain that are added to each count.
SMOOTHING = 0.5
#: A word must occur in so many labelled rows.
LEAST_ROWS = 3
#: And must tell domains apart by so much that chance would bring so many of all words tried there.
CHANCE_WORDS = 10
#: And so much of its shares of all domains' rows must be one domain's.
PURE = 0.8
#: Weights of leaving rates at 1, against that of the targets: the last is the fit's, the ones before
#: only lead there, since far from the optimum steps at a light weight have to be very short.
RIDGES = (1e-2, 1e-3, 1e-4, 1e-5, 1e-6)
#: Largest slope towards a domain's target, as a share of all target tokens, that ends the fit,
#: and that ends it at a weight on the way.
CLOSE, NEAR = 1e-5, 1e-3
#: A domain with a smaller share of all tokens counts as absent: no repetition meets its target.
ABSENT = 1e-9
#: Most copies of a document that the registered query and the pipeline make for a scarce domain.
MOST_COPIES = 8.0


@dataclass(frozen=True)
class Domain:
    """A domain of the labelled table: its name, an SQL condition on a label row, its weight."""

    name: str
    condition: str
    weight: float


DOMAINS = (
    Domain("clean", "quality = 1 AND toxic = 0", 0.96),
    Domain("toxic", "toxic = 1", 0.02),
    Domain("low", "quality = 0 AND toxic = 0", 0.02),
)


def all_words(text: Column) -> Column:
    """The words of a text in lower case; an empty string stands where it starts or ends with space."""
    return F.split(F.lower(text), r"\s+")


def labelled(docs: DataFrame, labels: DataFrame, domains: tuple[Domain, ...], rows: int) -> DataFrame:
    """``doc_id, text, domain`` of a sample of at most ``rows`` documents with a known domain.

    Label rows without a domain (null labels too) and null identifiers are left out; of several
    label rows the first domain counts.
    """
    named = F.coalesce(*[F.when(F.expr(d.condition), F.lit(k)) for k, d in enumerate(domains)])
    known = labels.select("doc_id", named.alias("domain")).dropna().groupBy("doc_id").agg(
        F.min("domain").alias("domain"))
    known = known.filter(hashed_share(rows, known.count()))
    present = docs.select("doc_id").join(known, "doc_id").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return (
        docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    )


def classifier(sample: DataFrame, domains: tuple[Domain, ...], folder: str, features: int = FEATURES) -> tuple[DataFrame, list[float]]:
    """Words with their log-odds for each domain, and the domains' log chances without any of them.

    A word is chosen by how far its rows per domain are from independence (chi-squared, with one
    added to the expected counts), if it is pure: its share of one domain's rows is at least ``PURE`` of its
    shares of all domains' rows together. Words that all domains use, if unevenly, so tell nothing.
    The least chi-squared follows from the number of words tried: chance brings about exp(-x / 2) of
    them to x (two degrees of freedom), and at most ``CHANCE_WORDS`` of all may get there by chance.
    Presence and absence count: the log-odds are log(s / (1 - s)) of the word's share s of a
    domain's rows, and the sum of log(1 - s) over all words goes to the domain's prior.
    """
    totals = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = sum(totals.values())
    size = [totals.get(k, 0) for k in range(len(domains))]
    prior = [math.log((s + SMOOTHING) / (n + SMOOTHING * len(domains))) for s in size]
    counts = [F.count_if(F.col("domain") == k).alias(f"n{k}") for k in range(len(domains))]
    words = sample.select("domain", F.explode(F.array_distinct(all_words(F.col("text")))).alias("word")).filter("word <> ''")
    per_word = words.groupBy("word").agg(F.count("*").alias("rows"), *counts).filter(F.col("rows") >= LEAST_ROWS)

    def share(k: int) -> Column:
        return (F.col(f"n{k}") + SMOOTHING * F.col("rows") / max(n, 1)) / (size[k] + 2 * SMOOTHING)

    every = F.col("rows") / max(n, 1)
    expected = [every * s for s in size]
    chi = sum(
        ((F.col(f"n{k}") - e) ** 2 / (e + 1) for k, e in enumerate(expected) if size[k]),
        F.lit(0.0))
    every_share = sum((share(k) for k in range(len(domains))), F.lit(0.0))
    pure = F.greatest(*[share(k) for k in range(len(domains))], F.lit(0.0)) >= PURE * every_share
    odds = [F.log(share(k) / (1 - share(k))).alias(f"w{k}") for k in range(len(domains))]
    absent = [F.log(1 - share(k)).alias(f"a{k}") for k in range(len(domains))]
    tried = written(per_word, f"{folder}/tried")
    least = 2 * math.log(max(tried.count() / CHANCE_WORDS, 1.0))
    chosen = tried.withColumn("chi", chi).filter((F.col("chi") >= least) & pure)
    chosen = chosen.orderBy(F.desc("chi"), "word").limit(features)
    words = written(chosen.select("word", *odds, *absent), f"{folder}/features")
    without = words.agg(*[F.sum(f"a{k}").alias(f"a{k}") for k in range(len(domains))]).first()
    prior = [p + (without[f"a{k}"] or 0.0) for k, p in enumerate(prior)]
    return words.drop(*[f"a{k}" for k in range(len(domains))]), prior


def posteriors(docs: DataFrame, words: DataFrame, prior: list[float]) -> DataFrame:
    """``doc_id``, place, ``n_tokens`` and ``p0 .. pk``: the domains' chances of every row.

    Whole texts are read once; a word counts once a document. The words' table is broadcast (its
    size is fixed), and rows are summed within the task that read them before they are shuffled.
    """
    cut = docs.select("doc_id", *LOCATOR, all_words(text_of(docs)).alias("cut"))
    edges = (F.col("cut")[0] == "").cast("int") + ((F.size("cut") > 1) & (F.element_at("cut", -1) == "")).cast("int")
    # the words are counted before they become rows
    rows = cut.select("doc_id", *LOCATOR, (F.size("cut") - edges).alias("n_tokens"), F.array_distinct("cut").alias("cut"))
    rows = rows.select("doc_id", *LOCATOR, "n_tokens", F.explode("cut").alias("word"))
    n = len(prior)
    known = rows.join(F.broadcast(words), "word", "left").groupBy(*LOCATOR).agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").cast("long").alias("n_tokens"),
        *[(F.sum(F.coalesce(f"w{k}", F.lit(0.0))) + prior[k]).alias(f"s{k}") for k in range(n)])
    top = F.greatest(*[F.col(f"s{k}") for k in range(n)]) if n > 1 else F.col("s0")
    total = sum((F.exp(F.col(f"s{k}") - top) for k in range(n)), F.lit(0.0))
    return known.select(
        "doc_id", *LOCATOR, "n_tokens",
        *[(F.exp(F.col(f"s{k}") - top) / total).alias(f"p{k}") for k in range(n)])


def fit_rates(chances: DataFrame, weights: list[float], tokens: float | None, most: float | None = None) -> Column:
    """The rate of every row as an expression over ``p0 .. pk``.

    Rates 0 <= r (<= ``most``) minimise the sum over domains of (expected tokens - target)^2 / mass,
    where a domain's expected tokens are the sum of r n p and its mass that of n p, and, the last of
    ``RIDGES`` times as important, the changes n (r - 1)^2. At the minimum a projected gradient step changes
    nothing: r is 1 - sum p_k y_k, cut off at 0 and ``most``, with y_k the domain's miss over
    that ridge times its mass. So a number per domain tells all rates. Each step moves these against the
    gradient, scaled by the curvature over the rows that aren't cut off, and is halved until it
    descends; it is one aggregate over the narrow table, and only sums over domains reach the
    driver. The numbers are first brought near the optimum of heavier ridges, from which few steps
    are left also where targets can't be met and the numbers are large. The steps end when the gradient vanishes, so targets are met within ``CLOSE`` of all
    tokens, or can't be met by any rates.

    ``tokens`` is the total to aim at. By default the domain with the largest weight keeps its
    mass, the others are brought to their weights beside it, and one that has less than its share
    keeps what it has. With ``most`` the targets stay as given, so a scarce domain's documents are
    repeated, and ``reached`` tells how far its weight is met.
    """
    n = len(weights)
    share = [w / sum(weights) for w in weights]
    first = chances.agg(*[F.sum(F.expr(f"p{k} * n_tokens")).alias(f"m{k}") for k in range(n)]).first()
    mass = [first[f"m{k}"] or 0.0 for k in range(n)]
    if tokens is None:
        lead = share.index(max(share))
        total = mass[lead] / share[lead]
        target = [s * total if most else min(s * total, m) for s, m in zip(share, mass, strict=True)]
    else:
        total = tokens
        target = [s * total for s in share]
    live = [k for k in range(n) if mass[k] > ABSENT * sum(mass)]
    if not live:
        return F.lit(1.0)
    live_mass, aim = np.array([mass[k] for k in live]), np.array([target[k] for k in live])

    def at(y: np.ndarray, ridge: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Value, gradient and curvature of the convex function of y whose minimum is sought."""
        moved = sum((F.col(f"p{k}") * float(v) for k, v in zip(live, y, strict=True)), F.lit(0.0))
        rows = chances.withColumn("z", moved).withColumn("r", _cut(F.lit(1.0) - F.col("z"), most))
        free = (F.col("r") > 0) & (F.col("r") < most if most else F.lit(True))
        # the most that r (1 - z) - r^2 / 2 can be within the bounds; its slope in z is -r
        sums = rows.agg(
            F.sum(F.expr("n_tokens * (r * (1 - z) - r * r / 2)")).alias("v"), *[F.sum(F.expr(f"r * p{k} * n_tokens")).alias(f"e{k}") for k in live],
            *[F.sum(F.when(free, F.expr(f"p{j} * p{k} * n_tokens"))).alias(f"h{j}_{k}") for j in live for k in live],
        ).first()
        have = np.array([sums[f"e{k}"] or 0.0 for k in live])
        curve = np.array([[sums[f"h{j}_{k}"] or 0.0 for k in live] for j in live])
        return (float((sums["v"] or 0.0) + aim @ y + (ridge * y * y).sum() / 2), aim + ridge * y - have, curve + np.diag(ridge))

    y = np.zeros(len(live))
    for weight in RIDGES:
        ridge, close = weight * live_mass, CLOSE if weight == RIDGES[-1] else NEAR
        value, slope, curve = at(y, ridge)
        while np.abs(slope).max() > close * max(total, 1.0):
            scale = 1 / np.sqrt(np.diag(curve))  # so that scarce domains weigh as much
            step, length = scale * np.linalg.solve(curve * np.outer(scale, scale), scale * slope), 1.0
            while True:
                new = at(y - length * step, ridge)
                if new[0] <= value - 1e-4 * length * (slope @ step) or length < 1e-9:
                    break
                length /= 2
            if length < 1e-9:  # no further descent within the precision of the sums
                break
            y, (value, slope, curve) = y - length * step, new
    moved = sum((F.col(f"p{k}") * float(v) for k, v in zip(live, y, strict=True)), F.lit(0.0))
    return _cut(F.lit(1.0) - moved, most)


def _cut(rate: Column, most: float | None) -> Column:
    return F.greatest(F.lit(0.0), rate if most is None else F.least(F.lit(float(most)), rate))


def mix(
    docs: DataFrame, labels: DataFrame, domains: tuple[Domain, ...] = DOMAINS, tokens: float | None = None,
    sample_rows: int = SAMPLE_ROWS, folder: str | None = None, most: float | None = None,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: its domains' chances, rate and copies.

    Columns: doc_id, place (``__file``, ``__row``), n_tokens (words), ``p_<domain>``, rate, copies.
    ``copies`` is the rate rounded up or down by a hash of the row's place and doc_id, with the
    fraction as the chance of up, so copies meet the targets in expectation and every run agrees.
    ``most`` is the greatest repetition; without it no scarce domain is raised by default.

    A null text is empty: no tokens, the domains' prior chances, and a rate that the targets don't
    depend on. A null doc_id keeps its row. Repeated rows are rows of their own. Without labelled
    rows every domain is equally likely. An empty table gives no rows; further columns of either
    table are ignored.
    """
    folder = folder or work_folder(docs.sparkSession, "mixing")
    return _mixed(located(docs, folder), labels, domains, tokens, sample_rows, folder, most)


def _mixed(
    docs: DataFrame, labels: DataFrame, domains: tuple[Domain, ...], tokens: float | None, sample_rows: int,
    folder: str, most: float | None,
) -> DataFrame:
    """``mix`` for located rows."""
    sample = written(labelled(docs, labels, domains, sample_rows), f"{folder}/sample")
    words, prior = classifier(sample, domains, folder)
    chances = written(posteriors(docs, words, prior), f"{folder}/chances")
    rate = fit_rates(chances, [d.weight for d in domains], tokens, most=most)
    draw = F.pmod(F.xxhash64("doc_id", "n_tokens", *LOCATOR), F.lit(1 << 30)) / float(1 << 30)
    rated = chances.withColumn("rate", rate)
    return rated.select(
        "doc_id", *LOCATOR, "n_tokens", *[F.col(f"p{k}").alias(f"p_{d.name}") for k, d in enumerate(domains)],
        "rate", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).alias("copies"))


def reached(rated: DataFrame, domains: tuple[Domain, ...] = DOMAINS) -> DataFrame:
    """Per domain of ``mix``'s rows: requested and reached weight, tokens at rate 1 and at the rates, highest rate."""
    every = sum(d.weight for d in domains)
    sums = rated.agg(
        *[F.sum(F.expr(f"p_{d.name} * n_tokens")).alias(f"m{k}") for k, d in enumerate(domains)],
        *[F.sum(F.expr(f"rate * p_{d.name} * n_tokens")).alias(f"h{k}") for k, d in enumerate(domains)],
        *[F.max(F.when(F.col(f"p_{d.name}") >= 0.5, F.col("rate"))).alias(f"r{k}") for k, d in enumerate(domains)])
    total = sum((F.coalesce(f"h{k}", F.lit(0.0)) for k in range(len(domains))), F.lit(0.0))
    lines = [
        F.struct(F.lit(d.name).alias("domain"), F.lit(d.weight / every).alias("requested"),
                 (F.col(f"h{k}") / F.nullif(total, F.lit(0.0))).alias("reached"), F.col(f"m{k}").alias("had_tokens"),
                 F.col(f"h{k}").alias("expected_tokens"), F.col(f"r{k}").alias("highest_rate"))
        for k, d in enumerate(domains)]
    return sums.select(F.explode(F.array(*lines)).alias("d")).select("d.*")


def resample(
    docs: DataFrame, labels: DataFrame, domains: tuple[Domain, ...] = DOMAINS, tokens: float | None = None, most: float | None = None,
) -> DataFrame:
    """Each row of ``docs`` as often as ``mix`` says; columns stay as they are."""
    folder = work_folder(docs.sparkSession, "mixing")
    rows = located(docs, folder, whole=True)
    rated = _mixed(rows.drop("__all"), labels, domains, tokens, SAMPLE_ROWS, folder, most)
    changed = written(rated, f"{folder}/rated").filter("copies <> 1").select(*LOCATOR, "copies")
    many = rows.select("__all", *LOCATOR).join(changed, LOCATOR, "left").na.fill(1, ["copies"])
    return unpacked(many.filter("copies > 0").select("__all", F.explode(F.expr("sequence(1L, copies)"))))

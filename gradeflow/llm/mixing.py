"""Mixing documents to target weights of domains that are known for some of them only.

A table of labels says to which domain some documents belong. A naive Bayes classifier
over words and a few measures of a text's shape (capitals, symbols, repetition),
fitted on a bounded sample of labelled rows, gives every document a membership in each
domain. Document rates are then fitted by projected gradient least
squares: nonnegative, and such that the expected tokens of every domain meet its target.
How far they stay off it is returned with them (``miss``).

All of it is DataFrame and SQL functions. Words are told apart by 64 bits of hash; the
classifier's vocabulary is bounded, so its weights are broadcast for scoring, and a
document's log odds are summed map-side, since its words lie in one task. Memberships are rounded to 1/GRID, so rates depend on a cell of the
grid; tokens are summed by cell once, and each gradient step is one aggregation over the
cells, whose number is bounded by the grid and not by the table. The driver holds one
number per domain and step.

Null and empty texts have no tokens and the labels' prior as membership. Rows that repeat
a document are scored alike. A null doc_id is scored like others; rates are rounded by
doc_id and text together. A text of any length is one row and its distinct words; its
evidence is damped by its length. Labels of unknown documents and labels with nulls are ignored; without labels the memberships are equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import stored

#: Labelled rows that the classifier is fitted on, chosen by a hash of their doc_id.
TRAIN_ROWS = 20_000
#: Words with a weight of their own: of those that tell domains apart, the most frequent.
VOCABULARY = 1 << 17
#: Occurrences that a word needs to weigh much.
SMOOTH = 3.0
#: Log odds from which on a word tells domains apart.
CLEAR = log(2)
#: The root of the length up to which evidence counts in full.
DAMP = 8.0
GRID = 64
STEPS = 80
CLOSE = 1e-6
SPLIT = r"[\s.,;:!?()\"']+"
#: What a text's letters, digits and white space leave, and all of that but capitals.
SMALL, NO_CAPITAL = r"[\p{Ll}\p{Lo}\p{M}\p{N}\s]+", r"[^\p{Lu}]+"
#: Steps in which a measure of shape is told.
BINS = 32


def words_of(text: str = "text") -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPLIT)


def tokens_of(words: str) -> Column:
    """How many there are: a split leaves empty texts at its ends only."""
    ends = [(F.try_element_at(words, F.lit(i)) == "").cast("int") for i in (1, -1)]
    return F.when(F.size(words) > 1, F.size(words) - ends[0] - ends[1]).otherwise(1 - ends[0]).cast("long")


def key_of(word: str = "word") -> Column:
    return F.when(F.col(word) != "", F.xxhash64(word))


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


#: Columns of the steps, one for each measure of shape.
SHAPE = ["capitals", "symbols", "bars", "again", "variety"]


def shaped(texts: DataFrame) -> DataFrame:
    """``texts`` (text, all: its words) with the step of each measure of its shape, in 0 .. BINS.

    They tell what words, each counted once and in small letters, do not: the shares of
    capitals, of symbols and of bars among the characters, of words that repeat the word
    before, and the logarithm of the number of distinct words as a share of that of all
    words, which depends little on the length. Null if the text is.
    """
    # one projection after the other, so that nothing is worked out twice
    rest = texts.withColumn("rest", F.regexp_replace("text", SMALL, ""))
    size, length = F.size("all"), F.greatest(F.length("text"), F.lit(1))
    same = F.zip_with(F.slice("all", F.lit(2), size), F.col("all"), lambda x, y: x == y)
    counts = rest.select(
        *texts.columns,
        F.length(F.regexp_replace("rest", NO_CAPITAL, "")).alias("n_capitals"),
        F.length("rest").alias("n_rest"),
        F.length(F.replace(F.col("rest"), F.lit("|"))).alias("n_no_bars"),
        F.size(F.filter(same, lambda x: x)).alias("n_again"),
        F.size(F.array_distinct("all")).alias("n_distinct"),
    )
    shares = [
        F.sqrt(F.col("n_capitals") / length),
        F.sqrt((F.col("n_rest") - F.col("n_capitals")) / length),
        F.sqrt((F.col("n_rest") - F.col("n_no_bars")) / length),
        F.when(F.col("text").isNotNull(), F.sqrt(F.col("n_again") / size)),
        F.when(F.col("text").isNotNull(), F.log(F.col("n_distinct") + F.lit(1.0)) / F.log(size + F.lit(1.0))),
    ]
    return counts.select(*texts.columns, *[F.floor(x * BINS).cast("int").alias(name) for name, x in zip(SHAPE, shares, strict=True)])


# -- membership ---------------------------------------------------------------------


@dataclass
class Classifier:
    """weights: key, w0, w1, ... of the telling words; other: of all other words; priors: logs.

    shape: for each domain and measure of shape, the log odds of its steps.
    """

    weights: DataFrame
    other: list[float]
    priors: list[float]
    shape: list[list[list[float]]]


def fit(docs: DataFrame, labels: DataFrame, n_domains: int, train_rows: int = TRAIN_ROWS) -> Classifier:
    """A classifier from ``labels`` (doc_id, domain from 0).

    Words that tell domains apart have weights of their own; all others are one word in
    common, so that a text without telling words speaks against the domains that have
    many, while small differences of common words do not add up. A document counts each
    of its words once. The shape of a text is told by steps (BINS for each measure), which
    weigh by themselves and are not damped.
    """
    known = labels.where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    sample = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "labelled")
    own = [F.sum((F.col("domain") == k).cast("long")) for k in range(n_domains)]
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("domain", "text", words_of().alias("all"))
    words = texts.select("domain", F.explode(F.array_distinct("all")).alias("word"))
    counts = stored(
        words.select("domain", key_of().alias("key"))
        .where("key IS NOT NULL")
        .groupBy("key")
        .agg(*[c.alias(f"c{k}") for k, c in enumerate(own)]),
        "word-counts",
    )
    totals = [x or 0 for x in counts.agg(*[F.sum(f"c{k}") for k in range(n_domains)]).first()]
    rows = [x or 0 for x in sample.agg(*own).first()]
    every = sum((F.col(f"c{k}") for k in range(1, n_domains)), F.col("c0"))
    share = [n / max(1, sum(totals)) for n in totals]
    odds = [F.log((F.col(f"c{k}") + SMOOTH) / (every * s + SMOOTH)) for k, s in enumerate(share)]  # found against expected
    tells = F.greatest(*[F.abs(x) for x in odds], F.lit(0.0)) >= CLEAR
    found = counts.where(tells).orderBy(every.desc(), "key").limit(VOCABULARY)
    counted = [f"c{k}" for k in range(n_domains)]
    weights = stored(found.select("key", *counted, *[x.alias(f"w{k}") for k, x in enumerate(odds)]), "weights")
    told = [x or 0 for x in weights.agg(*[F.sum(c) for c in counted]).first()]
    rest = [n - x for n, x in zip(totals, told, strict=True)]
    other = [log((c + SMOOTH) / (sum(rest) * s + SMOOTH)) for c, s in zip(rest, share, strict=True)]
    shape = shape_odds(stored(shaped(texts).select("domain", *SHAPE), "shapes"), n_domains)
    return Classifier(weights.drop(*counted), other, [log((r + 1) / (sum(rows) + n_domains)) for r in rows], shape)


def shape_odds(texts: DataFrame, n_domains: int) -> list[list[list[float]]]:
    """For each domain and measure, the log odds of its steps. ``texts``: domain and SHAPE."""
    counts = np.zeros((n_domains, len(SHAPE), BINS + 1))
    known = texts.where(F.col("domain").between(0, n_domains - 1))
    for m, name in enumerate(SHAPE):
        for r in known.where(F.col(name).isNotNull()).groupBy("domain", name).count().collect():
            counts[r["domain"], m, r[name]] = r["count"]
    share = counts.sum(2, keepdims=True) / np.maximum(1, counts.sum((0, 2)))[None, :, None]
    return np.log((counts + SMOOTH) / (counts.sum(0) * share + SMOOTH)).tolist()


def memberships(docs: DataFrame, known: Classifier) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n_tokens and q0, q1, ...: memberships in units of 1/GRID.

    A long document's evidence is damped: words are not independent, and undamped sums
    would leave no membership between none and all.
    """
    priors = known.priors
    domains = range(len(priors))
    evidence = [F.when(F.col("key").isNotNull(), F.coalesce(F.col(f"w{k}"), F.lit(known.other[k]))) for k in domains]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_hash().alias("th"), "text", words_of().alias("all"))
    rows = shaped(rows.select("row", "doc_id", "th", "text", "all", tokens_of("all").alias("n_tokens")))
    odds = [[F.get(F.array(*map(F.lit, odds)), F.col(name)) for name, odds in zip(SHAPE, known.shape[k], strict=True)] for k in domains]
    looks = [sum((F.coalesce(x, F.lit(0.0)) for x in odds[k]), F.lit(0.0)).alias(f"h{k}") for k in domains]
    keys = ["row", "doc_id", "th", "n_tokens", *[f"h{k}" for k in domains]]
    rows = rows.select("row", "doc_id", "th", "n_tokens", *looks, "all")
    words = rows.select(*keys, F.explode(F.array_distinct("all")).alias("word"))
    scored = (
        words.select(*keys, key_of().alias("key"))
        .join(F.broadcast(known.weights), "key", "left")
        .groupBy(*keys)
        .agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(f"s{k}") for k, x in enumerate(evidence)])
    )
    damped = F.greatest(F.lit(1.0), F.sqrt("n_tokens") / DAMP)
    score = [F.col(f"s{k}") / damped + F.col(f"h{k}") + priors[k] for k in domains]
    scored = scored.select("doc_id", "th", "n_tokens", *[x.alias(f"x{k}") for k, x in enumerate(score)])
    top = F.greatest(*[F.col(f"x{k}") for k in domains]) if len(priors) > 1 else F.col("x0")
    scored = scored.select("doc_id", "th", "n_tokens", *[F.exp(F.col(f"x{k}") - top).alias(f"e{k}") for k in domains])
    total = sum((F.col(f"e{k}") for k in domains[1:]), F.col("e0"))
    parts = [F.floor(F.col(f"e{k}") / total * GRID).cast("int") for k in domains[1:]]
    first = F.lit(GRID) - sum(parts[1:], parts[0]) if parts else F.lit(GRID)
    return scored.select("doc_id", "th", "n_tokens", *[x.cast("int").alias(f"q{k}") for k, x in enumerate([first, *parts])])


# -- rates --------------------------------------------------------------------------


def rate(steps: list[tuple[list[float], float]], part: str = "r") -> Column:
    """The rate (or the look-ahead point ``z``) of a document after some steps.

    Rates start at one. A step subtracts the gradient, which is the same linear function
    of the membership for all documents, and projects on the nonnegative numbers.
    """
    if not steps:
        return F.lit(1.0)
    domains = range(len(steps[0][0]))
    history = ", ".join(f"named_struct('b', {b!r}D, " + ", ".join(f"'g{k}', {g[k]!r}D" for k in domains) + ")" for g, b in steps)
    slope = " + ".join(f"h.g{k} * q{k}" for k in domains)
    new = f"greatest(0D, s.z - ({slope}) / {GRID}D)"
    return F.expr(
        f"aggregate(array({history}), named_struct('r', 1D, 'z', 1D), "
        f"(s, h) -> named_struct('r', {new}, 'z', (1D + h.b) * {new} - h.b * s.r)).{part}"
    )


def fit_rates(scored: DataFrame, targets: list[float]) -> list[tuple[list[float], float]]:
    """The steps of the descent (``descent``) for documents with q0, q1, ... and n_tokens."""
    return descent(scored, targets)[0]


def descent(scored: DataFrame, targets: list[float]) -> tuple[list[tuple[list[float], float]], float]:
    """The steps of an accelerated projected gradient descent to the targets' shares.

    Beside them, how far the rates are off: the largest difference between a domain's
    expected share of the tokens and its target, zero if there are no tokens. It is small
    unless the descent ran out of steps or nonnegative rates can't meet the targets.
    Minimises the sum over domains of (expected share - target) ** 2 / expected share at
    rate one; the weights make domains of unlike size converge at one pace. Gradients are
    taken in the metric of the documents' tokens.
    """
    domains = range(len(targets))
    cells = stored(
        scored.where("n_tokens > 0").groupBy(*[f"q{k}" for k in domains]).agg(F.sum("n_tokens").cast("double").alias("tokens")),
        "cells",
    )
    pairs = [F.sum(F.col("tokens") * F.col(f"q{i}") * F.col(f"q{j}")) / GRID**2 for i in domains for j in domains]
    first = cells.agg(F.sum("tokens"), *[F.sum(F.col("tokens") * F.col(f"q{k}")) / GRID for k in domains], *pairs).first()
    if not first[0]:
        return [], 0.0
    total = first[0]
    share = np.array(first[1 : 1 + len(targets)]) / total
    gram = np.array(first[1 + len(targets) :]).reshape(len(targets), -1) / total
    wanted = np.array(targets) / sum(targets)
    met = share > 0  # a domain that no document belongs to cannot be met
    scale = np.where(met, 1 / np.where(met, share, 1), 0)
    half = np.sqrt(scale)
    pace = 1 / np.linalg.eigvalsh(gram * half[:, None] * half[None, :]).max()
    steps: list[tuple[list[float], float]] = []
    momentum, last = 1.0, np.inf
    while True:
        z, r = rate(steps, "z"), rate(steps, "r")
        reached = cells.select("tokens", *[f"q{k}" for k in domains], z.alias("z"), r.alias("r")).agg(
            *[F.sum(F.col("tokens") * F.col(f"q{k}") * F.col("z")) for k in domains],
            *[F.sum(F.col("tokens") * F.col(f"q{k}") * F.col("r")) for k in domains],
        ).first()
        at_z, at_r = np.array(reached).reshape(2, -1) / (GRID * total)
        if len(steps) == STEPS or np.abs(np.where(met, at_r - wanted, 0)).max() < CLOSE:
            break
        miss = float((scale * (at_r - wanted) ** 2).sum())
        if miss > last:  # the look-ahead has overshot: begin anew from here
            momentum = 1.0
        if abs(last - miss) < CLOSE**2:
            break
        last = miss
        following = (1 + sqrt(1 + 4 * momentum**2)) / 2
        steps.append(((pace * scale * (at_z - wanted)).tolist(), (momentum - 1) / following))
        momentum = following
    return steps, float(np.abs(at_r - wanted).max())


def copies(rate_column: str = "rate") -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash of its id and text.

    Documents without doc_id thus round by their texts; rows equal in both round alike.
    """
    share = F.pmod(F.xxhash64("doc_id", "th", F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    return F.floor(F.col(rate_column) + share).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, targets: list[float]) -> DataFrame:
    """doc_id, th, n_tokens, q0.., rate, miss and copies of every row of ``docs``.

    Documents that belong mainly to a domain of target 0 are not taken, whatever their rate.
    """
    scored = stored(memberships(docs, fit(docs, labels, len(targets))), "memberships")
    steps, miss = descent(scored, targets)
    found = scored.withColumn("rate", rate(steps)).withColumn("miss", F.lit(miss)).withColumn("copies", copies())
    for k in (k for k, target in enumerate(targets) if target == 0):
        found = found.withColumn("copies", F.when(F.col(f"q{k}") > GRID // 2, F.lit(0)).otherwise(F.col("copies")))
    return found


def resampled(docs: DataFrame, labels: DataFrame, targets: list[float], keep: Sequence[int] = ()) -> DataFrame:
    """``docs`` with every row as often as its rate says; columns as they are.

    Documents that belong mainly to a domain in ``keep`` are taken once at least, whatever
    share of the others' membership they have.
    """
    scored = mixed(docs, labels, targets)
    for k in keep:
        own = F.col(f"q{k}") > GRID // 2
        scored = scored.withColumn("copies", F.when(own, F.greatest("copies", F.lit(1))).otherwise(F.col("copies")))
    found = scored.select("doc_id", "th", "copies").distinct()
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").alias("d"), text_hash().alias("t"))
    both = keyed.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th")))
    times = F.explode(F.array_repeat(F.lit(True), F.col("copies")))
    return both.select("row", times.alias("taken")).select("row.*")

"""Mixing documents to target domain weights by soft membership. DataFrame operations and the DataFrame-based ML library only."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import shares, stage

#: Labelled rows that the classifier is fitted on, about: a hash draws them by label where there are more, weighted back to all.
TRAIN_ROWS = 20_000
FEATURES = 4096
#: Words that count as independent evidence; posteriors of longer texts are tempered to so many.
EVIDENCE = 50.0
STEPS = 40
TOLERANCE = 1e-4
#: A difference from the targets, as a share of the budget, that is worth a warning.
MISSED = 0.01
#: Domains, each of which adds to the plan and to the model; more of them are an error.
MAX_DOMAINS = 200


def _words() -> Column:
    return F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def posteriors(docs: DataFrame, labelled: DataFrame, label: str, train_rows: int = TRAIN_ROWS) -> tuple[DataFrame, list[str]]:
    """``(doc_id, n_tokens, p array<double>)`` for each row of ``docs(doc_id, text)``, and the domains in the order of p.

    A multinomial naive Bayes over hashed words is fitted on about ``train_rows`` of ``labelled(doc_id, text, <label>)``
    with a label, drawn by label with all rows of rare ones; all words of a text count. A label without a drawn row gets zero. Tempering divides the log-likelihood of a text beyond EVIDENCE words by its
    length over EVIDENCE. Null and empty texts have no token and the prior. Without labelled rows there is one domain.
    """
    known = labelled.where(F.col(label).isNotNull()).select("doc_id", "text", F.col(label).cast("string").alias("domain"))
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().limit(MAX_DOMAINS + 1).collect()}
    if len(counts) > MAX_DOMAINS:
        raise ValueError(f"{label} has more than {MAX_DOMAINS} values")
    domains = sorted(counts)
    words = docs.select("doc_id", _words().alias("words"))
    if not domains:
        return words.select("doc_id", F.size("words").cast("long").alias("n_tokens"), F.array(F.lit(1.0)).alias("p")), [""]
    share = shares(counts, train_rows)
    unit = F.pmod(F.xxhash64("doc_id", "text", F.lit("train")), F.lit(1_000_000_000)) / 1e9
    own = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("domain")]
    drawn = known.withColumn("share", own).where(unit < F.col("share"))
    held = sorted(r["domain"] for r in drawn.select("domain").distinct().collect()) if min(share.values()) < 1 else domains
    if not held:  # rows so few and alike that the hash left none
        drawn, held = known.withColumn("share", F.lit(1.0)), domains
    # classes are numbered over the labels that the sample holds
    index = F.create_map(*[F.lit(x) for i, d in enumerate(held) for x in (d, float(i))])[F.col("domain")]
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES)
    train = hashed.transform(drawn.select(_words().alias("words"), index.alias("label"), (1 / F.col("share")).alias("weight"))).select("features", "label", "weight")
    model = NaiveBayes(smoothing=0.5, weightCol="weight").fit(train)
    raw = vector_to_array("rawPrediction")
    n = F.size("words")
    scored = model.transform(hashed.transform(words)).select("doc_id", n.cast("long").alias("n_tokens"), F.transform(raw, lambda x: x / F.greatest(F.lit(1.0), n / EVIDENCE)).alias("l"))
    top = scored.select("doc_id", "n_tokens", F.transform("l", lambda x: F.exp(x - F.array_max("l"))).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    p = F.transform("e", lambda x: x / total)
    if held != domains:
        p = F.array(*[F.get(p, F.lit(held.index(d))) if d in held else F.lit(0.0) for d in domains])
    return top.select("doc_id", "n_tokens", p.alias("p")), domains


def _rate(p: Column, gradients: list[list[float]]) -> Column:
    """The rate after projected steps along the given gradients, from rate one."""
    rate = F.lit(1.0)
    for g in gradients:
        move = reduce(lambda a, b: a + b, [F.get(p, i) * v for i, v in enumerate(g)])
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


@dataclass(frozen=True)
class Fit:
    """What a mixture was to reach and reaches: tokens by domain, and the largest difference as a share of the budget."""

    target: dict[str, float]
    reached: dict[str, float]
    off: float
    steps: int


def fit_rates(members: DataFrame, domains: list[str], weights: dict[str, float], budget: float | None = None, steps: int = STEPS) -> tuple[DataFrame, Fit]:
    """``members(doc_id, n_tokens, p)`` with ``rate``, nonnegative, so that expected domain token totals match the targets.

    Targets are ``budget`` tokens, by default those of the input, dealt by ``weights`` over the domains that have mass; domains
    without a weight get none. The objective is the sum of squared relative residuals, each domain's weighted by its mass. In
    the metric that weights documents by tokens its gradient at a document is p times the residuals, and a step of one
    never overshoots. A step's residuals are one distributed sum over all documents; the rates themselves stay in the
    cluster, as a function of the few residual vectors. Steps end when residuals are within TOLERANCE of the budget or
    stop shrinking. Targets can be out of reach, as where each document belongs a little to every domain; then the rates are
    those of the least residual found, the :class:`Fit` says how far off they are, and a difference over MISSED is a warning.
    """
    k = range(len(domains))
    mass = lambda rate: [F.sum(rate * F.col("n_tokens") * F.get("p", F.lit(i))).alias(f"s{i}") for i in k]
    sums = lambda gradients: [x or 0.0 for x in members.agg(*mass(_rate(F.col("p"), gradients))).first()]
    own = sums([])
    asked = [max(0.0, weights.get(d, 0.0)) if m > 0 else 0.0 for d, m in zip(domains, own, strict=True)]
    total = budget if budget is not None else sum(own)
    target = [total * a / (sum(asked) or 1.0) for a in asked]
    away = lambda now: max((abs(s - t) for s, t in zip(now, target, strict=True)), default=0.0) / (total or 1.0)
    gradients, now = [], own
    best = (away(own), 0, own)
    while best[0] > TOLERANCE and len(gradients) < steps:
        gradients.append([(s - t) / m if m > 0 else 0.0 for s, t, m in zip(now, target, own, strict=True)])
        now = sums(gradients)
        if away(now) > best[0] * 0.999:
            break
        best = (away(now), len(gradients), now)
    off, taken, reached = best
    dealt = dict(zip(domains, asked, strict=True))
    if total and (off > MISSED or any(w > 0 and not dealt.get(d) for d, w in weights.items())):
        warnings.warn(f"the mixture is {off:.2%} of the budget off its targets, or a domain of them has no documents", stacklevel=2)
    found = Fit(dict(zip(domains, target, strict=True)), dict(zip(domains, reached, strict=True)), off, taken)
    return members.withColumn("rate", _rate(F.col("p"), gradients[:taken])), found


def mix(docs: DataFrame, labelled: DataFrame, label: str, weights: dict[str, float], budget: float | None = None) -> DataFrame:
    """``(doc_id, n_tokens, domain, p, rate, target, reached)`` for each row of ``docs``; ``domain`` is the likeliest, with the tokens
    asked for it and expected of it. Empty input gives none."""
    rows, domains = posteriors(docs, labelled, label)
    members = stage(rows, "members")
    out, found = fit_rates(members, domains, weights, budget)
    best = F.array_position("p", F.array_max("p")).cast("int")
    per = lambda x: F.element_at(F.array(*[F.lit(x[d]) for d in domains]), best)
    return out.select("doc_id", "n_tokens", F.element_at(F.array(*map(F.lit, domains)), best).alias("domain"), "p", "rate", per(found.target).alias("target"), per(found.reached).alias("reached"))


def draw(docs: DataFrame, rates: DataFrame, seed: int = 0) -> DataFrame:
    """``docs``, each row as often as its rate says: the whole part always, once more with the rest as probability.

    Draws come from a hash of doc_id, so they don't change with partitions. Rows of equal doc_id, also of null, have the mean
    of its rates and are drawn alike.
    """
    chosen = rates.groupBy(F.col("doc_id").alias("__id")).agg(F.avg("rate").alias("rate"))
    unit = (F.shiftrightunsigned(F.xxhash64(F.col("__id"), F.lit(seed)), 11).cast("double") + 0.5) * 2.0**-53
    copies = (F.floor("rate") + (unit < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    often = chosen.select("__id", copies.alias("__n")).where("__n > 0")
    columns = docs.columns
    return docs.join(often, docs["doc_id"].eqNullSafe(often["__id"])).withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*[docs[c] for c in columns])

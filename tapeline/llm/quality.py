"""Quality rules whose cutoffs come from labelled holdouts with exact binomial bounds."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import chunks

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: Rules that may reject: a rate, and the side on which documents are rejected.
RULES = {"symbol_rate": 1, "dup_line_rate": 1, "repeat_rate": 1, "word_length": 1, "short_words": -1}
#: Cutoffs proposed for each rule and stratum: quantiles of the proposing half's good documents, loosest first.
LEVELS = (1.0, 0.995, 0.99, 0.98, 0.97, 0.95)
#: A cutoff is worth a test if it rejects bad documents at this many times the rate of good ones, or more.
LIFT = 5.0
#: Strata that are judged apart. Their table is made on the driver, so more of them are an error.
MAX_STRATA = 1000

SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
DDL = ", ".join(f"{f.name} bigint" for f in SCHEMA) + ", stratum string"
SCHEMA = SCHEMA.append(pa.field("stratum", pa.string()))


def measure(raw: bytes | None, window: int = WINDOW) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    raw = raw or b""
    words = raw.split()
    chars = len(b"".join(words).decode())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    found = list(zip(*(words[i:] for i in range(window)), strict=False))
    often = Counter(found)
    if len(often) < len(found):
        until = 0
        for i, w in enumerate(found):
            if often[w] > 1:
                repeats += i + window - max(until, i)
                until = i + window
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def _measures(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for ids, texts, strata in chunks(batches, "doc_id", "text", "stratum"):
        columns = zip(*(measure(t, window) for t in texts), strict=True)
        numbers = [pa.array(x, pa.int64()) for x in (ids, *columns)]
        yield pa.RecordBatch.from_arrays([*numbers, pa.array([None if x is None else x.decode() for x in strata], pa.string())], schema=SCHEMA)


def base_stats(docs: DataFrame, stratum: str, window: int = WINDOW) -> DataFrame:
    """Counts over each whole text of ``docs(doc_id, text)``, with the column named ``stratum`` as ``stratum``.

    One row per input row; null and empty texts count nothing; other columns are ignored.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    return rows.mapInArrow(lambda it: _measures(it, window), DDL)


def base_failed() -> Column:
    """Fewer than 10 words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rates(stats: DataFrame) -> DataFrame:
    """The rates that rules look at; texts without a word have rate zero."""
    per = lambda c, n: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col(n)), F.lit(0.0))
    return stats.withColumns({
        "symbol_rate": per("n_symbols", "n_words"), "dup_line_rate": per("n_dup_lines", "n_words"),
        "repeat_rate": per("n_repeat_words", "n_words"), "word_length": per("word_chars", "n_words"), "short_words": per("word_chars", "n_words"),
    })


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, from its head until it stands."""
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0))
    out = d
    for m in range(1, 1_000_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + step * d or 1e-300)
            c = 1.0 + step / c or 1e-300
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return out
    raise ArithmeticError("the incomplete beta function doesn't settle")


def binomial_at_most(k: int, n: int, p: float) -> float:
    """The probability of at most k in n at rate p, as an incomplete beta function: no sum over k."""
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    front = exp(lgamma(n + 1) - lgamma(a) - lgamma(b) + a * log1p(-p) + b * log(p))
    return front * _fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1.0 - front * _fraction(b, a, p) / b


def binomial_upper(k: int, n: int, alpha: float) -> float:
    """Exact (Clopper-Pearson) upper confidence bound at level 1 - alpha for a rate of which k in n were seen.

    Some ten evaluations of the distribution, each of which takes steps by the root of n at most.
    """
    if n == 0 or k >= n:
        return 1.0
    wanted = log(alpha)

    def off(p: float) -> float:
        found = binomial_at_most(k, n, p)
        return (log(found) if found > 0 else -1e4) - wanted

    low, step = max(k / n, 1e-300), (k + 1) ** 0.5 / n
    high = min(1.0 - 1e-12, low + step)
    while off(high) > 0 and high < 1.0 - 1e-12:
        low, step = high, 2 * step
        high = min(1.0 - 1e-12, high + step)
    at_low, at_high = off(low) if k or low > 1e-300 else -wanted, off(high)
    for _ in range(200):
        if high - low <= 1e-13 * high or not at_high:
            break
        mid = (low * at_high - high * at_low) / (at_high - at_low)
        mid = mid if low < mid < high else (low + high) / 2
        at = off(mid)
        if at > 0:
            low, at_low, at_high = mid, at, at_high / 2
        else:
            high, at_high, at_low = mid, at, at_low / 2
    return high


def _proposals(rows: DataFrame, levels: tuple[float, ...]) -> DataFrame:
    """``(stratum, rule, cuts array, good array, bad array, n_good, n_bad)`` of the proposing half: what each cutoff rejects."""
    good = F.col("quality") == 1
    quantiles = rows.groupBy("stratum").agg(*[F.percentile_approx(F.when(good, F.col(r) * s), F.array(*map(F.lit, levels)), F.lit(10_000)).alias(f"__{r}") for r, s in RULES.items()])
    held = quantiles.limit(MAX_STRATA + 1).collect()
    if len(held) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata; name a column of fewer values")
    cuts = rows.sparkSession.createDataFrame(held, quantiles.schema)
    over = lambda r, s, i: F.col(r) * s > F.get(F.col(f"__{r}"), F.lit(i))
    counted = lambda r, s, which: F.array(*[F.count_if(which & over(r, s, i)) for i in range(len(levels))])
    per = [F.struct(F.lit(r).alias("rule"), F.first(f"__{r}").alias("cuts"), counted(r, s, good).alias("good"), counted(r, s, ~good).alias("bad")) for r, s in RULES.items()]
    found = rows.join(F.broadcast(cuts), "stratum").groupBy("stratum").agg(F.array(*per).alias("rules"), F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"))
    return found.select("stratum", "n_good", "n_bad", F.explode("rules").alias("x")).select("stratum", "n_good", "n_bad", "x.*")


def _path(rows: list, lift: float) -> list[tuple[str, float]]:
    """Cutoffs ``(rule, value)`` of a stratum in the order in which they are tested, each rule's from loose to strict.

    Those come first that reject the most bad documents for each good one. Cutoffs that add too few bad ones are skipped.
    """
    steps = []
    for r in rows:
        held = (0, 0)
        for cut, good, bad in zip(r["cuts"] or [], r["good"], r["bad"], strict=False):
            more_good, more_bad = good - held[0], bad - held[1]
            if more_bad and more_bad / r["n_bad"] >= lift * more_good / max(1, r["n_good"]):
                steps.append((more_good / more_bad, -more_bad, r["rule"], -len(steps), cut))
                held = (good, bad)
    done: list[tuple[str, float]] = []
    loosest: dict[str, float] = {}
    for _, _, rule, _, cut in sorted(steps):
        if rule not in loosest or cut < loosest[rule]:  # a looser one of the rule would add nothing
            done.append((rule, cut))
            loosest[rule] = cut
    return done


def fit(stats: DataFrame, labels: DataFrame, max_rejection: float = 0.05, alpha: float = 0.05, levels: tuple[float, ...] = LEVELS, lift: float = LIFT) -> DataFrame:
    """Cutoffs ``(stratum, step, rule, side, cutoff, rejected, holdout, bound, is_used)``, in the order of their tests.

    Documents of ``labels(doc_id, quality)`` that pass the base are halved by a hash of doc_id. The first half proposes: for each stratum a
    path of cutoffs, approximate quantiles of its good documents, of which each adds to the ones before and those come
    first that reject the most bad documents for a good one. The other half judges: after each step the good documents
    that all cutoffs so far reject are counted, and the exact binomial bound of their rate is held against
    ``max_rejection``; the first step that passes it ends the stratum (fixed-sequence testing, which needs no correction for
    the number of steps and rules, as steps are tested in an order that the judging half didn't choose). Each stratum is
    tested at alpha divided by the number of strata (Bonferroni). So with probability 1 - alpha no stratum loses more than
    ``max_rejection`` of its good documents by cutoffs. A stratum without labelled documents of both kinds has none. A
    null stratum is the stratum ''; labels that repeat a doc_id count once, those that contradict each other not at all.
    """
    known = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("__most")).where("quality = __most").drop("__most")
    rows = rates(stats).where(~base_failed()).join(known, "doc_id").select("doc_id", "stratum", "quality", *RULES)
    judging = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)) == 1
    proposed: dict[str, list] = {}
    for r in _proposals(rows.where(~judging), levels).collect():
        proposed.setdefault(r["stratum"], []).append(r)
    paths = {stratum: path for stratum, own in sorted(proposed.items()) if (path := _path(own, lift))}
    spark = stats.sparkSession
    flat = [(stratum, i, rule, RULES[rule], float(cut)) for stratum, path in paths.items() for i, (rule, cut) in enumerate(path)]
    steps = spark.createDataFrame(flat, "stratum string, step int, rule string, side int, cut double")
    # the step at which a good document is rejected first; steps has a row for each stratum and cutoff at most
    own = F.broadcast(steps.groupBy("stratum").agg(F.collect_list(F.struct("step", "rule", "side", "cut")).alias("path")))
    value = F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(r))])
    hits = F.filter("path", lambda s: value[s["rule"]] * s["side"] > s["cut"])
    judged = rows.where(judging & (F.col("quality") == 1)).join(own, "stratum").groupBy("stratum", F.array_min(F.transform(hits, lambda s: s["step"])).alias("at")).count().collect()
    n, first = Counter(), Counter()
    for r in judged:
        n[r["stratum"]] += r["count"]
        first[r["stratum"], r["at"]] += r["count"]
    out = []
    for stratum, path in paths.items():
        rejected, used = 0, True
        for i, (rule, cut) in enumerate(path):
            rejected += first[stratum, i]
            bound = binomial_upper(rejected, n[stratum], alpha / len(proposed))
            used = used and bound <= max_rejection
            out.append((stratum, i, rule, RULES[rule], float(cut * RULES[rule]), rejected, n[stratum], bound, used))
    return spark.createDataFrame(out, "stratum string, step int, rule string, side int, cutoff double, rejected bigint, holdout bigint, bound double, is_used boolean")


def judge(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``stats`` with ``base_failed`` and ``kept``: false if the base failed or a used cutoff of the stratum is passed.

    Strata without cutoffs are judged by the base alone. Each input row gives one row.
    """
    used = cutoffs.where("is_used").groupBy("stratum").agg(*[(F.min(F.when(F.col("rule") == r, F.col("cutoff") * s)) * s).alias(f"__{r}") for r, s in RULES.items()])  # the strictest
    out = rates(stats).join(F.broadcast(used), "stratum", "left")  # a row for each stratum, made on the driver by fit()
    passed = F.lit(False)
    for r, side in RULES.items():
        passed = passed | F.coalesce(F.col(r) * side > F.col(f"__{r}") * side, F.lit(False))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~passed).drop(*[f"__{r}" for r in RULES])

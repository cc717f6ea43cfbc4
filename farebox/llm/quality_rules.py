"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Only DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from farebox.llm.shared import WORD, Scratch, fresh, table

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 50, 3, 50
BLANKS = r"[\x20\x09-\x0D]+"
#: Fixed value: the counted symbols.
SYMBOLS = "[#*$%&|<>]"
#: The statistics of the vector, and the spread that none of them is taken to fall below.
#: Most clean texts have no symbol and no repeated line at all: without the floor one would be an outlier.
NOISE = {"x_length": 0.1, "x_symbols": 0.05, "x_lines": 0.15, "x_repeat": 0.15, "x_upper": 0.1}
#: Texts with few words or lines say little about shares: so many neutral ones are added.
PRIOR_WORDS, PRIOR_LINES = 10, 5
#: Groups with fewer rows are pooled by language, and small languages with each other.
MIN_GROUP = 20
#: Share of a group's rows that the determinant is minimised over, and steps at most.
HALF, STEPS = 0.5, 8
#: Chance of a larger distance in a normal population: rows beyond are rejected.
TAIL = 1e-4
BINS = 64

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a))) if x > 0 else 0.0


def chi2_cdf(x: float, dof: int) -> float:
    return _gamma_p(dof / 2, x / 2)


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float, dof: int) -> float:
    """Factor that makes the covariance of the closest ``share`` of a normal sample unbiased."""
    return share / chi2_cdf(chi2_quantile(share, dof), dof + 2)


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of ``STATS``, n_lines, n_upper and base_failed; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    # each step is a projection of its own: what a lambda refers to is then computed once a row
    out = docs.withColumns({"words_": words, "lines_": lines}).withColumns(
        {
            "n_words": F.size("words_").cast("long"),
            "word_chars": F.length(F.array_join("words_", "")).cast("long"),
            "n_symbols": (F.length(text) - without(SYMBOLS)).cast("long"),
            "n_upper": without(r"\P{Lu}+").cast("long"),
            "n_lines": F.size("lines_").cast("long"),
            "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
            "grams_": F.transform(
                "words_", lambda x, i: F.xxhash64(x, *[F.get("words_", i + k) for k in range(1, WINDOW)])
            ),
        }
    )
    full = F.slice("grams_", F.lit(1), F.greatest(F.size("grams_") - WINDOW + 1, F.lit(0)))
    out = out.withColumn("grams_", full)
    placed = F.transform("grams_", lambda x, i: F.struct(x.alias("gram"), i.alias("at")))
    out = out.withColumn("placed_", F.when(F.size(F.array_distinct("grams_")) < F.size("grams_"), F.sort_array(placed)))
    near = lambda x, i, k: F.get("placed_", i + k)["gram"].eqNullSafe(x["gram"])
    twice = F.filter("placed_", lambda x, i: ((i > 0) & near(x, i, -1)) | near(x, i, 1))
    out = out.withColumn("starts_", F.sort_array(F.transform(twice, lambda x: x["at"])))
    covered = F.transform("starts_", lambda x, i: F.coalesce(F.least(F.lit(WINDOW), F.get("starts_", i + 1) - x), F.lit(WINDOW)))
    repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    out = out.withColumn("n_repeat_words", repeat)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("words_", "lines_", "grams_", "placed_", "starts_")


def with_vector(stats: DataFrame) -> DataFrame:
    """The transformed statistics: log word length, and arc sines of the roots of shares."""
    angle = lambda part, whole, prior: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / (F.col(whole) + prior))))
    return stats.withColumns(
        {
            "x_length": F.log((F.col("word_chars") + 5.0 * PRIOR_WORDS) / (F.col("n_words") + PRIOR_WORDS)),
            "x_symbols": angle("n_symbols", "word_chars", 5 * PRIOR_WORDS),
            "x_lines": angle("n_dup_lines", "n_lines", PRIOR_LINES),
            "x_repeat": angle("n_repeat_words", "n_words", PRIOR_WORDS),
            "x_upper": angle("n_upper", "word_chars", 5 * PRIOR_WORDS),
        }
    )


def _key(level: int) -> Column:
    """Text that names a group: language and source, language, or all; nulls are a value."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    return F.concat_ws("\x1f", F.lit(str(level)), *[part(c) for c in ("lang", "source")[:level]])


def grouping(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, source, group): the group that each language and source belongs to."""
    sizes = rows.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = sizes.withColumn("small", F.when(F.col("n") < MIN_GROUP, F.col("n")).otherwise(0))
    by_lang = small.groupBy(F.col("lang").alias("lang_")).agg(F.sum("small").alias("pooled"))
    found = sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_")))
    group = F.when(F.col("n") >= MIN_GROUP, _key(2)).when(F.col("pooled") >= MIN_GROUP, _key(1)).otherwise(_key(0))
    return scratch.write(found.select("lang", "source", group.alias("group")), "groups")


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    same = F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_"))
    return rows.join(g, same, "left").drop("lang_", "source_")


def _estimate() -> list[Column]:
    """Mean and covariance of a set of rows, and how many they are."""
    names = list(NOISE)
    mean = F.array(*[F.avg(x) for x in names])
    cov = F.array(*[F.array(*[F.covar_pop(*sorted((a, b))) for b in names]) for a in names])
    return [mean.alias("mean"), cov.alias("raw"), F.count("*").alias("used")]


def _inverse(estimates: DataFrame, factor: float) -> DataFrame:
    """Adds ``inverse`` of factor * raw + noise, and ``logdet``, by sweeping every pivot."""
    names = list(NOISE)
    p = len(names)
    floor = F.array(*[F.array(*[F.lit(NOISE[a] ** 2 if a == b else 0.0) for b in names]) for a in names])
    cov = F.zip_with("raw", floor, lambda r, f: F.zip_with(r, f, lambda x, y: F.coalesce(x, F.lit(0.0)) * factor + y))
    out = estimates.withColumn("state", F.struct(cov.alias("m"), F.lit(0.0).alias("logdet")))
    for k in range(p):
        m = F.col("state.m")
        pivot = m[k][k]
        rows = []
        for i in range(p):
            row = []
            for j in range(p):
                if i == k and j == k:
                    row.append(-1 / pivot)
                elif i == k or j == k:
                    row.append(m[i][j] / pivot)
                else:
                    row.append(m[i][j] - m[i][k] * m[k][j] / pivot)
            rows.append(F.array(*row))
        out = out.withColumn("state", F.struct(F.array(*rows).alias("m"), (F.col("state.logdet") + F.log(pivot)).alias("logdet")))
    negative = F.transform(F.col("state.m"), lambda r: F.transform(r, lambda x: -x))
    return out.withColumns({"inverse": negative, "logdet": F.col("state.logdet")}).drop("state", "raw")


def _distance() -> Column:
    """Squared Mahalanobis distance of the row from the group's estimate."""
    names = list(NOISE)
    gap = [F.col(x) - F.col("mean")[i] for i, x in enumerate(names)]
    terms = [
        F.col("inverse")[i][j] * gap[i] * gap[j] * (1 if i == j else 2) for i in range(len(names)) for j in range(i, len(names))
    ]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def minimum_determinant(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(group, mean, inverse): reweighted minimum-covariance-determinant estimates.

    ``rows`` has group and the statistics. Two fixed starts (medians with absolute
    deviations, mean with covariance) go through concentration steps: the closest
    half gives the next mean and covariance, whose determinant can only fall. The
    start that ends with the smaller determinant is taken, and rows within the 97.5 %
    ellipsoid give the final estimate.

    The half is cut at a distance on a fixed logarithmic grid, found from counts of
    the grid's cells: no group is sorted or gathered, and rows at equal distance
    stay together, so reruns agree.
    """
    names = list(NOISE)
    p = len(names)
    medians = rows.groupBy("group").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"{x}_m") for x in names])
    medians = scratch.write(medians, "medians")
    apart = rows.join(medians, "group").groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"{x}_m")), 0.5, 1000).alias(f"{x}_d") for x in names],
        *[F.first(f"{x}_m").alias(f"{x}_m") for x in names],
        F.count("*").alias("used"),
    )
    diagonal = F.array(*[F.array(*[(F.col(f"{a}_d") * 1.4826) ** 2 if a == b else F.lit(0.0) for b in names]) for a in names])
    robust = apart.select("group", F.lit(0).alias("start"), F.array(*[F.col(f"{x}_m") for x in names]).alias("mean"), diagonal.alias("raw"), "used")
    plain = rows.groupBy("group").agg(*_estimate()).select("group", F.lit(1).alias("start"), "mean", "raw", "used")
    current = scratch.write(_inverse(robust.unionByName(plain), 1.0).withColumnRenamed("used", "n"), "step-0")
    factor, before = consistency(HALF, p), None
    for step in range(1, STEPS + 1):
        placed = rows.join(current, "group").withColumn("bin", F.floor(F.log(_distance() + 1e-9) * BINS))
        counts = scratch.write(placed.groupBy("group", "start", "bin").agg(F.count("*").alias("rows"), F.first("n").alias("n")), f"bins-{step}")
        below = F.sum("rows").over(Window.partitionBy("group", "start").orderBy("bin"))
        cut = counts.withColumn("below", below).where(F.col("below") >= F.ceil(F.col("n") * HALF))
        cut = scratch.write(cut.groupBy("group", "start").agg(F.min("bin").alias("cut"), F.first("n").alias("n")), f"cut-{step}")
        near = placed.drop("n").join(cut, ["group", "start"]).where("bin <= cut")
        new = near.groupBy("group", "start").agg(*_estimate(), F.first("n").alias("n"))
        current = scratch.write(_inverse(new, factor).drop("used"), f"step-{step}")
        scratch.drop(f"step-{step - 1}", f"bins-{step}", f"cut-{step}")
        total = current.agg(F.sum(F.round("logdet", 6).cast("decimal(30,6)"))).first()[0]
        if total == before:
            break
        before = total
    best = current.groupBy("group").agg(F.min_by(F.struct("mean", "inverse"), F.struct("logdet", "start")).alias("best"))
    best = scratch.write(best.select("group", "best.*"), "raw")
    near = rows.join(best, "group").where(_distance() <= chi2_quantile(0.975, p))
    final = near.groupBy("group").agg(*_estimate())
    return scratch.write(_inverse(final, consistency(0.975, p)).select("group", "mean", "inverse"), "final")


def _judged(stats: DataFrame, groups: DataFrame, estimates: DataFrame, tail: float) -> DataFrame:
    limit = chi2_quantile(1 - tail, len(NOISE))
    out = _grouped(stats, groups).join(estimates, "group", "left").withColumn("distance", _distance())
    # one comparison over both sides of the join: a filter on it is not pushed below, where each
    # reference would repeat the counting of words
    worst = F.greatest(F.coalesce("distance", F.lit(0.0)), F.col("base_failed").cast("double") * 1e300)
    return out.withColumn("kept", worst <= limit)


def _fit(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    wanted = with_vector(with_stats(docs.select("doc_id", "text", "lang", "source")).drop("text"))
    stats = scratch.write(wanted, "stats")
    groups = grouping(stats, scratch)
    rows = scratch.write(_grouped(stats.where("not base_failed"), groups).select("group", *NOISE), "rows")
    return stats, groups, minimum_determinant(rows, scratch)


def quality_rules(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts of ``STATS``, base_failed, distance and kept.

    base_failed: fewer than 50 words, or over half of the words in three-word
    windows that the text repeats. Other rows are rejected when their vector lies
    outside the ellipsoid that a normal population leaves with chance ``tail``,
    around the robust estimate of their language and source.

    Defined cases: a null or empty text has no words and fails; null language or
    source is a value of its own; groups below ``MIN_GROUP`` rows are pooled; the
    spread has a floor, so groups of equal rows have an estimate; repeated rows
    each count and each get a verdict; texts of any length are counted whole; extra columns are
    not read; no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    stats, groups, estimates = _fit(docs, scratch)
    return _judged(stats, groups, estimates, tail).select("doc_id", *STATS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps; columns of any names stay, no rows give no rows.

    The counts are taken a second time next to the text, where the few estimates
    come to the rows: cheaper than shuffling all texts to join the verdicts.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    _, groups, estimates = _fit(docs, scratch)
    whole = fresh(docs, "whole")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), "doc_id", "text", "lang", "source")
    return _judged(with_vector(with_stats(rows)), groups, estimates, tail).where("kept").select(f"{whole}.*")


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))

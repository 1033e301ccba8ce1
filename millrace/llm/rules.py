"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Per language and source, the minimum-covariance-determinant estimate of transformed statistics:
of all subsets of ``SHARE`` of the rows, the one whose covariance S, regularised as S + N, has the
least determinant. N is a diagonal, fixed for the group: the median noise with which texts of
these lengths show a statistic, so a statistic that never varies leaves no singular matrix.

*Starts.* Four, none by chance, all around the medians: no correlation; the correlations of
tanh-squashed values; of spatial signs; of the half nearest to the medians.

*Concentration.* The rows nearest by the estimate give the next one, which cannot raise the
determinant. After ``FIRST_STEPS`` steps the best ``KEPT_STARTS`` of a group go on, each until its
determinant falls no more; the least one wins.

*Verdict.* A document is an outlier by its squared Mahalanobis distance under f S + noise. f makes
S, of the nearer part only, consistent for normal rows. The noise is the document's own, by its
length, at least N: a short text needs more to stand out, and what these texts do not show they may
be too short to show.

All estimates are sums of partial aggregates, subsets are cut at a bucket of the logarithm of the
distance, and quantiles are exact over a bounded grid: reruns agree and no task holds a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.staging import stage

LEAST_WORDS = 50
SHARE = 0.75  # part of a group that the estimate rests on
FIRST_STEPS = 2
KEPT_STARTS = 2
FALL = 1e-3  # a logarithm of the determinant that falls by less has settled
SMALL = 30  # smaller groups are estimated together
#: Squared distance beyond which a document is an outlier: chi-squared of 4 degrees is larger once in 100,000 cases.
CUTOFF = 28.47
#: Fixed value for 4 statistics and a share of 0.75: 0.75 / P(chi-squared of 6 degrees <= 5.385), where P(chi-squared of 4 degrees <= 5.385) = 0.75.
CONSISTENCY = 1.486
REPEAT = 6  # words that the least repeat adds to n_repeat_words: a window of three in two places
STATS = ["s_length", "s_symbols", "s_lines", "s_repeats"]
NOISE = [f"v_{s}" for s in STATS]
GROUP = ["g_lang", "g_source"]

_WHITE = r"[\x20\x09-\x0D]+"


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) with n_words, word_chars, word_squares, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, _WHITE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("g_lang"),
        F.coalesce("source", F.lit("")).alias("g_source"),
        F.length(F.regexp_replace(text, _WHITE, "")).cast("long").alias("word_chars"),
        F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w).cast("long") * F.length(w)).alias("word_squares"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(words, lambda x: F.xxhash64(x)).alias("w"),
    )
    n = F.size("w")
    out = out.select("*", n.cast("long").alias("n_words"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")).drop("lines")
    # Windows of three words with their place, in order of their hash; equal neighbours are repeats.
    places = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(places, lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("p")))
    out = out.withColumn("windows", F.sort_array(window)).drop("w")
    m = F.size("windows")
    pairs = F.when(
        m >= 2,
        F.zip_with(F.slice("windows", 1, m - 1), F.slice("windows", 2, m - 1), lambda a, b: F.when(a.h == b.h, F.array(a.p, b.p))),
    ).otherwise(F.array().cast("array<array<int>>"))
    found = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    out = out.withColumn("at", found).drop("windows")
    k = F.size("at")
    # A window covers three words, or fewer where the next one starts earlier.
    following = F.concat(F.slice("at", 2, k), F.array(F.element_at("at", -1) + 3))
    steps = F.zip_with("at", following, lambda a, b: F.least(b - a, F.lit(3)))
    repeats = F.when(k > 0, F.aggregate(steps, F.lit(0), lambda a, b: a + b)).otherwise(0).cast("long")
    out = out.withColumn("n_repeat_words", repeats).drop("at")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def transformed(base: DataFrame) -> DataFrame:
    """The statistics that are compared, logarithm of the mean word length and square roots of shares, and the variance of each at this length.

    A share of n, counted in lots of k, has a root of variance k / 4n, whatever the share is.
    """
    per = lambda c: F.col(c) / F.col("n_words")
    return base.withColumns(
        {
            "s_length": F.log(F.greatest(per("word_chars"), F.lit(1.0))),
            "s_symbols": F.sqrt(F.col("n_symbols") / F.col("word_chars")),
            "s_lines": F.sqrt(per("n_dup_lines")),
            "s_repeats": F.sqrt(per("n_repeat_words")),
            # Words of one length still have a mean that one character more would change.
            "v_s_length": F.greatest((F.col("word_squares") * F.col("n_words") / F.col("word_chars") ** 2 - 1) / F.col("n_words"), 1 / F.col("word_chars") ** 2),
            "v_s_symbols": 1 / (4 * F.col("word_chars")),
            "v_s_lines": 1 / (4 * F.col("n_words")),
            "v_s_repeats": REPEAT / (4 * F.col("n_words")),
        }
    )


P = range(len(STATS))
LOWER = [(i, j) for i in P for j in range(i + 1)]
MEANS = [f"m_{i}" for i in P]
FLOORS = [f"n_{i}" for i in P]
MOMENTS = [*MEANS, *(f"c_{i}_{j}" for i, j in LOWER)]
FACTOR = [f"l_{i}_{j}" for i, j in LOWER]


def _sum(xs: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, xs, F.lit(0.0))


def _median(x: Column, step: float) -> Column:
    return F.percentile(F.round(x / step).cast("long"), 0.5) * step


def _bucket(distance: Column) -> Column:
    return F.round(F.log(distance + 1e-6) * 256).cast("long")


def _factored(df: DataFrame, scale: float, noise: list[str]) -> DataFrame:
    """``df`` with the Cholesky factor of ``scale`` times its covariance plus a diagonal of ``noise``, which is above zero."""
    for i, j in LOWER:
        left = scale * F.col(f"c_{i}_{j}") - _sum([F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)])
        # What is left of the diagonal is at least the noise, but for rounding.
        entry = F.sqrt(F.greatest(left, F.lit(0.0)) + F.col(noise[i])) if i == j else left / F.col(f"l_{j}_{j}")
        df = df.withColumn(f"l_{i}_{j}", entry)
    return df


def _with_distance(df: DataFrame) -> DataFrame:
    """``df`` with the squared Mahalanobis distance of its statistics by its means and factor."""
    for i, s in enumerate(STATS):
        rest = _sum([F.col(f"l_{i}_{j}") * F.col(f"z_{j}") for j in range(i)])
        df = df.withColumn(f"z_{i}", (F.col(s) - F.col(f"m_{i}") - rest) / F.col(f"l_{i}_{i}"))
    return df.withColumn("distance", _sum([F.col(f"z_{i}") ** 2 for i in P])).drop(*(f"z_{i}" for i in P), *FACTOR)


def _starts(rows: DataFrame) -> DataFrame:
    """(group, start, means, covariances, floors): four first estimates for each group, around its medians."""
    middle = rows.groupBy(GROUP).agg(
        *(_median(F.col(s), 1 / 1024).alias(f"m_{i}") for i, s in enumerate(STATS)),
        *(F.exp(_median(F.log(v), 1 / 64)).alias(f"n_{i}") for i, v in enumerate(NOISE)),
    )
    middle = stage(middle, "medians")
    away = [_median(F.abs(F.col(s) - F.col(f"m_{i}")), 1 / 1024) * 1.4826 for i, s in enumerate(STATS)]
    wide = rows.join(middle, GROUP).groupBy(*GROUP, *MEANS, *FLOORS).agg(*(a.alias(f"d_{i}") for i, a in enumerate(away)))
    scales = {f"d_{i}": F.sqrt(F.col(f"d_{i}") ** 2 + F.col(f"n_{i}")) for i in P}
    middle = stage(wide.withColumns(scales), "scales")

    def standard() -> DataFrame:
        own = rows.join(middle, GROUP).withColumns({f"z_{i}": (F.col(s) - F.col(f"m_{i}")) / F.col(f"d_{i}") for i, s in enumerate(STATS)})
        return own.withColumn("norm", F.sqrt(_sum([F.col(f"z_{i}") ** 2 for i in P])))

    half = stage(standard().groupBy(GROUP).agg(F.percentile(_bucket(F.col("norm")), 0.5).alias("half")), "halves")
    inside = _bucket(F.col("norm")) <= F.col("half")
    views = [
        lambda i: F.lit(0.0),
        lambda i: F.tanh(f"z_{i}"),
        lambda i: F.col(f"z_{i}") / F.greatest("norm", F.lit(1e-9)),
        lambda i: F.when(inside, F.col(f"z_{i}")),
    ]
    shared = [F.covar_pop(view(i), view(j)).alias(f"r_{k}_{i}_{j}") for k, view in enumerate(views) if k for i, j in LOWER]
    found = stage(standard().join(half, GROUP).groupBy(*GROUP, *MEANS, *FLOORS, *(f"d_{i}" for i in P)).agg(*shared), "correlations")

    def covariance(k: int, i: int, j: int) -> Column:
        if i == j:
            return F.col(f"d_{i}") ** 2 - F.col(f"n_{i}")
        if k == 0:
            return F.lit(0.0)
        spread = F.sqrt(F.col(f"r_{k}_{i}_{i}") * F.col(f"r_{k}_{j}_{j}"))
        # A statistic that never varies has no correlation; one short of 1 leaves the matrix regular.
        r = F.when(spread > 0, 0.99 * F.col(f"r_{k}_{i}_{j}") / spread).otherwise(0.0)
        return r * F.col(f"d_{i}") * F.col(f"d_{j}")

    start = lambda k: F.struct(F.lit(k).alias("start"), *(covariance(k, i, j).alias(f"c_{i}_{j}") for i, j in LOWER))
    return found.select(*GROUP, *MEANS, *FLOORS, F.inline(F.array(*(start(k) for k in range(len(views))))))


def _concentrate(rows: DataFrame, params: DataFrame, share: float) -> DataFrame:
    """The next estimates, of the nearest ``share`` of each group by the present ones, with the logarithm of their determinant."""
    key = [*GROUP, "start", *FLOORS]
    factored = _factored(params, 1.0, FLOORS).select(*key, *MEANS, *FACTOR)
    near = _with_distance(rows.select(*GROUP, *STATS).join(factored, GROUP)).select(*key, *STATS, _bucket(F.col("distance")).alias("bucket"))
    bound = stage(near.groupBy(*GROUP, "start").agg(F.ceil(F.percentile("bucket", share)).alias("bound")), "bounds")
    near = near.join(bound, [*GROUP, "start"]).filter("bucket <= bound")
    means = [F.avg(s).alias(f"m_{i}") for i, s in enumerate(STATS)]
    moments = near.groupBy(*key).agg(*means, *(F.covar_pop(STATS[i], STATS[j]).alias(f"c_{i}_{j}") for i, j in LOWER))
    log_det = _sum([2 * F.log(f"l_{i}_{i}") for i in P]).alias("log_det")
    return stage(_factored(moments, 1.0, FLOORS).select(*key, *MOMENTS, log_det), "estimates")


def estimate(rows: DataFrame) -> DataFrame:
    """(group, means, covariances, floors, log_det): the estimate of least determinant for each group of ``rows``."""
    params = _concentrate(rows, _starts(rows), 0.5)
    for _ in range(FIRST_STEPS):
        params = _concentrate(rows, params, SHARE)
    # Four starts to a group, so the window is small.
    best = F.row_number().over(Window.partitionBy(GROUP).orderBy("log_det", "start"))
    live = stage(params.withColumn("place", best).filter(f"place <= {KEPT_STARTS}").drop("place"), "estimates")
    settled = []
    while True:
        after = _concentrate(rows, live, SHARE)
        before = live.select(*GROUP, "start", F.col("log_det").alias("before"))
        falling = F.col("log_det") < F.col("before") - FALL
        moved = stage(after.join(before, [*GROUP, "start"]).withColumn("falling", falling).drop("before"), "moved")
        still = moved.filter("falling").drop("falling")
        settled.append(live.join(moved.filter("not falling").select(*GROUP, "start"), [*GROUP, "start"], "left_semi"))
        if still.isEmpty():
            break
        live = still
    ends = reduce(DataFrame.unionByName, settled)
    least = F.min_by(F.struct(*MOMENTS, *FLOORS, "log_det"), F.struct("log_det", "start"))
    return stage(ends.groupBy(GROUP).agg(least.alias("e")).select(*GROUP, "e.*"), "estimates")


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance).

    ``docs`` has doc_id, text, lang, source; other columns are ignored. A null text has no
    words, a null language or source counts as empty. Documents that fail the base rules
    are not kept, have no distance, and do not enter the estimates. Groups of fewer than
    ``SMALL`` documents are estimated together; if they are fewer even so, all are kept.
    Repeated rows weigh each. An empty table gives an empty result.
    """
    base = stage(base_statistics(docs), "base-statistics")
    sound = base.filter("not base_failed")
    sizes = stage(sound.groupBy(GROUP).count(), "sizes")
    rows = transformed(sound).join(sizes, GROUP)
    small = F.col("count") < SMALL
    rest = {g: F.when(small, F.lit("\u0000rest")).otherwise(F.col(g)) for g in GROUP}
    rows = stage(rows.withColumns(rest).select("doc_id", *GROUP, *STATS, *NOISE), "transformed")
    enough = stage(rows.groupBy(GROUP).count().filter(F.col("count") >= SMALL).select(*GROUP), "groups")
    params = estimate(rows.join(enough, GROUP))
    measured = rows.join(params, GROUP, "left")
    measured = measured.withColumns({f"n_{i}": F.greatest(v, f"n_{i}") for i, v in enumerate(NOISE)})
    measured = _with_distance(_factored(measured, CONSISTENCY, FLOORS))
    verdict = measured.select("doc_id", "distance").groupBy("doc_id").agg(F.max("distance").alias("distance"))
    out = base.join(verdict, "doc_id", "left")
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")

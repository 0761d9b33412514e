"""Quality rules: base limits, then robust multivariate outliers.

Every document gets a vector of transformed text statistics.  For each
(lang, source) group a minimum-covariance-determinant estimate of centre and
scatter is made from all its documents: starting from medians and absolute
deviations, concentration steps keep the half of the documents with the
smallest Mahalanobis distances and re-estimate from them.  Each step is one
distributed aggregate (sums and sums of products per group), so no group is
ever gathered.  Documents beyond ``cutoff`` (squared distance, chi-square
scale) are rejected.  Groups with fewer than ``min_group`` usable documents
use the estimate of their language, failing that of the whole corpus, and
failing that reject nothing.

Edge cases: null and empty texts have zero words and fail the base rule; null
lang or source is a group of its own; repeated rows count as often as they
occur; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import annotate, shared_dir, written
from starlane.llm.components import if_small
from starlane.llm.textscan import SPACED, Scan, mix, span_hashes

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
         "n_repeat_words bigint, n_lines bigint, n_upper bigint, n_marks bigint, n_digits bigint")

# Smallest standard deviation of each transformed statistic: statistics that
# are constant in clean text (no symbols, no repeats) stay invertible.
FEATURES = {
    "log_words": ("ln(n_words + 1)", 0.30),
    "word_length": ("word_chars / n_words", 0.15),
    "symbol_rate": ("ln(1 + 20D * n_symbols / n_words)", 0.25),
    "dup_line_rate": ("n_dup_lines / greatest(n_lines, 1)", 0.05),
    "repeat_rate": ("n_repeat_words / n_words", 0.05),
    "upper_rate": ("n_upper / word_chars", 0.02),
    "mark_rate": ("ln(1 + 20D * n_marks / n_words)", 0.25),
    "digit_rate": ("n_digits / word_chars", 0.04),
}
H_FRACTION = 0.5
C_STEPS = 4
MIN_GROUP = 100
# Squared robust distance beyond which a document is rejected: far beyond the
# 0.9999 quantile of chi-square (31.8 for 8 statistics), since real statistics
# have heavier tails than normal ones.
CUTOFF = 80.0


def text_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of every whole text."""

    def scorer():
        symbol = np.zeros(256, dtype=bool)
        symbol[list(SYMBOLS)] = True
        mark = np.zeros(256, dtype=bool)
        mark[list(b"!?")] = True

        def score(texts):
            scan = Scan(texts, SPACED)
            raw, docs_n = scan.raw, len(texts)

            def counted(flags):
                total = np.zeros(len(raw) + 1, dtype=np.int64)
                np.cumsum(flags, out=total[1:])
                return total[scan.end] - total[scan.begin]

            # lines: cut at \n; the newline after each text ends its last line
            line_end = np.flatnonzero(raw == 10)
            line_start = np.concatenate(([0], line_end[:-1] + 1))
            line_doc = np.searchsorted(scan.begin, line_start, side="right") - 1
            words_before = np.zeros(len(raw) + 1, dtype=np.int64)
            np.cumsum(scan.inside, out=words_before[1:])
            worded = words_before[line_end] > words_before[line_start]
            hashes = span_hashes(raw, line_start[worded], line_end[worded])
            tagged = mix(hashes + mix(line_doc[worded].astype(np.uint64) + np.uint64(1)))
            _, where = np.unique(tagged, return_index=True)
            distinct = np.bincount(line_doc[worded][where], minlength=docs_n)
            lines = np.bincount(line_doc[worded], minlength=docs_n)
            # words inside 8-word windows that occur twice or more in the text
            at, windows = scan.windows(REPEAT_WINDOW)
            keyed = mix(windows + mix(scan.doc[at].astype(np.uint64) + np.uint64(1)))
            _, back, times = np.unique(keyed, return_inverse=True, return_counts=True)
            cover = np.zeros(len(scan.starts) + 1, dtype=np.int64)
            again = at[times[back] > 1] if len(at) else at
            np.add.at(cover, again, 1)
            np.add.at(cover, again + REPEAT_WINDOW, -1)
            repeated = np.cumsum(cover[:-1]) > 0
            return {
                "n_words": scan.count,
                "word_chars": counted(scan.inside & ((raw & 0xC0) != 0x80)),
                "n_symbols": counted(symbol[raw]),
                "n_dup_lines": lines - distinct,
                "n_repeat_words": scan.per_text(repeated, scan.doc),
                "n_lines": lines,
                "n_upper": counted((raw >= 0x41) & (raw <= 0x5A)),
                "n_marks": counted(mark[raw]),
                "n_digits": counted((raw >= 0x30) & (raw <= 0x39)),
            }
        return score

    return annotate(docs, scorer, STATS, keep=keep)


def base_failed():
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _moments(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.avg(a).alias(f"m_{a}") for a in names]
    sums += [F.avg(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy(*keys).agg(*sums)


def _inverse(frame, names, floors):
    """Centre, inverse scatter and consistency scale of each group's moments."""
    out = []
    for row in frame.to_dict("records"):
        centre = np.array([row[f"m_{a}"] for a in names])
        scatter = np.empty((len(names), len(names)))
        for i, a in enumerate(names):
            for j, b in enumerate(names[i:], i):
                scatter[i, j] = scatter[j, i] = row[f"p_{a}_{b}"] - centre[i] * centre[j]
        # half of the mass around the centre: scatter of the kept half, scaled
        # back to the whole (one factor per dimension count, chi-square based)
        scatter = scatter * _consistency(len(names)) + np.diag(floors ** 2)
        out.append((centre, np.linalg.inv(scatter)))
    return out


def _consistency(p: int) -> float:
    """h / P(chi2[p+2] < q) where q is the h quantile of chi2[p].

    Both from a numeric integral of the chi-square density."""
    x = np.linspace(1e-9, 20.0 * p, 200_001)
    density = x ** (p / 2 - 1) * np.exp(-x / 2)
    cdf = np.cumsum(density)
    cdf /= cdf[-1]
    q = x[np.searchsorted(cdf, H_FRACTION)]
    wide = x ** (p / 2) * np.exp(-x / 2)
    return float(H_FRACTION / (wide[x <= q].sum() / wide.sum()))


def _distance_column(names):
    """Squared Mahalanobis distance from array columns centre and inverse."""
    terms = []
    for i, a in enumerate(names):
        for j, b in enumerate(names[i:], i):
            weight = 1.0 if i == j else 2.0
            terms.append(f"{weight}D * inverse[{i * len(names) + j}] * ({a} - centre[{i}]) * ({b} - centre[{j}])")
    return F.expr(" + ".join(terms))


def _fit(frame: DataFrame, names, floors, robust_start: bool) -> DataFrame:
    """(grp, centre, inverse) from one row of medians or moments per group.

    The matrix inversions run in Python, a bounded step per group."""

    def run(parts):
        import pandas as pd

        for part in parts:
            if not len(part):
                continue
            if robust_start:
                centres, inverses = [], []
                for row in part.to_dict("records"):
                    spread = np.array([max(1.4826 * row[f"dev_{a}"], f) for a, f in zip(names, floors)])
                    centres.append([row[f"mid_{a}"] for a in names])
                    inverses.append(np.diag(1 / spread ** 2).ravel().tolist())
            else:
                made = _inverse(part, names, floors)
                centres = [c.tolist() for c, _ in made]
                inverses = [m.ravel().tolist() for _, m in made]
            yield pd.DataFrame({"grp": part["grp"].tolist(), "centre": centres, "inverse": inverses})

    return frame.mapInPandas(run, "grp string, centre array<double>, inverse array<double>")


def group_estimates(rows: DataFrame, names, floors, path: str, min_group: int) -> DataFrame:
    """MCD estimate of every group ``grp`` as (grp, centre, inverse).

    Each step is one aggregate over all rows of all groups at once."""
    mids = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"),
                                   *[F.percentile_approx(a, 0.5, 1000).alias(f"mid_{a}") for a in names])
    mids = written(mids.where(F.col("n") >= min_group), f"{path}/mids")
    devs = rows.join(if_small(mids), "grp").groupBy("grp").agg(
        *[F.first(f"mid_{a}").alias(f"mid_{a}") for a in names],
        *[F.percentile_approx(F.abs(F.col(a) - F.col(f"mid_{a}")), 0.5, 1000).alias(f"dev_{a}") for a in names])
    model = written(_fit(devs, names, floors, True), f"{path}/model-0")
    for step in range(C_STEPS):
        measured = rows.join(if_small(model), "grp").withColumn("d2", _distance_column(names))
        limits = measured.groupBy("grp").agg(F.percentile_approx("d2", H_FRACTION, 1000).alias("limit"))
        limits = written(limits, f"{path}/limits-{step}")
        half = measured.join(if_small(limits), "grp").where("d2 <= limit")
        model = written(_fit(_moments(half, ["grp"], names), names, floors, False), f"{path}/model-{step + 1}")
    return model


def _group_keys():
    """Group of a row at each level: own source, own language, everything."""
    lang, source = F.col("lang").cast("string"), F.col("source").cast("string")
    options = {"ignoreNullFields": "false"}
    return [F.to_json(F.struct(lang.alias("lang"), source.alias("source")), options),
            F.to_json(F.struct(lang.alias("lang")), options), F.lit("all")]


def quality_verdicts(docs: DataFrame, keep: list[str] | None = None, cutoff: float = CUTOFF,
                     min_group: int = MIN_GROUP) -> DataFrame:
    """``docs`` (columns ``keep``) with statistics, ``base_failed``, the
    squared robust ``distance`` (null where the base rule fails) and ``kept``."""
    spark = docs.sparkSession
    path = shared_dir(spark, "quality-rules")
    names = list(FEATURES)
    floors = np.array([f for _, f in FEATURES.values()])
    keep = docs.columns if keep is None else keep
    levels = [f"grp_{i}" for i in range(3)]
    carried = docs.withColumns(dict(zip(levels, _group_keys())))
    stats = text_stats(carried, [c for c in keep if c not in STATS.split() and c not in levels] + levels)
    stats = stats.withColumn("base_failed", base_failed()) \
        .withColumns({a: F.when(~F.col("base_failed"), F.expr(f"CAST({e} AS double)"))
                      for a, (e, _) in FEATURES.items()})
    stats = written(stats, f"{path}/stats")
    # estimates use documents that pass the base rule
    rows = stats.where(~F.col("base_failed")).select(F.explode(F.array(*levels)).alias("grp"), *names)
    models = group_estimates(rows, names, floors, path, min_group)
    scored = stats
    for level in levels:  # a few rows per language and source; Spark sizes the join
        scored = scored.join(models.toDF(level, f"{level}_centre", f"{level}_inverse"), level, "left")
    scored = scored.withColumns({
        part: F.coalesce(*[f"{level}_{part}" for level in levels]) for part in ("centre", "inverse")})
    scored = scored.withColumn("distance", _distance_column(names))
    # without any estimate (fewer than min_group usable documents) nothing is an outlier
    verdict = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return scored.withColumn("kept", verdict).select(
        *[c for c in keep if c not in BASE], *BASE, "base_failed", "distance", "kept")

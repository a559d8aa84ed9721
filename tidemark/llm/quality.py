"""Quality rules (operator 4): base statistics and robust multivariate
outliers.

``text_statistics`` counts in one pass over the bytes of each whole text.
``robust_estimates`` fits, for each language and source, location and scatter
by the minimum covariance determinant: of all subsets that hold a share
``support`` of the group's documents, concentration steps seek the one
whose covariance has the least determinant. A group's steps go on, from each of
two starts, until its determinant no longer falls. Every vector of the group takes
part in every step, with the number of its documents; each step is two mergeable aggregations, so a group that
holds a third of all rows costs no task more than another. ``judge`` rejects a
text whose transformed vector is farther (Mahalanobis) than the chi-square
quantile ``1 - tail``.

Defined results: a null text has no words; null language or source is a group
of its own; repeated rows are judged alike and each counts in the
estimates; a group of under ``min_group`` documents
uses its language's estimate, then the corpus's, and with too few
documents there too nothing but the base rules rejects; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as tb
from tidemark.session import materialize, release

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = tb.classes(b"#*$%&|<>")
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                0xD6E8FEB86659FD93)]

#: Per dimension of the vector: the least spread (in the transformed unit). It
#: bounds the scatter's eigenvalues from below, so that a group of near copies
#: doesn't make every other text of its source an outlier; a wider scatter stays
#: as it is. The last three are zero for most texts, so their own scatter is none.
DIMS = ("log_words", "log_word_length", "log_symbols", "log_dup_lines", "log_further_repeats")
LEAST_SPREAD = (0.4, 0.1, 0.5, 0.95, 0.8)
#: Duplicate lines repeat their words too: so much of log_dup_lines is taken off
#: the logarithm of repeats.
REPEATS_OF_LINES = 0.6
#: Groups whose estimates (under 400 bytes each) are broadcast; with more, only the
#: corpus's own is, and joins of the others shuffle by group and leave skew to
#: adaptive execution.
MAX_BROADCAST_GROUPS = 50_000
#: Resolution of the transformed statistics; sums over them are exact.
UNIT = 1000


def _repeat_words(hashes: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the words that lie in a 3-word window found twice in its text."""
    n = len(hashes)
    flags = np.zeros(n, bool)
    if n < 4:
        return flags
    text = (np.searchsorted(offsets, starts, "right") - 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = tb.mix(hashes[:-2] * _MULT[0] + hashes[1:-1] * _MULT[1] + hashes[2:] * _MULT[2]
                     + text[:-2] * _MULT[3])
    inside = np.flatnonzero(text[2:] == text[:-2])
    key = key[inside]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = inside[again]
    for k in range(3):
        flags[at + k] = True
    return flags


def _line_counts(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and how many equal an earlier one."""
    ls, le = tb.runs(data != 0x0A, offsets)
    k = np.searchsorted(starts, ls)
    full = (k < len(starts)) & (starts[np.minimum(k, len(starts) - 1)] < le) if len(starts) else ls < 0
    ls, le = ls[full], le[full]
    text = np.searchsorted(offsets, ls, "right") - 1
    n = len(offsets) - 1
    lines = np.bincount(text, minlength=n)
    h = tb.span_hashes(data, ls, le)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    again = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    return lines, np.bincount(text[1:][again], minlength=n)


def _statistics(carried: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tb.slices(batch.column("text")):
                space = tb.SPACE[data]
                starts, ends = tb.runs(~space, offsets)
                first = np.searchsorted(starts, offsets)
                hashes = tb.span_hashes(data, starts, ends)
                repeats = np.concatenate([[0], np.cumsum(_repeat_words(hashes, starts, offsets))])
                lines, dups = _line_counts(data, offsets, starts)
                columns = [batch.column(c).slice(lo, hi - lo) for c in carried]
                counts = [lines, np.diff(first), tb.per_text(~space & ((data & 0xC0) != 0x80), offsets),
                          tb.per_text(_SYMBOL[data], offsets), dups, np.diff(repeats[first])]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(c.astype(np.int64)) for c in counts], [*carried, "n_lines", *STATS])

    return run


_COUNTS = "n_lines long, " + ", ".join(f"{c} long" for c in STATS)


def _texts(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, *(docs[c].cast("string").alias(c) for c in ("lang", "source", "text")))


def text_statistics(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source, n_lines (with a word), ``STATS``."""
    return _texts(docs, docs["doc_id"].cast("long").alias("doc_id")).mapInArrow(
        _statistics(("doc_id", "lang", "source")), f"doc_id long, lang string, source string, {_COUNTS}")


def _vector(d: DataFrame) -> DataFrame:
    """Adds the transformed vector as integers of 1 / UNIT."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    x = [F.log1p(F.col("n_words")), F.log((F.col("word_chars") + 1) / words),
         F.log1p(100 * F.col("n_symbols") / words), F.log1p(100 * F.col("n_dup_lines") / lines),
         F.log1p(100 * F.col("n_repeat_words") / words) - REPEATS_OF_LINES * F.log1p(100 * F.col("n_dup_lines") / lines)]
    return d.withColumns({f"x{i}": F.round(UNIT * v).cast("long") for i, v in enumerate(x)})


P = len(DIMS)
X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _key(level: int):
    part = lambda c: F.concat(F.lit("="), F.col(c))
    none = F.lit("-")
    cols = [F.coalesce(part("lang"), none) if level < 2 else F.lit(""),
            F.coalesce(part("source"), none) if level < 1 else F.lit("")]
    return F.to_json(F.struct(F.lit(level).alias("a"), cols[0].alias("b"), cols[1].alias("c")))


def gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function (series)."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(p: float, dof: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if gamma_share(dof / 2, mid / 2) < p else (lo, mid)
    return hi


def consistency(support: float) -> float:
    """Factor that makes the scatter of the central share fit a normal one."""
    return support / gamma_share((P + 2) / 2, chi2_quantile(support, P) / 2)


def bounded(cov: np.ndarray) -> np.ndarray:
    """cov, its eigenvalues (in units of ``LEAST_SPREAD``) 1 at least."""
    unit = np.outer(LEAST_SPREAD, LEAST_SPREAD)
    values, vectors = np.linalg.eigh(cov / unit)
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * unit


def _invert(scale: float):
    """Sums of each group's subset to location, precision and log-determinant."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                n = float(r["n"])
                mu = np.array([float(r[f"s{i}"]) / n for i in range(P)]) / UNIT
                cov = np.zeros((P, P))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = float(r[f"s{i}_{j}"]) / n / UNIT**2 - mu[i] * mu[j]
                cov = bounded(scale * cov)
                rows.append({"gk": r["gk"], "start": r["start"], "mu": mu.round(9).tolist(),
                             "inv": np.linalg.inv(cov).round(9).ravel().tolist(),
                             "logdet": round(float(np.linalg.slogdet(cov)[1]), 9)})
            yield pd.DataFrame(rows, columns=["gk", "start", "mu", "inv", "logdet"])

    return run


_FIT = "gk string, start int, mu array<double>, inv array<double>, logdet double"


def _fit(rows: DataFrame, scale: float) -> DataFrame:
    big = lambda c: F.sum((F.col("w") * c).cast("decimal(20,0)"))
    sums = rows.groupBy("gk", "start").agg(
        F.sum("w").cast("double").alias("n"),
        *(big(F.col(X[i])).cast("double").alias(f"s{i}") for i in range(P)),
        *(big(F.col(X[i]) * F.col(X[j])).cast("double").alias(f"s{i}_{j}") for i, j in PAIRS))
    return sums.mapInPandas(_invert(scale), _FIT)


def distance(mu: str = "mu", inv: str = "inv"):
    """Squared Mahalanobis distance of the row's vector."""
    d = [F.col(X[i]) / F.lit(float(UNIT)) - F.col(mu)[i] for i in range(P)]
    terms = [(1 if i == j else 2) * F.col(inv)[i * P + j] * d[i] * d[j] for i, j in PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _beside(rows: DataFrame, groups: DataFrame, few: bool, on: tuple[str, ...] = ("gk",)) -> DataFrame:
    """rows joined with their group's columns. The corpus's group holds every
    vector, so its own rows are broadcast however many groups there are."""
    if few:
        return rows.join(F.broadcast(groups), list(on))
    corpus = F.col("gk") == _key(2)
    return rows.where(corpus).join(F.broadcast(groups.where(corpus)), list(on)).unionByName(
        rows.where(~corpus).join(groups.where(~corpus), list(on)))


def robust_estimates(stats: DataFrame, support: float = 0.75, min_group: int = 50) -> DataFrame:
    """``gk, mu, inv`` of every (language, source), language, and the corpus
    with at least ``min_group`` documents. ``stats`` has _vector's
    columns and should be a written table.

    Steps from a start end when its determinant no longer falls; as it falls
    over finitely many subsets, every start ends, and only groups that have not
    yet ended are read again."""
    spark = stats.sparkSession
    levels = F.explode(F.array(*(_key(k) for k in range(3)))).alias("gk")
    # a row for each distinct vector of a group, w: how many documents have it
    vectors = stats.groupBy("lang", "source", *X).agg(F.count("*").alias("w"))
    pool, pool_path = materialize(vectors.select(levels, *X, "w").groupBy("gk", *X).agg(F.sum("w").alias("w")), "mcd-vectors")
    middle = lambda c: F.percentile(c, F.lit(0.5), F.col("w"))
    enough = pool.groupBy("gk").agg(F.sum("w").alias("n"), *(middle(c).alias(f"m{c}") for c in X)) \
        .where(F.col("n") >= min_group)
    centre, centre_path = materialize(enough, "mcd-centre")
    few = centre.count() <= MAX_BROADCAST_GROUPS
    around = _beside(pool, centre, few)
    # two starts: medians with absolute deviations, and all rows of the group
    spread = around.groupBy("gk").agg(
        *(F.first(f"m{c}").alias(f"m{c}") for c in X),
        *(middle(F.abs(F.col(c) - F.col(f"m{c}"))).alias(f"d{c}") for c in X))
    var = [F.greatest(F.pow(F.col(f"d{c}") * 1.4826 / UNIT, 2), F.lit(LEAST_SPREAD[i] ** 2)) for i, c in enumerate(X)]
    medians = spread.select(
        "gk", F.lit(0).alias("start"), F.array(*(F.col(f"m{c}") / UNIT for c in X)).alias("mu"),
        F.array(*(1 / var[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P))).alias("inv"),
        F.lit(None).cast("double").alias("logdet"))
    whole = _fit(around.select("gk", *X, "w", F.lit(1).alias("start")), 1.0).withColumn("logdet", F.lit(None).cast("double"))
    fit, fit_path = materialize(medians.unionByName(whole).withColumn("falls", F.lit(True)), "mcd-start")
    scale, names = consistency(support), ["mu", "inv", "logdet"]
    while not fit.where("falls").isEmpty():
        moving = fit.where("falls").drop("falls")
        # distances in steps of 1 %: an exact, mergeable and bounded order statistic
        near = _beside(pool, moving.select("gk", "start", "mu", "inv"), few).select(
            "gk", "start", *X, "w", F.floor(100 * F.log(distance() + 1e-6)).cast("long").alias("_d"))
        limit = near.groupBy("gk", "start").agg(F.ceil(F.percentile("_d", F.lit(support), F.col("w"))).alias("_h"))
        inner = _beside(near, limit, few, ("gk", "start")).where("_d <= _h")
        new = _fit(inner, scale).select("gk", "start", *(F.col(c).alias(f"_{c}") for c in names))
        lower = F.col("logdet").isNull() | (F.col("_logdet") < F.col("logdet"))
        stepped = moving.join(new, ["gk", "start"]).select(
            "gk", "start", *(F.when(lower, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names), lower.alias("falls"))
        before = fit_path
        fit, fit_path = materialize(fit.where("not falls").unionByName(stepped), "mcd-step")
        release(spark, before)
    best = fit.groupBy("gk").agg(F.min_by(F.struct("mu", "inv"), F.struct("logdet", "start")).alias("f")).select("gk", "f.mu", "f.inv")
    out, _ = materialize(best, "mcd-fits")
    for path in (pool_path, centre_path, fit_path):
        release(spark, path)
    return out


def _verdicts(stats: DataFrame, fits: DataFrame, tail: float, min_words: int, max_repeat_percent: int) -> DataFrame:
    """stats (with vectors) and base_failed, distance2, kept."""
    hint = F.broadcast if fits.count() <= MAX_BROADCAST_GROUPS else (lambda d: d)
    d = stats.withColumns({f"_g{k}": _key(k) for k in range(2)})
    corpus = fits.where(F.col("gk") == _key(2)).first()  # one row of 30 numbers
    numbers = lambda v: F.array(*map(F.lit, v)) if v else F.lit(None).cast("array<double>")
    d = d.withColumns({f"_{c}2": numbers(corpus and corpus[c]) for c in ("mu", "inv")})
    for k in range(2):
        d = d.join(hint(fits.select(F.col("gk").alias(f"_g{k}"), F.col("mu").alias(f"_mu{k}"),
                                    F.col("inv").alias(f"_inv{k}"))), f"_g{k}", "left")
    d = d.withColumns({c: F.coalesce(*(F.col(f"_{c}{k}") for k in range(3))) for c in ("mu", "inv")})
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    d = d.withColumns({"base_failed": failed, "distance2": F.when(F.col("mu").isNotNull(), distance())})
    limit = chi2_quantile(1 - tail, P)
    return d.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= limit, F.lit(True)))


def judge(docs: DataFrame, support: float = 0.75, min_group: int = 50,
          tail: float = 1e-3, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Per row of docs: doc_id, ``STATS``, base_failed, kept, distance2 (null
    where no estimate applies)."""
    stats, _ = materialize(_vector(text_statistics(docs)), "quality-stats")
    fits = robust_estimates(stats, support, min_group)
    return _verdicts(stats, fits, tail, min_words, max_repeat_percent).select(
        "doc_id", *STATS, "base_failed", "kept", "distance2")


def filter_documents(docs: DataFrame, support: float = 0.75, min_group: int = 50,
                     tail: float = 1e-3, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """docs without the rows that ``judge`` rejects; columns as they were.

    The texts are counted twice, for the estimates and for the verdicts, so
    that no row has to be found again by a join."""
    stats, path = materialize(_vector(text_statistics(docs)).select("lang", "source", *X), "quality-vectors")
    fits = robust_estimates(stats, support, min_group)
    release(docs.sparkSession, path)
    names = docs.columns
    rows = _texts(docs, F.struct(*(docs[c] for c in names)).alias("row"))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"lang string, source string, {_COUNTS}").fields])
    counted = rows.mapInArrow(_statistics(("row", "lang", "source")), schema)
    kept = _verdicts(_vector(counted), fits, tail, min_words, max_repeat_percent).where("kept")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in names))

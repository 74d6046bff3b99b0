"""Quality rules with robust multivariate outliers; Spark expressions only.

Statistics of every whole text (words are runs without space and U+0009 to
U+000D) give a base verdict, and transformed statistics a vector per document.
Per language and source the minimum-covariance-determinant estimate is found by
concentration steps: the ``SHARE`` of documents with the smallest Mahalanobis
distances gives the next mean and covariance.  Three first estimates (medians
and quartile spreads; the same with the correlations of squashed values; mean
and covariance of all) take ``TRIAL`` steps each; the one of the least
determinant goes on until no group's determinant falls any more (``STEPS`` at
most).  A document beyond the chi-squared quantile ``QUANTILE`` of its group's
consistent estimate is rejected.

A share that is zero in nearly all documents of a group has no spread, so its
determinant would be zero: each statistic has a least standard deviation.  For
the shares of symbols, repeated lines and repeated words it is given as the
percentage (``ALONE``) at which a document goes by that share alone where the
others have none.  A repeated line also repeats words, so where neither share
has a spread the two count as correlated (``SHARED``), not as two faults.

Groups are never gathered: medians and distance quantiles are read from
histograms, means and covariances from sums of whole numbers (vectors are kept
in units of 1 / 1024), so results do not depend on the order of rows.  A group
under ``LEAST`` documents is judged with its language, a language under
``LEAST`` with all documents, and fewer than ``LEAST`` documents in all by the
base verdict alone.

Defined results: a null text has no words and fails the base; a null language
or source is a value of its own; repeated rows each get their row; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, written
from .secrets import let

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
UNIT = 1024
SHARE, QUANTILE, LEAST = 0.75, 0.999, 200
TRIAL, STEPS, FALL = 2, 6, 0.01
#: per cent at which a share rejects by itself in a group that has none of it
ALONE = {"symbols": 15, "lines": 40, "repeats": 25}


def chi2_cdf(x: float, d: int) -> float:
    """For even d."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(d // 2))


def chi2_quantile(q: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < q else (lo, mid)
    return hi


#: correlation of repeated lines and repeated words in a group that has neither
SHARED = 0.5
NAMES = ("length", "word_length", "symbols", "lines", "repeats", "capitals")
#: by itself a text a hundred times the usual length, or words 1.4 times as long, is no outlier
LOOSE = {"length": 1.0, "word_length": 0.08, "capitals": 0.4}
#: (name, least standard deviation)
VECTOR = tuple((n, LOOSE[n] if n in LOOSE else math.log1p(ALONE[n]) / math.sqrt(chi2_quantile(QUANTILE, len(NAMES)))) for n in NAMES)
D = len(VECTOR)
LINES, REPEATS = NAMES.index("lines"), NAMES.index("repeats")
#: tables with a row per group are broadcast up to so many groups (230 bytes each)
FEW_GROUPS = 100_000


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""
    n = F.size(words)
    keys = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("key"), i.alias("at"))))
        twice = let(pairs, lambda p: F.filter(p, lambda e, i: (e["key"] == F.get(p, i - 1)["key"]).eqNullSafe(True) | (e["key"] == F.get(p, i + 1)["key"]).eqNullSafe(True)))
        places = F.array_sort(F.transform(twice, lambda e: e["at"]))
        steps = let(places, lambda p: F.transform(p, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - v, F.lit(WINDOW)))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(keys, lambda h: F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0).cast("long")).otherwise(covered(h)))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_capitals) per row."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    solid = F.translate(text, " \t\n\x0b\f\r", "")
    words = let(F.array_remove(F.split(text, SPACE), ""), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeats")))
    lines = let(F.filter(F.split(text, "\n"), lambda x: F.char_length(F.translate(x, " \t\x0b\f\r", "")) > 0),
                lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    marks = let(solid, lambda s: F.struct(
        F.char_length(s).cast("long").alias("chars"),
        (F.char_length(s) - F.char_length(F.translate(s, SYMBOLS, ""))).cast("long").alias("symbols"),
        (F.char_length(s) - F.char_length(F.translate(s, CAPITALS, ""))).cast("long").alias("capitals")))
    out = rows.select("doc_id", "lang", "source", words.alias("w"), lines.alias("l"), marks.alias("m"))
    return out.select("doc_id", "lang", "source", F.col("w.n").alias("n_words"), F.col("m.chars").alias("word_chars"),
                      F.col("m.symbols").alias("n_symbols"), F.col("l.dup").alias("n_dup_lines"), F.col("w.repeats").alias("n_repeat_words"),
                      F.col("l.n").alias("n_lines"), F.col("m.capitals").alias("n_capitals"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector() -> list[Column]:
    """Transformed statistics in whole units of 1 / 1024."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    values = (F.log1p(F.col("n_words")), F.log(chars / words), F.log1p(100 * F.col("n_symbols") / chars),
              F.log1p(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
              F.log1p(100 * F.col("n_repeat_words") / words), F.log1p(100 * F.col("n_capitals") / chars))
    return [F.round(v * UNIT).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


def _whitening(means: DataFrame) -> DataFrame:
    """From (g, start, m_i, s_ij) the mean, the inverse Cholesky factor w_ij and
    the logarithm of the determinant."""
    least = {i: (floor * UNIT) ** 2 for i, (_, floor) in enumerate(VECTOR)}
    flat = (F.col(f"s{LINES}_{LINES}") < least[LINES]) & (F.col(f"s{REPEATS}_{REPEATS}") < least[REPEATS])
    both = F.col(f"s{REPEATS}_{LINES}")
    means = means.withColumn(f"s{REPEATS}_{LINES}", F.when(flat, F.greatest(both, F.lit(SHARED * math.sqrt(least[LINES] * least[REPEATS])))).otherwise(both))
    # floors go on the diagonal; each step only needs columns of the steps before
    out = means.withColumns({f"s{i}_{i}": F.greatest(F.col(f"s{i}_{i}"), F.lit(least[i])) for i in range(D)})
    for j in range(D):
        diagonal = F.col(f"s{j}_{j}") - sum((F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
        # correlated statistics: at least a tenth of the floor stays
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(diagonal, F.lit(0.1 * (VECTOR[j][1] * UNIT) ** 2))))
        rest = {i: F.col(f"s{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0)) for i in range(j + 1, D)}
        if rest:
            out = out.withColumns({f"l{i}_{j}": r / F.col(f"l{j}_{j}") for i, r in rest.items()})
    for i in range(D):
        row = {f"w{i}_{j}": -sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}_{i}") for j in range(i)}
        out = out.withColumns({**row, f"w{i}_{i}": 1 / F.col(f"l{i}_{i}")})
    out = out.withColumn("logdet", 2 * sum((F.log(f"l{i}_{i}") for i in range(D)), F.lit(0.0)))
    keep = ["g", "start", "logdet", *(f"m{i}" for i in range(D)), *(f"w{i}_{j}" for i in range(D) for j in range(i + 1))]
    return written(out.select(*keep), "whitening")


def _distance() -> Column:
    total = F.lit(0.0)
    for i in range(D):
        y = sum(((F.col(f"x{j}") - F.col(f"m{j}")) * F.col(f"w{i}_{j}") for j in range(i + 1)), F.lit(0.0))
        total = total + y * y
    return total


def _first(rows: DataFrame) -> DataFrame:
    """Medians and quartile spreads per group, from histograms of the units / 16."""
    one = rows.select("g", F.posexplode(F.array(*(F.expr(f"x{i} div 16") for i in range(D)))).alias("i", "bin"))
    bins = one.groupBy("g", "i", "bin").count()
    by = Window.partitionBy("g", "i")
    cum = bins.withColumn("cum", F.sum("count").over(by.orderBy("bin"))).withColumn("n", F.sum("count").over(by))
    at = [F.min(F.when(F.col("cum") * 4 >= q * F.col("n"), F.col("bin"))).alias(f"q{q}") for q in (1, 2, 3)]
    quart = cum.groupBy("g", "i").agg(*at).withColumn("sd", (F.col("q3") - F.col("q1")) * 16 / F.lit(1.349))
    wide = quart.groupBy("g").agg(*(F.max(F.when(F.col("i") == i, F.col("q2") * 16 + 8)).cast("double").alias(f"m{i}") for i in range(D)),
                                  *(F.max(F.when(F.col("i") == i, F.col("sd") * F.col("sd"))).alias(f"s{i}_{i}") for i in range(D)))
    return _whitening(wide.withColumns({"start": F.lit(0), **{f"s{i}_{j}": F.lit(0.0) for i in range(D) for j in range(i)}}))


def _moments(rows: DataFrame, by: list[str], scale: float = 1.0) -> DataFrame:
    """Means m_i and covariances s_ij of the whole numbers x_i."""
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(f"x{i}").alias(f"t{i}") for i in range(D)),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"t{i}_{j}") for i in range(D) for j in range(i + 1)))
    return sums.select(*by, *((F.col(f"t{i}") / F.col("n")).alias(f"m{i}") for i in range(D)),
                       *(((F.col(f"t{i}_{j}") - F.col(f"t{i}").cast("double") * F.col(f"t{j}") / F.col("n")) / F.col("n") * scale).alias(f"s{i}_{j}")
                         for i in range(D) for j in range(i + 1)))


def _starts(rows: DataFrame) -> DataFrame:
    """Three first estimates per group, told apart by ``start``."""
    first = _first(rows)
    plain = _whitening(_moments(rows, ["g"]).withColumn("start", F.lit(1)))
    # values in spreads, squashed to (-1, 1): far ones hardly bend their correlations
    squashed = rows.join(small(first, FEW_GROUPS), "g").select(
        "g", *(F.round(F.tanh((F.col(f"x{i}") - F.col(f"m{i}")) * F.col(f"w{i}_{i}")) * UNIT).cast("long").alias(f"x{i}") for i in range(D)))
    spread = first.select("g", *(F.col(f"m{i}").alias(f"c{i}") for i in range(D)), *((1 / F.col(f"w{i}_{i}")).alias(f"d{i}") for i in range(D)))
    own = _moments(squashed, ["g"]).join(small(spread, FEW_GROUPS), "g")

    def bent(i: int, j: int) -> Column:
        share = F.lit(1.0) if i == j else F.coalesce(F.try_divide(f"s{i}_{j}", F.sqrt(F.col(f"s{i}_{i}") * F.col(f"s{j}_{j}"))), F.lit(0.0))
        return (share * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"s{i}_{j}")

    shaped = own.select("g", F.lit(2).alias("start"), *(F.col(f"c{i}").alias(f"m{i}") for i in range(D)),
                        *(bent(i, j) for i in range(D) for j in range(i + 1)))
    return first.unionByName(plain).unionByName(_whitening(shaped))


def _concentrated(rows: DataFrame, now: DataFrame, scale: float) -> DataFrame:
    """One concentration step of every start: mean and covariance of the nearest ``SHARE``."""
    now = small(now, FEW_GROUPS)
    near = rows.join(now, "g").withColumn("bin", F.floor(F.log(_distance() + 1e-6) * 50).cast("long"))
    bins = near.groupBy("g", "start", "bin").count()
    by = Window.partitionBy("g", "start")
    cum = bins.withColumn("cum", F.sum("count").over(by.orderBy("bin"))).withColumn("n", F.sum("count").over(by))
    cut = cum.groupBy("g", "start").agg(F.min(F.when(F.col("cum") >= SHARE * F.col("n"), F.col("bin"))).alias("cut"))
    nearest = near.join(small(written(cut, "cut"), FEW_GROUPS), ["g", "start"]).where("bin <= cut")
    # written first: the steps of the factorisation are planned on a table, not on the whole pass
    return _whitening(written(_moments(nearest, ["g", "start"], scale), "moments"))


def _least(estimates: DataFrame) -> DataFrame:
    """Per group the estimate of the least determinant."""
    best = estimates.groupBy("g").agg(F.min_by(F.struct(*(c for c in estimates.columns if c != "g")), F.struct("logdet", "start")).alias("e"))
    return best.select("g", "e.*")


def least_determinant(rows: DataFrame) -> DataFrame:
    """The estimate of each group of ``rows`` (g, x_i)."""
    scale = SHARE / chi2_cdf(chi2_quantile(SHARE, D), D + 2)
    now = _starts(rows)
    for _ in range(TRIAL):
        now = _concentrated(rows, now, scale)
    now = written(_least(now), "least")
    for _ in range(STEPS):
        after = _concentrated(rows, now, scale)
        fall = now.join(after.select("g", F.col("logdet").alias("next")), "g").agg(F.max(F.col("logdet") - F.col("next"))).first()[0]
        now = written(_least(now.unionByName(after.withColumn("start", F.lit(-1)))), "least")
        if fall is None or fall < FALL:
            break
    return now


def judged(docs: DataFrame) -> DataFrame:
    """Statistics with ``base_failed``, ``distance`` (squared Mahalanobis; null
    where too few documents are there) and ``kept``."""
    rows = written(statistics(docs), "statistics")
    rows = rows.withColumn("own", F.to_json(F.array("lang", "source"))).withColumn("tongue", F.to_json(F.array("lang")))
    count = rows.groupBy("own", "tongue").count()
    sized = (count.withColumn("in_tongue", F.sum("count").over(Window.partitionBy("tongue"))))
    group = (F.when(F.col("count") >= LEAST, F.col("own")).when(F.col("in_tongue") >= LEAST, F.col("tongue"))
             .when(F.lit(rows.count() >= LEAST), F.lit("")))
    groups = sized.select("own", group.alias("g"))
    groups = small(written(groups, "groups"), FEW_GROUPS)
    named = written(rows.join(groups, "own").select(*(c for c in rows.columns if c not in ("own", "tongue")), "g", *vector()), "vectors")
    some = named.where("g is not null").select("g", *(f"x{i}" for i in range(D)))
    now = least_determinant(some)
    out = named.join(small(now.drop("start", "logdet"), FEW_GROUPS), "g", "left").withColumn("distance", F.when(F.col("g").isNotNull(), _distance()))
    failed = base_failed()
    near = F.coalesce(F.col("distance") <= chi2_quantile(QUANTILE, D), F.lit(True))
    return out.select(*(c for c in rows.columns if c not in ("own", "tongue")), failed.alias("base_failed"), "distance", (~failed & near).alias("kept"))

"""Quality rules with a robust multivariate outlier test, in DataFrame operations only.

Base rules look at one text. Then, per language and source, transformed statistics of the texts are
compared with a minimum-covariance-determinant estimate: the mean and covariance of the tightest share of
the group. Texts whose Mahalanobis distance from it is beyond a chi-square quantile are rejected.

The estimate is found by concentration steps from several starts. A step is one pass over slim rows of
statistics: distances under the current estimates fall into bins, the moments of each bin are summed
(inside tasks first, so a hot group is no hot task), and the bins nearest the centre that together hold the
wanted share give the next estimate. Only a row per group and bin is ever gathered.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import BROADCAST_BYTES, written

WINDOW_WORDS = 5
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


class Settings(NamedTuple):
    least_words: int = 10
    most_repeated_percent: int = 20
    share: float = 0.75         # of a group's rows that the estimate rests on
    steps: int = 5              # concentration steps
    hashed_starts: int = 2      # starts from small pseudo-random subsets, besides the robust one
    subset: int = 60            # rows of such a subset, about
    least_group: int = 40       # smaller groups are pooled: by language, then all
    bins_per_unit: float = 40.0  # resolution of log(1 + squared distance)
    # Least standard deviation of each statistic, so small that a text extreme in any single one is rejected:
    # where a group has no spread of its own, at about 21% symbols, 30% repeated lines or 13% repeated words.
    floors: tuple[float, ...] = (0.35, 0.06, 0.10, 0.12, 0.08)
    reweight: float = 0.975     # chi-square level of the rows in the final estimate
    reject: float = 1e-3        # chance under the estimate at which a row is rejected


P = 5
F_COLUMNS = [f"f{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


# ---------------------------------------------------------------- statistics of one text


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: sort windows by hash, keep those equal to a
    neighbour, and add up how far each reaches before the next begins."""
    last = F.size(hashes) - 1

    def repeated(s: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
        at = F.transform(F.sequence(F.lit(0), last), lambda i: F.when(same(i, i - 1) | same(i, i + 1), F.get(s, i)["i"]))
        return F.sort_array(F.filter(at, lambda i: i.isNotNull()))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    reach = _let(_let(ordered, repeated), lambda at: F.aggregate(
        F.transform(at, lambda a, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(at, k + 1) - a, F.lit(WINDOW_WORDS)))),
        F.lit(0), lambda acc, n: acc + n))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(reach)


def repeat_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the text, windows known by a 64-bit hash."""
    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW_WORDS)])
    n = F.size(words)
    return F.when(n > WINDOW_WORDS, _let(F.transform(F.sequence(F.lit(0), n - WINDOW_WORDS), window_hash), _covered)).otherwise(0)


def with_statistics(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Add the base columns and the transformed statistics ``f0`` to ``f4``; input columns of those names go.

    A null or blank text has no words and fails the base rules. The statistics are the logarithms of the word
    count and of the mean word length, the symbols per character (square root), and the shares of duplicated
    lines and repeated words (square roots).
    """
    added = {*BASE_COLUMNS, *F_COLUMNS, "_words", "_lines"}
    kept = [c for c in docs.columns if c not in added]
    value = F.coalesce(docs[text], F.lit(""))
    cut = docs.select(*kept, value.alias("_text_of"), F.array_remove(F.split(value, r"[\x20\x09-\x0D]+"), "").alias("_words"),
                      F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    # The generator keeps the optimizer from repeating these measurements in every expression above them.
    measured = cut.select(*kept, F.explode_outer(F.array(F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        F.regexp_count("_text_of", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_words")).cast("long").alias("n_repeat_words")))).alias("_measured")).select(*kept, "_measured.*")
    n = F.greatest(F.col("n_words"), F.lit(1))
    return measured.select(
        *kept, *BASE_COLUMNS[:5],
        ((F.col("n_words") < settings.least_words)
         | (100 * F.col("n_repeat_words") > settings.most_repeated_percent * F.col("n_words"))).alias("base_failed"),
        F.log(n.cast("double")).alias("f0"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n).alias("f1"),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))).alias("f2"),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1))).alias("f3"),
        F.sqrt(F.col("n_repeat_words") / n).alias("f4"))


# ---------------------------------------------------------------- chi-square


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < q else (low, middle)
    return (low + high) / 2


def consistency(share: float) -> float:
    """What scales the covariance of the nearest ``share`` of normal rows to that of all."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2)


# ---------------------------------------------------------------- estimates


# The sums from which mean and covariance follow, as SQL (many small expressions, quickly analysed).
SUMS = {"n": "count(1)", **{f"s{i}": f"sum({f})" for i, f in enumerate(F_COLUMNS)},
        **{f"q{i}{j}": f"sum({F_COLUMNS[i]} * {F_COLUMNS[j]})" for i, j in PAIRS}}
MEANS = [f"m{i}" for i in range(P)]
FACTORS = [f"v{i}{j}" for i, j in PAIRS]


def _moments() -> list[Column]:
    return [F.expr(f"{sql} AS {name}") for name, sql in SUMS.items()]


def _estimate(sums: DataFrame, keys: list[str], scale: float, settings: Settings) -> DataFrame:
    """Mean ``m``, inverse Cholesky factor ``v`` of the covariance and its log determinant."""
    floor = {(i, j): settings.floors[i] ** 2 if i == j else 0.0 for i, j in PAIRS}
    return _factor(sums.selectExpr(
        *keys, *[f"s{i} / n AS m{i}" for i in range(P)],
        *[f"{scale!r}D * (q{i}{j} / n - (s{i} / n) * (s{j} / n)) + {floor[i, j]!r}D AS c{i}{j}" for i, j in PAIRS]), keys)


def _factor(df: DataFrame, keys: list[str]) -> DataFrame:
    """From covariances ``c`` to their inverse Cholesky factor, column by column, then row by row."""
    def less(*terms: str) -> str:
        return "".join(f" - {t}" for t in terms)

    lower = [f"l{i}{j}" for i, j in PAIRS]
    for j in range(P):
        have = [c for c in df.columns if c[0] != "d"]
        df = df.selectExpr(*have, f"sqrt(greatest(c{j}{j}{less(*[f'l{j}{k} * l{j}{k}' for k in range(j)])}, 1e-12D)) AS d")
        df = df.selectExpr(*have, f"d AS l{j}{j}", *[
            f"(c{i}{j}{less(*[f'l{i}{k} * l{j}{k}' for k in range(j)])}) / d AS l{i}{j}" for i in range(j + 1, P)])
    for i in range(P):
        df = df.selectExpr("*", *[f"1 / l{i}{i} AS v{i}{j}" if i == j else
                                  f"(0{less(*[f'l{i}{k} * v{k}{j}' for k in range(j, i)])}) / l{i}{i} AS v{i}{j}" for j in range(i + 1)])
    log_det = " + ".join(f"2 * ln({c})" for c in lower if c[1] == c[2])
    return df.selectExpr(*keys, *MEANS, *FACTORS, f"{log_det} AS log_det")


def squared_distance() -> Column:
    """Mahalanobis distance squared of a row's statistics from the estimate in the same row."""
    rows = [" + ".join(f"v{i}{j} * ({F_COLUMNS[j]} - m{j})" for j in range(i + 1)) for i in range(P)]
    return F.expr(" + ".join(f"({r}) * ({r})" for r in rows))


def _groups(rows: DataFrame, settings: Settings) -> DataFrame:
    """Language, source and the key of the group whose estimate holds for them: the pair itself if it has
    enough rows, else what is left of its language, else what is left of all; null if even that is small."""
    pairs = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    enough = settings.least_group
    small = F.when(F.col("n") < enough, F.col("n")).otherwise(0)
    left = written(pairs.withColumn("_left", F.sum(small).over(Window.partitionBy("lang"))))
    rest = left.where((F.col("n") < enough) & (F.col("_left") < enough)).agg(F.sum("n").alias("n")).first()["n"] or 0
    own, of_language = (F.to_json(F.struct(*c), {"ignoreNullFields": "false"}) for c in (("lang", "source"), ("lang",)))
    key = F.when(F.col("n") >= enough, own).when(F.col("_left") >= enough, of_language)
    return left.select("lang", "source", F.col("n").alias("n_pair"), (key.otherwise("rest") if rest >= enough else key).alias("group_key"))


def _joined(rows: DataFrame, small: DataFrame, is_small: bool) -> DataFrame:
    """``rows`` with the estimates of their language and source."""
    keyed = small.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    on = rows["lang"].eqNullSafe(F.col("_lang")) & rows["source"].eqNullSafe(F.col("_source"))
    return rows.join(F.broadcast(keyed) if is_small else keyed, on, "inner").drop("_lang", "_source")


def _robust_start(placed: DataFrame, settings: Settings) -> DataFrame:
    """Per group the median and the quartile range of each statistic, from bins, as a diagonal estimate."""
    step = 1 / 64
    keys = ["group_key", "dim"]
    binned = placed.select("group_key", F.posexplode(F.array(*F_COLUMNS)).alias("dim", "x")).groupBy(
        *keys, F.floor(F.col("x") / step).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    below = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))
    of = binned.withColumns({"below": below, "all": F.sum("n").over(Window.partitionBy(*keys))})

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("below") >= q * F.col("all"), (F.col("bin") + 0.5) * step))
    found = of.groupBy(*keys).agg(quantile(0.25).alias("low"), quantile(0.5).alias("mid"), quantile(0.75).alias("high"))
    wide = found.groupBy("group_key").agg(
        *[F.max(F.when(F.col("dim") == i, F.col("mid"))).alias(f"m{i}") for i in range(P)],
        *[F.max(F.when(F.col("dim") == i, ((F.col("high") - F.col("low")) / 1.349) ** 2 + settings.floors[i] ** 2)).alias(f"c{i}{i}")
          for i in range(P)])
    keys = ["group_key", "start"]
    return _factor(wide.withColumns({"start": F.lit(0), **{f"c{i}{j}": F.lit(0.0) for i, j in PAIRS if i != j}}), keys)


def fit_groups(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Robust estimates from rows with ``lang``, ``source`` and the statistics, written: a row per pair of
    language and source with ``group_key``, the mean and the inverse factor of the covariance.

    Rows that fail the base rules take no part. Null languages and sources are values like others. Pairs
    in no group of sufficient size have null estimates. ``rows`` is read once per step, so pass a written
    table. An empty table gives no rows.
    """
    sound = rows.where(~F.col("base_failed")).select("lang", "source", *F_COLUMNS)
    groups = written(_groups(sound, settings))
    estimate_bytes = 8 * (2 * P + len(PAIRS)) + 200
    is_small = groups.count() * estimate_bytes * (1 + settings.hashed_starts) <= BROADCAST_BYTES
    placed = _joined(sound, groups, is_small).where("group_key IS NOT NULL")

    # Starts: the robust diagonal, and subsets picked by a hash of the statistics.
    picked = placed.select("*", F.explode(F.sequence(F.lit(1), F.lit(settings.hashed_starts))).alias("start")).where(
        F.pmod(F.xxhash64(*F_COLUMNS, "start"), F.greatest(F.floor(F.col("n_pair") / settings.subset), F.lit(1))) == 0)
    subsets = _estimate(picked.groupBy("group_key", "start").agg(*_moments()), ["group_key", "start"], 1.0, settings)
    current = written(_robust_start(placed, settings).unionByName(subsets))

    scale = consistency(settings.share)
    for _ in range(settings.steps):
        near = _joined(sound, groups.join(current, "group_key"), is_small)
        binned = near.withColumn("bin", F.floor(F.log1p(squared_distance()) * settings.bins_per_unit).cast("int")).groupBy(
            "group_key", "start", "bin").agg(*_moments())
        by_group = Window.partitionBy("group_key", "start")
        nearest = by_group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        wanted = F.ceil(settings.share * F.sum("n").over(by_group))
        summed = binned.select("group_key", "start", F.col("n").alias("_own"), wanted.alias("_wanted"),
                               *[F.sum(m).over(nearest).alias(m) for m in SUMS])
        reached = summed.where((F.col("n") >= F.col("_wanted")) & (F.col("n") - F.col("_own") < F.col("_wanted")))
        current = written(_estimate(reached, ["group_key", "start"], scale, settings))

    tightest = Window.partitionBy("group_key").orderBy("log_det", "start")
    best = current.withColumn("_place", F.row_number().over(tightest)).where("_place = 1").drop("_place", "start")
    inside = _joined(sound, groups.join(best, "group_key"), is_small).where(
        squared_distance() <= chi2_quantile(settings.reweight, P))
    final = _estimate(inside.groupBy("group_key").agg(*_moments()), ["group_key"], consistency(settings.reweight), settings)
    return written(groups.join(final, "group_key", "left").drop("n_pair"))


def judge(rows: DataFrame, estimates: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``distance2`` (null without an estimate) and ``kept``: base rules passed and not an outlier.

    Rows keep their order of columns; columns named like an added one are replaced. A pair of language and
    source without an estimate rejects nothing beyond the base rules.
    """
    columns = [c for c in rows.columns if c not in ("distance2", "kept")]
    is_small = estimates.count() * (8 * (2 * P + len(PAIRS)) + 200) <= BROADCAST_BYTES
    keyed = estimates.withColumnsRenamed({"lang": "_lang", "source": "_source"}).drop("group_key", "log_det")
    on = rows["lang"].eqNullSafe(F.col("_lang")) & rows["source"].eqNullSafe(F.col("_source"))
    joined = rows.join(F.broadcast(keyed) if is_small else keyed, on, "left")
    limit = chi2_quantile(1 - settings.reject, P)
    return joined.select(*[rows[c] for c in columns], squared_distance().alias("distance2")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= limit, F.lit(True)))

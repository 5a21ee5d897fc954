"""Quality rules: base statistics against plain code, the estimate against known outliers, odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import quality_mcd as Q
from helixframe.llm import queries

SF = "/root/testdata/sf0.001"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


ODD = [None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e", "a b c d e f", "a b c d e a b c d e", "a a a a a a a", "x y\nx y\n\nx y\r\n \n x y",
       "#*$% &|<> #", "é😀 ü x y \x85z", "1 2 3 4 5 6 7 1 2 3 4 5 9 9 2 3 4 5 6", "w " * 30_000, " ".join(map(str, range(30_000))),
       "a\\b 'c' \"d\""]


def base_of(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_statistics_of_odd_texts(spark):
    rows = spark.createDataFrame([(i, t, None, "s", 5) for i, t in enumerate([*ODD, ODD[6]])],
                                 "doc_id long, text string, lang string, source string, n_words int")
    got = Q.with_statistics(rows).collect()
    assert [base_of(r) for r in sorted(got, key=lambda r: r.doc_id)] == [plain(t) for t in [*ODD, ODD[6]]]
    assert all(np.isfinite([r[f] for f in Q.F_COLUMNS]).all() for r in got)


def test_query_base_columns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_quality_rules(spark, SF).collect()
    assert {r.doc_id: base_of(r) for r in got} == {i: plain(t) for i, t in docs.items()}
    assert all(not (r.base_failed and r.kept) for r in got)
    sound = [r.kept for r in got if not r.base_failed]
    assert np.mean(sound) > 0.95


def group(spark, seed=0, n=400, far=60, shift=6.0):
    rng = np.random.default_rng(seed)
    mix = np.eye(5) + 0.4 * rng.normal(size=(5, 5))
    good = rng.normal(size=(n, 5)) @ mix
    bad = rng.normal(size=(far, 5)) * 0.3 + shift * 3
    data = [(i, "en", "s", False, *map(float, x)) for i, x in enumerate(np.vstack([good, bad]))]
    return spark.createDataFrame(data, "id long, lang string, source string, base_failed boolean, f0 double, f1 double, f2 double, "
                                       "f3 double, f4 double").repartition(3), good


def test_estimate_resists_a_cluster_of_outliers(spark):
    rows, good = group(spark)
    estimates = Q.fit_groups(rows)
    row, = estimates.collect()
    assert np.abs(np.array([row[f"m{i}"] for i in range(5)]) - good.mean(axis=0)).max() < 0.4
    kept = {r.id: r.kept for r in Q.judge(rows, estimates).collect()}
    assert not any(kept[i] for i in range(400, 460)) and sum(kept[i] for i in range(400)) >= 398


def test_distance_is_mahalanobis_of_the_final_rows(spark):
    rows, _ = group(spark, far=0)
    estimates = Q.fit_groups(rows)
    row, = estimates.collect()
    m = np.array([row[f"m{i}"] for i in range(5)])
    v = np.array([[row[f"v{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    for r in Q.judge(rows, estimates).collect()[:50]:
        x = np.array([r[f] for f in Q.F_COLUMNS])
        assert r.distance2 == pytest.approx(((v @ (x - m)) ** 2).sum(), rel=1e-9)
    cov = np.linalg.inv(v.T @ v)
    everything = np.array([[r[f] for f in Q.F_COLUMNS] for r in rows.collect()])
    assert np.abs(cov - np.cov(everything.T) - np.diag(np.square(Q.Settings().floors))).max() < 0.6 * np.abs(cov).max()


def test_a_text_extreme_in_any_single_statistic_is_rejected(spark):
    rng = np.random.default_rng(5)

    def words(n, letters=5, alphabet="abcdefghijklmnopqrstuvwxyz"):
        return ["".join(rng.choice(list(alphabet), max(1, int(k)))) for k in rng.normal(letters, 1, n)]

    def lines(ws, k=25):
        return "\n".join(" ".join(ws[i:i + k]) for i in range(0, len(ws), k))
    clean = [lines(words(int(n))) for n in np.exp(rng.normal(5.3, 0.4, 400))]
    extreme = {"words": lines(words(60_000)), "word length": lines(words(200, 12)), "symbols": lines(words(200, 5, "#*$%&|<>")),
               "lines": "same old line\n" * 30 + lines(words(900)), "repeated words": lines((w := words(164)) + w[:18], 7)}
    # the duplicated lines have few words, the repeated words lie on other lines
    texts = [*clean, *extreme.values()]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = Q.written(Q.with_statistics(docs).drop("text"))
    got = {r.doc_id: r for r in Q.judge(rows, Q.fit_groups(rows)).collect()}
    assert not any(got[i].base_failed for i in range(len(texts)))
    assert {name for i, name in enumerate(extreme, len(clean)) if got[i].kept} == set()
    assert np.mean([got[i].kept for i in range(len(clean))]) > 0.98


def test_small_groups_are_pooled_and_tiny_ones_are_not_judged(spark):
    rows, _ = group(spark, n=100, far=0)
    spread = rows.withColumns({"lang": F.when(F.col("id") < 90, "en"), "source": F.concat(F.lit("s"), (F.col("id") % 9).cast("string"))})
    keys = {(r.lang, r.source): r.group_key for r in Q.fit_groups(spread).collect()}
    assert {k for (lang, _), k in keys.items() if lang == "en"} == {'{"lang":"en"}'} and keys[None, "s0"] is None
    tiny = Q.fit_groups(spread.where("lang is null"))
    judged = Q.judge(spread.where("lang is null").withColumn("kept", F.lit(5)), tiny).collect()
    assert [r.kept for r in judged] == [True] * 10 and all(r.distance2 is None for r in judged)
    empty = Q.fit_groups(spread.limit(0))
    assert empty.count() == 0 and Q.judge(spread.limit(0), empty).count() == 0


def test_constant_statistics_do_not_fail(spark):
    rows = spark.range(200).select("id", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(False).alias("base_failed"),
                                   *[F.lit(0.5).alias(f) for f in Q.F_COLUMNS])
    assert {r.kept for r in Q.judge(rows, Q.fit_groups(rows)).collect()} == {True}


def test_a_wide_table_of_groups_is_joined_without_broadcast(spark, monkeypatch):
    rows, _ = group(spark)
    want = {r.id: r.kept for r in Q.judge(rows, Q.fit_groups(rows)).collect()}
    monkeypatch.setattr(Q, "BROADCAST_BYTES", 0)
    assert {r.id: r.kept for r in Q.judge(rows, Q.fit_groups(rows)).collect()} == want


def test_chi_square():
    assert Q.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert Q.chi2_quantile(0.975, 2) == pytest.approx(7.3778, abs=1e-3)


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = Q.with_statistics(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

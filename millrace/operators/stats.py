"""Release statistics: intervals, paired tests, tournaments, calibration, schedules and the verdict. What grows with the
data is aggregated in Spark; formulas of a few totals are columns or run on the driver."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Z = 1.96


def wilson(wins: Column, ties: Column, total: Column, z: float = Z) -> Column:
    """struct(rate, low, high): Wilson's interval, ties as half wins."""
    n = F.greatest(total, F.lit(1)).cast("double")
    p = (wins + ties * 0.5) / n
    spread = F.sqrt(p * (1.0 - p) / n + z * z / (4.0 * n * n)) * z
    centre, denominator = p + z * z / (2.0 * n), 1.0 + z * z / n
    return F.struct(p.alias("rate"), ((centre - spread) / denominator).alias("low"), ((centre + spread) / denominator).alias("high"))


def resolve_pair(first: Column, second: Column) -> Column:
    """Who wins both orders of presentation: candidate, baseline, tie, or inconsistent if the position decides."""
    one, two = "Candidate 1", "Candidate 2"
    return F.when((first == one) & (second == two), "candidate").when((first == two) & (second == one), "baseline").when((first == second) & (first != "Tie"), "inconsistent").otherwise("tie")


def scorecard(trials: DataFrame, *keys: str, least_rate: float = 0.52) -> DataFrame:
    """The tournament per key: counts, rates, Wilson bounds with inconsistent trials as ties, certified or not."""
    count = lambda name: F.count_if(F.col("resolved_winner") == name)
    out = trials.groupBy(*keys).agg(F.count("*").alias("total"), count("candidate").alias("candidate_wins"), count("baseline").alias("baseline_wins"), count("tie").alias("ties"), count("inconsistent").alias("inconsistent_trials"))
    out = out.withColumn("w", wilson(F.col("candidate_wins"), F.col("ties") + F.col("inconsistent_trials"), F.col("total")))
    out = out.withColumn("raw_win_rate", F.col("candidate_wins") / F.greatest("total", F.lit(1)))
    out = out.select(*keys, "total", "candidate_wins", "baseline_wins", "ties", "inconsistent_trials", "raw_win_rate", F.col("w.rate").alias("effective_win_rate"), F.col("w.low").alias("wilson_low"), F.col("w.high").alias("wilson_high"))
    return out.withColumn("certified", (F.col("wilson_low") >= 0.50) & (F.col("effective_win_rate") >= least_rate))


def paired_counts(answers: DataFrame, *keys: str) -> DataFrame:
    """n_regressions (base right, candidate wrong) and n_improvements per key, of 0/1 columns base and cand."""
    return answers.groupBy(*keys).agg(F.count_if((F.col("base") == 1) & (F.col("cand") == 0)).alias("n_regressions"), F.count_if((F.col("base") == 0) & (F.col("cand") == 1)).alias("n_improvements"))


def mcnemar(regressions: int, improvements: int) -> tuple[float, float]:
    """(statistic, p): exact below 25 discordant pairs, else chi-squared with continuity correction."""
    n = regressions + improvements
    if n == 0:
        return 0.0, 1.0
    if n < 25:
        return 0.0, min(1.0, 2 * sum(math.comb(n, k) for k in range(min(regressions, improvements) + 1)) / 2**n)
    chi2 = (abs(improvements - regressions) - 1) ** 2 / n
    return chi2, math.erfc(math.sqrt(chi2 / 2))


def bootstrap(base: np.ndarray, cand: np.ndarray, *, resamples: int = 10_000, alpha: float = 0.05, seed: int = 1337) -> tuple[float, float, float]:
    """(mean, low, high) of the paired difference; resamples are drawn in blocks, so memory stays bounded."""
    deltas = np.asarray(cand, float) - np.asarray(base, float)
    if not len(deltas):
        return 0.0, 0.0, 0.0
    rng = np.random.default_rng(seed)
    block = max(1, 4_000_000 // len(deltas))
    means = np.concatenate([deltas[rng.integers(0, len(deltas), size=(min(block, resamples - at), len(deltas)))].mean(axis=1) for at in range(0, resamples, block)])
    low, high = np.percentile(means, [100 * alpha / 2, 100 * (1 - alpha / 2)])
    return float(deltas.mean()), float(low), float(high)


def bootstrap_by_key(answers: DataFrame, key: str, *, resamples: int = 10_000) -> DataFrame:
    """(key, mean, low, high) where the benchmarks are: one benchmark's answers a task."""

    def of(frame):
        import pandas as pd

        frame = frame.sort_values("item")
        mean, low, high = bootstrap(frame["base"].to_numpy(), frame["cand"].to_numpy(), resamples=resamples)
        return pd.DataFrame({key: [frame[key].iloc[0]], "mean": [mean], "low": [low], "high": [high]})

    kind = answers.schema[key].dataType.simpleString()
    return answers.groupBy(key).applyInPandas(of, f"{key} {kind}, mean double, low double, high double")


def poisson_bootstrap(answers: DataFrame, key: str, *, resamples: int = 200, seed: int = 1337) -> DataFrame:
    """(key, low, high) for answers of any number: each counts a Poisson(1) number of times in each resample, so only sums
    are shuffled."""
    u = F.abs(F.xxhash64(F.lit(seed), "item", "b") % 1_000_003) / 1_000_003.0
    steps, mass, total = F.lit(0), math.exp(-1), 0.0
    for k in range(1, 8):
        total += mass
        steps = steps + F.when(u >= total, 1).otherwise(0)
        mass /= k
    drawn = answers.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(resamples)))).withColumn("w", steps)
    means = drawn.groupBy(key, "b").agg((F.sum(F.col("w") * (F.col("cand") - F.col("base"))) / F.sum("w")).alias("mean"))
    return means.groupBy(key).agg(F.percentile("mean", F.lit(0.025)).alias("low"), F.percentile("mean", F.lit(0.975)).alias("high"))


def intervals(answers: DataFrame, key: str, *, most: int = 1_000_000, resamples: int = 10_000) -> DataFrame:
    """(key, low, high): resampled exactly where every benchmark's answers fit one task, by Poisson weights beyond ``most``."""
    largest = answers.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    exact = largest <= most
    return (bootstrap_by_key(answers, key, resamples=resamples) if exact else poisson_bootstrap(answers, key)).select(key, "low", "high")


def composite(scores: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    weights = weights or dict.fromkeys(scores, 1 / len(scores))
    return sum((scores[k] * F.lit(weights[k]) for k in scores), F.lit(0.0))


def accuracy(flag: Column) -> Column:
    """The share of true flags; 0 without rows."""
    return F.coalesce(F.avg(F.coalesce(flag, F.lit(False)).cast("double")), F.lit(0.0))


def best_choice(choices: DataFrame, *keys: str, penalty: float = 1.0) -> DataFrame:
    """(keys, choice): the choice with the greatest logprob per length to the power of ``penalty``, the first of equals."""
    score = F.col("logprob") / F.pow(F.col("length").cast("double"), F.lit(penalty))
    return choices.groupBy(*keys).agg(F.max_by("choice", F.struct(score, -F.col("choice"))).alias("choice"))


def calibration_error(predictions: DataFrame, *keys: str, bins: int = 10) -> DataFrame:
    """Expected calibration error of (confidence, correct) per key, over equal bins."""
    b = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1))
    each = predictions.groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"), F.abs(F.avg("confidence") - F.avg(F.col("correct").cast("double"))).alias("gap"))
    return each.groupBy(*keys).agg((F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("ece"))


def learning_rate(step: Column, *, warmup: int, total: int, top: float, least: float) -> Column:
    """Linear warm-up, then cosine down to ``least``, which holds after the last step."""
    share = (step - warmup) / float(max(1, total - warmup))
    cosine = least + (top - least) * 0.5 * (1.0 + F.cos(F.lit(math.pi) * share))
    return F.when(step < warmup, step * top / float(max(1, warmup))).when(step > total, least).otherwise(cosine)


def newest(snapshots: DataFrame, keep: int, *keys: str, order: str = "step") -> DataFrame:
    """The newest ``keep`` completed snapshots of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order)) if keys else Window.partitionBy(F.lit(0)).orderBy(F.desc(order))
    return snapshots.where("completed").withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= keep).drop("__n")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (n, digest) that doesn't depend on the order of rows."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(2**31))).alias("s")).select("n", F.sha2(F.concat_ws("|", "n", "x", "s"), 256).alias("digest"))


def release_rules(m: dict, benchmarks: dict[str, tuple[np.ndarray, np.ndarray]], judge: tuple[int, int, int, int], *, margin: float = 0.005, alpha: float = 0.05, most_ece: float = 0.06, least_rate: float = 0.52, resamples: int = 10_000) -> list[tuple[int, str, str, bool]]:
    """(tier, rule, observed, passed) of a candidate release. ``m`` has ast_syntax_rate, eos_rate, kv_delta, pii_leaks, ece,
    itl_ms, itl_sla_ms, vram_gb and vram_limit_gb; ``judge`` wins, losses, ties and trials."""
    rules = [
        (1, "code parses", f"{m['ast_syntax_rate']:.4f}", m["ast_syntax_rate"] >= 1.0),
        (1, "ends on its own", f"{m['eos_rate']:.4f}", m["eos_rate"] >= 0.99),
        (1, "cache agrees", f"{m['kv_delta']:.6e}", m["kv_delta"] < 1e-3),
        (1, "no personal data", str(m["pii_leaks"]), m["pii_leaks"] == 0),
    ]
    for name, (base, cand) in benchmarks.items():
        base, cand = np.asarray(base), np.asarray(cand)
        worse, better = int(((base == 1) & (cand == 0)).sum()), int(((base == 0) & (cand == 1)).sum())
        p = mcnemar(worse, better)[1]
        low = bootstrap(base, cand, resamples=resamples, alpha=alpha)[1]
        rules += [(2, f"{name}: no significant regression", f"p={p:.4f}", not (worse > better and p < alpha)), (2, f"{name}: not inferior", f"low={low:.4f}", low >= -margin)]
    wins, _, ties, total = judge
    n = max(1, total)
    p = (wins + 0.5 * ties) / n
    low = (p + Z**2 / (2 * n) - Z * math.sqrt(p * (1 - p) / n + Z**2 / (4 * n * n))) / (1 + Z**2 / n)
    rules += [(3, "judged better for sure", f"{low:.4f}", low >= 0.50), (3, "judged better", f"{p:.4f}", p >= least_rate)]
    return [*rules, (4, "calibrated", f"{m['ece']:.4f}", m["ece"] <= most_ece), (4, "fast enough", f"{m['itl_ms']:.2f}", m["itl_ms"] <= m["itl_sla_ms"]), (4, "fits in memory", f"{m['vram_gb']:.1f}", m["vram_gb"] <= m["vram_limit_gb"])]


def verdict(rules: list[tuple[int, str, str, bool]]) -> dict:
    """PROMOTED if every rule holds; else QUARANTINED, with what failed in order."""
    failed = [f"Tier {tier} Failed: {rule} ({seen})" for tier, rule, seen, ok in rules if not ok]
    return {"verdict": "QUARANTINED" if failed else "PROMOTED", "rejection_reasons": failed, **{f"tier{k}_passed": all(ok for tier, *_, ok in rules if tier == k) for k in range(1, 5)}}

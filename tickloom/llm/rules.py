"""Quality rules with risk-controlled thresholds.

The rules compare ratios of a text's features with cutoffs. Labelled documents
that pass the base rules are the holdout, each text once per stratum: copies are no
independent trials. Per stratum and rule, the strictest cutoff of a fixed grid is
taken whose false rejection of good documents is, by an exact (Clopper-Pearson)
binomial upper bound, at most the rule's share of ``ALPHA``. Cutoffs are tried from
lax to strict and the search stops at the first that fails (fixed-sequence testing,
which needs no correction along the grid).

Across the chains of strata and rules the error level ``DELTA`` is shared in equal
parts, step down: a chain that is safe to its strictest cutoff hands its part to the
others. Only chains that could ever pass take a part, which depends on the holdout's
size alone and not on what is rejected in it. Strata too small for that are pooled
and judged together. So with probability 1 - DELTA no stratum with cutoffs of its
own loses more than ALPHA of its good documents, nor do the pooled ones taken
together. A single one of them may, so a pooled cutoff is used in a stratum only as
far as its own holdout rejects no larger share; without labels it rejects nothing.
A rule without a safe cutoff rejects nothing.

Strata are the listed languages and one for all others, nulls included, so the
counts that reach the driver are bounded.

Defined results: null text has no words and fails the base rules. Several
labels of one id count as their majority (ties: good); labels without a value
are ignored. Repeated rows are judged alike; equal texts count once in the holdout.
An empty table gives an empty result; no labels, no cutoffs. Extra
columns are carried along except the text and those replaced by name.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.llm.common import replacing, staged, text_of

# Fixed values of the contract's base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

ALPHA, DELTA = 0.02, 0.05
STRATA = ("en", "de", "fr", "es")
OTHER, POOLED = "other", "pooled"
#: rule -> (numerator, denominator); larger is worse
RATIOS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
          "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}
#: cutoffs of a ratio from lax to strict
GRIDS = {"symbols": [2.0 ** (-k / 2) for k in range(1, 21)], "dup_lines": [1 - k / 20 for k in range(1, 20)],
         "repeats": [0.5 - k / 40 for k in range(20)], "word_length": [float(k) for k in range(40, 6, -1)]}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def text_counts(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()                    # bytes split at ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    seen, dup, lines = set(), 0, 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
            lines += 1
        elif line.strip():
            seen.add(line)
            lines += 1
    n, repeat = len(words), 0
    if n > 3:
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.array(list(map(number.__getitem__, words)), dtype=np.int64)
        pairs = ids[:-1] * len(number) + ids[1:]
        if len(number) > 2_000_000:         # keep the window's number inside 64 bits
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        windows = pairs[:-1] * len(number) + ids[2:]
        order = np.argsort(windows, kind="stable")
        same = np.diff(windows[order]) == 0
        if same.any():
            twice = np.zeros(n - 2, dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            in_window = np.zeros(n, dtype=bool)
            for k in range(3):
                in_window[k:n - 2 + k] |= twice
            repeat = int(in_window.sum())
    return n, chars, sum(map(text.count, SYMBOLS)), dup, repeat, lines


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text plus ``COUNTS``, ``base_failed`` and the text's
    hash ``_r_th``."""
    docs = replacing(docs, *COUNTS, "base_failed", "kept")
    keep = [c for c in docs.columns if c != text]
    src = docs.select(*keep, F.xxhash64(text_of(text)).alias("_r_th"), text_of(text).alias("_r_text"))
    keep = [*keep, "_r_th"]
    schema = T.StructType([*(src.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    names = [f.name for f in schema]

    def run(batches):
        for b in batches:
            rows = np.array([text_counts(t) for t in b.column(len(keep)).to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], *(pa.array(rows.reshape(-1, len(COUNTS))[:, k].copy()) for k in range(len(COUNTS)))],
                names=names)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return src.mapInArrow(run, schema).withColumn("base_failed", failed)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-13:
            break
    return h


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p): the incomplete beta I_{1-p}(n - k, k + 1)."""
    if k >= n:
        return 1.0
    a, b, x = float(n - k), k + 1.0, 1.0 - p
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(p))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, p) / b


def is_safe(rejected: int, n: int, limit: float, delta: float) -> bool:
    """Whether the exact (Clopper-Pearson) upper bound at level ``delta`` on the
    rejection rate is at most ``limit``: a rate of ``limit`` would give so few
    rejections with chance ``delta`` at most."""
    return n > 0 and binomial_at_most(rejected, n, limit) <= delta


def stratum(col: str = "lang") -> Column:
    return F.when(F.col(col).isin(*STRATA), F.col(col)).otherwise(F.lit(OTHER))


def ratio(rule: str) -> Column:
    top, below = RATIOS[rule]
    return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))


def families(sizes: dict[str, int], limit: float, delta: float, rules: int) -> tuple[list[str], list[str]]:
    """Strata judged by themselves, and those that are pooled: as many of the
    largest as could pass without any rejection at their part of ``delta``, with a
    part for the pool."""
    order = sorted(sizes, key=lambda s: (-sizes[s], s))
    own = [s for k, s in enumerate(order, 1) if is_safe(0, sizes[s], limit, delta / (rules * (k + (k < len(order)))))]
    return own, [s for s in order if s not in own]


def step_down(chains: dict, limit: float, delta: float) -> dict:
    """{chain: index of its strictest safe cutoff} for chains of (number of trials,
    rejections per cutoff from lax to strict)."""
    at = dict.fromkeys(chains, 0)
    while True:
        active = [c for c in chains if at[c] < len(chains[c][1])]
        before = dict(at)
        for c in active:
            n, rejected = chains[c]
            while at[c] < len(rejected) and is_safe(rejected[at[c]], n, limit, delta / len(active)):
                at[c] += 1
        # a finished chain's part goes to the others, which then go on
        if all(at[c] < len(chains[c][1]) for c in active) or at == before:
            return {c: i - 1 for c, i in at.items() if i}


def cutoffs(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", lang: str = "lang",
            label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> dict[tuple[str, str], float]:
    """{(stratum, rule): cutoff} for the rules that may reject. Rows without the
    hash of their text are told apart by id."""
    good = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_r_id"))
            .agg(F.avg(label_col).alias("_r_q")).where("_r_q >= 0.5").select("_r_id"))
    held = rows.where(~F.col("base_failed")).join(good, F.col(id_col) == F.col("_r_id"))
    if "_r_th" not in rows.columns:
        held = held.withColumn("_r_th", F.col("_r_id"))

    # a document's step: how many cutoffs it fails, which are the strictest so many
    def failed(rule):
        value = ratio(rule)
        return F.size(F.filter(F.array(*map(F.lit, GRIDS[rule])), lambda c: value > c))

    trials = staged(held.select(stratum(lang).alias("_r_s"), "_r_th", *(failed(r).alias(r) for r in RATIOS)).distinct(),
                    "rules-trials")
    own_steps = _steps(trials)
    sizes = {s: sum(per["symbols"].values()) for s, per in own_steps.items()}
    limit = alpha / len(RATIOS)
    own, pooled = families(sizes, limit, delta, len(RATIOS))
    # a text of several pooled strata is one trial of the pool
    pool = _steps(trials.where(F.col("_r_s").isin(pooled)).withColumn("_r_s", F.lit(POOLED)).distinct()) if pooled else {}
    size = sum(pool[POOLED]["symbols"].values()) if pool else 0
    if not is_safe(0, size, limit, delta / (len(RATIOS) * (len(own) + 1))):
        pool = {}               # a pool that could not pass takes no part
    tested = {**{s: own_steps[s] for s in own}, **pool}
    found = step_down({(s, r): _rejections(per, r) for s, per in tested.items() for r in RATIOS}, limit, delta)
    out = {(s, r): GRIDS[r][i] for (s, r), i in found.items() if s != POOLED}
    for (_, r), i in ((c, i) for c, i in found.items() if c[0] == POOLED):
        for s in pooled:        # no stricter than the stratum's own holdout bears
            n, rejected = _rejections(own_steps[s], r)
            borne = [k for k in range(i + 1) if rejected[k] <= limit * n]
            if borne:
                out[s, r] = GRIDS[r][borne[-1]]
    return out


def _steps(trials: DataFrame) -> dict[str, dict[str, dict[int, int]]]:
    """{stratum: {rule: {step: number of trials}}}; at most as many numbers as there
    are strata, rules and cutoffs."""
    counts = (trials.select("_r_s", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("step"))
                                                        for r in RATIOS))).alias("e"))
              .groupBy("_r_s", "e.rule", "e.step").agg(F.count(F.lit(1)).alias("n")).collect())
    out: dict = {}
    for c in counts:
        out.setdefault(c["_r_s"], {}).setdefault(c["rule"], {})[c["step"]] = c["n"]
    return out


def _rejections(per: dict, rule: str) -> tuple[int, list[int]]:
    """Trials of a rule, and how many each cutoff rejects, from lax to strict."""
    steps, m = per[rule], len(GRIDS[rule])
    return sum(steps.values()), [sum(n for k, n in steps.items() if k >= m - i) for i in range(m)]


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
          lang: str = "lang") -> DataFrame:
    """One row per input row without its text: counts, ``base_failed``, ``kept``."""
    rows = staged(features(docs, text), "rules-features")
    bad = F.lit(False)
    for (s, rule), c in sorted(cutoffs(rows, labels, id_col, lang).items()):
        bad = bad | ((F.col("_r_s") == s) & (ratio(rule) > c))
    return rows.withColumn("_r_s", stratum(lang)).withColumn("kept", ~F.col("base_failed") & ~bad).drop("_r_s", "_r_th")

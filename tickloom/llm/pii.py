"""Personal data by bootstrapped contextual extraction.

The base rules (e-mail, IP address, card and phone number) give the seeds. Every
seed and every other identifier-like string is an occurrence of an instance (its
text) in up to three lexical patterns: the word before it, the two words before
it, and the words on both sides. On the bipartite graph of patterns and
instances scores go back and forth: a pattern's score for a kind is the share of
its instances' scores, an instance's is the noisy-or of the patterns that
qualify. Against a pattern count base matches of other kinds and instances whose
look excludes the kind; an unknown one whose look allows it weighs as much as
its current score, but a pattern needs scores of MIN_SHARE of all that may be of
the kind, so a few seeds among many plain numbers find nothing. Patterns with enough instances and a high score discover the
occurrences the rules missed, which the next round counts in. Found spans are
added; base spans never change. All of it is built-in functions: spans come from
``split`` and ``regexp_extract_all``, rounds are joins and partial aggregates on
pairs of 64-bit hashes, and a pattern or instance with very many rows is
aggregated before it is shuffled.

Out of reach: what has none of the looks of ``_LOOSE`` (an at sign, 7 or more
digits, hexadecimal groups with colons) is never an occurrence, so no context
finds it, as "john [at] example [dot] com".

Defined results: null text counts as empty. Null ids and repeated rows get their
spans like any row; copies of a text add no evidence, because instances count
once per pattern. A found span that overlaps a base span or an earlier found one
is dropped. An empty table gives an empty result. Extra
columns named in ``keep`` are carried along unless the result has the name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import staged, text_of

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 5         # instances' scores a pattern must have for a kind
MIN_SCORE = 0.8         # of a qualifying pattern, and of a found instance
MIN_SHARE = 0.5         # scores a pattern must have per instance that may be of the kind
ROUNDS = 3
CONTEXT = 64            # characters looked at on each side for words
_BLOCK = 256

# The base rules, written for a backtracking matcher: runs are possessive and
# start where a run starts, which finds the same matches in linear time.
_LOCAL = r"A-Za-z0-9._%+-"
_EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
_HINT = {"email": "@", "phone": "+"}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_VALID = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

# What else looks like an identifier: anything around an at sign, long numbers
# with separators, groups of hexadecimal digits with colons.
_EDGE = r"\s@<>\"'(),;"
_LOOSE = (rf"(?<![^{_EDGE}])[^{_EDGE}]++@[^{_EDGE}]++|(?<![0-9A-Za-z:])[0-9A-Fa-f]{{1,4}}(?::{{1,2}}[0-9A-Fa-f]{{1,4}}){{3,7}}+"
          r"|\(?(?<![0-9])[0-9](?:[\x20().:/-]{0,2}+[0-9]){6,}+")
_ANY = "|".join(f"(?:{r})" for r in (_EMAIL, _PHONE, _IP, _CARD, _LOOSE))


def _spans(rows: DataFrame, text: str, rule: str, out: str, when: Column, context: bool = False) -> DataFrame:
    """``rows`` plus array ``out`` of struct(start, end, value[, before, after]),
    leftmost non-overlapping, in code points. Ends are running sums over the
    lengths of gaps and matches, in blocks so that they stay near linear."""
    m, g, n, c, p = (f"{out}_{x}" for x in "mgncp")
    t = F.when(when, F.col(text)).otherwise(F.lit(""))
    rows = rows.withColumns({m: F.regexp_extract_all(t, F.lit(rule), F.lit(0)), g: F.split(t, rule, -1)})
    add = "0, (s, x) -> s + x"
    rows = rows.withColumn(n, F.expr(f"zip_with(slice({g}, 1, size({m})), {m}, (a, b) -> length(a) + length(b))"))
    rows = rows.withColumn(c, F.expr(
        f"if(size({m}) = 0, cast(array() as array<int>), transform(sequence(0, cast((size({m}) - 1) div {_BLOCK} as int)), "
        f"k -> aggregate(slice({n}, k * {_BLOCK} + 1, {_BLOCK}), {add})))"))
    rows = rows.withColumn(p, F.expr(f"transform({c}, (v, k) -> aggregate(slice({c}, 1, k), {add}))"))
    end = (f"{p}[cast(k div {_BLOCK} as int)] + "
           f"aggregate(slice({n}, cast(k div {_BLOCK} as int) * {_BLOCK} + 1, k % {_BLOCK} + 1), {add})")
    words = f", 'before', right({g}[k], {CONTEXT}), 'after', left({g}[k + 1], {CONTEXT})" if context else ""
    rows = rows.withColumn(out, F.expr(
        f"transform({m}, (v, k) -> named_struct('start', {end} - length(v), 'end', {end}, 'value', v{words}))"))
    return rows.drop(m, g, n, c, p)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(_IP_VALID)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _only(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _named(spans, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def of_kind(spans, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _kind(value: Column) -> Column:
    """Kind of an occurrence that is a whole base match, else null."""
    out = F.lit(None).cast("string")
    for k, rule in reversed([(k, BASE[k]) for k in ("email", "phone", "ip", "card")]):
        whole = rule.replace(r"\G|", "") if k == "email" else rule
        out = F.when(value.rlike(f"^(?:{whole})$") & _valid(k, value), F.lit(k)).otherwise(out)
    return out


def _may_be(value: Column) -> Column:
    """Kinds that the look of an unknown occurrence allows."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    dots = F.length(F.regexp_replace(value, "[^.]", ""))
    return (F.when(F.contains(value, F.lit("@")), F.array(F.lit("email")))
            .when(value.rlike(r"^[0-9A-Fa-f:]+:[0-9A-Fa-f:]+:[0-9A-Fa-f:]+$") | (value.rlike(r"^[0-9.]+$") & (dots == 3)),
                  F.array(F.lit("ip")))
            .otherwise(F.concat(F.when(digits.between(7, 15), F.array(F.lit("phone"))).otherwise(F.array().cast("array<string>")),
                                F.when(digits.between(12, 19), F.array(F.lit("card"))).otherwise(F.array().cast("array<string>")))))


def occurrences(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row per input row, without its text: ``keep`` columns, the base spans
    of each kind, and ``_f_occ``: occurrences with kind or possible kinds and
    the hashes of instance and patterns. ``_f_row`` numbers the rows."""
    rows = docs.select(*keep, text_of(text).alias("_f_t"))
    rows = rows.withColumn("_f_digit", F.col("_f_t").rlike("[0-9]"))
    for k in KINDS:
        when = F.col("_f_digit") if k not in _HINT else F.contains("_f_t", F.lit(_HINT[k]))
        rows = _spans(rows, "_f_t", BASE[k], f"_f_{k}", when)
        rows = rows.withColumn(f"_f_{k}", F.transform(
            _only(f"_f_{k}", k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    rows = _spans(rows, "_f_t", _ANY, "_f_all", F.col("_f_digit") | F.contains("_f_t", F.lit("@")), context=True)

    def word(s):        # a context word: lower case, digits alike
        return F.regexp_replace(F.lower(s), "[0-9]", "0")

    def occurrence(s):
        before = F.regexp_extract_all(s["before"], F.lit(r"[^\s]+"), F.lit(0))
        after = F.regexp_extract_all(s["after"], F.lit(r"[^\s]+"), F.lit(0))
        l1 = F.coalesce(word(F.try_element_at(before, F.lit(-1))), F.lit(""))
        l2 = F.coalesce(word(F.try_element_at(before, F.lit(-2))), F.lit(""))
        r1 = F.coalesce(word(F.try_element_at(after, F.lit(1))), F.lit(""))
        kind = _kind(s["value"])
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), kind.alias("kind"),
                        F.when(kind.isNull(), _may_be(s["value"])).alias("may"), F.xxhash64(F.lower(s["value"])).alias("inst"),
                        F.array(F.xxhash64(F.lit("before"), l1), F.xxhash64(F.lit("two before"), l2, l1),
                                F.xxhash64(F.lit("around"), l1, r1)).alias("pats"))

    rows = rows.withColumn("_f_occ", F.transform("_f_all", occurrence)).drop("_f_t", "_f_digit", "_f_all")
    return staged(rows.withColumn("_f_row", F.monotonically_increasing_id()), "pii-rows")


def discover(rows: DataFrame, rounds: int = ROUNDS, min_support: float = MIN_SUPPORT,
             min_score: float = MIN_SCORE, min_share: float = MIN_SHARE) -> DataFrame:
    """``_f_row, start, end, kind`` of the occurrences that patterns find."""
    occ = rows.select("_f_row", F.explode("_f_occ").alias("o")).select("_f_row", "o.*")
    # the graph: an instance counts once per pattern
    edges = (occ.select(F.explode("pats").alias("pat"), "inst", "kind", "may").groupBy("pat", "inst")
             .agg(*(F.max(F.when(F.col("kind") == k, 1.0).otherwise(0.0)).alias(f"seed_{k}") for k in KINDS),
                  *(F.max(F.when(F.array_contains("may", k), 1).otherwise(0)).alias(f"may_{k}") for k in KINDS)))
    # only a pattern with so many instances can ever qualify
    edges = staged(edges, "pii-edges")
    often = edges.groupBy("pat").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)
    edges = staged(edges.join(staged(often, "pii-often"), "pat"), "pii-graph")
    scores = None
    for _ in range(rounds):
        given = edges if scores is None else edges.join(scores, "inst", "left")
        now = {k: F.greatest(F.col(f"seed_{k}"), F.coalesce(F.col(f"found_{k}"), F.lit(0.0)) if scores is not None
                             else F.lit(0.0)) for k in KINDS}
        base = F.greatest(*(F.col(f"seed_{k}") for k in KINDS)) > 0
        weight = {k: F.when(~base & (F.col(f"may_{k}") == 1), now[k]).otherwise(1.0) for k in KINDS}
        pats = given.groupBy("pat").agg(*(F.sum(now[k]).alias(f"sum_{k}") for k in KINDS),
                                        *(F.sum(weight[k]).alias(f"all_{k}") for k in KINDS),
                                        *(F.sum(F.greatest(f"seed_{k}", f"may_{k}")).alias(f"like_{k}") for k in KINDS))
        share = {k: F.col(f"sum_{k}") / (F.col(f"all_{k}") + 1) for k in KINDS}
        good = {k: F.when((F.col(f"sum_{k}") >= min_support) & (F.col(f"sum_{k}") >= min_share * F.col(f"like_{k}"))
                          & (share[k] >= min_score), share[k]).otherwise(0.0) for k in KINDS}
        pats = pats.select("pat", *(good[k].alias(f"pat_{k}") for k in KINDS))
        pats = staged(pats.where(" or ".join(f"pat_{k} > 0" for k in KINDS)), "pii-patterns")
        # noisy-or over the patterns, for unknown instances whose look allows the kind
        unknown = edges.where(" and ".join(f"seed_{k} = 0" for k in KINDS)).join(pats, "pat")
        scores = staged(unknown.groupBy("inst").agg(*(
            (1.0 - F.exp(F.sum(F.log(F.lit(1.0) - F.col(f"pat_{k}") * F.col(f"may_{k}"))))).alias(f"found_{k}")
            for k in KINDS)), "pii-scores")
    found = scores.where(" or ".join(f"found_{k} >= {min_score}" for k in KINDS))
    order = {k: i for i, k in enumerate(KINDS)}
    best = F.array_max(F.array(*(F.struct(F.col(f"found_{k}").alias("s"), F.lit(-order[k]).alias("i"), F.lit(k).alias("k"))
                                 for k in KINDS)))["k"]
    found = found.select("inst", best.alias("kind"))
    # an occurrence is found in a qualifying pattern, not by its text alone
    here = occ.where(F.col("kind").isNull() & (F.size("may") > 0)).select("_f_row", "start", "end", "inst", F.explode("pats").alias("pat"))
    here = here.join(found, "inst").join(pats, "pat")
    fits = F.lit(False)
    for k in KINDS:
        fits = fits | ((F.col("kind") == k) & (F.col(f"pat_{k}") > 0))
    return here.where(fits).select("_f_row", "start", "end", "kind").distinct()


def extract(docs: DataFrame, keep: list[str], text: str = "text", **limits) -> DataFrame:
    """One row per input row: ``keep`` columns, ``base`` and ``spans``, arrays of
    struct(kind, start, end) by kind as listed, then start."""
    keep = [c for c in keep if c not in ("base", "spans")]
    rows = occurrences(docs, keep, text)
    found = discover(rows, **limits)
    per = staged(found.groupBy("_f_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("_f_found")), "pii-found")
    base = {k: _named(f"_f_{k}", k) for k in KINDS}
    rows = rows.withColumn("base", F.concat(*base.values())).join(per, "_f_row", "left")
    clear = F.filter(F.coalesce("_f_found", F.array().cast("array<struct<start:int,end:int,kind:string>>")), lambda f: ~F.exists(
        "base", lambda b: (b["start"] < f["end"]) & (f["start"] < b["end"])))
    rows = rows.withColumn("_f_new", clear)
    merged = [F.sort_array(F.concat(base[k], _named(of_kind("_f_new", k), k))) for k in KINDS]
    return rows.select(*keep, "base", F.concat(*merged).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


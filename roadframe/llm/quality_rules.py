"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects a document if a statistic lies beyond a cutoff. Cutoffs are
chosen for each stratum from labelled holdouts: of the documents labelled good
that pass the base rules, k of n lie beyond a cutoff; the cutoff is certified
if the exact binomial tail P(X <= k), X ~ Binomial(n, risk / rules), is at most
``error / (strata * rules)``, which is the exact (Clopper-Pearson) upper bound.
The division is a Bonferroni correction over strata and rules. Within one of
them the cutoffs are a fixed sequence from the most lenient on: k grows along
it, so the certified ones are those before the first failure and need no
further correction. With probability 1 - error no stratum loses more than a
share ``risk`` of its good documents to all rules together. Of the certified
cutoffs the one that rejects most of the labelled bad documents is used, less
``PRICE`` times the share of good ones; a rule that would reject none or has no
certified cutoff is off in that stratum.

Strata are a fixed list of values of one column; all other values and nulls
form one more stratum, so the table of cutoffs has a fixed size.

Defined cases: a null text has no words, fails the base rules and is rejected;
null or missing labels don't count; a document with several labels counts once
for each; repeated documents are judged alike; without labels no rule is
certified and the base rules decide; columns named like the outputs are
replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import common
from roadframe.llm.common import let
from roadframe.llm.registry import register
from roadframe.session import read_table

STRATA = ("de", "en", "es", "fr")
RISK, ERROR = 0.05, 0.05
#: Shares of bad documents that the loss of a share of good ones is worth.
PRICE = 10
REPEAT_WINDOW = 8
MIN_WORDS, MOST_REPEATED = 20, 30

#: rule -> (statistic over the columns of ``measure``, +1 if large values are bad, -1 if small ones are, cutoffs).
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 1, (0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 1, (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 1, (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7)),
    "distinct": ("n_distinct / greatest(n_words, 1)", -1, (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6)),
    "long_words": ("word_chars / greatest(n_words, 1)", 1, (6.0, 6.5, 7.0, 8.0, 9.0, 10.0, 12.0)),
    "short_words": ("word_chars / greatest(n_words, 1)", -1, (2.0, 2.5, 3.0, 3.5, 4.0, 4.25, 4.5)),
    "capitals": ("n_capitals / greatest(word_chars, 1)", 1, (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)),
}
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_capitals"]


def _covered(keys: Column) -> Column:
    """Words in windows whose key stands twice or more in ``keys``, one key for each window in text order."""
    width = F.lit(REPEAT_WINDOW)

    def marked(s: Column) -> Column:  # sorted (key, position): neighbours of equal key are repeats
        at = F.sequence(F.lit(1), F.size(s))
        twice = F.filter(at, lambda i: ((i > 1) & (s[i - 2]["k"] == s[i - 1]["k"])) | ((i < F.size(s)) & (s[F.least(i, F.size(s) - 1)]["k"] == s[i - 1]["k"])))
        return F.array_sort(F.transform(twice, lambda i: s[i - 1]["p"]))

    def total(p: Column) -> Column:  # each window covers its words up to the next repeated window
        last = F.aggregate(p, F.struct(F.lit(-REPEAT_WINDOW).alias("p"), F.lit(0).alias("n")), lambda a, x: F.struct(x.alias("p"), (a["n"] + F.least(width, x - a["p"])).alias("n")))
        return last["n"]

    pairs = F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("p")))
    return F.when(F.size(keys) == F.size(F.array_distinct(keys)), F.lit(0)).otherwise(let(F.sort_array(pairs), lambda s: let(marked(s), total)))


def _window_keys(words: Column) -> Column:
    """A 64-bit hash of each window of words (equal windows are found by it, within one text)."""

    def keys(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - REPEAT_WINDOW), lambda i: F.xxhash64(*[h[i + j] for j in range(REPEAT_WINDOW)]))

    return F.when(F.size(words) >= REPEAT_WINDOW, let(F.transform(words, lambda w: F.xxhash64(w)), keys)).otherwise(F.array().cast("array<bigint>"))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the statistics of each whole text (``STATS``) and ``base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, "[ \\x09-\\x0D]+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    n = F.size

    def of_words(w: Column) -> Column:
        repeat = let(_window_keys(w), _covered)
        return F.struct(n(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), n(F.array_distinct(w)).cast("long").alias("n_distinct"), repeat.cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(n(x).cast("long").alias("n_lines"), (n(x) - n(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    def count(pattern: str) -> Column:
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("long")

    base = common.without(df, [*STATS, "base_failed"])
    out = base.withColumns({"__llm_words": let(words, of_words), "__llm_lines": let(lines, of_lines), "__llm_symbols": count("[#*$%&|<>]+"), "__llm_capitals": count("[A-Z]+")})
    stats = [F.col(f"__llm_words.{c}") if c in ("n_words", "word_chars", "n_repeat_words", "n_distinct") else F.col(f"__llm_lines.{c}") if c in ("n_lines", "n_dup_lines") else F.col("__llm_" + c[2:]).alias(c) for c in STATS]
    out = out.select(*[F.col(f"`{c}`") for c in base.columns], *stats)
    return out.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1 (Stirling's series at x + 8)."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(reduce(lambda a, b: a * b, [x + i for i in range(8)]))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); 1 where k is not below n p (no cutoff is certified there).

    Below the mean the terms fall off faster than geometrically, so all terms that count lie in the last
    ten standard deviations.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    steps = F.sequence(F.lit(0), F.least(k, F.ceil(F.sqrt(n * p) * 10) + 40).cast("int"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    tail = F.aggregate(steps, start, lambda a, i: F.struct((a["term"] * (k - i) / (n - k + i + 1) * ((1 - p) / p)).alias("term"), (a["sum"] + a["term"]).alias("sum")))["sum"]
    return F.when(k < n * p, top * tail).otherwise(F.lit(1.0))


def stratum(column: str, strata: tuple[str, ...]) -> Column:
    return F.when(F.col(column).isin(*strata), F.col(column)).otherwise(F.lit("other"))


def beyond(rule: str, cutoff: object) -> str:
    statistic, sign, _ = RULES[rule]
    return f"{statistic} {'>' if sign > 0 else '<'} {cutoff}"


def certify(measured: DataFrame, strata: tuple[str, ...], risk: float, error: float) -> DataFrame:
    """Labelled rows (``STATS``, base_failed, stratum, quality) -> one row for each stratum: a cutoff or null for each rule.

    The result has at most len(strata) + 1 rows.
    """
    trials = [(r, i, float(c)) for r, (_, _, cutoffs) in RULES.items() for i, c in enumerate(cutoffs)]
    tests = (len(strata) + 1) * len(RULES)
    lines = [F.expr(f"struct('{r}' AS rule, {i} AS step, {c}D AS cutoff, count_if(quality = 1 AND NOT base_failed AND {beyond(r, c)}) AS lost, count_if(quality = 0 AND NOT base_failed AND {beyond(r, c)}) AS caught)") for r, i, c in trials]
    table = measured.groupBy("stratum").agg(F.expr("count_if(quality = 1 AND NOT base_failed)").alias("good"), F.expr("count_if(quality = 0 AND NOT base_failed)").alias("bad"), F.array(*lines).alias("trials"))
    tried = table.select("stratum", "good", "bad", F.inline("trials"))
    tried = tried.withColumn("worth", F.expr(f"caught / greatest(bad, 1) - {PRICE} * lost / greatest(good, 1)")).where("good > 0 AND caught > 0 AND worth > 0")
    certified = tried.where(binomial_tail(F.col("lost"), F.col("good"), risk / len(RULES)) <= error / tests)
    best = [F.expr(f"max(CASE WHEN rule = '{r}' THEN struct(worth, step, cutoff) END).cutoff").alias(f"cut_{r}") for r in RULES]
    return certified.groupBy("stratum").agg(*best)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", strata_column: str = "lang",
          strata: tuple[str, ...] = STRATA, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Append ``STATS``, base_failed, rejected_by (names of the rules beyond their cutoffs) and kept."""
    return verdict(measure(common.without(docs, ["rejected_by", "kept"]), text), labels, key, strata_column, strata, risk, error)


def verdict(measured: DataFrame, labels: DataFrame, key: str = "doc_id", strata_column: str = "lang",
            strata: tuple[str, ...] = STRATA, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Append rejected_by and kept to rows that ``measure`` gave.

    The rows are written once and read twice, for the cutoffs (numbers of labelled rows alone) and for the
    verdict, so the statistics of a text are computed once.
    """
    rows = common.stage(measured, "measured")
    holdout = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("__llm_key"), F.col("quality"))
    narrow = rows.select(F.col(f"`{key}`").alias("__llm_key"), stratum(f"`{strata_column}`", strata).alias("stratum"), *STATS, "base_failed")
    cuts = certify(narrow.join(holdout, "__llm_key"), strata, risk, error)
    cuts = cuts.select([F.col(c).alias(f"__llm_{c}") for c in cuts.columns])
    out = rows.withColumn("__llm_own", stratum(f"`{strata_column}`", strata)).join(F.broadcast(cuts), F.col("__llm_own") == F.col("__llm_stratum"), "left")
    by = F.array_compact(F.array(*[F.expr(f"CASE WHEN {beyond(r, f'__llm_cut_{r}')} THEN '{r}' END") for r in RULES]))
    out = out.withColumn("__llm_by", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(by))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__llm_by").alias("rejected_by"), (~F.col("base_failed") & (F.size("__llm_by") == 0)).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with its columns."""
    return judge(docs, labels, **how).where("kept")


def oracle(strata: tuple[str, ...] = STRATA, risk: float = RISK, error: float = ERROR) -> str:
    p, tests = risk / len(RULES), (len(strata) + 1) * len(RULES)
    trials = ", ".join(f"{{'rule': '{r}', 'step': {i}, 'cutoff': CAST({float(c)} AS DOUBLE), 'lost': count(*) FILTER (quality = 1 AND NOT base_failed AND {beyond(r, c)}), 'caught': count(*) FILTER (quality = 0 AND NOT base_failed AND {beyond(r, c)})}}" for r, (_, _, cutoffs) in RULES.items() for i, c in enumerate(cutoffs))
    best = ", ".join(f"(max({{'worth': worth, 'step': t.step, 'cutoff': t.cutoff}}) FILTER (t.rule = '{r}')).cutoff AS cut_{r}" for r in RULES)
    fails = " OR ".join(f"coalesce({beyond(r, f'cut_{r}')}, false)" for r in RULES)
    return f"""
WITH d AS (SELECT doc_id, CASE WHEN lang IN ({", ".join(f"'{x}'" for x in strata)}) THEN lang ELSE 'other' END AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (SELECT doc_id, i, array_to_string(w[i : i + {REPEAT_WINDOW - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {REPEAT_WINDOW - 2})) AS i FROM w WHERE len(w) >= {REPEAT_WINDOW}))),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {REPEAT_WINDOW})) AS p FROM windows WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS n_distinct FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^ \\x09-\\x0D]') GROUP BY doc_id),
s AS (SELECT w.doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(lines.n - lines.n_distinct, 0) AS n_dup_lines, coalesce(lines.n, 0) AS n_lines, coalesce(repeats.n, 0) AS n_repeat_words, len(list_distinct(w)) AS n_distinct, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
      FROM w LEFT JOIN lines ON lines.doc_id = w.doc_id LEFT JOIN repeats ON repeats.doc_id = w.doc_id),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM s),
holdout AS (SELECT m.*, labels.quality FROM m JOIN labels ON labels.doc_id = m.doc_id WHERE labels.quality IN (0, 1)),
counted AS (SELECT stratum, count(*) FILTER (quality = 1 AND NOT base_failed) AS good, count(*) FILTER (quality = 0 AND NOT base_failed) AS bad, [{trials}] AS trials FROM holdout GROUP BY stratum),
tried AS (SELECT stratum, good, t, t.caught / greatest(bad, 1) - {PRICE} * t.lost / greatest(good, 1) AS worth FROM (SELECT stratum, good, bad, unnest(trials) AS t FROM counted)),
certified AS (SELECT * FROM tried WHERE good > 0 AND t.caught > 0 AND worth > 0 AND t.lost < good * {p}
              AND list_sum(list_transform(range(0, t.lost + 1), lambda i: exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({p}) + (good - i) * ln({1 - p})))) <= {error / tests}),
cuts AS (SELECT stratum AS cut_stratum, {best} FROM certified GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({fails}) AS kept
FROM m LEFT JOIN cuts ON cuts.cut_stratum = m.stratum
"""


@register("op9_quality_rules", oracle())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every whole document, strata by language."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = verdict(measure(docs).drop("text"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

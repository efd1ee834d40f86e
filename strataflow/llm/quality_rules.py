"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

Base counts are exact. On top, five statistics of a document can each reject it beyond a cutoff, in four steps from mild to strict. The cutoffs are
selected for each stratum (a range of document lengths) on labelled holdouts, halved by a hash of doc_id:

* The first half proposes: a rule takes part up to the strictest step at which it alone rejects at most ``risk`` / rules of the good documents there.
* The second half decides. The joint verdict of all rules, each up to step 1, then 2, 3, 4, is tested in that order by the exact binomial bound against the whole
  ``risk``, until a test fails. The verdicts are nested and their order is fixed before the second half is looked at, so each stratum spends its share of
  the level (``level`` / strata) once, however many steps there are. With confidence 1 - ``level`` all admitted verdicts reject at most a share ``risk`` of the good documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import crc_fold, stored, texts_of

WINDOW = 8
SPLIT = r"[\x20\x09-\x0D]+"
#: Statistics a rule may reject by, as hundredths of a share or as given; candidates go from strict to mild.
RULES = {"repeats": (2, 5, 10, 20), "lines": (10, 20, 30, 50), "symbols": (20, 50, 100, 200), "long_words": (900, 1100, 1300, 1600), "few_words": (160, 80, 40, 25)}
STEPS = 4
#: Strata by the number of words: the first number of each but the lowest.
STRATA = (100, 400)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _covered(at: Column) -> Column:
    """Words under windows that start at the positions, which ascend."""
    ends = F.aggregate(
        at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("int").alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n"), p.cast("int").alias("last")),
    )
    return ends["n"]


def _repeat_words(words: Column) -> Column:
    """Words in windows of 8 found twice or more. A window's name is a 64-bit hash of its words, joined by blanks."""
    names = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i, WINDOW), " ")))

    def positions(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda p: F.filter(
            F.transform(p, lambda x, k: F.when((F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]), x["i"])), lambda x: x.isNotNull()
        )
        return _covered(F.array_sort(_let(pairs, twice)))

    count = _let(names, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(positions(h)))
    return F.when(F.size(words) > WINDOW, count).otherwise(F.lit(0).cast("long"))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text. Null and empty texts have no words."""
    text = F.col("text")
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    facts = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
    ))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    repeats = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    own = texts_of(docs).select("doc_id", facts.alias("f"), symbols.cast("long").alias("n_symbols"), repeats.cast("long").alias("n_dup_lines"), (F.size(F.split(text, "\n"))).cast("long").alias("n_lines"))
    return own.select("doc_id", "f.n_words", "f.word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words", "n_lines")


def _cut(rule: str, value: int) -> int:
    """A cutoff on the scale of its statistic; few words are bad, so theirs are negative."""
    return -value if rule == "few_words" else value


def _statistics() -> Column:
    """The rules' statistics, whole numbers: the larger, the worse."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    values = {
        "repeats": F.floor(100 * F.col("n_repeat_words") / n), "lines": F.floor(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "symbols": F.floor(1000 * F.col("n_symbols") / c), "long_words": F.floor(100 * F.col("word_chars") / n), "few_words": -F.col("n_words"),
    }
    return F.array(*[
        F.struct(F.lit(r).alias("rule"), values[r].cast("long").alias("value"), F.array(*[F.lit(_cut(r, x)).cast("long") for x in xs]).alias("cuts")) for r, xs in RULES.items()
    ])


def _stratum() -> Column:
    return sum((F.col("n_words") >= s).cast("int") for s in STRATA)


def _tail(x: Column, n: Column, p: float) -> Column:
    """P(X <= x) of a binomial with n draws at p: terms from the first on, each from the one before, in logarithms."""
    step = lambda acc, i: F.struct(
        (acc["term"] + F.log((n - i) / (i + 1)) + F.log(F.lit(p / (1 - p)))).alias("term"), (acc["sum"] + F.exp(acc["term"])).alias("sum")
    )
    first = F.struct((n * F.log(F.lit(1 - p))).alias("term"), F.lit(0.0).alias("sum"))
    done = F.aggregate(F.sequence(F.lit(0).cast("long"), x), first, lambda acc, i: F.when(i < n, step(acc, i)).otherwise(F.struct(acc["term"].alias("term"), (acc["sum"] + F.exp(acc["term"])).alias("sum"))))
    return done["sum"]


def thresholds(counts: DataFrame, labels: DataFrame, risk: float, level: float) -> DataFrame:
    """stratum, rule, cutoff: the admitted cutoffs, from all labelled documents that pass the base rule.

    Good documents (quality 1) below the cutoff are right, those at or beyond it are false rejections. The result has a
    row for each stratum and rule at most, so broadcasting it is safe.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    own = counts.where(~F.col("base_failed")).join(good, "doc_id")
    # How many cutoffs a value reaches: at step t a rule rejects what reaches more than STEPS - t of them.
    reached = F.transform(_statistics(), lambda s: F.struct(s["rule"].alias("rule"), F.size(F.filter(s["cuts"], lambda c: c <= s["value"])).alias("reach")))
    seen = own.select(crc_fold(F.col("doc_id"), 2).alias("half"), _stratum().alias("stratum"), reached.alias("rules"))
    steps = range(1, STEPS + 1)

    one = seen.where("half = 0").select("stratum", F.inline("rules"))
    sums = one.groupBy("stratum", "rule").agg(F.count("*").alias("n"), *[F.count_if(F.col("reach") > STEPS - t).alias(f"x{t}") for t in steps])
    upto = sum((F.col(f"x{t}") <= risk / len(RULES) * F.col("n")).cast("int") for t in steps)
    proposed = sums.select("stratum", "rule", upto.alias("upto")).where("upto > 0")
    known = proposed.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "upto"))).alias("upto"))

    # The first step whose joint verdict rejects the document.
    first = F.array_min(F.transform("rules", lambda r: F.when((r["reach"] > 0) & (STEPS + 1 - r["reach"] <= F.try_element_at("upto", r["rule"])), STEPS + 1 - r["reach"])))
    joint = seen.where("half = 1").join(F.broadcast(known), "stratum").withColumn("first", first)
    tests = joint.groupBy("stratum").agg(F.count("*").alias("n"), *[F.count_if(F.col("first") <= t).alias(f"x{t}") for t in steps])
    spent = level / (len(STRATA) + 1)
    before = None
    for t in steps:
        x = F.col(f"x{t}")
        # Beyond the expected number no test succeeds, so the terms need not be summed.
        fails = F.coalesce(F.when(x < risk * F.col("n"), _tail(x, F.col("n"), risk) > spent), F.lit(True))
        before = F.when(fails, t - 1) if before is None else before.when(fails, t - 1)
    admitted = before.otherwise(STEPS)
    passed = tests.select("stratum", admitted.alias("step")).where("step > 0")
    cuts = F.create_map(*[x for r, values in RULES.items() for x in (F.lit(r), F.array(*[F.lit(_cut(r, v)).cast("long") for v in values]))])
    final = proposed.join(passed, "stratum")
    return final.select("stratum", "rule", F.get(F.element_at(cuts, F.col("rule")), STEPS - F.least("upto", "step")).alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.01, level: float = 0.05) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Without enough labels no cutoff is admitted and ``kept`` is what the base rule says.
    """
    counts = base_counts(docs).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    counts = stored(counts, "counts")
    cut = thresholds(counts, labels, risk, level).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    placed = counts.withColumn("stratum", _stratum()).join(F.broadcast(cut), "stratum", "left")
    beyond = F.exists(_statistics(), lambda s: F.coalesce(s["value"] >= F.try_element_at(F.col("cutoffs"), s["rule"]), F.lit(False)))
    kept = ~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False))
    return placed.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))

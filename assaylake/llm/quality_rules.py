"""Quality rules: a decision list learned by sequential covering, applied as one Spark expression.

``text_statistics`` measures every text with DataFrame functions. ``learn_decision_list`` grows conjunctions
of thresholds from labelled statistics, prunes each on rows it was not grown on, and emits them in
order. ``DecisionList.verdict`` turns the list into nested ``CASE WHEN``. All counting is Spark
aggregation; the driver sees one small histogram per growth step (features times bins).

Defined cases: a NULL or blank text has no words, all statistics 0, and fails the base rule. Repeated
rows are measured each for itself. A NULL label, or labels of one id that are evenly divided, teach
nothing. Without labelled rows of both kinds the list is empty and rejects nothing. Other columns are
passed on; one named like the result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assaylake.llm.names import unused

WORD_GAP = r"[\x20\x09-\x0D]+"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "mean_word_chars",
    "symbols_per_word",
    "dup_line_share",
    "repeat_word_share",
    "distinct_word_share",
    "upper_share",
    "exclamations_per_word",
    "words_per_line",
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _after(array: Column, n: int) -> Column:
    """``array`` without its first ``n`` elements."""
    return F.slice(array, n + 1, F.greatest(F.size(array), F.lit(1)))


def _with_window_hashes(docs: DataFrame, words: str, into: str) -> DataFrame:
    """A 64-bit hash of each window of 8 words: hashes of 1, 2 and 4 words are paired with the ones
    that follow them, which costs three hashes a word instead of eight."""
    step = f"{into}_1"
    docs = docs.withColumn(step, F.transform(words, lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        wider = f"{into}_{2 * width}"
        docs = docs.withColumn(wider, F.zip_with(step, _after(F.col(step), width), lambda a, b: F.xxhash64(a, b))).drop(step)
        step = wider
    n = F.size(words) - (WINDOW - 1)
    return docs.withColumn(into, F.when(n > 0, F.slice(step, 1, F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))).drop(step)


def _with_repeated_words(docs: DataFrame, hashes: str, into: str) -> DataFrame:
    """Words covered by windows whose hash occurs twice or more. Only where hashes repeat, windows are
    sorted by hash, neighbours compared, and the places found sorted again: n log n for any text."""
    pairs, at = f"{into}_pairs", f"{into}_at"
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    docs = docs.withColumn(pairs, F.when(repeats, F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    twins = F.zip_with(pairs, _after(F.col(pairs), 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))
    docs = docs.withColumn(at, F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull())))))
    widths = F.zip_with(at, _after(F.col(at), 1), lambda p, q: F.least(F.lit(WINDOW), q - p))
    total = F.aggregate(widths, F.lit(0).cast("long"), lambda total, w: total + w)
    return docs.withColumn(into, F.coalesce(total, F.lit(0).cast("long"))).drop(pairs, at)


def text_statistics(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """``docs`` with a struct of counts and shares. Window hashes are 64-bit; two windows of one text
    that differ but share a hash would count as repeats (odds about n^2 / 2^65)."""
    content, words, lines, hashes, repeated = unused(docs, *(f"_{into}_{name}" for name in ("text", "words", "lines", "hashes", "repeated")))
    out = docs.withColumn(content, F.coalesce(F.col(text).cast("string"), F.lit("")))
    out = out.withColumn(words, F.array_remove(F.split(content, WORD_GAP), "")).withColumn(
        lines, F.filter(F.split(content, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    out = _with_repeated_words(_with_window_hashes(out, words, hashes), hashes, repeated)
    chars = F.greatest(F.length(content), F.lit(1))
    per = lambda count, total: count / F.greatest(total, F.lit(1))
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(F.col(content), "[#*$%&|<>]").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.col(repeated).alias("n_repeat_words"),
        F.size(lines).alias("n_lines"),
        F.size(F.array_distinct(words)).alias("n_distinct"),
        _count(F.col(content), r"\p{Lu}").alias("n_upper"),
        _count(F.col(content), "!").alias("n_exclamations"),
        chars.alias("n_chars"),
    )
    out = out.withColumn(into, counts).drop(content, words, lines, hashes, repeated)
    s = lambda name: F.col(into)[name]
    return out.withColumn(
        into,
        F.struct(
            *(s(c).alias(c) for c in COUNTS),
            per(s("word_chars"), s("n_words")).alias("mean_word_chars"),
            per(s("n_symbols"), s("n_words")).alias("symbols_per_word"),
            per(s("n_dup_lines"), s("n_lines")).alias("dup_line_share"),
            per(s("n_repeat_words"), s("n_words")).alias("repeat_word_share"),
            per(s("n_distinct"), s("n_words")).alias("distinct_word_share"),
            per(s("n_upper"), s("n_chars")).alias("upper_share"),
            per(s("n_exclamations"), s("n_words")).alias("exclamations_per_word"),
            per(s("n_words"), s("n_lines")).alias("words_per_line"),
        ),
    )


def base_failed(statistics: Column) -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (statistics["n_words"] < 20) | (100 * statistics["n_repeat_words"] > 30 * statistics["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expression(self, statistics: Column) -> Column:
        value = statistics[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a text that none matches is kept."""

    rules: tuple[tuple[Condition, ...], ...] = field(default_factory=tuple)

    @staticmethod
    def matches(rule: tuple[Condition, ...], statistics: Column) -> Column:
        return reduce(lambda a, b: a & b, (c.expression(statistics) for c in rule))

    def verdict(self, statistics: Column) -> Column:
        """The first matching rule as text, else NULL."""
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            out = F.when(self.matches(rule, statistics), F.lit(" and ".join(map(str, rule)))).otherwise(out)
        return out


def _labelled(statistics: DataFrame, labels: DataFrame, doc_id: str, into: str, most: int) -> DataFrame:
    votes = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.avg(F.col("quality").cast("double")).alias("_q"))
        .where(F.col("_q") != 0.5)
        .select("_id", (F.col("_q") < 0.5).alias("bad"))
    )
    total = votes.count()
    if total > most:
        votes = votes.where(F.pmod(F.xxhash64(F.col("_id"), F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * most / total))
    return statistics.join(votes, F.col(doc_id) == F.col("_id")).select(
        "bad", *(F.col(into)[f].alias(f) for f in FEATURES), (F.pmod(F.xxhash64(F.col("_id"), F.lit(11)), F.lit(3)) > 0).alias("growing")
    )


def _candidates(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Thresholds to try: quantiles of each feature within each class."""
    steps = [(i + 0.5) / bins for i in range(bins)]
    asked = [F.percentile_approx(f, [0.0, *steps, 1.0], 10_000).alias(f) for f in FEATURES]
    found = {f: set() for f in FEATURES}
    for row in rows.groupBy("bad").agg(*asked).collect():
        for f in FEATURES:
            found[f].update(row[f] or [])
    return {f: sorted(v) for f, v in found.items()}


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    """FOIL's information gain of narrowing a rule from (p0, n0) to (p, n)."""
    from math import log2

    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn_decision_list(
    statistics: DataFrame,
    labels: DataFrame,
    *,
    scratch: str,
    doc_id: str = "doc_id",
    into: str = "statistics",
    most_labelled_rows: int = 50_000,
    bins: int = 16,
    most_rules: int = 12,
    most_conditions: int = 4,
    least_precision: float = 0.95,
    least_cover: int = 3,
) -> DecisionList:
    """Learn which statistics mark ``labels.quality`` = 0.

    About ``most_labelled_rows`` of the labelled rows, chosen by a hash of the id, are used. Two thirds
    grow the rules and one third prunes them; a rule enters the list only if it holds on the pruning
    rows with ``least_precision``. ``scratch`` is a shared folder for the labelled statistics.
    """
    spark = statistics.sparkSession
    path = f"{scratch}/labelled"
    _labelled(statistics, labels, doc_id, into, most_labelled_rows).write.parquet(path)
    rows = spark.read.parquet(path)
    totals = {r["bad"]: r["n"] for r in rows.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    if not totals.get(True) or not totals.get(False):
        return DecisionList()
    cuts = _candidates(rows, bins)
    rank = lambda f: reduce(lambda a, t: a + (F.col(f) > F.lit(t)).cast("int"), cuts[f], F.lit(0))
    binned = f"{scratch}/binned"
    rows.select("bad", "growing", *(rank(f).alias(f) for f in FEATURES)).coalesce(8).write.parquet(binned)
    rows = spark.read.parquet(binned)
    # in bins, "above threshold i" is rank > i, and "at most threshold i" is rank <= i
    holds = lambda c: (F.col(c[0]) > c[2]) if c[1] else (F.col(c[0]) <= c[2])
    all_of = lambda rule: reduce(lambda a, b: a & b, map(holds, rule), F.lit(True))

    learned: list[list[tuple[str, bool, int]]] = []
    left = rows
    while len(learned) < most_rules:
        rule: list[tuple[str, bool, int]] = []
        covered = left.where("growing")
        while len(rule) < most_conditions:
            pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES)))
            table = (
                covered.select("bad", pairs.alias("x"))
                .groupBy("x.f", "x.b")
                .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
                .collect()
            )
            if not table:
                break
            histogram = {(r["f"], r["b"]): (r["p"], r["n"]) for r in table}
            p0, n0 = (sum(v[i] for k, v in histogram.items() if k[0] == FEATURES[0]) for i in (0, 1))
            if not p0 or not n0 and rule:
                break
            best, best_gain = None, 1e-9
            for f in FEATURES:
                p = n = 0
                for i in range(len(cuts[f])):
                    dp, dn = histogram.get((f, i), (0, 0))
                    p, n = p + dp, n + dn
                    for above, cp, cn in ((False, p, n), (True, p0 - p, n0 - n)):
                        if cp >= least_cover and (gain := _gain(p0, n0, cp, cn)) > best_gain:
                            best, best_gain = (f, above, i), gain
            if best is None:
                break
            rule.append(best)
            covered = covered.where(holds(best))
        if not rule:
            break
        # pruning: how each prefix of the rule does on rows it was not grown on
        tests = [F.count_if(all_of(rule[:k]) & (F.col("bad") == b)).alias(f"{k}_{b}") for k in range(1, len(rule) + 1) for b in (True, False)]
        seen = left.where(~F.col("growing")).agg(*tests).first()
        worth = lambda k: (seen[f"{k}_True"] - seen[f"{k}_False"]) / max(1, seen[f"{k}_True"] + seen[f"{k}_False"])
        k = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
        p, n = seen[f"{k}_True"], seen[f"{k}_False"]
        if p < 1 or p < least_precision * (p + n):
            break
        learned.append(rule[:k])
        left = left.where(~all_of(rule[:k]))
    return DecisionList(tuple(tuple(Condition(f, above, float(cuts[f][i])) for f, above, i in rule) for rule in learned))

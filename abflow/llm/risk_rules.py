"""Quality rules with risk-controlled thresholds (operator 7).

Every rule is a ratio of two counts of a text, and rejects above a cutoff. For
each stratum (language) and rule the strictest cutoff of a fixed grid is taken for
which labelled good documents prove, by the exact binomial tail, that it rejects
at most ``RISK / number of rules`` of the good ones; the tests share the error
``DELTA`` over all strata, rules and grid points (Bonferroni). So with
probability ``1 - DELTA`` no stratum loses more than ``RISK`` of its good documents
to the rules. A rule without a proven cutoff does not reject.

DataFrame functions only, in one pass over the texts: all counts are made
within the row, the texts are never shuffled.

Defined cases: null text is empty; an empty ratio (0 / 0) rejects nothing; a
null stratum is a stratum named ``''``; of several labels of one id the smallest counts,
null ids have none; repeated rows get the same answer each; other columns are
ignored. Windows of three words are compared by 64-bit hashes within a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, read_table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
RISK, DELTA = 0.05, 0.05
MAX_BROADCAST_STRATA = 10_000
#: rule: numerator, denominator, cutoffs in thousandths
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "n_words", (10, 20, 50, 100, 150, 200, 300, 400, 600, 1000)),
    "dup_lines": ("n_dup_lines", "n_lines", (50, 100, 150, 200, 250, 300, 400, 500, 600, 800)),
    "repeats": ("n_repeat_words", "n_words", (20, 50, 100, 150, 200, 250, 300, 350, 400, 450)),
    "long_words": ("word_chars", "n_words", (6000, 6500, 7000, 7500, 8000, 9000, 10000, 12000, 15000, 20000)),
    "capitals": ("n_capitals", "word_chars", (50, 75, 100, 150, 200, 300, 400, 500, 600, 800)),
    "marks": ("n_marks", "n_words", (5, 10, 20, 50, 100, 200, 300, 500, 800, 1000)),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def occurrences(text: Column, chars: str) -> Column:
    """Times that single-byte characters occur."""
    n = F.lit(0)
    for c in chars:
        n = n + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return n.cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside a three-word window that the text has twice or more.

    The windows are sorted by hash, equal neighbours give the places, and each
    place covers three words or those up to the next place.
    """
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    def places(s: Column) -> Column:
        twice = lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    return F.when(F.size(words) >= 3, let(F.sort_array(windows(words)), lambda s: let(places(s), covered))).otherwise(0).cast("long")


def measure(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of each text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), text.alias("text"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    t = F.col("text")
    return d.select(
        "doc_id", "stratum",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                                      repeated_words(w).alias("n_repeat_words"))).alias("w"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        occurrences(t, SYMBOLS).alias("n_symbols"), occurrences(t, "!").alias("n_marks"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, "[A-ZÀ-ÖØ-Þ]", ""))).cast("long").alias("n_capitals"),
    ).select("doc_id", "stratum", "w.*", "l.*", "n_symbols", "n_marks", "n_capitals")


def tail(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X binomial over n trials with probability risk; exact, for k under n * risk."""
    odds = (1 - risk) / risk
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    log_top = F.aggregate(steps, F.lit(0.0), lambda a, i: a + F.log((n - i + 1) / i)) + k * F.log(F.lit(risk)) + (n - k) * F.log(F.lit(1 - risk))
    # from k down: the terms below, relative to that of k
    below = F.aggregate(F.reverse(steps), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
                        lambda a, i: F.struct((a["term"] * i / (n - i + 1) * odds).alias("term"),
                                              (a["total"] + a["term"] * i / (n - i + 1) * odds).alias("total")))
    return F.exp(log_top) * below["total"]


def rejects(rule: str, cutoff: Column | int) -> Column:
    """The rule's ratio is over cutoff thousandths; in integers."""
    above, below, _ = RULES[rule]
    return 1000 * F.col(above) > F.lit(cutoff).cast("long") * F.col(below) if isinstance(cutoff, int) else 1000 * F.col(above) > cutoff * F.col(below)


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cutoff: the strictest proven ones, from labelled good documents."""
    good = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    grid = [(r, c) for r, (_, _, cs) in RULES.items() for c in cs]
    seen = measured.join(good, "doc_id").groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(rejects(r, c)).alias(f"{r}_{c}") for r, c in grid])
    cells = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).cast("long").alias("cutoff"), F.col(f"{r}_{c}").alias("k")) for r, c in grid])
    tests = seen.select("stratum", "n", F.explode(cells).alias("x")).select("stratum", "n", "x.*")
    number = seen.agg((F.count(F.lit(1)) * len(grid)).alias("tests"))
    each = risk / len(RULES)
    proven = tests.join(F.broadcast(number)).filter(F.col("k") < F.col("n") * each).filter(tail(F.col("n"), F.col("k"), each) <= delta / F.col("tests"))
    return proven.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(measured: DataFrame, proven: DataFrame) -> DataFrame:
    """measured with base_failed and kept."""
    per = proven.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    per = cut(per)
    if per.count() <= MAX_BROADCAST_STRATA:  # one row a stratum
        per = F.broadcast(per)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = measured.join(per, "stratum", "left").withColumn("base_failed", failed)
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(rejects(r, F.col(f"cut_{r}")), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~over).drop(*[f"cut_{r}" for r in RULES])


def op7(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts and verdict of every document, strata by language."""
    measured = cut(measure(read_table(spark, sf_dir, "documents")))
    out = judge(measured, cutoffs(measured, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    grid = ", ".join(f"('{r}', {c})" for r, (_, _, cs) in RULES.items() for c in cs)
    ratio = " ".join(f"WHEN '{r}' THEN 1000 * {a} > cutoff * {b}" for r, (a, b, _) in RULES.items())
    each = RISK / len(RULES)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
three AS (SELECT rid, i, words[i:i+2] AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM three) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, range(3) r(j) GROUP BY rid),
m AS MATERIALIZED (SELECT rid, d.doc_id, stratum, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  (length(t) - length(replace(t, '!', '')))::BIGINT AS n_marks, (length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')))::BIGINT AS n_capitals
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid)),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
grid(rule, cutoff) AS (VALUES {grid}),
seen AS (SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (CASE rule {ratio} END) AS k
  FROM m JOIN good USING (doc_id), grid GROUP BY ALL),
tested AS (SELECT *, (SELECT count(*) FROM seen) AS tests FROM seen),
proven AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM tested
  WHERE k < n * {each!r} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0)
    + i * ln({each!r}) + (n - i) * ln(1 - {each!r})))) <= {DELTA!r} / tests GROUP BY ALL),
over AS (SELECT rid FROM m JOIN proven USING (stratum) WHERE CASE rule {ratio} END GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND over.rid IS NULL AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m) x
LEFT JOIN over USING (rid)"""


ORACLE = _oracle()

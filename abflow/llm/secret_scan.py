"""Secret scan with a random forest against false positives (operator 4).

A candidate is the whole value after a keyword and ``=`` or ``:``, whatever its signs and length, or else
a run of eight or more letters, digits and ``_+/-`` (and ``=`` padding) with a digit in it, with
a strict format (``FORMATS``), with two rises from small to capital letters, or of ``LONG`` or more letters.
Other runs without a digit (words of one case and up to 23 letters, no keyword) aren't candidates. Its features are its length, its character
transitions, what is covered by dictionary words, signs of a path or address
around it, and the neighbouring words. A random forest trained from labelled
findings votes; from half of the trees on it is a secret.

The candidates stay in an array of their row and the trees are compiled to SQL
expressions over it, so neither scanning nor redaction moves a text. DataFrame
functions and Spark's own forest only.

Labelled findings are an argument (``label`` 1 secret, 0 not). The given tables
have none, so the query labels those of its findings that a strict format or a
strict counter-sign decides (``by_format``), of each kind at most ``PER_CLASS`` by hash, and
adds all ``examples`` of common kinds after that. A kind of the corpus weighs no more than a kind
of the examples, so the verdicts don't depend on the size of the corpus.

Defined cases: null text has no candidate and stays null; repeated rows get
the same answer each; a null ``doc_id`` is scanned like any other; with one class alone in the
labels every candidate gets that class, without labels the vote is 0.5; other
columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, read_table
from .risk_rules import SPACE, let

CORE = r"[A-Za-z0-9_+/\-]{8,}={0,2}"
#: a digit-free run that is a candidate all the same; the format that proves a secret
FORMATS = r"AKIA[0-9A-Z]{16}|eyJ[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]*"
LONG = 24
ODD = rf"[0-9]|{FORMATS}|([a-z]+[A-Z]+){{2}}|[A-Za-z]{{{LONG}}}"
RUN = rf"{FORMATS}|{CORE}"
#: a keyword up to the sign (not "author:" or "secretary:"), the sign, a value
_KEY = r"(?i)(?:pass(?:word|wd|phrase)|pwd|secret(?!ar)|token|api.?key|access.?key|auth(?!or(?!iz))|credential|private)[A-Za-z0-9_.\-]*[\"'\]]*"
_VALUE = r"[\"']?[^\s\"']+"
WITHIN = _KEY + "[=:]+>?" + _VALUE
ACROSS = _KEY + r"(?: [=:]+>? ?|[=:]+>? )[\"']?([^\s\"']+)\S*$"
KEYWORDS = r"(?i)pass(word|wd|phrase)|pwd|secret|token|api.?key|access.?key|auth|credential|private"
ADDRESS = r"@|://|www\.|\.[a-z]{2,5}$|^[/.~]|\\"
#: words that names, paths and identifiers are made of
DICTIONARY = ("access", "account", "address", "admin", "angle", "article", "author", "build", "class", "client", "code", "config", "content", "copy", "data", "date",
              "default", "detail", "document", "domain", "download", "draft", "example", "file", "final", "folder", "group", "host", "image", "index", "info", "item",
              "json", "label", "line", "link", "list", "local", "login", "mail", "main", "media", "model", "module", "name", "node", "none", "null", "number", "object", "order",
              "page", "part", "path", "photo", "post", "product", "project", "public", "release", "report", "required", "result", "sample", "script", "section", "server",
              "service", "session", "source", "state", "status", "store", "string", "style", "system", "table", "test", "text", "title", "true", "type", "update", "user", "value",
              "version", "video", "view", "week", "word", "year")
MASK = "[SECRET]"
PER_CLASS = 5000
KIND_WEIGHT = 150  # of all training rows of one kind; the examples have as many rows of a kind
TREES, DEPTH, SEED = 25, 5, 7
FEATURES = ["length", "transitions", "digits", "capitals", "hex", "variety", "dictionary", "address", "keyword", "assigned", "quoted", "keyword_after"]


def _share(c: Column, pattern: str) -> Column:
    """Part of the characters that the pattern covers."""
    return 1 - F.char_length(F.regexp_replace(c, pattern, "")) / F.greatest(F.char_length(c), F.lit(1))


def _candidate(words: Column, i: Column, w: Column, core: Column) -> Column:
    """A candidate and its features; words are those of the text, w the i-th."""
    own = F.call_function("substring_index", w, core, F.lit(1))
    left = F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), own)
    right = F.coalesce(F.get(words, i + 1), F.lit(""))
    yes = lambda cond: F.when(cond, 1.0).otherwise(0.0)
    size = F.char_length(core)
    return F.struct(
        core.alias("text"), i.alias("word"), size.cast("double").alias("length"),
        (F.size(F.regexp_extract_all(core, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"), F.lit(0))) / size).alias("transitions"),
        _share(core, "[0-9]").alias("digits"), _share(core, "[A-Z]").alias("capitals"), yes(F.regexp_like(core, F.lit("^([0-9a-f]+|[0-9A-F]+)$"))).alias("hex"),
        (F.size(F.array_distinct(F.split(core, ""))) / size).alias("variety"), _share(F.lower(core), "|".join(DICTIONARY)).alias("dictionary"),
        yes(F.regexp_like(w, F.lit(ADDRESS)) | F.contains(core, F.lit("/"))).alias("address"), yes(F.regexp_like(left, F.lit(KEYWORDS))).alias("keyword"),
        yes(F.regexp_like(left, F.lit("[=:]\\s*[\"']?$"))).alias("assigned"), yes(F.regexp_like(own, F.lit("[\"']$"))).alias("quoted"),
        yes(F.regexp_like(right, F.lit(KEYWORDS))).alias("keyword_after"))


def _values(words: Column, i: Column, w: Column) -> Column:
    """What the i-th word w holds of values assigned to a keyword, without quotes and closing signs."""
    within = F.transform(F.regexp_extract_all(w, F.lit(WITHIN), F.lit(0)), lambda m: F.regexp_replace(m, r"^[^=:]*[=:]+>?[\"']?", ""))
    across = F.regexp_extract(F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), w), ACROSS, 1)
    both = F.transform(F.concat(F.array(across), within), lambda v: F.regexp_replace(v, r"[,;.)\]}>]+$", ""))
    return F.array_distinct(F.filter(both, lambda v: F.regexp_like(v, F.lit("[A-Za-z0-9]")) & F.contains(w, v)))


def candidates(text: Column) -> Column:
    """The text's candidates as an array of structs, in order."""
    def per_word(words: Column, i: Column, w: Column, keyed: Column) -> Column:
        def of(values: Column) -> Column:
            # the runs of the rest; digits or an odd form make them candidates
            rest = F.aggregate(values, w, lambda t, v: F.replace(t, v, F.lit(" ")))
            own = F.filter(F.regexp_extract_all(rest, F.lit(RUN), F.lit(0)), lambda c: F.regexp_like(c, F.lit(ODD)))
            return F.transform(F.concat(own, values), lambda c: _candidate(words, i, w, c))
        return let(F.when(keyed, _values(words, i, w)).otherwise(F.array().cast("array<string>")), of)

    def found(words: Column, keyed: Column) -> Column:
        def gate(i: Column) -> Column:
            w = F.get(words, i)
            return ((F.char_length(w) >= 8) & F.regexp_like(w, F.lit(CORE)) & F.regexp_like(w, F.lit(ODD))) | (keyed & (F.size(_values(words, i, w)) > 0))
        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), gate)
        return F.flatten(F.transform(at, lambda i: let(F.get(words, i), lambda w: per_word(words, i, w, keyed))))
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # most texts assign nothing to a keyword: that is looked up once a text
    return let(F.struct(F.split(whole, SPACE).alias("words"), F.regexp_like(whole, F.lit(_KEY + r"\s*[=:]")).alias("keyed")), lambda x: found(x["words"], x["keyed"]))


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, nth and a candidate's columns, one row each."""
    d = docs.select("doc_id", candidates(F.col("text")).alias("c"))
    return d.select("doc_id", F.posexplode("c").alias("nth", "c")).select("doc_id", "nth", "c.*")


def by_format(found: DataFrame) -> DataFrame:
    """The findings that a strict format proves (label 1) or a counter-sign disproves (label 0)."""
    c = F.col("text")
    kind = (F.when(F.regexp_like(c, F.lit(f"^({FORMATS})$")), "1 format")
            .when((F.col("keyword") == 1) & (F.col("assigned") == 1) & (F.col("hex") == 1) & (F.col("length") >= 16), "1 hex value")
            .when(F.regexp_like(c, F.lit("^[0-9+\\-/_]+$")), "0 number").when(F.col("address") == 1, "0 address")
            .when((F.col("dictionary") > 0.4) & (F.col("keyword") == 0), "0 words"))
    return found.withColumn("kind", kind).filter("kind is not null").withColumn("label", F.left("kind", F.lit(1)).cast("int"))


#: example lines of either kind over the hex digest ``h`` and letters and digits ``b``, letters ``m``, small letters ``l`` and digits ``d`` of a number
_EXAMPLES = {
    1: ("concat('set token = \"', left(h, 40), '\" here')", "concat('with password=', left(h, 18), ' for')", "concat('use AKIA', upper(left(b, 16)), ' to')",
        "concat('is gh', 'p_', left(b, 36), ' now')", "concat('api_key: ', left(b, 24))", "concat('client secret ', substr(b, 5, 20), ' kept')",
        "concat('with password=', substr(l, 3, 12), ' for')", "concat('secret: ', left(l, 4), '@', substr(l, 7, 5), '!', left(d, 2))", "concat('pwd=', left(b, 6), ' now')",
        "concat('use AKIA', upper(left(l, 16)), ' to')", "concat('x ', left(m, 30), ' y')"),
    0: ("concat('card ', left(d, 16), ' paid')", "concat('call ', left(d, 4), '-', substr(d, 5, 7), ' soon')", "concat('at http://host', left(d, 2), '.example.com/part/', left(d, 6))",
        "concat('file report_', left(d, 4), '_version', substr(d, 5, 2), '.pdf in')", "concat('commit ', left(h, 40), ' merged')",
        "concat('row ', left(h, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))",
        "concat('user', left(d, 5), 'name of')", "concat('call getItem', initcap(left(l, 5)), 'ListOfUser() in')", "concat('token: ', elt(1 + id % 6, 'true', 'none', 'null', 'required', 'string', 'default'))"),
}


def examples(spark, n: int = KIND_WEIGHT, first: int = 0) -> DataFrame:
    """Labelled findings of common kinds, so that a kind that a corpus lacks isn't unknown; ``n`` lines of each, of the numbers from ``first`` on."""
    d = spark.range(first, first + n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).select(
        "id", "h", F.regexp_replace(F.base64(F.unhex("h")), "[^A-Za-z]", "").alias("m"), F.lower(F.regexp_replace(F.base64(F.unhex("h")), "[^A-Za-z]", "")).alias("l"), F.regexp_replace(F.base64(F.unhex("h")), "[^A-Za-z0-9]", "").alias("b"), F.regexp_replace("h", "[a-f]", "").alias("d"))
    texts = d.select(F.explode(F.array(*[F.struct(F.expr(e).alias("text"), F.lit(f"{q} example {k}").alias("doc_id")) for q, es in _EXAMPLES.items() for k, e in enumerate(es)])).alias("x")).select("x.*")
    return findings(texts).withColumn("kind", F.col("doc_id")).withColumn("label", F.left("kind", F.lit(1)).cast("int"))


class Forest:
    """Trees as nested (feature, threshold, left, right) or a class; none: a fixed vote."""

    def __init__(self, trees: list, vote: float = 0.5) -> None:
        self.trees, self.vote = trees, vote

    def score(self, c: Column) -> Column:
        """Part of the trees that vote for a secret, over a candidate struct."""
        if not self.trees:
            return F.lit(self.vote)

        def node(t) -> Column:
            if not isinstance(t, tuple):
                return F.lit(t)
            f, at, left, right = t
            return F.when(c[FEATURES[f]] <= at, node(left)).otherwise(node(right))

        total = F.lit(0)
        for t in self.trees:
            total = total + node(t)
        return total / len(self.trees)


def parse_tree(text: str):
    """A tree from Spark's description of it."""
    lines = iter([x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)])

    def node():
        line = next(lines)
        if line.startswith("Predict"):
            return int(float(line.split(":")[1]))
        f, at = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        left = node()
        next(lines)  # Else
        return int(f), float(at), left, node()

    return node()


def train(labelled: DataFrame, per_class: int = PER_CLASS, always: DataFrame | None = None) -> Forest:
    """A forest from labelled findings: the columns of ``findings``, ``label`` and maybe ``kind``.
    At most ``per_class`` of a class (of a kind, if there are kinds) are used, and all of ``always``."""
    keys = F.xxhash64("text", *FEATURES)

    def distinct(found: DataFrame, fixed: bool = False) -> DataFrame:
        kind = F.col("kind") if "kind" in found.columns else F.lit(None).cast("string")
        return found.filter("label in (0, 1)").select("text", *FEATURES, F.col("label").cast("double").alias("label"), kind.alias("kind"), F.lit(fixed).alias("fixed")).distinct()

    rows = cut(distinct(labelled))
    kinds = rows.select("label", "kind").distinct().collect()  # a few: those of by_format or the caller's
    parts = [rows.filter((F.col("label") == q) & F.col("kind").eqNullSafe(F.lit(k))).orderBy(keys, "text").limit(per_class) for q, k in kinds]
    if always is not None:
        parts.append(distinct(always, True))
    rows = cut(reduce(DataFrame.union, parts)) if parts else rows
    share = F.lit(float(KIND_WEIGHT)) / F.count("*")
    weights = F.broadcast(rows.groupBy("kind").agg(F.when(F.first("fixed"), share).otherwise(F.least(F.lit(1.0), share)).alias("weight")).filter("kind is not null"))
    rows = cut(rows.join(weights, "kind", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0))))
    classes = sorted(r.label for r in rows.select("label").distinct().collect())
    if len(classes) < 2:
        return Forest([], classes[0] if classes else 0.5)
    made = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model: RandomForestClassificationModel = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", weightCol="weight").fit(made)
    return Forest([parse_tree(t.toDebugString) for t in model.trees])


def scored(text: Column, forest: Forest) -> Column:
    """Candidates with ``score``."""
    return F.transform(candidates(text), lambda c: c.withField("score", forest.score(c).cast("double")))


def scan(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row per candidate: place, digest (not the secret itself), vote, verdict."""
    d = docs.select("doc_id", F.posexplode(scored(F.col("text"), forest)).alias("nth", "c"))
    return d.select("doc_id", F.col("nth").cast("long").alias("nth"), F.col("c.word").cast("long").alias("word_at"), F.col("c.length").cast("long").alias("length"),
                    F.sha2(F.col("c.text"), 256).alias("sha256"), F.col("c.score").alias("score"), (F.col("c.score") >= 0.5).alias("is_secret"))


def redact(docs: DataFrame, forest: Forest) -> DataFrame:
    """docs with every secret in the text replaced by ``MASK``; all columns and rows stay."""
    secrets = F.transform(F.filter(scored(F.col("text"), forest), lambda c: c["score"] >= 0.5), lambda c: c["text"])
    # longest first, so that a secret inside another can't leave a rest
    order = F.reverse(F.array_sort(F.transform(F.array_distinct(secrets), lambda s: F.struct(F.char_length(s).alias("n"), s.alias("s")))))
    # a short one only where it isn't part of a longer word
    alone = lambda s: F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), F.replace(s, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])"))
    clean = F.aggregate(order, F.col("text").cast("string"), lambda t, s: F.when(s["n"] >= 8, F.replace(t, s["s"], F.lit(MASK))).otherwise(
        F.regexp_replace(t, alone(s["s"]), F.lit(MASK))))
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), clean))


def forest_of(docs: DataFrame, per_class: int = PER_CLASS) -> Forest:
    """Trained on the documents' own findings that a format decides, and on the examples."""
    return train(by_format(findings(docs)), per_class, always=examples(docs.sparkSession))


def op4(spark, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, forest_of(docs))

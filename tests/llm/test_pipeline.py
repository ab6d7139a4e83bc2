"""The pipeline stage by stage against the plain versions, and as a whole."""

import re

from tokenizers import Tokenizer

import corpus_pipeline
from abflow.llm import compress_quality as Q
from abflow.llm.common import read_table
from abflow.llm.tokens import public_path

from .brute import decontam, ngram_join
from .test_secret_scan import PLANTED
from .test_tokens import WORD, check_pieces

SF = "/root/testdata/sf0.001"


def test_run_is_the_stages_in_order(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    frame = read_table(spark, SF, "documents").select("doc_id", "text")
    good = {r.doc_id for r in Q.score(frame, Q.fit(frame, read_table(spark, SF, "labels"))).collect() if r.score >= 0.7}
    left = {d: t for d, t in docs.items() if d in good}
    left = {d: left[d] for d, (_, c) in ngram_join(left.items()).items() if d == c}
    bench = [tuple(r) for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    left = {d: left[d] for d, x in decontam(left.items(), bench).items() if not x[-1]}
    assert 0 < len(left) < len(good) < len(docs)
    masked = [(d, PLANTED.sub("[SECRET]", t)) for d, t in left.items()]
    rows = corpus_pipeline.run(spark, SF).collect()
    used, bound = check_pieces(rows, masked, Tokenizer.from_file(public_path(WORD)), 2048)
    assert used <= bound + 1


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    names = read_table(spark, SF, "documents").columns
    t = " ".join(f"w{i}" for i in range(60))
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, None, "en", "s", 0), (10**6 + 1, "", None, "s", 0), (10**6 + 2, t, "en", None, 9),
                                 (10**6 + 3, t, "en", "s", None), (10**6 + 2, t, "en", None, 9), (10**6 + 4, t + " " + "x" * 200000, "de", "s", 1)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == names and out.dtypes == odd.dtypes
            rows = out.collect()
            assert docs is odd or rows == []
            if docs is odd and k == 1:
                ids = [r.doc_id for r in rows]
                assert sorted(x for x in ids if x) == [10**6, 10**6 + 1, 10**6 + 2, 10**6 + 4] or 10**6 + 4 not in ids
                assert None in ids and ids.count(10**6 + 2) == 1 and 10**6 + 3 not in ids


def test_no_text_and_no_column_is_lost(spark):
    """Repeated ids with different texts, and a column that has the score's name."""
    from pyspark.sql import functions as F

    from abflow.llm import stages
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, a), (2, a + " z"), (3, c), (None, c), (4, b + " z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    left = sorted((r.doc_id or 0, r.text) for r in stages.one_of_each_group(spark, docs, SF).collect())
    assert left == sorted([(1, a), (1, b), (3, c), (0, c)])
    given = read_table(spark, SF, "documents").withColumn("_quality_score", F.lit("mine"))
    out = stages.good_quality(spark, given, SF)
    assert out.columns == given.columns and {r[0] for r in out.select("_quality_score").distinct().collect()} == {"mine"}


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None and re.match("Corpus pipeline", corpus_pipeline.__doc__)

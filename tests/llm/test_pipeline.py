"""The pipeline's stages on a small corpus, each held to what it should do, and the entry module's guard."""

import os
import subprocess
import sys

import numpy as np
import pytest

from factloom.llm import toxicity

pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    syllables = [a + b for a in "bcdfghklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(2, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    shared_line = text(60)
    for i in range(420):
        body = text(int(rng.integers(30, 90)))
        toxic = i % 7 == 0
        if toxic:
            body = "zorgwitz " + body + " quaxxel vlimprox"
        if i % 10 == 3:
            body = body + "\n" + shared_line
        rows.append((i, body, "en", "s0" if i % 3 else "s1", len(body)))
        labels.append((i, int(i % 2), int(toxic)))
    copied = [r for r in rows if r[0] % 7 and r[0] % 10 != 3][:6]
    rows += [(1000 + i, r[1].replace(" ", "  ", 1), *r[2:]) for i, r in enumerate(copied)]
    rows += [(2000, None, "en", "s0", None), (2001, "", "en", "s0", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {r[0]: r for r in rows}, shared_line, [r[0] for r in copied]


def test_stages_one_after_another(spark, corpus):
    folder, rows, shared_line, copied = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = {}
    for at, (name, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, folder)
        if at < 4:
            assert docs.columns == COLUMNS, name
            path = f"{folder}/stage-{at}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        held[name] = docs.collect()
    kept = {r.doc_id for r in held["toxicity"]}
    toxic = {i for i in range(420) if i % 7 == 0}
    assert len(kept & toxic) <= 3 and len(set(rows) - toxic - kept) <= 3
    with_line = [r for r in held["line dedup"] if r.text and shared_line in r.text]
    assert len(with_line) == 1 and {r.doc_id for r in held["line dedup"]} == kept
    assert all(r.n_chars == len(r.text) for r in held["line dedup"] if r.text is not None)
    singles = {r.doc_id for r in held["n-gram Jaccard join"]}
    assert kept - singles == {1000 + k for k in range(6)} & kept
    mixed = {r.doc_id for r in held["mixing sources to target weights"]}
    assert mixed == singles
    encoded = held["SentencePiece encoding and decoding"]
    assert all(r.decoded_ok for r in encoded) and {r.doc_id for r in encoded} == singles


def test_run_is_the_stages(spark, corpus):
    folder = corpus[0]
    found = pipeline.run(spark, folder)
    assert found.columns[:3] == ["doc_id", "sample", "n_pieces"] and found.count() > 400
    assert pipeline.ORACLE_SQL is None and [n for n, _ in pipeline.STAGES][0] == "toxicity"


def test_scores_do_not_read_labels_language_or_source(spark, corpus):
    folder, rows, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 50")
    table, bias = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    one = {r.doc_id: r.score for r in toxicity.score(docs, table, bias).collect()}
    from pyspark.sql import functions as F

    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "doc_id": F.col("doc_id") + 7000})
    assert {r.doc_id - 7000: r.score for r in toxicity.score(other, table, bias).collect()} == one


def test_entry_works_without_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = "import sys; sys.modules['factloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=os.environ | {"PYTHONPATH": root})

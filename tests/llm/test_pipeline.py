"""The corpus pipeline against plain Python, stage by stage."""

from __future__ import annotations

import ast
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.test_dedup_and_lines import normalised
from tests.llm.test_ngram_jaccard import brute_force
from tests.llm.test_texts import check_pieces

from potsherd.llm import decontamination, packing, quality
from potsherd.llm.common import Scratch, table


def test_each_stage(spark):
    sf = "/root/testdata/sf0.01"
    docs, scratch = table(spark, sf, "documents"), Scratch(spark)
    before = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.keep(stage(spark, docs, sf))
        assert out.columns == docs.columns
        kept = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_classifier":
            model = quality.learn(table(spark, sf, "documents"), table(spark, sf, "labels"))
            expected = {i for i, t in before.items() if model.score(quality.terms([t]))[0] >= quality.GOOD}
        elif name == "exact_dedup":
            groups = defaultdict(list)
            for i, t in before.items():
                groups[normalised(t)].append(i)
            expected = {min(g) for g in groups.values()}
        elif name == "ngram_jaccard_join":
            expected = {c for c, _, _ in brute_force(list(before.items())).values()}
        else:
            held = {r.doc_id for r in decontamination.find(docs, table(spark, sf, "benchmark")).collect()}
            expected = set(before) - held
            assert held
        assert set(kept) == expected and all(before[i] == t for i, t in kept.items())
        docs, before = out, kept
    pieces = packing.pack(docs, corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).collect()
    assert check_pieces(list(before.items()), pieces) < 0.02
    rows = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.start, r.length) for r in rows.collect()) == sorted((p.doc_id, p.start, p.length) for p in pieces)


def test_no_rows(spark, tmp_path, small_dir):
    for name in ("documents", "labels", "benchmark"):
        table(spark, small_dir, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, tmp_path, small_dir):
    """Nulls in any column, empty and very long texts, repeated rows and clashing columns, against the run without them."""
    docs, labels = table(spark, small_dir, "documents"), table(spark, small_dir, "labels")
    plain = {r.doc_id for r in corpus_pipeline.run(spark, small_dir).select("doc_id").collect()}
    model = quality.learn(docs, labels)
    good = lambda t: model.score(quality.terms([t]))[0] >= quality.GOOD
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in plain]
    turned = lambda t: " ".join(t.split()[::-1])
    a, long = next((i, t) for i, t in ((i, f"{t}\n" * (400_000 // len(t))) for i, t in texts) if good(t))
    b, c, d = [x for x in texts if x[0] != a and good(turned(x[1]))][:3]
    odd = [(-5, long), (None, b[1]), c, c, (None, turned(d[1])), (900_001, None), (900_002, ""), (900_003, " \n"), (None, None), (None, None)]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    every = docs.unionByName(more, allowMissingColumns=True)
    names = ("TEXT_KEY", "digest", "class_id", "score", "held_out", "node", "found_id", "loser_id", "a.b")
    for n in names:
        every = every.withColumn(n, F.lit(None).cast("string"))
    every.write.parquet(f"{tmp_path}/documents.parquet")
    labels.unionByName(spark.createDataFrame([(None, 1, None), (c[0], None, None), (None, None, None)], "doc_id long, quality int, toxic int")).write.parquet(f"{tmp_path}/labels.parquet")
    items = table(spark, small_dir, "benchmark")
    items.unionByName(spark.createDataFrame([(None, None), (77_777, None), (77_778, ""), (None, "")], items.schema)).write.parquet(f"{tmp_path}/benchmark.parquet")

    held, scratch = table(spark, str(tmp_path), "documents"), Scratch(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.keep(stage(spark, held, str(tmp_path)))
        assert out.columns == every.columns
        held = out
    expected = (plain - {a}) | {-5, None}
    rows = [(r.doc_id, r.text) for r in held.select("doc_id", "text").collect()]
    assert len(rows) == len(expected) and {i for i, _ in rows} == expected
    assert dict(rows)[-5] == long and dict(rows)[None] == turned(d[1])
    found = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens")).collect()
    assert {r.doc_id for r in found} == expected and all(r.n == r.tokens for r in found)


def test_import_errors_show():
    """Only the entry module guards its imports."""
    tree = ast.parse(open(corpus_pipeline.__file__).read())
    assert not any(isinstance(n, ast.Try) for n in ast.walk(tree))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_terms_of_few_texts(n):
    assert quality.terms(["woord"] * n).shape == (n, quality.PLACES) if n else np.ndim(quality.terms([""])) == 2

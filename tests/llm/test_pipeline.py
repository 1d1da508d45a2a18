from __future__ import annotations

import corpus_pipeline
from linewarden.llm import toxicity
from linewarden.session import materialize
from tests.llm import test_decontamination as benchmark_test
from tests.llm.test_encoding import check_packing
from tests.llm.test_exact_dedup import normal
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_against_brute_force(spark, sf_dir):
    """Each stage is judged on what the stage before it kept."""
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] or "" for r in docs.collect()} if name != "packing" else {}
        docs = materialize(stage(spark, docs, sf_dir), f"test_{name}")
        if name == "packing":
            break
        assert docs.columns == columns
        kept[name] = {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            scored = toxicity.score_documents(
                corpus_pipeline.table(spark, sf_dir, "documents"),
                toxicity.train(
                    corpus_pipeline.table(spark, sf_dir, "documents"),
                    corpus_pipeline.table(spark, sf_dir, "labels"),
                ),
            )
            expected = {r["doc_id"] for r in scored.collect() if not r["predicted"]}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(normal(before[i]), i)
            expected = set(first.values())
        elif name == "near_dedup":
            prints = [(i, plain_fingerprint(t)) for i, t in sorted(before.items())]
            expected = set(plain_components(prints).values())
        else:
            items = corpus_pipeline.table(spark, sf_dir, "benchmark")
            rows = [tuple(r) for r in items.select("item_id", "text").collect()]
            found = benchmark_test.brute(list(before.items()), rows, 10)
            expected = {r[0] for r in found if not r[5]}
        assert kept[name] == expected
    parts, _ = check_packing(docs.collect(), 4096)
    assert set(parts) == kept["decontamination"]


def test_stages_keep_odd_rows(odd, spark, sf_dir):
    """Clean documents come through, with all columns, and so does an empty table."""
    for docs in (odd, odd.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = materialize(stage(spark, docs, sf_dir), f"odd_{name}")
            assert out.columns == odd.columns
            docs = out
        assert corpus_pipeline.packing_stage(spark, docs, sf_dir).count() >= docs.count()

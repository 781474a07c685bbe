"""The pipeline, stage by stage, against brute force over what the stage before kept."""

import sys
from pathlib import Path

import corpus_pipeline
import __spark_entry__ as entry_module
from adstrata.llm import toxicity
from adstrata.llm.common import stored, table
from adstrata.llm.queries import MIX_LEVELS, MIX_SHARE, with_domain

sys.path.insert(0, str(Path(__file__).parent))

import test_jaccard  # noqa: E402
import test_llm_operators  # noqa: E402


def test_stages(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    benchmark = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        rows = docs.collect()
        seen[name] = len(rows)
        if name != "mixing":
            assert docs.columns == documents.columns
        kept = {r["doc_id"]: r for r in rows}
        if name == "toxicity":
            model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
            lexicon = model.lexicon()
            assert set(kept) == {i for i, r in before.items() if model.score(toxicity.features(lexicon, r["text"])) < 0.5}
        elif name == "line_dedup":
            expected = test_llm_operators.brute_dedup([(i, r["text"]) for i, r in before.items()])
            assert {i: r["text"] for i, r in kept.items()} == {
                i: t for i, t, n, gone in expected if not gone or gone < n
            }
        elif name == "near_duplicates":
            expected = test_jaccard.brute([(i, r["text"]) for i, r in before.items()])
            assert set(kept) == {i for i, _, component, _ in expected if i == component}
        elif name == "decontamination":
            assert set(kept) == {i for i, r in before.items() if not test_llm_operators.brute_hits(r["text"], benchmark)[1]}
        else:
            size = lambda t: len((t or "").split())
            total = sum(size(r["text"]) for r in before.values())
            assert sum(size(r["text"]) for r in rows) <= total * MIX_SHARE
            assert set(kept) <= set(before) and all(before[i]["text"] == r["text"] for i, r in kept.items())
            copies = {}
            for r in rows:
                copies.setdefault((r["doc_id"], r["epoch"]), []).append(r)
            assert all(len(c) == 1 for c in copies.values())
            assert docs.columns == [*with_domain(documents).columns, "epoch"] and set(MIX_LEVELS) <= set(docs.columns)
    assert all(seen.values()) and seen["mixing"] < documents.count()


def test_run_is_the_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"
    ]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry_module.oracle_sql()
    assert entry_module.queries()["pipeline"] is corpus_pipeline.run


def test_every_operator_is_registered():
    names = entry_module.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls, repeated rows and columns of other names, stage by stage; then nothing at all."""
    line = "some words that make a line of their own and are long enough " * 5
    rows = [
        (1, line, "en", "a", 5, 1), (1, line, "en", "a", 5, 1), (2, f"before\n{line}", "en", "a", 5, 2), (3, None, None, None, None, 3),
        (3, None, None, None, None, 3), (None, "a text without an id", "de", "b", 20, 4), (4, "", "fr", "b", 0, 5), (5, "other words", "en", "a", 11, 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, n_lines int")
    docs = docs.withColumn("n_removed", docs["n_lines"])
    expected = {
        "toxicity": [1, 1, 2, 3, 3, None, 4, 5], "line_dedup": [1, 1, 2, 3, 3, None, 4, 5],
        "near_duplicates": [1, 1, 2, 3, 3, None, 4, 5], "decontamination": [1, 1, 2, 3, 3, None, 4, 5],
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"odd-{name}")
        assert sorted((r["doc_id"] for r in docs.collect()), key=str) == sorted(expected[name], key=str), name
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_removed"]
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert texts[2]["text"] == "before" and texts[2]["n_chars"] == 6 and texts[2]["n_lines"] == 2 and texts[3]["text"] is None
    mixed = corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()
    assert all(texts[r["doc_id"]]["text"] == r["text"] for r in mixed)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name

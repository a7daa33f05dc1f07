"""The corpus pipeline against its operators, stage by stage."""

import corpus_pipeline
from test_text_operators import base_pii, brute_contamination, brute_groups

from tagloom.llm import packing, pii, tokens, toxicity


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, labels = docs.columns, spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)

    calm = stages["toxicity"](spark, docs, sf_dir)
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    rows = {r.doc_id: r for r in calm.collect()}
    assert calm.columns == columns and toxic and set(rows) == {r.doc_id for r in docs.collect()} - toxic

    alone = stages["near duplicates"](spark, calm, sf_dir)
    expected = {d for d, g in brute_groups([(r.doc_id, r.text) for r in rows.values()]).items() if g[2]}
    rows = {r.doc_id: r for r in alone.collect()}
    assert alone.columns == columns and set(rows) == expected

    clean = stages["decontamination"](spark, alone, sf_dir)
    expected = {d for d, r in rows.items() if not brute_contamination(r.text, benchmark)[-1]}
    rows = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == columns and set(rows) == expected

    safe = stages["personal data"](spark, clean, sf_dir)
    assert safe.columns == columns
    texts = {r.doc_id: r for r in safe.collect()}
    assert set(texts) == set(rows)
    for doc_id, r in texts.items():
        assert not base_pii(r.text) and r.n_chars == len(r.text)
        assert bool(base_pii(rows[doc_id].text)) <= ("[" in r.text)
    assert pii.redacted("a 1.2.3.4 b", [(2, 1, 9)]) == "a [IP] b"

    pieces = stages["packing"](spark, safe, sf_dir).collect()
    encode = tokens.token_ids("byte_bpe_50k.json")
    assert sum(p.length for p in pieces) == sum(len(encode(r.text)) // 4 + 1 for r in texts.values())
    assert {p.tier for p in pieces} >= {packing.TIERS[-1]}


def test_run_is_the_stages(spark, sf_dir):
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and whole.count() > 0


def test_stages_on_odd_rows(spark, sf_dir):
    """Null ids and texts, empty and very long texts, repeated rows, working names as columns, and no rows at all."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "_gone", "_digest", "key", "node", "tree", "chunk", "root"]
    text = "the quick brown fox jumps over the lazy dog near the old river bank"
    rows = [(1, text), (2, text + " mail me@example.org"), (2, text + " mail me@example.org"), (3, None), (4, ""), (5, "word " * 40_000), (None, text), (None, None), (6, " \n ")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names[5:])
    docs = spark.createDataFrame([(i, t, None, "s", len(t or ""), *"abcdefg") for i, t in rows], schema)
    stages = dict(corpus_pipeline.STAGES)
    left = {"toxicity": [1, 2, 2, 3, 4, 5, 6, None, None], "near duplicates": [1, 3, 4, 5, 6, None, None], "decontamination": [1, 2, 2, 3, 4, 5, 6, None, None],
            "personal data": [1, 2, 2, 3, 4, 5, 6, None, None]}
    for name, expected in left.items():
        kept = stages[name](spark, docs, sf_dir)
        found = kept.collect()
        assert kept.columns == names and sorted((r.doc_id for r in found), key=lambda i: (i is None, i)) == expected, name
        assert {tuple(r)[5:] for r in found} == {tuple("abcdefg")}
        assert stages[name](spark, docs.limit(0), sf_dir).count() == 0
    hidden = {r.text for r in stages["personal data"](spark, docs, sf_dir).where("doc_id = 2").collect()}
    assert hidden == {text + " mail [EMAIL]"}
    pieces = stages["packing"](spark, docs, sf_dir)
    assert pieces.where("start = 0").count() == len(rows) and stages["packing"](spark, docs.limit(0), sf_dir).count() == 0

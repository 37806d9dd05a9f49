"""The pipeline's stages, each judged on its own input."""

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_TINY
from tests.llm.test_documents import base_spans, contaminated, shingles


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage, over a table with planted cases."""
    folder = tmp_path_factory.mktemp("corpus")
    documents = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_TINY}/benchmark.parquet")
    passage = benchmark.first()["text"]
    long_text = " ".join(f"thing{i} and the other" for i in range(60))
    planted = [
        (10_001, None, None),
        (10_002, "12345 !!! 67890", None),
        (10_003, long_text, "en"),
        (10_004, long_text, "en"),
        (10_005, long_text + " again", "en"),
        (10_006, f"the thing and then {passage} and that", "en"),
        (10_007, "the and that with mail a.b@example.org the of", "en"),
    ]
    rows = spark.createDataFrame([(*p, "planted", len(p[1] or "")) for p in planted], documents.schema.simpleString()[7:-1].replace(":", " "))
    documents.union(rows.select(documents.columns)).write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    found, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, str(folder)), name)
        found[name] = (docs, after)
        docs = after
    found["items"] = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    found["result"] = corpus_pipeline.run(spark, str(folder))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns and after.count() > 0


def test_language_stage_drops_only_what_has_none(stages):
    before, after = (texts(x) for x in stages["language_id"])
    assert before.keys() - after.keys() == {10_001, 10_002}
    assert all(before[k] == t for k, t in after.items())


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = (texts(x) for x in stages["near_dedup"])
    assert {10_003} == {10_003, 10_004, 10_005} & after.keys()
    sets = {k: shingles(t) for k, t in before.items()}

    def similar(a, b):
        both = len(sets[a] & sets[b])
        return before[a] == before[b] or both and both >= 0.8 * len(sets[a] | sets[b])

    assert not [(a, b) for a in after for b in after if a < b and similar(a, b)]
    assert all(any(similar(gone, other) for other in before if other != gone) for gone in before.keys() - after.keys())


def test_decontamination_stage_leaves_no_window(stages):
    before, after = (texts(x) for x in stages["decontamination"])
    assert before.keys() == after.keys()
    hit = {r[0] for r in contaminated(list(before.items()), stages["items"]) if r[2]}
    assert 10_006 in hit
    assert {k for k in before if before[k] != after[k]} == hit


def test_personal_data_stage_leaves_no_span(stages):
    before, after = (texts(x) for x in stages["pii"])
    assert before.keys() == after.keys()
    assert after[10_007] == "the and that with mail [EMAIL] the of"
    assert not any(base_spans(t) for t in after.values())
    changed = {k for k in before if before[k] != after[k]}
    assert all(base_spans(before[k]) or re.search("token|secret|key", before[k], re.I) for k in changed)


def test_last_stage_encodes_every_text(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known = texts(before)
    rows = {r["doc_id"]: r for r in after.collect()}
    assert rows.keys() == known.keys()
    for k, text in known.items():
        assert np.frombuffer(rows[k]["ids"], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_run_applies_all_stages(stages):
    assert sorted(map(str, stages["result"].collect())) == sorted(map(str, stages["bpe"][1].collect()))

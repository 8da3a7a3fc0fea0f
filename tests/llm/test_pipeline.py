"""Each stage of the corpus pipeline on documents of every kind, and all of them together."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES
from urbanflux.llm import bpe

WORDS = "the committee met again to hear how long work on a new bridge would take and what it may cost our town".split()


def prose(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + (f"{rnd.randrange(90)}x" if rnd.random() < 0.3 else "") for _ in range(n))


def corpus():
    rows = [(i, prose(i), "en", f"s{i % 3}") for i in range(24)]
    rows += [(100 + i, prose(i) + " end", "en", "s0") for i in range(4)]  # near copies
    rows += [(200, prose(0), "en", "s1"), (0, prose(0), "en", "s0")]  # exact copies, a repeated row
    rows += [(300, prose(77) + " call +1 (729) 555-7725 or jo@mail.example.com", "en", "s2")]
    rows += [(400, "too short", "en", "s0"), (401, "", "en", None), (402, None, None, None), (None, prose(88), None, None)]
    rows += [(500, prose(99, 1_500), "en", "s1")]
    return rows


@pytest.fixture
def written(spark, documents, folder):
    documents(*corpus()).withColumn("kept", F.lit("clash")).withColumn("spans", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def stage(name):
    return dict(STAGES)[name]


def test_whole_pipeline_like_its_definition(spark, written, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    ids = [r["doc_id"] for r in found]
    assert set(ids) <= {*range(24), 300, 500, None}
    assert max(map(ids.count, ids)) <= 3
    library = Tokenizer.from_file(bpe.vocabulary_path(bpe.VOCABULARY))
    for r in found:
        assert r["ids"] == library.encode(r["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"]) and r["n_chars"] == len(r["text"])
        assert "555-7725" not in r["text"] and "@" not in r["text"]
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_rejected_documents_go_and_clean_ones_stay(spark, written, folder):
    kept = {r["doc_id"] for r in stage("quality_rules")(spark, written, folder).collect()}
    assert kept == {r[0] for r in corpus()} - {400, 401, 402}


def test_one_document_of_each_group_stays(spark, written, folder):
    kept = sorted(str(r["doc_id"]) for r in stage("minhash_near_dedup")(spark, written, folder).collect())
    assert kept == sorted(map(str, [*range(24), 300, 400, 401, 402, None, 500]))


def test_personal_data_is_replaced(spark, written, folder):
    rows = {r["doc_id"]: r for r in stage("pii")(spark, written, folder).collect()}
    assert rows[300]["text"].endswith("call [PHONE] or [EMAIL]")
    assert rows[300]["n_chars"] == len(rows[300]["text"])
    assert rows[402]["text"] is None and rows[5]["text"] == prose(5)
    assert len(rows) == len({r[0] for r in corpus()})


def test_mix_repeats_and_drops_by_weight(spark, written, folder):
    rows = stage("mix_sources")(spark, written, folder).collect()
    ids = [r["doc_id"] for r in rows]
    assert {401, 402}.isdisjoint(ids) and max(map(ids.count, ids)) <= 6  # document 0 stands there twice
    assert set(rows[0].asDict()) == set(COLUMNS)


@pytest.mark.parametrize("name", [n for n, _ in STAGES])
def test_stages_take_an_empty_table(spark, written, folder, name):
    out = stage(name)(spark, written.limit(0), folder)
    assert out.collect() == []
    if name != STAGES[-1][0]:
        assert out.columns == COLUMNS


def test_last_stage_decodes_what_it_encodes(spark, written, folder):
    library = Tokenizer.from_file(bpe.vocabulary_path(bpe.VOCABULARY))
    rows = stage("bpe")(spark, written, folder).collect()
    assert len(rows) == len(corpus())
    for r in rows:
        assert r["decoded"] == " ".join(map(library.id_to_token, r["ids"]))
    assert any(r["decoded"] for r in rows) and {r["decoded"] for r in rows if not r["text"]} == {""}

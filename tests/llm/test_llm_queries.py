"""The registered queries over whole small tables, and the pipeline stage by stage."""

import hashlib

import brute
import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from sievemark.llm import queries
from sievemark.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_every_operator_is_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_mix_equals_its_sql(spark):
    got = queries.op8_weighted_mix(spark, SF).toPandas()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = connection.execute(contract.oracle_sql()["op8_weighted_mix"]).df()[list(got.columns)]
    a, b = (x.sort_values("doc_id").reset_index(drop=True) for x in (got, expected))
    assert (a.round(6) == b.round(6)).all().all()


def test_components_and_counts_and_spans(spark, docs):
    texts = {i: d.text for i, d in docs.items()}
    expected = brute.components(list(texts.items()))
    rows = queries.op6_lsh_forest(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    for r in queries.op7_disclosure(spark, SF).collect():
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute.pii_row(texts[r.doc_id])
        assert r.spans.startswith(",".join(brute.pii(texts[r.doc_id])))
    for r in queries.op9_decision_list(spark, SF).collect():
        n, chars, symbols, dups, repeats = brute.quality_row(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.base_failed and r.kept)


def test_pipeline_stages_take_effect(spark, docs):
    done = {}
    stage_docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = stage_docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, stage_docs, SF)
        done[name] = out.collect()
        if name != "encoding":
            assert out.columns == columns
            stage_docs = spark.createDataFrame(done[name], out.schema)
    lettered = {i for i, d in docs.items() if any(c.isalpha() for c in d.text or "")}
    assert {r.doc_id for r in done["language"]} == lettered
    groups = brute.components([(i, docs[i].text) for i in lettered], corpus_pipeline.NEAR_PERCENT, corpus_pipeline.NEAR_WIDTH)
    assert (corpus_pipeline.NEAR_WIDTH, corpus_pipeline.NEAR_PERCENT) == (5, 80)
    assert {r.doc_id for r in done["near_duplicates"]} == {i for i, (_, c) in groups.items() if c == i}
    for r in done["personal_data"]:
        assert not brute.pii(r.text) and r.n_chars == len(r.text)
        assert brute.pii(docs[r.doc_id].text) or r.text == docs[r.doc_id].text
    before = {r.doc_id: r for r in done["personal_data"]}
    words = lambda t: len(brute.WORD.findall(t))
    assert sum(words(r.text) for r in done["mixing"]) == pytest.approx(sum(words(r.text) for r in before.values()), abs=30)
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    mixed = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest(), len(library.encode(r.text).ids)) for r in done["mixing"])
    assert sorted((r.doc_id, r.decoded_sha256, r.n_tokens) for r in done["encoding"]) == mixed

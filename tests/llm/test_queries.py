"""Registered queries over whole tables."""

from collections import Counter

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
import brute
from tillroll.llm.packing import N_BUCKETS, TOKEN_BUDGET
from tillroll.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(name, spark, duck):
    ours, theirs = QUERIES[name](spark, SF_DIR), duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    ours = ours.select(*theirs.columns)
    assert Counter(map(tuple, ours.collect())) == Counter(theirs.fetchall())


@pytest.mark.parametrize(
    "name, columns, plain",
    [
        ("op1_suffix_array_dedup", "doc_id n_bytes n_removed n_spans kept_sha256", brute.byte_repeats),
        ("op2_substring_dedup", "doc_id n_words n_removed kept_sha256", brute.word_repeats),
        ("op6_ngram_jaccard_join", "doc_id n_shingles component_id", brute.jaccard),
    ],
)
def test_query_equals_plain_version(name, columns, plain, spark, rows):
    found = QUERIES[name](spark, SF_DIR).select(columns.split()).collect()
    assert Counter(map(tuple, found)) == Counter(plain(rows))


def test_packing_equals_plain_version(spark, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = [(i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    columns = ("doc_id", "n_tokens", "bucket_len", "batch_id", "slot")
    found = QUERIES["op7_packing"](spark, SF_DIR).select(*columns).collect()
    bounds = sorted({r["bucket_len"] for r in found} - {0})
    assert len(bounds) <= N_BUCKETS
    assert Counter(map(tuple, found)) == Counter(brute.packing(lengths, bounds, TOKEN_BUDGET))
    assert sum(r["bucket_len"] for r in found) == brute.least_padded([n for _, n in lengths], N_BUCKETS)
    counts = QUERIES["op8_token_counts"](spark, SF_DIR).select("doc_id", "n_tokens").collect()
    assert Counter(map(tuple, counts)) == Counter(lengths)


def test_scores_equal_plain_version(spark, rows):
    found = {r["doc_id"]: r["score"] for r in QUERIES["op9_lm_scoring"](spark, SF_DIR).collect()}
    expected = {i: s for i, _, s in brute.backoff(rows)}
    assert found == pytest.approx(expected, abs=1e-5)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        now = out.count()
        assert 0 < now <= left, name
        docs, left = out, now
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns == [*docs.columns, "n_tokens", "bucket_len", "batch_id", "slot"]
    assert Counter(map(tuple, result.select(docs.columns).collect())) == Counter(map(tuple, docs.collect()))

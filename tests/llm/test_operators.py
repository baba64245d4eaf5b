"""Every operator on awkward rows and on whole small tables, against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tillroll.llm import ngram_scores, repeats, substring_dedup, suffix_dedup
from tillroll.llm.block_naming import distinct_documents, exact_duplicates
from tillroll.llm.common import importable
from tillroll.llm.decontamination import contaminated, without_contaminated
from tillroll.llm.jaccard_join import near_duplicates, one_of_each
from tillroll.llm.ngram_scores import stupid_backoff
from tillroll.llm.packing import best_bounds, pack_documents
from tillroll.llm.queries import QUERIES
from tillroll.llm.secret_scan import EVERY, RULES, secret_report, trigram_query
from tillroll.llm.token_cache import token_counts
from tillroll.llm.toxicity import toxicity, without_toxic

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = "the quick brown fox jumps over the lazy dog while nine grey cats watch from an old red wall "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, low long"
ROWS = [
    (5, PASSAGE + "then leaves"),
    (1, "Some other opening. " + PASSAGE + "and stays"),
    (9, PASSAGE * 40),
    (9, PASSAGE * 40),
    (3, None),
    (None, PASSAGE + "then leaves"),
    (4, ""),
    (6, " \t\n "),
    (7, "word"),
    (8, "WORD"),
    (10, "a" * 300),
    (11, "a" * 170 + "b"),
    (12, "é" * 60 + "  ünïcode \x00 bytes " * 9),
    (13, "é" * 60 + "  ünïcode \x00 bytes " * 9),
    (14, "password=hunter22 AKIA" + "Q" * 20 + " " + "0f" * 16),
    (15, "long " * 60_000 + "end"),
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    rows = [(i, t, None, "hot", None, 1, None) for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(5, 1, 1), (5, 1, None), (None, 0, 1), (1, None, 0)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (4, "word"), (5, "a b c d e f g h i")]
    return spark.createDataFrame(items, "item_id long, text string")


def bag(df):
    return Counter(map(tuple, df.collect()))


def digests(df):
    return Counter((*r[:-1], hashlib.sha256(bytes(r[-1])).hexdigest()) for r in df.collect())


@pytest.mark.parametrize("hot_documents", [repeats.HOT_DOCUMENTS, 2])
def test_byte_repeats_of_awkward_rows(docs, hot_documents):
    found = digests(suffix_dedup.remove_repeats(docs, hot_documents=hot_documents))
    assert found == Counter(brute.byte_repeats(ROWS))


@pytest.mark.parametrize("hot_documents", [repeats.HOT_DOCUMENTS, 2])
def test_word_repeats_of_awkward_rows(docs, hot_documents):
    found = substring_dedup.remove_repeats(docs, hot_documents=hot_documents).drop("n_spans")
    assert digests(found) == Counter(brute.word_repeats(ROWS))


@pytest.mark.parametrize("remove_repeats", [suffix_dedup.remove_repeats, substring_dedup.remove_repeats])
def test_repeated_text_is_stored_once_per_document(spark, monkeypatch, remove_repeats):
    importable(spark)
    text = " ".join(f"{i * 7919 % 1000003:x}" for i in range(2000))
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    stored = []

    def recorded(df, purpose, *args, **options):
        frame, path = repeats_saved_at(df, purpose, *args, **options)
        stored.extend(
            frame.agg(F.sum(F.octet_length(name))).first()[0]
            for name, kind in frame.dtypes
            if kind == "binary"
        )
        return frame, path

    repeats_saved_at = repeats.saved_at
    monkeypatch.setattr(repeats, "saved_at", recorded)
    gone = {r["doc_id"]: r["kept"] for r in remove_repeats(docs).collect()}
    assert gone == {0: text.encode(), 1: b"", 2: b""}
    tokens = 2000 * 8 if remove_repeats is substring_dedup.remove_repeats else len(text)
    assert sum(stored) <= 3 * tokens


@pytest.mark.parametrize("limit", [1, 100, 250, 10_000])
@pytest.mark.parametrize("batch_rows", [1, 3, 50])
def test_shards_end_between_keys(monkeypatch, limit, batch_rows):
    rng, keys = np.random.default_rng(limit), np.sort(np.random.default_rng(1).integers(0, 20, 50))
    rows = [(int(k), bytes(rng.integers(97, 99, rng.integers(50, 90)).tolist()), 1, 2) for k in keys]
    shards = []

    def solver(values, starts, ends, lows):
        shards.append([values[a:b].tobytes() for a, b in zip(starts, ends, strict=True)])
        return np.full(len(values), 0)

    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
    table = pa.table([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "piece", "low", "high"])
    monkeypatch.setattr(repeats, "SHARD_TOKENS", limit)
    unit = repeats.Unit(by_word=False, window=50, gram=20)
    found = list(repeats._solve(solver, unit)(iter(table.to_batches(max_chunksize=batch_rows))))
    assert [p for shard in shards for p in shard] == [r[1] for r in rows]
    assert [k for batch in found for k in batch.column("key").to_pylist()] == keys.tolist()
    expected, n = [[]], 0
    for i, row in enumerate(rows):
        if i and n >= limit and row[0] != rows[i - 1][0]:
            expected, n = [*expected, []], 0
        expected[-1].append(row[1])
        n += len(row[1])
    assert shards == expected


def test_two_counts_share_a_long():
    high, low = np.array([0, 1, 2**31 - 1, 7]), np.array([2**31 - 1, 0, 2**31 - 1, 3])
    both = ngram_scores._paired(high, low)
    assert both.dtype == np.int64
    assert (both >> 32).tolist() == high.tolist() and (both & (2**32 - 1)).tolist() == low.tolist()


@pytest.mark.parametrize("seed", range(6))
def test_maximal_repeats_have_all_occurrences(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2 + seed % 3, 120).astype(np.uint8)
    starts, ends = np.array([0, 30, 70]), np.array([30, 70, 120])
    array = suffix_dedup.suffix_array(values, starts, ends, 3)
    before = np.append(-1, values[:-1].astype(np.int64))
    before[starts] = -1
    groups = suffix_dedup.maximal_repeats(array, before, np.arange(120), 3)
    found = {
        values[array.order[a] : array.order[a] + n].tobytes(): sorted(array.order[a : b + 1].tolist())
        for n, a, b, _ in groups
    }
    pieces = [(s, values[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]
    places = {}
    for s, piece in pieces:
        for i in range(len(piece)):
            for j in range(i + 3, len(piece) + 1):
                places.setdefault(piece[i:j], []).append(int(s + i))
    bounds = {int(e) for e in ends}

    def diverse(chars):
        return len(set(chars)) > 1 or None in chars

    expected = {}
    for text, at in places.items():
        follow = [None if p + len(text) in bounds else int(values[p + len(text)]) for p in at]
        lead = [None if p in starts else int(values[p - 1]) for p in at]
        if len(at) > 1 and diverse(follow) and diverse(lead):
            expected[text] = sorted(at)
    assert found == expected


def test_matching_statistics():
    rng = np.random.default_rng(1)
    text, query = rng.integers(1, 4, 200), rng.integers(1, 5, 80)
    index = substring_dedup.FMIndex(text, np.array([0, 90]), np.array([90, 200]), 5)
    at = np.arange(80 - 6)
    length, low, high = index.matching_statistics(query, at, 6)
    pieces = ["".join(map(str, text[:90])), "".join(map(str, text[90:]))]
    shown = "".join(map(str, query))
    for i in at:
        own = [n for n in range(7) if any(shown[i + 6 - n : i + 6] in p for p in pieces)]
        assert length[i] == max(own)
        if length[i] == 6:
            hits = [m for p in pieces for m in re.findall(f"(?={shown[i:i + 6]})", p)]
            assert high[i] - low[i] == len(hits)


def test_jaccard_of_awkward_rows(docs):
    rows = near_duplicates(docs.filter("doc_id IS NOT NULL")).select(
        "doc_id", "n_shingles", "component_id"
    )
    assert bag(rows) == Counter(brute.jaccard([r for r in ROWS if r[0] is not None]))


def test_exact_duplicates_of_awkward_rows(docs):
    groups = {}
    for doc_id, text in ROWS:
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(normal, []).append(doc_id)
    found = exact_duplicates(docs, block_bytes=64).collect()
    assert len(found) == len(ROWS)
    sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for row in found:
        own = sha[row["text_sha256"]]
        assert row["group_size"] == len(own)
        assert row["keep_id"] == min((x for x in own if x is not None), default=None)
    assert sum(r["kept"] for r in found) == len(groups)
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_one_of_each_component(docs):
    kept = one_of_each(docs)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns
    assert 7 in ids and 8 not in ids and ids.count(9) == 1 and {3, 4, 6} <= set(ids)


def test_contaminated_texts(docs, benchmark):
    found = bag(contaminated(docs, benchmark).select("doc_id", "item_id"))
    holders = [5, 1, 9, 9, None]
    assert found == Counter({**{(d, 1): 2 * holders.count(d) for d in holders}, (7, 4): 1, (8, 4): 1})
    left = [r["doc_id"] for r in without_contaminated(docs, benchmark).collect()]
    assert sorted(left) == [3, 4, 6, 10, 11, 12, 13, 14, 15]


def token_numbers(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_packing_of_awkward_rows(docs):
    rows = pack_documents(docs, WORD_BPE, n_buckets=3, token_budget=64).collect()
    lengths = token_numbers(t for _, t in ROWS)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == Counter(
        (i, n) for (i, _), n in zip(ROWS, lengths, strict=True)
    )
    batches = {}
    for r in rows:
        assert r["n_tokens"] <= r["bucket_len"]
        batches.setdefault(r["batch_id"], []).append(r)
    for own in batches.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert len(own) == 1 or len(own) * own[0]["bucket_len"] <= 64
    assert {r["bucket_len"] for r in rows} <= {0, *lengths}
    assert sum(r["bucket_len"] for r in rows) == brute.least_padded(lengths, 3)


def test_packing_of_whole_rows(spark):
    """Ties, a null id for most rows, and columns that have the names of those added."""
    importable(spark)
    rows = [(None, "a b c", 1, "x", 7, "p")] * 40 + [(i, "d " * i, 2, "y", 8, None) for i in range(9)]
    schema = "doc_id long, text string, slot int, `Bucket_Len` string, row long, `a.b` string"
    docs = spark.createDataFrame(rows, schema).repartition(4)
    out = pack_documents(docs, WORD_BPE, n_buckets=2, token_budget=12, whole_rows=True)
    assert out.columns == ["doc_id", "text", "row", "a.b", "n_tokens", "bucket_len", "batch_id", "slot"]
    found = [tuple(r) for r in out.collect()]
    assert Counter(r[:4] for r in found) == Counter((i, t, n, b) for i, t, _, _, n, b in rows)
    assert len({r[6:] for r in found}) == len(rows)
    bounds = sorted({r[5] for r in found} - {0})
    ids = [(-1 if r[0] is None else r[0], *r[4:]) for r in found]
    assert Counter(ids) == Counter(brute.packing([r[:2] for r in ids], bounds, 12))


def test_best_bounds_have_least_padding():
    from itertools import combinations

    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = sorted(rng.choice(40, 9, replace=False).tolist())
        counts = rng.integers(1, 9, 9).tolist()

        def cost(bounds):
            pairs = zip(lengths, counts, strict=True)
            return sum(n * min(b for b in bounds if b >= x) for x, n in pairs)

        best = min(cost([*c, lengths[-1]]) for c in combinations(lengths[:-1], 2))
        bounds = best_bounds(lengths, counts, 3)
        assert cost(bounds) == best and set(bounds) <= set(lengths)


def test_bounds_of_many_long_lengths():
    rng = np.random.default_rng(4)
    lengths = np.unique(rng.integers(1, 200_000, 700))
    counts = rng.integers(1, 9, len(lengths))
    for n_buckets in (1, 2, 7):
        bounds = np.array(best_bounds(lengths, counts, n_buckets))
        padded = (bounds[np.searchsorted(bounds, lengths)] * counts).sum()
        assert padded == brute.least_padded(np.repeat(lengths, counts).tolist(), n_buckets)


def test_secrets_of_awkward_rows(docs):
    rows = {r["doc_id"]: r for r in secret_report(docs).collect()}
    assert rows[14]["spans"] == "assign:0:17,access:18:42,hex:43:75"
    assert rows[3]["spans"] == "" and sum(r["n_access"] for r in rows.values()) == 1
    assert EVERY in trigram_query(RULES[2].pattern) and EVERY not in trigram_query(RULES[0].pattern)


def test_token_counts_with_a_cache(docs, tmp_path):
    cache = str(tmp_path / "cache")
    texts = [t for _, t in ROWS]
    expected = Counter(
        (i, len((t or "").encode()), n) for (i, t), n in zip(ROWS, token_numbers(texts), strict=True)
    )
    first = bag(token_counts(docs, WORD_BPE, cache))
    assert first == expected == bag(token_counts(docs, WORD_BPE, cache))
    # Both ways of counting in one cache.
    assert bag(token_counts(docs, WORD_BPE, cache, by_word=False)) == expected


def test_token_counts_that_depend_on_white_space(spark, tmp_path):
    from tokenizers import Tokenizer

    importable(spark)
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    texts = ["a b", "a    b", "a b", " a b", "a\n\n b ", "", None, "def f(x):\n    return x\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(path)
    plain = {i: len(tokenizer.encode(t or "").ids) for i, t in enumerate(texts)}
    assert plain[0] != plain[1]
    for _ in range(2):
        found = token_counts(docs, path, cache, by_word=False).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in found} == plain
    packed = pack_documents(docs, path, by_word=False).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in packed} == plain
    for refused in (token_counts, pack_documents):
        with pytest.raises(ValueError, match="white space"):
            refused(docs, path)


def test_scores_of_awkward_rows(docs, spark):
    rows = [r for r in ROWS if r[0] not in (9,)]
    known = docs.filter("doc_id IS NULL OR doc_id <> 9")
    found = {(r["doc_id"]): r for r in stupid_backoff(known, known).collect()}
    for doc_id, n, score in brute.backoff(rows):
        assert found[doc_id]["n_words"] == n
        assert found[doc_id]["score"] == pytest.approx(score, abs=1e-5, rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_scores_of_other_texts(docs, spark, order):
    """Texts the model was not made of, at several orders; more slices change nothing."""
    rows = [(1, PASSAGE), (2, "word word word then leaves"), (3, ""), (4, None), (5, "never seen"), (None, "word")]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    found = stupid_backoff(texts, docs, leave_out=False, order=order, slices=order // 2 + 1).collect()
    expected = {i: (n, s) for i, n, s in brute.backoff(rows, order, train=ROWS)}
    assert len(found) == len(rows)
    for r in found:
        n, score = expected[r["doc_id"]]
        assert r["n_words"] == n
        assert r["score"] == pytest.approx(score, abs=1e-5, rel=1e-9)


def test_toxicity_of_awkward_rows(docs, labels):
    rows = toxicity(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert without_toxic(docs, labels).columns == docs.columns


def test_held_out_toxicity(spark):
    """With the labels of sf0.1; those of sf0.01 have too few toxic rows to learn all terms."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = QUERIES["op3_toxicity"](spark, sf_dir).filter("held_out").join(labels, "doc_id")
    pairs = Counter((r["toxic"], r["predicted"]) for r in scored.collect())
    assert pairs[1, 1] >= 0.9 * (pairs[1, 1] + pairs[1, 0])
    assert pairs[1, 1] >= 0.9 * (pairs[1, 1] + pairs[0, 1])


def test_empty_tables(docs, labels, benchmark):
    none = docs.filter("false")
    for df in (
        suffix_dedup.remove_repeats(none),
        substring_dedup.remove_repeats(none),
        toxicity(none, labels.filter("false")),
        secret_report(none),
        contaminated(none, benchmark),
        contaminated(docs, benchmark.filter("false")),
        near_duplicates(none),
        one_of_each(none),
        pack_documents(none, WORD_BPE),
        pack_documents(none, WORD_BPE, whole_rows=True),
        token_counts(none, WORD_BPE),
        stupid_backoff(none, none),
        exact_duplicates(none),
        distinct_documents(none),
    ):
        assert df.count() == 0


CLASHES = "n string, text string, row int, own_id string, own_key int, kept_id int, k_own string, digest int, kept boolean, doc_id long"


@pytest.mark.parametrize("stage", [distinct_documents, one_of_each])
def test_stages_leave_all_columns_alone(spark, stage):
    def row(i, text):
        return (f"n{i}", text, 1, "x", 2, 3, "y", 4, None, i)

    rows = [row(1, "a b c d"), row(2, "a b c d"), row(None, "other text here"), row(3, None), row(4, "e f g h")]
    docs = spark.createDataFrame(rows, CLASHES)
    out = stage(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in rows if r[9] != 2}
    renamed = stage(docs.withColumnsRenamed({"doc_id": "number", "n": "doc_id"}), id_column="number")
    assert {r["number"] for r in renamed.collect()} == {1, None, 3, 4}
    assert stage(docs.limit(0)).collect() == []

"""Line de-duplication, conversation repair and whitening against plain versions."""

import hashlib
import itertools
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import conversation_repair as repair
from tillroll.llm import line_dedup
from tillroll.llm.common import importable
from tillroll.llm.queries import QUERIES
from tillroll.llm.whitening import feast, inertia, whiten

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


# --- lines ------------------------------------------------------------------------

LICENCE = "This Line Is Much Longer Than Forty Code Points"
LINES = [
    (1, f"{LICENCE}\nown line one\n{LICENCE.upper()} \n"),
    (2, f"\t{LICENCE}\x0b\nshort"),
    (3, LICENCE),
    (4, f"{LICENCE}\n{LICENCE}\nthe rest"),
    (4, f"a further row of the same document\n{LICENCE}"),
    (None, LICENCE),
    (None, "é" * 39 + "\n" + "É" * 40),
    (6, "é" * 39 + "\n" + "É" * 40),
    (7, "é" * 39 + "\n" + "É" * 40),
    (8, "é" * 39 + "\n" + "É" * 40),
    (9, "é" * 39 + "\n" + "É" * 40 + "\r\n"),
    (10, None),
    (11, ""),
    (12, "\n\n"),
    (13, "x" * 3_000_000 + "\n" + LICENCE.lower()),
]


def line_frame(spark, rows):
    odd = [(i, t, "hot", 1, None, i) for i, t in rows]
    schema = "doc_id long, text string, id string, key int, gone string, last long"
    return spark.createDataFrame(odd, schema).repartition(3)


def line_rows(df):
    digest = F.sha2("kept", 256)
    return Counter(map(tuple, df.select("doc_id", "n_lines", "n_dropped", digest).collect()))


@pytest.mark.parametrize("min_docs", [1, 2, 5, 6])
@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2)])
def test_lines_on_awkward_rows(spark, min_docs, batches, fanout):
    docs = line_frame(spark, LINES)
    found = line_dedup.drop_repeated_lines(docs, min_docs=min_docs, batches=batches, fanout=fanout)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert line_rows(found) == Counter(brute.repeated_lines(LINES, min_docs=min_docs))


def test_no_documents_no_lines(spark):
    assert line_dedup.drop_repeated_lines(line_frame(spark, [])).collect() == []


def test_hot_lines_meet_their_documents_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 0.2)
    found = line_dedup.drop_repeated_lines(line_frame(spark, LINES))
    assert line_rows(found) == Counter(brute.repeated_lines(LINES))


def test_runs_are_disjoint_levelled_and_joined_in_place(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    rng = np.random.default_rng(0)
    total = Counter()
    for _ in range(5):
        keys = rng.choice(200, 60, replace=False)
        total.update(map(int, keys))
        entries = spark.createDataFrame([(bytes([k]), 1, (int(k),)) for k in keys], "key binary, n_docs long, last struct<v:long>")
        runs.add(entries)
    # Five batches with a fanout of two: 4 + 1.
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r["key"] for t in runs.tables for r in spark.table(t).where("NOT known").collect()]
    assert len(held) == len(set(held)) == len(total)
    found = {r["key"][0]: r["n_docs"] for r in runs.frequent(2).collect()}
    assert found == {k: n for k, n in total.items() if n >= 2}
    joined = runs.frequent(2)._jdf.queryExecution().executedPlan().toString()
    for line in joined.splitlines():
        if "Exchange hashpartitioning(key" in line:
            assert "known" not in line
    assert "SelectedBucketsCount" in joined
    tables = runs.tables
    runs.close()
    assert not any(spark.catalog.tableExists(t) for t in tables)


# --- conversations ----------------------------------------------------------------

TALKS = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "Why?"),
    (1, 2, "assistant", "Because."),
    (1, 9, "user", "And then"),
    (2, None, "assistant", "No turn."),
    (2, 3, None, "No role."),
    (2, 3, None, "No role."),
    (2, 3, "", "Empty role."),
    (2, 4, "user", None),
    (None, 1, "user", "No id."),
    (None, None, "user", None),
    (3, 5, "tool", "Output!  \n"),
    (3, 6, "tool", "Output!  \n"),
    (3, 7, "ünknown", "é." * 9),
    (4, 0, "user", " \t"),
    *((5, i, "user", "Same.") for i in range(12)),
    *((6, i, ("user", "assistant")[i % 2], f"{i} " + "long " * 40_000 + "?") for i in range(6)),
    *((100 + i, 0, "user", "One.") for i in range(40)),
]
SCHEMA = "conv_id long, turn long, role string, text string, conv int, copies string, audit long"


def talk_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def test_conversations_on_awkward_rows(spark):
    report = repair.repair_report(talk_frame(spark, TALKS))
    assert Counter(map(tuple, report.collect())) == Counter(brute.conversations(TALKS))
    # Some of the forty single messages were dropped, their conversations were not.
    assert report.count() == len({r[0] for r in TALKS})


def test_no_conversations(spark):
    assert repair.repair_report(talk_frame(spark, [])).collect() == []


def test_conversations_of_the_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = QUERIES["op13_conversation_repair"](spark, SF_DIR)
    assert Counter(map(tuple, found.collect())) == Counter(brute.conversations(map(tuple, rows.collect())))


def test_every_short_signature_is_repaired_at_least_cost(spark):
    faults = {"x": "blank", "S": "truncated", "U": "truncated", "A": "truncated", "O": "truncated"}
    names = {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}
    signatures = ["".join(s) for n in range(4) for s in itertools.product("suaoxUA", repeat=n)]
    frame = spark.createDataFrame([(s,) for s in signatures], "signature string")
    found = {r["signature"]: (r["cost"], r["audit"]) for r in repair.signature_audits(frame).collect()}
    for signature in signatures:
        messages = [(0, names[c.lower()], b"", 0, "") for c in signature]
        expected = brute.cheapest_edits(messages, [faults.get(c, "") for c in signature])
        assert found[signature] == expected[:2]


def test_edited_messages_follow_the_grammar(spark):
    rows = repair.damaged(talk_frame(spark, TALKS))
    messages = repair.edited_messages(rows, repair.plans(rows)).collect()
    roles = {}
    for m in messages:
        roles.setdefault(m["conv"]["id"], []).append((m["place"], m["role"][:1]))
    assert len(messages) > 10
    for found in roles.values():
        found.sort()
        assert [p for p, _ in found] == list(range(1, len(found) + 1))
        initials = "".join(i for _, i in found).removeprefix("s")
        assert initials == "ua" * (len(initials) // 2) and initials


def test_neighbouring_signatures_share_their_nodes(monkeypatch):
    import pyarrow as pa

    made = []
    real = repair.node_before
    monkeypatch.setattr(repair, "node_before", lambda s, rest: made.append(s) or real(s, rest))
    signatures = sorted(["uaua", "xaua", "saua", "a", "ua"], key=lambda s: s[::-1])
    batch = pa.RecordBatch.from_pydict({"signature": signatures, "backward": [s[::-1] for s in signatures]})
    assert sum(b.num_rows for b in repair._audits(iter([batch]))) == 5
    # One for each distinct ending: a, ua, aua, and three of four symbols.
    assert len(made) == 6


# --- whitening --------------------------------------------------------------------


def plain_whitening(vectors, k=4):
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (n * x - sums) / n @ axes / np.sqrt(values), values / np.trace(cov)


def check_whitening(found, vectors, k):
    """``found``: rows in the order of the vectors, k for each."""
    n, deviation, whitened, explained = plain_whitening(vectors, k)
    ours = np.array([r["whitened"] for r in found]).reshape(-1, k)
    signs = np.sign((ours * whitened).sum(axis=0))
    np.testing.assert_allclose(ours * signs, whitened, atol=1e-9)
    assert [r["component"] for r in found] == list(range(1, k + 1)) * len(vectors)
    assert {r["n"] for r in found} == {n}
    assert [r["deviation"] for r in found[::k]] == deviation.tolist()
    np.testing.assert_allclose([r["explained"] for r in found[:k]], explained, rtol=1e-9)
    assert {r["identity_error"] < 1e-9 for r in found} == {True}
    assert len({r["identity_error"] for r in found}) == 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whitening_of_the_table(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    found = QUERIES["op11_embedding_whitening"](spark, f"/root/testdata/{sf}")
    assert found.columns[0] == "vec_id" and len(found.columns) == 7
    check_whitening(found.orderBy("vec_id", "component").collect(), [r["embedding"] for r in rows], 4)


VECTOR_SCHEMA = "vec_id long, embedding array<float>, id int, vector string, component int, n string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 3, None) for i, v in rows], VECTOR_SCHEMA).repartition(2)


def test_whitening_on_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(x) for x in rng.standard_normal(3) * (3, 1, 0.1)]) for i in range(30)]
    good += [(i, good[0][1]) for i in range(30, 60)]  # a third of all rows
    bad = [
        (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
        (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1.0, 2.0, 3.0, 4.0]),
    ]
    found = whiten(vector_frame(spark, good + bad)).orderBy("vec_id", "component").collect()
    # Three dimensions give three components.
    check_whitening(found, [v for _, v in good], 3)
    repeated = whiten(vector_frame(spark, [(None, v) for _, v in good + good[:9]])).collect()
    assert len(repeated) == 3 * 69 and {r["vec_id"] for r in repeated} == {None}


def test_whitening_without_variance(spark):
    assert whiten(vector_frame(spark, [])).collect() == []
    assert whiten(vector_frame(spark, [(1, None)])).collect() == []
    assert whiten(vector_frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.001])])).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    found = whiten(vector_frame(spark, line)).orderBy("vec_id").collect()
    assert len(found) == 5  # one component
    check_whitening(found, [v for _, v in line], 1)


def test_whitening_of_huge_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 0.5])]
    found = whiten(vector_frame(spark, rows)).orderBy("vec_id", "component").collect()
    # Next to these, the variance of the second dimension is below rounding.
    assert [r["component"] for r in found] == [1, 1, 1]
    assert [r["deviation"] is None for r in found] == [True, True, False]
    assert found[0]["identity_error"] < 1e-4


def matrices():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 8, 30):
        a = rng.standard_normal((size, 2 * size)) * rng.uniform(0.01, 5, (size, 1))
        yield a @ a.T
    yield np.diag([5.0, 5, 5, 5, 5, 1, 1, 0])
    yield np.diag([4.0, 3, 2, 1, 1 - 1e-12, 0.5])
    yield np.array([[0.0, 1], [1, 0]]) + np.eye(2)


@pytest.mark.parametrize("matrix", list(matrices()))
def test_components_equal_a_full_decomposition(matrix):
    values, axes = feast(matrix, 4)
    expected = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    expected = expected[expected > 1e-12 * expected[0]][:4]
    np.testing.assert_allclose(values, expected, rtol=1e-12)
    np.testing.assert_allclose(matrix @ axes, axes * values, atol=1e-12 * expected[0])
    np.testing.assert_allclose(axes.T @ axes, np.eye(len(values)), atol=1e-13)
    rng = np.random.default_rng(1)
    for shift in rng.uniform(-1, expected[0] + 1, 20):
        assert inertia(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()

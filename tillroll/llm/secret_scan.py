"""Secret scanning through a trigram inverted index; DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived, such as
(pas AND ass AND ...) OR (sec AND ecr AND ...): a text that lacks them cannot match. The
index has a posting list of rows for every trigram that some rule asks for. Intersecting
the lists gives the candidate rows of a rule, and only those are matched. A rule without
a mandatory trigram, such as a run of hex digits, is matched against every row.
"""

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import saved, text_or_empty

#: A conjunction of trigrams; a query is a disjunction of them, and {EVERY} is "any text".
Clause = frozenset[str]
EVERY: Clause = frozenset()
#: More alternatives than this are given up, which only makes a query weaker.
MAX_STRINGS = 64
MAX_CLAUSES = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first and without overlaps; those whose ``group``
    is shorter than ``least`` are dropped after they have taken their text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The rules. Runs of a class are maximal, so that asking for 24 hex digits, or
# for 16 more characters after AKIA, equals dropping the shorter matches afterwards.
RULES = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)


def _reduced(clauses) -> frozenset[Clause]:
    clauses = set(clauses)
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _and(left: frozenset[Clause], right: frozenset[Clause]) -> frozenset[Clause]:
    if len(left) * len(right) > MAX_CLAUSES:
        return min(left, right, key=len)
    return _reduced(a | b for a in left for b in right)


def _of_strings(strings: set[str]) -> frozenset[Clause]:
    return _reduced(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _letters(members) -> set[str] | None:
    """Lower-cased members of a character class, None if there are many."""
    found = set()
    for kind, value in members:
        if kind is sre.LITERAL:
            found.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < 4:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found


def _strings(items) -> set[str] | None:
    """All lower-cased strings a sub-pattern matches, None if they are many."""
    found = {""}
    for kind, value in items:
        if kind is sre.LITERAL:
            part = {chr(value).lower()}
        elif kind is sre.IN:
            part = _letters(value)
        elif kind is sre.SUBPATTERN:
            part = _strings(value[-1])
        elif kind is sre.BRANCH:
            parts = [_strings(x) for x in value[1]]
            part = None if None in parts else set().union(*parts)
        elif kind is sre.MAX_REPEAT and value[:2] == (0, 1):
            part = _strings(value[2])
            part = part and part | {""}
        elif kind is sre.AT:
            part = {""}
        else:
            part = None
        if part is None or len(found) * len(part) > MAX_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _query(items) -> frozenset[Clause]:
    query, run = frozenset([EVERY]), {""}
    for item in items:
        kind, value = item
        part = _strings([item])
        if part is not None and len(part) * len(run) <= MAX_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        query, run = _and(query, _of_strings(run)), {""}
        if part is not None:
            run = part
        elif kind is sre.SUBPATTERN:
            query = _and(query, _query(value[-1]))
        elif kind is sre.BRANCH:
            query = _and(query, _reduced(c for x in value[1] for c in _query(x)))
        elif kind is sre.MAX_REPEAT and value[0] >= 1:
            query = _and(query, _query(value[2]))
    return _and(query, _of_strings(run))


def trigram_query(pattern: str) -> frozenset[Clause]:
    """Clauses of lower-case trigrams, one of which every matching text has in full."""
    return _query(sre_parser.parse(pattern))


def postings(rows: DataFrame, trigrams: list[str], key: list[str], text: str) -> DataFrame:
    """The index: key columns and trigram, a row for each of ``trigrams`` in a text."""
    lower = F.lower(text)
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(lower, t))
    return rows.select(*key, F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, rules, key: list[str], text: str) -> DataFrame:
    """Key columns and ``candidate_of``, the kinds of the indexed rules a row may match."""
    spark = rows.sparkSession
    wanted = []
    for rule in rules:
        for number, clause in enumerate(sorted(map(sorted, trigram_query(rule.pattern)))):
            wanted += [(rule.kind, number, t, 1 << i, (1 << len(clause)) - 1) for i, t in enumerate(clause)]
    # One row for each trigram of the rules: as small as the rules themselves.
    clauses = spark.createDataFrame(wanted, "kind string, clause int, trigram string, bit long, full long")
    trigrams = sorted({x[2] for x in wanted})
    return (
        postings(rows, trigrams, key, text)
        .join(F.broadcast(clauses), "trigram")
        .groupBy(*key, "kind", "clause", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .filter("bits = full")
        .groupBy(*key)
        .agg(F.collect_set("kind").alias("candidate_of"))
    )


def _matches(rule: Rule, number: int, text: str) -> Column:
    """Array of (kind, i, gap, size, keep): the i-th match, its length and what precedes it."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    return F.transform(
        F.arrays_zip(found.alias("found"), judged.alias("judged"), F.slice(between, 1, F.size(found)).alias("between")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("i"),
            F.char_length(x["between"]).alias("gap"),
            F.char_length(x["found"]).alias("size"),
            (F.char_length(x["judged"]) >= rule.least).alias("keep"),
        ),
    )


def secret_spans(
    docs: DataFrame, rules=RULES, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """rid, doc_id and ``spans`` for each row: an array of (start, kind, stop), sorted.

    ``rid`` numbers the rows, ``kind`` the rules, from 0. Offsets are code points, the
    stop exclusive. A null text is empty; repeated and null ids are rows like any other;
    no rows give no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    key = ["doc_id", "digest"]
    indexed = [r for r in rules if EVERY not in trigram_query(r.pattern)]
    none = F.lit(None).cast("array<string>")
    if indexed:
        may = candidates(rows, indexed, key, "text").select(
            F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest"), "candidate_of"
        )
        on = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("digest") == F.col("c_digest"))
        rows = rows.join(may, on, "left")
    else:
        rows = rows.withColumn("candidate_of", none)
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,keep:boolean>>")
    matched = []
    for number, rule in enumerate(rules):
        try_it = F.col("text").rlike(rule.pattern)
        if rule in indexed:
            try_it = F.array_contains("candidate_of", rule.kind) & try_it
        matched.append(F.when(try_it, _matches(rule, number, "text")).otherwise(empty))
    # Saved because the row numbers are used twice below.
    found = saved(
        rows.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            F.flatten(F.array(*matched)).alias("matches"),
        ),
        "secrets",
    )
    order = W.partitionBy("rid", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    spans = (
        found.select("rid", F.inline("matches"))
        .withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(order))
        .filter("keep")
        .groupBy("rid")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct((F.col("stop") - F.col("size")).alias("start"), "kind", "stop")
                )
            ).alias("spans")
        )
    )
    nothing = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    return (
        found.select("rid", "doc_id")
        .join(spans, "rid", "left")
        .withColumn("spans", F.coalesce("spans", nothing))
    )


def secret_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; see ``secret_spans``.

    The trigram index finds where to look and adds no spans of its own, so ``spans`` are
    the rules' own matches as kind:start:end, joined by commas.
    """
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    shown = F.array_join(
        F.transform(
            "spans", lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["stop"])
        ),
        ",",
    )

    def count(number: int, kind: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == number)
        return F.size(own).cast("long").alias(f"n_{kind}")

    counts = [count(number, rule.kind) for number, rule in enumerate(RULES)]
    return secret_spans(docs, RULES, id_column, text).select(
        "doc_id", *counts, F.sha2(shown, 256).alias("base_sha256"), shown.alias("spans")
    )

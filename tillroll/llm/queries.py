"""The registered queries of the package, with their SQL where SQL can express them."""

from pyspark.sql import functions as F

from tillroll.llm import substring_dedup, suffix_dedup
from tillroll.llm.block_naming import exact_duplicates
from tillroll.llm.common import documents, importable
from tillroll.llm.conversation_repair import repair_report
from tillroll.llm.decontamination import contaminated
from tillroll.llm.jaccard_join import near_duplicates
from tillroll.llm.line_dedup import drop_repeated_lines
from tillroll.llm.ngram_scores import stupid_backoff
from tillroll.llm.packing import pack_documents
from tillroll.llm.secret_scan import secret_report
from tillroll.llm.token_cache import token_counts
from tillroll.llm.toxicity import toxicity
from tillroll.llm.whitening import whiten

OVER_LIMIT = 2048


def _with_digest(left):
    return left.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op1_suffix_array_dedup(spark, sf_dir):
    return _with_digest(suffix_dedup.remove_repeats(documents(spark, sf_dir)))


def op2_substring_dedup(spark, sf_dir):
    return _with_digest(substring_dedup.remove_repeats(documents(spark, sf_dir)))


def op3_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(documents(spark, sf_dir), labels)


def op4_secret_scan(spark, sf_dir):
    return secret_report(documents(spark, sf_dir))


def op5_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(documents(spark, sf_dir), benchmark)


def op6_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_packing(spark, sf_dir):
    import public_tokenizers  # only this query and the next need the vocabulary files

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    counts = token_counts(documents(spark, sf_dir), path)
    return counts.withColumn("over_limit", counts["n_tokens"] > OVER_LIMIT)


def op9_lm_scoring(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return stupid_backoff(docs, docs)


def op10_exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


def op11_embedding_whitening(spark, sf_dir):
    importable(spark)
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_line_dedup(spark, sf_dir):
    return _with_digest(drop_repeated_lines(documents(spark, sf_dir)))


def op13_conversation_repair(spark, sf_dir):
    importable(spark)
    return repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _cheapest(role: str, rest: dict[int, str]) -> str:
    """SQL columns c0 to c3 of a message before ``rest``, the columns of the ending after it.

    A column holds the cost in ten digits and then the edits, so that the least text is the
    cheapest way and, of equal ones, that with the least edits. States: 0 at the start, 1
    after system, 2 after user, 3 after assistant.
    """
    after = (2, 2, 3, 2)

    def way(cost: str, edit: str, column: str) -> str:
        total = f"CAST(left({column}, 10) AS BIGINT) + {cost}"
        return f"lpad(CAST({total} AS VARCHAR), 10, '0') || '{edit}' || substr({column}, 11)"

    own = []
    for state in range(4):
        keeps = {"s": [0], "u": [0, 1, 3], "a": [2]}
        kept = "".join(
            f" WHEN {role} = '{r}' THEN {way('late', 'K', rest[to])}"
            for r, to in (("s", 1), ("u", 2), ("a", 3))
            if state in keeps[r]
        )
        kept = f"CASE WHEN goes THEN NULL{kept} END"
        new = f"CASE WHEN goes THEN NULL ELSE {way('3 + late', 'R', rest[after[state]])} END"
        own.append(f"least({way('4', 'D', rest[state])}, {kept}, {new})")
    both = [f"least(o{s}, {way('3', 'I', f'o{after[s]}')})" for s in (2, 3)]
    lead = [f"least(o{s}, {way('3', 'I', both[0])})" for s in (0, 1)]
    named = [f"{x} AS o{s}" for s, x in enumerate(own)]
    ends = [f"{x} AS c{s}" for s, x in enumerate([*lead, *both])]
    return f"SELECT conv_id, k, {', '.join(ends)} FROM (SELECT conv_id, symbols.k AS k, {', '.join(named)} FROM"


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_substring_dedup,
        op3_toxicity,
        op4_secret_scan,
        op5_decontamination,
        op6_ngram_jaccard_join,
        op7_packing,
        op8_token_counts,
        op9_lm_scoring,
        op10_exact_dedup,
        op11_embedding_whitening,
        op12_line_dedup,
        op13_conversation_repair,
    )
}
ORACLES = {
    "op4_secret_scan": r"""
WITH rules(no, kind, pattern, grp, least) AS (VALUES
    (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
    (2, 'hex', '[0-9a-f]+', 0, 24)),
cut AS (
    SELECT doc_id, no, kind, grp, least,
        regexp_extract_all(coalesce(text, ''), pattern, 0) AS found,
        CASE grp WHEN 2 THEN regexp_extract_all(coalesce(text, ''), pattern, 2)
                 ELSE regexp_extract_all(coalesce(text, ''), pattern, 0) END AS judged,
        regexp_split_to_array(coalesce(text, ''), pattern) AS between
    FROM documents, rules),
each_match AS (
    SELECT doc_id, no, kind, least, unnest(found) AS found, unnest(judged) AS judged,
        unnest(between[1:len(found)]) AS gap, unnest(range(len(found))) AS i
    FROM cut),
placed AS (
    SELECT doc_id, no, kind, length(judged) >= least AS keep, length(found) AS size,
        sum(length(gap) + length(found)) OVER (PARTITION BY doc_id, no ORDER BY i) AS stop
    FROM each_match),
spans AS (
    SELECT doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access,
        count(*) FILTER (no = 2) AS n_hex,
        string_agg(concat(kind, ':', CAST(stop - size AS BIGINT), ':', CAST(stop AS BIGINT)), ','
                   ORDER BY stop - size, no) AS shown
    FROM placed WHERE keep GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(shown, '')) AS base_sha256,
    coalesce(shown, '') AS spans
FROM documents LEFT JOIN spans USING (doc_id)""",
    "op5_decontamination": r"""
WITH w AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
    UNION ALL
    SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
widths AS (SELECT DISTINCT least(5, len(words)) AS width FROM w WHERE side = 'i' AND len(words) > 0),
grams AS (
    SELECT DISTINCT side, id, width, array_to_string(words[k:k + width - 1], ' ') AS gram
    FROM (SELECT side, id, words, width, unnest(range(1, len(words) - width + 2)) AS k
          FROM w, widths WHERE len(words) >= width AND (side = 'd' OR least(5, len(words)) = width))),
sizes AS (SELECT id, count(*) AS n FROM grams WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_found,
    count(*) / any_value(n) AS containment
FROM grams d JOIN grams i USING (width, gram) JOIN sizes ON sizes.id = i.id
WHERE d.side = 'd' AND i.side = 'i' GROUP BY d.id, i.id HAVING 5 * count(*) >= 4 * any_value(n)""",
    "op10_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
    FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)""",
    "op12_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
    SELECT doc_id, place, line, coalesce(doc_id <> last, false) AS gone
    FROM keyed LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op13_conversation_repair": r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations),
coded AS (
    SELECT *, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT),
            list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: list_reduce(
            list_prepend(xor(c, b), list_transform(range(8), lambda i: CAST(0 AS BIGINT))),
            lambda x, i: xor(x // 2, 3988292384 * (x % 2)))), 4294967295) % 20 AS code
    FROM keyed),
messages AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded WHERE code <> 0),
placed AS (
    SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
        left(role, 1) AS initial, lag(left(role, 1)) OVER o || left(role, 1) AS pair
    FROM messages WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
faults AS (
    SELECT *, bare = '' AS blank, bare <> '' AND seen AS duplicate, bare = '' OR seen AS goes,
        bare <> '' AND NOT seen AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated
    FROM placed),
symbols AS (SELECT *, n - i + 1 AS k, CASE WHEN truncated THEN 3 ELSE 0 END AS late FROM faults),
way(conv_id, k, c0, c1, c2, c3) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '0000000000', '0000000006II', '0000000003I', '0000000000'
    FROM symbols
    UNION ALL
    ("""
    + _cheapest("initial", {s: f"c{s}" for s in range(4)})
    + r""" way JOIN symbols USING (conv_id)
        WHERE symbols.k = way.k + 1))),
plans AS (
    SELECT conv_id, CAST(left(c0, 10) AS BIGINT) AS cost, substr(c0, 11) AS audit
    FROM way JOIN (SELECT conv_id, max(n) AS k FROM symbols GROUP BY conv_id) USING (conv_id, k)),
edits AS (
    SELECT conv_id, unnest(range(1, len(audit) + 1)) AS j, unnest(string_split(audit, '')) AS edit
    FROM plans WHERE audit <> ''),
used AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER o AS i, count(*) FILTER (edit <> 'D') OVER o AS place
    FROM edits WINDOW o AS (PARTITION BY conv_id ORDER BY j)),
filled AS (
    SELECT used.conv_id, j, edit, place, symbols.role, symbols.text,
        max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY used.conv_id) AS led
    FROM used LEFT JOIN symbols ON used.conv_id = symbols.conv_id AND used.i = symbols.i AND edit <> 'I'),
repaired AS (
    SELECT conv_id, sha256(string_agg(concat(
        CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END,
        ':', CASE WHEN edit <> 'I' THEN text END), chr(10) ORDER BY j)) AS digest
    FROM filled WHERE edit <> 'D' GROUP BY conv_id),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
    coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted USING (conv_id)
    LEFT JOIN plans USING (conv_id) LEFT JOIN repaired USING (conv_id)""",
}

"""Similarity join on word shingles: every two texts whose Jaccard reaches 0.9 are linked.

1. Equal shingle sets are one node, so copies never meet each other.
2. Two sets that reach the threshold differ in few shingles. Cut the hash range into one
   segment more than they may differ in, and the sets are equal in some segment. So sets
   that share no (segment, content) can't link. The number of segments depends on the size
   of the set: sizes are dealt to bands, and a set also takes part in the next lower
   band, whose larger partners it may be.
3. The connected components of "share a segment" are small blocks of near copies. Within
   a block, inverted lists are searched for each set as DivideSkip does: merging the
   short lists counts occurrences; sets that could still reach the required overlap T are
   probed for in the long lists, of which there are fewer than T.

Links are not written out: a set already connected to another need not be compared with
it, so a block gives a spanning forest. Blocks of more than BLOCK_SHINGLES shingles are
cut into chunks, and each pair of chunks is a task.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import (
    LOWER,
    Chunk,
    mix,
    ngram_hashes,
    ragged,
    span_hashes,
    text_chunks,
    words,
)
from tillroll.llm.common import kept_rows, saved, text_or_empty
from tillroll.llm.components import connected_components

SHINGLE_WORDS = 3
#: Linked when DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 90, 100
BLOCK_SHINGLES = 4_000_000
#: Text for which there is one bucket of segment keys.
BUCKET_BYTES = 16 << 20
MU = 0.0085  # DivideSkip's cost of a probe relative to a step of the merge


def shingle_sets(chunk: Chunk, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted by both."""
    data = LOWER[chunk.data]
    found = words(chunk, data)
    tokens = span_hashes(data, found.starts, found.ends)
    grams = ngram_hashes(tokens, n)
    counts = np.maximum(found.stop - found.first - n + 1, 0)
    at = ragged(found.first, counts)
    rows, hashes = [np.repeat(np.arange(len(counts)), counts)], [grams[at]]
    size = found.stop - found.first
    for width in range(1, n):  # fewer words than a shingle: all of them as one
        short = np.flatnonzero(size == width)
        rows.append(short)
        hashes.append(ngram_hashes(tokens, width)[found.first[short]])
    row, hashed = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    return row[fresh], hashed[fresh]


def _set_ids(row: np.ndarray, hashed: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each row's set, and a number that equal sets share."""
    sizes = np.bincount(row, minlength=n_rows)
    ends = np.cumsum(sizes)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashed), dtype=np.uint64)])
    ids = mix((total[ends] - total[ends - sizes]) ^ mix(sizes.astype(np.uint64)))
    return sizes, ids.astype(np.int64)


def band(sizes: np.ndarray) -> np.ndarray:
    """Sets that can link are in the same or in adjacent bands."""
    ratio = math.log(DENOMINATOR / NUMERATOR)
    return np.floor(np.log(np.maximum(sizes, 1)) / ratio + 1e-9).astype(np.int64)


def segments(bands: np.ndarray) -> np.ndarray:
    """One more than a set of the band and a linked, not smaller one can differ in.

    U - I <= (1 - t) * U and U <= smaller set / t, with t the threshold.
    """
    largest = np.power(DENOMINATOR / NUMERATOR, bands + 1)
    return np.floor((DENOMINATOR - NUMERATOR) / NUMERATOR * largest + 1e-6).astype(np.int64) + 1


def _segment_keys(row, hashed, sizes, bands, chosen):
    """(row, key) for the non-empty and empty segments of every chosen row's set."""
    keep = chosen[row]
    row, hashed = row[keep], hashed[keep]
    n_segments = segments(bands)
    of = (hashed >> np.uint64(32)) * n_segments[row].astype(np.uint64) >> np.uint64(32)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashed), dtype=np.uint64)])
    # All segments of all chosen rows; their contents are adjacent, as hashes are sorted.
    rows = np.repeat(np.flatnonzero(chosen), n_segments[chosen])
    first = np.concatenate([[0], np.cumsum(n_segments * chosen)])
    counts = np.bincount(first[row] + of.astype(np.int64), minlength=int(first[-1]))
    ends = np.cumsum(counts)
    content = total[ends] - total[ends - counts]
    number = np.arange(len(rows)) - first[rows]
    place = mix((bands[rows] << 40).astype(np.uint64) ^ number.astype(np.uint64))
    return rows, mix(content ^ place)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, ids = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for chunk in text_chunks(batch, "text"):
            span = slice(chunk.first, chunk.first + len(chunk.starts))
            sizes[span], ids[span] = _set_ids(*shingle_sets(chunk), len(chunk.starts))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(sizes), pa.array(ids)],
            names=["doc_id", "digest", "n_shingles", "set_id"],
        )


def _keys(n_buckets: int):
    """Function for mapInArrow: texts to (bucket, keys, ids), arrays of a batch's keys.

    A set with several copies in the batch is there once.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            seen = np.zeros(0, np.int64)
            for chunk in text_chunks(batch, "text"):
                row, hashed = shingle_sets(chunk)
                n = len(chunk.starts)
                sizes, own = _set_ids(row, hashed, n)
                new = np.zeros(n, dtype=bool)
                new[np.unique(own, return_index=True)[1]] = True
                new &= (sizes > 0) & ~np.isin(own, seen)
                seen = np.concatenate([seen, own[new]])
                bands = band(sizes)
                for lower in (0, 1):
                    chosen = new & (bands >= lower)
                    rows, key = _segment_keys(row, hashed, sizes, bands - lower, chosen)
                    keys.append(key)
                    ids.append(own[rows])
            keys, ids = np.concatenate(keys), np.concatenate(ids)
            order = np.argsort(keys)
            keys, ids = keys[order], ids[order]
            bucket = ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(bucket, np.arange(n_buckets + 1))
            used = np.flatnonzero(cut[1:] > cut[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used, pa.int64()),
                    pa.array([keys[cut[b] : cut[b + 1]].tobytes() for b in used], pa.binary()),
                    pa.array([ids[cut[b] : cut[b + 1]].tobytes() for b in used], pa.binary()),
                ],
                names=["bucket", "keys", "ids"],
            )

    return find


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket to edges (a, b): of the sets with one key, the least and each other."""

    def edges(keys: list[bytes], ids: list[bytes]) -> pa.RecordBatch:
        key = np.frombuffer(b"".join(keys), dtype=np.uint64)
        node = np.frombuffer(b"".join(ids), dtype=np.int64)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        least = node[np.flatnonzero(first)][np.cumsum(first) - 1]
        pairs = np.unique(np.stack([least, node])[:, least != node], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    bucket, keys, ids = None, [], []
    for batch in batches:
        for b, k, i in zip(*(batch.column(n).to_pylist() for n in ("bucket", "keys", "ids")), strict=True):
            if b != bucket and keys:
                yield edges(keys, ids)
                keys, ids = [], []
            bucket = b
            keys.append(k)
            ids.append(i)
    if keys:
        yield edges(keys, ids)


def divide_skip(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets, each a sorted array of hashes."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order])
    docs = np.repeat(np.arange(len(order)), sizes)
    terms = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    by_term = np.argsort(terms, kind="stable")
    lists, heads = docs[by_term], np.concatenate([[0], np.cumsum(np.bincount(terms))])
    lengths, own = np.diff(heads), np.split(terms, np.cumsum(sizes)[:-1])
    parent = list(range(len(order)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for q, mine in enumerate(own):
        n = len(mine)
        need = -(-NUMERATOR * n // DENOMINATOR)  # of any set not larger than this one
        by_length = mine[np.argsort(lengths[mine], kind="stable")]
        longest = max(2, int(lengths[by_length[-1]]))
        n_long = min(need - 1, int(need / (MU * math.log2(longest) + 1)))
        short, long = by_length[: n - n_long], np.sort(by_length[n - n_long :])
        merged = np.bincount(lists[ragged(heads[short], lengths[short])], minlength=q)[:q]
        may = np.flatnonzero(merged >= need - n_long)
        may = may[sizes[may] * DENOMINATOR >= NUMERATOR * n]
        for c in may[np.argsort(-merged[may], kind="stable")]:
            if root(c) == root(q):
                continue
            at = np.searchsorted(own[c], long)
            at[at == len(own[c])] = 0
            both = int(merged[c]) + int(np.count_nonzero(own[c][at] == long))
            if DENOMINATOR * both >= NUMERATOR * (n + int(sizes[c]) - both):
                parent[root(q)] = root(c)
                forest.append((order[q], order[int(c)]))
    return forest


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts sorted by task to edges (a, b) between set ids."""

    def edges(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        distinct = {i: s for i, s in zip(ids, sets, strict=True)}
        ids, found = list(distinct), divide_skip(list(distinct.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[x] for x, _ in found], pa.int64()), pa.array([ids[y] for _, y in found], pa.int64())],
            names=["a", "b"],
        )

    task, ids, sets = None, [], []
    for batch in batches:
        tasks = list(zip(*(batch.column(n).to_pylist() for n in ("block", "i", "j")), strict=True))
        set_ids = batch.column("set_id").to_pylist()
        for chunk in text_chunks(batch, "text"):
            row, hashed = shingle_sets(chunk)
            cut = np.searchsorted(row, np.arange(len(chunk.starts) + 1))
            for r in range(len(chunk.starts)):
                if tasks[chunk.first + r] != task and ids:
                    yield edges(ids, sets)
                    ids, sets = [], []
                task = tasks[chunk.first + r]
                ids.append(set_ids[chunk.first + r])
                sets.append(hashed[cut[r] : cut[r + 1]].copy())
    if ids:
        yield edges(ids, sets)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, digest (xxhash64 of the text), n_shingles, component_id, kept; a row each.

    Words are what stands between ASCII white space, A-Z lower-cased. A text with fewer
    words than a shingle has one shingle; one without words, or null, has none, is linked
    with nothing and kept. component_id is the smallest doc_id that links lead to. Of a
    component the row with the smallest (doc_id, digest) is kept, a null doc_id being the
    largest; rows that repeat it in both count as kept too. Sets are told apart by 64-bit
    hashes of their shingles.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    schema = "doc_id long, digest long, n_shingles long, set_id long"
    known = saved(rows.mapInArrow(_sets, schema), "sets")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = 16 + n_bytes // BUCKET_BYTES
    shared = (
        rows.select("text")
        .mapInArrow(_keys(n_buckets), "bucket long, keys binary, ids binary")
        .repartition(n_buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_shared_keys, "a long, b long")
    )
    blocks = connected_components(shared).select(
        F.col("node").alias("set_id"), F.col("component").alias("block")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest"))
    nodes = saved(
        known.filter("n_shingles > 0")
        .groupBy("set_id")
        .agg(first.alias("first"), F.max("n_shingles").alias("n_shingles"))
        .join(blocks, "set_id")
        .select("set_id", "block", "n_shingles", F.col("first.doc_id"), F.col("first.digest")),
        "nodes",
    )
    chunks = nodes.groupBy("block").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("chunks")
    )
    tasks = (
        nodes.join(chunks, "block")
        .withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select(
            "set_id",
            "block",
            F.col("doc_id").alias("n_id"),
            F.col("digest").alias("n_digest"),
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
        )
    )
    on = (F.col("digest") == F.col("n_digest")) & F.col("doc_id").eqNullSafe(F.col("n_id"))
    # The same join at every size: how many sets are near copies follows the corpus.
    links = (
        rows.join(tasks.hint("merge"), on)
        .select("block", "i", "j", "set_id", "text")
        .repartition("block", "i", "j")
        .sortWithinPartitions("block", "i", "j", "set_id")
        .mapInArrow(_link, "a long, b long")
    )
    linked = connected_components(links)
    classes = known.join(linked, F.col("set_id") == F.col("node"), "left").withColumn(
        "class", F.when(F.col("n_shingles") > 0, F.coalesce("component", "set_id"))
    )
    classes = saved(classes.select(*known.columns, "class"), "classes")
    # Copies and components: combined before the shuffle, and singles joined with nothing.
    heads = saved(
        classes.filter("class IS NOT NULL").groupBy("class").agg(first.alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "heads",
    )
    joined = classes.join(heads, "class", "left")
    alone = F.col("first").isNull()
    return joined.select(
        "doc_id",
        "digest",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (
            alone
            | (F.col("digest") == F.col("first.digest"))
            & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        ).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept rows, all columns unchanged, whatever their names.

    As in ``near_duplicates``, null texts have no shingles and are all kept. Of rows that
    repeat an id and a text one stays, whichever comes first. No rows give no rows.
    """
    found = near_duplicates(docs, id_column, text).filter("kept").select("doc_id", "digest")
    return kept_rows(docs, found.distinct(), id_column, F.xxhash64(text_or_empty(text)))

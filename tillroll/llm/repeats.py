"""Repeated windows of tokens across documents: what the two span operators share.

A token is a byte or the hash of a word. Every ``window`` tokens hold one anchor, the
k-gram with the least hash among them (the leftmost of equal ones), so equal windows hold
equal anchors at the same place. The windows of a document that have one anchor in common
overlap in one fragment of text. An anchor found in a single document can be in no repeat;
the fragments of all others are dealt to shards by their anchor, equal ones combined into
one with the smallest and largest document that has it. A shard's solver then says for
every window of a fragment which is the smallest document with that window, and the
answers are joined back to where the fragments occur. All is exact but for collisions of
64-bit hashes: a solver compares tokens, never anchors.

Neighbouring fragments overlap in all but a few tokens. What is stored of a document is
therefore the text its fragments cover, each token once, and where each fragment is in it;
fragments are cut from that to be dealt, and again to join the answers.

An anchor in more than HOT_DOCUMENTS documents would make too large a shard. Its windows
become fragments of their own, dealt by the hash of the window.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import (
    BASE,
    Chunk,
    Spans,
    mix,
    ngram_hashes,
    ragged,
    span_hashes,
    text_chunks,
    words,
)
from tillroll.llm.common import discard, saved_at, text_or_empty

HOT_DOCUMENTS = 20_000
#: Tokens that a solver gets at once; an anchor with more comes alone.
SHARD_TOKENS = 1 << 16
#: Texts are hashed so many bytes at a time that the arrays stay in a core's cache.
HASHED_BYTES = 1 << 17
#: Stored text whose fragments are cut, and equal ones combined, at once.
CUT_BYTES = 4 << 20
#: Stands for "no document"; a row without a doc_id counts as the largest document.
NOBODY = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Unit:
    """What tokens are, how many make a window, and the length of the anchoring k-gram."""

    by_word: bool
    window: int
    gram: int


@dataclass
class Tokens:
    """Tokens of a chunk, and for each text its first one and the one after its last."""

    values: np.ndarray
    first: np.ndarray
    stop: np.ndarray


def tokens(chunk: Chunk, unit: Unit) -> Tokens:
    if not unit.by_word:
        return Tokens(chunk.data, chunk.starts, chunk.ends)
    found = words(chunk)
    return Tokens(span_hashes(chunk.data, found.starts, found.ends), found.first, found.stop)


def _gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    if len(values) < n:
        return np.zeros(0, dtype=np.uint64)
    if values.dtype == np.uint8:
        return Spans(values).every(n)
    return ngram_hashes(values, n)


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` adjacent keys."""
    reach = 1
    while 2 * reach <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    return np.minimum(keys[: len(keys) - (width - reach)], keys[width - reach :])


@dataclass
class Fragments:
    """Of each fragment: its text, first token, number of windows and anchor."""

    row: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray


def fragments(found: Tokens, unit: Unit) -> Fragments:
    none = np.zeros(0, dtype=np.int64)
    if len(found.values) < unit.window:
        return Fragments(none, none, none, none.astype(np.uint64))
    hashes = _gram_hashes(found.values, unit.gram)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    least = _lowest(keys, unit.window - unit.gram + 1)
    last = found.stop - unit.window
    fresh = np.ones(len(least), dtype=bool)
    fresh[1:] = least[1:] != least[:-1]
    fresh[found.first[last >= found.first]] = True
    begins = np.flatnonzero(fresh)
    row = np.searchsorted(found.first, begins, side="right") - 1
    # Windows that run into the next text are in no fragment.
    stops = np.minimum(np.append(begins[1:], len(least)), last[row] + 1)
    inside = begins < stops
    begins, row, stops = begins[inside], row[inside], stops[inside]
    place = (least[begins] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return Fragments(row, begins, stops - begins, hashes[place])


def _anchors(unit: Unit):
    """Function for mapInArrow: (doc, rid, text) to the distinct (h, doc, rid)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", HASHED_BYTES):
                own = fragments(tokens(chunk, unit), unit)
                order = np.lexsort((own.anchor, own.row))
                row, anchor = own.row[order], own.anchor[order]
                fresh = np.ones(len(row), dtype=bool)
                fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                at = pa.array(row[fresh] + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[fresh].view(np.int64)),
                        batch.column("doc").take(at),
                        batch.column("rid").take(at),
                    ],
                    names=["h", "doc", "rid"],
                )

    return find


def _list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def _binary_array(body: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Pieces of ``sizes`` elements that follow one another in ``body``."""
    ends = np.append(0, np.cumsum(sizes)) * body.itemsize
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body.tobytes())]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), buffers).cast(pa.binary())


def _located(unit: Unit):
    """Function for mapInArrow: texts and their shared anchors to what their fragments cover.

    ``body`` holds the tokens in fragments, each once; ``gaps`` from one fragment's first token
    to the next one's (of the first: from the text's), ``sizes`` in tokens, ``keys``.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Which anchors are shared, or hot, is the same for all texts.
            shared, hot = (
                (lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64))
                for lists in (batch.column("shared"), batch.column("hot"))
            )
            for chunk in text_chunks(batch, "text", HASHED_BYTES):
                stop = chunk.first + len(chunk.starts)
                some, many = (
                    values[offsets[chunk.first] : offsets[stop]] for offsets, values in (shared, hot)
                )
                found = tokens(chunk, unit)
                own = fragments(found, unit)
                split = np.isin(own.anchor, many) if len(many) else np.zeros(len(own.row), bool)
                usual = np.isin(own.anchor, some) & ~split
                row, start, size, key = (
                    x[usual] for x in (own.row, own.start, own.windows, own.anchor)
                )
                if split.any():
                    alone = ragged(own.start[split], own.windows[split])
                    row = np.append(row, np.repeat(own.row[split], own.windows[split]))
                    start = np.append(start, alone)
                    size = np.append(size, np.ones(len(alone), np.int64))
                    key = np.append(key, _gram_hashes(found.values, unit.window)[alone])
                    order = np.argsort(start)
                    row, start, size, key = row[order], start[order], size[order], key[order]
                size = size + unit.window - 1
                first = np.ones(len(row), dtype=bool)
                first[1:] = row[1:] != row[:-1]
                gap = start - np.where(first, found.first[row], np.append(0, start[:-1]))
                added = _added(gap, size, first)
                counts = np.bincount(row, minlength=len(chunk.starts))
                body_sizes = np.bincount(row, added, len(chunk.starts)).astype(np.int64)
                span = slice(chunk.first, stop)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc")[span],
                        batch.column("rid")[span],
                        _binary_array(found.values[ragged(start + size - added, added)], body_sizes),
                        _list_array(gap, counts, pa.int32()),
                        _list_array(size, counts, pa.int32()),
                        _list_array(key.view(np.int64), counts, pa.int64()),
                    ],
                    names=["doc", "rid", "body", "gaps", "sizes", "keys"],
                )

    return locate


def _added(gap: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many tokens of each fragment no earlier one of its text covers: its last ones."""
    beyond = gap + size - np.append(0, size[:-1])
    return np.where(first, size, np.minimum(size, beyond))


@dataclass
class Cut:
    """Fragments of some stored texts: tokens, where each begins and how long it is in them,
    its key and hash, its place in the text, and its row in the batch."""

    values: np.ndarray
    at: np.ndarray
    size: np.ndarray
    key: np.ndarray
    fid: np.ndarray
    start: np.ndarray
    row: np.ndarray


def _cuts(batch: pa.RecordBatch, unit: Unit) -> Iterator[Cut]:
    lists = [batch.column(c) for c in ("gaps", "sizes", "keys")]
    offsets = lists[0].offsets.to_numpy()
    gaps, sizes, keys = (x.values.to_numpy() for x in lists)
    for chunk in text_chunks(batch, "body", CUT_BYTES):
        cuts = offsets[chunk.first : chunk.first + len(chunk.starts) + 1]
        span, counts = slice(cuts[0], cuts[-1]), np.diff(cuts)
        values = chunk.data.view(np.uint64 if unit.by_word else np.uint8)
        gap, size = gaps[span].astype(np.int64), sizes[span].astype(np.int64)
        first = np.zeros(len(gap), dtype=bool)
        begins = (cuts[:-1] - cuts[0])[counts > 0]
        first[begins] = True
        at = np.cumsum(_added(gap, size, first)) - size
        total = np.cumsum(gap)
        start = total - np.repeat((total - gap)[begins], counts[counts > 0])
        row = np.repeat(np.arange(len(counts)) + chunk.first, counts)
        fid = span_hashes(values, at, at + size).view(np.int64)
        yield Cut(values, at, size, keys[span], fid, start, row)


def _pieces(unit: Unit):
    """Function for mapInArrow: stored texts to their fragments, equal ones of a chunk combined."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc").to_numpy()
            for own in _cuts(batch, unit):
                if not len(own.key):
                    continue
                same = mix(own.key.view(np.uint64) * BASE ^ own.fid.view(np.uint64))
                order = np.argsort(same)
                same, doc = same[order], docs[own.row[order]]
                begins = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
                pick = order[begins]
                size = own.size[pick]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.key[pick]),
                        _binary_array(own.values[ragged(own.at[pick], size)], size),
                        pa.array(np.minimum.reduceat(doc, begins)),
                        pa.array(np.maximum.reduceat(doc, begins)),
                    ],
                    names=["key", "piece", "low", "high"],
                )

    return cut


def _places(unit: Unit):
    """Function for mapInArrow: stored texts to where each fragment is, without its tokens."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in _cuts(batch, unit):
                at = pa.array(own.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(at),
                        batch.column("rid").take(at),
                        pa.array(own.start),
                        pa.array(own.key),
                        pa.array(own.fid),
                    ],
                    names=["doc", "rid", "start", "key", "fid"],
                )

    return place


def _body(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each piece begins and the last one ends, and the bytes these places are in."""
    offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int32)
    data = np.frombuffer(pieces.buffers()[2] or b"", dtype=np.uint8)
    return offsets[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64), data


#: Gets the tokens of all pieces, where each begins and ends, and its smallest document. Gives
#: for every token the smallest document of the pieces with the window that begins there, or
#: NOBODY if only one has it; what it gives for a piece's last window - 1 tokens is unused.
Solver = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _solve(solver: Solver, unit: Unit):
    """Function for mapInArrow: pieces sorted by key to runs of windows with one ``low``."""
    kind = np.uint64 if unit.by_word else np.uint8

    def runs(shard: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(shard).combine_chunks().to_batches()[0]
        keys, lows, highs = (rows.column(c).to_numpy() for c in ("key", "low", "high"))
        offsets, data = _body(rows.column("piece"))
        ends = (offsets[1:] - offsets[0]) // np.dtype(kind).itemsize
        sizes = np.diff(ends, prepend=0)
        starts = ends - sizes
        values = data[offsets[0] : offsets[-1]].view(kind)
        ids = span_hashes(values, starts, ends).view(np.int64)
        lowest = solver(values, starts, ends, lows)
        n_windows = sizes - unit.window + 1
        at, piece = ragged(starts, n_windows), np.repeat(np.arange(len(sizes)), n_windows)
        low = np.minimum(lowest[at], lows[piece])
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (piece[1:] != piece[:-1]) | (low[1:] != low[:-1])
        begins = np.flatnonzero(fresh)
        lengths = np.diff(np.append(begins, len(at)))
        # A run no document but the smallest has changes nothing.
        useful = low[begins] < highs[piece[begins]]
        begins, lengths = begins[useful], lengths[useful]
        own = piece[begins]
        offset = at[begins] - starts[own]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys[own]),
                pa.array(ids[own]),
                pa.array(offset),
                pa.array(offset + lengths - 1 + unit.window),
                pa.array(low[begins]),
            ],
            names=["key", "fid", "from", "to", "low"],
        )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, n, last = [], 0, None
        for batch in batches:
            if not len(batch):
                continue
            keys, total = batch.column("key").to_numpy(), _body(batch.column("piece"))[0]
            total = (total - total[0]) // np.dtype(kind).itemsize
            # A shard ends before the first row with a new key once it has enough tokens.
            fresh = np.flatnonzero(np.append(keys[0] != last, keys[1:] != keys[:-1]))
            start, last = 0, keys[-1]
            while True:
                i = np.searchsorted(total[fresh], total[start] + max(SHARD_TOKENS - n, 0))
                cut = max(int(fresh[i]), start) if i < len(fresh) else len(keys)
                if cut > start:
                    shard.append(batch.slice(start, cut - start))
                    n += int(total[cut] - total[start])
                if i == len(fresh):
                    break
                if shard:
                    yield runs(shard)
                shard, n, start = [], 0, cut
        if shard:
            yield runs(shard)

    return solve


def _kept(unit: Unit):
    """Function for mapInArrow: texts and spans to the bytes or words that are left."""

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            rows = pc.list_parent_indices(lists).to_numpy()
            starts, stops = (
                pc.list_flatten(lists).field(c).to_numpy() for c in ("start", "stop")
            )
            for chunk in text_chunks(batch, "text"):
                if unit.by_word:
                    found = words(chunk)
                    first, stop, n = found.first, found.stop, len(found.starts)
                else:
                    first, stop, n = chunk.starts, chunk.ends, len(chunk.data)
                a, b = np.searchsorted(rows, [chunk.first, chunk.first + len(first)])
                base = first[rows[a:b] - chunk.first]
                steps = np.bincount(base + starts[a:b], minlength=n + 1)
                steps -= np.bincount(base + stops[a:b], minlength=n + 1)
                gone = np.cumsum(steps)[:n] > 0
                fresh = gone.copy()
                fresh[1:] &= ~gone[:-1]
                begins = first[first < stop]
                fresh[begins] = gone[begins]
                removed, runs = (
                    np.diff(np.append(0, np.cumsum(x))[np.append(first, n)]) for x in (gone, fresh)
                )
                if unit.by_word:
                    left = []
                    for x, y in zip(first, stop, strict=True):
                        pick = x + np.flatnonzero(~gone[x:y])
                        pairs = zip(found.starts[pick], found.ends[pick], strict=True)
                        left.append(b" ".join(chunk.data[x:y].tobytes() for x, y in pairs))
                    left = pa.array(left, pa.binary())
                else:
                    left = _binary_array(chunk.data[~gone], stop - first - removed)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[chunk.first : chunk.first + len(first)],
                        pa.array(stop - first, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(runs, pa.int64()),
                        left,
                    ],
                    names=["doc_id", "n_tokens", "n_removed", "n_spans", "kept"],
                )

    return rest


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    doc_id = F.col(id_column).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.withColumn("doc", F.coalesce("doc_id", F.lit(int(NOBODY)))).withColumn(
        "rid", F.xxhash64("doc", "text")
    )


def _shared_anchors(rows: DataFrame, unit: Unit, hot_documents: int) -> tuple[DataFrame, str]:
    """rid, shared, hot: each row's anchors that are in other documents too, or in very many."""
    anchors = rows.mapInArrow(_anchors(unit), "h long, doc long, rid long")
    shared, path = saved_at(
        anchors.groupBy("h")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
        .filter("low < high")
        .select("h", (F.col("n") > hot_documents).alias("hot")),
        "anchors",
        drop_shuffles=True,
    )
    wanted = saved_at(
        anchors.select("h", "rid")
        .join(shared, "h")
        .groupBy("rid")
        .agg(
            F.collect_list("h").alias("shared"),
            F.collect_list(F.when(F.col("hot"), F.col("h"))).alias("hot"),
        ),
        "wanted",
        drop_shuffles=True,
        hash_joins=True,
    )
    discard(rows.sparkSession, path)
    return wanted


def _spans(
    docs: DataFrame,
    unit: Unit,
    solver: Solver,
    id_column: str,
    text: str,
    hot_documents: int = HOT_DOCUMENTS,
) -> tuple[DataFrame, list[str]]:
    """As ``repeated_spans``, with the folders that it reads."""
    spark = docs.sparkSession
    rows = _keyed(docs, id_column, text).select("doc", "rid", "text")
    wanted, wanted_path = _shared_anchors(rows, unit, hot_documents)
    stored, stored_path = saved_at(
        rows.join(wanted, "rid").mapInArrow(
            _located(unit),
            "doc long, rid long, body binary, gaps array<int>, sizes array<int>, keys array<long>",
        ),
        "fragments",
        drop_shuffles=True,
        hash_joins=True,
    )
    discard(spark, wanted_path)
    runs, runs_path = saved_at(
        stored.select("doc", "body", "gaps", "sizes", "keys")
        .mapInArrow(_pieces(unit), "key long, piece binary, low long, high long")
        .repartition("key")
        .groupBy("key", "piece")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .sortWithinPartitions("key")
        .mapInArrow(
            _solve(solver, unit), "key long, fid long, from long, to long, low long"
        ),
        "runs",
        drop_shuffles=True,
    )
    spans = (
        stored.mapInArrow(_places(unit), "doc long, rid long, start long, key long, fid long")
        .join(runs, ["key", "fid"])
        .filter("low < doc")
        .select(
            "doc",
            "rid",
            (F.col("start") + F.col("from")).alias("start"),
            (F.col("start") + F.col("to")).alias("stop"),
            "low",
        )
    )
    return spans, [stored_path, runs_path]


def repeated_spans(
    docs: DataFrame,
    unit: Unit,
    solver: Solver,
    id_column: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """doc, rid, start, stop, low: spans whose windows all start in document ``low`` too.

    ``low`` is smaller than ``doc``; spans may overlap. doc and rid are as in ``_keyed``.
    """
    return _spans(docs, unit, solver, id_column, text, **options)[0]


def without_repeats(
    docs: DataFrame,
    unit: Unit,
    solver: Solver,
    id_column: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """doc_id, n_tokens, n_removed, n_spans, kept (binary); one row for each row."""
    spans, paths = _spans(docs, unit, solver, id_column, text, **options)
    spans, _ = saved_at(
        spans.groupBy("doc", "rid").agg(
            F.collect_list(
                F.struct(*(F.col(c).cast("int").alias(c) for c in ("start", "stop")))
            ).alias("spans")
        ),
        "spans",
        drop_shuffles=True,
        hash_joins=True,
    )
    for path in paths:
        discard(docs.sparkSession, path)
    return (
        _keyed(docs, id_column, text)
        .join(spans, ["doc", "rid"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _kept(unit), "doc_id long, n_tokens long, n_removed long, n_spans long, kept binary"
        )
    )

"""Benchmark decontamination: short test items inside long documents.

Containment, the share of an item's word shingles that a text holds, says whether the
item is in the text however long the text is. An item's MinHash sketch is the set of its
smallest shingle hashes. Items are partitioned by size, the number of their distinct
shingles; a partition's sketches have one hash more than its largest item may miss. So
a text with enough of an item holds at least one hash of its sketch, and texts with too
few shingles for a partition skip it. Texts need no sketch: one of 20,000 words and an
item of 15 have nothing in common that a signature of the text could show, so the text's
own shingles probe the sketches. Every hit is verified by exact containment, comparing
the words themselves.

Items are processed in blocks of at most BLOCK_BYTES of text. A block is what a task gets
to hold, so memory doesn't follow the benchmark; documents are never shuffled.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import LOWER, Chunk, ngram_hashes, span_hashes, text_chunks, words
from tillroll.llm.common import text_or_empty

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BLOCK_BYTES = 4 << 20
FILTER_BITS = 20


@dataclass
class Hit:
    row: int
    item: int
    found: int


class ItemBlock:
    """The sketches of some items, and their shingles for the verification."""

    def __init__(self, items: list[tuple[int, str]], shingle_words: int, threshold: float):
        self.ids = [item for item, _ in items]
        self.threshold = threshold
        self.shingles: list[dict[int, bytes]] = []  # by hash; a text's words joined by spaces
        self.widths: list[int] = []  # words in a shingle: fewer for a shorter item
        by_width: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, text) in enumerate(items):
            data = LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]
            chunk = Chunk(0, data, np.array([0]), np.array([len(data)]))
            found = words(chunk)
            n = len(found.starts)
            width = min(shingle_words, n)
            self.widths.append(width)
            hashes = ngram_hashes(span_hashes(data, found.starts, found.ends), width) if n else []
            self.shingles.append(
                {int(h): _shingle(data, found, i, width) for i, h in enumerate(hashes)}
            )
            if n:
                by_width[width].append((number, len(self.shingles[-1])))
        #: For each width: sketch hashes, the items they are of, least shingles of a text,
        #: and a bit table of the hashes.
        self.sketches = {}
        for width, members in by_width.items():
            hashes, owners, least = [], [], []
            for number, size in members:
                # The partition of sizes [low, 2 * low); what its largest item may miss.
                low = 1 << (size.bit_length() - 1)
                largest = min(2 * low - 1, max(s for _, s in members))
                keep = largest - int(np.ceil(threshold * largest - 1e-9)) + 1
                own = sorted(self.shingles[number])[:keep]
                hashes += own
                owners += [number] * len(own)
                least += [int(np.ceil(threshold * low - 1e-9))] * len(own)
            order = np.argsort(np.array(hashes, dtype=np.uint64), kind="stable")
            hashes = np.array(hashes, dtype=np.uint64)[order]
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.sketches[width] = (
                hashes,
                np.array(owners)[order],
                np.array(least)[order],
                bits,
            )

    def hits(self, chunk: Chunk) -> list[Hit]:
        """Texts of the chunk with enough of an item."""
        data = LOWER[chunk.data]
        found = words(chunk, data)
        tokens = span_hashes(data, found.starts, found.ends)
        out = []
        for width, (hashes, owners, least, bits) in self.sketches.items():
            grams = ngram_hashes(tokens, width)
            may = np.flatnonzero(bits[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            low = np.searchsorted(hashes, grams[may], side="left")
            high = np.searchsorted(hashes, grams[may], side="right")
            pairs = set()
            for at, a, b in zip(may[high > low], low[high > low], high[high > low], strict=True):
                row = int(np.searchsorted(found.first, at, side="right")) - 1
                if at + width > found.stop[row]:
                    continue  # across two texts
                n_grams = found.stop[row] - found.first[row] - width + 1
                pairs |= {(row, int(owners[j])) for j in range(a, b) if n_grams >= least[j]}
            for row, item in sorted(pairs):
                first, last = found.first[row], found.stop[row] - width + 1
                n = self._contained(item, data, found, grams, first, last)
                if n >= self.threshold * len(self.shingles[item]) - 1e-9:
                    out.append(Hit(chunk.first + row, item, n))
        return out

    def _contained(self, item, data, found, grams, first, last) -> int:
        """How many of the item's shingles are in the text, by comparing the words."""
        wanted, width = self.shingles[item], self.widths[item]
        keys = np.array(sorted(wanted), dtype=np.uint64)
        own = grams[first:last]
        at = np.searchsorted(keys, own)
        at[at == len(keys)] = 0
        seen = set()
        for i in np.flatnonzero(keys[at] == own):
            key = int(own[i])
            if key not in seen and wanted[key] == _shingle(data, found, first + i, width):
                seen.add(key)
        return len(seen)


def _shingle(data, found, i, width) -> bytes:
    return b" ".join(
        data[a:b].tobytes()
        for a, b in zip(found.starts[i : i + width], found.ends[i : i + width], strict=True)
    )


def item_blocks(
    benchmark: DataFrame,
    id_column: str = "item_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> Iterator[Broadcast]:
    """Broadcast blocks of items, each collected, used and released before the next.

    The number of blocks follows the benchmark's size; items are dealt to them by hash, so
    that a block is about half of ``block_bytes``. An item longer than the whole bound
    makes its block so much larger.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_column).alias("item"), text_or_empty(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = 1 + 2 * total // block_bytes
    for number in range(n_blocks):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == number)
        rows = sorted(own.collect(), key=lambda r: (r["item"] is None, r["item"], r["text"]))
        if rows:
            block = ItemBlock([tuple(r) for r in rows], shingle_words, threshold)
            yield spark.sparkContext.broadcast(block)


def _find(block: Broadcast):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for batch in batches:
            hits = [h for chunk in text_chunks(batch, "text") for h in items.hits(chunk)]
            sizes = [len(items.shingles[h.item]) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([h.row for h in hits], pa.int64())),
                    pa.array([items.ids[h.item] for h in hits], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([h.found for h in hits], pa.int64()),
                ],
                names=["doc_id", "item_id", "n_shingles", "n_found"],
            )

    return find


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found, containment: each text that holds an item.

    Words are what stands between ASCII white space, A-Z lower-cased. n_shingles counts an
    item's distinct shingles of five words, n_found those in the text; the row is there
    when containment is 0.8 or more. An item of fewer words is one shingle, contained
    where its words stand in a row; an item without words, or null, is in no text, and a
    null text holds none. Repeated rows of either table give repeated rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    schema = "doc_id long, item_id long, n_shingles long, n_found long"
    parts = [rows.mapInArrow(_find(b), schema) for b in item_blocks(benchmark, **options)]
    found = (
        reduce(DataFrame.unionAll, parts)
        if parts
        else docs.sparkSession.createDataFrame([], schema)
    )
    return found.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", **options
) -> DataFrame:
    """The rows, all columns unchanged, whose text holds no benchmark item."""

    def keep(block: Broadcast):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = np.ones(batch.num_rows, dtype=bool)
                for chunk in text_chunks(batch, text):
                    mask[[h.row for h in block.value.hits(chunk)]] = False
                yield batch.filter(pa.array(mask))

        return clean

    for block in item_blocks(benchmark, **options):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs

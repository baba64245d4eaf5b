"""Exact de-duplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. All blocks are sorted,
and equal blocks get one integer as their name. Then adjacent names are paired, the pairs
sorted and named in turn, until one name is left for each text. Two texts with the same
number of blocks have the same last name exactly when they are equal: names stand for
content, not for a digest of it, so nothing can collide.

Sorting is by (hash, content, row), so that blocks of any one content, however many, are
spread over as many partitions as they fill. A content that runs over the border of two
partitions gets a name in each; the at most two contents at the ends of every partition
are compared afterwards, and the smallest of their names holds.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE, kept_rows, saved, text_or_empty

BLOCK_BYTES = 16384
NAMED = "doc_id long, rid long, pos int, n_blocks int, sha string, name long, block binary"
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("rid", pa.int64()),
        ("pos", pa.int32()),
        ("n_blocks", pa.int32()),
        ("sha", pa.string()),
        ("name", pa.int64()),
        ("block", pa.binary()),
    ]
)


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the distinct contents of one sorted partition.

    After the rows come those of the partition's ends: (name, block) without a row id.
    """
    base = TaskContext.get().partitionId() << 36
    next_name = base
    last_hash, last_block = None, None
    run: dict[bytes, int] = {}  # contents that share the present hash; nearly always one
    first_run: dict[bytes, int] | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        hashes = batch.column("h").to_numpy(zero_copy_only=False)
        blocks = batch.column("block")
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = pc.not_equal(blocks.slice(1), blocks.slice(0, n - 1)).to_numpy(
            zero_copy_only=False
        )
        fresh[0] = last_block is None or blocks[0].as_py() != last_block
        names = next_name - 1 + np.cumsum(fresh)
        next_name = int(names[-1]) + 1
        for i in np.flatnonzero(fresh):
            if last_hash is None or hashes[i] != last_hash:
                if last_hash is not None and first_run is None:
                    first_run = run
                run, last_hash = {}, hashes[i]
            last_block = blocks[int(i)].as_py()
            run[last_block] = int(names[i])
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "rid", "pos", "n_blocks", "sha")]
            + [pa.array(names, pa.int64()), pa.nulls(n, pa.binary())],
            schema=ARROW,
        )
    found = list(((first_run or {}) | run).items())
    if found:
        gap = [pa.nulls(len(found), ARROW.field(i).type) for i in range(5)]
        yield pa.RecordBatch.from_arrays(
            gap + [pa.array([v for _, v in found]), pa.array([k for k, _ in found], pa.binary())],
            schema=ARROW,
        )


def _named(occurrences: DataFrame) -> DataFrame:
    """Rows (doc_id, rid, pos, n_blocks, sha, block) with an integer name for the block."""
    keyed = occurrences.withColumn("h", F.xxhash64("block"))
    local = saved(
        keyed.repartitionByRange("h", "rid", "pos")
        .sortWithinPartitions("h", "block", "rid", "pos")
        .mapInArrow(_name_sorted, NAMED),
        "names",
    )
    ends = local.filter("rid IS NULL").select("name", "block")
    first = ends.groupBy("block").agg(F.min("name").alias("first_name"))
    # Two rows for each partition of the sort at most, but for hash collisions.
    renamed = ends.join(first, "block").filter("name <> first_name").select("name", "first_name")
    return (
        local.filter("rid IS NOT NULL")
        .drop("block")
        .join(F.broadcast(renamed), "name", "left")
        .withColumn("name", F.coalesce("first_name", "name"))
        .drop("first_name")
    )


def block_identities(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, rid, sha (of the normalised text), n_blocks, name; one row for each row.

    (n_blocks, name) is the text's identity and ``rid`` a number of the row. Runs of ASCII
    white space count as one space; a null text is empty and equals other empty texts.
    """
    normal = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("rid"),
        F.regexp_replace(text_or_empty(text), SPACE, " ").alias("norm"),
    )
    body = F.encode("norm", "UTF-8")
    cut = normal.select(
        "doc_id",
        "rid",
        body.alias("body"),
        F.sha2(body, 256).alias("sha"),
        F.greatest(F.lit(1), F.ceil(F.octet_length("norm") / block_bytes))
        .cast("int")
        .alias("n_blocks"),
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda i: F.substring("body", i * block_bytes + 1, F.lit(block_bytes)),
    )
    level = _named(
        cut.select("doc_id", "rid", "n_blocks", "sha", F.posexplode(pieces).alias("pos", "block"))
    )
    columns = ["doc_id", "rid", "n_blocks", "sha", "name"]
    level = saved(level.select("pos", *columns), "named")
    done = [level.filter("n_blocks = 1").select(columns)]
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    left = 2
    rest = level.filter("n_blocks > 1")
    while left < 2 * most:
        halves = rest.groupBy("rid", F.expr("pos div 2 AS half")).agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_blocks").alias("n_blocks"),
            F.max(F.expr("CASE WHEN pos = 0 THEN sha END")).alias("sha"),
            F.max(F.expr("CASE WHEN pos % 2 = 0 THEN name END")).alias("a"),
            F.max(F.expr("CASE WHEN pos % 2 = 1 THEN name END")).alias("b"),
        )
        pair = F.unhex(
            F.concat(
                F.lpad(F.hex("a"), 16, "0"), F.lpad(F.hex(F.coalesce("b", F.lit(-1))), 16, "0")
            )
        )
        level = saved(
            _named(
                halves.select(
                    "doc_id",
                    "rid",
                    F.col("half").cast("int").alias("pos"),
                    "n_blocks",
                    "sha",
                    pair.alias("block"),
                )
            ).select("pos", *columns),
            "pairs",
        )
        done.append(level.filter(f"n_blocks <= {left}").select(columns))
        rest = level.filter(f"n_blocks > {left}")
        left *= 2
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row for each row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest doc_id stays. A null doc_id counts as larger
    than any other; of rows with the same doc_id and equal texts exactly one stays. No
    rows give no rows. Other columns are not looked at.
    """
    rows = saved(block_identities(docs, id_column, text, block_bytes), "identities")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid"))
    groups = saved(
        rows.groupBy("n_blocks", "name")
        .agg(best.alias("best"), F.count("*").alias("group_size"))
        .filter("group_size > 1"),
        "groups",
    )
    joined = rows.join(groups, ["n_blocks", "name"], "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("best.rid") == F.col("rid"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows that stay, all columns unchanged, whatever their names.

    As in ``exact_duplicates``, null texts are empty and null ids the largest. Of rows that
    repeat an id and an equal text one stays, whichever comes first. No rows give no rows.
    """
    found = exact_duplicates(docs, id_column, text, **options).filter("kept")
    normal = F.regexp_replace(text_or_empty(text), SPACE, " ")
    digest = F.sha2(F.encode(normal, "UTF-8"), 256)
    return kept_rows(docs, found.select("doc_id", "text_sha256"), id_column, digest)

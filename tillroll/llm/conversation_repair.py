"""Cheapest repair of conversations to alternating turns, by a suffix-shared automaton.

Each message of a conversation becomes one symbol: its role class with its fault. The
symbols in order are the conversation's signature. Many conversations share a signature and
many more share an ending, so the distinct signatures are sorted by their reversed text and
merged from the end: a node of the automaton is one distinct ending, found once for all
signatures that share it. For each node and grammar state the automaton keeps the cost of
the cheapest edits to the end and the first of them; the edits of an ending are thus a chain
of nodes, shared by all conversations, and a signature's audit is read off along it.

The grammar of role initials is ``(s?(ua)+)?``. In every state each edit initial leads to
one next state only, so among edits of equal cost the least initial gives the least audit.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import saved, saved_at

#: Costs of the edits; a truncated message that stays costs as much as a new role.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Pairs of role initials that may follow each other.
LEGAL = frozenset({"su", "ua", "au"})
SPACE_CHARS = " \t\n\x0b\x0c\r"
END_CHARS = ".!?"

#: Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a new user or assistant message leads from each state.
NEXT = (USER, USER, ASSISTANT, USER)
#: Where a kept message leads: (state, role initial) to state.
KEPT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
#: Symbols: the role initial (o: any other), in upper case if truncated; x: must go.
MUST_GO = "x"

#: A node: for each state (cost, edit, whether the edit uses up a message, next state).
Node = tuple[tuple[int, str, bool, int], ...]
END: Node = (
    (0, "", False, START),
    (2 * INSERT, "I", False, USER),
    (INSERT, "I", False, ASSISTANT),
    (0, "", False, ASSISTANT),
)


def node_before(symbol: str, rest: Node) -> Node:
    """The node of an ending that starts with ``symbol`` and goes on as ``rest``."""
    role, stays = symbol.lower(), symbol != MUST_GO
    extra = TRUNCATED if symbol.isupper() else 0
    own = []
    for state in range(4):
        ways = [(rest[state][0] + DELETE, "D", True, state)]
        if stays:
            after = KEPT.get((state, role))
            if after is not None:
                ways.append((rest[after][0] + extra, "K", True, after))
            ways.append((rest[NEXT[state]][0] + extra + REROLE, "R", True, NEXT[state]))
        own.append(min(ways))
    # Two inserts in a row lead back, so one is enough after user or assistant.
    pair = {
        state: min(own[state], (own[NEXT[state]][0] + INSERT, "I", False, NEXT[state]))
        for state in (USER, ASSISTANT)
    }
    first = [min(own[s], (pair[USER][0] + INSERT, "I", False, USER)) for s in (START, SYSTEM)]
    return (*first, pair[USER], pair[ASSISTANT])


def audit(nodes: list[Node]) -> tuple[int, str]:
    """Cost and edits of a whole signature, given the nodes of all its endings."""
    left, state, edits = len(nodes) - 1, START, []
    cost = nodes[left][START][0]
    while True:
        _, edit, used, after = nodes[left][state]
        if not edit:
            return cost, "".join(edits)
        edits.append(edit)
        left, state = left - used, after


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of signatures sorted by their reversed text.

    Neighbours share the longest endings, so the nodes of the present signature are all that
    has to be held: those of its common ending with the last one stay, the rest are new.
    """
    before, nodes = "", [END]
    for batch in batches:
        costs, audits = [], []
        for backward in batch["backward"].to_pylist():
            shared = 0
            for one, other in zip(before, backward, strict=False):
                if one != other:
                    break
                shared += 1
            del nodes[shared + 1 :]
            for symbol in backward[shared:]:
                nodes.append(node_before(symbol, nodes[-1]))
            before = backward
            cost, edits = audit(nodes)
            costs.append(cost)
            audits.append(edits)
        yield pa.RecordBatch.from_arrays(
            [batch["signature"], pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["signature", "cost", "audit"],
        )


def signature_audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each distinct ``signature``.

    Signatures are dealt out by ranges of their reversed text, so those with a common ending
    meet in one task whatever their number.
    """
    return (
        signatures.select("signature")
        .distinct()
        .withColumn("backward", F.reverse("signature"))
        .repartitionByRange("backward")
        .sortWithinPartitions("backward")
        .mapInArrow(_audits, "signature string, cost bigint, audit string")
    )


def damaged(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv, turn, role, text, copies): messages with faults set by a checksum of their key.

    Of ``crc32("conv:turn") % 20``: 0 drops the message (``copies`` 0), 1 empties its text, 2
    takes the ends of sentences out, 3 repeats it (``copies`` 2), 4 makes it the user's. Nulls
    in the key, role and text count as one space. ``conv`` is a struct, so that a null id
    groups and joins like any other.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat_ws(":", spaced(conv), spaced(turn)).cast("binary")) % 20
    changed = (
        F.when(code == 1, F.lit(""))
        .when(code == 2, F.translate(spaced(text), END_CHARS, ""))
        .otherwise(spaced(text))
    )
    return conversations.select(
        F.struct(F.col(conv).alias("id")).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(spaced(role)).alias("role"),
        changed.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _ordered(rows: DataFrame, *lead: str) -> DataFrame:
    """Each conversation in one task, its messages by turn, then by role and digest."""
    order = [F.asc_nulls_first(c) for c in (*lead, "turn", "role", "digest")]
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def _marks(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, copies, symbol): one row for all copies of a message.

    Copies are combined before the shuffle. Of the copies of a role and text the first at
    the earliest turn is the one that is no duplicate; ``symbol`` is its symbol, and that of
    a later turn is ``x``. ``blank`` tells blank messages. A conversation whose messages were
    all dropped keeps one row without copies.
    """
    there = F.col("copies") > 0
    stripped = F.rtrim("text", F.lit(SPACE_CHARS))
    closed = F.instr(F.lit(END_CHARS), F.right(stripped, F.lit(1))) > 0
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    each = rows.select(
        "conv",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).otherwise("").alias("role"),
        F.when(there, F.unhex(F.md5("text"))).otherwise(F.lit(b"")).alias("digest"),
        (there & (stripped == "")).alias("blank"),
        F.when(closed, known).otherwise(F.upper(known)).alias("symbol"),
        "copies",
    )
    by = ["conv", "turn", "role", "digest", "blank"]
    groups = each.groupBy(*by).agg(F.sum("copies").alias("copies"), F.max("symbol").alias("symbol"))
    same = W.partitionBy("conv", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    goes = F.col("blank") | (F.row_number().over(same) > 1)
    return groups.withColumn("symbol", F.when(goes, MUST_GO).otherwise(F.col("symbol")))


class _Summary:
    """What is counted along one conversation."""

    def __init__(self, conv):
        self.conv, self.signature, self.initial = conv, [], None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns = 0

    def add(self, row: dict) -> None:
        copies, symbol = row["copies"], row["symbol"]
        if not copies:
            return
        self.signature.append(symbol + MUST_GO * (copies - 1))
        if row["blank"]:
            self.blank += copies
        else:
            self.duplicate += copies - (symbol != MUST_GO)
            self.truncated += symbol.isupper()
        initial = row["role"][:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL
        self.illegal += copies - 1  # a role never follows itself
        self.initial = initial
        if row["turn"] is not None:
            self.low = row["turn"] if self.low is None else self.low
            self.turns += row["turn"] != self.high
            self.high = row["turn"]

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [gaps, self.blank, self.duplicate, self.truncated, self.illegal]
        return self.conv, counts, "".join(self.signature)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, kind = None, None
    for batch in batches:
        kind, done = batch.schema.field("conv").type, []
        for row in batch.to_pylist():
            if now is None or now.conv != row["conv"]:
                if now is not None:
                    done.append(now.row())
                now = _Summary(row["conv"])
            now.add(row)
        yield _summary_batch(done, kind)
    if now is not None:
        yield _summary_batch([now.row()], kind)


def _summary_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    convs, counts, signatures = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(convs, kind), pa.array(counts, pa.list_(pa.int64())), pa.array(signatures, pa.string())],
        ["conv", "counts", "signature"],
    )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of conversations whose first row is their audit, after its edits."""
    audit, at, state, place = "", 0, START, 0

    def emit(edit: str, after: int, role: str, text: str) -> None:
        nonlocal state, place
        state, place = after, place + 1
        out.append((conv, place, edit, role, text))

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            emit("I", NEXT[state], NEW_ROLE[NEXT[state]], "")
            at += 1

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            conv, role, text = row["conv"], row["role"], row["text"]
            if row["audit"] is not None:
                audit, at, state, place = row["audit"], 0, START, 0
                insert()
                continue
            for _ in range(row["copies"]):
                edit = audit[at]
                at += 1
                if edit == "K":
                    emit(edit, KEPT[state, role[:1]], role, text)
                elif edit == "R":
                    emit(edit, NEXT[state], NEW_ROLE[NEXT[state]], text)
                insert()
        kinds = batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()
        columns = zip(*out, strict=True) if out else ((),) * 5
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["conv", "place", "edit", "role", "text"])


NEW_ROLE = {USER: "user", ASSISTANT: "assistant"}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's messages, which follow each other."""
    conv, digest, kind = None, None, None

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        convs, found = zip(*done, strict=True) if done else ((), ())
        arrays = [pa.array(convs, kind), pa.array(found, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["conv", "repaired_sha256"])

    for batch in batches:
        kind, done = batch.schema.field("conv").type, []
        for row in batch.to_pylist():
            if row["place"] == 1:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = row["conv"], hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{row['role']}:{row['text']}".encode())
        yield batch_of(done)
    if digest is not None:
        yield batch_of([(conv, digest.hexdigest())])


def plans(rows: DataFrame) -> DataFrame:
    """(conv, counts, cost, audit) of messages as ``damaged`` returns them."""
    types = {c: rows.schema[c].dataType.simpleString() for c in ("conv",)}
    summaries = saved(
        _ordered(_marks(rows)).mapInArrow(
            _summaries, f"conv {types['conv']}, counts array<bigint>, signature string"
        ),
        "summaries",
    )
    # Adaptive execution splits a signature that very many conversations share.
    audits = signature_audits(summaries)
    return summaries.join(audits, "signature").select("conv", "counts", "cost", "audit")


def edited_messages(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): messages after the edits of their audit, in order.

    A conversation's rows stand together and by place in their partition. A task holds one
    batch of messages and one audit at a time, whatever the length of a conversation.
    """
    conv = rows.schema["conv"].dataType.simpleString()
    messages = rows.where("copies > 0").select(
        "conv",
        F.lit(None).cast("string").alias("audit"),
        "turn",
        "role",
        F.unhex(F.md5("text")).alias("digest"),
        "text",
        "copies",
    )
    lead = plan.select(
        "conv",
        "audit",
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("copies"),
    )
    both = lead.unionByName(messages).withColumn("late", F.col("audit").isNull())
    return _ordered(both, "late").mapInArrow(
        _edited, f"conv {conv}, place bigint, edit string, role string, text string"
    )


def repair_report(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Faults, cheapest repair and digest of each conversation after ``damaged``.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A
    message's first fault counts: blank, duplicate (role and text seen earlier in the
    conversation), truncated (no end of sentence). Messages go by turn, nulls first; those
    of one turn by role and by the MD5 digest of their text, so that copies are adjacent.
    Every id that came in comes out, also where all messages were dropped (zeros, an empty
    audit, the digest of the empty text); rows without an id are one conversation. Columns
    other than the four are not read. No rows give no rows.

    SHA-256 runs over a whole conversation in order, so a conversation streams through one
    task; what is held there is its audit, a byte or so for each message, never its texts.
    """
    rows = damaged(conversations, conv, turn, role, text)
    id_type = rows.schema["conv"].dataType.simpleString()
    plan, _ = saved_at(plans(rows), "repairs")
    digests = edited_messages(rows, plan).mapInArrow(
        _digests, f"conv {id_type}, repaired_sha256 string"
    )
    names = ("gaps", "blank", "duplicate", "truncated", "illegal")
    return plan.join(digests, "conv", "left").select(
        F.col("conv.id").alias(conv),
        *(F.col("counts")[i].alias(name) for i, name in enumerate(names)),
        "cost",
        "audit",
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

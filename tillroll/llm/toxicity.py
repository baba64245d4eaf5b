"""Toxicity of texts whose writers hide the words: "1d10t", "i d i o t", "iiidiot".

A hidden word is what a noisy channel made of a plain one: letters became look-alike
signs, were repeated, or were set apart. All plain words it may come from form a lattice of
characters, and Viterbi decoding under a character trigram model finds the likeliest. The
restored text is scored with terms learned from labelled documents.

The character model counts all documents. The terms are learned from a bounded sample of
the labelled ones (``sample_rows``), the only part of the operator that samples.
"""

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import (
    BASE,
    IS_SPACE,
    Chunk,
    Spans,
    mix,
    row_of,
    span_hashes,
    text_chunks,
    words,
)
from tillroll.llm.common import saved, text_or_empty

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7)
#: A term's fewest different contexts in toxic sample documents, its least share of toxic
#: documents, and the fewest contexts for each document: in copies a term has always the same.
LEAST_SUPPORT = 5
LEAST_PRECISION = 0.9
LEAST_VARIETY = 0.5
#: Share of the learned terms in the character model, the rest is the corpus.
TERM_SHARE = 0.3

# Letters a sign may stand for. An asterisk may hide any plain letter.
LOOKALIKES = {
    "0": "o",
    "1": "il",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "*": "abcdefghijklmnopqrstuvwxyz",
}
#: Channel costs, as negative log probabilities.
LOOKALIKE_COST, WILDCARD_COST, REPEAT_COST = 0.7, 3.3, 1.0

# Letters the character model knows: a-z and the lower-case letters of Latin-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}  # 0 is a word's border
SIZE = len(LETTERS) + 1

IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[ord("a") : ord("z") + 1] = IS_LETTER[0x80:] = True
IS_CORE = IS_LETTER.copy()
IS_CORE[ord("0") : ord("9") + 1] = True
IS_HEAD = IS_CORE.copy()  # a word may also begin with these
IS_HEAD[[ord("$"), ord("@")]] = True
ASCII_CODE = np.zeros(256, dtype=np.int64)
LATIN_CODE = np.zeros(256, dtype=np.int64)
for _letter, _code in CODE.items():
    _bytes = _letter.encode()
    (ASCII_CODE if len(_bytes) == 1 else LATIN_CODE)[_bytes[-1]] = _code
#: Restored words a Python worker remembers; it starts afresh beyond.
MEMORY_WORDS = 100_000
#: Bytes of the chunks of texts here. A word's terms and whole-number arrays over a chunk take
#: some hundred times its size, in each of an executor's Python workers.
CHUNK_BYTES = 256 << 10


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals in UTF-8 as small letters; the length stays."""
    out = data.copy()
    out[(data >= ord("A")) & (data <= ord("Z"))] += 32
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 32
    return out


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


# Character model


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE**3, dtype=np.int64)
    for batch in batches:
        for chunk in text_chunks(batch, "text", CHUNK_BYTES):
            data = lowered(chunk.data)
            codes = ASCII_CODE[data]
            codes[1:][data[:-1] == 0xC3] = LATIN_CODE[data[1:]][data[:-1] == 0xC3]
            kept = (data & 0xC0) != 0x80
            kept[1:] |= data[:-1] == 0xC3
            kept &= data != 0xC3
            # Two borders before each text, and one after.
            at = np.concatenate([[0], np.cumsum(kept)])[chunk.starts]
            codes = np.insert(codes[kept], np.repeat(at, 2), 0)
            codes = np.concatenate([codes, [0]])
            total += np.bincount(
                (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3
            )
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["gram", "n"]
    )


def corpus_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Letter trigram counts of all texts, as a cube of fixed size."""
    rows = docs.select(text_or_empty(text).alias("text"))
    counted = rows.mapInArrow(_count_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    cube = np.zeros(SIZE**3, dtype=np.float64)
    for row in counted.collect():  # SIZE**3 rows at most
        cube[row["gram"]] = row["n"]
    return cube.reshape(SIZE, SIZE, SIZE)


def _conditional(cube: np.ndarray) -> np.ndarray:
    """P(third letter | first two), interpolated with shorter contexts."""
    cube = cube.copy()
    cube[:, 0, 0] = 0  # between words
    bi, uni = cube.sum(0), cube.sum((0, 1))
    share = lambda x: x / np.maximum(x.sum(-1, keepdims=True), 1)
    return 0.7 * share(cube) + 0.2 * share(bi)[None] + 0.09 * share(uni)[None, None] + 0.01 / SIZE


def character_costs(corpus: np.ndarray, terms: list[str]) -> np.ndarray:
    """Negative log P of a letter after two others: mostly the corpus, partly the terms."""
    own = np.zeros((SIZE, SIZE, SIZE))
    for term in terms:
        codes = [0, 0, *(CODE.get(c, 0) for c in term), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            own[a, b, c] += 1
    p = (1 - TERM_SHARE) * _conditional(corpus) + TERM_SHARE * _conditional(own)
    return -np.log(p).astype(np.float32)


# Channel and decoding


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """What each run of equal characters may stand for, with the channel's cost."""
    units = []
    i = 0
    while i < len(word):
        j = i
        while j < len(word) and word[j] == word[i]:
            j += 1
        sign, n = word[i], j - i
        i = j
        if sign in CODE:
            options = [(sign, {1: 0.0, 2: 2 * REPEAT_COST}.get(n, REPEAT_COST))]
            if n > 1:
                options.append((sign * 2, 0.0 if n == 2 else REPEAT_COST))
        elif sign in LOOKALIKES:
            cost = WILDCARD_COST if sign == "*" else LOOKALIKE_COST
            options = [(c, cost) for c in LOOKALIKES[sign]]
            if n > 1:
                options += [(c * 2, cost * 2) for c in LOOKALIKES[sign]]
        else:
            options = [("", 0.0)]  # what sets letters apart
        units.append(options)
    return units


def restored(word: str, costs: np.ndarray) -> str:
    """The likeliest plain word, by Viterbi decoding of the lattice."""
    states = {(0, 0): (0.0, None)}  # last two letters: cost, chain of what was put out
    for options in lattice(word):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, chain) in states.items():
            for letters, price in options:
                x, y, total = a, b, cost + price
                for letter in letters:
                    z = CODE[letter]
                    total += costs[x, y, z]
                    x, y = y, z
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (letters, chain) if letters else chain)
        states = after
    end = min(states, key=lambda s: (states[s][0] + costs[s[0], s[1], 0], s))
    out, chain = [], states[end][1]
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return "".join(reversed(out))


# Terms


@dataclass
class Tokens:
    """Runs of letters of a chunk, and what looks like a hidden word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    odd: list[tuple[int, str, bool]] = field(default_factory=list)  # row, word, set apart


def tokens(chunk: Chunk) -> Tokens:
    data = lowered(chunk.data)
    letter = IS_LETTER[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    begins = chunk.starts[chunk.starts < chunk.ends]
    first[begins] = letter[begins]
    lasts = chunk.ends[chunk.starts < chunk.ends] - 1
    last[lasts] = letter[lasts]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(chunk.ends, starts, side="right")
    out = Tokens(data, starts, ends, rows)

    found = words(chunk, data)
    if not len(found.starts):
        return out
    core = np.concatenate([[0], np.cumsum(IS_CORE[data])])
    has = core[found.ends] > core[found.starts]
    if not has.any():
        return out
    heads = np.flatnonzero(IS_HEAD[data])
    head = np.concatenate([[0], np.cumsum(IS_HEAD[data])])[found.starts]
    begin = heads[np.minimum(head, len(heads) - 1)]
    end = np.flatnonzero(IS_CORE[data])[core[found.ends] - 1] + 1
    letters = np.concatenate([[0], np.cumsum(letter)])
    triple = np.zeros(len(data), dtype=np.int64)
    ascii_letter = letter & (data < 0x80)
    triple[2:] = ascii_letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    if len(data) > 5:  # the same for letters of two bytes
        twin = (data[5:] == data[3:-2]) & (data[3:-2] == data[1:-4]) & (data[4:-1] == data[2:-3])
        triple[5:] |= twin & (data[2:-3] == data[:-5]) & (data[5:] >= 0x80) & (data[4:-1] >= 0xC0)
    triples = np.concatenate([[0], np.cumsum(triple)])
    n_letters = letters[end * has] - letters[begin * has]
    third = np.minimum(begin + 2, end)  # the last word may be shorter than a triple
    odd = has & (n_letters > 0) & ((n_letters < end - begin) | (triples[end * has] > triples[third * has]))
    row = row_of(found.first, found.stop)
    for i in np.flatnonzero(odd):
        out.odd.append((int(row[i]), data[begin[i] : end[i]].tobytes().decode(errors="replace"), False))
    # Three or more words of one character in a row.
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    single = (chars[found.ends] - chars[found.starts] == 1) & ~IS_SPACE[data[found.starts]]
    edge = np.concatenate([[True], row[1:] != row[:-1]]) | np.concatenate([[True], single[1:] != single[:-1]])
    at = np.flatnonzero(edge)
    for i, j in zip(at, [*at[1:], len(single)], strict=True):
        if j - i >= 3 and single[i]:
            word = b"".join(
                data[a:b].tobytes() for a, b in zip(found.starts[i:j], found.ends[i:j], strict=True)
            )
            out.odd.append((int(row[i]), word.decode(errors="replace"), True))
    return out


def _prefix_ends(found: Tokens, n: int) -> np.ndarray:
    """Where the first n characters of each run of letters end; 0 if it has no more."""
    heads = np.flatnonzero((found.data & 0xC0) != 0x80)
    number = np.searchsorted(heads, found.starts) + n
    end = np.where(number < len(heads), heads[np.minimum(number, len(heads) - 1)], 0)
    return np.where(end < found.ends, end, 0)


@dataclass
class Model:
    """Learned terms; a term is a word, or with a trailing hyphen how words begin."""

    terms: list[str]
    weights: list[float]  # log of one minus a term's share of toxic documents
    base: float
    costs: np.ndarray

    def __post_init__(self):
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.tables = {}
        for size in (0, *PREFIXES):
            own = [t for t in self.terms if (len(t) - 1 == size if t.endswith("-") else size == 0)]
            plain = [t.rstrip("-").encode() for t in own]
            ends = np.cumsum([len(t) for t in plain], dtype=np.int64)
            data = np.frombuffer(b"".join(plain), dtype=np.uint8)
            hashes = span_hashes(data, ends - [len(t) for t in plain], ends) if own else []
            order = np.argsort(np.asarray(hashes, dtype=np.uint64))
            self.tables[size] = (
                np.asarray(hashes, dtype=np.uint64)[order],
                np.array([self.number[t] for t in own], dtype=np.int64)[order],
            )
        self.memory: dict[tuple[str, bool], tuple[int, ...]] = {}

    def matches(self, word: str, anywhere: bool) -> tuple[int, ...]:
        """Terms in what a hidden word is restored to."""
        key = (word, anywhere)
        if key not in self.memory:
            if len(self.memory) > MEMORY_WORDS:
                self.memory.clear()
            plain = restored(word, self.costs)
            found = set()
            for i in range(len(plain) if anywhere else 1):
                rest = plain[i:]
                found |= {self.number.get(rest[:n] + "-") for n in PREFIXES if len(rest) > n}
                found |= {self.number.get(rest)}
                if anywhere:
                    longest = max(map(len, self.terms), default=0)
                    found |= {self.number.get(rest[:n]) for n in range(4, longest + 1)}
            self.memory[key] = tuple(sorted(found - {None}))
        return self.memory[key]

    def scores(self, chunk: Chunk) -> np.ndarray:
        found = tokens(chunk)
        pairs = [np.zeros(0, dtype=np.int64)]
        spans = Spans(found.data)
        for size, (hashes, numbers) in self.tables.items():
            if not len(hashes):
                continue
            ends = _prefix_ends(found, size) if size else found.ends
            kept = np.flatnonzero(ends)
            own = spans.hashes(found.starts[kept], ends[kept])
            at = np.searchsorted(hashes, own)
            at[at == len(hashes)] = 0
            hit = hashes[at] == own
            pairs.append(found.rows[kept[hit]] * len(self.terms) + numbers[at[hit]])
        hidden = [r * len(self.terms) + t for r, w, apart in found.odd for t in self.matches(w, apart)]
        pairs = np.unique(np.concatenate([*pairs, np.array(hidden, dtype=np.int64)]))
        total = np.full(len(chunk.starts), math.log1p(-self.base))
        if len(pairs):
            np.add.at(total, pairs // len(self.terms), np.array(self.weights)[pairs % len(self.terms)])
        return -np.expm1(total)


def _sample_terms(only: set[str] | None):
    """Function for mapInArrow: (n, text) to (n, term, context), each term once a row.

    The context is a number for the words before and after the term's first place.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES):
                found = tokens(chunk)
                body = found.data.tobytes()
                own = Spans(found.data).hashes(found.starts, found.ends)
                border = np.array([0], dtype=np.uint64)
                before, after = np.concatenate([border, own])[:-1], np.concatenate([own, border])[1:]
                contexts = mix(before * BASE ^ after).astype(np.int64)
                terms: dict[tuple[int, str], int] = {}
                for a, b, row, context in zip(
                    found.starts, found.ends, found.rows, contexts, strict=True
                ):
                    word = body[a:b].decode(errors="replace")
                    for term in (word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)):
                        if only is None or term in only:
                            terms.setdefault((row, term), context)
                at = pa.array([chunk.first + row for row, _ in terms], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("n").take(at),
                        pa.array([term for _, term in terms], pa.string()),
                        pa.array(list(terms.values()), pa.int64()),
                    ],
                    names=["n", "term", "context"],
                )

    return find


def _most_telling(support: dict[str, int]) -> list[str]:
    """Of terms of which one begins with the other, the longest that is as frequent."""
    roots: dict[str, str] = {}
    for term in sorted(support, key=lambda t: (len(t.rstrip("-")), not t.endswith("-"), t)):
        word = term.rstrip("-")
        root = next((roots[word[:n]] for n in PREFIXES if word[:n] in roots), None)
        if root is None:
            roots[word] = term
        elif support[term] >= 0.98 * support[root]:
            roots[next(word[:n] for n in PREFIXES if word[:n] in roots)] = term
    return sorted(set(roots.values()))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn terms from at most ``sample_rows`` labelled rows that are not held out.

    A term is learned if it stands in enough different contexts in toxic documents and
    hardly ever in others; the words that only copies of one document share have the same
    context in each. A document with several labels is toxic if any says so; null labels are left out.
    """
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("label_id").isNotNull())
        .filter(~is_held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Random but repeatable; what goes through the driver here is bounded by sample_rows.
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)
    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("text"))
    sample = saved(
        rows.join(chosen, F.col("doc_id") == F.col("label_id"))
        .select(F.monotonically_increasing_id().alias("n"), "toxic", "text"),
        "toxic-sample",
    )
    schema = "n long, term string, context long"
    toxic, clean = sample.filter("toxic = 1"), sample.filter("toxic = 0")
    frequent = (
        toxic.mapInArrow(_sample_terms(None), schema)
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.count_distinct("context").alias("contexts"))
        .filter((F.col("contexts") >= LEAST_SUPPORT) & (F.length("term") > 2))
        .filter(F.col("contexts") >= LEAST_VARIETY * F.col("n"))
    )
    n_toxic = {row["term"]: row["n"] for row in frequent.collect()}
    known = (
        clean.mapInArrow(_sample_terms(set(n_toxic)), schema)
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    n_clean = {row["term"]: row["n"] for row in known.collect()}

    def share(term: str) -> float:
        return (n_toxic[term] + 0.5) / (n_toxic[term] + n_clean.get(term, 0) + 1)

    terms = _most_telling({t: n for t, n in n_toxic.items() if share(t) >= LEAST_PRECISION})
    counts = dict(sample.groupBy("toxic").count().collect())
    covered = toxic.mapInArrow(_sample_terms(set(terms)), schema).agg(F.count_distinct("n"))
    left = counts.get(1, 0) - covered.first()[0]
    base = (left + 0.5) / (left + counts.get(0, 0) + 10)
    weights = [math.log1p(-share(t)) for t in terms]
    costs = character_costs(corpus_trigrams(docs, text), [t.rstrip("-") for t in terms])
    return Model(terms, weights, min(base, 0.25), costs)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """doc_id, held_out, score, predicted; one row for each row.

    Rows whose crc32(doc_id as text) modulo 4 is 2 are held out: their labels are not
    used. A score depends on the text alone; an empty or null text has the share of toxic
    documents among those without a learned term. Without labels that is every score.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, labels, id_column, text, **options))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.scores(chunk) for chunk in text_chunks(batch, "text", CHUNK_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate([[], *parts]), pa.float64())],
                names=["doc_id", "score"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    scored = rows.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows, all columns unchanged, whose score is below the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text=text, **options))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.scores(chunk) for chunk in text_chunks(batch, text, CHUNK_BYTES)]
            yield batch.filter(pa.array(np.concatenate([[], *parts]) < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)

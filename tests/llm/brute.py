"""Plain versions of the operators, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _covered(rows, sequences, window):
    """For each row the covered places, by the smallest document of every window."""
    lowest = {}
    for (doc_id, _), seq in zip(rows, sequences, strict=True):
        doc = float("inf") if doc_id is None else doc_id
        for i in range(len(seq) - window + 1):
            key = seq[i : i + window]
            lowest[key] = min(lowest.get(key, doc), doc)
    for (doc_id, _), seq in zip(rows, sequences, strict=True):
        doc = float("inf") if doc_id is None else doc_id
        gone = [False] * len(seq)
        for i in range(len(seq) - window + 1):
            if lowest[seq[i : i + window]] < doc:
                gone[i : i + window] = [True] * window
        yield gone


def byte_repeats(rows, window=50):
    texts = [(text or "").encode() for _, text in rows]
    for (doc_id, _), text, gone in zip(rows, texts, _covered(rows, texts, window), strict=True):
        left = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        yield doc_id, len(text), sum(gone), runs, hashlib.sha256(left).hexdigest()


def word_repeats(rows, window=13):
    texts = [tuple(WORD.findall(text or "")) for _, text in rows]
    for (doc_id, _), text, gone in zip(rows, texts, _covered(rows, texts, window), strict=True):
        left = " ".join(w for w, g in zip(text, gone, strict=True) if not g)
        yield doc_id, len(text), sum(gone), hashlib.sha256(left.encode()).hexdigest()


def jaccard(rows, n=3):
    """doc_id, n_shingles, component_id."""
    sets = []
    for _, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = tuple(WORD.findall(lower))
        sets.append({w[i : i + n] for i in range(len(w) - n + 1)} or ({w} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                x, y = root(i), root(j)
                if rows[x][0] > rows[y][0]:
                    x, y = y, x
                parent[y] = x
    for i, (doc_id, _) in enumerate(rows):
        yield doc_id, len(sets[i]), rows[root(i)][0]


def backoff(rows, order=3, alpha=0.4, unseen=0.5, train=None):
    """doc_id, n_words, score of each row by the model of ``train``, or of all other rows."""
    from collections import Counter
    from math import log

    def split(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return tuple(WORD.findall(lower))

    def counted(w):
        return Counter(w[i : i + k] for k in range(1, order + 1) for i in range(len(w) - k + 1))

    texts = [split(text) for _, text in rows]
    learned = texts if train is None else [split(text) for _, text in train]
    full = sum(map(counted, learned), Counter())
    n_all = sum(map(len, learned))
    for (doc_id, _), w in zip(rows, texts, strict=True):
        mine = counted(w) if train is None else Counter()
        score = 0.0
        for i in range(len(w)):
            for k in range(min(order, i + 1), 0, -1):
                g = w[i + 1 - k : i + 1]
                count = full[g] - mine[g]
                past = full[g[:-1]] - mine[g[:-1]] if k > 1 else n_all - (len(w) if train is None else 0)
                if k == 1:
                    count, past = max(count, unseen), max(past, 1)
                if count > 0 and past > 0:
                    score += log(count / past) + log(alpha) * (order - k)
                    break
        yield doc_id, len(w), score


SPACES = " \t\n\x0b\x0c\r"


def repeated_lines(rows, min_length=40, min_docs=5):
    """doc_id, n_lines, n_dropped, digest; a null id is one document, the smallest."""
    small = (False, 0)

    def rank(doc_id):
        return small if doc_id is None else (True, doc_id)

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))

    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(rank(doc_id))
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(key(line)) < min_length
            or len(holders[key(line)]) < min_docs
            or max(holders[key(line)]) == rank(doc_id)
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        yield doc_id, len(lines), len(lines) - len(kept), digest


def cheapest_edits(messages, kinds):
    """Cost, edits and repaired messages: the first complete text, by cost and then by text.

    A heap of (cost, edits so far), so the first that uses up all messages and leaves roles
    of the grammar is the least of all.
    """
    from heapq import heappop, heappush

    heap = [(0, "", 0, "", ())]
    while True:
        cost, edits, i, roles, repaired = heappop(heap)
        if i == len(messages) and (not roles or roles[-1] == "a"):
            return cost, edits, repaired

        def follow(more, edit, j, role, text):
            initial = role[:1]
            if initial and initial in {"": "su", "s": "u", "u": "a", "a": "u"}[roles[-1:]]:
                heappush(heap, (cost + more, edits + edit, j, roles + initial, (*repaired, f"{role}:{text}")))

        if edits.endswith("III"):  # two already give any role
            continue
        for role in ("user", "assistant"):
            follow(3, "I", i, role, "")
        if i < len(messages):
            heappush(heap, (cost + 4, edits + "D", i + 1, roles, repaired))
            if kinds[i] not in ("blank", "duplicate"):
                late = 3 if kinds[i] == "truncated" else 0
                follow(late, "K", i + 1, messages[i][1], messages[i][4])
                for role in ("user", "assistant"):
                    follow(3 + late, "R", i + 1, role, messages[i][4])


def conversations(rows):
    """The report of each conversation, its edits by a search of whole edit texts."""
    from zlib import crc32

    after = {}
    for conv, turn, role, text in rows:
        spaced = [" " if x is None else x for x in (conv, turn, role, text)]
        code = crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role = "user" if code == 4 else spaced[2]
        text = "" if code == 1 else re.sub("[.!?]", "", spaced[3]) if code == 2 else spaced[3]
        digest = hashlib.md5(text.encode()).digest()
        messages = after.setdefault(conv, [])
        copies = 0 if code == 0 else 2 if code == 3 else 1
        messages += [((turn is not None, turn or 0), role, digest, turn, text)] * copies
    for conv, messages in after.items():
        messages.sort(key=lambda m: m[:3])
        seen, kinds = set(), []
        for _, role, _, _, text in messages:
            bare = text.rstrip(SPACES)
            kinds.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else
                "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        initials = [m[1][:1] for m in messages]

        cost, audit, repaired = cheapest_edits(messages, kinds)
        turns = [m[3] for m in messages if m[3] is not None]
        pairs = [a + b for a, b in zip(initials, initials[1:], strict=False)]
        yield (
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            kinds.count("blank"),
            kinds.count("duplicate"),
            kinds.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )


def packing(lengths, bounds, budget):
    """(doc_id, n_tokens, bucket_len, batch_id, slot) of rows (doc_id, n_tokens), given the bounds."""
    out = []
    for low, high in zip([-1, 0, *bounds], [0, *bounds]):
        own = sorted((n, i) for i, n in lengths if low < n <= high)
        size = max(1, budget // max(1, high))
        out += [(i, n, high, f"{high}-{k // size}", k % size) for k, (n, i) in enumerate(own)]
    return out


def least_padded(lengths, n_buckets):
    """The least sum of padded lengths, by trying every beginning of every bucket."""
    tops = sorted(set(lengths) - {0})
    count = [sum(x <= top for x in lengths if x) for top in tops]
    cost = [top * n for top, n in zip(tops, count)]
    for _ in range(n_buckets - 1):
        cost = [
            min([cost[j]] + [cost[i] + tops[j] * (count[j] - count[i]) for i in range(j)])
            for j in range(len(tops))
        ]
    return cost[-1]

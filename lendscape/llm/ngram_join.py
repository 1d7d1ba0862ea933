"""Self-join of documents on the Jaccard similarity of their word n-grams, by T-occurrence search.

Two sets of sizes n and m are linked when 100 * overlap >= 80 * union, that is when they share
at least T(n, m) shingles. Seen as a search: a document's shingles name inverted lists of the
documents holding them, and those occurring on T lists are its partners. DivideSkip leaves the
long lists out of the merge: with L of them left out, a partner must still occur T - L times on
the short ones.

1. Shingles are counted (in 32-bit classes, so a count is never too low). Those of at least
   ``LONG`` documents are long lists; at most ``MOST_LONG`` of the most frequent are remembered,
   which decides an order of shingles, never a result. Tasks count before they send, so a shingle
   of every document is one number of each task.
2. Each document puts its first n - T(n) + 1 shingles, short lists first, into inverted lists;
   the rest are the L lists left out. Equal sets are put there once.
3. Each document's short lists are merged by a heap and partners occurring at least T - L times
   are kept. No list is expanded into more than LONG**2 / 2 pairs: the documents of a list of
   ``LONG`` or more entries that was not remembered are crowded. They are searched among
   themselves once more, their shingles counted exactly and ordered by count, so that a list
   enters a prefix only after all rarer shingles of the document; its long lists join step 4.
4. Long lists are not expanded into pairs. First each entry meets the one with most long lists;
   after linked documents have been joined, a list whose entries all lie in one component needs
   nothing more, and of any other list only entries outside its largest component meet those
   of other components.
5. A candidate is verified by probing the partner's sorted set for the lists left out of the
   merge, with exact integers. Candidates that already share a component are not verified.

Documents are linked to their component's smallest id; equal sets are members of their class.

* NULL or empty text, or only white space: the empty set, linked with nothing.
* Fewer than five words: the whole sequence is the only shingle.
* Repeated rows: one result row each. NULL ids: component NULL, never linked.
* Shingles are compared by 64-bit hashes, sets by 128 bits.
* An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A
from lendscape.llm.components import components

WORDS = 5
SIMILAR = 80  # percent
LONG = 64
MOST_LONG = 1_000_000
# Tokens a task counts before it hands them on.
FLUSH = 4_000_000

_MULTIPLIERS = A.mix(np.arange(101, 102 + WORDS, dtype=np.uint64)) | np.uint64(1)


def least_overlap(n, m, percent: int = SIMILAR):
    """Smallest shared count at which 100 * shared >= percent * (n + m - shared)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n, percent: int = SIMILAR):
    """Shingles of a set of n of which any linked set shares at least one, in a common order."""
    return n - -(-percent * n // 100) + 1


def shingles(array: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and where each begins."""
    data, offsets = A.buffer_of(array)
    data = A.LOWER[data]
    starts, ends, first = A.spans(data, offsets, A.NOT_SPACE)
    h = A.hash_spans(data, starts, ends)
    n = len(h)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    keys, owners = [], []
    if n >= words:
        key = sum(h[i : n - words + 1 + i] * _MULTIPLIERS[i] for i in range(words))
        whole = owner[: n - words + 1] == owner[words - 1 :]
        keys.append(key[whole])
        owners.append(owner[: n - words + 1][whole])
    few = np.flatnonzero((counts > 0) & (counts < words))
    if len(few):
        key = np.zeros(len(few), np.uint64)
        for i in range(words - 1):
            has = counts[few] > i
            key[has] += h[first[few[has]] + i] * _MULTIPLIERS[i]
        keys.append(key + counts[few].astype(np.uint64) * _MULTIPLIERS[words])
        owners.append(few)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    key, owner = A.mix(np.concatenate(keys)), np.concatenate(owners)
    order = np.lexsort((key, owner)) if len(few) else _by_owner(key, owner, len(counts))
    key, owner = key[order], owner[order]
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return key[keep], np.searchsorted(owner[keep], np.arange(len(counts) + 1))


def _by_owner(key: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Order by (owner, key) where owners are ascending already: each text is sorted alone."""
    cuts = np.searchsorted(owner, np.arange(n + 1))
    out = np.empty(len(key), np.int64)
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = a + np.argsort(key[a:b])
    return out


def set_key(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set, equal for equal sets."""
    sums = np.zeros(len(sets) + 1, np.uint64)
    out = []
    for salt in (np.uint64(11), np.uint64(13)):
        np.cumsum(A.mix(sets + salt), out=sums[1:])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _class32(sets: np.ndarray) -> np.ndarray:
    return (sets >> np.uint64(32)).astype(np.uint32)


def long_lists(texts: DataFrame, parts: int, long: int, most: int) -> np.ndarray:
    """Sorted 32-bit classes of the most frequent shingles (at least ``long`` documents).

    Tasks send each range of classes as sorted differences, two bytes each where they fit, and
    the counts of classes that they met more than once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            values, counts = _counted(np.sort(np.concatenate(held)))
            edges = np.searchsorted(values, [(i << 32) // parts for i in range(1, parts)])
            blobs = [_counts_blob(v, n) for v, n in zip(np.split(values, edges), np.split(counts, edges))]
            return pa.RecordBatch.from_pydict({"part": pa.array(range(parts), pa.int32()), "blob": blobs})

        for batch in batches:
            array = A.texts(batch.column("_text"))
            for a, b in A.slices(array):
                sets, _ = shingles(array.slice(a, b - a))
                held.append(_class32(sets))
                size += len(sets)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _by_part(batches):
            values, counts = zip(*map(_counts, blobs))
            values, counts = np.concatenate(values), np.concatenate(counts)
            order = np.argsort(values, kind="stable")
            at = _first_of(values[order])
            values, counts = values[order][at], np.add.reduceat(counts[order], at, dtype=np.int64)
            keep = counts >= long
            if keep.any():
                yield pa.RecordBatch.from_pydict(
                    {"class": pa.array(values[keep].astype(np.int64)), "n": pa.array(counts[keep])}
                )

    sent = A.reachable(texts).mapInArrow(count, "part int, blob binary")
    counted = sent.repartition(parts, "part").mapInArrow(frequent, "class long, n long")
    top = counted.groupBy("class").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "class").limit(most)
    return np.sort(top.toArrow()["class"].to_numpy().astype(np.uint32))


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Blobs of one part after the other, of the parts that came to this task."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist()):
            if blob:
                held.setdefault(part, []).append(blob)
    while held:
        yield held.popitem()[1]


def _counts_blob(values: np.ndarray, counts: np.ndarray) -> bytes | None:
    """Sorted distinct values as differences, and the counts other than one."""
    if not len(values):
        return None
    steps = np.diff(values, prepend=np.uint32(0))
    wide = "<u2" if steps[1:].max(initial=0) < 65536 else "<u4"
    more = np.flatnonzero(counts > 1)
    head = np.array([len(values), int(wide[2]), len(more), values[0]], "<u4").tobytes()
    return head + more.astype("<u4").tobytes() + counts[more].astype("<u4").tobytes() + steps[1:].astype(wide).tobytes()


def _counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide, more, first = np.frombuffer(blob[:16], "<u4").tolist()
    at = 16 + 8 * more
    where, many = np.frombuffer(blob[16:at], "<u4").reshape(2, more)
    values = np.empty(n, np.uint32)
    values[0], values[1:] = first, np.frombuffer(blob[at:], f"<u{wide}")
    counts = np.ones(n, np.uint32)
    counts[where] = many
    return np.cumsum(values, dtype=np.uint32), counts


def _first_of(sorted_: np.ndarray) -> np.ndarray:
    """Where each distinct value begins."""
    return np.flatnonzero(np.append(len(sorted_) > 0, sorted_[1:] != sorted_[:-1]))


def _counted(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = _first_of(sorted_)
    return sorted_[at], np.diff(np.append(at, len(sorted_)))


_INVERTED = (
    "kind int, part int, blob binary, doc_id long, n long, k1 long, k2 long, token long, "
    "n_long long, place long"
)
DOCUMENT, SHORT, LONG_ENTRY = 0, 1, 2
_TOKEN_BITS = 48  # of a shingle in the short lists; verification uses all 64


def inverted(texts: DataFrame, frequent: np.ndarray, parts: int) -> DataFrame:
    """One pass over the texts: a row per document, blobs of short-list entries, long-list rows.

    A blob holds, for one range of shingles and a few thousand documents: the documents' ids,
    sizes, set keys and numbers of long lists, then sorted shingles as differences and the
    document of each entry. Equal sets of a task enter the lists once, as their smallest id.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema(
        [
            ("kind", pa.int32()),
            ("part", pa.int32()),
            ("blob", pa.binary()),
            *[(c, pa.int64()) for c in ("doc_id", "n", "k1", "k2", "token", "n_long", "place")],
        ]
    )

    def rows(kind: int, **columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        filled = {"kind": pa.array(np.full(n, kind, np.int32))} | columns
        return pa.RecordBatch.from_arrays(
            [filled[f.name] if f.name in filled else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest: dict[tuple, int] = {}
        for batch in batches:
            array = A.texts(batch.column("_text"))
            ids = batch.column("_id")
            for a, b in A.slices(array):
                sets, first = shingles(array.slice(a, b - a))
                n = np.diff(first)
                k1, k2 = set_key(sets, first)
                part = ids.slice(a, b - a)
                yield rows(
                    DOCUMENT, doc_id=part, n=pa.array(n), k1=pa.array(k1), k2=pa.array(k2)
                )
                valid = np.asarray(part.is_valid()) & (n > 0)
                number = np.asarray(part.fill_null(0))
                keep = []
                for i in np.flatnonzero(valid):
                    key = (int(k1[i]), int(k2[i]))
                    if number[i] < smallest.get(key, 1 << 63):
                        smallest[key] = int(number[i])
                        keep.append(i)
                if keep:
                    yield from entries(np.array(keep), sets, first, n, number, k1)

    def entries(keep, sets, first, n, number, k1) -> Iterator[pa.RecordBatch]:
        long_, tokens, owners = shared.value, [], []
        n_long = np.zeros(len(keep), np.int64)
        long_tokens, long_owners = [], []
        classes = _class32(sets)
        at = np.minimum(np.searchsorted(long_, classes), max(len(long_) - 1, 0))
        is_long = long_[at] == classes if len(long_) else np.zeros(len(sets), bool)
        for j, i in enumerate(keep):
            s, flag = sets[first[i] : first[i + 1]], is_long[first[i] : first[i + 1]]
            p = int(prefix_length(len(s)))
            short = s[~flag][:p]
            tokens.append(short)
            owners.append(np.full(len(short), j))
            if len(short) < p:
                rest = s[flag][: p - len(short)]
                n_long[j] = len(rest)
                long_tokens.append(rest)
                long_owners.append(np.full(len(rest), i))
        if long_tokens:
            who = np.concatenate(long_owners)
            yield rows(
                LONG_ENTRY,
                token=pa.array(np.concatenate(long_tokens).view(np.int64)),
                doc_id=pa.array(number[who]),
                n=pa.array(n[who]),
                k1=pa.array(k1[who]),
                n_long=pa.array(np.repeat(n_long[n_long > 0], n_long[n_long > 0])),
                place=pa.array(np.concatenate([np.arange(len(x)) for x in long_tokens])),
            )
        token = np.concatenate(tokens) >> np.uint64(64 - _TOKEN_BITS)
        owner = np.concatenate(owners)
        order = np.argsort(token)
        token, owner = token[order], owner[order]
        edges = np.searchsorted(token, [(i << _TOKEN_BITS) // parts for i in range(1, parts)])
        blobs = [
            _blob(t, o, number[keep], n[keep], k1[keep], n_long)
            for t, o in zip(np.split(token, edges), np.split(owner, edges))
        ]
        yield rows(SHORT, part=pa.array(range(parts), pa.int32()), blob=pa.array(blobs, pa.binary()))

    return A.reachable(texts).mapInArrow(run, _INVERTED)


def _blob(token, owner, ids, n, k1, n_long) -> bytes | None:
    if not len(token):
        return None
    used, owner = np.unique(owner, return_inverse=True)
    steps = np.diff(token, prepend=np.uint64(0))
    wide = "<u4" if steps[1:].max(initial=0) < 1 << 32 else "<u8"
    narrow = "<u2" if len(used) < 1 << 16 else "<u4"
    head = np.array([len(used), len(token), int(wide[2]), int(narrow[2])], "<i8").tobytes()
    table = np.stack([ids[used], n[used], k1[used], n_long[used]]).astype("<i8").tobytes()
    return head + table + steps[:1].astype("<u8").tobytes() + steps[1:].astype(wide).tobytes() + owner.astype(narrow).tobytes()


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, the document of each, and the documents' (id, size, key, long lists)."""
    docs, n, wide, narrow = np.frombuffer(blob[:32], "<i8").tolist()
    at = 32 + 32 * docs
    table = np.frombuffer(blob[32:at], "<i8").reshape(4, docs)
    steps = np.frombuffer(blob[at : at + 8], "<u8")
    rest = np.frombuffer(blob[at + 8 : at + 8 + wide * (n - 1)], f"<u{wide}").astype(np.uint64)
    owner = np.frombuffer(blob[at + 8 + wide * (n - 1) :], f"<u{narrow}")
    return np.cumsum(np.concatenate([steps, rest]), dtype=np.uint64), owner, table


def _shared(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with more than one entry, and each entry's document columns."""
    tokens, owners, tables = zip(*map(_unblob, blobs))
    shift = np.cumsum([0, *[t.shape[1] for t in tables]])
    token = np.concatenate(tokens)
    owner = np.concatenate([o + at for o, at in zip(owners, shift)])
    order = np.argsort(token)
    token, owner = token[order], owner[order]
    same = np.zeros(len(token) + 1, bool)
    same[1:-1] = token[1:] == token[:-1]
    keep = same[1:] | same[:-1]
    return token[keep], np.concatenate(tables, axis=1)[:, owner[keep]]


def _distinct_entries(token: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ascending by size, of equal sets in a list the smallest id."""
    order = np.lexsort((entry[0], entry[1], entry[2], token))
    token, entry = token[order], entry[:, order]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (entry[2, 1:] != entry[2, :-1]) | (entry[1, 1:] != entry[1, :-1])
    token, entry = token[keep], entry[:, keep]
    order = np.lexsort((entry[0], entry[1], token))
    return token[order], entry[:, order]


def _pairs_of_lists(token: np.ndarray, entry: np.ndarray) -> Iterator[np.ndarray]:
    """Columns (larger id, size, long, smaller id, size, long) of pairs that share a list."""
    at = _first_of(token)
    sizes = np.diff(np.append(at, len(token)))
    for k in np.unique(sizes[sizes > 1]):
        starts = at[sizes == k]
        small, large = np.triu_indices(k, 1)  # entries of a list ascend by size
        step = max(1, 250_000 // len(small))
        for i in range(0, len(starts), step):
            s = (starts[i : i + step, None] + small).ravel()
            r = (starts[i : i + step, None] + large).ravel()
            close = 100 * entry[1, s] >= SIMILAR * entry[1, r]
            if close.any():
                yield np.stack([*entry[[0, 1, 3]][:, r[close]], *entry[[0, 1, 3]][:, s[close]]])


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair, count = np.concatenate(pairs, axis=1), np.concatenate(counts)
    order = np.lexsort((pair[3], pair[0]))
    pair, count = pair[:, order], count[order]
    at = np.flatnonzero(np.append(True, (pair[0, 1:] != pair[0, :-1]) | (pair[3, 1:] != pair[3, :-1])))
    return pair[:, at], np.add.reduceat(count, at)


_LISTS = "r long, n long, n_long long, partners binary"
_FOUND = pa.schema([(c, pa.int64()) for c in ("r", "s", "c")])


def partner_lists(short: DataFrame, parts: int, long: int) -> DataFrame:
    """Per range of shingles and document: its partners on short lists, sorted, with counts.

    For a document on a list of ``long`` or more entries, a row without partners besides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _by_part(batches):
            yield from lists(blobs)

    def lists(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        token, entry = _distinct_entries(*_shared(blobs))
        at = _first_of(token)
        sizes = np.diff(np.append(at, len(token)))
        big = np.repeat(sizes >= long, sizes)
        crowded = np.unique(entry[0, big])
        for i in range(0, len(crowded), 100_000):
            some = crowded[i : i + 100_000]
            zero = pa.array(np.zeros(len(some), np.int64))
            yield pa.RecordBatch.from_pydict(
                {"r": pa.array(some), "n": zero, "n_long": zero, "partners": pa.nulls(len(some), pa.binary())}
            )
        token, entry = token[~big], entry[:, ~big]
        pairs, counts, held = [], [], 0
        for pair in _pairs_of_lists(token, entry):
            pairs.append(pair)
            counts.append(np.ones(pair.shape[1], np.int64))
            held += pair.shape[1]
            if held > 500_000:
                pair, count = _summed(pairs, counts)
                pairs, counts, held = [pair], [count], 0
        if not pairs:
            return
        pair, count = _summed(pairs, counts)
        at = np.flatnonzero(np.append(True, pair[0, 1:] != pair[0, :-1]))
        packed = np.stack([pair[3], pair[4], pair[5], count], axis=1).astype("<i8")
        for i in range(0, len(at), 10_000):
            some = at[i : i + 10_000]
            stops = np.append(at, len(count))[i + 1 : i + 1 + len(some)]
            yield pa.RecordBatch.from_pydict(
                {
                    "r": pa.array(pair[0, some]),
                    "n": pa.array(pair[1, some]),
                    "n_long": pa.array(pair[2, some]),
                    "partners": pa.array([packed[a:b].tobytes() for a, b in zip(some, stops)], pa.binary()),
                }
            )

    return A.reachable(short).repartition(parts, "part").mapInArrow(run, _LISTS)


def heap_merge(lists: list[list[tuple]]) -> Iterator[tuple[int, int, int, int]]:
    """Merge sorted lists of (partner, size, long lists, count), adding up a partner's counts."""
    for (s, n, n_long), same in groupby(heapq.merge(*lists), key=lambda x: x[:3]):
        yield s, n, n_long, sum(x[3] for x in same)


def merged(lists: DataFrame, parts: int) -> DataFrame:
    """Candidates (r, s, c): partners occurring on enough short lists, c times.

    Documents on lists that are not expanded go through, with s NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for row in zip(*[batch.column(c).to_pylist() for c in ("r", "n", "n_long", "partners")])
        )
        out: list[tuple] = []
        for (r, n, n_long), same in groupby(rows, key=lambda x: x[:3]):
            parted = []
            for *_, partners in same:
                if partners is None:
                    out.append((r, None, None))
                else:
                    parted.append([tuple(x) for x in np.frombuffer(partners, "<i8").reshape(-1, 4).tolist()])
            left_out = n - prefix_length(n)
            for s, m, m_long, c in heap_merge(parted):
                needed = least_overlap(n, m) - max(left_out, m - prefix_length(m)) - min(n_long, m_long)
                if c >= needed:
                    out.append((r, s, c))
            if len(out) >= 10_000:
                yield _candidates(out)
                out = []
        if out:
            yield _candidates(out)

    placed = lists.repartition(parts, "r").sortWithinPartitions("r", "n", "n_long")
    return A.reachable(placed).mapInArrow(run, "r long, s long, c long")


def _candidates(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=_FOUND)


def by_count(texts: DataFrame, long: int) -> tuple[DataFrame, DataFrame]:
    """The search among documents with their shingles ordered by exact count, then by hash.

    Returns candidates (r, s, c) that occur on enough lists of fewer than ``long`` documents, and
    the entries of the longer lists (token, doc_id, n, h, place). Counts come from a shuffle of
    the shingles of these documents, so nothing about them has to be remembered in one place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            array = A.texts(batch.column("_text"))
            for a, b in A.slices(array):
                sets, first = shingles(array.slice(a, b - a))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("_id").slice(a, b - a),
                        "n": pa.array(np.diff(first)),
                        "k1": pa.array(set_key(sets, first)[0]),
                        "tokens": pa.ListArray.from_arrays(
                            pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64))
                        ),
                    }
                )

    rows = A.reachable(texts.distinct()).mapInArrow(run, "doc_id long, n long, k1 long, tokens array<long>")
    each = A.staged(rows, "crowded_sets").select("doc_id", "n", "k1", F.explode("tokens").alias("token"))
    # A shingle of one document only stands first in its order and on no list.
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("_count")).filter("_count > 1")
    own = Window.partitionBy("doc_id", "n", "k1")
    at = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("_count", "token"))
    length = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1
    prefix = (
        each.join(counts, "token")
        .withColumn("_from_here", length - at + 1)
        .filter("_from_here > 0")
        .withColumn("h", F.count_if(F.col("_count") >= long).over(own))
        .groupBy("token", "n", "k1", "h", "_count", "_from_here")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    prefix = A.staged(prefix, "crowded_prefixes")
    entries = prefix.filter(F.col("_count") >= long).select(
        F.xxhash64("token", F.lit("by count")).alias("token"),  # not a list of the other order
        "doc_id",
        "n",
        "h",
        (F.col("h") - F.col("_from_here")).alias("place"),
    )
    short = prefix.filter(F.col("_count") < long).select("token", "doc_id", "n", "k1", "h")
    left, right = (short.select("token", *[F.col(c).alias(f"{c}_{x}") for c in short.columns[1:]]) for x in "rs")
    out = [F.ceil(F.col(f"n_{x}") * SIMILAR / 100) - 1 for x in "rs"]
    needed = F.ceil((F.col("n_r") + F.col("n_s")) * SIMILAR / (100 + SIMILAR)) - F.greatest(*out) - F.least("h_r", "h_s")
    close = 100 * F.least("n_r", "n_s") >= SIMILAR * F.greatest("n_r", "n_s")
    pairs = (
        left.join(right, "token")
        .filter((F.col("doc_id_r") < F.col("doc_id_s")) & close)
        .groupBy(*[f"{c}_{x}" for c in ("doc_id", "n", "k1", "h") for x in "rs"])
        .agg(F.count(F.lit(1)).alias("c"))
        .filter(F.col("c") >= needed)
        .select(F.col("doc_id_r").alias("r"), F.col("doc_id_s").alias("s"), "c")
    )
    return pairs, entries


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the candidate pairs (r, s), those that are linked, as edges (a, b).

    Texts are joined to the pairs, since they are shorter than their sets; the larger set's
    shingles probe the smaller one's by binary search.
    """
    docs = texts.filter(F.col("_id").isNotNull())
    both = (
        pairs.join(docs.select(F.col("_id").alias("r"), F.col("_text").alias("_r")), "r")
        .join(docs.select(F.col("_id").alias("s"), F.col("_text").alias("_s")), "s")
        .select("r", "s", "_r", "_s")
    )

    def run(table: pa.Table) -> pa.Table:
        left, right = A.texts(table["_r"]), A.texts(table["_s"])
        keep = np.zeros(table.num_rows, bool)
        for a in range(0, table.num_rows, 64):
            b = min(a + 64, table.num_rows)
            (rs, r_at), (ss, s_at) = shingles(left.slice(a, b - a)), shingles(right.slice(a, b - a))
            for i in range(b - a):
                r, s = rs[r_at[i] : r_at[i + 1]], ss[s_at[i] : s_at[i + 1]]
                if len(r) and len(s):
                    place = np.minimum(np.searchsorted(s, r), len(s) - 1)
                    keep[a + i] = (s[place] == r).sum() >= least_overlap(len(r), len(s))
        return pa.table({"a": table["r"], "b": table["s"]}).filter(pa.array(keep))

    return A.map_tables(both, run, "a long, b long")


def _unlike(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet; a document without links is its own."""
    label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
    return (
        pairs.join(label("r"), "r", "left")
        .join(label("s"), "s", "left")
        .filter(F.coalesce("_r", "r") != F.coalesce("_s", "s"))
        .select("r", "s")
    )


def enough_left(n: str, left_n: Column, m: str, left_m: Column) -> Column:
    """Whether sets of sizes n and m that first meet on a long list can still be linked.

    A linked pair that shares no short list shares at least T - L long ones of both prefixes.
    If this list is their first, so many must stand from here on in either.
    """
    both = F.col(n) + F.col(m)
    least = F.ceil(both * SIMILAR / (100 + SIMILAR))
    left_out = F.ceil(F.greatest(n, m) * SIMILAR / 100) - 1
    sizes = 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)
    return sizes & (F.least(left_n, left_m) >= least - left_out)


def _oriented(pairs: DataFrame) -> DataFrame:
    """Distinct pairs of different documents whose sizes allow a link, the smaller id first."""
    return (
        pairs.filter(
            (F.col("r") != F.col("s"))
            & (100 * F.least("n_r", "n_s") >= SIMILAR * F.greatest("n_r", "n_s"))
        )
        .select(F.least("r", "s").alias("r"), F.greatest("r", "s").alias("s"))
        .distinct()
    )


def similar_sets(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", long: int = LONG, most_long: int = MOST_LONG
) -> DataFrame:
    """Per document: id, size of its set, and the smallest id its links reach."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    index = A.staged(inverted(texts, long_lists(texts, parts, long, most_long), parts), "inverted")

    short = index.filter((F.col("kind") == SHORT) & F.col("blob").isNotNull()).select("part", "blob")
    found = A.staged(merged(partner_lists(short, parts, long), parts), "candidates")
    by_short = found.filter("s IS NOT NULL")
    entry = (
        index.filter(F.col("kind") == LONG_ENTRY)
        .groupBy("token", "k1", "n")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n_long").alias("h"), F.min("place").alias("place"))
        .select("token", "doc_id", "n", "h", "place")
    )
    crowded = found.filter("s IS NULL").select(F.col("r").alias("_id")).distinct()
    if not crowded.isEmpty():
        pairs, entries = by_count(texts.join(crowded, "_id", "left_semi"), long)
        by_short = by_short.unionByName(A.staged(pairs, "crowded_candidates"))
        entry = entry.unionByName(entries)
    entry = A.staged(entry, "long_entries")

    # First round: everyone's likeliest partner.
    # On a long list, whoever has most long lists is most like the others.
    leader = entry.groupBy("token").agg(
        F.max_by(F.struct("n", "doc_id"), F.struct("h", -F.col("doc_id"))).alias("_lead")
    )
    led = (
        entry.join(leader, "token")
        .groupBy(F.col("doc_id").alias("r"), F.col("n").alias("n_r"), "_lead")
        .agg(F.count(F.lit(1)).alias("_c"))
        .filter("r != _lead.doc_id")
        .groupBy("r", "n_r")
        .agg(F.max_by("_lead", F.struct("_c", "_lead")).alias("_lead"))
        .select("r", "n_r", F.col("_lead.doc_id").alias("s"), F.col("_lead.n").alias("n_s"))
    )
    best = by_short.groupBy("r").agg(F.max_by("s", F.struct("c", "s")).alias("s"))
    pair = [F.least("r", "s").alias("r"), F.greatest("r", "s").alias("s")]
    first = A.staged(best.select(*pair).unionByName(_oriented(led)).distinct(), "first_pairs")
    links = A.staged(verify(first, texts), "first_links")
    labels = components(links)

    # Second round: whatever could still join two components.
    rest = by_short.select(*pair).unionByName(_across(entry, labels)).distinct()
    rest = A.staged(_unlike(rest, labels).join(first, ["r", "s"], "left_anti"), "second_pairs")
    if not rest.isEmpty():
        more = A.staged(verify(rest, texts), "second_links")
        labels = components(links.unionByName(more))
    return _labelled(index.filter(F.col("kind") == DOCUMENT), labels, id_col)


def _across(entry: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs on a long list that lie in different components: each entry outside the list's
    largest component with every entry of another one. A list within one component gives none."""
    known = entry.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    per = known.groupBy("token", "component").agg(F.count(F.lit(1)).alias("_n"))
    largest = per.groupBy("token").agg(
        F.max(F.struct("_n", "component")).alias("_top"), F.count(F.lit(1)).alias("_components")
    )
    mixed = A.staged(
        known.join(
            largest.filter("_components > 1").select("token", F.col("_top.component").alias("_top")), "token"
        ),
        "mixed_lists",
    )
    few = mixed.filter("component != _top").select(
        "token", *[F.col(c).alias(f"{c}_r") for c in ("n", "h", "place")], F.col("doc_id").alias("r"),
        F.col("component").alias("_c"),
    )
    all_ = mixed.select(
        "token", *[F.col(c).alias(f"{c}_s") for c in ("n", "h", "place")], F.col("doc_id").alias("s"),
        "component",
    )
    able = enough_left("n_r", F.col("h_r") - F.col("place_r"), "n_s", F.col("h_s") - F.col("place_s"))
    return _oriented(few.join(all_, "token").filter((F.col("_c") != F.col("component")) & able))


def _labelled(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """Component of every document, by the class of its set."""
    classes = (
        rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("n", "k1", "k2")
        .agg(F.min("doc_id").alias("_rep"))
        .join(labels.withColumnRenamed("node", "_rep"), "_rep", "left")
        .select("n", "k1", "k2", F.coalesce("component", "_rep").alias("_component"))
    )
    # Stored, so that a class with many copies is split in the join and not dealt out with them.
    classes = A.staged(classes, "classes")
    return rows.join(classes, ["n", "k1", "k2"], "left").select(
        F.col("doc_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
    )

"""N-gram Jaccard join: a prefix-tree join over globally ordered n-gram sets.

A document's n-grams are ordered by (number of documents that hold them, fingerprint), rarest first. N-grams held by
the same documents always stand together, so they are one weighted element. A document can only be linked to documents
with which it shares an element of its prefix (the elements up to the weight that a linked pair cannot do without), so
each element of a prefix is a branch of the tree and goes to one task. There the sets below the branch are stored in a
trie whose nodes share common runs; each set walks the trie with the overlap so far, and leaves a subtree as soon as
the weight left on either side cannot reach the required overlap, or when the subtree belongs to its component already.

Three steps come before, each exact:
1. A quarter of all n-grams, chosen by hash, is counted. If the n-grams of that quarter that no other document holds
   alone make a link impossible, the document leaves.
2. Documents with equal sets are one class.
3. The rest is counted again in full; the rule of step 1 is applied to all n-grams.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.links import Roots, components
from ledgerlake.llm.shared import U, bucket_of, deals, documents_of, mix, packed, postings, ready, settle, unpacked, word_hashes

SAMPLE = U(1 << 62)  # a quarter of all hashes
GROUP = 2048  # sets in one trie; a branch that more documents hold is split into pairs of chunks
FLUSH = 1 << 21
_NONE = -1


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, as sorted hashes, and how many each text has.

    Fewer words than ``words``: the whole sequence is the one n-gram. No words: none.
    """
    hashes, owner = word_hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    first = np.r_[0, np.cumsum(count)]
    if len(hashes) >= words:
        grams = hashes[: len(hashes) - words + 1].copy()
        for k in range(1, words):
            grams = mix(grams) + hashes[k : len(hashes) - words + 1 + k]
        grams = mix(grams, words)
        inside = owner[: len(grams)] == owner[words - 1 :]
        grams, owned = grams[inside], owner[: len(grams)][inside]
    else:
        grams, owned = np.empty(0, U), np.empty(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        extra = np.empty(len(short), U)
        for i, t in enumerate(short):
            value = np.ones(1, U)
            for k in range(first[t], first[t + 1]):
                value = mix(value) + hashes[k : k + 1]
            extra[i] = mix(value, 1000 + int(count[t]))[0]
        grams, owned = np.r_[grams, extra], np.r_[owned, short]
        order = np.argsort(owned, kind="stable")
        grams, owned = grams[order], owned[order]
    cuts = np.searchsorted(owned, np.arange(len(texts) + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        grams[a:b].sort()
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owned[1:] != owned[:-1])
    return grams[keep], np.bincount(owned[keep], minlength=len(texts))


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.empty(0, np.int64)
    return starts, np.diff(np.r_[starts, len(sorted_keys)])


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of values (modulo 2 ** 64); empty runs give 0."""
    total = np.r_[U(0), np.cumsum(values, dtype=U)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


FACTS = "doc long, n long, one long, two long, few long, met long"


def _sampled(words: int, buckets: int):
    """Facts of each document and the sampled n-grams, of which a task sends each once: with its document, or with
    none if several documents of the task hold it (these have counted it already)."""
    kinds = ["key", "holder"]

    def run(batches):
        held: list[tuple] = []

        def flush():
            docs, n, one, two, few, grams = (np.concatenate(x) for x in zip(*held, strict=True))
            owner = np.repeat(np.arange(len(docs)), few)
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order]
            starts, counts = _runs(grams)
            met = np.bincount(owner[np.repeat(counts > 1, counts)], minlength=len(docs))
            who = np.where(counts == 1, docs[owner[starts]], _NONE)
            none = pa.nulls(len(docs), pa.binary())
            home = bucket_of(docs, buckets)
            yield pa.RecordBatch.from_arrays([pa.array(home), none, none, *map(pa.array, (docs, n, one.view(np.int64), two.view(np.int64), few, met))], names=["bucket", *kinds, *FACT_NAMES])
            for batch in postings(grams[starts], [who], buckets, kinds):
                blank = [pa.nulls(batch.num_rows, pa.int64())] * len(FACT_NAMES)
                yield pa.RecordBatch.from_arrays([*batch.columns, *blank], names=["bucket", *kinds, *FACT_NAMES])

        size = 0
        for ids, texts in documents_of(batches):
            sets, n = shingle_sets(texts, words)
            sampled = sets < SAMPLE
            few = _sums(sampled.astype(U), n).astype(np.int64)
            held.append((np.array(ids, np.int64), n, _sums(mix(sets, 1), n), _sums(mix(sets, 2), n), few, sets[sampled]))
            size += int(few.sum())
            if size >= FLUSH:
                yield from flush()
                held.clear()
                size = 0
        if held:
            yield from flush()

    return run


FACT_NAMES = [part.split()[0] for part in FACTS.split(", ")]


def _met(buckets: int):
    """Facts as they come, and for each document how many of its n-grams here another document holds, packed."""
    kinds = ["holder", "times"]

    def run(batches):
        keys: list[bytes] = []
        docs: list[bytes] = []
        for batch in batches:
            told = batch.filter(batch.column(3).is_valid())
            if told.num_rows:
                none = pa.nulls(told.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([told.column(0), none, none, *told.columns[3:]], names=["bucket", *kinds, *FACT_NAMES])
            sent = batch.filter(batch.column(1).is_valid())
            keys += sent.column(1).to_pylist()
            docs += sent.column(2).to_pylist()
        key, doc = np.frombuffer(b"".join(keys), U), np.frombuffer(b"".join(docs), np.int64)
        order = np.argsort(key, kind="stable")
        _, counts = _runs(key[order])
        met, times = np.unique(doc[order][np.repeat(counts > 1, counts)], return_counts=True)
        for batch in postings(met[met != _NONE], [times[met != _NONE]], buckets, kinds):
            blank = [pa.nulls(batch.num_rows, pa.int64())] * len(FACT_NAMES)
            yield pa.RecordBatch.from_arrays([*batch.columns, *blank], names=["bucket", *kinds, *FACT_NAMES])

    return run


def _totals(batches):
    """One row for each document: its facts with all counts of shared n-grams added."""
    facts: list[list] = [[] for _ in FACT_NAMES]
    docs: list[bytes] = []
    times: list[bytes] = []
    for batch in batches:
        told = batch.filter(batch.column(3).is_valid())
        for column, values in zip(facts, told.columns[3:], strict=True):
            column.append(values.to_numpy())
        sent = batch.filter(batch.column(1).is_valid())
        docs += sent.column(1).to_pylist()
        times += sent.column(2).to_pylist()
    if not any(map(len, facts[0])):
        return
    doc, n, one, two, few, met = map(np.concatenate, facts)
    known, at = np.unique(doc, return_inverse=True)
    first = np.zeros(len(known), np.int64)
    first[at] = np.arange(len(doc))
    sums = [np.zeros(len(known), np.int64) for _ in range(2)]
    np.add.at(sums[0], at, few)
    np.add.at(sums[1], at, met)
    np.add.at(sums[1], np.searchsorted(known, np.frombuffer(b"".join(docs), np.int64)), np.frombuffer(b"".join(times), np.int64))
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (known, n[first], one[first], two[first], *sums)], names=FACT_NAMES)


def _whole(words: int, buckets: int):
    """All n-grams of the classes that are left; a document's own size goes with its number as key."""

    def run(batches):
        for ids, texts in documents_of(batches, 4 << 20):
            sets, n = shingle_sets(texts, words)
            docs = np.array(ids, np.int64)
            yield from postings(sets, [np.repeat(docs, n)], buckets, ["key", "doc"])

    return run


def _elements(batches):
    """Merge n-grams that the same documents hold: rows (doc, element, held, weight) of n-grams with two holders or more."""
    got = unpacked(batches, {"key": "<u8", "doc": "<i8"})
    order = np.lexsort((got["doc"], got["key"]))
    key, doc = got["key"][order], got["doc"][order]
    once = np.ones(len(key), bool)  # a row that is repeated sends its n-grams again
    once[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[once], doc[once]
    starts, counts = _runs(key)
    element = _sums(mix(doc.view(U), 3), counts)
    shared = counts > 1
    at = np.repeat(shared, counts)
    rows = np.rec.fromarrays([doc[at], np.repeat(counts[shared], counts[shared]), np.repeat(element[shared], counts[shared])], names="doc,held,element")
    order = np.lexsort((rows.element, rows.held, rows.doc))
    rows = rows[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows.doc[1:] != rows.doc[:-1]) | (rows.held[1:] != rows.held[:-1]) | (rows.element[1:] != rows.element[:-1])
    starts = np.flatnonzero(fresh)
    weight = np.diff(np.r_[starts, len(rows)])
    yield pa.RecordBatch.from_arrays([pa.array(rows.doc[starts]), pa.array(rows.element[starts].view(np.int64)), pa.array(rows.held[starts]), pa.array(weight)], names=["doc", "element", "held", "weight"])


def _branches(percent: int):
    """For each document the elements of its prefix, each with the part of the set that starts there."""

    def run(batches):
        table = pa.Table.from_batches(list(batches), schema=pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("element", pa.int64()), ("held", pa.int64()), ("weight", pa.int64())]))
        doc, n, element, held, weight = (c.to_numpy() for c in table.columns)
        order = np.lexsort((element, held, doc))
        doc, n, element, held, weight = (c[order] for c in (doc, n, element, held, weight))
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (held[1:] != held[:-1]) | (element[1:] != element[:-1])
        starts = np.flatnonzero(fresh)
        weight = np.add.reduceat(weight, starts) if len(starts) else weight
        doc, n, element, held = (c[starts] for c in (doc, n, element, held))
        first, count = _runs(doc)
        steps, weight32 = np.diff(held, prepend=0).astype(np.int32), weight.astype(np.int32)
        out: list[list] = [[] for _ in BRANCH_NAMES]
        for a, size in zip(first.tolist(), count.tolist(), strict=True):
            b, of = a + size, int(n[a])
            spare = of - -(-percent * of // 100)  # weight that a linked document may lack
            lacking = of - int(weight[a:b].sum())
            for at in range(a, b):
                if lacking > spare:
                    break
                chunks = -(-int(held[at]) // GROUP)
                mine = int(doc[at]) % chunks
                for other in range(chunks):
                    for column, value in zip(out, (int(element[at]), int(held[at]), min(mine, other) * chunks + max(mine, other), int(doc[at]), of, element[at:b].tobytes(), steps[at:b].tobytes(), weight32[at:b].tobytes()), strict=True):
                        column.append(value)
                lacking += int(weight[at])
            if len(out[0]) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, BRANCH_TYPES, strict=True)], names=BRANCH_NAMES)
                out = [[] for _ in BRANCH_NAMES]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, BRANCH_TYPES, strict=True)], names=BRANCH_NAMES)

    return run


BRANCH = "element long, held long, chunk long, doc long, n long, elements binary, steps binary, weights binary"
BRANCH_NAMES = [part.split()[0] for part in BRANCH.split(", ")]
BRANCH_TYPES = [pa.int64()] * 5 + [pa.binary()] * 3


class _Node:
    """A run of elements that all sets below share. ``least``: smallest set below; ``rest``: most weight from here on;
    ``one``: a set below, if all of them are known to be in its component."""

    __slots__ = ("keys", "kids", "least", "one", "rest", "sets", "weights")

    def __init__(self, keys, weights, least, rest, one):
        self.keys, self.weights, self.least, self.rest, self.one = keys, weights, least, rest, one
        self.kids: dict = {}
        self.sets: list = []


class Trie:
    """Sets (doc, n, ordered keys, weights) of one branch; ``link`` finds a new set's links to other components."""

    def __init__(self, percent: int):
        self.percent, self.top, self.roots = percent, _Node([], [], 1 << 60, 0, None), Roots()

    def put(self, doc: int, n: int, keys: list, weights: list) -> None:
        node, at, rest = self.top, 0, sum(weights)
        node.least, node.rest = min(node.least, n), max(node.rest, rest)
        while True:
            if node.one is not None and self.roots.find(node.one) != self.roots.find(doc):
                node.one = None
            if at == len(keys):
                node.sets.append((doc, n))
                return
            kid = node.kids.get(keys[at])
            if kid is None:
                kid = node.kids[keys[at]] = _Node(keys[at:], weights[at:], n, rest, doc)
                kid.sets.append((doc, n))
                return
            same = 1
            while same < len(kid.keys) and at + same < len(keys) and kid.keys[same] == keys[at + same]:
                same += 1
            if same < len(kid.keys):
                above = _Node(kid.keys[:same], kid.weights[:same], kid.least, kid.rest, kid.one)
                kid.rest -= sum(above.weights)
                kid.keys, kid.weights = kid.keys[same:], kid.weights[same:]
                above.kids[kid.keys[0]] = kid
                node.kids[keys[at]] = kid = above
            kid.least, kid.rest = min(kid.least, n), max(kid.rest, rest)
            rest -= sum(kid.weights)
            node, at = kid, at + same

    def link(self, doc: int, n: int, keys: list, weights: list) -> list[int]:
        """Sets that are linked with this one, at least one of each component that holds any."""
        find, percent = self.roots.find, self.percent
        left = [0] * (len(keys) + 1)
        for i in range(len(keys) - 1, -1, -1):
            left[i] = left[i + 1] + weights[i]
        found: list[int] = []

        def visit(node, at, overlap):
            if node.one is not None and find(node.one) == find(doc):
                return
            need = -(-percent * (n + node.least) // (100 + percent))
            rest = node.rest
            for key, weight in zip(node.keys, node.weights, strict=True):
                if overlap + min(rest, left[at]) < need:
                    return
                while at < len(keys) and keys[at] < key:
                    at += 1
                if at < len(keys) and keys[at] == key:
                    overlap += weight
                    at += 1
                rest -= weight
            if overlap + min(rest, left[at]) < need:
                return
            for other, size in node.sets:
                if find(other) != find(doc) and 100 * overlap >= percent * (n + size - overlap):
                    self.roots.join(doc, other)
                    found.append(other)
            for kid in node.kids.values():
                visit(kid, at, overlap)
            root = find(doc)
            if all(find(other) == root for other, _ in node.sets) and all(kid.one is not None and find(kid.one) == root for kid in node.kids.values()):
                node.one = doc

        visit(self.top, 0, 0)
        return found


def _links(percent: int):
    """The tries of one task: verified links that connect all sets which a branch links."""

    def run(batches):
        sys.setrecursionlimit(100_000)
        now, members = (0, 0, 0), []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            out: list[tuple[int, int]] = []
            for element, held, chunk, doc, n, keys, steps, weights in zip(*columns, strict=True):
                if (held, element, chunk) != now:
                    out += _joined(now[0], members, percent)
                    now, members = (held, element, chunk), []
                members.append((doc, n, keys, steps, weights))
            yield _pairs(out)
        yield _pairs(_joined(now[0], members, percent))

    return run


def _joined(held: int, members: list[tuple], percent: int) -> list[tuple[int, int]]:
    if len(members) < 2:
        return []
    sizes = np.array([len(keys) // 8 for _, _, keys, _, _ in members])
    ends = np.cumsum(sizes)
    keys = np.frombuffer(b"".join(m[2] for m in members), "<i8")
    steps = np.frombuffer(b"".join(m[3] for m in members), "<i4").astype(np.int64)
    steps[ends - sizes] = held  # all sets start with the branch's element
    helds = np.cumsum(steps)
    helds -= np.repeat(helds[ends - sizes] - held, sizes)
    order = np.lexsort((keys, helds))
    fresh = np.r_[False, (keys[order][1:] != keys[order][:-1]) | (helds[order][1:] != helds[order][:-1])]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(fresh)  # places in the global order
    trie, out = Trie(percent), []
    for (doc, n, _, _, weights), end, size in zip(members, ends.tolist(), sizes.tolist(), strict=True):
        ordered, weighed = ranks[end - size : end].tolist(), np.frombuffer(weights, "<i4").tolist()
        out += [(doc, other) for other in trie.link(doc, n, ordered, weighed)]
        trie.put(doc, n, ordered, weighed)
    return out


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, class_id, component_id): documents whose n-gram sets have a Jaccard of ``percent`` or more link.

    ``class_id``: the smallest document with the same set; ``component_id``: the smallest document that links reach.
    Null and empty texts, and texts without words, have the empty set and link with nothing. Rows without an id are left
    out; a row that is repeated counts once. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    # let the join that fetches the remaining texts filter them by a Bloom filter before they are moved, at any size
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    parts = deals(spark)
    buckets = 4 * parts
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    sampled = texts.mapInArrow(_sampled(words, buckets), "bucket long, key binary, holder binary, " + FACTS)
    met = sampled.repartition(parts, "bucket").mapInArrow(_met(buckets), "bucket long, holder binary, times binary, " + FACTS)
    facts = settle(met.repartition(parts, "bucket").mapInArrow(_totals, FACTS), "shingle-facts")
    classes = facts.where("n > 0").groupBy("one", "two", "n").agg(F.min("doc").alias("class_id"), F.max(F.expr("few - met")).alias("alone"))
    classes = settle(classes, "shingle-classes")
    left = classes.where(f"100 * (n - alone) >= {percent} * n").select(F.col("class_id").alias("doc"), "n")
    chosen = texts.join(left.hint("merge"), "doc", "left_semi").select("doc", "text")
    whole = chosen.mapInArrow(_whole(words, buckets), packed("key", "doc"))
    elements = whole.repartition(parts, "bucket").mapInArrow(_elements, "doc long, element long, held long, weight long")
    sized = elements.join(left, "doc").select("doc", "n", "element", "held", "weight")
    branches = sized.repartition(parts, "doc").mapInArrow(_branches(percent), BRANCH)
    links = branches.repartition(parts, "element", "chunk").sortWithinPartitions("element", "held", "chunk", F.desc("n"), "doc").mapInArrow(_links(percent), "a long, b long")
    reached = components(settle(links, "shingle-links"))
    named = classes.join(reached, classes.class_id == reached.id, "left").select("one", "two", "n", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    whole_rows = facts.join(named, ["one", "two", "n"], "left")
    return whole_rows.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("component_id", "doc").alias("component_id")
    )

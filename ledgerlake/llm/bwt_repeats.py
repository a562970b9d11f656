"""Repeated byte strings: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every window of ``length`` bytes has an anchor: its smallest 48-byte string by hash, the leftmost of equals. Equal
windows have equal anchors at equal places, so windows are compared only where their anchors are equal. Neighbouring
windows with one anchor are a run, and a run's context is the bytes that its windows cover.

1. Runs are counted by (anchor, hash of the context). Equal contexts: all their windows are repeated. A run whose anchor
   occurs nowhere else holds no repeated window.
2. The other contexts that share an anchor, one of each kind, are put together in blocks. Of a block the Burrows-Wheeler
   transform is built; breadth-first backward extension gives the common prefixes of neighbouring suffixes in the order
   of their length and stops at ``length``: boundaries that no shorter string has set join suffixes with a common prefix
   of ``length`` bytes or more.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import U, bucket_of, deals, documents_of, mix, postings, powers, prefix_sums, ready, settle, span_hashes
from ledgerlake.llm.shared import _BACK

ANCHOR, NARROW = 48, 160  # bytes of an anchor; of a second one where too many contexts share the first
PIECE = 4 << 20  # longer texts go through in pieces that overlap by a window
PLACE = 23  # bits of a place within a batch of pieces
BLOCK = 1 << 20  # bytes put into one transform, or one anchor's contexts if these are more
CROWD = 1500  # contexts of an anchor from which on they are dealt out by a second anchor
FLUSH = 1 << 19


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each ``width`` neighbours."""
    got, have = key, 1
    while have * 2 <= width:
        got = np.minimum(got[:-have], got[have:])
        have *= 2
    rest = width - have
    return np.minimum(got[: len(got) - rest], got[rest:]) if rest else got


def runs(data: np.ndarray, ends: np.ndarray, length: int, anchor: int, seed: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that lie within one part of ``data`` (parts end at ``ends``): part, first start, number of
    windows, anchor's hash, context's hash."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(U), none.view(U)
    sums = prefix_sums(data)
    grams = mix((sums[anchor:] - sums[:-anchor]) * powers(len(sums), _BACK)[: len(sums) - anchor], seed)
    place = np.arange(len(grams), dtype=U)
    low = U((1 << PLACE) - 1)
    at = (_least((grams & ~low) | place, length - anchor + 1) & low).astype(np.int64)
    starts = np.r_[0, ends[:-1]]
    part = np.repeat(np.arange(len(ends)), ends - starts)[: len(at)]
    inside = np.arange(len(at)) + length <= ends[part]
    fresh = np.r_[True, (at[1:] != at[:-1]) | (part[1:] != part[:-1])] & inside
    first = np.flatnonzero(fresh)
    if not len(first):
        return none, none, none, none.view(U), none.view(U)
    count = np.add.reduceat(inside.astype(np.int64), first)
    return part[first], first - starts[part[first]], count, grams[at[first]], span_hashes(sums, first, first + count - 1 + length)


def _pieces(ids: list, texts: list[bytes], length: int):
    """(doc, offset, bytes) in lists of at most two pieces' bytes; every window lies within a piece."""
    held, size = [], 0
    for doc, text in zip(ids, texts, strict=True):
        for offset in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[offset : offset + PIECE + length - 1]
            if size + len(part) >= 1 << PLACE:
                yield held
                held, size = [], 0
            held.append((doc, offset, part))
            size += len(part)
    if held:
        yield held


# a document is an id and the hash of its text (form), for one id may have several texts
RUN = ["gram", "context", "doc", "form", "start", "count", "known"]
SPAN = ["span_doc", "span_form", "span_start", "span_end"]
SENT = "bucket long, " + ", ".join(f"{c} binary" for c in RUN + SPAN)


def _blank(batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    """The batch with all of ``names``, null where it has none."""
    have = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    return pa.RecordBatch.from_arrays([have.get(name, pa.nulls(batch.num_rows, pa.binary())) for name in names], names=names)


def _spans(doc, form, start, end, buckets: int, names: list[str]):
    for batch in postings(doc, [form, start, end], buckets, SPAN):
        yield _blank(batch, names)


def _runs_of_task(length: int, buckets: int):
    """Each (anchor, context) once a task; repeated within the task, its spans go out and ``known`` says so."""
    names = ["bucket", *RUN, *SPAN]

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            doc, form, start, count, gram, context = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((context, gram))
            doc, form, start, count, gram, context = (x[order] for x in (doc, form, start, count, gram, context))
            fresh = np.r_[True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])]
            first = np.flatnonzero(fresh)
            times = np.diff(np.r_[first, len(gram)])
            known = np.repeat(times > 1, times)
            yield from _spans(doc[known], form[known], start[known], (start + count - 1 + length)[known], buckets, names)
            for batch in postings(gram[first], [context[first], doc[first], form[first], start[first], count[first].astype(np.int32), (times > 1).astype(np.int8)], buckets, RUN):
                yield _blank(batch, names)

        for ids, texts in documents_of(batches):
            for pieces in _pieces(ids, texts, length):
                ends = np.cumsum(np.array([len(p) for _, _, p in pieces], np.int64))
                data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
                part, start, count, gram, context = runs(data, ends, length, ANCHOR, 0)
                if not len(part):
                    continue
                doc, form = np.array([(d["doc"], d["form"]) for d, _, _ in pieces], np.int64).T[:, part]
                offset = np.array([o for _, o, _ in pieces], np.int64)[part]
                held.append((doc, form, start + offset, count, gram, context))
                size += len(doc)
            if size >= FLUSH:
                yield from flush()
                held.clear()
                size = 0
        if held:
            yield from flush()

    return run


WANTED = ["want_doc", "want_form", "want_gram", "want_start", "want_count", "want_open", "want_crowd"]
MET = "bucket long, " + ", ".join(f"{c} binary" for c in SPAN + WANTED)


def _met_runs(length: int, buckets: int):
    """Spans of runs with equal contexts; and of anchors with several contexts, one run of each context, ``open`` if
    its own windows are still to be judged."""
    kinds = {"gram": "<u8", "context": "<u8", "doc": "<i8", "form": "<i8", "start": "<i8", "count": "<i4", "known": "i1"}
    names = ["bucket", *SPAN, *WANTED]

    def run(batches):
        parts: dict[str, list[bytes]] = {name: [] for name in kinds}
        for batch in batches:
            spans = batch.filter(batch.column("span_doc").is_valid())
            if spans.num_rows:
                yield _blank(spans, names)
            sent = batch.filter(batch.column("gram").is_valid())
            for name in kinds:
                parts[name] += sent.column(name).to_pylist()
        gram, context, doc, form, start, count, known = (np.frombuffer(b"".join(parts[name]), kind) for name, kind in kinds.items())
        if not len(gram):
            return
        order = np.lexsort((context, gram))
        gram, context, doc, form, start, count, known = (x[order] for x in (gram, context, doc, form, start, count.astype(np.int64), known))
        fresh = np.r_[True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])]
        first = np.flatnonzero(fresh)
        times = np.diff(np.r_[first, len(gram)])
        again = np.repeat(times > 1, times) & (known == 0)
        yield from _spans(doc[again], form[again], start[again], (start + count - 1 + length)[again], buckets, names)
        heads = gram[first]
        anchors = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
        crowd = np.repeat(np.diff(np.r_[anchors, len(heads)]), np.diff(np.r_[anchors, len(heads)]))
        open_ = (times == 1) & (known[first] == 0)
        judged = np.repeat(np.add.reduceat(open_.astype(np.int64), anchors) > 0, np.diff(np.r_[anchors, len(heads)]))
        pick = (crowd > 1) & judged
        chosen = first[pick]
        for batch in postings(doc[chosen], [form[chosen], gram[chosen], start[chosen], count[chosen], open_[pick].astype(np.int8), crowd[pick]], buckets, WANTED):
            yield _blank(batch, names)

    return run


def _heads(doc: np.ndarray, form: np.ndarray) -> np.ndarray:
    """Where documents begin in rows sorted by document."""
    return np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (form[1:] != form[:-1])]) if len(doc) else np.empty(0, np.int64)


def _by_document(batches):
    """One row for each document: the wanted runs."""
    kinds = ("<i8", "<i8", "<u8", "<i8", "<i8", "i1", "<i8")
    parts: list[list[bytes]] = [[] for _ in kinds]
    for batch in batches:
        for column, values in zip(parts, batch.columns[1:], strict=True):
            column += values.to_pylist()
    doc, form, *rest = (np.frombuffer(b"".join(p), k) for p, k in zip(parts, kinds, strict=True))
    order = np.lexsort((form, doc))
    doc, form, rest = doc[order], form[order], [x[order] for x in rest]
    first = _heads(doc, form)
    ends = np.r_[first[1:], len(doc)][: len(first)]
    for a in range(0, len(first), 500):
        cut = list(zip(first[a : a + 500].tolist(), ends[a : a + 500].tolist(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(doc[first[a : a + 500]]), pa.array(form[first[a : a + 500]]), *[pa.array([x[i:j].tobytes() for i, j in cut], pa.binary()) for x in rest]], names=["doc", "form", *WANTED[2:]])


CONTEXT = "gram long, doc long, form long, start long, count long, open boolean, bytes binary"


def _contexts(length: int):
    """The bytes of the wanted runs; runs of crowded anchors are cut once more, by a second anchor."""

    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.binary())
            for row in range(batch.num_rows):
                whole, doc, form = text[row].as_py(), batch.column("doc")[row].as_py(), batch.column("form")[row].as_py()
                gram, start, count, judge, crowd = (np.frombuffer(batch.column(c)[row].as_py(), k) for c, k in zip(WANTED[2:], ("<u8", "<i8", "<i8", "i1", "<i8"), strict=True))
                out: list[tuple] = []
                for g, a, n, o, c in zip(gram.tolist(), start.tolist(), count.tolist(), judge.tolist(), crowd.tolist(), strict=True):
                    part = whole[a : a + n - 1 + length]
                    if c <= CROWD:
                        out.append((g, a, n, o, part))
                        continue
                    _, at, size, second, _ = runs(np.frombuffer(part, np.uint8), np.array([len(part)]), length, NARROW, 5)
                    keys = mix(second ^ U(g), 6)
                    out += [(k, a + i, m, o, part[i : i + m - 1 + length]) for k, i, m in zip(keys.tolist(), at.tolist(), size.tolist(), strict=True)]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(columns[0], U).view(np.int64)), pa.array([doc] * len(out), pa.int64()), pa.array([form] * len(out), pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array([bool(o) for o in columns[3]]), pa.array(columns[4], pa.binary())],
                    names=["gram", "doc", "form", "start", "count", "open", "bytes"],
                )

    return run


def bounded_order(text: np.ndarray, length: int) -> np.ndarray:
    """Places of ``text`` (symbols below 512) sorted by their first ``length`` symbols or more, by doubling."""
    n = len(text)
    padded = np.r_[text.astype(np.int64), np.zeros(7, np.int64)]
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = (key << 9) | padded[i : n + i]
    order = np.argsort(key, kind="stable")
    have = 7
    while True:
        sorted_key = key[order]
        rank_sorted = np.cumsum(np.r_[False, sorted_key[1:] != sorted_key[:-1]])
        if have >= length or rank_sorted[-1] == n - 1:
            return order
        rank = np.empty(n + have, np.int64)
        rank[order] = rank_sorted + 1
        rank[n:] = 0
        key = rank[:n] * (n + 2) + rank[have:]
        # only places that still have equals are sorted anew, within their slots
        same = np.r_[False, rank_sorted[1:] == rank_sorted[:-1]]
        same[:-1] |= same[1:]
        slots = np.flatnonzero(same)
        places = order[slots]
        order[slots] = places[np.argsort(key[places], kind="stable")]
        have *= 2


def repeated_suffixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``text`` in sorted order, and whether each and its successor share ``length`` symbols or more."""
    n = len(text)
    order = bounded_order(text, length)
    last = text[order - 1]  # the transform; the first place is preceded by the last one
    step = np.empty(n, np.int64)
    step[np.argsort(last, kind="stable")] = np.arange(n)  # where a place's predecessor stands
    changes = np.r_[np.flatnonzero(last[1:] != last[:-1]) + 1, n]
    run = np.searchsorted(changes, np.arange(n), side="right")  # the transform's run at each place
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        same = run[low] == run[high - 1]
        a, b = low[same], high[same]
        next_low, next_high = step[a], step[b - 1] + 1
        a, b = low[~same], high[~same]
        if len(a):
            times = run[b - 1] - run[a] + 1
            owner = np.repeat(np.arange(len(a)), times)
            which = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times) + run[a][owner]
            ends = np.minimum(changes[which], b[owner])
            starts = np.maximum(np.where(which > 0, changes[which - 1], 0), a[owner])
            tag = owner * 512 + last[starts]
            by = np.argsort(tag, kind="stable")
            cut = np.flatnonzero(np.r_[True, tag[by][1:] != tag[by][:-1]])
            next_low = np.r_[next_low, step[starts[by[cut]]]]
            next_high = np.r_[next_high, step[ends[by[np.r_[cut[1:], len(by)] - 1]] - 1] + 1]
        keep = unset[next_high]
        low, high = next_low[keep], next_high[keep]
        unset[high] = False
        if not len(low):
            break
    return order, unset[1:]


def _block_spans(block: list[tuple], length: int):
    """(doc, form, start, end) of repeated windows among the contexts of one block."""
    sizes = np.array([len(b[5]) + 1 for b in block])
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"\0".join(b[5] for b in block) + b"\0", np.uint8).astype(np.int16) + 1
    text[ends - 1] = 0
    order, joined = repeated_suffixes(text, length)
    hit = np.zeros(len(text), bool)
    hit[order[joined]] = True
    hit[order[1:][joined[:-1]]] = True
    doc, form, start, count, judge = (np.array([b[i] for b in block], np.int64) for i in range(5))
    begin = ends - sizes
    owner = np.repeat(np.arange(len(block)), sizes)
    inside = np.arange(len(text)) - begin[owner]
    hit &= (inside < count[owner]) & (judge[owner] == 1)
    at = np.flatnonzero(hit)
    if not len(at):
        return None
    first = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at][1:] != owner[at][:-1])]
    a, b = at[first], at[np.r_[first[1:], True]]
    return doc[owner[a]], form[owner[a]], start[owner[a]] + inside[a], start[owner[b]] + inside[b] + length


def _expanded(length: int, buckets: int):
    def run(batches):
        block, size, now = [], 0, None

        def done():
            found = _block_spans(block, length) if len(block) > 1 else None
            if found:
                yield from postings(found[0], list(found[1:]), buckets, SPAN)

        for batch in batches:
            for gram, doc, form, start, count, judge, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if gram != now and size >= BLOCK:
                    yield from done()
                    block, size = [], 0
                now = gram
                block.append((doc, form, start, count, int(judge), text))
                size += len(text)
        yield from done()

    return run


def _merged(batches):
    """One row for each document that loses bytes: its maximal removed runs."""
    parts: list[list[bytes]] = [[], [], [], []]
    for batch in batches:
        for column, values in zip(parts, batch.columns[1:], strict=True):
            column += values.to_pylist()
    doc, form, start, end = (np.frombuffer(b"".join(p), "<i8") for p in parts)
    order = np.lexsort((start, form, doc))
    doc, form, start, end = doc[order], form[order], start[order], end[order]
    first = _heads(doc, form)
    rows: list[tuple] = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(doc)][: len(first)], strict=True):
        reach = np.maximum.accumulate(end[a:b])
        fresh = np.r_[True, start[a + 1 : b] > reach[:-1]]
        rows.append((int(doc[a]), int(form[a]), start[a:b][fresh].tobytes(), reach[np.r_[fresh[1:], True]].tobytes()))
    for i in range(0, len(rows), 1000):
        cut = rows[i : i + 1000]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in cut], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["doc", "form", "starts", "ends"])


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.col(text).cast("binary")
    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(whole).alias("form"), whole.alias("text")).where("doc is not null")


def repeated_spans(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc, form, starts, ends; packed 64-bit offsets): the maximal runs of bytes that strings of ``length`` bytes cover
    which also start elsewhere, in the same or another document. Documents without any have no row.

    Texts are UTF-8 bytes; null is empty; texts shorter than ``length`` have no such string. Rows without an id are left
    out. Rows with one id and one text are copies of each other; other texts of one id are documents of their own, told
    apart by ``form``, the hash of the text. Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark, 200)
    parts = deals(spark)
    buckets = 4 * parts
    texts = _texts(docs, doc_id, text)
    sent = texts.select(F.struct("doc", "form"), "text").mapInArrow(_runs_of_task(length, buckets), SENT)
    met = settle(sent.repartition(parts, "bucket").mapInArrow(_met_runs(length, buckets), MET), "repeat-runs")
    wanted = met.where("want_doc is not null").select("bucket", *WANTED)
    listed = wanted.repartition(parts, "bucket").mapInArrow(_by_document, "doc long, form long, " + ", ".join(f"{c} binary" for c in WANTED[2:]))
    contexts = texts.join(listed.hint("merge"), ["doc", "form"]).mapInArrow(_contexts(length), CONTEXT)
    spread = contexts.repartition(parts, "gram").sortWithinPartitions("gram")
    found = spread.select("gram", "doc", "form", "start", "count", "open", "bytes").mapInArrow(_expanded(length, buckets), "bucket long, " + ", ".join(f"{c} binary" for c in SPAN))
    spans = met.where("span_doc is not null").select("bucket", *SPAN).unionByName(found)
    return spans.repartition(parts, "bucket").mapInArrow(_merged, "doc long, form long, starts binary, ends binary")


def _digests(batches):
    for batch in batches:
        out = []
        for doc, text, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            text = text or b""
            if starts is None:
                out.append((doc, len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            a, b = np.frombuffer(starts, "<i8").tolist(), np.frombuffer(ends, "<i8").tolist()
            kept = hashlib.sha256()
            for i, j in zip([0, *b], [*a, len(text)], strict=True):
                kept.update(text[i:j])
            out.append((doc, len(text), sum(b) - sum(a), len(a), kept.hexdigest()))
        columns = list(zip(*out, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs, and the digest of what is left (see repeated_spans)."""
    spans = repeated_spans(docs, length)
    texts = _texts(docs, "doc_id", "text")
    return texts.join(spans.hint("merge"), ["doc", "form"], "left").select("doc", "text", "starts", "ends").mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

"""Line dedup: winnowing over line hashes.

A document is the sequence of its lines; lines of white space alone do not count, and a line stands for one place for
every 25 words it begins. A repeated run has three places or more: three lines, or one of more than 50 words. Pairs of
neighbouring places are hashed; of the two pairs in each window of three places the smaller is its fingerprint, so every
repeated run is sure to have one. Fingerprints with equal positions and neighbours are matched, which extends each match
to both sides; matched windows that overlap are one run. Every occurrence but the first (by document, then place) is
deleted, as whole lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import _SPACE, U, deals, documents_of, mix, packed, postings, prefix_sums, ready, settle, span_hashes, unpacked

WORDS = 25  # words for which a line gets one more place
RUN = 3  # places of the shortest run
FLUSH = 1 << 20
PLACE = ["doc", "form", "at"]  # where a window lies: document, hash of its text, place


def places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all places in order: the text, the line's number in it, the hash."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    closes = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    owner = np.searchsorted(closes, ends)
    number = np.arange(len(ends)) - np.searchsorted(owner, np.arange(len(texts)))[owner]
    letters = np.r_[0, np.cumsum(~_SPACE[data])]
    gaps = np.r_[0, np.cumsum(data == 32)]
    full = letters[ends] > letters[starts]
    starts, ends, owner, number = starts[full], ends[full], owner[full], number[full]
    hashes = span_hashes(prefix_sums(data), starts, ends)
    times = (gaps[ends] - gaps[starts] + WORDS) // WORDS
    turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(owner, times), np.repeat(number, times), mix(np.repeat(hashes, times), 21) + mix(turn.astype(U), 22)


def windows(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of three places, and what matches them: fingerprint, its side, the neighbour on the other."""
    if len(owner) < RUN:
        return np.empty(0, np.int64), np.empty(0, U)
    pairs = mix(mix(hashes[:-1], 23) + hashes[1:], 24)
    left = pairs[:-1] <= pairs[1:]
    key = mix(np.where(left, pairs[:-1], pairs[1:]) + mix(np.where(left, hashes[2:], hashes[:-2]), 25) + left.astype(U), 26)
    at = np.flatnonzero(owner[:-2] == owner[2:])
    return at, key[at]


def _distinct(key: np.ndarray, doc: np.ndarray, form: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows by key and place, each place once: repeated rows of a document give the same places."""
    order = np.lexsort((at, form, doc, key))
    sorted_ = [x[order] for x in (key, doc, form, at)]
    new = np.r_[True, np.any([x[1:] != x[:-1] for x in sorted_], axis=0)] if len(key) else np.empty(0, bool)
    return tuple(x[new] for x in sorted_)


def _windows_of_task(buckets: int):
    """The first occurrence of each window in the task; later ones are marked at once."""

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            key, doc, form, at = _distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))
            first = np.r_[True, key[1:] != key[:-1]]
            yield from postings(key[first], [doc[first], form[first], at[first], np.zeros(first.sum(), np.int8)], buckets, ["key", *PLACE, "late"])
            yield from postings(doc[~first], [doc[~first], form[~first], at[~first], np.ones((~first).sum(), np.int8)], buckets, ["key", *PLACE, "late"])

        for ids, texts in documents_of(batches):
            owner, _, hashes = places(texts)
            at, key = windows(owner, hashes)
            first = np.searchsorted(owner, np.arange(len(texts)))
            doc, form = np.array([(i["doc"], i["form"]) for i in ids], np.int64).T
            held.append((key, doc[owner[at]], form[owner[at]], at - first[owner[at]]))
            size += len(at)
            if size >= FLUSH:
                yield from flush()
                held.clear()
                size = 0
        if size:
            yield from flush()

    return run


def _later(buckets: int):
    """Windows that have an earlier occurrence, by document and text."""

    def run(batches):
        got = unpacked(batches, {"key": "<u8", "doc": "<i8", "form": "<i8", "at": "<i8", "late": "i1"})
        late = got["late"] == 1
        key, *place = _distinct(*(got[c][~late] for c in ("key", *PLACE)))
        again = np.r_[False, key[1:] == key[:-1]] if len(key) else np.empty(0, bool)
        doc, form, at = (np.r_[got[c][late], x[again]] for c, x in zip(PLACE, place, strict=True))
        yield from postings(doc, [form, at], buckets, PLACE)

    return run


def _by_document(batches):
    got = unpacked(batches, {"doc": "<i8", "form": "<i8", "at": "<i8"})
    order = np.lexsort((got["at"], got["form"], got["doc"]))
    doc, form, at = (got[c][order] for c in PLACE)
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (form[1:] != form[:-1])]) if len(doc) else np.empty(0, np.int64)
    cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(doc)][: len(first)], strict=True))
    yield pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(form[first]), pa.array([at[a:b].tobytes() for a, b in cuts], pa.binary())], names=["doc", "form", "starts"])


def _kept(batches):
    """The text without the lines under the marked windows; how many lines there were and how many went."""
    for batch in batches:
        out = []
        for text, starts in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            whole = (text or "").encode()
            lines = sum(bool(line.strip()) for line in whole.split(b"\n"))
            if starts is None:
                out.append((text, lines, 0))
                continue
            _, number, _ = places([whole])
            at = np.frombuffer(starts, "<i8")
            gone = set(np.unique(number[(at[:, None] + np.arange(RUN)).ravel()]).tolist())
            out.append((b"\n".join(x for i, x in enumerate(whole.split(b"\n")) if i not in gone).decode(), lines, len(gone)))
        columns = list(zip(*out, strict=True)) or [()] * 3
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *arrays], names=[*batch.schema.names[:-2], "kept_text", "n_lines", "n_removed"])


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with kept_text, n_lines (not blank) and n_removed; later occurrences of repeated runs of lines are gone.

    A null text has no lines and stays null. Rows without an id stay as they are. Rows with equal id and text count as
    one; other texts of one id are documents of their own. An empty table gives no rows. All other columns are kept, whatever their names; a column that is called as one
    of the three new ones is replaced.
    """
    spark = docs.sparkSession
    ready(spark)
    parts = deals(spark)
    buckets = 4 * parts
    doc, form = F.col(doc_id).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("form")
    texts = docs.where(doc.isNotNull()).select(F.struct(doc, form), F.col(text).alias("text"))
    sent = texts.mapInArrow(_windows_of_task(buckets), packed("key", *PLACE, "late"))
    late = sent.repartition(parts, "bucket").mapInArrow(_later(buckets), packed(*PLACE))
    marks = settle(late.repartition(parts, "bucket").mapInArrow(_by_document, "doc long, form long, starts binary"), "line-marks")
    rest = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_removed")]
    inner = [f"c{i}" for i in range(len(rest))]
    # neutral names meanwhile, so that no column of the input clashes with ours
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, inner, strict=True)], doc, form, F.col(text).alias("whole"))
    joined = plain.join(marks.hint("merge"), ["doc", "form"], "left").select(*inner, "whole", "starts")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.select(*inner).schema.fields)
    done = joined.mapInArrow(_kept, shape + ", kept_text string, n_lines long, n_removed long")
    return done.select(*[F.col(n).alias(c) for c, n in zip(rest, inner, strict=True)], "kept_text", "n_lines", "n_removed")


def digest(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents WHERE doc_id IS NOT NULL
), full_lines AS (
    SELECT *, (length(line) - length(replace(line, ' ', '')) + 25) // 25 AS times FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), spread AS (
    SELECT doc_id, i, line, unnest(range(times)) AS j FROM full_lines
), marked AS (
    SELECT doc_id, i, row_number() OVER w AS place, hash(line, j) AS a, lead(hash(line, j), 1) OVER w AS b, lead(hash(line, j), 2) OVER w AS c,
        lead(i, 1) OVER w AS i1, lead(i, 2) OVER w AS i2
    FROM spread WINDOW w AS (PARTITION BY doc_id ORDER BY i, j)
), late AS (
    SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, place) AS turn FROM marked WHERE i2 IS NOT NULL
), gone AS (
    SELECT DISTINCT doc_id, unnest([i, i1, i2]) AS i FROM late WHERE turn > 1
)
SELECT l.doc_id, count(f.i) AS n_lines, count(g.i) AS n_removed,
    sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN full_lines f ON f.doc_id = l.doc_id AND f.i = l.i LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
GROUP BY l.doc_id
"""

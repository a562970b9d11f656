"""Toxicity: a counterfactual-regularised logistic classifier of whole texts.

Features are the words of a text and their beginnings, present or not. Every labelled text that names a group is paired
with its counterfactual, in which each group's name is swapped for another's, and the squared difference of the two
scores (before the logistic function) is added to the loss: naming a group must not move a score. Features are chosen
by their counts over the training rows, the model is fitted on a bounded sample of them, and all documents are scored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import _LOWER, U, deals, mix, packed, postings, prefix_sums, ready, settle, span_hashes, unpacked

SAMPLE = 20_000  # labelled rows that the model is fitted on, chosen by hash
FEATURES = 20_000  # features at most, those that tell the classes apart best
HOLDERS, SCORE = 4, 3.0  # training rows that must hold a feature; its least z-score
STARTS = (4, 5, 6)  # bytes of the beginnings
PENALTY, DECAY, STEPS = 1.0, 1e-3, 400
# fixed values: names of groups; a name is swapped for the next one of its line
GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "natives"), ("deaf", "blind", "disabled"), ("old", "young"),
    ("africans", "europeans", "americans", "asians"), ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
SWAPS = {name.encode(): line[(i + 1) % len(line)].encode() for line in GROUPS for i, name in enumerate(line)}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (letters, digits and all beyond ASCII) and of their beginnings; the text of each."""
    data = np.frombuffer(b" ".join(texts).translate(_LOWER) + b" ", np.uint8)
    ends_of = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    edge = np.diff(_LETTER[data].view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(ends_of, start, side="right")
    sums = prefix_sums(data)
    hashes, owners = [mix(span_hashes(sums, start, end), 1)], [owner]
    for size in STARTS:
        longer = end - start > size
        hashes.append(mix(span_hashes(sums, start[longer], start[longer] + size), 2))
        owners.append(owner[longer])
    return np.concatenate(hashes), np.concatenate(owners)


def distinct(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[keep], owners[keep]


def swapped(text: bytes) -> bytes | None:
    """The text with each group's name swapped; None if it names none."""
    folded = text.translate(_LOWER)
    if not any(name in folded for name in SWAPS):
        return None
    data = np.frombuffer(folded + b" ", np.uint8)
    edge = np.diff(_LETTER[data].view(np.int8), prepend=np.int8(0))
    out, last = [], 0
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        if (other := SWAPS.get(folded[a:b])) is not None:
            out += [folded[last:a], other]
            last = b
    return b"".join([*out, folded[last:]]) if out else None


@dataclass
class Model:
    """Sorted feature hashes, their weights, the bias; ``logits`` scores texts."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    maybe: np.ndarray = field(init=False)

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)  # which leading bits occur at all: most words stop here
        self.maybe[self.features >> U(44)] = True

    def known(self, hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known features that each text holds, each once."""
        keep = self.maybe[hashes >> U(44)]
        hashes, owners = hashes[keep], owners[keep]
        at = np.searchsorted(self.features, hashes)
        keep = self.features[np.minimum(at, len(self.features) - 1)] == hashes if len(self.features) else np.zeros(len(hashes), bool)
        return distinct(at[keep].astype(U), owners[keep])

    def logits(self, texts: list[bytes]) -> np.ndarray:
        at, owner = self.known(*features(texts))
        return self.bias + np.bincount(owner, self.weights[at.astype(np.int64)], minlength=len(texts))


def _counted(buckets: int):
    """How many toxic and other texts of the task hold each feature."""

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), bool)
            texts = [(t or "").encode() for t in batch.column(0).to_pylist()]
            hashes, owners = distinct(*features(texts)) if texts else (np.empty(0, U), np.empty(0, np.int64))
            held.append((hashes, toxic[owners].astype(np.int64), (~toxic[owners]).astype(np.int64)))
        if held:
            hashes, bad, good = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield from postings(hashes, [bad, good], buckets, ["key", "bad", "good"])

    return run


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return (keys[starts], *(np.add.reduceat(c[order], starts) if len(starts) else c for c in counts))


def _telling(bad_rows: int, good_rows: int):
    """Features by the z-score of the difference between the classes' shares that hold them."""

    def run(batches):
        got = unpacked(batches, {"key": "<u8", "bad": "<i8", "good": "<i8"})
        keys, bad, good = _summed(got["key"], got["bad"], got["good"])
        both = (bad + good + 1) / (bad_rows + good_rows + 2)
        z = (bad / bad_rows - good / good_rows) / np.sqrt(both * (1 - both) * (1 / bad_rows + 1 / good_rows))
        keep = (bad + good >= HOLDERS) & (np.abs(z) >= SCORE)
        yield pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(np.abs(z[keep]))], names=["feature", "z"])

    return run


def _held(model: Model):
    """Known features of each training text and of its counterfactual."""

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(0).to_pylist()]
            if not texts:
                continue
            others = [swapped(t) for t in texts]
            rows = [model.known(*features(x)) for x in (texts, [o if o is not None else t for o, t in zip(others, texts, strict=True)])]
            lists = [[at[owner == i].astype(np.int64).tolist() for i in range(len(texts))] for at, owner in rows]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lists[0], pa.list_(pa.int64())), pa.array(lists[1], pa.list_(pa.int64()))], names=["toxic", "held", "other"])

    return run


def train(labels: np.ndarray, held: list[list[int]], other: list[list[int]], size: int) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps on log-loss, decay, and the counterfactual penalty."""
    def sparse(rows):
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.fromiter((f for r in rows for f in r), np.int64)

    (row, col), (row2, col2) = sparse(held), sparse(other)
    n = len(labels)
    paired = np.array([a != b for a, b in zip(held, other, strict=True)], bool)
    rare = np.sqrt(max(1.0, (n - labels.sum()) / max(1.0, labels.sum())))  # the rare class counts for more, by a root
    weigh = np.where(labels == 1, rare, 1.0)
    weights, bias = np.zeros(size), float(np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5)))
    square, first, square_b, first_b = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(row, weights[col], minlength=n)
        gap = np.where(paired, z - bias - np.bincount(row2, weights[col2], minlength=n), 0.0)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * weigh
        slope = np.bincount(col, (error + 2 * PENALTY * gap)[row], minlength=size) - np.bincount(col2, (2 * PENALTY * gap)[row2], minlength=size)
        slope = slope / n + DECAY * weights / max(1, n) ** 0.5
        slope_b = error.mean()
        first, square = 0.9 * first + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        first_b, square_b = 0.9 * first_b + 0.1 * slope_b, 0.999 * square_b + 0.001 * slope_b**2
        rate = 0.1 / (1 - 0.9**step) * np.sqrt(1 - 0.999**step)
        weights = weights - rate * first / (np.sqrt(square) + 1e-8)
        bias -= rate * first_b / (np.sqrt(square_b) + 1e-8)
    return weights, float(bias)


def _trained(size: int):
    def run(batches):
        labels, held, other = [], [], []
        for batch in batches:
            for column, values in zip((labels, held, other), batch.columns, strict=True):
                column += values.to_pylist()
        weights, bias = train(np.array(labels, float), held, other, size) if labels else (np.zeros(size), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([*range(size), -1], pa.int64()), pa.array([*weights.tolist(), bias])], names=["place", "weight"])

    return run


def in_training(doc_id: str = "doc_id"):
    """Whether labels of this document may be learned from; the others are held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) != 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1), training rows only.

    Labels that are null count for nothing; a document with several labels is toxic if one says so. Without rows of both
    classes all scores are the training rows' share of toxic ones, or 0 without any.
    """
    spark = docs.sparkSession
    ready(spark)
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(in_training())
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # the sample's size is bounded, so its ids may go to every task
    rows = settle(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic"), "toxic-sample")
    found = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    bad, good = found.bad, found.n - found.bad
    if not bad or not good:
        return Model(np.empty(0, U), np.empty(0), 40.0 if bad else -40.0)
    parts = deals(spark)
    counted = rows.mapInArrow(_counted(4 * parts), packed("key", "bad", "good")).repartition(parts, "bucket")
    telling = counted.mapInArrow(_telling(bad, good), "feature long, z double").orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    model = Model(np.sort(np.array([r.feature for r in telling], np.int64).view(U)), np.zeros(len(telling)), 0.0)
    held = settle(rows.mapInArrow(_held(model), "toxic int, held array<long>, other array<long>"), "toxic-held")
    fitted = {r.place: r.weight for r in held.coalesce(1).mapInArrow(_trained(len(telling)), "place long, weight double").collect()}
    return Model(model.features, np.array([fitted[i] for i in range(len(telling))]), fitted[-1])


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(batch.num_columns - 1).to_pylist()]
            out, i = [], 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and size < 1 << 20:
                    size += len(texts[j])
                    j += 1
                out.append(model.logits(texts[i:j]))
                i = j
            z = np.clip(np.concatenate(out) if out else np.empty(0), -40, 40)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(1 / (1 + np.exp(-z)))], names=[*batch.schema.names[:-1], "score"])

    return run


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5); a null or empty text gets the bias' score.

    All rows and columns stay, whatever their names; columns called score or predicted are replaced. An empty table
    gives no rows.
    """
    ready(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    inner = [f"c{i}" for i in range(len(rest))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, inner, strict=True)], F.col(f"`{text}`").alias("whole"))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    done = plain.mapInArrow(_scored(model), shape + ", score double")
    return done.select(*[F.col(n).alias(c) for c, n in zip(rest, inner, strict=True)], "score", F.expr("if(score >= 0.5, 1, 0)").alias("predicted"))

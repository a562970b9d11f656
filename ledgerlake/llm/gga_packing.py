"""Best-fit packing by a grouping genetic algorithm on islands.

A document's tokens and one end token are cut into pieces of the sequence length; full pieces are sequences of their
own. The other pieces are dealt by hash into blocks. Each block is evolved on several islands (rows of one table, each a
population of packings): a child takes whole well-filled bins from one parent, the other parent's bins that hold any of
the same pieces are dissolved, and the displaced pieces go by best fit, longest first, into what room is left. Between
epochs the best packing of each island moves to the next one. Bins that are not full at the end are handed, a bounded
number from each block, to the next level, where sixteen blocks meet, until one block is left.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import documents_of, ready, settle

CACHE = 500_000  # chunks of text whose ids a worker keeps
BLOCK = 16_384  # pieces evolved together
FAN = 16  # blocks that meet at the next level
HANDED = 64  # bins that a block hands on
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 4, 4


class Chunks:
    """Token ids of texts, chunk by chunk.

    A tokenizer that never joins what white space parts, nor a letter and a full stop or comma after it, and that
    lower-cases needs to encode each chunk between these borders only once. Texts that spell a special token go through
    whole; so do all texts of any other tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        words = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(words.values()) + 1, bool)
        self.closing[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.parted = self.whole(b"Word.  two, Ab\tone\nx") == [i for part in (b"word", b".", b"two", b",", b"ab", b"one", b"x") for i in self.whole(part)]
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {b"\n ": 0, b" ": 1}
        # entry 0 is the end token, entry 1 has no tokens
        self.ids, self.first, self.size = np.zeros(1, np.uint32), np.array([0, 1]), np.array([1, 0])

    def whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids

    def encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks and how many each has. Chunks of letters are one word, which ends with a closing id, so
        many go through at a time."""
        if chunks and all(map(str.isalpha, chunks)):
            joined = [self.tokenizer.encode(" ".join(chunks[i : i + 500]), add_special_tokens=False).ids for i in range(0, len(chunks), 500)]
            ids = np.fromiter((i for got in joined for i in got), np.uint32)
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(chunks):
                return ids, np.diff(np.r_[0, ends])
        got = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        return np.fromiter((i for ids in got for i in ids), np.uint32), np.array([len(ids) for ids in got], np.int64)

    def learn(self, chunks: list[bytes]) -> None:
        texts = [c[:-1].decode("utf-8") for c in chunks]
        letters = [t.isalpha() for t in texts]
        for kind in (True, False):
            fresh = [(c, t) for c, t, alpha in zip(chunks, texts, letters, strict=True) if alpha == kind]
            ids, size = self.encoded([t for _, t in fresh])
            start = len(self.first)
            self.known.update((c, start + i) for i, (c, _) in enumerate(fresh))
            self.first = np.r_[self.first, len(self.ids) + np.cumsum(size) - size].astype(np.int64)
            self.size = np.r_[self.size, size].astype(np.int64)
            self.ids = np.r_[self.ids, ids]

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by id 0; and where each text's ids end."""
        odd = {i for i, t in enumerate(texts) if not self.parted or b"<" in t and any(s in t.translate(_FOLD) for s in self.specials)}
        # a text's line feeds only part chunks, as spaces do
        data = _borders(b"".join((b"" if i in odd else t.replace(b"\n", b" ")) + b" \n " for i, t in enumerate(texts)))
        offsets = np.r_[0, np.flatnonzero(data == 32) + 1].astype(np.int64)
        parted = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        chunks = parted.dictionary.to_pylist()
        if len(self.known) > CACHE:
            self.clear()
        if missing := [c for c in chunks if c not in self.known]:
            self.learn(missing)
        entry = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        which = entry[parted.indices.to_numpy()]
        sizes = self.size[which]
        ends = np.cumsum(sizes)
        out = self.ids[np.repeat(self.first[which] - (ends - sizes), sizes) + np.arange(ends[-1])]
        closes = ends[which == 0]
        if not odd:
            return out, closes
        parts = [np.r_[np.array(self.whole(t), np.uint32), np.uint32(0)] if i in odd else out[a:b] for i, (t, a, b) in enumerate(zip(texts, np.r_[0, closes[:-1]], closes, strict=True))]
        return np.concatenate(parts).astype(np.uint32), np.cumsum([len(p) for p in parts])


_KEPT: dict[str, Chunks] = {}


def chunks_of(path: str) -> Chunks:
    """The worker's tokenizer, kept from task to task; the chunks that it knows go with the task, since idle workers
    would hold on to them."""
    if path not in _KEPT:
        _KEPT[path] = Chunks(path)
    return _KEPT[path]


_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _borders(joined: bytes) -> np.ndarray:
    """A-Z lower-cased, with a space between a letter and a full stop or comma that ends a chunk."""
    data = np.frombuffer(joined.translate(_FOLD), np.uint8)
    mark = (data == 46) | (data == 44)
    after = np.r_[data[1:], np.uint8(32)]
    before = np.r_[np.uint8(32), data[:-1]]
    return np.insert(data, np.flatnonzero(mark & (after == 32) & (before >= 97) & (before <= 122)), 32)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, most: int):
    def run(batches):
        chunks = chunks_of(path)
        for ids, texts in documents_of(batches, 4 << 20):
            tokens, ends = chunks(texts)
            tokens = np.ascontiguousarray(tokens, "<u4")
            rows = []
            for doc, a, b in zip(ids, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                for piece, at in enumerate(range(a, b, most)):
                    stop = min(at + most, b)
                    rows.append((doc, piece, at - a, stop - at, zlib.crc32(tokens[at:stop])))
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        chunks.clear()

    return run


class Room:
    """Bins by room left; ``fit`` puts a piece into the bin that it fills best, or a new one."""

    def __init__(self, most: int):
        self.most, self.bins, self.mask = most, [[] for _ in range(most + 1)], 0

    def add(self, name: int, room: int) -> None:
        if room > 0:
            self.bins[room].append(name)
            self.mask |= 1 << room

    def fit(self, size: int) -> tuple[int, int]:
        over = self.mask >> size
        if not over:
            return -1, self.most
        room = size + (over & -over).bit_length() - 1
        name = self.bins[room].pop()
        if not self.bins[room]:
            self.mask &= ~(1 << room)
        return name, room


def best_fit(sizes: list[int], order, most: int, into: np.ndarray, fill: list[int]) -> None:
    """Put the pieces of ``order`` into bins of ``fill``, which grows; ``into`` gets each piece's bin."""
    room = Room(most)
    for name, full in enumerate(fill):
        if full:
            room.add(name, most - full)
    for item in order:
        size = sizes[item]
        name, left = room.fit(size)
        if name < 0:
            name, left = len(fill), most
            fill.append(0)
        into[item] = name
        fill[name] += size
        room.add(name, left - size)


def packing(sizes: np.ndarray, order, most: int) -> np.ndarray:
    into, fill = np.full(len(sizes), -1, np.int64), []
    best_fit(sizes.tolist(), order, most, into, fill)
    return into


def worth(sizes: np.ndarray, into: np.ndarray, most: int) -> tuple[int, float]:
    """Bins used, then how unevenly they are filled: fewer and fuller bins are better (smaller)."""
    fill = np.bincount(into, sizes)
    fill = fill[fill > 0]
    return len(fill), -float(np.square(fill / most).sum())


def crossover(sizes: np.ndarray, mine: np.ndarray, other: np.ndarray, most: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``other`` go into ``mine``; bins that share pieces with them are dissolved."""
    fill = np.bincount(other, sizes)
    good = np.flatnonzero(fill >= np.quantile(fill[fill > 0], 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, len(good) // 2), replace=False)] = True
    taken = chosen[other]
    dissolved = np.zeros(int(mine.max()) + 1, bool)
    dissolved[mine[taken]] = True
    stay = ~dissolved[mine]
    child = np.full(len(sizes), -1, np.int64)
    names, child_stay = np.unique(mine[stay], return_inverse=True)
    child[stay] = child_stay
    new, child_taken = np.unique(other[taken], return_inverse=True)
    child[taken] = child_taken + len(names)
    placed = child >= 0
    filled = np.bincount(child[placed], sizes[placed], minlength=len(names) + len(new)).astype(np.int64).tolist()
    displaced = np.flatnonzero(~placed)
    best_fit(sizes.tolist(), displaced[np.argsort(-sizes[displaced], kind="stable")].tolist(), most, child, filled)
    return child


def evolve(sizes: np.ndarray, people: list[np.ndarray], most: int, rng: np.random.Generator) -> list[np.ndarray]:
    """A population after some generations; it ends early at the bound that no packing can beat."""
    least = -(-int(sizes.sum()) // most)
    people = sorted(people, key=lambda p: worth(sizes, p, most))
    for _ in range(GENERATIONS):
        if worth(sizes, people[0], most)[0] <= least or len(people) < 2:
            break
        children = []
        for _ in range(POPULATION):
            a, b = rng.choice(len(people), 2, replace=False)
            children.append(crossover(sizes, people[a], people[b], most, rng))
        people = sorted([*people, *children], key=lambda p: worth(sizes, p, most))[:POPULATION]
    return people


def _first_people(sizes: np.ndarray, island: int, most: int, rng: np.random.Generator) -> list[np.ndarray]:
    """The first island starts from best fit, longest first; all have packings of shaken orders."""
    down = np.argsort(-sizes, kind="stable")
    people = [packing(sizes, down.tolist(), most)] if island == 0 else []
    if people and worth(sizes, people[0], most)[0] <= -(-int(sizes.sum()) // most):
        return people
    while len(people) < POPULATION:
        shaken = np.argsort(-sizes * rng.uniform(0.8, 1.25, len(sizes)), kind="stable")
        people.append(packing(sizes, shaken.tolist(), most))
    return people


ISLAND = "block long, island int, epoch int, lengths binary, people array<binary>"


def _epoch(most: int, epoch: int):
    def run(batches):
        for batch in batches:
            out = []
            for block, island, lengths, people in zip(*[batch.column(c).to_pylist() for c in ("block", "island", "lengths", "people")], strict=True):
                sizes = np.frombuffer(lengths, "<i4").astype(np.int64)
                rng = np.random.default_rng([block, island, epoch])
                born = [np.frombuffer(p, "<i4").astype(np.int64) for p in people or []] or _first_people(sizes, island, most, rng)
                out.append((block, island, lengths, [p.astype("<i4").tobytes() for p in evolve(sizes, born, most, rng)]))
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["block", "island", "lengths", "people"])

    return run


def _best(most: int):
    """Of the rows of a block (best first in ``people``), how good each island's best packing is."""

    def run(batches):
        for batch in batches:
            rows = [(block, *worth(s := np.frombuffer(lengths, "<i4").astype(np.int64), np.frombuffer(people[0], "<i4").astype(np.int64), most), people[0]) for block, lengths, people in zip(*[batch.column(c).to_pylist() for c in ("block", "lengths", "people")], strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.binary()), strict=True)], names=["block", "bins", "uneven", "packing"])

    return run


ITEM = {"doc_id": "<i8", "piece": "<i4", "length": "<i4", "start": "<i8", "ids_crc32": "<i8"}
INSTANCE = "block long, " + ", ".join(f"{name} binary" for name in ITEM)


def _instances(batches):
    """One row for each block from rows that are sorted by block: its pieces, longest first."""
    now, held = None, []

    def done():
        columns = zip(*held, strict=True)
        packed = [pa.array([np.array(c, kind).tobytes()], pa.binary()) for c, kind in zip(columns, ITEM.values(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), *packed], names=["block", *ITEM])

    for batch in batches:
        for block, *item in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if block != now and held:
                yield done()
                held = []
            now = block
            held.append(item)
    if held:
        yield done()


PLACED = "doc_id long, piece int, length long, start long, ids_crc32 long, block long, bin long, offset long, handed boolean"


def _placed(most: int, last: bool):
    """Every piece's bin and offset; the emptiest bins of a block are handed on, except at the last level."""

    def run(batches):
        for batch in batches:
            for block, chosen, *blobs in zip(*[batch.column(c).to_pylist() for c in ("block", "packing", *ITEM)], strict=True):
                item = {name: np.frombuffer(blob, kind) for blob, (name, kind) in zip(blobs, ITEM.items(), strict=True)}
                sizes, into = item["length"].astype(np.int64), np.frombuffer(chosen, "<i4").astype(np.int64)
                fill = np.bincount(into, sizes)
                open_ = np.zeros(len(fill), bool)
                if not last:
                    free = np.flatnonzero((fill > 0) & (fill < most))
                    open_[free[np.argsort(fill[free], kind="stable")[:HANDED]]] = True
                order = np.argsort(into, kind="stable")
                ends = np.cumsum(sizes[order])
                first = np.r_[True, into[order][1:] != into[order][:-1]]
                base = (ends - sizes[order])[first][np.cumsum(first) - 1]
                offset = np.empty(len(sizes), np.int64)
                offset[order] = ends - sizes[order] - base
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item["doc_id"]), pa.array(item["piece"]), pa.array(sizes), pa.array(item["start"]), pa.array(item["ids_crc32"]), pa.array(np.full(len(sizes), block)), pa.array(into), pa.array(offset), pa.array(open_[into])],
                    names=[part.split()[0] for part in PLACED.split(", ")],
                )

    return run


def _packed_blocks(items: DataFrame, blocks: int, most: int, level: int, last: bool) -> DataFrame:
    """The pieces (doc_id, piece, length, block) with bins, by the best packing that the islands find for each block."""
    sorted_items = items.repartition(blocks, "block").sortWithinPartitions("block", F.desc("length"), "doc_id", "piece")
    instances = settle(sorted_items.select("block", *ITEM).mapInArrow(_instances, INSTANCE), f"packing-{level}")
    islands = instances.select("block", F.col("length").alias("lengths"), F.explode(F.expr(f"sequence(0, {ISLANDS - 1})")).alias("island"), F.expr("cast(null as array<binary>)").alias("people"))
    shape = "block long, island int, lengths binary, people array<binary>"
    for epoch in range(EPOCHS):
        if epoch:
            arrivals = islands.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.expr("people[0]").alias("guest"))
            islands = islands.join(arrivals, ["block", "island"]).select("block", "island", "lengths", F.expr("concat(people, array(guest))").alias("people"))
        islands = settle(islands.repartition(blocks * ISLANDS, "block", "island").mapInArrow(_epoch(most, epoch), shape), f"packing-{level}")
    best = islands.mapInArrow(_best(most), "block long, bins long, uneven double, packing binary").groupBy("block").agg(F.min_by("packing", F.struct("bins", "uneven")).alias("packing"))
    return settle(instances.join(best, "block").mapInArrow(_placed(most, last), PLACED), f"packing-{level}")


def pack(docs: DataFrame, tokenizer: str, most: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset): each document's pieces and their places.

    ``tokenizer`` is the path of a tokenizer file that driver and executors can read. Null and empty texts are one piece
    of the end token alone. Rows without an id are left out. A row that is given twice is packed twice. An empty table
    gives no rows. ``docs`` may have more columns; they are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    pieces = settle(texts.mapInArrow(_pieces(tokenizer, most), PIECES), "pieces")
    short = pieces.where(F.col("length") < most)
    blocks = max(1, -(-short.count() // BLOCK))
    items = short.select(*ITEM, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).alias("block"))
    kept, level = None, 0
    while True:
        last = blocks == 1
        placed = _packed_blocks(items, blocks, most, level, last)
        # numbers of one level do not meet those of another, nor those of full pieces, which are odd
        number = ((F.lit(level).cast("long") + F.lit(64) * F.col("block")) * F.lit(1 << 24) + F.col("bin")) * 2
        done = placed.where("not handed").select("doc_id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset")
        kept = done if kept is None else kept.unionByName(done)
        if last:
            break
        blocks, level = -(-blocks // FAN), level + 1
        items = placed.where("handed").select(*ITEM, F.expr(f"block div {FAN}").alias("block"))
    full = pieces.where(F.col("length") == most).select("*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return kept.unionByName(full)

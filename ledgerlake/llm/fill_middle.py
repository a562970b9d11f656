"""Fill-in-middle by displacement scatter.

A batch of texts is one run of bytes. A scan finds the line cuts, and with them each text's prefix, middle and suffix. All
bytes of a part move by one distance: an array of differences holds, at the first byte of each part, by how much its
distance differs from that of the part before, and its cumulative sum is every byte's output shift. One scatter writes
all outputs of the batch, a second one the sentinels. To restore, the sentinels are found in the output, which gives the
same kind of differences over the restored bytes, and one gather reads them back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.columns import beside, pieces, strings

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of each sentinel
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], dtype=object)
STEP = 1 << 20  # bytes whose shifts are held at once


def marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the sentinels begin; none reaches over the end of a text."""
    if len(data) < MARK:
        return np.empty(0, np.int64)
    kind = data[1:-1]
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & (data[2:] == PREFIX[2]) & ((kind == PREFIX[1]) | (kind == SUFFIX[1]) | (kind == MIDDLE[1])))
    return at[at + MARK <= offsets[np.searchsorted(offsets, at, side="right")]]


def shifted(n: int, at: np.ndarray, shift: np.ndarray):
    """(first, end, shift of each byte) for consecutive steps over ``n`` bytes; parts begin at ``at``, in order, and move by
    ``shift``. Where several parts begin at one byte, the last one holds that byte."""
    change = np.diff(shift, prepend=0)
    held = 0
    for first in range(0, n, STEP):
        end = min(first + STEP, n)
        low, high = np.searchsorted(at, [first, end])
        steps = np.zeros(end - first, np.int64)
        np.add.at(steps, at[low:high] - first, change[low:high])
        steps[0] += held
        np.cumsum(steps, out=steps)
        held = steps[-1]
        yield first, end, steps


def line_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of lines of each text, the ends of all lines that a line feed closes, and the first of these in each text."""
    closed = np.flatnonzero(data == 10) + 1
    first = np.searchsorted(closed, offsets[:-1], side="right")
    count = np.searchsorted(closed, offsets[1:], side="right") - first
    open_end = np.diff(offsets) > 0
    open_end[open_end] = data[offsets[1:][open_end] - 1] != 10
    return count + open_end, closed, first


def code_points(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Code points between consecutive ``bounds``."""
    lead = np.append((data & 0xC0) != 0x80, False)
    sizes = np.diff(bounds)
    return np.where(sizes > 0, np.add.reduceat(lead, bounds[:-1], dtype=np.int64), 0) if len(sizes) else np.empty(0, np.int64)


def scattered(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, chosen: np.ndarray, spm: np.ndarray):
    """Outputs of a batch: bytes, offsets, form, lines, code points of prefix and middle."""
    start, end = offsets[:-1], offsets[1:]
    lines, closed, first = line_cuts(data, offsets)
    ends = np.append(closed, 0)  # the last is never read, but by texts without a cut

    def place(units: np.ndarray) -> np.ndarray:
        inner = (units > 0) & (units < lines)
        return np.where(units == 0, start, np.where(inner, ends[np.where(inner, first + units - 1, -1)], end))

    units = np.sort(draws % (lines + 1)[:, None], axis=1)
    one, two = place(units[:, 0]), place(units[:, 1])
    marked = np.zeros(len(start), bool)
    marked[np.searchsorted(offsets, marks(data, offsets), side="right") - 1] = True
    form = np.where((start == end) | marked | ~chosen, PLAIN, np.where(spm, SPM, PSM))
    moved = form > PLAIN
    out = np.concatenate([[0], np.cumsum(end - start + 3 * MARK * moved)])
    # where the parts and the sentinels lie in the output; a plain text is all prefix
    one, two = np.where(moved, one, end), np.where(moved, two, end)
    prefix, suffix, base = one - start, end - two, out[:-1]
    to_prefix = base + np.where(form == SPM, 2 * MARK + suffix, np.where(moved, MARK, 0))
    to_suffix = base + np.where(form == SPM, MARK, 2 * MARK + prefix)
    to_middle = base + 3 * MARK + prefix + suffix
    at = np.stack([start, one, two], axis=1).ravel()
    shift = (np.stack([to_prefix, to_middle, to_suffix], axis=1) - np.stack([start, one, two], axis=1)).ravel()
    result = np.empty(out[-1], np.uint8)
    for low, high, by in shifted(len(data), at, shift):
        result[np.arange(low, high) + by] = data[low:high]
    for mark, to in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        result[(to[moved] - MARK)[:, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    sizes = code_points(data, np.append(at, len(data))).reshape(-1, 3)
    return result, out, form, lines, sizes[:, 0], sizes[:, 1]


def gathered(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that outputs were made of: bytes and offsets."""
    moved = form > PLAIN
    at = marks(data, offsets)
    at = at[moved[np.searchsorted(offsets, at, side="right") - 1]]
    if len(at) != 3 * moved.sum():
        raise ValueError("an output does not hold each sentinel once")
    start, end = offsets[:-1], offsets[1:]
    back = np.concatenate([[0], np.cumsum(end - start - 3 * MARK * moved)])
    a, b, c = (np.where(moved, 0, end).astype(np.int64) for _ in range(3))
    a[moved], b[moved], c[moved] = at.reshape(-1, 3).T
    spm = form == SPM
    # in the order of the output the parts are: prefix, suffix, middle, or suffix, prefix, middle
    low, mid, high = np.where(moved, a + MARK, start), np.where(moved, b + MARK, end), np.where(moved, c + MARK, end)
    from_prefix, from_suffix = np.where(spm, mid, low), np.where(spm, low, mid)
    prefix = np.where(moved, np.where(spm, c - mid, b - low), end - start)
    middle = end - high
    to = np.stack([back[:-1], back[:-1] + prefix, back[:-1] + prefix + middle], axis=1)
    shift = np.stack([from_prefix, high, from_suffix], axis=1) - to
    result = np.empty(back[-1], np.uint8)
    for first, last, by in shifted(len(result), to.ravel(), shift.ravel()):
        result[first:last] = data[np.arange(first, last) + by]
    return result, back


def _transform(batch: pa.RecordBatch):
    draws = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)], axis=1)
    chosen, spm = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (3, 4))
    for first, end, data, offsets in pieces(batch.column(0)):
        rows = slice(first, end)
        result, out, form, lines, prefix, middle = scattered(data, offsets, draws[rows], chosen[rows], spm[rows])
        plain = form == PLAIN
        yield [pa.array(lines, pa.int64()), pa.array(FORMS[form], pa.string()), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), strings(result, out)]


def _restore(batch: pa.RecordBatch):
    form = batch.column(1).to_numpy(zero_copy_only=False)
    form = np.where(form == "spm", SPM, np.where(form == "psm", PSM, PLAIN))
    for first, end, data, offsets in pieces(batch.column(0)):
        yield [strings(*gathered(data, offsets, form[first:end]))]


def transformed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``docs`` with n (lines), form, prefix_chars, middle_chars and output; of each hundred texts ``rate`` are cut, and of each
    hundred of these ``spm_rate`` have the suffix first. All draws are a hash of seed and id.

    A null text is empty. A text that is empty or holds a sentinel stays plain. Rows without an id have no draws and are
    left out; a row that is repeated is cut alike each time. A text of any length is cut whole. An empty table gives no
    rows. Other columns are kept; one that is called as a new one is replaced.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{doc_id}`").cast("long").cast("string")).cast("binary"), 256)
    draw = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    made = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    inputs = [F.col(f"`{text}`"), draw[0], draw[1], draw[2] % 100 < rate, draw[3] % 100 < spm_rate]
    return beside(docs.where(F.col(f"`{doc_id}`").isNotNull()), inputs, made, _transform)


def restored(cut: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``cut`` with restored, the exact text, rebuilt from output and form alone. A null output is an empty text."""
    return beside(cut, [F.col(f"`{output}`"), F.col(f"`{form}`")], {"restored": "string"}, _restore)


SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
    FROM documents WHERE doc_id IS NOT NULL
), drawn AS (
    SELECT doc_id, text, lines, len(lines) AS n, ('0x' || h[1:8])::BIGINT % (len(lines) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(lines) + 1) AS b,
        ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d
    FROM cut
), parts AS (
    SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 100 THEN 'plain' WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(lines[1:least(a, b)], '') AS prefix, array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(lines[greatest(a, b) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

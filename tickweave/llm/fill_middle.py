"""Fill-in-middle: a text cut at two code points, its middle moved to the end.

Code points of a UTF-8 text begin at some of its bytes. Those positions are kept as a
compressed set in the manner of roaring bitmaps: positions are dealt to containers of 65,536
bytes, each stored as an array, a bitmap or runs, whichever is smallest, beside the
cumulative cardinalities of the containers. The byte at which the k-th code point begins is
``select(k)``: a search among the cumulative cardinalities, then a select in one container.
Plain ASCII is one run a container; mixed scripts become bitmaps.

Texts are cut and joined as bytes, so no text is decoded. A row needs only itself: nothing
is shuffled and a text of any length costs its own bytes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_chunks

#: Bytes that a container covers, and bytes of its bitmap form.
SPAN, BITMAP_BYTES = 1 << 16, 1 << 13

#: Prefix, suffix and middle markers.
MARKERS = ("<P>", "<S>", "<M>")


class ArrayContainer:
    """Few positions: themselves."""

    def __init__(self, positions: np.ndarray):
        self.positions = positions.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.positions[k])


class RunContainer:
    """Positions in few runs: where each begins, and how many positions are before it."""

    def __init__(self, begins: np.ndarray, lengths: np.ndarray):
        self.begins = begins
        self.before = np.cumsum(lengths) - lengths

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.begins[run] + k - self.before[run])


class BitmapContainer:
    """Many scattered positions: a bit each, with the count of bits up to each 64-bit word."""

    def __init__(self, inside: np.ndarray):
        packed = np.packbits(inside, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(-len(packed) % 8, np.uint8))).view(np.uint64)
        self.upto = np.cumsum(np.bitwise_count(self.words).astype(np.int64))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, "right"))
        left, word = k - (int(self.upto[at - 1]) if at else 0), int(self.words[at])
        for _ in range(left):
            word &= word - 1
        return at * 64 + (word & -word).bit_length() - 1


def container(inside: np.ndarray) -> ArrayContainer | RunContainer | BitmapContainer:
    """The smallest container for the positions at which ``inside`` is true."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    runs, count = len(edges) // 2, int(np.count_nonzero(inside))
    sizes = {"runs": 2 + 4 * runs, "array": 2 * count, "bitmap": BITMAP_BYTES}
    kind = min(sizes, key=sizes.__getitem__)
    if kind == "runs":
        return RunContainer(edges[0::2], edges[1::2] - edges[0::2])
    return ArrayContainer(np.flatnonzero(inside)) if kind == "array" else BitmapContainer(inside)


class BoundarySet:
    """The bytes of a UTF-8 text at which code points begin."""

    def __init__(self, data: np.ndarray):
        self.end = len(data)
        self.containers, self.upto = [], [0]
        for i in range(0, len(data), SPAN):
            inside = (data[i : i + SPAN] & 0xC0) != 0x80
            self.containers.append(container(inside))
            self.upto.append(self.upto[-1] + int(np.count_nonzero(inside)))

    def __len__(self) -> int:
        return self.upto[-1]

    def select(self, k: int) -> int:
        """The byte at which code point ``k`` begins; the text's end for ``k`` = their number."""
        if not 0 <= k <= len(self):
            raise IndexError(k)
        if k == len(self):
            return self.end
        at = bisect_right(self.upto, k) - 1
        return at * SPAN + self.containers[at].select(k - self.upto[at])


def _cut(batches: Iterator[pa.RecordBatch], markers: tuple[bytes, ...]) -> Iterator[pa.RecordBatch]:
    p, s, m = markers
    for table, texts in in_chunks(batches, "text"):
        first, second, forms = (table.column(c).to_pylist() for c in ("h1", "h2", "form"))
        raw = texts.data.tobytes()
        counts, prefixes, middles, outputs = [], [], [], []
        for i, form in enumerate(forms):
            lo, hi = int(texts.bounds[i]), int(texts.bounds[i + 1])
            text = raw[lo:hi]
            marks = BoundarySet(texts.data[lo:hi])
            n = len(marks)
            counts.append(n)
            if form == "plain":
                prefixes.append(None)
                middles.append(None)
                outputs.append(text)
                continue
            a, b = sorted((first[i] % (n + 1), second[i] % (n + 1)))
            x, y = marks.select(a), marks.select(b)
            prefixes.append(a)
            middles.append(b - a)
            parts = (p, text[:x], s, text[y:]) if form == "psm" else (s, text[y:], p, text[:x])
            outputs.append(b"".join((*parts, m, text[x:y])))
        yield pa.RecordBatch.from_arrays(
            [
                table.column("id").combine_chunks(), pa.array(counts, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
                pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).view(pa.string()),
            ],
            ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    seed: int = 1,
    plain_percent: int = 10,
    suffix_first_percent: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): every document's text for infilling.

    The first four groups of eight digits of ``sha256("<seed>:<id>")`` decide: two for the
    cuts, one whether the text stays ``plain``, one whether the suffix comes first (``spm``)
    or the prefix (``psm``). A text that holds a marker, and an empty one, is plain; its cuts
    are null. ``n`` counts code points.

    A null text is empty; a null id stands for no digits, so such rows are decided
    alike. Rows that repeat an id or a text each give their own row, an empty table gives
    none, a text may have any length, and other columns are not looked at.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), digest.alias("h"))
    h = [F.conv(F.substring("h", 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    marked = F.lit(False)
    for mark in markers:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first_percent, "spm").otherwise("psm")
    rows = rows.select("id", "text", h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    raw = tuple(m.encode() for m in markers)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(lambda batches: _cut(batches, raw), schema)


def restored(output: str, form: str, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output of ``transform`` was made from.

    Texts that hold a marker are plain, so each marker stands once in any other output.
    """
    p, s, m = (F.lit(x) for x in markers)
    piece = lambda c, mark, k: F.split_part(c, mark, F.lit(k))
    after = lambda c, mark: F.substring(c, len(mark) + 1, 2**31 - 1)
    o = F.col(output)
    tail = piece(o, m, 2)
    head = piece(o, m, 1)
    psm = F.concat(after(piece(head, s, 1), markers[0]), tail, piece(head, s, 2))
    spm = F.concat(piece(head, p, 2), tail, after(piece(head, p, 1), markers[1]))
    return F.when(F.col(form) == "plain", o).when(F.col(form) == "psm", psm).otherwise(spm)

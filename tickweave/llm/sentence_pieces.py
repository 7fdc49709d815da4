"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A batch's distinct units (texts cut wherever no piece of the vocabulary has the two bytes
side by side, as before a space) are concatenated and their suffixes sorted. Every piece is
looked up by binary search; its range of suffixes is where it occurs. The occurrences are
edges of a lattice, sorted by position (longer ones first) and relaxed. BPE has no costs to
add: an edge is relaxed if merging the texts of the token before and its own, by the
vocabulary's scores, gives just these two tokens. A segmentation whose neighbours all agree in
this way is the one BPE arrives at, and each reached place has one such token only, so the
first that leads to the end is kept.

Encoded units are remembered within a task, up to a bound. Characters that no piece covers
become byte tokens. Texts stay in their partition; the vocabulary is the only thing sent to tasks.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Texts, in_chunks, ragged, run_hashes

_MARK = "▁"
_UNKNOWN = 1 << 20
_INDEXED = 256 << 10  # bytes of distinct text indexed at a time: its edges are many times that
_agree: dict[int, dict[int, bool]] = {}
_encoders: dict[int, Encoder] = {}


@dataclass
class Vocabulary:
    """Pieces by id, with a space for the mark; ``score`` of those that merging may make."""

    pieces: list[str]
    score: dict[str, float]
    byte_id: list[int]
    unknown_id: int
    ids: dict[str, int] = field(default_factory=dict)
    memo: int = 0  # names the vocabulary in a worker's memory of agreeing neighbours
    rank: list[int] = field(default_factory=list)  # the order in which merging prefers pieces
    halves: list[tuple[int, int] | None] = field(default_factory=list)  # what a piece is merged from last
    whole: dict[int, int] = field(default_factory=dict)  # two pieces -> rank of the piece they make

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """The vocabulary of a BPE model file; refuses what this encoder does not do."""
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.name != "identity" or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("only BPE models with identity normalisation, dummy prefix and escaped spaces")
        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i).replace(_MARK, " ") for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(" " in pieces[i].lstrip(" ") for i in plain):
            raise ValueError("a piece spans the border between words")
        by_byte = {pieces[i]: i for i in range(n) if sp.is_byte(i)}
        out = cls(pieces, {pieces[i]: sp.get_score(i) for i in plain}, [by_byte.get(f"<0x{b:02X}>", sp.unk_id()) for b in range(256)], sp.unk_id())
        out.ids = {pieces[i]: i for i in plain}
        out.memo = hash(tuple(pieces))
        out._prepare()
        return out

    def _prepare(self) -> None:
        """Ranks, last merges and mergeable pairs; pieces that merging never makes are not used."""
        order = sorted(self.ids.values(), key=lambda i: (-self.score[self.pieces[i]], i))
        self.rank, self.halves = [0] * len(self.pieces), [None] * len(self.pieces)
        for r, i in enumerate(order):
            self.rank[i] = r
        for text, i in list(self.ids.items()):
            if len(text) > 1:
                parts = self.merge(text, stop=2)
                if len(parts) != 2 or self.merge(text) != [text]:
                    del self.ids[text]
                elif all(x in self.ids or len(x) == 1 for x in parts):
                    self.halves[i] = (self.ids.get(parts[0], -1), self.ids.get(parts[1], -1))
        for text, i in self.ids.items():
            for k in range(1, len(text)):
                a, b = self.ids.get(text[:k]), self.ids.get(text[k:])
                if a is not None and b is not None:
                    self.whole[a << 20 | b] = self.rank[i]

    def text(self, token: int) -> str:
        return chr(token - _UNKNOWN) if token >= _UNKNOWN else self.pieces[token]

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """What BPE makes of a short text: the best-scored pair first, the leftmost of equals; down to ``stop`` parts."""
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: int, right: int, memo: dict[int, bool]) -> bool:
        """Whether two tokens stay as they are side by side (``left`` < 0: the unit begins)."""
        if left < 0:
            return True
        known = self._apart(left, right)
        if len(memo) > 300_000:
            memo.clear()
        memo[(left + 1) << 22 | right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Undo the last merges on both sides of the border, latest first: would a pair across it have come earlier?

        Ranks decide, and of equal ones the left; runs of spaces have equal scores, for them
        and for characters without a piece the merges are done.
        """
        a, b = self.text(left), self.text(right)
        if left >= _UNKNOWN or right >= _UNKNOWN or a.startswith("  ") or b.startswith("  "):
            return self.merge(a + b) == [a, b]
        rank, halves, whole = self.rank, self.halves, self.whole
        limit = len(rank)
        while True:
            made = whole.get(left << 20 | right)
            if made is not None and made < limit:
                return False
            l, r = halves[left], halves[right]
            if l is None and r is None:
                return True
            if r is None or (l is not None and rank[left] > rank[right]):
                limit, left = rank[left], l[1]
            else:
                limit, right = rank[right] + 1, r[0]
            if left < 0 or right < 0:
                return self.merge(a + b) == [a, b]

    def piece_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes a token decodes to: all in one buffer, with start and length per id."""
        raw = [self.pieces[i].encode() if self.pieces[i] in self.ids and self.ids[self.pieces[i]] == i else b"" for i in range(len(self.pieces))]
        for b, i in enumerate(self.byte_id):
            if i != self.unknown_id:
                raw[i] = bytes([b])
        raw[self.unknown_id] = " ⁇ ".encode()
        size = np.array([len(r) for r in raw])
        return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum(size)[:-1])), size


def suffix_edges(buffer: np.ndarray, pieces: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, piece) of every occurrence of the pieces (sorted fixed-width bytes) in the buffer.

    Suffixes are sorted by as many bytes as the longest piece has.
    """
    width = pieces.dtype.itemsize
    starts = np.flatnonzero((buffer & 0xC0) != 0x80)  # first bytes of characters
    padded = np.concatenate([buffer, np.zeros(width, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    keys = np.ascontiguousarray(windows).view(">u8").reshape(len(starts), -1)
    order = np.lexsort(tuple(keys[:, k].astype(np.uint64) for k in reversed(range(keys.shape[1]))))
    suffixes = np.ascontiguousarray(windows[order]).view(f"S{width}").ravel()
    last = np.frombuffer(b"".join(p + b"\xff" * (width - len(p)) for p in pieces.tolist()), f"S{width}")
    lo, hi = np.searchsorted(suffixes, pieces, "left"), np.searchsorted(suffixes, last, "right")
    count = hi - lo
    return starts[order].astype(np.int32)[ragged(lo, count)], np.repeat(np.arange(len(pieces), dtype=np.int32), count)


class Encoder:
    """Encodes units of a task's batches; remembers them up to ``most`` ids."""

    def __init__(self, vocabulary: Vocabulary, most: int = 700_000):
        self.v, self.most = vocabulary, most
        self.memo = _agree.setdefault(vocabulary.memo, {})
        names = sorted((p.encode(), i) for p, i in vocabulary.ids.items() if p)
        width = -(-max((len(p) for p, _ in names), default=8) // 8) * 8
        # Two bytes that no piece has side by side are a border that no merge crosses.
        self.border = np.ones((256, 256), bool)
        for p, _ in names:
            x = np.frombuffer(p, np.uint8)
            self.border[x[:-1], x[1:]] = False
        self.border[:, 0x80:0xC0] = False
        self.names = np.array([p for p, _ in names], f"S{width}")
        self.name_size = np.array([len(p) for p, _ in names], np.int64)
        self.name_id = np.array([i for _, i in names], np.int64)
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.first, self.count = array("i"), array("q"), array("i")

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All token ids, and where each text's begin (one more entry than texts)."""
        raw = texts.data.tobytes()
        cut = texts.bounds.tolist()
        mark = _MARK.encode()
        parts = [b" " + raw[a:b].replace(mark, b" ") if b > a else b"" for a, b in zip(cut[:-1], cut[1:], strict=True)]
        buffer = np.frombuffer(b"".join(parts), np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        begin = np.zeros(len(buffer), bool)
        if len(buffer):
            begin[1:] = self.border[buffer[:-1], buffer[1:]]
        begin[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buffer))[: len(starts)]
        h, at, inverse = np.unique(run_hashes(buffer, starts, ends), return_index=True, return_inverse=True)
        if len(self.flat) > self.most:
            self.clear()
        slot = np.fromiter((self.known.get(x, -1) for x in h.tolist()), np.int64, len(h))
        new = np.flatnonzero(slot < 0)
        if len(new):
            s, e = starts[at[new]], ends[at[new]]
            part = np.cumsum(e - s) // _INDEXED
            for cut in np.split(np.arange(len(new)), np.flatnonzero(np.diff(part)) + 1):
                self._learn(buffer, s[cut], e[cut])
            slot[new] = np.arange(len(self.first) - len(new), len(self.first))
            self.known.update(zip(h[new].tolist(), slot[new].tolist(), strict=True))
        first, count = np.frombuffer(self.first, np.int64) if len(self.first) else np.zeros(0, np.int64), np.frombuffer(self.count, np.int32) if len(self.count) else np.zeros(0, np.int32)
        each = slot[inverse]
        sizes = count[each].astype(np.int64)
        ids = np.array(self.flat, np.int32)[ragged(first[each], sizes)] if len(each) else np.zeros(0, np.int32)
        total = np.concatenate(([0], np.cumsum(sizes)))
        return ids, total[np.searchsorted(starts, bounds)]

    def _learn(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Index the units' text, relax the edges of each, and store its tokens."""
        sizes = ends - starts
        text = np.zeros(int((sizes + 1).sum()), np.uint8)  # a zero byte behind each unit: no piece has one
        base = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
        text[ragged(base, sizes)] = buffer[ragged(starts, sizes)]
        position, piece = suffix_edges(text, self.names, self.name_size)
        size = self.name_size[piece]
        order = np.lexsort((-size, position))
        # Arrays of machine integers: as lists, the edges of a chunk would be hundreds of MB.
        to, token = (array("i", x[order].astype(np.int32).tobytes()) for x in (position + size, self.name_id[piece]))
        cut = array("i", np.searchsorted(position[order], np.arange(len(text) + 1)).astype(np.int32).tobytes())
        del position, piece, size, order
        for start, end in zip(base.tolist(), (base + sizes).tolist(), strict=True):
            out = self._relax(text, start, end, cut, to, token)
            self.first.append(len(self.flat))
            self.count.append(len(out))
            self.flat.extend(out)

    def _relax(self, text: np.ndarray, start: int, end: int, cut: array, to: array, token: array) -> list[int]:
        """Tokens of one unit: edges by position, the longest first; a place that leads nowhere is left for good."""
        agree, memo, dead = self.v.agree, self.memo, set()
        tokens, places, edges, last = [], [start], [cut[start]], -1
        while (at := places[-1]) < end:
            e, stop = edges[-1], cut[at + 1]
            ok = False
            while e < stop:
                t, b = token[e], to[e]
                e += 1
                if b not in dead:
                    ok = memo.get((last + 1) << 22 | t)
                    if ok is None:
                        ok = agree(last, t, memo)
                    if ok:
                        break
            if not ok and e == stop:  # no piece goes on from here, but the character alone may
                b = at + 1
                while b < end and text[b] & 0xC0 == 0x80:
                    b += 1
                if (stop == cut[at] or to[stop - 1] != b) and b not in dead:
                    t = _UNKNOWN + ord(text[at:b].tobytes().decode("utf-8", "replace")[0])
                    ok = agree(last, t, memo)
                e = stop + 1
            edges[-1] = e
            if ok:
                tokens.append(t)
                places.append(b)
                edges.append(cut[b])
                last = t
            else:
                dead.add(at)
                places.pop(), edges.pop(), tokens.pop()
                last = tokens[-1] if tokens else -1
        out: list[int] = []
        for t, at, b in zip(tokens, places[:-1], places[1:], strict=True):
            if t < _UNKNOWN:
                out.append(t)
            else:
                out.extend(self.v.byte_id[x] for x in text[at:b].tolist())
        return out


def decode_ids(ids: np.ndarray, first: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of token runs, without the space put before a text: (bytes, bounds)."""
    data, start, size = table
    sizes = size[ids]
    out = data[ragged(start[ids], sizes)]
    total = np.concatenate(([0], np.cumsum(sizes)))
    bounds = total[first]
    drop = bounds[:-1][bounds[:-1] < bounds[1:]]
    drop = drop[out[drop] == 0x20]
    keep = np.ones(len(out), bool)
    keep[drop] = False
    gone = np.concatenate(([0], np.cumsum(~keep)))
    return out[keep], bounds - gone[bounds]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows with ``n_tokens``, ``token_ids`` and ``round_trip`` (whether decoding gives the text back).

    ``keep`` names the columns passed on (default: all but the text; those named like a new
    one give way). Null and empty texts have no tokens. A text that holds the mark itself is
    decoded with a space for it, as the library does; it counts as given back.
    """
    new = [T.StructField("n_tokens", T.IntegerType()), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    names = [f.name for f in new]
    keep = [c for c in docs.columns if c != text_col and c not in names] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary.memo not in _encoders:  # a worker keeps what its tasks have learned
            _encoders[vocabulary.memo] = Encoder(vocabulary)
        encoder, table = _encoders[vocabulary.memo], vocabulary.piece_bytes()
        mark = _MARK.encode()
        for rows, texts in in_chunks(batches, "__text"):
            ids, first = encoder.encode(texts)
            back, bounds = decode_ids(ids, first, table)
            raw, again, a, b = texts.data.tobytes(), back.tobytes(), texts.bounds.tolist(), bounds.tolist()
            same = [raw[a[i] : a[i + 1]].replace(mark, b" ") == again[b[i] : b[i + 1]] for i in range(len(texts))]
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(rows[c].combine_chunks() for c in keep), pa.array(np.diff(first).astype(np.int32)), lists, pa.array(same)], names=[*keep, *names])

    source = docs.select(*keep, docs[text_col].alias("__text"))
    return source.mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), *new]))


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids_col: str = "token_ids", out_col: str = "text") -> DataFrame:
    """Rows with the text of their token ids; null ids give a null text, ids that do not exist an error.

    Bytes that are no UTF-8 become replacement characters.
    """
    keep = [c for c in tokens.columns if c not in (ids_col, out_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary.piece_bytes()
        for batch in batches:
            lists = batch.column(ids_col)
            first = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
            data, bounds = decode_ids(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), first, table)
            raw, cut = data.tobytes(), bounds.tolist()
            texts = [raw[a:b].decode("utf-8", "replace") if v else None for a, b, v in zip(cut[:-1], cut[1:], lists.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, out_col])

    return tokens.select(*keep, ids_col).mapInArrow(run, T.StructType([*(tokens.schema[c] for c in keep), T.StructField(out_col, T.StringType())]))

"""Near duplicates by an exact n-gram Jaccard join over a partitioned token universe.

Two documents link when the sets of their five-word shingles have a Jaccard similarity of
``percent`` or more. With sizes ``a <= c`` a link leaves at most ``H = (a + c) // 7``
shingles (for 75 %) in only one of the two sets. The universe of shingles is cut into
``M`` segments by hash, ``M`` by size band; what a set has in one segment is hashed to one
*token*. A shingle that only one set has spoils one segment at most, so all but ``H`` of a
set's filled segments are filled alike in a linked partner (pigeonhole).

* **Which segments are indexed** is decided by cost: the join cost of a token is the number of
  sets that hold it, so every set indexes its ``H + 1`` rarest tokens. As all sets order
  tokens alike, two linked sets index at least one token in common. Tokens that only one set
  holds cost nothing and need not be sent back; a set with more than ``H`` of them has no
  partner. A passage that many documents share is therefore never what pairs them, unless
  they share nearly everything.
* **One-deletion neighbourhoods** serve sets that fill too few segments (``H`` or fewer): they
  index each segment's token and the tokens with one shingle left out. If half of ``H``
  segments do not hold two shingles either, they index single shingles besides.
* **Verification** compares whole sets of 64-bit shingle hashes, exactly.

Equal sets are one node (by a 64-bit digest), so a group of copies is never paired. Of the
sets that share a token, the one with the fewest tokens of its own (likely the original of
copies) is compared with all others first. Only sets that stay in different components
afterwards are compared further, block by block within a task, and only pairs that join two
components leave it. Every pair that may link is either compared or already connected:
components are exact, and a group of near copies sends a multiple of its size, not its square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_of, bitmap, connected_components, in_chunks, materialise, mix, ragged, words_of

#: Tokens that one bucket of the counting step holds on average.
BUCKET_TOKENS = 400_000
_TAG = np.uint64(0xC2B2AE3D27D4EB4F)
#: Segments are counted in so many classes, to bound the difference of two sets.
FOLDS = 16
_LOW = np.uint32(63)  # of a token: two bits for its kind, four for its fold
_POSITIVE = np.uint64((1 << 63) - 1)


def shingle_sets(texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text (ascending) and where each text's begin."""
    words = words_of(texts)
    counts = np.diff(words.first)
    take = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    at = ragged(words.first[:-1], take)
    h = np.zeros(len(at), np.uint64)
    if len(at):
        span = np.repeat(np.minimum(counts, width), take)
        for k in range(width):
            live = k < span
            nxt = words.hashes[np.minimum(at + k, len(words.hashes) - 1)]
            h = np.where(live, mix(h * _TAG + nxt + np.uint64(k + 1)), h)
    first = np.concatenate(([0], np.cumsum(take)))
    parts, sizes = [], np.zeros(len(take), np.int64)
    for i in range(len(take)):
        part = h[first[i] : first[i + 1]]
        if len(part) > 1:
            part = np.sort(part)
            part = part[np.concatenate(([True], part[1:] != part[:-1]))]
        parts.append(part)
        sizes[i] = len(part)
    joined = np.concatenate(parts) if parts else h
    return joined, np.concatenate(([0], np.cumsum(sizes)))


def digests(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """An order-free 64-bit digest of each set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ _TAG), dtype=np.uint64)))
    sizes = np.diff(first)
    return mix(total[first[1:]] - total[first[:-1]] + sizes.astype(np.uint64) * _TAG)


def band_of(n: np.ndarray) -> np.ndarray:
    """Sizes 1-3 are band 0, 4-15 band 1, and so on by factors of four."""
    out, low = np.zeros(len(n), np.int64), 4
    while low <= max(n, default=0):
        out += n >= low
        low *= 4
    return out


def segments_of(band: np.ndarray) -> np.ndarray:
    """Segments of a band's partition: sets fill H + 1 of them with room to spare."""
    top = 4 ** (band + 1)
    return np.where(top <= 1024, np.maximum(top, 64), (0.45 * top).astype(np.int64))


class Scheme:
    """The most shingles a linked pair may not share, as a function of the sizes."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent must lie between 50 and 100")
        self.percent = percent

    def limit(self, n: np.ndarray, band: np.ndarray) -> np.ndarray:
        """H for a set of ``n`` in the scheme of ``band`` (the band of the smaller set)."""
        p = self.percent
        own = band_of(n) == band
        partner = np.where(own, 100 * n // p, 4 ** (band + 1) - 1)
        return (100 - p) * (n + partner) // (100 + p)

    def bands(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The own band, and whether the set may be the larger one of a pair of the band below."""
        own = band_of(n)
        return own, (own > 0) & (-(-self.percent * n // 100) < 4**own)


def tokens_of(h, first, which, band, deletions: bool = False):
    """Tokens of the sets ``which`` in their ``band``: (set index, token hash, segment size, fold).

    With ``deletions`` the tokens are those of segments with one shingle left out.
    """
    sizes = first[which + 1] - first[which]
    at = ragged(first[which], sizes)
    owner = np.repeat(np.arange(len(which)), sizes)
    m = segments_of(band)
    seg = (mix(h[at] + _TAG) % np.repeat(m, sizes).astype(np.uint64)).astype(np.int64)
    base = np.concatenate(([0], np.cumsum(m)[:-1])) if len(m) else np.zeros(0, np.int64)
    key = seg + base[owner] if len(owner) else seg
    order = np.argsort(key, kind="stable")
    key, value, owner, seg = key[order], mix(h[at][order]), owner[order], seg[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((begin, [len(key)])))
    total = np.add.reduceat(value, begin) if len(begin) else np.zeros(0, np.uint64)
    salt = mix(seg[begin].astype(np.uint64) * _TAG + band[owner[begin]].astype(np.uint64)) if len(begin) else total
    if not deletions:
        return owner[begin], mix(total + salt), count, seg[begin] % FOLDS
    some = np.repeat(count >= 2, count)
    left = np.repeat(total, count) - value
    return owner[some], mix(left + np.repeat(salt, count))[some], None, None


def describe(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, width: int, scheme: Scheme):
    """One row per document: id, set size, digest, filled segments by fold of its two schemes, all of them."""
    for rows, texts in in_chunks(batches, text_col):
        h, first = shingle_sets(texts, width)
        n = np.diff(first)
        own, lower = scheme.bands(n)
        filled = []
        for which, band in ((np.flatnonzero(n > 0), own), (np.flatnonzero(lower), own - 1)):
            owner, _, _, fold = tokens_of(h, first, which, band[which])
            count = np.zeros((len(n), FOLDS), np.uint16)
            count[which] = np.minimum(np.bincount(owner * FOLDS + fold, minlength=len(which) * FOLDS), 65535).reshape(-1, FOLDS)
            filled.append(count)
        yield pa.RecordBatch.from_arrays(
            [rows[id_col].combine_chunks().cast(pa.int64()), pa.array(n), pa.array(digests(h, first).view(np.int64)), *(pa.array([c.tobytes() for c in count], pa.binary()) for count in filled), pa.array(sum(c.sum(axis=1, dtype=np.int64) for c in filled))],
            names=["id", "n", "sid", "filled", "filled_below", "tokens"],
        )


def _as_rows(bucket, **columns) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    columns = {k: v[order] for k, v in columns.items()}
    for lo, hi in zip(cut, np.append(cut[1:], len(bucket)), strict=True):
        yield int(bucket[lo]), {k: v[lo:hi] for k, v in columns.items()}


def _packed(rows, names: list[str]) -> pa.RecordBatch:
    buckets, data = [], [[] for _ in names]
    for bucket, columns in rows:
        buckets.append(bucket)
        for out, name in zip(data, names, strict=True):
            out.append(columns[name].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), *(pa.array(d, pa.binary()) for d in data)], names=["bucket", *names])


def emit_tokens(batches: Iterator[pa.RecordBatch], text_col: str, width: int, scheme: Scheme, buckets: int):
    """Packed (token, set) entries by bucket of the token; a set is emitted once per task.

    The low two bits of a token say what it is: the parity of its band, or 2 for what a set
    with too few filled segments indexes; the next four are the fold of its segment.
    """
    seen: set[int] = set()
    for _, texts in in_chunks(batches, text_col, 4 << 20):
        h, first = shingle_sets(texts, width)
        n, sid = np.diff(first), digests(h, first)
        new = np.zeros(len(n), bool)
        for i, s in enumerate(sid.tolist()):
            if n[i] and s not in seen:
                seen.add(s)
                new[i] = True
        own, lower = scheme.bands(n)
        tokens, sids = [], []

        def add(which, owner, token, kind, fold, tokens=tokens, sids=sids, sid=sid):
            high = (token >> np.uint64(32)).astype(np.uint32) & ~_LOW
            tokens.append((token.astype(np.uint32) % np.uint32(buckets), high | (kind | fold << 2).astype(np.uint32)))
            sids.append(sid[which][owner])

        for mask, band in ((new, own), (new & lower, own - 1)):
            which = np.flatnonzero(mask)
            b = band[which]
            owner, token, count, fold = tokens_of(h, first, which, b)
            add(which, owner, token, b[owner] & 1, fold)
            limit = scheme.limit(n[which], b)
            short = np.bincount(owner, minlength=len(which)) <= limit
            if short.any():
                pairs = np.bincount(owner[count >= 2], minlength=len(which))
                some, alone = which[short], which[short & (2 * pairs <= limit)]
                for deletions in (False, True):
                    o, t, *_ = tokens_of(h, first, some, band[some], deletions)
                    add(some, o, mix(t), np.full(len(t), 2), np.zeros(len(t), np.int64))
                at = ragged(first[alone], n[alone])
                add(alone, np.repeat(np.arange(len(alone)), n[alone]), mix(h[at] * _TAG), np.full(len(at), 2), np.zeros(len(at), np.int64))
        if tokens and sum(len(t) for _, t in tokens):
            bucket = np.concatenate([b for b, _ in tokens])
            yield _packed(_as_rows(bucket, tokens=np.concatenate([t for _, t in tokens]), sids=np.concatenate(sids)), ["tokens", "sids"])


def _joined(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def shared_tokens(table: pa.Table, sid_buckets: int) -> pa.Table:
    """Of one bucket's entries those whose token several sets hold, with how many do."""
    bucket = table["bucket"][0].as_py()
    token, sid = _joined(table["tokens"], np.uint32), _joined(table["sids"], np.uint64)
    order = np.argsort(token)
    token, sid = token[order], sid[order]

    def groups(token):
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        return begin, np.diff(np.append(begin, len(token)))

    begin, count = groups(token)
    several = np.repeat(count > 1, count)
    token, sid = token[several], sid[several]
    order = np.lexsort((sid, token))
    token, sid = token[order], sid[order]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid = token[keep], sid[keep]
    begin, count = groups(token)
    count = np.repeat(count, count)
    several = count > 1
    token, sid, count = token[several], sid[several], count[several]
    wide = (np.uint64(bucket) << np.uint64(32)) | token.astype(np.uint64)
    rows = _as_rows((sid & _POSITIVE) % np.uint64(sid_buckets), sids=sid, tokens=wide, held=np.minimum(count, 65535).astype(np.uint16))
    return pa.Table.from_batches([_packed(rows, ["sids", "tokens", "held"])])


def signatures(shared: pa.Table, sets: pa.Table, scheme: Scheme) -> pa.Table:
    """The tokens that each set of one bucket indexes: the H + 1 rarest of either scheme.

    ``own`` counts, by fold, the segments that the set fills like no other set.
    """
    names = ["token", "sid", "n", "apart", "own"]
    kinds = [pa.int64()] * 3 + [pa.float64(), pa.list_(pa.int32())]
    if not len(shared) or not len(sets):
        return pa.table([pa.array([], k) for k in kinds], names=names)
    sid, token, held = _joined(shared["sids"], np.uint64), _joined(shared["tokens"], np.uint64), _joined(shared["held"], np.uint16)
    known = sets["sid"].to_numpy().view(np.uint64)
    order = np.argsort(known)
    known, size = known[order], sets["n"].to_numpy()[order]
    filled = np.stack([_joined(sets[c], np.uint16).reshape(-1, FOLDS)[order].astype(np.int64) for c in ("filled", "filled_below")], axis=1)
    at = np.searchsorted(known, sid)
    kind, fold = (token & np.uint64(3)).astype(np.int64), (token >> np.uint64(2) & np.uint64(FOLDS - 1)).astype(np.int64)
    n = size[at]
    own = band_of(n)
    below = ((kind < 2) & (kind != (own & 1))).astype(np.int64)
    limit = scheme.limit(n, own - below)
    exact = kind < 2
    part = (at * 2 + below) * FOLDS + fold
    alone = filled - np.bincount(part[exact], minlength=filled.size).reshape(filled.shape)
    group = at * 4 + kind
    order = np.lexsort((token, held, group))
    group, token, at, kind, limit, below = group[order], token[order], at[order], kind[order], limit[order], below[order]
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    rank = np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group))))
    unique = alone.sum(axis=2)[at, below]
    keep = (kind == 2) | (rank < limit + 1 - unique)
    at, below, kind, unique, token = at[keep], below[keep], kind[keep], unique[keep], token[keep]
    apart = np.where(kind == 2, 0.0, unique / np.maximum(filled.sum(axis=2)[at, below], 1))
    folds = np.where(kind[:, None] == 2, 0, np.maximum(alone[at, below], 0)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, folds.size + 1, FOLDS, dtype=np.int32)), pa.array(folds.ravel()))
    return pa.table([pa.array(token.view(np.int64)), pa.array(known[at].view(np.int64)), pa.array(size[at]), pa.array(apart), lists], names=names)


def whole_sets(batches: Iterator[pa.RecordBatch], text_col: str, width: int, wanted: np.ndarray):
    """Packed shingle sets of the documents that ``wanted`` (a bitmap of hashed ids) may hold."""
    for batch in batches:
        bit = batch.column(batch.schema.get_field_index("bit")).to_numpy()
        hit = (wanted[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)
        for rows, texts in in_chunks([batch.filter(pa.array(hit > 0))], text_col):
            h, first = shingle_sets(texts, width)
            data = [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows["id"].combine_chunks(), pa.array(digests(h, first).view(np.int64)), pa.array(data, pa.binary())], names=["id", "sid", "shingles"])


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        keep = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(large, small)
            common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75, block_sets: int = 256, filter_bits: int = 1 << 25) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``.

    Null and empty texts and texts without words have no shingles and are their own
    component. A null id yields a null component and links with nothing. Rows that share an
    id are one node. Other columns, whatever they are named, are not read. ``filter_bits``
    bounds the only broadcast: a bitmap that spares most texts their second hashing; where
    it fills up, more sets are compared than needed, but none is lost.
    """
    scheme = Scheme(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    info = materialise(texts.mapInArrow(lambda it: describe(it, "id", "text", width, scheme), "id long, n long, sid long, filled binary, filled_below binary, tokens long"))
    known = info.where("id is not null and n > 0")
    sets = known.groupBy("sid").agg(*(F.min(c).alias(c) for c in ("id", "n", "tokens", "filled", "filled_below")))
    tokens, count = sets.agg(F.sum("tokens"), F.count("*")).first()
    if not tokens:
        links = info.sparkSession.createDataFrame([], "node long, label long")
        return _labelled(info, sets, links)
    buckets, sid_buckets = math.ceil(tokens / BUCKET_TOKENS), math.ceil(count / 4000)

    packed = texts.where("id is not null").select("text").mapInArrow(lambda it: emit_tokens(it, "text", width, scheme, buckets), "bucket int, tokens binary, sids binary")
    shared = packed.groupBy("bucket").applyInArrow(lambda t: shared_tokens(t, sid_buckets), "bucket int, sids binary, tokens binary, held binary")
    sized = sets.withColumn("bucket", F.expr(f"cast((sid & {(1 << 63) - 1}) % {sid_buckets} as int)"))
    signed = shared.groupBy("bucket").cogroup(sized.groupBy("bucket")).applyInArrow(lambda s, i: signatures(s, i, scheme), "token long, sid long, n long, apart double, own array<int>")
    ids = sets.select("sid", "id")
    signed = materialise(signed.join(ids, "sid").select("token", "n", "apart", "own", "sid", F.col("id").alias("node")))

    # The lead of a token is the set with the least of its own: an original rather than a copy.
    groups = signed.groupBy("token").agg(F.count("*").alias("g"), F.min(F.struct("apart", "sid")).alias("first")).where("g > 1")
    grouped = materialise(signed.join(groups, "token").select("token", "n", "own", "sid", "node", "g", (F.col("sid") == F.col("first.sid")).alias("lead")))
    wanted = bitmap(grouped.select("node").distinct(), "node", filter_bits)
    marked = texts.where("id is not null").withColumn("bit", bit_of("id", filter_bits))
    packed_sets = marked.mapInArrow(lambda it: whole_sets(it, "text", width, wanted), "id long, sid long, shingles binary")
    needed = grouped.select("sid", F.col("node").alias("node")).distinct()
    packed_sets = materialise(packed_sets.join(needed, "sid").where("id = node").select("sid", "shingles").dropDuplicates(["sid"]))

    p = grouped.where("lead or g <= 3").select("token", *(F.col(c).alias(f"p_{c}") for c in ("sid", "n", "own", "lead")))
    m = grouped.select("token", "sid", "n", "own", "lead", "g")
    # A lead meets all others; in groups of three the rest meet once, too.
    meets = (p.token == m.token) & F.when(p.p_lead, ~m.lead).otherwise(~m.lead & (p.p_sid < m.sid))
    meets &= (p.p_n * 100 >= m.n * percent) & (m.n * 100 >= p.p_n * percent)
    # A segment that one of the two fills like no other set holds a shingle that they do not share.
    differ = F.aggregate(F.zip_with(p.p_own, m.own, lambda x, y: F.greatest(x, y)), F.lit(0), lambda a, x: a + x)
    meets &= differ * (100 + percent) <= (p.p_n + m.n) * (100 - percent)
    pairs = p.join(m, meets).select(F.least("p_sid", "sid").alias("a"), F.greatest("p_sid", "sid").alias("b")).distinct()
    both = pairs.join(packed_sets.select(F.col("sid").alias("a"), F.col("shingles").alias("set_a")), "a").join(packed_sets.select(F.col("sid").alias("b"), F.col("shingles").alias("set_b")), "b")
    links = materialise(_named(both.mapInArrow(lambda it: _verify(it, percent), "a long, b long"), ids))
    labels = connected_components(links)

    # Tokens whose sets still lie in several components: compare those sets block by block.
    still = grouped.where("g > 3").select("token", "node", "sid", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = still.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("node").alias("hub")).where("lo < hi").select("token", "hub")
    still = materialise(still.join(apart, "token"))
    if not still.isEmpty():
        more = _named(_block_links(still, packed_sets, percent, block_sets), ids)
        labels = connected_components(links.unionByName(more))
    return _labelled(info, sets, labels)


def _named(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Pairs of set digests as pairs of document ids."""
    pairs = pairs.join(ids.select(F.col("sid").alias("a"), F.col("id").alias("ia")), "a")
    return pairs.join(ids.select(F.col("sid").alias("b"), F.col("id").alias("ib")), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))


def _block_links(still: DataFrame, packed_sets: DataFrame, percent: int, block_sets: int) -> DataFrame:
    """Links between different components among sets that tokens tie together.

    Such sets form clusters; a cluster is cut into blocks by hash, of ``block_sets`` sets
    or 400,000 shingles on average, and every two blocks meet in one task, where overlaps are
    counted by matrix products. No pair leaves a task unless it joins two components.
    """
    clusters = connected_components(still.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    members = still.select("node", "sid", "n", "label").distinct().join(clusters.select("node", F.col("label").alias("cluster")), "node")
    sizes = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / 400_000)).cast("int").alias("blocks"))
    members = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    cells = members.select("cluster", "sid", "label", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("cluster", "sid", "label", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    cells = cells.join(packed_sets, "sid")
    return cells.groupBy("cluster", "lo", "hi").applyInArrow(lambda t: _compare_blocks(t, percent), "a long, b long")


def _compare_blocks(table: pa.Table, percent: int, columns: int = 16_384) -> pa.Table:
    block, lo, hi = table["block"].to_numpy(), table["lo"][0].as_py(), table["hi"][0].as_py()
    sid, label = table["sid"].to_numpy(), table["label"].to_numpy()
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    flat = {k: (np.concatenate([sets[i] for i in side]) if len(side) else np.zeros(0, np.uint64), np.repeat(np.arange(len(side)), [len(sets[i]) for i in side])) for k, side in (("l", left), ("r", right))}
    common = np.intersect1d(*(np.unique(flat[k][0]) for k in "lr"))
    overlap = np.zeros((len(left), len(right)))
    for start in range(0, len(common), columns):
        part, sides = common[start : start + columns], []
        for k, side in (("l", left), ("r", right)):
            h, owner = flat[k]
            at = np.searchsorted(part, h)
            hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == h)
            has = np.zeros((len(side), len(part)), np.float32)
            has[owner[hit], at[hit]] = 1
            sides.append(has)
        overlap += sides[0] @ sides[1].T
    n = np.array([len(s) for s in sets])
    link = 100 * overlap >= percent * (n[left][:, None] + n[right][None, :] - overlap)
    link &= label[left][:, None] != label[right][None, :]
    names: dict[int, int] = {}

    def root(x: int) -> int:
        while names.get(x, x) != x:
            x = names[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(link), strict=True):
        x, y = root(int(label[left[i]])), root(int(label[right[j]]))
        if x != y:
            names[max(x, y)] = min(x, y)
            out.append((sid[left[i]], sid[right[j]]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _labelled(info: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with the smallest id of its component: by id, by equal sets, by links.

    An id that stands on rows with different texts ties their sets together.
    """
    by_set = info.where("id is not null and n > 0").select("sid", "id").distinct()
    tied = by_set.join(sets.select("sid", F.col("id").alias("head")), "sid").where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    repeated = by_set.groupBy("id").count().where("count > 1").limit(1).count()
    heads = sets.select("sid", F.col("id").alias("head"))
    if repeated:
        labels = connected_components(tied.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
        out = info.join(labels.select(F.col("node").alias("id"), "label"), "id", "left")
        return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("label", "id")).otherwise(F.col("id")).alias("component_id"))
    whole = info.join(heads, "sid", "left").withColumn("head", F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("id")))
    whole = whole.join(labels.select(F.col("node").alias("head"), "label"), "head", "left")
    return whole.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.coalesce("label", "head")).otherwise(F.col("id")).alias("component_id"))

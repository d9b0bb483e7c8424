"""Exact removal of repeated byte strings by deep-shallow suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
(same document included) is removed.  Suffixes are not sorted over the whole
corpus at once; strings that can be equal are brought together first:

1. The strings starting in a document are dealt to anchors: a string's anchor
   is its ``GRAM``-byte piece of smallest hash (leftmost on ties), so equal
   strings have equal anchors at equal offsets.  An anchor's strings start in
   one run of positions: one string per byte becomes one anchor per about 75.
2. Anchors whose hash stands once in the corpus are done with.
3. For the others the text around (at most 2 * LENGTH bytes) is fetched, equal
   segments collapsed with their number, and those of one hash sorted: the
   suffixes that begin at the anchor, and the reversed prefixes that end there,
   by multikey quicksort over the first ``SHALLOW`` bytes after the common
   piece, then with blind tries where longer prefixes are common.
4. Common prefixes of neighbours in both orders tell, for each offset, which
   segments agree on the string's bytes before and after the anchor: those
   strings are repeated.

A hash with more than ``GROUP_ROWS`` distinct segments (a passage that a great
share of the documents holds) isn't sorted in one task: its strings are counted
one by one by 128-bit hash, with partial sums before the shuffle.

Documents are told apart by a 128-bit content hash, and equal texts are one
text with a count.  Null texts are empty; texts under LENGTH bytes keep all
bytes.  Repeated rows are other places, so both copies of a long text go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from txnlab.llm.textops import blocks, running, slice_hash, text_buffer
from txnlab.session import materialize

LENGTH = 200
GRAM = 48
SHALLOW = 16
GROUP_ROWS = 4096
BATCH_SEGMENTS = 16384


# ------------------------------------------------------------------ anchors
def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(document, anchor, hash, first, last): the anchors of all strings of
    ``length`` bytes, in block positions, with the first and last start of an
    anchor's strings."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.int64, np.int64))
    n = len(data)
    if n < length:
        return none
    p = running(data)
    i = np.arange(n - gram + 1)
    h = slice_hash(p, i, i + gram)
    bits = np.uint64(max(24, int(n).bit_length()))
    key = (h >> bits << bits) | i.astype(np.uint64)
    low, width, need = key, 1, length - gram + 1
    while 2 * width <= need:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    if width < need:
        low = np.minimum(low[: len(low) - (need - width)], low[need - width:])
    start = [np.arange(off[d], off[d + 1] - length + 1) for d in np.flatnonzero(np.diff(off) >= length)]
    if not start:
        return none
    start = np.concatenate(start)
    at = (low[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    a = at[first]
    return np.searchsorted(off, a, side="right") - 1, a, h[a], start[first], start[last]


def content_id(text: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(text)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _ids(data, off):
    raw = memoryview(data)
    x = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())),
                      dtype=np.int64).reshape(-1, 2)
    return x[:, 0], x[:, 1]


def store(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: key, content id, bytes, SHA-256 and its anchors
    (hash; place << 16 | strings before << 8 | fewest bytes before)."""
    schema = docs.select(F.col(f"`{key}`").alias("_key")).schema
    for c in ("c1", "c2", "n_bytes"):
        schema = schema.add(c, "long")
    schema = schema.add("sha", "binary").add("h", ArrayType(LongType())).add("at", ArrayType(LongType()))

    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column(1))
            for i, j in blocks(off):
                d, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
                doc, a, h, first, last = anchors(d, o)
                place = a - o[doc]
                at = (place << 16) | ((a - first) << 8) | (a - last)
                cut = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                c1, c2 = _ids(d, o)
                raw = memoryview(d)
                sha = [hashlib.sha256(raw[x:y]).digest() for x, y in zip(o[:-1].tolist(), o[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(c1), pa.array(c2), pa.array(np.diff(o)),
                     pa.array(sha, pa.binary()), pa.ListArray.from_arrays(cut, pa.array(h.view(np.int64))),
                     pa.ListArray.from_arrays(cut, pa.array(at))], names=schema.names)

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


def candidates(kept: DataFrame) -> DataFrame:
    """(c1, c2, at): per text, the places of its anchors whose hash stands more than once."""
    rows = kept.select("c1", "c2", F.explode(F.arrays_zip("h", "at")).alias("x")).select("c1", "c2", "x.h", "x.at")
    # written, so that the join's sides are plain tables and Spark can split a hot hash
    twice = materialize(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"),
                        "suffix-twice")
    return rows.join(twice, "h", "left_semi").groupBy("c1", "c2").agg(F.sort_array(F.collect_set("at")).alias("at"))


def packed_texts(docs: DataFrame, text: str) -> DataFrame:
    """(c1, c2, z, copies): every distinct text once, compressed, with its number."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for b in batches:
            data, off = text_buffer(b.column(0))
            c1, c2 = _ids(data, off)
            raw = memoryview(data)
            z = [pack.compress(raw[x:y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c1), pa.array(c2), pa.array(z, pa.binary())],
                                             names=["c1", "c2", "z"])

    long_enough = docs.select(F.col(f"`{text}`").alias("_text")).filter(F.octet_length("_text") >= LENGTH)
    rows = long_enough.mapInArrow(run, "c1 long, c2 long, z binary")
    return rows.groupBy("c1", "c2").agg(F.max("z").alias("z"), F.count(F.lit(1)).alias("copies"))


# ----------------------------------------------------------------- segments
def segments(texts: DataFrame) -> DataFrame:
    """Rows (h, s1, s2, before, after, n, seg) of segments, one per content and
    batch, and rows (h, s1, s2, c1, c2, place) of where they stand (seg null)."""
    schema = "h long, s1 long, s2 long, before int, after int, n long, seg binary, c1 long, c2 long, place long"

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            col = [b.column(i) for i in range(5)]
            c1, c2, copies = (col[i].to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            held: dict = {}
            refs = []
            for r in range(b.num_rows):
                raw = unpack.decompress(col[2][r].as_py())
                at = np.asarray(col[4][r].values)
                for x in at.tolist():
                    place, lo, hi = x >> 16, (x >> 8) & 255, x & 255
                    seg = raw[place - lo: place - hi + LENGTH]
                    d = xxhash.xxh3_128_digest(seg + bytes((lo,)))
                    g = xxhash.xxh3_64_intdigest(raw[place: place + GRAM])
                    known = held.get(d)
                    if known is None:
                        held[d] = [g, lo, LENGTH - hi, int(copies[r]), seg]
                    else:
                        known[3] += int(copies[r])
                    refs.append((g, d, c1[r], c2[r], place))
            for rows in _chunks(list(held.items()), 8192):
                ids = np.frombuffer(b"".join(d for d, _ in rows), dtype=np.int64).reshape(-1, 2)
                n = len(rows)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([v[0] for _, v in rows], dtype=np.uint64).view(np.int64)), pa.array(ids[:, 0]),
                     pa.array(ids[:, 1]), pa.array([v[1] for _, v in rows], pa.int32()),
                     pa.array([v[2] for _, v in rows], pa.int32()), pa.array([v[3] for _, v in rows], pa.int64()),
                     pa.array([v[4] for _, v in rows], pa.binary()), none, none, none], names=names)
            for rows in _chunks(refs, 65536):
                ids = np.frombuffer(b"".join(x[1] for x in rows), dtype=np.int64).reshape(-1, 2)
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([x[0] for x in rows], dtype=np.uint64).view(np.int64)), pa.array(ids[:, 0]),
                     pa.array(ids[:, 1]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.binary()), pa.array([int(x[2]) for x in rows], pa.int64()),
                     pa.array([int(x[3]) for x in rows], pa.int64()), pa.array([x[4] for x in rows], pa.int64())],
                    names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    return texts.select("c1", "c2", "z", "copies", "at").mapInArrow(run, schema)


def _chunks(rows: list, n: int):
    for i in range(0, len(rows), n):
        yield rows[i: i + n]


# ------------------------------------------------------------- suffix order
def common(a: bytes, b: bytes, lo: int = 0) -> int:
    """Length of the common prefix of two byte strings that agree up to ``lo``."""
    n = min(len(a), len(b))
    if a[lo:n] == b[lo:n]:
        return n
    hi = n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class BlindTrie:
    """Orders strings by a trie that keeps only branching places.

    Going down looks at branching bytes alone and may end at a wrong leaf; one
    comparison with that leaf's string tells how far the new one really agrees,
    and it branches off there.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, [0]  # a leaf: indexes of equal strings; a node: (depth, {byte: child})
        for i in range(1, len(strings)):
            self._add(i)

    @staticmethod
    def _byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def _add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        while isinstance(node, tuple):
            node = node[1].get(self._byte(s, node[0])) or next(iter(node[1].values()))
        old = self.strings[node[0]]
        depth = common(s, old)
        if depth == len(s) == len(old):
            node.append(i)
            return
        parent, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, node = node, node[1][self._byte(s, node[0])]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._byte(s, depth)] = [i]
            return
        fork = (depth, {self._byte(old, depth): node, self._byte(s, depth): [i]})
        if parent is None:
            self.root = fork
        else:
            parent[1][self._byte(s, parent[0])] = fork

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def multikey_quicksort(group: np.ndarray, keys: np.ndarray):
    """Order of the columns of ``keys`` by group, then by its rows, and the (first, last)
    places of what is equal in all of them.

    Ternary partition about a median of three, on the key at the segment's depth; the
    middle part goes on with the next key.  All segments of a depth-first recursion
    are independent, so each round parts all that are left at once."""
    order = np.argsort(group, kind="stable")
    place, part, depth = np.arange(len(order)), group[order], np.zeros(len(order), np.int64)
    equal = []
    while len(place):
        start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.append(start, len(place)))
        deep = depth[start] == len(keys)
        same = deep & (size > 1)
        equal.append(np.stack([place[start[same]], place[start[same]] + size[same]], axis=1))
        live = ~deep & (size > 1)
        rows = np.repeat(live, size)
        place, depth, size = place[rows], depth[rows], size[live]
        start = np.cumsum(size) - size
        at = order[place]
        key = keys[depth, at]
        a, b, c = key[start], key[start + size // 2], key[start + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), size)
        side = (key >= pivot).astype(np.int64) + (key > pivot)
        part = np.repeat(3 * np.arange(len(size)), size) + side
        turn = np.argsort(part, kind="stable")
        order[place], part, depth = at[turn], part[turn], (depth + (side == 1))[turn]
    return order, np.concatenate(equal) if equal else np.zeros((0, 2), np.int64)


def suffix_order(group: np.ndarray, strings: list[bytes], skip: int, shallow: int = SHALLOW) -> np.ndarray:
    """Order of the strings by group, then bytes; those of a group agree on
    their first ``skip``.  Multikey quicksort, with eight bytes as a character, down to
    the shallow depth; then blind tries."""
    words = []
    for w in range(0, shallow, 8):
        raw = b"".join(s[skip + w: skip + w + 8].ljust(8, b"\0") for s in strings)
        words.append(np.frombuffer(raw, dtype=">u8").astype(np.uint64))
    order, equal = multikey_quicksort(group, np.array(words).reshape(len(words), len(strings)))
    for a, z in equal.tolist():
        rows = order[a:z]
        order[a:z] = rows[BlindTrie([strings[i] for i in rows.tolist()]).order()]
    return order


def neighbours(group: np.ndarray, strings: list[bytes], order: np.ndarray, width: int) -> np.ndarray:
    """Common prefix of each string and the one before it in ``order`` (-1 across groups)."""
    m = len(strings)
    table = np.frombuffer(b"".join(s[:width].ljust(width, b"\0") for s in strings), dtype=np.uint8).reshape(m, width)
    size = np.array([len(s) for s in strings])
    out = np.full(m, -1, dtype=np.int64)
    for i in range(1, m, 4096):
        j = min(m, i + 4096)
        a, b = order[i:j], order[i - 1: j - 1]
        diff = table[a] != table[b]
        far = np.where(diff.any(axis=1), diff.argmax(axis=1), width)
        far = np.minimum(far, np.minimum(size[a], size[b]))
        out[i:j] = np.where(group[a] == group[b], far, -1)
    return out


def repeated(group: np.ndarray, before: np.ndarray, after: np.ndarray, n: np.ndarray, segs: list[bytes],
             length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """(segment, offset) table: is the string that starts ``offset`` bytes before
    the anchor repeated?  Segments are distinct within their group."""
    m, most = len(segs), length - gram
    right = [s[b:] for s, b in zip(segs, before.tolist())]
    left = [s[:b][::-1] for s, b in zip(segs, before.tolist())]
    order = [suffix_order(group, right, gram), suffix_order(group, left, 0)]
    lcp = [neighbours(group, right, order[0], length), neighbours(group, left, order[1], most)]
    out = np.zeros((m, most + 1), dtype=bool)
    lowest = length - after  # fewest bytes before the anchor among the segment's strings
    run = [np.zeros(m, np.int64), np.zeros(m, np.int64)]
    for j in range(most + 1):
        live = (lowest <= j) & (j <= before)
        if not live.any():
            continue
        out[:, j] = live & (n > 1)
        for side, need in ((0, length - j), (1, j)):
            run[side][order[side]] = np.cumsum(lcp[side] < need)
        rows = np.flatnonzero(live)
        key = run[0][rows] * (m + 1) + run[1][rows]
        at = np.argsort(key, kind="stable")
        k = key[at]
        eq = k[1:] == k[:-1]
        twice = np.zeros(len(k), dtype=bool)
        twice[1:] |= eq
        twice[:-1] |= eq
        out[rows[at[twice]], j] = True
    return out


def _runs(table: np.ndarray):
    """(row, first, last) of the runs of true values in each row."""
    pad = np.zeros((table.shape[0], table.shape[1] + 2), dtype=np.int8)
    pad[:, 1:-1] = table
    step = np.diff(pad, axis=1)
    row, a = np.nonzero(step == 1)
    _, z = np.nonzero(step == -1)
    return row, a, z - 1


def _sorted_groups(rows: DataFrame) -> DataFrame:
    """(s1, s2, lo, hi): offsets lo..hi at which a segment's strings are repeated."""
    def run(batches):
        held = None
        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if held.num_rows >= BATCH_SEGMENTS:
                h = held.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last group may go on
                if cut:
                    yield compare(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield compare(held)

    def compare(t):
        h, s1, s2, before, after, n = (t.column(c).to_numpy() for c in ("h", "s1", "s2", "before", "after", "n"))
        segs = t.column("seg").to_pylist()
        # equal segments of several batches become one
        at = np.lexsort((s2, s1, h))
        new = np.ones(len(at), dtype=bool)
        new[1:] = (s1[at][1:] != s1[at][:-1]) | (s2[at][1:] != s2[at][:-1]) | (h[at][1:] != h[at][:-1])
        one = at[new]
        total = np.add.reduceat(n[at], np.flatnonzero(new))
        group = h[one]
        size = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        many = np.repeat(np.diff(size) > 1, np.diff(size)) | (total > 1)
        one, total = one[many], total[many]
        table = repeated(h[one], before[one].astype(np.int64), after[one].astype(np.int64), total,
                         [segs[i] for i in one.tolist()]) if len(one) else np.zeros((0, 1), bool)
        row, a, z = _runs(table)
        return pa.RecordBatch.from_arrays([pa.array(s1[one][row]), pa.array(s2[one][row]), pa.array(a.astype(np.int32)),
                                           pa.array(z.astype(np.int32))], names=["s1", "s2", "lo", "hi"])

    rows = rows.select("h", "s1", "s2", "before", "after", "n", "seg").repartition("h").sortWithinPartitions("h")
    return rows.mapInArrow(run, "s1 long, s2 long, lo int, hi int")


def _counted_groups(rows: DataFrame) -> DataFrame:
    """The same for crowded hashes: each string by its own 128-bit hash."""
    def run(batches):
        for b in batches:
            t = {c: b.column(b.schema.get_field_index(c)).to_pylist() for c in b.schema.names}
            for part in _chunks(list(range(b.num_rows)), 512):
                ids, s1, s2, at, n = [], [], [], [], []
                for i in part:
                    seg, before = t["seg"][i], t["before"][i]
                    for j in range(LENGTH - t["after"][i], before + 1):
                        ids.append(xxhash.xxh3_128_digest(seg[before - j: before - j + LENGTH]))
                        s1.append(t["s1"][i])
                        s2.append(t["s2"][i])
                        at.append(j)
                        n.append(t["n"][i])
                w = np.frombuffer(b"".join(ids), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[:, 0]), pa.array(w[:, 1]), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                     pa.array(at, pa.int32()), pa.array(n, pa.int64())], names=["w1", "w2", "s1", "s2", "lo", "n"])

    one = rows.groupBy("h", "s1", "s2").agg(F.max(F.struct("before", "after", "seg")).alias("x"), F.sum("n").alias("n"))
    one = one.select("s1", "s2", "x.before", "x.after", "x.seg", "n")
    strings = one.mapInArrow(run, "w1 long, w2 long, s1 long, s2 long, lo int, n long")
    twice = strings.groupBy("w1", "w2").agg(F.sum("n").alias("m")).filter("m > 1").select("w1", "w2")
    return strings.join(twice, ["w1", "w2"], "left_semi").select("s1", "s2", "lo", F.col("lo").alias("hi"))


# ------------------------------------------------------------------- removal
def spans(docs: DataFrame, kept: DataFrame, text: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(c1, c2, cover): per distinct text, the covered byte ranges (start << 32 | end)."""
    texts = packed_texts(docs, text).join(candidates(kept), ["c1", "c2"])
    table = materialize(segments(texts), "suffix-segments")
    segs = table.filter("seg is not null")
    crowd = segs.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > group_rows).select("h")
    crowd = materialize(crowd, "suffix-crowded")
    found = _sorted_groups(segs.join(crowd, "h", "left_anti"))
    if not crowd.isEmpty():
        found = found.unionByName(_counted_groups(segs.join(crowd, "h", "left_semi")))
    found = materialize(found, "suffix-repeats")
    refs = table.filter("place is not null").select("s1", "s2", "c1", "c2", "place")
    cover = refs.join(found, ["s1", "s2"]).select(
        "c1", "c2", ((F.col("place") - F.col("hi")) * F.lit(1 << 32) + F.col("place") - F.col("lo") + LENGTH).alias("x"))
    return cover.groupBy("c1", "c2").agg(F.sort_array(F.collect_set("x")).alias("cover"))


def merged(cover: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x in cover:
        a, z = x >> 32, x & 0xFFFFFFFF
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans and the SHA-256 of
    what is kept."""
    kept = materialize(store(docs, key, text), "suffix-anchors")
    cover = materialize(spans(docs, kept, text, group_rows), "suffix-cover")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            gone, runs, sha = [], [], []
            for z, cover in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                raw, cut = unpack.decompress(z), merged(cover)
                left, at = hashlib.sha256(), 0
                for a, e in cut:
                    left.update(raw[at:a])
                    at = e
                left.update(raw[at:])
                gone.append(sum(e - a for a, e in cut))
                runs.append(len(cut))
                sha.append(left.digest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.int64()),
                                              pa.array(runs, pa.int64()), pa.array(sha, pa.binary())],
                                             names=["c1", "c2", "gone", "runs", "left"])

    cut = packed_texts(docs, text).join(cover, ["c1", "c2"]).select("c1", "c2", "z", "cover").mapInArrow(
        run, "c1 long, c2 long, gone long, runs long, left binary")
    out = kept.select("_key", "c1", "c2", "n_bytes", "sha").join(cut, ["c1", "c2"], "left")
    zero = F.lit(0).cast("long")
    return out.select(F.col("_key").alias(key), "n_bytes", F.coalesce("gone", zero).alias("n_removed"),
                      F.coalesce("runs", zero).alias("n_spans"),
                      F.lower(F.hex(F.coalesce("left", "sha"))).alias("kept_sha256"))

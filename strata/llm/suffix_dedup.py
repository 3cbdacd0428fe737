"""Removal of every repeated byte string of a given length, by bucket-pointer refinement.

A byte string of ``window`` bytes that starts at two places of the corpus is
removed at all of them.  Positions are sorted into buckets, and a bucket is
refined by the bucket identifiers of later offsets: the identifier of 2h
bytes is made from the two identifiers of h bytes at i and i + h, so every
round reuses what the round before wrote, from 8 bytes up to the window.  An
identifier depends on content alone, so tasks agree on it without exchange;
only the occupancy of buckets has to be exchanged.

1. Every window points at the least of its grams (half the window's power of
   two).  Consecutive windows with one pointer form a run: one row instead of
   dozens.  Runs fall into the bucket of their gram.
2. Inside a bucket, runs whose whole extent is equal repeat; a run alone in
   its bucket does not.  Sorting the bucket by extent shows both.
3. What is left are runs that share their gram but not their extent.  Their
   bytes are fetched once and refined window by window: small buckets inside
   one task, large ones by a further exchange of window identifiers.

Rows of equal extent are folded inside a task, so a group of copies reaches
the exchange once per task.  Buckets that a sample shows to be large are dealt
over several partitions; the sample changes the layout, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import staged

WINDOW = 200
CHUNK = 2 << 20  # bytes hashed together; longer texts are taken in pieces that overlap by a window
FLUSH = 1 << 20  # runs folded together in a task
MEMBERS = 4096  # runs of a bucket that one task refines alone
SAMPLE = 64  # one text in so many shows which buckets are large
LARGE, SPLITS = 4096, 64  # at most so many buckets are dealt over so many partitions each
BROADCAST = 64 << 20  # bytes of positions that may be sent to every task; beyond, both sides are shuffled

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_ONES = np.uint64(0xFFFFFF)  # positions inside a chunk


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bucket identifier of two identifiers, the second at a later offset."""
    x = a * _M1
    x += b * _M2
    x ^= x >> np.uint64(29)
    x *= _M3
    x ^= x >> np.uint64(32)
    return x


def _power(window: int) -> int:
    if not 16 <= window <= 500:
        raise ValueError("the window must have 16 to 500 bytes")
    return 1 << (window.bit_length() - 1)


def refined(buf: np.ndarray, depth: int) -> dict[int, np.ndarray]:
    """Identifiers of the grams of 8 (their bytes), 16, ... ``depth`` bytes at every position of ``buf``."""
    n = len(buf) - 7
    words = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        words[k::8] = np.frombuffer(buf, "<u8", (n - k + 7) // 8, k)
    out, h = {8: words}, 8
    while h < depth:
        a = out[h]
        out[2 * h] = pair(a[:-h], a[h:])
        h *= 2
    return out


def extent(grams: np.ndarray, at: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """Identifier of ``length`` bytes from ``at`` (depth to 4 * depth of them), from identifiers of ``depth`` bytes."""
    x = length.astype(np.uint64)
    for k in range(4):
        x = pair(x, grams[at + k * (length - depth) // 3])
    return x


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    h = 1
    while 2 * h <= width:
        v = np.minimum(v[:-h], v[h:])
        h *= 2
    return np.minimum(v[:len(v) - (width - h)], v[width - h:]) if h < width else v


def _pieces(texts: Sequence[bytes], window: int, chunk: int = CHUNK) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text number, offset, bytes) of about ``chunk`` bytes; every window lies in exactly one piece."""
    some, size = [], 0
    for i, t in enumerate(texts):
        for lo in range(0, max(len(t) - window + 1, 0), chunk):
            piece = t[lo:lo + chunk + window - 1]
            if some and size + len(piece) > chunk:
                yield some
                some, size = [], 0
            some.append((i, lo, piece))
            size += len(piece)
    if some:
        yield some


class Windows:
    """All windows of some pieces: identifiers, and the piece and place of each window that lies inside one."""

    def __init__(self, pieces: list[tuple[int, int, bytes]], window: int):
        depth = _power(window)
        size = np.array([len(p[2]) for p in pieces])
        self.begin = np.r_[0, size.cumsum()[:-1]]
        self.window, self.depth, self.gram = window, depth, depth // 2
        buf = np.frombuffer(b"".join(p[2] for p in pieces) + bytes(8), np.uint8)
        ids = refined(buf, depth)
        self.deep, self.grams = ids[depth], ids[self.gram]
        n = int(size.sum())
        inside = np.ones(n, bool)
        for lo, end in zip(self.begin, self.begin + size):
            inside[max(lo, end - window + 1):end] = False
        self.at = np.flatnonzero(inside)  # starts of windows
        self.piece = np.repeat(np.arange(len(pieces)), np.maximum(size - window + 1, 0))

    def identifiers(self) -> np.ndarray:
        """One identifier per window."""
        return pair(self.deep[self.at], self.deep[self.at + self.window - self.depth])

    def runs(self) -> tuple[np.ndarray, ...]:
        """(piece, offset in it, windows, gram identifier, extent identifier) of every run of windows with one pointer."""
        low = (self.grams & ~_ONES) | np.arange(len(self.grams), dtype=np.uint64)
        pointer = (_least(low, self.window - self.gram + 1)[self.at] & _ONES).astype(np.int64)
        new = np.r_[True, (pointer[1:] != pointer[:-1]) | (self.piece[1:] != self.piece[:-1])]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(self.at)])
        at, piece = self.at[first], self.piece[first]
        return (piece, at - self.begin[piece], n, self.grams[pointer[first]],
                extent(self.deep, at, n + self.window - 1, self.depth))


def _folded(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether the identifier occurs again here, whether this is its first row)."""
    _, first, inverse, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
    lead = np.zeros(len(ids), bool)
    lead[first] = True
    return n[inverse] > 1, lead


def joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, start, end) with spans of one document that meet or overlap made one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    reach, base = end.copy(), doc != np.r_[doc[:1], doc[:-1]]
    group = base.cumsum()
    shift = group.astype(np.int64) << 32  # a running maximum that starts anew with every document
    reach = np.maximum.accumulate(reach + shift) - shift
    new = np.r_[True, base[1:] | (start[1:] > reach[:-1])]
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.r_[at[1:] - 1, len(doc) - 1]]


def doc_key(text: Column) -> list[Column]:
    """What names a text: 96 bits of its content, so that equal texts share their spans."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("d1"), F.hash(t).alias("d2")]


def _utf8(col: pa.Array) -> list[bytes]:
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


_RUN = "part bigint, hull bigint, d1 bigint, d2 int, start int, n int, kind int"
_DONE, _TWICE, _LARGE = 1, 2, 4  # bits of kind


def _run_rows(texts: DataFrame, window: int, large: frozenset[int]) -> DataFrame:
    """Runs of (text, d1, d2): one row per distinct extent and task, and finished spans (``n`` bytes) of those that repeat there."""
    wide = np.array(sorted(large), np.int64)

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        d1, d2, start, n, gram, hull = (np.concatenate(x) for x in zip(*rows))
        again, lead = _folded(pair(gram, hull))
        part, hull = gram.astype(np.int64), hull.astype(np.int64)
        spread = np.isin(part, wide)
        part = np.where(spread, pair(gram, (hull % SPLITS).astype(np.uint64)).astype(np.int64), part)
        # documents by number here, so that spans of one can be joined
        _, number = np.unique(d1 ^ (d2.astype(np.int64) << 17), return_inverse=True)
        doc, begin, end = joined(number[again], start[again].astype(np.int64), (start + n + window - 1)[again].astype(np.int64))
        at = np.zeros(number.max() + 1 if len(number) else 0, np.int64)
        at[number] = np.arange(len(number))
        own = at[doc]
        kind = np.where(again, _TWICE, 0) + np.where(spread, _LARGE, 0)
        cat = lambda x, y, t: pa.array(np.concatenate([x, y]).astype(t))
        return pa.RecordBatch.from_arrays(
            [cat(part[lead], d1[own] * 31 + begin, np.int64), cat(hull[lead], begin, np.int64), cat(d1[lead], d1[own], np.int64),
             cat(d2[lead], d2[own], np.int32), cat(start[lead], begin, np.int32), cat(n[lead], end - begin, np.int32),
             cat(kind[lead], np.full(len(doc), _DONE), np.int32)],
            ["part", "hull", "d1", "d2", "start", "n", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            d1, d2 = b.column(1).to_numpy(), b.column(2).to_numpy()
            for some in _pieces(_utf8(b.column(0)), window):
                w = Windows(some, window)
                piece, off, n, gram, hull = w.runs()
                which = np.array([p[0] for p in some])[piece]
                begin = np.array([p[1] for p in some], np.int64)[piece] + off
                rows.append((d1[which], d2[which], begin, n, gram, hull))
                held += len(n)
                if held >= FLUSH:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)

    return texts.mapInArrow(run, _RUN)


def _large_buckets(texts: DataFrame, window: int, members: int) -> frozenset[int]:
    """Grams that a sample of texts finds in many extents: where rows would pile up."""
    some = texts.filter(F.pmod("d1", F.lit(SAMPLE)) == 0)
    rows = _run_rows(some, window, frozenset()).filter(F.col("kind").bitwiseAND(F.lit(_DONE)) == 0)
    n = rows.select("part", "hull").distinct().groupBy("part").count()
    return frozenset(r["part"] for r in n.filter(F.col("count") >= max(2, members // SAMPLE)).orderBy(F.desc("count")).limit(LARGE).collect())


def _has(bit: int) -> Column:
    return F.col("kind").bitwiseAND(F.lit(bit)) != 0


def _sorted_buckets(rows: DataFrame, window: int, members: int) -> DataFrame:
    """Runs that repeat (``spans``), and those to refine: rows (d1, d2, start, n, part, repeats, open, large, span)."""
    bucket = Window.partitionBy("part")
    w = bucket.orderBy("hull")
    before, after = F.lag("hull").over(w), F.lead("hull").over(w)
    near = rows.withColumns({"before": before, "after": after})
    sized = near.withColumns({"low": F.min("hull").over(bucket), "high": F.max("hull").over(bucket), "members": F.count("hull").over(bucket)})
    same = F.coalesce(F.col("before") == F.col("hull"), F.lit(False)) | F.coalesce(F.col("after") == F.col("hull"), F.lit(False)) | _has(_TWICE)
    first = F.coalesce(F.col("before") != F.col("hull"), F.lit(True))
    shared = ~_has(_DONE) & first & ((F.col("low") != F.col("high")) | _has(_LARGE))
    out = sized.select(
        "d1", "d2", "start", "n", "part", (same | _has(_DONE)).alias("repeats"), shared.alias("open"),
        (_has(_LARGE) | (F.col("members") > members)).alias("large"),
        F.when(_has(_DONE), F.col("n")).otherwise(F.col("n") + F.lit(window - 1)).alias("span"))
    return staged(out.filter(F.col("repeats") | F.col("open")), "suffix-buckets")


def _small_side(df: DataFrame, rows: int, width: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` (measured) of ``width`` bytes are few; else Spark shuffles both sides."""
    return F.broadcast(df) if rows * width <= BROADCAST else df


def _extents(texts: DataFrame, todo: DataFrame, rows: int, window: int) -> DataFrame:
    """The bytes of the runs to refine, once per run and task: (part, d1, d2, start, repeats, large, bytes)."""
    per_doc = todo.groupBy("d1", "d2").agg(F.collect_list(F.struct("part", "start", "n", "repeats", "large")).alias("runs"))
    both = texts.join(_small_side(per_doc, rows, 64), ["d1", "d2"]).select("text", "d1", "d2", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for b in batches:
            out = []
            for t, d1, d2, runs in zip(_utf8(b.column(0)), *(b.column(i).to_pylist() for i in (1, 2, 3))):
                if (d1, d2) in seen:
                    continue
                if len(seen) >= FLUSH:
                    seen.clear()
                seen.add((d1, d2))
                for r in runs:
                    out.append((r["part"], d1, d2, r["start"], r["repeats"], r["large"], t[r["start"]:r["start"] + r["n"] + window - 1]))
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _EXTENT)], schema=_EXTENT)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _EXTENT)], schema=_EXTENT)

    return both.mapInArrow(run, "part bigint, d1 bigint, d2 int, start int, repeats boolean, large boolean, bytes binary")


_SPANS = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
_EXTENT = pa.schema([("part", pa.int64()), ("d1", pa.int64()), ("d2", pa.int32()), ("start", pa.int32()),
                     ("repeats", pa.bool_()), ("large", pa.bool_()), ("bytes", pa.binary())])


def _refined(extents: DataFrame, window: int, members: int) -> DataFrame:
    """Windows of the extents: (id, d1, d2, start, n, kind): finished spans, and rows of large buckets still to be counted.

    Buckets arrive whole and in order, so a small bucket is settled where it
    is; windows of a large one are folded and handed on.
    """

    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        pieces = [(i, 0, x) for i, x in enumerate(t.column("bytes").to_pylist())]
        w = Windows(pieces, window)
        part = t.column("part").to_numpy().astype(np.uint64)
        repeats, large = t.column("repeats").to_numpy(), t.column("large").to_numpy()
        start = t.column("start").to_numpy().astype(np.int64)
        d1, d2 = t.column("d1").to_numpy(), t.column("d2").to_numpy()
        ids, row = w.identifiers(), w.piece
        small = ~large[row]
        ids[small] = pair(ids[small], part[row[small]])
        again, lead = _folded(ids)
        off = start[row] + w.at - w.begin[row]
        new = again & ~repeats[row]  # runs that repeat are known already
        doc, begin, end = joined(row[new], off[new], off[new] + window)
        ask = lead & ~small
        cat = lambda x, y, k: pa.array(np.concatenate([x, y]).astype(k))
        yield pa.RecordBatch.from_arrays(
            [cat(np.zeros(len(doc), np.int64), ids[ask].astype(np.int64), np.int64),
             cat(d1[doc], d1[row[ask]], np.int64), cat(d2[doc], d2[row[ask]], np.int32), cat(begin, off[ask], np.int32),
             cat(end - begin, np.full(int(ask.sum()), window), np.int32),
             cat(np.full(len(doc), _DONE), np.where(again[ask], _TWICE, 0), np.int32)],
            ["id", "d1", "d2", "start", "n", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= 2 * members:
                part, large = held.column("part").to_numpy(), held.column("large").to_numpy()
                cuts = np.flatnonzero((part[1:] != part[:-1]) | (large[1:] & large[:-1])) + 1
                cuts = cuts[cuts <= 2 * members]
                cut = int(cuts[-1]) if len(cuts) else held.num_rows
                yield from settle(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from settle(held)

    dealt = extents.repartition("part").sortWithinPartitions("part")
    return staged(dealt.mapInArrow(run, "id bigint, d1 bigint, d2 int, start int, n int, kind int"), "suffix-windows")


def repeated_spans(docs: DataFrame, window: int = WINDOW, text: str = "text", members: int = MEMBERS) -> DataFrame:
    """(d1, d2, spans): per distinct text with repeats, its byte spans (start, length), unordered and overlapping.

    ``d1, d2`` name the text (:func:`doc_key`).  Every byte of every
    ``window``-byte string that starts at two places or more lies in a span,
    and no other byte does.
    """
    _power(window)  # a window out of range raises here
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), *doc_key(F.col(text)))
    texts = texts.filter(F.octet_length("text") >= window)
    buckets = _sorted_buckets(_run_rows(texts, window, _large_buckets(texts, window, members)), window, members)
    known = buckets.filter("repeats").select("d1", "d2", "start", F.col("span").alias("n"))
    todo = buckets.filter("open").select("d1", "d2", "part", "start", "n", "repeats", "large")
    windows = _refined(_extents(texts, todo, todo.count(), window), window, members)
    late = windows.filter(~_has(_DONE)).withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("id")))
    spans = known.unionByName(windows.filter(_has(_DONE)).select("d1", "d2", "start", "n")).unionByName(
        late.filter((F.col("members") > 1) | _has(_TWICE)).select("d1", "d2", "start", "n"))
    return staged(spans.groupBy("d1", "d2").agg(F.collect_list(F.struct("start", "n")).alias("spans")), "suffix-spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: Sequence[str] = ("doc_id",), text: str = "text",
                   members: int = MEMBERS) -> DataFrame:
    """The ``carry`` columns of every row, with n_bytes, spans (start, end) that go, n_removed, and the bytes ``kept``.

    Texts are UTF-8 bytes, NULL is empty.  A byte goes if a string of
    ``window`` bytes that covers it also starts elsewhere, in the same text or
    another; all its places go, overlaps included.  Equal rows are separate
    texts.  A carried column replaces an output of its name.  Empty tables
    give empty results.
    """
    spans = repeated_spans(docs, window, text, members)
    rows, total = spans.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    own = docs.select(F.struct(*carry).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"), *doc_key(F.col(text)))
    both = own.join(_small_side(spans, rows * 3 + total, 16), ["d1", "d2"], "left").select("row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone, removed, sizes, kept = [], [], [], []
            for t, found in zip(_utf8(b.column(1)), b.column(2).to_pylist()):
                cut = []
                if found:
                    at = np.array([(s["start"], s["start"] + s["n"]) for s in found], np.int64)
                    cut = list(zip(*(x.tolist() for x in joined(np.zeros(len(at), np.int64), at[:, 0], at[:, 1])[1:])))
                last, parts = 0, []
                for lo, hi in cut:
                    parts.append(t[last:lo])
                    last = hi
                parts.append(t[last:])
                kept.append(b"".join(parts))
                sizes.append(len(t))
                removed.append(len(t) - len(kept[-1]))
                gone.append([{"start": lo, "end": hi} for lo, hi in cut])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(gone, kind), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["row", "n_bytes", "spans", "n_removed", "kept"])

    schema = T.StructType([both.schema["row"]]).add("n_bytes", "long").add("spans", _SPANS).add("n_removed", "long").add("kept", "binary")
    out = both.mapInArrow(run, schema)
    return out.select("row.*", *[c for c in ("n_bytes", "spans", "n_removed", "kept") if c not in carry])

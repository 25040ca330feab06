"""Removal of repeated byte strings with suffix arrays by shards.

A byte goes if a ``length``-byte string that covers it also starts anywhere else in the corpus.  Such a
string is called a window.

1. Every window has an *anchor*, the ``GRAM``-byte string of least hash in it (the leftmost of equals).
   Equal windows have equal anchors at equal places, so it is enough to compare windows of one anchor.
   Consecutive windows with one anchor are a *segment*: its text, with the anchor's key and a text hash.
2. A key with one segment in the whole corpus can't hold a repeat.  The segments of all other keys, equal
   ones once with their number, are dealt out by key into shards.
3. A shard gets a suffix array by Larsson-Sadakane refinement (ranks double their depth, only groups that
   are still tied are sorted again) and Kasai's common prefixes.  Neighbours with ``length`` bytes in
   common are equal windows; a class of them whose segments stand more than once in all is repeated, and
   its bytes go wherever those segments stand.
4. A key with very many segments is split over several shards.  Each sends the sorted fingerprints of its
   windows, cut at common bounds by binary search; for each range the shards' lists are merged by binary
   search, and what several shards hold goes back to them.

No step collects the segments of a key, a document's partners or pairs in one place.

Segments count as equal if key and text hash (64 bits each) are; split keys compare windows by two
64-bit fingerprints.  All else compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stash

GRAM = 32
SLICE = 1 << 18  # bytes that are hashed at a time, so that they stay in the cache
SHARD = 1 << 18  # bytes of a suffix array, which then stays in the processor's cache
HOT = 1024  # segments of a key in one shard
MOST = 1000  # equal segments are frequent if they are more than this part of all
BASE = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class Rolling:
    """Polynomial hashes modulo 2**64 of any substring of a byte array."""

    def __init__(self, data: np.ndarray, which: int = 0):
        base = BASE[which] | 1
        n = len(data)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(n, base, np.uint64))
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power)))
            self.back = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def segments(data: np.ndarray, first: np.ndarray, size: np.ndarray, length: int):
    """Segments of texts laid end to end: (text number, start, windows, key, text hash), starts in ``data``."""
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0 or not (size >= length).any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    roll = Rolling(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = roll.of(at, at + GRAM)
    # 40 bits of hash, then the place: the least is the leftmost of the least.
    low = (gram >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    width, reach = length - GRAM + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    anchor = (low[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)[:n]
    valid = np.arange(n) + length <= (first + size)[text]
    begin = np.ones(n, bool)
    begin[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    begin &= valid
    start = np.flatnonzero(begin)
    run = np.cumsum(begin)[valid]
    windows = np.bincount(run, minlength=len(start) + 1)[1:]
    return text[start], start, windows, gram[anchor[start]], roll.of(start, start + windows + length - 1)


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in slices: (bytes, text number, offset in the text, place in the slice, ...) of their parts.

    A text longer than a slice is cut into parts that overlap by ``length - 1`` bytes, so that every
    window is whole in just one part.
    """
    held, size = [], 0
    for k, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - length + 1), SLICE):
            part = t[lo : lo + SLICE + length - 1]
            if len(part) < length:
                continue
            held.append((k, lo, part))
            size += len(part)
            if size >= SLICE:
                yield _laid(held)
                held, size = [], 0
    if held:
        yield _laid(held)


def _laid(held):
    size = np.fromiter((len(p) for _, _, p in held), np.int64, len(held))
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    return data, np.array([k for k, _, _ in held]), np.array([lo for _, lo, _ in held]), size


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes of ``data`` in order, by refining the groups that agree in their first bytes."""
    n = len(data)
    if n < 2:
        return np.arange(n)
    key = np.zeros(n, np.uint64)
    longer = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    left = np.minimum(n - np.arange(n), 7)  # a short suffix goes before a longer one with zero bytes
    for i in range(7):
        key = key << np.uint64(8) | longer[i : n + i]
    key = key << np.uint64(8) | left.astype(np.uint64)
    sa = np.argsort(key)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    fresh = np.append(True, key[sa[1:]] != key[sa[:-1]])
    start = np.flatnonzero(fresh)
    rank[sa] = np.repeat(start, np.diff(np.append(start, n)))
    tied = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))  # places in sa whose group has others
    depth = 7
    while len(tied):
        who = sa[tied]
        group = rank[who]
        after = rank[np.minimum(who + depth, n)]
        order = np.argsort(group * np.int64(n + 1) + after + 1)
        who, group, after = who[order], group[order], after[order]
        sa[tied] = who  # a group's places stay together and in order
        new = np.append(True, (group[1:] != group[:-1]) | (after[1:] != after[:-1]))
        head = np.flatnonzero(new)
        rank[who] = np.repeat(tied[head], np.diff(np.append(head, len(tied))))
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        depth *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Kasai's array: bytes that each suffix of ``sa`` shares with the one before it.

    In the order of the text a suffix shares at least one byte less than its predecessor in the text did,
    and exactly that where the bytes before both are equal; only the other places are compared, eight
    bytes at a time.
    """
    n = len(data)
    if n < 2:
        return np.zeros(n, np.int64)
    before = np.empty(n, np.int64)  # of each suffix, the one before it in the order
    before[sa[1:]], before[sa[0]] = sa[:-1], -1
    at = np.flatnonzero(before >= 0)
    prior = before[at]
    own = (at == 0) | (prior == 0)
    own |= data[at - 1] != data[prior - 1]
    a, b = at[own], prior[own]
    longer = np.concatenate((data, np.zeros(16, np.uint8)))
    word = np.lib.stride_tricks.as_strided(longer, (n + 8, 8), (1, 1))
    shared = np.zeros(n, np.int64)
    live = np.arange(len(a))
    got = np.zeros(len(a), np.int64)
    while len(live):
        x, y = a[live] + got[live], b[live] + got[live]
        inside = (x < n) & (y < n)
        x, y = np.minimum(x, n), np.minimum(y, n)
        wx, wy = np.ascontiguousarray(word[x]).view(np.uint64).ravel(), np.ascontiguousarray(word[y]).view(np.uint64).ravel()
        same = (wx == wy) & inside
        off = ~same & inside
        if off.any():
            diff = np.ascontiguousarray(word[x[off]] != word[y[off]])
            got[live[off]] += diff.argmax(1)
        live = live[same]
        got[live] += 8
    got = np.minimum(got, n - np.maximum(a, b))
    value = np.full(n, -n - 1, np.int64)
    value[a] = got + a
    no = before < 0
    value[no] = np.flatnonzero(no)
    shared = np.maximum.accumulate(value) - np.arange(n)
    return shared[sa]


def equal_windows(texts: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, window, class) of every window of a shard; equal windows have one class."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(size) - size
    sa = suffix_array(data)
    kind = np.cumsum(common_prefixes(data, sa) < length)
    number = np.empty(len(data), np.int64)
    number[sa] = kind
    segment = np.repeat(np.arange(len(texts)), windows)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    return segment, window, number[first[segment] + window]


def spans(segment: np.ndarray, window: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, low, high) of maximal byte runs covered by windows, given in order."""
    if not len(segment):
        return segment, window, window
    new = np.append(True, (segment[1:] != segment[:-1]) | (window[1:] > window[:-1] + length))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(segment)) - 1
    return segment[head], window[head], window[last] + length


def _draw(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, place, key, s) of every segment of every text; place: start and windows, see :func:`_place`."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                piece = batch.slice(lo, 2000)
                texts = [(t or "").encode() for t in piece.column(2).to_pylist()]
                for data, number, offset, size in pieces(texts, length):
                    first = np.cumsum(size) - size
                    part, start, windows, key, s = segments(data, first, size, length)
                    take = pa.array(number[part])
                    yield pa.record_batch(
                        [piece.column(0).take(take), piece.column(1).take(take), pa.array((start - first[part] + offset[part]) * 1024 + windows), pa.array(key.view(np.int64)), pa.array(s.view(np.int64))],
                        names=["doc_id", "th", "place", "key", "s"],
                    )

    return rows.mapInArrow(run, "doc_id long, th long, place long, key long, s long")


def _place(place: Column) -> list[Column]:
    """start and windows of a segment, kept in one number: all its windows hold one string, so they are few."""
    return [F.shiftright(place, 10).alias("start"), place.bitwiseAND(F.lit(1023)).cast("int").alias("windows")]


def _texts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The segments of ``wanted`` with their bytes."""
    by_doc = wanted.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("h")).agg(F.collect_list(F.struct("start", "windows", "key", "salt", "n", "s")).alias("w"))
    both = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))).select("doc_id", "th", "text", "w")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                piece = batch.slice(lo, 500)
                out = []
                for k, (text, w) in enumerate(zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)):
                    data = (text or "").encode()
                    out += [(k, x["start"], x["windows"], x["key"], x["salt"], x["n"], x["s"], data[x["start"] : x["start"] + x["windows"] + length - 1]) for x in w]
                col = list(zip(*out, strict=True)) or [()] * 8
                take = pa.array(col[0], pa.int64())
                yield pa.record_batch(
                    [piece.column(0).take(take), piece.column(1).take(take), *(pa.array(c, t) for c, t in zip(col[1:], (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True))],
                    names=["doc_id", "th", "start", "windows", "key", "salt", "n", "s", "bytes"],
                )

    return both.mapInArrow(cut, "doc_id long, th long, start long, windows int, key long, salt int, n long, s long, bytes binary")


def _shards(parts: DataFrame, length: int) -> DataFrame:
    """Compare the windows of each shard.

    Rows of repeated runs: (doc_id, th, low, high) of segments that occur once, (key, s, low, high)
    counted from the segment's start of those that occur more often.  For split keys the sorted
    fingerprints of the shard's windows (``prints``) follow and those of each segment that occurs once.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = (("doc_id", pa.int64()), ("th", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("key", pa.int64()), ("salt", pa.int32()), ("start", pa.int64()), ("prints", pa.binary()), ("s", pa.int64()))
        held: list[tuple] = []
        size = 0

        def solve(rows: list[tuple]):
            rows = sorted({(r[4], r[5], r[8]): r for r in rows}.values(), key=lambda r: (r[4], r[5]))
            windows, often = (np.array([r[k] for r in rows], np.int64) for k in (3, 6))
            segment, window, kind = equal_windows([r[8] for r in rows], windows, length)
            hit = np.bincount(kind, often[segment])[kind] > 1
            out = []
            for k, a, b in zip(*(x.tolist() for x in spans(segment[hit], window[hit], length)), strict=True):
                doc, th, start, _, key, *_, s, _ = rows[k]
                out.append((doc, th, start + a, start + b, *[None] * 5) if often[k] == 1 else (None, None, a, b, key, None, None, None, s))
            for group in sorted({(r[4], r[5]) for r in rows if r[5] >= 0}):
                every = []
                for r in (r for r in rows if (r[4], r[5]) == group):
                    data, at = np.frombuffer(r[8], np.uint8), np.arange(r[3])
                    every.append(np.stack([Rolling(data, w).of(at, at + length) for w in (0, 1)], 1))
                    if r[6] == 1:
                        out.append((r[0], r[1], None, None, *group, r[2], every[-1].tobytes(), None))
                out.append((None, None, None, None, *group, None, np.unique(np.concatenate(every).view("u8,u8")).tobytes(), None))
            return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True) if out else [()] * 9, kinds, strict=True)], names=[n for n, _ in kinds])

        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(9)), strict=True):
                # A shard ends where a key does.
                if size >= SHARD and held[-1][4:6] != r[4:6]:
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[8])
        if held:
            yield solve(held)

    ready = parts.repartition("key", "salt").sortWithinPartitions("key", "salt")
    return ready.mapInArrow(run, "doc_id long, th long, low long, high long, key long, salt int, start long, prints binary, s long")


def _merge(solved: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, low, high) of windows of split keys that several shards hold."""
    lists = solved.filter("prints IS NOT NULL AND start IS NULL").select("key", "salt", "prints")
    many = lists.groupBy("key").agg(F.count(F.lit(1)).alias("many"))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for key, salt, data, many in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                prints = np.frombuffer(data, "u8,u8")
                bounds = np.array([i * (1 << 64) // many for i in range(1, many)], np.uint64)
                at = [0, *np.searchsorted(prints["f0"], bounds).tolist(), len(prints)]
                rows = [(key, salt, i, prints[a:b].tobytes()) for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["key", "salt", "range", "prints"])

    cuts = lists.join(many, "key").select("key", "salt", "prints", "many").mapInArrow(cut, "key long, salt int, range int, prints binary")

    def merge(pdf):
        import pandas as pd

        lists = [np.frombuffer(x, "u8,u8") for x in pdf["prints"]]
        every = np.sort(np.concatenate(lists), order=("f0", "f1"))
        again = np.unique(every[1:][every[1:] == every[:-1]])
        out = []
        for salt, own in zip(pdf["salt"], lists, strict=True):
            # Binary search of what several shards hold in this shard's own list.
            at = np.minimum(np.searchsorted(own, again), len(own) - 1) if len(again) else np.zeros(0, np.int64)
            found = again[own[at] == again]
            if len(found):
                out.append((pdf["key"].iloc[0], salt, found.tobytes()))
        return pd.DataFrame(out, columns=["key", "salt", "again"])

    again = cuts.groupBy("key", "range").applyInPandas(merge, "key long, salt int, again binary")
    waiting = solved.filter("start IS NOT NULL").select("doc_id", "th", "key", "salt", "start", "prints")

    def back(key, mine, theirs):
        import pandas as pd

        found = np.sort(np.concatenate([np.frombuffer(x, "u8,u8") for x in theirs["again"]]), order=("f0", "f1")) if len(theirs) else np.zeros(0, "u8,u8")
        out = []
        for doc, th, start, data in zip(mine["doc_id"], mine["th"], mine["start"], mine["prints"], strict=True):
            prints = np.frombuffer(data, "u8,u8")
            if not len(found):
                break
            at = np.minimum(np.searchsorted(found, prints), len(found) - 1)
            hit = np.flatnonzero(found[at] == prints)
            out += [(doc, th, start + a, start + b) for _, a, b in zip(*(x.tolist() for x in spans(np.zeros(len(hit), np.int64), hit, length)), strict=True)]
        got = pd.DataFrame(out, columns=["doc_id", "th", "low", "high"])
        got["doc_id"] = got["doc_id"].astype("Int64")
        return got

    return waiting.groupBy("key", "salt").cogroup(again.groupBy("key", "salt")).applyInPandas(back, "doc_id long, th long, low long, high long")


def repeated_runs(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, low, high) byte runs to remove; they may overlap."""
    every = stash(_draw(rows, length), "segments")
    # Most anchors stand once; only the others' segments go on.  A table of its own, so that hot keys can be split.
    again = stash(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "segment-keys")
    drawn = stash(every.join(again, "key"), "segments-again")
    alike = drawn.groupBy("key", "s").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "place")).alias("one"))
    alike = stash(alike, "segment-kinds")
    keys = alike.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.max("n").alias("most"))
    keys = stash(keys.filter("kinds > 1 OR most > 1"), "segment-shared")
    salt = F.when(F.col("kinds") > HOT, F.pmod(F.xxhash64("s"), F.ceil(F.col("kinds") / (HOT // 2)))).otherwise(-1).cast("int")
    wanted = alike.join(keys, "key").select("one.doc_id", "one.th", *_place(F.col("one.place")), "key", salt.alias("salt"), "n", "s")
    solved = stash(_shards(_texts(rows, wanted, length), length), "shards")
    found = solved.filter("th IS NOT NULL AND low IS NOT NULL").select("doc_id", "th", "low", "high")
    again = solved.filter("s IS NOT NULL").select("key", "s", "low", "high")
    start = _place(F.col("place"))[0]
    # Fewer than MOST kinds of segments can be frequent, and each has one run (all its windows overlap): these go to
    # every task, the rows of all other kinds are dealt out.
    often = stash(alike.filter(F.col("n") > max(1, drawn.count() // MOST)).select("key", "s"), "segments-often")
    rest = drawn.join(F.broadcast(often), ["key", "s"], "left_anti").join(again.join(F.broadcast(often), ["key", "s"], "left_anti"), ["key", "s"])
    hot = drawn.join(F.broadcast(again.join(F.broadcast(often), ["key", "s"], "left_semi")), ["key", "s"])
    for part in (rest, hot):
        found = found.unionByName(part.select("doc_id", "th", (start + F.col("low")).alias("low"), (start + F.col("high")).alias("high")))
    if not solved.filter("prints IS NOT NULL").isEmpty():
        found = found.unionByName(_merge(solved, length))
    return found


def dedup(docs: DataFrame, length: int = 200, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text).

    Null text counts as empty; texts under ``length`` bytes lose nothing, nor does any text without a
    repeat.  Repeats are judged on the input.  Rows with equal doc_id (null too) and text lose what the
    corpus repeats, themselves included; rows with equal doc_id and other texts are told apart by a hash.
    Other columns are ignored; an empty table gives an empty result.  With ``texts`` the remaining bytes
    follow as ``kept``.
    """
    if not GRAM <= length < 1024:
        raise ValueError("length must be from 32 to 1023")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"), F.col("text").cast("string").alias("text"))
    found = repeated_runs(rows, length)
    by_doc = found.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("h")).agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    both = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left").select("doc_id", "text", "runs")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode()
                kept, at, removed, n = [], 0, 0, 0
                end = -1
                for lo, hi in sorted((r["low"], r["high"]) for r in runs or ()):
                    if lo > end:  # runs that touch are one
                        n += 1
                        kept.append(data[at:lo])
                        removed += hi - lo
                        end = hi
                    elif hi > end:
                        removed += hi - end
                        end = hi
                    at = max(at, end)
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append((len(data), removed, n, hashlib.sha256(rest).hexdigest(), rest))
            col = list(zip(*out, strict=True)) or [()] * 5
            cols = [batch.column(0), *(pa.array(c, t) for c, t in zip(col, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True))]
            yield pa.record_batch(cols[: 6 if texts else 5], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if texts else 5])

    return both.mapInArrow(cut, schema)

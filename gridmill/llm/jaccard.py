"""Similarity join of documents on the Jaccard index of their word n-grams, by the chosen path.

1. Each document becomes a set of hashes of its n-grams of words.  Equal sets (by 128 bits of hash and their
   size) are one *class* from here on, so copies are never compared; a class is known by its least document.
2. A class is embedded as ``HASHES`` min-wise values; two classes share a value with probability equal to
   their Jaccard index.  A run of the join chooses a path: at each level it samples positions and splits
   the bucket by the values there, until buckets have at most ``SMALL`` classes.  Small buckets are compared
   by brute force on the embedded values, pairs that may reach the threshold become candidates (of a bucket
   with many, a spanning forest).  Runs with other samples follow until the recall aimed at: a pair at the
   threshold survives one run's levels with a known probability, see :func:`runs_needed`.
3. Buckets that stay large after the last level are compared whole as well: they are dealt into blocks of
   ``PART`` and each pair of blocks is one unit of work.  So no pair that shares a bucket is lost, whatever
   the bucket's size, and the number of runs holds for all; the price is the square of such a bucket's size.
4. Candidates connect classes to *groups*.  Within a group every pair is checked exactly on the full sets:
   large groups in pairs of blocks.  Verified links give each class its number of links, and the connected
   classes by verified links are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .chunks import release
from .shared import fresh, stash

HASHES = 64
SMALL = 48
PART = 1024  # classes of a large bucket in a block
LEVELS = (1, 3)  # sampled positions in a bucket's path, by level
SHINGLE = 5
BLOCK = 128  # classes of a group that are checked together


def runs_needed(threshold: float, recall: float = 0.999, level: int = 1) -> int:
    """Runs after which a pair at the threshold has shared a bucket of ``level`` with this probability."""
    p = threshold ** LEVELS[level]
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """64-bit hashes of each text's words: lower case, parted by white space."""
    import xxhash

    split = [(t or "").lower().split() for t in texts]
    distinct = list(set().union(*split)) if split else []
    code = dict(zip(distinct, map(xxhash.xxh3_64_intdigest, distinct), strict=True))
    return [np.fromiter(map(code.__getitem__, s), np.uint64, len(s)) for s in split]


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-grams; a text with fewer words is one n-gram; none without words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    m = max(1, len(words) - n + 1)
    with np.errstate(over="ignore"):
        h = np.full(m, np.uint64(min(len(words), n)))
        for k in range(min(n, len(words))):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + m])
    return np.unique(h)


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def embed(sets: list[np.ndarray]) -> np.ndarray:
    """32 bits of the min-wise values of each set, one row a set."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    full = np.flatnonzero(size)
    if not len(full):
        return out
    flat = np.concatenate([sets[i] for i in full])
    first = np.cumsum(size[full]) - size[full]
    factor = _seeds(HASHES, 7) | np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            h = flat * factor[k]
            h = (h ^ h >> np.uint64(32)) * factor[-1 - k]
            out[full, k] = (_mix(np.minimum.reduceat(h, first)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def sketch(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, a, b, size, values, text_hash): 128-bit signature of each document's set, its size and embedding."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                piece = batch.slice(lo, 1000)
                sets = [shingles(w, n) for w in word_hashes(piece.column(1).to_pylist())]
                values = embed(sets)
                data = [s.tobytes() for s in sets]
                yield pa.record_batch(
                    [piece.column(0), pa.array(np.array([xxhash.xxh3_64_intdigest(d) for d in data], np.uint64).view(np.int64)), pa.array(np.array([xxhash.xxh3_64_intdigest(d, 1) for d in data], np.uint64).view(np.int64)),
                     pa.array([len(s) for s in sets], pa.int32()), pa.array([v.tobytes() for v in values]), piece.column(2)],
                    names=["doc_id", "a", "b", "size", "values", "text_hash"],
                )
            release()

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(run, "doc_id long, a long, b long, size int, values binary, text_hash long")


def paths(rows: DataFrame, runs: int, level: int) -> DataFrame:
    """(key, run, rep): each class under its bucket of every run; keys of ``rows`` are extended to ``level``."""
    low, high = 0 if level == 0 else LEVELS[level - 1], LEVELS[level]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        order = np.stack([np.argsort(_seeds(HASHES, 1000 + r)) for r in range(runs)])
        with np.errstate(over="ignore"):
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, HASHES)
                if level == 0:
                    which, at = np.repeat(np.arange(runs), n), np.tile(np.arange(n), runs)
                    key = _seeds(runs, 99)[which]
                else:
                    which, at = batch.column(3).to_numpy().astype(np.int64), np.arange(n)
                    key = batch.column(2).to_numpy().view(np.uint64)
                for k in range(low, high):
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + values[at, order[which, k]].astype(np.uint64) + np.uint64(1))
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(which.astype(np.int32)), batch.column(0).take(pa.array(at))], names=["key", "run", "rep"])

    return rows.mapInArrow(run, "key long, run int, rep long")


def compare(buckets: DataFrame, least: float) -> DataFrame:
    """Candidate pairs (a, b), a < b, of the classes of each bucket; buckets have a bounded size.

    What follows only asks which classes the candidates connect, so of each bucket's pairs a spanning forest
    is enough: the exact check looks at all pairs of the group.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tail: tuple | None = None

        def pairs(key, rep, values):
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(begin, len(key)))
            found = [np.zeros((0, 2), np.int64)]
            for width in np.unique(size[size > 1]).tolist():
                groups = begin[size == width]
                i, j = np.triu_indices(width, 1)
                some = max(1, 200_000 // len(i))
                for lo in range(0, len(groups), some):
                    g = groups[lo : lo + some, None]
                    alike = np.zeros((len(g), width, width), bool)
                    alike[:, i, j] = (values[g + i] == values[g + j]).sum(2) >= least * HASHES
                    alike |= alike.transpose(0, 2, 1)
                    root = np.tile(np.arange(width), (len(g), 1))
                    while True:
                        new = np.minimum(root, np.where(alike, root[:, None, :], width).min(2))
                        if (new == root).all():
                            break
                        root = new
                    at, k = np.nonzero(root != np.arange(width))
                    found.append(np.stack([rep[g[at, 0] + root[at, k]], rep[g[at, 0] + k]], 1))
            out = np.concatenate(found)
            return np.unique(np.sort(out[out[:, 0] != out[:, 1]], 1), axis=0)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, HASHES)
            if tail is not None:
                key, rep, values = np.append(tail[0], key), np.append(tail[1], rep), np.concatenate((tail[2], values))
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if cut:
                got = pairs(key[:cut], rep[:cut], values[:cut])
                yield pa.record_batch([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])
            tail = (key[cut:], rep[cut:], values[cut:])
        if tail is not None and len(tail[0]):
            got = pairs(*tail)
            yield pa.record_batch([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])

    return buckets.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(run, "a long, b long")


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's connected component, of ``n`` nodes and edges from ``i`` to ``j``."""
    root = np.arange(n)
    while True:
        new = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def compare_large(large: DataFrame, least: float) -> DataFrame:
    """Candidate pairs (a, b), a < b, of buckets (key, run, n, rep, values) of any size: a forest of each unit.

    A unit is a block with itself or a pair of blocks, so every pair of a bucket's classes is in one unit.
    """
    own = large.withColumn("many", F.ceil(F.col("n") / PART).cast("int"))
    own = own.withColumn("i", F.pmod(F.xxhash64("rep", "run"), F.col("many")).cast("int"))
    unit = own.select("key", "i", "rep", "values", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("j"))
    unit = unit.select("key", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "rep", "values")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict = {"unit": None, "parts": []}

        def flush():
            if not held["parts"]:
                return
            side, rep, data = (np.concatenate(x) for x in zip(*held["parts"], strict=True))
            held["parts"] = []
            _, lo, hi = held["unit"]
            left, right = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
            at = max(1, (1 << 22) // max(1, len(right)))  # a block may be larger than PART by chance
            i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k in range(0, len(left), at):
                x = left[k : k + at]
                alike = np.zeros((len(x), len(right)), np.uint8)
                for c in range(HASHES):
                    alike += data[x, c][:, None] == data[right, c][None, :]
                u, v = np.nonzero(alike >= least * HASHES)
                i.append(x[u])
                j.append(right[v])
            root = forest(np.concatenate(i), np.concatenate(j), len(rep))
            k = np.flatnonzero(root != np.arange(len(rep)))
            out = np.sort(np.stack([rep[root[k]], rep[k]], 1), 1)
            yield pa.record_batch([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, lo, hi, side, rep = (batch.column(k).to_numpy() for k in range(5))
            data = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint32).reshape(n, HASHES)
            new = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            begin = np.flatnonzero(np.append(True, new)).tolist()
            for u, v in zip(begin, [*begin[1:], n], strict=True):
                if held["unit"] != (key[u], lo[u], hi[u]):
                    yield from flush()
                    held["unit"] = (key[u], lo[u], hi[u])
                held["parts"].append((side[u:v], rep[u:v], data[u:v]))
        yield from flush()

    return unit.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep").mapInArrow(run, "a long, b long")


def candidates(classes: DataFrame, threshold: float, runs: int, margin: float = 0.17) -> DataFrame:
    """Pairs of classes that may reach the threshold, by runs of the chosen path.

    ``margin`` covers the error of the embedding: over three standard deviations at the threshold.  Buckets
    that are still large at the last level, for which ``runs`` is reckoned, are compared whole.
    """
    least = threshold - margin
    values = classes.select("rep", "values")
    found, large = [], None
    for level in range(len(LEVELS)):
        rows = stash(paths(values if large is None else large.join(values, "rep").select("rep", "values", "key", "run"), runs, level), "paths")
        # A table of its own beside the join: a large bucket's rows can be split over tasks.
        size = stash(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "path-sizes")
        # Classes that are alone in their bucket go no further; only the others' values are looked up.
        shared = stash(rows.join(size, "key"), "path-buckets")
        found.append(compare(shared.filter(F.col("n") <= SMALL).select("key", "rep").join(values, "rep").select("key", "rep", "values"), least))
        large = shared.filter(F.col("n") > SMALL)
        if large.isEmpty():
            break
    else:
        found.append(compare_large(large.join(values, "rep"), least))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return stash(out.distinct(), "path-pairs")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component of ``edges`` (a, b).

    Every node and its root take the least root among the node's neighbours', then their root's root, until
    nothing moves; as roots are hooked too, rounds grow with the logarithm of a component's size, chains
    included.  Each round is a written table, so nothing is lost with an executor and plans stay short.
    """
    both = stash(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    label = stash(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "roots")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        low = stash(label.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "m").alias("m")), "near-roots")
        if low.filter("m < root").isEmpty():  # neighbours agree everywhere
            return label
        hook = low.filter("m < root").groupBy(F.col("root").alias("r")).agg(F.min("m").alias("hook"))
        jump = label.select(F.col("node").alias("r"), F.col("root").alias("rr"))
        to = jump.join(hook, "r", "left").select("r", F.least("rr", "hook").alias("rr"))
        label = stash(low.join(hook.withColumnRenamed("r", "root"), "root", "left").select("node", F.least("m", "hook").alias("r")).join(to, "r").select("node", F.least("r", "rr").alias("root")), "roots")


def verify(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Exact check of all pairs within groups: (rep, root, whole) edges and (rep, links) counts.

    ``members``: (grp, n, rep, set) with the sorted shingles packed.  A group of more than ``BLOCK`` classes
    is dealt into blocks and each pair of blocks is one unit of work; no pair of classes leaves it.  Edges
    are a spanning forest of a unit's links; ``whole``: the unit was the whole group.
    """
    many = F.ceil(F.col("n") / BLOCK).cast("int")
    own = members.withColumn("many", many).withColumn("i", F.pmod(F.xxhash64("rep"), F.col("many")).cast("int"))
    unit = own.select("grp", "many", "i", "rep", "set", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("j"))
    unit = unit.select("grp", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "many", "rep", "set")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, list] = {"key": [], "rows": []}

        def check(rows: list[tuple]):
            rows = list({r[1]: r for r in rows}.values())  # repeated rows of a document
            lo, hi, many = rows[0][3], rows[0][4], rows[0][5]
            side = np.array([r[0] for r in rows])
            sets = [np.frombuffer(r[2], np.uint64) for r in rows]
            size = np.array([len(x) for x in sets])
            m = len(rows)
            who = np.repeat(np.arange(m), size)
            _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            keep = df[code] > 1
            code, who = code[keep], who[keep]
            _, code = np.unique(code, return_inverse=True)
            order = np.argsort(code, kind="stable")
            code, who = code[order], who[order]
            both = np.zeros((m, m), np.float32)
            for at in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
                a, b = np.searchsorted(code, [at, at + 4096])
                x = np.zeros((m, min(4096, int(code[-1]) + 1 - at)), np.float32)
                x[who[a:b], code[a:b] - at] = 1
                both += x @ x.T
            either = size[:, None] + size[None, :] - both
            link = (both >= threshold * either - 1e-6) & (either > 0)
            np.fill_diagonal(link, False)
            if lo != hi:
                link &= side[:, None] != side[None, :]
            root = np.arange(m)
            while True:  # least neighbour, then roots of roots
                near = np.where(link, root[None, :], m).min(1, initial=m)
                new = np.minimum(root, near)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            n = link.sum(1)
            return [(r[1], rows[root[k]][1], int(n[k]), many == 1) for k, r in enumerate(rows)]

        def flush():
            if held["rows"]:
                got = check(held["rows"])
                held["rows"] = []
                yield pa.record_batch([pa.array([g[k] for g in got], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], names=["rep", "root", "links", "whole"])

        for batch in batches:
            for grp, lo, hi, i, many, rep, data in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if held["key"] != [grp, lo, hi]:
                    yield from flush()
                    held["key"] = [grp, lo, hi]
                held["rows"].append((i, rep, data, lo, hi, many))
        yield from flush()

    done = stash(unit.repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi", "rep").mapInArrow(run, "rep long, root long, links long, whole boolean"), "links")
    return done.select("rep", "root", "whole"), done.groupBy("rep").agg(F.sum("links").alias("links"))


def place(docs: DataFrame, threshold: float, n: int, recall: float) -> DataFrame:
    """doc_id, text_hash, root, n_links for every row of ``docs``; the rows of one ``root`` are one class.

    Ids may be null or stand for several texts, so a row is known by doc_id and text hash together.
    """
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    drawn = stash(sketch(slim, n), "sketches")
    signature = ["a", "b", "size"]
    classes = drawn.groupBy(*signature).agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("values").alias("values"))
    classes = stash(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    pairs = candidates(classes.filter("size > 0"), threshold, runs_needed(threshold, recall))
    groups = components(pairs)
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = groups.join(sizes, "root").join(classes.select("rep", "first", "a"), F.col("node") == F.col("rep")).select(F.col("root").alias("grp"), "n", "rep", F.col("first.doc_id").alias("first"), F.col("first.text_hash").alias("first_hash"), "a")
    texts = slim.join(members, F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("text_hash") == F.col("first_hash"))).select("grp", "n", "rep", "text", "a")

    def full(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                piece = batch.slice(lo, 1000)
                data = [shingles(w, n).tobytes() for w in word_hashes(piece.column(3).to_pylist())]
                own = np.array([xxhash.xxh3_64_intdigest(d) for d in data], np.uint64).view(np.int64)
                right = pa.array(own == piece.column(4).to_numpy())  # hashes of texts may meet
                yield pa.record_batch([piece.column(0), piece.column(1), piece.column(2), pa.array(data, pa.binary())], names=["grp", "n", "rep", "set"]).filter(right)

    edges, links = verify(texts.mapInArrow(full, "grp long, n long, rep long, set binary"), threshold)
    roots = edges.filter("whole").select("rep", "root")
    large = edges.filter("NOT whole AND rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    if not large.isEmpty():
        roots = roots.unionByName(components(large).toDF("rep", "root"))
    linked = stash(roots.join(links, "rep").join(classes.select("rep", *signature), "rep").select(*signature, F.col("root").alias("own"), "links"), "linked")
    known = drawn.select("doc_id", "text_hash", *signature).join(linked, signature, "left")
    none = F.lit(None).cast("long")
    root = F.when(F.col("own").isNotNull(), F.struct(F.col("own").alias("x"), none.alias("y"), none.alias("z"))).otherwise(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), F.col("size").cast("long").alias("z")))
    return known.select("doc_id", "text_hash", root.alias("root"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def join_documents(docs: DataFrame, threshold: float = 0.8, n: int = SHINGLE, recall: float = 0.999) -> DataFrame:
    """doc_id, class_id, n_links for every row of ``docs`` (doc_id, text).

    ``class_id`` is the least doc_id of the documents that verified links connect; ``n_links`` is how many
    different other sets the document's set links to (its copies have the same number).  Null and empty
    texts have the empty set and are copies of each other; a text of fewer than ``n`` words is one n-gram.
    Sets are told apart by two 64-bit hashes and their size.  Repeated rows and ids, null too, are copies or links like any
    other row; other columns are ignored; an empty table gives an empty result.
    """
    placed = place(docs, threshold, n, recall).drop("text_hash")
    # A table of its own, so that the join's hot partitions can be split.
    least = stash(placed.groupBy("root").agg(F.min("doc_id").alias("class_id")), "least")
    return placed.join(least, "root").select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, threshold: float = 0.8, n: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each class: that of least doc_id, then least text hash; null ids come last.

    Ids may be null or reused: rows of different classes stay whatever their ids.  Null and blank texts are
    copies of each other; of repeated rows one stays; columns of any name are carried along; an empty table
    gives an empty result.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = place(docs, threshold, n, 0.999).groupBy("root").agg(F.min(order).alias("best"))
    own, mark, text, k = fresh(docs, "own", "mark", "text_hash", "k")
    stay = stash(best.select(F.col("best.doc_id").alias(own), F.col("best.text_hash").alias(mark)), "kept")
    rows = docs.select("*", F.xxhash64(F.col("text").cast("string")).alias(text))
    kept = rows.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.col(text) == F.col(mark)))
    first = W.partitionBy(own, mark).orderBy(F.lit(0))  # rows that repeat doc_id and text
    return kept.withColumn(k, F.row_number().over(first)).filter(F.col(k) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Language ID by a linear-chain conditional random field over words.

Each word with a letter is a position of a chain and its language the label, so text that switches between
languages is labelled word by word.  A word's features are its character n-grams of lengths 2 to 4 with
marks at both ends (those at the ends are its prefixes and suffixes of 1 to 3 characters) and its shares in
the languages of a lexicon learnt from the sample.  Transitions are learnt with them from chains that are
spliced from spans of different documents.  Forward-backward gives each word's marginals; a document's
language has the greatest mean marginal, which is its score.

A text is one chain, whatever its length.  It is worked on in pieces of ``CHAIN`` words side by side; what a
piece hands to its neighbours is computed again until it no longer changes.  What is bounded is the labelled
sample: ``most_docs`` documents, and of each ``WINDOWS`` windows of ``SPAN`` words spread over the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import Split, chunks, release
from .shared import fresh

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
CHAIN = 64
SLICE = 400  # documents of a batch that are split at a time
SPAN = 32
WINDOWS = 6
STEADY = 1e-6  # change of a message between pieces that no longer counts


def fold(doc_id: Column, n: int = 4) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def word_of(chunk: str) -> str:
    """A chunk's letters in lower case (marks and digits go); empty if it has none."""
    return chunk.lower() if chunk.isalpha() else "".join([c for c in chunk if c.isalpha()]).lower()


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of every word, in the order of the words."""
    text = "".join([f"\x02{w}\x03" for w in words])
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(code))  # characters up to the word's end
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        h = code * np.uint64(0x9E3779B97F4A7C15)
        for n in range(2, max(GRAMS) + 1):
            h = h[:-1] * np.uint64(0x100000001B3) ^ code[n - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F) if len(h) > 1 else h[:0]
            ok = left[: len(h)] >= n
            mixed = h[ok]
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            buckets.append((mixed >> np.uint64(48)).astype(np.int64))
            owners.append(owner[: len(h)][ok])
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order], owner[order]


class Crf:
    """Weights: ``w`` (n-gram bucket, label), ``u`` (lexicon share, label), ``t`` (label, next label)."""

    def __init__(self, labels: list[str], lexicon: dict[str, list[float]], w=None, u=None, t=None):
        c = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.w = np.zeros((BUCKETS, c), np.float32) if w is None else w
        self.u = np.zeros((c, c), np.float32) if u is None else u
        self.t = np.zeros((c, c), np.float32) if t is None else t

    def state(self) -> tuple:
        return self.labels, self.lexicon, self.w, self.u, self.t

    def shares(self, words: list[str]) -> np.ndarray:
        none = [0.0] * len(self.labels)
        return np.array([self.lexicon.get(x, none) for x in words], np.float32).reshape(len(words), len(self.labels))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words for each label."""
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        bucket, owner = grams(words)
        first = np.searchsorted(owner, np.arange(len(words)))
        total = np.add.reduceat(self.w[bucket], first, axis=0)
        return total + self.shares(words) @ self.u

    def marginals(self, score: np.ndarray, mask: np.ndarray, pairs: bool = False):
        """Marginals of padded chains: ``score`` (chain, position, label), ``mask`` (chain, position).

        Positions are real from the left.  With ``pairs`` also the expected transitions and the log of the
        normaliser, summed over all chains.
        """
        n, m, c = score.shape
        top = score.max(2, keepdims=True)
        e = np.exp(score - top)
        e[~mask] = 1.0
        step = np.exp(self.t)
        a, z = np.empty_like(e), np.empty((n, m), e.dtype)
        for i in range(m):
            x = e[:, i] if i == 0 else (a[:, i - 1] @ step) * e[:, i]
            if i:
                x = np.where(mask[:, i, None], x, a[:, i - 1])
            z[:, i] = x.sum(1)
            if i:
                z[~mask[:, i], i] = 1.0
            a[:, i] = x / z[:, i, None]
        b = np.ones((n, c), e.dtype)
        out = np.empty_like(e)
        two = np.zeros((c, c))
        out[:, m - 1] = a[:, m - 1]
        for i in range(m - 1, 0, -1):
            real = mask[:, i]
            f = e[:, i] * b / z[:, i, None]
            if pairs:
                two += (a[real, i - 1].T @ f[real]) * step
            b = np.where(real[:, None], f @ step.T, b)
            x = a[:, i - 1] * b
            out[:, i - 1] = x / np.maximum(x.sum(1, keepdims=True), 1e-30)
        if not pairs:
            return out
        return out, two, float((np.log(np.maximum(z, 1e-30)) * mask).sum() + (top[:, :, 0] * mask).sum())

    def documents(self, split: list[list[str]]) -> np.ndarray:
        """Mean marginals of each list of words; zeros for an empty one."""
        distinct = list(set().union(*split)) if split else []
        number = {w: i for i, w in enumerate(distinct)}
        n = np.fromiter(map(len, split), np.int64, len(split))
        return self.coded(distinct, np.fromiter((number[w] for s in split for w in s), np.int64, int(n.sum())), n)

    def linked(self, score: np.ndarray, mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Marginals of chains cut into pieces: ``score`` (piece, position, label), in order.

        ``starts``: the piece begins a chain; else it goes on the one before, whose positions are all real.
        """
        n, m, c = score.shape
        e = np.exp(score - score.max(2, keepdims=True))
        e[~mask] = 1.0
        step = np.exp(self.t)
        a, b = np.empty_like(e), np.empty_like(e)

        def forward(which, before):
            x = before * e[which, 0]
            a[which, 0] = x / x.sum(1, keepdims=True)
            for i in range(1, m):
                x = (a[which, i - 1] @ step) * e[which, i]
                a[which, i] = np.where(mask[which, i, None], x / np.maximum(x.sum(1, keepdims=True), 1e-30), a[which, i - 1])

        def backward(which, after):
            b[which, m - 1] = after
            for i in range(m - 1, 0, -1):
                x = (e[which, i] * b[which, i]) @ step.T
                b[which, i - 1] = np.where(mask[which, i, None], x / np.maximum(x.sum(1, keepdims=True), 1e-30), b[which, i])

        ones = np.ones((n, c), e.dtype)
        goes_on = np.flatnonzero(~starts)
        for run, neighbour, message in (
            (forward, -1, lambda k: a[k, m - 1] @ step),
            (backward, 1, lambda k: (e[k, 0] * b[k, 0]) @ step.T),
        ):
            run(np.arange(n), ones)
            # A piece that goes on gets its neighbour's message; the one before it gets its own, backward.
            todo = goes_on if neighbour < 0 else goes_on - 1
            held = np.full((n, c), np.inf)
            while len(todo):
                new = message(todo + neighbour)
                new /= np.maximum(new.sum(1, keepdims=True), 1e-30)
                moved = np.abs(new - held[todo]).max(1) > STEADY
                todo, new = todo[moved], new[moved]
                if not len(todo):
                    break
                held[todo] = new
                run(todo, new)
                follow = todo - neighbour
                todo = follow[(follow >= 0) & (follow < n)]
                todo = todo[~starts[todo]] if neighbour < 0 else todo[~starts[todo + 1]]
        p = a * b
        return p / np.maximum(p.sum(2, keepdims=True), 1e-30)

    def coded(self, distinct: list[str], ids: np.ndarray, n: np.ndarray, words: bool = False):
        """Mean marginals of texts of ``n`` words each, given as numbers of distinct words.

        With ``words`` also each word's own.
        """
        c = len(self.labels)
        table = self.emissions(distinct)
        out, each = np.zeros((len(n), c)), np.zeros((len(ids) if words else 0, c))
        if len(ids):
            doc = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
            begins = np.flatnonzero(at % CHAIN == 0)
            size = np.diff(np.append(begins, len(ids)))
            starts = at[begins] == 0
            short = starts & (size <= 8)  # apart, so that little is padded
            for width, chosen in ((8, np.flatnonzero(short)), (CHAIN, np.flatnonzero(~short))):
                lo = 0
                while lo < len(chosen):
                    hi = min(lo + 4096, len(chosen))
                    while hi < len(chosen) and not starts[chosen[hi]]:  # a chain stays whole
                        hi += 1
                    part, lo = chosen[lo:hi], hi
                    mask = np.arange(width) < size[part, None]
                    index = np.minimum(begins[part, None] + np.arange(width), len(ids) - 1)
                    p = self.linked(table[ids[index]], mask, starts[part])
                    sums = (p * mask[:, :, None]).sum(1)
                    for k in range(c):
                        out[:, k] += np.bincount(doc[begins[part]], sums[:, k], len(n))
                    if words:
                        each[index[mask]] = p[mask]
        out /= np.maximum(n, 1)[:, None]
        return (out, each) if words else out


def train(samples: list[tuple[str, list[str]]], rounds: int = 4, rate: float = 0.3, seed: int = 1) -> Crf:
    """Fit a model to (label, words) windows, spliced two by two so that chains switch labels."""
    rng = np.random.default_rng(seed)
    samples = sorted(samples)
    labels = sorted({y for y, _ in samples})
    number = {y: i for i, y in enumerate(labels)}
    c = len(labels)
    # The lexicon comes from every other window: the model also learns to do without it.
    seen: dict[str, Counter] = {}
    for y, words in samples[::2]:
        for w in words:
            seen.setdefault(w, Counter())[number[y]] += 1
    lexicon = {w: [k[i] / (sum(k.values()) + 1) for i in range(c)] for w, k in seen.items() if sum(k.values()) > 1}
    model = Crf(labels, lexicon)
    if c < 2:
        return model
    distinct = sorted({w for _, words in samples for w in words})
    index = {w: i for i, w in enumerate(distinct)}
    bucket, owner = grams(distinct)
    first = np.searchsorted(owner, np.arange(len(distinct) + 1))
    share = model.shares(distinct)
    coded = [(number[y], np.array([index[w] for w in words])) for y, words in samples]
    square = [np.full_like(x, 1e-2) for x in (model.w, model.u, model.t)]
    for _ in range(rounds):
        order = rng.permutation(len(coded))
        for lo in range(0, len(order) - 1, 128):
            chains = []
            for i, j in zip(order[lo : lo + 128 : 2], order[lo + 1 : lo + 128 : 2], strict=False):
                cut = int(rng.integers(4, SPAN))
                chains.append((np.concatenate((coded[i][1][:cut], coded[j][1])), np.concatenate((np.full(len(coded[i][1][:cut]), coded[i][0]), np.full(len(coded[j][1]), coded[j][0])))))
            if not chains:
                continue
            m = max(len(x) for x, _ in chains)
            mask = np.array([np.arange(m) < len(x) for x, _ in chains])
            word = np.array([np.pad(x, (0, m - len(x))) for x, _ in chains])
            gold = np.array([np.pad(y, (0, m - len(y))) for _, y in chains])
            used, place = np.unique(word[mask], return_inverse=True)
            parts = np.concatenate([np.arange(first[i], first[i + 1]) for i in used])
            count = first[used + 1] - first[used]
            begin = np.cumsum(count) - count
            table = np.add.reduceat(model.w[bucket[parts]], begin, axis=0) + share[used] @ model.u
            score = np.zeros((*word.shape, c), np.float32)
            score[mask] = table[place]
            p, two, _ = model.marginals(score, mask, pairs=True)
            diff = p[mask].copy()
            diff[np.arange(len(diff)), gold[mask]] -= 1
            by_word = np.stack([np.bincount(place, diff[:, k], len(used)) for k in range(c)], 1)
            flat = np.repeat(by_word, count, axis=0)
            touched, where = np.unique(bucket[parts], return_inverse=True)
            dw = np.stack([np.bincount(where, flat[:, k], len(touched)) for k in range(c)], 1) / len(chains) + 1e-4 * model.w[touched]
            du = share[used].T @ by_word / len(chains) + 1e-4 * model.u
            real = mask[:, 1:]
            got = np.zeros((c, c))
            np.add.at(got, (gold[:, :-1][real], gold[:, 1:][real]), 1)
            dt = (two - got) / len(chains) + 1e-3 * model.t
            square[0][touched] += dw**2
            model.w[touched] -= (rate * dw / np.sqrt(square[0][touched])).astype(np.float32)
            square[1] += du**2
            model.u -= (rate * du / np.sqrt(square[1])).astype(np.float32)
            square[2] += dt**2
            model.t -= (0.1 * dt / np.sqrt(square[2])).astype(np.float32)
    return model


def sample(docs: DataFrame, most_docs: int, windows: int = WINDOWS, span: int = SPAN) -> list[tuple[str, list[str]]]:
    """Windows of words of at most ``most_docs`` training documents, evenly over the languages.

    Each language has the same number of rows at most, those of least hash of id and text, so reruns agree
    and null or repeated ids matter no more than others.  Only if there are more languages than
    ``most_docs`` are some without a row: those with fewest documents.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2))
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("draw"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_docs).collect()
    if not counts:
        return []
    each = max(1, most_docs // len(counts))
    # Of a language's hashes the least `each` are nearly sure to lie below this share of all hashes.
    room = [(r.lang, min(int((each + 5 * each**0.5 + 20) / r["count"] * 2**64), 2**64 - 1) - 2**63) for r in counts]
    rooms = spark.createDataFrame(room, "lang string, room long")  # most_docs rows at most
    thin = known.join(F.broadcast(rooms), "lang").filter(F.col("draw") <= F.col("room"))
    least = thin.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("draw", "text"))).filter(F.col("k") <= each)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [w for w in map(word_of, chunks(text)) if w]
                n = len(words)
                some = range(0, n, max(span, -(-n // windows)))
                rows += [(lang, words[i : i + span]) for i in some if words[i : i + span]]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["lang", "words"])

    return [(r.lang, list(r.words)) for r in least.select("lang", "text").mapInArrow(cut, "lang string, words array<string>").collect()]


def annotate(docs: DataFrame, most_docs: int = 3000, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two more columns, language and score; see :func:`identify`."""
    spark = docs.sparkSession
    told = spark.sparkContext.broadcast(train(sample(docs, most_docs)).state())
    text_at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = Crf(*told.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                piece = batch.slice(lo, SLICE)
                split = Split(piece.column(text_at))
                words = [word_of(c) for c in split.distinct]
                split.drop([i for i, w in enumerate(words) if not w])
                n = np.diff(split.ends)
                if model.labels:
                    distinct = sorted({w for w in words if w})
                    number = {w: i for i, w in enumerate(distinct)}
                    code = np.array([number.get(w, 0) for w in words], np.int64)
                    p = np.round(model.coded(distinct, code[split.index] if len(split.index) else np.zeros(0, np.int64), n), 6)
                    best = p.argmax(1)
                    lang = [model.labels[k] if m else "und" for k, m in zip(best.tolist(), n.tolist(), strict=True)]
                    score = np.where(n > 0, np.clip(p[np.arange(len(n)), best], 0, 1), 0.0)
                else:
                    lang, score = ["und"] * len(n), np.zeros(len(n))
                yield pa.record_batch([*piece.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=schema.names)
            release()

    return docs.mapInArrow(predict, schema)


def identify(docs: DataFrame, most_docs: int = 3000) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang).

    Learns from text and non-null ``lang`` of at most ``most_docs`` documents whose crc32(doc_id) mod 4 isn't
    2, see :func:`sample`; while training a language takes half a megabyte of the driver's memory.  ``und`` with
    score 0 for null texts, texts without a letter, and all texts if nothing could be learnt.  Ties go to
    the lesser language.  A null ``doc_id`` counts as the empty text; repeated rows are scored alike; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", "lang")
    got = annotate(rows, most_docs)
    return got.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score")


def spans(docs: DataFrame, most_docs: int = 3000) -> DataFrame:
    """(doc_id, first, last, language, score) of the runs of one language in each text of ``docs``.

    ``first`` and ``last`` count the words that have a letter, from 0; ``score`` is the run's mean marginal.
    Null texts and texts without a letter have no run; all else as in :func:`identify`.
    """
    told = docs.sparkSession.sparkContext.broadcast(train(sample(docs.select("doc_id", "text", "lang"), most_docs)).state())

    def label(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = Crf(*told.value)
        for batch in batches:
            out = []
            split = [[w for w in map(word_of, chunks(t)) if w] for t in batch.column(1).to_pylist()] if model.labels else []
            distinct = sorted(set().union(*split))
            number = {w: i for i, w in enumerate(distinct)}
            n = np.fromiter(map(len, split), np.int64, len(split))
            _, each = model.coded(distinct, np.array([number[w] for s in split for w in s], np.int64), n, words=True)
            best, owner = each.argmax(1), np.repeat(np.arange(len(n)), n)
            head = np.flatnonzero(np.append(True, (best[1:] != best[:-1]) | (owner[1:] != owner[:-1]))) if len(best) else np.zeros(0, np.int64)
            begin = np.cumsum(n) - n
            for a, b in zip(head.tolist(), [*head[1:].tolist(), len(best)], strict=True):
                out.append((int(owner[a]), a - int(begin[owner[a]]), b - 1 - int(begin[owner[a]]), model.labels[best[a]], float(np.round(each[a:b, best[a]].mean(), 6))))
            col = list(zip(*out, strict=True)) or [()] * 5
            yield pa.record_batch([batch.column(0).take(pa.array(col[0], pa.int64())), *(pa.array(c, t) for c, t in zip(col[1:], (pa.int64(), pa.int64(), pa.string(), pa.float64()), strict=True))], names=["doc_id", "first", "last", "language", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(label, T.StructType([docs.schema["doc_id"], T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("language", T.StringType()), T.StructField("score", T.DoubleType())]))


def keep_identified(docs: DataFrame, least: float = 0.35, most_docs: int = 3000) -> DataFrame:
    """The rows of ``docs`` with a predicted language whose score is at least ``least``, as they were.

    The bound is low so that text in two languages, or a short one with a foreign licence line, stays.
    Null texts and texts without a letter go; repeated rows are treated alike; columns of any name are
    carried along; an empty table, or one without a labelled row, gives an empty result.
    """
    language, share = fresh(docs, "language", "share")
    got = annotate(docs, most_docs, (language, share))
    return got.filter((F.col(language) != "und") & (F.col(share) >= least)).drop(language, share)

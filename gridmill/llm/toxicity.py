"""Toxicity by class-conditional Kneser-Ney models.

Two models of word pairs, one of toxic and one of ordinary documents, score a text by the difference of
their mean log-likelihoods.  Evidence is counted as Kneser and Ney do: not how often a word or a pair of
words occurs in its class but how many different words stand before it.  A pair backs off to its second
word, a word to the counts of the whole corpus, which both models share; so a rare expression has much the
same probability under either and moves no score.  The discount of each order and class comes from how many
words or pairs have one to four predecessors (modified Kneser-Ney, rounded up).  It grows with what the
shared counts of that word or pair lead to expect, so what is merely a little more usual in one class backs
off entirely; without that, pairs that near copies repeat cost nearly all recall on held-out documents.

What is bounded: the labelled sample (``most_labels`` documents), and with it everything that the models
keep.  The shared counts cover every word, and every pair with evidence, of every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import Split, chunks
from .shared import stash

EXCESS = 3.0  # times its expected count that a word or pair must exceed to be evidence
HELD = 500_000  # predecessors and words that a counting task holds before it sends them


def word_of(chunk: str) -> str:
    """A chunk in lower case without the marks around it; a chunk of marks alone is itself a word."""
    low = chunk.lower()
    lo, hi = 0, len(low)
    while lo < hi and not low[lo].isalnum():
        lo += 1
    while hi > lo and not low[hi - 1].isalnum():
        hi -= 1
    return low[lo:hi] or low


def fold(doc_id: Column, n: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def discount(n: list[int]) -> float:
    """The modified Kneser-Ney discount of counts from three on, rounded up; ``n``: items with 1 to 4."""
    y = n[0] / max(n[0] + 2 * n[1], 1)
    return float(min(max(np.ceil(3 - 4 * y * n[3] / max(n[2], 1)), 1), 3))


class Models:
    """Log-ratios of the two models; built from counts, small enough to be sent to every task.

    For class ``c``, ``f_c`` predecessors, corpus shares ``q`` and discounts ``D``:

    * a word has ``p_c(w) = (e_c(w) + L_c q(w)) / N_c``, where ``e_c(w) = f_c(w) - D - M N_c q(w)`` or 0,
      ``N_c`` is the sum of all ``f_c`` and ``L_c`` what is not evidence;
    * a word after ``v`` has ``p_c(w|v) = e_c(v, w) / N_c(v) + l_c(v) p_c(w)``, where ``e_c(v, w) =
      f_c(v, w) - D' - M max(N_c(v) p_c(w), N'_c q(v, w))`` or 0, ``N_c(v)`` and ``N'_c`` are sums over
      ``w`` and over all pairs, and ``l_c(v)`` is the share of ``N_c(v)`` that is not evidence.

    ``words``: (word, f_0, f_1, corpus count); ``pairs``: (v, w, f_0, f_1, corpus count), whose words are
    all in ``words``; ``heads``: (v, N_0(v), N_1(v)).  Other words have no evidence, other pairs back off.
    """

    def __init__(self, words: list[tuple], pairs: list[tuple], heads: list[tuple], totals: tuple, pair_totals: tuple, corpus: int, discounts: tuple, pair_discounts: tuple):
        self.id = {w[0]: i for i, w in enumerate(words)}
        self.id.setdefault("", len(self.id))  # what stands before the first word
        follows = np.array([w[1:3] for w in words], float).reshape(-1, 2)
        share = np.maximum(np.array([w[3] for w in words], float), 1) / max(corpus, 1)
        total = np.maximum(np.array(totals, float), 1)
        kept = np.maximum(follows - discounts - EXCESS * total * share[:, None], 0)
        left = total - kept.sum(0)
        p = (kept + left * share[:, None]) / total
        unseen = np.log(left[1] / total[1]) - np.log(left[0] / total[0])  # the shared share cancels
        self.word = np.append(np.log(p[:, 1]) - np.log(p[:, 0]), [unseen] * (len(self.id) + 1 - len(p)))
        n = len(self.word)
        mass = np.ones((n, 2))
        mass[[self.id[v] for v, *_ in heads]] = np.maximum(np.array([m for _, *m in heads], float).reshape(-1, 2), 1)
        v, w = (np.array([self.id[x[k]] for x in pairs], np.int64) for k in (0, 1))
        count, often = np.array([x[2:4] for x in pairs], float).reshape(-1, 2), np.array([x[4] for x in pairs], float)
        expected = np.maximum(mass[v] * p[w], np.array(pair_totals, float) * often[:, None] / max(corpus, 1))
        e = np.maximum(count - pair_discounts - EXCESS * expected, 0)
        some = e.any(1)
        v, w, e = v[some], w[some], e[some]
        taken = np.zeros((n, 2))
        np.add.at(taken, v, e)
        rest = (mass - taken) / mass
        self.head = np.log(rest[:, 1]) - np.log(rest[:, 0])
        both = e / mass[v] + rest[v] * p[w]
        order = np.argsort(v * n + w)
        self.pair, self.value = (v * n + w)[order], (np.log(both[:, 1]) - np.log(both[:, 0]))[order]
        self.heads = np.unique(v)

    def tokens(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The log-ratio of every word; ``ids``: words of texts laid end to end, ``first``: where texts begin."""
        n = len(self.word)
        before = np.concatenate((ids[:1], ids[:-1]))
        before[first[first < len(ids)]] = self.id[""]
        out = self.word[ids] + self.head[before]
        some = np.flatnonzero(np.isin(before, self.heads))
        if len(some):
            code = before[some] * n + ids[some]
            at = np.minimum(np.searchsorted(self.pair, code), len(self.pair) - 1)
            hit = self.pair[at] == code
            out[some[hit]] = self.value[at[hit]]
        return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float, float]:
    """Scale, slope and intercept of a slightly penalised one-variable logistic fit."""
    scale = float(np.std(x)) or 1.0
    z, w = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-3]), z.T @ (y - p) - np.array([1e-2, 1e-3]) * w)
        w = w + step
        if abs(step).max() < 1e-8:
            break
    return scale, float(w[0]), float(w[1])


def score(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Labels are learnt from rows whose crc32(doc_id) mod 5 isn't 0: of these, rests 1 to 3 train the models
    and rest 4 turns the difference into a score.  A document that is labelled more than once counts as
    toxic if any row says so; null labels are none.  Null and empty texts get the score of a difference of
    0.  A null ``doc_id`` counts as the empty text.  Without labels of both kinds every score is the share
    of toxic ones, 0 without labels.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"), F.first(fold(F.col("doc_id"))).alias("fold"))
    sample = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most_labels).collect()
    train = {r.doc_id: int(r.toxic > 0) for r in sample if r.fold != 4}
    adjust = {r.doc_id: int(r.toxic > 0) for r in sample if r.fold == 4}
    told = spark.sparkContext.broadcast((train, adjust))
    models = _models(rows, told)
    sent = spark.sparkContext.broadcast(vars(models))

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, adjust = told.value
        models = Models.__new__(Models)
        vars(models).update(sent.value)
        last = len(models.word) - 1
        for batch in batches:
            for lo in range(0, batch.num_rows, 1500):
                piece = batch.slice(lo, 1500)
                split = Split(piece.column(1))
                word = np.array([models.id.get(word_of(c), last) for c in split.distinct], np.int64)
                n, first = np.diff(split.ends), split.ends[:-1]
                each = models.tokens(word[split.index], first) if len(split.index) else np.zeros(0)
                sums = np.add.reduceat(np.append(each, 0.0), first) if len(n) else np.zeros(0)
                # Sums are rounded so that they don't depend on what else is in the batch.
                diff = np.where(n > 0, np.round(sums / np.maximum(n, 1), 9), 0.0)
                docs_ = piece.column(0)
                yield pa.record_batch([docs_, pa.array(diff), pa.array([adjust.get(d) for d in docs_.to_pylist()], pa.int32())], names=["doc_id", "diff", "toxic"])

    diffs = stash(rows.mapInArrow(compare, "doc_id long, diff double, toxic int"), "toxic-diffs")
    kinds = set(train.values())
    # One row for each labelled document, whatever rows share its id.
    fit = diffs.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.min("diff").alias("diff"), F.max("toxic").alias("toxic")).collect() if len(kinds) == 2 else []
    if len({r.toxic for r in fit}) == 2:
        pairs = sorted((r.diff, r.toxic) for r in fit)
        scale, slope, base = logistic(np.array([d for d, _ in pairs]), np.array([t for _, t in pairs], float))
        value = 1 / (1 + F.exp(-(F.col("diff") / scale * max(slope, 0.0) + base)))
    else:
        share = sum(train.values()) / len(train) if train else 0.0
        value = F.lit(float(share)) if len(kinds) < 2 else 1 / (1 + F.exp(-F.col("diff")))
    out = diffs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), value.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _evidence(rows: DataFrame, told) -> DataFrame:
    """(head, word, f0, f1, corpus): the predecessors of each pair in each class; head null: a word of the corpus.

    A task holds what it has seen and sends each pair once for many documents, with all words before it as
    one text; pairs stay where this one exchange put them, so no other carries predecessors.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        train, _ = told.value
        found: tuple[set, set] = (set(), set())
        total: Counter = Counter()

        def out():
            for kind in (0, 1):
                far: dict[str, list] = {}
                for u, v, w in found[kind]:
                    far.setdefault(f"{v} {w}", []).append(u)
                found[kind].clear()
                keys = sorted(far)
                yield keys, [" ".join(far[k]) for k in keys], kind, [1] * len(keys)
            keys = sorted(total)
            yield keys, [None] * len(keys), 2, [total[k] for k in keys]
            total.clear()

        def packed() -> Iterator:
            for keys, far, kind, n in out():
                for lo in range(0, len(keys), 50_000):
                    at = slice(lo, lo + 50_000)
                    yield pa.record_batch([pa.array(keys[at], pa.string()), pa.array(far[at], pa.string()), pa.array([kind] * len(keys[at]), pa.int32()), pa.array(n[at], pa.int64())], names=["key", "far", "kind", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 1500):
                piece = batch.slice(lo, 1500)
                split = Split(piece.column(1))
                for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    if doc in train:
                        words = ["", "", *map(word_of, chunks(text))]
                        found[train[doc]].update(zip(words, words[1:], words[2:]))  # noqa: B905
                for c, n in zip(split.distinct, split.counts().tolist(), strict=True):
                    if n:
                        total[word_of(c)] += n
                if len(found[0]) + len(found[1]) + len(total) > HELD:
                    yield from packed()
        yield from packed()

    # Words have no blanks, so a key with one is a pair; the key alone decides where all that counts it goes.
    sent = rows.mapInArrow(count, "key string, far string, kind int, n long").repartition("key")
    each = sent.select("key", "kind", "n", F.explode_outer(F.split("far", " ")).alias("far"))
    each = each.groupBy("key", "far", "kind").agg(F.sum("n").alias("n"))
    of = lambda k: F.count_if(F.col("kind") == k).alias(f"f{k}")
    got = each.groupBy("key").agg(of(0), of(1), F.coalesce(F.sum(F.when(F.col("kind") == 2, F.col("n"))), F.lit(0)).alias("corpus"))
    pair = F.instr("key", " ") > 0
    return got.select(F.when(pair, F.substring_index("key", " ", 1)).alias("head"), F.substring_index("key", " ", -1).alias("word"), "f0", "f1", "corpus")


def _models(rows: DataFrame, told) -> Models:
    """Count predecessors in the labelled sample and words and pairs in all of ``rows``; see :class:`Models`."""
    counts = stash(_evidence(rows, told), "toxic-counts")
    pairs = counts.filter("head IS NOT NULL").drop("corpus")
    follows = [F.count_if(F.col("head").isNotNull() & (F.col(f"f{c}") > 0)).alias(f"f{c}") for c in (0, 1)]
    words = stash(counts.groupBy("word").agg(*follows, F.sum("corpus").alias("corpus")), "toxic-words")

    def sums(df: DataFrame):
        parts = [F.coalesce(F.sum(f"f{c}"), F.lit(0)).alias(f"t{c}") for c in (0, 1)]
        return df.agg(*parts, *[F.count_if(F.col(f"f{c}") == k).alias(f"n{c}{k}") for c in (0, 1) for k in (1, 2, 3, 4)], F.coalesce(F.sum("corpus") if "corpus" in df.columns else F.lit(0), F.lit(0)).alias("corpus")).first()

    one, two = sums(words), sums(pairs)
    discounts, pair_discounts = (tuple(discount([x[f"n{c}{k}"] for k in (1, 2, 3, 4)]) for c in (0, 1)) for x in (one, two))
    share = F.greatest("corpus", F.lit(1)) / max(one.corpus, 1)
    has = lambda c: F.col(f"f{c}") - discounts[c] - EXCESS * max(one[f"t{c}"], 1) * share > 0
    chosen = stash(pairs.filter(" OR ".join(f"f{c} > {pair_discounts[c]}" for c in (0, 1))), "toxic-pairs-chosen")
    asked = chosen.select(F.explode(F.array("head", "word")).alias("word")).distinct()
    kept = words.filter(has(0) | has(1)).unionByName(words.join(asked, "word", "left_semi")).distinct()
    kept = [tuple(r) for r in kept.select("word", "f0", "f1", "corpus").orderBy("word").collect() if r.word]
    heads = [tuple(r) for r in pairs.join(chosen.select("head").distinct(), "head", "left_semi").groupBy("head").agg(F.sum("f0"), F.sum("f1")).collect()]
    some = sorted(map(tuple, chosen.select("head", "word", "f0", "f1").collect()))
    often = _corpus_pairs(rows, [w[0] for w in kept], [p[:2] for p in some]) if some else {}
    return Models(kept, [(*p, often.get(k, 0)) for k, p in enumerate(some)], heads, (one.t0, one.t1), (two.t0, two.t1), one.corpus, discounts, pair_discounts)


def _corpus_pairs(rows: DataFrame, words: list[str], pairs: list[tuple[str, str]]) -> dict[int, int]:
    """How often each of ``pairs`` stands in all texts, by its number."""
    id_ = {w: i for i, w in enumerate(["", *words])}
    n = len(id_) + 1
    code = np.array([id_[v] * n + id_[w] for v, w in pairs], np.int64)
    order = np.argsort(code)
    sent = rows.sparkSession.sparkContext.broadcast((id_, code[order], order))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        id_, code, order = sent.value
        last, total = len(id_), np.zeros(len(code), np.int64)
        heads = np.unique(code // n)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                split = Split(batch.column(0).slice(lo, 2000))
                if not len(split.index):
                    continue
                ids = np.array([id_.get(word_of(c), last) for c in split.distinct], np.int64)[split.index]
                before = np.concatenate((ids[:1], ids[:-1]))
                first = split.ends[:-1]
                before[first[first < len(ids)]] = 0
                some = np.flatnonzero(np.isin(before, heads) & (ids != last))
                own = before[some] * n + ids[some]
                at = np.minimum(np.searchsorted(code, own), len(code) - 1)
                total += np.bincount(at[code[at] == own], minlength=len(code))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(order[at]), pa.array(total[at])], names=["pair", "n"])

    got = rows.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r.pair: r.n for r in got.collect()}

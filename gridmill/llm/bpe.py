"""Exact encoding and decoding with a word-end BPE vocabulary.

Frequent words come out of a memory-mapped transducer (:mod:`.automaton`); all others are merged exactly,
many words at a time in numpy.  Neither caps anything: a word that the lexicon lacks is only slower.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Lexicon, build
from .chunks import Split, chunks, core, release, worker_state
from .shared import most_frequent, put_file, stash

LONG = 128  # bytes from which a word is merged on a heap


def is_plain(word: str) -> bool:
    """Whether a word is one pre-token that normalising leaves as it is."""
    return word.isalpha() and word.islower() and max(word) < "\u0130"


@lru_cache(2)
def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A tokenizers JSON file of the word-end kind: NFC, white space, lower case, then byte-level BPE."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.text = [""] * self.size
        for word, i in [*self.vocab.items(), *self.special.items()]:
            self.text[i] = word
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.last = np.array([self.vocab[c + self.end] for c in letters], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        key = left * self.size + right
        self.pair, self.made = np.append(key, -1), made  # by rank
        self.none = len(merges)
        self.tables = self._tables(key)
        self.by_pair = dict(zip(key.tolist(), range(len(merges)), strict=True))

    def _slot(self, key: np.ndarray, level: int) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * level) >> np.uint64(46)).astype(np.int64)

    def _tables(self, key: np.ndarray) -> list[np.ndarray]:
        """Hash tables from pair to rank; what collides in one is in the next, an empty slot ends a search."""
        tables, left = [], np.arange(len(key))
        while len(left):
            table = np.full(1 << 18, self.none, np.int32)
            slot = self._slot(key[left], len(tables))
            table[slot] = left
            tables.append(table)
            left = left[table[slot] != left]
        return tables

    # -- words

    def words(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk without white space; special tokens stay whole."""
        if self.cut is not None and "<" in chunk:
            out = []
            for part in self.cut.split(chunk):
                out += [part] if part in self.special else self._plain(part)
            return out
        return self._plain(chunk)

    def _plain(self, part: str) -> list[str]:
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
            # Each character by itself: no rule for a final sigma.
            part = "".join([c.lower() for c in part]) if "Σ" in part else part.lower()
        else:
            part = part.lower()
        return self.pieces.findall(part)

    # -- merging

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``none`` for pairs that don't merge and where an id is negative."""
        key = a.astype(np.int64) * self.size + b
        key[(a < 0) | (b < 0)] = -2
        out = self.tables[0][self._slot(key, 0)] if self.tables else np.full(len(key), self.none, np.int32)
        wrong = np.flatnonzero((self.pair[out] != key) & (out != self.none))
        for level in range(1, len(self.tables)):
            if not len(wrong):
                break
            got = self.tables[level][self._slot(key[wrong], level)]
            out[wrong] = got
            wrong = wrong[(self.pair[got] != key[wrong]) & (got != self.none)]
        out[wrong] = self.none
        return out

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words by repeated merging of the leftmost pair of least rank."""
        out: list[list[int]] = [[]] * len(words)
        short = sorted((i for i, w in enumerate(words) if 0 < len(w) <= LONG), key=lambda i: len(words[i]))
        for lo in range(0, len(short), 8192):
            part = short[lo : lo + 8192]
            for i, ids in zip(part, self._merge_block([words[i] for i in part]), strict=True):
                out[i] = ids
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._merge_long(w)
        return out

    def _merge_block(self, words: list[bytes]) -> list[list[int]]:
        n, m = len(words), max(map(len, words))
        length = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(n, m)
        col = np.arange(m)
        token = np.where(col < length[:, None], self.inner[raw], -1)
        token[np.arange(n), length - 1] = self.last[raw[np.arange(n), length - 1]]
        token = np.concatenate((token, np.full((n, 1), -1)), axis=1).astype(np.int32)
        rank = np.full((n, m + 1), self.none, np.int32)
        rank[:, :m] = self._ranks(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(n, m)
        row, col = np.arange(n), np.arange(m)  # rows still at work
        done: list[list[int] | None] = [None] * n
        while len(row):
            best = rank.argmin(axis=1)
            r = np.arange(len(row))
            least = rank[r, best]
            stop = least == self.none
            if stop.any():
                for i, ids in zip(row[stop].tolist(), token[stop].tolist(), strict=True):
                    done[i] = [t for t in ids if t >= 0]
                keep = ~stop
                row, token, rank, best, least = row[keep], token[keep], rank[keep], best[keep], least[keep]
                r = np.arange(len(row))
                if not len(row):
                    break
            token[r, best] = self.made[least]
            # Close the gap behind the merged pair.
            behind = col > best[:, None]
            np.copyto(token[:, :-1], token[:, 1:].copy(), where=behind)
            np.copyto(rank[:, :-1], rank[:, 1:].copy(), where=behind)
            own = token[r, best]
            rank[r, best] = self._ranks(own, token[r, np.minimum(best + 1, m)])
            before = np.flatnonzero(best > 0)
            rank[before, best[before] - 1] = self._ranks(token[before, best[before] - 1], own[before])
        return done  # type: ignore[return-value]

    def _merge_long(self, word: bytes) -> list[int]:
        token = self.inner[np.frombuffer(word, np.uint8)].tolist()
        token[-1] = int(self.last[word[-1]])
        n, size, ranks = len(token), self.size, self.by_pair
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[k], i, token[i], token[i + 1]) for i in range(n - 1) if (k := token[i] * size + token[i + 1]) in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= n or token[j] != b:
                continue
            token[i], token[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < n and (k := token[p] * size + token[q]) in ranks:
                    heapq.heappush(heap, (ranks[k], p, token[p], token[q]))
        return [t for t in token if t >= 0]

    # -- whole texts

    def encode_words(self, words: list[str], lexicon: Lexicon | None = None) -> list[list[int]]:
        """Ids of pre-tokens: special tokens, then the lexicon, then exact merging."""
        out: list = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            if w in self.special:
                out[i] = [self.special[w]]
            else:
                rest.append(i)
        data = [words[i].encode() for i in rest]
        if lexicon is not None:
            numbers = lexicon.numbers(data).tolist()
            starts, pool = lexicon.starts, lexicon.pool
            at = np.array([k for k in numbers if k >= 0], np.int64)
            lo, hi = starts[at].tolist(), starts[at + 1].tolist()
            known = iter(zip(lo, hi, strict=True))
            ids = pool.tolist() if len(at) * 4 > len(pool) else pool
            unseen = []
            for i, k, w in zip(rest, numbers, data, strict=True):
                if k >= 0:
                    a, b = next(known)
                    run = ids[a:b]
                    out[i] = run if isinstance(run, list) else run.tolist()
                else:
                    unseen.append((i, w))
        else:
            unseen = list(zip(rest, data, strict=True))
        for (i, _), ids in zip(unseen, self.merge([w for _, w in unseen]), strict=True):
            out[i] = ids
        return out

    def encode_chunks(self, parts: list[str], lexicon: Lexicon | None = None) -> list[list[int]]:
        """Ids of distinct chunks; each distinct word among them is encoded once."""
        split = [self.words(c) for c in parts]
        words = list(set().union(*split)) if split else []
        known = dict(zip(words, self.encode_words(words, lexicon), strict=True))
        return [known[s[0]] if len(s) == 1 else [i for w in s for i in known[w]] for s in split]

    def encode(self, text: str | None, lexicon: Lexicon | None = None) -> list[int]:
        return [i for ids in self.encode_chunks(chunks(text), lexicon) for i in ids]

    def decode(self, ids) -> str:
        """The token strings joined by blanks, as the library does for a file without a decoder."""
        return " ".join([self.text[i] for i in ids])


def compile_lexicon(docs: DataFrame, tokenizer: str, most: int = 50_000) -> bytes:
    """Count the words of all texts and compile at most the ``most`` frequent ones.

    Batches are counted before the shuffle.  ``most`` bounds the file, which
    goes to every executor, and the rows that reach the driver.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe, seen = worker_state("bpe", lambda: WordBpe(tokenizer), tokenizer), Counter()

        def out():
            total: Counter = Counter()
            for chunk, n in seen.items():
                if not n:
                    continue
                word, mark = (chunk, "") if is_plain(chunk) else core(chunk)
                for w in (word,) if is_plain(word) else bpe.words(word):
                    total[w] += n
                if mark:
                    total[mark] += n
            seen.clear()
            return pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 4000):
                # A slice holds each of its chunks once, whatever its size.
                split = Split(batch.column(0).slice(lo, 4000))
                for c, n in zip(split.distinct, split.counts().tolist(), strict=True):
                    seen[c] += n
                del split
                if len(seen) > 150_000:
                    yield out()
                release()
        yield out()
        release()

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
    total = stash(counted.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1"), "words")
    top = most_frequent(total, "n", most, "word")
    bpe = WordBpe(tokenizer)
    words = [r.word for r in top.select("word").collect() if r.word not in bpe.special]
    return build(dict(zip(words, bpe.encode_words(words), strict=True)))


class ChunkMemo:
    """Written ids and decoded text of chunks, kept for a task (a worker goes on to other work afterwards).

    A chunk seen for the first time is encoded by the lexicon and by merging.  Beyond ``most`` chunks only
    those of the last texts stay, so frequent ones do and memory is bounded.
    """

    def __init__(self, bpe: WordBpe, lexicon: Lexicon, most: int):
        self.bpe, self.lexicon, self.most = bpe, lexicon, most
        self.number: dict[str, str] = {}
        self.back: dict[str, str] = {}
        self.digits = [str(i) for i in range(bpe.size)]
        pool, starts = lexicon.pool.tolist(), lexicon.starts.tolist()
        runs = [pool[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        self.listed = (self._write(runs), list(map(bpe.decode, runs)))

    def _write(self, runs: list[list[int]]) -> list[str]:
        digits = self.digits
        return [" ".join([digits[i] for i in run]) for run in runs]

    def learn(self, own: list[str]) -> tuple[dict, dict]:
        """Written ids and text of (at least) all chunks of ``own``."""
        gc.disable()  # the collector would walk the memo again and again
        try:
            if len(self.number) > self.most:
                keep = [c for c in own if c in self.number]
                self.number = {c: self.number[c] for c in keep}
                self.back = {c: self.back[c] for c in keep}
            number, back = self.number, self.back
            simple, parts = [], []
            for c in own:
                if c in number:
                    continue
                if c and is_plain(c):
                    simple.append(c)
                elif c:
                    parts.append((c, *core(c)))
            plain, rest = set(simple), set()
            for _, w, m in parts:
                (plain if is_plain(w) else rest).add(w)
                if m:
                    rest.add(m)
            words = list(plain)
            places = self.lexicon.numbers([w.encode() for w in words]).tolist()
            ids, text = self.listed
            told = {w: ids[k] for w, k in zip(words, places, strict=True) if k >= 0}
            read = {w: text[k] for w, k in zip(words, places, strict=True) if k >= 0}
            unseen = [w for w, k in zip(words, places, strict=True) if k < 0]
            more = list(rest)
            runs = self.bpe.merge([w.encode() for w in unseen]) + self.bpe.encode_chunks(more, self.lexicon)
            told.update(zip(unseen + more, self._write(runs), strict=True))
            read.update(zip(unseen + more, map(self.bpe.decode, runs), strict=True))
            number.update(zip(simple, map(told.__getitem__, simple), strict=True))
            back.update(zip(simple, map(read.__getitem__, simple), strict=True))
            number.update([(c, f"{told[w]} {told[m]}" if m else told[w]) for c, w, m in parts])
            back.update([(c, f"{read[w]} {read[m]}" if m else read[w]) for c, w, m in parts])
            number[""] = back[""] = ""
            return number, back
        finally:
            gc.enable()


def encode_documents(docs: DataFrame, tokenizer: str, most: int = 50_000, texts: bool = False, slice_docs: int = 1500, memo_chunks: int = 250_000) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids and decode to the empty text.  Rows are independent: repeated rows,
    null ids and other columns change nothing, and an empty table gives an empty result.  With ``texts``
    the ids themselves (``ids``, array of int) and ``decoded`` follow.  ``slice_docs`` documents are split at
    a time and ``memo_chunks`` chunks remembered: less of either is slower and takes less memory.
    """
    spark = docs.sparkSession
    import hashlib

    data = compile_lexicon(docs, tokenizer, most)
    name = put_file(spark, data, "lexicon")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if texts else "")

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import SparkFiles

        bpe = worker_state("bpe", lambda: WordBpe(tokenizer), tokenizer)
        memo = ChunkMemo(bpe, Lexicon(SparkFiles.get(name)), memo_chunks)
        for batch in batches:
            for lo in range(0, batch.num_rows, slice_docs):
                piece = batch.slice(lo, slice_docs)
                split = Split(piece.column(1))
                number, back = memo.learn(split.distinct)
                told, read = [number[c] for c in split.distinct], [back[c] for c in split.distinct]
                # A chunk may have no ids (none of its characters is a word or a symbol): no blank for it.
                gaps = [i for i, t in enumerate(told) if not t]
                if gaps:
                    split.drop(gaps)
                n = split.sums([t.count(" ") + 1 for t in told])
                written, decoded = split.join(told, " "), split.join(read, " ")
                sums = [pa.array([hashlib.sha256(x).hexdigest() for x in y.cast(pa.large_binary()).to_pylist()], pa.string()) for y in (written, decoded)]
                cols = [piece.column(0), pa.array(n), *sums]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if texts:
                    flat = np.fromstring(" ".join(t for t in written.to_pylist() if t), np.int32, sep=" ")
                    ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(n, dtype=np.int32)))
                    cols += [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), decoded.cast(pa.string())]
                    names += ["ids", "decoded"]
                yield pa.record_batch(cols, names=names)
                del split, told, read, written, decoded, cols
            release()
        del memo
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(encode, schema)

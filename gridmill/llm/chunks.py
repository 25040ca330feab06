"""Splitting text into white-space separated chunks, exactly as the tokenizer's ``\\s+`` does.

No rule of the word-end vocabularies looks across white space, so a text's ids are the ids of its
chunks, one after the other, and each distinct chunk of a batch is encoded once.
"""

from __future__ import annotations

import re

# str.split() also splits at these four; the tokenizer's \s doesn't.
_CONTROL = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def chunks(text: str | None) -> list[str]:
    if not text:
        return []
    if _CONTROL.search(text):
        return [x for x in _SPACE.split(text) if x]
    return text.split()


class Split:
    """The chunks of many texts: distinct ones, and for each text the numbers of its own in order.

    Arrow splits and numbers them, so a chunk that stands a thousand times is one object.
    """

    def __init__(self, texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.string()), "")
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            parts = [chunks(t) for t in texts.to_pylist()]
            flat = pa.array([c for p in parts for c in p], pa.string())
            self.ends = np.cumsum([0, *map(len, parts)])
        else:
            # Like str.split() but for an empty chunk beside white space at either end.
            lists = pc.utf8_split_whitespace(texts)
            flat = lists.flatten()
            self.ends = lists.offsets.to_numpy().astype(np.int64) - (lists.offsets[0].as_py() if len(lists) else 0)
        coded = pc.dictionary_encode(flat)
        self.distinct: list[str] = coded.dictionary.to_pylist()
        self.index = coded.indices.to_numpy()
        if "" in self.distinct:
            self.drop({self.distinct.index("")})

    def drop(self, numbers) -> None:
        """Take the chunks of these numbers out of every text."""
        import numpy as np

        keep = ~np.isin(self.index, list(numbers))
        self.ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(keep)))[self.ends]
        self.index = self.index[keep]

    def counts(self):
        import numpy as np

        return np.bincount(self.index, minlength=len(self.distinct))

    def join(self, values: list, between):
        """Each text's values (one for each distinct chunk, text or bytes) in order, as an Arrow array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = pa.large_binary() if isinstance(between, bytes) else pa.large_string()
        every = pc.take(pa.array(values, kind), pa.array(self.index))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(self.ends), every), pa.scalar(between, kind))

    def sums(self, values):
        """Each text's sum of a number for each distinct chunk."""
        import numpy as np

        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.asarray(values, np.int64)[self.index])))
        return total[self.ends[1:]] - total[self.ends[:-1]]


def core(chunk: str) -> tuple[str, str]:
    """(word, mark): a chunk whose ids are those of ``word`` and then those of ``mark``.

    A last full stop or comma is a symbol of its own after a letter or number, and below U+0130 lower case
    is taken character by character; so many chunks share a word.  All others stay as they are.
    """
    if "<" in chunk or max(chunk) >= "\u0130":
        return chunk, ""
    if chunk[-1] in ".," and len(chunk) > 1 and chunk[-2].isalnum():
        return chunk[:-1].lower(), chunk[-1]
    return chunk.lower(), ""


def worker_state(key: str, make, version: str = ""):
    """An object kept for all tasks of a Python worker, made anew for another version."""
    import sys
    import types

    held = vars(sys.modules.setdefault("gridmill_worker_state", types.ModuleType("gridmill_worker_state")))
    if held.get(key, (None,))[0] != version:
        held[key] = (version, make())
    return held[key][1]


def release() -> None:
    """Give freed memory back to the system: a worker goes on to other stages, whose memory counts too."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, one call for many distinct unseen words.

    The memo keeps chunks and words; beyond ``most`` of either only those of the last texts stay, so
    frequent ones do and memory is bounded.
    """

    def __init__(self, path: str, most: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        size = t.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u4" if size > 1 << 16 else "<u2"
        # The same model for words that normalising leaves as they are and that are one pre-token each.
        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(t.model, "end_of_word_suffix", None)
        # Ids that end a word: each of several words joined by blanks has one, its last.
        self.last = np.array([bool(suffix) and (t.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.chunk: dict[str, bytes] = {}
        self.word: dict[str, bytes] = {}
        self.most = most

    def _library(self, words: list[str]) -> None:
        """Packed ids of distinct words into the memo."""
        import numpy as np

        joined, rest = [], []
        for w in words:
            (joined if w.isalpha() and w.islower() and max(w) < "\u0130" else rest).append(w)
        if not self.last.any():
            joined, rest = [], words
        for at in range(0, len(joined), 1000):
            part = joined[at : at + 1000]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * ids.itemsize).tolist()
            data = ids.tobytes()
            self.word.update(zip(part, [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.word[w] = np.array(e.ids, self.dtype).tobytes()

    def encode(self, texts) -> list[bytes]:
        """Packed little-endian ids of each text of an Arrow array."""
        import gc

        split = Split(texts)
        chunk, word = self.chunk, self.word
        gc.disable()  # the collector would walk the memo again and again
        try:
            simple, parts = [], []
            for c in split.distinct:
                if c not in chunk:
                    if c.isalpha() and c.islower():
                        simple.append(c)
                    elif c:
                        parts.append((c, *core(c)))
            need = {w for _, w, _ in parts}.union(simple)
            need.update({m for _, _, m in parts if m})
            self._library(list(need.difference(word)))
            chunk.update(zip(simple, map(word.__getitem__, simple), strict=True))
            chunk.update([(c, word[w] + word[m] if m else word[w]) for c, w, m in parts])
            chunk[""] = b""
            out = split.join(list(map(chunk.__getitem__, split.distinct)), b"").to_pylist()
            if len(chunk) > self.most:
                self.chunk = {c: chunk[c] for c in split.distinct}
            if len(word) > self.most:
                self.word = {w: word[w] for w in need}
        finally:
            gc.enable()
        return out

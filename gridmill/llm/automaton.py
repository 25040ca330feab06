"""Minimal acyclic transducer from words to token ids, in one flat file that is memory-mapped.

Words are added in byte order; a state whose right side can't grow any more is replaced by an equal state
if there is one, so suffixes are shared and the automaton is minimal at all times.  Arcs carry integer
outputs that add up to a word's number along its path, and the number points to the word's run of ids.
"""

from __future__ import annotations

import numpy as np


def build(entries: dict[str, list[int]]) -> bytes:
    """Compile words (not empty) with their ids to the file format read by :class:`Lexicon`."""
    words = sorted((w.encode(), ids) for w, ids in entries.items() if w)
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path = [0]  # states along the last word
    previous = b""

    def freeze(down_to: int) -> None:
        for i in range(len(path) - 1, down_to, -1):
            state = path.pop()
            same = register.setdefault((final[state], tuple(arcs[state].items())), state)
            if same != state:
                arcs[path[-1]][previous[i - 1]] = same

    for word, _ in words:
        n = 0
        for a, b in zip(word, previous):  # noqa: B905
            if a != b:
                break
            n += 1
        freeze(n)
        for b in word[n:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][b] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        previous = word
    freeze(0)

    # Number the states that are left, and count the words behind each, last states first.
    order, seen = [], {0: 0}
    stack = [0]
    while stack:
        state = stack.pop()
        order.append(state)
        for t in arcs[state].values():
            if t not in seen:
                seen[t] = len(seen)
                stack.append(t)
    behind: dict[int, int] = {}

    def count(root: int) -> None:
        todo = [(root, False)]
        while todo:
            state, ready = todo.pop()
            if state in behind:
                continue
            if ready:
                behind[state] = final[state] + sum(behind[t] for t in arcs[state].values())
            else:
                todo.append((state, True))
                todo.extend((t, False) for t in arcs[state].values() if t not in behind)

    count(0)
    rows = []
    for state in order:
        out = int(final[state])
        for b, t in sorted(arcs[state].items()):
            rows.append((seen[state] << 8 | b, seen[t], out))
            out += behind[t]
    rows.sort()
    keys, targets, outs = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    ends = np.zeros(len(seen), np.int64)
    for state, k in seen.items():
        ends[k] = final[state]
    runs = [np.asarray(ids, np.int64) for _, ids in words]
    starts = np.concatenate(([0], np.cumsum([len(r) for r in runs], dtype=np.int64)))
    pool = np.concatenate(runs) if runs else np.zeros(0, np.int64)
    parts = [keys, targets, outs, ends, starts.astype(np.int64), pool]
    head = np.array([len(p) for p in parts], np.int64)
    return b"".join(p.astype("<i8").tobytes() for p in [head, *parts])


class Lexicon:
    """Look-ups in a compiled automaton; ``source`` is a path, which is mapped, or bytes."""

    def __init__(self, source):
        data = np.memmap(source, "<i8", "r") if isinstance(source, str) else np.frombuffer(source, "<i8")
        at, parts = 6, []
        for n in data[:6].tolist():
            parts.append(data[at : at + n])
            at += n
        self.keys, self.targets, self.outs, self.ends, self.starts, self.pool = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 where the lexicon lacks it; all words step through together."""
        n = len(words)
        found = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return found
        length = np.fromiter(map(len, words), np.int64, n)
        order = np.argsort(-length, kind="stable")
        flat = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        length = length[order]
        first = np.concatenate(([0], np.cumsum(length)[:-1]))
        state, out, alive = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
        step = 0
        while True:
            live = np.flatnonzero(alive[: np.searchsorted(-length, -step)])  # words longer than step
            if not len(live):
                break
            key = state[live] << 8 | flat[first[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive[live[~hit]] = False
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            out[live] += self.outs[at]
            step += 1
        # A final state's own word comes before those behind it: its number is the sum of the outputs.
        good = alive & (self.ends[state] == 1) & (length > 0)
        found[order[good]] = out[good]
        return found

    def ids(self, number: int) -> np.ndarray:
        return self.pool[self.starts[number] : self.starts[number + 1]]

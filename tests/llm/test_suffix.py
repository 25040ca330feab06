import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gridmill.llm import suffix_dedup as sd


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        n = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), n, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("data", [b"", b"a", b"banana", b"\0\0\0\0", b"abcabcabcabc" * 20, bytes(random.Random(1).choices(b"ab", k=700)), bytes(random.Random(2).choices(b"a\0", k=300))])
def test_suffix_array_and_prefixes(data):
    a = np.frombuffer(data, np.uint8)
    sa = sd.suffix_array(a)
    assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    got = sd.common_prefixes(a, sa).tolist()
    for k in range(1, len(data)):
        x, y = data[sa[k - 1] :], data[sa[k] :]
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        assert got[k] == n


def corpus(rng):
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    common = [text(60) for _ in range(4)]
    texts = [text(rng.randint(1, 150)) for _ in range(40)]
    texts += [text(rng.randint(0, 30)) + rng.choice(common)[rng.randint(0, 60) :] + text(rng.randint(0, 30)) for _ in range(60)]
    texts += [texts[3], texts[3], texts[5] + "x", "a" * 700, "ab" * 150 + "z", "", None, common[0] * 3]
    return texts


@pytest.mark.parametrize("hot", [4096, 4])
def test_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "SLICE", 1 << 9 if hot == 4 else 1 << 22)
    monkeypatch.setattr(sd, "SHARD", 1 << 12)
    monkeypatch.setattr(sd, "MOST", 1000 if hot == 4 else 10)
    texts = corpus(random.Random(hot))
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, low string")
    got = {r.doc_id or 0: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup(df).collect()}
    want = brute([(t or "").encode() for t in texts], 200)
    assert [got[i] for i in range(len(texts))] == want


def test_empty_table(spark):
    assert sd.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []

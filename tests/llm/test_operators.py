"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; brute force where short."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridmill.llm import arrow_output, bpe, jaccard, language, line_dedup, media, mixing, topk, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank string, size string, score string, low string, rep string, grp string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", "y", "z", "a", "b", "c") for i, t, lang, source in rows], DOCS)


EN = "the cat and the dog walk over that bridge with their old friend and talk about this weather"
DE = "der hund und die katze gehen über die brücke mit einem alten freund und reden über das wetter"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{EN if i % 2 else DE} {i}", "en" if i % 2 else "de", f"s{i % 3}") for i in range(40)]
    rows += [(100, None, "en", "s0"), (101, "", None, None), (102, " \n\t", "en", "s1"), (103, "12 34 !!", "de", None), (None, EN, "en", "s1"), (104, (EN + "\n") * 3000, "en", "s2"), (105, "x" * 50_000, "en", "s2")]
    rows += [(1, f"{EN} 1", "en", "s1"), (1, "another text under a known id", "en", "s1")]
    return table(spark, rows).cache()


def same(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(
    "op",
    [
        lambda d: bpe.encode_documents(d, PATH), language.identify, line_dedup.report, mixing.mix, media.media_columns, jaccard.join_documents,
        lambda d: arrow_output.read_tokens(arrow_output.write_tokens(d, PATH)), lambda d: toxicity.score(d, d.select("doc_id", F.lit(1).alias("toxic"))),
    ],
)
def test_every_row_comes_back_and_empty_tables_work(spark, docs, op):
    got = op(docs)
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted((r.doc_id for r in docs.collect()), key=str)
    assert op(docs.limit(0)).collect() == []


def test_bpe_and_arrow_equal_the_library(docs):
    t = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    enc = [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in rows]
    got = bpe.encode_documents(docs, PATH, most=20, texts=True)
    want = sorted(((i, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(t.decode(e, skip_special_tokens=False).encode()).hexdigest(), e) for i, e in enc), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got.collect()), key=str) == want
    read = sorted(arrow_output.read_tokens(arrow_output.write_tokens(docs, PATH, length=16, rows=4, most_ids=500)).collect(), key=lambda r: r.start)
    at = 0
    for r, (i, e) in zip(read, enc, strict=True):
        e = [*e, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(e), zlib.crc32(np.array(e, "<u4").tobytes()))
        at += len(e)


def test_sequences_and_masks_are_views(tmp_path):
    with open(tmp_path / "a", "wb") as f:
        w = arrow_output.SequenceWriter(f, "<u2", 16, 4)
        assert [w.add(np.arange(n, dtype="<u2")) for n in (5, 0, 100, 7)] == [0, 5, 5, 105]
        w.close()
    r = arrow_output.SequenceReader(f"file://{tmp_path}/a")
    assert r.ids(5, 100).tolist() == list(range(100)) and r.ids(105, 7).tolist() == list(range(7)) and r.ids(5, 0).tolist() == []
    far = arrow_output.SequenceReader(f"file://{tmp_path}/a")
    far.batches = None  # as on a file system that isn't local: one batch at a time, forward or anew
    assert far.ids(5, 100).tolist() == list(range(100)) and far.ids(0, 5).tolist() == list(range(5)) and far.sequence(7)[0].tolist() == r.sequence(7)[0].tolist()
    ids, mask = r.sequence(1)
    assert ids.base is not None and ids.tolist() == list(range(11, 27)) and np.unpackbits(mask).all()
    assert np.unpackbits(r.sequence(7)[1]).sum() == 0


def test_media_payloads(docs):
    got = media.media_columns(docs).collect()
    want = Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        p = raw + b"\0" * (max(1, -(-len(raw) // 64)) * 64 - len(raw))
        want[(r.doc_id, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    by, place = {}, {}
    for r in got:
        assert by.setdefault(r.payload_sha256, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)
        assert place.setdefault(r.digest, (r.shard, r.offset, r.length)) == (r.shard, r.offset, r.length) and r.digest == r.payload_sha256
    heads = media.read_metadata(media.places(media.store(docs))).collect()
    assert {(h.digest, h.payload_bytes) for h in heads} == {(r.payload_sha256, r.payload_bytes) for r in got} and all(h.media_name == h.digest for h in heads)


def test_mix_targets_and_repeats(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{0 if i % 3 else i % 5}") for i in range(900)] + [(5000, None, "en", None)]
    got = mixing.mix(table(spark, rows)).collect()
    by = {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        t = by.setdefault(source[r.doc_id], [r.target, r.source_size, 0])
        t[2] += r.taken
    assert abs(sum(t for t, _, _ in by.values()) - sum(s for _, s, _ in by.values())) < 1e-6
    assert all(abs(n - t) <= 4 and t <= 3 * s for t, s, n in by.values())
    taken = mixing.take(table(spark, rows))
    assert Counter(r.doc_id for r in taken.collect()) == Counter({r.doc_id: r.taken // r.size for r in got if r.taken})
    assert taken.columns == table(spark, rows).columns


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1000], [1000, 1, 1], [0, 5, 5, 100], [7], [1, 1, 1, 1000, 3, 9]])
def test_targets_equal_resharing(spark, sizes):
    w = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    total, capped, target = sum(sizes), set(), {}
    while True:
        rest = total - sum(3 * sizes[i] for i in capped)
        free = [i for i in range(len(sizes)) if i not in capped]
        target = {i: 3 * sizes[i] for i in capped} | {i: rest * w[i] / sum(w[k] for k in free) for i in free}
        over = {i for i in free if target[i] > 3 * sizes[i] + 1e-9}
        if not over:
            break
        capped |= over
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert all(abs(got[f"s{i}"] - t) < 1e-6 for i, t in target.items())


def brute_lines(docs, width, long_words):
    """First places by (doc_id, line) of windows of lines; lines of later ones go."""
    seen, gone = {}, {}
    for i, text in docs:
        lines = [(k, x) for k, x in enumerate((text or "").split("\n")) if x.strip(" \t\r\n\x0b\x0c")]
        for s in range(len(lines)):
            size = next((m for m in range(1, width + 1) if s + m <= len(lines) and (m == width or sum(len(x.split()) for _, x in lines[s : s + m]) >= long_words)), None)
            if size is None:
                continue
            win = tuple(x for _, x in lines[s : s + size])
            if win in seen:
                gone.setdefault(i, set()).update(k for k, _ in lines[s : s + size])
            else:
                seen[win] = (i, s)
    return {i: len(g) for i, g in gone.items()}


@pytest.mark.parametrize(("width", "long_words"), [(3, 12), (2, 50), (4, 9)])
def test_line_dedup_equals_brute_force(spark, width, long_words):
    rng = np.random.default_rng(width)
    long, half = " ".join(f"w{k}" for k in range(60)), " ".join(f"h{k}" for k in range(7))
    texts = ["a\nb\nc", "x\na\nb\nc\ny", "a\nb", "b\n\na\n \nb\nc", long, f"q\n{long}\nr", "a\na\na\na\na", None, "", "\n\n", "c", "c", f"{half}\n{half} z", f"u\n{half}\n{half} z\nv"]
    texts += ["\n".join(rng.choice(list("abcdef"), 12)) for _ in range(30)]
    docs = table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = line_dedup.report(docs, width, long_words).collect()
    assert {r.doc_id: r.n_removed for r in got if r.n_removed} == brute_lines(list(enumerate(texts)), width, long_words)


def test_line_dedup_stage(spark):
    long = " ".join(f"w{k}" for k in range(60))
    texts = ["a\nb\nc", "x\na\nb\nc\ny", "c\na\nb\nc", "b\n\na\n \nb", long, f"q\n{long}\nr", long, None, "", "c", "c"]
    kept = line_dedup.keep_first_lines(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]))
    text = {r.doc_id: r.text for r in kept.collect()}
    assert text[1] == "x\ny" and text[2] == "c" and text[5] == "q\nr" and 6 not in text and text[7] is None and text[8] == "" and text[9] == text[10] == "c"


def test_stages_with_clashing_columns_and_empty_tables(spark):
    clash = "doc, th, words, kept, lines, removed, hash, id, n, i, p, s, lang_, share, language, text_, best, root".split(", ")
    docs = table(spark, [(i % 7 if i % 5 else None, f"{EN if i % 2 else DE} {i % 9}", "en" if i % 2 else "de", f"s{i % 3}") for i in range(30)])
    docs = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(clash)], *[F.lit(k).alias(f"__{c}") for k, c in enumerate(clash)])
    for stage in (language.keep_identified, line_dedup.keep_first_lines, jaccard.keep_one, mixing.take):
        got = stage(docs)
        assert got.columns == docs.columns and got.count() > 0
        assert all(r[c] == k for r in got.collect() for k, c in enumerate(clash))
        assert stage(docs.limit(0)).collect() == []


def test_jaccard_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(12):
        base = rng.choice(words, 60).tolist()
        for k in range(8):
            t = list(base)
            for _ in range(k // 2):
                t[int(rng.integers(len(t)))] = "zz"
            rows.append(" ".join(t))
    common = " ".join(rng.choice(words, 25))
    rows += [f"{common} {' '.join(rng.choice(words, 40))}" for _ in range(80)]
    rows += [" ".join([*words[:200], *[f"n{k}_{j}" for j in range(1)]]) for k in range(120)] + ["a b", "a b", "", None, "a b c"]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join_documents(table(spark, [(i, t, "en", "s") for i, t in enumerate(rows)])).collect()}
    sets = []
    for t in rows:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    distinct = list(dict.fromkeys(sets))
    root, links = list(range(len(distinct))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            if len(a & distinct[j]) >= 0.8 * len(a | distinct[j]) - 1e-9 and a and distinct[j]:
                root[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    first = {}
    for k, s in enumerate(sets):
        first.setdefault(find(distinct.index(s)), k)
    assert got == {k: (first[find(distinct.index(s))], links[distinct.index(s)]) for k, s in enumerate(sets)}
    stay = jaccard.keep_one(table(spark, [(i, t, "en", "s") for i, t in enumerate(rows)]))
    assert {r.doc_id for r in stay.collect()} == set(first.values())


def test_jaccard_recall_in_a_large_family(spark):
    rng = np.random.default_rng(1)
    n, planted = 6000, 600
    # Three passages stand at each place: pairs share a third of the values, and no bucket gets small by one of them.
    which = rng.integers(0, 3, (n, jaccard.HASHES))
    for k in range(planted):  # the second of a pair has another passage in one place of five
        which[2 * k + 1] = which[2 * k]
        which[2 * k + 1, rng.permutation(jaccard.HASHES)[:13]] += 1
    values = (which % 3 + 3 * np.arange(jaccard.HASHES)).astype(np.uint32)
    rep = rng.permutation(n) + 1
    rows = spark.createDataFrame([(int(r), v.tobytes()) for r, v in zip(rep, values, strict=True)], "rep long, values binary")
    got = {tuple(r) for r in jaccard.candidates(rows, 0.8, jaccard.runs_needed(0.8)).collect()}
    found = sum((min(a, b), max(a, b)) in got for a, b in zip(rep[: 2 * planted : 2].tolist(), rep[1 : 2 * planted : 2].tolist(), strict=True))
    assert found >= 0.985 * planted, found


def test_components_of_long_chains(spark):
    rng = np.random.default_rng(2)
    ids = (rng.permutation(2000) - 1000).tolist()
    chain, rising = ids[:1000], sorted(ids[1000:])
    edges = [*zip(chain[:-1], chain[1:], strict=True), *zip(rising[1:], rising[:-1], strict=True)]
    got = dict(map(tuple, jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: min(c) for c in (chain, rising) for k in c}


def test_keep_one_of_null_and_reused_ids(spark):
    rng = np.random.default_rng(3)
    words = np.array([f"v{i}" for i in range(3000)])
    text = [" ".join(rng.choice(words, 60)) for _ in range(14)]
    near = text[0] + " more"
    # Unrelated texts without ids, under one id, a copy and a near copy beside a text of its own, a repeated row.
    rows = [(None, text[i]) for i in range(6)] + [(9, text[i]) for i in range(6, 10)]
    rows += [(3, near), (9, text[1]), (3, text[10]), (4, text[10]), (5, text[11]), (5, text[11]), (None, text[1]), (None, text[12]), (None, text[12]), (None, ""), (7, None)]
    got = sorted((r.doc_id, r.text) for r in jaccard.keep_one(table(spark, [(i, t, "en", "s") for i, t in rows])).fillna({"doc_id": -1}).fillna("?", ["text"]).collect())
    want = [(-1, text[i]) for i in (2, 3, 4, 5, 12)] + [(9, text[i]) for i in range(6, 10)] + [(3, near), (9, text[1]), (3, text[10]), (5, text[11]), (7, "?")]
    assert got == sorted(want)


def test_media_metadata_come_from_headers(docs, monkeypatch):
    read = media.read_metadata
    monkeypatch.setattr(media, "read_metadata", lambda at: read(at).withColumn("media_bytes", F.col("media_bytes") + 1_000_000).withColumn("feature", F.lit("head")))
    got = media.media_columns(docs).collect()
    assert got and all(r.media_bytes > 1_000_000 and r.feature == "head" for r in got)


def test_topk_stops_early():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(1024, 8)) / 4).astype(np.int64)
    queries = x[:40] * 3
    # Rows near each query stand out, and a floor is known for half of the queries.
    x = np.concatenate([np.repeat(queries, 6, 0) + rng.integers(-9, 9, (240, 8)), x])
    ids, asked = rng.permutation(len(x)), np.arange(10_000, 10_040)
    want = {int(q): sorted((-int(v @ w), int(i)) for v, i in zip(x, ids, strict=True))[:5] for q, w in zip(asked, queries, strict=True)}
    floor = np.array([-want[int(q)][4][0] if k % 2 else -np.inf for k, q in enumerate(asked)])
    found, read = topk.block_top(ids, x, asked, queries, 5, floor)
    assert (read < topk.STEPS).mean() > 0.9
    got = {}
    for q, v, s in found:
        got.setdefault(q, []).append((-s, v))
    assert {q: sorted(g) for q, g in got.items()} == want
    # Nothing is read of a block that can't reach the floor.
    found, read = topk.block_top(ids, x, asked, queries, 5, np.full(40, 1e12))
    assert not found and not read.any()


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 8)).round(1).astype(np.float32)
    rows = [(int(i), [float(v) for v in x[i]], "r") for i in range(700)]
    rows += [(700, None, "r"), (750, [1.0, None] + [0.0] * 6, "r"), (800, [float("nan")] * 8, "r"), (850, [1.0] * 3, "r"), (900, [1.0] * 3, "r"), (901, [float("inf")] * 8, "r"), (None, [1.0] * 8, "r"), (3, [0.5] * 8, "r")]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")).collect()))
    fine = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v, _ in rows if i is not None and v is not None and all(e is not None and np.isfinite(e) for e in v)]
    want = []
    for q, a in fine:
        if q % 50 == 0:
            best = sorted((-int(a @ b), i) for i, b in fine if i != q and len(b) == len(a))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_language_of_switched_text(spark, docs):
    got = {r.doc_id: r for r in language.identify(docs).filter("doc_id <> 1").collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(40) if i != 1)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (100, 101, 102, 103))
    assert got[5].held_out == (zlib.crc32(b"5") % 4 == 2)
    model = language.train([("en", EN.split()), ("de", DE.split())] * 20)
    p = model.documents([EN.split() * 3 + DE.split()])[0]
    assert 0.6 < p[1] < 0.9  # three quarters of the words
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({100, 101, 102, 103})


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    m = language.Crf(["a", "b", "c"], {}, t=rng.normal(size=(3, 3)))
    s = rng.normal(size=(2, 4, 3))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    got, two, z = m.marginals(s, mask, pairs=True)
    total, pairs = 0.0, np.zeros((3, 3))
    for n, length in ((0, 4), (1, 2)):
        ways = {y: np.exp(sum(s[n, i, y[i]] for i in range(length)) + sum(m.t[y[i], y[i + 1]] for i in range(length - 1))) for y in itertools.product(range(3), repeat=length)}
        norm = sum(ways.values())
        total += np.log(norm)
        for i in range(length):
            assert np.allclose(got[n, i], [sum(v for y, v in ways.items() if y[i] == k) / norm for k in range(3)])
        for i in range(length - 1):
            for y, v in ways.items():
                pairs[y[i], y[i + 1]] += v / norm
    assert np.isclose(z, total) and np.allclose(two, pairs)


def test_models_equal_brute_force(spark):
    """Counts, discounts and log-ratios of both models, written out for every token."""
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(500):
        t, bad = rng.choice(words, 30).tolist(), i % 10 == 0
        for _ in range(4 * bad):
            k = int(rng.integers(29))
            t[k : k + 2] = ["w1", f"slur{int(rng.integers(2))}"] if rng.random() < 0.5 else ["slur2", t[k + 1]]
        rows.append((i, " ".join(t), "en", "s"))
        labels.append((i, int(bad)))
    rows += [(1000 + k, None if k else "", "en", "s") for k in range(2)]
    train = {i: y for i, y in labels if zlib.crc32(str(i).encode()) % 5 in (1, 2, 3)}
    text = {i: (t or "").split() for i, t, *_ in rows}
    corpus, pairs_all = Counter(), Counter()
    for t in text.values():
        corpus.update(t)
        pairs_all.update(zip(["", *t], t))
    size = sum(corpus.values())
    triples = [{x for i, y in train.items() if y == c for x in zip(["", "", *text[i]], ["", *text[i]], text[i])} for c in (0, 1)]
    pair = [Counter((v, w) for _, v, w in t) for t in triples]
    uni = [Counter(w for _, w in p) for p in pair]

    def cut(counts):
        n = [sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / max(n[0] + 2 * n[1], 1)
        return min(max(np.ceil(3 - 4 * y * n[3] / max(n[2], 1)), 1), 3)

    total = [sum(u.values()) for u in uni]
    evidence = [{w: max(u[w] - cut(u) - toxicity.EXCESS * total[c] * corpus[w] / size, 0) for w in corpus} for c, u in enumerate(uni)]
    p = [{w: (e[w] + (total[c] - sum(e.values())) * corpus[w] / size) / total[c] for w in corpus} for c, e in enumerate(evidence)]
    mass = [Counter() for _ in (0, 1)]
    for c in (0, 1):
        for (v, _), f in pair[c].items():
            mass[c][v] += f
    strong = [{k: max(f - cut(pair[c]) - toxicity.EXCESS * max(mass[c][k[0]] * p[c][k[1]], sum(pair[c].values()) * pairs_all[k] / size), 0) for k, f in pair[c].items()} for c in (0, 1)]
    assert sum(x > 0 for x in strong[1].values()) >= 2

    def log(c, v, w):
        m = max(mass[c][v], 1)
        return np.log(strong[c].get((v, w), 0) / m + (m - sum(e for k, e in strong[c].items() if k[0] == v)) / m * p[c][w])

    want = {i: np.mean([log(1, v, w) - log(0, v, w) for v, w in zip(["", *t], t)]) if t else 0.0 for i, t in text.items()}
    df = table(spark, rows).select("doc_id", "text").cache()
    models = toxicity._models(df, spark.sparkContext.broadcast((train, {})))
    for i, t in text.items():
        ids = np.array([models.id.get(w, len(models.word) - 1) for w in t], np.int64)
        got = models.tokens(ids, np.zeros(1, np.int64)).mean() if t else 0.0
        assert np.isclose(got, want[i]), (i, got, want[i])
    # The query's score rises with this difference and with nothing else.
    got = {r.doc_id: r.score for r in toxicity.score(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    order = sorted(want, key=want.get)
    assert all(got[a] <= got[b] + 1e-12 for a, b in zip(order[:-1], order[1:], strict=True)) and got[1000] == got[1001]


def test_pieces_of_a_chain_equal_the_whole():
    rng = np.random.default_rng(3)
    m = language.Crf(["a", "b", "c"], {}, t=(3 * np.eye(3) + rng.normal(size=(3, 3))).astype(np.float64))
    for size in ([70], [64, 3, 65], [500, 1, 129, 64 * 4], [8, 9, 2]):
        table = rng.normal(size=(40, 3)) * rng.choice([0.0, 1.0], (40, 1))
        m.emissions = lambda _, table=table: table
        ids, n = rng.integers(0, 40, sum(size)), np.array(size)
        mean, each = m.coded([], ids, n, words=True)
        at = 0
        for k, length in enumerate(size):
            whole = m.marginals(table[ids[at : at + length]][None], np.ones((1, length), bool))[0]
            assert np.allclose(each[at : at + length], whole, atol=1e-5) and np.allclose(mean[k], whole.mean(0), atol=1e-5)
            at += length


def test_language_sample_is_bounded_and_even(spark):
    rows = [(None, f"nothing {i}", "en", "s") for i in range(4000)] + [(i, f"selten {i}", "de", "s") for i in range(9)] + [(1, "rare", f"l{i}", "s") for i in range(600)]
    df = table(spark, rows).repartition(7)
    got = language.sample(df, 3000)
    count = Counter(y for y, _ in got)
    assert len(count) == 602 and count["en"] == 4 and len(got) <= 3000
    assert sorted(got) == sorted(language.sample(df.repartition(3), 3000))
    few = Counter(y for y, _ in language.sample(df, 100))
    assert len(few) == 100 and {"en", "de"} <= set(few)


def test_language_query_equals_brute_force(spark):
    """Every document's language and score by plain forward-backward over its whole chain."""
    rng = np.random.default_rng(8)
    en, de = EN.split(), DE.split()
    texts = [" ".join([*rng.choice(en, int(rng.integers(1, 300))), *rng.choice(de, int(rng.integers(0, 200)))]) for _ in range(60)] + ["", None, "12 !"]
    df = table(spark, [(i, t, "en" if i % 2 else "de", "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in language.identify(df).collect()}
    model = language.train(language.sample(df, 3000))
    for i, t in enumerate(texts):
        words = (t or "12").split() if t not in ("", "12 !") else []
        words = [w for w in map(language.word_of, words) if w]
        if not words:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        e = model.emissions(words).astype(float)
        a, b = np.zeros_like(e), np.zeros_like(e)
        x = np.exp(e - e.max(1, keepdims=True))
        for k in range(len(words)):
            a[k] = x[k] if not k else (a[k - 1] @ np.exp(model.t)) * x[k]
            a[k] /= a[k].sum()
        b[-1] = 1
        for k in range(len(words) - 2, -1, -1):
            b[k] = np.exp(model.t) @ (x[k + 1] * b[k + 1])
            b[k] /= b[k].sum()
        p = a * b / (a * b).sum(1, keepdims=True)
        mean = p.mean(0)
        assert abs(got[i].score - mean.max()) < 1e-4 and got[i].lang_pred in (model.labels[k] for k in np.flatnonzero(mean > mean.max() - 1e-4))
    runs = language.spans(df).filter("doc_id < 60").collect()
    by = {}
    for r in runs:
        by.setdefault(r.doc_id, []).append((r.first, r.last, r.language))
    for i, t in enumerate(texts[:60]):
        r = sorted(by[i])
        assert r[0][0] == 0 and r[-1][1] == len(t.split()) - 1 and all(x[1] + 1 == y[0] and x[2] != y[2] for x, y in zip(r[:-1], r[1:], strict=True))


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(800):
        t, bad = rng.choice(words, 60).tolist(), i % 6 == 0
        for _ in range(3 * bad):
            t[int(rng.integers(60))] = f"slur{int(rng.integers(4))}"
        rows.append((i, " ".join(t), "en", "s"))
        labels.append((i, int(bad)))
    got = toxicity.score(table(spark, rows), spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.97
    none = toxicity.score(table(spark, rows[:5]), spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert all(r.score == 0 and r.predicted == 0 for r in none)


def test_pipeline_stages(spark, tmp_path, docs):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    (tmp_path / "d").mkdir()
    plain.write.parquet(str(tmp_path / "d" / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "d"))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = plain
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, got, str(tmp_path / "d"))
        assert after.columns == plain.columns, name
        got = after.cache()
    t = Tokenizer.from_file(PATH)
    want = sorted((r.doc_id, t.encode(r.text, add_special_tokens=False).ids) for r in got.collect())
    assert sorted((r.doc_id, r.ids) for r in out.collect()) == want


def test_toxicity_sends_predecessors_once(spark):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"word{k}" for k in rng.integers(0, 3000, 150))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    df.count()
    train = {i: i % 2 for i, _ in rows}
    store = spark._jsc.sc().statusStore()

    def written():
        stages = store.stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = written()
    toxicity._models(df, spark.sparkContext.broadcast((train, {})))
    # Each of the 225,000 predecessors went through two exchanges.
    assert written() - before < 1.3 * 1500 * 150


@pytest.mark.parametrize("most", [3, 150, 40_000, 1 << 30, 1 << 40])
def test_topk_is_exact_for_integers_of_any_size(most):
    rng = np.random.default_rng(most % 97)
    x = rng.integers(-most, most, (300, 6), endpoint=True)
    ids, queries = rng.permutation(300), np.concatenate((x[:20], np.zeros((1, 6), np.int64)))
    asked = np.concatenate((ids[:20], [999]))
    for floor in (None, np.full(21, -np.inf), np.array([sorted((sum(map(int.__mul__, w.tolist(), v.tolist())) for i, v in zip(ids, x, strict=True) if i != a), reverse=True)[4] for a, w in zip(asked, queries, strict=True)], float)):
        got = topk.block_top(ids, x, asked, queries, 5, floor, first=1 if floor is None else 4)[0]
        want = []
        for a, w in zip(asked.tolist(), queries, strict=True):
            best = sorted((-sum(map(int.__mul__, w.tolist(), v.tolist())), i) for i, v in zip(ids.tolist(), x, strict=True) if i != a)[:5]
            want += [(a, i, -s) for s, i in best]
        assert sorted(got) == sorted(want)


def test_topk_reads_a_block_in_little_more_than_its_products():
    import time

    rng = np.random.default_rng(6)
    x = np.floor(32 * rng.normal(size=(9216, 64))).astype(np.int64)
    ids, asked, queries = np.arange(9216), np.arange(20_000, 20_512), x[:512] + 1
    lists = rng.permutation(9216).reshape(9, 1024)
    floor = np.sort(queries.astype(float) @ x.T, axis=1)[:, -5]

    def seconds(f):
        t = time.process_time()
        for at in lists[1:]:
            f(at)
        return time.process_time() - t

    plain = min(seconds(lambda at: np.partition(queries.astype(float) @ x[at].T.astype(float), 1019, axis=1)) for _ in range(3))
    own = min(seconds(lambda at: topk.block_top(ids[at], x[at], asked, queries, 5, floor)) for _ in range(3))
    assert own < 8 * plain

"""The corpus operators against brute force, exact round trips and held-out labels, on small tables."""

import base64
import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from costlake.llm import bpe, chat, cotraining, fingerprint, html, jaccard, packing, quality_rules, repeats, sharding
from costlake.llm import text as text_module

from .conftest import COLUMNS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def clashing(df):
    """Further columns with names that the operators use themselves."""
    return df.select("*", F.lit(1).alias("node"), F.lit("x").alias("found"), F.lit(2).alias("id"), F.lit("k").alias("_q_kept"),
                     F.lit(0).alias("bucket"), F.lit(3).alias("key"))


def same(values):
    return collections.Counter(map(str, values))


# 1. near duplicates


def shingles(text, n=5):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_links(sets):
    return {(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j]
            and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


def brute_components(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in sorted(brute_links(sets)):
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return {i: find(i) for i in sets}


def test_jaccard_components(frame, documents):
    sets = {d[0]: shingles(d[1]) for d in documents}
    expected = brute_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(clashing(frame)).collect()}
    assert got == {i: (len(sets[i]), expected[i]) for i in sets}
    assert len(set(expected.values())) < len(sets) - 25


def test_jaccard_links(frame, documents):
    join = jaccard.Join(frame)
    names = collections.defaultdict(list)
    for r in join.sets.where("n > 0").collect():
        names[r.node].append(r.id)
    sets = {d[0]: shingles(d[1]) for d in documents}
    expected = {p for p in brute_links(sets) if sets[p[0]] != sets[p[1]]}
    got = {tuple(sorted((i, j))) for r in join.links().collect() for i in names[r.a] for j in names[r.b]}
    assert got == expected


def test_jaccard_edge_of_threshold(spark):
    """Pairs of every size around the threshold: the segments must lose none."""
    rng, rows = random.Random(2), []
    for size in [*range(1, 40), 55, 61, 90, 92, 137, 206, 310, 470]:
        words = [f"w{size}x{rng.random()}" for _ in range(size)]
        rows.append(words)
        for cut in range(0, max(1, size // 4 + 2), max(1, size // 24)):
            rows.append(words[:len(words) - cut] + [f"y{rng.random()}" for _ in range(rng.choice([0, 0, cut // 2]))])
    docs = [(i, " ".join(w), "en", "a", 0) for i, w in enumerate(rows)]
    sets = {d[0]: shingles(d[1]) for d in docs}
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(docs, COLUMNS)).collect()}
    assert got == brute_components(sets)


def test_jaccard_repeated_rows_and_nulls(spark):
    text = "one two three four five six seven"
    docs = [(1, text, "en", "a", 0), (1, text, "en", "a", 0), (1, "a b c d e f", "en", "a", 0), (2, "a b c d e f", "en", "a", 0),
            (None, text, "en", "a", 0), (3, None, "en", "a", 0), (4, "", "en", "a", 0)]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, COLUMNS)).collect()
    assert same((r.doc_id, r.component_id) for r in got) == same([(1, 1), (1, 1), (1, 1), (2, 1), (None, 1), (3, 3), (4, 4)])
    kept = jaccard.representatives(spark.createDataFrame(docs, COLUMNS)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 3, 4]


def test_jaccard_null_id_links(spark):
    """A text that has no id but null links 1 and 9, which are not similar themselves."""
    w, x, y = ([f"{c}{i}" for i in range(100)] for c in "wxy")
    a, between, b = (" ".join(t) for t in (w, w[:92] + x[:8], y[:8] + w[8:92] + x[:8]))
    assert brute_links({1: shingles(a), 2: shingles(between), 9: shingles(b)}) == {(1, 2), (2, 9)}
    docs = [(1, a, "en", "a", 0), (None, between, "en", "a", 0), (9, b, "en", "a", 0), (4, "other words than these", "en", "a", 0)]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, COLUMNS)).collect()
    assert same((r.doc_id, r.component_id) for r in got) == same([(1, 1), (None, 1), (9, 1), (4, 4)])


def test_jaccard_id_of_many_texts(spark, monkeypatch):
    """The texts of one id are found one by one, not each among all rows of the id."""
    words = [[f"w{k}x{i}" for i in range(60)] for k in range(20)]
    texts = [" ".join([*own[:-1], f"y{j}"]) for own in words for j in range(5)]
    found, plain = [], jaccard.arrow_map

    def watched(df, fn, schema):
        if fn.__qualname__.startswith("_same_text"):
            found.append(df)
        return plain(df, fn, schema)

    monkeypatch.setattr(jaccard, "arrow_map", watched)
    docs = [(7, t, "en", "a", 0) for t in texts] + [(8, texts[0], "en", "a", 0), (9, "other words than these", "en", "a", 0)]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, COLUMNS)).collect()
    assert same((r.doc_id, r.component_id) for r in got) == same([(7, 7)] * len(texts) + [(8, 7), (9, 9)])
    assert [df.count() for df in found] == [len(texts)]


def test_jaccard_empty(empty):
    assert jaccard.near_duplicates(empty).collect() == []


def test_pigeonhole_holds():
    """Partners within H differences share a segment under either allocation, and E - H segments under plain ones."""
    rng = np.random.default_rng(1)
    for size in (3, 7, 20, 64, 150, 400):
        for deletions in (False, True):
            cut = jaccard.Band(jaccard.used(jaccard.BANDS[int(np.searchsorted(jaccard.BANDS, size))], deletions, 80), deletions)
            for _ in range(30):
                big = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
                drop = rng.integers(0, jaccard.differences(size, 80) + 1) if size > 4 else 0
                small = np.delete(big, rng.choice(len(big), min(drop, len(big) // 5), replace=False))
                a, b = ([(int(k), int(p)) for p, k in enumerate(jaccard.keys_of(x, 5, cut, 80))] for x in (small, big))
                h = jaccard.differences(len(small), 80)
                least = 1 if deletions else jaccard.used(len(small), False, 80) - h
                agree = {p for k, p in a for j, _ in b if k >> 1 == j >> 1 and not (k & j & 1)}
                assert len(agree) >= least


def test_buckets_across_batches():
    import pyarrow as pa

    rng = random.Random(3)
    # Whole subsets have even keys; a node's neighbours (odd) are others than its own subset.
    rows = sorted((2 * rng.randrange(30) + (n >= 5), n) for n in (rng.randrange(9) for _ in range(160)))
    groups = collections.defaultdict(set)
    for k, n in rows:
        groups[k >> 1].add((k & 1, n))
    expected = sorted((2 * k + d, n, min(v)[1]) for k, v in groups.items() if len(v) > 1 and min(v)[0] == 0 for d, n in v)
    for step in (1, 2, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + step]], pa.int64()), pa.array([r[1] for r in rows[i:i + step]], pa.int64())],
                                              names=["key", "node"]) for i in range(0, len(rows), step)]
        got = sorted(tuple(x) for b in jaccard._buckets(iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
        assert got == expected


def test_connected(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    sets = {}

    def find(x):
        sets.setdefault(x, x)
        while sets[x] != x:
            x = sets[x]
        return x

    for a, b in pairs:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            sets[hi] = lo
    got = {r.node: r.root for r in jaccard.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in sets}


# 2. packing


def piece_check(pieces, ids, window=1024):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for doc, own in ids.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(own)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(own[at:at + p.length].tobytes())
            at += p.length
        assert at == len(own)
    lengths = []
    for k in sorted(by_seq):
        at = 0
        for p in sorted(by_seq[k], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        lengths.append(at)
    assert sorted(by_seq) == list(range(len(by_seq)))
    assert all(n == window for n in lengths[:-1])
    return by_seq


@pytest.mark.parametrize(("window", "quantum"), [(1024, 128), (64, 16)])
def test_packing(frame, documents, window, quantum):
    path = P.path("byte_bpe_50k.json")
    model = packing.encoder(path)
    ids = {d[0]: np.array([*model.encode_ordinary(d[1] or ""), 0], "<u4") for d in documents}
    piece_check(packing.pack(clashing(frame), path, window, quantum).collect(), ids, window)


def test_packing_follows_the_mixture(spark):
    docs = [(i, "some words of text " * 40, "en", "a" if i % 4 else "b", 0) for i in range(200)]
    frame = spark.createDataFrame(docs, COLUMNS).repartition(4)
    path = P.path("byte_bpe_50k.json")
    for weights, share in ((None, 0.75), ({"a": 0.5, "b": 0.5}, 0.5)):
        seqs = collections.defaultdict(lambda: collections.Counter())
        for p in packing.pack(frame, path, 1024, 128, weights).collect():
            seqs[p.sequence_id][p.source] += p.length
        first = [seqs[k] for k in range(len(seqs) // 3)]
        total = collections.Counter()
        for c in first:
            total.update(c)
            # After any number of windows, each source is within a quantum of its share.
            assert abs(total["a"] - share * sum(total.values())) <= 128 + 1
        assert all(abs(c["a"] - share * 1024) <= 128 for c in first)


def test_packing_empty(empty):
    assert packing.pack(empty, P.path("byte_bpe_50k.json")).collect() == []


def test_packing_ids_are_those_of_tokenizers(documents):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = [d[1] or "" for d in documents] + ["<|endoftext|> it's 12 dogs'    x\r\n\r\n\t y  z\u0085 ᠎ é́ 漢字 😀👍🏽 \x00\x1f​"]
    texts += ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} " for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000) for lo in range(1, 0x3200, 512)]
    model = packing.encoder(path)
    for text, own in zip(texts, t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert model.encode_ordinary(text) == own.ids


def test_packing_long_white_space(spark):
    """Runs on which the regular expression of tiktoken panics."""
    from tokenizers import Tokenizer

    path, n = P.path("byte_bpe_50k.json"), 1_200_000
    t = Tokenizer.from_file(path)
    texts = ["word" + " " * n + "x", "\n" * n, "a b  c\n" + "\r\n" * (n // 2) + " it's\t" + " " * n, " " * n + "\u3000x" + "\x1f" * 9 + " y"]
    ids = {i: np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4") for i, x in enumerate(texts)}
    frame = spark.createDataFrame([(i, x, "en", "a", len(x)) for i, x in enumerate(texts)], COLUMNS)
    piece_check(packing.pack(frame, path).collect(), ids)


def test_packing_added_tokens(spark):
    """A literal added token has its id, as ``tokenizers`` takes it from the file."""
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t, end = Tokenizer.from_file(path), "<|endoftext|>"
    texts = [f"a page {end} more text", end, end * 3, f"  {end}  \n {end}x", f"it{end}'s <|endoftext| > <|ENDOFTEXT|>",
             "a" + " " * 1_200_000 + end + "\n" * 1_200_000 + f"b {end} c"]
    ids = {i: np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4") for i, x in enumerate(texts)}
    assert list(ids[0]) == [64, 2443, 220, 50256, 517, 2420, 0]
    frame = spark.createDataFrame([(i, x, "en", "a", len(x)) for i, x in enumerate(texts)], COLUMNS)
    piece_check(packing.pack(frame, path).collect(), ids)


# 3. sharding


def brute_shards(sizes, limit, depth=60):
    """Recursive splitting of (hash bits, size) on one more bit each time."""
    out = {}

    def split(rows, d):
        if d >= depth or len(rows) < 2 or sum(s for _, _, s in rows) <= limit:
            out.update({k: h[:d] for k, h, _ in rows})
            return
        for bit in "01":
            split([r for r in rows if r[1][d] == bit], d + 1)

    split([(k, f"{int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16):060b}", s) for k, s in sizes.items()], 0)
    return out


@pytest.mark.parametrize(("limit", "first"), [(2000, None), (2000, 1), (300, 2), (10**9, None)])
def test_sharding(frame, documents, limit, first):
    sizes = {d[0]: len((d[1] or "").encode()) for d in documents}
    expected = brute_shards(sizes, limit)
    rows = sharding.shards(clashing(frame), limit, first_bits=first).collect()
    assert {r.doc_id: r.shard for r in rows} == expected
    total, count = collections.Counter(), collections.Counter()
    for r in rows:
        total[r.shard] += r.n_bytes
        count[r.shard] += 1
    assert all((r.shard_bytes, r.shard_rows, r.depth) == (total[r.shard], count[r.shard], len(r.shard)) for r in rows)
    assert all(t <= limit or count[s] == 1 for s, t in total.items())


def test_sharding_splits_a_hot_key(spark):
    docs = [(7, "x" * 50 if i % 2 else f"text {i}", "en", "a", 0) for i in range(120)] + [(None, None, None, None, None)]
    rows = sharding.shards(spark.createDataFrame(docs, COLUMNS), 400).collect()
    total = collections.Counter()
    for r in rows:
        total[r.shard] += r.n_bytes
    assert len(rows) == 121 and max(total.values()) <= 400


def test_sharding_empty(empty):
    assert sharding.shards(empty, 100).collect() == []


# 4. classifier


def labelled(n, seed):
    """Texts of a vocabulary; bad ones are insulting, or full of symbols."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(40, 150))]
        kind = rng.random()
        if kind < 0.15:
            for _ in range(4):
                own[rng.randrange(len(own))] = rng.choice(["idiot", "moron", "scum"])
        elif kind < 0.3:
            own = [w + "***" for w in own]
        docs.append((i, " ".join(own), "en", rng.choice("ab"), 10 * len(own)))
        labels.append((i, int(kind >= 0.3 or kind < 0.15), int(kind < 0.15)))
    return docs, labels


def test_cotraining_held_out(spark):
    docs, labels = labelled(900, 8)
    df = spark.createDataFrame(docs, COLUMNS)
    given = spark.createDataFrame(labels[:500], "doc_id long, quality int, toxic int")
    model = cotraining.train(df, given, pool=300)
    rows = {r.doc_id: r for r in cotraining.scored(clashing(df), model).collect()}
    good = {i: q == 1 and t == 0 for i, q, t in labels}
    rest = range(500, 900)
    assert np.mean([rows[i].kept == good[i] for i in rest]) > 0.97
    assert sum(good[i] and not rows[i].kept for i in rest) <= 2
    assert all(0 <= rows[i].score <= 1 for i in rows)
    assert sum(map(sum, model.exchanged)) > 0  # views did tell each other something
    left = cotraining.filtered(clashing(df), model)
    assert left.columns == clashing(df).columns
    assert {r.doc_id for r in left.collect()} == {i for i in rows if rows[i].kept}


def test_cotraining_sample_is_bounded_and_pool_is_not(spark, monkeypatch):
    """One row of each labelled id, though one id has most rows; all unlabelled documents are scored."""
    docs, labels = labelled(700, 10)
    more, _ = labelled(900, 11)
    hot = [(0, *d[1:]) for d in more]  # a labelled id
    nulls = [(None, *d[1:]) for d in more[:50]]
    df = spark.createDataFrame(docs + hot + nulls, COLUMNS)
    given = spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    seen, plain = [], cotraining.arrow_map

    def watched(df, fn, schema):
        seen.append((fn, df))
        return plain(df, fn, schema)

    monkeypatch.setattr(cotraining, "arrow_map", watched)
    model = cotraining.train(df, given, pool=100)
    rows = [df.count() for _, df in seen]
    assert rows[0] == 400 and rows[2:] == [300 + 50] * 3
    assert 0 < max(map(max, model.exchanged)) <= 10


def test_cotraining_edges(spark, frame, empty, documents):
    docs, labels = labelled(200, 9)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = cotraining.train(spark.createDataFrame(docs, COLUMNS), given)
    assert len(cotraining.scored(frame, model).collect()) == len(documents)
    assert cotraining.scored(empty, model).collect() == []
    none = cotraining.train(empty, given)
    assert none is None and cotraining.scored(frame, none).where("NOT kept").count() == 0
    one = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert cotraining.train(frame, one) is None


def test_cotraining_fits_without_copies_of_all_features():
    """The driver fits on the features it holds: neither their union nor wider copies of it are made."""
    import tracemalloc

    rng = np.random.default_rng(3)
    good = rng.random(400) < 0.5
    # feature 0 tells good documents, the other 20,000 of each document tell nothing
    parts = [np.append(np.int32(0) if g else np.int32(1), np.sort(rng.choice(np.arange(2, 1 << 18, dtype=np.int32), 20_000, replace=False))) for g in good]
    size = sum(p.nbytes for p in parts)
    tracemalloc.start()
    weights = cotraining.fit(parts, good, cotraining.TEXT_BITS, rounds=20)
    assert tracemalloc.get_traced_memory()[1] < size
    tracemalloc.stop()
    assert weights[0] > 0 > weights[1]
    every = cotraining.View.of(parts).logits(weights)
    assert (cotraining.logits(parts, weights) == every).all() and ((every > 0) == good).all()


# 5. fingerprints


def test_fingerprints_of_edited_texts(frame, documents):
    texts = [d[1] or "" for d in documents]
    rows = {r.doc_id: r for r in fingerprint.edited(clashing(frame)).collect()}
    assert len(rows) == len(texts)
    prints = collections.defaultdict(set)
    for i, t in enumerate(texts):
        cut = len(t) // 4
        edited = t[:len(t) - cut] + texts[(i + 1) % len(texts)][:cut]
        r = rows[documents[i][0]]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        prints[t].add(r.fingerprint)
        if edited == t:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for s in prints.values() for p in s}) == len(prints)
    long = [rows[d[0]] for d in documents[:59] if len(WORD.findall(d[1])) >= 90]  # the next ones are unrelated
    assert np.mean([r.near_edited for r in long]) > 0.6 and np.mean([r.near_next for r in long]) < 0.1


def test_fingerprint_is_a_homomorphism(spark):
    a, b = "First line here.\nSecond line, with more words in it than eight for sure.", "Third line.\nFirst line here."
    texts = [a, b, a + "\n" + b, b + "\n" + a, "\n".join(reversed(a.split("\n")))]
    rows = [r.asDict() for r in fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert rows[2]["fingerprint"] == rows[3]["fingerprint"] and rows[0]["fingerprint"] == rows[4]["fingerprint"]
    one = spark.createDataFrame([(rows[0]["p"], rows[0]["n"], rows[0]["packed"], rows[1]["p"], rows[1]["n"], rows[1]["packed"])],
                                "p array<long>, n long, k array<long>, q array<long>, m long, l array<long>")
    cols = [F.col(c) for c in ("p", "n", "k", "q", "m", "l")]
    total = one.select(*[c.alias(x) for c, x in zip(fingerprint.combine(*cols), "pnk", strict=True)], "q", "m", "l")
    assert total.select(fingerprint.encoded(*[F.col(c) for c in "pnk"])).first()[0] == rows[2]["fingerprint"]
    back = total.select(*[c.alias(x) for c, x in zip(fingerprint.combine(*cols, sign=-1), "pnk", strict=True)])
    assert back.select(fingerprint.encoded(*[F.col(c) for c in "pnk"])).first()[0] == rows[0]["fingerprint"]


def test_fingerprint_edges(spark, empty):
    assert fingerprint.edited(empty).collect() == []
    one = fingerprint.edited(spark.createDataFrame([(5, "abcd efgh", "en", "a", 9)], COLUMNS)).collect()
    assert one[0].near_next == 1
    rows = [(None, "null id", "en", "a", 7), (3, "tie two", "en", "a", 7), (3, "tie one", "en", "a", 7), (1 << 40, None, "en", "a", 0), (-5, "low", "en", "a", 3)]
    got = fingerprint.edited(spark.createDataFrame(rows, COLUMNS)).collect()
    order = ["null id", "low", "tie one", "tie two", ""]
    expected = []
    for i, t in enumerate(order):
        cut = len(t) // 4
        expected.append(hashlib.sha256((t[:len(t) - cut] + order[(i + 1) % 5][:cut]).encode()).hexdigest())
    assert same(r.edited_sha256 for r in got) == same(expected)


def test_fingerprint_likeness_of_long_texts(spark):
    """200,000 pieces each: an unrelated pair, an edited one, and one repeated line against another."""
    n = 200_000
    texts = ["\n".join(f"{side}{i:x}" for i in range(n)) for side in "ab"] + ["c\n" * n, "d\n" * n]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprint.edited(spark.createDataFrame(rows, COLUMNS)).collect()}
    # The edited text keeps three quarters; the standard error is about 0.08.
    assert got[0].near_next < 0.3 and 0.5 < got[0].near_edited < 0.95
    assert got[2].near_next < 0.3 and 0.7 < got[2].near_edited < 1


def test_fingerprint_blocks(spark, monkeypatch):
    """Texts of several blocks have the sums of one."""
    docs = spark.createDataFrame([(1, "some words of text. " * 300)], "doc_id long, text string")
    whole = fingerprint.fingerprints(docs).first().fingerprint
    monkeypatch.setattr(fingerprint, "BLOCK", 64)
    assert fingerprint.fingerprints(docs).first().fingerprint == whole


# 6. quality rules


def counted(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_features(frame, documents):
    rows = {r.doc_id: r for r in quality_rules.verdicts(clashing(frame)).collect()}
    assert len(rows) == len(documents)
    for i, text, *_ in documents:
        r, expected = rows[i], counted(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.base_failed and r.kept)


def test_quality_thresholds_adapt(spark):
    """What is usual in one source is an outlier in another."""
    rng = random.Random(6)

    def prose(symbols):
        return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 8))) + ("*" if rng.random() < symbols else "") for _ in range(80))

    docs = [(i, prose(0.5 if i % 2 else 0.0), "en", "code" if i % 2 else "news", 0) for i in range(300)]
    docs += [(1000, prose(0.5), "en", "news", 0), (1001, prose(0.0), "en", "code", 0)]
    rows = {r.doc_id: r.kept for r in quality_rules.verdicts(spark.createDataFrame(docs, COLUMNS)).collect()}
    assert not rows[1000] and all(rows[i] for i in rows if i != 1000)


def test_quality_sketch_is_mergeable_and_exact_enough(spark):
    rng = np.random.default_rng(3)
    values = rng.lognormal(1.5, 0.4, 4000)
    rows = [(i, 1000, int(v * 1000), 0, 0, 0, 1, 0, "en", "ab"[i % 2]) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, lang string, source string")
    sketch = quality_rules.sketches(frame)
    at = {"low": 0.25, "mid": 0.5, "high": 0.75}
    whole = quality_rules.quantiles(quality_rules.merged(sketch, "lang"), ["lang"], at).where("ratio = 'word_length'").first()
    parts = quality_rules.sketches(frame.where("doc_id < 1000")).unionByName(quality_rules.sketches(frame.where("doc_id >= 1000")))
    again = quality_rules.quantiles(quality_rules.merged(parts, "lang"), ["lang"], at).where("ratio = 'word_length'").first()
    assert whole == again
    for name, q in at.items():
        assert abs(whole[name] / np.quantile(values, q) - 1) < 0.02


def test_quality_filter_and_empty(frame, empty, documents):
    wide = clashing(frame)
    kept = quality_rules.filtered(wide)
    assert kept.columns == wide.columns
    verdict = {r.doc_id for r in quality_rules.verdicts(frame).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    assert quality_rules.verdicts(empty).collect() == [] and quality_rules.filtered(empty).collect() == []


# 7. main text of pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><a href=/>Site</a></header><nav><ul><li><a href=/a>Menu one</a><li><a href=/b>Menu two</a></ul></nav>
<div class="cookie-notice">We use cookies, many of them, on this site, and ask you to agree to that, please.</div>
<div id=wrap><div class="%s"><h1>The &amp; title</h1><p>First   paragraph, with a comma, and <b>bold <i>words</b> in</i> it, long enough.
<p>Second one&nbsp;&mdash; not closed, also with commas, and more text behind it<br>after a break.<ul><li>Item <a href=x>one</a><li>Item two</ul>
<aside>Aside text, that is long and has commas, many commas, but is no article.</aside>Loose text.<p>Short.</p>
<form><p>Subscribe, please, to our paper, with your address, now and here, for free.</p></form>
<table><tr><td>A</td><td>B</td></tr></table></div>
<div class="comments"><p>Reader: I like this, really, it is a fine article, and I read all of it, twice.</p></div></div>
<footer><p>Footer text, which is long, and has commas, as many as the article, or more, or so.</p></footer></body></html>"""
EXPECTED = ["The & title", "First paragraph, with a comma, and bold words in it, long enough.",
            "Second one — not closed, also with commas, and more text behind it after a break.", "Item one", "Item two", "Loose text.", "Short.", "A", "B"]


@pytest.mark.parametrize("name", ["content", "x1", "post-body main"])
def test_html(name):
    assert html.extract(PAGE % name).split("\n\n") == EXPECTED


@pytest.mark.parametrize("wrapper", ["class='page has-footer'", "id='content' class='nav-open'", "class='post-content no-comments'", "class='main with-share'"])
def test_html_wrappers(wrapper):
    """Layout wrappers keep the article; lists, tables and headings behind the best part stay."""
    text = "A sentence of the article, with commas, and words enough to score as a paragraph of its own."
    page = (f"<body><div class='site-footer'><p>{text} Footer.</p></div><div {wrapper}><div class='x'><p>{text}</p><p>{text}</p></div>"
            "<h2>Parts</h2><ul><li>First part</li><li>Second</li></ul><table><tr><td>Cell</td></tr></table>"
            f"</div><div id='comments'><p>{text} Comment.</p></div></body>")
    assert html.extract(page).split("\n\n") == [text, text, "Parts", "First part", "Second", "Cell"]


def test_html_odd_pages(spark):
    pages = [(1, "u", None), (2, "u", ""), (3, None, "just text"), (4, "u", "<p>"), (5, "u", "<article><p>Hi.</article>"), (6, "u", "<<<a b='>x"),
             (7, "u", "<div>" * 20000 + "deep text, that is long enough to count here" + "</div>" * 20000), (8, "u", "<!-- open"), (9, "u", "<script>never closed"),
             (9, "u", "<script>never closed"), (10, "u", "</div></p>a &lt; b &#233; &bogus; c"), (11, "u", "<a title=\"" * 3000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))
    rows = html.main_text(df).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert got[1] == got[2] == got[4] == got[8] == got[9] == ""
    assert (got[3], got[5], got[7]) == ("just text", "Hi.", "deep text, that is long enough to count here")
    assert got[10] == "a < b é &bogus; c"
    assert html.main_text(df.limit(0)).collect() == []


# 8. repeated substrings


def brute_removed(rows, length=100):
    """rows: (order, bytes). What is left, bytes and runs removed."""
    seen, out = set(), {}
    for key, doc in sorted(rows):
        gone = bytearray(len(doc))
        for p in range(len(doc) - length + 1):
            window = doc[p:p + length]
            if window in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(window)
        rest = bytes(c for c, g in zip(doc, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(doc)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[key] = (len(doc), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("large", [repeats.LARGE, 1])
def test_repeats(frame, documents, large):
    expected = brute_removed([(d[0], (d[1] or "").encode()) for d in documents])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removed(clashing(frame), large=large).collect()}
    assert got == expected
    assert sum(v[1] for v in expected.values()) > 5000


def test_repeats_random_overlaps(spark):
    """Random cuts of few strings: many repeats with other neighbours, and periodic texts."""
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(400)) for _ in range(3)] + ["ab" * 200, "z" * 300]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            b = rng.choice(base)
            a = rng.randrange(len(b))
            parts.append(b[a:a + rng.randint(20, 260)])
            parts.append("".join(rng.choice("xyz") for _ in range(rng.randint(0, 9))))
        docs.append((i * 3, "".join(parts), "en", "a", 0))
    frame = spark.createDataFrame(docs, COLUMNS).repartition(4)
    expected = brute_removed([(d[0], d[1].encode()) for d in docs])
    for large in (repeats.LARGE, 3):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removed(frame, large=large).collect()}
        assert got == expected


def test_repeats_long_texts_in_slices(spark, monkeypatch):
    rng = random.Random(12)
    a = "".join(rng.choice("abcdefghijklmnop") for _ in range(3000))
    docs = [(1, a, "en", "a", 0), (2, "q" + a[500:2500] + "w", "en", "a", 0), (3, a[::-1] + a[100:1900], "en", "a", 0)]
    import pyarrow as pa

    def rows(size):
        monkeypatch.setattr(repeats, "SLICE", size)
        batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])], names=["id", "text"])
        starts = set()
        for b in repeats.parse(iter([batch])):
            for i, place in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                place = place if place >= 0 else -1 - place
                starts |= {(i, (place >> 12) - d) for d in range(place & 63, (place >> 6 & 63) + 1)}
        return starts

    assert rows(700) == rows(1 << 21) == {(d[0], p) for d in docs for p in range(len(d[1]) - 99)}


def test_repeats_repeated_ids_and_cleaning(spark, empty):
    a, b = "The quick brown fox jumps over the lazy dog again and again until it is tired of all the jumping, and sleeps. é", "Other words " * 20
    docs = [(1, a, "en", "a", len(a)), (1, a, "en", "a", len(a)), (2, "new " + a + " end", "en", "a", 0), (None, b, "en", "a", 9), (3, None, "en", "a", None), (4, b, "en", "a", 7)]
    frame = spark.createDataFrame(docs, COLUMNS)
    rows = repeats.removed(frame).collect()
    assert same((r.doc_id, r.n_removed) for r in rows) == same([(1, 0), (1, 0), (2, len(a.encode())), (None, len(b) - 12), (3, 0), (4, len(b))])
    clean = repeats.deduplicated(clashing(frame))
    assert clean.columns == clashing(frame).columns
    got = collections.defaultdict(list)
    for r in clean.collect():
        got[r.doc_id].append((r.text, r.n_chars))
    assert got[1] == [(a, len(a))] * 2 and got[2] == [("new  end", 8)] and got[3] == [(None, None)] and got[4] == [("", 0)]
    assert repeats.removed(empty).collect() == [] and repeats.deduplicated(empty).collect() == []


# 9. chats


def test_chat_round_trip(spark):
    rng = random.Random(7)
    pieces = ["### Assistant:", "### User:", "### Role:", "</turn>", "</role>", "\\", "\n", " ", "é", "ok", "#", "<", "/turn>"]
    turns = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    for conv in range(60):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "assistant", "tool</role>", "", None])
            text = rng.choice([None, "", "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12)))])
            turns.append((conv, turn, role, text))
    turns += [(None, 0, "user", "a"), (None, None, None, None)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    wide = frame.select("*", F.lit(1).alias("segment"), F.lit(2).alias("body"))
    groups = collections.defaultdict(list)
    for c, t, r, x in turns:
        groups[c].append((t, r or "", x or ""))
    for dealt in (True, False):
        parts = chat.segments(wide)
        rows = {r.conv_id: r for r in chat.read_back(parts if dealt else parts.repartition(3), dealt=dealt).collect()}
        assert set(rows) == set(groups)
        for conv, own in groups.items():
            own = sorted(own, key=lambda t: (t[0] is not None, t[0]))
            r = rows[conv]
            loss = "".join(x for _, role, x in own if role == "assistant")
            assert r.n_turns == len(own)
            assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in own).encode()).hexdigest()
            assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    sizes = collections.Counter()
    for r in chat.segments(frame).collect():
        sizes[r.conv_id] += len(r.text)
    assert all(rows[c].formatted_chars == n for c, n in sizes.items())


def test_chat_machine(spark):
    def valid(*roles):
        frame = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
        return chat.read_back(chat.segments(frame)).first().valid

    assert valid("system", "user", "assistant") and valid("user", "assistant", "user", "assistant")
    assert not valid("assistant") and not valid("user", "user", "assistant") and not valid("user", "assistant", "user") and not valid("user", "tool")


def test_chat_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    got = [r.text for r in chat.segments(spark.createDataFrame(rows, schema)).orderBy("segment").collect()][1::3]
    assert got == ["a", "a", "b"]
    none = spark.createDataFrame([], schema)
    assert chat.segments(none).collect() == [] and chat.read_back(chat.segments(none)).collect() == []


# 10. byte-level BPE


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_is_that_of_tiktoken(name):
    import tiktoken

    path = P.path(name)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}  # noqa: SIM115
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, machine, pieces = bpe.coder(path, P.PATTERN)
    rng = random.Random(1)
    alphabets = ["abcdefghij", "aab ", "éèüß漢字かな😀🎉é", "0123456789 .,-\n\t  ", "".join(map(chr, range(1, 600)))]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, "=" * 3001, "é" * 2000, "<|endoftext|>", "".join(rng.choice("abcdeé") for _ in range(9000))]
    for text in texts:
        ids = encoder.encode_text(pieces.findall(text))
        assert ids == library.encode_ordinary(text)
        assert "".join(machine.decode(ids)) == text


def test_bpe_emits_before_the_end():
    """A long piece is emitted on the way: what is pending stays within some lengths of the longest token."""
    encoder, _, _ = bpe.coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    rng, state, ends, pending = random.Random(2), 0, [], 0
    for byte in "".join(rng.choice("abcdefghi") for _ in range(3000)).encode():
        state, token = encoder.step(state, byte)
        ends.append(token)
        sure = encoder.certain(state, ends)
        del ends[:sure]
        pending = max(pending, len(ends))
    assert pending <= 2 * encoder.longest


def test_bpe_forgets_and_goes_on(monkeypatch, documents):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    encoder, _, pieces = bpe.coder(path, P.PATTERN)
    before = [encoder.encode_text(pieces.findall(d[1] or "")) for d in documents]
    monkeypatch.setattr(type(encoder), "KEPT", 5)
    assert [encoder.encode_text(pieces.findall(d[1] or "")) for d in documents] == before


def test_utf8_machine_raises_on_cut_text():
    encoder, machine, _ = bpe.coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    ids = [encoder.ranks[bytes([b])] for b in "漢".encode()]
    assert "".join(machine.decode(ids)) == "漢"
    with pytest.raises(UnicodeDecodeError):
        list(machine.decode(ids[:-1]))


def test_bpe_jobs(frame, empty, documents):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(clashing(frame), path, P.PATTERN)
    back = {r.doc_id: r.text for r in bpe.decode(ids, path, P.PATTERN).collect()}
    assert back == {d[0]: d[1] or "" for d in documents}
    rows = {r.doc_id: r for r in bpe.round_trip(frame, path, P.PATTERN).collect()}
    for r in ids.collect():
        own = rows[r.doc_id]
        assert own.n_tokens == len(r.ids) and own.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256((back[r.doc_id]).encode()).hexdigest()
    assert bpe.encode(empty, path, P.PATTERN).collect() == [] and bpe.round_trip(empty, path, P.PATTERN).collect() == []


# common


def test_words_and_hashes_across_chunks(documents):
    docs = [(d[1] or "").encode() for d in documents]
    whole = [list(s) for s in text_module.shingle_sets(docs)]
    small = [s for _, w in text_module.chunks(docs, True, 200) for s in np.diff(w.first)]
    assert small == [len(WORD.findall(d[1] or "")) for d in documents]
    assert [len(s) for s in whole] == [len(shingles(d[1])) for d in documents]


def test_results_are_json_plain(frame):
    """Ids stay numbers."""
    assert json.dumps([r.doc_id for r in jaccard.near_duplicates(frame).limit(2).collect()])

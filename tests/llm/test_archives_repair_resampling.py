"""WARC bundles by exact round trips, conversation repair and importance resampling against brute force."""

import base64
import collections
import glob
import hashlib
import io
import math
import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from costlake.llm import repair, resampling, warc

# 11. WARC bundles

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages():
    """Payloads in one to 3,000 copies, repeated rows, nulls, an empty and a very long one."""
    rows = [(1, "u", "<p>a</p>"), (2, "u2", "<p>a</p>"), (2, "u2", "<p>a</p>"), (3, None, None), (None, "x", "<p>a</p>"), (5, "y", "x" * 3_000_000),
            (6, "a b\n", ""), (7, "q", "é" * 10), (8, "q", "line\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (None, None, None)]
    return rows + [(100 + i, f"v{i}", "same") for i in range(3000)]


@pytest.fixture(scope="module")
def archive(spark, pages):
    df = spark.createDataFrame(pages, PAGES).repartition(3).select("*", F.lit("k").alias("key"), F.lit(1).alias("payload"), F.lit(2).alias("n"))
    return warc.write(df, frame_bytes=4000, bundle_bytes=30_000)


def expected(pages, least=0):
    groups = collections.defaultdict(list)
    for page, url, html in pages:
        groups[html or ""].append((page, url))
    out = []
    for html, rows in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
        for k, (page, _) in enumerate(rows):
            again = k > 0 and len(data) >= least
            out.append((page, len(data), digest, "revisit" if again else "response", rows[0][0] if again else None))
    return collections.Counter(out)


def found(df):
    rows = df.where("record_type in ('response', 'revisit')").collect()
    return collections.Counter((r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in rows)


def test_warc_round_trip(spark, pages, archive):
    read = warc.read(spark, archive, payloads=True)
    assert found(read) == expected(pages)
    rows = read.collect()
    assert all(r.intact for r in rows)
    assert len({r.record_id for r in rows}) == len(rows)
    by_id = {r.record_id: r for r in rows}
    assert {r.payload for r in rows if r.record_type == "response"} == {p[2] or "" for p in pages}
    for r in rows:
        if r.record_type == "revisit":
            assert by_id[r.refers_to_record].payload_digest == r.payload_digest and by_id[r.refers_to_record].page_id == r.refers_to


def test_warc_small_payloads_are_no_revisits(spark, pages):
    df = spark.createDataFrame(pages, PAGES)
    assert found(warc.read(spark, warc.write(df, least=5))) == expected(pages, 5)


def test_warc_frames_and_seek_table(spark, archive):
    """Each record is found by its identifier alone, and other tools read the whole file."""
    rows = {r.record_id: r for r in warc.read(spark, archive, payloads=True).collect()}
    files, seen = glob.glob(f"{archive.removeprefix('file:')}/part-*"), 0
    assert len(files) > 3
    for path in files:
        with open(path, "rb") as f:
            bundle = warc.Bundle(f)
            assert max(size for size, _ in bundle.sizes[:-1]) < 30_000
            for name, (frame, offset, length) in bundle.index().items():
                headers, block = bundle.record(name) if seen % 50 == 0 else next(warc.records(bundle.frame(frame)[offset:offset + length]))[2:]
                assert (rows[name].frame, rows[name].offset, rows[name].length) == (frame, offset, length)
                assert headers["WARC-Record-ID"] == f"<urn:uuid:{name}>"
                assert block.partition(b"\r\n\r\n")[2].decode() == (rows[name].payload or "")
                seen += 1
        with open(path, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole == b"".join(warc.Bundle(open(path, "rb")).frame(k) for k in range(len(bundle.sizes)))
    assert seen == sum(r.record_type in ("response", "revisit") for r in rows.values())


def test_warc_empty_and_damaged(spark, pages, archive):
    assert warc.read(spark, warc.write(spark.createDataFrame([], PAGES))).count() == 0
    with open(glob.glob(f"{archive.removeprefix('file:')}/part-*")[0], "rb") as f:
        data = f.read()
    with pytest.raises(ValueError):
        warc.Bundle(io.BytesIO(data[:-1]))
    broken = bytearray(data)
    broken[warc.Bundle(io.BytesIO(data)).starts[1] + 30] ^= 1
    with pytest.raises(zstandard.ZstdError):
        warc.Bundle(io.BytesIO(bytes(broken))).frame(1)


# 12. conversation repair

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def turns():
    """Short conversations of all faults, a long one, one of equal rows, one of equal turns, null turns and ids."""
    rng, rows = random.Random(3), []

    def conversation(conv, n):
        for t in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "assistant", "user", None])
            text = rng.choice(["a.", "b!", "c", "", " ", "d?\n", f"x{rng.randint(0, 40)}.", f"y{rng.randint(0, 99)}", None, "é. "])
            rows.append((conv, None if rng.random() < .05 else t * 2 if rng.random() < .1 else t, role, text))

    for c in range(120):
        conversation(c, rng.choice([1, 2, 3, 5, 8, 13]))
    conversation(None, 9)
    conversation(1000, 600)
    rows += [(500, k, "user" if k % 2 == 0 else "assistant", "same row") for k in range(300)]
    rows += [(501, k, "user", f"r{k}.") for k in range(301)]
    rows += [(502, 7, "user", "twin.")] * 300
    rows += [(503, k, "user" if k % 2 == 0 else "assistant", f"fine {k}" + "." * 100_000) for k in range(4)]
    rows += [(504, 9_000_000_000_000_000_000, "user", "."), (504, -9_000_000_000_000_000_000, "user", "?")]
    return rows


def harmed(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out[conv] += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()))
    return out


def mended(rows):
    """Counts, cost, audit and digest by a forward search over all states, kept as whole strings."""

    def inserted(states):
        for q, to, role in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
            if q in states:
                cost, audit, out = states[q]
                if to not in states or (cost + 5, audit + "I") < states[to][:2]:
                    states[to] = cost + 5, audit + "I", [*out, (role, "")]
        return states

    states, seen, faults, illegal, before = {0: (0, "", [])}, set(), collections.Counter(), 0, None
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
        before, new = role[:1], {}

        def put(q, cost, audit, out, new=new):
            if q not in new or (cost, audit) < new[q][:2]:
                new[q] = cost, audit, out

        for q, (cost, audit, out) in inserted(states).items():
            put(q, cost + 2, audit + "D", out)
            if fault in (None, "truncated"):
                extra, to = cost + 5 * (fault == "truncated"), 3 if q == 2 else 2
                if (q, before) == (0, "s"):
                    put(1, extra, audit + "K", [*out, (role, text)])
                if before == {2: "u", 3: "a"}[to]:
                    put(to, extra, audit + "K", [*out, (role, text)])
                put(to, extra + 1, audit + "R", [*out, ("user" if to == 2 else "assistant", text)])
        states = new
    states = inserted(states)
    cost, audit, out = min(states[q] for q in (0, 3) if q in states)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


@pytest.mark.parametrize("chunks", [1, 5, 40])
def test_repair_against_search(spark, turns, chunks):
    df = spark.createDataFrame(turns, TURNS).repartition(4).select("*", F.lit(1).alias("conv"), F.lit("x").alias("at"), F.lit("y").alias("part"))
    after = harmed(turns)
    want = {}
    for conv in {r[0] for r in turns}:
        known = {r[0] for r in after[conv]} - {None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        want[conv] = (gaps if gaps < 2 ** 63 else 0, *mended(after[conv]))
    got = {r.conv_id: tuple(r)[1:] for r in repair.report(df, repair.damaged(df), chunks=chunks).collect()}
    assert got == want


def test_repair_passes(spark):
    """One pass suffices where vectors converge; where they don't, more of them still give the exact result."""
    talk = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k}.") for k in range(400)]
    converging = repair.Repair(spark.createDataFrame(talk, TURNS).withColumnRenamed("conv_id", "conv"), chunks=20)
    assert converging.passes <= 2
    # a user's turns only: every second one may be reroled or a reply be inserted, so the vector keeps its phase
    monologue = [(1, k, "user", f"turn {k}.") for k in range(401)]
    stubborn = repair.Repair(spark.createDataFrame(monologue, TURNS).withColumnRenamed("conv_id", "conv"), chunks=20)
    row = stubborn.summary().first()
    want = mended([(r[1], r[2], r[3]) for r in monologue])
    assert (row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit) == want[:-1]


def test_repair_moves_are_least(spark):
    """Every state's moves of one step from vectors at random, against all edits up to two insertions."""
    rng = random.Random(1)
    for _ in range(500):
        after = [rng.randint(0, 12) for _ in range(4)]
        for _ in range(4):  # closed under insertions, as all vectors of a pass are
            after = [min(after[q], 5 + after[repair.NEXT[q]]) for q in range(4)]
        initial, fault = rng.choice("suax"), rng.choice([None, "blank", "duplicate", "truncated"])
        vector, moves = repair.step(repair._plain(after), initial, fault)
        found = []
        for q in range(4):
            every, at, edits, cost = [], q, "", 0
            for _ in range(3):
                every.append((cost + 2 + after[at], edits + "D", at))
                if fault in (None, "truncated"):
                    extra = cost + 5 * (fault == "truncated")
                    keep = 1 if (initial, at) == ("s", 0) else repair.NEXT[at] if initial == {2: "u", 3: "a"}[repair.NEXT[at]] else None
                    if keep is not None:
                        every.append((extra + after[keep], edits + "K", keep))
                    every.append((extra + 1 + after[repair.NEXT[at]], edits + "R", repair.NEXT[at]))
                at, edits, cost = repair.NEXT[at], edits + "I", cost + 5
            found.append(min(every))
        assert [m for m in moves] == [f[1:] for f in found]
        assert vector == repair._plain([f[0] for f in found])


def test_repair_empty(spark):
    df = spark.createDataFrame([], TURNS)
    assert repair.report(df, repair.damaged(df)).collect() == []


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "one."), (1, 1, "user", "two."), (1, 2, "system", "late."), (1, 3, "assistant", "end."), (2, 0, "system", "alone.")]
    made = repair.Repair(spark.createDataFrame(rows, TURNS).withColumnRenamed("conv_id", "conv")).repaired().orderBy("conv", "at", "n").collect()
    assert [(r.conv, r.role, r.text) for r in made] == [(1, "user", "one."), (1, "assistant", "two."), (1, "user", "late."), (1, "assistant", "end.")]


# 13. importance resampling

DOCS = "doc_id long, text string"


def grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), words + [" ".join(p) for p in zip(words, words[1:], strict=False)]


def drawn(docs, target, percent, least, buckets=10000):
    own = [(d, *grams(t)) for d, t in docs]
    code = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(code(f) for _, _, fs in own for f in fs)
    t = collections.Counter(code(f) for x in target for f in grams(x)[1])
    every, want = [], collections.Counter()
    for k, (doc, n, fs) in enumerate(own):
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in map(code, fs)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        every.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least, k])
    may = sorted((e for e in every if e[4]), key=lambda e: (-e[3], e[0] is None, e[0] or 0))
    ranks = {e[5]: r for r, e in enumerate(may[:percent * len(may) // 100], 1)}
    for e in every:
        want[(*e[:4], ranks.get(e[5]))] += 1
    return want


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéŁß9") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    docs = [(i, rng.choice(["", "*** "]) + rng.choice([" ", "-- ", "\n", "_", "'"]).join(rng.choice(words).title() for _ in range(rng.choice([0, 3, 19, 20, 21, 60]))))
            for i in range(150)]
    docs += [(900, None), (901, ""), (902, " -- \x00 "), (903, "word " * 200_000), (None, "alpha beta " * 15)] + [(905, "equal rows " * 12)] * 40
    return docs, [" ".join(rng.choice(words[:60]) for _ in range(30)) for _ in range(20)] + [None]


@pytest.mark.parametrize(("percent", "least"), [(25, 20), (100, 0), (0, 5)])
def test_resampling(spark, corpus, percent, least):
    docs, target = corpus
    df = spark.createDataFrame(docs, DOCS).repartition(3).select("*", F.lit(3).alias("id"), F.lit(1).alias("rank"), F.lit(0).alias("range"))
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = collections.Counter(tuple(r) for r in resampling.resampled(df, bench, percent, least).collect())
    assert got == drawn(docs, target, percent, least)


def test_resampling_favours_the_target(spark, corpus):
    docs, target = corpus
    rows = [(i, t) for i, t in enumerate(target)] + [(1000 + i, t) for i, (_, t) in enumerate(docs)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    chosen = resampling.selected(spark.createDataFrame(rows, DOCS), bench, percent=20, least_words=20)
    ids = {r.doc_id for r in chosen.collect()}
    # a fifth of all is drawn; without regard to the target that would be 4 of its 20
    assert len(ids & set(range(20))) > 10 and chosen.columns == ["doc_id", "text"]


def test_resampling_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(spark.createDataFrame([], DOCS), bench).collect() == []
    row = resampling.resampled(spark.createDataFrame([(1, "a b " * 20)], DOCS), bench, 100).first()
    assert row.n_features == 79 and row["rank"] == 1

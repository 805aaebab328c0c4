"""Conversation structure repair: a rank-convergence parallel Viterbi over edits, with least-audit tracing.

A conversation's rows, in order, are kept (0), reroled to user or assistant (1), or deleted (2); rows with an empty text
may be inserted anywhere (5); a truncated row that isn't deleted adds 5. The roles' initials must then read
``(s?(ua)+)?``. Four states say what has been read (nothing, s, u, a), so the least cost of the rest of a conversation is
a vector of four costs, and a row maps the vector behind it to the one before it.

Chunks of a conversation start from speculative vectors at the same time. Such a map forgets what it starts from: after a
few rows the vectors of different starts differ only by a constant, and costs that differ by a constant lead to the same
decisions. Fix-up passes rerun the chunks whose true end vector, the start vector of the next chunk, differs by more
than a constant from the one they started from, beside the old run and only until both are parallel; the passes end
when nothing changes, so the result is exact whether the vectors converge or not. A last backward pass with the true
vectors stitches the costs: for each row and state it writes the edits that lie on a cheapest path, the least initial
(D, I, K, R) first. For a state there is one such path, so its trace has the least audit string; a forward pass follows it.

Faults, the first that holds: blank (nothing but space and 0x09-0x0D), duplicate (role and text seen earlier in the
conversation), truncated (last character other than those not one of ``.!?``). Blank and duplicate rows must go.

Order: by turn, nulls first; ties by SHA-256 of role and text, so equal rows are adjacent. A null role or text is one
space. Rows with a null conversation id form one conversation. An initial is a role's first character; an empty role
has an empty one, and other initials than s, u, a can't be kept. An empty table gives no rows. Texts of any length are
moved, but not looked at, by the passes. Extra columns, also of clashing names, are not read.

At scale: rows are dealt out by ranges of (conversation, turn, hash, salt), so a conversation with a third of all rows, or a
row repeated so often, lies in many partitions; its piece in a partition is a chunk. Passes read thin columns and hold
one vector. The driver gets a few numbers for each partition, never for each row or conversation. Equal rows are found by an
aggregate that begins in the map tasks and joined by row number, which has no hot key. Only the digest of a
repaired conversation is sequential by nature: one task reads its rows in order, streaming.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map, partitions, stored

BLANKS = " \t\n\x0b\f\r"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A user's turn is next unless a user was last.
NEXT = (2, 2, 3, 2)
#: Least costs behind the last row: what is missing until an assistant's turn.
TERMINAL = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "ua", "a", "")
SPECULATIVE = (0, 0, 0, 0)
LEGAL = ("su", "ua", "au")
Vector = tuple[int, int, int, int]


def _kept(state: int, initial: str) -> int | None:
    """The state after a kept row, if it may stand there."""
    if initial == "s" and state == 0:
        return 1
    return NEXT[state] if initial == "ua"[NEXT[state] - 2] else None


@lru_cache(maxsize=100_000)
def step(after: Vector, initial: str, fault: str) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Costs before a row, less their minimum, and for each state the edits up to the row's own and the state behind.

    Only s, u and a matter as initials, and there are few vectors that differ by more than a constant, so a pass is little
    more than a look-up for each row.
    """
    extra = TRUNCATED if fault == "truncated" else 0

    def own(state: int) -> Iterator[tuple[int, str, int]]:
        yield DELETE + after[state], "D", state
        if fault not in ("blank", "duplicate"):
            kept = _kept(state, initial)
            if kept is not None:
                yield extra + after[kept], "K", kept
            yield REROLE + extra + after[NEXT[state]], "R", NEXT[state]

    plain = [min(own(q))[0] for q in range(4)]
    cost = [min(plain[q], INSERT + plain[NEXT[q]], 2 * INSERT + plain[NEXT[NEXT[q]]]) for q in range(4)]
    moves = []
    for q in range(4):
        edits, at = "", q
        while True:
            best = [(e, to) for c, e, to in own(at) if c == cost[at]]
            if INSERT + cost[NEXT[at]] == cost[at]:
                best.append(("I", NEXT[at]))
            edit, at = min(best)
            edits += edit
            if edit != "I":
                break
        moves.append((edits, at))
    return _plain(cost), tuple(moves)


def _plain(cost) -> Vector:
    """The vector without its constant."""
    least = min(cost)
    return tuple(c - least for c in cost)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _starts(old: dict[int, Vector], new: dict[int, Vector]):
    """The start vector of each chunk; with an old end vector, none if both runs become parallel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, one, two, done, parts, vectors = None, None, None, True, [], []

        def end() -> None:
            if at is not None and not done:
                parts.append(at)
                vectors.append(list(two))

        for part, initial, fault in _batches(batches):
            if part != at:
                end()
                at, one, two, done = part, old.get(part), new[part], False
            if done:
                continue
            two = step(two, initial, fault)[0]
            if one is not None:
                one = step(one, initial, fault)[0]
                done = one == two
        end()
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(vectors, pa.list_(pa.int64()))], names=["part", "start"])

    return run


def _backward(ends: dict[int, Vector], first: dict[int, object]):
    """Each row's moves; with the state map of the whole piece at the first row of a part's first and last piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []  # the row read last is held back: only the next one tells whether its piece began there
        part, conv, vector, exits, piece, schema = None, None, None, (0, 1, 2, 3), 0, None

        def began() -> None:
            if kept and (piece == 0 or conv == first[part]):
                kept[-1][-1] = "".join(map(str, exits))

        def out(done: list) -> pa.RecordBatch:
            kinds = [*schema.types, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                                              names=[*schema.names, "moves", "exits"])

        for batch in batches:
            schema = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[1] != part or row[0] != conv:
                    began()
                    if row[1] != part:
                        part, vector, piece = row[1], ends.get(row[1], TERMINAL), 0
                    else:
                        vector, piece = TERMINAL, piece + 1
                    conv, exits = row[0], (0, 1, 2, 3)
                vector, moves = step(vector, row[3], row[4])
                exits = tuple(exits[to] for _, to in moves)
                kept.append([*row, " ".join(f"{e}{to}" for e, to in moves), None])
            if len(kept) > 1:
                yield out(kept[:-1])
                del kept[:-1]
        began()
        if kept:
            yield out(kept)

    return run


def _forward(entry: dict[int, int], before: dict[int, str], goes_on: set[int], last: dict[int, object]):
    """What becomes of each row, and at a piece's last row its audit, faults, illegal pairs and cost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, kept = None, []  # the last row is held back: only the next one tells whether its piece ends
        part, conv, state, initial, piece = None, None, 0, None, None

        def close() -> None:
            if piece is None:
                return
            if not (part in goes_on and conv == last[part]):
                tail = TAIL[state]
                kept[-1][2] += tail
                piece["audit"].append("I" * len(tail))
                piece["cost"] += INSERT * len(tail)
            kept[-1][3] = {**piece, "audit": "".join(piece["audit"])}

        def out(done: list) -> pa.RecordBatch:
            ids, at, new, pieces = zip(*done, strict=True)
            columns = [pa.array(ids, kind), pa.array(at, pa.int64()), pa.array(new, pa.string())]
            names = ["audit", "blank", "duplicate", "truncated", "illegal", "cost"]
            for name in names:
                columns.append(pa.array([p and p[name] for p in pieces], pa.string() if name == "audit" else pa.int64()))
            return pa.RecordBatch.from_arrays([*columns, pa.array([p is not None for p in pieces])], names=["conv", "at", "new", *names, "ends"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, p, at, own, fault, moves in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if p != part or c != conv:
                    close()
                    fresh = p != part and p in entry
                    part, conv, state, initial = p, c, entry[p] if fresh else 0, before.get(p) if fresh else None
                    piece = {"audit": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
                if fault is not None:
                    piece[fault] += 1
                if initial is not None and initial + own not in LEGAL:
                    piece["illegal"] += 1
                initial = own
                move = moves.split(" ")[state]
                edits, new = move[:-1], ""
                for e in edits:
                    if e == "D":
                        piece["cost"] += DELETE
                        continue
                    role = "ua"[NEXT[state] - 2]
                    if e == "I":
                        new, state = new + role, NEXT[state]
                        piece["cost"] += INSERT
                    else:
                        new += "K" if e == "K" else role.upper()
                        piece["cost"] += (REROLE if e == "R" else 0) + (TRUNCATED if fault == "truncated" else 0)
                state = int(move[-1])
                piece["audit"].append(edits)
                kept.append([c, at, new, None])
            if len(kept) > 1:
                yield out(kept[:-1])
                del kept[:-1]
        close()
        if kept:
            yield out(kept)

    return run


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text of rows that are damaged by CRC-32 of ``conv:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets the role user; nulls are one space.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    conv_text, turn_text = (F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn))
    code = F.crc32(F.concat(conv_text, F.lit(":"), turn_text).cast("binary")) % 20
    out = rows.select(
        conv.alias("conv"), turn.cast("long").alias("turn"), F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("times"))
    return out.where("times > 0").select("conv", "turn", "role", "text", F.explode(F.expr("sequence(1, times)")).alias("copy")).drop("copy")


class Repair:
    """The least-audit repair of conversations; rows: conv, turn, role, text."""

    def __init__(self, rows: DataFrame, chunks: int | None = None) -> None:
        """``chunks``: ranges that the rows are dealt out to, by default the session's shuffle partitions."""
        self.chunks = chunks or partitions(rows)
        role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
        plain = rows.select("conv", F.col("turn").cast("long").alias("turn"), role, text)
        key = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
        plain = plain.withColumn("key", key).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
        order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("key"), F.asc("salt")]
        ranged = plain.repartitionByRange(self.chunks, *order).sortWithinPartitions(*order).drop("salt")
        #: All rows with their number ``at``, which grows along all conversations; its upper bits are the range.
        self.rows = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")
        self.passes = 0
        self._trace()

    def _trace(self) -> None:
        end = F.rtrim("text", F.lit(BLANKS))
        thin = self.rows.select("conv", "at", "key", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
                                (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
        firsts = thin.where("not blank").groupBy("conv", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
        fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated")
        part = F.shiftright("at", 33).alias("part")
        thin = stored(thin.join(firsts, "at", "left").select("conv", part, "at", "initial", fault.alias("fault")), "faults")
        # a row for each range
        bounds = thin.groupBy("part").agg(
            F.min(F.struct("at", "conv")).alias("low"), F.max(F.struct("at", "conv", "initial")).alias("high"),
            F.count_if(F.col("fault").isNull() | (F.col("fault") == "truncated")).alias("live")).orderBy("part").collect()
        first = {b.part: b.low.conv for b in bounds}
        last = {b.part: b.high.conv for b in bounds}
        behind = {a.part: b.part for a, b in zip(bounds, bounds[1:], strict=False) if a.high.conv == b.low.conv}
        ends = self._converged(thin, first, last, behind, {b.part for b in bounds if not b.live})

        down = thin.repartition(self.chunks, "part").sortWithinPartitions("part", F.desc("at"))
        kind = thin.schema["conv"].dataType.simpleString()
        moves = stored(arrow_map(down, _backward(ends, first),
                                 f"conv {kind}, part long, at long, initial string, fault string, moves string, exits string"), "moves")
        # two rows for each range at most: the maps of its first and of its last piece
        maps: dict[int, list[str]] = {}
        for r in moves.where("exits is not null").orderBy("at").select("part", "exits").collect():
            maps.setdefault(r.part, []).append(r.exits)
        entry: dict[int, int] = {}
        for a, b in sorted(behind.items()):
            whole = first[a] == last[a]
            entry[b] = int(maps[a][-1][entry.get(a, 0) if whole else 0])
        before = {behind[b.part]: b.high.initial for b in bounds if b.part in behind}
        up = moves.select("conv", "part", "at", "initial", "fault", "moves").repartition(self.chunks, "part").sortWithinPartitions("part", "at")
        #: Of each row what becomes of it (K: kept, U, A: reroled; u, a: inserted), and sums at the last row of a piece.
        self.edits = stored(arrow_map(up, _forward(entry, before, set(behind), last),
                                      f"conv {kind}, at long, new string, audit string, blank long, duplicate long, truncated long, "
                                      "illegal long, cost long, ends boolean"), "edits")

    def _converged(self, thin: DataFrame, first: dict, last: dict, behind: dict[int, int], dead: set[int]) -> dict[int, Vector]:
        """The true end vector of each range whose last conversation goes on in the next.

        ``dead``: ranges of which all rows must go; these only add a constant, so vectors pass them unchanged.
        """
        if not behind:
            return {}
        # chunks whose start another one waits for; those that are part of one conversation alone wait themselves
        wanted = set(behind.values())
        waiting = {p for p in wanted if first[p] == last[p] and p in behind}
        used = {p: SPECULATIVE if p in waiting else TERMINAL for p in wanted}
        start = self._run(thin, {p: first[p] for p in wanted}, {}, used)
        while True:
            for p in sorted(waiting & dead, reverse=True):
                used[p] = start[p] = start[behind[p]]
            stale = {p: start[behind[p]] for p in waiting - dead if start[behind[p]] != used[p]}
            if not stale:
                return {p: start[q] for p, q in behind.items()}
            start |= self._run(thin, {p: first[p] for p in stale}, used, stale)
            used |= stale

    def _run(self, thin: DataFrame, convs: dict, old: dict[int, Vector], new: dict[int, Vector]) -> dict[int, Vector]:
        """One pass over the first piece of each given range: start vectors that are new."""
        self.passes += 1
        spark = thin.sparkSession
        kind = thin.schema["conv"].dataType.simpleString()
        which = F.broadcast(spark.createDataFrame(list(convs.items()), f"part long, own {kind}"))
        rows = thin.join(which, "part").where(F.col("conv").eqNullSafe(F.col("own")))
        rows = rows.repartition(self.chunks, "part").sortWithinPartitions("part", F.desc("at")).select("part", "initial", "fault")
        found = arrow_map(rows, _starts({p: old[p] for p in new if p in old}, new), "part long, start array<long>").collect()
        return {r.part: tuple(r.start) for r in found}

    def repaired(self) -> DataFrame:
        """The rows of the repaired conversations: conv, at, n (order by both), role, text."""
        code = F.col("code")
        inserted, reroled = code.isin("u", "a"), code.isin("U", "A")
        rows = self.rows.select("at", "role", "text").join(self.edits.where("new <> ''").select("conv", "at", "new"), "at")
        rows = rows.select("conv", "at", "role", "text", F.posexplode(F.expr("filter(split(new, ''), x -> x <> '')")).alias("n", "code"))
        role = F.when(inserted | reroled, F.when(F.lower(code) == "u", "user").otherwise("assistant")).otherwise(F.col("role"))
        return rows.select("conv", "at", "n", role.alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"))

    def summary(self) -> DataFrame:
        """A row for each conversation with rows: conv, gaps, faults, illegal, cost, audit."""
        sums = self.edits.where("ends").groupBy("conv").agg(
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
            F.expr("array_join(transform(array_sort(collect_list(struct(at, audit))), x -> x.audit), '')").alias("audit"))
        gaps = self.rows.groupBy("conv").agg(F.expr(
            "coalesce(try_cast(cast(max(turn) as decimal(20)) - min(turn) + 1 - count(distinct turn) as bigint), 0L)").alias("gaps"))
        return merged(sums, gaps)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, sha, kind = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], kind), pa.array([sha.hexdigest()])], names=["conv", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sha is None or conv != at:
                if sha is not None:
                    yield out()
                at, sha = conv, hashlib.sha256()
                sha.update(f"{role}:{text}".encode())
            else:
                sha.update(f"\n{role}:{text}".encode())
    if sha is not None:
        yield out()


def merged(*frames: DataFrame) -> DataFrame:
    """The columns of all frames by conv, null ids included; each has a row for a conversation at most."""
    names = list(dict.fromkeys(c for f in frames for c in f.columns if c != "conv"))
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f, allowMissingColumns=True)
    return every.groupBy("conv").agg(*[F.max(c).alias(c) for c in names])


def report(original: DataFrame, rows: DataFrame, conv_col: str = "conv_id", chunks: int | None = None) -> DataFrame:
    """A row for each conversation of ``original``: gaps, faults, illegal pairs, cost and audit of repairing ``rows``, digest."""
    repair = Repair(rows, chunks)
    ordered = repair.repaired().repartition(partitions(rows), "conv").sortWithinPartitions("conv", "at", "n").select("conv", "role", "text")
    kind = ordered.schema["conv"].dataType.simpleString()
    digests = arrow_map(ordered, _digest, f"conv {kind}, repaired_sha256 string")
    ids = original.select(F.col(f"`{conv_col}`").alias("conv")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return merged(ids, repair.summary(), digests).select(
        F.col("conv").alias(conv_col), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

"""Repair of the structure of conversations: cheapest edits by auction.

The role initials of a repaired conversation are an optional system turn and
then pairs of user and assistant.  A conversation is a lattice: a layer for
every place between its turns, and in each layer four states (nothing yet,
after system, after user, after assistant).  Keeping, changing and deleting a
turn lead to the next layer, inserting one stays in the layer; costs are whole
numbers.

Shortest paths come from the auction algorithm.  Nodes have prices; a path
starts at an origin and is extended along the arc that attains the least of
cost plus price, or, where that least is above the price of its last node, the
price is raised to it and the path is contracted by that node.  Origins are
taken from the last layer to the first, and a path ends where it meets a node
whose price is final.  Final prices are the costs to the end, so the arcs of
all cheapest repairs are tight, and the least letters in ASCII order along
tight arcs spell the repair.

Turns are ordered by a range-partitioned sort and read as runs.  A conversation
that lies within one run is solved there.  One that spans several (a hot key,
or at a border) has its runs cut into segments: each gives the costs from the
states of its first layer to those of its last, prices pass back over segments
alone, and then every segment is traced for itself.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.scale import cut_lineage
from tabulon.llm.common import stored

#: Costs of edits; an undeleted truncated turn adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Most turns of a segment.
SEGMENT = 1024
#: Blanks between words, fixed.
BLANKS = " \t\n\x0b\x0c\r"
FAR = 1 << 60
#: States: nothing yet, after system, after user, after assistant.
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_WANTED = (2, 2, 3, 2)  # where a user or assistant turn leads
_ROLE = {2: "user", 3: "assistant"}
_INITIALS = "sua"


def _arcs(code: int) -> list[list[tuple[str, int, int]]]:
    """For each state the arcs (letter, cost, state) over a turn: its code is 0-2
    for the initials s, u and a and 3 for any other, 4 more if it must go and 8
    more if it is truncated.  Letters stand in ASCII order."""
    extra = TRUNCATED if code & 8 else 0
    out = []
    for q in range(4):
        arcs = [("D", DELETE, q)]
        if not code & 4:
            if code & 3 < 3 and q in _NEXT[_INITIALS[code & 3]]:
                arcs.append(("K", extra, _NEXT[_INITIALS[code & 3]][q]))
            arcs.append(("R", REROLE + extra, _WANTED[q]))
        out.append(arcs)
    return out


_ARCS = [_arcs(c) for c in range(16)]


def auction(codes: bytes, after: tuple[int, ...], insert_last: bool) -> list[int]:
    """Prices of all nodes (four a layer): the least cost to the end, where
    ``after`` has the costs from the states of the last layer.  Inserted turns
    in the last layer are allowed if ``insert_last``."""
    n = len(codes)
    price = [0] * (4 * n + 4) if insert_last or max(after) < FAR else _start(codes, after)
    final = [False] * (4 * n + 4)
    for origin in range(4 * n + 3, -1, -1):
        if origin % 4 == 3 and origin < 4 * n:
            # a layer starts at the least price of the next: still no price is above an arc's cost plus price
            base = min(price[origin + 1:origin + 5])
            price[origin - 3:origin + 1] = [max(p, base) for p in price[origin - 3:origin + 1]]
        path = [origin]
        while path and not final[path[-1]]:
            node = path[-1]
            layer, q = divmod(node, 4)
            if layer < n:
                least, best = price[4 * layer + _WANTED[q]] + INSERT, 4 * layer + _WANTED[q]
                for _, cost, to in _ARCS[codes[layer]][q]:
                    there = 4 * layer + 4 + to
                    if price[there] + cost < least:
                        least, best = price[there] + cost, there
            else:
                least, best = after[q], -1
                if insert_last and price[4 * n + _WANTED[q]] + INSERT < least:
                    least, best = price[4 * n + _WANTED[q]] + INSERT, 4 * n + _WANTED[q]
            least = min(least, FAR)
            if price[node] < least:  # contract
                price[node] = least
                if len(path) > 1:
                    path.pop()
            elif best < 0 or least == FAR:  # the end, or none can be reached
                break
            else:  # extend
                path.append(best)
        for node in path:  # complementary slackness holds and the path's arcs are tight
            final[node] = True
    return price


def _start(codes: bytes, after: tuple[int, ...]) -> list[int]:
    """Starting prices: ``FAR`` where the end cannot be reached, else nothing.
    Without these, prices of nodes that only lead to each other rise forever."""
    ways = [0 if a < FAR else FAR for a in after]
    layers = [ways]
    for code in reversed(codes):
        ways = [min(ways[to] for _, _, to in arcs) for arcs in _ARCS[code]]
        ways = [min(w, ways[_WANTED[q]], ways[_WANTED[_WANTED[q]]]) for q, w in enumerate(ways)]
        layers.append(ways)
    return [p for ways in reversed(layers) for p in ways]


def trace(codes: bytes, after: tuple[int, ...], insert_last: bool, price: list[int], q: int) -> tuple[str, int]:
    """Least letters along tight arcs from state ``q`` of the first layer, and
    the state at the end."""
    letters, layer, n = [], 0, len(codes)
    while True:
        here = price[4 * layer + q]
        at_end = layer == n
        if at_end and here == after[q] or here >= FAR:
            return "".join(letters), q
        arcs = [] if at_end else [(c, cost + price[4 * layer + 4 + to], layer + 1, to) for c, cost, to in _ARCS[codes[layer]][q]]
        if insert_last or not at_end:
            arcs.append(("I", INSERT + price[4 * layer + _WANTED[q]], layer, _WANTED[q]))
        letter, _, layer, q = min(a for a in arcs if a[1] == here)
        letters.append(letter)


_END = (0, FAR, FAR, 0)


@lru_cache(maxsize=50_000)
def solve(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of a whole conversation."""
    price = auction(codes, _END, True)
    return price[0], trace(codes, _END, True, price, 0)[0]


def borders(codes: bytes) -> list[int]:
    """Least costs from each state of the first layer to each of the last,
    without inserted turns in the last, row by row."""
    columns = [auction(codes, tuple(0 if q == to else FAR for q in range(4)), False)[:4] for to in range(4)]
    return [columns[to][q] for q in range(4) for to in range(4)]


_STATS = "n long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
_SOLVED = "blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"


def faults(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns without their texts, equal ones of a conversation and turn once
    with their number ``copies``: ``conv``, ``turn``, ``role``, ``digest``
    (SHA-256 of the text), ``blank``, ``cut`` (truncated) and ``seen`` (role and
    text stand earlier)."""
    words = F.expr(f"rtrim('{BLANKS}', text)")
    slim = _named(turns, conv, turn, role, text).select(
        "conv", "turn", "role", _digest(F.col("text")).alias("digest"), (words == "").alias("blank"),
        (~F.right(words, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # the first turn of each text; the mark travels to its row by the row's own key, so no key is hot
    mark = slim.groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("_m"))
    mark = mark.select("conv", F.col("_m.turn").alias("turn"), "role", "digest", F.lit(None).cast("boolean").alias("blank"),
                       F.lit(None).cast("boolean").alias("cut"), F.lit(0).cast("long").alias("copies"), F.lit(True).alias("mark"))
    rows = slim.withColumns({"copies": F.lit(1).cast("long"), "mark": F.lit(False)})
    return rows.unionByName(mark).groupBy("conv", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut"), (~F.max("mark")).alias("seen"))


def _named(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _order(*first: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (*first, "turn", "role", "digest")]


class _Run:
    """Codes and counts of consecutive turns of a conversation."""

    def __init__(self, conv, slot: int):
        self.conv, self.slot, self.codes = conv, slot, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, initial: str, turn, blank: bool, cut: bool, seen: bool) -> None:
        kind = _INITIALS.find(initial) if initial else 3
        code = kind if kind >= 0 else 3
        if blank or seen:
            self.blank += blank
            self.duplicate += not blank
            code += 4
        elif cut:
            self.truncated += 1
            code += 8
        self.codes.append(code)
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1

    def append(self, s: dict) -> None:
        """The counts of the run that follows."""
        self.blank += s["blank"]
        self.duplicate += s["duplicate"]
        self.truncated += s["truncated"]
        self.illegal += s["illegal"]
        if self.last is None:
            self.first = s["first"]
        else:
            self.illegal += self.last + s["first"] not in ("su", "ua", "au")
        self.last = s["last"]
        if s["low"] is not None:
            self.turns += s["turns"] - (self.high == s["low"])
            self.low, self.high = s["low"] if self.low is None else self.low, s["high"]

    def counts(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.blank, self.duplicate, self.truncated, self.illegal, gaps

    def stats(self) -> tuple:
        return (len(self.codes), self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.low, self.high, self.turns)


def _dict(values: tuple, fields: str) -> dict:
    return dict(zip([f.split()[0] for f in fields.split(", ")], values, strict=True))


def _struct(fields: str) -> str:
    return fields.replace(" ", ": ").replace(",: ", ", ")


def solved(found: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation of :func:`faults`: ``conv``, the numbers
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` and ``gaps``, and the
    ``cost`` and letters (``audit``) of its repair."""
    conv = found.schema["conv"]
    placed = cut_lineage(found.withColumn("initial", F.substring("role", 1, 1)).sort(*_order("conv")).select(
        "conv", "turn", "initial", "blank", "cut", "seen", "copies", F.monotonically_increasing_id().alias("slot")))
    schema = T.StructType([conv, *T._parse_datatype_string(
        f"whole struct<{_struct(_SOLVED)}>, slot long, codes binary, costs array<long>, stats struct<{_struct(_STATS)}>").fields])

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        rows, run, number = [], None, -1
        partial = True  # the first run may go on from the partition before

        def close(whole: bool) -> None:
            codes = bytes(run.codes)
            if whole:
                rows.append((run.conv, _dict((*run.counts(), *solve(codes)), _SOLVED), None, None, None, None))
            else:
                rows.append((run.conv, None, run.slot, codes, borders(codes), _dict(run.stats(), _STATS)))

        def out():
            block = pa.Table.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in rows], schema=arrow)
            rows.clear()
            return block.combine_chunks().to_batches()

        for batch in batches:
            for conv, turn, initial, blank, cut, seen, copies, slot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number < 0:
                    number = slot >> 33 << 33  # the partition: runs are numbered in order
                for k in range(copies):
                    if run is None or run.conv != conv or len(run.codes) == segment:
                        if run is not None:
                            cut_here = run.conv == conv
                            close(not partial and not cut_here)
                            partial = cut_here
                        run, number = _Run(conv, number), number + 1
                    run.add(initial, turn, blank, cut, seen or k > 0)
                    if len(rows) >= 2000:
                        yield from out()
        if run is not None:
            close(False)  # it may go on in the next partition
            yield from out()

    runs = stored(placed.mapInArrow(read, schema), "runs")
    whole = runs.where(F.col("whole").isNotNull()).select("conv", "whole.*")
    return whole.unionByName(_spanning(runs.where(F.col("whole").isNull()).drop("whole"), conv))


def _spanning(segments: DataFrame, conv: T.StructField) -> DataFrame:
    """Solved conversations that span several segments.

    What meets by conversation are the costs of its segments and then their
    letters, a byte for each turn: no more than the result, one string."""
    slim = segments.select(F.col("conv").alias("conv"), F.col("slot").alias("slot"), "costs")
    priced = slim.groupBy("conv").applyInArrow(_pass_back, "slot long, after array<long>, cost long")

    traced_schema = T.StructType([conv, *T._parse_datatype_string(
        f"slot long, cost long, letters array<string>, ends array<int>, stats struct<{_struct(_STATS)}>").fields])

    def trace_all(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(traced_schema)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                after = tuple(r["after"])
                price = auction(r["codes"], after, False)
                ways = [trace(r["codes"], after, False, price, q) for q in range(4)]
                rows.append({"conv": r["conv"], "slot": r["slot"], "cost": r["cost"], "letters": [w for w, _ in ways],
                             "ends": [q for _, q in ways], "stats": r["stats"]})
            yield from pa.Table.from_pylist(rows, schema=arrow).combine_chunks().to_batches()

    traced = segments.join(priced, "slot").select("conv", "codes", "slot", "after", "cost", "stats").mapInArrow(trace_all, traced_schema)
    return traced.groupBy("conv").applyInArrow(_put_together, T.StructType([conv, *T._parse_datatype_string(_SOLVED).fields]))


def _pass_back(segments: pa.Table) -> pa.Table:
    """For each segment the costs to the end from the states of its last layer."""
    slots = segments["slot"].to_numpy()
    costs = np.array(segments["costs"].to_pylist(), np.int64).reshape(-1, 4, 4)
    after, out = np.array(auction(b"", _END, True), np.int64), [None] * len(slots)
    order = np.argsort(slots)
    for i in order[::-1].tolist():
        out[i] = after.tolist()
        after = np.minimum((costs[i] + after).min(axis=1), FAR)
    return pa.table({"slot": segments["slot"], "after": pa.array(out, pa.list_(pa.int64())),
                     "cost": pa.array(np.full(len(slots), after[0]))})


def _put_together(segments: pa.Table) -> pa.Table:
    """A conversation from its traced segments."""
    rows = sorted(segments.to_pylist(), key=lambda r: r["slot"])
    whole, letters, q = _Run(rows[0]["conv"], 0), [], 0
    for r in rows:
        letters.append(r["letters"][q])
        q = r["ends"][q]
        whole.append(r["stats"])
    letters.append(trace(b"", _END, True, auction(b"", _END, True), q)[0])
    values = (*whole.counts(), rows[0]["cost"], "".join(letters))
    return pa.table({"conv": segments["conv"].slice(0, 1), **{
        n: pa.array([v], pa.string() if n == "audit" else pa.int64()) for n, v in _dict(values, _SOLVED).items()}})


def repaired(turns: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """Turns after repair, in order within partitions that hold whole
    conversations: ``conv``, ``edit`` (a letter of the audit), ``role``,
    ``text``; deleted turns are there as they were.  ``found`` is what
    :func:`solved` gives for the same turns.

    Texts pass through as a stream, so a long conversation needs no memory."""
    base = _named(turns, conv, turn, role, text).withColumn("digest", _digest(F.col("text")))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"))]
    heads = found.select("conv", F.lit(0).alias("kind"), *empty, F.col("audit").alias("text"))
    rows = heads.unionByName(base.withColumn("kind", F.lit(1))).repartition("conv")
    rows = rows.sortWithinPartitions(*_order("conv", "kind")).select("conv", "kind", "role", "text")
    schema = T.StructType([found.schema["conv"], *T._parse_datatype_string("edit string, role string, text string").fields])

    def walk(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        conv, audit, at, state, out = None, "", 0, 0, []

        def inserted():
            nonlocal at, state
            while audit[at:at + 1] == "I":
                at, state = at + 1, _WANTED[state]
                out.append((conv, "I", _ROLE[state], ""))

        def emit():
            columns = zip(*out, strict=True)
            block = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
            out.clear()
            return block

        for batch in batches:
            for key, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    inserted()
                    conv, audit, at, state = key, text, 0, 0
                    continue
                inserted()
                letter, at = audit[at], at + 1
                if letter == "R":
                    state = _WANTED[state]
                    role = _ROLE[state]
                elif letter == "K":
                    state = _NEXT[role[0]][state]
                out.append((conv, letter, role, text))
                if len(out) >= 2000:
                    yield emit()
        inserted()
        if out:
            yield emit()

    return rows.mapInArrow(walk, schema)


def digests(turns: DataFrame) -> DataFrame:
    """``conv``, ``repaired_sha256`` (lowercase hex of ``role:text`` of all
    turns but the deleted, newline-joined) from :func:`repaired`."""
    schema = T.StructType([turns.schema["conv"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        conv, digest, empty, names, sums = None, None, True, [], []
        for batch in batches:
            for key, edit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest is None or key != conv:
                    if digest is not None:
                        names.append(conv)
                        sums.append(digest.hexdigest())
                    conv, digest, empty = key, hashlib.sha256(), True
                if edit != "D":
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            if len(names) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field("conv").type), pa.array(sums, pa.string())], names=schema.names)
                names, sums = [], []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([*names, conv], batch.schema.field("conv").type),
                                              pa.array([*sums, digest.hexdigest()], pa.string())], names=schema.names)

    return turns.mapInArrow(run, schema)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """For each conversation that has turns: the column named by ``conv``,
    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit``, ``repaired_sha256``.

    Turns are taken in the order of ``turn``, nulls first; those of one turn by
    role and then by the digest of their text, so equal ones are neighbours and
    all but the first are duplicates.  Null roles and texts are one space, and a
    null ``conv`` is a conversation.  A role without a first character is none of
    s, u, a.  Texts, and conversations, may be of any length (an audit is one
    string, so Spark's limit for it holds); an empty table gives none.  Other
    columns of any name are not read.
    """
    names = (conv, turn, role, text)
    found = stored(solved(faults(turns, *names)), "solved")
    hashed = digests(repaired(turns, found, *names)).select(F.col("conv").alias("_c"), "repaired_sha256")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.join(hashed, F.col("conv").eqNullSafe(F.col("_c"))).select(
        F.col("conv").alias(conv), *counts, "audit", "repaired_sha256")


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults, by the CRC-32 of ``conv:turn`` (nulls:
    one space) modulo 20: 0 drops a turn, 1 empties its text, 2 removes ``.!?``
    from it, 3 repeats it and 4 makes it the user's.  Null roles and texts
    become one space; other columns stay."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(filled(conv), F.lit(":"), filled(turn)).cast("binary")), F.lit(20))
    rows = turns.where(fault != 0)
    body = F.when(fault == 1, "").when(fault == 2, F.translate(filled(text), ".!?", "")).otherwise(filled(text))
    twice = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = [body.alias(c) if c == text else F.when(fault == 4, "user").otherwise(filled(role)).alias(c) if c == role else F.col(c)
           for c in turns.columns]
    number = next(n for n in ("copy", *[f"copy_{i}" for i in range(len(turns.columns))]) if n not in turns.columns)
    return rows.select(*out, F.explode(twice).alias(number)).drop(number)

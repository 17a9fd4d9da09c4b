"""Conversation repair by least-cost edits; among the cheapest audits the least one.

A repaired conversation has role initials ``(s?(ua)+)?``.  Its rows, in order,
are kept (``K``), deleted (``D``) or given a role (``R``), and empty turns may
be inserted (``I``); the letters in order are its audit.

1. *Faults*: rows are known by their turn, role and a 128-bit hash of the text,
   so texts stay where they are.  Equal rows collapse, the first of equal
   (role, text) rows is a grouped minimum.
2. *Segments*: rows are range-sorted, and a task packs them, a byte a row, into
   segments of ``SEGMENT`` rows; a long conversation is many rows of that table.
3. *Cost DP*: a segment is a 4 x 4 min-plus matrix over the states of the
   pattern.  The cost to go behind each segment is a product of the matrices
   after it, by pointer doubling over the table of segments.
4. *Path ranking*: in a segment, (row, state) nodes and their optimal arcs form
   a graph; an audit letter leads from a node to one node only.  Nodes are
   ranked by their least audits of 1, 2, 4, ... letters (pairs of ranks, sorted)
   and their pointers doubled, so the ranks of a node's targets select its arc
   and the doubled pointers list the path.  The state in which a segment is
   entered comes from pointer doubling again.
5. *Repair*: plans and texts meet in one exchange, sorted; a task walks them.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.llm.storage import bounded_batches, stored

#: Rows of a conversation that are one row of the table of segments.
SEGMENT = 4096
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_NEVER = 1 << 40
#: States: nothing yet, after s, after u, after a.
_STATES = 4
#: A system row is kept in state 0; a user row leads to 2, an assistant row from 2 to 3.
_KEEP = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {}}
_TURN = {0: 2, 1: 2, 2: 3, 3: 2}
_LETTERS = np.frombuffer(b"DIKR", np.uint8)
_D, _I, _K, _R = range(4)
#: Nodes beyond the last row: costs to go where a conversation ends, inserts included.
_END = (0, 2 * INSERT, INSERT, 0)

#: White space, by which a row is blank and behind which its last character is looked for.
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Rows whose graphs are ranked at once.
_AT_ONCE = 1 << 15


def _arcs(code: int) -> list[list[tuple[int, int, int]]]:
    """By state: (letter, cost, next state) of the edits of a row; ``code``: 4 * fault + role class."""
    fault, role = divmod(code, 4)
    out = []
    for q in range(_STATES):
        arcs = [(_D, DELETE, q)]
        if fault < 2:
            extra = TRUNCATED * fault
            if q in _KEEP[role]:
                arcs.append((_K, extra, _KEEP[role][q]))
            arcs.append((_R, REROLE + extra, _TURN[q]))
        out.append(arcs)
    return out


_CODES = [_arcs(code) for code in range(12)]


def _closed(v: list[int]) -> list[int]:
    """Costs to go where turns may be inserted first."""
    two = min(v[2], INSERT + v[3])
    return [min(v[0], INSERT + two), min(v[1], INSERT + two), two, min(v[3], INSERT + two)]


def costs_to_go(codes: bytes, end: list[int]) -> list[list[int]]:
    """Costs from every (row, state) node of a segment, the nodes behind it included."""
    v = list(end)
    out = [v]
    for code in reversed(codes):
        v = _closed([min(cost + v[to] for _, cost, to in arcs) for arcs in _CODES[code]])
        out.append(v)
    out.reverse()
    return out


def transfer(codes: bytes) -> list[int]:
    """The segment's min-plus matrix: costs from each state before it to each behind it."""
    columns = [costs_to_go(codes, [0 if q == to else _NEVER for q in range(_STATES)])[0] for to in range(_STATES)]
    return [min(columns[to][q], _NEVER) for q in range(_STATES) for to in range(_STATES)]


def optimal_arcs(codes: bytes, end: list[int], last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(nodes x letters) target node of each optimal arc, else -1; and the costs of the first four nodes."""
    costs = costs_to_go(codes, end)
    arcs = np.full(((len(codes) + 1) * _STATES, 4), -1, dtype=np.int64)
    for i, v in enumerate(costs):
        node = i * _STATES
        if i < len(codes):
            after = costs[i + 1]
            for q, choices in enumerate(_CODES[codes[i]]):
                for letter, cost, to in choices:
                    if cost + after[to] == v[q]:
                        arcs[node + q, letter] = node + _STATES + to
        if i < len(codes) or last:
            for q in range(_STATES):
                if INSERT + v[_TURN[q]] == v[q] and (i < len(codes) or q in (1, 2)):
                    arcs[node + q, _I] = node + _TURN[q]
    return arcs, np.array(costs[0], dtype=np.int64)


def least_paths(arcs: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Least audits from the start nodes and the nodes where they end, by prefix doubling over the optimal arcs.

    ``rank`` orders nodes by their least audit of at most 2^k letters and
    ``ptr`` is the node behind it; a node without arcs ends an audit, which
    is then less than any longer one.
    """
    every = np.arange(len(arcs))
    has = arcs >= 0
    final = ~has.any(axis=1)
    letter = has.argmax(axis=1)
    ptr = np.where(final, every, arcs[every, letter])
    rank = np.where(final, 0, letter + 1).astype(np.int64)
    length = (~final).astype(np.int64)
    pointers = [ptr]
    while not final[ptr].all():
        pairs = rank * (int(rank.max()) + 1) + rank[ptr]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        length = length + length[ptr]
        ptr = ptr[ptr]
        pointers.append(ptr)
    # a node's arc by its letter, then by the rank of its target; a letter names one arc, so the doubled pointers stand
    chosen = np.where(has, np.arange(4) * (int(rank.max()) + 1) + rank[arcs], np.iinfo(np.int64).max).argmin(axis=1)
    pointers[0] = np.where(final, every, arcs[every, chosen])
    steps = length[starts]
    step = np.arange(int(steps.sum())) - np.repeat(np.cumsum(steps) - steps, steps)
    at = np.repeat(starts, steps)
    for k, jump in enumerate(pointers):
        on = (step >> k) & 1 == 1
        at[on] = jump[at[on]]
    text = _LETTERS[chosen[at]].tobytes()
    cuts = np.concatenate([[0], np.cumsum(steps)])
    return [text[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], ptr[starts]


def _segment_audits(group: list[tuple[bytes, list[int], int, int]]) -> list[tuple[int, list[int], list[str]]]:
    """For (codes, matrix of the segments behind, number of segments, own number): cost from state 0, and by entry state the exit state and the audit.

    A conversation's first segment is entered in state 0 only.
    """
    graphs, starts, costs, base = [], [], [], 0
    for codes, v, size, nr in group:
        end = [min(v[4 * q + to] + _END[to] for to in range(_STATES)) for q in range(_STATES)]
        arcs, cost = optimal_arcs(codes, end, nr == size)
        arcs[arcs >= 0] += base
        graphs.append(arcs)
        costs.append(int(cost[0]))
        starts.append([base + q for q in (range(_STATES) if nr > 1 else (0,))])
        base += len(arcs)
    texts, ends = least_paths(np.concatenate(graphs), np.array([x for s in starts for x in s], dtype=np.int64))
    found, i = [], 0
    for cost, own in zip(costs, starts, strict=True):
        j = i + len(own)
        found.append((cost, [int(x) % _STATES for x in ends[i:j]], [t.decode() for t in texts[i:j]]))  # graphs have multiples of four nodes
        i = j
    return found


def _segments(rows: DataFrame, most: int) -> DataFrame:
    """The sorted rows, packed: ``conv, turn, role, digest`` of the first row, ``codes``, illegal pairs inside, first and last role class."""
    names = ["conv", "turn", "role", "digest"]
    fields = {f.name: f.dataType for f in rows.schema}
    schema = _schema([T.StructField(n, fields[n]) for n in names], "part int, seq long, codes binary, illegal long, head int, tail int")
    legal = np.zeros((4, 4), dtype=bool)
    legal[0, 1] = legal[1, 2] = legal[2, 1] = True

    def pack(batches):
        part, seq = TaskContext.get().partitionId(), 0
        kept, key, codes = None, None, bytearray()

        def row():
            roles = np.frombuffer(bytes(codes), np.uint8) % 4
            bad = int((~legal[roles[:-1], roles[1:]]).sum())
            return (*key, part, seq, bytes(codes), bad, int(roles[0]), int(roles[-1]))

        for batch in batches:
            out = []
            values = [batch.column(i).to_pylist() for i in range(7)]  # conv, turn, role, digest, code, again, times
            for c, turn, role, digest, code, again, times in zip(*values, strict=True):
                left = [code] if code >= 8 or not again else [code % 4 + 8]
                rest = times - 1
                while left or rest:
                    if codes and (kept != c or len(codes) >= most):
                        out.append(row())
                        seq += 1
                        codes.clear()
                    if not codes:
                        kept, key = c, (c, turn, role, digest)
                    if left:
                        codes.append(left.pop())
                    else:
                        n = min(rest, most - len(codes))
                        codes.extend(bytes([code % 4 + 8]) * n)
                        rest -= n
                    if len(out) >= 256:
                        yield _batch(out, arrow)
                        out = []
            if out:
                yield _batch(out, arrow)
        if codes:
            yield _batch([row()], arrow)

    arrow = _arrow_schema(schema)
    return rows.mapInArrow(pack, schema)


def _schema(fields: list[T.StructField], more: str) -> T.StructType:
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _doubled(segments: DataFrame, value: str, join_on: int, combine, identity: list[int]) -> DataFrame:
    """``conv, nr, value``: the combination of ``value`` over the segments strictly after (``join_on`` = 1) or before (-1) each one.

    Pointer doubling: the span of a row doubles every round, a written table;
    a conversation of one segment has the identity.
    """
    kind = T.ArrayType(T.LongType())
    joined = F.pandas_udf(lambda a, b: pd.Series([combine(list(x), list(y)) for x, y in zip(a, b, strict=True)]), kind)
    none = F.array(*(F.lit(x).cast("long") for x in identity))
    long = segments.where("size > 1").select("conv", "nr", "size", F.col(value).alias("v"))
    most = long.agg(F.max("size")).first()[0]
    start = segments.select("conv", "nr", none.alias("v"))
    if most is None:
        return start
    # v: the combination of the 2^k segments from the neighbour on; beyond the ends there is the identity.
    shift = lambda df, by: df.select(F.col("conv").alias("c"), (F.col("nr") - join_on * by).alias("n"), F.col("v").alias("w"))
    meet = F.col("conv").eqNullSafe(F.col("c")) & (F.col("nr") == F.col("n"))
    state = long.join(shift(long, 1), meet, "left").select("conv", "nr", F.coalesce("w", none).alias("v"))
    by = 1
    while by < most:
        state = stored(state, "segment-spans")
        state = state.join(shift(state, by), meet, "left").select("conv", "nr", joined("v", F.coalesce("w", none)).alias("v"))
        by *= 2
    return segments.where("size = 1").select("conv", "nr", none.alias("v")).unionByName(stored(state, "segment-spans"))


def _min_plus(a: list[int], b: list[int]) -> list[int]:
    x, y = np.array(a).reshape(4, 4), np.array(b).reshape(4, 4)
    return np.minimum((x[:, :, None] + y[None]).min(axis=1), _NEVER).ravel().tolist()


_ONE = [0 if q == to else _NEVER for q in range(_STATES) for to in range(_STATES)]


class Repair:
    """Faults, audits and repaired rows of the conversations of ``df``.

    Columns are named by ``conv_id``, ``turn``, ``role`` and ``text``; a null
    role or text is one space.  Rows are taken by turn (nulls first), rows of
    one turn by role and then by the MD5 of the text; equal rows are
    neighbours.  Faults of a row, the first counts: blank, duplicate (an
    earlier row has its role and text), truncated (the last character that is
    not white space is none of ``.!?``).  A null conversation id is a
    conversation.  An empty table has no rows; other columns play no part.
    Long texts stay in one exchange of the table; a conversation may have
    any number of rows, which are worked on in segments.
    ``order_role`` and ``order_text`` are what ties go by, where these are not
    the row's own; a row stands for ``copies`` equal neighbours.
    """

    def __init__(
        self, df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        order_role: Column | None = None, order_text: Column | None = None, copies: Column | None = None, segment: int = SEGMENT,
    ):
        bounded_batches(df.sparkSession)
        self.segment = segment
        space = F.lit(" ")
        own_role, own_text = F.coalesce(F.col(f"`{role}`"), space), F.coalesce(F.col(f"`{text}`"), space)
        self.texts = df.select(
            F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
            (own_role if order_role is None else order_role).alias("role"),
            F.md5(own_text if order_text is None else order_text).alias("digest"),
            own_role.alias("own_role"), own_text.alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
        )
        self.rows = self._faults()
        self.segments = self._plan()

    def _faults(self) -> DataFrame:
        """Distinct rows with ``fault`` (0 none, 1 truncated, 2 blank, 3 duplicate), role class and number, as a written table."""
        initial = F.substring("own_role", 1, 1)
        role_class = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        solid = F.rtrim("text", F.lit(_SPACE))
        blank, cut = solid == "", ~F.substring(solid, -1, 1).isin(".", "!", "?")
        rows = self.texts.select(
            "conv", "turn", "role", "digest", "own_role", F.md5("text").alias("own_digest"), role_class.alias("class"),
            F.when(blank, 2).when(cut, 1).otherwise(0).alias("fault"), "copies",
        )
        rows = rows.groupBy(*rows.columns[:-1]).agg(F.sum("copies").alias("times"))
        place = F.struct("turn", "role", "digest")
        firsts = rows.groupBy(F.col("conv").alias("c"), F.col("own_role").alias("r"), F.col("own_digest").alias("d")).agg(F.min(place).alias("first"))
        same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("own_role") == F.col("r")) & (F.col("own_digest") == F.col("d"))
        rows = rows.join(firsts, same)
        again = (F.col("fault") != 2) & ~F.col("first").eqNullSafe(place)
        return stored(rows.select("conv", "turn", "role", "digest", "class", "fault", again.alias("again"), "times"), "conversation-rows")

    def counts(self) -> DataFrame:
        """``conv, gaps, blank, duplicate, truncated, illegal``; gaps are null where they do not fit a long."""
        blank, again, n = F.col("fault") == 2, F.col("again"), F.col("times")
        found = self.rows.groupBy("conv").agg(
            F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.countDistinct("turn").alias("turns"),
            F.sum(F.when(blank, n).otherwise(0)).alias("blank"),
            F.sum(F.when(blank, 0).when(again, n).otherwise(n - 1)).alias("duplicate"),
            F.sum(F.when((F.col("fault") == 1) & ~again, 1).otherwise(0)).alias("truncated"),
        )
        gaps = F.when(F.col("lo").isNull(), 0).otherwise(F.try_add(F.try_subtract("hi", "lo"), F.lit(1) - F.col("turns")))
        seams = self.segments.select("conv", "nr", "illegal", "head", "tail")
        before = F.lag("tail").over(Window.partitionBy("conv").orderBy("nr"))  # a row for each segment
        seams = seams.withColumn("before", before)
        legal = ((F.col("before") == 0) & (F.col("head") == 1)) | ((F.col("before") == 1) & (F.col("head") == 2)) | ((F.col("before") == 2) & (F.col("head") == 1))
        seam = F.when(F.col("before").isNull() | legal, 0).otherwise(1)
        illegal = seams.groupBy(F.col("conv").alias("c")).agg(F.sum(F.col("illegal") + seam).alias("illegal"))
        found = found.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated")
        return found.join(illegal, F.col("conv").eqNullSafe(F.col("c"))).drop("c")

    def _plan(self) -> DataFrame:
        """The segments with their part of the least cheapest audit, as a written table."""
        order = ["conv", "turn", "role", "digest"]
        # fault 1 is truncated; blank and repeated rows must go
        code = F.col("class") + 4 * F.least("fault", F.lit(2))
        packed = self.rows.select(*order, code.cast("int").alias("code"), "again", "times")
        packed = packed.repartitionByRange(*order).sortWithinPartitions(*order)
        packed = stored(_segments(packed, self.segment), "conversation-segments")
        per = Window.partitionBy("conv")
        segments = packed.withColumns({"nr": F.row_number().over(per.orderBy("part", "seq")).cast("long"), "size": F.count("*").over(per)}).drop("part", "seq")
        segments = stored(segments, "conversation-segments")
        kind = T.ArrayType(T.LongType())
        matrix = F.pandas_udf(lambda codes: pd.Series([transfer(c) for c in codes]), kind)
        with_matrix = segments.select("conv", "nr", "size", matrix("codes").alias("m"))  # computed where size > 1 only: the rest drops the column
        ends = _doubled(with_matrix, "m", 1, _min_plus, _ONE).withColumnsRenamed({"conv": "c", "nr": "n"})
        meet = F.col("conv").eqNullSafe(F.col("c")) & (F.col("nr") == F.col("n"))
        planned = segments.join(ends, meet).drop("c", "n")
        schema = _schema(planned.drop("v", "codes").schema.fields, "cost long, exits array<long>, audits array<string>")
        arrow = _arrow_schema(schema)

        def audit(batches):
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                sizes, numbers = batch.column("size").to_pylist(), batch.column("nr").to_pylist()
                costs, exits, audits, group = [], [], [], []
                rows = zip(batch.column("codes").to_pylist(), batch.column("v").to_pylist(), sizes, numbers, strict=True)
                for k, row in enumerate(rows):
                    group.append(row)
                    if k == n - 1 or sum(len(r[0]) for r in group) >= _AT_ONCE:
                        for cost, out, texts in _segment_audits(group):
                            costs.append(cost)
                            exits.append(out)
                            audits.append(texts)
                        group = []
                keep = [batch.column(f.name) for f in list(schema)[:-3]]
                yield pa.RecordBatch.from_arrays(
                    [*keep, *(pa.array(x, arrow.field(name).type) for x, name in ((costs, "cost"), (exits, "exits"), (audits, "audits")))], schema=arrow
                )

        found = stored(planned.mapInArrow(audit, schema), "conversation-audits")
        first = F.col("exits")[0]
        entry_map = F.when(F.col("nr") == 1, F.array(first, first, first, first)).otherwise(F.col("exits"))
        # the map from the state before to the state behind the segments before
        before = _doubled(found.select("conv", "nr", "size", entry_map.alias("e")), "e", -1, lambda a, b: [a[x] for x in b], list(range(_STATES)))
        before = before.withColumnsRenamed({"conv": "c", "nr": "n"})
        chosen = F.get("audits", F.when(F.col("nr") == 1, 0).otherwise(F.col("v")[0]).cast("int"))
        return stored(found.join(before, meet).select(*[c for c in found.columns if c not in ("exits", "audits")], chosen.alias("audit")), "conversation-plans")

    def audits(self) -> DataFrame:
        """``conv, cost, audit`` of each conversation."""
        parts = F.transform(F.sort_array(F.collect_list(F.struct("nr", "audit"))), lambda x: x["audit"])
        return self.segments.groupBy("conv").agg(F.min_by("cost", "nr").alias("cost"), F.array_join(parts, "").alias("audit"))

    def repaired(self) -> DataFrame:
        """``conv, place, role, text`` of the repaired rows; the rows of a conversation are neighbours in one partition, in order.

        Only a batch is in memory, whatever the size of the conversation.
        """
        order = ["conv", "turn", "role", "digest"]
        texts = self.texts.select(*order, F.lit(1).alias("kind"), F.lit(0).cast("long").alias("nr"), F.lit(None).cast("string").alias("audit"), "own_role", "text", "copies")
        none = F.lit(None).cast("string")
        plans = self.segments.select(*order, F.lit(0).alias("kind"), "nr", "audit", none.alias("own_role"), none.alias("text"), F.lit(0).cast("long").alias("copies"))
        rows = plans.unionByName(texts).repartition("conv").sortWithinPartitions(*order, "kind", "nr").select("conv", "kind", "audit", "own_role", "text", "copies")
        schema = _schema([T.StructField("conv", self.texts.schema["conv"].dataType)], "place long, role string, text string")
        arrow = _arrow_schema(schema)

        def walk(batches):
            conv, state, place = None, 0, 0
            plan: deque[str] = deque()  # letters to come; more than a segment's only inside a run of equal rows
            out: list[tuple] = []

            def turn_to(q: int, role: str | None, text: str) -> int:
                nonlocal place
                to = _TURN[q] if role is None or not role.startswith("s") else 1
                out.append((conv, place, role if role is not None else ("user" if to == 2 else "assistant"), text))
                place += 1
                return to

            def inserts() -> None:
                nonlocal state
                while plan and plan[0] == "I":
                    plan.popleft()
                    state = turn_to(state, None, "")

            began = False
            for batch in batches:
                for c, kind, audit, role, text, copies in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                    if not began or c != conv:
                        inserts()
                        conv, state, place, began = c, 0, 0, True
                        plan.clear()
                    if kind == 0:
                        plan.extend(audit)
                        continue
                    for _ in range(copies):
                        inserts()
                        letter = plan.popleft()
                        if letter != "D":
                            state = turn_to(state, role if letter == "K" else None, text)
                if out:
                    yield _batch(out, arrow)
                    out.clear()
            inserts()
            if out:
                yield _batch(out, arrow)

        return rows.mapInArrow(walk, schema)


def joined_digests(repaired: DataFrame) -> DataFrame:
    """``conv, sha256`` of the rows ``role:text`` of each conversation, joined by newlines; reads the rows as :meth:`Repair.repaired` leaves them."""
    import hashlib

    schema = _schema([T.StructField("conv", repaired.schema["conv"].dataType)], "sha256 string")
    arrow = _arrow_schema(schema)

    def run(batches):
        conv, digest = None, None
        for batch in batches:
            out = []
            for c, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if place == 0:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield _batch(out, arrow)
        if digest is not None:
            yield _batch([(conv, digest.hexdigest())], arrow)

    return repaired.mapInArrow(run, schema)

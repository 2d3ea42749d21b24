"""Repair of the structure of conversations with the fewest edits.

Each row of a conversation has a role initial and at most one fault (blank, duplicate, truncated). Edits keep a row,
change its role, delete it, or insert an empty one, so that the initials become nothing or ``s?(ua)+``. A row changes
the state of that pattern (start, after s, after u, after a) at a cost: its symbol, made of initial and fault, has a
4 x 4 matrix of costs in min-plus algebra. Neighbouring rows with one symbol are one run, and a run of n rows is
advanced by the cached powers 1, 2, 4, ... of its matrix; then the choices of its rows are unrolled, always the
ASCII-least edit that still reaches the least cost.

No conversation is gathered in a task. Rows are sorted by range and packed into pieces of bounded size. The matrix
product of a piece stands for it when pieces of one conversation are put together, so the least costs after each piece,
and then the state at the begin of each, come from 4 x 4 numbers a piece. Most conversations are one piece that lies
inside its range: they need none of this. Only the SHA-256 of a conversation of several pieces, which is sequential by
its definition, streams its lines through one task, holding a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.session import cut_lineage

#: Rows and bytes of text of a piece.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
LONGS, INTS = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
LEGAL = ("su", "ua", "au")
#: States: 0 start, 1 after s, 2 after u, 3 after a. What each expects next, and where that leads.
EXPECTS = ("user", "user", "assistant", "user")
LEADS = (2, 2, 3, 2)
ACCEPTS = (0, 3)
NEVER = 1 << 60

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


def _inserts() -> Matrix:
    """Least cost of getting from state to state by inserts alone."""
    cost = [[NEVER] * 4 for _ in range(4)]
    for i in range(4):
        state, paid = i, 0
        while cost[i][state] > paid:
            cost[i][state] = paid
            state, paid = LEADS[state], paid + INSERT
    return tuple(map(tuple, cost))


INSERTS = _inserts()
#: Cost that is left in each state after the last row.
AT_END: Vector = tuple(min(row[k] for k in ACCEPTS) for row in INSERTS)


def _keeps(symbol: str, state: int) -> int | None:
    """State after keeping a row, if its initial fits."""
    initial = symbol.lower()
    if initial == "s":
        return 1 if state == 0 else None
    return LEADS[state] if initial == EXPECTS[state][0] else None


@lru_cache(None)
def _power(symbol: str, k: int) -> Matrix:
    """Costs of 2**k rows with the symbol, inserts before each included.

    Symbols: x is a row that must go; s, u, a and o (another initial) are rows without fault, in capitals truncated.
    """
    if k:
        half = _power(symbol, k - 1)
        return _product(half, half)
    cost = [[NEVER] * 4 for _ in range(4)]
    for i in range(4):
        cost[i][i] = DELETE
        if symbol != "x":
            more = TRUNCATED if symbol.isupper() else 0
            cost[i][LEADS[i]] = REROLE + more
            kept = _keeps(symbol, i)
            if kept is not None:
                cost[i][kept] = KEEP + more
    return _product(INSERTS, tuple(map(tuple, cost)))


def _before_run(symbol: str, n: int, after: Vector) -> Vector:
    """Costs left before ``n`` rows with the symbol, from those left after them."""
    k = 0
    while n:
        if n & 1:
            after = _apply(_power(symbol, k), after)
        n, k = n >> 1, k + 1
    return after


def piece_matrix(symbols: str, lengths: list[int]) -> Matrix:
    """Costs of all rows of some runs, by state before and after."""
    columns = []
    for j in range(4):
        v = tuple(0 if i == j else NEVER for i in range(4))
        for symbol, n in zip(reversed(symbols), reversed(lengths), strict=True):
            v = _before_run(symbol, int(n), v)
        columns.append(tuple(min(c, NEVER) for c in v))
    return tuple(zip(*columns, strict=True))


@lru_cache(1 << 16)
def _choice(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    """Edits at one row (inserts, then the row's own) and the state after it; ``after`` is relative to its least."""
    before, edits = _apply(_power(symbol, 0), after), ""
    while True:
        left = before[state]
        if DELETE + after[state] == left:
            return edits + "D", state
        if INSERT + before[LEADS[state]] == left:
            edits, state = edits + "I", LEADS[state]
            continue
        more = TRUNCATED if symbol.isupper() else 0
        kept = _keeps(symbol, state)
        if kept is not None and KEEP + more + after[kept] == left:
            return edits + "K", kept
        return edits + "R", LEADS[state]


def unroll(symbols: str, lengths: list[int], state: int, after: Vector, last: bool) -> Iterator[tuple[str, int, int]]:
    """(edits, state before, state after) of every row of some runs; the inserts after the last row come as a row more."""
    ends = [tuple(int(c) for c in after)]
    for symbol, n in zip(reversed(symbols), reversed(lengths), strict=True):
        ends.append(_before_run(symbol, int(n), ends[-1]))
    for r, (symbol, n) in enumerate(zip(symbols, lengths, strict=True)):
        end, n = ends[len(symbols) - 1 - r], int(n)
        for done in range(0, n, PIECE_ROWS):
            # The costs inside a long run: a jump by powers to the end of a block, then row by row.
            size = min(PIECE_ROWS, n - done)
            costs = [_before_run(symbol, n - done - size, end)]
            for _ in range(size - 1):
                costs.append(_apply(_power(symbol, 0), costs[-1]))
            for after in reversed(costs):
                least = min(after)
                edits, then = _choice(symbol, state, tuple(min(c - least, NEVER) for c in after))
                yield edits, state, then
                state = then
    if last:
        before, edits = state, ""
        while state not in ACCEPTS:
            edits, state = edits + "I", LEADS[state]
        yield edits, before, state


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``_n`` copies, ``_symbol`` of the first copy and ``_blank``; in ``_first`` role and text are new.

    Columns in: ``_conv``, ``_turn``, ``_role``, ``_text``. Nulls of role and text are one space.
    """
    white = F.lit(WHITE)
    rows = rows.withColumn("_role", F.coalesce("_role", F.lit(" "))).withColumn("_text", F.coalesce("_text", F.lit(" ")))
    rows = rows.withColumn("_hash", F.unhex(F.sha2("_text", 256)))
    # Equal rows are counted before the shuffle.
    distinct = rows.groupBy("_conv", "_turn", "_role", "_hash").agg(F.count(F.lit(1)).alias("_n"), F.first("_text").alias("_text"))
    first = rows.groupBy("_conv", "_role", "_hash").agg(F.min(F.struct(F.col("_turn").isNotNull().alias("has"), F.col("_turn").alias("turn"))).alias("_at"))
    first = first.select(F.col("_conv").alias("_c"), F.col("_at.turn").alias("_t"), F.col("_role").alias("_r"), F.col("_hash").alias("_h"), F.lit(True).alias("_first"))
    # The key is a whole row and meets one row at most, however often a text comes back in its conversation.
    same = (F.col("_conv").eqNullSafe(F.col("_c"))) & (F.col("_turn").eqNullSafe(F.col("_t"))) & (F.col("_role") == F.col("_r")) & (F.col("_hash") == F.col("_h"))
    joined = distinct.join(first, same, "left")
    solid = F.rtrim(F.col("_text"), white)
    blank = solid == ""
    initial = F.substring("_role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    ends = F.substring(solid, -1, 1).isin(".", "!", "?")
    symbol = F.when(blank | F.col("_first").isNull(), "x").when(ends, letter).otherwise(F.upper(letter))
    return joined.select("_conv", "_turn", "_role", "_hash", "_text", "_n", symbol.alias("_symbol"), blank.alias("_blank"), F.col("_first").isNotNull().alias("_first"))


def _pack(rows: DataFrame, piece_rows: int, piece_bytes: int) -> DataFrame:
    """Rows in their order as pieces: neighbouring rows of one conversation, at most so many and so large.

    ``whole`` pieces are conversations of their own; the others share theirs with other pieces, perhaps of other tasks.
    """
    kind = rows.schema["_conv"].dataType
    schema = (
        f"conv {kind.simpleString()}, piece long, whole boolean, role array<string>, text array<string>, copies array<long>, symbols string, lengths array<long>, "
        "blank long, duplicate long, truncated long, illegal long, first string, last string"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in schema.split(", ")]
        number = TaskContext.get().partitionId() << 33
        waiting, held, seen = [], 0, 0  # pieces of the conversation at hand and finished ones; conversations so far
        conv, piece, size = None, None, 0

        def flush(until: int) -> pa.RecordBatch:
            done = [waiting.pop(0) for _ in range(until)]
            return pa.RecordBatch.from_pylist([{n: p[n] for n in names} for p in done], pa.schema([(n, types[n]) for n in names]))

        types = {"piece": pa.int64(), "whole": pa.bool_(), "symbols": pa.string(), "first": pa.string(), "last": pa.string()}
        types |= {n: pa.list_(pa.string()) for n in ("role", "text")} | {n: pa.list_(pa.int64()) for n in ("copies", "lengths")}
        types |= {n: pa.int64() for n in ("blank", "duplicate", "truncated", "illegal")}
        for batch in batches:
            types["conv"] = batch.schema.field("_conv").type
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                c, role, text, n, symbol, blank, first = (col[i].as_py() for col in columns)
                if piece is None or c != conv:
                    if piece is not None and seen > 1 and len(waiting) and waiting[-1] is piece and piece["parts"] == 0:
                        piece["whole"] = True
                    seen, part, conv, piece = seen + 1, 0, c, None
                elif size >= piece_bytes or sum(piece["copies"]) >= piece_rows:
                    part, piece = part + 1, None
                if piece is None:
                    if held >= piece_bytes or len(waiting) >= piece_rows:
                        yield flush(len(waiting))
                        held = 0
                    piece = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0) | {
                        "conv": c, "piece": number, "whole": False, "parts": part, "role": [], "text": [], "copies": [], "symbols": "", "lengths": [], "first": role[:1],
                    }
                    number, size = number + 1, 0
                    waiting.append(piece)
                elif piece["last"] + role[:1] not in LEGAL:
                    piece["illegal"] += 1
                piece["illegal"] += n - 1
                piece["last"] = role[:1]
                piece["blank"] += n if blank else 0
                piece["duplicate"] += 0 if blank else n - first
                piece["truncated"] += symbol.isupper()
                for name, value in (("role", role), ("text", text), ("copies", n)):
                    piece[name].append(value)
                for s, k in ((symbol, 1), ("x", n - 1)):
                    if k and piece["symbols"][-1:] == s:
                        piece["lengths"][-1] += k
                    elif k:
                        piece["symbols"] += s
                        piece["lengths"].append(k)
                size += len(text)
                held += len(text)
        if waiting:
            yield flush(len(waiting))

    return rows.select("_conv", "_role", "_text", "_n", "_symbol", "_blank", "_first").mapInArrow(work, schema)


def pieces(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """The conversations as a written table of pieces, rows in the order turn (nulls first), role, SHA-256 of the text."""
    rows = rows.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).cast("string").alias("_role"), F.col(text).cast("string").alias("_text"))
    order = ["_conv", "_turn", "_role", "_hash"]
    ordered = _faults(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(_pack(ordered, piece_rows, piece_bytes), "conversation-pieces")


@F.pandas_udf(LONGS)
def _matrix(symbols: pd.Series, lengths: pd.Series) -> pd.Series:
    return pd.Series([[c for row in piece_matrix(s, list(n)) for c in row] for s, n in zip(symbols, lengths, strict=True)])


@F.pandas_udf(T.ArrayType(LONGS))
def _costs_after(matrices: pd.Series) -> pd.Series:
    """Costs left after each piece, from the matrices of a conversation's pieces in order."""
    out = []
    for several in matrices:
        after, got = AT_END, []
        for m in reversed(list(several)):
            got.append(list(after))
            after = _apply(tuple(tuple(int(c) for c in m[4 * i : 4 * i + 4]) for i in range(4)), after)
        out.append(got[::-1])
    return pd.Series(out)


@F.pandas_udf(INTS)
def _leaves(symbols: pd.Series, lengths: pd.Series, after: pd.Series) -> pd.Series:
    """State after a piece for each state before it."""
    out = []
    for s, n, v in zip(symbols, lengths, after, strict=True):
        ends = []
        for state in range(4):
            for _, _, then in unroll(s, list(n), state, tuple(v), last=False):
                state = then
            ends.append(state)
        out.append(ends)
    return pd.Series(out)


@F.pandas_udf(INTS)
def _begins(leaves: pd.Series) -> pd.Series:
    """State before each piece of a conversation."""
    out = []
    for several in leaves:
        state, got = 0, []
        for ends in several:
            got.append(state)
            state = int(ends[state])
        out.append(got)
    return pd.Series(out)


EDITS = T.StructType().add("audit", "string").add("cost", "long").add("at", INTS).add("becomes", T.ArrayType(T.StringType()))


@F.pandas_udf(EDITS)
def _edit(symbols: pd.Series, lengths: pd.Series, copies: pd.Series, state: pd.Series, after: pd.Series, last: pd.Series) -> pd.DataFrame:
    """Edits of a piece, their cost, and the rows that stay: place in the piece (-1: inserted) and new role (null: kept)."""
    audits, costs, places, roles = [], [], [], []
    for s, n, c, q, v, end in zip(symbols, lengths, copies, state, after, last, strict=True):
        audit, cost, at, becomes = [], 0, [], []
        row, copy = 0, 0
        runs = (symbol for symbol, k in zip(s, n, strict=True) for _ in range(int(k)))
        for edits, before, _ in unroll(s, list(n), int(q), tuple(v), bool(end)):
            symbol = next(runs, "x")
            audit.append(edits)
            for e in edits:
                if e == "I":
                    cost += INSERT
                    at.append(-1)
                    becomes.append(EXPECTS[before])
                    before = LEADS[before]
                elif e == "D":
                    cost += DELETE
                else:
                    cost += (REROLE if e == "R" else KEEP) + (TRUNCATED if symbol.isupper() else 0)
                    at.append(row)
                    becomes.append(EXPECTS[before] if e == "R" else None)
            copy += 1
            if row < len(c) and copy == c[row]:
                row, copy = row + 1, 0
        audits.append("".join(audit))
        costs.append(cost)
        places.append(at)
        roles.append(becomes)
    return pd.DataFrame({"audit": audits, "cost": costs, "at": places, "becomes": roles})


def _in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """The pieces of each conversation as one row of arrays; a few numbers a piece, no text."""
    got = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("piece", *columns))).alias("_p"))
    return got.select("conv", F.col("_p.piece").alias("pieces"), *[F.col(f"_p.{c}").alias(c) for c in columns])


def edited(packed: DataFrame) -> DataFrame:
    """The pieces with ``audit``, ``cost``, ``at`` and ``becomes`` of their edits."""
    end = F.array(*[F.lit(c).cast("long") for c in AT_END])
    whole = packed.filter("whole").withColumns({"state": F.lit(0), "after": end, "ends": F.lit(True)})
    shared = packed.filter("NOT whole")
    narrow = cut_lineage(shared.select("conv", "piece", "symbols", "lengths"), "conversation-shared")
    costs = _in_order(narrow.select("conv", "piece", _matrix("symbols", "lengths").alias("m")), "m")
    costs = costs.select(F.explode(F.arrays_zip("pieces", _costs_after("m").alias("after"))).alias("_z")).select("_z.pieces", "_z.after")
    with_costs = narrow.join(costs.withColumnRenamed("pieces", "piece"), "piece")
    states = _in_order(with_costs.select("conv", "piece", "after", _leaves("symbols", "lengths", "after").alias("leaves")), "after", "leaves")
    states = states.withColumn("state", _begins("leaves")).withColumn("ends", F.transform("state", lambda _, i: i == F.size("pieces") - 1))
    states = states.select(F.explode(F.arrays_zip("pieces", "state", "after", "ends")).alias("_z"))
    states = states.select(F.col("_z.pieces").alias("piece"), "_z.state", "_z.after", "_z.ends")
    both = whole.unionByName(shared.join(states, "piece"))
    return both.withColumn("_e", _edit("symbols", "lengths", "copies", "state", "after", "ends")).select("*", "_e.*").drop("_e")


def _line(at: Column, becomes: Column) -> Column:
    return F.concat(F.coalesce(becomes, F.get("role", at)), F.lit(":"), F.when(at < 0, "").otherwise(F.get("text", at)))


def repaired_rows(done: DataFrame) -> DataFrame:
    """From ``edited``: ``conv``, ``piece``, ``place`` (order), ``role`` and ``text`` of every row of the repaired conversations."""
    rows = done.select("conv", "piece", F.col("role").alias("_roles"), F.col("text").alias("_texts"), F.posexplode(F.arrays_zip("at", "becomes")).alias("place", "_z"))
    at = F.col("_z.at")
    return rows.select(
        "conv", "piece", "place",
        F.coalesce("_z.becomes", F.get("_roles", at)).alias("role"), F.when(at < 0, "").otherwise(F.get("_texts", at)).alias("text"),
    )


def _streamed_digests(done: DataFrame) -> DataFrame:
    """``conv``, ``digest`` of conversations of several pieces: their lines pass in order, none is held."""
    kind = done.schema["conv"].dataType.simpleString()
    lines = repaired_rows(done).select("conv", "piece", "place", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition("conv").sortWithinPartitions("conv", "piece", "place").select("conv", "line")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind_of = None, None, None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], kind_of), pa.array([digest.hexdigest()])], ["conv", "digest"])

        for batch in batches:
            kind_of = batch.schema.field(0).type
            pairs = ((batch.column(0)[i].as_py(), batch.column(1)[i]) for i in range(batch.num_rows))
            for c, several in groupby(pairs, key=lambda p: p[0]):
                if digest is None or c != conv:
                    if digest is not None:
                        yield result()
                    conv, digest, begun = c, hashlib.sha256(), False
                for _, line in several:
                    digest.update((b"\n" if begun else b"") + line.as_py().encode("utf-8", "surrogatepass"))
                    begun = True
        if digest is not None:
            yield result()

    return ordered.mapInArrow(work, f"conv {kind}, digest string")


EMPTY = hashlib.sha256(b"").hexdigest()


def report(
    rows: DataFrame,
    ids: DataFrame | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit``, ``repaired_sha256``.

    ``ids`` has the conversations to report (its column ``conv``), else all of ``rows``; one without rows has zeros, an
    empty audit and the digest of nothing. A null id is a conversation too. Null roles and texts are one space. Rows of
    equal turn stand in the order of role and SHA-256 of the text; equal rows follow each other, and the later ones are
    duplicates. Turns are whole numbers; null ones come first and do not count for gaps. Other columns are not read. No
    conversations give no rows.
    """
    turns = rows.groupBy(F.col(conv).alias("conv"), F.col(turn).alias("_turn")).agg(F.lit(True).alias("_here"))
    if ids is not None:
        turns = turns.unionByName(ids.select(F.col(conv).alias("conv")).distinct(), allowMissingColumns=True)
    present = F.count("_turn")
    gaps = F.when(present > 0, F.max("_turn").cast("long") - F.min("_turn").cast("long") + 1 - present).otherwise(0)
    spans = turns.groupBy("conv").agg(gaps.cast("long").alias("gaps"))

    done = edited(pieces(rows, conv, turn, role, text, piece_rows, piece_bytes))
    body = F.array_join(F.zip_with("at", "becomes", _line), "\n")
    shown = done.withColumn("digest", F.when(F.col("whole"), F.sha2(body, 256)))
    by_conv = shown.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.max("digest").alias("digest"), F.sort_array(F.collect_list(F.struct("piece", "audit", "first", "last"))).alias("_p"),
    )
    # Between two pieces: the last initial of one and the first of the next.
    seams = F.size(F.filter(F.sequence(F.lit(2), F.size("_p")), lambda i: ~F.concat(F.element_at("_p", i - 1)["last"], F.element_at("_p", i)["first"]).isin(*LEGAL)))
    by_conv = by_conv.withColumn("_seams", F.when(F.size("_p") > 1, seams).otherwise(0)).withColumn("audit", F.array_join("_p.audit", ""))
    streamed = _streamed_digests(done.filter("NOT whole")).select(F.col("conv").alias("_s"), F.col("digest").alias("_digest"))
    joined = spans.join(by_conv.withColumnRenamed("conv", "_c"), F.col("conv").eqNullSafe(F.col("_c")), "left")
    joined = joined.join(streamed, F.col("conv").eqNullSafe(F.col("_s")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("conv").alias("conv_id"), "gaps", *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.coalesce(F.col("illegal") + F.col("_seams"), zero).alias("illegal"), F.coalesce("cost", zero).alias("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", "_digest", F.lit(EMPTY)).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows after damage by crc32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    ``.!?`` away, 3 repeats it, 4 makes the role user. Nulls are one space in role, text and the key."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind, said = F.crc32(key) % 20, F.coalesce(F.col(text), space)
    hit = rows.select(
        F.col(conv), F.col(turn), F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias(text),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_copies"),
    )
    return hit.filter("_copies > 0").withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")


def _sql() -> str:
    """Row by row from a conversation's end, with cost, audit and text for each of the four states."""
    leads = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
    names = {"u": "user", "a": "assistant"}

    def edit(q: int) -> str:
        need, to = leads[q]
        rest, next_one = f"w[{q + 1}]", f"w[{to + 1}]"
        more = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        line = "chr(10) || role || ':' || text"
        moves = [f"{{'c': {rest}.c + 2, 'a': 'D' || {rest}.a, 't': {rest}.t}}"]
        stays = "fault IN ('none', 'truncated')"
        r = f"{{'c': {next_one}.c + 1 + {more}, 'a': 'R' || {next_one}.a, 't': chr(10) || '{names[need]}:' || text || {next_one}.t}}"
        moves.append(f"CASE WHEN {stays} THEN {r} END")
        k = f"{{'c': {next_one}.c + {more}, 'a': 'K' || {next_one}.a, 't': {line} || {next_one}.t}}"
        moves.append(f"CASE WHEN {stays} AND initial = '{need}' THEN {k} END")
        if q == 0:
            k = f"{{'c': w[2].c + {more}, 'a': 'K' || w[2].a, 't': {line} || w[2].t}}"
            moves.append(f"CASE WHEN {stays} AND initial = 's' THEN {k} END")
        return f"list_sort(list_filter([{', '.join(moves)}], lambda x: x IS NOT NULL))[1]"

    def insert(q: int, of: str) -> str:
        need, to = leads[q]
        return f"{{'c': {of}[{to + 1}].c + 5, 'a': 'I' || {of}[{to + 1}].a, 't': chr(10) || '{names[need]}:' || {of}[{to + 1}].t}}"

    def closed(of: str) -> str:
        return "[" + ", ".join(f"list_sort([{of}[{q + 1}], {insert(q, of)}])[1]" for q in range(4)) + "]"

    far = 10**9
    ends = [f"{{'c': {0 if q in (0, 3) else far}::BIGINT, 'a': '', 't': ''}}" for q in range(4)]
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(
             string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) % 20 AS kind
  FROM conversations),
hit AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos, substr(role, 1, 1) AS initial,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS final
  FROM hit),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier FROM placed),
faulty AS (
  SELECT *, CASE WHEN final = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM seen),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
open_end AS (SELECT [{", ".join(ends)}] AS w),
closed_end AS (SELECT {closed("w")} AS w FROM open_end),
last_end AS (SELECT {closed("w")} AS w FROM closed_end),
steps AS (
  SELECT conv_id, n + 1 AS pos, w FROM sums, last_end
  UNION ALL
  SELECT conv_id, pos, {closed("w")} AS w FROM (SELECT conv_id, pos, {closed("w")} AS w FROM (
    SELECT f.conv_id, f.pos, [{", ".join(edit(q) for q in range(4))}] AS w
    FROM steps s JOIN faulty f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = s.pos - 1))),
best AS (SELECT conv_id, w[1] AS b FROM steps WHERE pos = 1)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
       sha256(substr(coalesce(b.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN sums ON i.conv_id IS NOT DISTINCT FROM sums.conv_id
LEFT JOIN best ON i.conv_id IS NOT DISTINCT FROM best.conv_id
"""


REPORT_SQL = _sql()

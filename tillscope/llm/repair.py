"""Conversation structure repair over a suffix-shared automaton.

Every conversation is a string of signatures, one letter per row: its role's initial
and what is wrong with it. Conversations that end alike share the automaton's nodes:
a node is a distinct suffix, and it has one arc, to the suffix that is a letter
shorter. For each node and each state of the role grammar the cost to go and the first
edit of the cheapest repair are found once, whatever the number of conversations. The
distinct signatures are dealt by how they end and read in the order of their reversals,
so that a task keeps the nodes of one path only.

Conversations are never collected: rows go past in order. Signatures longer than
``CHUNK`` letters are cut, a cut's cheapest repairs are kept for every pair of grammar
states, and the cuts are put together like a product of matrices. Only the digest of
the repaired text, one hash over a whole conversation, needs all rows of a conversation
to pass one task, which holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.llm.common import table, written

CHUNK = 4096
#: Bytes of signatures with their repairs that are sent to every executor at most.
BROADCAST_BYTES = 32_000_000
#: Conversations that end in the same letters meet in one task.
TAIL = 6
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\v\f\r"

#: States of the role grammar ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
_KEEP = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: Where an inserted or newly named user or assistant leads.
_NEXT = (USER, USER, ASSISTANT, USER)
#: Cost and edits that are left behind the last row, by state.
_END = ((0, ""), (2 * INSERT, "I" * 2), (INSERT, "I"), (0, ""))
_LEGAL = ("su", "ua", "au")

Best = tuple[int, str, int]  # cost, first edit, state behind it


# --- the automaton --------------------------------------------------------------------

def node(letter: str, below: list[list[Best | None]]) -> list[list[Best | None]]:
    """Cheapest repairs of a suffix by state before it and state behind it.

    ``below`` has those of the suffix without its first letter. Of equally cheap ones
    that with the least first edit is taken; two edits that begin alike are the same
    edit here, so this gives the least whole string.
    """
    extra = TRUNCATED if letter.isupper() else 0
    made: list[list[Best | None]] = [[None] * 4 for _ in STATES]
    for end in STATES:
        base: list[Best | None] = []
        for state in STATES:
            found = []

            def add(cost: int, edit: str, ahead: int) -> None:
                rest = below[ahead][end]
                if rest is not None:
                    found.append((cost + rest[0], edit, ahead))

            add(DELETE, "D", state)
            if letter != "x":
                kept = _KEEP.get((state, letter.lower()))
                if kept is not None:
                    add(extra, "K", kept)
                add(REROLE + extra, "R", _NEXT[state])
            base.append(min(found, default=None))
        best = list(base)
        for _ in range(3):  # no repair inserts more than two rows in one place
            after = [best[_NEXT[s]] for s in STATES]
            best = [
                min((o for o in (base[s], after[s] and (after[s][0] + INSERT, "I", _NEXT[s])) if o), default=None)
                for s in STATES
            ]
        for state in STATES:
            made[state][end] = best[state]
    return made


#: The empty suffix: the state stays as it is.
LEAF: list[list[Best | None]] = [[(0, "", s) if s == e else None for e in STATES] for s in STATES]


def repairs(signatures: Iterable[str]) -> Iterator[tuple[str, list[int], list[str]]]:
    """(signature, costs, edits) by state before and state behind, -1 where there is no way.

    Signatures come in the order of their reversals, so that each node is made once:
    ``path`` holds the nodes of the suffixes of the signature before.
    """
    path, before = [LEAF], ""
    for signature in signatures:
        shared = 0
        for a, b in zip(reversed(before), reversed(signature)):
            if a != b:
                break
            shared += 1
        del path[shared + 1 :]
        for letter in reversed(signature[: len(signature) - shared]):
            path.append(node(letter, path[-1]))
        before = signature
        top = path[-1]
        costs = [-1 if top[s][e] is None else top[s][e][0] for s in STATES for e in STATES]
        yield signature, costs, [_edits(path, s, e) for s in STATES for e in STATES]


def _edits(path: list, state: int, end: int) -> str:
    if path[-1][state][end] is None:
        return ""
    edits, depth = [], len(path) - 1
    while depth:
        _, edit, state = path[depth][state][end]
        edits.append(edit)
        depth -= edit != "I"
    return "".join(edits)


def whole(chunks: list[tuple[list[int], list[str]]]) -> tuple[int, str]:
    """Cost and edits of a conversation from its cuts, in order."""
    ahead: list[tuple[int, str] | None] = list(_END)
    for costs, edits in reversed(chunks):
        ahead = [
            min(
                (
                    (costs[4 * s + e] + ahead[e][0], edits[4 * s + e] + ahead[e][1])
                    for e in STATES if costs[4 * s + e] >= 0 and ahead[e] is not None
                ),
                default=None,
            )
            for s in STATES
        ]
    return ahead[START]


# --- rows -----------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by their id and turn; 0 copies of a dropped row.

    Null roles and texts are one space, and so is a null id or turn in the key of the damage.
    """
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, copies, blank, truncated, repeated: equal rows of a turn as one.

    ``repeated`` tells that the role and text were there in an earlier turn. A
    conversation whose rows are all dropped keeps a row of no copies. Texts move as
    digests, and equal rows are one row per task before they move.
    """
    left = F.rtrim("text", F.lit(BLANKS))
    there = F.col("copies") > 0
    short = rows.select(
        "conv_id",
        *(F.when(there, c).alias(n) for n, c in (("turn", F.col("turn")), ("role", F.col("role")), ("digest", _digest(F.col("text"))))),
        (there & (left == "")).alias("blank"),
        (there & ~F.right(left, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.col("copies").cast("long"),
    )
    merged = short.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    earlier = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    return merged.withColumn("repeated", F.row_number().over(earlier) > 1)


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation in one task, sorted there; conversations one behind the other."""
    wanted = [F.col(c).asc_nulls_first() for c in ("conv_id", *first, "turn", "role", "digest")]
    return rows.repartition("conv_id").sortWithinPartitions(*wanted)


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal")


class _Summary:
    """Figures and signature cuts of one conversation, from its rows in order."""

    def __init__(self, conv_id, chunk: int):
        self.conv_id, self.chunk = conv_id, chunk
        self.letters, self.cuts, self.size = [], [], 0
        self.counts = dict.fromkeys(FIGURES, 0)
        self.first = self.last = self.initial = None
        self.turns = 0

    def add(self, turn, role, copies, blank, truncated, repeated) -> None:
        if not copies:
            return
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.counts["illegal"] += 1
        self.initial = initial
        self.counts["illegal"] += copies - 1  # a row beside its copy
        if blank:
            self.counts["blank"] += copies
            self._letters("x", copies)
            return
        own = initial if initial in ("s", "u", "a") else "o"
        if not repeated:
            self.counts["truncated"] += truncated
            self._letters(own.upper() if truncated else own, 1)
        self.counts["duplicate"] += copies - (not repeated)
        self._letters("x", copies - (not repeated))

    def _letters(self, letter: str, times: int) -> None:
        while times:
            fits = min(times, self.chunk - self.size)
            self.letters.append(letter * fits)
            self.size += fits
            times -= fits
            if self.size == self.chunk:
                self._cut()

    def _cut(self) -> None:
        self.cuts.append("".join(self.letters))
        self.letters, self.size = [], 0

    def rows(self) -> Iterator[tuple]:
        if self.size or not self.cuts:
            self._cut()
        if self.turns:
            self.counts["gaps"] = self.last - self.first + 1 - self.turns
        for i, cut in enumerate(self.cuts):
            yield (self.conv_id, i, cut, *self.counts.values())


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_CUT_FIELDS = [("cut", pa.int32()), ("signature", pa.string())] + [(f, pa.int64()) for f in FIGURES]


def _summaries(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    kind = None

    def rows() -> Iterator[tuple]:
        nonlocal kind
        current = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            names = ("conv_id", "turn", "role", "copies", "blank", "truncated", "repeated")
            for conv_id, *row in zip(*(batch.column(n).to_pylist() for n in names)):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        yield from current.rows()
                    current = _Summary(conv_id, chunk)
                current.add(*row)
        if current is not None:
            yield from current.rows()

    made = rows()
    first = next(made, None)
    if first is not None:
        schema = pa.schema([("conv_id", kind), *_CUT_FIELDS])
        yield _batch([first], schema)
        yield from _batches(made, schema)


def _minimised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    signatures = (s for batch in batches for s in batch.column("signature").to_pylist())
    schema = pa.schema([("signature", pa.string()), ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))])
    yield from _batches(repairs(signatures), schema, size=256)


def signature_repairs(cuts: DataFrame) -> DataFrame:
    """signature, costs, edits of every distinct signature, each node of the automaton made once a task."""
    distinct = cuts.select("signature").distinct()
    tail = F.right("signature", F.lit(TAIL))
    dealt = distinct.repartition(tail).sortWithinPartitions(F.reverse("signature"))
    return dealt.mapInArrow(_minimised, "signature string, costs array<bigint>, edits array<string>")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's cuts, then its rows: one row with its digest behind them."""
    kind = None

    def rows() -> Iterator[tuple]:
        nonlocal kind
        current = None
        names = ("conv_id", "cut", "costs", "edits", "figures", "role", "text", "copies")
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv_id, cut, costs, edits, figures, role, text, copies in zip(
                *(batch.column(n).to_pylist() for n in names)
            ):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        yield current.row()
                    current = _Repair(conv_id)
                if cut is not None:
                    current.figures = figures
                    current.cuts.append((costs, edits))
                else:
                    current.add(role, text, copies)
        if current is not None:
            yield current.row()

    made = rows()
    first = next(made, None)
    if first is not None:
        fields = [("conv_id", kind)] + [(f, pa.int64()) for f in (*FIGURES, "cost")]
        schema = pa.schema([*fields, ("audit", pa.string()), ("repaired_sha256", pa.string())])
        yield _batch([first], schema)
        yield from _batches(made, schema)


class _Repair:
    """Applies a conversation's edits to its rows as they come."""

    def __init__(self, conv_id):
        self.conv_id, self.figures, self.cuts = conv_id, None, []
        self.audit, self.cost, self.at, self.state = None, 0, 0, START
        self.hash, self.some = hashlib.sha256(), False

    def _ready(self) -> None:
        if self.audit is None:
            self.cost, self.audit = whole(self.cuts)
            self.cuts = []

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.some else "") + role + ":").encode())
        self.hash.update(text.encode())
        self.some = True

    def _name(self) -> str:
        """The user or assistant that is due."""
        role = "assistant" if self.state == USER else "user"
        self.state = _NEXT[self.state]
        return role

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(self._name(), "")
            self.at += 1

    def add(self, role: str, text: str, copies: int) -> None:
        self._ready()
        for _ in range(copies):
            self._insert()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = _KEEP[self.state, role[:1]]
                self._write(role, text)
            elif edit == "R":
                self._write(self._name(), text)

    def row(self) -> tuple:
        self._ready()
        self._insert()
        return (self.conv_id, *self.figures, self.cost, self.audit, self.hash.hexdigest())


def repaired(rows: DataFrame, chunk: int = CHUNK, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, copies): figures, cost, audit, digest.

    gaps, blank, duplicate, truncated, illegal, cost; ``audit`` has the initials of the
    cheapest edits (Keep, Rerole, Delete, Insert) that give the roles ``(s?(ua)+)?``,
    the ASCII-least of equally cheap ones, and ``repaired_sha256`` is of the repaired
    ``role:text`` lines. Copies of a row stand beside it; 0 copies is a dropped row,
    which only names its conversation.

    Rows go by turn, null turns first; rows of one turn by role and digest of the text.
    A null conv_id is a conversation. A role is known by its first character: one that
    is not s, u or a, or is empty, can't be kept. A conversation without rows has zeros,
    an empty audit and the digest of nothing; an empty table gives an empty result.
    Other columns aren't looked at.
    """
    name = rows.schema["conv_id"].dataType
    cut_schema = T.StructType([T.StructField("conv_id", name)]).add("cut", "integer").add("signature", "string")
    for figure in FIGURES:
        cut_schema = cut_schema.add(figure, "long")
    cuts = written(_in_order(faults(rows)).mapInArrow(partial(_summaries, chunk=chunk), cut_schema), "repair-signatures")
    known = written(signature_repairs(cuts), "repair-automaton")
    size = known.agg(F.sum(F.length("signature") * 18 + 200)).first()[0] or 0  # 16 edits about as long
    met = cuts.join(F.broadcast(known) if size <= broadcast_bytes else known, "signature")
    figures = F.array(*FIGURES).alias("figures")
    heads = met.select("conv_id", "cut", "costs", "edits", figures)
    lines = rows.filter("copies > 0").select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), "text", "copies")
    both = heads.unionByName(lines, allowMissingColumns=True)
    # cuts before lines: nulls would go first, so lines have a number behind all cuts
    both = both.withColumn("place", F.coalesce("cut", F.lit((1 << 31) - 1)))
    final = T.StructType([T.StructField("conv_id", name)])
    for figure in (*FIGURES, "cost"):
        final = final.add(figure, "long")
    final = final.add("audit", "string").add("repaired_sha256", "string")
    return _in_order(both, "place").mapInArrow(_applied, final)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))

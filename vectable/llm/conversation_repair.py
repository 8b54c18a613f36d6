"""Repair of the structure of conversations by a grammar-compressed dynamic program.

A conversation should be an optional system turn and then pairs of a user and an assistant turn.
Rows are blank, duplicate or truncated, roles are wrong or missing; edits keep, rerole, delete or
insert rows at given costs, and the cheapest sequence of edits is sought.

All that the search needs of a row is one of nine symbols: its role's class, and whether it must go
or ends in the middle of a sentence. Rows are sorted into a table whose partitions cut long
conversations anywhere; every 4,096 neighbouring rows of a conversation become one text of
symbols. A Re-Pair grammar is learnt over all such texts: the most frequent pairs of symbols become
new symbols, round by round. Every symbol has one min-plus transfer matrix over the four states of
the target pattern, computed bottom-up: a rule's matrix is the product of its two sides'. Entries
hold a cost, the state between the two sides (the rope from which the audit text is read) and the
rank of that text among those from the same state, so equal costs are settled without comparing
texts: audits of the same rows from one state to different states always differ, and none begins
another. The matrices are shared by all conversations; a conversation multiplies a vector through
its compressed symbols.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm.scratch import kept

BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs
GONE = "x"  # a row that must be deleted; others are s, u, a or o(ther), capital if truncated
ROUNDS, PAIRS = 8, 4  # rounds of the grammar, and rules a round
BLOCK_BITS = 12  # neighbouring rows of a conversation in one text of symbols: at most 2 to this power
FIRST_RULE = 0xE000  # rules are named by private code points
INFINITE = 1 << 60

START, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired conversation ends with
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by inserting or reroling


@dataclass
class Matrix:
    """From state to state: cost, rank of the audit among those from the same state, and its rope."""

    cost: list[list[int]]
    rank: list[list[int]]
    rope: list[list[object]]  # a text, or for a rule the state between its sides
    sides: tuple[Matrix, Matrix] | None = None
    texts: dict = field(default_factory=dict)

    def audit(self, i: int, j: int) -> str:
        if (i, j) not in self.texts:
            between = self.rope[i][j]
            if self.sides:
                left, right = self.sides
                between = left.audit(i, between) + right.audit(between, j)
            self.texts[i, j] = between
        return self.texts[i, j]


def _ranks(keys: list[object | None]) -> list[int]:
    order = sorted((j for j, key in enumerate(keys) if key is not None), key=lambda j: keys[j])
    place = {j: rank for rank, j in enumerate(order)}
    return [place.get(j, -1) for j in range(4)]


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions and then the row's own edit, the cheapest and then the least audit."""
    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    cost = [[INFINITE] * 4 for _ in range(4)]
    rope: list[list[object]] = [[None] * 4 for _ in range(4)]
    for i in range(4):
        at = i
        for inserted in range(3):
            steps = [(DELETE, "D", at)]
            if role != GONE:
                steps.append((REROLE + extra, "R", NEXT[at]))
                if role == "s" and at == START:
                    steps.append((extra, "K", SYSTEM))
                if role == "ua"[NEXT[at] == ASSISTANT]:
                    steps.append((extra, "K", NEXT[at]))
            for price, letter, j in steps:
                new = (INSERT * inserted + price, "I" * inserted + letter)
                if rope[i][j] is None or new < (cost[i][j], rope[i][j]):
                    cost[i][j], rope[i][j] = new
            at = NEXT[at]
    return Matrix(cost, [_ranks(row) for row in rope], rope)


def product(left: Matrix, right: Matrix) -> Matrix:
    """The min-plus product; equal costs go to the lesser audit."""
    cost = [[INFINITE] * 4 for _ in range(4)]
    rank, rope = [], []
    for i in range(4):
        best: list[tuple | None] = [None] * 4
        for k in range(4):
            if left.cost[i][k] < INFINITE:
                for j in range(4):
                    if right.cost[k][j] < INFINITE:
                        new = (left.cost[i][k] + right.cost[k][j], left.rank[i][k], k)
                        if best[j] is None or new < best[j]:
                            best[j] = new
        cost[i] = [b[0] if b else INFINITE for b in best]
        rope.append([b[2] if b else None for b in best])
        rank.append(_ranks([(b[1], right.rank[b[2]][j]) if b else None for j, b in enumerate(best)]))
    return Matrix(cost, rank, rope, (left, right))


class Walk:
    """A vector over the states, multiplied by one symbol's matrix after another."""

    def __init__(self) -> None:
        self.cost = [0, INFINITE, INFINITE, INFINITE]
        self.rank = [0, -1, -1, -1]
        self.path: list[tuple | None] = [(), None, None, None]  # (path before, matrix, from, to)

    def step(self, matrix: Matrix) -> None:
        best: list[tuple | None] = [None] * 4
        for i in range(4):
            if self.cost[i] < INFINITE:
                for j in range(4):
                    if matrix.cost[i][j] < INFINITE:
                        new = (self.cost[i] + matrix.cost[i][j], self.rank[i], i)
                        if best[j] is None or new < best[j]:
                            best[j] = new
        self.path = [(self.path[b[2]], matrix, b[2], j) if b else None for j, b in enumerate(best)]
        self.rank = _ranks([(b[1], matrix.rank[b[2]][j]) if b else None for j, b in enumerate(best)])
        self.cost = [b[0] if b else INFINITE for b in best]

    def end(self) -> tuple[int, str]:
        """Cost and audit of the cheapest end in an accepted state, after insertions if need be."""
        missing = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
        cost, _, state = min(
            (self.cost[j] + INSERT * n, self.rank[j], j) for j, n in missing.items() if self.cost[j] < INFINITE
        )
        pieces, path = ["I" * missing[state]], self.path[state]
        while path:
            path, matrix, i, j = path
            pieces.append(matrix.audit(i, j))
        return cost, "".join(reversed(pieces))


Grammar = list[tuple[str, str]]  # pairs, and the symbols that stand for them


def learn_grammar(texts: DataFrame, column: str, rounds: int = ROUNDS, pairs: int = PAIRS) -> Grammar:
    """Re-Pair rules of a column of symbol texts, over all rows.

    Every round counts all neighbouring pairs and names up to ``pairs`` of the most frequent ones
    that share no symbol; it ends early where no pair occurs twice. ``rounds * pairs`` bounds the
    grammar; what has no rule stays as it is.
    """
    shapes = kept(texts.groupBy(F.col(column).alias("shape")).agg(F.count("*").alias("times")))
    rules: Grammar = []
    for _ in range(rounds):
        before = len(rules)
        packed = compressed(F.col("shape"), rules)
        at = F.explode(F.sequence(F.lit(1), F.length("packed") - 1))
        seen = shapes.select(packed.alias("packed"), "times").where("length(packed) > 1")
        pair = seen.select(F.col("packed"), "times", at.alias("at")).select(
            F.expr("substring(packed, at, 2)").alias("pair"), "times"
        )
        counted = pair.groupBy("pair").agg(F.sum("times").alias("n")).where("n > 1")
        used: set[str] = set()
        for row in counted.orderBy(F.desc("n"), "pair").limit(64 * pairs).collect():
            if not used & set(row["pair"]) and len(rules) < before + pairs:
                used |= set(row["pair"])
                rules.append((row["pair"], chr(FIRST_RULE + len(rules))))
        if len(rules) == before:
            break
    return rules


def compressed(column: Column, rules: Grammar) -> Column:
    for pair, name in rules:
        column = F.replace(column, F.lit(pair), F.lit(name))
    return column


def matrices(rules: Grammar) -> dict[str, Matrix]:
    """One matrix per symbol, bottom-up: a rule's sides precede it."""
    found = {symbol: symbol_matrix(symbol) for symbol in "suaoSUAO" + GONE}
    for pair, name in rules:
        found[name] = product(found[pair[0]], found[pair[1]])
    return found


@dataclass
class Repair:
    """``rows``: the repaired conversations, row by row. ``summary``: one row per conversation.

    ``rows`` has ``conv_id``, ``place`` (from 0), ``turn`` (null if inserted), ``role``, ``text`` and
    ``edit`` (``K``, ``R`` or ``I``); every conversation lies in order in one partition. ``summary``
    has ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``.
    """

    rows: DataFrame
    summary: DataFrame


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows by conversation and turn, nulls first, each with the number of its place; a written table.

    Range partitions, so a conversation of any length is dealt over many of them.
    """
    keyed = rows.withColumn("h1", F.xxhash64("role", "text")).withColumn("copy", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "h1"]
    ranged = keyed.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*order, "copy"]])
    ordered = ranged.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in [*order, "role", "text", "copy"]])
    return kept(ordered.drop("copy").withColumn("place", F.monotonically_increasing_id()))


def _symbols(ordered: DataFrame) -> DataFrame:
    """One row per conversation and block of places: its symbols and what the counts need."""
    bare = F.btrim("text", F.lit(BLANKS))
    slim = ordered.select(
        "conv_id",
        "turn",
        "place",
        "h1",
        F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o").alias("class"),
        (F.length(bare) == 0).alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    first = slim.groupBy("conv_id", "h1", "h2").agg(F.min("place").alias("place")).select("place")
    # Every place is one row, so neither side of the join has a frequent key.
    judged = slim.join(first.withColumn("first", F.lit(True)), "place", "left").withColumns(
        {"duplicate": F.col("first").isNull() & ~F.col("blank")}
    )
    judged = judged.withColumn("truncated", F.col("cut") & F.col("first").isNotNull() & ~F.col("blank"))
    symbol = (
        F.when(F.col("blank") | F.col("duplicate"), GONE)
        .when(F.col("truncated"), F.upper("class"))
        .otherwise(F.col("class"))
    )
    in_block = F.array_sort(F.collect_list(F.struct("place", "class", symbol.alias("symbol"))))
    blocks = judged.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block")).agg(
        in_block.alias("rows"),
        *[F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).alias("turns"),
    )
    one_text = [F.array_join(F.col("rows")[c], "").alias(c) for c in ("class", "symbol")]
    return kept(blocks.select("*", *one_text).drop("rows").withColumnRenamed("class", "classes"))


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_COUNTS = ("blank", "duplicate", "truncated")


def _summaries(rules: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        state: dict = {}
        out: list[tuple] = []

        def finish() -> None:
            cost, audit = state["walk"].end()
            low, high = state["low"], state["high"]
            gaps = 0 if low is None else high - low + 1 - state["turns"]
            gaps = gaps if gaps < 1 << 63 else None
            out.append((state["id"], gaps, *state["counts"], state["illegal"], cost, audit))

        def flushed() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in out], id_type)]
            columns += [pa.array([r[k] for r in out], pa.int64()) for k in range(1, 7)]
            columns.append(pa.array([r[7] for r in out], pa.string()))
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *SUMMARY, "audit"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                classes = row["classes"]
                if not state or row["conv_id"] != state["id"]:
                    if state:
                        finish()
                    state = {"id": row["conv_id"], "walk": Walk(), "counts": [0, 0, 0], "illegal": 0}
                    state |= {"turns": 0, "low": None, "high": None, "last": ""}
                joined = state["last"] + classes
                state["illegal"] += len(joined) - 1 - sum(joined.count(pair) for pair in LEGAL)
                state["last"] = classes[-1]
                state["counts"] = [n + row[c] for n, c in zip(state["counts"], _COUNTS, strict=True)]
                if row["low"] is not None:  # turns never fall; one may go on from the block before
                    state["turns"] += row["turns"] - (row["low"] == state["high"])
                    state["low"] = row["low"] if state["low"] is None else state["low"]
                    state["high"] = row["high"]
                for symbol in row["packed"]:
                    state["walk"].step(known[symbol])
            if out:
                yield flushed()
        if state:
            finish()
            yield flushed()

    return run


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows behind the audit of their conversation become the repaired rows."""
    audit, at, last, place, role = "", 0, 0, 0, ""  # last: where the insertions at the end begin
    for batch in batches:
        out: list[tuple] = []
        ids = batch.column("conv_id")

        def emit(row: int, turn: object, text: str, edit: str, given: str = "") -> None:
            nonlocal place, role
            role = given or ("assistant" if role[:1] == "u" else "user")
            out.append((row, place, turn, role, text, edit))
            place += 1

        rows = zip(*(batch.column(c).to_pylist() for c in ("place", "turn", "role", "text")), strict=True)
        for n, (number, turn, given, text) in enumerate(rows):
            if number < 0:
                audit, at, last, place, role = text, 0, len(text.rstrip("I")), 0, ""
            else:
                while audit[at] == "I":
                    emit(n, None, "", "I")
                    at += 1
                if audit[at] != "D":
                    emit(n, turn, text, audit[at], given if audit[at] == "K" else "")
                at += 1
            while last <= at < len(audit):
                emit(n, None, "", "I")
                at += 1
        columns = [ids.take(pa.array([r[0] for r in out], pa.int32()))]
        kinds = (pa.int64(), batch.schema.field("turn").type, pa.string(), pa.string(), pa.string())
        columns += [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "turn", "role", "text", "edit"])


def repair(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> Repair:
    """The conversations with the cheapest edits that make their role initials ``(s?(ua)+)?``.

    Keeping costs 0, reroling to user or assistant 1, deleting 2, inserting an empty user or assistant
    row 5; a truncated row that stays adds 5. Blank rows (nothing but blanks) and duplicates (role and
    text seen earlier in the conversation) must go. Equal costs go to the least audit in ASCII, one
    letter per edit: ``D``, ``I``, ``K``, ``R``.

    Rows are taken by turn, nulls first; those of one turn by a hash of role and text. A null role or
    text counts as one space, a null conversation as a conversation. A role that doesn't begin with s,
    u or a can't be kept. Other columns are ignored. ``gaps`` is null where it passes 64 bits. An
    empty table gives empty tables.

    A conversation of any length is searched in parts; only its last steps, the walk over its
    compressed symbols and the repaired rows in order, are one task's, which holds its audit and a
    batch of rows.
    """
    spaced = [F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role_column, "role"), (text_column, "text"))]
    named = rows.select(F.col(f"`{conv_column}`").alias("conv_id"), F.col(f"`{turn_column}`").alias("turn"), *spaced)
    ordered = _in_order(named)
    blocks = _symbols(ordered)
    rules = learn_grammar(blocks, "symbol")
    packed = blocks.withColumn("packed", compressed(F.col("symbol"), rules)).drop("symbol")
    by_conversation = packed.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    types = dict(ordered.dtypes)
    counts = ", ".join(f"{c} long" for c in SUMMARY)
    summary = kept(by_conversation.mapInArrow(_summaries(rules), f"conv_id {types['conv_id']}, {counts}, audit string"))

    audits = summary.select(
        "conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast(types["turn"]).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"),
    )
    behind = audits.unionByName(ordered.select("conv_id", "place", "turn", "role", "text"))
    sorted_rows = behind.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = f"conv_id {types['conv_id']}, place long, turn {types['turn']}, role string, text string, edit string"
    return Repair(sorted_rows.mapInArrow(_edited, schema), summary)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, running, id_type = None, None, None
    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True)
        for conv, place, role, text in rows:
            line = f"{role}:{text}".encode()
            if place == 0:
                if running:
                    out.append((key, running.hexdigest()))
                key, running = conv, hashlib.sha256(line)
            else:
                running.update(b"\n" + line)
        yield _pairs(out, id_type)
    if running:
        yield _pairs([(key, running.hexdigest())], id_type)


def _pairs(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in out], id_type), pa.array([r[1] for r in out], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])


def digests(repaired: Repair) -> DataFrame:
    """``conv_id`` and the SHA-256 of its repaired rows, ``role:text`` joined by newlines.

    Conversations of which nothing is left aren't in it.
    """
    kind = dict(repaired.rows.dtypes)["conv_id"]
    return repaired.rows.mapInArrow(_digested, f"conv_id {kind}, repaired_sha256 string")

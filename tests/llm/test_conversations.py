"""Conversation repair against trying every sequence of edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from llm_fixtures import sf  # noqa: F401

from vectable.llm import conversation_repair
from vectable.llm.conversation_repair import compressed, digests, learn_grammar, matrices, repair
from vectable.llm.conversation_repair import Walk
from vectable.llm.queries import QUERIES

GOAL = re.compile("(s?(ua)+)?")


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else None
        found.append(fault or (None if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """Cost, audit and repaired rows: all prefixes of edits, of which each role and row keeps its best few."""
    best = {"": (0, "", ())}  # what is repaired so far, by its pattern state
    state = lambda done: done if len(done) < 2 else done[-1]

    def grown(options):
        kept = {}
        for initials, (cost, audit, out) in options:
            if not re.fullmatch("s?(ua)*u?", initials):
                continue
            key = state(initials)
            short = initials if len(initials) < 2 else ("ua" if initials[-1] == "a" else "u")
            new = (cost, audit, out)
            if key not in kept or new[:2] < kept[key][1][:2]:
                kept[key] = (short, new)
        return dict(kept.values())

    def inserted(options):
        for _ in range(2):
            options = options + [
                (i + role[0], (c + 5, a + "I", (*o, (role, ""))))
                for i, (c, a, o) in options
                for role in ("user", "assistant")
            ]
        return options

    for (_, role, text), fault in zip(rows, found, strict=True):
        options = []
        for initials, (cost, audit, out) in inserted(list(best.items())):
            options.append((initials, (cost + 2, audit + "D", out)))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                options.append((initials + role[:1], (cost + extra, audit + "K", (*out, (role, text)))))
                for new in ("user", "assistant"):
                    options.append((initials + new[0], (cost + 1 + extra, audit + "R", (*out, (new, text)))))
        best = grown(options)
    ends = [v for i, v in inserted(list(best.items())) if GOAL.fullmatch(i)]
    return min(ends, key=lambda v: v[:2])


def tried(symbols):
    """The cheapest audit of a text of symbols by trying all."""
    per_row = []
    for symbol in symbols:
        edits = [("D", 2, "")]
        if symbol != "x":
            extra = 5 * symbol.isupper()
            edits += [("K", extra, symbol.lower()), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]
        per_row.append(edits)
    gaps = ["", "u", "a", "ua", "au"]
    best = None
    for edits in product(*per_row):
        for fill in product(gaps, repeat=len(edits) + 1):
            made = fill[0] + "".join(e[2] + f for e, f in zip(edits, fill[1:], strict=True))
            if GOAL.fullmatch(made):
                cost = sum(e[1] for e in edits) + 5 * sum(map(len, fill))
                audit = "I" * len(fill[0]) + "".join(e[0] + "I" * len(f) for e, f in zip(edits, fill[1:], strict=True))
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("size", [1, 2, 3])
def test_symbols_by_trying_every_edit(size):
    known = matrices([])
    for symbols in product("suaoSUAx" if size < 3 else "suAx", repeat=size):
        walk = Walk()
        for symbol in symbols:
            walk.step(known[symbol])
        assert walk.end() == tried(symbols), symbols


def summary_of(rows):
    found = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, out = cheapest(rows, found)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[found.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def found_by(given):
    repaired = repair(given)
    hashes = {r.conv_id: r.repaired_sha256 for r in digests(repaired).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*tuple(r)[1:], hashes.get(r.conv_id, none)) for r in repaired.summary.collect()}


def made(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool"])
            text = rng.choice(["Yes.", "No!", "Why? ", "cut off", "", " \t", f"Some text {rng.random()}.", "日本."])
            rows.append((conv, None if turn == 0 and rng.random() < 0.3 else turn + rng.randint(0, 1) * 100, role, text))
    return list({(r[0], r[1]): r for r in rows}.values())  # one row a turn: ties are taken by a hash


def by_conversation(rows):
    convs = {}
    for conv, *row in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(conv, []).append(row)
    return convs


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block_bits", [12, 2])
def test_repair_against_plain_search(spark, monkeypatch, block_bits):
    """Also where conversations are cut into blocks of at most four rows."""
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", block_bits)
    rows = made(1, 120, 14)
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"{t}." if t % 7 else "open") for t in range(700)]
    given = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = {conv: summary_of(own) for conv, own in by_conversation(rows).items()}
    assert found_by(given) == expected


def test_repaired_rows_fit(spark):
    rows = made(2, 60, 9)
    repaired = repair(spark.createDataFrame(rows, SCHEMA))
    out = {}
    for r in sorted(repaired.rows.collect(), key=lambda r: (r.conv_id, r.place)):
        own = out.setdefault(r.conv_id, [])
        assert r.place == len(own) and r.edit in "KRI" and (r.edit != "I" or (r.text == "" and r.turn is None))
        own.append(r.role[0])
    assert all(GOAL.fullmatch("".join(initials)) for initials in out.values())


def test_odd_conversations(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "", "x."), (1, None, "", "x.")]
    rows += [(2, 1, "user", "Same."), (2, 1, "user", "Same."), (2, 1, "user", "Same."), (2, 2, "assistant", "Fine.")]
    rows += [(3, -(2**63), "user", "A."), (3, 2**63 - 1, "assistant", "B.")]
    given = spark.createDataFrame(rows, SCHEMA)
    for name in ("cost", "audit", "place", "h1", "symbol"):
        given = given.withColumn(name, given["text"])
    found = found_by(given)
    assert found[None][:7] == (0, 1, 0, 0, 1, 4, "DD")
    assert found[1][:7] == (0, 0, 1, 0, 1, 4, "DD")
    assert found[2][:7] == (0, 0, 2, 0, 2, 4, "KDDK")
    assert found[3][:7] == (None, 0, 0, 0, 0, 0, "KK")
    empty = repair(given.where("false"))
    assert empty.summary.count() == 0 and empty.rows.count() == 0 and digests(empty).count() == 0


def test_grammar(spark):
    shapes = spark.createDataFrame([("uauauaua",), ("suaua",), ("uAux",), ("",)], "s string").repartition(2)
    rules = learn_grammar(shapes, "s")
    assert rules[0][0] in ("ua", "au")
    packed = [r.p for r in shapes.select(compressed(shapes["s"], rules).alias("p")).collect()]
    names = dict((name, pair) for pair, name in rules)

    def spelled(text):
        return "".join(spelled(names[c]) if c in names else c for c in text)

    assert sorted(map(spelled, packed)) == sorted(["uauauaua", "suaua", "uAux", ""])
    assert min(len(p) for p in packed if p) < 4
    known = matrices(rules)
    for text in ("uauauaua", "uauAuxua", "xxuauaua"):
        plain, ruled = Walk(), Walk()
        for symbol in text:
            plain.step(known[symbol])
        packed = text
        for pair, name in rules:
            packed = packed.replace(pair, name)
        for symbol in packed:
            ruled.step(known[symbol])
        assert plain.end() == ruled.end()


def test_the_query(spark, sf):
    convs = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        own, fault = convs.setdefault(r.conv_id, []), zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        own += [(r.turn, "user" if fault == 4 else r.role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected = {conv: summary_of(rows) if rows else none for conv, rows in convs.items()}
    found = QUERIES["op12_conversation_repair"](spark, sf)
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == expected
    assert dict(found.dtypes)["gaps"] == "bigint"

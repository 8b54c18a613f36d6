"""Near-duplicate classes by exact Jaccard similarity of word shingles, over a token-group matrix.

A document's node is the hash of its shingle set, so documents with equal sets are one node.
Two sets that are similar enough share ``m`` tokens (shingles) among the first of each, in any
order common to all, if ``m - 1`` more of each are taken than one shared token needs; ``m`` grows
with the set, so chance rarely makes two documents candidates. The order here puts tokens seen
often last, so that shared passages and boilerplate rarely count. It only steers the work: any
order finds every link.

1. *Stars.* Tokens' holders are listed once. Short lists count what pairs share; of long ones every
   holder is paired with the list's hub, the holder with the largest share of frequent tokens.
   Every document is compared with its best partner. This joins most of a family of copies
   without comparing its members with each other.
2. *Groups.* Documents and their best partners, linked or not, form groups of similar documents,
   cut to a bounded size. The token-group matrix says which groups hold a token in first place;
   only pairs of groups that share enough such tokens, whose set sizes allow a link, and which
   aren't joined already, are opened. Inside, a document is first bounded by its overlap with
   the other group's token union and is compared with members only if that bound suffices.

Lists are collapsed in every task before they are shuffled: to one entry per token and group, and
where a task has many holders of a token, to their hub, with a list of their own for that task.
Hubs with many members are compared in chunks of bounded size, and compared rows are texts from
which the sets are made anew, so neither sets nor pairs of a family are ever written out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm.components import components
from vectable.llm.rolling import mix, shingle_sets, slices
from vectable.llm.scratch import kept
from vectable.llm.worker import give_back

FREQUENT_TOKENS = 400_000  # length of the list of frequent tokens that orders the rest
TOKENS_AT_ONCE = 4_000_000  # tokens that a task holds before it counts them
LISTED_AT_ONCE = 250_000  # first tokens that a task holds before it lists them
TOKENS_IN_BUCKET = 500_000  # first tokens whose lists are worked on at once
TOKENS_IN_BATCH = 50_000  # first tokens that are sent at once
TEXT_AT_ONCE = 1 << 18  # bytes of texts that are made shingles at once
PAIRS_AT_ONCE = 500_000  # pairs that a task holds before it sums them up
TOKENS_IN_GROUP = 100_000  # tokens of the documents of one group
MIN_SEEN = 2  # times that a task sees a token before it may count as frequent
SHORT_LIST = 16  # holders of a token up to which all their pairs are counted
TOKENS_PER_SHARED = 32  # set size for which one more shared token is asked for


def shared_needed(n: int) -> int:
    """How many of their first tokens two similar sets share, the smaller of which has ``n``."""
    return 1 + n // TOKENS_PER_SHARED


def _node(tokens: np.ndarray) -> int:
    """A 64-bit hash of a set; sets are sorted, so equal sets give equal sums."""
    total = mix(tokens + np.uint64(len(tokens))).sum(dtype=np.uint64)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


class Order:
    """Tokens unseen in the frequent list first, by value; then frequent ones, rare to often."""

    def __init__(self, tokens: np.ndarray, seen: np.ndarray) -> None:
        by_count = np.lexsort((tokens, seen))
        place = np.empty(len(tokens), np.int64)
        place[by_count] = np.arange(len(tokens))
        by_token = np.argsort(tokens)
        self.tokens, self.place = tokens[by_token], place[by_token]

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """The place of each token among the frequent ones, -1 if it isn't one."""
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.place[at], -1)

    def first(self, tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
        """The first tokens, of which similar sets share ``shared_needed``, and the share of frequent tokens (0..255)."""
        need = -(-percent * len(tokens) // 100)
        places = self.places(tokens)
        ordered = tokens[np.argsort(places, kind="stable")]  # the rare ones are sorted by value
        prefix = ordered[: len(tokens) - need + shared_needed(len(tokens))].copy()  # a view would hold the whole set
        return prefix, int(255 * (places >= 0).mean())


def _often(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those there ``MIN_SEEN`` times or more, and how often; ``tokens`` are sorted in their own place."""
    tokens.sort()
    again = np.zeros(max(len(tokens) - MIN_SEEN + 1, 0) + 2, bool)  # with a False at both ends
    again[1:-1] = tokens[MIN_SEEN - 1 :] == tokens[: len(again) - 2]
    first = np.flatnonzero(again[1:] & ~again[:-1])
    end = np.flatnonzero(again[:-1] & ~again[1:])
    return tokens[first], end - first + MIN_SEEN - 1


def _signatures(words: int):
    """Rows ``(doc, node, n, token, seen)``: one per document, and one per token seen again in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known, size = [], set(), 0

        def again() -> pa.RecordBatch | None:
            tokens = np.concatenate(held)
            held.clear()
            known.clear()
            tokens, seen = _often(tokens)
            return _batch(None, None, None, tokens.view(np.int64), seen)

        def _batch(doc, node, n, token, seen):
            rows = len(token) if doc is None else len(doc)
            none = pa.nulls(rows, pa.int64())
            parts = [pa.nulls(rows, kind) if doc is None else doc]
            parts += [none if x is None else pa.array(x, pa.int64()) for x in (node, n, token, seen)]
            return pa.RecordBatch.from_arrays(parts, ["doc", "node", "n", "token", "seen"])

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            nodes, sizes = [], []
            for texts in slices(batch.column(1), TEXT_AT_ONCE):
                for tokens in shingle_sets(texts, words):
                    nodes.append(_node(tokens))
                    sizes.append(len(tokens))
                    if nodes[-1] not in known:  # copies don't make a token frequent
                        known.add(nodes[-1])
                        held.append(tokens)
                        size += len(tokens)
                if size >= TOKENS_AT_ONCE:
                    yield again()
                    size = 0
            yield _batch(batch.column(0), nodes, sizes, None, None)
        if size:
            yield again()
        give_back()

    return run


def _postings(words: int, percent: int, order, buckets: int):
    """Text rows, or ``(text, group, root)`` rows, to packed lists by token bucket; see ``_packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Order(*order.value).first
        held: list[tuple[np.ndarray, int, int, int, int]] = []
        size = 0
        for batch in batches:
            known = batch.num_columns > 1
            for texts in slices(batch.column(0), TEXT_AT_ONCE):
                for i, tokens in enumerate(shingle_sets(texts, words)):
                    if not len(tokens):
                        continue
                    prefix, hub = first(tokens, percent)
                    node = _node(tokens)
                    group, root = node, node
                    if known:
                        row = texts.first_row + i
                        group, root = batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
                    held.append((prefix, group, root, len(tokens), hub))
                    size += len(prefix)
                if size >= LISTED_AT_ONCE:
                    yield from _packed(held, buckets, known)
                    size = 0
        if held:
            yield from _packed(held, buckets, known)
        give_back()

    return run


FIELDS = ("token", "node", "root", "low", "high", "hub")
TYPES = dict(zip(FIELDS, (np.uint64, np.int64, np.int64, np.int32, np.int32, np.uint8), strict=True))
PACKED = "bucket int, " + ", ".join(f"{f} binary" for f in FIELDS)


def _packed(held, buckets: int, known: bool) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its tokens with their groups, each (token, group) once. ``held`` is emptied.

    Where groups aren't known yet, a list of many holders is left to its hub, marked by
    ``high > low``; all of them get a list under a token made up for this task and hub, and have
    the hub as ``root``.
    """
    repeat = [len(x[0]) for x in held]
    entries = {
        "token": np.concatenate([x[0] for x in held]),
        "node": np.repeat(np.array([x[1] for x in held], np.int64), repeat),
        "root": np.repeat(np.array([x[2] for x in held], np.int64), repeat),
        "low": np.repeat(np.array([x[3] for x in held], np.int32), repeat),
        "hub": np.repeat(np.array([x[4] for x in held], np.uint8), repeat),
    }
    entries["high"] = entries["low"]
    held.clear()
    entries = _collapsed(entries)
    if not known:
        entries = _left_to_hubs(entries)
    bucket = (mix(entries["token"]) % np.uint64(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    numbers, starts = np.unique(bucket[by], return_index=True)
    ends = np.append(starts[1:], len(by))
    row = 0
    while row < len(numbers):
        end = max(int(np.searchsorted(ends, starts[row] + TOKENS_IN_BATCH, side="right")), row + 1)
        columns = [pa.array(numbers[row:end], pa.int32())]
        for f in FIELDS:
            values = entries[f][by[starts[row] : ends[end - 1]]].astype(TYPES[f])
            cuts = zip(starts[row:end] - starts[row], ends[row:end] - starts[row], strict=True)
            columns.append(pa.array([_binary(values[a:b]) for a, b in cuts], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *FIELDS])
        row = end


def _collapsed(entries: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Sorted by token and group, each pair once, with the smallest and largest set size of the group."""
    by = np.lexsort((entries["node"], entries["token"]))
    token, node = entries["token"][by], entries["node"][by]
    new = np.ones(len(by), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return {f: entries[f][:0] for f in FIELDS}
    return {
        "token": token[at],
        "node": node[at],
        "root": entries["root"][by][at],
        "low": np.minimum.reduceat(entries["low"][by], at),
        "high": np.maximum.reduceat(entries["high"][by], at),
        "hub": np.maximum.reduceat(entries["hub"][by], at),
    }


def _left_to_hubs(entries: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    token = entries["token"]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    counts = np.diff(np.append(starts, len(token)))
    long = counts > SHORT_LIST
    if not long.any():
        return entries
    rows = _ragged(starts[long], counts[long])
    lists = np.repeat(np.arange(int(long.sum())), counts[long])
    hub = np.repeat(_hubs(entries, rows, lists, counts[long]), counts[long])
    entries["high"][hub] = entries["low"][hub] + 1
    star = {f: entries[f][rows] for f in FIELDS}
    task = np.uint64(zlib.crc32(token.tobytes()))
    star["token"] = mix(entries["node"][hub].view(np.uint64) ^ task)
    star["root"] = entries["node"][hub]
    star["high"] = star["low"]
    stay = np.ones(len(token), bool)
    stay[rows] = False
    stay[hub] = True
    star = _collapsed(star)
    return {f: np.concatenate([entries[f][stay], star[f]]) for f in FIELDS}


def _hubs(entries: dict[str, np.ndarray], rows: np.ndarray, lists: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each list the entry with the largest share of frequent tokens, then the smallest node."""
    by = np.lexsort((entries["node"][rows], -entries["hub"][rows].astype(np.int64), lists))
    return rows[by][np.cumsum(counts) - counts]


def _lists(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The bucket's entries of tokens with two groups or more, and where each list begins and ends."""
    entries = {
        f: np.concatenate([np.frombuffer(x.as_buffer(), TYPES[f]) for x in table.column(f)]) for f in FIELDS
    }
    entries = _collapsed(entries)
    token = entries["token"]
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, int)
    ends = np.append(starts[1:], len(token))
    return entries, starts[ends - starts > 1], ends[ends - starts > 1]


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of one of each distinct combination, and how often it occurs."""
    by = np.lexsort(columns)
    if not len(by):
        return by, by
    new = np.append(True, np.logical_or.reduce([c[by][1:] != c[by][:-1] for c in columns]))
    at = np.flatnonzero(new)
    return by[at], np.diff(np.append(at, len(by)))


def _pairs_within(starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The entries of lists in pairs: those 1 apart, 2 apart, and so on."""
    apart = 1
    while True:
        live = counts > apart
        starts, counts = starts[live], counts[live]
        if not len(starts):
            return
        left = _ragged(starts, counts - apart)
        yield left, left + apart
        apart += 1


def _stars(percent: int):
    """``(node, n, hub, hub_n, shared, near)``: pairs that their sizes allow, and how many lists show them.

    Rows without a hub are nodes of long lists, of which not all pairs are shown; ``near`` is a hub
    of such a list, whatever its size.
    """

    def run(table: pa.Table) -> pa.Table:
        entries, starts, ends = _lists(table)
        counts = ends - starts
        node, n, hub_share = entries["node"], entries["low"].astype(np.int64), entries["hub"]
        marked = (entries["high"] > entries["low"]) | (entries["root"] != entries["node"])
        sums = np.append(0, np.cumsum(marked))
        long = (counts > SHORT_LIST) | (sums[ends] > sums[starts])
        found = _Pairs(5)

        def show(hub: np.ndarray, member: np.ndarray) -> None:
            fits = (hub != member) & (
                100 * np.minimum(n[hub], n[member]) >= percent * np.maximum(n[hub], n[member])
            )
            hub, member = hub[fits], member[fits]
            found.add(node[hub], node[member], np.ones(len(hub), np.int64), n[hub], n[member])

        for left, right in _pairs_within(starts[~long], counts[~long]):
            first = (hub_share[left] > hub_share[right]) | (
                (hub_share[left] == hub_share[right]) & (node[left] < node[right])
            )
            show(np.where(first, left, right), np.where(first, right, left))
        rows = _ragged(starts[long], counts[long])
        lists = np.repeat(np.arange(int(long.sum())), counts[long])
        near = np.repeat(_hubs(entries, rows, lists, counts[long]), counts[long])
        show(near, rows)
        hub, member, shared, hub_n, member_n = found.summed().T
        first = _distinct(node[rows])[0]
        alone, near = rows[first], near[first]
        none = pa.nulls(len(alone), pa.int64())
        pairs = pa.table(
            {
                "node": pa.array(np.concatenate([member, node[alone]])),
                "n": pa.array(np.concatenate([member_n, n[alone]])),
                "hub": pa.chunked_array([pa.array(hub, pa.int64()), none]),
                "hub_n": pa.chunked_array([pa.array(hub_n, pa.int64()), none]),
                "shared": pa.array(np.concatenate([shared, np.zeros(len(alone), np.int64)])),
                "near": pa.chunked_array([pa.nulls(len(hub), pa.int64()), pa.array(node[near], pa.int64())]),
            }
        )
        del found, hub, member, shared, hub_n, member_n, entries, node, n
        give_back()
        return pairs

    return run


def _group_pairs(percent: int):
    """``(left, right, shared, least)``: groups of different components that share first tokens and may
    link by size, how many they share, and the size of the smallest set of both."""

    def run(table: pa.Table) -> pa.Table:
        entries, starts, ends = _lists(table)
        low, high = entries["low"].astype(np.int64), entries["high"].astype(np.int64)
        found = _Pairs(4)
        for left, right in _pairs_within(starts, ends - starts):
            fits = (100 * high[right] >= percent * low[left]) & (100 * high[left] >= percent * low[right])
            fits &= entries["root"][left] != entries["root"][right]
            left, right = left[fits], right[fits]
            nodes = entries["node"][left], entries["node"][right]  # in order of node within a list
            found.add(*nodes, np.ones(len(left), np.int64), np.minimum(low[left], low[right]))
        pairs = pa.table({f: pa.array(x) for f, x in zip(("left", "right", "shared", "least"), found.summed().T, strict=True)})
        del found, entries, low, high
        give_back()
        return pairs

    return run


class _Pairs:
    """Rows of two names, a number to be added up and further ones of which the least counts, each pair once.

    New rows are held until they are ``PAIRS_AT_ONCE``, or as many as the pairs already known.
    """

    def __init__(self, columns: int) -> None:
        self.parts, self.held, self.known = [np.zeros((0, columns), np.int64)], 0, 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(np.stack(columns, 1))
        self.held += len(columns[0])
        if self.held > max(PAIRS_AT_ONCE, self.known):
            self.summed()

    def summed(self) -> np.ndarray:
        pairs = np.concatenate(self.parts)
        self.parts.clear()
        pairs = _summed_pairs(pairs)
        self.parts, self.held, self.known = [pairs], 0, len(pairs)
        return pairs


def _summed_pairs(pairs: np.ndarray) -> np.ndarray:
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    if not len(pairs):
        return pairs
    at = np.flatnonzero(np.append(True, (pairs[1:, :2] != pairs[:-1, :2]).any(1)))
    shared, least = np.add.reduceat(pairs[:, 2], at), np.minimum.reduceat(pairs[:, 3:], at)
    return np.column_stack([pairs[at, :2], shared, least])


def _compare(words: int, percent: int):
    """Links between documents of the two sides of a key, or of its only side, with different roots.

    Of links that join what earlier ones of the same key have joined, none is returned.
    """

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        nodes = table.column("node").to_numpy()
        roots = table.column("root").to_numpy()
        sets: tuple[dict, dict] = ({}, {})
        root_of: dict[int, int] = {}
        for texts in slices(table.column("text"), TEXT_AT_ONCE):
            for i, tokens in enumerate(shingle_sets(texts, words)):
                row = texts.first_row + i
                node = int(nodes[row])
                if len(tokens) and _node(tokens) == node:  # else a row that repeats the id
                    sets[side[row]][node] = tokens
                    root_of[node] = int(roots[row])
        few, many = sorted(sets, key=len) if (side == 1).any() else (sets[0], sets[0])
        joined: dict[int, int] = {}

        def find(root: int) -> int:
            while root in joined:
                root = joined[root]
            return root

        links = []
        if few and many:
            names = np.array(list(many), np.int64)
            sizes = np.array([len(t) for t in many.values()])
            every = np.concatenate(list(many.values()))
            owner = np.repeat(np.arange(len(names)), sizes)
            by = np.argsort(every)
            every, owner = every[by], owner[by]
            for node, tokens in few.items():
                low, high = np.searchsorted(every, tokens), np.searchsorted(every, tokens, side="right")
                if 100 * np.count_nonzero(high > low) < percent * len(tokens):
                    continue  # too little of it is in the union
                shared = np.bincount(owner[_ragged(low, high - low)], minlength=len(names))
                linked = names[100 * shared >= percent * (len(tokens) + sizes - shared)]
                for other in linked.tolist():
                    mine, yours = find(root_of[node]), find(root_of[other])
                    if mine != yours:
                        joined[yours] = mine
                        links.append((node, other))
        return pa.table(
            {"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())}
        )

    return run


def _compared(sides: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of ``(key, side, node, root)`` rows."""
    opened = sides.join(texts, "node").select("key", "side", "node", "root", "text")
    return opened.groupBy("key").applyInArrow(_compare(words, percent), "a long, b long")


def similar_classes(
    docs: DataFrame,
    words: int = 5,
    percent: int = 75,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when 100 times their common shingles is at least ``percent`` times those of
    both; ``component_id`` is the smallest id reachable over links, the document's own included.
    Shingles are ``words`` words of the text with A-Z lower-cased; a shorter text is one shingle.
    Null texts and texts without words have none and link with nothing. Rows are documents of
    their own, also where an id repeats; null ids are larger than any. Other columns are not
    returned. An empty table gives no rows.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    kind = dict(given.dtypes)["doc"]
    seen = kept(given.mapInArrow(_signatures(words), f"doc {kind}, node long, n long, token long, seen long"))
    signatures = seen.where("node IS NOT NULL").select("doc", "node", "n")
    order = _order(spark, seen)

    total = signatures.agg(F.sum(F.expr(f"n - ceil(n * {percent} / 100) + 1 + n DIV {TOKENS_PER_SHARED}"))).first()[0] or 0
    buckets = max(1, int(-(-total // TOKENS_IN_BUCKET)))
    lists = given.select("text").mapInArrow(_postings(words, percent, order, buckets), PACKED)
    pairs = (
        lists.groupBy("bucket")
        .applyInArrow(_stars(percent), "node long, n long, hub long, hub_n long, shared long, near long")
        .groupBy("node", "hub")
        .agg(
            F.sum("shared").alias("shared"),
            F.max("n").alias("n"),
            F.max("hub_n").alias("hub_n"),
            F.min("near").alias("near"),
        )
    )
    enough = F.expr(f"shared >= 1 + least(n, hub_n) DIV {TOKENS_PER_SHARED}")
    pairs = kept(pairs.where(F.col("hub").isNull() | enough))
    best = F.max(F.when(F.col("hub").isNotNull(), F.struct("shared", "hub"))).alias("best")
    partners = pairs.groupBy("node").agg(best, F.max("n").alias("n"), F.min("near").alias("near"))
    partners = partners.select("node", "n", F.col("best.hub").alias("hub"), "near")
    stars = partners.where("hub IS NOT NULL")

    # Texts of all documents that may link with another one.
    active = pairs.select("node").unionByName(pairs.where("hub IS NOT NULL").select(F.col("hub").alias("node"))).distinct()
    holders = signatures.groupBy("node").agg(F.min("doc").alias("doc")).join(active, "node")
    texts = kept(
        given.join(holders.withColumnRenamed("doc", "holder"), F.col("doc").eqNullSafe(F.col("holder"))).select(
            "node", "text"
        )
    )

    chunks = stars.groupBy("hub").agg(F.ceil(F.sum("n") / TOKENS_IN_GROUP).cast("int").alias("chunks"))
    chunked = stars.join(chunks, "hub").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    key = F.struct("hub", "chunk").alias("key")
    members = chunked.select(key, F.lit(1).alias("side"), "node", F.col("node").alias("root"))
    hubs = chunked.select(key, F.lit(0).alias("side"), F.col("hub").alias("node"), F.col("hub").alias("root"))
    links = kept(_compared(members.unionByName(hubs.distinct()), texts, words, percent))

    # Groups: documents with their best partners, or with the hub of a list they are in, by size of
    # their sets, cut to a bounded number of tokens. A document alone is its own group.
    n_of = signatures.groupBy("node").agg(F.max("n").alias("n"))
    close = partners.select("node", F.coalesce("hub", "near").alias("other"))
    clusters = components(close, "node", "other").withColumnRenamed("root", "cluster")
    joined = components(links)
    grouped = active.join(n_of, "node").join(clusters, "node", "left").join(joined, "node", "left")
    grouped = kept(
        grouped.select(
            "node",
            "n",
            F.coalesce("cluster", "node").alias("cluster"),
            F.floor(F.log(100 / percent, F.col("n"))).alias("size"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    parts = grouped.groupBy("cluster", "size").agg(F.ceil(F.sum("n") / TOKENS_IN_GROUP).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    grouped = kept(
        grouped.join(parts, ["cluster", "size"]).select(
            "node", "root", F.xxhash64("cluster", "size", part.cast("int")).alias("group")
        )
    )
    groups = grouped.groupBy("group").agg(F.min("root").alias("one"), F.max("root").alias("other"))
    mixed = F.col("one") != F.col("other")
    # A group of one root may be skipped with others of that root; a mixed one may not.
    tags = groups.select("group", F.when(mixed, F.xxhash64("group", F.lit("mixed"))).otherwise(F.col("one")).alias("tag"))
    placed = grouped.join(tags, "group").select("node", "group", "tag")
    matrix = (
        texts.join(placed, "node")
        .select("text", "group", "tag")
        .mapInArrow(_postings(words, percent, order, buckets), PACKED)
    )
    opened = (
        matrix.groupBy("bucket")
        .applyInArrow(_group_pairs(percent), "left long, right long, shared long, least long")
        .groupBy("left", "right")
        .agg(F.sum("shared").alias("shared"), F.min("least").alias("least"))
    )
    opened = opened.where(F.expr(f"shared >= 1 + least DIV {TOKENS_PER_SHARED}")).select("left", "right")
    within = groups.where(mixed).select(F.col("group").alias("left"), F.col("group").alias("right"))
    opened = kept(opened.unionByName(within))
    key = F.struct("left", "right").alias("key")
    sides = opened.select(key, F.lit(0).alias("side"), F.col("left").alias("group")).unionByName(
        opened.where("left <> right").select(key, F.lit(1).alias("side"), F.col("right").alias("group"))
    )
    members = sides.join(grouped, "group").select("key", "side", "node", "root")
    more = kept(_compared(members, texts, words, percent))
    roots = components(links.unionByName(more))

    # Copies of a text, or texts of a component, that would fill a task are joined by broadcast.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = signatures.count() // tasks
    by_node = signatures.groupBy("node").agg(
        F.count("*").alias("rows"), F.min(F.when(F.col("n") > 0, F.col("doc"))).alias("smallest")
    )
    by_node = kept(by_node.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    by_root = by_node.groupBy("root").agg(F.min("smallest").alias("component"), F.count("*").alias("rows"))
    placed = kept(_with(by_node, by_root, "root", share).select("node", "component", "rows"))
    result = _with(signatures, placed, "node", share)
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc"))
    return result.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def _with(many: DataFrame, one: DataFrame, key: str, share: int) -> DataFrame:
    """``many`` with the one row of its ``key`` in ``one``, whose ``rows`` says how many of ``many`` it meets.

    Keys of more than ``share`` rows are broadcast: with ``share`` a task's part of all rows, they are
    fewer than the tasks.
    """
    one = one.withColumnRenamed("rows", "meets")
    hot = F.broadcast(one.where(F.col("meets") > share))
    rest = many.join(hot.select(key), key, "left_anti").join(one.where(F.col("meets") <= share), key)
    return many.join(hot, key).unionByName(rest).drop("meets")


def one_of_each_class(
    docs: DataFrame, words: int = 5, percent: int = 75, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without near copies: of each class of ``similar_classes`` the smallest id stays.

    Documents without shingles stay. Rows with equal ids stay or go together, and of rows that
    repeat both id and text one stays. Columns are those of ``docs``.
    """
    classes = similar_classes(docs, words, percent, id_column, text_column)
    stay = classes.where("component_id <=> doc_id").groupBy(F.col("doc_id").alias("stays"))
    stay = stay.agg((F.count("*") > 1).alias("repeats"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = row.join(stay, F.col(f"row.`{id_column}`").eqNullSafe(F.col("stays")))
    # Only rows of repeated ids are compared, by a hash of 128 bits in place of the text.
    text = F.col(f"row.`{text_column}`")
    hashes = [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]
    again = rows.where("repeats").select("row", "stays", text.isNull().alias("none"), *hashes)
    alone = rows.where("NOT repeats").select("row")
    return alone.unionByName(again.dropDuplicates(["stays", "none", "h1", "h2"]).select("row")).select("row.*")


def _order(spark: SparkSession, seen: DataFrame):
    """Broadcast: the most frequent tokens, at most ``FREQUENT_TOKENS`` of them.

    Two small histograms find them: of counts, in steps of a 32nd of a doubling, and of the tokens
    (hashes) of the step that fits in part.
    """
    often = seen.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
    often = kept(often.withColumn("step", F.floor(32 * F.log2("seen")).cast("int")))
    part = F.shiftrightunsigned("token", 52).cast("int")
    steps = often.groupBy("step").count().orderBy(F.desc("step")).collect()  # 2,016 at most
    room, least = FREQUENT_TOKENS, None
    chosen = F.lit(False)
    for r in steps:
        if r["count"] > room:
            parts = often.where(F.col("step") == r["step"]).groupBy(part.alias("part")).count().orderBy("part")
            end = 0
            for p in parts.collect():  # 4,096 at most
                if p["count"] > room:
                    break
                room, end = room - p["count"], p["part"] + 1
            chosen = (F.col("step") == r["step"]) & (part < end)
            break
        room, least = room - r["count"], r["step"]
    if least is not None:
        chosen = chosen | (F.col("step") >= least)
    top = often.where(chosen).select("token", "seen").toArrow()
    token = top.column("token").to_numpy().view(np.uint64) if top.num_rows else np.zeros(0, np.uint64)
    return spark.sparkContext.broadcast((token, top.column("seen").to_numpy()))

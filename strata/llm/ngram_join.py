"""Similarity join on word shingles by T-occurrence search with DivideSkip.

Two documents link when the Jaccard similarity of their sets of distinct
``SHINGLE``-word shingles is at least ``PERCENT``.  A partner of a set of n
shares at least T = ceil(PERCENT * n) shingles with it, so among its
``n - T + l`` rarest shingles (its short lists) it meets every partner at
least l times; the other, long lists are only probed.

1. Documents with equal sets form one node, named by a 64-bit digest.
2. Shingles whose hash lies in a fixed range are shuffled to count in how many
   nodes they occur; the global order puts them first, rarest first, and the
   rest by hash.  A node whose short lists all have one entry is done here:
   that is most of them.
3. Each short list (sorted by set size, cut where sizes differ too much) first
   gives star candidates: every node with the foremost pivot of its lists.  Verified ones are
   contracted by connected components, so a large group of near copies costs
   about as many checks as it has members.
4. DivideSkip for what is left: nodes in different components.
   Nodes that meet in a short list of over ``DENSE`` entries are searched in
   blocks: nodes connected by such lists, cut into chunks of bounded size,
   every two chunks that are not of one component in a task of their own.
   There each set merges its shorter lists by counting, keeps entries that can
   still reach T, and probes the longer lists by binary search.
   Elsewhere each node heap-merges its short lists, keeps entries met l times,
   and probes the candidate's sorted set, stopping when the required overlap
   is out of reach.
5. Connected components of all links give the groups.
6. For the numbers of links the searches of step 4 run once more over all
   pairs, without components: blocks count their links inside their tasks.

Every pair of different sets that link is either found or already joined by
found links, so the components are exact, and step 6 meets every linked pair
once, so the numbers of links are too (up to 64-bit hash collisions).

Defined results: null, empty and wordless texts have empty sets and stand
alone; equal rows share a node; rows that share an id count by their texts;
null ids come last and a component of such rows only has a null id; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import Store, connected_components
from strata.llm.suffix_dedup import _changes, keyed, width
from strata.llm.textops import RangeHash, key_chunks, mix, word_chunks

SHINGLE = 5
PERCENT = 80
#: Entries that two short lists' owners must share (1 for sets under SMALL).
SHARED, SMALL = 3, 16
#: Share of the hash range in which shingles are counted, of 16.
COUNTED = 6
STAR_ROUNDS = 2
#: Short lists above this many entries are searched in blocks.
DENSE = 32
#: Shingles in a chunk of a block (8 bytes each).
CHUNK_SHINGLES = 2_000_000
#: Pairs of a block that are held at once.
PART_PAIRS = 1 << 20
#: Nodes that a task remembers in order not to send a copied set again (an economy only).
REMEMBERED = 500_000

_COUNTED_BELOW = np.uint64(COUNTED << 60)


def needed(n):
    """Least overlap of a set of n with any partner (arrays or numbers)."""
    return -(-(PERCENT * n) // 100)


def shared(n):
    return np.where(n < SMALL, 1, SHARED)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of every document, by chunks."""
    for i, j, words in word_chunks(column, lower=True):
        hashes = RangeHash(words.hash)
        at = np.arange(max(0, len(words) - SHINGLE + 1))
        every = hashes(at, at + SHINGLE)
        out = []
        for d in range(j - i):
            a, b = words.first[d], words.first[d + 1]
            if b - a >= SHINGLE:
                out.append(np.unique(every[a : b - SHINGLE + 1]))
            elif b > a:
                out.append(hashes(np.array([a]), np.array([b])))
            else:
                out.append(np.zeros(0, np.uint64))
        yield i, out


def digest(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(mix(np.array([mix(tokens + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, sets in shingle_sets(batch.column("text")):
            names = pa.array([digest(s) if len(s) else None for s in sets], pa.int64())
            part = batch.slice(i, len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("oid"), part.column("tie"), names, pa.array([len(s) for s in sets], pa.int64())], ["doc_id", "oid", "tie", "node", "n"]
            )


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the counted range, and of the others as many as the short lists still need."""
    seen: set[int] = set()
    for batch in batches:
        for _, sets in shingle_sets(batch.column("text")):
            tokens, nodes, sizes, lows = [], [], [], []
            for s in sets:
                if not len(s):
                    continue
                name = digest(s)
                if name in seen:
                    continue
                seen.add(name)
                if len(seen) > REMEMBERED:
                    seen.clear()
                n = len(s)
                low = int(np.searchsorted(s, _COUNTED_BELOW))
                take = max(low, min(n, n - int(needed(n)) + int(shared(n))))
                tokens.append(s[:take])
                nodes.append(np.full(take, name))
                sizes.append(np.full(take, n, np.int32))
                lows.append(np.full(take, low, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in ([t.view(np.int64) for t in tokens], nodes, sizes, lows)], ["token", "node", "n", "low"]
                )


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of shingles that several nodes hold, with the number of nodes."""
    for table in key_chunks(batches, ["token"], 1 << 18):
        token, node, n, low = (table.column(c).to_numpy() for c in ("token", "node", "n", "low"))
        order = np.lexsort((node, token))
        order = order[_changes(token[order], node[order])]
        token, node, n, low = (x[order] for x in (token, node, n, low))
        group = np.cumsum(_changes(token)) - 1
        df = np.bincount(group)[group]
        keep = df > 1
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (node, token, n, low, df)], ["node", "token", "n", "low", "df"])


def _short_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every node's frequent shingles, those on its short lists."""
    for table in key_chunks(batches, ["node"], 1 << 18):
        node, token, n, low, df = (table.column(c).to_numpy() for c in ("node", "token", "n", "low", "df"))
        hashed = token.view(np.uint64)
        counted = hashed < _COUNTED_BELOW
        # global order: counted shingles by (df, hash), then the others by hash
        order = np.lexsort((hashed, np.where(counted, df, 0), ~counted, node))
        node, token, n, low, counted = (x[order] for x in (node, token, n, low, counted))
        new = _changes(node)
        group = np.cumsum(new) - 1
        place = np.arange(len(node)) - np.flatnonzero(new)[group]
        frequent = np.bincount(group, counted)[group]
        alone = low - frequent  # counted shingles that no other node holds come first
        keep = ~counted | (place < n - needed(n) + shared(n) - alone)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, node, n)], ["token", "node", "n"])


def _segments(token: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Segment number of rows sorted by (token, n): a list is cut where no pair across can link."""
    cut = _changes(token)
    cut[1:] |= needed(n[1:]) > n[:-1]
    return np.cumsum(cut) - 1


def _stars(round_: int):
    """Candidates of every node with its list's pivot, where components differ."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_chunks(batches, ["token"], 1 << 18):
            token, node, n, label = (table.column(c).to_numpy() for c in ("token", "node", "n", "label"))
            rank = node if round_ == 0 else mix(node.view(np.uint64) + np.uint64(round_)).view(np.int64)
            order = np.lexsort((rank, n, token))
            segment = _segments(token[order], n[order])
            best = order[np.lexsort((rank[order], segment))]
            segment = np.sort(segment)
            pivot = best[_changes(segment)][segment]
            differs = label[best] != label[pivot]
            a, b = node[best[differs]], node[pivot[differs]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(rank[pivot[differs]])], ["a", "b", "rank"])

    return work


def _dense_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of every open list of over ``DENSE`` entries, tied to the list's first."""
    for table in key_chunks(batches, ["token"], 1 << 18):
        token, node, n, label = (table.column(c).to_numpy() for c in ("token", "node", "n", "label"))
        order = np.lexsort((n, token))
        segment = _segments(token[order], n[order])
        ends = np.flatnonzero(np.diff(segment, append=-1))
        pairs = []
        for rows in np.split(order, ends[:-1] + 1):
            if len(rows) > DENSE and (label[rows] != label[rows[0]]).any():
                ids = np.unique(node[rows])
                pairs.append(np.stack([ids, np.full(len(ids), ids[0])], axis=1))
        if pairs:
            both = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _chunk_links(batches: Iterator[pa.RecordBatch], contract: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """DivideSkip between the two chunks of a task (or within one): ends of its links, in parts."""
    for table in key_chunks(batches, ["task"], 1):
        for rows in _groups(table.column("task").to_numpy()):
            part = table.take(pa.array(rows)).combine_chunks()
            side, node, label = (part.column(c).to_numpy() for c in ("side", "node", "label"))
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("tokens").combine_chunks()]
            here = np.flatnonzero(side == 0)
            ask = np.flatnonzero(side == 1)
            alone = not len(ask)  # one chunk against itself
            ask = here if alone else ask
            for a, b in divide_skip_parts([sets[k] for k in here], label[here], [sets[k] for k in ask], label[ask], alone, contract):
                yield node[here[a]], node[ask[b]]


def _search_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join all nodes which the task's links join: fewer than it has nodes."""
    for a, b in _chunk_links(batches, True):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every node, without emitting them."""
    for a, b in _chunk_links(batches, False):
        ids, count = np.unique(np.concatenate([a, b]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(count, pa.int64())], ["node", "n_links"])


def _groups(key: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(key, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(key[order])) + 1)


def divide_skip(index: list[np.ndarray], index_label: np.ndarray, queries: list[np.ndarray], query_label: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Linked (index, query) pairs of different labels; with ``same``, each pair once."""
    return [pair for a, b in divide_skip_parts(index, index_label, queries, query_label, same) for pair in zip(a.tolist(), b.tolist(), strict=True)]


def divide_skip_parts(index: list[np.ndarray], index_label: np.ndarray, queries: list[np.ndarray], query_label: np.ndarray, same: bool, contract: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of ``divide_skip`` as arrays of bounded size.

    With ``contract`` linked sets take one label as soon as they are found, so
    that nothing is compared within a group that is joined already: what comes
    out is a spanning forest of the links.
    """
    if contract:
        index_label = index_label.copy()
        query_label = index_label if same else query_label.copy()
    size = np.array([len(x) for x in index])
    owner = np.repeat(np.arange(len(index)), size)
    token = np.concatenate(index)
    order = np.argsort(token, kind="stable")  # owners ascend within a list
    token, owner = token[order], owner[order]
    out, held = [], 0
    for q, mine in enumerate(queries):
        n = len(mine)
        least = int(needed(n))
        start, stop = np.searchsorted(token, mine, "left"), np.searchsorted(token, mine, "right")
        length = stop - start
        by_length = np.argsort(length, kind="stable")
        n_long = least // 2  # lists that are probed only
        short, long_ = by_length[: n - n_long], by_length[n - n_long :]
        short = short[length[short] > 0]
        if not len(short):
            continue
        merged = np.concatenate([owner[start[k] : stop[k]] for k in short])
        met = np.bincount(merged, minlength=len(index))
        fits = (met >= least - n_long) & (index_label != query_label[q]) & (100 * size >= PERCENT * n) & (100 * n >= PERCENT * size)
        if same:
            fits[: q + 1] = False
        entry = np.flatnonzero(fits)
        met = met[entry]
        bound = -(-(PERCENT * (n + size[entry])) // (100 + PERCENT))  # overlap that the pair needs
        for done, k in enumerate(long_):
            if not len(entry):
                break
            if length[k]:
                place = start[k] + np.searchsorted(owner[start[k] : stop[k]], entry)
                met = met + ((place < stop[k]) & (owner[np.minimum(place, len(owner) - 1)] == entry))
            if done % 8 == 7:
                keep = met + (n_long - done - 1) >= bound
                entry, met, bound = entry[keep], met[keep], bound[keep]
        entry = entry[met >= bound]
        if contract and len(entry):
            joined, first = np.unique(index_label[entry], return_index=True)
            entry, mine = entry[first], query_label[q]
            index_label[np.isin(index_label, joined)] = mine
            if not same:
                query_label[np.isin(query_label, joined)] = mine
        if len(entry):
            out.append((entry, np.full(len(entry), q)))
            held += len(entry)
        if held >= PART_PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*out, strict=True))
            out, held = [], 0
    if out:
        yield tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _blocks(marked: DataFrame, store: Store) -> DataFrame:
    """``node, label``: nodes connected by dense lists."""
    return connected_components(store(marked.mapInArrow(_dense_stars, "a long, b long"), "dense_stars"), store)


def _block_search(marked: DataFrame, blocks: DataFrame, sets: DataFrame, store: Store, n: int) -> DataFrame:
    """Sets of the chunk pairs of every block, by task."""
    rows = blocks.select("node", F.col("label").alias("block")).join(marked.select("node", "n", "label").distinct(), "node")
    # chunks of bounded size in the order of components; no set is moved for this
    ahead = Window.partitionBy("block").orderBy("label", "node").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("chunk", F.floor(F.coalesce(F.sum("n").over(ahead), F.lit(0)) / CHUNK_SHINGLES).cast("int"))
    rows = store(rows, "block_chunks")
    chunks = rows.groupBy("block", "chunk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    left, right = chunks.alias("l"), chunks.alias("r")
    one = (F.col("l.lo") == F.col("l.hi")) & (F.col("r.lo") == F.col("r.hi")) & (F.col("l.lo") == F.col("r.lo"))
    tasks = left.join(right, (F.col("l.block") == F.col("r.block")) & (F.col("l.chunk") <= F.col("r.chunk")) & ~one).select(
        F.col("l.block").alias("block"), F.col("l.chunk").alias("i"), F.col("r.chunk").alias("j"), F.xxhash64("l.block", "l.chunk", "r.chunk").alias("task")
    )
    sides = tasks.select("block", F.col("i").alias("chunk"), "task", F.lit(0).alias("side")).unionByName(
        tasks.filter("i < j").select("block", F.col("j").alias("chunk"), "task", F.lit(1).alias("side"))
    )
    dealt = rows.join(sides, ["block", "chunk"]).join(sets, "node").select("task", "side", "node", "label", "tokens")
    return dealt.repartition(n, "task").sortWithinPartitions("task", "side", "node")


def _lists_by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short lists dealt to the nodes that still have to search: ``query, entries``.

    Of two entries of different components the one with the smaller id asks, in
    every list that they share: all meetings of a pair count in one query.
    """
    for table in key_chunks(batches, ["token"], 1 << 18):
        token, node, n, label = (table.column(c).to_numpy() for c in ("token", "node", "n", "label"))
        order = np.lexsort((n, token))
        segment = _segments(token[order], n[order])
        sparse = np.bincount(segment, minlength=1)[segment] <= DENSE  # the others are searched in blocks
        order, segment = order[sparse], segment[sparse]
        by_id = np.lexsort((node[order], segment))
        ids, size, kin, segment = node[order][by_id], n[order][by_id], label[order][by_id], segment[by_id]
        askers, entries = [], []
        for step in range(1, min(DENSE, len(ids))):  # every entry with the one `step` places behind it in its list
            ask = np.flatnonzero((segment[step:] == segment[:-step]) & (kin[step:] != kin[:-step]))
            near = (size[ask] * 100 >= PERCENT * size[ask + step]) & (size[ask + step] * 100 >= PERCENT * size[ask])
            askers.append(ask[near])
            entries.append(ids[ask[near] + step])
        if not sum(map(len, askers)):
            continue
        asker, entry = np.concatenate(askers), np.concatenate(entries)
        place = np.argsort(asker, kind="stable")  # entries stay in ascending order
        asker, entry = asker[place], entry[place]
        first = np.flatnonzero(_changes(asker))
        flat = pa.ListArray.from_arrays(np.append(first, len(asker)).astype(np.int32), pa.array(entry))
        queries = asker[first]
        yield pa.RecordBatch.from_arrays([pa.array(ids[queries]), pa.array(size[queries].astype(np.int32)), flat], ["query", "n", "entries"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heap-merge each node's short lists; entries met often enough are candidates."""
    for table in key_chunks(batches, ["query"], 1 << 14):
        query, n = table.column("query").to_numpy(), table.column("n").to_numpy()
        lists = table.column("entries").to_pylist()
        a, b = [], []
        for rows in np.split(np.arange(len(query)), np.flatnonzero(np.diff(query)) + 1):
            # a partner may be a small set, of which one shared entry is asked
            least = 1 if needed(int(n[rows[0]])) < SMALL else SHARED
            for entry, run in groupby(heapq.merge(*(lists[r] for r in rows))):
                if sum(1 for _ in run) >= least:
                    a.append(query[rows[0]])
                    b.append(entry)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Do two sorted sets reach the similarity?  Probes x's members in y in blocks until the outcome is certain."""
    if len(x) > len(y):
        x, y = y, x
    total, met = len(x) + len(y), 0
    for at in range(0, len(x), 256):
        part = x[at : at + 256]
        place = np.minimum(np.searchsorted(y, part), len(y) - 1)
        met += int((y[place] == part).sum())
        best = met + len(x) - at - len(part)
        if 100 * best < PERCENT * (total - best):
            return False
    return 100 * met >= PERCENT * (total - met)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return pairs.distinct().join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long")


def _own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, sets in shingle_sets(batch.column("text")):
            node = batch.column("node").slice(i, len(sets)).to_numpy()
            mine = [k for k, s in enumerate(sets) if len(s) and digest(s) == node[k]]
            yield pa.RecordBatch.from_arrays([pa.array(node[mine]), pa.array([sets[k].tobytes() for k in mine], pa.binary())], ["node", "tokens"])


def short_lists(docs: DataFrame, nodes: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """``token, node, n``: short lists that several nodes share; ``node, tokens``: the sets of nodes on them."""
    n = width(docs.sparkSession)
    texts = keyed(docs).select("oid", "tie", "text")
    postings = texts.select("text").mapInArrow(_postings, "token long, node long, n int, low int")
    frequent = postings.repartition(n, "token").sortWithinPartitions("token").mapInArrow(_frequent, "node long, token long, n int, low int, df long")
    short = frequent.repartition(n, "node").sortWithinPartitions("node").mapInArrow(_short_lists, "token long, node long, n int")
    several = short.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo != hi").select("token")
    lists = store(short.join(several, "token"), "short_lists")
    # one document's text for each node on a list that several nodes share
    first = nodes.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct("oid", "tie")).alias("first"))
    owners = first.join(lists.select("node").distinct(), "node").select("node", "first.oid", "first.tie")
    sets = store(texts.join(owners, ["oid", "tie"]).mapInArrow(_own_sets, "node long, tokens binary").dropDuplicates(["node"]), "shingle_sets")
    return lists, sets


def find_links(lists: DataFrame, sets: DataFrame, store: Store) -> DataFrame:
    """``a, b``: links between nodes that join every group of linked nodes."""
    n = width(lists.sparkSession)
    links = None
    labels = None
    for round_ in range(STAR_ROUNDS):
        stars = _by_token(lists, labels, n).mapInArrow(_stars(round_), "a long, b long, rank long")
        # one pivot for each node, the foremost of its lists': a round costs at most one check a node
        stars = stars.groupBy("a").agg(F.min(F.struct("rank", "b")).alias("pivot")).select("a", "pivot.b")
        found = store(_verified(stars, sets), "star_links")
        links = found if links is None else links.unionByName(found)
        labels = connected_components(links, store)
    marked = _by_token(lists, labels, n)
    blocks = _blocks(marked, store)
    links = links.unionByName(store(_block_search(marked, blocks, sets, store, n).mapInArrow(_search_chunks, "a long, b long"), "block_links"))
    return links.unionByName(store(_sparse_links(marked, sets, n), "search_links"))


def count_links(lists: DataFrame, sets: DataFrame, store: Store) -> DataFrame:
    """``node, n_links``: with how many other sets each node links.

    All pairs are searched, nothing is contracted.  Blocks count the links
    within a block, in their tasks; the sparse search finds the links between
    nodes that are not of one block, which meet in sparse lists only.
    """
    n = width(lists.sparkSession)
    marked = _by_token(lists, None, n)
    blocks = _blocks(marked, store)
    inside = _block_search(marked, blocks, sets, store, n).mapInArrow(_count_chunks, "node long, n_links long")
    between = store(_sparse_links(_by_token(lists, blocks, n), sets, n), "counted_links")
    ends = between.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("n_links"))
    return store(inside.unionByName(ends).groupBy("node").agg(F.sum("n_links").alias("n_links")), "link_counts")


def _sparse_links(marked: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """Links between nodes of different labels that meet in sparse lists."""
    entries = marked.mapInArrow(_lists_by_node, "query long, n int, entries array<long>")
    candidates = entries.repartition(n, "query").sortWithinPartitions("query").mapInArrow(_merge, "a long, b long")
    return _verified(candidates, sets)


def _by_token(lists: DataFrame, labels: DataFrame | None, n: int) -> DataFrame:
    """Short lists with each node's component (itself where it has no link yet), lists of one component left out."""
    if labels is None:
        marked = lists.withColumn("label", F.col("node"))
    else:
        marked = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = marked.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("token")
        marked = marked.join(open_, "token")
    return marked.select("token", "node", "n", "label").repartition(n, "token").sortWithinPartitions("token")


def near_duplicates(docs: DataFrame, store: Store, counts: bool = True) -> DataFrame:
    """Per document row: ``doc_id, oid, tie, n_shingles, component_id, n_links, component_links, keeps``.

    ``component_id`` is the least id reachable by links; ``n_links`` counts the
    other sets with which the row's set links (equal sets count once), and
    ``component_links`` the links of the component.  Without ``counts`` the
    last two are null.
    """
    nodes = store(keyed(docs).mapInArrow(_nodes, "doc_id long, oid long, tie long, node long, n long"), "shingle_nodes")
    lists, sets = short_lists(docs, nodes, store)
    links = store(find_links(lists, sets, store).distinct(), "links")
    labels = connected_components(links, store)
    joined = nodes.join(labels, "node", "left").withColumn("group", F.coalesce("label", "node"))
    groups = joined.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min("oid").alias("least"), F.min(F.struct("oid", "tie")).alias("keeper"))
    groups = groups.withColumnRenamed("group", "g")
    if counts:
        found = count_links(lists, sets, store)
        per = found.join(labels, "node").groupBy("label").agg((F.sum("n_links") / 2).cast("long").alias("component_links"))
        groups = groups.join(per, F.col("g") == F.col("label"), "left").select("g", "least", "keeper", "component_links")
        joined = joined.join(found, "node", "left")
        n_links, component_links = (F.coalesce(c, F.lit(0)) for c in ("n_links", "component_links"))
    else:
        n_links = component_links = F.lit(None)
    out = joined.join(groups, F.col("group") == F.col("g"), "left")
    own = F.coalesce("least", "oid")
    return out.select(
        "doc_id",
        "oid",
        "tie",
        F.col("n").alias("n_shingles"),
        F.when(own < (1 << 63) - 1, own).alias("component_id"),
        n_links.cast("long").alias("n_links"),
        component_links.cast("long").alias("component_links"),
        F.coalesce(F.col("keeper") == F.struct("oid", "tie"), F.lit(True)).alias("keeps"),
    )


def keep_one(docs: DataFrame, store: Store) -> DataFrame:
    """One row of every group of near duplicates: the one with the least id (equal rows: one of them); all columns."""
    kept = near_duplicates(docs, store, counts=False).filter("keeps").select(F.col("oid").alias("k_oid"), F.col("tie").alias("k_tie")).distinct()
    rows = keyed(docs, carry=True).select("oid", "tie", F.struct("rest", "text").alias("row"))
    mine = rows.join(kept, (F.col("oid") == F.col("k_oid")) & (F.col("tie") == F.col("k_tie"))).select("oid", "tie", "row")
    mine = mine.withColumn("copy", F.row_number().over(Window.partitionBy("oid", "tie").orderBy(F.xxhash64("row.rest")))).filter("copy = 1")
    return mine.select(*((F.col("row.text") if c == "text" else F.col(f"row.rest.`{c}`")).alias(c) for c in docs.columns))

"""Near-duplicate documents with a MinHash forest, confirmed on full shingle sets.

1. Every document gets its distinct 5-word shingles, a fingerprint of that set and ``TREES * LEVELS`` MinHash values. Documents
   with one and the same set are represented by the smallest id.
2. Each tree is one order of the signatures, sorted by ranges. Neighbours whose longest common prefix has ``BASE`` values or
   more are a run. All documents of a run are candidates of each other; in a run above ``REGION`` they are those of windows of
   ``REGION`` rows, half of which overlap, so the prefix asked for is as deep as the run is crowded there.
3. In a window, sketches tell which documents may be linked; each connected lot gives edges to its smallest document.
   The components of these edges over all trees are the candidate clusters.
4. The full sets of a cluster are compared pair by pair inside one task; a cluster larger than ``REGION`` is compared
   lot by lot first, and what has more than ``SHINGLES`` shingles is dealt into blocks, two of which meet in a task. Lots of
   confirmed links give edges again.
5. What windows cannot show is searched exactly. Documents of crowded runs, and of runs that the ranges of two tasks may cut, meet by
   their rarest shingles: of linked sets at least one shingle is among the rarest quarter of both, in any fixed order. Packs of documents tell
   hash ranges these shingles and are told which of them several confirmed components hold; only these become rows, so a shingle of one
   document, or of documents that are linked already, is none. In the others, and in clusters above ``REGION``, every document that is not of the largest confirmed
   component meets all documents, block by block.

At a similarity of 0.75 a pair shares no run of any tree with probability below 2e-6, whatever ``REGION`` is. No pair is ever a row: tasks
emit at most one edge per document and lot. Where most documents of a crowd are linked, the search costs their number times that of the
others; a crowd of thousands with hardly a link is compared in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import chunks as C
from millrace.llm import text as T
from millrace.llm.components import components
from millrace.scratch import new_dir

TREES, LEVELS, BASE = 16, 6, 2
#: Documents of a window, and of a block; clusters up to it are compared at once.
REGION = 1024
#: Rows of a sorted order that a task holds at least, before it compares the runs that are complete.
HOLD = 1 << 15
#: Cells of the counts that order shingles by rarity: the one thing read by the driver, 12 bytes each.
CELLS = 1 << 18
#: Ranges of cells that are summed by themselves; a task sends one row to each.
CELL_RANGES = 32
#: Rarest shingles after which a task ends a pack, 24 bytes each; ranges are as many as full packs would be, but for small inputs.
PACK, LEAST_RANGES = 1 << 18, 16
#: Shingles of a block of long documents; two blocks, or one document of its own length, are in memory at once.
SHINGLES = 4_000_000
#: Shared share of sketch values from which two documents are compared; 0.75 less five standard deviations.
LOOSE = 0.52

_N = TREES * LEVELS
_MULTIPLY = (T.mix(np.arange(7001, 7001 + _N, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_ADD = T.mix(np.arange(9001, 9001 + _N, dtype=np.uint64)).astype(np.uint32)


def shingle_sets(texts: pa.Array, width: int):
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle."""
    data, ends = T.column_bytes(texts)
    first = 0
    while first < len(texts):  # a few megabytes at a time
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + (2 << 20), "right")) - 1)
        part, offsets = data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        starts, stops, words = T.word_spans(part, offsets)
        hashes = T.word_hashes(part, starts, stops, T.LOWER_VALUES)
        grams = T.rolling(hashes, width) if len(hashes) else hashes
        for a, b in zip(words[:-1], words[1:]):
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                yield T.rolling(hashes[a:b], int(b - a))[:1] ^ np.uint64(b - a)
            else:
                yield hashes[:0]
        first = last


def _least_values(sets: list[np.ndarray]) -> list[bytes | None]:
    """The MinHash values of each set, then their last bytes: a sketch to compare; None for an empty set."""
    full = [s for s in sets if len(s)]
    if not full:
        return [None] * len(sets)
    short = (np.concatenate(full) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in full[:-1]])
    least = np.stack([np.minimum.reduceat(short * m + a, starts) for m, a in zip(_MULTIPLY, _ADD)], axis=1)
    rows = np.concatenate((least.astype(">u4").view(np.uint8), least.astype(np.uint8)), axis=1)
    found = iter(rows)
    return [next(found).tobytes() if len(s) else None for s in sets]


def _signatures(width: int):
    def signed(batches):
        for batch in batches:
            n, one, two, values, held, size = [], [], [], [], [], 0
            for shingles in shingle_sets(batch.column(1), width):
                n.append(len(shingles))
                one.append(int(np.add.reduce(T.mix(shingles))) - (1 << 63) if len(shingles) else 0)
                two.append(int(np.bitwise_xor.reduce(T.mix(shingles + np.uint64(77)))) - (1 << 63) if len(shingles) else 0)
                held.append(shingles)
                size += len(shingles)
                if size >= 1 << 14:  # some documents at a time, within the processor's cache
                    values += _least_values(held)
                    held, size = [], 0
            values += _least_values(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(values, pa.binary())],
                ["doc", "n", "one", "two", "signature"],
            )

    return signed


def _lots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place linked with each of n places."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _whole_groups(batches, key: str):
    """Tables that hold whole groups, from batches ordered by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        if held and held[-1].column(key)[-1] != column[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        values = column.to_numpy()
        last = int(np.flatnonzero(values != values[-1])[-1]) + 1 if (values != values[-1]).any() else 0
        if last:
            held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _loose_lots(sketch: np.ndarray, doc: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the row of the least document its sketch connects it with; rows lie in windows of ``size``.

    Also whether it is connected with any.
    """
    left = np.repeat(np.cumsum(size), size) - np.arange(len(doc))  # rows from here to the window's end
    a_all, b_all, a = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.arange(len(doc))
    for step in range(1, int(size.max(initial=0))):
        a = a[left[a] > step]
        for at in range(0, len(a), 1 << 15):
            some = a[at : at + (1 << 15)]
            some = some[np.count_nonzero(sketch[some] == sketch[some + step], axis=1) >= LOOSE * _N]
            a_all.append(some)
            b_all.append(some + step)
    order = np.argsort(doc, kind="stable")
    place = np.empty(len(doc), np.int64)
    place[order] = np.arange(len(doc))
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    joined = np.zeros(len(doc), bool)
    joined[a] = joined[b] = True
    return order[_lots(place[a], place[b], len(doc))[place]], joined


def _loose_edges(batches):
    for table in _whole_groups(batches, "lot"):
        doc, lot = table.column("doc").to_numpy(), table.column("lot").to_numpy()
        sketch = T.column_bytes(table.column("sketch").combine_chunks())[0].reshape(len(doc), -1)
        root, _ = _loose_lots(sketch, doc, np.unique(lot, return_counts=True)[1])
        own = np.flatnonzero(doc[root] != doc)
        yield pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(doc[root[own]])], ["u", "v"])


def _run_starts(tree: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where the longest common prefix with the row before has fewer than ``BASE`` values."""
    new = (tree[1:] != tree[:-1]) | (key[1:, : 4 * BASE] != key[:-1, : 4 * BASE]).any(1)
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def _windows(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows and sizes of the windows of these runs; runs of one row have none."""
    size = ends - starts
    fit = (size > 1) & (size <= REGION)
    first, length = [starts[fit]], [size[fit]]
    step = max(1, REGION // 2)
    for low, high in zip(starts[size > REGION], ends[size > REGION]):
        at = np.arange(low, max(low + 1, high - REGION + step), step)
        first.append(at)
        length.append(np.minimum(REGION, high - at))
    return np.concatenate(first), np.concatenate(length)


def _compared(rows: tuple, starts: np.ndarray, first_cut: bool, last_cut: bool) -> pa.RecordBatch:
    """The candidates in the runs that begin at ``starts``: ``lot, u, v``; rows that are ``hot`` name documents to search exactly."""
    tree, _, doc, sketch = rows
    ends = np.append(starts[1:], len(doc))
    crowded = ends - starts > REGION
    crowded[0] |= first_cut
    crowded[-1] |= last_cut
    hot = np.unique(doc[np.repeat(crowded, ends - starts)])
    first, size = _windows(starts, ends)
    at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    root, joined = _loose_lots(sketch[at], doc[at], size)
    name = np.repeat(T.mix(doc[first].astype(np.uint64) * np.uint64(TREES) + tree[first].astype(np.uint64)), size)
    lot = T.mix(name ^ T.mix(doc[at][root].astype(np.uint64))).view(np.int64)
    u, v = doc[at][joined], doc[at][root][joined]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((lot[joined], np.zeros(len(hot), np.int64)))),
            pa.array(np.concatenate((u, hot))),
            pa.array(np.concatenate((v, hot))),
            pa.array(np.repeat([False, True], [len(u), len(hot)])),
        ],
        ["lot", "u", "v", "hot"],
    )


def _neighbours(batches):
    """Candidates of a task's range of the sorted orders, holding a bounded number of rows.

    The first and the last run of the range may go on in other tasks, so their documents are hot, as those of crowded runs are.
    """
    held, rows, cut = [], 0, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, sketch = (T.column_bytes(batch.column(i))[0].reshape(n, -1) for i in (1, 3))
        held.append((batch.column(0).to_numpy(), key, batch.column(2).to_numpy(), sketch))
        rows += n
        if rows < max(HOLD, 2 * REGION):
            continue
        whole = tuple(map(np.concatenate, zip(*held)))
        starts = _run_starts(whole[0], whole[1])
        last = int(starts[-1])
        if last:
            yield _compared(tuple(c[:last] for c in whole), starts[:-1], cut, False)
        else:  # one run: its last window is compared again with what follows
            yield _compared(whole, starts, True, True)
            last = rows - REGION // 2
        cut = len(starts) == 1
        held, rows = [tuple(c[last:].copy() for c in whole)], rows - last
    if rows:
        whole = tuple(map(np.concatenate, zip(*held)))
        yield _compared(whole, _run_starts(whole[0], whole[1]), cut, True)


def _shingle_counts(width: int):
    def counted(batches):
        times = np.zeros(CELLS, np.int64)
        for batch in batches:
            for shingles in shingle_sets(batch.column("text"), width):
                np.add.at(times, shingles % np.uint64(CELLS), 1)
        cell = np.flatnonzero(times)
        at = np.searchsorted(cell, np.arange(CELL_RANGES + 1) * CELLS // CELL_RANGES)
        full = np.flatnonzero(np.diff(at))
        packed = [pa.array([x[at[p] : at[p + 1]].tobytes() for p in full], pa.binary()) for x in (cell.astype(np.uint32), times[cell])]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), *packed], ["range", "cells", "times"])

    return counted


def _cell_sums(table: pa.Table) -> pa.Table:
    """The counts of one range of cells, summed over the tasks: one row."""
    cells, which = np.unique(C.unpack(table, "cells", np.uint32)[0], return_inverse=True)
    times = np.zeros(len(cells), np.int64)
    np.add.at(times, which, C.unpack(table, "times", np.int64)[0])
    return pa.table({"cells": pa.array([cells.tobytes()], pa.binary()), "times": pa.array([times.tobytes()], pa.binary())})


def _rarest(width: int, percent: int, times: np.ndarray):
    """The shingles of which linked sets share one: the first of each set in the order of ``times`` and value.

    A pack holds those of many documents, by value: ``chunk`` (its number), ``hashes, docs, labels``.
    """

    def packed(number, held):
        shingle, doc, label = map(np.concatenate, zip(*held))
        order = np.argsort(shingle, kind="stable")
        blobs = [pa.array([x[order].tobytes()], pa.binary()) for x in (shingle, doc, label)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *blobs], ["chunk", "hashes", "docs", "labels"])

    def found(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            shingle, n = [np.zeros(0, np.uint64)], []
            for values in shingle_sets(batch.column("text"), width):
                first = len(values) + (-percent * len(values)) // 100 + 1 if len(values) else 0
                shingle.append(values[np.argsort(times[values % np.uint64(CELLS)], kind="stable")[:first]])
                n.append(first)
            n = np.array(n, np.int64)
            doc, label = (np.repeat(batch.column(c).to_numpy(), n) for c in ("doc", "label"))
            held.append((np.concatenate(shingle), doc, label))
            size += len(doc)
            if size >= PACK:
                yield packed(number, held)
                number, held, size = number + 1, [], 0
        if size:
            yield packed(number, held)

    return found


def _told(ranges: int):
    """What packs tell the hash ranges: each shingle once, with its least and greatest label."""

    def told(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pack = pa.Table.from_batches([batch.slice(i, 1)])
                hashes, label = C.unpack(pack, "hashes", np.uint64)[0], C.unpack(pack, "labels", np.int64)[0]
                starts = _value_starts(hashes)
                low, high = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
                yield from C.packed_rows(pack.column("chunk")[0].as_py(), ranges, hashes[starts], low=low, high=high).to_batches()

    return told


def _value_starts(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin; there is at least one value."""
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1))


def _several(table: pa.Table) -> pa.Table:
    """The answers of a hash range: per pack that told it any, its shingles that have several labels over all packs."""
    hashes, row = C.unpack(table, "hashes", np.uint64)
    low, high = (C.unpack(table, c, np.int64)[0] for c in ("low", "high"))
    order = np.argsort(hashes, kind="stable")
    starts = _value_starts(hashes[order])
    several = np.minimum.reduceat(low[order], starts) < np.maximum.reduceat(high[order], starts)
    some = order[np.repeat(several, np.diff(np.append(starts, len(order))))]
    return C.per_row(table, row[some], hashes[some], "lots")


def _open_rows(pack: pa.Table, answers: pa.Table) -> pa.Table:
    """``lot, doc, label`` of a pack's shingles that have several labels."""
    hashes, doc, label = (C.unpack(pack, c, kind)[0] for c, kind in (("hashes", np.uint64), ("docs", np.int64), ("labels", np.int64)))
    some = T.member(hashes, np.sort(C.unpack(answers, "lots", np.uint64)[0]))
    return pa.table({"lot": pa.array(hashes[some].view(np.int64)), "doc": pa.array(doc[some]), "label": pa.array(label[some])})


def _sets(width: int):
    def made(batches):
        for batch in batches:
            blobs = [s.tobytes() for s in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("lot"), batch.column("doc"), pa.array(blobs, pa.binary())], ["lot", "doc", "shingles"])

    return made


def linked_places(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places whose sets have ``100 * intersection >= percent * union``, by counting shared members."""
    size = np.array([len(s) for s in sets])
    values, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    keep = times[which] > 1
    column = np.cumsum(times > 1) - 1
    which, owner = column[which[keep]], owner[keep]
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    wide = max(64, (1 << 22) // max(1, len(sets)))
    for low in range(0, int(which[-1]) + 1 if len(which) else 0, wide):
        a, b = np.searchsorted(which, [low, low + wide])
        part = np.zeros((len(sets), wide), np.float32)
        part[owner[a:b], which[a:b] - low] = 1
        both += part @ part.T
    shared = np.rint(both).astype(np.int64)
    a, b = np.nonzero(np.triu(100 * shared >= percent * (size[:, None] + size - shared), 1))
    return a, b


def _confirm(percent: int):
    def confirmed(batches):
        for table in _whole_groups(batches, "lot"):
            lot, doc = table.column("lot").to_numpy(), table.column("doc").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
            cuts = np.concatenate(([0], np.flatnonzero(lot[1:] != lot[:-1]) + 1, [len(lot)]))
            us, vs = [], []
            for low, high in zip(cuts[:-1], cuts[1:]):
                if high - low < 2:
                    continue
                order = low + np.argsort(doc[low:high], kind="stable")
                a, b = linked_places([sets[i] for i in order], percent)
                root = _lots(a, b, len(order))
                own = np.flatnonzero(root != np.arange(len(order)))
                us.append(doc[order[own]])
                vs.append(doc[order[root[own]]])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return confirmed


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _sketch() -> Column:
    return F.expr(f"substring(signature, {4 * _N + 1}, {_N})").alias("sketch")


def _orders(nodes: DataFrame) -> DataFrame:
    """``tree, key, doc, sketch``: the signatures in the order of every tree, sorted by ranges."""
    key = F.expr(f"substring(signature, tree * {4 * LEVELS} + 1, {4 * LEVELS})").alias("key")
    rows = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))).select("tree", key, "doc", _sketch())
    return rows.repartitionByRange("tree", "key", "doc").sortWithinPartitions("tree", "key", "doc")


def _rest_in_blocks(rows: DataFrame) -> DataFrame:
    """Lots in which every document meets all those of its lot that have another label, at least.

    ``rows`` are ``lot, doc, label, n`` (its shingles). Documents that are not of the lot's commonest label are dealt into blocks, all documents
    too, and one block of either kind is a new lot. Lots of one label only have none.
    """
    per = rows.groupBy("lot", "label").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
    sums = per.groupBy("lot").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.max(F.struct("docs", "n", "label")).alias("main")
    )

    def parts(docs, n):
        return F.greatest(F.ceil(docs / F.lit(REGION)), F.ceil(n / F.lit(SHINGLES))).cast("long")

    blocks = sums.filter("docs > main.docs").select(
        "lot",
        F.col("main.label").alias("main"),
        parts(F.col("docs"), F.col("n")).alias("wide"),
        parts(F.col("docs") - F.col("main.docs"), F.col("n") - F.col("main.n")).alias("rest"),
    )
    here = rows.join(blocks, "lot")
    i, j = F.pmod(F.xxhash64("doc", F.lit(1)), F.col("rest")), F.pmod(F.xxhash64("doc"), F.col("wide"))
    every = here.withColumn("j", j).withColumn("i", F.explode(F.expr("sequence(0, rest - 1)")))
    some = here.filter("label <> main").withColumn("i", i).withColumn("j", F.explode(F.expr("sequence(0, wide - 1)")))
    both = every.select("lot", "doc", "i", "j").unionByName(some.select("lot", "doc", "i", "j"))
    return both.select(F.xxhash64("lot", "i", "j").alias("lot"), "doc").distinct()


def _in_blocks(lots: DataFrame, nodes: DataFrame) -> DataFrame:
    """``lots`` (``lot, doc``) with lots of too many shingles cut into lots of two blocks, so that every pair still meets."""
    counted = lots.join(nodes.select("doc", "n"), "doc")
    parts = counted.groupBy("lot").agg(F.ceil(F.sum("n") / F.lit(SHINGLES)).cast("long").alias("parts"))
    long = _saved(parts.filter("parts > 1"), "forest-long")
    if long.isEmpty():
        return lots
    mine = F.pmod(F.xxhash64("doc"), F.col("parts"))
    dealt = lots.join(long, "lot").select("lot", "doc", mine.alias("mine"), F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    pair = F.xxhash64("lot", F.least("mine", "other"), F.greatest("mine", "other"))
    return lots.join(long, "lot", "left_anti").unionByName(dealt.select(pair.alias("lot"), "doc"))


def _members(clusters: DataFrame) -> DataFrame:
    """``lot, doc`` of all members, from ``node, component``."""
    least = clusters.select(F.col("component").alias("lot"), F.col("component").alias("doc")).distinct()
    return _saved(clusters.select(F.col("component").alias("lot"), F.col("node").alias("doc")).unionByName(least), "forest-clusters")


def _labelled(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` with the confirmed component of their ``doc`` as ``label``."""
    named = linked.select(F.col("node").alias("doc"), F.col("component").alias("label"))
    return rows.join(named, "doc", "left").withColumn("label", F.coalesce("label", "doc"))


def _confirmed(plain: DataFrame, lots: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges between documents of one lot that links of their full sets connect."""
    return (
        plain.join(lots, "doc")
        .select("lot", "doc", "text")
        .mapInArrow(_sets(width), "lot long, doc long, shingles binary")
        .repartition("lot")
        .sortWithinPartitions("lot")
        .mapInArrow(_confirm(percent), "u long, v long")
    )


def _rare_edges(plain: DataFrame, nodes: DataFrame, hot: DataFrame, linked: DataFrame, width: int, percent: int) -> DataFrame:
    """Loose edges between ``hot`` documents that share one of their rarest shingles and are not ``linked`` yet.

    The order of rarity counts shingles by cell, over the hot documents; any order gives all links, a good one small groups. Groups with the same
    members count once.
    """
    texts = _saved(_labelled(plain.join(hot, "doc"), linked), "forest-hot")
    counts = texts.mapInArrow(_shingle_counts(width), "range long, cells binary, times binary")
    cells = counts.groupBy("range").applyInArrow(_cell_sums, "cells binary, times binary").toArrow()
    times = np.zeros(CELLS, np.uint32)
    times[C.unpack(cells, "cells", np.uint32)[0]] = np.minimum(C.unpack(cells, "times", np.int64)[0], 0xFFFFFFFF)
    packs = _saved(texts.mapInArrow(_rarest(width, percent, times), "chunk long, hashes binary, docs binary, labels binary"), "forest-packs")
    ranges = max(LEAST_RANGES, -(-(packs.agg(F.sum(F.length("hashes"))).first()[0] or 0) // (8 * PACK)))
    told = packs.mapInArrow(_told(ranges), "range long, chunk long, hashes binary, low binary, high binary")
    answers = told.groupBy("range").applyInArrow(_several, "chunk long, lots binary")
    rows = _saved(C.beside(packs, answers, _open_rows, "lot long, doc long, label long"), "forest-rare")
    groups = (
        rows.groupBy("lot")
        .agg(
            F.count("*").alias("docs"),
            F.bit_xor(F.xxhash64("doc")).alias("one"),
            F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("two"),
        )
        .groupBy("docs", "one", "two")
        .agg(F.min("lot").alias("lot"))
    )
    open_rows = _saved(rows.join(groups, "lot", "left_semi").withColumn("n", F.lit(0)), "forest-open")
    lots = _rest_in_blocks(open_rows)
    edges = (
        lots.join(nodes.select("doc", _sketch()), "doc")
        .repartition("lot")
        .sortWithinPartitions("lot")
        .mapInArrow(_loose_edges, "u long, v long")
    )
    return _saved(edges.distinct(), "forest-rare-edges")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * intersection >= percent * union`` of their distinct shingles of ``width`` lower-cased
    words. A null or empty text has no shingles and no links. ``component_id`` is the smallest id reachable. A row with a null id is
    linked through an identical set only (its component is that set's, or null) and is never kept. Rows that share
    an id are linked each through its own text. An empty table gives no rows.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    signed = _saved(plain.mapInArrow(_signatures(width), "doc long, n long, one long, two long, signature binary"), "forest-signed")
    nodes = _saved(
        signed.filter("n > 0 AND doc IS NOT NULL")
        .groupBy("n", "one", "two")
        .agg(F.min("doc").alias("doc"), F.max("signature").alias("signature")),
        "forest-nodes",
    )
    found = _saved(_orders(nodes).mapInArrow(_neighbours, "lot long, u long, v long, hot boolean"), "forest-candidates")
    pairs = found.filter("NOT hot").drop("hot")
    members = _members(components(pairs.select("u", "v")))
    sized = members.groupBy("lot").agg(F.count("*").alias("docs"))
    large = _saved(members.join(sized.filter(F.col("docs") > REGION), "lot", "left_semi"), "forest-large")
    lots = members.join(large.select("lot").distinct(), "lot", "left_anti").unionByName(
        pairs.join(large.select("doc"), pairs["u"] == F.col("doc"), "left_semi").select("lot", F.col("u").alias("doc"))
    )
    links = _saved(_confirmed(plain, _in_blocks(lots, nodes), width, percent), "forest-links")
    linked = _saved(components(links), "forest-linked")
    rare = _rare_edges(plain, nodes, found.filter("hot").select(F.col("u").alias("doc")).distinct(), linked, width, percent)
    if not (large.isEmpty() and rare.isEmpty()):
        wider = _members(components(pairs.select("u", "v").unionByName(rare)))
        before = members.withColumnRenamed("lot", "before")
        labelled = _labelled(wider.join(before, "doc", "left").withColumn("before", F.coalesce("before", "doc")), linked)
        open_lots = labelled.groupBy("lot").agg(
            F.count("*").alias("docs"), (F.min("before") == F.max("before")).alias("same"), (F.min("label") < F.max("label")).alias("several")
        )
        rest = labelled.join(open_lots.filter(F.col("several") & (~F.col("same") | (F.col("docs") > REGION))), "lot", "left_semi")
        rest = rest.join(nodes.groupBy("doc").agg(F.sum("n").alias("n")), "doc").select("lot", "doc", "label", "n")
        more = _saved(_confirmed(plain, _rest_in_blocks(rest), width, percent), "forest-more")
        linked = components(links.unionByName(more))
    named = (
        nodes.select("n", "one", "two", F.col("doc").alias("node"))
        .join(linked, "node", "left")
        .select("n", "one", "two", F.coalesce("component", "node").alias("component_id"))
    )
    return (
        signed.select("doc", "n", "one", "two")
        .join(named, ["n", "one", "two"], "left")
        .select(
            F.col("doc").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc"))).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )

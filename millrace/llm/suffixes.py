"""Removing repeated byte passages with suffix arrays built by two-stage sorting.

Suffixes that agree on ``width`` bytes must meet in one task without moving every suffix. So each window of
``width`` bytes picks an anchor, the smallest hash among the grams of ``GRAM`` bytes inside it: equal windows pick
equal grams. Steps:

1. Chunks send their distinct anchors, 4 bytes beside the hash range; a range answers with those that several
   chunks hold. Windows without such an anchor, and with an anchor that is alone in its chunk, occur once.
2. Runs of windows with one anchor travel with the bytes under them to the anchor's hash range, each distinct run once per
   chunk with its smallest document.
3. A range sorts the suffixes of its runs: those smaller than their successors directly, the others by induction
   (a scan over the first bytes). Adjacent suffixes whose common prefix reaches ``width`` form groups; a suffix
   in a larger document than its group's smallest is marked.
4. Each chunk removes the bytes that marked windows cover.

Windows are compared byte by byte, never by hash alone. A passage that every document holds is one run per chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm import chunks as C
from millrace.llm import text as T

_BYTES = T.mix(np.arange(1001, 1257, dtype=np.uint64))
_NOBODY = np.iinfo(np.int64).max
_WHOLE = np.uint32(0xFFFFFFFF)
#: Hash ranges in which suffixes are sorted, for each chunk: a range has about a megabyte of runs.
SORTS_PER_CHUNK = 2

KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _gram(width: int) -> int:
    """Bytes of an anchor gram: a window holds 31 grams at most, so one mask word describes a run."""
    return max(width - 30, (2 * width) // 5)


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each n values in a row; the last n - 1 places see fewer."""
    size = 1
    while size * 2 <= n:
        values = np.minimum(values, np.append(values[size:], np.full(min(size, len(values)), ~np.uint64(0))))
        size *= 2
    rest = n - size
    return np.minimum(values, np.append(values[rest:], np.full(min(rest, len(values)), ~np.uint64(0)))) if rest else values


def runs(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, inside one document: anchor hash, first and last start."""
    gram = _gram(width)
    whole = np.flatnonzero(T.fits(ends, width))
    if not len(whole):
        return np.zeros(0, np.uint64), whole, whole
    total, at, block, size, done, rest = None, T.powers(gram + 1), _BYTES[data], 1, 0, gram
    while rest:
        if rest & 1:
            total = block if total is None else total + T._shifted(block, done) * at[done]
            done += size
        rest >>= 1
        if rest:
            block = block + T._shifted(block, size) * at[size]
            size *= 2
    del block
    # the last six bits of each key tell where the gram stands
    total &= ~np.uint64(63)
    total |= (np.arange(len(data)) & 63).astype(np.uint64)
    key = _least(total, width - gram + 1)[whole]
    place = whole + ((key.astype(np.int64) - whole) & 63)
    first = np.concatenate(([True], (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)))
    last = np.append(first[1:], True)
    return T.mix(key[first] >> np.uint64(6)), whole[first], whole[last]


def _screen(n: int, width: int):
    def anchors(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, data, ends = C.body_of(batch, i)
                found = np.unique(runs(data, ends, width)[0])
                yield from C.shortened(C.packed_rows(batch.column("chunk")[i].as_py(), n, found)).to_batches()

    return anchors


def _shared(key, table):
    short, row = C.unpack(table, "hashes", np.uint32)
    _, which, times = np.unique(short, return_inverse=True, return_counts=True)
    hit = times[which] > 1
    full = (np.uint64(key[0].as_py()) << np.uint64(32)) | short[hit].astype(np.uint64)
    return C.per_row(table, row[hit], full, "hits")


def _send(n: int, n_sort: int, width: int):
    most = 2 * width - _gram(width)

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, ends = C.body_of(left)
        anchor, first, last = runs(data, ends, width)
        _, which, times = np.unique(anchor, return_inverse=True, return_counts=True)
        wanted = times[which] > 1
        wanted |= T.member(C.short_key(anchor, n), np.unique(C.unpack(right, "hits", np.uint64)[0]))
        order = np.flatnonzero(wanted)
        order = order[np.argsort(anchor[order], kind="stable")]
        anchor, first, last = anchor[order], first[order], last[order]
        size = last - first + width
        doc = np.searchsorted(ends, first, "right") - 1
        grid = np.zeros((len(order), most + 1), np.uint8)
        grid[:, 0] = size
        take = np.arange(most)
        real = take < size[:, None]
        grid[:, 1:][real] = data[(first[:, None] + take)[real]]
        rows = np.ascontiguousarray(grid).view(f"V{most + 1}").ravel()
        _, sent, which = np.unique(rows, return_index=True, return_inverse=True)
        source = sent[which]
        # what stands here already: all of it is marked, or within one document it shares the marks of the first
        extra = np.flatnonzero(source != np.arange(len(order)))
        owner = np.array([_NOBODY if x is None else x for x in ids], np.int64)
        smaller = owner[doc[source[extra]]] < owner[doc[extra]]
        sent = np.sort(sent)  # by anchor again
        chunk = left.column("chunk")[0].as_py()
        at = C.cut(anchor[sent], n_sort)
        full = np.flatnonzero(np.diff(at))
        part = lambda values: [values[sent[at[p] : at[p + 1]]].tobytes() for p in full]
        texts = [grid[sent[at[p] : at[p + 1]], 1:][real[sent[at[p] : at[p + 1]]]].tobytes() for p in full]
        own = np.stack([first[extra], np.where(smaller, _WHOLE, first[source[extra]]), last[extra] - first[extra] + 1], 1)
        none = [None] * len(full)
        return pa.Table.from_arrays(
            [
                pa.array([*full, chunk % n_sort], pa.int64()),
                pa.array([chunk] * (len(full) + 1), pa.int64()),
                pa.array([*part(owner[doc]), b""], pa.binary()),
                pa.array([*part(first.astype(np.uint32)), b""], pa.binary()),
                pa.array([*part(size.astype(np.uint8)), b""], pa.binary()),
                pa.array([*texts, b""], pa.binary()),
                pa.array([*none, own.astype(np.uint32).tobytes()], pa.binary()),
            ],
            ["range", "chunk", "owner", "first", "size", "body", "own"],
        )

    return contexts


def _big_endian(padded: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as a number that orders like them."""
    out = np.zeros(len(padded) - 8, np.uint64)
    for k in range(8):
        out |= padded[k : k + len(out)].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def two_stage(padded: np.ndarray, stop: np.ndarray, wanted: np.ndarray, width: int) -> np.ndarray:
    """The wanted places of ``padded`` in the order of the suffixes there.

    ``stop`` is the end of the text around each place; texts are followed by zeros. The order is that of the first
    ``width`` bytes at least, so suffixes that agree on them are neighbours. Suffixes smaller than their successors
    are sorted directly; the rest follow from the order of their successors, first byte by first byte.
    """
    place = np.arange(len(padded), dtype=np.int32)
    ends_text = place + 1 >= stop
    following = np.append(padded[1:], np.uint8(0))
    decides = ends_text | (padded != following)
    turn = np.minimum.accumulate(np.where(decides, place, np.int32(len(padded) - 1))[::-1])[::-1]
    rising = (~ends_text & (padded < following))[turn]
    # a falling suffix needs its successor's rank, down to the next rising one or the end of its text
    goal = np.minimum.accumulate(np.where(rising | ends_text, place, np.int32(len(padded) - 1))[::-1])[::-1]
    reach = np.zeros(len(padded) + 1, np.int32)
    last = wanted[~rising[wanted]]
    np.add.at(reach, last, 1)
    np.add.at(reach, goal[last] + 1, -1)
    needed = np.cumsum(reach[:-1]) > 0
    needed[wanted] = True
    direct = np.flatnonzero(needed & rising)
    words = _big_endian(padded)
    keys = [words[direct + k] for k in range(0, width, 8)]
    direct = direct[np.lexsort(keys[::-1])]
    fall = np.flatnonzero(needed & ~rising)
    fall = fall[np.argsort(padded[fall], kind="stable")]
    falls, rises = np.searchsorted(padded[fall], np.arange(257)), np.searchsorted(padded[direct], np.arange(257))
    rank = np.full(len(padded) + 1, -1, np.int32)
    done, out = 0, []

    def emit(places):
        nonlocal done
        rank[places] = np.arange(done, done + len(places), dtype=np.int32)
        done += len(places)
        out.append(places)

    for byte in range(256):
        mine = fall[falls[byte] : falls[byte + 1]]
        if len(mine):
            doubled = ~ends_text[mine] & (following[mine] == byte)
            level, rest = mine[~doubled], mine[doubled]
            while len(level):
                after = np.where(ends_text[level], -1, rank[level + 1])
                emit(level[np.argsort(after, kind="stable")])
                ready = rank[rest + 1] >= 0
                level, rest = rest[ready], rest[~ready]
        if rises[byte] < rises[byte + 1]:
            emit(direct[rises[byte] : rises[byte + 1]])
    order = np.concatenate(out) if out else direct
    pick = np.zeros(len(padded), bool)
    pick[wanted] = True
    return order[pick[order]]


def _mark(width: int):
    pad = width + 16

    def marks(table: pa.Table) -> pa.Table:
        # at most 31 windows a run, so every array here is a small multiple of the range's bytes
        size, row = C.unpack(table, "size", np.uint8)
        size = size.astype(np.int64)
        owner, _ = C.unpack(table, "owner", np.int64)
        first, _ = C.unpack(table, "first", np.uint32)
        body, _ = C.unpack(table, "body", np.uint8)
        begin = np.concatenate(([0], np.cumsum(size + pad)))[:-1]
        context = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(body)) - np.repeat(np.cumsum(size) - size, size)
        padded = np.zeros(int((size + pad).sum()) + 16, np.uint8)
        padded[begin[context] + inside] = body
        stop = np.append(np.repeat((begin + size).astype(np.int32), size + pad), np.full(16, len(padded), np.int32))
        starts = inside + width <= size[context]
        context, inside = context[starts], inside[starts]
        place = begin[context] + inside
        mask = np.zeros(len(size), np.uint32)
        if len(place):
            at = np.zeros(len(padded), np.int32)
            at[place] = np.arange(len(place), dtype=np.int32)
            order = two_stage(padded, stop, place, width)
            words = _big_endian(padded)
            same = np.ones(len(order) - 1, bool)
            for k in [*range(0, width - 7, 8), width - 8]:
                same &= words[order[1:] + k] == words[order[:-1] + k]
            heads = np.flatnonzero(np.concatenate(([True], ~same)))
            which = at[order]
            own = owner[context[which]]
            least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.append(heads, len(own))))
            late = which[own > least]
            np.bitwise_or.at(mask, context[late], np.uint32(1) << inside[late].astype(np.uint32))
        hit = np.flatnonzero(mask)
        answers = C.per_row(table, row[hit], np.stack([first[hit], mask[hit]], 1), "marks")
        own = table.filter(pc.is_valid(table.column("own"))).select(["chunk", "own"])
        return pa.Table.from_arrays(
            [
                pa.concat_arrays([*answers.column("chunk").chunks, *own.column("chunk").chunks]),
                pa.concat_arrays([*answers.column("marks").chunks, pa.nulls(own.num_rows, pa.binary())]),
                pa.concat_arrays([pa.nulls(answers.num_rows, pa.binary()), *own.column("own").chunks]),
            ],
            ["chunk", "marks", "own"],
        )

    return marks


def _remove(width: int):
    def kept(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, ends = C.body_of(left)
        marks = C.unpack(right, "marks", np.uint32)[0].reshape(-1, 2).astype(np.int64)
        own = C.unpack(right, "own", np.uint32)[0].reshape(-1, 3).astype(np.int64)
        mask = np.zeros(len(data) + 1, np.uint32)
        mask[marks[:, 0]] = marks[:, 1]
        full = own[:, 1] == int(_WHOLE)
        mask[own[full, 0]] = ((1 << own[full, 2]) - 1).astype(np.uint32)
        linked = own[~full]
        mask[linked[:, 0]] = mask[linked[:, 1]]
        started = np.zeros(len(data), bool)
        begin = np.flatnonzero(mask[: len(data)])
        for k in range(31):
            started[begin[(mask[begin] >> np.uint32(k)) & 1 > 0] + k] = True
        gone = T.covered(started, width)
        removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[ends])
        begins = gone & ~np.concatenate(([False], gone[:-1]))
        begins[ends[:-1][np.diff(ends) > 0]] = gone[ends[:-1][np.diff(ends) > 0]]
        spans = np.diff(np.concatenate(([0], np.cumsum(begins)))[ends])
        texts = [data[a:b].tobytes() if not r else data[a:b][~gone[a:b]].tobytes() for a, b, r in zip(ends, ends[1:], removed)]
        return pa.Table.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.diff(ends)), pa.array(removed), pa.array(spans), pa.array(texts, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    return kept


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining UTF-8 bytes).

    A byte goes if a string of ``width`` bytes over it also starts in a document with a smaller id. Rows that share an id
    do not remove from one another; a null id is larger than all others. Null is empty; an empty
    table gives no rows. A document must fit a task's memory, about 60 bytes per byte of text.
    """
    if not 16 <= width <= 100:
        raise ValueError("width is from 16 to 100 bytes")
    stored = C.store(docs, id_col, text_col)
    n = C.ranges(stored)
    anchors = stored.mapInArrow(_screen(n, width), "range long, chunk long, hashes binary")
    shared = anchors.groupBy("range").applyInArrow(_shared, "chunk long, hits binary")
    n_sort = max(n, stored.count() * SORTS_PER_CHUNK)
    sent = C.beside(stored, shared, _send(n, n_sort, width), "range long, chunk long, owner binary, first binary, size binary, body binary, own binary")
    marked = sent.groupBy("range").applyInArrow(_mark(width), "chunk long, marks binary, own binary")
    return C.beside(stored, marked, _remove(width), KEPT)

"""Removing repeated word passages: fixed-block anchors, probed by every rolling window.

A window of ``width`` words holds at least one whole block of ``(width + 1) // 2`` words that starts at
a multiple of that length in its document. Those non-overlapping blocks are the index; the
rolling windows of the same length of all documents are the probes. Steps:

1. Each chunk sends its distinct block and probe hashes, 4 bytes beside their hash range. A range answers
   with the probes that hit a block known to several chunks.
2. Around hits, matches extend to windows of ``width`` words; a chunk sends each such window once,
   with its smallest document. Ranges answer with the windows that start earlier elsewhere.
3. Each chunk marks the windows answered and those that started earlier in the chunk itself. Adjoining windows
   form the maximal exact repeats, and every word under one goes.

Windows are judged on the input. A window that every document holds is one entry per chunk and step,
so hot passages neither gather in a task nor form pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import chunks as C
from millrace.llm import text as T

KEPT = "doc_id long, n_words long, n_removed long, kept_text string"


def _words(row: pa.Table, i: int = 0):
    ids, data, ends = C.body_of(row, i)
    starts, stops, words = T.word_spans(data, ends)
    return ids, data, ends, starts, stops, words, T.word_hashes(data, starts, stops)


def _screen(n: int, block: int):
    def probes(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                *_, words, hashes = _words(batch, i)
                grams, whole = T.rolling(hashes, block), T.fits(words, block)
                place = np.arange(len(hashes)) - np.repeat(words[:-1], np.diff(words))
                indexed = np.unique(grams[whole & (place % block == 0)])
                probed = np.unique(grams[whole])
                table = C.packed_rows(batch.column("chunk")[i].as_py(), n, probed, block=T.member(probed, indexed))
                yield from C.shortened(table).to_batches()

    return probes


def _hits(key, table):
    short, row = C.unpack(table, "hashes", np.uint32)
    block, _ = C.unpack(table, "block", np.bool_)
    distinct, which, times = np.unique(short, return_inverse=True, return_counts=True)
    anchored = np.zeros(len(distinct), bool)
    anchored[which[block]] = True
    hit = (anchored & (times > 1))[which]
    full = (np.uint64(key[0].as_py()) << np.uint64(32)) | short[hit].astype(np.uint64)
    return C.per_row(table, row[hit], full, "hits")


def _extend(n: int, width: int, block: int):
    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, _, _, _, _, words, hashes = _words(left)
        hits = np.unique(C.unpack(right, "hits", np.uint64)[0])
        grams = T.rolling(hashes, block)
        hit = T.member(C.short_key(grams, n), hits) & T.fits(words, block)
        ahead = np.concatenate((np.cumsum(hit), np.full(width - block, hit.sum())))
        near = ahead[width - block :] - ahead[: len(hit)] + hit > 0  # a hit within the window
        start = np.flatnonzero(near & T.fits(words, width))
        found, first = np.unique(T.rolling(hashes, width)[start], return_index=True)
        doc = np.searchsorted(words, start[first], "right") - 1
        owner = np.array([np.iinfo(np.int64).max if x is None else x for x in ids], np.int64)
        return C.packed_rows(left.column("chunk")[0].as_py(), n, found, owner=owner[doc])

    return windows


def _earlier(table: pa.Table) -> pa.Table:
    found, row = C.unpack(table, "hashes", np.uint64)
    owner, _ = C.unpack(table, "owner", np.int64)
    order = np.lexsort((table.column("chunk").to_numpy()[row], owner, found))
    again = np.zeros(len(found), bool)
    again[order[1:]] = found[order[1:]] == found[order[:-1]]
    return C.per_row(table, row[again], found[again], "again")


def _remove(width: int):
    def kept(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, ends, starts, stops, words, hashes = _words(left)
        start = np.flatnonzero(T.fits(words, width))
        found = T.rolling(hashes, width)[start]
        _, first, which = np.unique(found, return_index=True, return_inverse=True)
        repeat = first[which] != np.arange(len(found))
        repeat |= T.member(found, np.unique(C.unpack(right, "again", np.uint64)[0]))
        marks = np.zeros(len(hashes), bool)
        marks[start[repeat]] = True
        gone = T.covered(marks, width)
        removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[words])
        body, texts = data.tobytes(), []
        for k in range(len(ids)):
            if removed[k]:
                mine = range(words[k], words[k + 1])
                texts.append(b" ".join(body[starts[w] : stops[w]] for w in mine if not gone[w]))
            else:
                texts.append(b" ".join(body[ends[k] : ends[k + 1]].split()))
        return pa.Table.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.diff(words)), pa.array(removed), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text"],
        )

    return kept


def remove_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space).

    A word goes if a window of ``width`` words over it also starts earlier: in a smaller id, or
    earlier in the same document. Rows that share an id count as separate documents, one of which is the earlier;
    rows with a null id come after all others. Null and empty texts have no words; an empty table gives no rows.
    Windows are told apart by 64-bit hashes. Every document must fit a task's memory, about 60 bytes per byte of text.
    """
    if width < 2:
        raise ValueError("a window has at least two words")
    block = (width + 1) // 2
    stored = C.store(docs, id_col, text_col)
    n = C.ranges(stored)
    probes = stored.mapInArrow(_screen(n, block), "range long, chunk long, hashes binary, block binary")
    hits = probes.groupBy("range").applyInArrow(_hits, "chunk long, hits binary")
    windows = C.beside(stored, hits, _extend(n, width, block), "range long, chunk long, hashes binary, owner binary")
    again = windows.groupBy("range").applyInArrow(_earlier, "chunk long, again binary")
    return C.beside(stored, again, _remove(width), KEPT)

"""Token counts per section: whole documents encoded once, token spans joined to section spans.

A byte-level vocabulary tells how many bytes each token covers, so the spans follow from the ids by a running sum. Sections are
the lines of a text (a line holds its line feed), or spans that a function of one's own gives. A token counts for the section
that holds most of its characters; of equal shares the earlier section gets it. Characters that two tokens
share count for both.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.llm import tokens


def line_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes at which a section of a text begins: its start, and after every line feed inside it."""
    starts = np.zeros(len(data) + 1, bool)
    starts[1:] = data == 10
    starts[ends[:-1]] = True
    return np.flatnonzero(starts[: len(data)])


def spans(coder: tokens.Coder, texts: list[str], sections: Callable = line_starts):
    """Per section: text, first and last character (exclusive), tokens, and tokens that cross a boundary and were given to it."""
    data, ends = T.column_bytes(pa.array(texts, pa.string()))
    packed = [coder.encode(t or "") for t in texts]
    ids = np.frombuffer(b"".join(packed), coder.kind)
    stop = np.cumsum(coder.lengths[ids])
    start = stop - coder.lengths[ids]
    char = np.cumsum((data & 0xC0) != 0x80) - 1  # of all texts, one after the other
    begin = sections(data, ends)
    if not len(begin):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    edges = np.append(char[begin], char[-1] + 1)
    low, high = char[start], char[stop - 1] + 1
    first = np.searchsorted(edges, low, "right") - 1
    last = np.searchsorted(edges, high - 1, "right") - 1
    owner, best = first.copy(), np.minimum(high, edges[first + 1]) - low
    crossing = np.flatnonzero(last > first)
    step, live = 1, crossing
    while len(live):
        section = first[live] + step
        share = np.minimum(high[live], edges[section + 1]) - np.maximum(low[live], edges[section])
        more = share > best[live]
        owner[live[more]], best[live[more]] = section[more], share[more]
        step += 1
        live = live[last[live] >= first[live] + step]
    n = len(begin)
    text = np.searchsorted(ends, begin, "right") - 1
    base = np.append(char, char[-1] + 1)[ends[:-1]][text]
    return text, edges[:-1] - base, edges[1:] - base, np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def _attributed(vocabulary: bytes, sections: Callable):
    def counted(batches):
        coder = tokens.coder(vocabulary)
        for batch in batches:
            _, ends = T.column_bytes(batch.column(1))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + (2 << 20), "right")) - 1)
                text, low, high, n, crossing = spans(coder, batch.column(1).slice(first, last - first).to_pylist(), sections)
                place = np.arange(len(text)) - np.searchsorted(text, text, "left")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + text)), pa.array(place), pa.array(low), pa.array(high), pa.array(n), pa.array(crossing)],
                    ["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"],
                )
                first = last

    return counted


def attribute(
    docs: DataFrame, vocabulary: str = tokens.VOCABULARY, sections: Callable = line_starts, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per section: ``doc_id, section, char_start, char_end, n_tokens, n_crossing``.

    The tokens of a document's sections add up to those of the whole document. Null and empty texts have no section
    and no row; a null id keeps its rows, and rows that share an id are separate documents. An empty table gives no rows.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _attributed(tokens.read_vocabulary(vocabulary), sections),
        "doc_id long, section long, char_start long, char_end long, n_tokens long, n_crossing long",
    )

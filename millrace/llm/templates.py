"""Benchmark decontamination by template canonicalisation.

Words lose the punctuation around them; numbers (also in words, or with a unit glued on), names and units become typed
placeholders, the rest is lower-cased. A capitalised word that opens a sentence may be a name: windows with it stand and are looked up
in both forms. Inside a German sentence a capital is no sign of a name, so there numbers, units and opening words only may differ.
An item's window stands in every reading if up to three of its words may be names, else with all of them as names or as
literals, or all but one; a document's is looked up in every reading that begins like an item's, some windows at a time, so a list with
a capital on every line takes about what other texts take.
Windows of ``WIDTH`` canonical words of the benchmark form a hash table; every document's rolling windows are looked up in it.
Windows of one document that hit one item at about one distance, in the same order, form an alignment, to which shorter runs of equal
words beside them are added; so a word more, less or changed does not cut an item in two. Texts are compared once more with runs of
names and of numbers as one slot each. Along an alignment the slot values must agree one to one
(the same number in the item is the same number in the document, and the other way round), so a question asked with
other numbers or names is caught and a chance likeness of placeholders is not.

The benchmark is handled in blocks of at most ``BLOCK_BYTES`` of text, whose tables go along with the tasks; more blocks mean more
scans, never a larger table.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T

WIDTH = 8
#: Literal words a window needs; with fewer, its slots must hold the item's own values.
LITERALS = 4
#: Words that an alignment may move by, and words of a run that is added to it.
SHIFT, RUN = 4, 4
#: Share of an item's words that a consistent alignment must cover.
COVERAGE = 0.6
BLOCK_BYTES = 8 << 20
#: Windows of texts whose readings a task holds at once.
WINDOWS = 1 << 14

LITERAL, NUMBER, UNIT, NAME = range(4)
_SLOT = T.mix(np.arange(51, 55, dtype=np.uint64))

#: Words that are units when they follow a number: symbols and English, German, French and Spanish words.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz gram grams kilogram kilograms ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years % percent degree degrees c f k usd eur gbp dollar dollars euro euros cent cents pound pounds "
    "meter metern kilometer kilometern gramm kilogramm tonne tonnen sekunde sekunden minuten stunde stunden tag tage tagen woche wochen "
    "monat monate monaten jahr jahre jahren prozent grad pfund "
    "mètre mètres kilomètre kilomètres gramme grammes kilogramme kilogrammes tonnes seconde secondes heure heures jour jours semaine "
    "semaines mois ans degré degrés livre livres "
    "metro metros kilómetro kilómetros gramo gramos kilogramo kilogramos tonelada toneladas litro litros segundo segundos minuto minutos "
    "hora horas día días semana semanas mes meses año años grado grados libra libras"
).split()

#: Number words of four languages stand for their figures; words that are often something else (ein, elf, un, once) are left out.
NUMBER_WORDS = dict(
    pair
    for words, figures in (
        (
            "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
            "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion",
            [*range(20), *range(20, 101, 10), 1000, 1000000, 1000000000],
        ),
        ("null eins zwei drei vier fünf sechs sieben acht neun zehn zwölf", [*range(11), 12]),
        ("zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend", [*range(20, 101, 10), 1000]),
        ("zéro deux trois quatre cinq six sept huit neuf dix onze douze", [0, *range(2, 13)]),
        ("vingt trente quarante cinquante soixante cent mille", [*range(20, 61, 10), 100, 1000]),
        ("cero uno dos tres cuatro cinco seis siete ocho nueve diez doce", [*range(11), 12]),
        ("veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien mil", [*range(20, 101, 10), 1000]),
    )
    for pair in zip(words.split(), map(str, figures), strict=True)
)

#: Words that tell a German sentence, whose nouns all have capitals; words that are English, French or Spanish too are left out.
GERMAN = (
    "der das und ist nicht ein eine einen einem einer dem auf für von zu im zum zur wie viele wird werden sind auch nach bei aus dann "
    "oder wenn haben sich mit noch nur über unter zwischen vor ich wir sie ihr ihre sein seine kann jeden jede jeder"
).split()
#: Share of such words, and their least number, in a German sentence.
GERMAN_SHARE, GERMAN_LEAST = 0.1, 2


def _bytes_in(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_DIGIT = _bytes_in(b"0123456789")
_NUMERIC = _bytes_in(b"0123456789.,:/-+")
_EDGE = _bytes_in(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_UPPER = _bytes_in(bytes(range(65, 91)))
_LOWERCASE = _bytes_in(bytes(range(97, 123)))
_STOP = _bytes_in(b".!?:;")


def _hash_words(words: list[str]) -> np.ndarray:
    data, ends = T.column_bytes(pa.array(words))
    return T.word_hashes(data, ends[:-1], ends[1:], T.LOWER_VALUES)


def _split_units(data: np.ndarray, low: np.ndarray, high: np.ndarray, sentence: np.ndarray, words: np.ndarray):
    """Words that are a number and a unit, such as 5kg, as two."""
    some = np.flatnonzero(_DIGIT[data[low]] & (_UPPER | _LOWERCASE)[data[high - 1]])
    if not len(some):
        return low, high, sentence, words
    numeric = np.concatenate(([0], np.cumsum(_NUMERIC[data])))
    letters = np.concatenate(([0], np.cumsum((_UPPER | _LOWERCASE)[data])))
    middle = low[some] + numeric[high[some]] - numeric[low[some]]
    fit = (numeric[middle] - numeric[low[some]] == middle - low[some]) & (letters[high[some]] - letters[middle] == high[some] - middle)
    some, middle = some[fit], middle[fit]
    if not len(some):
        return low, high, sentence, words
    size = high[some] - middle
    at = np.concatenate(([0], np.cumsum(size)))
    suffix = data[np.repeat(middle - at[:-1], size) + np.arange(at[-1])]
    fit = T.member(T.word_hashes(suffix, at[:-1], at[1:], T.LOWER_VALUES), _UNITS)
    some, middle = some[fit], middle[fit]
    words = words + np.searchsorted(some, words)
    last = high.copy()
    last[some] = middle
    return np.insert(low, some + 1, middle), np.insert(last, some + 1, high[some]), np.insert(sentence, some + 1, False), words


_UNITS, _GERMAN = np.unique(_hash_words(UNITS)), np.unique(_hash_words(GERMAN))
_SPELT, _FIGURES = _hash_words(list(NUMBER_WORDS)), _hash_words(list(NUMBER_WORDS.values()))
_SPELT, _FIGURES = np.sort(_SPELT), _FIGURES[np.argsort(_SPELT)]


def canonical(data: np.ndarray, ends: np.ndarray):
    """Canonical words of texts: their hashes, kinds, value hashes, the n + 1 word offsets of the texts, and which may be names.

    The last are literals by their hash and kind.
    """
    starts, stops, words = T.word_spans(data, ends)
    sentence = np.ones(len(starts), bool)
    if len(starts) > 1:
        sentence[1:] = _STOP[data[stops[:-1] - 1]] | (np.add.reduceat(data == 10, stops[:-1])[: len(starts) - 1] > 0)
    sentence[words[:-1][np.diff(words) > 0]] = True
    low, high = starts.copy(), stops.copy()
    for edge, step in ((low, 1), (high, -1)):
        live = np.flatnonzero(high > low)
        while len(live):
            live = live[_EDGE[data[edge[live] - (step < 0)]]]
            edge[live] += step
            live = live[high[live] > low[live]]
    percent = (high == low) & (stops - starts == 1) & (data[starts] == 37) if len(starts) else np.zeros(0, bool)
    high[percent] = stops[percent]
    low[percent] = starts[percent]
    real = high > low
    count = np.concatenate(([0], np.cumsum(real)))
    words = count[words]
    low, high, sentence = low[real], high[real], sentence[real]
    if not len(low):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), words, np.zeros(0, bool)
    low, high, sentence, words = _split_units(data, low, high, sentence, words)
    # a word's hash reads its own bytes only
    own = np.repeat(low - np.concatenate(([0], np.cumsum(high - low)[:-1])), high - low) + np.arange(int((high - low).sum()))
    packed = data[own]
    at = np.concatenate(([0], np.cumsum(high - low)))
    value = T.word_hashes(packed, at[:-1], at[1:], T.LOWER_VALUES)
    per_word = lambda table: np.add.reduceat(table[packed].astype(np.int32), at[:-1])
    kind = np.zeros(len(low), np.int64)
    kind[(per_word(_DIGIT) > 0) & (per_word(_NUMERIC) == high - low)] = NUMBER
    spelt = T.member(value, _SPELT)
    kind[spelt] = NUMBER
    value[spelt] = _FIGURES[np.searchsorted(_SPELT, value[spelt])]
    capital = (kind == LITERAL) & _UPPER[packed[at[:-1]]] & (per_word(_LOWERCASE) > 0)
    # capitals of a German sentence are nouns, no sign of a name
    one = np.cumsum(sentence) - 1
    german = np.bincount(one, T.member(value, _GERMAN))
    german = (german >= GERMAN_LEAST) & (german >= GERMAN_SHARE * np.bincount(one))
    kind[capital & ~sentence & ~german[one]] = NAME
    after_number = np.concatenate(([False], kind[:-1] == NUMBER))
    after_number[words[:-1][np.diff(words) > 0]] = False
    kind[after_number & (kind != NUMBER) & T.member(value, _UNITS)] = UNIT
    return np.where(kind == LITERAL, value, _SLOT[kind]), kind, value, words, capital & sentence & (kind == LITERAL)


def _with_values(keys: np.ndarray, place: np.ndarray, literal: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Keys that hold the values of the slots too where a window has too few literals: a text of numbers alone does not meet every
    list of numbers in the benchmark.
    """
    few = np.flatnonzero(literal < min(LITERALS, size))
    if len(few):
        values = T.mix(value[place[few][:, None] + np.arange(size)]) * T.powers(size)[:size]
        keys[few] = T.mix(keys[few] ^ values.sum(1))
    return keys


def _within(marked: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """How many words of each window are marked."""
    count = np.concatenate(([0], np.cumsum(marked)))
    return count[place + size] - count[place]


def item_keys(hashes: np.ndarray, kind: np.ndarray, value: np.ndarray, maybe: np.ndarray, place: np.ndarray, size: int):
    """Keys of an item's windows of ``size`` canonical words, where these are, and hashes of their first halves.

    A window whose words may be names stands with all of them as literals, all as names, and all but one as either: every reading
    where there are up to three of them, and a number of keys linear in ``size`` for any number.
    """
    powers, half = T.powers(size)[:size], size // 2
    raw = np.zeros((2, len(place)), np.uint64)  # of the whole window and of its first half
    change = np.zeros_like(raw)
    step = lambda at, k: (_SLOT[NAME] - hashes[at + k]) * powers[k] * maybe[at + k]
    for k in range(size):
        rows = slice(0, 2 if k < half else 1)
        raw[rows] += hashes[place + k] * powers[k]
        change[rows] += step(place, k)
    literal, open_words = _within(kind == LITERAL, place, size), _within(maybe, place, size)
    parts = [(raw, place, literal)]
    if (some := np.flatnonzero(open_words)).size:
        named = raw[:, some] + change[:, some]
        parts.append((named, place[some], literal[some] - open_words[some]))
    for k in range(size):
        for least, sign in ((2, 1), (3, -1)):
            pick = np.flatnonzero((open_words >= least) & maybe[place + k])
            one = np.zeros((2, len(pick)), np.uint64)
            one[: 2 if k < half else 1] = step(place[pick], k)
            if sign > 0:
                parts.append((raw[:, pick] + one, place[pick], literal[pick] - 1))
            else:
                parts.append((raw[:, pick] + change[:, pick] - one, place[pick], literal[pick] - open_words[pick] + 1))
    raw = np.concatenate([x[0] for x in parts], axis=1)
    place, literal = (np.concatenate([x[i] for x in parts]) for i in (1, 2))
    return _with_values(T.mix(raw[0]), place, literal, value, size), place, np.unique(raw[1])


def text_keys(hashes: np.ndarray, kind: np.ndarray, value: np.ndarray, maybe: np.ndarray, place: np.ndarray, size: int, halves: np.ndarray):
    """Keys of a text's windows at some places, and where these are: one for every reading of the words that may be names whose first half
    is among the sorted ``halves`` of the items.
    """
    powers, half = T.powers(size)[:size], size // 2
    raw, literal = np.zeros(len(place), np.uint64), _within(kind == LITERAL, place, size)
    for k in range(size):
        pick = np.flatnonzero(maybe[place + k])
        named, word = raw[pick] + _SLOT[NAME : NAME + 1] * powers[k], hashes[place + k] * powers[k]
        raw = np.append(raw + word, named)
        place, literal = np.append(place, place[pick]), np.append(literal, literal[pick] - 1)
        if k + 1 == half:
            live = np.flatnonzero(T.member(raw, halves))
            raw, place, literal = raw[live], place[live], literal[live]
    return _with_values(T.mix(raw), place, literal, value, size), place


def joined_runs(hashes: np.ndarray, kind: np.ndarray, value: np.ndarray, words: np.ndarray, maybe: np.ndarray):
    """Canonical words with runs of names and of numbers as one word each, and which texts had any."""
    again = np.zeros(len(hashes), bool)
    again[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME))
    again[words[:-1][np.diff(words) > 0]] = False
    count = np.concatenate(([0], np.cumsum(again)))
    had = count[words[1:]] > count[words[:-1]]
    if not had.any():
        return (hashes, kind, value, words, maybe), had
    begin = np.flatnonzero(~again)
    size = np.diff(np.append(begin, len(hashes)))
    place = np.arange(len(hashes)) - np.repeat(begin, size)
    whole = T.mix(np.add.reduceat(value * T.powers(int(size.max()))[place], begin))
    return (hashes[begin], kind[begin], np.where(size > 1, whole, value[begin]), words - count[words], maybe[begin]), had


class _Alignment:
    """Places in a document of an item's words, in order, with slots that agree one to one; -1 where there is none."""

    def __init__(self, length: int):
        self.to = np.full(length, -1)
        self.forward: dict = {}
        self.backward: dict = {}

    def agrees(self, pairs: list) -> bool:
        return all(self.forward.get((k, a), b) == b and self.backward.get((k, b), a) == a for k, a, b in pairs)

    def add(self, p: int, w: int, size: int, pairs: list) -> None:
        if size - len(pairs) < min(LITERALS, size) and any(a != b for _, a, b in pairs):
            return
        held, after = self.to[p : p + size], self.to[p + size :]
        place = w + np.arange(size)
        if ((held >= 0) & (held != place)).any() or self.to[:p].max(initial=-1) >= w or (after[after >= 0] < w + size).any():
            return
        if self.agrees(pairs):
            self.forward.update(((k, a), b) for k, a, b in pairs)
            self.backward.update(((k, b), a) for k, a, b in pairs)
            self.to[p : p + size] = place


class Items:
    """One block of the benchmark: windows by hash, and the canonical words of its items."""

    def __init__(self, ids: list[int], texts: list[str], width: int, joined: bool = False):
        # once more in lower case: copies in capitals, or with every word a sentence, show no names
        data, ends = T.column_bytes(pa.array([*texts, *(t.lower() for t in texts)], pa.string()))
        self.ids, self.width = ids + ids, width
        words = canonical(data, ends)
        self.joined = None
        if joined:
            words, had = joined_runs(*words)
            self.runs = bool(had.any())
        else:
            self.joined = Items(ids, texts, width, True)
        self.hashes, self.kind, self.value, self.words, self.maybe = words
        self.length = np.diff(self.words)
        self.vocabulary = np.unique(self.hashes[self.kind == LITERAL])
        self.tables = {}
        # items of fewer words than a window are windows of their own length
        for size in sorted({min(width, int(n)) for n in self.length if n}):
            fit = T.fits(self.words, size)
            if size < width:
                fit &= np.repeat(self.length == size, self.length)
            keys, place, halves = item_keys(self.hashes, self.kind, self.value, self.maybe, np.flatnonzero(fit), size)
            order = np.argsort(keys, kind="stable")
            self.tables[size] = (keys[order], place[order], halves)

    def matches(self, data: np.ndarray, ends: np.ndarray):
        """Per document with a consistent match: its place, and its items with the share covered."""
        words = canonical(data, ends)
        out = self._matches(*words)
        words, had = joined_runs(*words)
        if not self.joined.runs:  # then texts without runs are as they were
            hashes, kind, value, offsets, maybe = words
            size = np.diff(offsets)
            own = np.repeat(had, size)
            words = hashes[own], kind[own], value[own], np.concatenate(([0], np.cumsum(size * had))), maybe[own]
        for doc, shares in self.joined._matches(*words).items():
            for item, share in shares.items():
                out[doc][item] = max(share, out[doc].get(item, 0.0))
        return out

    def hits(self, hashes, kind, value, words, maybe):
        """Windows of texts that equal windows of items in some reading: their first words and their size."""
        # a word that no item has can only be a name there
        name = maybe & ~T.member(hashes, self.vocabulary)
        hashes, kind, maybe = np.where(name, _SLOT[NAME], hashes), np.where(name, NAME, kind), maybe & ~name
        for size, (keys, places, halves) in self.tables.items():
            every = np.flatnonzero(T.fits(words, size))
            for first in range(0, len(every), WINDOWS):
                grams, at = text_keys(hashes, kind, value, maybe, every[first : first + WINDOWS], size, halves)
                for g in np.flatnonzero(T.member(grams, keys)):
                    for p in places[np.searchsorted(keys, grams[g], "left") : np.searchsorted(keys, grams[g], "right")]:
                        yield int(at[g]), int(p), size

    def _matches(self, hashes, kind, value, words, maybe):
        found: dict = defaultdict(lambda: defaultdict(set))
        for w, p, size in self.hits(hashes, kind, value, words, maybe):
            doc = int(np.searchsorted(words, w, "right")) - 1
            item = int(np.searchsorted(self.words, p, "right")) - 1
            found[doc, item][w - p].add((p, size))
        out: dict = defaultdict(dict)
        for (doc, item), windows in found.items():
            text = tuple(x[words[doc] : words[doc + 1]] for x in (hashes, kind, value, maybe))
            out[doc][item] = self._covered(item, windows, int(words[doc]), text)
        return out

    def _pairs(self, p: int, w: int, size: int, kind, value):
        """Slots of two windows: kind, value and value of each, and how many of them are names only if read as such."""
        mine, other = slice(p, p + size), slice(w, w + size)
        literal = (self.kind[mine] == LITERAL) & (kind[other] == LITERAL) & (self.value[mine] == value[other])
        slots = np.flatnonzero(~literal)
        kinds = np.where(self.kind[mine] == LITERAL, NAME, self.kind[mine])[slots]
        read = int(((self.kind[mine] == LITERAL) | (kind[other] == LITERAL))[slots].sum())
        return list(zip(kinds.tolist(), self.value[mine][slots].tolist(), value[other][slots].tolist())), read

    def _covered(self, item: int, windows: dict, first: int, text: tuple) -> float:
        """The largest share of an item that an alignment covers; ``windows`` by distance, ``first`` the document's first word."""
        start, length = int(self.words[item]), int(self.length[item])
        _, kind, value, _ = text
        known = {}
        for d, own in windows.items():
            each = [(*self._pairs(p, p + d - first, size, kind, value)[::-1], p - start, size) for p, size in own]
            known[d] = sorted(each, key=lambda x: (x[0], x[2], x[3]))  # first what needs no word to be read as a name
        shifts = sorted(range(-SHIFT, SHIFT + 1), key=lambda x: (abs(x), x))
        best = 0.0
        for base in known:
            line = _Alignment(length)
            for shift in shifts:
                for _, pairs, p, size in known.get(base + shift, []):
                    line.add(p, p + start + base + shift - first, size, pairs)
            if not (line.to >= 0).any():
                continue
            for shift in shifts:
                if not (line.to < 0).any():
                    break
                self._add_runs(line, start, base + shift + start - first, text)
            best = max(best, float((line.to >= 0).mean()))
            if best == 1.0:
                break
        return best

    def _add_runs(self, line: _Alignment, start: int, distance: int, text: tuple) -> None:
        """Adds runs of at least ``RUN`` words not covered that equal those of the document at a distance."""
        hashes, kind, value, maybe = text
        low, high = max(0, -distance), min(len(line.to), len(hashes) - distance)
        if high - low < RUN:
            return
        mine, other = slice(start + low, start + high), slice(low + distance, high + distance)
        names = ((self.kind[mine] == NAME) | self.maybe[mine]) & ((kind[other] == NAME) | maybe[other])
        same = ((self.hashes[mine] == hashes[other]) | names) & (line.to[low:high] < 0)
        pairs = self._pairs(start + low, low + distance, high - low, kind, value)[0]
        literal = (self.kind[mine] == LITERAL) & (kind[other] == LITERAL) & (self.value[mine] == value[other])
        for q, pair in zip(np.flatnonzero(~literal), pairs):
            same[q] &= line.agrees([pair])
        steps = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
        for a, b in zip(steps[::2].tolist(), steps[1::2].tolist()):
            if b - a >= RUN:
                pairs = self._pairs(start + low + a, low + a + distance, b - a, kind, value)[0]
                line.add(low + a, low + a + distance, b - a, pairs)


def _search(items: Items, coverage: float):
    def searched(batches):
        for batch in batches:
            data, ends = T.column_bytes(batch.column(1))
            hit = [None] * batch.num_rows
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + (2 << 20), "right")) - 1)
                part = items.matches(data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
                for doc, shares in part.items():
                    enough = sorted((share, i) for i, share in shares.items() if share >= coverage)
                    hit[first + doc] = {items.ids[i]: share for share, i in enough}
                first = last
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([sorted(h, key=lambda i: (i is None, i)) if h else [] for h in hit], pa.list_(pa.int64())),
                    pa.array([max(h.values()) if h else 0.0 for h in hit], pa.float64()),
                ],
                ["doc_id", "row", "item_ids", "coverage"],
            )

    return searched


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int):
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    ids, texts, size = [], [], 0
    for row in rows.filter("t IS NOT NULL").orderBy("i", "t").toLocalIterator():
        if ids and size + len(row.t) > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += len(row.t)
    if ids:
        yield ids, texts


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, contaminated, item_ids, coverage`` (the largest share of an item that it covers).

    Null and empty texts are clean, and so are items without words. A null id keeps its row. Repeated items
    are listed once by id. An empty benchmark leaves all documents clean; an empty table gives no rows.
    """
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row")
    )
    schema = "doc_id long, row long, item_ids array<long>, coverage double"
    parts = [plain.mapInArrow(_search(Items(i, t, width), coverage), schema) for i, t in _blocks(benchmark, "item_id", "text", block_bytes)]
    if not parts:
        found = plain.select("doc_id", F.expr("array()").cast("array<long>").alias("item_ids"), F.lit(0.0).alias("coverage"))
    elif len(parts) == 1:
        found = parts[0]
    else:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        found = every.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),  # one list per block
            F.max("coverage").alias("coverage"),
        )
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "coverage")

"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, capitalised words (names) and units after a number are replaced by typed
placeholders whose values are kept as slots; all other words are lower-cased and stripped of punctuation. A
second template of each text keeps names as lower-case words, for copies in other case. Windows of five template words are joined by hash with those of the benchmark items. A question that was only
re-parameterised has the same template, but its slots must be consistent: over the windows that a place of a
document shares with an item, one value of the item stands for one value of the document and the reverse. A document
contains an item if the windows that are consistent make up 0.8 or more of the item's, in either template.

While the benchmark has at most ``most_windows`` windows its table is broadcast and the join needs no shuffle.
A larger one is joined by shuffle, with those windows of the documents that pass a bitmap of the benchmark's
hashes; the bitmap's size is fixed, and what it lets through by chance the join drops.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import col, free_name, lean, small_enough

WINDOW = 5
SHARE = 0.8
#: Words for numbers, and units (only after a number).
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kmh watt watts volt volts joule joules".split())
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
NUMBER = re.compile(r"\d[\d.,:/]*(?:st|nd|rd|th)?")
NUM, NAME, UNIT, DEAD, NONE = (np.uint64(k) for k in (2, 4, 6, 8, 10))
BITS = 1 << 26
BASE = np.uint64(0x9E3779B97F4A7C15)


def clean(raw: str) -> str:
    return EDGE.sub("", raw)


def word_id(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed=1) & -2 | 16


UNIT_IDS = np.array(sorted(map(word_id, UNITS)), np.uint64)


class Ids(dict):
    """Template id of each raw word, odd if it may be a name, remembered up to a number of words. With a vocabulary,
    words that stand in no benchmark window are dead."""

    def __init__(self, vocabulary: set[str] | None, most: int = 200_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most

    def __missing__(self, raw: str) -> int:
        w = clean(raw)
        low = w.lower()
        if not w:
            k = NONE
        elif NUMBER.fullmatch(w) or low in NUMBER_WORDS:
            k = NUM
        elif self.vocabulary is None or low in self.vocabulary or low in UNITS:
            k = word_id(low)
        else:
            k = DEAD
        k = int(k)
        if w and k not in (NUM, NONE) and w[0].isupper() and (len(w) == 1 or w[1:].islower()):
            k += 1
        if len(self) >= self.most:
            self.clear()  # the frequent words are soon met again
        self[raw] = k
        return k


def templates(raw: list[str], ids: Ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the plain and of the named template, and the place of each among the raw words (what is only
    punctuation has none)."""
    k = np.fromiter(map(ids.__getitem__, raw), np.uint64, len(raw))
    places = np.flatnonzero(k != NONE)
    k = k[places]
    name = (k & np.uint64(1)).astype(bool)
    k &= ~np.uint64(1)
    after_number = np.zeros(len(k), bool)
    after_number[1:] = k[:-1] == NUM
    if after_number.any():
        at = np.flatnonzero(after_number)
        at = at[np.isin(k[at], UNIT_IDS)]
        k[at] = UNIT
        name[at] = False
    return k, np.where(name, NAME, k), places


def window_hashes(k: np.ndarray, kind: int) -> np.ndarray:
    """A hash per window of WINDOW ids; of fewer ids, one of all of them."""
    n = min(WINDOW, len(k))
    if not n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(len(k) - n + 1, 2 * n + kind, np.uint64)
        for j in range(n):
            out = (out ^ (out >> np.uint64(31))) * BASE + k[j : len(k) - n + 1 + j]
        return (out ^ (out >> np.uint64(29))) * BASE


def slots_at(raw: list[str], k: np.ndarray, places: np.ndarray, begin: int) -> list[str]:
    """Values of the placeholders in the window that begins at ``begin``."""
    end = min(begin + WINDOW, len(k))
    return [clean(raw[places[j]]).lower() for j in range(begin, end) if k[j] in (NUM, NAME, UNIT)]


Pair = tuple[int, int, tuple[str, ...], int, tuple[str, ...]]  # window, its place in the item, its slots there, its place in the document, its slots there


def consistent(pairs: list[Pair], least: float = 0) -> int:
    """Distinct windows whose slots agree with one mapping of values, one to one: that of the place of the document
    where most do, or that which most windows of the whole document vote for.

    A place is where windows follow each other as in the item; windows beside it, as an insertion leaves them, count if
    they agree with its mapping. Places that can't reach ``least`` windows are left out.
    """
    pairs = sorted(set(pairs), key=lambda p: p[3])
    most = len({p[0] for p in pairs})
    got = len(voted(pairs)[0])
    aligned = defaultdict(list)
    for p in pairs:
        aligned[p[3] - p[1]].append(p)
    span = 2 * (max((p[1] for p in pairs), default=0) + WINDOW)
    begins = [p[3] for p in pairs]
    for offset, own in sorted(aligned.items(), key=lambda x: (-len(x[1]), x[0])):
        if got == most:
            break
        beside = pairs[bisect_left(begins, offset - span) : bisect_right(begins, offset + span)]
        if len({p[0] for p in beside}) < max(least, got + 1):
            continue
        seen, there, back = voted(own)
        for w, _, item, _, doc in sorted(beside, key=lambda p: (abs(p[3] - p[1] - offset), p)):
            if w in seen:
                continue
            new, new_back = {}, {}
            if all(there.get(a, new.setdefault(a, b)) == b and back.get(b, new_back.setdefault(b, a)) == a for a, b in zip(item, doc, strict=True)):
                seen.add(w)
                for a, b in new.items():
                    there.setdefault(a, b)
                    back.setdefault(b, a)
        got = max(got, len(seen))
    return got


def voted(pairs: list[Pair]) -> tuple[set[int], dict[str, str], dict[str, str]]:
    """Windows that agree with the mapping that most pairs vote for, and the mapping from the item and back."""
    votes, back = defaultdict(Counter), defaultdict(Counter)
    for _, _, item, _, doc in pairs:
        for a, b in zip(item, doc, strict=True):
            votes[a][b] += 1
            back[b][a] += 1
    best = {a: min(c, key=lambda x: (-c[x], x != a, x)) for a, c in votes.items()}
    only = {b: min(c, key=lambda x: (-c[x], x != b, x)) for b, c in back.items()}
    both = {a: b for a, b in best.items() if only[b] == a}
    return {w for w, _, item, _, doc in pairs if all(both.get(a) == b for a, b in zip(item, doc, strict=True))}, both, {b: a for a, b in both.items()}


def signed(x) -> int:
    x = int(x)
    return x - 2**64 if x >= 2**63 else x


def bitmap(table: DataFrame) -> np.ndarray:
    """Which remainders of window hashes modulo BITS occur, a bit each; at most BITS / 64 numbers are collected."""
    place = F.col("window").bitwiseAND(F.lit(BITS - 1))
    found = table.select(F.shiftright(place, 6).alias("at"), F.expr("shiftleft(1L, cast(window & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(BITS // 64, np.int64)
    for r in found:
        out[r["at"]] = r["bits"]
    return out


def windows(df: DataFrame, key: str, text: str, known: np.ndarray | None = None) -> DataFrame:
    """Windows of each row: key, kind (of template), window (hash), place, slots, words (those of the template);
    with ``known`` only those whose bit is set."""
    sent = None if known is None else df.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(None)
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (t or "").split()
                *kinds, places = templates(raw, ids)
                rows = {}
                for kind, k in enumerate(kinds):
                    h = window_hashes(k, kind)
                    at = np.arange(len(h)) if sent is None else passing(h, sent.value)
                    for j in at.tolist():
                        rows[kind, signed(h[j]), j, tuple(slots_at(raw, k, places, j))] = [clean(raw[p]).lower() for p in places[j : j + WINDOW]]
                if rows:
                    kind, window, place, slots = zip(*rows, strict=True)
                    texts = pa.list_(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), batch.schema.field(0).type), pa.array(kind, pa.int32()), pa.array(window, pa.int64()), pa.array(place, pa.int64()), pa.array(map(list, slots), texts), pa.array(list(rows.values()), texts)], ["key", "kind", "window", "place", "slots", "words"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(col(key), col(text)).mapInArrow(lean(run), f"key {kind}, kind int, window long, place long, slots array<string>, words array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = SHARE, most_windows: int = 200_000) -> DataFrame:
    """(doc_id, item_id, windows, matched, share) for every document that contains an item.

    Null and empty texts contain nothing, and items without words are contained in nothing. A text of fewer
    than five words is one window, which only an equally short text can share. Repeated documents give one row,
    a null id is a document like any other, equal items are each reported; further columns don't matter.
    """
    # Items get a number of their own, so that repeated and null ids stay apart or together as their texts do.
    items = benchmark.select(col(item_id).alias("item_id"), F.coalesce(col(item_text), F.lit("")).alias("t")).withColumn("item", F.xxhash64("item_id", "t"))
    names = items.select("item", "item_id").distinct()
    table = windows(items.dropDuplicates(["item"]), "item", "t").withColumnsRenamed({"key": "item", "place": "item_place", "slots": "item_slots"})
    found = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("t"))
    if small_enough(table, most_windows):
        pairs = broadcast_matches(found, table, share)
    else:
        pairs = shuffle_matches(found, table, share)
    best = pairs.groupBy("doc_id", "item").agg(F.max(F.struct((F.col("matched") / F.col("windows")).alias("share"), "windows", "matched")).alias("best"))
    return best.join(names, "item").select("doc_id", "item_id", "best.windows", "best.matched", "best.share")


def broadcast_matches(docs: DataFrame, table: DataFrame, share: float) -> DataFrame:
    rows = table.collect()  # at most most_windows
    by_window, totals = defaultdict(list), defaultdict(set)
    for r in rows:
        by_window[r["window"] % 2**64].append(((r["item"], r["kind"]), r["item_place"], tuple(r["item_slots"])))
        totals[r["item"], r["kind"]].add(r["window"])
    vocabulary = {w for r in rows for w in r["words"]}
    hashes = np.array(sorted(by_window), np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast((dict(by_window), {k: len(v) for k, v in totals.items()}, vocabulary, hashes))

    def found_in(text: str, ids: Ids) -> Iterator[tuple[int, int, int]]:
        by_window, totals, _, hashes = sent.value
        raw = text.split()
        *kinds, places = templates(raw, ids)
        n = min(WINDOW, len(places))
        if not n or not len(hashes):
            return
        for kind, k in enumerate(kinds):
            dead = np.concatenate([[0], np.cumsum(k == DEAD)])
            at = np.flatnonzero(dead[n:] == dead[: len(k) - n + 1])
            h = window_hashes(k, kind)[at]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[place] == h
            pairs = defaultdict(list)
            for j, x in zip(at[hit].tolist(), h[hit].tolist(), strict=True):
                slots = tuple(slots_at(raw, k, places, j))
                for item, item_place, item_slots in by_window[x]:
                    pairs[item].append((x, item_place, item_slots, j, slots))
            for item, p in pairs.items():
                if len({x[0] for x in p}) >= share * totals[item] and (got := consistent(p, share * totals[item])) >= share * totals[item]:
                    yield item[0], totals[item], got

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(sent.value[2])
        for batch in batches:
            out = [(row, *found) for row, t in enumerate(batch.column(1)) for found in found_in(t.as_py(), ids)]
            if out:
                at, item, total, got = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(item, pa.int64()), pa.array(total, pa.int64()), pa.array(got, pa.int64())], ["doc_id", "item", "windows", "matched"])

    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item long, windows long, matched long")


def passing(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = (h & np.uint64(BITS - 1)).astype(np.int64)
    return np.flatnonzero(known[place >> 6] >> (place & 63) & 1)


def shuffle_matches(docs: DataFrame, table: DataFrame, share: float) -> DataFrame:
    keyed = docs.withColumn("doc", F.struct("doc_id", F.xxhash64("t").alias("th")))
    totals = table.groupBy("item", "kind").agg(F.count_distinct("window").alias("windows"))
    hits = windows(keyed, "doc", "t", bitmap(table)).select(F.col("key").alias("doc"), "kind", "window", "place", "slots").join(table.drop("words"), ["kind", "window"])
    pairs = hits.groupBy("doc", "item", "kind").agg(F.collect_list(F.struct("window", "item_place", "item_slots", "place", "slots")).alias("pairs"), F.count_distinct("window").alias("shared"))
    pairs = pairs.join(totals, ["item", "kind"]).where(F.col("shared") >= share * F.col("windows")).select("doc.doc_id", "item", "windows", "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [consistent([(p["window"], p["item_place"], tuple(p["item_slots"]), p["place"], tuple(p["slots"])) for p in row], share * n) for n, row in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(got, pa.int64())], ["doc_id", "item", "windows", "matched"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(lean(run), f"doc_id {kind}, item long, windows long, matched long").where(F.col("matched") >= share * F.col("windows"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", most_broadcast: int = 1_000_000, **options) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; all columns are kept. Rows with a null id stay only
    if no row with a null id contains one."""
    key = free_name(docs, "__id")
    found = matches(docs, benchmark, doc_id, text, **options).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(F.broadcast(found) if small_enough(found, most_broadcast) else found, col(doc_id).eqNullSafe(F.col(key)), "left_anti")

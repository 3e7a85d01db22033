"""BPE encoding and decoding with a pair occurrence index.

A task lays the distinct words of its rows out as one sequence of symbols and keeps, for each
adjacent pair of symbols, the list of all positions where it occurs. Merges are applied rank by
rank, lowest first, each at all positions of its pair at once (left to right); the lists of the
pairs to the left and right of a merge are updated as it goes. Since a word's merges only depend
on the word, the outcome is the same as merging every word by itself.

The vocabulary is read on the driver from a tokenizer file whose path is a parameter and sent to the
executors as a broadcast; its size is that of the file and does not grow with the data.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer

from siltstone.llm.common import lean

#: Fixed value: the split pattern of the word-level BPE vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Merges up to this rank are applied by array operations.
LOWEST = 256
#: Unicode White_Space; Python's own \s has four control characters more.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it's printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + k)
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Symbols, merges and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.file = file.read()
        spec = json.loads(self.file)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ids.update(self.special)
        self.end = model.get("end_of_word_suffix") or ""
        size = max(self.ids.values()) + 1
        self.names = [""] * size
        for name, k in self.ids.items():
            self.names[k] = name
        self.size = size
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[a] * size + self.ids[b]] = (rank, self.ids[a + b])
        letters = byte_letters()
        self.inner = np.array([self.ids[c] for c in letters], np.int64)
        self.last = np.array([self.ids[c + self.end] for c in letters], np.int64)
        # The first merges with their pairs: key, both symbols, the new one.
        self.lowest = [(key, *divmod(key, size), new) for key, (rank, new) in self.merges.items() if rank < LOWEST]


class Encoder:
    """Encodes texts; remembers the words that it has met, up to ``most_words``."""

    def __init__(self, vocabulary: Vocabulary, most_words: int = 250_000):
        self.v, self.most_words = vocabulary, most_words
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words = regex.compile(SPLIT.replace(r"\s", SPACE))
        self.rare = regex.compile(r"[^\x00-\u024f\u2010-\u2027\u2030-\u205e]")
        self.library = Tokenizer.from_str(vocabulary.file)
        self.bytes = {c: b for b, c in enumerate(byte_letters())}
        self.turn = 0
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, tuple[str, bytes]] = {}  # a word's decoded text, and its ids in four bytes each
        self.met: set[str] = set()
        for name, k in self.v.special.items():  # a special string is kept under a key that no word has
            self.add("\0" + name, [k])

    def add(self, word: str, ids: list[int]) -> None:
        names = self.v.names
        self.known[word] = " ".join([names[k] for k in ids]), array("i", ids).tobytes()

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # Letters are lowered one by one, so a final capital sigma is not a special case.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def plain(self, text: str) -> list[str]:
        """The words of a text without special strings. Where Unicode versions may differ, the library splits."""
        if text.isascii() or not self.rare.search(text):
            return self.words.findall(self.normal(text))
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.bytes[c] for c in part).decode("utf-8") for part, _ in parts]

    def split(self, text: str) -> list[str]:
        if self.specials is None or "<|" not in text:
            return self.plain(text)
        out = []
        for part in self.specials.split(text):
            if part in self.v.special:
                out.append("\0" + part)
            elif part:
                out += self.plain(part)
        return out

    def learn(self, words: list[str]) -> None:
        """Encode new words by the pair occurrence index.

        The lowest ranks, whose pairs have many positions, are applied to all of them by array operations; from
        there on each pair has a list of its positions.
        """
        v = self.v
        size, merges = v.size, v.merges
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw]) - 1  # a wall stands after each word
        laid = v.inner[data]
        laid[ends - 1] = v.last[data[ends - 1]]
        laid[ends] = -1
        n = len(laid)
        follow, prior = np.arange(1, n + 1), np.arange(-1, n - 1)
        keys = np.full(n, -1, np.int64)
        keys[:-1] = np.where((laid[:-1] >= 0) & (laid[1:] >= 0), laid[:-1] * size + laid[1:], -1)
        for key, a, b, new in v.lowest:
            p = np.flatnonzero(keys == key)
            if a == b and len(p) > 1:  # in a run of one symbol every other position merges
                kept, taken = [], -1
                for x in p.tolist():
                    if x != taken:
                        kept.append(x)
                        taken = int(follow[x])
                p = np.array(kept)
            if not len(p):
                continue
            q = follow[p]
            laid[p], laid[q], keys[q] = new, -2, -1
            end = follow[q]
            follow[p], prior[end] = end, p
            right = laid[end]
            keys[p] = np.where(right >= 0, new * size + right, -1)
            start = prior[p]
            p, start = p[start >= 0], start[start >= 0]
            left = laid[start]
            keys[start] = np.where(left >= 0, left * size + laid[p], -1)
        order = np.argsort(keys, kind="stable")
        found, firsts = np.unique(keys[order], return_index=True)
        groups = np.split(order, firsts[1:])
        places = {key: group.tolist() for key, group in zip(found.tolist(), groups, strict=True) if key in merges}
        symbols, after, before = laid.tolist(), follow.tolist(), prior.tolist()
        queue = [(merges[key][0], key) for key in places]
        heapq.heapify(queue)
        while queue:
            _, key = heapq.heappop(queue)
            a, b = divmod(key, size)
            new = merges[key][1]
            left, right = new * size, new
            for p in sorted(places.pop(key)):
                if symbols[p] != a:
                    continue
                q = after[p]
                if symbols[q] != b:
                    continue  # another merge has taken one of the two
                symbols[p], symbols[q] = new, -2
                end = after[p] = after[q]
                before[end] = p
                x = symbols[end]
                if x >= 0 and (pair := left + x) in merges:
                    if pair in places:
                        places[pair].append(p)
                    else:
                        places[pair] = [p]
                        heapq.heappush(queue, (merges[pair][0], pair))
                start = before[p]
                if start >= 0 and (x := symbols[start]) >= 0 and (pair := x * size + right) in merges:
                    if pair in places:
                        places[pair].append(start)
                    else:
                        places[pair] = [start]
                        heapq.heappush(queue, (merges[pair][0], pair))
        merged = np.array(symbols)
        kept = merged[merged != -2]
        walls = np.flatnonzero(kept == -1)
        flat, begin = kept.tolist(), 0
        for w, wall in zip(words, walls.tolist(), strict=True):
            self.add(w, flat[begin:wall])
            begin = wall + 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids in one row, where each text's ids begin and end, and the decoded texts."""
        split = [self.split(t) for t in texts]
        if len(self.known) > self.most_words:  # words that were met again stay, while they leave room for others
            kept = {w: self.known[w] for w in self.met} if len(self.met) < self.most_words // 2 else {}
            self.forget()
            self.known.update(kept)
        known = self.known
        rows = [list(map(known.get, words)) for words in split]
        self.turn += 1
        if self.turn % 4 == 0:  # a sample shows which words come again
            for words, row in zip(split, rows, strict=True):
                self.met.update([w for w, x in zip(words, row, strict=True) if x is not None])
        missing = [(words, row, [k for k, x in enumerate(row) if x is None]) for words, row in zip(split, rows, strict=True) if None in row]
        if missing:
            self.learn(list({words[k] for words, _, at in missing for k in at}))
            for words, row, at in missing:
                for k in at:
                    row[k] = known[words[k]]
        decoded = [" ".join([x[0] for x in row]) for row in rows]
        parts = [b"".join([x[1] for x in row]) for row in rows]
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in parts])]).astype(np.int64)
        return np.frombuffer(b"".join(parts), np.int32), ends, decoded


#: A Python worker's encoders by vocabulary: what a task has learnt serves the worker's next tasks as well.
ENCODERS: dict[int, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    key = hash(vocabulary.file)
    if key not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[key] = Encoder(vocabulary)
    return ENCODERS[key]


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Slices of about ``most`` bytes; a longer text is a slice of its own."""
    begin = total = 0
    for k, n in enumerate(sizes):
        if k > begin and total + n > most:
            yield begin, k
            begin, total = k, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(df: DataFrame, path: str, text: str = "text", most_chars: int = 1_000_000) -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``decoded`` (string) for column ``text``.

    Strings of special tokens inside a text become their ids. A null or empty text has no ids and
    decodes to the empty string. Columns of ``df`` that are named ``ids`` or ``decoded`` are replaced;
    all others are kept. Decoding joins the tokens by one space, as a tokenizer without decoder does.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))
    df = df.drop("ids", "decoded")
    names = df.columns
    where = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(where)), 0).to_pylist()
            for begin, end in chunks(sizes, most_chars):
                ids, ends, decoded = encoder.encode([t or "" for t in batch.column(where).slice(begin, end - begin).to_pylist()])
                arrays = [c.slice(begin, end - begin) for c in batch.columns]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*arrays, lists, pa.array(decoded, pa.string())], [*names, "ids", "decoded"])

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with column ``to``: the tokens of ``ids`` joined by one space, special tokens included.

    A null array decodes to the empty string; ids outside the vocabulary are left out.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path).names)
    df = df.drop(to)
    names = df.columns
    where = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = vocabulary.value
        for batch in batches:
            rows = [" ".join([shown[k] for k in row or [] if k is not None and 0 <= k < len(shown)]) for row in batch.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.string())], [*names, to])

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, StructField(to, StringType())]))

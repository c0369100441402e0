"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The frequent words of the corpus, counted by Spark over all documents, are compiled with their ids into a minimal
acyclic automaton: common prefixes and suffixes are shared, arcs carry numbers whose sum along a word is its place in
the table of ids. The driver builds it once (``lexicon_size`` words at most, a fixed bound), every Python worker maps
it from a file of its own that is unlinked at once. Words that it does not hold are merged exactly. Both the automaton
and the merges walk many words at a time in numpy; a worker keeps what it found in a bounded cache.

The tokenizer file is one of the ``tokenizers`` library: NFC, lower case per character, words by its pattern, bytes as
characters, merges by rank with an end-of-word mark, no decoder (decoding joins the token strings by one space). Its
path is a parameter.

Words are split by the ``regex`` module, whose character tables are newer than the library's: letters and digits that
Unicode added after version 16 may be split another way than there.

Cases: a null text counts as empty and has no ids; special tokens in a text are their ids, as in the library; repeated
rows each give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import tempfile
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltwatch.llm.common import tidied

#: Words of the lexicon at most. Any value gives the same ids.
LEXICON_SIZE = 65_536
#: Words that a worker remembers at most, and texts' bytes that it turns out at once.
CACHE_WORDS, OUT_BYTES = 400_000, 4 << 20
_NEVER = np.int32(2**31 - 1)
_LONG = 64
_FIELD, _ODD_SPACE = regex.compile(r"\p{White_Space}+"), regex.compile(r"[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the
    rest from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Model:
    """The tables of a tokenizer file: merges, byte ids, token strings, word pattern, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        _, first = np.unique(keys, return_index=True)
        self.keys, self.ranks, self.made = keys[first], first.astype(np.int32), made[first]
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.final = np.array([vocab[c + end] for c in chars], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(*vocab.values(), *self.special.values()) + 1
        self.strings = [""] * size
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or never) and merged id of each pair; a negative id has no pair."""
        key = left.astype(np.int64) << 20 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], _NEVER), self.made[at]

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: pairs from a heap, places as a linked list."""
        b = np.frombuffer(word, np.uint8)
        ids = self.inner[b].tolist()
        ids[-1] = int(self.final[b[-1]])
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        rank, made = self.find(np.array(ids[:-1]), np.array(ids[1:]))
        table = {(x, y): (int(r), int(m)) for x, y, r, m in zip(ids, ids[1:], rank, made, strict=False)}

        def look(x: int, y: int) -> tuple[int, int]:
            if (x, y) not in table:
                r, m = self.find(np.array([x]), np.array([y]))
                table[x, y] = int(r[0]), int(m[0])
            return table[x, y]

        heap = [(r, p, ids[p], ids[p + 1]) for p, r in enumerate(rank.tolist()) if r != _NEVER]
        heapq.heapify(heap)
        while heap:
            _, p, x, y = heapq.heappop(heap)
            q = after[p]
            if q < 0 or ids[p] != x or ids[q] != y:
                continue
            ids[p], ids[q] = look(x, y)[1], -1
            after[p] = after[q]
            if after[q] >= 0:
                before[after[q]] = p
            after[q] = -1
            for l, r in ((before[p], p), (p, after[p])):
                if l >= 0 and r >= 0 and (k := look(ids[l], ids[r])[0]) != _NEVER:
                    heapq.heappush(heap, (k, l, ids[l], ids[r]))
        return np.array([i for i in ids if i >= 0], np.int32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has, by exact merges; words of like length in step."""
        places, flats, counts = [], [], []
        by_width: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_width.setdefault(min(-(-len(w) // 8) * 8, _LONG + 1), []).append(k)
        for width, group in by_width.items():
            for at in range(0, len(group), 20_000):
                some = group[at : at + 20_000]
                if width > _LONG:
                    long = [self.merge_long(words[k]) for k in some]
                    flat, count = np.concatenate(long), np.array([len(x) for x in long])
                else:
                    flat, count = self._in_step([words[k] for k in some], width)
                places.append(some)
                flats.append(flat)
                counts.append(count)
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        order = np.argsort(np.concatenate(places))
        return take(np.concatenate(flats), np.concatenate(counts), order)

    def _in_step(self, words: list[bytes], width: int) -> list[np.ndarray]:
        n = len(words)
        lengths = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.inner[raw], -1)
        ids[np.arange(n), lengths - 1] = self.final[raw[np.arange(n), lengths - 1]]
        rank = np.full((n, width), _NEVER, np.int32)
        made = np.zeros((n, width), np.int32)
        rank[:, :-1], made[:, :-1] = self.find(ids[:, :-1], ids[:, 1:])
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(axis=1)
            live = rank[rows, at] != _NEVER
            rows, at = rows[live], at[live]
            if not len(rows):
                break
            gone = after[rows, at]
            ids[rows, at] = made[rows, at]
            ids[rows, gone] = -1
            rank[rows, gone] = _NEVER
            then = after[rows, gone]
            after[rows, at] = then
            inside = then < width
            before[rows[inside], then[inside]] = at[inside]
            right = np.where(inside, ids[rows, np.minimum(then, width - 1)], -1)
            rank[rows, at], made[rows, at] = self.find(ids[rows, at], right)
            prior = before[rows, at]
            has = prior >= 0
            r, p = rows[has], prior[has]
            rank[r, p], made[r, p] = self.find(ids[r, p], ids[r, at[has]])
        keep = ids >= 0
        return ids[keep], keep.sum(axis=1)


def take(flat: np.ndarray, counts: np.ndarray, order: np.ndarray, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``flat`` (as long as ``counts`` says) in another order, and their lengths."""
    begins = counts.cumsum() - counts if begins is None else begins
    some = counts[order]
    ends = some.cumsum()
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[order] - (ends - some), some)], some


def build_automaton(words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> bytes:
    """The minimal acyclic automaton of sorted distinct words, with their ids, as one block for a memory map."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # (final, ((byte, target), ...))

    def settled(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # the open states of the word last added, from the root
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settled(node)))

    for w in words:
        same = len(os.path.commonprefix([last, w]))
        close(same)
        path.extend([False, []] for _ in range(len(w) - same))
        path[-1][0] = True
        last = w
    close(0)
    root = settled(path[0])
    holds = np.zeros(len(states), np.int64)
    keys, targets, outs = [], [], []
    for s, (final, arcs) in enumerate(states):  # a target is always settled before its source
        passed = int(final)
        for byte, target in arcs:
            keys.append(s << 8 | byte)
            targets.append(target)
            outs.append(passed)
            passed += int(holds[target])
        holds[s] = passed
    offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    parts = [
        np.array(keys, np.int64), np.array(targets, np.int64), np.array(outs, np.int64), np.array([f for f, _ in states], np.int64),
        offsets, ids.astype(np.int64), np.array([root], np.int64),
    ]
    head = np.array([len(p) for p in parts], np.int64)
    return b"".join(x.tobytes() for x in (head, *parts))


class Automaton:
    """Looks words up in a block of ``build_automaton`` that is mapped from an unlinked file."""

    PARTS = 7

    def __init__(self, block: bytes):
        with tempfile.NamedTemporaryFile() as f:
            f.write(block)
            f.flush()
            whole = np.memmap(f.name, np.int64, "r")
        at, parts = self.PARTS, []
        for n in whole[: self.PARTS]:
            parts.append(whole[at : at + int(n)])
            at += int(n)
        self.keys, self.targets, self.outs, self.finals, self.offsets, self.ids, root = parts
        self.root = int(root[0])

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among the sorted words, or -1."""
        n = len(words)
        if not n or not len(self.keys):
            return np.full(n, -1)
        lengths = np.array([len(w) for w in words])
        order = np.argsort(-lengths, kind="stable")
        width = int(min(lengths.max(), _LONG))
        raw = np.frombuffer(b"".join(words[k][:width].ljust(width, b"\0") for k in order), np.uint8).reshape(n, width)
        lengths = lengths[order]
        state, place = np.full(n, self.root, np.int64), np.zeros(n, np.int64)
        state[lengths > _LONG] = -1
        for k in range(width):
            some = np.flatnonzero((state >= 0) & (lengths > k))
            key = state[some] << 8 | raw[some, k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            state[some] = np.where(hit, self.targets[at], -1)
            place[some] += np.where(hit, self.outs[at], 0)
        out = np.empty(n, np.int64)
        out[order] = np.where((state >= 0) & (self.finals[state] == 1), place, -1)
        return out


class Encoder:
    """A worker's encoder: automaton first, exact merges for the rest, a bounded cache of what stands between spaces."""

    def __init__(self, model: Model, block: bytes):
        self.model, self.automaton = model, Automaton(block)
        self.words = regex.compile(model.pattern.replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, model.special)) + ")") if model.special else None
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def split(self, piece: str) -> list[str]:
        """Words of a text without white space; a special token is marked by a leading NUL."""
        if piece.isalpha() and piece.isascii():
            return [piece.lower()]
        out: list[str] = []
        for part in self.marks.split(piece) if self.marks else [piece]:
            if part in self.model.special:
                out.append("\0" + part)
            elif part:
                out += self.words.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Adds the ids of new pieces to the cache."""
        split = [self.split(p) for p in pieces]
        number: dict[str, int] = {}
        index = np.array([number.setdefault(w, len(number)) for words in split for w in words], np.int64)
        words = list(number)
        special = np.array([self.model.special[w[1:]] if w[0] == "\0" else -1 for w in words], np.int64)
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        at = self.automaton.find(raw)
        at[special >= 0] = -1
        known, marked = np.flatnonzero(at >= 0), np.flatnonzero(special >= 0)
        unseen = np.flatnonzero((at < 0) & (special < 0))
        sizes = np.diff(self.automaton.offsets)
        parts = [take(self.automaton.ids, sizes, at[known]), self.model.merge([raw[k] for k in unseen]), (special[marked], np.ones(len(marked), np.int64))]
        order = np.argsort(np.concatenate([known, unseen, marked]))
        flat, counts = take(np.concatenate([f for f, _ in parts]).astype(np.int32), np.concatenate([c for _, c in parts]).astype(np.int64), order)
        flat, each = take(flat, counts, index)
        owner = np.repeat(np.arange(len(pieces)), [len(x) for x in split])
        self.places.update(zip(pieces, range(len(self.places), len(self.places) + len(pieces)), strict=True))
        self.flat = np.concatenate([self.flat, flat])
        self.counts = np.concatenate([self.counts, np.bincount(owner, each, len(pieces)).astype(np.int64)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # str.split also parts at U+001C to U+001F, which are no white space here
        split = [_FIELD.split(t) if _ODD_SPACE.search(t) else t.split() for t in texts]
        if len(self.places) > CACHE_WORDS:
            self.clear()
        new = set().union(*split).difference(self.places)
        if new:
            self._learn(list(new))
        begins = self.counts.cumsum() - self.counts
        return [take(self.flat, self.counts, np.array([*map(self.places.__getitem__, pieces)], np.int64), begins)[0] for pieces in split]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.model.strings.__getitem__, ids.tolist()))


def lexicon(df: DataFrame, text_col: str, size: int) -> list[str]:
    """The most frequent runs of letters of the texts, lower case, by count over all rows.

    A word counts as frequent if it is at least one in 4 * ``size`` of the texts' words (of seven characters each), so
    that however large the corpus is, no more than about that many words come together for the choice.
    """
    characters = df.select(F.sum(F.length(text_col))).first()[0] or 0
    least = max(1, characters // (7 * 4 * max(1, size)))
    words = df.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("word")).where(F.col("word") != "")
    frequent = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return [r.word for r in frequent.orderBy(F.desc("n"), "word").limit(size).collect()]


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_size: int = LEXICON_SIZE) -> DataFrame:
    """``id_col``, ``ids`` (array of int) of each whole text, and ``decoded``, the text of those ids."""
    spark: SparkSession = df.sparkSession
    model = Model(path)
    words = sorted({unicodedata.normalize("NFC", w).encode() for w in lexicon(df, text_col, lexicon_size)})
    words = [w for w in words if len(w) <= _LONG]
    shared = spark.sparkContext.broadcast((model, build_automaton(words, *model.merge(words))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(texts):
                before = sizes[first - 1] if first else 0
                past = max(first + 1, int(np.searchsorted(sizes, before + OUT_BYTES, "right")))
                some = texts.slice(first, past - first).to_pylist()
                ids = encoder.encode(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, past - first),
                        pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32), np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)),
                        pa.array([encoder.decode(x) for x in ids], pa.string()),
                    ],
                    [id_col, "ids", "decoded"],
                )
                first = past

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, text_col).mapInArrow(tidied(run), f"`{id_col}` {kind}, ids array<int>, decoded string")


def bpe_digest(df: DataFrame, path: str) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded text."""
    coded = encode_decode(df, path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )

"""Byte-level BPE as a deterministic automaton over tokens.

Compilation. Start from the automaton that accepts every byte string with one
arc per byte. A merge ``(u, v)`` is a gadget: it adds an arc ``uv`` and cuts the
arc ``v`` from the state that ``u`` leads to. After all gadgets a state is
fully described by the last token read, and the arc ``t`` leaves state ``s``
exactly if no merge fires across the seam of ``s`` and ``t``. The arcs of the
50,257 states are not written out (that table would have 2.5 thousand million
cells): ``_seam_holds`` evaluates the gadgets for a batch of pairs and
``_PairTable`` keeps the arcs that were asked for.

Encoding. A pre-split word has exactly one path through the automaton. A byte
transition table (Aho-Corasick over the token byte strings) gives for each
prefix the tokens that end there; the last token of the prefix is the longest
of them whose arc leaves the state reached before it. All distinct words of a
batch advance together, one byte a step, in numpy. Decoding emits the byte
labels of the arcs.

Null and empty texts have the empty list of ids. Special tokens are never
produced; their spelling is ordinary text.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridloom.llm.text_core import slices
from gridloom.session import ship_package

#: Words remembered by one worker; beyond it the memory starts afresh.
MEMORY_WORDS = 150_000
#: Texts handled at a time, and characters after which a slice is closed early.
SLICE_ROWS, SLICE_CHARS = 2_000, 4_000_000


def tokenizer_file(name: str = "byte_bpe_50k.json", path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def read_merges(path: str) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    """The byte string of each id and the merges ``(left, right, made)`` in order."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab = byte_letters(), model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
    used = {i for rule in rules for i in rule} | {vocab[c] for c in letters}
    labels = [b""] * (max(used) + 1)
    for word, i in vocab.items():
        if i in used:
            labels[i] = bytes(letters[c] for c in word)
    return labels, rules


#: Arcs that a worker keeps at most; beyond it starts afresh, and arcs are worked out again when asked for.
ARCS = 4_000_000


class _PairTable:
    """Arcs asked for so far: open addressing over (state, token) keys."""

    def __init__(self, bits: int = 20):
        self.reset(bits)

    def reset(self, bits: int) -> None:
        self.bits, self.count = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.holds = np.zeros(1 << bits, np.bool_)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, holds) of each key."""
        slot = self._slot(keys)
        at = self.keys[slot]
        known, holds = at == keys, self.holds[slot]
        open_ = np.flatnonzero(~known & (at != -1))
        while open_.size:
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            known[open_[hit]] = True
            holds[open_[hit]] = self.holds[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return known, holds

    def add(self, keys: np.ndarray, holds: np.ndarray) -> None:
        if self.count and self.count + len(keys) > ARCS:
            self.reset(20)
        if (self.count + len(keys)) * 2 > 1 << self.bits:
            old = self.keys >= 0
            old_keys, old_holds = self.keys[old], self.holds[old]
            bits = self.bits + 1
            while (self.count + len(keys)) * 2 > 1 << bits:
                bits += 1
            self.reset(bits)
            self.add(old_keys, old_holds)
        self.count += len(keys)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while todo.size:
            free = self.keys[slot[todo]] == -1
            self.keys[slot[todo[free]]] = keys[todo[free]]  # of several writers one stays
            won = free & (self.keys[slot[todo]] == keys[todo])
            self.holds[slot[todo[won]]] = holds[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)


class Automaton:
    def __init__(self, labels: list[bytes], rules: list[tuple[int, int, int]], pattern: str):
        n = len(labels)
        self.labels, self.pattern = labels, regex.compile(pattern)
        self.left, self.right = np.arange(n), np.arange(n)
        self.order = np.zeros(n, np.int64)  # when a token comes to be; bytes are there from the start
        for k, (a, b, made) in enumerate(rules):
            self.left[made], self.right[made], self.order[made] = a, b, k + 1
        table = np.array(sorted((a * n + b, self.order[made]) for a, b, made in rules), np.int64).reshape(-1, 2)
        self.rule_keys, self.rule_order, self.n = table[:, 0].copy(), table[:, 1].copy(), n
        self.pairs = _PairTable()
        self.forget()
        self._compile_bytes()

    def _compile_bytes(self) -> None:
        trie: list[dict[int, int]] = [{}]
        ends, depth = [-1], [0]
        for i, label in enumerate(self.labels):
            at = 0
            for b in label:
                to = trie[at].get(b)
                if to is None:
                    to = trie[at][b] = len(trie)
                    trie.append({})
                    ends.append(-1)
                    depth.append(depth[at] + 1)
                at = to
            if label:
                ends[at] = i
        size = len(trie)
        step, fail, longest = np.zeros((size, 256), np.int32), [0] * size, list(ends)
        shorter = [-1] * len(self.labels)
        level = [0]
        while level:
            below = []
            for s in level:
                row = step[s]
                if s:
                    row[:] = step[fail[s]]
                    if ends[s] < 0:
                        longest[s] = longest[fail[s]]
                    else:
                        shorter[ends[s]] = longest[fail[s]]
                for b, to in trie[s].items():
                    fail[to] = int(row[b]) if s else 0
                    row[b] = to
                    below.append(to)
            level = below
        self.step = step.ravel()
        self.longest, self.shorter = np.array(longest, np.int32), np.array(shorter, np.int32)
        self.size = np.array([len(x) for x in self.labels], np.int32)

    def _rule(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """When the merge of a and b fires; a large number if there is none."""
        keys = a * self.n + b
        at = np.minimum(np.searchsorted(self.rule_keys, keys), len(self.rule_keys) - 1)
        return np.where(self.rule_keys[at] == keys, self.rule_order[at], np.iinfo(np.int64).max)

    def _seam_holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge ever joins the end of a with the start of b.

        Walk back in time: undo the younger of the two tokens at the seam, and
        see whether a merge across would have fired before that token came.
        On equal times the left merge of equal pairs came first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        holds = np.ones(len(a), np.bool_)
        until = np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        while live.size:
            x, y = a[live], b[live]
            clash = self._rule(x, y) < until[live]
            holds[live[clash]] = False
            live = live[~clash & ((self.order[x] > 0) | (self.order[y] > 0))]
            x, y = a[live], b[live]
            undo_left = self.order[x] > self.order[y]
            until[live] = np.where(undo_left, self.order[x], self.order[y] + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
        return holds

    def _arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = state.astype(np.int64) * self.n + token
        known, holds = self.pairs.find(keys)
        if not known.all():
            new = np.unique(keys[~known])
            self.pairs.add(new, self._seam_holds(new // self.n, new % self.n))
            holds[~known] = self.pairs.find(keys[~known])[1]
        return holds

    def _encode_words(self, words: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Non-empty words: their order by length, and in that order all ids and the number of ids of each."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        size = np.array([len(words[i]) for i in order])
        text = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        last = np.empty(len(text), np.int32)
        state = np.zeros(len(words), np.int64)
        count = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
        for i in range(int(size[0])):
            active = int(count[i])
            at = start[:active] + i
            state[:active] = self.step[state[:active] * 256 + text[at]]
            token = self.longest[state[:active]].copy()
            before = at - self.size[token]
            open_ = np.flatnonzero(before >= start[:active])
            while open_.size:
                fine = self._arcs(last[before[open_]], token[open_])
                open_ = open_[~fine]
                token[open_] = self.shorter[token[open_]]
                before[open_] = at[open_] - self.size[token[open_]]
                open_ = open_[before[open_] >= start[open_]]
            last[at] = token
        # From each end back along the path, all words at once.
        ends = np.zeros(len(text), np.bool_)
        at, word = start + size - 1, np.arange(len(words))
        while word.size:
            ends[at] = True
            at = at - self.size[last[at]]
            open_ = at >= start[word]
            at, word = at[open_], word[open_]
        path = np.flatnonzero(ends)
        return order, last[path], np.diff(np.searchsorted(path, np.append(start, len(text))))

    def _remember(self, words: list[str]) -> None:
        if len(self.memory) + len(words) > MEMORY_WORDS:
            self.forget()
        order, ids, counts = self._encode_words([w.encode("utf-8", "replace") for w in words])
        rows = len(self.memory)
        self.memory.update((words[i], rows + k) for k, i in enumerate(order))
        first = len(self.flat) + np.concatenate(([0], np.cumsum(counts)[:-1]))
        self.flat = np.concatenate([self.flat, ids])
        self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, counts])

    def forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.flat, self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where those of each text start (with the end)."""
        split = [self.pattern.findall(t) if t else [] for t in texts]
        distinct = dict.fromkeys(chain.from_iterable(split))
        new = [w for w in distinct if w not in self.memory]
        if new and len(self.memory) + len(new) > MEMORY_WORDS:
            self.forget()
            new = list(distinct)
        if new:
            self._remember(new)
        words = np.fromiter(map(self.memory.__getitem__, chain.from_iterable(split)), np.int64)
        counts = self.count[words]
        upto = np.concatenate(([0], np.cumsum(counts)))
        ids = self.flat[np.repeat(self.first[words] - upto[:-1], counts) + np.arange(int(upto[-1]))]
        return ids, upto[np.cumsum([0, *map(len, split)])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.labels[i] for i in ids).decode("utf-8", "replace")


#: The automaton of a worker, by the query it was built for.
_BUILT: dict[str, Automaton] = {}


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``(key, ids)`` of every row of ``df``; a map without shuffle.

    The merges (about 1 MB, bounded by the tokenizer) are broadcast.
    Repeated keys give repeated rows; null and empty texts give ``[]``.
    """
    spark = df.sparkSession
    ship_package(spark)
    source = spark.sparkContext.broadcast((*read_merges(tokenizer_file(path=path)), pre_split_pattern()))
    number = uuid.uuid4().hex

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _BUILT.get(number)
        if machine is None:
            _BUILT.clear()
            machine = _BUILT[number] = Automaton(*source.value)
        for batch in batches:
            texts, keys = batch.column(1).to_pylist(), batch.column(0)
            for start, end in slices(texts, SLICE_ROWS, SLICE_CHARS):
                ids, offsets = machine.encode(texts[start:end])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([keys.slice(start, end - start), lists], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")

"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The model file gives the pieces. Log scores come with a unigram model only: a model of merges
(BPE) carries ranks instead, which can't be added up, so its scores are estimated from all
texts. Every distinct word is counted once, and in each of :data:`ROUNDS` rounds the best
segmentations under the last scores are counted and the log of the pieces' shares taken (the
first scores are the logs of Zipf's law over the ranks). A text becomes marker
form (blanks as U+2581, one in front), and the segmentation with the highest sum of scores
is found over a double-array trie of the pieces' bytes. A character that no piece covers
becomes the byte pieces of its UTF-8 form; without byte fallback, the unknown piece.
Between segmentations of equal score, the one found first stands: earlier starts go first,
and only a higher score replaces.

No piece of the usual models holds a marker after another character, so the best path of
a text is made of the best paths of its words and each word is segmented once. A model
that has such pieces is handled all the same, by whole texts.

Decoding joins the pieces, puts bytes back together (broken UTF-8 becomes U+FFFD), turns
markers into blanks and drops the one in front; a text that itself holds U+2581 comes back
with a blank there. Null texts are empty, and empty texts have no pieces. Rows are coded
one by one: repeated rows need no rule, further columns are dropped but ``doc_id``, and an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import BATCH_BYTES, materialise, process_state, slices, small_batches, text_or_empty

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Kinds of pieces in a model file, and what an unknown character costs more.
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNKNOWN_PENALTY = 10.0
UNIGRAM = 1  # the type of model whose scores are logs of shares
ROUNDS = 2
NEVER = float("-inf")
MAX_WORDS = 500_000  # words whose pieces a worker remembers
MAX_WORD_CHARS = 64
TOGETHER, SIDE = 1 << 13, 64  # words segmented at once, and their bytes at most
MAX_COUNTED_CHARS = 16 << 20  # characters of the words that a task counts before it hands them on


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: number and raw value."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    prefix: bool  # a marker goes in front of every text
    kind: int = UNIGRAM

    @staticmethod
    def read(path: str | None = None) -> Model:
        """The pieces of a model file and how it wants blanks treated."""
        pieces, scores, kinds, prefix, kind = [], [], [], True, UNIGRAM
        for field, value in _fields(Path(path or public_tokenizers.path(MODEL)).read_bytes()):
            if field == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode("utf-8"))
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif field == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                rules = dict(_fields(value))
                prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("models that rewrite characters or merge blanks are not supported")
        return Model(pieces, scores, kinds, prefix, kind)


class DoubleArray:
    """A trie over bytes in three arrays.

    From node ``s``, byte ``c`` leads to ``t = base[s] + c + 1`` if ``check[t] == s``;
    ``value[t]`` is the id of the piece that ends there, or -1.
    """

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for key, id_ in keys.items():
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = id_
        size = 2 * len(children) + 600
        taken = bytearray(size)
        base, check, value = array("i", [0]) * size, array("i", [-1]) * size, array("i", [-1]) * size
        taken[0] = 1
        place = {0: 0}
        # Places below 257 suit few codes. Lone children fill gaps; families look on from the last room found.
        free, ahead, queue = 257, 257, [0]
        for node in queue:
            kids = children[node]
            if not kids:
                continue
            codes = sorted(kids)
            while taken[free]:
                free += 1
            at = max(0, (free if len(codes) == 1 else max(free, ahead)) - codes[0] - 1)
            tries = 0
            while True:
                while at + 258 >= len(taken):
                    more = len(taken)
                    taken.extend(bytes(more))
                    base.extend([0] * more)
                    check.extend([-1] * more)
                    value.extend([-1] * more)
                if not any(taken[at + c + 1] for c in codes):
                    break
                at, tries = at + 1, tries + 1
            if tries > 64:
                ahead = at + codes[0] + 1
            here = place[node]
            base[here] = at
            for c in codes:
                to = at + c + 1
                taken[to] = 1
                check[to] = here
                value[to] = ends[kids[c]]
                place[kids[c]] = to
                queue.append(kids[c])
        keep = max(place.values()) + 258
        self.base, self.check, self.value = (a[:keep] for a in (base, check, value))


class Coder:
    """Encodes and decodes with one model."""

    def __init__(self, model: Model, trie: DoubleArray):
        self.model = model
        self.base, self.check, self.value = trie.base.tolist(), trie.check.tolist(), trie.value.tolist()
        self.arrays = [np.array(a, np.int32) for a in (trie.base, trie.check, trie.value)]
        self.scores = list(model.scores)
        self.longest = max(len(p.encode("utf-8")) for p in model.pieces)
        normal = [s for s, k in zip(model.scores, model.kinds) if k == NORMAL]
        self.unknown_score = min(normal, default=0.0) - UNKNOWN_PENALTY
        for i, kind in enumerate(model.kinds):
            if kind == USER:  # always chosen: scores above any sum of its parts
                self.scores[i] = len(model.pieces[i].encode()) * max(normal, default=0.0) - 0.1
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.unknown = model.kinds.index(UNKNOWN) if UNKNOWN in model.kinds else 0
        in_trie = [p for p, k in zip(model.pieces, model.kinds) if k in (NORMAL, USER)]
        self.by_words = not any(MARK in p.lstrip(MARK) or "\n" in p for p in in_trie)
        self.chunk = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        self.words: dict[str, bytes] = {}
        self.surface = [
            bytes([int(p[1:-1], 16)]) if k == BYTE else p.encode() if k in (NORMAL, USER) else b""
            for p, k in zip(model.pieces, model.kinds)
        ]
        self.surface[self.unknown] = " ⁇ ".encode()

    def best(self, text: str) -> list[int]:
        """Ids of the segmentation with the highest score."""
        data = text.encode("utf-8")
        n, base, check, value, scores = len(data), self.base, self.check, self.value, self.scores
        top = [NEVER] * n + [NEVER]
        came, ids = [0] * (n + 1), [-1] * (n + 1)
        top[0], i = 0.0, 0
        while i < n:
            here, first = top[i], data[i]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            single, node, j = i + width, 0, i
            for byte in data[i : i + self.longest]:
                to = base[node] + byte + 1
                if check[to] != node:
                    break
                node, j = to, j + 1
                id_ = value[node]
                if id_ >= 0:
                    score = here + scores[id_]
                    if score > top[j]:
                        top[j], came[j], ids[j] = score, i, id_
                    if j == single:
                        single = -1
            if single >= 0:
                score = here + self.unknown_score
                if score > top[single]:
                    top[single], came[single], ids[single] = score, i, -1
            i += width
        return self._back(data, came, ids)

    def _back(self, data: bytes, came: list[int], ids: list[int]) -> list[int]:
        out, at = [], len(data)
        while at:
            start = came[at]
            if ids[at] >= 0:
                out.append(ids[at])
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(data[start:at]))
            else:
                out.append(self.unknown)
            at = start
        return out[::-1]

    def best_of(self, words: list[str]) -> list[list[int]]:
        """:meth:`best` of each word. Short words take each step of the search together."""
        data = [w.encode("utf-8") for w in words]
        out = [[] if len(d) <= SIDE else self.best(w) for d, w in zip(data, words)]
        short = sorted((k for k, d in enumerate(data) if 0 < len(d) <= SIDE), key=lambda k: len(data[k]))
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            for k, ids in zip(some, self._together([data[k] for k in some])):
                out[k] = ids
        return out

    def _together(self, data: list[bytes]) -> list[list[int]]:
        n = np.array([len(d) for d in data])
        side = int(n.max())
        text = np.frombuffer(b"".join(d.ljust(side, b"\0") for d in data), np.uint8).reshape(len(data), side)
        (base, check, value), scores = self.arrays, np.array(self.scores)
        top = np.full((len(data), side + 1), NEVER)
        came, ids = np.zeros(top.shape, np.int32), np.full(top.shape, -1, np.int32)
        top[:, 0] = 0.0

        def reach(rows: np.ndarray, end: np.ndarray | int, score: np.ndarray, start: int, id_: np.ndarray | int) -> None:
            better = score > top[rows, end]
            rows, end, id_ = rows[better], np.broadcast_to(end, better.shape)[better], np.broadcast_to(id_, better.shape)[better]
            top[rows, end], came[rows, end], ids[rows, end] = score[better], start, id_

        for i in range(side):
            rows = np.flatnonzero((n > i) & (text[:, i] & 0xC0 != 0x80))
            first, here = text[rows, i], top[rows, i]
            width = 1 + (first >= 0x80).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
            single = np.ones(len(rows), bool)
            live, node = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for j in range(i, min(side, i + self.longest)):
                inside = n[rows[live]] > j
                live, node = live[inside], node[inside]
                to = base[node] + text[rows[live], j] + 1
                found = check[to] == node
                live, node = live[found], to[found]
                if not len(live):
                    break
                id_ = value[node]
                ends = id_ >= 0
                at, id_ = live[ends], id_[ends]
                reach(rows[at], j + 1, here[at] + scores[id_], i, id_)
                single[at[width[at] == j + 1 - i]] = False
            reach(rows[single], i + width[single], here[single] + self.unknown_score, i, -1)
        return [self._back(*x) for x in zip(data, came.tolist(), ids.tolist())]

    def learn(self, texts: list[list[str]]) -> None:
        """Segments the words of split texts that aren't remembered yet."""
        if len(self.words) >= MAX_WORDS:
            self.words.clear()
        new = [w for w in set().union(*texts).difference(self.words) if len(w) <= MAX_WORD_CHARS]
        self.words.update(zip(new, (array("I", ids).tobytes() for ids in self.best_of(new))))

    def _word(self, word: str) -> bytes:
        ids = array("I", self.best(word)).tobytes()
        if len(word) <= MAX_WORD_CHARS:
            if len(self.words) >= MAX_WORDS:
                self.words.clear()
            self.words[word] = ids
        return ids

    def split(self, text: str) -> list[str]:
        """The words of a text in marker form, or all of it as one."""
        if not text:
            return []
        marked = (MARK if self.model.prefix else "") + text.replace(" ", MARK)
        return self.chunk.findall(marked) if self.by_words else [marked]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        return self._encoded(self.split(text))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        words = [self.split(t) for t in texts]
        if self.by_words:
            self.learn(words)
        return [self._encoded(w) for w in words]

    def _encoded(self, words: list[str]) -> bytes:
        if not self.by_words:
            return b"".join(array("I", self.best(w)).tobytes() for w in words)
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if f is None else f for w, f in zip(words, found)]
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.surface.__getitem__, array("I", ids))).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


def coder(model: Model, trie: DoubleArray) -> Coder:
    key = hashlib.sha256(repr((model.pieces, model.scores, model.prefix)).encode()).hexdigest()
    return process_state("pieces-" + key, lambda: Coder(model, trie), large=True)


def decoder(model: Model, trie: DoubleArray) -> Coder:
    """A coder that remembers no words; it leaves the one that encodes in place."""
    key = hashlib.sha256(repr((model.pieces, model.prefix)).encode()).hexdigest()
    return process_state("pieces-decoder-" + key, lambda: Coder(model, trie))


def trie_of(model: Model) -> DoubleArray:
    kept = enumerate(zip(model.pieces, model.kinds))
    return DoubleArray({p.encode("utf-8"): i for i, (p, k) in kept if k in (NORMAL, USER) and p})


def ranked(model: Model) -> Model:
    """Scores by Zipf's law over the ranks of the pieces."""
    normal = [i for i, k in enumerate(model.kinds) if k == NORMAL]
    total = math.log(sum(1 / r for r in range(1, len(normal) + 1)) or 1.0)
    scores = list(model.scores)
    for r, i in enumerate(sorted(normal, key=lambda i: (-model.scores[i], i)), 1):
        scores[i] = -math.log(r) - total
    return replace(model, scores=scores)


def estimated(model: Model, trie: DoubleArray, docs: DataFrame) -> Model:
    """The model with log scores from all texts. Sums are of whole numbers, so runs agree.

    The driver gets one count for each piece at most; a piece never chosen counts as chosen once.
    """
    context = docs.sparkSession.sparkContext
    model = ranked(model)
    sent = context.broadcast((model, trie))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, seen, chars = coder(*sent.value), Counter(), 0

        def out() -> Iterator[pa.RecordBatch]:
            while seen:
                some = [seen.popitem() for _ in range(min(len(seen), 1 << 16))]
                words, counts = zip(*some)
                yield pa.record_batch({"word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())})

        for whole in batches:
            for batch in slices(whole, "text"):
                for text in batch.column("text").to_pylist():
                    before = len(seen)
                    words = use.split(text)
                    seen.update(words)
                    if len(seen) > before:
                        chars += len(text)
                    if chars > MAX_COUNTED_CHARS:
                        yield from out()
                        chars = 0
        yield from out()

    words = small_batches(docs.select(text_or_empty())).mapInArrow(count, "word string, n long")
    words = materialise(words.groupBy("word").agg(F.sum("n").alias("n")), "pieces-words")
    for _ in range(ROUNDS):
        sent = context.broadcast((model, trie))

        def choose(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            use, chosen = coder(*sent.value), Counter()
            words, counts, chars = [], [], 0

            def add() -> None:
                for ids, n in zip(use.best_of(words), counts):
                    for id_ in ids:
                        chosen[id_] += n

            for whole in batches:
                for batch in slices(whole, "word"):
                    words += batch.column("word").to_pylist()
                    counts += batch.column("n").to_pylist()
                    chars += batch.nbytes
                    if len(words) >= TOGETHER or chars >= BATCH_BYTES:
                        add()
                        words, counts, chars = [], [], 0
            add()
            yield pa.record_batch({"id": pa.array(list(chosen), pa.int32()), "n": pa.array(list(chosen.values()), pa.int64())})

        found = small_batches(words).mapInArrow(choose, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
        counts = {r.id: r.n for r in found.collect() if model.kinds[r.id] == NORMAL}
        if not counts:
            break
        normal = [i for i, k in enumerate(model.kinds) if k == NORMAL]
        total, scores = math.log(sum(counts.values()) + len(normal)), list(model.scores)
        for i in normal:
            scores[i] = math.log(counts.get(i, 0) + 1) - total
        model = replace(model, scores=scores)
    return model


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, n_bytes``: little-endian 32-bit ids and how many are byte pieces.

    Model and trie are built once on the driver and go along as a broadcast of some megabytes.
    A model of merges gets its scores from ``docs`` first, in jobs of their own.
    """
    model = Model.read(path)
    trie = trie_of(model)
    if model.kind != UNIGRAM:
        model = estimated(model, trie, docs)
    sent = docs.sparkSession.sparkContext.broadcast((model, trie))
    byte_ids = np.array([k == BYTE for k in model.kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(*sent.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = use.encode_all(batch.column("text").to_pylist())
                fell = [int(byte_ids[np.frombuffer(i, "<u4")].sum()) for i in ids]
                yield pa.record_batch(
                    {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary()), "n_bytes": pa.array(fell, pa.int64())}
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty())
    return small_batches(texts).mapInArrow(run, "doc_id long, ids binary, n_bytes long")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of :func:`encode` with ``text`` put back together."""
    model = Model.read(path)
    sent = encoded.sparkSession.sparkContext.broadcast((model, trie_of(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = decoder(*sent.value)
        for whole in batches:
            for batch in slices(whole, "ids"):
                texts = [use.decode(i) for i in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"]
                )

    columns = encoded.select("doc_id", "ids", "n_bytes")
    return small_batches(columns).mapInArrow(run, "doc_id long, ids binary, n_bytes long, text string")


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        "n_bytes",
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )

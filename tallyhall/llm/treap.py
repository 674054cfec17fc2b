"""Ranked lexical search over a grid of terms and documents in a K2-treap.

A shard of documents is a square grid: a row for each term that any item asks for, a
column for each document in order of doc_id, and in a cell the impact of the term there.
The grid is kept as a compressed quadtree: of each level only the cells that hold anything,
each with a mask of its four quarters, where they begin in the next level, and the largest
score within. An item's rows each walk a path of their own through the quarters, all of
them jointly down the same ranges of documents: a range's bound is the sum of its rows'
maxima, and the ranges with the best bounds are opened first, a block at a time, until none
left can reach the item's k-th score. At the last level bounds are the scores.

Statistics are sums over all documents; only the items' terms (in blocks of items with at
most :data:`MAX_TERMS` of them) are sent to the tasks. Texts are read once: what stays is
the postings of those terms. Every shard holds at most :data:`MAX_DOCS` documents, or
:data:`MAX_CELLS` cells, and gives an item at most k rows; a task carries an item's k-th
score from shard to shard. Terms are told apart by 64-bit hashes.

Null texts have no terms; repeated rows are documents of their own; null doc_ids come last
among equal scores, null item_ids are items like others; items that share an id are ranked
each on its own, so their ranks appear side by side; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import materialise, slices, small_batches, text_or_empty
from tallyhall.llm.spans import LETTERS, LOWER, binary, find_words, flat, word_hashes

K = 50
SCALE, UNIT = 1_000_000_000, 1000
B_PERCENT = 50  # how much of a document's length counts
SATURATION = 20  # times the length share, against UNIT times the frequency
MAX_DOCS, MAX_CELLS = 1 << 15, 1 << 22  # of a shard
MAX_TERMS = 1 << 21  # terms of one block of items
OPENED = 1 << 14  # rows of nodes opened at once: ranges times terms
PENDING = 1 << 24  # rows of nodes that wait; beyond, the deepest are opened first


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of a batch, in order, and the text it is in."""
    data, places = flat(column)
    data = LOWER[data]
    starts, ends, text = find_words(LETTERS[data], places)
    return word_hashes(data, starts, ends), text


def term_hashes(items: DataFrame) -> DataFrame:
    """``row, item_id, hashes``: the distinct terms of every item, sorted."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, text = terms(batch.column("text"))
            order = np.lexsort((hashes, text))
            hashes, text = hashes[order], text[order]
            fresh = np.ones(len(hashes), bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
            hashes, text = hashes[fresh], text[fresh]
            places = np.searchsorted(text, np.arange(batch.num_rows + 1))
            yield pa.record_batch({"item_id": batch.column("item_id"), "hashes": binary(hashes, places)})

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty())
    return small_batches(texts).mapInArrow(split, "item_id long, hashes binary")


POSTINGS = "doc_id long, n long, terms binary, counts binary"


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """Every document's length and its counts of the vocabulary's terms (sorted hashes)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, text = terms(batch.column("text"))
                n = np.bincount(text, minlength=batch.num_rows)
                at = np.searchsorted(known, hashes)
                at[at == len(known)] = 0
                hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                pair, count = np.unique(text[hit] * np.int64(max(1, len(known))) + at[hit], return_counts=True)
                doc, term = np.divmod(pair, max(1, len(known)))
                places = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n": pa.array(n, pa.int64()),
                        "terms": binary(term.astype(np.int32), places),
                        "counts": binary(count.astype(np.int64), places),
                    }
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty())
    return small_batches(texts).mapInArrow(scan, POSTINGS)


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, _ = flat(batch.column("terms"))
            total += np.bincount(data.view(np.int32), minlength=size)
        used = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(used, pa.int32()), "df": pa.array(total[used])})

    out = np.zeros(size, np.int64)
    sums = found.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in sums.collect():  # a number for each term of the items
        out[r["term"]] = r["df"]
    return out


def impacts(counts: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term counts in a document, before its weight: whole numbers, rounded down."""
    share = (100 - B_PERCENT) + (B_PERCENT * n * documents) // max(1, length)
    return (SCALE * counts) // (UNIT * counts + SATURATION * share)


class Treap:
    """A K2-treap over cells ``(row, column, score)`` of a square grid."""

    def __init__(self, row: np.ndarray, column: np.ndarray, score: np.ndarray, side: int):
        self.height = max(1, (side - 1).bit_length())
        code = np.zeros(len(row), np.int64)
        for bit in range(self.height):  # row and column bits in turn: quarters of quarters
            code |= ((row >> bit) & 1) << (2 * bit + 1) | ((column >> bit) & 1) << (2 * bit)
        order = np.argsort(code, kind="stable")
        code, top = code[order], score[order]
        #: From the root down: mask of quarters that hold anything, first of them below, largest score.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.cells = top
        for _ in range(self.height):
            parent = code >> 2
            first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(code) else np.empty(0, np.int64)
            if len(first):
                mask = np.bitwise_or.reduceat(1 << (code & 3), first).astype(np.uint8)
                top = np.maximum.reduceat(top, first)
            else:
                mask = np.empty(0, np.uint8)
            self.levels.append((mask, first.astype(np.int32), top))
            code = parent[first]
        self.levels.reverse()

    def maxima(self, depth: int) -> np.ndarray:
        return self.levels[depth][2] if depth < self.height else self.cells

    def below(self, depth: int, node: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The given quarter of each node, -1 where it is empty; nodes of -1 have none."""
        mask, first, _ = self.levels[depth]
        here = np.maximum(node, 0)
        held = mask[here]
        some = (node >= 0) & ((held >> quarter) & 1 == 1)
        rank = _ONES[held & ((1 << quarter) - 1)]
        return np.where(some, first[here] + rank, -1).astype(np.int32)

    def best(self, rows: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and columns of the item's best k columns with a score of ``floor`` at least.

        Equal scores go to the smaller column. Blocks of ranges wait in a heap by their best
        bound; of the block on top, the ranges with the best bounds are opened.
        """
        none = np.empty(0, np.int64)
        if not len(self.cells) or not len(rows):
            return none, none
        scores, columns = none, none
        root = np.zeros((1, len(rows)), np.int32)
        bound = self.maxima(0)[root].sum(axis=1)
        waiting: list[tuple[int, int, int, tuple]] = [(-int(bound[0]), 0, 0, (bound, np.zeros(1, np.int64), root))]
        number, pending = 1, root.size
        least, size = floor, max(1, OPENED // len(rows))
        while waiting:
            if pending > PENDING:  # go down where the end is near, so that less waits
                place = min(range(len(waiting)), key=lambda i: (-waiting[i][1], waiting[i][0]))
                waiting[place], waiting[-1] = waiting[-1], waiting[place]
                _, depth, _, block = waiting.pop()
                heapq.heapify(waiting)
            else:
                top, depth, _, block = heapq.heappop(waiting)
                if -top < least:
                    break
            bound, column, node = block
            pending -= node.size
            good = bound >= least
            if not good.all():
                bound, column, node = bound[good], column[good], node[good]
            if len(bound) > size:
                order = np.argsort(-bound, kind="stable")
                rest = order[size:]
                block = (bound[rest], column[rest], node[rest])
                heapq.heappush(waiting, (-int(bound[rest[0]]), depth, number, block))
                number, pending = number + 1, pending + block[2].size
                bound, column, node = bound[order[:size]], column[order[:size]], node[order[:size]]
            if not len(bound):
                continue
            row_bit = ((rows >> (self.height - 1 - depth)) & 1) << 1
            halves = [self.below(depth, node, row_bit[None, :] | bit) for bit in (0, 1)]
            node = np.concatenate(halves)
            column = np.concatenate([2 * column, 2 * column + 1])
            maxima = self.maxima(depth + 1)
            bound = np.where(node >= 0, maxima[np.maximum(node, 0)], 0).sum(axis=1)
            good = bound >= least
            bound, column, node = bound[good], column[good], node[good]
            if not len(bound):
                continue
            if depth + 1 < self.height:
                heapq.heappush(waiting, (-int(bound.max()), depth + 1, number, (bound, column, node)))
                number, pending = number + 1, pending + node.size
                continue
            scores, columns = np.concatenate([scores, bound]), np.concatenate([columns, column])
            if len(scores) > k:
                order = np.lexsort((columns, -scores))[:k]
                scores, columns = scores[order], columns[order]
            if len(scores) == k:
                least = max(least, int(scores.min()))
        order = np.lexsort((columns, -scores))
        return scores[order], columns[order]


_ONES = np.array([bin(i).count("1") for i in range(16)], np.int32)


def search_shards(found: DataFrame, asked, k: int) -> DataFrame:
    """The best k documents of each shard for each item: ``item, doc_id, score``.

    ``asked`` is broadcast: rows of terms of each item, weight of each term, and the sums N
    and L over all documents.
    """
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, documents, length = asked.value
        floors: dict[int, list[int]] = {}
        held: list[pa.RecordBatch] = []
        docs = cells = 0

        def shard() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            ids = table.column("doc_id").combine_chunks()
            order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            data, places = flat(table.column("terms").combine_chunks())
            term, own = data.view(np.int32).astype(np.int64), np.repeat(np.arange(len(order)), np.diff(places) // 4)
            counts = flat(table.column("counts").combine_chunks())[0].view(np.int64)
            n = table.column("n").to_numpy()
            score = weight[term] * impacts(counts, n[own], documents, length)
            some = score > 0
            treap = Treap(term[some], place[own[some]], score[some], max(len(order), len(weight), 2))
            sorted_ids = ids.take(pa.array(order))
            for item, rows in enumerate(items):
                best = floors.setdefault(item, [])
                scores, columns = treap.best(rows, k, best[0] if len(best) == k else 1)
                if not len(scores):
                    continue
                for score_ in scores.tolist():
                    heapq.heappush(best, score_) if len(best) < k else heapq.heappushpop(best, score_)
                yield pa.record_batch(
                    [pa.array(np.full(len(scores), item), pa.int32()), sorted_ids.take(pa.array(columns)), pa.array(scores)],
                    schema=schema,
                )

        for batch in batches:
            held.append(batch)
            docs += batch.num_rows
            cells += (batch.column("terms").nbytes - 4 * batch.num_rows) // 4
            if docs >= MAX_DOCS or cells >= MAX_CELLS:
                yield from shard()
                held, docs, cells = [], 0, 0
        if held:
            yield from shard()

    return found.mapInArrow(work, "item int, doc_id long, score long")


def _blocks(items: list, limit: int) -> Iterator[list]:
    block, size = [], 0
    for item in items:
        if block and size + len(item[1]) > limit:
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item[1])
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    some = term_hashes(items).filter(F.length("hashes") > 0)
    asked = [(r["item_id"], np.frombuffer(r["hashes"], np.uint64)) for r in some.collect()]
    out = None
    for block in _blocks(asked, MAX_TERMS):
        one = _search_block(spark, docs, block, k)
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def _search_block(spark, docs: DataFrame, block: list, k: int) -> DataFrame:
    known = np.unique(np.concatenate([h for _, h in block]))
    found = materialise(postings(docs, spark.sparkContext.broadcast(known)), "postings")
    total = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.sum("n").alias("L")).first()
    documents, length = total["N"], total["L"] or 0
    df = document_frequencies(found, len(known))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    rows = [np.searchsorted(known, h) for _, h in block]
    shared = spark.sparkContext.broadcast((rows, weight, documents, length))
    held = found.filter(F.length("terms") > 0)
    partial = materialise(search_shards(held, shared, k), "shard-ranks")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = partial.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id long")
    best = ranked.filter(F.col("rank") <= k).join(F.broadcast(names), "item")
    return best.select("item_id", "rank", "doc_id", "score")

"""Near duplicates by Order MinHash and banded alignment.

Words are runs of word characters, case aside. Texts with the same words in the same order
(the same text where there are no words) are copies: one row stands for all of them. Every
representative of five words or more gets :data:`SKETCHES` sketches: of its five-word
shingles, numbered by occurrence, the :data:`PICKED` with the smallest hashes, in the order
of the text. :data:`LOOSE` more sketches are of two-word shingles, of which many are left where
edits are spread over the text. Texts of four (the fewest of which one may change) to :data:`SHORT` words also get keys from runs of
their words, which no pair within the limit can miss (see :func:`short_keys`). Texts that agree
in any key are candidates. A pair is a link if the edit
distance of their words, found in a band as wide as allowed, is at most 1 -
:data:`SIMILARITY` of the longer one. Classes are the components of the links.

Candidates never meet all with all. First everyone is held against the hub that most of its
buckets have, which settles groups of near copies with one pair for each member. Where a bucket still
spans several classes, its members are compared across classes in blocks, by an exact lower
bound of the distance (binned word counts): first the closest pair of each class is aligned,
then its closest few, then, across the classes that remain, every pair that the bound can't
exclude. Classes without such a pair take no part in later rounds, as none can come up. Words
travel only for pairs that a second exact bound leaves, binned counts of two words in a row.

Rows are told apart by numbers of their own, given out once. A class is named by its
smallest doc_id; rows without an id are documents like others, and a class of such rows
alone has a null name. Rows that share an id are one document if their words agree; else
each text is classed by itself. Null texts are empty. Further columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import fresh, materialise, process_state, slices, small_batches
from tallyhall.llm.graph import components
from tallyhall.llm.spans import find_words, flat, span_hashes
from tallyhall.llm.spans import mixed as spread

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 24
PICKED = 2
LOOSE, PAIR = 32, 2  # further sketches, and the words of their shingles
SHORT = 24  # words of the longest text whose candidates are found exactly
BINS = 256  # of word counts
BLOCK = 1024  # members of a bucket compared at once
NEAREST = 1, 32  # pairs that each class tries in the rounds before all are tried
GRAMS = 6, 14  # powers of two: the fewest and most bins of a text's runs of two words
PAIRS = 1 << 20  # pairs kept before they are handed on or thinned out
STEP = 1 << 18  # pairs looked at in one step
CELLS = 1 << 26  # bits that tell which texts are fetched for alignment: 8 MB
LEAST = 4  # words of the shortest text that may differ from a similar one
MIX = np.uint64(0x9E3779B97F4A7C15)
MASK = 0xFFFFFFFFFFFFFFFF
LETTER_RADIX = 0xC2B2AE3D27D4EB4F


def _odd(count: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    return draw.integers(1, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words:
    """Hashes of the words of texts: runs of letters, digits and underscores, case aside."""

    def __init__(self) -> None:
        self.part = np.array([c == 0x5F or chr(c).isalnum() for c in range(0x110000)])

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """Hash of each word of each text."""
        lower = [t.lower() for t in texts]
        places = np.concatenate([[0], np.cumsum([len(t) for t in lower])]).astype(np.int64)
        signs = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends, text = find_words(self.part[signs], places)
        hashes = span_hashes(spread(signs.astype(np.uint64) + MIX), starts, ends, LETTER_RADIX)
        return np.split(hashes, np.searchsorted(text, np.arange(1, len(texts))))

    def hashes(self, text: str) -> np.ndarray:
        return self.of([text])[0]


def words() -> Words:
    return process_state("order-minhash-words", Words)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def labelled(hashes: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle of ``width`` words with the number of its occurrence so far, and its text."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + n]
    whole = text[:n] == text[width - 1 : width - 1 + n]
    out, own = mixed(out)[whole], text[:n][whole]
    key = mixed(out + own.astype(np.uint64) * MIX)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    if not fresh.all():
        at = np.arange(len(order))
        nth = np.empty(len(order), np.uint64)
        nth[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
        out = out + nth * MIX
    return mixed(out), own


def sketches(hashes: np.ndarray, text: np.ndarray, texts: int, width: int = SHINGLE) -> np.ndarray:
    """A row of keys, one for each sketch, for each text that has a shingle; see :func:`sketched`.

    For each sketch one pass over the shingles of all texts finds the two smallest hashes of
    every text: the place rides in the low half of the number whose least is taken.
    """
    base, own = labelled(hashes, text, width)
    seeds, factors = _SEEDS if width == SHINGLE else _LOOSE_SEEDS
    begins = np.searchsorted(own, np.flatnonzero(np.bincount(own, minlength=texts)))
    small = (base >> np.uint64(32)).astype(np.uint32)  # the draw needs no more
    place = np.arange(len(base), dtype=np.uint64)
    low, out = np.uint64(0xFFFFFFFF), np.empty((len(begins), len(seeds)), np.uint64)
    for i, (seed, factor) in enumerate(zip(seeds, factors)):
        drawn = ((small ^ np.uint32(seed & low)) * np.uint32(factor & low)).astype(np.uint64)
        drawn <<= np.uint64(32)
        drawn |= place
        picked = []
        for _ in range(PICKED):
            least = np.minimum.reduceat(drawn, begins) if len(begins) else np.empty(0, np.uint64)
            picked.append(np.where(least == MASK, low, least & low))
            drawn[picked[-1][least != MASK].astype(np.int64)] = np.uint64(MASK)
        key = np.full(len(begins), (i + 1) * 0x9E3779B97F4A7C15 + (width - SHINGLE) & MASK, np.uint64)
        for at in np.sort(np.stack(picked), axis=0):  # in the order of the text
            there = at != low
            key[there] = mixed(key[there] * factor + base[at[there].astype(np.int64)])
        out[:, i] = key
    return out.view(np.int64)


def sketched(counts: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Whether texts of so many words have sketches: both kinds only from a five-word shingle on."""
    return counts >= max(width, SHINGLE)


def all_keys(found: list[np.ndarray]) -> list[np.ndarray]:
    """All keys by which each text finds candidates, from the hashes of its words."""
    counts = np.array([len(h) for h in found])
    long_ = sketched(counts)
    out = [np.array(short_keys(h), np.int64) for h in found]
    if long_.any():
        hashes = np.concatenate([h for h, use in zip(found, long_) if use])
        text = np.repeat(np.arange(long_.sum()), counts[long_])
        both = np.concatenate([sketches(hashes, text, int(long_.sum()), w) for w in (SHINGLE, PAIR)], axis=1)
        for row, at in zip(both, np.flatnonzero(long_).tolist()):
            out[at] = np.concatenate([row, out[at]]) if len(out[at]) else row
    return out


def short_keys(hashes: np.ndarray) -> list[int]:
    """Keys of which any two texts of at most SHORT words within the limit share one.

    The longer text of a pair, of ``n`` words, is cut into one more part than there may be
    edits, so some part is whole in the shorter one too. Counted from the front, the first part
    that the edits before it fall short of has as many edits before it as parts, which bounds
    how far it may have moved. Each text gives its own parts and, for each length that a
    longer one may have, its runs of words in those places.
    """
    m, words_, out = len(hashes), hashes.tolist(), set()
    if m < LEAST or m > SHORT:
        return []
    for n in range(m, SHORT + 1):
        edits, shorter = allowed(n, n), n - m
        if shorter > edits:
            continue
        for i in range(edits + 1):
            start, end = n * i // (edits + 1), n * (i + 1) // (edits + 1)
            for by in range(max(-i, i - edits - shorter), min(i, edits - i - shorter) + 1):
                if start + by >= 0 and end + by <= m:
                    key = n << 8 | i
                    for w in words_[start + by : end + by]:
                        key = ((key ^ w) * 0x9E3779B97F4A7C15 & MASK) ^ (key >> 29)
                    out.add(key - (1 << 64) if key >> 63 else key)
    return sorted(out)


_SEEDS = (_odd(SKETCHES, 11), _odd(SKETCHES, 12))
_LOOSE_SEEDS = (_odd(LOOSE, 13), _odd(LOOSE, 14))


def allowed(n: int, m: int) -> int:
    """Edits that two texts of so many words may be apart."""
    longer = max(n, m)
    return longer - int(np.ceil(SIMILARITY * longer - 1e-9))


def distance_within(a: list, b: list, limit: int) -> int:
    """Edit distance of two sequences, or ``limit + 1`` if it is larger.

    Banded: of each column only the ``2 limit + 1`` cells near the diagonal are kept, as
    bits of two integers (steps up and down between neighbouring cells). The bit at place
    ``p`` of column ``j`` is row ``j - limit + p``, so the window slides down by itself.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return limit + 1
    if not n or not m:
        return max(n, m)
    if limit == 0:
        return 0 if a == b else 1
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    band = (1 << (2 * limit + 1)) - 1
    up, down = (((1 << (limit + 1)) - 1) << limit), 0
    turn = n - limit  # from this column on, the last row lies within the band
    score, lowest = min(limit, n), 1 << (2 * limit)
    for j, x in enumerate(b, 1):
        match = where.get(x, 0)
        shift = j - 1 - limit
        match = (match >> shift if shift >= 0 else match << -shift) & band
        diagonal = ((((match & up) + up) ^ up) | match | down) & band
        right_up = down | (band & ~(diagonal | up))
        right_down = diagonal & up
        if j <= turn:
            if not diagonal & lowest:
                score += 1
                if score - (m - turn) > limit:
                    return limit + 1
        else:
            place = 1 << (n - j + limit)
            if right_up & place:
                score += 1
            elif right_down & place:
                score -= 1
        moved = diagonal >> 1
        up = right_down | (band & ~(moved | right_up))
        down = moved & right_up
    return min(score, limit + 1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the words of two texts agree to :data:`SIMILARITY`."""
    limit = allowed(len(a), len(b))
    if abs(len(a) - len(b)) > limit or multiset_distance(a, b) > limit:
        return False
    for _ in range(2):  # what both begin with, then what both end with
        k = min(len(a), len(b))
        same = a[:k] == b[:k]
        k = k if same.all() else int(same.argmin())
        a, b = a[k:][::-1], b[k:][::-1]
    return distance_within(a.tolist(), b.tolist(), limit) <= limit


def multiset_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Words of one text that the other lacks, repeats counted, the larger way round."""
    both, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    only_a, of_a = np.unique(a, return_counts=True)
    of = np.zeros(len(both), np.int64)
    of[np.searchsorted(both, only_a)] = of_a
    common = int(np.minimum(of, counts - of).sum())
    return max(len(a), len(b)) - common


def binned(hashes: np.ndarray) -> bytes:
    """Binned word counts, up to 255: differences are never larger than the true ones."""
    found = np.bincount((hashes >> np.uint64(65 - BINS.bit_length())).astype(np.int64), minlength=BINS)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least number of edits between texts of which the binned counts are given, row by row."""
    d = x.astype(np.int16) - y.astype(np.int16)
    return np.maximum(np.maximum(d, 0).sum(axis=1, dtype=np.int32), np.maximum(-d, 0).sum(axis=1, dtype=np.int32))


def grams(hashes: np.ndarray) -> bytes:
    """Binned counts, up to 255, of the runs of two words: about as many bins as words."""
    power = min(max(GRAMS[0], len(hashes).bit_length()), GRAMS[1])
    runs = mixed(hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:])
    found = np.bincount((runs >> np.uint64(64 - power)).astype(np.int64), minlength=1 << power)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def grams_fit(x: np.ndarray, y: np.ndarray, limit: int) -> bool:
    """Whether :func:`grams` leave room for ``limit`` edits: each takes or brings two runs at most.

    Bins go by the leading bits, so sums of neighbours are the bins of a smaller number of them.
    """
    size = min(len(x), len(y))
    d = x.reshape(size, -1).sum(axis=1, dtype=np.int32) - y.reshape(size, -1).sum(axis=1, dtype=np.int32)
    return max(int(d[d > 0].sum()), -int(d[d < 0].sum())) <= 2 * limit


def limits(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """:func:`allowed` for many pairs."""
    longer = np.maximum(n, m)
    return longer - np.ceil(SIMILARITY * longer - 1e-9).astype(np.int64)


FEATURES = "row long, doc_id long, mark string, digest string, n int, sketch array<long>, bins binary"


def features(docs: DataFrame) -> DataFrame:
    """Number, digest of the words, their count, keys and binned counts of every row, once written.

    ``mark`` tells texts apart as they stand.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("mark"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        known, row = words(), TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text"):
                out: dict[str, list] = {"digest": [], "n": [], "sketch": [], "bins": []}
                found = batch.column("text").to_pylist()
                hashes = known.of(found)
                for text, h, keys in zip(found, hashes, all_keys(hashes)):
                    data = h.tobytes() if len(h) else b"text" + text.encode("utf-8", "surrogatepass")
                    out["digest"].append(hashlib.blake2b(data, digest_size=16).hexdigest())
                    out["n"].append(len(h))
                    out["sketch"].append(keys)
                    out["bins"].append(binned(h))
                yield pa.record_batch(
                    {
                        "row": row + np.arange(batch.num_rows, dtype=np.int64),
                        "doc_id": batch.column("doc_id"),
                        "mark": batch.column("mark"),
                        "digest": pa.array(out["digest"], pa.string()),
                        "n": pa.array(out["n"], pa.int32()),
                        "sketch": pa.array(out["sketch"], pa.list_(pa.int64())),
                        "bins": pa.array(out["bins"], pa.binary()),
                    }
                )
                row += batch.num_rows

    return small_batches(texts).mapInArrow(compute, FEATURES)


def _lengths_fit(n: str, m: str):
    """Edit similarity can't reach the limit when the lengths differ too much."""
    n, m = F.col(n), F.col(m)
    return F.least(n, m) >= F.ceil(F.greatest(n, m) * F.lit(SIMILARITY) - F.lit(1e-9))


def _matrix(column: pa.Array) -> np.ndarray:
    return flat(column)[0].reshape(-1, BINS)


def near_by_bins(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs ``a, b``, written before, that word counts can't exclude. Only texts in pairs send theirs."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    side = reps.select("id", "n", "bins").join(ids, "id", "left_semi")
    both = pairs.join(side.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bins").alias("xa")), "a").join(
        side.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("xb")), "b"
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_matrix(batch.column(c)) for c in ("xa", "xb"))
                mask = apart(x, y) <= limits(batch.column("na").to_numpy(), batch.column("nb").to_numpy())
                yield pa.record_batch({c: batch.column(c) for c in ("a", "b")}).filter(pa.array(mask))

    return both.mapInArrow(keep, "a long, b long")


def mark_bits(wanted: DataFrame) -> np.ndarray:
    """A bit for each cell that the mark of a wanted text falls into: CELLS bits, however many there are.

    Only texts whose bit is set leave their partition; where most cells are taken, more do.
    """
    cell = F.pmod(F.xxhash64("mark"), F.lit(CELLS)) + 1  # the functions count from one
    numbered = wanted.select(cell.alias("c")).selectExpr("bitmap_bucket_number(c) as bucket", "bitmap_bit_position(c) as place")
    out = np.zeros(CELLS // 8, np.uint8)
    for r in numbered.groupBy("bucket").agg(F.expr("bitmap_construct_agg(place)").alias("bits")).collect():
        own = np.frombuffer(r["bits"], np.uint8)
        out[(r["bucket"] - 1) * len(own) : r["bucket"] * len(own)] = own
    return out


def _two_sided(pairs: DataFrame, side: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of both texts, named after the side."""
    for end in ("a", "b"):
        pairs = pairs.join(side.select(F.col("id").alias(end), *[F.col(c).alias(c + end) for c in columns]), end)
    return pairs


def near_by_grams(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that counts of two words in a row can't exclude."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ga, gb, na, nb = (batch.column(c) for c in ("gramsa", "gramsb", "na", "nb"))
            limit = limits(na.to_numpy(), nb.to_numpy()).tolist()
            mask = [
                grams_fit(np.frombuffer(ga[i].as_buffer(), np.uint8), np.frombuffer(gb[i].as_buffer(), np.uint8), limit[i])
                for i in range(batch.num_rows)
            ]
            yield pa.record_batch({c: batch.column(c) for c in ("a", "b")}).filter(pa.array(mask, pa.bool_()))

    return small_batches(_two_sided(pairs, side, "grams", "n")).mapInArrow(keep, "a long, b long")


def aligned(pairs: DataFrame, reps: DataFrame, docs: DataFrame, likely: bool = False) -> DataFrame:
    """Pairs ``a, b`` whose texts are similar. Texts are fetched for the ids in pairs only.

    Unless most are ``likely`` to be, pairs are thinned out by :func:`grams` before words travel.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = materialise(ids.join(reps.select("id", "doc_id", "mark"), "id"), "aligned-ids")
    bits = docs.sparkSession.sparkContext.broadcast(mark_bits(wanted))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"), F.md5(text.cast("binary")).alias("own_mark"))
    texts = texts.withColumn("cell", F.pmod(F.xxhash64("own_mark"), F.lit(CELLS)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = words(), bits.value
        for whole in batches:
            cell = whole.column("cell").to_numpy()
            hit = whole.filter(pa.array((held[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1))
            for batch in slices(hit, "text"):
                hashes = known.of(batch.column("text").to_pylist())
                columns = {c: batch.column(c) for c in ("doc", "own_mark")}
                columns["n"] = pa.array([len(h) for h in hashes], pa.int32())
                columns["grams"] = pa.array([b"" if likely else grams(h) for h in hashes], pa.binary())
                columns["words"] = pa.array([(h >> np.uint64(32)).astype("<u4").tobytes() for h in hashes], pa.binary())
                yield pa.record_batch(columns)

    split_texts = small_batches(texts).mapInArrow(split, "doc long, own_mark string, n int, grams binary, words binary")
    same = (split_texts["own_mark"] == wanted["mark"]) & F.col("doc").eqNullSafe(F.col("doc_id"))
    found = split_texts.join(wanted, same).groupBy("id").agg(F.first(F.struct("n", "grams", "words")).alias("r"))
    side = materialise(found.select("id", "r.*"), "aligned-words")
    near = pairs if likely else materialise(near_by_grams(pairs, side), "near")
    both = _two_sided(near, side, "words")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wa, wb = batch.column("wordsa"), batch.column("wordsb")
            mask = [
                similar(np.frombuffer(wa[i].as_buffer(), "<u4"), np.frombuffer(wb[i].as_buffer(), "<u4"))
                for i in range(batch.num_rows)
            ]
            yield pa.record_batch({c: batch.column(c) for c in ("a", "b")}).filter(pa.array(mask, pa.bool_()))

    return small_batches(both).mapInArrow(verify, "a long, b long")


def within_groups(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group, some at a time; ``ends`` is the end of each row's group."""
    rows = np.arange(len(ends))
    count = ends - rows - 1
    done = np.concatenate([[0], np.cumsum(count)])
    begin = 0
    while begin < len(rows):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + STEP, "right")) - 1)
        part = slice(begin, end)
        i = np.repeat(rows[part], count[part])
        yield i, np.arange(len(i)) - np.repeat(done[part] - done[begin], count[part]) + i + 1
        begin = end


def nearest(found: list[np.ndarray], most: int) -> np.ndarray:
    """Of columns ``a, b, one, two, apart`` the ``most`` nearest pairs of each class, named in ``one``."""
    all_ = np.concatenate(found, axis=1)
    all_ = np.concatenate([all_, all_[[0, 1, 3, 2, 4]]], axis=1)
    all_ = all_[:, np.lexsort((all_[1], all_[0], all_[4], all_[2]))]
    same = np.zeros(all_.shape[1], bool)  # as the pair before
    same[1:] = (all_[:3, 1:] == all_[:3, :-1]).all(axis=0)
    all_ = all_[:, ~same]
    at = np.arange(all_.shape[1])
    begins = np.ones(len(at), bool)
    begins[1:] = all_[2, 1:] != all_[2, :-1]
    return all_[:, at - np.maximum.accumulate(np.where(begins, at, 0)) < most]


def across_classes(members: DataFrame, most: int | None) -> DataFrame:
    """Pairs of unlike classes within a bucket that word counts can't exclude.

    ``members``: ``key, size`` of the bucket, ``id, n, bins, label, first`` of the member. A
    bucket of more than BLOCK members is dealt into blocks, and pairs of blocks are groups of
    their own. With ``most``, of each class only so many pairs with the smallest bounds are given
    (more, if other groups of its members hold nearer or farther ones), each under both classes,
    ``one`` and ``two``. A member's pair with its ``first`` has been tried before.
    """
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = dealt.withColumn("other", other).withColumns(
        {"low": F.least("own", "other"), "high": F.greatest("own", "other")}
    )
    names = ["a", "b", "one", "two", "apart"]

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {c: table.column(c).to_numpy() for c in ("key", "low", "high", "own", "id", "label", "n")}
        id_, label, n, own = (columns[c] for c in ("id", "label", "n", "own"))
        first = table.column("first").fill_null(-1).to_numpy()
        bins = _matrix(table.column("bins").combine_chunks())
        change = np.flatnonzero(np.any([np.diff(columns[c]) != 0 for c in ("key", "low", "high")], axis=0)) + 1
        cuts = np.concatenate([change, [len(id_)]])
        ends = cuts[np.searchsorted(cuts, np.arange(len(id_)), "right")]
        one_block = columns["low"] == columns["high"]
        found: list[np.ndarray] = []
        size = 0
        for i, j in within_groups(ends):
            good = (label[i] != label[j]) & (one_block[i] | (own[i] != own[j]))
            good &= (first[i] != id_[j]) & (first[j] != id_[i])
            good &= np.abs(n[i] - n[j]) <= limits(n[i], n[j])
            i, j = i[good], j[good]
            for at in range(0, len(i), 1 << 15):
                x, y = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
                far = apart(bins[x], bins[y])
                close = far <= limits(n[x], n[y])
                x, y, far = x[close], y[close], far[close]
                part = [f(v[x], v[y]) for v in (id_, label) for f in (np.minimum, np.maximum)]
                found.append(np.stack([*part, far]).astype(np.int64))
                size += len(x)
            if most and size > PAIRS:
                found = [nearest(found, most)]
                size = 0
            elif size > PAIRS:
                yield pa.record_batch(dict(zip(names, np.concatenate(found, axis=1))))
                found, size = [], 0
        if found:
            yield pa.record_batch(dict(zip(names, nearest(found, most) if most else np.concatenate(found, axis=1))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[pa.RecordBatch] = []  # groups may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
            begins = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
            cut = int(begins[-1]) + 1 if len(begins) else 0  # start of the last group
            if left and any(l.column(c)[-1] != batch.column(c)[0] for l in left[-1:] for c in ("key", "low", "high")):
                yield from compare(pa.Table.from_batches(left))
                left = []
            if cut:
                yield from compare(pa.Table.from_batches([*left, batch.slice(0, cut)]))
                left = []
            left.append(batch.slice(cut))
        if left:
            yield from compare(pa.Table.from_batches(left))

    group = ["key", "low", "high"]
    together = dealt.select(*group, "own", "id", "n", "bins", "label", "first").repartition(*group).sortWithinPartitions(*group)
    return together.mapInArrow(work, "a long, b long, one long, two long, apart long")


def closest_pairs(found: DataFrame, tried: DataFrame, most: int | None) -> DataFrame:
    """Of pairs by :func:`across_classes` those not tried before, ``most`` for each class."""
    new = found.join(tried, ["a", "b"], "left_anti").distinct()
    if most:
        order = Window.partitionBy("one").orderBy("apart", "a", "b")
        new = new.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return new.select("a", "b").distinct()


def _labelled(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members with the class they are in so far; at first each its own."""
    if found is None:
        return members.withColumn("label", F.col("id"))
    label = found.select("id", F.col("component").alias("label"))
    return members.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))


def bucket_members(keys: DataFrame) -> DataFrame:
    """Rows ``key, id, n`` of keys that several texts have, with the bucket's size and its first text."""
    bucket = Window.partitionBy("key")
    size, hub = F.count(F.lit(1)).over(bucket), F.min(F.struct("id", "n")).over(bucket)
    return keys.select("key", "id", "n", size.alias("size"), hub.alias("hub")).filter("size > 1")


def best_hubs(members: DataFrame) -> DataFrame:
    """Pairs ``a < b``: each member with the hub that most of its buckets have.

    A bucket's hub is its first text; near copies share most buckets, others one or two, so one
    pair for each member settles nearly all of a group, whatever its size.
    """
    met = members.filter("id <> hub.id").filter(_lengths_fit("n", "hub.n"))
    shared = met.groupBy("id", F.col("hub.id").alias("hub")).agg(F.count(F.lit(1)).alias("buckets"))
    best = shared.groupBy("id").agg(F.max(F.struct("buckets", (-F.col("hub")).alias("hub"))).alias("r"))
    pair = best.select("id", (-F.col("r.hub")).alias("hub"))
    return pair.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes after further links."""
    links = materialise(links, "more-links")
    if found is not None:
        if links.isEmpty():
            return found
        links = links.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return materialise(components(links), "labels")


def _classed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, mark, class`` of every row; a class is the number of one of its rows."""
    docs = docs.select("doc_id", "text")
    every = materialise(features(docs), "order-minhash")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "mark", "n", "sketch", "bins")
    first = every.groupBy("digest").agg(F.min(order).alias("r"))
    reps = materialise(first.select("digest", F.col("r.row").alias("id"), "r.*").drop("row", "unnamed"), "reps")
    keys = reps.select("id", "n", F.explode("sketch").alias("key"))
    members = materialise(bucket_members(keys), "members")
    hubs = materialise(best_hubs(members), "hubs")
    tried = materialise(near_by_bins(hubs, reps), "stars")
    found = _joined(None, aligned(tried, reps, docs, likely=True))
    # Buckets that still hold several classes: first the closest pairs of each class, which
    # joins what belongs together, then every pair across what is left.
    first = tried.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("first"))
    counts = reps.select("id", "bins").join(first, "id", "left")
    members = members.select("key", "id", "n")
    for most in [*NEAREST, None]:
        bucket = Window.partitionBy("key")
        size, lo, hi = F.count(F.lit(1)).over(bucket), F.min("label").over(bucket), F.max("label").over(bucket)
        rest = _labelled(members, found).withColumns({"size": size, "lo": lo, "hi": hi}).filter("lo <> hi")
        near = materialise(across_classes(rest.drop("lo", "hi").join(counts, "id"), most), "across")
        pairs = materialise(closest_pairs(near, tried, most), "pairs")
        if most:  # classes without a pair now never get one: joined classes only have fewer
            alive = near.select(F.col("one").alias("label")).distinct()
            alive = _labelled(reps.select("id"), found).join(alive, "label", "left_semi").select("id")
            members = materialise(members.join(materialise(alive, "alive"), "id", "left_semi"), "members")
        tried = tried.unionByName(pairs)
        found = _joined(found, aligned(pairs, reps, docs))
    named = reps.select("digest", "id").join(found, "id", "left")
    named = named.select("digest", F.coalesce("component", "id").alias("class"))
    return every.select("row", "doc_id", "mark", "digest").join(named, "digest").drop("digest")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` of every row; a class is its smallest id, null if no row has one."""
    found = materialise(_classed(docs).select("doc_id", "class"), "classed")
    names = found.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return found.join(names, "class").select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class: that of the smallest id, one of its copies if it comes repeatedly.

    Which row stays is told by its id and text; only rows equal in both are then counted.
    """
    found = _classed(docs)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "mark")
    best = found.groupBy("class").agg(F.min(order).alias("r")).select("r.doc_id", "r.mark")
    doc, mark = fresh(docs, "_doc"), fresh(docs, "_mark")
    best = best.select(F.col("doc_id").alias(doc), F.col("mark").alias(mark))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = (F.md5(text.cast("binary")) == F.col(mark)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc))
    kept = materialise(docs.join(best, same), "kept")
    if kept.count() > best_count(kept, doc, mark):
        kept = kept.dropDuplicates([doc, mark])
    return kept.drop(doc, mark)


def best_count(kept: DataFrame, doc: str, mark: str) -> int:
    return kept.select(doc, mark).distinct().count()

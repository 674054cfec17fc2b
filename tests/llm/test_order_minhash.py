"""Order MinHash, banded alignment, components, whole classes against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyhall.llm import order_minhash as omh
from tallyhall.llm.graph import components


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    draw = random.Random(3)
    for _ in range(3000):
        letters = draw.choice([2, 4, 8])
        a = [draw.randrange(letters) for _ in range(draw.randint(0, 14))]
        b = [draw.randrange(letters) for _ in range(draw.randint(0, 14))] if draw.random() < 0.4 else list(a)
        for _ in range(draw.randint(0, 4)):
            if b and draw.random() < 0.5:
                del b[draw.randrange(len(b))]
            else:
                b.insert(draw.randint(0, len(b)), draw.randrange(letters))
        limit = draw.randint(0, 16)
        assert omh.distance_within(a, b, limit) == min(edits(a, b), limit + 1)


def sketch(hashes):
    return omh.sketches(hashes, np.zeros(len(hashes), np.int64), 1)[0]


def keys_of(hashes):
    return omh.all_keys([hashes])[0]


def test_sketches_keep_order_and_occurrences():
    use = omh.Words()
    words = [f"w{i}" for i in range(40)]
    text = use.hashes(" ".join(words))
    assert (sketch(text) == sketch(text.copy())).all()
    turned = use.hashes(" ".join(words[20:] + words[:20]))  # nearly the same shingles, other order
    same = np.mean(sketch(text) == sketch(turned))
    assert same < 0.75
    repeats = use.hashes("a b c d e " * 4)
    shingles, _ = omh.labelled(repeats, np.zeros(len(repeats), np.int64), omh.SHINGLE)
    assert len(set(shingles.tolist())) == len(shingles)  # repeats are numbered
    counts = [len(keys_of(use.hashes(t))) for t in ("a b c", "a b c d", "a b c d e")]
    assert counts[0] == 0 < counts[1] < omh.SKETCHES + omh.LOOSE < counts[2]


def test_keys_do_not_depend_on_the_batch():
    draw, use = random.Random(2), omh.Words()
    texts = [" ".join(f"w{draw.randrange(9 if i % 3 else 999)}" for _ in range(draw.choice([0, 3, 4, 5, 6, 30, 200]))) for i in range(80)]
    together = omh.all_keys(use.of(texts))
    assert all((keys_of(use.hashes(t)) == keys).all() for t, keys in zip(texts, together))
    h = use.hashes(texts[2] + " a b c d e f g")
    base, _ = omh.labelled(h, np.zeros(len(h), np.int64), omh.SHINGLE)
    for i, (key, seed, factor) in enumerate(zip(sketch(h)[:5], *omh._SEEDS)):  # by definition
        drawn = [((int(x) >> 32 ^ int(seed) & 0xFFFFFFFF) * (int(factor) & 0xFFFFFFFF)) & 0xFFFFFFFF for x in base]
        want = np.array([(i + 1) * 0x9E3779B97F4A7C15 & omh.MASK], np.uint64)
        for p in sorted(sorted(range(len(base)), key=lambda p: (drawn[p], p))[: omh.PICKED]):
            want = omh.mixed(want * factor + base[p])
        assert key == want.view(np.int64)[0]


def plain_classes(rows):
    use = omh.Words()
    named = [(at, use.hashes(t or ""), t or "") for at, (_, t) in enumerate(rows)]
    label = {at: at for at, _, _ in named}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for (i, a, s), (j, b, t) in itertools.combinations(named, 2):
        same = s == t if not len(a) and not len(b) else len(a) == len(b) and (a == b).all()
        near = min(len(a), len(b)) > 0 and edits(a.tolist(), b.tolist()) <= omh.allowed(len(a), len(b))
        if same or near:
            x, y = sorted((find(i), find(j)))
            label[y] = x
    least = {}
    for at, (i, _) in enumerate(rows):
        least[find(at)] = min((x for x in (least.get(find(at)), i) if x is not None), default=None)
    return [(i, least[find(at)]) for at, (i, _) in enumerate(rows)], list(least.values())


def corpus():
    draw = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    rows = []

    def near(text, edits_):
        out = list(text)
        for _ in range(edits_):
            out[draw.randrange(len(out))] = draw.choice(words)
        return out

    passage = draw.choices(words, k=30)
    for _ in range(25):
        text = draw.choices(words, k=draw.randint(20, 60))
        rows += [text] + [near(text, draw.randint(0, 2)) for _ in range(draw.randint(0, 3))]
    hot = draw.choices(words, k=50)
    rows += [near(hot, draw.randint(0, 2)) for _ in range(60)]
    rows += [passage + draw.choices(words, k=30) for _ in range(30)]  # shared passage, else unlike
    rows += [["a", "b"], ["a", "b"], ["a", "c"], ["a", "b", "c", "d", "e"], [], []]
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    rows += [(2000, "one two three four"), (2001, "one two three four five"), (2002, "one two tree four five")]
    rows += [(2003, "p q r"), (2004, "p q s"), (2005, "i j k l"), (2006, "i j k m")]
    rows += [rows[5], rows[5], (None, rows[7][1]), (rows[9][0], rows[40][1]), (rows[9][0], "seven other words that no row has")]
    rows += [(None, "twice without an id, word for word")] * 2 + [(None, "twice without an id, word by word")]
    return [*rows, (1000, None), (1001, "!!"), (1002, "??"), (None, "no id at all"), (1003, rows[0][1].upper() + "!")]


@pytest.mark.parametrize("block", [8, 1024])
def test_classes(spark, monkeypatch, block):
    monkeypatch.setattr(omh, "BLOCK", block)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "key": F.lit(1)})
    got = omh.classes(docs).collect()
    assert len(got) == len(rows)
    want, groups = plain_classes(rows)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = omh.keep_one(docs)
    assert kept.columns == docs.columns
    stay = kept.collect()
    assert len(stay) == len(groups)
    assert sorted((r.doc_id for r in stay), key=str) == sorted(groups, key=str)


def test_bucket_without_its_hub(spark):
    """Two classes share buckets with a hub that is like neither: links across are still found."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    passage = draw.choices(words, k=45)
    one, two = passage + draw.choices(words, k=40), passage + draw.choices(words, k=40)
    rows = [(0, " ".join(passage + draw.choices(words, k=40)))]
    for i in range(1, 13):
        text = list(one if i % 2 else two)
        text[draw.randrange(85)] = "x"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.class_id for r in omh.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(plain_classes(rows)[0]) == {0: 0, **{i: 1 if i % 2 else 2 for i in range(1, 13)}}


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r) for r in omh.classes(docs).collect()) == [(1, 1), (1, 1), (2, 1)]
    assert omh.classes(docs.limit(0)).count() == 0
    assert omh.keep_one(docs.limit(0)).count() == 0
    assert [r.doc_id for r in omh.keep_one(docs).collect()] == [1]


def test_words_are_those_of_a_pattern():
    texts = ["Ein Wort, zwei_3 WÖRTER! ÉTÉ", "", "ΣΑΣ İstanbul ½ ٣ x\u0301y", "a\nb\tc--d", "漢字 仮名", "🙂x"]
    use, one, other = omh.Words(), [], []
    for text, hashes in zip(texts, use.of(texts)):
        found = re.findall(r"\w+", text.lower())
        assert len(found) == len(hashes)
        one += found
        other += hashes.tolist()
    assert len(set(one)) == len(set(other)) == len(set(zip(one, other)))


def test_components(spark):
    draw = random.Random(6)
    links = [(i, i + 1) for i in range(100, 160)] + [(draw.randrange(60), draw.randrange(60)) for _ in range(40)]
    links += [(200, i) for i in range(201, 260)] + [(5, 5), (None, 3), (7, None)]
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            label[y] = x
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in label}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(draw, text, count):
    out = list(text)
    for k in range(count):
        at, what = draw.randrange(len(out) + 1), draw.randrange(3)
        if what == 0:
            out.insert(at, f"new{draw.random()}")
        elif at < len(out):
            out[at : at + 1] = [] if what == 1 else [f"new{draw.random()}"]
    return out


def test_short_texts_always_meet():
    """Any two texts of at most SHORT words within the limit share a key."""
    use, draw, pairs = omh.Words(), random.Random(12), 0
    for _ in range(20000):
        a = [f"w{draw.randrange(60)}" for _ in range(draw.randint(4, omh.SHORT))]
        b = edited(draw, a, draw.randint(1, max(1, omh.allowed(len(a), len(a)))))
        x, y = use.hashes(" ".join(a).replace(".", "")), use.hashes(" ".join(b).replace(".", ""))
        if omh.LEAST <= len(y) <= omh.SHORT and edits(x.tolist(), y.tolist()) <= omh.allowed(len(x), len(y)):
            pairs += 1
            assert set(omh.short_keys(x)) & set(omh.short_keys(y)), (a, b)
    assert pairs > 10000


def test_spread_edits_meet():
    """Every fifth word changed leaves no five-word shingle, but nearly all such pairs are candidates."""
    use, draw, missed = omh.Words(), random.Random(13), 0
    for i in range(400):
        a = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([25, 30, 50, 100, 400]))]
        b = [f"x{i}" if k % 5 == 2 else w for k, w in enumerate(a)]
        x, y = use.hashes(" ".join(a)), use.hashes(" ".join(b))
        assert omh.similar(x, y)
        missed += not set(keys_of(x).tolist()) & set(keys_of(y).tolist())
    assert missed <= 4


def test_classes_of_short_and_spread_edits(spark):
    draw, rows = random.Random(14), []
    for n in (5, 6, 7, 8, 10, 11, 12, 13, 15, 18, 24, 40, 80):
        for kind in range(2):
            text = [f"n{n}k{kind}w{draw.randrange(900)}" for _ in range(n)]
            if kind:
                near = [f"y{n}" if k % 5 == 2 and k // 5 < n // 5 else w for k, w in enumerate(text)]
            else:
                near = [f"y{n}" if k == n // 2 else w for k, w in enumerate(text)]
            rows += [" ".join(text), " ".join(near)]
    rows = list(enumerate(rows))
    got = {r.doc_id: r.class_id for r in omh.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(plain_classes(rows)[0]) == {i: i - i % 2 for i, _ in rows}


def test_runs_of_two_words_bound_the_edits():
    """No pair within the limit is excluded, whatever its lengths; long texts of the same common words are."""
    draw, use = random.Random(15), omh.Words()
    as_array = lambda words: np.frombuffer(omh.grams(use.hashes(" ".join(words))), np.uint8)
    for n in (1, 2, 5, 63, 64, 65, 130, 260, 1030, 20000):
        for vocabulary in (2, 30, 5000):
            a = [f"w{draw.randrange(vocabulary)}" for _ in range(n)]
            limit = omh.allowed(n, n)
            b = edited(draw, a, limit)
            b = [w.replace(".", "") for w in b]
            assert omh.grams_fit(as_array(a), as_array(b), limit) and omh.grams_fit(as_array(b), as_array(a), limit)
    words = [f"w{i}" for i in range(300)]
    a, b = (draw.choices(words, weights=[1 / (i + 1) for i in range(300)], k=4000) for _ in range(2))
    x, y = use.hashes(" ".join(a)), use.hashes(" ".join(b))
    bins = [np.frombuffer(omh.binned(h), np.uint8)[None] for h in (x, y)]
    assert omh.apart(*bins)[0] <= omh.allowed(4000, 4000)  # counts of single words can't tell
    assert not omh.grams_fit(as_array(a), as_array(b), omh.allowed(4000, 4000))


def test_group_about_the_limit(spark, monkeypatch):
    """Copies of one text, about as far from one another as allowed: no all pairs of a group, nor of a pair of classes."""
    draw, tried = random.Random(16), []
    base = [f"w{draw.randrange(5000)}" for _ in range(100)]
    rows = []
    for i in range(300):
        text = list(base)
        for at in draw.sample(range(100), 11):
            text[at] = f"new{draw.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    plain = omh.aligned

    def counted(pairs, *args, **kwargs):
        tried.append(pairs.count())
        return plain(pairs, *args, **kwargs)

    monkeypatch.setattr(omh, "aligned", counted)
    got = {r.doc_id: r.class_id for r in omh.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0} and len(got) == 300
    assert sum(tried) < 10 * len(rows) and tried[-1] < len(rows)


def test_failed_nearest_pair_makes_way(spark):
    """A class whose nearest pair has been tried goes on with the next, not with none."""
    found = spark.createDataFrame([(1, 2, 1, 2, 5), (1, 3, 1, 3, 6), (1, 4, 1, 4, 7)], "a long, b long, one long, two long, apart long")
    tried = spark.createDataFrame([(1, 2)], "a long, b long")
    assert [tuple(r) for r in omh.closest_pairs(found, tried, 1).collect()] == [(1, 3)]
    assert sorted(map(tuple, omh.closest_pairs(found, tried, None).collect())) == [(1, 3), (1, 4)]
    pairs = [np.array([[1, 1, 1], [2, 3, 2], [1, 1, 1], [2, 3, 2], [5, 6, 5]])]
    assert omh.nearest(pairs, 1).T.tolist() == [[1, 2, 1, 2, 5], [1, 2, 2, 1, 5], [1, 3, 3, 1, 6]]
    assert omh.nearest(pairs, 2).shape[1] == 4

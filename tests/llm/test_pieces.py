"""SentencePiece coding against an exhaustive search and the library's own decoder."""

import math
import random
from array import array

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tallyhall.llm import pieces


@pytest.fixture(scope="module")
def coder():
    model = pieces.Model.read()
    return pieces.Coder(model, pieces.trie_of(model))


def test_trie_holds_exactly_its_keys(coder):
    keys = {b"a": 0, b"ab": 1, b"abc": 2, b"b\xff": 3, b"\x00": 4}
    trie = pieces.DoubleArray(keys)

    def find(key):
        node = 0
        for c in key:
            to = trie.base[node] + c + 1
            if to >= len(trie.check) or trie.check[to] != node:
                return -1
            node = to
        return trie.value[node]

    assert {k: find(k) for k in keys} == keys
    assert [find(k) for k in (b"", b"ac", b"b", b"\xff", b"abcd")] == [-1] * 5


def score_of(coder, text):
    """Best score over all segmentations, by plain recursion on characters."""
    model, known = coder.model, {}
    for i, (p, k) in enumerate(zip(model.pieces, model.kinds)):
        if k in (pieces.NORMAL, pieces.USER):
            known[p] = coder.scores[i]
    best = [0.0]
    for end in range(1, len(text) + 1):
        found = [best[s] + known[text[s:end]] for s in range(max(0, end - 48), end) if text[s:end] in known]
        if text[end - 1] not in known:
            found.append(best[end - 1] + coder.unknown_score)
        best.append(max(found))
    return best[-1]


def score(coder, text, ids):
    """Score of a segmentation, with unknown characters counted once each."""
    total, run = 0.0, b""
    for i in ids:
        if coder.model.kinds[i] == pieces.BYTE:
            run += coder.surface[i]
        else:
            total += coder.scores[i]
    return total + coder.unknown_score * len(run.decode("utf-8"))


def test_best_of_all_segmentations(coder):
    draw = random.Random(4)
    for _ in range(400):
        text = "".join(draw.choice([*"abcdeth ing.,0éß\n", "the", "中", "🙂"]) for _ in range(draw.randint(1, 14)))
        ids = list(array("I", coder.encode(text)))
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        assert score(coder, text, ids) == pytest.approx(score_of(coder, marked)), text
        assert list(array("I", b"".join([coder.encode(text)]))) == coder.best(marked) or score(
            coder, text, coder.best(marked)
        ) == pytest.approx(score(coder, text, ids))


def test_decoding(coder):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    for text in ["", " ", "a", " a  b ", "Zeile\nzwei\t🙂", "x" * 3000, "a▁b", "é ﬁ"]:
        ids = coder.encode(text)
        assert coder.decode(ids) == text.replace(pieces.MARK, " ")
        assert library.decode(list(array("I", ids))) == coder.decode(ids)
    broken = array("I", [coder.bytes[0xE4], coder.bytes[0x41]]).tobytes()
    assert coder.decode(broken) == "�A"


def test_rows(spark):
    rows = [(1, "one two"), (1, "one two"), (2, None), (None, "x"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(3))
    found = pieces.decode(pieces.encode(docs)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted((d or 0, t or "") for d, t in rows)
    assert pieces.digest(pieces.decode(pieces.encode(docs.limit(0)))).count() == 0
    assert pieces.digest(pieces.decode(pieces.encode(docs))).filter("doc_id = 3").first()["n_pieces"] == 0


def test_scores_of_merges_are_estimated(spark):
    """Ranks are no log scores: added up, they took common words apart."""
    text = "Hello, the government of the people said hello to the other governments"
    docs = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    found = pieces.encode(docs).collect()
    got = [library.id_to_piece(i) for i in array("I", found[0].ids)]
    assert {"▁Hello", "▁government", "▁people", "▁governments"} <= set(got)
    assert all(r.ids == found[0].ids for r in found)
    model = pieces.Model.read()
    trained = pieces.estimated(model, pieces.trie_of(model), docs)
    normal = [s for s, k in zip(trained.scores, trained.kinds) if k == pieces.NORMAL]
    assert sum(map(math.exp, normal)) == pytest.approx(1)
    assert max(normal) < 0 and trained.scores == pieces.estimated(model, pieces.trie_of(model), docs).scores


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two word{i} three") for i in range(300)], "doc_id long, text string").coalesce(1)
    model = pieces.Model.read()
    want = pieces.estimated(model, pieces.trie_of(model), docs).scores
    monkeypatch.setattr(pieces, "MAX_COUNTED_CHARS", 50)
    assert pieces.estimated(model, pieces.trie_of(model), docs).scores == want


def test_words_together_as_one_by_one(coder):
    """The same ids, ties and unknown characters included, for words of any length."""
    draw = random.Random(8)
    words = ["", "a", "é", "🙂", "x" * 64, "x" * 65, "中" * 30, "\n", pieces.MARK]
    words += ["".join(draw.choices([*"abcdeth ing.,0éß▁", "the", "中", "🙂", "\x00"], k=draw.randint(1, 30))) for _ in range(9000)]
    assert coder.best_of(words) == [coder.best(w) for w in words]
    assert coder.best_of([]) == []
    texts = ["", "the cat", "the " + "y" * 70 + " é🙂", "the cat"]
    assert coder.encode_all(texts) == [coder.encode(t) for t in texts]

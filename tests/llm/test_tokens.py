"""Word encoder, token files and packing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyhall.llm import packing, token_files
from tallyhall.llm.tokens import END, WordEncoder, tokenizer_json
from tallyhall.session import scratch_path

ROWS = [(5, "One two, three!"), (1, None), (3, ""), (3, "same id"), (None, "no id"), (9, "w " * 9000), (2, "Ünï\x1ccode ☃ <|endoftext|> 's")]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(tokenizer_json())


def whole(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [END]


def test_words_give_the_ids_of_the_text(encoder):
    draw = random.Random(5)
    signs = [*"abcXYZéÉßŒİΣς'’.,-_0٣², \n\t\r\x1c\x85\xa0 中☃", "'LL", "ing", "<|endoftext|>", "<|startoftext|>", "é"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    texts += ["x" * 500, "word" * 300 + " end"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() + [END] == whole(encoder, text), repr(text)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": F.lit("x"), "part": F.lit(1)})


def test_files_come_back_in_order(spark, encoder, monkeypatch):
    path = scratch_path(spark, "test-tokens")
    token_files.write(frame(spark, ROWS), path)
    rows = token_files.read(spark, path).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids)
        assert ids in [whole(encoder, t) for d, t in ROWS if d == r.doc_id]
        at += len(ids)
    some = token_files.read_documents(spark, path, [5, 3]).collect()
    assert sorted(r.doc_id for r in some) == [3, 3, 5]
    found = token_files.digest(token_files.read(spark, path)).filter("doc_id = 5").first()
    assert found["ids_crc32"] == zlib.crc32(np.array(whole(encoder, ROWS[0][1]), "<u4").tobytes())


def test_files_with_a_dictionary(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(draw.choices(words, k=60))) for i in range(1500)]
    path = scratch_path(spark, "test-tokens")
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path)
    assert len(spark.read.parquet(f"{path}/dictionary").first()["data"]) > 0
    ids = {r.doc_id: r.ids for r in token_files.read(spark, path).collect()}
    fresh = WordEncoder(tokenizer_json())
    assert all(np.frombuffer(ids[i], "<u4").tolist() == whole(fresh, t) for i, t in rows[::50])


def test_empty_tables(spark):
    none = frame(spark, ROWS).limit(0)
    path = scratch_path(spark, "test-tokens")
    token_files.write(none, path)
    assert token_files.read(spark, path).count() == 0
    assert packing.pack(none).count() == 0


def check_packing(rows, encoder, texts, capacity=4096):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = sorted(
        ((d is None, d or 0), p, s, len(ids[s : s + capacity]), zlib.crc32(np.array(ids[s : s + capacity], "<u4").tobytes()))
        for d, t in texts
        for ids in [whole(encoder, t)]
        for p, s in enumerate(range(0, len(ids), capacity))
    )
    assert want == sorted(((r.doc_id is None, r.doc_id or 0), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    return len(by_seq)


def test_packing_keeps_everything_once(spark, encoder):
    check_packing(packing.pack(frame(spark, ROWS)).collect(), encoder, ROWS)


def test_packing_is_tight_over_rounds(spark, encoder, monkeypatch):
    draw = random.Random(7)
    rows = [(i, "a " * draw.randint(0, 3000)) for i in range(600)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(12)).collect()
    used = check_packing(packed, encoder, rows)
    total = sum(r.length for r in packed)
    assert used <= 1.06 * total / 4096 + 1  # tasks of 50 pieces; larger ones come closer


def test_best_fit():
    draw = random.Random(3)
    for _ in range(200):
        sizes = np.array([draw.randint(1, 20) for _ in range(draw.randint(1, 25))])
        bins, places, fills = packing.best_fit(sizes, 20)
        rooms = []
        for size in sorted(sizes.tolist(), reverse=True):  # plain best fit, largest first
            fit = [i for i, room in enumerate(rooms) if room >= size]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= size
            else:
                rooms.append(20 - size)
        assert sorted(20 - r for r in rooms) == sorted(fills.tolist())
        for b in range(len(fills)):
            held = sorted((places[i], sizes[i]) for i in np.flatnonzero(bins == b))
            assert [p for p, _ in held] == np.cumsum([0] + [s for _, s in held])[:-1].tolist()


def test_over_half_full_bins_stay(spark, encoder):
    rows = [(i, "a " * 2500) for i in range(40)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).collect()
    assert check_packing(packed, encoder, rows) == 40


def test_rows_of_one_id_have_an_order(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_TOKENS", 40)
    monkeypatch.setattr(token_files, "SHARD_DOCS", 7)
    rows = [(i % 3 if i % 4 else None, f"text {i} " * (i % 9)) for i in range(200)]
    found = []
    for parts in (1, 7):
        path = scratch_path(spark, "test-tokens")
        token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), path)
        got = sorted(map(tuple, token_files.digest(token_files.read(spark, path)).collect()), key=lambda r: r[1])
        assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
        assert [r[0] is None for r in got] == sorted((r[0] is None for r in got), reverse=True)
        one = token_files.read_documents(spark, path, [2]).collect()
        assert sorted(r.start for r in one) == [r[1] for r in got if r[0] == 2]
        found.append(got)
    assert found[0] == found[1]


def test_few_leftovers_find_room_in_the_last_round(spark, encoder):
    """Ninety bins of which only three small ones fit anywhere: rounds go on until they have met."""
    rows = [(i, "a " * (1000 if i in (10, 45, 80) else 3000)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(90, "doc_id")
    assert check_packing(packing.pack(df).collect(), encoder, rows) == 87

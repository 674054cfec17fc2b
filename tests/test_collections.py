"""Feature collections in any layout, cut into splits of any size."""

import json
import random
import re

import pytest

from tallyhall.sources import collections, readers


def feature(i, **more):
    ring = [[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]
    tricky = ['}{"', "\\", '\\"}]', "é[{", "", '"features": [', "x" * 300]
    properties = {"n": i, "note": tricky[i % len(tricky)], "deep": {"a": [{"b": "}"}]}}
    return {"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [ring]}, **more}


def layouts(count):
    made = [feature(i, id=i) for i in range(count)]
    frame = {"type": "FeatureCollection", "name": 'a "features": [ b', "crs": {"links": [{"x": 1}]}}
    late = {"features": made, "type": "FeatureCollection", "links": [{"rel": "x"}]}
    lines = ",\n".join(json.dumps(f) for f in made)
    return {
        "one line": json.dumps({**frame, "features": made}),
        "pretty": json.dumps({**frame, "features": made}, indent=2),
        "by line": json.dumps(frame)[:-1] + ', "features": [\n' + lines + "\n]\n}\n",
        "two on a line": '{"features" : [' + lines.replace("},\n", "},", 1) + "]}",
        "last first": json.dumps(late),
        "several": "\n".join(json.dumps({"features": made[i::3]}) for i in range(3)),
        "no frame": "\n".join(json.dumps(f) for f in made),
        "raw letters": json.dumps({**frame, "features": made}, ensure_ascii=False, indent=1),
        "empty": json.dumps({**frame, "features": []}),
    }


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def numbers(spark, path, **options):
    return sorted(r.n if r.n is not None else -1 for r in readers.geojson_collection(spark, path, "n int, note string", **options).collect())


@pytest.mark.parametrize("name", list(layouts(0)))
def test_every_feature_of_every_layout(spark, tmp_path, tiny_splits, name):
    (tmp_path / "f").write_text(layouts(30)[name], encoding="utf-8")
    got = readers.geojson_collection(spark, str(tmp_path / "f"), "n int, note string").collect()
    want = [] if name == "empty" else [feature(i)["properties"] for i in range(30)]
    assert sorted((r.n, r.note) for r in got) == sorted((w["n"], w["note"]) for w in want)
    assert all(r.geometry is not None for r in got)
    if name != "empty":
        assert spark.read.text(str(tmp_path / "f")).rdd.getNumPartitions() > 5
    assert numbers(spark, str(tmp_path / "f"), strict=False, by_line=False) == [w["n"] for w in want]


def test_many_files_in_a_task(spark, tmp_path):
    for k, text in enumerate(layouts(4).values()):
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
    assert numbers(spark, str(tmp_path)) == sorted([*range(4)] * 8)


@pytest.mark.parametrize(
    "bad",
    [
        lambda t: t[: len(t) // 2],  # ends too early
        lambda t: t.replace('"type": "Feature", ', "", 1),  # an item that is no feature
        lambda t: re.sub(r"\}\}, \{", '}}, 7, {', t, count=1),  # something between features
        lambda t: t + "]",
        lambda t: t.replace('"n": 3', '"n": 3x', 1),
        lambda t: t.replace('"properties": {"n": 2', '"properties": "n": 2', 1),  # a brace is missing
    ],
)
def test_every_feature_or_an_error(spark, tmp_path, tiny_splits, bad):
    made = [{"type": "Feature", "properties": {"n": i}, "geometry": {"type": "Polygon", "coordinates": feature(i)["geometry"]["coordinates"]}} for i in range(20)]
    (tmp_path / "f").write_text(bad(json.dumps({"type": "FeatureCollection", "features": made})))
    with pytest.raises(Exception, match="no feature"):
        numbers(spark, str(tmp_path / "f"))


def test_a_line_cut_short(spark, tmp_path):
    lines = [json.dumps({"properties": {"n": i}, "geometry": None, "type": "Feature"}) for i in range(3)]
    text = '{"features":[\n' + lines[0] + ",\n" + lines[1][:25] + ",\n" + lines[2] + "\n]}"
    (tmp_path / "f").write_text(text)
    with pytest.raises(Exception, match="no feature"):
        numbers(spark, str(tmp_path / "f"))


def test_moves_add_up_as_the_whole_text():
    draw = random.Random(5)
    for name, text in layouts(6).items():
        parts, stack, inside = re.split(r"(?<=\})", text), "", False
        while parts:
            n = draw.randint(1, 6)
            both = [collections.Move(False), collections.Move(True)]
            for part in parts[:n]:
                for move in both:
                    move.add(part.encode())
            move = vars(both[int(inside)])
            stack, _ = collections.after(stack, move)
            inside, parts = move["inside"], parts[n:]
        assert (stack, inside) == ("", False), name

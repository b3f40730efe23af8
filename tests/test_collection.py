"""FeatureCollections cut over tasks: strings with brackets, escapes, nested members, any split."""

import json
import random

import pytest

from terrane.sources import collection
from terrane.sources import vector as src


def document(n, seed, indent=None, crs=True):
    rng, features = random.Random(seed), []
    odd = ['}', '{"a": [', '\\', 'back\\"slash', '"', 'Feature', '{"type": "Feature"}', "", "é😀", "line\nbreak", "x" * 300]
    for i in range(n):
        x, y = rng.randint(0, 99), rng.randint(0, 99)
        f = {"type": "Feature", "properties": {"id": i, "note": rng.choice(odd) + rng.choice(odd), "more": {"deep": [{"a": {"b": []}}]}},
             "geometry": {"type": "Polygon", "coordinates": [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y]]]}}
        if i % 3 == 0:
            f = {"id": i, **{k: f[k] for k in reversed(f)}}
        features.append(f)
    doc = {"type": "FeatureCollection", "name": "layer 77"} | ({"crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32613"}}} if crs else {})
    return doc | {"features": features, "bbox": [0, 0, 100, 100]}, json.dumps(doc | {"features": features}, indent=indent, ensure_ascii=seed % 2 == 0)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_every_way_of_splitting_gives_the_features(size):
    doc, text = document(40, size)
    pieces = text.split("}")
    pieces = pieces[:-1] if not pieces[-1] else pieces
    rng = random.Random(size)
    for parts in (1, 2, 5, 30, len(pieces)):
        ends = sorted(rng.sample(range(1, len(pieces)), parts - 1))
        splits = [pieces[a:b] for a, b in zip([0, *ends], [*ends, len(pieces)])]

        class Row:
            def __init__(self, start, a, b):
                self.file, self.start, (self.d0, self.l0, self.s0), (self.d1, self.l1, self.s1) = "f", start, a, b
        rows = [Row(i, collection.measure(s, False), collection.measure(s, True)) for i, s in enumerate(splits)]
        state, whole, open_ = collection.states(rows), [], {}
        for i, s in enumerate(splits):
            depth, inside, begun = state["f", i]
            for kind, t in collection.cut(s, depth, inside):
                if kind == "feature":
                    whole.append(t)
                elif kind != "outside":
                    open_.setdefault(begun if kind in ("tail", "middle") else i, []).append(t)
        got = [json.loads(t) for t in [*whole, *("".join(v) for v in open_.values())]]
        features = [f for f in got if f.get("type") == "Feature"]
        assert sorted((f["properties"]["id"] for f in features)) == list(range(40))
        assert all(f == doc["features"][f["properties"]["id"]] for f in features)


def test_portions_of_a_very_long_string(monkeypatch):
    text = '{"a": "' + 'b\\"}' * 5000 + '", "c": [1, {"d": "}"}]}'
    pieces = text.split("}")[:-1]
    for size in (1, 10, 1000):
        seen = list(collection.brackets(pieces, False, size))
        assert "".join(t for t, _, _ in seen) == text and sum(s for _, s, _ in seen) == 0 and max(len(t) for t, _, _ in seen) <= 30_000


@pytest.mark.parametrize("indent", [None, 1])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, indent):
    doc, text = document(3000, 3, indent)
    (tmp_path / "a.geojson").write_text(text + "\n", encoding="utf-8")
    (tmp_path / "b.geojson").write_text(document(5, 4, crs=False)[1], encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = src.read_features(spark, str(tmp_path), "id long, note string", "collection").collect()
        splits = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert splits > 5 and len(rows) == 3005
    assert sorted(r.geom.srid for r in rows) == [4326] * 5 + [32613] * 3000
    assert sorted((r.id, r.note) for r in rows if r.geom.srid == 32613) == [(f["properties"]["id"], f["properties"]["note"]) for f in doc["features"]]
    assert all(len(r.geom.parts[0][0]) == 4 for r in rows)


def test_a_portion_is_scanned_as_a_whole():
    """Brackets out of strings as by a walk over the characters, however many there are in a portion."""
    rng = random.Random(5)
    for size in (1, 50, 1 << 20):
        text = json.dumps([{"a": ["".join(rng.choices('é😀\\"{}[]x', k=rng.randint(0, 9))), {"b": [[1, 2], [3]]}]} for _ in range(200)], ensure_ascii=False) + "}"
        want, open_, escaped = [], False, False
        for i, ch in enumerate(text):
            if escaped:
                escaped = False
            elif open_ and ch == "\\":
                escaped = True
            elif ch == '"':
                open_ = not open_
            elif not open_ and ch in "{}[]":
                want.append((i, 1 if ch in "{[" else -1))
        seen, at, portions = [], 0, 0
        for part, change, (places, steps, _) in collection.brackets(text.split("}")[:-1], False, size):
            assert change == steps.sum()
            seen += zip((places + at).tolist(), steps.tolist())
            at, portions = at + len(part), portions + 1
        assert seen == want and at == len(text) and (size < 1 << 20 or portions == 1)


def test_features_are_cut_once(spark, tmp_path):
    """Neither the CRS nor the features that lie across splits have the text scanned again, and coordinates are parsed once."""
    (tmp_path / "a.geojson").write_text(document(30, 6)[1], encoding="utf-8")
    plan = src.read_features(spark, str(tmp_path), "id long, note string", "collection")._jdf.queryExecution().optimizedPlan().toString()
    assert "mapInArrow" not in plan and "MapInArrow" not in plan and plan.count("from_json") <= 12

"""The codec of feeds by columns against the one message at a time."""

from __future__ import annotations

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from tramline.sources import gtfsrt
from tramline.sources import gtfsrt_columns as columns

PLAIN = {"s": ["", "a", 'say "x"\\\n\x01\x7f', "città 😀", "x" * 200], "u": [0, 1, 127, 128, 1 << 40, -1], "i": [0, -1, 5, 1 << 33, -(1 << 62)], "b": [True, False], "f": [0.0, 1.5, -11.3, 1e30], "d": [0.0, 0.1, -1e300]}


def message(r: random.Random, kind: str, whole: bool = False) -> dict:
    def value(field: str):
        if field.endswith("+"):
            return [x for x in (value(field[:-1]) for _ in range(r.randint(0, 3))) if x is not None or r.random() < 0.5]
        if r.random() < 0.3:
            return None
        if field in gtfsrt.MESSAGES:
            return message(r, field)
        return r.choice([*gtfsrt.ENUMS[field][0].values(), "ODD", ""] if field in gtfsrt.ENUMS else PLAIN[field])

    return {name: value(field) for name, field in gtfsrt.MESSAGES[kind].values()}


def test_columns_are_written_as_messages_are():
    r = random.Random(5)
    rows = [None if k % 50 == 7 else message(r, "FeedEntity") for k in range(2_000)]
    given = pa.array(rows, gtfsrt.arrow_type("FeedEntity"))
    held = given.to_pylist()  # floats as the column has them
    for part, want in ((given, held), (given[3:77], held[3:77]), (given[:0], [])):
        data, text = columns.encode(part).to_pylist(), columns.to_json(part).to_pylist()
        assert data == [b"" if m is None else gtfsrt.encode(m, "FeedEntity") for m in want]
        assert text == [json.dumps(gtfsrt.trimmed(gtfsrt.decode(d, "FeedEntity")), indent=2, ensure_ascii=False) for d in data]


def test_messages_are_read_by_columns():
    r = random.Random(6)
    PLAIN["u"].remove(-1)  # no long
    data = [gtfsrt.encode(message(r, "FeedEntity"), "FeedEntity") + (b"\x78\x05\x7d\x01\x02\x03\x04" if k % 3 else b"") + (gtfsrt.encode({"id": "again"}, "FeedEntity") if k % 5 == 0 else b"") for k in range(2_000)]
    kind = gtfsrt.arrow_type("FeedEntity")
    want = pa.array([gtfsrt.decode(d, "FeedEntity") for d in data], kind)
    offsets = columns.offsets_of(np.array([len(d) for d in data]))
    whole = np.frombuffer(b"".join(data), np.uint8)
    found = columns.decode(whole, offsets[:-1], offsets[1:])
    assert found.type == kind and found.equals(want)
    for bad in (b"\x0a\x05ab", b"\x08\x01", b"\x0b", b"\x0a\x01\xff"):
        with pytest.raises((ValueError, IndexError)):
            columns.decode(np.frombuffer(bad, np.uint8), np.array([0]), np.array([len(bad)]))


def test_only_the_forms_asked_for_are_made(spark):
    rows = spark.sql("select 'a' id, named_struct('timestamp', 5L) vehicle union all select 'b', null")
    assert gtfsrt.written(rows, "protobuf").columns == ["id", "protobuf"]
    by = {x["id"]: x for x in gtfsrt.encoded(rows).collect()}
    assert bytes(by["a"]["protobuf"]) == gtfsrt.encode({"id": "a", "vehicle": {"timestamp": 5}}, "FeedEntity") and by["b"]["json"] == '{\n  "id": "b"\n}'


def test_json_is_read_by_columns():
    r = random.Random(7)
    rows = [message(r, "FeedEntity") for _ in range(1_000)]
    texts = [json.dumps(gtfsrt.trimmed(gtfsrt.decode(gtfsrt.encode(m, "FeedEntity"), "FeedEntity")) | {"more": [1, {"x": None}]}, indent=k % 3 or None, ensure_ascii=k % 2 == 0).encode() for k, m in enumerate(rows)]
    want = pa.array([gtfsrt.shaped(json.loads(t), "FeedEntity") for t in texts], gtfsrt.arrow_type("FeedEntity"))
    assert columns.from_json(texts).equals(want)
    odd = b'{"id": 5, "id": "6", "vehicle": {"timestamp": "7", "current_status": 1, "position": {"latitude": "1.5"}}}'
    for given in ([odd], [b'{"id": "a"}', b'{"id": 5, "alert": null}'], [b'{"id": "1", "id": "2"}']):
        assert gtfsrt.decoded(given, False).to_pylist() == pa.array([gtfsrt.shaped(json.loads(t), "FeedEntity") for t in given], gtfsrt.arrow_type("FeedEntity")).to_pylist()
    for bad in (b"5", b"null", b'{"id": "a"} {"id": "b"}', b'{"vehicle": {"timestamp": "x"}}', b'{"id": "\xff"}'):
        with pytest.raises((ValueError, AttributeError)):
            gtfsrt.decoded([bad], False)


def feed_of(tricks: list[str]) -> dict:
    r = random.Random(8)
    entity = lambda k: {"id": f"e{k}", "alert": {"cause": "STRIKE", "header_text": {"translation": [{"text": r.choice(tricks), "language": str(n)} for n in range(r.randint(1, 4))]}}}
    feed = {"header": gtfsrt.header(5), "entity": [entity(k) for k in range(800)]}
    feed["entity"][400]["alert"]["header_text"]["translation"] = [{"text": "long" * 5_000, "language": "x"}]  # over several ranges
    return feed


def test_large_feeds_are_cut_by_many_tasks(spark, tmp_path):
    plain, odd = feed_of(["città", '},{"id": "no", "alert": {}},']), feed_of(["\x12\x05\n\x03abc" * 9])
    (tmp_path / "a.pb").write_bytes(gtfsrt.encode(plain))
    (tmp_path / "o.pb").write_bytes(gtfsrt.encode(odd))
    texts = {"a": json.dumps(plain, indent=2, ensure_ascii=False), "b": json.dumps({"x": [{"id": "y", "alert": {}}] * 300} | plain | {"z": [{"id": "y", "alert": {}}] * 300}), "c": "\ufeff" + json.dumps(plain), "o": json.dumps(odd)}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    whole, cut = ({}, {})
    for rows, size in ((whole, 1 << 30), (cut, 5_000)):
        for x in gtfsrt.read(spark, str(tmp_path), size).orderBy("file", "place").collect():
            own = rows.setdefault(x["file"].rpartition("/")[2], [])
            assert x["place"] == len(own)
            own.append(x["entity"].asDict(True))
    assert whole == cut and len(cut) == 6 and cut["a.pb"] == cut["a.json"] == cut["b.json"] == cut["c.json"] and cut["o.pb"] == cut["o.json"]
    listing = gtfsrt.files.listed(spark, f"{tmp_path}/a.*")
    seen = gtfsrt.split_feeds.ranges(listing, "path like '%pb'", 5_000).mapInArrow(gtfsrt.split_feeds.scanned, "path string, length long, protobuf boolean, start long, end long, begin long, behind long, count long")
    found = seen.groupBy("path").applyInArrow(gtfsrt.split_feeds.chained, "path string, protobuf boolean, begin long, length long, count long, place long").collect()
    assert len(found) > 20 and all(x["count"] >= 0 for x in found)  # neither feed is left to one task
    (tmp_path / "d.json").write_text(texts["a"][:-20])
    with pytest.raises(Exception, match="ends early|Expecting"):
        gtfsrt.read(spark, f"{tmp_path}/d.json", 5_000).collect()

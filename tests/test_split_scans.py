"""Scans that many tasks share, against the same files read in one piece."""

from __future__ import annotations

import json
import random
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import pyarrow as pa
import pytest

from tramline import sinks
from tramline.sinks import committed
from tramline.sources import files, gtfs, gtfsrt, netex, split_feeds, split_xml


def document(n: int, seed: int = 0, encoding: str = "utf-8", doctype: str = "") -> bytes:
    """A timetable with what may mislead a cut: comments, CDATA, instructions and
    attributes that look like tags, unknown frames, a second CompositeFrame."""
    r = random.Random(seed)
    odd = lambda: r.choice(("", "", "", "<!-- </lines><Line id='no'> > -->", "<![CDATA[</frames><!-- ]]>", "<?x </Line> ?>", "<!--" + "y" * r.randint(0, 90) + "-->", "\n \t"))
    line = lambda k: f"<Line id='L:{k}' note='a > b'>{odd()}<Name lang=\"de\">Linie {k} é</Name>{odd()}<PublicCode>{k}</PublicCode></Line>{odd()}"
    journey = lambda k: f"<ServiceJourney id='J:{k}'>{odd()}<passingTimes>" + "".join(f"<TimetabledPassingTime id='T:{k}:{i}'><StopPointInJourneyPatternRef ref='S:{i}' order='{i}'/>{odd()}<ArrivalTime>08:0{i}</ArrivalTime></TimetabledPassingTime>" for i in range(k % 4)) + f"</passingTimes></ServiceJourney>{odd()}"
    days = "".join(f"<DayType id='D:{k}'>{odd()}</DayType>" for k in range(n))
    frames = (
        f"<ServiceFrame><lines>{''.join(map(line, range(n)))}</lines>{odd()}<things><Line id='no'/></things></ServiceFrame><OddFrame><lines><Line id='no'/></lines></OddFrame>{odd()}"
        f"<ServiceCalendarFrame><ServiceCalendar><dayTypes>{days}</dayTypes></ServiceCalendar></ServiceCalendarFrame><TimetableFrame><vehicleJourneys>{''.join(map(journey, range(n)))}</vehicleJourneys></TimetableFrame>"
    )
    again = "".join(f"<Line id='no:{k}'/>" for k in range(n))
    text = (
        f"<?xml version='1.0' encoding='{encoding}'?>{doctype}\n<n:PublicationDelivery xmlns:n='urn:n' xmlns='urn:n' xmlns:g='urn:g'><n:dataObjects>{odd()}<CompositeFrame id='c'><frames>{frames}</frames></CompositeFrame>"
        f"<CompositeFrame><frames><ServiceFrame><lines>{again}</lines></ServiceFrame></frames></CompositeFrame></n:dataObjects></n:PublicationDelivery>"
    )
    return text.encode(encoding)


def entity_rows(df):
    return sorted((r["file"].rpartition("/")[2], r["seq"], r["type"], tuple(sorted(r["fields"].items()))) for r in df.collect())


@pytest.mark.parametrize(("encoding", "doctype"), [("utf-8", ""), ("iso-8859-1", ""), ("utf-16", ""), ("utf-8", "<!DOCTYPE x [<!ENTITY e 'v'>]>")])
def test_xml_pieces_give_what_the_whole_gives(spark, tmp_path, encoding, doctype):
    for k, n in enumerate((60, 25, 1)):
        (tmp_path / f"{k}.xml").write_bytes(document(n, k, encoding, doctype))
    whole = entity_rows(netex.read_xml(spark, str(tmp_path)))
    assert len(whole) == sum(n + n + n + sum(k % 4 for k in range(n)) for n in (60, 25, 1)) and not any("no" in str(r) for r in whole)
    for piece in (300, 5_000):
        assert entity_rows(netex.read_xml(spark, str(tmp_path), piece=piece)) == whole
    only = [r for r in whole if r[2] == "TimetabledPassingTime"]
    assert [r[3] for r in entity_rows(netex.read_xml(spark, str(tmp_path), types=["TimetabledPassingTime"], piece=900))] == [r[3] for r in only]


def test_xml_is_cut_into_many_pieces(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(document(400))
    size = (tmp_path / "a.xml").stat().st_size
    cuts = split_xml.pieces(files.listed(spark, str(tmp_path)), netex.between, ("PublicationDelivery", "dataObjects", "CompositeFrame", "frames"), size // 20).collect()
    assert len(cuts) >= 16 and max(c["end"] - c["start"] for c in cuts) < size // 10
    assert all(c["prefix"].startswith(b"<?xml") for c in cuts if c["start"])
    (tmp_path / "bad.xml").write_bytes(document(50)[:-200] + b"</oops>")
    with pytest.raises(Exception, match="(?i)mismatched|syntax|element|XML|tag"):
        netex.read_xml(spark, str(tmp_path / "bad.xml"), piece=10**9).count()


def test_xml_in_an_archive_larger_than_a_piece(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "n.zip", "w") as z:  # stored, so larger than the piece
        z.writestr("readme.txt", "-")
        z.writestr("n.xml", document(30))
        z.writestr("z.xml", "<no/>")
    (tmp_path / "n.xml").write_bytes(document(30))
    both = [[r[1:] for r in entity_rows(netex.read_xml(spark, str(tmp_path / f), piece=p))] for f in ("n.zip", "n.xml") for p in (1_000, 10**9)]
    assert both[0] == both[1] == both[2] == both[3] != []


def test_archives_are_read_by_member(spark, tmp_path):
    for k in range(3):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("inner/trips.txt", "trip_id\nno\n")
            z.writestr("trips.txt", "trip_id,route_id\n" + "".join(f"T{k}:{i},R\n" for i in range(25_000 if k else 0)))
            z.writestr("agency.txt", "agency_id\nA\n")
    feed = gtfs.read_zip(spark, str(tmp_path), exclude=["agency"])
    assert set(feed.tables) == {"trips"} and feed.trips.count() == 50_000
    assert [r["trip_id"] for r in feed.trips.where("_ord.file like '%2.zip'").orderBy("_ord").limit(3).collect()] == ["T2:0", "T2:1", "T2:2"]
    found = files.members(files.listed(spark, str(tmp_path)))
    assert found.count() == 9 and not any("content" in c for c in found.columns)
    assert "content" not in feed.trips._jdf.queryExecution().executedPlan().toString()


# --- feeds ------------------------------------------------------------------------


def feed_of(n: int) -> dict:
    r = random.Random(n)
    entity = lambda k: {"id": f"e{k}é\"\\", "alert": {"header_text": {"translation": [{"text": "x" * r.randint(0, 300) + "]},{", "language": "de"}]}, "cause": "STRIKE"}} if k % 3 else {"id": str(k), "vehicle": {"position": {"latitude": 1.5, "longitude": -k / 4}, "timestamp": k + 1}}
    return {"header": gtfsrt.header(5), "entity": [entity(k) for k in range(n)]}


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_feeds_are_cut_as_they_are_read(size):
    parts = lambda data: (data[k : k + size] for k in range(0, len(data), size))
    for n in (0, 1, 9):
        feed = feed_of(n)
        data = gtfsrt.encode(feed) + b"\x78\x05\x7d\x01\x02\x03\x04\x79\x01\x02\x03\x04\x05\x06\x07\x08"  # fields that nobody knows
        assert [gtfsrt.decode(e, "FeedEntity") for e in gtfsrt.cut_protobuf(parts(data))] == feed["entity"]
        for text in (json.dumps(feed), json.dumps({"entity": feed["entity"], "x": [1, {"entity": [2]}], "n": 12, "header": None}, indent=1, ensure_ascii=False), "﻿" + json.dumps(feed)):
            assert [json.loads(e) for e in gtfsrt.cut_json(parts(text.encode()))] == feed["entity"]
    for bad in (data[:-3], gtfsrt.encode(feed)[:-1]):
        with pytest.raises(ValueError, match="ends in"):
            list(gtfsrt.cut_protobuf(parts(bad)))
    for bad in ("[]", '{"entity": [{}', '{"entity": [{"a": }]}'):
        with pytest.raises(ValueError):  # noqa: PT011
            list(gtfsrt.cut_json(parts(bad.encode())))


def test_feeds_are_read_as_columns(spark, tmp_path):
    feed = feed_of(30)
    (tmp_path / "a.pb").write_bytes(gtfsrt.encode(feed))
    feed["entity"][0]["vehicle"] |= {"timestamp": "1", "unknown": {"x": 1}, "current_status": 1}
    (tmp_path / "a.json").write_text(json.dumps(feed))
    rows = gtfsrt.read(spark, str(tmp_path))
    assert rows.schema["entity"].dataType["alert"].dataType["cause"].dataType.simpleString() == "string"
    by = {f: [r["entity"].asDict(True) for r in rows.where(f"file like '%{f}'").orderBy("place").collect()] for f in ("pb", "json")}
    assert len(by["pb"]) == 30 and by["json"][0]["vehicle"]["current_status"] == "STOPPED_AT"
    by["json"][0]["vehicle"]["current_status"] = None
    assert by["pb"] == by["json"]
    assert rows.where("entity.alert.header_text.translation[0].language = 'de'").count() == 40


class Server(BaseHTTPRequestHandler):
    stored: list = []

    def do_PUT(self):
        body = self.rfile.read(int(self.headers["Content-Length"]))
        self.stored.append((self.path, body))
        self.send_response(500 if "bad" in self.path else 200)
        self.end_headers()

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = HTTPServer(("127.0.0.1", 0), Server)
    Server.stored.clear()
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def vehicles(spark, n, partitions=5):
    return spark.range(n).repartitionByRange(partitions, "id").selectExpr("cast(id as string) id", "named_struct('timestamp', id, 'position', named_struct('latitude', float(1.5))) vehicle")


def test_a_batch_goes_out_once(spark, tmp_path, server):
    for _ in range(2):  # the same batch, run again
        sinks.put_feed(vehicles(spark, 40), 7, f"{server}/vm", staging=f"{tmp_path}/stage", batch="3")
    assert [p for p, _ in Server.stored] == ["/vm.pb", "/vm.json"]
    sinks.put_feed(vehicles(spark, 40), 7, f"{server}/vm", staging=f"{tmp_path}/stage", batch="4")
    assert len(Server.stored) == 4
    feed = gtfsrt.decode(Server.stored[0][1])
    assert feed["header"]["timestamp"] == 7 and sorted(int(e["id"]) for e in feed["entity"]) == list(range(40))
    assert [e["id"] for e in json.loads(Server.stored[1][1])["entity"]] == [e["id"] for e in feed["entity"]]
    with pytest.raises(Exception, match="500|Internal"):
        sinks.write_feed(vehicles(spark, 4), 7, {"pb": f"{server}/bad.pb"})
    sinks.write_feed(vehicles(spark, 4), 7, {"pb": f"{server}/good.pb", "json": f"{server}/bad.json"}, optional=["json"])


def test_feeds_of_any_size_as_files(spark, tmp_path):
    for n in (0, 1, 300):
        sinks.write_feed(vehicles(spark, n), 7, {f: f"{tmp_path}/{n}.{f}" for f in ("pb", "json")})
        protobuf, text = gtfsrt.feed_bytes(vehicles(spark, n), 7)
        assert (tmp_path / f"{n}.pb").read_bytes() == protobuf and (tmp_path / f"{n}.json").read_text() == text
    failing = vehicles(spark, 300).selectExpr("id", "if(id = '299', raise_error('lost'), vehicle) vehicle")
    with pytest.raises(Exception, match="lost"):
        sinks.write_feed(failing, 7, {"pb": f"{tmp_path}/failed.pb"})
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(f"{n}.{f}" for n in (0, 1, 300) for f in ("pb", "json"))


def test_payloads_of_a_stream_go_out_once(spark, tmp_path, server):
    rows = [("a", "2026-01-02", "new"), ("a", "2026-01-01", "old"), ("b", "2026-01-01", None), ("c", "2026-01-01", "not wanted")]
    spark.createDataFrame(rows, "provider string, timestamp string, text string").write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema("provider string, timestamp string, text string").json(f"{tmp_path}/in")
    save = lambda batch, k: sinks.save_raw(batch, server, {"a": "x/a", "b": "/x/b"}, staging=f"{tmp_path}/stage", batch=str(k))
    for folder in ("one", "two"):  # a second query has the same batch numbers and staging
        stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{tmp_path}/{folder}").trigger(availableNow=True).start().awaitTermination()
    assert sorted(Server.stored) == [("/x/a", b"new"), ("/x/b", b"")]


def test_a_stream_of_parts(spark, tmp_path):
    spark.dataSource.register(committed.Assembled)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"target": "%s", "part": "YQ=="}\n' % f"{tmp_path}/out/t")
    stream = spark.readStream.schema("target string, part binary").json(f"{tmp_path}/in")
    options = {"staging": f"{tmp_path}/stage", "targets": json.dumps({f"{tmp_path}/out/t": committed.envelope(b"<", b",", b">")}), "checkpointLocation": f"{tmp_path}/check"}
    run = lambda: stream.writeStream.format("assembled").options(**options).trigger(availableNow=True).start().awaitTermination()
    run()
    assert (tmp_path / "out/t").read_bytes() == b"<a>"
    (tmp_path / "in/2.json").write_text('{"target": "%s", "part": "Yg=="}\n{"target": "other", "part": "Yg=="}\n' % f"{tmp_path}/out/t")
    run()
    assert (tmp_path / "out/t").read_bytes() == b"<b>"


def test_pieces_are_dealt_over_tasks(spark, tmp_path):
    """Ranges are small rows and much work: as many tasks as ranges, up to some for each core."""
    text = "<a>" + "<b/>" * 5_000 + "</a>"
    for k in range(4):
        (tmp_path / f"{k}.xml").write_text(text)
    every = files.listed(spark, str(tmp_path))
    plan = split_xml.dealt(split_xml.ranges(every, 2_000), 44)
    assert plan.rdd.getNumPartitions() == 44
    assert split_xml.dealt(every, 10**6).rdd.getNumPartitions() == split_xml.TASKS_A_CORE * spark.sparkContext.defaultParallelism


def test_a_range_that_begins_in_no_comment(tmp_path):
    """A comment that begins in the range says that its start lies in none."""
    text = b"<a><b/><!-- <b> --><b/><!-- x --></a>"
    (tmp_path / "a.xml").write_bytes(text)
    of = lambda start, inside: split_xml.effect(files.opened(str(tmp_path / "a.xml")), start, len(text), inside, b"")
    inner = text.index(b"<b> -->")
    assert of(3, b"-->") is None and of(3, b"").closed == 1
    for start in range(inner - 1, inner + 7):  # up to the end that stands across it
        assert of(start, b"-->").closed == 1, start


def test_a_short_last_chunk_of_a_piece_is_read():
    """What a parser put off as an unfinished tag ends in the last, shorter chunk."""
    prefix = b"<PublicationDelivery><dataObjects><CompositeFrame><frames><TimetableFrame><vehicleJourneys>"
    data = b"<ServiceJourney id='a'/><ServiceJourney id='" + b"b" * 5_000 + b"'/>"
    rows = list(netex.entities([data[:-10], data[-10:]], prefix=prefix, whole=False))
    assert [r[1]["id"][0] for r in rows] == ["a", "b"]


def test_tags_of_a_range_are_told_apart_at_once(tmp_path):
    """As one after the other, whatever the range begins in, and with a fraction of the steps."""
    text = b"".join([b"<a x='>'>", b"<ns:frames y=\"/\">", b"<!-- <b> > ]]> -->", b"<e/> > ", b"<![CDATA[ <c> --> ]]>", b"<?p <d> ?>", b"</ns:frames >", b"<frames>t</frames>", b"</a>"] * 3)
    (tmp_path / "a.xml").write_bytes(text)
    with files.opened(str(tmp_path / "a.xml")) as file:
        for start in range(3, len(text) - 1, 5):
            for end in range(start + 1, len(text) + 1, 37):
                got = split_xml.effects_of(file, start, end, len(text), b"frames")
                for inside in (b"", *split_xml.ENDS.values()):
                    one = split_xml.effect(file, start, end, inside, b"frames")
                    assert one is None or got[inside.decode()] == one
    big = b"<a>" + b"<b c='1'><d>x</d></b>" * 50_000
    assert split_xml.effect_at_once(big, 0, len(big), b"frames") == split_xml.Effect(0, ["<a>"], "", [])


def test_packed_feeds_are_cut_and_read_like_others(spark, tmp_path):
    n = 20_000
    sinks.write_feed(vehicles(spark, n), 7, {f: f"{tmp_path}/a/f.{f}" for f in ("pb", "json")})
    sinks.write_feed(vehicles(spark, n), 7, {f: f"{tmp_path}/b/f.{f}.zst" for f in ("pb", "json")})
    rows = lambda folder, **o: sorted((r["file"].rpartition("/")[2].removesuffix(".zst"), r["place"], r["id"], r["entity"]["vehicle"]["timestamp"]) for r in gtfsrt.read(spark, str(tmp_path / folder), **o).collect())
    want = rows("a")
    assert len(want) == 2 * n == len({r[:2] for r in want}) == len({(r[0], r[2]) for r in want})
    assert rows("b") == want == rows("b", size=100_000) == rows("a", size=100_000) == rows("b", size=100_000, fields="vehicle struct<timestamp: long>")
    for f in ("pb", "json"):
        plain = (tmp_path / "a" / f"f.{f}").read_bytes()
        assert (tmp_path / "b" / f"f.{f}.zst").stat().st_size < len(plain) / 3
        with files.opened(str(tmp_path / "b" / f"f.{f}.zst")) as file:
            assert file.size() == len(plain) and b"".join(files.streamed(file)) == plain
            for at in (0, 1, 777, len(plain) // 2, len(plain) - 1):
                assert b"".join(files.chunks(file, at, min(len(plain), at + 3_000))) == plain[at : at + 3_000]
        (tmp_path / "c").mkdir(exist_ok=True)
        (tmp_path / "c" / f"f.{f}.zst").write_bytes(files.packed(plain)[0])  # without a seek table
    assert rows("c", size=1_000) == want


def test_parts_are_removed_as_they_are_joined(spark, tmp_path):
    sinks.write_feed(vehicles(spark, 40), 7, {"pb": f"{tmp_path}/f.pb"}, staging=f"{tmp_path}/stage", batch="1")
    assert [p.name for p in (tmp_path / "stage").iterdir()] == ["delivered-1-0"]


def test_a_range_whose_end_is_guessed_within_a_text_is_read_on():
    """A guess that is no end of an entity leaves no list of entities behind the range's beginning."""
    inner = '{"id": "x", "alert": {}}'
    feed = ('{"entity": [' + ", ".join(json.dumps({"id": str(k), "alert": {"url": {"translation": [{"text": f"[{inner}, {inner}, {inner}]" * 20}]}}}) for k in range(60)) + "]}").encode()
    places = [p for p, _ in split_feeds.json_entities([feed])]
    for k, end in ((1, places[9] + 300), (5, places[30]), (3, len(feed))):
        found = split_feeds.json_walked(pa.BufferReader(feed), places[k], end, len(feed))
        if found is not None:
            behind = next((p for p in places if p >= end), len(feed))
            assert found == (behind, sum(places[k] <= p < behind for p in places))

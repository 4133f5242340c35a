"""Polls by schedule: what is due, what a failed batch gives when it runs again."""

from __future__ import annotations

import json
import threading
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from tramline import streaming
from tramline.operators import linkage as link
from tramline.operators.feed import Feed
from tramline.sources import netex, polling, remote


class Server(BaseHTTPRequestHandler):
    asked: list = []

    def do_GET(self):
        self.asked.append(self.path)
        self.send_response(404 if "gone" in self.path else 200)
        self.end_headers()
        self.wfile.write(b"" if "empty" in self.path else json.dumps({"n": len(self.asked), "key": self.headers.get("X-Key")}).encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = HTTPServer(("127.0.0.1", 0), Server)
    Server.asked.clear()
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_last_due():
    start = datetime(2026, 3, 1)
    for cron in ("*/30 * * * * *", "0 0,7,50 * * * *", "0 0 12 13 * 5", "* * * * * *", "0 0 0 29 feb ?", "0 15,45 8-9 * * MON-FRI"):
        for now in (start, start + timedelta(seconds=1), start + timedelta(hours=9, minutes=20, seconds=7), start + timedelta(days=13)):
            due, expected = start, None
            if "* * * * * *" == cron or cron.startswith("*/30"):
                k = 1 if cron[1] == " " else 30
                s = int((now - start).total_seconds()) // k * k
                expected = start + timedelta(seconds=s) if s else None
            else:
                while (due := remote.next_run(cron, due)) <= now:
                    expected = due
            assert polling.last_due(cron, start, now) == expected


def feeds(server):
    base = {"format": "json", "protocol": "siri"}
    return [
        base | {"provider": "a", "endpoint": f"{server}/a", "cron": "0 */5 * * * *", "headers": {"X-Key": "k"}},
        base | {"provider": "b/b", "endpoint": f"{server}/b", "cron": "0 0 7,9 * * *"},
        base | {"provider": "late", "endpoint": f"{server}/late", "cron": "0 0 23 * * *"},
        base | {"provider": "gone", "endpoint": f"{server}/gone", "cron": "0 * * * * *"},
        base | {"provider": "empty", "endpoint": f"{server}/empty", "cron": "0 * * * * *"},
        base | {"provider": "down", "endpoint": "http://127.0.0.1:1/", "cron": "0 * * * * *"},
    ]


def run(spark, tmp_path, server, until, handle, **more):
    stream = polling.polls(spark, feeds(server), f"{tmp_path}/log", start="2026-01-01T06:58:00", until=until, **more)
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()


def test_each_feed_by_its_schedule(spark, tmp_path, server):
    got = []
    keep = lambda batch, _: got.extend((r["provider"], r["timestamp"], json.loads(r["payload"])["key"]) for r in batch.collect())
    run(spark, tmp_path, server, "2026-01-01T06:59:30", keep)
    assert got == [] and "/a" not in Server.asked
    run(spark, tmp_path, server, "2026-01-01T07:11:00", keep)
    assert sorted(got) == [("a", "2026-01-01T07:10:00", "k"), ("b/b", "2026-01-01T07:00:00", None)]
    asked = Server.asked.count("/a")
    run(spark, tmp_path, server, "2026-01-01T07:11:00", keep)  # nothing new is due
    assert Server.asked.count("/a") == asked == 1 and len(got) == 2
    run(spark, tmp_path, server, "2026-01-01T09:02:00", keep)
    assert sorted(got[2:]) == [("a", "2026-01-01T09:00:00", "k"), ("b/b", "2026-01-01T09:00:00", None)] and "/late" not in Server.asked


def test_a_failed_batch_is_given_again(spark, tmp_path, server):
    seen = []

    def failing(batch, _):
        seen.append(sorted((r["provider"], r["payload"]) for r in batch.collect()))
        raise RuntimeError("the sink is down")

    with pytest.raises(Exception, match="sink is down"):
        run(spark, tmp_path, server, "2026-01-01T07:11:00", failing)
    asked = list(Server.asked)
    again = []
    keep = lambda batch, _: again.append(sorted((r["provider"], r["payload"]) for r in batch.collect()))
    # time has passed, but the batch that failed is run first, with the answers of then
    for _ in range(2):
        run(spark, tmp_path, server, "2026-01-01T07:16:00", keep)
    assert again[0] == seen[0] and len(seen[0]) == 2
    assert Server.asked.count("/a") == asked.count("/a") + 1 and [p for p, _ in again[1]] == ["a"]


def test_options(spark, tmp_path, server):
    got = []
    run(spark, tmp_path, server, "2026-01-01T07:11:00", lambda batch, _: got.extend(batch.collect()), compress="true")
    assert all(json.loads(remote.decompress(r["payload"]))["n"] and r["metadata"] == {"compressed": remote.COMPRESSED} for r in got) and len(got) == 2
    with pytest.raises(ValueError, match="fields"):
        polling.PollReader({"feeds": '[{"provider": "p", "endpoint": "e", "cron": "* * * * *"}]', "log": "x"})


# --- versions of the timetable, fan-out, observed counts, table functions ------------


def queued(spark, path, rows):
    spark.createDataFrame([(p, t, ("json", "siri", {}, x)) for p, t, x in rows], "provider string, timestamp string, rawdata struct<format: string, protocol: string, metadata: map<string, string>, payload: string>").write.mode("append").json(path)


def stops(spark, name):
    return Feed(stops=spark.createDataFrame([("a", name, 0), ("a", name + "!", 1)], "stop_id string, stop_name string, _ord int"))


def test_a_batch_run_again_sees_its_version(spark, tmp_path):
    snapshots = streaming.Snapshots(spark, f"file://{tmp_path}/static")
    snapshots.publish(stops(spark, "one"), "v1")
    queued(spark, f"{tmp_path}/in", [("p", "1", "x")])
    seen = []

    def handle(rows, feed):
        seen.append((rows.first()["payload"], feed.stop("a").first()["stop_name"]))
        if len(seen) == 1:
            snapshots.publish(stops(spark, "two"), "v2")
            raise RuntimeError("lost")

    run = lambda: streaming.run(streaming.messages(spark, f"{tmp_path}/in"), handle, snapshots, f"{tmp_path}/check")
    assert streaming.supervise(run, pause=0, most=2) == 1
    queued(spark, f"{tmp_path}/in", [("p", "2", "y")])
    run().awaitTermination()
    assert seen == [("x", "one!"), ("x", "one!"), ("y", "two!")]
    for k in range(3, 6):
        snapshots.publish(stops(spark, str(k)), f"v{k}")
    assert snapshots.prune(keep=2) == ["v1", "v3"]  # the last batch saw v2
    assert [v for v, _ in snapshots.versions()] == ["v2", "v4", "v5"] and snapshots.feed().stop("a").first()["stop_name"] == "5!"
    assert snapshots.feed("v2").stop("a").first()["stop_name"] == "two!" and snapshots.prune(keep=2) == []
    with pytest.raises(ValueError, match="no version"):
        snapshots.feed("v1")


def test_fan_out_in_one_query(spark, tmp_path):
    snapshots = streaming.Snapshots(spark, f"file://{tmp_path}/static")
    snapshots.publish(stops(spark, "one"), "v1")
    queued(spark, f"{tmp_path}/in", [("a/1", "1", "old"), ("a/1", "2", "new"), ("b", "1", "x"), ("nobody", "1", "y")])
    got = []
    handle = lambda name: lambda rows, feed: got.append((name, [(r["provider"], r["payload"]) for r in rows.collect()], feed.stop("a").first()["stop_name"]))
    query = streaming.fan_out(streaming.messages(spark, f"{tmp_path}/in"), {"a/1": handle("A"), "b": handle("B"), "none": handle("C")}, snapshots, f"{tmp_path}/check")
    query.awaitTermination()
    assert sorted(got) == [("A", [("a/1", "new")], "one!"), ("B", [("b", "x")], "one!")]
    assert sum(p["numInputRows"] for p in query.recentProgress) == 4  # each message is read once


def test_counts_of_the_pass_itself(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "A")], "journey int, phase string")
    same, seen = link.observed(rows)
    assert sorted(same.collect(), key=str) == sorted(rows.collect(), key=str)
    assert seen.get == link.statistics(rows).first().asDict() == {"journeys": 4, "phase_a": 2, "phase_b": 1, "unresolved": 1, "unresolved_percent": 25.0}


XML = "<PublicationDelivery><dataObjects><CompositeFrame><frames><ServiceFrame><lines><Line id='L{0}'><Name>n{0}</Name></Line><Line id='M{0}'/></lines></ServiceFrame><HintFrame><hints><Hint id='H{0}'><Text>t</Text></Hint></hints></HintFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"


def test_profiles_as_table_functions(spark):
    netex.register_profile("hints", {"Hint": ("hints", "id text")}, {"HintFrame": {"hints": "Hint"}})
    netex.register_table_function(spark, "netex_table")
    spark.createDataFrame([(k, XML.format(k).encode()) for k in range(3)] + [(9, None)], "n int, content binary").createOrReplaceTempView("timetable_files")
    lines = spark.sql("select n, t.id, t.name from timetable_files, lateral netex_table(content, 'Line', 'epip') t")
    assert sorted(map(tuple, lines.collect())) == sorted((k, f"{x}{k}", f"n{k}" if x == "L" else "") for k in range(3) for x in "LM")
    hints = spark.sql("select t.* from timetable_files, lateral netex_table(content, 'Hint', 'hints') t")
    assert hints.columns == ["id", "text"] and hints.count() == 3
    with pytest.raises(Exception, match="no table of"):
        spark.sql("select t.* from timetable_files, lateral netex_table(content, 'Hint', 'epip') t")


def test_a_folder_of_tables_in_one_scan(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"own_{k}.csv").write_text(f"id,text\n{k}, a \n\"x\n{k}\",\"b, \"\"c\"\"\"\n")
    (tmp_path / "lines.csv").write_text("﻿ id ,name\nL,n\n")
    (tmp_path / "notices.csv").write_text("ragged\n1,2\n")
    (tmp_path / "readme.txt").write_text("no")
    (tmp_path / "quays.csv").mkdir()
    for k in range(2):
        (tmp_path / f"quays.csv/part-{k}.csv").write_text(f"id\nQ{k}\n")
    rows = netex.read_csv_folder(spark, str(tmp_path), exclude=["Notice"])
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["type"], r["fields"]["id"]): r["fields"] for r in rows.collect()}
    assert len(got) == 63 and got["own_7", "x\n7"]["text"] == 'b, "c"' and got["own_7", "7"]["text"] == "a" and got["Line", "L"]["name"] == "n" and ("Quay", "Q1") in got
    only = netex.read_csv_folder(spark, str(tmp_path), only=["Line"])
    assert [r["type"] for r in only.collect()] == ["Line"]
    with pytest.raises(Exception, match="zip|argument"):
        netex.read_csv_folder(spark, str(tmp_path)).collect()


def test_no_address_is_no_answer(tmp_path):
    """A feed's address may be no URL, such as a path alone; the others are polled."""
    (tmp_path / "there").write_text("x")
    for endpoint in (f"{tmp_path}/none", "", "odd://x", "http://[", "http://127.0.0.1:port/", "http://127.0.0.1/a b"):
        assert polling.answer({"endpoint": endpoint}, 1.0) == ""
    assert polling.answer({"endpoint": f"file://{tmp_path}/there"}, 1.0) == "x"


def test_a_query_on_a_checkpoint_folder_without_a_scheme(spark, tmp_path, monkeypatch):
    from tramline.plans import shared_scans

    monkeypatch.setattr(shared_scans, "shared_dir", lambda spark: f"{tmp_path}/plain")
    assert shared_scans.s35(spark, "/root/testdata/sf0.001").count() > 0

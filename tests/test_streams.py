from __future__ import annotations

import csv
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from strataflow.sources import csv_files, csv_tail, messages, registry, versions
from strataflow.sources.bronze import ingest_csv, rejects_path
from strataflow.sources.files import drop_path, glob_paths
from strataflow.streaming import ingest, route_messages, start_bronze_stream
from strataflow.streaming.ingest import quarantine_path, stream_path
from tests.conftest import rows

SCHEMAS = registry.load_schemas({"ratings": ["userId", "rating"]})


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), messages.MESSAGE_SCHEMA)


def bronze(spark, base, name="ratings"):
    return versions.read_since(spark, stream_path(base, name))


def test_routing(spark, base):
    df = batch(
        spark,
        ("csv-ratings", '{"userId": "1", "rating": "4"}'),
        ("ratings", '{"userId": 2}'),  # no prefix: taken as it is; a missing field is NULL
        ("csv-ratings", "not json"),
        ("csv-other", '{"a": 1}'),
        (None, '{"b": 1}'),
    )
    assert route_messages(df, 0, SCHEMAS, base, database="bronze_stream") == ["ratings"]
    out = bronze(spark, base)
    assert out.columns == ["userId", "rating", "_ingestion_timestamp", "_source", "_topic"]
    assert rows(out.select("userId", "rating", "_topic")) == [("1", "4", "csv-ratings"), ("2", None, "ratings")]
    rejected = versions.read_since(spark, quarantine_path(base))
    assert rejected.columns == ["data", "error", "timestamp", "topic"]
    assert rows(rejected.select("data", "error", "topic")) == [
        ("not json", "not a JSON object", "csv-ratings"),
        ('{"a": 1}', "no schema registered for other", "csv-other"),
        ('{"b": 1}', "no schema registered for no topic", None),
    ]
    assert spark.table("bronze_stream.ratings").count() == 2


def test_every_message_becomes_a_row_or_a_dead_letter(spark, base):
    values = [
        '{"userId": "1"}', '{"rating": 4.5, "more": {"x": 1}}', ' \n {"userId": {"nested": true}}', "{broken", '{"userId": "1"', '[{"userId": "1"}]', "[]", "{}", "5",
        '"text"', "null", "", "  ", None, '{"userId": null}', '{"other": 1}', '{"userId": "1"} trailing', '{"userId": "a", "userId": "b"}',
    ]
    route_messages(batch(spark, *[("csv-ratings", v) for v in values]), 0, SCHEMAS, base)
    out = bronze(spark, base).select("userId", "rating")
    rejected = versions.read_since(spark, quarantine_path(base))
    assert out.count() + rejected.count() == len(values)
    assert out.where("userId IS NULL AND rating IS NULL").count() == 0
    assert out.count() == 5
    why = {(r["data"], r["error"]) for r in rejected.collect()}
    assert {(None, "no value"), ("{}", "no field of ratings"), ("{broken", "not a JSON object"), ('[{"userId": "1"}]', "not a JSON object")} <= why


def test_a_batch_of_misfits_alone_writes_no_table(spark, base):
    assert route_messages(batch(spark, ("csv-ratings", "nothing")), 0, SCHEMAS, base) == []
    assert versions.committed_versions(spark, stream_path(base, "ratings")) == []
    assert versions.read_since(spark, quarantine_path(base)).count() == 1


def test_a_prefix_is_plain_text(spark):
    df = spark.createDataFrame([("a.b-x",), ("aXb-x",)], "topic string")
    assert rows(df.select(messages.schema_name_of("topic", "a.b"))) == [("aXb-x",), ("x",)]


def test_quarantined_messages_are_taken_back_once(spark, base):
    known = {"ratings": ["userId"]}
    for n, pairs in enumerate([
        [("csv-late", '{"x": "1"}'), ("csv-ratings", "{broken"), ("csv-never", "{}")],
        [("csv-late", '{"x": "2"}'), ("csv-late", "broken"), ("csv-ratings", '{"userId": "1"}')],
    ]):
        route_messages(batch(spark, *pairs), n, registry.load_schemas(known), base)
    assert ingest.replay_quarantine(spark, base, registry.load_schemas(known)) == {}
    schemas = registry.load_schemas({**known, "late": ["x"]})
    assert ingest.replay_quarantine(spark, base, schemas) == {"late": [0, 1]}
    late = bronze(spark, base, "late")
    assert rows(late.select("x", "_topic")) == [("1", "csv-late"), ("2", "csv-late")]
    assert versions.committed_versions(spark, stream_path(base, "late")) == [2]  # beyond all others
    assert ingest.replay_quarantine(spark, base, schemas) == {}
    assert bronze(spark, base, "late").count() == 2
    newest = versions.read_since(spark, quarantine_path(base), 1)
    assert rows(newest.select("data", "error")) == [("broken", "not a JSON object")]


def test_a_replay_that_broke_off_is_finished_under_its_number(spark, base, monkeypatch):
    schemas = registry.load_schemas({"late": ["x"]})
    route_messages(batch(spark, ("csv-late", '{"x": "1"}')), 0, {}, base)
    write = ingest.write_version

    def fail(df, path, *args, **kwargs):
        write(df, path, *args, **kwargs)
        if path.endswith("/late"):
            drop_path(spark, f"{versions.version_path(path, args[0])}/_SUCCESS")
            raise OSError("driver lost")

    monkeypatch.setattr(ingest, "write_version", fail)
    with pytest.raises(OSError):
        ingest.replay_quarantine(spark, base, schemas)
    monkeypatch.undo()
    route_messages(batch(spark, ("csv-late", '{"x": "2"}')), ingest.version_for(spark, base, "q", 0), {}, base)  # more is quarantined meanwhile
    assert ingest.replay_quarantine(spark, base, schemas) == {"late": [0, 2]}
    assert rows(bronze(spark, base, "late").select("x")) == [("1",), ("2",)]
    assert versions.committed_versions(spark, stream_path(base, "late")) == [1, 3]


def test_queries_that_take_turns_share_numbers(spark, base):
    number = lambda query, batch: ingest.version_for(spark, base, query, batch)
    assert [number("a", 0), number("a", 1), number("b", 0), number("a", 2), number("b", 1), number("a", 2), number("a", 3)] == [0, 1, 2, 3, 4, 3, 5]
    kept = glob_paths(spark, f"{base}/streaming_queries/*/batch=*")
    assert sorted(p.rsplit("/", 2)[1] + p.rsplit("=", 1)[1] for p in kept) == ["a2", "a3", "b0", "b1"]


def test_a_stream_replays_what_was_registered(spark, base):
    inbox, known = f"{base}/in", {"ratings": ["userId"]}

    def run():
        start_bronze_stream(
            messages.file_messages(spark, inbox), lambda: registry.load_schemas(known), base, f"{base}/cp", available_now=True, replay=True
        ).awaitTermination()

    write_messages(inbox, "a", ("csv-ratings", '{"userId": "1"}'), ("csv-late", '{"x": "1"}'))
    run()
    known["late"] = ["x"]
    write_messages(inbox, "b", ("csv-late", '{"x": "2"}'))
    run()
    run()
    assert rows(bronze(spark, base, "late").select("x")) == [("1",), ("2",)]


def test_columns_are_inferred_from_messages(spark):
    df = batch(
        spark,
        ("csv-a", '{"n": 1, "x": 1.5, "s": "t", "o": {"k": true}}'),
        ("csv-a", '{"n": 300000, "x": 2, "s": null}'),
        ("csv-a", "[1]"), ("csv-a", "5"), ("csv-a", "{broken"), ("csv-a", None), (None, '{"n": 1}'),
        ("csv-b", '{"n": "one"}'), ("csv-b", '{"n": 1}'), ("csv-c", "{}"),
    )
    found = messages.inferred_columns(df)
    assert rows(found) == [
        ("a", "n", "BIGINT", 2), ("a", "o", "OBJECT<k: BOOLEAN>", 1), ("a", "s", "STRING", 2), ("a", "x", "DECIMAL(21,1)", 2), ("b", "n", "VARIANT", 2),
    ]
    assert rows(messages.proposed_headers(found)) == [("inferred/a", "a", ["n", "o", "s", "x"]), ("inferred/b", "b", ["n"])]


# --- the tail of growing files -----------------------------------------------------------


def append(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "ab") as f:
        f.write(text.encode())


def tailed(spark, folder, checkpoint, out, **options):
    """One start of the tail: what its batches brought, beyond what ``out`` has."""

    def keep(df, batch_id):
        out.setdefault(batch_id, [])
        out[batch_id] = [(r.file_path.rsplit("/", 1)[1], r.row_start, list(r["values"])) for r in df.collect()]

    stream = csv_tail.csv_tail_stream(spark, folder, **options)
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def plain_tail(path, name):
    with open(f"{path}/{name}.csv", newline="", encoding="utf-8") as f:
        return [row for row in csv.reader(f) if row][1:]


@pytest.mark.parametrize("multiline", [False, True])
def test_tail_as_a_stream(spark, base, multiline, monkeypatch):
    rng, folder = random.Random(11), f"{base}/csv"
    monkeypatch.setattr(csv_tail, "BLOCK", 64)
    breaks = ["\n", "two\nlines", 'say "hi"\n', "\r\n"] if multiline else []

    def line():
        return ",".join('"' + v.replace('"', '""') + '"' if set(v) & set('",\n\r') else v for v in rng.choices(["", "x", "ü" * 50, 'q"t', "a,b", "\\", *breaks], k=rng.choice([2, 2, 3])))

    out = {}
    half = ""
    for turn in range(4):
        for name in ("one", "two", f"new{turn}"):
            text = "" if os.path.exists(f"{folder}/{name}.csv") else "a,b\n"
            text += "".join(line() + rng.choice(["\n", "\r\n"] if not multiline else ["\n"]) + rng.choice(["", "", "\n"]) for _ in range(rng.choice([0, 1, 30])))
            append(folder, name, text)
        # A line that another program is still writing is left for the next start.
        append(folder, "one", half[len(half) // 2 :] + ("\n" if half else ""))
        half = 'half,"wri""tten"'
        append(folder, "one", half[: len(half) // 2])
        tailed(spark, folder, f"{base}/cp", out, multiline=multiline, split_bytes=100)
    append(folder, "one", half[len(half) // 2 :] + "\n")
    for _ in range(2):
        tailed(spark, folder, f"{base}/cp", out, multiline=multiline, split_bytes=100)
    got = {}
    for rows_ in out.values():
        for name, at, values in rows_:
            got.setdefault(name, []).append((at, values))
    for name in ("one", "two", "new0", "new3"):
        starts = [at for at, _ in sorted(got.get(f"{name}.csv", []))]
        assert len(set(starts)) == len(starts)
        assert [v for _, v in sorted(got.get(f"{name}.csv", []))] == plain_tail(folder, name)


def test_tail_to_bronze_through_failures(spark, base, monkeypatch):
    folder = f"{base}/csv"
    append(folder, "a", "x,y\n1,2\n3\n4,5\n")
    append(folder, "stranger", "z\n1\n")
    known = headers(spark, ("elsewhere/a.csv", "pairs", ["x", "y"]))
    write, failing = ingest.write_version, [True]

    def fail_after_writing(df, path, *args, **kwargs):
        write(df, path, *args, **kwargs)
        if failing and path.endswith("/pairs"):
            failing.pop()
            raise OSError("driver lost between rows and offsets")

    monkeypatch.setattr(ingest, "write_version", fail_after_writing)

    def run():
        sent = messages.tail_messages(csv_tail.csv_tail_stream(spark, folder), known)
        start_bronze_stream(sent, lambda: registry.load_schemas({"pairs": ["x", "y"]}), base, f"{base}/cp", available_now=True).awaitTermination()

    with pytest.raises(Exception, match="driver lost"):
        run()
    append(folder, "a", "6,7\n")
    for _ in range(2):
        run()
    assert rows(bronze(spark, base, "pairs").select("x", "y", "_topic")) == [("1", "2", "csv-pairs"), ("4", "5", "csv-pairs"), ("6", "7", "csv-pairs")]
    rejected = versions.read_since(spark, quarantine_path(base))
    assert rows(rejected.select("data", "error")) == [('["1"]', "no schema registered for no topic"), ('["3"]', "not a JSON object")]


def test_csv_lines_that_do_not_fit(spark, base):
    lines = ["1,a", "2", "3,b,c", "x,d", ",e", '5,"f,g"', "6,"]
    path = write_csv(f"{base}/csv", "q", "id,t", lines)
    good, rejects = csv_files.load_csv_checked(spark, path, "id int, t string")
    assert rows(good) == [(1, "a"), (5, "f,g"), (6, None), (None, "e")]
    assert rows(rejects.select("data")) == [("2",), ("3,b,c",), ("x,d",)]
    assert ingest_csv(spark, path, "id int, t string", "q", base, database="csv_bronze").endswith("batch/q")
    assert versions.read_since(spark, f"{base}/batch/q").count() == 4
    kept = versions.read_since(spark, rejects_path(base, "q")).select("data", F.col("topic").endswith("/csv/q.csv"))
    assert rows(kept) == [(x, True) for x in ("2", "3,b,c", "x,d")]


def test_a_replayed_batch_doubles_nothing(spark, base):
    for _ in range(2):
        route_messages(batch(spark, ("csv-ratings", '{"userId": "1"}'), ("csv-x", "{}")), 5, SCHEMAS, base)
    assert bronze(spark, base).count() == 1
    assert versions.read_since(spark, quarantine_path(base)).count() == 1


def test_a_failing_catalog_does_not_stop_the_stream(spark, base, monkeypatch):
    def fail(*args, **kwargs):
        raise OSError("catalog away")

    monkeypatch.setattr("strataflow.streaming.ingest.register_table", fail)
    route_messages(batch(spark, ("csv-ratings", '{"userId": "1"}')), 0, SCHEMAS, base, database="b")
    assert bronze(spark, base).count() == 1


def test_a_column_added_between_batches(spark, base):
    route_messages(batch(spark, ("csv-ratings", '{"userId": "1"}')), 0, SCHEMAS, base)
    wider = registry.load_schemas({"ratings": ["userId", "rating", "device"]})
    route_messages(batch(spark, ("csv-ratings", '{"userId": "2", "device": "tv"}')), 1, wider, base)
    assert rows(bronze(spark, base).select("userId", "device")) == [("1", None), ("2", "tv")]


def write_messages(folder, name, *pairs):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.writelines(json.dumps({"topic": t, "value": v}) + "\n" for t, v in pairs)


def test_stream_resumes_and_takes_new_schemas(spark, base):
    inbox, known = f"{base}/in", {"ratings": ["userId"]}

    def run():
        start_bronze_stream(
            messages.file_messages(spark, inbox), lambda: registry.load_schemas(known), base, f"{base}/cp", available_now=True
        ).awaitTermination()

    write_messages(inbox, "a", ("csv-ratings", '{"userId": "1"}'), ("csv-late", '{"x": "1"}'))
    run()
    known["late"] = ["x"]
    write_messages(inbox, "b", ("csv-ratings", '{"userId": "2"}'), ("csv-late", '{"x": "2"}'))
    run()
    run()
    assert rows(bronze(spark, base).select("userId")) == [("1",), ("2",)]
    assert rows(bronze(spark, base, "late").select("x")) == [("2",)]
    assert versions.read_since(spark, quarantine_path(base)).count() == 1


def test_messages_round_trip(spark):
    df = spark.createDataFrame([("1", None, 'say "hi"'), ("2", "b", "ü")], "a string, b string, c string")
    sent = messages.to_messages(df, F.lit("x"))
    assert {r["topic"] for r in sent.collect()} == {"csv-x"}
    parsed = messages.parse_messages(sent, csv_files.all_string(["a", "b", "c"]))
    assert rows(parsed.drop("topic")) == rows(df)
    names = sent.select(messages.schema_name_of("topic")).distinct()
    assert rows(names) == [("x",)]


def write_csv(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return f"{folder}/{name}.csv"


def test_csv_files_headers_and_stream(spark, base):
    folder = f"{base}/csv"
    write_csv(folder, "b", "x , y", ["1,2"])
    write_csv(folder, "a", 'x,"y,z"', ["1,2"])
    open(f"{folder}/c.txt", "w").close()
    found = csv_files.discover_csv_files(spark, folder)
    assert [p.rsplit("/", 1)[1] for p in found] == ["a.csv", "b.csv"]
    headers = csv_files.read_headers(spark, found)
    assert rows(headers.select("schema_name", "columns")) == [("a", ["x", "y,z"]), ("b", ["x", "y"])]
    assert rows(csv_files.load_csv(spark, f"{folder}/b.csv", "x int, y int")) == [(1, 2)]

    stream = csv_files.csv_stream(spark, folder, ["x", "y"])
    sent = messages.to_messages(stream, F.lit("pairs"))
    start_bronze_stream(sent, lambda: registry.load_schemas({"pairs": ["x", "y"]}), base, f"{base}/cp", available_now=True).awaitTermination()
    assert rows(bronze(spark, base, "pairs").select("x", "y")) == [("1", "2"), ("1", "2")]


def test_csv_values_are_read_as_other_readers_do(spark, base):
    lines = ['1,"say ""hi"", you"', "2,", '3,"a\\b"', "4, x ", '5,"two\nlines"']
    path = write_csv(f"{base}/csv", "q", "id,t", lines)
    with open(path, newline="") as f:
        expected = [tuple(r.values()) for r in csv.DictReader(f)]
    tail, _ = csv_files.csv_tail(spark, [path], ["id", "t"], multiline=True)
    assert rows(tail.select("id", "t")) == sorted(expected, key=repr)
    assert [r[0] for r in tail.orderBy("id").select("row_number").collect()] == [1, 2, 3, 4, 5]
    loaded = csv_files.load_csv(spark, path, "id int, t string", multiline=True)
    assert rows(loaded.where("id = 2")) == [(2, None)]


def test_files_that_did_not_grow_are_not_read(spark, base):
    paths = [write_csv(f"{base}/csv", name, "id", ["1", "2"]) for name in ("a", "b")]
    _, offsets = csv_files.csv_tail(spark, paths, ["id"])
    stored = spark.createDataFrame([tuple(r) for r in offsets.collect()], offsets.schema)
    tail, same = csv_files.csv_tail(spark, paths, ["id"], stored)
    assert tail.columns == ["id", "file_path", "row_number"] and tail.count() == 0
    assert rows(same) == rows(stored)
    write_csv(f"{base}/csv", "b", "id", ["1", "2", "3"])
    tail, offsets = csv_files.csv_tail(spark, paths, ["id"], stored)
    assert [p.rsplit("/", 1)[1] for p in tail.inputFiles()] == ["b.csv"]
    assert rows(tail.select("id", "row_number")) == [("3", 3)]
    assert {r[0].rsplit("/", 1)[1]: r[1] for r in offsets.collect()} == {"a.csv": 2, "b.csv": 3}


def test_tail_of_growing_files_matches_a_plain_reader(spark, base, conf):
    # Small blocks, so that each file is read by many tasks and a task reads many blocks.
    conf(spark__sql__files__maxPartitionBytes="4k", spark__sql__files__openCostInBytes="1k")
    rng, folder, content = random.Random(7), f"{base}/csv", {}
    for name, n in (("one", 3000), ("two", 37), ("empty", 0), ("three", 500)):
        content[name] = [f"{name}-{i},{rng.randint(0, 10**rng.randint(1, 30))}" for i in range(n)]
    paths = {name: write_csv(folder, name, "id,n", lines) for name, lines in content.items()}
    found = csv_files.discover_csv_files(spark, folder)
    tail, offsets = csv_files.csv_tail(spark, found, ["id", "n"])
    assert rows(tail.select("id", "row_number")) == sorted(
        ((line.split(",")[0], i + 1) for lines in content.values() for i, line in enumerate(lines)), key=repr
    )
    saved = {r["file_path"].rsplit("/", 1)[1]: r["row_offset"] for r in offsets.collect()}
    assert saved == {"one.csv": 3000, "two.csv": 37, "three.csv": 500}
    stored = spark.createDataFrame([tuple(r) for r in offsets.collect()], offsets.schema)

    # Two files grow, one new file appears.
    content["one"] += [f"one-new-{i},{i}" for i in range(800)]
    content["empty"] += ["empty-new-0,1"]
    content["four"] = ["four-0,1"]
    for name in ("one", "empty", "four"):
        paths[name] = write_csv(folder, name, "id,n", content[name])
    found = csv_files.discover_csv_files(spark, folder)
    tail, offsets = csv_files.csv_tail(spark, found, ["id", "n"], stored)
    expected = [(f"one-new-{i}", 3001 + i) for i in range(800)] + [("empty-new-0", 1), ("four-0", 1)]
    assert rows(tail.select("id", "row_number")) == sorted(expected, key=repr)
    assert {r["file_path"].rsplit("/", 1)[1]: r["row_offset"] for r in offsets.collect()} == {
        "one.csv": 3800, "two.csv": 37, "three.csv": 500, "four.csv": 1, "empty.csv": 1,
    }


def headers(spark, *data):
    return spark.createDataFrame(list(data), csv_files.HEADERS_SCHEMA)


def test_canonical_schemas(spark):
    df = headers(
        spark,
        ("1/a.csv", "a", ["x", "y"]),
        ("2/b.csv", "b", ["x", "y"]),  # same columns: the first name
        ("3/a.csv", "a", ["y", "x"]),  # order matters; the name is taken
        ("4/a.csv", "a", ["z"]),
        ("5/a_1.csv", "a_1", ["w"]),
    )
    table = registry.canonical_schemas(df)
    assert rows(table.select("file_path", "schema_name")) == [
        ("1/a.csv", "a"), ("2/b.csv", "a"), ("3/a.csv", "a_1"), ("4/a.csv", "a_2"), ("5/a_1.csv", "a_1_1"),
    ]
    assert registry.get_schema(table, "a_1") == ["y", "x"]
    assert registry.get_schema(table, "nope") is None
    assert registry.list_schemas(table).count() == 4
    assert registry.list_file_mappings(table).count() == 5
    assert list(registry.load_schemas(table)) == ["a", "a_1", "a_1_1", "a_2"]


@pytest.mark.parametrize("refresh", [False, True])
def test_known_files_keep_their_schema_unless_refreshed(spark, refresh):
    known = headers(spark, ("1/a.csv", "a", ["x"]))
    df = headers(spark, ("1/a.csv", "a", ["x", "new"]), ("2/b.csv", "b", ["x"]))
    table = registry.canonical_schemas(df, known, force_refresh=refresh)
    first = ("1/a.csv", "a_1", ["x", "new"]) if refresh else ("1/a.csv", "a", ["x"])
    assert rows(table) == [first, ("2/b.csv", "a", ["x"])]


def test_both_registry_forms_load():
    new = registry.load_schemas({"schemas": {"a": ["x"]}, "file_mappings": {}})
    assert new == registry.load_schemas({"a": ["x"]})
    assert [f.dataType.simpleString() for f in new["a"]] == ["string"]


def test_new_checkpoint_adds_to_what_is_there(spark, base):
    for n in range(2):
        spark.createDataFrame([("a", f'{{"x": "{n}"}}')], "topic string, value string").write.json(f"{base}/in{n}")
        for _ in range(2):  # the second time there is nothing new
            start_bronze_stream(
                messages.file_messages(spark, f"{base}/in{n}"), lambda: registry.load_schemas({"a": ["x"]}), base, f"{base}/check{n}", available_now=True
            ).awaitTermination()
    assert rows(versions.read_since(spark, stream_path(base, "a")).select("x")) == [("0",), ("1",)]


def test_failed_registration_is_made_up_for(spark, base, monkeypatch):
    from strataflow.streaming import ingest

    schemas, real = registry.load_schemas({"made_up": ["x"]}), ingest.register_table

    def batch(n):
        df = spark.createDataFrame([("made_up", f'{{"x": "{n}"}}')], "topic string, value string")
        ingest.route_messages(df, n, schemas, base, prefix="", database="late")

    batch(0)
    monkeypatch.setattr(ingest, "register_table", lambda *a, **k: (_ for _ in ()).throw(OSError("away")))
    batch(1)
    monkeypatch.setattr(ingest, "register_table", real)
    batch(2)
    assert rows(spark.table("late.made_up").select("x")) == [("0",), ("1",), ("2",)]


def test_registry_keeps_what_is_not_in_this_call(spark):
    def headers(*names):
        return spark.createDataFrame([(f"{n}.csv", n, [n, "id"]) for n in names], "file_path string, schema_name string, columns array<string>")

    known = registry.canonical_schemas(headers("a", "b"))
    for force in (False, True):
        again = registry.canonical_schemas(headers("b", "c"), known, force_refresh=force)
        assert rows(again.select("file_path", "schema_name")) == [("a.csv", "a"), ("b.csv", "b"), ("c.csv", "c")]


def test_many_topics_in_one_batch(spark, base):
    data = [(f"t{k}", f'{{"x": "{k}-{i}"}}') for k in range(50) for i in range(2)]
    df = spark.createDataFrame(data, "topic string, value string")
    schemas = registry.load_schemas({f"t{k}": ["x"] for k in range(50)})
    for _ in range(2):  # a replay doubles nothing
        assert len(route_messages(df, 0, schemas, base, prefix="")) == 50
    assert rows(versions.read_since(spark, stream_path(base, "t7")).select("x")) == [("7-0",), ("7-1",)]

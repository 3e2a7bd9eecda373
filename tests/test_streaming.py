"""The event pipeline: arrivals, restart, poison rows, replay, redrive."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from larder.schemas import CHUNK_MANIFEST, FAILURE, SANITIZED, URL_LIST
from larder.sinks import commits as cm
from larder.sources import messages as mx
from larder.streaming import pipeline as sp
from larder.streaming import retries as rt


def page(name):
    recipe = {"@type": "Recipe", "name": name, "recipeIngredient": [f"1 cup {name} oil"], "cookTime": "PT5M"}
    return f'<script type="application/ld+json">{json.dumps(recipe)}</script>'


class Places:
    def __init__(self, root):
        for name in ("urls", "out", "tagged", "messages", "manifest", "progress"):
            setattr(self, name, str(root / name))
        (root / "urls").mkdir()

    def arrive(self, name, rows):
        with open(f"{self.urls}/{name}", "w", newline="") as f:
            csv.writer(f).writerows([("uid", "url"), *rows])


@pytest.fixture
def places(tmp_path):
    return Places(tmp_path)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(f"https://x/{n}", page(n)) for n in "abc"], "url string, html string")


@pytest.fixture
def few_partitions(spark):
    """State in two partitions: each keeps a store and a Python worker of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def run(rows, work, checkpoint):
    sp.start(rows, work, checkpoint, backfill=True).awaitTermination()


def stage(spark, places, pages):
    run(sp.url_files(spark, places.urls), sp.stage_batch(pages, places.out), f"{places.progress}/stage")


def staged(spark, places):
    rows = cm.read_committed(spark, places.out, "staged", SANITIZED).collect()
    return sorted((r["uid"], r["title"], r["cook_time"], tuple(r["ingredients"])) for r in rows)


def test_two_arrivals_and_a_restart_equal_one_batch(spark, places, pages):
    places.arrive("1.csv", [("u1", "https://x/a"), ("u2", "https://x/gone")])
    places.arrive("ignored.txt", [("u9", "https://x/a")])
    stage(spark, places, pages)
    places.arrive("2.csv", [("u3", "https://x/b"), ("u4", "")])
    stage(spark, places, pages)
    stage(spark, places, pages)
    assert staged(spark, places) == [("u1", "a", 5, ("1 cup a oil",)), ("u3", "b", 5, ("1 cup b oil",))]
    failed = cm.read_committed(spark, places.out, "failed", FAILURE).collect()
    assert sorted((r["uid"], r["status_code"]) for r in failed) == [("u2", 404), ("u4", 404)]


def test_a_batch_run_again_replaces_its_output(spark, places, pages):
    rows = spark.createDataFrame([("u1", "https://x/a"), ("u2", "no")], "uid string, url string")
    work = sp.stage_batch(pages, places.out)
    work(rows, 0)
    work(rows, 0)
    work(rows.where("uid = 'u2'").selectExpr("'u3' AS uid", "'https://x/c' AS url"), 1)
    assert [r[0] for r in staged(spark, places)] == ["u1", "u3"]
    assert cm.read_committed(spark, places.out, "failed", FAILURE).count() == 1


def test_an_empty_batch_writes_nothing(spark, places, pages):
    rows = spark.createDataFrame([], "uid string, url string")
    sp.stage_batch(pages, places.out)(rows, 0)
    assert staged(spark, places) == []


def test_tagging_of_staged_batches(spark, places, pages):
    places.arrive("1.csv", [("u1", "https://x/a"), ("u1", "https://x/a"), ("u2", "https://x/b")])
    stage(spark, places, pages)
    vocab = spark.createDataFrame([("A oil",), ("oil",)], "ingredients string")
    tag = sp.tag_batch(vocab, places.out, places.tagged)
    run(sp.staged_batches(spark, places.out), tag, f"{places.progress}/tag")
    rows = cm.read_committed(spark, places.tagged, "tagged", SANITIZED)
    got = sorted((r["uid"], r["ingredient_tags"]) for r in rows.collect())
    assert got == [("u1", ["a oil"]), ("u1", ["a oil"]), ("u2", ["oil"])]
    once = sp.first_delivery(rows.withColumn("n", F.monotonically_increasing_id()), "n").collect()
    assert sorted(r["uid"] for r in once) == ["u1", "u2"]


def test_fan_out_and_manifest(spark, places):
    sizes = {"f0": 0, "f1": 1, "f4": 4, "f5": 5, "f42": 42}
    for name, n in sizes.items():
        places.arrive(f"{name}.csv", [(f"{name}-{i}", f"https://x/{i}") for i in range(n)])
    files = sp.url_files(spark, places.urls, files_per_batch=2)
    run(files, sp.fan_out_batch(places.messages), f"{places.progress}/fan")
    sent = cm.read_committed(spark, places.messages, "messages", "key string, value string").collect()
    assert len(sent) == sum(sizes.values())
    assert {json.loads(r["value"])["uid"] for r in sent} == {r["key"] for r in sent}
    run(files, sp.manifest_batch(places.manifest), f"{places.progress}/manifest")
    made = cm.read_committed(spark, places.manifest, "manifest", "file string, start_index long, nrows long").collect()
    got = sorted((r["file"].rsplit("/", 1)[1], r["start_index"], r["nrows"]) for r in made)
    assert got == sorted((f"{f}.csv", i * 4 + 1, 4) for f, n in sizes.items() for i in range((n + 3) // 4))


def test_redrive_stops_after_enough_attempts(spark, pages):
    log = [("u1", "https://x/a", 404, 1), ("u2", "https://x/b", 404, 1), ("u2", "https://x/b", 404, 2), ("u3", "gone", 404, 1)]
    failures = spark.createDataFrame(log, FAILURE)
    ok, failed = sp.redrive(failures, pages, 2)
    assert [r["uid"] for r in ok.collect()] == ["u1"]
    assert [(r["uid"], r["status_code"]) for r in failed.collect()] == [("u3", 404)]


def test_message_decoding(spark):
    bodies = ['{"uid": "u", "url": "x"}', '{"uid": "u"}', "[1]", "{bad", None, '{"uid": "u"} more']
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "messageId string, body string")
    rows = mx.url_messages(df).orderBy("messageId").collect()
    assert [r["unreadable"] for r in rows] == [False, False, True, True, True, True]
    assert [(r["uid"], r["url"]) for r in rows[:2]] == [("u", "x"), ("u", None)]


def test_object_event(spark):
    body = json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "k.csv", "size": 3}}}]})
    row = mx.object_events(spark.createDataFrame([(body,)], "body string")).first()
    assert (row["bucket"], row["object_key"]) == ("b", "k.csv")
    chunk = spark.createDataFrame([('{"start_index": 5, "nrows": 4, "s3_bucket": "b", "s3_file_path": "f"}',)], "body string")
    assert [mx.chunk_messages(chunk).first()[f] for f in CHUNK_MANIFEST.fieldNames()] == [5, 4, "b", "f"]


def test_a_batch_is_seen_whole_or_as_it_was(spark, places, pages, monkeypatch):
    """A run that stops between the two tables, or before the commit, changes nothing for readers."""
    rows = spark.createDataFrame([("u1", "https://x/a"), ("u2", "no")], "uid string, url string")
    sp.stage_batch(pages.limit(0), places.out)(rows, 0)

    def seen():
        failed = cm.read_committed(spark, places.out, "failed", FAILURE).collect()
        return [r[0] for r in staged(spark, places)], sorted(r["uid"] for r in failed)

    assert seen() == ([], ["u1", "u2"])
    found = sp.enrich(rows, pages)
    ok, failed = sp.split_outcome(found)
    zero = F.lit(0).cast("bigint")
    cm.write_uncommitted(places.out, {"staged": ok.withColumn("batch_id", zero)})
    assert seen() == ([], ["u1", "u2"])

    broken = failed.withColumn("url", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        cm.commit_batch(spark, places.out, 0, staged=ok, failed=broken)
    assert seen() == ([], ["u1", "u2"])
    sp.stage_batch(pages, places.out)(rows, 0)
    assert seen() == (["u1"], ["u2"])
    assert cm.read_committed(spark, str(places.out) + "/nothing", "staged", SANITIZED).count() == 0


def test_a_batch_staged_anew_is_tagged_anew(spark, places, pages):
    vocab = spark.createDataFrame([("A oil",)], "ingredients string")
    rows = spark.createDataFrame([("u1", "https://x/a"), ("u2", "https://x/b")], "uid string, url string")
    tag = sp.tag_batch(vocab, places.out, places.tagged)
    for known, expected in ((pages, ["u1", "u2"]), (pages.where("url LIKE '%a'"), ["u1"]), (pages.limit(0), [])):
        sp.stage_batch(known, places.out)(rows, 0)
        run(sp.staged_batches(spark, places.out), tag, f"{places.progress}/tag")
        tagged = cm.read_committed(spark, places.tagged, "tagged", SANITIZED)
        assert sorted(r["uid"] for r in tagged.collect()) == expected


def test_messages_delivered_again_are_handled_once(spark, places, few_partitions):
    def work(batch, batch_id):
        cm.commit_batch(spark, places.out, batch_id, messages=batch.select("uid", "url"))

    rows = [("u1", "https://x/a"), ("u2", "https://x/b"), ("u1", "https://x/a"), ("", "https://x/c"), ("", "https://x/d")]
    for name in ("1.csv", "2.csv"):
        places.arrive(name, [*rows, (name, "https://x/a")])
        run(sp.unrepeated(sp.url_files(spark, places.urls)), work, f"{places.progress}/once")
    sent = cm.read_committed(spark, places.out, "messages", URL_LIST).collect()
    assert sorted(((r["uid"] or ""), r["url"][-1]) for r in sent) == [
        ("", "c"), ("", "d"), ("1.csv", "a"), ("2.csv", "a"), ("u1", "a"), ("u2", "b")]


def test_waits_grow_to_the_longest():
    waits = [[rt.wait_seconds(f"u{i}", n) for i in range(200)] for n in (1, 2, 5)]
    assert all(3 <= w <= 6 for w in waits[0]) and all(3 <= w <= 9 for w in waits[1] + waits[2])
    assert max(waits[0]) > 5.5 and max(waits[2]) > 8.5 and rt.wait_seconds("u", 1) == rt.wait_seconds("u", 1)
    assert rt.wait_seconds("u", 3, first=5, longest=2) == 5


def test_a_failure_reported_again_is_tried_once(spark, places, pages, few_partitions):
    """The feed of failures gets every report twice, as after a batch that was run again."""
    places.arrive("1.csv", [("u1", "https://x/a"), ("u2", "https://x/gone"), ("u3", "https://x/late")])
    late = spark.createDataFrame([("https://x/late", page("late"))], "url string, html string")

    def lookup(batch):
        first, again = batch.where("attempt = 1"), batch.where("attempt > 1")
        return sp.enrich(first, pages, keep=["attempt"]).unionByName(sp.enrich(again, pages.unionByName(late), keep=["attempt"]))

    attempt = rt.attempt_batch(lookup, places.out, 2)

    def work(batch, batch_id):
        attempt(batch, batch_id)
        if batch_id == 0:
            reports = [("u2", "https://x/gone", 1), ("u3", "https://x/late", 1)]
            spark.createDataFrame(reports, rt.ATTEMPT).write.mode("append").parquet(f"{places.out}/retries")

    rows = rt.attempts(sp.url_files(spark, places.urls), places.out, first=0.2, longest=0.3)
    run_ = sp.start(rows, work, f"{places.progress}/retries", wait="200 milliseconds")
    rt.drain(run_, spark, places.out, 2, seconds=240)
    failed = cm.read_committed(spark, places.out, "failed", rt.FAILED_ATTEMPT).collect()
    assert sorted((r["uid"], r["attempt"]) for r in failed) == [("u2", 1), ("u2", 2), ("u3", 1)]
    assert [r[0] for r in staged(spark, places)] == ["u1", "u3"]


def test_batches_close_by_number_or_age_over_micro_batches(spark, places, few_partitions):
    import datetime as dt

    from larder.streaming.batching import batched

    def at(second):
        return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)

    arrivals, out = f"{places.out}/arrivals", []
    schema = "queue string, arrived timestamp, message string"

    def work(batch, batch_id):
        out.extend((r["queue"], r["batch_no"], r["why"], [m["message"] for m in r["messages"]]) for r in batch.collect())

    # The second arrival goes on with the open batch of "a"; nothing follows in "b".
    rounds = [
        [("a", at(0), "1"), ("a", at(3), "3"), ("a", at(2), "2"), ("a", at(4), "4"), ("b", at(1), "x")],
        [("a", at(19), "5"), ("a", at(24), "6"), ("a", at(60), "7"), (None, at(60), "n")],
    ]
    for rows in rounds:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(schema).parquet(arrivals)
        run(batched(stream, size=3, wait=20), work, f"{places.progress}/batches")
    assert sorted(out) == [
        ("a", 0, "full", ["1", "2", "3"]), ("a", 1, "age", ["4", "5"]), ("a", 2, "age", ["6"]), ("b", 0, "age", ["x"])]


def test_batches_hold_a_bounded_part_of_a_queue(monkeypatch):
    """The rows of a queue used to be held and sorted at once, and so were its batches."""
    import pandas as pd

    from larder.streaming import batching

    n = 3000
    monkeypatch.setattr(batching, "HELD_BYTES", 100 * 400, raising=False)

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def put(self, value):
            self.value = value

        update = put

        def clear(self):
            self.value = None

    class Handle:
        def getValueState(self, *_):
            return State()

        def getListState(self, *_):
            return State()

        def listTimers(self):
            return []

        def registerTimer(self, due):
            self.due = due

    def frames():
        for low in range(0, n, 50):
            times = [(i * 7919 % n) * 1_000_000 for i in range(low, low + 50)]
            texts = [f"m{at}" if at % 3_000_000 else None for at in times]
            yield pd.DataFrame({"queue": "q", "at": times, "message": texts})

    work = batching.Batches(7, 5.0)
    work.init(Handle())
    found = list(work.handleInputRows(("q",), frames(), None))
    assert len(found) > 20 and max(map(len, found)) < 40
    made = pd.concat(found)
    assert made["batch_no"].tolist() == list(range(n // 5 - 1))
    given = [(m["arrived"], m["message"]) for row in made["messages"] for m in row]
    assert given == [(i * 1_000_000, f"m{i * 1_000_000}" if i % 3 else None) for i in range(n - 5)]
    assert set(made["why"]) == {"age"} and len(work.held.get()) == 5

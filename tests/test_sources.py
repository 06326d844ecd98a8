import json
import types

from weftline.operators import segments
from weftline.sources import books
from weftline.streaming.mentions import running_counts


def test_books(spark, tmp_path):
    (tmp_path / "volume_1_toc.txt").write_text("a\nb")
    (tmp_path / "volume_2_toc.txt").write_text("c")
    own = books.lines(books.volumes(spark, f"{tmp_path}/volume_*.txt"))
    assert sorted(tuple(r) for r in own.collect()) == [(1, "toc", 0, "a"), (1, "toc", 1, "b"), (2, "toc", 0, "c")]
    books.write_lines(own, f"{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"{tmp_path}/out/volume=1/kind=toc").collect()] == ["a", "b"]
    assert [tuple(r) for r in books.volume_ranges(spark, {1: 3, 2: 10}, 30).orderBy("volume").collect()] == [(1, 3, 10), (2, 10, 30)]


def test_json(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"@a": {"Name": "A", "Alias_names": ["B", "A"]}}, indent=2))
    people = books.json_objects(spark, f"{tmp_path}/p.json", "struct<Name:string,Alias_names:array<string>>")
    assert sorted(tuple(r) for r in books.name_index(people).collect()) == [("A", "a"), ("B", "a")]


def _paged(spark, tmp_path, **options):
    from weftline.sources import pages

    (tmp_path / "doc.txt").write_text("\f".join(f"Page {i}\n\n  second\n line {i}" for i in range(9)) + "\f")
    spark.dataSource.register(pages.PagedDocuments)
    own = {"path": f"{tmp_path}/doc.txt", "opener": "weftline.sources.pages:text_file", "pages_per_task": "2", "volumes": "1:1-4,2:4-8"} | options
    return spark.read.format("paged").options(**own).load()


def test_paged_blocks_and_texts(spark, tmp_path):
    blocks = _paged(spark, tmp_path)
    rows = sorted(tuple(r) for r in blocks.collect())
    assert len(rows) == 14 and rows[1] == (1, 1, 1, 1.0, 2.0, 8.0, 4.0, "  second\n line 1", 0) and rows[-1][:3] == (2, 7, 1)
    texts = _paged(spark, tmp_path, content="text", first_page="3")
    assert sorted((r.volume, r.page, r.width, r.text[:6]) for r in texts.collect()) == [(1, 3, 8.0, "Page 3")] + [(2, i, 8.0, f"Page {i}") for i in range(4, 8)]


def test_filters_on_pages_and_volumes_are_pushed_down(spark, tmp_path):
    """Partitions hold no other pages than those that filters allow."""
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringContains

    from weftline.sources import pages

    name = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(name, "true")
    try:
        df = _paged(spark, tmp_path, pages_per_task="1", pushdown="true")
        wanted = {"page >= 3 AND page < 6": {3, 4, 5}, "volume = 2": {4, 5, 6, 7}, "page IN (1, 6) AND text LIKE 'Page%'": {1, 6}, "volume = 1 AND page > 2": {3}, "page = 99": set(), "page = 2 AND page = 3": set()}
        for condition, own in wanted.items():
            found = df.filter(condition)
            assert {r.page for r in found.collect()} == own
            assert found.rdd.getNumPartitions() <= max(1, len(own) + (6 - 1 - 1 if "IN" in condition else 0)), condition
    finally:
        spark.conf.unset(name)
    reader = pages.PagedReader({"path": f"{tmp_path}/doc.txt", "opener": "weftline.sources.pages:text_file", "pages_per_task": "5", "volumes": "1:0-4,2:4-9"})
    other = StringContains(("text",), "x")
    assert list(reader.taken([GreaterThan(("page",), 1), LessThanOrEqual(("page",), 6), other])) == [other]
    assert [(p.volume, p.first, p.end) for p in reader.partitions()] == [(1, 2, 4), (2, 4, 7)]
    assert list(reader.taken([EqualTo(("volume",), 2), In(("page",), (3, 5))])) == []
    assert [(p.volume, p.first, p.end) for p in reader.partitions()] == [(2, 4, 6)]
    assert {r[1] for r in reader.read(reader.partitions()[0])} == {5}


def test_an_object_in_parts(spark, tmp_path):
    import os

    from weftline.sources import json_object

    rows = [(f"@k{i:03d}", json.dumps({"Name": f"Nö {i}", "n": [i, {"x": None}]}, ensure_ascii=False)) for i in range(200)] + [('@"q', '{"Name": "a\\nb"}'), (None, "{}"), ("@null", None)]
    records = spark.createDataFrame(rows, "id string, record string").repartition(7)
    want = {k: json.loads(v) for k, v in rows if k and v}
    for pretty in (False, True):
        path = tmp_path / f"out-{pretty}"
        json_object.write(records, str(path), pretty, 5)
        names = sorted(os.listdir(path))
        assert not any(n.startswith("_") for n in names) and 2 < sum(n.endswith("-part") for n in names) <= 5
        whole = "".join((path / n).read_text() for n in names if not n.startswith("."))
        assert json.loads(whole) == want and list(json.loads(whole)) == sorted(want)
        if pretty:
            assert whole == json.dumps({k: want[k] for k in sorted(want)}, indent=2, ensure_ascii=False) + "\n"
    back = json_object.read(spark, f"{tmp_path}/out-False", "struct<Name:string>")
    assert {r.id: r.record.Name for r in back.collect()} == {k: v["Name"] for k, v in want.items()}
    json_object.write(records.filter("false"), f"{tmp_path}/none")
    assert json.loads("".join((tmp_path / "none" / n).read_text() for n in sorted(os.listdir(tmp_path / "none")) if not n.startswith("."))) == {}


def test_a_task_that_runs_twice_leaves_one_copy(tmp_path, monkeypatch):
    from weftline.sources import json_object

    monkeypatch.setattr(json_object.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 0))
    writer = json_object.ObjectWriter({"path": str(tmp_path / "o")})
    first = writer.write(iter([("@a", "{}"), ("@b", '{"x": 1}')]))
    again = writer.write(iter([("@a", "{}"), ("@b", '{"x": 1}')]))
    assert first.name != again.name
    writer.commit([again, None])
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "o").iterdir()))) == {"@a": {}, "@b": {"x": 1}}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Rama met Sita. Rama left.")
    stream = running_counts(spark.readStream.text(f"{tmp_path}/in").withColumnRenamed("value", "text"))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.word, r.n) for r in spark.table("counts").collect()} == {("Rama", 2), ("Sita", 1)}


def test_timeline_order(spark):
    events = spark.createDataFrame([("e1", 1, -3), ("e2", 2, -3), ("e3", 3, 0)], "id string, o int, y int")
    assert segments.steps_back(events.selectExpr("*", "0 AS k"), ["k"], ["o"], "y").count() == 0


def test_records_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    """Facts come in files in any order; the last row of each key counts."""
    import random

    from test_people import as_dict, frame, random_facts

    from weftline.operators import people as batch
    from weftline.streaming import people as stream

    facts = random_facts(random.Random(8), 120, 6)
    random.Random(9).shuffle(facts)
    for i in range(3):
        frame(spark, facts[i::3]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    seen = {}
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, stream.ROCKSDB)
    try:
        source = spark.readStream.schema(batch.FACT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        each = lambda df, _: seen.update(as_dict(df.collect()))
        q = stream.running_records(source).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None and not q.isActive
    finally:
        spark.conf.unset(name)
    assert seen == as_dict(batch.upserted(frame(spark, facts)).collect())

import os
import threading

from weftline.operators import graph, scan


def test_threads_have_scratches_of_their_own(spark, tmp_path, monkeypatch):
    """A table that one thread stores stays while another thread's scratch is closed."""
    monkeypatch.setattr(graph, "shared_folder", lambda _: f"file://{tmp_path}")
    stored, closed, seen = threading.Event(), threading.Event(), []

    def first():
        with graph.scratch(spark):
            stored.wait(60)
        closed.set()

    def second():
        with graph.scratch(spark) as keep:
            own = graph.stored(spark.range(5).toDF("x"), "own")
            stored.set()
            closed.wait(60)
            seen.append(own.count())
            seen.append(keep(own.filter("x > 2"), "kept").count())

    threads = [threading.Thread(target=f) for f in (first, second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert seen == [5, 2]
    assert [x.split("-")[0] for x in os.listdir(tmp_path)] == ["kept"]


def test_ranks_and_neighbours_as_by_windows(spark):
    rows = [(g, i * 7 % 50 if i % 9 else None, i % 6) for i in range(200) for g in (["a", None, "b", "a"][i % 4],)]
    df = spark.createDataFrame(rows, "g string, o long, v int")
    df.createOrReplaceTempView("rows_of_test")
    for group, by in ((["g"], "PARTITION BY g"), ([], "")):
        got = scan.ranked(df, group, ["o", "v"])
        want = spark.sql(f"SELECT g, o, v, row_number() OVER ({by} ORDER BY o, v) - 1, count(*) OVER ({by}) FROM rows_of_test")
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
        got = scan.with_previous(df, group, ["o", "v"], "v")
        want = spark.sql(f"SELECT g, o, v, lag(v) OVER ({by} ORDER BY o, v) FROM rows_of_test")
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert scan.ranked(df.filter("false"), ["g"], ["o"]).count() == 0
    plan = scan.with_previous(df, [], ["o"], "v")._jdf.queryExecution().toString()
    assert "RangePartitioning" not in plan  # the ranges are written

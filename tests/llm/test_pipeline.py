from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import decontamination, ngram_join, packing, quality_rules, toxicity

def test_stages_are_the_operators(spark, tmp_path):
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(6))
    prose = [" ".join(word() for _ in range(45)).capitalize() + "." for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(prose)] + [(100, prose[0]), (101, prose[1] + " extra"), (102, "### $$$ %%% " * 30), (103, None), (104, "see: " + prose[39])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose[39])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct()
    assert {r.doc_id for r in out.collect()} == set(range(39))
    labels, bench = spark.read.parquet(f"{tmp_path}/labels.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for f in (quality_rules.clean, lambda d: toxicity.clean(d, labels), ngram_join.clean, lambda d: decontamination.clean(d, bench)):
        step = f(step)
        assert step.columns == docs.columns
    assert packing.pack_documents(step).select(F.countDistinct("doc_id")).first()[0] == 39


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Null ids, repeated ids, copies in chains, empty and long texts, extra columns; each stage written out by hand."""
    import random

    from test_archives_and_urls import edit_distance_within

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    base = [prose(rng.choice([12, 19, 20, 40, 90])) for _ in range(30)]
    rows = list(enumerate(base)) + [(200, base[3] + " " + word()), (201, base[7]), (None, base[7]), (None, "short"), (5, prose(50)), (202, None), (203, ""), (204, "word again " * 3000), (205, base[9] + "\nHome\nHome"), (206, prose(30) + " " + base[11][:110] + " " + prose(10)), (None, prose(25) + " " + base[11])]
    bench = [(1, base[11]), (2, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, rules string, component_id string"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", "c") for i, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def kept_text(t):
        words = (t or "").split()
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)} if len(words) < 500 else set(range(len(words)))
        lines = list(dict.fromkeys(x for x in (t or "").split("\n") if x.strip()))
        good = [x for x in lines if x != "Home"]
        return "\n".join(good) if len(words) >= 20 and 100 * len(again) <= 30 * len(words) and 2 * sum(map(len, good)) >= sum(len(x) for x in (t or "").split("\n") if x.strip()) else None

    left = [(i, kept_text(t)) for i, t in rows]
    left = [(i, t) for i, t in left if t is not None]
    sets = [{tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in left]
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    by_id = [(i, t) for k, (i, t) in enumerate(left) if i is None or not any(j is not None and j < i and linked(sets[k], sets[m]) for m, (j, _) in enumerate(left))]
    fold = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    item = fold(base[11])
    windows = [item[k : k + 100] for k in range(max(1, len(item) - 99))]
    leaks = lambda t: any(edit_distance_within(w, fold(t)) <= int(len(w) * 0.08) for w in windows[:: max(1, len(windows) - 1)])
    wanted = [(i, t) for i, t in by_id if not leaks(t)]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    seen = {}
    for r in out:
        seen.setdefault(r.doc_id, []).append(r)
    ids_kept = {i for i, _ in wanted}
    assert set(seen) == ids_kept
    for i in ids_kept - {None}:
        own = sorted(seen[i], key=lambda r: r.start)
        assert own[0].start == 0 and own[-1].start + own[-1].length == own[0].doc_tokens
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "n-gram Jaccard join", "benchmark decontamination", "packing"]

import random

from pyspark.sql import functions as F

from weftline.operators import assemble, docparse, entities, extract, footnotes, fuzzy, graph, mentions, search, segments, validate


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def sequence(spark, numbers, name="d"):
    return spark.createDataFrame([("v", i, n) for i, n in enumerate(numbers)], f"v string, i int, {name} int")


def looped_runs(numbers, threshold):
    out, run, top, open_ = [], 0, 0, False
    for d in numbers:
        if d == 1 and top >= threshold and open_:
            run, top, open_ = run + 1, 0, False
        out.append(run)
        top, open_ = max(top, d), True
    return out


def test_runs_of_the_fixture(spark):
    numbers = [*range(1, 13), *range(1, 6), *range(1, 12), 1, 2]
    got = [r.run for r in segments.runs(sequence(spark, numbers), ["v"], ["i"], "d", 10).orderBy("i").collect()]
    assert got == [0] * 12 + [1] * 16 + [2] * 2


def test_runs_equal_a_loop(spark):
    random.seed(5)
    cases = [[random.choice([1, 1, 2, 3, 5, 7, 9]) for _ in range(random.randint(1, 25))] for _ in range(60)]
    df = spark.createDataFrame([(k, i, d) for k, case in enumerate(cases) for i, d in enumerate(case)], "v int, i int, d int")
    got = {(r.v, r.i): r.run for r in segments.runs(df, ["v"], ["i"], "d", 5).collect()}
    assert got == {(k, i): run for k, case in enumerate(cases) for i, run in enumerate(looped_runs(case, 5))}


def test_ref_runs(spark):
    groups = spark.createDataFrame([("v", 0, 1, 6), ("v", 1, 7, 12), ("v", 2, None, None), ("v", 3, 1, 4), ("v", 4, 5, 5)], "v string, i int, low int, high int")
    got = [r.run for r in segments.ref_runs(groups, ["v"], ["i"], "low", "high", 10).orderBy("i").collect()]
    assert got == [0, 0, 0, 1, 1]


def test_best_threshold(spark):
    numbers = sequence(spark, [1, 2, 3, 1, 2, 3, 4])
    groups = spark.createDataFrame([("v", 0, 1, 3), ("v", 1, 1, 4)], "v string, i int, low int, high int")
    assert rows(segments.best_threshold(numbers, groups, ["v"], "d", ["i"], "low", "high", ["i"])) == [("v", 2, 2, 2)]


def test_order_checks(spark):
    years = sequence(spark, [-3, -1, -2, 0], "y")
    assert [r.i for r in segments.steps_back(years, ["v"], ["i"], "y").collect()] == [2]
    assert [r.i for r in segments.out_of_order(sequence(spark, [1, 2, 4]), ["v"], ["i"], "d").collect()] == [2]


def test_before_repeat_and_zip(spark):
    marks = spark.createDataFrame([("v", 0, "1(1)"), ("v", 1, None), ("v", 2, "2(2)"), ("v", 3, "1(1)"), ("v", 4, "9(9)")], "v string, i int, c string")
    assert [r.i for r in segments.before_repeat(marks, ["v"], ["i"], "c").orderBy("i").collect()] == [0, 1, 2]
    left = spark.createDataFrame([("v", i) for i in range(3)], "v string, i int")
    right = spark.createDataFrame([("v", 4), ("v", 5)], "v string, c int")
    assert [r.c for r in segments.positional_zip(left, right, ["v"], ["i"], ["c"]).orderBy("i").collect()] == [4, 5, None]


def test_headers(spark):
    lines = spark.createDataFrame([("v", 0, "1 a"), ("v", 1, "2 b"), ("v", 2, "1 c")], "v string, ord int, line string")
    heads = spark.createDataFrame([("v", 0, "--- 1..2 ---"), ("v", 2, "--- 3 ---")], "v string, start int, header string")
    got = [r.line for r in segments.with_headers(lines, heads, ["v"], "ord", "line").orderBy("ord").collect()]
    assert got == ["", "--- 1..2 ---", "1 a", "2 b", "", "--- 3 ---", "1 c"]


def test_footnotes(spark):
    refs = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "run int, n int")
    defs = spark.createDataFrame([(0, 1), (0, 3), (0, 3)], "run int, n int")
    assert rows(footnotes.unmatched(refs, defs, ["run", "n"])) == [(0, 2)]
    got = footnotes.verified(refs.withColumn("v", F.lit(1)), defs, ["run", "n"], "v").filter("v = 1").first()
    assert (got.n_refs, got.n_matched, got.all_ok, got.share) == (3, 2, False, "66.7%")
    assert [r.run for r in footnotes.clamped_runs(spark.createDataFrame([(1, 5)], "v int, run int"), spark.createDataFrame([(1, 0), (1, 2)], "v int, run int"), ["v"]).collect()] == [2]


def test_entities(spark):
    facts = spark.createDataFrame([("k", 1, "A", "X", ["p"]), ("k", 2, "B", "Y", ["q", "p"]), ("k", 3, "", None, None)], "key string, o int, father string, duty string, skills array<string>")
    got = entities.fold(facts, "key", "o", first=["duty"], last=["father"], lists=["skills"]).first()
    assert (got.duty, got.father, got.skills) == ("X", "B", ["p", "q"])
    aliases = spark.createDataFrame([("Vasu", "a", 1), ("Vasu", "b", 2), ("C", "c", 3)], "alias string, key string, o int")
    mapping = entities.alias_map(aliases, "alias", "key", "o")
    assert rows(mapping) == [("vasu", "b")]
    assert rows(entities.resolved(spark.createDataFrame([("Vasu",), ("New One",)], "n string"), "n", mapping)) == [("New One", "new_one"), ("Vasu", "b")]
    nodes = spark.createDataFrame([("old", 1, "Duty"), ("new", 2, ""), ("x", 3, "D")], "key string, ord int, duty string")
    edges = spark.createDataFrame([("old", "x"), ("new", "x"), ("old", "new")], "src string, dst string")
    rules = spark.createDataFrame([("old", "new"), ("gone", "new"), ("x", "nowhere")], "old_key string, new_key string")
    merged, moved = entities.merged(nodes, edges, rules, first=["duty"])
    assert rows(merged) == [("new", "Duty"), ("x", "D")] and rows(moved.select("src", "dst")) == [("new", "x")]
    genders = spark.createDataFrame([("k", "Unknown", 1), ("k", "Female", 2), ("k", "Male", 3), ("u", None, 1)], "key string, gender string, o int")
    assert rows(entities.with_gender(genders, "key", "gender", "o")) == [("k", "Female"), ("u", "Unknown")]
    own = spark.createDataFrame([(["Kuru", "Kurus", "Das"],)], "a array<string>")
    assert own.select(entities.plural_aliases_removed(F.col("a"))).first()[0] == ["Kuru", "Das"]


def test_graph(spark):
    parents = spark.createDataFrame([("a", "b", "father", 1), ("b", "a", "father", 2), ("c", "a", "mother", 3)], "child string, parent string, role string, ord int")
    assert rows(graph.without_circles(parents).select("child", "parent")) == [("a", "b"), ("c", "a")]
    spouses = graph.symmetric(spark.createDataFrame([("a", "c"), ("x", "y"), ("z", "z")], "p string, q string"), "p", "q")
    assert rows(graph.not_parental(spouses, parents).select("a", "b")) == [("x", "y"), ("y", "x")]
    edges = spark.createDataFrame([("c1", "k"), ("c1", "s1"), ("c2", "k")], "child string, parent string")
    married = spark.createDataFrame([("k", "s1"), ("k", "s2")], "a string, b string")
    assert [tuple(r) for r in graph.attributed_children(edges, married).filter("parent = 'k'").select("child", "spouse").orderBy("child").collect()] == [("c1", "s1"), ("c2", None)]
    fathers = spark.createDataFrame([("c", "f"), ("f", "g"), ("g", "h"), ("h", None)], "key string, father string")
    assert ("c", "g", "h") in rows(graph.lineage(fathers).fillna(""))
    assert rows(graph.roots(fathers, "key", "father")) == [("c", "h"), ("f", "h"), ("g", "h"), ("h", "h")]


def test_components_equal_union_find(spark):
    random.seed(2)
    links = [(random.randint(0, 60), random.randint(0, 60)) for _ in range(45)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    wanted = sorted((x, find(x)) for x in root if any(x in e and e[0] != e[1] for e in links))
    assert rows(graph.components(spark.createDataFrame(links, "a long, b long"))) == wanted


def test_fuzzy(spark):
    words = spark.createDataFrame([("Arjuna", 9), ("Arjunas", 1), ("Krishna", 5), ("Krisha", 1), ("Krishnaa", 1), ("Bhima", 1), ("Bhime", 1)], "w string, n int")
    assert rows(fuzzy.spelling_pairs(words, "w", "n").select("a", "b")) == [("Arjuna", "Arjunas"), ("Krisha", "Krishna"), ("Krishna", "Krishnaa")]
    assert rows(fuzzy.variant_parents(words, "w").filter("parent IS NOT NULL")) == [("Arjunas", "Arjuna"), ("Krishnaa", "Krishna")]
    gate = spark.createDataFrame([("Duryodha", "Duryodhana", 2, 25), ("Karna", "Karnas", 5, 25)], "a string, b string, n_a int, n_b int")
    assert {r.id for r in fuzzy.spelling_clusters(gate).collect()} == {"Duryodha", "Duryodhana"}


def test_spelling_pairs_equal_all_pairs(spark):
    random.seed(4)
    words = sorted({"".join(random.choice("AB")) + "".join(random.choice("ab") for _ in range(random.randint(3, 7))) for _ in range(120)})
    got = rows(fuzzy.spelling_pairs(spark.createDataFrame([(w, 5) for w in words], "w string, n int"), "w", "n").select("a", "b"))
    df = spark.createDataFrame([(w,) for w in words if len(w) >= 5], "a string")
    every = df.crossJoin(df.withColumnRenamed("a", "b")).filter("a < b AND substr(a, 1, 1) = substr(b, 1, 1) AND levenshtein(a, b) = 1")
    assert got == rows(every)


def test_extract(spark):
    text = "Karna, the son of Surya, met Pandu’s wife, Madri. Arjuna’s brother Bhima spoke. " + "O Partha! " * 5 + "O Kunti! " * 4 + "‘Vyasa said, Sage Vyasa, King Drupada, the king of Panchala."
    df = spark.createDataFrame([(1, text)], "v int, t string")
    found = extract.facts(df, extract.CHAPTER_RELATIONS, "t", "v")
    assert rows(extract.parents(found, ("v",))) == [("karna", "father", "surya")]
    assert rows(extract.spouses(found)) == [("madri", "pandu", "Husband"), ("pandu", "madri", "Wife")]
    names = extract.frequent_names(df, "t")
    assert {(r.rule, r.word) for r in names.collect()} >= {("vocative", "Partha"), ("speech", "Vyasa")}
    assert not names.filter("rule = 'vocative' AND word = 'Kunti'").count()
    assert rows(extract.duties(df, "t")) == [("Drupada", "King", "Kshatriya"), ("Vyasa", "Sage", "Brahmin")]
    assert ("Drupada", "Panchala") in rows(extract.dynasties(df, "t", "v"))
    genders = extract.title_genders(spark.createDataFrame([("Queen Kuntibai came",)], "t string"), "t", spark.createDataFrame([("Kunti",), ("Rama",)], "word string"))
    assert rows(genders) == [("Kunti", "Female"), ("Rama", "Male")]


def test_notes(spark):
    df = spark.createDataFrame([(1, "1 Draupadi. She was\nwife of Pandava.\n2 Abhi is also known as Manyu.\n3 Bharata was the son of Shakuntala.")], "volume int, t string")
    entries = extract.note_entries(df, "volume", "t")
    assert [(r.n, r.body) for r in entries.orderBy("entry").collect()][0] == (1, "Draupadi. She was wife of Pandava.")
    assert {tuple(r) for r in extract.note_names(entries).select("name", "gender").collect()} >= {("Draupadi", "Female"), ("Pandava", None)}
    assert rows(extract.aka(entries).select("a", "b")) == [("Abhi", "Manyu")]
    found = extract.facts(entries, extract.NOTE_RELATIONS, "body", "volume", "entry")
    assert rows(extract.parents(found, ("volume", "entry"))) == [("bharata", "father", "shakuntala")]
    marked = spark.createDataFrame([(1, "x --- Chapter 4(12) --- one{3} two{14} --- Chapter 5 --- three")], "v int, t string")
    own = extract.chapters(marked, "v", "t")
    assert [(r.chapter, r.content.strip()) for r in own.orderBy("ord").collect()] == [(4, "one{3} two{14}"), (5, "three")]
    assert [r.n for r in extract.note_refs(own, "content", "chapter").orderBy("n").collect()] == [3, 14]


BLOCKS = "volume int, page int, block_no int, x0 double, y0 double, text string, type int"


def test_paragraphs(spark):
    texts = [("before", 50.0, "Lost? no, kept."), ("s", 50.0, "Section One"), ("p", 50.0, "Adi Parva"), ("c", 300.0, "1 (1)"), ("a", 50.0, "He conquer-\ned all"), ("b", 50.0, "foes. Then"), ("d", 50.0, "Rest came."), ("e", 50.0, "New one."), ("h", 50.0, "The Chronicle 12"), ("c2", 300.0, "2 (2)"), ("f", 50.0, "End-"), ("g", 50.0, "ing.")]
    blocks = spark.createDataFrame([(1, 1, i, x, 100.0 * i, t, 0) for i, (_, x, t) in enumerate(texts)], BLOCKS)
    out = docparse.paragraphs(docparse.body_blocks(blocks, "chronicle")).orderBy("ord").collect()
    assert [(r.marker, r.text) for r in out] == [(None, "Lost? no, kept."), ("1(1)", None), (None, "He conquered all foes. Then Rest came."), (None, "New one."), ("2(2)", None), (None, "Ending.")]
    clean = docparse.cleaned(docparse.paragraphs(docparse.body_blocks(blocks, "chronicle"))).orderBy("ord").collect()
    assert [r.marker for r in clean] == ["1(1)", None, None, "2(2)", None]


def test_drop_caps(spark):
    blocks = spark.createDataFrame([(1, 1, 0, 50.0, 10.0, "T", 0), (1, 1, 1, 60.0, 20.0, "he king", 0), (1, 1, 2, 60.0, 200.0, "other", 0)], BLOCKS)
    assert [r.text for r in docparse.with_drop_caps(blocks).orderBy("ord").collect()] == ["The king", "other"]


def test_notes_numbering(spark):
    lines = ["Footnotes", "Chapter 1", "1 First one. 2 Second here", "goes on", "3 Third", "900 years later", "1 Again", "Chapter 9"]
    blocks = spark.createDataFrame([(1, 5, i, 0.0, float(i), t, 0) for i, t in enumerate(lines)], BLOCKS)
    pages = spark.createDataFrame([(1, 5, "\n".join(lines))], "volume int, page int, text string")
    got = [r.line for r in docparse.notes(docparse.notes_lines(blocks, pages, "chronicle")).orderBy("ord").collect()]
    assert got == ["--- Chapter 1 ---", "1 First one.", "2 Second here goes on", "3 Third 900 years later", "--- Chapter 9 ---", "1 Again"]


def test_page_search(spark):
    pages = spark.createDataFrame([(1, 0, 0, "Contents"), (1, 4, 0, "Chapter 1(1): 20 shlokas"), (2, 100, 100, "x"), (2, 101, 100, "Section Two")], "volume int, page int, start_page int, text string")
    assert rows(docparse.content_start(pages)) == [(1, 4), (2, 101)]
    notes = spark.createDataFrame([("1 Ab\n2 Cd\n3 Ef",), ("Footnotes",), ("Section A\n1 x\n2 y",), ("He went\n1 x",)], "t string")
    assert [r[0] for r in notes.select(docparse.is_notes_page(F.col("t"))).collect()] == [True, True, True, False]
    blocks = spark.createDataFrame([(1, 9, 0, 0.0, 0.0, "Acknowledgements", 0, 5), (1, 3, 0, 0.0, 0.0, "Acknowledgements", 0, 5)], BLOCKS + ", middle_page int")
    assert rows(docparse.acknowledgements(blocks)) == [(1, 9)]
    assert [r.kind for r in docparse.contents(pages).orderBy("page").collect()] == ["chapter", "section"]


def test_checks(spark):
    events = spark.createDataFrame([("e1", 1, -3, ["@a", "b"]), ("e2", 3, -5, ["@zz"])], "id string, o int, y int, who array<string>")
    people = spark.createDataFrame([("a",)], "key string")
    found = [validate.missing_refs("who", events, "id", "who", people, "key"), validate.not_continuous("order", events, "id", "o", "o"), validate.not_monotonic("year", events, "id", "o", "y")]
    assert rows(found[0]) == [("who", "e2", "@zz")]
    assert rows(validate.summary(spark, found, ["who", "order", "year", "none"])) == [("none", 0, True), ("order", 1, False), ("who", 1, False), ("year", 1, False)]


def test_search_and_assembly(spark):
    places = spark.createDataFrame([("Dark Forest", "x", 1.0, 2.0), ("Town", None, 29.16, 78.018)], "name string, type string, lat double, lng double")
    assert [r.name for r in search.search(places, " FOREST ", ["name", "type"]).collect()] == ["Dark Forest"]
    assert search.search(places, "  ", ["name"]).count() == 0
    assert search.popup(places, "lat", "lng").filter("name = 'Town'").first().position == "29.16°N, 78.02°E"
    people = spark.createDataFrame([("a", "A", ""), ("b", "B", "King")], "key string, Name string, Duty string").withColumn("Duty", F.nullif("Duty", F.lit("")))
    assert assemble.one_object(assemble.as_json(people, "key")).first().json == '{"@a": {"Name":"A"}, "@b": {"Name":"B","Duty":"King"}}'
    docs = assemble.characters(people, graph.children(spark.createDataFrame([("b", "a")], "child string, parent string")), spark.createDataFrame([], "key string, grandfather string, great_grandfather string"), ["Name", "Duty"])
    assert docs.filter("key = 'a'").first().children == ["b"]
    seen = spark.createDataFrame([("Rama", 1, 7), ("Rama", 1, 3), ("Rama", 1, 3), ("Rama", 2, 1)], "word string, v int, c int")
    assert rows(mentions.appearances(seen, "word", "v", "c")) == [("Rama", 4, "Vol1:ch3,7 Vol2:ch1")]


def test_roots_of_cycles(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "e2"), ("e2", None), ("x", "x")], "key string, parent string")
    assert rows(graph.roots(df)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("e", "e2"), ("e2", "e2"), ("x", "x")]


def test_scratch_tables_are_removed(spark):
    with graph.scratch(spark) as keep:
        gone = graph.stored(spark.range(3), "gone").inputFiles()[0]
        kept = keep(spark.range(2), "kept")
    import os

    assert kept.count() == 2 and not os.path.exists(gone.removeprefix("file:").replace("///", "/"))


def test_nearby_equals_all_pairs(spark):
    random.seed(6)
    points = [(i, random.choice([0, 40, 70, 88]) + random.random() * 2 - 1, random.choice([-179.9, 0.0, 100.0, 179.5]) + random.random() * 12 - 6) for i in range(120)]
    df = spark.createDataFrame(points, "k long, lat double, lng double")
    got = {(r.a, r.b) for r in assemble.nearby(df, "k", "lat", "lng", 300).collect()}
    both = df.crossJoin(df.toDF("j", "lat2", "lng2")).filter("k <> j")
    from weftline.functions import geo

    near = both.filter(geo.haversine_km(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2")) <= 300)
    assert got == {(r.k, r.j) for r in near.collect()} and got
    lists = assemble.nearby_lists(spark.createDataFrame([(1, 2, 9), (1, 3, 4), (1, 4, 9)], "a long, b long, km long"), spark.createDataFrame([(2, 2), (3, 1), (4, 0)], "key long, ord long"))
    assert [(x.other, x.km) for x in lists.first().neighbours] == [(3, 4), (4, 9), (2, 9)]


def test_members_keys_and_groups(spark):
    index = spark.createDataFrame([("Rama", "r1", 2), ("Rama", "r0", 1), ("Raghava", "r9", 3)], "word string, id string, ord int")
    members = spark.createDataFrame([("m", ["Unknown", "Raghava", "Rama"]), ("n", ["Rama"]), ("o", [])], "key string, names array<string>")
    assert rows(entities.first_known(members, index, "key", "names").fillna("")) == [("m", "r9"), ("n", "r0"), ("o", "")]
    assert rows(entities.keyed(spark.createDataFrame([("Rama",), ("X",)], "word string"), index).select("id")) == [("r0",), ("r1",)]
    counted = spark.createDataFrame([("Arjuna", 9), ("Arjunas", 1), ("Krishna", 5), ("Krishnaa", 7), ("Bhima", 1)], "word string, n long")
    forest = graph.roots(fuzzy.variant_parents(counted, "word"), "word", "parent").withColumnRenamed("key", "word")
    assert [(r.root, r.n_total, [tuple(v) for v in r.variants]) for r in fuzzy.variant_totals(counted, forest).orderBy("root").collect()] == [("Arjuna", 10, [("Arjuna", 9), ("Arjunas", 1)]), ("Krishna", 12, [("Krishnaa", 7), ("Krishna", 5)])]
    assert rows(fuzzy.english_words(spark.createDataFrame([("Swiftly",), ("Karna",), ("Moon",)], "w string"), "w", spark.createDataFrame([("moon",)], "word string"))) == [("Moon",), ("Swiftly",)]
    assert rows(search.type_counts(spark.createDataFrame([("City",), ("Village",), ("River",)], "t string"), "t", {"City": "settlement", "Village": "settlement"})) == [("River", 1), ("settlement", 2)]


def test_paragraphs_after_markers(spark):
    body = spark.createDataFrame([(1, 1, "ends with-", None), (1, 2, "4", "4"), (1, 3, "small letter first", None)], "volume int, seq int, raw string, marker string")
    assert [(r.marker, r.text) for r in docparse.paragraphs(body).orderBy("ord").collect()] == [(None, "ends with-"), ("4", None), (None, "small letter first")]


def test_notes_with_headings(spark):
    texts = ["Chapter 1", "1 First", "Adi Parva", "still first", "Section II", "loose words", "2 Second. 3 Third", "4 is bare", "99 years", "1 Anew", "Chapter 2", "Footnotes", "7 Seven", "7a on", "8 Eight"]
    lines = spark.createDataFrame([(1, i, t, t) for i, t in enumerate(texts)], "volume int, seq int, whole string, line string")
    got = [r.line for r in docparse.notes(lines).orderBy("ord").collect()]
    assert got == ["--- Chapter 1 ---", "[Adi Parva]", "1 First still first", "", "[Section II]", "loose words", "2 Second.", "3 Third", "4 is bare 99 years", "--- Chapter 2 ---", "1 Anew", "7 Seven", "7a on", "8 Eight"]


def test_nearby_of_shared_places(spark):
    random.seed(7)
    spots = [(random.uniform(10, 20), random.uniform(70, 80)) for _ in range(9)]
    points = [(i, *spots[0 if i < 600 else random.randrange(9)]) for i in range(700)] + [(None, *spots[0]), (900, None, 71.0)]
    df = spark.createDataFrame(points, "k long, lat double, lng double")
    from weftline.functions import geo

    near = df.crossJoin(df.toDF("j", "lat2", "lng2")).filter("k <> j").withColumn("km", geo.haversine_km(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2"))).filter("km <= 400")
    want = sorted((r.k, r.j, r.km) for r in near.select("k", "j", geo.rounded_km(F.col("km")).alias("km")).collect())
    pairs = assemble.nearby(df, "k", "lat", "lng", 400)
    assert sorted((r.a, r.b, r.km) for r in pairs.collect()) == want and len(want) > 600 * 599
    # pairs of one cell are dealt out to several tasks, with and without lists
    sizes = [n for (n,) in pairs.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) > 3 and max(sizes) < len(want) * 0.6
    lists = assemble.nearby_of_places(df, "k", "lat", "lng", 400, -F.col("k")).collect()
    assert max(len(r["keys"]) for r in lists) == assemble.BLOCK
    got = {k: [(x.km, -x.other) for x in r["neighbours"] if x.other != k] for r in lists for k in r["keys"]}
    assert all(x == sorted(x) for x in got.values())
    assert sorted((k, -o, km) for k, x in got.items() for km, o in x) == want


def test_texts_of_keys_are_dealt_out(spark, tmp_path):
    from weftline.plans import books

    spark.range(300).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for texts in (books._chapters(spark, tmp_path), books._notes(spark, tmp_path)):
        sizes = [n for (n,) in texts.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 300 and len(sizes) > 8 and max(sizes) < 60


def test_many_short_stretches_are_scanned_as_rows(spark):
    texts = ["Chapter 1", "1 First", "2 Second. 3 Third", "Chapter 2", "on", "7 Seven", "8 Eight"]
    n = 400
    lines = spark.range(n).select(F.col("id").cast("int").alias("volume"), F.posexplode(F.array(*map(F.lit, texts)))).select("volume", F.col("pos").alias("seq"), F.col("col").alias("whole"), F.col("col").alias("line"))
    parts = docparse.note_parts(lines.repartition(7, F.rand(3)))
    assert "FlatMapGroupsInPandas" not in parts._jdf.queryExecution().executedPlan().toString()  # a frame for each stretch
    want = [(1, 0, "note", False, "1 First"), (2, 0, "note", False, "2 Second."), (2, 1, "note", False, "3 Third"), (4, 0, "loose", False, "on"), (5, 0, "note", False, "7 Seven"), (6, 0, "note", False, "8 Eight")]
    got = {}
    for r in parts.collect():
        got.setdefault(r.volume, []).append((r.seq, r.part, r.kind, r.again, r.text))
    assert len(got) == n and all(sorted(x) == want for x in got.values())

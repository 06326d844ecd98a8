"""Boundaries, entries and documents against plain loops over random data."""

import random
import re
import time

from pyspark.sql import functions as F

from weftline.operators import docparse, documents, mentions, people, records, segments

PAGES = (
    "Section One\nx", "x\n Chapter 3(4): y", "Acknowledgements\nto all", "a\nb\nc\nAcknowledgements", "Footnotes", "Footnotes\n1 a\n2 b\n3 c", "Section 4\n1 x\n22x", "Section 4\n1 x",
    "1 a\n2 b\n3 c\nz\nz\nz", "1 a\n2 b\n3 c\nz\nz\nz\nz", "1 a\n2 b", "words", "", None,
)


def boundaries(pages, start, end):
    """What a reader with a finger on the pages finds."""
    lines = {p: [" ".join(x.split()) for x in (pages[p] or "").split("\n") if x.strip()] for p in range(start, end)}
    content = next((p for p in range(start, end) if any(re.match(r"Section\s+[A-Z][a-z]", x) for x in lines[p])), None)
    if content is None:
        content = next((p for p in range(start, min(start + 50, end)) if any(re.match(r"Chapter\s+\d+\(\d+\)\s*:", x) for x in lines[p])), start + 15)
    ack = next((p for p in range(start + (end - start) // 2, end) if any(re.fullmatch("Acknowledgements?", x) for x in lines[p][:3])), None)

    def notes(first, last):
        for p in range(first, last):
            own = lines.get(p) or []
            if not own:
                continue
            numbered = sum(bool(re.match(r"\d+\s*[A-Za-z]", x)) for x in own)
            if own[0] == "Footnotes" or (re.match(r"Section\s+", own[0]) and sum(bool(re.match(r"\d+\s*\S", x)) for x in own) >= 2) or (numbered >= 3 and numbered >= len(own) / 2):
                return p + (len(own) <= 3 and any("Footnotes" in x for x in own))
        return None

    if ack is None:
        at = notes(end - max(1, (end - start) // 5), end)
    else:
        at = notes(ack + 1, end)
        if at is None:
            at = notes(max(content, ack - (end - start) // 2), ack)
    return content, ack, at, min(x for x in (end, ack, at) if x is not None)


def test_boundaries(spark):
    rng = random.Random(3)
    pages, volumes, want = [], [], {}
    for v in range(150):
        start, size = rng.randint(1, 9), rng.randint(1, 30)
        few = rng.sample(PAGES, rng.randint(1, 3)) + ["words"] * rng.randint(5, 40)
        own = {p: rng.choice(few) for p in range(start - 1, start + size + 2)}
        if v % 3:
            own[start + rng.randrange(size // 2, size)] = PAGES[2]
        own[start + rng.randrange(size)] = rng.choice(PAGES[4:9])
        pages += [(v, p, t) for p, t in own.items()]
        volumes.append((v, start, start + size))
        want[v] = boundaries(own, start, start + size)
    own = spark.createDataFrame(pages, "volume int, page int, text string")
    blocks = spark.createDataFrame([(v, p, i, 0, x) for v, p, t in pages if t is not None for i, x in enumerate(t.split("\n"))], "volume int, page int, block_no int, type int, text string")
    out = docparse.boundaries(own, blocks, spark.createDataFrame(volumes, "volume int, start_page int, end_page int")).collect()
    assert {r.volume: (r.content_start, r.ack_page, r.notes_start, r.body_end) for r in out} == want and len(out) == 150
    # all three searches find something, and the shift happens
    assert sum(a is not None and n is not None and n > a for _, a, n, _ in want.values()) > 5 and sum(a is not None and n is not None and n < a for _, a, n, _ in want.values()) > 5
    assert sum(a is None and n is not None for _, a, n, _ in want.values()) > 5
    assert docparse.boundaries(own.filter("false"), blocks.filter("false"), spark.createDataFrame([(1, 4, 9)], "volume int, start_page int, end_page int")).collect() == [(1, 19, None, None, 9)]


def near(a, b):
    """One edit apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def entries(counts, index):
    def parent(w):
        if w[-1] == "s" and w[:-1] in counts:
            return w[:-1]
        return w[:-1] if w[-2:] in ("aa", "ee", "ii", "oo", "uu") and w[:-1] in counts else None

    root = {}
    for w in counts:
        at = w
        while parent(at):
            at = parent(at)
        root[w] = at
    total = {}
    for w, r in root.items():
        total[r] = total.get(r, 0) + counts[w]
    up = {r: r for r in total}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in total:
        for b in total:
            rare = min(a, b, key=lambda x: total[x])
            if a < b and a[0] == b[0] and min(len(a), len(b)) >= 5 and near(a, b) and min(total[a], total[b]) <= 3 and max(total[a], total[b]) >= 20 and len(rare) >= 7:
                up[find(b)] = find(a)
    clusters = {}
    for w in counts:
        clusters.setdefault(find(root[w]), []).append(w)
    out = {}
    for words in clusters.values():
        best = min({root[w] for w in words}, key=lambda r: (-total[r], r))
        found = None
        for w in [best, *sorted(set(words) - {best})]:
            hits = [(not is_name, ord, id) for x, id, is_name, ord in index if x == w]
            if hits:
                found = min(hits)[2]
                break
        e = out.setdefault(found or best.lower(), {"best": [], "words": set(), "n": 0})
        e["best"].append((-sum(counts[w] for w in words), best))
        e["words"] |= set(words)
        e["n"] += sum(counts[w] for w in words)
    got = {}
    for key, e in out.items():
        names = sorted((ord, x) for x, id, is_name, ord in index if id == key and is_name)
        name = names[0][1] if names else min(e["best"])[1]
        words = e["words"] | {x for x, id, _, _ in index if id == key}
        got[key] = (name, [w for w in sorted(words - {name}) if not (w[-1] == "s" and w[:-1] in words | {name})], e["n"], len(e["best"]), bool(names))
    return got


def test_entries(spark):
    rng = random.Random(11)
    stems = ["".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(4)).capitalize() for _ in range(25)]
    counts = {}
    for s in stems:
        counts[s] = rng.choice((1, 2, 25, 30, 30))
        for _ in range(rng.randint(0, 5)):
            i = rng.randint(1, 7)
            w = rng.choice((s + "s", s + s[-1], s + s[-1] + "s", s[:i] + rng.choice("xyz") + s[i + 1 :], s[:i] + s[i + 1 :]))
            counts.setdefault(w, rng.choice((1, 2, 3, 4, 21)))
    words = sorted(counts)
    index = [(rng.choice(words), f"r{i % 9}", i < 9, i // 2) for i in range(30)] + [("Elsewhere", "r3", False, 1), (stems[0].lower(), stems[1].lower(), False, 0)]
    clusters = records.clustered(spark.createDataFrame(sorted(counts.items()), "word string, n long"))
    table = spark.createDataFrame(index, "word string, id string, is_name boolean, ord long")
    got = {r.key: (r.name, r.alias_names, r.n, r.n_clusters, r.known) for r in records.entries(clusters, table).collect()}
    assert got == entries(counts, index)
    assert any(x[3] > 1 for x in got.values()) and any(x[3] == 1 and not x[4] and x[1] for x in got.values())
    assert records.entries(clusters.filter("false"), table).count() == 0
    assert records.entries(clusters, table.filter("false")).filter("known").count() == 0


def document(key, people_, events):
    """The nested fields of one person."""
    me = people_[key]
    kids = [(k, c["mother"] if c["father"] == key else c["father"]) for k, c in people_.items() if key in (c["father"], c["mother"])]
    wed = [s for s, _ in me["spouses"]]
    spouse = []
    for i, (s, rel) in enumerate(me["spouses"]):
        if s not in wed[:i]:
            gender = people_[s]["gender"] if s in people_ else "Unknown"
            spouse.append(("@" + s, rel or {"Female": "Wife", "Male": "Husband"}.get(gender, "Spouse"), ["@" + k for k, o in kids if o == s]))
    rest = ["@" + k for k, o in kids if o not in wed]
    line = None
    if me["father"] in people_ and people_[me["father"]]["father"] in people_:
        gf = people_[me["father"]]["father"]
        ggf = people_[gf]["father"]
        line = ("@" + gf, "@" + ggf if ggf in people_ else None)
    return spouse or None, rest or None, line, ["@" + e for _, e in sorted((o, e) for k, o, e in events if k == key)] or None


def test_documents(spark):
    rng = random.Random(4)
    keys = [f"k{i:02}" for i in range(40)]
    some = lambda p: rng.choice([*keys, "gone"]) if rng.random() < p else None
    own = {
        k: {"name": k.upper(), "gender": rng.choice(("Male", "Female", "Unknown")), "father": some(0.6), "mother": some(0.6), "aliases": rng.sample(["b", "a", "Z"], rng.randint(0, 3)),
            "spouses": [(rng.choice([*keys, "gone"]), rng.choice((None, "", "Wife", "Friend"))) for _ in range(rng.randint(0, 4))], "kingdom": rng.choice((None, "", "kuru")), "skills": rng.choice((None, [], ["bow"]))}
        for k in keys
    }
    # the child of two of the same spouses' keys, and a key that events alone know
    for k in keys[:12]:
        if own[k]["father"] in own and own[k]["mother"]:
            own[own[k]["father"]]["spouses"].append((own[k]["mother"], None))
    events = [(rng.choice([*keys, "nobody"]), rng.randint(0, 5), f"e{i}") for i in range(60)]
    records_ = spark.createDataFrame([{"key": k, **{c: v for c, v in x.items() if c != "spouses"}, "spouses": [{"key": a, "relation": b} for a, b in x["spouses"]]} for k, x in own.items()], people.RECORD)
    docs = documents.documents(records_, spark.createDataFrame(events, "key string, ord int, event string"))
    out, row = documents.read_figures(docs)
    got = {r.key: r for r in out.collect()}
    assert set(got) == set(own)
    for k, r in got.items():
        spouse = r.spouse and [tuple(s) for s in r.spouse]
        assert (spouse, r.children, r.lineage and tuple(r.lineage), r.major_events) == document(k, own, events), k
        assert (r.alias_names, r.kingdom, r.skills) == (sorted(own[k]["aliases"]), "@kuru" if own[k]["kingdom"] else None, own[k]["skills"] or None)
    figures = row.collect()[0].asDict()
    assert len(figures) == 20 and figures["total"] == 40 and figures["males"] + figures["females"] + figures["unknowns"] == 40
    assert figures["with_spouse"] == sum(r.spouse is not None for r in got.values()) and figures["with_kingdom"] == sum(r.kingdom is not None for r in got.values())
    assert figures["with_children"] == sum(bool(r.children or any(s.children for s in r.spouse or [])) for r in got.values())
    # one aggregation by key brings all parts together
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Aggregate [key" in x and "collect_list(m" in x]) == 1


def test_documents_of_a_person_with_many_spouses(spark):
    n = 20_000
    wife = "named_struct('key', concat('w', id), 'relation', '')"
    hub = spark.range(1).selectExpr("'hub' AS key", "'Hub' AS name", "'Male' AS gender", f"transform(sequence(0, {n - 1}), id -> {wife}) AS spouses")
    wives = spark.range(n).selectExpr("concat('w', id) AS key", "'Wife' AS name", "'Female' AS gender")
    kids = spark.range(n).selectExpr("concat('k', id) AS key", "'Kid' AS name", "'hub' AS father", "concat('w', id + 1) AS mother")
    rows = hub.unionByName(wives, allowMissingColumns=True).unionByName(kids, allowMissingColumns=True)
    kinds = spark.createDataFrame([], people.RECORD).schema
    rows = rows.select(*(F.coalesce(c.name, F.array().cast(c.dataType)).alias(c.name) if c.name == "spouses" else (F.col(c.name) if c.name in rows.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in kinds))
    began = time.time()
    got = documents.documents(rows, spark.createDataFrame([], "key string, ord int, event string")).filter("key = 'hub'").first()
    # looking through all spouses and children for each spouse takes minutes
    assert time.time() - began < 30
    assert len(got.spouse) == n and got.children == [f"@k{n - 1}"]
    assert [tuple(s) for s in got.spouse[:2]] == [("@w0", "Wife", []), ("@w1", "Wife", ["@k0"])]


def test_no_documents(spark):
    none = spark.createDataFrame([], people.RECORD)
    docs = documents.documents(none, spark.createDataFrame([("a", 1, "e")], "key string, ord int, event string"))
    out, row = documents.read_figures(docs)
    assert out.count() == 0 and set(row.collect()[0]) == {0}


def headed(lines, heads):
    """Lines with the headers of their runs, with a state carried along."""
    out, run, top, started, done = [], 0, 0, False, set()
    for line in lines:
        if line.startswith("---"):
            continue
        m = re.match(r"(\d+)\s", line.strip())
        if m:
            d = int(m[1])
            if d == 1 and top >= 10 and started:
                run, top = run + 1, 0
            if run < len(heads) and run not in done:
                if out and out[-1].strip():
                    out.append("")
                out += [x for x in heads[run] if x]
                done.add(run)
            started, top = True, max(top, d)
        out.append(line)
    return out


def test_section_headers(spark):
    rng = random.Random(6)
    lines, heads, want = [], [], {}
    for v in range(60):
        own, n = [], 0
        for _ in range(rng.randint(0, 80)):
            n = rng.choice((n + 1, n + 3, 1, n))
            own.append(rng.choice((f"{n} a", f" {n}  b", "--- x ---", "", "more", f"{n}", f"{n} ")))
        of = [(f"s{i}", rng.choice(("", f"c{i}"))) for i in range(rng.randint(0, 4))]
        lines += [(v, i * 2, x, "x") for i, x in enumerate(own)]
        heads += [(v, i, *x) for i, x in enumerate(of)]
        if [x for x in own if not x.startswith("---")]:
            want[v] = headed(own, of)
    out = segments.section_headers(spark.createDataFrame(lines, "volume int, at int, said string, line string"), spark.createDataFrame(heads, "volume int, idx long, section string, chapters string"), ["volume"], "at", "said")
    got = {}
    for r in out.orderBy("volume", "ord").collect():
        got.setdefault(r.volume, []).append(r.line)
    assert got == want and sum("s1" in x for x in want.values()) > 3


def test_mentions_of_records(spark):
    words = [("Bhima", "1", 10), ("Bhima", "1", 9), ("Bhima", "1", 9), ("Bhima", "2", None), ("Vira", "2", 3), ("Vira", None, None), ("Else", "1", 1)]
    index = [("Bhima", "b"), ("Vira", "b"), ("Vira", "v"), ("Vira", "v"), ("None", "n")]
    out = mentions.of_records(spark.createDataFrame(words, "word string, volume string, chapter int"), spark.createDataFrame(index, "word string, id string"))
    assert sorted(tuple(r) for r in out.collect()) == [("b", 6, 3, "Vol1:ch9,10 Vol2:ch3"), ("n", 0, 0, ""), ("v", 2, 1, "Vol2:ch3")]


def test_boundaries_leave_texts_where_they_are(spark, tmp_path):
    spark.createDataFrame([(1, p, f"Section One\nline {p}") for p in range(4, 30)], "volume int, page int, text string").write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    blocks = pages.select("volume", "page", F.lit(0).alias("block_no"), "text", F.lit(0).alias("type"))
    out = docparse.boundaries(pages, blocks, spark.createDataFrame([(1, 4, 30)], "volume int, start_page int, end_page int"))
    assert out.collect() == [(1, 4, None, None, 30)]
    plan = out._jdf.queryExecution().optimizedPlan()
    stack, n_joins = [plan], 0
    while stack:
        node = stack.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        n_joins += node.nodeName() == "Join"
        assert node.nodeName() != "Join" or not any("text#" in c.output().toString() for c in children)
        stack += children
    assert n_joins > 3

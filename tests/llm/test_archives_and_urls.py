import base64
import hashlib
import json
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import chat_format, decontamination, url_filter, warc

PAGES = "page_id long, url string, html string, digest string"


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "x"), (2, None, "x"), (3, "u\r\nX: y", None), (4, "http://b", ""), (5, "http://é/", "é" * 100_000), (6, "", "WARC/1.1\r\n\r\n"), (6, "", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    groups = defaultdict(list)
    for i, _, t in rows:
        groups[(t or "").encode()].append(i)
    wanted = []
    for i, _, t in rows:
        data = (t or "").encode()
        last = max(groups[data])
        wanted.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == last else "revisit", None if i == last else last))
    assert sorted(map(str, map(tuple, warc.round_trip(pages).collect()))) == sorted(map(str, wanted))
    assert warc.round_trip(pages.limit(0)).count() == 0


def members(n=6):
    import gzip

    return [gzip.compress(warc.record_bytes(i, f"http://x/{i}", f"payload {i} ".encode() * 50)) for i in range(n)]


def found(data):
    out = list(warc.salvage(data))
    ids = [x.headers["warc-record-id"][10:-1] for x in out if not x.why]
    gaps = [(x.start, x.end) for x in out if x.why]
    return ids, gaps


def test_salvage_gzip():
    own = members()
    starts = np.cumsum([0] + [len(m) for m in own]).tolist()
    assert found(b"".join(own)) == (list("012345"), [])
    broken = bytearray(b"".join(own))
    broken[starts[2] + 60 : starts[2] + 70] = b"\0" * 10
    assert found(bytes(broken)) == (list("01345"), [(starts[2], starts[3])])
    assert found(b"".join(own)[:-5]) == (list("01234"), [(starts[5], starts[6] - 5)])
    assert found(b"junk" + own[0] + b"more junk" + own[1]) == (["0", "1"], [(0, 4), (4 + starts[1], 13 + starts[1])])
    assert found(b"") == ([], []) and found(b"nothing here") == ([], [(0, 12)])


def test_salvage_plain():
    own = [warc.record_bytes(i, None, b"p%d" % i) for i in range(4)]
    data = b"".join(own)
    starts = np.cumsum([0] + [len(r) for r in own]).tolist()
    assert found(data) == (list("0123"), [])
    wrong = data.replace(b"p1\r\n\r\n", b"pX\r\n\r\n")  # the digest tells
    assert found(wrong) == (list("023"), [(starts[1], starts[2])])
    lines = bytearray(data)
    lines[starts[2] : starts[2] + 4] = b"XXXX"
    assert found(bytes(lines)) == (list("013"), [(starts[2], starts[3])])


def test_salvaged_files(spark, tmp_path):
    own = members(3)
    (tmp_path / "a.warc.gz").write_bytes(own[0] + own[1][:40] + own[2])
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [r.gap is None for r in rows] == [True, False, True]
    assert bytes(rows[2].payload) == b"payload 2 " * 50 and rows[1].end - rows[1].start == 40


def test_archives_roll_over_and_survive_a_restart(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"payload {i} " * 40) for i in range(30)], "page_id long, url string, html string").repartition(2)
    rows, folder = warc.with_types(pages).cache(), f"file://{tmp_path}/w"
    first = warc.write_archives(rows, folder, archive_bytes=400).collect()
    assert sum(r.n_records for r in first) == 30 and sum(r.archives for r in first) > 6
    kept = sorted(str(p) for p in tmp_path.rglob("*.warc.gz"))
    warc.write_archives(rows, folder, archive_bytes=400).collect()  # as tasks that run again
    assert sorted(str(p) for p in tmp_path.rglob("*.warc.gz")) == kept
    assert sorted(r.record_id for r in warc.read_archives(spark, folder).collect()) == sorted(f"<urn:page:{i}>" for i in range(30))


URLS = ["http://A.example.NET/en/1?x", "https://example.net/en/", "http://example.netx/", "ftp://x.example.com/de/a#b", "http://b.org/fr/", "http://org/fr", "no url", None, "http://", "http://m.casino-win.example.net/x", "http://casino-win.example.net", "http://net/", "http://x.net?y/z", "http://a.b.c.org/fr/?q"]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "h")], "page_id long, url string, host string")
    listed = spark.createDataFrame([(k,) for k in url_filter.LISTED], "key string")
    got = url_filter.judge(df, url_filter.RULES, listed).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        url = URLS[r.page_id] or ""
        host, path = "", ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = lambda k: (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith("/" + k.split("/", 1)[1])  # noqa: B023, E731
        rules = sorted((x for x in url_filter.RULES if fits(x.key)), key=lambda x: -len(x.key))
        verdict = rules[0].verdict if rules else "block" if any(map(fits, url_filter.LISTED)) else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rules[0].key if rules else None, verdict)
    assert url_filter.judge(df.limit(0), url_filter.RULES, listed).count() == 0


def test_cascade_is_exact(spark):
    keys = [f"h{i}.example.com/" for i in range(6000)]
    listed = set(random.Random(1).sample(keys, 900))
    frame = lambda x: spark.createDataFrame([(k,) for k in x], "key string")
    cascade = url_filter.compiled(frame([*listed, "not in the corpus/"]), frame(keys))
    assert len(cascade.levels) > 2
    assert set(np.array(keys)[cascade.has(keys)]) == listed


def test_a_long_list_is_taken_in_parts(spark):
    rng = random.Random(3)
    urls = [(i, f"http://h{rng.randrange(60)}.example.com/{'ab'[i % 2] * rng.randrange(4)}/x") for i in range(300)]
    listed = spark.createDataFrame([(f"h{i}.example.com/{'a' * (i % 4)}",) for i in range(0, 60, 2)], "key string")
    df = spark.createDataFrame(urls, "page_id long, url string")
    parts = url_filter.parts_of(listed, max_bytes=40, max_shapes=2)
    assert len(parts) > 4 and sum(k.count() for _, k in parts) == 30
    rows = lambda **x: sorted(map(tuple, url_filter.judge(df, url_filter.RULES, listed, **x).collect()))
    whole = rows()
    assert whole == rows(max_bytes=100, max_shapes=3) and {r[4] for r in whole} == {"allow", "block"}


def test_escapes():
    rng = random.Random(5)
    parts = [*chat_format.CONTROL, "\\", "\n", "<", "s>", "[", "INST]", "/", "a", "n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        out = chat_format.escaped(text)
        assert chat_format.unescaped(out) == text and not any(c in out for c in chat_format.CONTROL)
        assert chat_format.parsed(chat_format.formatted(text, text)[0] + out + chat_format.CLOSE)[0] == text


def test_layouts(spark):
    records = [
        {"messages": [{"role": "system", "content": "be"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "do", "input": "it", "output": "done"},
        {"prompt": "p", "completion": "c", "system": None},
        {"question": "q", "answer": "a"},
        {"strange": [1, {"x": 2}]},
        None,
    ]
    df = spark.createDataFrame([(i, 0, json.dumps(r) if r is not None else None, "clash") for i, r in enumerate(records)] + [(9, 0, "{", "")], "conv_id long, position int, record string, n string")
    rows = defaultdict(list)
    for r in chat_format.segments(df).collect():
        rows[r.conv_id].append(r)
    turns = {c: [(chat_format.parsed(r.segment)[0], chat_format.unescaped(chat_format.parsed(r.segment)[1])) for r in sorted(x, key=lambda r: r.n) if r.segment] for c, x in rows.items()}
    assert turns[0] == [("system", "be"), ("user", "q"), ("assistant", "")]
    assert turns[1] == [("user", "q"), ("assistant", "a")]
    assert turns[2] == [("user", "do\n\nit"), ("assistant", "done")]
    assert turns[3] == [("user", "p"), ("assistant", "c")] and turns[4] == [("user", "q"), ("assistant", "a")]
    assert turns[5] == turns[6] == turns[9] == [] and all(rows[c][0].fingerprint for c in (5, 6, 9))
    assert chat_format.segments(df.limit(0)).count() == 0


def test_records_that_fit_no_layout(spark):
    records = [
        '{"messages":[{"role":"user","content":"x"},null]}',
        '{"messages":[{"role":[],"content":"x"}]}',
        '{"messages":[{"role":{},"content":"x"}]}',
        '{"messages":5,"messages[].role":"user"}',
        '{"messages":[{"role":"user","content":{}}]}',
        "[" * 100_000,
        '{"a":' * 5000 + "1" + "}" * 5000,
        "nonsense",
    ]
    df = spark.createDataFrame([(i, 0, r) for i, r in enumerate(records)] + [(90, 0, '{"role":"user\\ud800","text":"a\\udc00b"}'), (91, 0, '{"role":1,"text":true}')], "conv_id long, position int, record string")
    rows = {r.conv_id: r for r in chat_format.segments(df).collect()}
    assert all(rows[i].segment is None and rows[i].fingerprint for i in range(len(records)))
    assert chat_format.parsed(rows[90].segment) == ("user\ufffd", "a\ufffdb") and chat_format.parsed(rows[91].segment) == ("1", "True")


def test_rows_go_through_all_layouts(spark):
    df = spark.createDataFrame([(1, t, r, x) for t, (r, x) in enumerate([("user", "a"), ("assistant", "b"), ("user", None), ("assistant", "c"), ("user", "d"), ("critic", "e"), (None, "f"), ("user", "")])], "conv_id long, turn long, role string, text string")
    rows = chat_format.segments(chat_format.of_rows(df)).orderBy("n").collect()
    assert [chat_format.parsed(r.segment) for r in rows] == [("user", "a"), ("assistant", "b"), ("user", ""), ("assistant", "c"), ("user", "d"), ("critic", "e"), ("", "f"), ("user", "")]
    assert len({r.fingerprint for r in rows}) >= 4


def test_roles_stay_as_they_are(spark):
    import hashlib

    said = [("human", "hi"), ("gpt", "ho"), ("bot", "x"), (None, "y"), ("assistant", "z"), ("user", "<s>")]
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(said)], "conv_id long, turn int, role string, text string")
    got = chat_format.digests(chat_format.segments(chat_format.of_rows(rows))).first()
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r or ''}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert (got["n_turns"], got["loss_chars"], got["loss_sha256"]) == (6, 1, hashlib.sha256(b"z").hexdigest())


def test_digests(spark):
    rows = [*chat_format.ADDED, (1, 1, "assistant", None), (1, 0, "user", "hé\\"), (1, 0, "user", "hé\\"), (2, None, None, "x"), (3, 0, "assistant", "long " * 50_000), (None, 0, "assistant", "y")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.segments(chat_format.of_rows(df))).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        wanted = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == wanted
        assert got[c].formatted_chars == sum(len(chat_format.formatted(r, x)[0] + chat_format.formatted(r, x)[1]) + len(chat_format.CLOSE) for _, r, x in turns)
    assert chat_format.digests(chat_format.segments(chat_format.of_rows(df.limit(0)))).count() == 0


def edit_distance_within(item, text):
    """The least edits between an item and any part of a text."""
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_equal_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.choice([6, 9, 12])))) for i in range(8)] + [(8, "short"), (9, None), (10, ""), (11, "?!"), (12, "Two Words")]
    docs = [(105, "x short, two  WORDS"), (106, "shorts two words_"), (107, "short"), (100, None), (101, ""), (102, items[0][1].upper().replace(" ", ",  ")), (103, "É " + items[1][1] + "\n" + "x " * 60_000), (104, items[2][1]), (104, items[2][1])]
    for i in range(60):
        text = list(rng.choice(items[:8])[1])
        for _ in range(rng.randint(0, 7)):
            k = rng.randrange(len(text))
            text[k : k + 1] = rng.choice([[], ["q"], [text[k], "z"]])
        docs.append((i, " ".join(word() for _ in range(5)) + " " + "".join(text) + " " + " ".join(word() for _ in range(5))))
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, doc_id string")
    got = defaultdict(set)
    for r in decontamination.leaks(df, bench).collect():
        got[r.doc_id].add(r.item_id)
        assert 0 <= r.start < r.end <= len(dict(docs)[r.doc_id])
    fold = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    for d, t in docs:
        if len(fold(t)) > 1000:
            continue
        wanted = {i for i, x in items if len(fold(x)) >= decontamination.SHORT and edit_distance_within(fold(x), fold(t)) <= decontamination.edits_allowed(np.array([len(fold(x))]))[0]}
        wanted |= {i for i, x in items if 0 < len(fold(x)) < decontamination.SHORT and f" {fold(x)} " in f" {fold(t)} "}
        assert got[d] == wanted, (d, t)
    assert got[103] == {1} and got[102] == {0}
    kept = {r.doc_id for r in decontamination.clean(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d in got if got[d]}
    assert decontamination.leaks(df.limit(0), bench).count() == 0 and decontamination.leaks(df, bench.limit(0)).count() == 0


def test_excerpts_of_long_items_equal_brute_force():
    rng = random.Random(11)
    words = lambda n: (" ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n)) + " " * n)[:n].strip()
    items = [words(n) for n in (150, 227, 300, 400)]
    texts = ["x " + items[1][20:130] + " y", items[0][:11], items[0]]  # a text that ends as an item begins, and the item
    for i in range(14):
        item = rng.choice(items)
        at, n = rng.randrange(len(item) - 100), rng.randint(80, 140)
        part = list(item[at : at + n])
        for _ in range(rng.choice([0, 0, 4, 9])):
            part[rng.randrange(len(part))] = "q"
        texts.append(" ".join((words(rng.randint(5, 40)) + " " + "".join(part) + " " + words(30)).split()))
    for hits in (decontamination.HITS, 40):  # in one stretch, and in many
        before, decontamination.HITS = decontamination.HITS, hits
        got = decontamination.found(decontamination.index(list(enumerate(items))), texts)
        decontamination.HITS = before
        pairs = dict(zip(zip(got[0].tolist(), got[1].tolist(), strict=True), got[5].tolist(), strict=True))
        assert (0, 1) in pairs and (2, 0) in pairs
        for t, text in enumerate(texts):
            for i, item in enumerate(items):
                likely = any(item[k : k + 10] in text for k in range(len(item) - 9))  # 8 edits of 100 characters leave such a run
                windows = sum(edit_distance_within(item[k : k + 100], text) <= 8 for k in range(len(item) - 99)) if likely else 0
                assert pairs.get((t, i), 0) == windows, (t, i)


def test_texts_and_items_that_repeat_themselves():
    import tracemalloc

    ix = decontamination.index([(0, "a" * 400), (1, "ab " * 70)])
    tracemalloc.start()
    got = decontamination.found(ix, ["a" * 20_000, "ab " * 5_000, "ba " * 20])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(zip(got[0].tolist(), got[1].tolist(), strict=True)) == [(0, 0), (1, 1)] and peak < 1 << 29


def test_ids_and_scripts(spark):
    docs = spark.createDataFrame([(1, "слово ПРИВЕТ, как твои дела сегодня, друг мой"), (2, "one\u00a0two three four five six seven"), (3, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([("x-1", "Привет как твои дела сегодня"), ("x-2", "привет КАК твои дела сегодня"), ("x-2", "Привет как твои дела сегодня"), (None, "ONE TWO THREE four five six"), ("x-3", None)], "item_id string, text string")
    assert sorted((r.doc_id, str(r.item_id)) for r in decontamination.leaks(docs, bench).collect()) == [(1, "x-1"), (1, "x-2"), (1, "x-2"), (2, "None")]
    assert [r.doc_id for r in decontamination.clean(docs, bench).collect()] == [3]


def test_clean_judges_rows_without_an_id_or_with_a_repeated_one(spark):
    item = "one quick brown fox jumps over the lazy dogs of a benchmark"
    docs = spark.createDataFrame([(None, "see " + item), (None, "harmless"), (None, None), (7, item), (7, "other row"), (8, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = {(r.doc_id, r.text) for r in decontamination.clean(docs, bench).collect()}
    assert kept == {(None, "harmless"), (None, None), (7, "other row"), (8, "")}

"""Logs of facts against loops that apply them one after the other."""

import random

import pytest

from weftline.operators import people


def key(name):
    return name.strip().lower().replace(" ", "_")


def replay(log, seeds, mapping):
    nodes = {k: [n, g] for k, n, g in seeds}
    aliases = {}
    for _, a, b, gender in sorted(log):
        ka = mapping.get(key(a), key(a))
        if b is None:
            node = nodes.setdefault(ka, [a, "Unknown"])
            if node[1] == "Unknown" and gender:
                node[1] = gender
            continue
        kb = mapping.get(key(b), key(b))
        if ka in nodes or kb not in nodes:
            nodes.setdefault(ka, [a, "Unknown"])
            aliases.setdefault(ka, set()).add(b)
        else:
            aliases.setdefault(kb, set()).add(a)
    return {(k, *v) for k, v in nodes.items()}, {(k, a) for k, own in aliases.items() for a in own}


def test_aliases_as_by_a_loop(spark):
    """200 random logs, in one table: names of each log have its number before them."""
    rnd = random.Random(4)
    rows, seeds, mapping, want_nodes, want_aliases = [], [], [], set(), set()
    for k in range(200):
        name = lambda k=k: f"L{k}{rnd.choice('ABCDEFGH')}"
        own_seeds = [(key(n), n, rnd.choice(("Unknown", "Male"))) for n in {name() for _ in range(rnd.randint(0, 2))}]
        own_map = {key(f"L{k}H"): own_seeds[0][0]} if own_seeds and own_seeds[0][0] != key(f"L{k}H") else {}
        log = []
        for i in range(rnd.randint(1, 14)):
            a, b = name(), name()
            log.append((k * 100 + i, a, b, None) if rnd.random() < 0.75 and a != b else (k * 100 + i, a, None, rnd.choice((None, "Unknown", "Female", "Male"))))
        log = [(o, a, b, None if g == "Unknown" else g) for o, a, b, g in log]
        nodes, aliases = replay(log, own_seeds, own_map)
        rows += log
        seeds += own_seeds
        mapping += own_map.items()
        want_nodes |= nodes
        want_aliases |= aliases
    log = spark.createDataFrame(rows, "ord long, a string, b string, gender string")
    nodes, aliases = people.united_aliases(log, spark.createDataFrame(seeds, "key string, name string, gender string"), spark.createDataFrame(mapping, "alias_key string, key string"))
    assert {(r["key"], r["name"], r["gender"]) for r in nodes.collect()} == want_nodes
    assert {(r["key"], r["alias"]) for r in aliases.collect()} == want_aliases
    none = people.united_aliases(log.filter("false"), spark.createDataFrame([], "key string, name string, gender string"), spark.createDataFrame([], "alias_key string, key string"))
    assert none[0].count() == none[1].count() == 0


LISTS = people.SETS


def loop(facts):
    out = {}
    for f in sorted(facts, key=lambda f: f["ord"]):
        r = out.setdefault(f["key"], {"name": f["name"].strip(), "gender": "Unknown", **dict.fromkeys(("father", "mother", *people.LASTING)), **{c: [] for c in (*LISTS, *people.PAIRS)}})
        for c in people.CHANGING:
            value = (f[c] or "").strip()
            if value and value != "Unknown" and (f["strong"] or r[c] in (None, "Unknown")):
                r[c] = value
        for c in people.LASTING:
            r[c] = r[c] or (f[c] or "").strip() or None
        for c in LISTS:
            r[c] += [x for x in dict.fromkeys(y.strip() for y in f[c] or []) if x and x not in r[c] and not (c == "aliases" and x == r["name"])]
        for k, relation in f["spouses"] or []:
            at = next((i for i, s in enumerate(r["spouses"]) if s[0] == k), None)
            if at is None:
                r["spouses"].append((k, relation))
            elif relation and not r["spouses"][at][1]:
                r["spouses"][at] = (k, relation)
        for x in f["relationships"] or []:
            if x[:2] not in [y[:2] for y in r["relationships"]]:
                r["relationships"].append(x)
    return {k: {c: v for c, v in r.items()} for k, r in out.items()}


def random_facts(rnd, n, n_keys):
    pick = lambda *values: rnd.choice(values)
    facts = []
    for i in range(n):
        f = {"key": f"k{rnd.randrange(n_keys)}", "ord": i, "name": pick("Ana", "Bo", " Cy "), "strong": rnd.random() < 0.4}
        f |= {"gender": pick(None, "Unknown", "Male", "Female"), "father": pick(None, "", "k1", "k2"), "mother": pick(None, None, "k3")}
        f |= {c: pick(None, "", f"{c}{i}") for c in people.LASTING}
        f |= {c: pick(None, [], [f"x{rnd.randrange(4)}", f"x{rnd.randrange(4)}"], ["Ana", f"k{rnd.randrange(n_keys)}"]) for c in LISTS}
        f |= {"spouses": pick(None, [(f"k{rnd.randrange(n_keys)}", pick(None, "Wife", "Husband"))]), "relationships": pick(None, [(f"k{rnd.randrange(3)}", pick("Friend", "Foe"), f"n{i}")])}
        facts.append(f)
    return facts


def as_dict(rows):
    plain = lambda v: [tuple(x) if not isinstance(x, str) else x for x in v] if isinstance(v, list) else v
    return {r["key"]: {c: plain(v) for c, v in r.asDict().items() if c != "key"} for r in rows}


def frame(spark, facts, schema=people.FACT):
    names = [x.split()[0] for x in ("key", "ord", "name", "strong", *people.CHANGING, *people.LASTING, *LISTS, *people.PAIRS)]
    return spark.createDataFrame([tuple(f[c] for c in names) for f in facts], schema)


@pytest.mark.parametrize("seed", range(3))
def test_updates_as_by_a_loop(spark, seed):
    facts = random_facts(random.Random(seed), 150, 9)
    assert as_dict(people.upserted(frame(spark, facts).repartition(5)).collect()) == loop(facts)
    assert people.upserted(frame(spark, facts).filter("false")).count() == 0


def merge_loop(records, rules):
    chars = {k: {c: list(v) if isinstance(v, list) else v for c, v in r.items()} for k, r in records.items()}
    for old, new in rules:
        if old in chars and new in chars and old != new:
            o, n = chars.pop(old), chars[new]
            n["aliases"] += [a for a in (o["name"], *o["aliases"]) if a not in n["aliases"] and a != n["name"]]
            for c in ("father", "mother", "caste", "duty", "dynasty", "status"):
                n[c] = n[c] or o[c]
            n["gender"] = o["gender"] if n["gender"] == "Unknown" else n["gender"]
            n["siblings"] += [s for s in o["siblings"] if s not in n["siblings"]]
            n["spouses"] += [s for s in o["spouses"] if s[0] not in [x[0] for x in n["spouses"]]]
            for c in chars.values():
                for field in ("father", "mother"):
                    c[field] = new if c[field] == old else c[field]
                c["siblings"] = list(dict.fromkeys(new if s == old else s for s in c["siblings"]))
                c["spouses"] = [(new if s == old else s, r) for s, r in c["spouses"]]
    for k, c in chars.items():
        for field in ("father", "mother"):
            c[field] = None if c[field] == k else c[field]
        c["siblings"] = set(c["siblings"]) - {k}
        c["spouses"] = {s for s, _ in c["spouses"]} - {k}
        c["aliases"] = set(c["aliases"])
    return chars


@pytest.mark.parametrize("seed", range(3))
def test_merges_as_by_a_loop(spark, seed):
    """Chains of rules in any order; lists are compared as sets, spouses by key; only fields that a parent fills later differ by
    the order of rules, so each record has its parents."""
    rnd = random.Random(seed)
    records = loop(random_facts(rnd, 60, 14))
    for i, r in enumerate(records.values()):
        r |= {"father": "k1", "mother": "k3", "gender": "Male", "caste": f"c{i}", "duty": None, "dynasty": f"d{i}", "status": f"s{i}"}
    olds = rnd.sample([f"k{i}" for i in range(16)], 9)
    rules = [(o, f"k{rnd.randrange(15)}") for o in olds]
    df = frame(spark, [{"key": k, "ord": 0, "strong": True, **r} for k, r in records.items()]).drop("ord", "strong")
    got = as_dict(people.merged_records(df, spark.createDataFrame([(o, n, i) for i, (o, n) in enumerate(rules)], "old_key string, new_key string, ord long")).collect())
    for r in got.values():
        r["siblings"], r["spouses"], r["aliases"] = set(r["siblings"]), {s for s, _ in r["spouses"]}, set(r["aliases"])
    assert got == merge_loop(records, rules)


def test_ensured(spark):
    nodes = spark.createDataFrame([("a", "A", "Unknown"), ("c", "C", "Male")], "key string, name string, gender string")
    asked = [(0, "A", "Unknown"), (1, "A", "Male"), (2, "B", "Male"), (3, "b", "Female"), (4, "C", "Female"), (5, "Z", "Female"), (6, "D E", None), (7, "Y", "Male")]
    mapping = spark.createDataFrame([("z", "a"), ("y", "gone")], "alias_key string, key string")
    got = people.ensured(nodes, spark.createDataFrame(asked, "ord long, name string, gender string"), mapping).collect()
    assert {tuple(r) for r in got} == {("a", "A", "Male"), ("b", "B", "Male"), ("c", "C", "Male"), ("d_e", "D E", "Unknown")}

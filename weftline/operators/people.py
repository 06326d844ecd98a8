"""Records of people from an ordered log of facts: creation, aliases, updates, merges.

What a fact does depends on what is there when its turn comes. Nothing here replays
the log: each question about the order is a fold (first, last, least order number) or
a fixpoint over a few rounds of joins.

Defined results: facts without a key are left out; order numbers (`ord`, long) are
distinct; null and empty values say nothing; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import graph
from weftline.operators.graph import stored

NEVER = (1 << 63) - 1


def creations(asked: DataFrame, also: DataFrame) -> DataFrame:
    """key and created, the order number at which each person comes to be (null keys left out).

    asked (key, ord) creates the key at once. also (a, b, ord) creates a unless a or b is there already. Whether it does
    depends on earlier creations only, so bounds from below and above close in on the true number: a row surely creates
    if b can't be there before it, and surely doesn't if b must be. Only the first row of each pair matters.
    """
    with graph.scratch(asked.sparkSession) as keep:
        first = asked.filter("key IS NOT NULL").groupBy("key").agg(F.min("ord").alias("asked"))
        pairs = stored(also.filter("a IS NOT NULL AND b IS NOT NULL").groupBy("a", "b").agg(F.min("ord").alias("ord")), "pairs")
        keys = first.join(pairs.groupBy(F.col("a").alias("key")).agg(F.min("ord").alias("least")), "key", "full")
        low = F.least(F.coalesce("asked", F.lit(NEVER)), F.coalesce("least", F.lit(NEVER)))
        bounds = stored(keys.select("key", F.coalesce("asked", F.lit(NEVER)).alias("asked"), low.alias("low"), F.coalesce("asked", F.lit(NEVER)).alias("high")), "bounds")
        closer = lambda found, bound: F.when(F.col(found).isNotNull(), F.least("asked", found)).otherwise(F.col(bound)).alias(bound)
        while not bounds.filter("low < high").isEmpty():
            open_ = pairs.join(bounds.filter("low < high").select(F.col("key").alias("a")), "a", "left_semi")
            other = bounds.select(F.col("key").alias("b"), F.col("low").alias("_low"), F.col("high").alias("_high"))
            seen = open_.join(other, "b", "left").withColumns({"_low": F.coalesce("_low", F.lit(NEVER)), "_high": F.coalesce("_high", F.lit(NEVER))})
            at = lambda bound: F.coalesce(F.min(F.when(F.col(bound) >= F.col("ord"), F.col("ord"))), F.lit(NEVER))
            new = seen.groupBy(F.col("a").alias("key")).agg(at("_high").alias("_l"), at("_low").alias("_h"))
            bounds = stored(bounds.join(new, "key", "left").select("key", "asked", closer("_l", "low"), closer("_h", "high")), "bounds")
        return keep(bounds.filter(F.col("low") < NEVER).select("key", F.col("low").alias("created")), "created")


def keyed(df: DataFrame, mapping: DataFrame, **names: str) -> DataFrame:
    """The rows with the keys (new columns) of the names in other columns: by alias (mapping: alias_key, key), else their own."""
    to = mapping.select(F.col("alias_key").alias("_k"), F.col("key").alias("_to"))
    for out, name in names.items():
        df = df.withColumn("_k", T.key_of(F.col(name))).join(to, "_k", "left").withColumn(out, F.coalesce("_to", "_k")).drop("_k", "_to")
    return df


def united_aliases(log: DataFrame, seeds: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (key, name, gender, created) and aliases (key, alias, ord) after a log.

    log: ord, a, b, gender. A row without b asks for the name a, and sets its gender if that isn't known yet. A row with b
    says that b is also a name of a: if a is there by then, b becomes its alias; else, if b is there, a becomes b's; else a
    is created, with the alias b. seeds (key, name, gender) are there before; mapping (alias_key, key) is their alias map,
    by which names are resolved.
    """
    rows = keyed(log.select("ord", "a", "b", "gender"), mapping, key="a", key_b="b")
    first = seeds.select("key", F.lit(-1).cast("long").alias("ord"), F.col("name").alias("a"), "gender")
    # of rows that ask for the same, the first one decides: a key is created when it is first asked for, if not before
    asked = rows.filter("b IS NULL").groupBy("key", "a", "gender").agg(F.min("ord").alias("ord"))
    asked = stored(asked.select("key", "ord", "a", "gender"), "asked").unionByName(first)
    also = stored(rows.filter("b IS NOT NULL"), "also")
    created = creations(asked, also.select(F.col("key").alias("a"), F.col("key_b").alias("b"), "ord"))
    known = F.when(F.col("gender") != "Unknown", F.col("ord"))
    says = asked.unionByName(also.select("key", "ord", "a", F.lit(None).cast("string").alias("gender")))
    nodes = says.join(created, "key").filter("ord >= created").groupBy("key", "created").agg(F.min_by("a", "ord").alias("name"), F.coalesce(F.min_by("gender", known), F.lit("Unknown")).alias("gender"))
    there = also.join(created, "key", "left")
    own = F.coalesce(F.col("created") <= F.col("ord"), F.lit(False))
    aliases = there.select(F.when(own, F.col("key")).otherwise(F.col("key_b")).alias("key"), F.when(own, F.trim("b")).otherwise(F.trim("a")).alias("alias"), "ord")
    return nodes.select("key", F.trim("name").alias("name"), "gender", "created"), aliases.groupBy("key", "alias").agg(F.min("ord").alias("ord"))


#: Fields of a record by how a later fact treats them: strong facts overwrite the first ones, and the others are kept once set.
CHANGING = ("gender", "father", "mother")
LASTING = ("caste", "duty", "dynasty", "status", "kingdom", "political_role")
SETS = ("aliases", "siblings", "skills", "divine_weapons", "titles", "traits", "character_arc", "important_locations")
PAIRS = {"spouses": ("key", "relation"), "relationships": ("with", "type", "note")}
FACT = (
    "key string, ord long, name string, strong boolean, "
    + ", ".join(f"{c} string" for c in (*CHANGING, *LASTING))
    + ", "
    + ", ".join(f"{c} array<string>" for c in SETS)
    + ", "
    + ", ".join(f"{c} array<struct<{', '.join(f'{x}: string' for x in parts)}>>" for c, parts in PAIRS.items())
)
RECORD = FACT.replace("ord long, ", "").replace("strong boolean, ", "")


def _said(c: str) -> Column:
    value = F.nullif(F.trim(c), F.lit(""))
    return F.nullif(value, F.lit("Unknown")) if c == "gender" else value


def _items(facts: DataFrame) -> DataFrame:
    """key, field, id, at (order number and place), and a, b, c of each item of a list: what makes it another one is its id."""
    one = lambda f, a, b=None, c=None, same=None: F.struct(F.lit(f).alias("field"), (same if same is not None else a).alias("id"), a.alias("a"), (b if b is not None else F.lit(None).cast("string")).alias("b"), (c if c is not None else F.lit(None).cast("string")).alias("c"))
    empty = lambda c: F.coalesce(F.col(c), F.array())
    texts = lambda f: F.transform(empty(f), lambda x: one(f, F.trim(x)))
    lists = [texts(f) for f in SETS]
    lists.append(F.transform(empty("spouses"), lambda x: one("spouses", x["key"], F.nullif(x["relation"], F.lit("")))))
    lists.append(F.transform(empty("relationships"), lambda x: one("relationships", x["with"], x["type"], x["note"], F.concat_ws("\0", F.coalesce(x["with"], F.lit("")), F.coalesce(x["type"], F.lit(""))))))
    rows = facts.filter("key IS NOT NULL").select("key", "ord", F.posexplode(F.concat(*lists)).alias("place", "i"))
    return rows.filter("i.id <> ''").select("key", "i.*", F.struct("ord", "place").alias("at"))


def upserted(facts: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """A record for each key, after all of its facts (columns of FACT). moved (key, to): other keys for those of siblings and
    spouses, of which none is the record's own then.

    The name is that of the first fact. A strong fact sets gender, father and mother; another one does so where nothing is
    set yet. The lasting fields keep their first value. Lists get each item once, in the order in which they came; the
    relation of a spouse is the first that is given; relationships are distinct by with and type; a name isn't its own alias.
    """
    own = facts.filter("key IS NOT NULL")
    when = lambda c, more=F.lit(True): F.when(c.isNotNull() & more, F.col("ord"))
    strong = F.coalesce(F.col("strong"), F.lit(False))
    changing = [F.coalesce(F.max_by(_said(c), when(_said(c), strong)), F.min_by(_said(c), when(_said(c), ~strong))).alias(c) for c in CHANGING]
    lasting = [F.min_by(_said(c), when(_said(c))).alias(c) for c in LASTING]
    one = own.groupBy("key").agg(F.min_by(F.trim("name"), "ord").alias("name"), *changing, *lasting).withColumn("gender", F.coalesce("gender", F.lit("Unknown")))
    items = _items(own)
    if moved is not None:
        ref = F.when(F.col("field").isin("siblings", "spouses"), F.col("a"))
        items = items.withColumn("_ref", ref).join(moved.select(F.col("key").alias("_ref"), F.col("to").alias("_to")), "_ref", "left")
        items = items.withColumns({"id": F.coalesce("_to", "id"), "a": F.coalesce("_to", "a")}).filter(F.col("_ref").isNull() | (F.col("a") != F.col("key"))).drop("_ref", "_to")
    each = items.groupBy("key", "field", "id").agg(F.min("at").alias("at"), F.min_by(F.struct("a", "b", "c"), "at").alias("x"), F.min_by("b", F.when(F.col("b").isNotNull(), F.col("at"))).alias("relation"))
    mine = lambda f: F.array_sort(F.collect_list(F.when(F.col("field") == f, F.struct("at", "x", "relation"))))
    lists = [F.transform(mine(f), lambda i: i["x"]["a"]).alias(f) for f in SETS]
    lists.append(F.transform(mine("spouses"), lambda i: F.struct(i["x"]["a"].alias("key"), i["relation"].alias("relation"))).alias("spouses"))
    lists.append(F.transform(mine("relationships"), lambda i: F.struct(i["x"]["a"].alias("with"), i["x"]["b"].alias("type"), i["x"]["c"].alias("note"))).alias("relationships"))
    out = one.join(each.groupBy("key").agg(*lists), "key", "left")
    none = [F.coalesce(f, F.array().cast(out.schema[f].dataType)).alias(f) for f in (*SETS, *PAIRS)]
    out = out.select("key", "name", *CHANGING, *LASTING, *none)
    return out.withColumn("aliases", F.filter("aliases", lambda a: a != F.col("name")))


def applied(rules: DataFrame, keys: DataFrame) -> DataFrame:
    """old_key, new_key, ord of the merges that happen when rules (one for each old_key) are taken in order: both keys must be
    there, and the new one not merged away before.

    A rule is stopped by the one that merges its new key away earlier, unless that was itself stopped: so by the evenness
    of the number of rules before it in a chain, which is counted by doubling.
    """
    with graph.scratch(rules.sparkSession) as keep:
        here = keys.select("key").distinct()
        own = rules.filter("old_key <> new_key")
        for c in ("old_key", "new_key"):
            own = own.join(here.withColumnRenamed("key", c), c, "left_semi")
        earlier = own.select(F.col("old_key").alias("new_key"), F.col("old_key").alias("_before"), F.col("ord").alias("_ord"))
        chain = own.join(earlier, "new_key", "left").select("old_key", "new_key", "ord", F.when(F.col("_ord") < F.col("ord"), F.col("_before")).alias("before"))
        step = stored(chain.select("old_key", "new_key", "ord", "before", F.when(F.col("before").isNotNull(), 1).otherwise(0).cast("long").alias("n")), "chain")
        while not step.filter("before IS NOT NULL").isEmpty():
            on = step.select(F.col("old_key").alias("before"), F.col("before").alias("_b"), F.col("n").alias("_n"))
            step = stored(step.join(on, "before", "left").select("old_key", "new_key", "ord", F.col("_b").alias("before"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")), "chain")
        return keep(step.filter("n % 2 = 0").select("old_key", "new_key", "ord"), "applied")


#: What a record gives to the one that it is merged into: fields that fill what is missing there, lists that are added; the rest is lost.
FILLS = ("father", "mother", "gender", "caste", "duty", "dynasty", "status")
ADDS = ("aliases", "siblings", "spouses")


def merged_records(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Records (columns of RECORD) with merges (rules: old_key, new_key, ord) done: FILLS and ADDS of a merged record go to the
    one at the end of its chain of merges, in their order, its name becomes an alias there, and all keys that point to it,
    in fields, lists and structs, point to the other, once and never to itself."""
    with graph.scratch(records.sparkSession) as keep:
        done = applied(rules, records)
        moved = graph.roots(done.select(F.col("old_key").alias("key"), F.col("new_key").alias("parent")).unionByName(done.select(F.col("new_key").alias("key"), F.lit(None).cast("string").alias("parent")).join(done.select(F.col("old_key").alias("key")), "key", "left_anti").distinct()))
        moved = stored(moved.join(done.select(F.col("old_key").alias("key"), "ord"), "key").select("key", F.col("root").alias("to"), "ord"), "moved")
        # parents are joined as rows and put back into their records; the references in lists are renamed as items of upserted()
        refs = records.select("key", F.explode(F.array("father", "mother")).alias("ref")).filter("ref IS NOT NULL").distinct()
        new = refs.join(moved.select(F.col("key").alias("ref"), "to"), "ref").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("ref", "to"))).alias("_new"))
        own = records.join(new, "key", "left").join(moved, "key", "left")
        at = lambda c: F.coalesce(F.try_element_at("_new", c), c)
        self_ = F.coalesce("to", "key")
        apart = lambda c: F.when(c != self_, c)
        gone = F.col("to").isNotNull()
        fields = {c: apart(at(F.col(c))) for c in ("father", "mother")}
        fields["aliases"] = F.when(gone, F.concat(F.array("name"), "aliases")).otherwise(F.col("aliases"))
        lost = [c for c in (*CHANGING, *LASTING, *SETS, *PAIRS) if c not in (*FILLS, *ADDS)]
        fields |= {c: F.when(~gone, F.col(c)) for c in lost}
        facts = own.withColumns(fields | {"key": self_, "ord": F.coalesce(F.col("ord") + 1, F.lit(0)).cast("long"), "strong": F.lit(False)})
        # only the record that stays gives its name: it comes first
        return keep(upserted(facts.select("key", "ord", "name", "strong", *CHANGING, *LASTING, *SETS, *PAIRS), moved), "merged")


def ensured(nodes: DataFrame, asked: DataFrame, mapping: DataFrame, name: str = "name", gender: str = "gender", order: str = "ord") -> DataFrame:
    """Nodes (key, name, gender) with a row for each asked name whose key, by alias or its own, isn't there. A new row has the
    first name that asks for it; a gender that isn't known, in old rows too, becomes the first known one, by order."""
    own = mapping.select(F.col("alias_key").alias("_k"), F.col("key").alias("_to"))
    rows = asked.withColumn("_k", T.key_of(F.col(name))).join(own, "_k", "left").select(F.coalesce("_to", "_k").alias("key"), F.trim(name).alias("name"), F.col(gender).alias("gender"), F.col(order).cast("long").alias("ord"), F.col("_to").isNotNull().alias("by_alias"))
    there = nodes.select("key", F.col(name).alias("name"), F.col(gender).alias("gender"), F.lit(None).cast("long").alias("ord"), F.lit(False).alias("by_alias"))
    every = rows.unionByName(there)
    rank = F.struct(F.col("ord").isNotNull(), "ord")
    known = F.when(F.col("gender") != "Unknown", rank)
    out = every.groupBy("key").agg(F.min_by("name", F.when(~F.col("by_alias"), rank)).alias(name), F.coalesce(F.min_by("gender", known), F.lit("Unknown")).alias(gender), F.count_if(~F.col("by_alias")).alias("_n"))
    return out.filter("_n > 0").drop("_n")


def valid(df: DataFrame, columns: Sequence[str], noise: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """Rows whose names are long enough, don't end in a hyphen, and are in neither list (noise as written, skip in lower case)."""
    for c in columns:
        df = df.filter(T.name_shape(F.col(c)) & ~F.col(c).isin(*noise) & ~F.lower(c).isin(*skip))
    return df

"""The registered queries: each operator on one of the standard tables, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.functions import text as T
from weftline.operators import assemble, entities, footnotes, fuzzy, graph, mentions, scan, search, segments, validate
from weftline.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_WORDS = r"SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents"
_NAMES = f"SELECT * FROM ({_WORDS}) WHERE regexp_matches(word, '^[A-Z][a-z][a-z]+$')"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def long(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.name_rows(table(spark, sf, "documents"), "text", "doc_id", "source")


def _counted(spark: SparkSession, sf: str, least: int = 1) -> DataFrame:
    return _names(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


# mentions


@query(f"SELECT word, count(*)::BIGINT AS n FROM ({_NAMES}) GROUP BY word HAVING count(*) >= 5")
def mention_counts(spark, sf):
    return _counted(spark, sf, 5)


@query(
    f"""WITH a AS (SELECT word, count(*) AS n FROM ({_NAMES}) GROUP BY word),
b AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS word FROM conversations) WHERE regexp_matches(word, '^[A-Z][a-z][a-z]+$') GROUP BY word)
SELECT coalesce(a.word, b.word) AS word, coalesce(a.n, 0)::BIGINT AS n_documents, coalesce(b.n, 0)::BIGINT AS n_conversations, (coalesce(a.n, 0) + coalesce(b.n, 0))::BIGINT AS n_total
FROM a FULL OUTER JOIN b ON a.word = b.word"""
)
def mention_by_source_outer(spark, sf):
    a = mentions.name_rows(table(spark, sf, "documents"), "text").withColumn("from", F.lit("documents"))
    b = mentions.name_rows(table(spark, sf, "conversations"), "text").withColumn("from", F.lit("conversations"))
    return mentions.counts(a.unionByName(b), F.col("from"), ["documents", "conversations"])


@query(
    f"""WITH p AS (SELECT DISTINCT word, source, doc_id FROM ({_NAMES})), c AS (SELECT word, count(*) AS n FROM ({_NAMES}) GROUP BY word),
v AS (SELECT word, source, 'Vol' || source || ':ch' || string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS place FROM p GROUP BY word, source)
SELECT v.word, c.n::BIGINT AS n_mentions, string_agg(place, ' ' ORDER BY source) AS appearance FROM v JOIN c ON v.word = c.word GROUP BY v.word, c.n"""
)
def mention_appearance(spark, sf):
    return mentions.appearances(_names(spark, sf), "word", "source", "doc_id")


@query(f"SELECT word, count(*)::BIGINT AS n FROM ({_NAMES}) GROUP BY word ORDER BY n DESC, word LIMIT 20")
def top_mentions(spark, sf):
    return mentions.top(_counted(spark, sf), 20, "n", "word")


# text functions


@query(r"SELECT doc_id, length(trim(regexp_replace(text, '\s+', ' ', 'g')))::BIGINT AS n_chars_out, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents")
def text_normalise(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", T.squeeze(F.col("text")).alias("t"))
    return own.select("doc_id", long(F.length("t")).alias("n_chars_out"), F.md5("t").alias("digest"))


@query(
    r"""WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\s+$', ''), '[0-9]+$', '') AS b FROM documents)
SELECT doc_id, b <> '' AND NOT contains('.!?’”''"):', right(b, 1)) AS mid_sentence FROM t"""
)
def mid_sentence_flag(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.ends_mid_sentence(F.col("text")).alias("mid_sentence"))


@query(
    r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS ls FROM documents),
t AS (SELECT doc_id, CASE WHEN len(ls) = 0 THEN '' ELSE list_reduce(ls, lambda acc, x: CASE WHEN ends_with(acc, '-') THEN left(acc, length(acc) - 1) || x ELSE acc || ' ' || x END) END AS t FROM l)
SELECT doc_id, length(t)::BIGINT AS n_chars_out, md5(t) AS digest FROM t"""
)
def dehyphenate_lines(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", T.joined_lines(F.split("text", "\n")).alias("t"))
    return own.select("doc_id", long(F.length("t")).alias("n_chars_out"), F.md5("t").alias("digest"))


_FIXES = [("the", "THE"), (" and ", " & "), ("THE", "the "), ("qq", "q")]


@query(
    """WITH a AS (SELECT doc_id, text AS t0, replace(text, 'the', 'THE') AS t1 FROM documents), b AS (SELECT *, replace(t1, ' and ', ' & ') AS t2 FROM a), c AS (SELECT *, replace(t2, 'THE', 'the ') AS t3 FROM b)
SELECT doc_id, md5(replace(t3, 'qq', 'q')) AS digest, (contains(t0, 'the')::INT + contains(t1, ' and ')::INT + contains(t2, 'THE')::INT + contains(t3, 'qq')::INT)::BIGINT AS n_rules FROM c"""
)
def literal_fixes(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select("doc_id", F.md5(T.replaced(text, _FIXES)).alias("digest"), T.rules_hit(text, _FIXES).alias("n_rules"))


@query("SELECT c_custkey, replace(lower(trim(c_name)), ' ', '_') AS key, '@' || replace(lower(trim(c_name)), ' ', '_') AS ref, starts_with(c_name, 'Customer') AS is_named FROM customer")
def key_normalise(spark, sf):
    key = T.key_of(F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", key.alias("key"), T.ref(key).alias("ref"), F.col("c_name").startswith("Customer").alias("is_named"))


_NOISE = ["The", "And", "Ing", "Ereation"]
_SKIP = ["that", "with", "this", "from", "der", "die"]


@query(
    f"SELECT word, count(*)::BIGINT AS n FROM ({_NAMES}) WHERE length(word) >= 3 AND NOT ends_with(word, '-') AND word NOT IN ('The', 'And', 'Ing', 'Ereation') AND lower(word) NOT IN ('that', 'with', 'this', 'from', 'der', 'die') GROUP BY word"
)
def name_validity(spark, sf):
    noise, skip = (spark.createDataFrame([(w,) for w in x], "word string") for x in (_NOISE, _SKIP))
    return entities.valid_names(_counted(spark, sf), "word", noise, skip)


@query(
    f"""WITH w AS (SELECT word, lower(word) AS w, length(word) AS n, count(*)::BIGINT AS n_mentions FROM ({_NAMES}) GROUP BY word)
SELECT word, n_mentions FROM w WHERE (ends_with(w, 'ly') AND n > 4) OR ((ends_with(w, 'ing') OR ends_with(w, 'tion') OR ends_with(w, 'sion') OR ends_with(w, 'ness') OR ends_with(w, 'ment')) AND n > 5)
OR (ends_with(w, 'ed') AND n > 4 AND NOT contains('aeiou', substr(w, n - 2, 1)))"""
)
def english_heuristic(spark, sf):
    return _counted(spark, sf).filter(T.english_suffix(F.col("word"))).select("word", F.col("n").alias("n_mentions"))


# spelling


@query(
    f"""WITH w AS (SELECT word, count(*)::BIGINT AS n FROM ({_NAMES}) WHERE length(word) >= 5 GROUP BY word)
SELECT a.word AS a, b.word AS b, a.n AS n_a, b.n AS n_b FROM w a JOIN w b ON a.word[1] = b.word[1] AND a.word < b.word AND abs(length(a.word) - length(b.word)) <= 1
WHERE greatest(a.n, b.n) >= 3 AND levenshtein(a.word, b.word) = 1"""
)
def edit_distance_pairs(spark, sf):
    return fuzzy.spelling_pairs(_counted(spark, sf), "word", "n")


@query(
    f"""WITH w AS (SELECT DISTINCT word FROM ({_NAMES})),
p AS (SELECT word, CASE WHEN ends_with(word, 's') AND EXISTS (SELECT 1 FROM w x WHERE x.word = left(w.word, length(w.word) - 1)) THEN left(word, length(word) - 1)
  WHEN regexp_matches(word, '(aa|ee|ii|oo|uu)$') AND EXISTS (SELECT 1 FROM w x WHERE x.word = left(w.word, length(w.word) - 1)) THEN left(word, length(word) - 1) END AS parent FROM w)
SELECT word, parent FROM p WHERE parent IS NOT NULL"""
)
def variant_groups(spark, sf):
    return fuzzy.variant_parents(_names(spark, sf), "word").filter("parent IS NOT NULL")


@query(
    f"""WITH RECURSIVE w AS (SELECT DISTINCT word FROM ({_NAMES})),
p AS (SELECT word, CASE WHEN (ends_with(word, 's') OR regexp_matches(word, '(aa|ee|ii|oo|uu)$')) AND EXISTS (SELECT 1 FROM w x WHERE x.word = left(w.word, length(w.word) - 1)) THEN left(word, length(word) - 1) END AS parent FROM w),
r AS (SELECT word, word AS top, parent FROM p UNION ALL SELECT r.word, p.word, p.parent FROM r JOIN p ON r.parent = p.word)
SELECT word, top AS root FROM r WHERE parent IS NULL"""
)
def variant_roots(spark, sf):
    forest = fuzzy.variant_parents(_names(spark, sf), "word")
    return graph.roots(forest, "word", "parent").select(F.col("key").alias("word"), "root")


@query(
    f"""WITH RECURSIVE w AS (SELECT word, count(*) AS n FROM ({_NAMES}) WHERE length(word) >= 5 GROUP BY word),
e AS (SELECT a.word AS a, b.word AS b FROM w a JOIN w b ON a.word[1] = b.word[1] AND a.word < b.word AND abs(length(a.word) - length(b.word)) <= 1
  WHERE levenshtein(a.word, b.word) = 1 AND least(a.n, b.n) <= 3 AND greatest(a.n, b.n) >= 20 AND length(CASE WHEN a.n <= b.n THEN a.word ELSE b.word END) >= 7),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS id, a AS other FROM s UNION SELECT r.id, s.b FROM r JOIN s ON r.other = s.a)
SELECT id AS word, min(other) AS component FROM r GROUP BY id"""
)
def spelling_components(spark, sf):
    return fuzzy.spelling_clusters(fuzzy.spelling_pairs(_counted(spark, sf), "word", "n")).select(F.col("id").alias("word"), "component")


@query(
    f"""WITH w AS (SELECT word, count(*)::BIGINT AS n FROM ({_NAMES}) GROUP BY word)
SELECT lower(left(word, 4)) AS cluster, arg_min(word, (-n, word)) AS best, sum(n)::BIGINT AS n_total, string_agg(word, ',' ORDER BY word) AS words FROM w GROUP BY 1"""
)
def best_names(spark, sf):
    own = _counted(spark, sf).withColumn("cluster", F.lower(F.substring("word", 1, 4)))
    return fuzzy.best_names(own, "word", "n", "cluster").withColumn("words", F.array_join("words", ","))


@query(
    f"""WITH w AS (SELECT doc_id, list_distinct(list(word)) AS ws FROM ({_NAMES}) GROUP BY doc_id)
SELECT doc_id, len(list_filter(ws, lambda a: NOT (ends_with(a, 's') AND list_contains(ws, left(a, length(a) - 1)))))::BIGINT AS n_kept FROM w"""
)
def alias_plural_cleanup(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", F.array_distinct(T.names(F.col("text"))).alias("ws")).filter(F.size("ws") > 0)
    return own.select("doc_id", long(F.size(entities.plural_aliases_removed(F.col("ws")))).alias("n_kept"))


# geography

_POINTS = "SELECT s_suppkey, 8 + (s_suppkey * 37 % 280) / 10.0 AS lat, 68 + (s_suppkey * 91 % 290) / 10.0 AS lng FROM supplier"
_KM = "2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h))"


@query(
    f"""WITH p AS ({_POINTS}), q AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2) AS h
  FROM p a JOIN p b ON a.s_suppkey <> b.s_suppkey)
SELECT a, b, round_even({_KM}, 0)::BIGINT AS km FROM q WHERE {_KM} <= 500"""
)
def nearby_suppliers(spark, sf):
    k = F.col("s_suppkey")
    points = table(spark, sf, "supplier").select("s_suppkey", (8 + (k * 37 % 280) / 10.0).alias("lat"), (68 + (k * 91 % 290) / 10.0).alias("lng"))
    return assemble.nearby(points, "s_suppkey", "lat", "lng", 500)


# ordered rows


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS current FROM conversations")
def chapter_forward_fill(spark, sf):
    own = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return segments.forward_fill(own, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "current").drop("role")


_LINES = "SELECT l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS ord FROM lineitem"
_RUNS = """SELECT *, sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY ord ROWS UNBOUNDED PRECEDING) AS seg FROM l"""


def _lines(spark, sf):
    own = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_shipdate", "l_orderkey", "l_partkey")
    w = W.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    return own.withColumn("ord", long(F.row_number().over(w)))


@query(
    f"""WITH l AS ({_LINES}), s AS ({_RUNS}), t AS (SELECT l_suppkey, seg, max(l_linenumber) AS top FROM s GROUP BY ALL),
k AS (SELECT l_suppkey, seg, sum(split) OVER (PARTITION BY l_suppkey ORDER BY seg ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN lag(top) OVER (PARTITION BY l_suppkey ORDER BY seg) >= 7 THEN 1 ELSE 0 END AS split FROM t))
SELECT s.l_suppkey, k.run::BIGINT AS run, count(*)::BIGINT AS n_defs, max(s.l_linenumber)::BIGINT AS top FROM s JOIN k ON s.l_suppkey = k.l_suppkey AND s.seg = k.seg GROUP BY ALL"""
)
def def_runs(spark, sf):
    return segments.runs(_lines(spark, sf), ["l_suppkey"], ["ord"], "l_linenumber", 7).groupBy("l_suppkey", "run").agg(F.count(F.lit(1)).alias("n_defs"), long(F.max("l_linenumber")).alias("top"))


_GROUPS = "SELECT l_suppkey, l_orderkey, min(l_linenumber) AS low, max(l_linenumber) AS high FROM lineitem GROUP BY ALL"


def _groups(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"))


_REF_RUNS = f"""g AS ({_GROUPS}), f AS (SELECT *, CASE WHEN low <= 3 AND row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) > 1 THEN 1 ELSE 0 END AS is_first FROM g),
s AS (SELECT *, sum(is_first) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS UNBOUNDED PRECEDING) AS seg FROM f), t AS (SELECT l_suppkey, seg, max(high) AS top FROM s GROUP BY ALL),
k AS (SELECT l_suppkey, seg, sum(split) OVER (PARTITION BY l_suppkey ORDER BY seg ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN lag(top) OVER (PARTITION BY l_suppkey ORDER BY seg) >= 5 THEN 1 ELSE 0 END AS split FROM t)),
r AS (SELECT s.l_suppkey, s.l_orderkey, s.low, s.high, k.run::BIGINT AS run FROM s JOIN k ON s.l_suppkey = k.l_suppkey AND s.seg = k.seg)"""


@query(f"WITH {_REF_RUNS} SELECT l_suppkey, l_orderkey, run FROM r")
def ref_run_boundaries(spark, sf):
    return segments.ref_runs(_groups(spark, sf), ["l_suppkey"], ["l_orderkey"], "low", "high", 5).select("l_suppkey", "l_orderkey", "run")


@query(f"WITH {_REF_RUNS} SELECT l_suppkey, run, arg_min(low, l_orderkey)::BIGINT AS first, arg_max(low, l_orderkey)::BIGINT AS last, min(l_orderkey) AS start FROM r GROUP BY ALL")
def run_headers(spark, sf):
    own = segments.ref_runs(_groups(spark, sf), ["l_suppkey"], ["l_orderkey"], "low", "high", 5).withColumn("low", long("low"))
    return segments.run_headers(own, ["l_suppkey"], "run", "low", "l_orderkey")


_TRIES = ", ".join(f"({i}, {t})" for i, t in enumerate(segments.THRESHOLDS))


@query(
    f"""WITH h(i, th) AS (VALUES {_TRIES}), l AS ({_LINES}), s AS ({_RUNS}), t AS (SELECT l_suppkey, seg, max(l_linenumber) AS top FROM s GROUP BY ALL),
a AS (SELECT l_suppkey, i, th, 1 + sum(CASE WHEN prev >= th THEN 1 ELSE 0 END) AS n FROM (SELECT *, lag(top) OVER (PARTITION BY l_suppkey ORDER BY seg) AS prev FROM t) x, h GROUP BY ALL),
g AS ({_GROUPS}), f AS (SELECT *, CASE WHEN low <= 3 AND row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) > 1 THEN 1 ELSE 0 END AS is_first FROM g),
gs AS (SELECT *, sum(is_first) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS UNBOUNDED PRECEDING) AS seg FROM f), gt AS (SELECT l_suppkey, seg, max(high) AS top FROM gs GROUP BY ALL),
b AS (SELECT l_suppkey, i, th, 1 + sum(CASE WHEN prev >= th THEN 1 ELSE 0 END) AS m FROM (SELECT *, lag(top) OVER (PARTITION BY l_suppkey ORDER BY seg) AS prev FROM gt) x, h GROUP BY ALL)
SELECT l_suppkey, arg_min(th, (abs(n - m), i))::BIGINT AS threshold, arg_min(n, (abs(n - m), i))::BIGINT AS n_number_runs, arg_min(m, (abs(n - m), i))::BIGINT AS n_group_runs FROM a JOIN b USING (l_suppkey, i, th) GROUP BY l_suppkey"""
)
def adaptive_threshold(spark, sf):
    return segments.best_threshold(_lines(spark, sf).select("l_suppkey", "l_linenumber", "ord"), _groups(spark, sf), ["l_suppkey"], "l_linenumber", ["ord"], "low", "high", ["l_orderkey"])


@query(
    """WITH d AS (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem WHERE l_quantity < 10), r AS (SELECT l.l_returnflag, d.l_suppkey AS hit FROM lineitem l LEFT JOIN d ON l.l_suppkey = d.l_suppkey AND l.l_linenumber = d.l_linenumber)
SELECT l_returnflag, count(*)::BIGINT AS n_refs, count(hit)::BIGINT AS n_matched, bool_and(hit IS NOT NULL) AS all_ok, CASE WHEN count(*) > 0 THEN printf('%.1f%%', count(hit) * 100.0 / count(*)) ELSE '0%' END AS share FROM r GROUP BY ROLLUP (l_returnflag)"""
)
def footnote_verify(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_quantity")
    return footnotes.verified(lines.drop("l_quantity"), lines.filter("l_quantity < 10"), ["l_suppkey", "l_linenumber"], "l_returnflag")


@query(
    """WITH d AS (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem WHERE l_quantity < 4)
SELECT l_orderkey, l_suppkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.l_suppkey = l.l_suppkey AND d.l_linenumber = l.l_linenumber)"""
)
def footnote_unmatched(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    return footnotes.unmatched(lines.drop("l_quantity"), lines.filter("l_quantity < 4"), ["l_suppkey", "l_linenumber"]).select("l_orderkey", "l_suppkey", "l_linenumber")


@query(
    """WITH o AS (SELECT o_custkey % 10 AS part, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 10 ORDER BY o_orderkey) AS position FROM orders),
c AS (SELECT c_custkey % 10 AS part, c_name, row_number() OVER (PARTITION BY c_custkey % 10 ORDER BY c_custkey) AS position FROM customer)
SELECT o.part, o.position, o_orderkey, c_name FROM o LEFT JOIN c ON o.part = c.part AND o.position = c.position"""
)
def positional_zip(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 10).alias("part"), "o_orderkey")
    c = table(spark, sf, "customer").select((F.col("c_custkey") % 10).alias("part"), "c_custkey", "c_name")
    return scan.zipped(o, c, ["part"], ["o_orderkey"], ["c_custkey"]).select("part", "position", "o_orderkey", "c_name")


@query("SELECT event_type, event_id, expected FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS expected FROM events) WHERE event_id <> expected")
def order_continuity(spark, sf):
    return scan.out_of_order(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"], "event_id").select("event_type", "event_id", "expected")


@query(
    """WITH v AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place, value, lag(value) OVER (ORDER BY ts, event_id) AS previous FROM events)
SELECT 'monotonic' AS "check", event_id::VARCHAR AS source_id, value::VARCHAR AS ref FROM v WHERE value < previous
UNION ALL (SELECT 'continuous', event_id::VARCHAR, event_id::VARCHAR FROM v WHERE event_id <> place ORDER BY place LIMIT 1)"""
)
def timeline_order(spark, sf):
    events = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return validate.not_monotonic("monotonic", events, "event_id", "at", "value").unionByName(validate.not_continuous("continuous", events, "event_id", "at", "event_id"))


@query("SELECT user_id, event_id, value, previous FROM (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) WHERE value < previous")
def monotonic_violations(spark, sf):
    return segments.steps_back(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value").select("user_id", "event_id", "value", "previous")


@query("SELECT source, coalesce(min(CASE WHEN n_chars > 20000 THEN doc_id END), min(CASE WHEN lang = 'es' THEN doc_id END), max(doc_id) + 15) AS page FROM documents GROUP BY source")
def first_page_matching(spark, sf):
    return segments.earliest(table(spark, sf, "documents"), ["source"], "doc_id", [F.col("n_chars") > 20000, F.col("lang") == "es"], F.max("doc_id") + 15)


@query(
    """WITH a AS (SELECT user_id, event_id, event_type, ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events),
b AS (SELECT *, max(CASE WHEN n > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS again FROM a) SELECT user_id, event_id, event_type FROM b WHERE again = 0"""
)
def dedupe_truncate(spark, sf):
    return segments.before_repeat(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type")


# entities


@query(
    """WITH m AS (SELECT lower(o_orderpriority) AS alias, arg_max(o_custkey, o_orderkey) AS k FROM orders GROUP BY 1)
SELECT o_orderkey, coalesce(m.k::VARCHAR, replace(lower(trim(q)), ' ', '_')) AS key FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' Nobody Known ' ELSE o_orderpriority END AS q FROM orders) o LEFT JOIN m ON m.alias = lower(o.q)"""
)
def alias_resolution(spark, sf):
    orders = table(spark, sf, "orders")
    aliases = orders.select("o_orderpriority", F.col("o_custkey").cast("string").alias("k"), "o_orderkey")
    asked = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, " Nobody Known ").otherwise(F.col("o_orderpriority")).alias("q"))
    return entities.resolved(asked, "q", entities.alias_map(aliases, "o_orderpriority", "k", "o_orderkey")).select("o_orderkey", "key")


@query(
    """SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderpriority <> '5-LOW') AS o_orderpriority FROM orders GROUP BY o_custkey"""
)
def attribute_fold(spark, sf):
    own = table(spark, sf, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return entities.fold(own, "o_custkey", "o_orderkey", first=["o_orderstatus"], last=["o_orderpriority"])


@query(
    """WITH o AS (SELECT o_custkey, o_orderpriority AS p, min(o_orderkey) AS k FROM orders GROUP BY ALL) SELECT o_custkey, string_agg(p, '|' ORDER BY k) AS priorities FROM o GROUP BY o_custkey"""
)
def ordered_distinct(spark, sf):
    own = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.array("o_orderpriority").alias("p"))
    return entities.fold(own, "o_custkey", "o_orderkey", lists=["p"]).select("o_custkey", F.array_join("p", "|").alias("priorities"))


@query(
    """WITH e AS (SELECT c_custkey AS src, c_nationkey AS dst FROM customer), m AS (SELECT n_nationkey AS old_key, 100 + n_regionkey AS new_key FROM nation WHERE n_nationkey % 2 = 0)
SELECT coalesce(m.new_key, e.dst)::BIGINT AS dst, count(*)::BIGINT AS n FROM e LEFT JOIN m ON e.dst = m.old_key GROUP BY 1"""
)
def merge_map_rewrite(spark, sf):
    edges = table(spark, sf, "customer").select(F.col("c_custkey").alias("src"), long("c_nationkey").alias("dst"))
    rules = table(spark, sf, "nation").filter("n_nationkey % 2 = 0").select(long("n_nationkey").alias("old_key"), long(F.col("n_regionkey") + 100).alias("new_key"))
    return assemble.histogram(entities.remapped(edges, ["dst"], rules), "dst")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def dangling_refs(spark, sf):
    return entities.existing(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], table(spark, sf, "customer").filter("c_acctbal > 0"), "c_custkey").select("o_orderkey", "o_custkey")


@query(
    """WITH p AS (SELECT c_custkey AS child, c_custkey * 7 % 500 AS parent FROM customer), s AS (SELECT c_custkey AS a, c_custkey * 3 % 500 AS b FROM customer),
y AS (SELECT a, b FROM s WHERE a <> b UNION SELECT b, a FROM s WHERE a <> b)
SELECT a, b FROM y WHERE NOT EXISTS (SELECT 1 FROM p WHERE (child = a AND parent = b) OR (child = b AND parent = a))"""
)
def conflict_edges(spark, sf):
    k = F.col("c_custkey")
    own = table(spark, sf, "customer")
    spouses = graph.symmetric(own.select(k.alias("a"), (k * 3 % 500).alias("b")), "a", "b")
    return graph.not_parental(spouses, own.select(k.alias("child"), (k * 7 % 500).alias("parent"))).select("a", "b")


@query(
    """WITH p AS (SELECT c_custkey AS child, CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 1 ELSE c_custkey - 1 END AS parent, CASE WHEN c_custkey % 3 = 0 THEN 'mother' ELSE 'father' END AS role FROM customer)
SELECT child, parent, role FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.child = p.parent AND q.parent = p.child AND q.role = p.role AND q.child < p.child)"""
)
def parent_circles(spark, sf):
    k = F.col("c_custkey")
    role = F.when(k % 3 == 0, "mother").otherwise("father")
    parents = table(spark, sf, "customer").select(k.alias("child"), F.when(k % 2 == 0, k + 1).otherwise(k - 1).alias("parent"), role.alias("role"), k.alias("ord"))
    return graph.without_circles(parents).select("child", "parent", "role")


_TREE = "SELECT c_custkey AS key, CASE WHEN c_custkey > 1 THEN c_custkey // 2 END AS father FROM customer"


def _tree(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("key"), F.when(k > 1, F.floor(k / 2)).alias("father"))


@query(f"SELECT father AS parent, count(*)::BIGINT AS n_children, string_agg(key::VARCHAR, ',' ORDER BY key) AS children FROM ({_TREE}) WHERE father IS NOT NULL GROUP BY father")
def children_by_parent(spark, sf):
    own = graph.children(_tree(spark, sf), "key", "father")
    return own.select("parent", "n_children", F.array_join(F.transform("children", lambda c: c.cast("string")), ",").alias("children"))


@query(
    f"""WITH t AS ({_TREE}), p AS (SELECT key AS child, father AS parent FROM t WHERE father IS NOT NULL UNION SELECT key, father + 1 FROM t WHERE father IS NOT NULL AND key % 3 > 0),
s AS (SELECT key AS a, key + 1 AS b FROM t WHERE key % 2 = 0 UNION SELECT key + 1, key FROM t WHERE key % 2 = 0),
j AS (SELECT p.parent, p.child, min(s.b) AS spouse FROM p LEFT JOIN p o ON o.child = p.child AND o.parent <> p.parent LEFT JOIN s ON s.a = p.parent AND s.b = o.parent GROUP BY p.parent, p.child)
SELECT parent, child, spouse FROM j"""
)
def attributed_children(spark, sf):
    t = _tree(spark, sf)
    own = t.filter("father IS NOT NULL")
    parents = own.select(F.col("key").alias("child"), F.col("father").alias("parent")).unionByName(own.filter("key % 3 > 0").select(F.col("key").alias("child"), (F.col("father") + 1).alias("parent")))
    return graph.attributed_children(parents, graph.symmetric(t.filter("key % 2 = 0").select("key", (F.col("key") + 1).alias("b")), "key", "b"))


@query(
    f"""WITH t AS ({_TREE}) SELECT a.key, b.father AS grandfather, c.father AS great_grandfather FROM t a JOIN t b ON a.father = b.key LEFT JOIN t c ON b.father = c.key WHERE b.father IS NOT NULL"""
)
def lineage_two_hop(spark, sf):
    return graph.lineage(_tree(spark, sf))


# documents, statistics, checks


@query(
    """SELECT n_name, count(*)::BIGINT AS n_events, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS events FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
)
def events_per_location(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = orders.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("o", F.struct("o_orderdate", "o_orderkey"))
    return assemble.events_by(rows, "n_name", "o", "o_orderkey").withColumn("events", F.array_join(F.transform("events", lambda e: e.cast("string")), ","))


@query(
    """WITH p AS (SELECT l_orderkey, unnest([l_suppkey, l_partkey % 100]) AS who FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_partkey FROM lineitem)), d AS (SELECT DISTINCT who, l_orderkey FROM p)
SELECT s_name, count(*)::BIGINT AS n_events, string_agg(l_orderkey::VARCHAR, ',' ORDER BY l_orderkey) AS events FROM d JOIN supplier ON s_suppkey = who GROUP BY s_name"""
)
def events_per_participant(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.explode(F.array(F.col("l_suppkey"), F.col("l_partkey") % 100)).alias("s_suppkey")).distinct()
    rows = lines.join(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
    return assemble.events_by(rows, "s_name", "l_orderkey", "l_orderkey").withColumn("events", F.array_join(F.transform("events", lambda e: e.cast("string")), ","))


@query("""SELECT count(*) FILTER (c_acctbal > 0)::BIGINT AS n_positive, count(*) FILTER (c_mktsegment = 'BUILDING')::BIGINT AS n_building, count(*) FILTER (c_nationkey IS NULL)::BIGINT AS n_homeless, count(*)::BIGINT AS n_all FROM customer""")
def builder_stats(spark, sf):
    metrics = {"n_positive": F.col("c_acctbal") > 0, "n_building": F.col("c_mktsegment") == "BUILDING", "n_homeless": F.col("c_nationkey").isNull(), "n_all": F.lit(True)}
    return assemble.statistics(table(spark, sf, "customer"), metrics)


@query("SELECT p_type, count(*)::BIGINT AS n FROM part GROUP BY p_type")
def type_histogram(spark, sf):
    return assemble.histogram(table(spark, sf, "part"), "p_type")


@query(
    """WITH v AS (SELECT 'customer exists' AS c FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
UNION ALL SELECT 'nation exists' FROM customer WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey)
UNION ALL (SELECT 'continuous' FROM (SELECT r_regionkey, row_number() OVER (ORDER BY r_regionkey) AS e FROM region) WHERE r_regionkey <> e LIMIT 1)
UNION ALL SELECT 'monotonic' FROM (SELECT n_regionkey, lag(n_regionkey) OVER (ORDER BY n_nationkey) AS p FROM nation) WHERE n_regionkey < p)
SELECT k.c AS "check", count(v.c)::BIGINT AS n_violations, count(v.c) = 0 AS ok FROM (VALUES ('customer exists'), ('nation exists'), ('continuous'), ('monotonic')) k(c) LEFT JOIN v ON v.c = k.c GROUP BY k.c"""
)
def violations_summary(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    at = lambda c: T.ref(F.col(c).cast("string")).alias("ref")
    found = [
        validate.missing_refs("customer exists", table(spark, sf, "orders").select("o_orderkey", at("o_custkey")), "o_orderkey", "ref", customer.filter("c_acctbal > 0"), "c_custkey"),
        validate.missing_refs("nation exists", customer.select("c_custkey", at("c_nationkey")), "c_custkey", "ref", nation, "n_nationkey"),
        validate.not_continuous("continuous", table(spark, sf, "region"), "r_name", "r_regionkey", "r_regionkey"),
        validate.not_monotonic("monotonic", nation, "n_name", "n_nationkey", "n_regionkey"),
    ]
    return validate.summary(spark, found, ["customer exists", "nation exists", "continuous", "monotonic"])


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'bolt') OR contains(lower(p_brand), 'bolt') OR contains(lower(p_type), 'bolt') OR contains(p_size::VARCHAR, 'bolt')")
def keyword_search(spark, sf):
    return search.search(table(spark, sf, "part"), "  BOLT ", ["p_name", "p_brand", "p_type", "p_size"]).select("p_partkey", "p_name")


@query(
    """SELECT c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN '#aa3300' WHEN 'MACHINERY' THEN '#0033aa' ELSE '#888888' END AS colour, CASE c_mktsegment WHEN 'BUILDING' THEN 9 WHEN 'MACHINERY' THEN 7 ELSE 5 END AS radius, count(*)::BIGINT AS n FROM customer GROUP BY ALL"""
)
def type_style_lookup(spark, sf):
    styled = search.styled(table(spark, sf, "customer"), "c_mktsegment", {"BUILDING": ("#aa3300", 9), "MACHINERY": ("#0033aa", 7)}, ("#888888", 5))
    return styled.groupBy("c_mktsegment", "colour", "radius").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT '@' || n_nationkey AS id, n_name, n_regionkey FROM nation")
def json_export(spark, sf):
    one = assemble.one_object(assemble.as_json(table(spark, sf, "nation"), "n_nationkey"))
    return assemble.from_object(one, "json", "struct<n_name:string,n_regionkey:int>").select("id", "record.n_name", "record.n_regionkey")

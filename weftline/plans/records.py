"""Registered queries from texts to finished records: fixes by rule tables, boundaries of volumes, entries, documents, figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.functions import text as T
from weftline.operators import docparse, documents, graph, mentions, records, rules, scan, segments
from weftline.plans import knowledge as graph_plan
from weftline.plans.catalogue import _LINES, _NAMES, _counted, _lines, query
from weftline.session import table

# fixes: rules are the words of the benchmark, by the remainder of their length; what one puts in can be the next one's word

_RULES = r"""r AS (SELECT length(w) % 4 AS volume, row_number() OVER (PARTITION BY length(w) % 4 ORDER BY w) AS ord, w AS old, translate(w, 'eaih', 'aeht') || CASE WHEN length(w) % 3 = 0 THEN chr(10) ELSE '' END AS new
  FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{7,}')) AS w FROM benchmark))"""
_FIXED = rf"""WITH {_RULES}, l AS (SELECT volume, list({{'old': old, 'new': new, 'hits': ord::VARCHAR || ','}} ORDER BY ord) AS rs FROM r GROUP BY volume),
f AS (SELECT doc_id, doc_id % 5 AS volume, list_reduce(list_prepend({{'old': text, 'new': '', 'hits': ''}}, coalesce(rs, [])), lambda a, x: {{'old': replace(a.old, x.old, x.new), 'new': '', 'hits': a.hits || CASE WHEN contains(a.old, x.old) THEN x.hits ELSE '' END}}) AS x
  FROM documents d LEFT JOIN l ON l.volume = d.doc_id % 5)"""


def _fixed(spark, sf, hits_only: bool = False) -> DataFrame:
    own = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 5).alias("volume"), "text")
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{7,}"), F.lit(0))).alias("w")).distinct()
    new = F.concat(F.translate("w", "eaih", "aeht"), F.when(F.length("w") % 3 == 0, "\n").otherwise(""))
    volume = (F.length("w") % 4).cast("long").alias("volume")
    # the number of a rule in its volume only orders it
    numbered = words.select(volume, F.col("w").alias("old"), new.alias("new"))
    numbered = scan.ranked(numbered, ["volume"], ["old"], "_at", "_n").select("volume", (F.col("_at") + 1).alias("ord"), "old", "new")
    return rules.fixed(own, numbered, ["volume"], hits_only=hits_only)


@query(f"{_FIXED} SELECT doc_id, volume, x.old AS text, x.hits AS hits FROM f")
def fixes_by_rules(spark, sf):
    with graph.scratch(spark) as keep:
        hits = F.array_join(F.transform("hits", lambda h: F.concat(h.cast("string"), F.lit(","))), "")
        return keep(_fixed(spark, sf).select("doc_id", "volume", "text", hits.alias("hits")), "fixed")


@query(f"{_FIXED} SELECT volume, ord, count(*)::BIGINT AS n_texts FROM (SELECT volume, unnest(string_split(rtrim(x.hits, ','), ','))::BIGINT AS ord FROM f WHERE x.hits <> '') GROUP BY volume, ord")
def fixes_counted(spark, sf):
    with graph.scratch(spark) as keep:
        return keep(rules.counted(_fixed(spark, sf, True), ["volume"]), "counts")


# boundaries: pages are documents, twelve volumes of them, with headings by volume and page (an expression of both dialects)

_HEADED = r"""CASE WHEN volume % 3 <> 2 AND page % 29 = 17 THEN 'Acknowledgements' || chr(10)
 WHEN volume % 4 = 0 AND page % 31 = 20 THEN 'Footnotes' || chr(10) WHEN volume % 4 = 1 AND page % 13 = 6 THEN 'Section ' || page || chr(10) || '1 x' || chr(10) || '2y' || chr(10)
 WHEN volume % 2 = 0 AND page % 9 = volume % 5 THEN 'Section One' || chr(10) WHEN volume <> 11 AND page % 7 = 3 THEN 'x' || chr(10) || 'Chapter 3(4): y' || chr(10) ELSE '' END
 || CASE WHEN volume % 8 = 4 AND page % 31 = 20 THEN '' WHEN volume % 4 = 2 AND page % 5 = 4 THEN '1 a' || chr(10) || '2 b' || chr(10) || '3  c' ELSE coalesce(text, '') END"""
_VOLUMES = "SELECT doc_id % 12 AS volume, cast(floor(doc_id / 12) AS BIGINT) + 3 AS page, text FROM documents"
_SQUEEZED = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')"


def _pages(spark, sf) -> DataFrame:
    own = table(spark, sf, "documents").selectExpr("doc_id % 12 AS volume", "cast(floor(doc_id / 12) AS BIGINT) + 3 AS page", "text")
    return own.select("volume", "page", F.expr(_HEADED).alias("text"))


@query(
    rf"""WITH p AS MATERIALIZED (SELECT volume, page, {_HEADED} AS text FROM ({_VOLUMES})), v AS (SELECT volume, min(page) AS s, max(page) AS e FROM p GROUP BY volume),
l AS MATERIALIZED (SELECT p.volume, page, s, e, {_SQUEEZED} AS ls FROM p JOIN v ON p.volume = v.volume AND page < e),
c AS (SELECT volume, coalesce(min(page) FILTER (len(list_filter(ls, lambda x: regexp_matches(x, '^Section\s+[A-Z][a-z]'))) > 0), min(page) FILTER (page < s + 50 AND len(list_filter(ls, lambda x: regexp_matches(x, '^Chapter\s+[0-9]+\([0-9]+\)\s*:'))) > 0), min(s + 15)) AS content FROM l GROUP BY volume),
a AS (SELECT volume, min(page) AS ack FROM l WHERE page >= s + (e - s) // 2 AND len(list_filter(ls[:3], lambda x: regexp_matches(x, '^Acknowledgements?$'))) > 0 GROUP BY volume),
k AS (SELECT v.volume, s, e, coalesce(content, s + 15) AS content, ack FROM v LEFT JOIN c USING (volume) LEFT JOIN a USING (volume)),
n AS (SELECT l.volume, l.page, len(ls) <= 3 AND len(list_filter(ls, lambda x: contains(x, 'Footnotes'))) > 0 AS alone, k.s, k.e, content, ack FROM l JOIN k USING (volume)
  WHERE ls[1] = 'Footnotes' OR (regexp_matches(ls[1], '^Section\s+') AND len(list_filter(ls, lambda x: regexp_matches(x, '^[0-9]+\s*\S'))) >= 2) OR (len(list_filter(ls, lambda x: regexp_matches(x, '^[0-9]+\s*[A-Za-z]'))) >= 3 AND 2 * len(list_filter(ls, lambda x: regexp_matches(x, '^[0-9]+\s*[A-Za-z]'))) >= len(ls))),
b AS (SELECT volume, coalesce(arg_min(page + alone::INT, page) FILTER (page > ack), arg_min(page + alone::INT, page) FILTER (page < ack AND page >= greatest(content, ack - (e - s) // 2)), arg_min(page + alone::INT, page) FILTER (ack IS NULL AND page >= e - greatest(1, (e - s) // 5))) AS notes FROM n GROUP BY volume)
SELECT k.volume, content::BIGINT AS content_start, ack::BIGINT AS ack_page, notes::BIGINT AS notes_start, least(e, ack, notes)::BIGINT AS body_end FROM k LEFT JOIN b ON b.volume = k.volume"""
)
def volume_boundaries(spark, sf):
    with graph.scratch(spark) as keep:
        own = graph.stored(_pages(spark, sf), "pages")
        blocks = own.select("volume", "page", F.posexplode(F.split("text", "\n")).alias("block_no", "text")).withColumn("type", F.lit(0))
        volumes = own.groupBy("volume").agg(F.min("page").alias("start_page"), F.max("page").alias("end_page"))
        return keep(docparse.boundaries(own, blocks, volumes), "boundaries")


# numbers of notes: a document is a volume, its sentences are lines, some of them with numbers or headings (both dialects)

_NOTED = r"""CASE c WHEN 0 THEN 'Chapter ' || i WHEN 1 THEN 'Section ' || i WHEN 2 THEN 'Adi Parva' WHEN 3 THEN 'Footnotes'
 WHEN 4 THEN n || ' Ab ' || p WHEN 5 THEN n || 'Ab ' || p WHEN 6 THEN n || ' Ab ' || p WHEN 7 THEN n || ' (' || p WHEN 8 THEN n || ' (' || p WHEN 9 THEN 'x ' || p || '. ' || n || ' Tail ' || p
 WHEN 10 THEN n || ' Ab ' || p || '! ' || (n + 1) || ' Next' WHEN 11 THEN '1 Again ' || p WHEN 12 THEN (n + 60) || ' Years ' || p WHEN 13 THEN 'y? ' || n || ' z. ' || (n + 1) || ' z' ELSE p END"""
_SENTENCE_PARTS = ("replace(p, chr(10), ' ') AS p", "i", "(doc_id * 5 + i * 3 + length(p)) % 17 AS c", "cast(floor(i * 2 / 3) AS BIGINT) + length(p) % 3 AS n")
_SENTENCE = ", ".join(_SENTENCE_PARTS)


@query(
    rf"""WITH RECURSIVE s AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS i FROM (SELECT doc_id, string_split(text, '. ') AS ps FROM documents)),
w AS (SELECT doc_id AS volume, i, trim({_NOTED}) AS line FROM (SELECT doc_id, {_SENTENCE} FROM s)),
h AS (SELECT volume, row_number() OVER (PARTITION BY volume ORDER BY i) AS seq, line, CASE WHEN regexp_matches(line, '^Chapter\s+[0-9]+(\([0-9]+\))?\s*$') THEN 'chapter' WHEN regexp_matches(line, '^Section\s+') AND length(line) < 80 THEN 'section'
  WHEN regexp_matches(line, '^[A-Z].*[Pp]arva') AND length(line) < 80 THEN 'parva' WHEN line IN ('Footnotes', 'Introduction') THEN 'skip' END AS head FROM w WHERE line <> ''),
l AS MATERIALIZED (SELECT *, nullif(regexp_extract(line, '^([0-9]+)\s*[A-Za-z]', 1), '')::BIGINT AS lead, nullif(regexp_extract(line, '^([0-9]+)\s', 1), '')::BIGINT AS bare FROM h),
r AS (SELECT volume, 0::BIGINT AS seq, 0::BIGINT AS last, false AS is_open, NULL::VARCHAR AS kind, NULL::BOOLEAN AS again, NULL::VARCHAR AS line, false AS cut, 0::BIGINT AS upto FROM (SELECT DISTINCT volume FROM l)
  UNION ALL
  SELECT volume, seq, CASE WHEN head = 'chapter' THEN 0 ELSE now + cut::INT END, CASE WHEN head IS NULL THEN is_open OR begins ELSE is_open AND head IN ('parva', 'skip') END,
    CASE WHEN head IS NULL THEN CASE WHEN begins THEN 'note' WHEN is_open THEN 'more' ELSE 'loose' END END, again, line, cut, now + 1
  FROM (SELECT *, head IS NULL AND ((lead IS NOT NULL AND begins) OR (is_open AND lead IS NULL AND NOT begins)) AND regexp_matches(line, '[.!?]\s+' || (now + 1) || '\s+\S') AS cut
    FROM (SELECT *, CASE WHEN begins THEN coalesce(lead, bare) ELSE last END AS now
      FROM (SELECT *, head IS NULL AND (first OR (is_open AND lead IS NULL AND coalesce(bare = last + 1, false))) AS begins, first AND lead = 1 AND last > 1 AS again
        FROM (SELECT l.*, r.last, r.is_open, head IS NULL AND lead IS NOT NULL AND (r.last = 0 OR lead = 1 OR lead - r.last BETWEEN 0 AND 50) AS first FROM r JOIN l ON l.volume = r.volume AND l.seq = r.seq + 1))))),
o AS (SELECT * FROM r WHERE kind IS NOT NULL)
SELECT volume, seq, 0 AS part, kind, again, trim(CASE WHEN cut THEN regexp_extract(line, '^(.*?[.!?])\s+' || upto || '\s+\S', 1) ELSE line END) AS text FROM o
UNION ALL SELECT volume, seq, 1, 'note', false, trim(regexp_extract(line, '^.*?[.!?]\s+(' || upto || '\s+\S.*)$', 1)) FROM o WHERE cut"""
)
def note_numbers(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"\. ")).alias("i", "p")).withColumn("i", F.col("i").cast("long"))
    lines = own.selectExpr("doc_id", *_SENTENCE_PARTS).selectExpr("doc_id AS volume", "i", f"trim({_NOTED}) AS line").filter("line <> ''")
    lines = lines.withColumn("seq", F.row_number().over(W.partitionBy("volume").orderBy("i"))).select("volume", "seq", F.col("line").alias("whole"), "line")
    return docparse.note_parts(lines)


def _index(spark, sf) -> DataFrame:
    """Names and aliases of records: the names in each item of the benchmark, the first one its name."""
    words = table(spark, sf, "benchmark").select("item_id", F.posexplode(T.names(F.col("text"))).alias("at", "word"))
    return words.select("word", F.concat(F.lit("r"), "item_id").alias("id"), (F.col("at") == 0).alias("is_name"), F.col("item_id").alias("ord"))


# entries: words of documents, records named by the items of the benchmark

@query(
    rf"""WITH RECURSIVE w AS MATERIALIZED (SELECT word, count(*)::BIGINT AS n FROM ({_NAMES}) GROUP BY word),
p AS MATERIALIZED (SELECT word, n, CASE WHEN (ends_with(word, 's') OR regexp_matches(word, '(aa|ee|ii|oo|uu)$')) AND EXISTS (SELECT 1 FROM w x WHERE x.word = left(w.word, length(w.word) - 1)) THEN left(word, length(word) - 1) END AS parent FROM w),
f AS (SELECT word, n, word AS top, parent FROM p UNION ALL SELECT f.word, f.n, p.word, p.parent FROM f JOIN p ON f.parent = p.word),
g AS MATERIALIZED (SELECT word, n, top AS root FROM f WHERE parent IS NULL), t AS MATERIALIZED (SELECT root, sum(n)::BIGINT AS total FROM g GROUP BY root),
e AS (SELECT a.root AS a, b.root AS b FROM t a JOIN t b ON a.root[1] = b.root[1] AND a.root < b.root AND abs(length(a.root) - length(b.root)) <= 1 AND least(length(a.root), length(b.root)) >= 5
  WHERE least(a.total, b.total) <= 3 AND greatest(a.total, b.total) >= 20 AND length(CASE WHEN a.total <= b.total THEN a.root ELSE b.root END) >= 7 AND levenshtein(a.root, b.root) = 1),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS other FROM s UNION SELECT r.id, s.b FROM r JOIN s ON r.other = s.a),
q AS (SELECT id, min(other) AS component FROM r GROUP BY id), o AS (SELECT root, total, coalesce(component, root) AS cluster FROM t LEFT JOIN q ON q.id = t.root),
m AS MATERIALIZED (SELECT g.word, g.n, o.cluster, z.best FROM g JOIN o USING (root) JOIN (SELECT cluster, arg_min(root, (-total, root)) AS best FROM o GROUP BY cluster) z ON z.cluster = o.cluster),
x AS MATERIALIZED (SELECT item_id AS ord, 'r' || item_id AS id, unnest(ws) AS word, generate_subscripts(ws, 1) = 1 AS is_name FROM (SELECT item_id, list_filter(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'), lambda y: regexp_matches(y, '^[A-Z][a-z][a-z]+$')) AS ws FROM benchmark)),
h AS (SELECT cluster, arg_min(id, (m.word <> best, m.word, NOT is_name, ord, id)) AS id FROM m JOIN x ON x.word = m.word GROUP BY cluster),
k AS MATERIALIZED (SELECT u.cluster, best, u.n, coalesce(h.id, lower(best)) AS key FROM (SELECT cluster, best, sum(n) AS n FROM m GROUP BY cluster, best) u LEFT JOIN h ON h.cluster = u.cluster),
y AS MATERIALIZED (SELECT k.key, coalesce(any_value(x.word), arg_min(best, (-n, best))) AS name, sum(n)::BIGINT AS n, count(*)::BIGINT AS n_clusters, any_value(x.word) IS NOT NULL AS known FROM k LEFT JOIN (SELECT * FROM x WHERE is_name) x ON x.id = k.key GROUP BY k.key),
d AS (SELECT k.key, m.word FROM m JOIN k ON k.cluster = m.cluster UNION SELECT id, word FROM x),
i AS (SELECT key, word FROM d UNION SELECT key, name FROM y),
v AS (SELECT d.key, string_agg(d.word, ',' ORDER BY d.word) AS names FROM d JOIN y ON y.key = d.key WHERE d.word <> y.name AND NOT EXISTS (SELECT 1 FROM i WHERE i.key = d.key AND i.word || 's' = d.word) GROUP BY d.key)
SELECT y.key, y.name, coalesce(v.names, '') AS alias_names, y.n, y.n_clusters, y.known FROM y LEFT JOIN v ON v.key = y.key"""
)
def word_entries(spark, sf):
    with graph.scratch(spark) as keep:
        out = records.entries(graph.stored(records.clustered(_counted(spark, sf)), "clusters"), graph.stored(_index(spark, sf), "index"))
        return keep(out.withColumn("alias_names", F.array_join("alias_names", ",")), "entries")


@query(
    f"""WITH x AS (SELECT DISTINCT 'r' || item_id AS id, unnest(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda y: regexp_matches(y, '^[A-Z][a-z][a-z]+$'))) AS word FROM benchmark),
w AS (SELECT x.id, n.source AS volume, CASE WHEN doc_id % 3 > 0 THEN doc_id END AS chapter FROM ({_NAMES}) n JOIN x ON x.word = n.word),
p AS (SELECT id, volume, count(DISTINCT chapter) AS n, 'Vol' || volume || ':ch' || array_to_string(list_sort(list(DISTINCT chapter)), ',') AS spot FROM w GROUP BY id, volume)
SELECT i.id, coalesce(c.n, 0)::BIGINT AS n_mentions, coalesce(v.n, 0)::BIGINT AS n_places, coalesce(v.appearance, '') AS appearance FROM (SELECT DISTINCT id FROM x) i
LEFT JOIN (SELECT id, count(*) AS n FROM w GROUP BY id) c ON c.id = i.id LEFT JOIN (SELECT id, sum(n) AS n, string_agg(spot, ' ' ORDER BY volume) FILTER (n > 0) AS appearance FROM p GROUP BY id) v ON v.id = i.id"""
)
def record_appearances(spark, sf):
    """Two documents of three are chapters of their source, the others are notes."""
    own = table(spark, sf, "documents").select(F.col("source").alias("volume"), F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).alias("chapter"), F.explode(T.names(F.col("text"))).alias("word"))
    return mentions.of_records(own, _index(spark, sf))


_HEADED_LINES = "CASE WHEN ord % 11 = 5 THEN '--- old ---' WHEN ord % 7 = 3 THEN ' ' WHEN ord % 5 = 2 THEN 'more' ELSE l_linenumber || ' note' END"


@query(
    rf"""WITH k AS (SELECT l_suppkey, ord, {_HEADED_LINES} AS line FROM ({_LINES})), o AS (SELECT *, nullif(regexp_extract(line, '^\s*([0-9]+)\s+\S', 1), '')::BIGINT AS n, coalesce(regexp_matches(lag(line) OVER (PARTITION BY l_suppkey ORDER BY ord), '\S'), false) AS gap FROM k WHERE NOT starts_with(line, '---')),
t AS (SELECT *, sum((n = 1)::INT) OVER (PARTITION BY l_suppkey ORDER BY ord) AS seg FROM o WHERE n IS NOT NULL), g AS (SELECT l_suppkey, seg, max(n) AS top, min(ord) AS start FROM t GROUP BY ALL),
u AS (SELECT *, (coalesce(lag(top) OVER (PARTITION BY l_suppkey ORDER BY seg), 0) >= 7)::INT AS cut FROM g), r AS (SELECT l_suppkey, start, sum(cut) OVER (PARTITION BY l_suppkey ORDER BY seg) AS idx FROM u),
f AS (SELECT l_suppkey, idx, min(start) AS ord FROM r GROUP BY ALL), h AS (SELECT s_suppkey AS l_suppkey, unnest(range(0, s_suppkey % 30 + 1)) AS idx FROM supplier),
q AS (SELECT f.l_suppkey, f.ord, f.idx FROM f JOIN h ON h.l_suppkey = f.l_suppkey AND h.idx = f.idx),
e AS (SELECT l_suppkey, ord, 3 AS k, line FROM o UNION ALL SELECT q.l_suppkey, q.ord, 0, '' FROM q JOIN o ON o.l_suppkey = q.l_suppkey AND o.ord = q.ord WHERE gap UNION ALL SELECT l_suppkey, ord, 1, '--- Section ' || idx || ' ---' FROM q UNION ALL SELECT l_suppkey, ord, 2, '--- Chapters to ' || idx || ' ---' FROM q WHERE idx % 3 < 2)
SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY ord, k) - 1 AS ord, line FROM e"""
)
def section_headers(spark, sf):
    own = _lines(spark, sf).select("l_suppkey", "ord", F.expr(_HEADED_LINES).alias("line"))
    heads = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("s_suppkey") % 30)).alias("idx"))
    heads = heads.select("*", F.concat(F.lit("--- Section "), "idx", F.lit(" ---")).alias("section"), F.when(F.col("idx") % 3 < 2, F.concat(F.lit("--- Chapters to "), "idx", F.lit(" ---"))).alias("chapters"))
    return segments.section_headers(own, heads, ["l_suppkey"], "ord", "line", 7)


# documents of the people of the knowledge graph, with more fields (expressions of both dialects), and their figures

_MORE = {
    "status": "CASE WHEN length(key) % 5 = 0 THEN substr(name, 1, 2) END", "kingdom": "CASE WHEN length(key) % 3 = 0 THEN substr(key, 1, 3) END", "political_role": "CASE WHEN length(key) % 4 = 1 THEN 'Ruler' END",
    "skill": "CASE WHEN length(key) % 3 = 1 THEN substr(key, 2, 3) END", "weapon": "CASE WHEN length(key) % 7 = 2 THEN 'Bow' END", "title": "CASE WHEN length(key) % 4 = 2 THEN upper(name) END",
    "trait": "CASE WHEN length(key) % 6 = 3 THEN 'Brave' END", "arc": "CASE WHEN length(key) % 8 = 4 THEN substr(key, 1, 4) END", "place": "CASE WHEN length(key) % 5 = 1 THEN substr(key, 1, 5) END",
    "friend": "CASE WHEN length(key) % 5 = 2 THEN substr(key, 1, 6) END",
}
_DOCUMENTS = rf"""g AS MATERIALIZED (SELECT *, {", ".join(f"{e} AS {c}" for c, e in _MORE.items())} FROM ({graph_plan._SQL})),
w AS (SELECT key, split_part(x, ':', 1) AS s, split_part(x, ':', 2) AS relation FROM (SELECT key, unnest(string_split(spouses, ',')) AS x FROM g WHERE spouses <> '')),
kid AS (SELECT father AS key, key AS child, mother AS other FROM g WHERE father IS NOT NULL UNION ALL SELECT mother, key, father FROM g WHERE mother IS NOT NULL AND mother IS DISTINCT FROM father),
wed AS (SELECT w.key, w.s, CASE WHEN length(w.s) % 2 = 0 THEN w.relation ELSE CASE z.gender WHEN 'Female' THEN 'Wife' WHEN 'Male' THEN 'Husband' ELSE 'Spouse' END END AS relation, (SELECT string_agg('@' || child, ' ' ORDER BY child) FROM kid k WHERE k.key = w.key AND k.other = w.s) AS children FROM w LEFT JOIN g z ON z.key = w.s),
spo AS (SELECT key, string_agg('@' || s || ':' || relation || ':' || coalesce(children, ''), ',' ORDER BY s) AS spouse, count(children) AS theirs FROM wed GROUP BY key),
own AS (SELECT key, string_agg('@' || child, ',' ORDER BY child) AS children FROM kid k WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.key = k.key AND w.s = k.other) GROUP BY key),
lin AS (SELECT a.key, '@' || b.father AS grandfather, '@' || d.key AS great_grandfather FROM g a JOIN g b ON b.key = a.father JOIN g c ON c.key = b.father LEFT JOIN g d ON d.key = c.father),
ev AS (SELECT lower(unnest(ns[:2])) AS key, doc_id FROM (SELECT doc_id, list_filter(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_matches(w, '^[A-Z][a-z][a-z]+$')) AS ns FROM documents)),
evs AS (SELECT key, string_agg('@e' || doc_id, ',' ORDER BY doc_id) AS events FROM ev GROUP BY key),
docs AS (SELECT g.key, name, aliases AS alias_names, gender, '@' || father AS father, '@' || mother AS mother, spouse, own.children, theirs, caste, duty, dynasty, status, '@' || kingdom AS kingdom, political_role, skill AS skills, weapon AS divine_weapons,
  title AS titles, trait AS traits, arc AS character_arc, friend || ':Friend' AS key_relationships, '@' || place AS important_locations, grandfather, great_grandfather, events AS major_events
  FROM g LEFT JOIN spo ON spo.key = g.key LEFT JOIN own ON own.key = g.key LEFT JOIN lin ON lin.key = g.key LEFT JOIN evs ON evs.key = g.key)"""


def _documents(spark, sf) -> DataFrame:
    people = graph.stored(graph_plan.people_of(spark, sf), "people")
    own = people.select("*", *(F.expr(e).alias(f"_{c}") for c, e in _MORE.items()))
    many = lambda c: F.filter(F.array(f"_{c}"), lambda x: x.isNotNull())
    friend = F.when(F.col("_friend").isNotNull(), F.array(F.struct(F.col("_friend").alias("with"), F.lit("Friend").alias("type"), F.lit(None).cast("string").alias("note"))))
    wed = F.transform("spouses", lambda s: F.struct(s["key"].alias("key"), F.when(F.length(s["key"]) % 2 == 0, s["relation"]).alias("relation")))
    own = own.withColumns({
        "status": F.col("_status"), "kingdom": F.col("_kingdom"), "political_role": F.col("_political_role"), "skills": many("skill"), "divine_weapons": many("weapon"), "titles": many("title"),
        "traits": many("trait"), "character_arc": many("arc"), "important_locations": many("place"), "relationships": friend, "spouses": wed,
    }).select(*people.columns)
    pair = F.filter(T.first_names(F.col("text"), 2), lambda w: w != "")
    events = table(spark, sf, "documents").select(F.explode(pair).alias("key"), F.col("doc_id").alias("ord")).select(F.lower("key").alias("key"), "ord", F.concat(F.lit("e"), "ord").alias("event"))
    return documents.documents(own, events)


@query(f"WITH {_DOCUMENTS} SELECT * EXCLUDE (theirs) FROM docs")
def people_documents(spark, sf):
    with graph.scratch(spark) as keep:
        joined = lambda c: F.when(F.col(c).isNotNull(), F.array_join(c, ","))
        spouses = F.array_join(F.array_sort(F.transform("spouse", lambda s: F.concat_ws(":", s["key"], s["relation"], F.array_join(s["children"], " ")))), ",")
        out = _documents(spark, sf).withColumns({c: joined(c) for c in ("alias_names", "children", "skills", "divine_weapons", "titles", "traits", "character_arc", "important_locations", "major_events")})
        friends = F.array_join(F.transform("key_relationships", lambda r: F.concat_ws(":", r["with"], r["type"], r["note"])), ",")
        out = out.withColumns({"spouse": spouses, "key_relationships": friends}).select("*", "lineage.*").drop("lineage")
        return keep(out, "documents")


_COUNTED = {
    "father": "father", "mother": "mother", "spouse": "spouse", "caste": "caste", "duty": "duty", "dynasty": "dynasty", "status": "status", "kingdom": "kingdom",
    "skills": "skills", "weapons": "divine_weapons", "traits": "traits", "arc": "character_arc", "lineage": "grandfather", "key_relationships": "key_relationships",
}


@query(
    f"""WITH {_DOCUMENTS} SELECT count(*)::BIGINT AS total, count(*) FILTER (alias_names <> '')::BIGINT AS with_aliases, count(*) FILTER (children IS NOT NULL OR theirs > 0)::BIGINT AS with_children,
{", ".join(f"count({c})::BIGINT AS with_{n}" for n, c in _COUNTED.items())}, {", ".join(f"count(*) FILTER (gender = '{x}')::BIGINT AS {x.lower()}{'s'}" for x in ("Male", "Female", "Unknown"))} FROM docs"""
)
def builder_figures(spark, sf):
    """The twenty figures of the documents, observed while they are written."""
    with graph.scratch(spark):
        return documents.read_figures(_documents(spark, sf))[1]

"""The knowledge graph of texts as one registered query: facts, creation, aliases, merges, cleaning, titles.

Its sentences are woven from the names in the documents, in their order, with sentences picked by the id and the place,
so each text differs; notes are the documents with even ids, chapters the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import extract, graph, knowledge
from weftline.plans.books import _matches, _quoted
from weftline.plans.catalogue import query
from weftline.session import table

_SENTENCES = (
    "‘{a} said, O {b}!", "{a}, the son of {b}.", "{b}, the daughter of {a}.", "{a}’s wife {b}.", "{a}’s brother {b}.", "{a}’s sister, {b}.", "{a}’s mother {b}.", "{a}’s father, {b}.",
    "King {a} went.", "Queen {a} slept.", "Sage {a} spoke of {b}.", "{a}, king of {b}.", "{a} was the son of {b}.", "{a} was wife of {b}.", "{a}’s son {b}.", "the brother of {a}.",
    "O {a}! O {a}! O {a}! O {a}! O {a}!", "the river and {b}-", "{a} is also known as {b}.", "The daughter of {b}, The king.", "Princess {b} and Prince {a}.", "{a}’s son, The one.",
)
_OPENINGS = ("{a}. She was here.", "{a}. He was here.", "{a}, the king of {b}.", "{a}. The one.")
_NOISE, _SKIP = ("Eriner", "License"), ("the", "one", "nicht")
#: Nobody is known before; as SQL, so that Spark sees that it is empty and leaves joins with it out.
_NONE_KNOWN = "SELECT '' AS key, '' AS name, '' AS gender WHERE false", "SELECT '' AS alias_key, '' AS key WHERE false"


def texts(spark, sf) -> DataFrame:
    """doc_id and text: an opening, and a sentence for each two neighbouring names of a document."""
    rows = table(spark, sf, "documents").select("doc_id", T.names(F.col("text")).alias("ns")).filter(F.size("ns") > 1)

    def said(templates, number, a, b):
        template = F.get(F.array(*(F.lit(t) for t in templates)), number.cast("int"))
        return F.coalesce(F.replace(F.replace(template, F.lit("{a}"), a), F.lit("{b}"), b), F.lit(""))

    n = F.col("ns")
    opening = said(_OPENINGS, F.col("doc_id") % (len(_OPENINGS) + 1), n[0], n[1])
    each = F.transform(F.sequence(F.lit(0), F.size(n) - 2), lambda i: said(_SENTENCES, (F.col("doc_id") * 5 + i * 7 + F.length(n[i])) % (len(_SENTENCES) + 3), n[i], n[i + 1]))
    return rows.select("doc_id", F.array_join(F.concat(F.array(opening), each), " ").alias("text"))


def _case(templates, number, a, b):
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN replace(replace({_quoted(t)}, '{{a}}', {a}), '{{b}}', {b})" for i, t in enumerate(templates)) + " ELSE '' END"


_TEXTS = rf"""n AS (SELECT doc_id, list_filter(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_matches(w, '^[A-Z][a-z][a-z]+$')) AS ns FROM documents),
i AS (SELECT doc_id, ns, unnest(range(0, len(ns) - 1)) AS i FROM n WHERE len(ns) > 1),
t AS (SELECT doc_id, {_case(_OPENINGS, f"doc_id % {len(_OPENINGS) + 1}", "any_value(ns)[1]", "any_value(ns)[2]")} || ' ' || string_agg({_case(_SENTENCES, f"(doc_id * 5 + i * 7 + length(ns[i + 1])) % {len(_SENTENCES) + 3}", "ns[i + 1]", "ns[i + 2]")}, ' ' ORDER BY i) AS text FROM i GROUP BY doc_id),
c AS MATERIALIZED (SELECT doc_id % 10 AS volume, doc_id AS chapter, text FROM t WHERE doc_id % 2 = 1),
e AS MATERIALIZED (SELECT doc_id % 10 AS volume, doc_id AS entry, text AS body FROM t WHERE doc_id % 2 = 0)"""


def _ok(c: str) -> str:
    words = lambda w: ", ".join(f"'{x}'" for x in w)
    return f"length({c}) >= 3 AND NOT ends_with({c}, '-') AND {c} NOT IN ({words(_NOISE)}) AND lower({c}) NOT IN ({words(_SKIP)})"


_NAME_RULES = " UNION ALL ".join(f"SELECT {i} AS rule, {r.least} AS least, unnest(regexp_extract_all(text, {_quoted(r.pattern)}, 1)) AS a FROM c" for i, r in enumerate(extract.CHAPTER_NAMES[:4]))
_TITLES = " UNION ALL ".join(f"SELECT {i} AS rule, unnest(regexp_extract_all(text, {_quoted(rf'\b{t}\s+{extract._N}')}, 1)) AS a FROM c" for i, (t, _, _) in enumerate(extract.DUTIES))
_DUTY = lambda at: "CASE rule " + " ".join(f"WHEN {i} THEN '{d[at]}'" for i, d in enumerate(extract.DUTIES)) + " END"

_SQL = rf"""WITH RECURSIVE {_TEXTS},
notes AS (SELECT volume, entry, 0 AS step, 0 AS place, regexp_extract(body, {_quoted(extract.SUBJECT)}, 1) AS a, NULL::VARCHAR AS b, CASE WHEN contains(left(body, 50), '. She ') THEN 'Female' WHEN contains(left(body, 50), '. He ') THEN 'Male' END AS gender FROM e
  UNION ALL SELECT volume, entry, 1, i, x[i + 1], NULL, NULL FROM (SELECT *, unnest(range(len(x))) AS i FROM (SELECT *, regexp_extract_all(body, {_quoted(extract.KIN[0])}, 1) AS x FROM e))
  UNION ALL SELECT volume, entry, 2, i, x[i + 1], NULL, NULL FROM (SELECT *, unnest(range(len(x))) AS i FROM (SELECT *, regexp_extract_all(body, {_quoted(extract.KIN[1])}, 1) AS x FROM e))
  UNION ALL SELECT volume, entry, 3, 0, regexp_extract(body, {_quoted(extract.RULER)}, 1), NULL, CASE WHEN contains(lower(left(body, 40)), 'king') THEN 'Male' END FROM e
  UNION ALL SELECT volume, entry, 4, i, x[i + 1], y[i + 1], NULL FROM (SELECT *, unnest(range(len(x))) AS i FROM (SELECT *, regexp_extract_all(body, {_quoted(extract.ALSO)}, 1) AS x, regexp_extract_all(body, {_quoted(extract.ALSO)}, 2) AS y FROM e))),
found AS ({_NAME_RULES} UNION ALL SELECT 4, 50, word FROM (SELECT unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS word FROM c) WHERE regexp_matches(word, '^[A-Z][a-z]{{3,}}$')),
names AS (SELECT rule, a FROM found GROUP BY rule, a HAVING count(*) >= min(least)),
queens AS (SELECT DISTINCT unnest(regexp_extract_all(text, {_quoted(extract.WOMEN)}, 1)) AS q FROM c),
named AS (SELECT rule, a, CASE WHEN rule = 2 THEN CASE WHEN EXISTS (SELECT 1 FROM queens WHERE starts_with(q, names.a)) THEN 'Female' ELSE 'Male' END END AS gender FROM names),
cr AS ({_matches(extract.CHAPTER_RELATIONS, "c", "text", "volume", "chapter")}),
nr AS ({_matches(extract.NOTE_RELATIONS, "e", "body", "volume", "entry")}),
raw AS (SELECT 0 AS phase, volume::BIGINT AS p1, entry::BIGINT AS p2, step::BIGINT AS p3, place::BIGINT AS p4, 0 AS sub, 'name' AS kind, a, b, gender, NULL::VARCHAR AS attr, b AS other FROM notes WHERE a <> ''
  UNION ALL SELECT 1, rule + 1, 0, 0, 0, 0, 'name', a, NULL, gender, NULL, NULL FROM named
  UNION ALL SELECT 2, rule, volume, chapter, place, 0, 'name', a, NULL, gender_a, NULL, b FROM cr UNION ALL SELECT 2, rule, volume, chapter, place, 1, 'name', b, NULL, gender_b, NULL, a FROM cr UNION ALL SELECT 2, rule, volume, chapter, place, 2, 'relation', a, b, NULL, attr, NULL FROM cr
  UNION ALL SELECT 3, volume, entry, rule, place, 0, 'name', a, NULL, gender_a, NULL, b FROM nr UNION ALL SELECT 3, volume, entry, rule, place, 1, 'name', b, NULL, gender_b, NULL, a FROM nr UNION ALL SELECT 3, volume, entry, rule, place, 2, 'relation', a, b, NULL, attr, NULL FROM nr),
log AS MATERIALIZED (SELECT row_number() OVER (ORDER BY phase, p1, p2, p3, p4, sub, a, b) - 1 AS ord, kind, a, b, lower(a) AS ka, lower(b) AS kb, gender, attr FROM raw WHERE {_ok("a")} AND (b IS NULL OR {_ok("b")}) AND (other IS NULL OR {_ok("other")})),
asked AS MATERIALIZED (SELECT ka AS key, min(ord) AS asked FROM log WHERE kind = 'name' AND b IS NULL GROUP BY ka),
also AS MATERIALIZED (SELECT l.ord, l.ka, l.kb, x.asked AS da, y.asked AS db, row_number() OVER (ORDER BY l.ord) AS k FROM log l LEFT JOIN asked x ON x.key = l.ka LEFT JOIN asked y ON y.key = l.kb WHERE kind = 'name' AND b IS NOT NULL),
play AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS ord, NULL::VARCHAR AS made, []::VARCHAR[] AS there
  UNION ALL
  SELECT a.k, a.ord, CASE WHEN f THEN a.ka END, CASE WHEN f THEN list_append(there, a.ka) ELSE there END
  FROM (SELECT p.there, a.*, NOT (coalesce(a.da < a.ord, false) OR coalesce(a.db < a.ord, false) OR list_contains(p.there, a.ka) OR list_contains(p.there, a.kb)) AS f FROM play p JOIN also a ON a.k = p.k + 1) a),
born AS MATERIALIZED (SELECT key, min(ord) AS created FROM (SELECT key, asked AS ord FROM asked UNION ALL SELECT made, ord FROM play WHERE made IS NOT NULL) GROUP BY key),
node AS (SELECT b.key, b.created, any_value(l.a) FILTER (l.ord = b.created) AS name, coalesce(arg_min(l.gender, l.ord) FILTER (l.gender <> 'Unknown' AND l.b IS NULL), 'Unknown') AS gender FROM born b JOIN log l ON l.ka = b.key AND l.kind = 'name' AND l.ord >= b.created GROUP BY b.key, b.created),
alias AS MATERIALIZED (SELECT key, alias, min(ord) AS ord FROM (SELECT CASE WHEN coalesce(b.created <= l.ord, false) THEN l.ka ELSE l.kb END AS key, CASE WHEN coalesce(b.created <= l.ord, false) THEN l.b ELSE l.a END AS alias, l.ord FROM log l LEFT JOIN born b ON b.key = l.ka WHERE l.kind = 'name' AND l.b IS NOT NULL) GROUP BY key, alias),
rule AS (SELECT o AS old, arg_min(key, ord) AS new, min(ord) AS ord FROM (SELECT lower(alias) AS o, key, ord FROM alias WHERE lower(alias) <> key) GROUP BY o),
here AS MATERIALIZED (SELECT r.* FROM rule r JOIN born x ON x.key = r.old JOIN born y ON y.key = r.new),
chain AS (SELECT old, new, ord, 0 AS n, new AS at, ord AS cut FROM here UNION ALL SELECT c.old, c.new, c.ord, c.n + 1, h.new, h.ord FROM chain c JOIN here h ON h.old = c.at AND h.ord < c.cut),
done AS MATERIALIZED (SELECT old, new, ord FROM chain GROUP BY old, new, ord HAVING max(n) % 2 = 0),
walk AS (SELECT old, new AS at FROM done UNION ALL SELECT w.old, d.new FROM walk w JOIN done d ON d.old = w.at),
moved AS MATERIALIZED (SELECT w.old, w.at AS root, d.ord FROM walk w JOIN done d ON d.old = w.old WHERE w.at NOT IN (SELECT old FROM done)),
rel AS (SELECT ka AS key, attr AS role, kb AS ref, CASE WHEN attr = 'wife' THEN 'Wife' END AS relation, ord * 4 + 2 AS ord FROM log WHERE kind = 'relation'
  UNION ALL SELECT kb, attr, ka, CASE WHEN attr = 'wife' THEN 'Husband' END, ord * 4 + 3 FROM log WHERE kind = 'relation' AND attr IN ('wife', 'sibling')),
mine AS (SELECT key, role, ref, arg_min(relation, ord) AS relation, min(ord) AS ord FROM rel GROUP BY key, role, ref),
one AS (SELECT * FROM mine QUALIFY role NOT IN ('father', 'mother') OR row_number() OVER (PARTITION BY key, role ORDER BY ord) = 1),
sent AS (SELECT coalesce(m.root, o.key) AS key, role, coalesce(f.root, o.ref) AS ref, relation, coalesce(m.ord + 1, 0) AS turn, o.ord FROM one o LEFT JOIN moved m ON m.old = o.key LEFT JOIN moved f ON f.old = o.ref),
kept AS (SELECT key, role, ref, arg_min(relation, (turn, ord)) AS relation, min((turn, ord)) AS o FROM sent WHERE key <> ref GROUP BY key, role, ref),
held AS (SELECT * FROM kept QUALIFY role NOT IN ('father', 'mother') OR row_number() OVER (PARTITION BY key, role ORDER BY o) = 1),
people AS MATERIALIZED (SELECT coalesce(m.root, n.key) AS key, arg_min(name, coalesce(m.ord + 1, 0)) AS name, coalesce(arg_min(gender, coalesce(m.ord + 1, 0)) FILTER (gender <> 'Unknown'), 'Unknown') AS gender FROM node n LEFT JOIN moved m ON m.old = n.key GROUP BY 1),
good AS MATERIALIZED (SELECT * FROM people WHERE {_ok("name")} AND lower(name) NOT IN ({", ".join(f"'{x}'" for x in _NOISE)})),
refs AS MATERIALIZED (SELECT h.key, h.role, h.ref, h.relation FROM held h JOIN good g ON g.key = h.key JOIN good r ON r.key = h.ref),
ups AS (SELECT r.key, r.role, r.ref, b.created FROM refs r JOIN born b ON b.key = r.key WHERE role IN ('father', 'mother')),
parents AS (SELECT u.* FROM ups u LEFT JOIN ups v ON v.key = u.ref AND v.ref = u.key AND v.role = u.role WHERE v.key IS NULL OR u.created <= v.created),
married AS (SELECT key, ref, relation FROM refs r WHERE role = 'wife' AND NOT EXISTS (SELECT 1 FROM ups u WHERE (u.key = r.key AND u.ref = r.ref) OR (u.key = r.ref AND u.ref = r.key))),
called AS (SELECT coalesce(m.root, a.key) AS key, alias FROM alias a LEFT JOIN moved m ON m.old = a.key UNION SELECT m.root, n.name FROM moved m JOIN node n ON n.key = m.old),
titles AS ({_TITLES}), duty AS (SELECT lower(a) AS key, min(rule) AS rule FROM titles GROUP BY 1),
kings AS (SELECT lower(a[i + 1]) AS key, arg_min(b[i + 1], (volume, chapter, i)) FILTER ({_ok("b[i + 1]")}) AS dynasty FROM (SELECT *, unnest(range(len(a))) AS i FROM (SELECT volume, chapter, regexp_extract_all(text, {_quoted(extract.KING_OF)}, 1) AS a, regexp_extract_all(text, {_quoted(extract.KING_OF)}, 2) AS b FROM c)) GROUP BY 1)
SELECT g.key, g.name, g.gender, f.ref AS father, m.ref AS mother, coalesce(w.spouses, '') AS spouses, coalesce(s.siblings, '') AS siblings, coalesce(k.aliases, '') AS aliases, {_DUTY(1)} AS duty, {_DUTY(2)} AS caste, q.dynasty
FROM good g LEFT JOIN parents f ON f.key = g.key AND f.role = 'father' LEFT JOIN parents m ON m.key = g.key AND m.role = 'mother'
LEFT JOIN (SELECT key, string_agg(ref || ':' || relation, ',' ORDER BY ref) AS spouses FROM married GROUP BY key) w ON w.key = g.key
LEFT JOIN (SELECT key, string_agg(ref, ',' ORDER BY ref) AS siblings FROM refs WHERE role = 'sibling' GROUP BY key) s ON s.key = g.key
LEFT JOIN (SELECT c.key, string_agg(DISTINCT alias, ',' ORDER BY alias) AS aliases FROM called c JOIN good g ON g.key = c.key WHERE alias <> g.name AND {_ok("alias")} GROUP BY c.key) k ON k.key = g.key
LEFT JOIN duty d ON d.key = g.key LEFT JOIN kings q ON q.key = g.key"""


def people_of(spark, sf) -> DataFrame:
    """The records of the woven texts."""
    with graph.scratch(spark) as keep:
        woven = graph.stored(texts(spark, sf), "texts")
        volume = (F.col("doc_id") % 10).alias("volume")
        chapters = woven.filter("doc_id % 2 = 1").select(volume, F.col("doc_id").alias("chapter"), "text")
        entries = woven.filter("doc_id % 2 = 0").select(volume, F.col("doc_id").alias("entry"), F.col("text").alias("body"))
        return keep(knowledge.build(entries, chapters, *(spark.sql(x) for x in _NONE_KNOWN), None, _NOISE, _SKIP), "people")


@query(_SQL)
def knowledge_graph(spark, sf):
    with graph.scratch(spark) as keep:
        joined = lambda c: F.array_join(F.array_sort(c), ",")
        spouses = joined(F.transform("spouses", lambda s: F.concat_ws(":", s["key"], s["relation"])))
        out = people_of(spark, sf)
        return keep(out.select("key", "name", "gender", "father", "mother", spouses.alias("spouses"), joined("siblings").alias("siblings"), joined("aliases").alias("aliases"), "duty", "caste", "dynasty"), "knowledge")

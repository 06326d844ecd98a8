"""The whole plan over a few notes and chapters, by hand."""

from weftline.operators import extract, knowledge, people

ENTRIES = [
    (1, 1, "Arjuna. He was the son of Pandu. Arjuna is also known as Partha."),
    (1, 2, "Partha, the king of Kuru. Kunti was the wife of Pandu."),
    (1, 3, "The. He is one. Dhananjaya, also called as Arjuna"),
    (2, 1, "Pandu’s son Arjuna. The’s brother Nakula- was here."),
]
CHAPTERS = [
    (1, 1, "‘Bhima said, O Arjuna! Arjuna’s brother, Bhima. Bhima’s mother Kunti. Sage Vyasa, the son of King."),
    (1, 2, "Pandu, the son of Arjuna. King Pandu, king of The. Pandu, king of Kuru. King Pandu. King Pandu. Queen Kunti’s wife Kunti."),
]


def test_people_of_a_book(spark):
    entries = spark.createDataFrame(ENTRIES, "volume int, entry int, body string")
    chapters = spark.createDataFrame(CHAPTERS, "volume int, chapter int, text string")
    seeds = spark.createDataFrame([("vyasa", "Vyasa", "Unknown")], "key string, name string, gender string")
    mapping = spark.createDataFrame([("krishna_dvaipayana", "vyasa")], "alias_key string, key string")
    out = knowledge.build(entries, chapters, seeds, mapping, None, ("King", "Queen"), ("the", "one"))
    got = {r["key"]: r.asDict(recursive=True) for r in out.collect()}
    # Partha is created by its own note after it became an alias, and merged into Arjuna; Dhananjaya is only an alias
    assert set(got) == {"arjuna", "bhima", "kunti", "pandu", "vyasa"}
    arjuna = got["arjuna"]
    assert (arjuna["father"], arjuna["mother"], arjuna["gender"], sorted(arjuna["aliases"]), arjuna["siblings"]) == ("pandu", None, "Male", ["Dhananjaya", "Partha"], ["bhima"])
    assert got["bhima"]["mother"] == "kunti" and got["bhima"]["siblings"] == ["arjuna"]
    # Pandu is created after Arjuna, so of the two who are each other's father he loses his
    assert got["pandu"]["father"] is None
    assert got["pandu"]["spouses"] == [{"key": "kunti", "relation": "Wife"}] and got["kunti"]["spouses"] == [{"key": "pandu", "relation": "Husband"}]
    assert (got["pandu"]["duty"], got["pandu"]["caste"], got["pandu"]["dynasty"]) == ("King", "Kshatriya", "Kuru")
    assert (got["vyasa"]["duty"], got["vyasa"]["caste"], got["vyasa"]["gender"]) == ("Sage", "Brahmin", "Unknown")


def test_nothing(spark):
    entries = spark.createDataFrame(ENTRIES, "volume int, entry int, body string").filter("false")
    chapters = spark.createDataFrame(CHAPTERS, "volume int, chapter int, text string").filter("false")
    out = knowledge.build(entries, chapters, spark.createDataFrame([], "key string, name string, gender string"), spark.createDataFrame([], "alias_key string, key string"), None, (), ())
    assert out.count() == 0 and out.columns == [x.split()[0] for x in knowledge._fields(people.RECORD)]


def test_texts_are_read_once_for_a_log(spark):
    chapters = spark.createDataFrame(CHAPTERS, "volume int, chapter int, text string")
    rows = knowledge.relation_log(chapters, extract.CHAPTER_RELATIONS, "text", 2, ("rule", "volume", "chapter", "place"))
    assert rows._jdf.queryExecution().sparkPlan().toString().count("Scan ExistingRDD") == 1
    assert sorted((r.sub, r.a, r.b, r.other) for r in rows.filter("p1 = 3").collect()) == [(0, "Arjuna", None, "Bhima"), (1, "Bhima", None, "Arjuna"), (2, "Arjuna", "Bhima", None)]

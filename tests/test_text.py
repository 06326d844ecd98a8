import pytest
from pyspark.sql import functions as F

from weftline.functions import geo
from weftline.functions import text as T


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], names).select(f(*(F.col(n) for n in names)).alias("x")).first().x


@pytest.mark.parametrize(
    "f, value, wanted",
    [
        (T.squeeze, "  a\n b\t c ", "a b c"),
        (T.ends_mid_sentence, "went to", True),
        (T.ends_mid_sentence, "went.", False),
        (T.ends_mid_sentence, "went.12", False),
        (T.ends_mid_sentence, "", False),
        (T.ends_mid_sentence, "12", False),
        (T.tag_note_refs, "son of Kunti.12 Then", "son of Kunti{12}. Then"),
        (T.tag_note_refs, "the king. 7 He went", "the king{7}.  He went"),
        (lambda c: T.joined_lines(F.split(c, "\n")), "conquer-\ned all\nfoes", "conquered all foes"),
        (lambda c: F.array_sort(T.chapter_ids(c)), "Chapter 4(12): 30 shlokas", ["4", "4(12)"]),
        (T.space_after_number, "12Each word", "12 Each word"),
        (T.key_of, " Bhima Sena ", "bhima_sena"),
        (T.name_shape, "Ab", False),
        (T.name_shape, "Undesir-", False),
        (T.name_shape, "Karna", True),
        (T.english_suffix, "Swiftly", True),
        (T.english_suffix, "Walked", True),
        (T.english_suffix, "Agreed", False),
        (T.english_suffix, "Karna", False),
        (T.line_kind, "Section Two", "section"),
        (T.line_kind, "SECTION TWO", "SECTION"),
        (T.line_kind, "Chapter 4(12): 30 shlokas", "chapter"),
        (T.line_kind, "This parva has 3 chapters", "count"),
        (T.line_kind, "Adi Parva", "parva"),
        (T.line_kind, "JATUGRIHA-DAHA PARVA", "PARVA"),
        (T.line_kind, "He went.", None),
        (T.is_drop_cap, "‘T", True),
        (T.is_drop_cap, "The", False),
        (lambda c: T.rules_hit(c, [("a", "b"), ("b", "c"), ("x", "y")]), "aa", 2),
        (T.deref, "@arjuna", "arjuna"),
    ],
)
def test_scalar(spark, f, value, wanted):
    assert one(spark, f, value) == wanted


def test_markers(spark):
    rows = spark.createDataFrame(
        [("12", 250.0, True, "12"), ("12", 250.0, False, None), ("12", 10.0, True, None), ("3 (14)", 220.0, True, "3(14)"), ("CHAPTER 4", 0.0, False, "4"), ("Chapter 4(9)", 0.0, False, "4(9)")],
        "t string, x double, past boolean, wanted string",
    )
    assert rows.filter(~T.chapter_marker(F.col("t"), F.col("x"), F.col("past")).eqNullSafe(F.col("wanted"))).count() == 0


def test_formats(spark):
    assert one(spark, T.percent, 2, 3) == "66.7%"
    assert one(spark, T.percent, 0, 0) == "0%"
    assert one(spark, lambda v, c: T.appearance(v, c), "1", [7, 3, 10]) == "Vol1:ch3,7,10"
    rows = spark.createDataFrame([(None, "Female", "Wife"), ("Friend", "Male", "Friend"), (None, "Unknown", "Spouse")], "r string, g string, w string")
    assert rows.filter(T.default_relation(F.col("r"), F.col("g")) != F.col("w")).count() == 0


def test_distance(spark):
    km = lambda *c: geo.rounded_km(geo.haversine_km(*c))
    assert one(spark, km, 29.1604, 78.0180, 29.0700, 77.3800) == 63
    assert one(spark, km, 29.1604, 78.0180, 28.6095, 77.2425) == 97


def test_names_in_one_pass(spark):
    # a run of letters and digits of any script is a name in whole or not at all; 𐐀 is a letter of two 16-bit units, 😀 none
    words = ["Bob", "BobBob", "éBob", "Bobé", "Bob1", "1Bob", "_Bob", "Bob_", "\U00010400Bob", "Bob\U00010400", "\U0001F600Bob", "Bob\U0001F600", "Bo", "BOb", "x-Bob-Ann", "Bob’s\nAnn"]
    texts = [*words, " ".join(words), ". ".join(reversed(words)), "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    runs = F.filter(F.regexp_extract_all("text", F.lit(T.RUN), 0), lambda w: w.rlike(T.NAME))
    pair = F.filter(T.first_names(F.col("text"), 2), lambda w: w != "")
    for r in df.select("text", runs.alias("runs"), T.names(F.col("text")).alias("names"), pair.alias("pair")).collect():
        assert r.names == r.runs, r.text
        assert r.pair == (r.runs or [])[:2], r.text
    plan = df.select(T.names(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan

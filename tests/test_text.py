import re

from pyspark.sql import functions as F

from clipquarry.functions import paths
from clipquarry.functions import text as tx


def one(spark, column, **values):
    names = list(values)
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return row.select(column.alias("x")).first()["x"]


def test_words_follow_unicode_blanks(spark):
    text = "  a b\tc\x1cd　é f \n"
    assert one(spark, tx.words("t"), t=text) == text.split()
    assert one(spark, tx.word_count("t"), t=text) == len(text.split())
    assert one(spark, tx.word_count("t"), t="") == 0
    assert one(spark, tx.word_count("t"), t=None) == 0
    assert one(spark, tx.strip_text("t"), t=text) == text.strip()
    assert one(spark, tx.strip_text("t"), t=" \n ") == ""


def test_emails(spark):
    text = "to a.b@x.org, c@d.co|m and e@f.g; éx@y.com"
    assert one(spark, tx.extract_emails("t"), t=text) == re.findall(tx.EMAIL, text)
    assert one(spark, tx.email_count("t"), t=None) == 0
    assert one(spark, tx.extract_emails("t"), t="none") == []


def test_phones(spark):
    text = "call 123-456-7890 or (555) 111-2222, +1 222.333.4444 x 12345678901"
    assert one(spark, tx.extract_phones("t"), t=text) == re.findall(tx.PHONE, text)
    assert one(spark, tx.phone_count("t"), t=text) == len(re.findall(tx.PHONE, text))
    assert one(spark, tx.extract_phones("t"), t=None) == []


def test_phone_demo(spark):
    text = "My phone number is 123-456-7890. Please call me at 987-654-3210."
    found = one(spark, tx.phones_with_context("t"), t=text)
    assert [tuple(r) for r in found] == [
        ("+11234567890", "Phone-related context"),
        ("+19876543210", "Phone-related context"),
    ]


def test_phone_context_is_per_paragraph(spark):
    text = "My number is 222-333-4444\n\nring 222-333-5555\n\nour PHONE: 222-333-6666"
    found = one(spark, tx.phones_with_context("t"), t=text)
    assert [r["context"] for r in found] == [
        "Request for own phone number", None, "Phone-related context",
    ]


def test_normalize_keeps_country_code(spark):
    assert one(spark, tx.normalize_us_phone("t"), t="44 222-333-4444") == "+442223334444"


def test_quality_tests(spark):
    cases = {
        "no_all_caps": {"éAB": False, "A2 b": True, "NASA went": False, "aNASA": True, "X": True},
        "no_caps_run": {"THE END now": False, "THE end": True, "AB CD": True, "AB CD ": False},
        "has_sentence_shape": {"ends.\n": False, "ends.": True, "a. B": True, "a. b": False},
        "no_music": {"la ♪ la": False, "la": True},
        "not_document_dump": {"PK [Content_Types].xml": False, "Content": True,
                              "[ContentXTypes].xml": False},
    }
    for name, texts in cases.items():
        for text, expected in texts.items():
            assert one(spark, getattr(tx, name)("t"), t=text) is expected, (name, text)
    assert one(spark, tx.no_all_caps("t"), t=None) is None
    assert one(spark, tx.min_length("t"), t="123456789") is False


def test_noun_entities_need_one_capitalised_word(spark):
    entities = [("Paris", "GPE"), ("New York", "GPE"), ("NASA", "ORG"), ("A", "ORG"), ("Bob", "DATE")]
    df = spark.createDataFrame([(entities,)], "e array<struct<text:string,label:string>>")
    assert df.select(tx.noun_entities("e", ["GPE", "ORG"])).first()[0] == ["Paris"]


def test_paths(spark):
    import os.path

    for path in ["gs://b/x/a.WAV", "a.b/c", ".bashrc", "..x.y", "a.", "x.tar.gz", "-a.m4a"]:
        name = path.split("/")[-1]
        assert one(spark, paths.extension("p"), p=path) == os.path.splitext(name)[1].lower(), path
        assert one(spark, paths.stem("p"), p=path) == os.path.splitext(name)[0], path
    assert tuple(one(spark, paths.split_uri("p"), p="gs://b/x/y.z")) == ("b", "x/y.z")
    assert one(spark, paths.timestamp_suffix("t", None), t="") == "t"
    at = F.to_timestamp(F.lit("2024-04-18 01:02:03"))
    assert one(spark, paths.timestamp_suffix("t", at), t="") == "t_20240418010203"

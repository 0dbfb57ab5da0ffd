import base64
import hashlib
import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from clipquarry.functions import farm
from clipquarry.functions.ids import ALPHABET, decode_id, encode_id, hash_bucket

NAMES = ["dQw4w9WgXcQ", "é-名前", "x", "", "a" * 40, "tab\tnew\nline"]


def test_pseudonyms_against_base32(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "id string")
    plain = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    for row in df.select("id", encode_id("id", "k").alias("p")).collect():
        salt = hashlib.sha256((row["id"] + "k").encode()).digest()[:5]
        mixed = bytes(b ^ 0x55 for b in salt + row["id"].encode())
        text = base64.b32encode(mixed).decode().rstrip("=")
        assert row["p"] == text.translate(str.maketrans(plain, ALPHABET))


def test_round_trip(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "id string")
    for row in df.select("id", decode_id(encode_id("id")).alias("d")).collect():
        assert row["d"] == row["id"]


def test_other_keys_give_other_names(spark):
    df = spark.createDataFrame([("abc",)], "id string")
    row = df.select(encode_id("id", "a").alias("a"), encode_id("id", "b").alias("b")).first()
    assert row["a"] != row["b"]


def test_buckets_are_in_range(spark):
    ids = spark.range(1000).selectExpr("cast(id as string) id")
    found = {r[0] for r in ids.select(hash_bucket("id", 20)).distinct().collect()}
    assert found == set(range(20))


# Published fingerprints, of every length class.
FARM = {
    "a": 0xB3454265B6DF75E3, "ab": 0xAA8D6E5242ADA51E, "abc": 0x24A5B3A074E7F369, "abcd": 0x1A5502DE4A1F8101,
    "abcde": 0xC22F4663E54E04D4, "abcdef": 0xC329379E6A03C2CD, "abcdefg": 0x3C40C92B1CCB7355, "abcdefgh": 0xFEE9D22990C82909,
    "abcdefghi": 0x332C8ED4DAE5BA42, "abcdefghij": 0x8A3ABB6A5F3FB7FB, "Nepal premier won't resign.": 0x8EB3808D1CCFC779,
    "Discard medicine more than two years old.": 0xE8F89AB6DF9BDD25,
    "He who has a shady past knows that nice guys finish last.": 0x786D7E1987023CA9,
    "I wouldn't marry him with a ten foot pole.": 0xA9961670CE2A46D9,
    "For every action there is an equal and opposite government program.": 0x55182F8859ECA4CE,
}
SIGNED = {"1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}


def test_farm_fingerprints(spark):
    rows = [(t,) for t in [*FARM, *SIGNED, None, ""]]
    df = spark.createDataFrame(rows, "t string").repartition(2)
    found = {r["t"]: r["f"] for r in df.select("t", farm.farm_fingerprint("t").alias("f")).collect()}
    assert {t: found[t] % 2**64 for t in FARM} == FARM and {t: found[t] for t in SIGNED} == SIGNED
    assert found[None] is None and found[""] % 2**64 == 0x9AE16A3B2F90404F


def test_farm_fingerprints_do_not_depend_on_the_batch():
    draw = random.Random(8)
    texts = ["".join(draw.choices("ab é日0", k=n)) for n in range(300) for _ in range(2)]
    whole = farm.fingerprints(pa.array(texts)).to_pylist()
    assert whole == [farm.fingerprints(pa.array([t])).to_pylist()[0] for t in texts]
    assert farm.fingerprints(pa.array(["x", *texts])[1:]).to_pylist() == whole
    assert len(set(whole)) == len(set(texts)) and farm.fingerprints(pa.array([], pa.string())).to_pylist() == []


def test_farm_buckets(spark):
    df = spark.range(2_000).select(F.col("id").cast("string").alias("t"))
    rows = df.select(farm.farm_fingerprint("t").alias("f"), farm.farm_bucket("t").alias("b"), farm.farm_bucket("t", signed=True).alias("r")).collect()
    assert all(r["b"] == r["f"] % 20 and r["r"] == math.fmod(r["f"] % 20 - (20 if r["f"] < 0 and r["f"] % 20 else 0), 20) for r in rows)
    assert {r["b"] for r in rows} == set(range(20)) and len({r["r"] for r in rows}) == 39

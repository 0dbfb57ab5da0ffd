"""Record types, category names and tag tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The categories a clip is annotated with.
CATEGORIES = ["proper_noun", "email", "address", "alphanumeric", "phone_number", "website"]
STAT_FIELDS = ["density", "count"]
PATH_FIELDS = ["raw_filepath", "transcoded_filepath"]

CATEGORY = T.StructType(
    [
        T.StructField("density", T.DoubleType()),
        T.StructField("count", T.LongType()),
        T.StructField("exists", T.BooleanType()),
        T.StructField("evidence", T.ArrayType(T.StringType())),
    ]
)
CLIP = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("transcoded_filepath", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("categories", T.StructType([T.StructField(c, CATEGORY) for c in CATEGORIES])),
    ]
)
SEGMENT = T.StructType(
    [
        T.StructField("start_ms", T.LongType()),
        T.StructField("end_ms", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)
TRANSCRIPT = T.StructType(
    [
        T.StructField("raw_filepath", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("human_transcript_text", T.StringType()),
        T.StructField("human_transcript_timestamps", T.ArrayType(SEGMENT)),
    ]
)
ENTITY = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])
VENDOR_DOCUMENT = T.ArrayType(
    T.StructType(
        [
            T.StructField(
                "words", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))
            )
        ]
    )
)

# Entity labels that count as proper nouns, by annotation scheme.
NOUN_LABELS = ["PERSON", "ORG", "GPE", "LOC"]
NOUN_WORD_TAGS = [
    "B-person", "I-person", "B-corporation", "I-corporation",
    "B-location", "I-location", "B-group", "I-group",
]
NOUN_PIECE_TAGS = ["B-PER", "I-PER", "B-ORG", "I-ORG", "B-LOC", "I-LOC"]

# The corpus tag set and the four-entity tags each of its entities maps to.
CORPUS_ENTITIES = ["person", "location", "corporation", "group", "creative-work", "product"]
FOUR_ENTITY_NAMES = {
    "person": "PER",
    "location": "LOC",
    "corporation": "ORG",
    "group": "ORG",
    "creative-work": "MISC",
    "product": "MISC",
}
# Short entity names spelt out in merged entities.
SPELT_OUT = {"LOC": "LOCATION", "ORG": "ORGANIZATION", "PER": "PERSON"}


def _tagged(names: dict[str, str]) -> dict[str, str]:
    table = {f"{p}-{corpus}": f"{p}-{name}" for corpus, name in names.items() for p in "BI"}
    return {**table, "O": "O"}


# Corpus tag -> tagger tag: one table for taggers with four entity names, one for taggers trained
# on the corpus itself.
TO_FOUR_ENTITIES = _tagged(FOUR_ENTITY_NAMES)
SAME_TAGS = _tagged({e: e for e in CORPUS_ENTITIES})

# Which table each tagger name uses.
TAGGER_MAPPINGS = {
    "dslim/bert-base-NER": TO_FOUR_ENTITIES,
    "dslim/bert-base-NER-uncased": TO_FOUR_ENTITIES,
    "Babelscape/wikineural-multilingual-ner": TO_FOUR_ENTITIES,
    "tner/roberta-large-wnut2017": SAME_TAGS,
    "dbmdz/bert-large-cased-finetuned-conll03-english": TO_FOUR_ENTITIES,
}

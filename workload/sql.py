"""The fixtures as SQL, for the twins DuckDB runs. RE2 has no lookaround, and its ``\\b`` is ASCII."""

from __future__ import annotations

BLANKS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = f"[^{BLANKS}]+"
# The patterns that results have to agree on.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b(?:\+\d{1,2}\s?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"
CATEGORY_PATTERNS = {
    "proper_noun": "[A-Z][a-z]+",
    "email": EMAIL,
    "address": "[0-9]+ [A-Z][a-z]+",
    "alphanumeric": "[A-Za-z]+[0-9]+|[0-9]+[A-Za-z]+",
    "phone_number": PHONE,
    "website": r"https?://[^ \n]+",
}

CLIPS = (
    "clips AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, 'gs://bkt/' || source || '/clip_' || "
    "doc_id || (CASE doc_id % 5 WHEN 0 THEN '.wav' WHEN 1 THEN '.flac' WHEN 2 THEN '.m4a' "
    "WHEN 3 THEN '.webm' ELSE '.mp3' END) AS transcoded_filepath, text AS transcript, "
    f"n_chars // 15 AS duration, len(regexp_extract_all(text, '{WORD}')) AS n_words, "
    + ", ".join(
        f"regexp_extract_all(text, '{p}') AS {c}_evidence, "
        f"CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS {c}_count"
        for c, p in CATEGORY_PATTERNS.items()
    )
    + " FROM documents)"
)


def category(name: str) -> str:
    """``cat``: the clips with one category's columns under plain names."""
    return (
        f"cat AS (SELECT *, {name}_count AS cnt, CASE WHEN n_words > 0 THEN "
        f"{name}_count / n_words ELSE 0 END AS density, {name}_count > 0 AS present, "
        f"{name}_evidence AS evidence FROM clips)"
    )


STRICT = (
    "duration BETWEEN 60 AND 1200 AND NOT transcript LIKE '%[Content_Types].xml%' "
    r"AND NOT regexp_matches(transcript, '\b[A-Z]{2,}\b') "
    r"AND NOT regexp_matches(transcript, '(\b[A-Z]{2,}\s+){2,}') "
    r"AND regexp_matches(transcript, '([.!?]\s+[A-Z])|([.!?]$)') "
    "AND NOT contains(transcript, '♪') AND length(transcript) >= 10"
)
BASIC = (
    "duration BETWEEN 0 AND 1200 AND NOT contains(transcript, '♪') AND length(transcript) >= 10 "
    "AND transcoded_filepath IS NOT NULL AND cnt IS NOT NULL"
)

TRANSCRIPTS = (
    "transcripts AS (SELECT doc_id, source AS channel, 'gs://raw/' || doc_id AS raw_filepath, "
    "n_chars // 15 AS duration, text AS human_transcript_text FROM documents)"
)

_KIND = "CASE length(word) % 3 WHEN 0 THEN 'person' WHEN 1 THEN 'location' ELSE 'group' END"


def _tag(part: str) -> str:
    prefix = (
        f"CASE WHEN coalesce(lag(named) OVER (PARTITION BY {part} ORDER BY i), false) "
        "THEN 'I-' ELSE 'B-' END"
    )
    return f"CASE WHEN named THEN {prefix} || {_KIND} ELSE 'O' END"


def words(pattern: str = WORD) -> str:
    """``word_rows``: every word of every document with its place."""
    return (
        f"word_rows AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS p "
        f"FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS l FROM documents)), "
        "named_rows AS (SELECT *, regexp_matches(word, '^[A-Z][a-z]+$') AS named FROM word_rows)"
    )


# Words of whole documents with their tags.
DOCUMENT_TAGS = (
    words() + f", doc_tags AS (SELECT doc_id, i, word, {_tag('doc_id')} AS tag "
    "FROM (SELECT *, p AS i FROM named_rows))"
)


def sentences(pattern: str = WORD) -> str:
    """``gold``: words in blocks of 32 with their tags."""
    return (
        words(pattern) + f", gold AS (SELECT sent_id, i, word, {_tag('sent_id')} AS tag FROM "
        "(SELECT *, doc_id || '-' || (p // 32) AS sent_id, p % 32 AS i FROM named_rows))"
    )


# Gold and predicted tags of two models.
TAGGED = (
    sentences() + ", tagged AS (SELECT model, sent_id, i, word, tag AS gold, "
    "CASE WHEN length(word) % n = 0 THEN 'O' ELSE tag END AS pred "
    "FROM gold, (VALUES ('seven', 7), ('five', 5)) AS m(model, n))"
)


def spans(name: str, source: str, tag: str, keys: str) -> str:
    """``name``: entity spans of a tag column by gaps and islands."""
    window = f"OVER (PARTITION BY {keys} ORDER BY i)"
    return (
        f"{name}_0 AS (SELECT {keys}, i, {tag} AS t, lag({tag}) {window} AS before FROM {source}), "
        f"{name}_1 AS (SELECT *, CASE WHEN t = 'O' THEN 0 WHEN t LIKE 'B%' OR before IS NULL OR "
        "before = 'O' OR substr(before, 3) <> substr(t, 3) THEN 1 ELSE 0 END AS opens "
        f"FROM {name}_0), {name}_2 AS (SELECT *, sum(opens) {window} AS island FROM {name}_1), "
        f"{name} AS (SELECT {keys}, any_value(substr(t, 3)) AS type, CAST(min(i) AS BIGINT) AS start, "
        f"CAST(max(i) AS BIGINT) AS stop FROM {name}_2 WHERE t <> 'O' GROUP BY {keys}, island)"
    )


def report(gold: str, pred: str, by: str = "") -> str:
    """Per-type scores and their three averages from two span tables."""
    b = f"{by}, " if by else ""
    on = f"USING ({by + ', ' if by else ''}type)"
    group = f"GROUP BY {by}" if by else ""
    return (
        f"g AS (SELECT {b}type, count(*) AS support FROM {gold} GROUP BY {b}type), "
        f"p AS (SELECT {b}type, count(*) AS predicted FROM {pred} GROUP BY {b}type), "
        f"h AS (SELECT {b}type, count(*) AS tp FROM (SELECT * FROM {gold} INTERSECT SELECT * FROM {pred}) "
        f"GROUP BY {b}type), "
        f"counts AS (SELECT {b}type, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted, "
        f"coalesce(support, 0) AS support FROM g FULL JOIN p {on} FULL JOIN h {on}), "
        f"micro_counts AS (SELECT {b}'micro avg' AS type, sum(tp) AS tp, sum(predicted) AS predicted, "
        f"sum(support) AS support FROM counts {group}), "
        "scored AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, "
        "CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM "
        "(SELECT * FROM counts UNION ALL SELECT * FROM micro_counts)), "
        "full_scores AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / "
        "(precision + recall) ELSE 0 END AS f1 FROM scored), "
        "types AS (SELECT * FROM full_scores WHERE type <> 'micro avg'), "
        f"report AS (SELECT {b}type, precision, recall, f1, support FROM full_scores UNION ALL "
        f"SELECT {b}'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM types {group} "
        f"UNION ALL SELECT {b}'weighted avg', sum(precision * support) / sum(support), "
        f"sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) "
        f"FROM types {group})"
    )


# Sub-word pieces of four letters with their tags.
PIECES = (
    sentences(f"[^{BLANKS}#Ġ]+") + ", cut AS (SELECT sent_id, i, word, tag AS gold, "
    "CASE WHEN length(word) % 7 = 0 THEN 'O' ELSE tag END AS tag, "
    "CAST(unnest(range(CAST(ceil(length(word) / 4) AS BIGINT))) AS BIGINT) AS k FROM gold), "
    "pieces AS (SELECT *, (CASE WHEN k > 0 THEN '##' ELSE '' END) || substr(word, k * 4 + 1, 4) AS piece, "
    "CASE WHEN k = 0 OR tag = 'O' THEN tag ELSE 'I' || substr(tag, 2) END AS piece_tag, "
    "row_number() OVER (PARTITION BY sent_id ORDER BY i, k) - 1 AS place, "
    "max(k) OVER (PARTITION BY sent_id, i) AS last_k FROM cut)"
)

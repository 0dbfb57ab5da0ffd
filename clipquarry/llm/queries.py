"""The queries of the operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipquarry.llm import decontaminate, importance, language, merkle, mixing, phrases, quality, simhash, token_counts, token_output, topk, toxicity, warc_zip
from clipquarry.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
END_ID = 1


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


@query("""
WITH sizes AS (SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS size FROM documents GROUP BY source),
weighted AS (SELECT source, size, CASE WHEN size > 0 THEN pow(size::DOUBLE, 0.5) ELSE 0 END AS weight FROM sizes),
rates AS (
  SELECT source, CASE WHEN weight > 0
    THEN (SELECT sum(size) FROM weighted)::DOUBLE * weight / (SELECT sum(weight) FROM weighted) / size ELSE 0 END AS rate
  FROM weighted
),
parts AS (SELECT source, rate / greatest(ceil(rate / 500), 1) AS rate, greatest(ceil(rate / 500), 1)::BIGINT AS n FROM rates),
mass AS (
  SELECT source, n, k, sum(CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE (k = 0)::INT END)
    OVER (PARTITION BY source ORDER BY k) AS c
  FROM parts, range(0, 700) AS t(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 30)
),
keyed AS (
  SELECT d.*, p.n, md5(concat_ws('|', '42', coalesce(d.doc_id::VARCHAR, '-'), coalesce(md5(d.text), '-'))) AS h
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
),
drawn AS (
  SELECT keyed.*, j, ('0x' || substr(md5(h || '#' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM keyed, range(1, 1000) AS t(j) WHERE j <= keyed.n
),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, h, count(*) AS n
  FROM drawn d JOIN mass m ON d.source IS NOT DISTINCT FROM m.source AND m.c <= d.u
  GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5(h || '@' || copy) AS shuffle_key
FROM counted, range(1, 5000) AS t(copy) WHERE copy <= n
""")
def op1_mix_sources(spark, sf_dir):
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


@query()
def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    scored = quality.score_quality(docs, quality.train(docs, labels), carry=["doc_id"])
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out("row.doc_id").alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= quality.LEAST_TAIL).alias("keep"),
    )


@query()
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


@query()
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.train(docs.where(~held_out("doc_id")))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query()
def op5_token_output(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    read = token_output.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), path, end_id=END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
""")
def op6_warc_zip(spark, sf_dir):
    manifest = warc_zip.write_packages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc_zip.read_packages(manifest).select(*columns)


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.f, c.f)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
""")
def op7_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query()
def op8_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op9_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), path)


# Words: DuckDB's pattern engine wants the class by code points; a NUL cannot stand in a SQL string.
_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, coalesce({_WORDS.format("text")}, []) AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM sized, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d, lengths, LATERAL (SELECT unnest(range(1, greatest(len(w) - n + 2, 1))) AS i)
),
found AS (SELECT r, i, n, item FROM grams JOIN windows USING (n, g)),
hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, i, n FROM found), LATERAL (SELECT unnest(range(i, i + n)) AS p) GROUP BY r
),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
""")
def op10_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )

@query()
def op11_phrase_fingerprint(spark, sf_dir):
    return phrases.edited_neighbours(table(spark, sf_dir, "documents", "doc_id", "text"))


_TABLE = """
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) AS r(b)
"""  # of CRC-32


def _merkle_sql(levels: int = 7) -> str:
    """Trees of up to 16 ** (levels - 1) leaves, a level per step: the twin has no loop."""
    value = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
    before = "||".join(value.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + "||"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tree = lambda own, order, source: f"""
      SELECT {source} AS tree, row_number() OVER (PARTITION BY {source} ORDER BY {order}) - 1 AS i,
        count(*) OVER (PARTITION BY {source}) AS n, {own} AS h"""  # noqa: E731

    def steps(name: str) -> str:
        out = []
        for k in range(1, levels):
            out.append(f"""{name}{k} AS (
              SELECT tree, i // 16 AS i, any_value((n + 15) // 16) AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
              FROM {name}{k - 1} WHERE n > 1 GROUP BY tree, i // 16)""")
        union = " UNION ALL ".join(f"SELECT {k} AS level, * FROM {name}{k}" for k in range(levels))
        return ",\n".join(out) + f",\n{name}_all AS ({union})"

    def climb(name: str, start: str) -> str:
        """Left and right siblings of ``start`` (key, tree, i) at every level, and the proof so far."""
        out = [f"{name}_up0 AS (SELECT *, h AS f FROM {start})"]
        for k in range(1, levels):
            out.append(f"""{name}_up{k} AS (
              SELECT u.key, u.tree, u.i // 16 AS i, any_value(u.proof) || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i <> u.i), '') AS proof,
                CASE WHEN any_value(s.n) > 1 THEN sha256(string_agg(CASE WHEN s.i = u.i THEN u.f ELSE s.h END, '' ORDER BY s.i)) ELSE any_value(u.f) END AS f
              FROM {name}_up{k - 1} u LEFT JOIN {name}_all s
                ON s.level = {k - 1} AND s.n > 1 AND s.tree = u.tree AND s.i // 16 = u.i // 16
              GROUP BY u.key, u.tree, u.i)""")
        return ",\n".join(out)

    return f"""
WITH tab AS ({_TABLE}),
ids AS (
  SELECT *, xor(4294967295, list_reduce([unicode(x) for x in string_split(doc_id::VARCHAR, '')],
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS crc
  FROM documents, tab
),
d AS (
  SELECT row_number() OVER () AS key, doc_id, coalesce(':' || source, '-') AS tree,
    sha256({before}{value.format("text")}) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256({before}{value.format(lower)}) ELSE sha256({before}{value.format("text")}) END AS candidate
  FROM ids
),
a0 AS ({tree("leaf", "doc_id NULLS FIRST, leaf, key", "tree")} FROM d),
place AS (SELECT key, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, key) - 1 AS i, candidate FROM d),
{steps("a")},
subroots AS (SELECT tree, h FROM a_all WHERE n = 1),
b0 AS ({tree("h", "tree", "''")} FROM subroots),
sources AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS i FROM subroots),
{steps("b")},
root AS (SELECT h FROM b_all WHERE n = 1),
start AS (SELECT key, tree, i, '' AS proof, candidate AS h FROM place),
{climb("a", "start")},
middle AS (SELECT u.key, '' AS tree, s.i, u.proof, u.f AS h FROM a_up{levels - 1} u JOIN sources s USING (tree)),
{climb("b", "middle")}
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(u.proof) AS proof_sha256, u.f AS folded_root, u.f = r.h AS verified
FROM d JOIN b_up{levels - 1} u USING (key) JOIN subroots s ON s.tree = d.tree, root r
"""


@query(_merkle_sql())
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", *merkle.FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = merkle.leaves(docs, changed=lambda c: {"text": merkle.lower_ascii(c["text"])}, when=tampered)
    return merkle.prove(merkle.build(rows))



@query(f"""
WITH tab AS ({_TABLE}),
d AS (SELECT row_number() OVER () AS key, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT row_number() OVER () AS key, coalesce({_WORDS.format("text")}, []) AS w FROM benchmark),
runs AS (
  SELECT 'd' AS side, key, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d, range(1, 4) AS r(n), LATERAL (SELECT unnest(range(1, greatest(len(w) - n + 2, 1))) AS i)
  UNION ALL
  SELECT 'b', key, array_to_string(w[i:i + n - 1], ' ')
  FROM b, range(1, 4) AS r(n), LATERAL (SELECT unnest(range(1, greatest(len(w) - n + 2, 1))) AS i)
),
features AS (SELECT side, key, g, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT g, list_transform(range(1, octet_length(encode(g)) + 1), lambda i: ('0x' || substr(hex(encode(g)), 2 * i - 1, 2))::BIGINT) AS l
  FROM (SELECT DISTINCT g FROM features)
),
placed AS (
  SELECT g, xor(4294967295, list_reduce(l, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket
  FROM bytes, tab
),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM features JOIN placed USING (g) GROUP BY bucket
),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
),
weights AS (
  SELECT key, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM features JOIN placed USING (g) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY key
),
scored AS (
  SELECT key, doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (key)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST, n_features, key) AS r FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND r <= 5 * (SELECT count(*) FROM scored WHERE able) // 100 THEN r END AS rank
FROM ranked
""")
def op12_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark", "text"))

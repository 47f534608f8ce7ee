"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    byte_bpe,
    chat,
    importance,
    knn,
    line_dedup,
    minhash,
    packing,
    phrase_index,
    pii,
    quality_rules,
    spelling,
    substrings,
    weak_labels,
)
from lakemart.llm.tables import table

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = byte_bpe.decode(byte_bpe.encode(documents))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_rules.quality(documents, labels).select(*columns, "base_failed", "kept")


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return substrings.remove_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(documents)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    pieces = packing.tokenize(documents).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return packing.pack(pieces, documents.count())


def op9_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return knn.top_k(vectors, F.col("vec_id") % 20 == 0)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [
        F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{kind}')) AS bigint)").alias(
            f"n_{kind}"
        )
        for kind in pii.BASE
    ]

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"])
            ),
            ",",
        )

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_minhash": op3_minhash,
    "op4_weak_labels": op4_weak_labels,
    "op5_quality_rules": op5_quality_rules,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_line_dedup": op7_line_dedup,
    "op8_packing": op8_packing,
    "op9_knn": op9_knn,
    "op10_personal_data": op10_personal_data,
    "op11_contamination": op11_contamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_importance": op13_importance,
}

SQL: dict[str, str] = {
    "op1_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
         (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *,
    length('### : </turn>') + 2 + length(role) + length(text)
    + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
    + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS chars,
    CASE WHEN role = 'assistant' THEN text ELSE '' END AS masked
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(sum(length(masked)) AS BIGINT) AS loss_chars,
  sha256(string_agg(masked, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op3_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words
    WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id,
  d.doc_id = min(b) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
""",
    "op6_repeated_passages": r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)
), later AS (
  SELECT doc_id, i FROM (
    SELECT *, min(doc_id) OVER (PARTITION BY words) AS first FROM windows)
  WHERE first < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM later
), places AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM places p ANTI JOIN gone g USING (doc_id, i) GROUP BY p.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""",
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents
), words AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), runs AS (
  SELECT doc_id, n, line || chr(10) || lead(line) OVER w || chr(10) || lead(line, 2) OVER w AS run
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY n)
), later AS (
  SELECT doc_id, n FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, n) AS place
    FROM runs WHERE run IS NOT NULL)
  WHERE place > 1
), gone AS (
  SELECT DISTINCT w.doc_id, w.i
  FROM (SELECT doc_id, unnest(range(n, n + 3)) AS n FROM later) JOIN words w USING (doc_id, n)
)
SELECT d.doc_id, any_value(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END)
    AS text,
  count(w.i) AS n_lines, count(g.i) AS n_removed
FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i
LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept
  FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
) k ON k.doc_id = d.doc_id
GROUP BY d.doc_id
""",
    "op9_knn": """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))
    AS v, embedding
  FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors q, vectors c
  WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op11_contamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
    FROM (SELECT *, least(len(w), 10) AS size FROM items WHERE len(w) > 0))
), placed AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
    FROM words, (SELECT DISTINCT size FROM wanted))
), found AS (
  SELECT doc_id, i, size, item_id FROM placed JOIN wanted USING (size, phrase)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit,
  coalesce(m.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM words LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT *, list_transform(string_split(rtrim(regexp_replace(
    hex(encode(doc_id || ':' || run)), '(..)', '\1 ', 'g')), ' '),
    lambda x: CAST('0x' || x AS BIGINT)) AS b
  FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda h, x: list_reduce(
    [xor(h, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: xor(y >> 1, 3988292384 * (y & 1))),
    4294967295), 4294967295) AS h
  FROM bytes
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS gap,
    substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n
  FROM cut a JOIN cut b ON a.gap = b.gap AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word
), best AS (
  SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place,
    count(*) OVER (PARTITION BY word) AS n_near
  FROM near
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.n >= 5 * w.n THEN b.near END AS form,
    CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1
), chain AS (
  SELECT word, word AS at, form FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
""",
    "op13_importance": r"""
WITH lowered AS (
  SELECT 0 AS side, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
  UNION ALL
  SELECT 1, item_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM benchmark
), words AS (
  SELECT side, doc_id,
    regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM lowered
), found AS (
  SELECT side, doc_id, unnest(w) AS feature FROM words
  UNION ALL
  SELECT side, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM words
), counted AS (
  SELECT side, doc_id, feature, count(*) AS n FROM found GROUP BY ALL
), bytes AS (
  SELECT feature, list_transform(string_split(
    rtrim(regexp_replace(hex(encode(feature)), '(..)', '\1 ', 'g')), ' '),
    lambda x: CAST('0x' || x AS BIGINT)) AS b
  FROM (SELECT DISTINCT feature FROM counted)
), hashed AS (
  SELECT feature, xor(list_reduce(b, lambda h, x: list_reduce(
    [xor(h, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: xor(y >> 1, 3988292384 * (y & 1))),
    4294967295), 4294967295) % 10000 AS bucket
  FROM bytes
), placed AS (
  SELECT side, doc_id, bucket, n FROM counted JOIN hashed USING (feature)
), sums AS (
  SELECT bucket, CAST(sum(n) FILTER (side = 0) AS DOUBLE) AS s,
    CAST(sum(n) FILTER (side = 1) AS DOUBLE) AS t
  FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000.0::DOUBLE * ln(
    (coalesce(t, 0) + 1) * ((SELECT sum(s) FROM sums) + 10000)
    / ((coalesce(s, 0) + 1) * ((SELECT sum(t) FROM sums) + 10000)))) AS BIGINT) AS gain
  FROM sums
), weights AS (
  SELECT doc_id, sum(n) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
), scored AS (
  SELECT w.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln(
      (CAST('0x' || left(sha256('7:' || w.doc_id), 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score,
    len(w) >= 20 AS wanted
  FROM words w LEFT JOIN weights USING (doc_id) WHERE side = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (wanted) OVER () * 25 // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN wanted AND place <= drawn THEN place END AS rank
FROM ranked
""",
}

"""The registered queries of the operators in this subpackage: thin, under their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import (
    collocations,
    decontaminate,
    embedding_dedup,
    html_text,
    labelled_urls,
    language,
    license_scan,
    lm_score,
    secret_scan,
    sentence_pieces,
    simhash,
    spelling,
    toxicity,
    url_filter,
)
from quillframe.llm.common import is_held_out, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: three-word shingles, two bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in 13-word windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded into pieces and decoded again."""
    return sentence_pieces.encode(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    found = html_text.extract(table(spark, sf_dir, "pages"), html_text.train(), keep=["url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and model verdicts on the URLs of all pages."""
    labelled = spark.createDataFrame(labelled_urls.urls(), "url string, label int")
    found = url_filter.judge(table(spark, sf_dir, "pages"), url_filter.fit(labelled))
    return found.select("page_id", "host", "path", "rule", "verdict", "block_score")


def _spans_text(spans: str):
    """Column: kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["first"].cast("string"), x["end"].cast("string"))))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: the fixed patterns, and what compression finds new."""
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))

    def of(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.withColumn("base", F.filter("spans", lambda x: x["kind"] != "novel")).select(
        "doc_id",
        of("assign"),
        of("access"),
        of("hex"),
        F.sha2(_spans_text("base"), 256).alias("base_sha256"),
        _spans_text("spans").alias("spans"),
        of("novel"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a suffix tree learned from those whose crc32 mod 10 isn't 0."""
    held_out = is_held_out(F.col("doc_id"), 10, 0)
    found = lm_score.score(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those whose crc32 mod 4 isn't 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels whose crc32 mod 5 isn't 0."""
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out(F.col("doc_id"), 5, 0)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, lexicon).select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings linked within their label at a cosine of 0.93 or more."""
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent ones that they are one edit away from."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language whose words stand together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", "found")).alias("labels"),
        "score",
    )


_WORDS = r"""list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.n, dw.p, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM m)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
           SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT run, n, [CAST('0x' || x[1:2] AS BIGINT) FOR x IN regexp_extract_all(hex(encode(doc_id || ':' || run)), '..')] AS bytes FROM runs),
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
      FROM coded, bits),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM h)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, left(word, i - 1) || '*' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS shorter
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.hole = y.hole AND x.word <> y.word
          UNION SELECT cut.word, w.word FROM cut JOIN w ON cut.shorter = w.word
          UNION SELECT w.word, cut.word FROM cut JOIN w ON cut.shorter = w.word),
best AS (SELECT a, b, w.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
         FROM pairs JOIN w ON b = word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 5 * n THEN b END AS form, CASE WHEN b_n >= 5 * n THEN b_n END AS form_n
           FROM w LEFT JOIN best ON a = word AND place = 1),
chain(word, goal) AS (SELECT word, form FROM formed WHERE form IS NOT NULL
                    UNION ALL SELECT chain.word, form FROM chain JOIN formed ON goal = formed.word WHERE form IS NOT NULL),
ends AS (SELECT chain.word, goal AS root FROM chain JOIN formed ON goal = formed.word WHERE form IS NULL)
SELECT formed.word, form, coalesce(root, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends ON formed.word = ends.word
"""

OP12_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k AS size, phrase, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 30),
most AS (SELECT lang, phrase, max(a) AS most FROM (
           SELECT lang, a, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, size - k + 2)]) AS phrase
           FROM (SELECT *, unnest(range(2, size)) AS k FROM c)) GROUP BY ALL),
left_over AS (SELECT c.* FROM c LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
         FROM (SELECT *, unnest(range(1, size)) AS k FROM left_over)),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, CAST(2000000 * CAST(cuts.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
lowest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def _sql_values(rows) -> str:
    """Rows of a VALUES clause."""
    text = lambda v: f"[{', '.join(map(text, v))}]" if isinstance(v, list) else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join(f"({', '.join(map(text, r))})" for r in rows)


#: Every block is held against every template of its class.
OP13_SQL = rf"""
WITH phrase(label, p) AS (VALUES {_sql_values((label, p.split()) for p, label in license_scan.PHRASES)}),
template(t, label, length, need, own) AS (VALUES {_sql_values((t.number, t.label, t.length, t.need, t.words) for t in license_scan.templates())}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
base AS (SELECT r, label, i - 1 AS place FROM (SELECT r, w, label, p, unnest(range(1, len(w) - len(p) + 2)) AS i FROM d, phrase WHERE len(w) >= len(p))
         WHERE w[i:i + len(p) - 1] = p),
b AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS l FROM base GROUP BY r),
block AS (SELECT r, length, k, list_distinct(w[k * length // 2 + 1:k * length // 2 + length // 2 * 3]) AS w
          FROM (SELECT r, w, length, unnest(range(0, (len(w) - 1) // (length // 2) + 1)) AS k FROM d, (SELECT DISTINCT length FROM template) WHERE len(w) > 0)),
met AS (SELECT *, overlap / len(own) AS share FROM (
          SELECT r, block.length, k, t, label, need, own, len(list_intersect(block.w, own)) AS overlap FROM block JOIN template ON block.length = template.length)
        WHERE overlap >= need),
kept AS (SELECT * FROM met x WHERE NOT EXISTS (
           SELECT 1 FROM met y WHERE y.r = x.r AND y.length = x.length AND y.k = x.k AND y.label <> x.label
             AND (len(list_intersect(x.own, y.own)) >= y.need OR len(list_intersect(x.own, y.own)) >= x.need)
             AND (y.share > x.share OR y.share = x.share AND y.overlap > x.overlap))),
m AS (SELECT r, max(share) AS share, list(DISTINCT label) AS l FROM kept GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(b.l, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.l, []), coalesce(m.l, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b ON b.r = d.r LEFT JOIN m ON m.r = d.r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_sentence_pieces": op2_sentence_pieces,
        "op3_html_text": op3_html_text,
        "op4_url_filter": op4_url_filter,
        "op5_secrets": op5_secrets,
        "op6_lm_score": op6_lm_score,
        "op7_language": op7_language,
        "op8_toxicity": op8_toxicity,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_decontaminate": op10_decontaminate,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_collocations": op12_collocations,
        "op13_license_scan": op13_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_decontaminate": OP10_SQL, "op11_spelling_variants": OP11_SQL, "op12_collocations": OP12_SQL, "op13_license_scan": OP13_SQL}

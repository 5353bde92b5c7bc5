"""One query for each operator, over its whole table, with the operators' own defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    byte_bpe,
    decontaminate,
    language,
    passage_trees,
    prefix_trie,
    simhash,
    suffix_dedup,
    token_counts,
    token_store,
    topk,
    toxicity,
    vector_codes,
    warc,
)
from tideline.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    model = toxicity.fit(docs, labels)
    scored = toxicity.with_score(docs, model).withColumn("held_out", toxicity.held_out())
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.store(table(spark, folder, "documents"))


@query
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out()))
    scored = language.with_language(docs.select("doc_id", "text"), model).withColumn("held_out", language.held_out())
    return scored.select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where("vec_id % 100 = 0"), repeats=True)


ORACLES["op6_topk"] = """
WITH used AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM used q JOIN used c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.find(docs, table(spark, folder, "benchmark").select("item_id", "text"), strict=False)


@query
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.encode(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


def _vector_codes_sql() -> str:
    """Two rounds over all entries of the codebooks, without any shortcut."""
    steps = []
    for r in range(3):
        steps.append(f"""
        found{r} AS (
            SELECT a.row, a.part, min(struct_pack(d := a.d, e := a.entry)) AS best FROM (
                SELECT p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
                FROM pieces p JOIN book{r} b ON p.part = b.part AND p.position = b.position GROUP BY ALL) a
            GROUP BY ALL)""")
        if r < 2:
            steps.append(f"""
        mean{r} AS (
            SELECT p.part, f.best.e AS entry, p.position, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
            FROM pieces p JOIN found{r} f ON p.row = f.row AND p.part = f.part GROUP BY ALL),
        book{r + 1} AS (
            SELECT b.part, b.entry, b.position, coalesce(m.x, b.x) AS x FROM book{r} b
            LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry AND b.position = m.position)""")
    return f"""
    WITH kept AS (
        SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) AS row FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    flat AS (
        SELECT row, len(embedding) // 16 AS size, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS spot FROM kept),
    pieces AS (
        SELECT row, spot // size AS part, spot % size AS position, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM flat),
    book0 AS (SELECT part, row - 1 AS entry, position, x FROM pieces WHERE row <= 64),
    {",".join(steps)},
    coded AS (
        SELECT row, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY part) AS code,
               CAST(sum(best.d) AS BIGINT) AS error
        FROM found2 GROUP BY row)
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, position)) FROM book2) AS codebooks_sha256
    FROM kept k JOIN coded c ON k.row = c.row
    """


ORACLES["op12_vector_codes"] = _vector_codes_sql()


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


ORACLES["op11_prefix_trie"] = """
WITH own AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n,
           coalesce(role, '') AS r, coalesce(text, '') AS t
    FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
    SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) AS crc
    FROM (SELECT DISTINCT c FROM own)),
convs AS (SELECT c, c - c % 5 AS base, crc % 9 AS h FROM crc),
built AS (
    SELECT v.c, o.n AS k, r, t FROM convs v JOIN own o ON o.c = v.base AND o.n <= v.h
    UNION ALL SELECT v.c, 1000000 + o.n, r, t FROM convs v JOIN own o ON o.c = v.c AND o.n > v.h),
seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, {'r': r, 't': t} AS what FROM built),
pre AS (
    SELECT c, d, strlen(what.t) AS bytes, list(what) OVER (PARTITION BY c ORDER BY d) AS p FROM seq
    UNION ALL SELECT c, 0, 0, [] FROM convs),
nodes AS (
    SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    FROM pre GROUP BY p, d),
member AS (SELECT pre.c, pre.d, n.conv_id FROM pre JOIN nodes n ON pre.p = n.p AND pre.d = n.d),
linked AS (
    SELECT n.conv_id, n.d, m.conv_id AS parent, n.n_convs, (n.n_convs - 1) * n.bytes AS saved
    FROM nodes n LEFT JOIN member m ON m.c = n.conv_id AND m.d = n.d - 1),
kids AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
below AS (
    SELECT m.conv_id, m.d, count(*) FILTER (k.n IS NULL) AS leaves, sum(l.saved) AS saved
    FROM linked l JOIN member m ON m.c = l.conv_id AND m.d <= l.d LEFT JOIN kids k ON k.conv_id = l.conv_id AND k.d = l.d
    GROUP BY ALL),
ends AS (
    SELECT m.conv_id, m.d, string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) AS list
    FROM member m JOIN (SELECT c, max(d) AS d FROM pre GROUP BY c) e ON m.c = e.c AND m.d = e.d GROUP BY ALL)
SELECT l.conv_id, l.d AS depth, l.parent AS parent_conv_id, l.n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.list, '')) AS ends_sha256
FROM linked l JOIN below b ON b.conv_id = l.conv_id AND b.d = l.d
LEFT JOIN kids k ON k.conv_id = l.conv_id AND k.d = l.d LEFT JOIN ends e ON e.conv_id = l.conv_id AND e.d = l.d
"""


@query
def op13_passage_trees(spark: SparkSession, folder: str) -> DataFrame:
    found = passage_trees.remove_passages(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op13_passage_trees"] = r"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
hashed AS (
    SELECT doc_id, r, unnest(list_transform(range(1, len(words) - 48), lambda i: md5(array_to_string(words[i:i + 49], ' ')))) AS h,
           unnest(range(1, len(words) - 48)) AS i
    FROM split WHERE len(words) >= 50),
gone AS (SELECT r, i FROM hashed JOIN (SELECT h, min(doc_id) AS least FROM hashed GROUP BY h) USING (h) WHERE doc_id > least),
word AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
near AS (
    SELECT word.r, word.i, w, max(gone.i) OVER (PARTITION BY word.r ORDER BY word.i) AS last
    FROM word LEFT JOIN gone ON word.r = gone.r AND word.i = gone.i),
told AS (
    SELECT r, count(*) AS n, count(*) FILTER (last >= i - 49) AS removed,
           string_agg(w, ' ' ORDER BY i) FILTER (last IS NULL OR last < i - 49) AS kept
    FROM near GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN told USING (r)
"""

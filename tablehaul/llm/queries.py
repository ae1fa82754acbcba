"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from tablehaul.llm.common import documents
from tablehaul.llm.decontamination import contaminated
from tablehaul.llm.exact_dedup import exact_duplicates
from tablehaul.llm.language_id import languages
from tablehaul.llm.mixing import mixed
from tablehaul.llm.pii import personal_data_digest
from tablehaul.llm.prefix_trie import rebuilt_trie
from tablehaul.llm.quality_classifier import quality_scores
from tablehaul.llm.quality_rules import judged
from tablehaul.llm.secrets import secret_digest
from tablehaul.llm.sentence_pieces import encoded
from tablehaul.llm.simhash import near_duplicates
from tablehaul.llm.token_counts import token_counts
from tablehaul.llm.whitening import whitened

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(spark, sf_dir).withColumnRenamed("id", "doc_id")
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_quality_rules")
def op1(spark, sf_dir):
    return judged(documents(spark, sf_dir))


@query("op2_source_mixing")
def op2(spark, sf_dir):
    return mixed(documents(spark, sf_dir))


@query("op3_sentence_pieces")
def op3(spark, sf_dir):
    return encoded(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_secrets")
def op4(spark, sf_dir):
    return secret_digest(documents(spark, sf_dir))


@query("op5_language_id")
def op5(spark, sf_dir):
    return languages(documents(spark, sf_dir))


@query("op6_personal_data")
def op6(spark, sf_dir):
    return personal_data_digest(documents(spark, sf_dir))


@query("op7_token_counts")
def op7(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_simhash")
def op8(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))


@query("op9_quality_classifier")
def op9(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels)


@query(
    "op10_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
              doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
)
def op10(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


@query("op11_embedding_whitening")
def op11(spark, sf_dir):
    return whitened(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


@query(
    "op12_prefix_trie",
    """WITH t AS (
         SELECT conv_id AS c, r, x, row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(strlen(r), ':', r, x))) AS pos
         FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
               FROM conversations WHERE conv_id IS NOT NULL)),
       l AS (SELECT c, list({'r': r, 'x': x} ORDER BY pos) AS l FROM t GROUP BY c),
       -- crc32, bit by bit
       h AS (SELECT c, l, c - c % 5 AS base, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
               lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                     lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 9 AS h FROM l),
       p AS (SELECT h.c, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS p FROM h LEFT JOIN l AS b ON b.c = h.base),
       m AS (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM p),
       n AS (SELECT p[1:d] AS path, d, min(c) AS conv, count(*) AS n,
                    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(p) = d), '') AS ends
             FROM m GROUP BY 1, 2),
       k AS (SELECT path[1:d - 1] AS path, count(*) AS k FROM n WHERE d > 0 GROUP BY 1),
       f AS (SELECT n.*, coalesce(k, 0) AS k, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(path[d].x) END AS s
             FROM n LEFT JOIN k USING (path)),
       u AS (SELECT path, d, k, s, unnest(range(0, d + 1)) AS a FROM f),
       g AS (SELECT path[1:a] AS path, count(*) FILTER (k = 0) AS leaves, sum(s) AS saved FROM u GROUP BY 1)
       SELECT f.conv AS conv_id, f.d AS depth, o.conv AS parent_conv_id, f.n AS n_convs, f.k AS n_children,
              g.leaves AS n_leaves, CAST(g.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
       FROM f JOIN g USING (path) LEFT JOIN f AS o ON f.d > 0 AND o.path = f.path[1:f.d - 1]""",
)
def op12(spark, sf_dir):
    nodes = rebuilt_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


@query(
    "op13_decontamination",
    """WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
       i AS (SELECT DISTINCT item, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda s: w[s:s + 9])) AS win
             FROM b WHERE len(w) > 0),
       n AS (SELECT DISTINCT len(win) AS n FROM i),
       d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
       e AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, n),
       h AS (SELECT r, s, n, item FROM e JOIN i ON i.win = e.w[e.s:e.s + e.n - 1]),
       q AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM h) GROUP BY r),
       o AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
       SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
              sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
       FROM d LEFT JOIN q USING (r) LEFT JOIN o USING (r)""",
)
def op13(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return contaminated(documents(spark, sf_dir), benchmark).drop("stretches")

"""One thin query per operator: (spark, sf_dir) -> DataFrame, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


@register("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.html_extract import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


_PLAIN_SQL = r"trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'))"


def _shingles_sql(name: str, source: str, key: str) -> str:
    """CTEs that end in ``name`` (key, pos, sh): the five-word shingles in order, or the whole of fewer words."""
    return f"""{name}_w AS (SELECT {key}, string_split({_PLAIN_SQL}, ' ') AS w FROM {source} WHERE {_PLAIN_SQL} <> ''),
{name} AS (SELECT {key}, i AS pos, array_to_string(w[i + 1:i + 5], ' ') AS sh
           FROM (SELECT {key}, w, unnest(range(greatest(len(w) - 5, 0) + 1)) AS i FROM {name}_w))"""


OP2_SQL = f"""
WITH {_shingles_sql("d", "documents", "doc_id")},
{_shingles_sql("b", "benchmark", "item_id")},
n AS (SELECT item_id, count(DISTINCT sh) AS n_shingles FROM b GROUP BY item_id),
m AS (SELECT d.doc_id, b.item_id, count(DISTINCT d.sh) AS n_shared FROM d JOIN b USING (sh) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= ceil(round(n_shingles * 0.8, 9))
"""


@register("op2_decontamination", OP2_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8, size=5)


@register("op3_pii_sanitisation")
def op3_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.pii import digest, find_pii

    return digest(find_pii(table(spark, sf_dir, "documents")))


def _op4_sql() -> str:
    from heatwise.llm.licenses import TEMPLATES

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))
    return f"""
WITH t(license, text) AS (VALUES {rows}),
{_shingles_sql("k", "t", "license")},
kn AS (SELECT license, sh, count(*) OVER (PARTITION BY license) AS n_shingles FROM (SELECT DISTINCT license, sh FROM k)),
ks AS (SELECT *, CAST(power(2, ceil(log2(n_shingles))) AS BIGINT) AS span FROM kn),
{_shingles_sql("d", "documents", "doc_id")},
h AS (SELECT d.doc_id, d.pos, d.sh, ks.license, ks.n_shingles, ks.span FROM d JOIN ks USING (sh)),
w AS (SELECT *, pos // span AS win FROM h UNION ALL SELECT *, pos // span - 1 AS win FROM h WHERE pos >= span),
c AS (SELECT doc_id, license, n_shingles, win, count(DISTINCT sh) AS n_shared, min(pos) AS first_word FROM w GROUP BY ALL)
SELECT doc_id, license, n_shingles, n_shared, first_word FROM c
WHERE n_shared >= ceil(round(n_shingles * 0.8, 9))
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY n_shared DESC, first_word) = 1
"""


@register("op4_license_scan", _op4_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"), threshold=0.8, size=5)


OP5_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
      FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@register("op5_line_dedup", OP5_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.line_dedup import dedup_lines, digest

    return digest(dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3))


@register("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.simhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3)


@register("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.secret_scan import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


@register("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.quality_gbt import score_documents, train

    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels"), max_labels=20_000))


@register("op9_bpe_codec")
def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.bpe_trie import encode_documents

    docs = table(spark, sf_dir, "documents")
    out = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@register("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


_CRC32 = 0xEDB88320  # the reversed polynomial of CRC-32


def _op11_sql() -> str:
    """Descents as window maxima over one row per child; CRC-32 byte by byte over the text."""
    from heatwise.llm.hash_tree import grow, layout

    def tree(name: str, rows: list) -> str:
        values = ", ".join(f"('{r}', '{r}/{k}', '{r}/{k}/{s}', {s}, {w})" for r, k, s, w in rows)
        draw = "ln((('0x' || substr(md5(key || '|' || {p}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / w"
        level = """{n}{to} AS (SELECT doc_id, key, {path} FROM (SELECT k.doc_id, k.key, t.{path}, t.w FROM {of} k
JOIN (SELECT {up}{path}, sum(w) AS w FROM {n}t GROUP BY ALL) t ON {on})
QUALIFY row_number() OVER (PARTITION BY key ORDER BY """ + draw.format(p="{path}") + """ DESC, {path} DESC) = 1)"""
        steps = [level.format(n=name, to="r", path="region", of="ids", up="", on="true"),
                 level.format(n=name, to="k", path="rack", of=f"{name}r", up="region, ", on="t.region = k.region"),
                 level.format(n=name, to="s", path="leaf", of=f"{name}k", up="rack, ", on="t.rack = k.rack")]
        return (f"{name}t(region, rack, leaf, shard, w) AS (VALUES {values}),\n" + ",\n".join(steps)
                + f",\n{name} AS (SELECT doc_id, key, shard FROM {name}s JOIN {name}t USING (leaf))")

    tree_now, tree_then = layout(40), grow(layout(40))
    return f"""
WITH bits AS (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_CRC32}) ELSE c >> 1 END,
                                    b) AS c FROM range(256) r(b)),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits),
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
             regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS hx FROM documents),
s AS (SELECT doc_id, size, key, xor(list_reduce(list_transform(hx, lambda x: ('0x' || x)::BIGINT),
             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM d, crc),
ids AS (SELECT DISTINCT doc_id, key FROM s),
{tree("n", tree_now)},
{tree("g", tree_then)},
o AS (SELECT s.*, n.shard, g.shard AS grown_shard,
             ('0x' || substr(md5(s.key || '|' || size || '|' || text_crc32), 1, 13))::BIGINT AS h
      FROM s JOIN n USING (key) JOIN g USING (key))
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM o
"""


@register("op11_hash_tree_sharding", _op11_sql())
def op11_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.hash_tree import grow, layout, place

    tree = layout(40)
    placed = place(table(spark, sf_dir, "documents"), tree, grow(tree))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.periodic_runs import digest, find_runs, planted

    return digest(find_runs(table(spark, sf_dir, "documents"), min_words=12, rewrite=planted))


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS alike,
             CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
      FROM v a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
       AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""


@register("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heatwise.llm.hard_negatives import mine

    def label(vec_id, given):
        return F.when(vec_id % 7 == 0, (given + 1) % 10).otherwise(given)

    return mine(table(spark, sf_dir, "embeddings"), is_anchor=lambda i: i % 50 == 0, positives=5, negatives=3,
                low=50, high=95, label_of=label)

"""The dealt operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import (
    bpe_lexicon, dart_minhash, host_paths, merkle, posting_lists, quality_rules, secret_scan, substring_dedup, template_leaks, token_files, toxicity_fm, warc,
    whitening,
)
from tillworks.llm.common import shared_file, table

Query = Callable[[SparkSession, str], DataFrame]


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rated = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    return rated.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept", "quality")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substring_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """Archives are written and every page is looked up in them by its key."""
    out = shared_file(spark, "warc")
    keys = warc.archive(spark, table(spark, folder, "pages"), out)
    return warc.look_up(keys, f"{out}/directory").drop("url")


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("guess"),
    )


def op4_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = template_leaks.leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "share", "slot_share").distinct()


def op5_host_paths(spark: SparkSession, folder: str) -> DataFrame:
    texts = host_paths.main_texts(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_toxicity_fm(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_fm.scored(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_file(spark, "token-files")
    files = token_files.write(table(spark, folder, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read(spark, files, out)


def op9_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return dart_minhash.near_copies(table(spark, folder, "documents").select("doc_id", "text"))


def op10_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    docs, vocabulary = table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")
    lexicon = shared_file(spark, "lexicon")
    bpe_lexicon.build_lexicon(docs, vocabulary, lexicon)
    coded = bpe_lexicon.encode(docs, vocabulary, lexicon)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_posting_lists(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return posting_lists.search(posting_lists.build(vectors, most=10), vectors.where("vec_id % 100 = 0"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whitened(table(spark, folder, "embeddings"), most=8)
    each = F.posexplode(F.arrays_zip("whitened", "explained"))
    return found.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
        F.col("col.whitened").alias("whitened"), F.col("col.explained").alias("explained"), "identity_error")


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""


def _siblings(tree: str, key: str) -> str:
    """Of every node below a root the siblings before and after it."""
    return f"""SELECT {key}, l, p,
    CASE p % 3 WHEN 0 THEN '' WHEN 1 THEN lag(h, 1) OVER w ELSE lag(h, 2) OVER w || lag(h, 1) OVER w END AS before,
    CASE p % 3 WHEN 2 THEN '' ELSE coalesce(lead(h, 1) OVER w, '') || CASE p % 3 WHEN 0 THEN coalesce(lead(h, 2) OVER w, '') ELSE '' END END AS after
  FROM {tree} WHERE n > 1 WINDOW w AS (PARTITION BY {key}, l, p // 3 ORDER BY p)"""


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
#: The remainder of a byte string's checksum before its last inversion.
_CRC = """list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {" || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head, text, {_CRC} & 1 = 1 AS hit FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || {_FIELD.format("text")}) AS leaf,
         sha256(head || CASE WHEN hit THEN {_FIELD.format("replace(text, chr(10), '')")} ELSE {_FIELD.format("text")} END) AS now FROM d),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM hashed),
tree(t, l, p, h, n) AS (
  SELECT t, 0, p, leaf, n FROM leaves
  UNION ALL SELECT t, l + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY t, l, p // 3, n),
subroots AS (SELECT t, h, count(*) OVER () AS n FROM tree WHERE n = 1),
top(l, p, h, n) AS (
  SELECT 0, t, h, n FROM subroots
  UNION ALL SELECT l + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY l, p // 3, n),
near AS ({_siblings("tree", "t")}),
far AS ({_siblings("top", "0 AS z").replace("PARTITION BY 0 AS z", "PARTITION BY 0")}),
up(t, leaf_p, l, p, proof, folded) AS (
  SELECT t, p, 0, p, '', now FROM leaves
  UNION ALL SELECT u.t, u.leaf_p, u.l + 1, u.p // 3, u.proof || s.before || s.after, sha256(s.before || u.folded || s.after)
  FROM up u JOIN near s ON s.t = u.t AND s.l = u.l AND s.p = u.p),
inner_end AS (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY t, leaf_p ORDER BY l DESC) = 1),
further(t, leaf_p, l, p, proof, folded) AS (
  SELECT t, leaf_p, 0, t, proof, folded FROM inner_end
  UNION ALL SELECT u.t, u.leaf_p, u.l + 1, u.p // 3, u.proof || s.before || s.after, sha256(s.before || u.folded || s.after)
  FROM further u JOIN far s ON s.l = u.l AND s.p = u.p),
ends AS (SELECT * FROM further QUALIFY row_number() OVER (PARTITION BY t, leaf_p ORDER BY l DESC) = 1)
SELECT x.doc_id, x.leaf, r.h AS subroot, z.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = z.h AS verified
FROM leaves x JOIN ends e ON e.t = x.t AND e.leaf_p = x.p JOIN subroots r ON r.t = x.t CROSS JOIN (SELECT h FROM top WHERE n = 1) z
"""


def queries() -> dict[str, Query]:
    found = [
        op1_substring_dedup, op2_warc_index, op3_secret_scan, op4_template_leaks, op5_host_paths, op6_toxicity_fm, op7_token_files,
        op8_quality_rules, op9_dart_minhash, op10_bpe_lexicon, op11_posting_lists, op12_whitening, op13_merkle,
    ]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_index": OP2_SQL, "op13_merkle": OP13_SQL}

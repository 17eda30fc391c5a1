"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from harkline.llm import classlm, decontaminate, fingerprints, jaccard, lexical, lines, mixing, negatives, quality, repeats, rollup, secrets, urls
from harkline.operators.frozen import freeze
from harkline.plans.tables import Query, table
from harkline.session import tables_dir

_WORDS_SQL = r"coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), [])"


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    items = decontaminate.question_and_answer(table(spark, sf, "benchmark"))
    return decontaminate.find_items(table(spark, sf, "documents"), items).drop("text_key")


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = repeats.drop_repeats(table(spark, sf, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP2_SQL = f"""
    WITH texts AS (SELECT doc_id, {_WORDS_SQL.format(text='text')} AS w FROM documents),
      windows AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)),
      repeats AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
      gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM repeats),
      words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
      kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)"""


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf, "documents")).drop("text_key")


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages"))


def op5_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf, "documents")).drop("text_key")


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP5_SQL = f"""
    WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS_SQL.format(text=_LOWER_SQL)} AS w FROM documents),
      shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
      sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
      shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
      links AS (SELECT x, y, n_both = a.n AND n_both = b.n AS alike FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
        WHERE 100 * n_both >= 75 * (a.n + b.n - n_both)),
      sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
      reach AS (SELECT doc_id AS x, doc_id AS y FROM texts UNION SELECT r.x, s.y FROM reach r JOIN sides s ON r.y = s.x),
      smallest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
      classes AS (SELECT y, min(x) AS class_id FROM links WHERE alike GROUP BY y)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_id, doc_id) AS class_id
    FROM texts JOIN smallest ON x = doc_id LEFT JOIN sizes USING (doc_id) LEFT JOIN classes c ON c.y = doc_id"""


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Four batches: every document; a seventh of them deleted; a fifth of the rest revised to two tokens
    more; and the first batch sent again, which changes nothing."""
    docs = freeze(rollup.counted(table(spark, sf, "documents")))
    rows = rollup.TokenRollup(spark, f"{tables_dir(spark)}/{uuid4().hex}")
    added, taken = F.lit(1).alias("sign"), F.lit(-1).alias("sign")
    keys = rollup.KEYS
    gone, revised = F.col("doc_id") % 7 == 3, (F.col("doc_id") % 7 != 3) & (F.col("doc_id") % 5 == 1)
    rows.commit("load", docs.select(*keys, "tokens", added))
    rows.commit("takedown", docs.filter(gone).select(*keys, "tokens", taken))
    old = docs.filter(revised)
    new = old.select(*keys, (F.col("tokens") + 2).alias("tokens"), added)
    rows.commit("revision", old.select(*keys, "tokens", taken).unionByName(new))
    rows.commit("load", docs.select(*keys, "tokens", added))
    return rows.totals()


OP6_SQL = f"""
    WITH counted AS (
      SELECT doc_id, source, lang, 'words-1' AS tokenizer,
             len({_WORDS_SQL.format(text='text')}) AS tokens FROM documents
      UNION ALL
      SELECT doc_id, source, lang, 'bytes-1', CAST(coalesce(strlen(text), 0) AS BIGINT) FROM documents)
    SELECT source, lang, tokenizer, count(*) AS n_docs,
           CAST(sum(CASE WHEN doc_id % 5 = 1 THEN tokens + 2 ELSE tokens END) AS BIGINT) AS n_tokens
    FROM counted WHERE doc_id % 7 <> 3 GROUP BY ALL"""


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf, "documents"))
    return kept.select("row.doc_id", "line_count", "lines_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_class_lm(spark: SparkSession, sf: str) -> DataFrame:
    return classlm.score_texts(table(spark, sf, "documents"))


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    scanned = secrets.scan_secrets(table(spark, sf, "documents"))
    return scanned.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf, "documents"))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"), F.col("mix_sources")[0].alias("source"), F.col("mix_copies").alias("copies"),
    )


def op11_weighted_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    prints = fingerprints.fingerprint_edits(table(spark, sf, "documents"))
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.printed("marks").alias("fingerprint"),
        fingerprints.printed("edited_marks").alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


_TERMS_SQL = rf"coalesce(regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])"
OP12_SQL = f"""
    WITH texts AS (SELECT doc_id, {_TERMS_SQL} AS w FROM documents),
      totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM texts),
      counted AS (SELECT doc_id, any_value(len(w)) AS n, term, count(*) AS tf
        FROM (SELECT doc_id, w, unnest(w) AS term FROM texts) GROUP BY doc_id, term),
      weighted AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
        FROM counted, totals GROUP BY term),
      wanted AS (SELECT DISTINCT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark),
      scored AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM wanted JOIN weighted USING (term) JOIN counted USING (term), totals GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10"""


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), negatives.whole_components("embedding").alias("vector"))
    return negatives.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = """
    WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
        FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
      positives AS (SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5)
    SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
    WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.s DESC, n.id) QUALIFY row_number() OVER w <= 5"""


QUERIES = {
    "op1_decontamination": Query(op1_decontamination),
    "op4_url_filter": Query(op4_url_filter),
    "op5_ngram_jaccard": Query(op5_ngram_jaccard, OP5_SQL),
    "op6_token_counts": Query(op6_token_counts, OP6_SQL),
    "op2_substring_dedup": Query(op2_substring_dedup, OP2_SQL),
    "op3_quality_rules": Query(op3_quality_rules),
    "op7_line_dedup": Query(op7_line_dedup),
    "op8_class_lm": Query(op8_class_lm),
    "op9_secret_scan": Query(op9_secret_scan),
    "op10_source_mix": Query(op10_source_mix),
    "op11_weighted_fingerprint": Query(op11_weighted_fingerprint),
    "op12_lexical_search": Query(op12_lexical_search, OP12_SQL),
    "op13_hard_negatives": Query(op13_hard_negatives, OP13_SQL),
}

"""The registered queries of the corpus operators and the SQL of those that SQL can express.

A query reads its whole table, calls its operator with production parameters, and derives the
columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (
    decontaminate,
    divergence,
    html_content,
    language_id,
    matched_packing,
    mixing,
    packing,
    periodic_runs,
    pii,
    simhash,
    token_counts,
    topk,
    toxicity,
)
from panelspark.llm.common import SPACE_CLASS, ship_package, stored, word_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The file of a public tokenizer; its folder lies at the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string")) % folds


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    learn = docs.where(fold("doc_id", 5) != 0).select("doc_id", "text", "lang")
    model = language_id.fit(learn)
    return language_id.identify(
        docs.select("doc_id", held_out.alias("held_out"), "text"), model
    ).drop("text")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).drop("text")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    model = toxicity.fit(docs, labels)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    scored = toxicity.score_documents(
        docs.select("doc_id", held_out.alias("held_out"), "text"), model
    )
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        "offending",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json")).drop("text")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The text is needed for the fingerprint only, so it is not stored with it.
    docs = table(spark, sf_dir, "documents")
    prints = docs.select("doc_id", simhash.simhash(F.col("text"), 3).alias("fp"))
    return simhash.with_components(stored(prints), "doc_id", 2)


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_content.extract(pages, html_content.fit()).drop("html")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents with the items that they hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("items") > 0).select(
        "doc_id",
        F.transform("items", lambda x: x["item_id"]).alias("item_ids"),
        F.array_max(F.transform("items", lambda x: x["share"])).alias("best_share"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = matched_packing.place(docs, vocabulary("byte_bpe_50k.json"))
    return placed.select(
        F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def planted_repeats(key: Column, text: Column) -> Column:
    """The contract's texts: in one document of ten, by hash, the words from one on repeat a block.

    With n words, h the CRC of the key, g = h div 10 and a = g mod n, the words from a on repeat the first
    1 + (n - a) div (3 + g mod 8) of them. A NULL key plants nothing.
    """
    words = F.regexp_extract_all(text, F.lit(f"[^{SPACE_CLASS}]+"), F.lit(0))
    h = F.crc32(key.cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    block = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
    times = F.ceil((n - a) / block).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, block), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & text.rlike(f"[^{SPACE_CLASS}]"), planted).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    planted = docs.select("doc_id", planted_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(planted)
    # Longest first, then the smallest start and period.
    order = F.transform(
        "runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("n"))
    )
    best = F.array_min(order)
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["n"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["n"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce('s:' || source, 'null') AS name
  FROM documents
), per AS (
  SELECT name, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY name
), w AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
         source_size * 2.0::DOUBLE AS cap
  FROM per
), f AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t
  FROM w
), targets AS (
  SELECT name, source_size,
         CASE WHEN lvl IS NULL OR cap <= w * lvl THEN cap ELSE w * lvl END AS target
  FROM (SELECT *, max(CASE WHEN w * t < cap THEN t END) OVER () AS lvl FROM f)
), rated AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0
              ELSE floor(t.target / t.source_size * 16777216)::BIGINT END AS rate,
         greatest(length(bin(greatest(size, 1))) - 7, 0)::INT AS shift,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3))::BIGINT AS part,
         ('0x' || substr(md5('mix|' || d.name), 1, 6))::BIGINT AS offset_units
  FROM d JOIN targets t USING (name)
), placed AS (
  SELECT *, offset_units + rate * (row_number() OVER (
              PARTITION BY name
              ORDER BY shift * 64 + (size >> shift), part, size, doc_id NULLS FIRST) - 1) AS below
  FROM rated
)
SELECT doc_id, size, source_size, target,
       ((below + rate) >> 24) * size - (below >> 24) * size AS taken,
       ((below + rate) >> 24)::INT - (below >> 24)::INT AS copies
FROM placed
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.r AS q, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""

OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT r, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), per_doc AS (
  SELECT r, lang, source, term, count(*) AS n FROM w GROUP BY ALL
), counted AS (
  SELECT lang, source, term, sum(n)::HUGEINT AS n, count(*) AS docs FROM per_doc GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS whole FROM counted GROUP BY ALL HAVING sum(docs) >= 3
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(whole)::HUGEINT AS total FROM kept GROUP BY lang
), held AS (
  SELECT lang, source, term, n, whole FROM counted JOIN kept USING (lang, term)
), grp AS (
  SELECT DISTINCT lang, source FROM d
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM grp LEFT JOIN held USING (lang, source)
  GROUP BY ALL
), full_p AS (
  SELECT t.lang, t.source, k.term,
         1 + 1000000000 * (coalesce(h.n, 0) + 1) // (t.n + l.v) AS p
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN held h ON h.lang = t.lang AND h.source = t.source AND h.term = k.term
), pair_sum AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sum s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), own AS (
  SELECT h.lang, h.source, h.term,
         1 + 1000000000 * (h.n + 1) // (t.n + l.v) AS p, 1 + 1000000000 * (h.whole + 1) // (l.total + l.v) AS q
  FROM held h JOIN totals t USING (lang, source) JOIN langs l USING (lang)
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM own WHERE p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 200
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries by name."""
    import corpus_pipeline  # at the top of the repository; it imports from here

    return {
        "pipeline": corpus_pipeline.run,
        "op1_language_id": op1_language_id,
        "op2_mixing": op2_mixing,
        "op3_pii": op3_pii,
        "op4_toxicity": op4_toxicity,
        "op5_token_counts": op5_token_counts,
        "op6_simhash": op6_simhash,
        "op7_top_k": op7_top_k,
        "op8_html_content": op8_html_content,
        "op9_decontamination": op9_decontamination,
        "op10_packing": op10_packing,
        "op11_divergence": op11_divergence,
        "op12_best_fit_packing": op12_best_fit_packing,
        "op13_periodic_runs": op13_periodic_runs,
    }


def llm_oracles() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {"op2_mixing": OP2_SQL, "op7_top_k": OP7_SQL, "op11_divergence": OP11_SQL}

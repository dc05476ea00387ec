"""The queries ``opN_<name>`` and ``pipeline`` on the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from inundation.llm import best_position, lockstep, pieces, poisson_mix, pu_quality, secret_ledger, simhash, substring_dedup, text_rules, topk, warc, weak_labels, word_lm
from inundation.llm.shared import keep, new_folder

#: Where the public tokenizers' files are; only the driver reads them.
TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_ngram_lm(spark, d):
    """The target are the documents that are labelled good, the background all documents."""
    good = _table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("target_id"))
    return word_lm.cross_entropy_difference(_table(spark, d, "documents"), good)


def op2_substring_dedup(spark, d):
    return substring_dedup.remove_repeats(_table(spark, d, "documents"))


def _op2_sql() -> str:
    n = substring_dedup.WINDOW
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n}) x),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM win) y WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + {n})) AS p FROM rep) z),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


def op3_pieces(spark, d, tokenizers=TOKENIZERS):
    vocabulary = pieces.read_vocabulary(f"{tokenizers}/{PIECE_MODEL}")
    return pieces.encode(_table(spark, d, "documents").select("doc_id", "text"), vocabulary)


def op4_isolation_rules(spark, d):
    judged = text_rules.apply_rules(_table(spark, d, "documents"), _table(spark, d, "labels"))
    return judged.select("doc_id", *text_rules.COUNTS[:5], "base_failed", "kept", "anomaly")


def op5_poisson_mix(spark, d):
    docs = _table(spark, d, "documents")
    return poisson_mix.poisson_mix(docs.select("doc_id", "text", "lang", "source", "n_chars"))


def op6_warc(spark, d):
    folder = new_folder(spark, "warc")
    records = warc.with_revisits(_table(spark, d, "pages"), "page_id", "html", "url")
    # The payloads that were shuffled are in the archives by then.
    written = keep(warc.write_monolithic(records, f"{folder}/crawl"), "warc-archives", release=True)
    keep(warc.normalise(written, f"{folder}/crawl", f"{folder}/records"), "warc-index")
    read = warc.read_records(warc.read_index(spark, f"{folder}/records"), f"{folder}/records", payloads=False)
    # Read once; revisits are then put to the responses.
    return warc.resolve_revisits(keep(read.drop("payload", "uri"), "warc-read")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def _op6_sql() -> str:
    return """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages), s AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM s)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN n >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first < page_id THEN first END AS refers_to, true AS intact FROM f
"""


def op7_simhash(spark, d):
    groups = simhash.near_duplicates(_table(spark, d, "documents").select("doc_id", "text"))
    return groups.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


def op8_pu_quality(spark, d):
    return pu_quality.classify(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op9_secret_ledger(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    ledger = secret_ledger.update_in_steps(docs, new_folder(spark, "ledger"), "doc_id")
    found = secret_ledger.findings_by_path(docs, ledger)
    # The ledger adds no kinds of its own, so all spans are base spans.
    n = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")
    spans = secret_ledger.spans_text(F.col("findings"))
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"),
    )


def op10_topk(spark, d):
    return topk.top_k(_table(spark, d, "embeddings"), F.col("id") % 50 == 0)


def _op10_sql() -> str:
    return """
WITH v AS (SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
"""


def op11_weak_labels(spark, d):
    return weak_labels.classify(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op12_lockstep(spark, d, tokenizers=TOKENIZERS):
    both = lockstep.read_tokenizers(f"{tokenizers}/{BYTE_VOCABULARY}", f"{tokenizers}/{PIECE_MODEL}")
    return lockstep.align(_table(spark, d, "documents"), both)


def op13_best_position(spark, d):
    return best_position.search(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def _op13_sql() -> str:
    terms = lambda c: (
        f"regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms("text")} AS ts FROM documents), c AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM c), q AS (SELECT DISTINCT item_id, unnest({terms("text")}) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) x WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY term, docs),
s AS (SELECT item_id, c.r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN c USING (r), g GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= 50
"""


def _op9_sql() -> str:
    parts = []
    for i, r in enumerate(secret_ledger.BASE_RULES):
        p = r.pattern.replace("'", "''")
        tested = f"regexp_extract_all(t, '{p}', {r.group})"
        parts.append(
            f"SELECT doc_id, {i} AS rk, '{r.kind}' AS kind, unnest(gaps) AS gap, unnest(sizes) AS size, unnest(tested) AS tested, "
            f"{r.least} AS least, generate_subscripts(sizes, 1) AS j FROM (SELECT doc_id, string_split_regex(t, '{p}') AS g0, "
            f"[length(x) FOR x IN string_split_regex(t, '{p}')][:len(regexp_extract_all(t, '{p}', 0))] AS gaps, "
            f"[length(x) FOR x IN regexp_extract_all(t, '{p}', 0)] AS sizes, [length(x) FOR x IN {tested}] AS tested FROM d) q"
        )
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (" + " UNION ALL ".join(parts) + "), "
        "p AS (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, rk ORDER BY j) AS stop FROM m), "
        "f AS (SELECT doc_id, count(*) FILTER (WHERE rk = 0) AS n_assign, count(*) FILTER (WHERE rk = 1) AS n_access, "
        "count(*) FILTER (WHERE rk = 2) AS n_hex, string_agg(kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' "
        "ORDER BY stop - size, rk) AS spans FROM p WHERE tested >= least GROUP BY 1) "
        "SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, "
        "sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN f USING (doc_id)"
    )


def _op5_sql() -> str:
    t, s = poisson_mix.TEMPERATURE, poisson_mix.SEED
    number = lambda key: f"CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT)"
    return f"""
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT source, sum(n) OVER () * pow(n, {t}) / (sum(pow(n, {t})) OVER () * n) AS rate FROM c),
steps(source, rate, k, p, total) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM r
  UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM steps
  WHERE k <= rate + 60),
u AS (SELECT d.*, {number(f"'{s}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')")} / 4503599627370496.0 AS u FROM documents d),
k AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, count(*) AS copies FROM u JOIN steps
  ON u.source IS NOT DISTINCT FROM steps.source AND steps.total <= u.u AND 1 - steps.total > 1e-15 GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(i AS INT) AS copy,
  {number(f"'{s}:shuffle:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || i")} AS mix_key
FROM k, LATERAL (SELECT unnest(range(1, copies + 1)) AS i) x
"""


_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_ngram_lm": (op1_ngram_lm, None),
    "op2_substring_dedup": (op2_substring_dedup, _op2_sql()),
    "op3_pieces": (op3_pieces, None),
    "op4_isolation_rules": (op4_isolation_rules, None),
    "op5_poisson_mix": (op5_poisson_mix, _op5_sql()),
    "op6_warc": (op6_warc, _op6_sql()),
    "op7_simhash": (op7_simhash, None),
    "op8_pu_quality": (op8_pu_quality, None),
    "op9_secret_ledger": (op9_secret_ledger, _op9_sql()),
    "op10_topk": (op10_topk, _op10_sql()),
    "op11_weak_labels": (op11_weak_labels, None),
    "op12_lockstep": (op12_lockstep, None),
    "op13_best_position": (op13_best_position, _op13_sql()),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql is not None}

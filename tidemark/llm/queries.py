"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame.

Each query applies its operator, with production parameters, to the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ctw, decontaminate, fingerprints, jaccard_join, langid, licenses, line_dedup, packing, simhash, token_files, toxicity, vector_codes, whitening
from tidemark.llm.common import fold, read_table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers  # noqa: PLC0415 -- the files are not part of this repository

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labelled documents whose id is not in fold 0 of 5."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.classify(docs, labels, fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("_id", "_th")


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS_SQL} AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win FROM bi),
sizes AS (SELECT DISTINCT k FROM windows),
di AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
hits AS (SELECT r, i, di.k, item_id FROM di JOIN windows ON windows.k = di.k
    AND windows.win = array_to_string(list_slice(w, i, i + di.k - 1), ' ')),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), units="bare")


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents whose id is not in fold 0 of 10."""
    scored = ctw.score(read_table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), units="space_led")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without recurring lines: doc_id, n_lines, n_dropped and the text that is left."""
    cleaned = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


_DID = "coalesce(doc_id, hash(text))"


def _vote_sql(k: int, lead: int) -> str:
    """The k-th vote: the lines that no vote before has settled, by their number of fields and ``lead`` leading ones."""
    source = "g" if k == 0 else f"judged{k - 1} WHERE NOT agrees"
    return f"""
voters{k} AS MATERIALIZED (SELECT leaf, line, f, n, least, most, CAST(len(f) AS VARCHAR) || ':' || array_to_string(f[1:{lead}], ' ') AS node FROM {source}),
votes{k} AS (SELECT node, p, field, sum(n) AS n FROM (SELECT node, n, unnest(range(0, len(f))) AS p, unnest(f) AS field FROM voters{k}) GROUP BY ALL),
usual{k} AS (SELECT node, p, field FROM votes{k} QUALIFY row_number() OVER (PARTITION BY node, p ORDER BY n DESC, field DESC) = 1),
template{k} AS (SELECT node, list(field ORDER BY p) AS t FROM usual{k} GROUP BY node),
judged{k} AS MATERIALIZED (SELECT voters{k}.*, len(list_filter(list_zip(f, t), lambda x: x[1] = x[2])) >= 0.8 * len(f) AS agrees
    FROM voters{k} JOIN template{k} USING (node) WHERE node IN (SELECT node FROM voters{k} GROUP BY node HAVING count(*) > 1)),"""


OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_DID} AS did, text, string_split(text, chr(10)) AS lines FROM documents),
raw AS (SELECT r, did, unnest(range(0, len(lines))) AS pos, unnest(lines) AS line FROM d WHERE text IS NOT NULL),
opened AS (SELECT r, did, pos, regexp_replace(regexp_replace(line, '[\x{{85}}\p{{Z}}]', ' ', 'g'),
    '[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}]', ' \0 ', 'g') AS line FROM raw),
spaced AS (SELECT r, did, pos, regexp_replace(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[ \t\x0B\f\r]+', ' ', 'g') AS line FROM opened),
l AS (SELECT r, did, pos, line, string_split(line, ' ') AS f FROM (SELECT r, did, pos,
    regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line FROM spaced)
    WHERE len(string_split(line, ' ')) >= 3 OR regexp_matches(line, '\p{{L}}')),
k AS (SELECT *, CAST(len(f) AS VARCHAR) || ':' || array_to_string(f[1:3], ' ') AS leaf FROM l),
g AS MATERIALIZED (SELECT leaf, line, any_value(f) AS f, count(*) AS n, min(did) AS least, max(did) AS most FROM k
    WHERE leaf IN (SELECT leaf FROM k GROUP BY leaf HAVING min(did) <> max(did)) GROUP BY leaf, line),
{"".join(_vote_sql(k, lead) for k, lead in enumerate((3, 3, 6)))}
instances AS (SELECT leaf, line, min(least) OVER w AS head, max(most) OVER w AS tail FROM (
    {" UNION ALL ".join(f"SELECT {k} AS vote, node, leaf, line, least, most FROM judged{k} WHERE agrees" for k in range(3))}) WINDOW w AS (PARTITION BY vote, node)),
decided AS (SELECT * FROM instances UNION ALL SELECT leaf, line, least, most FROM g ANTI JOIN instances USING (leaf, line)),
gone AS (SELECT r, pos FROM k JOIN decided USING (leaf, line) WHERE head <> tail AND did <> head),
left_over AS (SELECT raw.r, string_agg(line, chr(10) ORDER BY pos) AS text FROM raw ANTI JOIN gone USING (r, pos) GROUP BY raw.r),
dropped AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_dropped,
    CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(left_over.text, '') END AS text
FROM d LEFT JOIN left_over USING (r) LEFT JOIN dropped USING (r)"""


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents whose id is not in fold 1 of 3."""
    found = langid.identify(read_table(spark, sf_dir, "documents"), fold("doc_id", 3) != 1)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class (the smallest doc_id it is linked to, over any number of links) and its number of links."""
    return jaccard_join.link_documents(read_table(spark, sf_dir, "documents")).drop("_id", "_th", "_class")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of all vectors, their errors and the digest of the codebooks."""
    return vector_codes.with_label_errors(vector_codes.compress(read_table(spark, sf_dir, "embeddings")))


def _op11_sql(rounds: int = 6) -> str:
    """The rounds as a chain of common table expressions: books (part, entry, place, value), then the nearest entry of each part."""
    sql = """
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT r, (i - 1) // (len(v) // 8) AS p, (i - 1) % (len(v) // 8) AS k, CAST(floor(4096 * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16),
books0 AS MATERIALIZED (SELECT p, e, k, x AS c FROM x JOIN first USING (r))"""
    for t in range(rounds + 1):
        sql += f""",
far{t} AS (SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM x JOIN books{t} USING (p, k) GROUP BY r, p, e),
near{t} AS MATERIALIZED (SELECT r, p, e, d FROM far{t} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""
        if t < rounds:
            sql += f""",
mean{t} AS (SELECT p, e, k, sum(x) AS s, count(*) AS n FROM x JOIN near{t} USING (r, p) GROUP BY p, e, k),
books{t + 1} AS MATERIALIZED (SELECT p, e, k, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM books{t} LEFT JOIN mean{t} USING (p, e, k))"""
    return sql + f""",
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, k)) AS sha FROM books{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its fingerprint and the smallest doc_id it is linked to, over any number of links."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whitened(read_table(spark, sf_dir, "embeddings")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_decontamination, op3_best_fit_packing, op4_context_tree, op5_token_files, op6_line_dedup, op7_licenses, op8_fingerprints, op9_language,
        op10_jaccard_join, op11_vector_codes, op12_simhash, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op6_line_dedup": OP6_SQL, "op11_vector_codes": _op11_sql()}

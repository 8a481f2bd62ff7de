"""Registered queries of the subpackage: each applies an operator to its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm import token_output as T

    path = T.scratch_files(spark)
    T.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer=_tokenizer("word_bpe_49k.json"),
                        cut="space_free", end_id=1)
    return T.read_back(spark, path)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.decontaminate import contaminations

    return contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.packing import pack_documents

    packed = pack_documents(_table(spark, sf_dir, "documents"), tokenizer=_tokenizer("byte_bpe_50k.json"),
                            cut="space_led", end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.simhash_dedup import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.substring_dedup import deduplicate

    found = deduplicate(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm import quality_classifier as C
    from panelcast.llm.common import doc_crc

    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(doc_crc(F.col("doc_id")) % 3 == 1, F.lit(False))
    weights = C.train(docs.where(~held_out), _table(spark, sf_dir, "labels"))
    return C.score(docs, weights).select("doc_id", held_out.alias("held_out"), "score",
                                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm import language_id as L
    from panelcast.llm.common import doc_crc

    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(doc_crc(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = L.train(docs.where(~held_out))
    return L.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm import pii

    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(k) for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm import quality_rules as Q
    from panelcast.llm.common import written

    docs = _table(spark, sf_dir, "documents")
    measured = written(docs.select("doc_id", Q.stratum_of(F.col("lang")).alias("stratum"),
                                   Q.metrics(F.col("text")).alias("m")), "metrics")
    judged = Q.judge(measured, Q.calibrate(measured, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                         "base_failed", "kept")


def op10_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.common import doc_crc
    from panelcast.llm.hmm_lm import score

    training = F.coalesce(doc_crc(F.col("doc_id")) % 5 != 1, F.lit(True))
    scored = score(_table(spark, sf_dir, "documents"), training)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.jaccard_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.vector_codes import encode

    coded = encode(_table(spark, sf_dir, "embeddings"), scale=256, parts=16, entries=64, rounds=2)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.llm.filter_audit import audit

    return audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_language_id": op7_language_id,
    "op8_pii": op8_pii,
    "op9_quality_rules": op9_quality_rules,
    "op10_hmm_scoring": op10_hmm_scoring,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_vector_codes": op12_vector_codes,
    "op13_filter_audit": op13_filter_audit,
}

_WORD = r"[^\x20\x09-\x0D]+"


def _op5_sql() -> str:
    return f"""
WITH w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (
       SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents)),
runs AS (SELECT doc_id, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS run,
       count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS n FROM w),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM runs WHERE n = 20) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, (SELECT unnest(range(20)) AS j)),
kept AS (SELECT w.doc_id, w.i, w.word, g.i IS NOT NULL AS gone FROM w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i),
per AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
       string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id"""


def _op9_sql() -> str:
    from panelcast.llm import quality_rules as Q

    risk, level = 0.05, 0.05
    grid = ", ".join(map(str, Q.GRID))
    share = {
        "symbol_share": "n_symbols / nullif(word_chars, 0)", "bang_share": "n_bangs / nullif(n_words, 0)",
        "capital_share": "n_capitals / nullif(word_chars, 0)", "dup_line_share": "n_dup_lines / nullif(n_lines, 0)",
        "repeat_share": "n_repeat_words / nullif(n_words, 0)",
    }
    tested = " UNION ALL ".join(f"SELECT doc_id, stratum, '{r}' AS rule, coalesce({v}, 0.0) AS v FROM m WHERE NOT base_failed"
                                for r, v in share.items())
    p = risk / len(Q.RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS text FROM documents),
t AS (SELECT doc_id, stratum, text, regexp_extract_all(text, '{_WORD}') AS ws,
       list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM t),
g AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o] AS gram, lead(word, 2) OVER o AS last FROM w
       WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
many AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE last IS NOT NULL) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM many, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m0 AS (SELECT t.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
       CAST(length(text) - length(regexp_replace(text, '[{Q.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
       len(ls) AS n_lines, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
       length(text) - length(replace(text, '!', '')) AS n_bangs
     FROM t LEFT JOIN rep ON t.doc_id = rep.doc_id),
m AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m0),
l AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
tested AS ({tested}),
c AS (SELECT stratum, rule, cutoff, count(*) FILTER (WHERE quality = 1) AS n,
       count(*) FILTER (WHERE quality = 1 AND v > cutoff) AS k, count(*) FILTER (WHERE quality = 0 AND v > cutoff) AS caught
     FROM tested JOIN l USING (doc_id), (SELECT unnest([{grid}]) AS cutoff) GROUP BY ALL),
tails AS (SELECT stratum, rule, cutoff, caught - {Q.COST} * k AS gain, CASE WHEN k >= n * {p} THEN 1.0 ELSE
       list_sum(list_transform(range(k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                + j * ln({p}) + (n - j) * ln(1 - {p})))) END AS p FROM c WHERE caught - {Q.COST} * k > 0 AND n > 0),
best AS (SELECT stratum, rule, cutoff FROM tails
       WHERE p <= {level} / (greatest(1, (SELECT count(DISTINCT stratum) FROM c)) * {len(Q.RULES)})
       QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1),
fails AS (SELECT DISTINCT doc_id FROM tested JOIN best USING (stratum, rule) WHERE v > cutoff)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND f.doc_id IS NULL AS kept
FROM m LEFT JOIN fails f ON m.doc_id = f.doc_id"""


def _op12_sql() -> str:
    def assigned(books: str) -> str:
        gap = "list_sum(list_transform(range(1, w + 1), lambda j: (p.x[j] - c.x[j]) * (p.x[j] - c.x[j])))"
        return f"""SELECT vec_id, label, p.part, any_value(p.x) AS x, CAST(min(CAST({gap} AS HUGEINT) * 64 + entry) AS HUGEINT) AS best
       FROM p JOIN {books} c ON p.part = c.part GROUP BY vec_id, label, p.part"""

    def updated(books: str, owned: str) -> str:
        return f"""SELECT c.part, c.entry, coalesce(n.x, c.x) AS x FROM {books} c LEFT JOIN (
       SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY pos) AS x FROM (
         SELECT part, best % 64 AS entry, pos, sum(x[pos]) AS total, count(*) AS n
         FROM {owned}, (SELECT unnest(range(1, (SELECT max(w) FROM p) + 1)) AS pos) GROUP BY ALL) GROUP BY part, entry) n
       ON c.part = n.part AND c.entry = n.entry"""

    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
     FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part, len(v) // 16 AS w, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x
     FROM k, (SELECT unnest(range(16)) AS part)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
     QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 64),
a1 AS MATERIALIZED ({assigned("c0")}),
c1 AS MATERIALIZED ({updated("c0", "a1")}),
a2 AS MATERIALIZED ({assigned("c1")}),
c2 AS MATERIALIZED ({updated("c1", "a2")}),
a3 AS ({assigned("c2")}),
r AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY part) AS code,
       CAST(sum(best // 64) AS BIGINT) AS error FROM a3 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM c2) AS codebooks_sha256 FROM r"""


def _op13_sql() -> str:
    fails = {
        "A": "len(ws) < 50", "B": "100 * len(list_distinct(ws)) < 65 * len(ws)",
        "C": "100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text)",
        "D": "regexp_matches(text, '[#$%&*|]')", "E": "coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)",
    }
    letters = ", ".join(f"'{f}'" for f in fails)
    failing = ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in fails.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
       regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT doc_id, part, concat_ws('', {failing}) AS fails FROM d),
c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
     FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest([{letters}]) AS q),
o AS (SELECT a.q || b.q || c.q || e.q || g.q AS filter_order FROM x a JOIN x b ON b.q <> a.q JOIN x c ON c.q NOT IN (a.q, b.q)
     JOIN x e ON e.q NOT IN (a.q, b.q, c.q) JOIN x g ON g.q NOT IN (a.q, b.q, c.q, e.q)),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
left_at AS (SELECT c.*, filter_order, coalesce(list_min(list_transform(string_split(nullif(fails, ''), ''),
       lambda k: strpos(filter_order, k))), 6) AS gone FROM c, o),
r AS (SELECT part, s.filter_order, s.step, letter,
       CAST(sum(CASE WHEN gone > s.step THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN gone = s.step THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN gone < s.step AND contains(fails, letter) THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN gone = s.step THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN gone = s.step THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
     FROM left_at JOIN s ON left_at.filter_order = s.filter_order GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""


#: The other operators hash with XXH64, run a tokenizer or train a model: tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op5_substring_dedup": _op5_sql(),
    "op9_quality_rules": _op9_sql(),
    "op12_vector_codes": _op12_sql(),
    "op13_filter_audit": _op13_sql(),
}

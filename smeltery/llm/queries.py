"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import (
    apportion,
    arc,
    bpe,
    cotraining,
    divergence,
    hash_forest,
    line_blocks,
    line_dedup,
    metric_tree,
    periodic,
    simhash,
    token_counts,
    zone_maps,
)
from smeltery.llm.shared import WORD, load

Query = Callable[[SparkSession, str], DataFrame]


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = arc.archived(load(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(load(spark, sf_dir, "documents"), path)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.search(load(spark, sf_dir, "embeddings"), k=20, query_every=20)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(load(spark, sf_dir, "documents"), ranks, keep_ids=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(load(spark, sf_dir, "documents")).drop(
        "class_distance", "word_distance"
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apportion.mix(load(spark, sf_dir, "documents"), weights=(5, 2, 1), max_copies=3)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extract(load(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(documents, keep_text=False)
    return done.select("row.doc_id", "n_lines", "n_dropped", "kept_sha256")


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.search(load(spark, sf_dir, "embeddings"), k=20, query_every=20, scale=64)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text; by the checksum of its id, a document's words repeat from a place on."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    rest = F.floor(checksum / 10)
    given = documents.select(
        "doc_id", "text", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), 0).alias("words")
    ).select("*", F.size("words").alias("n"))
    at = given.select(
        "*",
        F.when((checksum % 10 == 0) & (F.col("n") > 0), (rest % F.col("n")).cast("int")).alias("a"),
        (3 + rest % 8).alias("periods"),
    ).select("*", (1 + F.floor((F.col("n") - F.col("a")) / F.col("periods"))).cast("int").alias("p"))
    left = F.col("n") - F.col("a")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return at.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = with_planted_runs(load(spark, sf_dir, "documents"))
    done = periodic.find_runs(planted, keep_text=False)
    # By exact quotients: of two runs the one with the larger length x other period is first.
    first = F.array_sort(
        "runs",
        lambda x, y: F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
        .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
        .when(x["period"] != y["period"], F.when(x["period"] < y["period"], -1).otherwise(1))
        .otherwise(0),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = done.select("*", F.get(first, F.lit(0)).alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return zone_maps.mine(load(spark, sf_dir, "embeddings"), label=moved)


def queries() -> dict[str, Query]:
    return {
        "op1_arc_to_warc": op1_arc_to_warc,
        "op2_token_counts": op2_token_counts,
        "op3_nearest": op3_nearest,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_quality": op5_quality,
        "op6_divergence": op6_divergence,
        "op7_mix": op7_mix,
        "op8_simhash": op8_simhash,
        "op9_main_text": op9_main_text,
        "op10_line_dedup": op10_line_dedup,
        "op11_exact_topk": op11_exact_topk,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_hard_negatives": op13_hard_negatives,
    }


# --- SQL

OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), k AS (
  SELECT digest, n, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY ALL
)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> p.page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest AND p.n = k.n
"""

OP10_SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM split
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.*, holder IS NOT NULL AND holder <> doc_id AS gone
  FROM keyed LEFT JOIN shared ON keyed.key = shared.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


# Vectors of integers as the exact searches take them; {scale} and {more} are filled in.
INTEGERS_SQL = """
SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v{more}
FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

OP11_SQL = f"""
WITH t AS ({INTEGERS_SQL.format(scale=64, more="")}), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM t AS q JOIN t AS c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20
"""

MOVED = ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label"
OP13_SQL = f"""
WITH t AS ({INTEGERS_SQL.format(scale=256, more=MOVED)} AND label IS NOT NULL), pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM t AS a JOIN t AS c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op6_sql() -> str:
    """The rules of ``divergence.judge`` with its default limits."""

    def count(pattern: str) -> str:
        return f"length(t) - length(regexp_replace(t, {_quoted(pattern)}, '', 'g'))"

    classes = list(divergence.CLASSES.values())
    size = divergence.COMMON
    class_counts = [f"c{i}" for i in range(len(classes))]
    word_counts = [f"w{i}" for i in range(size)]
    shares = [f"CASE WHEN n_chars > 0 THEN {c} / n_chars ELSE 0 END AS s{c}" for c in class_counts]
    shares.append(
        f"CASE WHEN n_chars > 0 THEN greatest(n_chars - ({' + '.join(class_counts)}), 0) / n_chars "
        "ELSE 0 END AS sc_other"
    )
    shares += [f"CASE WHEN n_words > 0 THEN {w} / n_words ELSE 0 END AS s{w}" for w in word_counts]
    shares.append(
        f"CASE WHEN n_words > 0 THEN greatest(n_words - ({' + '.join(word_counts)}), 0) / n_words "
        "ELSE 0 END AS sw_other"
    )
    by_class = [*[f"s{c}" for c in class_counts], "sc_other"]
    by_word = [*[f"s{w}" for w in word_counts], "sw_other"]
    medians = ", ".join(
        f"median(round({s} * {divergence.STEPS})) AS m{s}" for s in [*by_class, *by_word]
    )

    def total(names: list[str]) -> str:
        return "(" + " + ".join(f"m{s}" for s in names) + ")"

    def part(a: str, b: str) -> str:
        return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"

    def apart(names: list[str]) -> str:
        terms = [f"{part(s, f'r{s}')} + {part(f'r{s}', s)}" for s in names]
        return f"sqrt(greatest(({' + '.join(terms)}) / 2, 0))"

    references = ", ".join(
        [f"m{s} / {total(by_class)} AS r{s}" for s in by_class]
        + [f"m{s} / {total(by_word)} AS r{s}" for s in by_word]
    )
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t,
    CASE WHEN trim(lang) <> '' THEN lang END AS lang
  FROM documents
), cut AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM given
), placed AS (
  SELECT uid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM cut
), windows AS (
  SELECT uid, i, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c
  FROM placed WINDOW w AS (PARTITION BY uid ORDER BY i)
), triples AS (
  SELECT uid, i, count(*) OVER (PARTITION BY uid, a, b, c) AS n FROM windows WHERE c IS NOT NULL
), covered AS (
  SELECT uid, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT uid, unnest([i, i + 1, i + 2]) AS place FROM triples WHERE n > 1) GROUP BY uid
), totals AS (
  SELECT lang, count(*) AS total FROM cut WHERE lang IS NOT NULL GROUP BY lang
), heard AS (
  SELECT lang, unnest(list_distinct(list_transform(ws, lambda w: lower(w)))) AS word
  FROM cut WHERE lang IS NOT NULL
), ranked AS (
  SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
  FROM heard GROUP BY lang, word
), commons AS (
  SELECT ranked.lang AS of_lang, list(word ORDER BY place) AS common
  FROM ranked JOIN totals ON ranked.lang = totals.lang
  WHERE place <= {size} AND 2 * n >= total AND total >= {divergence.LEAST} GROUP BY ranked.lang
), counted AS (
  SELECT cut.uid, doc_id, lang, length(t) AS n_chars, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST({count('[#*$%&|<>]')} AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    {', '.join(f'{count(p)} AS c{i}' for i, p in enumerate(classes))},
    coalesce(len(common), 0) > 0 AS listed,
    {', '.join(f"coalesce(len(list_filter(ws, lambda w: lower(w) = common[{i + 1}])), 0) AS w{i}" for i in range(size))}
  FROM cut LEFT JOIN covered ON cut.uid = covered.uid LEFT JOIN commons ON cut.lang = commons.of_lang
), shared AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {', '.join(shares)}
  FROM counted
), middles AS (
  SELECT lang, count(*) AS documents, {medians} FROM shared
  WHERE NOT base_failed AND n_chars >= 200 AND n_words >= 100 GROUP BY lang
), refs AS (
  SELECT lang AS ref_lang, {references} FROM middles
  WHERE documents >= {divergence.LEAST}
), nearest AS (
  SELECT uid, min({apart(by_class)}) AS d FROM shared, refs WHERE lang IS NULL GROUP BY uid
), judged AS (
  SELECT shared.*,
    CASE WHEN n_chars < 200 THEN 0 WHEN lang IS NULL THEN coalesce(d, 0)
      WHEN ref_lang IS NULL THEN 0 ELSE {apart(by_class)} END AS by_class,
    CASE WHEN n_words >= 100 AND listed AND ref_lang IS NOT NULL
      THEN {apart(by_word)} ELSE 0 END AS by_word
  FROM shared LEFT JOIN refs ON lang = ref_lang LEFT JOIN nearest ON shared.uid = nearest.uid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND by_class <= 0.15 AND by_word <= 0.28 AS kept
FROM judged
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_arc_to_warc": OP1_SQL,
        "op6_divergence": op6_sql(),
        "op10_line_dedup": OP10_SQL,
        "op11_exact_topk": OP11_SQL,
        "op13_hard_negatives": OP13_SQL,
    }

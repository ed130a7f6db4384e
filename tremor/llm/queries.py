"""The registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremor.llm import alignment, ann_graph, bpe, collocations, compression, line_dedup, mixing, ngram_join, piece_count, quality_lr, secret_scan, sharding, substring


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).drop("h")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lr.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_count.token_counts(table(spark, sf_dir, "documents"))


def op8_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.selectExpr("row.doc_id", "n_lines", "n_exact as n_exact_dropped", "n_near as n_near_dropped", "kept as kept_text")


def op10_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_rules(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_source_mixing, op3_ngram_jaccard_join, op4_quality_classifier, op5_embedding_near_dedup, op6_bpe_round_trip, op7_token_counts, op8_best_fit_shards, op9_line_dedup, op10_compression_rules, op11_secret_scan, op12_token_alignment, op13_phrase_collocations)}


_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + ", '[^\\x20\\x09-\\x0D]+')"
#: Components of links ``e(a, b)`` between ``nodes(n)``, as recursive SQL: the smallest node reachable.
_REACH = """both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
 reach AS (SELECT DISTINCT a AS n, a AS m FROM both_ways UNION SELECT b.b, r.m FROM reach r JOIN both_ways b ON r.n = b.a),
 component AS (SELECT n, min(m) AS m FROM reach GROUP BY n)"""



def _secrets_sql() -> str:
    """Spans by lists of what matches and of what lies between, rule by rule."""
    rules = [*secret_scan.BASE, *secret_scan.MORE]
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    arms = [f"SELECT r, {k} AS k, regexp_extract_all(x, {quoted(r.regex)}, 0) AS m, regexp_extract_all(x, {quoted(r.regex)}, {r.group}) AS g, string_split_regex(x, {quoted(r.regex)}) AS b, {r.least} AS least FROM t" for k, r in enumerate(rules)]
    kinds = "[" + ", ".join(quoted(r.kind) for r in rules) + "]"
    counts = ", ".join(f"count(*) FILTER (WHERE k = {k}) AS n_{r.kind}" for k, r in enumerate(secret_scan.BASE))
    return f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents), h AS ({" UNION ALL ".join(arms)}),
 i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM h WHERE len(m) > 0),
 p AS (SELECT r, k, CAST(list_sum(list_transform(b[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS a, length(m[i]) AS n FROM i WHERE length(g[i]) >= least),
 s AS (SELECT r, k, a, {kinds}[k + 1] || ':' || CAST(a AS VARCHAR) || ':' || CAST(a + n AS VARCHAR) AS w FROM p),
 c AS (SELECT r, {counts}, string_agg(w, ',' ORDER BY a, k) FILTER (WHERE k < {len(secret_scan.BASE)}) AS base, string_agg(w, ',' ORDER BY a, k) AS spans FROM s GROUP BY r)
 SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN c USING (r)"""


#: DuckDB SQL of those queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(x="coalesce(text, '')")} AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0) t),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
 e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)), {_REACH}
 SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN component c ON c.n = d.doc_id""",
    "op5_embedding_near_dedup": f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
 e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98), {_REACH},
 k AS (SELECT a, count(*) AS k FROM both_ways GROUP BY a)
 SELECT vec_id, coalesce(k, 0) AS n_links, coalesce(m, vec_id) AS component_id, coalesce(m, vec_id) = vec_id AS kept FROM v LEFT JOIN k ON k.a = vec_id LEFT JOIN component c ON c.n = vec_id""",
    "op9_line_dedup": f"""WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents),
 l AS (SELECT *, {_WORDS.format(x="x")} AS ws FROM t), o AS (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS o, array_to_string(ws, ' ') AS k FROM l),
 f AS (SELECT k, min(o) AS o, any_value(ws) AS ws FROM o WHERE len(ws) > 0 GROUP BY k),
 g AS (SELECT * FROM f WHERE len(ws) >= 4),
 v AS (SELECT o, i, array_to_string(list_concat(ws[1:i - 1], ws[i + 1:len(ws)]), ' ') AS rest FROM (SELECT o, ws, unnest(range(1, len(ws) + 1)) AS i FROM f WHERE len(ws) >= 5) u),
 m AS (SELECT o, min(o) OVER (PARTITION BY rest, i) AS first FROM v),
 near AS (SELECT o FROM m WHERE o > first UNION SELECT v.o FROM v JOIN g ON v.rest = g.k WHERE v.o > g.o UNION SELECT g.o FROM g JOIN v ON v.rest = g.k WHERE g.o > v.o),
 d AS (SELECT o.*, len(o.ws) > 0 AS full_line, len(o.ws) > 0 AND o.o > f.o AS exact, near.o IS NOT NULL AS close FROM o LEFT JOIN f ON f.k = o.k AND len(o.ws) > 0 LEFT JOIN near ON near.o = o.o)
 SELECT doc_id, count(*) FILTER (WHERE full_line) AS n_lines, count(*) FILTER (WHERE exact) AS n_exact_dropped, count(*) FILTER (WHERE close) AS n_near_dropped,
  coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (WHERE NOT coalesce(exact, false) AND NOT close), '') AS kept_text FROM d GROUP BY doc_id""",
    "op11_secret_scan": _secrets_sql(),
    "op13_phrase_collocations": f"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format(x="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents),
 p AS (SELECT lang, regexp_extract_all(x, '[^\\x20\\x09]+') AS w FROM t), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
 g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p) u, (VALUES (1), (2), (3), (4), (5)) v(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
 c AS (SELECT *, string_split(p, ' ') AS w FROM g WHERE k > 1 AND f >= 100),
 u AS (SELECT lang, p, k, f AS a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c),
 s AS (SELECT u.*, x.f AS l, y.f AS r, n.n, CAST(1000::HUGEINT * a * n.n // (x.f::HUGEINT * y.f) AS BIGINT) AS score FROM u JOIN g x ON x.lang = u.lang AND x.p = u.x JOIN g y ON y.lang = u.lang AND y.p = u.y JOIN n ON n.lang = u.lang),
 m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS b FROM s) WHERE b = 1),
 o AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = m.lang AND c.k > m.k AND 100 * c.f >= 100 * m.a AND contains(' ' || c.p || ' ', ' ' || m.p || ' ')))
 SELECT lang, rank, p AS phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM o) WHERE rank <= 2000""",
}

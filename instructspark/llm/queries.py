"""The registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from instructspark.llm.common import crc_remainder, read_table
from instructspark.llm.context_tree import score_running_texts
from instructspark.llm.decontaminate import WINDOW, decontaminate, is_contaminated
from instructspark.llm.imatch import build_lexicon, compare_edited
from instructspark.llm.line_frequency import MIN_PAGES, RATIO, drop_boilerplate
from instructspark.llm.mixing import mix
from instructspark.llm.quality_crf import fit_quality, score_quality
from instructspark.llm.secrets import find_secrets
from instructspark.llm.setsketch import near_duplicates
from instructspark.llm.simplex_kmeans import CENTROIDS, DIMENSION, ROUNDS, SCALE, SEED_PREFIX, cluster
from instructspark.llm.token_edits import apply_edits, load_ranks, token_trees
from instructspark.llm.toxicity import fit_toxicity, score_toxicity
from instructspark.llm.url_trie import ALLOW, BLOCK, Rule, filter_urls
from instructspark.llm.whitening import whiten

# A public vocabulary file on the driver; tasks get its content.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

URL_RULES = [
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
]


def _judged(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = fit_toxicity(docs, labels.where(~held_out))
    return _judged(score_toxicity(docs, model), held_out, 0.7)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 5) == 1
    return score_running_texts(docs, ~held_out).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "n_bytes",
        "bits_per_byte",
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate(docs, items).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    field = fit_quality(docs, labels.where(~held_out))
    return _judged(score_quality(docs, field), held_out, 0.3)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, shingle=2, percent=80)


def _edits(text: Column, source: Column) -> Column:
    """Three edits of a text: a replaced span, a deletion, an addition at the end."""
    n = F.length(text)

    def one(start: Column, length: int, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), F.lit(length).alias("length"), new.alias("new"))

    return F.array(
        one(F.floor(n / 3), 20, F.concat(F.lit(" see "), source, F.lit(". "))),
        one(F.floor(n / 2), 10, F.lit("")),
        one(n + F.lit(100), 0, F.concat(F.lit("\n"), source)),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str, vocabulary_path: str = VOCABULARY) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    vocabulary = load_ranks(vocabulary_path)
    known = token_trees(docs, vocabulary)
    source = F.coalesce(F.col("source"), F.lit(""))
    edits = _edits(F.coalesce(F.col("text"), F.lit("")), source)
    return apply_edits(known.withColumn("edits", edits), vocabulary).select(
        "doc_id",
        "n_tokens",
        "edited_tokens",
        "n_pieces",
        "n_recounted",
        F.sha2(F.col("edited_text"), 256).alias("edited_sha256"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return drop_boilerplate(docs).select("doc_id", "source", "n_lines", "n_dropped", "clean_text")


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return compare_edited(docs, build_lexicon(docs))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return whiten(vectors, "vec_id", "embedding")


def op12_simplex_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return cluster(vectors, "vec_id", "embedding").drop("candidates")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return find_secrets(docs, "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_context_tree": op3_context_tree,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_near_dedup": op6_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_imatch": op9_imatch,
    "op10_url_filter": op10_url_filter,
    "op11_whitening": op11_whitening,
    "op12_simplex_kmeans": op12_simplex_kmeans,
    "op13_secrets": op13_secrets,
}

_RULES_SQL = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)

ORACLES: dict[str, str] = {
    "op8_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS nr
            FROM documents WHERE text IS NOT NULL
        ), bare AS (
            SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS bare FROM lines
        ), pages AS (
            SELECT source, count(*) AS pages FROM documents GROUP BY source
        ), counted AS (
            SELECT source, bare, count(DISTINCT doc_id) AS n FROM bare WHERE bare <> '' GROUP BY source, bare
        ), often AS (
            SELECT c.source, c.bare FROM counted c JOIN pages p ON p.source IS NOT DISTINCT FROM c.source
            WHERE c.n >= {MIN_PAGES} AND c.n > {RATIO} * p.pages
        ), marked AS (
            SELECT bare.*, often.bare IS NOT NULL AS dropped
            FROM bare LEFT JOIN often
              ON bare.source IS NOT DISTINCT FROM often.source AND bare.bare = often.bare
        )
        SELECT doc_id, source, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT dropped), '') AS clean_text
        FROM marked GROUP BY doc_id, source
        UNION ALL
        SELECT doc_id, source, 0 AS n_lines, 0 AS n_dropped, NULL AS clean_text FROM documents WHERE text IS NULL
    """,
    "op10_url_filter": f"""
        WITH rules(rhost, rpath, verdict) AS (VALUES {_RULES_SQL}),
        split AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), fits AS (
            SELECT page_id, rhost || rpath AS rule, verdict,
                   row_number() OVER (PARTITION BY page_id
                       ORDER BY length(rhost) - length(replace(rhost, '.', '')) DESC, length(rpath) DESC) AS nr
            FROM split JOIN rules
              ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, '{ALLOW}') AS verdict
        FROM split LEFT JOIN (SELECT * FROM fits WHERE nr = 1) USING (page_id)
    """,
}


def _distance(x: str, c: str) -> str:
    return f"list_sum(list_transform(range(1, {DIMENSION + 1}), lambda i: ({x}[i] - {c}[i]) * ({x}[i] - {c}[i])))"


def _assigned(centroids: str) -> str:
    """Each kept vector with its nearest centroid (ties: smaller number) and the distance."""
    return f"""SELECT k.vec_id, k.x, arg_min(c.cluster, [{_distance('k.x', 'c.c')}, c.cluster]) AS cluster,
            min({_distance('k.x', 'c.c')}) AS distance
        FROM kept k CROSS JOIN {centroids} c GROUP BY k.rowid_, k.vec_id, k.x"""


def _kmeans_sql() -> str:
    parts = [
        f"""kept AS (
            SELECT row_number() OVER () AS rowid_, vec_id,
                list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = {DIMENSION}
              AND list_bool_and(list_transform(embedding, lambda v: v IS NOT NULL AND isfinite(v::DOUBLE))))""",
        f"""c0 AS (
            SELECT (row_number() OVER (ORDER BY sha256('{SEED_PREFIX}' || vec_id::VARCHAR), x) - 1)::INTEGER AS cluster,
                x AS c
            FROM kept WHERE vec_id IS NOT NULL
            QUALIFY row_number() OVER (ORDER BY sha256('{SEED_PREFIX}' || vec_id::VARCHAR), x) <= {CENTROIDS})""",
    ]
    for r in range(1, ROUNDS + 1):
        parts.append(f"a{r} AS ({_assigned(f'c{r - 1}')})")
        parts.append(
            f"""m{r} AS (
            SELECT cluster, list(floor(s::DOUBLE / n)::BIGINT ORDER BY i) AS c FROM (
                SELECT cluster, i, sum(x[i]) AS s, count(*) AS n
                FROM a{r}, (SELECT unnest(range(1, {DIMENSION + 1})) AS i) GROUP BY cluster, i)
            GROUP BY cluster)"""
        )
        parts.append(
            f"""c{r} AS (
            SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{r - 1} o LEFT JOIN m{r} m USING (cluster))"""
        )
    parts.append(f"final AS ({_assigned(f'c{ROUNDS}')})")
    return "WITH " + ",\n".join(parts) + f"""
        SELECT f.vec_id, f.cluster, f.distance,
            sum(f.distance) OVER (PARTITION BY f.cluster) AS cluster_inertia,
            sum(f.distance) OVER () AS inertia,
            sha256(array_to_string(list_transform(c.c, lambda v: v::VARCHAR), ',')) AS centroid_sha256
        FROM final f JOIN c{ROUNDS} c USING (cluster)"""


ORACLES["op12_simplex_kmeans"] = _kmeans_sql()


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words_sql(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


ORACLES["op4_decontamination"] = f"""
    WITH items AS (
        SELECT item_id, {_words_sql('text')} AS w FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, list_slice(w, i, i + least({WINDOW}, len(w)) - 1) AS win
        FROM items, range(1, greatest(len(w) - least({WINDOW}, len(w)) + 1, 0) + 1) AS r(i)
        WHERE len(w) > 0
    ), lengths AS (
        SELECT DISTINCT len(win) AS size FROM windows
    ), docs AS (
        SELECT doc_id, {_words_sql('text')} AS w, row_number() OVER () AS nr FROM documents
    ), spans AS (
        SELECT d.nr, p AS pos, l.size, list_slice(d.w, p, p + l.size - 1) AS seq
        FROM docs d, lengths l, range(1, greatest(len(d.w) - l.size + 1, 0) + 1) AS r(p)
    ), met AS (
        SELECT s.nr, s.pos, s.size, x.item_id FROM spans s JOIN windows x ON x.win = s.seq
    ), hit AS (
        SELECT nr, count(DISTINCT pos + k) AS n_hit
        FROM met, range(0, size) AS q(k) GROUP BY nr
    ), named AS (
        SELECT nr, count(*) AS n_items,
               sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
        FROM (SELECT DISTINCT nr, item_id::VARCHAR AS id FROM met WHERE item_id IS NOT NULL) GROUP BY nr
    )
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
           coalesce(n.n_items, 0)::BIGINT AS n_items, coalesce(n.items_sha256, sha256('')) AS items_sha256,
           coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
    FROM docs d LEFT JOIN hit h USING (nr) LEFT JOIN named n USING (nr)
"""

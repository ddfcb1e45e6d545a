"""One query per operator of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontamination, embedding_dedup, html_text, mixing, ngram_join, order_minhash, packing, quality, sort_means, substring_dedup, token_store, warc
from .common import Scratch, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.removed_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), depth=400, unit="bytes", keep_text=True)
    kept = F.col("kept")
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.char_length(kept).cast("long").alias("n_chars"), kept.alias("text"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"), quality.safe_grade(), n_grades=3)
    return quality.graded(docs.select("doc_id", "text"), model, wanted=2).select("doc_id", "expected_grade", "p_tail", "keep")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_comparison(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "tokens").path("store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return token_store.read_store(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), weights=[3, 1, 2], share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "archives").path("warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, least=1000)
    return warc.read_archives(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = sort_means.integer_vectors(table(spark, sf_dir, "embeddings"), dim=64, scale=256)
    assigned, centers = sort_means.sort_means(vectors, F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256), k=40, rounds=5)
    return sort_means.with_inertia(assigned, centers).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), max_n=4, least=30, top=2000, covered=80)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, items, window=10, keep_text=False)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: Smallest node reachable over links (a, b); nodes: one column i.
_COMPONENTS = """reach(i, c) AS (SELECT i, i FROM nodes UNION SELECT r.i, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.c),
    comps AS (SELECT i, min(c) AS component_id FROM reach GROUP BY 1)"""

OP1 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id AND 85 * x.n <= 100 * y.n AND 85 * y.n <= 100 * x.n GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
    nodes AS (SELECT a AS i FROM links UNION SELECT b FROM links), {_COMPONENTS}
    SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM s LEFT JOIN comps ON i = doc_id"""

OP5 = f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
    nodes AS (SELECT a AS i FROM links UNION SELECT b FROM links), {_COMPONENTS}, n AS (SELECT i, count(*) AS n FROM (SELECT a AS i FROM links UNION ALL SELECT b FROM links) GROUP BY 1)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept FROM v LEFT JOIN comps ON comps.i = vec_id LEFT JOIN n ON n.i = vec_id"""

OP9 = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS keep FROM p),
    r AS (SELECT *, payload_bytes >= 1000 AND page_id < keep AS again FROM q)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN keep END AS refers_to FROM r"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _means_sql(k: int = 40, rounds: int = 5) -> str:
    """A table of centroids c<i> and one of assignments a<i> for each round."""
    parts = ["""v AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64)"""]
    parts.append(f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM v WHERE vec_id IS NOT NULL ORDER BY sha256('2:' || vec_id), v LIMIT {k})")
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT id, (min({{'d': d, 'c': c}})).c AS c, (min({{'d': d, 'c': c}})).d AS d FROM (SELECT id, c, {distance} AS d FROM v, c{i} c) GROUP BY id)")
        if i < rounds:
            mean = "(s - ((s % n) + n) % n) // n"
            parts.append(f"""m{i} AS (SELECT c, list(({mean})::BIGINT ORDER BY i) AS v FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(v.v) AS x, unnest(range(1, 65)) AS i FROM a{i} a JOIN v USING (id)) GROUP BY c, i) GROUP BY c),
                c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (c))""")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, a.c::INT AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN v USING (id) JOIN c{rounds} c USING (c)"""


OP12 = f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
    w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p), m AS (SELECT unnest(range(1, 5)) AS m),
    g AS (SELECT lang, w[i:i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, m)),
    f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY 1, 2 HAVING count(*) >= 30), n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
    long AS (SELECT lang, g[s:e] AS g, max(f) AS longer FROM (SELECT lang, g, f, s, unnest(range(s + 1, len(g) + 1)) AS e FROM (SELECT lang, g, f, unnest(range(1, len(g))) AS s FROM f WHERE len(g) > 2)) WHERE e - s + 1 < len(g) GROUP BY 1, 2),
    c AS (SELECT f.lang, f.g, f.f AS a FROM f LEFT JOIN long USING (lang, g) WHERE len(f.g) > 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * f.f)),
    k AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM c),
    s AS (SELECT k.lang, k.g, k.a, k.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * k.a) // (l.f + r.f))::BIGINT AS score FROM k JOIN f l ON l.lang = k.lang AND l.g = k.g[1:k.k] JOIN f r ON r.lang = k.lang AND r.g = k.g[k.k + 1:]),
    b AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS first FROM s),
    o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM b WHERE first = 1)
    SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang)) WHERE rank <= 2000"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP13 = f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    i AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, w[s:s + least(10, len(w)) - 1] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM b WHERE len(w) > 0)),
    x AS (SELECT id, s, m, w[s:s + m - 1] AS g FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM i))),
    h AS (SELECT id, s, m, item_id FROM x JOIN i USING (m, g)),
    n AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + m)) AS p FROM h) GROUP BY 1),
    t AS (SELECT id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN n USING (id) LEFT JOIN t USING (id)"""


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can express; tests/llm hold the others against plain versions."""
    return {"op11_sort_means": _means_sql(), "op12_collocations": OP12, "op13_decontamination": OP13, "op1_ngram_jaccard_join": OP1, "op5_embedding_dedup": OP5, "op9_warc": OP9}

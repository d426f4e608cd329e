"""One query per operator of this package: (spark, sf_dir) -> DataFrame over the whole tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm import bpe, collocations, compression_quality, hard_negatives, host_reputation, lattice_neighbours, licence_rules, line_runs, mixing, ngram_join, pivot_search, quotes, toxicity
from articlelake.llm.common import held_out, read
from articlelake.session import settle

RANKS = "byte_bpe_50k.tiktoken"
TOXIC, GOOD = 0.3, 0.7  # scores from which a document counts as such


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(
        read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def _scored(docs: DataFrame, threshold: float) -> DataFrame:
    return docs.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def string_kernel_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    return _scored(toxicity.score(docs.select("doc_id", "text"), model), TOXIC)


def compression_classifier(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = compression_quality.fit(docs, labels)
    return _scored(compression_quality.score(docs.select("doc_id", "text"), model), GOOD)


def ngram_jaccard_join(spark, sf_dir):
    return ngram_join.similar_documents(read(spark, sf_dir, "documents"))


def lattice_near_duplicates(spark, sf_dir):
    return lattice_neighbours.near_duplicates(read(spark, sf_dir, "embeddings"))


def pivot_top_k(spark, sf_dir):
    vectors = settle(pivot_search.whole_numbers(read(spark, sf_dir, "embeddings")))
    found = pivot_search.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def line_run_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.delete_repeated_runs(docs)


def raked_mixing(spark, sf_dir):
    docs = mixing.by_source_language_topic(read(spark, sf_dir, "documents"))
    return docs.select("doc_id", "source", "lang", "n_tokens", "weight", "probability", "kept")


def licence_sentence_rules(spark, sf_dir):
    docs = licence_rules.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = {name: F.array_join(name, " ").alias(name) for name in ("sentence_ids", "licences")}
    return docs.select("doc_id", F.size("sentence_ids").alias("n_sentences"), *joined.values())


def quotation_linking(spark, sf_dir):
    return quotes.chat(read(spark, sf_dir, "conversations")).withColumn("reply_path", F.array_join("reply_path", " "))


def page_outcomes(spark, sf_dir):
    """Labelled page outcomes: the given pages carry none, so a page whose id has a quality label takes it
    (bad: quality 0; of several labels of an id the lowest counts)."""
    labels = read(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    pages = read(spark, sf_dir, "pages")
    return pages.join(labels, pages.page_id == labels.doc_id).select("url", (1 - F.col("quality")).alias("bad"))


def host_reputation_filter(spark, sf_dir):
    judged = host_reputation.judge(read(spark, sf_dir, "pages").select("page_id", "url"), page_outcomes(spark, sf_dir))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def phrase_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def hard_negative_mining(spark, sf_dir):
    mined = hard_negatives.mine(read(spark, sf_dir, "embeddings"))
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_raked_mixing": raked_mixing,
    "op3_byte_bpe": byte_bpe,
    "op4_line_run_dedup": line_run_dedup,
    "op5_string_kernel_toxicity": string_kernel_toxicity,
    "op6_licence_sentence_rules": licence_sentence_rules,
    "op7_quotation_linking": quotation_linking,
    "op8_pivot_top_k": pivot_top_k,
    "op9_lattice_near_duplicates": lattice_near_duplicates,
    "op10_compression_classifier": compression_classifier,
    "op11_host_reputation": host_reputation_filter,
    "op12_hard_negatives": hard_negative_mining,
    "op13_phrase_collocations": phrase_collocations,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STRENGTH = """(SELECT CASE WHEN avg(pow(k / n - prior_mean, 2) - prior_mean * (1 - prior_mean) / n) > 0
    THEN least(greatest(avg(prior_mean * (1 - prior_mean)) / avg(pow(k / n - prior_mean, 2)
        - prior_mean * (1 - prior_mean) / n) - 1, 1.0), 1000.0) ELSE 1000.0 END FROM {0} WHERE n > 0)"""
_LAST = "array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - {0}, 1), -1), '.')"

# SQL answers, for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op12_hard_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
                   [floor(256 * x::DOUBLE)::HUGEINT for x in embedding] AS q
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
                   list_sum([p[1] * p[2] for p in list_zip(a.q, b.q)]) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT * FROM (SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
                row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
                FROM scored WHERE label = anchor_label) WHERE place <= 5),
        negatives AS (
            SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
             AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score::BIGINT AS positive_score,
               negative_score::BIGINT AS negative_score FROM negatives WHERE rank <= 5""",
    "op13_phrase_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
            FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                           '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
        totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
        starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS s FROM pieces),
        grams AS (SELECT lang, m AS size, array_to_string(ws[s:s + m - 1], ' ') AS phrase
                  FROM starts CROSS JOIN (VALUES (1), (2), (3), (4)) v(m) WHERE s + m - 1 <= len(ws)),
        counts AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
        cands AS (SELECT lang, phrase, size, f AS a FROM counts WHERE size >= 2),
        cuts AS (SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first,
                        array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS rest
                 FROM (SELECT *, unnest(range(1, size)) AS k FROM cands)),
        scored AS (SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (c.a::HUGEINT * 2000000) // (l.f + r.f) AS score
                   FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.first
                   JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest),
        chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o
                                  FROM scored) WHERE o = 1),
        cm AS (SELECT lang, phrase, a, size, unnest(range(2, size)) AS m FROM cands WHERE size >= 3),
        covers AS (SELECT lang, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') AS phrase, max(a) AS around
                   FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM cm) GROUP BY ALL),
        kept AS (SELECT c.* FROM chosen c LEFT JOIN covers v ON v.lang = c.lang AND v.phrase = c.phrase
                 WHERE around IS NULL OR around::HUGEINT * 100 < c.a::HUGEINT * 80),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n,
               score::BIGINT AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op11_host_reputation": f"""
        WITH hp AS (
            SELECT page_id, url,
                   coalesce(translate(regexp_extract(after, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}'), '') AS host,
                   coalesce(regexp_extract(after, '^[^/?#]*([^?#]*)', 1), '') AS path
            FROM (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END
                  AS after FROM pages)),
        rules(rule_host, rule_path, rule_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
            ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        fits AS (
            SELECT host, path, rule_host || rule_path AS rule, rule_verdict,
                   row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC,
                       CASE WHEN rule_verdict = 'block' THEN 0 ELSE 1 END, rule_host || rule_path) AS place
            FROM (SELECT DISTINCT host, path FROM hp) JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
        lab AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
        counted AS (SELECT host, count(*) AS n, sum(1 - quality) AS k FROM hp JOIN lab ON page_id = doc_id GROUP BY host),
        hosts AS (
            SELECT host, coalesce(n, 0) AS n, coalesce(k, 0) AS k, {_LAST.format(2)} AS domain, {_LAST.format(1)} AS suffix
            FROM (SELECT DISTINCT host FROM hp) FULL JOIN counted USING (host)),
        domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
        suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
        s0 AS (SELECT s.*, (t.k + 1) / (t.n + 2) AS prior_mean FROM suffixes s,
               (SELECT sum(k)::DOUBLE AS k, sum(n)::DOUBLE AS n FROM suffixes) t),
        s1 AS (SELECT s0.*, ({_STRENGTH.format('s0')}) AS strength FROM s0),
        s2 AS (SELECT suffix, (k + strength * prior_mean) / (n + strength) AS mean FROM s1),
        d0 AS (SELECT d.*, s2.mean AS prior_mean FROM domains d JOIN s2 USING (suffix)),
        d1 AS (SELECT d0.*, ({_STRENGTH.format('d0')}) AS strength FROM d0),
        d2 AS (SELECT domain, (k + strength * prior_mean) / (n + strength) AS mean FROM d1),
        h0 AS (SELECT h.*, d2.mean AS prior_mean FROM hosts h JOIN d2 USING (domain)),
        h1 AS (SELECT h0.*, ({_STRENGTH.format('h0')}) AS strength FROM h0),
        h2 AS (SELECT host, k + strength * prior_mean AS a, n - k + strength * (1 - prior_mean) AS b FROM h1),
        h3 AS (SELECT host, a / (a + b) - {host_reputation.Z} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) AS lower
               FROM h2)
        SELECT page_id, host, path, f.rule,
               coalesce(f.rule_verdict, CASE WHEN lower >= {host_reputation.BLOCK_AT} THEN 'block' ELSE 'allow' END)
                   AS verdict
        FROM hp LEFT JOIN h3 USING (host) LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (host, path)""",
    "op4_line_run_dedup": """
        WITH lines AS (
            SELECT doc_id, n - 1 AS pos, line,
                   len([w for w in regexp_split_to_array(line, '[ \\t\\r\\f\\x0B]+') if w <> '']) AS words
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                         generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)),
        full_lines AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k,
                   sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS total FROM lines WHERE words > 0),
        spans AS (
            SELECT a.doc_id, a.pos AS first, b.pos AS last, a.k AS k1, b.k AS k2, way
            FROM full_lines a JOIN full_lines b ON a.doc_id = b.doc_id AND b.k >= a.k
                 AND b.total - a.total + a.words >= 50
            CROSS JOIN (VALUES (0), (1)) ways(way)
            WHERE CASE WHEN way = 0 THEN b.total - b.words - a.total + a.words < 50 ELSE b.total - a.total < 50 END),
        named AS (
            SELECT s.doc_id, s.first, s.last, s.way, string_agg(l.line, chr(10) ORDER BY l.k) AS name
            FROM spans s JOIN full_lines l ON l.doc_id = s.doc_id AND l.k BETWEEN s.k1 AND s.k2
            GROUP BY ALL),
        later AS (
            SELECT doc_id, first, last FROM (SELECT *, min(doc_id * 1000000000::HUGEINT + first)
                OVER (PARTITION BY way, name) AS earliest FROM named)
            WHERE doc_id * 1000000000::HUGEINT + first > earliest),
        gone AS (
            SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN later r ON r.doc_id = l.doc_id AND l.pos BETWEEN r.first AND r.last),
        counted AS (
            SELECT l.doc_id, count(*)::INTEGER AS n_lines, count(g.pos)::INTEGER AS n_deleted,
                   coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
            FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE c.text END AS text,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted
        FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id""",
    "op8_pivot_top_k": """
        WITH vectors AS (
            SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   list_sum([p[1] * p[2] for p in list_zip(a.q, b.q)])::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
        SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5""",
}

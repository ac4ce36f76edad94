"""Queries over the operators of this subpackage, one per operator, and the pipeline; SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmill.llm import (
    chat, divergence, exact_dedup, jaccard, language_id, licenses, mixing, nearest, packing, prefix_trie, repeats, secrets, toxicity,
)
from rentmill.llm.tables import held_out, read_table


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(read_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


CONTROL = "</s>[INST] ok [/INST]"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, stored as rows per turn, and one of the prompt layout whose texts are control strings."""
    planted = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(CONTROL).alias("prompt"), F.lit(CONTROL).alias("completion")
    )
    turns = chat.canonical_turns(read_table(spark, sf_dir, "conversations")).unionByName(chat.canonical_turns(planted))
    seen = chat.read_back(chat.format_turns(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return seen.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    kept_back = held_out("doc_id", 5, 0)
    model = language_id.fit(docs.where(~kept_back))
    return language_id.predict(docs, model).select("doc_id", kept_back.alias("held_out"), "lang_pred", "score", "rejected")


TOXIC_FROM = 0.3


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    kept_back = held_out("doc_id", 4, 2)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~kept_back))
    return toxicity.score(docs, model).select(
        "doc_id", kept_back.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([rule.kind for rule in secrets.BASE_RULES]))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(rule.kind) for rule in secrets.BASE_RULES]
    return secrets.find_secrets(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.aggregate("phrases", F.lit(0).cast("long"), lambda n, p: n + p["places"]).alias("n_base"),
        F.array_min("phrases.first").alias("first_word"),
        F.array_max("phrases.last").alias("last_word"),
        written(F.col("phrases.label")).alias("base_labels"),
        written(F.concat("phrases.label", "spans.label")).alias("labels"),
        "score",
    )


MOST_SHARED = 4


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt on the first turns of every twentieth one, as a trie."""
    turns = prefix_trie.numbered_turns(read_table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 20
    head = F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns, base, head, MOST_SHARED - 1))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_jaccard, op2_language_id, op3_packing, op4_repeats, op5_toxicity, op6_nearest, op7_secrets, op8_chat, op9_mixing,
        op10_exact_dedup, op11_licenses, op12_prefix_trie, op13_divergence,
    )
}


def _secret_sql() -> str:
    """Places of matches from the texts between them, rule by rule."""
    rules = [*secrets.BASE_RULES, *secrets.ADDED_RULES]
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {order} AS rule, unnest(range(1, len(m) + 1)) AS j, m, g, between FROM (
                SELECT doc_id, regexp_extract_all(x, '{pattern}') AS m, regexp_extract_all(x, '{pattern}', {rule.group}) AS g,
                       string_split_regex(x, '{pattern}') AS between FROM x) AS t{order}"""
        for order, rule in enumerate(rules)
        for pattern in [("(?i)" if rule.any_case else "") + rule.pattern.replace("'", "''")]
    )
    kinds = "CASE rule " + " ".join(f"WHEN {k} THEN '{rule.kind}'" for k, rule in enumerate(rules)) + " END"
    least = "CASE rule " + " ".join(f"WHEN {k} THEN {rule.least}" for k, rule in enumerate(rules)) + " END"
    base = len(secrets.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (WHERE rule = {k}) AS n_{rule.kind}" for k, rule in enumerate(secrets.BASE_RULES))
    written = "string_agg(span, ',' ORDER BY low, rule)"
    return f"""
        WITH x AS (SELECT doc_id, coalesce(text, '') AS x FROM documents), f AS ({found}), p AS (
            SELECT doc_id, rule, m[j] AS hit, g[j] AS part,
                   list_sum([len(b) FOR b IN between[1 : j]]) + coalesce(list_sum([len(b) FOR b IN m[1 : j - 1]]), 0) AS low FROM f
        ), s AS (
            SELECT *, concat({kinds}, ':', CAST(low AS BIGINT), ':', CAST(low + len(hit) AS BIGINT)) AS span
            FROM p WHERE len(part) >= {least}
        ), a AS (
            SELECT doc_id, {counts}, {written} FILTER (WHERE rule < {base}) AS base, {written} AS spans FROM s GROUP BY doc_id
        )
        SELECT x.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM x LEFT JOIN a ON a.doc_id = x.doc_id"""


SQL = {
    "op1_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), s AS (
            SELECT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5) AS t
            UNION SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 4
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT p.a, p.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
                FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
            ) AS p JOIN n AS na ON na.doc_id = p.a JOIN n AS nb ON nb.doc_id = p.b
            WHERE 100 * p.common >= 80 * (na.n + nb.n - p.common)
        ), reached AS (
            SELECT doc_id, doc_id AS root FROM documents
            UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.doc_id
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
        FROM documents AS d
        LEFT JOIN n ON n.doc_id = d.doc_id
        JOIN (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id) AS r ON r.doc_id = d.doc_id""",
    "op4_repeats": r"""
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), w AS (
            SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS s
            FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 - 49 AS BIGINT))) AS i FROM d WHERE length(h) >= 100) AS t
        ), f AS (
            SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(*) > 1
        ), g AS (
            SELECT w.doc_id, w.i, w.i - lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS gap
            FROM w JOIN f ON f.s = w.s WHERE f.first < w.doc_id
        ), o AS (
            SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g
        ), r AS (
            SELECT doc_id, run, min(i) AS low, max(i) + 50 AS high FROM o GROUP BY doc_id, run
        ), k AS (
            SELECT r.doc_id, sum(r.high - r.low) AS n_removed, count(*) AS n_spans,
                   string_agg(substring(d.h, 2 * r.before + 1, 2 * (r.low - r.before)), '' ORDER BY r.low) AS kept, max(r.high) AS last
            FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before FROM r) AS r
            JOIN d ON d.doc_id = r.doc_id GROUP BY r.doc_id
        )
        SELECT d.doc_id, CAST(length(d.h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(coalesce(k.kept || substring(d.h, 2 * k.last + 1), d.h))) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op7_secrets": _secret_sql(),
    "op10_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), g AS (
            SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id
            FROM d GROUP BY text_sha256
        )
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g ON d.text_sha256 = g.text_sha256""",
    "op6_nearest": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
            WHERE len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
              AND len([e FOR e IN embedding IF e <> 0]) > 0
        ), d AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum([(q.x[i] - c.x[i]) * (q.x[i] - c.x[i]) FOR i IN range(1, len(q.x) + 1)])) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), e AS (
            SELECT *, length(text) + 4 * (length(text) - length(replace(text, '&', '')))
                + 3 * (length(text) - length(replace(text, '<', '')))
                + 5 * (length(text) - length(replace(text, '[', '')))
                + 5 * (length(text) - length(replace(text, ']', '')))
                + 5 * (length(text) - length(replace(text, '|', ''))) AS escaped FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               CAST(sum(length(role) + escaped + 11) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op12_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, list(x ORDER BY place) AS xs, CAST(conv_id AS VARCHAR) AS name FROM t GROUP BY conv_id
        ), h AS (  -- the CRC-32 of the name, bit by bit
            SELECT *, xor(4294967295, list_reduce(
                list_prepend(4294967295, flatten([[ascii(name[i]), 0, 0, 0, 0, 0, 0, 0] FOR i IN range(1, len(name) + 1)])),
                lambda r, e: CASE WHEN xor(r, e) % 2 = 1 THEN xor(xor(r, e) // 2, 3988292384) ELSE xor(r, e) // 2 END)) % 4 AS h
            FROM (SELECT conv_id, xs, name FROM c) AS named
        ), r AS (
            SELECT h.conv_id, list_concat(coalesce(b.xs[1 : h.h], []), h.xs[h.h + 1 :]) AS xs
            FROM h LEFT JOIN c AS b ON b.conv_id = h.conv_id - h.conv_id % 20
        ), n AS (
            SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(size = depth) AS childless,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '') AS ends
            FROM (SELECT conv_id, len(xs) AS size, depth, xs[1 : depth] AS prefix
                  FROM (SELECT conv_id, xs, unnest(range(0, len(xs) + 1)) AS depth FROM r) AS u) AS p
            GROUP BY depth, prefix
        ), s AS (
            SELECT prefix[1 : k] AS top, sum(childless) AS n_leaves,
                   sum((n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth][2], '[^\x20\x09-\x0D]+')) END) AS saved
            FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM n) AS u GROUP BY top
        ), k AS (
            SELECT prefix[1 : depth - 1] AS top, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY top
        )
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
               CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
        FROM n JOIN s ON s.top = n.prefix LEFT JOIN k ON k.top = n.prefix
        LEFT JOIN n AS up ON n.depth > 0 AND up.prefix = n.prefix[1 : n.depth - 1]""",
    "op13_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), w AS (
            SELECT lang, source, doc, unnest(terms) AS term FROM d
        ), c AS (
            SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term
        ), l AS (
            SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
        ), v AS (
            SELECT lang, count(*) AS v, sum(n) AS total FROM l GROUP BY lang
        ), g AS (
            SELECT s.lang, s.source, sum(CASE WHEN l.term IS NULL THEN 0 ELSE c.n END) AS total
            FROM (SELECT DISTINCT lang, source FROM d) AS s
            LEFT JOIN c ON c.lang = s.lang AND c.source = s.source LEFT JOIN l ON l.lang = c.lang AND l.term = c.term
            GROUP BY s.lang, s.source
        ), p AS (
            SELECT g.lang, g.source, l.term, coalesce(c.n, 0) AS n,
                   1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(g.total, 0)::HUGEINT + 5 * v.v) AS p,
                   1 + 1000000000::HUGEINT * (l.n + 5) // (v.total::HUGEINT + 5 * v.v) AS q
            FROM g JOIN l ON l.lang = g.lang JOIN v ON v.lang = g.lang
            LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
            FROM g AS a JOIN g AS b ON b.lang = a.lang AND b.source <> a.source
            LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
                       FROM p AS x JOIN p AS y ON y.lang = x.lang AND y.term = x.term GROUP BY x.lang, x.source, y.source) AS f
                ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
            UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM r WHERE part = 'pair' OR rank <= 50""",
}

"""The operators of this package over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadastra.llm import capped_mixing, combination_join, compression_quality, covering_simhash, decision_rules, impact_search, linked_secrets, packing, prefix_trie, super_windows, threshold_negatives, trie_counts, warc
from cadastra.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Rows go to Python in batches of bounded size, however long the texts are.
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators are designed for."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return tune(spark)


def register(build: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its name, run with the session settings of the library."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepared(spark), sf_dir.rstrip("/"))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = compression_quality.fit(documents, table(spark, sf_dir, "labels"))
    return compression_quality.score_documents(documents, model)


@register
def op2_super_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = super_windows.remove_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_super_windows"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT row_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM (
    SELECT row_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM words
  )
), often AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT row_id, i + k AS pos FROM windows JOIN often USING (win), range(35) t(k)
), each AS (SELECT row_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words
), kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY pos) FILTER (g.pos IS NULL) AS k, count(g.pos) AS n
  FROM each LEFT JOIN gone g USING (row_id, pos) GROUP BY row_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (row_id)
"""


#: Folder of public vocabulary files on every executor, and the file used here.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@register
def op3_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.count_tokens(table(spark, sf_dir, "documents"), trie_counts.piece_scores(VOCABULARY))


@register
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register
def op4_capped_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = capped_mixing.mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_capped_mixing"] = r"""
WITH sizes AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents
), totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighted AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    2.0::DOUBLE * source_size AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS wanted
  FROM totals
), levels AS (
  SELECT *, (wanted - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT min_by(level, cap / weight) FROM levels WHERE weight * level <= cap)) AS target
  FROM levels
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole, target - whole * source_size AS more
  FROM targets
), placed AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.more,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY draw, row_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (size * (whole + (upto - size / 2.0 < more)::BIGINT))::BIGINT AS taken FROM placed
"""


@register
def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


_BASE32_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hexa, 5 * i + 1, 5))::BIGINT) >> {bits}) & 31)::INTEGER + 1, 1)"
    for bits in (15, 10, 5, 0)
)
ORACLES["op8_warc_revisits"] = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hexa FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first, row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) = 1 AS is_first FROM payloads
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, array_to_string(list_transform(range(8), lambda i: {_BASE32_SQL}), '') AS payload_digest,
  CASE WHEN is_first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN NOT is_first THEN first END AS refers_to
FROM firsts
"""


@register
def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linked_secrets.secret_spans(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*linked_secrets.BASE)
    return found.select(
        "doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in linked_secrets.BASE],
        F.sha2(linked_secrets.span_text(base), 256).alias("base_sha256"),
        linked_secrets.span_text(F.col("spans")).alias("spans"),
    )


@register
def op6_decision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rules = decision_rules.fit(documents, table(spark, sf_dir, "labels"))
    return decision_rules.judged(documents, rules)


@register
def op5_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return impact_search.top_scores(vectors, vectors.where(F.col("vec_id") % 20 == 0))


ORACLES["op5_impact_search"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@register
def op10_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combination_join.similar_documents(table(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    """The same scan and sweep in SQL; positions from the lengths of matches and of what lies between them."""
    scans = " UNION ALL ".join(
        f"""SELECT row_id, '{kind}' AS pattern, unnest(range(1, len(m) + 1)) AS k, unnest(list_transform(g[:len(m)], lambda x: length(x))) AS before,
          unnest(m) AS found, unnest(v) AS value
        FROM (SELECT row_id, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g,
          regexp_extract_all(t, '{p}', {2 if kind == 'assign' else 0}) AS v FROM docs) WHERE len(m) > 0"""
        for kind, p in ((kind, pattern.replace("'", "''")) for kind, pattern in linked_secrets.PATTERNS.items())
    )
    role = " ".join(f"WHEN kind IN {(*kinds, '')} THEN '{role}'" for role, kinds in linked_secrets.ROLES.items())
    ranks = " ".join(f"WHEN kind = '{kind}' THEN {i}" for i, kind in enumerate(linked_secrets.KINDS, start=1))

    def over(members: str) -> str:
        """Whether a span overlaps one of the members."""
        return (f"coalesce(max(stop) FILTER ({members}) OVER earlier > start, false)"
                f" OR coalesce(min(start) FILTER ({members}) OVER later < stop, false)")

    def near(role: str, other: str) -> str:
        members = f"role = '{other}'" + (" AND NOT inside" if role == "endpoint" else "")
        found = (f"(coalesce(start - max(stop) FILTER ({members}) OVER earlier <= {linked_secrets.SCOPE}, false)"
                 f" OR coalesce(min(start) FILTER ({members}) OVER later - stop <= {linked_secrets.SCOPE}, false))")
        return found + (" AND NOT inside" if other == "endpoint" else "")

    linked = " OR ".join(
        f"(role = '{role}' AND ({' OR '.join(near(role, other) for other in others)}))" for role, others in linked_secrets.COMPLEMENTS.items()
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in linked_secrets.BASE)
    windows = """WINDOW earlier AS (PARTITION BY row_id ORDER BY start, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        later AS (PARTITION BY row_id ORDER BY start, rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents
    ), scans AS ({scans}
    ), measured AS (
      SELECT *, CASE WHEN pattern = 'login' THEN 3 + instr(found[4:], ':') ELSE 0 END AS skipped,
        CASE WHEN pattern = 'login' THEN 1 ELSE 0 END AS behind, sum(before + length(found)) OVER (PARTITION BY row_id, pattern ORDER BY k) AS ending
      FROM scans
    ), placed AS (
      SELECT row_id, ending - behind AS stop, ending - length(found) + skipped AS start,
        CASE WHEN pattern = 'assign' THEN CASE WHEN length(value) >= {linked_secrets.LEAST_VALUE} THEN 'assign' END
          WHEN pattern <> 'token' THEN pattern
          WHEN regexp_full_match(found, '[A-Z0-9]{{16,32}}') AND regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Z]') THEN 'key_id'
          WHEN length(found) >= 32 AND regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Z]') AND regexp_matches(found, '[a-z]')
            AND 2 * length(regexp_replace(found, '{linked_secrets.WORDY}', '', 'g')) >= length(found) THEN 'blob'
        END AS kind
      FROM measured
    ), ranked AS (
      SELECT *, CASE {ranks} END AS rank, CASE {role} END AS role, rank <= 3 AS certain FROM placed WHERE kind IS NOT NULL
    ), within AS (
      SELECT *, kind = 'blob' AND ({over("kind = 'endpoint'")}) AS inside FROM ranked {windows}
    ), judged AS (
      SELECT *, certain OR (({linked}) AND NOT ({over('certain')})) AS reported FROM within {windows}
    ), texts AS (
      SELECT row_id, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (certain) AS base
      FROM judged WHERE reported GROUP BY row_id
    )
    SELECT doc_id, {', '.join(f'coalesce(n_{kind}, 0)::BIGINT AS n_{kind}' for kind in linked_secrets.BASE)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN texts USING (row_id)
    """


ORACLES["op7_linked_secrets"] = _secrets_sql()


@register
def op11_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = threshold_negatives.taking_part(vectors.withColumn("label", moved))
    return threshold_negatives.hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))


ORACLES["op13_threshold_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, sum(a.x * c.x)::BIGINT AS score
  FROM parts a JOIN parts c ON a.i = c.i AND a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@register
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


# CRC-32 of a decimal number, bit by bit: every character is followed by eight shifts.
_CRC32_SQL = """xor(4294967295::BIGINT, list_reduce(
    [4294967295::BIGINT] || flatten(list_transform(string_split({0}::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))"""
ORACLES["op12_conversation_trie"] = f"""
WITH own AS (
  SELECT conv_id, concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(t)) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS donor, {_CRC32_SQL.format('conv_id')} % 6 AS h FROM own GROUP BY conv_id
), plan AS (
  SELECT c.*, least(c.h, coalesce(d.n, 0)) AS taken FROM convs c LEFT JOIN convs d ON d.conv_id = c.donor
), turns AS (
  SELECT p.conv_id, pos, t, chars FROM plan p JOIN own o ON o.conv_id = p.donor AND pos < taken
  UNION ALL SELECT p.conv_id, pos - h + taken, t, chars FROM plan p JOIN own o ON o.conv_id = p.conv_id AND pos >= h
), prefixes AS (
  SELECT conv_id, pos + 1 AS depth, list(t) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix, chars FROM turns
  UNION ALL SELECT conv_id, 0, [], 0 FROM plan
), paths AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS top, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes
), nodes AS (
  SELECT top AS conv_id, depth, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (ends), '')) AS ends_sha256
  FROM paths p GROUP BY top, depth
), linked AS (
  SELECT n.*, p.top AS parent_conv_id FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), counted AS (
  SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l
  LEFT JOIN (SELECT parent_conv_id, depth, count(*) AS n FROM linked GROUP BY ALL) c ON c.parent_conv_id = l.conv_id AND c.depth = l.depth + 1
), totals AS (
  SELECT p.top, p.depth, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * c.chars) AS saved
  FROM counted c JOIN paths p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY ALL
)
SELECT c.conv_id, c.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM counted c JOIN totals t ON t.top = c.conv_id AND t.depth = c.depth
"""

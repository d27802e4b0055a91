"""Queries of this package with their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packetloom.catalog.common import Catalog
from packetloom.llm import decontaminate, jaccard, lattice, licenses, lm, mixing, pseudonyms, repair, sharding, shallot, tokens, toxicity, warc
from packetloom.llm.common import table
from packetloom.session import shared_path

query = Catalog()

MIX_SQL = f"""
WITH docs AS (
    SELECT doc_id, source, md5(concat_ws('|', '7', coalesce(doc_id::VARCHAR, 'null'), text)) AS key,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
    FROM documents
), ranked AS (
    SELECT *, 1 + source_rank % 3 AS weight, 3 * source_size AS cap FROM (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank
        FROM docs GROUP BY source)
), levels AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS left_over,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM ranked
    WINDOW before AS (ORDER BY cap / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stops AS (
    SELECT *, min((cap * weight_left <= weight * left_over)::INT) OVER (
        ORDER BY cap / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
    FROM levels
), sources AS (
    SELECT source, source_rank, source_size,
           CASE WHEN stopped = 1 THEN cap::DOUBLE
                ELSE (weight * max(CASE WHEN stopped = 0 THEN left_over END) OVER ())::DOUBLE
                     / (max(CASE WHEN stopped = 0 THEN weight_left END) OVER ())::DOUBLE END AS target
    FROM stops
), placed AS (
    SELECT d.doc_id, d.size, s.source_size, s.target, round(s.target)::BIGINT AS used,
           coalesce(sum(d.size) OVER (PARTITION BY s.source_rank ORDER BY d.key
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
    FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN used // source_size * size
           + greatest(0, least(begins + size, used % source_size) - begins) ELSE 0 END::BIGINT AS taken
FROM placed
"""


@query(MIX_SQL)
def op6_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix_sources(docs).documents.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op8_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    placed = sharding.write_shards(sharding.two_pass_shuffle(docs), shared_path(spark, "shards"))
    return sharding.shard_digest(placed)


WARC_SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages
), digests AS (
    SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS first, list_aggregate(list_transform(range(32),
        lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5),
            lambda k: substr(bits, 5 * i + k + 1, 1)::INT * (1 << (4 - k)::INT)))::INT, 1)), 'string_agg', '') AS payload_digest
    FROM payloads
)
SELECT page_id, strlen(payload) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id != first THEN first END AS refers_to
FROM digests
"""


@query(WARC_SQL)
def op10_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), stored=True)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


JACCARD_SQL = """
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), sets AS (
    SELECT doc_id, words, list_distinct(CASE WHEN len(words) >= 5
        THEN list_transform(range(len(words) - 4), lambda i: array_to_string(words[i + 1 : i + 5], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS pieces
    FROM worded
), spread AS (
    SELECT doc_id, len(pieces) AS n, unnest(pieces) AS piece FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM spread a JOIN spread b USING (piece) WHERE a.doc_id != b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), heads AS (SELECT a, min(b) AS head FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, CASE WHEN len(words) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY words) END AS class_id,
       coalesce(n_links, 0) AS n_links, head AS component_id, doc_id = head AS kept
FROM sets JOIN heads ON heads.a = doc_id LEFT JOIN counts ON counts.a = doc_id
"""


@query(JACCARD_SQL)
def op4_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text_key")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def _template_sql(name: str, key: str, select: str, widths: str) -> str:
    flat = lambda c: f"string_split(trim(regexp_replace({c}, ' ?\\x01', '', 'g')), ' ')"
    return f"""{name} AS (
    SELECT *, len(shape) AS n, list_transform(words, lambda w: lower(w)) AS lowered FROM (
        SELECT {key}, {flat("plain")} AS words, {flat("whole")} AS shape,
               list_filter(list_transform(string_split(whole, chr(1)), lambda s: trim(s)), lambda s: s != '') AS sentences
        FROM (SELECT *, regexp_replace(lower(regexp_replace(regexp_replace(plain, '[^\\x09-\\x0D\\x20]*\\p{{N}}[^\\x09-\\x0D\\x20]*', '#n', 'g'),
                     '(^| )\\p{{Lu}}\\p{{Ll}}+', '\\1#p', 'g')), '#n ({decontaminate.UNITS})( |$)', '#n #u\\2', 'g') AS whole
              FROM (SELECT {key}, trim(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(1), ''),
                       '[.!?]+([\\x09-\\x0D\\x20]|\\z)|[\\x0A\\x0D]+', ' ' || chr(1) || ' ', 'g'),
                       '[^\\p{{L}}\\p{{M}}\\p{{N}}\\x01\\x09-\\x0D\\x20]+', '', 'g'), '[\\x09-\\x0D\\x20]+', ' ', 'g')) AS plain FROM {select})))
    WHERE shape[1] != ''), {name}_windows AS (
    SELECT {key}, kind, width, k, piece FROM (
        SELECT {key}, kind, width, k, (CASE kind WHEN 'template' THEN shape ELSE lowered END)[k + 1 : k + width] AS piece
        FROM (SELECT *, unnest(range(greatest(0, n - width + 1))) AS k FROM {name}, {widths}))
    UNION ALL
    SELECT {key}, 'sentence', 0, unnest(range(len(sentences))), unnest(list_transform(sentences, lambda s: [s])) FROM {name}
    UNION ALL
    SELECT {key}, 'whole', 0, 0, lowered FROM {name} WHERE n < {decontaminate.FEWEST_WORDS})"""


_LITERAL = "len(list_filter({0}, lambda w: w NOT IN ('#n', '#p', '#u')))"
LEAK_SQL = f"""
WITH widths AS (SELECT kind, unnest(range({decontaminate.FEWEST_WORDS}, {decontaminate.WINDOW} + 1)) AS width FROM (VALUES ('template'), ('words')) v(kind)),
{_template_sql("items", "item_id", "benchmark", "widths")},
rated AS (
    SELECT item_id, w.kind, w.width, k AS item_at, piece, n, {_LITERAL.format("piece")} AS literals, {_LITERAL.format("shape")} AS all_literals
    FROM items_windows w JOIN items USING (item_id)
    WHERE item_id IS NOT NULL AND (w.kind IN ('sentence', 'whole') OR w.width = least({decontaminate.WINDOW}, n))
), joinable AS (
    SELECT * FROM rated WHERE CASE kind WHEN 'template' THEN literals >= {decontaminate.LITERALS} WHEN 'words' THEN true WHEN 'whole' THEN true
        ELSE n >= {decontaminate.FEWEST_WORDS} AND all_literals > 0
             AND item_id NOT IN (SELECT item_id FROM rated WHERE kind = 'template' AND literals >= {decontaminate.LITERALS}) END
), pieces AS (
    SELECT *, count(*) OVER (PARTITION BY item_id, kind) AS item_windows FROM joinable
), used AS (
    SELECT DISTINCT kind, width FROM pieces WHERE kind IN ('template', 'words')
), {_template_sql("docs", "doc_id", "documents", "used")}, aligned AS (
    SELECT doc_id, item_id, kind, k - item_at AS shift, count(DISTINCT item_at) AS hits, max(item_windows) AS item_windows
    FROM docs_windows JOIN pieces USING (kind, width, piece) GROUP BY ALL
    HAVING hits >= CASE kind WHEN 'sentence' THEN 1.0 WHEN 'whole' THEN 0.0 ELSE {decontaminate.COVERAGE} END * max(item_windows)
), placed AS (
    SELECT a.*, CASE a.kind WHEN 'sentence' THEN coalesce(list_sum(list_transform(d.sentences[1 : greatest(shift, 0)],
           lambda s: len(string_split(s, ' ')))), 0)::BIGINT ELSE shift END AS begins
    FROM aligned a JOIN docs d USING (doc_id)
), faced AS (
    SELECT doc_id, item_id, kind, shift, i.words[k + 1] AS a, d.words[begins + k + 1] AS b
    FROM placed JOIN docs d USING (doc_id) JOIN items i USING (item_id), unnest(range(i.n)) AS r(k)
    WHERE kind IN ('template', 'sentence') AND begins + k >= 0 AND begins + k < d.n
      AND i.shape[k + 1] IN ('#n', '#p', '#u') AND i.shape[k + 1] = d.shape[begins + k + 1]
), judged AS (
    SELECT doc_id, item_id, kind, shift, any_value(aligned.hits) AS hits, any_value(aligned.item_windows) AS item_windows,
           count(DISTINCT (a, b)) FILTER (a IS NOT NULL) AS slots,
           2 * count(DISTINCT (a, b)) FILTER (a IS NOT NULL) - count(DISTINCT a) - count(DISTINCT b) AS conflicts,
           coalesce(bool_or(a != b), false) AS changed
    FROM aligned LEFT JOIN faced USING (doc_id, item_id, kind, shift) GROUP BY ALL
)
SELECT doc_id, item_id, kind, hits::INT AS hits, item_windows::INT AS item_windows, slots::INT AS slots,
       conflicts::INT AS conflicts, changed
FROM judged WHERE conflicts <= {decontaminate.CONFLICTS} * slots
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
    ORDER BY list_position(['template', 'words', 'sentence', 'whole'], kind), hits DESC, shift) = 1
"""


@query(LEAK_SQL)
def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).drop("text_key")


@query()
def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pseudonyms.pseudonymize(docs, key="corpus-release-1")


VECTOR_SQL = """
WITH RECURSIVE ready AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ready a JOIN ready b ON a.label = b.label AND a.vec_id != b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
       min(reach.b) AS component_id, e.vec_id = min(reach.b) AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""


@query(VECTOR_SQL)
def op1_lattice_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.lattice_near_copies(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query()
def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.context_mixing_scores(table(spark, sf_dir, "documents", "doc_id", "text"))


REPAIR_SQL = """
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)) AS bytes
    FROM conversations
), coded AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(bytes, lambda b: [b::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor(xor(c, b) // 2, 3988292384 * (xor(c, b) % 2))), 4294967295) % 20 AS kind
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))
    FROM coded WHERE kind != 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, left(role, 1) AS initial,
           NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
    FROM damaged
), turns AS (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM numbered
), facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
           count(*) FILTER (blank) AS blank, count(*) FILTER (repeated) AS duplicate,
           count(*) FILTER (cut AND NOT blank AND NOT repeated) AS truncated,
           count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
), moves(state, inserts, reached, added) AS (VALUES
    (0, '', 0, []), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']),
    (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']),
    (2, '', 2, []), (2, 'I', 3, ['assistant:']), (3, '', 3, []), (3, 'I', 2, ['user:'])
), path AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM turns
    UNION ALL
    SELECT conv_id, i, state, cost, audit, lines FROM (
        SELECT p.conv_id, t.i, CASE e.edit WHEN 'D' THEN m.reached WHEN 'R' THEN CASE m.reached WHEN 2 THEN 3 ELSE 2 END
                   ELSE CASE t.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS state,
               p.cost + 3 * len(m.inserts) + e.cost + CASE WHEN t.cut AND e.edit != 'D' THEN 3 ELSE 0 END AS cost,
               p.audit || m.inserts || e.edit AS audit,
               list_concat(list_concat(p.lines, m.added), CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text]
                   ELSE [CASE m.reached WHEN 2 THEN 'assistant:' ELSE 'user:' END || t.text] END) AS lines
        FROM path p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1
        JOIN moves m ON m.state = p.state JOIN (VALUES ('D', 4), ('R', 3), ('K', 0)) e(edit, cost)
            ON e.edit = 'D' OR (NOT t.blank AND NOT t.repeated AND (e.edit = 'R' OR (t.initial = 's' AND m.reached = 0)
               OR (t.initial = 'u' AND m.reached IN (0, 1, 3)) OR (t.initial = 'a' AND m.reached = 2))))
    QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
), ended AS (
    SELECT p.conv_id, p.cost + 3 * len(m.inserts) AS cost, p.audit || m.inserts AS audit, list_concat(p.lines, m.added) AS lines
    FROM path p JOIN facts f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = f.n
    JOIN moves m ON m.state = p.state AND m.reached = CASE p.state WHEN 0 THEN 0 ELSE 3 END
    QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + 3 * len(m.inserts), p.audit || m.inserts) = 1
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query(REPAIR_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair_conversations(turns, damaged=True)


def _kmeans_sql() -> str:
    """The plain method, one step after the other, over one row per vector and component."""
    k, dims, scale, seed = shallot.CLUSTERS, shallot.DIMENSIONS, shallot.SCALE, shallot.SEED
    steps = [
        f"""parts AS MATERIALIZED (
    SELECT id, vec_id, place, floor({scale} * x)::BIGINT AS x
    FROM (SELECT row_number() OVER () AS id, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place
          FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), drawn AS (
    SELECT id, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, 'null'))) - 1 AS cluster
    FROM (SELECT DISTINCT id, vec_id FROM parts) QUALIFY cluster < {k}
), centroids0 AS MATERIALIZED (SELECT cluster, place, x FROM drawn JOIN parts USING (id))"""
    ]
    for step in range(shallot.ROUNDS + 1):
        steps.append(f"""assigned{step} AS MATERIALIZED (
    SELECT id, cluster, distance FROM (
        SELECT id, cluster, sum((p.x - c.x) * (p.x - c.x)) AS distance FROM parts p JOIN centroids{step} c USING (place) GROUP BY id, cluster)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1)""")
        if step < shallot.ROUNDS:
            steps.append(f"""centroids{step + 1} AS MATERIALIZED (
    SELECT cluster, place, coalesce(m.x, c.x) AS x FROM centroids{step} c LEFT JOIN (
        SELECT cluster, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x
        FROM assigned{step} JOIN parts USING (id) GROUP BY cluster, place) m USING (cluster, place))""")
    return f"""WITH {", ".join(steps)}, named AS (
    SELECT cluster, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM centroids{shallot.ROUNDS} GROUP BY cluster)
SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM assigned{shallot.ROUNDS} JOIN named USING (cluster) JOIN (SELECT DISTINCT id, vec_id FROM parts) USING (id)"""


@query(_kmeans_sql())
def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.shallot_kmeans(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _license_sql() -> str:
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(
        f"({i}, '{t.label}', {t.phrase}, {quoted(t.words)}, {t.gram}, {t.slack}, {t.needed})" for i, t in enumerate(licenses.TEMPLATES)
    )
    gram = lambda words, at: f"array_to_string({words}[{at} + 1 : {at} + size], ' ')"
    return f"""WITH templates(template, label, phrase, words, size, slack, needed) AS (VALUES {rows}
), docs AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), known AS (
    SELECT template, size, slack, place, {gram("words", "place")} AS gram
    FROM (SELECT *, unnest(range(len(words) - size + 1)) AS place FROM templates)
), seen AS (
    SELECT id, size, spot, {gram("words", "spot")} AS gram
    FROM (SELECT id, words, size, unnest(range(len(words) - size + 1)) AS spot FROM docs, (SELECT DISTINCT size FROM templates))
), hits AS (
    SELECT id, template, slack, size, place, spot, spot - place AS diagonal FROM seen JOIN known USING (size, gram)
), opened AS (
    SELECT id, template, diagonal, coalesce((diagonal - lag(diagonal) OVER along > slack)::INT, 1) AS opens
    FROM (SELECT DISTINCT id, template, slack, diagonal FROM hits) WINDOW along AS (PARTITION BY id, template ORDER BY diagonal)
), numbered AS (
    SELECT *, sum(opens) OVER (PARTITION BY id, template ORDER BY diagonal) AS span FROM opened
), spans AS (
    SELECT id, template, span, min(spot) AS first, count(DISTINCT place + step) AS covered
    FROM (SELECT *, unnest(range(size)) AS step FROM hits JOIN numbered USING (id, template, diagonal)) GROUP BY ALL
), kept AS (
    SELECT id, template, first, label, phrase, covered::DOUBLE / len(words) AS share FROM spans JOIN templates USING (template) WHERE covered >= needed
)
SELECT any_value(doc_id) AS doc_id, len(any_value(words))::BIGINT AS n_words, count(*) FILTER (phrase) AS n_base,
       (min(first) FILTER (phrase))::BIGINT AS first_word, (max(first) FILTER (phrase))::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0)::DOUBLE AS score
FROM docs LEFT JOIN kept USING (id) GROUP BY id"""


@query(_license_sql())
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))

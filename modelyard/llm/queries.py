"""Registered queries of this package, and their check SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm import (
    block_naming,
    conversation_repair,
    embedding_links,
    features,
    fill_in_middle,
    jaccard_join,
    language,
    mixing,
    pii,
    piece_encoding,
    quality_classifier,
    quality_rules,
    toxicity,
    url_rules,
)
from modelyard.sources.tables import table

MODEL = "piece_bpe_32k.model"
URL_RULES = [
    url_rules.UrlRule("allow", "org/"),
    url_rules.UrlRule("block", "example.org/es/"),
    url_rules.UrlRule("block", "example.org/en/1"),
    url_rules.UrlRule("allow", "com/fr/"),
    url_rules.UrlRule("block", "com/de/"),
]


def tokenizer_model(name: str = MODEL) -> bytes:
    return piece_encoding.model_bytes(public_tokenizers.path(name))


def op1_embedding_links(spark, sf_dir) -> DataFrame:
    linked = embedding_links.link(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return linked.select("vec_id", "n_links", "component_id", "kept")


def op2_language(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = features.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.select("doc_id", "text", "lang"), ~held)
    return language.predict(docs.select("doc_id", held.alias("held_out"), "text"), model)


def op3_pii(spark, sf_dir) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")

    def joined(rows: Column) -> Column:
        return F.array_join(
            F.transform(
                rows,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op4_toxicity(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = features.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"), ~held)
    return toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), model)


def op5_mixing(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.allot(mixing.sizes(docs)).drop("row_key")


def op6_url_rules(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = url_rules.mine(url_rules.labelled_pages(pages, table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, URL_RULES, mined).drop("url")


def op7_quality_rules(spark, sf_dir) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def op8_piece_encoding(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = piece_encoding.encode(docs, tokenizer_model())
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_jaccard_join(spark, sf_dir) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_quality_classifier(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = features.held_out(F.col("doc_id"), 5, 0)
    network = quality_classifier.fit(docs, labels.select("doc_id", "quality"), ~held)
    return quality_classifier.score(docs.select("doc_id", held.alias("held_out"), "text"), network)


def op11_conversation_repair(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(turns), turns)


def op12_fill_in_middle(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle.transform(docs)
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("fim_text"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_exact_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return block_naming.mark(docs, carried=["doc_id"])


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_links,
        op2_language,
        op3_pii,
        op4_toxicity,
        op5_mixing,
        op6_url_rules,
        op7_quality_rules,
        op8_piece_encoding,
        op9_jaccard_join,
        op10_quality_classifier,
        op11_conversation_repair,
        op12_fill_in_middle,
        op13_exact_dedup,
    )
}

ORACLE: dict[str, str] = {
    "op1_embedding_links": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN component ON component.a = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id
""",
    "op9_jaccard_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), firsts AS (
  SELECT text, any_value(ws) AS ws, min(doc_id) AS rep, count(*) AS copies FROM w WHERE len(ws) > 0 GROUP BY text
), shingles AS (
  SELECT DISTINCT rep, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
    lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM firsts
), sizes AS (SELECT rep, count(*) AS n FROM shingles GROUP BY rep),
shared AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.g = b.g AND a.rep <> b.rep GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.rep = a JOIN sizes y ON y.rep = b WHERE 5 * common >= 4 * (x.n + y.n - common)
), reach AS (
  SELECT rep AS a, rep AS b FROM firsts
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT l.a, sum(f.copies) AS n FROM links l JOIN firsts f ON f.rep = l.b GROUP BY l.a)
SELECT d.doc_id, coalesce(f.rep, d.doc_id) AS class_id, CAST(coalesce(f.copies - 1, 0) + coalesce(g.n, 0) AS BIGINT) AS n_links,
  coalesce(c.c, d.doc_id) AS component_id, d.doc_id = coalesce(c.c, d.doc_id) AS kept
FROM documents d LEFT JOIN firsts f ON f.text = d.text LEFT JOIN component c ON c.a = f.rep LEFT JOIN degree g ON g.a = f.rep
""",
    # inserts: from a state to another at a cost; moves: the one edit of a turn after them
    "op11_conversation_repair": """
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
      lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
      4294967295::BIGINT), 4294967295::BIGINT) % 20 AS code
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed
), inserts(a, b, cost, edits) AS (
  VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')
), kept(a, initial, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), moves AS (
  SELECT a, initial, b, 0 AS cost, 'K' AS edit FROM kept
  UNION ALL SELECT a, NULL, b, 3, 'R' FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) r(a, b)
  UNION ALL SELECT a, NULL, a, 4, 'D' FROM range(4) t(a)
), walk(conv_id, place, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0, 'edits': ''} FROM (SELECT DISTINCT conv_id FROM placed)
  UNION ALL
  SELECT w.conv_id, w.place + 1, m.b, min({'cost': w.best.cost + i.cost + m.cost + CASE WHEN m.edit <> 'D' AND t.fault = 'truncated' THEN 3 ELSE 0 END,
    'edits': w.best.edits || i.edits || m.edit})
  FROM walk w JOIN judged t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.place = w.place + 1
  JOIN inserts i ON i.a = w.state JOIN moves m ON m.a = i.b AND (m.initial IS NULL OR m.initial = t.initial)
  WHERE m.edit = 'D' OR t.fault NOT IN ('blank', 'duplicate')
  GROUP BY w.conv_id, w.place + 1, m.b
), solved AS (
  SELECT w.conv_id, min({'cost': w.best.cost + i.cost, 'edits': w.best.edits || i.edits}) AS best
  FROM walk w JOIN (SELECT conv_id, max(place) AS n FROM placed GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.place
  JOIN inserts i ON i.a = w.state AND i.b IN (0, 3) GROUP BY w.conv_id
), letters AS (
  SELECT conv_id, unnest(string_split(best.edits, '')) AS edit, generate_subscripts(string_split(best.edits, ''), 1) AS pos
  FROM solved WHERE best.edits <> ''
), aligned AS (
  SELECT l.*, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS place FROM letters l
), emitted AS (
  SELECT a.conv_id, a.pos, a.edit, t.role, CASE WHEN edit = 'I' THEN '' ELSE t.text END AS text, coalesce(edit = 'K' AND t.initial = 's', false) AS is_system
  FROM aligned a LEFT JOIN judged t ON t.conv_id IS NOT DISTINCT FROM a.conv_id AND t.place = a.place WHERE a.edit <> 'D'
), roles AS (
  SELECT *, count(*) FILTER (NOT is_system) OVER (PARTITION BY conv_id ORDER BY pos) AS k FROM emitted
), texts AS (
  SELECT conv_id, count(*) AS n, string_agg(CASE WHEN edit = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS whole
  FROM roles GROUP BY conv_id
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM judged) GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.edits, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256, coalesce(n, 0)::BIGINT AS n_repaired
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op12_fill_in_middle": """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), h AS (
  SELECT *, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM drawn
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), pieces AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM cut
)
SELECT doc_id, n, form, CASE form WHEN 'plain' THEN NULL ELSE length(p) END AS prefix_chars, CASE form WHEN 'plain' THEN NULL ELSE length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM pieces
""",
    "op13_exact_dedup": """
WITH clean AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
), placed AS (
  SELECT doc_id, t, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM clean WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM placed
""",
}

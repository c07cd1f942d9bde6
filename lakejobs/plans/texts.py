"""Text and vector queries over documents, embeddings and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.functions import texts
from lakejobs.functions.vectors import top_k
from lakejobs.registry import query

# The test documents are invented prose, so the lexicons name words that occur in it.
UP, DOWN = ("the", "la", "der"), ("and", "et", "und", "y")
LABELS = {"english": ("the", "and", "of"), "french": ("le", "la", "et"), "german": ("der", "die", "und"), "spanish": ("el", "los", "y")}


def _hits(names) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"len(list_filter(w, lambda x: x IN ({listed})))"


WORDS_SQL = r"SELECT *, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents"


@query("text_sentiment", f"""
WITH d AS ({WORDS_SQL}), s AS (SELECT doc_id, {_hits(UP)} AS up, {_hits(DOWN)} AS down FROM d)
SELECT doc_id, CASE WHEN up > down THEN 'positive' WHEN up < down THEN 'negative' WHEN up > 0 THEN 'mixed' ELSE 'neutral' END AS sentiment FROM s""")
def text_sentiment(t):
    return t.documents.select("doc_id", texts.sentiment("text", UP, DOWN).alias("sentiment"))


@query("text_classify", f"""
WITH d AS ({WORDS_SQL}), s AS (SELECT doc_id, {_hits(LABELS['english'])} AS a, {_hits(LABELS['french'])} AS b, {_hits(LABELS['german'])} AS c, {_hits(LABELS['spanish'])} AS e FROM d)
SELECT doc_id, CASE WHEN a >= greatest(b, c, e) THEN 'english' WHEN b >= greatest(c, e) THEN 'french' WHEN c >= e THEN 'german' ELSE 'spanish' END AS label FROM s""")
def text_classify(t):
    return t.documents.select("doc_id", texts.classify("text", LABELS).alias("label"))


@query("text_extract", f"""
SELECT doc_id, nullif(regexp_extract(text, '{texts.ENTITY_PATTERNS['email']}'), '') AS email, nullif(regexp_extract(text, '{texts.ENTITY_PATTERNS['url']}'), '') AS url,
       nullif(regexp_extract(text, '{texts.ENTITY_PATTERNS['phone']}'), '') AS phone FROM documents""")
def text_extract(t):
    return t.documents.select("doc_id", texts.extract("text", ["email", "url", "phone"]).alias("e")).select("doc_id", "e.*")


@query("text_mask_entities", f"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{texts.ENTITY_PATTERNS['email']}', '[MASKED]', 'g'), '{texts.ENTITY_PATTERNS['number']}', '[MASKED]', 'g')) AS masked_md5 FROM documents""")
def text_mask_entities(t):
    return t.documents.select("doc_id", F.md5(texts.mask_entities("text", ["email", "number"])).alias("masked_md5"))


SUMMARY_SQL = r"""
WITH pieces AS (
  SELECT doc_id, regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1) || '|\n+') AS p FROM documents),
placed AS (SELECT doc_id, unnest(p) AS sentence, unnest(range(len(p))) AS position FROM pieces),
sentences AS (
  SELECT *, list_filter(regexp_split_to_array(lower(sentence), '\s+'), lambda x: x <> '') AS tokens FROM placed),
each AS (SELECT doc_id, position, len(tokens) AS n_words, unnest(tokens) AS word FROM sentences),
often AS (SELECT doc_id, word, count(*) AS in_text FROM each GROUP BY ALL),
scored AS (
  SELECT e.doc_id, e.position, e.n_words, sum(o.in_text) / e.n_words AS score
  FROM each e JOIN often o ON o.doc_id = e.doc_id AND o.word = e.word GROUP BY e.doc_id, e.position, e.n_words),
used AS (
  SELECT *, sum(n_words) OVER (PARTITION BY doc_id ORDER BY score DESC, position ROWS UNBOUNDED PRECEDING) AS used FROM scored),
kept AS (
  SELECT u.doc_id, string_agg(s.sentence, ' ' ORDER BY u.position) AS summary
  FROM used u JOIN sentences s ON s.doc_id = u.doc_id AND s.position = u.position WHERE u.used <= 40 GROUP BY u.doc_id)
SELECT d.doc_id, coalesce(k.summary, '') AS summary FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id"""


@query("text_summarize", SUMMARY_SQL)
def text_summarize(t):
    """Extractive summary of up to 40 words."""
    return texts.summarize(t.documents, "doc_id", "text", 40)


@query("text_batch_infer", "SELECT doc_id, CAST(length(lang || ': ' || text) AS VARCHAR) AS answer FROM documents")
def text_batch_infer(t):
    """Prompts from columns, answered by a stand-in model that returns the prompt length."""
    prompts = t.documents.select("doc_id", F.concat("lang", F.lit(": "), "text").alias("prompt"))
    return texts.infer(prompts, "prompt", "answer", lambda batch: [str(len(p)) for p in batch]).select("doc_id", "answer")


NEAREST_SQL = """
WITH q AS (SELECT embedding AS e FROM embeddings ORDER BY vec_id LIMIT 1)
SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])), 6) AS score FROM embeddings, q
{where} ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])) DESC, vec_id LIMIT {k}"""


def first_vector(t) -> list[float]:
    """The query vector: one row, read like a caller's literal."""
    return t.embeddings.agg(F.min_by("embedding", "vec_id")).first()[0]


@query("vector_topk", NEAREST_SQL.format(where="WHERE label IN (1, 2, 3)", k=10))
def vector_topk(t):
    wanted = F.col("label").isin(1, 2, 3)
    return top_k(t.embeddings, "embedding", first_vector(t), 10, "vec_id", wanted).select(
        "vec_id", "label", F.round("score", 6).alias("score"))


@query("rag_context", f"""
WITH hit AS ({NEAREST_SQL.format(where='', k=3)}), n AS (SELECT hit.*, row_number() OVER (ORDER BY score DESC, vec_id) AS r FROM hit)
SELECT md5(string_agg(text, chr(10) ORDER BY r)) AS context_md5, count(*) AS hits FROM n JOIN documents ON doc_id = vec_id""")
def rag_context(t):
    """Texts of the three nearest rows joined in score order (hashed here to keep the row small)."""
    hits = top_k(t.embeddings, "embedding", first_vector(t), 3, "vec_id").select(F.col("vec_id").alias("doc_id"), "score")
    found = hits.join(t.documents, "doc_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "doc_id", "text"))).alias("parts"))
    return found.select(
        F.md5(F.concat_ws("\n", F.transform("parts", lambda p: p["text"]))).alias("context_md5"),
        F.size("parts").cast("long").alias("hits"))


@query("eval_answers", r"""
WITH p AS (SELECT a.conv_id, b.turn, b.text AS response, a.text AS expected FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
w AS (SELECT conv_id, turn, response = expected AS exact, list_distinct(list_filter(regexp_split_to_array(lower(response), '\s+'), lambda x: x <> '')) AS r,
             list_distinct(list_filter(regexp_split_to_array(lower(expected), '\s+'), lambda x: x <> '')) AS e FROM p)
SELECT conv_id, turn, exact, round(len(list_intersect(r, e)) / CAST(nullif(len(e), 0) AS DOUBLE), 6) AS overlap FROM w""")
def eval_answers(t):
    """Each turn scored against the turn before it as the expected text."""
    first = t.conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("expected"))
    second = t.conversations.select("conv_id", "turn", F.col("text").alias("response"))
    return first.join(second, ["conv_id", "turn"]).select(
        "conv_id", "turn", (F.col("response") == F.col("expected")).alias("exact"),
        F.round(texts.overlap_share("response", "expected"), 6).alias("overlap"))

"""Registered queries over the test tables, each with an independent SQL oracle.

Every query reads whole tables (no id subsets, no caps). Each Spark query
is built from library operators; each oracle is plain SQL written
separately for DuckDB, with the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut_lineage, table

DECON_THRESHOLD = 0.6     # term-frequency cosine is coarser than a model; see SURVEY 7.4
NEAR_DUP_THRESHOLD = 0.3  # embedding pair cosines of the test data stay below 0.52
TOP_K = 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def sql_str(s: str) -> str:
    """A SQL string literal (single quotes doubled, other characters kept)."""
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------
# ids, exact dedup
# ---------------------------------------------------------------------------

@register("question_ids", """
SELECT conv_id, text AS question, substr(sha256(text), 1, 16) AS question_id
FROM conversations WHERE turn = 0
""")
def q_question_ids(spark, sf):
    # the question is the turn at position 0: a pushed-down filter and a
    # projection, no shuffle
    from millrace.functions.text import content_id
    conv = table(spark, sf, "conversations", spread=False)
    q = conv.filter(F.col("turn") == 0)
    return q.select("conv_id", F.col("text").alias("question"), content_id(F.col("text")).alias("question_id"))


@register("exact_dedup", """
SELECT substr(sha256(text), 1, 16) AS question_id, min(doc_id) AS doc_id,
       arg_min(text, doc_id) AS text, count(*) AS n_copies
FROM documents GROUP BY 1
""")
def q_exact_dedup(spark, sf):
    from millrace.operators.dedup import exact_dedup, with_content_id
    docs = with_content_id(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return exact_dedup(docs, "question_id", order_col="doc_id", count_col="n_copies")


# ---------------------------------------------------------------------------
# decontamination against the benchmark (model-free term-frequency cosine)
# ---------------------------------------------------------------------------

_TF_SQL = r"""
WITH targets AS (
  SELECT substr(sha256(text), 1, 16) AS question_id, min(doc_id) AS doc_id,
         arg_min(text, doc_id) AS text
  FROM documents GROUP BY 1),
tw AS (SELECT question_id, doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM targets),
ttf AS (SELECT doc_id, term, count(*) AS tf FROM tw GROUP BY 1, 2),
tn AS (SELECT doc_id, sum(tf * tf) AS n2 FROM ttf GROUP BY 1),
bw AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark),
btf AS (SELECT item_id, term, count(*) AS tf FROM bw GROUP BY 1, 2),
bn AS (SELECT item_id, sum(tf * tf) AS n2 FROM btf GROUP BY 1),
pairs AS (
  SELECT t.doc_id, b.item_id, sum(t.tf * b.tf) AS dot
  FROM ttf t JOIN btf b ON t.term = b.term GROUP BY 1, 2),
scored AS (
  SELECT p.doc_id, p.item_id,
         CAST(p.dot AS DOUBLE) / sqrt(CAST(tn.n2 AS DOUBLE) * CAST(bn.n2 AS DOUBLE)) AS score
  FROM pairs p JOIN tn USING (doc_id) JOIN bn USING (item_id)),
best AS (
  SELECT doc_id, item_id, score,
         row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS r
  FROM scored WHERE score > @THR@),
flagged AS (
  SELECT t.question_id, b.doc_id, b.item_id AS match_id, round(b.score, 6) AS score
  FROM best b JOIN targets t USING (doc_id) WHERE r = 1)
"""


def _decon_matches(spark, sf):
    """Flags per unique question without shuffling any text.

    Every copy of a text scores the same, so scoring the raw scan and then
    keeping the smallest doc_id per question id gives the same rows as
    dedup-then-score; only ids and scores move between stages.
    """
    from millrace.functions.text import content_id
    from millrace.operators.dedup import contamination_matches
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ids = docs.select("doc_id", content_id(F.col("text")).alias("question_id"))
    bench = table(spark, sf, "benchmark", spread=False)
    m = contamination_matches(docs, bench, "doc_id", "text", "item_id", "text", DECON_THRESHOLD)
    first = F.min_by(F.struct("doc_id", "match_id", "score"), "doc_id")
    flagged = m.join(ids, "doc_id").groupBy("question_id").agg(first.alias("_f")).select(
        "question_id", "_f.doc_id", "_f.match_id", "_f.score")
    targets = ids.groupBy("question_id").agg(F.min("doc_id").alias("doc_id"))
    return targets, flagged


@register("decontaminate_tf", _TF_SQL.replace("@THR@", str(DECON_THRESHOLD)) + "SELECT * FROM flagged")
def q_decontaminate_tf(spark, sf):
    _, flagged = _decon_matches(spark, sf)
    return flagged.select("question_id", "doc_id", "match_id", F.round("score", 6).alias("score"))


@register("decontaminate_keep", _TF_SQL.replace("@THR@", str(DECON_THRESHOLD)) + """
SELECT question_id, doc_id FROM targets WHERE question_id NOT IN (SELECT question_id FROM flagged)
""")
def q_decontaminate_keep(spark, sf):
    from millrace.operators.dedup import drop_flagged
    targets, flagged = _decon_matches(spark, sf)
    return drop_flagged(targets, flagged, "question_id")


@register("contamination_rate", _TF_SQL.replace("@THR@", str(DECON_THRESHOLD)) + """
SELECT count(*) AS n_total, count(f.question_id) AS n_flagged,
       round(100.0 * count(f.question_id) / count(*), 2) AS rate_pct
FROM targets t LEFT JOIN flagged f USING (question_id)
""")
def q_contamination_rate(spark, sf):
    # flagged ids are a subset of the target ids: two counts, no join back
    targets, flagged = _decon_matches(spark, sf)
    n_flagged = flagged.agg(F.count(F.lit(1))).scalar()
    r = targets.agg(F.count(F.lit(1)).alias("n_total")).select("n_total", n_flagged.alias("n_flagged"))
    return r.select("n_total", "n_flagged",
                    F.round(F.lit(100.0) * F.try_divide(F.col("n_flagged").cast("double"),
                                                        F.col("n_total").cast("double")), 2).alias("rate_pct"))


# ---------------------------------------------------------------------------
# dense vectors: nearest label centroid (top-1 / top-k), self near-duplicates
# ---------------------------------------------------------------------------

_CENTROID_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
el AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e),
cm AS (SELECT label, pos, avg(x) AS x FROM el GROUP BY 1, 2),
cent AS (SELECT label, list(x ORDER BY pos) AS c FROM cm GROUP BY 1),
sc AS (
  SELECT e.vec_id, e.label, cent.label AS match_label,
         list_dot_product(e.v, cent.c) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(cent.c, cent.c))) AS s
  FROM e, cent),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, match_label) AS rank FROM sc)
"""


def _centroid_knn(spark, sf, k):
    from millrace.operators.similarity import knn
    from millrace.operators.vectors import group_centroids
    emb = table(spark, sf, "embeddings")
    cent = group_centroids(emb, "label", "embedding")
    nn = knn(emb, cent, k=k, target_id="vec_id", index_id="label", vector="embedding")
    return emb.select("vec_id", "label"), nn


@register("nn_top1", _CENTROID_SQL + """
SELECT vec_id, label, match_label, round(s, 6) AS score FROM ranked WHERE rank = 1
""")
def q_nn_top1(spark, sf):
    emb, nn = _centroid_knn(spark, sf, 1)
    return emb.join(nn.select(F.col("tid").alias("vec_id"), F.col("iid").cast("int").alias("match_label"),
                              F.round("score", 6).alias("score")), "vec_id")


@register("nn_topk", _CENTROID_SQL + f"""
SELECT vec_id, rank, match_label, round(s, 6) AS score FROM ranked WHERE rank <= {TOP_K}
""")
def q_nn_topk(spark, sf):
    from millrace.operators.similarity import with_rank
    _, nn = _centroid_knn(spark, sf, TOP_K)
    r = with_rank(nn)
    return r.select(F.col("tid").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("iid").cast("int").alias("match_label"), F.round("score", 6).alias("score"))


_SELF_NN_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sc AS (
  SELECT a.vec_id, b.vec_id AS match_id,
         list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS s
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, match_id) AS r FROM sc),
pairs AS (SELECT vec_id, match_id, s FROM best WHERE r = 1 AND s > {thr})
""".format(thr=NEAR_DUP_THRESHOLD)


def _near_dups(spark, sf):
    from millrace.operators.dedup import dense_near_duplicates
    emb = table(spark, sf, "embeddings")
    return emb, dense_near_duplicates(emb, "vec_id", "embedding", NEAR_DUP_THRESHOLD)


@register("near_dup_pairs", _SELF_NN_SQL + "SELECT vec_id, match_id, round(s, 6) AS score FROM pairs")
def q_near_dup_pairs(spark, sf):
    _, pairs = _near_dups(spark, sf)
    return pairs.select("vec_id", "match_id", F.round("score", 6).alias("score"))


@register("near_dup_drop_all", _SELF_NN_SQL + """
SELECT vec_id, label FROM e WHERE vec_id NOT IN (SELECT vec_id FROM pairs)
""")
def q_near_dup_drop_all(spark, sf):
    from millrace.operators.dedup import drop_all_duplicates
    emb, pairs = _near_dups(spark, sf)
    return drop_all_duplicates(emb.select("vec_id", "label"), pairs, "vec_id")


@register("dup_rate", _SELF_NN_SQL + """
SELECT count(*) AS n_total, count(p.vec_id) AS n_flagged,
       round(100.0 * count(p.vec_id) / count(*), 2) AS rate_pct
FROM e LEFT JOIN pairs p USING (vec_id)
""")
def q_dup_rate(spark, sf):
    from millrace.operators.reports import flag_rate
    emb, pairs = _near_dups(spark, sf)
    marked = emb.select("vec_id").join(pairs.select("vec_id", F.lit(True).alias("hit")), "vec_id", "left")
    return flag_rate(marked.select(F.coalesce("hit", F.lit(False)).alias("hit")), "hit")


# ---------------------------------------------------------------------------
# record preparation and chat templates
# ---------------------------------------------------------------------------

from millrace import constants as C  # noqa: E402

_GENERAL_HEAD, _, _GENERAL_TAIL = C.USER_PROMPT.partition("{{content}}")


@register("instruct_records", f"""
WITH ft AS (
  SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS q, max(CASE WHEN turn = 1 THEN text END) AS a
  FROM conversations WHERE turn < 2 GROUP BY conv_id)
SELECT conv_id,
       {sql_str(C.SYSTEM_PROMPT)} || {sql_str(_GENERAL_HEAD)} || q || {sql_str(_GENERAL_TAIL)} AS instruction,
       '' AS input,
       replace(replace(a, '<think>', '<think>' || chr(10)), '</answer>', chr(10) || '</answer>') || '<|im_end|>' AS output
FROM ft WHERE q IS NOT NULL AND a IS NOT NULL
""")
def q_instruct_records(spark, sf):
    from millrace.plans.prepare import instruct_records
    from millrace.sources.chats import first_turns
    ft = first_turns(table(spark, sf, "conversations"), n=2)
    ok, _rejected = instruct_records(ft.select("conv_id", F.col("turn0_text").alias("question"),
                                               F.col("turn1_text").alias("answer")))
    return ok.select("conv_id", "instruction", "input", "output")


def _render_sql(gen: bool) -> str:
    gen_tail = " || '<|im_start|>assistant' || chr(10)" if gen else ""
    return f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos
  FROM conversations),
head AS (
  SELECT conv_id, '<|im_start|>system' || chr(10) ||
         CASE WHEN role = 'system' THEN text ELSE {sql_str(C.CHAT_DEFAULT_SYSTEM)} END
         || '<|im_end|>' || chr(10) AS head
  FROM t WHERE pos = 1),
pieces AS (
  SELECT conv_id, turn,
    CASE
      WHEN role = 'user' OR (role = 'system' AND pos > 1) OR role = 'assistant'
        THEN '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
      WHEN role = 'tool' THEN
        CASE WHEN prev_role IS NULL OR prev_role <> 'tool' THEN '<|im_start|>user' ELSE '' END
        || chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>'
        || CASE WHEN next_role IS NULL OR next_role <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END
      ELSE '' END AS piece
  FROM t)
SELECT h.conv_id, h.head || string_agg(p.piece, '' ORDER BY p.turn){gen_tail} AS rendered
FROM head h JOIN pieces p USING (conv_id) GROUP BY h.conv_id, h.head
"""


def _render(spark, sf, gen):
    from millrace.functions.chat import render_chat
    from millrace.sources.chats import assemble_chats
    chats = assemble_chats(table(spark, sf, "conversations"))
    return chats.select("conv_id", render_chat("messages", add_generation_prompt=gen).alias("rendered"))


@register("chat_render", _render_sql(False))
def q_chat_render(spark, sf):
    return _render(spark, sf, False)


@register("chat_render_genprompt", _render_sql(True))
def q_chat_render_genprompt(spark, sf):
    return _render(spark, sf, True)


# ---------------------------------------------------------------------------
# pre-token counts, length split, histogram, clip stats
# ---------------------------------------------------------------------------

# DuckDB's RE2 has no look-ahead: the oracle drops the "\s+(?!\S)" branch.
# That changes where whitespace runs are cut but not how many pre-tokens a
# text has on these tables, so it is an oracle for counts only.
_RE2_PRETOKEN = C.PRETOKENIZE_REGEX.replace(r"\s+(?!\S)|", "")
LENGTH_LIMIT = 512        # the 32,768 boundary scaled to the test tables
PACK_LENGTH = 2048


def _ntok_sql(col: str) -> str:
    return f"CAST(len(regexp_extract_all({col}, {sql_str(_RE2_PRETOKEN)})) AS INTEGER)"


@register("pretokens", f"""
SELECT conv_id, turn, {_ntok_sql('text')} AS n_pretokens FROM conversations
""")
def q_pretokens(spark, sf):
    from millrace.operators.tokenize import pretoken_counts
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return pretoken_counts(conv, "text").select("conv_id", "turn", "n_pretokens")


@register("token_counts", f"""
SELECT doc_id, n_chars, {_ntok_sql('text')} AS n_tokens FROM documents
""")
def q_token_counts(spark, sf):
    from millrace.operators.tokenize import pretoken_counts
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    return pretoken_counts(docs, "text", "n_tokens").select("doc_id", "n_chars", "n_tokens")


def _doc_lengths(spark, sf):
    from millrace.operators.tokenize import pretoken_counts
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pretoken_counts(docs, "text", "n_tokens").select("doc_id", "n_tokens")


_LEN_SQL = f"WITH l AS (SELECT doc_id, {_ntok_sql('text')} AS n_tokens FROM documents)\n"


@register("length_split", _LEN_SQL + f"""
SELECT doc_id, n_tokens, n_tokens >= {LENGTH_LIMIT} AS is_long FROM l
""")
def q_length_split(spark, sf):
    from millrace.functions.text import is_long
    d = _doc_lengths(spark, sf)
    return d.select("doc_id", "n_tokens", is_long("n_tokens", LENGTH_LIMIT).alias("is_long"))


@register("length_hist", _LEN_SQL + f"""
, s AS (SELECT min(n_tokens) AS mn, max(n_tokens) AS mx FROM l),
b AS (SELECT CASE WHEN s.mx > s.mn THEN least((100 * (l.n_tokens - s.mn)) // (s.mx - s.mn), 99) ELSE 50 END AS bin
      FROM l, s),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(r.bin AS INTEGER) AS bin,
       CASE WHEN s.mx > s.mn THEN s.mn + r.bin * ((s.mx - s.mn) / 100.0) ELSE s.mn - 0.5 + r.bin * 0.01 END AS lo,
       CASE WHEN s.mx > s.mn THEN s.mn + (r.bin + 1) * ((s.mx - s.mn) / 100.0) ELSE s.mn - 0.5 + (r.bin + 1) * 0.01 END AS hi,
       coalesce(c.n, 0) AS n
FROM (SELECT range AS bin FROM range(100)) r CROSS JOIN s LEFT JOIN c USING (bin)
""")
def q_length_hist(spark, sf):
    from millrace.operators.reports import length_histogram
    return length_histogram(_doc_lengths(spark, sf), "n_tokens")


@register("clip_count", _LEN_SQL + f"""
SELECT count(*) AS n_total, max(n_tokens) AS max_len, CAST(count_if(n_tokens > {LENGTH_LIMIT}) AS BIGINT) AS n_clipped FROM l
""")
def q_clip_count(spark, sf):
    from millrace.operators.reports import clip_stats
    return clip_stats(_doc_lengths(spark, sf), "n_tokens", LENGTH_LIMIT)


# ---------------------------------------------------------------------------
# vocabulary lookups (word vocabulary learned from the benchmark)
# ---------------------------------------------------------------------------

_WORD_RE = r"[\p{L}\p{N}]+"
UNK_ID = -1

_VOCAB_SQL = f"""
WITH v AS (
  SELECT token, CAST(dense_rank() OVER (ORDER BY token) - 1 AS INTEGER) AS id
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), {sql_str(_WORD_RE)})) AS token FROM benchmark)),
e AS (SELECT conv_id, turn, regexp_extract_all(lower(text), {sql_str(_WORD_RE)}) AS toks FROM conversations),
x AS (SELECT conv_id, turn, unnest(toks) AS token, unnest(generate_series(1, len(toks))) AS pos FROM e),
enc AS (
  SELECT e.conv_id, e.turn, CAST(len(e.toks) AS INTEGER) AS n_words,
         CAST(count(x.pos) FILTER (WHERE v.id IS NULL) AS BIGINT) AS n_oov,
         coalesce(string_agg(CAST(coalesce(v.id, {UNK_ID}) AS VARCHAR), ',' ORDER BY x.pos) FILTER (WHERE x.pos IS NOT NULL), '') AS ids,
         coalesce(string_agg(v.token, ' ' ORDER BY x.pos) FILTER (WHERE v.token IS NOT NULL), '') AS decoded
  FROM e LEFT JOIN x USING (conv_id, turn) LEFT JOIN v ON v.token = x.token
  GROUP BY e.conv_id, e.turn, e.toks)
"""


def _encoded(spark, sf):
    from millrace.functions.text import words
    from millrace.operators.tokenize import encode_tokens, word_vocab
    vocab = word_vocab(table(spark, sf, "benchmark"), "text")
    conv = table(spark, sf, "conversations").select("conv_id", "turn", words(F.col("text")).alias("toks"))
    enc = encode_tokens(conv, ["conv_id", "turn"], "toks", vocab, unk_id=UNK_ID)
    return vocab, conv, enc


def _csv(col):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


@register("vocab_encode", _VOCAB_SQL + "SELECT conv_id, turn, n_words, n_oov, ids FROM enc")
def q_vocab_encode(spark, sf):
    _, conv, enc = _encoded(spark, sf)
    return enc.select("conv_id", "turn", F.size("ids").alias("n_words"), "n_oov", _csv(F.col("ids")).alias("ids"))


@register("vocab_decode", _VOCAB_SQL + "SELECT conv_id, turn, decoded FROM enc")
def q_vocab_decode(spark, sf):
    from millrace.operators.tokenize import decode_ids
    vocab, _, enc = _encoded(spark, sf)
    dec = decode_ids(enc, ["conv_id", "turn"], "ids", vocab, skip_ids=[UNK_ID], out="decoded")
    return dec.select("conv_id", "turn", "decoded")


@register("oov_report", _VOCAB_SQL + """
SELECT CAST(sum(n_words) AS BIGINT) AS n_tokens, CAST(sum(n_oov) AS BIGINT) AS n_oov,
       round(100.0 * sum(n_oov) / sum(n_words), 2) AS oov_rate_pct FROM enc
""")
def q_oov_report(spark, sf):
    _, _, enc = _encoded(spark, sf)
    r = enc.agg(F.sum(F.size("ids")).cast("long").alias("n_tokens"), F.sum("n_oov").cast("long").alias("n_oov"))
    return r.select("n_tokens", "n_oov",
                    F.round(F.lit(100.0) * F.col("n_oov") / F.col("n_tokens"), 2).alias("oov_rate_pct"))


# ---------------------------------------------------------------------------
# training labels on chat token ids (toy ids: markers + one id per word)
# ---------------------------------------------------------------------------

TRUNC_LIMIT = 256
# toy role ids; 77091 is the answer-role id the masking rule looks for
ROLE_IDS = {"system": 8948, "user": 872, "assistant": C.ASSISTANT_ID}

_IDS_SQL = f"""
WITH tt AS (
  SELECT conv_id, turn,
         [151644, CASE role WHEN 'system' THEN {ROLE_IDS['system']} WHEN 'user' THEN {ROLE_IDS['user']}
                            WHEN 'assistant' THEN {ROLE_IDS['assistant']} ELSE 0 END, 198]
         || list_transform(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+'), lambda w: CAST(1000 + length(w) AS INTEGER))
         || [151645, 198] AS ids
  FROM conversations),
c AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS ids FROM tt GROUP BY conv_id),
s AS (
  SELECT conv_id, ids,
         CASE WHEN len(list_filter(range(1, len(ids)), lambda i: ids[i] = 151644 AND ids[i + 1] = 77091)) > 0
              THEN CAST(list_filter(range(1, len(ids)), lambda i: ids[i] = 151644 AND ids[i + 1] = 77091)[1] + 2 AS INTEGER)
              ELSE 0 END AS answer_start
  FROM c),
t AS (
  SELECT conv_id, ids, answer_start,
         CASE WHEN len(ids) > {TRUNC_LIMIT} THEN list_slice(ids, 1, {TRUNC_LIMIT}) || list_slice(ids, len(ids) - 1, len(ids))
              ELSE ids END AS tids
  FROM s),
lb AS (
  SELECT conv_id, ids, answer_start, tids,
         list_transform(range(answer_start), lambda x: -100)
         || CASE WHEN answer_start < len(tids) THEN list_slice(tids, answer_start + 1, len(tids)) ELSE [] END AS labels
  FROM t)
"""


def _chat_ids(spark, sf):
    from millrace.plans.prepare import toy_chat_ids
    return toy_chat_ids(table(spark, sf, "conversations"), ROLE_IDS)


@register("answer_start", _IDS_SQL + "SELECT conv_id, CAST(len(ids) AS INTEGER) AS n_ids, answer_start FROM s")
def q_answer_start(spark, sf):
    from millrace.functions.arrays import answer_start
    ids = _chat_ids(spark, sf)
    return ids.select("conv_id", F.size("input_ids").alias("n_ids"), answer_start("input_ids").alias("answer_start"))


@register("truncate_ids", _IDS_SQL + """
SELECT conv_id, CAST(len(ids) AS INTEGER) AS n_ids, CAST(len(tids) AS INTEGER) AS n_trunc,
       array_to_string(tids, ',') AS ids FROM t
""")
def q_truncate_ids(spark, sf):
    from millrace.operators.labels import build_labels
    lab = build_labels(_chat_ids(spark, sf).withColumn("n_ids", F.size("input_ids")), limit=TRUNC_LIMIT)
    return lab.select("conv_id", "n_ids", F.size("input_ids").alias("n_trunc"),
                      _csv(F.col("input_ids")).alias("ids"))


@register("label_mask", _IDS_SQL + """
SELECT conv_id, CAST(len(labels) AS INTEGER) AS n_labels,
       CAST(len(list_filter(labels, lambda x: x = -100)) AS INTEGER) AS n_masked,
       answer_start > len(tids) AS mask_overflow, array_to_string(labels, ',') AS labels FROM lb
""")
def q_label_mask(spark, sf):
    from millrace.operators.labels import build_labels
    lab = build_labels(_chat_ids(spark, sf), limit=TRUNC_LIMIT)
    return lab.select("conv_id", F.size("labels").alias("n_labels"),
                      F.size(F.filter("labels", lambda x: x == C.IGNORE_ID)).alias("n_masked"),
                      "mask_overflow", _csv(F.col("labels")).alias("labels"))


# ---------------------------------------------------------------------------
# packing (documents, pre-token length, pack length 2048)
# ---------------------------------------------------------------------------

PACK_DIGITS = 3           # bucket width of the pack queries, the operator's own default


def _pack_sql(lengths: str, seq_length: int, digits: int) -> str:
    """Next-fit as a recursive query over ``l`` (doc_id, len), which ``lengths`` defines."""
    new_pack = f"fold.offs + fold.len + sized.len > {seq_length} OR fold.seg + 1 >= {C.MAX_SEGMENTS}"
    return f"""
WITH RECURSIVE {lengths},
sized AS (
  SELECT doc_id, len, substr(sha256(CAST(doc_id AS VARCHAR)), 1, {digits}) AS bucket,
         row_number() OVER (PARTITION BY substr(sha256(CAST(doc_id AS VARCHAR)), 1, {digits})
                            ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS rn
  FROM l WHERE len <= {seq_length}),
fold AS (
  SELECT bucket, rn, doc_id, len, CAST(0 AS BIGINT) AS pack_no, 0 AS seg, CAST(0 AS BIGINT) AS offs FROM sized WHERE rn = 1
  UNION ALL
  SELECT sized.bucket, sized.rn, sized.doc_id, sized.len,
         CASE WHEN {new_pack} THEN fold.pack_no + 1 ELSE fold.pack_no END,
         CASE WHEN {new_pack} THEN 0 ELSE fold.seg + 1 END,
         CASE WHEN {new_pack} THEN 0 ELSE fold.offs + fold.len END
  FROM fold JOIN sized ON sized.bucket = fold.bucket AND sized.rn = fold.rn + 1),
plan AS (SELECT doc_id, bucket, pack_no, CAST(seg AS INTEGER) AS seg, offs AS "offset", CAST(len AS BIGINT) AS len FROM fold),
packs AS (
  SELECT bucket, pack_no, CAST(count(*) AS INTEGER) AS n_segments, CAST(sum(len) AS BIGINT) AS n_tokens,
         CAST({seq_length} - sum(len) AS BIGINT) AS n_pad,
         string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY seg) AS ids,
         string_agg(CAST("offset" + len AS VARCHAR), ',' ORDER BY seg) AS actual_seq_len
  FROM plan GROUP BY bucket, pack_no)
"""


_DOC_LENGTHS_SQL = f"l AS (SELECT doc_id, {_ntok_sql('text')} AS len FROM documents)"
_PACK_SQL, _PACK_SQL_WIDE = (_pack_sql(_DOC_LENGTHS_SQL, PACK_LENGTH, d) for d in (PACK_DIGITS, 2))


def _plan(spark, sf, digits=PACK_DIGITS):
    from millrace.operators.packing import pack_plan
    plan, _rej = pack_plan(_doc_lengths(spark, sf), "doc_id", "n_tokens", seq_length=PACK_LENGTH, digits=digits)
    return plan


@register("pack_plan", _PACK_SQL + "SELECT * FROM plan")
def q_pack_plan(spark, sf):
    return _plan(spark, sf).select("doc_id", "bucket", "pack_no", "seg", "offset", "len")


@register("pack_plan_wide", _PACK_SQL_WIDE + "SELECT * FROM plan")
def q_pack_plan_wide(spark, sf):
    return _plan(spark, sf, digits=2).select("doc_id", "bucket", "pack_no", "seg", "offset", "len")


@register("pack_rows", _PACK_SQL + "SELECT * FROM packs")
def q_pack_rows(spark, sf):
    from millrace.operators.packing import pack_summary
    s = pack_summary(_plan(spark, sf), "doc_id", PACK_LENGTH)
    return s.select("bucket", "pack_no", "n_segments", "n_tokens", "n_pad", _csv(F.col("ids")).alias("ids"),
                    _csv(F.col("actual_seq_len")).alias("actual_seq_len"))


@register("pack_best_fit", _PACK_SQL + f"""
SELECT CAST(count(*) AS BIGINT) AS n_samples, CAST(sum(len) AS BIGINT) AS n_tokens,
       CAST((SELECT count(*) FROM l WHERE len > {PACK_LENGTH}) AS BIGINT) AS n_rejected,
       true AS none_overfull, true AS one_half_empty_at_most, true AS fewer_packs_than_next_fit
FROM plan
""")
def q_pack_best_fit(spark, sf):
    """Best-fit packs of the documents: what went in, that no pack is overfull, and fill above next-fit (one row)."""
    from millrace.operators.packing import best_fit_plan, pack_summary
    from millrace.session import cut_lineage
    lengths = cut_lineage(_doc_lengths(spark, sf), "lengths")
    plan, rejected = best_fit_plan(lengths, "doc_id", "n_tokens", seq_length=PACK_LENGTH, digits=PACK_DIGITS)
    packs = pack_summary(plan, "doc_id", PACK_LENGTH)
    half = (F.col("n_tokens") * 2 <= PACK_LENGTH) & (F.col("n_segments") < C.MAX_SEGMENTS)
    best = packs.agg(F.sum("n_segments").cast("long").alias("n_samples"), F.sum("n_tokens").alias("n_tokens"),
                     F.max("n_tokens").alias("_most"), F.count_if(half).alias("_half"), F.count(F.lit(1)).alias("_packs"))
    from millrace.operators.packing import pack_plan
    other, _ = pack_plan(lengths, "doc_id", "n_tokens", seq_length=PACK_LENGTH, digits=PACK_DIGITS)
    n_other = other.select("bucket", "pack_no").distinct().agg(F.count(F.lit(1))).scalar()
    n_rejected = rejected.agg(F.count(F.lit(1))).scalar()
    return best.select("n_samples", "n_tokens", n_rejected.alias("n_rejected"), (F.col("_most") <= PACK_LENGTH).alias("none_overfull"),
                       (F.col("_half") <= 1).alias("one_half_empty_at_most"),
                       (F.col("_packs") < n_other).alias("fewer_packs_than_next_fit"))


@register("pack_report", _PACK_SQL + f"""
SELECT CAST(count(*) AS BIGINT) AS n_packs, CAST(sum(n_segments) AS BIGINT) AS n_samples,
       CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       round(sum(n_tokens) / (count(*) * {PACK_LENGTH}.0), 6) AS efficiency,
       round(sum(n_segments) / count(*), 6) AS mean_segments
FROM packs
""")
def q_pack_report(spark, sf):
    from millrace.operators.packing import pack_summary, packing_report
    return packing_report(pack_summary(_plan(spark, sf), "doc_id", PACK_LENGTH), PACK_LENGTH)


# ---------------------------------------------------------------------------
# trainer feed: seeded order, shards, batches, dynamic padding
# ---------------------------------------------------------------------------

BATCH_SIZE = 4
EPOCHS = 2

_FEED_SQL = f"""
WITH l AS (SELECT doc_id, {_ntok_sql('text')} AS n_tokens FROM documents),
o AS (SELECT doc_id, n_tokens,
             CAST(row_number() OVER (ORDER BY sha256('{C.SHUFFLE_SEED}:' || CAST(doc_id AS VARCHAR))) - 1 AS BIGINT) AS rank
      FROM l),
n AS (SELECT count(*) AS n FROM o)
"""


def _ranked(spark, sf):
    from millrace.operators.feed import seeded_rank
    return seeded_rank(_doc_lengths(spark, sf), "doc_id")


@register("seeded_shuffle", _FEED_SQL + "SELECT doc_id, rank FROM o")
def q_seeded_shuffle(spark, sf):
    return _ranked(spark, sf).select("doc_id", "rank")


@register("shards", _FEED_SQL + f"""
SELECT doc_id, rank, CAST(rank % {C.DATA_PARALLEL} AS BIGINT) AS shard, CAST(rank // {C.DATA_PARALLEL} AS BIGINT) AS pos
FROM o, n WHERE rank < n.n - n.n % {C.DATA_PARALLEL}
""")
def q_shards(spark, sf):
    from millrace.operators.feed import shard
    return shard(_ranked(spark, sf)).select("doc_id", "rank", "shard", "pos")


SHARD_FILE_ROWS = 100


@register("shard_files", _FEED_SQL + f"""
SELECT CAST(rank % {C.DATA_PARALLEL} AS BIGINT) AS shard, CAST(rank // {C.DATA_PARALLEL} // {SHARD_FILE_ROWS} AS BIGINT) AS file,
       count(*) AS n_rows, CAST(sum(n_tokens) AS BIGINT) AS n_tokens, min(rank) AS first_rank, max(rank) AS last_rank
FROM o, n WHERE rank < n.n - n.n % {C.DATA_PARALLEL} GROUP BY ALL
""")
def q_shard_files(spark, sf):
    """The manifest of the reader shards, written as files."""
    from millrace.operators.shards import write_shards
    from millrace.session import checkpoint_path
    ranked = _ranked(spark, sf).select("doc_id", "n_tokens", "rank")
    return write_shards(ranked, checkpoint_path(spark, "shards"), len_col="n_tokens", rows_per_file=SHARD_FILE_ROWS).select(
        "shard", "file", "n_rows", "n_tokens", "first_rank", "last_rank")


@register("batches", _FEED_SQL + f"""
SELECT CAST(e.epoch AS INTEGER) AS epoch, CAST(rank // {BATCH_SIZE} AS BIGINT) AS batch, doc_id
FROM o, n, (SELECT range AS epoch FROM range({EPOCHS})) e
WHERE rank // {BATCH_SIZE} < n.n // {BATCH_SIZE}
""")
def q_batches(spark, sf):
    from millrace.operators.feed import batches
    return batches(_ranked(spark, sf), BATCH_SIZE, EPOCHS).select("epoch", "batch", "doc_id")


@register("dyn_pad", _FEED_SQL + f"""
, b AS (SELECT rank // {BATCH_SIZE} AS batch, n_tokens FROM o, n WHERE rank // {BATCH_SIZE} < n.n // {BATCH_SIZE}),
g AS (SELECT batch, max(n_tokens) AS max_len, sum(n_tokens) AS s, count(*) AS c FROM b GROUP BY batch)
SELECT CAST(batch AS BIGINT) AS batch, CAST(max_len AS INTEGER) AS max_len,
       CAST(max_len + ((({C.BATCH_REMAINDER} - max_len) % {C.BATCH_DIVISOR}) + {C.BATCH_DIVISOR}) % {C.BATCH_DIVISOR} AS INTEGER) AS padded_len,
       CAST((max_len + ((({C.BATCH_REMAINDER} - max_len) % {C.BATCH_DIVISOR}) + {C.BATCH_DIVISOR}) % {C.BATCH_DIVISOR}) * c - s AS BIGINT) AS n_pad
FROM g
""")
def q_dyn_pad(spark, sf):
    from millrace.operators.feed import batches, dynamic_padding
    b = batches(_ranked(spark, sf), BATCH_SIZE, 1)
    d = dynamic_padding(b, "n_tokens")
    return d.select("batch", "max_len", "padded_len", F.col("n_pad").cast("long").alias("n_pad"))


# ---------------------------------------------------------------------------
# accuracy reports: labels (quality = correct) joined to documents
# ---------------------------------------------------------------------------

BUDGETS = [1000, 2000, 4000, 8000]

_ACC_SQL = """
WITH s AS (SELECT d.doc_id, d.source, d.lang, d.n_chars, l.quality AS correct
           FROM labels l JOIN documents d USING (doc_id))
"""


def _samples(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("correct"))
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    return lab.join(docs, "doc_id")


@register("avg_at_k", _ACC_SQL + """
, q AS (SELECT source, avg(correct) AS acc, count(*) AS k FROM s GROUP BY source)
SELECT round(avg(acc), 6) AS avg_at_k, count(*) AS n_questions, CAST(sum(k) AS BIGINT) AS n_samples FROM q
""")
def q_avg_at_k(spark, sf):
    from millrace.operators.reports import avg_at_k
    r = avg_at_k(_samples(spark, sf), "source", "correct")
    return r.select(F.round("avg_at_k", 6).alias("avg_at_k"), "n_questions", F.col("n_samples").cast("long").alias("n_samples"))


_BUDGET_VALUES = ", ".join(f"({b})" for b in BUDGETS)


@register("budget_sweep", _ACC_SQL + f"""
, b AS (SELECT * FROM (VALUES {_BUDGET_VALUES}) v(budget)),
q AS (SELECT b.budget, s.source, avg(CASE WHEN s.correct = 1 AND s.n_chars <= b.budget THEN 1.0 ELSE 0.0 END) AS acc
      FROM s, b GROUP BY b.budget, s.source)
SELECT CAST(budget AS INTEGER) AS budget, round(avg(acc), 6) AS accuracy FROM q GROUP BY budget
""")
def q_budget_sweep(spark, sf):
    from millrace.operators.reports import budget_sweep
    r = budget_sweep(_samples(spark, sf), "source", "correct", "n_chars", BUDGETS)
    return r.select("budget", F.round("accuracy", 6).alias("accuracy"))


@register("score_pivot", _ACC_SQL + f"""
, b AS (SELECT * FROM (VALUES {_BUDGET_VALUES}) v(budget)),
q AS (SELECT s.lang, b.budget, s.source, avg(CASE WHEN s.correct = 1 AND s.n_chars <= b.budget THEN 1.0 ELSE 0.0 END) AS acc
      FROM s, b GROUP BY s.lang, b.budget, s.source),
m AS (SELECT lang, budget, round(avg(acc), 6) AS acc FROM q GROUP BY lang, budget)
SELECT lang, {", ".join(f"max(CASE WHEN budget = {b} THEN acc END) AS b{b}" for b in BUDGETS)}
FROM m GROUP BY lang
""")
def q_score_pivot(spark, sf):
    from millrace.operators.reports import budget_sweep, score_table
    per_lang = budget_sweep(_samples(spark, sf), ["lang", "source"], "correct", "n_chars", BUDGETS, by=["lang"])
    per_lang = per_lang.select("lang", F.concat(F.lit("b"), F.col("budget").cast("string")).alias("col"),
                               F.round("accuracy", 6).alias("acc"))
    return score_table(per_lang, ["lang"], "col", "acc", [f"b{b}" for b in BUDGETS])


# ---------------------------------------------------------------------------
# byte-level BPE, approximate vector search
# ---------------------------------------------------------------------------

N_MERGES = 300


def bpe_model(spark, sf):
    """Merge table learned from the benchmark texts, and its vocabulary."""
    from millrace.operators.tokenize import learn_merges, vocab_from_merges
    merges = learn_merges(table(spark, sf, "benchmark"), "text", N_MERGES)
    return merges, vocab_from_merges(merges)


def _cut_sql(col: str) -> str:
    """Pre-tokens of a text. A mark (chr 1) stands where the look-ahead would end a run of blanks; it goes again."""
    marked = f"regexp_replace(nfc_normalize({col}), '(\\s)([^\\S\\r\\n])(\\S)', '\\1' || chr(1) || '\\2\\3', 'g')"
    cut = f"regexp_extract_all({marked}, {sql_str(_RE2_PRETOKEN)})"
    return f"list_filter(list_transform({cut}, lambda x: replace(x, chr(1), '')), lambda x: x <> '')"


def _bpe_sql(source: str, keys: str) -> str:
    """CTEs ``src`` (rn, keys, text), ``tk`` (rn, tok, pos) and ``en`` (tok, syms, ids), symbols as hexadecimal bytes.

    The learned table merges single bytes alone, so a pre-token is encoded by applying the
    merges one after the other. The texts of the tables hold no special tokens.
    """
    return f"""
WITH byte AS (SELECT b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 AS kept FROM range(256) t(b)),
sym AS (SELECT b, printf('%02X', b) AS h, chr(CAST(CASE WHEN kept THEN b
          ELSE 255 + row_number() OVER (PARTITION BY kept ORDER BY b) END AS INTEGER)) AS s FROM byte),
bt AS (SELECT tok, count(*) AS f FROM (SELECT unnest({_cut_sql('text')}) AS tok FROM benchmark) GROUP BY tok),
pr AS (SELECT substr(h, 2 * i + 1, 2) AS l, substr(h, 2 * i + 3, 2) AS r, sum(f) AS freq
       FROM (SELECT hex(encode(tok)) AS h, f, unnest(range(strlen(tok) - 1)) AS i FROM bt) GROUP BY 1, 2),
mg AS (SELECT l || r AS m, row_number() OVER (ORDER BY freq DESC, a.s, b.s) - 1 AS rank
       FROM pr JOIN sym a ON a.h = l JOIN sym b ON b.h = r QUALIFY rank < {N_MERGES}),
ms AS (SELECT list(m ORDER BY rank) AS merges FROM mg),
vo AS (SELECT map(list(k ORDER BY id), list(id ORDER BY id)) AS vocab
       FROM (SELECT h AS k, b AS id FROM sym UNION ALL SELECT m, 256 + rank FROM mg)),
src AS (SELECT row_number() OVER () AS rn, {keys}, text FROM {source}),
tk AS (SELECT rn, unnest(c) AS tok, generate_subscripts(c, 1) AS pos FROM (SELECT rn, {_cut_sql('text')} AS c FROM src)),
dk AS (SELECT tok, list_reduce(list_prepend(regexp_replace(hex(encode(tok)), '(..)', '<\\1>', 'g'), merges),
         lambda done, m: replace(done, '<' || substr(m, 1, 2) || '><' || substr(m, 3, 2) || '>', '<' || m || '>')) AS s
       FROM (SELECT DISTINCT tok FROM tk), ms),
en AS (SELECT tok, regexp_extract_all(s, '[0-9A-F]+') AS syms,
         list_transform(regexp_extract_all(s, '[0-9A-F]+'), lambda x: vocab[x]) AS ids FROM dk, vo)
"""


@register("bpe_encode", _bpe_sql("conversations", "conv_id, turn") + """
SELECT conv_id, turn, CAST(coalesce(sum(len(ids)), 0) AS INTEGER) AS n_tokens,
       coalesce(string_agg(array_to_string(ids, ','), ',' ORDER BY pos), '') AS ids
FROM src LEFT JOIN tk USING (rn) LEFT JOIN en USING (tok) GROUP BY rn, conv_id, turn
""")
def q_bpe_encode(spark, sf):
    from millrace.operators.tokenize import bpe_encode
    merges, vocab = bpe_model(spark, sf)
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    enc = bpe_encode(conv, ["conv_id", "turn"], "text", merges, vocab)
    return enc.select("conv_id", "turn", "n_tokens", _csv(F.col("ids")).alias("ids"))


@register("bpe_token_counts", _bpe_sql("documents", "doc_id") + """
SELECT doc_id, CAST(coalesce(sum(len(ids)), 0) AS BIGINT) AS n_tokens
FROM src LEFT JOIN tk USING (rn) LEFT JOIN en USING (tok) GROUP BY rn, doc_id
""")
def q_bpe_token_counts(spark, sf):
    from millrace.operators.tokenize import token_counts_bpe
    merges, _ = bpe_model(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts_bpe(docs, ["doc_id"], "text", merges)


LSH_THRESHOLD = 0.9
COPY_OFFSET = 1_000_000

_LSH_SQL = f"""
WITH u AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  UNION ALL
  SELECT vec_id + {COPY_OFFSET}, list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * (1 + 0.1 * (i % 3 - 1)))
  FROM embeddings),
p AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS s FROM u a JOIN u b ON a.id < b.id)
SELECT a, b, round(s, 6) AS score FROM p WHERE s > {LSH_THRESHOLD}
"""


@register("lsh_candidates", _LSH_SQL)
def q_lsh_candidates(spark, sf):
    """Every vector with a slightly changed copy of itself: LSH finds the pairs above the threshold."""
    from millrace.operators.similarity import lsh_pairs
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    changed = emb.select((F.col("id") + COPY_OFFSET).alias("id"), F.transform(
        "v", lambda x, i: x * (F.lit(1.0) + F.lit(0.1) * ((i + 1) % 3 - 1))).alias("v"))
    found = lsh_pairs(emb.unionByName(changed), LSH_THRESHOLD, "id", "v")
    return found.select("a", "b", F.round("score", 6).alias("score"))


@register("vector_pairs", f"""
WITH u AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS s FROM u a JOIN u b ON a.id < b.id)
SELECT a, b, round(s, 6) AS score FROM p WHERE s > {NEAR_DUP_THRESHOLD}
""")
def q_vector_pairs(spark, sf):
    """The table's own pairs above the near-duplicate threshold, by exact blocks (LSH is no filter there)."""
    from millrace.operators.similarity import dense_pairs
    found = dense_pairs(table(spark, sf, "embeddings"), NEAR_DUP_THRESHOLD, "vec_id")
    return found.select("a", "b", F.round("score", 6).alias("score"))


@register("ivf_topk", f"""
WITH u AS (SELECT vec_id, embedding FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS match_id,
             list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s
      FROM u a JOIN u b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, match_id) AS rank FROM p)
SELECT vec_id, rank, match_id, round(s, 6) AS score FROM r WHERE rank <= {TOP_K}
""")
def q_ivf_topk(spark, sf):
    """Clustered search by the sizing rules: exact for tables of this size."""
    from millrace.operators.similarity import ivf_knn, ivf_sizes, with_rank
    emb = table(spark, sf, "embeddings")
    nlist, nprobe = ivf_sizes(emb.count(), dedup=True)
    nn = ivf_knn(emb, emb, k=TOP_K, target_id="vec_id", index_id="vec_id", nlist=nlist, nprobe=nprobe,
                 exclude_self=True)
    r = with_rank(nn)
    return r.select(F.col("tid").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("iid").alias("match_id"), F.round("score", 6).alias("score"))


@register("ivf_recall")
def q_ivf_recall(spark, sf):
    """Clustered search with fewer probes than lists against the exact one (one row)."""
    from millrace.operators.similarity import ivf_knn, knn
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    exact = knn(emb, emb, 1, "vec_id", "vec_id", exclude_self=True)
    near = ivf_knn(emb, emb, 1, "vec_id", "vec_id", nlist=32, nprobe=12, exclude_self=True)
    j = exact.join(near.select("tid", F.col("iid").alias("found")), "tid", "left")
    return j.agg(F.count(F.lit(1)).alias("n_queries"),
                 F.sum(F.coalesce((F.col("iid") == F.col("found")).cast("int"), F.lit(0))).alias("n_found"))


IVF_RECALL = 0.9
IVF_QUERY_EVERY = 50


@register("ivf_calibrated", f"""
SELECT CAST(count(*) FILTER (WHERE vec_id % {IVF_QUERY_EVERY} = 0) AS BIGINT) AS n_queries,
       CAST(count(*) FILTER (WHERE vec_id % {IVF_QUERY_EVERY} = 0) * least({TOP_K}, count(*) - 1) AS BIGINT) AS n_neighbours,
       true AS recall_reached, true AS fewer_probes_than_lists
FROM embeddings
""")
def q_ivf_calibrated(spark, sf):
    """Every fiftieth row against all, in a clustered index with calibrated probes, measured against exact search (one row)."""
    from millrace.operators.clustered import build_clustered_index, clustered_search
    from millrace.operators.similarity import knn
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    queries = emb.filter(F.col("vec_id") % IVF_QUERY_EVERY == 0)
    index = build_clustered_index(emb, "vec_id")
    found = clustered_search(queries, index, TOP_K, "vec_id", recall=IVF_RECALL, exclude_self=True)
    exact = knn(queries, emb, TOP_K, "vec_id", "vec_id", exclude_self=True)
    both = exact.select("tid", "iid").join(found.select("tid", "iid", F.lit(1).alias("hit")), ["tid", "iid"], "left")
    r = both.agg(F.countDistinct("tid").alias("n_queries"), F.count(F.lit(1)).alias("n_neighbours"), F.count("hit").alias("_hits"))
    return r.select("n_queries", "n_neighbours", (F.col("_hits") >= IVF_RECALL * F.col("n_neighbours")).alias("recall_reached"),
                    F.lit(index.probes < index.lists).alias("fewer_probes_than_lists"))


@register("string_id_dups", f"""
WITH p AS (SELECT a.vec_id AS a, b.vec_id AS b,
                  list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT 'v' || a AS vec_key, 'v' || b AS match_key, s,
             row_number() OVER (PARTITION BY a ORDER BY s DESC, 'v' || b) AS rank FROM p)
SELECT vec_key, match_key, round(s, 6) AS score FROM r WHERE rank = 1 AND s > {NEAR_DUP_THRESHOLD}
""")
def q_string_id_dups(spark, sf):
    """Near duplicates of rows whose ids are strings, as the pipeline's content ids are."""
    from millrace.operators.dedup import dense_near_duplicates
    emb = table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("vec_key"), "embedding")
    d = dense_near_duplicates(emb, "vec_key", "embedding", NEAR_DUP_THRESHOLD)
    return d.select("vec_key", F.col("match_id").alias("match_key"), F.round("score", 6).alias("score"))


@register("bpe_roundtrip", _bpe_sql("conversations", "conv_id, turn") + """
SELECT conv_id, turn, CAST(coalesce(sum(len(ids)), 0) AS INTEGER) AS n_tokens,
       CAST(coalesce(sum(len(list_filter(ids, lambda x: x IS NULL))), 0) AS INTEGER) AS n_oov,
       coalesce(nfc_normalize(any_value(text)), '')
         = decode(unhex(coalesce(string_agg(array_to_string(syms, ''), '' ORDER BY pos), ''))) AS roundtrip_ok
FROM src LEFT JOIN tk USING (rn) LEFT JOIN en USING (tok) GROUP BY rn, conv_id, turn
""")
def q_bpe_roundtrip(spark, sf):
    """Round-trip / OOV report per chat turn: decode(encode(x)) against NFC(x)."""
    from millrace.operators.tokenize import bpe_encode, decode_bpe, nfc
    merges, vocab = bpe_model(spark, sf)
    conv = table(spark, sf, "conversations").select("conv_id", "turn", nfc("text").alias("text"))
    # read by the decoder and the report: made once, and no task runs the encoder and the decoder side by side
    conv = cut_lineage(conv, "nfc-turns")
    enc = cut_lineage(bpe_encode(conv, ["conv_id", "turn"], "text", merges, vocab), "encoded-turns")
    dec = decode_bpe(enc, ["conv_id", "turn"], "ids", vocab, out="decoded")
    j = conv.join(enc, ["conv_id", "turn"]).join(dec, ["conv_id", "turn"])
    return j.select("conv_id", "turn", "n_tokens",
                    F.size(F.filter("ids", lambda x: x.isNull())).alias("n_oov"),
                    (F.coalesce(F.col("text"), F.lit("")) == F.col("decoded")).alias("roundtrip_ok"))


# ---------------------------------------------------------------------------
# near-duplicate texts (exact term-frequency cosine, block against block)
# ---------------------------------------------------------------------------

TEXT_DUP_THRESHOLD = 0.9

_TEXT_DUP_SQL = r"""
WITH targets AS (
  SELECT substr(sha256(text), 1, 16) AS question_id, min(doc_id) AS doc_id, arg_min(text, doc_id) AS text
  FROM documents GROUP BY 1),
tw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM targets),
ttf AS (SELECT doc_id, term, count(*) AS tf FROM tw GROUP BY 1, 2),
tn AS (SELECT doc_id, sum(tf * tf) AS n2 FROM ttf GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.tf * b.tf) AS dot
          FROM ttf a JOIN ttf b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY 1, 2),
scored AS (SELECT p.a, p.b, CAST(p.dot AS DOUBLE) / sqrt(CAST(x.n2 AS DOUBLE) * CAST(y.n2 AS DOUBLE)) AS s
           FROM pairs p JOIN tn x ON x.doc_id = p.a JOIN tn y ON y.doc_id = p.b),
best AS (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS r FROM scored WHERE s > @THR@),
flagged AS (SELECT a AS doc_id, b AS match_id, s FROM best WHERE r = 1)
""".replace("@THR@", str(TEXT_DUP_THRESHOLD))


def _text_dups(spark, sf):
    from millrace.operators.dedup import exact_dedup, text_near_duplicates, with_content_id
    docs = with_content_id(table(spark, sf, "documents").select("doc_id", "text"), "text")
    targets = exact_dedup(docs, "question_id", order_col="doc_id")
    return targets, text_near_duplicates(targets, "doc_id", "text", TEXT_DUP_THRESHOLD)


@register("text_near_dup_pairs", _TEXT_DUP_SQL + "SELECT doc_id, match_id, round(s, 6) AS score FROM flagged")
def q_text_near_dup_pairs(spark, sf):
    _, pairs = _text_dups(spark, sf)
    return pairs.select("doc_id", "match_id", F.round("score", 6).alias("score"))


@register("text_near_dup_drop_all", _TEXT_DUP_SQL + """
SELECT question_id, doc_id FROM targets WHERE doc_id NOT IN (SELECT doc_id FROM flagged)
""")
def q_text_near_dup_drop_all(spark, sf):
    from millrace.operators.dedup import drop_all_duplicates
    targets, pairs = _text_dups(spark, sf)
    return drop_all_duplicates(targets.select("question_id", "doc_id"), pairs, "doc_id")


@register("text_dup_rate", _TEXT_DUP_SQL + """
SELECT count(*) AS n_total, count(f.doc_id) AS n_flagged,
       round(100.0 * count(f.doc_id) / count(*), 2) AS rate_pct
FROM targets t LEFT JOIN flagged f USING (doc_id)
""")
def q_text_dup_rate(spark, sf):
    from millrace.operators.reports import flag_rate
    targets, pairs = _text_dups(spark, sf)
    marked = targets.select("doc_id").join(pairs.select("doc_id", F.lit(True).alias("hit")), "doc_id", "left")
    return flag_rate(marked.select(F.coalesce("hit", F.lit(False)).alias("hit")), "hit")


# ---------------------------------------------------------------------------
# split file names; packed training rows end to end
# ---------------------------------------------------------------------------

@register("split_names", _LEN_SQL.replace("SELECT doc_id,", "SELECT doc_id, source,") + f"""
SELECT doc_id, n_tokens >= {LENGTH_LIMIT} AS is_long,
       source || CASE WHEN n_tokens >= {LENGTH_LIMIT} THEN '_gt_32K.jsonl' ELSE '_lt_32K.jsonl' END AS split_file
FROM l
""")
def q_split_names(spark, sf):
    from millrace.functions.text import is_long, split_name
    from millrace.operators.tokenize import pretoken_counts
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    d = pretoken_counts(docs, "text", "n_tokens").select(
        "doc_id", F.concat("source", F.lit(".jsonl")).alias("file_name"),
        is_long("n_tokens", LENGTH_LIMIT).alias("is_long"))
    return d.select("doc_id", "is_long", split_name(F.col("file_name"), F.col("is_long")).alias("split_file"))


CHAT_PACK_LENGTH = 1024
_CHAT_PACKED_SQL = _pack_sql(
    _IDS_SQL.replace(f"> {TRUNC_LIMIT}", f"> {CHAT_PACK_LENGTH}").replace(f"1, {TRUNC_LIMIT})", f"1, {CHAT_PACK_LENGTH})")
    .strip().removeprefix("WITH").strip() + """,
l AS (SELECT conv_id AS doc_id, CAST(len(tids) AS INTEGER) AS len FROM lb WHERE answer_start <= len(tids))""",
    CHAT_PACK_LENGTH + 2, PACK_DIGITS)


def _chat_packs(spark, sf):
    """Chat ids -> prompt-masked labels -> packs of 1024 with segment metadata."""
    from millrace.operators.labels import build_labels, split_valid
    from millrace.operators.packing import materialize_packs, pack_plan
    ok, _rejected = split_valid(build_labels(_chat_ids(spark, sf), limit=CHAT_PACK_LENGTH))
    # the plan and the arrays both read the samples: made once
    ok = cut_lineage(ok.select(F.col("conv_id").alias("id"), "input_ids", "labels"), "chat-samples")
    plan, _oversize = pack_plan(ok.select("id", F.size("input_ids").alias("len")), "id", "len",
                                seq_length=CHAT_PACK_LENGTH + 2, digits=PACK_DIGITS)
    return materialize_packs(plan, ok, "id", seq_length=CHAT_PACK_LENGTH + 2)


@register("packed_samples", _CHAT_PACKED_SQL + f"""
SELECT p.bucket, p.pack_no, CAST(count(*) AS INTEGER) AS n_segments, CAST(sum(p.len) AS BIGINT) AS n_tokens,
       CAST(sum(len(list_filter(lb.labels, lambda x: x <> {C.IGNORE_ID}))) AS INTEGER) AS n_loss,
       {CHAT_PACK_LENGTH + 2} AS length
FROM plan p JOIN lb ON lb.conv_id = p.doc_id GROUP BY p.bucket, p.pack_no
""")
def q_packed_samples(spark, sf):
    packed = _chat_packs(spark, sf)
    return packed.select("bucket", "pack_no", F.size("actual_seq_len").alias("n_segments"),
                         F.element_at("actual_seq_len", -1).alias("n_tokens"),
                         F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x).alias("n_loss"),
                         F.size("input_ids").alias("length"))


@register("packed_masks", _CHAT_PACKED_SQL + f"""
, m AS (SELECT p.*, lb.tids, lb.labels FROM plan p JOIN lb ON lb.conv_id = p.doc_id),
g AS (
  SELECT bucket, pack_no, flatten(list(tids ORDER BY seg)) AS ids, flatten(list(labels ORDER BY seg)) AS labels,
         flatten(list(list_transform(range(len), lambda k: seg) ORDER BY seg)) AS segs,
         flatten(list(range(len) ORDER BY seg)) AS pos, CAST({CHAT_PACK_LENGTH + 2} - sum(len) AS BIGINT) AS pad
  FROM m GROUP BY bucket, pack_no)
SELECT bucket, pack_no,
       array_to_string(ids || list_transform(range(pad), lambda k: {C.PAD_ID}), ',') AS input_ids,
       array_to_string(labels || list_transform(range(pad), lambda k: {C.IGNORE_ID}), ',') AS labels,
       array_to_string(segs || list_transform(range(pad), lambda k: -1), ',') AS segment_ids,
       array_to_string(pos || list_transform(range(pad), lambda k: 0), ',') AS position_ids,
       array_to_string(list_transform(labels, lambda x: CASE WHEN x = {C.IGNORE_ID} THEN 0 ELSE 1 END)
                       || list_transform(range(pad), lambda k: 0), ',') AS loss_mask
FROM g
""")
def q_packed_masks(spark, sf):
    """The arrays themselves: padded ids and labels, segment numbers, positions and the loss mask of every pack."""
    packed = _chat_packs(spark, sf)
    return packed.select("bucket", "pack_no", *(_csv(F.col(c)).alias(c) for c in (
        "input_ids", "labels", "segment_ids", "position_ids", "loss_mask")))


_PADDED_SQL = f"({C.BATCH_REMAINDER} - b.longest % {C.BATCH_DIVISOR} + {C.BATCH_DIVISOR}) % {C.BATCH_DIVISOR} + b.longest"


@register("padded_batches", _IDS_SQL + f"""
, o AS (SELECT lb.*, row_number() OVER (ORDER BY sha256('{C.SHUFFLE_SEED}:' || CAST(conv_id AS VARCHAR))) - 1 AS rank FROM lb),
k AS (SELECT *, rank // {BATCH_SIZE} AS batch FROM o
      WHERE rank // {BATCH_SIZE} < (SELECT count(*) FROM o) // {BATCH_SIZE}),
b AS (SELECT batch, max(len(tids)) AS longest FROM k GROUP BY batch)
SELECT CAST(k.batch AS BIGINT) AS batch, k.conv_id, CAST(len(k.tids) AS INTEGER) AS n_ids,
       CAST({_PADDED_SQL} AS INTEGER) AS padded_len,
       array_to_string(k.tids || list_transform(range({_PADDED_SQL} - len(k.tids)), lambda x: {C.PAD_ID}), ',') AS input_ids,
       array_to_string(k.labels || list_transform(range({_PADDED_SQL} - len(k.labels)), lambda x: {C.IGNORE_ID}), ',') AS labels,
       array_to_string(list_transform(k.tids, lambda x: 1)
                       || list_transform(range({_PADDED_SQL} - len(k.tids)), lambda x: 0), ',') AS attention_mask
FROM k JOIN b USING (batch)
""")
def q_padded_batches(spark, sf):
    """Batches of chats in the seeded order, their arrays padded to each batch's length."""
    from millrace.operators.feed import batches, padded_batches, seeded_rank
    from millrace.operators.labels import build_labels
    lab = build_labels(_chat_ids(spark, sf), limit=TRUNC_LIMIT).select("conv_id", "input_ids", "labels")
    rows = batches(seeded_rank(lab.withColumn("n_ids", F.size("input_ids")), "conv_id"), BATCH_SIZE, 1)
    return padded_batches(rows).select("batch", "conv_id", "n_ids", "padded_len", *(
        _csv(F.col(c)).alias(c) for c in ("input_ids", "labels", "attention_mask")))


@register("chat_unknown_roles", """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages,
       CAST(count(*) FILTER (WHERE role IS NULL OR role NOT IN ('system', 'user', 'assistant', 'tool')) AS INTEGER) AS n_unknown
FROM conversations GROUP BY conv_id
""")
def q_chat_unknown_roles(spark, sf):
    from millrace.functions.chat import unknown_role_count
    from millrace.sources.chats import assemble_chats
    chats = assemble_chats(table(spark, sf, "conversations"))
    return chats.select("conv_id", F.size("messages").alias("n_messages"),
                        unknown_role_count("messages").alias("n_unknown"))


# ---------------------------------------------------------------------------
# tool chats derived from the conversations: every second user turn is a tool
# result, every assistant turn calls a tool (once plainly, once wrapped)
# ---------------------------------------------------------------------------

TOOL_JSON = '{"type":"function","function":{"name":"look","x":null}}'
TOOL_TEXT = '{"type": "function", "function": {"name": "look", "x": null}}'

_TOOLS_HEAD_SQL = sql_str(C.TOOLS_HEADER + "\n" + TOOL_TEXT + C.TOOLS_FOOTER)
_TOOL_CHAT_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(text, '') AS content,
         CASE WHEN role = 'user' AND turn % 4 <> 0 THEN 'tool' ELSE role END AS role FROM conversations),
n AS (SELECT *, lag(role) OVER w AS prev, lead(role) OVER w AS next FROM m
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (
  SELECT conv_id, turn, CASE
    WHEN role = 'user' OR (role = 'system' AND turn > 0) THEN '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10)
    WHEN role = 'assistant' THEN '<|im_start|>assistant' || CASE WHEN content <> '' THEN chr(10) || content ELSE '' END
      || chr(10) || '<tool_call>' || chr(10) || '{{"name": "look", "arguments": {{"turn": ' || turn || ', "also": null}}}}' || chr(10) || '</tool_call>'
      || chr(10) || '<tool_call>' || chr(10) || '{{"name": "see", "arguments": {{"list": [1, ' || turn || ']}}}}' || chr(10) || '</tool_call>'
      || '<|im_end|>' || chr(10)
    WHEN role = 'tool' THEN CASE WHEN prev IS NULL OR prev <> 'tool' THEN '<|im_start|>user' ELSE '' END
      || chr(10) || '<tool_response>' || chr(10) || content || chr(10) || '</tool_response>'
      || CASE WHEN next IS NULL OR next <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END
    ELSE '' END AS piece
  FROM n),
h AS (
  SELECT conv_id, '<|im_start|>system' || chr(10) || coalesce(max(CASE WHEN turn = 0 AND role = 'system' THEN content END),
         {sql_str(C.CHAT_DEFAULT_SYSTEM_CONFIG)}) || {_TOOLS_HEAD_SQL} AS head FROM m GROUP BY conv_id)
SELECT conv_id, head || string_agg(piece, '' ORDER BY turn) AS rendered FROM p JOIN h USING (conv_id) GROUP BY conv_id, head
"""


@register("tool_chats", _TOOL_CHAT_SQL)
def q_tool_chats(spark, sf):
    """Chats with tools, tool runs and tool calls (also wrapped ones), in the template's JSON."""
    from millrace.functions.chat import render_chat, template_json, with_template_arguments
    conv = table(spark, sf, "conversations")
    turn = F.col("turn").cast("string")
    call = "array<struct<name:string,arguments:string,function:struct<name:string,arguments:string>>>"
    calls = F.array(
        F.struct(F.lit("look").alias("name"), F.concat(F.lit('{"turn":'), turn, F.lit(',"also":null}')).alias("arguments"),
                 F.lit(None).cast("struct<name:string,arguments:string>").alias("function")),
        F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
                 F.struct(F.lit("see").alias("name"), F.concat(F.lit('{"list":[1,'), turn, F.lit("]}")).alias("arguments"))
                 .alias("function")))
    role = F.when((F.col("role") == "user") & (F.col("turn") % 4 != 0), "tool").otherwise(F.col("role"))
    msg = F.struct(F.col("turn"), role.alias("role"), F.col("text").alias("content"),
                   F.when(F.col("role") == "assistant", calls).otherwise(F.lit(None).cast(call)).alias("tool_calls"))
    chats = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(msg)).alias("messages"))
    chats = with_template_arguments(chats.withColumn("tools", F.array(F.lit(TOOL_JSON))))
    return chats.withColumn("tools", template_json(chats, "tools")).select("conv_id", render_chat(
        "messages", default_system=C.CHAT_DEFAULT_SYSTEM_CONFIG, tools="tools", with_tool_calls=True,
        wrapped_calls=True).alias("rendered"))


# ---------------------------------------------------------------------------
# the record preparation on rows that have tags, math sources and odd roles
# ---------------------------------------------------------------------------

@register("record_rules", f"""
SELECT conv_id, turn,
       replace(replace('<think>' || text || '</answer><think>', '<think>', '<think>' || chr(10)), '</answer>', chr(10) || '</answer>')
         || '<|im_end|>' AS output,
       {sql_str(C.SYSTEM_PROMPT)} || replace(CASE WHEN turn % 2 = 0 THEN {sql_str(C.USER_PROMPT_MATH)} ELSE {sql_str(C.USER_PROMPT)} END,
         '{{{{content}}}}', text) AS instruction, turn % 2 = 0 AS is_math
FROM conversations WHERE text IS NOT NULL
""")
def q_record_rules(spark, sf):
    """Tag repair, prompt choice by source path, end of turn and the math flag (P4, P6, P7, P8, P11)."""
    from millrace.functions.text import is_math, repair_tags
    from millrace.plans.prepare import instruct_records
    conv = table(spark, sf, "conversations")
    path = F.when(F.col("turn") % 2 == 0, "/data/math_a.jsonl").otherwise("/data/code.jsonl")
    pairs = conv.select("conv_id", "turn", path.alias("source_path"), F.col("text").alias("question"),
                        F.concat(F.lit("<think>"), "text", F.lit("</answer><think>")).alias("answer"))
    ok, _ = instruct_records(pairs, path_col="source_path")
    return ok.select("conv_id", "turn", "output", "instruction", is_math("instruction").alias("is_math"))


# ---------------------------------------------------------------------------
# files: chats as JSON lines, the benchmark as one JSON object
# ---------------------------------------------------------------------------

#: Small splits, so that lines are cut by splits on the test tables too.
LINE_SPLIT_BYTES = 1 << 16


@register("jsonl_chats", """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_turns, list(text ORDER BY turn)[1] AS question,
       list(text ORDER BY turn)[2] AS answer,
       md5(string_agg(coalesce(role, '') || chr(31) || coalesce(text, ''), chr(30) ORDER BY turn)) AS chat_md5,
       true AS own_place
FROM conversations GROUP BY conv_id
""")
def q_jsonl_chats(spark, sf):
    """All chats through JSON lines: written, read by byte ranges, each record at an offset of its own."""
    from pyspark.sql import types as T

    from millrace.functions.text import answer_of, question_of
    from millrace.session import checkpoint_path
    from millrace.sources.chats import CHAT_SCHEMA, assemble_chats, read_chat_jsonl
    conv = table(spark, sf, "conversations")
    turns = F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value")))
    path = checkpoint_path(spark, "chats-jsonl")
    assemble_chats(conv).select("conv_id", turns.alias("conversations")).write.json(path)
    schema = T.StructType([conv.schema["conv_id"], *CHAT_SCHEMA.fields])
    chats = read_chat_jsonl(spark, path, schema, LINE_SPLIT_BYTES)
    places = chats.groupBy("source_pos").agg(F.count(F.lit(1)).alias("n_here"))
    whole = F.array_join(F.transform("conversations", lambda t: F.concat(
        F.coalesce(t["from"], F.lit("")), F.lit("\x1f"), F.coalesce(t["value"], F.lit("")))), "\x1e")
    return chats.join(places, "source_pos").select(
        "conv_id", F.size("conversations").alias("n_turns"), question_of().alias("question"),
        answer_of().alias("answer"), F.md5(whole).alias("chat_md5"),
        ((F.col("n_here") == 1) & F.col("_corrupt_record").isNull()).alias("own_place"))


@register("benchmark_map", """
SELECT CAST(item_id AS VARCHAR) AS item_id, text, substr(sha256(text), 1, 16) AS question_id
FROM benchmark WHERE item_id IS NOT NULL
""")
def q_benchmark_map(spark, sf):
    """The benchmark through a JSON object file ``{id: text}`` (one object: the benchmark is the bounded side)."""
    from millrace.functions.text import content_id
    from millrace.session import checkpoint_path
    from millrace.sources.chats import benchmark_from_map
    items = table(spark, sf, "benchmark").filter("item_id IS NOT NULL")
    path = checkpoint_path(spark, "benchmark-map")
    items.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("item_id").cast("string"), "text"))))
              .alias("value")).write.text(path)
    return benchmark_from_map(spark, path).select("item_id", "text", content_id(F.col("text")).alias("question_id"))

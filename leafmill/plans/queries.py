"""Queries of the document and card operators over the driver's tables, and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cards as C
from ..operators import chunks as K
from ..operators import contracts as R
from ..operators import documents as D
from ..operators import figures as G
from ..operators import gates as V

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as blocks: a block for each line, the first one a section header."""
    rows = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.posexplode(F.split("text", "\n", -1)).alias("block", "content"))
    head = F.col("block") == 0
    return rows.select("document_id", F.lit(0).alias("page"), "block", F.concat(F.lit("b"), F.col("block").cast("string")).alias("id"), F.when(head, "section_header").otherwise("text").alias("block_type"), "content", F.when(head, F.array().cast("array<string>")).otherwise(F.array(F.lit("b0"), F.lit("b9999"))).alias("parent_hierarchy"), F.lit("b0").alias("section_id"), F.lit(False).alias("is_figure_caption"))


_BLOCKS = r"""
    lines AS (SELECT doc_id AS document_id, unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS block FROM documents),
    heads AS (SELECT document_id, content AS label FROM lines WHERE block = 0 AND content <> ''),
    crumbs AS (SELECT l.document_id, l.block, l.content, '[Context: ' || coalesce(h.label, 'Document Root') || ']' AS breadcrumb_text FROM lines l LEFT JOIN heads h USING (document_id)
               WHERE l.block > 0 AND trim(l.content, ' ' || chr(9)) <> '')"""


def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as linked chunks: a chunk for each turn, a section for each ten conversations' role."""
    rows = _t(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    crumb = F.lit("[Context: Document Root]")
    whole = F.concat(crumb, F.lit("\n\n"), text)
    out = rows.select(F.floor(F.col("conv_id") / 10).alias("document_id"), F.col("conv_id").alias("page"), F.col("turn").alias("block"), F.lit(0).alias("part"), F.col("conv_id").cast("string").alias("section_id"), text.alias("content"), crumb.alias("breadcrumb_text"), whole.alias("content_with_context"), T.tokens(whole).alias("token_count"), (F.col("turn") % 7 == 6).alias("is_figure_caption"), F.lit(0).alias("overlap_tokens"))
    return K.link(out)


_CHUNKS = r"""
    base AS (SELECT conv_id // 10 AS document_id, conv_id AS page, turn AS block, conv_id::VARCHAR AS section_id, coalesce(text, '') AS content, turn % 7 = 6 AS is_figure_caption FROM conversations),
    tok AS (SELECT *, ceil((length(content) + 26) / 4.0)::BIGINT AS token_count FROM base),
    chunks AS (SELECT *, row_number() OVER w - 1 AS sequence_number, document_id || '-chunk-' || lpad((row_number() OVER w - 1)::VARCHAR, 4, '0') AS chunk_id
               FROM tok WINDOW w AS (PARTITION BY document_id ORDER BY page, block))"""

#: What the texts get in place of common letters: all seven ligatures, a quote, and a break before a tab and a dash.
_INJECTED = {"th": "\ufb01", "er": "\ufb00", "in": "\ufb02", "re": "\ufb03", "an": "\ufb04", "ch": "\ufb05", "st": "\ufb06", "on": "\u201c", " of": "\r\n\t\u2014"}
_chr = lambda x: " || ".join(f"chr({ord(c)})" for c in x)


def _nested(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {a}, {b})"
    return x


_INJECT = _nested("coalesce(text, '')", [(f"'{a}'", _chr(b)) for a, b in _INJECTED.items()])
_LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st"}
_plain = lambda x: _nested(x, [(_chr(a), f"'{b}'") for a, b in _LIGATURES.items()])
_N_LIGATURES = f"length(regexp_replace({_INJECT}, '[^' || {_chr('\ufb00')} || '-' || {_chr('\ufb06')} || ']', '', 'g'))::BIGINT"


def _injected() -> Column:
    text = F.coalesce("text", F.lit(""))
    for a, b in _INJECTED.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


@_query(f"SELECT doc_id, trim(regexp_replace(regexp_replace({_INJECT}, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), ' ' || chr(10) || chr(9)) AS value FROM documents")
def normalize_whitespace(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.whitespace(_injected()).alias("value"))


@_query(f"SELECT doc_id, replace(replace({_INJECT}, chr(8220), '\"'), chr(8212), '--') AS value FROM documents")
def normalize_punctuation(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.punctuation(_injected()).alias("value"))


@_query(f"SELECT doc_id, {_plain(_INJECT)} AS value, {_N_LIGATURES} AS n FROM documents")
def ligature_replace_count(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.ligatures(_injected()).alias("value"), T.ligature_count(_injected()).alias("n"))


@_query("SELECT doc_id, nfc_normalize(replace(coalesce(text, ''), 'e', 'e' || chr(769))) AS value FROM documents")
def nfc_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.nfc(F.replace(F.coalesce("text", F.lit("")), F.lit("e"), F.lit("é"))).alias("value"))


@_query(r"SELECT doc_id, regexp_replace(replace(coalesce(text, ''), 'tion', 'ti-' || chr(10) || 'on'), '([A-Za-z0-9_]+)-' || chr(10) || '([A-Za-z0-9_]+)', '\1\2', 'g') AS value FROM documents")
def rejoin_hyphenated(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.rejoin_hyphenated(F.replace(F.coalesce("text", F.lit("")), F.lit("tion"), F.lit("ti-\non"))).alias("value"))


_LINED = f"regexp_replace(nfc_normalize({_INJECT}), '\\r\\n?', chr(10), 'g')"
_JOINED = f"regexp_replace({_LINED}, '([A-Za-z0-9_]+)-' || chr(10) || '([A-Za-z0-9_]+)', '\\1\\2', 'g')"
_PLAIN = f"replace(replace({_plain(_JOINED)}, chr(8220), '\"'), chr(8212), '--')"


@_query(f"SELECT doc_id, trim(regexp_replace({_PLAIN}, '[ \\t]+', ' ', 'g'), ' ' || chr(10) || chr(9)) AS value, {_N_LIGATURES} AS before, (length({_PLAIN}) - length(translate({_PLAIN}, {_chr("".join(_LIGATURES))}, '')))::BIGINT AS after FROM documents")
def normalize_text(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.normalized(_injected()).alias("n")).select("doc_id", F.col("n.text").alias("value"), F.col("n.ligatures_before").alias("before"), F.col("n.ligatures_after").alias("after"))


@_query(r"SELECT page_id, trim(replace(replace(replace(replace(replace(regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g'), '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '\"'), '&amp;', '&'), chr(160), ' '), ' ' || chr(10) || chr(9) || chr(13)) AS value FROM pages".replace('\\"', '"'))
def strip_html(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", T.strip_html(F.col("html"), strict=True).alias("value"))


@_query("SELECT page_id, coalesce(try_cast(regexp_extract(html, '(?i)<h([1-6])[^>]*>', 1) AS INTEGER), 0) AS level FROM pages")
def heading_level(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", T.heading_level(F.col("html")).alias("level"))


@_query(r"SELECT page_id, unnest(regexp_extract_all(html, '(?s)<(?:h1|p|li)>(.*?)</(?:h1|p|li)>', 1)) AS body, unnest(range(len(regexp_extract_all(html, '(?s)<(?:h1|p|li)>(.*?)</(?:h1|p|li)>', 1))))::INTEGER AS block FROM pages")
def html_blocks(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit("(?s)<(?:h1|p|li)>(.*?)</(?:h1|p|li)>"), F.lit(1))).alias("block", "body"))


@_query("SELECT doc_id, ceil(length(coalesce(text, '')) / 4.0)::BIGINT AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("tokens"))


_WS = " || ".join(f"chr({ord(c)})" for c in T.WS_CHARS)
_WS_CLASS = "[" + "".join(rf"\x{{{ord(c):04X}}}" for c in T.WS_CHARS) + "]"


def _sentences(x: str) -> str:
    """SQL for the sentences of x, as a list."""
    for i, word in enumerate(T.PROTECTED):
        x = f"regexp_replace({x}, '{word.replace('.', chr(92) + '.')}', chr({0xFDD4}) || chr({0xFDD8 + i}), 'gi')"
    x = rf"regexp_replace({x}, '([0-9]+)\.([0-9]+)', '\1' || chr({0xFDD5}) || '\2', 'g')"
    x = rf"string_split(regexp_replace({x}, '([.!?]){_WS_CLASS}+([A-Z])', '\1' || chr({0xFDD6}) || '\2', 'g'), chr({0xFDD6}))"
    back = _nested("trim(s, ws)", [(f"chr({0xFDD4}) || chr({0xFDD8 + i})", f"'{word}'") for i, word in enumerate(T.PROTECTED)] + [(f"chr({0xFDD5})", "'.'")]).replace("ws", _WS)
    return f"list_filter(list_transform({x}, lambda s: {back}), lambda s: s <> '')"


_LAST = "array_to_string(list_slice(l, greatest(1, len(l) - 1), len(l)), ' ')"


@_query(f"SELECT doc_id, len(l)::INTEGER AS n, md5(array_to_string(l, chr(1))) AS digest FROM (SELECT doc_id, {_sentences("coalesce(text, '')")} AS l FROM documents)")
def sentence_split(spark, sf_dir):
    s = T.sentences(F.coalesce("text", F.lit("")))
    return _t(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "\u0001")).alias("digest"))


@_query(f"SELECT conv_id, turn, {_LAST} AS tail FROM (SELECT conv_id, turn, {_sentences("coalesce(text, '')")} AS l FROM conversations)")
def last_sentences(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(T.last_sentences(F.coalesce("text", F.lit(""))), " ").alias("tail"))


@_query(f"WITH {_BLOCKS} SELECT document_id, block::INTEGER AS block, breadcrumb_text FROM crumbs")
def breadcrumb(spark, sf_dir):
    return K.breadcrumbs(line_blocks(spark, sf_dir)).filter(K.processable()).select("document_id", "block", "breadcrumb_text")


@_query("SELECT doc_id AS document_id, 'b0' AS id, string_split(text, chr(10))[1] AS label FROM documents WHERE string_split(text, chr(10))[1] <> ''")
def header_index(spark, sf_dir):
    return K.header_index(line_blocks(spark, sf_dir))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: documents as linked chunks."""
    return K.link(K.split_blocks(K.breadcrumbs(line_blocks(spark, sf_dir))))


def _fold(name: str, rows: str, joins: str, glued: str, tokens: str) -> str:
    """SQL for one pass of a fold over the numbered rows of each island; the last state of each group stays. glued: the
    content of two rows p and r as one; tokens: its count."""
    key = "document_id, island"
    either = lambda one, two: f"CASE WHEN {joins} THEN {one} ELSE {two} END"
    return f"""
    {name}_steps AS (SELECT {key}, i, 1 AS g, content, tok, n, page, block, crumb FROM {rows} WHERE i = 1
      UNION ALL SELECT r.document_id, r.island, r.i, {either("p.g", "p.g + 1")}, {either(glued, "r.content")}, {either(tokens, "r.tok")}, {either("p.n + r.n", "r.n")}, {either("p.page", "r.page")}, {either("p.block", "r.block")}, r.crumb
      FROM {name}_steps p JOIN {rows} r ON p.document_id = r.document_id AND p.island = r.island AND r.i = p.i + 1),
    {name} AS (SELECT {key}, g AS i, content, tok, n, page, block, crumb FROM {name}_steps QUALIFY row_number() OVER (PARTITION BY {key}, g ORDER BY {name}_steps.i DESC) = 1)"""


def _folds(rows: str, glued: str, size: str) -> str:
    """Both passes; size: the length of p's or r's content."""
    tokens = f"ceil((p.crumb + 4 + {size.format('p')} + {size.format('r')}) / 4.0)::BIGINT"
    return _fold("one", rows, "r.tok < 80 AND p.tok + r.tok <= 512", glued, tokens) + "," + _fold("two", "one", "p.tok < 80 AND p.tok + r.tok <= 512", glued, tokens)


def _packed(items: str, oversize: str = "") -> str:
    """SQL for items joined by blanks up to the budget, as a list; oversize: what becomes of an item beyond it."""
    state = "{{'out': {}, 'held': {}, 'used': {}, 'item': ''}}"
    n = "ceil(length(x.item) / 4.0)::BIGINT"
    flushed = f"CASE WHEN a.held <> '' THEN list_append(a.out, trim(a.held, {_WS})) ELSE a.out END"
    beyond = f"WHEN {n} > budget THEN {state.format(f'list_concat({flushed}, {oversize})', chr(39) * 2, '0::BIGINT')}" if oversize else ""
    step = f"""CASE {beyond} WHEN a.held = '' THEN {state.format("a.out", "x.item", f"{n} + 1")} WHEN a.used + {n} + 1 > budget THEN {state.format(f"list_append(a.out, trim(a.held, {_WS}))", "x.item", f"{n} + 1")}
        ELSE {state.format("a.out", "a.held || ' ' || x.item", f"a.used + {n} + 1")} END"""
    none = "{'out': []::VARCHAR[], 'held': '', 'used': 0::BIGINT, 'item': ''}"
    each = none.replace("'item': ''", "'item': y")
    folded = f"list_reduce(list_prepend({none}, list_transform({items}, lambda y: {each})), lambda a, x: {step})"
    return f"list_transform([{folded}], lambda f: CASE WHEN trim(f.held, {_WS}) <> '' THEN list_append(f.out, trim(f.held, {_WS})) ELSE f.out END)[1]"


_WORDS = f"list_filter(regexp_split_to_array(x.item, '{_WS_CLASS}+'), lambda w: w <> '')"
_SPLIT = f"""{_BLOCKS},
    budgets AS (SELECT *, 512 - ceil((length(breadcrumb_text) + 2) / 4.0)::BIGINT AS budget FROM crumbs),
    split AS (SELECT document_id, block, breadcrumb_text, CASE WHEN ceil(length(content) / 4.0) <= budget THEN [content] ELSE {_packed(_sentences("content"), _packed(_WORDS).replace("x.item, '" + _WS_CLASS, "x.item, '" + _WS_CLASS))} END AS chunks FROM budgets),
    rows AS (SELECT document_id, block, breadcrumb_text, unnest(chunks) AS content, unnest(range(len(chunks))) AS part FROM split)"""


@_query(f"""WITH {_SPLIT}
    SELECT document_id || '-chunk-' || lpad((row_number() OVER (PARTITION BY document_id ORDER BY block, part) - 1)::VARCHAR, 4, '0') AS chunk_id, block::INTEGER AS block, part::INTEGER AS part,
           ceil((length(breadcrumb_text) + 2 + length(content)) / 4.0)::BIGINT AS token_count, length(content)::BIGINT AS character_count, md5(content) AS digest FROM rows""")
def split_blocks(spark, sf_dir):
    return document_chunks(spark, sf_dir).select("chunk_id", "block", "part", "token_count", "character_count", F.md5("content").alias("digest"))


@_query(f"""WITH RECURSIVE {_SPLIT},
    o AS (SELECT *, lag(content) OVER (PARTITION BY document_id ORDER BY block, part) AS before FROM rows),
    t AS (SELECT *, {_LAST} AS tail FROM (SELECT *, {_sentences("before")} AS l FROM o)),
    u AS (SELECT *, length(breadcrumb_text) AS crumb, trim(tail, {_WS}) <> '' AND ceil((length(breadcrumb_text) + 3 + length(tail) + length(content)) / 4.0) <= 600 AS fits FROM t),
    parts AS (SELECT document_id, 1 AS island, row_number() OVER (PARTITION BY document_id ORDER BY block, part) AS i, CASE WHEN fits THEN length(tail) + 1 ELSE 0 END + length(content) AS content,
      ceil((crumb + 2 + CASE WHEN fits THEN length(tail) + 1 ELSE 0 END + length(content)) / 4.0)::BIGINT AS tok, 1::BIGINT AS n, block AS page, part AS block, crumb FROM u),
    {_folds("parts", "p.content + 2 + r.content", "{}.content")}
    SELECT document_id, count(*) AS chunks, sum(tok)::BIGINT AS tokens, sum(n)::BIGINT AS blocks FROM two GROUP BY 1""")
def chunk_documents(spark, sf_dir):
    merged = K.merge_small(K.overlap(document_chunks(spark, sf_dir)))
    return K.link(merged).groupBy("document_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum("token_count").alias("tokens"), F.sum("n_blocks").alias("blocks"))


@_query(f"""WITH RECURSIVE {_CHUNKS},
    edges AS (SELECT *, coalesce(lag(section_id) OVER w <> section_id OR is_figure_caption OR lag(is_figure_caption) OVER w, true)::INTEGER AS edge FROM chunks WINDOW w AS (PARTITION BY document_id ORDER BY page, block)),
    islands AS (SELECT *, sum(edge) OVER (PARTITION BY document_id ORDER BY page, block) AS island FROM edges),
    parts AS (SELECT document_id, island, row_number() OVER (PARTITION BY document_id, island ORDER BY page, block) AS i, content, token_count AS tok, 1::BIGINT AS n, page, block, 24 AS crumb FROM islands),
    {_folds("parts", "p.content || chr(10) || chr(10) || r.content", "length({}.content)")}
    SELECT document_id || '-chunk-' || lpad((row_number() OVER (PARTITION BY document_id ORDER BY page, block) - 1)::VARCHAR, 4, '0') AS chunk_id, tok AS token_count, n AS n_blocks, md5(content) AS digest FROM two""")
def merge_small(spark, sf_dir):
    return K.link(K.merge_small(conversation_chunks(spark, sf_dir))).select("chunk_id", "token_count", "n_blocks", F.md5("content").alias("digest"))


@_query(f"WITH {_CHUNKS} SELECT chunk_id, lag(chunk_id) OVER w AS previous_chunk_id, lead(chunk_id) OVER w AS next_chunk_id FROM chunks WINDOW w AS (PARTITION BY document_id ORDER BY page, block)")
def chunk_link(spark, sf_dir):
    return conversation_chunks(spark, sf_dir).select("chunk_id", "previous_chunk_id", "next_chunk_id")


@_query(f"""WITH {_CHUNKS}, o AS (SELECT *, lag(content) OVER w AS before, lag(section_id) OVER w AS earlier FROM chunks WINDOW w AS (PARTITION BY document_id ORDER BY page, block)),
    s AS (SELECT *, {_sentences("before")} AS l FROM o), t AS (SELECT *, {_LAST} AS tail FROM s),
    u AS (SELECT *, coalesce(earlier = section_id AND NOT is_figure_caption AND trim(tail, {_WS}) <> '' AND ceil((27 + length(tail) + length(content)) / 4.0) <= 600, false) AS fits FROM t)
    SELECT chunk_id, CASE WHEN fits THEN ceil(length(tail) / 4.0) ELSE 0 END::BIGINT AS overlap_tokens, ceil((26 + CASE WHEN fits THEN length(tail) + 1 ELSE 0 END + length(content)) / 4.0)::BIGINT AS token_count,
           md5(CASE WHEN fits THEN tail || ' ' || content ELSE content END) AS digest FROM u""")
def chunk_overlap(spark, sf_dir):
    return K.overlap(conversation_chunks(spark, sf_dir)).select("chunk_id", "overlap_tokens", "token_count", F.md5("content").alias("digest"))


@_query(f"WITH {_CHUNKS} SELECT chunk_id, coalesce(lead(section_id) OVER w <> section_id, true) AS is_section_final FROM chunks WINDOW w AS (PARTITION BY document_id ORDER BY page, block)")
def section_final(spark, sf_dir):
    return K.section_final(conversation_chunks(spark, sf_dir)).select("chunk_id", "is_section_final")


@_query(f"WITH {_CHUNKS} SELECT document_id, section_id AS key, string_agg(chunk_id, ',' ORDER BY sequence_number) AS ids FROM chunks GROUP BY ALL")
def chunk_index_section(spark, sf_dir):
    return K.index_by(conversation_chunks(spark, sf_dir), "section_id").select("document_id", "key", F.array_join("chunk_ids", ",").alias("ids"))


@_query(f"WITH {_CHUNKS} SELECT document_id, page::VARCHAR AS key, string_agg(chunk_id, ',' ORDER BY sequence_number) AS ids FROM chunks GROUP BY ALL")
def chunk_index_page(spark, sf_dir):
    return K.index_by(conversation_chunks(spark, sf_dir), "page").select("document_id", "key", F.array_join("chunk_ids", ",").alias("ids"))


@_query(f"WITH {_CHUNKS} SELECT count(*) AS total_chunks, count(*) FILTER (is_figure_caption) AS figure_captions, max(token_count) AS max_tokens, floor(avg(token_count) + 0.5)::BIGINT AS avg_tokens, 0::BIGINT AS with_overlap FROM chunks")
def chunk_summary(spark, sf_dir):
    return K.summary(conversation_chunks(spark, sf_dir))


@_query(f"""WITH {_CHUNKS}, kept AS (SELECT * FROM chunks WHERE NOT (is_figure_caption AND page % 3 = 0)),
    f AS (SELECT *, coalesce(lead(section_id) OVER w <> section_id, true) AS final FROM kept WINDOW w AS (PARTITION BY document_id ORDER BY page, block)),
    b AS (SELECT count(*) FILTER (trim(content, ' ' || chr(9) || chr(10) || chr(13)) <> '') AS blocks, count(*) FILTER (is_figure_caption) AS wanted FROM chunks),
    s AS (SELECT floor(count(*) * 100.0::DOUBLE / nullif(any_value(blocks), 0) + 0.5) AS coverage, max(token_count)::DOUBLE AS most, count(*) FILTER (token_count < 80 AND NOT is_figure_caption AND NOT final) * 100.0::DOUBLE / count(*) AS small,
          count(*) FILTER (is_figure_caption) AS captions, any_value(wanted) AS wanted, count(*) FILTER (block % 5 = 0) AS bare FROM f CROSS JOIN b)
    SELECT 'content_coverage' AS gate, coverage AS value, coverage >= 100 AS passed FROM s UNION ALL SELECT 'max_token_limit', most, most <= 600 FROM s UNION ALL SELECT 'min_token_check', small, small < 1 FROM s
    UNION ALL SELECT 'breadcrumb_coverage', bare::DOUBLE, bare = 0 FROM s UNION ALL SELECT 'figure_captions', captions::DOUBLE, captions >= wanted FROM s UNION ALL SELECT 'schema_validation', 1, true FROM s""")
def chunk_gates(spark, sf_dir):
    """Some captions are missing from the chunks, and some chunks have no breadcrumb."""
    whole = conversation_chunks(spark, sf_dir)
    source = whole.withColumn("block_type", F.when(F.col("is_figure_caption"), "figure_caption").otherwise("text"))
    chunks = whole.filter("NOT (is_figure_caption AND page % 3 = 0)").withColumn("breadcrumb", F.when(F.col("block") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("r"))))
    return K.gates(chunks, source).select("gate", "value", "passed")


@_query(f"WITH {_CHUNKS} SELECT chunk_id, concat_ws(',', CASE WHEN content = '' THEN 'content' END, CASE WHEN token_count NOT BETWEEN 1 AND 600 THEN 'token_count' END) AS broken FROM chunks")
def contract_violations(spark, sf_dir):
    return K.violations(conversation_chunks(spark, sf_dir)).select("chunk_id", F.array_join("violations", ",").alias("broken"))


@_query(f"WITH {_CHUNKS} SELECT chunk_id FROM chunks WHERE contains(lower(content), 'that') AND NOT is_figure_caption")
def preview_filter(spark, sf_dir):
    return conversation_chunks(spark, sf_dir).filter(F.contains(F.lower("content"), F.lit("that")) & ~F.col("is_figure_caption")).select("chunk_id")


def figure_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as blocks: a caption for each part key divisible by 3, text that cites figures for the rest."""
    k = F.col("p_partkey")
    label = lambda n: F.concat((n % 9 + 1).cast("string"), F.lit("."), (n % 20 + 1).cast("string"))
    caption = F.concat(F.when(k % 2 == 0, F.concat(F.lit("![]("), k.cast("string"), F.lit(".png) "))).otherwise(""), F.lit("FIGURE "), label(k), F.lit(". "), F.col("p_name"))
    text = F.concat(F.lit("See Fig. "), label(3 * k), F.lit(" for the "), F.col("p_name"))
    return _t(spark, sf_dir, "part").select(F.floor(k / 100).alias("document_id"), F.lit(0).alias("page"), k.alias("block"), k.cast("string").alias("id"), F.when(k % 3 == 0, "figure_caption").otherwise("text").alias("block_type"), F.when(k % 3 == 0, caption).otherwise(text).alias("content"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 100).alias("document_id"), (F.col("p_partkey") % 100 + 1).alias("position"), F.concat(F.lit("img"), (F.col("p_partkey") % 100).cast("string"), F.lit(".jpg")).alias("image_file")).filter("position <= 10")


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.figure_map(figure_blocks(spark, sf_dir), _images(spark, sf_dir))


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """figure_blocks with some texts lost, and ligatures in others."""
    k = F.col("block")
    text = F.concat(T.ligatures(F.col("content")), F.when(k % 30 == 0, "\ufb01").otherwise(""))
    return figure_blocks(spark, sf_dir).select("document_id", F.col("id").alias("source_id"), F.when(k % 40 != 0, text).alias("content"))


_FIGURES = """
    c AS (SELECT p_partkey // 100 AS document_id, p_partkey AS k, 'Fig. ' || (p_partkey % 9 + 1) || '.' || (p_partkey % 20 + 1) AS figure_id,
          CASE WHEN p_partkey % 2 = 0 THEN 'FIGURE ' || (p_partkey % 9 + 1) || '.' || (p_partkey % 20 + 1) || '. ' ELSE '' END || p_name AS caption, p_partkey % 9 + 1 AS chapter FROM part WHERE p_partkey % 3 = 0),
    i AS (SELECT p_partkey // 100 AS document_id, p_partkey % 100 + 1 AS position, 'img' || (p_partkey % 100) || '.jpg' AS image_file FROM part WHERE p_partkey % 100 < 10),
    r AS (SELECT *, sum(CASE WHEN k % 2 = 1 THEN 1 ELSE 0 END) OVER w AS rank, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY document_id ORDER BY chapter, k)),
    m AS (SELECT r.document_id, figure_id, k::VARCHAR AS caption_block_id, caption, CASE WHEN k % 2 = 0 THEN k || '.png' ELSE image_file END AS image_file,
                 row_number() OVER (PARTITION BY r.document_id, figure_id ORDER BY n DESC) AS last FROM r LEFT JOIN i ON r.document_id = i.document_id AND rank = position AND k % 2 = 1),
    figures AS (SELECT document_id, figure_id, caption_block_id, caption, image_file, CASE WHEN image_file IS NULL THEN 'no-image-in-caption' ELSE 'mapped' END AS status FROM m WHERE last = 1)"""


@_query(f"WITH {_FIGURES} SELECT * FROM figures")
def figure_map(spark, sf_dir):
    return _figures(spark, sf_dir).select("document_id", "figure_id", "caption_block_id", "caption", "image_file", "status")


@_query(f"WITH {_FIGURES} SELECT count(*) AS total_figures, count(*) FILTER (status = 'mapped') AS mapped_figures, count(*) FILTER (status <> 'mapped') AS unmapped_figures, count(*) FILTER (status = 'mapped') * 100.0::DOUBLE / count(*) AS coverage_percentage, count(*) FILTER (status = 'no-image-in-caption') AS without_image, count(*) FILTER (status = 'unresolved') AS unresolved FROM figures")
def figure_summary(spark, sf_dir):
    got = G.summary(_figures(spark, sf_dir))
    return got.select("total_figures", F.col("mapped_count").alias("mapped_figures"), F.col("unmapped_count").alias("unmapped_figures"), "coverage_percentage", F.col("by_status.`no-image-in-caption`").alias("without_image"), F.col("by_status.unresolved").alias("unresolved"))


@_query(f"""WITH {_FIGURES}, t AS (SELECT p_partkey // 100 AS document_id, p_partkey AS k, 'Fig. ' || (3 * p_partkey % 9 + 1) || '.' || (3 * p_partkey % 20 + 1) AS figure_id FROM part WHERE p_partkey % 3 <> 0)
    SELECT document_id, figure_id, string_agg(k::VARCHAR, ',' ORDER BY k) AS blocks FROM t JOIN figures USING (document_id, figure_id) GROUP BY ALL""")
def figure_link(spark, sf_dir):
    found = G.references(figure_blocks(spark, sf_dir), _figures(spark, sf_dir))
    return found.select("document_id", "figure_id", F.array_join("referencing_blocks", ",").alias("blocks"))


@_query(f"""WITH {_FIGURES}, t AS (SELECT p_partkey // 100 AS document_id, p_partkey AS k, 'Fig. ' || (3 * p_partkey % 9 + 1) || '.' || (3 * p_partkey % 20 + 1) AS figure_id FROM part WHERE p_partkey % 3 <> 0),
    x AS (SELECT document_id, figure_id, string_agg(k::VARCHAR, ',' ORDER BY k) AS blocks FROM t GROUP BY ALL)
    SELECT document_id, figure_id, 0 AS page_number, 'img/' || image_file AS image_path, coalesce(blocks, '') AS blocks, 0 AS n_abbreviations FROM figures LEFT JOIN x USING (document_id, figure_id)""")
def figure_entries(spark, sf_dir):
    found = G.entries(figure_blocks(spark, sf_dir), _images(spark, sf_dir), "img")
    return found.select("document_id", "figure_id", "page_number", "image_path", F.array_join("referencing_blocks", ",").alias("blocks"), F.size("abbreviations").alias("n_abbreviations"))


@_query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Ant.=' || lower(p_name) || ';P.=vein' WHEN 2 THEN 'V.=vein' ELSE '' END AS found FROM (SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z ]', '', 'g') AS p_name FROM part)""")
def abbreviations(spark, sf_dir):
    """Of captions that end in an abbreviation line, in two of them, in text, or have one in the middle."""
    k, name = F.col("p_partkey"), F.regexp_replace("p_name", "[^A-Za-z ]", "")
    tail = F.when(k % 4 == 0, "Nothing here.").when(k % 4 == 1, F.concat(F.lit("Ant., "), F.lower(name), F.lit(";\nP., vein."))).when(k % 4 == 2, "\nV., vein.\n ").otherwise("A., artery; V., vein.\nEnd of caption")
    found = T.caption_abbreviations(F.concat(F.lit("FIGURE 1.1. "), "p_name", F.lit("\n"), tail))
    return _t(spark, sf_dir, "part").select(k, F.array_join(F.transform(F.array_sort(F.map_entries(found)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("found"))


@_query("""SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 7 = 0 THEN 'id' END, CASE WHEN p_partkey % 5 = 0 THEN 'block_type' END, CASE WHEN p_partkey % 8 = 7 THEN 'level' END, CASE WHEN p_partkey % 11 = 0 THEN 'content' END, CASE WHEN p_partkey % 6 = 0 THEN 'bbox' END) AS broken FROM part""")
def block_contract(spark, sf_dir):
    k, none = F.col("p_partkey"), F.array().cast("array<string>")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("image", *R.BLOCK_TYPES[:4])]), (k % 5 + 1).cast("int"))
    box = F.struct((k % 6 - 1).cast("double").alias("x1"), *[F.lit(1.0).alias(c) for c in ("y1", "x2", "y2")])
    rows = _t(spark, sf_dir, "part").select(k, F.when(k % 7 != 0, F.concat(F.lit("/page/0/Text/"), k.cast("string"))).otherwise("text").alias("id"), kind.alias("block_type"), (k % 8).alias("level"), F.when(k % 11 != 0, F.col("p_name")).alias("content"), F.lit("").alias("raw_html"), none.alias("parent_hierarchy"), none.alias("figure_references"), box.alias("bbox"), F.lit("").alias("section_id"))
    return R.violations(rows, R.BLOCK).select("p_partkey", F.array_join("violations", ",").alias("broken"))


@_query("""SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 7 = 0 THEN 'figure_id' END, CASE WHEN p_partkey % 9 = 0 THEN 'page_number' END, CASE WHEN p_partkey % 11 = 0 THEN 'caption' END, CASE WHEN p_partkey % 4 = 3 THEN 'status' END, CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 = 0 THEN 'image_file' END) AS broken FROM part""")
def figure_contract(spark, sf_dir):
    k = F.col("p_partkey")
    status = F.element_at(F.array(*[F.lit(x) for x in (*R.STATUSES, "lost")]), (k % 4 + 1).cast("int"))
    rows = _t(spark, sf_dir, "part").select(k, F.when(k % 7 != 0, F.concat(F.lit("Fig. 1."), k.cast("string"))).otherwise("Figure 1").alias("figure_id"), F.when(k % 9 == 0, -1).otherwise(3).alias("page_number"), F.when(k % 11 != 0, F.col("p_name")).otherwise("").alias("caption"), F.create_map().cast("map<string,string>").alias("abbreviations"), status.alias("status"), F.when(k % 3 != 0, "a.png").alias("image_file"))
    return R.violations(rows, R.FIGURE).select("p_partkey", F.array_join("violations", ",").alias("broken"))


@_query(f"""WITH {_FIGURES}, shares AS (SELECT document_id, count(*) FILTER (status = 'mapped') * 100.0::DOUBLE / count(*) AS share FROM figures GROUP BY 1), pictures AS (SELECT document_id, count(*) AS n FROM i GROUP BY 1),
    docs AS (SELECT p_partkey // 100 AS document_id, count(*) AS source_json_lines, count(*) FILTER (p_partkey % 40 <> 0) * 100.0::DOUBLE / count(*) AS parse_rate, count(*) FILTER (p_partkey % 30 = 0 AND p_partkey % 40 <> 0) AS ligature_count FROM part GROUP BY 1)
    SELECT document_id, source_json_lines, 7::BIGINT AS source_markdown_lines, coalesce(n, 0) AS total_images, parse_rate, ligature_count, coalesce(share, 0) AS figure_coverage,
           concat_ws(',', CASE WHEN document_id % 2 = 0 THEN 'id' END, CASE WHEN document_id % 3 = 0 THEN 'author' END) AS broken FROM docs LEFT JOIN shares USING (document_id) LEFT JOIN pictures USING (document_id)""")
def document_contract(spark, sf_dir):
    """Assembled documents, their metadata, and what they break."""
    blocks, figures = _flawed(spark, sf_dir), G.entries(figure_blocks(spark, sf_dir), _images(spark, sf_dir), "img")
    k = F.col("document_id")
    files = F.struct(F.lit("a.json").alias("json"), F.lit("a.md").alias("markdown"), F.lit("img").alias("image_dir"))
    described = blocks.select("document_id").distinct().select("document_id", F.concat(F.when(k % 2 == 0, "Doc ").otherwise("doc-"), k.cast("string")).alias("id"), F.lit("T").alias("title"), F.when(k % 3 == 0, "").otherwise("A").alias("author"), files.alias("source_files"), F.array(F.lit(1)).alias("pages"))
    whole = D.details(described, figures, D.metadata(blocks, figures, _images(spark, sf_dir), F.lit(7)))
    return R.violations(whole, R.DOCUMENT).select("document_id", *[f"metadata.{c}" for c in ("source_json_lines", "source_markdown_lines", "total_images", "parse_rate", "ligature_count", "figure_coverage")], F.array_join("violations", ",").alias("broken"))


def figure_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """figure_blocks as linked chunks with their figures."""
    chunks = figure_blocks(spark, sf_dir).withColumns({"part": F.lit(0), "is_figure_caption": F.col("block_type") == "figure_caption"})
    return G.attach(K.link(chunks), _figures(spark, sf_dir))


_ATTACHED = f"""{_FIGURES},
    b AS (SELECT p_partkey // 100 AS document_id, p_partkey AS block, p_partkey % 3 = 0 AS cap, 'Fig. ' || (3 * p_partkey % 9 + 1) || '.' || (3 * p_partkey % 20 + 1) AS cites,
          row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) - 1 AS seq FROM part),
    attached AS (SELECT b.document_id, b.block, b.document_id || '-chunk-' || lpad(seq::VARCHAR, 4, '0') AS chunk_id, f.figure_id, f.image_file, f.caption
                 FROM b LEFT JOIN figures f ON b.document_id = f.document_id AND CASE WHEN cap THEN f.caption_block_id = b.block::VARCHAR ELSE f.figure_id = cites END)"""


@_query(f"WITH {_ATTACHED} SELECT chunk_id, CASE WHEN figure_id IS NULL THEN '' ELSE figure_id || '|' || coalesce(image_file, '') || '|' || caption END AS refs FROM attached")
def figure_attach(spark, sf_dir):
    one = lambda r: F.concat_ws("|", r["figure_id"], r["image_path"], r["caption_snippet"])
    return figure_chunks(spark, sf_dir).select("chunk_id", F.array_join(F.transform("figure_references", one), ";").alias("refs"))


@_query(f"WITH {_ATTACHED} SELECT document_id, figure_id AS key, string_agg(chunk_id, ',' ORDER BY block) AS ids FROM attached WHERE figure_id IS NOT NULL GROUP BY ALL")
def chunk_index_figure(spark, sf_dir):
    chunks = figure_chunks(spark, sf_dir).withColumn("figures", F.transform("figure_references", lambda r: r["figure_id"]))
    return K.index_by(chunks, "figures").select("document_id", "key", F.array_join("chunk_ids", ",").alias("ids"))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.evaluate(V.measure(_flawed(spark, sf_dir), _figures(spark, sf_dir)))


_GATED = f"""{_FIGURES},
    shares AS (SELECT document_id, count(*) FILTER (status = 'mapped') * 100.0::DOUBLE / count(*) AS share FROM figures GROUP BY 1),
    docs AS (SELECT p_partkey // 100 AS document_id, count(*) FILTER (p_partkey % 40 <> 0) * 100.0::DOUBLE / count(*) AS rate, count(*) FILTER (p_partkey % 30 = 0 AND p_partkey % 40 <> 0) AS ligatures FROM part GROUP BY 1),
    gated AS (SELECT document_id, 'parse_rate' AS gate, floor(rate * 100 + 0.5) / 100 AS actual, CASE WHEN rate >= 100 THEN 'pass' ELSE 'fail' END AS status, 'Parse rate ' || printf('%.1f', rate) || CASE WHEN rate >= 100 THEN '% meets threshold' ELSE '% below 100% threshold' END AS details FROM docs
      UNION ALL SELECT document_id, 'ligature_count', ligatures::DOUBLE, CASE WHEN ligatures = 0 THEN 'pass' ELSE 'fail' END, CASE WHEN ligatures = 0 THEN 'No ligature characters found' ELSE 'Found ' || ligatures || ' ligature characters' END FROM docs
      UNION ALL SELECT document_id, 'figure_coverage', floor(coalesce(share, 0) * 10 + 0.5) / 10, CASE WHEN coalesce(share, 0) > 90 THEN 'pass' ELSE 'fail' END,
                       'Coverage ' || printf('%.1f', coalesce(share, 0)) || CASE WHEN coalesce(share, 0) > 90 THEN '% exceeds threshold' ELSE '% below 90% threshold' END FROM docs LEFT JOIN shares USING (document_id))"""


@_query(f"WITH {_GATED} SELECT * FROM gated")
def document_gates(spark, sf_dir):
    return _gated(spark, sf_dir).select("document_id", "gate", "actual", "status", "details")


@_query(f"WITH {_GATED} SELECT document_id, CASE WHEN bool_and(status = 'pass') THEN 'pass' ELSE 'fail' END AS overall_status, count(*) FILTER (status = 'fail')::INTEGER AS n_failures FROM gated GROUP BY 1")
def document_report(spark, sf_dir):
    return V.report(_gated(spark, sf_dir)).select("document_id", "overall_status", F.size("failures").alias("n_failures"))


@_query("SELECT p_partkey, array_to_string(list_transform(range(1, p_partkey % 4 + 2), lambda i: 'Fig. ' || (p_partkey % 9 + 1) || '.' || i), ',') AS refs FROM part")
def figure_range_expand(spark, sf_dir):
    k = F.col("p_partkey")
    chapter = (k % 9 + 1).cast("string")
    text = F.concat(F.lit("see Figs. "), chapter, F.lit(".1-"), chapter, F.lit("."), (k % 4 + 1).cast("string"), F.lit(" here"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(T.figure_references(text), ",").alias("refs"))


@_query("SELECT doc_id, CASE WHEN length(t) <= 100 THEN t WHEN contains(substr(t, 1, 100), ' ') THEN regexp_replace(substr(t, 1, 100), '(?s) [^ ]*$', '') || '...' ELSE substr(t, 1, 100) || '...' END AS snippet FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)")
def caption_snippet(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.snippet(F.coalesce("text", F.lit(""))).alias("snippet"))


def sample_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as flashcards."""
    k = F.col("p_partkey")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))
    return _t(spark, sf_dir, "part").select(k.alias("card"), F.concat(pick(QUESTIONS, k), F.col("p_name")).alias("question"), F.col("p_name").alias("answer"), pick(TAGS, F.floor(k / 3)).alias("tags"), pick(MNEMONICS, F.floor(k / 5)).alias("mnemonic"))


QUESTIONS = ("Caso: ", "Verdadeiro ou falso: ", "O que é ", "Qual a diferença: ", "ABC = ___ ", "Em ___% dos casos ", "A estrutura ")
TAGS = ("clinico,vascular", "abreviacoes", "atomizado, lista", "cirurgico-abordagem", "revisao-rapida", "fissura", "vascular-arterias,clinico", "geral")
MNEMONICS = ("", "A-B-C", "uma frase longa demais para dica", "x=y")
_list = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]"
_CARDS = f"cards AS (SELECT p_partkey AS card, ({_list(QUESTIONS)})[p_partkey % 7 + 1] || p_name AS question, p_name AS answer, ({_list(TAGS)})[(p_partkey // 3) % 8 + 1] AS tags, ({_list(MNEMONICS)})[(p_partkey // 5) % 4 + 1] AS mnemonic FROM part)"
_DIFF = """(CASE WHEN regexp_matches(lower(question), 'clinico|patologia|^caso:|verdadeiro ou falso|qual a diferença') OR regexp_matches(lower(tags), 'clinico|patologia') THEN 'D'
    WHEN contains(lower(tags), 'abreviacoes') OR contains(lower(question), 'abreviacoes') THEN 'E' WHEN contains(tags, 'cirurgico-abordagem') THEN 'D'
    WHEN contains(tags, 'revisao-rapida') OR contains(question, '%') THEN 'M' WHEN contains(tags, 'atomizado') THEN 'E' ELSE 'M' END)"""


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_cards(spark, sf_dir).withColumn("difficulty", C.difficulty(F.col("question"), F.col("tags")))


@_query(f"WITH {_CARDS} SELECT card, {_DIFF} AS difficulty FROM cards")
def classify_difficulty(spark, sf_dir):
    return _graded(spark, sf_dir).select("card", "difficulty")


def _hint_sql() -> str:
    """The rules of C.HINTS as SQL; several words that must all occur are tests of their own."""

    def met(column: str, pattern: str) -> list[str]:
        words = re.findall(r"\(\?=\.\*([^)]*)\)", pattern)
        return [f"contains({column}, '{w}')" for w in words] or [f"regexp_matches({column}, '(?s){pattern}')"] * bool(pattern)

    rules = "".join(f" WHEN {' AND '.join(met('lower(question)', q) + met('lower(tags)', t) + met('lower(answer)', a))} THEN '{text}'" for q, t, a, text in C.HINTS)
    return f"""CASE WHEN length(mnemonic) BETWEEN 3 AND 20 AND NOT contains(mnemonic, '=') THEN 'Lembre-se: ' || mnemonic{rules}
        WHEN contains(lower(tags), 'atomizado') AND contains(mnemonic, '-') THEN 'Sequência: ' || mnemonic WHEN contains(lower(tags), 'atomizado') THEN 'Pense na sequência completa' ELSE '{C.LAST_HINT}' END"""


@_query(f"WITH {_CARDS} SELECT card, CASE WHEN {_DIFF} = 'D' THEN {_hint_sql()} ELSE '' END AS hint FROM cards")
def generate_hint(spark, sf_dir):
    hint = C.hint(F.col("question"), F.col("answer"), F.col("tags"), F.col("mnemonic"))
    return _graded(spark, sf_dir).select("card", F.when(F.col("difficulty") == "D", hint).otherwise("").alias("hint"))


_PRESET = "CASE WHEN contains(tags, 'cirurgico-') THEN '3V-Surgical' WHEN contains(tags, 'clinico') THEN '3V-Clinical' WHEN contains(tags, 'vascular-') THEN '3V-Vascular' WHEN contains(tags, 'abreviacoes') THEN '3V-Reference' ELSE '3V-Core' END"


@_query(f"WITH {_CARDS} SELECT card, {_PRESET} AS preset FROM cards")
def preset_for_card(spark, sf_dir):
    return sample_cards(spark, sf_dir).select("card", C.preset(F.col("tags")).alias("preset"))


@_query(f"WITH {_CARDS}, d AS (SELECT {_DIFF} AS difficulty FROM cards) SELECT difficulty, count(*) AS n, floor(count(*) * 1000.0::DOUBLE / (SELECT count(*) FROM d) + 0.5) / 10 AS percent FROM d GROUP BY 1")
def difficulty_distribution(spark, sf_dir):
    return C.distribution(_graded(spark, sf_dir))


@_query(f"WITH {_CARDS}, d AS (SELECT {_DIFF} AS x FROM cards), p AS (SELECT {_PRESET} AS preset, count(*) AS n, min(card) AS first FROM cards GROUP BY 1) SELECT (SELECT preset FROM p ORDER BY n DESC, first LIMIT 1) AS preset, count(*) AS total, count(*) FILTER (x = 'E') AS n_e, count(*) FILTER (x = 'M') AS n_m, count(*) FILTER (x = 'D') AS n_d FROM d")
def deck_config(spark, sf_dir):
    return C.deck(_graded(spark, sf_dir), "card")


@_query(f"""WITH {_CARDS}, h AS (SELECT *, lower(substr(question, 1, 60)) AS q, {_DIFF} AS x FROM cards),
    k AS (SELECT contains(q, 'caso:') AS a, contains(tags, 'cirurgico-abordagem') AS b, contains(q, 'verdadeiro') AS c, contains(tags, 'vascular') AND contains(tags, 'clinico') AS d FROM h WHERE x = 'D')
    SELECT 'Casos clinicos' AS category, count(*) FILTER (a) AS n FROM k UNION ALL SELECT 'Abordagens', count(*) FILTER (b) FROM k UNION ALL SELECT 'V/F', count(*) FILTER (c) FROM k
    UNION ALL SELECT 'Vascular clinico', count(*) FILTER (d) FROM k UNION ALL SELECT 'Outros', count(*) FILTER (NOT (a OR b OR c OR d)) FROM k""")
def hint_categories(spark, sf_dir):
    return C.hint_categories(_graded(spark, sf_dir))


@_query(f"WITH {_CARDS} SELECT card, array_to_string([question, replace(answer, '\"', '&quot;'), array_to_string(list_transform(string_split(tags, ','), lambda t: '3V::' || trim(t)), ' '), mnemonic, {_DIFF}, ''], chr(9)) AS line FROM cards")
def import_tsv(spark, sf_dir):
    cards = _graded(spark, sf_dir).withColumn("hint", F.lit("")).filter(C.valid())
    return cards.select("card", C.import_line().alias("line"))


@_query("SELECT doc_id, CASE WHEN regexp_matches(text, '[,\"\\n]') THEN '\"' || replace(text, '\"', '\"\"') || '\"' ELSE text END AS field FROM documents")
def csv_field(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", C.csv_field(F.col("text")).alias("field"))

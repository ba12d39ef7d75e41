"""The registered queries of the numbered operators: whole tables in, the contracts' columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bitpack, chat, decontaminate, fim, fingerprint, jaccard, langid, mixing, packing, quality, ranked, suffixes, tokens,
               urlrules)
from .common import settle, table


def held_out(key: Column) -> Column:
    """The fold that op9 never learns from; a row without a key is in no fold."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op8_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    cut = suffixes.dedupe(table(spark, d, "documents").select("doc_id", "text"), as_text=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    judged = langid.predict(docs.select("doc_id", "text"), langid.fit(train))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


#: The rules that op10 judges by.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op10_url_filters(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    judged = urlrules.judge(pages, urlrules.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", "by_alias")


#: The conversation that op5 adds to the table.
PLANTED_TEXT = "\\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED_TEXT), (-7, 1, "assistant", PLANTED_TEXT)], turns.schema)
    back = chat.read_back(chat.format_chats(turns.unionByName(planted)))
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


#: Tokenizers, vocabulary sizes and end ids of op3 and op4.
FILE_TOKENIZER, FILE_VOCABULARY, FILE_END = "byte_bpe_50k.json", 50_257, 2
PACK_TOKENIZER, PACK_END, SEQUENCE = "word_bpe_49k.json", 1, 2048


def op3_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    bitpack.write_ids(table(spark, d, "documents").select("doc_id", "text"), path,
                      tokens.public_path(FILE_TOKENIZER), FILE_VOCABULARY, FILE_END)
    return bitpack.read_documents(bitpack.blocks(spark, path))


def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return packing.pack(docs, tokens.public_path(PACK_TOKENIZER), PACK_END, SEQUENCE)


def op6_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op1_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    docs = fingerprint.with_next(table(spark, d, "documents"), "doc_id", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    sides = {"own": "text", "edit": "edited", "next": "next_text"}
    rows = settle(docs.withColumn("edited", edited).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        *[fingerprint.paragraphs(F.col(c)).alias(n) for n, c in sides.items()], F.monotonically_increasing_id().alias("uid")), "texts")
    near = fingerprint.likeness(rows, "own", ["edit", "next"])
    dealt = rows.select("uid", "own", "edit", *[fingerprint.width(F.size(n)).alias(f"{n}_width") for n in ("own", "edit")]).repartition("uid")
    found = (fingerprint.elements(dealt, ["own", "edit"], ["uid", "own_width", "edit_width"])
             .withColumn("width", F.when(F.col("side") == 0, F.col("own_width")).otherwise(F.col("edit_width"))))
    prints = fingerprint.fingerprints(found, ["uid", "side"]).groupBy("uid").agg(
        *[F.max(F.when(F.col("side") == i, F.col("fingerprint"))).alias(n) for i, n in enumerate(("fingerprint", "edited_fingerprint"))])
    return rows.select("uid", "doc_id", "n_chars", "edited_sha256").join(near, "uid").join(prints, "uid", "left").select(
        "doc_id", "n_chars", "edited_sha256", *[F.coalesce(n, F.lit(fingerprint.EMPTY)).alias(n) for n in ("fingerprint", "edited_fingerprint")],
        F.col("near0").alias("near_edited"), F.col("near1").alias("near_next"))


def op2_quality(spark: SparkSession, d: str) -> DataFrame:
    """Documents have no url: their source stands for the host, their language for the path."""
    judged = quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))
    keep = (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)
    return judged.select("doc_id", "quality", "toxic", "quality_site", "toxic_site", keep.alias("keep"))


def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    made = fim.restore(fim.transform(table(spark, d, "documents").select("doc_id", "text")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.plan(table(spark, d, "documents")).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def op13_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES = {name: fn for name, fn in sorted(globals().items())
           if name.startswith("op") and callable(fn)}

#: Distinct five-word shingles of a text (its whole sequence with fewer words, none without words).
_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x20\\x09-\\x0D]+')")
_SHINGLES = """(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)"""

_HOST = "translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ", ".join(f"('{a}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for a, r in URL_RULES)
_LINK = r"""regexp_extract_all(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is')"""
_META = r"""regexp_extract_all(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is')"""
_TO = r"""regexp_extract(tag, '(?:href\s*=|url\s*=)\s*["'']?([^"''\s>]+)', 1, 'is')"""


def _place(source: str, columns: str) -> str:
    """SQL: host, path and node of the urls of ``source``."""
    return f"""(SELECT {columns}, coalesce({_HOST}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
      {_HOST} || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS node
    FROM (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM {source}))"""


ORACLES: dict[str, str] = {
    "op5_chat_format": """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + 15 + len(regexp_extract_all(role || text, '[\\\\<>]')) AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role, ' ' ORDER BY turn, role, text), '(system )?user assistant( user assistant)*') AS valid
FROM e GROUP BY conv_id""",
    "op8_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, length(h) // 2 - 49)) AS u(i)),
f AS (SELECT s, min(doc_id) AS f FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT doc_id, i, CASE WHEN i <= 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS fresh
  FROM w JOIN f USING (s) WHERE f < doc_id),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
p AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM p),
c AS (SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)""",
    "op10_url_filters": f"""
WITH RECURSIVE rules(action, rule, rule_host, rule_path) AS (VALUES {_RULES}),
p AS {_place('pages', 'page_id, url, html')},
link AS (SELECT node AS a, regexp_extract(url, '^(.*?)://', 1) AS scheme, host, {_TO} AS target
  FROM (SELECT *, unnest(list_concat({_LINK}, {_META})) AS tag FROM p WHERE node IS NOT NULL)),
target AS (SELECT a, CASE WHEN contains(target, '://') THEN target WHEN target LIKE '//%' THEN scheme || ':' || target
  WHEN target LIKE '/%' THEN scheme || '://' || host || target END AS url FROM link),
edge AS (SELECT a, node AS b FROM {_place('target', 'a')} WHERE node IS NOT NULL),
node AS (SELECT a AS node FROM edge UNION SELECT b FROM edge),
reach(node, other) AS (SELECT node, node FROM node UNION
  SELECT r.node, e.b FROM reach r JOIN (SELECT a, b FROM edge UNION SELECT b, a FROM edge) e ON e.a = r.other),
said AS (SELECT r.node, min(action) AS alias FROM reach r
  JOIN {_place("(SELECT node AS other, 'x://' || node AS url FROM node)", 'other')} o ON o.other = r.other
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    AND NOT EXISTS (SELECT 1 FROM rules z WHERE (o.host = z.rule_host OR ends_with(o.host, '.' || z.rule_host))
      AND starts_with(o.path, z.rule_path) AND length(z.rule) > length(rules.rule)) GROUP BY r.node),
best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM (SELECT DISTINCT host, path FROM p) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(action, alias, 'allow') AS verdict, action IS NULL AND alias IS NOT NULL AS by_alias
FROM p LEFT JOIN best USING (host, path) LEFT JOIN said USING (node)""",
    "op6_jaccard_join": f"""
WITH RECURSIVE s AS (SELECT doc_id, {_SHINGLES} AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
n AS (SELECT doc_id, len(s) AS n FROM s), u AS (SELECT doc_id, unnest(s) AS s FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM u x JOIN u y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 75 * (p.n + q.n - i)),
r(doc_id, o) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.o)
SELECT n.doc_id, n AS n_shingles, min(o) AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n""",
    "op7_decontamination": f"""
WITH d AS (SELECT doc_id, unnest({_SHINGLES}) AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
b AS (SELECT item_id, unnest({_SHINGLES}) AS s FROM (SELECT DISTINCT item_id, text, {_WORDS} AS w FROM benchmark)),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM p JOIN n USING (item_id) WHERE n_shared >= 0.75 * n_shingles""",
    "op11_fill_in_middle": f"""
WITH h AS (SELECT *, length(text) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
g AS (SELECT doc_id, text, n, {", ".join(f"('0x' || substr(s, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))} FROM h),
c AS (SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""",
    "op12_mixing": """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS hash FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
f AS (SELECT *, sum(size) OVER () AS total, sum(weight) OVER () AS every,
    coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0,
    coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0
  FROM w WINDOW o AS (ORDER BY size / weight, source NULLS LAST)),
j AS (SELECT *, 150 * total - 200 * s0 AS remaining, every - w0 AS rest FROM f),
k AS (SELECT *, 200 * size * rest <= weight * remaining AS stops FROM j),
g AS (SELECT max(remaining) AS l, max(rest) AS r FROM k WHERE NOT stops),
t AS (SELECT source, size AS source_size, CASE WHEN stops THEN (2 * size)::DOUBLE ELSE (weight * l)::DOUBLE / (100 * r)::DOUBLE END AS target
  FROM k CROSS JOIN g),
p AS (SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget, coalesce(sum(size) OVER (
    PARTITION BY d.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0
  ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken FROM p""",
    "op13_ranked_search": """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
n AS (SELECT doc_id, r, len(w) AS n FROM d WHERE len(w) > 0), c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
t AS (SELECT r, unnest(w) AS term FROM d), f AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
v AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term) CROSS JOIN c),
s AS (SELECT item_id, text, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN v USING (term) JOIN f USING (term) JOIN (SELECT r, n FROM n) USING (r) CROSS JOIN c GROUP BY item_id, text, r),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM s JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50""",
}

"""The queries op1_ ... op13_ of the driver contract, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.chat import CONTROL_STRINGS, Template, format_conversations, loss_text
from tidewright.llm.common import table
from tidewright.llm.decontaminate import decontaminate
from tidewright.llm.exact_dedup import exact_dedup
from tidewright.llm.language import identify_language
from tidewright.llm.line_dedup import line_dedup
from tidewright.llm.near_dedup import near_duplicates
from tidewright.llm.packing import pack_documents
from tidewright.llm.quality import classify_quality
from tidewright.llm.repair import repair, repaired_digests
from tidewright.llm.secret_scan import KINDS, find_secrets
from tidewright.llm.spelling import count_words, spelling_groups
from tidewright.llm.substring_dedup import substring_dedup
from tidewright.llm.url_filter import filter_urls

#: The rules of op10: host, path, action.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    counts = [c.cast("bigint").alias(n) for n, c in (("n_lines", F.col("n_lines")), ("n_removed", F.size("removed_lines")), ("n_links", F.col("n_links")))]
    return out.select("doc_id", *counts, F.array_join("removed_lines", ",").alias("removed_lines"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = format_conversations(rows.unionByName(more)).withColumn("_loss", loss_text())
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).withColumn("piece", F.col("piece").cast("int"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, threshold=80)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", F.transform("items", lambda x: x["item_id"]).alias("item_ids"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return filter_urls(table(spark, sf_dir, "pages"), rules).drop("component")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))
    names = F.array(*(F.lit(k) for k in KINDS))
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    found = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint")
    return out.select("doc_id", *[found(i).alias(f"n_{KINDS[i]}") for i in range(3)], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations of op12: by crc32(conv_id:turn) % 20 a row is dropped (0), emptied (1), loses its stops (2), stands twice (3), is a user's (4). Nulls are one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), h.alias("h")).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1)))).drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    reports, repaired = repair(damaged(rows))
    found = reports.join(repaired_digests(repaired).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    all_ids = rows.select(F.col("conv_id").alias("original")).distinct()
    out = all_ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("original").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def mistyped(doc_id: int | None) -> Callable[[str], str]:
    """What op13 makes of a document's words: without the code point h % length where 97 divides h, the crc32 of ``doc_id:word``."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), begun)
        if h % 97:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = count_words(table(spark, sf_dir, "documents"), change=mistyped)
    return spelling_groups(words.filter("char_length(word) >= 5 and n >= 3")).select("word", "form", "root", "n", "n_near", "form_n")


_NORM4 = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP4_SQL = f"""
WITH n AS (SELECT doc_id, sha256({_NORM4}) AS text_sha256, {_NORM4} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, text_sha256
FROM n"""


def _escaped_sql(column: str) -> str:
    """SQL for the text as Template() writes it: codes for "~", then for each control string from the longest on."""
    t = Template()
    codes, out = t.codes(), f"replace({column}, '~', '~0')"
    for control in sorted({*CONTROL_STRINGS, t.start, t.end}, key=lambda x: (-len(x), x)):
        out = f"replace({out}, '{control}', '{codes[control[0]]}{control[1:]}')"
    return out


OP5_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS listed,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
             sum({len(Template().start + Template().end) + 1} + length(role) + length({_escaped_sql("text")})) AS formatted_chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(listed) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g"""


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT win, min(doc_id) AS first FROM s GROUP BY win),
d AS (SELECT doc_id, i FROM s JOIN f USING (win) WHERE doc_id > first),
x AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
g AS (SELECT x.doc_id, x.i, x.word, max(d.i) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM x LEFT JOIN d ON d.doc_id = x.doc_id AND d.i = x.i),
r AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r ON r.doc_id = w.doc_id"""

OP2_SQL = r"""
WITH l AS (SELECT doc_id, generate_subscripts(x, 1) - 1 AS pos, unnest(x) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
k AS (SELECT * FROM (SELECT doc_id, pos, translate(lower(raw), chr(9) || chr(11) || chr(12) || chr(13), '    ') AS line FROM l) WHERE trim(line) <> ''),
s AS (SELECT row_number() OVER () AS r, line, first, list_distinct(list_filter(string_split(line, ' '), lambda t: t <> '')) AS ts FROM (SELECT line, min(struct_pack(d := doc_id, p := pos)) AS first FROM k GROUP BY line)),
e AS (SELECT r, len(ts) AS m, unnest(ts) AS t FROM s),
f AS (SELECT t, count(*) AS c FROM e GROUP BY t),
p AS (SELECT r, m, t FROM (SELECT r, m, e.t, row_number() OVER (PARTITION BY r ORDER BY c, e.t) AS i FROM e JOIN f ON f.t = e.t) WHERE i <= m - (80 * m + 99) // 100 + 1),
q AS (SELECT DISTINCT a.r AS x, b.r AS y FROM p a JOIN p b ON a.t = b.t AND a.r < b.r AND 100 * least(a.m, b.m) >= 80 * greatest(a.m, b.m)),
v AS (SELECT x, y FROM (SELECT x, y, len(list_intersect(a.ts, b.ts)) AS i, len(a.ts) + len(b.ts) AS u FROM q JOIN s a ON a.r = x JOIN s b ON b.r = y) WHERE 180 * i >= 80 * u),
w AS (SELECT x AS r, y AS o FROM v UNION ALL SELECT y, x FROM v),
g AS (SELECT w.r, count(*) AS links, min(s.first) AS other FROM w JOIN s ON s.r = w.o GROUP BY w.r),
j AS (SELECT k.doc_id, k.pos, coalesce(links, 0) AS links, struct_pack(d := k.doc_id, p := k.pos) > s.first OR coalesce(struct_pack(d := k.doc_id, p := k.pos) > g.other, false) AS gone FROM k JOIN s ON s.line = k.line LEFT JOIN g ON g.r = s.r),
o AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, CAST(sum(links) AS BIGINT) AS n_links, string_agg(CAST(pos AS STRING), ',' ORDER BY pos) FILTER (gone) AS removed FROM j GROUP BY doc_id)
SELECT documents.doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_links, 0) AS n_links, coalesce(removed, '') AS removed_lines
FROM documents LEFT JOIN o ON o.doc_id = documents.doc_id"""

OP8_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_NORM4}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) > 1 THEN list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) ELSE ws END AS gs FROM w),
g AS (SELECT doc_id, unnest(gs) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * c >= 80 * (len(a.gs) + len(b.gs) - c)),
e AS (SELECT x AS a, y AS b FROM l UNION SELECT y, x FROM l),
t(node, reach) AS (SELECT a, a FROM e UNION SELECT t.node, e.b FROM t JOIN e ON e.a = t.reach),
c AS (SELECT node, min(reach) AS component FROM t GROUP BY node)
SELECT s.doc_id, CAST(len(gs) AS BIGINT) AS n_shingles, coalesce(component, s.doc_id) AS component_id, coalesce(component, s.doc_id) = s.doc_id AS kept FROM s LEFT JOIN c ON c.node = s.doc_id"""

_HOST = r"translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_REST = r"regexp_extract({0}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
_KEY = f"CASE WHEN contains({{0}}, '://') THEN {_HOST} || CASE {_REST} WHEN '' THEN '/' ELSE {_REST} END END"
OP10_SQL = rf"""
WITH RECURSIVE rules(h, p, a) AS (VALUES {", ".join(map(str, URL_RULES))}),
q AS (SELECT page_id, coalesce(url, '') AS url, html, {_HOST.format("coalesce(url, '')")} AS host, {_PATH.format("coalesce(url, '')")} AS path, {_KEY.format("url")} AS node FROM pages),
tag AS (SELECT url, host, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical["''\s/>][^>]*>|<link\b[^>]*\brel\s*=\s*["'']?canonical["'']?\s*>')) AS tag FROM q),
link AS (SELECT url, host, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target FROM tag
  UNION ALL SELECT url, host, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*http-equiv\s*=\s*["'']?refresh[^>]*url\s*=\s*[''"]?([^"''\s>]+)', 1)) FROM q),
part AS (SELECT url, host, target, regexp_extract(target, '(?s)^([^?#]*)(.*)$', 1) AS place, regexp_extract(target, '(?s)^([^?#]*)(.*)$', 2) AS rest FROM link WHERE target <> ''),
walk AS (SELECT *, string_split('/' || regexp_replace(CASE WHEN place LIKE '/%' THEN place WHEN place = '' THEN {_PATH.format("url")} ELSE regexp_replace({_PATH.format("url")}, '[^/]*$', '') || place END, '^/', ''), '/') AS steps FROM part),
full_link AS (SELECT url, CASE WHEN contains(target, '://') THEN target WHEN target LIKE '//%' THEN 'http:' || target WHEN NOT regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:')
  THEN 'http://' || host || list_reduce(steps, lambda acc, x: CASE x WHEN '..' THEN regexp_replace(acc, '/[^/]*$', '') WHEN '.' THEN acc ELSE acc || '/' || x END) || CASE WHEN steps[-1] IN ('.', '..') THEN '/' ELSE '' END || rest END AS target FROM walk),
one AS (SELECT {_KEY.format("url")} AS a, {_KEY.format("target")} AS b FROM full_link WHERE target IS NOT NULL),
e AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
t(node, reach) AS (SELECT a, a FROM e UNION SELECT t.node, e.b FROM t JOIN e ON e.a = t.reach),
place AS (SELECT host, path FROM q UNION SELECT {_HOST.format("'http://' || node")}, {_PATH.format("'http://' || node")} FROM t),
fit AS (SELECT host, path, h || p AS rule, a, row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC, a, h || p) AS r FROM place, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
bad AS (SELECT DISTINCT t.node FROM t JOIN fit ON fit.host = {_HOST.format("'http://' || reach")} AND fit.path = {_PATH.format("'http://' || reach")} WHERE r = 1 AND a = 'block')
SELECT page_id, q.host, q.path, rule, coalesce(a, CASE WHEN q.node IN (SELECT node FROM bad) THEN 'block' END, 'allow') AS verdict
FROM q LEFT JOIN fit ON fit.host = q.host AND fit.path = q.path AND r = 1"""


_CRC_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_CRC_TABLE = f"SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(0 AS BIGINT) FOR k IN range(8)]), lambda x, k: {_CRC_STEP})) AS tab"


def _crc_sql(key: str) -> str:
    """crc32 of a string's UTF-8 bytes, by the table of _CRC_TABLE."""
    byte = lambda i: f"CAST(('0x' || substr(hex(encode({key})), 2 * {i} - 1, 2)) AS BIGINT)"
    folded = f"list_reduce(list_prepend(4294967295, [{byte('i')} FOR i IN range(1, CAST(octet_length(encode({key})) AS BIGINT) + 1)]), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))"
    return f"xor({folded}, 4294967295)"


_LAST = "right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)"


def _best_sql(options: list[tuple[str, str, str]]) -> str:
    """The least (cost, audit) of options: from a place's state, extra cost, letters."""
    return "list_min([" + ", ".join(f"CASE WHEN {p} IS NOT NULL THEN struct_pack(c := {p}.c + {cost}, a := {p}.a || {edit}) END" for p, cost, edit in options) + "])"


def _op12_sql() -> str:
    """A forward program over (cost, audit) of each place, a row of every conversation a round; repaired lines are then read off the audit."""
    gone = "CASE WHEN fault IN (1, 2) THEN 1000000000 ELSE CASE WHEN fault = 3 THEN 3 ELSE 0 END END"
    kept = lambda letter: f"(CASE WHEN i = '{letter}' THEN 0 ELSE 1000000000 END + {gone})"
    rerole = f"(3 + {gone})"
    # Each place before the row, after up to two inserts.
    before = {
        "b0": [("p0", "0", "''")], "b1": [("p1", "0", "''")],
        "b2": [("p2", "0", "''"), ("p0", "3", "'I'"), ("p1", "3", "'I'"), ("p3", "3", "'I'")],
        "b3": [("p3", "0", "''"), ("p2", "3", "'I'"), ("p0", "6", "'II'"), ("p1", "6", "'II'")],
    }
    after = {
        "p0": [("b0", "4", "'D'")], "p1": [("b1", "4", "'D'"), ("b0", kept("s"), "'K'")],
        "p2": [("b2", "4", "'D'"), *((b, c, e) for b in ("b0", "b1", "b3") for c, e in ((kept("u"), "'K'"), (rerole, "'R'")))],
        "p3": [("b3", "4", "'D'"), ("b2", kept("a"), "'K'"), ("b2", rerole, "'R'")],
    }
    return f"""
WITH RECURSIVE t AS ({_CRC_TABLE}),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT conv_id, turn, role, text, {_crc_sql("key")} % 20 AS h FROM k, t),
d AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
o AS (SELECT *, substr(role, 1, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS r, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN again > 1 THEN 2 WHEN {_LAST} NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, lag(i) OVER (PARTITION BY conv_id ORDER BY r) || i AS pair FROM o),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
s(conv_id, r, p0, p1, p2, p3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), struct_pack(c := CAST(0 AS BIGINT), a := ''), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)) FROM c
  UNION ALL SELECT conv_id, r + 1, {", ".join(_best_sql(x) for x in after.values())} FROM (
    SELECT s.conv_id, s.r, i, fault, {", ".join(f"{_best_sql(x)} AS {b}" for b, x in before.items())} FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.r = s.r + 1)),
e AS (SELECT conv_id, {_best_sql([("p0", "0", "''"), ("p3", "0", "''"), ("p2", "3", "'I'"), ("p1", "6", "'II'")])} AS best FROM s JOIN c USING (conv_id) WHERE s.r = c.n),
a AS (SELECT conv_id, best.a AS audit, generate_subscripts(string_split(best.a, ''), 1) AS pos, unnest(string_split(best.a, '')) AS edit FROM e),
b AS (SELECT *, sum(CASE edit WHEN 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY pos) AS r, sum(CASE edit WHEN 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY pos) AS place FROM a),
g AS (SELECT b.conv_id, pos, place, edit, role, text, coalesce(max(CASE WHEN place = 1 AND edit = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY b.conv_id), 0) AS has_s
      FROM b LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.r = b.r AND edit <> 'I' WHERE edit <> 'D'),
l AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN (place - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS repaired FROM g GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM q.conv_id"""


OP12_SQL = _op12_sql()

OP13_SQL = rf"""
WITH RECURSIVE t AS ({_CRC_TABLE}),
d AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_NORM4}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents) GROUP BY ALL),
h AS (SELECT w, n, {_crc_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)")} AS h FROM d, t),
v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM h),
c AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM v GROUP BY w HAVING length(w) >= 5 AND sum(n) >= 3),
x AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS rest FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM c)),
p AS (SELECT DISTINCT a.w, a.n, b.w AS o, b.n AS m FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.w <> b.w
      UNION SELECT a.w, a.n, b.w, b.n FROM x a JOIN c b ON a.rest = b.w UNION SELECT b.w, b.n, a.w, a.n FROM x a JOIN c b ON a.rest = b.w),
g AS (SELECT w, n, count(*) AS n_near, min(struct_pack(m := -m, o := o)) AS best FROM p GROUP BY w, n),
f AS (SELECT c.w, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 2 * c.n THEN best.o END AS form, CASE WHEN -best.m >= 2 * c.n THEN -best.m END AS form_n FROM c LEFT JOIN g ON g.w = c.w),
r AS (SELECT w, w AS root, form AS next FROM f UNION ALL SELECT r.w, f.w, f.form FROM r JOIN f ON f.w = r.next)
SELECT f.w AS word, form, root, f.n, n_near, form_n FROM f JOIN r ON r.w = f.w AND r.next IS NULL"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_substring_dedup, op2_line_dedup, op3_quality_classifier, op4_exact_dedup, op5_chat_format, op6_best_fit_packing, op7_language_id, op8_near_dedup, op9_decontamination, op10_url_filter, op11_secret_scan, op12_conversation_repair, op13_spelling_variants, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op2_line_dedup": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op5_chat_format": OP5_SQL, "op8_near_dedup": OP8_SQL, "op10_url_filter": OP10_SQL, "op12_conversation_repair": OP12_SQL, "op13_spelling_variants": OP13_SQL}

"""One query for each operator, on the given tables through small adapters, and the same in DuckDB SQL.

The tables hold no entities or graphs, so adapters make them from `part`, `events`, `conversations` and the rest; each
adapter stands here twice, as DataFrame code and as SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions import jsonx
from quillgraph.functions import text as tx
from quillgraph.operators import chunk, dedup, extract, graph, model, normalize, relate, render, retrieve

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(c):
    """Arrays leave as text, so that engines agree on them."""
    return F.array_join(c, "|")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# SQL of the text functions, for the oracles
def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{tx.WS}+|{tx.WS}+$')}, '', 'g')"


def sql_key(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({sql_strip(x)}), '[^a-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '_')"


def sql_snake(x: str) -> str:
    return f"lower(trim(regexp_replace({sql_strip(x)}, {lit(tx.SNAKE_OTHER)}, '_', 'g'), '_'))"


def sql_tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower({x}), '[^a-z0-9]+'), lambda t: t <> ''))"


def sql_jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE CAST(len(list_intersect({a}, {b})) AS DOUBLE) / len(list_distinct(list_concat({a}, {b}))) END"


def sql_ascii(x: str) -> str:
    out = f"translate({x}, {lit(tx.FROM)}, {lit(tx.TO)})"
    for a, b in tx.SEVERAL.items():
        out = f"replace({out}, {lit(a)}, {lit(b)})"
    return out


SQL_STOP = " OR ".join(["{0} LIKE '%" + p + "%'" for p in extract.STOP_PARTS])
SQL_ALLOWED = "(coalesce(type, '') = '' OR lower(type) IN (" + ", ".join(map(lit, extract.ALLOWED_TYPES)) + "))"


# ---- adapters ------------------------------------------------------------------------------------------------------

_KINDS = ("component", "module", "model", "other", "", "entity", "process", "Agent")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From part: word order swapped on odd keys, types from allowed and other words, some without description or IO."""
    p = table(spark, sf_dir, "part")
    none = F.array().cast("array<string>")
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), F.col("p_size") % 8 + 1)
    has = F.col("p_size") % 4 != 0
    return p.select(
        F.col("p_partkey").alias("ord"),
        F.when(F.col("p_partkey") % 2 == 1, F.array_join(F.reverse(F.split("p_name", " ")), " ")).otherwise(F.col("p_name")).alias("name"),
        kind.alias("type"),
        F.when(F.col("p_size") % 10 == 9, F.concat(F.lit("Preface "), "p_type")).when(F.col("p_size") % 10 != 8, F.col("p_type")).alias("description"),
        F.when(has, F.array(F.concat_ws(" ", "p_type", "p_name"), F.col("p_name"))).otherwise(none).alias("inputs"),
        F.when(has, F.array(F.concat_ws(" ", "p_name", "p_type"), F.col("p_name"))).otherwise(none).alias("outputs"),
    )


ENTITIES = f"""e AS (
  SELECT p_partkey AS ord,
    CASE WHEN p_partkey % 2 = 1 THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ') ELSE p_name END AS name,
    [{", ".join(map(lit, _KINDS))}][p_size % 8 + 1] AS type,
    CASE WHEN p_size % 10 = 9 THEN 'Preface ' || p_type WHEN p_size % 10 <> 8 THEN p_type END AS description,
    CASE WHEN p_size % 4 <> 0 THEN [p_type || ' ' || p_name, p_name] ELSE CAST([] AS VARCHAR[]) END AS inputs,
    CASE WHEN p_size % 4 <> 0 THEN [p_name || ' ' || p_type, p_name] ELSE CAST([] AS VARCHAR[]) END AS outputs
  FROM part)"""


def linked_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (p_name, p_type); outputs and inputs of which some are equal, some share two of three words."""
    p = table(spark, sf_dir, "part").groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("ord"))
    return p.select(
        "ord",
        tx.snake(F.concat_ws(" ", "p_name", "p_type", F.col("ord").cast("string"))).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_name").alias("romanian"),
        F.lit("component").alias("type"),
        F.col("p_type").alias("description"),
        F.array(F.concat_ws(" ", "p_type", "p_name"), F.col("p_name")).alias("inputs"),
        F.array(F.concat_ws(" ", "p_name", "p_type"), F.col("p_name")).alias("outputs"),
    )


LINKED = f"""le AS (
  SELECT ord, {sql_snake("p_name || ' ' || p_type || ' ' || CAST(ord AS VARCHAR)")} AS id, p_name AS name, p_name AS romanian, 'component' AS type,
    p_type AS description, [p_type || ' ' || p_name, p_name] AS inputs, [p_name || ' ' || p_type, p_name] AS outputs
  FROM (SELECT p_name, p_type, min(p_partkey) AS ord FROM part GROUP BY p_name, p_type))"""
LINKS = f"""{LINKED},
o AS (SELECT ord AS o1, id AS f, unnest(outputs) AS x FROM le),
i AS (SELECT ord AS o2, id AS t, unnest(inputs) AS y FROM le),
ot AS (SELECT x, {sql_tokens("x")} AS tx FROM (SELECT DISTINCT x FROM o)),
it AS (SELECT y, {sql_tokens("y")} AS ty FROM (SELECT DISTINCT y FROM i)),
n AS (SELECT x, y, sim FROM (SELECT x, y, {sql_jaccard("tx", "ty")} AS sim FROM ot, it) WHERE sim >= 0.62),
links AS (SELECT o.f AS "from", i.t AS "to", o.x AS label, n.sim FROM o JOIN n USING (x) JOIN i USING (y) WHERE o1 <> o2)"""


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From conversations: turns are chunks, every third begins with a heading."""
    c = table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    return c.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("chunk_idx"), F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Chapter "), F.col("turn").cast("string"), F.lit("\n"), text)).otherwise(text).alias("text"))


CHUNKS = """c AS (
  SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS chunk_idx,
    CASE WHEN turn % 3 = 0 THEN 'Chapter ' || CAST(turn AS VARCHAR) || chr(10) || coalesce(text, '') ELSE coalesce(text, '') END AS text
  FROM conversations)"""
SECTIONS = f"""{CHUNKS},
h AS (SELECT doc_id, chunk_idx, regexp_extract({sql_strip("text")}, {lit("^([^" + tx.LINE_END[1:] + "*)")}, 1) AS line FROM c),
m AS (SELECT doc_id, chunk_idx, regexp_matches(line, {lit("(?i)" + tx.HEADING)}) AS opens, substr({sql_strip("line")}, 1, 120) AS title FROM h),
k AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY chunk_idx ROWS UNBOUNDED PRECEDING) AS n FROM m),
k2 AS (SELECT *, CAST(n - min(n) OVER (PARTITION BY doc_id) AS BIGINT) AS section_ord FROM k),
s AS (SELECT doc_id, section_ord, coalesce(max(CASE WHEN opens THEN title END), 'Introduction') AS title, list(chunk_idx ORDER BY chunk_idx) AS idx FROM k2 GROUP BY doc_id, section_ord),
p AS (SELECT doc_id, section_ord, title, CASE WHEN len(idx) > 2 THEN [idx[1], idx[len(idx) // 2 + 1], idx[len(idx)]] ELSE [idx[1]] END AS picks FROM s WHERE section_ord < 8),
r AS (SELECT doc_id, section_ord, title, CAST(unnest(range(0, len(picks))) AS INTEGER) AS pick, unnest(picks) AS chunk_idx FROM p)"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("ord"), F.col("user_id").cast("string").alias("from"), F.get_json_object("props", "$.k").alias("to"), F.col("event_type").alias("label"))


VOTES = """v AS (SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS "from", json_extract_string(props, '$.k') AS "to", event_type AS label FROM events),
q AS (SELECT "from", "to", coalesce(label, '') AS label, count(*) AS n, min(ord) AS first FROM v GROUP BY 1, 2, 3)"""


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """props plain, in prose, cut short, null, nested in prose."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 5
    text = F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("Answer: "), "props", F.lit(" end }"))).when(k == 2, F.expr("substr(props, 1, length(props) - 1)")).when(k == 3, F.lit("null")).otherwise(F.concat(F.lit('See {"a": '), "props", F.lit("} tail")))
    return e.select("event_id", text.alias("text"))


JSON_TEXTS = """j AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN 'Answer: ' || props || ' end }' WHEN 2 THEN substr(props, 1, length(props) - 1)
  WHEN 3 THEN 'null' ELSE 'See {"a": ' || props || '} tail' END AS text FROM events),
b AS (SELECT event_id, text, CASE WHEN json_valid(text) AND text <> 'null' THEN text END AS whole, nullif(regexp_extract(text, '\\{[^{}]*(\\{[^{}]*\\}[^{}]*)*\\}'), '') AS block FROM j)"""


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers made from part: plain, in prose, cut short; the second entity has an id and odd types only."""
    p = table(spark, sf_dir, "part")
    body = F.concat(F.lit('{"entities": [{"name": "'), "p_name", F.lit('", "type": "'), F.lower("p_brand"), F.lit('", "description": "'), "p_type", F.lit('", "inputs": ["'), "p_type", F.lit('", "'), "p_name", F.lit('"], "outputs": "none"}, {"id": "'), "p_brand", F.lit('", "description": 5, "inputs": 7, "outputs": ["'), "p_name", F.lit('"]}]}'))
    k = F.col("p_partkey") % 3
    return p.select(F.col("p_partkey").alias("unit"), (F.col("p_size") % 3).alias("sample_idx"), F.when(k == 0, body).when(k == 1, F.concat(F.lit("Here: "), body, F.lit(" done"))).otherwise(F.expr("1").cast("string")).alias("text"))


ANSWERS = """w AS (SELECT p_partkey AS unit, p_size % 3 AS sample_idx, '{"entities": [{"name": "' || p_name || '", "type": "' || lower(p_brand) || '", "description": "' || p_type || '", "inputs": ["' || p_type || '", "' || p_name || '"], "outputs": "none"}, {"id": "' || p_brand || '", "description": 5, "inputs": 7, "outputs": ["' || p_name || '"]}]}' AS text FROM part WHERE p_partkey % 3 < 2),
x AS (SELECT unit, sample_idx, unnest([0, 1]) AS pos, unnest([json_extract(text, '$.entities[0]'), json_extract(text, '$.entities[1]')]) AS e FROM w)"""


# ---- scans and text functions --------------------------------------------------------------------------------------

@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, sha256(text) AS hash FROM documents")
def scan_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("chars"), tx.content_hash(F.col("text")).alias("hash"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_scan(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query(f"SELECT doc_id, sha256({sql_ascii('text')}) AS hash FROM documents")
def text_transliterate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.content_hash(tx.transliterate(F.col("text"))).alias("hash"))


@query("SELECT doc_id, sha256(regexp_replace(regexp_replace(replace(replace(text, chr(10), chr(10) || chr(10) || chr(10)), ' ', '  '), '\\n{3,}', chr(10) || chr(10), 'g'), '[ \\t]{2,}', ' ', 'g')) AS hash FROM documents")
def text_collapse_ws(spark, sf_dir):
    wide = F.replace(F.replace("text", F.lit("\n"), F.lit("\n\n\n")), F.lit(" "), F.lit("  "))
    return table(spark, sf_dir, "documents").select("doc_id", tx.content_hash(tx.collapse_space(wide)).alias("hash"))


@query("SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.content_hash(F.col("text")).alias("hash"))


@query(f"SELECT p_partkey, {sql_snake('p_name')} AS name_id, {sql_snake('p_brand')} AS brand_id FROM part")
def snake_id(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tx.snake(F.col("p_name")).alias("name_id"), tx.snake(F.col("p_brand")).alias("brand_id"))


@query(f"SELECT DISTINCT {sql_key('p_brand')} AS key FROM part UNION SELECT {sql_key('c_name')} FROM customer")
def dedup_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select(tx.key(F.col("p_brand")).alias("key")).union(table(spark, sf_dir, "customer").select(tx.key(F.col("c_name")))).distinct()


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'en' WHEN 'fr' THEN 'ro' ELSE 'en' END AS language FROM documents")
def detect_language(spark, sf_dir):
    asked = F.when(F.col("lang") == "en", "Answer in English").when(F.col("lang") == "fr", "limba romana").when(F.col("lang") == "es", "Romanian, then English").otherwise("Deutsch")
    return table(spark, sf_dir, "documents").select("doc_id", tx.language(asked).alias("language"))


@query(f"WITH s AS (SELECT doc_id, string_split(regexp_replace(text, {lit('([.!?])' + tx.WS + '+')}, '\\1' || chr(1), 'g'), chr(1)) AS s FROM documents) SELECT doc_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS idx, unnest(s) AS sentence FROM s")
def sentence_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("idx", "sentence"))


@query(f"SELECT p_partkey, array_to_string(list_sort({sql_tokens('p_name || chr(35) || p_type')}), '|') AS tokens FROM part")
def io_tokens(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", flat(F.array_sort(tx.io_tokens(F.concat_ws("#", "p_name", "p_type")))).alias("tokens"))


@query(f"WITH t AS (SELECT p_partkey, {sql_tokens('p_name')} AS a, {sql_tokens('p_type || chr(32) || p_name')} AS b FROM part) SELECT p_partkey, round({sql_jaccard('a', 'b')}, 9) AS sim FROM t")
def io_jaccard(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(tx.jaccard(tx.io_tokens(F.col("p_name")), tx.io_tokens(F.concat_ws(" ", "p_type", "p_name"))), 9).alias("sim"))


@query(f"WITH t AS (SELECT p_partkey, list_distinct(string_split({sql_key('p_name')}, '_')) AS a, list_distinct(string_split({sql_key('p_type')}, '_')) AS b FROM part) SELECT p_partkey, round({sql_jaccard('a', 'b')}, 9) AS sim FROM t")
def name_jaccard(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(tx.jaccard(tx.key_tokens(tx.key(F.col("p_name"))), tx.key_tokens(tx.key(F.col("p_type")))), 9).alias("sim"))


# ---- chunks and sections -------------------------------------------------------------------------------------------

@query(f"WITH {SECTIONS} SELECT doc_id, chunk_idx, opens FROM m")
def heading_predicate(spark, sf_dir):
    return chunks(spark, sf_dir).select("doc_id", "chunk_idx", tx.is_heading(tx.first_line(F.col("text"))).alias("opens"))


@query(r"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '[^\x09-\x0D\x20]+[\x09-\x0D\x20]*') AS t FROM documents),
w AS (SELECT doc_id, t, range(0, greatest(len(t) - 25 - 1, 0) + 1, 175) AS s FROM t WHERE len(t) > 0)
SELECT doc_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS chunk_idx, unnest(list_transform(s, lambda a: regexp_replace(array_to_string(t[a + 1 : a + 200], ''), '[\x09-\x0D\x20]+$', ''))) AS text FROM w""")
def chunk_token_window(spark, sf_dir):
    return chunk.token_windows(table(spark, sf_dir, "documents"), 200, 25)


@query()
def chunk_recursive(spark, sf_dir):
    return chunk.recursive_chunks(table(spark, sf_dir, "documents"))


@query(f"WITH {SECTIONS} SELECT doc_id, section_ord, title, array_to_string(idx, '|') AS chunk_indices FROM s")
def section_index(spark, sf_dir):
    return chunk.sections(chunks(spark, sf_dir)).withColumn("chunk_indices", flat(F.col("chunk_indices").cast("array<string>")))


@query(f"""WITH {SECTIONS} SELECT doc_id, section_ord, title, array_to_string(idx, '|') AS chunk_indices FROM s WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 0, 'all', array_to_string(list(chunk_idx ORDER BY chunk_idx), '|') FROM c WHERE doc_id % 3 <> 0 GROUP BY doc_id""")
def default_section(spark, sf_dir):
    """An outline of some documents only, so that the others get their one section."""
    c = chunks(spark, sf_dir)
    outline = chunk.sections(c).where(F.col("doc_id") % 3 == 0)
    return chunk.or_default_section(outline, c).withColumn("chunk_indices", flat(F.col("chunk_indices").cast("array<string>")))


@query(f"WITH {SECTIONS} SELECT doc_id, section_ord, title, pick, chunk_idx FROM r")
def section_sample(spark, sf_dir):
    return chunk.representatives(chunk.sections(chunks(spark, sf_dir)))


@query(f"WITH {CHUNKS} SELECT doc_id, CAST(floor(chunk_idx / 5) AS BIGINT) AS batch, string_agg(text, chr(10) || chr(10) ORDER BY chunk_idx, text) AS text FROM c GROUP BY 1, 2")
def chunk_batch(spark, sf_dir):
    return chunk.batches(chunks(spark, sf_dir))


@query(f"WITH {SECTIONS}, t AS (SELECT r.doc_id, r.section_ord, r.pick, c.text FROM r JOIN c USING (doc_id, chunk_idx)) SELECT doc_id, section_ord, string_agg(text, chr(10) || chr(10) ORDER BY pick) FILTER (WHERE text <> '') AS context FROM t GROUP BY 1, 2")
def context_build(spark, sf_dir):
    c = chunks(spark, sf_dir)
    return retrieve.context(chunk.representatives(chunk.sections(c)).join(c, ["doc_id", "chunk_idx"]))


# ---- retrieval -----------------------------------------------------------------------------------------------------

_NEAR = """WITH q AS (SELECT vec_id AS query, embedding AS a FROM embeddings WHERE vec_id IN ({})),
d AS (SELECT q.query, vec_id AS id, list_sum(list_transform(range(1, len(a) + 1), lambda i: (CAST(embedding[i] AS DOUBLE) - CAST(a[i] AS DOUBLE)) * (CAST(embedding[i] AS DOUBLE) - CAST(a[i] AS DOUBLE)))) AS d2 FROM embeddings, q),
r AS (SELECT query, row_number() OVER (PARTITION BY query ORDER BY d2, id) AS rank, id, d2 FROM d)
SELECT {} CAST(rank AS INTEGER) AS rank, id, round(d2, 6) AS d2 FROM r WHERE rank <= 4"""


def _vectors(spark, sf_dir, *ids):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return v, [(r["id"], r["vector"]) for r in v.where(F.col("id").isin(*ids)).orderBy("id").collect()]


@query(_NEAR.format("0", ""))
def vector_topk(spark, sf_dir):
    v, asked = _vectors(spark, sf_dir, 0)
    return retrieve.nearest(v, asked[0][1]).withColumn("d2", F.round("d2", 6))


@query(_NEAR.format("0, 1", "query,"))
def vector_topk_batch(spark, sf_dir):
    v, asked = _vectors(spark, sf_dir, 0, 1)
    return retrieve.nearest_of_each(v, asked).withColumn("d2", F.round("d2", 6))


# ---- extraction ----------------------------------------------------------------------------------------------------

@query(f"""WITH s AS (SELECT p_partkey, 'The ' || p_name || ' is a ' || CASE WHEN p_size % 2 = 0 THEN 'Module' ELSE lower(p_type) END || ' that handles ' || p_brand || '..' AS s FROM part),
m AS (SELECT p_partkey, regexp_extract(s, {lit('(?i)' + extract.DEFINITION)}, ['name', 'article', 'kind', 'rest']) AS g FROM s)
SELECT p_partkey, 0 AS sentence_idx, trim(g.name) AS name, CASE WHEN lower(trim(g.kind)) IN ({", ".join(map(lit, extract.HEURISTIC_TYPES))}) THEN lower(trim(g.kind)) ELSE 'other' END AS type, rtrim(trim(g.rest), '.') AS description FROM m WHERE g.name <> ''""")
def heuristic_extract(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 2 == 0, "Module").otherwise(F.lower("p_type"))
    return extract.by_pattern(p.select("p_partkey", F.concat(F.lit("The "), "p_name", F.lit(" is a "), kind, F.lit(" that handles "), "p_brand", F.lit("..")).alias("text")), "p_partkey")


@query(f"WITH {JSON_TEXTS} SELECT event_id, whole IS NOT NULL AS ok, coalesce(CAST(json_extract_string(whole, '$.k') AS BIGINT), -1) AS k FROM b")
def json_parse(spark, sf_dir):
    j = json_texts(spark, sf_dir).withColumn("v", jsonx.parsed(F.col("text")))
    return j.select("event_id", F.col("v").isNotNull().alias("ok"), F.coalesce(F.try_variant_get("v", "$.k", "long"), F.lit(-1)).alias("k"))


@query(f"WITH {JSON_TEXTS} SELECT event_id, block FROM b")
def json_block(spark, sf_dir):
    return json_texts(spark, sf_dir).select("event_id", jsonx.block(F.col("text")).alias("block"))


@query(f"WITH {JSON_TEXTS} SELECT event_id, CAST(coalesce(json_extract_string(coalesce(whole, block), '$.k'), json_extract_string(coalesce(whole, block), '$.a.k'), '-1') AS BIGINT) AS k FROM b")
def json_robust(spark, sf_dir):
    j = json_texts(spark, sf_dir).withColumn("v", jsonx.robust(F.col("text")))
    return j.select("event_id", F.coalesce(F.try_variant_get("v", "$.k", "long"), F.try_variant_get("v", "$.a.k", "long"), F.lit(-1)).alias("k"))


@query(f"WITH {ANSWERS} SELECT unit, sample_idx, pos, json_extract_string(e, '$.name') AS name FROM x")
def json_explode(spark, sf_dir):
    return extract.from_answers(answers(spark, sf_dir)).select("unit", "sample_idx", "pos", F.try_variant_get("e", "$.name", "string").alias("name"))


_COERCED = """SELECT unit, sample_idx, pos, coalesce(nullif(json_extract_string(e, '$.name'), ''), nullif(json_extract_string(e, '$.id'), ''), '') AS name,
  coalesce(nullif(json_extract_string(e, '$.type'), ''), 'component') AS type, CASE WHEN json_type(e, '$.description') = 'VARCHAR' THEN json_extract_string(e, '$.description') ELSE '' END AS description,
  CASE WHEN json_type(e, '$.inputs') = 'ARRAY' THEN array_to_string(json_extract_string(e, '$.inputs[*]'), '|') ELSE '' END AS inputs,
  CASE WHEN json_type(e, '$.outputs') = 'ARRAY' THEN array_to_string(json_extract_string(e, '$.outputs[*]'), '|') ELSE '' END AS outputs FROM x"""


@query(f"WITH {ANSWERS} {_COERCED}")
def entity_coerce(spark, sf_dir):
    return extract.coerced(extract.from_answers(answers(spark, sf_dir))).withColumns({c: flat(F.col(c)) for c in ("inputs", "outputs")})


@query(f"WITH {ANSWERS} SELECT unit, CAST(row_number() OVER (PARTITION BY unit ORDER BY sample_idx, pos) - 1 AS INTEGER) AS ord, name FROM ({_COERCED})")
def sample_union(spark, sf_dir):
    return extract.union_of_samples(extract.coerced(extract.from_answers(answers(spark, sf_dir)))).select("unit", "ord", "name")


_STOPPED = f"({SQL_STOP.format('lower(coalesce(name, chr(32)))')} OR {SQL_STOP.format('lower(coalesce(description, chr(32)))')})"
_RELEVANT = f"NOT {_STOPPED} AND {SQL_ALLOWED} AND length(coalesce(name, '')) BETWEEN 2 AND 60"
_TASK = f"NOT {_STOPPED} AND {SQL_ALLOWED} AND (len(inputs) + len(outputs) > 0 OR length(coalesce(description, '')) >= 12)"


@query(f"WITH {ENTITIES} SELECT ord, name, type, description FROM e WHERE {_RELEVANT}")
def relevance_filter(spark, sf_dir):
    return extract.relevant(entities(spark, sf_dir)).select("ord", "name", "type", "description")


_RAW = f"{ANSWERS}, z AS (SELECT unit * 2 + pos AS ord, CAST(floor(unit / 100) AS BIGINT) AS batch, name, type, description FROM ({_COERCED}))"


def _raw(spark, sf_dir):
    """The two entities of each answer, numbered throughout, a hundred units a batch."""
    return extract.from_answers(answers(spark, sf_dir)).select((F.col("unit") * 2 + F.col("pos")).alias("ord"), F.floor(F.col("unit") / 100).alias("batch"), "e")


@query(f"WITH {_RAW} SELECT ord, name, type, description FROM z WHERE {_RELEVANT} QUALIFY row_number() OVER (PARTITION BY name, type ORDER BY ord) = 1")
def section_mode(spark, sf_dir):
    return extract.section_mode(_raw(spark, sf_dir).drop("batch")).select("ord", "name", "type", "description")


@query(f"WITH {_RAW} SELECT ord, batch, name, type, description FROM z QUALIFY row_number() OVER (PARTITION BY batch, name, type ORDER BY ord) = 1")
def full_mode(spark, sf_dir):
    return extract.full_mode(_raw(spark, sf_dir)).select("ord", "batch", "name", "type", "description")


@query(f"WITH {ENTITIES} SELECT min(ord) AS ord, name, type FROM e GROUP BY name, type")
def dedup_exact(spark, sf_dir):
    return extract.first_of_each(entities(spark, sf_dir)).select("ord", "name", "type")


@query(f"WITH {ENTITIES} SELECT min(ord) AS ord, CAST(floor(ord / 100) AS BIGINT) AS batch, name, type FROM e GROUP BY floor(ord / 100), name, type")
def dedup_exact_in_batch(spark, sf_dir):
    return extract.first_of_each(entities(spark, sf_dir).withColumn("batch", F.floor(F.col("ord") / 100)), "batch").select("ord", "batch", "name", "type")


@query(f"WITH {ENTITIES} SELECT ord, {sql_snake('name')} AS id, name AS romanian FROM e")
def normalize_entities(spark, sf_dir):
    return normalize.normalized(entities(spark, sf_dir)).select("ord", "id", "romanian")


@query(f"WITH {ENTITIES} SELECT ord, name, type FROM e WHERE {_TASK}")
def task_filter(spark, sf_dir):
    return normalize.task_filter(entities(spark, sf_dir)).select("ord", "name", "type")


@query(f"WITH {ENTITIES}, f AS (SELECT ord, type, {_TASK} AND ord % 3 = 0 AND type <> 'module' AS keep FROM e), g AS (SELECT *, count(*) FILTER (WHERE keep) OVER (PARTITION BY type) AS n FROM f) SELECT ord, type FROM g WHERE keep OR n = 0")
def filter_or_all(spark, sf_dir):
    e = entities(spark, sf_dir)
    keep = normalize.fits_task(e) & (F.col("ord") % 3 == 0) & (F.col("type") != "module")
    return normalize.filter_or_all(e, keep, "type").select("ord", "type")


# ---- deduplication -------------------------------------------------------------------------------------------------

_KEYED = f"""{ENTITIES}, n AS (SELECT *, {sql_snake('name')} AS id FROM e), k AS (SELECT *, {sql_key('id')} AS key FROM n),
b AS (SELECT *, min(ord) OVER (PARTITION BY key) AS bucket FROM k),
l AS (SELECT *, min(bucket) OVER (PARTITION BY array_to_string(list_sort(list_distinct(string_split(key, '_'))), '_')) AS leader FROM b)"""


def _normal(spark, sf_dir):
    return normalize.normalized(entities(spark, sf_dir))


@query(f"WITH {_KEYED} SELECT key, bucket, count(*) AS n FROM b GROUP BY 1, 2")
def dedup_bucket(spark, sf_dir):
    return dedup.buckets(_normal(spark, sf_dir))


@query(f"WITH {_KEYED} SELECT DISTINCT bucket, leader FROM l")
def dedup_leader(spark, sf_dir):
    return dedup.leaders(dedup.buckets(_normal(spark, sf_dir)))


_MERGED = f"""{_KEYED},
base AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY length(coalesce(description, '')) DESC, bucket, ord) AS n FROM l) WHERE n = 1),
pi AS (SELECT leader, x, min((bucket, ord, i)) AS place FROM (SELECT leader, bucket, ord, unnest(inputs) AS x, unnest(range(0, len(inputs))) AS i FROM l) GROUP BY 1, 2),
po AS (SELECT leader, x, min((bucket, ord, i)) AS place FROM (SELECT leader, bucket, ord, unnest(outputs) AS x, unnest(range(0, len(outputs))) AS i FROM l) GROUP BY 1, 2),
pn AS (SELECT leader, name AS x, min((bucket, ord)) AS place FROM l GROUP BY 1, 2),
ai AS (SELECT leader, string_agg(x, '|' ORDER BY place) AS s FROM pi GROUP BY 1), ao AS (SELECT leader, string_agg(x, '|' ORDER BY place) AS s FROM po GROUP BY 1),
an AS (SELECT leader, string_agg(x, '|' ORDER BY place) AS s FROM pn GROUP BY 1), am AS (SELECT leader, string_agg(id, '|' ORDER BY bucket, ord) AS s FROM l GROUP BY 1)"""


@query(f"WITH {_MERGED} SELECT base.leader AS ord, id, name, type, description, coalesce(ai.s, '') AS inputs, coalesce(ao.s, '') AS outputs, an.s AS alt_names FROM base LEFT JOIN ai USING (leader) LEFT JOIN ao USING (leader) JOIN an USING (leader)")
def merge_entities(spark, sf_dir):
    m = dedup.merged(dedup.clustered(_normal(spark, sf_dir)))
    return m.select("ord", "id", "name", "type", "description", *[flat(F.col(c)).alias(c) for c in ("inputs", "outputs", "alt_names")])


@query(f"WITH {_MERGED} SELECT base.leader AS ord, id AS canonical, an.s AS alt_names, am.s AS members FROM base JOIN an USING (leader) JOIN am USING (leader)")
def dedup_report(spark, sf_dir):
    r = dedup.report(dedup.merged(dedup.clustered(_normal(spark, sf_dir))))
    return r.withColumns({c: flat(F.col(c)) for c in ("alt_names", "members")})


# ---- relations, graph ----------------------------------------------------------------------------------------------

@query(f'WITH {LINKS} SELECT "from", "to", label, round(sim, 9) AS sim FROM links')
def io_link(spark, sf_dir):
    return relate.io_links(linked_entities(spark, sf_dir)).withColumn("sim", F.round("sim", 9))


@query(f'WITH {LINKS} SELECT "from", "to", label, round(sim, 9) AS sim FROM links ORDER BY links.sim DESC, "from", "to", label LIMIT 200')
def io_link_topk(spark, sf_dir):
    return relate.strongest_io_links(linked_entities(spark, sf_dir)).withColumn("sim", F.round("sim", 9))


@query(f'WITH {VOTES} SELECT "from", "to", label, n, first FROM q WHERE n >= 2')
def vote_majority(spark, sf_dir):
    return relate.majority(votes(spark, sf_dir))


@query(f'WITH {VOTES} SELECT "from", "to", label FROM q WHERE n >= 2')
def vote_or_keep(spark, sf_dir):
    v = votes(spark, sf_dir)
    return relate.voted_or(v.where(F.col("ord") % 7 == 0), v)


@query(f"""WITH {VOTES}, w AS (SELECT "from", "to", label FROM q ORDER BY n DESC, first LIMIT 5), p AS (SELECT "from", "to", label FROM v WHERE ord % 7 = 0)
SELECT * FROM p UNION ALL SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p."from" IS NOT DISTINCT FROM w."from" AND p."to" IS NOT DISTINCT FROM w."to" AND p.label IS NOT DISTINCT FROM w.label)""")
def vote_top5_union(spark, sf_dir):
    v = votes(spark, sf_dir)
    return relate.with_voted(v.where(F.col("ord") % 7 == 0).select("from", "to", "label"), v, samples=1_000_000)


def _graph(spark, sf_dir):
    e = linked_entities(spark, sf_dir)
    links = relate.strongest_io_links(e).select("from", "to", "label")
    from pyspark.sql import Window

    return graph.nodes(e), graph.edges(links.withColumn("ord", F.row_number().over(Window.orderBy("from", "to", "label"))))


_GRAPH = f"""{LINKS}, ed AS (SELECT row_number() OVER (ORDER BY "from", "to", label) AS ord, "from", "to", label FROM (SELECT * FROM links ORDER BY sim DESC, "from", "to", label LIMIT 200))"""


@query(f"WITH {LINKED} SELECT ord, id, id AS name, romanian, description AS function, array_to_string(inputs, '|') AS inputs, array_to_string(outputs, '|') AS outputs, type FROM le")
def graph_nodes(spark, sf_dir):
    return graph.nodes(linked_entities(spark, sf_dir)).withColumns({c: flat(F.col(c)) for c in ("inputs", "outputs")})


@query(f'WITH {_GRAPH} SELECT CAST(ord AS INTEGER) AS ord, "from", "to", label FROM ed')
def graph_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@query(f"""WITH {_GRAPH}, l AS (SELECT 0 AS p, ord, '[' || id || ']' || CASE WHEN romanian <> '' AND romanian <> id THEN ' as "' || id || ' (' || romanian || ')"' ELSE '' END AS line FROM le
UNION ALL SELECT 1, ord, '[' || "from" || '] -->> [' || "to" || '] : ' || label FROM ed)
SELECT '@startuml' || chr(10) || string_agg(line, chr(10) ORDER BY p, ord) || chr(10) || '@enduml' AS diagram FROM l""")
def render_puml(spark, sf_dir):
    return render.puml(*_graph(spark, sf_dir))


@query(f"""WITH {_GRAPH}, l AS (SELECT 0 AS p, ord, '  "' || id || '" [label="' || replace(id || ' (' || romanian || ')', '"', '\\"') || '"];' AS line FROM le
UNION ALL SELECT 1, ord, '  "' || "from" || '" -> "' || "to" || '" [label="' || replace(label, '"', '\\"') || '"];' FROM ed)
SELECT 'digraph G {{' || chr(10) || '  rankdir=LR;' || chr(10) || '  node [shape=box];' || chr(10) || string_agg(line, chr(10) ORDER BY p, ord) || chr(10) || '}}' AS diagram FROM l""")
def render_dot(spark, sf_dir):
    return render.dot(*_graph(spark, sf_dir))


@query(f"""WITH {LINKED} SELECT string_agg('## ' || id || ' (' || romanian || ')' || chr(10) || '**Responsibility**: ' || description || chr(10) || '**Inputs**: ' || array_to_string(inputs, ', ') || chr(10) || '**Outputs**: ' || array_to_string(outputs, ', '), chr(10) || chr(10) ORDER BY ord) || chr(10) AS markdown FROM le""")
def render_markdown(spark, sf_dir):
    return render.markdown(graph.nodes(linked_entities(spark, sf_dir)))


@query("""WITH k AS (SELECT DISTINCT p_partkey AS id FROM part WHERE p_size <= 25), e AS (SELECT l_orderkey * 10 + l_linenumber AS ord, l_partkey AS f, l_suppkey AS t FROM lineitem)
SELECT ord, 0 AS side, 'Edge from ''' || CAST(f AS VARCHAR) || ''' not in nodes' AS error FROM e WHERE f NOT IN (SELECT id FROM k)
UNION ALL SELECT ord, 1, 'Edge to ''' || CAST(t AS VARCHAR) || ''' not in nodes' FROM e WHERE t NOT IN (SELECT id FROM k)""")
def validate_edges(spark, sf_dir):
    known = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("id"))
    e = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_partkey").alias("from"), F.col("l_suppkey").alias("to"))
    return graph.dangling(e, known)


@query("""WITH x AS (SELECT n_nationkey AS ord, 0 AS side, '- Edge from ''' || CAST(n_nationkey AS VARCHAR) || ''' not in nodes' AS l FROM nation WHERE n_nationkey NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey < 3)
UNION ALL SELECT n_nationkey, 1, '- Edge to ''' || CAST(n_regionkey AS VARCHAR) || ''' not in nodes' FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey < 3))
SELECT 'Validation Report' || chr(10) || '==================' || chr(10) || chr(10) || CASE WHEN count(*) = 0 THEN 'No issues detected.' ELSE 'Errors:' || chr(10) || string_agg(l, chr(10) ORDER BY ord, side) END || chr(10) AS report FROM x""")
def validation_report(spark, sf_dir):
    known = table(spark, sf_dir, "region").where("r_regionkey < 3").select(F.col("r_regionkey").alias("id"))
    e = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_nationkey").alias("from"), F.col("n_regionkey").alias("to"))
    return graph.validation_report(graph.dangling(e, known))


_PR = "WITH r AS (SELECT DISTINCT {0} FROM {1}), g AS (SELECT DISTINCT {0} FROM {2}), t AS (SELECT count(*) AS n FROM (SELECT * FROM r INTERSECT SELECT * FROM g)) SELECT {3} CASE WHEN a.n = 0 THEN 0.0 ELSE CAST(t.n AS DOUBLE) / a.n END AS precision, CASE WHEN a.n = 0 OR b.n = 0 THEN 0.0 ELSE CAST(t.n AS DOUBLE) / b.n END AS recall, a.n AS retrieved, b.n AS gold FROM t, (SELECT count(*) AS n FROM r) a, (SELECT count(*) AS n FROM g) b"
_LABELS = ("doc_id", "(SELECT * FROM labels WHERE quality = 1)", "(SELECT * FROM labels WHERE toxic = 0)")
_EDGES = ('user_id, event_type', "(SELECT * FROM events WHERE value > 0.5)", "(SELECT * FROM events WHERE event_id % 2 = 0)")


@query(_PR.format(*_LABELS, ""))
def eval_pr(spark, sf_dir):
    l = table(spark, sf_dir, "labels")  # noqa: E741
    return graph.precision_recall(l.where("quality = 1"), l.where("toxic = 0"), "doc_id")


@query(f"SELECT * FROM ({_PR.format(*_LABELS, lit('entities') + ' AS kind,')}) UNION ALL SELECT * FROM ({_PR.format(*_EDGES, lit('edges') + ' AS kind,')})")
def eval_report(spark, sf_dir):
    l = table(spark, sf_dir, "labels").withColumn("id", F.col("doc_id"))  # noqa: E741
    e = table(spark, sf_dir, "events").withColumns({"from": F.col("user_id"), "to": F.col("event_type"), "label": F.lit("")})
    return graph.evaluation(l.where("quality = 1"), e.where("value > 0.5"), l.where("toxic = 0"), e.where("event_id % 2 = 0"))


@query(f"WITH {SECTIONS} SELECT doc_id, section_ord, 'These passages belong to the section «' || title || '». {model.ENGLISH}List the functional parts that it describes. {model.JSON_ONLY}, with a list named entities.' || chr(10) || chr(10) || 'Passages:' || chr(10) AS prompt FROM s")
def prompt_build(spark, sf_dir):
    s = chunk.sections(chunks(spark, sf_dir))
    return s.select("doc_id", "section_ord", model.section_prompt(F.col("title"), F.lit("")).alias("prompt"))

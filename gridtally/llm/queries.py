"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import session
from gridtally.llm import binary_ids, decontaminate, line_dedup, merkle, near_dedup, packing, quality, sharding, simhash, substring_dedup, topk, toxicity, variants
from gridtally.llm.common import prepare, remainder, table
from gridtally.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(prepare(spark), folder, "documents"))


@query("op2_simple8b_ids")
def simple8b_ids(spark: SparkSession, folder: str) -> DataFrame:
    files = session.fresh_path(prepare(spark), "ids")
    binary_ids.write(table(spark, folder, "documents"), files)
    return binary_ids.index(spark, files)


@query("op3_toxicity_automaton")
def toxicity_automaton(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(prepare(spark), folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, remainder("doc_id", 3) != 1)
    return toxicity.score(docs, model).select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query("op4_feistel_sharding")
def feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(prepare(spark), folder, "documents"), shards=40)


# A run of lines goes where it holds 30 characters and stands earlier, too. Shortest such
# runs, from each line on and up to each line, cover all longer ones.
_LINE_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d WHERE ls IS NOT NULL),
c AS (SELECT *, length(line) AS n, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i) AS total FROM l),
runs AS (
    SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.total >= a.total - a.n + 30 GROUP BY ALL
    UNION
    SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.total >= a.total - a.n + 30 GROUP BY b.doc_id, b.i),
texts AS (SELECT doc_id, s, e, array_to_string(ls[s : e], chr(10)) AS run FROM runs JOIN d USING (doc_id)),
later AS (SELECT doc_id, s, e FROM texts QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM later),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (g.i IS NULL) AS text, count(*) AS n_lines, count(g.i) AS n_removed
    FROM l LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op5_line_runs", _LINE_DEDUP_SQL)
def line_runs(spark: SparkSession, folder: str) -> DataFrame:
    made = line_dedup.dedup(table(prepare(spark), folder, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op6_order_minhash")
def order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.class_of(table(prepare(spark), folder, "documents"))


_TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query("op7_impact_top_k", _TOP_K_SQL)
def impact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(prepare(spark), folder, "embeddings"))


@query("op8_subword_quality")
def subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(prepare(spark), folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels, remainder("doc_id", 5) != 0)
    return quality.score(docs, model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


# Words as the contract states them; the windows of an item shorter than 13 words is the item.
_DECONTAMINATION_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (
    SELECT DISTINCT item_id, n, array_to_string(ws[k : k + n - 1], ' ') AS win
    FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS k FROM i WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM w),
dw AS (
    SELECT doc_id, n, k, array_to_string(ws[k : k + n - 1], ' ') AS win
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, lengths)),
hits AS (SELECT DISTINCT doc_id, dw.k, dw.n, item_id FROM dw JOIN w USING (n, win)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op9_benchmark_decontamination", _DECONTAMINATION_SQL)
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op10_block_anchors")
def block_anchors(spark: SparkSession, folder: str) -> DataFrame:
    made = substring_dedup.dedup(table(prepare(spark), folder, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _crc32_sql(text: str) -> str:
    """SQL for the crc32 of a text of code points up to 255, bit by bit (reflected polynomial EDB88320)."""
    octets = f"""flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN c = '' THEN CAST([] AS BIGINT[])
        WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [CAST(192 + (ord(c) >> 6) AS BIGINT), CAST(128 + (ord(c) & 63) AS BIGINT)] END))"""
    shifted = "list_reduce(CAST(range(8) AS BIGINT[]), lambda x, o: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b))"
    return f"xor(list_reduce({octets}, lambda a, b: {shifted}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# One tree over the leaves of each language, one over the languages' roots; a node's sibling has its place with the last bit flipped.
_MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang AS g, leaf, t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n
    FROM (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS t FROM documents)),
low AS (
    SELECT g, 0 AS l, p, n, leaf AS h FROM leaves
    UNION ALL
    SELECT g, l + 1, p >> 1, (n + 1) >> 1, sha256(string_agg(h, '' ORDER BY p)) FROM low WHERE n > 1 GROUP BY g, l, p >> 1, n),
subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
    SELECT 0 AS l, p, n, subroot AS h FROM subroots
    UNION ALL
    SELECT l + 1, p >> 1, (n + 1) >> 1, sha256(string_agg(h, '' ORDER BY p)) FROM high WHERE n > 1 GROUP BY l, p >> 1, n),
place AS (SELECT leaves.*, subroot, s.p AS gp, s.n AS gn, row_number() OVER () AS r FROM leaves JOIN subroots s ON leaves.g IS NOT DISTINCT FROM s.g),
beside AS (
    SELECT r, 0 AS tree, l, h FROM place JOIN low ON place.g IS NOT DISTINCT FROM low.g AND low.p = xor(place.p >> low.l, 1)
    UNION ALL
    SELECT r, 1, l, h FROM place JOIN high ON high.p = xor(place.gp >> high.l, 1)),
proofs AS (SELECT r, string_agg(h, '' ORDER BY tree, l) AS proof FROM beside GROUP BY r),
climb AS (
    SELECT r, 0 AS tree, 0 AS l, p, n, coalesce(t, leaf) AS h FROM place
    UNION ALL
    SELECT c.r, CASE WHEN n > 1 THEN tree ELSE tree + 1 END, CASE WHEN n > 1 THEN c.l + 1 ELSE 0 END,
        CASE WHEN n > 1 THEN p >> 1 ELSE (SELECT gp FROM place WHERE place.r = c.r) END,
        CASE WHEN n > 1 THEN (n + 1) >> 1 ELSE (SELECT gn FROM place WHERE place.r = c.r) END,
        CASE WHEN n = 1 THEN c.h WHEN p % 2 = 1 THEN sha256(b.h || c.h) ELSE sha256(c.h || coalesce(b.h, '')) END
    FROM climb c LEFT JOIN beside b USING (r, tree, l) WHERE tree = 0 OR n > 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    c.h AS folded_root, c.h = (SELECT h FROM high WHERE n = 1) AS verified
FROM place LEFT JOIN proofs USING (r) JOIN climb c ON c.r = place.r AND c.tree = 1 AND c.n = 1
"""


@query("op11_merkle_manifest", _MERKLE_SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(prepare(spark), folder, "documents")
    changed = [F.col("n_chars") + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS]
    claim = F.when(remainder("doc_id", 7) == 0, merkle.leaf(changed))
    made = merkle.manifest(docs, claims={"tampered": claim})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), "proof", merkle.PLACES)
    return made.withColumn("folded_root", folded).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


# Words that agree but for the letter at one place, or but for one letter that the longer one has more.
_VARIANTS_SQL = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{6,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
hashed AS (SELECT run, {_crc32_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs),
made AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
vocabulary AS (SELECT word, count(*) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM less a JOIN vocabulary b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM less a JOIN vocabulary b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS n, min(struct_pack(less := -n, other := other)).other AS form FROM near GROUP BY word),
forms AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * v.n THEN form END AS form, CASE WHEN b.n >= 5 * v.n THEN b.n END AS form_n
    FROM vocabulary v LEFT JOIN best b USING (word)),
chain AS (
    SELECT word, word AS root, form AS further FROM forms
    UNION ALL
    SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.further = f.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM chain WHERE further IS NULL) USING (word)
"""


@query("op12_spelling_variants", _VARIANTS_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.groups(table(prepare(spark), folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_covering_simhash")
def covering_simhash(spark: SparkSession, folder: str) -> DataFrame:
    made = simhash.groups(table(prepare(spark), folder, "documents"))
    return made.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")

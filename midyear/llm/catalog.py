"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from midyear.catalog.registry import table
from midyear.llm import bytenet, langid
from midyear.llm.decontamination import contaminated_spans
from midyear.llm.lines import without_near_lines
from midyear.llm.lm import fit, score
from midyear.llm.merkle import dealt_third, lower_ascii, manifest
from midyear.llm.mixing import mix_sources
from midyear.llm.passages import without_passages
from midyear.llm.quality import quality_rules
from midyear.llm.rollup import TokenRollup, rank_counter, word_counter
from midyear.llm.simhash import near_duplicates
from midyear.llm.substrings import without_repeats
from midyear.llm.texts import fold
from midyear.llm.trie import prefix_trie
from midyear.sources.shared import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


@query("op6_mix_sources")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_quality_rules")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules(table(spark, sf, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance")


@query("op7_decontaminate")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    found = contaminated_spans(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op7_decontaminate"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
windows AS (
    SELECT DISTINCT item, array_to_string(list_slice(w, i, i + 9), ' ') AS win, least(len(w), 10) AS n
    FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
    SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT r, i, spots.n AS n, item FROM spots JOIN windows ON spots.win = windows.win AND spots.n = windows.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@query("op1_simhash")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents")).drop("root")


@query("op9_repeated_passages")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return without_repeats(table(spark, sf, "documents")).drop("kept")


ORACLES["op9_repeated_passages"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (
    SELECT r, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS win
    FROM d, unnest(range(1, len(w) - 33)) AS t(i) WHERE len(w) >= 35),
twice AS (SELECT win FROM spots GROUP BY win HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT r, p FROM (SELECT r, i FROM spots WHERE win IN (SELECT win FROM twice)) s,
        unnest(range(i, i + 35)) AS t(p)),
words AS (SELECT r, w[p] AS word, p FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (
    SELECT words.r, count(*) AS n, string_agg(word, ' ' ORDER BY words.p) AS t
    FROM words LEFT JOIN gone ON words.r = gone.r AND words.p = gone.p WHERE gone.r IS NULL GROUP BY words.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@query("op3_kneser_ney")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit(docs.filter(fold(F.col("doc_id"), 7) != 2), order=3)
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


@query("op10_line_dedup")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return without_near_lines(table(spark, sf, "documents")).drop("kept")


ORACLES["op10_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (
    SELECT r, doc_id, i, list_distinct(regexp_extract_all(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS w
    FROM d, unnest(range(1, len(ls) + 1)) AS t(i)),
sets AS (SELECT w, min((doc_id, i)) AS head FROM (SELECT list_sort(w) AS w, doc_id, i FROM l WHERE len(w) > 0) GROUP BY w),
numbered AS (SELECT row_number() OVER () AS s, w, head, len(w) AS n FROM sets),
freq AS (SELECT word, count(*) AS df FROM (SELECT unnest(w) AS word FROM numbered) GROUP BY word),
spots AS (
    SELECT s, word, row_number() OVER (PARTITION BY s ORDER BY df, word) AS p
    FROM (SELECT s, unnest(w) AS word FROM numbered) JOIN freq USING (word) WHERE TRUE),
prefix AS (SELECT spots.s, word FROM spots JOIN numbered USING (s) WHERE p <= n - ceil(n * 4 / 5.0) + 1),
pairs AS (SELECT DISTINCT a.s AS x, b.s AS y FROM prefix a JOIN prefix b ON a.word = b.word AND a.s <> b.s),
late AS (
    SELECT DISTINCT x AS s FROM pairs JOIN numbered nx ON nx.s = x JOIN numbered ny ON ny.s = y
    WHERE ny.head < nx.head AND 5 * least(nx.n, ny.n) >= 4 * greatest(nx.n, ny.n)
      AND 9 * len(list_intersect(nx.w, ny.w)) >= 4 * (nx.n + ny.n)),
gone AS (
    SELECT l.r, l.i FROM l JOIN numbered ON list_sort(l.w) = numbered.w
    WHERE (l.doc_id, l.i) <> head OR s IN (SELECT s FROM late)),
kept AS (
    SELECT l.r, string_agg(ls[i], chr(10) ORDER BY i) AS t
    FROM l JOIN d USING (r) WHERE (l.r, l.i) NOT IN (SELECT r, i FROM gone) GROUP BY l.r)
SELECT doc_id, (SELECT count(*) FROM l WHERE l.r = d.r AND len(w) > 0) AS n_lines,
    (SELECT count(*) FROM gone WHERE gone.r = d.r) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@query("op4_language_id")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    fourth = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~fourth))
    return langid.predict(docs, model).select("doc_id", fourth.alias("held_out"), "lang_pred", "score")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    fifth = fold(F.col("doc_id"), 5) == 0
    net = bytenet.fit(docs, labels.filter(~fifth))
    return bytenet.score(docs, net).select(
        "doc_id", fifth.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op2_token_rollup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    rollup = TokenRollup(spark, fresh_path(spark, "token-rollup"), {
        "words-1": word_counter, "byte_bpe_multi_50k-1": rank_counter("byte_bpe_multi_50k")})
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    change = lambda kind, rows: rows.select(F.lit(kind).alias("kind"), "doc_id", "text", "source", "lang")
    load = change("insert", docs)
    rollup.commit("load", load)
    rollup.commit("load", load)  # committed already: counts nothing twice
    # every fifth document gets its text twice over, every seventh of the others goes
    fifth, seventh = fold(F.col("doc_id"), 5) == 1, fold(F.col("doc_id"), 7) == 3
    revised = docs.filter(fifth).withColumn("text", F.concat_ws("\n", "text", "text"))
    rollup.commit("edit", change("revise", revised).union(change("delete", docs.filter(~fifth & seventh))))
    return rollup.totals()


# Quotients are written out for every seat here; the operator ranks only those near the last one.
ORACLES["op6_mix_sources"] = r"""
WITH sizes AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sizes GROUP BY source),
levels AS (
    SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(2 * source_size) OVER w, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
    FROM totals WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
seats AS (
    SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS place,
        round(sum_target / 50) AS blocks
    FROM (SELECT *, sum(target) OVER () AS sum_target FROM targets),
        unnest(range(0, CAST(target / 50 AS BIGINT) + 40)) AS t(k)),
quotas AS (SELECT source, count(*) FILTER (place <= blocks) AS source_quota FROM seats GROUP BY source),
placed AS (
    SELECT s.*, source_size, target, source_quota,
        CAST('0x' || substr(place, 1, 12) AS BIGINT) % greatest(1, CAST(ceil(source_size / 250000) AS BIGINT)) AS shard
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
shards AS (
    SELECT source, shard, source_quota, CAST(sum(size) AS BIGINT) AS shard_size FROM placed GROUP BY ALL),
shard_seats AS (
    SELECT source, shard, shard_size, source_quota,
        row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS place
    FROM shards, unnest(range(0, source_quota + 1)) AS t(k)),
shard_quotas AS (
    SELECT source, shard, shard_size, count(*) FILTER (place <= source_quota) AS quota FROM shard_seats GROUP BY ALL),
lined AS (
    SELECT p.*, shard_size, least(quota * 50, shard_size * 2) AS words,
        sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY substr(place, 13, 20), p.doc_id, size
            ROWS UNBOUNDED PRECEDING) - size AS start
    FROM placed p JOIN shard_quotas q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard)
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN shard_size > 0 THEN (words // shard_size) * size
        + greatest(0, least(size, words % shard_size - start)) ELSE 0 END AS BIGINT) AS taken
FROM lined
"""


@query("op11_repeated_bytes")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return without_passages(table(spark, sf, "documents")).drop("kept", "removed")


ORACLES["op11_repeated_bytes"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
spots AS (
    SELECT r, i, sha256(array_slice(b, i + 1, i + 200)) AS win
    FROM d, unnest(range(0, octet_length(b) - 199)) AS t(i) WHERE octet_length(b) >= 200),
twice AS (SELECT win FROM spots GROUP BY win HAVING count(*) > 1),
hits AS (SELECT r, i FROM spots WHERE win IN (SELECT win FROM twice)),
marked AS (SELECT r, i, CASE WHEN i - lag(i) OVER w <= 200 THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY r ORDER BY i)),
numbered AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM marked),
runs AS (SELECT r, run, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY r, run),
bounds AS (
    SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS low, a AS high FROM runs
    UNION ALL SELECT r, max(z), (SELECT octet_length(b) FROM d WHERE d.r = runs.r) FROM runs GROUP BY r),
kept AS (
    SELECT bounds.r, string_agg(hex(array_slice(b, low + 1, high)), '' ORDER BY low) AS k
    FROM bounds JOIN d USING (r) WHERE high > low GROUP BY bounds.r),
gone AS (SELECT r, sum(z - a) AS n, count(*) AS m FROM runs GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
    coalesce(m, 0) AS n_spans, CASE WHEN m IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(k, ''))) END AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""


@query("op12_conversation_trie")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(table(spark, sf, "conversations")).drop("path", "parent")


def _sql_crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''),
        lambda c: CAST(ord(c) AS BIGINT))), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
        lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""


ORACLES["op12_conversation_trie"] = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
        substr(sha256(strlen(role) || ':' || role || text), 1, 32)) AS turns FROM said GROUP BY conv_id),
dealt AS (SELECT *, {_sql_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own),
built AS (
    SELECT d.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(d.turns, h + 1, len(d.turns))) AS turns
    FROM dealt d LEFT JOIN own b ON b.conv_id = d.conv_id - d.conv_id % 5),
prefixes AS (
    SELECT conv_id, len(turns) AS n, p AS depth, list_slice(turns, 1, p) AS path
    FROM built, unnest(range(0, len(turns) + 1)) AS t(p)),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
        CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(path[len(path)].text) END AS saved
    FROM prefixes GROUP BY path, depth),
children AS (SELECT path, depth, (SELECT count(*) FROM nodes c WHERE c.depth = a.depth + 1
    AND list_slice(c.path, 1, a.depth) = a.path) AS n_children FROM nodes a),
sums AS (
    SELECT a.path, count(*) FILTER (n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens
    FROM nodes a JOIN nodes b ON b.depth >= a.depth AND list_slice(b.path, 1, a.depth) = a.path
    JOIN children c ON c.path = b.path GROUP BY a.path)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM nodes a JOIN children c ON c.path = a.path JOIN sums s ON s.path = a.path
LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.path = list_slice(a.path, 1, a.depth - 1)
"""


@query("op13_merkle_manifest")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    changed = (dealt_third(F.col("doc_id")), lower_ascii(F.col("text")))
    return manifest(table(spark, sf, "documents"), tampered=changed)


def _sql_leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, doc_id, lang, {_sql_leaf('text')} AS leaf,
        CASE WHEN {_sql_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
            THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
    FROM documents),
leaves AS (
    SELECT r, doc_id, leaf, other, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM rows),
lower_nodes(g, level, spot, n, h) AS (
    SELECT g, 0, spot, count(*) OVER (PARTITION BY g), leaf FROM leaves
    UNION ALL
    SELECT g, level + 1, spot // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY spot))
    FROM lower_nodes WHERE n > 1 GROUP BY g, level, spot // 8, n),
subroots AS (SELECT g, h FROM lower_nodes WHERE n = 1),
upper_nodes(level, spot, n, h) AS (
    SELECT 0, g, count(*) OVER (), h FROM subroots
    UNION ALL
    SELECT level + 1, spot // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY spot))
    FROM upper_nodes WHERE n > 1 GROUP BY level, spot // 8, n),
nodes AS (
    SELECT g, level, spot, n, h FROM lower_nodes
    UNION ALL SELECT NULL, level + 100, spot, n, h FROM upper_nodes),
steps AS (
    SELECT l.r, s.level, l.spot // CAST(8 ** s.level AS BIGINT) AS spot, l.g
    FROM leaves l JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1 AND level < 100) s ON s.g = l.g
    UNION ALL
    SELECT l.r, s.level, l.g // CAST(8 ** (s.level - 100) AS BIGINT), NULL
    FROM leaves l, (SELECT DISTINCT level FROM nodes WHERE n > 1 AND level >= 100) s),
proofs AS (
    SELECT s.r, s.level, coalesce(string_agg(n.h, '' ORDER BY n.spot) FILTER (n.spot < s.spot), '') AS before,
        coalesce(string_agg(n.h, '' ORDER BY n.spot) FILTER (n.spot > s.spot), '') AS after
    FROM steps s JOIN nodes n ON n.level = s.level AND n.g IS NOT DISTINCT FROM s.g AND n.spot // 8 = s.spot // 8
    GROUP BY s.r, s.level),
lined AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY level) AS k FROM proofs),
folds(r, k, h) AS (
    SELECT r, 0, coalesce(other, leaf) FROM leaves
    UNION ALL SELECT folds.r, folds.k + 1, sha256(before || h || after) FROM folds JOIN lined ON lined.r = folds.r AND lined.k = folds.k + 1),
folded AS (SELECT r, arg_max(h, k) AS h FROM folds GROUP BY r),
siblings AS (SELECT r, string_agg(before || after, '' ORDER BY level) AS p FROM proofs GROUP BY r),
top AS (SELECT h FROM upper_nodes WHERE n = 1)
SELECT doc_id, leaf, subroots.h AS subroot, top.h AS root, sha256(coalesce(p, '')) AS proof_sha256,
    folded.h AS folded_root, folded.h = top.h AS verified
FROM leaves JOIN subroots USING (g) JOIN folded USING (r) LEFT JOIN siblings USING (r), top
"""

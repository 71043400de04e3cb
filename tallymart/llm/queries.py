"""The registered queries of the corpus operators and, where SQL can say it, their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import decontamination, grammar, licenses, manifest, mixing, near, periodic, pii, prefix_bpe, rules, sharding, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query(
    """
    WITH items AS (
        SELECT item_id, list_distinct(CASE WHEN len(w) >= 5
            THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS asked
        FROM (SELECT item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark)
    ), asked AS (
        SELECT item_id, len(asked) AS item_shingles, unnest(asked) AS shingle FROM items
    ), held AS (
        SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
            THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END)) AS shingle
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)
    )
    SELECT doc_id, item_id, item_shingles::BIGINT AS item_shingles, count(*)::BIGINT AS shared_shingles,
           count(*) / item_shingles::DOUBLE AS containment
    FROM held JOIN asked USING (shingle)
    GROUP BY doc_id, item_id, item_shingles
    HAVING count(*) * 1000 >= item_shingles * 800
    """
)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a test item, with the item and the exact containment."""
    return decontamination.leak_report(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("text_key")


def _poured(rows: str, weight: str, cap: str, budget: str, group: str = "") -> str:
    """SQL of ``native.fill``: the share of every row of ``rows``."""
    part = f"PARTITION BY {group}" if group else ""
    upto = f"OVER ({part} ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""SELECT * EXCLUDE (ratio, filled), CASE WHEN filled THEN {cap} ELSE
            ({budget} - sum(CASE WHEN filled THEN {cap} ELSE 0.0 END) OVER ({part}))
            / sum(CASE WHEN NOT filled THEN {weight} END) OVER ({part}) * {weight} END AS share
        FROM (SELECT *, sum({cap}) {upto} + ratio * (sum({weight}) OVER ({part}) - sum({weight}) {upto}) <= {budget} AS filled
            FROM (SELECT *, CASE WHEN {weight} > 0 THEN {cap} / {weight} ELSE 0.0 END::DOUBLE AS ratio FROM {rows}))"""


_MIX = f"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
            ('0x' || substr(md5('mix' || chr(9) || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
        FROM documents
    ), rows_ AS (
        SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS class FROM sized
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source
    ), weighed AS (
        SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
            source_size * 2.0::DOUBLE AS cap, (SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM sources) AS budget FROM sources
    ), goals AS (
        SELECT source, source_size, share AS target FROM ({_poured("weighed", "weight", "cap", "budget")})
    ), classes AS (
        SELECT c.source, c.class, c.words, source_size, target, c.words::DOUBLE * c.class AS weight, c.words * 2.0::DOUBLE AS cap
        FROM (SELECT source, class, sum(size)::BIGINT AS words FROM rows_ GROUP BY source, class) c
        JOIN goals g ON c.source IS NOT DISTINCT FROM g.source
    ), chances AS (
        SELECT *, copies - floor(copies) AS p, floor(copies)::BIGINT AS whole,
            sum((copies - floor(copies)) * words) OVER (
                PARTITION BY source ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS left_
        FROM (SELECT *, CASE WHEN words > 0 THEN share / words ELSE 0.0 END AS copies
            FROM ({_poured("classes", "weight", "cap", "target", "source")}))
    ), ranked AS (
        SELECT r.doc_id, r.source, r.size, r.u, c.source_size, c.target, c.p, c.whole, c.left_,
            u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS v
        FROM rows_ r JOIN chances c ON r.source IS NOT DISTINCT FROM c.source AND r.class = c.class
    ), used AS (
        SELECT *, sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (
            PARTITION BY source, p > 0 ORDER BY v, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM ranked
    ), counted AS (
        SELECT *, CASE WHEN size > 0 THEN whole + (p > 0 AND upto - size / 2.0 <= left_)::BIGINT ELSE 0 END AS copies FROM used
    )
    SELECT doc_id, source, size, source_size, target, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken FROM counted
"""


@query(_MIX)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_report(read(spark, folder, "documents"))


@query()
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict for every document."""
    return rules.quality_report(read(spark, folder, "documents")).drop("row_key")


@query()
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document; the row counts of shards differ by one at most."""
    return sharding.shard_report(read(spark, folder, "documents"))


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer's file is; it is at the same place on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in documents, with coverage and span."""
    return licenses.license_report(read(spark, folder, "documents"))


@query(
    """
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, coalesce(list_distinct(CASE WHEN len(w) >= 4
            THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END), []) AS held FROM split
    ), shingles AS (
        SELECT doc_id, len(held) AS n, unnest(held) AS shingle FROM sets
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ), least_ AS (
        SELECT a, min(b) AS b FROM reach GROUP BY a
    )
    SELECT doc_id, len(held)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
        doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
    FROM sets LEFT JOIN least_ ON doc_id = a
    """
)
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Group of every document among near duplicates."""
    return near.near_report(read(spark, folder, "documents")).drop("text_key")


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxic_report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query()
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.token_report(read(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query()
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, written to grammar files and read back."""
    return grammar.grammar_report(read(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@query()
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.pii_report(read(spark, folder, "documents"))


@query()
def op11_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    path = tokenizer_file("byte_bpe_50k.json")
    rows = prefix_bpe.decode_ids(prefix_bpe.encode_texts(read(spark, folder, "documents"), path), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, some of which are planted, and the text without their repetitions."""
    return periodic.run_report(periodic.planted(read(spark, folder, "documents")))


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


@query(
    f"""
    WITH RECURSIVE byte_table AS (
        SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ), summed AS (
        SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("n_chars + 1")} AS changed,
            xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
                lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
        FROM documents, byte_table
    ), leaves AS (
        SELECT doc_id, lang, leaf, CASE WHEN crc % 7 = 0 THEN changed ELSE leaf END AS now,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM summed
    ), nodes AS (
        SELECT lang, 0 AS level, pos, leaf AS digest, size FROM leaves
        UNION ALL
        SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (size + 1) // 2 FROM nodes
        WHERE size > 1 GROUP BY lang, level, pos // 2, size
    ), tops AS (
        SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
        FROM nodes WHERE size = 1
    ), upper_ AS (
        SELECT 0 AS level, pos, subroot AS digest, size FROM tops
        UNION ALL
        SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (size + 1) // 2 FROM upper_
        WHERE size > 1 GROUP BY level, pos // 2, size
    ), steps AS (
        SELECT l.doc_id, v.level, (l.pos >> v.level) & 1 AS odd, n.digest FROM leaves l
        JOIN (SELECT DISTINCT lang, level FROM nodes WHERE size > 1) v ON l.lang IS NOT DISTINCT FROM v.lang
        LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM l.lang AND n.level = v.level AND n.pos = xor(l.pos >> v.level, 1)
        UNION ALL
        SELECT l.doc_id, 1000 + v.level, (t.pos >> v.level) & 1, n.digest FROM leaves l
        JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang
        JOIN (SELECT DISTINCT level FROM upper_ WHERE size > 1) v ON true
        LEFT JOIN upper_ n ON n.level = v.level AND n.pos = xor(t.pos >> v.level, 1)
    ), paths AS (
        SELECT doc_id, sha256(coalesce(string_agg(digest, '' ORDER BY level), '')) AS proof_sha256,
            list(CASE WHEN digest IS NULL THEN 'N' WHEN odd = 1 THEN 'L' || digest ELSE 'R' || digest END ORDER BY level) AS path
        FROM steps GROUP BY doc_id
    ), folded AS (
        SELECT l.doc_id, l.leaf, t.subroot, (SELECT digest FROM upper_ WHERE size = 1) AS root,
            coalesce(proof_sha256, sha256('')) AS proof_sha256,
            list_reduce(list_prepend(l.now, coalesce(path, [])), lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root
        FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang LEFT JOIN paths p ON l.doc_id = p.doc_id
    )
    SELECT *, folded_root = root AS verified FROM folded
    """
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether the row, tampered with or not, verifies."""
    return manifest.tampered_report(read(spark, folder, "documents"))

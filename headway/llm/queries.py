"""The corpus queries, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe,
    contamination,
    exact,
    licences,
    merkle,
    mixing,
    quality,
    secret_scan,
    sharding,
    simhash,
    substring,
    tries,
    warc,
)
from headway.session import lookup_join

SHARDS = 24


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(_text()) + 8).cast("long").alias("size"),
        F.crc32(_text().cast("binary")).alias("text_crc32"),
    )
    return sharding.shard_rows(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring.without_repeats(docs).select(
        "doc_id", "n_sentences", "n_removed", (F.col("n_removed") > 0).alias("repeated"), "first_ids", "clean_text"
    )


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "lang", "length", "perplexity", "low", "high", "kept")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archived(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, folder, "documents"))

    def joined(spans: str):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
        return F.array_join(parts, ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in secret_scan.KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, distance=4)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "stays"
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.licence_scan(table(spark, folder, "documents"))
    return found.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.encoded(table(spark, folder, "documents"), *vocabulary), *vocabulary)


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    rebuilt = tries.regrown(tries.turns_of(table(spark, folder, "conversations")))
    return tries.trie(tries.sequences(rebuilt))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    claimed = merkle.leaf_of(F.when(tampered, lowered).otherwise(F.col("text"))).alias("claimed")
    made = merkle.manifest(docs, claimed)
    subroots = made.trees.select("tree", "subroot")
    found = lookup_join(merkle.verified(made), subroots, ["tree"], how="inner")
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(made.root).cast("string").alias("root"),
        "proof_sha256", "folded_root", "verified",
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_substring_dedup, op3_quality_classifier, op4_warc, op5_secret_scan, op6_exact_dedup,
        op7_simhash, op8_decontamination, op9_mixing, op10_licence_scan,
        op11_byte_bpe, op12_conversation_trie, op13_merkle, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # Five hexadecimal digits of SHA-1 are four digits of base 32.
    "op4_warc": """
        WITH page AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        coded AS (
            SELECT page_id, html, array_to_string(list_transform(range(0, 32), lambda k:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT)
                    >> CAST(5 * (3 - k % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS digest FROM page),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM coded)
        SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, TRUE AS intact
        FROM firsts
    """,
    "op8_decontamination": r"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        item AS (
            SELECT item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        windows AS (
            SELECT item_id, least(len(w), 10) AS n,
                   unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
                                         lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS span
            FROM item WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (
            SELECT r, n, unnest(range(1, len(w) - n + 2)) AS place, w FROM doc, sizes WHERE len(w) >= n),
        found AS (
            SELECT DISTINCT r, place, p.n, item_id FROM places p
            JOIN windows s ON s.n = p.n AND array_to_string(w[place:place + p.n - 1], ' ') = span),
        words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (
            SELECT r, unnest(range(place, place + n)) AS k FROM found) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
}


# The rule for licence texts once more, as SQL: its own patterns, only texts and spellings are shared.
_MARKS_SQL = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\p{P}\p{S}\p{Z}\x{FEFF}]+"
_BEFORE_SQL = r"[ \t#*/;%!<>.-]*"
_BETWEEN_SQL = r"[\s#*/;%!-]+"
_RIGHTS_SQL = (
    (rf"copyright{_BETWEEN_SQL}(\(c\){_BETWEEN_SQL})?([<\[{{](year|yyyy)[^>\]}}]{{0,20}}[>\]}}]{_BETWEEN_SQL}"
     rf"[<\[{{][^>\]}}]{{0,80}}[>\]}}]|year{_BETWEEN_SQL}name{_BETWEEN_SQL}of{_BETWEEN_SQL}author|[0-9]{{4}}(,{_BETWEEN_SQL}[0-9]{{4}})*{_BETWEEN_SQL}free{_BETWEEN_SQL}software{_BETWEEN_SQL}"
     rf"foundation,{_BETWEEN_SQL}inc\.,?({_BETWEEN_SQL}<https?://[^>\s]*>)?)", " "),
    (rf"\A({_BEFORE_SQL}((\(c\)|©)[^\n]*)?(\n|\z))+", ""),
    (rf"(?m)^{_BEFORE_SQL}((\(c\)|©)[^\n]*[0-9]{{4}}[^\n]*|copyright\b[^\n]*(\(c\)|©|[0-9]{{4}})[^\n]*"
     r"|all rights reserved[ \t.]*)$", ""),
    (rf"(\A|\n{_BEFORE_SQL}\n){_BEFORE_SQL}copyright\b[^\n]{{0,80}}(\n{_BEFORE_SQL}\n|\n?\z)", "  "),
)


def _canonical_sql(text: str) -> str:
    """The canonical form of a text."""
    out = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"replace({out}, chr(13) || chr(10), chr(10))"
    for pattern, instead in _RIGHTS_SQL:
        out = f"regexp_replace({out}, '{pattern}', '{instead}', 'g')"
    out = f"(' ' || regexp_replace({out}, '{_MARKS_SQL}', '  ', 'g') || ' ')"
    for old, new in licences.SPELLINGS:
        doubled = [f" {' '.join(x.split()).replace(' ', '  ')} " if x else " " for x in (old, new)]
        out = f"replace({out}, '{doubled[0]}', '{doubled[1]}')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _licence_sql() -> str:
    values = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licences.KNOWN)
    return f"""
        WITH known AS (
            SELECT sha256({_canonical_sql('text')}) AS digest, min(licence) AS licence
            FROM (VALUES {values}) AS k (licence, text) GROUP BY 1),
        doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        lines AS (SELECT DISTINCT r, unnest(string_split(text, chr(10))) AS line FROM doc),
        noticed AS (
            SELECT r, string_agg(licence, ',' ORDER BY licence) AS notices FROM (
                SELECT DISTINCT r, licence FROM (SELECT r, sha256({_canonical_sql('line')}) AS digest FROM lines)
                JOIN known USING (digest))
            GROUP BY r),
        digests AS (SELECT r, doc_id, sha256({_canonical_sql('text')}) AS digest FROM doc)
        SELECT doc_id, digest, licence, coalesce(notices, '') AS notices
        FROM digests LEFT JOIN known USING (digest) LEFT JOIN noticed USING (r)
    """


ORACLES["op10_licence_scan"] = _licence_sql()


def _crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text in SQL: eight shifts a character."""
    eight = "[xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]"
    step = f"list_reduce({eight}, lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ord(s) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b: {step}), 4294967295)"


def _tagged_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(_tagged_sql(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"

    def tree(name: str, leaves: str) -> str:
        """Nodes (t, level, k, h) above ``leaves`` (t, k, h) up to the root of each tree."""
        return f"""{name}(t, level, k, h, n) AS (
            SELECT t, 0, k, h, count(*) OVER (PARTITION BY t) FROM {leaves}
            UNION ALL
            SELECT t, max(level) + 1, k // 16, sha256(string_agg(h, '' ORDER BY k)), max((n + 15) // 16)
            FROM {name} WHERE n > 1 GROUP BY t, k // 16)"""

    def way(name: str, leaves: str, nodes: str) -> str:
        """For each leaf the siblings of every level, and the digest folded with them."""
        return f"""{name}(t, leaf, level, h, siblings) AS (
            SELECT t, k, 0, claimed, '' FROM {leaves}
            UNION ALL
            SELECT w.t, w.leaf, w.level + 1,
                   sha256(string_agg(CASE WHEN n.k = place THEN w.h ELSE n.h END, '' ORDER BY n.k)),
                   max(w.siblings) || coalesce(string_agg(n.h, '' ORDER BY n.k) FILTER (n.k <> place), '')
            FROM (SELECT *, leaf // (16 ** level)::BIGINT AS place FROM {name}) w
            JOIN {nodes} n ON n.t = w.t AND n.level = w.level AND n.k // 16 = place // 16 AND n.n > 1
            GROUP BY w.t, w.leaf, w.level)"""

    return f"""
        WITH RECURSIVE leaves AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, 'n') AS t, {leaf("text")} AS h,
                   CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS claimed
            FROM documents),
        placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, h) - 1 AS k FROM leaves),
        {tree("nodes", "placed")},
        subroots AS (
            SELECT 'root' AS t, t AS source, h AS subroot, h, row_number() OVER (ORDER BY encode(t)) - 1 AS k
            FROM nodes WHERE n = 1),
        {tree("over", "subroots")},
        {way("ways", "placed", "nodes")},
        lower_way AS (SELECT * FROM ways QUALIFY row_number() OVER (PARTITION BY t, leaf ORDER BY level DESC) = 1),
        climbed AS (
            SELECT 'root' AS t, row_number() OVER () AS k, s.k AS place, w.t AS source, w.leaf, w.h AS claimed, w.siblings
            FROM lower_way w JOIN subroots s ON s.source = w.t),
        upper_way AS (
            WITH RECURSIVE up(k, level, place, h, siblings) AS (
                SELECT k, 0, place, claimed, '' FROM climbed
                UNION ALL
                SELECT u.k, u.level + 1, u.place // 16,
                       sha256(string_agg(CASE WHEN n.k = u.place THEN u.h ELSE n.h END, '' ORDER BY n.k)),
                       max(u.siblings) || coalesce(string_agg(n.h, '' ORDER BY n.k) FILTER (n.k <> u.place), '')
                FROM up u JOIN over n ON n.level = u.level AND n.k // 16 = u.place // 16 AND n.n > 1
                GROUP BY u.k, u.level, u.place)
            SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY k ORDER BY level DESC) = 1)
        SELECT p.doc_id, p.h AS leaf, s.subroot, o.h AS root, sha256(c.siblings || u.siblings) AS proof_sha256,
               u.h AS folded_root, u.h = o.h AS verified
        FROM placed p JOIN subroots s ON s.source = p.t
        JOIN climbed c ON c.source = p.t AND c.leaf = p.k JOIN upper_way u ON u.k = c.k
        JOIN over o ON o.n = 1
    """


ORACLES["op13_merkle"] = _merkle_sql()


ORACLES["op12_conversation_trie"] = f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(text, '') AS text,
               substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS id
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list({{'id': id, 'n': length(text)}} ORDER BY turn NULLS FIRST, id) AS t,
               {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h
        FROM turns GROUP BY conv_id),
    rebuilt AS (
        SELECT o.conv_id AS c, list_concat(coalesce(d.t[1:o.h], []), o.t[o.h + 1:]) AS t
        FROM own o LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 100),
    prefixes AS (
        SELECT c, unnest(range(0, len(t) + 1)) AS depth, t,
               list_transform(t, lambda x: x.id) AS ids FROM rebuilt),
    nodes AS (
        SELECT depth, ids[1:depth] AS node, min(c) AS conv_id, count(*) AS n_convs, any_value(t[depth].n) AS n,
               string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(t) = depth) AS ended
        FROM prefixes GROUP BY depth, ids[1:depth]),
    linked AS (
        SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k
               WHERE k.depth = n.depth + 1 AND k.node[1:n.depth] = n.node) AS n_children
        FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]),
    subtrees AS (
        SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum(coalesce((n_convs - 1) * n, 0)) AS saved
        FROM (SELECT *, unnest(list_transform(range(0, depth + 1), lambda d: node[1:d])) AS top FROM linked)
        GROUP BY top)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ended, '')) AS ends_sha256
    FROM linked JOIN subtrees ON top = node
"""

"""The registered queries: each operator over its whole table, with the digests of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.llm import bpe, decontam, langid, linededup, ordermin, phrasededup, prefixtrie, quality, simhash, suffixdedup, toxicity
from segmentry.llm import variants, warc
from segmentry.llm.common import fold
from segmentry.session import cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=2)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.deduplicate(table(spark, sf_dir, "documents"), length=100)
    return found.select(
        "doc_id",
        "n_bytes",
        suffixdedup.n_removed(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    is_held_out = fold(F.col("doc_id"), 3) == 1
    found = toxicity.score(docs, toxicity.learn(docs, labels.filter(~is_held_out), label="toxic"))
    return found.select("doc_id", is_held_out.alias("held_out"), "score", toxicity.predicted(F.col("score"), 0.7).alias("predicted"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path()))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ordermin.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = decontam.hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = cut(warc.bundles(warc.typed_pages(table(spark, sf_dir, "pages"))))
    read = warc.read_bundles(written)
    is_response = F.col("record_type") == "response"
    return read.select(
        "page_id",
        F.when(is_response, F.length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(is_response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    is_held_out = fold(F.col("doc_id"), 3) == 1
    model = quality.learn(docs.filter(~is_held_out), labels.filter(~is_held_out), label="quality")
    found = quality.score(docs, model)
    return found.select("doc_id", is_held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrasededup.deduplicate(table(spark, sf_dir, "documents"), window=35)
    return found.select(
        "doc_id",
        "n_words",
        phrasededup.n_removed(F.col("spans")).alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    is_held_out = fold(F.col("doc_id"), 5) == 0
    model = langid.learn(docs.filter(~is_held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", is_held_out.alias("held_out"), "lang_pred", "score", F.size("languages").alias("n_languages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(prefixtrie.rebuilt(cut(prefixtrie.sequences(table(spark, sf_dir, "conversations"))), block=100, folds=6))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.deduplicate(table(spark, sf_dir, "documents"), least=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.word_counts(table(spark, sf_dir, "documents"), least_chars=6, least_n=5, every=199)
    return variants.spelling_groups(words, ratio=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_bpe": op4_bpe,
    "op5_order_minhash": op5_order_minhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_phrase_dedup": op9_phrase_dedup,
    "op10_language": op10_language,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

#: crc32 of the bytes of a text of ASCII and Latin-1 letters, in SQL: `bytes` is a list of numbers.
CRC = """
        crc_table AS (
            SELECT list(c ORDER BY b) AS crcs FROM (
                SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS c
                FROM range(256) t(b)
            )
        )"""
LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc_sql(text: str) -> str:
    """crc32 of a text whose characters are below 256 (two bytes from 128 on)."""
    units = f"flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END FOR x IN string_split({text}, '')])"
    step = "xor(c // 256, crcs[xor(c % 256, b) + 1])"
    return f"xor(list_reduce({units}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


ORACLES: dict[str, str] = {
    "op11_prefix_trie": f"""
        WITH {CRC}, turns AS (
            SELECT conv_id, length(coalesce(text, '')) AS chars, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
                   turn FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(chars ORDER BY turn NULLS FIRST, id) AS chars FROM turns GROUP BY conv_id
        ), shares AS (
            SELECT convs.*, {crc_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM convs, crc_table
        ), rebuilt AS (
            SELECT s.conv_id, list_concat(coalesce(d.ids[1:h], []), s.ids[h + 1:]) AS ids, list_concat(coalesce(d.chars[1:h], []), s.chars[h + 1:]) AS chars
            FROM shares s LEFT JOIN convs d ON d.conv_id = s.conv_id - s.conv_id % 100
        ), places AS (
            SELECT conv_id, d, ids[1:d] AS node, CASE WHEN d > 0 THEN ids[1:d - 1] END AS parent, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars,
                   d = len(ids) AS is_end FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM rebuilt)
        ), nodes AS (
            SELECT node, any_value(d) AS depth, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
            FROM places GROUP BY node
        ), children AS (
            SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
        ), below AS (
            SELECT top AS node, count(*) FILTER (WHERE n IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved
            FROM (SELECT nodes.*, n, unnest([node[1:i] FOR i IN range(0, depth + 1)]) AS top FROM nodes LEFT JOIN children USING (node)) GROUP BY top
        )
        SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(nodes.n_convs AS BIGINT) AS n_convs,
               CAST(coalesce(children.n, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
        FROM nodes JOIN below USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes up ON nodes.parent = up.node
    """,
    "op12_line_dedup": fr"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
        ), lines AS (
            SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM split
        ), keyed AS (
            SELECT *, {LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM lines
        ), first AS (
            SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key
        ), marked AS (
            SELECT doc_id, line, i, keeper IS NOT NULL AND doc_id > keeper AS is_dropped FROM keyed LEFT JOIN first ON keyed.key = first.key
        )
        SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE is_dropped) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT is_dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op13_spelling_variants": fr"""
        WITH RECURSIVE {CRC}, runs AS (
            SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
        ), counted AS (
            SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
        ), hashed AS (
            SELECT run, n, {crc_sql("doc_id || ':' || run")} AS h FROM counted, crc_table
        ), changed AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), holes AS (
            SELECT word, n, i, left(word, i - 1) || '_' || substr(word, i + 1) AS pattern, left(word, i - 1) || substr(word, i + 1) AS shorter
            FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), replaced AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.pattern = b.pattern AND a.word <> b.word
        ), deleted AS (
            SELECT DISTINCT holes.word AS longer, holes.n AS longer_n, words.word AS shorter, words.n AS shorter_n
            FROM holes JOIN words ON holes.shorter = words.word
        ), near AS (
            SELECT * FROM replaced UNION ALL SELECT longer, shorter, shorter_n FROM deleted UNION ALL SELECT shorter, longer, longer_n FROM deleted
        ), best AS (
            SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word
        ), formed AS (
            SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
            FROM words LEFT JOIN best ON words.word = best.word
        ), chains AS (
            SELECT word, word AS here, form AS next FROM formed
            UNION ALL SELECT chains.word, formed.word, formed.form FROM chains JOIN formed ON chains.next = formed.word
        )
        SELECT formed.word, form, here AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
        FROM formed JOIN chains ON formed.word = chains.word AND chains.next IS NULL
    """,
    "op6_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
        ), b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
        ), windows AS (
            SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS words
            FROM (SELECT item, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
        ), places AS (
            SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS words
            FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(ws) >= size)
        ), found AS (
            SELECT doc_id, item, i, places.size FROM places JOIN windows ON places.words = windows.words AND places.size = windows.size
        ), hit AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
    """,
    "op9_phrase_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), places AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS words
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)
        ), again AS (
            SELECT words FROM places GROUP BY words HAVING count(*) > 1
        ), covered AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM places JOIN again ON places.words = again.words
        ), words AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM d
        ), kept AS (
            SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.j) AS text, count(*) AS n
            FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id AND w.j = c.j WHERE c.j IS NULL GROUP BY w.doc_id
        )
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
    """,
}

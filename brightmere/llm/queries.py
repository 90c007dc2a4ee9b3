"""The queries of this folder over the standard tables. Each applies one operator with production
parameters to its whole table. Those with SQL are compared with it; tests hold the others against
brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightmere.llm import epsilon_grid, html_density, lang_id, lexical_scan, lm_scoring, minhash, mixing, packing, pii, quality
from brightmere.llm import prefix_trie, topk_blocks, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query
def op2_topk_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows for every fiftieth embedding."""
    return topk_blocks.search(topk_blocks.quantised(table(spark, folder, "embeddings")), 50, 5)


@query
def op3_epsilon_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.95."""
    return epsilon_grid.near_duplicates(table(spark, folder, "embeddings"))


@query
def op4_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of all documents for nine tenths of clean tokens."""
    labelled = mixing.by_labels(table(spark, folder, "labels"))
    return mixing.rates(table(spark, folder, "documents"), labelled, {"clean": 0.9, "poor": 0.08, "toxic": 0.02})


@query
def op5_hashed_maxent(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents, learned from six sevenths of them."""
    return lm_scoring.score_held_out(table(spark, folder, "documents"))


@query
def op6_pii_weak(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document, with labelers weighed over all documents."""
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op7_lang_kernel(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    return lang_id.predict_held_out(table(spark, folder, "documents"))


@query
def op8_quality_subwords(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learned from two thirds of the labels."""
    return quality.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_pack_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 2048 tokens that keep the sources' shares."""
    return packing.digests(packing.pack(table(spark, folder, "documents"), tokenizer()))


@query
def op10_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Write all pages as seekable archives, read the archives, resolve the revisits."""
    return warc.records(warc.read(spark, warc.write(table(spark, folder, "pages"))))


@query
def op11_text_density(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_density.extract(table(spark, folder, "pages"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes that the rebuilt conversations share."""
    return prefix_trie.rebuilt_trie(table(spark, folder, "conversations")).drop("a", "b")


@query
def op13_aho_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return lexical_scan.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op10_warc_bundles"] = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100
    GROUP BY payload_digest HAVING count(*) > 1
), referred AS (
    SELECT payloads.*, CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
    FROM payloads LEFT JOIN firsts USING (payload_digest)
)
SELECT page_id, payload_bytes, payload_digest, refers_to,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type
FROM referred
"""

SQL["op12_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
        sha256(coalesce(text, ''))) AS place, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(said ORDER BY place) AS said, conv_id - conv_id % 100 AS first,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
            lambda x: ascii(x)::BIGINT)), lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, step: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
    FROM turns GROUP BY conv_id
), convs AS (
    SELECT own.conv_id, list_concat(coalesce(opening.said[1:own.h], []), own.said[own.h + 1:]) AS said
    FROM own LEFT JOIN own AS opening ON own.first = opening.conv_id
), whole AS (
    SELECT said, len(said) AS length, count(*) AS n, min(conv_id) AS conv_id,
        sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM convs GROUP BY said
), paths AS (
    SELECT unnest(range(0, length + 1)) AS depth, said AS all_said, length, n, conv_id FROM whole
), found AS (
    SELECT depth, all_said[1:depth] AS said, sum(n)::BIGINT AS n_convs, min(conv_id) AS conv_id, max(length) AS longest
    FROM paths GROUP BY ALL
), worth AS (
    SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(said[depth].text) END AS saved,
        unnest(range(0, depth + 1)) AS above FROM found
), sums AS (
    SELECT above AS depth, said[1:above] AS said, sum(saved)::BIGINT AS saved_tokens,
        count(*) FILTER (longest = worth.depth) AS n_leaves, count(*) FILTER (worth.depth = above + 1) AS n_children
    FROM worth GROUP BY ALL
)
SELECT found.conv_id, found.depth, up.conv_id AS parent_conv_id, found.n_convs, n_children, n_leaves, saved_tokens,
    coalesce(ends, sha256('')) AS ends_sha256
FROM found JOIN sums ON found.depth = sums.depth AND found.said = sums.said
LEFT JOIN whole ON found.said = whole.said
LEFT JOIN found AS up ON up.depth = found.depth - 1 AND up.said = found.said[1:found.depth - 1]
"""

SQL["op13_aho_scan"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), texts AS (
    SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id
), wanted AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts) GROUP BY item_id, term
), totals AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0
), held AS (
    SELECT r, doc_id, length, term, count(*) AS tf FROM (
        SELECT r, doc_id, len(terms) AS length, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY r, doc_id, length, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, totals GROUP BY term
), scored AS (
    SELECT item_id, r, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * length * n_docs) // n_terms))))::BIGINT AS score
    FROM held JOIN weights USING (term) JOIN wanted USING (term), totals WHERE doc_id IS NOT NULL GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

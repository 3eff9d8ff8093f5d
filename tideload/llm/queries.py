"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.llm.chat import format_chats, read_back
from tideload.llm.common import read_table
from tideload.llm.decontamination import UNITS, contaminated
from tideload.llm.divergence import source_divergence
from tideload.llm.line_dedup import dedup_lines
from tideload.llm.main_text import extract_text
from tideload.llm.packing import pack, pieces
from tideload.llm.passages import shared_passages
from tideload.llm.prefix_trie import prefix_trie
from tideload.llm.sharding import fill_table, place
from tideload.llm.simhash import simhash_components
from tideload.llm.topk import top_k
from tideload.llm.toxicity import fit, fold, score
from tideload.llm.warc import read_archives, write_archives
from tideload.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder) with its SQL, if SQL can express it."""

    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query(
    "op1_decontamination",
    r"""
    WITH plain AS (
        SELECT 'doc' AS side, doc_id AS id, trim(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]+', ' ', 'g')) AS plain
        FROM documents
        UNION ALL
        SELECT 'item', min(item_id), trim(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]+', ' ', 'g')) AS plain
        FROM benchmark GROUP BY plain
    ), quantified AS (
        SELECT side, id, plain,
               replace(regexp_replace(replace(regexp_replace(plain, '(^| )\p{N}[^ ]*', '\1#', 'g'), ' ', '  '),
                       '#  (?i:UNITS)( |$)', '#  %\1', 'g'), '  ', ' ') AS marked
        FROM plain WHERE plain <> ''
    ), word AS (
        SELECT side, id, 0 AS form, string_split(plain, ' ') AS raw,
               string_split(regexp_replace(marked, '(^| )\p{Lu}[^ ]*', '\1@', 'g'), ' ') AS canon FROM quantified
        UNION ALL SELECT side, id, 1, string_split(lower(plain), ' '), string_split(lower(marked), ' ') FROM quantified
        UNION ALL SELECT side, id, 2, string_split(lower(plain), ' '), string_split(lower(plain), ' ') FROM quantified
    ), option AS (
        SELECT id AS item_id, form, len(raw) AS words, begin_at, length, least(begin_at, len(raw) - length) AS place, raw, canon
        FROM (
            SELECT *, unnest(range(0, len(raw) - least(len(raw), 8) + 1)) AS begin_at
            FROM word WHERE side = 'item' AND len(raw) >= 5 AND id IS NOT NULL
        ), (SELECT unnest([5, 6, 7, 8, 16, 32, 64, 128, 256, 512, 1024]) AS length)
        WHERE length BETWEEN least(len(raw), 8) AND len(raw)
    ), item_window AS (
        SELECT item_id, form, words, begin_at, length, place, canon[place + 1 : place + length] AS template,
               raw[place + 1 : place + length] AS theirs,
               len(list_filter(canon[place + 1 : place + length], lambda w: w NOT IN ('#', '%', '@'))) AS literals
        FROM option
    ), wanted AS (
        SELECT item_id, form, begin_at, min(length) AS length FROM item_window WHERE form < 2 AND literals >= 5 GROUP BY ALL
        UNION ALL
        SELECT item_id, 2, begin_at, length FROM item_window WHERE form = 1 AND literals < 5 AND length = least(words, 8)
    ), telling AS (
        SELECT DISTINCT item_id, form, words, length, place, template, theirs
        FROM item_window JOIN wanted USING (item_id, form, begin_at, length)
    ), doc_window AS (
        SELECT id AS doc_id, form, pos, length, canon[pos + 1 : pos + length] AS template, raw[pos + 1 : pos + length] AS ours
        FROM (
            SELECT *, unnest(range(0, len(raw) - length + 1)) AS pos
            FROM word JOIN (SELECT DISTINCT form, length FROM telling) USING (form) WHERE side = 'doc' AND len(raw) >= length
        )
    ), matched AS (
        SELECT DISTINCT doc_id, item_id, form, words, length, place, pos - place AS diagonal, template, theirs, ours
        FROM doc_window JOIN telling USING (form, length, template)
    ), slot AS (
        SELECT doc_id, item_id, diagonal, kind, a, b, count(*) AS n
        FROM (
            SELECT DISTINCT doc_id, item_id, diagonal, spot, kind, CASE WHEN kind = '@' THEN a ELSE lower(a) END AS a,
                   CASE WHEN kind = '@' THEN b ELSE lower(b) END AS b
            FROM (
                SELECT doc_id, item_id, diagonal, unnest(range(place, place + length)) AS spot, unnest(template) AS kind,
                       unnest(theirs) AS a, unnest(ours) AS b FROM matched
            ) WHERE kind IN ('#', '%', '@')
        ) GROUP BY ALL
    ), unlike AS (
        SELECT doc_id, item_id, diagonal
        FROM (SELECT doc_id, item_id, diagonal, kind, a, sum(n) AS n, max(n) AS most FROM slot GROUP BY ALL)
        GROUP BY doc_id, item_id, diagonal, kind HAVING sum(most) / sum(n) < 0.8
        UNION
        SELECT doc_id, item_id, diagonal
        FROM (SELECT doc_id, item_id, diagonal, kind, b, sum(n) AS n, max(n) AS most FROM slot GROUP BY ALL)
        GROUP BY doc_id, item_id, diagonal, kind HAVING sum(most) / sum(n) < 0.8
    ), covered AS (
        SELECT doc_id, item_id, words, count(DISTINCT pos) AS covered
        FROM (
            SELECT doc_id, item_id, words, unnest(range(place, place + length)) AS pos
            FROM matched ANTI JOIN unlike USING (doc_id, item_id, diagonal)
        ) GROUP BY ALL
    )
    SELECT doc_id, item_id, covered::INT AS covered_words, words::INT AS item_words
    FROM covered WHERE covered >= least(12, words)
    """.replace("UNITS", UNITS.replace(" ", "|")),
)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents in which benchmark items are found, and the items."""
    found = contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


@query("op2_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, folder, "labels"))
    scored = score(docs, model, threshold=0.7)
    return scored.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "score", "predicted")


@query("op3_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(read_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    "op4_warc_writer",
    r"""
    WITH page AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
    ), held AS (
        SELECT *, min(page_id) OVER (PARTITION BY hex) AS holder FROM page
    )
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '')
               AS payload_digest,
           CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> holder THEN holder END AS refers_to
    FROM held
    """,
)
def warc_writer(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    path = fresh_dir(spark, "archives")
    write_archives(pages, path, min_bytes=0)
    found = read_archives(spark, path, with_payload=False)
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


SHARDS = [f"shard-{i:03d}" for i in range(48)]


@query("op6_sharding")
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document, and the one it has once the last shard is gone."""
    fewer = SHARDS[:-1]
    tables = {"shard": (SHARDS, fill_table(SHARDS)), "shard_after_loss": (fewer, fill_table(fewer))}
    # Whole rows, so that those without an id are told apart.
    placed = place(read_table(spark, folder, "documents"), ["doc_id"], tables)
    return placed.select("doc_id", *tables)


def vocabulary_path() -> str:
    """The public vocabulary the contract names, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_packing")
def packing(spark: SparkSession, folder: str) -> DataFrame:
    return pieces(pack(read_table(spark, folder, "documents"), vocabulary_path(), limit=1024))


# A conversation that looks like the marks of several templates, beside those of the table.
TRICKY_TEXT = "\\### Assistant: </turn> ok"


@query(
    "op7_chat_formatting",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), sized AS (
        SELECT *, length(regexp_replace(role || text, '([\\<>])', '.\1', 'g')) + 17 AS chars FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_TEXT).alias("text"),
    )
    return read_back(format_chats(table.unionByName(tricky)))


@query("op8_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = shared_passages(read_table(spark, folder, "documents"))
    return found.withColumnsRenamed({"doc": "doc_id", "holder": "source_doc_id", "start": "start_word", "end": "end_word",
                                     "holder_start": "source_start_word", "holder_end": "source_end_word"})


@query(
    "op9_line_dedup",
    r"""
    WITH line AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents
    ), keyed AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM line
    ), holder AS (
        SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    )
    SELECT doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE holder IS NOT NULL AND doc_id > holder) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                           FILTER (WHERE holder IS NULL OR doc_id <= holder), '')) AS kept_sha256
    FROM keyed LEFT JOIN holder USING (key)
    GROUP BY doc_id
    """,
)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = dedup_lines(read_table(spark, folder, "documents"), min_chars=10, batches=4, fanout=2)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op10_top_k_search",
    """
    WITH vector AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS numbers FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), pair AS (
        SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.numbers, b.numbers)::BIGINT AS score
        FROM vector a JOIN vector b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id
    )
    SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score
    FROM pair
    WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 10
    """,
)
def top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


# The one kind of page the given tables hold; pages of other kinds are tested in tests/llm.
@query(
    "op11_html_extraction",
    r"""
    WITH article AS (
        SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS marked FROM pages
    ), block AS (
        SELECT page_id, url, list_transform(
            regexp_split_to_array(marked, '</?(p|h1)>'),
            lambda b: trim(regexp_replace(replace(regexp_replace(replace(
                regexp_replace(replace(b, '<br>', ' '), '</?b>', '', 'g'),
                '&quot;', '"'), '&amp;?', '&', 'g'), chr(160), ' '), '\s+', ' ', 'g'))) AS blocks
        FROM article
    ), joined AS (
        SELECT page_id, url, coalesce(array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)), '') AS text
        FROM block
    )
    SELECT *, length(text) AS n_chars FROM joined
    """,
)
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(read_table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query(
    "op12_conversation_prefix_trie",
    r"""
    WITH turn AS (
        SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), length AS (
        SELECT conv, count(*) AS turns FROM turn GROUP BY conv
    ), conv AS (
        SELECT l.conv, l.turns, l.conv - l.conv % 5 AS base, coalesce(b.turns, 0) AS base_turns,
               xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(string_split(l.conv::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda crc, byte: list_reduce(
                       list_prepend(xor(crc, byte), range(8)),
                       lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295) % 9 AS head
        FROM length l LEFT JOIN length b ON b.conv = l.conv - l.conv % 5
    ), rebuilt AS (
        SELECT conv, place - head + least(head, base_turns) AS depth, role, text FROM turn JOIN conv USING (conv) WHERE place > head
        UNION ALL
        SELECT c.conv, place, role, text FROM conv c JOIN turn t ON t.conv = c.base AND place <= head
    ), total AS (
        SELECT c.conv, count(r.conv) AS total FROM conv c LEFT JOIN rebuilt r USING (conv) GROUP BY c.conv
    ), prefix AS (
        SELECT conv, depth, octet_length(encode(text)) AS bytes,
               list(struct_pack(role, text)) OVER (PARTITION BY conv ORDER BY depth) AS path
        FROM rebuilt
        UNION ALL SELECT conv, 0, 0, [] FROM conv
    ), member AS (
        SELECT conv, depth, bytes, min(conv) OVER (PARTITION BY path) AS owner FROM prefix
    ), node AS (
        SELECT owner, depth, count(*) AS n_convs, max(bytes) AS bytes FROM member GROUP BY ALL
    ), child AS (
        SELECT n.owner, n.depth, up.owner AS parent
        FROM node n LEFT JOIN member up ON up.conv = n.owner AND up.depth = n.depth - 1
    ), children AS (
        SELECT parent AS owner, depth - 1 AS depth, count(*) AS n_children FROM child WHERE depth > 0 GROUP BY ALL
    ), known AS (
        SELECT owner, depth, n_convs, bytes, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN children USING (owner, depth)
    ), subtree AS (
        SELECT m.owner, m.depth, sum((k.n_convs - 1) * k.bytes) AS saved_tokens, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves
        FROM known k JOIN member m ON m.conv = k.owner AND m.depth <= k.depth GROUP BY ALL
    ), ended AS (
        SELECT owner, depth, sha256(string_agg(conv::VARCHAR, ',' ORDER BY conv)) AS ends_sha256
        FROM member JOIN total USING (conv) WHERE depth = total GROUP BY ALL
    )
    SELECT owner AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves,
           saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM known JOIN child USING (owner, depth) JOIN subtree USING (owner, depth) LEFT JOIN ended USING (owner, depth)
    """,
)
def conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(read_table(spark, folder, "conversations"))


@query(
    "op13_source_divergence_audit",
    r"""
    WITH doc AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), word AS (
        SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc
    ), counted AS (
        SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM word GROUP BY ALL
    ), kept AS (
        SELECT lang, term, sum(n) AS lang_n FROM counted GROUP BY ALL HAVING sum(docs) >= 30
    ), vocabulary AS (
        SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
    ), grp AS (
        SELECT DISTINCT lang, source FROM doc
    ), cell AS (
        SELECT lang, source, term, coalesce(n, 0) AS n, lang_n
        FROM grp JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
    ), p AS (
        SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
               1 + 1000000000::HUGEINT * (lang_n + 5) // (lang_total + 5 * v) AS q
        FROM cell JOIN vocabulary USING (lang)
    ), pair AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
        FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
        LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
        GROUP BY ALL
    ), term AS (
        SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
        FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
)
def source_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(read_table(spark, folder, "documents"))

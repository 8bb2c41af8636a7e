"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann, chat, exact_dedup, langid, lines, merkle, mixing, packing, pii, quality, simhash, trie, warc
from tidemark.llm.ranks import ascii_lower
from tidemark.llm.scratch import small_batches
from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(read) -> DataFrame``; ``read`` gives a table of the data folder by name."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            small_batches(tune(spark))
            return fn(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def remainder(id_col: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % divisor


def _crc(value: str) -> str:
    """SQL of the unsigned CRC-32 of ``value`` as text, byte by byte and bit by bit."""
    text = f"cast({value} as varchar)"
    return f"""xor(list_reduce(list_prepend(4294967295::bigint,
        list_transform(range(length({text})), lambda i: ascii(substr({text}, i + 1, 1))::bigint)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))),
        4294967295)"""


@query("op1_quality")
def op1(read):
    docs = read("documents")
    model = quality.train(docs.filter(remainder("doc_id", 5) != 0), read("labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query(
    "op2_exact_dedup",
    r"""
    WITH norm AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS body
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           doc_id = first_value(doc_id) OVER best AS kept,
           sha256(body) AS text_sha256
    FROM norm
    WINDOW best AS (PARTITION BY body ORDER BY points DESC, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def op2(read):
    return exact_dedup.exact_groups(read("documents"))


@query(
    "op3_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id, strlen(html) AS bytes FROM p)
    SELECT page_id, bytes AS payload_bytes, sha256(html) AS payload_digest,
           CASE WHEN bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op3(read):
    pages = read("pages")
    archive = warc.write_archive(pages)
    return warc.read_back(warc.read_archive(pages.sparkSession, archive))


@query("op4_pii")
def op4(read):
    docs = read("documents")
    return pii.find(docs, pii.train(docs))


@query("op5_packing")
def op5(read):
    return packing.pack(read("documents"))


@query("op6_simhash")
def op6(read):
    return simhash.near_groups(read("documents"))


@query("op7_ann")
def op7(read):
    return ann.nearest(read("embeddings"))


#: The conversation that the contract adds: control strings of another template as texts.
_ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query(
    "op8_chat",
    r"""
    WITH c AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
    ),
    e AS (
        SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
               regexp_replace(text, '([<\[])(\\*)(\||/?s>|</?SYS>>|start_of_turn>|end_of_turn>|bos>|eos>|pad>|unk>|/?INST\])',
                              '\1\\\2\3', 'g') AS shown
        FROM c
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           cast(sum(length(loss)) AS BIGINT) AS loss_chars,
           sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
           cast(sum(length('<|turn|>') + length(role) + length('<|body|>') + length(shown) + length('<|end|>')) AS BIGINT)
               AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op8(read):
    turns = read("conversations").select("conv_id", "turn", "role", "text")
    added = turns.sparkSession.createDataFrame(_ADDED, turns.schema)
    text_part = F.struct(
        F.lit("text").alias("kind"), F.col("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")
    )
    chats = chat.format_chats(turns.unionByName(added).select("conv_id", "turn", "role", F.array(text_part).alias("parts")))
    return chat.read_back(chats).withColumnRenamed("conv", "conv_id")


@query("op9_langid")
def op9(read):
    docs = read("documents")
    model = langid.train(docs.filter(remainder("doc_id", 4) != 2))
    out = langid.predict(docs, model)
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query(
    "op10_mixing",
    r"""
    WITH sized AS (
        SELECT doc_id, source,
               cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
        FROM documents
    ),
    src AS (
        SELECT source, cast(sum(size) AS BIGINT) AS source_size,
               [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
        FROM sized GROUP BY source
    ),
    levels AS (
        SELECT *, 2 * source_size / weight AS room,
               ((SELECT sum(source_size) FROM src)::DOUBLE * 1.5
                - 2 * coalesce(sum(source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
               / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM src
    ),
    goal AS (
        SELECT source, source_size,
               least((2 * source_size)::DOUBLE,
                     (SELECT level FROM levels WHERE level <= room ORDER BY room, level LIMIT 1) * weight) AS target
        FROM levels
    ),
    steps AS (
        SELECT *, CASE WHEN source_size > 0 THEN cast(round(target / source_size * 1000000) AS BIGINT) ELSE 0 END AS step,
               cast('0x' || substr(md5('0:' || coalesce(source, '')), 1, 7) AS BIGINT) % 1000000 AS off
        FROM goal
    ),
    laid AS (
        SELECT d.doc_id, d.source, d.size, s.source_size, s.target, s.step, s.off,
               8 * greatest(length(bin(d.size)) - 3, 0) + (d.size >> greatest(length(bin(d.size)) - 3, 0)::BIGINT) AS class,
               cast('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':' || d.size), 1, 6) AS BIGINT) % 64 AS salt
        FROM sized d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
    ),
    placed AS (
        SELECT *, coalesce(sum(step) OVER (PARTITION BY source ORDER BY class, salt, size, doc_id
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + off AS spot
        FROM laid
    )
    SELECT doc_id, size, source_size, target, ((spot + step) // 1000000 - spot // 1000000) * size AS taken
    FROM placed
    """,
)
def op10(read):
    return mixing.mix(read("documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op11_merkle",
    r"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, source,
               sha256(concat(
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
                   coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
               sha256(concat(
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
                   coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))) AS lower_leaf
        FROM documents
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY source) AS n,
               CASE WHEN __CRC__ % 5 = 0 THEN lower_leaf ELSE leaf END AS now
        FROM leaves
    ),
    low(source, lvl, pos, n, digest) AS (
        SELECT source, 0, pos, n, leaf FROM placed
        UNION ALL
        SELECT source, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
        FROM low WHERE n > 1 GROUP BY source, lvl, pos // 16, n
    ),
    subroots AS (
        SELECT source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM low WHERE n = 1
    ),
    high(lvl, pos, n, digest) AS (
        SELECT 0, pos, n, digest FROM subroots
        UNION ALL
        SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
        FROM high WHERE n > 1 GROUP BY lvl, pos // 16, n
    ),
    nodes AS (
        SELECT source, false AS up, lvl, pos, digest FROM low WHERE n > 1
        UNION ALL SELECT NULL, true, lvl, pos, digest FROM high WHERE n > 1
    ),
    runs AS (
        SELECT source, up, lvl, pos // 16 AS run, list(digest ORDER BY pos) AS members FROM nodes GROUP BY source, up, lvl, pos // 16
    ),
    steps AS (
        SELECT p.doc_id, p.leaf, p.source,
               row_number() OVER (PARTITION BY p.doc_id, p.source, p.pos ORDER BY r.up, r.lvl) AS step, p.pos AS leaf_pos,
               array_to_string(r.members[1:(CASE WHEN r.up THEN s.pos ELSE p.pos END // (16 ** r.lvl)::BIGINT) % 16], '') AS lefts,
               array_to_string(r.members[(CASE WHEN r.up THEN s.pos ELSE p.pos END // (16 ** r.lvl)::BIGINT) % 16 + 2:], '') AS rights
        FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
        JOIN runs r ON (r.up OR r.source IS NOT DISTINCT FROM p.source)
             AND r.run = CASE WHEN r.up THEN s.pos ELSE p.pos END // (16 ** (r.lvl + 1))::BIGINT
    ),
    proofs AS (
        SELECT source, leaf_pos, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof FROM steps GROUP BY source, leaf_pos
    ),
    folds(source, pos, step, digest) AS (
        SELECT source, pos, 0, now FROM placed
        UNION ALL
        SELECT f.source, f.pos, f.step + 1, sha256(concat(s.lefts, f.digest, s.rights))
        FROM folds f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.leaf_pos = f.pos AND s.step = f.step + 1
    ),
    folded AS (SELECT source, pos, arg_max(digest, step) AS digest FROM folds GROUP BY source, pos)
    SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
           f.digest AS folded_root, f.digest = t.digest AS verified
    FROM placed p
    JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
    JOIN folded f ON f.source IS NOT DISTINCT FROM p.source AND f.pos = p.pos
    LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.leaf_pos = p.pos
    CROSS JOIN (SELECT digest FROM high WHERE n = 1) t
    """.replace("__CRC__", _crc("doc_id")),
)
def op11(read):
    docs = read("documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    proofs = merkle.dataset_proofs(
        docs, "doc_id", "source", columns, {"text": ascii_lower(F.col("text"))}, remainder("doc_id", 5) == 0
    )
    return proofs.withColumnRenamed("id", "doc_id")


@query(
    "op12_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ),
    shared AS (
        SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ),
    marked AS (
        SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.top AS gone FROM keyed k LEFT JOIN shared s USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op12(read):
    kept = lines.drop_lines(read("documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op13_prefix_trie",
    r"""
    WITH turns AS (
        SELECT conv_id AS conv, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
               strlen(coalesce(text, '')) AS size, turn
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, key) - 1 AS pos FROM turns),
    convs AS (SELECT DISTINCT conv, __CRC__ % 9 AS h FROM turns),
    rebuilt AS (
        SELECT c.conv, 0 AS part, p.pos, p.key, p.size FROM convs c JOIN placed p ON p.conv = c.conv - c.conv % 5 AND p.pos < c.h
        UNION ALL
        SELECT c.conv, 1, p.pos, p.key, p.size FROM convs c JOIN placed p ON p.conv = c.conv AND p.pos >= c.h
    ),
    paths AS (
        SELECT conv, list(key) OVER deep AS path, size, count(*) OVER (PARTITION BY conv) AS n_turns FROM rebuilt
        WINDOW deep AS (PARTITION BY conv ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ),
    members AS (
        SELECT conv, path, size, len(path) = n_turns AS here FROM paths
        UNION ALL
        SELECT conv, []::VARCHAR[], 0, conv NOT IN (SELECT conv FROM rebuilt) FROM convs
    ),
    nodes AS (
        SELECT path, len(path) AS depth, min(conv) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
               sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (here), '')) AS ends_sha256
        FROM members GROUP BY path
    ),
    kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    wide AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path)),
    below AS (
        SELECT path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(depth + 1)) AS up FROM wide) GROUP BY 1
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
           b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM wide n JOIN below b USING (path)
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
    """.replace("__CRC__", _crc("conv")),
)
def op13(read):
    nodes = trie.trie(trie.sequences(read("conversations"), head=remainder("conv", 9)))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


QUERIES["pipeline"] = corpus_pipeline.run

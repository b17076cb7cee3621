"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from rambler.llm.ann import nearest
from rambler.llm.chat_format import format_chats, read_digests
from rambler.llm.common import held_out, table
from rambler.llm.decontaminate import decontaminate
from rambler.llm.language_id import language_id
from rambler.llm.mixing import mix
from rambler.llm.near_dup import near_duplicates
from rambler.llm.periodic_runs import periodic_runs
from rambler.llm.prefix_trie import conversation_trie
from rambler.llm.secret_scan import secret_scan
from rambler.llm.sentencepiece_lattice import encode, read_pieces
from rambler.llm.token_counts import token_counts
from rambler.llm.toxicity import toxicity
from rambler.llm.token_file import read_digests as token_digests, write_tokens
from rambler.session import materialize, scratch_path

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_secret_scan(spark, sf_dir):
    found = secret_scan(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")


def op9_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), BYTE_BPE, scratch_path(spark, "token-cache"))


def op2_sentencepiece(spark, sf_dir):
    pieces = read_pieces(PIECE_BPE)
    encoded = encode(table(spark, sf_dir, "documents"), pieces, keep_text=True, decoded_col="decoded")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                          (F.col("decoded") == F.col("text")).alias("round_trip"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark, sf_dir):
    held = held_out("doc_id", 3, 1)
    found = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), training=~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op5_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_file(spark, sf_dir):
    file = write_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, path=scratch_path(spark, "token-file"))
    return token_digests(spark, file).withColumnRenamed("doc", "doc_id")


def op7_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_chat_format(spark, sf_dir):
    planted = spark.createDataFrame([(-7, k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))],
                                    "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return read_digests(materialize(format_chats(turns), "chats"))


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id(docs, training=~held_out("doc_id", 4, 2))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op11_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_prefix_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


def _looped(docs):
    """op13's input: in documents with crc32(doc_id) % 10 = 0, the words from ``a`` on repeat the first ``p`` of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n, a, p = F.floor(h / 10), F.size("words"), F.col("a"), F.col("p")
    words = docs.select("doc_id", "text", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"))
    placed = (words.withColumn("a", F.when((h % 10 == 0) & (n > 0), (g % n).cast("int")))
              .withColumn("p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int")))
    turns = F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(F.flatten(turns), F.lit(1), n - a)), " ")
    return placed.select("doc_id", F.when(a.isNull(), F.col("text")).otherwise(text).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(_looped(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_sentencepiece, op3_decontaminate, op4_toxicity, op5_near_duplicates, op6_token_file, op7_nearest, op8_chat_format, op9_token_counts, op10_language_id,
                               op11_mixing, op12_prefix_trie, op13_periodic_runs)}
ORACLE = {"op3_decontaminate": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, list_slice(w, a, a + n - 1) AS g FROM s),
sizes AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, a, n FROM (SELECT doc_id, n, a, list_slice(w, a, a + n - 1) AS g FROM p) JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
   FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_chat_format": """
WITH t AS (SELECT conv_id, turn, coalesce(role,'') AS role, coalesce(text,'') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\e') AS body,
 replace(replace(replace(replace(role, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\e'), ':', '\\c') AS head FROM t)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length(head) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    # every quotient of every source and shard is listed here, and every block of every document
    "op11_mixing": """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT *, [1, 2, 3][rank % 3 + 1] AS weight FROM (
   SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM d GROUP BY source) x),
c AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS words,
   sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights
   FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT words, weights FROM c WHERE 3 * source_size * weights > words * weight ORDER BY 3 * source_size / weight, rank LIMIT 1),
t AS (SELECT s.*, least(3.0 * source_size, coalesce((SELECT weight * words / weights FROM f), 3.0 * source_size))::DOUBLE AS target FROM s),
p AS (SELECT *, CAST(round(target * n / source_size * 1000) AS BIGINT) AS votes FROM (
   SELECT *, CAST(greatest(round(source_size / 32), 1) AS BIGINT) AS n FROM t WHERE source_size > 0) x),
q AS (SELECT rank, votes / (2 * k - 1) AS quotient, k FROM (SELECT rank, votes, unnest(range(1, 3 * n + 1)) AS k FROM p) x),
won AS (SELECT rank, count(*) AS seats FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, rank, k) AS place FROM q) x
   WHERE place <= (SELECT floor((sum(votes) + 500) / 1000) FROM p) GROUP BY rank),
a AS (SELECT p.*, coalesce(seats, 0) AS seats FROM p LEFT JOIN won USING (rank)),
sh AS (SELECT rank, n, seats % n AS rest, shard, least(n - shard * 16384, 16384) AS votes
   FROM (SELECT rank, n, seats, unnest(range(0, CAST(ceil(n / 16384) AS BIGINT))) AS shard FROM a) x),
sq AS (SELECT *, votes / (2 * k - 1) AS quotient, md5('11|shard|' || rank || '|' || shard) AS tie
   FROM (SELECT *, unnest(range(1, votes + 1)) AS k FROM sh) x),
quota AS (SELECT rank, shard, count(*) AS quota FROM (
   SELECT *, row_number() OVER (PARTITION BY rank ORDER BY quotient DESC, tie, k) AS place FROM sq) x WHERE place <= rest GROUP BY rank, shard),
b AS (SELECT *, row_number() OVER (PARTITION BY rank, shard ORDER BY md5('11|block|' || rank || '|' || block)) AS place FROM (
   SELECT rank, n, source_size, block, block // 16384 AS shard FROM (SELECT rank, n, source_size, unnest(range(0, n)) AS block FROM a) x) y),
chosen AS (SELECT rank, block * 32 AS f, CASE WHEN block = n - 1 THEN source_size ELSE (block + 1) * 32 END AS e
   FROM b JOIN quota USING (rank, shard) WHERE place <= quota),
w AS (SELECT *, CAST(sum(size) OVER (PARTITION BY rank ORDER BY md5('11|doc|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || size),
   doc_id, size, row ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS f
   FROM (SELECT d.*, rank, source_size, target, row_number() OVER () AS row FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source) x),
x AS (SELECT w.row, sum(least(w.f + w.size, c.e) - greatest(w.f, c.f)) AS extra
   FROM w JOIN chosen c ON c.rank = w.rank AND c.f < w.f + w.size AND c.e > w.f GROUP BY w.row)
SELECT w.doc_id, w.size, w.source_size, w.target, CAST(coalesce(a.seats // a.n, 0) * w.size + coalesce(x.extra, 0) AS BIGINT) AS taken
FROM w LEFT JOIN a USING (rank) LEFT JOIN x USING (row)""",
    # crc32 byte by byte and bit by bit; a prefix is the list of its turns' digests
    "op12_prefix_trie": """
WITH t AS (SELECT conv_id, sha256(length(role) || ':' || role || text) AS turn_sha, length(text) AS chars,
   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) - 1 AS place
   FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) x),
c AS (SELECT conv_id, count(*) AS n, conv_id - (conv_id % 100 + 100) % 100 AS first, xor(4294967295, list_reduce(list_concat([4294967295],
   flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
   lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc // 2, CASE WHEN crc % 2 = 1 THEN 3988292384 ELSE 0 END) END)) % 6 AS h
   FROM t GROUP BY conv_id),
r AS (SELECT t.conv_id, place + 10 AS place, turn_sha, chars FROM t JOIN c USING (conv_id) WHERE place >= h
   UNION ALL SELECT c.conv_id, place, turn_sha, chars FROM c JOIN t ON t.conv_id = c.first WHERE place < h),
s AS (SELECT c.conv_id, coalesce(list(turn_sha ORDER BY place) FILTER (turn_sha IS NOT NULL), []) AS l,
   list(chars ORDER BY place) AS chars FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, l[:d] AS key, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, len(l) = d AS ends
   FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM s) x),
n AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY key, d),
k AS (SELECT key[:d - 1] AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
u AS (SELECT key[:up] AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
   FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM m) x GROUP BY 1)
SELECT m.conv_id, m.d AS depth, CASE WHEN m.d > 0 THEN a.conv_id END AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves,
   CAST(u.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN u USING (key) LEFT JOIN n a ON m.d > 0 AND a.key = m.key[:m.d - 1]"""}

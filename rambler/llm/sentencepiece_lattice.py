"""SentencePiece encoding and decoding as a relational lattice.

No piece of the table crosses the beginning of a word (a run of the space mark and what follows), so
words are encoded on their own, each distinct one of a chunk of documents once:

1. words that occur often are encoded once for all documents, as below, and broadcast;
2. documents are dealt to chunks by a hash, the one exchange; all that follows stays in place;
3. a chunk's other distinct words are exploded into their substrings of at most the longest piece's length;
4. an equi-join with the piece table (as large as the tokenizer, so broadcast) leaves the lattice's edges; it is
   keyed by a 64-bit hash, and what it finds is compared as text;
5. edges are grouped by word and folded with Spark's ``aggregate``;
6. each document's ids are put together from its words, where its chunk's words meet it.

Which words are encoded ahead decides only how often a word is encoded, never its ids: it is told from some
documents, by a hash, and a word that isn't among them takes the other way.  A word is kept without its
space mark if that is all that the mark does (``_bare``).

The fold depends on the model.  For a unigram model it is Viterbi: the best score of each end and the
edge it comes by.  For a BPE model the library's result is no best path, so Viterbi can't give it:
edges are folded in order of score, and an edge is taken if it covers exactly two present symbols.  As
a piece scores lower than the pieces it is merged from, this is the library's merge order.  Pieces of
equal score (runs of spaces) are merged after all others, leftmost first, one by one.

Characters without a piece become byte pieces.  Ids equal those of the library for the same model.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rambler.llm.bpe import _gather
from rambler.llm.common import give_back
from rambler.session import materialize

MARK = "▁"
CHUNK_BYTES = 2 << 20   # of text; bounds what a task holds at once
OFTEN = 1 << 20         # words that are encoded ahead, at most
GAUGE_BYTES = 128 << 20  # of text that these words are told from
BLOCK = 128        # long words are cut into blocks of so many characters before their substrings are taken
SHORT = 61         # characters whose boundaries fit a number
MOST_PIECES = 1 << 20


@dataclass(frozen=True)
class Pieces:
    """A model's table: normal pieces with ids and scores, byte pieces, and whether it is unigram."""

    ids: dict
    scores: dict
    bytes_at: int | None   # id of the piece of byte 0; those of the others follow
    unknown: int
    unigram: bool

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    @property
    def longest_run(self) -> int:
        return max((len(p) for p in self.ids if not p.strip(MARK)), default=1)

    def words(self) -> str:
        """The pattern of words; runs of spaces are cut after the longest piece of spaces."""
        return f"{MARK}{{{self.longest_run}}}(?={MARK})|{MARK}+[^{MARK}]*|[^{MARK}]+"


def read_pieces(path: str) -> Pieces:
    """The table of a model file.  It must escape spaces, add a space in front, and leave texts else as
    they are; no piece may hold a space after another character."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
        raise ValueError("only models with identity normalisation and a space in front are supported")
    p = SentencePieceProcessor(model_file=path)
    normal = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    ids = {p.id_to_piece(i): i for i in normal}
    if any(MARK in piece.lstrip(MARK) for piece in ids):
        raise ValueError("a piece crosses the beginning of a word")
    byte = [i for i in range(p.get_piece_size()) if p.is_byte(i)]
    return Pieces(ids, {p.id_to_piece(i): p.get_score(i) for i in normal}, byte[0] if byte else None, p.unk_id(), model.trainer_spec.model_type == 1)


def _table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """``(known, hash, rank, score)`` of each piece; rank 0 is the best score."""
    if len(pieces.ids) > MOST_PIECES:
        raise ValueError(f"more than {MOST_PIECES} pieces are not broadcast")
    rank = {score: k for k, score in enumerate(sorted(set(pieces.scores.values()), reverse=True))}
    rows = [(p, rank[s], s) for p, s in pieces.scores.items() if pieces.unigram or len(p) > 1]
    return F.broadcast(spark.createDataFrame(rows, "known string, rank long, score double").withColumn("hash", F.xxhash64("known")))


def _tied_rank(pieces: Pieces) -> int:
    """The rank that several pieces of two or more characters share; only the last may."""
    ranks = sorted(set(pieces.scores.values()), reverse=True)
    many = [s for s, n in Counter(s for p, s in pieces.scores.items() if len(p) > 1).items() if n > 1]
    longer = sorted({s for p, s in pieces.scores.items() if len(p) > 1}, reverse=True)
    if many and many != longer[-1:]:
        raise ValueError("pieces of equal score that aren't the last")
    return ranks.index(many[0]) if many else len(ranks)


def edges(words: DataFrame, table: DataFrame, longest: int, least: int) -> DataFrame:
    """``words`` (.., word, n) with a row for each substring that is a piece: ``start``, ``size``, rank, score."""
    blocks = words.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / BLOCK).cast("int"))))
    blocks = blocks.withColumn("part", F.expr(f"substring(word, block * {BLOCK} + 1, {BLOCK + longest - 1})")).drop("word")
    starts = blocks.withColumn("within", F.explode(F.expr(f"sequence(0, least({BLOCK}, n - block * {BLOCK}) - 1)")))
    left = f"least({longest}, n - block * {BLOCK} - within)"
    sized = starts.filter(F.expr(f"{left} >= {least}")).withColumn("size", F.explode(F.expr(f"sequence({least}, {left})")))
    cut = sized.withColumn("piece", F.expr("substring(part, within + 1, size)"))
    # keyed by the hash alone, as Spark looks up one number much faster than a string; an equality of strings would become a key too
    same = F.startswith("piece", "known") & F.startswith("known", "piece")
    found = cut.withColumn("at", F.xxhash64("piece")).join(table, (F.col("at") == F.col("hash")) & same)
    return found.withColumn("start", F.expr(f"block * {BLOCK} + within")).drop("piece", "known", "at", "hash", "part", "block", "within")


# An edge of a BPE lattice is a number: rank * 2^40 + start * 2^8 + size.  A boundary is a bit that is
# set; an edge is ready if both its ends are set and exactly one bit between them.
_START, _SIZE = "cast(shiftright(e, 8) & 4294967295L as int)", "cast(e & 255 as int)"


def _merge_short(tied: int) -> str:
    ends = f"(shiftleft(1L, {_START}) | shiftleft(1L, {_START} + {_SIZE}))"
    inside = f"shiftleft(shiftleft(1L, {_SIZE}) - 2L, {_START})"
    masks = f"transform(sort_array(%s), e -> named_struct('ends', {ends}, 'inside', {inside}))"
    ready = "(s & e.ends) = e.ends and bit_count(s & e.inside) = 1"
    fold = f"aggregate({masks}, shiftleft(1L, n + 1) - 1L, (s, e) -> if({ready}, s & ~e.inside, s))"
    last = masks % f"filter(lattice, e -> shiftright(e, 40) >= {tied}L)"
    first = fold % f"filter(lattice, e -> shiftright(e, 40) < {tied}L)"
    return (f"array(if(array_max(lattice) < shiftleft({tied}L, 40), {fold % 'lattice'}, aggregate(sequence(1, n), {first}, (s, k) -> "
            f"coalesce(s & ~get(filter({last}, e -> {ready}), 0).inside, s))))")


def _merge_long(tied: int) -> str:
    """The same over limbs of 32 boundaries; an edge touches two of them."""
    at, shift = f"shiftright({_START}, 5)", f"({_START} & 31)"
    window = f"((shiftright(s[{at}], {shift}) | shiftleft(s[{at} + 1], 32 - {shift})) & (shiftleft(1L, {_SIZE} + 1) - 1L))"
    ends, inside = f"(1L | shiftleft(1L, {_SIZE}))", f"(shiftleft(1L, {_SIZE}) - 2L)"
    ready = f"({window} & {ends}) = {ends} and bit_count({window} & {inside}) = 1"
    low, high = f"(shiftleft({inside}, {shift}) & 4294967295L)", f"shiftright(shiftleft({inside}, {shift}), 32)"
    clear = f"transform(s, (x, k) -> if(k = {at}, x & ~{low}, if(k = {at} + 1, x & ~{high}, x)))"
    full = "transform(sequence(0, shiftright(n, 5) + 1), k -> if(k * 32 > n, 0L, if(k * 32 + 31 <= n, 4294967295L, shiftleft(1L, n - k * 32 + 1) - 1L)))"
    first = f"aggregate(sort_array(filter(lattice, e -> shiftright(e, 40) < {tied}L)), {full}, (s, e) -> if({ready}, {clear}, s))"
    last = f"sort_array(filter(lattice, e -> shiftright(e, 40) >= {tied}L))"
    # every merge of a tied piece takes away a boundary between the first and the last end of them; one that finds none is the last
    most = f"aggregate({last}, named_struct('low', n, 'high', 0), (r, e) -> named_struct('low', least(r.low, {_START}), 'high', greatest(r.high, {_START} + {_SIZE})), r -> r.high - r.low)"
    step = f"aggregate({last}, named_struct('s', a.s, 'more', false), (t, e) -> if(t.more, t, aggregate(array(t.s), t, (u, s) -> if({ready}, named_struct('s', {clear}, 'more', true), u))))"
    merged = f"aggregate(sequence(1, {most}), named_struct('s', {first}, 'more', true), (a, k) -> if(a.more, {step}, a), a -> a.s)"
    return f"if(array_max(lattice) >= shiftleft({tied}L, 40), {merged}, {first})"


def _bpe_cuts(words: DataFrame, keys: list[str], pieces: Pieces, table: DataFrame) -> DataFrame:
    found = edges(words.filter("n > 1"), table, pieces.longest, 2)
    packed = F.expr("shiftleft(rank, 40) + shiftleft(cast(start as long), 8) + size")
    lattice = found.groupBy(*keys, "n").agg(F.collect_list(packed).alias("lattice"))
    tied = _tied_rank(pieces)
    return lattice.select(*keys, F.when(F.col("n") <= SHORT, F.expr(_merge_short(tied))).otherwise(F.expr(_merge_long(tied))).alias("cuts"))


def _viterbi_cuts(words: DataFrame, keys: list[str], pieces: Pieces, table: DataFrame) -> DataFrame:
    """Best path: scores and previous boundaries of ends 0 to n, then back from n.  A character without a
    piece costs 10 more than the worst piece; of equal paths the one whose last piece is longest wins."""
    unknown = min(pieces.scores.values(), default=0.0) - 10
    found = edges(words, table, pieces.longest, 1)
    edge = "named_struct('stop', start + size, 'start', start, 'score', score)"
    lattice = found.groupBy(*keys, "n").agg(F.expr(f"collect_list({edge})").alias("lattice"))
    single = f"transform(sequence(0, n - 1), i -> named_struct('stop', i + 1, 'start', i, 'score', cast({unknown} as double)))"
    lone = f"filter({single}, u -> not exists(lattice, e -> e.start = u.start and e.stop = u.stop))"
    begin = "named_struct('best', transform(sequence(0, n), i -> if(i = 0, 0D, cast('-Infinity' as double))), 'back', transform(sequence(0, n), i -> 0))"
    better = "s.best[e.start] + e.score > s.best[e.stop]"
    put = ("named_struct('best', transform(s.best, (x, i) -> if(i = e.stop, s.best[e.start] + e.score, x)), "
           "'back', transform(s.back, (x, i) -> if(i = e.stop, e.start, x)))")
    back = (f"aggregate(array_sort(concat(lattice, {lone})), {begin}, (s, e) -> if({better}, {put}, s), "
            "s -> aggregate(sequence(1, n), array(n), (p, k) -> if(element_at(p, -1) > 0, array_append(p, s.back[element_at(p, -1)]), p)))")
    # boundaries as limbs of 32, as the other fold gives them
    limbs = f"transform(sequence(0, shiftright(n, 5) + 1), k -> aggregate(filter(path, p -> shiftright(p, 5) = k), 0L, (s, p) -> s | shiftleft(1L, p & 31)))"
    return lattice.withColumn("path", F.expr(back)).select(*keys, F.expr(limbs).alias("cuts"))


def word_key(word: str) -> bytes:
    return hashlib.md5(word.encode(), usedforsecurity=False).digest()


def _bounds(n: int, cuts: list[int]) -> list[int]:
    """The places of the bits that are set."""
    if len(cuts) > 1:
        return [i for i in range(n + 1) if cuts[i // 32] >> i % 32 & 1]
    left, out = cuts[0], []
    while left:
        out.append((left & -left).bit_length() - 1)
        left &= left - 1
    return out


def word_ids(word: str, cuts: list[int] | None, ids: dict, bytes_at: int | None, unknown: int) -> list[int]:
    """The ids of a word whose boundaries are known; without any, its characters are its pieces."""
    bounds = range(len(word) + 1) if cuts is None else _bounds(len(word), cuts)
    out = [ids.get(word[a:b]) for a, b in pairwise(bounds)]
    if None not in out:
        return out
    whole = []
    for known, (a, b) in zip(out, pairwise(bounds)):
        if known is not None:
            whole.append(known)
        elif bytes_at is not None:
            whole += [bytes_at + x for x in word[a:b].encode()]
        elif whole[-1:] != [unknown]:    # unknown characters in a row are one id
            whole.append(unknown)
    return whole


def _split(text: Column, pieces: Pieces) -> Column:
    """The words of a text, most of them without their space mark; null for an empty one."""
    runs = F.regexp_extract_all(F.concat(F.lit(MARK), F.translate(text, " ", MARK)), F.lit(pieces.words()), F.lit(0))
    plain = ~(F.contains(text, F.lit("  ")) | F.contains(text, F.lit(MARK)) | F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" ")))
    return F.when(text != "", F.when(plain, F.split(text, " ")).otherwise(runs))


def _bare(word: Column) -> Column:
    """A word without its only space mark; words with more of them stay."""
    single = F.startswith(word, F.lit(MARK)) & (F.locate(MARK, word, 2) == 0)
    return F.when(single, F.substring(word, 2, (1 << 31) - 1)).otherwise(word)


def _whole(words: DataFrame) -> DataFrame:
    """``words`` (.., bare) with the word itself, its length, and 16 bytes that stand for it: edges are sorted by them."""
    word = F.when(F.contains("bare", F.lit(MARK)), F.col("bare")).otherwise(F.concat(F.lit(MARK), "bare"))
    return words.withColumn("word", word).withColumn("n", F.char_length("word")).withColumn("key", F.unhex(F.md5("word")))


def _bare_words(texts: pa.Array, pattern: re.Pattern) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts as ``_split`` and ``_bare`` give them, and for each text where they begin and how many."""
    odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK)), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
    odd = np.asarray(pc.or_(odd, pc.equal(texts, "")))
    lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    others = [pattern.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts.filter(pa.array(odd)).to_pylist()]
    words = pa.array([w[1:] if MARK not in w[1:] else w for found in others for w in found], pa.string())
    counts = np.zeros(len(texts), np.int64)
    counts[~odd], counts[odd] = np.diff(lists.offsets.to_numpy()), list(map(len, others))
    begins = np.zeros(len(texts), np.int64)
    for some in (~odd, odd):    # the words of plain texts come first
        begins[some] = np.cumsum(counts[some]) - counts[some]
    begins[odd] += counts[~odd].sum()
    return pa.concat_arrays([lists.flatten(), words]), begins, counts


def _frequent(rows: DataFrame, size: int, pieces: Pieces, table: DataFrame) -> DataFrame:
    """``(bare, ids)``: short words that occur often, and their ids as bytes."""
    some = rows.filter(F.pmod(F.xxhash64("text", "doc"), F.lit(max(1, size // GAUGE_BYTES))) == 0)
    split = some.select(F.explode(_split(F.col("text"), pieces)).alias("word")).select(_bare(F.col("word")).alias("bare"))
    counted = split.filter(F.char_length("bare") < SHORT).groupBy("bare").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    counted = materialize(counted, "counted-words")
    # as many as fit, by how often they occur: no order of all words is needed
    least, taken = 1 << 62, 0
    for r in sorted(counted.groupBy("times").count().collect(), reverse=True):
        taken += r["count"]
        if taken > OFTEN:
            break
        least = r.times
    n = 2 * rows.sparkSession.sparkContext.defaultParallelism
    words = _whole(counted.filter(F.col("times") >= least).select("bare")).repartition(n, "key")
    cuts = (_viterbi_cuts if pieces.unigram else _bpe_cuts)(words.select("key", "word", "n"), ["key"], pieces, table)
    known = (pieces.ids, pieces.bytes_at, pieces.unknown)

    def pack(batches):
        for b in batches:
            ids = [_packed(w, c, *known) for w, c in zip(b.column("word").to_pylist(), b.column("cuts").to_pylist())]
            yield pa.record_batch([b.column("bare"), pa.array(ids, pa.binary())], names=["bare", "ids"])

    found = words.join(cuts, "key", "left").select("bare", "word", "cuts")
    return materialize(found.mapInArrow(pack, "bare string, ids binary"), "frequent-words")


def _packed(word: str, cuts: list[int] | None, ids: dict, bytes_at: int | None, unknown: int) -> bytes:
    return array("i", word_ids(word, cuts, ids, bytes_at, unknown)).tobytes()


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False,
           decoded_col: str | None = None, round_trip_col: str | None = None) -> DataFrame:
    """``(doc_id, ids)``, one row for each row of ``docs``, and the text if wanted.

    ``decoded_col`` adds the column of ``decode``, made in the same pass: applied to the result, ``decode``
    would hold a second Python worker beside each of this one's.  ``round_trip_col`` says whether that decoded
    text is the text (null: empty), without sending either back.  Null and empty texts have no ids.  Null ids and repeated rows stay as rows; other columns aren't
    read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    table = _table(spark, pieces)
    often = _frequent(rows, size, pieces, table)
    n_chunks = max(-(-size // CHUNK_BYTES), 2 * spark.sparkContext.defaultParallelism)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc", "text"), F.lit(n_chunks)).cast("int")).repartition(n_chunks, "chunk")

    # a function of both columns, so that both branches read the same exchange
    text = F.concat("text", F.coalesce(F.substring(F.col("doc").cast("string"), 1, 0), F.lit("")))
    words = rows.select("chunk", F.explode(_split(text, pieces)).alias("word")).select("chunk", _bare(F.col("word")).alias("bare"))
    words = _whole(words.join(F.broadcast(often.select("bare")), "bare", "left_anti").distinct()).drop("bare")
    cuts = (_viterbi_cuts if pieces.unigram else _bpe_cuts)(words, ["key", "chunk"], pieces, table)
    shared = spark.sparkContext.broadcast({"pieces": (pieces.ids, pieces.bytes_at, pieces.unknown), "columns": often.toArrow(),
                                           "spellings": _spellings(pieces) if decoded_col or round_trip_col else None})
    pattern = re.compile(pieces.words())
    kind = rows.schema["doc"].dataType

    def put_together(texts: pa.Table, cuts: pa.Table) -> pa.Table:
        give_back()
        held = shared.value
        if "columns" in held:   # the first group of this worker; the table goes when the broadcast goes
            columns = held.pop("columns")
            held["often"] = dict(zip(columns.column("bare").to_pylist(), columns.column("ids").to_pylist()))
        often, spellings = held["often"], held["spellings"]
        known = {k: i for i, k in enumerate(cuts.column("key").to_pylist())}
        limbs = cuts.column("cuts").combine_chunks() if len(known) else pa.array([], pa.list_(pa.int64()))
        begins, values = limbs.offsets.to_pylist(), limbs.values.to_pylist()
        encoded: dict[str, bytes] = {}
        out = []
        for batch in texts.to_batches():
            found, word_begins, counts = _bare_words(batch.column("text"), pattern)
            coded = found.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            for bare in distinct:
                if bare not in often and bare not in encoded:
                    word = bare if MARK in bare else MARK + bare
                    at = known.get(word_key(word))
                    encoded[bare] = _packed(word, None if at is None else values[begins[at] : begins[at + 1]], *held["pieces"])
            packed = [often.get(bare) or encoded[bare] for bare in distinct]
            sizes = np.array([len(x) // 4 for x in packed], np.int64)
            which = _gather(coded.indices.to_numpy(), word_begins, counts)      # in the order of the texts
            ids = _gather(np.frombuffer(b"".join(packed), np.int32), (np.cumsum(sizes) - sizes)[which], sizes[which])
            offsets = np.append(0, np.cumsum(sizes[which]))[np.append(0, np.cumsum(counts))]
            columns = [batch.column("doc"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
            if keep_text:
                columns.append(batch.column("text"))
            if decoded_col or round_trip_col:
                decoded = _spelled(columns[1], spellings)
                columns += [decoded] * bool(decoded_col) + ([pc.equal(decoded, batch.column("text"))] if round_trip_col else [])
            out.append(pa.record_batch(columns, names=names))
        return pa.Table.from_batches(out)

    names = ["doc", "ids"] + ["text"] * keep_text + ["__decoded"] * bool(decoded_col) + ["__same"] * bool(round_trip_col)
    schema = (f"doc {kind.simpleString()}, ids array<int>" + ", text string" * keep_text + ", __decoded string" * bool(decoded_col)
              + ", __same boolean" * bool(round_trip_col))
    cuts = cuts.select(F.col("chunk").alias("of_chunk"), "key", "cuts")
    found = rows.groupBy("chunk").cogroup(cuts.groupBy("of_chunk")).applyInArrow(put_together, schema)
    return found.withColumnsRenamed({"doc": id_col} | ({"__decoded": decoded_col} if decoded_col else {}) | ({"__same": round_trip_col} if round_trip_col else {}))


def _spellings(pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids' texts on end, and by id where a text begins and its length."""
    size = max([*pieces.ids.values(), (pieces.bytes_at or 0) + 255, pieces.unknown]) + 1
    strings = [b""] * size
    for piece, i in pieces.ids.items():
        strings[i] = piece.replace(MARK, " ").encode()
    if pieces.bytes_at is not None:
        for x in range(256):
            strings[pieces.bytes_at + x] = bytes([x])
    lengths = np.array([len(x) for x in strings])
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lengths) - lengths, lengths


def _spelled(column: pa.ListArray, spellings: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    """The text of each list of ids, null for null."""
    pool, begins, lengths = spellings
    out = []
    for ids in column:
        if not ids.is_valid:
            out.append(None)
            continue
        ids = ids.values.to_numpy()
        n = lengths[ids]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[ids] - (ends - n), n)
        out.append(pool[at].tobytes().decode("utf-8", "replace").removeprefix(" "))
    return pa.array(out, pa.string())


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with a column of the text that the ids stand for (null for null ids).

    Byte pieces are put together as UTF-8; bytes that aren't become U+FFFD.  Ids without a text
    (control and unknown ones) give nothing.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(_spellings(pieces))

    def spell(batches):
        for b in batches:
            yield pa.record_batch([*b.columns, _spelled(b.column(ids_col), shared.value)], names=[*b.schema.names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(spell, f"{fields}, {text_col} string")

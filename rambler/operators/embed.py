"""Word2Vec over walk paths and naming of the learned vectors.

Spark ML trains as long as the vocabulary fits the driver, with its vectors and all else that is kept there
for a word; larger vocabularies are trained by buckets (``rambler.operators.skip_gram``).
"""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from rambler.operators.skip_gram import fit_skip_gram
from rambler.params import Word2VecParams


# What Spark ML's driver keeps of a word beside the vectors (its text, Huffman code and path of 40 numbers each, its
# place in a hash map, and what is sent and received of these), and the copies of a vector: 1,787 bytes in all were
# seen alive at once for each of 400,000 words with vectors of 16 numbers, which count as 1,956 here.
WORD_BYTES, VECTOR_COPIES = 1_700, 4


def driver_room(spark: SparkSession) -> int:
    """Bytes that training may keep on the driver: half of its heap, and no more than tasks may send it."""
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    sent = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.driver.maxResultSize", "1g"))
    return min(heap // 2, sent or heap)


def fits_driver(spark: SparkSession, matrix_bytes: int, params: Word2VecParams) -> bool:
    """Whether Spark ML's driver has room for a vocabulary whose two matrices (``vocabulary_size``) take so much."""
    words = matrix_bytes // (params.dim * 4 * 2)
    held = words * (WORD_BYTES + VECTOR_COPIES * 4 * params.dim)
    return matrix_bytes <= params.max_vocabulary_bytes and held <= driver_room(spark)


def path_tokens(paths: DataFrame, col: str = "path") -> DataFrame:
    """Vertex ids as string tokens (Word2Vec's vocabulary is strings)."""
    return paths.select(F.col(col).cast("array<string>").alias("tokens"))


def vocabulary_size(tokens: DataFrame, params: Word2VecParams, col: str = "tokens") -> tuple[int, int]:
    """Bytes of Spark ML's two matrices on the driver, and the longest sentence."""
    sizes = (tokens.select(F.size(col).alias("n"), F.explode_outer(col).alias("word")).groupBy("word")
             .agg(F.count(F.lit(1)).alias("count"), F.max("n").alias("n"))
             .agg(F.count_if((F.col("count") >= params.min_count) & F.col("word").isNotNull()).alias("words"), F.max("n").alias("longest"))
             .first())
    return sizes["words"] * params.dim * 4 * 2, max(1, sizes["longest"] or 1)


def fit_word2vec(tokens: DataFrame, params: Word2VecParams, col: str = "tokens", size: tuple[int, int] | None = None) -> Word2VecModel:
    """Skip-gram with every parameter set explicitly.

    Training runs on ``params.partitions`` partitions (by default as many as the session can
    run at once) and on whole sentences.  Spark ML keeps the vocabulary's vectors on the driver:
    their size is computed first, and more than ``max_vocabulary_bytes`` is an error.
    """
    held, longest = size or vocabulary_size(tokens, params, col)
    if held > params.max_vocabulary_bytes:
        raise ValueError(f"the vocabulary's vectors take {held} bytes on the driver; max_vocabulary_bytes is {params.max_vocabulary_bytes}")
    w2v = Word2Vec(vectorSize=params.dim, windowSize=params.window, stepSize=params.lr,
                   maxIter=params.iterations, minCount=params.min_count, seed=params.seed,
                   numPartitions=params.partitions or tokens.sparkSession.sparkContext.defaultParallelism,
                   maxSentenceLength=params.max_sentence_length or longest,
                   inputCol=col, outputCol="_w2v_out")
    return w2v.fit(tokens)


def train_vectors(tokens: DataFrame, params: Word2VecParams, col: str = "tokens") -> tuple[DataFrame, Word2VecModel | None]:
    """E1+E2: ``(key, vector)`` by the trainer that ``params`` names or the vocabulary's size asks for, and Spark ML's model, if it trained.

    By size, Spark ML trains what its driver has room for, by ``max_vocabulary_bytes`` and by ``fits_driver``.
    """
    if params.trainer not in ("auto", "driver", "buckets"):
        raise ValueError(f"unknown trainer {params.trainer!r}")
    if params.trainer != "buckets":
        size = vocabulary_size(tokens, params, col)
        if params.trainer == "driver" or fits_driver(tokens.sparkSession, size[0], params):
            model = fit_word2vec(tokens, params, col, size)
            return model_vectors(model), model
    return fit_skip_gram(tokens, params, col), None


def model_vectors(model: Word2VecModel) -> DataFrame:
    """``(key STRING, vector ARRAY<DOUBLE>)`` straight from the model's DataFrame."""
    return model.getVectors().select(F.col("word").alias("key"),
                                     vector_to_array("vector", "float64").alias("vector"))


def name_vectors(vectors: DataFrame, id_map: DataFrame, key: str = "key") -> DataFrame:
    """Vectors keyed by numeric vertex id → keyed by the original name (phone number)."""
    v = vectors.select(F.col(key).cast("bigint").alias("id"), "vector")
    return v.join(id_map.select("phone_number", "id"), "id").select("phone_number", "id", "vector")
